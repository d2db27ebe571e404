import gc
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
from pathlib import Path

from tidewater.llm import alignment


def test_scoring_lets_go_of_the_encoders():
    a, b = (Path(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    alignment.load_pair(a.read_text(), b.read_bytes())
    score = alignment._score(np.zeros(1, np.int64), np.zeros(1, np.int64))
    assert score(pa.table({"packed": pa.array([], pa.binary())}), pa.table({"pos": pa.array([], pa.int32())})).num_rows == 0
    assert alignment.load_pair.cache_info().currsize == 0


def test_pieces_of_a_block_are_freed_at_once(monkeypatch):
    seen = []
    made = alignment.defaultdict
    monkeypatch.setattr(alignment, "defaultdict", lambda *a: seen.append(weakref.ref(d := Numbers(*a))) or d)

    class Numbers(made):
        pass

    pair = alignment.load_pair(*(Path(public_tokenizers.path(n)).read_text() if n.endswith("json") else Path(public_tokenizers.path(n)).read_bytes() for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    gc.disable()
    try:
        alignment._block([1], ["one two one"], pair, np.zeros(len(pair.bytes_a), np.int64))
        assert seen and seen[0]() is None
    finally:
        gc.enable()


def test_groups_go_back_in_chunks(monkeypatch):
    monkeypatch.setattr(alignment, "DOCS", 2)
    text = pa.array([b"1|2;", b"3,4|5;"], pa.binary())
    got = alignment._spelled(text, np.array([0, 1, 1, 0], np.int32), np.array([2, 0, 1, 1]))
    assert got.num_chunks == 2 and got.to_pylist() == ["1|2;3,4|5", "", "3,4|5", "1|2"]


def test_a_block_is_laid_in_small_rows(spark):
    """Rows of several parts give the figures of a block that fits one row."""
    a, b = (Path(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    rng = np.random.default_rng(7)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyzßé"), (40_000, 9))]
    docs = spark.createDataFrame([(i, " ".join(words[i * 2_000 : i * 2_000 + 4_000])) for i in range(20)], "doc_id long, text string").coalesce(1)
    laid = docs.selectExpr("doc_id id", "text").mapInArrow(alignment._lay(a.read_text(), b.read_bytes(), 1 << 30), alignment._LAID)
    widest = laid.selectExpr("max(length(packed)) a", "max(size(pairs)) b", "max(size(ids)) c", "sum(length(packed)) d", "sum(size(pairs)) e", "count(distinct block) f").first()
    assert widest.a <= 128 << 10 < widest.d and max(widest.b, widest.c) <= 1 << 10 < widest.e and widest.f == 1
    whole = alignment.align(docs, a.read_text(), b.read_bytes(), block_bytes=1 << 30).orderBy("id").collect()
    cut = alignment.align(docs, a.read_text(), b.read_bytes(), block_bytes=1 << 10).orderBy("id").collect()
    assert whole == cut and sum(r.n_links for r in whole) > 0
