import gc
import random
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import zstandard

from tidewater.llm import bpe


def test_words_are_dealt_in_one_order():
    words = ["b", "é", "a b", "\U0001f600", "a"]
    assert bpe._by_part(words, 3) == bpe._by_part(set(words), 3)
    assert bpe._by_part(words, 1) == [([w.encode() for w in sorted(words)], sorted(words))]


def test_first_pieces_are_not_taken_for_those_after_a_space(spark):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["word", " word", "word word", "", "a  b", "word's  12345 word", "  word"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.ids for r in bpe.encode(docs, ranks, public_tokenizers.PATTERN, block_bytes=12).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_ids_are_decoded_where_they_are_made(spark, monkeypatch):
    monkeypatch.setattr(bpe, "DOCS", 2)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    texts = ["one two", None, "", "é 日本 \n\n x", "a  b", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2  # both sides of the join are packed, nothing runs after it
    got = {r.id: (bytes(r.decoded), r.ids) for r in coded.collect()}
    plain = {r.id: (bytes(r.decoded), r.ids) for r in bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()}
    assert got == plain == {i: ((t or "").encode(), plain[i][1]) for i, t in enumerate(texts)}


def test_numbers_of_words_are_freed_at_once():
    class Key:
        pass

    numbers, key = bpe._numbered(), Key()
    gone = weakref.ref(key)
    assert [numbers[key], numbers["a"], numbers[key]] == [0, 1, 0]
    gc.disable()
    try:
        del numbers, key
        assert gone() is None
    finally:
        gc.enable()


def test_short_and_long_words_are_merged_alike(monkeypatch):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rng = random.Random(5)
    words = ["".join(rng.choices("aeinrst lmé\u4e16\u0434", k=rng.randrange(1, 40))).encode() for _ in range(400)] + [b"a" * n for n in range(1, 70)]
    short = [bpe.encode_word(w, ranks) for w in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert short == [bpe.encode_word(w, ranks) for w in words]


def test_a_part_gives_every_block_the_ids_of_its_words(monkeypatch):
    ranks, coded = {bytes([b]): b for b in range(256)} | {b"ab": 256}, []
    original = bpe.encode_word
    monkeypatch.setattr(bpe, "encode_word", lambda word, known: coded.append(word) or original(word, known))
    shrink, grow = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    blocks = [[b"ab", b"c"], [b"abc", b"ab", b"\xc3\xa9"]]
    sent = pa.table({
        "part": pa.array([0, 0], pa.int32()),
        "block": pa.array([3, 5], pa.int32()),
        "sizes": pa.array([shrink(np.array([len(w) for w in b], np.int32).tobytes()) for b in blocks], pa.binary()),
        "words": pa.array([shrink(b"".join(b)) for b in blocks], pa.binary()),
    })
    out = bpe._encode_part(ranks)(sent)
    read = lambda column: [np.frombuffer(grow(x.as_py()), np.int32).tolist() for x in out[column]]
    assert read("counts") == [[1, 1], [2, 1, 2]] and read("ids") == [[256, 99], [256, 99, 256, 0xC3, 0xA9]]
    assert sorted(coded) == [b"ab", b"abc", b"c", b"\xc3\xa9"]
