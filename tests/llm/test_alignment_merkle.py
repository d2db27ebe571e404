"""Tokenizer alignment and the Merkle manifest against plain Python."""

import hashlib
import random
from collections import Counter
from pathlib import Path
from zlib import crc32

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tidewater.llm import alignment, merkle, queries

A, B = (Path(public_tokenizers.path(n)) for n in queries.ALIGNED)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "The cat sat on the mat.\nTwo  spaces,\ttabs and 123 numbers; don't stop", "en", "a", 1),
    (2, "The cat sat on the mat.\nTwo  spaces,\ttabs and 123 numbers; don't stop", "en", "b", 1),
    (2, "The cat sat on the mat.\nTwo  spaces,\ttabs and 123 numbers; don't stop", "en", "b", 1),
    (3, None, None, None, None),
    (4, "", "en", "é", 0),
    (5, " lead and trail ", "fr", "", 4),
    (6, "a piece sign ▁ in the text", "de", "b", 9),
    (7, "<|endoftext|> <s> </s> <unk> <0x41> plain", "de", "b", 9),
    (None, "ünïcödé 日本語のテキスト 😀 \x00 \x85 \xa0 end", "en", None, 3),
    (8, "x" * 3000 + " " * 70, "en", "c", 3000),
    (9, "word " * 500, "en", "c", 2**40),
    (10, " ", "ja", "c", 2**63 - 2),
    (14, " \n ", None, "c", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    clash = {c: F.lit(1) for c in ("id", "block", "packed", "group", "h", "n", "g", "idx", "top", "_rank", "a b", "x.y", "q`z")}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def plain_pair():
    a = tokenizers.Tokenizer.from_file(str(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(B))
    return a, b


def plain_alignment(rows):
    """The contract, token by token."""
    a, b = plain_pair()
    back = {c: x for c, x in zip(sorted(tokenizers.pre_tokenizers.ByteLevel.alphabet(), key=ord), range(256), strict=True)}
    # The stand-ins in the order of their bytes: printable ones are themselves, the others follow from 256.
    others = iter(x for x in range(256) if chr(x) not in back)
    back = {c: ord(c) if ord(c) < 256 else next(others) for c in back}
    bytes_a = lambda i: bytes(back[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    coded, count = [], Counter()
    for i, t in rows:
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        raw = (" " + (t or "")).encode()
        if not t or b"".join(map(bytes_a, ids_a)) != raw or b"".join(map(bytes_b, ids_b)) != raw:
            ids_a, ids_b = [], []
        ends = []
        for ids, size in ((ids_a, bytes_a), (ids_b, bytes_b)):
            at, own = 0, []
            for x in ids:
                at += len(size(x))
                own.append(at)
            ends.append(own)
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(x, y) for e in both for x, p in zip(ids_a, ends[0], strict=True) if p == e for y, q in zip(ids_b, ends[1], strict=True) if q == e] if len(both) < 400 else [(dict(zip(ends[0], ids_a, strict=True))[e], dict(zip(ends[1], ids_b, strict=True))[e]) for e in both]
        groups, before = [], 0
        for e in both:
            part = [",".join(str(x) for x, p in zip(ids, own, strict=True) if before < p <= e) for ids, own in ((ids_a, ends[0]), (ids_b, ends[1]))]
            groups.append("|".join(part))
            before = e
        count.update(links)
        coded.append((i, len(ids_a), len(ids_b), len(groups), links, ";".join(groups)))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return [(i, x, y, g, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), text) for i, x, y, g, links, text in coded]


@pytest.mark.parametrize("block_bytes", [40, 1 << 24])
def test_alignment_equals_brute_force(docs, empty, block_bytes):
    args = A.read_text(), B.read_bytes()
    got = alignment.align(docs, *args, block_bytes=block_bytes)
    same([tuple(r) for r in got.collect()], plain_alignment([(r[0], r[1]) for r in ROWS]))
    assert alignment.align(empty, *args).count() == 0


def test_alignment_query(spark, docs, tmp_path):
    docs.drop("q`z", "x.y", "a b").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in plain_alignment([(r[0], r[1]) for r in ROWS])]
    same([tuple(r) for r in got.collect()], want)


def test_pieces_encode_as_the_whole_text():
    a, b = plain_pair()
    pair = alignment.load_pair(A.read_text(), B.read_bytes())
    rng = random.Random(4)
    signs = [*"abcXY '’s.,!?\n\t\r 12 é日本\x00\x1c\x85\xa0 _-<|>/", "  ", "   ", " \n", "<s>", "<|endoftext|>", "ﬁ", "'ll", "😀", "​"]
    for _ in range(5000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 14)))
        pieces = alignment.pieces_of(text)
        assert "".join(" " + p for p in pieces) == " " + text
        found = alignment.align_pieces(pieces, pair)
        assert found.good.all()
        assert (found.n_a.sum(), found.n_b.sum()) == (len(a.encode(" " + text, add_special_tokens=False).ids), len(b.encode(text)))


def test_a_very_long_text(spark):
    text = ("lorem ipsum dolor sit amet, consectetur\n" * 40_000) + "y" * 20_000
    got = alignment.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A.read_text(), B.read_bytes()).first()
    a, b = plain_pair()
    assert (got.n_a, got.n_b) == (len(a.encode(" " + text, add_special_tokens=False).ids), len(b.encode(text)))


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, more=0):
    i, text, lang, source, n = r
    n = None if n is None else n + more
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def plain_tree(nodes, fanout):
    """Root and, per node, the list of (before, after) on its way."""
    proofs, of = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(s, min(s + fanout, len(nodes))) for s in range(0, len(nodes), fanout)]
        for run in runs:
            for k in run:
                for leaf in of[k]:
                    proofs[leaf].append(("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k)))
        nodes, of = [digest(*[nodes[k] for k in run]) for run in runs], [[x for k in run for x in of[k]] for run in runs]
    return nodes[0], proofs


def plain_manifest(rows, fanout):
    first = lambda v: (v is not None, (v or "").encode() if not isinstance(v, int) else v)
    out, tops = [], []
    groups = sorted({r[2] for r in rows}, key=first)
    for g in groups:
        own = sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        top, proofs = plain_tree([plain_leaf(r) for r in own], fanout)
        tops.append(top)
        out.append((own, top, proofs))
    root, above = plain_tree(tops, fanout)
    return [(r, plain_leaf(r), top, root, [*p, *up]) for (own, top, proofs), up in zip(out, above, strict=True) for r, p in zip(own, proofs, strict=True)]


@pytest.mark.parametrize("fanout, nodes", [(2, 256), (2, 4), (3, 3)])
def test_manifest_equals_brute_force(docs, empty, monkeypatch, fanout, nodes):
    monkeypatch.setattr(merkle, "BLOCK_NODES", nodes)
    got = merkle.manifest(docs, fanout=fanout).withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    want = plain_manifest(ROWS, fanout)
    same([(r.id, r.group, r.leaf, r.subroot, r.root, [tuple(p) for p in r.proof], r.folded) for r in got], [(r[0], r[2], leaf, top, root, proof, root) for r, leaf, top, root, proof in want])
    assert merkle.manifest(empty, fanout=fanout).count() == 0


def test_manifest_query_finds_what_was_tampered(spark, docs, tmp_path):
    docs.drop("q`z", "x.y", "a b").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_merkle(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = []
    for r, leaf, top, root, proof in plain_manifest(ROWS, 2):
        at = plain_leaf(r, 1) if r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0 else leaf
        for before, after in proof:
            at = digest(before, at, after)
        want.append((r[0], leaf, top, root, digest(*[x + y for x, y in proof]), at, at == root))
    same([tuple(r) for r in got.collect()], want)
    assert {w[6] for w in want} == {True, False}


def test_many_rows_and_groups(spark):
    rows = [(i % 900, f"t{i % 37}", f"l{i % 11}" if i % 3 else "hot", "s", i) for i in range(1500)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    same([(r.id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.proof]) for r in got], [(r[0], leaf, top, root, proof) for r, leaf, top, root, proof in plain_manifest(rows, 2)])
