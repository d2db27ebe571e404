"""The training-data operators against brute force on small tables with nulls, ties, repeats and clashing columns."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import bpe, exact_dedup, learning, line_dedup, mixing, quality, simhash, sketch, substring_dedup, toxicity, warc

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 40
ROWS = [
    (1, "The cat sat on the mat.\nA line that repeats here\n" + LONG, "en", "a", 1),
    (2, "Another text, short.\n  A LINE that repeats here \nend", "en", "b", 1),
    (3, "The cat sat on the mat.\nA line that repeats here\n" + LONG, "en", "a", 1),
    (3, "The cat sat on the mat.\nA line that repeats here\n" + LONG, "en", "a", 1),
    (4, None, None, None, None),
    (5, "", "en", "a", 0),
    (6, " \t\n ", "fr", "", 4),
    (7, LONG.upper() + "é É ß İ x \x1c", "de", "b", 9),
    (None, "The  cat sat on the mat. A line that repeats here " + LONG, "en", None, 3),
    (None, None, "en", None, 3),
    (8, "x" * 3000, "en", "c", 3000),
    (9, "y " + LONG + " z", "en", "c", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    clash = {c: F.lit(1) for c in ("id", "key", "block", "row", "fp", "line", "part", "size", "norm")}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def bare(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def test_exact_groups(docs, empty):
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(bare(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = []
    for norm, members in groups.items():
        for k, (_, _, _, i) in enumerate(sorted(members)):
            want.append((i, sorted(members)[0][3], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    got = exact_dedup.exact_groups(docs).drop("n_chars").collect()
    same([tuple(r) for r in got], want)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_groups_over_many_partitions(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup.exact_groups(rows.repartition(7))
    hot = got.where("group_size > 1")
    assert hot.count() == 1000 and {tuple(r) for r in hot.select("keep_id", "group_size").distinct().collect()} == {(0, 1000)}
    assert got.where("kept").count() == 2001


def test_lines(docs, empty):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip("\x20\t\n\x0b\x0c\r"))

    big = 2**63
    owner = {}
    for i, t, *_ in ROWS:
        for line in (t or "").split("\n"):
            owner[key(line)] = min(owner.get(key(line), big), big - 1 if i is None else i)
    want = []
    for i, t, *_ in ROWS:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == (big - 1 if i is None else i)]
        want.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    for batches in (1, 3):
        got = line_dedup.drop_repeated_lines(docs, batches=batches).select("row.doc_id", "kept_text", "n_lines", "n_dropped")
        same([tuple(r) for r in got.collect()], want)
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def shingle_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(len(words) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints_and_groups(docs, empty):
    got = simhash.near_groups(docs).collect()
    same([(r.id, r.fingerprint) for r in got], [(i, f"{shingle_print(t):016x}") for i, t, *_ in ROWS])
    assert {r.component_id for r in got if r.id in (1, 3)} == {1}
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {4}
    assert simhash.near_groups(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 3").count() == 0 and kept.where("doc_id = 1").count() == 1
    assert simhash.keep_one(empty).count() == 0


def test_simhash_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = np.unique(np.concatenate([rng.integers(0, 2**63, 800, dtype=np.uint64), *[np.bitwise_xor.reduce([s, *(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64))]).reshape(1) for s in seeds for k in range(7)]]))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(4)
    roots = {r.node: r.root for r in simhash.connected(simhash.links(table)).collect()}
    a, b = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, 1))
    nodes, want = simhash.components_of(fps[a], fps[b])
    label = {int(n): int(r) for n, r in zip(nodes.view(np.int64), want.view(np.int64), strict=True)}
    groups, found = {}, {}
    for x in fps.view(np.int64).tolist():
        groups.setdefault(label.get(x, x), set()).add(x)
        found.setdefault(roots.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_a_dense_group_is_linked_through_a_forest():
    have = np.arange(300, dtype=np.uint64)
    a, b = simhash._link_large(have, have)
    assert len(a) < 300 and set(simhash.components_of(a, b)[1].tolist()) == {0}


def test_one_large_group_alone_and_groups_without_questions():
    many = np.arange(2000, dtype=np.uint64)
    asks = np.repeat(np.array([0, 1], np.int8), len(many))
    a, b = simhash._link_groups(np.zeros(2 * len(many), np.int64), np.concatenate([many, many]), asks)  # 4 million pairs
    assert len(a) == len(many) - 1 and set(simhash.components_of(a, b)[1].tolist()) == {0}
    a, b = simhash._link_groups(np.array([1, 1, 2]), np.arange(3, dtype=np.uint64), np.zeros(3, np.int8))
    assert len(a) == len(b) == 0


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


#: Text per block for many blocks, and for one.
BLOCKS = [sum(len((r[1] or "").encode()) for r in ROWS) // 16, 1 << 22]


@pytest.mark.parametrize("block_bytes", BLOCKS)
def test_bpe_equals_the_library(spark, docs, empty, ranks, block_bytes):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["a  b \n c\n\n  d ", " lead", "tail ", "don't 'llx", "a\x1cb \x1c c\x85 d", "".join(f"x{chr(c)} y" for c in range(0x3100) if not 0xD800 <= c < 0xE000)]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    got = bpe.decode(bpe.encode(docs.select("doc_id", "text").unionByName(more), ranks, public_tokenizers.PATTERN, block_bytes=block_bytes), ranks).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in [(r[0], r[1]) for r in ROWS] + [(100 + i, t) for i, t in enumerate(odd)]]
    same([(r.id, list(r.ids), bytes(r.decoded)) for r in got], want)
    assert bpe.encode(empty, ranks, public_tokenizers.PATTERN).count() == 0


def test_long_words_merge_as_short_ones(ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for word in ("a" * 500, "abcabcxyz" * 60, "ñandú" * 50):
        assert bpe.encode_word(word.encode(), ranks) == library.encode_ordinary(word)


def test_mixing(docs, empty, spark):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    sums = {}
    for r in got:
        sums.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(taken - target) <= 1 for taken, target in sums.values())
    total = sum(r.size for r in got)
    assert abs(sum(t for _, t in sums.values()) - 1.5 * total) < 1e-6 * total
    assert sorted(r.taken for r in mixing.mix(docs).collect()) == sorted(r.taken for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.taken_rows(empty).count() == 0
    rows = mixing.taken_rows(docs)
    assert rows.columns == docs.columns
    assert rows.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in got)


def test_targets_share_the_excess_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 400)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # weights 3, 1, 2, 3: a stops at 20, then null at 800 (2845 / 6 each is above), then c at 1000 (2045 / 3); b gets the rest
    assert got == {"a": 20, None: 800, "c": 1000, "b": pytest.approx(1045)}


@pytest.mark.parametrize("block_bytes", BLOCKS)
def test_passages(docs, empty, block_bytes):
    big = 2**63 - 1
    first = {}
    for i, t, *_ in ROWS:
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = min(first.get(raw[p : p + 50], big), big if i is None else i)
    want = []
    for i, t, *_ in ROWS:
        raw, gone = (t or "").encode(), set()
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < (big if i is None else i):
                gone.update(range(p, p + 50))
        spans = sum(p - 1 not in gone for p in gone)
        want.append((i, len(raw), len(gone), spans, bytes(b for p, b in enumerate(raw) if p not in gone)))
    got = substring_dedup.drop_repeated_passages(docs, block_bytes=block_bytes).collect()
    same([(r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got], want)
    assert substring_dedup.drop_repeated_passages(empty).count() == 0


def test_merged_runs_are_sorted():
    rng = np.random.default_rng(3)
    runs = [sorted({bytes(rng.integers(97, 100, rng.integers(0, 9)).tolist()) for _ in range(n)}) for n in (0, 1, 40, 60, 25)]

    def shared(x, y):
        return next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))

    commons = [[0, *(shared(x, y) for x, y in zip(r, r[1:], strict=False))][: len(r)] for r in runs]
    order, common = substring_dedup.merge_runs(runs, commons)
    at, out = [0] * len(runs), []
    for r in order:
        out.append(runs[r][at[r]])
        at[r] += 1
    assert out == sorted(x for r in runs for x in r)
    assert common[1:] == [shared(x, y) for x, y in zip(out, out[1:], strict=False)]


def test_sketches(spark, docs, empty):
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    distinct = [r for i, r in enumerate(order) if i == 0 or (r[0], r[1] or "") != (order[i - 1][0], order[i - 1][1] or "")]
    edited = {}
    for k, r in enumerate(distinct):
        own, after = r[1] or "", distinct[(k + 1) % len(distinct)][1] or ""
        half = len(own) // 2
        edited[r[0], own] = own[: len(own) - half] + after[:half]
    got = sketch.fingerprints(docs).collect()
    same([(r.id, r.n_chars, r.edited) for r in got], [(r[0], len(r[1] or ""), edited[r[0], r[1] or ""]) for r in ROWS])
    assert len({tuple(r.sketch) for r in got if r.id in (1, 3)}) == 1 and sketch.fingerprints(empty).count() == 0
    two = spark.createDataFrame([("one two three four five six seven eight", "two three four five six seven eight nine ten")], "a string, b string")
    two = two.withColumn("c", F.concat_ws(" ", "a", "b"))
    for c in "abc":
        two = sketch.with_sketch(two, c, f"s{c}")
    row = two.select(sketch.likeness(F.col("sa"), F.col("sa")), sketch.merge(F.col("sa"), F.col("sb")), "sa", "sb").first()
    low = sorted({h for h in [*row.sa, *row.sb] if h < sketch.BELOW}) or [min([*row.sa, *row.sb])]
    assert row[0] == 1.0 and list(row[1]) == low


def test_archives(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "ü", "é" * 5000), (None, "u", "alone"), (None, "u", "same")], "page_id long, url string, html string").withColumn("of", F.lit(1))
    got = {(r.page_id, r.payload_bytes): r for r in warc.round_trip(pages).collect()}

    def digest(x):
        return base64.b32encode(hashlib.sha1(x.encode()).digest()).decode()

    assert (got[1, 4].record_type, got[1, 4].refers_to, got[2, 4].record_type, got[2, 4].refers_to) == ("revisit", 2, "response", None)
    assert (got[3, 0].record_type, got[3, 0].refers_to, got[4, 0].record_type) == ("revisit", 4, "response")
    assert got[None, 5].record_type == "response" and got[None, 4].record_type == "revisit" and len(got) == 7
    assert got[5, 10000].payload_digest == digest("é" * 5000) and got[1, 4].payload_digest == digest("same")
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_faulty_archives_are_refused():
    good = warc.record(1, "u", b"payload", None, False)
    assert warc.parse(good)[:2] == (1, 7)
    for bad in (good[:-1], good.replace(b"payload", b"pAyload"), good.replace(b"WARC-Type", b"X-Type"), good.replace(b"WARC/1.1", b"WARC/9")):
        with pytest.raises(ValueError):
            warc.parse(bad)
    with pytest.raises(ValueError):
        list(warc.read_archive(b"garbage that is no frame"))


@pytest.mark.parametrize("train, score, label, cut", [(quality.train, quality.score_quality, "quality", 0.5), (toxicity.train, toxicity.score_toxicity, "toxic", 0.3)])
def test_classifiers(spark, docs, empty, train, score, label, cut):
    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(600):
        mark = int(rng.random() < 0.3)
        own = list(rng.choice(words, 40)) + (["badone", "nasty"] if mark else [])
        rng.shuffle(own)
        rows.append((i, " ".join(own), mark))
    table = spark.createDataFrame(rows, "doc_id long, text string, mark int")
    labels = table.select("doc_id", F.col("mark").alias(label)).unionByName(spark.createDataFrame([(None, 1), (1, None)], f"doc_id long, {label} int"))
    model = train(table, labels)
    got = score(table, model, mark=F.col("mark"), out=learning.held_out(F.col("doc_id"), 3, 1)).collect()
    assert np.mean([r.predicted == r.mark for r in got]) > 0.97 and all(r.predicted == int(r.score >= cut) for r in got)
    assert score(docs, model).count() == len(ROWS) and score(empty, model).count() == 0
    for none in (labels.limit(0), labels.withColumn(label, F.lit(1))):
        assert all(0 <= r.score <= 1 for r in score(docs, train(table, none)).collect())


def pair_texts(seed, n=600):
    """Toxic is mona with fool, and lisa with king; each of the four words is in half of the texts of either class."""
    rng, out = np.random.default_rng(seed), []
    for i in range(n):
        first, second = i % 2, i // 2 % 2
        own = [*rng.choice([f"word{k}" for k in range(300)], 40), ("mona", "lisa")[first], ("fool", "king")[second]]
        out.append((" ".join(rng.permutation(own)), int(first == second)))
    return out


def test_toxic_pairs_of_words_that_tell_nothing_alone():
    terms = toxicity.make_terms()
    known, new = ([(terms(t), y) for t, y in pair_texts(seed)] for seed in (1, 2))
    rng = np.random.default_rng(3)
    known = [known[i] for i in rng.permutation(len(known))]
    model = toxicity.fit([r for r, _ in known], np.array([y for _, y in known]))
    assert np.mean([(model.slope * model.margin(r) + model.shift > 0) == y for r, y in new]) > 0.95


def test_a_rare_insult_keeps_its_weight():
    terms, rng, rows, labels = toxicity.make_terms(), np.random.default_rng(1), [], []
    for i in range(2985):  # about as many as the labels of sf0.1; every fifth calibrates
        toxic = i % 9 == 0
        rows.append(terms(" ".join([*rng.choice([f"word{k}" for k in range(300)], 40), *(["nasty"] if toxic else []), *(["vile"] if i in (9, 18, 27, 36) else [])])))
        labels.append(int(toxic))
    model = toxicity.fit(rows, np.array(labels))
    assert model.linear[terms("vile")[0]] > 0


def test_pipeline(spark, docs, empty, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, quality int").write.parquet(f"{base}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash", "mixing", "bpe"]
    for table in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, base)
            assert name == "bpe" or out.columns == table.columns
            assert out.count() <= 2 * max(table.count(), 0) + 3
    docs.write.parquet(f"{base}/documents.parquet")
    assert "n_tokens" in corpus_pipeline.run(spark, base).columns
