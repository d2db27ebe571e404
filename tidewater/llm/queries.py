"""One registered query per operator, over its whole table, and oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import alignment, bpe, exact_dedup, learning, line_dedup, merkle, mixing, quality, simhash, sketch, substring_dedup, toxicity, url_filter, warc

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The two vocabularies that are aligned.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
#: The written rules for addresses as (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sketch.fingerprints(_table(spark, sf_dir, "documents"))
    own, edited = F.col("sketch"), F.col("edited_sketch")
    return done.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch.as_text(own).alias("fingerprint"),
        sketch.as_text(edited).alias("edited_fingerprint"),
        sketch.likeness(own, edited).alias("near_edited"),
        sketch.likeness(own, F.col("next_sketch")).alias("near_next"),
        sketch.containment(own, edited).alias("in_edited"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), learning.held_out(F.col("id"), quality.FOLDS, quality.FOLD).alias("held_out"), "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "part")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), learning.held_out(F.col("id"), toxicity.FOLDS, toxicity.FOLD).alias("held_out"), "score", "predicted")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.drop_repeated_passages(_table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (Path(public_tokenizers.path(name)).read_bytes() for name in ALIGNED)
    done = alignment.align(_table(spark, sf_dir, "documents"), a.decode(), b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return done.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    more = {"n_chars": docs["n_chars"].cast("decimal(20,0)") + 1}
    changed = merkle.leaf_of([more.get(c, docs[c]) for c in merkle.FIELDS])
    tampered = F.crc32(docs["doc_id"].cast("string")) % 7 == 0
    done = merkle.manifest(docs, seen=F.when(tampered, changed))
    return done.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        merkle.fold(F.coalesce("seen", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_BLANK = r"[\x20\x09-\x0D]"

_OP1_SQL = rf"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)
"""

_OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), placed AS (
  SELECT *, length(k) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY k) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM placed GROUP BY doc_id
"""

# CRC-32 bit by bit: 3988292384 is its polynomial, 4294967295 its start and final mask.
_OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT *, CAST(doc_id AS VARCHAR) AS key FROM documents
), tampered AS (
  SELECT *, coalesce(xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(key[i]) AS BIGINT)),
    lambda crc, x: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END, xor(crc, x)),
    CAST(4294967295 AS BIGINT)), 4294967295) % 7 = 0, false) AS bad FROM d
), parts AS (
  SELECT *, coalesce(strlen(key) || ':' || key, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail, CAST(n_chars AS VARCHAR) AS own, CAST(n_chars + 1 AS VARCHAR) AS more FROM tampered
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(own) || ':' || own, '-') || tail) AS leaf,
    CASE WHEN bad THEN sha256(head || coalesce(strlen(more) || ':' || more, '-') || tail) ELSE sha256(head || coalesce(strlen(own) || ':' || own, '-') || tail) END AS seen FROM parts
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM leaves
), low AS (
  SELECT g, 0 AS lvl, idx, n, leaf AS h FROM placed
  UNION ALL
  SELECT g, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY g, lvl, idx // 2, n
), subroots AS (
  SELECT g, lvl AS height, h, (SELECT count(DISTINCT g) FROM placed) AS n FROM low WHERE n = 1
), high AS (
  SELECT 0 AS lvl, g AS idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY lvl, idx // 2, n
), steps AS (
  SELECT p.g, p.idx AS place, l.lvl, s.h AS sibling, s.idx < l.idx AS is_left FROM placed p
  JOIN low l ON l.g = p.g AND l.idx = p.idx >> l.lvl AND l.n > 1 LEFT JOIN low s ON s.g = l.g AND s.lvl = l.lvl AND s.idx = xor(l.idx, 1)
  UNION ALL
  SELECT p.g, p.idx, r.height + l.lvl, s.h, s.idx < l.idx FROM placed p JOIN subroots r USING (g)
  JOIN high l ON l.idx = p.g >> l.lvl AND l.n > 1 LEFT JOIN high s ON s.lvl = l.lvl AND s.idx = xor(l.idx, 1)
), folded AS (
  SELECT g, idx AS place, 0 AS lvl, seen AS h FROM placed
  UNION ALL
  SELECT f.g, f.place, f.lvl + 1, sha256(CASE WHEN s.sibling IS NULL THEN f.h WHEN s.is_left THEN s.sibling || f.h ELSE f.h || s.sibling END)
  FROM folded f JOIN steps s USING (g, place, lvl)
), proofs AS (
  SELECT g, place, coalesce(string_agg(sibling, '' ORDER BY lvl), '') AS proof FROM steps GROUP BY g, place
), ends AS (
  SELECT g, place, arg_max(h, lvl) AS folded_root FROM folded GROUP BY g, place
)
SELECT p.doc_id, p.leaf, r.h AS subroot, t.h AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, e.folded_root, e.folded_root = t.h AS verified
FROM placed p JOIN subroots r USING (g) CROSS JOIN (SELECT h FROM high WHERE n = 1) t
LEFT JOIN proofs q ON q.g = p.g AND q.place = p.idx JOIN ends e ON e.g = p.g AND e.place = p.idx
"""

_QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_simhash": op3_simhash,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_line_dedup": op5_line_dedup,
    "op6_bpe": op6_bpe,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_passages": op9_passages,
    "op10_warc": op10_warc,
    "op11_url_filter": op11_url_filter,
    "op12_alignment": op12_alignment,
    "op13_merkle": op13_merkle,
}
_SQL = {"op1_exact_dedup": _OP1_SQL, "op5_line_dedup": _OP5_SQL, "op13_merkle": _OP13_SQL}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
