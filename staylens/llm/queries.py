"""The registered queries of this subpackage and their SQL, where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import alignment, bytebpe, jaccard, langid, licenses, lines, lm, packing, quality, substrings, topk, variants, viterbi


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents")).drop("detections")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(_table(spark, sf_dir, "documents"), langid.held_out(5, 1))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = viterbi.encode_texts(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_ids", F.crc32("ids").alias("ids_crc32"), "round_trip")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(_table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup_substrings(_table(spark, sf_dir, "documents").select("doc_id", "text"), window=20)
    return out.select("doc.doc_id", "n_words", "n_removed", "kept_sha256")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), langid.held_out(4, 2)
    model = langid.learn(docs.where(~held_out))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents")).drop("groups")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(_table(spark, sf_dir, "documents"), least=3, modulus=97, times=2)


def op13_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bytebpe.encode_texts(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_lines": op2_lines,
    "op3_licenses": op3_licenses,
    "op4_topk": op4_topk,
    "op5_lm": op5_lm,
    "op6_pieces": op6_pieces,
    "op7_jaccard": op7_jaccard,
    "op8_substrings": op8_substrings,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_variants": op12_variants,
    "op13_bytebpe": op13_bytebpe,
}

SQL: dict[str, str] = {
    "op4_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op7_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0) t
), n AS (
  SELECT doc_id, CAST(COUNT(*) AS BIGINT) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.i >= 90 * (na.n + nb.n - p.i)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, MIN(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
""",
    "op8_substrings": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20) t
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win) t WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later
), words AS (
  SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w
), kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS t, COUNT(*) AS n
  FROM words x ANTI JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
""",
}
