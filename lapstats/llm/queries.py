"""Registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstats.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    licenses,
    quality_nbsvm,
    secrets,
    sharding,
    simhash,
    spelling,
    topk,
    toxicity_cnn,
    training_order,
    vector_codes,
)
from lapstats.llm.common import table
from lapstats.llm.labels import fold

#: Scores from which a document counts as good, or as toxic.
GOOD, TOXIC = 0.3, 0.7
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def _folded(scored: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"),
                         *[c for c in scored.columns if c not in ("doc_id", "score")])


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_nbsvm.Model:
    return quality_nbsvm.fit(docs, table(spark, sf_dir, "labels"), "quality", fold(5) != 0)


def op1_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _folded(quality_nbsvm.score(docs, quality_model(spark, docs, sf_dir)), fold(5) == 0, GOOD)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, benchmark).drop("__key")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4).select(
        "doc_id", "fingerprint", "component_id")


def token_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of the ids of each text and of what they decode to."""
    path = public_tokenizers.path(RANK_FILE)
    both = bpe.encode(docs, path, public_tokenizers.PATTERN, with_bytes=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_cnn.fit(docs, table(spark, sf_dir, "labels"), "toxic", fold(3) != 1, common_threshold=TOXIC)
    return _folded(toxicity_cnn.score(docs, model), fold(3) == 1, TOXIC)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *(count(k) for k in secrets.BASE), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=8).drop("row_number")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with what was matched; documents without a license have empty lists."""
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.col("matches.license"))), ",").alias("licenses"),
        F.array_max(F.col("matches.coverage")).alias("best_coverage"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(
            ":", m["license"], m["start"].cast("string"), m["end"].cast("string"))), ",").alias("spans"))


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte ids of all texts in shards of 16384 sequences of 1024 ids, on shared storage; a row per sequence."""
    return training_order.materialise(table(spark, sf_dir, "documents"), training_order.byte_ids(F.col("text")),
                                      training_order.shared_path(spark, "training-order"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"), scale=4096, parts=8, entries=16, rounds=6)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), least=7, count=2, ratio=10, slip_every=31).select(
        "word", "form", "root", "n", "n_near", "form_n")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_nbsvm, op2_decontaminate, op3_simhash, op4_bpe, op5_toxicity_cnn, op6_secrets, op7_exact_dedup,
    op8_feistel_shards, op9_licenses, op10_training_order, op11_vector_codes, op12_spelling, op13_topk, pipeline)}

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _pq_round(i: int) -> str:
    """CTEs of one round: parts with their nearest entry of codebook i, and the codebook i + 1."""
    return f"""
d{i} AS (SELECT v.vec_id, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x)) AS d2
         FROM v JOIN c{i} c USING (part, dim) GROUP BY ALL),
a{i} AS MATERIALIZED (SELECT vec_id, part, min(d2) AS d2, arg_min(entry, d2 * 16 + entry) AS entry FROM d{i} GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, c.dim, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT part, entry, dim, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM v JOIN a{i} USING (vec_id, part)
    GROUP BY ALL) m USING (part, entry, dim))"""


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE = {
    "op2_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, w[s + 1:s + 10] AS win, len(w[s + 1:s + 10]) AS size
       FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, size, s, w[s + 1:s + size] AS win
       FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS s
             FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
hits AS (SELECT doc_id, s, dw.size AS size, item_id FROM dw JOIN iw ON dw.win = iw.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
          FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op7_exact_dedup": r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
""",
    "op11_vector_codes": f"""
WITH kept AS (SELECT vec_id, label, embedding FROM embeddings WHERE {_FINITE}),
v AS MATERIALIZED (SELECT vec_id, (pos - 1) // 8 AS part, (pos - 1) % 8 AS dim, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x
      FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM kept)),
c0 AS MATERIALIZED (SELECT part, entry, dim, x FROM v JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16))
    USING (vec_id)),{",".join(_pq_round(i) for i in range(7))},
coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INT)), '' ORDER BY part) AS code, CAST(sum(d2) AS BIGINT) AS error
          FROM a6 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, dim)) FROM c6) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
""",
    "op13_topk": f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
                        WHERE vec_id IS NOT NULL AND {_FINITE}),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
""",
}
