"""The registered queries: each applies one operator to its whole table and derives the
digest columns of the contract from what the operator returns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (bpe, fingerprints, jaccard, lexical, packing, quality, repeats, secrets, site_style, token_files,
                           topk, variants, warc)
from shelfcast.llm.common import documents

END_ID = 1
LEAST_QUALITY = 0.3


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    pooled = quality.features(docs, quality.shared_vectors(docs))
    model = quality.fit(pooled, documents(spark, sf_dir, "labels"))
    return quality.score(pooled, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= LEAST_QUALITY, 1).otherwise(0).alias("predicted"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets.scan(docs, secrets.train(docs))
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", name), ",").alias("spans"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = token_files.write(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return (token_files.read(spark, parts)
            .select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next", "common_prefix")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(documents(spark, sf_dir)).drop("tie")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(documents(spark, sf_dir))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.with_ids_and_text(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return both.select("doc_id", "n_tokens", F.sha2(F.col("ids"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive(warc.with_revisits(documents(spark, sf_dir, "pages")))
    full = F.col("record_type") == "response"
    # two reads with pushed predicates: responses with payloads, revisits from their headers alone
    whole = warc.read(spark, folder).where(full).select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", "refers_to")
    again = warc.read(spark, folder, payload=False).where(F.col("record_type") == "revisit").select(
        "record_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return whole.unionByName(again).select(
        warc.row_key("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", warc.row_key("refers_to").alias("refers_to"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op12_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (site_style.extract(documents(spark, sf_dir, "pages"))
            .withColumn("n_chars", F.char_length("text").cast("long")))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_secrets": op2_secrets,
    "op3_token_files": op3_token_files,
    "op4_fingerprints": op4_fingerprints,
    "op5_jaccard": op5_jaccard,
    "op6_topk": op6_topk,
    "op7_repeats": op7_repeats,
    "op8_packing": op8_packing,
    "op9_bpe": op9_bpe,
    "op10_warc": op10_warc,
    "op11_lexical": op11_lexical,
    "op12_site_style": op12_site_style,
    "op13_variants": op13_variants,
}

ORACLES: dict[str, str] = {
    "op6_topk": """
WITH v AS (SELECT DISTINCT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
     d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS payload_digest FROM p),
     h AS (SELECT payload_digest, payload_bytes, max(page_id) AS head FROM d WHERE payload_bytes >= 1000 GROUP BY 1, 2)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN head IS NOT NULL AND d.page_id IS DISTINCT FROM head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head IS NOT NULL AND d.page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM d LEFT JOIN h USING (payload_digest, payload_bytes)
""",
    "op11_lexical": r"""
WITH t AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') AS words FROM documents),
     s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(words)) AS BIGINT) AS total FROM t WHERE len(words) > 0),
     o AS (SELECT d, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, unnest(words) AS term FROM t) GROUP BY 1, 2),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM o, s GROUP BY term, docs),
     m AS (SELECT d, doc_id, 50 + (50 * len(words) * docs) // total AS m FROM t, s),
     i AS (SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS words FROM benchmark),
     q AS (SELECT i, item_id, unnest(words) AS term FROM i),
     r AS (SELECT i, item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
           FROM q JOIN w USING (term) JOIN o USING (term) JOIN m USING (d) GROUP BY i, item_id, d, doc_id),
     k AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
""",
}
