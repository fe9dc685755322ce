"""The operators as registered queries, one thin function each, and SQL where SQL can express the result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.llm import (
    decontaminate, exact_dedup, hard_negatives, jaccard_join, language_id, license_scan, packing, pii, sentence_spans, sharding,
    spelling_variants, suffix_dedup, warc,
)
from framewell.llm.common import read_table
from framewell.plans.settle import shared_folder

# A key for the shared test tables only; a real one is a secret of the caller.
TEST_KEY = b"test tables only, not a secret"
SHARDS = [f"shard-{i:03d}" for i in range(128)]


def tokenizer_file() -> str:
    """The public vocabulary that the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_classes(read_table(spark, sf_dir, "documents")).drop("same")


def language_model(docs: DataFrame) -> language_id.Model:
    """Learned from labelled documents that are not held out."""
    return language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_model(docs)).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read_table(spark, sf_dir, "documents"), TEST_KEY)


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeated(read_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated(read_table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(read_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("hits").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    folder = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    warc.write_archives(pages, folder)
    index = warc.build_index(warc.read_archives(spark, folder))
    found = warc.fetch(warc.lookup(index, pages.select(warc.url_key(warc.encoded(F.col("url"))).alias("key"))))
    return found.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, F.col("doc_id"), SHARDS).select("doc_id", "slot", "shard", "shard_name")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    flipped = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", flipped.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, scale=256)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))
    starts, base = F.col("places.at"), F.array_distinct(F.col("places.label"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "template_labels")), ",").alias("labels"),
        "score",
    )


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_pii": op3_pii,
    "op4_sentence_spans": op4_sentence_spans,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_decontaminate": op7_decontaminate,
    "op8_warc": op8_warc,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_license_scan": op13_license_scan,
}

ORACLES = {
    "op1_exact_dedup": r"""
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               coalesce(doc_id = min(doc_id) OVER (PARTITION BY norm), false) AS kept,
               sha256(norm) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
    """,
    "op7_decontaminate": r"""
        WITH cut AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
        item AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k + 1 : k + least(10, len(w))], ' ') AS phrase
                FROM item, LATERAL (SELECT unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS k) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT n FROM win),
        runs AS (SELECT doc_id, n, p, array_to_string(w[p + 1 : p + n], ' ') AS phrase
                 FROM cut, sizes, LATERAL (SELECT unnest(range(0, greatest(len(w) - n + 1, 0))) AS p)),
        hit AS (SELECT doc_id, p, win.n, item_id FROM runs JOIN win USING (n, phrase)),
        covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS pos FROM hit) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
        SELECT cut.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM cut LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op8_warc": """
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN top <> page_id THEN top END AS refers_to
        FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                     CASE WHEN strlen(coalesce(html, '')) >= 1000 THEN max(page_id) OVER (PARTITION BY coalesce(html, '')) ELSE page_id END AS top
              FROM pages)
    """,
}
