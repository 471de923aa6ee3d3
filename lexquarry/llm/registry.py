"""Queries of this subpackage, by the names under which they are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry.llm import oracles
from lexquarry.llm.decontaminate import contamination
from lexquarry.llm.fill_middle import digests, fill_in_middle
from lexquarry.llm.hard_negatives import mine, quantised
from lexquarry.llm.jaccard_join import similar_documents
from lexquarry.llm.language_id import identify_corpus
from lexquarry.llm.line_dedup import remove_repeated_passages
from lexquarry.llm.lm_score import score_documents
from lexquarry.llm.mixing import mixture
from lexquarry.llm.quality_classifier import classify_documents
from lexquarry.llm.quality_rules import judge
from lexquarry.llm.secrets import find_secrets
from lexquarry.llm.shard import assign_shards
from lexquarry.llm.warc import read_archives, write_archives
from lexquarry.scratch import new_path, save


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents")).drop("key", "component")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_corpus(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("key")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(_table(spark, sf_dir, "documents"))


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """op11 of a table of vectors: labels of ids divisible by 7 are moved on first, and ids divisible by 100 are anchors."""
    own = vectors.select("vec_id", quantised("embedding").alias("v"), F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return mine(own, F.col("vec_id") % 100 == 0, vector="v")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def archived_pages(pages: DataFrame) -> DataFrame:
    """op12 of a table of pages: archives are written to the shared folder and read back."""
    folder = new_path(pages.sparkSession, "warc")
    write_archives(pages, folder, "page_id", "url", "html")
    records = read_archives(pages.sparkSession, folder, payloads=False)
    return save(records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id", "archive", "offset"), "records")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(_table(spark, sf_dir, "pages")).drop("url", "record_id", "archive", "offset")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(fill_in_middle(_table(spark, sf_dir, "documents")))


# ---- what SQL can check of the operators' results ----------------------------


def lm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1 without the model's score; base scores to four places, as sums differ by their order."""
    return op1_lm_scoring(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def ngram_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2's contract."""
    return op2_ngram_jaccard_join(spark, sf_dir).select("doc_id", "n_shingles", "component_id")


def shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5's rows without their places."""
    return op5_sharding(spark, sf_dir).select("doc_id", "size", "law")


def shard_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5 promises of its shards: whole, gapless, nearly equal, and equal texts side by side but where a shard ends."""
    rows = op5_sharding(spark, sf_dir)
    largest = rows.agg(F.max("size").alias("largest"))
    shards = rows.groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("slot").alias("last"), F.min("slot").alias("first"), F.count_distinct("slot").alias("slots"))
    groups = rows.groupBy("text_crc32", "size").agg(F.count_distinct("shard").alias("parts"), F.sum("size").alias("group_bytes"))
    total = shards.agg(F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"), F.count("*").alias("shards"), F.bool_and((F.col("first") == 0) & (F.col("last") == F.col("n") - 1) & (F.col("slots") == F.col("n"))).alias("gapless"), F.max("bytes").alias("most"), F.min("bytes").alias("least"))
    together = groups.crossJoin(total.select(F.col("bytes").alias("all_bytes"))).agg(F.bool_and(F.col("parts") <= 2 + F.col("group_bytes") * 24 / F.col("all_bytes")).alias("groups_together"))
    one = total.crossJoin(largest).crossJoin(together)  # one row each
    return one.select("rows", "bytes", "shards", "gapless", (F.col("most") - F.col("least") <= 2 * F.col("largest")).alias("near_equal"), "groups_together")


def rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6 without the votes and what follows from them."""
    return op6_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's base kinds."""
    return op9_secret_scan(spark, sf_dir).drop("spans")


_OPERATORS = (
    op1_lm_scoring, op2_ngram_jaccard_join, op3_language_id, op4_decontamination, op5_sharding, op6_quality_rules, op7_source_mixing,
    op8_quality_classifier, op9_secret_scan, op10_line_dedup, op11_hard_negatives, op12_warc, op13_fill_middle,
)
_CHECKED = (lm_base, ngram_components, shard_sizes, shard_totals, rules_base, secrets_base)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (*_OPERATORS, *_CHECKED)}


#: Words, then all windows of the sizes that items need, joined by their words.
_OP4 = r"""
WITH lowered AS (
  SELECT 'd' AS side, doc_id::VARCHAR AS id, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL SELECT 'b', item_id::VARCHAR, NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (SELECT side, id, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
sizes AS (SELECT DISTINCT least(len(w), 13) AS k FROM words WHERE side = 'b' AND len(w) > 0),
items AS (SELECT DISTINCT id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (
  SELECT id, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM words WHERE side = 'b' AND len(w) > 0)),
windows AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, sizes WHERE side = 'd' AND len(w) >= k)),
hits AS (SELECT doc_id, i, windows.k, items.id FROM windows JOIN items ON windows.win = items.win AND windows.k = items.k),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, id FROM hits) GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, (coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w)) AS contaminated
FROM words LEFT JOIN covered ON words.doc_id = covered.doc_id LEFT JOIN named ON words.doc_id = named.doc_id WHERE side = 'd'"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontamination": _OP4,
        "op11_hard_negatives": oracles.HARD_NEGATIVES,
        "op12_warc": oracles.WARC,
        "op13_fill_middle": oracles.FILL_MIDDLE,
        "lm_base": oracles.LM_BASE,
        "ngram_components": oracles.COMPONENTS,
        "shard_sizes": oracles.SIZES,
        "shard_totals": oracles.SHARDS,
        "rules_base": oracles.RULES_BASE,
        "secrets_base": oracles.SECRETS_BASE,
    }
