"""The registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolith.llm import (
    chat, codes, licences, mixing, negatives, neighbours, oracles, packing, pii, quality, simhash, toxicity, urls, warc,
)
from aerolith.llm.common import table
from aerolith.llm.vectors import whole_vectors

TOKENIZER = "word_bpe_49k.json"
LISTED_LABELS = 10


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)



def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.flag_toxic(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_snapshots(table(spark, sf_dir, "conversations"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.filter_captures(fetched(pages), dated_entries(pages))


def fetched(pages: DataFrame) -> DataFrame:
    """The table has no fetch time: pages are taken as fetched one a day over two years, in turn."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(730)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetch_date"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """Lists made from the pages' own hosts and their parents, as the tables hold none.

    The digits of a key's MD5 decide whether it is listed, where, and when it comes, goes and comes
    back, so the lists grow with the hosts. No listed name has more than `LISTED_LABELS` labels.
    """
    hosts = pages.select(urls.host_of(F.col("url")).alias("host")).distinct()
    keys = hosts.filter("host IS NOT NULL").select(F.explode(urls.keys_of(F.col("host"), LISTED_LABELS)).alias("key"))
    digits = lambda at, n: F.conv(F.substring("md5", at, n), 16, 10).cast("int")
    listed = keys.distinct().withColumn("md5", F.md5("key")).filter(digits(1, 1) < 8)
    first = digits(2, 3) % 600
    entry = lambda day, action: F.struct(day.alias("offset"), F.lit(action).alias("action"))
    entries = F.array(
        entry(first, urls.ADD),
        entry(first + 20 + digits(5, 2), urls.REMOVE),
        entry(first + 300 + digits(7, 2), urls.ADD),
    )
    names = F.array(F.lit("malware"), F.lit("spam"), F.lit("adult"))
    return listed.select(
        F.get(names, digits(9, 2) % 3).alias("list"),
        F.when(digits(11, 1) < 6, urls.HOST).otherwise(urls.DOMAIN).alias("scope"),
        "key",
        F.inline(entries),
    ).select(
        "list", "scope", "key", "action",
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("offset")).alias("day"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = simhash.fingerprint_text(F.col("fp")).alias("fingerprint")
    return classes.select("doc_id", fingerprint, "component_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return report.drop("n_lines", "n_capitals")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some labels are moved on by one first, as mislabelled rows are."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.hard_negatives(whole_vectors(vectors, "label"), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_chat_snapshots": op1_chat_snapshots,
    "op2_warc_index": op2_warc_index,
    "op3_simhash": op3_simhash,
    "op4_mixing": op4_mixing,
    "op5_url_filters": op5_url_filters,
    "op6_packing": op6_packing,
    "op7_neighbours": op7_neighbours,
    "op8_licences": op8_licences,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_personal_data": op11_personal_data,
    "op12_vector_codes": op12_vector_codes,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES = {
    "op1_chat_snapshots": oracles.CHAT,
    "op5_url_filters": oracles.URLS,
    "op2_warc_index": oracles.WARC,
    "op4_mixing": oracles.MIXING,
    "op12_vector_codes": oracles.CODES,
    "op13_hard_negatives": oracles.NEGATIVES,
}
