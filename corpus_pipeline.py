"""A corpus pipeline: five stages over the documents, each written and read again before the next.

Quality filter, line dedup, near duplicates, benchmark decontamination, packing. `SQL` can't express
these stages; tests/llm compare them with brute force on small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dnsight.llm import decontamination, jaccard, line_dedup, packing, quality
from dnsight.llm.tokens import default_tokenizer
from dnsight.sources.storage import scratch, stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1; it learns from the labelled ones among them.

    Null and empty texts are scored like others, repeated rows each; a score at the threshold is kept; an empty
    table stays empty. Columns may have any further names, but none that begins with two underscores.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own = [F.col(f"`{c}`").alias(f"__column{k}") for k, c in enumerate(docs.columns)]
    scored = quality.score(docs.select(*own, "text"), model, [f"__column{k}" for k in range(len(own))])
    return scored.filter("predicted = 1").drop("score", "predicted").toDF(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; n_chars is counted anew, a document with nothing left goes."""
    lean = line_dedup.dedup_lines(docs.withColumn("__full", F.coalesce(F.length(F.trim("text")), F.lit(0)) > 0))
    emptied = F.col("__full") & (F.length(F.trim("text")) == 0)
    return (
        lean.filter(~emptied)
        .withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
        .select(*docs.columns)
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a number `__row` for each row, to be stored, so that it is the same in every use."""
    return docs.withColumn("__row", F.monotonically_increasing_id())


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest id; one without an id only if none has one.

    Repeated rows are near duplicates like others. Texts without a word link with nothing, so their rows stay.
    """
    with scratch(spark) as keep:
        keyed = keep(_keyed(docs))
        # As ids of the operator, these make the first row of a group its component's id.
        place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__row").alias("row"))
        classes = jaccard.near_duplicates(keyed.select(place.alias("doc_id"), "text"))
        kept = keep(classes.filter("doc_id.row = component_id.row").select(F.col("doc_id.row").alias("__row")))
    return keyed.join(kept, "__row", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that benchmark passages don't contaminate, whatever their ids; each is judged by its own text.

    Only the hashes of contaminated texts are stored; without a text a row is clean.
    """
    own = F.xxhash64(F.col("text").cast("string"))
    with scratch(spark) as keep:
        rows = docs.filter("text is not null").select(own.alias("doc_id"), "text")
        found = decontamination.contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
        bad = keep(found.filter("contaminated").select(F.col("doc_id").alias("__own")).distinct())
    return docs.withColumn("__own", own).join(bad, "__own", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their sequences.

    Null and empty texts are a piece of one token; repeated rows are packed each; no documents, no pieces;
    columns but `doc_id` and `text` are left out, whatever their names.
    """
    return packing.pack(docs, default_tokenizer())


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
