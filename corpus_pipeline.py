"""From raw documents to packed training sequences, one written stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm import decontamination, packing, quality, secrets, similar
from cardlake.llm.queries import TOKENIZER
from cardlake.llm.shared import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours of their text find good."""
    voters = quality.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, voters).where("predicted = 1").select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Runs of five words, a Jaccard likeness of 0.8 or more.
    """
    return similar.one_of_each(docs, width=5, percent=80)


def clean_of_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, items)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets blotted out of their texts."""
    spans = secrets.judged_spans(docs, repository=["source", "lang"], owner="source")
    rows = secrets.with_spans(docs, spans)
    text = secrets.redacted(F.coalesce("text", F.lit("")), F.col("secret_spans"))
    rows = rows.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per token piece with its place in a sequence."""
    # workers are used again by other stages, so they keep fewer words here
    found = packing.pieces(docs, TOKENIZER, remembered=300_000).withColumn("ids_crc32", F.crc32("ids"))
    return packing.packed(found.drop("ids"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", clean_of_tests),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: The classifier cannot be stated in SQL; tests hold the stages against plain forms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
