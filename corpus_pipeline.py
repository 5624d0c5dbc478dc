"""A cleaning pipeline over ``documents``: toxicity, line dedup, near duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir), where docs is all that the stage before kept, and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage as Parquet to the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitspark.llm.bpe import encode_digests
from pitspark.llm.common import stored, table
from pitspark.llm.decontaminate import drop_contaminated
from pitspark.llm.jaccard import one_of_each
from pitspark.llm.line_dedup import dedup_lines
from pitspark.llm.toxicity import judge


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not hold for toxic."""
    return judge(docs, table(spark, sf_dir, "labels"), restored=False).filter("score < 0.5").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines; one of which nothing remains is left out.  n_chars follows the text."""
    out = dedup_lines(docs).filter("n_removed = 0 or n_removed < n_lines")
    out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    import public_tokenizers

    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The classifier and the search are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
