"""Training-data pipeline: its stages in order, each a whole-table Spark job.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``docs``. A stage is judged on its own input and
its decisions take effect: what it drops or cuts is gone for the next.

The stages set the session's ``spark.sql.execution.arrow.maxBytesPerBatch`` to
``BATCH_BYTES`` (and leave it so, as their results are computed later): a task
holds a batch several times over, in the JVM and in Python. A single longer text is
a batch of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrbars.llm import jaccard, langid, packing, quality, substring_words

#: Least mean probability of the language found.
LANGUAGE_SCORE = 0.5
#: Bytes of rows that go to Python at once.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters (null and empty texts too) and those of no clear language."""
    bound_batches(spark)
    found = langid.identify(docs)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LANGUAGE_SCORE)).select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents predicted to be of low quality."""
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels).where("predicted = 1").select("row.*")


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies keep the document with the smallest id."""
    bound_batches(spark)
    return jaccard.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that a document with a smaller id also has."""
    bound_batches(spark)
    return substring_words.deduplicate(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents left into sequences of the permitted lengths."""
    bound_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Two stages are trained models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = jaccard.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
