"""Corpus pipeline: from raw documents to a mix for training.

``STAGES`` run in order; each takes all rows its predecessor kept, its result is written as Parquet
and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm.common import remove_path, table
from gridstats.llm.decontaminate import decontaminate
from gridstats.llm.mixing import mix_rows
from gridstats.llm.pii import sanitise
from gridstats.llm.simhash import keep_first
from gridstats.llm.toxicity import score_toxicity, train_on
from gridstats.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = train_on(docs, table(spark, folder, "labels"))
    scored = score_toxicity(docs.select(*COLUMNS), model, keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return keep_first(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a share of benchmark passages."""
    judged = decontaminate(docs, table(spark, folder, "benchmark"), keep=COLUMNS)
    return judged.where("NOT contaminated").select(*COLUMNS)


def remove_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data generalised, terms that give it away removed; ``n_chars`` follows the text."""
    clean = sanitise(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents the mix takes, with their size, their source's target and the words taken."""
    return mix_rows(docs.select(*COLUMNS)).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal data", remove_personal_data),
    ("mixing", mix_sources),
]

# The classifier and the fingerprints cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs, before = table(spark, folder, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{number}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_path(spark, before)
        before = path
    return docs
