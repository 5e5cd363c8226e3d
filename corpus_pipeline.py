"""Corpus pipeline: from raw documents to token ids.

``STAGES`` lists (name, function) in order. A function takes (spark, docs,
sf_dir) and returns a DataFrame; each result is written as Parquet in the
shared folder and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.

1. ``language``: rows without letters, or far from every learned language, go.
2. ``near_duplicates``: one document of each group of similar texts stays.
3. ``decontaminate``: documents that hold a benchmark item go.
4. ``personal_data``: found spans are replaced by their kind.
5. ``encode``: the texts as token ids, with both checks of the codec.

Every stage is defined for null and empty texts, repeated rows and empty
tables as its operator says; extra columns pass through stages 1 to 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import stages
from millrace.session import fresh_dir

STAGES = [
    ("language", stages.known_language),
    ("near_duplicates", stages.one_of_each_group),
    ("decontaminate", stages.without_benchmark),
    ("personal_data", stages.redacted),
    ("encode", stages.encoded),
]

#: SQL cannot express the language, alignment, weak-supervision and codec stages;
#: the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    root = fresh_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        stage(spark, docs, sf_dir).write.mode("errorifexists").parquet(path)
        docs = spark.read.parquet(path)
    return docs
