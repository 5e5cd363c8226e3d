"""The operators as stages of a corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Filters and rewrites are narrow passes that carry all columns of ``docs``; only
the near-duplicate stage shuffles. Row order is not kept. Every stage limits the
bytes of the session's Arrow batches (``small_batches``).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, ngram_join, personal_data, rank_profiles, sentencepiece_codec
from ._batches import slices, small_batches

#: A text whose nearest language profile scores less is none of the learned languages.
LEAST_LANGUAGE_SCORE = 0.3


def _column(b: pa.RecordBatch, name: str) -> int:
    names = b.schema.names
    return names.index(name) if name in names else [n.lower() for n in names].index(name.lower())


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of a learned language; a null ``lang`` gets the predicted one.

    Rejected: null or empty text, text without letters, text far from every
    profile. If no language can be learned (no row has a lang), all rows go.
    """
    small_batches(spark)
    profiles = rank_profiles.fit_profiles(docs)

    def run(batches):
        for b in slices(batches):
            texts = [t or "" for t in b.column(_column(b, "text")).to_pylist()]
            found = rank_profiles.predict_texts(texts, profiles)
            at = _column(b, "lang")
            lang = [x if x is not None else f[0] for x, f in zip(b.column(at).to_pylist(), found)]
            cols = list(b.columns)
            cols[at] = pa.array(lang, pa.string())
            keep = [f[0] != rank_profiles.UNKNOWN and f[1] >= LEAST_LANGUAGE_SCORE for f in found]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names).filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of similar texts.

    Rows that share an id stand or fall together; identical rows of one id, or of
    no id, are reduced to one.
    """
    small_batches(spark)
    linked = ngram_join.link_components(spark, docs)
    keep = (linked.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("kept_id")).distinct())
    held = docs.join(keep, docs["doc_id"].eqNullSafe(keep["kept_id"]), "left_semi")
    return held.dropDuplicates(["doc_id", "text"])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` is found."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text.

    A null text stays null.
    """
    small_batches(spark)
    model = personal_data.fit_model(docs)

    def run(batches):
        for b in slices(batches):
            at, cols = _column(b, "text"), list(b.columns)
            text = [t if t is None else personal_data.redact_text(t, model) for t in b.column(at).to_pylist()]
            cols[at] = pa.array(text, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)
    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, parity, round_trip of every document."""
    small_batches(spark)
    ids = sentencepiece_codec.encode_documents(docs)
    return ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "parity", "round_trip")
