"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL oracles."""

from . import analytics, ingest_queries


def registry() -> dict:
    return {**analytics.QUERIES, **ingest_queries.QUERIES}


def oracle() -> dict:
    return {**analytics.SQL, **ingest_queries.SQL}
