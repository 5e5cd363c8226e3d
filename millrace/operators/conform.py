"""Conforming raw, all-string inputs to one typed transaction schema.

All steps are projections. Each function builds a single ``select`` from the
column names (metadata only, decided on the driver from the schema), so the
whole chain collapses into one Project inside the scan's codegen stage.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import to_type

# ---------------------------------------------------------------------------
# Fixed values (they must equal the reference's for the same results).
# Standard column -> accepted source names, as listed by the reference.
COLUMN_ALIASES = {
    "customer_id": ["custid", "customerid", "cust_id", "customer", "cust"],
    "transaction_amount": ["txnamt", "amount", "txn_amount", "transactionamt", "amt"],
    "transaction_timestamp": ["transaction_timestamp", "txn_time", "timestamp", "txn_timestamp", "time"],
    "quantity": ["qty", "quantity", "no_of_items", "count"],
    "transaction_id": ["transaction_id", "txn_id", "txnid", "id"],
    "product_id": ["product_id", "productid", "prod_id", "pid"],
    "country": ["country", "country_code", "location"],
    "status": ["status", "txn_status", "state"],
}

# Canonical typed schema, in output order.
EXPECTED_SCHEMA = [
    ("transaction_id", "string"),
    ("customer_id", "string"),
    ("transaction_amount", "double"),
    ("transaction_timestamp", "timestamp"),
    ("country", "string"),
    ("product_id", "string"),
    ("quantity", "int"),
    ("status", "string"),
]

# The first-generation job's fixed renames and casts.
V1_RENAMES = {"custid": "customer_id", "txnamt": "transaction_amount"}
V1_CASTS = {"transaction_amount": "double", "quantity": "int", "transaction_timestamp": "timestamp"}

BATCH_COLUMNS = ("batch_id", "process_date")
# ---------------------------------------------------------------------------

# Prefix of the optional per-column "value present but not convertible" flags.
FAIL_PREFIX = "__castfail_"
RESCUED = "__rescued"


class ConformError(ValueError):
    """A header that cannot be mapped unambiguously."""


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; names equal after lower-casing are an error."""
    lowered = [c.lower() for c in df.columns]
    dupes = sorted({c for c in lowered if lowered.count(c) > 1})
    if dupes:
        raise ConformError(f"Columns collide after lower-casing: {dupes}")
    return df.toDF(*lowered)


def rename_fixed(df: DataFrame, renames: dict = V1_RENAMES) -> DataFrame:
    """Apply fixed renames; a rename whose source is absent is skipped."""
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def resolve_aliases(columns: list, aliases: dict = COLUMN_ALIASES) -> dict:
    """Map standard name -> the one source column holding it (absent if none).

    The standard name itself always counts as a candidate. More than one
    present candidate is an error naming them all.
    """
    cols = set(columns)
    mapping = {}
    for std, names in aliases.items():
        candidates = [std] + [n for n in names if n != std]
        hits = [c for c in candidates if c in cols]
        if len(hits) > 1:
            raise ConformError(f"ambiguous header: {hits} all stand for {std}")
        if hits:
            mapping[std] = hits[0]
    return mapping


def conform(df: DataFrame, schema=EXPECTED_SCHEMA, aliases: dict = COLUMN_ALIASES,
            keep_extra: bool = True, flag_failures: bool = False, rescue: bool = False) -> DataFrame:
    """Lower-case names, map aliases, add missing columns as typed NULLs, and
    convert every expected column (bad values become NULL). Columns that map
    to no standard name are kept as they are (after the expected ones) unless
    ``keep_extra`` is false. One projection.

    ``flag_failures`` appends a boolean ``__castfail_<name>`` per converted
    column: a value was present but did not convert (it became NULL). The ingest
    job counts these with an Observation and drops them before writing.

    ``rescue`` appends ``__rescued``, a map from the name of every such column to the value
    as it came (empty where nothing failed)."""
    df = lowercase_columns(df)
    mapping = resolve_aliases(df.columns, aliases)
    used = set(mapping.values())
    exprs = []
    for name, dtype in schema:
        if name in mapping:
            exprs.append(to_type(F.col(f"`{mapping[name]}`"), dtype).alias(name))
        else:
            exprs.append(F.lit(None).cast(dtype).alias(name))
    std_names = {n for n, _ in schema}
    if keep_extra:
        exprs += [F.col(f"`{c}`") for c in df.columns if c not in used and c not in std_names]
    if flag_failures:
        for name, dtype in schema:
            if dtype != "string":
                raw = F.col(f"`{mapping[name]}`") if name in mapping else F.lit(None)
                exprs.append((raw.isNotNull() & to_type(raw, dtype).isNull()).alias(FAIL_PREFIX + name))
    if rescue:
        kept = [F.when(F.col(f"`{mapping[name]}`").isNotNull() & to_type(F.col(f"`{mapping[name]}`"), dtype).isNull(),
                       F.struct(F.lit(name).alias("key"), F.col(f"`{mapping[name]}`").alias("value")))
                for name, dtype in schema if dtype != "string" and name in mapping]
        entries = F.filter(F.array(*kept), lambda x: x.isNotNull()) if kept else None
        exprs.append((F.map_from_entries(entries) if kept else F.create_map().cast("map<string,string>")).alias(RESCUED))
    return df.select(*exprs)


def stamp_batch(df: DataFrame, batch_id: str, process_date) -> DataFrame:
    """Add the run's ``batch_id`` (string) and ``process_date`` (date)."""
    if isinstance(process_date, str):
        process_date = date.fromisoformat(process_date)
    return df.withColumns({"batch_id": F.lit(batch_id), "process_date": F.lit(process_date)})


def transform_v1(df: DataFrame, batch_id: str, process_date) -> DataFrame:
    """First-generation standardization: lower-case names, the two fixed
    renames, three conversions, batch stamps. Other columns pass through.
    A conversion whose column is missing fails (unresolved column)."""
    df = rename_fixed(lowercase_columns(df))
    df = df.withColumns({c: to_type(F.col(c), t) for c, t in V1_CASTS.items()})
    return stamp_batch(df, batch_id, process_date)


def transform_v2(df: DataFrame, batch_id: str, process_date, schema=EXPECTED_SCHEMA,
                 aliases: dict = COLUMN_ALIASES, flag_failures: bool = False, rescue: bool = False) -> DataFrame:
    """Second-generation standardization: alias mapping, expected schema with
    NULL padding and conversions, extra columns kept, batch stamps."""
    return stamp_batch(conform(df, schema, aliases, flag_failures=flag_failures, rescue=rescue),
                       batch_id, process_date)


def failure_flags(df: DataFrame) -> list:
    """The ``__castfail_*`` columns of a conformed DataFrame."""
    return [c for c in df.columns if c.startswith(FAIL_PREFIX)]
