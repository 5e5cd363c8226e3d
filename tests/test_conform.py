import datetime as dt

import pytest

from millrace.operators import ConformError, conform, transform_v1, transform_v2
from millrace.operators.quality import quality_counts, split_by_key

# The header of the first generation of files.
COLUMNS = ["transaction_id", "custId", "txnAmt", "transaction_timestamp", "country",
           "product_id", "quantity", "status"]


def test_first_generation_renames_casts_and_stamps(spark):
    rows = [("S-1", "K7", "12.50", "2027-03-01T06:00:00Z", "NORWAY", "PX", "3", "OPEN"),
            ("S-2", "K8", "x", "never", None, None, None, None)]
    out = transform_v1(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS)), "b7", "2027-03-02")
    kinds = dict(out.dtypes)
    assert [kinds[c] for c in ("transaction_amount", "quantity", "transaction_timestamp", "process_date")] == \
        ["double", "int", "timestamp", "date"]
    one, two = sorted(out.collect(), key=lambda r: r.transaction_id)
    assert (one.customer_id, one.transaction_amount, one.quantity, one.batch_id) == ("K7", 12.5, 3, "b7")
    assert one.process_date == dt.date(2027, 3, 2)
    assert (two.transaction_amount, two.transaction_timestamp, two.quantity) == (None, None, None)


def test_alias_mapping_pads_and_keeps_extra(spark):
    df = spark.createDataFrame([("T1", "C1", "9.5", "zz")], ["TxnID", "CustomerID", "Amt", "extra"])
    out = transform_v2(df, "b", "2026-04-28")
    assert out.columns == ["transaction_id", "customer_id", "transaction_amount",
                           "transaction_timestamp", "country", "product_id", "quantity",
                           "status", "extra", "batch_id", "process_date"]
    r = out.first()
    assert (r.transaction_id, r.customer_id, r.transaction_amount, r.extra) == ("T1", "C1", 9.5, "zz")
    assert r.status is None and r.quantity is None
    assert dict(out.dtypes)["quantity"] == "int"


def test_standard_name_is_a_candidate_and_conflicts_fail(spark):
    ok = spark.createDataFrame([("C1", "1.0")], ["customer_id", "transaction_amount"])
    assert conform(ok).first().customer_id == "C1"
    bad = spark.createDataFrame([("C1", "C2")], ["customer_id", "custid"])
    with pytest.raises(ConformError, match="customer_id"):
        conform(bad)


def test_case_collision_fails(spark):
    df = spark.createDataFrame([("a", "b")], ["Status", "STATUS"])
    with pytest.raises(ConformError):
        conform(df)


def test_bad_values_and_quality_split(spark):
    rows = [("T1", "C1", "abc", "bad-ts", "", "2.5"), ("T2", None, "1.5", "2026-04-28T11:00:00Z", " 2 ", "x")]
    df = spark.createDataFrame(rows, ["id", "cust", "amount", "time", "qty", "state"])
    out = transform_v2(df, "b", "2026-04-28")
    r1, r2 = sorted(out.collect(), key=lambda r: r.transaction_id)
    assert r1.transaction_amount is None and r1.transaction_timestamp is None and r1.quantity is None
    assert r2.quantity == 2 and r2.transaction_timestamp == dt.datetime(2026, 4, 28, 11, 0)
    good, bad = split_by_key(out)
    assert [r.transaction_id for r in good.collect()] == ["T1"]
    assert [r.transaction_id for r in bad.collect()] == ["T2"]
    assert tuple(quality_counts(out).first()) == (2, 1, 1)
