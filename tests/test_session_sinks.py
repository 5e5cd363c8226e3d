import datetime as dt
import os

from millrace.operators import select_new_files, transform_v2
from millrace.session import fresh_dir, shared_root
from millrace.sinks.ledger import read_control
from millrace.sinks import quarantine_path, recorded_schema, write_curated, write_quarantine
from millrace.sources import read_curated


def test_shared_folder_comes_from_the_session(spark):
    root = shared_root(spark)
    assert root == (spark.conf.get("spark.checkpoint.dir", None) or root)
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b and a.startswith(root)


def test_schema_is_recorded_once_per_change(spark, workdir):
    target = f"{workdir}/t"
    one = spark.createDataFrame([("T1", "C1")], ["id", "cust"])
    for i in range(2):
        write_curated(transform_v2(one, f"b{i}", "2026-04-28"), target)
    assert read_control(spark, f"{target}_schema", "schema string, at timestamp").count() == 1
    write_curated(transform_v2(one.selectExpr("*", "1 as more"), "b3", "2026-04-29"), target)
    assert read_control(spark, f"{target}_schema", "schema string, at timestamp").count() == 2
    assert "more" in recorded_schema(spark, target).names
    got = read_curated(spark, target)
    assert got.where("more is null").count() == 2 and got.count() == 3


def test_quarantine_beside_the_table_keeps_it_readable(spark, workdir):
    raw = spark.createDataFrame([("T1", "C1"), ("T2", None)], ["id", "cust"])
    df = transform_v2(raw, "b1", "2026-04-28")
    target = f"{workdir}/curated"
    write_curated(df.where("customer_id is not null"), target)
    path = write_quarantine(df.where("customer_id is null"), target)
    assert path == quarantine_path(target) and not path.startswith(target + "/")
    assert read_curated(spark, target).count() == 1
    assert read_curated(spark, path).count() == 1
    assert sorted(os.listdir(workdir)) == ["curated", "curated_bad_records", "curated_bad_records_schema",
                                           "curated_schema"]


def test_window_bounds_accept_iso_strings_with_offsets(spark):
    m = spark.createDataFrame([("a", dt.datetime(2026, 4, 29, 8, 53, 8))],
                              "path string, modificationTime timestamp")
    # 08:53:08Z is inside (08:00Z, 10:53:08+02:00] = (08:00Z, 08:53:08Z]
    assert select_new_files(m, "2026-04-29T08:00:00Z", "2026-04-29T10:53:08+02:00").count() == 1
    assert select_new_files(m, "2026-04-29T10:53:08+02:00", "2026-04-30T00:00:00Z").count() == 0


def test_manifest_landing_is_written_without_sorting(spark, workdir, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from millrace.plans.ingest_queries import q_ingest_manifest
    rows = [(k, k % 7 if k % 5 else None, "OFP"[k % 3], 1.5 * k, None if k == 9 else "1-URGENT") for k in range(300)]
    (spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                 "o_orderpriority string")
     .selectExpr("*", "timestamp_ntz '1998-01-02 00:00:00' as o_orderdate").write.parquet(f"{workdir}/orders.parquet"))
    name, seen, csv = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.csv

    def noted(self, *a, **k):
        seen.append(int(spark.conf.get(name)))
        return csv(self, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "csv", noted)
    before = spark.conf.get(name)
    got = {(r.folder, r.hidden): r.files for r in q_ingest_manifest(spark, workdir).collect()}
    digit = lambda c, s: "__HIVE_DEFAULT_PARTITION__" if c is None or s == "P" else c % 10      # noqa: E731
    assert got == {(f"{'_kept' if s == 'O' else 'seen'}/state={s}/digit={digit(c, s)}", s == "O"): 1
                   for _, c, s, _, _ in rows}
    assert seen and min(seen) > 0 and spark.conf.get(name) == before
