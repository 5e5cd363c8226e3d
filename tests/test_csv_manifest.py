import datetime as dt
import os

from millrace.operators import conform, in_window, run_cutoff, select_new_files
from millrace.sources import group_by_header, list_files, read_csv_batch


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_mixed_headers_map_per_file(spark, workdir):
    write(f"{workdir}/a.csv", "id,custId,txnAmt\nT1,C1,1.5\nT2,C2,2.5\n")
    write(f"{workdir}/b.csv", "amount,id,customerid,extra\n9.5,T3,C3,zz\n")
    paths = [f"{workdir}/a.csv", f"{workdir}/b.csv"]
    assert len(group_by_header(spark, paths)) == 2
    out = read_csv_batch(spark, paths, per_header=conform)
    got = sorted((r.transaction_id, r.customer_id, r.transaction_amount, r.extra) for r in out.collect())
    assert got == [("T1", "C1", 1.5, None), ("T2", "C2", 2.5, None), ("T3", "C3", 9.5, "zz")]


def test_empty_fields_are_null_blanks_are_values(spark, workdir):
    write(f"{workdir}/c.csv", 'id,custid\nT1,\nT2,""\nT3,   \nT4,C4\n')
    out = read_csv_batch(spark, [f"{workdir}/c.csv"], per_header=conform)
    got = {r.transaction_id: r.customer_id for r in out.collect()}
    assert got["T1"] is None and got["T2"] is None and got["T4"] == "C4"
    assert got["T3"] is not None


def test_nothing_to_read(spark):
    assert read_csv_batch(spark, []) is None


def test_list_files(spark, workdir):
    write(f"{workdir}/top.dat", "12345")
    write(f"{workdir}/deep/er/low.dat", "1")
    flat = {r.path.rsplit("/", 1)[1]: r.length for r in list_files(spark, workdir, recursive=False).collect()}
    assert flat == {"top.dat": 5}
    assert list_files(spark, workdir).count() == 2
    assert list_files(spark, f"{workdir}/nowhere").columns == ["path", "modificationTime", "length"]
    assert list_files(spark, f"{workdir}/nowhere").isEmpty()


def _manifest(spark, rows):
    return spark.createDataFrame(rows, "path string, modificationTime timestamp")


def test_file_window(spark):
    stamps = [dt.datetime(2030, 6, d, h) for d in (1, 2, 3) for h in (0, 12)]
    m = _manifest(spark, [(f"f{i}", t) for i, t in enumerate(stamps)])
    got = select_new_files(m, "2030-06-01T11:59:59", "2030-06-02T12:00:00")
    assert sorted(r.path for r in got.collect()) == ["f1", "f2", "f3"]
    assert select_new_files(m.limit(0), "2030-06-01T00:00:00", "2030-06-04T00:00:00").isEmpty()


def test_file_window_bounds_and_first_run(spark):
    low, cut = dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 3)
    m = _manifest(spark, [("at_low", low), ("at_cutoff", cut), ("after", cut + dt.timedelta(seconds=1)),
                          ("old", dt.datetime(1999, 1, 1))])
    assert sorted(r.path for r in select_new_files(m, low, cut).collect()) == ["at_cutoff"]
    assert sorted(r.path for r in select_new_files(m, None, cut).collect()) == ["at_cutoff", "at_low", "old"]


def test_run_cutoff_is_last_completed_second():
    now = dt.datetime(2026, 4, 29, 8, 53, 8, 213460, tzinfo=dt.timezone.utc)
    assert run_cutoff(now) == dt.datetime(2026, 4, 29, 8, 53, 7, tzinfo=dt.timezone.utc)


def test_sniff_reads_first_nonempty_line_and_falls_back(spark, workdir):
    from millrace.sources.csv import _headers_by_spark, sniff_headers
    write(f"{workdir}/h1.csv", "\n\nx,y\n1,2\n")
    write(f"{workdir}/h2.csv", "﻿a,b\r\n1,2\r\n")
    write(f"{workdir}/empty.csv", "")
    heads = sniff_headers(spark, [f"{workdir}/h1.csv", f"{workdir}/h2.csv", f"{workdir}/empty.csv"])
    assert heads == {f"{workdir}/h1.csv": "x,y", f"{workdir}/h2.csv": "a,b"}
    by_spark = _headers_by_spark(spark, [f"{workdir}/h1.csv", f"{workdir}/h2.csv", f"{workdir}/empty.csv"])
    assert by_spark == {f"file:{workdir}/h1.csv": "x,y", f"file:{workdir}/h2.csv": "a,b"}


def test_sniff_distributed_for_many_files(spark, workdir, monkeypatch):
    import millrace.sources.csv as C
    monkeypatch.setattr(C, "FILES_PER_TASK", 2)
    paths = []
    for i in range(5):
        p = f"{workdir}/m{i}.csv"
        write(p, ("a,b\n" if i % 2 else "b,a\n") + "1,2\n")
        paths.append(p)
    heads = C.sniff_headers(spark, paths)
    assert heads == {p: ("a,b" if i % 2 else "b,a") for i, p in enumerate(paths)}
    assert len(C.group_by_header(spark, paths)) == 2


def test_header_schema_from_sniffed_line():
    from millrace.sources.csv import header_schema
    opts = {"header": "true", "mode": "PERMISSIVE"}
    assert [f.name for f in header_schema('id,"cust,id",amt', opts).fields] == ["id", "cust,id", "amt"]
    assert header_schema("a,,b", opts) is None            # empty name: let Spark name it
    assert header_schema("a,A", opts) is None             # case-insensitive duplicate
    assert header_schema("a;b", {**opts, "sep": ";"}).fieldNames() == ["a", "b"]
    assert header_schema("a,b", {**opts, "multiLine": "true"}) is None


def test_quoted_header_names_read_back(spark, workdir):
    write(f"{workdir}/q.csv", '"id","custId","extra col"\nT1,C1,x\n')
    out = read_csv_batch(spark, [f"{workdir}/q.csv"], per_header=conform)
    r = out.first()
    assert (r.transaction_id, r.customer_id, r["extra col"]) == ("T1", "C1", "x")


def test_batch_identity_formats():
    from millrace.operators import batch_identity
    utc = dt.timezone.utc
    assert batch_identity(dt.datetime(2026, 4, 29, 8, 53, 8, tzinfo=utc)) == ("batch_20260429_085308", "2026-04-29")
    assert batch_identity(dt.datetime(2026, 4, 29, 8, 53, 8, 200, tzinfo=utc))[0] == "batch_20260429_085308_000200"


def test_gzip_csv_headers_are_sniffed_decompressed(spark, workdir):
    import gzip
    with gzip.open(f"{workdir}/g.csv.gz", "wt") as f:
        f.write("id,custId,txnAmt\nT1,C1,1.5\n")
    write(f"{workdir}/p.csv", "amount,id,customerid\n2.5,T2,C2\n")
    out = read_csv_batch(spark, [f"{workdir}/g.csv.gz", f"{workdir}/p.csv"], per_header=conform)
    got = sorted((r.transaction_id, r.customer_id, r.transaction_amount) for r in out.collect())
    assert got == [("T1", "C1", 1.5), ("T2", "C2", 2.5)]
