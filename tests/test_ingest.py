import datetime as dt
import os
import time

import pytest

from millrace.plans.ingest import IngestConfig, run_batch
from millrace.sinks import ledger as L
from millrace.sinks.tables import quarantine_path
from millrace.sources import read_curated
from millrace.streaming.ingest_stream import drain

HEADER = "transaction_id,custId,txnAmt,transaction_timestamp,country,product_id,quantity,status\n"
TXN_1 = HEADER + (
    "S-1,K7,12.50,2027-03-01T06:00:00Z,NORWAY,PX,1,OPEN\n"
    "S-2,K8,0.75,2027-03-01T06:30:00Z,CHILE,PY,4,OPEN\n"
    "S-1,K7,12.50,2027-03-01T06:00:00Z,NORWAY,PX,1,OPEN\n"
    "S-3,K9,88.00,2027-03-01T07:00:00Z,CHILE,PZ,2,PAID\n")
TXN_2 = HEADER + (
    "S-4,K7,3.25,2027-03-02T05:00:00Z,NORWAY,PX,1,PAID\n"
    "S-5,,9.99,2027-03-02T05:10:00Z,NORWAY,PY,1,PAID\n")
TXN_ALIASED = "Qty,TxnID,Customer,Amount,Channel\n4,S-6,K10,10.5,web\nx,S-7,,n/a,web\n"


def land(folder, name, text, mtime):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write(text)
    ts = mtime.timestamp()
    os.utime(p, (ts, ts))
    return p


def cfg_for(workdir, **kw):
    return IngestConfig(landing=f"{workdir}/landing", target=f"{workdir}/curated",
                        control=f"{workdir}/control", **kw)


T0 = dt.datetime(2026, 4, 28, 12, 0, tzinfo=dt.timezone.utc)


def test_incremental_runs(spark, workdir):
    cfg = cfg_for(workdir, replay_safe=False)       # plain append layout
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    land(cfg.landing, "txn_2.csv", TXN_2, T0 + dt.timedelta(minutes=1))
    r1 = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert r1["status"] == "SUCCESS" and r1["records_processed"] == 5 and r1["bad_records"] == 1
    assert r1["batch_id"] == "batch_20260428_130000"
    assert r1["cast_failures"] == {"transaction_amount": 0, "transaction_timestamp": 0, "quantity": 0}
    table = read_curated(spark, cfg.target)
    assert table.count() == 5   # the exact duplicate S-1 is kept
    assert sorted(d for d in os.listdir(cfg.target) if d[0] not in "_.") == ["process_date=2026-04-28"]
    assert all(not d.startswith("batch_id=")
               for d in os.listdir(f"{cfg.target}/process_date=2026-04-28"))
    assert dict(table.dtypes)["process_date"] == "date"
    bad = read_curated(spark, quarantine_path(cfg.target)).collect()
    assert [r.transaction_id for r in bad] == ["S-5"]
    # Nothing new.
    r2 = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=2))
    assert r2["status"] == "NO_FILES"
    # A new file with another header, landing after the watermark.
    land(cfg.landing, "txn_3.csv", TXN_ALIASED, T0 + dt.timedelta(hours=2, minutes=30))
    land(cfg.landing, "late.csv", TXN_2, T0 - dt.timedelta(days=1))  # older than the watermark: not lost
    r3 = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=3))
    assert r3["files"] == [f"file:{cfg.landing}/late.csv", f"file:{cfg.landing}/txn_3.csv"]
    assert r3["records_processed"] == 2 and r3["bad_records"] == 2 and r3["cast_failures"]["quantity"] == 1
    assert r3["cast_failures"]["transaction_amount"] == 1
    table = read_curated(spark, cfg.target)
    assert table.count() == 7
    new = table.where("transaction_id = 'S-6'").first()
    assert (new.customer_id, new.quantity, new.channel) == ("K10", 4, "web")
    assert L.current_watermark(spark, cfg.control) == T0 + dt.timedelta(hours=3)
    states = {r.batch_id: r.status for r in L.batch_states(spark, cfg.control).collect()}
    assert sorted(states.values()) == ["NO_FILES", "SUCCESS", "SUCCESS"]
    assert L.latest_batch(spark, cfg.control).first().batch_id == r3["batch_id"]


def test_failure_is_recorded_whole_and_replayed(spark, workdir, monkeypatch):
    import millrace.plans.ingest as I
    cfg = cfg_for(workdir)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)

    def broken(*a, **k):
        raise OSError("disk " + "x" * 9000)
    with monkeypatch.context() as m:
        m.setattr(I, "write_curated", broken)
        with pytest.raises(OSError):
            run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    latest = L.latest_batch(spark, cfg.control).first()
    assert latest.status == "FAILED" and latest.error_message == "OSError: disk " + "x" * 9000
    assert L.current_watermark(spark, cfg.control) is None   # not advanced
    r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=5))     # the same batch again
    assert r["status"] == "SUCCESS" and r["batch_id"] == latest.batch_id
    assert read_curated(spark, cfg.target).count() == 4
    assert L.current_watermark(spark, cfg.control) == T0 + dt.timedelta(hours=1)


def test_bad_files_are_rejected_one_by_one(spark, workdir):
    from millrace.plans.ingest import plan_batch, process_batch
    cfg = cfg_for(workdir)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    land(cfg.landing, "clash.csv", "customer_id,custid\nC1,C2\n", T0)
    gone = land(cfg.landing, "gone.csv", TXN_2, T0)
    planned = plan_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    os.rename(gone, f"{workdir}/elsewhere.csv")
    r = process_batch(spark, cfg, planned)
    assert (r["status"], r["records_processed"], r["rejected_files"], r["n_files"]) == ("SUCCESS", 4, 2, 3)
    why = {x.path.rsplit("/", 1)[1]: x.error
           for x in L.file_rows(spark, cfg.control).where("state = 'REJECTED'").collect()}
    assert set(why) == {"clash.csv", "gone.csv"} and "customer_id" in why["clash.csv"]
    land(cfg.landing, "txn_2.csv", TXN_2, T0 + dt.timedelta(minutes=1))   # later files are not held up
    assert run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=2))["records_processed"] == 1


def test_abandon_and_release(spark, workdir):
    from millrace.plans.ingest import plan_batch
    cfg = cfg_for(workdir)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    first = plan_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    L.abandon_batch(spark, cfg.control, first["batch_id"], release=True)
    again = plan_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert again["files"] == first["files"] and again["batch_id"] != first["batch_id"]
    L.abandon_batch(spark, cfg.control, again["batch_id"], "broken producer")
    assert L.current_watermark(spark, cfg.control) is None
    assert run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))["status"] == "NO_FILES"
    states = {r.batch_id: r.status for r in L.batch_states(spark, cfg.control).collect()}
    assert sorted(states.values()) == ["ABANDONED", "NO_FILES", "RELEASED"]


def test_equal_cutoffs_never_hide_a_success(spark, workdir):
    cfg = cfg_for(workdir)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    runs = [run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1)) for _ in range(3)]
    assert [r["status"] for r in runs] == ["SUCCESS", "NO_FILES", "NO_FILES"]
    assert len({r["batch_id"] for r in runs}) == 3
    assert L.latest_batch(spark, cfg.control).first().status == "SUCCESS"
    assert sorted(r.status for r in L.batch_states(spark, cfg.control).collect()) == ["NO_FILES", "NO_FILES", "SUCCESS"]


@pytest.mark.parametrize("name", ["txn 1.csv", "txn[1].csv", "100%25.csv", "a{b}c.csv", "q?.csv", "star*.csv",
                                  "hash#1.csv", "plus+1.csv", "ünï.csv", "B.CSV", "c.txt", "noext", "x=1/y.csv"])
def test_awkward_names_with_quarantine(spark, workdir, name):
    cfg = cfg_for(workdir)
    land(os.path.dirname(f"{cfg.landing}/{name}"), os.path.basename(name), "\n\n" + TXN_2, T0)
    r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert (r["records_processed"], r["bad_records"], r["n_files"]) == (1, 1, 1)
    assert [x.transaction_id for x in read_curated(spark, quarantine_path(cfg.target)).collect()] == ["S-5"]


def test_hidden_names_are_recorded(spark, workdir):
    cfg = cfg_for(workdir)
    for name in ("a.csv", "_d.csv", ".e.csv", "_SUCCESS", ".a.csv.crc"):
        land(cfg.landing, name, TXN_1, T0)
    r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert (r["n_files"], r["hidden_files"]) == (1, 2)
    hidden = L.file_rows(spark, cfg.control).where("state = 'HIDDEN'").collect()
    assert sorted(x.path.rsplit("/", 1)[1] for x in hidden) == [".e.csv", "_d.csv"]
    assert run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=2))["hidden_files"] == 0


def test_long_headers_are_never_cut(spark, workdir):
    cfg = cfg_for(workdir)
    wide = HEADER.strip() + "," + ",".join(f"extra_column_number_{i:05d}" for i in range(4000)) + "\n"
    row = "S-1,K7,12.50,2027-03-01T06:00:00Z,NORWAY,PX,1,OPEN" + ",z" * 4000 + "\n"
    land(cfg.landing, "wide.csv", "\n" * 70_000 + wide + row, T0)
    r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    table = read_curated(spark, cfg.target)
    assert r["records_processed"] == 1 and len(table.columns) == 4010
    assert table.select("extra_column_number_03999").first()[0] == "z"


def test_all_bad_batch_leaves_a_readable_table(spark, workdir):
    cfg = cfg_for(workdir)
    land(cfg.landing, "bad.csv", HEADER + "S-9,,1,2027-03-02T05:10:00Z,X,P,1,S\n", T0)
    r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert (r["status"], r["bad_records"]) == ("SUCCESS", 1)
    table = read_curated(spark, cfg.target)
    assert table.count() == 0 and dict(table.dtypes)["transaction_amount"] == "double"
    land(cfg.landing, "good.csv", TXN_1, T0 + dt.timedelta(minutes=1))
    run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=2))
    assert read_curated(spark, cfg.target).count() == 4


def test_thousands_of_files_in_bounded_batches(spark, workdir):
    from millrace.plans.ingest import run_until_drained
    cfg = cfg_for(workdir, max_files=1500)
    for i in range(2600):
        land(f"{cfg.landing}/{i % 7}", f"f{i}.csv", f"id,custId\nT{i},C{i}\n", T0 + dt.timedelta(seconds=i // 900))
    done = run_until_drained(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert [r["n_files"] for r in done] == [1500, 1100, 0]
    assert read_curated(spark, cfg.target).select("transaction_id").distinct().count() == 2600
    assert "files" not in L.ledger_rows(spark, cfg.control).columns      # no path list in the ledger


def test_replay_safe_rewrite_does_not_duplicate(spark, workdir):
    from millrace.plans.ingest import ingest_files
    cfg = cfg_for(workdir, replay_safe=True)
    p = land(cfg.landing, "txn_1.csv", TXN_1, T0)
    for _ in range(2):
        ingest_files(spark, [p], "batch_x", "2026-04-28", cfg)
    ingest_files(spark, [p], "batch_y", "2026-04-28", cfg)
    assert read_curated(spark, cfg.target).count() == 8


def test_v1_job_has_no_split(spark, workdir):
    cfg = cfg_for(workdir, version="v1")
    land(cfg.landing, "txn_2.csv", TXN_2, T0)
    r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert r["records_processed"] == 2
    assert read_curated(spark, cfg.target).count() == 2


def test_stream_takes_old_files(spark, workdir):
    cfg = cfg_for(workdir)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    drain(spark, cfg)
    land(cfg.landing, "old.csv", TXN_2, T0 - dt.timedelta(days=30))
    drain(spark, cfg)
    assert read_curated(spark, cfg.target).count() == 5


def test_stream_drains_each_file_once(spark, workdir):
    cfg = cfg_for(workdir, replay_safe=True)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    drain(spark, cfg)
    drain(spark, cfg)
    assert read_curated(spark, cfg.target).count() == 4
    land(cfg.landing, "txn_2.csv", TXN_2, T0)
    drain(spark, cfg)
    assert read_curated(spark, cfg.target).count() == 5
    assert read_curated(spark, quarantine_path(cfg.target)).count() == 1


def test_plan_and_process_as_two_jobs(spark, workdir):
    from millrace.plans.ingest import plan_batch, process_batch
    cfg = cfg_for(workdir)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    planned = plan_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert planned["status"] == "PLANNED" and len(planned["files"]) == 1
    # Planning again before processing returns the same batch.
    again = plan_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=2))
    assert again["batch_id"] == planned["batch_id"]
    assert L.current_watermark(spark, cfg.control) is None
    done = process_batch(spark, cfg)        # picks the pending batch from the ledger
    assert done["status"] == "SUCCESS" and done["records_processed"] == 4
    assert L.current_watermark(spark, cfg.control) == T0 + dt.timedelta(hours=1)
    assert process_batch(spark, cfg)["status"] == "SUCCESS"   # nothing pending: latest state


def test_replayed_batch_replaces_its_quarantine(spark, workdir):
    from millrace.plans.ingest import ingest_files
    cfg = cfg_for(workdir, replay_safe=True)
    p = land(cfg.landing, "txn_2.csv", TXN_2, T0)
    for _ in range(2):
        ingest_files(spark, [p], "batch_q", "2026-04-28", cfg)
    assert read_curated(spark, cfg.target).count() == 1
    assert read_curated(spark, quarantine_path(cfg.target)).count() == 1


def test_stream_batch_identity_comes_from_files(spark, workdir):
    cfg = cfg_for(workdir, replay_safe=True)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    drain(spark, cfg)
    row = L.latest_batch(spark, cfg.control).first()
    assert row.process_date == T0.date() and row.watermark_ts.astimezone(dt.timezone.utc) == T0


def test_day_folder_listing_only_touches_recent_days(spark, workdir):
    from millrace.operators.incremental import day_folders_glob
    g = day_folders_glob("/l", "%Y/%m/%d", T0, T0 + dt.timedelta(days=1))
    assert g == "/l/{2026/04/27,2026/04/28,2026/04/29}"
    assert day_folders_glob("/l", "%Y/%m/%d", None, T0) == "/l"
    assert day_folders_glob("/l", "%Y/%m/%d", T0, T0, 2) == "/l/{2026/04/26,2026/04/27,2026/04/28}"
    cfg = cfg_for(workdir, day_folders="%Y/%m/%d", full_listing_every=3)
    land(f"{cfg.landing}/2026/04/28", "a.csv", TXN_1, T0)
    r1 = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))       # first run: full listing
    assert r1["records_processed"] == 4
    land(f"{cfg.landing}/2026/04/29", "b.csv", TXN_2, T0 + dt.timedelta(days=1))
    land(f"{cfg.landing}/2026/01/01", "stray.csv", TXN_2, T0 + dt.timedelta(days=1))  # outside the days
    r2 = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(days=1, hours=1))
    assert [f.rsplit("/", 1)[1] for f in r2["files"]] == ["b.csv"]
    r3 = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(days=5))         # no folder for these days
    assert r3["status"] == "NO_FILES"
    r4 = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(days=5))         # every third run lists everything
    assert [f.rsplit("/", 1)[1] for f in r4["files"]] == ["stray.csv"]


def test_success_row_is_the_only_commit_point(spark, workdir):
    cfg = cfg_for(workdir)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    # The watermark is the finished row's cutoff; nothing else was written.
    assert L.current_watermark(spark, cfg.control) == T0 + dt.timedelta(hours=1)
    assert sorted(os.listdir(cfg.control)) == ["claims", "files", "leases", "ledger"]
    # A manual move forwards is honoured, a move backwards is not.
    L.advance_watermark(spark, cfg.control, T0 + dt.timedelta(hours=5))
    L.advance_watermark(spark, cfg.control, T0)
    assert L.current_watermark(spark, cfg.control) == T0 + dt.timedelta(hours=5)
    assert L.latest_batch(spark, cfg.control).first().status == "SUCCESS"


def test_command_line(spark, workdir, capsys):
    import json as _json
    from millrace.__main__ import main
    land(f"{workdir}/landing", "txn_1.csv", TXN_1, T0)
    args = ["--landing", f"{workdir}/landing", "--target", f"{workdir}/curated",
            "--control", f"{workdir}/control"]
    assert main(["plan", *args]) == 0
    assert _json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == "PLANNED"
    assert main(["process", *args]) == 0
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["status"] == "SUCCESS" and out["records_processed"] == 4


def test_stream_one_file_per_trigger_mixed_headers(spark, workdir):
    from millrace.streaming.ingest_stream import start_stream_ingest
    cfg = cfg_for(workdir, replay_safe=True)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    land(cfg.landing, "txn_3.csv", TXN_ALIASED, T0 + dt.timedelta(minutes=1))
    q = start_stream_ingest(spark, cfg, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    states = L.batch_states(spark, cfg.control).collect()
    assert sorted(r.batch_id for r in states) == ["stream_0000000000", "stream_0000000001"]
    assert all(r.n_files == 1 and r.status == "SUCCESS" for r in states)
    table = read_curated(spark, cfg.target)
    assert table.count() == 5 and "channel" in table.columns


def test_quarantine_rereads_only_files_with_bad_rows(spark, workdir, monkeypatch):
    import millrace.plans.ingest as I
    seen = []
    real = I.read_csv_batch

    def spy(spark_, paths, *a, **k):
        seen.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return real(spark_, paths, *a, **k)

    monkeypatch.setattr(I, "read_csv_batch", spy)
    cfg = cfg_for(workdir)
    land(cfg.landing, "clean.csv", TXN_1, T0)
    land(cfg.landing, "dirty.csv", TXN_2, T0)
    r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert r["bad_records"] == 1 and r["records_processed"] == 5
    assert seen == [["clean.csv", "dirty.csv"], ["dirty.csv"]]
    assert [x.transaction_id for x in read_curated(spark, quarantine_path(cfg.target)).collect()] == ["S-5"]
    assert "__source_file" not in read_curated(spark, cfg.target).columns


def test_stream_continuous_mode(spark, workdir):
    from millrace.streaming.ingest_stream import start_stream_ingest
    cfg = cfg_for(workdir, replay_safe=True)
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    q = start_stream_ingest(spark, cfg, available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        assert read_curated(spark, cfg.target).count() == 4
        land(cfg.landing, "txn_2.csv", TXN_2, T0 + dt.timedelta(minutes=5))
        q.processAllAvailable()
        assert read_curated(spark, cfg.target).count() == 5
    finally:
        q.stop()
    assert len(L.batch_states(spark, cfg.control).collect()) == 2


def test_default_layout_is_replay_safe(spark, workdir):
    cfg = cfg_for(workdir)
    assert cfg.replay_safe
    land(cfg.landing, "txn_1.csv", TXN_1, T0)
    r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    assert [d for d in os.listdir(f"{cfg.target}/process_date=2026-04-28") if d[0] not in "_."] == [f"batch_id={r['batch_id']}"]


def test_max_files_bounds_a_backlog_without_skipping(spark, workdir):
    cfg = cfg_for(workdir, max_files=2)
    for i in range(5):
        land(cfg.landing, f"f{i}.csv", TXN_1, T0 + dt.timedelta(minutes=i))
    land(cfg.landing, "tie.csv", TXN_1, T0 + dt.timedelta(minutes=1))   # same mtime as f1
    seen = []
    for _ in range(4):
        r = run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
        seen.append(sorted(f.rsplit("/", 1)[1] for f in r["files"]))
    assert seen == [["f0.csv", "f1.csv"], ["f2.csv", "tie.csv"], ["f3.csv", "f4.csv"], []]
    assert read_curated(spark, cfg.target).count() == 6 * 4
    assert L.current_watermark(spark, cfg.control) == T0 + dt.timedelta(hours=1)


def test_command_line_stream(spark, workdir, capsys):
    import json as _json
    from millrace.__main__ import main
    land(f"{workdir}/landing", "txn_2.csv", TXN_2, T0)
    args = ["stream", "--landing", f"{workdir}/landing", "--target", f"{workdir}/curated",
            "--control", f"{workdir}/control"]
    assert main(args) == 0
    assert _json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == "DRAINED"
    assert read_curated(spark, f"{workdir}/curated").count() == 1
    assert read_curated(spark, quarantine_path(f"{workdir}/curated")).count() == 1


def test_values_that_do_not_fit_are_rescued(spark, workdir):
    from millrace.sinks.tables import rescued_path
    cfg = cfg_for(workdir, rescue=True)
    land(cfg.landing, "odd.csv", "transaction_id,custId,txnAmt,quantity\nA,K1,12,3\nB,K2,n/a,x1\nC,,1.5.2,4\n"
         "D,K4,7,1,surplus,more\nE,K5\n", T0)
    land(cfg.landing, "clean.csv", "transaction_id,custId,txnAmt,quantity\nF,K1,12,3\n", T0)
    run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=1))
    got = {r["transaction_id"]: (r["rescued"], r["line"]) for r in read_curated(spark, rescued_path(cfg.target)).collect()}
    assert got == {"B": ({"transaction_amount": "n/a", "quantity": "x1"}, None),
                   "C": ({"transaction_amount": "1.5.2"}, None),
                   "D": ({}, "D,K4,7,1,surplus,more"), "E": ({}, "E,K5")}
    table = read_curated(spark, cfg.target)
    assert sorted(r["transaction_id"] for r in table.collect()) == ["A", "B", "D", "E", "F"]
    assert not [c for c in table.columns if c.startswith("__")]
    assert [r["transaction_id"] for r in read_curated(spark, quarantine_path(cfg.target)).collect()] == ["C"]
    run_batch(spark, cfg, cutoff=T0 + dt.timedelta(hours=2))
    assert read_curated(spark, rescued_path(cfg.target)).count() == 4
