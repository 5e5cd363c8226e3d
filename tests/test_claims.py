"""Crash safety and exclusivity of the ingest job: kills after every durable step, and runs side by side."""

import datetime as dt
import os
import threading

import pytest

from millrace.plans.ingest import STEPS, IngestConfig, Overtaken, plan_batch, process_batch, run_batch, run_until_drained
from millrace.sinks import claims as C
from millrace.sinks import ledger as L
from millrace.sinks.tables import quarantine_path
from millrace.sources import read_curated

HEADER = "transaction_id,custId,txnAmt\n"
T0 = dt.datetime(2026, 5, 4, 9, 0, tzinfo=dt.timezone.utc)
LATER = T0 + dt.timedelta(hours=1)


class Killed(BaseException):
    pass


def landing_of(workdir, n):
    os.makedirs(f"{workdir}/landing", exist_ok=True)
    for i in range(n):
        path = f"{workdir}/landing/f{i:03d}.csv"
        with open(path, "w") as f:
            f.write(HEADER + f"A{i},K{i},1.5\nB{i},,2\n")
        at = T0.timestamp() + i
        os.utime(path, (at, at))


def cfg_for(workdir, **kw):
    return IngestConfig(landing=f"{workdir}/landing", target=f"{workdir}/curated", control=f"{workdir}/control", **kw)


def assert_each_once(spark, cfg, n):
    good = sorted(r["transaction_id"] for r in read_curated(spark, cfg.target).collect())
    bad = sorted(r["transaction_id"] for r in read_curated(spark, quarantine_path(cfg.target)).collect())
    assert good == sorted(f"A{i}" for i in range(n))
    assert bad == sorted(f"B{i}" for i in range(n))
    owned = L.owned_files(spark, cfg.control).where("state = 'PLANNED'")
    assert owned.count() == owned.select("path").distinct().count() == n


@pytest.mark.parametrize("step", STEPS)
def test_killed_after_each_step(spark, workdir, step):
    landing_of(workdir, 3)

    def die(at):
        if at == step:
            raise Killed(at)
    with pytest.raises(Killed):
        run_batch(spark, cfg_for(workdir, max_files=2, on_step=die), LATER)
    cfg = cfg_for(workdir)
    done = run_until_drained(spark, cfg, LATER)
    assert done[-1]["status"] == "NO_FILES"
    assert_each_once(spark, cfg, 3)
    # What was claimed kept its batch; what was not left no trace in the ledger.
    states = {r["batch_id"]: r["status"] for r in L.batch_states(spark, cfg.control).collect()}
    assert sorted(states.values()) == ["NO_FILES", "SUCCESS"] + (["SUCCESS"] if step != "files" else [])


@pytest.mark.parametrize("write", ["record_files", "record_batch"])
def test_a_control_write_that_fails(spark, workdir, monkeypatch, write):
    landing_of(workdir, 2)
    real, calls = getattr(L, write), []

    def once(*a, **k):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("store is away")
        return real(*a, **k)
    monkeypatch.setattr(L, write, once)
    with pytest.raises(OSError):
        run_batch(spark, cfg_for(workdir), LATER)
    cfg = cfg_for(workdir)
    run_until_drained(spark, cfg, LATER)
    assert_each_once(spark, cfg, 2)


def test_beaten_to_the_claim(spark, workdir):
    """Another run claims between this one's choice of files and its claim."""
    landing_of(workdir, 4)
    other, seen = cfg_for(workdir, max_files=2, owner="other"), []

    def interfere(step):
        if step == "files" and not seen:
            seen.append(plan_batch(spark, other, LATER))
    mine = plan_batch(spark, cfg_for(workdir, max_files=3, owner="mine", on_step=interfere), LATER)
    # The beaten run came back to the batch that nobody loads yet.
    assert mine["batch_id"] == seen[0]["batch_id"] and mine["files"] == seen[0]["files"]
    assert L.file_rows(spark, other.control).where("state = 'PLANNED'").count() == 5    # three of them orphans
    run_until_drained(spark, cfg_for(workdir), LATER)
    assert_each_once(spark, cfg_for(workdir), 4)


def test_a_held_batch_is_left_alone_until_its_lease_ends(spark, workdir):
    landing_of(workdir, 3)
    slow = cfg_for(workdir, max_files=2, owner="slow")
    batch = plan_batch(spark, slow, LATER)
    assert C.lease(spark, slow.control, batch["batch_id"], "slow", 3600) == 1
    quick = cfg_for(workdir, owner="quick")
    done = run_until_drained(spark, quick, LATER)
    assert [len(r["files"]) for r in done] == [1, 0]            # only what nobody holds
    with pytest.raises(Overtaken):
        process_batch(spark, quick, batch)
    run_batch(spark, slow, LATER)                               # its owner comes back
    assert_each_once(spark, slow, 3)


def test_an_overtaken_run_does_not_commit(spark, workdir):
    landing_of(workdir, 2)
    took = []

    def overtake(step):
        if step == "data" and not took:
            took.append(C.lease(spark, slow.control, batch["batch_id"], "other", 60))
    slow = cfg_for(workdir, owner="slow", lease_seconds=0, on_step=overtake)
    batch = plan_batch(spark, slow, LATER)
    with pytest.raises(Overtaken):
        process_batch(spark, slow, batch)
    assert took == [2]
    assert {r["status"] for r in L.batch_states(spark, slow.control).collect()} == {"PLANNED"}
    run_until_drained(spark, cfg_for(workdir, owner="other"), LATER)
    assert_each_once(spark, slow, 2)


def test_runs_side_by_side(spark, workdir):
    landing_of(workdir, 12)
    errors = []

    def work(i):
        try:
            run_until_drained(spark, cfg_for(workdir, max_files=2, owner=f"run-{i}"), LATER)
        except BaseException as e:
            errors.append(e)
    runs = [threading.Thread(target=work, args=(i,)) for i in range(3)]
    for r in runs:
        r.start()
    for r in runs:
        r.join()
    assert not errors
    assert_each_once(spark, cfg_for(workdir), 12)


def test_exclusive_creation(spark, workdir):
    path, won = f"{workdir}/x/000001", []
    threads = [threading.Thread(target=lambda i=i: won.append(C.create_exclusive(spark, path, f"run {i}")))
               for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 7 + [True]
    assert open(path).read().startswith("run ") and C.names(spark, f"{workdir}/x") == ["000001"]
    assert os.listdir(f"{workdir}/x") == ["000001"]
