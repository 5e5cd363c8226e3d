"""The listing data source against a walk of the folders."""

import os

from millrace.sources.listing import ENOUGH, ListingReader, can_list, list_everything
from millrace.sources.manifest import hidden_files, list_files

NAMES = ["a.csv", "x/b 1.csv", "x/y/z/w/v/c%.csv", "_h.csv", ".k/q.csv", "x/_SUCCESS", "x/_d=1/u.csv", "a[1].csv",
         "x/.part.crc", "ü/é+#.csv", "_dir/deep/f"]


def fill(workdir, names=NAMES):
    for n in names:
        os.makedirs(os.path.dirname(f"{workdir}/in/{n}"), exist_ok=True)
        with open(f"{workdir}/in/{n}", "w") as f:
            f.write(n)
    return f"{workdir}/in"


def test_same_files_as_sparks_listing_and_the_hidden_ones(spark, workdir):
    folder = fill(workdir)
    rows = list_everything(spark, folder).collect()
    assert len(rows) == len({r["path"] for r in rows})
    seen = {(r["path"], r["modificationTime"], r["length"]) for r in rows if not r["hidden"]}
    assert seen == {tuple(r) for r in list_files(spark, folder).collect()}
    assert {r["path"] for r in rows if r["hidden"]} == {h[0] for h in hidden_files(spark, folder)}
    assert {r["path"] for r in list_everything(spark, f"file:{folder}/").collect()} == {r["path"] for r in rows}


def test_glob_missing_and_empty(spark, workdir):
    folder = fill(workdir)
    names = {os.path.basename(r["path"]) for r in list_everything(spark, folder, "*.csv").collect()}
    assert names == {os.path.basename(n) for n in NAMES if n.endswith(".csv")}
    assert list_everything(spark, f"{workdir}/none").collect() == []
    os.makedirs(f"{workdir}/empty")
    assert list_everything(spark, f"{workdir}/empty").collect() == []
    assert not can_list(spark, f"{folder}/{{a,b}}") and not can_list(spark, "viewfs://x/in")


def test_folders_are_shared_out(workdir):
    folder = fill(workdir, [f"d{i % 7}/e{i % 300}/f{i}.csv" for i in range(900)])
    shares = ListingReader({"path": folder}).partitions()
    assert len(shares) >= ENOUGH and sum(s.deep for s in shares) >= 300
    got = [r for s in shares for r in ListingReader({"path": folder}).read(s)]
    assert len(got) == len({r[0] for r in got}) == 900
