"""Print the final (AQE) physical plan tree of every registered query.

    python tools/explain_all.py [/root/testdata/sf0.1] > plans.md

Each query is executed once so the adaptive plan is final (broadcast decisions,
reused exchanges, coalesced shuffles are the ones actually taken).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace import plans  # noqa: E402
from millrace.session import build_session  # noqa: E402


def final_tree(df) -> tuple[str, list]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n(1)")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("+- == Initial Plan ==")[0]
    scans = sorted(set(re.findall(r"^(PushedFilters: .*|ReadSchema: .*)$", text, re.M)))
    return tree.rstrip(), scans


def main(argv) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    print(f"# Physical plans (final AQE plans, {os.path.basename(sf)}, local[8])\n")
    print("Generated by `tools/explain_all.py`. Scan lines show what reached the Parquet reader.\n")
    for name, fn in plans.registry().items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        tree, scans = final_tree(df)
        print(f"## {name}\n\n```\n{tree}\n```\n")
        for s in scans:
            print(f"* `{s}`")
        print()
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
