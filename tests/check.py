"""Run queries against their oracles: python tests/check.py [sf] [name part ...]."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import connect, differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tablecraft.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    d = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    con = connect(d)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, d)
            if name in oracles:
                problems = differences(df, con, oracles[name])
            else:
                problems = [f"no oracle, {df.count()} rows"]
        except Exception as error:  # report and go on
            problems = [str(error)[:1500] or traceback.format_exc()[-1500:]]
        took = time.time() - start
        if problems:
            bad += 1
        print(f"{'ok ' if not problems else 'BAD'} {took:6.2f}s {name}", flush=True)
        for p in problems:
            print("      ", p)
    print("bad:", bad)


if __name__ == "__main__":
    main()
