"""Run every query against its oracle: python tests/run_contract.py [sf_dir] [name ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import __spark_entry__ as e
import contract
from footfall.session import get_session


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("contract", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = contract.connect(sf_dir)
    queries, oracles = e.queries(), e.oracle_sql()
    bad = sorted(set(queries) ^ set(oracles))
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            got = contract.spark_result(df)
            took = time.time() - start
            want = contract.oracle_result(con, oracles[name])
            ok = got == want
            print(f"{'ok ' if ok else 'BAD'} {name} rows={len(got[1])}/{len(want[1])} {took:.2f}s", flush=True)
            if not ok:
                bad.append(name)
                print("  ", got[0], want[0])
                extra = [r for r in got[1] if r not in want[1]][:2]
                missing = [r for r in want[1] if r not in got[1]][:2]
                print("   spark ", extra, "\n   oracle", missing)
        except Exception as error:
            bad.append(name)
            print("ERR", name, str(error)[:600], flush=True)
    print("failed:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
