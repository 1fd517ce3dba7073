"""Run every registered query against its SQL; name keys to check only those.

    python tests/check_all.py [--sf DIR] [key ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tunelake.registry.catalog import ORACLES, QUERIES  # noqa: E402


def main(argv):
    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in argv or QUERIES:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
            else:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        mark = "ok  " if not problems else "FAIL"
        print(f"{mark} {name} {time.time() - t0:.2f}s {'' if name in ORACLES else '(rows)'}", *problems,
              sep="\n     " if problems else " ", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
