"""Compare catalogue queries with their SQL counterparts: check.py FOLDER [NAME ...]"""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import connect, differences  # noqa: E402

from shopscope.registry.catalogue import QUERIES  # noqa: E402
from shopscope.registry.counterparts import ORACLE_SQL  # noqa: E402
from shopscope.session import get_session  # noqa: E402

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = differences(QUERIES[name](spark, folder), con, ORACLE_SQL[name])
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok':4} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("    ", line)
    print(f"{len(names) - bad} of {len(names)} agree; without SQL: {sorted(set(QUERIES) - set(ORACLE_SQL))}")
    sys.exit(bool(bad))
