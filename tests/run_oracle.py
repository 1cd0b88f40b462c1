"""CLI: compare all (or the named) queries against DuckDB at one scale."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_compare import compare, duck  # noqa: E402

from tastegraph.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "16g"})
    import __spark_entry__ as entry
    names = sys.argv[1:] or list(entry.queries())
    con = duck(sf)
    for n in names:
        try:
            res = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            res = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        print(json.dumps(res), flush=True)
