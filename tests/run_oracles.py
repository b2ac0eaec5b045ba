"""``python -m tests.run_oracles [sf] [query ...]``: compare queries with their SQL.

Instead of a scale factor, the path of a table directory will do."""

import sys
import time

from pyspark.sql import SparkSession

from recurra.plans.oracles import ORACLES
from recurra.plans.queries import QUERIES, bind
from tests.compare import difference, duck


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = sf if "/" in sf else f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                verdict = difference(spark, con, name, sf_dir) or "equal"
            else:
                verdict = f"{bind(QUERIES[name])(spark, sf_dir).count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.2f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main()
