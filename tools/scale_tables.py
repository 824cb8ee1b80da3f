"""Write an N-times larger copy of the driver tables for scaling runs.

Fact tables (lineitem, orders, events) are replicated N times with their
own keys shifted per copy; dimension tables (part, customer, nation,
region, ...) are copied unchanged, so every product and customer gets N
times the activity -- hot keys get hotter, as with real growth.  The data is
derived by Spark from the given tables.

    python tools/scale_tables.py /root/testdata/sf0.1 /tmp/run-x/sf1x 10
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cartwheel.config import build_session  # noqa: E402

SHIFT = {"lineitem": ["l_orderkey"], "orders": ["o_orderkey"], "events": ["event_id"]}
TABLES = "region nation customer supplier part orders lineitem events".split()


def main() -> None:
    src, dst, n = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/"), int(sys.argv[3])
    spark = build_session("local[8]", shuffle_partitions=16)
    for t in TABLES:
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t in SHIFT:
            span = df.agg(*[F.max(c) + 1 for c in SHIFT[t]]).first()
            copies = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            for c, width in zip(SHIFT[t], span):
                copies = copies.withColumn(c, F.col(c) + F.col("_copy") * F.lit(width))
            df = copies.drop("_copy")
        # one folder per table, named like the driver's files
        df.write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
