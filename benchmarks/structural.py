"""Checking a table column by column against checking it in one plan: seconds and Spark jobs.

Column by column means: a count job per column and rule, an append job per failing column (type
errors joined back on the key), then a set difference to get the good rows. Both write the same
layers from the same stored table; the input is the text orders of $BENCH_SF_DIR, times $BENCH_COPIES.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from medallion.operators.standardize import conform  # noqa: E402
from medallion.operators.rules import rules_for  # noqa: E402
from medallion.plans.initial import Layers, load_silver  # noqa: E402
from medallion.queries.derived import dictionary, dirty_orders  # noqa: E402
from medallion.session import get_spark  # noqa: E402
from medallion.sinks.writers import write_full  # noqa: E402

DAY = date(2024, 3, 1)


def one_plan(spark, layers) -> None:
    load_silver(spark, layers, dictionary(), "orders", DAY)


def column_by_column(spark, layers) -> None:
    bronze = spark.read.parquet(layers.bronze("orders")).drop("part_date")
    errors = layers.errors("orders")
    for rule in rules_for(bronze, dictionary(), "orders"):
        bad = bronze.where(rule.broken)
        if bad.count() > 0:
            if rule.rule == "type":
                bad = bronze.join(bad.select("o_orderkey"), "o_orderkey").select(*bronze.columns)
            bad.withColumn("error_desc", F.lit(rule.error_desc)).write.mode("append").parquet(errors)
    good = bronze.subtract(spark.read.parquet(errors).select(*bronze.columns))
    write_full(conform(good, dictionary(), "orders"), layers.silver("orders"), DAY)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("structural", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                      spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="structural-")
    source = dirty_orders(spark, sf_dir)
    many = source.repartition(copies).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    write_full(many.drop("copy"), f"{root}/bronze/orders", DAY)
    n_rows = spark.read.parquet(f"{root}/bronze/orders").count()
    result = {"rows": n_rows}
    for name, check in (("column_by_column", column_by_column), ("one_plan", one_plan)):
        runs = []
        for attempt in range(4):
            layers = Layers(f"{root}/{name}-{attempt}")
            spark.read.parquet(f"{root}/bronze/orders").write.partitionBy("part_date").parquet(layers.bronze("orders"))
            spark.sparkContext.setJobGroup(f"{name}-{attempt}", name)
            start = time.perf_counter()
            check(spark, layers)
            runs.append(time.perf_counter() - start)
            jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{name}-{attempt}"))
        result[name] = {"seconds_median": round(sorted(runs[1:])[1], 2), "jobs": jobs}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
