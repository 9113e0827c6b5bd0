"""Compares the plan shapes used here with the plain ones: python bench_plans.py [folder]"""

from __future__ import annotations

import statistics
import sys
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from check_queries import session
from lumenframe.functions.kernels import minkowski
from lumenframe.operators import neighbors as N
from lumenframe.operators.position import exact_quantiles, with_position
from lumenframe.plans.neighbors import KEYS, K_MAX, split
from lumenframe.sources.scratch import clear
from lumenframe.sources.tables import table


def timed(fn, runs: int = 3) -> float:
    seconds = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds[1:])


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session()
    train, test = split(spark, folder)

    def blocks():
        return N.nearest(train, test, 16, carry=["label"], **KEYS)

    def all_pairs():
        a = test.select(F.col("vec_id").alias("probe"), F.col("embedding").cast("array<double>").alias("a"))
        b = train.select(F.col("vec_id").alias("nb"), "label", F.col("embedding").cast("array<double>").alias("b"))
        pairs = a.join(F.broadcast(b)).select("probe", "nb", "label", minkowski(F.col("a"), F.col("b")).alias("dist"))
        rank = F.row_number().over(Window.partitionBy("probe").orderBy("dist", "nb"))
        return pairs.withColumn("rank", rank).filter("rank <= 16")

    def sweep_once():
        near = N.nearest_lists(train, test, K_MAX + 1, carry=["label"], **KEYS)
        return N.sweep_k(near, label="label", kernel="gaussian", k_max=K_MAX)

    def sweep_each():
        out = None
        for k in range(1, K_MAX + 1):
            near = N.nearest(train, test, k + 1, carry=["label"], **KEYS)
            one = N.vote(near, label="label", kernel="gaussian", k=k).withColumn("k", F.lit(k))
            out = one if out is None else out.unionByName(one)
        return out

    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]

    def ranges():
        return with_position(lines.distinct(), [], order)

    def one_task():
        return lines.distinct().withColumn("pos", F.row_number().over(Window.orderBy(*order)))

    def sketch():
        return exact_quantiles(lines, [], "l_extendedprice", {"m": 0.5, "q": 0.9})

    def one_buffer():
        return lines.agg(F.percentile("l_extendedprice", [0.5, 0.9]))

    for name, shaped, plain in (
        ("similarity join: blocks / all pairs", blocks, all_pairs),
        ("k sweep: one join / a join per k", sweep_once, sweep_each),
        ("global position: ranges / one task", ranges, one_task),
        ("exact quantiles: sketch and slots / one buffer", sketch, one_buffer),
    ):
        runs = 1 if shaped is sweep_once else 3
        print(f"{name:50s} {timed(shaped, runs):7.2f} s {timed(plain, runs):7.2f} s", flush=True)
    clear(spark)


if __name__ == "__main__":
    main()
