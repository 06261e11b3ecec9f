"""Running sums in a global order, without fixed bins and without one task that sees all rows.

Rows are range-partitioned by (keys, order). Spark samples the data for the
boundaries, so a crowded stretch of values gets as many ranges as it needs; while
some range is above the bound, the rows are cut into twice as many. Sums by (keys,
range), a running sum over these few rows, and a window inside each range give
every row what lies before it. The placed rows are written (reliable checkpoint),
so that every reader sees the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.session import cut_lineage

RANGE_ROWS = 1_000_000


def placed(df: DataFrame, order: list[Column], range_rows: int = RANGE_ROWS, tries: int = 6) -> DataFrame:
    """``df`` plus ``_range``, which ascends with ``order``. A range has at most
    ``range_rows`` rows, if rows equal in ``order`` do not prevent it."""
    rows = df.count()
    ranges = max(1, -(-2 * rows // range_rows))
    for _ in range(tries):
        out = cut_lineage(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
        top = out.groupBy("_range").count().agg(F.max("count")).first()[0] or 0
        if top <= range_rows or ranges > rows:
            break
        ranges *= 2
    return out


def before(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], totals: dict[str, Column] | None = None,
           range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` plus, per row, the sums over the rows of its keys that come before
    it in ``order`` (``sums``: name -> column to add up) and over all rows of its
    keys (``totals``). ``order`` must tell the rows of a key apart."""
    out = placed(df, [F.col(c) for c in (*keys, *order)], range_rows)
    totals = totals or {}
    per = out.groupBy(*keys, "_range").agg(*(F.sum(c).alias(f"_s_{n}") for n, c in sums.items()),
                                           *(F.sum(c).alias(f"_t_{n}") for n, c in totals.items()))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_range", *(F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums),
                     *(F.sum(f"_t_{n}").over(Window.partitionBy(*keys)).alias(n) for n in totals))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = out.join(per, [*keys, "_range"])
    for n, c in sums.items():
        joined = joined.withColumn(n, F.col(f"_b_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return joined.drop("_range", *(f"_b_{n}" for n in sums))


def first_rows(df: DataFrame, order: list[str], n: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The first ``n`` rows in ``order``: rows per range, what comes before each
    range, and a filter; only the range that ``n`` ends in is ranked."""
    out = placed(df, [F.col(c) for c in order], range_rows)
    counts = sorted((r["_range"], r["count"]) for r in out.groupBy("_range").count().collect())  # one row a range
    left = n
    for r, c in counts:
        if c > left:
            last = out.where(F.col("_range") == r).withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy(*order))) \
                .where(F.col("_n") <= left).drop("_n", "_range")
            return out.where(F.col("_range") < r).drop("_range").unionByName(last)
        left -= c
    return out.drop("_range")
