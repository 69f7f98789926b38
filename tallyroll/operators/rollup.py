"""Aggregations, top-N and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import MONEY, ratio
from .shared import stored




def dollars(amount: Column) -> Column:
    """An exact sum, given as a double."""
    return F.coalesce(F.sum(amount.cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")


def published(df: DataFrame, status: str = "status", counted: str | None = "counted") -> DataFrame:
    """CONFIRMED and PROBABLE rows that count."""
    df = df.where(F.col(status).isin("CONFIRMED", "PROBABLE"))
    return df.where(F.col(counted)) if counted else df


def totals(df: DataFrame, keys: list[Column], amount: str, n: str = "donations", total: str = "total_amount") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(n), dollars(F.col(amount)).alias(total))


def tier_measures(status: Column, amount: Column, tiers: tuple[str, ...] = ("CONFIRMED", "PROBABLE", "UNCERTAIN")) -> list[Column]:
    """For one agg(): the count and the dollars of each tier."""
    of = lambda t: F.when(status == t, amount.cast(MONEY))
    return [x for t in tiers for x in (F.count_if(status == t).alias(f"n_{t.lower()}"), F.coalesce(F.sum(of(t)), F.lit(0)).cast("double").alias(f"usd_{t.lower()}"))]


def listed(col: Column, separator: str = ",") -> Column:
    """The distinct values, sorted and joined; nulls left out."""
    return F.array_join(F.array_sort(F.collect_set(col)), separator)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group with their rank; Spark cuts each task's rows to n before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= n)


def latest_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The row of the largest order tuple of each group."""
    from .dedup import best_row_per_key

    return best_row_per_key(df, group, order)


def two_level_arg_max(df: DataFrame, outer: str, inner: str, amount: str) -> DataFrame:
    """Of each outer key the inner key with the most dollars (ties to the smaller key) and those dollars."""
    sums = df.groupBy(outer, inner).agg(F.sum(F.col(amount).cast(MONEY)).alias("total"))
    best = sums.groupBy(outer).agg(F.min(F.struct((-F.col("total")).alias("t"), F.col(inner).alias("k"))).alias("b"))
    return best.select(outer, F.col("b.k").alias(inner), (-F.col("b.t")).cast("double").alias("total_amount"))


def ranked(df: DataFrame, order: list[Column], out: str = "place") -> DataFrame:
    """df with each row's place (from 0) in the order, which names each row.

    Rows are put into ranges, kept as they are; the ranges' row counts, one number each, give where a range begins. No
    task sees more than its own range.
    """
    ranged = stored(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = {r["__range"]: r["count"] for r in ranged.groupBy("__range").count().collect()}  # a row a range
    before = F.array(*[F.lit(sum(n for other, n in counts.items() if other < k)).cast("long") for k in range(max(counts, default=0) + 1)])
    local = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranged.withColumn(out, F.element_at(before, F.col("__range") + 1) + local - 1).select(*df.columns, out)


def round_robin(df: DataFrame, weight: list[Column], buckets: int, out: str = "bucket") -> DataFrame:
    """Deals a registry out to buckets by descending weight: the first row to the first bucket, the next to the next, and around."""
    return ranked(df, weight, "__place").withColumn(out, F.pmod("__place", F.lit(buckets)).cast("int")).drop("__place")


def keep_recent_or_newest(df: DataFrame, group: str, date: str, now: Column, days: int) -> DataFrame:
    """Adds keep: rows of less than so many days, and the newest of each group."""
    newest = df.groupBy(group).agg(F.max(date).alias("__newest"))
    return df.join(newest, group).withColumn("keep", (F.datediff(now, F.col(date)) < days) | (F.col(date) == F.col("__newest"))).drop("__newest")


def queue_stats(donations: DataFrame, queue: DataFrame, key: str) -> DataFrame:
    """Per entity of either side: confirmed, probable, open, resolved and the ratio probable / confirmed."""
    d = donations.groupBy(key).agg(F.count_if(F.col("status") == "CONFIRMED").alias("confirmed"), F.count_if(F.col("status") == "PROBABLE").alias("probable"))
    q = queue.groupBy(key).agg(F.count_if(F.col("resolution").isNull()).alias("open"), F.count("resolution").alias("resolved"))
    both = d.join(q, key, "full").na.fill(0, ["confirmed", "probable", "open", "resolved"])
    return both.withColumn("ratio", ratio(F.col("probable"), F.col("confirmed")))


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: total, resolved, unresolved and percent of left's distinct keys that right has."""
    found = left.select(key).distinct().join(right.select(key).distinct().withColumn("__hit", F.lit(1)), key, "left")
    n, hit = F.count("*"), F.count("__hit")
    return found.agg(n.alias("total"), hit.alias("resolved"), (n - hit).alias("unresolved"), F.round(ratio(hit * 100.0, n), 1).alias("percent"))


def nested_cycles(df: DataFrame, key: str, cycle: str, party: str, amount: str) -> DataFrame:
    """key and by_cycle: a map from cycle to a map from party to dollars, for JSON payloads."""
    cells = df.groupBy(key, cycle, party).agg(dollars(F.col(amount)).alias("usd"))
    rows = cells.groupBy(key, cycle).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(party, "usd")))).alias("by_party"))
    return rows.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(cycle, "by_party"))).alias("by_cycle"))
