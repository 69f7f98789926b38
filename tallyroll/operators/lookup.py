"""Lookups: with fallbacks, by prefixes, by names within names, and who is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_fallback(facts: DataFrame, names: DataFrame, keys: list[str], value: str, fallback: Column) -> DataFrame:
    """facts with the value looked up by keys, or the fallback."""
    found = names.select(*keys, F.col(value).alias("__found"))
    return facts.join(found, keys, "left").withColumn(value, F.coalesce("__found", fallback)).drop("__found")


#: Characters of the pieces by which names are looked for; shorter names are pieces themselves.
GRAM = 3


def _grams(text: Column, sizes: tuple[int, ...]) -> Column:
    """The distinct pieces of a text of these sizes."""
    none = F.array().cast("array<string>")
    n = F.char_length(text)
    of = lambda size: F.when(n >= size, F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substring(text, i, F.lit(size)))).otherwise(none)
    return F.array_distinct(F.flatten(F.array(*map(of, sizes))))


def names_within(rows: DataFrame, text: Column, names: DataFrame, name: str) -> DataFrame:
    """Rows beside every row of names whose name occurs anywhere in the text, letters of either case alike; blank names never do.

    Each name is filed under the one of its pieces of GRAM characters that the fewest texts have. The pieces of the texts,
    each text once however many rows have it, meet these in an equi-join; only where one meets is the whole name looked
    for. However many names there are, nothing is compared with everything.
    """
    right = names.withColumn("__piece", F.lower(F.btrim(F.col(name)))).where("__piece <> ''")
    left = rows.withColumn("__text", F.lower(F.coalesce(text, F.lit(""))))
    own = right.select("__piece").distinct()
    pieces = own.select("__piece", F.explode(_grams(F.col("__piece"), (GRAM,))).alias("__gram")).unionByName(own.where(F.char_length("__piece") < GRAM).withColumn("__gram", F.col("__piece")))
    texts = left.select("__text").distinct()
    found = texts.select("__text", F.explode(_grams(F.col("__text"), tuple(range(1, GRAM + 1)))).alias("__gram"))
    counts = found.join(pieces.select("__gram").distinct(), "__gram", "left_semi").groupBy("__gram").agg(F.count("*").alias("n"))
    filed = pieces.join(counts, "__gram").groupBy("__piece").agg(F.min(F.struct("n", "__gram")).alias("rarest"))
    pairs = found.join(filed.select("__piece", F.col("rarest.__gram").alias("__gram")), "__gram").where(F.contains("__text", "__piece")).select("__text", "__piece")
    return left.join(pairs, "__text").join(right, "__piece").drop("__text", "__piece")


def prefix_compatible(rows: DataFrame, people: DataFrame, last: str, first: str) -> DataFrame:
    """Pairs of equal last names whose first names begin with one another; both sides have columns last and first."""
    right = people.withColumnRenamed(first, "__first")
    a, b = F.lower(F.col(first)), F.lower(F.col("__first"))
    return rows.join(right, last).where((F.startswith(a, b) | F.startswith(b, a)) & (a != "") & (b != "")).withColumnRenamed("__first", f"matched_{first}")


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_anti")


def shared_between_buckets(df: DataFrame, key: str, bucket: str) -> DataFrame:
    """Keys that more than one bucket holds, with the number of buckets."""
    return df.groupBy(key).agg(F.countDistinct(bucket).alias("buckets")).where("buckets > 1")
