"""One row of a key: by rank, by order, by content; and the flags that keep the others without counting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tie(df: DataFrame, columns: list[str]) -> list[Column]:
    """The row itself as the last key: equal ranks are settled by contents, not by chance."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [F.xxhash64(*own).alias("tie")] if (own := [c for c in columns if "map<" not in kinds[c]]) else []


def best_row_per_key(df: DataFrame, keys: list[str], rank: list[Column]) -> DataFrame:
    """The row of the largest rank tuple of each key: an aggregation with map-side combine, no window, no sort of the groups."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], *_tie(df, others))).alias("best"))
    return best.select(*keys, "best.*").select(*df.columns)


def first_row_per_key(df: DataFrame, keys: list[str], order: list[Column], few: bool = False) -> DataFrame:
    """The row that comes first in an explicit order. `few`: keys have few rows each, which are dealt out first, so that no task sorts all that it reads."""
    others = [c for c in df.columns if c not in keys]
    best = (df.repartition(*keys) if few else df).groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(order)], *_tie(df, others))).alias("best"))
    return best.select(*keys, "best.*").select(*df.columns)


def first_by_native_id(df: DataFrame, key: str, order: list[Column], blank: str = "keep", few: bool = False) -> DataFrame:
    """The first row of each native id. blank: what becomes of rows without one: keep each, collapse them into one, or drop them. few: as for first_row_per_key()."""
    has = F.coalesce(F.btrim(F.col(key).cast("string")), F.lit("")) != ""
    named = first_row_per_key(df.where(has), [key], order, few)
    if blank == "drop":
        return named
    blanks = df.where(~has)
    return named.unionByName(blanks if blank == "keep" else first_row_per_key(blanks.withColumn("__one", F.lit(1)), ["__one"], order).drop("__one"))


def numeric_rank(col: Column) -> Column:
    """A filing number as a number, -1 where it isn't one."""
    return F.coalesce(col.try_cast("decimal(38,0)"), F.lit(-1).cast("decimal(38,0)"))


def counted_flag(df: DataFrame, keys: list[str], txn: str, countable: Column, out: str = "counted") -> DataFrame:
    """False for rows that aren't countable and have a countable sibling: one of the same keys with another transaction id.

    The least and the largest countable id of a group tell whether another one exists, so groups are aggregated and
    joined back; keys with nulls are in no group.
    """
    groups = df.where(countable).groupBy(*keys).agg(F.min(txn).alias("__lo"), F.max(txn).alias("__hi"))
    joined = df.join(groups, keys, "left")
    sibling = F.coalesce((F.col("__lo") != F.col(txn)) | (F.col("__hi") != F.col(txn)), F.lit(False))
    return joined.withColumn(out, countable | ~sibling).drop("__lo", "__hi").select(*df.columns, out)


def supersede_copies(df: DataFrame, keys: list[str], rank: list[Column], id_col: str) -> DataFrame:
    """All rows, with superseded_by: the id of the row of the largest rank among those of equal content, null for that row itself."""
    named = [r.alias(f"r{i}") for i, r in enumerate(rank)]
    winner = df.groupBy(*keys).agg(F.max_by(id_col, F.struct(*named, F.col(id_col).alias("id"))).alias("__winner"))
    winner = winner.select(*[F.col(k).alias(f"__{k}") for k in keys], "__winner")
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]  # a null key is a value like any other
    return df.join(winner, on, "left").select(*df.columns, F.when(F.col("__winner") != F.col(id_col), F.col("__winner")).alias("superseded_by"))


def keyless_kept(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each identity, and every row without one."""
    return first_by_native_id(df, key, order, "keep")
