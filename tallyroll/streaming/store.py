"""Versioned tables under one root, published together.

A commit writes the parts of its tables under a version of its own and then one manifest that names every part of every
table; the manifest's success marker publishes all of them at once. Readers follow the newest finished manifest, so a run
that fails between any two writes leaves nothing that anybody reads, and running it again overwrites its own version.

A table is cut into buckets by a hash of its keys, a bucket into files by a second hash if so many are asked for, else by its
size, so that few large buckets don't leave the writing to few tasks. Three kinds of writes: `replace`
(the buckets that are written take the place of the old ones), `append` (parts are added to their buckets) and `whole` (all
old parts go). A part remembers with how many migration steps it was written; reading applies the later ones. `prune`
removes what no manifest that is kept names.

Layout: data/<table>/v=<version>/bucket=<n>/ and manifests/v=<version>/, both under root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]
PART = "table string, bucket int, version long, steps int, buckets int"
#: Bytes that a bucket should hold, and files of a bucket.
BUCKET_BYTES, FILES = 256 << 20, 1


@dataclass(frozen=True)
class Part:
    table: str
    bucket: int
    version: int
    steps: int
    buckets: int


@dataclass(frozen=True)
class Write:
    """A table's part of a commit. keys: what its buckets are a hash of. touched: the buckets that `replace` empties even if no row is left."""

    rows: DataFrame
    keys: tuple[str, ...]
    kind: str = "replace"
    buckets: int = 1
    files: int = FILES
    touched: tuple[int, ...] = ()


def add(name: str, kind: str, fill: Column | None = None) -> Step:
    """A migration step: a new column, null or filled."""
    return lambda df: df if name in df.columns else df.withColumn(name, (F.lit(None) if fill is None else fill).cast(kind))


def rename(old: str, new: str) -> Step:
    return lambda df: df.withColumnRenamed(old, new)


def retype(name: str, kind: str) -> Step:
    """A migration step: another type; values that it can't hold become null."""
    return lambda df: df.withColumn(name, F.col(name).try_cast(kind))


def fill(name: str, value: Column) -> Step:
    """A migration step: a value for rows that have none."""
    return lambda df: df.withColumn(name, F.coalesce(F.col(name), value))


def migrated(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    for step in steps:
        df = step(df)
    return df


def buckets_for(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets a table of so many bytes should have when it is first written; it keeps them."""
    return max(1, -(-size // bucket_bytes))


def bucket_of(keys: Iterable[str | Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """The published versions, oldest first (those before one, if given)."""
    found = sorted(int(n[2:]) for n in _names(spark, f"{root}/manifests") if n.startswith("v="))
    return [v for v in found if (before is None or v < before) and "_SUCCESS" in _names(spark, f"{root}/manifests/v={v}")]


def parts(spark: SparkSession, root: str, before: int | None = None, version: int | None = None) -> list[Part]:
    """The parts that the newest manifest names (or that before a version, or of one version): a few for each bucket."""
    newest = [version] if version is not None else versions(spark, root, before)[-1:]
    return [Part(**r.asDict()) for v in newest for r in spark.read.schema(PART).json(f"{root}/manifests/v={v}").collect()]


def read(spark: SparkSession, root: str, table: str, buckets: Iterable[int] | None = None, steps: Sequence[Step] = (), before: int | None = None, version: int | None = None, named: list[Part] | None = None) -> DataFrame | None:
    """A table as the newest manifest (or `named`, if it was read before) has it, or some of its buckets; parts of older schemas are migrated. None where it has no parts."""
    wanted = None if buckets is None else set(buckets)
    own = [p for p in (parts(spark, root, before, version) if named is None else named) if p.table == table and (wanted is None or p.bucket in wanted)]
    out = None
    for written in sorted({p.steps for p in own}):
        paths = [f"{root}/data/{table}/v={p.version}/bucket={p.bucket}" for p in own if p.steps == written]
        rows = migrated(spark.read.parquet(*paths), steps[written:])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _written(spark: SparkSession, root: str, table: str, version: int, write: Write) -> list[int]:
    """Writes a table's parts; the buckets that have any."""
    path = f"{root}/data/{table}/v={version}"
    rows = write.rows.withColumn("bucket", bucket_of(write.keys, write.buckets))
    if write.files > FILES:
        split = F.pmod(F.xxhash64(F.lit(1), *write.rows.columns), F.lit(write.files)).cast("int")
        tasks = max(1, (len(write.touched) or write.buckets) * write.files)
        rows = rows.withColumn("__file", split).repartition(tasks, "bucket", "__file").drop("__file")
    else:
        rows = rows.hint("rebalance", "bucket")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(path)
    return sorted(int(n.removeprefix("bucket=")) for n in _names(spark, path) if n.startswith("bucket="))


def commit(spark: SparkSession, root: str, version: int, writes: dict[str, Write], steps: dict[str, int] | None = None, named: list[Part] | None = None) -> None:
    """Writes the tables under the version and publishes them. steps: how many migration steps a table's rows have behind them.

    The parts of the version before stay, but for those that `replace` and `whole` give up. A version is written from those
    before it, so a run that is repeated gives the same.
    """
    kept = parts(spark, root, before=version) if named is None else list(named)
    for table, write in writes.items():
        found = _written(spark, root, table, version, write)
        if write.kind == "whole":
            kept = [p for p in kept if p.table != table]
        elif write.kind == "replace":
            gone = {*found, *write.touched}
            kept = [p for p in kept if p.table != table or p.bucket not in gone]
        elif write.kind != "append":
            raise ValueError(write.kind)
        kept += [Part(table, b, version, (steps or {}).get(table, 0), write.buckets) for b in found]
    publish(spark, root, version, kept)


def publish(spark: SparkSession, root: str, version: int, kept: list[Part]) -> None:
    """The one write that makes a version visible."""
    rows = [(p.table, p.bucket, p.version, p.steps, p.buckets) for p in kept]
    spark.createDataFrame(rows, PART).coalesce(1).write.mode("overwrite").json(f"{root}/manifests/v={version}")


def compact(spark: SparkSession, root: str, version: int, table: str, keys: tuple[str, ...], steps: Sequence[Step] = ()) -> None:
    """A version in which each bucket of an appended table is one part again, in the newest schema."""
    own = [p for p in parts(spark, root, before=version) if p.table == table]
    rows = read(spark, root, table, steps=steps, before=version)
    if rows is not None:
        commit(spark, root, version, {table: Write(rows.drop("bucket"), keys, "whole", own[0].buckets)}, {table: len(steps)})


def references(spark: SparkSession, root: str, keep: int) -> dict[tuple[str, int, int], int]:
    """Of each part (table, bucket, version): how many of the newest `keep` manifests name it."""
    counts: dict[tuple[str, int, int], int] = {}
    for v in versions(spark, root)[-keep:]:
        for p in parts(spark, root, version=v):
            at = (p.table, p.bucket, p.version)
            counts[at] = counts.get(at, 0) + 1
    return counts


def prune(spark: SparkSession, root: str, keep: int = 3) -> list[tuple[str, int, int]]:
    """Removes the manifests but the newest `keep`, then the parts that none of these names; returns what went.

    Parts of versions after the newest manifest belong to a run that isn't finished and stay.
    """
    if keep < 1:
        raise ValueError("the newest version has to stay")
    done = versions(spark, root)
    if not done:
        return []
    named, newest, gone = references(spark, root, keep), done[-1], []
    for name in [n for n in _names(spark, f"{root}/manifests") if n.startswith("v=")]:
        if int(name[2:]) <= newest and int(name[2:]) not in done[-keep:]:
            fs, path = _fs(spark, f"{root}/manifests/{name}")
            fs.delete(path, True)
    for table in _names(spark, f"{root}/data"):
        for v in [n for n in _names(spark, f"{root}/data/{table}") if n.startswith("v=") and int(n[2:]) <= newest]:
            at = f"{root}/data/{table}/{v}"
            held = [n for n in _names(spark, at) if n.startswith("bucket=")]
            old = [n for n in held if (table, int(n.removeprefix("bucket=")), int(v[2:])) not in named]
            for name in [at] if len(old) == len(held) else [f"{at}/{n}" for n in old]:
                fs, path = _fs(spark, name)
                fs.delete(path, True)
            gone += [(table, int(n.removeprefix("bucket=")), int(v[2:])) for n in old]
    return sorted(gone)
