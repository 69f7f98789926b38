"""Incremental loads: a file stream whose micro-batches are merged into versioned state, and how fresh the state is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import duplicate_identities, merged


#: Parts that state is cut into by a hash of its keys; a micro-batch writes those that its keys fall into.
BUCKETS = 64


def _versions(spark: SparkSession, root: str, before: int | None = None) -> dict[int, int]:
    """The version that holds each bucket of the newest finished state (older than `before`, if given)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/versions")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    names = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v=")]
    done = [int(p.getName()[2:]) for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    done = [v for v in done if before is None or v < before]
    if not done:
        return {}
    rows = spark.read.schema("bucket int, version long").json(f"{root}/versions/v={max(done)}").collect()  # a row a bucket
    return {r.bucket: r.version for r in rows}


def _read(spark: SparkSession, root: str, versions: dict[int, int]) -> DataFrame:
    return spark.read.parquet(*[f"{root}/data/v={v}/bucket={b}" for b, v in sorted(versions.items())])


def state(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The newest state under root, or the one before a version; null where there is none."""
    versions = _versions(spark, root, before)
    return _read(spark, root, versions) if versions else None


def merge_stream(incoming: DataFrame, root: str, checkpoint: str, keys: list[str], substance: dict[str, str], id_col: str, pick: Callable[[DataFrame], DataFrame] | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Merges each micro-batch into the state under root, then moves on. Late rows are never dropped.

    State is cut into buckets by a hash of the keys. A batch reads and writes only the buckets that its keys fall into, as
    data/v=<batch>/bucket=<n>, and then names the version of every bucket in versions/v=<batch>. A batch that runs again
    overwrites its own version from those before it, so a restart changes nothing; buckets that no newer version names may be
    removed. `pick` makes a batch unique by keys; without it, a batch with an identity twice is refused. The number of
    buckets is fixed with the first batch.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = (pick(batch) if pick else batch).withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            if not pick and not duplicate_identities(rows, keys).isEmpty():
                raise ValueError("a batch holds an identity twice")
            versions = _versions(spark, root, number)
            touched = sorted(r[0] for r in rows.select("__bucket").distinct().collect())  # `buckets` numbers at most
            if not touched:
                return
            plain = rows.drop("__bucket")
            if known := {b: versions[b] for b in touched if b in versions}:
                table = _read(spark, root, known)
                live = table.where("superseded_by IS NULL").drop("superseded_by")
                after = merged(live, plain, keys, substance, F.lit(number), id_col).unionByName(table.where("superseded_by IS NOT NULL"))
            else:
                after = plain.withColumn(id_col, F.col(id_col).cast("string")).withColumn("superseded_by", F.lit(None).cast("string"))
            # a superseded row stays in the bucket of the row that replaced it
            own = [F.coalesce("superseded_by", k) if k == id_col else F.col(k) for k in keys]
            key_types = {k: batch.schema[k].dataType for k in keys}
            bucket = F.pmod(F.xxhash64(*[o.cast(key_types[k]) for o, k in zip(own, keys, strict=True)]), F.lit(buckets)).cast("int")
            after.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/v={number}")
            names = [(b, v) for b, v in (versions | dict.fromkeys(touched, number)).items()]
            spark.createDataFrame(names, "bucket int, version long").coalesce(1).write.mode("overwrite").json(f"{root}/versions/v={number}")
        finally:
            rows.unpersist()

    return incoming.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()


def freshness(runs: DataFrame, donations: DataFrame, key: str, now: Column, days: int = 45) -> DataFrame:
    """Per key of runs: the age in days of the last run and of the newest donation, and whether the run is stale."""
    r = runs.groupBy(key).agg(F.max("started_at").alias("last_run"))
    d = donations.groupBy(key).agg(F.max("date").alias("newest"))
    both = r.join(d, key, "left")
    age = F.datediff(now, F.col("last_run"))
    return both.select(key, age.alias("run_age_days"), F.datediff(now, F.col("newest")).alias("newest_age_days"), (~F.coalesce(age < days, F.lit(False))).alias("stale"))


def watermarks_after(watermarks: DataFrame, runs: DataFrame, key: str) -> DataFrame:
    """key and last_run after some runs (key, run_date, from_raw, truncated): a run that read only stored files, or stopped early, moves no watermark; none moves back."""
    done = runs.where(~F.coalesce("from_raw", F.lit(False)) & ~F.coalesce("truncated", F.lit(False))).select(key, F.col("run_date").alias("last_run"))
    return watermarks.select(key, "last_run").unionByName(done).groupBy(key).agg(F.max("last_run").alias("last_run"))


def read_from(watermarks: DataFrame, key: str, days: int = 550, floor: str = "2000-01-01") -> DataFrame:
    """key and min_date: where the next run of each key starts to read: so many days before its watermark, the floor where there is none."""
    start = F.lit(floor).cast("date")
    return watermarks.select(key, F.coalesce(F.greatest(F.date_sub("last_run", days), start), start).alias("min_date"))


def trailing_window(rows: DataFrame, date: str, watermark: Column, days: int = 550) -> DataFrame:
    """The rows that an incremental run reads again: filings arrive late, and the merge makes the overlap harmless."""
    return rows.where(F.col(date) >= F.greatest(F.date_sub(watermark, days), F.lit("2000-01-01").cast("date")))
