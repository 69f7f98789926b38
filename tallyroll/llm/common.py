"""Helpers that the operators of this package share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes (as JSON) a lookup table may have to be broadcast; beyond either the salted join is used.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
SALTS = 16
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset and all runs on one machine (tests)."""
    if at := spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(at)
        return at
    if not (at := spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{own}")
        at = spark.sparkContext.getCheckpointDir()
    return at


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, in a session that hands Python workers at most ARROW_ROWS rows at a time: rows hold whole texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read again: its lineage ends here, and each row is decided once."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def digest(*cols: Column) -> Column:
    """128 bits of hash as struct<a,b>."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(0x5EED), *cols).alias("b"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table is small enough to be broadcast; only tables of few rows are measured."""
    if df.count() > rows:
        return False
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= BROADCAST_BYTES


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, salt_by: list[str], bound: int = BROADCAST_ROWS) -> DataFrame:
    """left join right, whose rows are already stored.

    Broadcasts right if it has at most `bound` rows of at most BROADCAST_BYTES together. Otherwise copies each of its rows to SALTS salts, so that a key with
    a third of left's rows goes to SALTS tasks. The copies are never broadcast: Spark judges them by the size of the one table
    that they are made from, and would build SALTS times as much in the driver.
    """
    if small(right, bound):
        return left.join(F.broadcast(right), keys, how)
    salted = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = left.withColumn("__salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int"))
    return left.join(salted.hint("merge"), [*keys, "__salt"], how).drop("__salt")


def words(text: Column) -> Column:
    """Lower-case words (runs of letters, marks and digits) of a text; null gives none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")
