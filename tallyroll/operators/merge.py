"""Keyed state as DataFrames: merges give the next state and what happened, and write nothing themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null


def record_uid(sub_id: Column, transaction_id: Column) -> Column:
    """The identity of a record: its submission id where it has one, else its transaction id."""
    return F.coalesce(blank_to_null(sub_id), transaction_id)


def _cents(col: Column) -> Column:
    return F.round(col.cast("decimal(18,4)") * 100).cast("long")


def _same(a: Column, b: Column, kind: str) -> Column:
    """Equal as cents for money, else as text, where null and empty are one."""
    if kind == "money":
        return _cents(a).eqNullSafe(_cents(b))
    return F.coalesce(a.cast("string"), F.lit("")) == F.coalesce(b.cast("string"), F.lit(""))


def merge_events(current: DataFrame, incoming: DataFrame, keys: list[str], substance: dict[str, str], guard: tuple[str, str] | None = None, sub_id: str | None = None) -> DataFrame:
    """What becomes of each row of either side, both unique by keys: columns keys, cur, inc (whole rows) and outcome.

    outcome: kept (only current), inserted (only incoming), collision (two submission ids, or both guard columns differ),
    superseded (something of substance differs) or unchanged. substance maps columns to "money" or "text". An incoming row
    without one of the keys is an error: it would be added again by each batch.
    """
    cur = current.select(*keys, F.struct(*current.columns).alias("cur"))
    nameless = F.raise_error(F.lit(f"a record without {' or '.join(keys)} can't be merged"))
    named = [F.coalesce(F.col(k), nameless.cast(incoming.schema[k].dataType)).alias(k) for k in keys]
    inc = incoming.select(*named, F.struct(*incoming.columns).alias("inc"))
    both = cur.join(inc, keys, "full")
    c, i = lambda n: F.col(f"cur.{n}"), lambda n: F.col(f"inc.{n}")
    same = {n: _same(c(n), i(n), kind) for n, kind in substance.items()}
    collision = F.lit(False)
    if sub_id:
        a, b = blank_to_null(c(sub_id)), blank_to_null(i(sub_id))
        collision = collision | F.coalesce(a != b, F.lit(False))
    if guard:
        collision = collision | (~same[guard[0]] & ~same[guard[1]])
    unchanged = F.lit(True)
    for s in same.values():
        unchanged = unchanged & s
    outcome = F.when(F.col("inc").isNull(), "kept").when(F.col("cur").isNull(), "inserted").when(collision, "collision").when(unchanged, "unchanged").otherwise("superseded")
    return both.withColumn("outcome", outcome)


def merged(current: DataFrame, incoming: DataFrame, keys: list[str], substance: dict[str, str], at: Column, id_col: str, guard: tuple[str, str] | None = None, sub_id: str | None = None) -> DataFrame:
    """The next state: current columns and superseded_by. Replaced versions stay under an id of their own that names the time."""
    events = merge_events(current, incoming, keys, substance, guard, sub_id)
    new = events.where("outcome IN ('inserted', 'superseded')").select("inc.*").withColumn("superseded_by", F.lit(None).cast("string"))
    stay = events.where("outcome IN ('kept', 'unchanged', 'collision')").select("cur.*").withColumn("superseded_by", F.lit(None).cast("string"))
    old = events.where("outcome = 'superseded'").select("cur.*").withColumn("superseded_by", F.col(id_col).cast("string"))
    old = old.withColumn(id_col, F.concat(F.col(id_col).cast("string"), F.lit("~superseded~"), at.cast("string")))
    return new.unionByName(stay).withColumn(id_col, F.col(id_col).cast("string")).unionByName(old)


def adopted(current: DataFrame, incoming: DataFrame, order: Column, exact: tuple[str, ...] = ("recipient_committee_id", "date", "amount")) -> DataFrame:
    """current, where rows from before submission ids existed take over the identity of the incoming row that they are.

    Such a row has no sub_id, is keyed by its transaction id and agrees with the incoming row in owner, transaction id and the
    columns `exact` (null equals null). An incoming row whose identity is stored already, or that fits several, adopts none;
    of several that fit one row, the first in `order` adopts it. Both tables have record_uid, sub_id, transaction_id and
    entity_slug.
    """
    keys = ["record_uid", "entity_slug"]
    new = incoming.where(F.col("record_uid") != F.col("transaction_id")).join(current.select(*keys).distinct(), keys, "left_anti")
    new = new.select("transaction_id", "entity_slug", *[F.col(c).alias(f"__{c}") for c in exact], F.col("record_uid").alias("__uid"), F.col("sub_id").alias("__sub"), order.alias("__order"))
    old = current.where(blank_to_null(F.col("sub_id")).isNull() & (F.col("record_uid") == F.col("transaction_id")))
    agree = [F.col(f"__{c}").eqNullSafe(F.col(c)) for c in exact]
    pairs = new.join(old.select("transaction_id", "entity_slug", *exact, F.col("record_uid").alias("__old")), ["transaction_id", "entity_slug"])
    for a in agree:
        pairs = pairs.where(a)
    # a stored row is unique by record_uid and owner, so an incoming row fits one at most; the first in order takes it
    taken = pairs.groupBy(F.col("__old").alias("record_uid"), "entity_slug").agg(F.min_by(F.struct("__uid", "__sub"), F.col("__order")).alias("__take"))
    rows = current.join(taken, keys, "left")
    return rows.withColumns({"record_uid": F.coalesce("__take.__uid", "record_uid"), "sub_id": F.coalesce("__take.__sub", "sub_id")}).select(*current.columns)


def in_rounds(incoming: DataFrame, keys: list[str], order: list[Column], most: int = 16) -> list[DataFrame]:
    """A batch as batches that are unique by keys: the first rows of each identity, then the second ones, and so on.

    Merged one after the other, each row sees the effect of those before it. Rows that repeat an earlier one entirely change
    nothing and are left out. More than `most` versions of one identity are refused: such a batch is no batch.
    """
    rows = incoming.dropDuplicates().withColumn("__round", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    last = rows.agg(F.max("__round")).first()[0] or 0
    if last > most:
        raise ValueError(f"an identity occurs in {last} versions")
    return [rows.where(F.col("__round") == r).drop("__round") for r in range(1, last + 1)]


def in_sequence(current: DataFrame, incoming: DataFrame, key: str, substance: dict[str, str], order: list[Column], at: Column, prefix: str) -> tuple[DataFrame, DataFrame]:
    """A batch inserted row by row over the stored rows of its keys: the next state of these keys, and an event a row.

    Each row is held against the row before it in `order` (the stored live one comes first, ties go by contents): equal in
    substance, it changes nothing; else it takes the place of that row, which stays under the key, the time and, from the
    second one on, its number. Both sides have the same columns, superseded_by and superseded_reason among them; current may
    hold other keys, which stay as they are. Events: the incoming row's columns and outcome (inserted, unchanged or
    superseded). A window over each key sorts its rows; none is collected.
    """
    columns, named = current.columns, [o.alias(f"o{i}") for i, o in enumerate(order)]
    plain = [c for c, t in current.dtypes if "map<" not in t]
    rows = current.where("superseded_by IS NULL").select(*columns).withColumn("__place", F.struct(F.lit(0).alias("phase"), F.lit(None).cast(incoming.select(F.struct(*named)).schema[0].dataType).alias("o"), F.lit(0).cast("long").alias("tie")))
    rows = rows.unionByName(incoming.select(*columns, F.struct(F.lit(1).alias("phase"), F.struct(*named).alias("o"), F.xxhash64(*plain).alias("tie")).alias("__place")))
    own = Window.partitionBy(key).orderBy("__place")
    same = F.array(*[F.coalesce((_cents(F.col(c)) if kind == "money" else F.col(c)).cast("string"), F.lit("")) for c, kind in substance.items()])
    rows = rows.withColumn("__plain", same).withColumns({"__before": F.lag("__plain").over(own), "__arrives": F.max(F.col("__place.phase")).over(Window.partitionBy(key)) == 1})
    rows = rows.withColumn("outcome", F.when(F.col("__place.phase") == 0, "stored").when(F.col("__before").isNull(), "inserted").when(F.col("__before") == F.col("__plain"), "unchanged").otherwise("superseded"))
    events = rows.where("outcome <> 'stored'").select(*columns, "outcome")
    kept = rows.where("outcome <> 'unchanged'").withColumns({"__after": F.lead("__plain").over(own), "__number": F.row_number().over(own)})
    differs = F.array_join(F.filter(F.array(*map(F.lit, substance)), lambda n, i: F.get("__plain", i) != F.get("__after", i)), ", ")
    # stored rows of other keys go along, which is less than to find them by joins; they come out as they are
    gone = F.col("__after").isNotNull() & F.col("__arrives")
    name = F.concat(F.col(key), F.lit("~superseded~"), at.cast("string"), F.when(F.col("__number") > 1, F.concat(F.lit("~"), F.col("__number").cast("string"))).otherwise(""))
    after = {"superseded_by": F.when(gone, F.col(key)), "superseded_reason": F.when(gone, F.concat(F.lit(prefix), differs)), "status": F.when(gone, F.lit("SUPERSEDED")).otherwise(F.col("status")), key: F.when(gone, name).otherwise(F.col(key))}
    new = kept.select(*[after.get(c, F.col(f"`{c}`")).alias(c) for c in columns])
    return current.where("superseded_by IS NOT NULL").unionByName(new), events


def carried(current: DataFrame, incoming: DataFrame, keys: list[str], curated: list[str]) -> DataFrame:
    """incoming with the curated columns of current: replacing a row doesn't lose what people have written into it."""
    kept = current.select(*keys, *[F.col(c).alias(f"__{c}") for c in curated])
    rows = incoming.join(kept, keys, "left")
    own = lambda c: F.coalesce(f"__{c}", c) if c in incoming.columns else F.col(f"__{c}")
    return rows.withColumns({c: own(c) for c in curated}).drop(*[f"__{c}" for c in curated])


def backfilled(current: DataFrame, raw: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """current with missing (null or blank) values of the columns taken from raw, which is unique by keys; what is there stays."""
    found = raw.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    missing = lambda c: F.col(c).isNull() | (F.btrim(F.col(c).cast("string")) == "")
    rows = current.join(found, keys, "left")
    return rows.withColumns({c: F.when(missing(c), F.coalesce(f"__{c}", c)).otherwise(F.col(c)) for c in columns}).select(*current.columns)


def backlog(wanted: DataFrame, fetched: DataFrame, tombstones: DataFrame, key: str, at: str, now: Column, days: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """What to fetch in this run and what is deferred: keys without a tombstone that are stale (or were never fetched), the stalest first."""
    due = wanted.select(key).distinct().join(tombstones.select(key), key, "left_anti").join(fetched.groupBy(key).agg(F.max(at).alias("last")), key, "left")
    due = due.where(F.col("last").isNull() | (F.datediff(now, F.col("last")) >= days))
    taken = due.orderBy(F.asc_nulls_first("last"), key).limit(budget)
    return taken, due.join(taken.select(key), key, "left_anti")


def tombstones_after(tombstones: DataFrame, failed: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The tombstones after a run: those of keys that were fetched go, failed ones are added, older ones keep their record."""
    return insert_ignore(tombstones.join(done.select(key), key, "left_anti"), failed, [key])


def buckets_merged(base: DataFrame, buckets: list[DataFrame], slug: str = "entity_slug", owner: str = "parent_owner_slug") -> DataFrame:
    """base with the households that the buckets have run replaced by the buckets' rows; refuses buckets that share one."""
    house = F.coalesce(owner, slug)
    parts = [b.select("*", house.alias("__house"), F.lit(i).alias("__bucket")) for i, b in enumerate(buckets)]
    if not parts:
        return base
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    if not rows.groupBy("__house").agg(F.countDistinct("__bucket").alias("n")).where("n > 1").isEmpty():
        raise ValueError("two buckets hold one household")
    ran = rows.select("__house").distinct()
    return base.withColumn("__house", house).join(ran, "__house", "left_anti").select(*base.columns).unionByName(rows.select(*base.columns))


def collisions_repaired(queue: DataFrame, resolutions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The queue without items that are gone for good (a resolution stands), and the resolutions whose item is gone."""
    keys = [key, "entity_slug"]
    return queue.join(resolutions.select(*keys).distinct(), keys, "left_anti"), resolutions.join(queue.select(*keys).distinct(), keys, "left_anti")


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows win over current ones of the same keys."""
    return current.join(incoming.select(*keys).distinct(), keys, "left_anti").select(*current.columns).unionByName(incoming.select(*current.columns))


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows win; incoming rows with new keys are added."""
    return current.unionByName(incoming.join(current.select(*keys).distinct(), keys, "left_anti").select(*current.columns))


def replace_children(current: DataFrame, incoming: DataFrame, parent: str) -> DataFrame:
    """All rows of the parents that arrive are replaced by the arriving ones."""
    return upsert(current, incoming, [parent])


def duplicate_identities(incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that one batch has more than once: to be shown, not settled by chance."""
    return incoming.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def evolved(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with the columns of a later schema: those it lacks are null; the rest keep their values."""
    return df.select(*df.columns, *[F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns])
