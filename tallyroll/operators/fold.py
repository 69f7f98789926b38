"""Records inserted one after the other, as one pass over a batch: each sees what those before it have done to the state.

Rows that may touch each other, by a shared identity or by a shared transaction id of one entity, are a group; a group's
rows are folded in their order over its stored rows. All groups are folded side by side. Only the stored rows of groups that
the batch touches are read into the fold; the others pass by it.

The order of decisions for a row: the stored row of its identity (record_uid and entity_slug); else, if it brings a
submission id, the one row stored under its transaction id from before such ids existed that agrees in committee, date and
amount, which takes over the new identity; else it is inserted. Two submission ids that differ are a collision, and so is a
committee that differs together with the amount: nothing is written. Something of SUBSTANCE that differs supersedes: the old
row stays under an id of its own that names the time. Otherwise nothing has changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from .merge import _cents, record_uid
from .shared import stored

#: Columns that make a record another version, and how they are compared.
SUBSTANCE = {"amount": "money", "date": "text", "recipient_committee_id": "text", "recipient_candidate_id": "text", "filing_id": "text", "image_number": "text"}
#: Columns that differ together in two records, not in two versions of one; and those in which a row without submission id has to agree.
GUARD, BRIDGE = ("recipient_committee_id", "amount"), ("recipient_committee_id", "date", "amount")
OUTCOMES = ("inserted", "unchanged", "superseded", "collision", "keyless")


def let(value: Column, body) -> Column:
    """body of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _plain(value: Column, kind: str) -> Column:
    """A value as it is compared: money in cents, else text, null and empty being one."""
    return F.coalesce((_cents(value) if kind == "money" else value).cast("string"), F.lit(""))


def components(edges: DataFrame, scope: str, a: str, b: str) -> DataFrame:
    """edges (scope, a, b; distinct) with grp: the least b that an edge is linked to through shared values of a and b in its scope."""
    rows = edges.withColumn("grp", F.col(b))
    if edges.groupBy(scope, a).agg(F.min(b).alias("x"), F.max(b).alias("y")).where("x <> y").isEmpty():
        return rows
    while True:
        rows = stored(rows, "components")
        after = rows.drop("grp").join(rows.groupBy(scope, a).agg(F.min("grp").alias("grp")), [scope, a])
        least = after.groupBy(scope, b).agg(F.min("grp").alias("grp"))
        after = stored(after.drop("grp").join(least, [scope, b]).select(*rows.columns), "components")
        if after.join(rows, rows.columns, "left_anti").isEmpty():
            return after
        rows = after


def _rows(incoming: DataFrame, columns: list[str]) -> DataFrame:
    """incoming as rows of the fold: what decides, and the place in the sequence."""
    place = F.struct("__order.*", F.xxhash64(*columns).alias("tie"))
    return incoming.select(F.struct(*columns).alias("row"), "record_uid", "transaction_id", "entity_slug", *_decisive(), place.alias("place"))


def _decisive() -> list[Column]:
    """The columns that decide, once as they are compared and once as they are."""
    plain = F.array(*[_plain(F.col(c), k) for c, k in SUBSTANCE.items()])
    return [blank_to_null(F.col("sub_id")).alias("sub"), plain.alias("plain"), F.struct(*BRIDGE).alias("exact")]


def _versions(rows: DataFrame) -> DataFrame:
    """A group's rows in sequence, where rows that equal the one right before them in all that decides are counted with it (repeats)."""
    own = Window.partitionBy("entity_slug", "grp").orderBy("place")
    decides = F.struct("record_uid", "transaction_id", "sub", "plain", "exact")
    runs = rows.withColumn("decides", decides).withColumn("new", (~F.col("decides").eqNullSafe(F.lag("decides").over(own))).cast("int")).withColumn("run", F.sum("new").over(own))
    first = F.struct("row", "record_uid", "transaction_id", "sub", "plain", "exact")
    runs = runs.groupBy("entity_slug", "grp", "run").agg(F.min("place").alias("place"), F.min_by(first, "place").alias("v"), (F.count("*") - 1).alias("repeats"))
    return runs.groupBy("entity_slug", "grp").agg(F.sort_array(F.collect_list(F.struct("place", "v", "repeats"))).alias("versions"))


def _step(state: Column, version: Column) -> Column:
    """How a group's live rows take the next version; rows are named by their places: stored ones from -1 down, versions from 0 up."""
    uid, txn = version["uid"], version["txn"]
    live = state["live"]
    legacy = F.filter(live, lambda s: (s["txn"] == txn) & (s["uid"] == txn) & s["sub"].isNull() & s["exact"].eqNullSafe(version["exact"]))
    old = let(
        F.get(F.filter(live, lambda s: s["uid"] == uid), F.lit(0)),
        lambda hit: F.when(hit.isNotNull(), F.struct(hit.alias("s"), F.lit(False).alias("adopted"))).otherwise(
            let(F.when(uid != txn, legacy), lambda found: F.when(F.size(found) == 1, F.struct(F.get(found, F.lit(0)).alias("s"), F.lit(True).alias("adopted")))),
        ),
    )

    def decide(had: Column) -> Column:
        mine, names = had["s"], F.array(*map(F.lit, SUBSTANCE))
        differs = F.when(had.isNotNull(), F.filter(names, lambda n, i: F.get(mine["plain"], i) != F.get(version["plain"], i)))
        return let(differs, lambda d: settle(had, d))

    def settle(had: Column, differs: Column) -> Column:
        sub = F.when(had["adopted"], version["sub"]).otherwise(had["s"]["sub"])
        collision = F.coalesce(sub != version["sub"], F.lit(False)) | (F.array_contains(differs, GUARD[0]) & F.array_contains(differs, GUARD[1]))
        outcome = F.when(had.isNull(), "inserted").when(collision, "collision").when(F.size(differs) > 0, "superseded").otherwise("unchanged")
        return let(outcome, lambda o: after(had, differs, sub, o))

    def after(had: Column, differs: Column, sub: Column, outcome: Column) -> Column:
        adopted, mine = F.coalesce(had["adopted"], F.lit(False)), had["s"]
        others = F.filter(live, lambda s: (s["uid"] != uid) & ~(adopted & (s["uid"] == txn)))
        stays = F.struct(uid.alias("uid"), mine["txn"].alias("txn"), sub.alias("sub"), mine["plain"].alias("plain"), mine["exact"].alias("exact"), mine["at"].alias("at"))
        comes = F.struct(uid.alias("uid"), txn.alias("txn"), version["sub"].alias("sub"), version["plain"].alias("plain"), version["exact"].alias("exact"), version["at"].alias("at"))
        replaced = outcome == "superseded"
        number = state["gone"] + replaced.cast("int")
        event = F.struct(outcome.alias("outcome"), differs.alias("differs"), adopted.alias("adopted"), F.when(replaced, mine["at"]).alias("old"), sub.alias("old_sub"), number.alias("number"))
        taken = F.when(replaced | (outcome == "inserted"), comes).otherwise(stays)
        return F.struct(F.array_append(others, taken).alias("live"), F.array_append(state["events"], event).alias("events"), number.alias("gone"))

    return let(old, decide)


def _under_one(keys: DataFrame) -> bool:
    """Whether each identity of an entity has one transaction id only."""
    own = ["entity_slug", "record_uid"]
    return keys.repartition(*own).distinct().groupBy(*own).agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def _groups(rows: DataFrame, live: DataFrame, keys: list[str]) -> DataFrame:
    """The group of each identity and transaction id of an entity that a batch touches."""
    new = rows.select(*keys).distinct()
    by_uid = live.join(new.select("entity_slug", "record_uid").distinct(), ["entity_slug", "record_uid"], "left_semi")
    by_txn = live.where(F.col("record_uid") == F.col("transaction_id")).join(new.select("entity_slug", "transaction_id").distinct(), ["entity_slug", "transaction_id"], "left_semi")
    edges = new.unionByName(by_uid.select(*keys)).unionByName(by_txn.select(*keys)).distinct()
    return components(edges, "entity_slug", "record_uid", "transaction_id")


def folded(current: DataFrame, incoming: DataFrame, order: list[Column], at: Column) -> DataFrame:
    """The groups that a batch touches, a row each: entity_slug, grp, live and old (arrays of rows of current's columns) and events.

    incoming has current's columns but those that the state adds (record_uid, superseded_by, superseded_reason); order puts
    it in sequence, rows that tie go by their contents. Use it through `state_after` and `events_of`; it is a stored table.
    """
    columns, at = current.columns, at.cast("string")
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    rows = _rows(with_identity(incoming.withColumn("__order", place), current, "__order").where(_named()), columns)
    keys = ["entity_slug", "record_uid", "transaction_id"]
    live = current.where("superseded_by IS NULL")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine = lambda x: x.select("entity_slug", "grp", F.struct(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "record_uid", "transaction_id", *_decisive()).alias("v"))
    if _under_one(rows.select(*keys).unionByName(live.select(*keys))):
        # no identity has two transaction ids: these are the groups, and nothing is joined to find them
        grouped = rows.withColumn("grp", F.col("transaction_id"))
        stored_rows = mine(live.withColumn("grp", F.col("transaction_id"))).join(grouped.select("entity_slug", "grp").distinct(), ["entity_slug", "grp"], "left_semi")
    else:
        groups = _groups(rows, live, keys)
        grouped, stored_rows = rows.join(groups, keys), mine(live.join(groups, keys))
    # a batch of versions that are much alike is small when compressed: as many tasks as a shuffle has, not as few as its bytes ask for
    both = _versions(grouped.repartition(tasks, "entity_slug", "grp")).join(stored_rows.groupBy("entity_slug", "grp").agg(F.sort_array(F.collect_list("v"), asc=True).alias("mine")), ["entity_slug", "grp"], "left")

    exact = rows.schema["exact"].dataType.simpleString()
    live_type = f"array<struct<uid:string,txn:string,sub:string,plain:array<string>,exact:{exact},at:int>>"
    event_type = "array<struct<outcome:string,differs:array<string>,adopted:boolean,old:int,old_sub:string,number:int>>"
    narrow = lambda v, i: F.struct(v["record_uid"].alias("uid"), v["transaction_id"].alias("txn"), v["sub"].alias("sub"), v["plain"].alias("plain"), v["exact"].alias("exact"), i.cast("int").alias("at"))
    begin = F.struct(F.coalesce(F.transform("mine", lambda v, i: narrow(v, -1 - i)), F.array()).cast(live_type).alias("live"), F.array().cast(event_type).alias("events"), F.lit(0).alias("gone"))
    taken = F.aggregate(F.transform("versions", lambda x, i: narrow(x["v"], i)), begin, _step)
    # most groups are one row that nothing is stored of: it is inserted
    event = F.struct(F.lit("inserted").alias("outcome"), F.lit(None).alias("differs"), F.lit(False).alias("adopted"), F.lit(None).alias("old"), F.lit(None).alias("old_sub"), F.lit(0).alias("number"))
    lone = F.struct(F.array(narrow(F.get("versions", F.lit(0))["v"], F.lit(0))).cast(live_type).alias("live"), F.array(event).cast(event_type).alias("events"), F.lit(0).alias("gone"))
    done = both.withColumn("s", F.when(F.col("mine").isNull() & (F.size("versions") == 1), lone).otherwise(taken))

    def row(at: Column) -> Column:
        return F.when(at < 0, F.get(F.col("mine"), -1 - at)["row"]).otherwise(F.get(F.col("versions"), at)["v"]["row"])

    def archived(e: Column, i: Column) -> Column:
        txn = F.get(F.col("versions"), i)["v"]["transaction_id"]
        name = F.concat(txn, F.lit("~superseded~"), at, F.when(e["number"] > 1, F.concat(F.lit("~"), e["number"].cast("string"))).otherwise(""))
        return F.when(e["outcome"] == "superseded", row(e["old"]).withField("transaction_id", name).withField("record_uid", name).withField("sub_id", e["old_sub"]).withField("status", F.lit("SUPERSEDED")).withField("superseded_by", txn).withField("superseded_reason", _reason(e)))

    def shown(e: Column, i: Column) -> Column:
        x = F.get(F.col("versions"), i)
        return F.struct(x["place"].alias("place"), x["v"]["record_uid"].alias("record_uid"), x["v"]["transaction_id"].alias("transaction_id"), e["outcome"].alias("outcome"), _reason(e).alias("reason"), e["adopted"].alias("adopted"), x["repeats"].alias("repeats"))

    # all that follows reads the groups several times: they are folded once
    out = done.select(
        "entity_slug",
        "grp",
        F.transform("s.live", lambda l: let(row(l["at"]), lambda r: F.when(r["record_uid"] == l["uid"], r).otherwise(r.withField("record_uid", l["uid"]).withField("sub_id", l["sub"])))).alias("live"),
        F.array_compact(F.transform("s.events", archived)).alias("old"),
        F.transform("s.events", shown).alias("events"),
    )
    return stored(out, "folded")


def _reason(e: Column) -> Column:
    listed = F.array_join(e["differs"], ", ")
    return F.when(e["outcome"] == "superseded", F.concat(F.lit("restated: "), listed)).when(e["outcome"] == "collision", F.concat(F.lit("not a restatement: "), listed))


def with_identity(incoming: DataFrame, current: DataFrame, *more: str) -> DataFrame:
    """incoming in current's columns and types, each row under its identity; columns that it lacks are null."""
    rows = incoming.withColumn("record_uid", record_uid(F.col("sub_id") if "sub_id" in incoming.columns else F.lit(None).cast("string"), F.col("transaction_id")))
    return rows.select(*[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in current.schema.fields], *more)


def _named() -> Column:
    return F.col("record_uid").isNotNull() & F.col("transaction_id").isNotNull() & F.col("entity_slug").isNotNull()


def moved_by(done: DataFrame) -> DataFrame:
    """The rows of the next state that the fold has had in hand, live and superseded."""
    return done.select(F.explode(F.concat("live", "old")).alias("r")).select("r.*")


def state_after(current: DataFrame, done: DataFrame) -> DataFrame:
    """The next state: the rows of groups that weren't touched, and those of the fold, live and superseded."""
    was = done.select("entity_slug", F.explode("live").alias("r")).select("r.*")
    old = done.select(F.explode("old").alias("r")).select("r.*")
    # a group's stored rows are among its live ones, or were superseded, or adopted into another identity
    touched = was.select("entity_slug", "record_uid").unionByName(done.select("entity_slug", F.explode("events").alias("e")).where("e.adopted").select("entity_slug", F.col("e.transaction_id").alias("record_uid"))).distinct()
    return current.join(touched, ["entity_slug", "record_uid"], "left_anti").select(*current.columns).unionByName(was).unionByName(old)


def events_of(incoming: DataFrame, done: DataFrame) -> DataFrame:
    """What became of each version of the batch: entity_slug, record_uid, transaction_id, outcome, reason, adopted, repeats (equal rows right after it, which change nothing). Rows without identity are `keyless`: nothing is written of them."""
    rows = done.select("entity_slug", F.explode("events").alias("e")).select("entity_slug", "e.record_uid", "e.transaction_id", "e.outcome", "e.reason", "e.adopted", "e.repeats")
    loose = with_identity(incoming, incoming.withColumn("record_uid", F.lit("")).limit(0)).where(~_named())
    none = loose.groupBy("entity_slug", "record_uid", "transaction_id").agg(F.count("*").alias("n"))
    return rows.unionByName(none.select("entity_slug", "record_uid", "transaction_id", F.lit("keyless").alias("outcome"), F.lit("no identity").alias("reason"), F.lit(False).alias("adopted"), (F.col("n") - 1).alias("repeats")))
