"""Sequential inserts, the versioned store and runs that are committed whole."""

import datetime
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyroll.operators import fold
from tallyroll.streaming import runs, store

ROW = "transaction_id string, sub_id string, record_uid string, entity_slug string, parent_owner_slug string, contributor_name_raw string, amount decimal(18,2), date date, recipient_committee_id string, recipient_candidate_id string, filing_id string, image_number string, is_individual boolean, status string, superseded_by string, superseded_reason string"
NAMES = [c.split(" ")[0] for c in ROW.split(", ")]


def _row(txn, sub=None, slug="a", amount=1, day=1, committee="C1", filing="F", **more):
    return {n: None for n in NAMES} | dict(transaction_id=txn, sub_id=sub, entity_slug=slug, contributor_name_raw="N", amount=Decimal(amount), date=datetime.date(2020, 1, day), recipient_committee_id=committee, filing_id=filing, status="CONFIRMED") | more


def _uid(r):
    return (r["sub_id"] or "").strip() or r["transaction_id"]


def _frame(spark, rows, numbered=False):
    data = [tuple(r[n] for n in NAMES) + ((i,) if numbered else ()) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, ROW + (", n int" if numbered else ""))


def _plain(r, c):
    return "" if r[c] is None else f"{r[c]:.2f}" if c == "amount" else str(r[c])


def _one_by_one(stored, arriving):
    """The decisions of an insert, a row at a time."""
    live, old, events = {(r["record_uid"], r["entity_slug"]): dict(r) for r in stored}, [], []
    for r in arriving:
        u, t, s = _uid(r), r["transaction_id"], r["entity_slug"]
        r = dict(r, record_uid=u)
        had, adopted = live.get((u, s)), False
        if had is None and u != t:
            fits = [x for (k, o), x in live.items() if o == s and k == t == x["transaction_id"] and not (x["sub_id"] or "").strip() and all(x[c] == r[c] for c in fold.BRIDGE)]
            if len(fits) == 1:
                had = live.pop((t, s))
                had |= {"record_uid": u, "sub_id": r["sub_id"]}
                live[(u, s)], adopted = had, True
        differs = [c for c in fold.SUBSTANCE if had and _plain(had, c) != _plain(r, c)]
        a, b = ((x or {}).get("sub_id") or "" for x in (had, r))
        if had is None:
            outcome = "inserted"
        elif a.strip() and b.strip() and a.strip() != b.strip() or {"recipient_committee_id", "amount"} <= set(differs):
            outcome = "collision"
        else:
            outcome = "superseded" if differs else "unchanged"
        if outcome == "superseded":
            old.append(had)
        if outcome in ("inserted", "superseded"):
            live[(u, s)] = r
        events.append((s, u, t, outcome, adopted))
    return live, old, events


def _random(r, n):
    out = []
    for _ in range(n):
        t = f"T{r.randrange(9)}"
        out.append(_row(t, r.choice([None, "", " ", f"S{t}", f"S{t}", "SX"]), r.choice("ab"), r.randrange(1, 3), r.randrange(1, 3), r.choice(["C1", None, "C2"]), r.choice("FG")))
    return out


def _key(r):
    return tuple(_plain(r, c) for c in ("record_uid", "entity_slug", *fold.SUBSTANCE))


def test_fold_inserts_as_one_by_one(spark):
    r = random.Random(11)
    stored = list({(_uid(x), x["entity_slug"]): x | {"record_uid": _uid(x)} for x in _random(r, 12)}.values())
    arriving = _random(r, 260)
    # one identity in 25 versions, which a row with a submission id takes over in the middle
    arriving += [_row("LONG", "SL" if k > 12 else None, amount=1 + (k if k != 13 else 12)) for k in range(25)]
    arriving += [_row(None, None), _row(None, "  "), _row("T", None, slug=None)]
    incoming = _frame(spark, arriving, True).drop("record_uid", "superseded_by", "superseded_reason").repartition(3)
    current = _frame(spark, stored)
    done = fold.folded(current, incoming, [F.col("n")], F.lit("t")).persist()
    live, old, want = _one_by_one(stored, arriving[:-3])
    got = Counter()
    for e in fold.events_of(incoming, done).collect():
        got[(e.entity_slug, e.record_uid, e.transaction_id, e.outcome, e.adopted)] += 1
        if e.repeats:
            again = e.outcome if e.outcome in ("collision", "keyless") else "unchanged"
            got[(e.entity_slug, e.record_uid, e.transaction_id, again, False)] += e.repeats
    assert sum(n for k, n in got.items() if k[3] == "keyless") == 3
    assert {k: n for k, n in got.items() if k[3] != "keyless"} == dict(Counter(want))
    assert ("a", "SL", "LONG", "unchanged", True) in got and sum(n for k, n in got.items() if k[4]) > 1
    rows = [x.asDict() for x in fold.state_after(current, done).collect()]
    assert sorted(_key(x) for x in rows if not x["superseded_by"]) == sorted(_key(x) for x in live.values())
    gone = [x for x in rows if x["superseded_by"]]
    assert len(gone) == len(old) and all(x["status"] == "SUPERSEDED" for x in gone)
    assert len({(x["record_uid"], x["entity_slug"]) for x in rows}) == len(rows)
    done.unpersist()


def test_fold_of_nothing(spark):
    current = _frame(spark, [_row("T", record_uid="T")])
    none = _frame(spark, [], True)
    done = fold.folded(current, none, [F.col("n")], F.lit("t"))
    assert fold.events_of(none, done).isEmpty() and fold.state_after(current, done).count() == 1
    one = _frame(spark, [_row("T", amount=2)], True)
    done = fold.folded(current.limit(0), one, [F.col("n")], F.lit("t"))
    assert [e.outcome for e in fold.events_of(one, done).collect()] == ["inserted"]


def _lines(df, *cols):
    return sorted(tuple(str(v) for v in r) for r in df.select(*cols).collect()) if df is not None else []


def test_runs_are_published_whole(spark, tmp_path, monkeypatch):
    """A run that fails between any two writes leaves no trace, and running it again gives what an undisturbed one gives."""
    r, schema = random.Random(4), _frame(spark, [])
    batches = [_random(r, 60), [_row("T1", "ELSE", "a"), _row("T2", "ST1", "a"), *_random(r, 40)]]
    ran = [spark.createDataFrame([("a", datetime.date(2020, 1, k + 1), False, False)], "key string, run_date date, from_raw boolean, truncated boolean") for k in range(2)]

    def run(root, k):
        rows = _frame(spark, batches[k], True)
        queue = rows.where("amount = 2").select("transaction_id", "entity_slug", F.lit("look").alias("reason"))
        runs.commit_run(spark, root, k, schema, rows, [F.col("n")], F.lit(f"t{k}"), queue, ran[k], buckets=5)

    def seen(root):
        return {t: _lines(df, *sorted(set(df.columns) - {"bucket"})) if (df := store.read(spark, root, t)) is not None else None for t in (runs.STATE, runs.EVENTS, runs.QUEUE, runs.WATERMARKS, runs.IDENTITIES, runs.PLACES)}

    calm, rough = f"file://{tmp_path}/calm", f"file://{tmp_path}/rough"
    real, publish = store._written, store.publish
    for k in range(2):
        before = seen(rough)
        for fail_at in (0, 3, 6) if k == 1 else ():
            count = iter(range(99))

            def failing(*args, count=count, fail_at=fail_at):
                if next(count) == fail_at:
                    raise OSError("lost")
                return real(*args)

            def never(*args):
                raise OSError("lost")

            monkeypatch.setattr(store, "_written", failing)
            monkeypatch.setattr(store, "publish", never if fail_at == 6 else publish)
            with pytest.raises(OSError):
                run(rough, k)
            monkeypatch.setattr(store, "_written", real)
            monkeypatch.setattr(store, "publish", publish)
            if fail_at in (0, 6):
                assert seen(rough) == before
        run(calm, k)
        run(rough, k)
        assert seen(rough) == seen(calm)
    live, old, events = {}, [], []
    for b in batches:
        live, gone, happened = _one_by_one(live.values(), b)
        old, events = old + gone, events + happened
    rows = [x.asDict() for x in runs.state(spark, calm).collect()]
    assert sorted(_key(x) for x in rows if not x["superseded_by"]) == sorted(_key(x) for x in live.values()) and len(rows) == len(live) + len(old)
    log = store.read(spark, calm, runs.EVENTS)
    assert log.agg(F.sum(F.col("repeats") + 1)).first()[0] == len(events)
    assert [x.last_run for x in store.read(spark, calm, runs.WATERMARKS).collect()] == [datetime.date(2020, 1, 2)]
    assert store.read(spark, calm, runs.QUEUE).groupBy("transaction_id", "entity_slug").count().where("count > 1").isEmpty()


def test_old_versions_go(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    one = spark.range(40).select("id", F.lit(0).alias("v"))
    store.commit(spark, root, 0, {"t": store.Write(one, ("id",), buckets=4), "log": store.Write(one, ("id",), "append", 2)})
    for k in range(1, 6):
        bucket = store.bucket_of(["id"], 4)
        rows = one.where(bucket == k % 4).withColumn("v", F.lit(k))
        store.commit(spark, root, k, {"t": store.Write(rows, ("id",), buckets=4, touched=(k % 4,)), "log": store.Write(rows, ("id",), "append", 2)})
    store._written(spark, root, "t", 9, store.Write(one, ("id",), buckets=4))  # a run that isn't finished
    before = [_lines(store.read(spark, root, t, version=v), "id", "v") for t in ("t", "log") for v in (4, 5)]
    counts = store.references(spark, root, 2)
    gone = store.prune(spark, root, 2)
    assert gone and not set(gone) & set(counts) and all(v <= 5 for _, _, v in gone)
    assert store.versions(spark, root) == [4, 5]
    assert [_lines(store.read(spark, root, t, version=v), "id", "v") for t in ("t", "log") for v in (4, 5)] == before
    assert (tmp_path / "store/data/t/v=9").exists() and store.prune(spark, root, 2) == []
    store.compact(spark, root, 6, "log", ("id",))
    assert _lines(store.read(spark, root, "log"), "id", "v") == before[3] and {p.version for p in store.parts(spark, root) if p.table == "log"} == {6}
    with pytest.raises(ValueError):
        store.prune(spark, root, 0)


def test_state_of_three_schemas_reads_as_one(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    steps = (store.add("office", "string"), store.rename("cash", "amount"), store.retype("amount", "decimal(18,2)"), store.fill("office", F.lit("none")))
    rows = spark.range(30).select("id", F.concat(F.col("id").cast("string"), F.lit(".50")).alias("cash"))
    every = lambda k: store.bucket_of(["id"], 3) == k
    for k, done in enumerate((0, 2, 4)):
        part = store.migrated(rows.where(every(k)), steps[:done])
        store.commit(spark, root, k, {"t": store.Write(part, ("id",), buckets=3, touched=(k,))}, {"t": done})
    out = store.read(spark, root, "t", steps=steps).drop("bucket")
    assert dict(out.dtypes) == {"id": "bigint", "amount": "decimal(18,2)", "office": "string"}
    assert _lines(out, "id", "amount", "office") == sorted((str(i), f"{i}.50", "none") for i in range(30))
    store.compact(spark, root, 3, "t", ("id",), steps)
    assert {p.steps for p in store.parts(spark, root)} == {4} and _lines(store.read(spark, root, "t", steps=steps), "id", "amount", "office") == _lines(out, "id", "amount", "office")


def test_household_is_replaced_in_its_buckets(spark, tmp_path):
    root, schema = f"file://{tmp_path}/store", _frame(spark, [])
    rows = [_row(f"T{k}", f"S{k}", f"e{k % 20}", amount=k, parent_owner_slug="e1" if k % 20 == 2 else None) for k in range(60)]
    queue = spark.createDataFrame([("T1", "e1", "old"), ("T3", "e3", "old")], "transaction_id string, entity_slug string, reason string")
    runs.commit_run(spark, root, 0, schema, _frame(spark, rows, True), [F.col("n")], F.lit("t"), queue, buckets=32)
    new = [_row("N1", "S901", "e1", is_individual=False, record_uid="S901"), _row("N2", "S902", "e1", is_individual=True, record_uid="S902")]
    slugs = spark.createDataFrame([("e1",)], "entity_slug string")
    again = spark.createDataFrame([("N9", "e1", "new")], "transaction_id string, entity_slug string, reason string")
    read = runs.households_replaced(spark, root, 1, slugs, _frame(spark, new), again)
    assert 0 < len(read) <= 8 < 32  # six stored rows and two new ones
    got = runs.state(spark, root)
    assert got.where("coalesce(parent_owner_slug, entity_slug) = 'e1'").count() == 2 and got.count() == 56
    assert _lines(store.read(spark, root, runs.QUEUE), "transaction_id", "reason") == [("N9", "new"), ("T3", "old")]
    counted = {r.transaction_id: r.counted for r in runs.with_counted(got).collect()}
    assert counted["N1"] is False and counted["N2"] is True and all(v for k, v in counted.items() if k != "N1")
    back = runs.households_replaced(spark, root, 2, slugs, _frame(spark, []))
    assert set(back) <= set(read) and runs.state(spark, root).count() == 54


def test_groups_are_folded_once(spark):
    from tallyroll.plans import queries  # noqa: F401  registers the queries of runs
    from tallyroll.plans import runs as made

    current = made._stored(spark, "/root/testdata/sf0.001")
    done = fold.folded(current, made._versions(spark, "/root/testdata/sf0.001"), [F.col("n")], F.lit("t"))
    after = fold.state_after(current, done)
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "folded-" in str(done.inputFiles())


def test_groups_are_joined_only_where_an_identity_has_two_transaction_ids(spark, monkeypatch):
    one = _frame(spark, [_row("T", "S"), _row("U")], True)
    real, asked = fold._groups, []
    monkeypatch.setattr(fold, "_groups", lambda *a: asked.append(1) or real(*a))
    for rows, times in ((one, 0), (_frame(spark, [_row("T", "S"), _row("U", "S")], True), 1)):
        done = fold.folded(_frame(spark, [_row("T", record_uid="T"), _row("V", record_uid="V")]), rows, [F.col("n")], F.lit("t"))
        assert len(asked) == times and fold.state_after(_frame(spark, [_row("T", record_uid="T"), _row("V", record_uid="V")]), done).where("transaction_id = 'V'").count() == 1


def test_a_large_bucket_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    root, rows = f"file://{tmp_path}/store", spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        store.commit(spark, root, 0, {"t": store.Write(rows, ("id",), buckets=2)})
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    out = store.read(spark, root, "t")
    assert len(out.inputFiles()) > 2 and out.count() == 60_000
