"""Members of archives, names within texts, ranks over ranges, and rules that one-sided data can't show."""

import csv
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyroll.functions import text
from tallyroll.operators import classify, dedup, lookup, merge, policy, reports, rollup
from tallyroll.sources import archives, states


def _zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data if isinstance(data, bytes) else data.encode())


def _csv(rows):
    out = io.StringIO()
    csv.writer(out).writerows(rows)
    return out.getvalue()


def test_members_are_streamed(spark, tmp_path):
    long = [[str(i), f"name, {i}", "x\ny"] for i in range(2500)]
    _zip(tmp_path / "a.zip", {
        "in/contribs_01.csv": _csv([["id", "name", "note"], *long]),
        "in/CONTRIBS_02.CSV": b"\xef\xbb\xbfid,extra,name\n7,e,caf\xe9 \xff\n\n8,f\n9,g,h,more\n",
        "in/contribs_03.csv": "",
        "in/other.csv": "id\n1\n",
    })
    got = archives.read_members(spark, str(tmp_path / "a.zip"), "contribs_*.csv", rows="1000")
    assert got.columns == ["id", "extra", "name", "note", "_path", "_block", "_at"]
    assert got.rdd.getNumPartitions() == 3
    rows = got.orderBy("_path", "_at").collect()
    assert [(r.id, r.extra, r.name, r.note, r._at) for r in rows[:3]] == [("7", "e", "caf� �", None, 0), ("8", "f", None, None, 1), ("9", "g", "h", None, 2)]
    assert [(r.id, r.name, r.note) for r in rows[3:]] == [tuple(x) for x in long]
    assert rows[0]._path.endswith("a.zip!in/CONTRIBS_02.CSV")
    few = archives.read_members(spark, str(tmp_path / "a.zip"), "contribs_*.csv", columns="note,none")
    assert few.columns[:2] == ["note", "none"] and few.where("note IS NOT NULL").count() == 2500 and few.where("none IS NOT NULL").count() == 0
    _zip(tmp_path / "b.zip", {"other.csv": "id\n2\n"})
    both = archives.read_members(spark, str(tmp_path), "other.csv")
    assert sorted(r.id for r in both.collect()) == ["1", "2"]
    one = archives.read_members(spark, f"file://{tmp_path}/a.zip", "other.csv|contribs_03.csv")
    assert [r.id for r in one.collect()] == ["1"]


def test_a_source_reads_its_archive_as_its_files(spark, tmp_path):
    head = "FILING_ID\tAMEND_ID\tTRAN_ID\tCTRIB_NAML\tCTRIB_NAMF\tAMOUNT\tRCPT_DATE\n"
    rows = "".join(f"F{i % 7}\t{i % 3}\tT{i}\tFie\"ld{i % 5}\tAnn\t{i}.50\t3/4/2020\n" for i in range(300))
    _zip(tmp_path / "db.zip", {"Cal/DATA/Rcpt_Cd.tsv": head + rows, "Cal/DATA/CVR.TSV": "A\tB\n1\t2\n"})
    (tmp_path / "rcpt.tsv").write_text(head + rows)
    source = states.SOURCES["CA"]
    plain = lambda df: sorted(map(str, source.bundle(df).collect()))
    assert plain(source.read_archive(spark, str(tmp_path / "db.zip"), "rcpt_cd.tsv")) == plain(source.read(spark, str(tmp_path / "rcpt.tsv")))


@pytest.mark.parametrize("size", [10, 20_000])
def test_names_within_texts(spark, size):
    r = random.Random(size)
    word = lambda n: "".join(r.choice("abcdeé") for _ in range(n))
    names = [(k, word(r.randrange(1, 8)).upper() if k % 2 else word(r.randrange(3, 9))) for k in range(size)] + [(-1, " "), (-2, None), (-3, "ab"), (-4, "ab")]
    texts = [(k, word(r.randrange(0, 14))) for k in range(150)] + [(200, None), (201, "xxabxx"), (202, "xxabxx"), (203, "Ab")]
    got = lookup.names_within(spark.createDataFrame(texts, "id int, t string"), F.col("t"), spark.createDataFrame(names, "k int, name string"), "name")
    want = sorted((i, k) for i, t in texts for k, n in names if n and n.strip() and n.strip().lower() in (t or "").lower())
    assert sorted((x.id, x.k) for x in got.collect()) == want


def test_ranks_over_ranges(spark):
    r = random.Random(1)
    rows = [(i, r.choice([None, 1.5, 2.5, 9.0])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, w double").repartition(7)
    order = [F.desc_nulls_last("w"), F.col("id")]
    ranked = rollup.ranked(df, order)
    assert "Window" in ranked._jdf.queryExecution().toString() and "SinglePartition" not in ranked._jdf.queryExecution().executedPlan().toString()
    want = {i: k for k, (i, w) in enumerate(sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0])))}
    assert {x.id: x.place for x in ranked.collect()} == want
    assert {x.id: x.bucket for x in rollup.round_robin(df, order, 4).collect()} == {i: k % 4 for i, k in want.items()}
    assert rollup.ranked(df.limit(0), order).count() == 0


def test_parties_have_six_buckets(spark):
    seen = {"GOP": "REP", " republican": "REP", "IND": "IND", "Independent": "IND", "lib": "LIB", "Libertarian": "LIB", "GREEN": "GRE", "DEMOCRAT": "DEM", "D": "OTH", "R": "OTH", "DFL": "OTH", "": "OTH", None: "OTH"}
    df = spark.createDataFrame([(k,) for k in seen], "p string").select("p", text.party_bucket(F.col("p")).alias("b"))
    assert {r.p: r.b for r in df.collect()} == seen


def test_generic_employers_are_listed_but_not_suggested(spark):
    rows = [("a", "PROBABLE", e, "X") for e in ("Selfemployed", "unemployed ", "Private Investor", "INFORMATION REQUESTED", "Acme", "", None) for _ in range(2)] + [("b", "PROBABLE", "Bolt", "X")] * 2
    df = spark.createDataFrame(rows, "entity_slug string, status string, contributor_employer string, contributor_city string").withColumn("amount", F.lit(1))
    listed = {(r.entity_slug, r.value): r.n for r in reports.by_signal_field(df, "PROBABLE", "contributor_employer").collect()}
    assert listed[("a", "PRIVATE INVESTOR")] == 2 and listed[("a", "")] == 4 and len(listed) == 7
    assert ("a", "") not in {(r.entity_slug, r.value) for r in reports.by_signal_field(df, "PROBABLE", "contributor_employer", blank=False).collect()}
    registry = spark.createDataFrame([("a", ["acme"])], "slug string, employers array<string>").withColumns({c: F.array().cast("array<string>") for c in ("strong_employers", "negative_employers")})
    assert {(r.entity_slug, r.value) for r in reports.suggestions(df, registry).collect()} == {("a", "INFORMATION REQUESTED"), ("b", "BOLT")}


def test_seats_in_two_congresses_are_one_row(spark):
    gifts = spark.createDataFrame([("T1", "m1")], "txn string, bioguide string")
    seats = spark.createDataFrame([("m1", "C", 1), ("m1", "C", 2), ("m1", "C", 2)], "bioguide string, thomas_id string, congress int")
    bills = spark.createDataFrame([("b1", "C", 1), ("b2", "C", 2), ("b1", "C", 2), ("b3", "C", 3)], "bill_id string, thomas_id string, congress int")
    assert [(r.txn, r.bill_ids) for r in policy.with_committees(gifts, seats, bills).collect()] == [("T1", "b1,b2")]


def test_records_that_share_a_key_stay_records(spark):
    registry = spark.createDataFrame([("owner", "owner", None, 0, ["Ann Field"])], "slug string, kind string, parent_slug string, position int, name_variants array<string>")
    lists = ("cities", "states", "employers", "occupations", "strong_employers", "strong_zips", "negative_employers")
    registry = registry.withColumns({c: F.array().cast("array<string>") for c in lists} | {"mrs_is_self": F.lit(False), "lone_city_state_is_weak": F.lit(False)})
    rows = [("same", "Ann Field", "Acme"), ("same", "Field, Ann", "Bolt"), (None, "Ann Field", "Cog"), (None, "Ann Field", "Dune"), (None, "Bob Field", "Egg")]
    df = spark.createDataFrame(rows, "record_id string, contributor_name string, contributor_employer string").withColumns({f"contributor_{c}": F.lit("") for c in ("occupation", "city", "state", "zip")})
    assert sorted(r.contributor_employer for r in classify.classify(df, registry).collect()) == ["Acme", "Bolt", "Cog", "Dune"]


def test_rows_without_a_key_are_refused(spark):
    state = spark.createDataFrame([("a", 1)], "k string, amount int")
    with pytest.raises(Exception, match="can't be merged"):
        merge.merged(state, spark.createDataFrame([(None, 1)], "k string, amount int"), ["k"], {"amount": "money"}, F.lit(1), "k").collect()


def test_ties_are_settled_by_contents(spark):
    rows = [("k", 1, v) for v in "bacd"]
    found = set()
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(order, "k string, r int, v string").repartition(3)
        found.add((dedup.best_row_per_key(df, ["k"], [F.col("r")]).first().v, dedup.first_row_per_key(df, ["k"], [F.col("r")]).first().v))
    assert len(found) == 1
