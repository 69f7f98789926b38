"""Exports that are counted while they are written."""

from pyspark.sql import functions as F

from tallyroll.operators import checks
from tallyroll.sources import sinks


def test_an_export_is_held_against_its_manifest_and_the_table(spark, tmp_path):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("part"), (F.col("id") / 4).cast("decimal(18,2)").alias("amount"))
    root = f"file://{tmp_path}/out"
    back = sinks.export_counted(df, root, "part", "amount")
    assert back.schema.simpleString() == df.schema.simpleString() and back.count() == 300
    said = spark.read.json(f"{root}/manifest").first()
    assert said.rows == 300 and int(said.cents) == sum(int(i * 25) for i in range(300))
    assert sinks.whole(spark, root, df.schema, "amount")
    assert {r.part: r.same for r in checks.exports_agree(df, back, "part", "amount").collect()} == {"a": True, "b": True}
    later = df.union(spark.createDataFrame([(900, "a", 1)], "id long, part string, amount int").withColumn("amount", F.col("amount").cast("decimal(18,2)"))).union(df.limit(1).withColumn("part", F.lit("new")))
    assert {r.part: r.same for r in checks.exports_agree(later, back, "part", "amount").collect()} == {"a": False, "b": True, "new": False}
    for f in sorted((tmp_path / "out/data/part=a").glob("part-*"))[:1]:
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)  # else the change is seen by the checksum already
        f.write_text(f.read_text().replace('"id":0,', '"id":7,', 1) if '"id":0,' in f.read_text() else "")
    spark.catalog.clearCache()
    assert not sinks.whole(spark, root, df.schema, "amount")


def test_a_payload_knows_its_rows(spark, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    sinks.export_payload({"rows": df, "none": df.limit(0)}, f"file://{tmp_path}/p", {"name": "x"}, {"rows": "k"})
    meta = {r.name: r.value for r in spark.read.json(f"file://{tmp_path}/p/_meta").collect()}
    assert meta == {"name": "x", "rows.rows": "10", "rows.none": "0"}


def test_a_payload_is_one_scan(spark, tmp_path):
    from tallyroll.operators import reports

    rows = [(f"e{k % 3}", "e0" if k % 3 == 1 else None, None if k % 4 == 0 else f"C{k % 5}", 2000 + 2 * (k % 2), "DEM" if k % 2 else "REP", "CONFIRMED" if k % 3 else "PROBABLE", k) for k in range(40)]
    df = spark.createDataFrame(rows, "entity_slug string, parent_owner_slug string, committee_id string, election_cycle int, party string, status string, amount int").withColumn("date", F.lit("2020-01-01").cast("date"))
    df.write.parquet(f"{tmp_path}/gifts")
    out = reports.payload(spark.read.parquet(f"{tmp_path}/gifts"))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    got = {(r.section, r.owner, r.election_cycle, r.party, r.committee_id): r for r in out.collect()}
    league = got["league", None, None, None, None]
    assert (league.n, league.total_amount, league.owners, league.cycles, league.members) == (40, 780.0, 2, 2, None)
    home = got["owner", "e0", None, None, None]
    assert (home.members, home.recipients, home.cycles) == (1, 6, 2) and home.n == sum(1 for r in rows if r[0] != "e2")
    assert got["recipient", None, None, None, "_unknown"].n == 10 and got["recipient", None, None, None, "C1"].owners == 2
    assert reports.payload(spark.read.parquet(f"{tmp_path}/gifts").limit(0)).count() == 0


def test_a_report_is_written_in_order_with_its_meta(spark, tmp_path):
    root = f"file://{tmp_path}/report"
    rows = spark.createDataFrame([(1.0, "=cmd"), (3.0, "b"), (2.0, None)], "amount double, note string")
    sinks.export_report(rows, root, [F.desc("amount")], {"bills": "b1,b2"})
    meta = {r["name"]: r.value for r in spark.read.json(f"{root}/_meta").collect()}
    assert meta["n_rows"] == "3" and meta["bills"] == "b1,b2" and "cause" in meta["neutrality_note"]
    lines = [x for p in sorted((tmp_path / "report" / "csv").glob("*.csv")) for x in p.read_text().splitlines() if x != "amount,note"]
    assert [x.split(",")[0] for x in lines] == ["3.0", "2.0", "1.0"] and lines[2].split(",")[1].strip('"').startswith("'=")
    sinks.export_report(rows.where("false"), root, [F.desc("amount")], {})
    assert {r["name"]: r.value for r in spark.read.json(f"{root}/_meta").collect()}["n_rows"] == "0"
