"""The attribution library: domain cases with invented names, and every query against its SQL."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyroll.functions import dates, money, text
from tallyroll.operators import attribution, checks, classify, dedup, lookup, merge, policy, rollup
from tallyroll.plans import cases
from tallyroll.plans import queries as plans
from tallyroll.sources import federal, legislation, sinks, states
from tallyroll.streaming import incremental

SF = "/root/testdata/sf0.001"


def _plain(v):
    return None if v is None or v != v else f"{float(v):.6g}" if not isinstance(v, (str, bool)) and hasattr(v, "__float__") else str(v)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, con_rows = plans.QUERIES[name](spark, SF), con.execute(plans.ORACLES[name])
    names = [d[0] for d in con_rows.description]
    want = sorted([tuple(_plain(r[names.index(c)]) for c in sorted(names)) for r in con_rows.fetchall()], key=str)
    assert sorted(got.columns) == sorted(names)
    assert sorted([tuple(_plain(r[c]) for c in sorted(names)) for r in got.collect()], key=str) == want


def _one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(col.alias("x")).first().x


def test_names_and_places(spark):
    names = spark.createDataFrame([("Stone-Field, Mr. Ann B. III",), (None,), ("  Dr. ",), ("V",), ("Ann Stone V",), ("v. Ann Stone",)], "v string")
    n = {r.v: r.n for r in text.with_name_parts(names, "v", "n").collect()}
    first = n["Stone-Field, Mr. Ann B. III"]
    assert set(first.forms) == {"ann stone-field", "ann field-stone", "ann stone field", "ann field stone"} and first.suffix == "iii" and first.initials == ["b"]
    assert n[None].forms == n["  Dr. "].forms == n["V"].forms == [] and n["V"].suffix == n["Ann Stone V"].suffix == "v" and n["v. Ann Stone"].forms == ["v ann stone"]
    assert not _one(spark, text.token_start(F.col("v"), F.lit("gap")), v="Singapore") and _one(spark, text.token_start(F.col("v"), F.lit("gap")), v="GAP, Inc.")
    assert tuple(_one(spark, text.city_state_zip(F.col("v")), v="New Town, fl 12345-6789")) == ("New Town", "FL", "12345")
    assert tuple(_one(spark, text.name_party_office(F.col("v")), v="Stone, Ann (REP)(STR)")) == ("Stone, Ann", "REP", "STR")
    assert _one(spark, text.csv_guard(F.col("v")), v="=1+1") == "'=1+1"


def test_dates_and_money(spark):
    assert str(_one(spark, dates.epoch_date(F.col("v")), v="/Date(1256886000000)/")) == "2009-10-30"
    assert _one(spark, dates.any_date(F.col("v")), v="13/45/2020") is None
    assert float(_one(spark, money.money(F.col("v")), v=" $1,234.50 ")) == 1234.5 and _one(spark, money.money(F.col("v")), v="nan") is None


def test_countable_siblings(spark):
    rows = [("a", "1", 0), ("a", "2", 1), ("b", "3", 0), ("c", "4", 1), ("c", "5", 1), (None, "6", 0)]
    df = spark.createDataFrame(rows, "k string, txn string, own int")
    got = {r.txn: r.counted for r in dedup.counted_flag(df, ["k"], "txn", F.col("own") == 1).collect()}
    assert got == {"1": False, "2": True, "3": True, "4": True, "5": True, "6": True}


def test_classifier_answers_the_cases(spark):
    got = {}
    for r in classify.classify(cases.records(spark), cases.registry(spark), "case_id").collect():
        got.setdefault(r.case_id, set()).add((r.entity_slug, r.status, ",".join(r.signals)))
    for i, case in enumerate(cases.CASES):
        assert got.get(i, set()) == set(case[-1]), case
    # without relatives, their records belong to nobody
    alone = classify.classify(cases.records(spark), cases.registry(spark), "case_id", related=False).collect()
    kin = {e[0] for e in cases.ENTITIES if e[2]}
    assert {(r.case_id, r.entity_slug) for r in alone} == {(i, slug) for i, c in enumerate(cases.CASES) for slug, _, _ in c[-1] if slug not in kin}


def test_reasons_name_the_anomaly(spark):
    rows = classify.classify(cases.records(spark), cases.registry(spark), "case_id").where("case_id = 7").collect()
    assert [("outside documented residences" in r.status_reason, r.status) for r in rows] == [(True, "CONFIRMED")]


def test_policy_days_and_tiers(spark):
    d = spark.createDataFrame([("T1", "H1", None, 5000.0, "2018-01-01"), ("T2", None, "C1", 2000.0, "2018-01-01"), ("T3", "", "C2", 1.0, "2018-01-01")], "txn string, recipient_candidate_id string, recipient_committee_id string, amount double, date string")
    cross = spark.createDataFrame([("H1", "M1")], "candidate_id string, bioguide string")
    committees = spark.createDataFrame([("C1", "P", '["H1"]'), ("C2", "P", '["H1","H2"]')], "committee_id string, designation string, candidate_ids string")
    got = policy.resolved_donations(d, cross, committees)
    assert {(r.txn, r.join_tier) for r in got.collect()} == {("T1", "direct"), ("T2", "indirect")}
    votes = policy.with_votes(policy.resolved_donations(d, cross), spark.createDataFrame([("V", "M1", "Yea")], "vote_id string, bioguide string, position string"), spark.createDataFrame([("V", "2018-03-22")], "vote_id string, vote_date string"))
    assert votes.first().days_before_vote == 80


def test_sources_project_to_the_canonical_record(spark):
    fl = spark.createDataFrame([("Stone, Ann (REP)(STR)", "03/04/2020", "$1,000.00", "CHE", "FIELD BOB", "1 Road", "New Town, FL 12345", "NULL")], ["Candidate/Committee", "Date", "Amount", "Typ", "Contributor Name", "Address", "City State Zip", "Occupation"])
    r = states.SOURCES["FL"].project(fl).first()
    assert (r.contributor_city, r.recipient_party, float(r.amount), str(r.date), r.contributor_occupation) == ("New Town", "REP", 1000.0, "2020-03-04", "")
    assert r.state_txn_id.startswith("FL:FL-DOE::") and (r.contributor_name, r.recipient_type) == ("FIELD, BOB", "candidate")
    assert len(states.SOURCES) == 11


def test_sources_from_landed_files(spark, tmp_path):
    """Each source reads a file of its own format and gives one canonical record a contribution."""
    def landed(code, text, name="rows.txt"):
        path = tmp_path / code
        path.mkdir(exist_ok=True)
        (path / name).write_text(text, encoding="utf-8-sig" if code == "MN" else "utf-8")
        return states.SOURCES[code].read(spark, str(path / name))

    def one(code, text, recipients=None):
        got = states.SOURCES[code].bundle(landed(code, text), recipients).collect()
        assert len(got) == 1, got
        return got[0]

    ca = one("CA", "TRAN_ID\tFILING_ID\tAMEND_ID\tAMOUNT\tRCPT_DATE\tCTRIB_NAML\tCTRIB_NAMF\tCTRIB_CITY\nT1\tF1\t0\t10\t3/4/2020 12:00:00 AM\tField\tBob\tRiverton\nT1\tF1\t1\t10\t3/4/2020 12:00:00 AM\tFIELD\tBOB\tRiverton\n",
             landed("CA", 'FILING_ID\tAMEND_ID\tFILER_ID\tFILER_NAML\tCAND_NAML\nF1\t2\t77\tNew "name\t\nF1\t1\t77\tOld\tX\n', "cvr.txt"))
    assert (ca.contributor_name, str(ca.date), ca.recipient_name, ca.recipient_filer_id, ca.recipient_type, ca.contributor_employer) == ("FIELD, BOB", "2020-03-04", 'New "name', "77", "committee", "")
    pa = one("PA", "FilerID,CampaignFinanceID,CONTRIBUTOR,ENAME,CONTAMT1,CONTDATE1,CONTAMT2,CONTDATE2\n5,9,BOB FIELD,NULL,1.50,20200304,,\n5,9,BOB FIELD,NULL,1.50,20200304,,\n", landed("PA", "FILERID,FILERNAME,PARTY,OFFICE,FILERTYPE\n5,Friends,DEM,GOV,CAN\n5,Later,X,X,X\n", "filer.txt"))
    assert (pa.recipient_name, pa.recipient_party, pa.recipient_type, float(pa.amount), len(pa.source_tran_id)) == ("Friends", "DEM", "can", 1.5, 16)
    ny = one("NY", "filer_id,trans_number,flng_ent_last_name,flng_ent_first_name,flng_ent_city,sched_date,org_amt,election_year,cand_comm_name\n1,,Field,Bob,Troy,2020-03-04T00:00:00,5,2021,Friends of Ann\n2,,Field,Rob,Troy,2020-03-04T00:00:00,5,2021,X\n")
    assert (ny.contributor_city, ny.election_cycle, ny.recipient_type) == ("Troy", 2021, "candidate")
    assert states.SOURCES["NY"].for_classifier(spark.createDataFrame([("Troy", "NY")], "contributor_city string, contributor_state string")).first().contributor_city == ""
    wa = one("WA", "id,contributor_name,receipt_date,amount,type,filer_name\n1,FIELD BOB J,2020-03-04,5,Candidate,F\n1,FIELD BOB J,2020-03-04,5,Candidate,F\n")
    assert (wa.contributor_name, wa.contributor_middle_name, wa.recipient_type) == ("FIELD, BOB J", "J", "candidate")
    rows = landed("CO", "CO_ID,RecordID,LastName,FirstName,MI,ContributionDate,ContributionAmount,CommitteeType\n1,,Field,Bob,J,2020-03-04 00:00:00,5,Issue Committee\n1,,Field,Bob,J,2020-03-04 00:00:00,5,\n")
    assert sorted(str(r.recipient_type) for r in states.SOURCES["CO"].bundle(rows).collect()) == ["None", "committee"]  # rows without an id are kept each
    az = one("AZ", 'TransactionLastName,TransactionFirstName,TransactionDate,Amount,CommitteeUniqueId,PublicTransactionId,CandidateLastName\n"Field, Bob",Bob,/Date(1256886000000)/,5,1,10,Z\n"Field, Bob",Bob,/Date(1256886000000)/,5,1,11,Z\n')
    assert (az.contributor_name, str(az.date), az.source_tran_id, az.recipient_type) == ("Field, Bob", "2009-10-30", "11", "candidate")
    mn = one("MN", "Recipient reg num,Recipient,Contributor,Amount,Receipt date,Contrib zip,Contrib Employer name,Receipt type,Recipient type\n7,F,\"Field, Bob\",5,03/04/2020,55401,Acme,C,PCC\n7,F,\"Field, Bob\",5,03/04/2020,55401,Acme,C,PCC\n")
    assert (mn.source_filing_id, mn.recipient_type, mn.contributor_employer) == ("7", "candidate", "Acme")
    rows = landed("MD", "contributorName,contributorZipCode,transactionDate,transactionAmount,transactionGuid,reportGuid,committeeType,contributorTypeCode\n\"Field, Bob J\",21201-2435,2020-03-04,5,g1,r,Ballot Issue,TIND\n\"Field, Bob J\",21201-2435,2020-03-04,5,g1,r,x,TIND\nX,1,2020-03-04,5,,r,x,\n")
    md = states.SOURCES["MD"].bundle(rows).collect()
    assert [(r.contributor_zip, r.contributor_first_name, r.contributor_middle_name, r.recipient_type) for r in md] == [("21201", "Bob", "J", "ballot_measure")] and rows.where(states.is_person(rows)).count() == 2
    out = states.without_opted_out(spark.createDataFrame([("a", "CA"), ("b", "CA")], "owner_slug string, jurisdiction string"), spark.createDataFrame([("a", "CA")], "owner_slug string, jurisdiction string"))
    assert [r.owner_slug for r in out.collect()] == ["b"]


def test_api_pages_and_exports(spark, tmp_path):
    for name, rows in (("a", [{"sub_id": "1", "n": "x"}]), ("b", [{"sub_id": "1", "n": "y"}, {"sub_id": "2", "n": "z"}])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"response": {"results": rows}}))
    (tmp_path / "_skipped.json").write_text(json.dumps({"response": {"results": [{"sub_id": "9", "n": "w"}]}}))
    (tmp_path / "broken.json").write_text("{")
    pages = federal.read_pages(spark, str(tmp_path / "*.json"), "sub_id string, transaction_id string, n string")
    assert sorted(r.n for r in federal.contributions(pages).collect()) == ["x", "z"]
    df = spark.createDataFrame([("=a", 2020, -1.0), ("b", None, 2.0)], "t string, election_cycle int, v double")
    sinks.export_by_cycle(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    assert [(r.t, r.v) for r in back] == [("'=a", "-1.0")] and os.path.isdir(tmp_path / "out" / "election_cycle=2020")


def test_stream_merges_versions(spark, tmp_path):
    schema = "uid string, amount double, committee string"
    read = lambda: spark.readStream.schema(schema).json(str(tmp_path / "in"))
    root = str(tmp_path / "state")
    for batch in ([("1", 1.0, "c"), ("2", 2.0, "c"), *((f"x{i}", 1.0, "c") for i in range(40))], [("1", 1.0, "c"), ("2", 3.0, "c"), ("3", 4.0, "c")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        incremental.merge_stream(read(), root, str(tmp_path / "ck"), ["uid"], {"amount": "money", "committee": "text"}, "uid", buckets=8).awaitTermination()
    rows = incremental.state(spark, root).collect()
    live = sorted((r.uid, r.amount) for r in rows if r.superseded_by is None and not r.uid.startswith("x"))
    assert live == [("1", 1.0), ("2", 3.0), ("3", 4.0)] and sum(r.uid.startswith("x") for r in rows) == 40
    assert [(r.uid, r.superseded_by) for r in rows if r.superseded_by] == [("2~superseded~1", "2")]
    touched = [d for d in os.listdir(tmp_path / "state" / "data" / "v=1") if d.startswith("bucket=")]
    assert 1 <= len(touched) <= 3  # only the buckets of keys that came are written again
    assert sorted(r.uid for r in incremental.state(spark, root, 1).where("superseded_by IS NULL").collect()) == sorted(["1", "2", *(f"x{i}" for i in range(40))])


def test_collisions_write_nothing(spark):
    cur = spark.createDataFrame([("1", 1.0, "a")], "uid string, amount double, committee string")
    inc = spark.createDataFrame([("1", 2.0, "b")], "uid string, amount double, committee string")
    out = merge.merged(cur, inc, ["uid"], {"amount": "money", "committee": "text"}, F.lit(1), "uid", ("committee", "amount")).collect()
    assert [(r.uid, r.amount) for r in out] == [("1", 1.0)]
    assert rollup.nested_cycles(cur.withColumn("y", F.lit(2020)), "uid", "y", "committee", "amount").first().by_cycle == {2020: {"a": 1.0}}


def test_votes_of_both_chambers(spark, tmp_path):
    (tmp_path / "h.xml").write_text("<rollcall-vote><vote-metadata><congress>115</congress><session>2nd</session><rollcall-num>127</rollcall-num><action-date>22-Mar-2018</action-date><legis-num>H R 1</legis-num></vote-metadata><vote-data><recorded-vote><legislator name-id='A1'>A</legislator><vote>Yea</vote></recorded-vote><recorded-vote><legislator>B</legislator><vote>Nay</vote></recorded-vote><recorded-vote><legislator name-id='A1'>A</legislator><vote>Nay</vote></recorded-vote><recorded-vote><legislator name-id='C3'>C</legislator><vote/></recorded-vote><recorded-vote><legislator name-id='D4'>D</legislator><vote>Not Voting</vote></recorded-vote></vote-data></rollcall-vote>")
    (tmp_path / "s.xml").write_text("<roll_call_vote><congress>115</congress><session>2</session><vote_number>x</vote_number><vote_date>March 23, 2018, 12:34 AM</vote_date><document><document_name>H.R. 1</document_name></document><members><member><lis_member_id>S1</lis_member_id><vote_cast>Nay</vote_cast></member><member><lis_member_id>S9</lis_member_id><vote_cast>Yea</vote_cast></member></members></roll_call_vote>")
    meta, positions = legislation.house_votes(legislation.read_votes(spark, str(tmp_path / "h.xml")))
    m = meta.first()
    assert (m.congress, m.session, m.roll_number, str(m.vote_date), m.legis_num) == (115, 2, 127, "2018-03-22", "H R 1")
    assert sorted((r.bioguide_id, r.position) for r in positions.collect()) == [("A1", "Yea"), ("D4", "Not Voting")]
    meta, positions = legislation.senate_votes(legislation.read_votes(spark, str(tmp_path / "s.xml")))
    m = meta.first()
    assert (m.session, m.roll_number, str(m.vote_date), m.legis_num, m.vote_date_raw) == (2, None, "2018-03-23", "H.R. 1", "March 23, 2018, 12:34 AM")
    known, lost = legislation.mapped_positions(positions, spark.createDataFrame([("S1", "L1"), (None, "L2")], "lis_id string, bioguide_id string"))
    assert [(r.bioguide_id, r.position) for r in known.collect()] == [("L1", "Nay")] and [r.unmapped for r in lost.collect()] == [1]
    votes = spark.createDataFrame([("v1",), ("v2",)], "vote_id string")
    casts = spark.createDataFrame([("v1", "A"), ("v1", "B")], "vote_id string, bioguide string")
    assert [(r.vote_id, r.positions) for r in checks.incomplete_votes(votes, casts, 2).collect()] == [("v2", 0)]


def test_committees_and_members(spark):
    committees = spark.createDataFrame([("SSJU", "senate", "Judiciary"), (None, "house", "None")], "thomas_id string, type string, name string")
    members = spark.createDataFrame([("SSJU", [("A1", "1", "Chair", "majority"), (None, "2", None, None), ("B2", "x", None, None)]), ("SSJU01", [("A1", "1", None, None)])], "thomas_id string, members array<struct<bioguide: string, rank: string, title: string, party: string>>")
    full, rows = legislation.memberships(committees, members, 119)
    assert [(r.thomas_id, r.congress) for r in full.collect()] == [("SSJU", 119)]
    assert sorted((r.bioguide_id, r.rank) for r in rows.collect()) == [("A1", 1), ("B2", None)]
    pages = spark.createDataFrame([("C1", None, "Name", ["H1"], [2020, 2018, 2020, None], None)], "committee_id string, name string, committee_name string, candidate_ids array<string>, cycles array<int>, is_terminated boolean")
    names = [c.strip().split(" ")[0] for c in federal.COMMITTEE.replace("\n", " ").split(",")]
    row = federal.committee_rows(pages.select("*", *[F.lit(None).cast("string").alias(n) for n in names if n not in pages.columns])).first()
    assert (row["name"], row.cycles, row.candidate_ids, row.is_terminated) == ("Name", "[2018,2020]", '["H1"]', False)


def test_guards_and_small_parts(spark, tmp_path):
    rows = spark.createDataFrame([("f1", "p", "2020-01-01", 1.0), ("", "p", "2020-01-01", 1.0), ("f", "p", None, 1.0), ("f", "p", "2020-01-01", None)], "filing_id string, raw_payload_path string, date string, amount double")
    assert [r.rejected for r in checks.provenance_gate(rows, ["filing_id", "raw_payload_path", "date"], "amount").collect()] == [None, "no filing_id", "no date", "no amount"]
    assert [r.gate for r in attribution.gated(rows).collect()] == [None, None, "unparseable contribution date", "unparseable contribution amount"]
    assert checks.totals_agree(rows, rows, "amount").first().same and not checks.totals_agree(rows, rows.limit(2), "amount").first().same
    live = spark.createDataFrame([("1", None), ("2", "x"), ("3", None)], "uid string, superseded_by string")
    assert [r.uid for r in checks.loss(live, live.where("uid = '1'"), ["uid"]).collect()] == ["3"]
    donations = spark.createDataFrame([("a", None, 1), ("b", "a", 2), ("c", None, 3)], "entity_slug string, parent_owner_slug string, v int")
    with pytest.raises(ValueError):
        attribution.rebuilt(donations, donations.limit(0), live, ["a"])
    assert [r.entity_slug for r in attribution.rebuilt(donations, donations.limit(0), live, ["a"], force=True).collect()] == ["c"]
    state = donations.withColumn("jurisdiction", F.when(F.col("v") == 2, "TX").otherwise("CA"))
    assert sorted(r.v for r in attribution.reclassified_state(state, state.where("v = 1").withColumn("v", F.lit(9)), "CA", "a").collect()) == [2, 3, 9]
    queue = spark.createDataFrame([("1", "a", "Name only", None, "CA"), ("2", "a", "other", None, "CA"), ("3", "a", "name ONLY", "done", "CA"), ("4", "b", "NAME only", None, "TX")], "transaction_id string, entity_slug string, reason string, resolution string, jurisdiction string")
    settled = spark.createDataFrame([("4", "b", "DISCARDED")], "transaction_id string, entity_slug string, resolution string")
    assert [r.transaction_id for r in attribution.bulk_selected(queue, settled, "name%").collect()] == ["1"]
    assert sorted(r.transaction_id for r in attribution.reopened_queue(queue, queue.limit(0), "CA", "a").collect()) == ["3", "4"]
    more = attribution.decided(settled, "transaction_id", "a", queue.where("transaction_id < '3'"), {"resolution": F.lit("DISCARDED")})
    assert more.count() == 3 and attribution.withdrawn(more, "transaction_id", "a", queue.where("transaction_id = '1'")).count() == 2
    uncertain = queue.select("transaction_id", "entity_slug", F.lit("UNCERTAIN").alias("status"))
    assert sorted(r.transaction_id for r in attribution.queued(uncertain, settled, "transaction_id").collect()) == ["1", "2", "3"]
    with pytest.raises(ValueError):
        merge.buckets_merged(donations, [donations.limit(1), donations.limit(1)])
    with pytest.raises(ValueError):
        merge.in_rounds(spark.range(20).select(F.lit(1).alias("k"), "id"), ["k"], [F.col("id")])
    assert merge.replace_children(donations, donations.where("v = 1").withColumn("v", F.lit(7)), "entity_slug").where("v = 7").count() == 1
    assert merge.evolved(donations, {"v": "int", "w": "date"}).columns[-1] == "w"
    assert sorted(r.k for r in merge.tombstones_after(spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(3,)], "k int"), spark.createDataFrame([(2,)], "k int"), "k").collect()) == [1, 3]
    left, gone = merge.collisions_repaired(queue, settled, "transaction_id")
    assert left.count() == 3 and gone.count() == 0
    people = spark.createDataFrame([("Field", "Bob"), ("Field", "Al")], "last string, first string")
    assert [r.matched_first for r in lookup.prefix_compatible(spark.createDataFrame([("Field", "BOBBY")], "last string, first string"), people, "last", "first").collect()] == ["Bob"]
    blanks = spark.createDataFrame([("1", 2), ("1", 1), ("", 3), (None, 4)], "id string, at int")
    kept = {how: sorted(r.at for r in dedup.first_by_native_id(blanks, "id", [F.col("at")], how).collect()) for how in ("keep", "collapse", "drop")}
    assert kept == {"keep": [1, 3, 4], "collapse": [1, 3], "drop": [1]} and dedup.keyless_kept(blanks, "id", [F.col("at")]).count() == 3
    day = lambda c: _one(spark, c, v="2020-07-01")
    assert str(day(dates.lookback(F.col("v").cast("date")))) == "2018-12-29" and day(dates.congress_of(F.year(F.col("v").cast("date")))) == 116
    assert day(dates.is_fresh(F.col("v").cast("date"), F.lit("2020-08-01").cast("date"))) and not day(dates.is_fresh(F.lit(None).cast("date"), F.col("v").cast("date")))
    assert [r.at for r in incremental.trailing_window(blanks.withColumn("d", F.date_add(F.lit("2018-12-27").cast("date"), F.col("at"))), "d", F.lit("2020-07-01").cast("date")).collect()] == [2, 3, 4]
    assert _one(spark, text.json_strings(F.col("v")), v='["a"]') == ["a"] and _one(spark, text.json_strings(F.col("v")), v="no") == [] and _one(spark, text.party_bucket(F.col("v")), v=" republican ") == "REP"
    sinks.export_csv(donations, str(tmp_path / "csv"), [F.desc("v")])
    sinks.export_json(donations, str(tmp_path / "json"), "entity_slug")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3 and spark.read.json(str(tmp_path / "json")).count() == 3
    assert spark.read.parquet(sinks.snapshot(donations, str(tmp_path / "snap"), "r1")).count() == 3


def test_payloads_and_entity_exports(spark, tmp_path):
    from pyspark.sql import types as T

    names = {c: "string" for c in sinks.ALL_COLUMNS} | {"amount": "decimal(18,2)", "date": "date", "election_cycle": "int", "signals_matched": "array<string>"}
    base = dict.fromkeys(names) | {"entity_slug": "a", "status": "CONFIRMED", "signals_matched": ["x"], "contributor_name_raw": "=1+1"}
    schema = T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in names.items()) + ", counted boolean")
    rows = [base | {"transaction_id": t, "date": d, "counted": c, "status": s} for t, d, c, s in (("1", "2020-01-01", True, "CONFIRMED"), ("2", "2021-01-01", True, "PROBABLE"), ("3", "2021-01-01", False, "PROBABLE"), ("4", "2021-01-01", True, "UNCERTAIN"))]
    import datetime

    df = spark.createDataFrame([tuple(datetime.date.fromisoformat(r[k]) if k == "date" else r[k] for k in [*names, "counted"]) for r in rows], schema)
    sinks.export_entities(df, str(tmp_path / "entities"))
    back = spark.read.option("header", True).csv(str(tmp_path / "entities" / "entity=a"))
    assert back.columns == list(sinks.ALL_COLUMNS) and [(r.transaction_id, r.contributor_name_raw, r.signals_matched) for r in back.collect()] == [("2", "'=1+1", '["x"]'), ("1", "'=1+1", '["x"]')]
    sinks.export_payload({"owners": df.select("entity_slug", "amount"), "rows": df.select("status", "date")}, str(tmp_path / "payload"), {"about": "test"}, {"rows": "status"})
    assert {r.name: r.value for r in spark.read.json(str(tmp_path / "payload" / "_meta")).collect()} == {"about": "test", "rows.owners": "4", "rows.rows": "4"}
    assert os.path.isdir(tmp_path / "payload" / "rows" / "status=CONFIRMED")


def test_landed_bills_and_filings(spark, tmp_path):
    bill = {"congress": 115, "type": "HR", "number": 7, "title": "T", "laws": ["x"], "latestAction": {"text": "Passed", "actionDate": "2018-01-02"}, "sponsors": [{"bioguideId": "A1"}]}
    (tmp_path / "bill.json").write_text(json.dumps({"bill": bill, "cosponsors": [{"bioguideId": "A1"}, {"bioguideId": "B2"}], "committees": [{"systemCode": "hsju00", "chamber": "House", "name": "Judiciary"}]}, indent=1))
    bills = legislation.read_bills(spark, str(tmp_path / "bill.json"))
    row = legislation.bill_rows(bills).first()
    assert (row.bill_id, row.enacted, row.latest_action, row.congress_dot_gov_url) == ("115-hr-7", True, "Passed", "https://www.congress.gov/bill/115th-congress/house-bill/7")
    assert sorted((r.bioguide_id, r.role) for r in legislation.sponsor_rows(bills).collect()) == [("A1", "sponsor"), ("B2", "cosponsor")]
    assert [(r.thomas_id, r.chamber) for r in legislation.bill_committee_rows(bills).collect()] == [("HSJU", "house")]
    (tmp_path / "filing.json").write_text(json.dumps({"response": {"results": [{"file_number": 12, "is_amended": True, "amendment_chain": [1, 2], "cycle": 0, "election_year": 2020}, {"file_number": 13}]}}))
    rows = {r.file_number: r for r in federal.filing_rows(federal.read_pages(spark, str(tmp_path / "filing.json"), federal.FILING)).collect()}
    assert (rows["12"].cycle, rows["12"].is_amended, rows["12"].amendment_chain, rows["13"].is_amended, rows["13"].amendment_chain) == (2020, True, '["1","2"]', False, "[]")


def test_lists_of_bills_are_never_broadcast(spark):
    gifts = spark.createDataFrame([(f"T{i}", f"B{i % 3}") for i in range(30)], "txn string, bioguide string")
    seats = spark.createDataFrame([("B0", "C", 1), ("B1", "C", 1), ("B1", "C", 2), ("B2", "C", 3)], "bioguide string, thomas_id string, congress int")
    bills = spark.createDataFrame([(f"b{i:03}", "C", 1 + i % 2) for i in range(500)], "bill_id string, thomas_id string, congress int")
    out = policy.with_committees(gifts, seats, bills)
    assert out.columns == ["bioguide", "txn", "thomas_id", "bill_ids"]
    odd = ",".join(f"b{i:03}" for i in range(0, 500, 2))
    every = ",".join(f"b{i:03}" for i in range(500))
    assert sorted((r.txn, r.bill_ids) for r in out.collect()) == sorted((f"T{i}", odd if i % 3 == 0 else every) for i in range(30) if i % 3 < 2)
    assert "strategy=merge" in out._jdf.queryExecution().optimizedPlan().toString()


def test_long_lists_are_sorted_by_pieces_and_written_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(policy, "PIECE", 7)
    for k in policy.LONG_ROWS:
        spark.conf.unset(k)
    gifts = spark.createDataFrame([(f"T{i}", "B0" if i % 4 else "B1") for i in range(400)], "txn string, bioguide string").repartition(1)
    seats = spark.createDataFrame([("B0", "C", 1), ("B0", "C", 2), ("B1", "D", 1)], "bioguide string, thomas_id string, congress int")
    ids = [f"b{i:05}-{'x' * 40}" for i in range(30000)]
    bills = spark.createDataFrame([(x, "C", 1 + i % 2) for i, x in enumerate(ids)] + [(ids[0], "C", 2), (None, "C", 1), (None, "D", 1)], "bill_id string, thomas_id string, congress int")
    out = policy.with_committees(gifts, seats, bills)
    out.write.parquet(str(tmp_path / "out"))
    found = {(r.thomas_id, r.bill_ids): r.n for r in spark.read.parquet(str(tmp_path / "out")).groupBy("thomas_id", "bill_ids").agg(F.count("*").alias("n")).collect()}
    assert found == {("C", ",".join(ids)): 300, ("D", ""): 100}
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < 16 * len(",".join(ids))  # a list of 1.4 MB for each of 300 rows
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=merge") == 2 and "collect_set(bill_id" not in plan


def test_records_that_differ_in_what_is_null(spark, monkeypatch):
    from tallyroll.operators import classify

    fields = cases.records(spark).drop("case_id")
    rows = cases.records(spark).where("case_id = 1").withColumn("case_id", F.lit(7))
    moved = rows.withColumns({"contributor_city": F.lit("x"), "contributor_state": F.lit(None).cast("string")}).union(rows.withColumns({"contributor_city": F.lit(None).cast("string"), "contributor_state": F.lit("x")}))
    for bound in (classify.BROADCAST_ROWS, 0):  # broadcast and salted
        monkeypatch.setattr(classify, "BROADCAST_ROWS", bound)
        assert classify.classify(moved.union(moved), cases.registry(spark), "case_id").count() == 2
        got = classify.classify(cases.records(spark), cases.registry(spark), "case_id").select("case_id", "entity_slug", "status", F.array_join("signals", ",").alias("signals"))
        assert sorted(map(tuple, got.collect())) == sorted((i, *x) for i, c in enumerate(cases.CASES) for x in c[-1])
    plan = classify.candidates(fields.withColumn("k", F.lit(1)), cases.registry(spark), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Aggregate" in line and "contributor_city" in line for line in plan.split("\n"))  # records aren't sorted with the names


def test_records_that_are_unique_stay_where_they_are(spark):
    """Only their names are searched: no record is shuffled, sorted or compared with others, and the answers are the same."""
    rows = cases.records(spark)
    done = classify.classify(rows, cases.registry(spark), "case_id", unique=True)
    assert "hashpartitioning(__" not in done.drop("contributor_zip")._jdf.queryExecution().executedPlan().toString().replace("hashpartitioning(__id", "")
    got = done.select("case_id", "entity_slug", "status", F.array_join("signals", ",").alias("signals"))
    assert sorted(map(tuple, got.collect())) == sorted((i, *x) for i, c in enumerate(cases.CASES) for x in c[-1])


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_scored_again_are_dealt_out_before_they_are_sorted(spark):
    from tallyroll.plans import ingest

    stored = ingest._stored(spark, SF)
    none = spark.createDataFrame([], "transaction_id string, entity_slug string, verdict string, resolution string")
    plan = _optimized(attribution.reclassified_in_place(stored, cases.registry(spark), none, none))
    assert "RepartitionByExpression [__row" in plan and "Window" not in plan


def test_legs_of_review_items_are_found_once(spark):
    queue = spark.createDataFrame([("T", "stone", "name only", None)], "transaction_id string, entity_slug string, reason string, resolution string")
    fields = ("occupation", "city", "state", "zip")
    raw = spark.createDataFrame([("T", f"S{i}", "stone", "10", "Ann Stone", e, *[""] * 4) for i, e in enumerate(("Acme", "Acme", ""))], "transaction_id string, sub_id string, entity_slug string, amount string, contributor_name string, contributor_employer string, " + ", ".join(f"contributor_{c} string" for c in fields))
    live = spark.createDataFrame([("S0", None)], "record_uid string, superseded_by string")
    out = attribution.burndown(queue, queue.select("transaction_id", "entity_slug").where("false"), raw.union(raw), cases.registry(spark), live)
    assert "/legs-" in str(out.inputFiles()) and "min_by" not in _optimized(out)
    assert [(r.disposition, r.legs, r.attributable, float(r.promoted_amount)) for r in out.collect()] == [("HOLD", 3, 2, 10.0)]
