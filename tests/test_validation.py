"""Curated bills and stored roll calls with something wrong."""

from pyspark.sql import functions as F

from tallyroll.operators import validation
from tallyroll.sources import legislation

GOOD = {
    "stem": "118-hr-1", "bill_id": "118-hr-1", "congress": 118, "bill_type": "hr", "number": 1, "issue_area": "a", "relevance_basis": "It says so.", "carried_by_bill_id": None,
    "sources": [("Text", "u")], "roll_calls": [("house", 118, 1, 5, 2023)], "change_log": [("2020-01-01", "Filed")],
}


def _problems(spark, *changes):
    docs = spark.createDataFrame([tuple((GOOD | c).values()) for c in changes], validation.BILL_DOCUMENT)
    issues = spark.createDataFrame([("a",)], "issue_area string")
    return sorted((r.level, r.problem) for r in validation.bill_problems(docs, issues, F.lit("2024-01-01").cast("date")).collect())


def test_each_rule_of_a_bill_document(spark):
    assert _problems(spark, {}) == []
    assert _problems(spark, {"roll_calls": None}, {"roll_calls": []}) == []
    assert _problems(spark, {"stem": "x"}) == [("error", "bill_id isn't the document's name")]
    assert _problems(spark, {"congress": None}) == [("error", "congress is no integer")]
    assert ("error", "unknown bill_type") in _problems(spark, {"bill_type": None})
    assert _problems(spark, {"carried_by_bill_id": "118-hr-2"}) == [("warning", "carried by a bill that isn't filed")]
    assert _problems(spark, {"carried_by_bill_id": "118-hr-1"}) == []
    assert _problems(spark, {"carried_by_bill_id": " "}) == [("error", "carried_by_bill_id is empty")]
    assert _problems(spark, {"issue_area": "b", "relevance_basis": ""}) == [("error", "relevance_basis is missing"), ("error", "unknown issue_area")]
    assert _problems(spark, {"sources": None, "change_log": []}) == [("error", "change_log is missing"), ("error", "sources are missing")]
    assert _problems(spark, {"sources": [("", None)]}) == [("error", "sources[0].description is empty"), ("warning", "sources[0].url is empty")]
    assert _problems(spark, {"roll_calls": [("senate", 118, 1, 5, None), ("house", 118, None, 5, None), (None, 118, 1, 1, 1)]}) == [
        ("error", "roll_calls[1].session is no integer"), ("error", "roll_calls[1].year is missing"), ("error", "roll_calls[2].chamber is neither house nor senate"),
    ]
    assert _problems(spark, {"change_log": [("2024-02-30", "x"), ("2024-01-02", " ")]}) == [("error", "change_log[0].date is missing or invalid"), ("error", "change_log[1].change is empty"), ("error", "change_log[1].date lies in the future")]
    docs = spark.createDataFrame([], validation.BILL_DOCUMENT)
    assert validation.bill_problems(docs, spark.createDataFrame([], "issue_area string"), F.current_date()).isEmpty()
    bills = spark.createDataFrame([("118-hr-1",), ("117-s-2",), ("117-s-2",)], "bill_id string")
    assert [r.bill_id for r in validation.orphaned_bills(bills, spark.createDataFrame([tuple(GOOD.values())], validation.BILL_DOCUMENT)).collect()] == ["117-s-2"]


def test_roll_calls_are_held_against_their_documents(spark, tmp_path):
    page = "<rollcall-vote><vote-metadata><congress>{}</congress><session>{}</session><rollcall-num>5</rollcall-num><action-date>5-Jan-2023</action-date></vote-metadata><vote-data/></rollcall-vote>"
    for name, args in {"good": (118, "1st"), "bad": (117, "2nd"), "silent": ("", "")}.items():
        (tmp_path / f"{name}.xml").write_text(page.format(*args))
    meta, _ = legislation.house_votes(legislation.read_votes(spark, f"file://{tmp_path}/*.xml"))
    path = {r._path.rsplit("/", 1)[-1][:-4]: r._path for r in meta.collect()}
    votes = spark.createDataFrame([(n, 118, 1, path.get(n)) for n in ("good", "bad", "silent", "gone")], "vote_id string, congress int, session int, raw_payload_path string")
    got = sorted((r.vote_id, r.field, r.stored, r.said) for r in validation.misfiled_votes(votes, meta).collect())
    assert got == [("bad", "congress", "118", "117"), ("bad", "session", "1", "2"), ("silent", "document", None, None)]


def test_partial_roll_calls(spark):
    votes = spark.createDataFrame([("h", "b", "House"), ("s", "b", "senate"), ("none", "b", "senate"), ("x", "b", None)], "vote_id string, bill_id string, chamber string")
    positions = spark.range(400).select(F.lit("h").alias("vote_id")).unionByName(spark.range(89).select(F.lit("s").alias("vote_id")))
    assert sorted((r.vote_id, r.positions, r.least) for r in validation.partial_votes(votes, positions).collect()) == [("none", 0, 90), ("s", 89, 90)]
