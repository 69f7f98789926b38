"""Checks of curated bill documents and of stored roll calls; each gives the problems as rows and changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null

#: A curated bill document; stem is the name that it was filed under.
BILL_DOCUMENT = """stem string, bill_id string, congress int, bill_type string, number int, issue_area string, relevance_basis string, carried_by_bill_id string, sources array<struct<description: string, url: string>>,
roll_calls array<struct<chamber: string, congress: int, session: int, roll: int, year: int>>, change_log array<struct<date: string, change: string>>"""
# Kinds of bills, and how few positions make a chamber's roll call look like a partial one.
BILL_TYPES = ("hr", "s", "hjres", "sjres", "hconres", "sconres", "hres", "sres")
LEAST_POSITIONS = {"house": 400, "senate": 90}


def _missing(c: Column) -> Column:
    return blank_to_null(c).isNull()


def _each(items: str, *rules: tuple[str, Callable[[Column], Column], str]) -> Column:
    """A problem for each entry of a list and each rule (level, condition, what) that it breaks; null conditions count as broken."""

    def broken(level: str, condition: Callable[[Column], Column], what: str) -> Column:
        line = lambda x, i: F.when(F.coalesce(condition(x), F.lit(True)), F.struct(F.lit(level).alias("level"), F.concat(F.lit(f"{items}["), i.cast("string"), F.lit(f"]{what}")).alias("problem")))
        return F.array_compact(F.transform(items, line))

    nothing = F.array().cast("array<struct<level: string, problem: string>>")
    return F.when(F.col(items).isNull(), nothing).otherwise(F.concat(*[broken(*rule) for rule in rules]))


def bill_problems(documents: DataFrame, issues: DataFrame, today: Column) -> DataFrame:
    """bill documents (BILL_DOCUMENT) with something wrong: stem, level (error or warning) and problem, a row each.

    issues: issue_area, the known ones. A bill that carries another one should be filed itself (warning); dates of the
    change log may not lie in the future. Without any issues the areas aren't held against them.
    """
    known = issues.select("issue_area").distinct().withColumn("__area", F.lit(True))
    areas = issues.agg((F.count("*") > 0).alias("__areas"))
    filed = documents.select(F.col("stem").alias("carried_by_bill_id")).distinct().withColumn("__carrier", F.lit(True))
    rows = documents.join(known, "issue_area", "left").join(filed, "carried_by_bill_id", "left").crossJoin(F.broadcast(areas))  # one row
    good_id = F.concat_ws("-", F.col("congress").cast("string"), "bill_type", F.col("number").cast("string"))
    typed = F.coalesce(F.col("bill_type").isin(*BILL_TYPES), F.lit(False))
    whole = F.col("congress").isNotNull() & typed & F.col("number").isNotNull()
    rules = [
        ("error", ~F.col("bill_id").eqNullSafe(F.col("stem")), "bill_id isn't the document's name"),
        ("error", F.col("congress").isNull(), "congress is no integer"),
        ("error", ~typed, "unknown bill_type"),
        ("error", F.col("number").isNull(), "number is no integer"),
        ("error", whole & ~F.col("bill_id").eqNullSafe(good_id), "bill_id isn't congress-type-number"),
        ("error", _missing(F.col("issue_area")), "issue_area is missing"),
        ("error", ~_missing(F.col("issue_area")) & F.col("__areas") & F.col("__area").isNull(), "unknown issue_area"),
        ("error", _missing(F.col("relevance_basis")), "relevance_basis is missing"),
        ("error", F.col("carried_by_bill_id").isNotNull() & _missing(F.col("carried_by_bill_id")), "carried_by_bill_id is empty"),
        ("warning", ~_missing(F.col("carried_by_bill_id")) & F.col("__carrier").isNull(), "carried by a bill that isn't filed"),
        ("error", F.coalesce(F.size("sources"), F.lit(0)) < 1, "sources are missing"),
        ("error", F.coalesce(F.size("change_log"), F.lit(0)) < 1, "change_log is missing"),
    ]
    plain = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(level).alias("level"), F.lit(what).alias("problem"))) for level, c, what in rules]))
    day = lambda x: F.try_to_date(x["date"], "yyyy-MM-dd")
    listed = [
        _each("sources", ("error", lambda x: _missing(x["description"]), ".description is empty"), ("warning", lambda x: _missing(x["url"]), ".url is empty")),
        _each("roll_calls", ("error", lambda x: ~x["chamber"].isin("house", "senate"), ".chamber is neither house nor senate"), *[("error", lambda x, k=k: x[k].isNull(), f".{k} is no integer") for k in ("congress", "session", "roll")], ("error", lambda x: (F.coalesce(x["chamber"], F.lit("")) == "house") & x["year"].isNull(), ".year is missing")),
        _each("change_log", ("error", lambda x: day(x).isNull(), ".date is missing or invalid"), ("error", lambda x: F.coalesce(day(x) > today, F.lit(False)), ".date lies in the future"), ("error", lambda x: _missing(x["change"]), ".change is empty")),
    ]
    return rows.select("stem", F.inline(F.concat(plain, *listed)))


def orphaned_bills(bills: DataFrame, documents: DataFrame) -> DataFrame:
    """Stored bills that no document stands for any more: loads only add, so they stay until somebody removes them."""
    return bills.select("bill_id").distinct().join(documents.select(F.col("stem").alias("bill_id")), "bill_id", "left_anti")


def partial_votes(votes: DataFrame, positions: DataFrame) -> DataFrame:
    """Roll calls with fewer positions than their chamber would show: vote_id, bill_id, chamber, positions and least. Those of other bodies aren't judged."""
    counts = positions.groupBy("vote_id").agg(F.count("*").alias("positions"))
    least = F.create_map(*[F.lit(x) for kv in LEAST_POSITIONS.items() for x in kv])
    rows = votes.join(counts, "vote_id", "left").na.fill(0, ["positions"]).withColumn("least", F.try_element_at(least, F.lower("chamber")))
    return rows.where("positions < least").select("vote_id", "bill_id", "chamber", "positions", "least")


def misfiled_votes(votes: DataFrame, parsed: DataFrame) -> DataFrame:
    """Stored roll calls whose landed document names another congress or session: vote_id, field, stored and said.

    votes: vote_id, congress, session, raw_payload_path; parsed: _path, congress, session of the documents at hand (house_votes,
    senate_votes). Roll calls whose document isn't there, or doesn't say, aren't judged; a document that can't be read names
    neither and is listed under the field `document`.
    """
    said = parsed.select(F.col("_path").alias("raw_payload_path"), F.col("congress").alias("__congress"), F.col("session").alias("__session"))
    rows = votes.where(~_missing(F.col("raw_payload_path"))).join(said, "raw_payload_path")
    line = lambda c: F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("stored"), F.col(f"__{c}").cast("string").alias("said"))
    unread = F.col("__congress").isNull() & F.col("__session").isNull()
    none = F.lit(None).cast("string")
    wrong = [F.when(F.col(f"__{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"__{c}")), line(c)) for c in ("congress", "session")]
    return rows.select("vote_id", F.inline(F.array_compact(F.array(*wrong, F.when(unread, F.struct(F.lit("document").alias("field"), none.alias("stored"), none.alias("said")))))))
