"""Bills, sponsors, committees, legislators and roll calls from landed files, as tables.

Curated YAML documents come as JSON lines (one document a line); whoever lands them converts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import congress_of, month_name_date
from ..functions.text import blank_to_null
from ..operators.dedup import first_row_per_key

# Kinds of bills in web addresses, and of terms.
BILL_PATHS = {
    "hr": "house-bill", "s": "senate-bill", "hjres": "house-joint-resolution", "sjres": "senate-joint-resolution",
    "hconres": "house-concurrent-resolution", "sconres": "senate-concurrent-resolution", "hres": "house-resolution", "sres": "senate-resolution",
}
CHAMBERS = {"rep": "house", "sen": "senate"}

PERSON = "array<struct<bioguideId: string>>"
BILL = f"bill struct<congress: int, type: string, number: int, title: string, introducedDate: string, url: string, laws: array<string>, latestAction: struct<text: string, actionDate: string>, sponsors: {PERSON}>, cosponsors {PERSON}, committees array<struct<systemCode: string, chamber: string, name: string>>"


def read_bills(spark: SparkSession, path: str) -> DataFrame:
    """Landed bill documents with their cosponsors and committees."""
    return spark.read.schema(BILL).json(path, multiLine=True).withColumn("_path", F.col("_metadata.file_path"))


def bill_id() -> Column:
    return F.concat_ws("-", F.col("bill.congress").cast("string"), F.lower("bill.type"), F.col("bill.number").cast("string"))


def bill_rows(bills: DataFrame) -> DataFrame:
    kind, paths = F.lower("bill.type"), F.create_map(*[F.lit(x) for kv in BILL_PATHS.items() for x in kv])
    web = F.concat(F.lit("https://www.congress.gov/bill/"), F.col("bill.congress").cast("string"), F.lit("th-congress/"), F.coalesce(F.try_element_at(paths, kind), kind), F.lit("/"), F.col("bill.number").cast("string"))
    return bills.select(
        bill_id().alias("bill_id"), "bill.congress", kind.alias("bill_type"), "bill.number", "bill.title", F.col("bill.introducedDate").alias("introduced_date"), F.col("bill.latestAction.text").alias("latest_action"),
        F.col("bill.latestAction.actionDate").alias("latest_action_date"), (F.coalesce(F.size("bill.laws"), F.lit(0)) > 0).alias("enacted"), F.coalesce(web, "bill.url").alias("congress_dot_gov_url"),
    )


def sponsor_rows(bills: DataFrame) -> DataFrame:
    """bill_id, bioguide_id and role, each person once a bill: a sponsor is no cosponsor."""
    people = F.concat(*[F.transform(F.coalesce(c, F.array().cast(PERSON)), lambda p: F.struct(p["bioguideId"].alias("bioguide_id"), F.lit(role).alias("role"))) for c, role in (("bill.sponsors", "sponsor"), ("cosponsors", "cosponsor"))])  # noqa: B023
    rows = bills.select(bill_id().alias("bill_id"), F.explode(people).alias("p")).select("bill_id", "p.*").where(blank_to_null(F.col("bioguide_id")).isNotNull())
    return rows.groupBy("bill_id", "bioguide_id").agg(F.max("role").alias("role"))  # "sponsor" sorts behind "cosponsor"


def thomas_id(code: Column) -> Column:
    """The full committee of a system code: upper case, without the two digits at its end; codes of under three letters have none."""
    return F.when(F.char_length(code) >= 3, F.upper(F.regexp_replace(code, "[0-9]{2}$", "")))


def bill_committee_rows(bills: DataFrame) -> DataFrame:
    """bill_id, system_code, thomas_id, chamber and name of each committee of referral."""
    rows = bills.select(bill_id().alias("bill_id"), F.posexplode("committees").alias("at", "c")).where(blank_to_null(F.col("c.systemCode")).isNotNull())
    rows = first_row_per_key(rows.select("bill_id", "at", F.col("c.systemCode").alias("system_code"), blank_to_null(F.lower("c.chamber")).alias("chamber"), F.col("c.name").alias("name")), ["bill_id", "system_code"], [F.col("at")])
    return rows.select("bill_id", "system_code", thomas_id(F.col("system_code")).alias("thomas_id"), "chamber", "name")


LEGISLATOR = "id struct<bioguide: string, fec: array<string>, icpsr: string, govtrack: string, opensecrets: string, lis: string>, name struct<first: string, last: string, official_full: string>, terms array<struct<type: string, start: string, end: string, state: string, district: string, party: string>>"


def crosswalk(current: DataFrame, historical: DataFrame | None = None, only_with_ids: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Legislators, their candidate ids and their terms, of documents of LEGISLATOR; people in both files keep their current identity.

    only_with_ids leaves out people without a candidate id: no contribution can reach them.
    """
    rows = current.withColumn("_source", F.lit(0))
    if historical is not None:
        rows = rows.unionByName(historical.withColumn("_source", F.lit(1)))
    rows = rows.where(blank_to_null(F.col("id.bioguide")).isNotNull()).withColumn("fec", F.filter(F.coalesce("id.fec", F.array().cast("array<string>")), lambda x: x != ""))
    rows = rows.where(F.size("fec") > 0) if only_with_ids else rows
    last = F.try_element_at("terms", F.lit(-1))
    people = first_row_per_key(
        rows.select(
            F.col("id.bioguide").alias("bioguide_id"), "_source", *[F.col(f"id.{c}").alias(f"{c}_id") for c in ("icpsr", "govtrack", "opensecrets", "lis")],
            F.coalesce(blank_to_null(F.col("name.official_full")), blank_to_null(F.concat_ws(" ", blank_to_null(F.col("name.first")), blank_to_null(F.col("name.last")))), "id.bioguide").alias("full_name"),
            F.col("name.first").alias("first_name"), F.col("name.last").alias("last_name"), last["party"].alias("current_party"), last["state"].alias("current_state"),
        ), ["bioguide_id"], [F.col("_source"), F.col("full_name")],
    ).drop("_source")
    ids = rows.select(F.explode("fec").alias("fec_candidate_id"), F.col("id.bioguide").alias("bioguide_id")).distinct()
    chamber = F.create_map(*[F.lit(x) for kv in CHAMBERS.items() for x in kv])
    terms = rows.select(F.col("id.bioguide").alias("bioguide_id"), "_source", F.posexplode("terms").alias("at", "t")).withColumn("chamber", F.try_element_at(chamber, F.col("t.type"))).where("chamber IS NOT NULL")
    terms = first_row_per_key(terms.select("bioguide_id", "chamber", F.col("t.start").alias("start_date"), "_source", "at", F.col("t.end").alias("end_date"), "t.state", "t.district", "t.party"), ["bioguide_id", "chamber", "start_date"], [F.col("_source"), F.col("at")])
    year = F.left("start_date", F.lit(4)).try_cast("int")
    return people, ids, terms.withColumn("congress", congress_of(year)).drop("_source", "at")


def memberships(committees: DataFrame, members: DataFrame, congress: int) -> tuple[DataFrame, DataFrame]:
    """Full committees (thomas_id, chamber, name, congress) and their members; subcommittees, which have no own entry, go.

    committees: thomas_id, type, name; members: thomas_id and members (array of bioguide, rank, title, party).
    """
    full = first_row_per_key(committees.where(blank_to_null(F.col("thomas_id")).isNotNull()).select("thomas_id", F.col("type").alias("chamber"), "name"), ["thomas_id"], [F.col("name")])
    rows = members.join(full.select("thomas_id"), "thomas_id", "left_semi").select("thomas_id", F.explode("members").alias("m"))
    rows = rows.select("thomas_id", F.col("m.bioguide").alias("bioguide_id"), F.col("m.rank").try_cast("int").alias("rank"), "m.title", "m.party").where(blank_to_null(F.col("bioguide_id")).isNotNull())
    return full.withColumn("congress", F.lit(congress)), rows.withColumn("congress", F.lit(congress))


def read_votes(spark: SparkSession, path: str) -> DataFrame:
    """Landed roll-call XML, a row a file: value and _path."""
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("_path"))


def _dated(raw: Column) -> tuple[Column, Column]:
    """The date of a roll call and the text it was read from, which stays where it can't be read."""
    head = F.when(F.contains(raw, F.lit(",")), F.regexp_extract(raw, r"^([^,]*,[^,]*)", 1)).otherwise(raw)
    return month_name_date(head), raw


def _positions(rows: DataFrame, ids: Column, cast: Column, name: str) -> DataFrame:
    """A member's first entry of a roll call counts; entries without a member or a vote are left out."""
    both = rows.select("_path", F.posexplode(F.arrays_zip(ids.alias(name), cast.alias("position"))).alias("_at", "m")).select("_path", "_at", f"m.{name}", F.btrim("m.position").alias("position"))
    both = both.withColumn(name, F.btrim(name)).where((F.coalesce(F.col(name), F.lit("")) != "") & (F.coalesce("position", F.lit("")) != ""))
    return first_row_per_key(both, ["_path", name], [F.col("_at")]).drop("_at")


def _meta(rows: DataFrame, chamber: str, base: str, names: dict[str, str]) -> DataFrame:
    one = lambda path: blank_to_null(F.xpath_string("value", F.lit(f"{base}/{path}")))
    out = rows.select("_path", F.lit(chamber).alias("chamber"), *[one(v).alias(k) for k, v in names.items()])
    day, raw = _dated(F.col("vote_date"))
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "").try_cast("int")
    return out.withColumns({"vote_date_raw": raw, "vote_date": day, "congress": digits("congress"), "session": digits("session"), "roll_number": F.col("roll_number").try_cast("int")})


def house_votes(votes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metadata and positions (by bioguide id) of House roll calls."""
    at = "rollcall-vote/vote-data/recorded-vote[legislator/@name-id and vote/text()]"
    meta = _meta(votes, "house", "rollcall-vote/vote-metadata", {"congress": "congress", "session": "session", "roll_number": "rollcall-num", "vote_date": "action-date", "question": "vote-question", "description": "vote-desc", "result": "vote-result", "legis_num": "legis-num"})
    return meta, _positions(votes, F.xpath("value", F.lit(f"{at}/legislator/@name-id")), F.xpath("value", F.lit(f"{at}/vote/text()")), "bioguide_id")


def senate_votes(votes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metadata and positions (by the Senate's own member id) of Senate roll calls."""
    at = "roll_call_vote/members/member[lis_member_id/text() and vote_cast/text()]"
    meta = _meta(votes, "senate", "roll_call_vote", {"congress": "congress", "session": "session", "roll_number": "vote_number", "vote_date": "vote_date", "question": "question", "description": "vote_title", "result": "vote_result", "legis_num": "document/document_name"})
    return meta, _positions(votes, F.xpath("value", F.lit(f"{at}/lis_member_id/text()")), F.xpath("value", F.lit(f"{at}/vote_cast/text()")), "lis_member_id")


def mapped_positions(positions: DataFrame, legislators: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Senate positions by bioguide id, and how many of each roll call have no known member."""
    known = legislators.where("lis_id IS NOT NULL").groupBy(F.col("lis_id").alias("lis_member_id")).agg(F.min("bioguide_id").alias("bioguide_id"))
    rows = positions.join(known, "lis_member_id", "left")
    return rows.where("bioguide_id IS NOT NULL").drop("lis_member_id"), rows.where("bioguide_id IS NULL").groupBy("_path").agg(F.count("*").alias("unmapped"))


def vote_id(chamber: Column, congress: Column, session: Column, roll: Column) -> Column:
    return F.concat_ws("-", chamber, congress.cast("string"), session.cast("string"), roll.cast("string"))
