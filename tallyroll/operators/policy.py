"""Joins from contributions to legislators, sponsors, votes and committees, and their rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rollup import dollars, tier_measures

#: Copies of a list of bills, so that the donations that get the same list go to as many tasks.
SALTS = 16
#: Bills of a list that are gathered at once.
PIECE = 1000
#: Parquet's writer holds 100 rows before it first looks at their size, and writes a long string that rows share once for each of
#: them: 100 lists of a megabyte don't fit a task. Rows are looked at after 8, a dictionary may have 32 MB, and lists aren't compared
#: byte by byte for a least and a largest one.
LONG_ROWS = {"parquet.page.size.row.check.min": "8", "parquet.dictionary.page.size": str(32 << 20), "parquet.column.statistics.enabled#bill_ids": "false"}


def single_candidate(designation: Column, candidate_ids: Column) -> Column:
    """Whether a committee is a principal or authorised one of exactly one candidate; candidate_ids is a JSON array."""
    return designation.isin("P", "A") & F.coalesce(F.json_array_length(candidate_ids) == 1, F.lit(False))


def resolved_donations(donations: DataFrame, crosswalk: DataFrame, committees: DataFrame | None = None, counted_only: bool = True) -> DataFrame:
    """Donations beside the legislators they reach, with join_tier: "direct" by candidate id and, if committees are given, "indirect" by a committee of one candidate.

    Rows that a column `counted` says are copies of another one are left out, unless counted_only is False.
    """
    if counted_only and "counted" in donations.columns:
        donations = donations.where(F.coalesce("counted", F.lit(True)))
    direct = donations.join(crosswalk, F.col("recipient_candidate_id") == F.col("candidate_id")).withColumn("join_tier", F.lit("direct"))
    if committees is None:
        return direct
    alone = committees.where(single_candidate(F.col("designation"), F.col("candidate_ids"))).select("committee_id", F.get_json_object("candidate_ids", "$[0]").alias("only_candidate"))
    blank = F.coalesce("recipient_candidate_id", F.lit("")) == ""
    indirect = donations.where(blank).join(alone, F.col("recipient_committee_id") == F.col("committee_id")).join(crosswalk, F.col("only_candidate") == F.col("candidate_id"))
    return direct.unionByName(indirect.drop("committee_id", "only_candidate").withColumn("join_tier", F.lit("indirect")))


def with_votes(resolved: DataFrame, positions: DataFrame, votes: DataFrame) -> DataFrame:
    """A row per donation and vote of the legislator, with the signed number of days from gift to vote."""
    return resolved.join(positions, "bioguide").join(votes, "vote_id").withColumn("days_before_vote", F.datediff("vote_date", "date"))


def with_sponsors(resolved: DataFrame, sponsors: DataFrame) -> DataFrame:
    return resolved.join(sponsors, "bioguide")


def with_committees(resolved: DataFrame, memberships: DataFrame, bill_committees: DataFrame) -> DataFrame:
    """A row per donation, member and committee, with the sorted list of the bills that were referred to it in a congress of the membership.

    Seats of one member in several congresses are one row with the bills of all of them. A list grows with the bills, so there
    is one for each committee and set of congresses, not for each member; it meets the donations last, in a merge join over
    SALTS copies of it, and is never broadcast, nor are the bills. The session writes Parquet by LONG_ROWS from then on, where it has no other
    values for them, so that files hold a list once and not once a row.
    """
    conf = resolved.sparkSession.conf
    for k, v in LONG_ROWS.items():
        conf.set(k, conf.get(k, v))
    held = bill_committees.select("thomas_id", "congress").distinct()
    seats = memberships.select("bioguide", "thomas_id", "congress").distinct().join(held, ["thomas_id", "congress"], "left_semi")
    seats = seats.groupBy("bioguide", "thomas_id").agg(F.array_sort(F.collect_set("congress")).alias("__terms"))
    terms = seats.select("thomas_id", "__terms").distinct()
    asked = terms.select("thomas_id", "__terms", F.explode("__terms").alias("congress")).join(bill_committees.hint("merge"), ["thomas_id", "congress"])
    lists = _listed(asked, ["thomas_id", "__terms"], "bill_id", "bill_ids")
    lists = lists.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = resolved.join(seats, "bioguide").withColumn("__salt", F.pmod(F.xxhash64(*[c for c, kind in resolved.dtypes if "map<" not in kind]), F.lit(SALTS)).cast("int"))
    return rows.join(lists.hint("merge"), ["thomas_id", "__terms", "__salt"]).select(*_first("bioguide", resolved.columns), "thomas_id", "bill_ids")


def _listed(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """keys and `name`, the sorted distinct values of each of them, joined by commas.

    Values are sorted as rows, which can spill, in as many tasks as a shuffle has, and joined by pieces of PIECE; no set of all
    values of a key is held. A null adds nothing to a list but keeps its key.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first(value)))
    rows = rows.select(*keys, value).distinct().repartition(n, *keys).withColumn("__piece", F.floor((place - 1) / PIECE))
    pieces = rows.groupBy(*keys, "__piece").agg(F.array_join(F.array_sort(F.collect_list(value)), ",").alias("__values"))
    inner = F.array_sort(F.collect_list(F.struct("__piece", "__values")))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(inner, lambda x: x["__values"]), ",").alias(name))


def _first(key: str, columns: list[str]) -> list[str]:
    """Columns in the order in which a join by the key gives them."""
    return [key, *[c for c in columns if c != key]]


def vote_rollup(votes: DataFrame, by: str) -> DataFrame:
    """Counts a gift once for each of its vote rows."""
    return votes.groupBy(by).agg(F.count("*").alias("rows"), dollars(F.col("amount")).alias("total_amount"), F.count_if(F.col("position") == "Yea").alias("yea"), F.count_if(F.col("position") == "Nay").alias("nay"), F.countDistinct("bioguide").alias("legislators"), *(tier_measures(F.col("status"), F.col("amount"), ("CONFIRMED", "PROBABLE")) if "status" in votes.columns else []))


def brief_rollup(votes: DataFrame, by: str, gift: str) -> DataFrame:
    """Counts a gift once, however many votes it meets."""
    return votes.select(by, gift, "amount").dropDuplicates([by, gift]).groupBy(by).agg(F.count("*").alias("gifts"), dollars(F.col("amount")).alias("total_amount"))


# -- reports: who gave to those who vote on, sponsor or sit in a committee over a list of bills


_GIFT = {
    "owner_slug": "entity_slug", "transaction_id": "transaction_id", "amount": "amount", "donation_date": "date", "donation_status": "status", "recipient_committee_name": "recipient_committee_name",
    "recipient_candidate_id": "recipient_candidate_id", "recipient_candidate_name": "recipient_candidate_name", "join_tier": "join_tier", "bioguide": "bioguide",
}
PUBLISHED = ("CONFIRMED", "PROBABLE")


def _gifts(resolved: DataFrame, statuses: tuple[str, ...]) -> DataFrame:
    return resolved.where(F.col("status").isin(*statuses)).select(*[F.col(v).alias(k) for k, v in _GIFT.items()])


def _dressed(rows: DataFrame, entities: DataFrame, legislators: DataFrame, *more: str) -> DataFrame:
    """rows with the owner's name and team, where they are known, and the legislator's name, party and state, the largest gifts first."""
    owners = entities.select(F.col("slug").alias("owner_slug"), F.col("name").alias("owner_name"), F.col("team").alias("owner_team"))
    people = legislators.select("bioguide", F.col("full_name").alias("legislator_name"), F.col("current_party").alias("legislator_party"), F.col("current_state").alias("legislator_state"))
    out = rows.join(people, "bioguide").join(owners, "owner_slug", "left").withColumnRenamed("bioguide", "legislator_bioguide")
    first = ["owner_slug", "owner_name", "owner_team", *[k for k in _GIFT if k not in ("owner_slug", "bioguide")], "legislator_bioguide", "legislator_name", "legislator_party", "legislator_state"]
    return out.select(*first, *more).orderBy(F.desc("amount"), "donation_date", "transaction_id", "legislator_bioguide", *more)


def vote_report(resolved: DataFrame, bills: DataFrame, votes: DataFrame, positions: DataFrame, entities: DataFrame, legislators: DataFrame, statuses: tuple[str, ...] = PUBLISHED) -> DataFrame:
    """A row per gift and recorded vote of its legislator on one of the bills, with the signed days from gift to vote.

    resolved: resolved_donations(); bills: bill_id; votes: vote_id, bill_id, chamber, vote_date, question, result,
    source_url; positions: vote_id, bioguide, position; entities: slug, name, team; legislators: bioguide, full_name,
    current_party, current_state. No bills give no rows. The votes on the bills are found before they meet the gifts.
    """
    asked = votes.join(bills.select("bill_id").distinct(), "bill_id", "left_semi").select(*[F.col(c).alias(f"vote_{c.removeprefix('vote_')}") for c in ("vote_id", "bill_id", "chamber", "vote_date", "question", "result", "source_url")])
    cast = positions.select("bioguide", "vote_id", F.col("position").alias("legislator_position")).join(asked, "vote_id")
    rows = _gifts(resolved, statuses).join(cast, "bioguide").withColumn("days_before_vote", F.datediff("vote_date", "donation_date"))
    return _dressed(rows, entities, legislators, *asked.columns, "legislator_position", "days_before_vote")


def sponsor_report(resolved: DataFrame, bills: DataFrame, sponsors: DataFrame, entities: DataFrame, legislators: DataFrame, statuses: tuple[str, ...] = PUBLISHED) -> DataFrame:
    """A row per gift and sponsorship of one of the bills by its legislator. sponsors: bill_id, bioguide, role."""
    asked = sponsors.join(bills.select("bill_id").distinct(), "bill_id", "left_semi").select("bioguide", "bill_id", F.col("role").alias("sponsor_role"))
    return _dressed(_gifts(resolved, statuses).join(asked, "bioguide"), entities, legislators, "bill_id", "sponsor_role")


def committee_report(resolved: DataFrame, bills: DataFrame, bill_committees: DataFrame, committees: DataFrame, memberships: DataFrame, entities: DataFrame, legislators: DataFrame, statuses: tuple[str, ...] = PUBLISHED) -> DataFrame:
    """A row per gift, committee and member, with the sorted list of the bills that the committee holds.

    Memberships are those of one congress, so only bills of the congress of the committee's row count. bills: bill_id,
    congress; bill_committees: bill_id, thomas_id; committees: thomas_id, name, congress; memberships: thomas_id, bioguide,
    title. A member who is listed twice in a committee has one row, under the first title.
    """
    held = bill_committees.select("bill_id", "thomas_id").join(bills.select("bill_id", "congress").distinct(), "bill_id").join(committees.select("thomas_id", "congress", F.col("name").alias("committee_name")), ["thomas_id", "congress"])
    held = held.groupBy("thomas_id", "committee_name").agg(F.array_join(F.array_sort(F.collect_set("bill_id")), ",").alias("bill_ids"))
    seats = memberships.groupBy("thomas_id", "bioguide").agg(F.min("title").alias("member_title"))
    rows = _gifts(resolved, statuses).join(seats.join(held, "thomas_id"), "bioguide").withColumnRenamed("thomas_id", "committee_id")
    return _dressed(rows, entities, legislators, "committee_id", "committee_name", "member_title", "bill_ids")


def report_owners(rows: DataFrame) -> DataFrame:
    """Per owner of a vote report: rows, dollars by tier of the join and by the member's position, and how many legislators; the most dollars first."""
    position = F.lower(F.coalesce("legislator_position", F.lit("")))
    indirect = F.coalesce(F.startswith("join_tier", F.lit("indirect")), F.lit(False))
    # a level of sums by legislator first, so that counting them copies no row
    sums = rows.groupBy("owner_slug", "legislator_bioguide").agg(
        F.max(F.struct("owner_name", "owner_team")).alias("o"), F.count("*").alias("n"), *[F.sum(F.when(c, F.col("amount").cast("decimal(18,2)"))).alias(k) for k, c in {"total": F.lit(True), "direct": ~indirect, "indirect": indirect, "yea": position == "yea", "nay": position == "nay"}.items()]
    )
    out = sums.groupBy("owner_slug").agg(F.max("o").alias("o"), F.sum("n").alias("n_donations"), *[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(k) for k, c in {"total_amount": "total", "direct_amount": "direct", "indirect_authorized_amount": "indirect", "to_yea_amount": "yea", "to_nay_amount": "nay"}.items()], F.count("legislator_bioguide").alias("n_legislators"))
    return out.select("owner_slug", "o.owner_name", "o.owner_team", *[c for c in out.columns if c not in ("owner_slug", "o")]).orderBy(F.desc("total_amount"), "owner_slug")
