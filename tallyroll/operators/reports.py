"""The composite reports: summaries of owners, the league, recipients and states, audits and briefs, as DataFrames.

Donations have: entity_slug, entity_kind, parent_owner_slug, status, amount, date, election_cycle, party, committee_id,
committee_name, recipient_type. Money is exact and leaves as a double; sums of what is adjusted for prices are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.links import federal_filing
from ..functions.money import MONEY, cpi_adjusted, ratio
from ..functions.text import committee_bucket, party_bucket
from .rollup import dollars, listed, tier_measures, top_per_group, two_level_arg_max

TIERS = ("CONFIRMED", "PROBABLE")


def with_real(donations: DataFrame) -> DataFrame:
    """Adds owner (the household), and amount_real in dollars of the base year."""
    return donations.withColumns({"owner": F.coalesce("parent_owner_slug", "entity_slug"), "amount_real": cpi_adjusted(F.col("amount"), F.coalesce("election_cycle", F.year("date")))})


def display_rows(donations: DataFrame) -> DataFrame:
    """Rows as pages show them: dollars of the base year to the cent, the party's bucket, the kind of committee, and the page of the filing where its number is known."""
    rows = with_real(donations)
    return rows.withColumns({
        "amount_real": F.round("amount_real", 2), "party": party_bucket(F.col("party")), "recipient_type": committee_bucket(F.col("committee_type")), "filing_url": federal_filing(F.col("filing_id")),
    })


def _real() -> Column:
    return F.round(F.sum("amount_real"), 2)


def by_party(rows: DataFrame, key: str, *inner: str, amount: str = "amount") -> DataFrame:
    """key and `cells`: a sorted array of the inner keys and dollars, one entry each; what a JSON payload makes a map of."""
    sums = rows.groupBy(key, *inner).agg(dollars(F.col(amount)).alias("usd"), F.count("*").alias("n"))
    return sums.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*inner, "usd", "n"))).alias("cells"))


def _sums(rows: DataFrame) -> DataFrame:
    """Sums by all that is counted: rows of one entity, committee and cycle are one, so that distinct counts on top of it copy few rows."""
    usd, own = F.col("amount").cast(MONEY), F.col("entity_slug") == F.col("owner")
    when = lambda c, v: F.sum(F.when(c, v))
    return rows.withColumn("committee_id", F.coalesce("committee_id", F.lit("_unknown"))).groupBy("owner", "entity_slug", "committee_id", "election_cycle").agg(
        F.count("*").alias("n"), F.sum(usd).alias("usd"), F.sum("amount_real").alias("real"), F.min("date").alias("first"), F.max("date").alias("last"),
        *[F.count_if(F.col("status") == t).alias(f"n_{t.lower()}") for t in TIERS], *[when(F.col("status") == t, usd).alias(f"usd_{t.lower()}") for t in TIERS],
    ).withColumn("own", own)


def _tiers_of_sums() -> list[Column]:
    """tier_measures of _sums()."""
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return [x for t in TIERS for x in (zero(f"n_{t.lower()}").alias(f"n_{t.lower()}"), zero(f"usd_{t.lower()}").cast("double").alias(f"usd_{t.lower()}"))]


def owner_summary(donations: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One row an owner: totals of the household and of the owner alone, tiers by count and by dollars, reach, dates, runs."""
    own = F.col("own")
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = _sums(with_real(donations)).groupBy("owner").agg(
        F.sum("n").alias("n_total"), zero(F.sum("usd")).cast("double").alias("total_amount"), F.round(F.sum("real"), 2).alias("total_amount_real"), *_tiers_of_sums(),
        zero(F.sum(F.when(own, F.col("n")))).alias("n_owner_only"), zero(F.sum(F.when(own, F.col("usd")))).cast("double").alias("owner_only_amount"), F.round(zero(F.sum(F.when(own, F.col("real")))), 2).alias("owner_only_amount_real"),
        F.countDistinct(F.when(~own, F.col("entity_slug"))).alias("household_members"), F.countDistinct("committee_id").alias("distinct_recipients"),
        F.countDistinct("election_cycle").alias("n_cycles"), F.min("first").alias("earliest_date"), F.max("last").alias("latest_date"),
    )
    if runs is None:
        return out
    last = runs.groupBy(F.col("entity_slug").alias("owner")).agg(F.count("*").alias("n_runs"), F.max(F.struct("started_at", "run_id")).alias("l")).select("owner", "n_runs", F.col("l.run_id").alias("last_run_id"), F.col("l.started_at").alias("last_run_at"))
    return out.join(last, "owner", "left").na.fill(0, ["n_runs"])


def household_members(donations: DataFrame) -> DataFrame:
    """Each relative of an owner who gave, with tiers; the owner's own gifts aren't among them."""
    rows = with_real(donations).where(F.col("entity_slug") != F.col("owner"))
    return rows.groupBy("owner", "entity_slug", "entity_kind").agg(F.count("*").alias("n_total"), dollars(F.col("amount")).alias("total_amount"), _real().alias("total_amount_real"), *tier_measures(F.col("status"), F.col("amount"), TIERS))


def household_view(donations: DataFrame, slug: str) -> DataFrame:
    """Members of one household with their totals, the owner first, then by dollars."""
    rows = donations.where((F.col("entity_slug") == slug) | (F.col("parent_owner_slug") == slug))
    sums = rows.groupBy("entity_slug", "entity_kind").agg(F.count("*").alias("n_total"), dollars(F.col("amount")).alias("total_amount"), *tier_measures(F.col("status"), F.col("amount"), TIERS))
    return sums.orderBy((F.col("entity_kind") == "owner").desc(), F.desc("total_amount"), "entity_slug")


def top_recipients(donations: DataFrame, n: int = 8, by: str = "owner") -> DataFrame:
    """The n committees that each owner gave most to; those without an id are one, named _unknown."""
    rows = with_real(donations).withColumn("committee_id", F.coalesce("committee_id", F.lit("_unknown")))
    last = F.struct("date", "status", "committee_name", "party")
    sums = rows.groupBy(by, "committee_id").agg(F.sum(F.col("amount").cast(MONEY)).alias("total"), _real().alias("total_amount_real"), F.count("*").alias("n"), F.max(last).alias("l"))
    top = top_per_group(sums, [by], [F.desc("total"), F.col("committee_id")], n)
    return top.select(by, "rank", "committee_id", F.col("l.committee_name").alias("committee_name"), F.col("l.party").alias("party"), F.col("total").cast("double").alias("total_amount"), "total_amount_real", "n")


def league(donations: DataFrame) -> DataFrame:
    """One row: what all owners gave together."""
    return _sums(with_real(donations)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_donations"), F.coalesce(F.sum("usd"), F.lit(0)).cast("double").alias("total_amount"), F.coalesce(F.round(F.sum("real"), 2), F.lit(0.0)).alias("total_amount_real"), *_tiers_of_sums(),
        F.countDistinct("owner").alias("n_owners"), F.countDistinct("election_cycle").alias("n_cycles"), F.min("first").alias("earliest_date"), F.max("last").alias("latest_date"),
    )


def recipients(donations: DataFrame) -> DataFrame:
    """One row a committee: totals, owners, cycles, dates; the kind is that of the earliest gift that has one but Other, name and party are those of the last gift."""
    rows = with_real(donations).where("committee_id IS NOT NULL AND committee_id <> ''")
    kind = F.coalesce(F.min(F.when(F.coalesce("recipient_type", F.lit("Other")) != "Other", F.struct("date", "recipient_type")))["recipient_type"], F.lit("Other"))
    last = F.max(F.struct("date", "committee_name", "party"))
    return rows.groupBy("committee_id").agg(
        last["committee_name"].alias("committee_name"), last["party"].alias("party"), kind.alias("recipient_type"), dollars(F.col("amount")).alias("total_amount"), _real().alias("total_amount_real"), F.count("*").alias("n_donations"),
        F.countDistinct("owner").alias("n_owners"), listed(F.col("election_cycle").cast("string")).alias("cycles"), F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"),
    )


#: What each section of a payload is keyed by.
SECTIONS = {"league": (), "owner": ("owner",), "cell": ("owner", "election_cycle", "party"), "recipient": ("committee_id",)}


def payload(donations: DataFrame) -> DataFrame:
    """All sections of a dashboard's payload from one scan: section, its keys (owner, election_cycle, party, committee_id), n, total_amount, confirmed_amount, earliest_date, latest_date, and how many members, recipients, owners and cycles there are.

    The first sums are by all keys together; grouping sets over these pair the keys, and pairs are counted instead of
    distinct values: an owner has as many recipients as there are pairs of them. Counts that a section doesn't have are null.
    """
    usd = F.col("amount").cast(MONEY)
    keys = ["owner", "entity_slug", "committee_id", "election_cycle", "party"]
    sums = [F.count("*").alias("n"), F.sum(usd).alias("usd"), F.sum(F.when(F.col("status") == "CONFIRMED", usd)).alias("sure"), F.min("date").alias("first"), F.max("date").alias("last")]
    rows = donations.withColumn("owner", F.coalesce("parent_owner_slug", "entity_slug")).withColumn("committee_id", F.coalesce("committee_id", F.lit("_unknown")))
    cells = rows.groupBy(*keys).agg(*sums)
    pairs = (("owner", "entity_slug"), ("owner", "committee_id"), ("owner", "election_cycle"), ("owner", "election_cycle", "party"), ("committee_id", "election_cycle"), ("owner",), ("election_cycle",))
    again = [F.sum("n").alias("n"), F.sum("usd").alias("usd"), F.sum("sure").alias("sure"), F.min("first").alias("first"), F.max("last").alias("last")]
    paired = cells.groupingSets([list(p) for p in pairs], *keys).agg(F.grouping_id().alias("set"), *again)
    number = {p: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in p) for p in pairs}
    none, no_sum = F.lit(None).cast("string"), {"n": F.lit(0).cast("long"), "usd": F.lit(None), "sure": F.lit(None)}

    def counted(section: str, what: str | None = None, value: Column | None = None, summed: bool = False) -> Column:
        own = [F.col(k).cast("string").alias(k) if k in SECTIONS[section] else none.alias(k) for k in ("owner", "election_cycle", "party", "committee_id")]
        totals = [(F.col(k) if summed else no_sum[k].cast(paired.schema[k].dataType)).alias(k) for k in ("n", "usd", "sure")]
        counts = [F.when(F.lit(c == what), F.lit(1) if value is None else value.cast("int")).cast("long").alias(c) for c in ("members", "recipients", "owners", "cycles")]
        return F.struct(F.lit(section).alias("section"), *own, *totals, "first", "last", *counts)

    gives = {
        pairs[0]: [counted("owner", "members", F.col("entity_slug") != F.col("owner"))],
        pairs[1]: [counted("owner", "recipients", summed=True), counted("recipient", "owners", summed=True)],
        pairs[2]: [counted("owner", "cycles")],
        pairs[3]: [counted("cell", summed=True)],
        pairs[4]: [counted("recipient", "cycles")],
        pairs[5]: [counted("league", "owners", summed=True)],
        pairs[6]: [counted("league", "cycles")],
    }
    lines = F
    for pair, structs in gives.items():
        lines = lines.when(F.col("set") == number[pair], F.array(*structs))
    by = ["section", "owner", "election_cycle", "party", "committee_id"]
    out = paired.select(F.inline(lines)).groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("usd").cast("double").alias("total_amount"), F.coalesce(F.sum("sure"), F.lit(0)).cast("double").alias("confirmed_amount"), F.min("first").alias("earliest_date"), F.max("last").alias("latest_date"), *[F.sum(c).alias(c) for c in ("members", "recipients", "owners", "cycles")],
    )
    return out.withColumn("election_cycle", F.col("election_cycle").cast("int"))


def candidate_top_committee(donations: DataFrame) -> DataFrame:
    return two_level_arg_max(donations, "candidate_id", "committee_id", "amount")


# -- states


def state_rows(donations: DataFrame, filers: DataFrame) -> DataFrame:
    """State donations with recipient, recipient_type, party, office (of the filer where it is known, else as filed) and recipient_key."""
    keys = ["jurisdiction", "source", "recipient_filer_id"]
    known = filers.select("jurisdiction", "source", F.col("filer_id").alias("recipient_filer_id"), *[F.col(c).alias(f"__{c}") for c in ("name", "filer_type", "party", "office")])
    rows = with_real(donations).join(known, keys, "left")
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    rows = rows.withColumn("recipient", F.coalesce(given("__name"), given("recipient_name"), F.lit("(recipient unidentified)")))
    key = F.concat_ws(":", "jurisdiction", "source", F.coalesce(given("recipient_filer_id"), F.concat(F.lit("name:"), "recipient")))
    more = {"recipient_type": F.coalesce(given("__filer_type"), "recipient_type"), "party": F.coalesce(given("__party"), "recipient_party"), "office": F.coalesce(given("__office"), "recipient_office"), "recipient_key": key}
    return rows.withColumns(more).drop("__name", "__filer_type", "__party", "__office")


def _state_measures() -> list[Column]:
    return [*[F.count_if(F.col("status") == t).alias(f"n_{t.lower()}") for t in TIERS], dollars(F.col("amount")).alias("total_amount"), _real().alias("total_amount_real")]


def state_owners(rows: DataFrame) -> DataFrame:
    return rows.groupBy("entity_slug").agg(*_state_measures(), listed(F.col("jurisdiction")).alias("jurisdictions"), F.countDistinct("recipient_key").alias("n_recipients"), listed(F.col("election_cycle").cast("string")).alias("cycles"))


def state_jurisdictions(rows: DataFrame) -> DataFrame:
    return rows.groupBy("jurisdiction").agg(*_state_measures(), F.countDistinct("entity_slug").alias("n_owners"))


def state_recipients(rows: DataFrame) -> DataFrame:
    last = F.max(F.struct("date", "recipient", "recipient_type", "party", "office"))
    return rows.groupBy("recipient_key", "jurisdiction", "source").agg(last["recipient"].alias("recipient"), last["recipient_type"].alias("recipient_type"), last["party"].alias("party"), last["office"].alias("office"), *_state_measures(), F.countDistinct("entity_slug").alias("n_owners"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def state_top(rows: DataFrame, group: str, inner: str, n: int) -> DataFrame:
    """The n inner keys of each group with the most dollars: recipients of owners or jurisdictions, donors of recipients."""
    sums = rows.groupBy(group, inner).agg(F.sum(F.col("amount").cast(MONEY)).alias("total"))
    return top_per_group(sums, [group], [F.desc("total"), F.col(inner)], n).select(group, "rank", inner, F.col("total").cast("double").alias("total_amount"))


def coverage_matrix(owners: DataFrame, jurisdictions: DataFrame, runs: DataFrame, opt_outs: DataFrame) -> DataFrame:
    """A row per owner and jurisdiction that was run or opted out of: state, and the counts of the last run.

    owners: owner_slug; jurisdictions: jurisdiction; runs: owner_slug, jurisdiction, started_at, scanned, confirmed, probable,
    uncertain; opt_outs: owner_slug, jurisdiction. An opt-out needs no run.
    """
    keys = ["owner_slug", "jurisdiction"]
    last = runs.groupBy(*keys).agg(F.max(F.struct("started_at", "scanned", "confirmed", "probable", "uncertain")).alias("l")).select(*keys, "l.*")
    cells = last.join(opt_outs.select(*keys).distinct().withColumn("__out", F.lit(True)), keys, "full")
    cells = cells.join(owners, "owner_slug", "left_semi").join(jurisdictions, "jurisdiction", "left_semi")
    state = F.when(F.col("__out"), "opted out").when(F.col("confirmed") + F.col("probable") > 0, "found").otherwise("searched")
    return cells.select(*keys, state.alias("state"), "started_at", "scanned", "confirmed", "probable", "uncertain")


# -- audits

# Employers that name none.
GENERIC_EMPLOYERS = ("self", "self-employed", "self employed", "selfemployed", "retired", "not employed", "unemployed", "n/a", "none", "homemaker", "housewife", "house wife", "house-wife", "investor", "private investor")


def by_signal_field(donations: DataFrame, status: str, field: str, least: int = 1, blank: bool = True) -> DataFrame:
    """Rows of one tier per owner and value of a field (employer, ZIP): counts, dollars and cities, most rows first. blank: whether rows without a value are one of the values."""
    value = F.upper(F.btrim(F.coalesce(field, F.lit(""))))
    rows = donations.where(F.col("status") == status).withColumn("value", value)
    rows = rows if blank else rows.where("value <> ''")
    sums = rows.groupBy("entity_slug", "value").agg(F.count("*").alias("n"), dollars(F.col("amount")).alias("total_amount"), listed(F.col("contributor_city")).alias("cities"))
    return sums.where(F.col("n") >= least).orderBy("entity_slug", F.desc("n"), "value")


def suggestions(donations: DataFrame, registry: DataFrame, least: int = 2) -> DataFrame:
    """Employers of PROBABLE rows that no signal of the owner names yet: what could become one, once somebody has looked. Generic ones name nobody; an owner without an entry has no signals."""
    from .classify import NEEDLES
    from ..functions.text import norm, starts_token

    found = by_signal_field(donations, "PROBABLE", "contributor_employer", least, blank=False)
    found = found.where(~F.lower("value").isin(*GENERIC_EMPLOYERS))
    known = registry.select(F.col("slug").alias("entity_slug"), F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in NEEDLES if c != "occupations"]).alias("__known"))
    rows = found.join(known, "entity_slug", "left").withColumn("__known", F.coalesce("__known", F.array().cast("array<string>")))
    return rows.where(~F.exists("__known", lambda k: starts_token(norm(F.col("value")), norm(k)))).drop("__known")


#: Tables of an audit: tier and field.
AUDIT = {"probable_by_employer": ("PROBABLE", "contributor_employer"), "probable_by_zip": ("PROBABLE", "contributor_zip"), "confirmed_by_zip": ("CONFIRMED", "contributor_zip")}


def audit_tables(donations: DataFrame, queue: DataFrame, n: int = 10) -> DataFrame:
    """All owners' audit tables from one scan of donations: entity_slug, section, rank, value, n, cities, states and employers, the n most frequent values of each.

    Sections: AUDIT (rows of a tier by employer as filed, or by ZIP code where there is one) and queue_reasons (open
    items). cities, states and employers are sorted, distinct and joined by commas.
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    cells = F.array(*[F.struct(F.lit(k).alias("section"), F.lit(tier).alias("tier"), text(field).alias("value")) for k, (tier, field) in AUDIT.items()])
    rows = donations.select("entity_slug", "status", "contributor_city", "contributor_state", "contributor_employer", F.inline(cells)).where("status = tier AND (value <> '' OR section = 'probable_by_employer')")
    by = ["entity_slug", "section", "value"]
    lists = {"cities": "contributor_city", "states": "contributor_state", "employers": "contributor_employer"}
    # distinct combinations first: the lists are of few values, the rows may be many
    sums = rows.groupBy(*by, *lists.values()).agg(F.count("*").alias("n")).groupBy(*by).agg(F.sum("n").alias("n"), *[listed(F.col(c)).alias(k) for k, c in lists.items()])
    reasons = queue.where("resolution IS NULL").groupBy("entity_slug", F.lit("queue_reasons").alias("section"), text("reason").alias("value")).agg(F.count("*").alias("n"))
    both = sums.unionByName(reasons, allowMissingColumns=True)
    return top_per_group(both, ["entity_slug", "section"], [F.desc("n"), F.col("value")], n).select("entity_slug", "section", "rank", "value", "n", *lists)


def audit_counts(donations: DataFrame, queue: DataFrame, runs: DataFrame, registry: DataFrame) -> DataFrame:
    """A row for each owner of the registry: rows by tier, open items, and when the last run was done (null where there was none)."""
    owners = registry.where("parent_slug IS NULL").select(F.col("slug").alias("entity_slug")).distinct()
    tiers = donations.groupBy("entity_slug").agg(*[F.count_if(F.col("status") == t).alias(t.lower()) for t in TIERS])
    items = queue.where("resolution IS NULL").groupBy("entity_slug").agg(F.count("*").alias("uncertain_open"))
    last = runs.groupBy("entity_slug").agg(F.max("completed_at").alias("last_run"))
    out = owners.join(tiers, "entity_slug", "left").join(items, "entity_slug", "left").join(last, "entity_slug", "left")
    return out.na.fill(0, [t.lower() for t in TIERS] + ["uncertain_open"])


def audit_suggestions(tables: DataFrame, registry: DataFrame, least: int = 2) -> DataFrame:
    """What the audit's tables suggest to look at: entity_slug, suggestion, value and n. Nobody's signals change by it.

    promote_employer: an employer of PROBABLE rows that holds a documented, but not a strong one; add_zip: a ZIP code of
    CONFIRMED rows that isn't among the strong ones; review_employer: an employer that no signal names, neither generic nor
    negative: perhaps another person of the same name; check_city: one of the three most frequent cities of PROBABLE rows
    that aren't documented. The first two look at the five most frequent values. Words are held against each other in lower
    case; an owner without an entry has no signals.
    """
    none = F.array().cast("array<string>")
    lower = lambda c: F.transform(F.filter(F.coalesce(c, none), lambda x: F.coalesce(x, F.lit("")) != ""), F.lower)
    known = registry.select(F.col("slug").alias("entity_slug"), *[lower(F.col(c)).alias(f"__{c}") for c in ("employers", "strong_employers", "negative_employers", "cities")], F.coalesce("strong_zips", none).alias("__zips"))
    rows = tables.join(known, "entity_slug", "left").withColumns({c: F.coalesce(c, none) for c in known.columns if c != "entity_slug"})
    value = F.btrim("value")
    low = F.lower(value)
    within = lambda c: F.exists(c, lambda s: F.contains(low, s))
    employer = (F.col("section") == "probable_by_employer") & (value != "") & (F.col("n") >= least)
    kind = (
        F.when(employer & (F.col("rank") <= 5) & within("__employers") & ~within("__strong_employers"), "promote_employer")
        .when(employer & ~within("__employers") & ~within("__strong_employers") & ~within("__negative_employers") & ~low.isin(*GENERIC_EMPLOYERS), "review_employer")
        .when((F.col("section") == "confirmed_by_zip") & (F.col("rank") <= 5) & (F.col("n") >= least) & ~F.array_contains("__zips", value), "add_zip")
    )
    first = rows.select("entity_slug", kind.alias("suggestion"), value.alias("value"), "n").where("suggestion IS NOT NULL")
    places = rows.where("section = 'probable_by_employer'").select("entity_slug", "n", "__cities", F.explode(F.array_distinct(F.transform(F.split("cities", ","), lambda c: F.lower(F.btrim(c))))).alias("value"))
    places = places.where(~F.array_contains("__cities", F.col("value")) & (F.col("value") != "")).groupBy("entity_slug", "value").agg(F.sum("n").alias("n"))
    top = top_per_group(places, ["entity_slug"], [F.desc("n"), F.col("value")], 3).where(F.col("n") >= least)
    return first.unionByName(top.select("entity_slug", F.lit("check_city").alias("suggestion"), "value", "n"))


def sampled(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows at random, the same for the same seed: those of the smallest seeded hashes of the key."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def adjudicated(queue: DataFrame) -> DataFrame:
    """Per owner the share of settled items, in percent."""
    return queue.groupBy("entity_slug").agg(F.count("*").alias("items"), F.count("resolution").alias("settled"), F.round(ratio(F.count("resolution") * 100.0, F.count("*")), 1).alias("percent"))


def run_totals(runs: DataFrame) -> DataFrame:
    """One row: what all runs read and asked for."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return runs.agg(F.count("*").alias("n_runs"), F.min("started_at").alias("earliest_run"), F.max("started_at").alias("latest_run"), total("records_fetched").alias("total_records_fetched"), total("api_calls").alias("total_api_calls"), F.count_if(F.coalesce("dry_run", F.lit(False))).alias("n_dry_runs"))


# -- legislation


def brief(rows: DataFrame, by: list[str], owner: str, gift: str) -> DataFrame:
    """Per bill (or other keys `by`): each owner's gift counted once, by tier of its first row; the owners and the dollars."""
    order = F.struct(*[F.col(c) for c in ("status", "bioguide")])
    one = rows.groupBy(*by, owner, gift).agg(F.min(order)["status"].alias("status"), F.max("amount").alias("amount"))
    return one.groupBy(*by).agg(F.count("*").alias("gifts"), F.countDistinct(owner).alias("owners"), dollars(F.col("amount")).alias("total_amount"), *tier_measures(F.col("status"), F.col("amount"), TIERS))


def legislation_coverage(donations: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """One row: distinct candidates of donations, those that a legislator is known for, and the share in percent."""
    people = donations.where("coalesce(candidate_id, '') <> ''").select("candidate_id").distinct().join(crosswalk.groupBy("candidate_id").agg(F.min("bioguide").alias("bioguide")), "candidate_id", "left")
    n, known = F.count("*"), F.count("bioguide")
    return people.agg(n.alias("candidates"), known.alias("resolved"), (n - known).alias("unresolved"), F.round(ratio(known * 100.0, n), 1).alias("percent"))


def missing_voters(positions: DataFrame, people: DataFrame) -> DataFrame:
    """Members with positions whom the table of legislators doesn't have, with the number of their positions."""
    return positions.join(people.select("bioguide"), "bioguide", "left_anti").groupBy("bioguide").agg(F.count("*").alias("positions"))
