"""State contribution files as one canonical record.

A source is a declaration: where each canonical field comes from, how its recipients are looked up and which of its rows are
one contribution. bundle() turns raw string rows into canonical ones: prepare, resolve, project, each a select or a join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.money import money
from ..operators.dedup import best_row_per_key, first_by_native_id, numeric_rank
from .archives import read_members

#: Gives the cleaned text of a raw column, '' where the file has no such column.
Get = Callable[[str], Column]
Expr = Callable[[Get], Column]
#: Where a row stands in its files: path, start of the block, place in the block.
PLACE = ("_path", "_block", "_at")


def getter(df: DataFrame, null_word: bool = False) -> Get:
    names = set(df.columns)
    return lambda n: text.clean(F.col(f"`{n}`"), null_word) if n in names else F.lit("")


def either(*cols: Column) -> Column:
    """The first that isn't empty, else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def spaced(*cols: Column) -> Column:
    return F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in cols])


def comma_name(last: Column, *given: Column) -> Column:
    """Last, First Middle, or what there is of it."""
    first = spaced(*given)
    return F.when((last != "") & (first != ""), F.concat(last, F.lit(", "), first)).otherwise(either(last, first))


def kind_by(col: Column, *words: tuple[str, str], other: str | None = "committee") -> Column:
    """A kind by the first word (in lower case) that the column holds; blank gives null."""
    out = F.when(col == "", F.lit(None).cast("string"))
    for word, kind in words:
        out = out.when(F.contains(F.lower(col), F.lit(word)), kind)
    return out.otherwise(other)


@dataclass(frozen=True)
class Index:
    """A lookup table of recipients: key and fields of its rows, the column of receipts that has the key, and which row of a key counts.

    Without `rank` the first row in file order counts, else the one of the largest rank, the last of ties.
    """

    of_row: Expr
    key: Expr
    fields: dict[str, Expr]
    rank: Expr | None = None

    def built(self, rows: DataFrame, null_word: bool = False) -> DataFrame:
        """__id and _recipient_<field> of each key."""
        c = getter(rows, null_word)
        place = F.struct(*PLACE) if PLACE[0] in rows.columns else F.struct(F.monotonically_increasing_id())
        named = [v(c).alias(f"_recipient_{k}") for k, v in self.fields.items()]
        table = rows.select(self.key(c).alias("__id"), F.struct(*named).alias("f"), place.alias("p"), *([self.rank(c).alias("r")] if self.rank else [])).where("__id <> ''")
        one = F.max_by("f", F.struct("r", "p")) if self.rank else F.min_by("f", F.col("p"))
        return table.groupBy("__id").agg(one.alias("f")).select("__id", "f.*")


@dataclass(frozen=True)
class Source:
    """jurisdiction, name, format options, and the expressions of canonical fields; fields left out are empty."""

    jurisdiction: str
    name: str
    person: dict[str, Expr]
    contributor: dict[str, Expr]
    recipient: dict[str, Expr]
    date: Expr
    amount: Expr
    tran_id: Expr
    filing_id: Expr | None = None
    report_type: Expr | None = None
    parse_date: Callable[[Column], Column] = dates.iso_date
    null_word: bool = False
    options: dict[str, str] = field(default_factory=lambda: {"header": "true"})
    stated_year: Expr | None = None
    prepare: Callable[[DataFrame, Get], DataFrame] | None = None
    index: Index | None = None
    #: Columns of a contribution's content, of which the latest filing counts; without it, the first row of each own id counts.
    content: Callable[[Get], list[Column]] | None = None
    rank: Callable[[Get], list[Column]] | None = None
    #: What becomes of rows without an own id: keep each, collapse them into one, or drop them.
    blank_ids: str = "keep"
    #: Fields that are stored, but not shown to the classifier.
    hidden: tuple[str, ...] = ()
    last_name: Expr | None = None

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """The raw rows: every column a string (a byte-order mark is no part of the first name), with their places."""
        rows = spark.read.options(mode="PERMISSIVE", **self.options).csv(path)
        rows = rows.toDF(*[c.removeprefix("﻿") for c in rows.columns])
        return rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")).withColumn("_at", F.monotonically_increasing_id())

    def read_archive(self, spark: SparkSession, path: str, members: str) -> DataFrame:
        """The raw rows of an archive's members, or of a folder of archives: as read(), each member a task."""
        names = {"sep": "sep", "quote": "quote", "encoding": "encoding"}
        return read_members(spark, path, members, **{names[k]: v for k, v in self.options.items() if k in names})

    def prepared(self, rows: DataFrame) -> DataFrame:
        return self.prepare(rows, getter(rows, self.null_word)) if self.prepare else rows

    def resolved(self, rows: DataFrame, recipients: DataFrame | None) -> DataFrame:
        """Rows with the _recipient_ columns of the lookup table; rows that it doesn't know have none."""
        if self.index is None or recipients is None:
            return rows
        table = self.index.built(recipients, self.null_word)
        return rows.withColumn("__id", self.index.of_row(getter(rows, self.null_word))).join(table, "__id", "left").drop("__id")

    def unique(self, rows: DataFrame) -> DataFrame:
        """One row a contribution."""
        c = getter(rows, self.null_word)
        place = [F.col(p) for p in PLACE if p in rows.columns] or [F.lit(0)]
        if self.content:
            keys = {f"__k{i}": k for i, k in enumerate(self.content(c))}
            rank = self.rank(c) if self.rank else [numeric_rank(self.filing_id(c)), self.filing_id(c), self.tran_id(c)]
            return best_row_per_key(rows.withColumns(keys), list(keys), rank).drop(*keys)
        return first_by_native_id(rows.withColumn("__own", self.tran_id(c)), "__own", place, self.blank_ids, few=True).drop("__own")

    def project(self, rows: DataFrame, *more: str) -> DataFrame:
        """The canonical record of each row, and the columns `more` of the row itself."""
        c = getter(rows, self.null_word)
        get = lambda part, k: part[k](c) if k in part else F.lit("")
        date = self.parse_date(self.date(c))
        filing = self.filing_id(c) if self.filing_id else F.lit("")
        return rows.select(
            text.composed_key(F.lit(self.jurisdiction), F.lit(self.name), filing, self.tran_id(c)).alias("state_txn_id"),
            F.lit(self.jurisdiction).alias("jurisdiction"),
            F.lit(self.name).alias("source"),
            text.blank_to_null(filing).alias("source_filing_id"),
            text.blank_to_null(self.tran_id(c)).alias("source_tran_id"),
            get(self.person, "name").alias("contributor_name"),
            *[get(self.person, k).alias(f"contributor_{k}_name") for k in ("first", "middle", "last")],
            get(self.person, "suffix").alias("contributor_suffix"),
            *[get(self.contributor, k).alias(f"contributor_{k}") for k in CONTRIBUTOR],
            *[text.blank_to_null(get(self.recipient, k)).alias(f"recipient_{k}") if k != "name" else get(self.recipient, k).alias("recipient_name") for k in RECIPIENT],
            text.blank_to_null(self.report_type(c) if self.report_type else F.lit("")).alias("report_type"),
            money(self.amount(c)).alias("amount"),
            date.alias("date"),
            dates.state_cycle(date, self.stated_year(c) if self.stated_year else None).alias("election_cycle"),
            *more,
        )

    def bundle(self, rows: DataFrame, recipients: DataFrame | None = None) -> DataFrame:
        """Canonical records of raw rows, each contribution once, with their recipients."""
        return self.project(self.resolved(self.unique(self.prepared(rows)), recipients))

    def for_classifier(self, records: DataFrame) -> DataFrame:
        """Canonical records as the classifier may see them: what the source can't vouch for is blank."""
        return records.withColumns({f"contributor_{k}": F.lit("") for k in self.hidden}) if self.hidden else records

    def candidates(self, rows: DataFrame, registry: DataFrame) -> DataFrame:
        """Raw rows beside the slug of each owner one of whose surnames is in the contributor's last name: a coarse funnel, wider than the classifier."""
        from ..operators.classify import few, looked_up
        from ..operators.lookup import names_within
        from ..operators.shared import stored

        names = registry.where("parent_slug IS NULL").select(F.col("slug").alias("owner_slug"), F.explode("name_variants").alias("v")).select("owner_slug", text.surname(F.col("v")).alias("__surname")).distinct()
        last = self.last_name(getter(rows, self.null_word)) if self.last_name else self.person["last"](getter(rows, self.null_word))
        own = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
        keyed = rows.withColumns({"__last": F.lower(F.coalesce(last, F.lit(""))), "__a": F.xxhash64(*own)})
        # owners are found once a last name; the rows go neither through that search nor through a sort for those found by two surnames
        shown = stored(names_within(keyed.select("__last").distinct(), F.col("__last"), names, "__surname").select("__last", "owner_slug").distinct(), "shown")
        return looked_up(keyed, shown, ["__last"], few(shown)).select(*rows.columns, "owner_slug")


CONTRIBUTOR = ("employer", "occupation", "city", "state", "zip")
RECIPIENT = ("filer_id", "name", "type", "party", "office")
US_OR_ISO = lambda c: F.coalesce(dates.us_date(c), dates.iso_date(c))
COMPACT_OR_ISO = lambda c: F.coalesce(dates.compact_date(c), dates.iso_date(c))
TSV = {"header": "true", "sep": "\t", "quote": ""}


def _of(*names: str) -> Expr:
    return lambda c: either(*[c(n) for n in names])


def _contributor(*names: str | None) -> dict[str, Expr]:
    """Columns of employer, occupation, city, state and zip; None where the source has none."""
    return {k: _of(*n.split("|")) for k, n in zip(CONTRIBUTOR, names, strict=True) if n}


def _given(c: Get, column: str, first: bool) -> Column:
    """The first word of a column of given names, or the others."""
    words = F.split(c(column), r"\s+")
    return F.get(words, F.lit(0)) if first else F.array_join(F.slice(words, F.lit(2), F.size(words)), " ")


def _name(form: Callable[[Column], Column], column: str, part: str) -> Expr:
    return lambda c: form(c(column))[part]


def _comma(name: Column) -> Column:
    return comma_name(name["last"], name["first"], name["middle"])


def _last_word(column: str) -> Expr:
    return lambda c: F.lower(F.regexp_extract(c(column), r"(\S+)$", 1))


def _columns(first: str, last: str, middle: str | None = None, suffix: str | None = None) -> dict[str, Expr]:
    """A name that comes in columns of its own, composed as "Last, First Middle"."""
    given = [x for x in (first, middle) if x]
    out = {"name": lambda c: comma_name(c(last), *map(c, given)), "first": _of(first), "last": _of(last)}
    return out | ({"middle": _of(middle)} if middle else {}) | ({"suffix": _of(suffix)} if suffix else {})


def _hashed(*columns: str) -> Callable[[DataFrame, Get], DataFrame]:
    """Gives rows without an id of their own one: the hash of their content."""
    return lambda rows, c: rows.withColumn("_tran", text.content_hash(*[c(n) for n in columns]))


def _pa_pairs(rows: DataFrame, c: Get) -> DataFrame:
    """A row for each of the three pairs of amount and date that isn't blank, with the hash of its content as id."""
    cells = F.array(*[F.struct(F.lit(i).alias("_pair"), c(f"CONTAMT{i}").alias("_amount"), c(f"CONTDATE{i}").alias("_date")) for i in (1, 2, 3)])
    out = rows.select("*", F.inline(cells)).where("_amount <> '' OR _date <> ''")
    return out.withColumn("_tran", text.content_hash(either(c("CampaignFinanceID"), c("CampaignfinanceID")), c("CONTRIBUTOR"), c("ENAME"), F.col("_date"), F.col("_amount"), F.col("_pair")))


def _fl(part: str) -> Expr:
    return lambda c: text.name_party_office(c("Candidate/Committee"))[part]


def _fl_place(part: str) -> Expr:
    return lambda c: text.city_state_zip(c("City State Zip"))[part]


def _fl_name(c: Get) -> Column:
    words = F.split(c("Contributor Name"), r"\s+")
    return comma_name(F.regexp_replace(F.coalesce(F.get(words, F.lit(0)), F.lit("")), "[,.]+$", ""), F.array_join(F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))), " "))


def _plain_recipient(filer: str, name: str, kind: Expr, **more: Expr) -> dict[str, Expr]:
    return {"filer_id": _of(*filer.split("|")), "name": _of(name), "type": kind} | more


LAST_FIRST = lambda col: text.last_first_names(col, comma=False)
BY_CONTENT = lambda name, *columns: lambda c: [F.lower(name(c)), *[_of(*x.split("|"))(c) for x in columns]]
_TX_NAME = lambda c: either(spaced(c("contributorNameFirst"), c("contributorNameLast"), c("contributorNameSuffixCd")), c("contributorNameOrganization"))
_IL_NAME = lambda c: spaced(c("FirstName"), c("LastOnlyName"))
_AZ_LAST = lambda c: F.btrim(F.substring_index(c("TransactionLastName"), ",", 1))
_AZ_NAME = lambda c: comma_name(_AZ_LAST(c), c("TransactionFirstName"), c("TransactionMiddleName"))
_TX_KIND = lambda col: F.when(F.contains(F.upper(col), F.lit("COH")), "candidate").when(F.rlike(F.upper(col), F.lit("PAC|CEC|PTY")), "committee")

# The column names of the published files, and the names of the sources.
SOURCES: dict[str, Source] = {
    s.jurisdiction: s
    for s in (
        Source(
            "CA", "CAL-ACCESS",
            {"name": lambda c: F.when(c("CTRIB_NAMF") != "", F.concat(c("CTRIB_NAML"), F.lit(", "), c("CTRIB_NAMF"))).otherwise(c("CTRIB_NAML")), "first": _of("CTRIB_NAMF"), "last": _of("CTRIB_NAML"), "suffix": _of("CTRIB_NAMS")},
            _contributor("CTRIB_EMP", "CTRIB_OCC", "CTRIB_CITY", "CTRIB_ST", "CTRIB_ZIP4"),
            {k: _of(f"_recipient_{k}") for k in ("filer_id", "name", "type")},
            _of("RCPT_DATE"), _of("AMOUNT"), _of("TRAN_ID"), _of("FILING_ID"), parse_date=US_OR_ISO, options=TSV,
            index=Index(_of("FILING_ID"), _of("FILING_ID"), {
                "filer_id": _of("FILER_ID"),
                "name": lambda c: F.when(c("FILER_NAML") == "", either(c("CAND_NAML"), c("BUS_NAME"), c("BAL_NAME"))).when(c("FILER_NAMF") != "", F.concat(c("FILER_NAML"), F.lit(", "), c("FILER_NAMF"))).otherwise(c("FILER_NAML")),
                "type": lambda c: F.when(c("CAND_NAML") != "", "candidate").when(c("BAL_NAME") != "", "ballot_measure").otherwise("committee"),
            }, rank=lambda c: F.coalesce(c("AMEND_ID").try_cast("int"), F.lit(0))),
            content=lambda c: [c("TRAN_ID"), c("AMOUNT"), c("RCPT_DATE"), F.lower(c("CTRIB_NAML")), F.lower(c("CTRIB_NAMF"))],
            rank=lambda c: [F.coalesce(c("AMEND_ID").try_cast("int"), F.lit(0)), c("FILING_ID")],
        ),
        Source(
            "PA", "PA-DOS", {"name": _of("CONTRIBUTOR")}, _contributor("ENAME", "OCCUPATION", "CITY", "STATE", "ZIPCODE"),
            {"filer_id": _of("FilerID", "FILERID")} | {k: _of(f"_recipient_{k}") for k in ("name", "type", "party", "office")},
            _of("_date"), _of("_amount"), _of("_tran"), _of("CampaignFinanceID", "CampaignfinanceID"), parse_date=COMPACT_OR_ISO, null_word=True, prepare=_pa_pairs,
            index=Index(_of("FilerID", "FILERID"), _of("FILERID", "FilerID"), {"name": _of("FILERNAME"), "party": _of("PARTY"), "office": _of("OFFICE"), "type": lambda c: F.lower(c("FILERTYPE"))}),
            blank_ids="collapse", last_name=_last_word("CONTRIBUTOR"),
        ),
        Source(
            "NY", "NYSBOE", _columns("flng_ent_first_name", "flng_ent_last_name", "flng_ent_middle_name"), _contributor(None, None, "flng_ent_city", None, "flng_ent_zip"),
            _plain_recipient("filer_id", "cand_comm_name", lambda c: F.when(c("cand_comm_name") == "", F.lit(None).cast("string")).when(F.contains(F.lower(c("cand_comm_name")), F.lit(" for ")) | F.startswith(F.lower(c("cand_comm_name")), F.lit("friends of")), "candidate").otherwise("committee")),
            _of("sched_date"), _of("org_amt"), _of("trans_number"), _of("filer_id"), _of("filing_desc"), stated_year=_of("election_year"), blank_ids="collapse", hidden=("city", "state"),
        ),
        Source(
            "TX", "TEC",
            {"name": _TX_NAME, "first": lambda c: _given(c, "contributorNameFirst", True), "middle": lambda c: _given(c, "contributorNameFirst", False), "last": _of("contributorNameLast"), "suffix": _of("contributorNameSuffixCd")},
            _contributor("contributorEmployer", "contributorOccupation|contributorJobTitle", "contributorStreetCity", "contributorStreetStateCd", "contributorStreetPostalCode"),
            {"filer_id": _of("filerIdent"), "name": _of("filerName", "_recipient_name"), "type": lambda c: F.coalesce(_TX_KIND(c("filerTypeCd")), c("_recipient_type")), "office": _of("_recipient_office")},
            _of("contributionDt"), _of("contributionAmount"), _of("contributionInfoId"), _of("reportInfoIdent"), _of("formTypeCd"), COMPACT_OR_ISO, True,
            index=Index(_of("filerIdent"), _of("filerIdent"), {"name": _of("filerName"), "type": lambda c: _TX_KIND(c("filerTypeCd")), "office": _of("ctaSeekOfficeDescr", "filerHoldOfficeDescr", "contestSeekOfficeDescr")}),
            content=BY_CONTENT(_TX_NAME, "contributionDt", "contributionAmount", "filerIdent"),
        ),
        Source(
            "IL", "ISBE", {"name": _IL_NAME, "first": lambda c: _given(c, "FirstName", True), "middle": lambda c: _given(c, "FirstName", False), "last": _of("LastOnlyName")},
            _contributor("Employer", "Occupation", "City", "State", "Zip"), {"filer_id": _of("CommitteeID")} | {k: _of(f"_recipient_{k}") for k in ("name", "type", "party")},
            _of("RcvDate"), _of("Amount"), _of("ID"), _of("FiledDocID"), _of("D2Part"), US_OR_ISO, options=TSV,
            index=Index(_of("CommitteeID"), _of("ID"), {"name": _of("Name"), "type": lambda c: kind_by(c("TypeOfCommittee"), ("candidate", "candidate"), ("ballot", "ballot_measure")), "party": _of("PartyAffiliation")}),
            content=BY_CONTENT(_IL_NAME, "RcvDate", "Amount", "CommitteeID"),
        ),
        Source(
            "WA", "WA-PDC", {"name": lambda c: _comma(LAST_FIRST(c("contributor_name")))} | {k: _name(LAST_FIRST, "contributor_name", k) for k in ("first", "middle", "last")},
            _contributor("contributor_employer_name", "contributor_occupation", "contributor_city", "contributor_state", "contributor_zip"),
            _plain_recipient("filer_id", "filer_name", lambda c: kind_by(c("type"), ("candidate", "candidate")), party=_of("party"), office=_of("office")),
            _of("receipt_date"), _of("amount"), _of("id"), _of("report_number"), _of("origin"), stated_year=_of("election_year"), blank_ids="collapse",
        ),
        Source(
            "CO", "CO-TRACER", _columns("FirstName", "LastName", "MI", "Suffix"), _contributor("Employer", "Occupation", "City", "State", "Zip"),
            _plain_recipient("CO_ID", "CommitteeName", lambda c: kind_by(c("CommitteeType"), ("candidate", "candidate"))),
            _of("ContributionDate"), _of("ContributionAmount"), _of("RecordID"), _of("CO_ID"), _of("ReceiptType"), US_OR_ISO, True,
        ),
        Source(
            "AZ", "AZ-SOS", {"name": _AZ_NAME, "first": _of("TransactionFirstName"), "middle": _of("TransactionMiddleName"), "last": _AZ_LAST},
            _contributor("TransactionEmployer", "TransactionOccupation", "TransactionCity", "TransactionState", "TransactionZipCode"),
            _plain_recipient("CommitteeUniqueId|CommitteeId", "CommitteeName", lambda c: F.when(F.contains(F.lower(c("CommitteeGroupName")), F.lit("candidate")) | (c("CandidateLastName") != ""), "candidate").when(c("CommitteeGroupName") != "", "committee")),
            _of("TransactionDate"), _of("Amount"), _of("PublicTransactionId", "TransactionId"), _of("CommitteeUniqueId", "CommitteeId"), _of("TransactionType"), dates.epoch_date,
            content=BY_CONTENT(_AZ_NAME, "TransactionDate", "Amount", "CommitteeUniqueId|CommitteeId"),
        ),
        Source(
            "MN", "MN-CFB", {"name": _of("Contributor")}, _contributor("Contrib Employer name", None, None, None, "Contrib zip"),
            _plain_recipient("Recipient reg num", "Recipient", lambda c: F.when(c("Recipient type") == "", F.lit(None).cast("string")).when(F.upper(c("Recipient type")) == "PCC", "candidate").otherwise("committee")),
            _of("Receipt date"), _of("Amount"), _of("_tran"), _of("Recipient reg num"), _of("Receipt type"), US_OR_ISO, True,
            prepare=_hashed("Recipient reg num", "Contributor", "Amount", "Receipt date", "Contrib zip", "Contrib Employer name", "Receipt type"), last_name=lambda c: text.surname(c("Contributor")),
        ),
        Source(
            "FL", "FL-DOE", {"name": _fl_name}, {"occupation": _of("Occupation")} | {k: _fl_place(k) for k in ("city", "state", "zip")},
            {"name": _fl("name"), "party": _fl("party"), "office": _fl("office"), "type": lambda c: F.when(_fl("office")(c) != "", "candidate").otherwise("committee")},
            _of("Date"), _of("Amount"), _of("_tran"), None, _of("Typ"), dates.us_date, True, TSV,
            prepare=lambda rows, c: _hashed("Candidate/Committee", "Date", "Amount", "Contributor Name", "Address", "City State Zip", "Occupation")(rows.where((c("Contributor Name") != "") & ~F.startswith(c("Candidate/Committee"), F.lit("<"))), c),
            last_name=lambda c: F.lower(F.regexp_replace(F.regexp_extract(c("Contributor Name"), r"^(\S+)", 1), "[,.]+$", "")),
        ),
        Source(
            "MD", "MD-SBE", {"name": _of("contributorName")} | {k: _name(text.last_first_names, "contributorName", k) for k in ("first", "middle", "last")},
            _contributor(None, None, "contributorCity", "contributorState", None) | {"zip": lambda c: either(text.zip5(c("contributorZipCode")), c("contributorZipCode"))},
            _plain_recipient("filingEntityId", "committeeName", lambda c: F.when((F.upper(c("committeeTypeCode")) == "BALC") | F.contains(F.lower(c("committeeType")), F.lit("ballot")), "ballot_measure").when(F.contains(F.lower(c("committeeType")), F.lit("candidate")), "candidate").when(either(c("committeeTypeCode"), c("committeeType")) != "", "committee")),
            _of("transactionDate"), _of("transactionAmount"), _of("transactionGuid", "transactionId"), _of("reportGuid", "reportId"), _of("report"), blank_ids="drop",
        ),
    )
}


def owner_names(registry: DataFrame) -> DataFrame:
    """owner_slug, last and first (lower case, the first given name) of each variant of an owner that has both."""
    variants = registry.where("parent_slug IS NULL").select(F.col("slug").alias("owner_slug"), F.explode("name_variants").alias("v"))
    rows = variants.select("owner_slug", text.last_first_names(F.col("v")).alias("n")).select("owner_slug", F.lower("n.last").alias("last"), F.lower("n.first").alias("first"))
    return rows.where("last <> '' AND first <> ''").distinct()


def distinct_variants(registry: DataFrame) -> DataFrame:
    """slug and variant of each name worth asking for: of those that differ in case, periods, commas and spaces only, the first."""
    rows = registry.select("slug", F.posexplode("name_variants").alias("at", "variant")).withColumn("key", text.norm(F.col("variant"))).where("key <> ''")
    return rows.groupBy("slug", "key").agg(F.min_by("variant", "at").alias("variant")).select("slug", "variant")


def asked_by_parts(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of the NY file beside each owner one of whose last names and one of whose first names they have, not necessarily of one variant."""
    names, c = owner_names(registry), getter(rows)
    keyed = rows.withColumns({"__last": F.lower(c("flng_ent_last_name")), "__first": F.lower(c("flng_ent_first_name"))})
    lasts, firsts = names.select("owner_slug", F.col("last").alias("__last")).distinct(), names.select("owner_slug", F.col("first").alias("__first")).distinct()
    return keyed.join(lasts, "__last").join(firsts, ["owner_slug", "__first"], "left_semi").drop("__last", "__first").select(*rows.columns, "owner_slug")


def asked_by_prefix(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of the WA file beside each owner with a name that the contributor's begins with, as "LAST FIRST"."""
    names, name = owner_names(registry), F.lower(getter(rows)("contributor_name"))
    keyed = rows.withColumns({"__name": name, "__last": F.regexp_extract(name, r"^(\S+)", 1)})
    right = names.select("owner_slug", F.concat_ws(" ", "last", "first").alias("__start"), F.regexp_extract("last", r"^(\S+)", 1).alias("__last"))
    return keyed.join(right, "__last").where(F.startswith("__name", "__start")).select(*rows.columns, "owner_slug").distinct()


def asked_by_entity(entities: DataFrame, registry: DataFrame, column: str = "EntityLastName") -> DataFrame:
    """AZ entities beside each owner of the same last name whose first name begins with theirs or the other way round; a missing first name fits."""
    n = text.last_first_names(F.col(column))
    keyed = entities.withColumns({"last": F.lower(n["last"]), "__first": F.lower(n["first"])})
    fits = (F.col("__first") == "") | F.startswith("__first", "first") | F.startswith("first", "__first")
    return keyed.join(owner_names(registry), "last").where(fits).select(*entities.columns, "owner_slug").distinct()


def is_person(rows: DataFrame) -> Column:
    """Whether a row of the MD file is a person's: by type code, else by type."""
    c = getter(rows)
    return F.when(c("contributorTypeCode") != "", F.upper(c("contributorTypeCode")) == "TIND").otherwise(F.lower(c("contributorType")) == "individual")


def without_opted_out(records: DataFrame, opt_outs: DataFrame) -> DataFrame:
    """Candidate rows (owner_slug, jurisdiction) without those of owners who opted out of the jurisdiction."""
    return records.join(opt_outs.select("owner_slug", "jurisdiction").distinct(), ["owner_slug", "jurisdiction"], "left_anti")


def exploded_pairs(rows: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """One row per (amount, date) pair of a row with several; pairs that are both blank are left out. Adds _pair, _amount, _date."""
    cells = F.array(*[F.struct(F.lit(i + 1).alias("_pair"), F.col(a).alias("_amount"), F.col(d).alias("_date")) for i, (a, d) in enumerate(pairs)])
    out = rows.select("*", F.inline(cells))
    return out.where((F.coalesce(F.btrim("_amount"), F.lit("")) != "") | (F.coalesce(F.btrim("_date"), F.lit("")) != ""))
