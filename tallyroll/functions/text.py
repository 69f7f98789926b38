"""String functions: cleaning, names, places, keys and hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Honorifics that names drop, and suffixes that they set apart ("v" only at the end).
HONORIFICS = ("mr", "mrs", "ms", "miss", "dr", "hon", "prof", "rev")
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")


def clean(col: Column, null_word: bool = False) -> Column:
    """Trimmed text, '' for null; with null_word also for the word NULL in any case."""
    out = F.coalesce(F.btrim(col), F.lit(""))
    return F.when(F.upper(out) == "NULL", F.lit("")).otherwise(out) if null_word else out


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.btrim(col), F.lit(""))


def norm(col: Column) -> Column:
    """Lower case, periods and commas as spaces, single spaces, trimmed; '' for null."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), "[.,]", " "), r"(?U)\s+", " "))


def with_name_parts(df: DataFrame, name: str, out: str) -> DataFrame:
    """df with `out`: struct<forms: array<string>, suffix: string, initials: array<string>> of the personal names in column `name`.

    "Last, First" is turned around at its first comma; honorifics go; the last suffix is set apart ("v" only at the end);
    single-letter middle names become initials; a hyphenated last name adds itself reversed, spaced, and both. Each step is a
    projection of its own, so that none is evaluated again at every mention.
    """
    raw = F.btrim(F.coalesce(F.col(name), F.lit("")))
    comma = F.instr(raw, ",")
    turned = F.when(comma > 0, F.concat(F.substr(raw, comma + 1), F.lit(" "), F.substring(raw, F.lit(1), comma - 1))).otherwise(raw)
    df = df.withColumn("__t", F.filter(F.split(norm(turned), " "), lambda t: (t != "") & ~t.isin(*HONORIFICS)))
    long, short = [x for x in SUFFIXES if len(x) > 1], [x for x in SUFFIXES if len(x) == 1]
    suffix = lambda t, i: t.isin(*long) | (t.isin(*short) & (i == F.size("__t") - 1))
    df = df.withColumns({"__s": F.coalesce(F.try_element_at(F.filter("__t", suffix), F.lit(-1)), F.lit("")), "__k": F.filter("__t", lambda t, i: ~suffix(t, i))})
    n = F.size("__k")
    middle = F.slice("__k", F.lit(2), F.greatest(n - 2, F.lit(0)))
    initials = F.array_distinct(F.filter(middle, lambda t: F.char_length(t) == 1))
    plain = F.when(n > 2, F.concat(F.slice("__k", 1, 1), F.filter(middle, lambda t: F.char_length(t) > 1), F.slice("__k", F.lit(-1), F.lit(1)))).otherwise(F.col("__k"))
    df = df.withColumns({"__i": initials, "__p": plain})
    df = df.withColumns({"__head": F.slice("__p", F.lit(1), F.greatest(F.size("__p") - 1, F.lit(0))), "__parts": F.filter(F.split(F.coalesce(F.try_element_at("__p", F.lit(-1)), F.lit("")), "-"), lambda x: x != "")})
    ended = lambda *ends: F.array(*[F.array_join(F.concat("__head", e), " ") for e in ends])
    hyphened = F.when((F.size("__parts") > 1), ended(F.array(F.array_join(F.reverse("__parts"), "-")), F.col("__parts"), F.reverse("__parts")))
    own = F.when(F.size("__p") > 0, F.array(F.array_join("__p", " ")))
    none = F.array().cast("array<string>")
    forms = F.array_distinct(F.concat(F.coalesce(own, none), F.coalesce(hyphened, none)))
    return df.withColumn(out, F.struct(forms.alias("forms"), F.col("__s").alias("suffix"), F.col("__i").alias("initials"))).drop("__t", "__s", "__k", "__i", "__p", "__head", "__parts")


def full_name(first: Column, middle: Column, last: Column, suffix: Column) -> Column:
    """The parts that aren't blank, in this order, with spaces between them."""
    return F.concat_ws(" ", *[blank_to_null(c) for c in (first, middle, last, suffix)])


def initials_compatible(a: Column, b: Column) -> Column:
    """Whether two arrays of middle initials can belong to one person: one is empty, or they overlap."""
    return (F.size(a) == 0) | (F.size(b) == 0) | F.arrays_overlap(a, b)


def token_start(hay: Column, needle: Column) -> Column:
    """Whether the needle, taken literally, begins at a word's start in the hay, both normalised; blank needles never match."""
    return starts_token(norm(hay), norm(needle))


def starts_token(hay: Column, needle: Column) -> Column:
    """token_start() of texts that are normalised already; a pattern is made only where the hay holds the needle at all."""
    quoted = F.concat(F.lit("(?U)\\b\\Q"), F.replace(needle, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return (needle != "") & F.contains(hay, needle) & F.rlike(hay, quoted)


def surname(variant: Column) -> Column:
    """The last name of a name variant, lower-cased: what stands before its comma, or its last word."""
    v = F.btrim(F.coalesce(variant, F.lit("")))
    return F.lower(F.btrim(F.when(F.contains(v, F.lit(",")), F.substring_index(v, ",", 1)).otherwise(F.regexp_extract(v, r"(\S+)$", 1))))


def zip_matches(zip_code: Column, signal: Column) -> Column:
    """A signal of more than five characters matches exactly, others by the first five."""
    z, s = F.btrim(F.coalesce(zip_code, F.lit(""))), F.btrim(F.coalesce(signal, F.lit("")))
    return (z != "") & (s != "") & F.when(F.char_length(s) > 5, z == s).otherwise(F.left(z, F.lit(5)) == F.left(s, F.lit(5)))


def zip5(col: Column) -> Column:
    return F.regexp_extract(F.coalesce(col, F.lit("")), r"^\s*(\d{5})", 1)


def city_state_zip(col: Column) -> Column:
    """struct<city, state, zip> of "CITY, ST 12345-6789", the ZIP code by its first five digits; text of another form is all city."""
    raw = clean(col)
    pattern = r"^(.*?)(?:,\s*|\s+)([A-Za-z]{2})\s+(\d{5})(?:-\d+)?$"
    hit = F.rlike(raw, F.lit(pattern))
    part = lambda i, other: F.when(hit, F.btrim(F.regexp_extract(raw, pattern, i))).otherwise(other)
    return F.struct(part(1, raw).alias("city"), F.upper(part(2, F.lit(""))).alias("state"), part(3, F.lit("")).alias("zip"))


def last_first_names(col: Column, comma: bool = True) -> Column:
    """struct<first, middle, last> of "Last, First Middle", or of "LAST FIRST MIDDLE" where comma is False; one word is a last name.

    With comma, the first comma divides, and a name without one is "First [Middle] Last".
    """
    raw = clean(col)
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    get = lambda w, i: F.coalesce(F.get(w, i if isinstance(i, Column) else F.lit(i)), F.lit(""))
    rest = lambda w, start, size: F.array_join(F.slice(w, F.lit(start), F.greatest(size, F.lit(0))), " ")
    own, after = words(raw), words(F.substr(raw, F.instr(raw, ",") + 1))
    n = F.size(own)
    if not comma:
        return F.struct(get(own, 1).alias("first"), rest(own, 3, n - 2).alias("middle"), get(own, 0).alias("last"))
    divided = F.struct(get(after, 0).alias("first"), rest(after, 2, F.size(after) - 1).alias("middle"), F.btrim(F.substring_index(raw, ",", 1)).alias("last"))
    plain = F.struct(F.when(n > 1, get(own, 0)).otherwise("").alias("first"), rest(own, 2, n - 2).alias("middle"), get(own, n - 1).alias("last"))
    return F.when(F.contains(raw, F.lit(",")), divided).otherwise(plain)


def name_party_office(col: Column) -> Column:
    """struct<name, party, office> of "Name (PARTY)(OFFICE)"; text without both codes at its end is all name."""
    raw = clean(col)
    pattern = r"^(.*?)\s*\(([^)]*)\)\s*\(([^)]*)\)$"
    hit = F.rlike(raw, F.lit(pattern))
    part = lambda i, other: F.when(hit, F.btrim(F.regexp_extract(raw, pattern, i))).otherwise(other)
    return F.struct(part(1, raw).alias("name"), part(2, F.lit("")).alias("party"), part(3, F.lit("")).alias("office"))


# The names of parties.
PARTIES = {"DEM": ("DEM", "DEMOCRAT", "DEMOCRATIC"), "REP": ("REP", "REPUBLICAN", "GOP"), "IND": ("IND", "INDEPENDENT"), "LIB": ("LIB", "LIBERTARIAN"), "GRE": ("GRE", "GREEN")}


def party_bucket(col: Column) -> Column:
    """One of five parties by name or code, else OTH; single letters are no codes of it."""
    p, out = F.upper(F.btrim(F.coalesce(col, F.lit("")))), F
    for party, names in PARTIES.items():
        out = out.when(p.isin(*names), party)
    return out.otherwise("OTH")


# The committee-type letters of federal filings.
COMMITTEE_TYPES = {"Candidate": "P S H", "Party": "X Y Z", "PAC": "Q N O V W U I D C E"}


def committee_bucket(letter: Column) -> Column:
    """The kind of committee by its type letter; unknown ones are "Other"."""
    code, out = F.upper(F.btrim(letter)), F
    for kind, letters in COMMITTEE_TYPES.items():
        out = out.when(code.isin(*letters.split()), kind)
    return out.otherwise("Other")


def composed_key(*parts: Column) -> Column:
    """Parts joined by colons; a null part is an empty one, so places don't shift."""
    return F.concat(*[x for i, p in enumerate(parts) for x in ([F.lit(":")] if i else []) + [F.coalesce(p.cast("string"), F.lit(""))]])


def content_hash(*parts: Column) -> Column:
    """The first 16 hex digits of the SHA-1 of the parts joined by bars, nulls as empty."""
    return F.left(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary")), F.lit(16))


def csv_guard(col: Column) -> Column:
    """A quote before texts that a spreadsheet would read as a formula."""
    return F.when(F.rlike(col, F.lit(r"^[=+\-@\t\r]")), F.concat(F.lit("'"), col)).otherwise(col)


def single_of_json_array(col: Column) -> Column:
    """The only element of a JSON array of length one, else null."""
    return F.when(F.json_array_length(col) == 1, F.get_json_object(col, "$[0]"))


def json_strings(col: Column) -> Column:
    """A JSON array of strings; empty where it isn't one."""
    return F.coalesce(F.from_json(col, "array<string>"), F.array().cast("array<string>"))
