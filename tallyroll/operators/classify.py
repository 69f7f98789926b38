"""The confidence classifier: who a record belongs to, how surely, and by which signals.

The distinct names of records meet a registry of entities by the forms of their names, an equi-join on exploded name forms, and
records meet the names that fit anybody; everything else is column expressions. Neither the registry nor these names are assumed to
be few: up to BROADCAST_ROWS of them are broadcast, beyond which keys are salted. Names and signals of the registry are normalised
once, on its own side of the join.

Registry columns: slug, kind, parent_slug (null for owners), position (among the relatives of an owner), name_variants,
cities, states, employers, occupations, strong_employers, strong_zips, negative_employers (arrays of strings), mrs_is_self,
lone_city_state_is_weak (booleans). An owner and those whose parent_slug names it are a household.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import full_name, initials_compatible, norm, starts_token, with_name_parts, zip_matches
from .shared import stored

REGISTRY = "slug string, kind string, parent_slug string, position int, name_variants array<string>, cities array<string>, states array<string>, employers array<string>, occupations array<string>, strong_employers array<string>, strong_zips array<string>, negative_employers array<string>, mrs_is_self boolean, lone_city_state_is_weak boolean"
NEEDLES = ("employers", "occupations", "strong_employers", "negative_employers")
#: Entities of a registry (or names) that are broadcast, and copies of one that isn't.
BROADCAST_ROWS, SALTS = 10_000, 16
SPLIT_NAME = ("contributor_first_name", "contributor_middle_name", "contributor_last_name", "contributor_suffix")


def _list(col: str) -> Column:
    return F.coalesce(F.col(col), F.array().cast("array<string>"))


def _entities(registry: DataFrame) -> DataFrame:
    """A row per entity, with its signals normalised: __id (a hash of all of it), __entity, __list (its name variants)."""
    signals = {c: F.transform(_list(c), lambda x: F.struct(x.alias("raw"), norm(x).alias("needle"))) for c in NEEDLES}
    entity = F.struct(
        "slug", "kind", "parent_slug", F.coalesce("position", F.lit(0)).alias("position"),
        *[v.alias(c) for c, v in signals.items()],
        F.transform(_list("cities"), norm).alias("cities"), F.transform(_list("states"), lambda s: F.upper(F.btrim(s))).alias("states"), _list("strong_zips").alias("strong_zips"),
        F.coalesce("mrs_is_self", F.lit(False)).alias("mrs_is_self"), F.coalesce("lone_city_state_is_weak", F.lit(False)).alias("lone_city_state_is_weak"),
    )
    return registry.select(F.xxhash64(F.to_json(F.struct(*registry.columns), {"ignoreNullFields": "false"})).alias("__id"), entity.alias("__entity"), _list("name_variants").alias("__list"))


def _variants(entities: DataFrame) -> DataFrame:
    """A row per form of each name variant: __form, __v (name parts), __at (which variant), and of the entity __id, __slug, __house, __owner (it is one) and __position."""
    of = [F.col("__entity.slug").alias("__slug"), F.coalesce("__entity.parent_slug", "__entity.slug").alias("__house"), F.col("__entity.parent_slug").isNull().alias("__owner"), F.col("__entity.position").alias("__position")]
    rows = entities.select("__id", *of, F.posexplode("__list").alias("__at", "__variant"))
    rows = with_name_parts(rows, "__variant", "__v")
    return rows.select("__id", "__slug", "__house", "__owner", "__position", "__at", "__v", F.explode("__v.forms").alias("__form"))


def candidates(records: DataFrame, registry: DataFrame, key: str = "record_id", related: bool = True, unique: bool = False) -> DataFrame:
    """Each record beside one entity of each household that its name fits: __record, __entity, __variant and __suffix_ok.

    A variant fits if it shares a form of the name and the middle initials don't exclude each other; the first that also has
    the same suffix is taken, else the first. The name as filed comes first; for entities that it doesn't fit, the name made
    of the split fields is tried. Relatives, in their order, come before the owner but need the same suffix; without
    `related`, records that fit a relative are left out. Records without a name, and those that fit nobody, are left out.
    Records that share a key (or have none) but differ are records each; those that are equal in all columns are one. With
    `unique` there are none of these (or it doesn't matter), and no record is shuffled to look for them.
    """
    split = all(c in records.columns for c in SPLIT_NAME)
    full = full_name(*[F.col(c) for c in SPLIT_NAME]) if split else F.lit("")
    plain = [F.col(f"`{f.name}`") for f in records.schema.fields if "map<" not in f.dataType.simpleString()]
    # a record is named by 128 bits of hash; the second half knows which columns are null, since nulls leave a hash as it is
    ids = [F.xxhash64(*plain).alias("__a"), F.xxhash64(F.lit(1), F.col(f"`{key}`"), *[c.isNull() for c in plain], *plain).alias("__b")]
    rows = records.where(F.coalesce(F.col("contributor_name"), F.lit("")) != "").select(F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("__record"), F.col("contributor_name").alias("__name"), full.alias("__full"), *ids)
    entities = _entities(registry)
    small = few(registry)
    # whom a name fits is found once a name, and stored; records meet the answers where they are
    best = stored(_fits(rows.select("__name", "__full").distinct(), entities, split, small, related), "names")
    found = looked_up(rows, best, ["__name", "__full"], few(best)).drop("__name", "__full")
    if not unique:
        again = F.lag("__a").over(Window.partitionBy("__a", "__b", "__id").orderBy("__a")).isNotNull()
        found = found.withColumn("__again", again).where("NOT __again")
    entity = entities.select("__id", "__entity", "__list").dropDuplicates(["__id"])
    return looked_up(found, entity, ["__id"], small).select("__record", "__entity", F.get("__list", F.col("__at")).alias("__variant"), F.col("__suffix_ok"))


def _fits(names: DataFrame, entities: DataFrame, split: bool, small: bool, related: bool) -> DataFrame:
    """Of each name (__name as filed, __full of split fields), the entity of each household that it fits: __id, __at and __suffix_ok."""
    names = with_name_parts(names.withColumn("__a", F.xxhash64("__name", "__full")), "__name", "__n")
    tries = [F.struct(F.lit(0).alias("source"), F.col("__n").alias("n"))]
    if split:
        names = with_name_parts(names, "__full", "__y")
        tries.append(F.struct(F.lit(1).alias("source"), F.col("__y").alias("n")))
    keys = ["__name", "__full"]
    names = names.select("__a", *keys, F.explode(F.array(*tries)).alias("__try"))
    names = names.select("__a", *keys, "__try", F.explode("__try.n.forms").alias("__form"))
    both = looked_up(names, _variants(entities), ["__form"], small).where(initials_compatible(F.col("__try.n.initials"), F.col("__v.initials")))
    suffix_ok = F.col("__try.n.suffix") == F.col("__v.suffix")
    rank = F.struct(F.col("__try.source").alias("s"), (~suffix_ok).alias("x"), F.col("__at").alias("a"), F.col("__id").alias("i"))
    both = both.select(*keys, "__id", "__house", "__slug", "__owner", "__position", "__at", suffix_ok.alias("__suffix_ok"), rank.alias("__rank"))
    one = both.groupBy(*keys, "__house", "__slug").agg(F.min_by(F.struct("__id", "__at", "__owner", "__position", "__suffix_ok"), F.col("__rank")).alias("m")).where("m.__owner OR m.__suffix_ok")
    order = F.struct(F.col("m.__owner").alias("o"), F.col("m.__position").alias("p"), F.col("__slug").alias("s"))
    best = one.groupBy(*keys, "__house").agg(F.min_by("m", order).alias("m"))
    best = best if related else best.where("m.__owner")
    return best.select(*keys, "m.__id", "m.__at", "m.__suffix_ok")


def few(table: DataFrame) -> bool:
    """Whether a table is small enough to be broadcast."""
    return len(table.select(F.lit(1)).limit(BROADCAST_ROWS + 1).take(BROADCAST_ROWS + 1)) <= BROADCAST_ROWS


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """rows (with __a) joined with what is known of the registry: broadcast where that is small, else by salted keys, since few names may have most rows."""
    if small:
        return rows.join(F.broadcast(table), keys)
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", F.pmod("__a", F.lit(SALTS)).cast("int")).join(salted, [*keys, "__salt"]).drop("__salt")


def _hits(hay: str, needles: str) -> Column:
    return F.transform(F.filter(F.col(f"__entity.{needles}"), lambda n: starts_token(F.col(hay), n["needle"])), lambda n: n["raw"])


def _named(kind: str, hits: Column) -> Column:
    return F.transform(hits, lambda h: F.concat(F.lit(f"{kind}:"), h))


def tiers(matched: DataFrame) -> DataFrame:
    """Adds status (CONFIRMED, PROBABLE or UNCERTAIN), status_reason and signals to candidates().

    A city together with its state is one signal. An address outside the documented ones contradicts unless there is a
    strong signal: the pair of city and state, or the city alone where the record has no state; an entity without documented
    cities has no address that agrees.
    """
    field = lambda c: F.coalesce(F.col(f"__record.contributor_{c}"), F.lit(""))
    city, state = norm(field("city")), F.upper(F.btrim(field("state")))
    rows = matched.withColumns({"__emp": norm(field("employer")), "__occ": norm(field("occupation")), "__city": city, "__state": state})
    in_city, in_state = F.array_contains("__entity.cities", F.col("__city")), F.array_contains("__entity.states", F.col("__state"))
    has_city, has_state = F.col("__city") != "", F.col("__state") != ""
    zips = F.filter("__entity.strong_zips", lambda z: zip_matches(field("zip"), z))
    zip_code = F.transform(F.slice(zips, 1, 1), lambda z: F.when(F.char_length(F.btrim(z)) > 5, F.btrim(z)).otherwise(F.left(F.btrim(field("zip")), F.lit(5))))
    none = F.array().cast("array<string>")
    place = F.when(has_city & has_state & in_city & in_state, F.array(F.concat(F.lit("city_state:"), "__city", F.lit("/"), "__state"))).otherwise(none)
    rows = rows.withColumns({
        "__mrs": F.array_contains(F.split(norm(field("name")), " "), "mrs") & ~F.col("__entity.mrs_is_self"),
        "__negative": _named("negative_employer", _hits("__emp", "negative_employers")),
        "__strong": F.concat(_named("strong_employer", _hits("__emp", "strong_employers")), _named("strong_zip", zip_code)),
        "__confirming": F.concat(_named("employer", _hits("__emp", "employers")), _named("occupation", _hits("__occ", "occupations")), place),
        "__elsewhere": has_city & ~F.when(has_state, in_city & in_state).otherwise(in_city),
    })
    n, s = F.size("__confirming"), F.size("__strong")
    lone = (n == 1) & F.exists("__confirming", lambda x: F.startswith(x, F.lit("city_state:"))) & F.col("__entity.lone_city_state_is_weak")
    all_signals, listed = F.concat("__strong", "__confirming"), lambda c: F.array_join(c, ", ")
    outside = F.concat(F.lit(" (address outside documented residences: "), field("city"), F.lit("/"), field("state"), F.lit(")"))
    steps = [
        (~F.col("__suffix_ok"), "UNCERTAIN", F.lit("name suffix differs from the variants"), none),
        (F.col("__mrs"), "UNCERTAIN", F.lit("Mrs may be a spouse"), F.array(F.lit("mrs_honorific"))),
        (F.size("__negative") > 0, "UNCERTAIN", F.concat(F.lit("negative employer: "), listed("__negative")), F.col("__negative")),
        (F.col("__elsewhere") & (s == 0), "UNCERTAIN", F.concat(F.lit("address contradicts"), outside), all_signals),
        (s > 0, "CONFIRMED", F.concat(F.lit("strong signal: "), listed("__strong"), F.when(F.col("__elsewhere"), outside).otherwise("")), all_signals),
        (n >= 2, "CONFIRMED", F.concat(F.lit("two or more signals: "), listed("__confirming")), all_signals),
        (lone, "UNCERTAIN", F.lit("city and state alone"), all_signals),
        (n == 1, "PROBABLE", F.concat(F.lit("one signal: "), listed("__confirming")), all_signals),
    ]
    chain = lambda i, other: _chain([(c[0], c[i]) for c in steps], other)
    out = rows.withColumns({"status": chain(1, F.lit("UNCERTAIN")), "status_reason": chain(2, F.lit("name only")), "signals": chain(3, none)})
    return out.drop("__emp", "__occ", "__city", "__state", "__mrs", "__negative", "__strong", "__confirming", "__elsewhere")


def _chain(steps: list[tuple[Column, Column | str]], other: Column) -> Column:
    out = F
    for condition, value in steps:
        out = out.when(condition, value if isinstance(value, Column) else F.lit(value))
    return out.otherwise(other)


ADDED = ("entity_slug", "entity_kind", "parent_owner_slug", "matched_variant", "status", "status_reason", "signals")


def classify(records: DataFrame, registry: DataFrame, key: str = "record_id", related: bool = True, unique: bool = False) -> DataFrame:
    """Every record that fits an entity, a row a household: its own columns, and the entity's slug, kind and owner, the variant that matched, status, status_reason and signals.

    Columns of records must not have the names of those that are added. related and unique: as for candidates().
    """
    done = tiers(candidates(records, registry, key, related, unique))
    return done.select(*[F.col("__record")[c].alias(c) for c in records.columns], F.col("__entity.slug").alias("entity_slug"), F.col("__entity.kind").alias("entity_kind"), F.col("__entity.parent_slug").alias("parent_owner_slug"), F.col("__variant").alias("matched_variant"), "status", "status_reason", "signals")
