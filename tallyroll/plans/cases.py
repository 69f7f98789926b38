"""Records and a registry that the classifier's rules can go wrong on, with the answers that the rules demand, worked out by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.classify import REGISTRY

# slug, kind, parent, position, variants, cities, states, employers, occupations, strong employers, strong ZIPs, negative employers, Mrs is self, lone place is weak
ENTITIES = [
    ("stone", "owner", None, None, ["Ann Stone"], ["Springfield"], ["IL"], ["Acme", "Gap"], ["Engineer"], ["Stone Holdings"], ["12345"], ["Rival"], False, False),
    ("field", "owner", None, None, ["Bob Field", "Robert Field Jr."], ["Riverton"], ["WY"], ["Borealis", "North & Co"], [], [], ["825011234"], [], False, True),
    ("field-cara", "spouse", "field", 0, ["Cara Field"], ["Riverton"], ["WY"], [], ["Teacher"], [], [], [], True, False),
    ("field-rob", "child", "field", 1, ["Robert Field III"], [], [], ["Kiteworks"], [], [], [], [], False, False),
    ("stone-field", "owner", None, None, ["Ann Stone-Field"], [], [], ["Moss"], [], [], [], [], False, False),
    ("park", "owner", None, None, ["John P. Park"], [], [], ["Acme"], [], [], [], [], False, False),
    ("park-s", "child", "park", 0, ["John S. Park"], [], [], ["Zed"], [], [], [], [], False, False),
    ("vane", "owner", None, None, ["Henry Vane V"], ["Dale"], ["OH"], ["Vane Mills"], ["Miller"], [], [], [], False, False),
    ("twin-a", "owner", None, None, ["Kim Twin"], ["Eastport"], ["ME"], ["Alpha"], [], [], [], [], False, False),
    ("twin-b", "owner", None, None, ["Kim Twin"], ["Westport"], ["CT"], ["Beta"], [], [], [], [], False, False),
    ("twin-b-kim", "child", "twin-b", 0, ["Kim Twin Jr"], ["Westport"], ["CT"], ["Gamma"], [], [], [], [], False, False),
    ("henry", "owner", None, None, ["John W. Henry"], [], [], ["Sox"], [], [], [], [], False, False),
]

C, P, U = "CONFIRMED", "PROBABLE", "UNCERTAIN"
# name; first, middle, last, suffix; employer, occupation, city, state, ZIP; for each household: slug, status, signals
CASES = [
    ("STONE, ANN", "", "Acme Inc", "", "Springfield", "IL", "", [("stone", C, "employer:Acme,city_state:springfield/IL")]),
    ("Ann Stone", "", "Acme Inc", "", "", "", "", [("stone", P, "employer:Acme")]),
    ("ann  STONE", "", "", "", "", "", "", [("stone", U, "")]),
    ("Ann Stone", "", "Acme", "", "Springfield", "WY", "", [("stone", U, "employer:Acme")]),
    ("Ann Stone", "", "Acme", "", "Riverton", "", "", [("stone", U, "employer:Acme")]),
    ("Ann Stone", "", "Acme", "", "Springfield", "", "", [("stone", P, "employer:Acme")]),
    ("Ann Stone", "", "", "", "", "IL", "", [("stone", U, "")]),
    ("Ann Stone", "", "Stone Holdings LLC", "", "Riverton", "WY", "", [("stone", C, "strong_employer:Stone Holdings")]),
    ("Ann Stone", "", "", "", "", "", "12345-9999", [("stone", C, "strong_zip:12345")]),
    ("Ann Stone", "", "", "", "", "", "1234", [("stone", U, "")]),
    ("Ann Stone", "", "Rival Stone Holdings", "", "Springfield", "IL", "12345", [("stone", U, "negative_employer:Rival")]),
    ("Ann Stone", "", "Singapore Airlines", "", "", "", "", [("stone", U, "")]),
    ("Ann Stone", "", "Gap, Inc.", "Civil Engineers", "", "", "", [("stone", C, "employer:Gap,occupation:Engineer")]),
    ("Ann Stone", "", "Acme Gap Partners", "", "", "", "", [("stone", C, "employer:Acme,employer:Gap")]),
    ("Mrs. Ann Stone", "", "Stone Holdings", "", "Springfield", "IL", "12345", [("stone", U, "mrs_honorific")]),
    ("Dr. Ann Stone", "", "Acme", "", "", "", "", [("stone", P, "employer:Acme")]),
    ("Ann Stone Jr.", "", "Stone Holdings", "", "Springfield", "IL", "12345", [("stone", U, "")]),
    ("Ann M. Stone", "", "Acme", "", "", "", "", [("stone", P, "employer:Acme")]),
    ("Ann Marie Stone", "", "Acme", "", "", "", "", []),
    ("Annie Stone", "", "Acme", "", "", "", "", []),
    ("", "Ann||Stone|", "Acme", "", "", "", "", []),
    ("FIELD, BOB", "", "", "", "Riverton", "WY", "", [("field", U, "city_state:riverton/WY")]),
    ("FIELD, BOB", "", "Borealis", "", "Riverton", "WY", "", [("field", C, "employer:Borealis,city_state:riverton/WY")]),
    ("FIELD, BOB", "", "", "", "", "", "82501", [("field", U, "")]),
    ("FIELD, BOB", "", "", "", "", "", "825011234", [("field", C, "strong_zip:825011234")]),
    ("FIELD, ROBERT JR", "", "Borealis", "", "", "", "", [("field", P, "employer:Borealis")]),
    ("FIELD, ROBERT", "", "Borealis", "", "Riverton", "WY", "", [("field", U, "")]),
    ("FIELD, ROBERT III", "", "Kiteworks", "", "", "", "", [("field-rob", P, "employer:Kiteworks")]),
    ("FIELD, ROBERT III", "", "Kiteworks", "", "Riverton", "WY", "", [("field-rob", U, "employer:Kiteworks")]),
    ("Field, Cara Mrs", "", "", "Teacher", "Riverton", "WY", "", [("field-cara", C, "occupation:Teacher,city_state:riverton/WY")]),
    ("Field, Cara Sr", "", "", "Teacher", "Riverton", "WY", "", []),
    ("Bob Field", "", "North & Co Ltd", "", "", "", "", [("field", P, "employer:North & Co")]),
    ("Ann Stone-Field", "", "Moss Brothers", "", "", "", "", [("stone-field", P, "employer:Moss")]),
    ("Ann Field-Stone", "", "Moss", "", "", "", "", [("stone-field", P, "employer:Moss")]),
    ("STONE FIELD, ANN", "", "Moss", "", "", "", "", [("stone-field", P, "employer:Moss")]),
    ("ann field stone", "", "Mossy Bank", "", "", "", "", [("stone-field", P, "employer:Moss")]),
    ("Ann Field", "", "Moss", "", "", "", "", []),
    ("Park, John", "", "Acme", "", "", "", "", [("park-s", U, "")]),
    ("Park, John P", "", "Acme", "", "", "", "", [("park", P, "employer:Acme")]),
    ("Park, John S", "", "Zed", "", "", "", "", [("park-s", P, "employer:Zed")]),
    ("Park, John Q", "", "Acme", "", "", "", "", []),
    ("Park, John P", "", "Acme", "", "Anywhere", "TX", "", [("park", U, "employer:Acme")]),
    ("Vane, Henry V", "", "Vane Mills", "", "", "", "", [("vane", U, "")]),
    ("Henry Vane V", "", "Vane Mills", "", "Dale", "OH", "", [("vane", C, "employer:Vane Mills,city_state:dale/OH")]),
    ("Henry V. Vane", "", "", "Miller", "", "", "", [("vane", U, "")]),
    ("Kim Twin", "", "Beta", "", "Westport", "CT", "", [("twin-a", U, ""), ("twin-b", C, "employer:Beta,city_state:westport/CT")]),
    ("Kim Twin Jr", "", "Gamma", "", "", "", "", [("twin-a", U, ""), ("twin-b-kim", P, "employer:Gamma")]),
    ("HENRY JOHN W.", "John|W.|Henry|", "Sox", "", "", "", "", [("henry", P, "employer:Sox")]),
    ("HENRY JOHN W.", "John|W.|Henry|Jr", "Sox", "", "", "", "", [("henry", U, "")]),
    ("Henry John", "John|B.|Henry|", "Sox", "", "", "", "", []),
    ("Mrs", "", "Acme", "", "", "", "", []),
    (None, "", "Acme", "", "", "", "", []),
]

FIELDS = "case_id int, contributor_name string, contributor_first_name string, contributor_middle_name string, contributor_last_name string, contributor_suffix string, contributor_employer string, contributor_occupation string, contributor_city string, contributor_state string, contributor_zip string"


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ENTITIES, REGISTRY)


def records(spark: SparkSession) -> DataFrame:
    """case_id and the record of each case."""
    rows = []
    for i, (name, split, *rest) in enumerate(CASES):
        parts = (split or "|||").split("|")
        rows.append((i, name, *parts, *rest[:5]))
    return spark.createDataFrame(rows, FIELDS)


def answers() -> str:
    """SQL rows (case_id, entity_slug, status, signals) of the answers."""
    text = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({i}, {text(slug)}, {text(status)}, {text(signals)})" for i, case in enumerate(CASES) for slug, status, signals in case[-1])
