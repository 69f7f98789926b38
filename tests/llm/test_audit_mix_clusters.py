"""Filter audit, mixing and centroid clustering against plain implementations and in their defined cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

pytest.importorskip("tallyroll.llm")
from pyspark.sql import functions as F  # noqa: E402

from tallyroll.llm import annulus, filteraudit, mixing  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, size string, part string"
LABELS = "doc_id long, quality int, toxic int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0, "x", "y", "z") for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(21)
    words = lambda n, k: " ".join(f"w{r.randrange(k)}" for _ in range(n))
    out = [(i, words(r.choice((3, 150, 230, 260)), r.choice((20, 400))) + r.choice(("", " a#b", " ABC" * 60)), r.choice(("en", "de")), f"s{r.randrange(7)}") for i in range(120)]
    copy = out[5][1]
    out += [(1000 + i, copy, "en", "s1") for i in range(150)] + [(3, copy, "fr", "s1"), (3, copy, "fr", "s1"), (None, copy, "en", None), (None, copy, "en", None)]
    out += [(700, None, None, "s2"), (701, "", "", None), (702, "", "en", "s2"), (703, "  x \x85y\x1cz\tq\x0bv", "en", "s3"), (704, "É" * 40 + " ABC", "en", "s3"), (705, words(70_000, 30_000), "en", "s4")]
    return out


def test_filter_audit_matches_brute_force(spark, rows):
    r = random.Random(2)
    labels = [(i, r.choice((0, 1, None)), r.choice((0, 1))) for i, *_ in rows if r.random() < 0.5] + [(5, 0, 1), (5, 1, 0), (None, 1, 1), (99_999, 1, 1)]
    good, bad = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang, _ in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        docs.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in bad))
    want, shapley = {}, defaultdict(int)
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [d for d in own if f in d[1] and not d[1] & before]
                kept = sum(not d[1] & (before | {f}) for d in own)
                want[part, order, step] = (kept, len(gone), sum(f in d[1] and bool(d[1] & before) for d in own), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone))
                shapley[part, f] += len(gone)
    table = _docs(spark, rows).repartition(5)
    for held in (filteraudit.HELD_BYTES, 2000):  # chains that are sent on early give the same
        counted = filteraudit.masks(table, held=held).groupBy("mask").agg(F.sum("rows").alias("n")).collect()
        assert sum(x.n for x in counted) == len(rows)
    got = filteraudit.audit(table, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 4 * 600
    for x in got:
        assert (x.kept, x.removed, x.redundant, x.unique_fails, x.good_lost, x.toxic_lost) == want[x.part, x.filter_order, x.step]
        assert x.shapley == shapley[x.part, x.filter_order[x.step - 1]]


def test_filter_audit_collisions_and_empty_tables(spark, rows):
    chains = filteraudit.Chains()
    told = [g for k, (text, key) in enumerate([(b"a", 5), (b"b", 3), (b"a", 2), (b"a", 2), (b"b", 9), (b"a", 1)]) for g in chains.add(7, text, key, 0, {f"p{k}": 1})]
    e = filteraudit.DUPLICATE
    assert told == [(5, "p0", e, 1), (9, "p4", e, 1), (2, "p2", e, 1), (2, "p3", e, 1)]
    assert [(link[0], link[1], link[3]) for _, link in chains.flush()] == [(b"a", 1, {"p5": 1}), (b"b", 3, {"p1": 1})]
    empty, labels = _docs(spark, rows).limit(0), spark.createDataFrame([], LABELS)
    assert filteraudit.audit(empty, labels).collect() == []
    assert filteraudit.audit(_docs(spark, rows[:1]), labels).count() == 600


def _targets(sizes, share=Fraction(3, 2), most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        if not free:
            return {s: Fraction(most * sizes[s]) for s in order}
        rate = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > most * sizes[s]}
        if not over:
            return {s: Fraction(most * sizes[s]) if s in full else rate * weight[s] for s in order}
        full |= over


def test_mix_meets_its_targets_exactly(spark, rows):
    docs = _docs(spark, rows)
    size = {s: sum(len(WORD.findall(t or "")) for _, t, _, x in rows if x == s) for s in {x for *_, x in rows}}
    want = _targets(size)
    options = {"block": 64, "bucket_words": 3000, "group": 3, "shards": 5}
    mix, placed, sources = mixing.write_mix(docs.repartition(4), **options)
    for s in sources.collect():
        name = None if s.src == "b" else s.src[1:]
        assert s.size == size[name] and math.isclose(s.target, want[name], rel_tol=1e-12, abs_tol=1e-9) and s.wanted == math.floor(want[name] + Fraction(1, 2))
    got = {s.src: s.words for s in mix.groupBy("src").agg(F.sum("words").alias("words")).collect()}
    assert got == {s.src: s.wanted for s in sources.collect() if s.wanted}
    report = mixing.report(docs.repartition(3), **options).collect()
    assert Counter((x.doc_id, x.size) for x in report) == Counter((i, len(WORD.findall(t or ""))) for i, t, *_ in rows)
    assert all(0 <= x.taken <= 2 * x.size for x in report)
    first = placed.join(mix.groupBy("src", "start").agg(F.sum("words").alias("taken")), ["src", "start"], "left").collect()
    assert Counter((x.id, x.size, x.taken or 0) for x in first) == Counter((x.doc_id, x.size, x.taken) for x in report)  # reruns agree
    # no words of a pass are drawn twice, blocks lie in one shard and together, and shards hold equal numbers of blocks
    spans = mix.collect()
    seen = Counter((x.src, x["pass"], x.start + x["from"] + k) for x in spans for k in range(x.words))
    assert max(seen.values()) == 1
    where = defaultdict(set)
    for x in spans:
        where[x.src, x["pass"], x.block].add((x.shard, x.cell, x.ticket))
    assert all(len(v) == 1 for v in where.values())
    blocks = Counter(shard for v in where.values() for shard, *_ in v)
    assert len(blocks) == 5 and max(blocks.values()) - min(blocks.values()) <= 3
    texts = {x.doc_id: x.text for x in docs.where("doc_id IS NOT NULL").collect()}
    for x in mixing.texts(mix, docs).collect():
        assert len(WORD.findall(x.text)) == x.words
        if x.id not in (None, 3):
            assert WORD.findall(x.text) == WORD.findall(texts[x.id])[x["from"] : x["from"] + x.words]


def test_mix_of_hot_rows_and_of_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 16)
    same = [(1, "one two three", "en", "hot")] * 100 + [(k, "four five", "en", "cold") for k in range(40)]
    out = mixing.report(_docs(spark, same), block=8, bucket_words=50).collect()
    assert len(out) == 140 and sum(x.taken for x in out if x.size == 3) == 410 and sum(x.taken for x in out if x.size == 2) == 160
    assert mixing.report(_docs(spark, rows).limit(0)).collect() == []
    none = mixing.report(_docs(spark, [(1, None, "en", "a"), (2, " \t", "en", None)])).collect()
    assert sorted((x.doc_id, x.size, x.source_size, x.target, x.taken) for x in none) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_tree_splits_quotas_exactly(spark):
    quotas = {i: (i * 37) % 90 for i in range(23)}
    table = spark.createDataFrame(list(quotas.items()), "place long, draws long")
    for shards, group in ((1, 100), (7, 100), (7, 4)):
        ends = {r.place: [*r.offsets, quotas[r.place]] for r in mixing.dealt(table, shards, 5, group).collect()}
        cells = {i: [b - a for a, b in zip(e, e[1:])] for i, e in ends.items()}
        assert all(min(c) >= 0 and sum(c) == quotas[i] and len(c) == shards for i, c in cells.items())
        totals = [sum(c[s] for c in cells.values()) for s in range(shards)]
        assert max(totals) - min(totals) <= 2
    long = lambda v: F.lit(v).cast("long")
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 53)) / float(1 << 53)
    drawn = spark.range(20_000).select(mixing._hypergeometric(long(5), long(12), long(4), u).alias("x")).groupBy("x").count().collect()
    for r in drawn:
        p = math.comb(5, r.x) * math.comb(7, 4 - r.x) / math.comb(12, 4)
        assert abs(r["count"] / 20_000 - p) < 4 * math.sqrt(p * (1 - p) / 20_000)


def test_blocks_are_permuted(spark):
    for n in (1, 2, 7, 64, 999):
        out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), [F.lit(3), F.lit(n)]).alias("p")).collect()
        assert sorted(r.p for r in out) == list(range(n)) and (n < 64 or [r.p for r in out] != list(range(n)))


def _lloyd(vectors, k, rounds):
    """Plain rounds over Python integers: (cluster, distance) of each vector, and the centroids."""
    ints = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v in vectors]
    order = sorted(range(len(ints)), key=lambda i: (vectors[i][0] is None, hashlib.sha256(f"2:{vectors[i][0]}".encode()).hexdigest() if vectors[i][0] is not None else "", ints[i]))
    centroids = [ints[i] for i in order[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for x in ints:
            groups[near(x)[1]].append(x)
        for n, own in groups.items():
            centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    return [(n, d) for d, n in map(near, ints)], centroids


EMBEDDINGS = "vec_id long, embedding array<float>, label int, id string, cluster string"


@pytest.mark.parametrize("spread", [0.02, 1.0, 1e6])
def test_clusters_match_plain_rounds(spark, spread):
    r = random.Random(int(spread * 100))
    middles = [[r.gauss(0, 1) for _ in range(6)] for _ in range(9)]
    vectors = [(i, [m + r.gauss(0, spread) for m in r.choice(middles)]) for i in range(300)]
    vectors += [(i, [round(x * 2) / 256 for x in v]) for i, v in vectors[:60]]  # repeated ids, and many ties
    vectors += [(None, [0.0] * 6), (400, [0.0] * 6), (401, [-0.001] * 6), (402, [0.0] * 6)]
    bad = [(500, None), (501, []), (502, [1.0] * 5), (503, [1.0, None] * 3), (504, [float("nan")] * 6), (505, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in vectors + bad], EMBEDDINGS).repartition(4)
    got = annulus.clusters(df, k=12, rounds=4, dimensions=6).collect()
    want, centroids = _lloyd(vectors, 12, 4)
    assert Counter((x.vec_id, x.cluster, x.distance) for x in got) == Counter((i, n, d if d < 1 << 63 else None) for (i, _), (n, d) in zip(vectors, want))
    inertia = defaultdict(int)
    for n, d in want:
        inertia[n] += d
    for x in got:
        assert x.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[x.cluster])).encode()).hexdigest()
        assert (x.cluster_inertia, x.inertia) == tuple(v if v < 1 << 63 else None for v in (inertia[x.cluster], sum(inertia.values())))


def test_clusters_of_few_huge_and_no_vectors(spark):
    frame = lambda rows: spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], EMBEDDINGS)
    few = annulus.clusters(frame([(1, [1.0, 2.0]), (2, [3.0, 4.0])]), k=5, dimensions=2).collect()
    assert sorted(x.distance for x in few) == [0, 0] and len({x.cluster for x in few}) == 2
    rows = [(i, [float(10**30) if i == 3 else i * 1.0, -2.0]) for i in range(8)]
    want, _ = _lloyd(rows, 2, 3)
    huge = {x.vec_id: x for x in annulus.clusters(frame(rows), k=2, rounds=3, dimensions=2).collect()}
    assert all(huge[i].cluster == n and huge[i].distance == (d if d < 1 << 63 else None) for (i, _), (n, d) in zip(rows, want))
    assert annulus.clusters(frame([(1, None)]), dimensions=2).collect() == [] and annulus.clusters(frame([]), dimensions=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_annulus_leaves_out_only_what_is_farther(spark):
    r = np.random.default_rng(4)
    centroids = [[int(v) for v in row] for row in r.integers(-40, 40, (30, 8)) * r.integers(1, 60, (30, 1))]
    rings, x = annulus.Rings(centroids), r.integers(-900, 900, (500, 8))
    exact = ((x[:, None] - np.array(centroids)) ** 2).sum(2)
    for home in (None, r.integers(0, 30, 500)):
        best, distance = rings.assign(x, home)
        assert (best == exact.argmin(1)).all() and (distance == exact.min(1)).all()
