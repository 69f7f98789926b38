"""Quality classification by co-training of two views.

The text view sees a document's characters, words and lines; the metadata view sees its host, language and length as
recorded. Both are logistic regressions. They start from the labelled documents; in each round, each view labels those
unlabelled documents that it is most certain about, and hands them to the other view's training set. Labelled documents
that are held out calibrate each view's log-odds and then the combination of both, which scores all documents.

Both views' features of every document are computed once, over whole texts, and stored; each round searches all unlabelled
documents for the most certain ones, and the last step scores all, by column expressions. At most MAX_LABELLED labelled
documents, chosen by hash, teach and calibrate; that is the only bound. Unlabelled documents of equal features count once.

Defined cases: a null text is an empty one; null or unknown hosts, languages and lengths have features of their own;
repeated labels of an id are averaged, a tie counts as good; labels of other values than 0 and 1, or without an id or a
document, are left out; of documents with one labelled id, the one of the least features teaches; without labels of both
kinds there is no model, and each score is the share of good labels (1 where there is none); rows with equal ids are scored
each; an empty table gives an empty result; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_small_batches, lookup_join, stored

MAX_LABELLED = 4000
ROUNDS, PER_ROUND = 5, 100
#: Calibrated probability beyond which a view is certain.
CERTAIN = 0.97
#: Documents of a smaller probability to be good are rejected.
KEEP = 0.5
MARKS = "!*#$%&|<>{}=@_~^\\/"
HOSTS, LANGS = 64, 16
TEXT_FEATURES, META_FEATURES = 18, 4
#: Groups that the most certain documents of the tasks are ranked in before the driver sees them.
GROUPS = 16


def text_features(text: str) -> np.ndarray:
    """The text view: shares of kinds of characters, and how words and lines repeat."""
    n = max(1, len(text))
    words = text.split()
    w = max(1, len(words))
    lower = [x.lower() for x in words]
    distinct = set(lower)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = max(1, sum(map(str.isalpha, text)))
    marks = sum([text.count(c) for c in MARKS])
    same = sum(map(str.__eq__, lower, lower[1:]))
    counts: dict[str, int] = {}
    for x in lower:
        counts[x] = counts.get(x, 0) + 1
    pairs = len(set(zip(lower, lower[1:], strict=False))) if w > 1 else 1
    return np.array(
        [
            1.0,
            sum(map(str.isupper, text)) / letters,
            marks / n,
            sum(map(str.isdigit, text)) / n,
            letters / n,
            math.log1p(sum(map(len, words)) / w),
            same / w,
            len(distinct) / w ** 0.8,
            pairs / max(1, w - 1),
            max(counts.values(), default=0) / w,
            len(set(lines)) / max(1, len(lines)),
            math.log1p(w),
            math.log1p(len(lines)),
            math.log1p(n / max(1, len(lines))),
            sum([x[-1] in MARKS for x in words]) / w,
            sum([x.isupper() for x in words]) / w,
            sum([x in MARKS for x in words]) / w,
            float(w < 5),
        ]
    )


def meta_features(host: str | None, lang: str | None, size: float | None) -> list[float]:
    """The metadata view: the recorded length, whether it is unknown, and the slots of the hashed host and language."""
    known = size is not None and math.isfinite(size)
    slot = lambda x, n: float(zlib.crc32(x.encode("utf-8", "surrogatepass")) % n if x is not None else n)
    return [math.log1p(max(0.0, size)) / 10 if known else 0.0, float(not known), slot(host, HOSTS), slot(lang, LANGS)]


def expanded(meta: np.ndarray) -> np.ndarray:
    """Rows of meta_features as columns: a constant, both numbers, and one column a slot of host and language."""
    out, rows = np.zeros((len(meta), 3 + HOSTS + 1 + LANGS + 1)), np.arange(len(meta))
    out[:, 0] = 1.0
    out[:, 1:3] = meta[:, :2]
    out[rows, 3 + meta[:, 2].astype(int)] = 1.0
    out[rows, 4 + HOSTS + meta[:, 3].astype(int)] = 1.0
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """The weights of a ridge logistic regression, by Newton's method; the first column is the constant and isn't shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-3
    for _ in range(steps):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class View:
    """Standardisation, weights and calibration (slope, offset) of a view."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * np.clip(((x - self.mean) / self.scale) @ self.w, -30, 30) + self.offset

    @classmethod
    def learned(cls, x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
        mean, scale = x.mean(0), x.std(0) + 1e-6
        mean[0], scale[0] = 0.0, 1.0
        scale[scale < 1e-5] = 1.0
        view = cls(mean, scale, fitted((x - mean) / scale, y))
        z = view.log_odds(held_x)
        b, a = fitted(np.stack([np.ones(len(z)), z], 1), held_y, ridge=0.05)
        view.slope, view.offset = max(float(a), 0.0), float(b)
        return view


@dataclass
class CoTrained:
    """Both views and the weights (constant, text, metadata) of their combination; without views, a constant."""

    text: View | None
    meta: View | None
    weights: np.ndarray
    rounds: list[tuple[int, int]]


def _linear(view: View) -> tuple[np.ndarray, float]:
    """Weights and constant of a view's log-odds before clipping and calibration."""
    w = view.w / view.scale
    return w, -float(view.mean @ w)


Chosen = dict[tuple[int, bool], tuple[np.ndarray, np.ndarray, np.ndarray]]


def cotrain(text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, choose: Callable[[list[View], np.ndarray], Chosen], rounds: int = ROUNDS) -> CoTrained:
    """Rounds of exchange between the views; `held` marks the labelled rows that calibrate.

    choose(views, taken) gives of each view and class the keys and both kinds of features of the unlabelled documents that
    the view is most certain about, without those whose keys are taken.
    """
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)  # too few to hold any out: they calibrate what they taught
        if len(set(y)) < 2:
            return CoTrained(None, None, np.array([y.mean() if len(y) else 1.0]), [])
    calibrate = held if held.any() else ~held
    whole = [text, expanded(meta)]
    own, seen = [x[~held] for x in whole], [x[calibrate] for x in whole]
    extra_x, extra_y = [[], []], [[], []]
    taken = np.zeros(0, np.int64)
    exchanged = []
    for r in range(rounds + 1):
        views = [View.learned(np.concatenate([own[v], *extra_x[v]]), np.concatenate([y[~held], *extra_y[v]]), seen[v], y[calibrate]) for v in (0, 1)]
        if r == rounds:
            break
        chosen = choose(views, taken)
        for (v, good), (_, t, m) in chosen.items():
            extra_x[1 - v].append(expanded(m) if v == 0 else t)
            extra_y[1 - v].append(np.full(len(t), float(good)))
        taken = np.unique(np.concatenate([taken, *(c[0] for c in chosen.values())]))
        exchanged.append(tuple(sum(len(c[0]) for (v, _), c in chosen.items() if v == view) for view in (0, 1)))
        if not any(exchanged[-1]):
            break
    a, b = (views[v].log_odds(seen[v]) for v in (0, 1))
    return CoTrained(*views, fitted(np.stack([np.ones(len(a)), a, b], 1), y[calibrate], ridge=0.05), exchanged)


def most_certain(views: list[View], taken: np.ndarray, keys: np.ndarray, text: np.ndarray, meta: np.ndarray, n: int = PER_ROUND) -> dict[tuple[int, bool], tuple[np.ndarray, ...]]:
    """Of each view and class: strength (calibrated log-odds), key and features of the n documents that it is most certain about."""
    free = ~np.isin(keys, taken)
    sure, out = math.log(CERTAIN / (1 - CERTAIN)), {}
    for v, x in ((0, text), (1, expanded(meta))):
        odds = views[v].log_odds(x)
        for good in (True, False):
            strength = odds if good else -odds
            at = np.flatnonzero(free & (strength >= sure))
            at = at[np.unique(keys[at], return_index=True)[1]]
            at = at[np.lexsort((keys[at], -strength[at]))[:n]]
            out[v, good] = strength[at], keys[at], text[at], meta[at]
    return out


def _lists(x: np.ndarray) -> pa.Array:
    """Rows as Arrow lists of floats."""
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], np.ascontiguousarray(x, np.float32).ravel())


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def featured(docs: DataFrame, carry: list[str], key: str = "doc_id", text: str = "text", host: str = "source", lang: str = "lang", size: str = "n_chars") -> DataFrame:
    """Stored: __doc (a struct of the columns `carry` of each row), __id, t and m (the features of both views)."""
    own = [c for c in (text, host, lang, size) if c in docs.columns]
    names = [*dict.fromkeys([*carry, key, *own])]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__doc"))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("__doc"), F.col(key).alias("__id"), F.array(F.lit(0.0).cast("float")).alias("t"), F.array(F.lit(0.0).cast("float")).alias("m")).schema
    at = {c: i for i, c in enumerate(names)}
    whole = len(carry) == len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0)
            cells = lambda c: doc.field(at[c]).to_pylist() if c in at else [None] * len(doc)  # noqa: B023, E731
            number = lambda x: None if x is None else float(x)
            word = lambda x: None if x is None else str(x)
            t = np.array([text_features(x or "") for x in cells(text)]).reshape(-1, TEXT_FEATURES)
            m = np.array([meta_features(word(h), word(g), number(n)) for h, g, n in zip(cells(host), cells(lang), cells(size), strict=True)]).reshape(-1, META_FEATURES)
            kept = doc if whole else pa.StructArray.from_arrays([doc.field(at[c]) for c in carry], fields=[doc.type.field(at[c]) for c in carry])
            yield pa.RecordBatch.from_arrays([kept, doc.field(at[key]), _lists(t), _lists(m)], names=["__doc", "__id", "t", "m"])

    return stored(in_small_batches(rows).mapInArrow(run, out), "features")


def _search(unlabelled: DataFrame, n: int) -> Callable[[list[View], np.ndarray], Chosen]:
    """choose() over a stored table of key, t and m: tasks keep their n most certain, which are ranked in groups of keys."""

    def choose(views: list[View], taken: np.ndarray) -> Chosen:
        known = unlabelled.sparkSession.sparkContext.broadcast((views, taken))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[tuple[int, bool], tuple[np.ndarray, ...]] = {}
            for batch in batches:
                found = most_certain(*known.value, batch.column(0).to_numpy(), _rows(batch.column(1), TEXT_FEATURES), _rows(batch.column(2), META_FEATURES), n)
                for k, new in found.items():
                    both = [np.concatenate(x) for x in zip(best[k], new, strict=True)] if k in best else new
                    at = np.unique(both[1], return_index=True)[1]
                    at = at[np.lexsort((both[1][at], -both[0][at]))[:n]]
                    best[k] = tuple(x[at] for x in both)
            for (v, good), (strength, keys, t, m) in best.items():
                yield pa.RecordBatch.from_arrays([pa.array([v] * len(keys), pa.int32()), pa.array([good] * len(keys), pa.bool_()), pa.array(strength), pa.array(keys), _lists(t), _lists(m)], names=["view", "good", "strength", "key", "t", "m"])

        rows = unlabelled.mapInArrow(run, "view int, good boolean, strength double, key long, t array<float>, m array<float>")
        group = F.pmod("key", F.lit(GROUPS)).alias("group")
        rows = rows.groupBy("view", "good", group, "key").agg(F.max("strength").alias("strength"), F.max("t").alias("t"), F.max("m").alias("m"))
        order = Window.partitionBy("view", "good", "group").orderBy(F.desc("strength"), "key")
        some = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).collect()  # 4 * GROUPS * n at most
        out: Chosen = {}
        for v in (0, 1):
            for good in (True, False):
                top = sorted([(-r.strength, r.key, r.t, r.m) for r in some if (r.view, r.good) == (v, good)])[:n]
                out[v, good] = np.array([x[1] for x in top], np.int64), np.array([x[2] for x in top], float).reshape(-1, TEXT_FEATURES), np.array([x[3] for x in top], float).reshape(-1, META_FEATURES)
        return out

    return choose


def trained(features: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> CoTrained:
    """Fits the classifier on featured() documents and labels."""
    votes = labels.select(F.col(key).alias("__id"), F.col(label).cast("int").alias("y")).where("y IN (0, 1) AND __id IS NOT NULL").groupBy("__id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    votes = stored(votes.withColumn("h", F.xxhash64("__id")), "votes")
    share = min(1.0, 1.5 * max_labelled / max(1, votes.count()))
    sample = votes.where(F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy("h", "__id").limit(max_labelled)
    narrow = features.select("__id", "t", "m")
    known = narrow.join(F.broadcast(sample), "__id").groupBy("h", "__id", "y").agg(F.min(F.struct("t", "m")).alias("x")).orderBy("h", "__id").collect()  # max_labelled at most
    t = np.array([r.x.t for r in known], float).reshape(-1, TEXT_FEATURES)
    m = np.array([r.x.m for r in known], float).reshape(-1, META_FEATURES)
    others = lookup_join(narrow, votes.select("__id"), ["__id"], "left_anti", ["t"])
    others = stored(others.select(F.xxhash64("t", "m").alias("key"), "t", "m"), "unlabelled")
    return cotrain(t, m, np.array([r.y for r in known], float), np.array([r.h % 4 == 0 for r in known], bool), _search(others, per_round), rounds)


def _clipped(z: Column, limit: float) -> Column:
    return F.greatest(F.least(z, F.lit(limit)), F.lit(-limit))


def _odds(view: View, z: Column) -> Column:
    return _clipped(z, 30.0) * F.lit(view.slope) + F.lit(view.offset)


def _probability(z: Column) -> Column:
    return 1 / (1 + F.exp(-_clipped(z, 40.0)))


def scored(features: DataFrame, model: CoTrained, keep: float = KEEP) -> DataFrame:
    """Columns __doc, p_text, p_meta, score, keep of featured() documents, by column expressions."""
    if model.text is None:
        share = F.lit(float(model.weights[0]))
        return features.select("__doc", share.alias("p_text"), share.alias("p_meta"), share.alias("score"), (share >= keep).alias("keep"))
    (w, c), (u, d) = _linear(model.text), _linear(model.meta)
    slot = lambda i, first, n: F.element_at(F.array(*[F.lit(float(x)) for x in u[first : first + n]]), F.get("m", F.lit(i)).cast("int") + 1)
    text = sum((F.get("t", F.lit(i)).cast("double") * float(x) for i, x in enumerate(w)), F.lit(c))
    meta = F.lit(d + float(u[0])) + F.get("m", F.lit(0)).cast("double") * float(u[1]) + F.get("m", F.lit(1)).cast("double") * float(u[2]) + slot(2, 3, HOSTS + 1) + slot(3, 4 + HOSTS, LANGS + 1)
    rows = features.select("__doc", _odds(model.text, text).alias("a"), _odds(model.meta, meta).alias("b"))
    k = [F.lit(float(x)) for x in model.weights]
    rows = rows.select("__doc", _probability(F.col("a")).alias("p_text"), _probability(F.col("b")).alias("p_meta"), _probability(k[0] + F.col("a") * k[1] + F.col("b") * k[2]).alias("score"))
    return rows.withColumn("keep", F.col("score") >= keep)


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id, p_text, p_meta, score and keep of every document."""
    features = featured(docs, [key], key)
    return scored(features, trained(features, labels, key)).select(F.col("__doc")[key].alias("doc_id"), "p_text", "p_meta", "score", "keep")


def accepted(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """The documents, in their own columns, that the classifier doesn't reject."""
    features = featured(docs, docs.columns)
    return scored(features, trained(features, labels), keep).where("keep").select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
