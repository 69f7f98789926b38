"""The corpus pipeline's stages and run() against plain implementations, on a small corpus with planted cases."""

import hashlib
import random

import pytest

pytest.importorskip("tallyroll.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tallyroll.llm import common, cotrain, linededup  # noqa: E402
from tallyroll.llm.common import table  # noqa: E402
from tallyroll.llm.queries import tokenizer_path  # noqa: E402

from .test_operators import DOCS, _brute_classes, _words  # noqa: E402


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """documents, labels and benchmark as files: good and junk texts, boilerplate lines, copies, benchmark passages, odd rows."""
    r, rows = random.Random(41), []
    items = [(k, " ".join(_words(r, n))) for k, n in enumerate((8, 15, 30))] + [(7, None), (8, "")]
    menu = "home about contact imprint"
    for i in range(240):
        host = "abc"[i % 3]
        w = _words(r, r.randrange(30, 90))
        if i % 6 == 5:  # junk
            text = " ".join(x.upper() + "!!$$" for x in w)
        elif i % 15 == 3:  # a benchmark passage with every tenth word replaced
            text = " ".join(w + [x if n % 10 else "zz" for n, x in enumerate(items[i % 3][1].split())] + _words(r, 5))
        else:
            text = " ".join(w[:20]) + "\n" + " ".join(w[20:])
        rows.append((i, f"{menu}\n{text}" if host == "a" else text, "en", host, None))
    for i in range(60):  # exact and near copies, at other hosts
        text = rows[4 * i][1].replace(f"{menu}\n", "")
        w = text.split(" ")
        if i % 2:
            w[len(w) // 2] = "changed"
        rows.append((300 + i, " ".join(w), "en", "d", None))
    rows += [(500, None, None, None, None), (501, "", "en", "a", 0), (None, rows[0][1], "en", "a", None), (502, rows[1][1], "en", "b", 7), (502, rows[1][1], "en", "b", 7), (503, "long words " * 4000, "en", "b", None)]
    rows = [(i, t, g, s, n if n is not None or t is None else len(t)) for i, t, g, s, n in rows]
    labels = [(i, int(i % 6 != 5), 0) for i in range(0, 240, 2)] + [(1, 1, 0), (5, 0, 0), (11, 0, 0), (17, 0, 0), (23, 0, 0), (29, 0, 0), (35, 0, 0), (41, 0, 0), (47, 0, 0), (53, 0, 0), (59, 0, 0), (65, 0, 0)]
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def _plain_lines(rows):
    """The rows without lines that more than a tenth of a host's pages hold, two pages at least."""
    pages, counts = {}, {}
    for _, text, _, host, _ in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            counts[host, line] = counts.get((host, line), 0) + 1
    bad = {k for k, n in counts.items() if n >= 2 and n > pages[k[0]] * linededup.RATIO}
    out = []
    for i, text, lang, host, _ in rows:
        new = None if text is None else "\n".join(x for x in text.split("\n") if (host, x.strip(" ")) not in bad)
        out.append((i, new, lang, host, None if new is None else len(new)))
    return out


def _plain_contaminated(text, items):
    import re

    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    w = words(text)
    for v in map(words, items):
        if v and any(5 * sum(0 <= j + at < len(w) and w[j + at] == x for j, x in enumerate(v)) >= 4 * len(v) for at in range(1 - len(v), len(w))):
            return True
    return False


def test_pipeline_matches_plain_stages(spark, corpus):
    tokenizers = pytest.importorskip("tokenizers")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "tokens"] and corpus_pipeline.ORACLE_SQL is None
    docs = table(spark, corpus, "documents")
    stages = dict(corpus_pipeline.STAGES)
    key = lambda r: tuple(map(str, r))

    judged = cotrain.report(docs, table(spark, corpus, "labels")).where("keep").collect()
    kept = stages["quality"](spark, docs, corpus)
    rows = [tuple(r) for r in kept.collect()]
    assert kept.columns == docs.columns and sorted(map(str, (r[0] for r in rows))) == sorted(str(r.doc_id) for r in judged)
    ids = {r[0] for r in rows}
    junk = set(range(5, 240, 6))
    assert not ids & junk and len(ids & (set(range(240)) - junk)) == 200

    want = _plain_lines(rows)
    lines = stages["line_dedup"](spark, kept, corpus)
    assert lines.columns == docs.columns and sorted(map(key, lines.collect())) == sorted(map(key, want))
    assert not any("imprint" in (t or "") for _, t, _, s, _ in want if s == "a")

    roots, best = _brute_classes([r[:2] for r in want]), {}
    for r, g in zip(want, roots):
        if g not in best or (r[0] is None, r[0] or 0) < (best[g][0] is None, best[g][0] or 0):
            best[g] = r
    near = stages["near_dedup"](spark, lines, corpus)
    assert near.columns == docs.columns and sorted(map(key, near.collect())) == sorted(map(key, best.values()))
    assert len(best) < len(want) - 50

    items = [r.text for r in table(spark, corpus, "benchmark").collect()]
    clean = [r for r in best.values() if not _plain_contaminated(r[1], items)]
    left = stages["decontamination"](spark, near, corpus)
    assert left.columns == docs.columns and sorted(map(key, left.collect())) == sorted(map(key, clean)) and len(clean) <= len(best) - 8

    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for r in clean:
        encoded = library.encode(r[1] or "", add_special_tokens=False).ids
        expected.append((r[0], len(encoded), digest(" ".join(map(str, encoded))), digest(library.decode(encoded, skip_special_tokens=False))))
    got = corpus_pipeline.run(spark, corpus)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and sorted(map(key, got.collect())) == sorted(map(key, expected))


def test_pipeline_of_an_empty_table(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, corpus, name).limit(0).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_first_stage_with_more_labels_than_are_broadcast(spark, corpus, monkeypatch):
    docs, plans, keep = table(spark, corpus, "documents"), {}, common.stored
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    few = rows(corpus_pipeline.quality(spark, docs, corpus))

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(common, "small", lambda *a: False)
    monkeypatch.setattr(cotrain, "stored", seen)
    assert rows(corpus_pipeline.quality(spark, docs, corpus)) == few
    assert "LeftAnti" in plans["unlabelled"] and "Broadcast" not in plans["unlabelled"]
