import hashlib
import re

import numpy as np
import pytest

from roadlens.llm import decontaminate as D
from llm_helpers import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    out = []
    for text in texts:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            q = words(item)
            n = min(window, len(q))
            grams = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    ids.add(str(item_id))
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()))
    return out


def result(df):
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r.item_ids).encode()).hexdigest()) for r in df.collect()]


def check(spark, docs, texts, items):
    items_df = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(result(D.contamination(docs(texts, extra=True), items_df)))
    assert got == [(i, *row) for i, row in enumerate(brute(texts, items))]


def test_brute_force(spark, docs, rng):
    items = [(i, prose(rng, int(n))) for i, n in enumerate(rng.integers(1, 40, 25))]
    items += [(90, items[0][1]), (91, ""), (92, None), (93, "ka " * 12)]
    texts = []
    for _ in range(60):
        parts = [prose(rng, int(rng.integers(0, 40)))]
        if rng.random() < 0.6:
            q = words(items[int(rng.integers(25))][1])
            a = int(rng.integers(len(q)))
            parts += ["! ".join(q[a:a + int(rng.integers(1, 25))]).upper(), prose(rng, 5)]
        texts.append(", ".join(parts))
    check(spark, docs, [*texts, "ka " * 300, "ka-ka.KA " * 9], items)


def test_awkward(spark, docs, awkward):
    check(spark, docs, awkward, [(1, "lorem ipsum " * 8), (2, "same text twice same"), (3, "ÄÖ É ü"), (4, "İ"), (-5, "12")])
    check(spark, docs, awkward, [])
    assert D.contamination(docs([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_repeated_rows_and_missing_ids(spark, docs):
    items = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    rows = [(1, "zero one two three"), (1, "zero one two three"), (None, "one two three"), (None, "none")]
    got = sorted(result(D.contamination(docs(rows), items)), key=repr)
    assert [(r[0], r[2]) for r in got] == [(1, 3), (1, 3), (None, 0), (None, 3)]
    kept = D.clean(docs(rows, extra=True), items)
    assert kept.columns == docs([], extra=True).columns
    assert [tuple(r)[:2] for r in kept.collect()] == [(None, "none")]


@pytest.mark.parametrize("rows", [0, 10 ** 9])
def test_shuffled_and_broadcast_lookups_agree(spark, docs, rng, rows):
    text = prose(rng, 40)
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    found, _ = D.hits(docs([text + " tail", prose(rng, 30)]), items, broadcast_rows=rows)
    assert found.filter("start >= 0").select("start").distinct().count() == 31


def test_main_path_is_native(spark, docs):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = D.contamination(docs(["a b c"]), items)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert np.all([c not in plan for c in ("CartesianProduct", "NestedLoop")])


def test_shuffled_lookup_sends_places_not_words(spark, docs, rng):
    """A text of 20,000 words crosses the network as places and fingerprints, and comes back by row; rows without hits stay apart."""
    long = prose(rng, 20_000)
    items = [(i, " ".join(long.split()[900 * i:900 * i + 30])) for i in range(20)] + [(50, "ka lo"), (51, None)]
    texts = [long, prose(rng, 30), None, "", "ka lo mi", long]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    small, _ = D.hits(docs(texts), items_df, broadcast_rows=10**9)
    large, _ = D.hits(docs(texts), items_df, broadcast_rows=0)
    rows = lambda df: sorted(tuple(r) for r in df.filter("start >= 0").select("doc_id", "n_words", "start", "length", "window").distinct().collect())
    assert rows(small) == rows(large) and len(rows(large)) > 100
    assert sorted(r.doc_id for r in large.filter("start = -1").collect()) == list(range(6))
    text = large._jdf.queryExecution().optimizedPlan().toString()
    join = text[text.index("Join LeftSemi"):]
    side = join.split("\n")[1]
    assert "_words" not in side and "Project" in side
