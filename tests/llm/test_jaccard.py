import numpy as np
import pytest

from roadlens.llm import jaccard as J
from llm_helpers import prose


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


def check(docs, texts):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.link_components(docs(texts, extra=True), sketch_bits=10).collect())
    assert got == brute(texts)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[int(rng.integers(len(words)))] = prose(rng, 1)
    return " ".join(words)


def families(rng, groups=8, copies=12):
    texts = [prose(rng, int(rng.integers(1, 60))) for _ in range(40)]
    for _ in range(groups):
        words = prose(rng, int(rng.integers(30, 200))).split()
        texts += [edited(rng, words, int(rng.integers(0, 4))) for _ in range(copies)]
    passage = prose(rng, 60)
    return texts + [f"{prose(rng, 30)} {passage} {prose(rng, 20)}" for _ in range(20)]


@pytest.mark.parametrize("long", [2, 50])
def test_brute_force(docs, rng, monkeypatch, long):
    monkeypatch.setattr(J, "LONG", long)
    check(docs, families(rng))


@pytest.mark.parametrize("long", [2, 50])
def test_long_lists_in_tiles(docs, rng, monkeypatch, long):
    monkeypatch.setattr(J, "TILE", 3)
    monkeypatch.setattr(J, "LONG", long)
    check(docs, families(rng, 5, 20))


def test_chain_of_links(docs, rng):
    words = prose(rng, 100).split()
    texts = []
    for i in range(25):
        words[(i * 4) % 100] = f"changed{i}"
        texts.append(" ".join(words))
    check(docs, texts[::-1])


def test_threshold_is_met_exactly(docs):
    # 5-word shingles of w0..w13 (10) and of w0..w11 (8): 8 / 10 is a link; 7 / 10 is not.
    w = [f"w{i}" for i in range(14)]
    check(docs, [" ".join(w), " ".join(w[:12]), " ".join(w[:11]).upper()])


def test_awkward(docs, awkward):
    check(docs, awkward)
    check(docs, [])
    check(docs, [None, "", None])


def test_missing_and_repeated_ids(docs):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "alone"), (3, "other words here")]
    got = sorted(((r.doc_id, r.component_id) for r in J.link_components(docs(rows), sketch_bits=10).collect()), key=repr)
    assert got == sorted([(None, 5), (5, 5), (5, 5), (None, None), (3, 3)], key=repr)


def test_keep_first(docs, rng):
    text = prose(rng, 50)
    kept = J.keep_first(docs([(9, text), (2, text + " end"), (4, "own"), (None, text)], extra=True), sketch_bits=10)
    assert kept.columns == docs([], extra=True).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [2, 4]  # the copy without an id goes


def test_keep_first_decides_by_row(docs, rng):
    """Equal rows leave one; of rows that share an id only the copy goes; rows without words stay."""
    text, own = prose(rng, 50), prose(rng, 50)
    alone = prose(rng, 30)
    rows = [(2, text), (2, text), (7, text), (7, own), (8, alone), (8, alone), (8, alone), (None, own), (None, own), (9, ""), (9, "")]
    kept = J.keep_first(docs(rows, extra=True), sketch_bits=10)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(2, text), (7, own), (8, alone), (9, ""), (9, "")], key=repr)
    kept = J.keep_first(docs([(None, text), (None, text + " end"), (None, text), (None, "own"), (None, None)]), sketch_bits=10)
    assert len(kept.collect()) == 3  # one of the copies, though none has an id


@pytest.mark.parametrize("text", ["a b\x0bc\x1cd", "É é A a", "x y z"])
def test_words(text):
    n = len(J.shingle_set(" ".join([text] * 3), J._WordHashes()))
    assert n == len(shingles(" ".join([text] * 3)))


def test_components_of_random_graphs(spark, rng):
    for n, m in ((30, 20), (200, 180)):
        pairs = rng.integers(0, n, (m, 2))
        label = np.arange(n)
        for _ in range(n):
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        edges = spark.createDataFrame(pairs.tolist(), "a long, b long")
        got = {r.set_id: r.root for r in J.components(edges).collect()}
        seen = set(pairs[pairs[:, 0] != pairs[:, 1]].ravel().tolist())
        assert got == {i: label[i] for i in seen}


def test_lists_keep_entries_near_in_size(spark, rng):
    """An entry stays if another set of its list could link by its size, also across batches; copies go."""
    size = {int(k): int(rng.integers(1, 200)) for k in rng.permutation(10_000)[:300]} | {-1: 10, -2: 8, -3: 7, -4: 1}
    keys = list(size)
    rows = {(t, k, size[k], t % 3) for t in range(200) for k in rng.choice(keys, int(rng.integers(1, 6)))}
    rows = {(t, int(k), n, p) for t, k, n, p in rows} | {(t, k, size[k], 0) for t, k in ((900, -1), (900, -2), (901, -2), (901, -3), (901, -4), (902, -1), (902, -3))}
    entries = spark.createDataFrame([*rows, *rows], "token long, set_id long, n int, pos int").repartition(3)
    want = sorted(r for r in rows if any(
        r[:1] == s[:1] and r[1] != s[1] and 100 * min(r[2], s[2]) >= 80 * max(r[2], s[2]) for s in rows))
    assert {r[0] for r in want} & {900, 901, 902} == {900, 901} and 0 < len(want) < len(rows)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in (old, "3", "1"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            assert sorted(map(tuple, J._lists(entries, 80).collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_keep_first_looks_components_up_once(docs, rng, monkeypatch):
    plans, stored = {}, J.stored

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(J, "stored", noted)
    text = prose(rng, 50)
    assert J.keep_first(docs([text, text + " end", "own"]), sketch_bits=10).count() == 2
    assert "LeftOuter" in plans["named"] and "LeftOuter" not in plans["fate"]
