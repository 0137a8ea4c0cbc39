import numpy as np

from roadlens.llm import queries as Q
from roadlens.llm import toxicity as X
from llm_helpers import prose


def labelled(spark, rng, n):
    rows = []
    for i in range(n):
        words = prose(rng, int(rng.integers(20, 120))).split()
        toxic = int(rng.random() < 0.3)
        for _ in range(4 * toxic):
            words.insert(int(rng.integers(len(words))), str(rng.choice(["zwart", "qwob", "grunzel"])))
        rows.append((i, " ".join(words), toxic, i % 4))
    return rows


def test_held_out_accuracy(spark, rng):
    rows = labelled(spark, rng, 400)
    model, curve = X.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int, part int"))
    fresh = labelled(spark, rng, 200)
    got = X.score(spark.createDataFrame(fresh, "doc_id long, text string, toxic int, part int"), model, curve).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert np.mean([r.predicted == r.toxic for r in got]) >= 0.95


def test_query(spark, sf):
    got = Q.QUERIES["op2_kneser_ney"](spark, sf).toPandas()
    assert len(got) == 200 and got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == got["predicted"]).all()


def test_smoothed_probabilities_add_up(spark, rng):
    """Over all characters, the probabilities after one context add up to about one (hashes collide a little)."""
    rows = [(prose(rng, 60), int(i % 3 == 0)) for i in range(30)]
    model = X.fit(X.count(spark.createDataFrame(rows, "text string, toxic int")))
    letters = sorted({c for t, _ in rows for c in t})
    for context in ("ka l", " lom", "ti k"):
        codes = [np.array([ord(x) for x in context + c], np.uint32) for c in letters]
        ordinary, toxic = zip(*[[float(v[-1]) for v in X.likelihoods(c, model)] for c in codes], strict=True)
        for side in (ordinary, toxic):
            assert 0.9 <= np.exp(side).sum() <= 1.02


def test_unknown_expressions_say_next_to_nothing(spark, rng):
    rows = [(prose(rng, 60), int(i % 2 == 0)) for i in range(40)]
    model = X.fit(X.count(spark.createDataFrame(rows, "text string, toxic int")))
    ordinary, toxic = X.likelihoods(np.array([ord(c) for c in "     zzqqwwyy"], np.uint32), model)
    assert np.abs(ordinary - toxic)[8:].max() < 1e-6


def test_awkward(spark, docs, awkward, rng):
    rows = [(i, t, y, p) for i, t, y, p in labelled(spark, rng, 80)] + [(None, None, 1, 1), (900, "x", None, 0), (901, None, 0, 0), (902, "", 1, 0)]
    model, curve = X.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int, part int"))
    df = docs(awkward, extra=True)
    got = X.score(df, model, curve)
    assert set(got.columns) == set(df.columns) | {"score", "predicted", "ordinary_ll", "toxic_ll"}
    scores = {r.doc_id: r.score for r in got.collect()}
    assert len(scores) == len(awkward) and all(0 <= s <= 1 for s in scores.values())
    assert scores[0] == scores[1] and scores[4] == scores[5]
    assert X.score(docs([]), model, curve).count() == 0


def test_no_labels(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, text string, toxic int, part int")
    assert [r.score for r in X.score(docs(["a", None]), *X.train(empty)).collect()] == [0.0, 0.0]


def test_labels_are_joined_either_way(spark, docs):
    df = docs([(1, "a"), (1, "a"), (2, "b"), (3, None), (None, "c")], extra=True)
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (None, 1), (7, 1), (1, 1), (2, 5)], "doc_id long, toxic int")
    for rows in (0, 100):
        got = sorted(tuple(r) for r in X.with_labels(df, labels, rows).collect())
        assert got == [(1, "a", 1)] * 4


def test_held_part_is_counted(spark, rng):
    """An expression that only the held part has is known to the model that scores."""
    rows = labelled(spark, rng, 400) + [(1000 + i, prose(rng, 40) + " vrimbax" * 3, 1, 0) for i in range(20)]
    schema = "doc_id long, text string, toxic int, part int"
    model, curve = X.train(spark.createDataFrame(rows, schema))
    whole = X.fit(X.count(spark.createDataFrame(rows, schema)))
    codes = np.array([ord(c) for c in "     vrimbax"], np.uint32)
    ordinary, toxic = X.likelihoods(codes, model)
    assert toxic[9:].min() > -1 and (toxic - ordinary)[5:].sum() > 0
    assert all(np.allclose(a, b, atol=0.05) for a, b in zip(X.likelihoods(codes, whole), (ordinary, toxic), strict=True))


def test_curve_is_drawn_by_class(spark, rng):
    """A few toxic texts beside many ordinary ones, and one text in many copies, are still in the curve's sample."""
    rows = [r for r in labelled(spark, rng, 500) if r[3] != 0 or not r[2]]
    toxic = [prose(rng, 40) + " zwart qwob grunzel" * 2 for _ in range(3)]
    held = [(1000 + i, "the same ordinary text", 0, 0) for i in range(300)] + [(2000 + i, t, 1, 0) for i, t in enumerate(toxic)]
    df = spark.createDataFrame(rows + held, "doc_id long, text string, toxic int, part int")
    drawn = X._drawn(df.filter("part = 0").select("text", "toxic"), 10).collect()
    assert {r.text for r in drawn if r.toxic} == set(toxic) and len({r.text for r in drawn if not r.toxic}) == 10 == len(drawn) - 3
    ordinary = {r[1] for r in rows + held if r[3] == 0 and not r[2]}
    assert np.isclose(sum(r.each for r in drawn if not r.toxic), len(ordinary))


def test_held_part_without_toxic_texts(spark, rng):
    rows = [r for r in labelled(spark, rng, 300) if r[3] != 0 or not r[2]]
    trained = X.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int, part int"))
    fresh = labelled(spark, rng, 100)
    got = X.score(spark.createDataFrame(fresh, "doc_id long, text string, toxic int, part int"), *trained).collect()
    assert np.mean([r.predicted == r.toxic for r in got]) >= 0.9


def test_one_toxic_text(spark, docs, rng):
    """No part can be held: the mean difference decides, and a text without any is not toxic."""
    rows = [(i, prose(rng, 40), 0, i % 4) for i in range(40)] + [(99, "zwart qwob grunzel " * 5, 1, 0)]
    trained = X.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int, part int"))
    got = {r.doc_id: r for r in X.score(docs([rows[-1][1], rows[0][1], None]), *trained).collect()}
    assert got[0].score > 0.5 > got[2].score > 0 and got[0].score > got[1].score > 0


def test_ngrams_of_many_alphabets_keep_their_own_counts(spark, rng):
    """More distinct n-grams than any small table of buckets holds; one character is beyond 16 bits."""
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9F00, 20_000))) + chr(0x20000 + i) for i in range(25)]
    grams = X.count(spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "text string, toxic int")).toPandas()
    codes = [np.concatenate([np.full(X.ORDER, 32), X._squeezed(t)]) for t in texts]
    want = {tuple(c[max(i - 4, 0):i + 1]) for c in codes for i in range(5, len(c))}
    assert abs(len(grams) - len(want)) <= 10 * len(texts)  # and those of the padding
    assert (grams["ordinary"] + grams["toxic"]).sum() == sum(map(len, codes))
    model = X.fit(grams)
    assert (model["grams"].of(grams["gram"].to_numpy()) == np.arange(len(grams))).all()
    assert (model["grams"].of(rng.integers(-2 ** 62, 2 ** 62, 10_000)) == -1).all()
