import numpy as np
from pyspark.sql import functions as F

from roadlens.llm import language_id as N
from roadlens.llm import queries as Q


def test_held_out_accuracy(spark, sf):
    got = Q.QUERIES["op6_naive_bayes"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").filter("held_out").toPandas()
    assert len(held) > 20 and (held["lang"] == held["lang_pred"]).mean() >= 0.98
    assert got.filter("score < 0 OR score > 1").count() == 0


def brute(texts, labels, query, buckets, alpha):
    """Multinomial naive Bayes over the same hashed n-grams, text by text."""
    def hashes(text):
        out = []
        for codes, own, _, _ in N.pieces(iter([(0, text)]), 10 ** 9):
            for h in N.grams(codes, own, buckets):
                out += [x for x in h.tolist() if x < buckets]
        return out

    langs = sorted(set(labels))
    counts = np.array([np.bincount([h for t, y in zip(texts, labels, strict=True) if y == x for h in hashes(t)], minlength=buckets)
                       for x in langs])
    logs = np.log((counts + alpha) / (counts.sum(axis=1, keepdims=True) + alpha * buckets))
    prior = np.log([labels.count(x) / len(labels) for x in langs])
    total = prior + logs[:, hashes(query)].sum(axis=1)
    p = np.exp(total - total.max())
    return langs[int(total.argmax())], float((p / p.sum()).max())


def test_brute_force_and_pieces(spark, docs, monkeypatch):
    texts, labels = ["the cat and the dog", "le chat et le chien", "der hund und die katze", "the end"], ["en", "fr", "de", "en"]
    train = spark.createDataFrame(list(zip(texts, labels, strict=True)), "text string, lang string")
    model = N.train(train, buckets=1 << 10)
    queries = ["a dog", "chien", "Katze UND", "the le der" * 50]
    want = [brute(texts, labels, q, 1 << 10, N.ALPHA) for q in queries]
    for size in (10 ** 6, 7):  # whole and in pieces
        monkeypatch.setattr(N.pieces, "__defaults__", (size,))
        got = N.predict(docs(queries), model).orderBy("doc_id").collect()
        assert [r.lang_pred for r in got] == [w[0] for w in want]
        assert np.allclose([r.score for r in got], [w[1] for w in want], atol=1e-4)


def test_awkward(spark, docs, awkward):
    train = spark.createDataFrame([("some words", "en"), (None, "fr"), ("x", None), ("quelques mots", "fr")], "text string, lang string")
    model = N.train(train, buckets=1 << 12)
    df = docs(awkward, extra=True)
    got = N.predict(df, model)
    assert set(got.columns) == set(df.columns) | {"lang_pred", "score"}
    und = {r.doc_id for r in got.filter("lang_pred = 'und'").collect()}
    assert und == {0, 1, 2, 9, 10}
    assert got.filter("lang_pred = 'und' AND score != 0").count() == 0
    assert N.predict(docs([]), model).count() == 0
    nothing = N.train(train.filter(F.lit(False)))
    assert {(r.lang_pred, r.score) for r in N.predict(docs(["word"]), nothing).collect()} == {("und", 0.0)}


def test_ties_go_to_the_first_language(spark, docs):
    train = spark.createDataFrame([("abc", "zz"), ("abc", "aa")], "text string, lang string")
    got = N.predict(docs(["abc"]), N.train(train)).first()
    assert got.lang_pred == "aa" and abs(got.score - 0.5) < 1e-6


def test_one_rule_for_a_letter(spark, docs):
    """Numbers, fractions and circled digits are no letters, whatever a regular expression's word class says."""
    texts = ["the words of a text", "les mots du texte", "½ ②", "٣ Ⅷ ﬀ" , "x", "12 !", "_", None, ""]
    df = docs(texts)
    model = N.train(docs(texts[:2]).withColumn("lang", F.when(F.col("doc_id") == 0, "en").otherwise("fr")))
    got = {r.doc_id: (r.lang_pred, r.score) for r in N.predict(df, model).collect()}
    has = {r.doc_id for r in df.filter(N.has_letter(F.col("text"))).collect()}
    assert has == {0, 1, 3, 4} and {i for i, (lang, _) in got.items() if lang != "und"} == has
    assert got[2] == ("und", 0.0)


def test_a_filter_on_the_prediction_scores_once(spark, docs):
    model = N.train(docs(["the words", "other words"]))
    text = N.predict(docs(["a"]), model).filter("lang_pred != 'und'").select("doc_id", "lang_pred")._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1
