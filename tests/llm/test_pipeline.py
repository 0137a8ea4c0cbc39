from pyspark.sql import functions as F

import corpus_pipeline as C
from roadlens.llm.common import stored
from llm_helpers import prose
from test_decontaminate import brute as contaminated
from test_jaccard import brute as linked
from test_line_templates import brute as deduped

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, docs, rng, tmp_path):
    items = [(i, prose(rng, 25)) for i in range(5)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = ["\n".join(prose(rng, int(rng.integers(6, 40))) for _ in range(int(rng.integers(1, 5)))) for _ in range(60)]
    texts += texts[:5] + [t + " tail" for t in texts[5:10]] + [f"{prose(rng, 20)} {items[2][1]} {prose(rng, 9)}", None, "", "12 !!", texts[0] + "\nown line"]
    df = stored(docs(texts), "docs")

    df = stored(C.language(spark, df, str(tmp_path)), "a")
    rows = {r.doc_id: r.text for r in df.collect()}
    assert df.columns == COLUMNS and set(rows) == {i for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)}

    ids = sorted(rows)
    want = {i: t for i, (t, n) in zip(ids, deduped([rows[i] for i in ids]), strict=True) if not n or t.strip()}
    df = stored(C.lines(spark, df, str(tmp_path)), "b")
    rows = {r.doc_id: r.text for r in df.collect()}
    assert df.columns == COLUMNS and rows == want
    assert all(r.n_chars == len(r.text) for r in df.collect())

    ids = sorted(rows)
    want = [ids[i] for i, _, c in linked([rows[i] for i in ids]) if i == c]
    df = stored(C.near_duplicates(spark, df, str(tmp_path)), "c")
    assert df.columns == COLUMNS and sorted(r.doc_id for r in df.collect()) == want

    kept = [i for i, (_, n, _, _) in zip(want, contaminated([rows[i] for i in want], items), strict=True) if n == 0]
    df = stored(C.benchmark(spark, df, str(tmp_path)), "d")
    assert df.columns == COLUMNS and sorted(r.doc_id for r in df.collect()) == kept
    assert len(kept) < len(want) < len(ids)

    done = C.tokens(spark, df, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in done) == kept and all(len(r.ids) == 4 * r.n_tokens for r in done)


def test_run_is_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in C.STAGES:
        docs = stored(stage(spark, docs, sf), name)
    assert sorted(C.run(spark, sf).drop("ids").collect()) == sorted(docs.drop("ids").collect())


def test_empty_and_awkward(spark, docs, awkward, sf):
    for df in (docs([]), docs(awkward, extra=True), docs([(None, None), (1, "a"), (1, "a")])):
        for name, stage in C.STAGES[:-1]:
            out = stored(stage(spark, df, sf), name)
            assert out.columns == df.columns
            df = out
        assert C.tokens(spark, df, sf).count() == df.count()


def test_without_known_languages(spark, docs, sf):
    df = docs(["text", "12", None]).withColumn("lang", F.lit(None).cast("string"))
    assert [r.doc_id for r in C.language(spark, df, sf).collect()] == [0]


def test_short_lines_are_dropped(spark, docs, sf):
    got = {r.doc_id: r.text for r in C.lines(spark, docs(["one\nAll rights reserved.", "two\nAll rights reserved."]), sf).collect()}
    assert got == {0: "one\nAll rights reserved.", 1: "two"}
