import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import lm_trie as L
from roadlens.llm import queries as Q

D = (0.6, 1.1, 1.4)


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</end>"]


def plain(texts, learned, d=D):
    """n_tokens, n_known, N, base and score of each text, from dictionaries."""
    c1, c2, c3 = Counter(), Counter(), Counter()
    for text in (t for t, x in zip(texts, learned, strict=True) if x):
        w = ["<", "<", *split(text)]
        c1.update(w[2:])
        c2.update(zip(w[1:], w[2:]))  # noqa: B905
        c3.update(zip(w, w[1:], w[2:]))  # noqa: B905
    sums = {}
    for key, n in [*c2.items(), *c3.items()]:
        mine = sums.setdefault(key[:-1], [0, 0.0])
        mine[0] += n
        mine[1] += d[min(n, 3) - 1]
    whole = sum(c1.values()) + 0.5 * (len(c1) + 1)

    def p(context, w):
        if not context:
            return (c1[w] + 0.5) / whole
        n = (c2 if len(context) == 1 else c3)[(*context, w)]
        total, off = sums.get(context, (0, 0))
        below = p(context[1:], w)
        return below if not total else ((n - d[min(n, 3) - 1] if n else 0) + off * below) / total

    out = []
    for text in texts:
        w = ["<", "<", *split(text)]
        base = sum(math.log10(p((), x)) for x in w[2:])
        score = sum(math.log10(p((a, b), x)) for a, b, x in zip(w, w[1:], w[2:]))  # noqa: B905
        out.append((len(w) - 2, sum(c1[x] > 0 for x in w[2:]), sum(c1.values()), base, score))
    return out


def check(df, ids, want, by_token=2e-3):
    got = {}
    for r in df.collect():
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]))
    expected = {}
    for i, w in zip(ids, want, strict=True):
        expected.setdefault(i, []).append(w)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in expected.items()}
    for i, mine in expected.items():
        for a, b in zip(sorted(got[i]), sorted(mine), strict=True):
            assert a[:3] == b[:3]
            assert a[3] == pytest.approx(b[3], rel=1e-9) and abs(a[4] - b[4]) <= by_token * b[0]


def prose_table(rng, n):
    words = [f"W{i}" for i in range(40)]
    return [" ".join(words[min(int(rng.exponential(8)), 39)] for _ in range(int(rng.integers(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize(("shard_bytes", "block_tokens"), [(10**9, 10**9), (500, 100)])
def test_scores_against_dictionaries(spark, docs, rng, shard_bytes, block_tokens):
    """Shards, blocks and copies change nothing; the one difference is the quantisation."""
    texts = prose_table(rng, 120)
    texts += [texts[3]] * 40 + ["Hot pair " * 50] * 10 + [None, "", " \n", "unseen words only"]
    learned = [i % 4 != 1 for i in range(len(texts))]
    df = L.score(docs(texts, extra=True), F.col("doc_id") % 4 != 1, shard_bytes=shard_bytes, sample=0, block_tokens=block_tokens, fixed_discounts=D)
    check(df, range(len(texts)), plain(texts, learned))


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = Q.QUERIES["op13_elias_fano"](spark, sf).collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in rows}
    assert {r["doc_id"]: r["held_out"] for r in out} == held
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    want = {r["doc_id"]: w for r, w in zip(rows, plain([r["text"] for r in rows], [not held[r["doc_id"]] for r in rows]), strict=True)}
    for r in out:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][3], rel=1e-9)
    better = [sum(r["score"] for r in out if r["held_out"] == h) - sum(r["base_score"] for r in out if r["held_out"] == h) for h in (False, True)]
    assert better[0] > 0 and better[1] > 0  # contexts help, also on texts that were not learned


def trained(rng, hot=()):
    """A shard's trie over random tokens, with the tokens' hashes."""
    hashes = np.sort(rng.integers(1 << 62, size=30, dtype=np.int64).astype(np.uint64))
    tokens = np.minimum(rng.exponential(6, 3000).astype(np.int64), 29)
    lengths = np.full(100, 30, np.int64)
    split = (hashes[:len(hot)], np.array(hot, np.uint64))
    hv, wu = L.trigrams(hashes, tokens, lengths, split)
    a, b, back, _ = L.distinct(hv, wu)
    return hashes, tokens, split, L.Trie.mapped(L.Trie.build(a, b, np.bincount(back)))


@pytest.mark.parametrize("hot", [(), (3, 2)])
def test_probabilities_sum_to_one(rng, hot):
    hashes, tokens, split, trie = trained(rng, hot)
    p1 = np.bincount(tokens, minlength=30) / len(tokens)
    for u, v in [(0, 1), (3, 0), (29, 29), (5, 2)]:
        text = np.array([x for w in range(30) for x in (u, v, w)])
        hv, wu = L.trigrams(hashes, text, np.full(30, 3, np.int64), split)
        a, b, back, _ = L.distinct(hv, wu)
        alpha, beta = trie.query(a, b)
        third = np.arange(2, 90, 3)
        assert (alpha[back[third]] + beta[back[third]] * p1).sum() == pytest.approx(1, abs=2e-3)


def test_sequences(rng):
    for n, top in [(0, 1), (1, 1), (1, 1 << 63), (20_000, 1 << 62), (20_000, 25_000), (20_000, 1 << 20), (9000, 9000)]:
        keys = np.unique(rng.integers(0, top, n, dtype=np.uint64)) if n < top else np.arange(n, dtype=np.uint64)
        s = L.Sequence.of(keys)
        assert (s.keys() == keys).all() and (s.find(keys) == np.arange(len(keys))).all()
        others = np.setdiff1d(rng.integers(0, 1 << 63, 500, dtype=np.uint64), keys)
        assert (s.find(others) == -1).all()
    flat = np.repeat(np.arange(50, dtype=np.uint64), 400)
    assert (L.Sequence.of(flat).keys() == flat).all()


def test_awkward(spark, docs, awkward):
    texts = awkward + [(None, "no id"), (3, "again an id")]
    pairs = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    learned = [i is not None and i % 2 == 0 for i, _ in pairs]
    df = L.score(docs(texts, extra=True), F.col("doc_id") % 2 == 0, fixed_discounts=D)
    check(df, [i for i, _ in pairs], plain([t for _, t in pairs], learned))
    assert L.score(docs([]), F.lit(True)).count() == 0
    nothing = L.score(docs(["a b", ""]), F.lit(False)).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in nothing] == [(0, 0)] * 2 and all(r["score"] == r["base_score"] for r in nothing)


def test_hot_words_are_split_and_levels_are_files(spark, docs, rng):
    texts = prose_table(rng, 200)
    df = docs(texts)
    _, _, hot = L._plan(df.withColumn("learned", F.lit(True)), 500, 2000)
    assert len(hot[0]) and (hot[1] >= 2).all()
    rows = L.tries(df, F.col("doc_id") % 2 == 0, shard_bytes=500).collect()
    found = [L.Trie(bytes(r["levels"])) for r in rows]
    assert sum(t.tri.n for t in found) == len({x for i, t in enumerate(texts) if i % 2 == 0 for w in [["<", "<", *split(t)]] for x in zip(w, w[1:], w[2:])})  # noqa: B905
    out = L.score(df, F.lit(True), shard_bytes=500).collect()
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_shards_and_parts_do_not_change_scores(spark, docs, rng):
    """Discounts come from all counts and a split word's pairs are counted whole: the layout decides nothing."""
    texts = prose_table(rng, 200) + ["Hot pair " * 50] * 10 + [None, ""]
    df = docs(texts)
    learned = F.col("doc_id") % 4 != 1
    _, _, hot = L._plan(df.withColumn("learned", learned), 500, 2000)
    assert len(hot[0])
    one = sorted(L.score(df, learned).collect())
    assert sorted(L.score(df, learned, shard_bytes=500, block_tokens=300).collect()) == one
    assert sorted(L.score(df, learned, shard_bytes=4000, sample=0).collect()) == one


@pytest.mark.parametrize("n", [1, 8, 9, 3000])
def test_cells_keep_their_trigrams(rng, n):
    hv = rng.integers(0, 20, n).astype(np.uint64) << np.uint64(50)
    wu = rng.integers(0, 9, n).astype(np.uint64) << np.uint64(60) | rng.integers(0, 1 << 32, n).astype(np.uint64)
    hv, wu, _, _ = L.distinct(hv, wu)
    back = L._cell(*L._head_and_body(hv, wu))
    assert (back[0] == hv).all() and (back[1] == wu).all()


def test_words_that_a_trie_takes_for_one_share_a_part(rng):
    """Only 32 bits of the word before are kept, so those alone choose the part of a split word."""
    upper = np.uint64(12345) << np.uint64(32)
    hashes = np.array([L.END, 777, 888, *(upper + np.arange(1, 60, dtype=np.uint64))], np.uint64)
    tokens = np.array([x for i in range(59) for x in (i + 3, 1, 2)])
    hv, wu = L.trigrams(hashes, tokens, np.full(59, 3), (np.array([777], np.uint64), np.array([64], np.uint64)))
    assert len(set(zip(hv[2::3].tolist(), wu[2::3].tolist()))) == 1  # noqa: B905
