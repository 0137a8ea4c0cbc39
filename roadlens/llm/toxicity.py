"""Toxicity by class-conditional Kneser-Ney models of characters.

Texts are lower-cased, everything but letters becomes a space, and every character is predicted from the
four before it. The highest order is counted for toxic and for ordinary texts apart. What both discount
goes to one shared backoff model, Kneser-Ney continuation counts of both classes together, so an
expression that neither class knows says nothing for either. n-grams up to three characters are
counted under the characters themselves, longer ones under 64-bit hashes of them, so none share a count. The
model is gathered and broadcast: it grows with the distinct n-grams of the labelled texts, and so covers all of them.

A text's log-likelihoods under both models are compared per character over the whole text, and per
word for the ``TOP`` words that speak most for toxic, since a few expressions in a long text are
diluted otherwise and a single one may be chance. A logistic curve over these differences, none of
which grows with the text's length alone, gives the score; it is fitted on at most ``CALIBRATION``
distinct texts of each class from a held part, each class weighted back to its number of distinct texts there, scored
by counts of all other labelled texts. The model that scores then counts the held part too. If no part
can be held with both classes on both sides, the score is the logistic of ``GAP_WEIGHT`` times the mean difference per character.

Defined results: null and empty texts score as texts with all differences 0. Labels that are null or of
unknown documents teach nothing; a document labelled twice counts twice. Without labels of both classes
every score is 0. Texts are read whole. Columns besides doc_id and text (and toxic) are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import packed, sampled, stored
from roadlens.llm.language_id import _codes

ORDER = 5
SHARED = 3
CHARACTER = 21  # bits of a code point
LAST = (1 << CHARACTER) - 1
TOP = 5
CALIBRATION = 4000
GAP_WEIGHT = 50.0
BROADCAST_ROWS = 2_000_000
PIECE = 400_000
HELD_ROWS = 1_000_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per place, the keys of the ORDER characters that end there, of those before the last, and of the last SHARED.

    The last key holds its three characters, the last one lowest; the other two are hashes.
    """
    c = codes.astype(np.uint64)
    ago = [c, *[np.concatenate([np.full(k, 32, np.uint64), c])[:len(c)] for k in range(1, ORDER)]]
    bits = np.uint64(CHARACTER)
    tri = ago[0] | ago[1] << bits | ago[2] << (bits + bits)
    context = _mixed((ago[1] | ago[2] << bits | ago[3] << (bits + bits)) + _mixed(ago[4] + np.uint64(1)))
    gram = _mixed(context + ago[0] * np.uint64(0x9E3779B97F4A7C15))
    return gram.view(np.int64), context.view(np.int64), tri.view(np.int64)


class _Places:
    """Places of distinct 64-bit keys, by open addressing at a load of at most one half."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        todo, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            left = self.slots[at] != todo
            todo, at = todo[left], self._next(at[left])

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & (len(self.slots) - 1)

    def of(self, asked: np.ndarray) -> np.ndarray:
        """The place of each asked key, -1 if it is not there."""
        at = self._home(asked)
        out = self.slots[at]
        if not len(self.keys):
            return out
        todo = np.flatnonzero((out >= 0) & (self.keys[out] != asked))
        at = at[todo]
        while len(todo):
            at = self._next(at)
            out[todo] = got = self.slots[at]
            left = (got >= 0) & (self.keys[got] != asked[todo])
            todo, at = todo[left], at[left]
        return out


def _squeezed(text: str) -> np.ndarray:
    """The text's letters; runs of anything else are one space."""
    codes = _codes(text)
    space = codes == 32
    return codes[~(space & np.concatenate([[False], space[:-1]]))]


def _packed(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[np.ndarray, list[int], list[int]]]:
    """Codes of several texts together, where each begins, and whose it is; a text stays in one array."""
    codes, starts, names, total = [], [], [], 0
    for name, text in texts:
        mine = np.concatenate([np.full(ORDER, 32, np.uint32), _squeezed(text)])
        codes.append(mine)
        starts.append(total)
        names.append(name)
        total += len(mine)
        if total >= PIECE:
            yield np.concatenate(codes), starts, names
            codes, starts, names, total = [], [], [], 0
    if total:
        yield np.concatenate(codes), starts, names


GRAM = ["gram", "context", "tri"]


def _added(parts: list[pd.DataFrame]) -> pd.DataFrame:
    """The counts of several tables of n-grams together."""
    counts = pd.concat(parts, ignore_index=True).groupby("gram", sort=False)
    return pd.concat([counts[GRAM[1:]].first(), counts[["ordinary", "toxic"]].sum()], axis=1).reset_index()


def count(labelled: DataFrame) -> DataFrame:
    """text and toxic to distinct n-grams: keys of n-gram, context and shared n-gram, ordinary, toxic."""

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, n = [], 0
        for batch in batches:
            for label, texts in batch.groupby("toxic")["text"]:
                for codes, _, _ in _packed((0, t) for t in texts):
                    gram, context, tri = _keys(codes)
                    gram, at, times = np.unique(gram, return_index=True, return_counts=True)
                    none = np.zeros(len(gram), np.int64)
                    parts.append(pd.DataFrame({"gram": gram, "context": context[at], "tri": tri[at],
                                               "ordinary": none if label else times, "toxic": times if label else none}))
                    n += len(gram)
                    if n >= HELD_ROWS:
                        parts = [_added(parts)]
                        n = len(parts[0])
                        if 2 * n >= HELD_ROWS:
                            yield parts[0]
                            parts, n = [], 0
        if parts:
            yield _added(parts)

    rows = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).filter("text IS NOT NULL AND toxic IN (0, 1)")
    found = rows.mapInPandas(grams, "gram long, context long, tri long, ordinary long, toxic long")
    return found.groupBy(*GRAM).agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _gathered(grams: DataFrame) -> pd.DataFrame:
    """The table of n-grams, 40 bytes a row, as Arrow columns rather than rows."""
    return grams.toArrow().to_pandas()


def _sums(keys: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(keys, weights=values, minlength=size)


def _discount(counts: np.ndarray) -> float:
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return float(min(max(once / (once + 2 * twice), 0.1), 0.9)) if once else 0.5


def fit(grams: DataFrame | pd.DataFrame) -> dict:
    """The model: places and log-likelihoods of known n-grams (ordinary, toxic), of falling back from a
    context, and of the shared model."""
    g = grams if isinstance(grams, pd.DataFrame) else _gathered(grams)
    # Shared model: continuation counts over distinct n-grams, trigram to unigram to uniform.
    tris, tri = np.unique(g["tri"].to_numpy(), return_inverse=True)
    pairs, pair = np.unique(tris >> CHARACTER, return_inverse=True)
    last = tris & LAST
    uni = np.bincount(last, minlength=LAST + 1) + 2.0 ** 15 / (LAST + 1)
    uni = uni / uni.sum()
    n = np.bincount(tri, minlength=len(tris))
    d = _discount(n)
    total, kinds = _sums(pair, n, len(pairs)), _sums(pair, np.ones(len(tris)), len(pairs))
    fall = d * kinds / np.maximum(total, 1)
    shared = np.maximum(n - d, 0) / np.maximum(total[pair], 1) + fall[pair] * uni[last]
    contexts, context = np.unique(g["context"].to_numpy(), return_inverse=True)
    model = {"grams": _Places(g["gram"].to_numpy()), "contexts": _Places(contexts), "tris": _Places(tris), "pairs": _Places(pairs),
             "shared": _log(shared), "fall": _log(fall), "uni": _log(uni)}
    both = {"ordinary": g["ordinary"].to_numpy().astype(float), "toxic": g["toxic"].to_numpy().astype(float)}

    def smoothed(n: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the known n-grams, and the weight of falling back by context."""
        d = _discount(n)
        total, kinds = _sums(context, n, len(contexts)), _sums(context, n > 0, len(contexts))
        weight = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        return np.maximum(n - d, 0) / np.maximum(total[context], 1) + weight[context] * back, weight

    pooled, pooled_weight = smoothed(both["ordinary"] + both["toxic"], shared[tri])
    for name, n in both.items():
        known, weight = smoothed(n, pooled)
        model[name], model[f"{name}_back"] = _log(known), _log(weight * pooled_weight)
    return model


def _log(p: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p, 1e-30)).astype(np.float32)


def likelihoods(codes: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Per place, the log-likelihood of its character under the ordinary and the toxic model."""
    gram, context, tri = _keys(codes)
    gram = model["grams"].of(gram)
    new = np.flatnonzero(gram < 0)
    context, tri = model["contexts"].of(context[new]), tri[new]
    pair, shared = model["pairs"].of(tri >> CHARACTER), model["tris"].of(tri)
    low = _looked_up(model["fall"], pair) + model["uni"][tri & LAST]
    low = np.where(shared < 0, low, _looked_up(model["shared"], shared))
    out = []
    for name in ("ordinary", "toxic"):
        found = _looked_up(model[name], gram)
        found[new] = _looked_up(model[f"{name}_back"], context) + low
        out.append(found)
    return out[0], out[1]


def _looked_up(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The logarithms at known places, 0 at unknown ones."""
    return np.where(at < 0, np.float32(0), values[at]) if len(values) else np.zeros(len(at), np.float32)


COMPARED = ("mean_gap", *[f"word_{i}" for i in range(1, TOP + 1)])
FEATURES = ("ordinary_ll", "toxic_ll", *COMPARED)


def _features(texts: list[str | None], model: dict) -> np.ndarray:
    out = np.zeros((len(texts), len(FEATURES)))
    for codes, starts, names in _packed((i, t) for i, t in enumerate(texts) if t):
        ordinary, toxic = likelihoods(codes, model)
        gap = (toxic - ordinary).astype(np.float64)
        ends = [*starts[1:], len(codes)]
        for a, b, name in zip(starts, ends, names, strict=True):
            a += ORDER
            if b <= a:
                continue
            mine = gap[a:b]
            begins = np.flatnonzero(codes[a:b] == 32)  # a word with the space before it
            words = np.add.reduceat(mine, begins) if len(begins) else mine[:1]
            top = np.sort(words if len(words) <= TOP else np.partition(words, -TOP)[-TOP:])[::-1]
            out[name, :3] = ordinary[a:b].mean(dtype=np.float64), toxic[a:b].mean(dtype=np.float64), mine.mean()
            out[name, 3:3 + len(top)] = top
    return out


def features(docs: DataFrame, model: dict) -> DataFrame:
    """Adds the struct ``found`` of length-normalised log-likelihoods and their differences."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(", ".join(f"{c} double" for c in FEATURES))
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(_features(batch.tolist(), shared.value), columns=list(FEATURES))

    return docs.withColumn("found", measure("text"))


def _logistic(x: np.ndarray, y: np.ndarray, each: np.ndarray, penalty: float = 1e-2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method on rows that count ``each`` times; returns weights (the first is the bias), means and scales."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (each * p * (1 - p))[:, None]).T @ z + penalty * np.eye(len(w)), z.T @ (each * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def with_labels(docs: DataFrame, labels: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, text and toxic of the labelled documents.

    Up to ``broadcast_rows`` labels (of 16 bytes) are broadcast; with more, both sides are shuffled.
    """
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)")
    side = F.broadcast(labels) if labels.count() <= broadcast_rows else labels
    return docs.select("doc_id", "text").filter("text IS NOT NULL").join(side, "doc_id")


def _drawn(held: DataFrame, n: int) -> DataFrame:
    """Of the text and toxic of ``held``, at most ``n`` distinct texts a class, and in ``each`` how many one stands for."""
    rows = held.withColumn("_hash", F.xxhash64("text"))
    keys = stored(rows.select("_hash", "toxic").distinct(), "held")
    few = [sampled(keys.filter(F.col("toxic") == r["toxic"]), n, "_hash").withColumn("each", F.lit(max(1.0, r["count"] / n)))
           for r in keys.groupBy("toxic").count().collect()]
    if not few:
        return held.withColumn("each", F.lit(1.0))
    return rows.join(F.broadcast(reduce(DataFrame.unionByName, few)), ["_hash", "toxic"]).dropDuplicates(["_hash", "toxic"]).drop("_hash")


def train(labelled: DataFrame, calibration: int = CALIBRATION) -> tuple[dict, tuple | None]:
    """From text, toxic and a number ``part``: counts on all rows, and a curve fitted on part 0 against the counts of the others.

    If part 0 or the others lack a class, the curve is fitted on the smallest other part for which neither side does.
    """
    rows = labelled.filter("text IS NOT NULL AND toxic IN (0, 1)").select("text", F.col("toxic").cast("int").alias("toxic"), "part")
    both = lambda counts: counts["ordinary"].any() and counts["toxic"].any()
    others, own = (_gathered(count(rows.filter(c))) for c in ("NOT (part <=> 0)", "part = 0"))
    whole, part = _added([others, own]), 0
    if not both(whole):
        return fit(whole), None
    if not (both(others) and both(own)):
        by = rows.groupBy("part").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
        all_toxic, n = by.agg(F.sum("toxic"), F.sum("n")).first()
        part = by.filter(F.col("toxic").between(1, all_toxic - 1) & (F.col("n") - F.col("toxic")).between(1, n - all_toxic - 1)).agg(F.min("part")).first()[0]
        if part is None:  # the tiny bias leaves a text without any difference below one half
            k = len(COMPARED)
            return fit(whole), (np.array([-1e-6, GAP_WEIGHT, *[0.0] * (k - 1)]), np.zeros(k), np.ones(k))
        others = _gathered(count(rows.filter(~F.col("part").eqNullSafe(F.lit(part)))))
    held = rows.filter(F.col("part") == part).select("text", "toxic")
    x = features(_drawn(held, calibration), fit(others)).select("found.*", "toxic", "each").toPandas()
    y, each = x.pop("toxic").to_numpy().astype(float), x.pop("each").to_numpy()
    return fit(whole), _logistic(x[list(COMPARED)].to_numpy(), y, each)


def score(docs: DataFrame, model: dict, curve: tuple | None) -> DataFrame:
    """``docs`` with ordinary_ll and toxic_ll (per character), score and predicted in place of columns of these names."""
    alone, rest = packed(docs, "text")
    measured = features(alone, model)
    if curve is None:
        value = F.lit(0.0)
    else:
        w, mean, scale = curve
        linear = F.lit(float(w[0]))
        for name, weight, m, s in zip(COMPARED, w[1:], mean, scale, strict=True):
            linear = linear + (F.col("found")[name] - float(m)) * float(weight / s)
        value = 1 / (1 + F.exp(-linear))
    made = {"ordinary_ll": F.col("found.ordinary_ll"), "toxic_ll": F.col("found.toxic_ll"), "score": value,
            "predicted": (value >= 0.5).cast("int")}
    return measured.select(*[rest[c] for c in rest if c not in made], *[v.alias(c) for c, v in made.items()])
