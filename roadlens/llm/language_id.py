"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and all 1- to 3-grams of characters
are hashed to a fixed number of buckets. Training counts them over every labelled row: each task
adds up its counts per language, Spark sums those by language and bucket. What is broadcast is one
matrix of ``BUCKETS`` + 1 rows and a column per language, however large the corpus is. Scoring gathers
that matrix for a few hundred thousand characters at a time and sums the rows by document.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if
no language was learned. Ties go to the first language in string order. Rows with a null language
or text teach nothing. Repeated rows each count. Long texts are read whole, in pieces. Only the
columns named are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import give_back, packed

BUCKETS = 1 << 18
ORDERS = (1, 2, 3)
ALPHA = 0.5
PIECE = 250_000
_PAD = max(ORDERS) - 1


def has_letter(text: Column) -> Column:
    """Whether a text has a letter; the one rule for what has no language."""
    return text.rlike(r"\p{L}")


@functools.cache
def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter, else a space."""
    codes = np.arange(0x110000, dtype=np.uint32)
    alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(alpha, codes, np.uint32(32))


def _codes(text: str) -> np.ndarray:
    raw = f" {text.lower()} ".encode("utf-32-le", "replace")
    return _letters()[np.frombuffer(raw, np.uint32)]


def pieces(texts: Iterator[tuple[int, str]], size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, list, list]]:
    """Texts cut and packed into arrays of about ``size`` code points.

    Yields the codes, which places begin an n-gram of their own, where each piece begins and whose
    it is. A piece carries the next characters along, so no n-gram is lost or counted twice.
    """
    codes, own, starts, names, total = [], [], [], [], 0
    for name, text in texts:
        whole = _codes(text)
        for a in range(0, len(whole), size):
            part = whole[a:a + size + _PAD]
            n = min(size, len(whole) - a)
            codes += [part, np.zeros(_PAD, np.uint32)]
            mine = np.zeros(len(part) + _PAD, bool)
            mine[:n] = True
            own.append(mine)
            starts.append(total)
            names.append(name)
            total += len(mine)
            if total >= size:
                yield np.concatenate(codes), np.concatenate(own), starts, names
                codes, own, starts, names, total = [], [], [], [], 0
    if total:
        yield np.concatenate(codes), np.concatenate(own), starts, names


def grams(codes: np.ndarray, own: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """Per order, the bucket of the n-gram at each place; ``buckets`` where there is none."""
    mixed = np.zeros(len(codes), np.uint32)
    there = own.copy()
    for n in range(1, max(ORDERS) + 1):
        shifted = codes[n - 1:]
        mixed[:len(shifted)] = (mixed[:len(shifted)] + shifted) * np.uint32(0x9E3779B1)
        there[:len(shifted)] &= shifted > 0
        there[len(shifted):] = False
        if n in ORDERS:
            h = ((mixed ^ (mixed >> np.uint32(15))) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
            yield np.where(there, (h >> np.uint32(8)) % np.uint32(buckets), np.uint32(buckets))


def train(labelled: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA,
          text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-probabilities (bucket by language, the last row 0) and log-priors."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                mine = sums.setdefault(name, np.zeros(buckets + 1, np.int64))
                docs[name] = docs.get(name, 0) + len(texts)
                for codes, own, _, _ in pieces((0, t) for t in texts):
                    for h in grams(codes, own, buckets):
                        mine += np.bincount(h, minlength=buckets + 1)
        for name, mine in sums.items():
            mine[buckets] = docs[name]  # the place of "none" holds the number of documents
            at = np.flatnonzero(mine)
            yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": mine[at]})

    counted = (rows.mapInPandas(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counted["lang"].unique())
    matrix = np.zeros((buckets + 1, len(langs)), np.int64)
    matrix[counted["bucket"], counted["lang"].map({x: i for i, x in enumerate(langs)}).astype(int)] = counted["n"]
    docs = matrix[buckets].astype(float)
    matrix[buckets] = 0
    logs = np.log((matrix + alpha) / (matrix.sum(axis=0) + alpha * buckets))
    logs[buckets] = 0
    return langs, logs.astype(np.float32), np.log(docs / docs.sum()) if langs else docs


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior probability of that language.

    Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # Told to be nondeterministic, so that a filter on the prediction does not make Spark score every text twice.
    @F.pandas_udf("lang_pred string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, logs, prior = shared.value
        buckets = len(logs) - 1
        for texts in batches:
            totals = np.zeros((len(texts), len(langs))) + prior
            some = [(i, t) for i, t in enumerate(texts) if t] if langs else []
            for codes, own, starts, names in pieces(iter(some)):
                sums = np.zeros((len(codes), len(langs)), np.float32)
                for h in grams(codes, own, buckets):
                    sums += logs[h]
                np.add.at(totals, names, np.add.reduceat(sums, starts, axis=0, dtype=np.float64))
            out = pd.DataFrame({"lang_pred": "und", "score": 0.0}, index=range(len(texts)))
            if some:
                rows = [i for i, _ in some]
                mine = totals[rows]
                best = mine.argmax(axis=1)
                share = np.exp(mine - mine.max(axis=1, keepdims=True))
                out.loc[rows, "lang_pred"] = [langs[b] for b in best]
                out.loc[rows, "score"] = 1 / share.sum(axis=1)
            yield out
            give_back()

    alone, rest = packed(docs, text)
    kept = [rest[c] for c in rest if c not in ("lang_pred", "score")]
    asked = F.when(has_letter(F.col(f"`{text}`")), F.col(f"`{text}`"))
    return alone.withColumn("_found", scored.asNondeterministic()(asked)).select(*kept, "_found.*")
