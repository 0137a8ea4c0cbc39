"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's 5-grams of words are hashed. In every window of 10 words there are six of them, and the
window's fingerprint is the smallest. Equal windows have equal fingerprints, so every shared span
of 10 words or more is found, while only about two positions in five are sent to the join. A hit
is then extended to the six windows that may share its fingerprint, and those are compared word
by word, so a hash never decides.

Items shorter than a window are one window each. Their lengths (at most nine) are looked up, and for
each length that occurs the documents' windows of that length take part as well.

Defined results: a null or empty text has no words and is not contaminated. Every input row of
``docs`` gives one result row, repeated rows and null ids too. Items without words are never found;
repeated items are all reported. Columns besides the named ones are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import lower_az, packed, stored

#: Characters between words: all of ASCII but digits and letters (A-Z count as letters once lowered).
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
#: Fingerprints of 8 bytes that are broadcast at most; with more, both sides are shuffled.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """The words of a text as it is written; compare them with ``lower_az``."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def _hashed(name: str, n: int, i: Column) -> Column:
    return F.xxhash64(*[F.get(F.col(name), i + j) for j in range(n)])


def _up_to(last: Column) -> Column:
    """0, 1, ... last; empty if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _with_minima(df: DataFrame, window: int, gram: int) -> DataFrame:
    """Adds ``_min``: the fingerprint of each window of ``_words``.

    Hashes are of lower-cased words, which only joins more candidates than A-Z alone.
    """
    span = window - gram + 1
    return (df.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(F.lower(w))))
            .withColumn("_n", F.size("_words"))
            .withColumn("_g", F.when(F.col("_n") >= window, F.transform(
                _up_to(F.col("_n") - gram), lambda i: _hashed("_h", gram, i)))
                .otherwise(F.array().cast("array<bigint>")))
            .withColumn("_min", F.transform(
                _up_to(F.col("_n") - window),
                lambda i: F.least(*[F.get(F.col("_g"), i + j) for j in range(span)]))))


def _window_text(start: Column, n: Column) -> Column:
    return F.array_join(F.transform(F.slice("_words", start + 1, n), lower_az), " ")


def _looked_up(df: DataFrame, window: int, gram: int, lengths: list[int]) -> DataFrame:
    """One row per kept fingerprint: ``_len``, ``_start``, ``_fp``; and one with start -1 per row of ``df``."""
    span = window - gram + 1
    new = F.filter(_up_to(F.col("_n") - window),
                   lambda i: (i % span == 0) | (F.get(F.col("_min"), i) != F.get(F.col("_min"), i - 1)))
    at = "array<struct<_len:int,_start:int>>"
    with_length = lambda n: lambda i: F.struct(F.lit(n), i)
    parts = [F.array(F.struct(F.lit(0), F.lit(-1))).cast(at), F.transform(new, with_length(window)).cast(at)]
    parts += [F.transform(_up_to(F.col("_n") - n), with_length(n)).cast(at) for n in lengths]
    minima = F.get(F.col("_min"), F.col("_start"))
    fp = reduce(lambda rest, n: F.when(F.col("_len") == n, _hashed("_h", n, F.col("_start"))).otherwise(rest),
                lengths, F.when(F.col("_start") >= 0, minima))
    return df.withColumn("_at", F.explode(F.concat(*parts))).select("*", "_at.*").withColumn("_fp", fp)


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM,
         text: str = "text", item_id: str = "item_id",
         broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Exact hits of item windows in documents.

    Returns two frames. The first has, for each row of ``docs`` (numbered ``_row``), a row with
    ``start`` -1 and the row's ``n_words``, and a row for each hit window with ``start``, ``length``
    (in words) and ``window``. The second has ``window`` and ``item_id``.
    """
    items = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("_words"))
    items = items.withColumn("_n", F.size("_words")).filter("_n > 0")
    lengths = sorted(r[0] for r in items.filter(F.col("_n") < window).select("_n").distinct().collect())
    inside = (items.withColumn("_start", F.explode(_up_to(F.greatest(F.col("_n") - window, F.lit(0)))))
              .withColumn("_len", F.least("_n", F.lit(window))))
    windows = inside.select("item_id", _window_text(F.col("_start"), F.col("_len")).alias("window")).distinct()
    prints = _looked_up(_with_minima(items, window, gram), window, gram, [])
    prints = prints.filter("_start >= 0").select("_len", "_fp")
    for n in lengths:
        prints = prints.union(items.filter(F.col("_n") == n)
                              .withColumn("_h", F.transform("_words", lambda w: F.xxhash64(F.lower(w))))
                              .select(F.lit(n), _hashed("_h", n, F.lit(0))))
    prints = prints.distinct().select(F.col("_len").alias("_l"), F.col("_fp").alias("_f"))
    same = (F.col("_fp") == F.col("_f")) & (F.col("_len") == F.col("_l"))
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", words(F.col(text)).alias("_words"))
    if prints.count() <= broadcast_rows:
        kept = _looked_up(_with_minima(numbered, window, gram), window, gram, lengths)
        kept = kept.join(F.broadcast(prints.withColumn("_hit", F.lit(True))), same, "left").filter("_hit OR _start = -1")
    else:  # place and fingerprint alone are shuffled; the words come back by row, once, for all its hits
        numbered = stored(numbered, "numbered")
        places = _looked_up(_with_minima(numbered, window, gram), window, gram, lengths).filter("_start >= 0")
        found = places.select("_row", "_len", "_start", "_fp").join(prints, same, "left_semi")
        per_row = found.groupBy("_row").agg(F.collect_list(F.struct("_len", "_start")).alias("_hits"))
        none = F.array(F.struct(F.lit(0).alias("_len"), F.lit(-1).alias("_start")))
        kept = (numbered.join(per_row, "_row", "left").withColumn("_n", F.size("_words"))
                .withColumn("_at", F.explode(F.concat(none, F.coalesce("_hits", F.slice(none, 1, 0))))).select("*", "_at.*"))
    # A fingerprint stands for the windows that begin in the next places; those of short items for themselves.
    last = F.least(F.col("_start") + (window - gram), F.col("_n") - window)
    starts = F.when(F.col("_len") == window, F.sequence(F.col("_start"), F.greatest(last, F.col("_start"))))
    kept = kept.withColumn("start", F.explode(F.coalesce(starts, F.array("_start"))))
    # A row that stands for its document alone gets a text of its own that no window is, so such rows do not meet in one task.
    alone = F.concat(F.lit("\0"), F.col("_row").cast("string"))
    near = kept.select("_row", "doc_id", F.col("_n").alias("n_words"), "start", F.col("_len").alias("length"),
                       F.when(F.col("start") >= 0, _window_text(F.col("start"), F.col("_len"))).otherwise(alone).alias("window"))
    exact = near.join(windows.select("window").distinct().withColumn("_same", F.lit(True)), "window", "left")
    return exact.filter("_same OR start = -1").drop("_same"), windows


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids (sorted as strings), contaminated."""
    found, windows = hits(docs, items, window, gram, text, item_id)
    found = found.checkpoint()  # read twice below; the text is scanned once
    spans = F.array_sort(F.collect_set(F.when(F.col("start") >= 0, F.struct("start", "length"))))
    covered = F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
            (a["n"] + F.greatest(s["start"] + s["length"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n")))
    per_doc = found.groupBy("_row", "doc_id", "n_words").agg(covered["n"].alias("n_hit"))
    which = (found.filter("start >= 0").select("_row", "window").distinct()
             .join(windows, "window").select("_row", F.col("item_id").cast("string").alias("i")).distinct()
             .groupBy("_row").agg(F.array_sort(F.collect_list("i")).alias("item_ids")))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return (per_doc.join(which, "_row", "left")
            .select("doc_id", F.col("n_words").cast("long"), F.col("n_hit").cast("long"),
                    F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def clean(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` without any word inside an item's window, all columns kept.

    A row is known by its doc_id and text together; equal rows share their fate.
    """
    key = F.xxhash64("doc_id", "text")
    found, _ = hits(docs.select(F.struct("doc_id", key.alias("key")).alias("doc_id"), "text"), items, **how)
    bad = found.filter("start >= 0").select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.key").alias("_key")).distinct()
    alone, rest = packed(docs, "doc_id", "text")
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (key == F.col("_key"))
    return alone.join(bad, same, "left_anti").select(*rest.values())
