"""Line dedup with a fixed-depth tree of log templates, in DataFrame functions only.

The tree's levels are: number of tokens, then the first ``depth`` tokens. Characters of scripts written without
spaces are tokens of their own. Tokens with a digit are variable fields and read ``<*>``. In a leaf, two lines follow one
template if they are equal, or, for lines of ``block_tokens`` tokens or more, if they are equal but for one of
the four blocks into which the tokens behind the leading ones are cut; that block is the template's variable field.
A template has constant tokens in at least one of ``CONSTANT`` of its places. A line that leaves fewer, such as a row of
numbers, and one of fewer than ``min_tokens`` tokens is its own template: its exact text without outer spaces.

A template that occurs in two documents or more is recurring: its lines stay in the document with the
smallest id and are dropped from all others. Every line but a blank one takes part.

Only the smallest and largest document of a leaf or template are kept, so a line found in a third of
all documents is one row per task before any shuffle. Lines go on to the templates only if their leaf
occurs in two documents; the joins back are plain equi-joins, which Spark splits where a key is hot.

Defined results: a null text stays null and has no line; an empty text has one empty line, which
stays. Rows that share an id are one document. A null id sorts last. Columns besides doc_id and
text pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import packed, stored

DEPTH = 3
MIN_TOKENS = 5
BLOCK_TOKENS = 12
BLOCKS = 4
CONSTANT = 2
_LAST_ID = (1 << 63) - 1
_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


SPACE = " \t\n\x0b\f\r"
FIELD = "<*>"


def _spaced(line: Column) -> Column:
    """Every character of a script without spaces between spaces; the range is a first, quick look."""
    return F.when(line.rlike(r"[\x{E00}-\x{10FFFF}]"), F.regexp_replace(line, f"({_UNSPACED})", " $1 ")).otherwise(line)


def _masked(line: Column) -> Column:
    spaced = _spaced(line)
    return F.btrim(F.when(line.rlike("[0-9]"), F.regexp_replace(spaced, r"[^\s]*[0-9][^\s]*", FIELD)).otherwise(spaced), F.lit(SPACE))


def _split(masked: Column) -> Column:
    """The tokens; a text with single spaces is split without an expression."""
    return F.when(masked.rlike(r"[\t\n\x0B\f\r]|  "), F.split(masked, r"\s+")).otherwise(F.split(masked, " "))


def template_keys(tokens: Column, fields: Column, depth: int = DEPTH, block_tokens: int = BLOCK_TOKENS) -> tuple[Column, Column]:
    """Leaf key and template keys of a line's tokens, a block left out only if enough constant tokens stay.

    ``fields`` says whether any token is a variable field; without one nothing needs to be counted.
    """
    n = F.size(tokens)
    leaf = F.xxhash64(n, F.slice(tokens, 1, depth))
    rest = F.greatest(n - depth, F.lit(0))
    step = F.ceil(rest / BLOCKS).cast("int")
    starts = [F.lit(depth + 1) + step * j for j in range(BLOCKS)]
    parts = [F.slice(tokens, s, F.greatest(F.least(step, n + 1 - s), F.lit(0))) for s in starts]
    block = F.array(*[F.xxhash64(p) for p in parts])
    all_rest = F.xxhash64(F.slice(tokens, depth + 1, rest))
    constant = lambda some: F.size(F.array_remove(some, FIELD))
    whole = constant(tokens)
    enough = [(whole - constant(p)) * CONSTANT >= n - F.size(p) for p in parts]
    every = F.array(*map(F.lit, range(BLOCKS)))
    left_out = F.when(fields, F.array_compact(F.array(*[F.when(e, F.lit(j)) for j, e in enumerate(enough)]))).otherwise(every)
    but_one = F.transform(left_out, lambda j: F.xxhash64(
        j, F.filter(block, lambda _, k: k != j)))
    return leaf, F.when(n >= block_tokens, F.concat(F.array(all_rest), but_one)).otherwise(F.array(all_rest))


def _marked(docs: DataFrame) -> DataFrame:
    """Adds ``_id`` (an order of documents) and ``_key`` (with it, a row's contents)."""
    return docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)),
                             "_key": F.xxhash64("doc_id", "text")})


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS,
                    block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The lines to drop: _id, _key of the row and _line, its place in the text from 0."""
    def read(line: Column) -> Column:
        masked = _masked(line)
        return F.struct(F.btrim(line, F.lit(SPACE)).alias("exact"), _split(masked).alias("tokens"), F.contains(masked, F.lit(FIELD)).alias("fields"))

    def keyed(body: Column, line: Column) -> Column:
        tokens, exact, fields = body["tokens"], body["exact"], body["fields"]
        leaf, keys = template_keys(tokens, fields, depth, block_tokens)
        few = fields & (F.size(F.array_remove(tokens, FIELD)) * CONSTANT < F.size(tokens))
        alone = (F.size(tokens) < min_tokens) | few
        by_text = F.xxhash64(F.lit("exact"), exact)
        return F.struct(line.alias("_line"), F.length(exact).alias("_n"), F.when(alone, by_text).otherwise(leaf).alias("_leaf"),
                        F.when(alone, F.array(by_text)).otherwise(keys).alias("_keys"))

    found = F.transform(F.transform(F.split("text", "\n"), read), keyed)
    lines = _marked(docs.select("doc_id", "text")).select("_id", "_key", F.inline(found))
    lines = stored(lines.filter("_n > 0").drop("_n"), "lines")  # read four times, the texts once

    def several(df: DataFrame, *by: str) -> DataFrame:
        return (df.groupBy(*by).agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
                .filter("_first < _last").drop("_last"))

    inside = lines.join(several(lines, "_leaf").drop("_first"), "_leaf")
    templates = inside.select("_id", "_key", "_line", "_leaf", F.explode("_keys").alias("_template"))
    return (templates.join(several(templates, "_leaf", "_template"), ["_leaf", "_template"])
            .filter("_first < _id").select("_id", "_key", "_line").distinct())


def drop_recurring(docs: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, and n_lines and n_dropped in place of columns of these names."""
    gone = (recurring_lines(docs, depth, min_tokens, block_tokens)
            .groupBy("_id", "_key").agg(F.collect_list("_line").alias("_gone")))
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda _, i: ~F.array_contains("_gone", i))
    alone, rest = packed(docs, "doc_id", "text")
    made = {"text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_dropped": F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long")}
    passed = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return (_marked(alone).join(gone, ["_id", "_key"], "left")
            .select(*[made[c].alias(c) if c == "text" else rest[c] for c in passed],
                    made["n_lines"].alias("n_lines"), made["n_dropped"].alias("n_dropped")))
