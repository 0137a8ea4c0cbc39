"""Token counts of documents in flat, unindexed token files, from a scan for separators.

A token file is nothing but token ids of a fixed width, each document followed by the end-of-document
id. A task takes a file and cuts it into blocks; in each, numpy finds all separators at once. What
crosses blocks is settled by a prefix scan over one small row per block: the running sum of tokens
places the block in its file, and the running maximum of separator places gives the last one
before it, so a document may span any number of blocks.

Defined results: an empty file has no document; two separators in a row hold an empty document; tokens
behind the last separator are a last document with ``ended`` false; an incomplete last token is ignored.
A file must be under 2 GB, as Spark reads it as one value.

``write_tokens`` makes such files from documents, one per input partition, in input order. A null text
is empty. Rows that repeat count each. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlens.llm.bpe import _ranks, _slices, vocabulary

BLOCK_TOKENS = 1 << 19
_encodings: dict[tuple[bytes, str], tiktoken.Encoding] = {}


def _encoding(file: bytes, pattern: str) -> tiktoken.Encoding:
    if (file, pattern) not in _encodings:
        _encodings[file, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_ranks(file), special_tokens={})
    return _encodings[file, pattern]


def write_tokens(docs: DataFrame, folder: str, vocabulary_path: str, pattern: str, end_id: int, width: int = 2) -> None:
    """Writes the texts' token ids, little-endian, ``width`` bytes each, with ``end_id`` after each text."""
    file = docs.sparkSession.sparkContext.broadcast(vocabulary(vocabulary_path))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(file.value, pattern)
        for batch in _slices(batches):
            ids = (encoding.encode_to_numpy(t or "") for t in batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(f"<u{width}").tobytes() for x in ids], pa.binary())], names=["value"])

    # The text writer puts a value's bytes and then the line separator, here the separator's bytes.
    end = end_id.to_bytes(width, "little").decode("latin-1")
    (docs.select("text").mapInArrow(tokens, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", end).option("encoding", "ISO-8859-1").text(folder))


def scan_blocks(spark: SparkSession, folder: str, end_id: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block: file, block, n_tokens and the separators' places in the block."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in batch.itertuples(index=False):
                ids = np.frombuffer(content, f"<u{width}", len(content) // width)
                rows = []
                for block, a in enumerate(range(0, len(ids), block_tokens)):
                    mine = ids[a:a + block_tokens]
                    rows.append((path, block, len(mine), np.flatnonzero(mine == end_id).astype(np.int32)))
                yield pd.DataFrame(rows, columns=["file", "block", "n_tokens", "ends"])

    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("path", "content")
    return files.mapInPandas(scan, "file string, block int, n_tokens long, ends array<int>")


def count_tokens(spark: SparkSession, folder: str, end_id: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document of the files: file, doc (from 0), first_token, n_tokens, ended."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = scan_blocks(spark, folder, end_id, width, block_tokens)
    placed = blocks.withColumn("at", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    last = F.col("at") + F.element_at("ends", -1)
    placed = placed.withColumn("last", F.when(F.size("ends") > 0, last)).withColumns({
        "previous": F.coalesce(F.max("last").over(before), F.lit(-1)),
        "docs_before": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)),
    })
    inside = placed.select("file", "at", "previous", "docs_before", "ends", F.posexplode("ends").alias("i", "end"))
    begin = F.when(F.col("i") == 0, F.col("previous") + 1).otherwise(F.col("at") + F.get("ends", F.col("i") - 1) + 1)
    docs = inside.select("file", (F.col("docs_before") + F.col("i")).alias("doc"), begin.alias("first_token"),
                         (F.col("at") + F.col("end") - begin).alias("n_tokens"), F.lit(True).alias("ended"))
    rest = (placed.groupBy("file").agg(F.sum(F.size("ends")).alias("doc"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("first_token"),
                                       F.sum("n_tokens").alias("n"))
            .select("file", "doc", "first_token", (F.col("n") - F.col("first_token")).alias("n_tokens"), F.lit(False).alias("ended"))
            .filter("n_tokens > 0"))
    return docs.union(rest)


def document_tokens(docs: DataFrame, folder: str, vocabulary_path: str, pattern: str, end_id: int) -> DataFrame:
    """Writes token files of ``docs`` to ``folder``, scans them and names the documents: doc_id, n_tokens.

    The i-th document of a file is the i-th row of the input partition that wrote it, so ``docs``
    must be a table that is read the same way twice. If the counts disagree, the query fails.
    """
    write_tokens(docs, folder, vocabulary_path, pattern, end_id)
    counted = count_tokens(docs.sparkSession, folder, end_id)
    at = F.monotonically_increasing_id()
    names = docs.select(F.col("doc_id").cast("long"), at.alias("at")).select(
        "doc_id", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("doc"))
    counted = counted.select(F.regexp_extract("file", r"part-(\d+)-", 1).cast("long").alias("part"), "doc", "n_tokens")
    known = F.col("n_tokens").isNotNull() & F.col("known")
    return (names.withColumn("known", F.lit(True)).join(counted, ["part", "doc"], "full")
            .select("doc_id", F.when(known, F.col("n_tokens"))
                    .otherwise(F.raise_error(F.lit("token files and documents differ")).cast("long")).alias("n_tokens")))
