"""Byte-level BPE over a whole corpus: each distinct word is encoded once.

1. ``blocks``: a task splits its texts into pre-tokens (words) and numbers the distinct words of each block
   of about ``BLOCK_CHARS`` characters. So a word crosses the network once per block, not once per
   occurrence.
2. The blocks' words are shuffled by word: all blocks' copies of a word meet in one bucket, where the
   word is encoded once, and the ids go back to the blocks that asked for them.
3. The texts are read again, now as word numbers by position, and meet their block's ids.

The texts are read twice rather than kept in between, which would take more disk than the result. Both
reads must see the same rows in the same partitions, as a table's scan does; each block carries a
checksum of its words, and the job fails if the two differ.

Packed rows keep the shuffles small; a bucket is read as a stream and holds only its own distinct
words. Nothing but the vocabulary (a fixed file) is broadcast.

Defined results: a null or empty text has no tokens. Every input row gives one result row. A text of
any length is encoded whole. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import functools
import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import give_back, text_bytes

BLOCK_CHARS = 4_000_000
_LONG = 2_000_000
_CHUNK = 500_000


def vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@functools.lru_cache(maxsize=2)
def _ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}


@functools.lru_cache(maxsize=2)
def _encoding(file: bytes) -> tiktoken.Encoding:
    """Encodes one word at a time: its pattern takes all it is given as one match."""
    return tiktoken.Encoding("words", pat_str=r"(?s:.)+", mergeable_ranks=_ranks(file), special_tokens={})


@functools.lru_cache(maxsize=2)
def _token_bytes(file: bytes) -> list[bytes]:
    ranks = _ranks(file)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


@functools.cache
def odd_characters() -> dict[int, str]:
    """Characters that this process's ``regex`` and the library's own expressions class differently.

    Each maps to a character of the library's class. The two follow different Unicode versions.
    """
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    classes, odd = [], set()
    for expression, like in ((r"\s", "\t"), (r"\p{L}", "b"), (r"\p{N}", "1")):
        probe = tiktoken.Encoding("probe", pat_str=expression, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        theirs = set(probe.decode_bytes(probe.encode_ordinary(every)).decode())  # what does not match is left out
        odd |= theirs ^ set(regex.findall(expression, every))
        classes.append((theirs, like))
    return {ord(c): next((like for theirs, like in classes if c in theirs), "#") for c in odd}


def _joined(ids: bytes, table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _pack(data: bytes | np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(bytes(data) if isinstance(data, bytes) else data.tobytes())


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _planes(numbers: np.ndarray) -> bytes:
    """Little-endian bytes of 32-bit numbers, all lowest bytes first: small numbers pack better so."""
    return _pack(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.copy())


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(_unpack(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _pack_words(raw: list[bytes], at: list[int]) -> tuple[bytes, bytes]:
    lengths = np.fromiter(map(len, raw), np.uint32, len(raw))
    return _planes(np.diff(np.array(at), prepend=0)), _pack(len(raw).to_bytes(4, "little") + lengths.tobytes() + b"".join(raw))


def _unpack_words(data: bytes) -> list[bytes]:
    raw = _unpack(data)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    starts = np.concatenate([[4 + 4 * n], ends[:-1]])
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


_BLOCK = "bucket int, block string, seal long, at binary, data binary, doc_ids array<long>, counts array<long>"
_COLUMNS = ["bucket", "block", "seal", "at", "data", "doc_ids", "counts"]
_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.string()), ("seal", pa.int64()), ("at", pa.binary()), ("data", pa.binary()),
                    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
#: Rows that become Python values at a time; a whole Arrow batch of texts would be held several times over.
_ROWS = 256


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            yield batch.slice(first, _ROWS)


def blocks(docs: DataFrame, buckets: int, pattern: str = public_tokenizers.PATTERN,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per block its words, a row for each bucket; or without buckets (0) one row, the texts as word numbers."""

    odd = odd_characters()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = regex.compile(pattern)
        # Most texts are settled by one range; only the others are looked through for the characters themselves.
        high = regex.compile(f"[{chr(min(odd, default=0x10FFFF))}-\U0010FFFF]")
        strange = frozenset(map(chr, odd))
        part = made = 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = f"{part}-{made}"
            flat = np.concatenate(numbers)
            often = np.bincount(flat, minlength=len(words))
            order = np.argsort(-often, kind="stable")  # frequent words get small numbers
            spelled = [w.encode("utf-8", "replace") for w in words]
            seal = crc32(b"\0".join(spelled))
            if not buckets:
                place = np.empty(len(words), np.uint32)
                place[order] = np.arange(len(words), dtype=np.uint32)
                rows = [(-1, block, seal, None, _planes(place[flat]), ids, [len(x) for x in numbers])]
            else:
                by_bucket: dict[int, tuple[list[bytes], list[int]]] = {}
                for new, old in enumerate(order.tolist()):
                    mine = by_bucket.setdefault(crc32(spelled[old]) % buckets, ([], []))
                    mine[0].append(spelled[old])
                    mine[1].append(new)
                rows = [(b, block, seal, *_pack_words(w, at), None, None) for b, (w, at) in by_bucket.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)],
                                                 schema=_ARROW)

        words: dict[str, int] = {}
        ids, numbers, chars = [], [], 0
        for batch in _slices(batches):
            part = batch.column("part")[0].as_py()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                if high.search(text) and not strange.isdisjoint(text):
                    some = (text[m.start():m.end()] for m in found.finditer(text.translate(odd)))
                else:
                    some = found.findall(text) if len(text) < _LONG else (m[0] for m in found.finditer(text))
                new = np.fromiter((words.setdefault(w, len(words)) for w in some), np.uint32)
                ids.append(doc_id)
                numbers.append(new)
                chars += len(text)
                if chars >= block_chars:
                    yield from flush()
                    made += 1
                    words.clear()
                    ids, numbers, chars = [], [], 0
                    give_back()
        if ids:
            yield from flush()
        words.clear()
        ids, numbers = [], []
        give_back()

    return docs.select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().alias("part")).mapInArrow(split, _BLOCK)


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN,
           block_chars: int = BLOCK_CHARS, decoded: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens and ``ids``, the token ids as little-endian 32-bit numbers.

    With ``decoded`` also what ``decode`` adds, made from the ids by the same worker: a second worker beside it
    would hold every block once more.
    """
    spark = docs.sparkSession
    file = spark.sparkContext.broadcast(vocabulary(path))
    buckets = 64 * max(1, math.ceil(math.sqrt(text_bytes(docs) / 1e9)))

    def encode_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, list[int]] = {}
        encoding, now = _encoding(file.value), None
        for batch in batches:
            out = []
            for bucket, block, seal, at, data, _, _ in batch.itertuples(index=False):
                if bucket != now:  # a word is in one bucket only
                    known.clear()
                    now = bucket
                rows = []
                for word in _unpack_words(data):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = encoding.encode_ordinary(word.decode())
                    rows.append(ids)
                counts = np.fromiter(map(len, rows), np.uint32, len(rows))
                flat = np.fromiter(chain.from_iterable(rows), np.uint32, int(counts.sum()))
                out.append((bucket, block, seal, at, _planes(np.concatenate([counts, flat])), None, None))
            yield pd.DataFrame(out, columns=_COLUMNS)
            out = None
        known.clear()
        give_back()

    def reassemble(block: pd.DataFrame) -> pd.DataFrame:
        if block["seal"].nunique() != 1 or (block["bucket"] < 0).sum() != 1:
            raise ValueError("the documents were not the same when they were read again")
        texts = block[block["bucket"] < 0].iloc[0]
        parts = [(np.cumsum(_from_planes(a), dtype=np.int64), _from_planes(d))
                 for a, d in block.loc[block["bucket"] >= 0, ["at", "data"]].itertuples(index=False)]
        size = sum(len(at) for at, _ in parts)
        counts = np.zeros(size, np.int64)
        starts = np.zeros(size, np.int64)
        flat, total = [], 0
        for at, both in parts:
            n = both[:len(at)].astype(np.int64)
            counts[at] = n
            starts[at] = total + np.cumsum(n) - n
            flat.append(both[len(at):])
            total += int(n.sum())
        table = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        words = _from_planes(texts["data"])
        per_text = np.asarray(texts["counts"], np.int64)
        out, done, first = [], 0, 0
        ends = np.cumsum(per_text)
        while first < len(per_text):  # some texts at a time
            last = max(first + 1, int(np.searchsorted(ends, done + _CHUNK, "right")))
            mine = words[done:ends[last - 1]]
            n = counts[mine]
            stop = np.cumsum(n)
            ids = table[np.repeat(starts[mine] - (stop - n), n) + np.arange(int(n.sum()))].astype("<u4")
            bounds = np.concatenate([[0], stop])[ends[first:last] - done].tolist()
            begin = 0
            for end in bounds:
                out.append(ids[begin:end].tobytes())
                begin = end
            done, first = int(ends[last - 1]), last
        ids = pd.array([None if pd.isna(i) else i for i in texts["doc_ids"]], "Int64")
        del table, words, counts, starts, parts, flat
        give_back()
        made = {"doc_id": ids, "n_tokens": [len(x) // 4 for x in out], "ids": out}
        if decoded:
            spelled = _token_bytes(file.value)
            made["decoded"] = [_joined(x, spelled) for x in out]
        return pd.DataFrame(made)

    encoded = (blocks(docs, buckets, pattern, block_chars).repartition("bucket").sortWithinPartitions("bucket")
               .mapInPandas(encode_words, _BLOCK))
    return (encoded.union(blocks(docs, 0, pattern, block_chars)).groupBy("block")
            .applyInPandas(reassemble, "doc_id long, n_tokens long, ids binary" + (", decoded binary" if decoded else "")))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids``, from the token-byte table."""
    file = encoded.sparkSession.sparkContext.broadcast(vocabulary(path))

    def join_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(file.value)
        for batch in _slices(batches):
            out = [None if x is None else _joined(x, table) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(join_bytes, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))
