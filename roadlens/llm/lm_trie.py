"""Language-model scoring with Elias-Fano n-gram tries.

Tokens are words and one end a text; a word is known by a 64-bit hash. A trigram (u, v, w) lives in the shard of its
middle word v. There a trie of three levels is built from the learned texts' counts:

1. the words v, with pointers to their successors and predecessors;
2. the successors w of each v, and its predecessors u, 32 bits of the hash each;
3. the trigrams, each as the place of w among v's successors and of u among v's predecessors, so a
   number relative to its context, small where the context has few neighbours.

Every level is one monotone sequence in Elias-Fano form (low bits in whole bytes, high bits in unary), and so are
the pointers. Beside them lie the counts of each pair and trigram, and of each context their sum and how many of
them are 1, 2 and more. The levels are one file, memory-mapped while its shard is queried; a query
is a successor search in each level, block by block, in ascending order.

p(w|uv) = a3 + g3 (a2 + g2 p1), with modified absolute discounting (three discounts by count for pairs and three for
trigrams, estimated from the counts of all shards) and p1 = (c + 0.5) / (N + 0.5 (V + 1)). It sums to one over the learned
words and one unknown. The logarithms of a3, g3, a2 and g2 are quantised.

Texts are read in blocks. A block sends its distinct trigrams, with their learned counts, to their shards, and its
distinct words to theirs; shards build, answer, and send back the counts, and how many counts of 1 to 4 they hold; when the
discounts are known from all of those, the block adds up probabilities by text. Nothing of the model is gathered. A word
expected (from ``SAMPLE`` texts) to fill more than one shard is split by the word before it into parts. Contexts of two words stay whole; the
pairs that begin with a split word are counted whole in shards of pairs. So the numbers of shards and parts are a matter of layout: scores are the same for any.

Defined results: a null text is an empty one, one end token. Repeated rows each count and each get a row. Rows
without an id are not different. Without learned texts every count is 0 and all models are the uniform one over
the unknown word. Texts are read whole, and twice: the source must give the same partitions each time (a table does), else
this fails. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import mmap
import tempfile
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import give_back, sampled, stored, text_bytes

SHARD_BYTES = 8_000_000  # of text; about a million trigrams
WORD_SHARES = 8  # trigram shards for each shard of words
BLOCK_TOKENS = 1_000_000
SAMPLE = 2000
START, END = 0x5BD1E9955BD1E995, 0x27D4EB2F165667C5  # hashes that stand for no word
NONE = 0xFFFF  # the code of zero
STEPS = 4096  # codes a power of ten
BLOCK_KEYS = 1 << 13
_LOW32 = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ROWS = 256


# ---- sequences and levels ------------------------------------------------------------------

class Sequence:
    """A strictly or weakly increasing sequence of whole numbers in Elias-Fano form, read from arrays that may be mapped."""

    def __init__(self, n: int, low_bytes: int, lows: np.ndarray, highs: np.ndarray, starts: np.ndarray):
        self.n, self.low_bytes, self.lows, self.highs, self.starts = n, low_bytes, lows, highs, starts
        firsts = np.arange(0, n, BLOCK_KEYS)
        at = starts[:len(firsts)].astype(np.int64) - firsts
        self.firsts = (at.astype(np.uint64) << np.uint64(8 * low_bytes) if low_bytes < 8 else np.zeros(len(firsts), np.uint64)) | self._low(firsts)

    @staticmethod
    def encoded(keys: np.ndarray) -> list[np.ndarray]:
        """The arrays of a sequence: head (length, low bytes), lows, highs, and where in highs each block of keys begins."""
        n = len(keys)
        keys = keys.astype(np.uint64)
        ideal = math.log2(max(float(keys[-1]) / n, 1)) if n else 0
        low_bytes = min(8, max(0, int((ideal + 5) // 8)))
        if n and (int(keys[-1]) >> 8 * low_bytes if low_bytes < 8 else 0) > 64 * n + 1024:
            low_bytes += 1
        lows = keys.view(np.uint8).reshape(-1, 8)[:, :low_bytes].copy().ravel() if n else np.zeros(0, np.uint8)
        high = (keys >> np.uint64(8 * low_bytes) if low_bytes < 8 else np.zeros(n, np.uint64)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(high[-1]) + 1 if n else 0, bool)
        bits[high] = True
        return [np.array([n, low_bytes], np.uint64), lows, np.packbits(bits), high[::BLOCK_KEYS].astype(np.uint64)]

    @classmethod
    def of(cls, keys: np.ndarray) -> Sequence:
        head, *rest = cls.encoded(keys)
        return cls(int(head[0]), int(head[1]), *rest)

    def _low(self, at: np.ndarray | slice) -> np.ndarray:
        rows = np.asarray(self.lows).reshape(self.n, self.low_bytes)[at] if self.low_bytes else None
        count = len(rows) if rows is not None else len(range(self.n)[at]) if isinstance(at, slice) else len(at)
        out = np.zeros((count, 8), np.uint8)
        if rows is not None:
            out[:, :self.low_bytes] = rows
        return out.view(np.uint64).ravel()

    def block(self, b: int) -> np.ndarray:
        """The keys of one block."""
        first, last = b * BLOCK_KEYS, min((b + 1) * BLOCK_KEYS, self.n)
        begin = int(self.starts[b])
        end = int(self.starts[b + 1]) if b + 1 < len(self.starts) else 8 * len(self.highs)
        bits = np.unpackbits(np.asarray(self.highs[begin // 8:(end + 7) // 8]))
        ones = np.flatnonzero(bits[begin % 8:])[:last - first] + begin
        high = (ones - np.arange(first, last)).astype(np.uint64)
        return (high << np.uint64(8 * self.low_bytes) if self.low_bytes < 8 else np.zeros(last - first, np.uint64)) | self._low(slice(first, last))

    def keys(self) -> np.ndarray:
        return np.concatenate([self.block(b) for b in range(len(self.starts))]) if self.n else np.zeros(0, np.uint64)

    def find(self, asked: np.ndarray) -> np.ndarray:
        """The place of each asked key (ascending), by a successor search in its block; -1 if it is not there."""
        out = np.full(len(asked), -1, np.int64)
        if not self.n or not len(asked):
            return out
        block = np.searchsorted(self.firsts, asked, "right") - 1
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(asked)], strict=True):
            if block[a] >= 0:
                keys = self.block(int(block[a]))
                at = np.searchsorted(keys, asked[a:b])
                hit = at < len(keys)
                hit[hit] = keys[at[hit]] == asked[a:b][hit]
                out[a:b][hit] = at[hit] + int(block[a]) * BLOCK_KEYS
        return out


def quantised(p: np.ndarray) -> np.ndarray:
    """Logarithms of probabilities as 16-bit codes, ``STEPS`` to a power of ten; zero and what is below all of them is ``NONE``."""
    with np.errstate(divide="ignore"):
        code = np.rint(-np.log10(p) * STEPS)
    return np.clip(code, 0, NONE, out=code).astype(np.uint16)


_VALUES = np.append(10.0 ** (-np.arange(NONE) / STEPS), 0.0)


def histogram(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5]


def discounts(n: np.ndarray) -> np.ndarray:
    """What counts of 1, 2 and more give up, by how many counts are 1, 2, 3 and 4."""
    n = np.asarray(n, float)
    if not n[0] or not n[1]:
        return np.array([0.75, 0.75, 0.75])
    y = n[0] / (n[0] + 2 * n[1])
    d = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.75 * k for k in (1, 2, 3)]
    return np.array([min(max(x, 0.1), k - 0.02) for k, x in zip((1, 2, 3), d, strict=True)])


def _sums(counts: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Of each group the sum of its counts, and how many of them are 1, 2 and more."""
    some = [np.bincount(group[of], minlength=groups) for of in (counts == 1, counts == 2, counts > 2)]
    return np.array([np.bincount(group, counts, groups), *some]).astype(np.uint32)


def _left(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of each context (1 at least), and the weight it leaves to the shorter one."""
    total, *often = sums.astype(float)
    least = np.maximum(total, 1)
    return least, np.where(total > 0, _VALUES[quantised((d[0] * often[0] + d[1] * often[1] + d[2] * often[2]) / least)], 1)


def _smoothed(counts: np.ndarray, total: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The discounted probability of each count in a context of this sum."""
    off = np.array([0, *d])[np.minimum(counts, 3)]
    return _VALUES[quantised((counts - off) / total)]


def weights(tri: np.ndarray, total: np.ndarray, left: np.ndarray, d2: np.ndarray, d3: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """alpha and beta, so that p(w|uv) = alpha + beta p1(w), from what ``Trie.counts`` finds for trigrams, and the ``_left`` of their middle words."""
    total3, left3 = _left(tri[2:], d3)
    return _smoothed(tri[0], total3, d3) + left3 * _smoothed(tri[1], total, d2), left3 * left


class Trie:
    """The levels of one shard: sequences of words, successors, predecessors, trigrams and pointers, and counts beside them."""

    SEQUENCES = ("words", "succ_at", "pred_at", "succ", "pred", "tri")
    COUNTS = ("middle", "c2", "context", "c3")

    @classmethod
    def build(cls, hv: np.ndarray, wu: np.ndarray, counts: np.ndarray) -> bytes:
        """From distinct trigrams ascending by (v, w and u) and their counts (1 or more)."""
        new_v = np.append(True, hv[1:] != hv[:-1]) if len(hv) else np.zeros(0, bool)
        words, v = hv[new_v], np.cumsum(new_v) - 1
        w, u = wu >> _32, wu & _LOW32
        new_w = new_v | np.append(True, w[1:] != w[:-1]) if len(hv) else new_v
        node = np.cumsum(new_w) - 1
        succ = (v[new_w].astype(np.uint64) << _32) | w[new_w]
        pred, context = np.unique((v.astype(np.uint64) << _32) | u, return_inverse=True)
        pred_v = (pred >> _32).astype(np.int64)
        n_succ, n_pred = np.bincount(v[new_w], minlength=len(words)), np.bincount(pred_v, minlength=len(words))
        succ_at, pred_at = np.cumsum(n_succ) - n_succ, np.cumsum(n_pred) - n_pred
        base = np.cumsum(n_succ * n_pred) - n_succ * n_pred
        tri = base[v] + (node - succ_at[v]) * n_pred[v] + context - pred_at[v]
        pair_counts = np.bincount(node, counts, len(succ)).astype(np.int64)
        arrays = [a for keys in (words, succ_at, pred_at, succ, pred, tri) for a in Sequence.encoded(keys)]
        arrays += [_sums(pair_counts, v[new_w], len(words)), pair_counts.astype(np.uint32), _sums(counts, context, len(pred)), counts.astype(np.uint32)]
        sizes = np.array([x.nbytes for x in arrays], np.uint64)
        return b"".join([sizes.tobytes(), *(x.tobytes() + bytes(-x.nbytes % 8) for x in arrays)])

    def __init__(self, data):
        n = 4 * len(self.SEQUENCES) + len(self.COUNTS)
        sizes, at, parts = np.frombuffer(data, np.uint64, n).tolist(), 8 * n, []
        kinds = [np.uint64, np.uint8, np.uint8, np.uint64] * len(self.SEQUENCES) + [np.uint32] * len(self.COUNTS)
        for size, kind in zip(sizes, kinds, strict=True):
            parts.append(np.frombuffer(data, kind, int(size) // np.dtype(kind).itemsize, at))
            at += int(size) + -int(size) % 8
        for i, name in enumerate(self.SEQUENCES):
            head, *rest = parts[4 * i:4 * i + 4]
            setattr(self, name, Sequence(int(head[0]), int(head[1]), *rest))
        for name, part in zip(self.COUNTS, parts[4 * len(self.SEQUENCES):], strict=True):
            setattr(self, name, part.reshape(4, -1) if name in ("middle", "context") else part)

    @classmethod
    def mapped(cls, data: bytes) -> Trie:
        """From a file of its own that is gone when the trie is."""
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def counts(self, hv: np.ndarray, wu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For trigrams ascending by (v, w and u), by column: the count, that of the pair (v, w), and the sums of the context (u, v).

        And for each distinct v the sums of its pairs. All are 0 where nothing was learned.
        """
        tri = np.zeros((6, len(hv)), np.uint32)
        new_v = np.append(True, hv[1:] != hv[:-1])[:len(hv)]
        middle = np.zeros((4, int(new_v.sum())), np.uint32)
        if not len(hv) or not self.words.n:
            return tri, middle
        v = self.words.find(hv[new_v])
        middle[:, v >= 0] = self.middle[:, v[v >= 0]]
        v = v[np.cumsum(new_v) - 1]
        at = np.flatnonzero(v >= 0)
        v, w, u = v[at], wu[at] >> _32, wu[at] & _LOW32
        pairs = (v.astype(np.uint64) << _32) | w
        new_w = np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]
        node = self.succ.find(pairs[new_w])[np.cumsum(new_w) - 1]
        tri[1, at[node >= 0]] = self.c2[node[node >= 0]]
        contexts, back = np.unique((v.astype(np.uint64) << _32) | u, return_inverse=True)
        context = self.pred.find(contexts)[back]
        tri[2:, at[context >= 0]] = self.context[:, context[context >= 0]]
        both = np.flatnonzero((node >= 0) & (context >= 0))
        succ_at, pred_at = self.succ_at.keys().astype(np.int64), self.pred_at.keys().astype(np.int64)
        n_succ, n_pred = np.diff(succ_at, append=self.succ.n), np.diff(pred_at, append=self.pred.n)
        base = np.cumsum(n_succ * n_pred) - n_succ * n_pred
        mine = v[both]
        key = base[mine] + (node[both] - succ_at[mine]) * n_pred[mine] + context[both] - pred_at[mine]
        found = self.tri.find(key.astype(np.uint64))
        tri[0, at[both[found >= 0]]] = self.c3[found[found >= 0]]
        return tri, middle

    def query(self, hv: np.ndarray, wu: np.ndarray, d2: np.ndarray | None = None, d3: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For trigrams ascending by (v, w and u): alpha and beta, so that p(w|uv) = alpha + beta p1(w).

        The discounts of pairs and trigrams are those of this shard's counts unless they are given.
        """
        d2, d3 = (discounts(histogram(c)) if d is None else d for c, d in ((self.c2, d2), (self.c3, d3)))
        tri, middle = self.counts(hv, wu)
        word = np.cumsum(np.append(True, hv[1:] != hv[:-1])[:len(hv)]) - 1
        total, left = _left(middle, d2)
        return weights(tri, total[word], left[word], d2, d3)

    def pair_histogram(self, without: np.ndarray) -> np.ndarray:
        """``histogram`` of the counts of pairs, without those that begin with some words (ascending)."""
        n_succ = np.diff(self.succ_at.keys().astype(np.int64), append=self.succ.n)
        return histogram(self.c2[np.repeat(~np.isin(self.words.keys(), without), n_succ)])


# ---- texts and blocks ----------------------------------------------------------------------

def hashes_of(words: Iterable[bytes]) -> np.ndarray:
    """The end's hash and those of the words."""
    return np.fromiter(itertools.chain((END,), map(xxhash.xxh64_intdigest, words)), np.uint64)


def _numbers() -> defaultdict[bytes, int]:
    """Numbers of a block's words in the order they are met; the end is number 0."""
    return defaultdict(itertools.count(1).__next__)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only


def trigrams(hashes: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each token of the texts, the key of its middle word and the bits of the two others.

    ``hot`` are the words that are split, ascending, and the number of parts of each.
    """
    w = hashes[tokens]
    first = np.cumsum(lengths) - lengths
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[first] = START
    u = np.empty_like(v)
    u[1:] = v[:-1]
    u[first] = START
    wu = (w & ~_LOW32) | (u >> _32)
    if len(hot[0]):
        at = np.minimum(np.searchsorted(hot[0], v), len(hot[0]) - 1)
        split = hot[0][at] == v
        v[split] = (v[split] + ((u[split] >> _32) * _M2 >> _32) % hot[1][at[split]]) * _M1  # by the bits of u that a trie knows
    return v, wu


def parts(hot: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all parts of split words, ascending, and the number of each one's word."""
    word = np.repeat(np.arange(len(hot[0])), hot[1].astype(np.int64))
    part = np.arange(len(word)) - np.searchsorted(word, word)
    keys = (hot[0][word] + part.astype(np.uint64)) * _M1
    order = np.argsort(keys)
    return keys[order], word[order]


def split_word(keys: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The number of the split word that each middle word's key is a part of; -1 for other words."""
    known, word = parts(hot)
    if not len(known):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, word[at], -1)


def split_pairs(hv: np.ndarray, wu: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that begin with a split word, ascending: its number and 32 bits of the next word's hash.

    From distinct trigrams ascending; also the places of the trigrams that have one, and each one's pair.
    """
    new = np.append(True, hv[1:] != hv[:-1])[:len(hv)]
    word = split_word(hv[new], hot)[np.cumsum(new) - 1]
    at = np.flatnonzero(word >= 0)
    own, which = np.unique(word[at].astype(np.uint64) << _32 | wu[at] >> _32, return_inverse=True)
    return own, at, which


def _pair_shards(hot: tuple[np.ndarray, np.ndarray]) -> int:
    return math.ceil(int(hot[1].sum()) / 2)  # a word has two parts for each shard it would fill


def _pair_shard(pairs: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (pairs * _M1 >> _32) % np.uint64(max(1, _pair_shards(hot)))


def distinct(hv: np.ndarray, wu: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams ascending, for each token its trigram's place there, and the tokens in that order."""
    order = np.argsort(wu)
    order = order[np.argsort(hv[order], kind="stable")]
    a, b = hv[order], wu[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(a)]
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    return a[new], b[new], back, order


def _pack(data: np.ndarray) -> bytes:
    """Bytes of whole numbers, all lowest bytes first, compressed."""
    size = data.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(data.view(np.uint8).reshape(-1, size).T.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return raw.reshape(size, -1).T.copy().view(kind).ravel() if len(raw) else np.zeros(0, kind)


def _pack_rows(rows: np.ndarray) -> bytes:
    """Rows of whole numbers, each with as many bytes a number as its largest needs, packed like ``_pack``."""
    sizes = [1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 for top in rows.max(axis=1).tolist()]
    parts = (row.astype(f"u{size}").view(np.uint8).reshape(-1, size).T.tobytes() for row, size in zip(rows, sizes, strict=True))
    return zstandard.ZstdCompressor(level=1).compress(b"".join([bytes(sizes), *parts]))


def _unpack_rows(data: bytes, rows: int) -> Iterator[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes, at = raw[:rows].tolist(), rows
    n = (len(raw) - rows) // sum(sizes)
    for size in sizes:
        yield raw[at:at + n * size].reshape(size, -1).T.copy().view(f"u{size}").ravel()
        at += n * size


_CELL = "block string, seal long, shard int, head binary, body binary, counts binary, doc_ids array<long>, lengths binary"
_FIELDS = [("block", pa.string()), ("seal", pa.int64()), ("shard", pa.int32()), ("head", pa.binary()), ("body", pa.binary()),
           ("counts", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary())]


def _batch(row: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, (_, t) in zip(row, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard and the places of its members, in order."""
    order = np.argsort(shard.astype(np.uint16 if len(shard) and shard.max() < 1 << 16 else np.uint32), kind="stable")  # two bytes sort by radix
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        yield int(shard[part[0]]), part


def blocks(docs: DataFrame, shards: int, word_shards: int, hot: tuple[np.ndarray, np.ndarray], cells: bool,
           block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per block a cell for each shard (trigram shards first, then those of words, then those of split words' pairs), or else one row with its texts as numbers.

    ``docs`` have doc_id, text and learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbers()
        part = made = total = 0
        ids: list[int | None] = []
        learned: list[bool] = []
        flat: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            hashes = hashes_of(numbers)
            tokens, lengths = np.concatenate(flat), np.fromiter(map(len, flat), np.int64, len(flat))
            block, seal = f"{part}-{made}", xxhash.xxh64_intdigest(hashes.tobytes() + lengths.tobytes()) - (1 << 63)
            if not cells:
                yield _batch((block, seal, -1, hashes.tobytes(), _pack(tokens), None, ids, lengths.astype(np.uint32).tobytes()))
                return
            taught = np.repeat(np.array(learned, bool), lengths)
            hv, wu, back, _ = distinct(*trigrams(hashes, tokens, lengths, shared.value))
            counts = np.bincount(back[taught], minlength=len(hv)).astype(np.uint32)
            del back
            for shard, at in _by_shard(hv % np.uint64(shards)):
                yield _batch((block, seal, shard, *_head_and_body(hv[at], wu[at]), _pack(counts[at]), None, None))
            of_words = np.bincount(tokens[taught], minlength=len(hashes)).astype(np.uint32)
            for shard, at in _by_shard(hashes % np.uint64(word_shards)):
                yield _batch((block, seal, shards + shard, hashes[at].tobytes(), None, _pack(of_words[at]), None, None))
            own, at, which = split_pairs(hv, wu, shared.value)
            of_pairs = np.bincount(which, counts[at], len(own)).astype(np.uint32)
            for shard, at in _by_shard(_pair_shard(own, shared.value)):
                yield _batch((block, seal, shards + word_shards + shard, own[at].tobytes(), None, _pack(of_pairs[at]), None, None))

        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                part = batch["part"][0].as_py()
                for doc_id, text, learn in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "learned")), strict=True):
                    words = words_of(text)
                    flat.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                    flat[-1] = np.append(flat[-1], np.uint32(0))
                    ids.append(doc_id)
                    learned.append(bool(learn))
                    total += len(words) + 1
                    if total >= block_tokens:
                        yield from flush()
                        numbers = _numbers()
                        ids, learned, flat, total, made = [], [], [], 0, made + 1
                        give_back()
        if flat:
            yield from flush()
        numbers.clear()
        ids, learned, flat = [], [], []
        give_back()

    return docs.select(F.col("doc_id").cast("long"), "text", "learned", F.spark_partition_id().alias("part")).mapInArrow(split, _CELL)


# ---- shards --------------------------------------------------------------------------------

def _head_and_body(hv: np.ndarray, wu: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct trigrams ascending: each v and its length, then every u, where a pair (v, w) begins, and the w of each pair."""
    v, w = np.append(True, hv[1:] != hv[:-1]), (wu >> _32).astype(np.uint32)
    new, pair = np.flatnonzero(v), v | np.append(True, w[1:] != w[:-1])
    head = np.concatenate([hv[new], np.diff(new, append=len(hv)).astype(np.uint64)])
    return head.tobytes(), wu.astype(np.uint32).tobytes() + np.packbits(pair).tobytes() + w[pair].tobytes()


def _cell(head: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(head, np.uint64).reshape(2, -1)
    hv = np.repeat(both[0], both[1].astype(np.int64))
    n, bits = len(hv), (len(hv) + 7) // 8
    pair = np.unpackbits(np.frombuffer(body, np.uint8, bits, 4 * n), count=n)
    w = np.frombuffer(body[4 * n + bits:], np.uint32)[np.cumsum(pair, dtype=np.int64) - 1]
    return hv, w.astype(np.uint64) << _32 | np.frombuffer(body, np.uint32, n)


def _merged(cells: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct trigrams of a shard's cells, their counts, and the place of each of the cells' trigrams."""
    parts = [_cell(h, b) for h, b in zip(cells["head"].to_pylist(), cells["body"].to_pylist(), strict=True)]
    counts = np.concatenate([_unpack(c, np.uint32) for c in cells["counts"].to_pylist()])
    hv, wu, back, _ = distinct(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    return hv, wu, np.bincount(back, counts, len(hv)).astype(np.int64), back


_ANSWER = "block string, seal long, shard int, first binary, second binary, sums array<long>, splits array<array<long>>"
_ANSWERS = [("block", pa.string()), ("seal", pa.int64()), ("shard", pa.int32()), ("first", pa.binary()), ("second", pa.binary()),
            ("sums", pa.list_(pa.int64())), ("splits", pa.list_(pa.list_(pa.int64())))]


def _answered(shards: int, word_shards: int, hot: tuple[np.ndarray, np.ndarray]):
    """What shards send back to each block: counts.

    And once a shard ``sums`` (learned tokens, distinct ones, and the histograms of pairs and trigrams) and ``splits`` (of each split word its
    number and the sums of its pairs).
    """
    def answer(cells: pa.Table) -> pa.Table:
        out, shard = [], cells["shard"][0].as_py()
        names = list(zip(cells["block"].to_pylist(), cells["seal"].to_pylist(), strict=True))
        sums, splits = np.zeros(10, np.int64), []
        if shard < shards:
            hv, wu, counts, back = _merged(cells)
            seen = counts > 0
            trie = Trie.mapped(Trie.build(hv[seen], wu[seen], counts[seen]))
            tri, middle = trie.counts(hv, wu)
            word = np.cumsum(np.append(True, hv[1:] != hv[:-1])[:len(hv)]) - 1
            sums[2:6], sums[6:] = trie.pair_histogram(parts(hot)[0]), histogram(counts)
            elsewhere = split_word(hv[np.append(True, hv[1:] != hv[:-1])[:len(hv)]], hot) >= 0
            tri[1, elsewhere[word]], middle[:, elsewhere] = 0, 0
            ends = np.cumsum([np.frombuffer(h, np.uint64).reshape(2, -1)[1].sum() for h in cells["head"].to_pylist()]).tolist()
            for (block, seal), a, b in zip(names, [0, *ends], ends):  # noqa: B905  one more start
                mine = word[back[a:b]]
                mine = mine[np.append(True, mine[1:] != mine[:-1])]
                out.append((block, seal, shard, _pack_rows(tri[:, back[a:b]]), _pack_rows(middle[:, mine]), None, None))
        else:
            cuts = [np.frombuffer(h, np.uint64) for h in cells["head"].to_pylist()]
            own, back = np.unique(np.concatenate(cuts), return_inverse=True)
            counts = np.bincount(back, np.concatenate([_unpack(c, np.uint32) for c in cells["counts"].to_pylist()]), len(own)).astype(np.uint64)
            if shard < shards + word_shards:
                sums[0], sums[1] = int(counts.sum()), int((counts > 0).sum())
            else:
                sums[2:6] = histogram(counts)
                number, at = np.unique((own >> _32).astype(np.int64), return_inverse=True)
                splits = np.column_stack([number, _sums(counts, at, len(number)).T]).tolist()
            ends = np.cumsum([len(p) for p in cuts]).tolist()
            for (block, seal), a, b in zip(names, [0, *ends], ends):  # noqa: B905  one more start
                out.append((block, seal, shard, _pack(counts[back[a:b]]), None, None, None))
        out[0] = (*out[0][:5], sums.tolist(), splits)  # once a shard
        give_back()
        return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), _ANSWERS, strict=True)], names=[n for n, _ in _ANSWERS])
    return answer


def _plan(docs: DataFrame, shard_bytes: int, sample: int) -> tuple[int, int, tuple[np.ndarray, np.ndarray]]:
    """The number of shards of trigrams and of words, and the words that are split."""
    shards = max(1, math.ceil(text_bytes(docs) / shard_bytes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch["text"].to_pylist():
                own, n = np.unique(hashes_of(words_of(text)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], names=["word", "n"])

    if shards == 1:
        return 1, 1, (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    drawn = sampled(docs.select("doc_id", "text"), sample, "doc_id", "text").select("text").mapInArrow(count, "word long, n long")
    drawn = drawn.groupBy("word").agg(F.sum("n").alias("n"))
    total = drawn.agg(F.sum("n")).first()[0] or 1
    often = drawn.filter(F.col("n") * shards > total).collect()  # fewer words than shards
    hot = sorted((r["word"] & (1 << 64) - 1, math.ceil(2 * r["n"] * shards / total)) for r in often)
    return shards, max(1, shards // WORD_SHARES), (np.array([h for h, _ in hot], np.uint64), np.array([k for _, k in hot], np.uint64))


def tries(docs: DataFrame, learned: Column, shard_bytes: int = SHARD_BYTES, sample: int = SAMPLE) -> DataFrame:
    """shard, levels: the trie of each shard, as ``Trie`` reads it. The counts of a split word's pairs are dealt out to its parts."""
    texts = docs.select("doc_id", "text").withColumn("learned", learned).filter("learned")
    shards, word_shards, hot = _plan(texts, shard_bytes, sample)

    def build(cells: pa.Table) -> pa.Table:
        hv, wu, counts, _ = _merged(cells)
        return pa.table({"shard": pa.array([cells["shard"][0].as_py()], pa.int32()), "levels": pa.array([Trie.build(hv, wu, counts)], pa.binary())})

    return (blocks(texts, shards, word_shards, hot, True).filter(F.col("shard") < shards)
            .groupBy("shard").applyInArrow(build, "shard int, levels binary"))


def score(docs: DataFrame, learned: Column, shard_bytes: int = SHARD_BYTES, sample: int = SAMPLE,
          block_tokens: int = BLOCK_TOKENS, fixed_discounts: tuple | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score and score (log10), learned from the rows where ``learned``."""
    texts = docs.select("doc_id", "text").withColumn("learned", learned)
    shards, word_shards, hot = _plan(texts, shard_bytes, sample)
    answers = stored(blocks(texts, shards, word_shards, hot, True, block_tokens).groupBy("shard")
                     .applyInArrow(_answered(shards, word_shards, hot), _ANSWER), "answers")
    sums = [x or 0 for x in answers.agg(*[F.sum(F.col("sums")[i]) for i in range(10)]).first()]
    train_tokens, kinds = sums[:2]
    whole = train_tokens + 0.5 * (kinds + 1)
    d2, d3 = (discounts(sums[2:6]), discounts(sums[6:])) if fixed_discounts is None else (np.array(fixed_discounts),) * 2
    of_split = np.zeros((4, len(hot[0])), np.int64)
    if len(hot[0]):
        rows = answers.select(F.explode("splits").alias("s")).groupBy(F.col("s")[0]).agg(*[F.sum(F.col("s")[i]) for i in range(1, 5)])
        for number, *mine in rows.collect():  # fewer words than shards
            of_split[:, number] = mine

    def scored(texts: pa.Table, mine: pa.Table) -> pa.Table:
        if texts.num_rows != 1 or set(texts["seal"].to_pylist()) != set(mine["seal"].to_pylist()):
            raise ValueError("the documents were not the same when they were read again")
        row = texts.to_pylist()[0]
        hashes, tokens, lengths = np.frombuffer(row["head"], np.uint64), _unpack(row["body"], np.uint32), np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        hv, wu, back, _ = distinct(*trigrams(hashes, tokens, lengths, hot))
        got = {s: (a, b) for s, a, b in zip(*(mine[c].to_pylist() for c in ("shard", "first", "second")), strict=True)}
        new = np.append(True, hv[1:] != hv[:-1])[:len(hv)]
        word, first = np.cumsum(new) - 1, np.flatnonzero(new)
        tri, middle, counts = np.empty((6, len(hv)), np.uint32), np.empty((4, len(first)), np.int64), np.empty(len(hashes), np.uint64)
        for shard, at in _by_shard(hv % np.uint64(shards)):
            for column, part in zip(tri, _unpack_rows(got[shard][0], 6), strict=True):
                column[at] = part
            own = word[at[new[at]]]
            for column, part in zip(middle, _unpack_rows(got[shard][1], 4), strict=True):
                column[own] = part
        for shard, at in _by_shard(hashes % np.uint64(word_shards)):
            counts[at] = _unpack(got[shards + shard][0], np.uint64)
        own, split, which = split_pairs(hv, wu, hot)
        of_pairs = np.empty(len(own), np.uint64)
        for shard, at in _by_shard(_pair_shard(own, hot)):
            of_pairs[at] = _unpack(got[shards + word_shards + shard][0], np.uint64)
        tri[1, split] = of_pairs[which]
        number = split_word(hv[first], hot)
        middle[:, number >= 0] = of_split[:, number[number >= 0]]
        del own, split, which, of_pairs, got, wu
        total, left = _left(middle, d2)
        alpha, beta = np.empty(len(hv)), np.empty(len(hv))
        for a in range(0, len(hv), BLOCK_KEYS):
            b = a + BLOCK_KEYS
            alpha[a:b], beta[a:b] = (_VALUES[quantised(x)] for x in weights(tri[:, a:b], total[word[a:b]], left[word[a:b]], d2, d3))
        del tri, middle, total, left, word
        p1 = (counts + 0.5) / whole
        first = np.cumsum(lengths) - lengths
        add = lambda x: np.add.reduceat(x, first)
        p = np.log10(alpha[back] + beta[back] * p1[tokens])
        del hv, back, alpha, beta
        give_back()
        return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "n_tokens": pa.array(lengths, pa.int64()),
                         "n_known": pa.array(add((counts > 0).astype(np.int64)[tokens]), pa.int64()),
                         "base_score": pa.array(add(np.log10(p1)[tokens])), "score": pa.array(add(p))})

    out = (blocks(texts, shards, word_shards, hot, False, block_tokens).select("block", "seal", "head", "body", "doc_ids", "lengths").groupBy("block")
           .cogroup(answers.select("block", "seal", "shard", "first", "second").groupBy("block"))
           .applyInArrow(scored, "doc_id long, n_tokens long, n_known long, base_score double, score double"))
    return out.select("doc_id", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
