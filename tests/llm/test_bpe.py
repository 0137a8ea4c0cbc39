import base64

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from roadlens.llm import bpe
from llm_helpers import prose

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(docs, texts, library, **how):
    done = bpe.decode(bpe.encode(docs(texts, extra=True), PATH, **how), PATH).collect()
    assert sorted(r.doc_id for r in done) == list(range(len(texts)))
    for r in done:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()


def test_awkward(docs, awkward, library):
    check(docs, [t for t in awkward if t is None or len(t) < 60_000 or " " in t], library)
    assert bpe.encode(docs([]), PATH).count() == 0


def test_every_kind_of_character(docs, rng, library):
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + [0x1F600, 0x1D4B3, 0x20000]
    texts = ["".join(chr(c) + str(rng.choice(["", " ", "  ", "a", "'s", "1", "\n"])) for c in points[a:a + 500])
             for a in range(0, len(points), 500)]
    check(docs, [*texts, "it's I'LL we'd  x   \n\n  y\t\tz  ", "<|endoftext|>", "".join(map(chr, bpe.odd_characters())) * 3], library)


def test_small_blocks(docs, rng, library, monkeypatch):
    monkeypatch.setattr(bpe, "_LONG", 50)
    monkeypatch.setattr(bpe, "_CHUNK", 20)
    check(docs, [prose(rng, int(n)) for n in rng.integers(0, 60, 50)], library, block_chars=300)


def test_repeated_and_missing_ids(docs, library):
    rows = bpe.encode(docs([(1, "a b"), (1, "a b"), (None, "c")]), PATH).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in rows) == [(False, 2), (False, 2), (True, 1)]


def test_decoded_by_the_same_worker(docs, awkward):
    df = docs(awkward + ["naïve 𝒳 don't  stop\n\n"], extra=True)
    rows = lambda found: sorted((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in found.collect())
    assert rows(bpe.encode(df, PATH, decoded=True)) == rows(bpe.decode(bpe.encode(df, PATH), PATH))
