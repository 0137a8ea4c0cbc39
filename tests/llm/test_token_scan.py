import numpy as np
import public_tokenizers as P
import pytest

from roadlens.llm import token_scan as T
from roadlens.session import scratch_path
from test_bpe import PATH, library  # noqa: F401

END = 50256


def write(folder, files, width):
    folder.mkdir()
    for name, ids in files.items():
        (folder / name).write_bytes(b"".join(int(i).to_bytes(width, "little") for i in ids))


def brute(files):
    out = []
    for name, ids in files.items():
        first = 0
        doc = 0
        for i, x in enumerate(ids):
            if x == END:
                out.append((name, doc, first, i - first, True))
                first, doc = i + 1, doc + 1
        if first < len(ids):
            out.append((name, doc, first, len(ids) - first, False))
    return sorted(out)


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("block", [1, 3, 7, 1 << 19])
def test_blocks_are_stitched(spark, tmp_path, rng, width, block):
    files = {f"f{i}": rng.choice([1, 2, 80, 196, END], int(n), p=[.3, .2, .2, .15, .15]).tolist() for i, n in enumerate(rng.integers(0, 60, 8))}
    files |= {"empty": [], "ends": [END, END, END], "open": [1] * 30, "one": [END], "swap": [0x50C4, 0xC450, 80, 196]}
    write(tmp_path / "tokens", files, width)
    got = T.count_tokens(spark, str(tmp_path / "tokens"), END, width, block).collect()
    assert sorted((r.file.rpartition("/")[2], r.doc, r.first_token, r.n_tokens, r.ended) for r in got) == brute(files)


def test_an_incomplete_token_is_ignored(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "f").write_bytes(b"\x01\x00" + END.to_bytes(2, "little") + b"\x07")
    assert [(r.n_tokens, r.ended) for r in T.count_tokens(spark, str(tmp_path / "t"), END).collect()] == [(1, True)]


def test_documents(spark, docs, awkward, library):  # noqa: F811
    texts = [t for t in awkward if t is None or " " in t or len(t) < 1000]
    path = scratch_path(spark, "docs")
    docs([*((i, t) for i, t in enumerate(texts)), (None, "no id"), (0, "again")], extra=True).repartition(3).write.parquet(path)
    got = T.document_tokens(spark.read.parquet(path), scratch_path(spark, "tokens"), PATH, P.PATTERN, END).collect()
    want = [(i, len(library.encode_ordinary(t or ""))) for i, t in enumerate(texts)]
    want += [(None, len(library.encode_ordinary("no id"))), (0, len(library.encode_ordinary("again")))]
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)


def test_files_are_flat(spark, docs, tmp_path):
    T.write_tokens(docs(["hello", None, "<|endoftext|>"]).coalesce(1), str(tmp_path / "out"), PATH, P.PATTERN, END)
    ids = np.concatenate([np.fromfile(f, "<u2") for f in (tmp_path / "out").glob("part-*")])
    assert (ids == END).sum() == 3 and ids[-1] == END and len(ids) > 4


def test_no_documents(spark, docs):
    path = scratch_path(spark, "none")
    docs([]).write.parquet(path)
    assert T.document_tokens(spark.read.parquet(path), scratch_path(spark, "tokens"), PATH, P.PATTERN, END).count() == 0
