import re

import regex

from roadlens.llm import line_templates as L
from llm_helpers import prose


def brute(texts, depth=3, min_tokens=5, block_tokens=12):
    """(text kept, lines dropped) by text; ids are places."""
    def keys(line):
        exact = line.strip(" \t\n\x0b\f\r")
        if not exact:
            return []
        spaced = regex.sub(r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])", r" \1 ", line)
        enough = lambda some: 2 * sum(x != "<*>" for x in some) >= len(some)
        t = re.split(r"[ \t\n\x0b\f\r]+", re.sub(r"^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$", "", re.sub(
            r"[^ \t\n\x0b\f\r]*[0-9][^ \t\n\x0b\f\r]*", "<*>", spaced)))
        if len(t) < min_tokens or not enough(t):
            return [exact]
        out = [(len(t), tuple(t))]
        if len(t) >= block_tokens:
            s = -(-(len(t) - depth) // 4)
            out += [(len(t), j, tuple(a), tuple(b)) for j in range(4) for a, b in [(t[:depth + s * j], t[depth + s * (j + 1):])] if enough(a + b)]
        return out

    first = {}
    for i, text in enumerate(texts):
        for line in (text or "").split("\n"):
            for k in keys(line):
                first.setdefault(k, i)
    out = []
    for i, text in enumerate(texts):
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if all(first[k] == i for k in keys(x))]
        out.append((None if text is None else "\n".join(kept), len(lines) - len(kept)))
    return out


def check(docs, texts):
    got = L.drop_recurring(docs(texts, extra=True))
    assert got.columns[:2] == ["doc_id", "text"] and got.columns[-2:] == ["n_lines", "n_dropped"]
    assert [(r.text, r.n_dropped) for r in sorted(got.collect())] == brute(texts)


def test_brute_force(docs, rng):
    shared = [prose(rng, int(n)) for n in rng.integers(2, 60, 20)]
    texts = []
    for _ in range(80):
        lines = [prose(rng, int(rng.integers(1, 30))) for _ in range(int(rng.integers(0, 5)))]
        for line in rng.choice(shared, int(rng.integers(0, 4))):
            words = line.split()
            if rng.random() < 0.5:
                words[int(rng.integers(len(words)))] = str(rng.choice(["changed", "7 days", "id42"]))
            lines.insert(int(rng.integers(len(lines) + 1)), " ".join(words))
        texts.append("\n".join(lines))
    check(docs, texts)


def test_awkward(docs, awkward):
    check(docs, awkward)
    assert L.drop_recurring(docs([])).count() == 0


def test_variable_fields(docs):
    line = "Posted on {} by the editors of our weekly news letter for all the readers"
    texts = [line.format("2024-01-05"), line.format("3 May"), "own text of this document\n" + line.format("2023-11-30")]
    got = {r.doc_id: (r.text, r.n_dropped) for r in L.drop_recurring(docs(texts)).collect()}
    assert got[0][1] == 0 and got[2] == ("own text of this document", 1)


def test_repeated_ids_are_one_document(docs):
    rows = [(4, "the very same line of text"), (4, "the very same line of text"), (None, "the very same line of text")]
    got = sorted((r.doc_id is None, r.n_dropped) for r in L.drop_recurring(docs(rows)).collect())
    assert got == [(False, 0), (False, 0), (True, 1)]


def test_main_path_is_native(docs):
    plan = L.drop_recurring(docs(["a b c d e"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_no_line_is_too_short(docs, rng):
    han = "".join(map(chr, rng.integers(0x4E00, 0x9F00, 40)))
    texts = [f"first own line\nAll rights reserved.\n\nPage 3\n{han}", f"second one\n All rights reserved. \n\nPage 7\n{han[:20]}変変{han[22:]}", "Page 3\n" + han]
    got = sorted((r.doc_id, r.text) for r in L.drop_recurring(docs(texts)).collect())
    assert got == [(0, texts[0]), (1, "second one\n\nPage 7"), (2, "")]
    assert [t for t, _ in brute(texts)] == [t for _, t in got]


def test_rows_of_numbers_stay(docs):
    """Number tables of clean documents stay; an equal row, and a line with enough constant tokens, still goes."""
    line = "Posted on {} by the editors of our weekly news letter for all the readers"
    half = "a b c d e f g 8 9 10 11 12 13 14"  # constant in half its places, but not without its first block
    texts = ["12 15 18 20 22\n1 2 3 4 5\n" + line.format("2024-01-05") + "\n" + half, "31 7 9 11 40\n" + line.format("3 May"),
             "1 2 3 4 5\nown\n" + line.format("2023-11-30") + "\n" + half.replace("d e f", "x y z")]
    got = {r.doc_id: r.text for r in L.drop_recurring(docs(texts)).collect()}
    assert [t for t, _ in brute(texts)] == [got[i] for i in range(3)]
    assert got == {0: texts[0], 1: texts[1], 2: "own\n" + half.replace("d e f", "x y z")}
