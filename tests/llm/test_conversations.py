import functools
import hashlib
import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from roadlens.llm import conversations as C
from roadlens.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string, cost string, part int"
SPACE = " \t\n\x0b\f\r"


def word(x):
    return " " if x is None else str(x)


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = word(role), word(text)
        case = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        text = "" if case == 1 else "".join(c for c in text if c not in ".!?") if case == 2 else text
        for _ in range({0: 0, 3: 2}.get(case, 1)):
            yield conv, turn, "user" if case == 4 else role, text


def plain(rows):
    """Counts, cost, audit and repaired lines of one conversation's (turn, role, text), by trying every edit."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        tail = text.rstrip(SPACE)
        faults.append("b" if not tail else "d" if (role, text) in seen else "t" if tail[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, q, puts):
        found = [(0, "", ())] if i == len(rows) and q in ("", "a") else []
        for role in ("user", "assistant") if puts < 4 else ():
            if (q, role[0]) in step:
                c, s, out = best(i, role[0], puts + 1)
                found.append((c + 3, "I" + s, (f"{role}:", *out)))
        if i < len(rows):
            _, role, text = rows[i]
            c, s, out = best(i + 1, q, 0)
            found.append((c + 4, "D" + s, out))
            if faults[i] not in ("b", "d"):
                for letter, cost, new in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                    if (q, new[:1]) in step:
                        c, s, out = best(i + 1, new[:1], 0)
                        found.append((c + cost + 3 * (faults[i] == "t"), letter + s, (f"{new}:{text}", *out)))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (gaps, *(faults.count(x) for x in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows, damaging=True):
    by = {r[0]: [] for r in rows}
    for conv, *rest in damaged(rows) if damaging else [(c, t, word(r), word(x)) for c, t, r, x in rows]:
        by[conv].append(tuple(rest))
    return sorted(((conv, *plain(mine)) for conv, mine in by.items()), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)


def test_query(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(Q.QUERIES["op12_run_length"](spark, sf)) == expected(rows)


@pytest.fixture
def wild(rng):
    """Conversations of every shape: null turns, equal turns, odd roles, blank, repeated and open texts."""
    roles, texts = ["system", "user", "assistant", "tool", "", None, "unknown"], ["a.", "b", " \n", None, "", "Why? ", "a.", "c!\x0b", "é…"]
    rows = []
    for conv in range(120):
        for turn in range(int(rng.integers(1, 9))):
            t = [None, turn, turn, turn // 2, 2 * turn][int(rng.integers(5))]
            rows.append((conv, t, roles[int(rng.integers(7)) if rng.random() < 0.4 else int(rng.integers(3))], texts[int(rng.integers(9))]))
    return rows + rows[:30] + [(None, None, None, None), (None, 1, "user", "x."), (None, 2, "assistant", "y.")]


def test_awkward_against_every_edit(spark, wild):
    df = made(spark, wild)
    assert got(C.audits(C.damage(df))) == expected(wild)
    assert got(C.audits(C.messages(df))) == expected(wild, False)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_conversations_that_cross_partitions(spark, partitions, rng):
    """One conversation with a third of all rows; texts of it repeat in far partitions."""
    rows = [(1, int(t), ["user", "assistant", "system"][int(rng.integers(3))], f"text {int(rng.integers(40))}" + "." * int(rng.integers(2)))
            for t in rng.permutation(60)]
    rows += [(1, 5, "user", "text 1.")] * 12 + [(int(c), int(t), "user", "q?") for c in range(2, 40) for t in range(3)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = C.messages(made(spark, rows))
        assert got(C.audits(df)) == expected(rows, False)
        out = C.repaired(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    mine = sorted((r["part"], r["place"], r["edit"], r["role"], r["text"]) for r in out if r["conv_id"] == 1)
    want = next(x for x in expected(rows, False) if x[0] == 1)
    assert "".join(x[2] for x in mine) == want[-2]
    assert hashlib.sha256("\n".join(f"{x[3]}:{x[4]}" for x in mine if x[2] != "D").encode()).hexdigest() == want[-1]


def test_all_dropped_and_empty(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert got(C.audits(C.damage(made(spark, [(5, gone, "user", "x.")])))) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert got(C.audits(C.damage(made(spark, [])))) == []


def test_long_runs_by_powers(rng):
    """Runs advanced by powers and unrolled by halves equal single steps."""
    for _ in range(60):
        runs = C.collapsed((int(rng.integers(9)), int(rng.integers(1, 70))) for _ in range(3))
        single = [(s, 1) for s, n in runs for _ in range(n)]
        letters = [x for x, _ in C.walk(runs, 0, C.END)]
        assert letters == [x for x, _ in C.walk(single, 0, C.END)]
        assert C._before(C.matrix(runs), C.END) == C._before(C.matrix(single), C.END)


def test_very_long_text_is_hashed_whole(spark):
    text = "word " * 400_000 + "."
    rows = [(1, 0, "user", text), (1, 1, "assistant", text + "!")]
    assert got(C.audits(C.messages(made(spark, rows)))) == expected(rows, False)
