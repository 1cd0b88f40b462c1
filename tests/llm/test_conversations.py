"""Operator 13 against a plain recursion over all edits."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from tastegraph.llm import conversations as C
from tastegraph.llm import queries as Q
from tastegraph.llm.common import table

SF = "/root/testdata/sf0.001"
PATTERN = re.compile("(s?(ua)+)?")


def ordered(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], hashlib.sha256(r[2].encode()).digest())
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=key)


def brute(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of (turn, role, text) rows."""
    rows, seen, fault = ordered(rows), set(), []
    for _, role, text in rows:
        fault.append("blank" if not text.strip(" \t\n\v\f\r") else "duplicate" if (role, text) in seen
                     else "truncated" if text.strip(" \t\n\v\f\r")[-1] not in ".!?" else "")
        seen.add((role, text))
    best = [None] * (len(rows) + 1)  # (cost, audit, lines) to go by state: nothing, after s, u, a
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    for i in range(len(rows), -1, -1):
        now = {}
        for state in follows:
            options = []
            if i == len(rows):
                if state in ("", "a"):
                    options.append((0, "", ()))
            else:
                _, role, text = rows[i]
                c, a, lines = best[i + 1][state]
                options.append((4 + c, "D" + a, lines))
                if fault[i] not in ("blank", "duplicate"):
                    late = 3 * (fault[i] == "truncated")
                    to = [follows[state]] + ["s"] * (state == "")
                    if role[:1] in to:
                        c, a, lines = best[i + 1][role[:1]]
                        options.append((late + c, "K" + a, (f"{role}:{text}", *lines)))
                    c, a, lines = best[i + 1][follows[state]]
                    options.append((3 + late + c, "R" + a, (f"{name[follows[state]]}:{text}", *lines)))
            now[state] = options
        done = {s: min(o, default=(10 ** 9, "", ())) for s, o in now.items()}
        for _ in range(6):
            for s, nxt in follows.items():
                c, a, lines = done[nxt]
                done[s] = min(done[s], (3 + c, "I" + a, (f"{name[nxt]}:", *lines)))
        best[i] = done
    cost, audit, lines = best[0][""]
    assert PATTERN.fullmatch("".join(x[0] for x in lines))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        spaced = lambda x: " " if x is None else x
        code = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = "user" if code == 4 else spaced(role), spaced(text)
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def expected(original, rows):
    by = collections.defaultdict(list)
    for conv, *r in rows:
        by[conv].append(r)
    return {c: brute(by[c]) for c in {r[0] for r in original}}


def found(df):
    rows = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(Q.op13_conversation_repair(spark, SF)) == expected(rows, damaged(rows))


SAID = ["Yes.", "no", "", " \n", "What?", "more\n", "Fine! ", "Long " * 20 + ".", "ok"]
WHO = ["system", "user", "assistant", "tool", "", "s", None]


def conversation(rng, n):
    return [(rng.choice([None, rng.randint(-2, n)]) if rng.random() < 0.3 else i, rng.choice(WHO[:3] if rng.random() < 0.8 else WHO),
             rng.choice([*SAID, None]) if rng.random() < 0.5 else f"Turn {i}.") for i in range(n)]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1024])
def test_any_blocks_give_the_same(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rng = random.Random(block)
    rows = [(c, *r) for c in [None, *range(12)] for r in conversation(rng, rng.choice([1, 2, 3, 5, 9]))]
    rows += [(99, *r) for r in conversation(rng, 60)]                      # one long conversation
    rows += [(100, None, "assistant", "same.")] * 25                       # all copies of one row: nothing converges
    rows += [(101, i, "assistant", "") for i in range(25)]                 # blank throughout
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert found(C.report(df, df)) == expected(rows, rows)


def test_repaired_lines(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "cut"), (2, 0, "assistant", "A."), (3, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = [tuple(r) for r in C.repaired(df).orderBy("conv_id", "line").collect()]
    want = expected(rows, rows)
    for c in (1, 2, 3):
        lines = [f"{r[2]}:{r[3]}" for r in got if r[0] == c]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == want[c][-1]
    assert [r[1] for r in got if r[0] == 2] == [0, 1]


def test_no_rows_clashing_columns_and_dropped_conversations(spark):
    schema = "conv_id string, turn long, role string, text string, pos string, block int, kind string, edit string, lead int"
    empty = spark.createDataFrame([], schema)
    assert found(C.report(empty, C.damage(empty))) == {}
    rows = [("x", i, "user" if i % 2 == 0 else "assistant", f"Say {i}.", "p", 1, "k", "e", 2) for i in range(30)]
    df = spark.createDataFrame(rows, schema)
    assert found(C.report(df, df.limit(0))) == {"x": (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    plain = [r[:4] for r in rows]
    assert found(C.report(df, C.damage(df))) == expected(plain, damaged(plain))


def test_vectors_are_few():
    assert C.VECTORS[0] == C._relative(C._END) and len(C.VECTORS) < 64
