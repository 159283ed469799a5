"""Conversation repair against plain dynamic programming over whole conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from rosterforge.llm import conversations, queries

GRAMMAR = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
SCHEMA = "conv_id long, turn long, role string, text string"


def best_edits(turns):
    """((cost, audit), the repaired turns) by recursion over (turn, state, inserts in a row)."""

    @lru_cache(None)
    def go(i, state, inserted):
        found = []
        if i == len(turns) and state in ("", "a"):
            found.append((0, "", ()))
        name = {"u": "user", "a": "assistant"}
        if inserted < 2:
            for r in "ua":
                if r in GRAMMAR[state]:
                    c, e, out = go(i, r, inserted + 1)
                    found.append((c + 2, "I" + e, ((name[r], ""), *out)))
        if i < len(turns):
            role, text, fault = turns[i]
            c, e, out = go(i + 1, state, 0)
            found.append((c + 3, "D" + e, out))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                for cost, edit, to in [(0, "K", role), (2, "R", "user"), (2, "R", "assistant")]:
                    if to[:1] in GRAMMAR[state]:
                        c, e, out = go(i + 1, to[0], 0)
                        found.append((c + cost + more, edit + e, ((to, text), *out)))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "~", ())

    return go(0, "", 0)


def expected(rows):
    by, ids = defaultdict(list), {r[0] for r in rows}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        by[conv] += [] if kind == 0 else [row] * (1 + (kind == 3))
    out = {}
    for conv in ids:
        got = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, turns = set(), []
        for _, role, text in got:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            turns.append((role, text, fault))
        cost, audit, kept = best_edits(tuple(turns))
        known = [t for t, *_ in got if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, *(sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def found(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def random_rows(n, seed):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Über"]
    texts = ["Yes.", "No", "", " \n", None, "why?", "end!  ", "a. b", "日本.", ". x"]
    return [(r.choice([None, *range(12)]), r.choice([None, -3, 2**40, *range(9)]), r.choice(roles), r.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("block_bits", [12, 1])
def test_random_conversations(spark, block_bits):
    rows = random_rows(400, block_bits)
    got = found(conversations.repair_report(spark.createDataFrame(rows, SCHEMA).repartition(3), block_bits))
    assert got == expected(rows)


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op12_conversation_repair(spark, sf)) == expected(rows)


def test_one_long_conversation_of_equal_rows_and_no_rows_at_all(spark):
    many = spark.range(30_000).selectExpr("1L conv_id", "id % 3 turn", "'user' role", "'Same.' text", "'x' pos", "'y' kind")
    got = conversations.repair(many)
    assert [r.asDict() for r in got.report.collect()] == [dict(conv_id=1, gaps=0, blank=0, duplicate=29_999, truncated=0, illegal=29_999, cost=3 * 29_999 + 2)]
    ((_, audit, sha),) = conversations.digest(got.turns).collect()
    assert audit == "K" + "D" * 29_999 + "I" and sha == hashlib.sha256(b"user:Same.\nassistant:").hexdigest()
    assert conversations.repair_report(many.limit(0)).count() == 0


def test_turns_are_given_back(spark):
    rows = [(1, 1, "system", "Be kind."), (1, 2, "user", "Hi."), (1, 3, "user", "Hi."), (1, 4, "assistant", "Yes"), (1, 5, "bot", "So.")]
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA)).turns.orderBy("seq").collect()
    assert [(r["edit"], r["role"], r["text"]) for r in got] == [("K", "system", "Be kind."), ("K", "user", "Hi."), ("D", "user", "Hi."), ("K", "assistant", "Yes"), ("D", "bot", "So.")]
