"""Conversation repair against a plain programme over whole texts."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from meshtally.llm import conversation
from meshtally.llm.queries import CONVERSATIONS_SQL

SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies int, seg string, symbols string"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def plain(rows):
    """rows of one conversation (turn, role, text) in order: cost, audit and repaired lines, from the end backwards."""
    seen, faults = set(), []
    for _, role, text in rows:
        kind = ("blank" if not text.strip(" \t\n\x0b\f\r") else "duplicate" if (role, text) in seen
                else "truncated" if text.rstrip(" \t\n\x0b\f\r")[-1] not in ".!?" else "")
        faults.append(kind)
        seen.add((role, text))
    best = {0: (0, "", []), 3: (0, "", []), 2: (2, "I", ["assistant:"]), 1: (4, "II", ["user:", "assistant:"])}
    for (_, role, text), fault in zip(rows[::-1], faults[::-1]):
        ways = {q: [(3 + best[q][0], "D" + best[q][1], best[q][2])] for q in range(4)}
        for q in range(4):
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                wish = "a" if q == 2 else "u"
                for cost, letter, to, name in ((2, "R", wish, {"a": "assistant", "u": "user"}[wish]), (0, "K", role[:1], role)):
                    if (q, to) in NEXT:
                        c, a, lines = best[NEXT[q, to]]
                        ways[q].append((cost + extra + c, letter + a, [f"{name}:{text}", *lines]))
        now = {q: min(w) for q, w in ways.items()}
        for _ in range(4):
            for q in range(4):
                wish = "a" if q == 2 else "u"
                c, a, lines = now[NEXT[q, wish]]
                now[q] = min(now[q], (c + 2, "I" + a, [{"a": "assistant:", "u": "user:"}[wish], *lines]))
        best = now
    initials = [r[1][:1] for r in rows]
    turns = {r[0] for r in rows} - {None}
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": best[0][0], "audit": best[0][1],
            "repaired_sha256": hashlib.sha256("\n".join(best[0][2]).encode()).hexdigest()}


def conversations(seed=5):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(60), None]:
        n = 400 if conv == 7 else rng.randint(1, 14)
        for t in range(n):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"])
            text = rng.choice(["Yes.", "No", "", " \n", None, f"so {t}.", f"then {t}", "é！ well?", "x" * 50 + ".", "ok! \t"])
            turn = rng.choice([t, t, t, t + 1, None])
            rows.append((conv, turn, role, text, rng.choice([1, 1, 1, 2, 5]), "clash", None))
    rows += [(7, 3, "user", "over and over.", 1, None, None)] * 300  # one row, many times
    rows.append((8, 99, "assistant", "very long. " * 60000, 1, None, None))
    return rows


def expected(rows):
    groups = {}
    for conv, turn, role, text, copies, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups.setdefault(conv, []).extend([(turn, role, text)] * copies)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest())
    return {c: plain(sorted(g, key=order)) for c, g in groups.items()}


@pytest.mark.parametrize("slice_rows", [5, 1 << 16])
def test_repair_equals_the_plain_programme(spark, slice_rows):
    rows = conversations()
    found = conversation.repair(spark.createDataFrame(rows, SCHEMA).repartition(3), copies=F.col("copies"), slice_rows=slice_rows)
    got = {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in found.collect()}
    assert got == expected(rows)


def test_grammar_is_shared_and_exact():
    rng = random.Random(1)
    seqs = list({bytes(rng.choice([1, 2, 1, 2, 0, 5, 8]) for _ in range(rng.randint(1, 30))) for _ in range(300)})
    seqs += [bytes([1, 2]) * 500, bytes([8]) * 777]
    grammar = conversation.Grammar(seqs)

    def spelt(r):
        return bytes([r]) if r < 9 else b"".join(map(spelt, grammar.rules[r - 9]))

    assert [spelt(r) for r in grammar.roots] == seqs
    assert len(grammar.rules) < sum(map(len, seqs)) / 2


def test_report_equals_the_sql_and_keeps_lost_conversations(spark, tmp_path):
    rows = [(c, t, r, x) for c, t, r, x, *_ in conversations(9)] + [(c, 0, "user", "Alone.") for c in range(1000, 1100)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame.write.parquet(f"{tmp_path}/c")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    found = conversation.report(spark.read.parquet(f"{tmp_path}/c"))
    want = con.sql(f"SELECT {', '.join(found.columns)} FROM ({CONVERSATIONS_SQL})").fetchall()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert any(r[-2] == "" for r in want)
    assert conversation.report(frame.limit(0)).count() == 0
