"""Conversation repair against a row-by-row dynamic program over whole audits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from blotter.llm.common import prepare
from blotter.llm.repair import damaged_turns, least_audits, repaired_conversations

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = "conv_id long, turn long, role string, text string, block string, state long"


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    prepare(spark)


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def _expected(rows):
    damaged = _damaged(rows)
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in damaged if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in mine:
            tail = text.rstrip(SPACE)
            fault = "blank" if not tail else "dup" if (role, text) in seen else "" if tail[-1] in ".!?" else "cut"
            seen.add((role, text))
            faults.append(fault)
        # state -> (cost, audit, lines)
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}
        name = {"u": "user", "a": "assistant"}

        def inserted(states):
            best = dict(states)
            for _ in range(2):
                for state, (cost, audit, lines) in list(best.items()):
                    to = follow[state]
                    new = (cost + 5, audit + "I", [*lines, name[to] + ":"])
                    if to not in best or new[:2] < best[to][:2]:
                        best[to] = new
            return best

        states = inserted({"": (0, "", [])})
        for (_, role, text), fault in zip(mine, faults, strict=True):
            after = {}
            for state, (cost, audit, lines) in states.items():
                ways = [(state, 2, "D", [])]
                if fault not in ("blank", "dup"):
                    extra = 5 if fault == "cut" else 0
                    to = follow[state]
                    ways.append((to, 1 + extra, "R", [f"{name[to]}:{text}"]))
                    if role[:1] == to or (role[:1] == "s" and state == ""):
                        ways.append((role[:1], extra, "K", [f"{role}:{text}"]))
                for to, price, letter, more in ways:
                    new = (cost + price, audit + letter, lines + more)
                    if to not in after or new[:2] < after[to][:2]:
                        after[to] = new
            states = inserted(after)
        cost, audit, lines = min((v for k, v in states.items() if k in ("", "a")), key=lambda v: v[:2])
        turns = [t for t, _, _ in mine if t is not None]
        initials = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out.append((
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("blank"), faults.count("dup"), faults.count("cut"), illegal,
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def _rows(n_conversations, most, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n_conversations):
        for turn in range(rng.randrange(most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "s", "unknown"])
            text = rng.choice(["Yes.", "no", "A thing!", " \n", "", None, f"said {turn}?", "é…. ", f"open {rng.random()}"])
            rows.append((conv, rng.choice([turn, turn, turn, turn // 2, None, turn * 3]), role, text))
    return rows


def _got(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], COLUMNS).repartition(5)
    return sorted((tuple(r) for r in repaired_conversations(damaged_turns(df), **more).collect()), key=str)


@pytest.mark.parametrize("block_rows", [1024, 3, 1])
def test_repairs_equal_brute_force(spark, block_rows):
    rows = _rows(120, 14, block_rows) + [(None, 1, "user", "No id."), (None, None, None, None), (-7, 5, "assistant", "x" * 300_000)]
    rows += [(1000, 1, "user", "The same.")] * 40 + [(1001, None, None, None)] * 3
    assert _got(spark, rows, block_rows=block_rows) == _expected(rows)


def test_long_conversation_over_many_blocks(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "user", "tool"]), rng.choice(["Fine.", "cut off", f"Text {t}."])) for t in range(900)]
    assert _got(spark, rows, block_rows=64) == _got(spark, rows) == _expected(rows)


def test_dropped_conversation_and_empty_table(spark):
    gone = [(c, t, "user", "Hello.") for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:5]
    empty = hashlib.sha256(b"").hexdigest()
    assert _got(spark, gone) == sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c in {g[0] for g in gone}), key=str)
    assert repaired_conversations(damaged_turns(spark.createDataFrame([], COLUMNS))).count() == 0


def test_ranks_choose_the_ascii_least_audit():
    import numpy as np

    # two kept assistants in a row: delete either one, or insert or reroll; "D" first is least
    codes = [np.array([1, 2, 2, 1, 2], dtype=np.uint8), np.zeros(0, dtype=np.uint8)]
    audits, ends, cost = least_audits(codes, np.array([[0, 10, 5, 0], [0, 10, 5, 0]]))
    assert audits[0][0] == b"KDKKK" and ends[0][0] == 3 and cost[0][0] == 2
    assert audits[1] == [b"", b"", b"", b""] and list(ends[1]) == [0, 1, 2, 3]
