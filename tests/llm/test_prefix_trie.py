"""The prefix trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from blotter.llm.common import prepare
from blotter.llm.prefix_trie import SECTION, prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string, section long, depth string"
FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    prepare(spark)


def _order(row):
    _, turn, role, text = row
    role, text = (role or "").encode(), (text or "").encode()
    return (turn is not None, turn or 0, hashlib.md5(str(len(role)).encode() + b":" + role + text).hexdigest())


def _expected(rows):
    logged = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=_order):
        logged[row[0]].append((row[2] or "", row[3] or ""))
    rebuilt = {}
    for c, own in logged.items():
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own if base == c else logged.get(base, [])[:h] + own[h:]
    # a prefix is named by the chain of names below it
    members, parent, size, ends, children = defaultdict(list), {}, {}, defaultdict(list), defaultdict(set)
    names = {}
    for c, turns in rebuilt.items():
        at = 0
        members[0].append(c)
        for turn in turns:
            new = names.setdefault((at, turn), len(names) + 1)
            parent[new], size[new] = at, len(turn[1].encode())
            children[at].add(new)
            members[new].append(c)
            at = new
        ends[at].append(c)
    if not members:
        return []
    depth, leaves, saved = {0: 0}, {}, {}
    for node in sorted(members):
        if node:
            depth[node] = depth[parent[node]] + 1
    for node in sorted(members, key=lambda n: -depth[n]):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * size.get(node, 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (
            min(members[n]), depth[n], min(members[parent[n]]) if n else None, len(members[n]), len(children[n]),
            leaves[n], saved[n], sha(ends[n]),
        )
        for n in members
    )


def _got(spark, rows, partitions=5):
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], COLUMNS).repartition(partitions)
    return sorted(tuple(r[c] for c in FIELDS) for r in prefix_trie(df).collect())


def test_trie_equals_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for c in [*range(-12, 260), 1001, 1003]:
        for t in range(rng.randrange(14)):
            rows.append((c, rng.choice([t, t, t // 2, None]), rng.choice(["u", "a", None, ""]), rng.choice(["x", "yé", "", None, "long " * 9])))
    rows += [(None, 1, "u", "no id"), (2000, 1, "u", "z" * 400_000), (2000, 1, "u", "z")] + [(2005, 3, "u", "same")] * 30
    assert _got(spark, rows) == _expected(rows)


def test_copies_and_snapshots_over_many_sections(spark):
    """Exact copies, snapshots cut at every length, and forks, all deeper than a section."""
    base = [("u", f"turn {t}" * (t % 4)) for t in range(3 * SECTION + 7)]
    rng = random.Random(4)
    rows = []
    lengths = [len(base)] * 40 + list(range(1, len(base), 3)) + [SECTION - 1, SECTION, SECTION + 1, 2 * SECTION]
    for k, n in enumerate(lengths):
        turns = base[:n]
        if k % 4 == 3:
            turns = turns + [("a", f"fork {rng.randrange(3)}")] * rng.randrange(1, SECTION + 3)
        # multiples of five keep their own turns
        rows += [(5 * k, t, role, text) for t, (role, text) in enumerate(turns)]
    assert _got(spark, rows) == _expected(rows)


def test_forests_merge_over_many_partitions(spark):
    """More partitions than one round merges, so contracted forests are contracted again."""
    rng = random.Random(6)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    rows = []
    for c in range(0, 3000, 5):
        copied = c % 3 == 0
        for t in range(6 if copied else rng.randrange(1, 7)):
            rows.append((c, t, "u", f"{t}" if copied or rng.random() < 0.6 else f"{t} {rng.randrange(4)}"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "150")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = _got(spark, rows)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert got == _expected(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert prefix_trie(spark.createDataFrame([], COLUMNS)).count() == 0
    # conversations shorter than the turns they lose, below a base that is absent
    short = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:30]
    rows = [(c, 1, "u", "only") for c in short]
    assert _got(spark, rows) == _expected(rows)
    assert len(_expected(rows)) == 1
