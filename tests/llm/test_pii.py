"""Personal data: base spans against Python's re, and what the trees add to them."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from blotter.llm import pii
from blotter.llm.common import prepare, read
from blotter.llm.queries import QUERIES
from tests.conftest import SMOKE_DIR

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
COLUMNS = "doc_id long, text string, spans string, kind int, label int"


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    prepare(spark)


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def _base(text):
    found = [
        (m.start(), pii.KINDS.index(kind), m.end(), m.group())
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text or "")
        if _valid(kind, m.group())
    ]
    return sorted(found)


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, 0) for i, t in rows], COLUMNS)


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(1)
    bits = ["a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.2.3.004", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+1 (555) 123-4567", "+49.30.1234567", "+1", "++12", "é", "𝕏", "-", "_", " ", ".", "9" * 17, "word", "\n", "(", "a@b.c_d@e.f", "%"]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randrange(25)))) for k in range(1500)]
    rows += [(None, None), (7, ""), (7, "z@y.xx"), (7, "z@y.xx"), (9001, "a" * 3000 + "@b.cc"), (9002, "7" * 3000), (9003, "x." * 2000),
             (9004, "a@b" + ".c" * 2000), (9005, "5.6.7.8 and " * 2000), (9006, "+1 555 123 4567; " * 500)]
    got = pii.personal_data(_docs(spark, rows)).collect()
    want = sorted(((i, _base(t)) for i, t in rows), key=lambda r: (str(r[0]), len(r[1]), r[1]))
    have = sorted(((r["doc_id"], [(s["start"], s["kind"], s["end"], s["value"]) for s in r["base"]]) for r in got), key=lambda r: (str(r[0]), len(r[1]), r[1]))
    assert have == want
    for r in got:
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))


def test_very_long_texts_take_linear_time(spark):
    n = 300_000
    texts = ["a" * n + "@b.cc", "7" * n, "x." * n, "a@b" + ".c" * n, "5.6.7.8 and " * 20_000, "+1 555 123 4567; " * 5000, "1-" * n + "1"]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["base"]] for r in pii.personal_data(_docs(spark, list(enumerate(texts)))).collect()}
    assert got[0] == [(0, n + 5)] and got[1] == got[2] == got[6] == [] and got[3] == [(0, 2 * n + 3)]
    assert got[4] == [(12 * k, 12 * k + 7) for k in range(20_000)]
    assert got[5] == [(17 * k, 17 * k + 15) for k in range(5000)]


def _corpus(rng, n):
    words = "the of and to in that is was he for it with as his on be at by had not are but from or have".split()
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    rows = []
    for k in range(n):
        bit = rng.choice([
            rng.choice([
                f"call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
                f"tel +{rng.randrange(20, 99)} {rng.randrange(100, 999)} {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}",
                f"phone +{rng.randrange(100, 999)} {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}",
            ]),
            f"mail ann.{k}@mail{k % 9}.example.com",
            f"host {rng.randrange(1, 255)}.{rng.randrange(255)}.{rng.randrange(255)}.{rng.randrange(1, 255)}",
            f"version {rng.randrange(9)}.{rng.randrange(300, 999)}.{rng.randrange(99)}.{rng.randrange(400, 999)}",
            f"order {rng.randrange(10**15, 10**16)}",
            f"card {_card(rng)}",
            " ".join(str(rng.randrange(100, 9999)) for _ in range(5)),
            f"{rng.randrange(10, 99)} {rng.randrange(100, 999)}-{rng.randrange(10)} {rng.randrange(10, 99)}",
            f"date {rng.randrange(1990, 2030)}-{rng.randrange(1, 12):02d}-{rng.randrange(1, 28):02d}",
        ])
        rows.append((k, f"{text(8)} {bit} {text(8)}"))
    return rows


def _card(rng):
    body = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(body + str(d) for d in range(10) if _luhn(body + str(d)))


def test_looser_forms_are_added_and_impossible_ones_are_not(spark):
    rng = random.Random(8)
    rows = _corpus(rng, 2500)
    card = _card(rng)
    spaced = ".".join(card[k : k + 4] for k in range(0, 16, 4))
    broken = spaced[:-1] + str((int(spaced[-1]) + 1) % 10)
    planted = {
        100_001: ("write to ann.lee (at) mail3 [dot] example dot com now", {0}),
        100_002: (f"card {spaced} please", {2}),
        100_003: ("call (482) 555-7163 now", {3}),
        100_004: ("host 10[.]20[.]30[.]40 up", {1}),
        100_005: (f"card {broken} please", set()),
        100_006: ("date 2024-05-17 or 17.05.2024 at noon", set()),
        100_007: ("nothing of the kind is here", set()),
        100_008: ("look at the home. The end", set()),
    }
    docs = _docs(spark, rows + [(i, t) for i, (t, _) in planted.items()])
    found = {r["doc_id"]: {s["kind"] for s in r["spans"]} for r in pii.personal_data(docs).collect()}
    assert {i: found[i] for i in planted} == {i: kinds for i, (_, kinds) in planted.items()}


def test_no_labels_and_empty_table(spark):
    assert pii.personal_data(_docs(spark, [])).count() == 0
    rows = pii.personal_data(_docs(spark, [(1, "no data"), (2, None)])).collect()
    assert [(list(r["base"]), list(r["spans"])) for r in rows] == [([], []), ([], [])]


def test_boosting_tells_a_conjunction():
    cells = [((a, b) + (0,) * (len(pii.FEATURES) - 2), 0 if a and b else 50, 50 if a and b else 0) for a in (0, 1) for b in (0, 1)]
    bias, trees = pii.fitted_trees(cells)
    score = lambda row: bias + sum(pii._value(t, row) for t in trees)
    assert all((score(row) > 0) == (p > 0) for row, _, p in cells)
    assert pii.fitted_trees([(cells[0][0], 0, 9)])[1] == []


def test_every_labelled_span_counts(spark, monkeypatch):
    seen = []
    fitted, threshold = pii.fitted_trees, pii._threshold
    monkeypatch.setattr(pii, "fitted_trees", lambda cells: seen.extend(cells) or fitted(cells))
    monkeypatch.setattr(pii, "_threshold", lambda bias, trees, cells: seen.extend(cells) or threshold(bias, trees, cells))
    feature = lambda k: ",".join([str(k), *["0"] * (len(pii.FEATURES) - 1)])
    span = lambda k, label, f: f"named_struct('kind', {k}, 'start', id, 'end', id + 1, 'value', '', 'label', {label}, 'f', array({f}))"
    rows = spark.range(8000).selectExpr(
        "id AS doc_id", f"array({span(2, 0, feature(1))}, {span(2, 1, feature(2))}, {span(3, 1, 'cast(id AS int) % 4, ' + feature(0)[2:])}) AS spans"
    )
    pii.fitted_model(rows)
    assert sum(c[1] for c in seen) == 8000 and sum(c[2] for c in seen) == 16_000


def test_query_columns(spark):
    texts = {r["doc_id"]: r["text"] for r in read(spark, SMOKE_DIR, "documents").collect()}
    for r in QUERIES["op12_personal_data"](spark, SMOKE_DIR).collect():
        spans = _base(texts[r["doc_id"]])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert set(joined.split(",")) <= set(r["spans"].split(",")) or not joined
