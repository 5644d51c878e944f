"""Personal data: generous generators propose spans, boosted trees on their form and context choose.

The base patterns find what is certain. Looser generators propose further spans of the same kinds:
spelled or spaced addresses, numbers without a country code, cards with other separators, defanged
addresses. What the base patterns confirm, and what no reading of a form allows (a failed check
digit, a part above 255, a date), are labels by themselves; boosted trees learn from them how a
kind's form and context look, without the marks that the base patterns ask for, and score the
proposals that no rule decides. Built-in functions only: the trees are fitted on the driver from
counts of equal feature rows, and scored as an expression.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import held_out, stored

#: Rounds, depth and step of the boosting, and the least weight of a leaf's curvature.
ROUNDS, DEPTH, STEP, LEAST = 12, 3, 0.5, 1.0
#: Each round leaves out every SKIP-th feature in turn, so that no single one decides alone.
SKIP = 3
#: Share of rightly chosen spans that a kind's threshold keeps on held-out labelled spans.
PRECISION = 0.95
#: Threshold of a kind for which no held-out span tells one.
UNTOLD = 0.5
#: Characters before a span that its context words are looked for in.
CONTEXT = 32
#: Neighbours, in order of start, that a span is compared with for overlap.
NEAR = 4

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Quantifiers are possessive and starts are bound to the start of a
# run where that changes no match, so that long runs take linear time and no deep recursion.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser generators.
LOOSE = {
    "email": (
        r"(?i)(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]{1,64}+"
        r"(?:\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20?＠\x20?|\x20@\x20?|@\x20|\x20at\x20(?=[A-Za-z0-9-]{1,63}\x20dot\x20))"
        r"[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[({<]\x20?(?:dot|\.)\x20?[\])}>]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}+){1,5}"
    ),
    "ip": (
        r"(?<![0-9.])[0-9]{1,3}(?:(?:\x20?[\[(]\x20?(?:\.|dot)\x20?[\])]\x20?|\x20\.\x20?|\.\x20|\x20dot\x20)[0-9]{1,3}){3}(?![0-9])"
    ),
    "card": r"(?<![0-9A-Za-z])[0-9]{4,6}(?:[\x20._/ -]{1,3}[0-9]{3,6}){2,4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.,/:-])(?:\((?=[0-9]))?[0-9]{2,5}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){2,4}(?![0-9A-Za-z])",
}
#: Words before a span, by what they announce.
WORDS = (
    r"(?i)\b(?:e-?mail|mail|mailto|contact|write to|correo|courriel)\b",
    r"(?i)\b(?:tel|phone|call|mobile|cell|fax|telefon|t[eé]l[eé]phone|tel[eé]fono|whatsapp)\b",
    r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|iban)\b",
    r"(?i)\b(?:ip|host|address|server|login|from)\b",
    r"(?i)\b(?:version|v|no|nr|id|ref|order|invoice|isbn|serial|section|chapter|date|on)\b",
)
#: Features of a span, in order.
FEATURES = ("digits", "groups", "first", "last", "luhn", "parts", "words", "left", "right", "letters", "brackets")
#: A year, month and day, or the other way around.
DATE = r"^(?:(?:19|20)[0-9]{2}[-./\x20][0-1]?[0-9][-./\x20][0-3]?[0-9]|[0-3]?[0-9][-./\x20][0-3]?[0-9][-./\x20](?:19|20)[0-9]{2})$"


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _running(column: str) -> str:
    """Running sums of an array, in log2(size) rounds."""
    return (
        f"aggregate(sequence(0, cast(ceil(log2(size({column}))) AS int)), {column}, (acc, k) -> "
        "transform(acc, (v, i) -> v + if(i >= shiftleft(1, k), acc[i - shiftleft(1, k)], 0)))"
    )


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    doubled = f"cast(substr({digits}, -i, 1) AS int) * (2 - i % 2)"
    return f"(aggregate(sequence(1, length({digits})), 0, (a, i) -> a + {doubled} - if({doubled} > 9, 9, 0)) % 10 = 0)"


def _all_small(parts: str) -> str:
    return f"forall({parts}, part -> cast(part AS double) <= 255)"


def _valid(kind: str, text: str) -> str:
    """What a base match must also be."""
    if kind == "ip":
        return _all_small(f"split({text}, '[.]')")
    if kind == "card":
        return f"if(length({_digits(text)}) BETWEEN 14 AND 19, {_luhn(_digits(text))}, false)"
    return f"length({_digits(text)}) BETWEEN 10 AND 15" if kind == "phone" else "true"


def _impossible(kind: str, text: str, digits: str, parts: str) -> str:
    """What no reading of a proposal allows."""
    if kind == "email":
        return f"NOT rlike({text}, '[A-Za-z]{{2,24}}$')"
    if kind == "ip":
        return f"NOT {_all_small(parts)}"
    if kind == "card":
        return f"if(length({digits}) BETWEEN 13 AND 19, NOT {_luhn(digits)}, true)"
    return f"(length({digits}) NOT BETWEEN 7 AND 15 OR rlike({text}, {_sql(DATE)}))"


def _spans(kind: str, found: str, pieces: str) -> str:
    """Structs of kind, start, end, value and the text around, of the matches ``found`` between
    ``pieces``; positions are code points."""
    ends = _running(f"zip_with({found}, slice({pieces}, 1, size({found})), (x, p) -> length(x) + length(p))")
    return f"""CASE WHEN size({found}) > 0 THEN transform(zip_with({found}, {ends}, (x, e) -> named_struct('x', x, 'e', e)),
      (m, i) -> named_struct('kind', {KINDS.index(kind)}, 'start', m.e - length(m.x), 'end', m.e, 'value', m.x,
        'digits', {_digits("m.x")}, 'parts', filter(split(m.x, '[^0-9]+'), y -> y <> ''),
        'before', right({pieces}[i], {CONTEXT}), 'after', left({pieces}[i + 1], 1)))
      ELSE array() END"""


def _char(text: str) -> str:
    return (
        f"CASE WHEN {text} = '' OR rlike({text}, '^[\\\\x20\\\\x09-\\\\x0D]') THEN 0 WHEN rlike({text}, '^[A-Za-z]') THEN 1 "
        f"WHEN rlike({text}, '^[0-9]') THEN 2 WHEN rlike({text}, '^[:=(<\"]') THEN 3 ELSE 4 END"
    )


def _features(s: str) -> str:
    """Features of a span as an array of small integers."""
    words = " ".join(f"WHEN rlike({s}.before, {_sql(w)}) THEN {k + 1}" for k, w in enumerate(WORDS))
    return f"""array(
      least(length({s}.digits), 20), least(size({s}.parts), 8),
      least(coalesce(length(get({s}.parts, 0)), 0), 6), least(coalesce(length(get({s}.parts, size({s}.parts) - 1)), 0), 6),
      CASE WHEN length({s}.digits) BETWEEN 12 AND 20 THEN if({_luhn(s + ".digits")}, 2, 1) ELSE 0 END,
      if({_all_small(s + ".parts")}, 1, 0),
      CASE {words} ELSE 0 END,
      {_char(f"right({s}.before, 1)")},
      {_char(f"{s}.after")},
      least(length(regexp_replace({s}.value, '[^A-Za-z]', '')), 12),
      if(rlike({s}.value, '[()]'), 1, 0))"""


def proposed_spans(docs: DataFrame) -> DataFrame:
    """doc_id and the base and proposed spans of every whole text, with label (1: the base pattern
    holds, 0: no reading allows it, null: open) and features. A narrow pass over the texts."""
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t"))
    patterns = {f"base_{k}": p for k, p in BASE.items()} | {f"loose_{k}": p for k, p in LOOSE.items()}
    found = texts.selectExpr("doc_id", "t", *(f"regexp_extract_all(t, {_sql(p)}, 0) AS {m}" for m, p in patterns.items()))
    split = found.selectExpr(
        "doc_id", *patterns, *(f"CASE WHEN size({m}) > 0 THEN split(t, {_sql(p)}, -1) END AS {m}_p" for m, p in patterns.items())
    )
    placed = split.selectExpr("doc_id", *(f"{_spans(m.split('_')[1], m, m + '_p')} AS {m}" for m in patterns))

    def labelled(name: str) -> str:
        group, kind = name.split("_")
        if group == "base":
            label = f"if({_valid(kind, 's.value')}, 1, 0)"
        else:
            label = f"if({_impossible(kind, 's.value', 's.digits', 's.parts')}, 0, cast(null AS int))"
        return f"""transform({name}, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'value', s.value,
          'label', {label}, 'f', {_features("s")}))"""

    return placed.selectExpr("doc_id", f"concat({', '.join(map(labelled, patterns))}) AS spans")


# --- boosted trees over counted feature rows ------------------------------------------------------


def _leaf(rows: list[tuple], gradients: list[float], curvatures: list[float]) -> float:
    return STEP * sum(gradients) / (sum(curvatures) + LEAST)


def _grown(rows: list[tuple], gradient: list[float], curvature: list[float], depth: int, features: list[int]):
    """A tree over feature rows: a leaf's value, or (feature, cut, below, above)."""
    total_g, total_h = sum(gradient), sum(curvature)
    here = total_g * total_g / (total_h + LEAST)
    best = (1e-6, None)
    if depth:
        for k in features:
            g, h = defaultdict(float), defaultdict(float)
            for row, a, b in zip(rows, gradient, curvature, strict=True):
                g[row[k]] += a
                h[row[k]] += b
            left_g = left_h = 0.0
            values = sorted(g)
            for low, high in zip(values, values[1:], strict=False):
                left_g, left_h = left_g + g[low], left_h + h[low]
                right_g, right_h = total_g - left_g, total_h - left_h
                gain = left_g**2 / (left_h + LEAST) + right_g**2 / (right_h + LEAST) - here
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (k, (low + high) / 2))
    if best[1] is None:
        return _leaf(rows, gradient, curvature)
    k, cut = best[1]
    sides = []
    for low in (True, False):
        at = [i for i, row in enumerate(rows) if (row[k] <= cut) == low]
        sides.append(_grown([rows[i] for i in at], [gradient[i] for i in at], [curvature[i] for i in at], depth - 1, features))
    return (k, cut, *sides)


def _value(tree, row: tuple) -> float:
    while isinstance(tree, tuple):
        k, cut, low, high = tree
        tree = low if row[k] <= cut else high
    return tree


def fitted_trees(cells: list[tuple[tuple, int, int]]) -> tuple[float, list]:
    """Bias and trees of a logistic boosting over (features, negatives, positives)."""
    negative, positive = sum(c[1] for c in cells), sum(c[2] for c in cells)
    bias = math.log((positive + 1) / (negative + 1))
    if not negative or not positive:
        return bias, []
    rows = [c[0] for c in cells]
    margin = [bias] * len(cells)
    trees = []
    for turn in range(ROUNDS):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        gradient = [c[2] * (1 - q) - c[1] * q for c, q in zip(cells, p, strict=True)]
        curvature = [(c[1] + c[2]) * q * (1 - q) for c, q in zip(cells, p, strict=True)]
        tree = _grown(rows, gradient, curvature, DEPTH, [k for k in range(len(FEATURES)) if (k + turn) % SKIP])
        trees.append(tree)
        margin = [m + _value(tree, r) for m, r in zip(margin, rows, strict=True)]
    return bias, trees


def _threshold(bias: float, trees: list, cells: list[tuple[tuple, int, int]]) -> float:
    """Half way, in log odds, from the lowest score down to which held-out spans are right often enough
    to the next lower one (half a span is added to the wrong ones, so that few spans do not tell)."""
    scored = defaultdict(lambda: [0, 0])
    for row, negative, positive in cells:
        at = scored[bias + sum(_value(t, row) for t in trees)]
        at[0] += negative
        at[1] += positive
    margins = sorted(scored, reverse=True)
    cut, wrong, right = None, 0.5, 0
    for k, margin in enumerate(margins):
        wrong, right = wrong + scored[margin][0], right + scored[margin][1]
        if right / (right + wrong) >= PRECISION:
            cut = (margin + margins[k + 1]) / 2 if k + 1 < len(margins) else -math.inf
    if cut is None:
        # no score is right often enough: only what scores above all of them
        cut = margins[0] + 1 if margins else -math.inf
    return max(UNTOLD, 1 / (1 + math.exp(-cut)) if cut > -700 else 0.0)


def fitted_model(proposed: DataFrame) -> dict[int, tuple[float, list, float]]:
    """Per kind its bias, trees and threshold. The trees learn from documents whose crc32 modulo 5 is
    not 0, thresholds come from the others. Every labelled span counts: equal feature rows, which are
    small integers and so few, arrive as one with the number of their spans."""
    spans = proposed.select("doc_id", F.explode("spans").alias("s")).where("s.label IS NOT NULL")
    cells = (
        spans.groupBy(held_out().alias("held"), F.col("s.kind").alias("kind"), F.col("s.f").alias("f"))
        .agg(F.count_if(F.col("s.label") == 0).alias("negative"), F.count_if(F.col("s.label") == 1).alias("positive"))
        .collect()
    )
    model = {}
    for k in range(len(KINDS)):
        of = lambda held: sorted((tuple(c["f"]), c["negative"], c["positive"]) for c in cells if c["kind"] == k and c["held"] == held)  # noqa: E731, B023
        bias, trees = fitted_trees(of(False))
        model[k] = (bias, trees, _threshold(bias, trees, of(True)))
    return model


def _tree_sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    k, cut, low, high = tree
    return f"if(s.f[{k}] <= {cut!r}D, {_tree_sql(low)}, {_tree_sql(high)})"


def _score_sql(model: dict[int, tuple[float, list, float]]) -> tuple[str, str]:
    margins = " ".join(f"WHEN {k} THEN {' + '.join([f'{bias!r}D', *map(_tree_sql, trees)])}" for k, (bias, trees, _) in model.items())
    least = " ".join(f"WHEN {k} THEN {t!r}D" for k, (_, _, t) in model.items())
    return f"1 / (1 + exp(-(CASE s.kind {margins} END)))", f"CASE s.kind {least} END"


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and the personal data in the text of every document of ``docs`` (doc_id, text): ``base``
    and ``spans`` (base ones and those chosen among the proposals), arrays of (start, kind, end,
    value, score) by start, then kind; positions are code points, ends exclusive, kinds 0 to 3 are
    email, ip, card and phone, and base spans score 1.

    Null and empty texts have no spans, long ones are searched whole; repeated rows and repeated or
    null ids each get their own row; an empty table gives none; other columns are ignored. A proposal
    is chosen at its kind's threshold unless a near span that overlaps it is a base span or scores
    better (ties: the longer, then the earlier in order). A kind of which no span is confirmed, or
    none refuted, has the constant score of its share.
    """
    proposed = stored(proposed_spans(docs), "pii-spans")
    score, least = _score_sql(fitted_model(proposed))
    scored = proposed.selectExpr(
        "doc_id",
        f"""transform(filter(spans, s -> s.label = 1 OR s.label IS NULL), s -> named_struct('start', s.start, 'kind', s.kind,
              'end', s.end, 'value', s.value, 'exact', s.label IS NOT NULL, 'score', if(s.label = 1, 1D, {score}), 'least', {least})) AS spans""",
    )
    chosen = scored.selectExpr("doc_id", "array_sort(filter(spans, s -> s.exact OR s.score >= s.least)) AS spans")
    beats = "(o.exact OR o.score > s.score OR (o.score = s.score AND (o.end - o.start > s.end - s.start OR (o.end - o.start = s.end - s.start AND j < 0))))"
    near = f"""filter(spans, (s, i) -> s.exact OR NOT exists(
        filter(transform(filter(sequence(-{NEAR}, {NEAR}), j -> j <> 0), j -> named_struct('j', j, 'o', get(spans, i + j))), n -> n.o IS NOT NULL),
        n -> n.o.start < s.end AND s.start < n.o.end AND {beats.replace("o.", "n.o.").replace("j <", "n.j <")}))"""
    shown = lambda what: f"transform({what}, s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end, 'value', s.value, 'score', s.score))"
    return chosen.selectExpr("doc_id", f"{shown('filter(spans, s -> s.exact)')} AS base", f"{shown(near)} AS spans")


def span_text(column: str) -> str:
    """kind:start:end of an array of spans, comma-joined, as an SQL expression."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({column}, s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')"
