"""The training-data operators against brute force on small awkward tables."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from blotter.llm import (
    chat_format,
    components,
    embedding_dedup,
    mixing,
    ngram_join,
    packing,
    quality,
    secret_scan,
    topk,
    toxicity,
    warc,
)
from blotter.llm.common import prepare, read, stored
from blotter.llm.labelled import labelled_sample

LONG = " ".join(f"long{k % 7001}" for k in range(30_000))
# columns whose names the operators use themselves
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, mix_size long"


def docs_of(spark, texts, sources=None):
    """One row per text (or (id, text)), with clashing extra columns."""
    rows = []
    for k, t in enumerate(texts):
        doc_id, text = t if isinstance(t, tuple) else (k, t)
        source = sources[k] if sources else f"s{k % 3}"
        rows.append((doc_id, text, "en", source, len(text or ""), 0.5, "k", 7))
    return spark.createDataFrame(rows, DOCS)


AWKWARD = [None, "", "  \n", "one", "two words", LONG, "a b c d e f", "a b c d e f", (6, "a b c d e f"), (None, "no id here")]


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    prepare(spark)


def groups_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def test_components_equal_union_find(spark):
    rng = np.random.RandomState(3)
    edges = [(int(a), int(b)) for a, b in rng.randint(0, 90, (70, 2))] + [(k, k + 1) for k in range(100, 106)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    root = groups_of(200, edges)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert {(r["node"], r["component"]) for r in found} == {(x, root[x]) for x in nodes}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 mixing ------------------------------------------------------------------------------


def filled(sizes: dict, weights: dict, budget: float, cap: float) -> dict:
    """Shares by weight, excess over the caps shared again until none is above."""
    target, full = dict.fromkeys(sizes, 0.0), set()
    while len(full) < len(sizes):
        left = budget - sum(target[s] for s in full)
        total = sum(weights[s] for s in sizes if s not in full)
        over = set()
        for s in sizes:
            if s not in full:
                target[s] = left * weights[s] / total
                if target[s] >= cap * sizes[s]:
                    over.add(s)
        if not over:
            break
        for s in over:
            target[s] = cap * sizes[s]
        full |= over
    return target


def test_mixing_targets_and_copies(spark):
    rng = np.random.RandomState(1)
    texts = AWKWARD + [" ".join(["w"] * int(n)) for n in rng.randint(1, 60, 600)]
    sources = [["b", None, "a", "é", "B"][int(x)] for x in rng.choice(5, len(texts), p=[0.6, 0.1, 0.1, 0.1, 0.1])]
    sources[5] = "é"  # a document longer than its source's target may be in the mix or not
    docs = docs_of(spark, texts, sources)
    plan = mixing.planned_mix(docs).collect()
    size = lambda t: len((t or "").split())
    sizes = Counter()
    for t, s in zip(texts, sources, strict=True):
        sizes[s] += size(t[1] if isinstance(t, tuple) else t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    want = filled(sizes, weights, 1.5 * sum(sizes.values()), 2)
    assert len(plan) == len(texts)
    taken = Counter()
    for r in plan:
        assert r["mix_target"] == pytest.approx(want[r["source"]]) and r["mix_source_size"] == sizes[r["source"]]
        assert r["mix_size"] == size(r["text"]) and 0 <= r["mix_copies"] <= 2
        taken[r["source"]] += r["mix_size"] * r["mix_copies"]
    assert taken["b"] == pytest.approx(want["b"], rel=0.3)
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["mix_copies"] for r in plan)
    again = mixing.planned_mix(docs.repartition(7)).select("doc_id", "text", "mix_copies").collect()
    assert Counter(map(tuple, again)) == Counter((r["doc_id"], r["text"], r["mix_copies"]) for r in plan)
    assert mixing.planned_mix(docs.limit(0)).count() == 0


# --- 2 embeddings --------------------------------------------------------------------------


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.RandomState(5)
    centres = rng.normal(size=(12, 16))
    rows = []
    for k in range(260):
        x = centres[k % 12] + rng.normal(scale=0.06, size=16) * (k % 3)
        rows.append((k, [float(v) for v in x], k % 4 if k % 12 else 1))
    rows += [(300 + k, [float(v) for v in 3 * centres[1]], 1) for k in range(40)]  # copies
    rows += [(300, rows[-1][1], 1), (None, rows[-1][1], 1)]  # a repeated row and a null id
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] + [1.0] * 15, 1), (403, [1.0, None], 1)]
    rows += [(404, [float("inf")] * 16, 1), (405, rows[1][1], None), (406, [], 1), (407, [1.0, 2.0], 1), (408, [2.0, 4.0], 1)]
    table = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, key string, n int")
    got = embedding_dedup.near_vectors(table).collect()

    def linkable(r):
        return r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])

    n, links = len(rows), []
    for a in range(n):
        for b in range(a):
            x, y = rows[a], rows[b]
            if linkable(x) and linkable(y) and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, v = np.array(x[1]), np.array(y[1])
                if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.98:
                    links.append((b, a))
    count = Counter(x for p in links for x in p)
    root, least = groups_of(n, links), {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root[k]] = min(least.get(root[k], r[0]), r[0])
    want = Counter((r[0], count[k], least.get(root[k])) for k, r in enumerate(rows))
    assert len(links) > 500
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_mix_keeps_columns_named_like_the_plan(spark):
    docs = spark.createDataFrame([(k, f"word {k} more", "s", 77, 9, 5.0, "c") for k in range(20)], "doc_id long, text string, source string, mix_size int, mix_copies int, mix_target double, mix_copy string")
    rows = mixing.mix_sources(docs).collect()
    assert rows and {(r["mix_size"], r["mix_copies"], r["mix_target"], r["mix_copy"]) for r in rows} == {(77, 9, 5.0, "c")}
    assert mixing.mix_sources(docs).columns == docs.columns


def test_repeated_pieces_are_dealt_to_many_chunks(spark):
    docs = spark.createDataFrame([(1, "the same words again")] * 3000 + [(2, None), (3, "other words")], "doc_id long, text string").repartition(6)
    packed = packing.pack_documents(docs).collect()
    place = Counter((r["sequence_id"], r["offset"]) for r in packed if r["length"])
    assert len(packed) >= 3002 and max(place.values()) == 1
    plan = packing.pack_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(deal" in plan and "xxhash64(doc_id" not in plan


# --- 3 secrets -----------------------------------------------------------------------------


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


KEY = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48"), der(5)), der(4, bytes(range(200))))
SSH = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", bytes(range(32))))
URL64 = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
TOKEN = ".".join([URL64(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()), URL64(b'{"sub":"1"}'), URL64(bytes(32))])


def test_secret_spans(spark):
    pem = f"-----BEGIN PRIVATE KEY-----\n{base64.encodebytes(KEY).decode()}-----END PRIVATE KEY-----"
    texts = [
        "é😀 PassWord = 'hunter22' x",
        'api_key:"abc" token:token:abcdef secret=abcdefgh',
        "AKIA" + "B" * 16 + " AKIA" + "B" * 15,
        "x" + "0a" * 12 + " " + "0a" * 11 + "f" * 64,
        f"go {TOKEN} end",
        f"k {base64.b64encode(KEY).decode()} {KEY.hex()}",
        pem,
        "ssh-ed25519 " + base64.b64encode(SSH).decode(),
        "a.b.c " + "Q" * 80 + " " + base64.b64encode(b"plain words here, nothing else at all").decode(),
        *AWKWARD,
    ]
    rows = secret_scan.scan_secrets(docs_of(spark, texts)).collect()
    by = {r["doc_id"]: r for r in rows[:9]}
    kinds = lambda k: [s.split(":")[0] for s in by[k]["spans"].split(",") if s]
    assert by[0]["spans"] == "assign:3:23" and kinds(1) == ["assign"] and by[1]["spans"].endswith(":48")
    assert (by[2]["n_access"], by[3]["n_hex"]) == (1, 2)
    assert kinds(4) == ["token"] and kinds(5) == ["der", "hex", "der"] and kinds(6) == ["der"] and kinds(7) == ["ssh"]
    assert kinds(8) == []
    for r, t in zip(rows, texts, strict=True):
        text = (t[1] if isinstance(t, tuple) else t) or ""
        runs, at = [], 0
        while at < len(text):
            end = at
            while end < len(text) and text[end] in "0123456789abcdef":
                end += 1
            if end - at >= 24:
                runs.append((at, end))
            at = max(end, at + 1)
        assert r["n_hex"] == len(runs)
        base = [s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
    masked = secret_scan.mask_secrets(docs_of(spark, texts))
    out = masked.collect()
    assert masked.columns == docs_of(spark, texts).columns and out[0]["text"] == "é😀 [SECRET]' x"
    assert out[0]["n_chars"] == len(out[0]["text"]) and out[8]["text"] == texts[8] and out[9]["text"] is None
    assert secret_scan.scan_secrets(docs_of(spark, [])).count() == 0


def test_der_lengths_must_nest():
    assert secret_scan.is_der_key(KEY) and not secret_scan.is_der_key(KEY[:-1]) and not secret_scan.is_der_key(KEY + b"\0")
    assert not secret_scan.is_der_key(der(0x30, der(2, b"\0"), der(0x30, der(2, b"\1")), der(4, b"x" * 40)))
    assert secret_scan.is_ssh_key(SSH) and not secret_scan.is_ssh_key(SSH[:-1])


def test_secret_keys_in_other_forms(spark):
    pem = f"-----BEGIN PRIVATE KEY-----\n{base64.encodebytes(KEY).decode()}-----END PRIVATE KEY-----"
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"
    locked = base64.encodebytes(bytes(range(160))).decode()
    rsa = lambda body: f"-----BEGIN RSA PRIVATE KEY-----\n{body}-----END RSA PRIVATE KEY-----"
    wrapped = base64.encodebytes(KEY).decode().strip()
    blob = SSH + len(SSH).to_bytes(4, "big") + SSH
    lines = lambda s, w: [s[k : k + w] for k in range(0, len(s), w)]
    secrets = {
        "der": [
            pem.replace("\n", "\\n"),
            pem.replace("\n", "\\\\r\\\\n").replace("/", "\\/"),
            rsa("Comment: a key\n\n" + base64.encodebytes(KEY).decode()),
            rsa(head + locked),
            rsa(head + locked).replace("\n", "\\n"),
            wrapped,
            wrapped.replace("\n", "\r\n    "),
            wrapped.replace("\n", "\\n"),
            "\n".join(lines(base64.b64encode(KEY).decode(), 70)),
            KEY.hex().upper(),
            KEY.hex()[:80] + KEY.hex()[80:].upper(),
            "\n".join(lines(KEY.hex().upper(), 64)),
        ],
        "ssh": ["\n".join(lines(base64.b64encode(blob).decode(), 64))],
    }
    cases = [(kind, s) for kind, found in secrets.items() for s in found]
    texts = [f"see \n{s}\nand\nmore words" for _, s in cases]
    assert "-----END" not in texts[5]
    plain = [
        rsa(head + base64.encodebytes(bytes(161)).decode()), rsa(locked), "\n".join(["Q" * 64] * 9),
        base64.encodebytes(KEY[:-1]).decode(), base64.encodebytes(b"words " * 60).decode(), "0A" * 90, "-----BEGIN A KEY-----" * 50,
    ]
    rows = {r["doc_id"]: r["text"] for r in secret_scan.mask_secrets(docs_of(spark, texts + plain)).collect()}
    for k, (kind, s) in enumerate(cases):
        assert rows[k] == "see \n[SECRET]\nand\nmore words", (k, rows[k])
        assert kind in {x for x, _, _ in secret_scan.all_spans(texts[k])[1]}
    assert [rows[len(texts) + k] for k in range(len(plain))] == plain


BASE_PATTERNS = {
    "assign": r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def test_base_spans_and_digest_equal_the_plain_patterns(spark):
    rng = np.random.RandomState(21)
    bits = ["PassWord", "token", "api_key", "apikey", "secret", "'", '"', " ", "  ", ":", "=", "abcdef", "x-y.z/=", "AKIA", "B9" * 8, "0a" * 12, "f" * 5, "\u0131", "\n", "K"]
    texts = ["".join(rng.choice(bits, rng.randint(30))) for _ in range(800)]
    for r, text in zip(secret_scan.scan_secrets(docs_of(spark, texts)).collect(), texts, strict=True):
        spans = []
        for k, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
            for m in re.finditer(pattern, text, re.IGNORECASE | re.ASCII if kind == "assign" else 0):
                size = len(m[2]) if kind == "assign" else len(m[0])
                if size >= (6, 20, 24)[k]:
                    spans.append((m.start(), k, m.end(), kind))
        want = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), text
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3))


def test_secret_keys_inside_other_text():
    kinds = lambda t: {k for k, _, _ in secret_scan.confirmed_spans(t, [])}
    pem = f"-----BEGIN PRIVATE KEY-----\n{base64.encodebytes(KEY).decode()}-----END PRIVATE KEY-----"
    secret = bytes([4]) + bytes(range(120))
    packets = bytes([0xC5, 121]) + secret + bytes([0xCD, 5]) + b"a@b.c" + bytes([0x94, 121]) + secret
    armoured = "-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 2\n\n{}=abcd\n-----END PGP PRIVATE KEY BLOCK-----"
    header = URL64(json.dumps({"alg": "RSA-OAEP", "enc": "A256GCM"}).encode())
    long_key = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48"), der(5)), der(4, bytes(range(250)) * 4))
    forms = {
        "base64 of armour": (base64.b64encode(pem.encode()).decode(), "der"),
        "base64 of JSON": (base64.b64encode(json.dumps({"key": base64.b64encode(KEY).decode()}).encode()).decode(), "der"),
        "twice encoded": (base64.b64encode(base64.b64encode(pem.encode())).decode(), "der"),
        "openpgp": (armoured.format(base64.encodebytes(packets).decode()), "pgp"),
        "colons": (":".join(f"{b:02x}" for b in KEY), "der"),
        "quoted": (pem.replace("\n", "\n> "), "der"),
        "commented": (pem.replace("\n", "\n# "), "der"),
        "entities": (pem.replace("\n", "&#10;"), "der"),
        "breaks": (pem.replace("\n", "<br>"), "der"),
        "percent": (pem.replace("\n", "%0A").replace("+", "%2B").replace("/", "%2F").replace("=", "%3D"), "der"),
        "after a path": ("path/" + base64.b64encode(long_key).decode(), "der"),
        "glued": ("keyis" + base64.b64encode(long_key).decode(), "der"),
        "five parts": (".".join([header, URL64(bytes(64)), URL64(bytes(12)), URL64(bytes(80)), URL64(bytes(16))]), "token"),
    }
    for name, (text, kind) in forms.items():
        assert kind in kinds(f"here: {text} there"), name
    broken = bytes([0xC5, 122]) + secret
    for text in (armoured.format(base64.encodebytes(broken).decode()), ":".join(f"{b:02x}" for b in KEY[:-1]), base64.b64encode(b"plain words " * 9).decode(), "a/" + "MIIB" * 40):
        assert not kinds(f"here: {text} there"), text


def test_secret_scan_time_is_linear_on_hostile_lines():
    import time

    ssh = base64.b64encode(b"\0\0\0\x07ssh-rsa" + bytes([0, 0, 9, 9]) * 9).decode()[:64]
    der_head = base64.b64encode(b"\x30\x84\0\x20\0\0" + bytes(42)).decode()[:64]
    for line in (ssh, der_head, "3084" + "0" * 60, "b3BlbnNzaC1" + "A" * 53, "AAAAB3NzaC1yc2EAAAAB" + "A" * 44):
        for end in ("\n", "\\n"):
            began = time.process_time()
            secret_scan.all_spans((line + end) * 30_000)
            assert time.process_time() - began < 4, line


# --- 4 n-gram join -------------------------------------------------------------------------


def shingle_set(text):
    words = (text or "").split(" ")
    words = [w for x in words for w in x.split("\n") if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_texts():
    rng = np.random.RandomState(9)
    texts = list(AWKWARD)
    for base in range(12):
        words = [f"w{x}" for x in rng.randint(0, 4000, 60 + 20 * base)]
        texts += [" ".join(words)] * (1 + base % 3)
        for copy in range(12):
            changed = list(words)
            for _ in range(copy % 5):
                changed[rng.randint(len(words))] = f"x{rng.randint(4000)}"
            texts.append(" ".join(changed) + (" shared line that many texts end with" if copy % 2 else ""))
    return texts


def test_jaccard_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIMIT", 4)
    monkeypatch.setattr(ngram_join, "SKETCH_BLOCK", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    texts = near_texts()
    docs = docs_of(spark, texts)
    rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
    sets = [shingle_set(t) for _, t in rows]
    links = [
        (b, a)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    ]
    count = Counter(x for p in links for x in p)
    root, least = groups_of(len(sets), links), {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    want = Counter((i, count[k], least.get(root[k])) for k, (i, _) in enumerate(rows))
    got = ngram_join.jaccard_join(docs, recall=0.999999).collect()
    assert len(links) > 150
    assert Counter((r["doc_id"], r["n_links"], r["class_id"]) for r in got) == want
    kept = ngram_join.keep_one_of_each(docs, recall=0.999999)
    assert kept.columns == docs.columns
    worded = [r for r in kept.collect() if (r["text"] or "").split()]
    assert len(worded) == len({root[k] for k in range(len(sets)) if sets[k]})
    assert {r["doc_id"] for r in worded} == {least.get(root[k]) for k in range(len(sets)) if sets[k]}
    assert kept.count() - len(worded) == sum(not s for s in sets)
    assert ngram_join.jaccard_join(docs.limit(0)).count() == 0


def test_links_of_a_bucket_grow_with_its_members_not_their_pairs(spark):
    """Near copies of one text beside a few strangers: all are linked, by rows in proportion."""
    rng = np.random.RandomState(7)
    base, made = rng.bytes(128), {}
    for n in (500, 1000, 2000):
        cuts = []
        for k in range(n):
            cut = bytearray(base)
            for at in rng.choice(128, 8, replace=False):
                cut[at] = rng.randint(256)
            cuts.append((f"k{k}", bytes(cut)))
        # a second family, and one that is like nothing
        other = rng.bytes(128)
        cuts += [(f"m{k}", other[:-1] + bytes([k])) for k in range(20)] + [("alone", rng.bytes(128))]
        members = spark.createDataFrame([(5, k, len(cuts)) for k, _ in cuts], "path long, key string, n long")
        links = ngram_join.bucket_links(members, spark.createDataFrame(cuts, "key string, cut binary"), 0.8).collect()
        names = {k: i for i, (k, _) in enumerate(cuts)}
        root = groups_of(len(cuts), [(names[r["a"]], names[r["b"]]) for r in links])
        assert len(set(root)) == 3 and len(set(root[:n])) == 1 and len(set(root[n : n + 20])) == 1
        made[n] = len(links)
    assert made[2000] < 2.5 * made[1000] < 6.25 * made[500]


def test_a_block_is_dealt_to_other_groups_only(spark):
    shapes = [(-1, 0, 2, 5), (3, 0, 2, 5), (3, 2, 2, 5), (3, 4, 1, 5), (9, 0, 40, 41)]
    rows = spark.createDataFrame(shapes, "family long, begin long, blocks long, total long")
    got = [r["other"] for r in rows.withColumn("other", ngram_join._other_blocks()).collect()]
    assert got == [[b for b in range(t) if f == -1 or not a <= b < a + n] for f, a, n, t in shapes]
    assert got[-1] == [40]


def test_similar_texts_and_a_common_passage_are_split_into_small_buckets(spark):
    """Sketches about one centre, some too far from it to link, and strangers that share a passage: no
    bucket keeps them together, rows grow with the members, and pairs at the threshold are connected."""
    rows, least = {}, 102
    for n in (1000, 4000):
        rng = np.random.RandomState(3)
        half, pairs = n // 2, n // 20
        centres = rng.randint(0, 1 << 32, (2, 128), dtype=np.uint64)
        own = rng.randint(0, 1 << 32, (n, 128), dtype=np.uint64)
        share = np.r_[rng.choice([0.45, 0.6, 0.75, 0.85, 0.95], half), np.full(half, 0.35)][:, None]
        values = np.where(rng.rand(n, 128) < share, np.repeat(centres, half, axis=0), own)
        # the pairs: of each half, the first and the next few
        left = np.r_[0:pairs, half : half + pairs]
        values[left + pairs] = np.where(rng.rand(len(left), 128) < 0.82, values[left], own[left + pairs])
        made = [(f"k{k}", v.astype("<u4").tobytes()) for k, v in enumerate(values)]
        classes = spark.createDataFrame(made, "key string, sketch binary")
        buckets, near = ngram_join.final_buckets(classes, ngram_join.runs_needed(), 0.8)
        buckets, near = stored(buckets, "buckets"), stored(near, "near")
        assert buckets.agg({"n": "max"}).first()[0] <= ngram_join.LIMIT
        rows[n] = buckets.count() + near.count()
        cut = classes.select("key", ngram_join._low_bytes(classes["sketch"]).alias("cut"))
        links = ngram_join.bucket_links(buckets, cut, 0.8).unionByName(near).collect()
        root = groups_of(n, [(int(r["a"][1:]), int(r["b"][1:])) for r in links])
        found = [root[k] == root[k + pairs] for k in left if np.sum(values[k] == values[k + pairs]) >= least]
        assert len(found) > n // 20 and all(found)
    assert rows[4000] < 5 * rows[1000]


def test_strangers_of_a_common_line_do_not_meet_by_it(spark):
    """Sets that share a third of their tokens with all and little else: no bucket is split for them, rows
    grow with the sets, and pairs at the threshold are connected, also those of frequent tokens only."""
    for n in (1000, 3000):
        rng = np.random.RandomState(4)
        pairs = n // 20
        line = rng.randint(0, 1 << 32, 128, dtype=np.uint64)
        values = np.where(rng.rand(n, 128) < 0.33, line, rng.randint(0, 1 << 32, (n, 128), dtype=np.uint64))
        left = np.arange(pairs)
        values[left + pairs] = np.where(rng.rand(pairs, 128) < 0.85, values[left], values[left + pairs])
        made = [(f"k{k}", v.astype("<u4").tobytes()) for k, v in enumerate(values)]
        classes = spark.createDataFrame(made, "key string, sketch binary")
        frequent = ngram_join.frequent_tokens(classes)
        assert np.array_equal(frequent, np.sort(line + (np.arange(1, 129, dtype=np.uint64) << np.uint64(32))))
        paths = ngram_join.child_paths(classes, ngram_join.runs_needed(), 0.8, frequent)
        assert paths.groupBy("path").count().agg({"count": "max"}).first()[0] <= ngram_join.LIMIT
        buckets, near = ngram_join.final_buckets(classes, ngram_join.runs_needed(), 0.8)
        cut = classes.select("key", ngram_join._low_bytes(classes["sketch"]).alias("cut"))
        links = ngram_join.bucket_links(buckets, cut, 0.8).unionByName(near).collect()
        root = groups_of(n, [(int(r["a"][1:]), int(r["b"][1:])) for r in links])
        found = [root[k] == root[k + pairs] for k in left if np.sum(values[k] == values[k + pairs]) >= 102]
        assert len(found) > pairs // 2 and all(found)
    # more frequent tokens than half of what similar sets share: these are chosen too
    held = spark.createDataFrame([(k, line.astype("<u4").tobytes()) for k in ("a", "b")], "key string, sketch binary")
    met = ngram_join.child_paths(held, ngram_join.runs_needed(), 0.8, frequent).groupBy("path").count()
    assert met.count() > 10 and met.where("count <> 2").isEmpty()


def test_small_groups_and_strangers_share_blocks():
    counted = [{"mask": 0, "n": 30}, {"mask": 1, "n": 10}, {"mask": 2, "n": 20}, {"mask": 12, "n": 90}, {"mask": 4, "n": 70}]
    kind = pa.list_(pa.struct([("mask", pa.int32()), ("n", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), pa.array([counted], kind), pa.array([100])], names=["path", "counted", "block"])
    (got,) = ngram_join._bucket_groups(iter([batch]))
    assert {r["mask"]: (r["family"], r["begin"], r["blocks"], r["total"]) for r in got.to_pylist()} == {
        0: (-1, 0, 1, 3), 1: (-1, 0, 1, 3), 2: (-1, 0, 1, 3), 4: (12, 1, 2, 3), 12: (12, 1, 2, 3)
    }


def test_runs_reach_the_recall_in_the_deepest_buckets(spark, monkeypatch):
    chance = 1.0
    for _ in range(ngram_join.DEPTH):
        chance = 1 - np.exp(-chance)
    assert 1 - (1 - chance) ** ngram_join.runs_needed() >= ngram_join.RECALL
    # isolated pairs near the threshold that share most of one passage, split down to the last depth
    monkeypatch.setattr(ngram_join, "LIMIT", 2)
    rng = np.random.RandomState(12)
    passage = [f"p{k}" for k in range(150)]
    texts = []
    for k in range(60):
        own = [f"own{k}-{j}" for j in range(40)]
        at = rng.randint(20)
        words = own[:20] + passage[at : at + 130] + own[20:]
        texts += [" ".join(words), " ".join([f"a{k}-{j}" for j in range(8)] + words + [f"b{k}-{j}" for j in range(20)])]
    sets = [shingle_set(t) for t in texts]
    links = [(b, a) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    count = Counter(x for p in links for x in p)
    got = ngram_join.jaccard_join(docs_of(spark, texts)).collect()
    assert len(links) >= 60 and {r["doc_id"]: r["n_links"] for r in got} == {k: count[k] for k in range(len(texts))}


# --- 5 packing -----------------------------------------------------------------------------


def test_word_encoder_equals_the_tokenizer():
    enc = packing.WordEncoder(packing.vocabulary_path())
    texts = ["", "'still can't we'll I'D", "İstanbul ΣΑΣ σς ẞ", "á é", "x\x1cy z\x85w", "日本 １２３ ½", "😀😀 a😀b"]
    texts += ["<|endoftext|> a", "Ünï çödé, thé end.", "'" * 40 + "s", "a　b​c", "no.1!! (two)--three"]
    for t in [*texts, *texts]:
        assert enc.text(t) == np.array(enc.whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes(), t


def test_packing_places_every_piece(spark):
    rng = np.random.RandomState(2)
    texts = AWKWARD + [" ".join(["word"] * int(n)) for n in rng.randint(1, 3000, 150)] + ["same text"] * 400
    docs = docs_of(spark, texts)
    rows = packing.pack_documents(docs).collect()
    enc = packing.WordEncoder(packing.vocabulary_path())
    want = Counter()
    for k, t in enumerate(texts):
        doc_id, text = t if isinstance(t, tuple) else (k, t)
        ids = enc.whole.encode(text or "", add_special_tokens=False).ids + [1]
        for p, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a : a + 4096], dtype="<u4")
            want[(doc_id, p, a, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= 1.02 * sum(r["length"] for r in rows) / 4096 + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("counts", [{}, {1: 5}, {4096: 3}, {4095: 2, 1: 3}, {1366: 1000}, {1365: 1000, 2000: 777, 2100: 500, 3: 10}])
def test_plan_covers_every_rank(counts):
    seen, bins = defaultdict(set), defaultdict(int)
    for length, start, end, each, sequence, _ in packing.plan_slots(counts).tolist():
        for rank in range(start, end):
            assert rank not in seen[length]
            seen[length].add(rank)
            bins[sequence + (rank - start) // each] += length
    assert {k: len(v) for k, v in seen.items()} == counts and all(v <= 4096 for v in bins.values())


# --- 6 chat --------------------------------------------------------------------------------


def test_chat_keeps_maximal_conversations(spark):
    rng = np.random.RandomState(4)
    logs = {}
    for c in range(60):
        turns = [("user" if k % 2 == 0 else "assistant", f"t{c % 9}-{k}") for k in range(1 + rng.randint(9))]
        logs[c] = turns
    logs[100] = [("user", None), (None, "x")]
    logs[101] = [("user", None)]
    logs[102] = [("user", "")]
    logs[103] = [("user", "long")] * 700
    logs[None] = [("user", "anonymous")]
    rows = [(c, 3 * k, r, t, "z") for c, turns in logs.items() for k, (r, t) in enumerate(turns)]
    rows.append((104, None, "user", "no number", "z"))
    rng.shuffle(rows)
    table = spark.createDataFrame([tuple(r) for r in rows], "conv_id long, turn long, role string, text string, block string")
    logs[104] = [("user", "no number")]
    want = {}
    for c, turns in logs.items():
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in logs.values()):
            continue
        same = [k for k, o in logs.items() if o == turns]
        ids = [k for k in same if k is not None]
        want[min(ids) if ids else None] = (
            "".join(f"<|{r or 'unknown'}|>\n{t or ''}\n" for r, t in turns), len(turns), len(same)
        )
    got = defaultdict(list)
    for r in chat_format.formatted_conversations(table).collect():
        got[r["conv_id"]].append((r["segment"], r["text"], r["total_turns"], r["copies"], r["n_turns"]))
    assert {c: ("".join(x[1] for x in sorted(v)), v[0][2], v[0][3]) for c, v in got.items()} == want
    assert len(got[103]) == 3 and sum(x[4] for x in got[103]) == 700
    assert chat_format.formatted_conversations(table.limit(0)).count() == 0


def test_chat_rows_are_bounded_by_turns_not_by_numbers(spark):
    rows = [(1, 5, "user", f"again{k % 300}") for k in range(900)]  # one number, logged again
    rows += [(2, None, "user", f"x{k}") for k in range(600)]  # no numbers
    rows += [(None, k, "user", f"n{k // 2}") for k in range(500)]  # no id
    rows += [(3, 1000 * k, "user", f"far{k}") for k in range(200)]  # few turns, large numbers
    rows += [(4, 1, "user", "same")] * 700 + [(5, 1, "user", "same")] * 300  # the second is a prefix
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = defaultdict(list)
    for r in chat_format.formatted_conversations(table).collect():
        got[r["conv_id"]].append((r["segment"], r["n_turns"], r["text"]))
        assert r["n_turns"] <= chat_format.BLOCK_TURNS
    assert set(got) == {1, 2, 3, 4, None}
    for c, parts in got.items():
        parts.sort()
        own = [r for r in rows if r[0] == c]
        assert [p[0] for p in parts] == list(range(len(parts))) and sum(p[1] for p in parts) == len(own)
        shown = "".join(p[2] for p in parts).split("<|user|>\n")[1:]
        assert Counter(shown) == Counter(r[3] + "\n" for r in own)
    assert len(got[3]) == 1 and got[3][0][2] == "".join(f"<|user|>\nfar{k}\n" for k in range(200))
    assert "".join(p[2] for p in got[None]) == "".join(f"<|user|>\nn{k // 2}\n" for k in range(500))
    assert len(got[4]) == 3


@pytest.mark.parametrize("numbers", ["even", "from 0"])
def test_segments_equal_the_twin_at_every_length(spark, duck, numbers):
    rows = []
    for c, n in enumerate((255, 256, 257, 512, 513, 700)):
        for k in range(n):
            turn = 2 * k if numbers == "even" else k
            rows.append((c, turn, "user" if k % 2 == 0 else None, f"c{c} t{k}"))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = chat_format.formatted_conversations(table)
    con = duck.cursor()
    con.execute("CREATE TEMP TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO temp.conversations VALUES (?, ?, ?, ?)", rows)
    from blotter.llm.queries import ORACLE_SQL

    found = con.execute(ORACLE_SQL["op6_chat_format"].replace("FROM conversations", "FROM temp.conversations"))
    columns = [d[0] for d in found.description]
    want = sorted(found.fetchall())
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want
    assert len(want) == 1 + 1 + 2 + 2 + 3 + 3


# --- 7 and 9 classifiers -------------------------------------------------------------------


def labelled_docs(spark, make, n=900):
    rng = np.random.RandomState(6)
    words = ["the", "and", "river", "stone", "walks", "over", "light", "green", "house", "under", "quiet", "morning"]
    texts, flags = [], []
    for k in range(n):
        flags.append(int(k % 3 == 0))
        texts.append(make(rng, list(rng.choice(words, 40 + rng.randint(60))), flags[-1]))
    docs = docs_of(spark, texts + AWKWARD)
    return docs, spark.createDataFrame([(k, f, f) for k, f in enumerate(flags)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int"), flags


def accuracy(rows, flags):
    checked = [(r["predicted"], flags[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] >= 10 and r["doc_id"] < len(flags)]
    assert len(checked) > 100
    return np.mean([a == b for a, b in checked])


def test_repeated_labelled_ids_leave_room_for_the_others(spark):
    ids = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5]
    labels = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id long, toxic int")
    first = labels.orderBy("toxic").selectExpr("doc_id", "xxhash64(doc_id) AS h").orderBy("h").first()["doc_id"]
    docs = docs_of(spark, [(k, f"text {k}") for k in ids] + [(first, f"text {first}")] * 500)
    sample = labelled_sample(docs, labels, "toxic", rows=50)
    assert [sorted(c) for c in sample.texts] == [sorted(f"text {k}" for k in ids if k % 2 == y) for y in (0, 1)]


def test_quality_on_held_out_rows(spark):
    def make(rng, words, good):
        return " ".join(words) if good else " ".join(w.upper() + "!! ###" for w in words)

    docs, labels, flags = labelled_docs(spark, make)
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(flags) + len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert accuracy(rows, flags) > 0.97
    for r in rows[:50]:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] >= 0.3 for r in rows)
    none = quality.quality_scores(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_toxicity_on_held_out_rows(spark):
    def make(rng, words, toxic):
        if toxic:
            for _ in range(6):
                words[rng.randint(len(words))] = "grobn" + rng.choice(["ik", "el", "arz", "ump"])
        return " ".join(words)

    docs, labels, flags = labelled_docs(spark, make)
    rows = toxicity.toxicity_scores(spark, docs, labels).collect()
    assert len(rows) == len(flags) + len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert accuracy(rows, flags) > 0.95
    assert {r["score"] for r in toxicity.toxicity_scores(spark, docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity_scores(spark, docs.limit(0), labels).count() == 0


def test_few_toxic_words_in_long_texts(spark):
    def make(rng, words, toxic):
        words = list(rng.permutation(words * rng.choice([1, 20])))
        if toxic:
            words[rng.randint(len(words))] = "grobn" + rng.choice(["ik", "el", "arz", "ump"])
        return " ".join(words)

    docs, labels, flags = labelled_docs(spark, make)
    rows = toxicity.toxicity_scores(spark, docs, labels).collect()
    assert accuracy(rows, flags) > 0.99


def test_toxic_phrases_of_ordinary_words(spark):
    phrase = ["light", "over", "house"]

    def make(rng, words, toxic):
        words = [w for w in words if w not in phrase]
        for _ in range(6):  # the same words in every text, side by side in toxic ones only
            at = rng.randint(len(words))
            words[at:at] = phrase if toxic else phrase[::-1]
        return " ".join(words)

    docs, labels, flags = labelled_docs(spark, make)
    assert accuracy(toxicity.toxicity_scores(spark, docs, labels).collect(), flags) > 0.95


def test_kneser_ney_probabilities_sum_to_one(spark):
    grams, begin, word, _ = toxicity.word_grams(["the then there them they other"])
    times = np.bincount(word, minlength=len(begin))
    keys, at = np.unique(grams, return_inverse=True)
    level = toxicity._Level(keys, np.bincount(at, weights=np.repeat(times, np.diff(np.r_[begin, len(grams)]))).astype(int))
    context = keys[0] >> toxicity.BITS
    every = (context << toxicity.BITS) + np.arange(64)
    assert level.probability(every, np.full(64, 1 / 64)).sum() == pytest.approx(1.0)
    docs = docs_of(spark, ["good day to you"] * 6 + ["bad grobnik"] * 6)
    model, _ = toxicity.fit_toxicity(docs.selectExpr("cast(doc_id >= 6 AS int) AS y", "doc_id", "text"), 0.5, docs)
    assert model.score(["grobnik"])[0] > model.score(["good day"])[0]
    # over all that can follow, the shared counts add up as well
    shared = toxicity.shared_counts(docs, np.unique(np.r_[every, keys]))
    seen = [k for k in every if shared[2][2][np.searchsorted(shared[2][0], toxicity._low(k, 3))] > 0]
    assert len(seen) in (0, 64)
    assert toxicity._shared_probability(shared, np.arange(64)).sum() == pytest.approx(1.0)


def test_word_models_equal_brute_force_kneser_ney(spark):
    """Log ratios of every word after the two before it, from dictionaries of word n-grams."""
    rng = np.random.RandomState(12)
    words = list("abcdefg")
    make = lambda n: [" ".join(rng.choice(words, rng.randint(3, 12), p=np.arange(1, 8) / 28)) for _ in range(n)]
    learn, others = (make(30), make(20)), make(40)
    docs = docs_of(spark, [*learn[0], *learn[1], *others])
    rows = spark.createDataFrame([(y, t) for y in (0, 1) for t in learn[y]], "y int, text string")
    model = toxicity.ToxicityModel({}, None, 0.5, toxicity.fit_phrases(rows, docs))

    def trigrams(texts):
        for t in texts:
            w = ["", "", *t.split()]
            yield from zip(w, w[1:], w[2:], strict=False)

    followed = defaultdict(set)
    for _, a, w in trigrams([*learn[0], *learn[1], *others]):
        followed[w].add(a)
    vocabulary = {w for texts in learn for *_, w in trigrams(texts)}
    total = sum(len(followed[w]) for w in vocabulary)

    def discount(counts):
        once, twice = (sum(c == k for c in counts) for k in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.5

    def share(counts, context, gram, lower):
        inside = {g: c for g, c in counts.items() if g[:-1] == context}
        if not inside:
            return lower, 1.0
        cut, whole = discount(counts.values()), sum(inside.values())
        weight = cut * len(inside) / whole
        return max(inside.get(gram, 0) - cut, 0) / whole + weight * lower, weight

    def ratio(gram, known):
        p = []
        for y in (0, 1):
            triples = Counter(trigrams(learn[y]))
            pairs = Counter(g[1:] for g in triples)
            low, pair_weight = share(pairs, gram[1:2], gram[1:], max(len(followed[gram[2]]) / total, 1 / total))
            high, weight = share(triples, gram[:2], gram, low)
            p.append({"triple": high, "pair": weight * low, "none": weight * pair_weight}[known])
        return np.log(p[1] / p[0])

    triples = {y: set(trigrams(learn[y])) for y in (0, 1)}
    for text in [*learn[0][:5], *learn[1][:5], *others[:10], "a zz b a"]:
        *_, hashes, at = toxicity._words([text])
        for gram, got in zip(trigrams([text]), model.phrase_ratios(hashes, at), strict=True):
            seen = triples[0] | triples[1]
            known = "triple" if gram in seen else "pair" if gram[1:] in {g[1:] for g in seen} else "none"
            assert got == pytest.approx(ratio(gram, known), abs=1e-5), (text, gram)


# --- 8 archive -----------------------------------------------------------------------------


def test_archive_round_trip(spark, tmp_path):
    big = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\né</p>" * 60
    rows = [(1, "http://a", big), (2, "http://b", big), (9, "http://c\r\nX: y", big), (9, "http://c", big)]
    rows += [(3, None, None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"), (7, "u", LONG), (None, "u", LONG), (8, "u", "x" * 1000)]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, sha256 string")
    got = Counter(map(tuple, warc.archived_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [k for k, _, h in rows if h == html and k is not None]
        head = max(ids) if len(data) >= 1000 else i
        want[(i, len(data), hashlib.sha1(data).hexdigest(), "response" if head == i else "revisit", None if head == i else head)] += 1
    assert got == want
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    stored = [r["sha256"] for r in spark.read.parquet(f"{path}/payloads").collect()]
    assert len(set(stored)) == len({h or "" for _, _, h in rows})
    shared = [h for _, _, h in rows if len(h or "") >= 1000]
    assert all(stored.count(hashlib.sha256(h.encode()).hexdigest()) == 1 for h in shared)
    warc.write_warc(warc.rebuilt_records(spark, path), f"{path}/warc")
    headers = Counter(r["header"] for r in spark.read.parquet(f"{path}/headers").collect())
    back = warc.read_warc(spark, f"{path}/warc").collect()
    assert Counter(r["header"] for r in back) == headers
    assert {bytes(r["payload"]) for r in back if r["payload"] is not None} == {(h or "").encode() for _, _, h in rows}
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_only_payloads_of_the_written_size_are_shuffled(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [(k, "u", "x" * n) for k, n in enumerate((5, 1500, 1500, 200_000, 200_000, 5 << 20))]
    path = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    rebuilt = warc.rebuilt_records(spark, path).where("record_type <> 'revisit'")
    revisits = spark.read.parquet(f"{path}/headers").where("record_type = 'revisit'").withColumn("payload", F.lit(None).cast("binary"))
    records = rebuilt.unionByName(revisits)
    low, found = 0, []
    for high, _ in warc.FILE_RECORDS:
        inside = records.where(warc._written_between(low, high))
        plan = inside._jdf.queryExecution().optimizedPlan().toString().splitlines()
        scan = next(k for k, x in enumerate(plan) if "Relation [" in x and "payload#" in x)
        assert not low or re.search(rf"Filter .*bytes#\d+L >= {low}\b", plan[scan - 1])
        found.append(sorted(r["page_id"] for r in inside.collect()))
        low = high
    assert found == [[0, 1, 2, 3], [4], [5]]


def test_archive_files_are_bounded_and_read_by_other_readers(spark, tmp_path):
    import gzip

    large = ["".join(chr(33 + (k * 7 + j * j) % 90) for j in range(1000)) * 8000 for k in range(3)]  # 8 MB each
    middle = [f"{k}" * 200_000 for k in range(20)]
    huge = "z" * (17 << 20)  # its size does not fit three bytes
    texts = [*large, *middle, huge, *(f"small {k}" for k in range(1200))]
    pages = spark.createDataFrame([(k, f"http://{k}", t) for k, t in enumerate(texts)], "page_id long, url string, html string").repartition(2)
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, date="2025-01-02T03:04:05Z")
    warc.write_warc(warc.rebuilt_records(spark, path), f"{path}/warc")
    found = {}
    for file in (tmp_path / "archive" / "warc").glob("part-*"):
        content = file.read_bytes()
        members = list(warc.unzipped(content, "f"))
        sizes = [len(data) for _, data in members]
        assert len(members) == 1 or sum(sizes) < 70 << 20
        # each member stands alone, and all of them are one gzip file
        assert gzip.decompress(content) == b"".join(data for _, data in members)
        for _, data in members:
            fields = dict(x.split(": ", 1) for x in data[: data.index(b"\r\n\r\n")].decode().split("\r\n")[1:])
            assert fields["WARC-Date"] == "2025-01-02T03:04:05Z"
            found[int(fields["WARC-Record-ID"][len("<urn:page:") : -1])] = data
    assert set(found) == set(range(len(texts)))
    back = {r["page_id"]: bytes(r["payload"]) for r in warc.read_warc(spark, f"{path}/warc").collect()}
    assert back == {k: t.encode() for k, t in enumerate(texts)}
    with pytest.raises(ValueError, match="does not end"):
        list(warc.unzipped(gzip.compress(b"cut off")[:-3], "f"))


# --- 10 search -----------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rng = np.random.RandomState(8)
    rows = [(k, [float(v) for v in rng.normal(size=6).round(1)]) for k in range(150)]
    rows += [(200 + k, rows[3][1]) for k in range(30)] + [(203, rows[3][1])]
    rows += [(20, None)][:0] + [(240, None), (260, [float("nan")] * 6), (280, [1.0, None]), (None, rows[0][1]), (320, [1.0, 2.0]), (321, [3.0, -1.0])]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, part int")
    from pyspark.sql import functions as F

    got = topk.top_k(table, F.col("vec_id") % 20 == 0, k=7).collect()
    whole = [(i, [int(np.floor(64 * v)) for v in e]) for i, e in rows if i is not None and e is not None and None not in e and np.isfinite(e).all()]
    want = set()
    for q, x in {(i, tuple(e)) for i, e in whole if i % 20 == 0}:
        found = sorted((-sum(a * b for a, b in zip(x, e, strict=True)), i) for i, e in whole if i != q and len(e) == len(x))
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:7])}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_products_stay_exact_for_large_components():
    q = np.array([[1 << 40, -(1 << 40)]], dtype=np.int64)
    s = np.array([[1 << 40, 1 << 40], [(1 << 20) + 1, 1], [1 << 62, 0]], dtype=np.int64)
    want = [max(-(1 << 63), min((1 << 63) - 1, int(sum(int(a) * int(b) for a, b in zip(q[0], x, strict=True))))) for x in s]
    assert topk.products(q, s)[0].tolist() == want


# --- queries and pipeline ------------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as P
    from tests.conftest import SMOKE_DIR

    from blotter.llm.common import stored

    docs = read(spark, SMOKE_DIR, "documents")
    stages = {}
    frame = docs
    for name, stage in P.STAGES:
        frame = stored(stage(spark, frame, SMOKE_DIR), name)
        stages[name] = frame
    rows = lambda n: stages[n].collect()
    assert all(stages[n].columns == docs.columns for n, _ in P.STAGES[:-1])
    scored = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, read(spark, SMOKE_DIR, "labels")).collect()}
    assert {r["doc_id"] for r in rows("quality_classifier")} == {i for i, s in scored.items() if s >= 0.3}
    good = sorted(rows("quality_classifier"), key=lambda r: r["doc_id"])
    sets = [shingle_set(r["text"]) for r in good]
    links = [(b, a) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert {r["doc_id"] for r in rows("ngram_jaccard_join")} == {good[k]["doc_id"] for k in set(groups_of(len(sets), links))}
    before = {r["doc_id"]: r["text"] for r in rows("ngram_jaccard_join")}
    for r in rows("secret_scans"):
        spans = secret_scan.all_spans(before[r["doc_id"]])[1]
        assert r["text"] == secret_scan.masked(before[r["doc_id"]] or "", spans) and r["n_chars"] == len(r["text"])
    copies = {r["doc_id"]: r["mix_copies"] for r in mixing.planned_mix(stages["secret_scans"]).collect()}
    assert Counter(r["doc_id"] for r in rows("mixing_sources")) == {i: c for i, c in copies.items() if c}
    packed = rows("best_fit_packing")
    assert {r["doc_id"] for r in packed} == {i for i, c in copies.items() if c}
    total = sum(r["length"] for r in packed)
    assert len({r["sequence_id"] for r in packed}) <= 1.02 * total / 4096 + 1
