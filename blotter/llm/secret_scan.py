"""Secret scans with structural confirmation.

Plain patterns find the base spans (assignments, access keys, long hex). Runs of base64 or hex
characters are then decoded and reported only when their structure confirms them: DER key
encodings whose nested lengths add up, SSH key blobs of length-prefixed fields, and signed
tokens whose header is JSON that names an algorithm. What decodes to text is scanned in turn, to
a fixed depth, as keys are often stored encoded once more. Whole texts are read in Arrow batches;
nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

#: The base patterns and the least lengths of what they must hold.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
#: Order of the kinds in a span list, for spans that start together.
KINDS = ("assign", "access", "hex", "token", "der", "ssh", "pgp")
#: Signed tokens start with an encoded brace, so with ew or ey. Runs that may hold an encoded structure; shorter ones cannot hold a key.
ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}KEY(?: BLOCK)?)-----((?:(?!-----).)*+)-----END \1-----", re.DOTALL)
#: What stands in an armoured key's lines for a line end: escaped ones, and strings joined in code.
LINE_END = re.compile(
    r"(?:\\+[nrt])+|[\"']\s*[+.,&\\]?\s*[\"']|&#(?:1[03]|[xX]0?[aAdD]);|<br\s*/?>|(?:%0[aAdD])+", re.IGNORECASE
)
#: Marks before each line of a quoted or commented key, with the space after them.
QUOTED = re.compile(r"^(?:[>#*|;]+|//+|--)(?:\s+|$)|^[>|#]+")
#: Escaped characters of base64 and armour, and what they stand for.
ESCAPES = (
    ("\\/", "/"), ("\\u002b", "+"), ("\\u002B", "+"), ("\\u003d", "="), ("\\u003D", "="),
    ("%2b", "+"), ("%2B", "+"), ("%2f", "/"), ("%2F", "/"), ("%3d", "="), ("%3D", "="), ("&#43;", "+"), ("&#61;", "="), ("&#47;", "/"),
)
HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:\s.*")
ENCRYPTED = re.compile(r"DEK-Info:\s*[A-Z0-9-]+,([0-9A-Fa-f]+)\s*")
#: Runs on lines of their own, the ends of which may be escaped, and the parts of such a chain.
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:(?<=\\)[nr])?+([A-Za-z0-9+/_-]{16,}+"
    r"(?:[ \t]*+(?:\r?\n|(?:\\+[nr])++)[ \t]*+[A-Za-z0-9+/_-]++)++)={0,2}"
)
PART = re.compile(r"(?:\\+[nr])++|([A-Za-z0-9+/_-]++)")
#: An encrypted token has five parts, of which the second may be empty.
SEALED = re.compile(
    r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]*)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)(?![A-Za-z0-9_-])"
)
#: Bytes in hex with colons between.
COLONS = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){23,}(?![0-9A-Fa-f:])")
#: An encoded key that other characters of its alphabet stand right before: starts of DER and SSH keys.
INSIDE = re.compile(r"(?:(?<=/)|(?<=[A-Za-z0-9_+-]))(?:MII[A-Za-z0-9]|AAAA[BCEGI]3NzaC1|AAAAE2VjZHNh|b3BlbnNzaC1rZXktdjEA)")
#: How often what a candidate decodes to is scanned again.
NESTED = 2
#: No kind of SSH key has more fields than its certificates, about twenty.
SSH_FIELDS = 32
ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{24,}")
SSH_KINDS = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-", b"sk-ssh-", b"sk-ecdsa-", b"openssh-key-v1")
#: Starts of the kinds, as far as a short first line tells.
SSH_STARTS = tuple(kind[:11] for kind in SSH_KINDS)
MASK = "[SECRET]"

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base pattern that are long enough."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def unbase64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padded or not; None if it is not base64."""
    body = text.rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the element at ``at``, if it fits before ``end``."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if size < 0x80:  # DER takes the shortest form
            return None
    return (tag, at, at + size) if at + size <= end else None


def der_children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill the range exactly, or None."""
    found = []
    while at < end:
        x = der_element(data, at, end)
        if x is None:
            return None
        found.append(x)
        at = x[2]
    return found


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE that spans the data, whose parts nest and have the shape of a key: PKCS#1 or
    DSA (integers only), EC (version and octets), PKCS#8 (version, algorithm, octets) or a
    public key (algorithm and bits). Algorithms start with an object identifier."""
    outer = der_element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    parts = der_children(data, outer[1], outer[2])
    if not parts or len(parts) < 2:
        return False
    tags = [t for t, _, _ in parts]
    sizes = [b - a for _, a, b in parts]

    def algorithm(k: int) -> bool:
        inside = der_children(data, parts[k][1], parts[k][2]) if tags[k] == 0x30 else None
        return bool(inside) and inside[0][0] == 0x06

    if set(tags) == {0x02}:
        return len(tags) in (2, 6, 9) and max(sizes) >= 16
    if tags[0] == 0x02 and sizes[0] == 1 and len(tags) >= 2:
        if tags[1] == 0x04:
            return sizes[1] >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
        return len(tags) >= 3 and algorithm(1) and tags[2] == 0x04
    if tags[0] == 0x30 and len(tags) == 2:
        return (tags[1] == 0x03 and sizes[1] >= 16 and algorithm(0)) or (tags[1] == 0x04 and algorithm(0))
    return False


def is_ssh_key(data: bytes) -> bool:
    """Fields of four length bytes each that add up to the data, the first a known key kind."""
    if data.startswith(b"openssh-key-v1\0"):
        return True
    at, first = 0, None
    while at < len(data):
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + size > len(data):
            return False
        if first is None:
            first = data[at : at + size]
            if not first.startswith(SSH_KINDS):
                return False
        at += size
    return first is not None and len(data) > len(first) + 4


def is_signed_token(header: str, payload: str) -> bool:
    """The header decodes to a JSON object that names an algorithm, the payload decodes."""
    head, body = unbase64(header), unbase64(payload)
    if head is None or body is None or not head.lstrip().startswith(b"{"):
        return False
    try:
        parsed = json.loads(head)
    except (ValueError, RecursionError):
        return False
    return isinstance(parsed, dict) and isinstance(parsed.get("alg"), str)


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    if data[0] == 0x30 and is_der_key(data):
        return "der"
    if is_ssh_key(data):
        return "ssh"
    return None


def is_secret_packets(data: bytes) -> bool:
    """OpenPGP packets whose lengths fill the data, the first a secret key (version 3 to 6)."""
    at, first = 0, True
    while at < len(data):
        tag = data[at]
        if not tag & 0x80 or at + 2 > len(data):
            return False
        if tag & 0x40:
            kind, size = tag & 0x3F, data[at + 1]
            head = 2
            if 192 <= size < 224 and at + 3 <= len(data):
                size, head = ((size - 192) << 8) + data[at + 2] + 192, 3
            elif size == 255 and at + 6 <= len(data):
                size, head = int.from_bytes(data[at + 2 : at + 6], "big"), 6
            elif size >= 192:
                return False
        else:
            kind, width = tag >> 2 & 0xF, 1 << (tag & 3)
            if width == 8 or at + 1 + width > len(data):
                return False
            size, head = int.from_bytes(data[at + 1 : at + 1 + width], "big"), 1 + width
        if at + head + size > len(data):
            return False
        if first and (kind != 5 or size < 16 or not 3 <= data[at + head] <= 6):
            return False
        at, first = at + head + size, False
    return not first


def armoured_kind(body: str) -> str | None:
    """Kind of the key between armour lines, whose line ends may be escaped. Header lines are
    left out; under DEK-Info the key is encrypted, so its length in cipher blocks confirms it."""
    for escaped, plain in ESCAPES:
        body = body.replace(escaped, plain)
    lines = [QUOTED.sub("", line.strip()).strip() for line in LINE_END.sub("\n", body).splitlines()]
    block, at = 0, 0
    while at < len(lines) and (not lines[at] or HEADER.fullmatch(lines[at])):
        cipher = ENCRYPTED.fullmatch(lines[at])
        block = len(cipher[1]) // 2 if cipher else block
        at += 1
    if lines and re.fullmatch(r"=[A-Za-z0-9+/]{4}", next((x for x in reversed(lines) if x), "")):
        # the checksum line of an OpenPGP block
        lines = lines[: max(k for k, x in enumerate(lines) if x)]
        if is_secret_packets(unbase64("".join("".join(lines[at:]).split())) or b""):
            return "pgp"
    data = unbase64("".join("".join(lines[at:]).split()))
    if data and is_secret_packets(data):
        return "pgp"
    if block >= 8 and data and len(data) % block == 0:
        return "der"
    return key_kind(data)


def der_size(head: bytes) -> int:
    """Bytes of the SEQUENCE that starts with ``head``, 0 if none does."""
    if len(head) < 6 or head[0] != 0x30:
        return 0
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    if n > 4:
        return 0
    return 2 + n + int.from_bytes(head[2 : 2 + n], "big") if n else 2 + head[1]


class Chain:
    """Runs of base64 or hex on lines of their own, with sums of their lengths, so that no line's
    trial walks over the others."""

    def __init__(self, parts: list[str]):
        self.parts = parts
        self.before = [0, *accumulate(map(len, parts))]
        # where the lines of one width that a line belongs to end
        self.same = [0] * len(parts)
        for k in range(len(parts) - 1, -1, -1):
            follows = k + 1 < len(parts) and len(parts[k + 1]) == len(parts[k])
            self.same[k] = self.same[k + 1] if follows else k + 1

    def chars(self, at: int, start: int, n: int) -> str:
        """``n`` characters from ``start`` on of the lines from ``at`` on."""
        first = bisect_right(self.before, self.before[at] + start) - 1
        skip = self.before[at] + start - self.before[first]
        out = ""
        while first < len(self.parts) and len(out) < skip + n:
            out += self.parts[first]
            first += 1
        return out[skip : skip + n]

    def line_at(self, at: int, chars: int) -> int | None:
        """The line behind which ``chars`` characters from line ``at`` on end, if one does."""
        k = bisect_left(self.before, self.before[at] + chars)
        return k if k < len(self.before) and self.before[k] == self.before[at] + chars else None


def ssh_ends(chain: Chain, at: int, end: int) -> list[int]:
    """Bytes up to the end of each length-prefixed field after the first, in the lines ``at`` to
    ``end``; only the length bytes are decoded."""
    total = (chain.before[end] - chain.before[at]) * 3 // 4
    found, place = [], 0
    for field in range(SSH_FIELDS):
        if place + 4 > total:
            break
        group = place // 3
        data = unbase64(chain.chars(at, 4 * group, 8)) or b""
        size = data[place - 3 * group : place - 3 * group + 4]
        if len(size) < 4:
            break
        place += 4 + int.from_bytes(size, "big")
        if place <= total and field:
            found.append(place)
    return found


def wrapped_key(chain: Chain, at: int) -> tuple[str, int] | None:
    """Kind of the wrapped key that starts with a line, and the line behind it. A DER key tells
    its size; an SSH key has lines of one width and a last one that may be shorter."""
    parts = chain.parts
    first = parts[at]
    if first.startswith("30") and ANY_HEX.fullmatch(first):
        decode, chars = _unhex, 2 * der_size(bytes.fromhex(first[:12]))
    elif first[0] == "M":
        decode, chars = unbase64, -(-der_size(unbase64(first[:8]) or b"") * 4 // 3)
    else:
        head = unbase64(first[:28]) if first.startswith(("AAAA", "b3BlbnNzaC")) else None
        if not head or not head[4 if head[0] == 0 else 0 :].startswith(SSH_STARTS):
            return None
        end = chain.same[at]
        end += end < len(parts) and len(parts[end]) < len(first)
        if (unbase64(chain.chars(at, 0, 20)) or b"").startswith(b"openssh-key-v1\0"):
            return "ssh", end
        last = None
        for size in ssh_ends(chain, at, end):
            # characters that decode to so many bytes, and no more
            for chars in range(-(-size * 4 // 3), -(-(size + 1) * 4 // 3)):
                line = chain.line_at(at, chars)
                last = max(last or 0, line) if line is not None and at < line <= end else last
        return ("ssh", last) if last else None
    line = chain.line_at(at, chars) if chars else None
    if line is None or line <= at:
        return None
    kind = key_kind(decode("".join(parts[at:line])))
    return (kind, line) if kind else None


def _unhex(text: str) -> bytes | None:
    try:
        return bytes.fromhex(text)
    except ValueError:
        return None


def wrapped_spans(text: str) -> list[Span]:
    """Keys in base64 or hex that is wrapped over lines without armour."""
    found = []
    for chain in WRAPPED.finditer(text):
        spans = [m.span(1) for m in PART.finditer(text, chain.start(1), chain.end(1)) if m[1]]
        parts = [text[a:b] for a, b in spans]
        lines = Chain(parts)
        k = 0
        while k < len(parts) - 1:
            key = wrapped_key(lines, k)
            if key and key[1] > k + 1:
                end = spans[key[1] - 1][1]
                padding = len(text[end : end + 2]) - len(text[end : end + 2].lstrip("="))
                found.append((key[0], spans[k][0], end + padding))
            k = key[1] if key else k + 1
    return found


def is_sealed_token(header: str, *parts: str) -> bool:
    """The header decodes to a JSON object that names an algorithm and a cipher, and all decode."""
    return is_signed_token(header, parts[1]) and all(unbase64(p) is not None for p in parts) and '"enc"' in unbase64(header).decode("utf-8", "replace")


def nested_kind(data: bytes | None, depth: int) -> str | None:
    """Kind of the first key in what a candidate decodes to, when that is text."""
    if not data or depth <= 0 or len(data) < 32:
        return None
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    found = confirmed_spans(text, [], depth - 1)
    return ordered(found)[0][0] if found else None


def key_inside(text: str, start: int, end: int) -> tuple[str, int, int] | None:
    """An encoded key in a run whose first characters belong to something else, as after a path or
    glued to a word. A DER key tells where it ends; others go up to the end of the run."""
    for m in INSIDE.finditer(text, start, end):
        a, b = m.start(), end
        if text.startswith("MII", a):
            size = der_size(unbase64(text[a : a + 8]) or b"")
            chars = -(-size * 4 // 3)
            if not size or a + chars > end:
                continue
            b = a + chars
        kind = key_kind(unbase64(text[a:b]))
        if kind:
            padding = len(text[b : b + 2]) - len(text[b : b + 2].lstrip("="))
            return kind, a, b + padding
    return None


def confirmed_spans(text: str, base: list[Span], depth: int = NESTED) -> list[Span]:
    """Spans added by decoding candidates: signed or encrypted tokens, and encoded or armoured keys,
    also inside what a candidate decodes to."""
    found = [("token", *m.span()) for m in SIGNED.finditer(text) if is_signed_token(m[1], m[2])]
    found += [("token", *m.span()) for m in SEALED.finditer(text) if is_sealed_token(*m.groups())]
    armoured = []
    if "-----BEGIN" in text:
        for m in ARMOUR.finditer(text):
            kind = armoured_kind(m[2])
            if kind:
                armoured.append((kind, *m.span()))
    found += armoured
    for m in ENCODED.finditer(text):
        data = unbase64(m[0])
        kind = key_kind(data) or nested_kind(data, depth)
        if kind:
            found.append((kind, *m.span()))
        elif inner := key_inside(text, *m.span()):
            found.append(inner)
    if ":" in text:
        for m in COLONS.finditer(text):
            kind = key_kind(bytes.fromhex(m[0].replace(":", "")))
            if kind:
                found.append((kind, *m.span()))
    for kind, a, b in wrapped_spans(text):
        if not any(x <= a and b <= y for _, x, y in armoured):
            found.append((kind, a, b))
    runs = [m.span() for m in ANY_HEX.finditer(text)]
    for a, b in [(a, b) for kind, a, b in base if kind == "hex"] + runs:
        if (b - a) % 2 == 0:
            inner = key_kind(bytes.fromhex(text[a:b]))
            if inner:
                found.append((inner, a, b))
    return list(dict.fromkeys(found))


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered(spans))


def all_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text; none for a null text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, base + confirmed_spans(text, base)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, overlaps joined, replaced by one mark."""
    out, at = [], 0
    for _, a, b in ordered(spans):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, n_confirmed, base_sha256, spans.

    Offsets count code points, ends are exclusive. A null or empty text has no spans (its
    base_sha256 is that of the empty string). Repeated rows are scanned alike; other columns
    are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("assign", "access", "hex", "more", "digest", "spans")}
            for text in batch.column(1).to_pylist():
                base, spans = all_spans(text)
                for kind in KINDS[:3]:
                    out[kind].append(sum(k == kind for k, _, _ in base))
                out["more"].append(len(spans) - len(base))
                out["digest"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(out[c], pa.int64()) for c in ("assign", "access", "hex", "more")),
                    *(pa.array(out[c], pa.string()) for c in ("digest", "spans")),
                ],
                names=["id", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"
    )
    return docs.select(id_col, text_col).mapInArrow(_renamed(scan, id_col), schema)


def _renamed(fn, id_col: str):
    def run(batches):
        for out in fn(batches):
            yield out.rename_columns([id_col, *out.schema.names[1:]])

    return run


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every found span of the text masked and, where a text changed, its length
    column set anew. All rows and columns stay; null texts stay null."""
    names = docs.columns

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index(text_col)).to_pylist()
            spans = [all_spans(t)[1] for t in texts]
            if any(spans):
                new = [masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
                columns = {n: batch.column(k) for k, n in enumerate(names)}
                columns[text_col] = pa.array(new, batch.schema.field(text_col).type)
                if length_col in columns:
                    old = columns[length_col].to_pylist()
                    sizes = [len(t) if s else n for t, s, n in zip(new, spans, old, strict=True)]
                    columns[length_col] = pa.array(sizes, batch.schema.field(length_col).type)
                batch = pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)
            yield batch

    return docs.mapInArrow(mask, docs.schema)
