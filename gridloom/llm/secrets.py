"""Secret scans: patterns, then structural confirmation of encoded candidates.

Three plain kinds (``assign``, ``access``, ``hex``) come from patterns. Three
more are reported only when their bytes parse as what they claim to be:

* ``jwt``: three base64url parts whose header is a JSON object that names an
  algorithm, whose payload is a JSON object, and which carries a signature;
* ``der``: base64 or hex that decodes to a private key in the nested
  tag-length-value form (RSA, DSA, EC, PKCS#8, plain or encrypted), every length
  checked against what it holds;
* ``openssh``: base64 or hex that decodes to the magic word and the
  length-prefixed fields of an OpenSSH private key.

An armoured block is reported with its armour. Every scan takes time in
proportion to the text.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.frames import col, slices

# The kinds in the order of a report, and the plain patterns.
KINDS = ("assign", "access", "hex", "jwt", "der", "openssh")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE_CHARS = 12

JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40})PRIVATE KEY-----([^-]*)-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----")
WRAPPED = re.compile(r"[A-Za-z0-9+/]{24,}(?:(?:\r?\n|\\n)[A-Za-z0-9+/]+)*={0,2}")
URL_SAFE = re.compile(r"[A-Za-z0-9_-]{32,}={0,2}")
LONG_HEX = re.compile(r"[0-9A-Fa-f]{48,}")
OPENSSH_MAGIC = b"openssh-key-v1\x00"

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType(), False),
            T.StructField("start", T.LongType(), False),
            T.StructField("end", T.LongType(), False),
        ]
    ),
    False,
)
ARROW_SPANS = pa.list_(
    pa.struct([pa.field("kind", pa.string(), False), pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)])
)

SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and stop of the value at ``at``; None unless it ends by ``end``."""
    if at + 2 > end:
        return None
    tag, first = data[at], data[at + 1]
    at += 2
    if first < 0x80:
        length = first
    else:
        n = first & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        length = int.from_bytes(data[at : at + n], "big")
        at += n
    return (tag, at, at + length) if at + length <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at`` to ``end`` exactly."""
    out = []
    while at < end:
        found = _element(data, at, end)
        if found is None or len(out) > 64:
            return None
        out.append(found)
        at = found[2]
    return out


def der_key_bytes(data: bytes) -> int:
    """Length of the private key that ``data`` begins with; 0 if there is none."""
    top = _element(data, 0, len(data))
    if top is None or top[0] != SEQUENCE:
        return 0
    parts = _children(data, top[1], top[2])
    if not parts:
        return 0
    tags = [t for t, _, _ in parts]

    def algorithm(part: tuple[int, int, int]) -> bool:
        inner = _children(data, part[1], part[2])
        return bool(inner) and inner[0][0] == OID and inner[0][2] > inner[0][1]

    if tags == [SEQUENCE, OCTETS]:  # encrypted
        good = algorithm(parts[0]) and parts[1][2] - parts[1][1] >= 16
    elif tags[0] != INTEGER or parts[0][2] - parts[0][1] != 1:
        good = False
    elif tags[1:3] == [SEQUENCE, OCTETS]:  # algorithm, then the key itself
        good = data[parts[0][1]] in (0, 1) and algorithm(parts[1]) and parts[2][2] - parts[2][1] >= 16
    elif tags[1:2] == [OCTETS]:  # elliptic curve: the scalar, then tagged options
        good = data[parts[0][1]] == 1 and parts[1][2] - parts[1][1] >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
    elif tags[:6] == [INTEGER] * 6:  # numbers only
        good = len(tags) in (6, 9, 10) and parts[1][2] - parts[1][1] >= 32
    else:
        good = False
    return top[2] if good else 0


def openssh_key_bytes(data: bytes) -> int:
    """Length of the OpenSSH private key that ``data`` begins with, or 0."""
    if not data.startswith(OPENSSH_MAGIC):
        return 0
    at = len(OPENSSH_MAGIC)

    def field(at: int) -> int:
        if at + 4 > len(data):
            return -1
        stop = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return stop if stop <= len(data) else -1

    for _ in range(3):  # cipher, key derivation, its options
        if (at := field(at)) < 0:
            return 0
    if at + 4 > len(data):
        return 0
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 16:
        return 0
    for _ in range(keys + 1):  # public parts, then the private part
        start = at
        if (at := field(at)) < 0:
            return 0
    return at if at - start > 16 else 0


def confirmed(data: bytes) -> tuple[str, int] | None:
    """Kind and length of the key that ``data`` begins with."""
    if n := der_key_bytes(data):
        return "der", n
    if n := openssh_key_bytes(data):
        return "openssh", n
    return None


def _unpadded(text: str, altchars: bytes | None = None) -> bytes:
    text = text[: len(text) - (len(text) % 4 == 1)]
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=altchars)
    except (binascii.Error, ValueError):
        return b""


def _json_object(part: str) -> dict | None:
    try:
        value = json.loads(_unpadded(part, b"-_"))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _signed_tokens(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in JWT.finditer(text):
        head, body, _ = m.group().split(".")
        header = _json_object(head)
        if header and isinstance(header.get("alg"), str) and header["alg"] and _json_object(body) is not None:
            out.append(("jwt", m.start(), m.end()))
    return out


def _encoded_keys(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in ARMOUR.finditer(text):
        body = re.sub(r"\\n|[^A-Za-z0-9+/=]", "", m.group(2)).rstrip("=")
        if found := confirmed(_unpadded(body)):
            out.append((found[0], m.start(), m.end()))
    for m in WRAPPED.finditer(text):
        run = m.group()
        # the first byte of a key's outer sequence, or of the magic word
        if run[0] not in "Mb":
            continue
        at, line = [], re.sub(r"\r?\n|\\n", lambda g: " " * len(g.group()), run).rstrip("=")
        at = [i for i, c in enumerate(line) if c != " "]
        if found := confirmed(_unpadded(line.replace(" ", ""))):
            chars = -(-found[1] * 4 // 3)
            stop = m.start() + at[chars - 1] + 1
            while stop < len(text) and text[stop] == "=" and stop - m.start() - at[chars - 1] <= 2:
                stop += 1
            out.append((found[0], m.start(), stop))
    for m in URL_SAFE.finditer(text):
        run = m.group().rstrip("=")
        if run[0] in "Mb" and ("-" in run or "_" in run) and (found := confirmed(_unpadded(run, b"-_"))):
            out.append((found[0], m.start(), m.start() + -(-found[1] * 4 // 3)))
    for m in LONG_HEX.finditer(text):
        run = m.group()
        if run[:2] in ("30", "6f", "6F") and (found := confirmed(bytes.fromhex(run[: len(run) & ~1]))):
            out.append((found[0], m.start(), m.start() + 2 * found[1]))
    return _outermost(out)


def _outermost(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Drop a key that lies inside another, such as a block's body in its armour."""
    out: list[tuple[str, int, int]] = []
    for kind, start, end in sorted(set(spans), key=lambda s: (s[1], -s[2], s[0])):
        if not out or end > out[-1][2]:
            out.append((kind, start, end))
    return out


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end) in code points, end exclusive,
    by start, then by the order of ``KINDS``, then by end."""
    if not text:
        return []
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE_CHARS]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    out += _signed_tokens(text)
    out += _encoded_keys(text)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _spans_of(texts: pa.Array) -> pa.Array:
    rows = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t.as_py())] for t in texts]
    return pa.array(rows, ARROW_SPANS)


def scan_secrets(df: DataFrame, text: str = "text", spans: str = "secret_spans") -> DataFrame:
    """Add ``spans``: array of (kind, start, end) of the secrets in each text.

    A null or empty text has an empty array. Repeated rows stay, each with its
    spans; an empty table stays empty; a column already called ``spans`` is
    replaced. One pass over the table, no shuffle.
    """
    find = F.arrow_udf(_spans_of, SPANS)
    return df.withColumn(spans, find(col(text)))


def _blotted(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts, spans):
        text, found = text.as_py(), found.as_py()
        if not text or not found:
            out.append(text)
            continue
        parts, at = [], 0
        for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
            if s["end"] <= at:
                continue
            parts.append(text[at : max(at, s["start"])])
            if s["start"] >= at:
                parts.append(f"[{s['kind']}]")
            at = s["end"]
        out.append("".join(parts) + text[at:])
    return pa.array(out, pa.string())


def _clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in slices(batches):
        yield _blotted(texts, _spans_of(texts))


def scan_and_redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace each secret of ``text`` by its kind in brackets, in one pass; as
    :func:`scan_secrets` and :func:`redact_secrets` one after the other."""
    return df.withColumn(text, F.arrow_udf(_clean, T.StringType())(col(text)))


def redact_secrets(df: DataFrame, text: str = "text", spans: str = "secret_spans") -> DataFrame:
    """Replace each span of ``text`` by its kind in brackets and drop ``spans``.

    Overlapping spans become one replacement, named by the first. Texts without
    a span, and null texts, are left as they are.
    """
    blot = F.arrow_udf(_blotted, T.StringType())
    return df.withColumn(text, blot(col(text), col(spans))).drop(spans)
