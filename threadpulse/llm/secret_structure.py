"""Secrets in whole texts: three base patterns, and keys and tokens whose structure is confirmed.

Candidates in base64 or hex are decoded, and reported only if what they hold parses: a private key in
DER (nested lengths that fit, the version first), an OpenSSH key (its magic and length-prefixed fields),
or a signed token (a JSON header that names an algorithm, a JSON body, a signature). A token's header may begin anywhere in a run
of its letters. PEM blocks may hold header lines; an encrypted block is a key if they name the cipher and its
whole blocks follow. A key in base64 may go over lines of equal width without PEM marks.

Spans are code points of the text, end exclusive, sorted by start and then by the order of KINDS. The base
spans never depend on what structure adds. NULL and empty texts have none. Rows are independent; other
columns than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from threadpulse.llm import words as W

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "der", "token")

# Fixed patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")

_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[^-]|-(?!----)){16,}+)-----END \1-----")
_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:\s*\S+")
_DEK = re.compile(r"DEK-Info:\s*[A-Z0-9-]+,\s*((?:[0-9A-Fa-f]{16}){1,2})\b")
_THREE_PARTS = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]{16,}+))")
_OBJECT = re.compile(r'\{[ \t\r\n]*"(?=(?:[^"\\]|\\.)*+"[ \t\r\n]*:)')
#: Lines of base64 in a row; the separator may be written as a backslash and an n.
_LINES = re.compile(r"(?:(?<![A-Za-z0-9+/_-])(?!(?<=\\)n)|(?<=\\n))[A-Za-z0-9+/_-]{20,}+(?:(?:[ \t]*\r?\n[ \t]*|(?:\\r)?\\n)[A-Za-z0-9+/_-]+)++={0,2}")
_LINE = re.compile(r"(?:\\r)?\\n|([A-Za-z0-9+/_-]+={0,2})")
_CODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_HEXED = re.compile(r"(?:[0-9a-f]{2}){32,}|(?:[0-9A-F]{2}){32,}")


def _decoded(text: str) -> bytes:
    """Bytes of a base64 text in either alphabet, without or with padding; empty if it is none."""
    text = text.rstrip("=").translate({ord("-"): "+", ord("_"): "/"})
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of a DER element that lies within data[at:end]."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size >= 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or start + width > end:
            return None
        size, start = int.from_bytes(data[start : start + width], "big"), start + width
        if size < 0x80:
            return None
    return (tag, start, start + size) if start + size <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill data[start:end] without a rest."""
    found = []
    while start < end:
        if (element := _element(data, start, end)) is None:
            return None
        found.append(element)
        start = element[2]
    return found


def is_der_key(data: bytes) -> bool:
    """A private key: a sequence that spans all bytes and begins with a version; then either integers
    (RSA, DSA), an octet string (elliptic curve), or an algorithm sequence and an octet string (PKCS 8),
    or an encrypted form: an algorithm sequence and an octet string."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data) or outer[2] - outer[1] < 24:
        return False
    parts = _children(data, outer[1], outer[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    if tags[:1] == [0x02] and parts[0][2] - parts[0][1] == 1 and data[parts[0][1]] <= 1:
        if len(tags) >= 6 and set(tags) == {0x02}:
            return True
        if tags[1:2] == [0x04] and parts[1][2] - parts[1][1] >= 16:
            return True
        if tags[1:3] == [0x30, 0x04] and _names_algorithm(data, parts[1]):
            return parts[2][2] - parts[2][1] >= 16
        return False
    return tags == [0x30, 0x04] and _names_algorithm(data, parts[0]) and parts[1][2] - parts[1][1] >= 16


def _names_algorithm(data: bytes, sequence: tuple[int, int, int]) -> bool:
    inner = _children(data, sequence[1], sequence[2])
    return bool(inner) and inner[0][0] == 0x06


def is_openssh_key(data: bytes) -> bool:
    """The magic, then cipher, key derivation and its options as length-prefixed fields, a number of
    keys, the public key and the private part."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), 0
    while fields < 5:
        if fields == 3 and at + 4 <= len(data):
            at += 4
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        at, fields = at + 4 + size, fields + 1
        if at > len(data):
            return False
    return True


def is_signed_token(head: str, body: str) -> bool:
    """Header and body are JSON objects, and the header names an algorithm."""
    try:
        header, claims = (json.loads(_decoded(x)) for x in (head, body))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(claims, dict) and isinstance(header.get("alg"), str)


_JSON = json.JSONDecoder()


def is_encrypted_key(body: str, data: bytes) -> bool:
    """Header lines that say so and name cipher and start vector, and whole cipher blocks."""
    dek = _DEK.search(body)
    return bool(dek and re.search(r"Proc-Type:\s*4,\s*ENCRYPTED", body) and len(data) >= 24 and len(data) % (len(dek[1]) // 2) == 0)


def _is_pem_key(body: str) -> bool:
    """Key or encrypted key in the body of a PEM block, whose header lines are left out."""
    body = body.replace("\\r", "").replace("\\n", "\n")
    lines = [x for x in body.split("\n") if ":" not in x]
    # header lines as lines; in a block without line ends, as words
    for text in ("".join(lines), _HEADER.sub("", body), " ".join(x for x in body.split() if ":" not in x)):
        data = _decoded("".join(text.split()))
        if is_der_key(data) or is_openssh_key(data) or is_encrypted_key(body, data):
            return True
    return False


def _head_start(part: str, body: str) -> int | None:
    """The first place in part from which on it is the header of a signed token with this body.

    Places that differ by four letters decode to suffixes of one another, so four decodings serve all.
    """
    if part.startswith("e") and is_signed_token(part, body):
        return 0
    if "ey" not in part and "ew" not in part:
        return None
    found = []
    for shift in range(4):
        text = _decoded(part[shift:]).decode("latin-1")
        for m in _OBJECT.finditer(text) if text.rstrip().endswith("}") else ():
            if m.start() % 3 == 0:
                try:
                    end = _JSON.raw_decode(text, m.start())[1]
                except (ValueError, RecursionError):
                    continue
                at = shift + m.start() // 3 * 4
                if not text[end:].strip() and is_signed_token(part[at:], body):
                    found.append(at)
                    break
    return min(found, default=None)


def _tokens(text: str) -> list[tuple[int, int, str]]:
    """Signed tokens, also behind other parts or letters that a token could begin with."""
    found, at = [], 0
    for m in _THREE_PARTS.finditer(text):
        if m.start(1) >= at and (start := _head_start(m[1], m[2])) is not None:
            at = m.end(3)
            found.append((m.start(1) + start, at, "token"))
    return found


def _wrapped(text: str) -> list[tuple[int, int, str]]:
    """Keys in base64 over lines of equal width, the last as long or shorter."""
    found = []
    for block in _LINES.finditer(text):
        lines = [m.span(1) for m in _LINE.finditer(text, *block.span()) if m[1]]
        first = 0
        while first < len(lines):
            a, b = lines[first]
            first += 1
            if b - a < 20 or not (text[a] == "M" or text.startswith("b3BlbnNzaC1rZXktdjE", a)):
                continue
            # a DER key says how many lines it has; an OpenSSH key has all of that width and perhaps a shorter one
            outer = _element(_decoded(text[a : b - (b - a) % 4]), 0, 1 << 40)
            letters = (4 * outer[2] + 2) // 3 if outer else 0
            stop = min(first - 1 + (letters + b - a - 1) // (b - a), len(lines) + 1) if text[a] == "M" else len(lines)
            last = first
            while last < min(stop, len(lines)) and lines[last][1] - lines[last][0] == b - a:
                last += 1
            shorter = last < min(stop, len(lines)) and lines[last][1] - lines[last][0] < b - a
            for end in (last + shorter, last):
                if first < end and (text[a] != "M" or end == stop):
                    data = _decoded("".join(text[c:d] for c, d in lines[first - 1 : end]))
                    if is_der_key(data) or is_openssh_key(data):
                        found.append((a, lines[end - 1][1], "der"))
                        first = end
                        break
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 or more has no maximal run around it but itself, so the short runs need not be visited.
    found += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return found


def structured_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans whose decoded content is a key or a signed token; a span inside a PEM block is part of it."""
    found = []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            if _is_pem_key(m[2]):
                found.append((m.start(), m.end(), "pem"))
    if "." in text:
        found += _tokens(text)
    if "\n" in text or "\\n" in text:
        found += [w for w in _wrapped(text) if not any(a <= w[0] < b for a, b, _ in found)]
    covered = list(found)
    for pattern, read in ((_CODED, _decoded), (_HEXED, _from_hex)):
        for m in pattern.finditer(text):
            if not any(a <= m.start() < b for a, b, _ in covered):
                data = read(m[0])
                if is_der_key(data) or is_openssh_key(data):
                    found.append((m.start(), m.end(), "der"))
    return found


def _from_hex(text: str) -> bytes:
    return bytes.fromhex(text)


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans, each in order."""
    text = text or ""
    base = base_spans(text)
    return ordered(base), ordered([*base, *structured_spans(text)])


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[{}]") -> str:
    """The text with each span, or group of overlapping spans, replaced by the mark with the first kind."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], mark.format(kind)]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, and n_spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            rows = [find(text) for text in batch.column("text").to_pylist()]
            kinds = [[kind for _, _, kind in base] for base, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    *(pa.array([k.count(kind) for k in kinds], pa.int64()) for kind in BASE_KINDS),
                    pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                    pa.array([written(spans) for _, spans in rows], pa.string()),
                    pa.array([len(spans) for _, spans in rows], pa.int64()),
                ],
                ["doc_id", *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans", "n_spans"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def redact(docs: DataFrame) -> DataFrame:
    """The rows with every span in the text replaced by its kind in brackets; NULL stays NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            at = batch.schema.get_field_index("text")
            clean = [None if t is None else redacted(t, find(t)[1]) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
