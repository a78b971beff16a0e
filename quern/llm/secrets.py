"""Secret scan with structural confirmation.

Base patterns (fixed values of the contract) find assignments, access keys and hex runs. Candidates in base64, base64url or hex, on one line
or wrapped over several, are then decoded, and a span is added only where the bytes parse: DER private keys (RSA, DSA, EC, PKCS#8, plain or
encrypted) with every nested length in place, OpenSSH key files with their length-prefixed fields, PEM blocks around either, as text or
encoded once more, and signed tokens whose header is a JSON object with an algorithm.

Cases: a null text counts as empty; an empty text has no spans; null ids are passed through; repeated rows each give a row; ties of starts
are ordered by kind; an empty table gives no rows; other columns are not read by the scan and kept by redact(), whatever their names; a very
long text takes time in proportion to its length, for each pattern passes over a run of characters once.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Container, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tune

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE = 8

#: Runs begin where the character before is none of theirs, and are never given back, so that each is read once.
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++\.[A-Za-z0-9_.-]++")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([A-Za-z0-9+/=\s]++)-----END \1-----")
B64_LINE = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{64,}+={0,2}")
URL64 = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{64,}+={0,2}")
HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}+")
LONG_RUN = re.compile(r"[A-Za-z0-9+/_-]{40}")
LINES = re.compile(r"(?<![A-Za-z0-9+/])(?:[A-Za-z0-9+/]{40,}+[ \t]*+\r?\n[ \t]*+)++(?:[A-Za-z0-9+/]++={0,2})?+")
# Object identifiers of RSA and EC keys, and beginnings of those of password-based encryption.
OID_RSA, OID_EC = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201")
OID_PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))

#: Kinds in the order that breaks ties of equal starts.
KINDS = ("assign", "access", "hex", "pem", "openssh", "der", "jwt")
ORDER = {k: i for i, k in enumerate(KINDS)}


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value of one DER element that fits before end."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill data from at to end; None if they don't."""
    found = []
    while at < end:
        if not (x := _tlv(data, at, end)):
            return None
        found.append(x)
        at = x[2]
    return found


def is_der_key(data: bytes) -> bool:
    """A PKCS#1, DSA, SEC1 or PKCS#8 private key whose nested lengths all fit."""
    top = _tlv(data, 0, len(data))
    if not top or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _items(data, top[1], top[2])
    if not parts:
        return False
    tags = [t for t, _, _ in parts]
    value = lambda i: data[parts[i][1] : parts[i][2]]
    if tags == [0x30, 0x04]:  # encrypted
        inner = _items(data, parts[0][1], parts[0][2])
        return bool(inner) and inner[0][0] == 0x06 and data[inner[0][1] : inner[0][2]].startswith(OID_PBE) and parts[1][2] > parts[1][1]
    if tags[0] != 0x02 or len(value(0)) != 1:
        return False
    version = value(0)[0]
    if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]) and version <= 1:
        return len(tags) == 9 or (version == 1 and len(tags) == 10 and tags[9] == 0x30 and bool(_items(data, parts[9][1], parts[9][2])))
    if len(tags) == 6 and all(t == 0x02 for t in tags):  # DSA: p, q, g, y, x
        return version == 0 and len(value(1)) >= 64 and len(value(2)) >= 20
    if len(tags) >= 2 and tags[1] == 0x04 and version == 1:
        return len(value(1)) >= 16 and all(t in (0xA0, 0xA1) and _items(data, x, y) for t, x, y in parts[2:])
    if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04 and version <= 1 and all(t & 0xE0 == 0xA0 or t in (0x80, 0x81) for t in tags[3:]):
        inner = _items(data, parts[1][1], parts[1][2])
        if not inner or inner[0][0] != 0x06:
            return False
        oid = data[inner[0][1] : inner[0][2]]
        return is_der_key(value(2)) if oid in (OID_RSA, OID_EC) else len(value(2)) >= 16
    return False


def is_openssh_key(data: bytes) -> bool:
    """The magic, then cipher, kdf and options as length-prefixed strings, and a count of keys."""
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 16


def _unbase64(s: str) -> bytes:
    s = s.rstrip("=")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _json(part: str) -> object:
    try:
        return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return None


def is_signed_token(s: str) -> bool:
    """Header and payload are JSON objects, and the header names an algorithm."""
    parts = s.split(".")
    head = _json(parts[0]) if len(parts) > 2 else None
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(_json(parts[1]), dict)


def token_spans(text: str) -> list[tuple[int, int, str]]:
    """Three parts in a row with dots between them, the first of which begins with an encoded brace."""
    found = []
    for m in DOTTED.finditer(text):
        parts, at, free = m[0].split("."), m.start(), 0
        for i, x in enumerate(parts[:-2]):
            # the token may stand behind other characters of the alphabet
            for p in sorted({x.find("eyJ"), x.rfind("eyJ")} - {-1}):
                if i >= free and is_signed_token(".".join([x[p:], *parts[i + 1 : i + 3]])):
                    found.append((at + p, at + sum(map(len, parts[i : i + 3])) + 2, "jwt"))
                    free = i + 3
                    break
            at += len(x) + 1
    return found


def _key_kind(data: bytes) -> str | None:
    """What the whole of data is."""
    if data.startswith(b"openssh-key-v1\0"):
        return "openssh" if is_openssh_key(data) else None
    if data.startswith(b"-----BEGIN "):
        m = PEM.match(data.decode("latin-1"))
        return "pem" if m and _is_pem(m[2]) else None
    return "der" if data[:1] == b"0" and is_der_key(data) else None


def _is_pem(body: str) -> bool:
    return _key_kind(_unbase64("".join(body.split()))) in ("der", "openssh")


def _der_chars(s: str, at: int) -> int:
    """How many base64 characters, without padding, a DER sequence has that begins at a place of s; 0 if none does."""
    head = _unbase64(s[at : at + 8])
    if len(head) < 6 or head[0] != 0x30:
        return 0
    k = head[1] & 0x7F if head[1] & 0x80 else 0
    if k > 4 or (head[1] & 0x80 and not k):
        return 0
    total = 2 + k + (int.from_bytes(head[2 : 2 + k], "big") if k else head[1])
    return (4 * total + 2) // 3


def encoded_key(s: str, ends: Container[int]) -> tuple[int, int, str] | None:
    """Start, end and kind of a key in a base64 run without padding, which may stand behind other characters of the alphabet, and ends
    where the run or one of its lines does."""
    if (kind := _key_kind(_unbase64(s))) is not None:
        return 0, len(s), kind
    at = s.find("MI")
    while at >= 0:
        n = _der_chars(s, at)
        if n >= 60 and at + n in ends and _key_kind(_unbase64(s[at : at + n])) == "der":
            return at, at + n, "der"
        at = s.find("MI", at + 1)
    return None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    """What decodes and parses. A key is told once: within a PEM block as pem, and a wrapped one not again by its lines."""
    found: list[tuple[int, int, str]] = []
    taken = bytearray()

    def free(a: int, b: int) -> bool:
        return 1 not in taken[a:b]

    def add(a: int, b: int, kind: str) -> None:
        found.append((a, b, kind))
        taken.extend(bytes(len(text) - len(taken)))
        taken[a:b] = b"\1" * (b - a)

    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            if _is_pem(m[2]):
                add(m.start(), m.end(), "pem")
    if "eyJ" in text:
        found += token_spans(text)
    if not LONG_RUN.search(text):
        return found
    for m in LINES.finditer(text):
        if len(m[0]) < 64 or not free(*m.span()):
            continue
        places = [i for i, c in enumerate(m[0]) if c not in " \t\r\n="]
        run = "".join(m[0][i] for i in places)
        ends = {len(run), *(k + 1 for k in range(len(places) - 1) if places[k + 1] > places[k] + 1)}
        if (x := encoded_key(run, ends)) is not None:
            stop = m.start() + places[x[1] - 1] + 1
            while text[stop : stop + 1] == "=":
                stop += 1
            add(m.start() + places[x[0]], stop, x[2])
    for pattern, plain in ((B64_LINE, True), (URL64, False)):
        for m in pattern.finditer(text):
            if not free(*m.span()):
                continue
            run = m[0].rstrip("=")
            if not plain:
                if "-" not in run and "_" not in run:
                    continue
                run = run.replace("-", "+").replace("_", "/")
            if (x := encoded_key(run, (len(run),))) is not None:
                add(m.start() + x[0], m.end() if x[1] == len(run) else m.start() + x[1], x[2])
    for m in HEX_ANY.finditer(text):
        if free(*m.span()) and (kind := _key_kind(bytes.fromhex(m[0][: len(m[0]) & ~1]))) is not None:
            add(m.start(), m.end(), kind)
    return found


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda x: (x[0], ORDER[x[2]], x[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in ordered(spans))


SCHEMA = "doc_id long, kind string, start int, end int, value string"


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, base and structural, arrays of (kind, start, end) in code points."""
    tune(docs.sparkSession)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, more = [], []
            for text in b["text"].to_pylist():
                base.append(ordered(base_spans(text or "")))
                more.append(ordered(structural_spans(text or "")))
            cols = [pa.array([[{"kind": k, "start": a, "end": e} for a, e, k in x] for x in side], span) for side in (base, more)]
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), *cols], ["doc_id", "base", "structural"])

    kind = "array<struct<kind:string,start:long,end:long>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, base {kind}, structural {kind}")


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span written over by its kind."""
    out, at = [], 0
    for a, b, k in sorted(spans):
        if b <= at:
            continue
        out += [text[at : max(a, at)], f"[{k}]" if a >= at else ""]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by [kind]; n_chars, if there, is that of the new text."""
    tune(docs.sparkSession)
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t if t is None else mask(t, base_spans(t) + structural_spans(t)) for t in b["text"].to_pylist()]
            cols = {n: b[n] for n in names} | {"text": pa.array(texts, b["text"].type)}
            if "n_chars" in cols:
                olds = b["n_chars"].to_pylist()
                cols["n_chars"] = pa.array([o if t is None else len(t) for t, o in zip(texts, olds, strict=True)], b["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names)

    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, from scan()."""
    spans = scan(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = [[[(x["start"], x["end"], x["kind"]) for x in row] for row in b[side].to_pylist()] for side in ("base", "structural")]
            base, every = sides[0], [x + y for x, y in zip(*sides, strict=True)]
            counts = [pa.array([sum(s[2] == k for s in row) for row in base], pa.int64()) for k in KINDS[:3]]
            sha = pa.array([hashlib.sha256(joined(row).encode()).hexdigest() for row in base])
            yield pa.RecordBatch.from_arrays([b["doc_id"], *counts, sha, pa.array([joined(row) for row in every], pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return spans.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
