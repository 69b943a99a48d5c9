"""Secret scans: patterns for candidates, and structural confirmation before the method reports a span of its own.

Base kinds (patterns alone): assign, access, hex. The method's kinds are reported only if what they claim to be parses:

* pem: an armoured private key; the base64 body decodes to DER whose nested lengths add up, or to the key container
  that starts with "openssh-key-v1" and whose length-prefixed fields fit.
* jwt: a signed token; the header decodes to a JSON object that names an algorithm, the payload to a JSON object.
* der: bare base64, plain or URL-safe, in one run or wrapped over lines, that decodes to a DER private key (a sequence
  that starts with a small version integer and fills the bytes exactly, inner elements included). The sequence's own
  header says how many characters belong to it. Bodies inside a confirmed pem are not reported again.
* hexder: the same in hex.

Every candidate pattern is tried only at the start of a run of its characters, so a scan is linear in the text; a wrapped
body is followed for as many characters as its header claims.

Defined cases: null and empty texts have no span: counts 0, the digest of the empty string, spans ''. Rows are independent
of each other (no shuffle), so repeated rows repeat their results, and an empty table gives an empty result. Other columns,
whatever their names, are not read, and redact_secrets returns them as they are.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spans_sql, table

KINDS = ("assign", "access", "hex", "pem", "jwt", "der", "hexder")
BASE_KINDS = 3
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a longer run is one match, a shorter one fails
_HEX = re.compile(r"[0-9a-f]{24,}")
_ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]*+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+")
#: The first line of a base64 sequence: its tag and the top bits of its length make "M" and one of A to P.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])M[A-P][A-Za-z0-9+/_-]{30,}+")
_WRAP = re.compile(r"(?:\r?\n|\\r?\\n|\\n)[\x20\t]*([A-Za-z0-9+/_-]+)")
_HEX_DER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}+")


_PLAIN = str.maketrans("-_", "+/")


def _unbase64(body: str, alphabet: bytes | None = None) -> bytes | None:
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), altchars=alphabet, validate=True)
    except (binascii.Error, ValueError):
        return None


def tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER element at `at`; None if its length does not fit before `end`."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 128:
        width = n & 127
        if not 1 <= width <= 4 or at + width > end or data[at] == 0:
            return None
        n, at = int.from_bytes(data[at : at + width], "big"), at + width
        if n < 128:
            return None
    return (tag, at, at + n) if at + n <= end else None


def fills(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill data[at:end] exactly, constructed ones checked inside; None if they do not."""
    found, todo = [], [(at, end, True)]
    while todo:
        at, end, top = todo.pop()
        while at < end:
            element = tlv(data, at, end)
            if element is None:
                return None
            if top:
                found.append(element)
            if element[0] & 0x20:
                todo.append((element[1], element[2], False))
            at = element[2]
    return found


def wrapped_body(text: str, start: int, end: int) -> tuple[str, int] | None:
    """(characters, end) of the base64 sequence whose first line is text[start:end], as long as its header says; None if the
    text ends before, or goes on after, as many characters."""
    head = _unbase64(text[start : start + 8].translate(_PLAIN))
    if head is None or head[0] != 0x30:
        return None
    n, width = head[1], 0
    if n >= 128:
        width = n & 127
        if not 1 <= width <= 4:
            return None
        n = int.from_bytes(head[2 : 2 + width], "big")
    need, parts = -(-4 * (2 + width + n) // 3), [text[start:end]]
    have = end - start
    while have < need and (m := _WRAP.match(text, end)):
        parts.append(m[1])
        have, end = have + len(m[1]), m.end()
    if have != need:
        return None
    padding = -need % 4
    return "".join(parts), end + padding if padding and text.startswith("=" * padding, end) else end


def is_private_der(data: bytes | None) -> bool:
    """A sequence that is all of `data` and starts with version 0 to 3 followed by the parts of a private key."""
    if not data or len(data) < 24 or data[0] != 0x30:
        return False
    outer = tlv(data, 0, len(data))
    if outer is None or outer[2] != len(data):
        return False
    inner = fills(data, outer[1], outer[2])
    if inner is None or len(inner) < 2:
        return False
    tag, a, b = inner[0]
    if tag != 0x02 or b - a != 1 or data[a] > 3:
        return False
    second = inner[1][0]
    numbers = len(inner) >= 6 and all(t == 0x02 for t, _, _ in inner[:6])  # modulus, exponents, primes
    wrapped = second == 0x30 and len(inner) >= 3 and inner[2][0] == 0x04  # algorithm, then the key as octets
    curve = second == 0x04  # the secret number, then optional parameters
    return numbers or wrapped or curve


def is_encrypted_der(data: bytes | None) -> bool:
    """A sequence of an algorithm sequence and octets, as encrypted key containers are."""
    if not data or data[0] != 0x30:
        return False
    outer = tlv(data, 0, len(data))
    inner = fills(data, outer[1], outer[2]) if outer and outer[2] == len(data) else None
    return bool(inner) and [t for t, _, _ in inner] == [0x30, 0x04]


def is_key_container(data: bytes | None) -> bool:
    """The "openssh-key-v1" container: cipher, kdf, options, number of keys, that many public parts, one private part."""
    magic = b"openssh-key-v1\0"
    if not data or not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bool:
        nonlocal at
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at <= len(data)

    if not (field() and field() and field()) or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return 1 <= keys <= 64 and all(field() for _ in range(keys + 1)) and at == len(data)


def is_key_armour(label: str, body: str) -> bool:
    """Header lines ("Name: value") may precede the base64 body; an encrypted classic body is opaque but whole blocks."""
    text = [x.strip() for x in re.split(r"\r?\n|\\n", body)]
    headers = [x for x in text if ":" in x]
    data = _unbase64("".join(x for x in text if ":" not in x))
    if not data:
        return False
    if any("ENCRYPTED" in h for h in headers):
        return len(data) >= 32 and len(data) % 8 == 0
    return is_private_der(data) or is_key_container(data) or (label.startswith("ENCRYPTED") and is_encrypted_der(data))


def is_signed_token(token: str) -> bool:
    head, payload, _ = token.split(".")
    try:
        header = json.loads(_unbase64(head, b"-_") or b"")
        claims = json.loads(_unbase64(payload, b"-_") or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict)


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted by start, then kind."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        opened = None
        for m in _ARMOUR.finditer(text):
            if m[1] == "BEGIN":
                opened = m
            elif opened is not None and opened[2] == m[2]:
                if is_key_armour(m[2], text[opened.end() : m.start()]):
                    spans.append((opened.start(), 3, m.end()))
                opened = None
    if "eyJ" in text:
        spans += [(m.start(), 4, m.end()) for m in _TOKEN.finditer(text) if is_signed_token(m[0])]
    armoured = [(a, b) for a, kind, b in spans if kind == 3]
    for m in _BASE64.finditer(text):
        found = wrapped_body(text, m.start(), m.end())
        if found and is_private_der(_unbase64(found[0].translate(_PLAIN))) and not any(a <= m.start() < b for a, b in armoured):
            spans.append((m.start(), 5, found[1]))
    if "30" in text:
        spans += [(m.start(), 6, m.end()) for m in _HEX_DER.finditer(text) if len(m[0]) % 2 == 0 and is_private_der(bytes.fromhex(m[0]))]
    return sorted(spans)


def _named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches):
    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            spans = find_secrets(text.as_py() or "")
            base = [x for x in spans if x[1] < BASE_KINDS]
            row = [doc_id, *(sum(x[1] == k for x in base) for k in range(BASE_KINDS)), len(spans) - len(base)]
            for column, value in zip(out, [*row, hashlib.sha256(_named(base).encode()).hexdigest(), _named(spans)], strict=True):
                column.append(value)
        types = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): counts of the base kinds, number of confirmed spans, digest, all spans."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scan, SCHEMA)


def redacted(text: str) -> str:
    """Text with every span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, at = [], 0
    for a, kind, b in find_secrets(text):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
            at = b
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """docs with the secrets of `text` replaced; null stays null."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = pa.array([None if t is None else redacted(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.field(at).with_type(pa.string()), texts)

    return docs.mapInArrow(run, docs.schema)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op1_secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1_secrets that SQL can say."""
    return op1_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


_either = lambda word: "".join(f"[{c.upper()}{c}]" for c in word)
_ASSIGN_SQL = "(?:" + "|".join(map(_either, ("password", "passwd", "secret", "token"))) + f"|{_either('api')}_?{_either('key')}" + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
#: The rows of op1_secrets_base in DuckDB's SQL.
BASE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({spans_sql('assign', 0, _ASSIGN_SQL, f"length(regexp_extract(m, '{_ASSIGN_SQL}', 1)) >= 6")}
  UNION ALL {spans_sql('access', 1, 'AKIA[A-Z0-9]+', 'length(m) >= 20')}
  UNION ALL {spans_sql('hex', 2, '[0-9a-f]+', 'length(m) >= 24')}),
per AS (SELECT doc_id, count(*) FILTER (WHERE ord = 0) AS n0, count(*) FILTER (WHERE ord = 1) AS n1, count(*) FILTER (WHERE ord = 2) AS n2,
  string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, ord) AS s FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(s, '')) AS base_sha256 FROM d LEFT JOIN per USING (doc_id)
"""
