"""Secret scanning: an Aho-Corasick keyword prefilter, regular expressions
anchored at its hits, then validation of checksums that secrets embed.

Kinds that need no checksum: ``assign`` (a password-like name with a value),
``access`` (AKIA keys), ``hex`` (long lowercase hexadecimal runs). Kinds that
are reported only if they validate: ``github`` and ``npm`` (CRC-32 of the token
in its last six base-62 digits), ``jwt`` (a decodable header naming its
algorithm), ``pem`` (a private key whose body is one complete DER sequence, the fields of an
OpenSSH key, or whole blocks of the cipher that its header lines name) and
``card`` (a number with a Luhn check digit, only behind a card keyword)."""

from __future__ import annotations

import base64
import binascii
import json
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.common import fresh, map_slices, texts_of

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem", "card")
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: keyword (lower case) -> kind whose expression is tried where it begins
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github",
    "ghr_": "github", "npm_": "npm", "eyj": "jwt", "-----begin ": "pem", "card": "card", "visa": "card",
    "mastercard": "card", "amex": "card",
}

# ASCII letters in either case, spelled out through IGNORECASE on bytes
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_BASE62 = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_JWT = re.compile(rb"(eyJ[A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+)")
_JWT_RUN = re.compile(rb"eyJ[A-Za-z0-9_-]*+")
_PEM_BEGIN = re.compile(rb"-----BEGIN ((?:[A-Z]++ )?PRIVATE KEY)-----\s*+")
_PEM_LINE = re.compile(rb"[A-Za-z][A-Za-z0-9-]*+:[^\n]*+\n")
_PEM_LINES = re.compile(rb"(?:[A-Za-z][A-Za-z0-9-]*+:[^\n]*+\n)*+")
_PEM_BODY = re.compile(rb"[A-Za-z0-9+/=\s]*+")
_DEK = re.compile(rb"^DEK-Info:\s*[A-Z0-9-]+,([0-9A-Fa-f]+)\s*$", re.M)
_OPENSSH = b"openssh-key-v1\0"
_CARD = re.compile(rb"(?:card|visa|mastercard|amex)(?:[ _-]?(?:number|no|nr|num))?[\"']?[:=# ]{1,3}[\"']?((?:\d[ -]?){12,18}\d)(?!\d)", re.I)
_HEX_RUN = re.compile(rb"[0-9a-f]+")
_HEX_SHAPE = bytes(0x68 if c in b"0123456789abcdef" else 0x20 for c in range(256))
_DIGITS62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc62(body: bytes) -> bytes:
    n, out = binascii.crc32(body), b""
    while n:
        n, d = divmod(n, 62)
        out = _DIGITS62[d : d + 1] + out
    return out.rjust(6, b"0")


def _unpadded(part: bytes) -> bytes:
    return base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4))


def _jwt_ok(header: bytes, payload: bytes) -> bool:
    try:
        head = json.loads(_unpadded(header))
        return isinstance(head, dict) and "alg" in head and isinstance(json.loads(_unpadded(payload)), dict)
    except (ValueError, RecursionError):
        return False


def _pem_ok(label: bytes, headers: bytes, body: bytes) -> bool:
    try:
        data = base64.b64decode(b"".join(body.split()), validate=True)
    except ValueError:
        return False
    if label.startswith(b"OPENSSH"):
        return _openssh_ok(data)
    if m := _DEK.search(headers):
        return len(data) > 0 and len(m[1]) in (16, 32) and len(data) % (len(m[1]) // 2) == 0
    return _der_ok(data)


def _openssh_ok(data: bytes) -> bool:
    """The magic, cipher, its key derivation and options, the number of keys, the
    public keys and the private part; behind it at most a cipher's tag."""
    at = len(_OPENSSH)
    if not data.startswith(_OPENSSH):
        return False
    for _ in range(3):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 0 < keys <= len(data):
        return False
    for _ in range(keys + 1):
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        if not size or at > len(data):
            return False
    return len(data) - at in (0, 16)


def _der_ok(der: bytes) -> bool:
    """One DER sequence whose length field covers exactly the rest."""
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return der[1] == len(der) - 2
    k = der[1] & 0x7F
    return 0 < k <= 4 and int.from_bytes(der[2 : 2 + k], "big") == len(der) - 2 - k


def _luhn_ok(digits: bytes) -> bool:
    d = [c - 48 for c in digits if 48 <= c <= 57]
    doubled = [x * 2 - 9 * (x > 4) for x in d[-2::-2]]
    return len(set(d)) > 1 and (sum(d[-1::-2]) + sum(doubled)) % 10 == 0


class _Blocks:
    """Key blocks of a text. Where its header lines and its body end is kept from
    one beginning to the next, as beginnings inside header lines share both: each
    line and each body is read once, however many blocks begin in it."""

    def __init__(self, data: bytes):
        self.data, self.lines, self.body = data, (0, 0), (-1, 0)

    def match(self, at: int) -> tuple[int, int, int, bool] | None:
        m = _PEM_BEGIN.match(self.data, at)
        if not m:
            return None
        head = m.end()
        line = _PEM_LINE.match(self.data, head)
        if not line:
            begin = head
        elif self.lines[0] <= head and line.end() <= self.lines[1]:
            begin = self.lines[1]
        else:
            begin = _PEM_LINES.match(self.data, line.end()).end()
            self.lines = (head, begin)
        if self.body[0] != begin:
            self.body = (begin, _PEM_BODY.match(self.data, begin).end())
        tail, end = b"-----END " + m[1] + b"-----", self.body[1]
        if end == begin or not self.data.startswith(tail, end):
            return None
        stop = end + len(tail)
        return at, stop, stop, _pem_ok(m[1], self.data[head:begin], self.data[begin:end])


def _match(kind: str, data: bytes, at: int, blocks: _Blocks) -> tuple[int, int, int, bool] | None:
    """(start, end, end of what is settled, valid) at a keyword's start."""
    if kind == "assign":
        m = _ASSIGN.match(data, at)
        return m and (m.start(), m.end(), m.end(), len(m[1]) >= MIN_VALUE)
    if kind == "access":
        m = _ACCESS.match(data, at)
        return m and (m.start(), m.end(), m.end(), m.end() - m.start() >= MIN_ACCESS)
    if kind in ("github", "npm"):
        m = _BASE62.match(data, at)
        return m and (m.start(), m.end(), m.end(), _crc62(m[1]) == m[2])
    if kind == "jwt":
        if m := _JWT.match(data, at):
            return m.start(), m.end(), m.end(), _jwt_ok(m[1], m[2])
        # what fails here fails for every other keyword in the same run as well
        run = _JWT_RUN.match(data, at)
        return run and (at, at, run.end(), False)
    if kind == "pem":
        return blocks.match(at)
    m = _CARD.match(data, at)
    return m and (m.start(1), m.end(1), m.end(), _luhn_ok(m[1]))


def keyword_automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def byte_spans(a: ahocorasick.Automaton, data: bytes) -> list[tuple[str, int, int]]:
    """Every secret as (kind, start, end) in bytes, by start, then kind as listed."""
    out: list[tuple[str, int, int]] = []
    reach: dict[str, int] = {}
    blocks = _Blocks(data)
    hits = [(end + 1 - n, kind) for end, (n, kind) in a.iter(data.lower().decode("latin-1"))]
    for at, kind in sorted(set(hits)):
        if at >= reach.get(kind, 0) and (m := _match(kind, data, at, blocks)):
            reach[kind] = m[2]
            if m[3]:
                out.append((kind, m[0], m[1]))
    shape = data.translate(_HEX_SHAPE)
    need = b"h" * MIN_HEX
    at = shape.find(need)
    while at >= 0:
        end = _HEX_RUN.match(data, at).end()
        out.append(("hex", at, end))
        at = shape.find(need, end)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def code_points(data: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The same spans counted in code points."""
    if not spans or data.isascii():
        return spans
    places, seen, at = {}, 0, 0
    for p in sorted({p for _, a, b in spans for p in (a, b)}):
        at += len(data[seen:p].decode("utf-8", "surrogateescape"))
        places[p] = at
        seen = p
    return [(k, places[a], places[b]) for k, a, b in spans]


def secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, spans_col: str = "spans") -> DataFrame:
    """Each row of ``docs`` (columns ``keep``, all by default) with all its
    secrets as spans (kind, start, end in code points, end exclusive) by start,
    then kind. Matches of one kind never overlap; those of different kinds may.
    Null and empty texts have none. A column named ``spans_col`` gives way."""

    def run(part: pa.RecordBatch) -> dict:
        a = keyword_automaton()
        rows = []
        for data in texts_of(part, "__text"):
            spans = code_points(data, byte_spans(a, data))
            rows.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
        return {spans_col: rows}

    return map_slices(docs, text_col, run, f"`{spans_col}` {SPAN}", keep)


def redact(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``; each secret (overlapping ones together)
    is replaced by ``[kind]`` of the first, and ``size_col`` holds the new
    length of changed texts."""

    def run(part: pa.RecordBatch) -> dict:
        a = keyword_automaton()
        rows = []
        for data in texts_of(part, "__text"):
            pieces, done = [], 0
            for kind, s, e in byte_spans(a, data):
                if s >= done:
                    pieces += [data[done:s], f"[{kind}]".encode()]
                done = max(done, e)
            rows.append(b"".join([*pieces, data[done:]]).decode("utf-8", "surrogateescape") if pieces else None)
        return {clean: rows}

    clean = fresh("clean", docs.columns)
    out = map_slices(docs, text_col, run, f"{clean} string")
    changed = F.col(clean).isNotNull()
    new = {text_col: F.coalesce(clean, f"`{text_col}`")}
    if size_col in docs.columns:
        new[size_col] = F.when(changed, F.length(clean).cast(docs.schema[size_col].dataType)).otherwise(F.col(f"`{size_col}`"))
    return out.select(*((new[c] if c in new else F.col(f"`{c}`")).alias(c) for c in docs.columns))


def base_digest(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans (of some kinds), comma-joined (a column)."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
