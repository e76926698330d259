"""Secret scans: Aho-Corasick prefilter, anchored expressions near hits, checksums.

One automaton finds the keywords of all kinds in the lower-cased text; a kind's
expression is tried only where one of its keywords starts.  Kinds whose tokens embed a
checksum are reported only if it is right.  ``hex`` has no keyword, so its runs
are found by their character class.

Fixed values: the expressions of the three base kinds, the checksum rules of the others.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import caches

BASE = ("assign", "access", "hex")
EMBEDDED = ("github", "npm", "xprv")
KINDS = BASE + EMBEDDED

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

SPANS = "array<struct<kind:string,start:long,end:long>>"


def crc_base62(body: str) -> str:
    """CRC-32 of the token body as six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits


def _crc_ok(m: re.Match) -> bool:
    return crc_base62(m[1]) == m[2]


def _base58_ok(m: re.Match) -> bool:
    """Base58Check: the last four bytes repeat the double SHA-256 of the rest."""
    value = 0
    for c in m[0]:
        value = value * 58 + BASE58.index(c)
    raw = value.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


#: kind, keywords (lower case), anchored expression, test of a match
RULES = (
    ("assign", ("password", "passwd", "secret", "token", "api_key", "apikey"), ASSIGN, lambda m: len(m[2]) >= 6),
    ("access", ("akia",), ACCESS, lambda m: len(m[0]) >= 20),
    ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), GITHUB, _crc_ok),
    ("npm", ("npm_",), NPM, _crc_ok),
    ("xprv", ("xprv",), XPRV, _base58_ok),
)
_ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
_automaton: list = []


def automaton():
    """One automaton per worker process, built on first use."""
    if not _automaton:
        a = ahocorasick.Automaton()
        for rule, (_, keywords, _, _) in enumerate(RULES):
            for word in keywords:
                a.add_word(word, (len(word), rule))
        a.make_automaton()
        _automaton.append(a)
    return _automaton[0]


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind.

    Leftmost and non-overlapping within a kind; different kinds may overlap.
    """
    low = text.lower()
    if len(low) != len(text):  # a character whose lower case is longer would shift positions
        low = text.translate(_ASCII_LOWER)
    hits = [(end - size + 1, rule) for end, (size, rule) in automaton().iter(low)]
    found, taken = [], {}
    for start, rule in sorted(hits):
        if start < taken.get(rule, 0):
            continue
        kind, _, expression, valid = RULES[rule]
        if m := expression.match(text, start):
            taken[rule] = m.end()
            if valid(m):
                found.append((kind, start, m.end()))
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def merged(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Overlapping spans joined into one, under the kind of the first."""
    out: list[tuple[str, int, int]] = []
    for kind, start, end in spans:
        if out and start < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(end, out[-1][2]))
        else:
            out.append((kind, start, end))
    return out


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    parts, at = [], 0
    for kind, start, end in merged(spans):
        parts += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*parts, text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ``spans``) of every row, ``spans`` an array of (kind, start, end).

    NULL or empty text: no spans.  NULL or repeated ids are passed through, one row per
    input row; other columns are ignored; an empty table gives an empty result.  A text is
    scanned whole, whatever its length.
    """
    @caches.task("secret_scan")
    def run(batches):
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t)] if t else []
                     for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, kind)], ["id", "spans"])

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, spans {SPANS}")
            .withColumnRenamed("id", id_col))


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with every span replaced by ``[kind]``.

    ``length_col``, if the table has it, is set to the new length of changed texts.
    NULL texts stay NULL; rows without secrets are unchanged.  Repeated rows and NULL ids are rows like others,
    texts of any length are scanned whole, an empty table stays empty.
    """
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    @caches.task("secret_scan")
    def run(batches):
        for batch in batches:
            before = batch.column(at).to_pylist()
            after = [redacted(t, s) if t and (s := find_secrets(t)) else t for t in before]
            columns = list(batch.columns)
            columns[at] = pa.array(after, batch.schema.field(at).type)
            if length is not None:
                sizes = [len(b) if a != b else n for a, b, n in zip(before, after, columns[length].to_pylist())]
                columns[length] = pa.array(sizes, batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
