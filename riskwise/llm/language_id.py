"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1/-1.  A letter trigram is the product of its
letters' vectors, rotated by their place (permutation keeps the order, the product binds).
A text is the sum (bundle) of its trigrams' vectors; a language's prototype is the
sum of its learning texts' length-normalised vectors.  A text gets the language of largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from . import caches

DIM = 1024
SEED = 20_000
CHUNK = 64                # texts whose trigram counts are multiplied at once
CHUNK_CHARS = 400_000
TABLE = 1 << 15           # trigram vectors that a worker keeps
BLOCK = 1 << 13           # distinct trigrams whose counts and vectors are multiplied at once, at most TABLE
SCALE = 1 << 20           # sums are taken over integers: the same for any task order
MAX_LANGUAGES = 10_000    # prototypes are shipped to the tasks, 4 KB each

_letters: dict[tuple[int, int], np.ndarray] = {}
_is_letter: list[np.ndarray] = []
_vectors: dict[int, "Vectors"] = {}
caches.remember("language_id", lambda: (_letters.clear(), _vectors.clear(), _is_letter.clear()))


def letter_vector(cp: int, dim: int = DIM) -> np.ndarray:
    key = (cp, dim)
    if key not in _letters:
        if len(_letters) > TABLE:
            _letters.clear()
        bits = np.random.Generator(np.random.Philox(key=[SEED, cp])).integers(0, 2, dim, dtype=np.int8)
        _letters[key] = bits * np.int8(2) - np.int8(1)
    return _letters[key]


def trigram_vector(code: int, dim: int = DIM) -> np.ndarray:
    a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
    return np.roll(letter_vector(a, dim), 2) * np.roll(letter_vector(b, dim), 1) * letter_vector(c, dim)


class Vectors:
    """Vectors of trigram codes seen by this worker, in one growing matrix of at most ``TABLE`` rows."""

    def __init__(self, dim: int):
        self.dim, self.rows, self.at = dim, np.empty((0, dim), np.int8), {}

    def take(self, codes: list[int]) -> np.ndarray:
        missing = [c for c in codes if c not in self.at]
        if len(self.at) + len(missing) > TABLE:
            self.at, missing = {}, codes
        need = len(self.at) + len(missing)
        if need > len(self.rows):
            grown = np.empty((min(max(need, 2 * len(self.rows)), TABLE), self.dim), np.int8)
            grown[:len(self.rows)] = self.rows
            self.rows = grown
        for c in missing:
            self.at[c] = len(self.at)
            self.rows[self.at[c]] = trigram_vector(c, self.dim)
        return self.rows[[self.at[c] for c in codes]].astype(np.float32)


def vectors(dim: int) -> Vectors:
    return _vectors.setdefault(dim, Vectors(dim))


def letters_of(text: str) -> np.ndarray:
    """Lower-case letters with one space at both ends and for every run of anything else."""
    if not _is_letter:
        _is_letter.append(np.array([chr(c).isalpha() for c in range(0x10000)]))
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    alpha = _is_letter[0][np.minimum(cp, 0xFFFF)]
    high = np.flatnonzero(cp > 0xFFFF)
    if len(high):
        alpha[high] = [chr(c).isalpha() for c in cp[high].tolist()]
    if not alpha.any():
        return np.zeros(0, dtype=np.uint32)
    s = np.zeros(len(cp) + 2, dtype=np.uint32)
    s[1:-1] = np.where(alpha, cp, 0)
    s[s == 0] = 32
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = (s[1:] != 32) | (s[:-1] != 32)
    return s[keep]


def trigram_places(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the distinct trigrams; text and index of its code of every trigram."""
    rows = [letters_of(t) for t in texts]
    lengths = np.array([max(0, len(r) - 2) for r in rows])
    if not lengths.sum():
        return (np.zeros(0, np.int64),) * 3
    joined = np.concatenate(rows)
    alphabet = np.flatnonzero(np.bincount(joined)) if joined.max() < 1 << 16 else np.unique(joined)
    k = len(alphabet)
    small = np.searchsorted(alphabet, joined).astype(np.int64)
    start = np.cumsum([0] + [len(r) for r in rows])
    inner = np.ones(len(joined), dtype=bool)
    for e, r in zip(start[1:], rows):
        if len(r):
            inner[e - 2:e] = False
    code = (small[:-2] * k + small[1:-1]) * k + small[2:]
    code = code[inner[:-2]]
    doc = np.repeat(np.arange(len(texts)), lengths)
    if k <= 128:
        used = np.flatnonzero(np.bincount(code, minlength=k ** 3))
        place = np.zeros(k ** 3, dtype=np.int32)
        place[used] = np.arange(len(used))
        at = place[code]
    else:
        used, at = np.unique(code, return_inverse=True)
    abc = alphabet[used // k ** 2], alphabet[used // k % k], alphabet[used % k]
    a, b, c = (x.astype(np.int64) for x in abc)
    return a << 42 | b << 21 | c, doc, at


def trigram_counts(texts: list[str]) -> tuple[list[int], np.ndarray]:
    """Codes of the distinct trigrams, and a (texts x codes) matrix of counts."""
    codes, doc, at = trigram_places(texts)
    counts = np.bincount(doc * len(codes) + at, minlength=len(texts) * len(codes)).reshape(len(texts), len(codes))
    return codes.tolist(), counts.astype(np.float32)


def trigram_sums(texts: list[str], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the vectors of every text's trigrams, as whole numbers, and trigrams per text.

    Only ``BLOCK`` vectors are held at once, however many distinct trigrams there are.
    """
    codes, doc, at = trigram_places(texts)
    n = np.bincount(doc, minlength=len(texts))
    kind = np.float32 if n.max(initial=0) < 1 << 24 else np.float64   # exact up to there
    out = np.zeros((len(texts), dim), kind)
    if len(codes) > BLOCK:
        order = np.argsort(at, kind="stable")
        doc, at = doc[order], at[order]
    for a in range(0, len(codes), BLOCK):
        some = codes[a:a + BLOCK].tolist()
        i, j = (0, len(at)) if len(codes) <= BLOCK else np.searchsorted(at, [a, a + BLOCK])
        counts = np.bincount(doc[i:j] * len(some) + at[i:j] - a, minlength=len(texts) * len(some))
        out += counts.reshape(len(texts), len(some)).astype(kind) @ vectors(dim).take(some)
    return out, n


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and j - i < CHUNK and (j == i or chars < CHUNK_CHARS):
            chars += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def _bundles(dim: int):
    """Partial prototype sums of one task, one row per language and dimension."""
    @caches.task("language_id")
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for i, j in chunks(texts):
                sums, n = trigram_sums([t or "" for t in texts[i:j]], dim)
                if n.any():
                    found = np.rint(sums / np.maximum(n, 1)[:, None] * SCALE).astype(np.int64)
                    for lang, row in zip(langs[i:j], found):
                        total[lang] = total.get(lang, 0) + row
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x in total for _ in range(dim)], pa.string()),
                 pa.array(np.tile(np.arange(dim, dtype=np.int32), len(total))),
                 pa.array(np.concatenate(list(total.values())))], ["lang", "i", "v"])
    return run


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their unit-length prototypes, from all rows with both columns.

    More than ``MAX_LANGUAGES`` values of ``lang`` are an error: the prototypes are shipped to every task.
    """
    base = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    sums = base.mapInArrow(_bundles(dim), "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    found: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():
        found.setdefault(row["lang"], np.zeros(dim))[row["i"]] = row["v"]
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages; prototypes are shipped to every task")
    names = sorted(found)
    matrix = np.array([found[n] for n in names]).reshape(len(names), dim)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return names, (matrix / np.where(norm == 0, 1, norm)).astype(np.float32)


def predict_texts(texts: list[str | None], names: list[str], prototypes: np.ndarray) -> tuple[list[str], list[float]]:
    lang, score = ["und"] * len(texts), [0.0] * len(texts)
    if not names:
        return lang, score
    for i, j in chunks(texts):
        bundle, n = trigram_sums([t or "" for t in texts[i:j]], prototypes.shape[1])
        if not n.any():
            continue
        norm = np.linalg.norm(bundle, axis=1)
        cosine = (bundle @ prototypes.T) / np.where(norm == 0, 1, norm)[:, None]
        best = cosine.argmax(axis=1)
        for d in np.flatnonzero(n).tolist():
            lang[i + d] = names[best[d]]
            score[i + d] = float(min(1.0, max(0.0, cosine[d, best[d]])))
    return lang, score


def identify(docs: DataFrame, names: list[str], prototypes: np.ndarray, text_col: str = "text") -> DataFrame:
    """All rows and columns, with ``lang_pred`` and ``score`` (the cosine, cut to 0..1).

    NULL texts and texts without letters: ``und``, 0.  With no learned language every row
    is ``und``.  Equal cosines go to the first language in name order.  Columns
    named like the two new ones are replaced.
    """
    rest = docs.drop("lang_pred", "score")
    at = rest.columns.index(text_col)

    @caches.task("language_id")
    def run(batches):
        for batch in batches:
            lang, score = predict_texts(batch.column(at).to_pylist(), names, prototypes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return rest.mapInArrow(run, StructType([*rest.schema.fields, *added]))


def held_out(id_col: Column) -> Column:
    """Rows never learned from; a NULL id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """(``id_col``, held_out, lang_pred, score) of every row; see ``identify``."""
    names, prototypes = learn_profiles(docs.where(~held_out(F.col(id_col))), text_col, lang_col)
    base = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return (identify(base, names, prototypes, "text")
            .select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score"))


def with_known_language(docs: DataFrame, names: list[str], prototypes: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose text has letters.

    Those are the rows that ``identify`` would not call ``und``; where no language was learned they stay too.  NULL and
    empty texts go; repeated rows and NULL ids are rows like others; an empty table stays empty.
    """
    at = docs.columns.index(text_col)

    @caches.task("language_id")
    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            if names:
                keep = [x != "und" for x in predict_texts(texts, names, prototypes)[0]]
            else:
                keep = [len(letters_of(t or "")) > 0 for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
