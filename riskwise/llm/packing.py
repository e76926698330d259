"""Packing by Karmarkar-Karp multiway differencing.

Every task tokenizes its documents and packs them in pools of bounded size, so there is
no shuffle and no group that grows with the table.  Documents longer than a window are
cut; their full windows stand alone and the rest goes to the pool.  A pool is split
into near-equal windows by differencing: the two partial partitions of largest spread are
merged with opposing order until one is left.  If a window exceeds the capacity, the
window count rises by one and the pool is split again; if that took over a fiftieth more
windows, longer pieces are halved first.

A sequence whose length is a power of two needs no padding.  So the tokens of a pool of more than one window
that would leave its last window part empty are first cut off as a few sequences of such lengths.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import caches
from . import words as W

WINDOW = 4096
POOL_TOKENS = 1 << 19     # tokens packed together in one task
UNIT = 64                 # shorter pieces are joined to runs of about this many tokens
MEMO = 200_000            # distinct parts of texts, about 40 MB, that a worker remembers
GROUP_BYTES = 2 << 20     # texts encoded together
SIGNS = b".,;:!?%*#$&|<>()[]{}+-=/_~^@\"`"

#: Kind of a byte: 0 white space, 1 ASCII letter, 2 closing sign, 3 any other.
KIND = np.full(256, 3, dtype=np.uint8)
KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KIND[list(SIGNS)] = 2

#: The character that stands for a byte in the vocabulary: itself if it prints, else the next one from 256 on.
_PRINTS = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTS)}

_encoders: dict[str, "WordEncoder"] = {}
caches.remember("packing", _encoders.clear)


class WordEncoder:
    """Token ids of whole texts.

    The vocabulary's splitter never joins characters across white space, nor letters with the
    closing signs that follow them, and lower-cases.  So a text's ids are the concatenation of those of its
    parts: the letters and the signs of a word that is letters and closing signs, and any other word as it is.
    The distinct parts of a group of texts are encoded once, by the vocabulary's model if they are
    letters, and every text's ids are gathered from theirs.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}

    def _ids(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _run(self, letters: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _runs(self, runs: list[bytes]) -> dict[bytes, bytes]:
        """Ids of runs of letters, some not ASCII: normalised in one call, their bytes written as the vocabulary does.

        A run stays whole only if it still is letters then, all of scripts whose letters every splitter knows.
        """
        plain = self.tokenizer.normalizer.normalize_str(b" ".join(runs).decode("utf-8", "replace")).split(" ")
        if len(plain) != len(runs):
            return {r: self._ids(r) for r in runs}
        return {r: self._run(s.encode().decode("latin-1").translate(BYTE_CHARS)) if s.isalpha() and max(s) < "\u2000"
                else self._ids(r) for r, s in zip(runs, plain)}

    def encoded(self, parts: list[bytes]) -> list[bytes]:
        """Ids of distinct parts.  What is met first is remembered, which is what is frequent."""
        known, out, later = self.known, {}, []
        for w in [w for w in parts if w not in known]:
            if w.isalpha():                             # ASCII letters only
                out[w] = self._run(w.decode("ascii"))
                continue
            run = w.rstrip(SIGNS)
            if not w.isascii() and run.decode("utf-8", "replace").isalpha():
                later.append((w, run, w[len(run):]))
            else:
                out[w] = self._ids(w)
        if later:
            runs = self._runs(list({r for _, r, _ in later}))
            tails = {t: self._ids(t) for t in {t for _, _, t in later}}
            out.update((w, runs[r] + tails[t]) for w, r, t in later)
        found = [known[w] if w in known else out[w] for w in parts]
        room = MEMO - len(known)
        if room > 0:
            known.update(itertools.islice(out.items(), room))
        return found

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and where each row's begin (length rows + 1)."""
        text, first = _parts(raw, offsets)
        coded = text.dictionary_encode()
        code, parts = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        held = parts.buffers()[2].to_pybytes() if len(parts) else b""
        cuts = np.frombuffer(parts.buffers()[1], np.int64, len(parts) + 1).tolist() if len(parts) else [0]
        collecting = gc.isenabled()
        gc.disable()                    # many small objects, none of them in cycles
        try:
            found = self.encoded([held[x:y] for x, y in zip(cuts, cuts[1:])])
        finally:
            if collecting:
                gc.enable()
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        lengths = size[code]
        ends = np.r_[0, np.cumsum(lengths)]
        return flat[np.repeat(begin[code] - ends[:-1], lengths) + np.arange(ends[-1])], ends[first]


def _parts(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The parts of all rows, ASCII letters in lower case, and the index of every row's first part (length rows + 1)."""
    kind = KIND[raw]
    inside = kind > 0
    row = np.zeros(len(raw) + 1, dtype=bool)
    row[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | row[1:-1]                  # first byte of a word
    at = np.flatnonzero(start)
    if len(at):
        # words of letters, then closing signs: the kinds do not fall, and none is beyond
        fall = np.zeros(len(raw), dtype=bool)
        fall[1:] = (kind[1:] < kind[:-1]) & ~start[1:] & inside[1:]
        odd = np.add.reduceat((fall | (kind > 2)).view(np.uint8), at, dtype=np.int32) > 0
        tail = np.zeros(len(raw), dtype=bool)
        tail[1:] = (kind[1:] == 2) & (kind[:-1] == 1) & ~start[1:]
        cut = np.flatnonzero(tail)
        start[cut[~odd[np.searchsorted(at, cut, side="right") - 1]]] = True
        at = np.flatnonzero(start)
    text = W.LOWER[raw[inside]]
    size = np.add.reduceat(inside.view(np.uint8), at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
    bounds = np.r_[0, np.cumsum(size)]
    return (pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(text)]),
            np.searchsorted(at, offsets))


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def differencing(sizes: list[int], k: int) -> np.ndarray:
    """Window (0..k-1) of every item, by Karmarkar-Karp differencing over k ways.

    Equal spreads are taken in item order, so the result depends on the input only.
    """
    n = len(sizes)
    if n == 0 or k <= 1:
        return np.zeros(n, dtype=np.int64)
    sums: list = []
    for s in sizes:
        row = np.zeros(k, dtype=np.int64)
        row[0] = s
        sums.append(row)
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    children: list = [None] * n
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = sums[a] + sums[b][::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        total -= total[-1]
        sums[a] = sums[b] = None
        sums.append(total)
        children.append((a, b, order))
        heapq.heappush(heap, (-int(total[0]), len(sums) - 1))
    window = np.zeros(n, dtype=np.int64)
    stack = [(heap[0][1], np.arange(k))]
    while stack:
        node, place = stack.pop()
        if children[node] is None:
            window[node] = place[0]
            continue
        a, b, order = children[node]
        left, right = np.empty(k, dtype=np.int64), np.empty(k, dtype=np.int64)
        left[order] = place
        right[k - 1 - order] = place
        stack += [(a, left), (b, right)]
    return window


class Piece:
    """A run of a document's ids: ``ids`` holds them as bytes."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: bytes, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        return (Piece(self.doc, self.start, self.ids[:4 * n], self.total),
                Piece(self.doc, self.start + n, self.ids[4 * n:], self.total))


def _carved(pieces: list[Piece], lengths: list[int]) -> list[list[Piece]]:
    """Sequences of exactly the given lengths, taken from the end of ``pieces``."""
    out = []
    for want in lengths:
        row = []
        while want:
            p = pieces.pop()
            if len(p) > want:
                p, rest = p.cut(want)
                pieces.append(rest)
            row.append(p)
            want -= len(p)
        out.append(row)
    return out


def _units(pieces: list[Piece], limit: int) -> list[list[Piece]]:
    """What is placed as one: runs of short pieces, and longer ones cut to ``limit``."""
    units: list[list[Piece]] = []
    size = UNIT
    for p in pieces:
        while len(p) > limit:
            head, p = p.cut(limit)
            units.append([head])
            size = UNIT
        if size < UNIT and size + len(p) <= limit:
            units[-1].append(p)
            size += len(p)
        else:
            units.append([p])
            size = len(p)
    return units


def _rejoined(row: list[Piece]) -> list[Piece]:
    """The sequence, parts of one document that meet again made one piece."""
    out: list[Piece] = []
    for p in row:
        last = out[-1] if out else None
        if last is not None and last.doc == p.doc and last.total == p.total and last.start + len(last) == p.start:
            out[-1] = Piece(p.doc, last.start, last.ids + p.ids, p.total)
        else:
            out.append(p)
    return out


def pack_pool(pieces: list[Piece], window: int = WINDOW) -> list[list[Piece]]:
    """Sequences of at most ``window`` ids holding every id of the pieces once."""
    pieces = list(pieces)
    total = sum(map(len, pieces))
    if total <= window:                 # differencing one way: no document is cut for the sake of padding
        return [_rejoined(pieces)] if total else []
    k = total // window
    # what is beyond k full windows, and room for uneven windows, as powers of two
    spare = min(total, -(-(total - k * window + 8 * k) // UNIT) * UNIT)
    out = _carved(pieces, [1 << i for i in range(spare.bit_length()) if spare >> i & 1 and 1 << i <= window]) \
        if spare <= window else []
    total = sum(map(len, pieces))
    least = -(-total // window)
    limit = window
    while pieces:
        units = _units(pieces, limit)
        sizes = [sum(map(len, u)) for u in units]
        k = least
        # a few more windows than the least, else finer cuts; at the finest, as many as it takes
        while k <= least + max(1, least // 50) or limit <= 2 * UNIT:
            place = differencing(sizes, k)
            if np.bincount(place, weights=sizes, minlength=k).max() <= window:
                rows: list[list[Piece]] = [[] for _ in range(k)]
                for u, w in zip(units, place.tolist()):
                    rows[w] += u
                return out + [_rejoined(r) for r in rows if r]
            k += 1
        limit //= 2
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = 2, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """Pieces of packed sequences: (``id_col``, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are little-endian unsigned 32-bit token ids.  NULL or empty text is one piece
    holding ``end_id`` alone.  NULL or repeated ids are separate documents like any other; other
    columns are ignored; an empty table gives no sequences.  Texts of any length are
    encoded whole.  Sequence ids are unique; they depend on how the table is split into tasks.
    """
    end = int(end_id).to_bytes(4, "little")

    @caches.task("packing")
    def run(batches):
        encode = encoder(tokenizer_path).encode
        base = TaskContext.get().partitionId() << 32
        made = 0

        def flush(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal made
            cols: tuple[list, ...] = ([], [], [], [], [], [], [])
            for row in sequences:
                offset = 0
                for p in row:
                    for c, v in zip(cols, (p.doc, p.start, len(p), p.ids, p.total, base + made, offset)):
                        c.append(v)
                    offset += len(p)
                made += 1
            types = (kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        def rows(ids: np.ndarray, first: np.ndarray) -> Iterator[bytes]:
            first = first.tolist()
            return (ids[x:y].tobytes() + end for x, y in zip(first, first[1:]))

        pool: list[Piece] = []
        held = 0
        for batch in batches:
            kind = batch.schema.field("id").type
            raw, offsets = W.text_buffer(batch.column("text"))
            encoded = (ids for i, j in W.row_chunks(offsets, GROUP_BYTES)
                       for ids in rows(*encode(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])))
            for doc, ids in zip(batch.column("id").to_pylist(), encoded):
                n, full = len(ids) // 4, []
                for start in range(0, n, window):
                    piece = Piece(doc, start, ids[4 * start:4 * (start + window)], n)
                    if len(piece) == window:
                        full.append([piece])
                        if len(full) * window >= pool_tokens:
                            yield flush(full)
                            full = []
                    else:
                        pool.append(piece)
                        held += len(piece)
                if full:
                    yield flush(full)
                if held >= pool_tokens:
                    yield flush(pack_pool(pool, window))
                    pool, held = [], 0
        if pool:
            yield flush(pack_pool(pool, window))

    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = (f"id {base.schema['id'].dataType.simpleString()}, start long, length long, ids binary, "
              "doc_tokens long, sequence_id long, offset long")
    return base.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per sequence: its ids in order and the documents in it."""
    part: Iterator = ("offset", "ids", id_col)
    return (pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct(*part))).alias("p"))
            .select("sequence_id", F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "").alias("hex"),
                    F.transform("p", lambda x: x[id_col]).alias("docs"))
            .select("sequence_id", F.unhex("hex").alias("ids"), "docs"))
