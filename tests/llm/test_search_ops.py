"""Ranked search, substring dedup and hard negatives against brute force, and their edge cases."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskwise.llm import hard_negatives, ranked_search, substring_dedup
from riskwise.llm import words as W

from .test_text_ops import EDGE_TEXTS, WORD, docs, edge  # noqa: F401

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranks(rows, items, limit=50):
    bags = [(d, Counter(terms(t))) for d, t in rows]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for d, b in bags:
            m = 50 + 50 * sum(b.values()) * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m))
                    for t in set(terms(text)) if t in b)
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(item, k + 1, d, -s) for k, (s, d) in enumerate(sorted(scored)[:limit])]
    return sorted(out, key=repr)


def ranks(frame):
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, frame.collect()), key=repr)


def test_ranked_search_matches_brute_force(spark, edge, monkeypatch):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in docs(spark).select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(None, rows[0][1])]
    rows += [(20_000 - i, rows[i % 2][1] + (" the" if i % 3 == 0 else "")) for i in range(150)]   # two large groups of copies
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, None), (901, ""), (902, "?!"), (None, "the same text"), (903, "Five-five five,FIVE\x00of"), (903, "x"), (903, "x")]
    d, b = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    expected = brute_ranks(rows, items)
    assert ranks(ranked_search.rank_documents(d, b)) == expected
    monkeypatch.setattr(ranked_search, "ITEM_TERMS", 300)    # several blocks of items
    monkeypatch.setattr(ranked_search, "CELLS", 1000)        # and few scores at a time
    assert ranks(ranked_search.rank_documents(d, b)) == expected


def test_ranked_search_ties_and_copies_beyond_the_limit(spark):
    # equal scores of different classes: members interleave by id; one class has more members than the limit
    rows = [(i, "alpha beta") for i in range(0, 40, 2)] + [(i, "alpha gamma") for i in range(1, 40, 2)] + [(99, "delta")] * 3
    items = [(1, "alpha"), (2, "delta")]
    for limit in (3, 7, 100):
        got = ranks(ranked_search.rank_documents(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS), limit=limit))
        assert got == brute_ranks(rows, items, limit)


def test_ranked_search_edges(spark, edge):  # noqa: F811
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "same text of five words x")], ITEMS)
    assert ranks(ranked_search.rank_documents(none, items)) == []
    assert ranks(ranked_search.rank_documents(edge, spark.createDataFrame([], ITEMS))) == []
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]          # clashing columns `score`, NULL and repeated ids
    assert ranks(ranked_search.rank_documents(edge, items)) == brute_ranks(rows, [(1, "same text of five words x")])


def test_terms_of_windows():
    raw, off = W.text_buffer(pa.array([None, "", "Ab-cd", "x", "y_Ü€ 1a", "\x00\x7f"]))
    found, first = ranked_search.terms_of(raw, off)
    assert found.to_pylist() == ["ab", "cd", "x", "y", "Ü€", "1a"] and first.tolist() == [0, 0, 0, 2, 3, 6, 6]


def brute_repeats(rows, n):
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = [True] * n
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


def kept(frame):
    assert frame.columns == ["id", "n_words", "n_removed", "kept"]
    return Counter(map(tuple, frame.collect()))


@pytest.mark.parametrize("small", [False, True])
def test_substring_dedup_matches_brute_force(spark, monkeypatch, small):
    if small:   # many chunks and buckets, chunks of one row, chunks dealt over several batches
        monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 3000)
        monkeypatch.setattr(substring_dedup, "ANCHOR_BUCKET", 20_000)
        monkeypatch.setattr(substring_dedup, "WINDOW_BUCKET", 5_000)
    rows = [(r["doc_id"], r["text"]) for r in docs(spark).select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(None, rows[0][1]), (3, rows[5][1])]
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(50)]
    for k in range(60):          # a passage of 30 to 50 words in own surroundings, some of them at a row's ends
        own = [f"o{k}_{i}" for i in range(int(rng.integers(0, 40)))]
        a, b = int(rng.integers(0, 11)), 50 - int(rng.integers(0, 11))
        cut = int(rng.integers(0, len(own) + 1))
        rows.append((30_000 + k, " ".join(own[:cut] + passage[a:b] + own[cut:])))
    rows += [(40_000, "a " * 34), (40_001, "a " * 35), (40_002, "b " * 36), (40_003, "c d " * 18), (40_004, "A " * 35)]
    got = kept(substring_dedup.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(5)))
    assert got == brute_repeats(rows, 35)


def test_substring_dedup_other_lengths_and_edges(spark, edge):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    rng = np.random.default_rng(4)
    rows += [(100 + k, " ".join(rng.choice(["u", "v", "w"], 60))) for k in range(20)]
    d = spark.createDataFrame(rows, DOCS)
    for window, seed in ((5, 3), (7, 7), (4, 1), (35, 16)):
        assert kept(substring_dedup.remove_repeats(d, window=window, seed=seed)) == brute_repeats(rows, window)
    assert kept(substring_dedup.remove_repeats(edge)) == brute_repeats([(r["doc_id"], r["text"]) for r in edge.collect()], 35)
    assert substring_dedup.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError, match="anchor"):
        substring_dedup.remove_repeats(d, window=5, seed=6)


def test_winnowed_anchors_cover_equal_windows():
    # wherever two windows are equal, their anchor is equal and counted as met twice
    words = np.random.default_rng(1).integers(0, 3, 400)
    raw, off = W.text_buffer(pa.array([" ".join(map(str, words[:250])), " ".join(map(str, words[250:]))]))
    seeds = substring_dedup.Seeds(raw, off, 6, 3)
    value, more = seeds.anchors()
    many = set(value[more].tolist())
    hashes = substring_dedup.run_hashes(seeds.words, 6, seeds.known)
    for h, n in Counter(hashes[seeds.own > 0].tolist()).items():
        if n > 1:
            own = set(seeds.own[(hashes == h) & (seeds.own > 0)].tolist())
            assert len(own) == 1 and own <= many


def brute_negatives(rows, every=100, n=5):
    clean = {}
    for i, v, x in rows:
        if None not in (i, v, x) and all(c is not None and math.isfinite(c) for c in v):
            clean[i] = (x, [math.floor(256 * float(c)) for c in v])
    out = []
    for a in sorted(i for i in clean if i % every == 0):
        label, u = clean[a]
        score = {i: sum(p * q for p, q in zip(u, w)) for i, (_, w) in clean.items()}
        best = lambda ids: sorted(ids, key=lambda i: (-score[i], i))[:n]
        for p in best([i for i in clean if i != a and clean[i][0] == label]):
            found = [i for i in clean if clean[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(best(found))]
    return sorted(out)


VECS = "vec_id long, embedding array<float>, label int"


def mined(frame):
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_match_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("ANCHOR_BLOCK", 2), ("ROW_BLOCK", 60), ("TABLE_BYTES", 1), ("SCORES", 1)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same = rows[7][1]
    rows += [(1000 + i, same, i % 3) for i in range(40)]                 # a group of copies: ties by id
    rows += [(2000, [0.0] * 64, 1), (2001, [0.0] * 64, 1), (2002, [], 2), (2100, [-0.5] * 64, 4), (2003, [9.5] * 3, 4),
             (2200, None, 1), (2300, [1.0], None), (None, [1.0], 1), (2400, [float("nan")] * 64, 1), (2004, [None, 1.0], 1),
             (2005, [float("inf")], 1), (-100, same, -1), (2006, [0.25] * 70, 2)]
    d = spark.createDataFrame(rows, VECS)
    padded = [(i, v and list(v) + [0.0] * (70 - len(v)) if v is not None else None, x) for i, v, x in rows]
    assert mined(hard_negatives.mine_hard_negatives(d)) == brute_negatives(padded)


def test_hard_negatives_edges(spark):
    none = spark.createDataFrame([], VECS)
    assert mined(hard_negatives.mine_hard_negatives(none)) == []
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.9, 0.25], 2), (2, [0.9, 0.25], 2), (3, [1.0, 0.5], 2), (3, [9.0, 9.0], 3)]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], VECS + ", planes string, block int")    # clashing names, repeated ids
    assert mined(hard_negatives.mine_hard_negatives(d)) == brute_negatives([rows[0], rows[1], rows[2], rows[4]])
    assert mined(hard_negatives.mine_hard_negatives(d.where("vec_id > 0"))) == []
    with pytest.raises(ValueError, match="64-bit"):
        hard_negatives.mine_hard_negatives(spark.createDataFrame([(0, [1e30], 1)], VECS))


def test_lookups_equal_the_inner_product():
    rng = np.random.default_rng(2)
    x, y = rng.integers(-300, 300, (50, 16)), rng.integers(-300, 300, (9, 16))
    bits = 10
    planes = np.stack([np.packbits(((x >> k) & 1).astype(np.uint8), axis=1, bitorder="little") for k in range(bits)], axis=1)
    assert (hard_negatives._vectors(planes) == x).all()
    assert (hard_negatives.scores(hard_negatives.subset_sums(y), planes) == x @ y.T).all()
