"""Document FP-tree, pivot distance tables and periodic runs against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventloom.llm import fptree, periodic, simhash
from eventloom.llm.queries import REGISTRY

# --- runs ---------------------------------------------------------------------------


def runs_by_hand(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def a_document(draw):
    size, alphabet = draw.choice([0, 1, 11, 12, 13, 30, 60, 120, 200]), draw.choice([1, 2, 3, 5, 50])
    words = [draw.randrange(alphabet) for _ in range(size)]
    if draw.random() < 0.6:
        words = []
        while len(words) < size:
            block = [draw.randrange(alphabet) for _ in range(draw.randrange(1, 30))]
            words += (block * draw.randrange(1, 9))[: draw.randrange(1, 100)]
            if draw.random() < 0.3:
                words += words[-draw.randrange(1, 60) :]
    return [str(w).encode() for w in words]


def test_runs_against_all_periods():
    draw = random.Random(5)
    fibonacci, longer = [b"a"], [b"a", b"b"]
    while len(longer) < 400:
        fibonacci, longer = longer, longer + fibonacci
    for _ in range(60):
        documents = [a_document(draw) for _ in range(draw.randrange(1, 25))]
        found = periodic.search_documents([*documents, longer])
        assert [list(map(tuple, r.tolist())) for r in found[:-1]] == [runs_by_hand(d) for d in documents]
    assert list(map(tuple, found[-1].tolist())) == runs_by_hand(longer)
    with pytest.raises(ValueError):
        periodic.periodic_runs(None, least=3)


def test_range_successor():
    draw = np.random.default_rng(1)
    values = draw.permutation(300)
    matrix = periodic.WaveletMatrix(values)
    low = draw.integers(0, 300, 500)
    high = np.minimum(300, low + draw.integers(0, 60, 500))
    least = draw.integers(0, 600, 500)
    got = matrix.successor(low, high, least)
    for i in range(500):
        assert got[i] == min((v for v in values[low[i] : high[i]] if v >= least[i]), default=-1)


def test_long_periodic_texts_take_few_steps():
    # one word throughout, and two stretches of one word
    assert periodic.search_documents([[b"a"] * 60_000])[0].tolist() == [[0, 60_000, 1]]
    words = ([b"a"] * 20_000 + [b"b"]) * 2
    assert periodic.search_documents([words])[0].tolist() == [[0, 20_000, 1], [0, 40_002, 20_001], [20_001, 20_000, 1]]


def runs_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_hand(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)]
    return (doc_id, len(runs), *best, best[2] and 1000 * best[1] // best[2], *digests)


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a " * 40), (5, "a b " * 9 + "c"), (5, "a b " * 9 + "c"), (None, "x y z " * 8), (6, "é ö  " * 12), (7, " ".join(f"w{i % 4000}" for i in range(12_000))), (8, "one two"), (-9, "q " * 13)]


@pytest.fixture(scope="module")
def edges(spark):
    frame = spark.createDataFrame(EDGES, "doc_id long, text string")
    for name in ("start", "length", "period", "runs", "print", "key", "n", "terms", "counts", "term", "item", "score", "rank", "component"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def test_runs_query_and_edge_cases(spark, edges, tmp_path):
    draw = random.Random(6)
    rows = [*EDGES, *((i, " ".join(w.decode() for w in a_document(draw))) for i in range(100, 220))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    result = REGISTRY["op13_periodic_runs"](spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted((runs_row(*r) for r in rows), key=repr)
    assert periodic.periodic_runs(edges).count() == len(EDGES)
    assert periodic.periodic_runs(edges.limit(0)).count() == 0


# --- fingerprints -------------------------------------------------------------------


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, ids, radius=4):
    """The smallest id that each row reaches."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius or (ids[i] is not None and ids[i] == ids[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    least = {}
    for i, doc in enumerate(ids):
        least[root(i)] = min((x for x in (least.get(root(i)), doc) if x is not None), default=None)
    return [least[root(i)] for i in range(len(prints))]


def near_copies(draw, n):
    base = [f"b{i}" for i in range(220)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    return texts + [" ".join(f"r{draw.randrange(900)}" for _ in range(draw.randrange(1, 60))) for _ in range(n // 2)]


@pytest.mark.parametrize("most", [None, 3])
def test_fingerprints_against_all_pairs(spark, tmp_path, most):
    rows = [*EDGES, *enumerate(near_copies(random.Random(7), 160), 1000), (1002, "an id with another text"), (1003, "An id WITH another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if most is None:
        docs.write.parquet(str(tmp_path / "documents.parquet"))
        result = REGISTRY["op12_simhash"](spark, str(tmp_path))
    else:
        # all but the smallest keys go through meeting points
        result = simhash.simhash_duplicates(docs, most=most)
    prints = [print_of(t) for _, t in rows]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, linked(prints, [i for i, _ in rows]), strict=True)]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(want, key=repr)
    assert len({c for _, _, c in want}) < len(want) - 20


def test_pivot_filter_loses_no_pair():
    draw = np.random.default_rng(2)
    prints = draw.integers(0, 2**64, 4000, dtype=np.uint64)
    other = prints.copy()
    for row in range(len(other)):
        for bit in draw.choice(64, row % 5, replace=False):
            other[row] ^= np.uint64(1) << np.uint64(bit)
    # a pair within the radius agrees in a key, and in all coordinates to within the radius
    assert (simhash.block_keys(prints) == simhash.block_keys(other)).any(axis=1).all()
    differences = np.abs(simhash.pivot_table(prints) - simhash.pivot_table(other)).sum(axis=2)
    assert (differences.max(axis=1) <= np.bitwise_count(prints ^ other)).all()
    # most pairs of unlike fingerprints are discarded before their bits are compared
    unlike = np.abs(simhash.pivot_table(prints[:-1]) - simhash.pivot_table(prints[1:])).sum(axis=2)
    assert (unlike.max(axis=1) <= 4).mean() < 0.001
    assert len(simhash.meeting_points(prints[:1])[0]) == 2081


def test_fingerprint_edge_cases(edges):
    rows = simhash.simhash_duplicates(edges).collect()
    assert len(rows) == len(EDGES)
    by_id = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] == ("0" * 16, 1)
    assert by_id[None][1] is None
    assert simhash.simhash_duplicates(edges.limit(0)).count() == 0


# --- ranked search ------------------------------------------------------------------


def ranked_by_hand(rows, items, top):
    terms = [fptree.terms_of(t or "") for _, t in rows]
    n, total = sum(map(bool, terms)), sum(map(len, terms))
    counts = [Counter(t) for t in terms]
    df = Counter(t for c in counts for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(fptree.terms_of(text or ""))
    result = []
    for item, wanted in asked.items():
        scored = []
        for (doc, _), held in zip(rows, counts, strict=True):
            if held:
                m = 50 + 50 * sum(held.values()) * n // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * held[t] // (1000 * held[t] + 20 * m)) for t in wanted if held[t])
                if score > 0:
                    scored.append((-score, doc is None, doc or 0))
        result += [(item, rank, None if none else doc, -minus) for rank, (minus, none, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(result, key=repr)


@pytest.mark.parametrize(("tree_terms", "block_terms"), [(fptree.TREE_TERMS, fptree.BLOCK_TERMS), (150, 30)])
def test_ranked_search_against_all_scores(spark, monkeypatch, tree_terms, block_terms):
    draw = random.Random(8)
    zipf = [f"t{i}" for i in range(300) for _ in range(300 // (i + 1))]
    rows = [(i, " ".join(draw.choices(zipf, k=draw.choice([1, 5, 40, 80])))) for i in range(700)]
    # many copies: ties by id
    rows += [(i, "T1 t7, t9é t250") for i in range(900, 1100)] + [*EDGES, (None, "t1 t7")]
    items = [(i, " ".join(draw.choices(zipf, k=draw.choice([1, 3, 12])))) for i in range(25)]
    items += [(30, None), (31, ""), (None, "t1"), (32, "t250 t9é absent"), (2, "t250"), (33, "a A b x y q")]
    # in the session's own process: the limit travels with the function
    monkeypatch.setattr(fptree, "LEAF", 8)
    monkeypatch.setattr(fptree, "TREE_TERMS", tree_terms)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("terms", F.lit("x")).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit("x"))
    got = sorted(map(tuple, fptree.ranked_search(docs, asked, top=20, block_terms=block_terms).collect()), key=repr)
    assert got == ranked_by_hand(rows, items, 20)


def test_tree_in_small_parts():
    """Deep and flat trees, and several trees in a row, find the same."""
    draw = random.Random(9)
    n_terms, n_items = 60, 12
    weights = np.array([draw.randrange(0, 4000) for _ in range(n_terms)], np.int64)
    holds = np.array([[draw.random() < 0.15 for _ in range(n_items)] for _ in range(n_terms)], np.int8)
    rows = []
    for doc in range(1500):
        path = tuple(sorted({min(n_terms - 1, int(draw.expovariate(0.1))) for _ in range(draw.randrange(1, 30))}))
        rows.append((path, tuple(draw.choice([1, 1, 2, 9]) for _ in path), draw.choice([50, 75, 100, 400]), doc))
    asked = fptree.Asked(list(range(n_items)), weights, holds, 1000, 1500)

    def score(row, item):
        return sum(int(weights[t]) * (10**9 * c // (1000 * c + 20 * row[2])) for t, c in zip(row[0], row[1], strict=True) if holds[t, item])

    want = [sorted(((score(r, i), -r[3]) for r in rows if score(r, i) > 0), reverse=True)[:10] for i in range(n_items)]
    for parts in (1, 7):
        best = fptree.Best(n_items, 10, np.zeros(n_items, np.int64))
        for p in range(parts):
            fptree.search_tree(fptree.Tree(rows[p::parts], 10), asked, best)
        assert [sorted(h, reverse=True) for h in best.heaps] == want


def test_bounds_cut_branches_off():
    """Documents of unlike subjects: an item's search scores few leaves."""
    rows = [((0, 1 + subject), (1, 1 + doc % 3), 100, 1000 * subject + doc) for subject in range(40) for doc in range(100)]
    weights = np.array([1, *([5000] * 40)], np.int64)
    holds = np.zeros((41, 1), np.int8)
    holds[[0, 7], 0] = 1
    scored = []
    leaf = fptree._score_leaf
    try:
        fptree._score_leaf = lambda tree, node, *rest: (scored.append(node.high - node.low), leaf(tree, node, *rest))
        best = fptree.Best(1, 10, np.zeros(1, np.int64))
        fptree.search_tree(fptree.Tree(rows, 10), fptree.Asked([0], weights, holds, 1000, 4000), best)
    finally:
        fptree._score_leaf = leaf
    assert [-d for _, d in sorted(best.heaps[0], reverse=True)] == [6002 + 3 * i for i in range(10)]
    assert sum(scored) <= 64


def test_ranked_search_edge_cases(spark, edges):
    items = spark.createDataFrame([(1, "a")], "item_id int, text string")
    found = fptree.ranked_search(edges, items)
    assert dict(found.dtypes) == {"item_id": "int", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert [r.doc_id for r in found.orderBy("rank").collect()] == [4, 5, 5]
    assert fptree.ranked_search(edges.limit(0), items).count() == 0
    assert fptree.ranked_search(edges, items.limit(0)).count() == 0
