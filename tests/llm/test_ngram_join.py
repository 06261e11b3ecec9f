import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankforge.llm import ngram_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def brute(rows, n, t):
    sets = [grams(x, n) for _, x in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in by[g] if j > i}:
            k = len(s & sets[j])
            if 100 * k >= t * (len(s) + len(sets[j]) - k):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(spark, rows, n, t, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in J.ngram_components(df, n, t, **kw).collect()), key=str)


def planted():
    rng = np.random.default_rng(5)
    rows, words = [], [f"w{i}" for i in range(300)]
    for base in range(12):
        size = int(rng.integers(1, 400))
        text = list(rng.choice(words, size))
        for _ in range(int(rng.integers(1, 30))):
            copy = list(text)
            for _ in range(int(rng.integers(0, 1 + size // 25))):
                copy[int(rng.integers(0, size))] = str(rng.choice(words))
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    return rows


@pytest.mark.parametrize("n,t,tokens", [(3, 90, 400_000), (2, 70, 900)])
def test_components_as_brute_force(spark, n, t, tokens):
    rows = planted()
    assert got(spark, rows, n, t, block_tokens=tokens) == brute(rows, n, t)


@pytest.mark.parametrize("n,t", [(3, 90), (5, 80)])
def test_the_trie_finds_the_links(spark, n, t):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = J.document_sets(df, n, t, with_sets=False).groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sigs").alias("sigs")) \
        .withColumn("id", F.col("rep"))
    stars = J.block_stars(classes)
    members = J.members(df, classes, stars, n, t, 400_000)
    assert members.filter("large").count() == 0 and J.large_links(members, stars, t, 400_000).count() == 0
    found = [tuple(r) for r in J.tree_links(members, t).collect()]
    assert len(found) > 20
    # with the equal sets, the trie's links give the components of brute force
    sets, root, parent = {d: grams(x, n) for d, x in rows}, {d: c for d, _, c in brute(rows, n, t)}, {}

    def find(d):
        while d in parent:
            d = parent[d]
        return d
    by_set = {}
    for d in sorted(sets):
        if by_set.setdefault(sets[d], d) != d:
            parent[d] = by_set[sets[d]]
    for a, b in found:
        k = len(sets[a] & sets[b])
        assert 100 * k >= t * (len(sets[a]) + len(sets[b]) - k)
        a, b = sorted((find(a), find(b)))
        assert a != b  # no link is found twice
        parent[b] = a
    assert {d: find(d) for d in sets} == root


def test_many_equal_rows(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join(["new", *words[1:]])
    rows = [(5, " ".join(words))] * 20_000 + [(i, " ".join(words)) for i in range(10_000, 13_000)] + [(3, near), (None, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = J.ngram_components(df, 3, 90).groupBy("component_id", "n_shingles").count().collect()
    assert [tuple(r) for r in out] == [(3, 58, len(rows))]


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (7, "A\x0bB"), (7, "A\x0bB"),
            (8, "É b c"), (9, "é b c"), (None, "a b"), (10, "x " * 30_000), (11, "x x")]
    assert got(spark, rows, 3, 90) == brute(rows, 3, 90)
    assert got(spark, [], 3, 90) == []


def test_real_documents(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert got(spark, rows, 3, 90) == brute(rows, 3, 90)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 30), min_size=1, max_size=25), min_size=1, max_size=20, unique=True),
       st.sampled_from([50, 70, 90]))
def test_trie_connects_what_links(sets, t):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    found = J.trie_links(arrays, list(range(len(sets))), t)
    links = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
             if i < j and 100 * len(a & b) >= t * len(a | b)}
    assert {tuple(sorted(x)) for x in found} <= links

    def label(pairs):
        root = list(range(len(sets)))
        for _ in sets:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root
    assert label(found) == label(links)


@settings(max_examples=40, deadline=None)
@given(st.integers(10, 400), st.integers(0, 60), st.integers(0, 2**32))
def test_linked_sets_share_a_segment(size, change, seed):
    rng = np.random.default_rng(seed)
    sizes = J.levels(90, 10_000)
    a = rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2)
    b = a.copy()
    b[:change] = rng.integers(0, 2**63, min(change, size)).astype(np.uint64)
    b = b[: max(1, size - int(rng.integers(0, 5)))]
    a, b = np.unique(a), np.unique(b)
    k = len(np.intersect1d(a, b))
    if 100 * k >= 90 * (len(a) + len(b) - k) and not np.array_equal(a, b):
        x, y = (set(np.concatenate(J.segment_digests(s, 90, *sizes)).tolist()) for s in (a, b))
        assert x & y


@pytest.mark.parametrize("t", [70, 75, 76, 80, 90])
def test_sets_at_the_size_bound_share_a_segment(t):
    rng, sizes = np.random.default_rng(t), J.levels(t, 10_000)
    for size in range(2, 300):
        large = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
        small = np.sort(rng.permutation(large)[:-(-size * t // 100)])
        if len(small) < len(large):
            x, y = (set(np.concatenate(J.segment_digests(s, t, *sizes)).tolist()) for s in (small, large))
            assert x & y, (len(small), len(large))


def test_shingling_keeps_no_words():
    texts = [" ".join(f"w{i}x{j}" for j in range(500)) for i in range(100)]
    shingle = J.Shingler(3)
    shingle(texts[0])
    tracemalloc.start()
    sizes = [len(shingle(t)) for t in texts]
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sizes == [498] * 100 and kept < 100_000
