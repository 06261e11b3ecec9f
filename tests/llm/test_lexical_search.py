import math
import re
from collections import Counter

import numpy as np
import pytest

from rankforge.llm import lexical_search as L

TERM = re.compile(L.TERM)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df, out = Counter(t for _, c in counted for t in c), []
    for i, text in items:
        q, found = Counter(terms(text)), []
        for d, c in counted:
            n = sum(c.values())
            m = 25 + 75 * n * n_docs // total if total else 0
            s = sum(q[t] * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in q if t in c)
            if s > 0:
                found.append((s, d))
        out += [(i, r + 1, d, s) for r, (s, d) in enumerate(L.ranked(found, k))]
    return sorted(out, key=str)


def run(spark, docs, items, **setting):
    d = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, n int")
    i = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, score int")
    return sorted((tuple(r) for r in L.search(d, i, **setting).collect()), key=str)


@pytest.mark.parametrize("setting", [{}, {"segment_docs": 30, "block": 4, "batch_entries": 60}, {"segment_docs": 1}])
def test_equals_brute_force(spark, sf_small, setting):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").limit(120).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").limit(12).collect()]
    docs += [(900, None), (901, ""), (902, " .,!\n"), (None, items[0][1]), (903, items[0][1]), (903, items[0][1]), (904, "Éa ÉA éa A_B\x7fc"),
             (905, items[1][1] * 300)]
    items += [(None, items[2][1]), (50, None), (51, ""), (52, "nowhere-zzzz"), (53, "éa Éa a a a B"), (53, "éa Éa a a a B"), (54, "한글 0")]
    assert run(spark, docs, items, **setting) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == run(spark, [(1, "a b")], []) == run(spark, [(1, None)], [(1, "a")]) == []


def test_many_equal_documents(spark):
    docs = [(i, "one two three") for i in range(2000, 0, -1)] + [(i, f"four w{i}") for i in range(3000, 3500)]
    items = [(0, "one two"), (1, "four w3100")]
    got = run(spark, docs, items, block=8, segment_docs=700)
    assert got == brute(docs, items)
    assert [d for i, _, d, _ in sorted(got, key=lambda r: r[:2]) if i == 0] == list(range(1, 11))


def test_terms():
    text = "Ab-C9_é É  A`b{c~\x7fd\x00e/ "
    assert [t.decode() for t in L.terms_of(text)] == terms(text)
    assert L.terms_of(None) == L.terms_of("") == []


def test_summaries_bound_their_blocks_and_skip():
    rng = np.random.default_rng(2)
    number = {bytes([65 + i]): i for i in range(12)}
    items = L.Items([(0, Counter({b"A": 2, b"B": 1, b"C": 1})), (1, Counter({b"D": 1, b"E": 3}))], number)
    own = [np.sort(rng.choice(12, rng.integers(1, 8), replace=False)) for _ in range(300)]
    indptr = np.concatenate([[0], np.cumsum([len(x) for x in own])])
    impacts = rng.integers(1, 1000, indptr[-1])
    s = L.Segment(list(range(300)), indptr, np.concatenate(own), impacts, items, 12, 8)
    for t, (docs, firsts, summary) in s.blocks.items():
        assert sorted(docs) == [d for d in range(300) if t in own[d]]
        assert np.diff(firsts).max() <= 8 and np.diff(firsts).min() >= 1
        for b, (x, y) in enumerate(zip(firsts, firsts[1:])):
            for c, u in enumerate(items.together[t]):
                held = [impacts[indptr[d]:indptr[d + 1]][own[d] == u] for d in docs[x:y]]
                assert summary[b, c] == max((int(h[0]) for h in held if len(h)), default=0)
    full = [(sum(int(n) * int(impacts[indptr[d]:indptr[d + 1]][own[d] == t].sum()) for t, n in zip(items.terms[0], items.times[0])), d)
            for d in range(300)]
    assert s.search(items, 0, [], 5) == L.ranked([x for x in full if x[0] > 0], 5)
    assert s.search(items, 0, [(10 ** 9, -1)] * 5, 5) == [(10 ** 9, -1)] * 5
