import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rankforge.llm import source_mix as M


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.sampled_from([0.0, 0.1, 0.37, 0.5, 0.999, 1.0])), max_size=60), st.integers(0, 99))
def test_pivot_keeps_the_sum_and_leaves_one_part(rows, seed):
    size, part = np.array([s for s, _ in rows], int), np.array([p for _, p in rows], float)
    out = M.pivot(size, part, np.random.default_rng(seed))
    assert np.isclose((size * out).sum(), (size * part).sum())
    assert ((out >= 0) & (out <= 1)).all()
    assert ((out > 0) & (out < 1) & (size > 0)).sum() <= 1


def test_pivot_has_the_right_expectation():
    size, part = np.array([1, 2, 3, 7, 7, 20]), np.full(6, 0.3)
    mean = np.mean([M.pivot(size, part, np.random.default_rng(i)) for i in range(6000)], axis=0)
    assert np.abs(mean - 0.3).max() < 0.03


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return M.mix_sources(df, **kw).collect()


def test_mix_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(0, 60)), f"s{int(rng.integers(0, 7)) ** 2}") for i in range(900)]
    rows += [(i, "v " * 30, "hot") for i in range(900, 1500)] + [(2000, None, None), (2001, "a b c", None), (2001, "a b c", None),
                                                               (None, "x " * 5, "é"), (2002, None, "empty"), (2003, "q " * 40_000, "B")]
    got = run(spark, rows, bucket_rows=16, fan_in=4)
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and np.isclose(r.target, want[s]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 0.5001
        assert sum(r.part_words > 0 for r in mine) <= 1
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    key = lambda r: (str(r.source), str(r.doc_id), r.size, r.taken)
    again = run(spark, rows[::-1], bucket_rows=16, fan_in=4)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_empty_and_wordless(spark):
    assert run(spark, []) == []
    assert [r.taken for r in run(spark, [(1, None, "a"), (2, " ", None)])] == [0, 0]


def test_equal_rows_are_dealt_to_all_buckets(spark):
    """Many equal rows: no bucket holds more than its share, and the target is met."""
    docs = spark.createDataFrame([(1, "a b c", "s")] * 20_000 + [(2, "x y", "t")], "doc_id long, text string, source string")
    got = M.mix_sources(docs, bucket_rows=64)
    rows = got.collect()
    assert len(rows) == 20_001
    taken = sum(r.taken for r in rows if r.source == "s")
    assert abs(taken - next(r.target for r in rows if r.source == "s")) <= 1
    assert {r.copies for r in rows if r.source == "s"} == {1, 2}
