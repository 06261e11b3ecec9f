import numpy as np

from rankforge.llm import embedding_neardup as E


def brute(ids, rows, t=0.9):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for v in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i]) == len(rows[j]):
                a, b = np.array(rows[i], float), np.array(rows[j], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= t:
                    n[i] += 1
                    n[j] += 1
                    root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: (n[i], least[find(i)]) for i, d in enumerate(ids)}


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 64))
    rows = [(base[i % 30] + rng.standard_normal(64) * rng.choice([0, 0.1, 0.3, 0.45])).astype(np.float32).tolist() for i in range(240)]
    rows += [None, [], [0.0] * 64, [1.0] * 63 + [None], [float("nan")] * 64, [1.0, 2.0], [2.0, 4.0], [1e30] * 64, [1e-30] * 64,
             rows[0], rows[0]]
    ids = [int(x) for x in rng.permutation(len(rows))]
    df = spark.createDataFrame([(d, v, 0) for d, v in zip(ids, rows)], "vec_id long, embedding array<float>, key int")
    want = brute(ids, rows)
    for block in (1024, 40):
        got = {r.vec_id: r for r in E.near_duplicates(df, block=block).collect()}
        assert len(got) == len(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
        assert all(got[d].n_links <= want[d][0] for d in ids)
        assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())
        assert sum(got[d].component_id == want[d][1] for d in ids) >= 0.97 * len(ids)
    assert E.near_duplicates(df.limit(0)).collect() == []


def test_list_decoding_is_exact():
    code = E.ProductCode(64, 20, 12.0, 1)
    x = E.unit(np.random.default_rng(0).standard_normal((5, 64)))
    y = x @ code.turn
    for v, found in zip(y, code.decode(x)):
        s = (v[:32] @ code.codes[0].T)[:, None] + (v[32:] @ code.codes[1].T)[None, :]
        assert sorted(found.tolist()) == np.flatnonzero((s >= code.bound).ravel()).tolist()


def test_recall_with_as_many_filters_as_for_ten_million_vectors(spark):
    rng, words = np.random.default_rng(8), 775
    x = E.unit(rng.standard_normal((400, 64)))
    y = rng.standard_normal((400, 64))
    y = E.unit(y - (x * y).sum(1, keepdims=True) * x)
    c = rng.uniform(0.901, 0.92, (400, 1))
    rows = np.concatenate([x, c * x + np.sqrt(1 - c * c) * y])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in E.near_duplicates(df, per_filter=len(rows) * 12 / words**2).collect()}
    assert sum(got.values()) >= 0.99 * 800


def test_sketches_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(6)
    for dim, t in ((64, 0.9), (8, 0.9), (64, 0.7)):
        x = E.unit(rng.standard_normal((20_000, dim)))
        y = rng.standard_normal((20_000, dim))
        y = t * x + np.sqrt(1 - t * t) * E.unit(y - (x * y).sum(1, keepdims=True) * x)
        p = E.planes(dim, 11)
        apart = ((x @ p > 0) != (y @ p > 0)).sum(1)
        assert apart.max() <= E.sketch_distance(t) and abs(apart.mean() / E.SKETCH - np.arccos(t) / np.pi) < 0.02
    strangers = ((x @ p > 0) != (x[::-1] @ p > 0)).sum(1)
    assert (strangers <= E.sketch_distance(0.9)).mean() < 0.001


def test_planted_pairs_and_clusters(spark):
    """Recall against brute force: pairs at 0.90 to 0.95 and clusters of near copies among strangers."""
    rng = np.random.default_rng(10)
    x = E.unit(rng.standard_normal((3000, 64)))
    z = rng.standard_normal((300, 64))
    z = E.unit(z - (x[:300] * z).sum(1, keepdims=True) * x[:300])
    c = rng.uniform(0.901, 0.95, (300, 1))
    clusters = np.repeat(x[300:303], 150, axis=0) + 0.04 * rng.standard_normal((450, 64))
    rows = E.unit(np.concatenate([x, c * x[:300] + np.sqrt(1 - c * c) * z, clusters]))
    cos = rows @ rows.T >= 0.9
    np.fill_diagonal(cos, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in E.near_duplicates(df, block=128).collect()}
    assert all(got[i] <= n for i, n in enumerate(cos.sum(1)))
    print("recall", sum(got.values()) / cos.sum())
    assert sum(got.values()) >= 0.99 * cos.sum()


def test_bound_is_that_of_unit_vectors():
    x = E.unit(np.random.default_rng(1).standard_normal((200_000, 16)))[:, 0]
    for share in (0.3, 0.01, 0.001):
        assert abs((x > E.cap_bound(16, share)).mean() / share - 1) < 0.25
    assert abs(E.cap_bound(3, 0.25) - 0.5) < 1e-4  # in three dimensions the component is uniform


def test_every_vector_has_a_filter(spark):
    code = E.ProductCode(64, 775, 12.0, 3)
    assert min(map(len, code.decode(E.unit(np.random.default_rng(2).standard_normal((300, 64)))))) > 0
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [-1.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.component_id for r in E.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3}
