import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import joint as J
from rankforge.operators import metrics as M
from rankforge.operators import networks as N
from rankforge.plans.demo import li_spec, samples_li

FIELDS = ["acctbal_b", "discount_b", "mktsegment_v", "nation_id", "z_nation_id", "z_brand_h"]
X = ["discount", "tax", "z_size_n"]
LABELS = {"ctr": "y_ctr", "ctcvr": "y_ctcvr", "cvr": "y_ctcvr"}
NETS = {"fm": lambda: N.FM(FIELDS, 3, 3), "wide_deep": lambda: N.WideDeep(FIELDS, 3, 3, [6, 4]),
        "deepfm": lambda: N.DeepFM(FIELDS, 3, 3, [6, 4]), "esmm": lambda: N.ESMM(FIELDS, 3, 3, [6], 8, stop_ctr_grad=False),
        "esmm_stopped": lambda: N.ESMM(FIELDS, 3, 3, [6], inputs="shared"), "mmoe": lambda: N.MMoE(FIELDS, 3, 3, [6, 4]),
        "two_tower": lambda: N.TwoTower(FIELDS[:4], FIELDS[4:], 3, 2, 1, [6, 4])}


def table_rows(net):
    return sum(n for _, _, n in J.field_tables(li_spec(), net))


def rows_of(spark, sf, net, batches=1, partitions=None, keep=("sample_id",), planted=False):
    s = samples_li(spark, sf)
    if planted:  # labels that depend on two ids and a dense input
        s = s.withColumn("y_ctr", (F.col("nationkey") % 3 + F.col("z_nationkey") % 3 > 2 - F.col("z_size_n")).cast("double")) \
            .withColumn("y_ctcvr", F.col("y_ctr") * (F.col("z_nationkey") % 2))
    if partitions:
        s = s.repartition(partitions)
    return J.training_rows(s, li_spec(), net, LABELS, X, keep=keep, batches=batches)


def numbers(net, n=9, seed=0):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.6).astype(float)
    conv = y * (rng.random(n) < 0.5)
    return (0.4 * rng.normal(size=(n, len(net.fields))), 0.4 * rng.normal(size=(n, len(net.fields), net.dim)), rng.normal(size=(n, net.n_x)),
            {"ctr": y, "ctcvr": conv, "cvr": conv}, rng.random(n) + 0.5, {f: rng.normal(size=s) * 0.4 for f, s in net.shapes().items()})


@pytest.mark.parametrize("name", sorted(NETS))
def test_gradients_equal_finite_differences(name):
    net = NETS[name]()
    L, E, x, Y, w, dense = numbers(net)
    scales = {t: 0.3 + 0.2 * i for i, t in enumerate(net.tasks)}
    held = net.predict(dense, L, E, x)["ctr"]

    def loss():
        if name != "esmm_stopped":
            return sum(s * net.losses(dense, L, E, x, Y, w)[t][0] for t, s in scales.items())
        p = net.predict(dense, L, E, x)  # the click probability is a constant in the joint loss
        return sum(scales[t] * np.sum(net.weight(t, w) * N.log_loss(Y[t], q)) for t, q in (("ctr", p["ctr"]), ("ctcvr", held * p["cvr"])))

    dL, dE, grads = net.gradients(dense, L, E, x, Y, w, scales)
    for values, slope in [(L, dL), (E, dE), *((dense[f], grads.get(f, np.zeros(s))) for f, s in net.shapes().items())]:
        for i in np.ndindex(values.shape):
            at, h = values[i], 1e-6
            values[i] = at + h
            up = loss()
            values[i] = at - h
            down = loss()
            values[i] = at
            assert slope[i] == pytest.approx((up - down) / (2 * h), rel=1e-5, abs=1e-7)


def plain_step(batch, net, model, sparse, tasks, deep, wide, w):
    """One step in numpy over whole arrays: new (sparse, dense)."""
    L, E, x, Y, weight, ids = batch
    total, dense = {}, {f: np.zeros(p.shape) for f, p in model.dense.items()}
    for i, t in enumerate(tasks):
        n = net.mask(t, Y).sum()
        dL, dE, grads = net.gradients(model.dense, L, E, x, Y, weight, {t: 1.0 / n})
        for f, g in grads.items():
            dense[f] += w[i] * g
        for s in range(len(L)):
            for pos, key in ids[s]:
                g = np.concatenate([[dL[s, pos]], dE[s, pos]])
                total[key] = total.get(key, 0) + w[i] * g
    new = {}
    for key, (p, a, b) in sparse.items():
        g = total.get(key, np.zeros(len(p)))
        rules = [wide] + [deep] * (len(p) - 1)
        new[key] = [float(r.apply(p[i], a[i], b[i], g[i], 1, np)[0]) for i, r in enumerate(rules)]
    return new, {f: deep.apply(p, *model.state[f], dense[f], 1, np)[0] for f, p in model.dense.items()}


@pytest.mark.parametrize("name,kind,limit", [("deepfm", "adagrad", None), ("mmoe", "adam", None), ("esmm", "sgd", 0)])
def test_step_equals_numpy(spark, sf_small, name, kind, limit):
    net = NETS[name]()
    deep, wide = J.Rule(kind, 0.05, l2=0.001), J.Rule("ftrl", 0.05, 0.001, 0.001)
    rows = J.stored(rows_of(spark, sf_small, net))
    model = J.start_model(spark, li_spec(), net, deep, wide)
    sparse = {(r.fid, r.bucket): (r.p, r.a, r.b) for r in model.sparse.collect()}
    data = rows.collect()
    L, E = np.zeros((len(data), 6)), np.zeros((len(data), 6, 3))
    ids = [[(e.pos, (e.fid, e.bucket)) for e in r.entries] for r in data]
    for s, own in enumerate(ids):
        for pos, key in own:
            L[s, pos] += sparse[key][0][0]
            E[s, pos] += sparse[key][0][1:]
    y = np.array([r.y for r in data])
    batch = (L, E, np.array([r.x for r in data]), {t: y[:, i] for i, t in enumerate(sorted(LABELS))}, np.array([r.w for r in data]), ids)
    want, dense = plain_step(batch, net, model, sparse, net.tasks, deep, wide, np.ones(len(net.tasks)))
    counts = J.task_counts(rows, net, sorted(LABELS))[0]
    more = {} if limit is None else {"limit": limit}
    got = J.step(rows, model, net, sorted(LABELS), counts, table_rows(net), deep, wide, **more)
    for r in got.sparse.collect():
        assert r.p == pytest.approx(want[r.fid, r.bucket], abs=1e-9)
    for f, p in dense.items():
        assert got.dense[f] == pytest.approx(p, abs=1e-9)


def test_same_weights_for_any_number_of_partitions(spark, sf_small):
    net, found = NETS["deepfm"](), []
    for partitions in (1, 7):
        model = J.start_model(spark, li_spec(), net, J.Rule("adagrad", 0.1))
        rows = J.stored(rows_of(spark, sf_small, net, batches=3, partitions=partitions))
        model = J.train(rows, net, model, LABELS, table_rows(net), epochs=1, deep=J.Rule("adagrad", 0.1))
        assert model.step == 3
        found.append(({(r.fid, r.bucket): r.p for r in model.sparse.collect()}, model.dense))
    assert found[0][0].keys() == found[1][0].keys()
    for key, p in found[0][0].items():
        assert p == pytest.approx(found[1][0][key], abs=1e-9)
    for f, p in found[0][1].items():
        assert p == pytest.approx(found[1][1][f], abs=1e-9)


@pytest.mark.parametrize("name,rule", [("deepfm", J.Rule("adagrad", 0.4)), ("esmm_stopped", J.Rule("adam", 0.1))])
def test_training_improves_and_survives_saving(spark, sf_small, tmp_path, name, rule):
    net = NETS[name]()
    rows = J.stored(rows_of(spark, sf_small, net, batches=2, planted=True).withColumn("dev", F.pmod(F.xxhash64("sample_id"), F.lit(5)) == 0))
    dev, rest = rows.filter("dev"), rows.filter("not dev")
    first = J.start_model(spark, li_spec(), net, rule)
    model = J.train(rest, net, first, LABELS, table_rows(net), epochs=3, deep=rule)
    assert model.history[-1]["loss_ctr"] < model.history[0]["loss_ctr"]

    def auc(m):
        p = J.score(dev, net, m, LABELS, table_rows(net)).join(dev.select("rid", F.element_at("y", 2).alias("y")), "rid")
        return M.auc_exact(p, "y", "p_ctr").first()["auc"]

    assert auc(model) > auc(first) + 0.05
    path = str(tmp_path / "models")
    assert J.load_model(spark, path) is None
    J.save_model(model, path, "20200101")
    J.save_model(first, path, "20191231")
    model.sparse.write.parquet(f"{path}/runs/20200102/sparse")  # a run that was interrupted
    again = J.load_model(spark, path)
    assert again.step == model.step
    before, after = ({r.rid: r.p_ctr for r in J.score(dev, net, m, LABELS, table_rows(net)).collect()} for m in (model, again))
    assert before == pytest.approx(after, abs=1e-12)
    with pytest.raises(ValueError):
        J.load_model(spark, path, "20200102")


def test_gradnorm_uses_the_norms_of_the_shared_experts(spark, sf_small):
    net = NETS["mmoe"]()
    rows = J.stored(rows_of(spark, sf_small, net))
    rule = J.Rule("sgd", 0.01)
    model = J.start_model(spark, li_spec(), net, rule)
    seen = []

    class Watch(J.TaskWeights):
        def next(self, losses, norms):
            seen.append((losses.copy(), norms.copy()))
            return super().next(losses, norms)

    counts = J.task_counts(rows, net, sorted(LABELS))[0]
    got = J.step(rows, model, net, sorted(LABELS), counts, table_rows(net), rule, weights=Watch(3, "gradnorm"))
    data = [b for t in J.whole_samples(J.gathered(rows, model.sparse, table_rows(net), 3).toArrow().to_batches())
            for b in [J.Batch(t, net, sorted(LABELS))]]
    for i, t in enumerate(net.tasks):
        g = [net.gradients(model.dense, b.L, b.E, b.X, b.Y, b.w, {t: 1.0 / counts[t]})[2] for b in data]
        norm = np.sqrt(sum((sum(x[4000 + e] for x in g) ** 2).sum() for e in range(3)))
        assert seen[0][1][i] == pytest.approx(norm, rel=1e-9)
    assert got.history[0]["weight_ctr"] == 1.0


def test_task_weights():
    w = J.TaskWeights(2, "lbtw", period=3)
    assert w.next(np.array([1.0, 2.0]), None).tolist() == [1.0, 1.0]
    for _ in range(2):
        assert w.next(np.array([0.5, 2.0]), None) == pytest.approx((np.array([0.5, 1.0]) / 0.75) ** 0.5)
    assert w.next(np.array([0.3, 0.1]), None).tolist() == [1.0, 1.0]  # a new period
    assert J.TaskWeights(2, "sum", [1.0, 0.5]).next(None, None).tolist() == [1.0, 0.5]


def test_ftrl_zeroes_small_weights():
    r = J.Rule("ftrl", 0.1, l1=1.0)
    p, n, z = r.apply(np.array([0.0, 0.0]), np.full(2, 0.1), np.zeros(2), np.array([0.5, 3.0]), 1, np)
    assert p[0] == 0 and p[1] < 0 and n == pytest.approx([0.35, 9.1])


def test_errors_of_reading_are_not_a_cold_start(spark, tmp_path):
    from rankforge.operators.training import load_latest_weights
    assert load_latest_weights(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        load_latest_weights(spark, str(tmp_path / "bad"))


def test_ids_looked_up_equal_ids_joined(spark, sf_small):
    """Unknown ids, a gap in the table, and ids that repeat in it."""
    net = NETS["deepfm"]()
    rows = J.stored(rows_of(spark, sf_small, net).limit(400).withColumn("entries", F.transform("entries", lambda e: F.when(
        (e["pos"] == 3) & (e["bucket"] % 5 == 1), e.withField("bucket", e["bucket"] + 9000)).otherwise(e))))
    first = J.start_model(spark, li_spec(), net, J.Rule())
    gap = first.sparse.where("not (fid = 4 and bucket = 0) and bucket <> 7")
    scales = {"ctr": 0.01}
    for sparse, held in ((gap, True), (gap.union(gap.where("fid = 4")), False)):
        model = J.Model(sparse, first.dense, first.state)
        assert (J.held_table(model, table_rows(net), 3, J.BROADCAST_LIMIT_BYTES) is not None) == held
        want, got = ({(r.kind, r.task, r.fid, r.bucket): tuple(r)[4:] for r in J.task_gradients(
            rows, model, net, sorted(LABELS), scales, table_rows(net), **limit).collect()} for limit in ({"limit": 0}, {}))
        assert got.keys() == want.keys() and any(b > 9000 for _, _, _, b in got)
        for key, g in want.items():
            assert got[key] == pytest.approx(g, abs=1e-9)
        want, got = (dict(J.score(rows, net, model, LABELS, table_rows(net), **limit).select("rid", "p_ctr").collect()) for limit in ({"limit": 0}, {}))
        assert got == pytest.approx(want, abs=1e-12)


def test_loop_reads_only_the_files_of_its_group(spark, sf_small, monkeypatch):
    """Every step of train_eval_loop plans the files of its split and group only, every scoring those of the dev split."""
    from rankforge.plans import queries_joint as Q
    trained, scored, plain_train, plain_score = [], [], J.train, J.score

    def filters(rows):
        return rows._jdf.queryExecution().sparkPlan().toString().split("PartitionFilters: [")[1].split("]")[0]

    monkeypatch.setattr(J, "train", lambda rows, *a, **b: trained.append(filters(rows)) or plain_train(rows, *a, **b))
    monkeypatch.setattr(J, "score", lambda rows, *a, **b: scored.append(filters(rows)) or plain_score(rows, *a, **b))
    got = Q.q_train_eval_loop(spark, sf_small).collect()
    assert [(r.epoch, r.shard_group, r.step) for r in got] == [(e, g, 5 * e + g + 1) for e in range(2) for g in range(5)]
    assert len(trained) == len(scored) == 10 and all("split" in f for f in trained + scored) and all("shard_group" in f for f in trained)
