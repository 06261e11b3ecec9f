"""Joint training of embedding tables, linear weights and dense layers.

A step takes one mini-batch of samples. If the declared size of the parameter
table fits the broadcast limit, the tasks get the table and look the ids of their
samples up in it; otherwise ids are exploded and joined with it (shuffled), and
each task rebuilds its samples. It runs the network forward and back in Arrow
batches, and sums the gradients of equal ids before it emits them. One aggregate by (task, table, id) adds them up over tasks; the
parameter table, which carries its optimizer state, is merged with that sum and
written (a reliable checkpoint). Dense gradients have the size of the network
and go to the driver, as do the task losses.

Mini-batches are numbered by a seeded hash of the sample's key: no global sort,
and the same batches (hence, up to the order of floating-point sums, the same
weights) for any number of partitions. Task weights are constant, loss-balanced
(LBTW) or GradNorm on the gradients of the parameters that the tasks share.

Samples without known ids, and empty batches, are allowed: an unknown or negative
id reads zeros and learns nothing; an empty batch is no step.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.features import compile_features
from rankforge.operators.lookup import param_table
from rankforge.operators.networks import ESMM, MMoE, Network
from rankforge.session import BROADCAST_LIMIT_BYTES, checkpoint_dir, cut_lineage
from rankforge.spec import FeatureSpec

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPARSE, DENSE, LOSS = 0, 1, 2
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass
class Rule:
    """Update rule: sgd, adagrad, adam or ftrl (``l1``, ``l2`` as in FTRL-proximal;
    for the others ``l2`` adds l2 * parameter to the gradient of every row)."""

    kind: str = "adagrad"
    lr: float = 0.05
    l1: float = 0.0
    l2: float = 0.0
    start: float = 0.1  # initial accumulator of adagrad and ftrl

    def first(self) -> float:
        return self.start if self.kind in ("adagrad", "ftrl") else 0.0

    def apply(self, p, a, b, g, step: int, lib):
        """New (parameter, state a, state b); ``lib`` gives sqrt, abs, where for numpy or columns."""
        if self.l2 and self.kind != "ftrl":
            g = g + p * self.l2
        if self.kind == "sgd":
            return p - g * self.lr, a, b
        if self.kind == "adagrad":
            n = a + g * g
            return p - g * self.lr / lib.sqrt(n), n, b
        if self.kind == "adam":
            m, v = a * 0.9 + g * 0.1, b * 0.999 + g * g * 0.001
            lr = self.lr * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            return p - m * lr / (lib.sqrt(v) + 1e-8), m, v
        if self.kind == "ftrl":
            n = a + g * g
            z = b + g - (lib.sqrt(n) - lib.sqrt(a)) / self.lr * p
            shrunk = (lib.where(z > 0, z - self.l1, z + self.l1)) / (lib.sqrt(n) / self.lr + 2 * self.l2) * -1.0
            return lib.where(lib.abs(z) > self.l1, shrunk, z * 0.0), n, z
        raise ValueError(self.kind)


class _Columns:
    sqrt, abs = staticmethod(F.sqrt), staticmethod(F.abs)

    @staticmethod
    def where(c, x, y):
        return F.when(c, x).otherwise(y)


@dataclass
class Model:
    """Parameters with their optimizer state: ``sparse`` (fid, bucket, p, a, b;
    p = [linear weight, embedding...]) and dense matrices by number."""

    sparse: DataFrame
    dense: dict[int, np.ndarray]
    state: dict[int, tuple[np.ndarray, np.ndarray]]
    step: int = 0
    history: list[dict] = field(default_factory=list)

    def tables(self) -> DataFrame:
        """``fid, bucket, w, vec``, as the scorers take it."""
        return self.sparse.select("fid", "bucket", F.element_at("p", 1).alias("w"), F.slice("p", 2, F.size("p") - 1).alias("vec"))


def field_tables(spec: FeatureSpec, net: Network, numeric=()) -> list[tuple]:
    """(field, table id, rows) of the network's fields: spec features, then numeric value fields."""
    idx, base = spec.field_index(), len(spec.features)
    extra = {c: base + i for i, c in enumerate(numeric)}
    return [(f, extra[f], 1) if f in extra else (f, idx[f], spec[f].n_ids()) for f in net.fields]


def start_model(spark, spec: FeatureSpec, net: Network, deep: Rule, wide: Rule | None = None, numeric=()) -> Model:
    """Initial parameters and optimizer state."""
    fields = [(f, fid, n, False) for f, fid, n in dict((t[1], t) for t in field_tables(spec, net, numeric)).values()]
    t = param_table(spark, fields, dim=net.dim, with_bias=False, with_w=True)
    wide = wide or deep
    first = F.array(F.lit(wide.first()), *[F.lit(deep.first())] * net.dim)
    sparse = t.select("fid", "bucket", F.concat(F.array("w"), "vec").alias("p"), first.alias("a"),
                      F.array(*[F.lit(0.0)] * (net.dim + 1)).alias("b"))
    dense = net.initial()
    return Model(sparse, dense, {f: (np.full(w.shape, deep.first()), np.zeros(w.shape)) for f, w in dense.items()})


def id_entry(pos: int, fid: int, value: Column | None = None):
    """bucket -> (position of the field, table, id, value)."""
    value = F.lit(1.0) if value is None else value
    return lambda bucket: F.struct(F.lit(pos).alias("pos"), F.lit(fid).cast("long").alias("fid"),
                                   bucket.cast("long").alias("bucket"), value.cast("double").alias("value"))


def training_rows(samples: DataFrame, spec: FeatureSpec, net: Network, labels: dict[str, str], x_cols=(), numeric=(),
                  weight: str | None = "wt", key: str = "sample_id", keep=(), batches: int = 1, seed: int = 1) -> DataFrame:
    """``rid, entries, x, y, w, batch`` and ``keep``: the compiled samples, with
    their ids as (position, table, id, value) and the number of their mini-batch."""
    columns = dict.fromkeys([key, *keep, *labels.values(), *x_cols, *numeric, *([weight] if weight else [])])
    feats = compile_features(samples, spec, keep=[c for c in columns if c not in net.fields or c in numeric])
    parts = []
    for pos, (f, fid, _) in enumerate(field_tables(spec, net, numeric)):
        if f in numeric:
            parts.append(F.array(id_entry(pos, fid, F.coalesce(F.col(f).cast("double"), F.lit(0.0)))(F.lit(0))))
        elif spec[f].is_list:
            parts.append(F.transform(F.coalesce(F.col(f), F.array().cast("array<bigint>")), id_entry(pos, fid)))
        else:
            parts.append(F.array(id_entry(pos, fid)(F.col(f))))
    entries = F.filter(F.concat(*parts), lambda e: e["bucket"] >= 0)
    numbers = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in x_cols]) if x_cols else F.array().cast("array<double>")
    return feats.select(
        F.monotonically_increasing_id().alias("rid"), *dict.fromkeys(keep), entries.alias("entries"), numbers.alias("x"),
        F.array(*[F.col(labels[t]).cast("double") for t in sorted(labels)]).alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(batches)).cast("int").alias("batch"))


def stored(rows: DataFrame, by=()) -> DataFrame:
    """The rows written by batch, and then by the columns ``by`` of few values, into the shared folder: a step
    reads its batch only, and a filter on ``by`` only the rows that it keeps."""
    spark = rows.sparkSession
    path = f"{checkpoint_dir(spark)}/train-{uuid.uuid4().hex}"
    before = spark.conf.get(WRITERS, "0")
    spark.conf.set(WRITERS, str(max(int(before), 16 if by else 8)))  # the files of a few batches open at once: no sort of all rows by batch
    try:
        rows.write.option("parquet.block.size", 32 << 20).partitionBy("batch", *by).parquet(path)
    finally:
        spark.conf.set(WRITERS, before)
    return spark.read.schema(rows.schema).parquet(path)


def gathered(rows: DataFrame, sparse: DataFrame, table_rows: int, dim: int, limit: int = BROADCAST_LIMIT_BYTES, keep=()) -> DataFrame:
    """One row per sample (pos -1: x, y, w and ``keep``) followed by one per id
    with its parameters; the rows of a sample lie together."""
    head = F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("fid"), F.lit(None).cast("long").alias("bucket"),
                    F.lit(None).cast("double").alias("value"))
    own = list(dict.fromkeys(("x", "y", "w", *keep)))
    long = rows.select("rid", *own, F.explode(F.concat(F.array(head), "entries")).alias("e")).select(
        "rid", "e.*", *[F.when(F.col("e.pos") < 0, F.col(c)).alias(c) for c in own])
    t = sparse.select("fid", "bucket", "p")
    if table_rows * (48 + 8 * (dim + 1)) <= limit:
        out = long.join(F.broadcast(t), ["fid", "bucket"], "left")
    else:
        out = long.join(t, ["fid", "bucket"], "left").repartition("rid").sortWithinPartitions("rid", "pos")
    return out.select("rid", "pos", "fid", "bucket", "value", *own, "p")


def whole_samples(batches: Iterator[pa.RecordBatch], least: int = 50_000) -> Iterator[pa.Table]:
    """The gathered rows in tables of whole samples."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        kept.append(b)
        if sum(k.num_rows for k in kept) >= least:
            t = pa.Table.from_batches(kept).combine_chunks()
            last = int(np.flatnonzero(t["pos"].to_numpy() < 0)[-1])
            if last:
                yield t.slice(0, last)
            kept = t.slice(last).to_batches()
    if kept and sum(k.num_rows for k in kept):
        yield pa.Table.from_batches(kept).combine_chunks()


def floats(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as rows of ``width``; null rows are zeros."""
    a = column.combine_chunks()
    out, there = np.zeros((len(a), width)), a.is_valid().to_numpy(zero_copy_only=False)
    if width:
        out[there] = a.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


class Batch:
    """Network inputs of some gathered rows."""

    def __init__(self, t: pa.Table, net: Network, tasks: list[str]):
        pos = t["pos"].to_numpy()
        heads = pos < 0
        self.ids = ~heads  # rows of ids; the others begin a sample
        self.n = int(heads.sum())
        self.sample, self.pos = (np.cumsum(heads) - 1)[self.ids], pos[self.ids]
        self.key = np.stack([t[c].to_numpy(zero_copy_only=False)[self.ids].astype(np.int64) for c in ("fid", "bucket")], axis=1)
        self.value = t["value"].to_numpy(zero_copy_only=False)[self.ids].astype(float)
        p = floats(t["p"], net.dim + 1)[self.ids] * self.value[:, None]
        self.L, self.E = np.zeros((self.n, len(net.fields))), np.zeros((self.n, len(net.fields), net.dim))
        np.add.at(self.L, (self.sample, self.pos), p[:, 0])
        np.add.at(self.E, (self.sample, self.pos), p[:, 1:])
        self.X = floats(t["x"], net.n_x)[heads]
        y = floats(t["y"], len(tasks))[heads]
        self.Y = {name: y[:, i] for i, name in enumerate(tasks)}
        self.w = t["w"].to_numpy(zero_copy_only=False)[heads].astype(float)
        self.rid = t["rid"].to_numpy()[heads]


class Table:
    """A parameter table of bounded size, by (table, id)."""

    def __init__(self, t: pa.Table, width: int):
        t = t.filter(pc.and_(t["fid"].is_valid(), t["bucket"].is_valid()))
        fid, bucket = (t[c].to_numpy().astype(np.int64) for c in ("fid", "bucket"))
        order = np.lexsort((bucket, fid))
        self.fid, self.bucket = fid[order], bucket[order]
        self.p = np.vstack([floats(t["p"], width)[order], np.zeros((1, width))])  # the last row is that of unknown ids
        fids, first = np.unique(self.fid, return_index=True)
        self.parts = dict(zip(fids.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(fid)])))

    def repeats(self) -> bool:
        """Whether an id occurs twice."""
        return bool(((self.fid[1:] == self.fid[:-1]) & (self.bucket[1:] == self.bucket[:-1])).any())

    def find(self, fid: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The row of every id, -1 for an unknown one."""
        at = np.full(len(fid), -1)
        for f, (a, b) in self.parts.items():
            own = np.flatnonzero(fid == f)
            ids, want = self.bucket[a:b], bucket[own]
            near = want if ids[0] == 0 and ids[-1] == b - a - 1 else np.searchsorted(ids, want)
            near = np.clip(near, 0, b - a - 1)
            at[own] = np.where(ids[near] == want, near + a, -1)
        return at


def held_table(model: Model, table_rows: int, dim: int, limit: int) -> Table | None:
    """The table for the tasks to look ids up, if its declared size fits ``limit`` and no id repeats."""
    if table_rows * (48 + 8 * (dim + 1)) > limit:
        return None
    table = Table(model.sparse.select("fid", "bucket", "p").toArrow(), dim + 1)
    return None if table.repeats() else table


class Packed(Batch):
    """Network inputs of rows with ``entries``, whose ids are looked up in a table."""

    def __init__(self, t: pa.Table, net: Network, tasks: list[str], table: Table):
        lists = t["entries"].combine_chunks()
        flat, counts = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        pos, fid, bucket, value = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        self.n = t.num_rows
        self.sample, self.pos, self.value = np.repeat(np.arange(self.n), counts), pos, value.astype(float)
        self.key = np.stack([fid, bucket], axis=1)
        self.at = table.find(fid, bucket)
        p = table.p[self.at] * self.value[:, None]
        place, size = self.sample * len(net.fields) + self.pos, self.n * len(net.fields)
        sums = [np.bincount(place, p[:, d], size).reshape(self.n, -1) for d in range(net.dim + 1)]
        self.L = sums[0]
        self.E = np.stack(sums[1:], axis=2) if net.dim else np.zeros((*sums[0].shape, 0))
        self.X = floats(t["x"], net.n_x)
        y = floats(t["y"], len(tasks))
        self.Y = {name: y[:, i] for i, name in enumerate(tasks)}
        self.w = t["w"].to_numpy().astype(float)
        self.rid = t["rid"].to_numpy()


def task_gradients(rows: DataFrame, model: Model, net: Network, labels: list[str], scales: dict[str, float], table_rows: int,
                   limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``kind, task, fid, bucket, g0...``: per task the gradient of its scaled
    loss, by id (kind 0) and by entry of a dense parameter (kind 1), and its
    unscaled loss sum and row count (kind 2: g0, and g1)."""
    dense, dim, tasks = model.dense, net.dim, list(net.tasks)
    names = ["kind", "task", "fid", "bucket", *(f"g{d}" for d in range(dim + 1))]

    def emit(kind: int, task: int, fid, bucket, g: np.ndarray) -> pa.RecordBatch:
        n = len(g)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, task, np.int32)),
             pa.array(np.broadcast_to(fid, n).astype(np.int64)), pa.array(np.asarray(bucket, np.int64)),
             *(pa.array(np.ascontiguousarray(g[:, d])) for d in range(dim + 1))], names=names)

    def padded(v: np.ndarray) -> np.ndarray:
        return np.hstack([v[:, None], np.zeros((len(v), dim))])

    table = held_table(model, table_rows, dim, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        loss = np.zeros((len(tasks), 2))
        if table is not None:  # sums by row of the table, whose last row stands for unknown ids
            by_row, seen = np.zeros((len(tasks), *table.p.shape)), np.zeros(len(table.p), bool)
        for b in (Batch(t, net, labels) for t in whole_samples(batches)) if table is None else \
                (Packed(pa.Table.from_batches([x]), net, labels, table) for x in batches if x.num_rows):
            rest = np.arange(len(b.key)) if table is None else np.flatnonzero(b.at < 0)
            keys, inverse = np.unique(b.key[rest], axis=0, return_inverse=True)
            for i, (s, n) in enumerate(net.losses(dense, b.L, b.E, b.X, b.Y, b.w).values()):
                loss[i] += s, n
            for i, task in enumerate(tasks):
                dL, dE, grads = net.gradients(dense, b.L, b.E, b.X, b.Y, b.w, {task: scales[task]})
                for f, g in grads.items():
                    total[i, f] = total.get((i, f), 0.0) + g
                own = np.hstack([dL[b.sample, b.pos][:, None], dE[b.sample, b.pos]]) * b.value[:, None]
                if table is not None:
                    for d in range(dim + 1):
                        by_row[i, :, d] += np.bincount(b.at % len(table.p), own[:, d], len(table.p))
                    seen[b.at] = True
                out = np.zeros((len(keys), dim + 1))
                np.add.at(out, inverse.reshape(-1), own[rest])
                if len(keys):
                    yield emit(SPARSE, i, keys[:, 0], keys[:, 1], out)
        if table is not None:
            used = np.flatnonzero(seen[:-1])
            for i in range(len(tasks) if len(used) else 0):
                yield emit(SPARSE, i, table.fid[used], table.bucket[used], by_row[i, used])
        for (i, f), g in total.items():
            yield emit(DENSE, i, f, np.arange(g.size), padded(g.ravel()))
        yield emit(LOSS, 0, -1, np.arange(len(tasks)), padded(loss[:, 0]))
        yield emit(LOSS, 1, -1, np.arange(len(tasks)), padded(loss[:, 1]))

    schema = "kind int, task int, fid long, bucket long, " + ", ".join(f"g{d} double" for d in range(dim + 1))
    source = gathered(rows, model.sparse, table_rows, dim, limit) if table is None else rows.select("rid", "entries", "x", "y", "w")
    return source.mapInArrow(run, schema).groupBy("kind", "task", "fid", "bucket").agg(
        *(F.sum(f"g{d}").alias(f"g{d}") for d in range(dim + 1)))


class TaskWeights:
    """Weights of the task losses by step: ``sum`` (constants), ``lbtw`` (relative
    training speed to the power alpha, scaled by their ``norm``: "mean" as ratio to the
    mean speed, "count" so that the weights add up to the number of tasks) or
    ``gradnorm`` (Adam on the distance of the weighted gradient norms from their targets)."""

    def __init__(self, n: int, mode: str = "sum", constants=None, alpha: float | None = None, lr: float = 0.01, period: int = 34848,
                 norm: str = "mean"):
        self.mode, self.w, self.lr, self.period, self.norm = mode, np.ones(n) if constants is None else np.array(constants, float), lr, period, norm
        self.alpha = alpha if alpha is not None else 0.12 if mode == "gradnorm" else 0.5
        self.m, self.v, self.t, self.first = np.zeros(n), np.zeros(n), 0, None

    def next(self, losses: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """The weights of this step, from its losses and gradient norms."""
        if self.mode == "sum":
            return self.w
        if self.first is None or self.mode == "lbtw" and self.t % self.period == 0:
            self.first = losses.copy()
        self.t += 1
        speed = losses / self.first
        if self.mode == "lbtw":
            w = (speed / speed.mean()) ** self.alpha
            return w if self.norm == "mean" else w * len(w) / w.sum()
        used = self.w
        g = self.w * norms
        pull = (speed / speed.mean()) ** self.alpha
        side = np.sign(g - g.mean() * pull)
        grad = side * norms - (side * pull).sum() * norms / len(norms)
        self.m, self.v = 0.9 * self.m + 0.1 * grad, 0.999 * self.v + 0.001 * grad * grad
        w = self.w - self.lr * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)
        self.w = w * len(w) / w.sum()
        return used


def shared_part(net: Network) -> tuple[Column, set[int]]:
    """What GradNorm measures: the experts of MMoE, the tables of the others."""
    if isinstance(net, MMoE):
        fids = {4000 + e for e in range(net.n_experts)}
        return (F.col("kind") == DENSE) & F.col("fid").isin(sorted(fids)), fids
    if isinstance(net, ESMM) and net.shared.layers:
        fids = {net.shared.layers[0][0]}
        return (F.col("kind") == DENSE) & F.col("fid").isin(sorted(fids)), fids
    return F.col("kind") == SPARSE, set()


def step(rows: DataFrame, model: Model, net: Network, labels: list[str], counts: dict[str, int], table_rows: int, deep: Rule,
         wide: Rule | None = None, weights: TaskWeights | None = None, limit: int = BROADCAST_LIMIT_BYTES) -> Model:
    """One update of all parameters from the samples in ``rows``; ``counts`` has
    the number of rows of every task, which its loss is divided by."""
    tasks, dim, wide, n = list(net.tasks), net.dim, wide or deep, model.step + 1
    weights = weights or TaskWeights(len(tasks))
    scales = {t: 1.0 / counts[t] if counts[t] else 0.0 for t in tasks}
    grads = cut_lineage(task_gradients(rows, model, net, labels, scales, table_rows, limit))
    small = grads.filter(F.col("kind") > SPARSE).collect()  # the size of the network
    losses = np.array([next((r.g0 for r in small if r.kind == LOSS and r.task == 0 and r.bucket == i), 0.0) * scales[t]
                       for i, t in enumerate(tasks)])
    norms = np.zeros(len(tasks))
    if weights.mode == "gradnorm":
        which, _ = shared_part(net)
        square = sum((F.col(f"g{d}") ** 2 for d in range(1, dim + 1)), F.col("g0") ** 2)
        for r in grads.filter(which).groupBy("task").agg(F.sqrt(F.sum(square)).alias("n")).collect():
            norms[r.task] = r.n
    w = weights.next(losses, norms)
    # dense parameters
    total = {f: np.zeros(p.size) for f, p in model.dense.items()}
    for r in small:
        if r.kind == DENSE:
            total[r.fid][r.bucket] += w[r.task] * r.g0
    dense, state = {}, {}
    for f, p in model.dense.items():
        new = deep.apply(p, *model.state[f], total[f].reshape(p.shape), n, np)
        dense[f], state[f] = new[0], new[1:]
    # tables
    by_task = F.element_at(F.array(*[F.lit(float(x)) for x in w]), F.col("task") + 1)
    g = grads.filter(F.col("kind") == SPARSE).groupBy("fid", "bucket").agg(
        F.array(*(F.sum(F.col(f"g{d}") * by_task) for d in range(dim + 1))).alias("g"))
    zeros = F.array(*[F.lit(0.0)] * (dim + 1))

    def updated(x, i):
        new = [F.when(i == 0, a).otherwise(b) for a, b in zip(wide.apply(x["p"], x["a"], x["b"], x["g"], n, _Columns),
                                                              deep.apply(x["p"], x["a"], x["b"], x["g"], n, _Columns))]
        return F.struct(*(c.alias(k) for k, c in zip("pab", new)))

    merged = model.sparse.join(g, ["fid", "bucket"], "left").withColumn("g", F.coalesce("g", zeros)) \
        .withColumn("new", F.transform(F.arrays_zip("p", "a", "b", "g"), updated))
    sparse = cut_lineage(merged.select("fid", "bucket", *(F.col(f"new.{k}").alias(k) for k in "pab")))
    entry = {"step": n, "loss": float((w * losses).sum()), **{f"loss_{t}": float(x) for t, x in zip(tasks, losses)},
             **{f"weight_{t}": float(x) for t, x in zip(tasks, w)}}
    return Model(sparse, dense, state, n, [*model.history, entry])


def walk_forward_runs(rows: DataFrame, period: str, net: Network, first: Model, labels: dict[str, str], table_rows: int, path: str,
                      deep: Rule | None = None, wide: Rule | None = None, epochs: int = 1, keep=("y", "w")) -> Iterator[tuple]:
    """Train on each period from the run committed for the one before it, commit
    the new run, and score the period after it: yields (period, tested period,
    model, scores). A period whose run is committed already is not trained again."""
    spark = rows.sparkSession
    periods = sorted(r[0] for r in rows.select(period).distinct().collect())
    done = set(committed_runs(spark, path))
    for now, after in zip(periods, periods[1:]):
        name = str(now)
        if name not in done:
            earlier = [str(p) for p in periods if p < now and str(p) in done]
            model = load_model(spark, path, earlier[-1]) if earlier else first
            model = train(rows.filter(F.col(period) == now), net, model, labels, table_rows, epochs, deep, wide)
            save_model(model, path, name)
            done.add(name)
        model = load_model(spark, path, name)
        yield now, after, model, score(rows.filter(F.col(period) == after), net, model, labels, table_rows, keep=keep)


def task_counts(rows: DataFrame, net: Network, labels: list[str]) -> dict[int, dict[str, int]]:
    """Rows of every task in every batch."""
    clicked = F.element_at("y", labels.index("ctr") + 1) == 1
    got = rows.groupBy("batch").agg(F.count("*").alias("n"), F.count(F.when(clicked, 1)).alias("clicked")).collect()
    return {r.batch: {t: r.clicked if t == "cvr" else r.n for t in net.tasks} for r in got}


def train(rows: DataFrame, net: Network, model: Model, labels: dict[str, str], table_rows: int, epochs: int = 1,
          deep: Rule | None = None, wide: Rule | None = None, weights: TaskWeights | None = None, seed: int = 1,
          limit: int = BROADCAST_LIMIT_BYTES) -> Model:
    """Passes over all mini-batches of ``rows`` (``training_rows``, best ``stored``); their order changes by epoch."""
    deep, names = deep or Rule(), sorted(labels)
    counts = task_counts(rows, net, names)
    weights = weights or TaskWeights(len(net.tasks))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for b in rng.permutation(sorted(counts)).tolist():
            model = step(rows.filter(F.col("batch") == b), model, net, names, counts[b], table_rows, deep, wide, weights, limit)
    return model


def score(rows: DataFrame, net: Network, model: Model, labels: dict[str, str], table_rows: int,
          limit: int = BROADCAST_LIMIT_BYTES, keep=()) -> DataFrame:
    """``rid``, ``keep`` and the probabilities ``p_<task>`` of every sample."""
    names, dense = sorted(labels), model.dense
    heads = sorted(net.predict(dense, np.zeros((0, len(net.fields))), np.zeros((0, len(net.fields), net.dim)), np.zeros((0, net.n_x))))
    schema = rows.select("rid", *keep).schema
    for h in heads:
        schema = schema.add(f"p_{h}", "double")

    table = held_table(model, table_rows, net.dim, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_samples(batches) if table is None else (pa.Table.from_batches([x]) for x in batches if x.num_rows):
            b = Batch(t, net, names) if table is None else Packed(t, net, names, table)
            p = net.predict(dense, b.L, b.E, b.X)
            own = t.select(["rid", *keep])
            own = own.filter(pa.array(~b.ids)).combine_chunks() if table is None else own
            for part in pa.table([*own.columns, *(pa.array(p[h]) for h in heads)], names=schema.names).to_batches():
                yield part

    if table is None:
        return gathered(rows, model.sparse, table_rows, net.dim, limit, keep).mapInArrow(run, schema)
    return rows.select(*dict.fromkeys(("rid", "entries", "x", "y", "w", *keep))).mapInArrow(run, schema)


# ---------------------------------------------------------------- committed runs
def dense_table(spark, dense: dict[int, np.ndarray], state: dict | None = None) -> DataFrame:
    """``fid, i, j, p, a, b`` of the dense parameters."""
    rows = [(f, i, j, float(w[i, j]), *((float(s[i, j]) for s in state[f]) if state else (0.0, 0.0)))
            for f, w in dense.items() for i in range(w.shape[0]) for j in range(w.shape[1])]
    return spark.createDataFrame(rows, "fid long, i int, j int, p double, a double, b double")


def dense_arrays(table: DataFrame) -> tuple[dict, dict]:
    """Dense parameters and their state from ``dense_table`` (the size of the network)."""
    out: dict[int, list] = {}
    for r in table.collect():
        out.setdefault(r.fid, []).append((r.i, r.j, r.p, r.a, r.b))
    dense, state = {}, {}
    for f, cells in out.items():
        arrays = [np.zeros((max(c[0] for c in cells) + 1, max(c[1] for c in cells) + 1)) for _ in range(3)]
        for i, j, *values in cells:
            for a, v in zip(arrays, values):
                a[i, j] = v
        dense[f], state[f] = arrays[0], (arrays[1], arrays[2])
    return dense, state


def save_model(model: Model, path: str, run: str) -> None:
    """Write a run's tables, then its line in the list of runs: a run that was
    interrupted before that line exists is never loaded. Names of runs sort by time."""
    spark = model.sparse.sparkSession
    if run in committed_runs(spark, path):
        raise ValueError(f"run {run!r} exists")
    model.sparse.write.mode("overwrite").parquet(f"{path}/runs/{run}/sparse")
    dense_table(spark, model.dense, model.state).write.mode("overwrite").parquet(f"{path}/runs/{run}/dense")
    spark.createDataFrame([(run, model.step)], "run string, step long").coalesce(1).write.mode("append").parquet(f"{path}/committed")


def committed_runs(spark, path: str) -> list[str]:
    """Names of the complete runs, oldest first."""
    from rankforge.operators.training import read_if_exists
    t = read_if_exists(spark, f"{path}/committed")
    return [] if t is None else sorted(r.run for r in t.select("run").distinct().collect())


def load_model(spark, path: str, run: str | None = None) -> Model | None:
    """The given run, or the newest complete one; None if there is none."""
    runs = committed_runs(spark, path)
    if run is None and not runs:
        return None
    run = run or runs[-1]
    if run not in runs:
        raise ValueError(f"run {run!r} is not complete")
    dense, state = dense_arrays(spark.read.parquet(f"{path}/runs/{run}/dense"))
    last = spark.read.parquet(f"{path}/committed").filter(F.col("run") == run).first().step
    return Model(spark.read.parquet(f"{path}/runs/{run}/sparse"), dense, state, last)
