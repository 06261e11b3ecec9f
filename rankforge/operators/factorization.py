"""Factorization machine on id columns, as MLlib trains it on their one-hot vectors.

The samples are packed once into blocks of small integers. Features of few ids share
one integer, so a sample is some six of them, whatever the number of positions of the
one-hot vector. An iteration is one job over the blocks: each task adds the residuals,
and the residuals times the factor sums, up by id; one aggregate by position adds the
tasks up, and the driver applies AdamW to the parameters (one row per id, as MLlib).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.boosting import tables_of
from rankforge.session import discarded, small_batches, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 8_192  # what a core holds of them stays near it
GROUP_IDS = 4_096  # features are packed together up to so many combinations


@dataclass
class IdFM:
    """``table``: by position (ids of the first feature, of the second, ...) the factors and
    the linear weight. A feature has the ids 0 .. size - 2 and one position for others."""

    features: list[str]
    sizes: list[int]
    table: np.ndarray
    intercept: float = 0.0
    iterations: int = 0

    def getFactorSize(self) -> int:
        return self.table.shape[1] - 1

    def by_feature(self) -> list[np.ndarray]:
        return np.split(self.table, np.cumsum(self.sizes)[:-1])


def groups_of(sizes: list[int]) -> list[list[int]]:
    """The features, small ones first, in groups of at most ``GROUP_IDS`` combinations."""
    out: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: sizes[f]):
        if out and int(np.prod([sizes[i] for i in out[-1]], dtype=object)) * sizes[f] <= GROUP_IDS:
            out[-1].append(f)
        else:
            out.append([f])
    return out


def codes(ids: list[np.ndarray], sizes: list[int], group: list[int]) -> np.ndarray:
    """The combination of each sample's ids of a group."""
    code = np.zeros(len(ids[0]), np.int64)
    for f in group:
        code = code * sizes[f] + ids[f]
    return code


def code_table(parts: list[np.ndarray], sizes: list[int], group: list[int]) -> np.ndarray:
    """The sums of the members' rows by combination."""
    total = np.zeros((1, parts[0].shape[1]))
    for f in group:
        total = (total[:, None, :] + parts[f][None, :, :]).reshape(-1, total.shape[1])
    return total


def raw_score(codes: list[np.ndarray], tables: list[np.ndarray], intercept: float) -> tuple[np.ndarray, np.ndarray]:
    """Factor sums and raw predictions; the last column of a table is linear weight - squared factors / 2."""
    total = np.zeros((len(codes[0]), tables[0].shape[1]))
    for code, t in zip(codes, tables):
        total += t.take(code, axis=0)
    s = total[:, :-1]
    return s, total[:, -1] + 0.5 * np.einsum("nd,nd->n", s, s) + intercept


def lookup_tables(model: IdFM, groups: list[list[int]]) -> list[np.ndarray]:
    parts = [np.hstack([t[:, :-1], (t[:, -1] - 0.5 * (t[:, :-1] ** 2).sum(axis=1))[:, None]]) for t in model.by_feature()]
    return [code_table(parts, model.sizes, g) for g in groups]


def fm_blocks(rows: DataFrame, names: list[str], sizes: list[int]) -> DataFrame:
    """``n, block``: up to ``BLOCK_ROWS`` samples, the codes of each group and then y."""
    groups = groups_of(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables_of(batches, BLOCK_ROWS):
            ids = [t[c].to_numpy() for c in names]
            parts = [codes(ids, sizes, g).astype(code_kind(sizes, g)).tobytes() for g in groups] + [t["y"].to_numpy().astype(np.int8).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([t.num_rows], pa.int64()), pa.array([b"".join(parts)], pa.binary())], names=["n", "block"])

    return rows.select(*names, "y").mapInArrow(run, "n long, block binary")


def code_kind(sizes: list[int], group: list[int]) -> np.dtype:
    return np.dtype(np.uint16 if int(np.prod([sizes[f] for f in group], dtype=object)) <= 2 ** 16 else np.int32)


def unpacked(block: bytes, n: int, sizes: list[int], groups: list[list[int]]) -> tuple[list[np.ndarray], np.ndarray]:
    out, at = [], 0
    for g in groups:
        kind = code_kind(sizes, g)
        out.append(np.frombuffer(block, kind, n, at).astype(np.int64))
        at += kind.itemsize * n
    return out, np.frombuffer(block, np.int8, n, at)


def gradient_sums(blocks: DataFrame, model: IdFM) -> DataFrame:
    """``position, s0...``: over the samples with the id at a position, the sums of residual *
    factor sum by factor, and of the residual; position -1: the number of samples."""
    groups, sizes, k = groups_of(model.sizes), model.sizes, model.getFactorSize()
    tables, first = lookup_tables(model, groups), np.concatenate([[0], np.cumsum(sizes)])
    intercept, names = model.intercept, [f"s{d}" for d in range(k + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = [np.zeros((k + 1, len(t))) for t in tables], 0
        for n, block in ((n, x) for b in batches for n, x in zip(b.column("n").to_pylist(), b.column("block").to_pylist())):
            at, y = unpacked(block, n, sizes, groups)
            s, raw = raw_score(at, tables, intercept)
            r = 1.0 / (1.0 + np.exp(-raw)) - y
            weights = [*np.ascontiguousarray((s * r[:, None]).T), r]
            for g, code in enumerate(at):
                for d, v in enumerate(weights):
                    sums[g][d] += np.bincount(code, v, sums[g].shape[1])
            count += n
        if not count:
            return
        out = np.zeros((int(first[-1]), k + 1))
        for group, total in zip(groups, sums):
            shape = total.reshape(k + 1, *(sizes[f] for f in group))
            for i, f in enumerate(group):
                own = shape.sum(axis=tuple(1 + j for j in range(len(group)) if j != i))
                out[first[f]:first[f + 1]] = own.T
        used = np.flatnonzero(out.any(axis=1))
        position, values = np.append(used, -1), np.vstack([out[used], np.full((1, k + 1), float(count))])
        yield pa.RecordBatch.from_arrays([pa.array(position), *(pa.array(np.ascontiguousarray(values[:, d])) for d in range(k + 1))],
                                         names=["position", *names])

    schema = "position long, " + ", ".join(f"{c} double" for c in names)
    return blocks.mapInArrow(run, schema).groupBy("position").agg(*(F.sum(c).alias(c) for c in names))


def first_factors(n: int, seed: int, std: float) -> np.ndarray:
    """Normal numbers of the generator that MLlib draws the first factors from."""
    # java.util.Random: 48-bit states, two uniform numbers of 53 bits a trial, Marsaglia's polar method
    state, mask, out = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1), (1 << 48) - 1, []

    def bits(k: int) -> int:
        nonlocal state
        state = (state * 0x5DEECE66D + 0xB) & mask
        return state >> (48 - k)

    while len(out) < n:
        a, b = (2 * (((bits(26) << 27) + bits(27)) / (1 << 53)) - 1 for _ in range(2))
        s = a * a + b * b
        if 0 < s < 1:
            scale = np.sqrt(-2 * np.log(s) / s)
            out += [a * scale, b * scale]
    return std * np.array(out[:n])


def train_id_fm(df: DataFrame, features: list[str], label: str, factors: int = 4, reg: float = 0.01, max_iter: int = 20, step: float = 0.05,
                seed: int = 1, std: float = 0.01, tol: float = 1e-6) -> IdFM:
    """FM for a 0/1 label on features of ids >= 0: log-loss over all samples in every iteration, AdamW,
    until ``max_iter`` or until the parameters move by less than ``tol`` of their norm."""
    spark = df.sparkSession
    rows = df.select(*(F.col(f).cast("int").alias(f) for f in features), F.col(label).cast("double").alias("_y"))
    usable = F.coalesce(F.col("_y").isin(0.0, 1.0), F.lit(False))
    for f in features:
        usable = usable & F.coalesce(F.col(f) >= 0, F.lit(False))
    rows = rows.withColumn("y", F.when(usable, F.col("_y")).otherwise(
        F.raise_error(F.lit("a row without a label 0 or 1 or an id >= 0")).cast("double"))).drop("_y")
    top = rows.agg(*(F.max(f).alias(f) for f in features)).first()
    if top[0] is None:
        raise ValueError("no rows to learn from")
    sizes = [top[f] + 2 for f in features]
    n = sum(sizes)
    model = IdFM(list(features), sizes, np.zeros((n, factors + 1)))
    model.table[:, :-1] = first_factors(n * factors, seed, std).reshape(n, factors)
    m, v = np.zeros(n * (factors + 1) + 1), np.zeros(n * (factors + 1) + 1)
    blocks = written(fm_blocks(rows, features, sizes), packed=True)
    with small_batches(spark):
        for i in range(1, max_iter + 1):
            got = gradient_sums(blocks, model).toArrow()
            position, values = got["position"].to_numpy(), np.stack([got[f"s{d}"].to_numpy() for d in range(factors + 1)], axis=1)
            count = values[position < 0][0, 0]
            sums = np.zeros((n, factors + 1))
            sums[position[position >= 0]] = values[position >= 0]
            residual = sums[:, -1:].copy()
            sums[:, :-1] -= model.table[:, :-1] * residual
            # every sample has one id of the first feature: their residuals are all of them
            g = np.append(sums.ravel(), residual[:sizes[0]].sum()) / count
            old = np.append(model.table.ravel(), model.intercept)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            new = old - step * m / (1 - 0.9 ** i) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8) - reg * old  # MLlib's decay: not by step
            model.table, model.intercept, model.iterations = new[:-1].reshape(n, factors + 1), float(new[-1]), i
            if i > 1 and np.linalg.norm(new - old) < tol * max(np.linalg.norm(new), 1.0):
                break
    discarded(blocks)
    return model


def score_id_fm(df: DataFrame, model: IdFM, out: str = "p") -> DataFrame:
    """``df`` plus the probability of label 1; an id that the model does not know has the last position of its feature."""
    others = [c for c in df.columns if c != out]
    schema = df.select(*others).schema.add(out, "double")
    groups = groups_of(model.sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = lookup_tables(model, groups)
        for b in batches:
            ids = [b.column(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in model.features]
            ids = [np.where((i >= 0) & (i < size - 1), i, size - 1) for i, size in zip(ids, model.sizes)]
            raw = raw_score([codes(ids, model.sizes, g) for g in groups], tables, model.intercept)[1]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), pa.array(1.0 / (1.0 + np.exp(-raw)))], names=schema.names)

    return df.mapInArrow(run, schema)
