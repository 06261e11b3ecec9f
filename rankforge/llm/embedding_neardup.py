"""Embedding near-duplicates by spherical-cap filters.

A filter is a direction; a vector is in it if its component along the direction
exceeds a bound. The directions are structured: after a random rotation the
space is cut into two halves with a random code of unit vectors each, and every
pair of codewords is a direction. So a vector is list-decoded: the codewords of
one half in order of their products, and for each those of the other half that
bring the sum over the bound. Vectors that share a filter are compared, by
cosine in double precision. In each rotation the number of filters grows with
the number of vectors, so that a filter holds about ``per_filter`` of them, and
the bound is set for ``hits`` filters per vector; a vector in none takes its
``hits`` best ones. ``TABLES`` rotations, and more of them where the chance that
two vectors at the threshold share a filter would be below ``recall``.

Equal vectors are one class with a count. Filters are joined twice. First with a
sketch of each vector, the sides of ``SKETCH`` random hyperplanes it lies on:
only members that have another member within the distance that a pair at the
threshold keeps (but for a chance of 10^-10) go on. Those are joined again with
their vectors and compared. A filter of more than ``block``
classes is cut into chunks, one task for each pair of chunks. A pair found in
several filters counts in the smallest one it shares. Tasks return link counts
and enough links to connect what they found, never all pairs. Links are exact;
recall at a cosine of 0.9 is that of the filters (see the README).

Edge cases: null, empty, zero or non-finite vectors and those with a null
component link with nothing, nor do vectors of different lengths; repeated rows
are equal vectors, so linked; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import connected_components, cut, every_share, share

TABLES = 4
#: Bits of a sketch.
SKETCH = 256
#: Pairs of random vectors, in each of TABLES rotations, that the recall is computed from.
_PAIRS = 500


def usable(v: list[float | None] | None) -> np.ndarray | None:
    if not v or None in v:
        return None
    x = np.asarray(v, np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow on the way."""
    x = x / np.abs(x).max(axis=-1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


def cap_bound(dim: int, share: float) -> float:
    """The component along a fixed direction that this share of random unit
    vectors exceeds: its angle has a density of sin^(dim - 2)."""
    if dim == 1:
        return np.inf  # only two vectors: all take their best filters
    mid = (np.arange(1 << 17) + 0.5) * (np.pi / (1 << 17))
    upto = np.cumsum(np.exp((dim - 2) * np.log(np.sin(mid))))
    return float(np.cos(np.interp(share, upto / upto[-1], mid + np.pi / (1 << 18))))


class ProductCode:
    """Filters of vectors of ``dim`` components in one rotation."""

    def __init__(self, dim: int, words: int, hits: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.dim, self.words, self.seed = dim, words, seed
        self.cut = dim // 2 if dim > 1 else 1
        self.codes = [c / np.linalg.norm(c, axis=1, keepdims=True)
                      for c in (rng.standard_normal((words, max(1, n))) for n in (self.cut, dim - self.cut))]
        self.best = min(words, int(np.ceil(hits)))
        # a pair of unit codewords is a direction of length sqrt(2)
        self.bound = cap_bound(dim, min(0.5, hits / words**2)) * np.sqrt(2)

    @cached_property
    def turn(self) -> np.ndarray:
        rng = np.random.default_rng([self.seed, self.dim, 1])
        return np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0]

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter numbers of each row: all pairs of codewords over the bound, or the best ones if there is none."""
        return self.decode_turned(x @ self.turn)

    def decode_turned(self, x: np.ndarray) -> list[np.ndarray]:
        a = x[:, :self.cut] @ self.codes[0].T
        b = x[:, self.cut:] @ self.codes[1].T if self.cut < x.shape[1] else np.zeros((len(x), self.words))
        order = np.argsort(-b, axis=1, kind="stable")
        out = []
        for i in range(len(x)):
            falling = -b[i, order[i]]
            n = np.searchsorted(falling, a[i] - self.bound, "right")
            first = np.repeat(np.arange(self.words), n)
            second = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
            if not len(first):  # the best sums are among the best words of either half
                top = np.argsort(-a[i], kind="stable")[:self.best]
                sums = (a[i, top][:, None] - falling[None, :self.best]).ravel()
                at = np.argsort(-sums, kind="stable")[:self.best]
                first, second = top[at // self.best], at % self.best
            out.append(first * self.words + order[i][second])
        return out


def shared_by(dim: int, words: int, hits: float, seed: int, cosine: float, pairs: int = _PAIRS) -> float:
    """Share of random pairs at this cosine that have a filter in common in one rotation."""
    rng, met = np.random.default_rng([seed, dim, 2]), 0
    for t in range(TABLES):
        code = ProductCode(dim, words, hits, seed + t)
        x, y = (unit(rng.standard_normal((pairs, dim))) for _ in range(2))
        if dim > 1:
            y = unit(y - (x * y).sum(axis=1, keepdims=True) * x)
            y = cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * y
        else:
            y = x
        # random pairs need no rotation
        met += sum(len(np.intersect1d(f, g)) > 0 for f, g in zip(code.decode_turned(x), code.decode_turned(y)))
    return met / (TABLES * pairs)


def tables(dim: int, words: int, hits: float, seed: int, threshold: float, recall: float) -> int:
    """How many rotations it takes to link two vectors at the threshold with a
    chance of ``recall``. Under a random rotation every pair at a cosine has the
    same chance, independent of the other rotations."""
    missed = 1 - shared_by(dim, words, hits, seed, threshold)
    if missed == 0:
        return TABLES
    if missed == 1:
        raise ValueError(f"no filters for vectors of {dim} components at a cosine of {threshold}")
    return max(TABLES, int(np.ceil(np.log(1 - recall) / np.log(missed))))


def planes(dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, 3]).standard_normal((dim, SKETCH))


def sketch_distance(threshold: float) -> int:
    """Most differing bits of two vectors at the threshold: 6.5 standard deviations over the mean."""
    p = np.arccos(np.clip(threshold, -1, 1)) / np.pi
    return int(np.ceil(SKETCH * p + 6.5 * np.sqrt(SKETCH * p * (1 - p)))) + 2


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, per_filter: float = 200.0, hits: float = 12.0,
                    block: int = 1024, seed: int = 11, recall: float = 0.999) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for ``vectors(vec_id, embedding)``."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [usable(v) for v in b.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"),
                 pa.array([None if x is None else xxhash.xxh3_128_digest((x + 0.0).tobytes()) for x in xs], pa.binary()),
                 pa.array([None if x is None else x.tolist() for x in xs], pa.list_(pa.float64()))],
                names=["vec_id", "key", "vec"])

    rows = cut(vectors.select("vec_id", "embedding").mapInArrow(digest, f"vec_id {kind}, key binary, vec array<double>"))
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("vec_id").alias("rep"))
    n = classes.count()
    words = max(8, int(np.ceil(np.sqrt(n * hits / per_filter))))
    dims = [r[0] for r in classes.select(F.size("vec")).distinct().collect()]
    turns = {dim: tables(dim, words, hits, seed, threshold, recall) for dim in dims}
    most = max(turns.values(), default=TABLES)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[int, list[ProductCode]] = {}
        for pdf in batches:
            out, sketches = [[] for _ in range(len(pdf))], [b""] * len(pdf)
            dims = pdf["vec"].map(len).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in codes:
                    codes[dim] = [ProductCode(dim, words, hits, seed + t) for t in range(turns[dim])]
                at = np.flatnonzero(dims == dim)
                x = unit(np.stack(pdf["vec"].to_numpy()[at]).astype(np.float64))
                for t, code in enumerate(codes[dim]):
                    for i, found in zip(at, code.decode(x)):
                        out[i].append((dim * most + t) * words * words + found)
                for i, bits in zip(at, np.packbits(x @ planes(dim, seed) > 0, axis=1)):
                    sketches[i] = bits.tobytes()
            yield pdf.assign(filters=[np.sort(np.concatenate(x)) for x in out], sketch=sketches)

    # the checkpoint fixes the class numbers
    coded = cut(classes.mapInPandas(
        decode, f"key binary, vec array<double>, copies long, rep {kind}, filters array<long>, sketch binary")
        .withColumn("id", F.monotonically_increasing_id()))

    def dealt(members: DataFrame, *columns: str) -> DataFrame:
        """Members ``(filter, id)`` of each pair of chunks ``(filter, i, j)``; filters with one member are left out."""
        spread = members.groupBy("filter").agg(
            F.ceil(F.count("*") / F.lit(block)).cast("int").alias("chunks"), F.count("*").alias("n")) \
            .filter("n > 1").drop("n")
        return (members.join(spread, "filter")
                .withColumn("chunk", F.pmod(F.hash("id"), F.col("chunks")))
                .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                .select("filter", "id", *columns, "chunk",
                        F.least("chunk", "mate").alias("i"), F.greatest("chunk", "mate").alias("j")))

    far = sketch_distance(threshold)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.unpackbits(np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1), axis=1)
        x = bits.astype(np.float32) * 2 - 1
        close = x @ x.T >= SKETCH - 2 * far
        np.fill_diagonal(close, False)
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            side = pdf["chunk"].to_numpy()
            close &= side[:, None] != side[None, :]
        return pdf.loc[close.any(axis=1), ["filter", "id"]]

    met = cut(dealt(coded.select(F.explode("filters").alias("filter"), "id", "sketch"), "sketch")
              .groupBy("filter", "i", "j").applyInPandas(meet, "filter long, id long").distinct())
    near = dealt(met).join(coded.select("id", "vec", "copies", "filters"), "id")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.stack(pdf["vec"].to_numpy()).astype(np.float64))
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            side = pdf["chunk"].to_numpy()
            linked &= side[:, None] != side[None, :]
        at = np.flatnonzero(linked.any(axis=1))
        linked, pdf = linked[np.ix_(at, at)], pdf.iloc[at]
        if not len(at):
            return pd.DataFrame({"id": [], "other": [], "links": []})
        label = np.arange(len(at))
        while True:  # smallest place reachable
            low = np.minimum(label, np.where(linked, label[None, :], len(at)).min(axis=1))
            low = low[low]
            if (low == label).all():
                break
            label = low
        # a pair counts here only if it shares no smaller filter
        here = int(pdf["filter"].iloc[0])
        before = [f[:np.searchsorted(f, here)] for f in map(np.asarray, pdf["filters"])]
        ids, place = np.unique(np.concatenate(before), return_inverse=True)
        has = np.zeros((len(at), len(ids)), np.float32)
        has[np.repeat(np.arange(len(at)), [len(f) for f in before]), place] = 1
        fresh = linked & (has @ has.T == 0)
        ids = pdf["id"].to_numpy()
        return pd.DataFrame({"id": ids, "other": ids[label], "links": fresh @ pdf["copies"].to_numpy()})

    found = cut(near.groupBy("filter", "i", "j").applyInPandas(compare, "id long, other long, links long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("u"), F.col("other").alias("v")))
    # classes of one vector without a link need no label
    linked = cut(coded.select("id", "key", "rep", "copies").join(links, "id", "left")
                 .join(parts.withColumnRenamed("node", "id"), "id", "left")
                 .filter("copies > 1 or component is not null")
                 .withColumn("component", F.coalesce("component", "id")))
    least = linked.groupBy("component").agg(F.min("rep").alias("least")).withColumn("share", every_share())
    label = (linked.withColumn("share", share("id")).join(least, ["component", "share"])
             .select("key", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
             .withColumn("share", every_share()))
    return rows.select("vec_id", "key").withColumn("share", share("vec_id")).join(label, ["key", "share"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id")) \
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
