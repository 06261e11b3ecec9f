"""Exact top-k by inner product, block at a time.

Vectors are put in the order of their similarity (cells of pivots that a bounded
sample provides), cut into ranges of at most ``range_rows`` rows, and each range
into blocks. A block keeps the largest and the smallest value of every component,
so a query's bound on a block is the sum, over its components, of the larger of
the two products. A range is one row: its ids, its vectors (the forward index of
its blocks) and the blocks' extremes.

A query first meets the blocks of its own range, which gives it a lower bound on
its k-th score. Then it goes to the ranges whose own bound reaches that score:
there it takes the blocks by descending bound and scores each by its forward
index, until the next bound is below its k-th score so far. What remains per
range (at most k rows a query) is ranked.

Movement: every vector once, into its range; every query to the ranges that its
bound reaches (queries travel in packs, ranges once per ``packs_at_once`` packs).
A task holds one range and about ``packs_at_once`` packs. The pivots are the
only broadcast: at most ``max_cells``, from a sample of at most ``sample_rows``
rows. A cell of any size is dealt to as many ranges as it needs.

Edge cases: vectors that are null, or hold null, NaN or infinite components, and
rows without an id, take no part; vectors of different lengths are compared as
if padded with zeros; rows that share an id are candidates (and queries) each,
but none of them is a candidate of another; equal scores rank by id; an empty
table, or one without queries, gives no rows. Products that do not fit 64 bits
are an error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import cut

_EXACT = float(2 ** 53)


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, v``: floor(scale * x) of every component, for the rows that take part."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return df.filter(fine).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


def matrix(vectors, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width``."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def pack(a: np.ndarray) -> bytes:
    """The smallest integer type that holds all values, then the values."""
    top = int(np.abs(a).max()) if a.size else 0
    kind = next((k for k in (np.int8, np.int16, np.int32) if top <= np.iinfo(k).max), np.int64)
    return bytes([np.dtype(kind).itemsize]) + np.ascontiguousarray(a, kind).tobytes()


def unpack(b: bytes, width: int) -> np.ndarray:
    """What ``pack`` was given, as rows of ``width``."""
    return np.frombuffer(b, np.dtype(f"i{b[0]}"), offset=1).astype(np.int64).reshape(-1, width)


def products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Integer inner products, by floating point where that is exact."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    top = float(np.abs(rows).max()) * float(np.abs(vector).max()) * rows.shape[1]
    if top < _EXACT:
        return (rows.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
    if top >= 2.0 ** 63:
        raise OverflowError("inner products beyond 64 bits")
    return rows @ vector


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Upper bounds (queries x blocks): the sum of the larger product per component."""
    top = float(np.abs(queries).max(initial=0)) * float(max(np.abs(high).max(initial=0), np.abs(low).max(initial=0))) * queries.shape[1]
    q = queries.astype(np.float64)
    out = np.maximum(q, 0) @ high.T.astype(np.float64) + np.minimum(q, 0) @ low.T.astype(np.float64)
    return out if top < _EXACT else out + np.abs(out) * 1e-9 + top * 1e-12


class Range:
    """One range of rows: blocks, their extremes and their forward index."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, block: int):
        self.ids, self.rows, self.block = ids, rows, block
        starts = np.arange(0, len(ids), block)
        self.high, self.low = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)

    def best(self, own: int, vector: np.ndarray, reach: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """The k best (score, id), without the own id and what scores below
        ``least``: blocks by descending bound until one is below the k-th score."""
        order = np.argsort(-reach, kind="stable")
        scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, 1
        while at < len(order):
            taken = order[at:at + step]
            if least is not None:
                taken = taken[reach[taken] >= least]
                if not len(taken):
                    break
            where = (taken[:, None] * self.block + np.arange(self.block)).ravel()
            where = where[where < len(self.ids)]
            s, i = products(self.rows[where], vector), self.ids[where]
            keep = i != own if least is None else (i != own) & (s >= least)
            scores, ids = np.concatenate([scores, s[keep]]), np.concatenate([ids, i[keep]])
            if len(scores) > k:
                top = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[top], ids[top]
            if len(scores) == k:
                least = int(scores.min()) if least is None else max(least, int(scores.min()))
            at, step = at + step, 2 * step
        top = np.lexsort((ids, -scores))
        return list(zip(scores[top].tolist(), ids[top].tolist()))


def nearest_cell(pivots: np.ndarray) -> Column:
    """The pivot with the largest cosine (a seeded choice of cells; any choice is exact)."""
    @F.pandas_udf("int")
    def cell(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype="int32")
        rows = matrix([x[:pivots.shape[1]] for x in v], pivots.shape[1]).astype(np.float64)
        return pd.Series((rows @ pivots.T).argmax(axis=1).astype("int32"))
    return cell("v")


def top_k(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, every: int = 100, scale: int = 1024,
          block: int = 64, range_rows: int = 32768, pack_rows: int = 1024, packs_at_once: int = 32,
          sample_rows: int = 16384, max_cells: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by
    ``every``, the k rows of other ids with the largest inner product."""
    spark = df.sparkSession
    rows = whole_vectors(df, id_col, vec_col, scale)
    n, width = rows.agg(F.count("*"), F.greatest(F.max(F.size("v")), F.lit(1))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    # cells: pivots from a bounded sample (they decide the order of the rows, never a result)
    sample = [r.v for r in rows.sample(min(1.0, sample_rows / n), 7).limit(sample_rows).select("v").collect()]
    cells = max(1, min(max_cells, n // (block * 8), len(sample)))
    pivots = np.zeros((1, width))
    if sample:
        pivots = matrix(sample[:: max(1, len(sample) // cells)][:cells], width).astype(np.float64)
        pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-9)
    celled = rows.withColumn("cell", nearest_cell(pivots)).withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
    sizes = {r.cell: r["count"] for r in celled.groupBy("cell").count().collect()}  # at most max_cells rows
    # small cells share a range, a large one has several
    first, parts, used, room = {}, {}, 0, range_rows
    for c in sorted(sizes):
        if sizes[c] > range_rows // 2:
            parts[c], first[c] = -(-2 * sizes[c] // range_rows), used + (room < range_rows)
            used, room = first[c] + parts[c], range_rows
        else:
            if room < sizes[c]:
                used, room = used + 1, range_rows
            first[c], parts[c], room = used, 1, room - sizes[c]
    plan = spark.createDataFrame([(c, first[c], parts[c]) for c in sizes], "cell int, first int, parts int")
    dealt = celled.join(F.broadcast(plan), "cell").select(
        (F.col("first") + F.pmod("deal", F.col("parts"))).cast("int").alias("part"), "id", "v", "cell")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cell", "id"], kind="stable")
        ids, m = pdf["id"].to_numpy(np.int64), matrix(pdf["v"].to_list(), width)
        r = Range(ids, m, block)
        asks = np.flatnonzero(ids % every == 0)
        least = []
        for q, reach in zip(asks, bounds(m[asks], r.high, r.low)):
            got = r.best(int(ids[q]), m[q], reach, k, None)
            least.append(got[k - 1][0] if len(got) >= k else -2 ** 63)
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "ids": [ids.tobytes()], "rows": [pack(m)],
                             "high": [pack(m.max(axis=0))], "low": [pack(m.min(axis=0))],
                             "asks": [asks.tolist()], "least": [least]})

    index = cut(dealt.groupBy("part").applyInPandas(
        build, "part int, ids binary, rows binary, high binary, low binary, asks array<long>, least array<long>"))

    # the queries, with their k-th score in their own range, in packs
    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                at = np.asarray(r.asks, np.int64)
                ids, m = np.frombuffer(r.ids, np.int64), unpack(r.rows, width)
                for a in range(0, len(at), pack_rows):
                    p = at[a:a + pack_rows]
                    yield pd.DataFrame({"from_part": [r.part], "q_ids": [ids[p].tobytes()], "q_rows": [pack(m[p])],
                                        "q_least": [np.asarray(r.least, np.int64)[a:a + pack_rows].tobytes()]})

    packs = cut(index.select("part", "ids", "rows", "asks", "least").mapInPandas(
        asked, "from_part int, q_ids binary, q_rows binary, q_least binary")
        .withColumn("pack", F.monotonically_increasing_id()))
    if packs.isEmpty():
        return empty
    n_packs, n_ranges = packs.count(), index.count()
    groups, tens = -(-n_packs // packs_at_once), -(-n_ranges // 256)

    # which ranges a pack must see: extremes of up to 256 ranges against a pack
    ends = index.select((F.col("part") % tens).alias("ten"), "part", "high", "low")
    sought = packs.withColumn("ten", F.explode(F.sequence(F.lit(0), F.lit(tens - 1))))

    def routes(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in ("part", "team", "pack", "q_ids", "q_rows", "q_least", "at")})
        high = np.vstack([unpack(b, width) for b in left["high"]])
        low = np.vstack([unpack(b, width) for b in left["low"]])
        out = []
        for r in right.itertuples():
            q, least = unpack(r.q_rows, width), np.frombuffer(r.q_least, np.int64)
            q_ids = np.frombuffer(r.q_ids, np.int64)
            for part, reach in zip(left["part"], bounds(q, high, low).T):
                p = np.flatnonzero(reach >= least)
                if len(p):
                    out.append((part, r.team, r.pack, q_ids[p].tobytes(), pack(q[p]), least[p].tobytes(), p.tobytes()))
        return pd.DataFrame(out, columns=["part", "team", "pack", "q_ids", "q_rows", "q_least", "at"])

    wide = "part int, team int, pack long, q_ids binary, q_rows binary, q_least binary, at binary"
    team = F.pmod(F.xxhash64("pack"), F.lit(groups)).cast("int")
    visits = ends.withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).groupBy("ten", "team").cogroup(
        sought.withColumn("team", team).groupBy("ten", "team")).applyInPandas(routes, wide)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            r = Range(np.frombuffer(left["ids"].iloc[0], np.int64), unpack(left["rows"].iloc[0], width), block)
            for v in right.itertuples():
                q, least, q_ids = unpack(v.q_rows, width), np.frombuffer(v.q_least, np.int64), np.frombuffer(v.q_ids, np.int64)
                for i, (at, reach) in enumerate(zip(np.frombuffer(v.at, np.int64), bounds(q, r.high, r.low))):
                    for s, c in r.best(int(q_ids[i]), q[i], reach, k, int(least[i])):
                        out.append((v.pack, int(at), int(q_ids[i]), c, s))
        return pd.DataFrame(out, columns=["pack", "at", "query_id", "vec_id", "score"])

    found = index.select("part", "ids", "rows").withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))) \
        .groupBy("part", "team").cogroup(visits.groupBy("part", "team")) \
        .applyInPandas(search, "pack long, at long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("pack", "at").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
