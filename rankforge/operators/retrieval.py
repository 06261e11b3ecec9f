"""Two-tower vectors as tables, and the k best items of a whole catalogue for every user.

``tower_vectors`` evaluates a tower once per distinct user or item. ``top_items``
searches an inverted file: items lie in the cells of k-means centres (fitted on a
bounded sample), a cell knows its centre and the largest distance of its items
from it, so q . c + |q| r bounds the score of a query q in the cell. A query first
probes the ``probes`` cells of highest bound, which gives its k-th score, then
every other cell whose bound reaches it: the result is exact, and cells that
cannot hold a better item are not read. ``approximate = True`` leaves the second
part out.

Movement: every item once, into its cell (cells larger than ``cell_rows`` are dealt
to several rows); a query to the cells it probes, dealt to groups of about
``group_rows`` queries. Broadcast: centres and radii, at most ``max_cells`` rows.
No pair is emitted but the k best of a query and cell.

Null vectors, and null ids, take no part; equal scores (to nine digits) rank by id.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.models import dense_apply, dense_param
from rankforge.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---------------------------------------------------------------- M12 towers
def tower_vectors(rows: DataFrame, key: str, x: str, sizes, head: int, dense: dict | None = None, count: str | None = None,
                  eps: float = 1e-3, digits: int | None = None) -> DataFrame:
    """``key, vec``: relu layers without bias (numbers 1000 + 10 head + layer), each
    followed by batch normalisation with the mean and variance over all rows, a
    row counting ``count`` times (its number of samples). One pass a layer for
    the statistics, 2 * units numbers; ``digits`` rounds the vectors."""
    n = F.col(count).cast("double") if count else F.lit(1.0)
    out = cut_lineage(rows.select(key, F.col(x).alias("vec"), n.alias("_n")))
    for layer, (a, b) in enumerate(zip(sizes, sizes[1:])):
        w = dense_param(dense, 1000 + 10 * head + layer, a, b)
        h = dense_apply(F.col("vec"), a, lambda m, w=w: {"h": np.maximum(m @ w, 0.0)}, [("h", "vec")])["h"]
        out = cut_lineage(out.select(key, h.alias("vec"), "_n"))
        unit = [F.col("vec").getItem(u) for u in range(b)]
        first = out.agg(F.sum("_n").alias("n"), *(F.sum(F.col("_n") * u).alias(f"m{i}") for i, u in enumerate(unit))).first()
        if not first.n:
            break
        mean = [first[f"m{i}"] / first.n for i in range(b)]
        spread = out.agg(*(F.sum(F.col("_n") * (u - m) ** 2).alias(f"v{i}") for i, (u, m) in enumerate(zip(unit, mean)))).first()
        out = out.withColumn("vec", F.array(*((u - m) / float(np.sqrt(spread[f"v{i}"] / first.n + eps)) for i, (u, m) in enumerate(zip(unit, mean)))))
    if digits is not None:
        out = out.withColumn("vec", F.transform("vec", lambda v: F.round(v, digits)))
    return cut_lineage(out.select(key, "vec"))


# ---------------------------------------------------------------- O4 top-k over the catalogue
def centres(items: DataFrame, cells: int, sample_rows: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """k-means on at most ``sample_rows`` items (they decide which cells are read, never a result)."""
    n = items.count()
    sample = np.array([r.vec for r in items.sample(min(1.0, sample_rows / max(n, 1)), seed).select("vec").limit(sample_rows).collect()])
    if not len(sample):
        sample = np.array([r.vec for r in items.select("vec").limit(1).collect()])
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        near = (sample @ c.T - 0.5 * (c ** 2).sum(axis=1)).argmax(axis=1)
        sums, count = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, sample)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
    return c


def k_best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest scores of every row, largest first, equal ones by id."""
    least = np.partition(scores, -k, axis=1)[:, -k:].min(axis=1, keepdims=True) if len(ids) > k else -np.inf
    row, at = np.nonzero(scores >= least)
    order = np.lexsort((ids[at], -scores[row, at], row))
    row, at = row[order], at[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], at[kept]


def top_items(users: DataFrame, items: DataFrame, k: int, user_col: str = "uid", item_col: str = "touid", probes: int = 4,
              approximate: bool = False, max_cells: int = 1024, cell_rows: int = 16384, group_rows: int = 16384,
              sample_rows: int = 32768) -> DataFrame:
    """``user_col, rank, item_col, score``: the k items with the largest inner product for every user (``vec`` on both sides)."""
    spark = users.sparkSession
    items = cut_lineage(items.where(F.col(item_col).isNotNull() & F.col("vec").isNotNull()).select(F.col(item_col).alias("item"), "vec"))
    users = cut_lineage(users.where(F.col(user_col).isNotNull() & F.col("vec").isNotNull()).select(F.col(user_col).alias("user"), "vec"))
    user_type, item_type = dict(users.dtypes)["user"], dict(items.dtypes)["item"]
    n_items, n_users = items.count(), users.count()
    if not n_items or not n_users:
        return spark.createDataFrame([], f"{user_col} {user_type}, rank long, {item_col} {item_type}, score double")
    c = centres(items, int(max(1, min(max_cells, np.sqrt(n_items)))), sample_rows)

    @F.pandas_udf("struct<cell: int, away: double>")
    def place(v: pd.Series) -> pd.DataFrame:
        x = np.vstack(v.to_list()) if len(v) else np.zeros((0, c.shape[1]))
        near = (x @ c.T - 0.5 * (c ** 2).sum(axis=1)).argmax(axis=1)
        return pd.DataFrame({"cell": near.astype("int32"), "away": np.sqrt(((x - c[near]) ** 2).sum(axis=1))})

    placed = cut_lineage(items.withColumn("at", place("vec")).select("item", "vec", "at.cell", "at.away"))
    size = {r.cell: (r.n, r.far) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("far")).collect()}
    parts = spark.createDataFrame([(cell, -(-n // cell_rows)) for cell, (n, _) in size.items()], "cell int, parts int")
    part = F.pmod(F.xxhash64("item"), F.col("parts")).cast("int")
    groups = -(-n_users // group_rows)
    lists = placed.join(F.broadcast(parts), "cell").withColumn("part", part).withColumn(
        "team", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select("cell", "part", "team", "item", "vec")
    used = np.array(sorted(size))
    far, middle = np.array([size[i][1] for i in used]), c[used]
    n_parts = np.array([-(-size[i][0] // cell_rows) for i in used.tolist()])

    def routes(second: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                q = np.vstack(b["vec"].to_list()) if len(b) else np.zeros((0, middle.shape[1]))
                reach = q @ middle.T + np.linalg.norm(q, axis=1, keepdims=True) * far * (1 + 1e-9) + 1e-9
                order = np.argsort(-reach, axis=1, kind="stable")
                asked = np.ones(order[:, :probes].shape, bool)
                if second:
                    order = order[:, probes:]
                    asked = np.take_along_axis(reach, order, axis=1) >= b["least"].to_numpy()[:, None]
                row, at = np.nonzero(asked)
                cell = order[row, at]
                row, cell = np.repeat(row, n_parts[cell]), np.repeat(cell, n_parts[cell])
                first = np.flatnonzero(np.diff(cell, prepend=-1) | np.diff(row, prepend=-1))
                number = np.arange(len(row)) - np.repeat(first, np.diff(first, append=len(row)))
                for a in range(0, len(row), 10_000):
                    r = row[a:a + 10_000]
                    yield pd.DataFrame({"cell": used[cell[a:a + 10_000]], "part": number[a:a + 10_000], "user": b["user"].to_numpy()[r],
                                        "vec": b["vec"].to_numpy()[r]})
        return run

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"user": right["user"][:0], "item": left["item"][:0], "score": pd.Series([], dtype=float)})
        m, ids = np.vstack(left["vec"].to_list()), left["item"].to_numpy()
        out = []
        for a in range(0, len(right), 256):
            part = right.iloc[a:a + 256]
            scores = np.round(np.vstack(part["vec"].to_list()) @ m.T, 9)
            row, at = k_best(scores, ids, k)
            out.append(pd.DataFrame({"user": part["user"].to_numpy()[row], "item": ids[at], "score": scores[row, at]}))
        return pd.concat(out)

    team = F.pmod(F.xxhash64("user"), F.lit(groups)).cast("int")
    sent = f"cell int, part int, user {user_type}, vec array<double>"

    def probe(rows: DataFrame, second: bool) -> DataFrame:
        asked = rows.mapInPandas(routes(second), sent).withColumn("team", team)
        return lists.groupBy("cell", "part", "team").cogroup(asked.groupBy("cell", "part", "team")) \
            .applyInPandas(best, f"user {user_type}, item {item_type}, score double")

    found = cut_lineage(probe(users, False))
    if not approximate and len(used) > probes:
        order = Window.partitionBy("user").orderBy(F.desc("score"), "item")
        least = found.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select("user", F.col("score").alias("least"))
        rest = users.join(least, "user", "left").fillna(-float("inf"), ["least"])
        found = found.unionByName(probe(rest, True))
    rank = F.row_number().over(Window.partitionBy("user").orderBy(F.desc("score"), "item"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("user").alias(user_col), F.col("rank").cast("long").alias("rank"), F.col("item").alias(item_col), "score")
