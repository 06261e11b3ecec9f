"""Ranked lexical search with geometric blocks per term.

One pass over the texts counts, per document, all its terms and the frequencies
of those that some item asks for (the forward index, written once). Documents
are then taken in segments of at most ``segment_docs`` rows. In a segment every
term has a posting list; the list is clustered by document similarity (nearest
of a few of its own documents, by random projections of the impact vectors) and
cut into blocks of at most ``block`` documents. A block's summary holds, for
every term that occurs in an item together with the block's term, the largest
impact of any of its documents. The inner product of an item with a summary is
an exact upper bound of the block's scores.

An item visits the blocks of its terms by descending bound, scores their
documents by the forward index, and stops at the first block whose bound is
below its k-th score so far; that score is carried through all segments of a
task. The best of the tasks (at most k an item and task) are ranked at the end.

Bounds on memory: a task holds one segment; the items come in batches of at most
about ``batch_entries`` (item, term) entries, each broadcast and searched by
itself, so any number of items is answered. The texts are not shuffled.

Score: a term's weight w is floor(1000 ln((2N + 2) / (2 df + 1))), its impact on a
document w * (10^9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L; an item adds the
impacts of its terms, repeats included (64-bit integers).

Edge cases: null or empty texts have no terms and are never found; an item
without terms, or whose terms occur nowhere or weigh nothing, has no rows; every
row of the items is an item and every row of the documents a document, also
repeated ones; equal scores rank by doc_id, null last; no items or no documents give
no rows. Texts of any length are read whole. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import cut

#: Bytes of no term become spaces, A-Z become a-z; bytes from 0x80 belong to terms.
_FOLD = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else
              b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


#: The same in SQL functions, for the vocabulary of the items.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs that begin at ``starts`` and are ``sizes`` long, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def item_batches(items: DataFrame, id_col: str, text_col: str, entries: int) -> Iterator[list[tuple]]:
    """The items as (id, {term: number}), in batches of about ``entries`` distinct terms an item."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = F.size(F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(TERM), F.lit(0))))
    total = rows.agg(F.sum(size)).first()[0] or 0
    n = -(-total // entries)
    for i in range(n):
        batch = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).collect()
        counted = [(r.id, Counter(terms_of(r.text))) for r in batch]
        if counted := [(i, c) for i, c in counted if c]:
            yield counted


def forward_index(docs: DataFrame, number: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: number of terms of a document, and the sorted
    numbers and frequencies of its terms in the vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.value.get
        for b in batches:
            sizes, n, terms, tfs = [], [], [], []
            for t in b.column(1).to_pylist():
                words = terms_of(t)
                ids = np.fromiter((i for i in map(get, words) if i is not None), np.int32)
                own, tf = np.unique(ids, return_counts=True)
                n.append(len(words))
                sizes.append(len(own))
                terms.append(own)
                tfs.append(tf)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else [], k))
                     for x, k in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


class Items:
    """The items of a batch over the numbered vocabulary, and which terms occur together."""

    def __init__(self, items: list[tuple], number: dict[bytes, int]):
        self.ids = [i for i, _ in items]
        self.terms = [np.array(sorted(number[t] for t in c), np.int64) for _, c in items]
        name = {n: t for t, n in number.items()}
        self.times = [np.array([c[name[t]] for t in ts.tolist()], np.int64) for (_, c), ts in zip(items, self.terms)]
        together: dict[int, set[int]] = {}
        for ts in self.terms:
            for t in ts.tolist():
                together.setdefault(t, set()).update(ts.tolist())
        #: term -> the coordinates of its summaries
        self.together = {t: np.array(sorted(x), np.int64) for t, x in together.items()}


class Segment:
    """Blocks, summaries and forward index of some documents."""

    def __init__(self, ids: list, indptr: np.ndarray, terms: np.ndarray, impacts: np.ndarray, items: Items,
                 n_terms: int, block: int, seed: int = 11, rays: int = 16):
        self.ids, self.indptr, self.terms, self.impacts, self.n_terms = ids, indptr, terms, impacts, n_terms
        sizes = np.diff(indptr)
        doc = np.repeat(np.arange(len(ids)), sizes)
        rng = np.random.default_rng(seed)
        ray = rng.standard_normal((n_terms, rays)).astype(np.float32)
        sketch = np.zeros((len(ids), rays), np.float32)
        for r in range(rays):
            sketch[:, r] = np.bincount(doc, weights=ray[terms, r] * impacts, minlength=len(ids))
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        order = np.argsort(terms, kind="stable")
        lists, begin = doc[order], np.searchsorted(terms[order], np.arange(n_terms + 1))
        column = np.full(n_terms, -1)
        #: term -> (documents in the order of their blocks, bounds of the blocks, summaries by coordinate)
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for t, together in items.together.items():
            docs = lists[begin[t]:begin[t + 1]]
            if not len(docs):
                continue
            if len(docs) > block:  # nearest of a few documents of the list
                heads = rng.choice(docs, -(-len(docs) // block), replace=False)
                near = (sketch[docs] @ sketch[heads].T).argmax(axis=1)
                by = np.argsort(near, kind="stable")
                docs, near = docs[by], near[by]
                run = np.searchsorted(near, near)  # a large cluster is cut into blocks of its own
                cell = near * (len(docs) // block + 2) + (np.arange(len(docs)) - run) // block
                firsts = np.flatnonzero(np.diff(cell, prepend=-1))
            else:
                firsts = np.zeros(1, np.int64)
            which = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(docs))))
            column[together] = np.arange(len(together))
            at = spread(indptr[docs], sizes[docs])
            col = column[terms[at]]
            fits = col >= 0
            summary = np.zeros((len(firsts), len(together)), np.int64)
            np.maximum.at(summary.reshape(-1), (np.repeat(which, sizes[docs])[fits] * len(together) + col[fits]), impacts[at[fits]])
            column[together] = -1
            self.blocks[t] = docs, np.append(firsts, len(docs)), summary

    def search(self, items: Items, i: int, best: list[tuple], k: int) -> list[tuple]:
        """The k best (score, doc_id) of ``best`` and this segment, for item i."""
        terms, times = items.terms[i], items.times[i]
        reach, where = [], []
        for t in terms.tolist():
            if t in self.blocks:
                docs, firsts, summary = self.blocks[t]
                reach.append(summary[:, np.searchsorted(items.together[t], terms)] @ times)
                where += [(docs, a, b) for a, b in zip(firsts.tolist(), firsts[1:].tolist())]
        if not reach:
            return best
        reach = np.concatenate(reach)
        weight = np.zeros(self.n_terms, np.int64)
        weight[terms] = times
        seen = np.zeros(len(self.ids), bool)
        order = np.argsort(-reach, kind="stable")
        at, step = 0, 4
        while at < len(order):
            least = best[-1][0] if len(best) == k else 1
            taken = [b for b in order[at:at + step].tolist() if reach[b] >= least]
            if not taken:
                break
            docs = np.unique(np.concatenate([where[b][0][where[b][1]:where[b][2]] for b in taken]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            n = self.indptr[docs + 1] - self.indptr[docs]
            entries = spread(self.indptr[docs], n)
            sums = np.concatenate([[0], np.cumsum(weight[self.terms[entries]] * self.impacts[entries])])
            ends = np.cumsum(n)
            scores = sums[ends] - sums[ends - n]
            good = np.flatnonzero(scores >= least)
            if len(good) > 4 * k:  # keep the ties of the k-th score
                good = good[scores[good] >= np.partition(scores[good], -k)[-k]]
            best = ranked(best + [(int(scores[g]), self.ids[docs[g]]) for g in good.tolist()], k)
            at, step = at + step, 2 * step
        return best


def ranked(found: list[tuple], k: int) -> list[tuple]:
    """The k first by descending score, then by id, null ids last."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", segment_docs: int = 8192, block: int = 64,
           batch_entries: int = 1_000_000) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents that score highest for every item, if above 0."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    kinds = items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    for batch in item_batches(items, item_col, item_text, batch_entries):
        number = {t: i for i, t in enumerate(sorted({t for _, c in batch for t in c}))}
        index = cut(forward_index(docs, sc.broadcast(number), id_col, text_col))
        total = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        n_docs, n_all = total[0], total[1] or 0
        if not n_docs:
            continue
        df = {r.t: r["count"] for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(number))], np.int64)
        asked = sc.broadcast((Items(batch, number), weights))

        def run(batches: Iterator[pa.RecordBatch], asked=asked, n_docs=n_docs, n_all=n_all) -> Iterator[pa.RecordBatch]:
            own, weights = asked.value
            best: list[list[tuple]] = [[] for _ in own.ids]
            for b in batches:
                for a in range(0, b.num_rows, segment_docs):
                    part = b.slice(a, segment_docs)
                    terms, tfs = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs"))
                    sizes = part.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                    m = np.array([25 + 75 * n * n_docs // n_all for n in part.column("n").to_pylist()], np.int64)
                    impacts = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, sizes)))
                    segment = Segment(part.column("doc_id").to_pylist(), np.concatenate([[0], np.cumsum(sizes)]), terms, impacts,
                                      own, len(weights), block)
                    for i in range(len(best)):
                        best[i] = segment.search(own, i, best[i], k)
            rows = [(i, *x) for i, found in enumerate(best) for x in found]
            if rows:
                at, score, doc = (list(x) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, pa_kind)], names=["at", "score", "doc_id"])

        pa_kind = pa.string() if kinds[1] == "string" else pa.int32() if kinds[1] == "int" else pa.int64()
        found = index.filter(F.size("terms") > 0).mapInArrow(run, f"at int, score long, doc_id {kinds[1]}")
        rank = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(batch)], f"at int, item_id {kinds[0]}")
        out = out.unionByName(found.withColumn("rank", rank).filter(F.col("rank") <= k).join(F.broadcast(names), "at")
                              .select("item_id", "rank", "doc_id", "score"))
    return out
