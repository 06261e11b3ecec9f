"""N-gram Jaccard join by a prefix tree.

Every document becomes its set of word n-grams, as ascending 64-bit hashes. Documents with equal sets are one class. Classes link
when ``100 * |A n B| >= threshold * |A u B|``.

1. *Blocks.* Two linked sets of sizes a, b differ in at most
   ``k = (a + b)(100 - t) / (100 + t)`` n-grams. The hash range is cut into
   more than k segments (per size level), so linked sets agree on a whole
   segment. Only one 64-bit digest per segment is shuffled, about t% less than
   the n-grams themselves. Classes that share blocks form a cluster.
2. *Trie.* Every cluster of at most ``block_tokens`` n-grams is searched in one
   task by a radix trie of its sets. One order of n-grams, by hash, holds for the
   whole table: rare-first order would need the frequency of every n-gram. A
   traversal, level by level, shares the overlap of common prefixes and leaves a
   subtree when overlap so far plus the shorter remainder cannot reach the
   required overlap, or when it holds only sets that are connected already.
3. *Larger clusters.* In each of their blocks every class is first compared with
   the block's smallest class, which joins large groups of copies in time linear
   in their size. Blocks still in several components go to the trie as well; a
   cluster of them with more than ``block_tokens`` n-grams is cut into
   chunks, one task for each pair of chunks, so no task holds an unbounded
   cluster and no pair is missed.

Nothing is capped or sampled. Equality of 64-bit hashes stands for equality of
n-grams (within a pair of documents of 10^4 n-grams, an error has probability
below 10^-11), equality of 128-bit digests for that of whole sets.

Edge cases: null, empty or blank text gives an empty set (0 n-grams), linked
with nothing; with fewer than n words the whole sequence is the only n-gram;
repeated rows are one class and come back as often as given; a null doc_id is
returned with the component of its class; an empty table gives an empty
result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import connected_components, cut, every_share, mix64, share

#: Odd multipliers of the words of an n-gram, from the golden ratio.
_GOLD = 0x9E3779B97F4A7C15


class Shingler:
    """Text -> ascending distinct n-gram hashes. Nothing is kept between calls:
    hashing a word again costs less than looking it up."""

    def __init__(self, n: int):
        self.n = n

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        width = min(self.n, len(h))
        out = np.full(len(h) - width + 1, width, np.uint64)
        for i in range(width):
            out += mix64(h[i: len(h) - width + 1 + i] + np.uint64((_GOLD * (2 * i + 1)) & (2**64 - 1)))
        return np.unique(mix64(out))


def levels(threshold: int, top: int, ratio: float = 1.3) -> tuple[list[int], list[int], list[int]]:
    """Of each size level up to ``top``: its lower bound, the most n-grams in
    which a pair may differ, and the number of hash segments, so many that even
    the smallest set nearly always fills more of them. A pair belongs to the
    level of its smaller set."""
    if not 70 <= threshold <= 100:
        raise ValueError("threshold must be between 70 and 100 (%)")
    lows, differ, segments = [1], [], []
    while True:
        following = max(lows[-1] + 1, int(np.ceil(lows[-1] * ratio)))
        a = following - 1
        k = (a + 100 * a // threshold) * (100 - threshold) // (100 + threshold)
        n = k + 1
        while k and n < 4 * k + 8:
            empty = np.exp(-lows[-1] / n)
            if n * (1 - empty) - 3 * np.sqrt(n * empty * (1 - empty)) >= k + 1:
                break
            n += 1 + k // 100
        differ.append(k)
        segments.append(n if k else 0)
        if following > top:
            return lows, differ, segments
        lows.append(following)


def segment_digests(h: np.ndarray, threshold: int, lows: list[int], differ: list[int],
                    segments: list[int]) -> list[np.ndarray]:
    """Digests of a set's hash segments, at its level and at each lower level
    that a partner may be in. Levels where linked sets are equal give
    none. Linked sets agree on n - k segments or more; if so many are empty, the
    set is cut again under the next seed, and so is any partner it shares no
    other segment with."""
    out: list[np.ndarray] = []
    size = len(h)
    home = int(np.searchsorted(lows, size, "right")) - 1
    least = -(-size * threshold // 100)
    for level in range(home, -1, -1):
        if level < home and least >= lows[level + 1]:
            break
        if not segments[level]:
            continue
        n, seed, at = segments[level], 0, h
        while True:
            seg = ((at >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            starts = np.flatnonzero(np.diff(seg, prepend=np.uint64(n)))
            sums = np.add.reduceat(mix64(at), starts)
            out.append(mix64(sums + mix64(seg[starts] * np.uint64(_GOLD)
                                          + np.uint64(level * 1_000_003 + seed))))
            if len(starts) > differ[level]:
                break
            seed += 1
            at = np.sort(mix64(h + np.uint64(seed)))
    return out


#: Largest set size that the levels cover.
_TOP = 1 << 34
#: Hash cells of doc_ids in the prefilter of texts: the most rows it broadcasts.
_CELLS = 1 << 20


def document_sets(docs: DataFrame, n: int, threshold: int, with_sets: bool) -> DataFrame:
    """``(doc_id, n_shingles, key, sigs)`` or, with sets, ``(key, n_shingles,
    grams)``; key is a 128-bit digest of the set, null for an empty set."""
    sizes = levels(threshold, _TOP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        none = np.empty(0, np.uint64)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingle(t) for t in part.column("text").to_pylist()]
                size = pa.array([len(s) for s in sets], pa.int64())
                key = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
                lists = sets if with_sets else [
                    np.concatenate(segment_digests(s, threshold, *sizes) or [none]) if len(s) else none
                    for s in sets]
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                flat = pa.array(np.concatenate([none, *lists]).view(np.int64))
                col = pa.ListArray.from_arrays(pa.array(ends), flat)
                first = [] if with_sets else [part.column("doc_id")]
                yield pa.RecordBatch.from_arrays(
                    [*first, size, key, col],
                    names=[*([] if with_sets else ["doc_id"]), "n_shingles", "key", "grams" if with_sets else "sigs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = "n_shingles long, key binary, grams array<long>" if with_sets else \
        f"doc_id {kind}, n_shingles long, key binary, sigs array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Trie:
    """Radix trie over lexicographically sorted id arrays, as flat arrays: a
    node holds the sets lo..hi, the tokens start..end of any of them, and the
    smallest and largest size below it; its children are numbered in a row.
    The sets lo..ends end at the node."""

    def __init__(self, sets: list[np.ndarray]):
        self.offset = np.cumsum([0, *map(len, sets)])
        self.flat = np.concatenate(sets)
        sizes = np.diff(self.offset)
        shared = np.zeros(len(sets) + 1, np.int64)
        for i in range(1, len(sets)):
            a, b = sets[i - 1], sets[i]
            n = min(len(a), len(b))
            differs = a[:n] != b[:n]
            shared[i] = int(differs.argmax()) if differs.any() else n
        rows, at = [[0, len(sets), 0]], 0
        while at < len(rows):
            lo, hi, start = rows[at]
            end = int(sizes[lo]) if hi - lo == 1 else int(shared[lo + 1:hi].min())
            ends = lo
            while ends < hi and sizes[ends] == end:
                ends += 1
            first = len(rows)
            splits = [ends, *(ends + 1 + np.flatnonzero(shared[ends + 1:hi] <= end)).tolist(), hi]
            rows += [[a, b, end] for a, b in zip(splits, splits[1:]) if a < b]
            rows[at] += [end, ends, int(sizes[lo:hi].min()), int(sizes[lo:hi].max()), first, len(rows) - first]
            at += 1
        self.lo, self.hi, self.start, self.end, self.ends, self.small, self.large, self.first, self.children = \
            np.array(rows, np.int64).T
        self.begin = self.offset[self.lo] + self.start
        self.last = self.flat[np.maximum(self.offset[self.lo] + self.end - 1, 0)]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] numbers), starts[1], ..."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def trie_links(sets: list[np.ndarray], group: list[int], threshold: int,
               side: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect sets of different ``group``; enough of them that
    linked sets end connected. With ``side``, only pairs of different sides are
    compared. The sets are ascending, in the order of hashes that holds for all."""
    ids, dense = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.cumsum([0, *map(len, sets)])
    ranked = [dense[a:b] for a, b in zip(bounds, bounds[1:])]
    order = sorted(range(len(ranked)), key=lambda i: ranked[i].astype(">u4").tobytes())
    ranked = [ranked[i] for i in order]
    root = np.array(group, np.int64)[order]
    part = np.arange(len(order)) if side is None else np.array(side)[order]
    t, links = Trie(ranked), []
    held = np.zeros(len(ids), bool)

    def need(a, b):
        return -(-threshold * (a + b) // (100 + threshold))

    for q, x in enumerate(ranked):
        # sets up to each place that are not connected with this one
        apart = np.concatenate([[0], np.cumsum((root != root[q]) & (part != part[q]))])
        if apart[-1] == apart[q + 1]:
            continue
        held[x] = True
        size = len(x)
        node, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(node):
            lo, hi = t.lo[node], t.hi[node]
            keep = (t.large[node] * 100 >= threshold * size) & (size * 100 >= threshold * t.small[node]) \
                & (apart[hi] > apart[np.minimum(np.maximum(lo, q + 1), hi)])
            node, overlap = node[keep], overlap[keep]
            lengths = t.end[node] - t.start[node]
            found = np.concatenate([[0], np.cumsum(held[t.flat[ranges(t.begin[node], lengths)]])])
            ends = np.cumsum(lengths)
            overlap = overlap + found[ends] - found[ends - lengths]
            left = size - np.searchsorted(x, t.last[node], "right")
            left[t.end[node] == 0] = size
            keep = overlap + np.minimum(left, t.large[node] - t.end[node]) >= need(size, t.small[node])
            node, overlap = node[keep], overlap[keep]
            done = (t.ends[node] > t.lo[node]) & (overlap >= need(size, t.end[node]))
            for at in node[done].tolist():
                for y in range(max(t.lo[at], q + 1), t.ends[at]):
                    if root[y] != root[q] and part[y] != part[q]:
                        links.append((order[q], order[y]))
                        root[root == root[y]] = root[q]
            overlap = np.repeat(overlap, t.children[node])
            node = ranges(t.first[node], t.children[node])
        held[x] = False
    return links


def ngram_components(docs: DataFrame, n: int = 5, threshold: int = 80,
                     block_tokens: int = 400_000) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id,
    text)``: size of its n-gram set and the smallest doc_id linked to it,
    directly or through others, at a Jaccard similarity of ``threshold`` %."""
    sized = cut(document_sets(docs, n, threshold, with_sets=False))
    # the checkpoint fixes the class numbers
    classes = cut(sized.filter("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sigs").alias("sigs"),
        F.count("*").alias("rows")).withColumn("id", F.monotonically_increasing_id()))
    stars = cut(block_stars(classes))
    grams = cut(members(docs, classes, stars, n, threshold, block_tokens))
    links = tree_links(grams, threshold).union(large_links(grams, stars, threshold, block_tokens))

    linked = cut(classes.select("id", "key", "rep").join(
        connected_components(links).withColumnRenamed("node", "id"), "id"))
    least = linked.groupBy("component").agg(F.min("rep").alias("component_id")).withColumn("share", every_share())
    named = linked.withColumn("share", share("id")).join(least, ["component", "share"]).select("key", "component_id")
    copies = classes.filter("rows > 1").select("key", F.col("rep").alias("component_id")).join(named, "key", "left_anti")
    label = named.union(copies).withColumn("share", every_share())
    return sized.select("doc_id", "n_shingles", "key").withColumn("share", share("doc_id")) \
        .join(label, ["key", "share"], "left").select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def block_stars(classes: DataFrame) -> DataFrame:
    """``(sig, id, leader)``: blocks of several classes, each class but the
    smallest, the leader, beside it."""
    blocks = classes.select("id", F.explode("sigs").alias("sig"))
    shared = blocks.groupBy("sig").agg(F.min("id").alias("leader"), F.max("id").alias("top")) \
        .filter("leader <> top").select("sig", "leader")
    return blocks.join(shared, "sig").filter("id <> leader").select("sig", "id", "leader")


def members(docs: DataFrame, classes: DataFrame, stars: DataFrame, n: int, threshold: int,
            block_tokens: int) -> DataFrame:
    """``(id, cluster, large, n_shingles, grams)`` of the classes in blocks;
    ``large`` if the cluster has more than ``block_tokens`` n-grams."""
    cluster = connected_components(stars.select(F.col("id").alias("u"), F.col("leader").alias("v"))) \
        .select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    placed = cut(classes.select("id", "key", "rep", "n_shingles").join(cluster, "id"))
    large = placed.groupBy("cluster").agg((F.sum("n_shingles") > block_tokens).alias("large"))
    reps = placed.select("rep").distinct()
    # most texts are in no block: a broadcast of at most _CELLS cell numbers keeps them out of the exchange
    cell = lambda col: F.pmod(F.xxhash64(col), F.lit(_CELLS))
    cells = reps.select(cell("rep").alias("cell")).distinct()
    texts = docs.select("doc_id", "text").join(F.broadcast(cells), cell("doc_id") == F.col("cell"), "left_semi") \
        .join(reps, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    return document_sets(texts, n, threshold, with_sets=True).join(
        placed.join(large, "cluster").select("key", "id", "cluster", "large"), "key") \
        .dropDuplicates(["id"]).select("id", "cluster", "large", "n_shingles", "grams")


def _settle(pdf: pd.DataFrame, threshold: int, group: list[int], side: list[int] | None) -> pd.DataFrame:
    found = trie_links([np.asarray(g, np.int64).view(np.uint64) for g in pdf["grams"]], group, threshold, side)
    ids = pdf["id"].to_numpy()
    return pd.DataFrame({"u": ids[[a for a, _ in found]], "v": ids[[b for _, b in found]]})


def tree_links(grams: DataFrame, threshold: int) -> DataFrame:
    """Links that connect what links in the clusters that are not large."""
    return grams.filter("not large").select("cluster", "id", "grams").groupBy("cluster").applyInPandas(
        lambda pdf: _settle(pdf, threshold, list(range(len(pdf))), None), "u long, v long")


def large_links(grams: DataFrame, stars: DataFrame, threshold: int, block_tokens: int) -> DataFrame:
    """Links that connect what links in the large clusters."""
    grams = grams.filter("large")
    stars = cut(stars.join(grams.select("id"), "id", "left_semi"))
    other = grams.select(F.col("id").alias("leader"), F.col("grams").alias("led"), F.col("n_shingles").alias("n_led"))
    both = F.size(F.array_intersect("grams", "led")).cast("long")
    total = F.col("n_shingles") + F.col("n_led")
    first = cut(stars.select("id", "leader").distinct().join(grams, "id").join(other, "leader")
                .filter(F.col("n_shingles") * 100 >= F.col("n_led") * threshold)
                .filter(F.col("n_led") * 100 >= F.col("n_shingles") * threshold)
                .filter(both * 100 >= (total - both) * threshold)
                .select(F.col("id").alias("u"), F.col("leader").alias("v")))
    known = cut(connected_components(first))

    member = stars.select("sig", "id", "leader").union(
        stars.select("sig", F.col("leader").alias("id"), "leader").distinct())
    named = (member.join(known.withColumnRenamed("node", "id"), "id", "left")
             .withColumn("comp", F.coalesce("component", "id")))
    open_blocks = named.groupBy("sig").agg(F.min("comp").alias("a"), F.max("comp").alias("b")) \
        .filter("a <> b").select("sig")
    left = cut(named.join(open_blocks, "sig", "left_semi"))

    cluster = cut(connected_components(left.select(F.col("id").alias("u"), F.col("leader").alias("v"))))
    rows = cut(left.select("id", "comp").distinct()
               .join(cluster.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "id")
               .join(grams.select("id", "n_shingles"), "id"))
    spread = rows.groupBy("cluster").agg(
        F.ceil(F.sum("n_shingles") / F.lit(block_tokens)).cast("int").alias("chunks"))
    placed = (rows.join(spread, "cluster")
              .withColumn("chunk", F.pmod(F.hash("id"), F.col("chunks")))
              .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select("cluster", "id", "comp", "chunk",
                      F.least("chunk", "mate").alias("i"), F.greatest("chunk", "mate").alias("j"))
              .join(grams.select("id", "grams"), "id"))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        cross = pdf["i"].iloc[0] != pdf["j"].iloc[0]
        return _settle(pdf, threshold, pd.factorize(pdf["comp"])[0].tolist(), pdf["chunk"].tolist() if cross else None)

    return first.union(placed.groupBy("cluster", "i", "j").applyInPandas(settle, "u long, v long"))
