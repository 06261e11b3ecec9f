"""Prefix trie of conversations by van Emde Boas recursion on depth.

Names. A sequence is cut at half its (power of two) height: the content of an
upper half, named by a digest, and the name of what precedes it give the name
of the cut prefix, which is the root of a lower forest; upper tries and lower
forests are then cut in the same way, all those of one height in one pass. After
log2(height) passes every turn has the name of the prefix that it ends, i.e. its
node. Passes over tall blocks touch only conversations that are that long.

Totals. A node's totals first cover the node alone, then its block of depths of
height 1, 2, 4, ...: when an upper block meets the lower one, the totals of the
lower forest's roots are grafted onto the cut node they hang from and onto the
ancestors of that node within the upper block. A pass adds at most one row per
turn, so the work is the number of turns times log2(height), whatever the depth.

Skew: turns are numbered from one global order (conversation, turn), so a huge
conversation is spread over tasks; nodes are counted with map-side partial
aggregates; the at most ``hot_nodes`` nodes that hold more than that fraction of
all turns are looked up by broadcast (that bound is proven: a turn is in one
node), all others by a join. The ids of a node's finished conversations are
joined in ordered chunks, and one pass over the chunks digests them. Names are
128-bit digests; texts are digested in place and never shuffled.

Edge cases: rows without conv_id take no part; null role or text counts as empty;
a null turn comes first, equal turns are ordered by role, then text; a conversation
may be rebuilt from no turns (it ends in the root); an empty table has no nodes;
repeated rows are turns of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import cut

EMPTY = sha256(b"").hexdigest()


def name(before: Column, content: Column) -> Column:
    return F.md5(F.concat(before, content))


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, pos, content, size``: the turns of every conversation in order
    from 1, the digest of role and text, and the code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    thin = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, 64).alias("head"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("content"), F.length(text).cast("long").alias("size"))
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("head"), F.col("content")]
    placed = cut(thin.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "content", "size", F.monotonically_increasing_id().alias("at")).withColumn("part", F.shiftright("at", 33)))
    runs = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("conv_id", "part", "first", before.alias("before"))
    return placed.join(runs, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "content", "size")


def unsplit(turns: DataFrame) -> DataFrame:
    """Number of turns per conversation."""
    return turns.groupBy("conv_id").agg(F.max("pos").alias("n"))


def rebuilt(turns: DataFrame, shared: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation from the first ``shared`` (at most ``most``) turns of
    conversation ``base`` and its own turns after its first ``shared``:
    ``conv_id, depth, content, size`` and ``conv_id, n``."""
    own = unsplit(turns)
    heads = own.select(F.col("conv_id").alias("b"), F.least("n", F.lit(most)).alias("has"))
    convs = own.withColumn("h", shared.cast("long")).withColumn("b", base).join(heads, "b", "left") \
        .select("conv_id", "b", "h", "n", F.least("h", F.coalesce("has", F.lit(0))).alias("taken"))
    first = turns.filter(F.col("pos") <= most).withColumnRenamed("conv_id", "b")
    lent = convs.filter("taken > 0").select("conv_id", "b", "taken").join(first, "b").filter("pos <= taken") \
        .select("conv_id", F.col("pos").alias("depth"), "content", "size")
    kept = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("pos > h") \
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "content", "size")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return lent.unionByName(kept), lengths


def prefix_names(turns: DataFrame, lengths: DataFrame, height: int) -> DataFrame:
    """``turns`` (conv_id, depth, content, size) plus ``node``, the name of the
    prefix that ends with the turn."""
    levels = []  # contents of aligned blocks of 2^i turns that have a right neighbour
    blocks = turns.select("conv_id", (F.col("depth") - 1).alias("j"), "content")
    for i in range(height):
        if i:
            blocks = cut(blocks.groupBy("conv_id", F.shiftright("j", 1).alias("j")).agg(
                F.md5(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("j", "content"))), lambda x: x["content"]))).alias("content")))
        levels.append(blocks)
        tall = lengths.filter(F.col("n") > 2 ** (i + 1)).select("conv_id")
        if i + 1 < height:
            blocks = blocks.join(tall, "conv_id", "left_semi")
    # names of what precedes each block, from the tallest blocks down
    before = lengths.filter("n > 0").select("conv_id", F.lit(0).cast("long").alias("j"), F.md5(F.lit("")).alias("before"), "n")
    for i in reversed(range(height)):
        upper = before.withColumn("j", F.col("j") * 2)
        halved = F.col("n") > (F.col("j") + 1) * 2 ** i
        lower = upper.filter(halved).join(levels[i], ["conv_id", "j"]).select(
            "conv_id", (F.col("j") + 1).alias("j"), name(F.col("before"), F.col("content")).alias("before"), "n")
        before = cut(upper.unionByName(lower))
    return turns.join(before.select("conv_id", (F.col("j") + 1).alias("depth"), "before"), ["conv_id", "depth"]) \
        .select("conv_id", "depth", "size", name(F.concat("before", F.lit("/")), F.col("content")).alias("node"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """``ends`` (conv_id, node) -> ``node, ends_sha256``: digest of the ascending
    ids, joined by commas. Chunks of ids are joined in the global order (node,
    conv_id); a node's chunks are then digested as they come."""
    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            runs = (b["node"] != b["node"].shift()).cumsum()
            got = b.assign(text=b["conv_id"].astype(str)).groupby(runs, sort=False).agg(
                node=("node", "first"), first=("conv_id", "first"), ids=("text", ",".join))
            yield got.reset_index(drop=True)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, h = None, None
        for b in batches:
            out = []
            for r in b.itertuples():
                if r.node != node:
                    if node is not None:
                        out.append((node, h.hexdigest()))
                    node, h = r.node, sha256()
                else:
                    h.update(b",")
                h.update(r.ids.encode())
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(node, h.hexdigest())], columns=["node", "ends_sha256"])

    chunked = cut(ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
                  .mapInPandas(chunks, "node string, first long, ids string"))
    return chunked.repartition(F.col("node")).sortWithinPartitions("node", "first").mapInPandas(digest, "node string, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame, hot_nodes: int = 1000) -> DataFrame:
    """The nodes of the conversations ``turns`` (conv_id, depth from 1, content,
    size) with ``lengths`` (conv_id, n): ``conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. A node is told
    by its depth and its smallest conversation."""
    turns, lengths = cut(turns), cut(lengths)
    n_convs, least, deepest, n_turns = lengths.agg(F.count("*"), F.min("conv_id"), F.max("n"), F.sum("n")).first()
    spark = turns.sparkSession
    if not n_convs:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                         "n_leaves long, saved_tokens long, ends_sha256 string")
    height = max(0, int(deepest) - 1).bit_length()
    named = cut(prefix_names(turns, lengths, height))
    nodes = cut(named.groupBy("node").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"),
                                          F.first("depth").alias("depth"), F.first("size").alias("size")))
    # the node of every turn, told by its smallest conversation
    hot = nodes.filter(F.col("n_convs") * hot_nodes > int(n_turns)).select("node", "rep")
    cold = nodes.filter(F.col("n_convs") * hot_nodes <= int(n_turns)).select("node", "rep")
    tagged = named.select("conv_id", "depth", "node").join(F.broadcast(hot.withColumnRenamed("rep", "hot")), "node", "left")
    path = cut(tagged.filter("hot is not null").select("conv_id", "depth", F.col("hot").alias("rep")).unionByName(
        tagged.filter("hot is null").drop("hot").join(cold, "node").select("conv_id", "depth", "rep")))
    # a conversation is the smallest one of its nodes from some depth on; above that depth lies the parent of the first
    heads = nodes.groupBy(F.col("rep").alias("conv_id")).agg(F.min("depth").alias("top"))
    joints = heads.withColumn("depth", F.col("top") - 1).join(path, ["conv_id", "depth"]).select(
        "conv_id", F.col("top").alias("depth"), F.col("rep").alias("joint"))
    own = nodes.select(F.col("rep").alias("conv_id"), "depth", "n_convs", "node", ((F.col("n_convs") - 1) * F.col("size")).alias("saved")) \
        .join(joints, ["conv_id", "depth"], "left").withColumn(
            "parent", F.when(F.col("depth") == 1, F.lit(least)).otherwise(F.coalesce("joint", "conv_id"))).drop("joint")
    children = own.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    own = own.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"]) \
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    total = cut(own)
    for i in range(height):
        roots = total.filter((F.col("depth") - 1) % 2 ** (i + 1) == 2 ** i).groupBy(
            F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("foot")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        above = roots.withColumn("depth", F.explode(F.sequence(F.col("foot") - 2 ** i + 1, F.col("foot")))) \
            .join(path, ["conv_id", "depth"]).groupBy(F.col("rep").alias("conv_id"), "depth").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
        total = cut(total.join(above, ["conv_id", "depth"], "left").withColumn("leaves", F.col("leaves") + F.coalesce("l", F.lit(0)))
                    .withColumn("saved", F.col("saved") + F.coalesce("s", F.lit(0))).drop("l", "s"))
    top = total.filter("depth = 1").agg(F.count("*").alias("n_children"), F.coalesce(F.sum("leaves"), F.lit(0)).alias("leaves"),
                                        F.coalesce(F.sum("saved"), F.lit(0)).alias("saved")) \
        .select(F.lit(least).alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"),
                F.lit(n_convs).alias("n_convs"), F.lit("").alias("node"), "n_children", F.greatest("leaves", F.lit(1)).alias("leaves"), "saved")
    last = named.join(lengths, "conv_id").filter("depth = n").select("conv_id", "node") \
        .unionByName(lengths.filter("n = 0").select("conv_id", F.lit("").alias("node")))
    columns = ["conv_id", "depth", "parent", "n_convs", "node", "n_children", "leaves", "saved"]
    return total.select(*columns).unionByName(top.select(*columns)).join(ends_digest(last), "node", "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def lent_prefixes(rows: DataFrame, group: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with up to ``most`` turns of the first of their ``group``."""
    turns = cut(numbered_turns(rows))
    c = F.col("conv_id")
    return rebuilt(turns, F.crc32(c.cast("string").cast("binary")) % (most + 1), c - c % group, most)
