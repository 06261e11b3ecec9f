"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A first pass counts the words of the corpus (map-side, then by word). The
frequent ones form a table of distinct words, over which the merges are
replayed once: an inverted index maps every pair that merges into a token to
its positions over all words; the merges are applied in rank order, all
positions of one at once, and touch only the neighbours of these positions.
That table goes to every task; it holds at most ``shared_words`` words, so its
size does not grow with the corpus. A second pass splits the texts and puts the
ids of their words together; words that are not in the table are replayed in
the task, all those of a group of texts together, and at most ``words_kept`` of
them are remembered. Which words are shared changes the time, never a result.
The corpus itself is not shuffled.

In a word whose merge yields a pair of a rank lower than its own, or that has
two different pairs for one token, rank order over the corpus could differ from
rank order within the word; such a word is encoded again by itself, always
merging its leftmost pair of lowest rank.

The split pattern must be one whose matches take white space only as a single
leading space or as a whole run (as that of the public byte-level tokenizers).

Edge cases: null or empty text has no tokens and both digests are those of the
empty string; texts of any length are encoded whole; repeated rows are encoded
each; special tokens in a text are ordinary text; an empty table gives an empty
result; other columns are kept, but for those of the names that the result adds.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.llm.common import cut

_SHIFT = 20  # ranks are below 2^20


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs that begin at ``starts`` and are ``sizes`` long, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class MergeReplay:
    """Encoder of one rank file and split pattern."""

    def __init__(self, lines: bytes, pattern: str):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        self.token = {i: t for t, i in self.rank.items()}
        self.byte_rank = np.array([self.rank[bytes([i])] for i in range(256)], np.int64)
        self.pattern = regex.compile(pattern)
        self.pairs: dict[int, int] = {}
        for t, i in self.rank.items():
            for at in range(1, len(t)):
                a, b = self.rank.get(t[:at]), self.rank.get(t[at:])
                if a is not None and b is not None:
                    self.pairs[a << _SHIFT | b] = i

    def alone(self, piece: bytes) -> list[int]:
        """Ids of one piece: its leftmost pair of lowest rank merges first."""
        parts, pairs = [self.rank[piece[i:i + 1]] for i in range(len(piece))], self.pairs
        while True:
            low, at = min(((r, i) for i in range(len(parts) - 1)
                           if (r := pairs.get(parts[i] << _SHIFT | parts[i + 1])) is not None), default=(None, 0))
            if low is None:
                return parts
            parts[at:at + 2] = [low]

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of every piece, by replaying the merges over all of them."""
        ids, sizes = self.replay(pieces)
        ends = np.cumsum(sizes).tolist()
        return [ids[e - n:e].tolist() for e, n in zip(ends, sizes.tolist())]

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, and how many each has."""
        pairs = self.pairs
        whole = np.array([self.rank.get(p, -1) for p in pieces], np.int64)  # a token of the vocabulary is itself
        rest = np.flatnonzero(whole < 0).tolist()
        loose = [pieces[i] for i in rest]
        flat = np.frombuffer(b"".join(loose), np.uint8)
        firsts = np.cumsum([0, *map(len, loose)])
        n = len(flat)
        tok = self.byte_rank[flat]
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[firsts[1:] - 1], prv[firsts[:-1]] = -1, -1
        #: pair -> arrays of positions of its left token; rank -> its pairs
        where: dict[int, list[np.ndarray]] = {}
        of_rank: dict[int, set[int]] = {}
        ranks: list[int] = []
        odd: list[np.ndarray] = []

        def enter(codes: np.ndarray, at: np.ndarray, merged: int) -> None:
            order = np.argsort(codes, kind="stable")
            codes, at = codes[order], at[order]
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(codes)]):
                r = pairs.get(code := int(codes[a]))
                if r is None:
                    continue
                if r <= merged:
                    odd.append(at[a:b])
                    continue
                where.setdefault(code, []).append(at[a:b])
                if r not in of_rank:
                    of_rank[r] = set()
                    heapq.heappush(ranks, r)
                of_rank[r].add(code)

        left = np.flatnonzero(nxt >= 0)
        enter(tok[left] << _SHIFT | tok[nxt[left]], left, -1)
        while ranks:
            r = heapq.heappop(ranks)
            codes = of_rank.pop(r)
            lists = [where.pop(c) for c in codes]
            if len(codes) > 1:  # two ways to the same token: which comes first is settled within a piece
                odd += [x for parts in lists for x in parts]
                continue
            a, b = divmod(next(iter(codes)), 1 << _SHIFT)
            at = lists[0][0] if len(lists[0]) == 1 else np.unique(np.concatenate(lists[0]))
            after = nxt[at]
            fits = (tok[at] == a) & (after >= 0) & (tok[after] == b)
            at, after = at[fits], after[fits]
            if not len(at):
                continue
            if a == b:  # in a run of equal tokens every second pair merges
                chained = np.concatenate([[False], after[:-1] == at[1:]])
                begin = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                take = (np.arange(len(at)) - begin) % 2 == 0
                at, after = at[take], after[take]
            beyond, before = nxt[after], prv[at]
            x = pairs.get(r << _SHIFT | a)
            if x is not None and x <= r:  # would come between two merges of this round
                odd.append(at)
            tok[at], tok[after] = r, -1
            nxt[at], nxt[after] = beyond, -1
            has = beyond >= 0
            prv[beyond[has]] = at[has]
            right, left = at[has], before[before >= 0]
            left = left[tok[left] >= 0]
            codes = np.concatenate([tok[right] << _SHIFT | tok[nxt[right]], tok[left] << _SHIFT | tok[nxt[left]]])
            if len(codes):
                enter(codes, np.concatenate([right, left]), r)
        kept = np.flatnonzero(tok >= 0)
        ids, ends = tok[kept], np.searchsorted(kept, firsts)
        own: dict[int, list[int]] = {}
        if odd:
            own = {k: self.alone(loose[k]) for k in
                   set((np.searchsorted(firsts, np.concatenate(odd), "right") - 1).tolist())}
        sizes, common = np.ones(len(pieces), np.int64), np.ones(len(loose), bool)
        sizes[rest] = found = np.diff(ends)
        for k, x in own.items():
            sizes[rest[k]], common[k] = len(x), False
        out, at = np.empty(sizes.sum(), np.int64), np.cumsum(sizes) - sizes
        out[at[whole >= 0]] = whole[whole >= 0]
        out[spread(at[rest][common], found[common])] = ids[spread(ends[:-1][common], found[common])]
        for k, x in own.items():
            out[at[rest[k]]:at[rest[k]] + len(x)] = x
        return out, sizes

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


#: White space besides the space and the line end (Unicode White_Space and the
#: four separators that str.split also takes), and the mark used to cut.
_OTHER_SPACE = re.compile("[\x00\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def chunks(text: str, split) -> list[str]:
    """Parts of a text that the pattern never joins: where words are parted by
    one space or line end each, a word with the space before it, and the line
    ends. Any other text is split whole."""
    words = text.count(" ") + text.count("\n") + 1
    if len(text.split()) != words or _OTHER_SPACE.search(text):
        return split(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


#: In a text that this matches, words are not parted by one space or line end each.
_UNEVEN = r"^[ \n]|[ \n]$|[ \n][ \n]|[\x00\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}" \
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def words_of(texts: pa.Array, split) -> tuple[pa.Array, np.ndarray]:
    """``chunks`` of every text (null: none) in one array, and where each text's
    begin in it (one more than there are texts)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    even = pc.and_(pc.invert(pc.match_substring_regex(texts, _UNEVEN)), pc.greater(pc.binary_length(texts), 0))
    marked = pc.replace_substring(pc.replace_substring(texts.filter(even), " ", "\0 "), "\n", "\0\n\0")
    plain = pc.split_pattern(marked, "\0")
    other = [split(t) for t in texts.filter(pc.invert(even)).to_pylist()]
    words = pa.concat_arrays([plain.flatten().cast(pa.large_string()),
                              pa.array([w for t in other for w in t], pa.large_string())])
    even = even.to_numpy(zero_copy_only=False)
    sizes = np.zeros(len(even), np.int64)
    sizes[even] = pc.list_value_length(plain).to_numpy(zero_copy_only=False)
    sizes[~even] = [len(t) for t in other]
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    if len(other):  # back into the order of the texts
        begins = np.empty(len(even), np.int64)
        begins[even] = np.concatenate([[0], np.cumsum(sizes[even])])[:-1]
        begins[~even] = len(words) - sizes[~even].sum() + np.concatenate([[0], np.cumsum(sizes[~even])])[:-1]
        words = words.take(pa.array(np.repeat(begins - firsts[:-1], sizes) + np.arange(len(words))))
    return words, firsts


def encode_words(replay: MergeReplay, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and how many each has: the distinct
    pieces of the words are replayed together."""
    split = replay.pattern.findall
    parts = [(w,) if w.isalpha() or w[:1] == " " and w[1:].isalpha() else split(w) for w in words]
    flat = list(chain.from_iterable(parts))
    number = dict(zip(dict.fromkeys(flat), range(len(flat))))
    ids, sizes = replay.replay([p.encode("utf-8", "surrogatepass") for p in number])
    which = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
    n = sizes[which]
    return ids[spread((np.cumsum(sizes) - sizes)[which], n)], np.diff(np.concatenate([[0], np.cumsum(n)])[begins])


class WordIds:
    """Ids of words: those of the shared table, and those a worker has met
    since its memory was last full (then it begins anew with the shared ones).
    A worker keeps this between tasks, so words are in one Arrow array and ids
    in 32 bits: 12 bytes a word besides its text and 4 for each token."""

    def __init__(self, replay: MergeReplay, words: pa.Array, ids: np.ndarray, sizes: np.ndarray, kept: int):
        self.replay, self.kept, self.shared = replay, kept, (words, ids, sizes)
        self.names = pa.array([str(i) for i in range(max(replay.token) + 1)], pa.large_string())
        self.bytes = pa.array([replay.token.get(i, b"") for i in range(max(replay.token) + 1)], pa.large_binary())
        self.begin()

    def begin(self) -> None:
        self.words, self.ids, self.sizes = self.shared

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each has; the words are distinct."""
        found = pc.index_in(words, value_set=self.words)
        fresh = words.filter(pc.is_null(found))
        at = pc.fill_null(found, -1).to_numpy()
        at = np.where(at < 0, len(self.words) - 1 + np.cumsum(at < 0), at)
        if len(fresh):
            ids, sizes = encode_words(self.replay, fresh.to_pylist())
            self.words = pa.concat_arrays([self.words, fresh])
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        n = self.sizes[at]
        out = self.ids[spread((np.cumsum(self.sizes) - self.sizes)[at], n)]
        if len(self.words) > self.kept:
            self.begin()
        return out, n


@lru_cache(maxsize=2)
def encoder(lines: bytes, pattern: str) -> MergeReplay:
    """One encoder for all tasks of a worker."""
    return MergeReplay(lines, pattern)


@lru_cache(maxsize=1)
def word_ids(lines: bytes, pattern: str, shared: bytes, kept: int) -> WordIds:
    """One memory of words for all tasks of a worker."""
    with pa.ipc.open_stream(shared) as reader:
        table = reader.read_all().combine_chunks()
    ids = table["ids"].combine_chunks()
    return WordIds(encoder(lines, pattern), table["word"].combine_chunks().cast(pa.large_string()),
                   ids.flatten().to_numpy(), pc.list_value_length(ids).to_numpy(), kept)


def groups(b: pa.RecordBatch, chars: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows, each ending with the text that reaches ``chars``."""
    at, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(b.column("text")), 0).to_pylist()):
        size += n
        if size >= chars:
            yield b.slice(at, i + 1 - at)
            at, size = i + 1, 0
    if at < b.num_rows:
        yield b.slice(at)


def frequent_words(docs: DataFrame, lines, pattern: str, shared_words: int, group_chars: int) -> DataFrame:
    """``word, ids`` of the most frequent words of all texts, at most
    ``shared_words``. A group of texts counts the words it holds twice or more;
    words of equal frequency class are taken together or not at all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = encoder(lines.value, pattern).pattern.findall
        for b in batches:
            for part in groups(b, group_chars):
                n = words_of(part.column("text"), split)[0].value_counts()
                n = n.filter(pc.greater(n.field("counts"), 1))
                yield pa.RecordBatch.from_arrays([n.field("values").cast(pa.string()), n.field("counts")], names=["word", "n"])

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(lines.value, pattern)
        words = [w for b in batches for w in b.column("word").to_pylist()]
        ids, sizes = encode_words(own, words)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), lists], names=["word", "ids"])

    counted = cut(docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
                  .select("word", F.floor(F.log2("n") * 4).alias("class")))
    least, total = None, 0
    for r in sorted(counted.groupBy("class").count().collect(), reverse=True):  # at most 256 classes
        total += r["count"]
        if total > shared_words:
            break
        least = r["class"]
    return counted.filter(F.lit(False) if least is None else F.col("class") >= least).select("word").mapInArrow(
        replay, "word string, ids array<int>")


def bpe_encode(docs: DataFrame, rank_file: str, pattern: str, with_ids: bool = True, shared_words: int = 120_000,
               words_kept: int = 300_000, group_chars: int = 2_500_000) -> DataFrame:
    """``docs`` plus ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by
    one space), ``decoded_sha256`` (of the bytes decoded from the ids) and, with
    ids, ``ids``. The rank file is read once on the driver and broadcast (its
    size is that of a vocabulary, below 2^20 tokens), and so is the table of
    frequent words."""
    with open(rank_file, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())
    new = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    new += [("ids", T.ArrayType(T.IntegerType()))] * with_ids
    kept = [c for c in docs.columns if c not in dict(new) and (c != "text" or with_ids)]
    schema = docs.select(*kept).schema
    for name, kind in new:
        schema = schema.add(name, kind)
    read = docs.select(*kept, *(["text"] if "text" not in kept else []))
    table = frequent_words(docs, lines, pattern, shared_words, group_chars).toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    shared = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(lines.value, pattern, shared.value, words_kept)
        split = known.replay.pattern.findall

        def encoded(part: pa.RecordBatch) -> pa.RecordBatch:
            words, firsts = words_of(part.column("text"), split)
            words = words.dictionary_encode()
            ids, sizes = known.of(words.dictionary)
            own = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int64())
            at, offsets = words.indices, pa.array(firsts, pa.int64())

            def joined(values: pa.Array, sep) -> pa.Array:
                """What the ids of each word stand for, joined; then that of each text's words."""
                sep = pa.scalar(sep, values.type)
                each = pc.binary_join(pa.LargeListArray.from_arrays(own, values.take(pa.array(ids))), sep)
                return pc.binary_join(pa.LargeListArray.from_arrays(offsets, each.take(at)), sep)

            texts, decoded = joined(known.names, " "), joined(known.bytes, b"")
            total = np.concatenate([[0], np.cumsum(sizes[at.to_numpy()])])[firsts]
            columns = [pa.array(np.diff(total), pa.int64()),
                       pa.array([sha256(t.as_buffer()).hexdigest() for t in texts], pa.string()),
                       pa.array([sha256(t.as_buffer()).hexdigest() for t in decoded], pa.string())]
            if with_ids:
                columns.append(pa.array([list(map(int, t.as_py().split())) for t in texts], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *columns], names=[*kept, *dict(new)])

        for b in batches:
            yield from map(encoded, groups(b, group_chars))
        pa.default_memory_pool().release_unused()  # the worker lives on, for tasks of other kinds as well

    return read.mapInArrow(run, schema)
