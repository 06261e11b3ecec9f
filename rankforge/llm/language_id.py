"""Language identification by character language models.

One interpolated Kneser-Ney model per language over lower-cased letters (any
run of other characters is one space). An n-gram of up to four characters packs
into 64 bits (16 bits a character; characters beyond the basic plane share one
code). The corpus is counted in Spark: each task counts its n-grams per
language, one aggregate adds them up. Every n-gram *type* reaches the driver and
is in the broadcast model, which grows with the number of types: about 32 bytes
+ 16 bytes per language for each. Only a caller that gives ``model_grams``
prunes the four-character n-grams, after discounts, continuation counts and
totals are made from all of them: each language keeps its most frequent ones,
the probability of the others goes to their contexts' back-off, and the
cross-entropy of the training text is that of the pruned model on all counts.

The models are sorted hash arrays: all n-grams of an order by ascending 64-bit
hash, with one row of probabilities per language. A text's cross-entropy is the
mean over all its characters; the lowest wins. ``score`` is the posterior of
the winner times its fit: 1 as long as the cross-entropy stays within
``slack`` standard errors plus ``margin`` of what is usual for the language,
and falling exponentially beyond. A score below ``min_score`` rejects.

Posterior and rejection are calibrated on labelled texts that a model has not
seen: every eighth, by a hash of the text (so copies stay together), is kept
from a first model and scored by it. The temperature of the posterior is the
one of a grid with the least log-loss of the true languages; a language's usual
cross-entropy is the mean over its characters there; ``margin`` is the
``QUANTILE`` of what the texts need beyond ``slack`` standard errors. The final
models count all labelled texts. Where no labelled text is kept apart (very few
texts), the temperature is 1, the usual cross-entropy that of the counted text
and ``margin`` 0.5; a language without one keeps its own counted text's.

Edge cases: null text or text without a letter is ``und`` with score 0 and is
rejected; without any training text everything is; equal cross-entropies take
the language that sorts first; null doc_ids count as the empty text in the
held-out rule; texts of any length count and are scored whole; an empty table
gives an empty result; repeated rows and other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import cut, mix64

ORDER = 4
#: One labelled text of so many calibrates; the temperatures tried; the share of texts that fit without penalty.
APART, HEAT, QUANTILE = 8, 2.0 ** -np.arange(0, 10.5, 0.5), 0.99
#: Characters scored at once, but for longer texts: some 100 bytes a character and language while they are looked up.
SCORED = 100_000
_CODE = np.uint64(16)
_OTHER = 0xFFFF


@cache
def _letters() -> np.ndarray:
    """Code of each code point: itself (or _OTHER beyond 16 bits) for a letter, else 0."""
    out = np.zeros(0x110000, np.uint16)
    for i in range(0x110000):
        if chr(i).isalpha():
            out[i] = min(i, _OTHER)
    return out


def char_codes(text: str | None) -> np.ndarray:
    """Letters of the lower-cased text; runs of other characters are one 32.
    Empty if there is no letter."""
    if not text:
        return np.empty(0, np.uint16)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([_letters()[points], np.zeros(1, np.uint16)])
    before = np.concatenate([[0], codes[:-1]])
    kept = codes[(codes > 0) | (before > 0)]
    return np.where(kept == 0, np.uint16(32), kept) if len(kept) else kept


def gram_keys(codes: np.ndarray) -> np.ndarray:
    """64-bit key of the four characters that end at each position; the text is
    preceded by spaces."""
    wide = np.concatenate([np.full(ORDER - 1, 32, np.uint64), codes.astype(np.uint64)])
    n = len(codes)
    out = wide[:n].copy()
    for i in range(1, ORDER):
        out = (out << _CODE) | wide[i:n + i]
    return out


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def apart(text: Column) -> Column:
    """Whether a labelled text calibrates the models."""
    return F.pmod(F.xxhash64(text), F.lit(APART)) == 0


def count_grams(docs: DataFrame) -> DataFrame:
    """``docs(text, lang)`` -> ``(lang, gram, n, n_apart)`` over every row with
    both; ``n_apart`` is what the texts kept apart have of ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[str, bool], list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def merged(parts):
            keys = np.concatenate([k for k, _ in parts])
            counts = np.concatenate([c for _, c in parts])
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            return keys[starts], np.add.reduceat(counts, starts)

        def flush():
            for (lang, aside), parts in kept.items():
                keys, counts = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts),
                     pa.array(counts if aside else np.zeros_like(counts))], names=["lang", "gram", "n", "n_apart"])
            kept.clear()

        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                by: dict[tuple[str, bool], list[np.ndarray]] = {}
                for text, *key in zip(*(part.column(c).to_pylist() for c in ("text", "lang", "aside"))):
                    if len(codes := char_codes(text)):
                        by.setdefault(tuple(key), []).append(gram_keys(codes))
                for lang, keys in by.items():
                    grams, counts = np.unique(np.concatenate(keys), return_counts=True)
                    kept.setdefault(lang, []).append((grams, counts.astype(np.int64)))
                    if len(kept[lang]) >= 16:
                        kept[lang] = [merged(kept[lang])]
                held = sum(len(k) for parts in kept.values() for k, _ in parts)
                if held > 4_000_000:  # a task's memory stays bounded
                    yield from flush()
        if kept:
            yield from flush()

    rows = docs.select("text", "lang", apart(F.col("text")).alias("aside")).filter("text is not null and lang is not null")
    return rows.mapInArrow(run, "lang string, gram long, n long, n_apart long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"), F.sum("n_apart").alias("n_apart"))


class HashArray:
    """64-bit keys sorted by hash, and a directory over the leading hash bits."""

    def __init__(self, keys: np.ndarray):
        hashed = mix64(keys)
        self.order = np.argsort(hashed)
        self.hashes = hashed[self.order]
        self.bits = np.uint64(64 - max(4, min(21, int(len(keys)).bit_length() + 2)))
        cells = 1 << (64 - int(self.bits))
        self.starts = np.searchsorted(self.hashes >> self.bits, np.arange(cells + 1).astype(np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is missing."""
        hashed = mix64(keys)
        cell = (hashed >> self.bits).astype(np.int64)
        at, stop = self.starts[cell], self.starts[cell + 1]
        out = np.full(len(keys), -1, np.int32)
        if not len(self.hashes):
            return out
        hit = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashed
        out[hit & (at < stop)] = at[hit & (at < stop)]
        open_ = np.flatnonzero((out < 0) & (at + 1 < stop))
        while len(open_):
            at[open_] += 1
            hit = self.hashes[at[open_]] == hashed[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            open_ = open_[at[open_] + 1 < stop[open_]]
        return out


class LanguageModels:
    """Kneser-Ney models of several languages over shared sorted hash arrays."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], most: int | None = None):
        """Ascending n-grams and their counts per language, of which at most ``most`` keep a probability of their own."""
        self.langs = sorted(counts)
        self.grams: list[HashArray] = []
        self.prob: list[np.ndarray] = []
        self.contexts: list[HashArray] = []
        self.backoff: list[np.ndarray] = []
        types = {lang: self._orders(*counts[lang]) for lang in self.langs}
        self.floor = np.ones(len(self.langs))
        for n in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([types[x][n - 1][0] for x in self.langs] or [np.empty(0, np.uint64)]))
            ctx = np.unique(keys >> _CODE)
            contexts = HashArray(ctx)
            own, back = np.zeros((len(keys), len(self.langs))), np.ones((len(ctx), len(self.langs)))
            has = np.zeros(len(keys), bool)
            for i, lang in enumerate(self.langs):
                k, c = types[lang][n - 1]
                once, twice = np.count_nonzero(c == 1), np.count_nonzero(c == 2)
                d = once / (once + 2 * twice) if once and twice else 0.5
                h, which = np.unique(k >> _CODE, return_inverse=True)
                total = np.bincount(which, c)
                share = np.maximum(c - d, 0) / total[which]
                gamma = d * np.bincount(which) / total
                if n == ORDER and most is not None and most < len(k):
                    pruned = np.lexsort((mix64(k), -c))[most:]
                    gamma += np.bincount(which[pruned], share[pruned], len(h))
                    share[pruned] = 0
                    kept = np.ones(len(k), bool)
                    kept[pruned] = False
                    has[np.searchsorted(keys, k[kept])] = True
                else:
                    has[np.searchsorted(keys, k)] = True
                own[np.searchsorted(keys, k), i] = share
                back[np.searchsorted(ctx, h), i] = gamma
                if n == 1:
                    self.floor[i] = gamma[0] / (1 << 16)
            keys, own = (keys, own) if has.all() else (keys[has], own[has])
            grams = HashArray(keys)
            if n == 1:
                prob = own + self.floor
            else:
                prob = own + back[np.searchsorted(ctx, keys >> _CODE)] * self._prob(keys & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
            self.grams.append(grams)
            self.prob.append(prob[grams.order])
            self.contexts.append(contexts)
            self.backoff.append(back[contexts.order])
        self.log = np.log(self.prob[-1]) if self.langs else None
        self.heat, self.margin = 1.0, 0.5
        # mean and spread of the cross-entropy per character over the training counts
        self.mean, self.spread = np.zeros(len(self.langs)), np.zeros(len(self.langs))
        for i, lang in enumerate(self.langs):
            k, c = counts[lang]
            x = np.concatenate([-self.log_prob(k[at:at + 500_000])[:, i] for at in range(0, len(k), 500_000)])
            self.mean[i] = (x * c).sum() / c.sum()
            self.spread[i] = np.sqrt((c * (x - self.mean[i]) ** 2).sum() / c.sum())

    @staticmethod
    def _orders(keys, counts):
        """Types and counts of orders 1..ORDER: the highest as counted, each
        lower one by the number of different characters that precede it."""
        out = [(keys, counts.astype(np.float64))]
        for n in range(ORDER - 1, 0, -1):
            k, c = np.unique(out[0][0] & np.uint64((1 << 16 * n) - 1), return_counts=True)
            out.insert(0, (k, c.astype(np.float64)))
        return out

    def _prob(self, keys: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of n-grams of order n, one column per language."""
        at = self.grams[n - 1].find(keys)
        out = self.prob[n - 1][at] if len(self.prob[n - 1]) else np.zeros((len(keys), len(self.langs)))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            out[missing] = self.floor if n == 1 else self._backed(keys[missing], n)
        return out

    def _backed(self, keys: np.ndarray, n: int) -> np.ndarray:
        at = self.contexts[n - 1].find(keys >> _CODE)
        gamma = self.backoff[n - 1][at]
        gamma[at < 0] = 1.0
        return gamma * self._prob(keys & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)

    def log_prob(self, keys: np.ndarray) -> np.ndarray:
        at = self.grams[-1].find(keys)
        out = self.log[at]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            out[missing] = np.log(self._backed(keys[missing], ORDER))
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Characters, and cross-entropy per language (rows of texts), over whole texts."""
        sizes = np.zeros(len(texts), np.int64)
        out = np.full((len(texts), len(self.langs)), np.inf)
        group, held = [], 0

        def score():
            if not group:
                return
            logs = self.log_prob(np.concatenate([k for _, k in group]))
            starts = np.cumsum([0, *(len(k) for _, k in group)])[:-1]
            rows = [i for i, _ in group]
            sums = np.add.reduceat(logs, starts, axis=0)
            out[rows] = -sums / sizes[rows, None]

        for i, text in enumerate(texts):
            codes = char_codes(text)
            sizes[i] = len(codes)
            if len(codes) and self.langs:
                group.append((i, gram_keys(codes)))
                held += len(codes)
                if held > SCORED:
                    score()
                    group, held = [], 0
        score()
        return sizes, out

    def predict(self, texts: list[str | None], slack: float, margin: float | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
        sizes, h = self.entropies(texts)
        margin = self.margin if margin is None else margin
        score, entropy = np.zeros(len(texts)), np.full(len(texts), np.nan)
        lang = ["und"] * len(texts)
        for i in np.flatnonzero((sizes > 0) & bool(self.langs)):
            best = int(h[i].argmin())
            weight = np.exp(-(h[i] - h[i, best]) * sizes[i] * self.heat)
            allowed = self.mean[best] + margin + slack * self.spread[best] / np.sqrt(sizes[i])
            score[i] = min(1.0, np.exp(allowed - h[i, best])) / weight.sum()
            lang[i], entropy[i] = self.langs[best], h[i, best]
        return lang, score, entropy


def fit_language_models(docs: DataFrame, model_grams: int | None = None) -> LanguageModels:
    """Models of every non-null ``lang`` in ``docs(text, lang)``; with
    ``model_grams``, of about so many four-character n-grams at most, but one of each language at least."""
    got = count_grams(docs).toArrow().combine_chunks()
    lang = pa.concat_arrays([pa.array([], pa.string()), *got.column("lang").chunks]).dictionary_encode()
    names, which = lang.dictionary.to_pylist(), lang.indices.to_numpy()
    gram = got.column("gram").to_numpy().view(np.uint64)
    n, aside = got.column("n").to_numpy(), got.column("n_apart").to_numpy()
    del got, lang
    most = None if model_grams is None else max(1, model_grams // max(1, len(names)))

    def build(n: np.ndarray) -> LanguageModels:
        out = {}
        for i, x in enumerate(names):
            mine = np.flatnonzero((which == i) & (n > 0))
            if len(mine):
                mine = mine[np.argsort(gram[mine])]
                out[x] = gram[mine], n[mine]
        return LanguageModels(out, most)

    fit = calibration(docs, build(n - aside)) if aside.any() else None
    models = build(n)
    if fit:
        models.heat, models.margin = fit["heat"], fit["margin"]
        for i, x in enumerate(models.langs):
            models.mean[i] = fit["mean"].get(x, models.mean[i])
    return models


def calibration(docs: DataFrame, models: LanguageModels, slack: float = 4.0) -> dict | None:
    """Temperature, margin and usual cross-entropy by language, from the texts
    of ``docs(text, lang)`` that ``models`` have not seen; None if there is none
    in a language they know. One pass; the driver gets one row per language."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    loss = [f"loss{j}" for j in range(len(HEAT))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        at = {x: i for i, x in enumerate(m.langs)}
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                lang = part.column("lang").to_pylist()
                sizes, h = m.entropies(part.column("text").to_pylist())
                rows = [i for i, x in enumerate(lang) if x in at and sizes[i] > 0]
                own = np.array([at[lang[i]] for i in rows], np.int64)
                size, h = sizes[rows], h[rows]
                true = h[np.arange(len(rows)), own]
                gap = (h - h.min(axis=1, keepdims=True)) * size[:, None] if rows else h
                losses = [np.log(np.exp(-gap * t).sum(axis=1)) + gap[np.arange(len(rows)), own] * t for t in HEAT]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang[i] for i in rows], pa.string()), pa.array(size), pa.array(true),
                     pa.array(m.spread[own]), *map(pa.array, losses)], names=["lang", "size", "h", "spread", *loss])

    rows = docs.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & apart(F.col("text")))
    scored = cut(rows.mapInArrow(run, "lang string, size long, h double, spread double, " + ", ".join(f"{x} double" for x in loss)))
    sums = scored.groupBy("lang").agg((F.sum(F.col("h") * F.col("size")) / F.sum("size")).alias("mean"),
                                      *(F.sum(x).alias(x) for x in loss)).collect()
    if not sums:
        return None
    mean = {r["lang"]: r["mean"] for r in sums}
    usual = F.broadcast(docs.sparkSession.createDataFrame(list(mean.items()), "lang string, mean double"))  # a row per language
    beyond = F.col("h") - F.col("mean") - slack * F.col("spread") / F.sqrt("size")
    margin = scored.join(usual, "lang").agg(F.percentile_approx(beyond, QUANTILE, 10_000)).first()[0]
    total = [sum(r[x] for r in sums) for x in loss]
    return {"heat": float(HEAT[int(np.argmin(total))]), "margin": max(0.0, margin), "mean": mean}


def classify(docs: DataFrame, models: LanguageModels, slack: float = 4.0, margin: float | None = None,
             min_score: float = 0.3) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score``, ``cross_entropy``, ``rejected``;
    only the text is looked at. ``margin`` is the models' own unless given. Columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    new = [("lang_pred", "string"), ("score", "double"), ("cross_entropy", "double"), ("rejected", "boolean")]
    kept = [c for c in docs.columns if c not in dict(new)]
    schema = docs.select(*kept).schema
    for name, kind in new:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                lang, score, entropy = shared.value.predict(part.column("text").to_pylist(), slack, margin)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(lang, pa.string()), pa.array(score),
                     pa.array(entropy, from_pandas=True), pa.array((score < min_score) | (np.array(lang) == "und"))],
                    names=[*kept, *dict(new)])

    return docs.select(*kept).mapInArrow(run, schema)
