"""Quality rules as a bitmask ledger, with SQL functions only.

``measure`` evaluates every measurement once per document; ``ledger`` keeps
them and one failure bit per rule. Policies are versioned bit masks: applying
one, or asking what each of its rules removes, never reads the texts again.

Words in repeated 5-word windows, without leaving the row: the windows are
hashed (64 bits); only if two are equal the hashes are sorted with their
positions, and the positions of equal ones give the words they cover.

Edge cases: null text counts as empty (0 words: fails ``short``); a text of
fewer than 5 words has no window; texts of any length are measured whole;
repeated rows are separate documents; an empty table has an empty ledger, whose
ablation has a row of zeros per rule. Columns of ``docs`` are kept, but for
those of the names that are added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.pii import let

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_caps", "n_lines", "n_dup_lines", "n_repeat_words"]

#: Rules in bit order: name and condition of failure, in integers.
RULES: list[tuple[str, str]] = [
    ("short", "n_words < 10"),
    ("repeats", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("dup_lines", "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines"),
    ("long_words", "word_chars > 25 * n_words"),
    ("tiny_words", "word_chars < 2 * n_words"),
    ("shouting", "n_words >= 10 and 100 * n_caps > 50 * word_chars"),
]
#: Versioned policies: the rules that each applies.
POLICIES: dict[str, list[str]] = {
    "base": ["short", "repeats"],
    "v1": ["short", "repeats", "symbols", "dup_lines", "long_words", "tiny_words", "shouting"],
}


def _repeat_words(words: Column) -> Column:
    hashes = let(words, lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(w[i + k] for k in range(WINDOW)))))
    pairs = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    twice = lambda p: F.array_sort(F.transform(
        F.filter(p, lambda x, j: ((j > 0) & (F.get(p, j - 1)["h"] == x["h"]))
                 | F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
    covered = lambda at: F.aggregate(
        at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h),
                                        covered(let(pairs(h), twice))).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(words) >= WINDOW, some).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` plus the columns of ``MEASURES`` (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    full = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    lines = let(full, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    of_words = let(words, lambda w: F.struct(
        F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), _repeat_words(w).alias("repeat")))
    count = lambda chars: F.length(text) - F.length(F.regexp_replace(text, chars, ""))
    got = docs.withColumns({"_words": of_words, "_lines": lines, "_symbols": count("[#*$%&|<>]"),
                            "_caps": count("[A-Z]")})
    return got.withColumns({
        "n_words": F.col("_words.n").cast("long"), "word_chars": F.col("_words.chars").cast("long"),
        "n_symbols": F.col("_symbols").cast("long"), "n_caps": F.col("_caps").cast("long"), "n_lines": F.col("_lines.n").cast("long"),
        "n_dup_lines": F.col("_lines.dup").cast("long"), "n_repeat_words": F.col("_words.repeat"),
    }).drop("_words", "_lines", "_symbols", "_caps")


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` plus measurements and ``fail_bits`` (bit i: rule i failed)."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, rule) in enumerate(RULES)]
    total: Column = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs).withColumn("fail_bits", total)


def mask(policy: str) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def passes(policy: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (and so
    return without it), and all that the policy removes; from the bits alone."""
    m = F.lit(mask(policy)).cast("long")
    sets = rows.select(F.col("fail_bits").bitwiseAND(m).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    of: Callable[[int], list[Column]] = lambda i: [
        F.coalesce(F.sum(F.when(F.col("b").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("b") == F.lit(1 << i), F.col("n"))), F.lit(0))]
    removed = F.coalesce(F.sum(F.when(F.col("b") != 0, F.col("n"))), F.lit(0))
    names = [name for name, _ in RULES]
    structs = [F.struct(F.lit(rule).alias("rule"), of(names.index(rule))[0].alias("failed"),
                        of(names.index(rule))[1].alias("alone"), removed.alias("removed"))
               for rule in POLICIES[policy]]
    return sets.agg(F.array(*structs).alias("x")).select(F.explode("x").alias("x")).select("x.*")
