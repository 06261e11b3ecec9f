import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

from rankforge.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth int, node string, n int"


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(o)] for c, o in own.items()}
    seqs = {}
    for c, o in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + o[h:]
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((len(p), min(m), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def run(spark, rows, **setting):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = P.trie(*P.lent_prefixes(df), **setting).select(
        "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(r) for r in got.collect())


def test_given_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, rows) == brute(rows)


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = []
    for c in [*range(-205, -195), *range(60), 200, *range(1005, 1030)]:
        for t in range(rng.choice([1, 2, 3, 4, 9, 17])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "", None]), rng.choice(["a", "bb", "ccc", "", None])))
    rows += [(None, 0, "user", "lost"), (5, 0, "user", "a"), (5, 0, "user", "a")]
    assert run(spark, rows, hot_nodes=5) == brute(rows)


def test_hot_conversations(spark):
    rows = [(c, t, "user", f"turn {t}" + ("." if t == 4 and c % 7 == 0 else "")) for c in range(1, 900) for t in range(6)]
    rows += [(0, t, "user", "long " * (t % 3) + str(t)) for t in range(700)]  # one conversation with many turns
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    assert run(spark, []) == run(spark, [(None, 1, "user", "x")]) == []
    one = [(1, 0, None, None)]
    assert run(spark, one) == brute(one)
    few = [(c, 0, "u", "x" * c) for c in range(1, 9)]  # some are rebuilt from no turns
    assert run(spark, few) == brute(few)
    assert any(d == 0 and e != P.EMPTY for d, *_, e in run(spark, few))
