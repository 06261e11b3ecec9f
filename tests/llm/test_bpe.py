import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from rankforge.llm import bpe

FILE = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def replay():
    with open(FILE, "rb") as f:
        return bpe.MergeReplay(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def reference(replay):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=replay.rank, special_tokens={})


def random_texts(n):
    rng = random.Random(3)
    points = [lambda: rng.randrange(128), lambda: rng.randrange(0x3000), lambda: rng.choice([32, 10, 9, 0x85, 0xA0, 0x1C]),
              lambda: rng.choice([39, 115, 97, 98]), lambda: rng.randrange(0x1F300, 0x1F700)]
    texts = ["".join(chr(rng.choice(points)()) for _ in range(rng.randrange(80))) for _ in range(n)]
    return texts + ["".join(rng.choice("ab \n'sé1.") for _ in range(rng.randrange(300))) for _ in range(n)]


def test_replay_equals_tiktoken(replay, reference):
    texts = random_texts(1500) + ["a" * 3000, " " * 999, "ab" * 700, "\n" * 50 + "x", "<|endoftext|>", "\x00a b"]
    split = replay.pattern.findall
    pieces = sorted({p for t in texts for c in bpe.chunks(t, split) for p in split(c)})
    ids = dict(zip(pieces, replay.encode([p.encode() for p in pieces])))
    for t in texts:
        got = [i for c in bpe.chunks(t, split) for p in split(c) for i in ids[p]]
        assert got == reference.encode_ordinary(t)
        assert replay.decode(got) == t.encode()
    assert replay.encode([]) == []


def test_pieces_by_themselves(replay, reference):
    words = ["hello", "antidisestablishmentarianism", "éèêë", "aaaaaaaaa", "x"]
    for w in words:
        assert replay.alone(w.encode()) == reference.encode_ordinary(w)


def test_frame(spark, sf_small, reference):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    rows += [(900, None), (901, ""), (None, "one"), (901, ""), (902, "word " * 60_000), (903, "<|endoftext|> a\tb  c")]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_tokens int")
    got = bpe.bpe_encode(df, FILE, P.PATTERN).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text): r for r in got}
    for d, t in rows:
        r, ids = by[d, t], reference.encode_ordinary(t or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.bpe_encode(df.limit(0), FILE, P.PATTERN, with_ids=False).collect() == []


def test_words_of_texts(replay):
    split = replay.pattern.findall
    texts = random_texts(400) + ["", None, "a b\nc", "a  b", " a", "a ", "\n", "one two\nthree"] * 3
    words, firsts = bpe.words_of(pa.array(texts, pa.string()), split)
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(firsts, firsts[1:])] == [bpe.chunks(t, split) if t else [] for t in texts]


def test_shared_words_and_memory_change_no_result(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    want = sorted(bpe.bpe_encode(docs, FILE, P.PATTERN, with_ids=False).collect())
    for setting in ({"shared_words": 0, "words_kept": 1, "group_chars": 20_000}, {"shared_words": 300, "words_kept": 400}):
        assert sorted(bpe.bpe_encode(docs, FILE, P.PATTERN, with_ids=False, **setting).collect()) == want


def test_remembered_words_are_few_bytes_each_and_bounded(replay, reference):
    words = [f" w{i}x{i * i}" for i in range(30_000)]
    none = np.empty(0, np.int32)
    known = bpe.WordIds(replay, pa.array([], pa.large_string()), none, none, 12_000)
    for at in range(0, len(words), 5_000):
        some = words[max(0, at - 2_000):at + 5_000]  # some of them remembered, some not
        ids, sizes = known.of(pa.array(some, pa.large_string()))
        ends = np.cumsum(sizes)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, sizes)] == reference.encode_ordinary_batch(some)
        assert len(known.words) == len(known.sizes) <= 12_000 and known.sizes.sum() == len(known.ids)
        assert known.words.nbytes + known.ids.nbytes + known.sizes.nbytes <= 70 * len(known.words)  # 17 bytes, 8 tokens
