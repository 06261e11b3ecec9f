import re

from rankforge.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(re.findall("[A-Z]", text)),
            len(lines), len(lines) - len(set(lines)), len(covered))


def test_measures_as_brute_force(spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    texts += [None, "", " \t\n", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 20_000, "a\x0bb\x1cc d e",
              "l one\nl one\n\nl one\n \nZ", "éè # $ | <b>", "SHOUT! " * 12]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 1)], "i int, text string, n_words int")
    rows = quality.ledger(df).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert tuple(r[m] for m in quality.MEASURES) == brute(r.text)
        failed = {quality.RULES[b][0] for b in range(len(quality.RULES)) if r.fail_bits >> b & 1}
        n, chars, symbols, caps, lines, dup, repeat = brute(r.text)
        assert ("short" in failed) == (n < 10) and ("repeats" in failed) == (100 * repeat > 20 * n)
        assert ("symbols" in failed) == (10 * symbols > 3 * n)
        assert ("shouting" in failed) == (n >= 10 and 100 * caps > 50 * chars)


def test_policies_and_ablation_from_bits(spark):
    df = spark.createDataFrame([(b,) for b in (0, 1, 2, 3, 4, 4, 64, 8)], "fail_bits long")
    got = {r.rule: (r.failed, r.alone, r.removed) for r in quality.ablation(df, "base").collect()}
    assert got == {"short": (2, 1, 3), "repeats": (2, 1, 3)}
    got = {r.rule: (r.failed, r.alone, r.removed) for r in quality.ablation(df, "v1").collect()}
    assert got["symbols"] == (2, 2, 7) and got["shouting"] == (1, 1, 7) and got["tiny_words"] == (0, 0, 7)
    assert df.filter(quality.passes("base")).count() == 5 and df.filter(quality.passes("v1")).count() == 1
    assert [r.failed for r in quality.ablation(df.limit(0), "base").collect()] == [0, 0]
