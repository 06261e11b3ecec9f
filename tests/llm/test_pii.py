import hashlib
import re

from pyspark.sql import functions as F

from rankforge.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(text):
    out = []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for no, (kind, pattern, ok) in enumerate([
            ("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(int(x) <= 255 for x in s.split("."))),
            ("card", CARD, lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
            ("phone", PHONE, lambda s: 10 <= len(digits(s)) <= 15)]):
        out += [(m.start(), no, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if ok(m[0])]
    return ",".join(x for _, _, x in sorted(out))


def found(spark, texts, kinds=None):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    keep = F.filter("pii", lambda s: s["kind_no"] < (kinds or len(pii.KINDS)))
    return [r.x for r in pii.find_pii(df).select("i", pii.joined(keep).alias("x")).orderBy("i").collect()]


def test_base_kinds_as_brute_force(spark, sf_small):
    import random
    rng = random.Random(9)
    bits = ["a@b.c", "@", ".", "1", "12", " ", "-", "+", "(", "x_y", "255", "256", "4736962573099581", "1.2.3.4", "é", "\U0001F600",
            "+1 (487) 555-7209", "\n", "007", "a.b", "%"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    texts += [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    texts += [None, "", "1 " * 3000, "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "9" * 5000, "a" * 5000 + "@b." + "c." * 3000 + "d",
              "0000000255.1.1.1", "+1" + "." * 5000]
    assert found(spark, texts, 4) == [base(t) for t in texts]


def test_many_spans_and_very_long_text(spark):
    text = "10.0.0.1 und " * 20_000
    got = found(spark, [text])[0].split(",")
    assert len(got) == 20_000 and got[-1] == f"ip:{13 * 19_999}:{13 * 19_999 + 8}"


def test_further_kinds_need_checksum_or_context(spark):
    texts = ["Konto DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "ssn 123-45-6789", "part 123-45-6789",
             'token = "04dbebab91ab85687d33eeaaf9ac"', '"04dbebab91ab85687d33eeaaf9ac"']
    got = found(spark, texts)
    assert [x.split(":")[0] for x in got] == ["iban", "", "ssn", "", "secret", ""]


def test_redaction_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "Mail a@b.cc, IP 1.2.3.4!", 7), (2, None, 7), (3, "", 7), (3, "", 7)], "doc_id int, text string, pii int")
    rows = sorted(((r.doc_id, r.text) for r in pii.redact(pii.find_pii(df)).collect()))
    assert rows == [(1, "Mail [EMAIL], IP [IP]!"), (2, None), (3, ""), (3, "")]
    assert pii.find_pii(df.limit(0)).collect() == []
    again = spark.createDataFrame([(rows[0][1],)], "text string")
    assert pii.find_pii(again).first().pii == []


def test_query_counts_each_kind(spark, tmp_path):
    texts = ["1.2.3.4 a@b.c 4111111111111111 +1 (487) 555-7209", "+1 (487) 555-7209 a@b.c, d@e.f", "x", None,
             "1.2.3.4 5.6.7.8 9.10.11.12 DE89 3704 0044 0532 0130 00 iban", "4111111111111111 a@b.c"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op8_personal_data(spark, str(tmp_path)).collect():
        kinds = [s.split(":")[0] for s in base(texts[r.doc_id]).split(",")]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]
        assert r.n_iban == (1 if r.doc_id == 4 else 0) and r.n_ssn == r.n_secret == 0
        assert r.base_sha256 == hashlib.sha256(base(texts[r.doc_id]).encode()).hexdigest()
