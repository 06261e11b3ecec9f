import random

from rankforge.llm import warc_fixity as W


def frame(spark, rows):
    return spark.createDataFrame([(f, o, b, 1) for (f, o), b in rows], "file long, offset long, body string, node int")


def test_audit_finds_exactly_the_damage(spark):
    rng = random.Random(6)
    rows = {(f, rng.randrange(1 << 34) if f == 3 else i * 900): f"r{f}-{i}" for f in range(4) for i in range(300 if f != 2 else 0)}
    rows[0, 900] = None
    other, want = dict(rows), {}
    for key in rng.sample(sorted(rows), 25):
        want[key] = rng.choice(["corrupt", "missing"])
        if want[key] == "missing":
            del other[key]
        else:
            other[key] = "rotten"
    other[1, 10**9] = other[9, 0] = "new"
    want[1, 10**9] = want[9, 0] = "extra"
    a, b = frame(spark, rows.items()), frame(spark, other.items())
    files, damage = W.audit(a, b)
    assert {(r.file, r.offset): r.status for r in damage.collect()} == want
    intact = {r.file: r.intact for r in files.collect()}
    assert intact == {f: all(k[0] != f for k in want) for f in (0, 1, 3, 9)}
    rep = {r.file: r for r in W.report(a, a).collect()}
    assert all(r.intact and r.n_bad == 0 and r.bad == "" and r.root == r.replica_root for r in rep.values())
    assert sum(r.n_records for r in rep.values()) == len(rows)


def test_one_changed_record_changes_each_level_once(spark):
    rows = {(0, i * 1000): str(i) for i in range(2000)}
    a, b = (W.merkle_levels(W.hashed(frame(spark, x.items()))) for x in (rows, rows | {(0, 500_000): "!"}))
    assert [W.differing(x, y, ["file", "node"]).count() for x, y in zip(a, b)] == [1] * (W.LEVELS + 1)


def test_records_of_pages_and_edge_cases(spark):
    pages = spark.createDataFrame([(1, "u", "<p>"), (2, None, None), (2, None, None), (None, "u", "x"), (501, "v", "y" * 300_000)],
                                  "page_id long, url string, html string")
    rows = W.warc_records(pages).collect()
    assert len(rows) == 5 and all(r.length == len(r.body.encode()) for r in rows)
    first = sorted((r.offset, r.length) for r in rows if r.file == 0)
    assert [o for o, _ in first] == [0, first[0][1], first[0][1] + first[1][1]]
    empty = W.warc_records(pages.limit(0))
    assert W.report(empty, empty).collect() == []
    assert [r.intact for r in W.report(W.warc_records(pages), empty).collect()] == [False] * 3


def test_index_has_the_digests_of_the_records(spark):
    from pyspark.sql import functions as F
    pages = spark.createDataFrame([(1, "u", "<p>"), (2, None, None), (2, None, None), (7, "v", "y" * 300_000)], "page_id long, url string, html string")
    index = W.warc_index(pages, other=F.concat("body", F.lit("!")))
    assert index.columns == ["file", "offset", "length", "page_id", "digest", "other"]
    assert W.report(W.warc_records(pages), index).first().intact
    files, damage = W.audit(index, index.select("file", "offset", F.col("other").alias("digest")))
    assert damage.filter("status = 'corrupt'").count() == 4 and not files.first().intact
