import re
from collections import defaultdict

import duckdb

from rankforge.llm import queries, url_filter as U

RULES = queries.URL_RULES


def brute(pages, rounds=30):
    def parts(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        return ("", "") if not m else ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2])

    def fit(host, path):
        ok = [(len(r), v, r) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
              and path.startswith("/" + r.split("/", 1)[1])]
        return max(ok)[1:] if ok else (None, None)
    rows = [(p, *parts(u), *fit(*parts(u))) for p, u, _ in pages]
    links = set()
    for (_, host, *_), (_, _, html) in zip(rows, pages):
        for x in re.findall(U.HREF.replace("\\x22", '"'), html or ""):
            to = parts("x:" + x if x.startswith("//") else x)[0]
            if host and to and host != to:
                links.add((host, to))
    scores = {}
    for kind, edges in (("allow", links), ("block", {(b, a) for a, b in links})):
        out = defaultdict(list)
        for a, b in edges:
            out[a].append(b)
        seed = defaultdict(lambda: [0, 0])
        for _, host, _, v, _ in rows:
            if host:
                seed[host][0] += v == kind
                seed[host][1] += 1
        mass = {h: 10**12 * n // k for h, (n, k) in seed.items() if n}
        total = defaultdict(int, mass)
        for _ in range(rounds):
            following = defaultdict(int)
            for h, m in mass.items():
                for to in out[h]:
                    following[to] += m * 85 // 100 // len(out[h])
            mass = {h: m for h, m in following.items() if m}
            for h, m in mass.items():
                total[h] += m
        scores[kind] = {h: m * 15 // 100 for h, m in total.items()}
    got = []
    for p, host, path, v, rule in rows:
        t, d = scores["allow"].get(host, 0), scores["block"].get(host, 0)
        got.append((p, host, path, rule, v or ("block" if d - t > 75 * 10**9 else "allow"), t, d))
    return sorted(got, key=str)


def planted():
    a = lambda *hosts: "".join(f"<a class=x href='http://{h}/p'>l</a>" for h in hosts)
    rows = [(1, "http://spam.net/x", a("good.org")), (2, "http://Farm.io/1", a("spam.net", "bad.net", "farm.io")),
            (3, "https://good.org/fr/a", a("friend.io") + '<A HREF="//cdn.io/x">'), (4, "https://friend.io?q", a("farm.io")),
            (5, "http://a.example.net/en/1", None), (6, "http://x.example.com/de/", a("spam.net")), (7, "http://x.example.com/fr/", ""),
            (8, None, a("spam.net")), (9, "no scheme", ""), (10, "http://", ""), (11, "http://badnet/", ""), (12, "http://net", ""),
            (13, "ftp://u:p@bad.net:80/#f", ""), (13, "ftp://u:p@bad.net:80/#f", ""), (None, "http://bad.net/" + "y" * 50_000, ""),
            (14, "http://cdn.io/", ""), (15, "http://near.io", a("farm.io"))]
    return rows


def test_against_brute_force_and_sql(spark):
    rows = planted()
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    assert sorted((tuple(r) for r in U.judge_urls(df, RULES, rounds=30).collect()), key=str) == brute(rows)
    got = sorted((tuple(r) for r in U.judge_urls(df, RULES).collect()), key=str)
    assert got == brute(rows, rounds=300)
    verdict = {r[0]: r[4] for r in got}
    assert verdict[2] == "block" and verdict[4] == "allow" and verdict[14] == "allow"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    sql = sorted(con.execute("SELECT page_id, host, path, rule, verdict, trust, distrust FROM (" + queries.ORACLES["op1_url_filter"] + ")").fetchall(), key=str)
    assert sql == got
    assert U.judge_urls(df.limit(0), RULES).collect() == []


def test_long_chains_and_a_hot_host(spark):
    """Distrust reaches hosts more than 30 links away; one host with many pages is spread by salt."""
    a = lambda i: f"<a href='http://h{i + 1}.io/'>l</a>"
    rows = [(i, f"http://h{i}.io/", a(i)) for i in range(40)] + [(99, "http://h40.io/", "<a href='http://bad.net/'>l</a>"), (100, "http://bad.net/", "")]
    rows += [(1000 + i, f"http://h39.io/{i}", "") for i in range(3000)]
    got = sorted((tuple(r) for r in U.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES).collect()), key=str)
    assert got == brute(rows, rounds=300)
    assert next(r for r in got if r[0] == 0)[6] > 0
