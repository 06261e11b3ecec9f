"""URL filter: rules, then link-graph propagation per host.

A rule is ``host/path-prefix``: it fits its host and all subdomains where the
url's path starts with the prefix; the longest one wins. For all other urls the
host decides. Hosts start with a trust (distrust) of the share of their pages
that a rule allows (blocks). Trust follows links forward, distrust follows them
backward: personalised PageRank with damping ``damping`` over the distinct
links between different hosts; hosts without a link pass nothing on. A host is
blocked if its distrust exceeds its trust by ``margin`` times what a host with
every page blocked keeps for itself.

Scores are whole numbers (parts of 10^12), so results do not depend on the
order of sums and agree between runs and engines. The rounds end when nothing
is left to pass on: a share of a share falls below one part after
ln(10^12 * hosts) / -ln(0.85) rounds at most (170 for one seed, 300 for 10^9), and
much earlier where links form no cycle. Each is one join and one aggregate with
map-side sums; lineage is cut by reliable checkpoints. Pages find the scores of
their host by (host, salt), as a host may hold a third of all pages.

Edge cases: null urls and urls without ``://`` have an empty host and path, fit
no rule and are allowed, as are urls whose host is empty; null html has no
links; texts of any length are read whole; repeated rows count as pages and are
returned each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import cut

UNIT = 10**12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Links of a page: the href of its anchors.
HREF = r"<[aA]\s[^>]*?[hH][rR][eE][fF]\s*=\s*[\x22']?([^\x22'\s>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + prefix))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct links ``(src, dst)`` between different hosts."""
    link = F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)))
    to = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    return (pages.select(host_of(F.col("url")).alias("src"), link.alias("link"))
            .select("src", host_of(to).alias("dst")).filter("src <> '' and dst <> '' and src <> dst").distinct())


def propagate(links: DataFrame, seeds: DataFrame, damping: int = 85, rounds: int | None = None) -> DataFrame:
    """``seeds(host, trust, distrust)`` over ``links(src, dst)`` -> the same
    columns with propagated scores (damping in %, 0 to 99). ``rounds`` ends the
    propagation early on request."""
    if not 0 <= damping < 100:
        raise ValueError(f"damping of {damping} %")
    both = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to")).unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to")))
    degree = both.groupBy("kind", "host").agg(F.count("*").alias("degree"))
    edges = cut(both.join(degree, ["kind", "host"]))
    mass = cut(seeds.selectExpr("host", "stack(2, 'trust', trust, 'distrust', distrust) as (kind, mass)").filter("mass > 0"))
    total = lambda parts: reduce(DataFrame.unionByName, parts).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
    reached, done = [mass], 0
    while rounds is None or done < rounds:
        done += 1
        mass = cut(mass.join(edges, ["kind", "host"])
                   .select("kind", F.col("to").alias("host"), F.expr(f"mass * {damping} div 100 div degree").alias("mass"))
                   .groupBy("kind", "host").agg(F.sum("mass").alias("mass")).filter("mass > 0"))
        if mass.isEmpty():
            break
        reached.append(mass)
        if len(reached) == 24:
            reached = [cut(total(reached))]
    own = F.expr(f"mass * {100 - damping} div 100")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, own)), F.lit(0)).alias(kind)
    return total(reached).groupBy("host").agg(of("trust"), of("distrust"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], damping: int = 85, rounds: int | None = None,
               margin: float = 0.5, salts: int = 16) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` of every row of
    ``pages(page_id, url, html)``; rules are ``(verdict, rule)``, kept in the
    plan (a list of some hundreds at most)."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")) \
        .withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    share = lambda v: F.floor(F.lit(UNIT) * F.count(F.when(F.col("fit.verdict") == v, 1)) / F.count("*")).cast("long")
    seeds = urls.filter("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = propagate(host_links(pages), seeds, damping, rounds)
    least = int(UNIT * (100 - damping) / 100 * margin)
    salted = scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    own = F.pmod(F.xxhash64("page_id", "path"), F.lit(salts)).cast("int")
    return urls.withColumn("salt", own).join(salted, ["host", "salt"], "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("distrust") - F.col("trust") > least, "block").otherwise("allow"))
        .alias("verdict"),
        F.coalesce("trust", F.lit(0).cast("long")).alias("trust"),
        F.coalesce("distrust", F.lit(0).cast("long")).alias("distrust"))
