"""The queries of this subpackage, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import (block_topk, bpe, embedding_neardup, html_extract, language_id, lexical_search, ngram_join, pii,
                           prefix_trie, quality, source_mix, url_filter, warc_fixity)
from rankforge.llm.common import cut, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(f):
    QUERIES[f.__name__] = f
    return f


@_register
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of 3-word shingle sets at a Jaccard similarity of 90 %."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), n=3, threshold=90)


@_register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    models = language_id.fit_language_models(docs.filter("not held_out"))
    return language_id.classify(docs.select("doc_id", "held_out", "text"), models).drop("text")


@_register
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes decoded from them, as digests."""
    return bpe.bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


@_register
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes of every document."""
    return source_mix.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies", "part_words")


@_register
def op5_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the verdicts of two policies."""
    rows = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *quality.MEASURES, "fail_bits", (~quality.passes("base")).alias("base_failed"),
                       (quality.passes("base") & quality.passes("v1")).alias("kept"))


ORACLES["op5_quality_ledger"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, i, ws[i:i + 4] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1),
c AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS j FROM r) GROUP BY rid),
l AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup
      FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_caps, coalesce(l.n, 0)::BIGINT AS n_lines,
             coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN l USING (rid) LEFT JOIN c USING (rid)),
b AS (SELECT *, (n_words < 10)::INT AS b0, (100 * n_repeat_words > 20 * n_words)::INT AS b1,
             (10 * n_symbols > 3 * n_words)::INT AS b2, (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines)::INT AS b3,
             (word_chars > 25 * n_words)::INT AS b4, (word_chars < 2 * n_words)::INT AS b5,
             (n_words >= 10 AND 100 * n_caps > 50 * word_chars)::INT AS b6 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_caps, n_lines, n_dup_lines, n_repeat_words,
       (b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5 + 64 * b6)::BIGINT AS fail_bits,
       b0 + b1 > 0 AS base_failed, b0 + b1 + b2 + b3 + b4 + b5 + b6 = 0 AS kept
FROM b
"""


@_register
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every document."""
    rows = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["kind_no"] < len(pii.BASE))
    counts = [pii.of_kind("pii", i).cast("long").alias(f"n_{k.name}") for i, k in enumerate(pii.KINDS)]
    return rows.select("doc_id", *counts, F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
                       pii.joined(F.col("pii")).alias("spans"))


@_register
def op10_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors at a cosine of 0.9."""
    return embedding_neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Rules of the production url filter.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@_register
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url; hosts are judged by their links."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def _url_sql() -> str:
    up = f"'{url_filter.UPPER}', '{url_filter.LOWER}'"
    host = f"translate(regexp_extract(coalesce({{0}}, ''), '://([^/?#]*)', 1), {up})"
    fits = " ".join(
        f"WHEN (host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) "
        f"AND starts_with(path, '/{r.split('/', 1)[1]}') THEN '{v} {r}'"
        for v, r in sorted(URL_RULES, key=lambda r: -len(r[1])))
    href = url_filter.HREF.replace("\\x22'", "\\x22''")
    return f"""
WITH RECURSIVE u AS (SELECT page_id, {host.format('url')} AS host,
                  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, html FROM pages),
f AS (SELECT *, CASE {fits} END AS fit FROM u),
h AS (SELECT host, (1000000000000 * count(*) FILTER (fit LIKE 'allow%') // count(*))::BIGINT AS trust,
             (1000000000000 * count(*) FILTER (fit LIKE 'block%') // count(*))::BIGINT AS distrust
      FROM f WHERE host <> '' GROUP BY host),
k AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS link FROM u),
l AS (SELECT DISTINCT src, dst FROM (SELECT src, {host.format("CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END")} AS dst FROM k)
      WHERE src <> '' AND dst <> '' AND src <> dst),
b AS (SELECT 'trust' AS kind, src AS host, dst FROM l UNION ALL SELECT 'distrust', dst, src FROM l),
e AS MATERIALIZED (SELECT kind, host, dst, count(*) OVER (PARTITION BY kind, host) AS degree FROM b),
m0 AS MATERIALIZED (SELECT 'trust' AS kind, host, trust AS mass FROM h WHERE trust > 0
      UNION ALL SELECT 'distrust', host, distrust FROM h WHERE distrust > 0),
m AS (SELECT * FROM m0 UNION ALL
      SELECT m.kind, e.dst, sum(m.mass * 85 // 100 // degree)::BIGINT FROM m JOIN e ON m.kind = e.kind AND m.host = e.host
      GROUP BY m.kind, e.dst HAVING sum(m.mass * 85 // 100 // degree) > 0),
s AS (SELECT kind, host, sum(mass)::BIGINT * 15 // 100 AS score FROM m GROUP BY ALL),
r AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0)::BIGINT AS trust,
             coalesce(sum(score) FILTER (kind = 'distrust'), 0)::BIGINT AS distrust FROM s GROUP BY host)
SELECT page_id, f.host, path, substr(fit, 7) AS rule,
       CASE WHEN fit IS NOT NULL THEN substr(fit, 1, 5)
            WHEN coalesce(distrust, 0) - coalesce(trust, 0) > 75000000000 THEN 'block' ELSE 'allow' END AS verdict,
       coalesce(trust, 0)::BIGINT AS trust, coalesce(distrust, 0)::BIGINT AS distrust
FROM f LEFT JOIN r ON f.host = r.host
"""


ORACLES["op1_url_filter"] = _url_sql()


@_register
def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the pages as WARC files against a replica in which some records
    have changed bytes and some are gone."""
    def rotten(body: Column) -> Column:
        middle = F.floor(F.length(body) / 2).cast("int")
        return F.concat(F.substring(body, F.lit(1), middle), F.lit("~"), F.substring(body, middle + 2, F.length(body)))

    replica = F.when(F.col("page_id") % 97 == 13, rotten(F.col("body"))).otherwise(F.col("body"))
    index = cut(warc_fixity.warc_index(table(spark, sf_dir, "pages"), replica=replica))
    kept = index.filter("page_id is null or page_id % 211 <> 5")
    return warc_fixity.report(index, kept.select("file", "offset", F.col("replica").alias("digest")))


def _warc_sql() -> str:
    def tree(side: str) -> str:
        sql, below = "", f"rec_{side}"
        for i in range(warc_fixity.LEVELS + 1):
            at = "offs" if i == 0 else "node"
            node = f"offs // {warc_fixity.RANGE}" if i == 0 else \
                "node * 0" if i == warc_fixity.LEVELS else f"node // {warc_fixity.FAN_OUT}"
            sql += f"""
{side}{i} AS (SELECT file, {node} AS up, sha256(string_agg({at}::VARCHAR || ':' || digest, ',' ORDER BY {at})) AS digest,
      sum(n)::BIGINT AS n FROM (SELECT file, {at}, digest, n FROM {below}) GROUP BY file, {node}),"""
            below = f"(SELECT file, up AS node, digest, n FROM {side}{i})"
        return sql

    return f"""
WITH p AS (SELECT page_id, page_id // 500 AS file, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))::VARCHAR
      || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS body FROM pages),
o AS (SELECT *, coalesce(sum(strlen(body)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offs FROM p),
rec_a AS (SELECT file, offs, page_id, sha256(body) AS digest, 1 AS n FROM o),
rec_b AS (SELECT file, offs, page_id, sha256(CASE WHEN page_id % 97 = 13 THEN substr(body, 1, length(body) // 2) || '~' || substr(body, length(body) // 2 + 2) ELSE body END) AS digest, 1 AS n
      FROM o WHERE page_id % 211 <> 5),{tree('a')}{tree('b')}
d AS (SELECT a.file, a.offs, CASE WHEN b.digest IS NULL THEN 'missing' ELSE 'corrupt' END AS status
      FROM rec_a a LEFT JOIN rec_b b ON a.file = b.file AND a.offs = b.offs WHERE a.digest IS DISTINCT FROM b.digest),
g AS (SELECT file, count(*) AS n_bad, string_agg(offs::VARCHAR || ':' || status, ',' ORDER BY offs, status) AS bad FROM d GROUP BY file)
SELECT a.file, a.n AS n_records, a.digest AS root, b.digest AS replica_root, a.digest IS NOT DISTINCT FROM b.digest AS intact,
       coalesce(n_bad, 0)::BIGINT AS n_bad, coalesce(bad, '') AS bad
FROM a{warc_fixity.LEVELS} a LEFT JOIN b{warc_fixity.LEVELS} b ON a.file = b.file LEFT JOIN g ON a.file = g.file
"""


ORACLES["op4_warc_fixity"] = _warc_sql()


@_register
def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@_register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(*prefix_trie.lent_prefixes(table(spark, sf_dir, "conversations")))


ORACLES["op11_prefix_trie"] = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
             length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '') AS item, length(coalesce(text, '')) AS size
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS b, 4294967295 - list_reduce(
             list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                 lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc
      FROM (SELECT DISTINCT conv_id FROM t)),
h AS (SELECT conv_id, b, crc % 6 AS h FROM c),
r AS (SELECT h.conv_id, t.pos, 0 AS own, item, size FROM h JOIN t ON t.conv_id = h.b AND t.pos <= h.h
      UNION ALL SELECT h.conv_id, t.pos, 1, item, size FROM h JOIN t ON t.conv_id = h.conv_id AND t.pos > h.h),
s AS (SELECT h.conv_id, coalesce(items, []) AS items, coalesce(sizes, []) AS sizes FROM h LEFT JOIN (
      SELECT conv_id, list(item ORDER BY own, pos) AS items, list(size ORDER BY own, pos) AS sizes FROM r GROUP BY conv_id) USING (conv_id)),
p AS (SELECT conv_id, d AS depth, items[:d] AS prefix, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size, d = len(items) AS ends
      FROM (SELECT *, unnest(range(0, len(items) + 1)) AS d FROM s)),
n AS (SELECT prefix, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(size) AS size,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY prefix),
k AS (SELECT prefix[:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (prefix)),
u AS (SELECT prefix[:d] AS prefix, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * size) AS saved
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM m) GROUP BY 1)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves,
       u.saved::BIGINT AS saved_tokens, m.ends_sha256
FROM m JOIN u USING (prefix) LEFT JOIN n q ON m.depth > 0 AND q.prefix = m.prefix[:m.depth - 1]
"""


@_register
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_lexical_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
             lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ts FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
             lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ts FROM benchmark),
c AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS n, sum(len(ts))::BIGINT AS l FROM d),
f AS (SELECT rid, doc_id, n, t, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * c.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY t, c.n),
q AS (SELECT iid, item_id, t, count(*) AS times FROM (SELECT iid, item_id, unnest(ts) AS t FROM i) GROUP BY ALL),
s AS (SELECT iid, item_id, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * f.n * c.n) // c.l))))::BIGINT AS score
      FROM q JOIN f USING (t) JOIN w USING (t), c GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@_register
def op13_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors of largest integer inner product for every 100th vector."""
    return block_topk.top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op13_block_topk"] = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v),
             lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
