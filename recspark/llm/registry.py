"""The queries of this subpackage, each over a whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import archives, collocations, divergence, jaccard_join, language_id, mixing, packing, pieces, quality_model, rule_lists, sharding, url_filter, weighted_sampling
from recspark.sources.scratch import new_path, table


def held_out() -> Column:
    """Labels of documents with this remainder are held out: learning never sees them."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"), where=~held_out())
    out = quality_model.scored(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.segments(packing.write_packs(table(spark, sf_dir, "documents"), new_path(spark, "packs")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_groups(table(spark, sf_dir, "documents"), n=3, percent=90)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.digest(sharding.shuffle_into_shards(docs, 40, sharding.new_shard_path(docs)))


def op5_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archived_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.compare_with_edits(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_rows(mixing.plan_copies(mixing.narrow_rows(table(spark, sf_dir, "documents"))))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rule_lists.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(*first, *[c for c in out.columns if c not in first])


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = url_filter.filter_urls(pages, url_filter.listed_from(pages), url_filter.RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "canonical_url", "listed")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.identify(docs, language_id.fit(docs, where=~held_out()), ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


QUERIES = {
    "op1_quality_model": op1_quality_model,
    "op2_packing": op2_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_sharding": op4_sharding,
    "op5_archives": op5_archives,
    "op6_fingerprints": op6_fingerprints,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_pieces": op9_pieces,
    "op10_url_filter": op10_url_filter,
    "op11_divergence": op11_divergence,
    "op12_collocations": op12_collocations,
    "op13_language": op13_language,
}

OP10_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    regexp_extract(url, '^.*?://[^/?#]*[^?#]*(\?[^#]*)?', 1, 's') AS rest
  FROM pages),
canon AS (
  SELECT page_id, host, path, CASE WHEN contains(url, '://') THEN
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
    || regexp_replace(regexp_replace(rest, '([?&])utm_[^&]*(&|$)', '\1', 'g'), '[?&]+$', '') END AS canonical_url
  FROM parts),
listed AS (SELECT DISTINCT canonical_url FROM canon WHERE regexp_matches(host, '(^|\.)(ads-track|adult-x|casino-win)\.') AND canonical_url IS NOT NULL),
ruled AS (
  SELECT c.*, l.canonical_url IS NOT NULL AS listed, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM canon c LEFT JOIN listed l USING (canonical_url))
SELECT page_id, host, path, canonical_url, rule, listed,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP5_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, min(page_id) AS original FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN original IS NULL OR original IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN original IS DISTINCT FROM page_id THEN original END AS refers_to
FROM p LEFT JOIN first ON p.payload_digest = first.payload_digest AND payload_bytes >= 100
"""

OP3_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS q FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.q = b.q AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT doc_id AS id, doc_id AS root FROM sets UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id)
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN (SELECT id, min(root) AS component_id FROM reach GROUP BY 1) ON id = doc_id
"""

OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, term, sum(c)::BIGINT AS n, count(*) AS docs FROM (SELECT i, lang, source, term, count(*) AS c FROM (SELECT i, lang, source, unnest(w) AS term FROM d) GROUP BY ALL) GROUP BY 1, 2, 3),
kept AS (SELECT lang, term, sum(n)::BIGINT AS n FROM t GROUP BY 1, 2 HAVING sum(docs) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
vocabulary AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY 1),
cells AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(t.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
shares AS (SELECT c.*, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY c.lang, source) + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 2)) // (total + 2 * v) AS q FROM cells c JOIN vocabulary USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) s
  ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts) WHERE part = 'pair' OR rank <= 10
"""

OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3), (4), (5)) v(m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY 1),
cand AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND a >= 100),
inner_ AS (SELECT DISTINCT lang, a, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM cand, range(2, 5) x(k), range(1, 5) y(i) WHERE k < m AND i + k - 1 <= m),
largest AS (SELECT lang, phrase, max(a) AS outer_a FROM inner_ GROUP BY 1, 2),
left_over AS (SELECT c.* FROM cand c LEFT JOIN largest USING (lang, phrase) WHERE outer_a IS NULL OR 100 * outer_a < 100 * a),
cuts AS (SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r, n.n, (1000::HUGEINT * c.a * n.n) // (h.a::HUGEINT * t.a) AS score
  FROM left_over c, range(1, 5) x(k), f h, f t, n WHERE k < c.m AND h.lang = c.lang AND h.phrase = array_to_string(ws[1:k], ' ') AND t.lang = c.lang AND t.phrase = array_to_string(ws[k + 1:], ' ') AND n.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE o = 1) WHERE rank <= 2000
"""

SQL = {"op3_jaccard_join": OP3_SQL, "op5_archives": OP5_SQL, "op10_url_filter": OP10_SQL, "op11_divergence": OP11_SQL, "op12_collocations": OP12_SQL}
