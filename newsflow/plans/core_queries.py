"""Queries over the relational, lifecycle, cleaning and reporting operators, each with its DuckDB oracle.

The reference ships no data, so inputs are derived from the driver's tables; both sides derive them by
the same expressions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from newsflow.functions import dates, urls
from newsflow.operators import buckets, cleaning, lifecycle, relational, reports
from newsflow.plans.catalog import register
from newsflow.session import table
from newsflow.sources.tables import new_path

HOST_SQL = r"lower(regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]*)', 1), '(?i)^www\.', ''))"


@register("q_domain_extract", f"SELECT page_id, {HOST_SQL} AS host, regexp_replace({HOST_SQL}, '\\.[^.]*$', '') AS domain, split_part(regexp_replace({HOST_SQL}, '\\.[^.]*$', ''), '.', 1) AS domain_key, regexp_replace(url, '/$', '') AS url_trim FROM pages")
def q_domain_extract(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.host(u).alias("host"), urls.extract_domain(u).alias("domain"), urls.domain_key(urls.extract_domain(u)).alias("domain_key"), urls.trim_slash(u).alias("url_trim"))


@register("q_url_segments", r"SELECT page_id, CAST(length(url) - length(replace(url, '/', '')) AS BIGINT) AS slashes, split_part(url, '/', -1) AS base, NOT regexp_matches(url, '\.html$') AS no_html, regexp_replace(url, '[^a-zA-Z0-9_-]', '', 'g') AS ident FROM pages")
def q_url_segments(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.slashes(u).alias("slashes"), urls.basename(u).alias("base"), (~u.rlike(r"\.html$")).alias("no_html"), urls.sanitize(u).alias("ident"))


_DATED = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE o_orderkey % 5
  WHEN 0 THEN strftime(o_orderdate, '/%Y/%m/%d/') WHEN 1 THEN strftime(o_orderdate, '-%Y%m%d-') WHEN 2 THEN strftime(o_orderdate, '/%d-%m-%Y/')
  WHEN 3 THEN strftime(o_orderdate, '/%Y-%m/') ELSE '/artikel/' END AS part FROM orders"""


@register("q_url_dates", f"""WITH u AS ({_DATED})
SELECT o_orderkey, CASE WHEN part = '/artikel/' THEN 'no_date' WHEN date_trunc('month', day) <= DATE '1998-06-15' AND last_day(day) >= DATE '1996-02-10' THEN 'in_range' ELSE 'out_of_range' END AS reason,
  CASE o_orderkey % 5 WHEN 0 THEN 'ymd' WHEN 1 THEN 'ymd_compact' WHEN 2 THEN 'dmy' WHEN 3 THEN 'ym' ELSE 'none' END AS pattern,
  CASE WHEN part <> '/artikel/' THEN CAST(date_trunc('month', day) AS DATE) END AS start FROM u""")
def q_url_dates(spark, d):
    day, k = F.col("o_orderdate"), F.col("o_orderkey")
    part = F.when(k % 5 == 0, F.date_format(day, "/yyyy/MM/dd/")).when(k % 5 == 1, F.date_format(day, "-yyyyMMdd-")).when(k % 5 == 2, F.date_format(day, "/dd-MM-yyyy/")).when(k % 5 == 3, F.date_format(day, "/yyyy-MM/")).otherwise("/artikel/")
    found = dates.url_date(F.concat(F.lit("https://news.example"), part, F.lit("a"), k % 10), "1996-02-10", "1998-06-15")
    return table(spark, d, "orders").select("o_orderkey", found.alias("f")).select("o_orderkey", "f.reason", "f.pattern", "f.start")


_LINKS = """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 4 <> 0 THEN strftime(l_shipdate, '%Y-%m-%d') || CASE WHEN l_orderkey % 2 = 0 THEN 'T10:00:00Z' ELSE '' END ELSE 'x' END AS lastmod, CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_shipdate AS DATE) END AS pub_date FROM lineitem"""


@register("q_date_range_filter", f"""WITH l AS ({_LINKS}), m AS (SELECT *, coalesce(pub_date, try_cast(CASE WHEN regexp_matches(regexp_replace(lastmod, 'T.*$', ''), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN regexp_replace(lastmod, 'T.*$', '') END AS DATE)) AS date FROM l)
SELECT l_orderkey, l_linenumber, date FROM m WHERE date IS NULL OR date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""")
def q_date_range_filter(spark, d):
    k = F.col("l_orderkey")
    lastmod = F.when(k % 4 != 0, F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.when(k % 2 == 0, "T10:00:00Z").otherwise(""))).otherwise("x")
    date = F.coalesce(F.when(k % 3 != 0, F.col("l_shipdate").cast("date")), dates.iso_date(lastmod))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", date.alias("date"))
    return rows.where(F.col("date").isNull() | F.col("date").between(F.lit("1996-01-01").cast("date"), F.lit("1997-12-31").cast("date")))


@register("q_filter_tiers", """SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)small') THEN 'media_sitemaps' WHEN regexp_matches(p_name, '(?i)ring|bolt') THEN 'irrelevant_sitemaps' WHEN p_size % 7 = 0 THEN 'html contents'
 WHEN regexp_matches(p_name, '(?i)large') THEN 'dynamic websites' WHEN p_name IN ('red box', 'blue box') THEN 'excluded_sitemaps' WHEN p_size % 5 = 0 THEN 'missing sitemap content' END AS filtered_because FROM part""")
def q_filter_tiers(spark, d):
    parts = table(spark, d, "part").withColumn("body", F.when(F.col("p_size") % 7 == 0, "<!DOCTYPE html>x").when(F.col("p_size") % 5 != 0, "<urlset/>"))
    return cleaning.tiers(parts, "p_name", "body", {"media": ["small"], "irrelevant": ["ring", "bolt"]}, ["large"], ["red box", "blue box"]).select("p_partkey", "filtered_because")


@register("q_first_per_key", "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n = 1")
def q_first_per_key(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return relational.first_per_key(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]).drop("l_suppkey")


@register("q_latest_row", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def q_latest_row(spark, d):
    return relational.latest(table(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", F.col("event_id"))


@register("q_dup_groups", "SELECT doc_id, group_size FROM (SELECT doc_id, count(*) OVER (PARTITION BY md5(text)) AS group_size FROM documents) WHERE group_size > 1")
def q_dup_groups(spark, d):
    marked = table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("k"))
    return relational.duplicate_groups(marked, ["k"]).select("doc_id", "group_size")


@register("q_any_dup", "SELECT count(*) AS n, count(DISTINCT text) AS n_distinct, count(*) <> count(DISTINCT text) AS any_dup FROM documents")
def q_any_dup(spark, d):
    marked = table(spark, d, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("k"))
    return marked.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("k").alias("n_distinct")).withColumn("any_dup", F.col("n") != F.col("n_distinct"))


@register("q_union_fill", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def q_union_fill(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return relational.union_fill(a, b)


@register("q_append_aligned", "SELECT c_custkey AS id, c_name AS name, try_cast(c_name AS DOUBLE) AS score FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def q_append_aligned(spark, d):
    target = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("score"))
    source = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("score"), F.lit(1).alias("more"))
    return target.unionByName(relational.aligned(source, target))


def _nations(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))


@register("q_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def q_except(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, d, "orders").where("o_totalprice > 300000").select("o_custkey"))


@register("q_intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def q_intersect(spark, d):
    a, b = _nations(spark, d)
    return a.intersect(b)


@register("q_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def q_union_distinct(spark, d):
    a, b = _nations(spark, d)
    return a.union(b).distinct()


# Rules for the synthetic pages: shapes like those of the reference, values of our own.
_RULES = [("news.example.com", "path", "/en/"), ("news.example.com", "path", "https://news.example.com/de/"), ("blog.example.com", "path", "fr/.*[02468]"), ("news.example.com", "rlike", "index\\.html$"), ("m.example.com", "slashes", "4"), ("example.com", "segments", "1"), ("blog.example.com", "rlike", "[?]q=")]


def _hosts(spark, d):
    return table(spark, d, "pages").select("page_id", "url")


_RULE_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _RULES) + ") AS r(domain, kind, pattern)"
_REASON_SQL = f"""WITH p AS (SELECT page_id, url, {HOST_SQL} AS host, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/]*(/[^?#]*)?', 1) AS path FROM pages),
r AS (SELECT * FROM {_RULE_SQL}),
paths AS (SELECT domain, '^https?://(www\\.)?' || replace(domain, '.', '\\.') || '/.*?(' || string_agg(rel, '|' ORDER BY rel) || ')' AS pattern FROM (SELECT domain, regexp_replace(regexp_replace(pattern, '^https?://(?:www\\.)?[^/]+', ''), '^/', '') AS rel FROM r WHERE kind = 'path') GROUP BY domain),
s AS (SELECT p.page_id, bool_or(CASE kind WHEN 'rlike' THEN regexp_matches(url, pattern) WHEN 'segments' THEN len(list_filter(string_split(path, '/'), lambda x: x <> '')) = try_cast(pattern AS INT) WHEN 'slashes' THEN length(url) - length(replace(url, '/', '')) = try_cast(pattern AS INT) ELSE false END) AS hit FROM p JOIN r ON p.host = r.domain AND kind <> 'path' GROUP BY p.page_id),
m AS (SELECT p.*, CASE WHEN p.page_id % 17 = 0 THEN 'exact_match' WHEN paths.pattern IS NOT NULL AND regexp_matches(url, paths.pattern) THEN 'path_rule' WHEN s.hit THEN 'special_rule' END AS reason FROM p LEFT JOIN paths ON p.host = paths.domain LEFT JOIN s ON p.page_id = s.page_id)"""


def _cleaned(spark, d):
    pages = _hosts(spark, d)
    rules = spark.createDataFrame(_RULES, cleaning.RULES)
    exact = pages.where("page_id % 17 = 0").select(F.concat("url", F.lit("#"), "page_id").alias("url"))
    keyed = pages.withColumn("url", F.when(F.col("page_id") % 17 == 0, F.concat("url", F.lit("#"), "page_id")).otherwise(F.col("url")))
    return cleaning.clean(keyed, exact, rules)


@register("q_clean_precedence", f"{_REASON_SQL} SELECT page_id, reason FROM m")
def q_clean_precedence(spark, d):
    return _cleaned(spark, d).select("page_id", "reason")


@register("q_discard_stats", f"{_REASON_SQL} SELECT host, count(*) FILTER (WHERE reason = 'exact_match') AS exact_match, count(*) FILTER (WHERE reason = 'path_rule') AS path_rule, count(*) FILTER (WHERE reason = 'special_rule') AS special_rule FROM m WHERE reason IS NOT NULL GROUP BY host")
def q_discard_stats(spark, d):
    gone = _cleaned(spark, d).where("reason is not null").withColumn("host", urls.host(F.col("url")))
    return gone.groupBy("host").agg(*[F.count_if(F.col("reason") == r).alias(r) for r in ("exact_match", "path_rule", "special_rule")])


@register("q_anti_exact", f"SELECT page_id FROM pages WHERE {HOST_SQL} NOT IN (SELECT {HOST_SQL} FROM pages WHERE page_id % 10 = 0)")
def q_anti_exact(spark, d):
    pages = _hosts(spark, d).withColumn("host", urls.host(F.col("url")))
    return pages.join(pages.where("page_id % 10 = 0").select("host"), "host", "left_anti").select("page_id")


@register("q_anti_path_rule", f"{_REASON_SQL} SELECT p.page_id FROM p WHERE NOT EXISTS (SELECT 1 FROM paths WHERE paths.domain = p.host AND regexp_matches(p.url, paths.pattern))")
def q_anti_path_rule(spark, d):
    pages = _hosts(spark, d).withColumn("domain", urls.host(F.col("url")))
    paths = cleaning.path_patterns(spark.createDataFrame(_RULES, cleaning.RULES))
    return pages.alias("p").join(paths.alias("r"), (F.col("p.domain") == F.col("r.domain")) & F.regexp_like("p.url", F.col("r.pattern")), "left_anti").select("page_id")


@register("q_archive", "WITH old AS (SELECT o_custkey AS k, o_orderkey, 0 AS age FROM orders WHERE o_orderstatus = 'F'), new AS (SELECT o_custkey, o_orderkey, 1 FROM orders WHERE o_orderstatus <> 'F'), u AS (SELECT * FROM old UNION ALL SELECT * FROM new) SELECT 'u/' || k AS url, CAST(age AS INT) AS run FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY age, o_orderkey) AS n FROM u) WHERE n = 1")
def q_archive(spark, d):
    orders = table(spark, d, "orders")
    old = orders.where("o_orderstatus = 'F'").select(F.concat(F.lit("u/"), "o_custkey").alias("url"), F.lit(0).alias("run"), F.lit("2025-01-01").cast("timestamp").alias("deleted_at"))
    new = orders.where("o_orderstatus <> 'F'").select(F.concat(F.lit("u/"), "o_custkey").alias("url"), F.lit(1).alias("run"))
    return cleaning.archive(old, new, F.lit("2025-02-01").cast("timestamp")).select("url", "run")


#: Every order is in one of the tables or in several.
_STATUS = {"final_data": "o_orderstatus = 'F'", "parse_error": "o_orderpriority like '1%' or o_orderstatus = 'P'", "error": "o_orderpriority like '2%' or o_totalprice > 200000", "retry": "o_orderstatus <> 'F'"}


def _status_tables(spark, d):
    url = F.concat(F.lit("u/"), "o_orderkey", F.when(F.col("o_orderkey") % 4 < 2, "/").otherwise("")).alias("url")
    return {name: table(spark, d, "orders").where(rule).select(F.col("o_orderkey").alias("id"), url) for name, rule in _STATUS.items()}


@register("q_priority_dedup", f"SELECT o_orderkey AS id, 'u/' || o_orderkey AS url, CASE {' '.join(f"WHEN {rule} THEN '{name}'" for name, rule in _STATUS.items())} END AS status FROM orders")
def q_priority_dedup(spark, d):
    return lifecycle.priority_dedup(_status_tables(spark, d)).select("id", "url", "status")


@register("q_status_flags", f"SELECT o_orderkey, {_STATUS['final_data']} AS processed, {_STATUS['parse_error']} AS parse_error, {_STATUS['error']} AS error, {_STATUS['retry']} AS retry FROM orders")
def q_status_flags(spark, d):
    tables = {n: t.withColumn("url", urls.trim_slash(F.col("url"))) for n, t in _status_tables(spark, d).items()}
    links = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("u/"), "o_orderkey").alias("url"), F.lit(True).alias("processed"))
    return lifecycle.status_flags(links, tables).drop("url")


def _laid_out(spark, d):
    """The four status tables in buckets of their URL."""
    names = {n: f"store_{n}_{uuid.uuid4().hex}" for n in _STATUS}
    return {n: buckets.lay_out(t, names[n], new_path(spark, n), 8) for n, t in _status_tables(spark, d).items()}


@register("q_bucketed_priority", f"SELECT o_orderkey AS id, 'u/' || o_orderkey AS url, CASE {' '.join(f"WHEN {rule} THEN '{name}'" for name, rule in _STATUS.items())} END AS status FROM orders")
def q_bucketed_priority(spark, d):
    """G11, I3 over stores that are laid out by URL."""
    return buckets.priority(_laid_out(spark, d)).select("id", "url", "status")


@register("q_bucketed_flags", f"SELECT o_orderkey, {_STATUS['final_data']} AS processed, {_STATUS['parse_error']} AS parse_error, {_STATUS['error']} AS error, {_STATUS['retry']} AS retry FROM orders")
def q_bucketed_flags(spark, d):
    """G12, D8 over stores that are laid out by URL, the links too."""
    links = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("u/"), "o_orderkey").alias("url"), F.lit(True).alias("processed"))
    laid = buckets.lay_out(links, f"links_{uuid.uuid4().hex}", new_path(spark, "links"), 8)
    return buckets.flags(laid, _laid_out(spark, d)).drop("url")


@register("q_bucketed_unseen", f"SELECT o_orderkey FROM orders WHERE NOT ({' OR '.join(f"coalesce({rule}, false)" for n, rule in _STATUS.items() if n != 'retry')})")
def q_bucketed_unseen(spark, d):
    """Rows of a run that three stores don't have; only the run is shuffled."""
    run = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("u/"), "o_orderkey", F.lit("/")).alias("url"))
    return buckets.unseen(run, [s for n, s in _laid_out(spark, d).items() if n != "retry"]).select("o_orderkey")


@register("q_append_new", "SELECT 'u/' || o_orderkey AS url, o_orderstatus <> 'O' AS old FROM orders")
def q_append_new(spark, d):
    t = table(spark, d, "orders").select("o_orderstatus", F.concat(F.lit("u/"), "o_orderkey").alias("url"))
    a, b = t.where("o_orderstatus <> 'O'").select("url", F.lit(True).alias("old")), t.where("o_orderstatus <> 'F'").select("url", F.lit(False).alias("old"))
    return lifecycle.append_new(a, b)


@register("q_upsert", "SELECT coalesce(a.k, b.k) AS k, coalesce(b.v, a.v) AS v, coalesce(a.first_seen, b.first_seen) AS first_seen FROM (SELECT o_orderkey AS k, o_orderstatus AS v, 1 AS first_seen FROM orders WHERE o_orderstatus <> 'O') a FULL JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS v, 2 AS first_seen FROM orders WHERE o_orderstatus <> 'F') b ON a.k = b.k")
def q_upsert(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"), F.lit(1).alias("first_seen"))
    new = o.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("v"), F.lit(2).alias("first_seen"))
    return lifecycle.upsert(old, new, "k", ("first_seen",))


@register("q_purge_domain", f"SELECT page_id FROM pages WHERE NOT (coalesce({HOST_SQL} = 'news.example.com', false) OR regexp_matches(url, '^https?://(?:www\\.)?news[.]example[.]com(?:[./]|$)'))")
def q_purge_domain(spark, d):
    pages = _hosts(spark, d).withColumn("domain", urls.host(F.col("url")))
    return lifecycle.purge_domain(pages, "news.example.com").select("page_id")


@register("q_left_coalesce", "SELECT o_orderkey, coalesce(c_name, 'none') AS name, coalesce(c_mktsegment, o_orderpriority) AS label FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) ON o_custkey = c_custkey")
def q_left_coalesce(spark, d):
    some = table(spark, d, "customer").where("c_custkey % 3 = 0")
    return table(spark, d, "orders").join(some, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", F.coalesce("c_name", F.lit("none")).alias("name"), F.coalesce("c_mktsegment", "o_orderpriority").alias("label"))


_LOGS = "a AS (SELECT l_orderkey AS url, l_linenumber AS n, l_returnflag AS m FROM lineitem WHERE l_linenumber <= 2), b AS (SELECT l_orderkey AS url, l_linenumber AS n2, l_returnflag AS m2 FROM lineitem WHERE l_linenumber > 2)"


def _logs(spark, d):
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("url"), "l_linenumber", F.col("l_returnflag").alias("m"))
    return t.where("l_linenumber <= 2").withColumnRenamed("l_linenumber", "n"), t.where("l_linenumber > 2").select("url", F.col("l_linenumber").alias("n2"), F.col("m").alias("m2"))


@register("q_two_key_join", f"WITH {_LOGS} SELECT a.url, n, n2, m FROM a JOIN b ON a.url = b.url AND m = m2")
def q_two_key_join(spark, d):
    a, b = _logs(spark, d)
    return a.join(b.withColumnRenamed("m2", "m"), ["url", "m"]).select("url", "n", "n2", "m")


@register("q_theta_join", f"WITH {_LOGS} SELECT a.url, n, n2, m, m2 FROM a JOIN b ON a.url = b.url AND m <> m2")
def q_theta_join(spark, d):
    a, b = _logs(spark, d)
    return a.join(b, (a.url == b.url) & (a.m != b.m2)).select(a.url, "n", "n2", "m", "m2")


@register("q_grid_fill", """WITH k AS (SELECT DISTINCT event_type AS key FROM events), g AS (SELECT key, CAST(day AS DATE) AS day FROM k, generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY) AS s(day)),
 c AS (SELECT CAST(ts AS DATE) AS day, event_type AS key, count(*) AS n FROM events GROUP BY ALL) SELECT day, key, coalesce(n, 0) AS n, n IS NULL AS zero_flag FROM g LEFT JOIN c USING (day, key)""")
def q_grid_fill(spark, d):
    rows = table(spark, d, "events").select(F.col("ts").cast("date").alias("d"), "event_type")
    return relational.grid_counts(rows, "d", "event_type", "2024-01-01", "2024-02-05")


@register("q_shuffle_limit", "SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || 's1'), doc_id LIMIT 100")
def q_shuffle_limit(spark, d):
    return relational.sample(table(spark, d, "documents").select("doc_id"), "doc_id", 100, "s1")


@register("q_round_robin", "SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS seq, dense_rank() OVER (ORDER BY md5(source || 's2'), source) AS turn FROM documents")
def q_round_robin(spark, d):
    return relational.round_robin(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", "s2").select("doc_id", "seq", "turn")


@register("q_strat_sample", """WITH t AS (SELECT l_returnflag || l_linestatus AS s, l_orderkey * 10 + l_linenumber AS k FROM lineitem), c AS (SELECT s, count(*) AS n FROM t GROUP BY s), a AS (SELECT sum(n) AS al FROM c),
 q AS (SELECT s, n, CAST(n AS DOUBLE) / al * 1001 AS e, least(CAST(round_even(CAST(n AS DOUBLE) / al * 1001, 0) AS BIGINT), n) AS q FROM c, a), r AS (SELECT 1001 - sum(q) AS rest FROM q),
 u AS (SELECT s, q, rest, row_number() OVER (PARTITION BY n > q ORDER BY e - floor(e) DESC, s) AS up, row_number() OVER (PARTITION BY q > 0 ORDER BY e - floor(e), s DESC) AS down, n > q AS room FROM q, r),
 w AS (SELECT s, q + CASE WHEN rest > 0 AND room AND up <= rest THEN 1 WHEN rest < 0 AND q > 0 AND down <= -rest THEN -1 ELSE 0 END AS quota FROM u)
 SELECT t.s, k FROM (SELECT s, k, row_number() OVER (PARTITION BY s ORDER BY md5(CAST(k AS VARCHAR) || 's3'), k) AS n FROM t) t JOIN w ON t.s = w.s WHERE t.n <= quota""")
def q_strat_sample(spark, d):
    t = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("s"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return relational.stratified_sample(t, "s", "k", 1001, "s3").select("s", "k")


_FLAGS = "SELECT o_orderpriority AS domain, o_orderstatus = 'F' AS processed, o_orderstatus = 'P' AS error, o_orderkey % 11 = 0 AS parse_error FROM orders"
_PROGRESS = f"SELECT domain, count(*) AS input_links, count(*) FILTER (WHERE processed) AS n_processed, count(*) FILTER (WHERE error) AS n_error, count(*) FILTER (WHERE parse_error) AS n_parse_error, count(*) FILTER (WHERE NOT processed AND NOT error AND NOT parse_error) AS n_remaining FROM ({_FLAGS}) GROUP BY domain"


def _progress(spark, d):
    s = F.col("o_orderstatus")
    return reports.progress(table(spark, d, "orders").select(F.col("o_orderpriority").alias("domain"), (s == "F").alias("processed"), (s == "P").alias("error"), (F.col("o_orderkey") % 11 == 0).alias("parse_error")))


@register("q_progress_report", f"SELECT *, round_even((n_processed + n_error) / input_links * 100, 2) AS progress_rate FROM ({_PROGRESS})")
def q_progress_report(spark, d):
    return _progress(spark, d)


@register("q_unpivot_status", f"WITH p AS ({_PROGRESS}) SELECT domain, status, round_even(n / input_links * 100, 2) AS share, ordinal FROM (SELECT domain, input_links, unnest(['processed', 'error', 'parse_error', 'remaining']) AS status, unnest([n_processed, n_error, n_parse_error, n_remaining]) AS n, unnest([1, 2, 3, 4]::BIGINT[]) AS ordinal FROM p)")
def q_unpivot_status(spark, d):
    return reports.long_shares(_progress(spark, d))


@register("q_response_summary", "SELECT coalesce(CASE WHEN event_type <> 'view' THEN event_type END, 'unknown') AS label, count(*) AS n, round_even(count(*) / sum(count(*)) OVER () * 100, 2) AS pct FROM events GROUP BY 1")
def q_response_summary(spark, d):
    return reports.summary(table(spark, d, "events"), F.when(F.col("event_type") != "view", F.col("event_type")))


@register("q_chunk_delta", "WITH t AS (SELECT o_orderkey % 2 AS h, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done FROM orders GROUP BY 1), l AS (UNPIVOT t ON n_rows, n_customers, n_done INTO NAME measure VALUE v) SELECT a.measure, a.v AS before, b.v AS after, b.v - a.v AS delta FROM l a JOIN l b ON a.measure = b.measure AND a.h = 0 AND b.h = 1")
def q_chunk_delta(spark, d):
    o = table(spark, d, "orders")
    measures = {"n_rows": F.count(F.lit(1)), "n_customers": F.countDistinct("o_custkey"), "n_done": F.count_if(F.col("o_orderstatus") == "F")}
    return reports.deltas(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), measures)


@register("q_overview_rollup", """WITH o AS (SELECT o_custkey AS k, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final FROM orders GROUP BY 1), l AS (SELECT o_custkey AS k, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
 SELECT n_name AS domain, count(*) AS n_sitemaps, CAST(sum(coalesce(n_orders, 0)) AS BIGINT) AS n_orders, CAST(sum(coalesce(n_final, 0)) AS BIGINT) AS n_final, CAST(sum(coalesce(n_lines, 0)) AS BIGINT) AS n_lines, CAST(sum(coalesce(n_returned, 0)) AS BIGINT) AS n_returned
 FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN o ON o.k = c_custkey LEFT JOIN l ON l.k = c_custkey GROUP BY 1""")
def q_overview_rollup(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    o = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderstatus") == "F").alias("n_final"))
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    lines = per.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("n").alias("n_lines"), F.sum("r").alias("n_returned"))
    measures = ["n_orders", "n_final", "n_lines", "n_returned"]
    sitemaps = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(o, "c_custkey", "left").join(lines, "c_custkey", "left").na.fill(0, measures)
    rolled = sitemaps.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_sitemaps"), *[F.sum(m).alias(m) for m in measures])
    return rolled.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("domain"), "n_sitemaps", *measures)


_FIELDS = "SELECT doc_id, CASE WHEN quality = 1 THEN source WHEN quality = 0 THEN ' ' END AS author, CASE WHEN n_chars % 3 = 0 THEN lang END AS headline, toxic FROM documents LEFT JOIN labels USING (doc_id)"


def _fields(spark, d):
    j = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    return j.select("doc_id", F.when(F.col("quality") == 1, F.col("source")).when(F.col("quality") == 0, " ").alias("author"), F.when(F.col("n_chars") % 3 == 0, F.col("lang")).alias("headline"), "toxic", "quality")


@register("q_field_completeness", f"WITH f AS ({_FIELDS}), c AS (SELECT count(nullif(trim(author), '')) AS author, count(nullif(trim(headline), '')) AS headline, count(toxic) AS toxic, count(*) AS al FROM f), l AS (UNPIVOT c ON author, headline, toxic INTO NAME field VALUE n_filled) SELECT field, n_filled, round_even(n_filled / al * 100, 2) AS pct FROM l")
def q_field_completeness(spark, d):
    return reports.completeness(_fields(spark, d), ["author", "headline", "toxic"])


@register("q_agreement", "WITH j AS (SELECT quality, toxic, lang, source FROM documents LEFT JOIN labels USING (doc_id)), r AS (SELECT round_even(avg(CASE WHEN quality IS NOT DISTINCT FROM toxic THEN 1 ELSE 0 END) * 100, 2) AS labels, round_even(avg(CASE WHEN lang IS NOT DISTINCT FROM source THEN 1 ELSE 0 END) * 100, 2) AS names, round_even(avg((CASE WHEN quality IS NOT DISTINCT FROM toxic THEN 1 ELSE 0 END + CASE WHEN lang IS NOT DISTINCT FROM source THEN 1 ELSE 0 END) / 2) * 100, 2) AS overall FROM j) SELECT field, pct FROM (UNPIVOT r ON labels, names, overall INTO NAME field VALUE pct)")
def q_agreement(spark, d):
    j = table(spark, d, "documents").select("doc_id", "lang", "source").join(table(spark, d, "labels"), "doc_id", "left")
    return reports.agreement(j, {"labels": ("quality", "toxic"), "names": ("lang", "source")})


@register("q_group_label", "SELECT s_suppkey, CASE WHEN count(*) OVER (PARTITION BY s_nationkey) > 1 THEN 'multiple' ELSE 'one' END AS label, max(CAST(s_acctbal > 5000 AS INT)) OVER (PARTITION BY s_nationkey) = 0 AS only_failed FROM supplier")
def q_group_label(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("s_nationkey")
    return table(spark, d, "supplier").select("s_suppkey", F.when(F.count(F.lit(1)).over(w) > 1, "multiple").otherwise("one").alias("label"), (F.max((F.col("s_acctbal") > 5000).cast("int")).over(w) == 0).alias("only_failed"))


@register("q_dense_ids", "SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) AS domain_id, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS seq FROM customer")
def q_dense_ids(spark, d):
    from pyspark.sql import Window

    ids = relational.dense_ids(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "domain_id")
    return ids.select("c_custkey", "domain_id", F.row_number().over(Window.partitionBy("c_mktsegment").orderBy("c_custkey")).cast("long").alias("seq"))


@register("q_halves", "SELECT n_name, ntile(2) OVER (ORDER BY n_name) AS half FROM nation")
def q_halves(spark, d):
    from pyspark.sql import Window

    # a list of domains, as plots take it
    return table(spark, d, "nation").select("n_name", F.ntile(2).over(Window.orderBy("n_name")).cast("long").alias("half"))


@register("q_schema_check", "SELECT * FROM (VALUES (1::BIGINT, 'o_orderkey', 'bigint', 'bigint', true, 0::BIGINT), (2, 'o_custkey', 'int', 'bigint', true, 0), (3, 'o_orderstatus', 'string', 'string', true, (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))), (4, 'missing', 'string', NULL, false, 0)) AS t(position, column_name, expected_type, found_type, in_place, bad_values)")
def q_schema_check(spark, d):
    return lifecycle.schema_report(table(spark, d, "orders"), [("o_orderkey", "bigint", None), ("o_custkey", "int", None), ("o_orderstatus", "string", "F; O"), ("missing", "string", "a;b")])


@register("q_chunk_number", "SELECT 'chunk_' || lpad(CAST(max(o_orderkey % 90) + 1 AS VARCHAR), 3, '0') AS next_chunk FROM orders")
def q_chunk_number(spark, d):
    from newsflow.sources.tables import next_chunk

    return table(spark, d, "orders").select(F.concat(F.lit("chunk_"), F.lpad((F.col("o_orderkey") % 90).cast("string"), 3, "0")).alias("c")).agg(next_chunk(F.col("c")).alias("next_chunk"))
