"""Queries over the sinks of a run, its stores, the workbench and the files around them, each with its DuckDB oracle."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from newsflow.functions import dates, urls
from newsflow.operators import discovery, extract, relational, reports, responses, runlog, sitemaps, workbench
from newsflow.plans.catalog import register
from newsflow.session import table
from newsflow.sources import commits, page_files, tables

# A response log from events: every event is a request; its type decides what came of it.
_ROUTE = "CASE event_type WHEN 'purchase' THEN 'output' WHEN 'signup' THEN 'output' WHEN 'error' THEN 'error' WHEN 'click' THEN 'retry' ELSE 'parse_error' END"
_STATUS = "CASE event_type WHEN 'error' THEN 410 WHEN 'click' THEN 429 ELSE 200 END"
_EVENTS = f"SELECT event_id, ts, 'd' || user_id AS domain, 'https://d' || user_id || '.de/' || event_type AS url, {_ROUTE} AS route, {_STATUS} AS status_code, event_type, user_id, value FROM events"


def _events(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", "ts", F.concat(F.lit("d"), "user_id").alias("domain"), F.concat(F.lit("https://d"), "user_id", F.lit(".de/"), "event_type").alias("url"), F.expr(_ROUTE).alias("route"), F.expr(_STATUS).alias("status_code"), "event_type", "user_id", "value")


def _log(spark, d):
    return _events(spark, d).select(F.col("event_id").alias("request_id"), (F.col("event_id") * 10).alias("response_id"), "domain", "url", F.col("event_type").alias("from_chunk"), "status_code")


def _routed(spark, d):
    e = _events(spark, d)
    return e.select(F.col("event_id").alias("id"), "domain", "url", F.lit("t").alias("timestamp_scraped"), F.when(F.col("route") == "output", "2024-01-01").alias("date_time"), F.lit("a").alias("author"), F.lit("h").alias("headline"), F.col("event_type").alias("text"), F.lit(False).alias("paywall"), F.lit("<p>").alias("html_content"), "route", F.concat(F.lit("why_"), "event_type").alias("reason"), F.col("event_type").alias("from_chunk"))


@register("q_sinks", f"""WITH e AS ({_EVENTS}), l AS (SELECT url, event_type, max(event_id) AS m FROM e GROUP BY 1, 2)
 SELECT CASE route WHEN 'output' THEN 'final_data' ELSE route END AS store, event_id AS id, e.url, CASE WHEN route IN ('retry', 'error') THEN 'why_' || e.event_type END AS reason, CASE route WHEN 'retry' THEN m * 10 END AS response_id, CASE route WHEN 'retry' THEN m END AS request_id, CASE route WHEN 'parse_error' THEN '<p>' END AS html_content, CASE WHEN route IN ('output', 'parse_error') THEN e.event_type END AS text
 FROM e JOIN l ON e.url = l.url AND e.event_type = l.event_type""")
def q_sinks(spark, d):
    """The four sinks of routed responses."""
    found = runlog.sinks(_routed(spark, d), _log(spark, d))
    every = relational.union_fill(*[t.withColumn("store", F.lit(name)) for name, t in found.items()])
    return every.select("store", "id", "url", F.coalesce("retry_reason", "error_reason").alias("reason"), "response_id", "request_id", "html_content", "text")


@register("q_request_log", """WITH o AS (SELECT event_id AS request_id, ts, event_type AS agent, CAST(value AS VARCHAR) IS NULL AS x FROM events WHERE event_type = 'view'), m AS (SELECT max(request_id) AS m FROM o)
 SELECT request_id, event_type AS agent FROM (SELECT event_id AS request_id, event_type FROM events WHERE event_type = 'view')
 UNION ALL SELECT m + row_number() OVER (ORDER BY ts, event_id), CASE WHEN event_type <> 'click' THEN event_type END FROM events, m WHERE event_type <> 'view'""")
def q_request_log(spark, d):
    """Rows numbered on from the log's largest id; blanks become null, columns those of the log."""
    e = table(spark, d, "events").select("event_id", "ts", F.col("event_type").alias("agent"))
    log = e.where("agent = 'view'").select(F.col("event_id").alias("request_id"), "agent")
    new = e.where("agent <> 'view'").withColumn("agent", F.when(F.col("agent") == "click", "  ").otherwise(F.col("agent"))).withColumn("unknown", F.lit(1))
    return log.unionByName(runlog.log_rows(log, new, ["ts", "event_id"], "request_id"))


@register("q_response_log", """SELECT row_number() OVER (ORDER BY ts, event_id) AS response_id, 'd' || user_id AS domain, CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'retry' WHEN 'signup' THEN 'retry' ELSE 'parse' END AS action,
 CASE event_type WHEN 'error' THEN 'http_error_410' WHEN 'click' THEN 'http_error_429' WHEN 'signup' THEN 'bot_detected' ELSE 'valid' END AS response_analysis, substr(repeat(event_type || ' ', 500), 1, 2000) AS body_snippet FROM events""")
def q_response_log(spark, d):
    """Analysed responses with snippets of their bodies, as log rows."""
    e = _events(spark, d)
    a = responses.analyze(F.lit(False), F.col("status_code"), F.when(F.col("event_type") == "signup", "bot_detected").otherwise("valid"))
    new = e.select("ts", "event_id", "domain", "event_type", a["action"].alias("action"), a["analysis"].alias("response_analysis"))
    body = runlog.snippet(F.repeat(F.concat("event_type", F.lit(" ")), 500))
    log = spark.createDataFrame([], "response_id long, domain string, action string, response_analysis string, body_snippet string")
    return runlog.log_rows(log, new, ["ts", "event_id"], "response_id", {"body_snippet": body})


@register("q_flush", f"""WITH e AS ({_EVENTS}) SELECT CASE route WHEN 'output' THEN 'final_data' ELSE route END AS store, 2 * count(*) AS n, CAST(2 * sum(event_id) AS BIGINT) AS ids FROM e GROUP BY 1
 UNION ALL SELECT 'request_log', 2 * count(*), CAST(2 * sum(event_id) AS BIGINT) FROM e UNION ALL SELECT 'response_log', 2 * count(*), CAST(2 * sum(event_id) AS BIGINT) FROM e""")
def q_flush(spark, d):
    """Two chunks flushed as batches, the second one again after it is committed, and the stores read back."""
    root, log = tables.new_path(spark, "stores"), _log(spark, d)
    for batch in ("chunk_001", "chunk_002", "chunk_002"):
        runlog.flush_chunk(spark, _routed(spark, d), log, root, batch)
    return relational.union_fill(*[commits.read(spark, root, name).agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")).withColumn("store", F.lit(name)) for name in runlog.STORES])


_FLAGGED = "SELECT o_orderkey AS id, 'd' || (o_custkey % 7) AS domain, 'u/' || o_orderkey AS url, o_orderstatus = 'F' AS processed, CASE WHEN o_totalprice > 300000 THEN true END AS error, o_orderpriority LIKE '1%' AS retry, o_orderpriority LIKE '2%' AS parse_error FROM orders"


def _flagged(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("d"), F.col("o_custkey") % 7).alias("domain"), F.concat(F.lit("u/"), "o_orderkey").alias("url"), (F.col("o_orderstatus") == "F").alias("processed"), F.when(F.col("o_totalprice") > 300000, True).alias("error"), F.col("o_orderpriority").like("1%").alias("retry"), F.col("o_orderpriority").like("2%").alias("parse_error"))


@register("q_eligible", f"WITH l AS ({_FLAGGED}) SELECT id, domain, NOT retry AS without_retry, NOT retry AND NOT parse_error AS without_both FROM l WHERE NOT processed AND NOT coalesce(error, false)")
def q_eligible(spark, d):
    """Links that may be fetched, with and without those to be retried or re-parsed."""
    links = _flagged(spark, d)
    some = runlog.eligible(links, skip_retry=True).select("id", F.lit(True).alias("a"))
    both = runlog.eligible(links, skip_retry=True, skip_parse_error=True).select("id", F.lit(True).alias("b"))
    out = runlog.eligible(links).join(some, "id", "left").join(both, "id", "left")
    return out.select("id", "domain", F.coalesce("a", F.lit(False)).alias("without_retry"), F.coalesce("b", F.lit(False)).alias("without_both"))


@register("q_chunk", f"""WITH l AS ({_FLAGGED}), e AS (SELECT * FROM l WHERE NOT processed AND NOT coalesce(error, false)), c AS (SELECT domain, count(*) AS n FROM e GROUP BY 1), t AS (SELECT domain, n, n * least(200, (SELECT count(*) FROM e)) / (SELECT count(*) FROM e) AS x FROM c),
 q AS (SELECT *, least(CAST(round_even(x, 0) AS BIGINT), n) AS q, x - floor(x) AS frac FROM t), r AS (SELECT least(200, (SELECT count(*) FROM e)) - sum(q) AS rest FROM q),
 o AS (SELECT *, row_number() OVER (PARTITION BY n > q ORDER BY frac DESC, domain) AS up, row_number() OVER (PARTITION BY q > 0 ORDER BY frac, domain DESC) AS down FROM q, r),
 w AS (SELECT domain, q + CASE WHEN rest > 0 AND n > q AND up <= rest THEN 1 WHEN rest < 0 AND q > 0 AND down <= -rest THEN -1 ELSE 0 END AS quota FROM o),
 s AS (SELECT e.*, row_number() OVER (PARTITION BY e.domain ORDER BY md5(CAST(id AS VARCHAR) || 'x'), id) AS p FROM e), k AS (SELECT s.* FROM s JOIN w ON s.domain = w.domain WHERE p <= quota)
 SELECT id, k.domain, row_number() OVER (PARTITION BY k.domain ORDER BY id) AS seq, g.turn FROM k JOIN (SELECT domain, row_number() OVER (ORDER BY md5(domain || 'x'), domain) AS turn FROM (SELECT DISTINCT domain FROM k)) g ON g.domain = k.domain""")
def q_chunk(spark, d):
    """The next chunk of links, domains by turns. Its size is what the operator is asked for."""
    return runlog.chunk(_flagged(spark, d), 200, "x").select("id", "domain", "seq", "turn")


@register("q_pending", f"WITH l AS ({_FLAGGED}) SELECT id, domain, url, flag FROM (SELECT *, 'parse_error' AS flag FROM l WHERE parse_error UNION ALL SELECT *, 'not_retry' FROM l WHERE NOT retry)")
def q_pending(spark, d):
    links = _flagged(spark, d)
    return runlog.pending(links).withColumn("flag", F.lit("parse_error")).unionByName(runlog.pending(links, "retry", False).withColumn("flag", F.lit("not_retry")))


@register("q_gone_links", "SELECT DISTINCT 'https://d' || user_id || '.de/error' AS url FROM events WHERE event_type = 'error'")
def q_gone_links(spark, d):
    return runlog.gone_links(_log(spark, d))


@register("q_last_known", "SELECT user_id, (SELECT arg_max(value, event_id) FROM events x WHERE x.user_id = e.user_id AND event_type <> 'view') AS value, (SELECT arg_max(event_type, event_id) FROM events x WHERE x.user_id = e.user_id AND event_type <> 'click') AS event_type FROM (SELECT DISTINCT user_id FROM events) e")
def q_last_known(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") != "view", F.col("value")).alias("value"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type"))
    return runlog.last_known(e, "user_id", "event_id", ["value", "event_type"])


@register("q_all_blocked", "SELECT 1 AS level, bool_and(n >= 3) AS stop FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS n FROM events GROUP BY 1) UNION ALL SELECT 5, false")
def q_all_blocked(spark, d):
    states = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("kills"))
    return relational.union_fill(*[runlog.all_blocked(states, level).withColumn("level", F.lit(level)) for level in (1, 5)])


@register("q_fetch_budget", """WITH e AS (SELECT user_id, event_id, event_type IN ('error', 'click', 'view') AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
 s AS (SELECT *, n - coalesce(max(CASE WHEN NOT bad THEN n END) OVER (PARTITION BY user_id ORDER BY n), 0) AS streak FROM e), b AS (SELECT *, coalesce(max(streak) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
 SELECT event_id FROM b WHERE n <= CASE WHEN user_id % 2 = 0 THEN 15 ELSE 20 END AND before < 5""")
def q_fetch_budget(spark, d):
    """G22. The budget of a visit is the operator's own limit."""
    log = table(spark, d, "events").select("user_id", "ts", "event_id", F.when(F.col("event_type").isin("error", "click", "view"), 500).otherwise(200).alias("status"), (F.col("user_id") % 2 == 0).alias("soft"))
    return runlog.within_budget(log, "user_id", ["ts", "event_id"], "status", soft="soft").select("event_id")


_SECOND = "SELECT 'u/' || o_orderkey AS url, CASE WHEN o_orderstatus = 'P' THEN ' ' WHEN o_orderstatus = 'O' THEN 'body' END AS text, CASE WHEN o_totalprice > 150000 THEN '2024-01-01' END AS date_time FROM orders"


def _second(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.concat(F.lit("u/"), "o_orderkey").alias("url"), F.when(F.col("o_orderstatus") == "P", " ").when(F.col("o_orderstatus") == "O", "body").alias("text"), F.when(F.col("o_totalprice") > 150000, "2024-01-01").alias("date_time"))


def _stores(spark, d):
    links = _flagged(spark, d).select("id", "domain", "url", "retry", "parse_error")
    columns = "id long, domain string, url string, date_time string, text string"
    return {"final_data": spark.createDataFrame([], columns), "retry": links.where("retry").select("id", "domain", "url"), "parse_error": links.where("parse_error").select("id", "domain", "url"), "error": links.limit(0).select("id", "domain", "url")}


@register("q_retry_flow", f"""WITH l AS ({_FLAGGED}), c AS (SELECT * FROM l WHERE retry ORDER BY md5(url || 'r'), url LIMIT 300), t AS (SELECT c.*, text, date_time, coalesce(trim(text) <> '' AND date_time IS NOT NULL, false) AS good FROM c LEFT JOIN ({_SECOND}) s ON s.url = c.url)
 SELECT 'final_data' AS store, url, NULL AS reason FROM t WHERE good UNION ALL SELECT 'failed', url, CASE WHEN text IS NULL THEN 'not extracted' WHEN trim(text) = '' THEN 'empty text' ELSE 'no date' END FROM t WHERE NOT good
 UNION ALL SELECT 'retry', url, NULL FROM l WHERE retry AND url NOT IN (SELECT url FROM t WHERE good) UNION ALL SELECT 'parse_error', url, NULL FROM l WHERE parse_error""")
def q_retry_flow(spark, d):
    """Of 300 links to be retried (the run's own limit), what a second extraction makes of them."""
    stores, failed = runlog.retry_run(_flagged(spark, d), _second(spark, d), _stores(spark, d), 300, "r")
    parts = [df.select(F.lit(name).alias("store"), "url", F.lit(None).cast("string").alias("reason")) for name, df in stores.items()]
    return relational.union_fill(*parts, failed.select(F.lit("failed").alias("store"), "url", "reason"))


@register("q_second_extraction", f"WITH o AS (SELECT 'u/' || o_orderkey AS url, CASE WHEN o_orderpriority LIKE '3%' THEN '' WHEN o_orderpriority LIKE '4%' THEN 'own' END AS text, CAST(NULL AS VARCHAR) AS date_time FROM orders) SELECT o.url, coalesce(nullif(trim(o.text), ''), nullif(trim(s.text), '')) AS text, s.date_time FROM o LEFT JOIN ({_SECOND}) s ON s.url = o.url")
def q_second_extraction(spark, d):
    ours = table(spark, d, "orders").select(F.concat(F.lit("u/"), "o_orderkey").alias("url"), F.when(F.col("o_orderpriority").like("3%"), "").when(F.col("o_orderpriority").like("4%"), "own").alias("text"), F.lit(None).cast("string").alias("date_time"))
    return runlog.merge_extractions(ours, _second(spark, d), columns=("date_time", "text"))


@register("q_promote", """WITH p AS (SELECT o_orderkey AS id, 'u/' || o_orderkey AS url, o_orderstatus <> 'F' AND o_orderpriority NOT LIKE '1%' AS good, o_orderstatus = 'P' AS old FROM orders)
 SELECT id, url, good OR old AS processed, NOT (good OR old) AS parse_error, CASE WHEN good OR old THEN 'final_data' ELSE 'parse_error' END AS store FROM p""")
def q_promote(spark, d):
    """Re-parsed pages leave parse_error for final_data, failures stay; links get their flags anew."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("u/"), "o_orderkey").alias("url"), "o_orderstatus", "o_orderpriority")
    final = o.where("o_orderstatus = 'P'").select("id", "url", F.lit("x").alias("text"))
    x = F.struct(F.when(F.col("o_orderstatus") != "F", "2024-01-01").alias("date_time"), F.lit("a").alias("author"), F.lit("h").alias("headline"), F.when(F.col("o_orderpriority").like("1%"), " ").otherwise("text").alias("text"))
    parsed = o.select("id", "url", x.alias("x"), F.lit(False).alias("paywall"))
    stores, links = workbench.fill_results(o.select("id", "url"), {"final_data": final, "parse_error": o.select("id", "url")}, parsed)
    every = relational.union_fill(*[stores[s].select("url", F.lit(s).alias("store")) for s in ("final_data", "parse_error")])
    return links.join(every, "url").select("id", "url", "processed", "parse_error", "store")


_RULES = "SELECT 'prod' AS version, 'n' || n_nationkey || '.de' AS domain, 'text' AS field, 'p' || n_nationkey AS selector FROM nation UNION ALL SELECT 'prod', '*', 'bot', 'b' || r_regionkey FROM region"


def _rules(spark, d):
    """A text rule per nation, and a rule for bots per region that holds for all domains."""
    row = lambda df, domain, field, selector: df.select(F.lit("prod").alias("version"), domain.alias("domain"), F.lit(field).alias("field"), F.lit(1).alias("priority"), F.lit("css").alias("kind"), F.array(selector).alias("selectors"), F.array().cast("array<string>").alias("attributes"))
    nation = row(table(spark, d, "nation"), F.concat(F.lit("n"), "n_nationkey", F.lit(".de")), "text", F.concat(F.lit("p"), "n_nationkey"))
    return nation.unionByName(row(table(spark, d, "region"), F.lit("*"), "bot", F.concat(F.lit("b"), "r_regionkey")))


@register("q_rule_edits", f"""WITH p AS ({_RULES}), l AS (SELECT 'local' AS version, domain, field, CASE WHEN field = 'bot' THEN 'all' WHEN domain IN (SELECT 'n' || n_nationkey || '.de' FROM nation WHERE n_regionkey = 1) THEN 'new' ELSE selector END AS selector FROM p)
 SELECT DISTINCT version, domain, field, selector FROM l UNION ALL SELECT * FROM p WHERE domain <> 'n1.de' UNION ALL SELECT 'prod', domain, field, selector FROM l WHERE domain = 'n1.de'""")
def q_rule_edits(spark, d):
    """Local rules of a region's domains edited, bot rules replaced for all, one domain's taken over into production."""
    rules, some = _rules(spark, d), table(spark, d, "nation").where("n_regionkey = 1")
    text = some.select(F.lit("local").alias("version"), F.concat(F.lit("n"), "n_nationkey", F.lit(".de")).alias("domain"), F.lit("text").alias("field"), F.lit(1).alias("priority"), F.lit("css").alias("kind"), F.array(F.lit("new")).alias("selectors"), F.array().cast("array<string>").alias("attributes"))
    bot = table(spark, d, "region").where("r_regionkey = 0").select(F.lit("local").alias("version"), F.lit("any.de").alias("domain"), F.lit("bot").alias("field"), F.lit(1).alias("priority"), F.lit("css").alias("kind"), F.array(F.lit("all")).alias("selectors"), F.array().cast("array<string>").alias("attributes"))
    edited = workbench.apply(workbench.edit(workbench.sandbox(rules), text.unionByName(bot)), "n1.de")
    return edited.select("version", "domain", "field", F.col("selectors")[0].alias("selector"))


@register("q_show_rules", f"SELECT domain, field, selector FROM ({_RULES}) WHERE domain IN ('n3.de', '*')")
def q_show_rules(spark, d):
    """What a domain's page is parsed by."""
    return workbench.show(workbench.sandbox(_rules(spark, d)), "n3.de").select("domain", "field", F.col("selectors")[0].alias("selector"))


_PAGE_HOST = r"lower(regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]*)', 1), '(?i)^www\.', ''))"


@register("q_reparse_changed", f"SELECT page_id, {_PAGE_HOST} = (SELECT min({_PAGE_HOST}) FROM pages) AS parsed_again FROM pages")
def q_reparse_changed(spark, d):
    """After an edit of one domain's rules only its pages are parsed again."""
    pages = table(spark, d, "pages")
    first = pages.select(urls.host(F.col("url")).alias("domain")).agg(F.min("domain").alias("domain"))
    rule = lambda df, selector: df.select(F.lit("local").alias("version"), "domain", F.lit("headline").alias("field"), F.lit(1).alias("priority"), F.lit("css").alias("kind"), F.array(F.lit(selector)).alias("selectors"), F.array().cast("array<string>").alias("attributes"))
    common = rule(first.select(F.lit("*").alias("domain")), "h1")
    before = tables.materialize(workbench.reparse_changed(pages, common, key="page_id"), "parsed")
    rules = common.unionByName(rule(first, "h2"))
    again = tables.materialize(workbench.changed(pages, rules, before, "page_id"), "changed")
    after = workbench.reparse_changed(pages, rules, before, "page_id")
    return after.select("page_id").join(again.select("page_id", F.lit(True).alias("again")), "page_id", "left").select("page_id", F.coalesce("again", F.lit(False)).alias("parsed_again"))


@register("q_page_files", "SELECT 'a/' || (page_id % 7) || CASE WHEN row_number() OVER (PARTITION BY page_id % 7 ORDER BY page_id) > 1 THEN '-' || row_number() OVER (PARTITION BY page_id % 7 ORDER BY page_id) ELSE '' END AS name, coalesce(html, '') || chr(10) || chr(13) || ' end' || chr(10) AS html FROM pages")
def q_page_files(spark, d):
    """Every page written to a file of its own and read back with its name, line breaks kept."""
    pages = table(spark, d, "pages").select("page_id", F.concat(F.lit("a/"), F.col("page_id") % 7).alias("name"), F.concat(F.coalesce("html", F.lit("")), F.lit("\n\r end\n")).alias("html"))
    path = tables.new_path(spark, "pages")
    page_files.export(page_files.unique_names(pages, "name", ["page_id"]), path)
    return page_files.load(spark, path)


@register("q_agency_text", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'h' || event_id WHEN event_id % 3 = 0 THEN 'text' END AS text, CASE WHEN event_id % 4 = 0 THEN 'dpa' WHEN event_id % 5 = 0 THEN 'a' END AS author FROM events WHERE event_id % 4 <> 0 OR (event_id % 3 <> 0 AND event_id % 5 <> 0)")
def q_agency_text(spark, d):
    """Agency reports without text and author get the headline and the agency."""
    k = F.col("event_id")
    found = extract.agency_text(F.when(k % 4 == 0, F.concat(F.lit("h"), k)), F.when(k % 4 == 0, "2024-01-01"), F.when(k % 3 == 0, "text"), F.when(k % 5 == 0, "a"))
    return table(spark, d, "events").where("event_id % 4 <> 0 or (event_id % 3 <> 0 and event_id % 5 <> 0)").select("event_id", found.alias("x")).select("event_id", "x.text", "x.author")


@register("q_paywall_rules", """WITH m AS (SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS l FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), f AS (SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS l FROM orders WHERE o_totalprice > 250000 GROUP BY 1)
 SELECT 'd' || c_custkey AS domain, CASE WHEN c_custkey % 11 = 0 THEN 'no_paywall' WHEN c_custkey % 13 = 0 THEN 'all_paywall' WHEN f.l IS NOT NULL THEN 'hardcoded' WHEN m.l IS NOT NULL THEN 'mined' ELSE 'no_samples' END AS rule,
 CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN NULL ELSE array_to_string(coalesce(f.l, m.l), ',') END AS markers FROM customer LEFT JOIN m ON m.o_custkey = c_custkey LEFT JOIN f ON f.o_custkey = c_custkey""")
def q_paywall_rules(spark, d):
    """The paywall rule of each domain by priority, with its markers."""
    domain, k = F.concat(F.lit("d"), "c_custkey").alias("domain"), F.col("c_custkey")
    domains = table(spark, d, "customer").select(domain, F.when(k % 11 == 0, "no_paywall").when(k % 13 == 0, "all_paywall").otherwise("some").alias("paywall_url"))
    o = table(spark, d, "orders").select(F.concat(F.lit("d"), "o_custkey").alias("domain"), F.col("o_orderpriority").alias("marker"), "o_orderstatus", "o_totalprice")
    found = extract.resolve_paywall_rules(domains, o.where("o_orderstatus = 'P'"), o.where("o_totalprice > 250000"))
    return found.select("domain", "rule", F.array_join("markers", ",").alias("markers"))


def _tables_of(spark, d):
    """A page per nation whose second table lists its customers; cells and rows are left open."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda x: F.concat(F.lit("<tr><td> "), x["c_custkey"].cast("string"), F.lit(" <td><b>"), x["c_name"], F.lit("</b>")))
    pages = table(spark, d, "customer").groupBy("c_nationkey").agg(F.array_join(rows, "\n").alias("rows"))
    return pages.select("c_nationkey", F.concat(F.lit("<table><tr><th>x</table><p>t</p><table><tr><th>id<th>name"), "rows", F.lit("</table>")).alias("html"))


@register("q_html_tables", "SELECT c_nationkey, n, CASE WHEN n = 0 THEN 'id' ELSE id END AS id, CASE WHEN n = 0 THEN 'name' ELSE name END AS name FROM (SELECT c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS n, CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer UNION ALL SELECT DISTINCT c_nationkey, 0, '', '' FROM customer)")
def q_html_tables(spark, d):
    """A5: the rows of the second table of each page."""
    cells = _tables_of(spark, d).select("c_nationkey", F.posexplode(extract.html_tables(F.col("html"))[1]).alias("n", "row"))
    return cells.select("c_nationkey", "n", F.col("row")[0].alias("id"), F.col("row")[1].alias("name"))


@register("q_first_elements", "SELECT c_nationkey, string_agg(c_name, ',' ORDER BY c_custkey) FILTER (WHERE n <= 3) AS names FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n FROM customer) GROUP BY 1")
def q_first_elements(spark, d):
    """The first three elements of a selector; their number is the operator's own limit."""
    return _tables_of(spark, d).select("c_nationkey", F.array_join(extract.first_values(F.col("html"), ["td > b"], 3), ",").alias("names"))


@register("q_load_parse_errors", "SELECT event_id AS id FROM events WHERE event_type = 'view' AND user_id = (SELECT min(user_id) FROM events)")
def q_load_parse_errors(spark, d):
    first = table(spark, d, "events").agg(F.min("user_id")).first()[0]
    errors = _events(spark, d).where("route = 'parse_error'").select(F.col("event_id").alias("id"), "domain")
    return workbench.load(errors, f"d{first}").select("id")


_DOMAIN = "CASE c_mktsegment WHEN 'BUILDING' THEN 'host:8080' WHEN 'FURNITURE' THEN NULL WHEN 'MACHINERY' THEN '00' || (c_custkey % 3) WHEN 'HOUSEHOLD' THEN 'a/b=c%' ELSE '' END"


@register("q_by_domain", f"""WITH c AS (SELECT {_DOMAIN} AS domain, c_nationkey AS url, CASE WHEN c_acctbal < 2000 THEN 0 WHEN c_acctbal < 5000 THEN 1 ELSE 2 END AS run FROM customer),
 k AS (SELECT domain, url, min(run) AS run FROM c GROUP BY 1, 2)
 SELECT domain, count(*) AS n, CAST(sum(run) AS BIGINT) AS runs, CAST(sum(url) AS BIGINT) AS urls FROM k WHERE domain IS DISTINCT FROM '' AND url <> 7 GROUP BY 1""")
def q_by_domain(spark, d):
    """A table by domain, merged with new rows twice, without an emptied domain and without a URL that is done everywhere; domains with signs, digits and none."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("url"), F.when(F.col("c_acctbal") < 2000, 0).when(F.col("c_acctbal") < 5000, 1).otherwise(2).alias("run"), F.expr(_DOMAIN).alias("domain"))
    path, nobody = tables.new_path(spark, "domains"), c.limit(0)
    for run in range(3):
        tables.merge_by_domain(spark, c.where(F.col("run") == run), path, nobody)
    tables.merge_by_domain(spark, nobody, path, tables.read_by_domain(spark, path, [""]))
    tables.merge_by_domain(spark, nobody, path, c.where("url = 7").select("url"))
    return tables.read_by_domain(spark, path).groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.sum("run").alias("runs"), F.sum("url").alias("urls"))


@register("q_files", "SELECT c_custkey, 'a, \"b\"' || chr(10) || c_name AS name, lower(c_mktsegment) AS domain FROM customer")
def q_files(spark, d):
    """CSV written and read, files of a glob with the domain from their names."""
    c, root = table(spark, d, "customer"), tables.new_path(spark, "files")
    rows = c.select("c_custkey", F.concat(F.lit('a, "b"\n'), "c_name").alias("name"), F.lower("c_mktsegment").alias("seg"))
    tables.write_csv(rows, f"{root}/csv")
    back = spark.read.schema("c_custkey long, name string, seg string").csv(f"{root}/csv", header=True, multiLine=True, escape='"')
    back.write.partitionBy("seg").parquet(f"{root}/part")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/part/seg=*/*.parquet"))]
    for i, p in enumerate(names):
        seg = p.getParent().getName().split("=")[1]
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{root}/flat"))
        fs.rename(p, jvm.org.apache.hadoop.fs.Path(f"{root}/flat/part{i}_{seg}.parquet"))
    return tables.domain_of_file(tables.read_many(spark, f"{root}/flat/*.parquet")).select("c_custkey", "name", "domain")


@register("q_lines", "SELECT n_name || ' #' || n_nationkey AS value FROM nation")
def q_lines(spark, d):
    path = tables.new_path(spark, "lines")
    table(spark, d, "nation").select(F.concat("n_name", F.lit(" #"), "n_nationkey").alias("value")).write.text(path)
    return tables.read_lines(spark, path)


@register("q_gunzip", "SELECT c_custkey, c_name AS text FROM customer")
def q_gunzip(spark, d):
    @pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        def one(t: str) -> bytes:
            z = zlib.compressobj(wbits=31)
            return z.compress(t.encode()) + z.flush()

        return texts.map(one)

    payload = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name").cast("binary")).otherwise(packed("c_name"))
    return table(spark, d, "customer").select("c_custkey", tables.gunzip(payload).alias("text"))


@register("q_sample_pages", "SELECT 's' || (page_id % 3) AS name, count(*) AS n FROM pages GROUP BY 1")
def q_sample_pages(spark, d):
    """Pages written as text in folders by name, and counted there."""
    path = tables.new_path(spark, "samples")
    tables.write_pages(table(spark, d, "pages").select(F.regexp_replace("html", r"\s+", " ").alias("html"), F.concat(F.lit("s"), F.col("page_id") % 3).alias("name")), path)
    return spark.read.text(path).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@register("q_codebook", "SELECT 'type' AS field, 'bigint' AS c_custkey, 'double' AS c_acctbal UNION ALL SELECT 'allowed', NULL, '0;1'")
def q_codebook(spark, d):
    """A4: a codebook turned so that its variables are columns."""
    book = spark.createDataFrame([("c_custkey", "bigint", None), ("c_acctbal", "double", "0;1")], "variable string, type string, allowed string")
    return tables.transpose(book, "variable", ["c_custkey", "c_acctbal"]).withColumnRenamed("name", "field")


@register("q_typical_sitemaps", "SELECT 'd' || n_nationkey || '.de' AS domain_url, 'https://d' || n_nationkey || '.de' || p AS typical_URL FROM nation, (VALUES (0, '/sitemap.xml'), (1, '/sitemap_index.xml'), (2, '/feeds/news.xml')) AS t(k, p) WHERE (n_nationkey + k) % 3 <> 1")
def q_typical_sitemaps(spark, d):
    """Usual paths (the caller's table) tried for every domain against the responses."""
    n = table(spark, d, "nation").select(F.concat(F.lit("d"), "n_nationkey", F.lit(".de")).alias("domain_url"), "n_nationkey")
    paths = spark.createDataFrame([(0, "/sitemap.xml"), (1, "/sitemap_index.xml"), (2, "/feeds/news.xml")], "k int, path string")
    answers = n.crossJoin(F.broadcast(paths)).select(F.concat(F.lit("https://"), "domain_url", "path").alias("url"), F.when((F.col("n_nationkey") + F.col("k")) % 3 == 1, 404).otherwise(200).alias("status"))  # three paths
    return discovery.typical(n, answers, paths)


@register("q_url_shapes", r"SELECT page_id, NOT regexp_matches(url, '\.html$') AS no_html, NOT regexp_matches(regexp_replace(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/]*', ''), '[0-9]') AS no_digit, regexp_matches(url, 'liveblog|live') AS live FROM pages")
def q_url_shapes(spark, d):
    return table(spark, d, "pages").select("page_id", urls.shape(F.col("url")).alias("s")).select("page_id", "s.*")


@register("q_snapshot_url", "SELECT o_orderkey, 'https://archive.example/web/' || strftime(o_orderdate, '%Y%m%d') || '000000id_/https://x/' || o_orderkey AS address, CAST(o_orderdate AS DATE) AS day FROM orders")
def q_snapshot_url(spark, d):
    """A13, F12."""
    stamp = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("000000"))
    return table(spark, d, "orders").select("o_orderkey", sitemaps.snapshot_url(stamp, F.concat(F.lit("https://x/"), "o_orderkey"), "https://archive.example/web/").alias("address"), dates.stamp_date(stamp).alias("day"))


@register("q_date_texts", """SELECT o_orderkey, epoch(o_orderdate) AS http, epoch(o_orderdate) AS iso, epoch((o_orderdate AT TIME ZONE 'Europe/Berlin')) AS german, strftime(o_orderdate, '%Y-%m-%d') || ' - ' || strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') AS span, CASE WHEN o_orderkey % 2 = 0 THEN 'a.de' ELSE 'b.com.de' END AS host FROM orders""")
def q_date_texts(spark, d):
    """F6, F13, F14, F15, F18 on dates written out."""
    day = F.col("o_orderdate")
    epoch = lambda c: F.unix_timestamp(c).cast("double")
    http = dates.http_date(F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
    iso = dates.iso_datetime(F.concat(F.date_format(day + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
    german = dates.german_datetime(F.concat(F.date_format(day, "dd.MM.yyyy"), F.when(F.col("o_orderkey") % 2 == 0, ", 0:00 Uhr").otherwise("")))
    host = urls.ensure_suffix(F.when(F.col("o_orderkey") % 2 == 0, "a.de").otherwise("b.com"))
    return table(spark, d, "orders").select("o_orderkey", epoch(http).alias("http"), epoch(iso).alias("iso"), epoch(german).alias("german"), dates.span_text(day, day + F.expr("INTERVAL 2 DAYS")).alias("span"), host.alias("host"))


@register("q_run_lengths", """WITH e AS (SELECT user_id, event_id, event_type, ts, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM e)
 SELECT event_id, CAST(run AS BIGINT) AS run, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS run_pos FROM r""")
def q_run_lengths(spark, d):
    return relational.runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "run", "run_pos")


_URLSET = "'<?xml version=\"1.0\"?><sm:urlset xmlns:sm=\"http://s\"><sm:url id=\"1\"><sm:loc>https://x/' || c_custkey || '</sm:loc><sm:lastmod>2025-01-0' || (1 + c_custkey % 9) || '</sm:lastmod></sm:url><sm:url><sm:loc>https://y/' || c_custkey || '</sm:loc></sm:url></sm:urlset>'"


def _urlsets(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.expr(_URLSET.replace('\\"', '"')).alias("body"))


@register("q_urlset_scrape", f"SELECT c_custkey, CASE WHEN c_custkey % 9 BETWEEN 2 AND 5 THEN 'in_range' ELSE 'out_of_range' END AS in_range, 2::BIGINT AS urlset_link_count, '2025-01-0' || (1 + c_custkey % 9) || ' - 2025-01-0' || (1 + c_custkey % 9) AS urlset_date_range, md5({_URLSET}) AS content FROM customer")
def q_urlset_scrape(spark, d):
    """K2, K4, F2: urlsets with prefixed names and attributes."""
    found = sitemaps.scrape_urlsets(_urlsets(spark, d), "2025-01-03", "2025-01-06")
    return found.select("c_custkey", "in_range", "urlset_link_count", "urlset_date_range", F.md5("urlset_content").alias("content"))


@register("q_root_tags", f"SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'urlset' WHEN 1 THEN NULL WHEN 2 THEN 'sitemapindex' WHEN 3 THEN NULL ELSE 'sitemap' END AS tag FROM customer")
def q_root_tags(spark, d):
    """Names of root elements; null where the document is not well-formed."""
    k = F.col("c_custkey")
    body = F.when(k % 5 == 0, F.expr(_URLSET)).when(k % 5 == 1, "<urlset><url></urlset>").when(k % 5 == 2, "\n<!-- a --><SitemapIndex/>").when(k % 5 == 3, "not xml").otherwise("<sitemap></sitemap>")
    return table(spark, d, "customer").select("c_custkey", sitemaps.root_tag(body).alias("tag"))


@register("q_sitemap_links", "SELECT c_custkey, u || c_custkey AS result_link, d AS date FROM (SELECT c_custkey, unnest(['https://x/', 'https://y/']) AS u, unnest([CAST('2025-01-0' || (1 + c_custkey % 9) AS DATE), NULL]) AS d FROM customer)")
def q_sitemap_links(spark, d):
    """K2, K5, M3: one row per link of a urlset with prefixed names."""
    return _urlsets(spark, d).select("c_custkey", F.explode(sitemaps.links(F.col("body"))).alias("l")).select("c_custkey", "l.result_link", "l.date")


@register("q_progression_upsert", """WITH o AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE 'urlset' END AS root_tag, 'in_progress' AS s, CASE WHEN c_custkey % 2 = 0 THEN 'g' END AS g FROM customer WHERE c_acctbal < 6000), n AS (SELECT c_custkey, 'sitemapindex' AS root_tag, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'scraped' END AS s, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'h' END AS g FROM customer WHERE c_acctbal >= 2000)
 SELECT coalesce(o.c_custkey, n.c_custkey) AS current_url, CASE WHEN coalesce(o.root_tag, 'unknown') <> 'unknown' THEN o.root_tag ELSE coalesce(n.root_tag, o.root_tag) END AS root_tag, coalesce(n.s, o.s) AS processing_status, coalesce(n.g, o.g) AS pagination_group FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def q_progression_upsert(spark, d):
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    old = c.where("c_acctbal < 6000").select(k.alias("current_url"), F.when(k % 3 == 0, "unknown").otherwise("urlset").alias("root_tag"), F.lit("in_progress").alias("processing_status"), F.when(k % 2 == 0, "g").alias("pagination_group"))
    new = c.where("c_acctbal >= 2000").select(k.alias("current_url"), F.lit("sitemapindex").alias("root_tag"), F.when(F.col("c_mktsegment") != "BUILDING", "scraped").alias("processing_status"), F.when(F.col("c_mktsegment") == "MACHINERY", "h").alias("pagination_group"))
    return sitemaps.progression_upsert(old, new)


@register("q_group_dissolve", """WITH t AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS g, c_custkey % 4 AS i, CASE WHEN c_acctbal > 9500 THEN 'sitemapindex' ELSE 'urlset' END AS tag FROM customer), m AS (SELECT DISTINCT g FROM t WHERE tag = 'sitemapindex' AND g IS NOT NULL)
 SELECT id, CASE WHEN m.g IS NULL THEN CAST(t.g AS VARCHAR) END AS pagination_group, CASE WHEN m.g IS NULL THEN i END AS pagination_index, CASE WHEN m.g IS NULL THEN 'candidate' ELSE 'dissolved' END AS pagination_group_status FROM t LEFT JOIN m ON t.g = m.g""")
def q_group_dissolve(spark, d):
    c = table(spark, d, "customer")
    tree = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 0, F.col("c_nationkey").cast("string")).alias("pagination_group"), (F.col("c_custkey") % 4).alias("pagination_index"), F.when(F.col("c_acctbal") > 9500, "sitemapindex").otherwise("urlset").alias("root_tag"), F.lit("candidate").alias("pagination_group_status"))
    return sitemaps.dissolve_groups(tree).drop("root_tag")


@register("q_reset_master", """WITH r AS (SELECT DISTINCT 'd' || user_id AS root_url FROM events WHERE event_type = 'click'), m AS (SELECT 'd' || user_id AS root_url, count(*) AS n FROM events GROUP BY 1)
 SELECT m.root_url, CASE WHEN r.root_url IS NULL THEN 'fully_processed' ELSE 'in_progress' END AS input_processing_status, CASE WHEN r.root_url IS NULL THEN n ELSE 0 END AS total_request_count, CASE WHEN r.root_url IS NULL THEN n ELSE 0 END AS total_urlsets_scraped, CASE WHEN r.root_url IS NULL THEN 'normal' ELSE 'retry' END AS processing_flag FROM m LEFT JOIN r ON m.root_url = r.root_url""")
def q_reset_master(spark, d):
    """Masters of sitemaps whose log has retry flags start anew."""
    e = _events(spark, d).select(F.col("domain").alias("root_url"), "url", (F.col("event_type") == "click").alias("retry_flag"))
    master = e.groupBy("root_url").agg(F.lit("fully_processed").alias("input_processing_status"), F.count(F.lit(1)).alias("total_request_count"), F.count(F.lit(1)).alias("total_urlsets_scraped"), F.lit("normal").alias("processing_flag"))
    return sitemaps.reset_master(master, sitemaps.retry_rows(e))


@register("q_master_status", """WITH t AS (SELECT user_id, event_type FROM events), s AS (SELECT user_id AS root_url, bool_and(event_type IN ('purchase', 'error')) AS over, bool_and(event_type = 'error') AS bad, bool_or(event_type = 'click') AS retry FROM t GROUP BY 1)
 SELECT root_url, CASE WHEN retry THEN 'partially_processed_and_moved_to_retry' WHEN bad THEN 'total_error' WHEN over THEN 'fully_processed' ELSE 'in_progress' END AS input_processing_status FROM s""")
def q_master_status(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("root_url"), "event_type")
    tree = e.select("root_url", F.when(F.col("event_type") == "purchase", "scraped").when(F.col("event_type") == "error", "xml_error").otherwise("in_progress").alias("processing_status"))
    return sitemaps.master_status(tree, e.select("root_url", (F.col("event_type") == "click").alias("retry_flag")))


@register("q_labelled_counts", "SELECT 'all' AS label, count(*) AS n FROM orders UNION ALL SELECT 'eligible', count(*) FILTER (WHERE o_orderstatus <> 'F') FROM orders UNION ALL SELECT 'chunk', least(200, count(*)) FROM orders")
def q_labelled_counts(spark, d):
    o = table(spark, d, "orders")
    return reports.labelled_counts({"all": o, "eligible": o.where("o_orderstatus <> 'F'"), "chunk": o.limit(200)})


@register("q_parse_error_overview", f"WITH l AS ({_FLAGGED}), r AS (SELECT domain, count(*) AS input_links, count(*) FILTER (WHERE parse_error) AS n_parse_error FROM l GROUP BY 1) SELECT *, round_even(n_parse_error / input_links * 100, 2) AS pct_parse_error FROM r WHERE n_parse_error > 0")
def q_parse_error_overview(spark, d):
    return reports.parse_error_overview(reports.progress(_flagged(spark, d)))


@register("q_sitemap_presence", "SELECT count(*) FILTER (WHERE h) AS with_sitemap, count(*) FILTER (WHERE NOT h) AS without_sitemap FROM (SELECT c_nationkey, bool_or(c_acctbal > 9900) AS h FROM customer GROUP BY 1)")
def q_sitemap_presence(spark, d):
    return reports.sitemap_presence(table(spark, d, "customer").select(F.col("c_nationkey").alias("domain_url"), F.when(F.col("c_acctbal") > 9900, "s").alias("sitemap_URL")))


@register("q_pattern_counts", "WITH c AS (SELECT count(*) AS al, count(*) FILTER (WHERE regexp_matches(url, '^https')) AS tls, count(*) FILTER (WHERE regexp_matches(url, 'utm_')) AS tracked, count(*) FILTER (WHERE regexp_matches(url, '[.]html?$')) AS file FROM pages), l AS (UNPIVOT c ON tls, tracked, file INTO NAME pattern VALUE n) SELECT pattern, n, round_even(n / al * 100, 2) AS pct FROM l")
def q_pattern_counts(spark, d):
    return reports.pattern_counts(table(spark, d, "pages"), "url", {"tls": "^https", "tracked": "utm_", "file": "[.]html?$"})


@register("q_sitemap_overview", """WITH k AS (SELECT c_custkey AS id FROM customer), l AS (SELECT o_custkey AS id, count(*) AS n, count(*) FILTER (WHERE o_orderstatus <> 'F') AS v, count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS u FROM orders GROUP BY 1),
 p AS (SELECT o_custkey AS id, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS dt, count(*) FILTER (WHERE o_orderstatus = 'P') AS re FROM orders GROUP BY 1),
 e AS (SELECT o_custkey AS id, count(*) FILTER (WHERE o_orderpriority LIKE '2%') AS i, count(*) FILTER (WHERE o_orderpriority LIKE '3%') AS s, count(*) FILTER (WHERE o_orderpriority LIKE '4%' OR o_orderpriority LIKE '5%') AS x FROM orders GROUP BY 1),
 g AS (SELECT o_custkey AS id, count(*) FILTER (WHERE o_totalprice > 100000) AS b FROM orders GROUP BY 1),
 a AS (SELECT o_custkey AS id, count(*) FILTER (WHERE o_orderstatus = 'O') AS same, count(*) FILTER (WHERE o_orderstatus <> 'O') AS other FROM orders WHERE o_totalprice > 200000 GROUP BY 1)
 SELECT k.id AS layer_1_url_id, coalesce(l.n, 0) AS total_links_for_domain, coalesce(v, 0) AS total_valid_links, coalesce(u, 0) AS total_urlsets, coalesce(p.n, 0) AS total_progression_entries, coalesce(dt, 0) + coalesce(i, 0) AS total_links_excluded_by_date, coalesce(s, 0) AS total_links_excluded_by_string, coalesce(dt, 0) + coalesce(i, 0) + coalesce(s, 0) AS total_links_excluded,
 coalesce(x, 0) + coalesce(re, 0) AS total_errors, coalesce(b, 0) AS total_verified_errors_before_retry, coalesce(same, 0) AS total_verified_errors_after_retry, coalesce(other, 0) AS total_unsolved_errors
 FROM k LEFT JOIN l ON l.id = k.id LEFT JOIN p ON p.id = k.id LEFT JOIN e ON e.id = k.id LEFT JOIN g ON g.id = k.id LEFT JOIN a ON a.id = k.id""")
def q_sitemap_overview(spark, d):
    """The eleven measures of every sitemap."""
    key = "layer_1_url_id"
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", key)
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    progression = o.select(key, F.when(status == "F", "excluded_by_date").when(status == "P", "response_error").otherwise("scraped").alias("processing_status"))
    category = F.when(priority.like("2%"), "input_out_of_range").when(priority.like("3%"), "excluded_string").when(priority.like("4%"), "xml_parse_error").when(priority.like("5%"), "unsupported_root_tag")
    log = o.select(key, F.col("o_orderkey").alias("requested_url"), F.lit("a").alias("http_status_message"), (F.col("o_totalprice") > 100000).alias("retry_flag"))
    retry = o.select(key, F.col("o_orderkey").alias("requested_url"), F.when(status == "O", "a").otherwise("b").alias("http_status_message"), (F.col("o_totalprice") > 200000).alias("retry_flag"))
    return reports.sitemap_overview(table(spark, d, "customer").select(F.col("c_custkey").alias(key)), o, o.where("o_orderstatus <> 'F'"), o.where("o_orderpriority like '1%'"), progression, o.select(key, category.alias("error_category")), log, retry)


@register("q_json_ld", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'h' || event_id WHEN 1 THEN 'g' WHEN 2 THEN 'l' END AS headline, CASE event_id % 4 WHEN 0 THEN 'A. B' WHEN 1 THEN 'C' WHEN 2 THEN 'D, E' END AS author, CASE WHEN event_id % 4 = 0 THEN '2024-01-01' END AS date_time FROM events")
def q_json_ld(spark, d):
    """Fields from JSON-LD: plain objects, @graph, lists of names, broken scripts."""
    k = F.col("event_id")
    plain = F.concat(F.lit('{"headline": "h'), k, F.lit('", "author": {"name": "A. B"}, "datePublished": "2024-01-01"}'))
    script = F.when(k % 4 == 0, plain).when(k % 4 == 1, '{"@graph": [{"headline": "g", "author": "C"}]}').when(k % 4 == 2, '[{"headline": "l", "author": [{"name": "D"}, "E"]}]').otherwise('{"headline": broken')
    pages = table(spark, d, "events").select("event_id", F.concat(F.lit('<html><body><script type="application/ld+json">'), script, F.lit("</script></body></html>")).alias("html"), F.lit("https://x.de/a").alias("url"))
    return extract.extract(pages).select("event_id", "x.headline", "x.author", "x.date_time")


@register("q_page_rules", "SELECT event_id, CASE WHEN event_type = 'view' THEN 'Anna ' || event_id END AS author, CASE WHEN event_type = 'click' THEN 'd' || event_id END AS date_time, event_type = 'error' AS bot, event_type = 'purchase' AS marker FROM events")
def q_page_rules(spark, d):
    """Following elements, dataLayer members, bot and paywall rules from tables."""
    k, kind = F.col("event_id"), F.col("event_type")
    body = (
        F.when(kind == "view", F.concat(F.lit("<h3 class='by'>By</h3><i>x</i><span>Anna "), k, F.lit("</span>"))).when(kind == "click", F.concat(F.lit("<script>dataLayer.push({page.date: 'd"), k, F.lit("', n: 1,});</script>")))
        .when(kind == "error", "<p>Please VERIFY you are human</p>").when(kind == "purchase", "<meta content='locked-content'>").otherwise("<p>plain</p>")
    )
    pages = table(spark, d, "events").select("event_id", F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"), F.lit("https://x.de/a").alias("url"))
    rules = [("x.de", "author", 1, "next", ["h3.by"], ["span"]), ("x.de", "date_time", 1, "data_layer", ["page.date"], [])]
    bot = extract.bot_rules(spark.createDataFrame([("phrases", "Verify you are human"), ("selectors", "#challenge"), ("scripts", "captcha.js")], "kind string, value string"))
    paywall = spark.createDataFrame([("x.de", "meta", "locked-content"), ("x.de", "css", ".wall")], "domain string, type string, marker string")
    return extract.extract(pages, rules=rules, paywall=paywall, bot=bot).select("event_id", "x.author", "x.date_time", "x.bot", F.col("x.paywall_marker").alias("marker"))


@register("q_markers", "SELECT event_id, 'css' AS type, 'div.plus-' || event_type AS marker FROM events UNION ALL SELECT event_id, 'script', 'isPaid\\s*=' FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, 'meta', 'premium ' || event_id FROM events WHERE event_type = 'click'")
def q_markers(spark, d):
    """Markers by the caller's keywords and script patterns, one row each."""
    kind = F.col("event_type")
    html = F.concat(F.lit("<div class='a plus-"), kind, F.lit("'>x</div>"), F.when(kind == "view", "<script>var isPaid = 1</script>").when(kind == "click", F.concat(F.lit("<meta content='premium "), "event_id", F.lit("'>"))).otherwise(""))
    found = extract.mine_markers(html, ("plus", "premium"), (r"isPaid\s*=",))
    return table(spark, d, "events").select("event_id", F.explode(found).alias("m")).select("event_id", "m.type", "m.marker")
