"""Sitemap trees: XML, traversal, roll-up, ordering and pagination groups."""

from __future__ import annotations

import re
from itertools import count
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from newsflow.functions.dates import iso_date
from newsflow.functions.urls import pagination_key, pagination_number
from newsflow.operators.relational import numbered, tasks_for

#: Statuses that end a sitemap well or badly.
DONE = ("excluded_by_string", "excluded_by_date", "scraped", "all_child_links_processed")
FAILED = ("response_error", "xml_error", "unsupported_root_tag", "all_processed_some_errors")
LEAST_GROUP = 5


def root_tag(xml: Column) -> Column:
    """Lower-case name of the root element, without prefix; null where the document is not well-formed (K1, K2)."""
    @pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_root)

    return run(xml)


def _root(text: str | None) -> str | None:
    if text is None:
        return None
    names: list[str] = []
    parser = expat.ParserCreate(namespace_separator=" ")
    parser.StartElementHandler = lambda name, _: names or names.append(name)
    try:
        parser.Parse(text.lstrip("\ufeff \t\r\n").encode("utf-8", "replace"), True)
    except expat.ExpatError as e:
        # prefixes that no one declares are common in sitemaps; they don't make one unreadable
        return first_tag(text) if e.code == expat.errors.codes[expat.errors.XML_ERROR_UNBOUND_PREFIX] else None
    return names[0].split(" ")[-1].lower()


def first_tag(text: str) -> str | None:
    m = re.match(r"(?:\s|<\?[^>]*\?>|<!--(?:(?!-->)[\s\S])*-->|<!DOCTYPE[^>]*>)*<(?:[\w.-]+:)?([\w.-]+)", text)
    return m[1].lower() if m else None


def opening_tag(xml: Column) -> Column:
    """Lower-case name of the first element, by pattern: also of documents that are not well-formed."""
    return F.nullif(F.lower(F.regexp_extract(xml, r"^(?:\s|<\?[^>]*\?>|<!--(?:(?!-->)[\s\S])*-->|<!DOCTYPE[^>]*>)*<(?:[\w.-]+:)?([\w.-]+)", 1)), F.lit(""))


def locations(xml: Column) -> Column:
    """All <loc> values of a sitemap, trimmed, by pattern: malformed documents give what they have."""
    return F.transform(F.regexp_extract_all(xml, F.lit(r"<(?:[\w.-]+:)?loc(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?([^<\]]*?)\s*(?:\]\]>)?\s*</"), F.lit(1)), _unescape)


def _unescape(x: Column) -> Column:
    for code, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(code), F.lit(sign))
    return x


def links(xml: Column) -> Column:
    """array<struct<result_link, lastmod_date, pub_date, date>> of a urlset, aligned inside each <url>; only http(s) links."""
    urls = F.regexp_extract_all(xml, F.lit(r"<(?:[\w.-]+:)?url(?:\s[^>]*)?>([\s\S]*?)</(?:[\w.-]+:)?url\s*>"), F.lit(1))
    of = lambda u, tag: F.nullif(_unescape(F.trim(F.regexp_extract(u, rf"<(?:[\w.-]+:)?{tag}(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?([^<\]]*)", 1))), F.lit(""))
    found = F.transform(urls, lambda u: F.struct(of(u, "loc").alias("result_link"), iso_date(of(u, "lastmod")).alias("lastmod_date"), iso_date(of(u, "publication_date")).alias("pub_date")))
    dated = F.transform(found, lambda x: F.struct(x["result_link"].alias("result_link"), x["lastmod_date"].alias("lastmod_date"), x["pub_date"].alias("pub_date"), F.coalesce(x["pub_date"], x["lastmod_date"]).alias("date")))
    return F.filter(dated, lambda x: F.coalesce(x["result_link"].rlike("^https?://"), F.lit(False)))


WALKED = "url string, parent_url string, root_url string, depth long, root_tag string, processing_status string, children array<string>"


def walk(roots: DataFrame, responses: DataFrame, path: str | None = None, most_levels: int | None = None) -> DataFrame:
    """Breadth-first traversal: url, parent_url, root_url, depth, root_tag, processing_status of every sitemap that the roots reach.

    Every level is one join of the frontier with the responses; (root, url) pairs that are seen are not
    taken again, so it ends, however deep the tree. A level is a written generation under ``path``
    (a new folder if None); it counts when its job is committed. A walk over a path goes on after the
    last committed generation, with the roots that it began with; ``most_levels`` stops it for now after
    so many levels of this call. The only thing read back is whether a frontier is empty.
    """
    from newsflow.sources.tables import new_path

    spark = roots.sparkSession
    path = path or new_path(spark, "walk")
    fs = (make := spark.sparkContext._jvm.org.apache.hadoop.fs.Path)(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done_levels = next(n for n in count() if not fs.exists(make(f"{path}/level-{n}/_SUCCESS")))
    for level in count(done_levels):
        if level:
            done = _generations(spark, path, level)
            last = _generations(spark, path, level, level - 1)
            children = last.select(F.explode("children").alias("url"), F.col("url").alias("parent"), "root_url", (F.col("depth") + 1).alias("depth")).groupBy("url", "root_url", "depth").agg(F.min("parent").alias("parent_url"))
            frontier = children.join(done.select("url", "root_url"), ["url", "root_url"], "left_anti").select("url", "parent_url", "root_url", "depth")
            if frontier.limit(1).count() == 0:
                break
        else:
            frontier = roots.select(F.col("url"), F.lit(None).cast("string").alias("parent_url"), F.col("url").alias("root_url"), F.lit(0).cast("long").alias("depth")).distinct()
        if most_levels is not None and level - done_levels >= most_levels:
            break
        fetched = frontier.join(responses.select("url", "status", "body"), "url", "left")
        tag = root_tag(F.col("body"))
        status = F.when(F.col("status").isNull() | (F.col("status") != 200), "response_error").when(tag.isNull(), "xml_error").when(tag == "urlset", "scraped").when(tag == "sitemapindex", "subsitemap_sorted").otherwise("unsupported_root_tag")
        parsed = fetched.select("url", "parent_url", "root_url", "depth", tag.alias("root_tag"), status.alias("processing_status"), F.when(status == "subsitemap_sorted", locations(F.col("body"))).alias("children"))
        parsed.write.mode("overwrite").parquet(f"{path}/level-{level}")  # what an attempt left without commit goes
    return _generations(spark, path, next(n for n in count() if not fs.exists(make(f"{path}/level-{n}/_SUCCESS")))).drop("children")


def _generations(spark, path: str, end: int, start: int = 0) -> DataFrame:
    """The committed generations of a walk from ``start`` up to ``end``."""
    found = [f"{path}/level-{n}" for n in range(start, end)]
    return spark.read.schema(WALKED).parquet(*found) if found else spark.createDataFrame([], WALKED)


def roll_up(tree: DataFrame, root: str = "root_url") -> DataFrame:
    """tree (url, parent_url, processing_status, and root_url and root_tag where it has them) with the statuses of parents from what is below them, at any depth.

    A parent is done if all its children are, over with errors if all are over, else in progress; its
    own status is then its children's affair no more. So a parent has the least state of the leaves below it, and
    that is found by doubling: after k rounds each row knows the least of the leaves less than 2**k
    levels below, and its ancestor 2**k levels up. Rounds are the logarithm of the depth; each is two
    joins over the tree and a written table. Adds subsitemap_status and subsitemap_progress ("k of n"
    children are over), null where a row has no children. An index without children is in progress,
    "0 of 0". Rows whose parent is not there are roots; a tree that is not one raises.
    """
    from newsflow.sources.tables import materialize

    same = [root] if root in tree.columns else []
    index = F.coalesce(F.col("root_tag") == "sitemapindex", F.lit(False)) if "root_tag" in tree.columns else F.lit(False)
    good, bad = F.col("processing_status").isin(*DONE), F.col("processing_status").isin(*FAILED)
    # 2 done, 1 failed, 0 open
    own = F.when(good, 2).when(bad, 1).otherwise(0)
    children = tree.select(*same, F.col("parent_url").alias("url")).where("url is not null").groupBy(*same, "url").agg(F.count(F.lit(1)).alias("n"))
    nodes = tree.select(*same, "url", "parent_url", own.alias("own"), index.alias("index")).join(children, [*same, "url"], "left")
    # a parent's own state says nothing; that of an index without children is open
    state = F.when(F.col("n").isNotNull(), 2).when(F.col("index"), 0).otherwise(F.col("own"))
    current = materialize(nodes.select(*same, "url", F.col("parent_url").alias("up"), state.alias("least")), "roll-up")
    rounds, most = 0, max(1, current.count()).bit_length() + 1
    while current.where("up is not null").limit(1).count():
        rounds += 1
        if rounds > most:
            raise ValueError("the parents of some rows lead back to them")
        below = current.where("up is not null").groupBy(*same, F.col("up").alias("url")).agg(F.min("least").alias("__below"))
        above = current.select(*same, F.col("url").alias("up"), F.col("up").alias("__next"))
        moved = current.join(below, [*same, "url"], "left").join(above, [*same, "up"], "left")
        current = materialize(moved.select(*same, "url", F.col("__next").alias("up"), F.least("least", F.coalesce("__below", F.col("least"))).alias("least")), "roll-up")
    over = current.join(tree.select(*same, "url", "parent_url"), [*same, "url"]).where("parent_url is not null").groupBy(*same, F.col("parent_url").alias("url")).agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col("least") > 0).alias("__over"))
    told = tree.join(current.select(*same, "url", "least"), [*same, "url"]).join(over, [*same, "url"], "left")
    parent = F.col("__n").isNotNull() | index
    pick = lambda two, one, none: F.when(F.col("__n").isNull() | (F.col("least") == 0), none).when(F.col("least") == 2, two).otherwise(one)
    return told.withColumns({
        "processing_status": F.when(parent, pick("all_child_links_processed", "all_processed_some_errors", "in_progress")).otherwise(F.col("processing_status")),
        "subsitemap_status": F.when(parent, pick("fully_processed", "partially_failed", "in_progress")),
        "subsitemap_progress": F.when(parent, F.concat(F.coalesce("__over", F.lit(0)).cast("string"), F.lit(" of "), F.coalesce("__n", F.lit(0)).cast("string"))),
    }).select(*tree.columns, "subsitemap_status", "subsitemap_progress")


#: Rows of a group beyond which it is numbered by ranges and not in one task.
LARGE_GROUP = 50_000


def pagination_groups(df: DataFrame, url: str, parent: str | list[str], least: int = LEAST_GROUP) -> DataFrame:
    """pagination_group and pagination_index of files name-<n>.xml of which one parent has at least ``least`` (L2). ``parent``: the columns that tell parents apart (the parent, and the root where it is given); a group's name is unique inside its parent only.

    Groups are windows, dealt to as many tasks as their rows need. Those of more than LARGE_GROUP rows, of
    which there are at most one for so many rows, are numbered by ranges together.
    """
    from newsflow.sources.tables import materialize

    by = [parent] if isinstance(parent, str) else parent
    keys, order = [*by, "__k"], [F.col("__n").asc_nulls_last(), url]
    keyed = df.withColumn("__k", pagination_key(F.col(url))).withColumn("__n", pagination_number(F.col(url)))
    named = [F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]
    same = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.count("__n").alias("__size")).where(F.col("__rows") > LARGE_GROUP)
    large = materialize(sizes.select(*named, "__size"), "large-groups")
    some = large.limit(1).count() > 0
    small = keyed.join(F.broadcast(large), same, "left_anti") if some else keyed
    dealt = small.repartition(tasks_for(df.withColumn("__k", F.col(url)).withColumn("__n", F.lit(0))), *keys)  # a key is no longer than its URL
    w = Window.partitionBy(*keys)
    found = dealt.withColumn("__size", F.count("__n").over(w)).withColumn("__i", F.row_number().over(w.orderBy(*order)).cast("long"))
    if some:
        placed = numbered(keyed.join(F.broadcast(large), same).drop(*[f"__{i}" for i in range(len(keys))]), [*keys, *order], "__i")
        first = placed.groupBy(*keys).agg((F.min("__i") - 1).alias("__before")).select(*named, "__before")
        moved = placed.join(F.broadcast(first), same).withColumn("__i", F.col("__i") - F.col("__before"))
        found = found.unionByName(moved.select(*found.columns))
    grouped = F.col("__n").isNotNull() & (F.col("__size") >= least)
    return found.withColumn("pagination_group", F.when(grouped, F.col("__k"))).withColumn("pagination_index", F.when(grouped, F.col("__i"))).drop("__k", "__n", "__size", "__i")


#: Members of a group that an abort spares.
SPARED = ("response_error", "xml_error", "unsupported_root_tag")


def run_abort(df: DataFrame, group: str | list[str], order: str, status: str = "pagination_group_status", before: str = "date_before_range", least: int = 3) -> DataFrame:
    """A group with ``least`` consecutive pages before the range is given up (G18): its members that are not processed and have not failed become processed, excluded_by_date and aborted (columns processed, processing_status and ``status``). ``group``: the columns that tell groups apart; rows without a group stay."""
    by, tasks = [group] if isinstance(group, str) else group, tasks_for(df)
    # rows without a group are no group: they are dealt by their order
    apart = F.when(F.col(by[-1]).isNull(), F.pmod(F.xxhash64(order), F.lit(tasks)))
    inside = Window.partitionBy(*by, "__apart")
    w = inside.orderBy(order)
    hit = F.coalesce(F.col(status) == before, F.lit(False))
    # hits up to a row less those before its run began, which is where the last page that is none lies: one order serves all windows; rows of one place belong together
    marked = df.withColumn("__apart", apart).repartition(tasks, *by, "__apart").withColumn("__h", hit.cast("int"))
    place = Window.partitionBy(*by, "__apart", order)
    counted = marked.withColumn("__here", F.sum("__h").over(place)).withColumn("__other", F.min("__h").over(place) == 0).withColumn("__hits", F.sum("__h").over(w))
    began = F.coalesce(F.max(F.when(F.col("__other"), F.col("__hits") - F.col("__here"))).over(w), F.lit(0))
    longest = counted.withColumn("__run", F.col("__hits") - began).withColumn("__most", F.max("__run").over(inside))
    gone = (F.col("__most") >= least) & ~F.coalesce(F.col("processed"), F.lit(False)) & ~F.coalesce(F.col("processing_status").isin(*SPARED), F.lit(False)) & F.col(by[-1]).isNotNull()
    out = longest.withColumn("__gone", F.coalesce(gone, F.lit(False)))
    return out.withColumns({"processed": F.col("processed") | F.col("__gone"), "processing_status": F.when(F.col("__gone"), "excluded_by_date").otherwise(F.col("processing_status")), status: F.when(F.col("__gone"), "aborted").otherwise(F.col(status))}).drop("__apart", "__h", "__here", "__other", "__hits", "__run", "__most", "__gone")


def master_status(tree: DataFrame, log: DataFrame, key: str = "root_url") -> DataFrame:
    """input_processing_status per sitemap from its distinct statuses and its log's retry flags."""
    seen = tree.groupBy(key).agg(F.collect_set("processing_status").alias("s"))
    retry = log.groupBy(key).agg(F.bool_or("retry_flag").alias("r"))
    final, failed = F.array(*[F.lit(x) for x in DONE + FAILED]), F.array(*[F.lit(x) for x in FAILED])
    only_failed = F.forall("s", lambda x: F.array_contains(failed, x))
    over = F.forall("s", lambda x: F.array_contains(final, x))
    status = F.when(F.coalesce("r", F.lit(False)), "partially_processed_and_moved_to_retry").when(only_failed, "total_error").when(over, "fully_processed").otherwise("in_progress")
    return seen.join(retry, key, "left").select(key, status.alias("input_processing_status"))


def snapshots(body: Column) -> Column:
    """Timestamps of an archive listing: a JSON array of rows, the first a header."""
    rows = F.from_json(body, "array<array<string>>")
    return F.flatten(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))))


def child_order(children: DataFrame, parent: str, pos: str, url: str, excluded: list[str], date_from: str, date_to: str) -> DataFrame:
    """bucket and sort_place of a sitemap index's children: in range first, then unknown; excluded ones have no place (L1)."""
    from newsflow.functions.dates import url_date
    from newsflow.functions.urls import has_any

    dated = children.withColumn("__r", url_date(F.col(url), date_from, date_to)["reason"])
    bucket = F.when(has_any(F.col(url), excluded, ignore_case=False), "excluded_by_string").when(F.col("__r") == "out_of_range", "excluded_by_date").when(F.col("__r") == "in_range", "in_range").otherwise("unknown")
    marked = dated.withColumn("bucket", bucket).withColumn("__o", F.when(F.col("bucket") == "in_range", 0).when(F.col("bucket") == "unknown", 1))
    place = F.row_number().over(Window.partitionBy(parent, F.col("__o").isNull()).orderBy("__o", pos))
    return marked.withColumn("sort_place", F.when(F.col("__o").isNotNull(), place.cast("long"))).drop("__o", "__r")


def validate_groups(pages: DataFrame, group: str | list[str], index: str, tag: str, day: str, tolerance: int = 2) -> DataFrame:
    """group and pagination_group_status from its first, middle and last page (G17): urlsets only, dates monotone. ``group``: the columns that tell groups apart."""
    from newsflow.operators.relational import monotone

    by = [group] if isinstance(group, str) else group
    w = Window.partitionBy(*by)
    n, r = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(index))
    probe = pages.withColumn("__n", n).withColumn("__r", r).where((F.col("__r") == 1) | (F.col("__r") == F.ceil(F.col("__n") / 2)) | (F.col("__r") == F.col("__n")))
    kinds = probe.groupBy(*by).agg(F.bool_and(F.coalesce(F.col(tag) == "urlset", F.lit(False))).alias("__all"))
    order = monotone(probe, by, [index], day, tolerance)
    return kinds.join(order, by).select(*by, F.when(F.col("__all"), F.col("direction")).otherwise("invalid_urlsets").alias("pagination_group_status"))


def next_work(tree: DataFrame) -> DataFrame:
    """The one row to fetch next (G20): rows without a group by parent and place, then grouped ones by parent, group and index."""
    grouped = F.col("pagination_group").isNotNull().cast("int")
    order = [grouped, "parent_id", F.coalesce("pagination_group", F.lit("")), F.coalesce("pagination_index", "sort_place"), "id"]
    return tree.where("not processed").orderBy(*order).limit(1)


def retry_rows(log: DataFrame) -> DataFrame:
    """Default progression rows for the retry-flagged rows of a response log, one per URL."""
    return log.where("retry_flag").select("root_url", "url").distinct().select("root_url", "url", F.lit(False).alias("processed"), F.lit("in_progress").alias("processing_status"), F.lit("unknown").alias("root_tag"))


def snapshot_url(stamp: Column, url: Column, archive: str) -> Column:
    """Address of an archived copy."""
    return F.concat(F.lit(archive.rstrip("/") + "/"), stamp, F.lit("id_/"), url)


def scrape_urlsets(bodies: DataFrame, date_from: str, date_to: str, body: str = "body") -> DataFrame:
    """bodies with in_range, urlset_link_count, urlset_date_range and urlset_content (K4)."""
    from newsflow.functions.dates import span_text, urlset_range

    found = bodies.withColumn("__l", links(F.col(body)))
    days = F.col("__l.date")
    return found.withColumns({
        "in_range": urlset_range(days, date_from, date_to)["reason"], "urlset_link_count": F.size("__l").cast("long"),
        "urlset_date_range": F.nullif(span_text(F.array_min(days), F.array_max(days)), F.lit("")), "urlset_content": F.col(body),
    }).drop("__l")


def progression_upsert(old: DataFrame, new: DataFrame, key: str = "current_url") -> DataFrame:
    """The progression table after an update (G16): new values where given; an old root_tag stays unless it is unknown, a group unless a new one is given."""
    a, b = old.alias("a"), new.alias("b")
    pick = []
    for c in (c for c in old.columns if c != key):
        was, now = F.col(f"a.{c}"), F.col(f"b.{c}") if c in new.columns else F.lit(None)
        pick.append((F.when(F.coalesce(was, F.lit("unknown")) != "unknown", was).otherwise(F.coalesce(now, was)) if c == "root_tag" else F.coalesce(now, was)).alias(c))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), *pick)


def dissolve_groups(tree: DataFrame, group: str = "pagination_group", parent: list[str] | None = None) -> DataFrame:
    """Groups that hold a sitemapindex are dissolved: their members lose group and index (G19). ``parent``: the columns inside which a group's name is unique."""
    by = [*(parent or []), group]
    mixed = tree.where((F.col("root_tag") == "sitemapindex") & F.col(group).isNotNull()).select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)]).distinct().withColumn("__hit", F.lit(True))
    hit = tree.join(mixed, [F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(by)], "left")
    gone = F.col("__hit").isNotNull()
    return hit.withColumns({
        "pagination_group_status": F.when(gone, "dissolved").otherwise(F.col("pagination_group_status")), "pagination_index": F.when(~gone, F.col("pagination_index")), group: F.when(~gone, F.col(group)),
    }).drop("__hit", *[f"__g{i}" for i in range(len(by))])


def reset_master(master: DataFrame, retry: DataFrame, key: str = "root_url") -> DataFrame:
    """Master rows of sitemaps that are tried again, set back to their defaults."""
    again = retry.select(key).distinct().withColumn("__again", F.lit(True))
    hit = F.coalesce("__again", F.lit(False))
    joined = master.join(again, key, "left")
    defaults = {"input_processing_status": F.lit("in_progress"), "total_request_count": F.lit(0).cast("long"), "total_urlsets_scraped": F.lit(0).cast("long"), "processing_flag": F.lit("retry")}
    return joined.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in defaults.items()}).drop("__again")
