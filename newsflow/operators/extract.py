"""Field extraction from stored pages by declarative rules, paywall and bot detection, marker mining.

A rule is a row (domain, field, priority, kind, selectors, attributes, raw, exclude): kind css, json_ld,
data_layer (names of members) or next (elements of the tag in attributes that follow the selectors). Rules are data; code is never read from them. All rules of a run go to the workers in one
closure, and one pass over the pages computes every field and flag, so no page is parsed twice.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from newsflow.functions.urls import host
from newsflow.sources.html import page_tables, parse, search, select

FIELDS = ("date_time", "author", "headline", "text")
#: Rules that hold for every domain, after its own: (field, priority, kind, selectors, attributes).
DEFAULT_RULES = [
    ("*", "date_time", 10, "json_ld", ["datePublished"], []), ("*", "date_time", 20, "css", ["meta[property='article:published_time']", "meta[name=date]"], ["content"]), ("*", "date_time", 30, "css", ["time[datetime]"], ["datetime"]),
    ("*", "author", 10, "json_ld", ["author"], []), ("*", "author", 20, "css", ["meta[name=author]"], ["content"]), ("*", "author", 30, "css", ["[rel=author]", ".author"], []),
    ("*", "headline", 10, "json_ld", ["headline"], []), ("*", "headline", 20, "css", ["meta[property='og:title']"], ["content"]), ("*", "headline", 30, "css", ["h1"], []), ("*", "headline", 40, "css", ["title"], []),
    ("*", "text", 10, "json_ld", ["articleBody"], []), ("*", "text", 20, "css", ["article p"], []), ("*", "text", 30, "css", ["main p", "p"], []),
]
DEFAULT_PAYWALL = [".paywall", "[class*=paywall]", "[data-paywall]"]
#: What a challenge page shows: selectors, phrases in title or body (any case), patterns in scripts (exact case).
DEFAULT_BOT = {"selectors": ["#challenge-form", ".g-recaptcha", "[class*=captcha]"], "phrases": ["verify you are human", "access denied", "are you a robot", "unusual traffic"], "scripts": ["challenge-platform", "recaptcha/api.js"]}
EXTRACTED = "parsed boolean, bot boolean, paywall_marker boolean, title string, date_time string, author string, headline string, text string, paragraphs array<string>"


def _whole(digits: str) -> int | float:
    """An int of JSON; one of more digits than an int takes is a float, so that its script is not lost."""
    return int(digits) if len(digits) < 4000 else float(digits)


def json_ld(root) -> list[dict]:
    """All objects of a page's JSON-LD scripts, those of @graph too; broken scripts, and such as are nested deeper than can be read, are passed over."""
    out: list[dict] = []
    for node in select(root, "script[type='application/ld+json']"):
        try:
            stack = [json.loads(node.raw_text(), parse_int=_whole)]
        except (ValueError, RecursionError):
            continue
        while stack:
            x = stack.pop(0)
            if isinstance(x, list):
                stack += x
            elif isinstance(x, dict):
                out.append(x)
                stack += x["@graph"] if isinstance(x.get("@graph"), list) else [x.get("@graph")]
    return out


def json_values(objects: list[dict], name: str) -> list[str]:
    """Values of a property: strings as they are, names of objects, each of a list."""
    out = []
    for o in objects:
        for v in o.get(name) if isinstance(o.get(name), list) else [o.get(name)]:
            v = v.get("name") if isinstance(v, dict) else v
            if isinstance(v, str) and v.strip():
                out.append(v.strip())
    return out


_KEY = re.compile(r"([{,]\s*)([A-Za-z_$][\w$.]*)\s*:")


def data_layer(root, name: str = "dataLayer") -> dict:
    """The members of the object literals that scripts push to ``name`` (K13): bare keys, single quotes and trailing commas are read; what is no data is passed over."""
    out: dict = {}
    for node in select(root, "script"):
        for m in re.finditer(rf"{re.escape(name)}\.push\((\{{[\s\S]*?\}})\)", node.raw_text()):
            text = re.sub(r"'((?:[^'\\]|\\.)*)'", lambda q: json.dumps(q[1].replace("\\'", "'")), m[1])
            try:
                out |= json.loads(re.sub(r",\s*([}\]])", r"\1", _KEY.sub(r'\1"\2":', text)))
            except ValueError:
                continue
    return out


def following(root, selectors: list[str], tag: str) -> list[str]:
    """Texts of the elements ``tag`` that come after what the selectors take, under the same parent (K7)."""
    out = []
    for s in selectors:
        for node in select(root, s):
            beside = node.parent.children if node.parent is not None else []
            at = next((i for i, c in enumerate(beside) if c is node), len(beside))
            out += [t for c in beside[at + 1 :] if not isinstance(c, str) and c.tag == tag and (t := c.text()).strip()]
    return out


def bot_rules(rules: DataFrame) -> dict[str, list[str]]:
    """Rules from a table (kind: selectors, phrases or scripts; value), a few dozen rows (K17). Phrases are compared in lower case."""
    out: dict[str, list[str]] = {"selectors": [], "phrases": [], "scripts": []}
    for r in rules.orderBy("kind", "value").collect():
        out[r.kind].append(r.value.lower() if r.kind == "phrases" else r.value)
    return out


def paywall_selectors(markers: DataFrame) -> DataFrame:
    """(domain, selectors) from a table of markers (domain, type: css or meta, marker), a row per domain (K18): a meta marker is a meta element with that content."""
    selector = F.when(F.col("type") == "css", F.col("marker")).otherwise(F.concat(F.lit("meta[content='"), "marker", F.lit("']")))
    return markers.groupBy("domain").agg(F.sort_array(F.collect_set(selector)).alias("selectors"))


def is_bot_page(root, rules: dict) -> bool:
    if any(select(root, s) for s in rules["selectors"]):
        return True
    shown = " ".join(n.text() for n in select(root, "title, body")).lower()
    if any(p in shown for p in rules["phrases"]):
        return True
    scripts = " ".join(n.attrs.get("src", "") + " " + n.raw_text() for n in select(root, "script"))
    return any(p in scripts for p in rules["scripts"])


def fields(root, rules: list[tuple]) -> dict[str, str | None]:
    """Each field by its first rule, in order of priority, that gives a value. Texts join all values, other fields take the first."""
    objects, out = json_ld(root), dict.fromkeys(FIELDS)
    for _, field, _, kind, what, attributes in sorted(rules, key=lambda r: (r[0] == "*", r[2])):
        if out[field] is None:
            if kind == "json_ld":
                values = [v for w in what for v in json_values(objects, w)]
            elif kind == "data_layer":
                layer = data_layer(root)
                values = [str(layer[w]) for w in what if layer.get(w) not in (None, "")]
            elif kind == "next":
                values = following(root, what, attributes[0])
            else:
                values = search(root, what, attributes, every=False)
            if values:
                out[field] = "\n".join(values) if field == "text" else ", ".join(values) if field == "author" else values[0]
    return out


def paragraphs(root, least: int = 20, but: tuple[str, ...] = ("^Anzeige$",)) -> list[str]:
    """Paragraph texts of more than ``least`` characters that match none of the patterns."""
    return [t for t in search(root, ["p"]) if len(t) > least and not any(re.search(p, t) for p in but)]


#: Pages whose values are Python's at one time; the others of a batch are Arrow's, which is compact.
SLICE = 100


def _in_slices(one, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """one(value of each column) of every row, row by row, as an Arrow array of ``kind``."""
    out, done = [], []
    for row in zip(*columns, strict=True):
        out.append(one(*(v.as_py() for v in row)))
        if len(out) == SLICE:
            done.append(pa.array(out, kind))
            out = []
    return pa.concat_arrays([*done, pa.array(out, kind)])


def extract(pages: DataFrame, html: str = "html", url: str = "url", rules: list[tuple] | None = None, paywall: DataFrame | None = None, bot: dict | None = None) -> DataFrame:
    """pages with a struct ``x``: parsed, bot, paywall_marker, title, the four fields and the paragraphs.

    ``paywall``: markers per domain (domain, type, marker); they meet the pages by a join on the host, and
    pages of domains that have none are tried by the usual ones.
    """
    rules, bot = rules or DEFAULT_RULES, bot or DEFAULT_BOT

    def one(page: str | None, domain: str | None, markers) -> tuple:
        root = parse(page)
        if root is None:
            return (False, False, None, None, None, None, None, None, [])
        own = [r for r in rules if r[0] in ("*", domain)]
        found = fields(root, own)
        marker = any(select(root, s) for s in (DEFAULT_PAYWALL if markers is None else markers))
        out = (True, is_bot_page(root, bot), marker, next(iter(search(root, ["title"])), None), *[found[f] for f in FIELDS], paragraphs(root))
        root.free()
        return out

    names = [part.split(" ")[0] for part in re.split(r", (?=\w+ )", EXTRACTED)]
    kind = pa.struct([(n, pa.bool_() if n in ("parsed", "bot", "paywall_marker") else pa.list_(pa.string()) if n == "paragraphs" else pa.string()) for n in names])

    @arrow_udf(EXTRACTED)
    def run(page: pa.Array, domain: pa.Array, markers: pa.Array) -> pa.Array:
        return _in_slices(lambda *row: dict(zip(names, one(*row), strict=True)), kind, page, domain, markers)

    if paywall is None:
        return pages.withColumn("x", run(F.col(html), host(F.col(url)), F.lit(None).cast("array<string>")))
    told = paywall_selectors(paywall).select(F.col("domain").alias("__domain"), F.col("selectors").alias("__selectors"))
    named = pages.withColumn("__host", host(F.col(url))).join(told, F.col("__host") == F.col("__domain"), "left")
    return named.withColumn("x", run(F.col(html), F.col("__host"), F.col("__selectors"))).drop("__host", "__domain", "__selectors")


def source_title(html: Column) -> Column:
    """The first title element as the source has it: only &lt; &gt; and &amp; are replaced, in that order, and blanks made one; blank or none: null. ``extract`` has the title as a browser shows it."""
    x = F.regexp_extract(html, r"(?s)<title[^>]*>(.*?)</title>", 1)
    for code, sign in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = F.replace(x, F.lit(code), F.lit(sign))
    return F.nullif(F.regexp_replace(F.regexp_replace(x, r"[\t\n\f\r ]+", " "), r"^\p{Zs}+|\p{Zs}+\z", ""), F.lit(""))


def paywall_decision(special: Column, has_paywall: Column, marker: Column) -> Column:
    """Three-valued paywall (K20): a special rule, then unknown domains stay null, then markers, else false."""
    return F.when(special.isNotNull(), special).when(has_paywall.isNull(), F.lit(None).cast("boolean")).when(has_paywall & marker, True).otherwise(False)


def paywall_by_length(text: Column, low: int = 300, high: int = 500) -> Column:
    """Texts whose trimmed length lies between low and high are teasers; null: false."""
    return F.coalesce(F.length(F.trim(text)).between(low, high), F.lit(False))


def agency_text(headline: Column, date_time: Column, text: Column, author: Column) -> Column:
    """Struct of text and author: agency reports without both get the headline and 'dpa' (K16)."""
    bare = headline.isNotNull() & date_time.isNotNull() & text.isNull() & author.isNull()
    return F.struct(F.when(bare, headline).otherwise(text).alias("text"), F.when(bare, "dpa").otherwise(author).alias("author"))


#: Parts of names that may mark a paywall.
KEYWORDS = ("paywall", "premium", "plus", "subscribe", "abo", "metered", "locked", "paid")


def mine_markers(html: Column, keywords: tuple[str, ...] = KEYWORDS, scripts: tuple[str, ...] = ()) -> Column:
    """array<struct<type, marker>>: tag.class, tag#id, attributes and meta contents that hold a keyword, and script patterns that match (K21). Keywords and patterns are the caller's data."""
    def one(page):
        root = parse(page)
        found = set()
        for n in root.walk() if root is not None else ():
            for c in n.attrs.get("class", "").split():
                if any(k in c.lower() for k in keywords):
                    found.add(("css", f"{n.tag}.{c}"))
            if any(k in n.attrs.get("id", "").lower() for k in keywords):
                found.add(("css", f"{n.tag}#{n.attrs['id']}"))
            for a in n.attrs:
                if a not in ("class", "id", "href", "src", "content") and any(k in a for k in keywords):
                    found.add(("css", f"{n.tag}[{a}]"))
            if n.tag == "meta" and any(k in n.attrs.get("content", "").lower() for k in keywords):
                found.add(("meta", n.attrs["content"]))
            if n.tag == "script" and scripts:
                text = n.raw_text()
                found |= {("script", p) for p in scripts if re.search(p, text)}
        if root is not None:
            root.free()
        return [{"type": t, "marker": m} for t, m in sorted(found)]

    @arrow_udf("array<struct<type: string, marker: string>>")
    def run(pages: pa.Array) -> pa.Array:
        return _in_slices(one, pa.list_(pa.struct([("type", pa.string()), ("marker", pa.string())])), pages)

    return run(html)


def exclusive_markers(samples: DataFrame) -> DataFrame:
    """(domain, type, marker) of paywalled pages that no free page of the domain has (K22). samples: domain, label, html."""
    marked = samples.select("domain", "label", F.explode(mine_markers(F.col("html"))).alias("m")).select("domain", "label", "m.type", "m.marker").distinct()
    return marked.where("label = 'paywalled'").drop("label").join(marked.where("label = 'free'").drop("label"), ["domain", "type", "marker"], "left_anti")


def resolve_paywall_rules(domains: DataFrame, mined: DataFrame, fixed: DataFrame) -> DataFrame:
    """Per domain the rule in force, by priority: no_paywall, all_paywall, fixed markers, mined markers, none."""
    m, f = (t.groupBy("domain").agg(F.array_sort(F.collect_set("marker")).alias(n)) for t, n in ((mined, "mined"), (fixed, "fixed")))
    joined = domains.join(f, "domain", "left").join(m, "domain", "left")
    rule = F.when(F.col("paywall_url") == "no_paywall", "no_paywall").when(F.col("paywall_url") == "all_paywall", "all_paywall").when(F.col("fixed").isNotNull(), "hardcoded").when(F.col("mined").isNotNull(), "mined").otherwise("no_samples")
    return joined.select("domain", rule.alias("rule"), F.when(rule == "hardcoded", F.col("fixed")).when(rule == "mined", F.col("mined")).alias("markers"))


def first_values(html: Column, selectors: list[str], most: int) -> Column:
    """array<string>: the texts of the first ``most`` elements that the selectors take."""
    def one(page):
        if (root := parse(page)) is None:
            return []
        out = search(root, selectors, most=most)
        root.free()
        return out

    @arrow_udf("array<string>")
    def run(pages: pa.Array) -> pa.Array:
        return _in_slices(one, pa.list_(pa.string()), pages)

    return run(html)


def html_tables(html: Column) -> Column:
    """array<array<array<string>>>: tables, rows, cells of a page (A5). Rows are taken while a page is read, and each page's go to Arrow at once."""
    kind = pa.list_(pa.list_(pa.list_(pa.string())))

    @arrow_udf("array<array<array<string>>>")
    def run(pages: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], kind), *(pa.array([page_tables(p.as_py())], kind) for p in pages)])

    return run(html)
