"""Column functions over URLs, hosts and identifiers. Null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """Lower-cased host without scheme, user, port and leading ``www.``: the canonical key of every rule join."""
    return F.lower(F.regexp_replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]*)", 1), r"(?i)^www\.", ""))


def extract_domain(url: Column) -> Column:
    """The host less its last label: https://www.a-b.de/x -> a-b."""
    return F.regexp_replace(host(url), r"\.[^.]*$", "")


def domain_key(domain: Column) -> Column:
    """What stands before the first dot."""
    return F.substring_index(domain, ".", 1)


def ensure_suffix(domain: Column, suffix: str = ".de") -> Column:
    return F.when(domain.endswith(suffix), domain).otherwise(F.concat(domain, F.lit(suffix)))


def trim_slash(url: Column) -> Column:
    """One trailing slash off."""
    return F.regexp_replace(url, "/$", "")


def path(url: Column) -> Column:
    """From the first slash behind the host; empty if there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/]*(/[^?#]*)?", 1)


def slashes(text: Column) -> Column:
    """How many slashes a text has."""
    return (F.length(text) - F.length(F.replace(text, F.lit("/"), F.lit("")))).cast("long")


def basename(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def pagination_key(url: Column) -> Column:
    """The file name without the page number before .xml."""
    return F.regexp_replace(basename(url), r"-?[0-9]+(?=\.xml)", "")


def pagination_number(url: Column) -> Column:
    """The digits before .xml, or null."""
    return F.nullif(F.regexp_extract(basename(url), r"([0-9]+)\.xml", 1), F.lit("")).try_cast("long")


def shape(url: Column) -> Column:
    """Struct of no_html (does not end in .html), no_digit (no digit behind the site's name) and live (a live page)."""
    rest = F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/]*", "")
    return F.struct((~url.rlike(r"\.html$")).alias("no_html"), (~rest.rlike("[0-9]")).alias("no_digit"), url.rlike("liveblog|live").alias("live"))


def sanitize(text: Column) -> Column:
    """An identifier: letters, digits, underscore and hyphen."""
    return F.regexp_replace(text, "[^a-zA-Z0-9_-]", "")


def escape_dots(text: Column) -> Column:
    return F.replace(text, F.lit("."), F.lit("\\."))


def path_pattern(domain: Column, paths: Column) -> Column:
    """One pattern for the path rules of a domain; only the host is escaped, paths are patterns themselves."""
    return F.concat(F.lit(r"^https?://(www\.)?"), escape_dots(domain), F.lit("/.*?("), F.concat_ws("|", paths), F.lit(")"))


def relative_rule(rule: Column) -> Column:
    """A path rule that was written as a whole URL, without scheme and host."""
    return F.regexp_replace(F.regexp_replace(rule, r"^https?://(?:www\.)?[^/]+", ""), "^/", "")


def has_any(text: Column, words: list[str], ignore_case: bool = True) -> Column:
    """Whether one of the words or patterns occurs; null text: false."""
    return F.coalesce(text.rlike(("(?i)" if ignore_case else "") + "|".join(words)), F.lit(False))


def browser(agent: Column) -> Column:
    """Browser family by what a user-agent string contains; the order matters, since most names contain others."""
    return (
        F.when(F.contains(agent, F.lit("Edg")), "Edge").when(F.contains(agent, F.lit("OPR")), "Opera").when(F.contains(agent, F.lit("Firefox")), "Firefox")
        .when(F.contains(agent, F.lit("Chrome")), "Chrome").when(F.contains(agent, F.lit("Safari")), "Safari").otherwise("Other")
    )


def is_mobile(agent: Column) -> Column:
    return F.coalesce(agent.rlike("Mobile|Android|iPhone|iPad"), F.lit(False))


def robots_sitemaps(body: Column) -> Column:
    """Distinct sitemap addresses of a robots.txt body, in order."""
    flat = F.regexp_replace(body, r"[\r\n]+", " ")
    return F.array_distinct(F.regexp_extract_all(flat, F.lit(r"(?i)sitemap:\s*(https?://[\w./~:-]+)"), F.lit(1)))
