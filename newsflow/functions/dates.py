"""Dates in URLs, in sitemaps and in article metadata. Nothing raises: what is no date is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names and their numbers.
MONTHS = {
    "januar": 1, "january": 1, "jan": 1, "februar": 2, "february": 2, "feb": 2, "märz": 3, "maerz": 3, "march": 3, "mär": 3, "mae": 3, "mar": 3,
    "april": 4, "apr": 4, "mai": 5, "may": 5, "juni": 6, "june": 6, "jun": 6, "juli": 7, "july": 7, "jul": 7, "august": 8, "aug": 8,
    "september": 9, "sep": 9, "oktober": 10, "october": 10, "okt": 10, "oct": 10, "november": 11, "nov": 11, "dezember": 12, "december": 12, "dez": 12, "dec": 12,
}
_Y, _M, _D, _S = r"(?:19|20)\d\d", r"0[1-9]|1[0-2]", r"0[1-9]|[12]\d|3[01]", "[-_/]"
_NAMES = "|".join(sorted(MONTHS, key=lambda n: (-len(n), n)))

#: Name, pattern, group of the year, group of the month (0: whole year); equal starts go to the earlier row.
PATTERNS = (
    ("ymd", rf"(?<!\d)({_Y}){_S}({_M}){_S}(?:{_D})(?!\d)", 1, 2),
    ("ymd_compact", rf"(?<!\d)({_Y})({_M})(?:{_D})(?!\d)", 1, 2),
    ("dmy", rf"(?<!\d)(?:{_D}){_S}({_M}){_S}({_Y})(?!\d)", 2, 1),
    ("dmy_compact", rf"(?<!\d)[0-3]\d([0-3]\d)({_Y})(?!\d)", 2, 1),
    ("month_year", rf"(?<!\d)({_M}|[1-9]){_S}({_Y})(?!\d)", 2, 1),
    ("ym", rf"(?<!\d)({_Y}){_S}({_M})(?!\d)", 1, 2),
    ("ym_compact", rf"(?<!\d)({_Y})({_M})(?!\d)", 1, 2),
    ("monthname_year", rf"({_NAMES})({_Y})", 2, 1),
    ("ym_monthname", rf"({_Y})({_NAMES})", 1, 2),
    ("year_only", rf"(?<!\d)({_Y})(?!\d)", 1, 0),
)


def url_date(url: Column, date_from: str, date_to: str) -> Column:
    """Struct of decision, reason, pattern, start and end: the leftmost date of a URL against a window of days.

    A date counts as its whole month, a lone year as the year. No date, or an impossible month: proceed.
    """
    text = F.lower(url)
    hits = F.filter(F.array(*[F.struct(F.regexp_instr(text, F.lit(p)).alias("pos"), F.lit(i).alias("ord")) for i, (_, p, _, _) in enumerate(PATTERNS)]), lambda x: x["pos"] > 0)
    names = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    labels = F.array(*[F.lit(label) for label, *_ in PATTERNS])

    def pick(at: Column, group: int) -> Column:
        """Group 2: the year, 3: the month, of the pattern that was hit."""
        out = F.lit(None).cast("string")
        for i, row in reversed(list(enumerate(PATTERNS))):
            out = F.when(at == i, F.regexp_extract(text, row[1], row[group]) if row[group] else F.lit("1")).otherwise(out)
        return out

    def parts(at: Column) -> Column:
        month = pick(at, 3)
        return F.struct(pick(at, 2).try_cast("int").alias("year"), F.coalesce(month.try_cast("int"), F.element_at(names, month)).alias("month"), F.element_at(labels, at + 1).alias("name"))

    def interval(x: Column) -> Column:
        start = F.when(x["month"].between(1, 12), F.make_date(x["year"], x["month"], F.lit(1)))
        end = F.when(x["name"] == "year_only", F.make_date(x["year"], F.lit(12), F.lit(31))).otherwise(F.last_day(start))
        return F.struct(x["name"].alias("name"), start.alias("start"), end.alias("end"))

    def decide(x: Column) -> Column:
        inside = (x["start"] <= F.lit(date_to).cast("date")) & (x["end"] >= F.lit(date_from).cast("date"))
        reason = F.when(x["start"].isNull(), "no_date").when(inside, "in_range").otherwise("out_of_range")
        found = x["start"].isNotNull()
        return F.struct(F.when(found & ~inside, "exclude").otherwise("proceed").alias("decision"), reason.alias("reason"), F.when(found, x["name"]).otherwise("none").alias("pattern"), x["start"].alias("start"), F.when(found, x["end"]).alias("end"))

    # one-element arrays bind each intermediate value once
    out = F.array(F.array_min(hits)["ord"])
    for step in (parts, interval, decide):
        out = F.transform(out, step)
    return F.element_at(out, 1)


def iso_date(text: Column) -> Column:
    """The date of an ISO date or datetime; any other shape is null."""
    day = F.regexp_replace(text, "T.*$", "")
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(day, "yyyy-MM-dd"))


def urlset_range(dates: Column, date_from: str, date_to: str) -> Column:
    """Struct of reason and first: whether any of a urlset's dates lies in a window, and the least that does."""
    inside = F.filter(dates, lambda d: d.between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))
    known = F.filter(dates, lambda d: d.isNotNull())
    reason = F.when(F.size(known) == 0, "no_lastmod_found").when(F.size(inside) > 0, "in_range").otherwise("out_of_range")
    return F.struct(reason.alias("reason"), F.array_min(inside).alias("first"))


def stamp_date(text: Column) -> Column:
    """The date of a timestamp that begins with yyyyMMdd."""
    return F.try_to_date(F.substring(text, 1, 8), "yyyyMMdd")


def http_date(text: Column) -> Column:
    """An HTTP date such as ``Tue, 05 Mar 2024 10:00:00 GMT``."""
    return F.try_to_timestamp(F.substring(text, 6, 100), F.lit("dd MMM yyyy HH:mm:ss zzz"))


def german_datetime(text: Column, zone: str = "Europe/Berlin") -> Column:
    """dd.MM.yyyy with a time behind a comma, hyphen or space, ``Uhr`` ignored; local time to UTC."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?i)\s*uhr", ""), r"\s*[,–-]\s*|\s+", " "))
    return F.to_utc_timestamp(F.coalesce(F.try_to_timestamp(plain, F.lit("d.M.yyyy H:mm")), F.try_to_timestamp(plain, F.lit("d.M.yyyy"))), zone)


def iso_datetime(text: Column) -> Column:
    return F.try_to_timestamp(text)


def span_text(first: Column, last: Column) -> Column:
    """``min - max`` of two dates."""
    return F.concat_ws(" - ", F.date_format(first, "yyyy-MM-dd"), F.date_format(last, "yyyy-MM-dd"))
