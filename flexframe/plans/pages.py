"""Page-extraction jobs over a table of fetched pages ``(page_id, url, html)``.

Each page is one row, so everything that is "per page" (all links of a page,
the first N after an offset, the related tabs up to a stop marker) is an
array expression on that row: ``regexp_extract_all`` then ``filter`` /
``slice`` / ``posexplode``. No window, no shuffle, and a page is never split
across tasks. Only the totals shuffle, on their key, with map-side partial
aggregation.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.urls import referer, search_url, url_extension, without_query

# Patterns of the page layouts we read.
HREF_PATTERN = r'href="([^"]*)"'
IMGPT_PATTERN = r'(?s)class="imgpt".*?m="(\{.*?\})"'
TAB_PATTERN = r'(?s)class="dtviD".*?href="([^"]*)"'
TAB_NAME_PATTERN = r",g_1:([^:&]*)"
TAB_STOP_NAME = "background-color"
TAB_NAME_LIMIT = 100
# The form of a character reference, and the code points that HTML reads as others or as nothing.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
OTHER_CODES = {0x00: "\ufffd", 0x0D: "\r"} | {c: bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)}
NO_CODES = [(0x01, 0x08), (0x0B, 0x0B), (0x0E, 0x1F), (0x7F, 0x7F), (0xFDD0, 0xFDEF)]
METADATA_SCHEMA = StructType([StructField(n, StringType()) for n in ("murl", "desc", "purl", "turl")])


def _named(ref: Column) -> Column:
    """The characters of a named reference (with its semicolon, if it has one); null if there is no such name.

    The names are one literal map of maps, by their first two letters, so that
    a lookup passes over a few hundred entries and not all of them.
    """
    table: dict[str, dict[str, str]] = {}
    for name, value in html5.items():
        table.setdefault(name[:2], {})[name] = value
    names = F.from_json(F.lit(json.dumps(table)), "map<string,map<string,string>>")
    return F.try_element_at(F.try_element_at(names, F.substring(ref, 1, 2)), ref)


def _code(ref: Column) -> Column:
    """The character of a numeric reference, by the rules for code points that are none."""
    decimal = F.regexp_extract(ref, "^#0*([0-9]*)", 1)
    hexadecimal = F.regexp_extract(ref, "^#[xX]0*([0-9a-fA-F]*)", 1)
    beyond = F.lit(0x110000).cast("long")
    code = F.when(ref.rlike("^#[xX]"), F.when(F.length(hexadecimal) > 6, beyond).otherwise(F.conv(F.concat(F.lit("0"), hexadecimal), 16, 10).cast("long"))).otherwise(
        F.when(F.length(decimal) > 7, beyond).otherwise(F.concat(F.lit("0"), decimal).cast("long")))

    def char(n: Column) -> Column:
        other = F.create_map(*[F.lit(x) for pair in OTHER_CODES.items() for x in pair])
        none = (n.bitwiseAND(0xFFFE) == 0xFFFE) & (n < 0x110000)
        for low, high in NO_CODES:
            none = none | n.between(low, high)
        bytes_of = F.unhex(F.lpad(F.hex(F.when((n >= 0x110000) | n.between(0xD800, 0xDFFF), 0xFFFD).otherwise(n)), 8, "0"))
        return F.coalesce(F.try_element_at(other, n.cast("int")), F.when(none, F.lit("")).otherwise(F.decode(bytes_of, "UTF-32")))

    return F.get(F.transform(F.array(code), char), F.lit(0))


def unescape(c: Column) -> Column:
    """HTML character references undone: numeric ones, and all named ones of HTML 5, some of which need no semicolon.

    Where no name fits as a whole, the longest of those without a semicolon
    that begins the reference counts. The text is cut at its references once,
    so what a reference gives is not read again.
    """
    bare = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)

    def one(ref: Column) -> Column:
        start = F.regexp_extract(ref, "^(" + "|".join(bare) + ")", 1)
        partly = F.when(start != "", F.concat(_named(start), F.substring(ref, F.length(start) + 1, F.length(ref))))
        return F.when(ref.startswith("#"), _code(ref)).otherwise(F.coalesce(_named(ref), partly, F.concat(F.lit("&"), ref)))

    refs = F.regexp_extract_all(c, F.lit(REFERENCE), 1)
    gaps = F.split(c, REFERENCE, -1)
    joined = F.array_join(F.zip_with(gaps, F.transform(refs, one), lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")
    return F.when(F.instr(c, "&") > 0, joined).otherwise(c)


def page_links(pages: DataFrame, pattern: str = HREF_PATTERN) -> DataFrame:
    """Distinct links of every page: ``(page_id, link)``; a page is one row, so nothing is shuffled."""
    return pages.select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(pattern), 1))).alias("link"))


def link_filter(link: Column, thumbnail_host: str | None = None) -> Column:
    """Links that start with ``http`` and are not served from the thumbnail host."""
    cond = link.startswith("http")
    if thumbnail_host:
        cond = cond & ~link.startswith(thumbnail_host)
    return cond


def url_filter(url: Column, ignore: list[str] | None = None, formats: list[str] | None = None) -> Column:
    """Not containing any ignored substring; extension in ``formats`` when given."""
    cond = F.lit(True)
    for s in ignore or []:
        cond = cond & ~F.coalesce(url.contains(s), F.lit(False))
    if formats:
        cond = cond & url_extension(url).isin(*[f.lower() for f in formats])
    return cond


def top_links(pages: DataFrame, limit: int, offset: int = 0, ok: callable = None, pattern: str = HREF_PATTERN) -> DataFrame:
    """Per page, in page order: skip the first ``offset-1`` parsable items, then
    take successes (``ok``) until ``limit-offset+1`` of them; failures are not counted.
    """
    ok = ok or (lambda x: x.startswith("http"))
    items = F.filter(F.regexp_extract_all("html", F.lit(pattern), 1), lambda x: x != "")
    start = max(int(offset), 1)
    after = F.slice(items, start, F.greatest(F.size(items), F.lit(1)))
    good = F.filter(after, ok)
    take = max(int(limit) - max(int(offset), 1) + 1, 0)
    chosen = F.slice(good, 1, take) if take > 0 else F.array().cast("array<string>")
    return pages.select("page_id", F.posexplode(chosen).alias("rank", "link"))


def page_metadata(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Embedded ``imgpt`` metadata blocks, unescaped and parsed; unparsable blocks skipped."""
    blocks = pages.select("page_id", F.posexplode(F.regexp_extract_all(html_col, F.lit(IMGPT_PATTERN), 1)).alias("pos", "raw"))
    parsed = blocks.select("page_id", "pos", F.from_json(unescape(F.col("raw")), METADATA_SCHEMA).alias("m"))
    good = parsed.where(F.col("m").isNotNull() & F.col("m.murl").isNotNull())
    return good.select("page_id", "pos", *format_object(F.col("m")))


def format_object(m: Column) -> list[Column]:
    """Metadata fields: link without query (blanks as ``+``), format, description, host, source."""
    murl = without_query(m.getField("murl"))
    return [
        F.substring_index(murl, ".", -1).alias("image_format"),
        F.replace(murl, F.lit(" "), F.lit("+")).alias("image_link"),
        m.getField("desc").alias("image_description"),
        m.getField("purl").alias("image_host"),
        m.getField("purl").alias("image_source"),
    ]


def page_tabs(pages: DataFrame, base_url: str = "", html_col: str = "html") -> DataFrame:
    """Related tabs ``(page_id, pos, name, link)``, in page order, up to the first stop marker.

    A tab's link is its ``href`` (``&amp;`` undone, prefixed by ``base_url``); its name is
    the ``,g_1:`` part of the link with ``+`` as blanks. Reading stops at the first tab
    whose name is longer than 100 characters or is the stop word.
    """
    hrefs = F.transform(F.regexp_extract_all(html_col, F.lit(TAB_PATTERN), 1), lambda h: F.replace(h, F.lit("&amp;"), F.lit("&")))
    tabs = F.transform(hrefs, lambda h: F.struct(
        F.replace(F.regexp_extract(h, TAB_NAME_PATTERN, 1), F.lit("+"), F.lit(" ")).alias("name"),
        F.concat(F.lit(base_url), h).alias("link")))
    stop = F.array_position(F.transform(tabs, lambda t: (F.length(t["name"]) > TAB_NAME_LIMIT) | (t["name"] == TAB_STOP_NAME)), True)
    kept = F.when(stop > 0, F.slice(tabs, 1, stop - 1)).otherwise(tabs)
    # a later tab with the same name replaces the link of an earlier one, at the earlier one's place: in order
    # of (name, place) each name's first and last tab stand at the ends of its run
    ordered = F.array_sort(F.transform(kept, lambda t, i: F.struct(t["name"].alias("name"), i.alias("pos"), t["link"].alias("link"))))
    numbered = pages.select("page_id", ordered.alias("tabs")).where(F.size("tabs") > 0)

    def ends(step: int) -> Column:
        beyond = lambda i: F.get(F.col("tabs"), i + step)["name"]
        return F.filter("tabs", lambda t, i: ~F.coalesce(beyond(i) == t["name"], F.lit(False)))

    pairs = F.zip_with(ends(-1), ends(1), lambda a, b: F.struct(a["name"].alias("name"), a["pos"].alias("pos"), b["link"].alias("link")))
    return numbered.select("page_id", F.explode(pairs).alias("t")).select("page_id", "t.name", "t.pos", "t.link")


def url_parts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", referer(F.col("url")).alias("referer"),
                        F.try_parse_url(F.col("url"), F.lit("HOST")).alias("host"),
                        url_extension(F.col("url")).alias("extension"))


def search_terms(keywords: DataFrame, prefixes: list[str], suffixes: list[str], template_head: str, template_tail: str = "") -> DataFrame:
    """Every prefix x suffix around every keyword, with its search URL.

    The caller's word lists are expanded per keyword row with ``explode`` (no
    join): the work is linear in the keywords. A keyword's own blanks stay.
    """
    pre = F.explode(F.array(*[F.lit(p) for p in (prefixes or [""])]))
    suf = F.explode(F.array(*[F.lit(s) for s in (suffixes or [""])]))
    words = F.filter(F.array("prefix", "keyword", "suffix"), lambda w: w.isNotNull() & (w != ""))
    return (keywords.select("keyword", pre.alias("prefix")).select("keyword", "prefix", suf.alias("suffix"))
            .select("keyword", "prefix", "suffix", F.array_join(words, " ").alias("term"))
            .withColumn("search_url", search_url(F.col("term"), template_head, template_tail)))


def status_totals(results: DataFrame, key: str, ok: Column) -> DataFrame:
    """Successes and failures per key, plus an overall row (key null), via ``rollup``."""
    return (results.rollup(key)
            .agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"))
            .select(key, "n_ok", "n_failed"))
