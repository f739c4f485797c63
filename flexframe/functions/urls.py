"""URL expressions used by the page-extraction jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def host_of(url) -> Column:
    return F.try_parse_url(_col(url), F.lit("HOST"))


def referer(url) -> Column:
    """``scheme://host`` of a URL (null when it does not parse)."""
    u = _col(url)
    scheme = F.try_parse_url(u, F.lit("PROTOCOL"))
    host = F.try_parse_url(u, F.lit("HOST"))
    return F.when(scheme.isNotNull() & host.isNotNull(), F.concat(scheme, F.lit("://"), host))


def without_query(url) -> Column:
    """URL with everything from the first ``?`` removed."""
    return F.substring_index(_col(url), "?", 1)


def url_extension(url) -> Column:
    """Lower-cased text after the last dot of the query-less URL's last path segment."""
    last = F.substring_index(without_query(url), "/", -1)
    return F.when(F.instr(last, ".") > 0, F.lower(F.substring_index(last, ".", -1))).otherwise(F.lit(""))


def percent_encoded(text) -> Column:
    """Percent-encoded UTF-8; letters, digits and ``_.-~/`` stay as they are, blanks are ``%20``."""
    out = F.url_encode(_col(text))
    # the form encoding differs in these: fixed values
    for form, plain in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        out = F.replace(out, F.lit(form), F.lit(plain))
    return out


def search_url(term, template_head: str, template_tail: str = "") -> Column:
    """Search URL: percent-encoded term inside a fixed template."""
    return F.concat(F.lit(template_head), percent_encoded(term), F.lit(template_tail))
