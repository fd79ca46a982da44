"""Text helpers: trimming, tokens, prefixes, addresses, web addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"

# Public suffixes of two labels, under which a name is registered one label lower.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za",
    "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "com.tw",
    "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
)


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def squeezed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(text, r"\s+", " "))


def tokens(text: Column) -> Column:
    """Lower-case word tokens, empty ones left out."""
    return F.array_remove(F.split(F.lower(text), r"\W+"), "")


def address(*parts: tuple[Column, bool]) -> Column:
    """Parts joined by ", "; a missing optional part is empty, a missing required one gives NULL."""
    shown = [F.coalesce(c, F.lit("")) if optional else c for c, optional in parts]
    pieces = [shown[0]]
    for part in shown[1:]:
        pieces += [F.lit(", "), part]
    return F.concat(*pieces)


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def registered_domain(url: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """Last two labels of the host, or three below a public suffix of two labels."""
    name = host(url)
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(two)
