"""Records from saved pages: registry tables and article heads."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.functions.text import host, registered_domain, squeezed

# Field → (table, cell), both counted from 0, in a saved registry page.
REGISTRY_CELLS = {
    "serial_number": (4, 1),
    "manufacturer": (4, 5),
    "model": (4, 9),
    "mfr_year": (4, 25),
    "owner": (5, 1),
    "owner_state": (5, 9),
    "engine_manufacturer": (6, 1),
    "engine_model": (6, 5),
}
_TABLES = r"(?is)<table\b[^>]*>(.*?)</table>"
_CELLS = r"(?is)<td\b[^>]*>(.*?)</td>"
_TAGS = r"(?s)<[^>]*>"


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags removed, white space squeezed."""
    return squeezed(F.regexp_replace(html, _TAGS, " "))


def table_records(
    pages: DataFrame, key: str, html: str = "html",
    cells: Mapping[str, tuple[int, int]] = REGISTRY_CELLS, keep_incomplete: bool = False,
) -> DataFrame:
    """One record per page from table cells picked by position.

    A page that lacks a cell gives no record; ``keep_incomplete`` keeps it with NULLs and a
    ``complete`` flag, which serves to count such pages.
    """
    tables = pages.select(key, F.regexp_extract_all(html, F.lit(_TABLES), 1).alias("_tables"))
    needed = sorted({t for t, _ in cells.values()})
    split = tables.select(key, *[
        F.regexp_extract_all(F.get("_tables", F.lit(t)), F.lit(_CELLS), 1).alias(f"_t{t}") for t in needed
    ])
    # Told by the number of cells: a filter on the records would work out every one of them twice.
    complete = reduce(lambda a, b: a & b, [
        F.coalesce(F.size(f"_t{t}") > max(c for s, c in cells.values() if s == t), F.lit(False)) for t in needed
    ])
    records = [plain_text(F.get(f"_t{t}", F.lit(c))).alias(name) for name, (t, c) in cells.items()]
    if keep_incomplete:
        return split.select(key, *records, complete.alias("complete"))
    return split.where(complete).select(key, *records)


def head_records(pages: DataFrame, key: str, url: str = "url", html: str = "html") -> DataFrame:
    """Title, first link, first paragraph and registered domain of each saved page."""

    def first(pattern: str) -> Column:
        return F.regexp_extract(html, pattern, 1)

    return pages.select(
        key,
        plain_text(first(r"(?is)<title[^>]*>(.*?)</title>")).alias("title"),
        first(r'(?is)<a\s[^>]*href="([^"]*)"').alias("first_link"),
        plain_text(first(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>")).alias("summary"),
        registered_domain(F.col(url)).alias("domain"),
    )


def domains(pages: DataFrame, key: str, url: str = "url") -> DataFrame:
    return pages.select(key, host(F.col(url)).alias("host"), registered_domain(F.col(url)).alias("domain"))
