"""HTML extraction from saved pages (S8, S9), as column expressions.

Pages are rows ``(page_id, url, html)``.  Everything here is regular-expression
and array functions evaluated inside the row -- no Python on the workers, no
shuffle: a page is processed by whichever task holds it.

* ``extract_links``: every ``<a href>`` of a page, resolved against its URL.
* ``extract_listing``: rows of a directory listing (the page's first table):
  link, absolute URL, the two right-aligned cells (time, size), without the
  "Parent Directory" and "Name" rows.
* ``extract_schema_tables``: data-dictionary pages: ``<h1>`` title, file
  names from ``<h3>`` headings (first ``(NAME.csv)`` each, headings without
  one dropped), tables whose header row has "Element Name" or "Element",
  names and tables paired by position (unpaired ones are marked), body cells
  normalised (strip, lower-case, one trailing footnote digit removed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (decode_entities, extract_csv_name, normalize_cell, page_url_parts,
                         resolve_with_parts, size_quality, size_to_mb, strip_text, tag_text)

# an attribute value: in double quotes, in single quotes or bare
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'=<>`]+)"""
HREF = rf"""(?is)<a\b[^>]*?(?<=[\s"'])href\s*=\s*{_VALUE}"""
ANCHOR = rf"""{HREF}[^>]*>(?:.*?</a>)?"""
FIRST_TABLE = r"(?is)<table\b[^>]*>(.*?)</table>"
TABLES = FIRST_TABLE
ROWS = r"(?is)<tr\b[^>]*>(.*?)</tr>"
RIGHT_CELLS = r"""(?is)<td\b[^>]*?\balign\s*=\s*["']?right["']?(?=[\s>/])[^>]*>(.*?)</td>"""
CELLS = r"(?is)<td\b[^>]*>(.*?)</td>"
HEAD_CELLS = r"(?is)<th\b[^>]*>(.*?)</th>"
THEAD = r"(?is)<thead\b[^>]*>(.*?)</thead>"
TBODY = r"(?is)<tbody\b[^>]*>(.*?)</tbody>"
H1 = r"(?is)<h1\b[^>]*>(.*?)</h1>"
H3 = r"(?is)<h3\b[^>]*>(.*?)</h3>"

# Header cells that mark a schema table; link texts of rows
# that are not files.
SCHEMA_TABLE_HEADERS = ("Element Name", "Element")
SKIP_LINK_TEXTS = ("Parent Directory", "Name")


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), 1)


def _unquoted(c: Column) -> Column:
    return F.when(c.startswith('"') | c.startswith("'"), F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c)


def _values(c: Column) -> Column:
    """``href`` values in order, whichever way they are quoted."""
    return F.transform(_all(c, HREF), _unquoted)


def _one(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(c, pattern, group)


def _text(c: Column) -> Column:
    return strip_text(tag_text(c))


def extract_links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """S8 (links): (page columns..., link_pos, href, link)."""
    keep = [c for c in pages.columns if c != html]
    # the page URL's pieces are computed once per page, below the explode
    per_page = pages.select(*keep, page_url_parts(url).alias("_u"),
                            _values(F.col(html)).alias("_hrefs"))
    return (per_page.select(*keep, "_u", F.posexplode("_hrefs").alias("link_pos", "_raw"))
            .withColumn("href", decode_entities("_raw"))
            .withColumn("link", resolve_with_parts("href", "_u")).drop("_raw", "_u"))


def extract_listing(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """S8 (listing rows): page columns, row_pos, href, link, name,
    last_modified, size, size_mb, is_dir."""
    keep = [c for c in pages.columns if c != html]
    # of each row, its first link with its text, and its right-aligned cells
    pieces = F.transform(_all(_one(F.col(html), FIRST_TABLE), ROWS),
                         lambda row: F.struct(_one(row, ANCHOR, 0).alias("a"), _all(row, RIGHT_CELLS).alias("right")))
    per_page = pages.select(*keep, page_url_parts(url).alias("_u"), pieces.alias("_rows"))
    r = per_page.select(*keep, "_u", F.posexplode("_rows").alias("row_pos", "_row")).where("_row.a <> ''")
    out = r.select(
        *keep, "_u", "row_pos",
        decode_entities(_unquoted(_one(F.col("_row.a"), HREF))).alias("href"),
        _text(F.col("_row.a")).alias("name"),
        _text(F.get("_row.right", 0)).alias("last_modified"),
        _text(F.get("_row.right", 1)).alias("size"))
    out = out.where(~F.col("name").isin(*SKIP_LINK_TEXTS))
    return (out.withColumn("link", resolve_with_parts("href", "_u")).drop("_u")
            .withColumn("size_mb", size_to_mb("size")).withColumn("size_quality", size_quality("size"))
            .withColumn("is_dir", F.col("href").endswith("/")))


def _is_schema_table(t: Column) -> Column:
    head_row = _one(_one(t, THEAD), ROWS)
    heads = F.transform(_all(head_row, HEAD_CELLS), _text)
    return F.exists(heads, lambda h: h.isin(*SCHEMA_TABLE_HEADERS))


def extract_schema_tables(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page columns..., title, table_pos, table_name, paired, row_pos, cells).

    Names and tables are paired by position.  What has no partner stays, with
    ``paired`` false: a name without table has one row with NULL row_pos and
    cells, a table without name has NULL table_name."""
    keep = [c for c in pages.columns if c != html]
    h = F.col(html)
    names = F.filter(F.transform(_all(h, H3), lambda x: extract_csv_name(tag_text(x))),
                     lambda x: x.isNotNull())
    tables = F.filter(_all(h, TABLES), _is_schema_table)
    pairs = F.zip_with(names, tables, lambda a, b: F.struct(a.alias("table_name"), b.alias("body")))
    t = pages.select(*keep, _text(_one(h, H1)).alias("title"),
                     F.posexplode(pairs).alias("table_pos", "_p"))
    rows = _all(_one(F.col("_p.body"), TBODY), ROWS)
    paired = F.col("_p.table_name").isNotNull() & F.col("_p.body").isNotNull()
    # only a name without table keeps a row of its own
    some = F.when(F.col("_p.body").isNull(), F.array(F.lit(None).cast("string"))).otherwise(rows)
    r = t.select(*keep, "title", "table_pos", F.col("_p.table_name").alias("table_name"), paired.alias("paired"),
                 F.posexplode(some).alias("row_pos", "_row"))
    cells = F.transform(_all(F.col("_row"), CELLS), lambda c: normalize_cell(tag_text(c)))
    return r.select(*keep, "title", "table_pos", "table_name", "paired",
                    F.when(F.col("_row").isNotNull(), F.col("row_pos")).alias("row_pos"), cells.alias("cells"))
