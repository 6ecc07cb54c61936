"""Registered queries for the landing side.

``pages`` is used as it is for links and URL base names.  Manifest snapshots and
the tracker list are cut from ``orders`` by order status, so every order is
processed.  Directory listings
and data-dictionary pages are composed in Spark from ``orders`` and ``part``
rows (256 orders per listing page, 40 parts per dictionary page: page sizes do
not grow with the data); the oracles compute the expected rows straight from
those tables, so they check the extraction, not the composition.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import change as C
from ..session import scratch_path
from ..sources import html as H
from . import adapters as A
from .catalog import ORACLE, register

# -------------------------------------------------------------- links, URLs

# Page URLs are scheme://host/path; the oracles cut them and the page text with
# string functions, not with the engine's patterns.
_HOST = "array_to_string(string_split(split_part(split_part(url, '#', 1), '?', 1), '/')[1:3], '/')"
_STEPS = "string_split(split_part(split_part(url, '#', 1), '?', 1), '/')[4:]"


@register("extract_links",
          f"SELECT page_id, url, link_pos, href, {_HOST} || href AS link FROM ("
          "SELECT page_id, url, CAST(unnest(range(len(l))) AS INTEGER) AS link_pos, unnest(l) AS href FROM ("
          "SELECT page_id, url, list_transform(string_split(html, '<a href=\"')[2:], lambda x: split_part(x, '\"', 1)) AS l FROM pages))")
def _links(spark, sf_dir):
    return H.extract_links(A.read(spark, sf_dir, "pages"))


# href and, in SQL, its target; dirs: the page's folder steps
_HREFS = {
    "x.html": "base || array_to_string(list_append(dirs, 'x.html'), '/')",
    "./y": "base || array_to_string(list_append(dirs, 'y'), '/')",
    "../c.zip": "base || array_to_string(list_append(dirs[1:len(dirs) - 1], 'c.zip'), '/')",
    "d/../e/": "base || array_to_string(list_append(dirs, 'e/'), '/')",
    "..": "base || CASE WHEN len(dirs) > 1 THEN array_to_string(dirs[1:len(dirs) - 1], '/') || '/' ELSE '' END",
    "/r//s/./t": "base || 'r//s/t'",
    "//o.example.org/p": "split_part(url, ':', 1) || '://o.example.org/p'",
    "ftp://z/y/../w": "'ftp://z/y/../w'",
    "?q=1": "split_part(split_part(url, '#', 1), '?', 1) || '?q=1'",
    "#f": "split_part(url, '#', 1) || '#f'",
    "": "url",
    "  blank.html": "base || array_to_string(list_append(dirs, 'blank.html'), '/')",
}
_LIST = ", ".join(f"('{h}')" for h in _HREFS)
_TARGET = " ".join(f"WHEN '{h}' THEN {t}" for h, t in _HREFS.items())


@register("resolve_link",
          f"SELECT page_id, href, CASE href {_TARGET} END AS link FROM (SELECT page_id, url, {_HOST} || '/' AS base, "
          f"{_STEPS}[1:len({_STEPS}) - 1] AS dirs FROM pages), (VALUES {_LIST}) h(href)")
def _resolve(spark, sf_dir):
    hrefs = F.array(*[F.lit(h) for h in _HREFS])
    pages = A.read(spark, sf_dir, "pages").select("page_id", "url", F.explode(hrefs).alias("href"))
    return pages.select("page_id", "href", X.resolve_link("href", "url").alias("link"))


_PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


_SCHEMES = ", ".join(f"'{x}'" for x in X.PARAM_SCHEMES)


@register("url_basename",
          f"SELECT page_id, url, CASE WHEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) IN ({_SCHEMES}) "
          f"THEN regexp_extract(string_split({_PATH}, '/')[-1], '^([^;]*)', 1) "
          f"ELSE string_split({_PATH}, '/')[-1] END AS base_name FROM pages")
def _basename(spark, sf_dir):
    return A.read(spark, sf_dir, "pages").select("page_id", "url", X.url_basename("url").alias("base_name"))


# ------------------------------------------------------------- listings

LISTING_PAGE = 256
_SIZE = ("CASE o_orderkey % 6 WHEN 0 THEN '-' "
         "WHEN 1 THEN CAST(o_orderkey % 997 AS STRING) || 'K' "
         "WHEN 2 THEN CAST(o_orderkey % 997 AS STRING) || '.' || CAST(o_orderkey % 10 AS STRING) || 'M' "
         "WHEN 3 THEN CAST(o_orderkey % 13 AS STRING) || '.' || CAST(o_orderkey % 7 AS STRING) || 'G' "
         "WHEN 4 THEN CAST(o_orderkey % 997 AS STRING) || '.' || CAST(o_orderkey % 4 AS STRING) || 'k' "
         "ELSE CAST(o_orderkey % 997 AS STRING) END")


def listing_pages(spark, sf_dir):
    """Apache-style directory listings, one page per 256 order keys."""
    o = A.read(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / LISTING_PAGE).alias("page_id"), "o_orderkey",
        F.expr(f"'ord_' || CAST(o_orderkey AS STRING) || '.zip'").alias("fname"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("ts"), F.expr(_SIZE).alias("size"))
    # attribute values in double quotes, in single quotes and bare
    q = F.element_at(F.array(F.lit('"'), F.lit("'"), F.lit("")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    row = F.concat(F.lit('<tr><td valign="top"><a class=f href='), q, F.col("fname"), q, F.lit(">"), F.col("fname"),
                   F.lit("</a></td><td align="), q, F.lit("right"), q, F.lit(">"), F.col("ts"),
                   F.lit("  </td><td align="), q, F.lit("right"), q, F.lit(">"), F.col("size"), F.lit("</td></tr>\n"))
    pages = o.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", row.alias("r")))).alias("rs"))
    url = F.concat(F.lit("https://data.example.org/files/g"), F.col("page_id").cast("string"), F.lit("/"))
    html = F.concat(
        F.lit("<html><head><title>Index</title></head><body><h1>Index</h1><table>\n"
              '<tr><th><a href="?C=N;O=D">Name</a></th><th><a href="?C=M;O=A">Last modified</a></th>'
              "<th>Size</th></tr>\n"
              '<tr><td><a href="/files/">Parent Directory</a></td><td>&nbsp;</td>'
              '<td align="right">  - </td></tr>\n'),
        F.array_join(F.transform("rs", lambda x: x["r"]), ""),
        F.lit("</table></body></html>"))
    return pages.select("page_id", url.alias("url"), html.alias("html"))


def _mb(expr_num, factor):
    return f"printf('%.2f', TRY_CAST({expr_num} AS DOUBLE) * {factor} / 1048576)"


_SIZE_MB_SQL = ("CASE WHEN s = '-' THEN s WHEN regexp_matches(right(s, 1), '^[0-9]$') THEN s "
                f"WHEN upper(right(s, 1)) = 'K' THEN {_mb('left(s, length(s) - 1)', 1024)} "
                f"WHEN upper(right(s, 1)) = 'M' THEN {_mb('left(s, length(s) - 1)', 1048576)} "
                f"WHEN upper(right(s, 1)) = 'G' THEN {_mb('left(s, length(s) - 1)', 1073741824)} END")


_QUALITY_SQL = ("CASE WHEN s = '-' THEN 'none' WHEN regexp_matches(right(s, 1), '^[0-9]$') THEN 'bytes' "
                "WHEN upper(right(s, 1)) IN ('K', 'M', 'G') THEN 'converted' ELSE 'unknown' END")


@register("extract_listing",
          "SELECT page_id, 'https://data.example.org/files/g' || CAST(page_id AS VARCHAR) || '/' AS url, "
          "CAST(row_number() OVER (PARTITION BY page_id ORDER BY o_orderkey) + 1 AS INTEGER) AS row_pos, "
          "fname AS href, 'https://data.example.org/files/g' || CAST(page_id AS VARCHAR) || '/' || fname AS link, "
          "fname AS name, ts AS last_modified, s AS size, "
          f"{_SIZE_MB_SQL} AS size_mb, {_QUALITY_SQL} AS size_quality, false AS is_dir "
          f"FROM (SELECT CAST(floor(o_orderkey / {LISTING_PAGE}) AS BIGINT) AS page_id, o_orderkey, "
          "'ord_' || CAST(o_orderkey AS VARCHAR) || '.zip' AS fname, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS ts, "
          f"{_SIZE} AS s FROM orders)")
def _listing(spark, sf_dir):
    return H.extract_listing(listing_pages(spark, sf_dir))


@register("size_to_mb", f"SELECT l_orderkey, l_linenumber, s AS size, {_SIZE_MB_SQL} AS size_mb FROM ("
          "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 7 "
          "WHEN 1 THEN CAST(l_quantity AS STRING) || 'K' WHEN 2 THEN CAST(l_extendedprice AS STRING) || 'M' "
          "WHEN 3 THEN CAST(l_discount AS STRING) || 'G' WHEN 4 THEN '-' WHEN 5 THEN CAST(l_linenumber AS STRING) "
          "WHEN 6 THEN CAST(l_tax AS STRING) || 'k' ELSE CAST(l_extendedprice AS STRING) || 'K' END AS s FROM lineitem)")
def _size(spark, sf_dir):
    s = F.expr("CASE l_linenumber % 7 "
               "WHEN 1 THEN CAST(l_quantity AS STRING) || 'K' WHEN 2 THEN CAST(l_extendedprice AS STRING) || 'M' "
               "WHEN 3 THEN CAST(l_discount AS STRING) || 'G' WHEN 4 THEN '-' WHEN 5 THEN CAST(l_linenumber AS STRING) "
               "WHEN 6 THEN CAST(l_tax AS STRING) || 'k' ELSE CAST(l_extendedprice AS STRING) || 'K' END")
    li = A.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", s.alias("size"))
    return li.withColumn("size_mb", X.size_to_mb("size"))


_LISTED = "CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END"


@register("parse_listing_ts",
          "SELECT o_orderkey, listed, CAST(year(t) AS INTEGER) AS yr, CAST(month(t) AS INTEGER) AS mo, "
          "CAST(day(t) AS INTEGER) AS dy, CAST(hour(t) AS INTEGER) AS hh, CAST(minute(t) AS INTEGER) AS mi "
          f"FROM (SELECT o_orderkey, listed, try_strptime(listed, '%Y-%m-%d %H:%M') AS t FROM "
          f"(SELECT o_orderkey, {_LISTED} AS listed FROM orders))")
def _parse_ts(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, F.lit("n/a"))
        .otherwise(X.format_listing_ts("o_orderdate")).alias("listed"))
    t = X.parse_listing_ts("listed")
    return o.select("o_orderkey", "listed", F.year(t).alias("yr"), F.month(t).alias("mo"),
                    F.dayofmonth(t).alias("dy"), F.hour(t).alias("hh"), F.minute(t).alias("mi"))


# -------------------------------------------------------- dictionary pages

DICT_PAGE = 40
_TYPE_CELL = ("CASE p_size % 4 WHEN 0 THEN 'NUMBER' WHEN 1 THEN 'VARCHAR2' "
              "WHEN 2 THEN 'Char' || CAST(p_size % 10 AS STRING) ELSE 'DATE' END")
_NAME_CELL = "upper(replace(p_name, ' ', '_'))"


def dictionary_pages(spark, sf_dir):
    p = A.read(spark, sf_dir, "part").select(
        F.floor(F.col("p_partkey") / DICT_PAGE).alias("page_id"), "p_partkey",
        F.expr(_NAME_CELL).alias("n"), F.expr(_TYPE_CELL).alias("t"),
        F.col("p_size").cast("string").alias("z"), F.col("p_brand").alias("b"))
    r1 = F.concat(F.lit("<tr><td> "), F.col("n"), F.lit(" </td><td>"), F.col("t"), F.lit("</td><td>"),
                  F.col("z"), F.lit("</td></tr>"))
    r2 = F.concat(F.lit("<tr><td>X_"), F.col("p_partkey").cast("string"), F.lit("</td><td>Code &amp; "),
                  F.col("b"), F.lit("</td></tr>"))
    g = p.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("p_partkey", r1.alias("a"), r2.alias("b")))).alias("rs"))
    pid = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<html><body><h1>Data Dictionary "), pid, F.lit("</h1>"),
        F.lit("<h3>Overview</h3><table><tr><td>not a schema</td></tr></table>"),
        F.lit("<h3>Parts Table (PARTS_"), pid, F.lit(".csv)</h3>"),
        F.lit("<table><thead><tr><th>Element Name</th><th>Data Type</th><th>Length</th></tr></thead><tbody>"),
        F.array_join(F.transform("rs", lambda x: x["a"]), ""),
        F.lit("</tbody></table>"),
        F.lit("<h3>Codes (CODES_"), pid, F.lit(".csv) see also (OTHER.csv)</h3>"),
        F.lit("<table><thead><tr><th>Element</th><th>Description</th></tr></thead><tbody>"),
        F.array_join(F.transform("rs", lambda x: x["b"]), ""),
        F.lit("</tbody></table>"),
        F.lit("<h3>Notes (NOTES_"), pid, F.lit(".csv)</h3>"),
        F.lit("<table><thead><tr><th>Note</th></tr></thead><tbody><tr><td>x</td></tr></tbody></table>"),
        F.lit("</body></html>"))
    return g.select("page_id", html.alias("html"))


_NORM = "regexp_replace(lower(trim({0})), '[0-9]$', '')"


@register("extract_schema_tables",
          "SELECT page_id, 'Data Dictionary ' || CAST(page_id AS VARCHAR) AS title, table_pos, table_name, paired, row_pos, "
          "n_cells, cell_0, cell_1, cell_2 FROM ("
          # the heading of notes has no table of its own
          "SELECT page_id, 2 AS table_pos, 'NOTES_' || CAST(page_id AS VARCHAR) || '.csv' AS table_name, false AS paired, "
          "CAST(NULL AS INTEGER) AS row_pos, CAST(NULL AS INTEGER) AS n_cells, NULL AS cell_0, NULL AS cell_1, NULL AS cell_2 "
          f"FROM (SELECT DISTINCT CAST(floor(p_partkey / {DICT_PAGE}) AS BIGINT) AS page_id FROM part) UNION ALL "
          "SELECT page_id, 0 AS table_pos, 'PARTS_' || CAST(page_id AS VARCHAR) || '.csv' AS table_name, true AS paired, "
          "CAST(row_number() OVER (PARTITION BY page_id ORDER BY p_partkey) - 1 AS INTEGER) AS row_pos, 3 AS n_cells, "
          f"{_NORM.format(_NAME_CELL)} AS cell_0, {_NORM.format(_TYPE_CELL)} AS cell_1, "
          f"{_NORM.format('CAST(p_size AS VARCHAR)')} AS cell_2 FROM (SELECT *, CAST(floor(p_partkey / {DICT_PAGE}) AS BIGINT) AS page_id FROM part) "
          "UNION ALL "
          "SELECT page_id, 1, 'CODES_' || CAST(page_id AS VARCHAR) || '.csv', true, "
          "CAST(row_number() OVER (PARTITION BY page_id ORDER BY p_partkey) - 1 AS INTEGER), 2, "
          f"{_NORM.format(chr(39) + 'X_' + chr(39) + ' || CAST(p_partkey AS VARCHAR)')}, "
          f"{_NORM.format(chr(39) + 'Code & ' + chr(39) + ' || p_brand')}, NULL "
          f"FROM (SELECT *, CAST(floor(p_partkey / {DICT_PAGE}) AS BIGINT) AS page_id FROM part))")
def _schema_tables(spark, sf_dir):
    t = H.extract_schema_tables(dictionary_pages(spark, sf_dir))
    return t.select("page_id", "title", "table_pos", "table_name", "paired", "row_pos",
                    F.when(F.col("cells").isNotNull(), F.size("cells")).alias("n_cells"), F.get("cells", 0).alias("cell_0"),
                    F.get("cells", 1).alias("cell_1"), F.get("cells", 2).alias("cell_2"))


_HEADING = ("'Table ' || p_name || CASE WHEN p_size % 3 = 0 THEN '' "
            "ELSE ' (' || upper(replace(p_type, ' ', '_')) || '_' || CAST(p_partkey AS STRING) || '.csv)' END "
            "|| CASE WHEN p_size % 5 = 0 THEN '' ELSE ' and (EXTRA.csv)' END")


@register("extract_csv_name",
          f"SELECT p_partkey, NULLIF(regexp_extract({_HEADING}, '\\(([^)]+\\.csv)\\)', 1), '') AS csv_name FROM part")
def _csv_name(spark, sf_dir):
    return A.read(spark, sf_dir, "part").select("p_partkey", X.extract_csv_name(F.expr(_HEADING)).alias("csv_name"))


_CELL = "'  ' || upper(p_type) || CAST(p_size % 10 AS STRING) || ' '"


@register("cell_normalize", f"SELECT p_partkey, {_NORM.format(_CELL)} AS cell FROM part")
def _cell(spark, sf_dir):
    return A.read(spark, sf_dir, "part").select("p_partkey", X.normalize_cell(F.expr(_CELL)).alias("cell"))


# ------------------------------------------------------- change detection

_URL = "'https://data.example.org/f/' || CAST(o_orderkey AS STRING) || '.zip'"
_OLD_TS = "strftime(o_orderdate, '%Y-%m-%d %H:%M')"
_NEW_TS = (f"CASE WHEN o_orderkey % 7 = 0 THEN 'garbled' WHEN o_orderkey % 2 = 0 THEN {_OLD_TS} "
           f"ELSE substr({_OLD_TS}, 1, 10) || ' 12:30' END")


def _snapshots(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    old_ts = X.format_listing_ts("o_orderdate")
    new_ts = (F.when(F.col("o_orderkey") % 7 == 0, F.lit("garbled"))
              .when(F.col("o_orderkey") % 2 == 0, old_ts)
              .otherwise(F.concat(F.substring(old_ts, 1, 10), F.lit(" 12:30"))))
    url = F.expr(_URL)
    manifest = o.where(F.col("o_orderstatus") != "P").select(
        url.alias("url"), url.alias("link"), old_ts.alias("last_modified"),
        F.format_string("%d.00", F.col("o_orderkey") % 50).alias("size_mb"),
        F.concat(F.lit("data/f/"), F.col("o_orderkey").cast("string"), F.lit(".zip")).alias("file_location"))
    listing = o.where(F.col("o_orderstatus") != "O").select(
        url.alias("url"), url.alias("link"), new_ts.alias("last_modified"),
        F.format_string("%d.00", F.col("o_orderkey") % 60).alias("size_mb"))
    return manifest, listing


_MANIFEST_SQL = (f"SELECT {_URL} AS url, {_URL} AS link, {_OLD_TS} AS last_modified, "
                 "CAST(o_orderkey % 50 AS VARCHAR) || '.00' AS size_mb, "
                 "'data/f/' || CAST(o_orderkey AS VARCHAR) || '.zip' AS file_location FROM orders WHERE o_orderstatus <> 'P'")
_LISTING_SQL = (f"SELECT {_URL} AS url, {_URL} AS link, {_NEW_TS} AS last_modified, "
                "CAST(o_orderkey % 60 AS VARCHAR) || '.00' AS size_mb FROM orders WHERE o_orderstatus <> 'O'")


@register("manifest_diff",
          "SELECT *, status IN ('new', 'updated') AS to_fetch FROM ("
          "SELECT l.url, l.link, l.last_modified, l.size_mb, m.last_modified AS stored_last_modified, "
          "CASE WHEN m.last_modified IS NULL OR try_strptime(m.last_modified, '%Y-%m-%d %H:%M') IS NULL THEN 'new' "
          "WHEN try_strptime(l.last_modified, '%Y-%m-%d %H:%M') IS NULL THEN 'unknown' "
          "WHEN try_strptime(l.last_modified, '%Y-%m-%d %H:%M') > try_strptime(m.last_modified, '%Y-%m-%d %H:%M') THEN 'updated' "
          "ELSE 'unchanged' END AS status "
          f"FROM ({_LISTING_SQL}) l LEFT JOIN ({_MANIFEST_SQL}) m USING (url))")
def _diff(spark, sf_dir):
    manifest, listing = _snapshots(spark, sf_dir)
    return C.manifest_diff(listing, manifest)


@register("manifest_upsert",
          "SELECT url, CASE WHEN u.url IS NOT NULL THEN u.link ELSE m.link END AS link, "
          "CASE WHEN u.url IS NULL THEN m.last_modified WHEN u.last_modified = 'garbled' THEN '1990-01-01 00:00' "
          "ELSE u.last_modified END AS last_modified, "
          "CASE WHEN u.url IS NOT NULL THEN u.size_mb ELSE m.size_mb END AS size_mb, m.file_location "
          f"FROM ({_MANIFEST_SQL}) m FULL OUTER JOIN ({_LISTING_SQL}) u USING (url)")
def _upsert(spark, sf_dir):
    return C.manifest_upsert(*_with_older(spark, sf_dir))


def _with_older(spark, sf_dir):
    """Manifest and listing, every third key twice on either side, first with an older
    time: the last wins."""
    manifest, listing = _snapshots(spark, sf_dir)
    older = lambda df: df.where(F.substring("url", -5, 1).isin("1", "4", "7")).withColumn(
        "last_modified", F.lit("1980-01-01 00:00")).withColumn("size_mb", F.lit("0.01"))
    listing = listing.withColumn("last_modified", F.when(F.col("last_modified") != "garbled", F.col("last_modified")).otherwise("1990-01-01 00:00"))
    return older(manifest).unionByName(manifest), listing.unionByName(older(listing))


@register("manifest_bucket_upsert", ORACLE["manifest_upsert"])
def _bucket_upsert(spark, sf_dir):
    """K9/H2 on a stored manifest: the listing's upsert, then one of a single key, which
    rewrites that key's bucket only."""
    manifest, listing = _with_older(spark, sf_dir)
    table = C.ManifestTable(spark, scratch_path(spark, "manifest"), buckets=32)
    table.upsert(manifest)
    table.upsert(listing)
    before = table.table.state()["parts"]
    one = C.last_per_key(listing, "url").orderBy("url").limit(1)
    touched = table.upsert(one)
    after = table.table.state()["parts"]
    assert len(touched) == 1 and {p for p in after if after[p] != before[p]} == set(touched), (touched, before, after)
    return table.read()


@register("tracker_status",
          "SELECT 'https://data.example.org/dl/ord_' || CAST(o_orderkey AS VARCHAR) || '.zip?v=1' AS download_link, "
          "'ord_' || CAST(o_orderkey AS VARCHAR) || '.zip' AS remote_name, "
          "CASE WHEN o_orderstatus = 'F' THEN 'present' ELSE 'missing' END AS status FROM orders")
def _tracker(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    tracker = o.select(F.concat(
        F.lit("https://data.example.org/dl/ord_"), F.col("o_orderkey").cast("string"),
        F.lit(".zip?v=1")).alias("download_link"))
    archive = o.where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("ord_"), F.col("o_orderkey").cast("string"), F.lit(".zip")).alias("file_name"))
    return C.tracker_status(tracker, archive).select("download_link", "remote_name", "status")
