"""Scalar and generator functions (all JVM-side Column expressions).

Each returns a ``Column`` so it stays inside whole-stage codegen; none of them
calls Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- ids (F1)

def split_ids(c: ColumnOrName, sep: str = " ") -> Column:
    """Split a multi-valued field on a literal separator.

    ``"a  b"`` gives ``["a", "", "b"]`` and ``""`` gives ``[""]``, like the
    Spark SQL ``split`` the lists were always split with; NULL stays NULL.
    """
    return F.split(_c(c), re.escape(sep), -1)


def explode_ids(c: ColumnOrName, sep: str = " ", drop_empty: bool = False) -> Column:
    """Generator: one output row per id (F1).  NULL lists give no row."""
    arr = split_ids(c, sep)
    if drop_empty:
        arr = F.filter(arr, lambda x: x != F.lit(""))
    return F.explode(arr)


# ------------------------------------------------------- names

def upper_name(c: ColumnOrName) -> Column:
    return F.upper(_c(c))


def clean_identifier(c: ColumnOrName) -> Column:
    """``-`` becomes ``_`` so a table name is a valid SQL identifier."""
    return F.translate(_c(c), "-", "_")


def clean_identifier_py(name: str) -> str:
    return name.replace("-", "_")


def file_stem(c: ColumnOrName) -> Column:
    """Text before the first ``.`` of a file name."""
    return F.substring_index(_c(c), ".", 1)


def file_stem_py(name: str) -> str:
    return name.split(".")[0]


def path_basename(c: ColumnOrName) -> Column:
    """Last ``/``-separated piece of a path."""
    return F.element_at(F.split(_c(c), "/", -1), -1)


# ------------------------------------------------ data-dictionary cells

# Characters Python's ``str.isdigit`` accepts besides decimal
# digits (superscripts, subscripts, circled digits), used to recognise a
# trailing footnote mark on a dictionary cell.
_EXTRA_DIGITS = ("²³¹⁰⁴-⁹₀-₉①-⑨"
                 "⑴-⑼⒈-⒐⓵-⓽❶-❾➀-➈"
                 "➊-➒")
_TRAILING_DIGIT = "[\\p{Nd}" + _EXTRA_DIGITS + "]$"
# Unicode-aware white space at either end (Python's str.strip()).
_EDGE_SPACE = "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$"


def strip_text(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), _EDGE_SPACE, "")


def normalize_cell(c: ColumnOrName) -> Column:
    """strip + lower-case, then drop one trailing digit (a footnote mark)."""
    low = F.lower(strip_text(c))
    return F.regexp_replace(low, _TRAILING_DIGIT, "")


def extract_csv_name(c: ColumnOrName) -> Column:
    """First ``(NAME.csv)`` in a heading; NULL when there is none."""
    return F.nullif(F.regexp_extract(_c(c), r"\(([^)]+\.csv)\)", 1), F.lit(""))


# ------------------------------------------------------------ listing

# Megabytes in one of each unit.
SIZE_UNITS_MB = {"K": 1 / 1024, "M": 1.0, "G": 1024.0}


def size_to_mb(c: ColumnOrName) -> Column:
    """Human file size -> megabytes as text with two decimals.

    ``-`` and values whose last character is a digit come back unchanged;
    K, M, G (any case) are powers of 1024.  An unknown unit or a number that
    does not parse gives NULL instead of an error.  Rounding is half-even on
    the exact binary value, which is what ``'%.2f' %`` does in Python.
    """
    s = _c(c)
    unit = F.upper(F.substring(s, -1, 1))
    body = F.substring(s, F.lit(1), F.length(s) - 1)
    per_mb = F.create_map(*[F.lit(x) for pair in SIZE_UNITS_MB.items() for x in pair])
    mb = body.try_cast("double") * F.try_element_at(per_mb, unit)      # powers of two: exact
    return (F.when(s == "-", s)
            .when(unit.rlike("^[0-9]$"), s)
            .otherwise(F.call_function("format_number", mb, F.lit("0.00"))))


def size_quality(c: ColumnOrName) -> Column:
    """How ``size_to_mb`` came by its value: ``converted``; ``bytes`` (no unit,
    returned as it is); ``none`` (``-``, empty or missing); ``unknown`` (NULL
    because of the unit or the number)."""
    s = _c(c)
    return (F.when(F.coalesce(s, F.lit("")).isin("", "-"), "none")
            .when(F.substring(s, -1, 1).rlike("^[0-9]$"), "bytes")
            .when(size_to_mb(s).isNotNull(), "converted").otherwise("unknown"))


LISTING_TS_FORMAT = "yyyy-MM-dd HH:mm"


def parse_listing_ts(c: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm`` text -> timestamp; NULL when it does not parse."""
    return F.try_to_timestamp(_c(c), F.lit(LISTING_TS_FORMAT))


def format_listing_ts(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), LISTING_TS_FORMAT)


# ---------------------------------------------------------------- URLs

# scheme ':' ; '//' authority ; path ; (';' params) ; '?' query ; '#' fragment
_URL_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_path(c: ColumnOrName) -> Column:
    """Path part of a URL, parsed the way ``urllib.parse.urlsplit`` does."""
    return F.regexp_extract(_c(c), _URL_PATH, 1)


# URL schemes whose last path segment may carry ";params"
# (the empty scheme included), as urllib.parse treats them.
PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
                 "rtspu", "sip", "sips", "mms", "sftp", "tel")


def url_basename(c: ColumnOrName) -> Column:
    """Base name of a URL path: last segment, without ``;params`` for the
    schemes that have them (F8)."""
    last = path_basename(url_path(c))
    scheme = F.lower(F.regexp_extract(_c(c), r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    return F.when(scheme.isin(*PARAM_SCHEMES), F.regexp_extract(last, r"^([^;]*)", 1)).otherwise(last)


# URL schemes whose links resolve against a page URL.
RELATIVE_SCHEMES = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
                    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")


def _clean_url(c: Column) -> Column:
    """Leading control characters and blanks, and all tabs and line breaks, go."""
    return F.regexp_replace(F.regexp_replace(c, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def url_parts(c: ColumnOrName) -> Column:
    """A URL as struct (scheme, has_authority, authority, path, query, fragment);
    the scheme is lower-case, absent parts are empty."""
    u = _clean_url(_c(c))
    scheme = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    rest = F.when(scheme == "", u).otherwise(F.substring(u, F.length(scheme) + 2, F.length(u)))
    body = F.regexp_extract(rest, r"(?s)^([^#]*)", 1)
    before = F.regexp_extract(body, r"(?s)^([^?]*)", 1)
    return F.struct(
        F.lower(scheme).alias("scheme"),
        before.startswith("//").alias("has_authority"),
        F.regexp_extract(before, r"(?s)^//([^/]*)", 1).alias("authority"),
        F.regexp_replace(before, r"(?s)^//[^/]*", "").alias("path"),
        F.regexp_extract(body, r"(?s)^[^?]*\?(.*)", 1).alias("query"),
        F.regexp_extract(rest, r"(?s)^[^#]*#(.*)", 1).alias("fragment"))


def _walk(start: Column, steps: Column, relative: Column) -> Column:
    """Path steps taken one after the other from ``start``: struct (out, open), where
    ``open`` says that the path ends in a folder.  ``.`` stays, ``..`` goes up, an
    empty step of a relative path stays too."""
    def step(acc: Column, x: Column) -> Column:
        out = acc["out"]
        return (F.when(x == "..", F.struct(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))).alias("out"), F.lit(True).alias("open")))
                .when((x == ".") | ((x == "") & relative), F.struct(out.alias("out"), F.lit(True).alias("open")))
                .otherwise(F.struct(F.concat(out, F.array(x)).alias("out"), F.lit(False).alias("open"))))
    return F.aggregate(steps, F.struct(start.alias("out"), F.lit(False).alias("open")), step)


def page_url_parts(page_url: ColumnOrName) -> Column:
    """What link resolution needs of a page's URL, as one struct: compute it once per
    page, before exploding the page's links.  Besides the URL's pieces: ``origin`` (up
    to the path), ``folder`` (the page's folder as path steps, dots taken), ``prefix``
    (origin and folder as text), and ``joins``, whether links resolve against it."""
    p = F.struct(url_parts(page_url).alias("p"), _c(page_url).alias("url"))

    def pieces(x: Column) -> Column:
        u = x["p"]
        joins = u["scheme"].isin(*RELATIVE_SCHEMES) & (x["url"] != "")
        steps = F.split(u["path"], "/", -1)
        # the first step stays as it is: empty below a root
        first = F.slice(steps, 1, F.when(F.size(steps) > 1, F.lit(1)).otherwise(F.lit(0)))
        # a last step that names a document is no part of the folder
        folder = _walk(first, F.slice(steps, F.lit(2), F.greatest(F.size(steps) - 2, F.lit(0))), F.lit(True))["out"]
        folder = F.when(u["path"] == "", F.array(F.lit(""))).otherwise(folder)
        origin = F.concat(F.when(u["scheme"] != "", F.concat(u["scheme"], F.lit(":"))).otherwise(F.lit("")),
                          F.when((u["authority"] != "") | (u["scheme"] != ""), F.concat(F.lit("//"), u["authority"])).otherwise(F.lit("")))
        # with an authority and a folder below the root, a plain link only needs to be appended
        plain = joins & (u["authority"] != "") & (F.size(folder) > 0) & (F.get(folder, F.lit(0)) == "")
        prefix = F.when(plain, F.concat(origin, F.array_join(folder, "/"), F.lit("/")))
        return F.struct(x["url"].alias("url"), u.alias("p"), joins.alias("joins"), F.when(plain, origin).alias("origin"),
                        folder.alias("folder"), prefix.alias("prefix"))
    return F.get(F.transform(F.array(p), pieces), F.lit(0))


# Links that need no walk: steps without dots, blanks or marks, and a query or fragment
# that is not empty.
_STEP = r"(?!\.{1,2}(?:[/?#]|$))[^\x00-\x20/:?#]+"
_MARKS = r"(?:\?[^#\x00-\x20]+)?(?:#[^\x00-\x20]+)?$"
PLAIN_LINK = rf"^{_STEP}(?:/{_STEP})*/?{_MARKS}"
ROOTED_LINK = rf"^/(?:{_STEP}(?:/{_STEP})*/?)?{_MARKS}"
ABSOLUTE_LINK = rf"^[a-z][a-z0-9+.\-]*://[^/?#\x00-\x20]+(?:/[^?#\x00-\x20]*)?{_MARKS}"


def _url_text(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    opt = lambda mark, c: F.when(c != "", F.concat(F.lit(mark), c)).otherwise(F.lit(""))
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
                    F.when(authority != "", F.concat(F.lit("//"), authority, rooted))
                    # an empty authority is written where the path could be taken for one
                    .when(path.startswith("//") | ((scheme != "") & ((path == "") | path.startswith("/"))), F.concat(F.lit("//"), path))
                    .otherwise(path),
                    opt("?", query), opt("#", fragment))


def resolve_with_parts(href: ColumnOrName, parts: ColumnOrName) -> Column:
    """``resolve_link`` given precomputed ``page_url_parts``."""
    h, page = _c(href), parts if isinstance(parts, Column) else _c(parts)

    def join(pair: Column) -> Column:
        u, base = pair["u"], page["p"]
        other = (u["scheme"] != "") & (u["scheme"] != base["scheme"])
        own = _url_text(base["scheme"], u["authority"], u["path"], u["query"], u["fragment"])
        same_page = _url_text(base["scheme"], base["authority"], base["path"],
                              F.when(u["query"] == "", base["query"]).otherwise(u["query"]), u["fragment"])
        moved = _url_text(base["scheme"], base["authority"], pair["path"], u["query"], u["fragment"])
        return (F.when(other, h).when(u["authority"] != "", own).when(u["path"] == "", same_page).otherwise(moved))

    def walked(u: Column) -> Column:
        relative = ~u["path"].startswith("/")
        start = F.when(relative, page["folder"]).otherwise(F.array().cast("array<string>"))
        return F.struct(u.alias("u"), _walk(start, F.split(u["path"], "/", -1), relative).alias("w"))

    def with_path(x: Column) -> Column:
        w = x["w"]
        path = F.array_join(F.when(w["open"], F.concat(w["out"], F.array(F.lit("")))).otherwise(w["out"]), "/")
        return F.struct(x["u"].alias("u"), F.when(path == "", F.lit("/")).otherwise(path).alias("path"))
    # each lambda's variable holds what the next step uses, so nothing is computed twice
    slow = F.transform(F.transform(F.transform(F.array(url_parts(h)), walked), with_path), join)
    return (F.when(page["url"] == "", h).when(h == "", page["url"])
            .when(~page["joins"] | h.rlike(ABSOLUTE_LINK), h)
            .when(page["prefix"].isNotNull() & h.rlike(PLAIN_LINK), F.concat(page["prefix"], h))
            .when(page["origin"].isNotNull() & h.rlike(ROOTED_LINK), F.concat(page["origin"], h))
            .otherwise(F.get(slow, F.lit(0))))


def resolve_link(href: ColumnOrName, page_url: ColumnOrName) -> Column:
    """Absolute URL of a link found on ``page_url`` (F9), as ``urljoin`` gives it:
    ``.`` and ``..`` steps are taken, a query or fragment alone stays on the page,
    links of another scheme stay as they are, leading blanks go.  A ``;parameter``
    is a part of its path step."""
    # the lambda's variable holds the page's pieces, so they are computed once
    resolved = F.transform(F.array(page_url_parts(page_url)), lambda page: resolve_with_parts(href, page))
    return F.get(resolved, F.lit(0))


# ------------------------------------------------------------- HTML text

# The named character references decoded in tag text and attributes.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
_NUMERIC = r"&#([0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"


def decode_entities(c: ColumnOrName) -> Column:
    """Character references decoded once: named ones, and numeric ones up to
    U+10FFFF.  A text without ``&`` is returned as it is."""
    parts = F.split(_c(c), f"(?={_NUMERIC})|(?<=;)", -1)

    def one(x: Column) -> Column:
        number = F.regexp_extract(x, f"^{_NUMERIC}$", 1)
        code = F.when(F.lower(F.substring(number, 1, 1)) == "x", F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).try_cast("int")
        # the code point as UTF-32 text
        text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        named = x
        for ent, ch in _ENTITIES:
            named = F.replace(named, F.lit(ent), F.lit(ch))
        return F.when((number != "") & (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF), text).otherwise(named)
    return F.when(~_c(c).contains("&"), _c(c)).otherwise(F.array_join(F.transform(parts, one), ""))


def tag_text(c: ColumnOrName) -> Column:
    """Visible text of an HTML fragment: tags removed, references decoded."""
    return decode_entities(F.regexp_replace(_c(c), "<[^>]*>", ""))


# ------------------------------------------------------------- misc

def row_to_json(*cols: ColumnOrName) -> Column:
    """Row -> JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*[_c(x) for x in cols]) if cols else F.struct("*"))


def split_notes(c: ColumnOrName) -> Column:
    """Tracker notes ``file-sheet-skip`` -> struct; fields NULL unless exactly
    three parts (F13)."""
    parts = F.split(_c(c), "-", -1)
    ok = F.size(parts) == 3
    return F.struct(
        F.when(ok, parts[0]).alias("file"),
        F.when(ok, parts[1]).alias("sheet"),
        F.when(ok, parts[2].try_cast("int")).alias("skip_rows"),
        ok.alias("valid"))


def text_fixups(c: ColumnOrName, pairs) -> Column:
    """Ordered literal replacements (C7): ``pairs`` is a list of (old, new)."""
    out = _c(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out
