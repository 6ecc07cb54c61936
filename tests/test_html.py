from faclake.sources.html import extract_links, extract_listing, extract_schema_tables

LISTING = """<html><body><h1>Index of /files</h1><table>
<tr><th><a href="?C=N;O=D">Name</a></th><th><a href="?C=M;O=A">Last modified</a></th><th>Size</th></tr>
<tr><td><a href="/">Parent Directory</a></td><td>&nbsp;</td><td align="right">  - </td></tr>
<tr><td><a href="case_downloads.zip">case_downloads.zip</a></td><td align="right">2024-03-05 14:22  </td><td align="right">128K</td></tr>
<tr><td><a href="sub/">sub/</a></td><td align="right">2024-03-01 09:00  </td><td align="right">  - </td></tr>
<tr><td><a href="a&amp;b.csv.gz">a&amp;b.csv.gz</a></td><td align="right">2024-03-06 01:02  </td><td align="right">1.5G</td></tr>
</table><table><tr><td><a href="ignored.zip">ignored</a></td></tr></table></body></html>"""

DICTIONARY = """<html><body><h1> Case Data Dictionary </h1>
<h3>Introduction</h3><p>text</p>
<h3>Case Facilities (CASE_FACILITIES.csv)</h3>
<table><thead><tr><th>Element Name</th><th>Data Type</th><th>Length</th></tr></thead>
<tbody><tr><td>ACTIVITY_ID</td><td>Number</td><td>10</td></tr>
<tr><td> REGISTRY_ID1 </td><td>VARCHAR2</td><td>12</td></tr></tbody></table>
<table><thead><tr><th>Code</th><th>Meaning</th></tr></thead><tbody><tr><td>A</td><td>B</td></tr></tbody></table>
<h3>Heading without a table (CASE_EXTRA.csv)</h3>
<h3>Enforcements (CASE_ENFORCEMENTS.csv) and (OTHER.csv)</h3>
<table><thead><tr><th>Element</th><th>Type</th></tr></thead>
<tbody><tr><td>CASE_NUMBER</td><td>char</td></tr></tbody></table>
</body></html>"""


def test_listing(spark):
    pages = spark.createDataFrame([(1, "https://downloads.example.gov/files/index.html", LISTING)],
                                  "page_id long, url string, html string")
    rows = extract_listing(pages).orderBy("row_pos").collect()
    assert [r.href for r in rows] == ["case_downloads.zip", "sub/", "a&b.csv.gz"]
    r0 = rows[0]
    assert (r0.link, r0.last_modified, r0.size, r0.size_mb, r0.is_dir) == (
        "https://downloads.example.gov/files/case_downloads.zip", "2024-03-05 14:22", "128K", "0.12", False)
    assert rows[1].is_dir and rows[1].size_mb == "-"
    assert rows[2].size_mb == "1536.00"


def test_links(spark):
    pages = spark.createDataFrame([(1, "https://h.example/a/b?q=1", '<a href="x.zip">x</a> <a class="c" href="/y">y</a>')],
                                  "page_id long, url string, html string")
    got = [(r.link_pos, r.link) for r in extract_links(pages).collect()]
    assert got == [(0, "https://h.example/a/x.zip"), (1, "https://h.example/y")]


def test_dictionary_positional_pairing(spark):
    pages = spark.createDataFrame([(7, DICTIONARY)], "page_id long, html string")
    rows = extract_schema_tables(pages).orderBy("table_pos", "row_pos").collect()
    assert {r.title for r in rows} == {"Case Data Dictionary"}
    # names: FACILITIES, EXTRA, ENFORCEMENTS; schema tables: 2 -> the heading without
    # a table shifts ENFORCEMENTS' table onto CASE_EXTRA.csv, and the last name has none
    got = sorted((r.table_pos, r.table_name, r.paired, list(r.cells) if r.cells else None) for r in rows)
    assert got == [
        (0, "CASE_FACILITIES.csv", True, ["activity_id", "number", "1"]),
        (0, "CASE_FACILITIES.csv", True, ["registry_id", "varchar", "1"]),
        (1, "CASE_EXTRA.csv", True, ["case_number", "char"]),
        (2, "CASE_ENFORCEMENTS.csv", False, None),
    ]


def test_attributes_in_any_quoting(spark):
    page = ("<table><tr><td><a class=x href='a.zip'>a.zip</a></td><td align='right'>2024-01-02 03:04</td><td align=right>3M</td></tr>"
            "<tr><td><a href=b.zip title=\"t\">b.zip</a></td><td ALIGN=RIGHT>2024-01-02 03:04</td><td align=\"right\">7Q</td></tr>"
            "<tr><td><a data-href='no' HREF=\"c&#46;zip\">c.zip</a></td><td align=right>x</td><td align=right> - </td></tr></table>")
    pages = spark.createDataFrame([(1, "https://h.org/d/", page)], "page_id long, url string, html string")
    rows = extract_listing(pages).orderBy("row_pos").collect()
    assert [(r.href, r.link, r["size"], r.size_mb, r.size_quality) for r in rows] == [
        ("a.zip", "https://h.org/d/a.zip", "3M", "3.00", "converted"), ("b.zip", "https://h.org/d/b.zip", "7Q", None, "unknown"),
        ("c.zip", "https://h.org/d/c.zip", "-", "-", "none")]
    assert [r.href for r in extract_links(pages).orderBy("link_pos").collect()] == ["a.zip", "b.zip", "c.zip"]
