"""Readers on hand-written files: snapshot text (R6-R8), CSV union (R3/R4),
JSON shapes (R9), meeting pages (R10)."""

import datetime as dt

from pyspark.sql import types as T

from conftest import rows
from shortbook.plans import jobs
from shortbook.sources import csv as csv_src, html, jsonsrc, snapshots

USA = """#BOF|2025.04.14|19:06:47

#SYM|CUR|NAME|AVAILABLE|FEERATE|REBATERATE|FIGI
aapl|USD|Apple|1000|0.25|-0.5|BBG000B9XRY4
NA|USD|Literal NA|NA|na|
 |USD|blank symbol|1|1|1
msft|USD
goog|USD|Alphabet|abc|2|3|NA|extra
# a comment
#EOF
"""
MIXED = """#BOF|garbage
#SYM|AVAILABLE
x|1
#SYM||FEERATE|AVAILABLE
y|2|3
"""


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_snapshot_text_edges(spark, tmp_path):
    snap = tmp_path / "2025-04-14_19-00-00"
    write(snap / "usa.txt", USA)
    write(snap / "Mixed.txt", MIXED)
    write(snap / "noheader.txt", "a|1\nb|2\n")
    write(snap / "norows.txt", "#BOF|2025.04.14|19:06:47\n#SYM|AVAILABLE\n#EOF\n")
    write(snap / "upper.TXT", "#SYM|AVAILABLE\nzz|1\n")
    write(tmp_path / "not_a_snapshot" / "x.txt", "#SYM|AVAILABLE\nqq|1\n")
    out = snapshots.parse_snapshot_text(spark, str(tmp_path))
    got = rows(out, ["COUNTRY", "SYM", "CURRENCY", "NAME", "AVAILABLE", "FEERATE", "REBATERATE", "bof_ts"])
    bof = dt.datetime(2025, 4, 14, 19, 6, 47)
    folder = dt.datetime(2025, 4, 14, 19, 0, 0)
    expected = [
        ("USA", "AAPL", "USD", "Apple", 1000.0, 0.25, -0.5, bof),
        ("USA", None, "USD", "Literal NA", None, None, None, bof),
        ("USA", "MSFT", "USD", None, None, None, None, bof),
        ("USA", "GOOG", "USD", "Alphabet", None, 2.0, 3.0, bof),
        # last header applies to every row; blank header cell dropped; bad BOF -> folder time
        ("MIXED", "X", None, None, None, 1.0, None, folder),
        ("MIXED", "Y", None, None, 3.0, 2.0, None, folder),
    ]
    assert got == sorted(expected, key=repr)
    extra = {r["SYM"]: [tuple(e) for e in r["EXTRA"]] for r in out.where("COUNTRY = 'USA'").collect()}
    assert extra["AAPL"] == [("FIGI", "BBG000B9XRY4")]
    assert extra["MSFT"] == [("FIGI", None)] and extra["GOOG"] == [("FIGI", None)]


def test_snapshot_writer_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("2024-01-02_00-00-00", "US", 1, "A", 1.0), ("2024-01-02_00-00-00", "US", 2, "B", None),
         ("2024-01-03_00-00-00", "GB", 3, "C", 2.5)],
        "folder string, COUNTRY string, SEQ long, SYM string, AVAILABLE double")
    root = str(tmp_path / "land")
    snapshots.write_snapshot_text(df, root, "folder", "COUNTRY", "SEQ", ["SYM", "AVAILABLE"])
    names = sorted(p.name for p in (tmp_path / "land" / "2024-01-02_00-00-00").iterdir())
    assert [n for n in names if not n.startswith(".")] == ["us.txt"]
    out = snapshots.parse_snapshot_text(spark, root)
    assert rows(out, ["COUNTRY", "SYM", "AVAILABLE"]) == sorted(
        [("US", "A", 1.0), ("US", "B", None), ("GB", "C", 2.5)], key=repr)


def test_csv_union_by_header(spark, tmp_path):
    write(tmp_path / "10-K_filings_2024_Q1.csv", "cik,company\n0001,Acme\n")
    write(tmp_path / "8-K_filings_2024_Q1.csv", "company,cik,items\nBeta,0002,2.02\n")
    write(tmp_path / "10-Q_filings_2024_Q1.csv", "cik,company\n")
    out = csv_src.read_filings(spark, str(tmp_path))
    assert rows(out, ["cik", "company", "items", "filing_type"]) == sorted(
        [("0001", "Acme", None, "10-K"), ("0002", "Beta", "2.02", "8-K")], key=repr)


def test_json_shapes(spark, tmp_path):
    rec = T.StructType([T.StructField("a", T.StringType()), T.StructField("d", T.StringType())])
    write(tmp_path / "pages" / "p1.json", '[{"a": "1", "d": "2024-01-01"}, {"a": "2", "d": "2024-01-08"}]')
    write(tmp_path / "pages" / "p2.json", '[{"a": "3", "d": "2024-01-08"}]')
    got = jsonsrc.read_paged_records(spark, str(tmp_path / "pages"), rec, "d", "2024-01-08")
    assert rows(got, ["a"]) == [("2",), ("3",)]
    write(tmp_path / "nested" / "n.json", '{"data": {"rows": [{"a": "x"}, {"a": "y"}]}}\n{"other": 1}\n')
    got = jsonsrc.read_nested_records(spark, str(tmp_path / "nested"), rec)
    assert rows(got, ["a"]) == [("x",), ("y",)]
    m = T.StructType([T.StructField("cik_str", T.LongType()), T.StructField("ticker", T.StringType())])
    write(tmp_path / "keyed" / "k.json", '{"0": {"cik_str": 320193, "ticker": "AAPL"}, "1": {"cik_str": 789019, "ticker": "MSFT"}}')
    got = jsonsrc.read_keyed_objects(spark, str(tmp_path / "keyed"), m)
    assert rows(got, ["_key", "cik_str", "ticker"]) == [("0", 320193, "AAPL"), ("1", 789019, "MSFT")]


FOMC = """<html><body><div id="article">
<div class="panel panel-default"><div class="panel-heading"><h4><a id="y">2024 FOMC Meetings</a></h4></div>
<div class="row fomc-meeting"><div class="fomc-meeting__month"><strong>January</strong></div>
<div class="fomc-meeting__date">30-31*</div>
<div class="fomc-meeting__minutes"><a href="/monetarypolicy/fomcminutes20240131.htm">HTML</a> <a href="m.pdf">PDF</a><br>
(Released February 21, 2024)</div></div>
<div class="fomc-meeting--shaded row fomc-meeting"><div class="fomc-meeting__month">March</div>
<div class="fomc-meeting__date">19 (unscheduled)</div></div>
<div class="row fomc-meeting"><div class="fomc-meeting__month">April</div><div class="fomc-meeting__date">(cancelled)</div></div>
</div>
<div class="panel panel-default"><div class="row fomc-meeting"><div class="fomc-meeting__month">May</div>
<div class="fomc-meeting__date">1 (Notation Vote)</div></div></div>
</div></body></html>"""


def test_meeting_page(spark):
    pages = spark.createDataFrame([(1, FOMC), (2, "<html><body>no article</body></html>")], "page_id long, html string")
    out = jobs.meeting_rows(html.meeting_records(pages))
    got = rows(out, ["Year", "Month", "Dates", "Summary of Economic Projections", "Unscheduled", "Cancelled",
                     "Notation Vote", "Transcript HTML Link", "Transcript Release Date"])
    link = "https://www.federalreserve.gov//monetarypolicy/fomcminutes20240131.htm"
    assert got == sorted([
        (2024, "January", "30-31", True, False, False, False, link, "February 21, 2024"),
        (2024, "March", "19", False, True, False, False, None, None),
        (2024, "May", "1", False, False, False, True, None, None),
    ], key=repr)


def test_generic_html_records(spark):
    page = "<html><nav><a href='/a'>A</a><a href='/b'>B &amp; C</a></nav><article><h1>T</h1><p>one<p>two</article></html>"
    out = html.html_records(spark.createDataFrame([(7, page)], "page_id long, html string"))
    assert rows(out, ["kind", "pos", "text", "href"]) == sorted([
        ("h1", 0, "T", None), ("nav_link", 0, "A", "/a"), ("nav_link", 1, "B & C", "/b"),
        ("paragraph", 0, "one", None), ("paragraph", 1, "two", None)], key=repr)


def test_csv_union_skips_unreadable_file(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y\n1,2\n")
    (tmp_path / "b.csv").write_bytes(b"")  # empty file: no header line
    write(tmp_path / "c.csv", "y,x\n3,4\n")
    out = csv_src.read_csv_union(spark, str(tmp_path))
    assert rows(out, ["x", "y"]) == [("1", "2"), ("4", "3")]


def test_csv_union_keeps_malformed_rows(spark, tmp_path):
    write(tmp_path / "a.csv", 'x,y\n1,2\n3,4,5\n')
    out = csv_src.read_csv_union(spark, str(tmp_path), corrupt_col="_bad")
    got = rows(out, ["x", "y", "_bad"])
    assert ("1", "2", None) in got and any(r[2] == "3,4,5" for r in got)


def test_named_files_keep_special_characters(spark, tmp_path):
    from shortbook.sources import sinks
    df = spark.createDataFrame([("a+b c.csv", 1), ("x%y=z.csv", 2)], "_name string, v int")
    written = sinks.write_named_files(df, str(tmp_path / "o"), "_name", "csv", {"header": True})
    assert sorted(w.rsplit("/", 1)[1] for w in written) == ["a+b c.csv", "x%y=z.csv"]


def test_snapshot_text_shuffle_join_path(spark, tmp_path):
    """Where the per-file table is too large to broadcast the lines are
    shuffled to it; line order was fixed at the scan, so results are identical."""
    snap = tmp_path / "2025-04-14_19-00-00"
    write(snap / "usa.txt", USA)
    write(snap / "Mixed.txt", MIXED)
    cols = ["COUNTRY", "SYM", "AVAILABLE", "FEERATE", "REBATERATE", "bof_ts"]
    expected = rows(snapshots.parse_snapshot_text(spark, str(tmp_path)), cols)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        got = snapshots.parse_snapshot_text(spark, str(tmp_path))
        from conftest import plan_text
        assert "SortMergeJoin" in plan_text(got)
        assert rows(got, cols) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_bad_page_does_not_fail_the_job(spark, monkeypatch):
    """A page that cannot be read gives an error row; an unknown id is null."""
    def records(page):
        if page == "bad":
            raise ValueError("broken page")
        return [("h1", 0, page, None)]
    pages = spark.createDataFrame([(1, "ok"), (2, "bad"), (None, "x")], "page_id long, html string")
    out = html._map_pages(pages, "page_id", "html", records, ["page_id", "kind", "pos", "text", "href"],
                          html.RECORD_SCHEMA, lambda m: ("parse_error", 0, m, None))
    assert rows(out, ["page_id", "kind", "text"]) == sorted(
        [(1, "h1", "ok"), (2, "parse_error", "ValueError: broken page"), (None, "h1", "x")], key=repr)


def test_deep_and_split_markup():
    deep = "<div>" * 5_000 + "<h1>x <b>y</b></h1>" + "</div>" * 5_000
    assert html.page_records(deep) == [("h1", 0, "x y", None)]
    page = """<div id="article"><div class="panel panel-default"><div class="panel-heading">
      <h4><a>2024 <b>FOMC Meetings</b></a></h4></div>
      <div class="row fomc-meeting"><div class="fomc-meeting__month">May<script>no</script></div>
      <div class="fomc-meeting__date">1</div></div></div>"""
    assert html.page_meetings(page) == [("2024", "May", "1", None, None, None)]
    assert html.page_meetings(None) == html.page_records("") == []


def test_nav_links_without_python(spark):
    from conftest import plan_text
    page = "<nav class='x'><a class=\"k\" href='/a'> A <i>b</i></a></nav><a href='/no'>n</a><NAV><a href=\"/c?x&amp;y\">C</a></NAV>"
    out = html.nav_links(spark.createDataFrame([(7, page), (8, None)], "page_id long, html string"))
    assert rows(out, ["page_id", "pos", "text", "href"]) == [(7, 0, "A b", "/a"), (7, 1, "C", "/c?x&y")]
    assert not any(k in plan_text(out) for k in ("MapInPandas", "MapInArrow", "ArrowEval", "BatchEvalPython"))


def test_nav_links_of_loose_markup(spark):
    page = ("<!-- <nav><a href='/c'>c</a></nav> --><nav><script>'<a href=\"/s\">s</a>'</script><a href=/u>it&#8217;s</a>"
            "<a name=k>&eacute;&copy;&#x27;&unknown;&</a><nav><a href='/n?a&amp;b'>n</a></nav><A HREF = '/o'>&#146;</A></nav>"
            "<a href='/no'>n</a>")
    out = html.nav_links(spark.createDataFrame([(7, page)], "page_id long, html string"))
    assert rows(out, ["page_id", "pos", "text", "href"]) == sorted([
        (7, 0, "it\u2019s", "/u"), (7, 1, "\u00e9\u00a9'&unknown;&", None), (7, 2, "n", "/n?a&b"),
        (7, 3, "\u2019", "/o")], key=repr)


def test_csv_quotes_commas_and_newlines(spark, tmp_path):
    import csv
    records = [("1", 'ACME "X" Corp, Inc', "plain"), ("2", "two\nlines", 'say ""'), ("3", "", "a,b")]
    with open(tmp_path / "q.csv", "w", newline="") as f:
        csv.writer(f).writerows([("id", "name", "note"), *records])
    want = sorted([(a, b or None, c) for a, b, c in records], key=repr)
    assert rows(csv_src.read_csv_union(spark, str(tmp_path)), ["id", "name", "note"]) == want
    table = csv_src.read_csv_table(spark, str(tmp_path / "q.csv"))
    assert rows(table, ["id", "name", "note"]) == want
    from shortbook.sources import sinks
    sinks.write_csv(table, str(tmp_path / "again"))
    assert rows(csv_src.read_csv_table(spark, str(tmp_path / "again")), ["id", "name", "note"]) == want


def test_archive_twice_replaces(spark, tmp_path):
    from shortbook.sources import sinks
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "folder string, v int")
    plan = spark.createDataFrame([("a", "archive"), ("b", "keep")], "folder string, action string")
    root = str(tmp_path / "arch")
    assert sinks.archive_snapshots(df, plan, root) == 2
    assert sinks.archive_snapshots(df, plan, root) == 2
    assert spark.read.parquet(root).count() == 2
