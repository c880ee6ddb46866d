"""URL filter and archives."""

import duckdb
import pytest

from checks.parity import spark_rows, sql_rows
from tickbars.llm import op6_url_filter, op9_archives
from tickbars.llm.queries import ORACLE, QUERIES

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    _, got = spark_rows(QUERIES[name](spark, MIDDLE))
    _, want = sql_rows(MIDDLE, ORACLE[name])
    assert got == want and got


def link(kind, url):
    return f"<html><LINK href='{url}' rel=canonical>" if kind == "c" else f'<meta http-equiv="Refresh" content="0; URL={url}">'


PAGES = [
    (1, "http://a.org/x", link("c", "https://example.com/en/1")),  # an allowed alias outranks the block
    (2, "http://b.org/x?q=1#f", link("c", "http://k.net/fr/2")),
    (3, "https://b.org/y", link("r", "/x?q=1")),
    (4, "http://c.org/d/e", link("r", "f")),
    (5, "HTTP://C.org/d/f#z", link("c", "//k.net/es/")),
    (6, "http://www.example.com/en/9", link("c", "http://k.net/fr/2")),
    (7, "http://d.org", None),
    (8, None, link("c", "http://k.net/fr/2")),
    (9, "no scheme", link("c", "http://k.net/fr/2")),
    (10, "http://notexample.com/en/", ""),
    (11, "http://Example.COM/en/", ""),
    (12, "http://e.net/ES/", "<p>"),
    (13, "http://e.net/es/?a=http://x/#y", "<p>"),
    (14, "http://chain0.org/", link("c", "http://chain1.org/")),
    (15, "http://chain1.org/", link("c", "http://chain2.org/")),
    (16, "http://chain2.org/", link("c", "http://chain3.net/fr/")),
    (17, "http://d.org", "<p>again"),
]


def test_url_filter_with_links(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in op6_url_filter.filtered(df).collect()}
    verdicts = {k: (r["rule"], r["verdict"]) for k, r in got.items()}
    # 2 and 6 share k.net/fr/2 with the allowed www.example.com, so only pages away from it are blocked.
    assert verdicts[6] == ("www.example.com/en/", "allow") and verdicts[2] == verdicts[3] == (None, "allow")
    assert verdicts[4] == verdicts[5] == (None, "block")
    assert {verdicts[k] for k in (14, 15, 16)} == {(None, "block")}
    assert verdicts[11] == ("example.com/en/", "block") and verdicts[10] == ("com/", "allow")
    assert verdicts[13] == ("net/es/", "block") and verdicts[12] == (None, "allow")
    assert got[8]["host"] == got[8]["path"] == got[9]["host"] == "" and got[7]["path"] == ""
    df.coalesce(1).write.parquet(f"{tmp_path}/pages")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    cursor = connection.execute(op6_url_filter.OP6_SQL)
    names = [d[0] for d in cursor.description]
    assert sorted(cursor.fetchall(), key=repr) == sorted((tuple(r[n] for n in names) for r in got.values()), key=repr)


LINKED = [
    (1, "http://d.org", "<p>", "block"),
    (2, "http://d2.org/a", link("c", "http://d.org/") + link("r", "http://k.net/fr/1"), "block"),
    (3, "http://e.org/p", link("c", "/q?a=1&amp;b=2&#38;c=3&x;"), "block"),
    (4, "http://e.org/q?a=1&b=2&c=3&x;", link("r", "http://k.net/fr/2"), "block"),
    (5, "http://f.org/a/b/c", link("c", "../x"), "block"),
    (6, "http://f.org/a/x", link("c", "http://k.net/es/3"), "block"),
    (7, "http://g.org/a/b", link("c", "./y/."), "block"),
    (8, "http://g.org/a/y/", link("c", "http://k.net/es/4"), "block"),
    (9, "http://h.org/a/b?o=2", link("c", "?p=1"), "block"),
    (10, "http://h.org/a/b?p=1", link("c", "http://k.net/es/5"), "block"),
    (11, "http://i.org/z", link("c", "/out?u=http://k.net/fr/"), "allow"),
    (12, "http://i.org/y", link("r", "out?u=http://k.net/fr/../es/"), "allow"),
    (13, "http://j.org/z", link("c", "http://j.org/1") + link("c", "http://k.net/fr/6"), "block"),
    (14, "http://l.org/z", link("r", "/1") + link("r", "http://k.net/fr/7"), "block"),
    (15, "http://m.org/", link("c", "mailto:a@k.net/fr/") + link("r", "#part"), "allow"),
    (16, "http://n.org/a/../../b", link("c", "http://k.net/x/../fr/8"), "block"),
    (17, "http://n.org/b", None, "block"),
    (18, "http://o.org?q=1", link("c", "s"), "block"),
    (19, "http://o.org/s", link("c", "http://k.net/es/?a=/../b"), "block"),
    (20, "http://o.org/?q=1", "<p>", "block"),
]


def test_links_are_resolved(spark):
    df = spark.createDataFrame([page[:3] for page in LINKED], "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in op6_url_filter.filtered(df).collect()}
    assert got == {page_id: (None, verdict) for page_id, _, _, verdict in LINKED}


def test_url_filter_without_rows(spark):
    assert op6_url_filter.filtered(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_archives_round_trip(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "http://a/ b\n", big, 1), (2, None, big, 2), (3, "http://a/", "x" * 999, 3), (4, "http://a/", "x" * 999, 4), (5, "http://a/", None, 5), (6, "u", "", 6)]
    rows += [(7, "http://a/", big, 7), (7, "http://a/", big, 7), (None, "http://n/", big, 8), (8, "http://l/", "long " * 200_000, 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, size int")
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in op9_archives.converted(df).collect()), key=repr)
    n = len(big.encode())
    want = [(1, n, "revisit", 7), (2, n, "revisit", 7), (3, 999, "response", None), (4, 999, "response", None), (5, 0, "response", None), (6, 0, "response", None)]
    want += [(7, n, "response", None), (7, n, "response", None), (None, n, "revisit", 7), (8, 1_000_000, "response", None)]
    assert got == sorted(want, key=repr)
    assert op9_archives.converted(df.filter("false")).collect() == []


def test_arc_versions():
    for version in (1, 2):
        block = op9_archives._version_block(version)
        text = block + "\n" + op9_archives._arc_record(version, 4, "http://h/p", "<é>", 77) + "\n"
        (line, document), = op9_archives.arc_records(text.replace("text/html ", "text/html; charset=x ", 1).encode())
        assert line["URL"] == "http://h/p" and line["Content-type"] == "text/html; charset=x" and document.endswith("<é>".encode())
        assert line.get("Offset") == (None if version == 1 else "77")
        with pytest.raises(ValueError):
            list(op9_archives.arc_records(text.encode()[:-4]))


def test_warc_record():
    raw = op9_archives.warc_record(3, "http://h/", "20240102030405", "text/html", b"ab", "aa" * 20, None) + b"\r\n\r\n"
    (headers, block), = op9_archives.warc_records(raw)
    assert headers["warc-date"] == "2024-01-02T03:04:05Z" and headers["warc-type"] == "response" and block.endswith(b"ab")
    assert headers["warc-record-id"] == op9_archives.record_id(3, "http://h/", "aa" * 20)


def test_revisits_name_their_response(spark, tmp_path):
    """By the standard's headers; each file begins with what wrote it."""
    html = "x" * 2000
    rows = [(1, "http://a/1", html), (2, "http://b/2", html), (9, "http://c/9", html), (4, "http://d/4", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    op9_archives.write_arc(pages, str(tmp_path / "arc"))
    op9_archives.write_warc(op9_archives.read_arc(spark, str(tmp_path / "arc")), str(tmp_path / "warc"))
    files = [op9_archives._unpacked(r["content"]) for r in op9_archives._files(spark, str(tmp_path / "warc")).collect()]
    records = [list(op9_archives.warc_records(f)) for f in files if f]
    assert all(held[0][0]["warc-type"] == "warcinfo" and held[0][1].startswith(b"software:") for held in records)
    headers = {h["x-page-id"]: h for held in records for h, _ in held[1:]}
    assert {k: h["warc-type"] for k, h in headers.items()} == {"1": "revisit", "2": "revisit", "9": "response", "4": "response"}
    ids = [h["warc-record-id"] for held in records for h, _ in held]
    assert len(set(ids)) == len(ids)
    for page in "12":
        assert headers[page]["warc-refers-to"] == headers["9"]["warc-record-id"]
        assert headers[page]["warc-refers-to-target-uri"] == "http://c/9"
        assert headers[page]["warc-refers-to-date"] == headers["9"]["warc-date"] == "2024-01-01T00:00:00Z"
    assert "warc-refers-to" not in headers["4"]


def test_files_are_rolled_by_bytes(spark, tmp_path):
    """A page of 20 MB has a file of its own, in both formats; the others share theirs in order."""
    rows = [(i, f"http://a/{i}", ("abc " * 50 if i != 7 else "y" * 20_000_000)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    op9_archives.write_arc(pages, arc, file_bytes=4000)
    contents = [op9_archives._unpacked(r["content"]) for r in op9_archives._files(spark, arc).collect()]
    held = [[int(op9_archives._http_headers(b)[0]["x-page-id"]) for _, b in op9_archives.arc_records(c)] for c in contents if c]
    assert sorted(sum(held, [])) == list(range(40)) and [7] in held
    assert all(h == list(range(h[0], h[-1] + 1)) and len(h) <= 20 for h in held) and len(held) == 4
    op9_archives.write_warc(op9_archives.read_arc(spark, arc), warc, file_records=10)
    files = [list(op9_archives.warc_records(op9_archives._unpacked(r["content"]))) for r in op9_archives._files(spark, warc).collect()]
    assert all(f[0][0]["warc-type"] == "warcinfo" and len(f) <= 11 for f in files if f)
    got = {r["page_id"]: r["payload_bytes"] for r in op9_archives.read_warc(spark, warc).collect()}
    assert got == {i: len(html) for i, _, html in rows}


def test_url_filter_on_odd_rows(spark):
    """Equal rows, a very long page, nulls, and columns with the operator's own names."""
    rows = [(page_id, url, html) for page_id, url, html, _ in LINKED] + [(1, "http://d.org", "<p>")] * 3
    rows += [(100, "http://big.org/x", "x" * 2_000_000 + link("c", "http://k.net/fr/9")), (None, None, None), (101, None, "<p>"), (102, "no scheme", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS node", "'y' AS verdict", "2 AS u", "3 AS root")
    got = sorted(((r["page_id"], r["verdict"]) for r in op6_url_filter.filtered(df).select("page_id", "verdict").collect()), key=repr)
    want = [(page_id, verdict) for page_id, _, _, verdict in LINKED] + [(1, "block")] * 3 + [(100, "block"), (None, "allow"), (101, "allow"), (102, "allow")]
    assert got == sorted(want, key=repr)
