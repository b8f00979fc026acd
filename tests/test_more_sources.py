"""Adaptive API scans against a local stub, and spreadsheets against what was written into them."""

import collections
import datetime
import http.server
import json
import random
import threading
import urllib.error
import urllib.parse
import urllib.request
import zipfile

import pytest

from tessera.sources import dated, spreadsheets

START = datetime.date(2023, 1, 1)


@pytest.fixture
def api():
    """A server of 3,000 rows over 500 days, a fifth of them on ten days, that caps a query at 100 rows and now and then asks to wait."""
    rnd = random.Random(1)
    days = [START + datetime.timedelta(days=rnd.choice(range(40, 50)) if rnd.random() < 0.22 else rnd.randrange(500)) for _ in range(3000)]
    rows = [{"id": i, "day": d.isoformat()} for i, d in enumerate(days)]
    log = collections.Counter()

    class Stub(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            url = urllib.parse.urlparse(self.path)
            q = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
            log[url.path, q["a"], q["b"]] += 1
            if log["busy"] < 5 and rnd.random() < 0.2:
                log["busy"] += 1
                self.send_response(429)
                self.send_header("Retry-After", "0.05")
                self.end_headers()
                return
            if url.path == "/rows" and log["fail"] and log["served"] > 20:
                self.send_response(500)
                self.end_headers()
                return
            found = [r for r in rows if q["a"] <= r["day"] <= q["b"]]
            log["served"] += url.path == "/rows"
            body = json.dumps(len(found) if url.path == "/count" else found[:100]).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", rows, log
    server.shutdown()


def functions(base):
    def get(kind, a, b):
        try:
            with urllib.request.urlopen(f"{base}/{kind}?a={a}&b={b}") as r:
                return json.loads(r.read())
        except urllib.error.HTTPError as e:
            if e.code == 429:
                raise dated.RetryLater(float(e.headers["Retry-After"])) from None
            raise

    return (lambda a, b: get("count", a, b)), (lambda a, b: get("rows", a, b))


def test_ranges_hold_all_rows(spark, api):
    base, rows, _ = api
    count, _ = functions(base)
    found = dated.plan(spark, count, START, START + datetime.timedelta(days=499), 100, days=365).collect()
    assert sum(r.n for r in found) == 3000 and max(r.n for r in found) <= 100
    ends = sorted((r["first"], r["last"]) for r in found)
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    with pytest.raises(Exception, match="more than a query's 20"):
        dated.plan(spark, count, START, START + datetime.timedelta(days=499), 20).collect()


def test_a_scan_that_was_stopped_goes_on(spark, api, tmp_path):
    base, rows, log = api
    count, get = functions(base)
    days = (START, START + datetime.timedelta(days=499))
    log["fail"] = 1
    with pytest.raises(Exception, match="500"):
        dated.scan(spark, count, get, *days, 100, f"{tmp_path}/t", at_once=8)
    log["fail"] = 0
    finished = {r["range"] for r in spark.read.parquet(f"{tmp_path}/t/finished").collect()}
    assert len(finished) >= 8
    before = {k: n for k, n in log.items() if k[0] == "/rows"}
    found = dated.scan(spark, count, get, *days, 100, f"{tmp_path}/t", at_once=8)
    assert sorted(json.loads(r.body)["id"] for r in found.collect()) == list(range(3000))
    assert all(log["/rows", *x.split("_")] == before["/rows", *x.split("_")] for x in finished)


def cell(ref, value, kind="", style=0):
    s = f' s="{style}"' if style else ""
    if kind == "inlineStr":
        return f'<c r="{ref}"{s} t="inlineStr"><is><t>{value}</t></is></c>'
    return f'<c r="{ref}"{s}{f" t=\"{kind}\"" if kind else ""}><v>{value}</v></c>'


def book(path, sheets, shared=(), dimension=True):
    main, rel = spreadsheets.MAIN[1:-1], spreadsheets.RELATION[1:-1]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="&quot;days&quot; 0.00"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si>{x}</si>" for x in shared) + "</sst>")
        for i, rows in enumerate(sheets.values(), 1):
            top = f'<dimension ref="A1:C{max(rows, default=1)}"/>' if dimension else ""
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}">{top}<sheetData>' + "".join(f'<row r="{r}">{"".join(cells)}</row>' for r, cells in rows.items()) + '</sheetData><mergeCells count="1"><mergeCell ref="A1:B1"/></mergeCells></worksheet>')


def test_typed_merged_and_empty_cells(spark, tmp_path):
    shared = ["<t>name</t>", "<r><t>rich </t></r><r><t>text</t></r>", "<t>漢字</t><rPh sb='0' eb='1'><t>kana</t></rPh>"]
    first = {
        1: [cell("A1", 0, "s"), cell("C1", 1, "s")],
        2: [cell("A2", 2, "s"), cell("B2", "3.0"), cell("C2", "2.50")],
        4: [cell("A4", 1, "b"), cell("B4", 45292, style=1), cell("C4", "45292.5", style=2)],
        5: [cell("A5", "#N/A", "e"), cell("B5", "kept as it is", "inlineStr"), cell("AA5", "7")],
        6: [cell("A6", "1.5", style=3), cell("B6", "0.25", style=1), cell("C6", "sum", "str")],
        7: [],
    }
    book(tmp_path / "a.xlsx", {"One": first, "Two": {3: [cell("B3", "late", "inlineStr")]}}, shared)
    found = spreadsheets.read(spark, str(tmp_path), rows=2)
    assert found.rdd.getNumPartitions() == 6
    got = {(r.sheet, r.row): r.cells for r in found.collect()}
    assert got == {
        ("One", 1): ["name", "", "rich text"], ("One", 2): ["漢字", "3", "2.5"], ("One", 4): ["true", "2024-01-01", "2024-01-01 12:00:00"], ("One", 5): ["#N/A", "kept as it is", *[""] * 24, "7"],
        ("One", 6): ["1.5", "06:00:00", "sum"], ("Two", 3): ["", "late"],
    }
    path = found.first().path
    one = spreadsheets.table(found, path, "One")
    assert one.columns == ["row", "name", "column_2", "rich text"] and [tuple(r)[1:] for r in one.orderBy("row").collect()][0] == ("漢字", "3", "2.5")


@pytest.mark.parametrize("dimension", [True, False])
def test_ranges_of_a_long_sheet(spark, tmp_path, dimension):
    rows = {r: [cell(f"A{r}", r), cell(f"B{r}", f"v{r}", "inlineStr")] for r in range(1, 3001) if r % 7}
    book(tmp_path / "b.xlsm", {"Long": rows, "Empty": {}}, dimension=dimension)
    found = spreadsheets.read(spark, str(tmp_path / "b.xlsm"), rows=400)
    assert sorted((r.row, *r.cells) for r in found.collect()) == [(r, str(r), f"v{r}") for r in rows]
    assert found.rdd.getNumPartitions() == (9 if dimension else 2)


def test_a_commit_that_was_cut_off(spark, tmp_path, monkeypatch):
    """Between taking the old pointer away and naming the new one, the new run is live; large files are hashed as streams."""
    from tessera.sources import publish

    p = publish.Publisher(spark, f"{tmp_path}/lake")
    for run, n in (("r1", 1000), ("r2", 1500)):
        small = p.stage(run, {"t": spark.range(n)}).collect()
        monkeypatch.setattr(publish, "WHOLE", 0)
        assert sorted(map(tuple, p.manifest(run).collect())) == sorted(map(tuple, small))
        monkeypatch.undo()
        p.commit(run, p.manifest(run))
    assert p.live() == "r2"
    (tmp_path / "lake/_LATEST.json").rename(tmp_path / "lake/_LATEST.tmp")
    assert p.live() == "r2" and p.table("t").count() == 1500
