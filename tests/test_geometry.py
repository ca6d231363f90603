"""Rules and tiles on pages, and tables in markup."""

import time

from tidemark.operators import geometry, render


def test_ruled_tables(spark):
    v = [(1, "V", float(x), 500.0, 600.0) for x in (100, 200, 300)]
    h = [(1, "H", float(y), 100.0, 300.0) for y in (500, 550, 600)]
    short = [(2, "V", 10.0, 0.0, 20.0), (2, "V", 20.0, 0.0, 20.0), (2, "V", 30.0, 0.0, 20.0), (2, "H", 5.0, 0.0, 200.0)]
    far = [(1, "H", 900.0, 100.0, 300.0), (1, "V", 300.4, 500.0, 510.0)]
    got = geometry.ruled_tables(spark.createDataFrame(v + h + short + far, "page int, kind string, at double, lo double, hi double")).collect()
    assert [(r.page, r.xs, r.ys) for r in got] == [(1, [100.0, 200.0, 300.0], [500.0, 550.0, 600.0])]


def test_tiles_merge_until_none_is_left(spark):
    tile = lambda i, x, y, w=10.0, h=10.0, p=100: (1, i, x, y, x + w, y + h, int(p * w / 10), int(p * h / 10))
    rows = [tile(1, 0.0, 0.0), tile(2, 10.0, 0.0), tile(3, 0.0, 10.0), tile(4, 10.0, 10.0), tile(5, 50.0, 50.0), tile(6, 60.0, 50.0, p=300)]
    tiles = spark.createDataFrame(rows, "page long, id long, x0 double, y0 double, x1 double, y1 double, width long, height long")
    got = sorted((sorted(r.ids), r.width, r.height) for r in geometry.merge_tiles(tiles).collect())
    assert got == [([1, 2, 3, 4], 200, 200), ([5], 100, 100), ([6], 300, 300)]
    assert geometry.abutting(tiles).where("a = 1").count() == 2


def test_html_tables():
    html = '<table><tr><td colspan=2>a</td><td rowspan="2">b</td></tr><tr><td>c<br>d</td><td>e</td></tr></table><table><tr><th>x</table>'
    cells = {(t, r, c): x for t, r, c, x in render.parse_html_tables(html)}
    assert cells == {(0, 0, 0): "a", (0, 0, 1): "a", (0, 0, 2): "b", (0, 1, 0): "c\nd", (0, 1, 1): "e", (0, 1, 2): "b", (1, 0, 0): "x"}
    assert list(render.parse_html_tables(None)) == [] and list(render.parse_html_tables("<p>none</p>")) == []


def test_documents():
    assert "| LOC |" in render.item_document() and "매립+준공" in render.type_document()


def test_tiles_of_a_large_page_merge_in_time(spark):
    n = 6000  # in two columns; comparing all with all again after each merge took minutes
    rows = [(1, i, i % 2 * 100.0, i // 2 * 50.0, i % 2 * 100 + 100.0, i // 2 * 50 + 50.0, 200, 100) for i in range(n)]
    tiles = spark.createDataFrame(rows, "page long, id long, x0 double, y0 double, x1 double, y1 double, width long, height long")
    began = time.time()
    (whole,) = geometry.merge_tiles(tiles, max_pixels=1 << 40).collect()
    assert (whole.ids, whole.width, whole.height) == (list(range(n)), 400, n // 2 * 100) and time.time() - began < 20
    limited = geometry.merge_tiles(tiles, max_pixels=4_000_000).collect()
    assert max(r.width * r.height for r in limited) == 4_000_000 and sorted(i for r in limited for i in r.ids) == list(range(n))
