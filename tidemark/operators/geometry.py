"""Lines and boxes on pages: ruled tables, bands, and tiles of images, as relations.

segments(page, kind, at, lo, hi): V at x from top lo to bottom hi, H at y from left lo to right hi. A page is a group.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.plans.staging import spread

# Fixed values, in points: how near coordinates are one, how long a rule's pieces must be together, how far it may miss.
NEAR, V_LENGTH, H_LENGTH, MISS, LEAST = 3.0, 40.0, 100.0, 5.0, 3


def rules(segments: DataFrame) -> DataFrame:
    """rules(page, kind, at, length, lo, hi): the pieces at a rounded coordinate together."""
    return segments.groupBy("page", "kind", F.round("at").cast("int").alias("at")).agg(F.sum(F.col("hi") - F.col("lo")).alias("length"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def cluster(points: DataFrame, by: list[str], value: str, near: float = NEAR) -> DataFrame:
    """points with cluster, the number from 0 of the run of values without a gap over near, and center, its mean."""
    order = Window.partitionBy(*by).orderBy(value)
    gap = F.when(F.col(value) - F.lag(value).over(order) > near, 1).otherwise(0)
    run = points.withColumn("_gap", gap).withColumn("cluster", F.sum("_gap").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    return run.withColumn("center", F.avg(value).over(Window.partitionBy(*by, "cluster"))).drop("_gap")


def ruled_tables(segments: DataFrame) -> DataFrame:
    """grids(page, xs, ys): pages with at least LEAST long upright rules that long level rules cross; a page has one at most."""
    found = rules(segments)
    upright = found.where((F.col("kind") == "V") & (F.col("length") >= V_LENGTH))
    enough = upright.groupBy("page").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST).select("page")
    level = found.where((F.col("kind") == "H") & (F.col("length") >= H_LENGTH)).join(enough, "page")
    crossed = crossing(level, upright).where(F.col("n_crossed") >= LEAST)
    ys = cluster(crossed.select("page", "at"), ["page"], "at").groupBy("page").agg(F.array_sort(F.collect_set("center")).alias("ys"))
    xs = cluster(upright.select("page", "at"), ["page"], "at").groupBy("page").agg(F.array_sort(F.collect_set("center")).alias("xs"))
    return xs.join(ys, "page").where((F.size("ys") >= 2) & (F.size("xs") >= 2))


def crossing(level: DataFrame, upright: DataFrame, miss: float = MISS) -> DataFrame:
    """level with n_crossed: upright rules of the page whose extent holds it. A page's rules meet by page, never all with all."""
    v = upright.select(F.col("page").alias("v_page"), F.col("lo").alias("v_lo"), F.col("hi").alias("v_hi"))
    hit = level.join(v, (F.col("page") == F.col("v_page")) & F.col("at").between(F.col("v_lo") - miss, F.col("v_hi") + miss), "left")
    return hit.groupBy(*level.columns).agg(F.count("v_page").alias("n_crossed"))


def outside_bands(lines: DataFrame, bands: DataFrame) -> DataFrame:
    """lines(page, center, ..) that lie in none of bands(page, top, bottom)."""
    b = bands.select(F.col("page").alias("b_page"), "top", "bottom")
    return lines.join(b, (F.col("page") == F.col("b_page")) & F.col("center").between(F.col("top"), F.col("bottom")), "left_anti")


def edge_grid(cells: DataFrame, by: list[str]) -> DataFrame:
    """cells(.., x0, y0, x1, y1) with row, col, row_span, col_span: places of their edges among the distinct ones of a table."""

    def ranks(a: str, b: str, out: str) -> DataFrame:
        edges = cells.select(*by, F.col(a).alias("e")).union(cells.select(*by, F.col(b).alias("e"))).distinct()
        return edges.withColumn(out, F.dense_rank().over(Window.partitionBy(*by).orderBy("e")) - 1)

    out = cells
    for edge, axis, name in (("x0", ("x0", "x1"), "c0"), ("x1", ("x0", "x1"), "c1"), ("y0", ("y0", "y1"), "r0"), ("y1", ("y0", "y1"), "r1")):
        out = out.join(ranks(*axis, name).withColumnRenamed("e", edge), [*by, edge])
    return out.select(*cells.columns, F.col("r0").alias("row"), F.col("c0").alias("col"), (F.col("r1") - F.col("r0")).alias("row_span"), (F.col("c1") - F.col("c0")).alias("col_span"))


def abutting(tiles: DataFrame, near: float = 1.0) -> DataFrame:
    """pairs(page, a, b, side) of tiles(page, id, x0, y0, x1, y1) that share a whole edge."""
    a, b = tiles.alias("a"), tiles.alias("b")
    eq = lambda p, q: F.abs(F.col(p) - F.col(q)) <= near
    right = eq("a.x1", "b.x0") & eq("a.y0", "b.y0") & eq("a.y1", "b.y1")
    below = eq("a.y1", "b.y0") & eq("a.x0", "b.x0") & eq("a.x1", "b.x1")
    return a.join(b, (F.col("a.page") == F.col("b.page")) & (F.col("a.id") != F.col("b.id")) & (right | below)).select(F.col("a.page").alias("page"), F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.when(right, "right").otherwise("below").alias("side"))


def merge_tiles(tiles: DataFrame, near: float = 1.0, density_within: float = 0.02, max_pixels: int = 80_000_000) -> DataFrame:
    """tiles(page, id, x0, y0, x1, y1, width, height in pixels) merged until no two share a whole edge: page, ids, x0, y0, x1, y1, width, height.

    Only tiles of one density merge, up to max_pixels; a page is a group. The work grows with the tiles, by the edges they begin and end at.
    """

    def merge(table: pa.Table) -> pa.Table:
        boxes = [{**t, "ids": [t["id"]]} for t in table.to_pylist()]
        width, reach = 8 * near or 1.0, near * 1.001  # a little more than near, for what rounding takes
        order = lambda i: (boxes[i]["y0"], boxes[i]["x0"], boxes[i]["ids"], i)
        cell = lambda v: math.floor(v / width)
        near_cells = lambda v: {cell(v - reach), cell(v + reach)}
        sides = (("x0", "x1", "y0", "y1", "width", "height"), ("y0", "y1", "x0", "x1", "height", "width"))
        # boxes by side and the corners of the edge where they begin, and of that where they end, in cells
        begin, end = defaultdict(dict), defaultdict(dict)

        def places(i: int):
            for k, (lo, hi, o_lo, o_hi, _, _) in enumerate(sides):
                t = boxes[i]
                yield begin, (k, cell(t[lo]), cell(t[o_lo]), cell(t[o_hi]))
                yield end, (k, cell(t[hi]), cell(t[o_lo]), cell(t[o_hi]))

        def put(i: int) -> None:
            for index, at in places(i):
                index[at][i] = None

        def take(i: int) -> None:
            for index, at in places(i):
                del index[at][i]
                if not index[at]:
                    del index[at]

        def beside(index: dict, i: int, mine: int):
            """Boxes of an index whose edge may be the one of box i at its end (mine 1) or its beginning (0)."""
            for k, side in enumerate(sides):
                for at in itertools.product(*(near_cells(boxes[i][side[c]]) for c in (mine, 2, 3))):
                    yield from (j for j in index.get((k, *at), ()) if j != i)

        def joined(a, b):
            for lo, hi, o_lo, o_hi, size, other in sides:
                if abs(a[hi] - b[lo]) <= near and abs(a[o_lo] - b[o_lo]) <= near and abs(a[o_hi] - b[o_hi]) <= near:
                    da, db = a[size] / max(a[hi] - a[lo], 1e-9), b[size] / max(b[hi] - b[lo], 1e-9)
                    whole = {size: a[size] + b[size], other: max(a[other], b[other])}
                    if abs(da - db) <= density_within * max(da, db) and whole[size] * whole[other] <= max_pixels:
                        return {hi: b[hi], **whole}
            return None

        # the first box in order that has a partner takes the first that it has; only those beside a box that has grown are asked again
        for i in range(len(boxes)):
            put(i)
        todo, waits, alive = [order(i) for i in range(len(boxes))], [True] * len(boxes), [True] * len(boxes)
        heapq.heapify(todo)
        while todo:
            i = heapq.heappop(todo)[-1]
            waits[i] = False
            j = min((j for j in beside(begin, i, 1) if joined(boxes[i], boxes[j])), key=order, default=None) if alive[i] else None
            if j is None:
                continue
            take(i)
            take(j)
            boxes[i].update(joined(boxes[i], boxes[j]))
            boxes[i]["ids"].extend(boxes[j]["ids"])
            alive[j] = False
            put(i)
            for k in {i, *beside(end, i, 0)}:
                if not waits[k]:
                    waits[k] = True
                    heapq.heappush(todo, order(k))
        boxes = sorted((b for b, there in zip(boxes, alive) if there), key=lambda t: (t["y0"], t["x0"], t["ids"]))
        names = ("page", "ids", "x0", "y0", "x1", "y1", "width", "height")
        return pa.Table.from_pylist([{n: b[n] for n in names} for b in boxes], schema=pa.schema([("page", pa.int64()), ("ids", pa.list_(pa.int64())), *[(n, pa.float64()) for n in names[2:6]], ("width", pa.int64()), ("height", pa.int64())]))

    return spread(tiles, "page").groupBy("page").applyInArrow(merge, "page bigint, ids array<bigint>, x0 double, y0 double, x1 double, y1 double, width bigint, height bigint")
