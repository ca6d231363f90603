"""HTML of tables, tables in HTML and Markdown, and Markdown reports."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.window import Window

from tidemark.functions import text as T


def html_tables(cells: DataFrame, spans: DataFrame) -> DataFrame:
    """html(doc, tbl, html): a table each; merged cells are drawn once, at their first place, with their spans.

    Merges are never guessed: without spans every coordinate is a cell. Rows that are short are filled.
    """
    by = ["doc", "tbl"]
    anchors = spans.select(*by, "row", "col", F.greatest("row_span", F.lit(1)).alias("rs"), F.greatest("col_span", F.lit(1)).alias("cs"))
    inner = anchors.select(*by, F.explode(F.expr("sequence(row, row + rs - 1)")).alias("row"), F.col("row").alias("r0"), F.col("col").alias("c0"), "cs")
    inner = inner.select(*by, "row", F.explode(F.expr("sequence(c0, c0 + cs - 1)")).alias("col"), "r0", "c0").where("row <> r0 OR col <> c0").select(*by, "row", "col").distinct()
    size = cells.groupBy(*by).agg(F.max("row").alias("rows"), F.max("col").alias("cols"))
    full = size.select(*by, F.explode(F.expr("sequence(0, rows)")).alias("row"), "cols").select(*by, "row", F.explode(F.expr("sequence(0, cols)")).alias("col"))
    drawn = full.join(inner, [*by, "row", "col"], "left_anti").join(cells.select(*by, "row", "col", "text"), [*by, "row", "col"], "left").join(anchors, [*by, "row", "col"], "left")
    attr = lambda name, c: F.when(F.col(c) > 1, F.concat(F.lit(f' {name}="'), F.col(c).cast("string"), F.lit('"'))).otherwise("")
    cell = F.concat(F.lit("<td"), attr("rowspan", "rs"), attr("colspan", "cs"), F.lit(">"), T.html_escape("text"), F.lit("</td>"))
    rows = drawn.groupBy(*by, "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", cell.alias("h")))), lambda x: x["h"]), "").alias("h"))
    rows = rows.select(*by, "row", F.concat(F.lit("<tr>"), "h", F.lit("</tr>")).alias("h"))
    return rows.groupBy(*by).agg(F.concat(F.lit("<table>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "h"))), lambda x: x["h"]), ""), F.lit("</table>")).alias("html"))


def html_document(html: Column | str, title: Column | str) -> Column:
    return F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), T.html_escape(title), F.lit("</title></head><body>"), F.col(html) if isinstance(html, str) else html, F.lit("</body></html>"))


class _Tables(HTMLParser):
    """Collects tables' cells; a cell is put into every coordinate that it covers."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables, self.open = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"grid": {}, "row": -1, "col": 0, "cell": None})
            return
        if not self.open:
            return
        now = self.open[-1]
        if tag == "tr":
            self._close(now)
            now["row"], now["col"] = now["row"] + 1, 0
        elif tag in ("td", "th"):
            self._close(now)
            span = {k: int(v) if (v or "").strip().isdigit() else 1 for k, v in attrs if k in ("rowspan", "colspan")}
            now["row"] = max(now["row"], 0)
            while (now["row"], now["col"]) in now["grid"]:
                now["col"] += 1
            now["cell"] = (max(1, min(span.get("rowspan", 1), 65_534)), max(1, min(span.get("colspan", 1), 1_000)), [])
        elif tag == "br" and now["cell"]:
            now["cell"][2].append("\n")

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in ("td", "th", "tr"):
            self._close(self.open[-1])
        elif tag == "table":
            now = self.open.pop()
            self._close(now)
            self.tables.append(now["grid"])

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"][2].append(data)

    def _close(self, now):
        if not now["cell"]:
            return
        down, right, parts = now["cell"]
        text = "".join(parts).strip()
        for i in range(down):
            for j in range(right):
                now["grid"].setdefault((now["row"] + i, now["col"] + j), text)
        now["col"] += right
        now["cell"] = None


def parse_html_tables(html: str | None) -> Iterator[tuple[int, int, int, str]]:
    """(table, row, col, text) of each coordinate; rows that only spans reach below the last row do not count."""
    parser = _Tables()
    parser.feed(html or "")
    while parser.open:
        parser.handle_endtag("table")
    for t, grid in enumerate(parser.tables):
        for (r, c), text in sorted(grid.items()):
            yield t, r, c, text


@udtf(returnType="tbl int, row int, col int, text string")
class HtmlGrid:
    """A table function: the cells of all tables in a page."""

    def eval(self, html: str):
        yield from parse_html_tables(html)


def html_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """cells(key, tbl, row, col, text) of the tables in each page; pages without a table cost no Python."""
    spark = pages.sparkSession
    spark.udtf.register("html_grid", HtmlGrid)
    pages.where(F.lower(html).contains("<table")).select(F.col(key).alias("k"), F.col(html).alias("h")).createOrReplaceTempView("_html_pages")
    return spark.sql(f"SELECT k AS {key}, g.tbl, g.row, g.col, g.text FROM _html_pages, LATERAL html_grid(h) g")


def markdown_cells(texts: DataFrame, key: str, text: str) -> DataFrame:
    """cells(key, row, col, text) of the lines that begin with a pipe; lines of dashes between pipes are no rows."""
    lines = texts.select(key, F.posexplode(F.split(text, "\n", -1)).alias("line", "raw")).select(key, "line", T.trim_control("raw").alias("raw"))
    piped = lines.where(F.col("raw").startswith("|") & ~F.col("raw").rlike(r"^[|\s:\-]+$"))
    inner = F.regexp_replace(F.regexp_replace("raw", r"^\|", ""), r"\|$", "")
    nth = F.row_number().over(Window.partitionBy(key).orderBy("line")) - 1
    rows = piped.withColumn("row", nth)
    return rows.select(key, "row", F.posexplode(F.split(inner, r"\|", -1)).alias("col", "c")).select(key, "row", "col", T.trim_control("c").alias("text"))


def plain_markdown(c: Column | str) -> Column:
    """Text without Markdown's marks, and LaTeX underlines and superscripts as their content."""
    text = F.col(c) if isinstance(c, str) else c
    for pattern, new in (
        (r"\$\s*\\underline\{\s*(?:\\text\s*\{)?([^{}]*)\}?\s*\}\s*\$", "$1"), (r"\$\s*\^\{?([^{}$]*)\}?\s*\$", "$1"), (r"(?m)^#{1,6}\s+", ""),
        (r"\*\*([^*]+)\*\*", "$1"), (r"__([^_]+)__", "$1"), (r"`([^`]*)`", "$1"), (r"!\[[^\]]*\]\([^)]*\)", ""), (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    ):
        text = F.regexp_replace(text, pattern, new)
    return T.trim_control(text)


def markdown_table(df: DataFrame, titles: list[str], columns: list[str], limit: int | None = None) -> str:
    """A Markdown table of a report's rows, which are few; limit is a report's own."""
    shown = df.select(*[T.markdown_cell(F.col(c).cast("string")).alias(c) for c in columns])
    rows = (shown.limit(limit) if limit else shown).toLocalIterator()
    head = ["| " + " | ".join(titles) + " |", "|" + " --- |" * len(titles)]
    return "\n".join(head + ["| " + " | ".join(r) + " |" for r in rows])


def item_document(version: str = "1") -> str:
    """The dictionary of items as Markdown."""
    from tidemark.plans.dictionaries import items

    lines = [f"# 항목 사전 (판 {version})", "", "| 코드 | 이름 | 범위 | 유형 | 계열 | 동의어 |", "| --- | --- | --- | --- | --- | --- |"]
    lines += [f"| {i.code} | {i.name} | {i.scope} | {i.value_type} | {i.series or '—'} | {', '.join(i.synonyms) or '—'} |" for i in items()]
    return "\n".join(lines)


def type_document(version: str = "1") -> str:
    from tidemark.plans.dictionaries import types

    lines = [f"# 종류 사전 (판 {version})", "", "| 코드 | 이름 | 상위 | 우선순위 | 규칙 |", "| --- | --- | --- | --- | --- |"]
    lines += [f"| {t.code} | {t.name} | {t.family} | {t.priority} | {' / '.join('+'.join(r) for r in t.rules) or '—'} |" for t in sorted(types(), key=lambda t: (-t.priority, t.code))]
    return "\n".join(lines)


def standard_document(version: str = "1") -> str:
    """The standard of the warehouse as Markdown: domains with their types, and every table's columns."""
    from tidemark.operators import warehouse

    domains = sorted({d for t in warehouse.TABLES for _, d, _ in warehouse.columns(t)})
    lines = [f"# 표준 사전 (판 {version})", "", "## 도메인", "", "| 도메인 | 유형 | 길이 |", "| --- | --- | --- |"]
    lines += [f"| {d} | {warehouse.SQL_TYPES.get(d, 'STRING')} | {warehouse.TEXT_LIMITS.get(d, '—')} |" for d in domains]
    for table in warehouse.TABLES:
        lines += ["", f"## {table}", "", "| 컬럼 | 도메인 | 널 | 키 |", "| --- | --- | --- | --- |"]
        lines += [f"| {n} | {d} | {'Y' if null else 'N'} | {'PK' if n in warehouse.keys(table) else '—'} |" for n, d, null in warehouse.columns(table)]
    return "\n".join(lines)


def extras_report(files: DataFrame, values: DataFrame, top: int = 200) -> str:
    """What labels no item knows, most frequent first, and how many records have each item; values(doc, record, key, mapped, value)."""
    from tidemark.operators import views
    from tidemark.plans.dictionaries import items

    spark = files.sparkSession
    records = values.select("doc", "record").distinct().count()
    unknown = views.unmapped_labels(values.where("NOT mapped").select(F.col("key").alias("label"), "doc", F.col("record").alias("pos"), "value"))
    n = unknown.agg(F.count(F.lit(1)).alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("values")).first()
    codes = [i.code for i in items() if i.scope == "attribute"]
    coverage = views.field_coverage(values, spark.createDataFrame([(c,) for c in codes], "item_cd string"), records)
    by_code = {r["item_cd"]: r for r in coverage.collect()}  # a row for each item, told in the dictionary's order
    lines = ["# 미매핑 항목 검토", "", f"문서 {files.count():,} · 레코드 {records:,} · 미매핑 {n['kinds']:,}종 {n['values']:,}건", "", "## 미매핑 라벨", ""]
    lines += [markdown_table(unknown.orderBy(F.desc("n"), "label"), ["라벨", "건수", "문서", "예"], ["label", "n", "n_docs", "example"], top), "", "## 항목 채움", "", "| 항목 | 건수 | 비율 |", "| --- | --- | --- |"]
    lines += [f"| {c} | {by_code[c]['n']} | {by_code[c]['percent']} |" for c in codes if c in by_code]
    return "\n".join(lines)


def types_report(files: DataFrame, top: int = 200) -> str:
    """How many attachments are of each type, and the titles that no type takes."""
    from tidemark.operators import views
    from tidemark.plans.dictionaries import types

    spark = files.sparkSession
    n = files.agg(F.count("NOTI_KND_CD").alias("told"), F.count(F.when(F.col("NOTI_KND_CD").isNull() & F.col("NOTI_TTL").isNotNull(), 1)).alias("odd"), F.count(F.when(F.col("NOTI_TTL").isNull(), 1)).alias("bare")).first()
    every = spark.createDataFrame([(t.code,) for t in types()], "NOTI_KND_CD string")
    lines = ["# 고시 종류 검토", "", f"분류 {n['told']:,} · 미분류 {n['odd']:,} · 제목 없음 {n['bare']:,}", "", "## 종류별", ""]
    lines += [markdown_table(views.type_distribution(files, every).orderBy(F.desc("n"), "NOTI_KND_CD"), ["종류", "건수"], ["NOTI_KND_CD", "n"]), "", "## 미분류 제목", ""]
    lines += [markdown_table(views.unclassified_titles(files).orderBy(F.desc("n"), "title"), ["제목", "건수", "예"], ["title", "n", "example"], top)]
    return "\n".join(lines)
