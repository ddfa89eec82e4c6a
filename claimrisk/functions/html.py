"""Typed elements of HTML pages and cells of their tables, as column expressions and windows.

A page is cut into tags and texts by one regular expression that never runs twice over the same
text.  A fold over the few tags that make one element of all inside (navigation, tables) finds
their ranges; running sums tell what is silent and which element a token belongs to.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: element types by tag ----------------------------------------------------
KINDS = {
    "h1": "title", "h2": "section_header", "h3": "section_header", "h4": "section_header",
    "h5": "section_header", "h6": "section_header", "p": "text", "li": "text",
    "div": "text", "blockquote": "text", "pre": "text", "td": "text", "th": "text",
    "nav": "page_header", "header": "page_header", "footer": "page_footer", "table": "table",
}
WHOLE = {"nav", "header", "footer", "table"}   # one element with everything inside
SILENT = {"script", "style", "head", "noscript", "template"}
CELLS = {"tr", "td", "th"}   # kept as markup inside a table

# A comment, a script or style with its content, a declaration, a tag, text, a stray bracket.
# What is not closed goes to the end of the page, or to the next bracket for a tag.
TOKEN = (
    r"(?s)<!--.*?(?:-->|\z)"
    r"|(?i:<script\b[^<>]*+>.*?(?:</script\s*+>|\z))"
    r"|(?i:<style\b[^<>]*+>.*?(?:</style\s*+>|\z))"
    r"|<[!?][^<>]*+>"
    r"|</?[a-zA-Z](?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+>"
    r"|</?[a-zA-Z][^<>]*+>"
    r"|[^<]++|<")
ENTITY = r"&#[0-9]++;?|&#[xX][0-9a-fA-F]++;?|&[A-Za-z][A-Za-z0-9]*+;?|[^&]++|&"
FREQUENT = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " "}


def _one_of(column: Column, names) -> Column:
    return column.isin(*sorted(names))


def _fields(token: Column) -> tuple[Column, Column]:
    """Name of a tag (empty for other tokens), and whether it is an end tag."""
    return F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^\s/>]*)", 1)), token.startswith("</")


def unescaped(text: Column) -> Column:
    """Character references decoded: by number, and the names of HTML 5."""
    names = F.create_map(*[F.lit(x) for name, value in sorted(html5.items())
                           for x in (f"&{name}", value)])

    def one(piece: Column) -> Column:
        decimal = F.regexp_extract(piece, r"^&#([0-9]{1,7});?$", 1)
        hexadecimal = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]{1,6});?$", 1)
        number = F.when(decimal != "", decimal.cast("int")).when(
            hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("int"))
        out = F.when(~piece.startswith("&"), piece)
        for name, value in FREQUENT.items():
            out = out.when(piece == name, F.lit(value))
        wide = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return out.when(known, wide).when(
            piece.startswith("&#"), piece).otherwise(F.coalesce(F.try_element_at(names, piece), piece))

    pieces = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def _whole_ranges(tokens: Column) -> Column:
    """Ranges of tokens (first, last, tag) that make one element, in order.

    The tag that opens first decides; the range ends where as many of its kind are closed.
    """
    def event(token, at):
        name, closes = _fields(token)
        return F.named_struct(F.lit("at"), at, F.lit("tag"), name, F.lit("closes"), closes)

    events = F.filter(F.transform(tokens, event), lambda e: _one_of(e.tag, WHOLE))
    start = F.named_struct(
        F.lit("tag"), F.lit(None).cast("string"), F.lit("depth"), F.lit(0), F.lit("first"), F.lit(0),
        F.lit("ranges"), F.array().cast("array<struct<first:int,last:int,tag:string>>"))

    def state(tag, depth, first, ranges):
        return F.named_struct(F.lit("tag"), tag, F.lit("depth"), depth, F.lit("first"), first,
                              F.lit("ranges"), ranges)

    def step(s, e):
        nothing = F.lit(None).cast("string")
        ended = F.array_append(s.ranges, F.named_struct(
            F.lit("first"), s["first"], F.lit("last"), e["at"], F.lit("tag"), s["tag"]))
        return (
            F.when(s.tag.isNull() & ~e.closes, state(e.tag, F.lit(1), e["at"], s.ranges))
            .when(s.tag.isNull() | (s.tag != e.tag), s)
            .when(~e.closes, state(s.tag, s.depth + 1, s["first"], s.ranges))
            .when(s.depth > 1, state(s.tag, s.depth - 1, s["first"], s.ranges))
            .otherwise(state(nothing, F.lit(0), F.lit(0), ended)))

    def finish(s):  # what is still open goes to the end
        return F.when(s.tag.isNull(), s.ranges).otherwise(F.array_append(s.ranges, F.named_struct(
            F.lit("first"), s["first"], F.lit("last"), F.lit(2 ** 31 - 1), F.lit("tag"), s["tag"])))

    return F.aggregate(events, start, step, finish)


def _spans(token: Column) -> Column:
    """colspan and rowspan of a cell's tag, as they are kept in the markup of a table."""
    out = []
    for name in ("colspan", "rowspan"):
        number = F.regexp_extract(token, rf"(?i)\s{name}\s*=\s*[\"']?([0-9]+)", 1)
        out.append(F.when(number != "", F.concat(F.lit(f" {name}="), number)).otherwise(F.lit("")))
    return F.concat(*out)


def element_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per element: page, position, type and content.

    Rows that repeat a page are cut each for itself; a null page has no elements.
    """
    tokens = F.regexp_extract_all(F.col(html), F.lit(TOKEN), F.lit(0))
    # the ranges are found below the explode, so that no row carries all tokens of its page
    cut = pages.select(key, F.monotonically_increasing_id().alias("_page"), tokens.alias("_tokens")).withColumn(
        "_ranges", _whole_ranges(F.col("_tokens"))).select(
        key, "_page", "_ranges", F.posexplode("_tokens").alias("at", "token"))
    name, closes = _fields(F.col("token"))
    inside = F.get(F.filter("_ranges", lambda r: F.col("at").between(r["first"], r["last"])), F.lit(0))
    skipped = F.col("token").rlike(r"^(?:<[!?]|(?i:<script\b|<style\b))")
    rows = cut.select(
        key, "_page", "at", "token", F.when(skipped, "").otherwise(name).alias("tag"), closes.alias("closes"),
        inside.alias("whole"), skipped.alias("skipped"))
    c = F.col
    silent = F.when(_one_of(c("tag"), SILENT), F.when(c("closes"), -1).otherwise(1)).otherwise(0)
    along = Window.partitionBy("_page").orderBy("at")
    edge = c("whole").isNotNull() & ((c("at") == c("whole")["first"]) | (c("at") == c("whole")["last"]))
    starts = edge | (c("whole").isNull() & _one_of(c("tag"), KINDS))
    rows = rows.withColumn("depth", F.sum(silent).over(along)).withColumn(
        # end tags of nothing do not count: the sum never falls below zero
        "silent", c("depth") - F.least(F.lit(0), F.min("depth").over(along))).withColumn(
        "element", F.sum(starts.cast("int")).over(along))
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    kind = F.when(starts & ~c("closes"), F.try_element_at(kinds, c("tag"))).otherwise("text")
    cell = (c("whole")["tag"] == "table") & _one_of(c("tag"), CELLS)
    piece = (
        F.when((c("tag") == "") & ~c("skipped"), F.when(c("silent") == 0, unescaped(c("token"))))
        .when(c("skipped") | _one_of(c("tag"), SILENT) | edge, F.lit(None))
        .when(cell, F.concat(F.when(c("closes"), "</").otherwise("<"), "tag",
                             F.when(c("closes"), "").otherwise(_spans(c("token"))), F.lit(">")))
        .when(c("whole").isNotNull() & ~c("closes"), " ")
        .when((c("tag") == "br") & ~c("closes"), " "))
    made = rows.select(key, "_page", "element", "at", kind.alias("kind"), piece.alias("piece")).groupBy(
        "_page", "element").agg(
        F.first(key).alias(key), F.min_by("kind", "at").alias("type"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p.piece), "")
        .alias("content"))
    made = made.withColumn("content", F.trim(F.regexp_replace("content", r"(?U)\s+", " "))).where("content <> ''")
    order = Window.partitionBy("_page").orderBy("element")
    return made.select(key, (F.row_number().over(order) - 1).alias("position"), "type", "content")


def table_grid(content: Column) -> Column:
    """Rows of a table's markup as arrays of cell texts, cells of several rows or columns repeated.

    A fold over the rows carries the cells that reach further down; within a row a cell takes the
    first columns that are free.
    """
    def attribute(tag, name):
        return F.greatest(F.lit(1), F.coalesce(
            F.regexp_extract(tag, rf"{name}=([0-9]{{1,4}})", 1).try_cast("int"), F.lit(1)))

    def cells(row):
        return F.transform(
            F.regexp_extract_all(row, F.lit(r"(?s)<t[dh][^<>]*>(?:.*?)</t[dh]>"), F.lit(0)),
            lambda cell: F.named_struct(
                F.lit("value"), F.trim(F.regexp_extract(cell, r"(?s)^<t[dh][^<>]*>(.*)</t[dh]>$", 1)),
                F.lit("wide"), attribute(F.regexp_extract(cell, r"^<[^>]*>", 0), "colspan"),
                F.lit("high"), attribute(F.regexp_extract(cell, r"^<[^>]*>", 0), "rowspan")))

    rows = F.transform(F.regexp_extract_all(content, F.lit(r"(?s)<tr>(.*?)</tr>"), F.lit(1)), cells)
    placed = "array<struct<col:int,left:int,value:string>>"
    empty = F.array().cast(placed)

    def place(taken):
        """Puts one cell after those of its row, beside what reaches down from rows above."""
        def step(s, cell):
            first = F.get(F.filter(
                F.sequence(s["next"], s["next"] + F.size(taken)),
                lambda col: ~F.exists(taken, lambda t: t["col"] == col)), F.lit(0))
            own = F.transform(F.sequence(first, first + cell["wide"] - 1), lambda col: F.named_struct(
                F.lit("col"), col, F.lit("left"), cell["high"], F.lit("value"), cell["value"]))
            return F.named_struct(F.lit("next"), first + cell["wide"], F.lit("cells"), F.concat(s["cells"], own))
        return step

    def row_step(s, row):
        start = F.named_struct(F.lit("next"), F.lit(0), F.lit("cells"), empty)
        own = F.aggregate(row, start, place(s["down"]), lambda x: x["cells"])
        everything = F.array_sort(F.concat(s["down"], own))
        return F.named_struct(
            F.lit("down"), F.transform(F.filter(everything, lambda x: x["left"] > 1), lambda x: F.named_struct(
                F.lit("col"), x["col"], F.lit("left"), x["left"] - 1, F.lit("value"), x["value"])),
            F.lit("grid"), F.array_append(s["grid"], F.transform(everything, lambda x: x["value"])))

    start = F.named_struct(F.lit("down"), empty, F.lit("grid"), F.array().cast("array<array<string>>"))
    return F.aggregate(rows, start, row_step, lambda s: s["grid"])


def table_cells(tables: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """One row per body cell: row number, row label (first cell), column label, value.

    Works on the markup the table elements keep, so a value stays with its row and column.
    """
    listed = tables.select(*keys, table_grid(F.col(content)).alias("rows")).filter(F.size("rows") > 1)
    body = listed.select(
        *keys, F.col("rows")[0].alias("labels"),
        F.posexplode(F.slice("rows", 2, F.size("rows") - 1)).alias("row", "values"))
    return body.select(
        *keys, "row", F.get("values", F.lit(0)).alias("row_label"), "labels",
        F.posexplode("values").alias("col", "value"),
    ).select(
        *keys, "row", "col", "row_label", F.get("labels", F.col("col")).alias("column_label"), "value")
