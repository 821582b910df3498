"""Header rows of a grid: which rows belong to the header, and the merged column names. All column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

#: Fixed values.
HEADER_JOIN, MAX_HEADER_ROWS, MAX_HEADER_CELL = " | ", 3, 60
#: Tokens of a period in a header cell: a date, month and year, quarter or month, year.
PERIOD_TOKEN = "\\d{1,2}\\s*[/\\-.]\\s*\\d{1,2}\\s*[/\\-.]\\s*\\d{2,4}|\\d{1,2}\\s*[/\\-.]\\s*(?:19|20)\\d{2}|[QT]\\s*\\d|(?:19|20)\\d{2}"
#: A cell that holds a unit and nothing else.
UNIT_CELL = "(?iU)^(?:đơn\\s*vị\\s*(?:tính)?\\s*[:\\-]?\\s*)?(?:(?:nghìn\\s+tỷ|nghìn|triệu|tỷ)\\s*)?(?:vnd|đồng|vn\\s*đ|usd|eur|jpy|%)$"

#: Words of a search document: the search sees them, so they change its results.
COMPANY, CODE_INSIDE, CODE_ALONE, AND_YEAR, AND_SCOPE, AND_REPORT = "Công ty: ", " (mã ", "Mã: ", ", năm ", ", phạm vi ", ", báo cáo "
BEFORE, NAMES, LABELS = " Ngữ cảnh: ", " Cột: ", ". Dòng: "

_EMPTY = "array<string>"


def duplicate_positions(header: Column) -> Column:
    """0-based positions of non-empty names that occur more than once."""
    numbered = F.transform(header, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.transform(F.filter(numbered, lambda c: (c["h"] != "") & (F.size(F.filter(header, lambda o: o == c["h"])) > 1)), lambda c: c["i"])


def looks_numeric(cell: Column) -> Column:
    """A digit is left once period tokens are out."""
    return F.regexp_replace(cell, f"(?U){PERIOD_TOKEN}", " ").rlike("(?U)\\d")


def is_unit_row(row: Column) -> Column:
    cells = F.filter(F.transform(row, strip), lambda c: c != "")
    return (F.size(cells) >= 2) & F.forall(cells, lambda c: c.rlike(UNIT_CELL))


def continues_header(header: Column, row: Column) -> Column:
    """The row is one more tier of the header rather than the first row of data."""
    plain = (F.size(row) > 0) & F.exists(row, lambda c: strip(c) != "") & ~F.exists(row, looks_numeric) & ~F.exists(row, lambda c: F.length(c) > MAX_HEADER_CELL)
    doubles = duplicate_positions(header)
    below = F.transform(doubles, lambda i: F.coalesce(F.get(row, i), F.lit("")))
    tells_apart = (F.size(doubles) > 0) & F.forall(below, lambda c: strip(c) != "") & (F.size(F.array_distinct(below)) >= 2)
    return F.coalesce(plain & (is_unit_row(row) | tells_apart), F.lit(False))


def merge_header(header: Column, row: Column) -> Column:
    """Names of both tiers joined; a part that the name has already isn't repeated."""

    def merged(top: Column, sub: Column) -> Column:
        top, sub = strip(F.coalesce(top, F.lit(""))), strip(F.coalesce(sub, F.lit("")))
        known = (sub == "") | (sub == top) | F.array_contains(F.split(top, " \\| "), sub)
        return F.when(known, top).when(top == "", sub).otherwise(F.concat(top, F.lit(HEADER_JOIN), sub))

    return F.zip_with(header, row, merged)


def split_header(tables: DataFrame, grid: str = "grid") -> DataFrame:
    """Adds header and rows: two further tiers at most, and one row of data is always left if the grid has two.

    An empty grid has neither.
    """
    g = F.col(grid)
    none = F.array().cast(_EMPTY)
    start = F.struct(F.coalesce(F.get(g, F.lit(0)), none).alias("header"), F.lit(1).alias("tiers"))

    def tier(acc: Column, k: Column) -> Column:
        row = F.coalesce(F.get(g, k), none)
        joins = (acc["tiers"] == k) & (F.size(g) - 1 > k) & continues_header(acc["header"], row)
        return F.when(joins, F.struct(merge_header(acc["header"], row).alias("header"), (acc["tiers"] + 1).alias("tiers"))).otherwise(acc)

    out = tables.withColumn("_split", F.aggregate(F.sequence(F.lit(1), F.lit(MAX_HEADER_ROWS - 1)), start, tier))
    tiers = F.col("_split.tiers")
    rest = F.when(F.size(g) > 0, F.slice(g, tiers + 1, F.greatest(F.size(g) - tiers, F.lit(0)))).otherwise(F.array().cast("array<array<string>>"))
    return out.withColumn("header", F.col("_split.header")).withColumn("rows", rest).drop("_split")


def n_rows(header: Column, rows: Column) -> Column:
    return F.size(rows) + (F.size(header) > 0).cast("int")


def n_cols(header: Column, rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(F.concat(F.array(header), rows), F.size)), F.lit(0))


def digits_only(cell: Column) -> Column:
    """Eligibility's test: a digit, and nothing but digits, dots, commas, minus signs and spaces once parentheses and % at the ends are off."""
    body = F.regexp_replace(strip(cell), "^[()%]+|[()%]+$", "")
    return body.rlike("(?U)\\d") & body.rlike("(?U)^[\\d.,\\- ]+$")


def label_numeric(cell: Column) -> Column:
    """The index text's test: like digits_only, but no digit is needed, so a dash counts as a number."""
    return F.regexp_replace(strip(cell), "^[()%]+|[()%]+$", "").rlike("(?U)^[\\d.,\\-  ]+$")


def eligible(grid: Column, min_cells: int = 4, require_numeric: bool = True) -> Column:
    """Enough non-empty cells, and a number among them if one is required."""
    cells = F.filter(F.flatten(grid), lambda c: strip(c) != "")
    enough = F.size(cells) >= min_cells
    return enough & F.exists(cells, digits_only) if require_numeric else enough


def csv_field(cell: Column) -> Column:
    """A field quoted only where it must be."""
    return F.when(cell.rlike("[\",\\r\\n]"), F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(cell)


def to_csv(rows: Column) -> Column:
    """CSV text of rows of cells, LF after each; a row of one empty cell is written as a quoted empty field."""
    line = lambda r: F.when((F.size(r) == 1) & (F.get(r, F.lit(0)) == ""), F.lit('""')).otherwise(F.array_join(F.transform(r, csv_field), ","))
    return F.concat(F.array_join(F.transform(rows, line), "\n"), F.when(F.size(rows) > 0, F.lit("\n")).otherwise(F.lit("")))


def cut_csv(text: Column, max_chars: int | None) -> Column:
    """CSV text of at most max_chars characters, cut after a whole row where there is one, with a last LF."""
    if max_chars is None:
        return text
    head = F.left(text, F.lit(max_chars))
    return F.when(F.length(text) > max_chars, F.concat(F.when(F.instr(head, "\n") > 1, F.regexp_replace(head, "\n[^\n]*\\z", "")).otherwise(head), F.lit("\n"))).otherwise(text)


def table_csv(header: Column, rows: Column, max_chars: int | None = None) -> Column:
    """Header, if there is one, and rows as CSV."""
    every = F.when(F.size(header) > 0, F.concat(F.array(header), rows)).otherwise(rows)
    return cut_csv(to_csv(every), max_chars)


def index_text(company: Column, max_chars: int = 1200) -> Column:
    """What the search reads of a table (columns ticker, year, scope, doc_name, context_before, header, rows)."""
    who = F.when(F.coalesce(company, F.lit("")) != "", F.concat(F.lit(COMPANY), company, F.lit(CODE_INSIDE), F.col("ticker"), F.lit(")"))).otherwise(F.concat(F.lit(CODE_ALONE), F.col("ticker")))
    scope = F.when(F.coalesce(F.col("scope"), F.lit("")) != "", F.concat(F.lit(AND_SCOPE), F.col("scope"))).otherwise(F.lit(""))
    head = F.concat(who, F.lit(AND_YEAR), F.coalesce(F.col("year").cast("string"), F.lit("None")), scope, F.lit(AND_REPORT), F.col("doc_name"), F.lit("."))
    names = F.array_join(F.filter("header", lambda h: h != ""), " | ")
    words = F.transform(F.slice("rows", 1, 40), lambda r: F.array_join(F.filter(F.slice(r, 1, 3), lambda c: (c != "") & ~label_numeric(c)), " / "))
    labels = F.array_join(F.filter(words, lambda w: w != ""), " | ")
    body = F.concat(F.lit(BEFORE), F.col("context_before"), F.lit(NAMES), names, F.lit(LABELS), labels)
    return F.left(F.concat(head, body), F.lit(max_chars))


def index_entries(tables: DataFrame, companies: DataFrame | None = None, company_rows: int = 1_000_000) -> DataFrame:
    """Search documents of tables that have header and rows; names come from companies (ticker, name) by a left join.

    companies is broadcast if it has company_rows rows at most.
    """
    if companies is not None:
        names = companies.select("ticker", F.col("name").alias("_company"))
        small = names.limit(company_rows + 1).count() <= company_rows
        tables = tables.join(F.broadcast(names) if small else names, "ticker", "left")
    else:
        tables = tables.withColumn("_company", F.lit(""))
    header, rows = F.col("header"), F.col("rows")
    return tables.select(
        "table_ref", "doc_name", "ticker", "year", "scope", "line", "order", "page", n_rows(header, rows).alias("n_rows"), n_cols(header, rows).alias("n_cols"),
        index_text(F.coalesce("_company", F.lit(""))).alias("index_text"),
    )


def cells(tables: DataFrame, keys: tuple[str, ...] = ("table_ref",)) -> DataFrame:
    """Long form: keys, row, col (0-based), col_name, value. Cells beyond the header have an empty name."""
    rows = tables.select(*keys, "header", F.posexplode("rows").alias("row", "_row"))
    flat = rows.select(*keys, "header", "row", F.posexplode("_row").alias("col", "value"))
    return flat.select(*keys, "row", "col", F.coalesce(F.get("header", F.col("col")), F.lit("")).alias("col_name"), "value")

