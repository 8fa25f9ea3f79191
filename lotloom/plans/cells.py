"""Lots from tables of cells, an array of rows of texts, as column expressions.

Which column says what is told by the header above the lots: its words give columns their roles, wherever they
stand. Nothing is shuffled and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotloom.functions import classify, dates, numbers
from lotloom.functions.bind import let

#: Rows among which the header is looked for, and the least shares of a lot; smaller numbers are counts of something else.
HEADER_ROWS, LEAST_SHARES = 10, 100
#: Parts of words that tell a column's role.
ENDS, SHARES = ("lock", "upto", "date"), ("share", "securit")


def header_end(cells: Column) -> Column:
    """The place of the last header row: the first of the topmost rows with one cell ``from`` and one ``to``, else the first row."""
    low = lambda row: F.transform(row, lambda c: F.lower(F.coalesce(c, F.lit(""))))
    marked = F.transform(F.slice(cells, 1, HEADER_ROWS), lambda row: let(low(row), lambda r: F.array_contains(r, "from") & F.array_contains(r, "to")))
    return F.greatest(F.array_position(F.transform(marked, lambda m: F.coalesce(m, F.lit(False))), True) - 1, F.lit(0)).cast("int")


def _headers(cells: Column, end: Column) -> Column:
    """The text above each column, lower case."""
    top = F.slice(cells, F.lit(1), end + 1)
    width = F.coalesce(F.array_max(F.transform(cells, lambda row: F.size(row))), F.lit(0))
    above = lambda i: F.lower(F.concat_ws(" ", F.transform(top, lambda row: F.nullif(F.get(row, i), F.lit("")))))
    return F.transform(F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>")), above)


def roles(cells: Column) -> Column:
    """Where lots begin and what columns they have: first (row), shares (the last column that says so, else the first one), ends (the first, else null)."""
    def of(end: Column) -> Column:
        def found(headers: Column) -> Column:
            places = lambda words: F.filter(F.sequence(F.lit(0), F.size(headers) - 1), lambda i: F.exists(F.array(*map(F.lit, words)), lambda w: F.get(headers, i).contains(w)))
            shares, ends = places(SHARES), places(ENDS)
            some = F.size(headers) > 0
            return F.struct((end + 1).alias("first"), F.coalesce(F.when(some, F.array_max(shares)), F.lit(0)).alias("shares"), F.when(some, F.array_min(ends)).alias("ends"))

        return let(_headers(cells, end), found)

    return let(header_end(cells), of)


def lots(cells: Column) -> Column:
    """The lots below the header, in order: shares, lockin_date (null where it means free), is_free, row_class.

    Empty rows and rows without at least LEAST_SHARES shares are left out; short rows have empty cells. A null or
    empty table has no lots.
    """
    kind = "array<struct<shares:bigint,lockin_date:string,is_free:boolean,row_class:string>>"

    def of(r: Column) -> Column:
        def lot(row: Column) -> Column:
            day = F.when(r["ends"].isNotNull(), F.trim(F.coalesce(F.get(row, r["ends"]), F.lit("")))).otherwise("")

            def made(d: Column) -> Column:
                free = dates.is_free_date(d)
                return F.struct(numbers.clean_number(F.coalesce(F.get(row, r["shares"]), F.lit(""))).alias("shares"), F.when(~free, d).alias("lockin_date"), free.alias("is_free"), classify.row_class(F.lit(""), d).alias("row_class"))

            return let(day, made)

        below = F.filter(F.slice(cells, r["first"] + 1, F.greatest(F.size(cells) - r["first"], F.lit(0))), lambda row: F.exists(row, lambda c: F.coalesce(c, F.lit("")) != ""))
        return F.filter(F.transform(below, lot), lambda x: F.coalesce(x["shares"] >= LEAST_SHARES, F.lit(False)))

    return F.coalesce(F.when(F.size(cells) > 0, let(roles(cells), of)), F.array()).cast(kind)
