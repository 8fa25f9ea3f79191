"""From the text of a shareholding pattern to promoter, public, other, total and locked shares.

As with lock-in annexures a document is one row, its lines are an array, and every strategy
is a column expression that gives one struct, or null where it fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotloom.functions import numbers, text
from lotloom.functions.bind import built_once, let

# Labels of the three categories, lower case without spaces and hyphens.
PROMOTER = ("totalshareholdingofpromoters", "totalshareholdingofpromoter", "totalshareholding", "(a)promoter&promotergroup", "(a)promotergroup")
PUBLIC = ("totalpublicshareholding", "totalpublic", "(b)public")
OTHER = ("totalnonpromoter", "(c)nonpromoternonpublic", "(c)nonpromoternonepublic", "(c)nonpublic", "(c)nonpromoter")
#: Words of header lines, lines that may be missed before a table ends, rows of a table at most.
HEADER_WORDS, MOST_MISSES, MOST_ROWS = ("shareholding", "equity", "no."), 3, 10

@dataclass(frozen=True)
class Inputs:
    """The document in lower case, its lines and their numbers, those of the label lines, and totals known beforehand (null if not)."""

    whole: Column
    low: Column  # array of lines
    nums: Column  # array of arrays of numbers, one for each line
    promoter: Column  # numbers of the label lines, null where there is none
    public: Column
    other: Column
    total: Column  # the grand total's (line, nums), null if there is none
    total_hint: Column
    locked_hint: Column
    computed_hint: Column


def _result(promoter: Column, public: Column, other: Column, total: Column, locked: Column, found: Column, strategy: str) -> Column:
    values = ((promoter, "promoter_shares"), (public, "public_shares"), (other, "other_shares"), (total, "total_shares"), (locked, "locked_shares"))
    return F.struct(*(v.cast("bigint").alias(n) for v, n in values), found.cast("boolean").alias("all_found"), F.lit(strategy).alias("strategy"))


def labelled(bare: Column, labels: tuple[str, ...]) -> Column:
    """Where the first of the labels stands in a text without spaces and hyphens, null if none does."""
    return F.least(*(F.nullif(F.instr(bare, label), F.lit(0)) for label in labels))


def line_of(bare: Column, at: Column) -> Column:
    """Number of the line, from 0, that holds the character at a place from 1."""
    return F.size(F.split(F.substring(bare, F.lit(1), at - 1), "\n", -1)) - 1


def matched_label(line: Column, labels: tuple[str, ...]) -> Column:
    """The label that a line bears, in the order of precedence."""
    return F.coalesce(*(F.when(text.pattern_text(line).contains(label), label) for label in labels))


def _first(tests: Column) -> Column:
    """Place (from 1) of the first that holds; 0 if none."""
    return F.coalesce(F.array_position(tests, True), F.lit(0)).cast("int")


def grand_total(whole: Column, low: Column, nums: Column) -> Column:
    """Place (from 1) of the first line that starts with total, isn't a category's and has two numbers; 0 or null if none."""
    def is_total(l: Column, n: Column) -> Column:
        return (F.size(n) >= 2) & l.rlike(r"^total\b") & ~l.contains("shareholding of promoters") & ~l.contains("public shareholding")

    return F.when(whole.contains("total"), _first(F.zip_with(low, nums, is_total)))


def _at(nums: Column, value: Column) -> Column:
    """Place of a value from 0, null if it is not there."""
    return F.nullif(F.array_position(nums, value), F.lit(0).cast("bigint")).cast("int") - 1


def _hinted_locked(x: Inputs, nums: Column) -> Column:
    return F.when((x.locked_hint != 0) & F.array_contains(nums, x.locked_hint), x.locked_hint)


def spatial(x: Inputs) -> Column:
    """All three categories at the place that the known total has in a total line set in columns."""
    def of(i: Column) -> Column:
        a, b, c = (F.get(v, i) for v in (x.promoter, x.public, x.other))
        return F.when(a + b + c == x.total_hint, _result(a, b, c, x.total_hint, _hinted_locked(x, x.total["nums"]), F.lit(True), "spatial_columns"))

    return F.when(x.total["line"].contains("  ") & (x.total_hint != 0), let(_at(x.total["nums"], x.total_hint), of))


def _total_row(x: Inputs, hint: Column, with_word: bool = False, with_locked: bool = True) -> Column:
    """Place (from 1) of the first line that holds the total (and the locked shares, if known); 0 if none."""
    def holds(n: Column) -> Column:
        ok = F.array_contains(n, hint)
        return F.coalesce(ok & (x.locked_hint.isNull() | F.array_contains(n, x.locked_hint)) if with_locked else ok, F.lit(False))

    if not with_word:
        return _first(F.transform(x.nums, holds))
    return F.when(x.whole.contains("total"), _first(F.zip_with(x.low, x.nums, lambda l, n: l.contains("total") & holds(n)))).otherwise(0)


def _above(lines: Column, at: Column) -> Column:
    """Lines above the one at place ``at`` (from 1)."""
    return F.slice(lines, F.lit(1), F.greatest(at - 1, F.lit(0)))


def _data_above(x: Inputs, at: Column) -> Column:
    """Numbers of the data lines above the total line."""
    def data(l: Column, n: Column) -> Column:
        ok = F.size(n) >= 2
        for w in HEADER_WORDS:
            ok = ok & ~l.contains(w)
        return F.when(ok, n)

    return F.when(at > 0, F.array_compact(F.zip_with(_above(x.low, at), _above(x.nums, at), data)))


def position_from_total(x: Inputs, lines: Column, i: Column) -> Column:
    """First, second and last data line above the total line, at the total's place; the sum must be exact."""
    a, b = F.get(F.get(lines, F.lit(0)), i), F.get(F.get(lines, F.lit(1)), i)
    c = F.when(F.size(lines) == 2, F.lit(0).cast("bigint")).otherwise(F.get(F.try_element_at(lines, F.lit(-1)), i))
    return F.when((F.size(lines) >= 2) & (a + b + c == x.total_hint), _result(a, b, c, x.total_hint, x.locked_hint, F.lit(None), "position_based"))


def total_columns(nums: Column, hint: Column) -> Column:
    """Places of the shares and the locked shares in a total line, and the total.

    Shares: the hint's place, else the largest number's. Locked: of later numbers from 1000 to
    below the total, the largest, rather one of at least half the total.
    """
    def of(i: Column) -> Column:
        total = F.get(nums, i)
        later = F.filter(F.transform(F.sequence(F.lit(0), F.size(nums) - 1), lambda j: F.struct(F.get(nums, j).alias("value"), (-j).alias("j"))), lambda p: (-p["j"] > i) & (p["value"] >= 1000) & (p["value"] < total))
        best = lambda ps: F.array_max(ps)  # noqa: E731  the largest value, the earliest of equals
        chosen = let(later, lambda ps: F.coalesce(best(F.filter(ps, lambda p: 2 * p["value"] >= total)), best(ps)))
        return F.struct(i.alias("share"), total.alias("total"), chosen["value"].alias("locked"))

    return F.when(F.size(nums) > 0, let(F.coalesce(_at(nums, hint), _at(nums, F.array_max(nums))), of))


def sequential(x: Inputs, c: Column) -> Column:
    """Label lines at the total line's column of shares (``total_columns``); what it finds, complete or not."""
    total = F.coalesce(c["total"], x.total_hint)
    pick = lambda v: F.when(total.isNull() | (F.get(v, c["share"]) <= total), F.get(v, c["share"]))
    a, b, o = pick(x.promoter), pick(x.public), pick(x.other)
    return _result(a, b, o, total, c["locked"], a.isNotNull() & b.isNotNull() & o.isNotNull(), "sequential")


def _complete(r: Column, x: Inputs) -> Column:
    """Whether the sequential result is whole and its sum is both the hint and its own total."""
    total = r["promoter_shares"] + r["public_shares"] + r["other_shares"]
    return F.coalesce(r["all_found"] & (r["total_shares"] != 0) & (total == x.total_hint) & (total == r["total_shares"]), F.lit(False))


def _as_long(x: Inputs, at: Column, least: Column) -> Column:
    """Numbers of the lines above that have at least so many, null for others; blank lines never count."""
    lines = _above(x.nums, at)
    any_ = F.zip_with(_above(x.low, at), lines, lambda l, n: F.when((l != "") & (F.size(n) >= least), n))
    return F.when(least > 0, F.transform(lines, lambda n: F.when(F.size(n) >= least, n))).otherwise(any_)


def _last(data: Column) -> Column:
    return F.slice(data, F.greatest(F.size(data) - MOST_ROWS + 1, F.lit(1)), F.lit(MOST_ROWS))


def _upward(lines: Column, data: Column) -> Column:
    """Data (``data``: those of ``lines`` that are) going up, until too many lines in a row aren't any; top first."""
    marks = F.array_join(F.transform(F.reverse(lines), lambda n: F.when(n.isNull(), "0").otherwise("1")), "")
    live = F.length(F.substring_index(marks, "0" * MOST_MISSES, 1))
    near = F.array_compact(F.slice(lines, F.size(lines) - live + 1, live))
    return _last(F.when(F.size(lines) - F.size(data) < MOST_MISSES, data).otherwise(near))


def _by_place(x: Inputs, v: Column, total_nums: Column, i: Column, hint: Column, name: str, strict: bool = False) -> Column:
    """Values of the first three number arrays at the total's place ``i``; the sum must be exact."""
    a, b = F.get(F.get(v, F.lit(0)), i), F.get(F.get(v, F.lit(1)), i)
    c = F.when(F.size(v) >= 3, F.get(F.get(v, F.lit(2)), i)).otherwise(F.lit(0).cast("bigint"))
    ok = (F.size(v) >= 2) & (a + b + F.coalesce(c, F.lit(0)) == hint)
    locked = F.when(F.array_contains(total_nums, x.locked_hint), x.locked_hint) if strict else _hinted_locked(x, total_nums)
    found = F.lit(True) if strict else c.isNotNull() & locked.isNotNull()
    return F.when(ok & (a != 0) & (b != 0) if strict else ok, _result(a, b, c, hint, locked, found, name))


def _like_shares(x: Inputs, at: Column) -> Column:
    """Numbers of the lines above with a number above 10,000, or all at most 100, null for others."""
    return F.transform(_above(x.nums, at), lambda n: F.when((F.size(n) >= 3) & ((F.array_max(n) > 10_000) | (F.array_max(n) <= 100)), n))


def _last_of_window(x: Inputs, at: Column) -> Column:
    """Numbers of the lines with three of them within twenty lines above the total line."""
    window = F.slice(x.nums, F.greatest(at - 19, F.lit(2)), F.greatest(F.least(at - 2, F.lit(19)), F.lit(0)))
    return F.filter(window, lambda n: F.size(n) >= 3)


@built_once
def _steps(name: str, first: str, second: str, live: str | None) -> tuple[dict[str, Column], ...]:
    """The cascade as columns, each step on those before it, so that only what looks at single lines is a lambda, and only where
    nothing was found. ``first`` and ``second`` name the known totals; rows without ``live`` have null.

    The order: spatial columns, position from the total, the sequential result if it is complete, then up from the line of a known
    total while lines look like shares, while they have nearly as many numbers as it, the last ones with three numbers; the sequential result is also what is left at the end.
    """
    c = F.col
    x = Inputs(*map(F.col, ("_whole", "_low", "_nums", "_a", "_b", "_c", "_t", first, "known_locked", second)))
    one, none = c(name), c(name).isNull() if live is None else c(name).isNull() & c(live)
    wanted = lambda v: v if live is None else F.when(c(live), v)
    hint = F.coalesce(F.nullif(x.total_hint, F.lit(0)), x.computed_hint)
    place = lambda h, **how: F.when(none & (h != 0), _total_row(x, h, **how))
    own, tried = F.when(c("_at") > 0, F.get(x.nums, c("_at") - 1)), none & (c("_at") > 0)
    by_place = lambda lines, h, strategy, **how: F.coalesce(one, F.when(c("_at") > 0, _by_place(x, lines, c("_own"), c("_i"), h, strategy, **how)))
    upward = F.when(tried, _upward(c("_lines"), c("_data")))
    return (
        {name: wanted(spatial(x)), "_k": wanted(total_columns(x.total["nums"], x.total_hint))},
        {"_q": wanted(sequential(x, c("_k"))), "_at": place(x.total_hint, with_word=True)},
        {"_data": _data_above(x, c("_at")), "_i": _at(own, x.total_hint)},
        {name: F.coalesce(one, F.when(c("_at") > 0, position_from_total(x, c("_data"), c("_i"))), F.when(_complete(c("_q"), x), c("_q")))},
        {"_at": place(x.total_hint, with_locked=False)},
        {"_at": F.when(c("_at") > 0, c("_at")).otherwise(place(x.computed_hint, with_locked=False)), "_h": F.when(c("_at") > 0, x.total_hint).otherwise(x.computed_hint)},
        {"_own": own, "_lines": F.when(tried, _like_shares(x, c("_at")))},
        {"_i": _at(c("_own"), c("_h")), "_data": F.array_compact("_lines")},
        {"_data": upward},
        {name: by_place(c("_data"), c("_h"), "boundary_detection")},
        {"_at": place(hint)},
        {"_own": own},
        {"_i": _at(c("_own"), hint), "_n": F.size("_own") - 5},
        {"_lines": F.when(tried, _as_long(x, c("_at"), c("_n")))},
        {"_data": F.array_compact("_lines")},
        {"_data": upward},
        {name: by_place(c("_data"), hint, "column_count_validation")},
        {"_data": F.when(tried, _last_of_window(x, c("_at")))},
        {"_data": _last(c("_data"))},
        {name: F.coalesce(by_place(c("_data"), hint, "simple_position", strict=True), c("_q"))},
    )


def cascade(rows: DataFrame, name: str, first: str, second: str, live: str | None = None) -> DataFrame:
    """Rows (_whole, _low, _nums, _a, _b, _c, _t, known_locked and the known totals) with the first acceptable result as column ``name``; null where ``live``, a column, isn't true."""
    for step in _steps(name, first, second, live):
        rows = rows.withColumns(step)
    return rows.drop("_k", "_q", "_at", "_h", "_own", "_i", "_n", "_lines", "_data")


def adds_up(r: Column) -> Column:
    return F.coalesce(r["promoter_shares"] + r["public_shares"] + r["other_shares"] == r["total_shares"], F.lit(False))


def reconciled(r: Column) -> Column:
    """Other shares as what promoter and public leave of the total, where other is missing, zero or wrong."""
    a, b, c, t = (r[n] for n in ("promoter_shares", "public_shares", "other_shares", "total_shares"))
    rest = t - a - b
    wrong = c.isNull() | (c == 0) | (a + b + F.coalesce(c, F.lit(0)) != t)
    fix = F.coalesce((t > 0) & (a >= 0) & (b >= 0) & ~((a == 0) & (b == 0)) & wrong & (rest >= 0), F.lit(False))
    return F.when(fix, r.withField("other_shares", rest).withField("all_found", F.lit(True))).otherwise(r)


def implausible(r: Column, total_hint: Column, locked_hint: Column) -> Column:
    """Whether a result deviates from the hints, is tiny against its total, or doesn't add up."""
    zero = lambda n: F.coalesce(r[n], F.lit(0))
    t, both, locked = zero("total_shares"), zero("promoter_shares") + zero("public_shares"), zero("locked_shares")
    tiny = (t >= 100_000) & (both > 0) & (both <= 10_000)
    off = ((t > 0) & (t != total_hint)) | ((locked > 0) & (locked != locked_hint))
    return tiny | F.coalesce(off, F.lit(False)) | ~adds_up(r)


def recovered(r: Column, low: Column, whole: Column, total_hint: Column, locked_hint: Column) -> Column:
    """Promoter and public from the lines marked (A) and (B), other as the rest; null if that fails."""
    first = lambda test: F.get(F.filter(low, test), F.lit(0))
    largest = lambda line: F.array_max(numbers.guarded_numbers(line))
    a, b = first(lambda l: l.contains("(a)") & l.contains("promoter")), first(lambda l: l.contains("(b)") & l.contains("public"))
    total_line = first(lambda l: l.rlike(r"total\s*a\+b") | l.rlike(r"^total\b"))
    total = F.coalesce(r["total_shares"], total_hint)
    locked = F.when(numbers.contains_number(whole, locked_hint), locked_hint).otherwise(F.coalesce(largest(total_line), r["locked_shares"]))

    def of(v: Column) -> Column:
        rest = total - v["a"] - v["b"]
        out = r.withField("promoter_shares", v["a"]).withField("public_shares", v["b"]).withField("other_shares", rest).withField("total_shares", total)
        out = out.withField("locked_shares", locked).withField("all_found", F.lit(True)).withField("strategy", F.concat(F.coalesce(r["strategy"], F.lit("unknown")), F.lit("+hint_recovery")))
        return F.when(rest >= 0, out)

    return let(F.struct(largest(a).alias("a"), largest(b).alias("b")), of)


def locked_from_hint(r: Column, whole: Column, hint: Column) -> Column:
    """The known locked shares where the text holds them and the result has none, or a fragment."""
    now = F.coalesce(r["locked_shares"], F.lit(0))
    bad = ((now <= 100_000) & (hint >= 1_000_000)) | ((now > 0) & (hint >= 100_000) & (now * 100 < hint)) | (now == 0)
    fix = F.coalesce((hint > 0) & (now != hint) & bad & numbers.contains_number(whole, hint), F.lit(False))
    return F.when(fix, r.withField("locked_shares", hint)).otherwise(r)


def problems(r: Column, lockin_locked: Column | None = None) -> Column:
    """Why a result isn't valid, as an array of reasons; empty if it is.

    Values that are missing are named and end the check. Then parts must make up the total (unless it is zero; no
    other shares count as none), and only where they do, locked shares must be those of the lock-in, if both are known.
    """
    none = F.array().cast("array<string>")
    missing = F.array_compact(F.array(*(F.when(r[n].isNull(), f"missing {n}") for n in ("promoter_shares", "public_shares", "total_shares"))))
    parts = r["promoter_shares"] + r["public_shares"] + F.coalesce(r["other_shares"], F.lit(0))
    out = F.when(r.isNull(), F.array(F.lit("no data"))).when(F.size(missing) > 0, missing)
    out = out.when((r["total_shares"] != 0) & (parts != r["total_shares"]), F.array(F.lit("sum differs from total")))
    return (out if lockin_locked is None else out.when(r["locked_shares"] != lockin_locked, F.array(F.lit("locked differs from lock-in")))).otherwise(none)


def coverage(rows: Column, labels: tuple[str, ...]) -> Column:
    """How many lines bear each label."""
    def bearing(label: str) -> Column:
        return F.size(F.filter(rows, lambda r: r["bare"].contains(label)))

    return F.map_from_arrays(F.array(*map(F.lit, labels)), F.array(*map(bearing, labels)))


@built_once
def _read() -> tuple[dict[str, Column], ...]:
    """The document as lines and their numbers. What can be is done on the whole text, since what is done to each line is interpreted;
    sets of characters are looked at only where a text has any white space but blanks and line feeds."""
    c, labels = F.col, {"_a": PROMOTER, "_b": PUBLIC, "_c": OTHER}
    parts = F.split("_whole", "\n", -1)
    return (
        {"_whole": F.lower(text.plain_breaks(F.coalesce("text", F.lit(""))))},
        {"_odd": c("_whole").rlike(text.ODD_WHITE)},
        {"_whole": F.when(c("_odd"), F.regexp_replace("_whole", text.ALL_BREAKS, "\n")).otherwise(c("_whole"))},
        {"_low": F.when(c("_odd"), F.transform(parts, text.strip)).otherwise(F.transform(parts, lambda l: F.trim(l))), "_nums": numbers.numbers_by_line(c("_whole")), "_bare": F.replace(F.replace("_whole", F.lit(" "), F.lit("")), F.lit("-"), F.lit(""))},
        {**{n: labelled(c("_bare"), ls) for n, ls in labels.items()}, "_t": grand_total(c("_whole"), c("_low"), c("_nums"))},
        {**{n: F.when(c(n).isNotNull(), F.get("_nums", line_of(c("_bare"), c(n)))) for n in labels}, "_t": F.when(c("_t") > 0, F.struct(F.get("_low", c("_t") - 1).alias("line"), F.get("_nums", c("_t") - 1).alias("nums")))},
    )


@built_once
def _checked() -> Column:
    """The result of the total that adds up."""
    switch = (F.col("_two.total_shares") == F.col("computed_total")) & adds_up(F.col("_two"))
    return reconciled(F.when(F.coalesce(switch, F.lit(False)), F.col("_two")).otherwise(F.col("_one")))


@built_once
def _rescued() -> Column:
    """What the hints recover where a result contradicts them, else null."""
    whole, known, locked = F.coalesce("text", F.lit("")), F.col("known_total"), F.col("known_locked")
    gate = numbers.contains_number(whole, known) & numbers.contains_number(whole, locked) & implausible(F.col("_r"), known, locked)
    return F.when(known.isNotNull() & locked.isNotNull() & gate, recovered(F.col("_r"), F.col("_low"), whole, known, locked))


def extract(documents: DataFrame) -> DataFrame:
    """``documents`` (exchange, text; optional known_total, computed_total, known_locked) with the column shp.

    A null text is empty. Values that no strategy finds are null; ``shp_shares`` turns them into 0.
    """
    both = {"known_total", "computed_total"} <= set(documents.columns)
    for name in ("known_total", "computed_total", "known_locked"):
        if name not in documents.columns:
            documents = documents.withColumn(name, F.lit(None).cast("bigint"))
    kept, c = documents.columns, F.col
    out = documents
    for step in _read():
        out = out.withColumns(step)
    out = cascade(out.drop("_bare", "_odd"), "_one", "known_total", "computed_total")
    if both:  # else nothing can disagree
        conflict = (c("exchange") == "BSE") & (c("known_total") != c("computed_total")) & (c("_one.total_shares") == c("known_total"))
        out = cascade(out.withColumn("_conflict", F.coalesce(conflict, F.lit(False))), "_two", "computed_total", "known_total", "_conflict")
        out = out.withColumn("_two", F.when(c("_conflict"), reconciled(c("_two"))))
    else:
        out = out.withColumn("_two", F.when(F.lit(False), c("_one")))
    out = out.withColumn("_r", _checked()).withColumn("_saved", _rescued())
    out = out.withColumn("_r", F.when(c("_saved").isNotNull() & adds_up(c("_saved")), c("_saved")).otherwise(c("_r")))
    return out.select(*kept, locked_from_hint(c("_r"), F.coalesce("text", F.lit("")), c("known_locked")).alias("shp"))


def shp_shares(shp: str = "shp") -> list[Column]:
    """Columns of the record: zero for what wasn't found."""
    names = {"total_shares": "shp_total_shares", "locked_shares": "shp_locked_shares", "promoter_shares": "shp_promoter_shares", "public_shares": "shp_public_shares", "other_shares": "shp_others_shares"}
    return [F.coalesce(f"{shp}.{n}", F.lit(0)).alias(to) for n, to in names.items()]
