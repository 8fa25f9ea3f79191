"""From the text of a lock-in annexure to its share lots.

A filing is one row; its lines are an array, and every strategy is a column expression
over these lines that gives one struct (null where it fails). The cascade's first strategy
settles most filings; what it leaves goes to a plan of its own, where a ``CASE`` over the
others' results picks one. Nothing is shuffled and no Python runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotloom.functions import classify, dates, numbers, text
from lotloom.functions.bind import built_once, let

LOT = (
    "shares bigint, from_no bigint, to_no bigint, security_type string, from_date string, to_date string, raw_lockin string, share_form string, is_free boolean, row_class string, range_diff bigint"
)
LOTS = f"array<struct<{LOT.replace(' bigint', ':bigint').replace(' string', ':string').replace(' boolean', ':boolean')}>>"
_NAMES = [f.split()[0] for f in LOT.split(", ")]
#: Rows above the footer, as ``body`` makes them.
ROWS = "array<struct<line:string,nums:array<bigint>,total:boolean>>"

# Words that mark a header line.
REVERSE_HEADERS = ("Number of Securities", "Type of Security")


def _any(line: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | line.contains(w)
    return out


def _says_total(line: Column) -> Column:
    return F.lower(line).contains("total")


def _no_lots() -> Column:
    return F.array().cast(LOTS)


def _lot(**fields: Column | None) -> Column:
    """A lot with null for what a strategy doesn't know."""
    kinds = dict(f.split() for f in LOT.split(", "))
    return F.struct(*(F.coalesce(fields[n]).cast(kinds[n]).alias(n) if fields.get(n) is not None else F.lit(None).cast(kinds[n]).alias(n) for n in _NAMES))


def _sum(lots: Column, test: Callable[[Column], Column] | None = None) -> Column:
    kept = F.filter(lots, test) if test else lots
    return F.aggregate(kept, F.lit(0).cast("bigint"), lambda s, r: s + r["shares"])


def _shares(rows: Column) -> Column:
    """The sum of the first numbers of rows, which is their lots' sum of shares."""
    return F.aggregate(rows, F.lit(0).cast("bigint"), lambda s, r: s + F.get(r["nums"], F.lit(0)))


def _result(lots: Column, facts: Callable[[Column], tuple[Column, Column, Column]]) -> Column:
    """The struct of a strategy; ``facts`` gives declared total, match and name from the lots."""
    def of(v: Column) -> Column:
        declared, match, strategy = facts(v)
        free = F.filter(v, lambda r: r["is_free"])
        return F.struct(
            v.alias("lots"), declared.cast("bigint").alias("declared_total"), _sum(v).alias("computed_total"), match.alias("total_match"), F.size(v).alias("rows_count"),
            F.size(free).alias("free_count"), (F.size(v) - F.size(free)).alias("locked_count"), _sum(v, lambda r: r["is_free"]).alias("free_shares"),
            _sum(v, lambda r: ~r["is_free"]).alias("locked_shares"), strategy.cast("string").alias("strategy"),
        )

    return let(lots, of)


def _kept(lines: Column) -> Column:
    """Lines but empty ones, page markers and rules."""
    return F.filter(lines, _is_kept)


def _is_kept(line: Column) -> Column:
    return (line != "") & ~line.startswith("---") & ~line.startswith("####")


def _numbered(line: Column) -> Column:
    """A line with its numbers."""
    return F.struct(line.alias("line"), numbers.line_numbers(line).alias("nums"))


def body(lines: Column, footer: Column | None = None) -> Column:
    """Lines above the first footer, each with its numbers (a date, which may fit by chance, is none) and whether it says total.
    Where ``footer`` is false none is looked for."""
    def above(kept: Column) -> Column:
        at = F.array_position(F.transform(kept, lambda l: text.may_have_footer(l) & l.rlike(text.FOOTER)), True)
        return let(at, lambda p: F.when(p > 0, F.slice(kept, F.lit(1), F.greatest(p - 1, F.lit(0)).cast("int"))).otherwise(kept))

    found = let(_kept(lines), above)
    return F.transform(found if footer is None else F.when(footer, found).otherwise(_kept(lines)), lambda l: F.struct(l.alias("line"), numbers.token_numbers(l, dates=False).alias("nums"), _says_total(l).alias("total")))


def _last_total(rows: Column) -> Column:
    """The largest number of the last total line that has any."""
    totals = F.filter(rows, lambda r: r["total"] & (F.size(r["nums"]) > 0))
    return F.array_max(F.try_element_at(totals, F.lit(-1))["nums"])


def _three(rows: Column, test: Callable[[Column], Column]) -> Column:
    """Rows with at least three numbers that aren't totals and pass the test."""
    return F.filter(rows, lambda r: ~r["total"] & (F.size(r["nums"]) >= 3) & test(r))


def _fits(r: Column) -> Column:
    """Shares agree with the distinctive numbers, where both ends are given."""
    shares, first, last = (F.get(r["nums"], F.lit(i)) for i in range(3))
    return (first <= 0) | (last <= 0) | (shares == last - first + 1)


def _positive(r: Column) -> Column:
    return F.get(r["nums"], F.lit(0)) > 0


def _dated(r: Column, pattern: str, kind: Column, form: bool = True, parsed: bool = True, soft: bool = False) -> Column:
    """The lot of a numbered line. ``parsed``: dates as dates where possible; ``soft``: with the range's difference."""
    shares, first, last = (F.get(r["nums"], F.lit(i)) for i in range(3))
    start, end = (lambda day: F.get(day, F.lit(0))), (lambda day: F.get(day, F.lit(1)))

    def lot(day: Column, kind: Column, raw: Column, cls: Column) -> Column:
        diff = F.when((first > 0) & (last > 0), shares - (last - first + 1)) if soft else None
        return _lot(shares=shares, from_no=first, to_no=last, security_type=kind, from_date=start(day), to_date=end(day), raw_lockin=raw, share_form=text.share_form(r["line"]) if form else None, is_free=cls == "free", row_class=cls, range_diff=diff)

    # both dates by one expression: a task builds its code from all of them
    both = let(dates.line_dates(r["line"], pattern), lambda d: F.array(d["first"], d["last"]))
    read_days = F.transform(both, dates.date_text) if parsed else both
    raw_of = lambda day: F.when(end(day) != "", end(day)).otherwise(start(day))
    return let(read_days, lambda day: let(kind, lambda k: let(raw_of(day), lambda raw: let(classify.row_class(k, raw), lambda cls: lot(day, k, raw, cls)))))


@dataclass(frozen=True)
class Inputs:
    """What strategies look at, as columns: lines of the document, rows above the footer as they
    stand and with numbers mended, numbers on the page (null where no total is known), totals known beforehand (null if not),
    the document's lines with their numbers, whether numbers may have gaps, and those of the totals that are on the page (none for a strategy that isn't anchored).

    A strategy tells from numbers alone whether its total is allowed, and reads dates and types only of lots that it yields.
    """

    lines: Column
    every_line: Column
    rows: Column
    mended: Column
    on_page: Column
    known: Column
    declared: Column
    computed: Column
    numbered: Column
    gaps: Column
    hints: Column

    def allows(self, total: Column) -> Column:
        """Whether a total is one of the hints, if there are any."""
        return (F.size(self.hints) == 0) | F.array_contains(self.hints, total)


def general(x: Inputs, compat: bool = False) -> Column:
    """Three leading numbers and an optional rest: a date, or free.

    With ``compat`` decimals keep their digits (``303091.00`` is 30309100), else they are dropped.
    """
    row = r"^(\d[\d,.\*]*)\s+(\d[\d,.\*]*)\s+(\d[\d,.\*]*)\s*(.*)"
    number = (lambda c: F.regexp_replace(c, "[^0-9]", "").try_cast("bigint")) if compat else numbers.clean_number
    cleaned = F.transform(x.every_line, lambda l: text.without_toll_free(l))
    found = F.filter(cleaned, lambda l: (l != "") & ~_any(l, ("Distinctive", "Lock in", "Equity")) & l.rlike(row))
    parts = F.transform(found, lambda l: F.struct(*(number(F.regexp_extract(l, row, i)).alias(n) for i, n in ((1, "a"), (2, "b"), (3, "c"))), F.trim(F.regexp_extract(l, row, 4)).alias("rest")))
    parts = F.filter(parts, lambda p: ~_says_total(p["rest"]) & p["a"].isNotNull() & p["b"].isNotNull() & p["c"].isNotNull())

    def lot(p: Column) -> Column:
        free = (p["rest"] == "") | p["rest"].rlike("(?i)free")
        date = F.coalesce(*(F.nullif(F.regexp_extract(p["rest"], d, 0), F.lit("")) for d in (r"\d{1,2}-[A-Za-z]{3}-\d{2,4}", r"\d{1,2}[-/\.]\d{1,2}[-/\.]\d{4}")))
        make = lambda f, d: _lot(shares=p["a"], from_no=p["b"], to_no=p["c"], to_date=d, raw_lockin=p["rest"], is_free=f, row_class=classify.coarse_class(d, f))
        return let(free, lambda f: let(F.when(~f, date), lambda d: make(f, d)))

    none = F.lit(None)
    same = lambda lots, total: F.coalesce(total == _sum(lots), F.lit(False)) & (F.size(lots) > 0)
    return let(declared_total(x.every_line), lambda total: _result(F.transform(parts, lot), lambda lots: (total, same(lots, total), none)))


def declared_total(lines: Column) -> Column:
    """The largest number of the first line that says total and has a number."""
    hits = F.filter(lines, lambda l: _says_total(l) & l.rlike(r"\d"))
    return F.array_max(numbers.line_numbers(F.get(hits, F.lit(0))))


def unlock_schedule(lines: Column) -> Column:
    """Dates and shares of the schedule of shares that become tradable, as an array of (unlock_date, shares)."""
    date, kind = r"(\d{1,2}-[A-Za-z]{3}-\d{4})", "array<struct<unlock_date:string,shares:bigint>>"

    def seen(l: Column) -> Column:
        def of(low: Column) -> Column:
            annexure, two = low.contains("annexure"), low.contains("ii") | low.contains("2")
            opens = (annexure & two) | _any(low, ("eligible", "traded", "unlock", "schedule"))
            closes = annexure & (low.contains("i") | low.contains("1")) & ~two
            return F.struct(opens.alias("opens"), closes.alias("closes"), F.regexp_extract(l, date, 1).alias("day"), others(l).alias("shares"))

        return let(F.lower(text.squeeze(l)), of)

    def others(l: Column) -> Column:
        def of(of_day: Column) -> Column:
            tokens = F.transform(F.regexp_extract_all(l, F.lit(r"(\d[\d,]*)"), F.lit(1)), lambda n: F.replace(n, F.lit(","), F.lit("")))
            return F.array_max(F.transform(F.filter(tokens, lambda n: ~F.array_contains(of_day, n)), lambda n: n.try_cast("bigint")))

        return let(F.regexp_extract_all(F.regexp_extract(l, date, 1), F.lit(r"(\d+)"), F.lit(1)), of)

    def step(acc: Column, l: Column) -> Column:
        take = (acc["state"] == 1) & ~l["opens"] & ~l["closes"] & (l["day"] != "") & l["shares"].isNotNull()
        state = F.when(acc["state"] == 2, 2).when(l["opens"], 1).when((acc["state"] == 1) & l["closes"], 2).otherwise(acc["state"])
        row = F.array(F.struct(l["day"].alias("unlock_date"), l["shares"].alias("shares")))
        return F.struct(state.alias("state"), F.when(take, F.concat(acc["rows"], row)).otherwise(acc["rows"]).cast(kind).alias("rows"))

    return F.aggregate(F.transform(lines, seen), F.struct(F.lit(0).alias("state"), F.array().cast(kind).alias("rows")), step, lambda acc: acc["rows"])


def reverse_from_total(x: Inputs) -> Column:
    """From the bottom total line upward until the lots make up the total exactly."""
    up = F.reverse(F.filter(x.numbered, lambda r: _is_kept(r["line"])))
    says = lambda r: ((F.size(r["nums"]) == 1) & (F.get(r["nums"], F.lit(0)) > 1_000_000)) | ((F.size(r["nums"]) > 0) & _says_total(r["line"]))
    ends = lambda r: ((F.size(r["nums"]) < 3) & _any(r["line"], REVERSE_HEADERS)) | (r["line"].contains("Limited") & (F.size(r["nums"]) == 0))

    def mend(r: Column) -> Column:
        whole = lambda l: F.when(l == r["line"], r).otherwise(_numbered(l))
        return F.when(x.gaps, let(numbers.repair_numbers(r["line"], eager=True), whole)).otherwise(r)

    def judged(r: Column) -> Column:
        usable = F.coalesce((F.size(r["nums"]) >= 3) & _fits(r), F.lit(False))
        return F.struct(r["line"].alias("line"), r["nums"].alias("nums"), ends(r).alias("ends"), usable.alias("usable"))

    def fold(rows: Column, target: Column) -> Column:
        def step(acc: Column, r: Column) -> Column:
            def of(after: Column) -> Column:
                stop = acc["stop"] | r["ends"] | (r["usable"] & (after > target))
                take = r["usable"] & ~stop
                done = take & (after == target) & (F.get(r["nums"], F.lit(2)) == target)
                return F.struct(F.when(take, after).otherwise(acc["sum"]).alias("sum"), F.when(take, acc["taken"] + 1).otherwise(acc["taken"]).alias("taken"), (stop | done).alias("stop"))

            return let(acc["sum"] + F.when(r["usable"], F.get(r["nums"], F.lit(0))).otherwise(0), of)

        # what is taken are the first usable rows; their dates are read when they make up the total
        name = F.when(x.known.isNotNull() & (x.known != 0), "total_validation").otherwise("reverse_from_total")
        taken = lambda n: F.reverse(F.slice(F.filter(rows, lambda r: r["usable"]), F.lit(1), n))
        lots = lambda n: F.transform(taken(n), lambda r: _dated(r, dates.WITH_IPO, F.lit(""), form=False))
        whole = lambda s: F.when((s["sum"] == target) & (s["taken"] > 0), _result(lots(s["taken"]), lambda lots: (target, F.lit(True), name)))
        return let(F.aggregate(rows, F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("taken"), F.lit(False).alias("stop")), step), whole)

    def from_line(up: Column, at: Column) -> Column:
        above = F.slice(up, (at + 1).cast("int"), F.greatest(F.size(up), F.lit(1)))
        rows = F.transform(F.transform(above, mend), judged)
        target = F.coalesce(F.nullif(x.known, F.lit(0)), F.array_max(F.get(up, (at - 1).cast("int"))["nums"]))
        return F.when(at > 0, let(target, lambda target: F.when(x.allows(target), let(rows, lambda rows: fold(rows, target)))))

    return let(up, lambda up: let(F.array_position(F.transform(up, says), True), lambda at: from_line(up, at)))


def _by_line(x: Inputs, rows: Column, name: str) -> Column:
    def of(found: Column) -> Column:
        lots = F.transform(found, lambda r: _dated(r, dates.WITHOUT_IPO, text.security_type(r["line"])))
        return F.when(x.allows(_shares(found)), _result(lots, lambda lots: (F.coalesce(_last_total(rows), F.nullif(_sum(lots), F.lit(0))), F.lit(True), F.lit(name))))

    return let(_three(rows, _fits), of)


def line_by_line(x: Inputs) -> Column:
    """Each line above the footer, stray spaces inside numbers closed."""
    return _by_line(x, x.mended, "line_by_line")


def unrepaired(x: Inputs) -> Column:
    """As line by line, numbers as they stand; fails beyond 100 off a known total."""
    off = lambda out: (x.known > 0) & (out["computed_total"] > 0) & (F.abs(out["computed_total"] - x.known) > 100)
    return let(_by_line(x, x.rows, "no_malformed_cleanup"), lambda out: F.when(~F.coalesce(off(out), F.lit(False)), out))


def range_only(x: Inputs) -> Column:
    """Lines with two numbers besides dates: first and last; shares follow from them."""
    def two(l: Column) -> Column:
        # only tokens with a digit may be numbers; without an odd mark these are the row's own
        marked = lambda t: t.contains("/") | t.contains("-") | t.contains(".")
        tokens = F.filter(F.regexp_extract_all(l, F.lit(r"(?<!\S)[^\d\s]*+\d\S*"), F.lit(0)), lambda t: ~(marked(t) & (F.length(F.translate(t, "/-.", "")) >= 7)))
        return F.filter(F.transform(tokens, numbers.clean_number), lambda n: n.isNotNull())

    first, last = (lambda r: F.get(r["nums"], F.lit(0))), (lambda r: F.get(r["nums"], F.lit(1)))
    rows = F.filter(F.transform(x.rows, lambda r: F.struct(r["line"].alias("line"), F.when(r["line"].rlike(numbers.ODD_MARK), two(r["line"])).otherwise(r["nums"]).alias("nums"))), lambda r: (F.size(r["nums"]) == 2) & (first(r) < last(r)))
    widened = F.transform(rows, lambda r: F.struct(r["line"].alias("line"), F.array(last(r) - first(r) + 1, first(r), last(r)).alias("nums")))
    lots = lambda found: F.transform(found, lambda r: _dated(r, dates.WITHOUT_IPO, text.security_type(r["line"], between=False), form=False, parsed=False))
    facts = lambda total: lambda lots: (total, total.isNull() | (total == _sum(lots)), F.lit("range_calculation"))
    off = lambda out: (x.known > 0) & (F.abs(out["computed_total"] - x.known) > 100)
    made = lambda found: let(declared_total(x.lines), lambda total: _result(lots(found), facts(total)))
    return let(let(widened, lambda found: F.when((F.size(found) > 0) & x.allows(_shares(found)), made(found))), lambda out: F.when(~F.coalesce(off(out), F.lit(False)), out))


def sum_first(x: Inputs) -> Column:
    """Any lines with a lock-in signal; then all, or a greedy, or a contiguous part of them that makes up a total."""
    def signal(r: Column) -> Column:
        return let(F.lower(r["line"]), lambda low: _any(low, ("demat", "physical", "free", "n/a"))) | (dates.line_dates(r["line"])["last"] != "")

    found = _three(x.rows, lambda r: _positive(r) & signal(r))
    lots = lambda rows: F.transform(rows, lambda r: _dated(r, dates.WITH_IPO, text.security_type(r["line"]), soft=True))
    on_rows = F.flatten(F.transform(x.rows, lambda r: r["nums"]))
    hints = let(on_rows, lambda seen: F.filter(F.array(x.known, x.declared, x.computed), lambda h: (h > 0) & F.array_contains(seen, h)))
    targets = F.array_distinct(F.filter(F.concat(hints, F.array(_last_total(x.rows))), lambda h: h > 0))

    def greedy(found: Column, target: Column) -> Column:
        def step(acc: Column, r: Column) -> Column:
            def of(after: Column) -> Column:
                take = (acc["sum"] < target) & (after <= target)
                return F.struct(F.when(take, after).otherwise(acc["sum"]).alias("sum"), F.when(take, F.concat(F.array(r), acc["rows"])).otherwise(acc["rows"]).cast(ROWS).alias("rows"))

            return let(acc["sum"] + F.get(r["nums"], F.lit(0)), of)

        out = F.aggregate(F.reverse(found), F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast(ROWS).alias("rows")), step)
        return let(out, lambda o: F.when(o["sum"] == target, o["rows"]))

    def contiguous(found: Column, target: Column) -> Column:
        ends = F.transform(F.sequence(F.lit(0), F.size(found)), lambda i: _shares(F.slice(found, F.lit(1), i)))

        def part(ends: Column) -> Column:
            spans = F.transform(F.sequence(F.lit(1), F.size(found)), lambda i: F.struct(i.alias("first"), F.array_position(ends, F.get(ends, i - 1) + target).cast("int").alias("end")))
            return let(F.get(F.filter(spans, lambda s: s["end"] > s["first"]), F.lit(0)), lambda hit: F.when(hit.isNotNull(), F.slice(found, hit["first"], hit["end"] - hit["first"])))

        return let(ends, part)

    def chosen(found: Column, targets: Column) -> Column:
        first_of = lambda pick: F.get(F.filter(F.transform(targets, lambda t: pick(found, t)), lambda l: l.isNotNull()), F.lit(0))
        return F.when((F.size(targets) == 0) | F.array_contains(targets, _shares(found)), found).otherwise(F.coalesce(first_of(greedy), first_of(contiguous)))

    def facts(targets: Column):
        def of(lots: Column) -> tuple[Column, Column, Column]:
            declared = F.coalesce(F.nullif(_last_total(x.rows), F.lit(0)), F.nullif(x.declared, F.lit(0)), x.known, _sum(lots))
            return declared, (F.size(targets) > 0) | (declared == _sum(lots)), F.lit("sum_first_soft_labels")

        return of

    def pick(found: Column, targets: Column) -> Column:
        return let(chosen(found, targets), lambda rows: F.when(rows.isNotNull() & x.allows(_shares(rows)), _result(lots(rows), facts(targets))))

    return let(found, lambda found: F.when(F.size(found) > 0, let(targets, lambda targets: pick(found, targets))))


def two_dates(x: Inputs) -> Column:
    """Lots where at least one bears both dates; they must make up the text's total, else the known one."""
    lots = lambda rows: F.transform(rows, lambda r: _dated(r, dates.WITH_IPO, text.security_type(r["line"], between=False)))
    both = lambda lots: F.exists(lots, lambda r: (r["from_date"] != "") & (r["to_date"] != "") & (r["to_date"] != "FREE"))

    def of(rows: Column, total: Column) -> Column:
        declared = F.coalesce(_last_total(x.rows), x.known, total)
        found = _result(lots(rows), lambda _: (total, F.lit(True), F.lit("two_dates_fallback")))
        return F.when(declared == total, let(found, lambda out: F.when(both(out["lots"]), out)))

    return let(_three(x.rows, lambda r: _positive(r) & _fits(r)), lambda rows: let(_shares(rows), lambda total: of(rows, total)))


@dataclass(frozen=True)
class Strategy:
    """One way to read a filing that isn't NSE's: an expression that gives a result (null where it fails), and where it stands among others, lower first.

    An anchored one must also arrive at one of the totals known beforehand that are on the page, if there are any.
    """

    name: str
    priority: int
    build: Callable[[Inputs], Column]
    anchored: bool = True
    #: Whether it looks at rows, which are then made for it.
    rows: bool = True


#: Strategies by name; those of the library stand at tens.
STRATEGIES: dict[str, Strategy] = {}


def register(strategy: Strategy) -> None:
    """Add a strategy to the cascade, or put it in the place of the one of that name; plans built from now on have it."""
    STRATEGIES[strategy.name] = strategy


def cascade() -> list[Strategy]:
    """The registered strategies in the order in which they are tried; equal priorities by name."""
    return sorted(STRATEGIES.values(), key=lambda s: (s.priority, s.name))


for _strategy in (
    Strategy("reverse_from_total", 10, reverse_from_total, rows=False), Strategy("line_by_line", 20, line_by_line), Strategy("no_malformed_cleanup", 30, unrepaired),
    Strategy("range_calculation", 40, range_only), Strategy("sum_first_soft_labels", 50, sum_first), Strategy("two_dates_fallback", 60, two_dates, anchored=False),
):
    register(_strategy)


def _acceptable(x: Inputs, result: Column, anchored: bool) -> Column:
    """Whether a strategy's result has lots and, where it must be, a total that is one of the hints on the page."""
    ok = result.isNotNull() & (F.size(result["lots"]) > 0)
    if anchored:
        ok = ok & x.allows(result["computed_total"])
    return F.coalesce(ok, F.lit(False))


def _inputs(anchored: bool = True) -> Inputs:
    named = map(F.col, ("_lines", "_every", "_rows", "_mended", "_page", "known_total", "declared_hint", "computed_hint", "_numbered", "_gaps"))
    return Inputs(*named, F.col("_hints") if anchored else F.array().cast("array<bigint>"))


@built_once
def _column(name: str) -> Column:
    """What strategies look at, from the text: its lines by either kind of break, its numbers, its rows above the footer, mended ones."""
    lines = text.lines(F.coalesce("text", F.lit("")))
    mend = lambda: let(F.transform("_lines", lambda l: numbers.repair_numbers(l)), lambda mended: F.when(mended == F.col("_lines"), F.col("_rows")).otherwise(body(mended, F.col("_footer"))))
    return {
        "_lines": lambda: lines, "_numbered": lambda: F.transform("_lines", _numbered), "_gaps": lambda: numbers.may_have_gaps(F.col("text")), "_footer": lambda: text.may_have_footer(F.col("text")), "_every": lambda: text.lines(F.coalesce("text", F.lit("")), every_break=True), "_page": lambda: F.when(F.greatest("known_total", "declared_hint", "computed_hint") > 0, F.flatten(F.transform("_numbered", lambda r: r["nums"]))),
        "_hints": lambda: let(F.col("_page"), lambda page: F.filter(F.array("known_total", "declared_hint", "computed_hint"), lambda h: h.isNotNull() & (h > 0) & F.array_contains(page, h))),
        "_rows": lambda: body(F.col("_lines"), F.col("_footer")), "_mended": lambda: F.when(F.col("_gaps"), mend()).otherwise(F.col("_rows")),
    }[name]()


@built_once
def _result_of(strategy: Strategy) -> Column:
    """The strategy's result where it is acceptable, else null."""
    x = _inputs(strategy.anchored)
    return let(strategy.build(x), lambda r: F.when(_acceptable(x, r, strategy.anchored), r))


@built_once
def _general(compat: bool) -> Column:
    return general(_inputs(), compat)


@built_once
def _failed() -> Column:
    return _result(_no_lots(), lambda _: (F.lit(None), F.lit(False), F.lit("all_failed")))


@built_once
def _finished() -> Column:
    """The picked result with dates, status and bucket for each lot."""
    def finished(r: Column) -> Column:
        # one expression for both dates, each read once: a bucket mentions its days at each of its bounds
        def of(days: Column, start: Column) -> Column:
            to = F.get(days, F.lit(1))
            extra = (F.get(days, F.lit(0)).alias("lockin_date_from"), to.alias("lockin_date_to"), classify.status(r["is_free"]).alias("status"), classify.bucket(start, to).alias("bucket"))
            return F.struct(*(r[n].alias(n) for n in _NAMES), *extra)

        days = F.transform(F.array(r["from_date"], r["to_date"]), lambda t: dates.date_value(t, F.col("_order")))
        return let(days, lambda days: let(F.coalesce(F.get(days, F.lit(0)), F.col("reference_date")), lambda start: of(days, start)))

    return F.when(F.col("_picked").isNotNull(), F.col("_picked").withField("lots", F.transform("_picked.lots", finished)))


def extract(filings: DataFrame, compat: bool = False, skip_blank: bool = False) -> DataFrame:
    """``filings`` (exchange, text; optional known_total, declared_hint, computed_hint, reference_date) with the column lockin.

    NSE filings go to the general parser, others to the cascade and, if that finds nothing, to
    the general parser. A null text is empty. Lots carry dates, status and bucket. With
    ``skip_blank`` documents of next to no content aren't parsed and have a null lockin.

    The plan is one chain of columns. Each strategy is a step that is evaluated only where the steps before it
    found nothing, and what only later ones look at is made only there, so a filing runs only the strategies it needs.
    """
    for name, kind in (("known_total", "bigint"), ("declared_hint", "bigint"), ("computed_hint", "bigint"), ("reference_date", "date")):
        if name not in filings.columns:
            filings = filings.withColumn(name, F.lit(None).cast(kind))
    kept, tried = filings.columns, cascade()
    live = ~text.is_blank(F.col("text")) if skip_blank else F.lit(True)
    # a filter on the result isn't pushed below a column that isn't deterministic; it would evaluate the strategies again, for each mention
    out = filings.withColumns({"_live": live, "_other": F.coalesce(F.col("exchange") != "NSE", F.lit(False)), "_barrier": F.monotonically_increasing_id() >= 0})
    tries = F.col("_live") & F.col("_other")
    out = out.withColumns({c: F.when(tries, _column(c)) for c in ("_lines", "_gaps")}).withColumn("_numbered", F.when(tries, _column("_numbered")))
    out = out.withColumn("_page", F.when(tries, _column("_page"))).withColumns({"_hints": F.when(tries, _column("_hints")), "_footer": F.lit(None), "_rows": F.lit(None), "_mended": F.lit(None)})
    found: Column | None = None
    made = False
    for i, strategy in enumerate(tried):
        waits = F.col("_live") & F.col("_other") & (found.isNull() if found is not None else F.lit(True))
        if strategy.rows and not made:
            for c in ("_footer", "_rows", "_mended"):
                out = out.withColumn(c, F.when(waits, _column(c)))
            made = True
        result = F.when(waits, _result_of(strategy))
        out = out.withColumn(f"_f{i}", result if found is None else F.coalesce(found, result))
        found = F.col(f"_f{i}")
    last = F.col("_live") & (F.lit(True) if found is None else found.isNull())
    out = out.withColumn("_every", F.when(last, _column("_every")))
    plain = F.when(last, _general(compat))
    picked = F.coalesce(plain if found is None else F.coalesce(found, plain), F.when(F.col("_live") & F.col("_other"), _failed()))
    unsure = F.exists("_picked.lots", lambda r: dates.needs_order(r["from_date"]) | dates.needs_order(r["to_date"]))
    out = out.withColumn("_picked", picked).withColumn("_order", F.when(unsure, dates.date_order(F.coalesce("text", F.lit("")))))
    return out.where("_barrier").select(*kept, _finished().alias("lockin"))


def scheduled(extracted: DataFrame) -> DataFrame:
    """Extracted filings with what their schedule says becomes tradable when, and the share of free shares in percent (0 without a total)."""
    of = F.try_divide(F.col("lockin.free_shares") * F.lit(100.0), F.nullif("lockin.computed_total", F.lit(0)))
    return extracted.withColumns({"unlock_schedule": unlock_schedule(text.lines(F.coalesce("text", F.lit("")), every_break=True)), "free_percent": F.coalesce(F.round(of, 2), F.lit(0.0))})


def lots(extracted: DataFrame, *keys: str) -> DataFrame:
    """One row per lot, in the document's order (row_order from 0).

    An inner explode would be given a filter on the array's size, which is pushed below the extraction and repeats it.
    """
    rows = extracted.select(*keys, F.posexplode_outer("lockin.lots").alias("row_order", "lot"))
    return rows.where("row_order is not null").select(*keys, "row_order", "lot.*")
