"""Column expressions that the operators share: number text, units, dates, fiscal arithmetic, tolerances."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Months by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


#: White space of any kind (Unicode's White_Space).
SPACES = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trimmed(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.trim(text, F.lit(SPACES))


def once(**columns: Column) -> Column:
    """Columns computed once for each row, for ``select``.

    As a generator, so that the optimiser copies them into no filter, no later projection and no lambda, where they would be computed for each element.
    """
    return F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items()))))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used.

    As a lambda, ``use`` isn't written out into the generated method of its stage, which Java doesn't compile above 8000 bytes of code.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def number(text: Column, *, empty: float | None = None, dash: float | None = None, spaces: bool = False, dollar: bool = False, trailing_minus: bool = False, percent: bool = False) -> Column:
    """Printed numbers: parentheses are negative; commas and bold marks go; what isn't a number is null.

    ``empty`` and ``dash`` are the values of empty cells and dashes, ``spaces`` drops inner white space, ``dollar`` and
    ``percent`` drop these signs, ``trailing_minus`` reads ``7-`` as -7.
    """

    def cleaned(text: Column) -> Column:
        t = trimmed(F.replace(F.replace(text, F.lit("**"), F.lit("")), F.lit(","), F.lit("")))
        if dollar:
            t = F.replace(t, F.lit("$"), F.lit(""))
        if percent:
            t = F.replace(t, F.lit("%"), F.lit(""))
        return F.translate(t, SPACES, "") if spaces else t

    def read(body: Column, negative: Column) -> Column:
        if trailing_minus:
            negative = negative | body.endswith("-")
            body = F.when(body.endswith("-"), F.left(body, F.length(body) - 1)).otherwise(body)
        value = let(body, lambda b: F.when(b.rlike(_NUMBER), b.try_cast("double")))
        return let(value, lambda v: F.when(negative, -F.abs(v) if trailing_minus else -v).otherwise(v))

    def signed(t: Column) -> Column:
        inside = let(trimmed(F.regexp_replace(t, r"^\(|\)$", "")), lambda b: read(b, F.lit(True)))
        return F.when(t.startswith("(") & t.rlike(r"^\(.*\)$"), inside).otherwise(let(trimmed(t), lambda b: read(b, F.lit(False))))

    def other(t: Column) -> Column:
        return F.when(t == "", F.lit(empty).cast("double")).when(t.rlike("^[-–—]+$"), F.lit(dash).cast("double")).otherwise(signed(t))

    # most figures are digits and commas only; null text passes all tests and stays null
    plain = lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double")
    return let(text, lambda x: F.when(x.rlike(r"^[0-9][0-9,]*\z"), plain(x)).otherwise(let(cleaned(x), other)))


def unit_factor(unit: Column, field: Column | None = None) -> Column:
    """What makes a figure thousands; per-share fields are never scaled."""
    u = F.lower(F.coalesce(unit, F.lit("")))
    factor = F.when(u.contains("thousand"), 1.0).when(u.isin("rupees", "rupee", "full_rupees"), 0.001).when(u == "millions", 1000.0).otherwise(1.0)
    return factor if field is None else F.when(F.lower(field).rlike("eps|per_share"), 1.0).otherwise(factor)


def month_number(name: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(name, 1, 3))).cast("int")


def period_header(text: Column) -> Column:
    """``struct(period_end, months)`` of headers such as 9M Sep 2024, 30 Jun 2024, June 30, 2024; months is null for dates."""
    plain = trimmed(F.when(F.contains(text, F.lit("(")), F.regexp_replace(text, r"\s*\([^)]*\)\s*$", "")).otherwise(text))

    def read(t: Column) -> Column:
        span, day, long_ = r"^(\d{1,2})M\s+([A-Za-z]+)\s+(\d{4})$", r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})$", r"^([A-Za-z]+)\s+(\d{1,2}),?\s+(\d{4})$"

        def part(pattern: str, i: int) -> Column:
            return F.regexp_extract(t, pattern, i)

        def when(pattern: str, y: int, m: int, d: int | None) -> Column:
            year, month = part(pattern, y).try_cast("int"), month_number(part(pattern, m))
            first = F.try_make_date(year, F.when(month > 0, month), F.lit(1)) if hasattr(F, "try_make_date") else F.when(month > 0, F.make_date(year, month, F.lit(1)))
            return F.last_day(first) if d is None else F.when(part(pattern, d).try_cast("int") <= F.day(F.last_day(first)), F.date_add(first, part(pattern, d).try_cast("int") - 1))

        end = F.when(t.rlike(span), when(span, 3, 2, None)).when(t.rlike(day), when(day, 3, 2, 1)).when(t.rlike(long_), when(long_, 3, 1, 2))
        return F.struct(end.alias("period_end"), F.when(t.rlike(span), part(span, 1).try_cast("int")).alias("months"))

    # the text without its remark is made once, as every pattern looks at it
    return F.get(F.transform(F.array(plain), read), F.lit(0))


def fiscal_year(end: Column, fiscal_month: Column) -> Column:
    return (F.year(end) + (F.month(end) > fiscal_month).cast("int")).cast("int")


def months_into(end: Column, fiscal_month: Column) -> Column:
    """1 to 12: months of the fiscal year that end with this date's month."""
    return (F.pmod(F.month(end) - fiscal_month - 1, F.lit(12)) + 1).cast("int")


def off_by(actual: Column, expected: Column, base: Column) -> Column:
    """Difference relative to a base; infinite if only the base is 0."""
    return F.when(base != 0, F.abs(actual - expected) / F.abs(base)).when(actual == expected, 0.0).otherwise(float("inf"))
