"""Repair and typing expressions for vendor text. All are Column -> Column, evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerlake.functions.naming import WORD_BREAKS

# The month pattern and the spellings vendors use for "no value".
MONTH_COMMA = r'"([A-Za-z]+ \d+), (\d+)"'
EMPTY_CELLS = ["", "null", "NULL", "None", '""']
DECIMAL_BLANKS = ["", "null", "none", "n/a"]
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy"]

# A Unicode noncharacter: cannot occur in valid interchange text.
FIELD_MARK = "\uffff"


def _quote() -> Column:
    return F.lit('"')


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed a single time, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\r\n"))


def fix_month_comma(line: Column) -> Column:
    """Drop the comma inside the first quoted ``"Month D, YY"`` and in every copy of it."""

    def repair(found: Column) -> Column:
        return F.replace(line, found, F.regexp_replace(found, MONTH_COMMA, '"$1 $2"'))

    first = F.regexp_extract(line, MONTH_COMMA, 0)
    # most lines have no quote at all
    return F.when(line.contains('"'), once(first, lambda f: F.when(f != "", repair(f)).otherwise(line))).otherwise(line)


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, _quote(), F.lit("")))


def has_open_quote(line: Column) -> Column:
    return _quotes(line) % 2 == 1


def fix_unterminated_quote(line: Column) -> Column:
    """Close a line with an odd number of quotes, unless it already ends in one."""
    return F.when(has_open_quote(line) & ~line.endswith('"'), F.concat(line, _quote())).otherwise(line)


def csv_fields(line: Column) -> Column:
    """Fields of one CSV line, split only at commas outside quotes; quotes stay in place.

    Pieces between quotes alternate outside / inside, so one linear pass marks the outer commas.
    """
    marked = F.transform(
        F.split(line, '"', -1),
        lambda piece, i: F.when(i % 2 == 0, F.replace(piece, F.lit(","), F.lit(FIELD_MARK))).otherwise(piece),
    )
    return F.split(F.array_join(marked, '"'), FIELD_MARK, -1)


def pad_columns(line: Column, expected: int) -> Column:
    """Append commas until the line has ``expected`` fields; longer lines are left alone."""
    missing = F.greatest(F.lit(expected) - F.size(csv_fields(line)), F.lit(0))
    return F.concat(line, F.repeat(F.lit(","), missing))


def clean_line(line: Column, expected: int) -> Column:
    """Trim, repair the month comma, close the open quote, pad. Empty lines stay empty.

    A line that still ends on its odd quote is passed on unpadded.
    """

    def finish(text: Column) -> Column:
        ends_open = has_open_quote(text) & text.endswith('"')
        closed = once(fix_unterminated_quote(text), lambda c: pad_columns(c, expected))
        return F.when((text == "") | ends_open, text).otherwise(closed)

    return once(strip(line), lambda stripped: once(fix_month_comma(stripped), finish))


def unquote(cell: Column) -> Column:
    """A field without its enclosing quotes, doubled quotes folded."""
    inner = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), _quote())
    return F.when(cell.startswith('"') & cell.endswith('"') & (F.length(cell) >= 2), inner).otherwise(cell)


def normalise_cell(cell: Column) -> Column:
    """Trimmed cell, or NULL when it spells "no value"."""
    return once(strip(cell), lambda text: F.when(~text.isin(EMPTY_CELLS), text))


def normalised_cells(line: Column, expected: int) -> Column:
    """Exactly ``expected`` normalised cells: short rows padded with NULL, long rows cut."""
    cells = F.transform(csv_fields(line), lambda c: once(strip(c), lambda t: normalise_cell(unquote(t))))
    nulls = F.array_repeat(F.lit(None).cast("string"), expected)
    return F.slice(F.concat(cells, nulls), 1, expected)


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def safe_cast(c: Column, to: str) -> Column:
    """Typed value, or NULL for blank and malformed text."""
    return blank_to_null(c.cast("string")).try_cast(to)


def safe_int(c: Column) -> Column:
    return safe_cast(c, "bigint")


def safe_float(c: Column) -> Column:
    """Double, or NULL. NaN and infinities are refused as well: no operator expects them."""
    value = safe_cast(c, "double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def safe_date(c: Column) -> Column:
    return F.try_to_date(blank_to_null(c), "yyyy-MM-dd")


def safe_bool(c: Column) -> Column:
    return safe_cast(c, "boolean")


def safe_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(blank_to_null(c))


def decimal_text_to_bigint(c: Column) -> Column:
    """``'1234.0'`` -> 1234 through double, halves to even."""
    return F.rint(safe_float(c)).try_cast("bigint")


def parse_percent(c: Column) -> Column:
    return safe_float(F.rtrim(F.trim(c), F.lit("%")))


def parse_money(c: Column, to: str = "decimal(20,6)") -> Column:
    """Amount without ``$`` and thousands commas."""
    return safe_cast(F.regexp_replace(c, "[$,]", ""), to)


def parse_date_any(c: Column, formats: list[str] | None = None) -> Column:
    """First format that parses, in order."""
    text = blank_to_null(c)
    return F.coalesce(*[F.try_to_date(text, f) for f in formats or DATE_FORMATS])


def standard_decimal(c: Column) -> Column:
    """Two places, half up, computed on the decimal text so 0.045 becomes 0.05."""
    text = F.trim(c.cast("string"))
    return F.when(~F.lower(text).isin(DECIMAL_BLANKS), F.round(text.try_cast("decimal(38,10)"), 2)).try_cast(
        "decimal(38,2)"
    )


def clip_text(c: Column, width: int, default: str | None = None, trim_end: bool = False) -> Column:
    """Trim and cut to ``width``; blank becomes NULL, a missing value the default. ``trim_end`` drops the blanks that the cut leaves at the end."""
    source = F.coalesce(c, F.lit(default)) if default else c
    cut = F.substring(F.trim(source), 1, width)
    return F.nullif(F.rtrim(cut) if trim_end else cut, F.lit(""))


def snake_case(c: Column) -> Column:
    """camelCase value to snake_case."""
    for break_at in WORD_BREAKS:
        c = F.regexp_replace(c, break_at, "$1_$2")
    return F.lower(c)


def violations(rules: dict[str, Column]) -> Column:
    """Names of the broken rules; a rule that evaluates to NULL counts as kept."""
    return F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))


def all_true(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
