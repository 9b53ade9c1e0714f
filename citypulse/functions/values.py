"""Number, text and key clean-up. Every function takes and returns Columns (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes that occur in delimited files.
WHITESPACE = " \t\r\n\x0b\x0c"
# Fixed value: what an address without a usable key is called.
UNDEFINED_KEY = "undefined"
# Fixed value: the flag that marks a mountain lot.
MOUNTAIN_FLAG = 2
CELL_ID_LENGTH = 8


def stripped(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def _number_or_null(text: Column) -> Column:
    """Value of number text. The last character must not be a letter: the JVM would read '1d' as 1.0,
    and 'nan' and 'inf' are no counts. One short test keeps wide projections compilable.
    """
    return F.when(F.substring(text, -1, 1) <= "9", text).try_cast("double")


def lenient_double(col: Column) -> Column:
    """Number in text; missing and malformed text becomes 0.0."""
    return F.coalesce(_number_or_null(col), F.lit(0.0))


def optional_double(col: Column) -> Column:
    """Number in text; missing and malformed text is NULL."""
    return _number_or_null(col)


def integer_text(col: Column) -> Column:
    """Whole-number text of a numeric or text value ('0012' and 12.7 give '12'); NULL if not a number."""
    number = _number_or_null(col.cast("string"))
    return number.try_cast("bigint").cast("string")


def cell_id_text(col: Column) -> Column:
    """Cell id as text: integral numbers lose a trailing '.0', missing stays NULL."""
    return integer_text(col)


def district_code(col: Column) -> Column:
    """District code times 100, as text."""
    return (stripped(col.cast("string")).cast("bigint") * F.lit(100)).cast("string")


def is_valid_cell(col: Column) -> Column:
    return col.isNotNull() & (F.length(col) == CELL_ID_LENGTH)


def _is_blank(col: Column) -> Column:
    return col.isNull() | (stripped(col) == "")


def address_key(road: Column, legal: Column, main: Column, sub: Column, mountain: Column) -> Column:
    """``code-[S]main[-sub]``: road code, or the legal-district code where the road code is blank.

    A blank main number, or a code or main number that is not a number, gives ``undefined``.
    A blank or malformed sub number is left out ('0' is kept). Flag 2 puts S before the main number.
    """
    road, legal, main, sub, mountain = (c.cast("string") for c in (road, legal, main, sub, mountain))
    code = integer_text(F.when(_is_blank(road), legal).otherwise(road))
    main_number = integer_text(main)
    lot = F.when(F.coalesce(integer_text(mountain) == str(MOUNTAIN_FLAG), F.lit(False)), F.lit("S")).otherwise("")
    return F.when(code.isNull() | main_number.isNull(), F.lit(UNDEFINED_KEY)).otherwise(
        F.concat_ws("-", code, F.concat(lot, main_number), integer_text(sub))
    )


def clip_at_zero(col: Column) -> Column:
    """Negative values become zero; NULL stays NULL."""
    return F.when(col.isNotNull(), F.greatest(col, F.lit(0.0)))


def rounded2(col: Column) -> Column:
    """Two decimals as ``decimal(38,2)``, rounded half up on the decimal, not the binary, value."""
    return F.round(col.cast("decimal(38,10)"), 2).cast("decimal(38,2)")


def not_in_keep_nulls(col: Column, values: list) -> Column:
    """``NOT IN`` that keeps rows where the column is NULL."""
    return ~col.isin(values) | col.isNull()
