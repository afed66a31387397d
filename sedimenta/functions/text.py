"""Text <-> typed value conversions used on spreadsheet cells, hashes and templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text shapes accepted as number and as date. Spark alone
# would also take '1d' as a number and '2025' as a date.
NUMBER_SHAPE = r"^\s*[+-]?([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9]+)?\s*$"
NAMED_NUMBER_SHAPE = r"^\s*[+-]?(?i:nan|inf|infinity)\s*$"
DATE_SHAPE = r"^\s*([0-9]{4})([-/ \\])([0-9]{1,2})\2([0-9]{1,2})([ T][0-9:.Z+-]*)?\s*$"


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or NULL when nothing but blanks is left."""
    return F.nullif(F.trim(F.coalesce(text, F.lit(""))), F.lit(""))


def to_double(text: Column) -> Column:
    """DOUBLE of a numeric text, NULL for anything else; never fails."""
    plain = F.regexp_replace(F.trim(text), "_", "")
    return F.when(text.rlike(NUMBER_SHAPE) | text.rlike(NAMED_NUMBER_SHAPE), plain.try_cast("double"))


def to_int(text: Column) -> Column:
    """INTEGER of a numeric text, fractions rounded half away from zero; NULL when out of range."""
    plain = F.regexp_replace(F.trim(text), "_", "")
    exact = F.when(text.rlike(NUMBER_SHAPE), plain.try_cast("double").try_cast("decimal(38,10)"))
    return F.round(exact, 0).try_cast("int")


def to_date(text: Column) -> Column:
    """DATE of a year-first text (`2025-1-5`, `2025/01/05`, with or without a time part)."""
    iso = F.concat_ws("-", *[F.regexp_extract(text, DATE_SHAPE, g) for g in (1, 3, 4)])
    return F.when(text.rlike(DATE_SHAPE), iso.try_cast("date"))


def number_text(column: str) -> Column:
    """Round-trip text of a DOUBLE column: 2.5 -> '2.5', 3 -> '3.0', 0.00001 -> '1e-05', 1e16 -> '1e+16'.

    No digit is dropped, so different values have different texts; `nan`, `inf` and `-inf` are texts and both zeros
    are '0.0'. `cast(double as string)` switches to exponents at 1e-3 and 1e7, here they begin below
    1e-4 and at 1e16: in between the text goes through a decimal, which is exact, as 17 digits fit its 21 places.
    Each branch names the text once, which keeps generated code short.
    """
    return F.expr(_number_sql("`" + column.replace("`", "``") + "`"))


def number_texts(*columns: str) -> Column:
    """The texts of several DOUBLE columns as an array: one loop, so its code does not grow with the columns.

    Six columns written out beside each other make a generated method too long to be compiled to machine code.
    """
    names = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
    return F.expr(f"transform(array({names}), x -> {_number_sql('x')})")


def _number_sql(v: str) -> str:
    text = f"cast({v} AS string)"
    unfolded = f"regexp_replace(cast(cast({text} AS decimal(38,21)) AS string), '([.][0-9]+?)0+$', '$1')"
    power = f"regexp_replace(replace({text}, '.0E', 'E'), 'E(-?)([0-9])$', 'E$10$2')"
    return f"""CASE
        WHEN {v} = 0 THEN '0.0'
        WHEN abs({v}) >= 0.001D AND abs({v}) < 1e7D THEN {text}
        WHEN isnan({v}) THEN 'nan'
        WHEN abs({v}) = double('Infinity') THEN if({v} < 0, '-inf', 'inf')
        WHEN abs({v}) >= 0.0001D AND abs({v}) < 1e16D THEN {unfolded}
        WHEN {v} IS NOT NULL THEN replace(replace({power}, 'E-', 'e-'), 'E', 'e+')
        END"""


def cell_text(number: Column | None = None, moment: Column | None = None, other: Column | None = None) -> Column:
    """Text of a typed spreadsheet cell; the first part that is not NULL decides, none gives ''.

    Moments become ISO dates, whole numbers lose their fraction, other numbers
    keep up to six decimals without trailing zeros.
    """
    parts: list[Column] = []
    if moment is not None:
        parts.append(F.date_format(moment, "yyyy-MM-dd"))
    if number is not None:
        exact = number.try_cast("decimal(38,6)")
        trimmed = F.rtrim(F.rtrim(exact.cast("string"), F.lit("0")), F.lit("."))
        parts.append(
            F.when(number.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(number), F.lit("nan"))
            .when(number == F.lit(float("inf")), F.lit("inf"))
            .when(number == F.lit(float("-inf")), F.lit("-inf"))
            .when(number == F.rint(number), number.try_cast("decimal(38,0)").cast("string"))
            .otherwise(trimmed)
        )
    if other is not None:
        parts.append(other.cast("string"))
    return F.coalesce(*parts, F.lit(""))
