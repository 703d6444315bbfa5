"""Cell formatting for the text export, as built-in column expressions (no UDF).

Rules, per value:

* NULL or empty text -> empty cell;
* the partner id column -> the integer, truncated, without decimals;
* a number -> two decimals, as the source system prints it: the value as a binary
  double, its exact decimal expansion rounded half to even (2.675 is below the tie as a
  double and prints 2.67; 0.125 is a tie and prints 0.12; -0.001 prints -0.00);
* anything else -> its text (dates as ``yyyy-MM-dd``).

The source system formats *every* value that parses as a number, text columns
included (an invoice id ``70123`` becomes ``70123.00``). ``legacy_strings=True``
reproduces that for text columns, with its grammar of numbers (``1_000``, `` 7. ``,
``nan`` and ``inf`` among them, of ASCII digits); by default text is left as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTNER_ID_COLUMNS = ("partner_id", "id_partner")
# What the source system reads as a number in text: digits, with single underscores
# between them, signed, with a point and an exponent; or a name of a special value.
_DIGITS = r"\d(?:_?\d)*"
NUMERIC_TEXT = rf"^\s*[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
SPECIAL_TEXT = r"(?i)^\s*[+-]?(?:inf|infinity|nan)\s*$"

_BITS = 1 << 52  # a double's fraction in units of 2**-52 fits a long, 100 times over
_LONG = float(1 << 63)


def printed(x: str) -> str:
    """SQL text of the double ``x`` with two decimals, rounded half to even on its exact
    value. The fraction is taken apart into units of 2**-52 and of 2**-104, which is
    exact, and multiplied by 100 in 64-bit integers; bits below that, which only values
    far below a cent have, can't decide a tie. Whole parts of 8e37 and more are printed
    to 17 digits."""
    size = f"abs({x})"
    fraction = f"(CASE WHEN {size} < {float(_BITS)!r}D THEN {size} - floor({size}) ELSE 0D END)"
    units = f"CAST(floor({fraction} * {float(_BITS)!r}D) AS BIGINT)"
    finer = (f"(CAST(floor(({fraction} * {float(_BITS)!r}D - {units}) * {float(_BITS)!r}D) "
             f"AS BIGINT) * 100)")
    scaled = f"({units} * 100 + shiftright({finer}, 52))"
    cents = f"shiftright({scaled}, 52)"
    rest = f"({scaled} & {_BITS - 1}L)"
    more = f"(({finer} & {_BITS - 1}L) > 0)"
    up = f"({rest} > {_BITS // 2}L OR ({rest} = {_BITS // 2}L AND ({more} OR {cents} % 2 = 1)))"
    rounded = f"({cents} + CASE WHEN {up} THEN 1 ELSE 0 END)"
    high = f"CAST(floor({size} / {_LONG!r}D) AS BIGINT)"
    large = (f"CAST(CAST(CAST({high} AS decimal(19,0)) * {1 << 63}BD AS decimal(38,0)) "
             f"+ CAST({size} - CAST({high} AS DOUBLE) * {_LONG!r}D AS BIGINT) AS decimal(38,0))")
    whole = (f"CASE WHEN {size} < {_LONG!r}D THEN CAST(CAST(floor({size}) AS BIGINT) "
             f"+ shiftright({rounded} + 28, 7) AS STRING) "
             f"WHEN {size} < 8e37D THEN CAST({large} AS STRING) "
             f"ELSE format_string('%.0f', {size}) END")
    text = (f"concat(CASE WHEN startswith(CAST({x} AS STRING), '-') THEN '-' ELSE '' END, {whole}, '.', "
            f"lpad(CAST({rounded} % 100 AS STRING), 2, '0'))")
    return (f"CASE WHEN isnan({x}) THEN 'nan' WHEN {size} = double('inf') "
            f"THEN CASE WHEN {x} < 0 THEN '-inf' ELSE 'inf' END ELSE {text} END")


def _text_number(name: str) -> str:
    """The double that the text column ``name`` reads as (it matches a pattern above)."""
    return f"try_cast(replace(trim(BOTH FROM `{name}`), '_', '') AS double)"


def cell(name: str, dtype: T.DataType, legacy_strings: bool = False) -> Column:
    c = F.col(name)
    empty = F.lit("")
    if name.lower() in PARTNER_ID_COLUMNS:
        if isinstance(dtype, T.StringType):
            as_int = F.expr(f"try_cast(`{name}` AS double)").cast("long").cast("string")
            out = F.coalesce(as_int, c)
        else:
            out = c.cast("long").cast("string")
    elif isinstance(dtype, T.NumericType):
        out = F.expr(printed(f"CAST(`{name}` AS DOUBLE)"))
    elif isinstance(dtype, T.BooleanType):
        out = F.when(c, F.lit("1.00")).otherwise(F.lit("0.00"))
    elif isinstance(dtype, T.StringType) and legacy_strings:
        number = c.rlike(NUMERIC_TEXT) | c.rlike(SPECIAL_TEXT)
        out = F.when(number, F.expr(printed(_text_number(name)))).otherwise(c)
    else:
        out = c.cast("string")
    return F.when(c.isNull(), empty).otherwise(F.coalesce(out, empty)).alias(name)


def report_cells(df: DataFrame, legacy_strings: bool = False) -> DataFrame:
    """Every column of ``df`` as formatted text, same names and order."""
    return df.select(*[cell(f.name, f.dataType, legacy_strings) for f in df.schema.fields])
