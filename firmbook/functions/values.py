"""Column expressions for texts, numbers and keys of the registry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_LENGTH = 8


def establishment_key(
    base: str | Column = "cnpj_basico",
    order: str | Column = "cnpj_ordem",
    check: str | Column = "cnpj_dv",
) -> Column:
    """The 14-character id; null if any of its parts is."""
    return F.concat(base, order, check)


def company_key(establishment: str | Column = "CNPJ") -> Column:
    """The company id an establishment id starts with."""
    return F.left(establishment, F.lit(KEY_LENGTH))


def clip_text(text: str | Column, length: int) -> Column:
    """At most the first ``length`` characters; empty text for null."""
    return F.coalesce(F.substring(text, 1, length), F.lit(""))


def decimal_comma(text: str | Column) -> Column:
    """``1234,50`` as a double; null if the text is no number."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast(T.DoubleType())


def amount_or_zero(text: str | Column) -> Column:
    """Like :func:`decimal_comma`, with 0.0 for blank, null and unreadable text."""
    text = F.col(text) if isinstance(text, str) else text
    blank = (text == "") | text.isNull()
    return F.coalesce(F.when(blank, F.lit(0.0)).otherwise(decimal_comma(text)), F.lit(0.0))


def round_places(value: str | Column, places: int = 2) -> Column:
    """Round a double to decimal places, halves away from zero.

    The scaled double decides, so that 8201.925, which is stored a little
    below that, scales and rounds as it does in other engines; ``F.round``
    would go by its shortest decimal text.
    """
    value = F.col(value) if isinstance(value, str) else value
    scale = float(10**places)
    return F.round(value * scale) / scale


def compact_date(text: str | Column) -> Column:
    """``yyyyMMdd`` text as a date; null for ``0`` and days that do not exist."""
    return F.try_to_date(text, "yyyyMMdd")


def conform_value(value: Column, kind: T.DataType, nullable: bool = True) -> Column:
    """Bring a value to a declared type the way a lenient database load does.

    Text is cut to its declared width, a number that does not fit is null, text
    that may not be null becomes empty.
    """
    if isinstance(kind, T.VarcharType):
        cut = F.substring(value.cast("string"), 1, kind.length)
        return cut if nullable else F.coalesce(cut, F.lit(""))
    if isinstance(kind, T.DateType):
        return value
    return value.try_cast(kind)


def sql_text(text: str) -> str:
    """``text`` as a literal within a SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
