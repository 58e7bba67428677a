"""Bringing a table to declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmbook.functions.values import conform_value


def conform(df: DataFrame, table: T.StructType) -> DataFrame:
    """Select the declared columns ``df`` has, each brought to its declared type.

    A declared timestamp that ``df`` lacks is the load time.
    """
    columns = []
    for field in table.fields:
        if field.name in df.columns:
            value = conform_value(F.col(field.name), field.dataType, field.nullable)
        elif isinstance(field.dataType, T.TimestampType):
            value = F.current_timestamp()
        else:
            continue
        columns.append(value.alias(field.name))
    return df.select(*columns)

