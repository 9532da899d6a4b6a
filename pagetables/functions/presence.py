"""Is a field there? Two rules, for typed columns and for VARIANT values taken from JSON lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRESENCE_RULES = ("truthy", "filled")

# JSON text of the values that count as false.
FALSY_JSON = ("null", "false", "0", '""', "[]", "{}")


def variant_truthy(value: Column) -> Column:
    """Numbers go by their value: zero in any spelling is false."""
    is_number = F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    zero = F.coalesce(is_number & (F.try_variant_get(value, "$", "double") == 0), F.lit(False))
    return F.coalesce(~F.to_json(value).isin(*FALSY_JSON) & ~zero, F.lit(False))


def variant_text(value: Column) -> Column:
    """The value when it is a JSON string, else null."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def is_truthy(value: Column, data_type: T.DataType) -> Column:
    """Not null, not empty, not zero, not false."""
    if isinstance(data_type, T.VariantType):
        return variant_truthy(value)
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(value) > 0, F.lit(False))
    if isinstance(data_type, T.BooleanType):
        return F.coalesce(value, F.lit(False))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(value != 0, F.lit(False))
    if isinstance(data_type, T.StringType):
        return F.coalesce(value != "", F.lit(False))
    return value.isNotNull()


def is_filled(value: Column, data_type: T.DataType) -> Column:
    """Not null and not the empty string; zero and false count as filled."""
    if isinstance(data_type, T.VariantType):
        return F.coalesce(~F.to_json(value).isin("null", '""'), F.lit(False))
    if isinstance(data_type, T.StringType):
        return F.coalesce(value != "", F.lit(False))
    return value.isNotNull()


def is_present(value: Column, data_type: T.DataType, rule: str) -> Column:
    if rule not in PRESENCE_RULES:
        raise ValueError(f"presence must be one of {PRESENCE_RULES}, not {rule!r}")
    return (is_truthy if rule == "truthy" else is_filled)(value, data_type)


def text_of(value: Column, data_type: T.DataType) -> Column:
    """The text of a string field; values of any other type give null."""
    if isinstance(data_type, T.VariantType):
        return variant_text(value)
    if isinstance(data_type, T.StringType):
        return value
    return F.lit(None).cast("string")
