"""Strict JSON on top of the VARIANT type.

``try_parse_json`` stops at the end of the first value, so ``{"a":1} x`` passes.
A line counts as JSON only if it also parses as the single element of an array
and as the single field of an object, which no trailing text survives.

``spark.sql.variant.allowDuplicateKeys`` must be on (see ``prepare_session``),
else an object with a repeated field is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reasons a line is refused.
INVALID_JSON = "invalid JSON"
MISSING_FIELD = "missing field"
NOT_A_STRING = "not a string"
EMPTY_TEXT = "empty text"
TOO_LARGE = "value above 128 MiB"

#: The most bytes that Spark parses into one VARIANT.
VARIANT_BYTES = 128 << 20
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def strict_json(line: Column) -> Column:
    """The line as VARIANT, null when it is not exactly one JSON value."""
    in_array = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), line, F.lit("}")))
    fields = F.try_variant_get(in_object, "$", "map<string,variant>")

    def only_element(array: Column) -> Column:
        first = F.try_variant_get(array, "$[0]", "variant")
        second = F.try_variant_get(array, "$[1]", "variant")
        return F.when(second.isNull() & (F.size(fields) == 1), first)

    # the function gives the parsed line a name, so that it is parsed once
    return F.transform(F.array(in_array), only_element)[0]


def strict_elements(line: Column) -> Column:
    """The elements of a line that is exactly one JSON array, else null.

    Every element is a VARIANT of its own, so the array may be of any size.
    """
    inside = F.from_json(
        F.concat(F.lit("["), line, F.lit("]")), "array<array<variant>>", _STRICT
    )
    field = F.from_json(
        F.concat(F.lit('{"v":'), line, F.lit("}")), "v array<variant>", _STRICT
    )

    def only(arrays: Column) -> Column:
        return F.when((F.size(arrays) == 1) & field["v"].isNotNull(), arrays[0])

    return F.transform(F.array(inside), only)[0]


def is_too_large(line: Column) -> Column:
    """Whether a line that did not parse may be JSON with a value above the limit."""
    return F.octet_length(line) > VARIANT_BYTES


def json_items(line: Column) -> Column:
    """The elements of an array, or the one other value; null when the line is not JSON.

    A line with a value above the limit is an error, as nobody can say what it holds.
    """
    single = F.transform(F.array(strict_json(line)), lambda v: F.when(v.isNotNull(), F.array(v)))
    items = F.when(line.rlike(r"^[ \t\r\n]*\["), strict_elements(line)).otherwise(single[0])
    failed = F.raise_error(F.lit(f"JSON with a {TOO_LARGE}"))

    def loud(found: Column) -> Column:
        return F.when(found.isNull() & is_too_large(line), failed).otherwise(found)

    return F.transform(F.array(items), loud)[0]


def with_json(df: DataFrame, line: Column, name: str) -> DataFrame:
    """Add the parsed line as a VARIANT column, with the generator of ``with_items``."""
    return df.select("*", F.explode(F.array(strict_json(line))).alias(name))


def with_loud_json(df: DataFrame, line: Column, name: str) -> DataFrame:
    """Like ``with_json``, where a value above the limit is an error, as nobody can say what it holds."""
    failed = F.raise_error(F.lit(f"JSON with a {TOO_LARGE}"))

    def loud(found: Column) -> Column:
        return F.when(found.isNull() & is_too_large(line), failed).otherwise(found)

    return df.select("*", F.explode(F.transform(F.array(strict_json(line)), loud)).alias(name))


def with_items(df: DataFrame, line: Column, name: str) -> DataFrame:
    """Add what ``json_items`` gives as a column.

    The generator keeps the optimizer from copying the parser into every later use.
    """
    return df.select("*", F.explode(F.array(json_items(line))).alias(name))


def json_kind(value: Column) -> Column:
    """``object``, ``array``, ``string`` or ``other``; null for a null VARIANT."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string")
        .when(kind.isNotNull(), "other")
    )


def field_path(name: str) -> str:
    """A path to one field; paths know two kinds of quotes but no escapes."""
    quote = "'" if "'" not in name else '"'
    if quote in name:
        raise ValueError(f"field name with both kinds of quotes: {name}")
    return f"$[{quote}{name}{quote}]"


def field_of(value: Column, name: str) -> Column:
    """The named field of a JSON object as VARIANT, null when absent."""
    return F.try_variant_get(value, field_path(name), "variant")


def string_of(value: Column) -> Column:
    """A VARIANT string as STRING; numbers and the like give null, not their digits."""
    return F.when(
        F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")
    )


def text_field(value: Column, name: str) -> Column:
    return string_of(field_of(value, name))
