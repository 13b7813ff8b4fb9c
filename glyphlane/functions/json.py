"""JSON cells read as strictly as Python's json module reads them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_json(text: Column) -> Column:
    """Variant of a JSON text, NULL for anything else.

    The parser stops at the end of the first value and would accept text behind
    it. Inside an object and inside a list such a tail cannot pass both times.
    """
    member = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    entry = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(entry.isNotNull(), F.try_variant_get(member, "$.v", "variant"))


def kind(value: Column) -> Column:
    """Leading word of a variant's type: ARRAY, OBJECT, STRING, BIGINT, ..."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
