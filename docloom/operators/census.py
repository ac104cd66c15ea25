"""Counts of value classes per collection and field, from loosely typed JSON values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import values as V
from docloom.operators.profile import fields

# Declared types with the family they belong to; the type itself is the mode.
NUMBER_TYPES = ("long", "integer", "short", "byte", "double", "float", "half_float", "scaled_float")
STRING_TYPES = ("keyword", "text")
RANGE_TYPES = (
    "integer_range", "float_range", "long_range", "double_range", "date_range", "ip_range",
)
# Declared types that are their own family, without a mode.
PLAIN_TYPES = (
    "null", "boolean", "binary", "nested", "date", "token_count", "murmur3", "annotated_text",
    "percolator", "ip", "dense_vector", "sparse_vector", "alias", "rank_feature", "rank_features",
    "join", "flattened",
)


def _count(rows: DataFrame, subtype: Column, name: str) -> DataFrame:
    return (
        rows.withColumn(name, subtype)
        .groupBy("_index", "key", name)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def value_type_census(docs: DataFrame) -> DataFrame:
    """Values per field and class."""
    return _count(fields(docs), F.col("type"), "type")


def number_mode_census(docs: DataFrame) -> DataFrame:
    """Numbers per field and width class."""
    numbers = fields(docs).where(F.col("type") == "number")
    return _count(numbers, V.number_mode(F.try_variant_get("value", "$", "double")), "mode")


def _subtype_census(docs: DataFrame, key: str, subtype) -> DataFrame:
    return _count(fields(docs).where(F.col("key") == key), subtype(F.col("value")), "subtype")


def geo_point_census(docs: DataFrame, key: str) -> DataFrame:
    """Values of a point field per encoding; NULL counts the explicit nulls."""
    return _subtype_census(docs, key, V.geo_point_subtype)


def geo_shape_census(docs: DataFrame, key: str) -> DataFrame:
    """Values of a shape field per shape; NULL counts nulls and texts naming no shape."""
    return _subtype_census(docs, key, V.geo_shape_subtype)


def completion_census(docs: DataFrame, key: str) -> DataFrame:
    """Values of a completion field per form."""
    return _subtype_census(docs, key, V.completion_subtype)


def family(declared: Column, by_value: Column) -> Column:
    """Family of a field from its declared type, or from its value's class when none is known."""
    return (
        F.when(declared.isin(*NUMBER_TYPES), "number")
        .when(declared.isin(*STRING_TYPES), "string")
        .when(declared.isin(*RANGE_TYPES), "range")
        .when(declared.isin(*PLAIN_TYPES), declared)
        .when(declared == "completion", "completion")
        .when(declared == "geo_point", "geo-point")
        .when(declared == "geo_shape", "geo-shape")
        # Without a usable declaration null counts as an object.
        .when(by_value == "null", "object")
        .otherwise(by_value)
    )


def mode(declared: Column, by_value: Column, value: Column, number: Column) -> Column:
    """Mode or subtype inside the family; NULL where the family has none."""
    known = [*NUMBER_TYPES, *STRING_TYPES, *RANGE_TYPES]
    return (
        F.when(declared.isin(*known), declared)
        .when(declared.isin(*PLAIN_TYPES), F.lit(None).cast("string"))
        .when(declared == "completion", V.completion_subtype(value))
        .when(declared == "geo_point", V.geo_point_subtype(value))
        .when(declared == "geo_shape", V.geo_shape_subtype(value))
        .when(by_value == "string", "text")
        .when(by_value == "number", V.number_mode(number))
    )


def type_family(docs: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Values per path, family and mode, over every path found in the documents.

    ``declared`` maps paths to types; it is a schema, so it travels as a literal map. An array is
    one value; members of the objects inside it are counted under the path without positions.
    """
    pairs = [F.lit(x) for item in declared.items() for x in item]
    types = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    # Only these families look into a container.
    looked = [path for path, type_ in declared.items() if type_ in ("completion", "geo_point", "geo_shape")]
    found = V.document_nodes(
        docs, "$", "_index",
        values=lambda path, type_: ~type_.isin("object", "array") | V.field_path(path).isin(*looked),
    )
    rows = found.where(V.is_member(F.col("path"))).select(
        "_index", V.field_path(F.col("path")).alias("path"), "type", "value",
        F.try_variant_get("value", "$", "double").alias("number"),
    )
    rows = rows.withColumn("declared", F.element_at(types, F.col("path")))
    by_value = F.col("type")
    return (
        rows.withColumn("family", family(F.col("declared"), by_value))
        .withColumn("mode", mode(F.col("declared"), by_value, F.col("value"), F.col("number")))
        .groupBy("_index", "path", "family", "mode")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
