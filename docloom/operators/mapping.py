"""A declared mapping applied to JSON documents: typed columns, ignored names, quarantine.

A mapping is a list of ``Field``. Semantics are fixed here: a value that cannot take its type is
malformed and either ignored, with its name kept in ``_ignored``, or sends the document to
quarantine. Everything is one projection over one parse of each document.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.analysis import standard_lower
from docloom.functions.rows import held, let
from docloom.functions.values import (
    body_of, field_path, geo_point_subtype, nodes, number_mode, parse_document, steps, value_type, walk,
)

# Declared type and the Spark type of its column.
COLUMN_TYPES = {
    "long": "bigint",
    "integer": "int",
    "short": "smallint",
    "byte": "tinyint",
    "double": "double",
    "float": "float",
    "half_float": "float",
    "scaled_float": "bigint",
    "keyword": "string",
    "text": "string",
    "ip": "string",
    "boolean": "boolean",
    "binary": "binary",
    "date": "timestamp",
    "integer_range": "struct<gte:int,lte:int>",
    "long_range": "struct<gte:bigint,lte:bigint>",
    "float_range": "struct<gte:float,lte:float>",
    "double_range": "struct<gte:double,lte:double>",
    "date_range": "struct<gte:timestamp,lte:timestamp>",
    "ip_range": "struct<gte:string,lte:string>",
    "dense_vector": "array<float>",
    "sparse_vector": "map<string,float>",
    "rank_features": "map<string,float>",
    "rank_feature": "float",
    "null": "bigint",
    "object": "variant",
    "nested": "array<variant>",
    "flattened": "map<string,string>",
    "geo_point": "struct<lat:double,lon:double>",
    "geo_shape": "variant",
    "completion": "array<struct<input:string,weight:bigint>>",
    "token_count": "int",
    "join": "struct<name:string,parent:string>",
    "alias": "variant",
    "murmur3": "bigint",
}
# Ranges but for dates, and the type of their ends.
RANGE_ENDS = {
    "integer_range": "int", "long_range": "bigint", "float_range": "float",
    "double_range": "double", "ip_range": "string",
}
WHOLE_TYPES = ("long", "integer", "short", "byte")
FRACTION_TYPES = ("double", "float", "half_float", "rank_feature")
TEXT_TYPES = ("keyword", "text", "ip")


@dataclass(frozen=True)
class Field:
    """One mapped field. ``path`` starts at the body, such as ``$.info.seg``.

    ``many`` makes the column an array: any field may hold one value or several.
    """

    name: str
    path: str
    type: str
    coerce: bool = True
    ignore_malformed: bool = False
    null_value: object = None
    ignore_above: int | None = None
    scaling_factor: float | None = None
    format: str = "yyyy/MM/dd"
    many: bool = False

    @property
    def column_type(self) -> str:
        if self.type not in COLUMN_TYPES:
            raise ValueError(f"field {self.name}: unknown type {self.type}")
        return f"array<{COLUMN_TYPES[self.type]}>" if self.many else COLUMN_TYPES[self.type]


def to_whole(v: Column, spark_type: str, coerce: bool = True) -> Column:
    """Whole number from a JSON value.

    With ``coerce`` numeric text counts and fractions are cut off; without it only whole
    numbers do. Anything else, and a number too large for the type, is NULL.
    """
    kind = value_type(v)
    double = F.try_variant_get(v, "$", "double")
    cut = F.coalesce(F.try_variant_get(v, "$", "bigint"), double.try_cast("bigint"))
    whole = (kind == "number") & (double == F.floor(double).cast("double"))
    usable = kind.isin("number", "string") if coerce else whole
    return F.when(usable, cut.try_cast(spark_type))


def to_fraction(v: Column, spark_type: str = "double", coerce: bool = True) -> Column:
    """Floating number from a JSON value; numeric text counts with ``coerce``."""
    usable = value_type(v).isin("number", "string") if coerce else value_type(v) == "number"
    return F.when(usable, F.try_variant_get(v, "$", "double").try_cast(spark_type))


def scaled(v: Column, factor: float, coerce: bool = True) -> Column:
    """The number times ``factor``, rounded, as BIGINT."""
    return F.round(to_fraction(v, "double", coerce) * F.lit(factor)).try_cast("bigint")


def to_text(v: Column) -> Column:
    """Text of a scalar; containers are malformed."""
    scalar = value_type(v).isin("string", "number", "boolean")
    return F.when(scalar, F.try_variant_get(v, "$", "string"))


def to_date(text: Column, formats: str) -> Column:
    """Timestamp by the first of the ``||``-separated patterns that fits."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats.split("||")])


def to_boolean(v: Column) -> Column:
    """true, false, or one of these words."""
    text = to_text(v)
    return F.when(text.isin("true", "false"), text == "true")


def typed(v: Column, field: Field) -> Column:
    """The value in its declared type; NULL when missing, null, or malformed.

    A field of many values is malformed if one of them is; nulls among them are left out.
    """
    target = field.column_type
    if field.many:
        one = replace(field, many=False)
        given = F.filter(
            F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)),
            lambda e: value_type(e) != "null",
        )
        read = F.transform(given, lambda e: typed(e, one))
        good = F.forall(read, lambda x: x.isNotNull())
        return F.when(v.isNotNull() & (value_type(v) != "null") & good, read)
    if field.type == "null":
        return to_whole(v, target, field.coerce)
    if field.type == "object":
        return F.when(value_type(v) == "object", v)
    if field.type in ("geo_shape", "alias"):
        return F.when(value_type(v) != "null", v)
    if field.type == "nested":
        items = F.coalesce(F.try_variant_get(v, "$", target), F.array(v))
        return F.when(F.forall(items, lambda e: value_type(e) == "object"), items)
    if field.type == "flattened":
        return F.when(value_type(v) == "object", _flat(v))
    if field.type == "geo_point":
        return geo_point(v, geo_point_subtype(v))
    if field.type == "completion":
        return _completion(v, target)
    if field.type == "token_count":
        return F.size(standard_lower(to_text(v)))
    if field.type == "join":
        named = F.struct(
            F.try_variant_get(v, "$.name", "string").alias("name"),
            F.try_variant_get(v, "$.parent", "string").alias("parent"),
        )
        plain = F.struct(to_text(v).alias("name"), F.lit(None).cast("string").alias("parent"))
        return F.when(value_type(v) == "string", plain).when(named["name"].isNotNull(), named)
    if field.type == "murmur3":
        return F.hash(to_text(v)).cast(target)
    if field.type in WHOLE_TYPES:
        return to_whole(v, target, field.coerce)
    if field.type in FRACTION_TYPES:
        return to_fraction(v, target, field.coerce)
    if field.type == "scaled_float":
        return scaled(v, field.scaling_factor, field.coerce)
    if field.type in TEXT_TYPES:
        return to_text(v)
    if field.type == "boolean":
        return to_boolean(v)
    if field.type == "binary":
        return F.try_to_binary(to_text(v), F.lit("base64"))
    if field.type == "date":
        return to_date(to_text(v), field.format)
    if field.type == "date_range":
        return range_of(v, lambda end: to_date(to_text(end), field.format))
    if field.type in RANGE_ENDS:
        end_type = RANGE_ENDS[field.type]
        if end_type in ("int", "bigint"):
            return range_of(v, lambda end: to_whole(end, end_type, field.coerce))
        if end_type in ("float", "double"):
            return range_of(v, lambda end: to_fraction(end, end_type, field.coerce))
        return range_of(v, to_text)
    return F.try_variant_get(v, "$", target)


def _flat(v: Column) -> Column:
    """Path to text of every leaf of an object; nulls are left out."""
    leaves = F.transform(
        F.filter(nodes(v, F.lit("")), lambda n: ~value_type(n["value"]).isin("object", "array", "null")),
        lambda n: F.struct(
            F.regexp_replace(n["path"], r"^\.", ""), F.try_variant_get(n["value"], "$", "string")
        ),
    )
    return F.map_from_entries(leaves)


def _completion(v: Column, target: str) -> Column:
    """Inputs with their weight: text, an object whose input is one text or several, or an array."""
    whole = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))

    def entries(e: Column) -> Column:
        given = F.try_variant_get(e, "$.input", "variant")
        inputs = F.coalesce(F.try_variant_get(given, "$", "array<variant>"), F.array(given))
        weight = F.try_variant_get(e, "$.weight", "bigint")
        several = F.transform(inputs, lambda i: F.struct(to_text(i).alias("input"), weight.alias("weight")))
        single = F.array(F.struct(to_text(e).alias("input"), F.lit(None).cast("bigint").alias("weight")))
        return F.when(value_type(e) == "object", several).otherwise(single)

    found = F.flatten(F.transform(whole, entries))
    good = F.forall(found, lambda e: e["input"].isNotNull())
    return F.when((value_type(v) != "null") & good, found.cast(target))


def range_of(v: Column, read: Callable[[Column], Column]) -> Column:
    """Range from an object with ``gte`` and ``lte``. An end that is missing or null is open; one
    that is there and cannot be read makes the range malformed, so NULL."""
    def end(name: str) -> Column:
        there = lambda x: x.isNotNull() & (value_type(x) != "null")
        return let(
            F.try_variant_get(v, f"$.{name}", "variant"),
            lambda x: F.struct(F.when(there(x), read(x)).alias("value"), there(x).alias("there")),
        )

    def good(e: Column) -> Column:
        return ~e["there"] | e["value"].isNotNull()

    ends = F.struct(end("gte").alias("gte"), end("lte").alias("lte"), value_type(v).alias("kind"))
    return let(ends, lambda r: F.when(
        (r["kind"] == "object") & good(r["gte"]) & good(r["lte"]),
        F.struct(r["gte"]["value"].alias("gte"), r["lte"]["value"].alias("lte")),
    ))


def apply_mapping(docs: DataFrame, mapping: list[Field], *keep: str) -> DataFrame:
    """Typed columns beside ``keep``, with ``_ignored`` and ``_malformed`` field names.

    A document with a non-empty ``_malformed`` belongs in quarantine; one whose text is not one whole
    object has ``_source`` there. An explicit null takes ``null_value``, a missing field does not; text
    longer than ``ignore_above`` becomes NULL. See ``observed_arrays`` for fields of several values.
    """
    body = held(docs.select(*keep, body_of(docs).alias("_body")), "_body")
    raw = [F.try_variant_get("_body", f.path, "variant").alias(f"_v_{f.name}") for f in mapping]
    object_ = F.try_variant_get("_body", "$", "map<string,variant>").isNotNull()
    values = body.select(*keep, *raw, object_.alias("_whole"))
    values = values.select(
        "*", *[typed(F.col(f"_v_{f.name}"), f).alias(f"_t_{f.name}") for f in mapping]
    )

    def _constant(f: Field) -> Column:
        one = F.lit(f.null_value).cast(COLUMN_TYPES[f.type])
        return F.array(one) if f.many else one

    def column(f: Field) -> Column:
        value = F.col(f"_t_{f.name}")
        if f.null_value is not None:
            is_null = value_type(F.col(f"_v_{f.name}")) == "null"
            value = F.when(is_null, _constant(f)).otherwise(value)
        if f.ignore_above is not None:
            short = lambda x: F.length(x) <= f.ignore_above
            value = F.filter(value, short) if f.many else F.when(short(value), value)
        return value.alias(f.name)

    def bad(ignored: bool) -> Column:
        names = [
            F.when(
                (value_type(F.col(f"_v_{f.name}")) != "null") & F.col(f"_t_{f.name}").isNull(),
                F.lit(f.name),
            )
            for f in mapping
            if f.ignore_malformed == ignored
        ]
        if not ignored:
            names.append(F.when(~F.col("_whole"), "_source"))
        found = F.array(*names) if names else F.array().cast("array<string>")
        return F.filter(found, lambda name: name.isNotNull())

    return values.select(
        *keep, *[column(f) for f in mapping],
        bad(True).alias("_ignored"), bad(False).alias("_malformed"),
    )


def is_quarantined() -> Column:
    """Marks mapped documents with a malformed field that was not to be ignored."""
    return F.size("_malformed") > 0


def observed_arrays(docs: DataFrame, mapping: list[Field]) -> list[Field]:
    """The mapping with ``many`` set for every field that holds an array in some document.

    A field may hold one value or several without saying so; one pass over the documents tells which
    do. A flag per mapped field reaches the driver. Types that take arrays as one value keep their form.
    """
    own = ("geo_point", "geo_shape", "completion", "nested", "dense_vector", "alias")
    asked = [f for f in mapping if not f.many and f.type not in own]
    if not asked:
        return mapping
    body = docs.select(body_of(docs).alias("_body"))
    flags = body.agg(*[
        F.max(F.try_variant_get("_body", f.path, "array<variant>").isNotNull()).alias(f"f{i}")
        for i, f in enumerate(asked)
    ]).first()
    several = {f.name for i, f in enumerate(asked) if flags[i]}
    return [replace(f, many=True) if f.name in several else f for f in mapping]


def dynamic_policy(docs: DataFrame, mapped: list[str], policy: str) -> DataFrame:
    """Handle keys the mapping does not know; ``unmapped`` lists them in text order.

    ``true`` adds them with an inferred type (``added``: key to class and width), ``runtime``
    keeps their values undecided (``runtime``: key to VARIANT), ``false`` ignores them, and
    ``strict`` marks the document as ``rejected``. Under every policy text that is not one whole object
    is rejected, and has no unmapped keys (NULL).
    """
    if policy not in ("true", "runtime", "false", "strict"):
        raise ValueError(f"unknown policy {policy}")
    members = F.try_variant_get(body_of(docs), "$", "map<string,variant>")
    keys = F.col("_keys") if "_keys" in docs.columns else F.json_object_keys("raw")
    known = F.array(*map(F.lit, mapped)).cast("array<string>")
    unknown = held(docs.withColumn("_members", members), "_members")
    unknown = held(
        unknown.withColumn("unmapped", F.when(F.col("_members").isNotNull(), F.array_except(keys, known))), "unmapped"
    )
    rejected = F.col("_members").isNull()
    if policy == "strict":
        rejected = rejected | (F.size("unmapped") > 0)
    unknown = unknown.withColumn("rejected", rejected)
    if policy in ("true", "runtime"):
        # The keys of a whole object are those of its members, so the known ones tell the rest.
        found = F.map_filter("_members", lambda key, _: ~F.array_contains(known, key))
        if policy == "true":
            found = F.transform_values(
                found,
                lambda _, v: F.when(
                    value_type(v) == "number", number_mode(F.try_variant_get(v, "$", "double"))
                ).otherwise(value_type(v)),
            )
        unknown = unknown.withColumn("added" if policy == "true" else "runtime", found)
    return unknown.drop("_members")


def enabled_false(docs: DataFrame, path: str, name: str) -> DataFrame:
    """The object at ``path`` kept as text, neither typed nor checked; NULL where the document is not
    one whole object."""
    whole = F.try_variant_get(body_of(docs), "$", "map<string,variant>").isNotNull()
    return docs.withColumn(name, F.when(whole, F.get_json_object("raw", path)))


def copy_targets(paths: list[str], target: str) -> list[str]:
    """Every mapped path whose last step is ``target``; a dotted target names nothing."""
    return [p for p in paths if "[" not in p and p.split(".")[-1] == target and "." not in target]


def copy_to(rows: DataFrame, sources: list[str], targets: list[str]) -> DataFrame:
    """Add one array column per target with the non-null source values, in declared order."""
    values = F.array_compact(F.array(*[F.col(s).cast("string") for s in sources]))
    return rows.withColumns({target: values for target in targets})


def alias_path(targets: list[str]) -> str:
    """Path an alias stands for: the first target, without array steps and the leading body name."""
    steps = [s for s in re.sub(r"\[[0-9]*\]", "", targets[0]).split(".") if s]
    return "$." + ".".join(steps[1:] if steps[0] == "_source" else steps)


def alias_field(docs: DataFrame, name: str, targets: list[str], spark_type: str) -> DataFrame:
    """Read a field under a second name."""
    value = F.try_variant_get(parse_document(F.col("raw")), alias_path(targets), spark_type)
    return docs.withColumn(name, value)


def multi_fields(rows: DataFrame, source: str, fields: dict[str, Column]) -> DataFrame:
    """Further columns ``source.name``, each its own reading of the same source."""
    return rows.withColumns({f"{source}.{name}": column for name, column in fields.items()})


def nested_explode(docs: DataFrame, path: str, columns: dict[str, str], *keep: str) -> DataFrame:
    """One row per object of a nested array, with ``pos``; documents without any keep one row."""
    items = F.try_variant_get(parse_document(F.col("raw")), path, "array<variant>")
    exploded = docs.select(*keep, F.posexplode_outer(items).alias("pos", "item"))
    return exploded.select(
        *keep, "pos",
        *[F.try_variant_get("item", f"$.{name}", t).alias(name) for name, t in columns.items()],
    )


def flattened_leaves(
    docs: DataFrame, path: str, *keep: str,
    depth_limit: int | None = None, null_value: str | None = None, ignore_above: int | None = None,
) -> DataFrame:
    """Leaves of the object at ``path`` as ``(leaf_path, leaf)`` text rows.

    An explicit null takes ``null_value`` or is left out, as is text longer than
    ``ignore_above``. A leaf nested deeper than ``depth_limit``, if one is given, raises.
    """
    body = F.try_variant_get(body_of(docs), path, "variant")
    bodies = docs.select(*keep, body.alias("body"))
    found = walk(
        bodies, F.col("body"), F.lit("$"), *keep, values=lambda _, type_: ~type_.isin("object", "array")
    )
    text = F.when(F.col("type") == "null", F.lit(null_value)).otherwise(
        F.try_variant_get("value", "$", "string")
    )
    field = field_path(F.col("path"))
    checked = F.regexp_replace(field, r"^\$\.?", "")
    if depth_limit is not None:
        too_deep = F.size(steps(field, "$")) > depth_limit
        checked = F.when(too_deep, F.raise_error(F.lit("object nested too deep"))).otherwise(checked)
    leaves = found.where(~F.col("type").isin("object", "array")).select(
        *keep, checked.alias("leaf_path"), text.alias("leaf")
    )
    leaves = leaves.where(F.col("leaf").isNotNull())
    return leaves if ignore_above is None else leaves.where(F.length("leaf") <= ignore_above)


def range_contains(rows: DataFrame, field: str, x: Column) -> DataFrame:
    """Rows whose range holds the value, both ends included; an open end holds everything."""
    low, high = F.col(f"{field}.gte"), F.col(f"{field}.lte")
    return rows.where((low.isNull() | (low <= x)) & (high.isNull() | (x <= high)))


def geo_normalize(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``struct<lat, lon>`` from decimal text, array (lon first) or object; else NULL.

    The encoding is found once per row, as a column of its own.
    """
    found = rows.withColumn("_subtype", geo_point_subtype(F.col(value)))
    return found.withColumn(name, geo_point(F.col(value), F.col("_subtype"))).drop("_subtype")


def geo_point(v: Column, subtype: Column) -> Column:
    """``struct<lat, lon>`` of a point given by text, array or object; NULL for other encodings."""
    pair = F.split(F.try_variant_get(v, "$", "string"), ",")

    def coordinate(place: int, item: str, member: str) -> Column:
        return (
            F.when(subtype == "string", F.trim(F.get(pair, place)).try_cast("double"))
            .when(subtype == "geoJSON", F.try_variant_get(v, item, "double"))
            .when(subtype == "object", F.try_variant_get(v, member, "double"))
        )

    point = F.struct(
        coordinate(0, "$[1]", "$.lat").alias("lat"), coordinate(1, "$[0]", "$.lon").alias("lon")
    )
    known = subtype.isin("string", "geoJSON", "object")
    return F.when(known & point["lat"].isNotNull() & point["lon"].isNotNull(), point)


def keyword_normalizer(x: Column) -> Column:
    """Lower-case, trimmed form of a keyword, for grouping."""
    return F.lower(F.trim(x))


def sample_generate(ids: DataFrame, id_column: str, schema: dict[str, str]) -> DataFrame:
    """One generated document per id, each field a fixed function of the id and the type.

    Whole numbers count up modulo their width, fractions are halves, booleans alternate, text
    carries the id, and other types get a hash of id and field name.
    """
    i = F.col(id_column)

    def value(name: str, type_: str) -> Column:
        if type_ in WHOLE_TYPES:
            limit = {"byte": 127, "short": 32767}.get(type_, 2_147_483_647)
            return F.pmod(i, F.lit(limit)).cast(COLUMN_TYPES[type_])
        if type_ in FRACTION_TYPES:
            return (i / F.lit(2.0)).cast(COLUMN_TYPES[type_])
        if type_ == "boolean":
            return i % 2 == 0
        if type_ in TEXT_TYPES:
            return F.concat(F.lit(f"{name}-"), i.cast("string"))
        return F.xxhash64(i, F.lit(name))

    return ids.select(i, *[value(n, t).alias(n) for n, t in schema.items()])
