"""Column expressions that classify JSON values held as VARIANT.

Value classes carry the names a JSON parser in a script language gives them:
string, number, boolean, null, array, object.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.session import materialize

# Exclusive upper bounds of the integer widths (value class "number").
BYTE_LIMIT = 127
SHORT_LIMIT = 32767
INTEGER_LIMIT = 2147483647
# Fixed value: from here on a number prints with an exponent and counts as a float.
EXPONENT_LIMIT = 1e21

# Leading words of a well-known-text shape and the subtype each one means.
SHAPE_WORDS = {
    "POINT": "point",
    "LINESTRING": "linestring",
    "POLYGON": "polygon",
    "MULTIPOINT": "multipoint",
    "MULTILINESTRING": "multilinestring",
    "MULTIPOLYGON": "multipolygon",
    "GEOMETRYCOLLECTION": "geometrycollection",
    "BBOX": "envelope",
}
# Fixed value: a decimal "lat,lon" pair anywhere in the text.
DECIMAL_PAIR = r"-?\d+\.\d+,-?\d+\.\d+"


def parse_document(raw: Column) -> Column:
    """VARIANT of one whole JSON value; NULL for bad text, duplicate keys or trailing text.

    The parser stops after the first value, so the text is parsed as the first of two elements of
    an array, with a hash of the text as the second: text that closes the array early, or adds
    elements, cannot know it. The elements are used in every case, so the text is parsed once.
    """
    mark = F.xxhash64(raw)
    wrapped = F.try_parse_json(F.concat(F.lit("["), raw, F.lit(","), mark.cast("string"), F.lit("]")))
    elements = F.try_variant_get(wrapped, "$", "array<variant>")
    whole = (F.size(elements) == 2) & (F.try_variant_get(F.get(elements, 1), "$", "bigint") == mark)
    return F.get(elements, F.when(whole, 0).otherwise(-1))


def parse_object(raw: Column) -> Column:
    """Members of a document's body by key; NULL unless the text is one whole JSON object."""
    return F.try_variant_get(parse_document(raw), "$", "map<string,variant>")


def value_type(v: Column) -> Column:
    """Class name of a JSON value; SQL NULL for a missing one.

    The shape is read once and looked up: inside array functions nothing shares a subexpression.
    """
    shapes = {
        "VOID": "null", "STRING": "string", "BOOLEAN": "boolean", "ARRAY": "array",
        "OBJECT": "object",
    }
    classes = F.create_map(*[F.lit(x) for item in shapes.items() for x in item])
    shape = F.substring_index(F.schema_of_variant(v), "<", 1)
    return F.when(v.isNotNull(), F.coalesce(F.try_element_at(classes, shape), F.lit("number")))


def as_text(v: Column) -> Column:
    """Text of a JSON string, without quotes; NULL for other classes."""
    return F.when(value_type(v) == "string", F.try_variant_get(v, "$", "string"))


def number_mode(x: Column) -> Column:
    """Width class of a DOUBLE: byte, short, integer, long or float.

    Bounds are exclusive on both sides, so 127 is a short and -127 still a byte.
    """
    return (
        F.when((x != F.floor(x).cast("double")) | (F.abs(x) >= F.lit(EXPONENT_LIMIT)), "float")
        .when((x > -(BYTE_LIMIT + 1)) & (x < BYTE_LIMIT), "byte")
        .when((x > -(SHORT_LIMIT + 1)) & (x < SHORT_LIMIT), "short")
        .when((x > -(INTEGER_LIMIT + 1)) & (x < INTEGER_LIMIT), "integer")
        .when(x.isNotNull(), "long")
    )


def _set(v: Column, path: str) -> Column:
    """The member exists and is neither null, false, zero nor empty text."""
    member = F.try_variant_get(v, path, "variant")
    return member.isNotNull() & ~F.to_json(member).isin("null", "false", "0", '""')


def geo_point_subtype(v: Column) -> Column:
    """string, geohash, geoJSON, geo-bounding or object. Null has no subtype here."""
    kind = value_type(v)
    return (
        F.when((kind == "string") & as_text(v).rlike(DECIMAL_PAIR), "string")
        .when(kind == "string", "geohash")
        .when(kind == "array", "geoJSON")
        .when((kind == "object") & _set(v, "$.top_left") & _set(v, "$.bottom_right"), "geo-bounding")
        .when(kind != "null", "object")
    )


def geo_shape_subtype(v: Column) -> Column:
    """Shape name from well-known text or from the ``type`` member; else point.

    A string that starts with none of the words has no subtype, and neither has null.
    """
    kind = value_type(v)
    text = as_text(v)
    by_word = reduce(
        lambda case, word: case.when(
            text.rlike(rf"(?i)^\s*{word}\s*\S"), SHAPE_WORDS[word]
        ),
        SHAPE_WORDS,
        F.when(F.lit(False), F.lit(None).cast("string")),
    )
    return (
        F.when(kind == "string", by_word)
        .when((kind == "object") & _set(v, "$.type"), F.try_variant_get(v, "$.type", "string"))
        .when(kind != "null", "point")
    )


def completion_subtype(v: Column) -> Column:
    """array for arrays, object for everything else that is present."""
    return F.when(value_type(v) == "array", "array").when(v.isNotNull(), "object")


def number_text(v: Column) -> Column:
    """Number as text the way a script prints it, so that one double has one text.

    Whole numbers have plain digits below 1e21 and an exponent from there on.
    """
    x = F.try_variant_get(v, "$", "double")
    large = F.abs(x) >= F.lit(EXPONENT_LIMIT)
    digits = x.try_cast("decimal(38,0)")
    whole = (x == digits.cast("double")) & ~large
    plain = F.to_json(v)
    exponent = F.regexp_replace(F.regexp_replace(x.cast("string"), r"\.0E", "E"), "E", "e+")
    return (
        F.when(whole, digits.cast("string"))
        .when(large, exponent)
        .when(plain.rlike(r"^-?\d+\.\d+$"), F.regexp_replace(plain, r"0+$", ""))
        .otherwise(plain)
    )


def _scalar_text(v: Column) -> Column:
    kind = value_type(v)
    return (
        F.when(kind == "string", F.try_variant_get(v, "$", "string"))
        .when(kind == "number", number_text(v))
        .when(kind == "object", "[object Object]")
        .otherwise(F.to_json(v))
    )


def _leaves(v: Column) -> Column:
    """The elements of an array with nested arrays replaced by theirs, in order, at any depth.

    Every round opens the outermost arrays; there are no more rounds than opening brackets in the
    value's text, and none changes anything once only leaves are left. An empty array is a leaf.
    """

    def elements(e: Column) -> Column:
        inner = F.try_variant_get(e, "$", "array<variant>")
        return F.when(F.size(inner) > 0, inner).otherwise(F.array(e))

    rounds = F.size(F.split(F.to_json(v), r"\["))
    return F.aggregate(
        F.sequence(F.lit(1), rounds), F.array(v),
        lambda found, _: F.flatten(F.transform(found, elements)),
    )


def label_text(v: Column) -> Column:
    """Value coerced to text, as it names a document kind.

    Missing gives ``undefined`` and null gives ``null``; an object gives a fixed literal and
    an array its leaves joined by commas, where null and an empty array are empty text.
    """
    parts = F.transform(
        _leaves(v),
        lambda e: F.when(value_type(e).isin("null", "array"), "").otherwise(_scalar_text(e)),
    )
    return (
        F.when(v.isNull(), "undefined")
        .when(value_type(v) == "array", F.array_join(parts, ","))
        .otherwise(_scalar_text(v))
    )


def _child_path(parent: Column, key: Column) -> Column:
    """Keys that are not plain words are quoted, with brackets escaped: a path stays unambiguous."""
    escaped = F.regexp_replace(key, r'(["\\])', r"\\$1")
    escaped = F.replace(F.replace(escaped, F.lit("["), F.lit(r"\u005b")), F.lit("]"), F.lit(r"\u005d"))
    quoted = F.concat(F.lit('["'), escaped, F.lit('"]'))
    return F.concat(
        parent, F.when(key.rlike(r"^[\p{L}\p{N}_@\-]+$"), F.concat(F.lit("."), key)).otherwise(quoted)
    )


def field_path(path: Column) -> Column:
    """A node's path without array positions."""
    return F.regexp_replace(path, r"\[[0-9]+\]", "")


def is_member(path: Column) -> Column:
    """The node is the member of an object, not the element of an array."""
    return ~path.rlike(r"\[[0-9]+\]$")


def leads_arrays(path: Column) -> Column:
    """The path only ever enters the first element of an array, and no array inside an array."""
    return ~path.rlike(r"\[[1-9][0-9]*\]|\[0\]\[0\]")


# One step of a path: a plain key, a quoted key, or an array position.
_STEP = r'\.[\p{L}\p{N}_@\-]+|\["(?:[^"\\]|\\.)*"\]|\[[0-9]+\]'


def steps(path: Column, root: str) -> Column:
    """The steps of a path below its root."""
    below = F.substring(path, len(root) + 1, 2_147_483_647)
    return F.regexp_extract_all(below, F.lit(_STEP), F.lit(0))


def ancestors(path: Column, root: str) -> Column:
    """Proper ancestors of a path as ``struct<path, step>``, root first; ``step`` is the kind of
    step taken from there: ``key`` or ``item``."""
    found = steps(path, root)
    return F.transform(
        found,
        lambda s, i: F.struct(
            F.concat(F.lit(root), F.array_join(F.slice(found, F.lit(1), i), "")).alias("path"),
            F.when(s.rlike(r"^\[[0-9]"), "item").otherwise("key").alias("step"),
        ),
    )


def nodes(v: Column, root: Column, max_levels: int | None = None) -> Column:
    """Every node of a JSON value at any depth, itself first: ``array<struct<path, value>>``.

    For columns that hold a small object whole; tables of nodes come from ``walk``.
    The number of rounds comes from the brackets in the value's own text, which is never less
    than its depth, so nothing is cut unless ``max_levels`` asks for it. Array functions run
    interpreted, so a node carries only what cannot be derived from it later, and ``v`` and
    ``root`` are mentioned twice: give them as columns, not as costly expressions.
    """

    def node(path: Column, value: Column) -> Column:
        return F.struct(path.alias("path"), value.alias("value"))

    def children(n: Column) -> Column:
        members = F.transform(
            F.map_entries(F.try_variant_get(n["value"], "$", "map<string,variant>")),
            lambda e: node(_child_path(n["path"], e["key"]), e["value"]),
        )
        items = F.transform(
            F.try_variant_get(n["value"], "$", "array<variant>"),
            lambda e, i: node(F.concat(n["path"], F.lit("["), i.cast("string"), F.lit("]")), e),
        )
        return F.coalesce(members, items, F.array().cast(NODES))

    def deeper(acc: Column, _: Column) -> Column:
        frontier = F.slice(acc["all"], acc["next"], F.size(acc["all"]) - acc["next"] + 1)
        grown = F.struct(
            F.concat(acc["all"], F.flatten(F.transform(frontier, children))).alias("all"),
            (F.size(acc["all"]) + 1).alias("next"),
        )
        return F.when(acc["next"] > F.size(acc["all"]), acc).otherwise(grown)

    # Splitting at brackets gives one part more than there are brackets.
    rounds = F.size(F.split(F.to_json(v), r"[{\[]"))
    if max_levels is not None:
        rounds = F.least(rounds, F.lit(max_levels))
    start = F.struct(F.array(node(root, v)).alias("all"), F.lit(1).alias("next"))
    return F.aggregate(F.sequence(F.lit(1), rounds), start, deeper, lambda acc: acc["all"])


NODES = "array<struct<path:string,value:variant>>"


Keep = Callable[[Column, Column], Column]
# Levels that one round of the walk opens; deeper values take further rounds.
LEVELS = 4


def walk(rows: DataFrame, value: Column, path: Column, *keep: str, values: Keep | None = None) -> DataFrame:
    """``keep`` and one row ``(path, type, value)`` per node of a JSON value, itself included.

    The tree is opened level by level, as a table: a lateral ``variant_explode`` a level turns the
    containers among the rows into their members, so the cost is that of the nodes, however wide an
    array is. A container is handed on by its first member, which saves a second look at it. After
    ``LEVELS`` levels what is found is written, and only what is still closed goes on, so that a
    value of any depth is opened whole. A NULL value has no nodes.

    ``values`` says by path and type which nodes carry their value; the others have NULL.
    """
    front = rows.select(F.struct(*keep).alias("_keep"), path.alias("_path"), value.alias("_value"))
    found = None
    while True:
        level = materialize(_opened(front, values), "nodes")
        nodes_ = level.where("NOT closed").select(*[F.col("_keep")[k].alias(k) for k in keep], "path", "type", "value")
        found = nodes_ if found is None else found.unionByName(nodes_)
        rest = level.where("closed")
        if rest.isEmpty():
            return found
        front = rest.select("_keep", F.col("path").alias("_path"), F.col("value").alias("_value"))


def _opened(front: DataFrame, values: Keep | None) -> DataFrame:
    """Nodes of the next ``LEVELS`` levels; ``closed`` ones are containers that go on."""
    tvf = front.sparkSession.tvf

    def node(path: Column, type_: Column, value: Column) -> Column:
        kept = F.lit(None).cast("variant") if values is None else F.when(values(path, type_), value)
        return F.struct(path.alias("path"), type_.alias("type"), kept.alias("value"), F.lit(False).alias("closed"))

    # Containers that a row stands for, being their first member.
    none = F.array().cast("array<struct<path:string,type:string,value:variant,closed:boolean>>")
    level = front.withColumn("_chain", none)
    for _ in range(LEVELS):
        opened = level.lateralJoin(tvf.variant_explode_outer(F.col("_value").outer()))
        inside, member = F.col("pos").isNotNull(), F.col("key").isNotNull()
        parent = node(F.col("_path"), F.when(member, "object").otherwise("array"), F.col("_value"))
        child = F.when(member, _child_path(F.col("_path"), F.col("key"))).otherwise(
            F.concat("_path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))
        )
        level = opened.select(
            "_keep",
            F.when(inside, child).otherwise(F.col("_path")).alias("_path"),
            F.when(inside, F.col("value")).otherwise(F.col("_value")).alias("_value"),
            F.when(~inside, F.col("_chain"))
            .when(F.col("pos") == 0, F.concat("_chain", F.array(parent))).otherwise(none).alias("_chain"),
        )
    last = level.withColumn("_type", value_type(F.col("_value")))
    closed = F.col("_type").isin("object", "array") & ~F.to_json("_value").isin("{}", "[]")
    whole = F.struct(
        F.col("_path").alias("path"), F.col("_type").alias("type"), F.col("_value").alias("value"),
        F.lit(True).alias("closed"),
    )
    own = F.when(closed, whole).otherwise(node(F.col("_path"), F.col("_type"), F.col("_value")))
    every = last.select("_keep", F.explode_outer(F.concat("_chain", F.array(own))).alias("_node"))
    return every.where(F.col("_node.type").isNotNull()).select("_keep", "_node.*")


def body_of(docs: DataFrame) -> Column:
    """The documents' bodies: as parsed before (``_source``), else from their text."""
    return F.col("_source") if "_source" in docs.columns else parse_document(F.col("raw"))


def document_nodes(docs: DataFrame, root: str, *keep: str, values: Keep | None = None) -> DataFrame:
    """``keep`` and one row ``(path, type, value)`` per node below the root of each document.

    Text that is not one whole object has none. ``values`` as for ``walk``.
    """
    bodies = docs.select(F.struct(*keep).alias("_keep"), body_of(docs).alias("_value"))
    members = bodies.lateralJoin(docs.sparkSession.tvf.variant_explode_outer(F.col("_value").outer()))
    tops = members.where(F.col("key").isNotNull()).select(
        *[F.col("_keep")[k].alias(k) for k in keep],
        _child_path(F.lit(root), F.col("key")).alias("_top"), F.col("value").alias("_body"),
    )
    return walk(tops, F.col("_body"), F.col("_top"), *keep, values=values)
