"""Templates and schemas of document kinds: deep merge, mapped fields present, schema merge."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.rows import spread_join
from docloom.functions.values import (
    ancestors, body_of, document_nodes, field_path, is_member, leads_arrays, value_type,
)
from docloom.session import materialize

ROOT = "_source"
# Fixed value: the extra kind that carries a collection's full mapping and has no documents.
MAPPING_KIND = "indexMappingConfig"
# Members from which on an object counts as a map, and columns of a table of all kinds.
MAP_MEMBERS, TABLE_COLUMNS = 200, 2000

def _last_seen(kinded: DataFrame) -> DataFrame:
    """Per kind and path the last ``seq`` that set it to a scalar, an object and an array.

    ``mixed`` marks paths set to more than one of them. A few numbers per group, so the map side combines in a hash table and values stay behind.
    """

    def last(condition: Column) -> Column:
        return F.max(F.when(condition, F.col("seq")).otherwise(F.lit(-1).cast("bigint")))

    type_ = F.col("type")
    form = F.when(type_ == "object", 1).when(type_ == "array", 2).otherwise(0)
    found = document_nodes(kinded, ROOT, "_index", "kind", "seq")
    below = (
        found.groupBy("_index", "kind", "path")
        .agg(
            last(~type_.isin("object", "array")).alias("scalar"),
            last(type_ == "object").alias("object"),
            last(type_ == "array").alias("array"),
            (F.min(form) < F.max(form)).alias("mixed"),
        )
    )
    never = F.lit(-1).cast("bigint")
    roots = kinded.groupBy("_index", "kind").agg(F.max("seq").alias("object")).select(
        "_index", "kind", F.lit(ROOT).alias("path"), never.alias("scalar"), "object",
        never.alias("array"), F.lit(False).alias("mixed"),
    )
    return (
        below.unionByName(roots)
        .withColumn("above", ancestors(F.col("path"), ROOT))
        .withColumn("last", F.greatest("scalar", "object", "array"))
        .withColumn(
            "state",
            F.when(F.col("last") == F.col("scalar"), "scalar")
            .when(F.col("last") == F.col("object"), "object")
            .otherwise("array"),
        )
    )


def template_paths(kinded: DataFrame) -> DataFrame:
    """The paths that exist after merging all documents of a kind in ``seq`` order.

    ``(_index, kind, path, above, last, state)``: ``last`` is the document that decides the path.
    A path is gone when an ancestor was later set to a scalar, or to the other container
    (an array over an object, an object over an array). Ancestors are found by equi-joins on
    the table of paths, not on the documents; only ancestors set to more than one form can take a path
    away, and all paths of a kind may lie below one of them.
    """
    seen = materialize(_last_seen(kinded))
    above = seen.select("_index", "kind", "path", "last", F.explode("above").alias("a"))
    killer = F.greatest(
        F.col("scalar"), F.when(F.col("a.step") == "key", F.col("array")).otherwise(F.col("object"))
    )
    setters = seen.where("mixed").select(
        "_index", "kind", F.col("path").alias("a_path"), "scalar", "object", "array"
    )
    gone = (
        spread_join(above.withColumn("a_path", F.col("a.path")), setters, ["_index", "kind", "a_path"], "path")
        .where(killer > F.col("last"))
        .select("_index", "kind", "path")
        .distinct()
    )
    return seen.join(gone, ["_index", "kind", "path"], "left_anti").select(
        "_index", "kind", "path", "above", "last", "state"
    )


def _json_string(text: Column) -> Column:
    """Text as a JSON string literal."""
    array = F.to_json(F.array(text))
    return F.substring(array, 2, F.length(array) - 2)


def merged_template(kinded: DataFrame) -> DataFrame:
    """The deep merge of all documents of a kind, as its leaves ``(_index, kind, path, value)``.

    Later documents win per leaf, explicit null included; objects merge, arrays merge by
    position, and an empty container is a leaf. The envelope is part of the template. Values are
    fetched at the end, from the documents that decide them.
    """
    alive = materialize(template_paths(kinded))
    parents = (
        alive.where(F.size("above") > 0)
        .select("_index", "kind", F.try_element_at("above", F.lit(-1))["path"].alias("path"))
        .distinct()
    )
    scalars = alive.where(F.col("state") == "scalar").select("_index", "kind", "path", "last")
    empties = (
        alive.where(F.col("state") != "scalar")
        .join(parents, ["_index", "kind", "path"], "left_anti")
        .select(
            "_index", "kind", "path",
            F.when(F.col("state") == "object", "{}").otherwise("[]").alias("value"),
        )
    )
    deciders = alive.select("_index", F.col("last").alias("seq")).distinct()
    deciding = kinded.join(deciders, ["_index", "seq"], "left_semi")
    values = (
        document_nodes(
            deciding, ROOT, "_index", "kind", "seq", values=lambda _, type_: ~type_.isin("object", "array")
        )
        .select(
            "_index", "kind", "path", F.col("seq").alias("last"), F.to_json("value").alias("value")
        )
        .join(scalars, ["_index", "kind", "path", "last"])
        .select("_index", "kind", "path", "value")
    )
    roots = alive.where(F.size("above") == 0).select("_index", "kind", F.col("last").alias("seq"))
    service = F.create_map(
        F.lit("_index"), _json_string(F.col("_index")), F.lit("_id"), _json_string(F.col("_id"))
    )
    envelope = deciding.join(roots, ["_index", "kind", "seq"]).select(
        "_index", "kind", F.explode(service).alias("path", "value")
    )
    return values.unionByName(empties).unionByName(envelope)


def kind_schema(kinded: DataFrame, kinds: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mapped fields of every kind: ``(_index, kind, path, type)``.

    ``kinds`` lists ``(_index, kind)``, ``mapping`` holds ``(_index, path, type)`` with paths
    below ``_source``. A kind keeps the fields present in its merged template (null counts;
    inside arrays the first element speaks). Kinds without documents, and the only kind of a
    collection, keep all fields. Collections with several kinds get the mapping kind on top.
    """
    counted = kinds.groupBy("_index").agg(F.count(F.lit(1)).alias("n"))
    extra = counted.where(F.col("n") > 1).select("_index", F.lit(MAPPING_KIND).alias("kind"))
    with_docs = kinded.select("_index", "kind").distinct().withColumn("has_docs", F.lit(True))
    listed = (
        kinds.select("_index", "kind").unionByName(extra)
        .join(counted, "_index")
        .join(with_docs, ["_index", "kind"], "left")
        .withColumn("all_fields", (F.col("n") == 1) | F.col("has_docs").isNull())
        .select("_index", "kind", "all_fields")
    )
    present = (
        template_paths(kinded)
        .where(leads_arrays(F.col("path")))
        .select("_index", "kind", field_path(F.col("path")).alias("path"))
        .distinct()
    )
    columns = ["_index", "kind", "path", "type"]
    some = listed.where(~F.col("all_fields")).select("_index", "kind")
    whole = listed.where("all_fields").join(mapping, "_index").select(columns)
    mapped = present.join(mapping, ["_index", "path"])
    found = spread_join(mapped, some, ["_index", "kind"], "path", "left_semi")
    return found.select(columns).unionByName(whole)


def drop_empty_kinds(kinds: DataFrame, kinded: DataFrame, schema: DataFrame,
                     include_empty: bool = False) -> DataFrame:
    """Kinds with their document and field counts; those with neither are dropped."""
    documents = kinded.groupBy("_index", "kind").agg(F.count(F.lit(1)).alias("documents"))
    mapped = schema.groupBy("_index", "kind").agg(F.count(F.lit(1)).alias("fields"))
    counted = (
        kinds.select("_index", "kind")
        .join(documents, ["_index", "kind"], "left")
        .join(mapped, ["_index", "kind"], "left")
        .na.fill(0, ["documents", "fields"])
    )
    return counted if include_empty else counted.where("documents > 0 OR fields > 0")


def observed_schema(kinded: DataFrame) -> DataFrame:
    """Field map of every kind as its documents show it, with the order of the kinds.

    ``(_index, kind, kind_order, path, type)``; ``type`` is scalar, object or array, and
    ``kind_order`` the ``seq`` of the kind's first document.
    """
    order = kinded.groupBy("_index", "kind").agg(F.min("seq").alias("kind_order"))
    fields = (
        template_paths(kinded)
        .where(leads_arrays(F.col("path")))
        .where(is_member(F.col("path")) & (F.col("path") != ROOT))
        .select("_index", "kind", field_path(F.col("path")).alias("path"),
                F.col("state").alias("type"))
    )
    return spread_join(fields, order, ["_index", "kind"], "path")


def schema_merge(schemas: DataFrame) -> DataFrame:
    """One field map per collection from the maps of its kinds.

    An object beats a non-object, else the first kind wins; ``kind`` is the one that won.
    """
    rank = F.struct((F.col("type") != "object").alias("plain"), "kind_order", "kind", "type")
    return (
        schemas.groupBy("_index", "path")
        .agg(F.min(rank).alias("best"))
        .select("_index", "path", F.col("best.type").alias("type"), F.col("best.kind").alias("kind"))
    )


def observed_fields(docs: DataFrame) -> DataFrame:
    """Distinct field paths found in each collection's documents, with their value classes."""
    return (
        document_nodes(docs, ROOT, "_index")
        .where(is_member(F.col("path")))
        .select("_index", field_path(F.col("path")).alias("path"), "type")
        .distinct()
    )


def new_fields(before: DataFrame, after: DataFrame) -> DataFrame:
    """Paths of a collection found in ``after`` and not in ``before``, with their classes there."""
    return observed_fields(after).join(
        observed_fields(before).select("_index", "path").distinct(), ["_index", "path"], "left_anti"
    )


def fold_maps(merged: DataFrame, most: int = MAP_MEMBERS, columns: int = TABLE_COLUMNS) -> DataFrame:
    """A merged schema in which objects used as maps have the type ``map`` and no members.

    An object with more than ``most`` members is one: its keys are data that grows with the documents. If
    more than ``columns`` paths are left, ``most`` is halved, so that a schema of any size
    becomes a table of bounded width. The root can be a map too, as the path of the documents' body.
    """
    rows = materialize(merged.withColumn("_above", ancestors(F.col("path"), ROOT)["path"]), "merged")
    while True:
        parents = rows.groupBy("_index", F.try_element_at("_above", F.lit(-1)).alias("path")).agg(
            F.count(F.lit(1)).alias("members")
        )
        maps = parents.where(F.col("members") > most).select("_index", "path")
        opened = rows.select("_index", "path", "type", "kind", F.explode_outer("_above").alias("above"))
        hits = maps.select("_index", F.col("path").alias("above"), F.lit(True).alias("_inside"))
        # Most paths may lie in one map, and there are as many as documents: they are grouped, not looked up.
        left = (
            spread_join(opened, hits, ["_index", "above"], "path", "left")
            .groupBy("_index", "path", "type", "kind").agg(F.max("_inside").alias("_inside"))
            .where(F.col("_inside").isNull())
        )
        marked = left.join(maps.withColumn("_map", F.lit(True)), ["_index", "path"], "left")
        folded = marked.withColumn("type", F.when(F.col("_map"), "map").otherwise(F.col("type"))).drop("_map", "_inside")
        roots = maps.where(F.col("path") == ROOT).join(
            rows.groupBy("_index").agg(F.min("kind").alias("kind")), "_index"
        ).select("_index", "path", F.lit("map").alias("type"), "kind")
        found = materialize(folded.select("_index", "path", "type", "kind").unionByName(roots), "folded")
        if most <= 1 or found.count() <= columns:
            return found
        most //= 2


def table_columns(merged: DataFrame) -> list[tuple[str, str, str]]:
    """(column, path, type) of a merged schema, by path.

    The schema reaches the driver, as that of any table does: fold it first. Members are joined by
    underscores; of two paths that give one name the second gets a number.
    """
    columns, taken = [], set()
    for row in merged.select("path", "type").orderBy("path").collect():
        name = base = re.sub(r"[^\w]+", "_", row["path"].removeprefix(ROOT)).strip("_") or "value"
        number = 1
        while name.lower() in taken:
            number += 1
            name = f"{base}_{number}"
        taken.add(name.lower())
        columns.append((name, "$" + row["path"].removeprefix(ROOT), row["type"]))
    return columns


def kind_union(kinded: DataFrame, merged: DataFrame) -> DataFrame:
    """All kinds of a collection as one table, in one scan: ``_index``, ``seq``, ``_kind``, and one
    column per path of the merged schema, folded.

    Scalars and arrays come as text, arrays as JSON. Where the schema has an object, the column
    holds the value of documents that have something else there; a map has its members as text by key, and
    a second column for other values. A member that a document lacks is NULL; no document is left out.
    """
    parsed = kinded.withColumn("_body", body_of(kinded))

    def text(value: Column) -> Column:
        kind = value_type(value)
        return F.when(kind.isin("array", "object"), F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))

    def columns(name: str, path: str, type_: str) -> list[Column]:
        value = F.try_variant_get("_body", path, "variant")
        kind = value_type(value)
        plain = F.when(kind == "array", F.to_json(value)).when(
            kind != "object", F.try_variant_get("_body", path, "string")
        )
        if type_ == "object":
            return [plain.alias(name)]
        if type_ == "map":
            members = F.transform_values(F.try_variant_get(value, "$", "map<string,variant>"), lambda _, v: text(v))
            return [members.alias(name), plain.alias(f"{name}_other")]
        return [plain.when(kind == "object", F.to_json(value)).alias(name)]

    found = [c for column in table_columns(fold_maps(merged)) for c in columns(*column)]
    return parsed.select("_index", "seq", F.col("kind").alias("_kind"), *found)


# Bytes of text that a file of kinds holds.
FILE_BYTES = 128 << 20


def write_by_kind(kinded: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Documents as Parquet files by kind, their number bounded by bytes, not by kinds.

    A kind with ``file_bytes`` or more has a folder of its own and as many files as it needs; all others are
    dealt by hash to folders of about that size. ``path/manifest`` says where each kind is, and
    ``read_kind`` reads nothing else.
    """
    rows = kinded.select("_index", "kind", "_id", "seq", "raw")
    size = F.sum(F.octet_length("raw").cast("bigint") + 64)
    kinds = materialize(
        rows.groupBy("_index", "kind").agg(F.count(F.lit(1)).alias("documents"), size.alias("bytes")), "kinds"
    )
    small = F.col("bytes") < file_bytes
    rest = kinds.where(small).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tails = max(1, -(-rest // file_bytes))
    digest = F.xxhash64("_index", "kind")
    slot = F.when(small, F.concat(F.lit("tail-"), F.pmod(digest, F.lit(tails)).cast("string"))).otherwise(
        F.concat(F.lit("kind-"), F.hex(digest))
    )
    manifest = materialize(
        kinds.withColumn("slot", slot).withColumn(
            "files", F.when(small, 1).otherwise(F.ceil(F.col("bytes") / file_bytes)).cast("int")
        ), "kind-manifest",
    )
    manifest.sort("_index", "kind").write.mode("errorifexists").parquet(f"{path}/manifest")
    placed = rows.join(manifest.select("_index", "kind", "slot", "files"), ["_index", "kind"])
    part = F.pmod(F.xxhash64("seq", "_id"), "files").cast("int")
    dealt = placed.withColumn("_part", part).repartition("slot", "_part").sortWithinPartitions("slot", "_index", "kind")
    dealt.drop("_part", "files").write.mode("errorifexists").partitionBy("slot").parquet(f"{path}/data")


def read_kind(spark: SparkSession, path: str, index: str, kind: str) -> DataFrame:
    """The documents of one kind, from its folder alone; a kind that is not there has none."""
    here = (F.col("_index") == index) & (F.col("kind") == kind)
    found = spark.read.parquet(f"{path}/manifest").where(here).select("slot").first()
    slot = F.lit(False) if found is None else F.col("slot") == found["slot"]
    return spark.read.parquet(f"{path}/data").where(slot & here).drop("slot")
