"""Field profiles of document collections, and the choice of the field that names the kind.

All functions work on every collection at once, keyed by ``_index``. Order is the documents'
own ``seq``, never the order of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.values import body_of, label_text, number_text, value_type
from docloom.session import materialize
from docloom.sources.documents import parsed_once

# Samples kept per field, and the presence (percent) a kind field needs.
SAMPLES_PER_FIELD = 30
KIND_PRESENCE = 90
# Fixed value: key that never names the kind unless the caller says otherwise.
EXCLUDED_KEYS = ("id",)
# Fixed value: the key that keeps a tie.
PREFERRED_KEY = "type"

# Ranges of a field's documents that are looked at at once for its samples, and rows ranked without a cut.
RANGES, RANKED_ROWS = 256, 100_000

# Value classes by code, so that the last class of a field is the maximum of one number.
TYPES = ("string", "number", "boolean", "null", "array", "object")


def _members(docs: DataFrame) -> tuple[Column, Column]:
    """Members of the documents by key, NULL unless the body is one whole object, and its keys in order."""
    members = F.try_variant_get(body_of(docs), "$", "map<string,variant>")
    return members, F.col("_keys") if "_keys" in docs.columns else F.json_object_keys("raw")


def document_fields(docs: DataFrame) -> DataFrame:
    """One row per whole document and top-level key: ``(_index, seq, pos, key, value, type, first)``.

    A document without any key has one row too, with a null key. ``first`` marks one row of each document,
    so that rows of fields also count documents. Text that is not one whole object has no rows.
    """
    members, keys = _members(docs)
    parsed = docs.select("_index", "seq", members.alias("members"), keys.alias("keys"))
    places = F.when(F.col("members").isNotNull(), F.col("keys"))
    opened = parsed.select("_index", "seq", "members", F.posexplode_outer(places).alias("pos", "key"))
    # The condition needs what the explosion gives; one on the members alone would be moved below it
    # and parse every document again.
    there = opened.where(F.coalesce(F.col("pos"), F.size("members")) >= 0)
    value = F.element_at("members", F.col("key"))
    return there.select("_index", "seq", "pos", "key", value.alias("value")).select(
        "*", value_type(F.col("value")).alias("type"), (F.coalesce("pos", F.lit(0)) == 0).alias("first")
    )


def fields(docs: DataFrame) -> DataFrame:
    """One row per document and top-level key: ``(_index, seq, pos, key, value, type)``.

    ``pos`` is the place of the key in the document's text. Explicit nulls are rows, missing
    keys are not, members are not descended into, and text that is not one whole object has no
    fields.
    """
    return document_fields(docs).where(F.col("key").isNotNull()).drop("first")


def _type_code(type_: Column) -> Column:
    code = F.lit(0)
    for i, name in enumerate(TYPES):
        code = F.when(type_ == name, F.lit(i)).otherwise(code)
    return code


def _type_name(code: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, TYPES)), (code + 1).cast("int"))


def _key_order(key: Column, first: Column) -> Column:
    """Position of a key in a profile: whole-number keys ascending, then first seen first."""
    whole = key.rlike("^(0|[1-9][0-9]{0,9})$") & (key.try_cast("bigint") < F.lit(4294967295))
    return F.struct(
        F.when(whole, F.lit(0)).otherwise(F.lit(1)).alias("word"),
        F.when(whole, key.try_cast("bigint")).otherwise(F.lit(-1)).alias("number"),
        first.alias("first"),
    )


def stats_type() -> Column:
    """Type of a field from ``any_string`` and ``last_code`` of its statistics."""
    return F.when(F.col("any_string") == 1, "string").otherwise(_type_name(F.col("last_code")))


def field_stats(exploded: DataFrame, *more: Column) -> DataFrame:
    """Count, first place, and type per field, from ``fields``, and ``more`` aggregates.

    Everything aggregates into number buffers, so the map side combines in a hash table: few
    keys, many rows. The first place is a pair of ``seq`` and position, any ``seq`` will do.
    """
    return (
        exploded.groupBy("_index", "key")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.min("seq").alias("first_seq"),
            F.min_by("pos", "seq").alias("first_pos"),
            F.max("seq").alias("last_seq"),
            F.max_by(_type_code(F.col("type")), "seq").alias("last_code"),
            F.max(F.when(F.col("type") == "string", 1).otherwise(0)).alias("any_string"),
            *more,
        )
        .withColumn("type", stats_type())
    )


def field_presence(docs: DataFrame) -> DataFrame:
    """Number of documents having each key, explicit nulls included."""
    return field_stats(fields(docs)).select("_index", "key", "cnt")


def field_type(docs: DataFrame) -> DataFrame:
    """String once any value is a string; else the type of the last value."""
    return field_stats(fields(docs)).select("_index", "key", "type")


def percent(count: Column, total: Column) -> Column:
    """Whole percent, halves up; the order of the arithmetic decides cases such as 57/200."""
    return F.floor(count.cast("double") / total * 100 + 0.5).cast("int")


def field_profile(docs: DataFrame) -> DataFrame:
    """Per field: count, type, presence in percent, and its order in the profile.

    One aggregate over the fields gives both the fields' counts and, from the first row of each
    document, the totals; what is joined is a row per field.
    """
    stats = materialize(field_stats(document_fields(docs), F.count_if("first").alias("documents")), "field-stats")
    totals = stats.groupBy("_index").agg(F.sum("documents").alias("total"))
    return (
        stats.where(F.col("key").isNotNull())
        .join(totals, "_index")
        .select(
            "_index", "key", "cnt", "type",
            percent(F.col("cnt"), F.col("total")).alias("probability"),
            _key_order(F.col("key"), F.struct("first_seq", "first_pos")).alias("position"),
        )
    )


def field_probability(docs: DataFrame) -> DataFrame:
    return field_profile(docs).select("_index", "key", "cnt", "probability")


def _sample_ends(values: DataFrame, size: int) -> DataFrame:
    """``(_index, key, high)``: a ``seq`` up to which each field surely has its first ``size`` distinct
    values, or its last ``seq`` if it has fewer.

    Distinct values are estimated for ``RANGES`` ranges of a field's span of ``seq``; the first range that
    alone holds enough ends what has to be read, and is itself cut again until few rows are in it. So no
    more than a few values of each range before it, and the rows of a short one, are compared exactly.
    """
    columns = ["_index", "key"]
    spans = materialize(
        values.groupBy(*columns).agg(
            F.min("seq").alias("low"), F.max("seq").alias("high"), F.count(F.lit(1)).alias("rows")
        ), "sample-spans",
    )
    # Spans as decimals: the distance of two positions may not fit a long.
    start, end = F.col("low").cast("decimal(20,0)"), F.col("high").cast("decimal(20,0)")
    width = F.ceil((end - start + 1) / F.lit(RANGES)).cast("decimal(20,0)")
    while not spans.where(F.col("rows") > RANKED_ROWS).isEmpty():
        wide = spans.where(F.col("rows") > RANKED_ROWS).withColumn("width", width)
        place = F.floor((F.col("seq").cast("decimal(20,0)") - start) / F.col("width")).cast("int")
        counted = (
            values.join(wide, columns).where(F.col("seq").between(F.col("low"), F.col("high")))
            .groupBy(*columns, place.alias("place"))
            .agg(F.approx_count_distinct("digest", 0.05).alias("distinct"), F.count(F.lit(1)).alias("inside"))
        )
        # Twice the size by estimate is more than the size itself.
        enough = counted.where(F.col("distinct") >= 2 * size)
        first = enough.groupBy(*columns).agg(F.min(F.struct("place", "inside")).alias("cut"))
        low = start + F.col("cut.place") * F.col("width")
        cut = wide.join(first, columns, "left").select(
            *columns,
            F.when(F.col("cut").isNull(), F.col("low")).otherwise(low.cast("bigint")).alias("low"),
            F.when(F.col("cut").isNull(), F.col("high"))
            .otherwise(F.least(end, low + F.col("width") - 1).cast("bigint")).alias("high"),
            # A range of one position cannot be cut, nor one without enough values in any part.
            F.when(F.col("width") > 1, F.coalesce("cut.inside", F.lit(0))).otherwise(0).cast("bigint").alias("rows"),
        )
        spans = materialize(cut.unionByName(spans.where(F.col("rows") <= RANKED_ROWS)), "sample-spans")
    return spans.select(*columns, "high")


def field_samples(docs: DataFrame, size: int = SAMPLES_PER_FIELD) -> DataFrame:
    """The first ``size`` distinct values per field, as ``(_index, key, rank, type, sample)``.

    Scalars are equal when class and value are (numbers as doubles, so 1 and 1.0 are one);
    objects and arrays never equal each other. Values are compared and ranked by digest, and only those
    up to the ``seq`` by which a field has its samples; their text is fetched at the end, for the samples
    alone, from the documents that hold them.
    """
    docs = parsed_once(docs, "_index", "seq")
    exploded = fields(docs)
    scalar = ~F.col("type").isin("array", "object")
    shown = (
        F.when(F.col("type") == "number", number_text(F.col("value")))
        .when(F.col("type") == "string", F.try_variant_get("value", "$", "string"))
        .otherwise(F.to_json("value"))
    )
    # A container is its own value: its place stands for it.
    digest = F.when(scalar, F.sha2(shown, 256)).otherwise(F.col("seq").cast("string"))
    values = exploded.select("_index", "key", "seq", F.concat("type", digest).alias("digest"))
    firsts = (
        values.join(_sample_ends(values, size), ["_index", "key"])
        .where(F.col("seq") <= F.col("high"))
        .groupBy("_index", "key", "digest").agg(F.min("seq").alias("seq"))
    )
    # Values of one key differ in seq: a document holds one value per key.
    order = Window.partitionBy("_index", "key").orderBy("seq")
    ranked = materialize(
        firsts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= size)
        .select("_index", "key", "seq", "rank"),
        "samples",
    )
    # Only the documents that hold a sample are looked at for their text.
    holders = docs.join(ranked.select("_index", "seq").distinct(), ["_index", "seq"], "left_semi")
    return (
        fields(holders).join(ranked, ["_index", "key", "seq"])
        .select("_index", "key", "rank", "type", shown.alias("sample"))
    )


def kind_candidates(profile: DataFrame, threshold: int = KIND_PRESENCE) -> DataFrame:
    """Mark fields fit to name the kind: present often enough and of type string."""
    return profile.withColumn(
        "suggested", (F.col("probability") >= threshold) & (F.col("type") == "string")
    )


def kind_exclusions(candidates: DataFrame, excluded: tuple[str, ...] = EXCLUDED_KEYS) -> DataFrame:
    """Excluded keys stay suggested but are not ``eligible``."""
    return candidates.withColumn(
        "eligible", F.col("suggested") & ~F.col("key").isin(*excluded) if excluded
        else F.col("suggested")
    )


def kind_field(
    profile: DataFrame,
    excluded: tuple[str, ...] = EXCLUDED_KEYS,
    threshold: int = KIND_PRESENCE,
) -> DataFrame:
    """The field naming the kind, per collection; an empty key and 0 when there is none.

    The highest presence wins, then the preferred key, then the later field.
    """
    marked = kind_exclusions(kind_candidates(profile, threshold), excluded)
    rank = F.struct("probability", (F.col("key") == PREFERRED_KEY), "position", "key")
    best = F.max(F.when(F.col("eligible"), rank))
    return (
        marked.groupBy("_index")
        .agg(best.alias("best"))
        .select(
            "_index",
            F.coalesce("best.key", F.lit("")).alias("kind_field"),
            F.coalesce("best.probability", F.lit(0)).alias("probability"),
        )
    )


def chosen_kind_fields(docs: DataFrame, **rules) -> DataFrame:
    """``(_index, kind_field)`` as the profile suggests it, written once and reused."""
    return materialize(kind_field(field_profile(docs), **rules).select("_index", "kind_field"))


def with_kind(docs: DataFrame, kind_fields: DataFrame) -> DataFrame:
    """Whole documents, parsed, with ``kind``: the text of the collection's kind field.

    A missing field gives ``undefined``, null gives ``null``. Collections without a kind field
    get their own name. Text that is not one whole object is left out; documents that were not parsed
    before are, and are written.
    """
    value = F.try_element_at(F.try_variant_get("_source", "$", "map<string,variant>"), F.col("kind_field"))
    whole = parsed_once(docs).where(F.col("_source").isNotNull())
    return (
        whole.join(kind_fields, "_index")
        .withColumn("_value", value)
        .withColumn(
            "kind",
            F.when(F.col("kind_field") == "", F.col("_index")).otherwise(label_text(F.col("_value"))),
        )
        .drop("_value")
    )


def group_by_kind(kinded: DataFrame) -> DataFrame:
    """Documents per collection and kind, the empty-text kind included."""
    return kinded.groupBy("_index", "kind").agg(F.count(F.lit(1)).alias("documents"))


def distinct_kinds(kinded: DataFrame) -> DataFrame:
    """Kind names per collection and the ``seq`` they first appear at.

    The empty text is no kind, and a collection where no field names the kind has none.
    """
    return (
        kinded.where((F.col("kind_field") != "") & (F.col("kind") != ""))
        .groupBy("_index", "kind")
        .agg(F.min("seq").alias("first_seq"))
    )


def field_order(profile: DataFrame, alphabetical: bool = False) -> DataFrame:
    """Number the fields of each collection, in profile order or by name.

    The fields are sorted over all tasks by range; a field's number is its place in its own part and the
    number of fields of its collection in the parts before, so no task sees a whole collection.
    """
    order = F.col("key") if alphabetical else F.col("position")
    columns = profile.columns
    dealt = profile.withColumn("_order", order).repartitionByRange("_index", "_order")
    parts = materialize(dealt.withColumn("_part", F.spark_partition_id()), "field-parts")
    held = parts.groupBy("_index", "_part").agg(F.count(F.lit(1)).alias("_held"))
    # A row per part.
    before = Window.partitionBy("_index").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("_index", "_part", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_index", "_part").orderBy("_order"))
    numbered = parts.withColumn("_inside", inside).join(offsets, ["_index", "_part"])
    return numbered.select(*columns, (F.col("_before") + F.col("_inside")).cast("int").alias("place"))


def cardinality_sketches(docs: DataFrame, precision: int = 14) -> DataFrame:
    """``(_index, key, values, sketch)``: how many values each field has, and a sketch of the distinct ones.

    Sketches of batches, kinds or collections are merged by ``merged_cardinality``, and may be stored.
    """
    rows = fields(docs)
    digest = F.concat("type", F.to_json("value"))
    return rows.groupBy("_index", "key").agg(
        F.count(F.lit(1)).alias("values"), F.hll_sketch_agg(digest, precision).alias("sketch")
    )


def merged_cardinality(sketches: DataFrame, *keys: str) -> DataFrame:
    """Values, and the estimate of the distinct ones, over all sketches of the same ``keys``."""
    return sketches.groupBy(*keys).agg(
        F.sum("values").alias("values"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"),
    )


def collection_profile(docs: DataFrame, excluded: tuple[str, ...] = EXCLUDED_KEYS) -> DataFrame:
    """What to know about every collection, as rows ``(_index, role, name, first_seq, first_pos)``.

    Roles: ``kind_field`` (one row, empty name when there is none), ``suggested`` and ``other``
    fields, and ``kind`` names; the last two columns give their order of appearance. Rows, not lists: a
    field with a value per document can name the kind, and lists of those would not fit a task.
    """
    docs = parsed_once(docs, "_index", "seq")
    profile = materialize(field_profile(docs))
    chosen = materialize(kind_field(profile, excluded).select("_index", "kind_field"))
    names = kind_candidates(profile).select(
        "_index",
        F.when(F.col("suggested"), "suggested").otherwise("other").alias("role"),
        F.col("key").alias("name"),
        F.col("position.first.first_seq").alias("first_seq"),
        F.col("position.first.first_pos").alias("first_pos"),
    )
    kinds = distinct_kinds(with_kind(docs, chosen)).select(
        "_index", F.lit("kind").alias("role"), F.col("kind").alias("name"),
        "first_seq", F.lit(0).alias("first_pos"),
    )
    heads = chosen.select(
        "_index", F.lit("kind_field").alias("role"), F.col("kind_field").alias("name"),
        F.lit(0).cast("bigint").alias("first_seq"), F.lit(0).alias("first_pos"),
    )
    return heads.unionByName(names).unionByName(kinds)
