"""Registered queries: a declared mapping applied to documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions.values import parse_document
from docloom.operators import mapping as M
from docloom.plans.registry import query
from docloom.sources import fixtures as X
from docloom.sources.documents import parsed_once
from docloom.sources.tables import table

_LOOSE = "WITH" + X.LOOSE_SQL
# The member ``n`` as a whole number with and without coercion; 'x' stands for malformed.
_COERCED = "CASE WHEN NOT has_n OR null_n THEN '' WHEN form = 4 THEN 'x' ELSE CAST(user_id AS VARCHAR) END"
_EXACT = "CASE WHEN NOT has_n OR null_n THEN '' WHEN form = 0 THEN CAST(user_id AS VARCHAR) ELSE 'x' END"


def _text(column, malformed: str | None = None):
    shown = F.coalesce(F.col(column).cast("string"), F.lit(""))
    if malformed is None:
        return shown.alias(column)
    return F.when(F.array_contains(malformed, F.lit(column)), "x").otherwise(shown).alias(column)


@query(
    "typed_projection",
    _LOOSE + """
    SELECT seq, seq AS id, event_type = event_type AS present, label,
      CASE WHEN day = 'soon' OR seq % 4 = 1 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day,
      user_id AS low, user_id + seq % 7 AS high
    FROM loose""",
)
def typed_projection(spark, sf):
    mapping = [
        M.Field("id", "$.id", "long"), M.Field("label", "$.label", "keyword"),
        M.Field("day", "$.day", "date"), M.Field("span", "$.span", "long_range"),
    ]
    mapped = M.apply_mapping(X.loose_docs(spark, sf), mapping, "seq")
    return mapped.select(
        "seq", "id", F.col("label").isNotNull().alias("present"), "label",
        F.coalesce(F.date_format("day", "yyyy-MM-dd"), F.lit("")).alias("day"),
        F.col("span.gte").alias("low"), F.col("span.lte").alias("high"),
    )


@query(
    "observed_arrays",
    "WITH " + X.MIXED_ROWS_SQL + """
    SELECT seq, id, CASE WHEN origin = 'customer' THEN 'n' || nation || CASE WHEN id % 2 = 0 THEN ',even' ELSE '' END
      WHEN origin = 'supplier' THEN CASE WHEN id % 2 = 0 THEN 's' ELSE '' END END AS tags FROM mixed_rows""",
)
def observed_arrays(spark, sf):
    docs = X.mixed_docs(spark, sf)
    mapping = M.observed_arrays(docs, [M.Field("id", "$.id", "long"), M.Field("tags", "$.tags", "keyword")])
    mapped = M.apply_mapping(docs, mapping, "seq").where(~M.is_quarantined())
    return mapped.select("seq", "id", F.array_join("tags", ",").alias("tags"))


@query("coerce", _LOOSE + f" SELECT seq, {_COERCED} AS lenient, {_EXACT} AS exact FROM loose")
def coerce(spark, sf):
    mapping = [
        M.Field("lenient", "$.n", "long"), M.Field("exact", "$.n", "integer", coerce=False),
    ]
    mapped = M.apply_mapping(X.loose_docs(spark, sf), mapping, "seq")
    return mapped.select("seq", _text("lenient", "_malformed"), _text("exact", "_malformed"))


@query(
    "ignore_malformed",
    _LOOSE + f"""
    SELECT seq, CASE WHEN {_COERCED} = 'x' THEN '' ELSE {_COERCED} END AS n,
      CASE WHEN {_COERCED} = 'x' THEN 'n' ELSE '' END AS ignored, day = 'soon' AS quarantined
    FROM loose
    UNION ALL SELECT -seq, '', '', true FROM loose WHERE seq % 97 = 5""",
)
def ignore_malformed(spark, sf):
    mapping = [
        M.Field("n", "$.n", "integer", ignore_malformed=True),
        M.Field("day", "$.day", "date", format="yyyy/MM/dd||dd-MM-yyyy"),
    ]
    mapped = M.apply_mapping(X.with_broken(X.loose_docs(spark, sf)), mapping, "seq")
    return mapped.select(
        "seq", _text("n"), F.array_join("_ignored", ",").alias("ignored"),
        M.is_quarantined().alias("quarantined"),
    )


@query(
    "null_value",
    _LOOSE + """
    SELECT seq, CASE WHEN NOT has_n THEN 'missing' WHEN null_n THEN '-1' WHEN form = 4 THEN 'x'
                ELSE CAST(user_id AS VARCHAR) END AS n FROM loose""",
)
def null_value(spark, sf):
    mapping = [M.Field("n", "$.n", "long", null_value=-1, ignore_malformed=True)]
    mapped = M.apply_mapping(X.loose_docs(spark, sf), mapping, "seq")
    shown = F.when(F.array_contains("_ignored", F.lit("n")), "x").otherwise(
        F.coalesce(F.col("n").cast("string"), F.lit("missing"))
    )
    return mapped.select("seq", shown.alias("n"))


@query(
    "ignore_above",
    _LOOSE + """ SELECT seq, CASE WHEN length(label) <= 6 THEN label ELSE '' END AS label,
      length(label) AS source_chars FROM loose""",
)
def ignore_above(spark, sf):
    mapping = [
        M.Field("label", "$.label", "keyword", ignore_above=6),
        M.Field("source", "$.label", "text"),
    ]
    mapped = M.apply_mapping(X.loose_docs(spark, sf), mapping, "seq")
    return mapped.select(
        "seq", _text("label"), F.length("source").cast("bigint").alias("source_chars")
    )


@query(
    "scaled_float",
    """SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS stored,
              CAST(round(p_retailprice * 100) AS BIGINT) / 100.0 AS price FROM part""",
)
def scaled_float(spark, sf):
    docs = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit('{"price": '), F.col("p_retailprice"), F.lit("}")).alias("raw")
    )
    mapping = [M.Field("stored", "$.price", "scaled_float", scaling_factor=100.0)]
    mapped = M.apply_mapping(docs, mapping, "p_partkey")
    return mapped.select("p_partkey", "stored", (F.col("stored") / 100.0).alias("price"))


@query(
    "date_format",
    _LOOSE + """ SELECT seq, CASE WHEN day = 'soon' THEN '' ELSE strftime(ts, '%Y%m%d') END AS day
    FROM loose""",
)
def date_format(spark, sf):
    mapping = [M.Field("day", "$.day", "date", format="yyyy/MM/dd||dd-MM-yyyy")]
    mapped = M.apply_mapping(X.loose_docs(spark, sf), mapping, "seq")
    return mapped.select(
        "seq", F.coalesce(F.date_format("day", "yyyyMMdd"), F.lit("")).alias("day")
    )


MAPPED_KEYS = ["id", "n", "label", "day", "span", "tree", "items"]


@query(
    "dynamic_policy",
    _LOOSE + """,
    per_key AS (
      SELECT 'extra' AS key, CASE WHEN seq < 127 THEN 'byte' WHEN seq < 32767 THEN 'short'
        WHEN seq < 2147483647 THEN 'integer' ELSE 'long' END AS type FROM loose WHERE seq % 6 = 0
      UNION ALL SELECT 'note', 'string' FROM loose WHERE seq % 15 = 0)
    SELECT 'true' AS policy, key, type AS detail, count(*) AS documents FROM per_key GROUP BY ALL
    UNION ALL SELECT 'runtime', key, '', count(*) FROM per_key GROUP BY key
    UNION ALL SELECT 'false', '', CASE WHEN seq % 6 = 0 OR seq % 15 = 0 THEN 'has unmapped' ELSE 'all mapped' END,
      count(*) FROM loose GROUP BY 3
    UNION ALL SELECT policy, '', 'unreadable', count(*) FROM loose, (VALUES ('false'), ('strict')) p(policy)
      WHERE seq % 97 = 5 GROUP BY 1
    UNION ALL SELECT 'strict', '', CASE WHEN seq % 6 = 0 OR seq % 15 = 0 THEN 'rejected' ELSE 'accepted' END,
      count(*) FROM loose GROUP BY 3""",
)
def dynamic_policy(spark, sf):
    # Four policies look at the documents, which are parsed once.
    docs = parsed_once(X.with_broken(X.loose_docs(spark, sf)), "seq")
    unreadable = F.when(F.col("unmapped").isNull() & F.col("rejected"), "unreadable")

    def counted(policy, rows, *keys):
        grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("documents"))
        return grouped.select(F.lit(policy).alias("policy"), "key", "detail", "documents")

    added = M.dynamic_policy(docs, MAPPED_KEYS, "true").select(
        F.explode("added").alias("key", "detail")
    )
    runtime = M.dynamic_policy(docs, MAPPED_KEYS, "runtime").select(
        F.explode(F.map_keys("runtime")).alias("key"), F.lit("").alias("detail")
    )
    has_unmapped = unreadable.when(F.size("unmapped") > 0, "has unmapped").otherwise("all mapped")
    ignored = M.dynamic_policy(docs, MAPPED_KEYS, "false").select(
        F.lit("").alias("key"), has_unmapped.alias("detail")
    )
    strict = M.dynamic_policy(docs, MAPPED_KEYS, "strict").select(
        F.lit("").alias("key"), unreadable.when(F.col("rejected"), "rejected").otherwise("accepted").alias("detail")
    )
    return (
        counted("true", added, "key", "detail")
        .unionByName(counted("runtime", runtime, "key", "detail"))
        .unionByName(counted("false", ignored, "key", "detail"))
        .unionByName(counted("strict", strict, "key", "detail"))
    )


@query(
    "enabled_false",
    _LOOSE + """
    SELECT seq, '{"a":{"b":' || user_id || ',"c":null},"d":"' || event_type || '"}' AS tree FROM loose
    UNION ALL SELECT -seq, NULL FROM loose WHERE seq % 97 = 5""",
)
def enabled_false(spark, sf):
    docs = X.with_broken(X.loose_docs(spark, sf))
    return M.enabled_false(docs, "$.tree", "tree").select("seq", "tree")


@query(
    "copy_to",
    _LOOSE + """,
    copied AS (SELECT seq, label || CASE WHEN has_n AND NOT null_n AND form <> 4
        THEN '|' || user_id ELSE '' END || '|' || seq AS copied FROM loose)
    SELECT seq, copied AS "all", copied AS deep_all FROM copied""",
)
def copy_to(spark, sf):
    paths = ["$.label", "$.n", "$.id", "$.all", "$.tree.all", "$.tree.d"]
    mapping = [
        M.Field("label", "$.label", "keyword"),
        M.Field("n", "$.n", "long", ignore_malformed=True),
        M.Field("id", "$.id", "long"),
    ]
    mapped = M.apply_mapping(X.loose_docs(spark, sf), mapping, "seq")
    names = {"$.all": "all", "$.tree.all": "deep_all"}
    targets = [names[p] for p in M.copy_targets(paths, "all")]
    copied = M.copy_to(mapped, ["label", "n", "id"], targets)
    return copied.select("seq", *[F.array_join(t, "|").alias(t) for t in targets])


@query("alias_field", _LOOSE + " SELECT seq, user_id AS leaf FROM loose")
def alias_field(spark, sf):
    targets = ["_source.tree.a.b", "_source.id"]
    return M.alias_field(X.loose_docs(spark, sf), "leaf", targets, "bigint").select("seq", "leaf")


@query(
    "multi_fields",
    _LOOSE + """
    SELECT seq, label, CASE WHEN length(label) <= 6 THEN label ELSE '' END AS "label.raw",
      lower(trim(label)) AS "label.folded", length(trim(label)) AS "label.chars" FROM loose""",
)
def multi_fields(spark, sf):
    label = F.col("label")
    mapped = M.apply_mapping(
        X.loose_docs(spark, sf), [M.Field("label", "$.label", "text")], "seq"
    ).select("seq", "label")
    return M.multi_fields(mapped, "label", {
        "raw": F.when(F.length(label) <= 6, label).otherwise(""),
        "folded": M.keyword_normalizer(label),
        "chars": F.length(F.trim(label)).cast("bigint"),
    })


@query(
    "nested_explode",
    _LOOSE + """
    SELECT seq, -1 AS pos, '' AS sku, -1 AS qty FROM loose WHERE seq % 3 = 0
    UNION ALL SELECT seq, 0, 's' || user_id, CASE seq % 3 WHEN 1 THEN 1 ELSE 2 END FROM loose WHERE seq % 3 > 0
    UNION ALL SELECT seq, 1, 't', seq % 9 FROM loose WHERE seq % 3 = 2""",
)
def nested_explode(spark, sf):
    rows = M.nested_explode(
        X.loose_docs(spark, sf), "$.items", {"sku": "string", "qty": "bigint"}, "seq"
    )
    return rows.na.fill({"pos": -1, "sku": "", "qty": -1})


@query(
    "flattened_leaves",
    _LOOSE + """
    SELECT seq, 'a.b' AS leaf_path, CAST(user_id AS VARCHAR) AS leaf FROM loose
    UNION ALL SELECT seq, 'a.c', 'none' FROM loose
    UNION ALL SELECT seq, 'd', event_type FROM loose WHERE length(event_type) <= 5""",
)
def flattened_leaves(spark, sf):
    return M.flattened_leaves(
        X.loose_docs(spark, sf), "$.tree", "seq", null_value="none", ignore_above=5
    )


@query(
    "range_contains",
    _LOOSE + " SELECT seq, user_id AS low, user_id + seq % 7 AS high FROM loose"
    " WHERE user_id <= 42 AND 42 <= user_id + seq % 7",
)
def range_contains(spark, sf):
    mapping = [M.Field("span", "$.span", "long_range")]
    mapped = M.apply_mapping(X.loose_docs(spark, sf), mapping, "seq")
    rows = M.range_contains(mapped, "span", F.lit(42))
    return rows.select("seq", F.col("span.gte").alias("low"), F.col("span.lte").alias("high"))


@query(
    "geo_normalize",
    """SELECT event_id AS seq,
      CAST(CASE WHEN event_id % 6 IN (0, 3, 4) THEN event_id % 90 + 0.5 ELSE -999 END AS DOUBLE) AS lat,
      CAST(CASE WHEN event_id % 6 IN (0, 3, 4) THEN -(event_id % 180 + 0.25) ELSE -999 END AS DOUBLE) AS lon
    FROM events""",
)
def geo_normalize(spark, sf):
    point = F.try_variant_get(parse_document(F.col("raw")), "$.point", "variant")
    rows = M.geo_normalize(X.geo_docs(spark, sf).select("seq", point.alias("v")), "v", "p")
    return rows.select("seq", "p.lat", "p.lon").na.fill(-999.0)


@query(
    "keyword_normalizer",
    _LOOSE + " SELECT lower(trim(label)) AS label, count(*) AS documents FROM loose GROUP BY 1",
)
def keyword_normalizer(spark, sf):
    label = F.get_json_object("raw", "$.label")
    return X.loose_docs(spark, sf).groupBy(M.keyword_normalizer(label).alias("label")).agg(
        F.count(F.lit(1)).alias("documents")
    )


@query(
    "sample_generate",
    """SELECT o_orderkey, o_orderkey % 2147483647 AS id, o_orderkey % 127 AS size,
         o_orderkey / 2.0 AS price, o_orderkey % 2 = 0 AS active, 'name-' || o_orderkey AS name
       FROM orders""",
)
def sample_generate(spark, sf):
    schema = {
        "id": "long", "size": "byte", "price": "double", "active": "boolean", "name": "keyword",
    }
    return M.sample_generate(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", schema)


# Documents that hold every further type, one value or several, and range ends that cannot be read.
_KINDS_RAW = """concat('{"none": ', case when event_id % 2 = 0 then 'null' else cast(user_id as string) end,
    ', "obj": ', case event_id % 3 when 0 then '[1]' else concat('{"a": {"b": ', user_id, '}}') end,
    ', "items": ', case event_id % 3 when 0 then '[{"q": 1}, {"q": 2}]' when 1 then '{"q": 3}' else '[1]' end,
    ', "point": ', case event_id % 3 when 0 then concat('"', event_id % 90, '.5,7.25"')
        when 1 then concat('[7.25, ', event_id % 90, '.5]') else '"u4pru"' end,
    ', "shape": "POINT (1 2)", "suggest": ',
    case event_id % 3 when 0 then '"x"' when 1 then '{"input": ["x", "y"], "weight": 2}'
        else '[{"input": "z", "weight": 5}]' end,
    ', "words": "', event_type, ' two  three", "rel": ',
    case event_id % 2 when 0 then '"q"' else concat('{"name": "a", "parent": "', user_id, '"}') end,
    ', "tags": ', case event_id % 4 when 0 then concat('["', event_type, '", "b"]') when 1 then '"one"'
        when 2 then '["a", {"c": 1}]' else 'null' end,
    ', "nums": [1, "', user_id, '", null], "span": ',
    case event_id % 3 when 0 then '{"gte": "bad", "lte": 9}' when 1 then '{"gte": 2.5}'
        else concat('{"gte": 1, "lte": "', user_id, '"}') end, '}')"""


@query(
    "typed_kinds",
    """SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS none,
      CASE WHEN event_id % 3 = 0 THEN '' ELSE '{"a":{"b":' || user_id || '}}' END AS obj,
      CASE WHEN event_id % 3 = 0 THEN '' ELSE 'a.b=' || user_id END AS flat,
      CASE event_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE -1 END AS items,
      CASE WHEN event_id % 3 = 2 THEN '' ELSE (event_id % 90) || '.5/7.25' END AS point,
      '"POINT (1 2)"' AS shape,
      CASE event_id % 3 WHEN 0 THEN 'x:' WHEN 1 THEN 'x:2,y:2' ELSE 'z:5' END AS suggest,
      len(list_filter(regexp_split_to_array(lower(event_type || ' two  three'), '[^\\p{L}\\p{N}]+'), lambda t: t <> ''))
        AS words,
      CASE event_id % 2 WHEN 0 THEN 'q/' ELSE 'a/' || user_id END AS rel,
      CASE event_id % 4 WHEN 0 THEN event_type || ',b' WHEN 1 THEN 'one' ELSE '' END AS tags,
      '1,' || user_id AS nums,
      CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '2-' ELSE '1-' || user_id END AS span,
      array_to_string(list_filter([
        CASE WHEN event_id % 3 = 0 THEN 'obj' END, CASE WHEN event_id % 3 = 0 THEN 'flat' END,
        CASE WHEN event_id % 3 = 2 THEN 'items' END, CASE WHEN event_id % 3 = 2 THEN 'point' END,
        CASE WHEN event_id % 4 = 2 THEN 'tags' END, CASE WHEN event_id % 3 = 0 THEN 'span' END],
        lambda t: t IS NOT NULL), ',') AS malformed
    FROM events""",
)
def typed_kinds(spark, sf):
    docs = table(spark, sf, "events").select(
        F.col("event_id").cast("bigint").alias("seq"), F.expr(_KINDS_RAW).alias("raw")
    )
    mapped = M.apply_mapping(docs, [
        M.Field("none", "$.none", "null"), M.Field("obj", "$.obj", "object"),
        M.Field("flat", "$.obj", "flattened"), M.Field("items", "$.items", "nested"),
        M.Field("point", "$.point", "geo_point"), M.Field("shape", "$.shape", "geo_shape"),
        M.Field("suggest", "$.suggest", "completion"), M.Field("words", "$.words", "token_count"),
        M.Field("rel", "$.rel", "join"), M.Field("tags", "$.tags", "keyword", many=True),
        M.Field("nums", "$.nums", "long", many=True), M.Field("span", "$.span", "long_range"),
    ], "seq")

    def text(value):
        return F.coalesce(value.cast("string"), F.lit(""))

    def pair(column, one, two, sign):
        shown = F.concat(text(F.col(column)[one]), F.lit(sign), text(F.col(column)[two]))
        return F.when(F.col(column).isNull(), "").otherwise(shown).alias(column)

    flat = F.transform(F.map_entries("flat"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    inputs = F.transform("suggest", lambda e: F.concat(e["input"], F.lit(":"), text(e["weight"])))
    return mapped.select(
        "seq", text(F.col("none")).alias("none"), text(F.to_json("obj")).alias("obj"),
        text(F.array_join(flat, ",")).alias("flat"),
        F.coalesce(F.size("items"), F.lit(-1)).cast("bigint").alias("items"),
        pair("point", "lat", "lon", "/"), F.to_json("shape").alias("shape"),
        F.array_join(inputs, ",").alias("suggest"), F.col("words").cast("bigint").alias("words"),
        pair("rel", "name", "parent", "/"), text(F.array_join("tags", ",")).alias("tags"),
        F.array_join(F.col("nums").cast("array<string>"), ",").alias("nums"),
        pair("span", "gte", "lte", "-"), F.array_join("_malformed", ",").alias("malformed"),
    )
