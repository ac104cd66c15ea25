"""Registered queries: merged templates, kind schemas, schema merge and drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators import profile as P
from docloom.operators import schema as S
from docloom.plans.registry import query
from docloom.session import materialize, scratch_path
from docloom.sources.documents import parsed_once
from docloom.sources import fixtures as X

# Every node of the mixed collection below the root, with what it was set to and when.
_EVENTS = (
    "WITH " + X.MIXED_FIELDS_SQL + """,
    top AS (
      SELECT r.kind, f.seq, '_source.' || f.key AS path, '' AS parent,
        CASE f.type WHEN 'object' THEN 'object' WHEN 'array' THEN 'array' ELSE 'scalar' END AS cls,
        CASE f.type WHEN 'string' THEN '"' || f.val || '"' ELSE f.val END AS value
      FROM mixed_fields f JOIN mixed_rows r USING (seq)),
    inner_nodes AS (
      SELECT kind, seq, '_source.info.ref' AS path, '_source.info' AS parent,
        CASE origin WHEN 'order' THEN 'scalar' ELSE 'object' END AS cls,
        CASE origin WHEN 'order' THEN '"' || priority || '"' END AS value FROM mixed_rows
      UNION ALL SELECT kind, seq, '_source.info.seg', '_source.info', 'scalar', '"' || seg || '"'
        FROM mixed_rows WHERE origin = 'customer'
      UNION ALL SELECT kind, seq, '_source.info.ref.nation', '_source.info.ref', 'scalar',
        CAST(nation AS VARCHAR) FROM mixed_rows WHERE origin <> 'order'
      UNION ALL SELECT kind, seq, '_source.info.ref.acct', '_source.info.ref', 'scalar', 'null'
        FROM mixed_rows WHERE origin = 'supplier'
      UNION ALL SELECT kind, seq, '_source.tags[0]', '_source.tags', 'scalar', '"n' || nation || '"'
        FROM mixed_rows WHERE origin = 'customer'
      UNION ALL SELECT kind, seq, '_source.tags[0]', '_source.tags', 'scalar', '"s"'
        FROM mixed_rows WHERE origin = 'supplier' AND id % 2 = 0
      UNION ALL SELECT kind, seq, '_source.tags[1]', '_source.tags', 'scalar', '"even"'
        FROM mixed_rows WHERE origin = 'customer' AND id % 2 = 0),
    ev AS (SELECT * FROM top UNION ALL SELECT * FROM inner_nodes),
    finals AS (
      SELECT kind, path, arg_max(parent, seq) AS parent, max(seq) AS last,
             arg_max(cls, seq) AS cls, arg_max(value, seq) AS value FROM ev GROUP BY 1, 2),
    alive AS (
      SELECT * FROM finals f WHERE NOT EXISTS (
        SELECT 1 FROM ev e WHERE e.kind = f.kind AND e.path = f.parent AND e.cls = 'scalar'
          AND e.seq > f.last))"""
)


def _kinded(docs):
    """Documents with their kind, parsed and written once: what follows reads them several times."""
    docs = parsed_once(docs)
    return materialize(P.with_kind(docs, P.chosen_kind_fields(docs)), "kinded")


def _mixed(spark, sf):
    return _kinded(X.mixed_docs(spark, sf))


@query(
    "merged_template",
    _EVENTS + """
    SELECT 'mixed' AS _index, kind, path, value FROM alive WHERE cls = 'scalar'
    UNION ALL SELECT 'mixed', kind, path, '[]' FROM alive a WHERE cls = 'array'
      AND NOT EXISTS (SELECT 1 FROM alive c WHERE c.kind = a.kind AND c.parent = a.path)
    UNION ALL SELECT 'mixed', kind, '_index', '"mixed"' FROM mixed_rows GROUP BY kind
    UNION ALL SELECT 'mixed', kind, '_id', '"' || max(seq) || '"' FROM mixed_rows GROUP BY kind""",
)
def merged_template(spark, sf):
    return S.merged_template(_mixed(spark, sf))


# A declared mapping of the mixed collection; ``lost`` is in no document.
MAPPING = {
    "_source.kind": "keyword",
    "_source.id": "long",
    "_source.name": "text",
    "_source.status": "keyword",
    "_source.info": "object",
    "_source.info.ref": "object",
    "_source.info.ref.nation": "integer",
    "_source.info.ref.acct": "double",
    "_source.info.seg": "keyword",
    "_source.tags": "keyword",
    "_source.lost": "date",
}
_MAPPING_SQL = "mapping(path, type) AS (VALUES " + ", ".join(
    f"('{path}', '{type_}')" for path, type_ in MAPPING.items()
) + ")"


def _mapping(spark):
    rows = [("mixed", path, type_) for path, type_ in MAPPING.items()]
    return spark.createDataFrame(rows, "_index string, path string, type string")


@query(
    "kind_schema",
    _EVENTS + f""", {_MAPPING_SQL},
    kinds AS (SELECT DISTINCT kind, false AS everything FROM mixed_rows WHERE kind <> ''
              UNION ALL SELECT 'indexMappingConfig', true)
    SELECT 'mixed' AS _index, k.kind, m.path, m.type FROM kinds k CROSS JOIN mapping m
    WHERE k.everything
      OR EXISTS (SELECT 1 FROM alive a WHERE a.kind = k.kind AND a.path = m.path)""",
)
def kind_schema(spark, sf):
    kinded = _mixed(spark, sf)
    return S.kind_schema(kinded, P.distinct_kinds(kinded), _mapping(spark))


@query(
    "drop_empty_kinds",
    _EVENTS + f""", {_MAPPING_SQL},
    listed AS (
      SELECT DISTINCT 'mixed' AS _index, kind FROM mixed_rows WHERE kind <> ''
      UNION ALL SELECT DISTINCT 'events', event_type FROM events
      UNION ALL SELECT 'mixed', 'ghost' UNION ALL SELECT 'events', 'ghost'),
    documents AS (
      SELECT 'mixed' AS _index, kind, count(*) AS n FROM mixed_rows GROUP BY 2
      UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY 2),
    fields AS (
      SELECT 'mixed' AS _index, kind, count(*) AS n FROM alive JOIN mapping USING (path) GROUP BY 2
      UNION ALL SELECT 'mixed', 'ghost', count(*) FROM mapping)
    SELECT l._index, l.kind, coalesce(d.n, 0) AS documents, coalesce(f.n, 0) AS fields
    FROM listed l LEFT JOIN documents d USING (_index, kind) LEFT JOIN fields f USING (_index, kind)
    WHERE coalesce(d.n, 0) > 0 OR coalesce(f.n, 0) > 0""",
)
def drop_empty_kinds(spark, sf):
    kinded = _kinded(X.collections(spark, sf))
    found = P.distinct_kinds(kinded).select("_index", "kind")
    ghosts = found.select("_index").distinct().withColumn("kind", F.lit("ghost"))
    listed = found.unionByName(ghosts)
    return S.drop_empty_kinds(listed, kinded, S.kind_schema(kinded, listed, _mapping(spark)))


@query(
    "schema_merge",
    _EVENTS + """,
    starts AS (SELECT kind, min(seq) AS kind_order FROM mixed_rows GROUP BY 1)
    SELECT 'mixed' AS _index, path, cls AS type, kind FROM (
      SELECT *, row_number() OVER (PARTITION BY path ORDER BY cls = 'object' DESC, kind_order) AS rn
      FROM alive JOIN starts USING (kind) WHERE path NOT LIKE '%]') WHERE rn = 1""",
)
def schema_merge(spark, sf):
    return S.schema_merge(S.observed_schema(_mixed(spark, sf)))


@query(
    "new_fields",
    "WITH " + X.MIXED_FIELDS_SQL + """,
    paths AS (
      SELECT origin, '$.' || key AS path, type FROM mixed_fields JOIN mixed_rows USING (seq)
      UNION ALL SELECT origin, '$.info.ref', CASE origin WHEN 'order' THEN 'string' ELSE 'object' END
        FROM mixed_rows
      UNION ALL SELECT origin, '$.info.seg', 'string' FROM mixed_rows WHERE origin = 'customer'
      UNION ALL SELECT origin, '$.info.ref.nation', 'number' FROM mixed_rows WHERE origin <> 'order'
      UNION ALL SELECT origin, '$.info.ref.acct', 'null' FROM mixed_rows WHERE origin = 'supplier')
    SELECT DISTINCT 'mixed' AS _index, replace(path, '$', '_source') AS path, type FROM paths
    WHERE origin <> 'order' AND path NOT IN (SELECT path FROM paths WHERE origin = 'order')""",
)
def new_fields(spark, sf):
    docs = X.mixed_docs(spark, sf)
    is_order = F.get_json_object("raw", "$.cust").isNotNull()
    return S.new_fields(docs.where(is_order), docs.where(~is_order))


@query(
    "kind_union",
    "WITH " + X.MIXED_ROWS_SQL + """
    SELECT 'mixed' AS _index, seq, kind AS _kind,
      CASE seq % 50 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN NULL ELSE origin END AS kind,
      CAST(id AS VARCHAR) AS id, name, CAST(cust AS VARCHAR) AS cust, status,
      CAST(NULL AS VARCHAR) AS info, priority AS info_ref, CAST(nation AS VARCHAR) AS info_ref_nation,
      CAST(NULL AS VARCHAR) AS info_ref_acct, seg AS info_seg,
      CASE WHEN origin = 'customer'
           THEN '["n' || nation || '"' || CASE WHEN id % 2 = 0 THEN ',"even"' ELSE '' END || ']'
           WHEN origin = 'supplier' AND id % 2 = 0 THEN '["s"]' WHEN origin = 'supplier' THEN '[]' END AS tags
    FROM mixed_rows""",
)
def kind_union(spark, sf):
    kinded = _mixed(spark, sf)
    return S.kind_union(kinded, S.schema_merge(S.observed_schema(kinded)))


@query(
    "write_by_kind",
    "WITH " + X.MIXED_ROWS_SQL + """
    SELECT 'mixed' AS _index, kind, count(*) AS documents, CAST(sum(seq) AS BIGINT) AS seq_sum
    FROM mixed_rows GROUP BY 2""",
)
def write_by_kind(spark, sf):
    path = scratch_path(spark, "by-kind")
    S.write_by_kind(_mixed(spark, sf), path)
    return spark.read.parquet(f"{path}/data").groupBy("_index", "kind").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("seq").alias("seq_sum")
    )


@query(
    "read_kind",
    "WITH " + X.MIXED_ROWS_SQL + """
    SELECT 'mixed' AS _index, kind, seq FROM mixed_rows WHERE kind IN ('supplier', 'null', '')""",
)
def read_kind(spark, sf):
    path = scratch_path(spark, "by-kind")
    S.write_by_kind(_mixed(spark, sf), path, file_bytes=1 << 20)
    found = [S.read_kind(spark, path, "mixed", kind) for kind in ("supplier", "null", "", "nowhere")]
    return reduce(DataFrame.unionByName, found).select("_index", "kind", "seq")


@query(
    "kind_union_maps",
    """SELECT 'visits' AS _index, event_id AS seq, event_type AS kind, event_id % 2 = 0 AS has_map,
         CASE WHEN event_id % 2 = 0 THEN '{"at":' || event_id || '}' END AS value,
         CASE WHEN event_id % 2 = 1 AND event_id < 50 THEN 'none' END AS other,
         CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS plain FROM events""",
)
def kind_union_maps(spark, sf):
    kinded = _kinded(X.visit_docs(spark, sf))
    table = S.kind_union(kinded, S.schema_merge(S.observed_schema(kinded)))
    user = F.concat(F.lit("u"), F.col("seq").cast("string"))
    return table.select(
        "_index", "seq", F.col("type").alias("kind"), F.col("by_user").isNotNull().alias("has_map"),
        F.try_element_at("by_user", user).alias("value"), F.col("by_user_other").alias("other"),
        F.col("deep_user").alias("plain"),
    )
