"""Registered queries: classes of values."""

from __future__ import annotations

from docloom.operators import census as C
from docloom.plans.registry import query
from docloom.sources import fixtures as X

_MODE = """CASE WHEN x > -128 AND x < 127 THEN 'byte' WHEN x > -32768 AND x < 32767 THEN 'short'
  WHEN x > -2147483648 AND x < 2147483647 THEN 'integer' ELSE 'long' END"""


@query(
    "value_type_census",
    X.FIELDS_SQL + " SELECT _index, key, type, count(*) AS cnt FROM fields GROUP BY 1, 2, 3",
)
def value_type_census(spark, sf):
    return C.value_type_census(X.collections(spark, sf))


@query(
    "number_mode_census",
    X.FIELDS_SQL + f"""
    SELECT _index, key, {_MODE} AS mode, count(*) AS cnt
    FROM (SELECT *, CAST(val AS BIGINT) AS x FROM fields WHERE type = 'number') GROUP BY 1, 2, 3""",
)
def number_mode_census(spark, sf):
    return C.number_mode_census(X.collections(spark, sf))


@query(
    "geo_point_census",
    """SELECT 'places' AS _index, 'point' AS key,
         CASE event_id % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'geohash' WHEN 2 THEN 'geohash'
              WHEN 3 THEN 'geoJSON' WHEN 4 THEN 'object' ELSE 'geo-bounding' END AS subtype,
         count(*) AS cnt
       FROM events GROUP BY 3""",
)
def geo_point_census(spark, sf):
    return C.geo_point_census(X.geo_docs(spark, sf), "point")


@query(
    "geo_shape_census",
    """SELECT 'places' AS _index, 'shape' AS key,
         CASE event_id % 9 WHEN 0 THEN 'point' WHEN 1 THEN 'linestring' WHEN 2 THEN 'polygon'
              WHEN 3 THEN 'multipoint' WHEN 4 THEN 'envelope' WHEN 6 THEN 'MultiPolygon'
              WHEN 7 THEN 'point' END AS subtype,
         count(*) AS cnt
       FROM events GROUP BY 3""",
)
def geo_shape_census(spark, sf):
    return C.geo_shape_census(X.geo_docs(spark, sf), "shape")


@query(
    "completion_census",
    """SELECT 'places' AS _index, 'suggest' AS key,
         CASE event_id % 3 WHEN 0 THEN 'array' ELSE 'object' END AS subtype, count(*) AS cnt
       FROM events GROUP BY 3""",
)
def completion_census(spark, sf):
    return C.completion_census(X.geo_docs(spark, sf), "suggest")


# Declared types of some paths; the others are classified by their values.
DECLARED = {
    "$.event_id": "long",
    "$.type": "keyword",
    "$.point": "geo_point",
    "$.id": "scaled_float",
    "$.info.seg": "ip",
}


@query(
    "type_family",
    X.FIELDS_SQL + f""",
    members AS (
      SELECT _index, '$.' || key AS path, type, val FROM fields
      UNION ALL SELECT 'mixed', '$.info.ref', CASE origin WHEN 'order' THEN 'string' ELSE 'object' END, ''
        FROM mixed_rows
      UNION ALL SELECT 'mixed', '$.info.seg', 'string', '' FROM mixed_rows WHERE origin = 'customer'
      UNION ALL SELECT 'mixed', '$.info.ref.nation', 'number', CAST(nation AS VARCHAR)
        FROM mixed_rows WHERE origin <> 'order'
      UNION ALL SELECT 'mixed', '$.info.ref.acct', 'null', '' FROM mixed_rows WHERE origin = 'supplier')
    SELECT _index, path,
      CASE WHEN path = '$.event_id' THEN 'number' WHEN path = '$.type' THEN 'string'
           WHEN path = '$.id' THEN 'number' WHEN path = '$.info.seg' THEN 'ip'
           WHEN type = 'null' THEN 'object' ELSE type END AS family,
      CASE WHEN path = '$.event_id' THEN 'long' WHEN path = '$.type' THEN 'keyword'
           WHEN path = '$.id' THEN 'scaled_float' WHEN path = '$.info.seg' THEN NULL
           WHEN type = 'string' THEN 'text' WHEN type = 'number' THEN {_MODE} END AS mode,
      count(*) AS cnt
    FROM (SELECT *, CASE WHEN type = 'number' THEN CAST(val AS BIGINT) END AS x FROM members)
    GROUP BY 1, 2, 3, 4""",
)
def type_family(spark, sf):
    return C.type_family(X.collections(spark, sf), DECLARED)
