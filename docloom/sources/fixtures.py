"""Document collections built from the given tables by deterministic expressions.

The tables hold no missing keys, mixed types or geo values, so these expressions make them.
Each ``*_SQL`` constant states the same construction for the SQL check: either as documents
with their text or, for the profile, as one row per top-level field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources.tables import table


def _rows(spark: SparkSession, sf_dir: str, name: str, index: str, seq: str, raw: str) -> DataFrame:
    return table(spark, sf_dir, name).select(
        F.lit(index).alias("_index"),
        F.expr(f"cast({seq} as string)").alias("_id"),
        F.expr(f"cast({seq} as bigint)").alias("seq"),
        F.expr(raw).alias("raw"),
    )


def event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection ``events``: ``user`` is sometimes missing, ``k`` number, string or null."""
    return _rows(
        spark, sf_dir, "events", "events", "event_id",
        """concat('{"event_id": ', event_id, ', "type": "', event_type, '"',
             case when event_id % 10 = 0 then '' else concat(', "user": ', user_id) end,
             ', "k": ',
             case when event_id % 7 = 0 then 'null'
                  when event_id % 11 = 0 then concat('"', get_json_object(props, '$.k'), '"')
                  else get_json_object(props, '$.k') end, '}')""",
    )


def with_broken(docs: DataFrame) -> DataFrame:
    """``docs`` and, for some of them, a broken copy with a negative ``seq``: a key given twice, text behind
    the object, an object cut short, or an array."""
    broken = docs.where("seq % 97 = 5").select(
        "_index", "_id", (-F.col("seq")).alias("seq"),
        F.expr("""case seq % 4 when 0 then concat('{"id": 0, ', substr(raw, 2)) when 1 then concat(raw, ' x')
                  when 2 then '{broken' else '[1]' end""").alias("raw"),
    )
    return docs.unionByName(broken)


EVENT_FIELDS_SQL = """
  event_rows AS (
    SELECT event_id AS seq, event_type, user_id, event_id, regexp_extract(props, '[0-9]+') AS k
    FROM events),
  event_fields AS (
    SELECT 'events' AS _index, seq, 0 AS pos, 'event_id' AS key, 'number' AS type,
           CAST(event_id AS VARCHAR) AS val FROM event_rows
    UNION ALL SELECT 'events', seq, 1, 'type', 'string', event_type FROM event_rows
    UNION ALL SELECT 'events', seq, 2, 'user', 'number', CAST(user_id AS VARCHAR) FROM event_rows
      WHERE event_id % 10 <> 0
    UNION ALL SELECT 'events', seq, 2 + CAST(event_id % 10 <> 0 AS INT), 'k',
      CASE WHEN event_id % 7 = 0 THEN 'null' WHEN event_id % 11 = 0 THEN 'string' ELSE 'number' END,
      CASE WHEN event_id % 7 = 0 THEN 'null' ELSE k END FROM event_rows)"""

# The kind member of the mixed collection: mostly there, sometimes missing, empty or null.
_KIND = """case when {seq} % 50 = 0 then '' when {seq} % 50 = 1 then '"kind": "", '
           when {seq} % 50 = 2 then '"kind": null, ' else '"kind": "{name}", ' end"""


def mixed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection ``mixed``: customers, orders and suppliers told apart by ``kind``.

    ``info.ref`` is an object in two kinds and text in the third; ``tags`` varies in length.
    """
    customers = _rows(
        spark, sf_dir, "customer", "mixed", "c_custkey * 3",
        f"""concat('{{', {_KIND.format(seq="(c_custkey * 3)", name="customer")}, '"id": ', c_custkey,
            ', "name": "', c_name, '", "info": {{"ref": {{"nation": ', c_nationkey, '}}, "seg": "',
            c_mktsegment, '"}}, "tags": ["n', c_nationkey, '"',
            case when c_custkey % 2 = 0 then ', "even"' else '' end, ']}}')""",
    )
    orders = _rows(
        spark, sf_dir, "orders", "mixed", "o_orderkey * 3 + 1",
        f"""concat('{{', {_KIND.format(seq="(o_orderkey * 3 + 1)", name="order")}, '"id": ', o_orderkey,
            ', "cust": ', o_custkey, ', "status": "', o_orderstatus, '", "info": {{"ref": "',
            o_orderpriority, '"}}}}')""",
    )
    suppliers = _rows(
        spark, sf_dir, "supplier", "mixed", "s_suppkey * 3 + 2",
        f"""concat('{{', {_KIND.format(seq="(s_suppkey * 3 + 2)", name="supplier")}, '"id": ', s_suppkey,
            ', "name": "', s_name, '", "info": {{"ref": {{"nation": ', s_nationkey,
            ', "acct": null}}}}, "tags": [',
            case when s_suppkey % 2 = 0 then '"s"' else '' end, ']}}')""",
    )
    return customers.unionByName(orders).unionByName(suppliers)


MIXED_ROWS_SQL = """
  mixed_raw AS (
    SELECT c_custkey * 3 AS seq, 'customer' AS origin, c_custkey AS id, c_name AS name,
           c_nationkey AS nation, c_mktsegment AS seg, NULL AS cust, NULL AS status,
           NULL AS priority FROM customer
    UNION ALL SELECT o_orderkey * 3 + 1, 'order', o_orderkey, NULL, NULL, NULL, o_custkey,
           o_orderstatus, o_orderpriority FROM orders
    UNION ALL SELECT s_suppkey * 3 + 2, 'supplier', s_suppkey, s_name, s_nationkey, NULL, NULL,
           NULL, NULL FROM supplier),
  mixed_rows AS (
    SELECT *, seq % 50 <> 0 AS has_kind,
      CASE seq % 50 WHEN 0 THEN 'undefined' WHEN 1 THEN '' WHEN 2 THEN 'null' ELSE origin END AS kind
    FROM mixed_raw)"""

# Top-level fields; containers carry their number of members as ``val``.
MIXED_FIELDS_SQL = (
    MIXED_ROWS_SQL
    + """,
  mixed_fields AS (
    SELECT 'mixed' AS _index, seq, 0 AS pos, 'kind' AS key,
           CASE WHEN seq % 50 = 2 THEN 'null' ELSE 'string' END AS type, kind AS val
      FROM mixed_rows WHERE has_kind
    UNION ALL SELECT 'mixed', seq, CAST(has_kind AS INT), 'id', 'number', CAST(id AS VARCHAR)
      FROM mixed_rows
    UNION ALL SELECT 'mixed', seq, CAST(has_kind AS INT) + 1, 'name', 'string', name
      FROM mixed_rows WHERE origin <> 'order'
    UNION ALL SELECT 'mixed', seq, CAST(has_kind AS INT) + 1, 'cust', 'number', CAST(cust AS VARCHAR)
      FROM mixed_rows WHERE origin = 'order'
    UNION ALL SELECT 'mixed', seq, CAST(has_kind AS INT) + 2, 'status', 'string', status
      FROM mixed_rows WHERE origin = 'order'
    UNION ALL SELECT 'mixed', seq, CAST(has_kind AS INT) + CASE origin WHEN 'order' THEN 3 ELSE 2 END,
      'info', 'object',
      CASE origin
        WHEN 'customer' THEN '{"ref":{"nation":' || nation || '},"seg":"' || seg || '"}'
        WHEN 'order' THEN '{"ref":"' || priority || '"}'
        ELSE '{"ref":{"acct":null,"nation":' || nation || '}}' END FROM mixed_rows
    UNION ALL SELECT 'mixed', seq, CAST(has_kind AS INT) + 3, 'tags', 'array',
      CASE WHEN origin = 'customer'
           THEN '["n' || nation || '"' || CASE WHEN id % 2 = 0 THEN ',"even"' ELSE '' END || ']'
           WHEN id % 2 = 0 THEN '["s"]' ELSE '[]' END
      FROM mixed_rows WHERE origin <> 'order')"""
)

FIELDS_SQL = (
    "WITH "
    + EVENT_FIELDS_SQL
    + ","
    + MIXED_FIELDS_SQL
    + """,
  fields AS (SELECT * FROM event_fields UNION ALL SELECT * FROM mixed_fields),
  totals AS (SELECT _index, count(DISTINCT seq) AS total FROM fields GROUP BY 1)"""
)


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collections ``events`` and ``mixed`` together."""
    return event_docs(spark, sf_dir).unionByName(mixed_docs(spark, sf_dir))


def visit_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection ``visits``: ``by_user`` has a key of its own in every second document, and is text in a
    few early ones."""
    return _rows(
        spark, sf_dir, "events", "visits", "event_id",
        """concat('{"type": "', event_type, '"',
             case when event_id % 2 = 0 then concat(', "by_user": {"u', event_id, '": {"at": ', event_id, '}}')
                  when event_id < 50 then ', "by_user": "none"' else '' end,
             case when event_id % 3 = 0 then concat(', "deep": {"user": ', user_id, '}') else '' end, '}')""",
    )


def catalog_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collections, two system ones, and one whose name only looks like a system one."""
    parts = [
        collections(spark, sf_dir),
        _rows(spark, sf_dir, "supplier", ".security", "s_suppkey",
              """concat('{"id": ', s_suppkey, '}')"""),
        _rows(spark, sf_dir, "part", "APM-7.17.0-span", "p_partkey",
              """concat('{"id": ', p_partkey, '}')"""),
        _rows(spark, sf_dir, "part", "apm-agent", "p_partkey",
              """concat('{"id": ', p_partkey, ', "brand": "', p_brand, '"}')"""),
    ]
    all_docs = parts[0]
    for part in parts[1:]:
        all_docs = all_docs.unionByName(part)
    return all_docs


CATALOG_SQL = """
  catalog AS (
    SELECT 'events' AS _index, event_id AS seq FROM events
    UNION ALL SELECT 'mixed', c_custkey * 3 FROM customer
    UNION ALL SELECT 'mixed', o_orderkey * 3 + 1 FROM orders
    UNION ALL SELECT 'mixed', s_suppkey * 3 + 2 FROM supplier
    UNION ALL SELECT '.security', s_suppkey FROM supplier
    UNION ALL SELECT 'APM-7.17.0-span', p_partkey FROM part
    UNION ALL SELECT 'apm-agent', p_partkey FROM part)"""


def geo_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection ``places``: a point in six forms, a shape in nine, a completion in three."""
    lat = "event_id % 90"
    lon = "event_id % 180"
    return _rows(
        spark, sf_dir, "events", "places", "event_id",
        f"""concat('{{"point": ',
          case event_id % 6
            when 0 then concat('"', {lat}, '.5,-', {lon}, '.25"')
            when 1 then concat('"', {lat}, ',-', {lon}, '"')
            when 2 then '"u4pruydq"'
            when 3 then concat('[-', {lon}, '.25, ', {lat}, '.5]')
            when 4 then concat('{{"lat": ', {lat}, '.5, "lon": -', {lon}, '.25}}')
            else concat('{{"top_left": {{"lat": ', {lat}, ', "lon": 1}}, "bottom_right": {{"lat": 1, "lon": ',
                        {lon}, '}}}}') end,
          ', "shape": ',
          case event_id % 9
            when 0 then '"POINT (1 2)"' when 1 then '" linestring(1 2, 3 4)"'
            when 2 then '"Polygon ((1 2))"' when 3 then '"MULTIPOINT (1 2)"'
            when 4 then '"BBOX (1, 2, 3, 4)"' when 5 then '"circle"'
            when 6 then '{{"type": "MultiPolygon", "coordinates": []}}'
            when 7 then '{{"coordinates": [1, 2]}}' else 'null' end,
          ', "suggest": ',
          case event_id % 3
            when 0 then '[{{"input": "a", "weight": 1}}]'
            when 1 then '{{"input": ["a"], "weight": 2}}' else '"plain"' end, '}}')""",
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events collection as text lines; some are cut off, lack ``_index`` or hold a list."""
    return event_docs(spark, sf_dir).select(
        F.expr(
            """case when seq % 47 = 0 then concat('{"_index": "events", "_id": "', _id, '", "seq": ', seq)
               else concat('{', case when seq % 43 = 0 then '' else '"_index": "events", ' end,
                 '"_id": "', _id, '", "seq": ', seq, ', "_source": ',
                 case when seq % 41 = 0 then '[1]' else raw end, '}') end"""
        ).alias("value")
    )


# What is wrong with each line; the empty text marks a good one.
LINES_SQL = """
  lines AS (
    SELECT event_id AS seq, event_type,
      CASE WHEN event_id % 47 = 0 THEN 'bad_json' WHEN event_id % 43 = 0 THEN 'no_index'
           WHEN event_id % 41 = 0 THEN 'bad_source' ELSE '' END AS problem FROM events)"""


def loose_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection ``loose``: numbers as text, dates in several forms, unmapped keys, objects.

    ``n`` is a whole number, numeric text, a fraction, fractional text or a word, and sometimes
    null or missing.
    """
    return _rows(
        spark, sf_dir, "events", "loose", "event_id",
        """concat('{"id": ', event_id,
          case when event_id % 17 = 0 then '' else concat(', "n": ', case
            when event_id % 13 = 0 then 'null' when event_id % 5 = 0 then cast(user_id as string)
            when event_id % 5 = 1 then concat('"', user_id, '"')
            when event_id % 5 = 2 then concat(user_id, '.5')
            when event_id % 5 = 3 then concat('"', user_id, '.75"') else '"many"' end) end,
          ', "label": "', case when event_id % 3 = 0 then concat('  ', upper(event_type), ' ')
                               else event_type end, '"',
          ', "day": "', case event_id % 4 when 0 then date_format(ts, 'yyyy/MM/dd')
            when 1 then date_format(ts, 'dd-MM-yyyy') when 2 then date_format(ts, 'yyyy/MM/dd')
            else 'soon' end, '"',
          case when event_id % 6 = 0 then concat(', "extra": ', event_id) else '' end,
          case when event_id % 15 = 0 then ', "note": "free"' else '' end,
          ', "span": {"gte": ', user_id, ', "lte": ', user_id + event_id % 7, '}',
          ', "tree": {"a": {"b": ', user_id, ', "c": null}, "d": "', event_type, '"}',
          ', "items": [', case event_id % 3 when 0 then '' when 1 then
             concat('{"sku": "s', user_id, '", "qty": 1}') else
             concat('{"sku": "s', user_id, '", "qty": 2}, {"sku": "t", "qty": ', event_id % 9, '}') end,
          ']}')""",
    )


LOOSE_SQL = """
  loose AS (
    SELECT event_id AS seq, user_id, event_type, ts,
      event_id % 17 <> 0 AS has_n, event_id % 17 <> 0 AND event_id % 13 = 0 AS null_n,
      event_id % 5 AS form,
      CASE WHEN event_id % 3 = 0 THEN '  ' || upper(event_type) || ' ' ELSE event_type END AS label,
      CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y/%m/%d') WHEN 1 THEN strftime(ts, '%d-%m-%Y')
        WHEN 2 THEN strftime(ts, '%Y/%m/%d') ELSE 'soon' END AS day
    FROM events)"""
