"""Registered queries: sinks, filtered views, parent/child rows, constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import constraints as C
from docloom.operators import relations as R
from docloom.plans.registry import ORACLES, query
from docloom.session import scratch_path
from docloom.sources import documents as D
from docloom.sources import fixtures as X
from docloom.sources import sinks
from docloom.sources.tables import table


def write_lines(spark, sf) -> str:
    path = scratch_path(spark, "lines")
    X.event_lines(spark, sf).write.text(path)
    return path


@query(
    "ndjson_scan",
    "WITH" + X.LINES_SQL + """
    SELECT problem, count(*) AS lines,
           CAST(sum(CASE WHEN problem IN ('', 'no_index') THEN seq ELSE 0 END) AS BIGINT) AS seq_sum
    FROM lines GROUP BY 1""",
)
def ndjson_scan(spark, sf):
    lines = D.ndjson_scan(spark, write_lines(spark, sf), mode="quarantine")
    kept = F.col("problem").isNull() | (F.col("problem") == "no_index")
    return lines.groupBy(F.coalesce("problem", F.lit("")).alias("problem")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(kept, F.col("seq")).otherwise(0)).alias("seq_sum"),
    )


@query(
    "create_if_absent",
    "SELECT event_type AS type, count(*) AS documents FROM events GROUP BY 1",
)
def create_if_absent(spark, sf):
    docs = D.with_source(X.event_docs(spark, sf))
    path = sinks.create_if_absent(docs, scratch_path(spark, "create"), "Events")
    type_ = F.try_variant_get("_source", "$.type", "string").alias("type")
    return spark.read.parquet(path).groupBy(type_).agg(F.count(F.lit(1)).alias("documents"))


@query(
    "append_validated",
    "WITH" + X.LINES_SQL + """
    SELECT CASE problem WHEN '' THEN 'stored' ELSE problem END AS outcome, count(*) AS documents,
           CAST(sum(CASE WHEN problem = '' THEN length(event_type) ELSE 0 END) AS BIGINT) AS type_chars
    FROM lines WHERE problem <> 'bad_json' GROUP BY 1""",
)
def append_validated(spark, sf):
    lines = D.ndjson_scan(spark, write_lines(spark, sf), mode="quarantine")
    docs = lines.where(F.coalesce("problem", F.lit("")) != "bad_json")
    docs = docs.select("_index", "_id", "_source")
    path = scratch_path(spark, "append")
    bad = sinks.append_validated(docs, path, on_bad="reject")
    stored = spark.read.parquet(path).select(
        F.lit("stored").alias("outcome"), F.try_variant_get("_source", "$.type", "string").alias("t")
    )
    rejected = bad.select(F.col("problem").alias("outcome"), F.lit("").alias("t"))
    return stored.unionByName(rejected).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length("t").cast("bigint")).alias("type_chars")
    )


@query(
    "append_repeated",
    """SELECT form, event_type AS type, count(*) AS documents FROM events, (VALUES ('ids'), ('token')) f(form)
       GROUP BY ALL""",
)
def append_repeated(spark, sf):
    docs = D.envelope(X.event_docs(spark, sf))
    half = docs.where("cast(_id as long) % 2 = 0")
    ids, token = scratch_path(spark, "append"), scratch_path(spark, "append")
    # A call that got half way, then the whole one twice.
    for rows in (half, docs, docs):
        sinks.append_validated(rows, ids, keep_id=True)
        sinks.append_validated(rows, token, token="batch-1")
    type_ = F.try_variant_get("_source", "$.type", "string").alias("type")
    found = [
        spark.read.parquet(path).select(F.lit(form).alias("form"), type_)
        for form, path in (("ids", ids), ("token", token))
    ]
    return found[0].unionByName(found[1]).groupBy("form", "type").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "load_collection",
    "WITH" + X.LINES_SQL + """
    SELECT 'events' AS _index, event_type AS type, count(*) + 1 AS documents
    FROM lines WHERE problem = '' GROUP BY 2""",
)
def load_collection(spark, sf):
    docs = X.event_docs(spark, sf)
    kinds = docs.groupBy(F.get_json_object("raw", "$.type").alias("kind")).agg(
        F.min_by(F.struct("_index", "_id", "raw"), "seq").alias("d")
    )
    generated = D.envelope(kinds.select("d.*"))
    lines = D.ndjson_scan(spark, write_lines(spark, sf), mode="quarantine")
    path, _ = sinks.load_collection(
        generated, [lines.select("_index", "_id", "_source")],
        scratch_path(spark, "load"), "Events", on_bad="reject",
    )
    type_ = F.try_variant_get("_source", "$.type", "string").alias("type")
    return spark.read.parquet(path).groupBy("_index", type_).agg(
        F.count(F.lit(1)).alias("documents")
    )


@query(
    "alias_term_filter",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'""",
)
def alias_term_filter(spark, sf):
    orders = table(spark, sf, "orders")
    view = R.filtered_view(
        orders, "filled_orders", "o_orderstatus", "F", "o_orderpriority", "2-HIGH"
    )
    return view.select("o_orderkey", "o_custkey")


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")


def _orders(spark, sf):
    return table(spark, sf, "orders")


@query(
    "parent_children",
    """SELECT c_custkey, c_mktsegment, o_orderkey, o_orderstatus
       FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def parent_children(spark, sf):
    children = _orders(spark, sf).select("o_custkey", "o_orderkey", "o_orderstatus")
    joined = R.parent_children(_customers(spark, sf), children, "c_custkey", "o_custkey")
    return joined.select("c_custkey", "c_mktsegment", "o_orderkey", "o_orderstatus")


@query(
    "has_child",
    """SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (
         SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""",
)
def has_child(spark, sf):
    big = F.col("o_totalprice") > 450_000
    parents = R.has_child(_customers(spark, sf), _orders(spark, sf), "c_custkey", "o_custkey", big)
    return parents.select("c_custkey", "c_mktsegment")


@query(
    "childless",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def childless(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey")
    return R.childless(orders, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


@query(
    "has_parent",
    """SELECT o_orderkey FROM orders WHERE o_custkey IN (
         SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def has_parent(spark, sf):
    machinery = F.col("c_mktsegment") == "MACHINERY"
    children = R.has_parent(
        _orders(spark, sf), _customers(spark, sf), "c_custkey", "o_custkey", machinery
    )
    return children.select("o_orderkey")


@query(
    "children_rollup",
    """SELECT o_orderkey, count(l_orderkey) AS children,
         CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18, 2))), 0) AS DOUBLE) AS total
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def children_rollup(spark, sf):
    total = {"total": F.col("l_extendedprice").cast("decimal(18,2)")}
    rolled = R.children_rollup(
        _orders(spark, sf).select("o_orderkey"), table(spark, sf, "lineitem"), "o_orderkey",
        "l_orderkey", total,
    )
    return rolled.withColumn("total", F.col("total").cast("double"))


@query(
    "multi_level",
    """SELECT c_custkey, o_orderkey, l_linenumber, l_quantity FROM customer
       JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey""",
)
def multi_level(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    joined = R.multi_level([
        (_customers(spark, sf), None, None),
        (_orders(spark, sf).select("o_orderkey", "o_custkey"), "c_custkey", "o_custkey"),
        (lines, "o_orderkey", "l_orderkey"),
    ])
    return joined.select("c_custkey", "o_orderkey", "l_linenumber", "l_quantity")


@query("multi_level_stored", ORACLES["multi_level"])
def multi_level_stored(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    path = scratch_path(spark, "chain")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    stored = R.store_chain([
        (_customers(spark, sf), None, None),
        (_orders(spark, sf).select("o_orderkey", "o_custkey"), "c_custkey", "o_custkey"),
        (lines, "o_orderkey", "l_orderkey"),
    ], "c_custkey", name, path, buckets=8)
    return R.multi_level_routed(stored).select("c_custkey", "o_orderkey", "l_linenumber", "l_quantity")


@query(
    "foreign_field",
    """SELECT s_suppkey, s_name, coalesce(n_name, '') AS n_name FROM (
         SELECT *, CASE WHEN s_suppkey % 9 = 0 THEN -1 ELSE s_nationkey END AS nation FROM supplier)
       LEFT JOIN nation ON nation = n_nationkey""",
)
def foreign_field(spark, sf):
    suppliers = table(spark, sf, "supplier").withColumn(
        "nation", F.expr("CASE WHEN s_suppkey % 9 = 0 THEN -1 ELSE s_nationkey END")
    )
    found = R.foreign_field(suppliers, table(spark, sf, "nation"), "nation", "n_nationkey")
    return found.select("s_suppkey", "s_name", F.coalesce("n_name", F.lit("")).alias("n_name"))


# Orders with some values taken out, pointed nowhere, or given twice.
_BROKEN_SQL = """WITH broken AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 97 = 0 THEN -1 WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END AS cust,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 79 = 0 THEN 1 ELSE o_orderkey END AS pk
  FROM orders)"""


def _broken(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "o_orderstatus",
        "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderpriority END AS priority",
        "CASE WHEN o_orderkey % 97 = 0 THEN -1 WHEN o_orderkey % 101 = 0 THEN NULL"
        " ELSE o_custkey END AS cust",
        "CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 79 = 0 THEN 1"
        " ELSE o_orderkey END AS pk",
    )


def _order_rules() -> dict[str, C.Rule]:
    priority = F.col("priority")
    return {
        "required": C.required("required", priority),
        "length": C.length("length", priority, 6, 10),
        "pattern": C.pattern("pattern", priority, "-(URGENT|HIGH|MEDIUM)"),
        "enum": C.enum("enum", F.col("o_orderstatus"), ["F", "O"]),
        "range": C.value_range("range", F.col("o_totalprice"), 1500.0, 450_000.0, True, False),
        "multiple_of": C.multiple_of("multiple_of", F.col("cust"), 7),
    }


# The same rules in SQL: rows the rule speaks about, and rows breaking it.
_ORDER_RULES_SQL = {
    "required": ("true", "priority IS NULL"),
    "length": ("priority IS NOT NULL", "length(priority) < 6 OR length(priority) > 10"),
    "pattern": (
        "priority IS NOT NULL", "NOT regexp_matches(priority, '-(URGENT|HIGH|MEDIUM)')"),
    "enum": ("o_orderstatus IS NOT NULL", "o_orderstatus NOT IN ('F', 'O')"),
    "range": ("o_totalprice IS NOT NULL", "o_totalprice <= 1500 OR o_totalprice > 450000"),
    "multiple_of": ("cust IS NOT NULL", "cust % 7 <> 0"),
}


def _register_order_rule(rule: str) -> None:
    checked, broken = _ORDER_RULES_SQL[rule]

    @query(
        f"chk_{rule}",
        _BROKEN_SQL + f"""
        SELECT '{rule}' AS rule, CAST(o_orderkey AS VARCHAR) AS key FROM broken
        WHERE ({checked}) AND ({broken})""",
    )
    def check(spark, sf):
        return C.violations(_broken(spark, sf), "o_orderkey", [_order_rules()[rule]])


for _rule in _ORDER_RULES_SQL:
    _register_order_rule(_rule)


@query(
    "chk_primary_key",
    _BROKEN_SQL + """ SELECT coalesce(CAST(pk AS VARCHAR), '') AS key, count(*) AS copies
    FROM broken GROUP BY pk HAVING pk IS NULL OR count(*) > 1""",
)
def chk_primary_key(spark, sf):
    return C.primary_key(_broken(spark, sf), "pk").na.fill("", ["key"])


@query(
    "chk_foreign_key",
    _BROKEN_SQL + """ SELECT o_orderkey, cust FROM broken
    WHERE cust IS NOT NULL AND cust NOT IN (SELECT c_custkey FROM customer)""",
)
def chk_foreign_key(spark, sf):
    broken = C.foreign_key(_broken(spark, sf), "cust", table(spark, sf, "customer"), "c_custkey")
    return broken.select("o_orderkey", "cust")


@query(
    "chk_items",
    """SELECT 'items' AS rule, CAST(doc_id AS VARCHAR) AS key
       FROM (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents)
       WHERE len(t) < 2 OR len(t) > 200 OR len(list_distinct(t)) < len(t)""",
)
def chk_items(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    rule = C.items("items", F.col("lines"), 2, 200, unique=True)
    return C.violations(lines, "doc_id", [rule])


@query(
    "chk_properties",
    "WITH " + X.MIXED_ROWS_SQL + """
    SELECT 'properties' AS rule, CAST(seq AS VARCHAR) AS key FROM mixed_rows
    WHERE 4 + CAST(has_kind AS INT) < 5 OR origin <> 'order'""",
)
def chk_properties(spark, sf):
    rule = C.properties(
        "properties", F.col("raw"), 5, 8, ["kind", "id", "cust", "status", "info"]
    )
    return C.violations(X.with_broken(X.mixed_docs(spark, sf)), "seq", [rule])


@query(
    "chk_dims",
    """SELECT 'dims' AS rule, CAST(vec_id AS VARCHAR) AS key FROM embeddings WHERE
       CASE WHEN vec_id % 25 = 0 THEN len(embedding) - 1 ELSE len(embedding) END <> 64""",
)
def chk_dims(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumn(
        "embedding", F.expr("CASE WHEN vec_id % 25 = 0 THEN slice(embedding, 1, 63) ELSE embedding END")
    )
    return C.violations(vectors, "vec_id", [C.dims("dims", F.col("embedding"), 64)])


_REPORT_PARTS = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) FILTER ({checked}) AS checked,"
    f" count(*) FILTER (({checked}) AND ({broken})) AS violations FROM broken"
    for rule, (checked, broken) in _ORDER_RULES_SQL.items()
)


@query(
    "constraint_report",
    _BROKEN_SQL + _REPORT_PARTS.join([" ", """
    UNION ALL SELECT 'primary_key', count(*),
      count(*) FILTER (pk IS NULL OR pk IN (SELECT pk FROM broken GROUP BY pk HAVING count(*) > 1))
      FROM broken
    UNION ALL SELECT 'foreign_key', count(cust),
      count(*) FILTER (cust IS NOT NULL AND cust NOT IN (SELECT c_custkey FROM customer)) FROM broken"""]),
)
def constraint_report(spark, sf):
    orders = _broken(spark, sf)
    return C.constraint_report([
        C.row_report(orders, list(_order_rules().values())),
        C.primary_key_report("primary_key", orders, "pk"),
        C.foreign_key_report(
            "foreign_key", orders, "cust", table(spark, sf, "customer"), "c_custkey"
        ),
    ])
