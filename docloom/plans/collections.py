"""Registered queries: scans, counts, sampling, profile, kinds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators import profile as P
from docloom.plans.registry import query
from docloom.sources import documents as D
from docloom.sources import fixtures as X

SAMPLE = {"percent": 12.5, "max_value": 1200}

_CATALOG = "WITH " + X.CATALOG_SQL


@query(
    "scan_limit",
    "SELECT 'events' AS _index, CAST(event_id AS VARCHAR) AS _id, event_id AS seq, event_type AS type"
    " FROM events ORDER BY event_id LIMIT 500",
)
def scan_limit(spark, sf):
    docs = D.scan_limit(X.collections(spark, sf), "events", 500)
    return docs.select("_index", "_id", "seq", F.get_json_object("raw", "$.type").alias("type"))


@query("count_docs", _CATALOG + " SELECT _index, count(*) AS documents FROM catalog GROUP BY 1")
def count_docs(spark, sf):
    return D.count_docs(X.catalog_docs(spark, sf))


@query(
    "sample_size",
    _CATALOG + """
    SELECT _index, count(*) AS documents, CAST(2000000 AS BIGINT) AS absolute_size,
           CAST(least(ceil(count(*) * 12.5 / 100), 1200) AS BIGINT) AS relative_size
    FROM catalog GROUP BY 1""",
)
def sample_size(spark, sf):
    counts = D.count_docs(X.catalog_docs(spark, sf))
    absolute = D.sample_size(counts, absolute=2_000_000).withColumnRenamed("size", "absolute_size")
    return D.sample_size(absolute, **SAMPLE).withColumnRenamed("size", "relative_size")


@query(
    "sampled_read",
    _CATALOG + """
    SELECT _index, CAST(seq AS VARCHAR) AS _id, seq FROM (
      SELECT *, row_number() OVER (PARTITION BY _index ORDER BY seq) AS rn,
             count(*) OVER (PARTITION BY _index) AS n FROM catalog)
    WHERE rn <= least(ceil(n * 12.5 / 100), 1200)""",
)
def sampled_read(spark, sf):
    return D.sampled_read(X.catalog_docs(spark, sf), **SAMPLE).select("_index", "_id", "seq")


@query(
    "catalog_filtered",
    _CATALOG + """
    SELECT _index, count(*) AS documents FROM catalog
    WHERE NOT starts_with(_index, '.') AND NOT regexp_matches(_index, '(?i)^apm-[0-9]+\\.[0-9]+\\.[0-9]+')
    GROUP BY 1""",
)
def catalog_filtered(spark, sf):
    return D.catalog_filtered(X.catalog_docs(spark, sf))


@query(
    "envelope",
    "WITH" + X.EVENT_FIELDS_SQL + """
    SELECT 'events' AS _index, CAST(seq AS VARCHAR) AS _id,
      '{"event_id":' || seq || ',"k":' ||
      max(CASE WHEN key = 'k' AND type = 'string' THEN '"' || val || '"' WHEN key = 'k' THEN val END)
      || ',"type":"' || max(CASE WHEN key = 'type' THEN val END) || '"'
      || coalesce(',"user":' || max(CASE WHEN key = 'user' THEN val END), '') || '}' AS _source
    FROM event_fields GROUP BY seq""",
)
def envelope(spark, sf):
    return D.envelope(X.event_docs(spark, sf)).withColumn("_source", F.to_json("_source"))


@query(
    "field_presence",
    X.FIELDS_SQL + " SELECT _index, key, count(*) AS cnt FROM fields GROUP BY 1, 2",
)
def field_presence(spark, sf):
    return P.field_presence(X.collections(spark, sf))


@query(
    "field_samples",
    X.FIELDS_SQL + """,
    firsts AS (
      SELECT _index, key, type, val, min(seq) AS seq FROM fields
      WHERE type NOT IN ('array', 'object') GROUP BY ALL
      UNION ALL SELECT _index, key, type, val, seq FROM fields WHERE type IN ('array', 'object'))
    SELECT _index, key, CAST(rank AS INT) AS rank, type, val AS sample FROM (
      SELECT *, row_number() OVER (PARTITION BY _index, key ORDER BY seq) AS rank FROM firsts)
    WHERE rank <= 30""",
)
def field_samples(spark, sf):
    return P.field_samples(X.collections(spark, sf))


_PROFILE = X.FIELDS_SQL + """,
    stats AS (
      SELECT _index, key, count(*) AS cnt, min(seq * 100 + pos) AS first,
        CASE WHEN bool_or(type = 'string') THEN 'string' ELSE arg_max(type, seq) END AS type
      FROM fields GROUP BY 1, 2),
    profile AS (
      SELECT s.*, CAST(floor(CAST(cnt AS DOUBLE) / total * 100 + 0.5) AS INT) AS probability,
             row_number() OVER (PARTITION BY _index ORDER BY first) AS place
      FROM stats s JOIN totals t USING (_index)),
    marked AS (SELECT *, probability >= 90 AND type = 'string' AS suggested FROM profile)"""


@query("field_type", _PROFILE + " SELECT _index, key, type FROM stats")
def field_type(spark, sf):
    return P.field_type(X.collections(spark, sf))


@query("field_probability", _PROFILE + " SELECT _index, key, cnt, probability FROM profile")
def field_probability(spark, sf):
    return P.field_probability(X.collections(spark, sf))


@query(
    "kind_candidates",
    _PROFILE + " SELECT _index, key, probability, type, suggested FROM marked",
)
def kind_candidates(spark, sf):
    marked = P.kind_candidates(P.field_profile(X.collections(spark, sf)))
    return marked.select("_index", "key", "probability", "type", "suggested")


@query(
    "kind_exclusions",
    _PROFILE + """
    SELECT _index, key, suggested, suggested AND key NOT IN ('kind', 'type') AS eligible FROM marked""",
)
def kind_exclusions(spark, sf):
    marked = P.kind_candidates(P.field_profile(X.collections(spark, sf)))
    kept = P.kind_exclusions(marked, ("kind", "type"))
    return kept.select("_index", "key", "suggested", "eligible")


@query(
    "kind_field",
    _PROFILE + """
    SELECT _index, key AS kind_field, probability FROM (
      SELECT *, row_number() OVER (PARTITION BY _index
        ORDER BY probability DESC, key = 'type' DESC, place DESC) AS rn
      FROM marked WHERE suggested AND key <> 'id') WHERE rn = 1""",
)
def kind_field(spark, sf):
    return P.kind_field(P.field_profile(X.collections(spark, sf)))


_KINDS = X.FIELDS_SQL + """,
    kinds AS (
      SELECT 'mixed' AS _index, kind, seq FROM mixed_rows
      UNION ALL SELECT 'events', event_type, seq FROM event_rows)"""


def _kinded(spark, sf):
    docs = D.parsed_once(X.collections(spark, sf), "_index", "seq")
    return P.with_kind(docs, P.chosen_kind_fields(docs))


@query(
    "distinct_kinds",
    _KINDS + " SELECT _index, kind, min(seq) AS first_seq FROM kinds WHERE kind <> '' GROUP BY 1, 2",
)
def distinct_kinds(spark, sf):
    return P.distinct_kinds(_kinded(spark, sf))


@query(
    "group_by_kind", _KINDS + " SELECT _index, kind, count(*) AS documents FROM kinds GROUP BY 1, 2"
)
def group_by_kind(spark, sf):
    return P.group_by_kind(_kinded(spark, sf))


@query(
    "field_order",
    _PROFILE + """
    SELECT _index, key, CAST(place AS INT) AS seen_place,
           CAST(row_number() OVER (PARTITION BY _index ORDER BY key) AS INT) AS name_place
    FROM profile""",
)
def field_order(spark, sf):
    seen = P.field_order(P.field_profile(X.collections(spark, sf)))
    seen = seen.withColumnRenamed("place", "seen_place")
    by_name = P.field_order(seen, alphabetical=True)
    return by_name.select("_index", "key", "seen_place", F.col("place").alias("name_place"))


@query(
    "merged_cardinality",
    X.FIELDS_SQL + """
    SELECT _index, key, count(*) AS n, true AS close FROM fields GROUP BY 1, 2""",
)
def merged_cardinality(spark, sf):
    docs = D.parsed_once(X.collections(spark, sf), "_index", "seq")
    # Sketches of three batches, merged, against the distinct values of all.
    parts = [P.cardinality_sketches(docs.where(F.col("seq") % 3 == i)) for i in range(3)]
    merged = P.merged_cardinality(reduce(DataFrame.unionByName, parts), "_index", "key")
    exact = P.fields(docs).groupBy("_index", "key").agg(
        F.count_distinct(F.sha2(F.concat("type", F.to_json("value")), 256)).alias("exact")
    )
    close = F.abs(F.col("estimate") - F.col("exact")) <= 0.03 * F.col("exact")
    return merged.join(exact, ["_index", "key"]).select("_index", "key", F.col("values").alias("n"), close.alias("close"))


@query(
    "collection_profile",
    _PROFILE + """,
    chosen AS (
      SELECT _index, arg_max(key, probability * 1000 + CAST(key = 'type' AS INT) * 500 + place) AS kind_field
      FROM marked WHERE suggested AND key <> 'id' GROUP BY 1),
    kinds AS (
      SELECT 'mixed' AS _index, kind, seq FROM mixed_rows WHERE kind <> ''
      UNION ALL SELECT 'events', event_type, seq FROM event_rows)
    SELECT _index, 'kind_field' AS role, kind_field AS name, CAST(0 AS BIGINT) AS first_seq,
      CAST(0 AS INT) AS first_pos FROM chosen
    UNION ALL SELECT _index, CASE WHEN suggested THEN 'suggested' ELSE 'other' END, key,
      first // 100, CAST(first % 100 AS INT) FROM marked
    UNION ALL SELECT _index, 'kind', kind, min(seq), 0 FROM kinds GROUP BY 1, 3""",
)
def collection_profile(spark, sf):
    return P.collection_profile(X.collections(spark, sf))


# Fields and kinds of the documents that the sample takes.
_SAMPLED = X.FIELDS_SQL.replace(
    "fields AS (SELECT * FROM event_fields UNION ALL SELECT * FROM mixed_fields)",
    """every_field AS (SELECT * FROM event_fields UNION ALL SELECT * FROM mixed_fields),
  places AS (
    SELECT _index, seq, row_number() OVER (PARTITION BY _index ORDER BY seq) AS rn,
           count(*) OVER (PARTITION BY _index) AS n
    FROM (SELECT DISTINCT _index, seq FROM every_field)),
  taken AS (SELECT _index, seq FROM places WHERE rn <= least(ceil(n * 12.5 / 100), 1200)),
  fields AS (SELECT * FROM every_field JOIN taken USING (_index, seq))""",
)
_SAMPLED_PROFILE = _PROFILE.replace(X.FIELDS_SQL, _SAMPLED)


@query(
    "sampled_profile",
    _SAMPLED_PROFILE + """,
    chosen AS (
      SELECT _index, arg_max(key, probability * 1000 + CAST(key = 'type' AS INT) * 500 + place) AS kind_field
      FROM marked WHERE suggested AND key <> 'id' GROUP BY 1),
    kinds AS (
      SELECT 'mixed' AS _index, kind, seq FROM mixed_rows WHERE kind <> ''
      UNION ALL SELECT 'events', event_type, seq FROM event_rows)
    SELECT _index, 'kind_field' AS role, kind_field AS name, CAST(0 AS BIGINT) AS first_seq,
      CAST(0 AS INT) AS first_pos FROM chosen
    UNION ALL SELECT _index, CASE WHEN suggested THEN 'suggested' ELSE 'other' END, key,
      first // 100, CAST(first % 100 AS INT) FROM marked
    UNION ALL SELECT _index, 'kind', kind, min(seq), 0 FROM kinds JOIN taken USING (_index, seq) GROUP BY 1, 3""",
)
def sampled_profile(spark, sf):
    return P.collection_profile(D.sampled_read(X.collections(spark, sf), **SAMPLE))
