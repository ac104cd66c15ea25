"""Merged templates against a sequential merge of random documents."""

import json
import random

from tests.test_rules import docs_of

from pyspark.sql import functions as F

from docloom.operators import schema as S


def merge(target, source):
    """Merge one value over another; an object over an array, left open elsewhere, replaces it."""
    if isinstance(source, dict):
        result = dict(target) if isinstance(target, dict) else {}
        for key, value in source.items():
            result[key] = merge(result.get(key), value)
        return result
    if isinstance(source, list):
        result = list(target) if isinstance(target, list) else []
        for i, value in enumerate(source):
            if i < len(result):
                result[i] = merge(result[i], value)
            else:
                result.append(merge(None, value))
        return result
    return source


def leaves(value, path):
    if isinstance(value, dict) and value:
        for key, member in value.items():
            yield from leaves(member, f"{path}.{key}")
    elif isinstance(value, list) and value:
        for i, item in enumerate(value):
            yield from leaves(item, f"{path}[{i}]")
    else:
        yield path, json.dumps(value, separators=(",", ":"))


def random_value(rng, depth):
    kind = rng.choice(["scalar", "null", "object", "array"] if depth else ["scalar", "null"])
    if kind == "object":
        return {k: random_value(rng, depth - 1) for k in "abc" if rng.random() < 0.6}
    if kind == "array":
        return [random_value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return None if kind == "null" else rng.randint(0, 9)


def test_template_equals_sequential_merge(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for case in range(60):
        docs = [
            {k: random_value(rng, 3) for k in "xyz" if rng.random() < 0.8}
            for _ in range(rng.randint(1, 6))
        ]
        merged = {}
        for doc in docs:
            merged = merge(merged, doc)
        kind = f"k{case}"
        expected[kind] = dict(leaves(merged, "_source"))
        rows += [("c", str(i), i, json.dumps(d), kind) for i, d in enumerate(docs)]
    frames = spark.createDataFrame(rows, "_index string, _id string, seq long, raw string, kind string")
    for partitions in (1, 8):
        found: dict = {}
        for r in S.merged_template(frames.repartition(partitions)).collect():
            if r["path"] not in ("_index", "_id"):
                found.setdefault(r["kind"], {})[r["path"]] = r["value"]
        assert found == expected


def test_odd_keys_and_depth(spark):
    deep = "1"
    for _ in range(12):
        deep = f'{{"d": {deep}}}'
    docs = docs_of(spark, [f'{{"a.b": [{{"x[0]": 1}}], "deep": {deep}}}']).withColumn("kind", F.lit("k"))
    paths = {r["path"] for r in S.merged_template(docs).collect()}
    assert "_source.deep" + ".d" * 12 in paths
    assert '_source["a.b"][0]["x\\u005b0\\u005d"]' in paths
