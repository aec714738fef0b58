"""What keeps large inputs within their limits: expressions computed once, checks that are compiled, rows dealt out before they grow."""

from pyspark.sql import functions as F

from adloom.functions import normalize as N
from adloom.operators import merge as M
from adloom.operators.schema import Schema


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bodies_are_dealt_out_before_they_grow_into_leaves(spark, monkeypatch):
    seen, write = [], M.checkpointed
    monkeypatch.setattr(M, "checkpointed", lambda df: seen.append(optimized(df)) or write(df))
    rows = [(1, 0, '{"a":{"x":1},"b":2}'), (1, 1, '{"a":5}'), (1, 1, '{"a":5}'), (None, 0, '{"c":{}}'), (2, 0, None)]
    df = spark.createDataFrame(rows, "page_id int, rank int, body string").withColumn("body", F.try_parse_json("body"))
    out = M.json_deep_merge(df, ["page_id"], "rank", "body")
    assert "Repartition" in seen[0].split("explode", 1)[1]
    # joins keep their parts, however few bytes the paths have
    assert "RepartitionByExpression" in optimized(out)
    assert sorted((str(r.page_id), ".".join(r.path), r.value) for r in out.collect()) == [("1", "a", "5"), ("1", "b", "2"), ("None", "c", "{}")]


def test_facts_in_amenity_keys_derive_the_keys_once(spark):
    rows = [(["bedrooms_2", "area450_sqft", "available_from1_june_2026", "ad_typeproperty_wanted"],), (["bedrooms_2", "bedroom_3", "x"],), ([],), (None,)]
    df = spark.createDataFrame(rows, "k array<string>")
    got = df.select(N.legacy_amenity_keys(F.transform("k", F.lower)).alias("f")).select("f.*")
    assert optimized(got).count("lower(lambda") == 1
    assert [(r.intent, r.square_feet, r.beds, str(r.available_from)) for r in got.collect()] == [("find", 450.0, 2, "2026-06-01"), (None, None, 3, "None"), (None, None, None, "None"), (None, None, None, "None")]


def test_an_option_is_looked_up_without_a_scan_of_all(spark):
    df = spark.createDataFrame([(" no PETS ",), ("Dogs",), ("Any Pet is Ok, really",), (" ",), (None,), ("cow",)], "x string")
    got = df.select(N.match_option(F.col("x"), ["Any Pet is Ok", "no pets", "No Pets", "Only Dogs"]).alias("o"))
    assert [r.o for r in got.collect()] == ["no pets", "Only Dogs", "Any Pet is Ok", None, None, None]
    assert "filter(" not in optimized(got)


def test_checks_of_a_schema_are_compiled(spark):
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "string", "enum": ["x", "y"]}, "n": {"type": "integer", "const": 1}}}
    df = spark.createDataFrame([(("x", 1),), (("z", 2),), ((None, None),), (None,)], "doc struct<a:string,n:int>")
    out = df.select(Schema(schema).violations(F.col("doc"), df.schema["doc"].dataType).alias("v"))
    assert [[tuple(v) for v in r.v] for r in out.collect()] == [[], [("a", "enum"), ("n", "const")], [("a", "required")], []]
    assert "filter(" not in optimized(out)
