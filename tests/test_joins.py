import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from compare import plan_text, staged_plans
from siltstone.operators import hierarchy, joins
from siltstone.operators.hierarchy import Hierarchy, hierarchy_rollup
from siltstone.operators.joins import dimension_join, duplicate_keys, parent_lookup, salted_join
from siltstone.sources.stage import scratch_path

KEYS = st.lists(st.sampled_from([None, 1, 1, 1, 1, 2, 3, 4, 5]), max_size=30)


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("hot_rows", [1, 3, 1000])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=KEYS, right=KEYS)
def test_salted_join_equals_plain_join(spark, rows, how, hot_rows, left, right):
    a = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, a int")
    b = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "r int, b int")
    got = salted_join(a, b, "k", "r", how, hot_rows=hot_rows)
    assert rows(got) == rows(a.join(b, a["k"] == b["r"], how))


def test_salted_join_splits_copies_and_one_sided_hot_keys(spark, rows):
    a = spark.createDataFrame([("x", i % 40) for i in range(300)] + [("only left", 1)] * 20 + [("y", 0)], "k string, a int")
    b = spark.createDataFrame([("x", 1), ("x", 2), ("only right", 5), ("y", 7)] + [("z", i) for i in range(50)], "r string, b int")
    for how in ("inner", "left", "full"):
        got = salted_join(a, b, "k", "r", how, hot_rows=10)
        assert rows(got) == rows(a.join(b, a["k"] == b["r"], how))


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_one_scan_a_side_finds_the_hot_keys(spark, rows, how):
    """Besides the join itself, each source is scanned once: for hot keys, their rows and NULLs."""
    left, right = scratch_path(spark, "left"), scratch_path(spark, "right")
    spark.range(0, 3000, 1, 4).selectExpr("CASE WHEN id % 3 = 0 THEN 'x' WHEN id % 3 = 1 THEN concat('k', id) END AS k", "id AS a").write.parquet(left)
    spark.range(0, 40, 1, 2).selectExpr("CASE WHEN id < 20 THEN 'x' WHEN id < 30 THEN concat('k', id * 3 + 1) END AS r", "id AS b").write.parquet(right)
    a, b = spark.read.parquet(left), spark.read.parquet(right)
    with staged_plans() as plans:
        joined = salted_join(a, b, "k", "r", how, hot_rows=100)
    for key, rest in (("k:string", "a:bigint"), ("r:string", "b:bigint")):
        assert "".join(plans).count(f"ReadSchema: struct<{key}>") == 1 and "".join(plans).count(f"struct<{key},") == 0
        assert plan_text(joined).count(f"ReadSchema: struct<{key},{rest}>") == 1
    assert "sketch" in "".join(plans)
    assert rows(joined) == rows(a.join(b, a["k"] == b["r"], how))


def test_a_sketch_that_is_too_small_is_grown(spark, monkeypatch):
    """No key of the given size stays hidden, however many others there are."""
    many = spark.range(0, 60_000, 1, 4).selectExpr("CASE WHEN id % 60 < 2 THEN -(id % 6) ELSE id END AS k")
    found = joins._profile(many, "k", 300, tracked=32)
    counts = {r.k: r["count"] for r in many.groupBy("k").count().where("count >= 300").collect()}
    assert counts and {r.k: r.n for r in found.keys.collect()} == counts
    assert found.nulls == 0 and found.n_keys == len(counts)


@pytest.mark.parametrize("kind", ["binary", "decimal(12,2)", "date", "boolean", "timestamp", "double", "struct<x:int>"])
def test_hot_keys_of_any_type(spark, kind):
    value = {"date": "date_add(DATE '2024-01-01', cast(id % 2 as int))", "boolean": "id % 2 = 0", "timestamp": "timestamp_seconds(id % 2)", "struct<x:int>": "struct(cast(id % 2 as int) AS x)", "binary": "cast(concat('b', id % 2) as binary)"}.get(kind, f"cast(id % 2 as {kind})")
    df = spark.range(0, 101, 1, 3).selectExpr(f"CASE WHEN id < 100 THEN {value} END AS k", "id AS a")
    other = df.selectExpr("k AS r", "a AS b")
    assert joins._profile(df, "k", 50).n_keys == 2 and joins._profile(df, "k", 51).n_keys == 0
    joined = salted_join(df, other.where("b < 2 OR b = 100"), "k", "r", "full", hot_rows=20)
    assert joined.count() == 102 and joined.where("a IS NOT NULL AND b IS NOT NULL").count() == 100


def test_copies_of_one_row_are_spread(spark):
    """Equal rows of a hot key do not all land in one partition."""
    copies = spark.range(0, 4000, 1, 8).select(F.lit("x").alias("k"), F.lit(1).alias("a"))
    one = spark.createDataFrame([("x", 7)], "r string, b int")
    joined = salted_join(copies, one, "k", "r", "full", hot_rows=100)
    assert joined.count() == 4000
    plan = joined.select("a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "spark_partition_id" in plan.lower()


def test_salted_join_rejects_other_types(spark):
    df = spark.range(1).toDF("k")
    with pytest.raises(ValueError):
        salted_join(df, df, "k", "k", "left_anti")


@pytest.mark.parametrize("max_rows", [1, 100])
def test_dimension_join_is_the_same_on_both_paths(spark, rows, max_rows):
    facts, dim = spark.createDataFrame([(1, 5), (2, 9), (3, None)], "a int, k int"), spark.createDataFrame([(5, "x"), (6, "y")], "k int, v string")
    joined = dimension_join(facts, dim, "k", max_rows)
    assert rows(joined.select("a", "v")) == [(1, "x"), (2, None), (3, None)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) == (max_rows == 100)


def test_parent_lookup_keeps_rows_without_parent(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("b", "a", 2), ("c", "gone", 3)], "id string, mgr string, p int")
    assert rows(parent_lookup(df, "mgr", "id", {"p": "mgr_p"}).select("id", "mgr_p")) == [("a", None), ("b", 1), ("c", None)]


TREE = Hierarchy("code", "sup", "level", "name", "LOC")


def test_rollup_covers_every_position_of_the_owner(spark, rows):
    nodes = spark.createDataFrame([
        ("L1", "root", "LOC", "Site 1", None), ("G1", "L1", "GRP", "Group 1", None), ("G2", "G1", "GRP", "Group 2", None),
        ("D", "L1", "GRP", "Dup", None), ("D", "L1", "GRP", "Dup", None), ("D", "L1", "GRP", "Other name", None),
        ("s1", "L1", "GEN", "set", 1.0), ("s2", "G1", "GEN", "set", 2.0), ("s3", "G2", "GEN", "set", 3.0),
        ("s4", "gone", "GEN", "set", 4.0), ("s5", None, "GEN", "set", 5.0), ("s6", "D", "GEN", "set", 6.0), ("s7", "D", "GEN", "set", None),
    ], "code string, sup string, level string, name string, kw double")
    children = nodes.where("level = 'GEN'")
    got = hierarchy_rollup(children, nodes, TREE, ["code"], "kw", "code", "kw", "n")
    nodes.createOrReplaceTempView("rollup_nodes")
    want = spark.sql("""
        SELECT e.code, p.code, p.level, p.name, o.code, o.name, sum(e.kw), count(e.code) FROM rollup_nodes e
        LEFT JOIN rollup_nodes p ON e.sup = p.code LEFT JOIN rollup_nodes o ON p.sup = o.code AND o.level = 'LOC'
        WHERE e.level = 'GEN' GROUP BY e.code, p.code, p.level, p.name, o.code, o.name
    """)
    assert rows(got.select("code", "parent_code", "parent_level", "parent_name", "owner_code", "owner_name", "kw", "n")) == rows(want)
    assert rows(duplicate_keys(nodes, "code")) == [("D", 3)]


def test_rollup_does_not_build_the_rows_of_a_repeated_code(spark):
    nodes = spark.createDataFrame([("P", "L", "GRP", "p", None)] * 500 + [(f"c{i}", "P", "GEN", "c", 1.0) for i in range(500)], "code string, sup string, level string, name string, kw double")
    total = hierarchy_rollup(nodes.where("level = 'GEN'"), nodes, TREE, ["sup"], "kw", "code", "kw", "n").collect()
    assert [(r.kw, r.n) for r in total] == [(250_000.0, 250_000)]


def test_rollup_deals_its_groups_by_their_number(spark, rows, monkeypatch):
    """Ten times the children are dealt to ten times the tasks; one large group is combined first."""
    def rolled(n, group_by):
        nodes = spark.range(n).selectExpr("concat('c', id) AS code", "concat('c', id div 10) AS sup", "'GRP' AS level", "'x' AS name", "1D AS kw")
        return hierarchy_rollup(nodes, nodes, TREE, group_by, "kw", "code", "kw", "n")

    want = rows(rolled(1000, ["code"]).select("code", "parent_code", "kw", "n"))
    monkeypatch.setattr(hierarchy, "ROWS_PER_TASK", 20)
    assert [rolled(n, ["code"]).rdd.getNumPartitions() for n in (100, 1000)] == [6, 51]
    assert rows(rolled(1000, ["code"]).select("code", "parent_code", "kw", "n")) == want and len(want) == 1000
    whole = rolled(1000, ["level"])
    assert "REPARTITION_BY_NUM" not in plan_text(whole) and whole.agg(F.sum("n")).first()[0] == 1000


def test_every_hot_key_is_split(spark, rows):
    """Two hundred keys, all over the limit of a task: no partition gets a whole one."""
    many = spark.range(0, 200 * 60, 1, 8).select((F.col("id") % 200).alias("k"), F.col("id").alias("a"))
    other = spark.range(200).select(F.col("id").alias("r"), (F.col("id") * 2).alias("b"))
    joined = salted_join(many, other, "k", "r", "full", hot_rows=10)
    assert rows(joined) == rows(many.join(other, many["k"] == other["r"], "full"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = salted_join(many, other, "k", "r", "full", hot_rows=10)
        where = split.select("k", F.spark_partition_id().alias("part")).groupBy("k").agg(F.countDistinct("part").alias("places"))
        assert where.count() == 200 and where.where("places < 2").count() == 0
    finally:
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_null_keys_are_spread_by_their_number(spark):
    nulls = spark.range(0, 1000, 1, 8).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("a"))
    none = spark.createDataFrame([], "r int, b int")
    split = salted_join(nulls, none, "k", "r", "full", hot_rows=100)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert split.count() == 1000 and "__i" in plan
    assert "__i" not in salted_join(nulls, none, "k", "r", "full", hot_rows=1000)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_salted_join_with_maps_and_dotted_names(spark, hot_rows):
    a = spark.createDataFrame([(1, {"x": 1}, [{"y": 2}]), (1, None, None), (1, {}, []), (None, {"z": 3}, None)], "k int, m map<string,int>, l array<map<string,int>>").withColumnRenamed("m", "a.m")
    b = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "r int, v int").withColumnRenamed("v", "b.v")
    for how, n in (("inner", 3), ("left", 4), ("full", 6)):
        joined = salted_join(a, b, "k", "r", how, hot_rows=hot_rows)
        assert joined.columns == ["k", "a.m", "l", "r", "b.v"] and joined.count() == n


def test_wide_dimensions_are_not_broadcast(spark):
    facts, dim = spark.createDataFrame([(1, 5)], "a int, k int"), spark.createDataFrame([(5, "x" * 2000)], "k int, v string")
    for most, sent in ((100, False), (10_000, True)):
        plan = dimension_join(facts, dim, "k", max_bytes=most)._jdf.queryExecution().optimizedPlan().toString()
        assert ("broadcast" in plan) == sent
