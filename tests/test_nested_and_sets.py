import pytest
from pyspark.sql import functions as F

from medallion.operators.nested import flatten, safe_name, sanitize_names
from medallion.operators.setops import except_distinct, union_all


def test_posexplode_keeps_empty_and_null(spark):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "id int, a array<string>")
    out = flatten(df)
    assert out.columns == ["id", "a_pos", "a"]
    assert {tuple(r) for r in out.collect()} == {(1, 0, "x"), (1, 1, "y"), (2, None, None), (3, None, None)}


def test_sibling_arrays_multiply(spark):
    df = spark.createDataFrame([([1, 2], ["a", "b", "c"])], "x array<int>, y array<string>")
    assert flatten(df).count() == 6


def test_structs_go_to_the_end(spark):
    df = spark.sql("select named_struct('b', 1, 'c', named_struct('d', 2)) as s, 3 as id")
    out = flatten(df)
    assert out.columns == ["id", "s_b", "s_c_d"]
    assert out.collect() == [(3, 1, 2)]


def test_array_of_structs_of_arrays(spark):
    df = spark.sql("select 1 as id, array(named_struct('k', 'a', 'v', array(1, 2)), named_struct('k', 'b', 'v', array(3))) as xs")
    out = flatten(df)
    assert sorted(out.columns) == ["id", "xs_k", "xs_pos", "xs_v", "xs_v_pos"]
    got = {tuple(r) for r in out.select("xs_pos", "xs_k", "xs_v_pos", "xs_v").collect()}
    assert got == {(0, "a", 0, 1), (0, "a", 1, 2), (1, "b", 0, 3)}


def test_maps_are_left_alone(spark):
    df = spark.sql("select map('a', 1) as m")
    assert flatten(df).collect() == [({"a": 1},)]


def test_names(spark):
    assert [safe_name(n) for n in ("a.b", "x@y", "p/q:r", "m|n?(o)!")] == ["a_b", "x_y", "p_q_r", "m_n__o__"]
    df = spark.range(1).select(F.lit(1).alias("a.b"), F.lit(2).alias("x@y"))
    assert sanitize_names(df).columns == ["a_b", "x_y"]


def test_colliding_names_are_an_error(spark):
    with pytest.raises(ValueError, match="a_b"):
        sanitize_names(spark.range(1).select(F.lit(1).alias("a.b"), F.lit(2).alias("a_b")))
    with pytest.raises(ValueError, match="s_b"):
        flatten(spark.sql("select named_struct('b', 1) as s, 2 as s_b"))


def test_flatten_has_no_shuffle(spark):
    df = spark.sql("select 1 as id, array(named_struct('k', 'a')) as xs")
    assert "Exchange" not in flatten(df)._jdf.queryExecution().executedPlan().toString()


def test_except_is_distinct_and_null_safe(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, None), (3, None)], "a int, b string")
    right = spark.createDataFrame([(3, None)], "c int, d string")
    out = except_distinct(left, right)
    assert out.columns == ["a", "b"]
    assert sorted(out.collect()) == [(1, None), (2, None)]
    assert sorted(out.collect()) == sorted(left.subtract(right).collect())


def test_except_wants_equal_width(spark):
    with pytest.raises(ValueError):
        except_distinct(spark.range(1), spark.range(1).selectExpr("id", "id as b"))


def test_except_collapses_copies_before_its_only_shuffle(spark):
    left = spark.range(100).selectExpr("id % 3 as a")
    plan = except_distinct(left, left.where("a = 1"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan


def test_union_pads_with_null(spark):
    out = union_all(spark.sql("select 1 as a, 'x' as b"), spark.sql("select 2 as a"))
    assert sorted(out.collect()) == [(1, "x"), (2, None)]
