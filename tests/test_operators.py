"""DataFrame operators: semantics and the physical plans they produce."""

import re

import pytest
from pyspark.sql import functions as F

from kinloom.functions import codes as C
from kinloom.operators import quality as Q
from kinloom.operators.link import code_join, full_merge
from kinloom.operators.reshape import pivot_arrays, pivot_slots, union_all, unpivot_positions
from kinloom.operators.select import asof_latest, first_value_by, keep_first


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_nulls_last_and_map_side_limit(spark):
    df = spark.createDataFrame(
        [("p", None, "a"), ("p", 2, "b"), ("p", 1, "c"), ("q", None, "d")], "k string, o int, v string")
    out = keep_first(df, ["k"], ["o", "v"])
    assert sorted((r.k, r.v) for r in out.collect()) == [("p", "c"), ("q", "d")]
    # row_number() == 1 is planned as a per-group limit that also runs before the shuffle
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("WindowGroupLimit") >= 2, p


def test_first_value_by_skips_non_matching(spark):
    df = spark.createDataFrame([("p", 3, "1"), ("p", 1, "9"), ("p", 2, "2"), ("q", 1, "9")],
                               "k string, o int, s string")
    out = df.groupBy("k").agg(first_value_by(F.col("s"), [F.col("o")], where=F.col("s").isin("1", "2")).alias("s"))
    assert sorted(tuple(r) for r in out.collect()) == [("p", "2"), ("q", None)]


def test_code_join_is_or_join_without_nested_loop(spark):
    codes = C.cancer_codes(spark)
    dx = spark.createDataFrame([("C751", "C75"), ("C910", "C91"), ("J459", "J45"), (None, None)],
                               "diagnosis string, diagnosis_3char string")
    out = code_join(dx, codes, stems=C.stems(C.cancer_code_rows()))
    assert sorted((r.diagnosis, r.cancer_group) for r in out.collect()) == [
        ("C751", "Brain / CNS"), ("C910", "Leukaemia")]
    p = plan(out)
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_unpivot_positions(spark):
    df = spark.createDataFrame([("e1", "A", None, "C")], "id string, x1 string, x2 string, x3 string")
    out = unpivot_positions(df, ["id"], ["x1", "x2", "x3"], "pos", "code")
    assert sorted((r.pos, r.code) for r in out.collect()) == [(1, "A"), (2, None), (3, "C")]
    assert "Expand" in plan(out)


def test_pivot_slots_fixed_schema(spark):
    df = spark.createDataFrame([("p", 1, "a"), ("p", 3, "c")], "k string, n int, g string")
    out = pivot_slots(df, ["k"], "n", [1, 2, 3, 4], {"group": "g"}, name=lambda s, n: f"{s}_{n}")
    assert out.columns == ["k", "group_1", "group_2", "group_3", "group_4"]
    assert tuple(out.first()) == ("p", "a", None, "c", None)


def test_full_merge_coalesces_keys(spark):
    a = spark.createDataFrame([("x", 1)], "k string, a int")
    b = spark.createDataFrame([("y", 2)], "k string, b int")
    assert sorted(tuple(r) for r in full_merge(a, b, ["k"]).collect()) == [("x", 1, None), ("y", None, 2)]


def test_pivot_slots_stops_or_keeps_whole_rows(spark):

    rows = [("p", 1, "N", "ASD", None, 5), ("p", 1, "E", None, "VI", 1), ("p", 2, "A", None, None, 2)]
    df = spark.createDataFrame(rows, "k string, n int, a string, b string, c string, d int")
    wide = dict(values={v: v for v in "abcd"}, name=lambda s, n: f"{s}_{n}")
    with pytest.raises(ValueError):
        pivot_slots(df, ["k"], "n", [1, 2], **wide)
    with pytest.raises(ValueError):  # a slot outside the list
        pivot_slots(df.filter("d <> 1"), ["k"], "n", [1], **wide)
    out = pivot_slots(df, ["k"], "n", [1, 2], on_duplicate="first", **wide).first()
    assert tuple(out) == ("p", "E", None, "VI", 1, "A", None, None, 2)


def test_asof_gives_a_row_for_each_left_row(spark):
    left = spark.createDataFrame([("p", 10), ("p", 8), ("p", 5), ("p", None), (None, 9), ("q", 9)], "k string, bound int")
    right = spark.createDataFrame([("p", 8, "b"), ("p", 8, "a"), ("p", 10, "b"), ("p", 11, "c"), (None, 1, "z"), ("p", None, "y")],
                                  "k string, t int, v string")
    other = spark.createDataFrame([("p", 3, 1.5), ("q", 10, 2.5)], "k string, u int, w double")
    out = asof_latest(left, [(right, F.col("t")), (other, F.col("u") + 3)], ["k"], "bound", tie_break=[lambda c: F.col(c).asc()])
    got = {(r.k, r.bound): (r._r0 and r._r0.v, r._r1 and r._r1.w) for r in out.collect()}
    assert got == {("p", 10): ("b", 1.5), ("p", 8): ("a", 1.5), ("p", 5): (None, None), ("q", 9): (None, None)}
    text = plan(out)
    assert "Join" not in text


def test_asof_cuts_a_hot_key_before_the_shuffle(spark):
    """A key with a million records of a few times brings one row a time to its task."""
    left = spark.createDataFrame([("hot", 5)], "k string, bound int")
    right = spark.range(0, 20000, 1, 4).selectExpr("'hot' AS k", "cast(id % 7 AS int) AS t", "id AS v")
    out = asof_latest(left, [(right, F.col("t"))], ["k"], "bound", tie_break=[lambda c: F.col(c).asc()])
    assert [tuple(r._r0) for r in out.collect()] == [(5, 5)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("WindowGroupLimit") >= 2  # once before the rows are shuffled


def test_pivot_arrays_like_pivot_slots(spark):

    rows = [("p", 1, "N", "ASD", None, 5), ("p", 1, "E", None, "VI", 1), ("p", 2, "A", None, None, 2), ("q", 2, None, None, None, None),
            (None, 1, "N", None, None, 7)]
    df = spark.createDataFrame(rows, "k string, n int, a string, b string, c string, d int")
    args = dict(slot_col="n", slots=[1, 2, 3], name=lambda s, n: f"{s}_Y-{n}")
    want = pivot_slots(df, ["k"], values={v: v for v in "abcd"}, on_duplicate="first", **args)
    got = pivot_arrays(df, ["k"], values=list("abcd"), on_duplicate="first", **args)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    with pytest.raises(ValueError):
        pivot_arrays(df, ["k"], values=list("abcd"), **args)
    wide = pivot_arrays(df, ["k"], values=list("abcd"), on_duplicate="unique", **args)
    assert "ObjectHashAggregate" in plan(wide) and "SortAggregate" not in plan(wide)


def test_union_of_many_parts(spark):
    parts = [spark.range(1).selectExpr(f"{i} AS a", *(["1 AS b"] if i % 2 else [])) for i in range(7)]
    assert sorted((r.a, r.b) for r in union_all(parts).collect()) == [(i, 1 if i % 2 else None) for i in range(7)]
    assert union_all(parts[:1]).count() == 1


def test_assert_unique_stops(spark):

    Q.assert_unique(spark.createDataFrame([("a",), ("b",)], "k string"), ["k"])
    with pytest.raises(AssertionError):
        Q.assert_unique(spark.createDataFrame([("a",), ("a",)], "k string"), ["k"])


def test_quality_helpers(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [tuple(r) for r in Q.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    prof = Q.profile(df.withColumn("z", F.lit(1))).orderBy("col_position").collect()
    assert [(r.col_names, r.observations) for r in prof] == [("k", 3), ("z", None)]
    p = plan(Q.profile(df))
    assert "Cartesian" not in p and "NestedLoop" not in p


def test_code_lists():
    cancer = C.cancer_code_rows()
    assert len(cancer) == 101 + 16
    groups = {c3 or c4: g for c3, c4, g in cancer}
    assert groups["C70"] == "Brain / CNS" and groups["C751"] == "Brain / CNS" and groups["C750"] == "Other"
    cong = {(c3 or c4): g for c3, c4, g in C.congenital_code_rows()}
    assert "Q53" not in cong and "Q95" not in cong            # excluded stems
    assert "Q18" not in cong and "Q180" not in cong and cong["Q183"] == "other"  # expanded, child excluded
    assert cong["Q250"] == "ga_mte_37wks_only" and cong["Q850"] == "neurofibromatosis"
    assert cong["Q90"] == "down_syndrome" and cong["D215"] == "other"


def test_rank_skew_safe_matches_row_number_on_hot_group(spark):
    from kinloom.operators.select import rank_skew_safe, rank_within

    rows = [("hot", i % 37, i % 5, f"e{i:04d}") for i in range(600)] + [("cold", i, 0, f"c{i}") for i in range(5)]
    rows += [("hot", None, i % 2 or None, f"n{i}") for i in range(20)] + [(None, 1, None, "x"), (None, None, 2, "y")]
    df = spark.createDataFrame(rows, "k string, o int, p int, id string")
    for order in (["o", "id"], ["o", "p", "id"], ["o", "p", "p", "id"]):
        got = rank_skew_safe(df, ["k"], order, "r")
        want = df.withColumn("r", rank_within(["k"], order))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    with pytest.raises(ValueError):
        rank_skew_safe(df, ["k"], ["id"], "r")


def test_rank_skew_safe_spreads_a_hot_group(spark):
    """The rows of one person are shuffled by (person, first, second value) and nothing is stored."""
    from kinloom.operators.select import rank_skew_safe

    df = spark.range(20000).selectExpr("concat('h', id DIV 100000) AS k", "cast(id % 50 AS int) AS o", "cast(id % 20 AS int) AS p", "id")
    out = rank_skew_safe(df, ["k"], ["o", "p", "id"], "r")
    sizes = [r[0] for r in out.repartition(8, "k", "o", "p").groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 20000 / 3
    text = plan(out)
    assert re.search(r"row_number\(\) windowspecdefinition\(k#\d+, o#\d+, p#\d+, id#", text) and "ExistingRDD" not in text
    assert out.agg(F.count_distinct("r"), F.max("r")).first()[:] == (20000, 20000)
