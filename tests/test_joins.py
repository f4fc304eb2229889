"""Joins with frequent keys."""

from textloom.operators import joins


def test_looked_up_is_a_left_join(spark):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(["a"] * 50 + ["b", "c", "c", None, None, "z"])], "k string, i int")
    table = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, "x"), ("c", 3.0, "y"), ("d", 4.0, "w"), (None, 5.0, "never")], "k string, x double, y string")
    want = sorted(map(repr, rows.join(table, "k", "left").collect()))
    for most in (1, 2, 100):
        got = joins.looked_up(rows, table, ["k"], most=most)
        assert got.columns == ["k", "i", "x", "y"] and sorted(map(repr, got.collect())) == want
    counts = rows.groupBy("k").count().withColumnRenamed("count", "n")
    assert sorted(map(repr, joins.looked_up(rows, table, ["k"], counts, 1).collect())) == want
    assert joins.looked_up(rows.where("false"), table, ["k"]).count() == 0 and joins.looked_up(rows, table.where("false"), ["k"]).count() == 56
