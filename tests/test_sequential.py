import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stationflow.operators.sequential import adjacent, with_next_minute


def _frame(spark, n=600, keys=5, seed=7):
    rnd = random.Random(seed)
    data = [(rnd.randrange(keys), i, rnd.choice([None, rnd.randrange(50)])) for i in range(n)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "k int, t int, v int")


def test_adjacent_equals_window_lag_and_lead(spark):
    df = _frame(spark)
    w = Window.partitionBy("k").orderBy("t")
    for direction, fn in (("prev", F.lag), ("next", F.lead)):
        got = adjacent(df, ["k"], ["t"], F.floor(F.col("t") / 37), ["v", "t"], direction, "nb")
        got = got.select("k", "t", F.col("nb.v").alias("v2"), F.col("nb.t").alias("t2"))
        exp = df.select("k", "t", fn("v").over(w).alias("v2"), fn("t").over(w).alias("t2"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_adjacent_without_keys(spark):
    df = _frame(spark, n=200).select("t", "v")
    got = adjacent(df, [], ["t"], F.floor(F.col("t") / 10), ["t"], "next", "nb")
    r = {a: b for a, b in got.select("t", "nb.t").collect()}
    assert r[0] == 1 and r[9] == 10 and r[199] is None


def test_adjacent_keeps_null_values_distinct_from_missing_row(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5)], "k int, t int, v int")
    got = adjacent(df, ["k"], ["t"], F.col("t"), ["v"], "prev", "p").orderBy("t").collect()
    assert got[0]["p"] is None            # first row: no previous row at all
    assert got[1]["p"] is not None and got[1]["p"]["v"] is None  # previous row, null value


def test_adjacent_with_a_hot_key_holding_a_third_of_rows(spark):
    rnd = random.Random(11)
    data = [(0 if i % 3 == 0 else rnd.randrange(1, 50), i, rnd.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, t int, v int")
    w = Window.partitionBy("k").orderBy("t")
    got = adjacent(df, ["k"], ["t"], F.floor(F.col("t") / 25), ["v"], "prev", "p")
    got = got.select("k", "t", F.col("p.v").alias("pv"))
    exp = df.select("k", "t", F.lag("v").over(w).alias("pv"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_next_minute_equals_window_lead(spark):
    rnd = random.Random(3)
    minutes = sorted(rnd.sample(range(0, 6 * 1440), 900))
    df = spark.createDataFrame([(rnd.randrange(3), m, m % 7) for m in minutes], "k int, m int, v int").select(
        "k", F.timestamp_micros(F.col("m").cast("bigint") * 60_000_000).alias("minute"), "v")
    for keys in (["k"], []):
        w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("minute")
        exp = df.select(*keys, "minute", "v", F.lead("minute").over(w), F.min("minute").over(w))
        got = with_next_minute(df, keys, ["v"], first="f")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, exp.collect()), key=str)
