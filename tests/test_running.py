from __future__ import annotations

import random
from itertools import accumulate

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import running as running_module
from tidemark.operators.running import CHUNK, running, split_hot_groups


def rows_for(n, seed, spread):
    rng = random.Random(seed)
    keys = ["hot"] * (2 * n // 3) + [f"k{i % 5}" for i in range(n - 2 * n // 3)]
    orders = rng.sample(range(spread), n)
    return [(k, o, rng.randrange(100)) for k, o in zip(keys, orders)]


def expected(rows, inclusive):
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((o, v) for k, o, v in rows if k == key)
        sums = list(accumulate(v for _, v in mine))
        for i, (o, _) in enumerate(mine):
            out[key, o] = sums[i] if inclusive else (sums[i - 1] if i else None)
    return out


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("spread", [400, 10**12])
def test_chunked_scan_equals_plain_scan(spark, inclusive, spread):
    rows = rows_for(300, 7, spread)
    df = spark.createDataFrame(rows, "k string, o long, v long")
    for target in (5, 10_000):
        out = running(df, ["k"], "o", {"s": ("sum", "v")}, inclusive=inclusive, target=target)
        assert {(r.k, r.o): r.s for r in out.collect()} == expected(rows, inclusive)


def test_doubles_and_uneven_values(spark):
    values = [2.0**i for i in range(-40, 40)] + [1.0 + i * 1e-13 for i in range(1, 40)]
    df = spark.createDataFrame([(v, 1) for v in values], "o double, v long")
    out = running(df, [], "o", {"rank": ("sum", "v")}, target=4)
    assert [r.rank for r in out.orderBy("o").collect()] == list(range(1, len(values) + 1))


def test_no_chunk_exceeds_the_target(spark):
    # A third of the rows sits in a narrow stretch of a very wide range.
    wide = [(i * 10**12,) for i in range(200)]
    dense = [(5 * 10**12 + 1 + i,) for i in range(100)]
    df = spark.createDataFrame(wide + dense, "o long")
    chunked, divided = split_hot_groups(df, [], "o", 10)
    assert divided
    assert chunked.groupBy(CHUNK).count().agg(F.max("count")).first()[0] <= 10
    assert chunked.count() == 300


def test_known_sizes_skip_the_division(spark):
    df = spark.createDataFrame([(i, 1) for i in range(20)], "o long, v long")
    sizes = df.select(F.lit(3).alias("n"))
    out = running(df, [], "o", {"s": ("sum", "v")}, target=5, sizes=sizes)
    assert [r.s for r in out.orderBy("o").collect()] == list(range(1, 21))


def test_column_combined_in_two_ways_is_refused(spark):
    df = spark.createDataFrame([(i, 1) for i in range(20)], "o long, v long")
    with pytest.raises(ValueError):
        running(df, [], "o", {"a": ("sum", "v"), "b": ("max", "v")}, target=5)


def test_dividing_changes_no_type_and_no_result(spark):
    df = spark.createDataFrame([(i, 1_000_000_000) for i in range(20)], "o int, v int")
    whole = running(df, [], "o", {"s": ("sum", "v")}, target=100)
    parts = running(df, [], "o", {"s": ("sum", "v")}, target=4)
    assert whole.schema == parts.schema
    assert sorted(whole.collect()) == sorted(parts.collect())
    assert parts.agg(F.max("s")).first()[0] == 20_000_000_000


def test_hot_null_key_is_divided(spark):
    rows = [(None, i, 1) for i in range(40)] + [("a", i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    chunked, divided = split_hot_groups(df, ["k"], "o", 6)
    assert divided and chunked.groupBy("k", CHUNK).count().agg(F.max("count")).first()[0] <= 6
    out = running(df, ["k"], "o", {"s": ("sum", "v")}, target=6)
    assert sorted(r.s for r in out.where("k is null").collect()) == list(range(1, 41))


def test_infinities_are_cells_of_their_own(spark):
    values = [float("-inf"), -1.7e308, *[i / 10 for i in range(20)], 1.7e308, float("inf")]
    df = spark.createDataFrame([(v, 1) for v in values], "o double, v long")
    out = running(df, [], "o", {"rank": ("sum", "v")}, target=3)
    assert [r.rank for r in out.orderBy("o").collect()] == list(range(1, len(values) + 1))


def test_rows_that_cannot_be_divided_stay_together(spark):
    df = spark.createDataFrame([(5.0, 1)] * 9, "o double, v long")
    _, divided = split_hot_groups(df, [], "o", 3)
    assert not divided


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_chunk_totals_are_scanned_in_chunks_themselves(spark, monkeypatch, keys):
    from tidemark.operators import running as module

    levels, divide = [], module.split_hot_groups
    monkeypatch.setattr(module, "LEAST_TOTALS", 0)
    monkeypatch.setattr(module, "split_hot_groups", lambda df, *a: (levels.append(df.count()), divide(df, *a))[1])
    rng = random.Random(4)
    rows = [(i % 11 == 0, i * i, rng.randrange(1_000)) for i in range(300)]
    df = spark.createDataFrame(rows, "k boolean, at long, v long")
    w = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["at"]: (r.s, r.m) for r in df.select("at", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m")).collect()}
    plain = df.withColumn("v2", F.col("v"))
    out = running(plain, keys, "at", {"s": ("sum", "v"), "m": ("max", "v2")}, target=8)
    assert {r["at"]: (r.s, r.m) for r in out.collect()} == want
    assert len(levels) >= 3 and levels == sorted(levels, reverse=True)


def test_wide_rows_make_smaller_chunks(spark):
    narrow = spark.range(1)
    wide = narrow.withColumns({f"c{i}": F.lit(i) for i in range(30)})
    assert running_module.fitting_rows(narrow, 1) == running_module.TARGET_ROWS_DEFAULT
    assert 16 * 32 * running_module.fitting_rows(wide, 1) <= running_module.TARGET_BYTES
