import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopledger.operators.ordered import mark_runs, neighbours


def make(seed, n=120):
    rnd = random.Random(seed)
    # One key holds most of the rows.
    rows = [(rnd.choice("aaab"), i * rnd.randint(1, 3) + i, rnd.choice([1, 2, None]), rnd.randint(0, 5)) for i in range(n)]
    seen, out = set(), []
    for k, at, flag, v in rows:
        if (k, at) not in seen:
            seen.add((k, at))
            out.append((k, at, flag, v))
    return out


def by_key(rows):
    keys = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        keys.setdefault(r[0], []).append(r)
    return keys


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_neighbours_equal_the_plain_window(spark, width):
    rows = make(width)
    df = spark.createDataFrame(rows, "k string, at int, x int, v int").repartition(5)
    got = neighbours(
        df, ["k"], ["at"], F.floor(F.col("at") / width),
        lag={"before": "x"}, lead={"after": "v"}, running={"total": F.col("v")}, fill={"last_x": "x"},
    ).collect()
    want = {}
    for k, items in by_key(rows).items():
        total, last = 0, None
        for j, (_, at, x, v) in enumerate(items):
            total += v
            last = x if x is not None else last
            want[(k, at)] = (
                items[j - 1][2] if j else None, items[j + 1][3] if j + 1 < len(items) else None, total, last,
            )
    assert {(r.k, r["at"]): (r.before, r.after, r.total, r.last_x) for r in got} == want


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_runs_equal_the_plain_window(spark, width):
    rows = make(width + 50)
    df = spark.createDataFrame(rows, "k string, at int, x int, v int").repartition(3)
    got = mark_runs(
        df, ["k"], ["at"], F.floor(F.col("at") / width), ["v"], lambda prev, cur: prev("v") > cur("v")
    ).collect()
    want = {}
    for k, items in by_key(rows).items():
        run = 0
        for j, (_, at, _x, v) in enumerate(items):
            run += 1 if j == 0 or items[j - 1][3] > v else 0
            want[(k, at)] = run
    assert {(r.k, r["at"]): r.run_no for r in got} == want


def test_no_window_spans_a_whole_key_of_rows(spark):
    df = spark.createDataFrame(make(1), "k string, at int, x int, v int")
    plan = neighbours(df, ["k"], ["at"], F.col("at"), lag={"before": "x"})._jdf.queryExecution().toString()
    assert "windowspecdefinition(k" in plan and "__bucket0" in plan


def test_deep_buckets_equal_the_plain_window(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice("kk?"), n, n // 4, n // 16, rnd.randint(1, 9), rnd.choice([None, None, f"v{n}"])) for n in range(300)]
    df = spark.createDataFrame(rows, "k string, at int, fine int, wide int, v int, f string").repartition(5)
    buckets = [F.floor(F.col("wide") / 4), F.col("wide"), F.col("fine")]
    got = neighbours(df, ["k"], ["at"], buckets, lag={"before": "v"}, running={"total": F.col("v")}, fill={"filled": "f"}, deep=True)
    plain = Window.partitionBy("k").orderBy("at")
    want = df.withColumns({"before": F.lag("v").over(plain), "total": F.sum("v").over(plain),
                           "filled": F.last("f", ignorenulls=True).over(plain.rowsBetween(Window.unboundedPreceding, 0))})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
