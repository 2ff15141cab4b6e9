"""Hot groups, quantiles and gaps against brute force."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from helpers import view
from logtally.operators import id_sets, metrics
from logtally.operators.id_gaps import id_gaps
from logtally.operators.ordered import Ordered, order_keys
from logtally.operators.quantiles import exact_quantiles

START = datetime(2026, 8, 20)


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with a third of all rows; repeated and missing times."""
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        group = 7 if i % 3 == 0 else rng.randrange(100)
        when = START + timedelta(seconds=rng.randrange(900))
        rows.append((i, group, None if rng.random() < 0.05 else when, rng.randrange(50)))
    return spark.createDataFrame(
        rows, "id bigint, account_id bigint, created_at timestamp_ntz, x int"
    ).repartition(5)


@pytest.mark.parametrize("seconds", [1, 60, 3600])
@pytest.mark.parametrize("ahead", [True, False])
def test_neighbour_equals_plain_window(skewed, seconds, ahead):
    window = Window.partitionBy("account_id").orderBy(*order_keys())
    step = F.lead if ahead else F.lag
    plain = skewed.select("id", step("x").over(window).alias("n"), step("id").over(window).alias("m"))
    split = Ordered(skewed, ["account_id"], seconds).neighbour(
        ["x", "id"], "_n", ahead
    )
    got = split.select("id", F.col("_n.x").alias("n"), F.col("_n.id").alias("m"))
    assert sorted(got.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("seconds", [1, 3600])
def test_number_equals_plain_window(skewed, seconds):
    two = skewed.withColumn("kind", F.col("x") % 2)
    window = Window.partitionBy("account_id", "kind").orderBy(*order_keys())
    plain = two.select("id", F.row_number().over(window).cast("bigint").alias("n"))
    got = Ordered(two, ["account_id", "kind"], seconds).number("n")
    assert sorted(got.select("id", "n").collect()) == sorted(plain.collect())


def test_no_single_task_holds_the_hot_group(skewed):
    cut = Ordered(skewed, ["account_id"], 60).rows
    biggest = cut.groupBy("account_id", "_slot").count().agg(F.max("count")).first()[0]
    assert biggest < 100


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(-(10**9), 10**12)), min_size=1, max_size=60
    )
)
def test_quantiles_equal_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "g int, v bigint")
    wanted = {"lowest": 0.0, "median": 0.5, "p90": 0.9, "highest": 1.0}
    got = {r.g: r for r in exact_quantiles(df, "g", "v", wanted, unit=1e6).collect()}
    assert set(got) == {g for g, _ in pairs}
    for g, row in got.items():
        values = np.array([v for h, v in pairs if h == g]) / 1e6
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, 5), (2, 4), (2, None)], "g int, v bigint")
    for few in (True, False):
        got = exact_quantiles(df, "g", "v", {"m": 0.5}, few_groups=few).collect()
        assert [(r.g, r.m) for r in got] == [(2, 4.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.sets(
        st.one_of(
            st.integers(-50, 50),
            st.integers(2**21 - 20, 2**21 + 20),
            st.integers(2**42 - 20, 2**42 + 20),
            st.integers(0, 2**62),
        ),
        max_size=60,
    ),
    st.sampled_from([0, 3, 1000]),
)
def test_gaps_equal_brute_force(spark, values, threshold):
    df = spark.createDataFrame([(v,) for v in values], "id bigint")
    got = sorted((r.prev, r.id) for r in id_gaps(df, threshold).collect())
    line = sorted(values)
    assert got == [(a, b) for a, b in zip(line, line[1:]) if b - a > threshold]


# --- ids as bitmaps ----------------------------------------------------------


def scattered(seed, n=3000):
    random = np.random.default_rng(seed)
    near = random.integers(-70_000, 140_000, n)
    edges = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, 65536, 65537, 10**12]
    return sorted({*near.tolist(), *edges, *range(200_000, 200_400)})


@pytest.mark.parametrize("threshold", [1, 7, 15, 16, 40, 1000])
def test_id_sets_match_brute_force(spark, threshold):
    ids = scattered(1)
    other = [i for i in ids if i % 5 and not 65_537 <= i <= 98_304] + [10**13]
    twice = ids[::400] * 2
    frame = spark.createDataFrame([(i,) for i in ids + twice + [None]], "id bigint")
    sets = id_sets.id_sets(frame, held=F.lit(True), even=F.col("id") % 2 == 0)
    got = sorted((r.prev, r.id) for r in id_sets.jumps(sets, "held", threshold).collect())
    assert got == [(a, b) for a, b in zip(ids, ids[1:]) if b - a > threshold]
    even = [i for i in ids if i % 2 == 0]
    got = sorted((r.prev, r.id) for r in id_sets.jumps(sets, "even", threshold).collect())
    assert got == [(a, b) for a, b in zip(even, even[1:]) if b - a > threshold]
    if threshold > 1:
        return
    assert sorted(r.id for r in id_sets.repeated(frame, sets, "held").collect()) == ids[::400]
    unpacked = sets.select(F.explode(id_sets.members(F.col("held"), F.col("bucket"))).alias("id"))
    assert sorted(r.id for r in unpacked.collect()) == ids
    fact = id_sets.id_sets(spark.createDataFrame([(i,) for i in other], "id bigint"), held=F.lit(True))
    lost = id_sets.lacking(sets, fact, "held").collect()
    missing = sorted(set(ids) - set(other))
    assert sum(r.n for r in lost) == len(missing)
    assert min(r.from_id for r in lost) == missing[0] and max(r.to_id for r in lost) == missing[-1]


def scans(df):
    """Scans of files in the plan that was run in the end."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("FileScan")


def test_ordered_metrics_read_the_view_once(spark, tmp_path):
    rows = [
        (i, i % 3, ["ITEM_BUY", "SAFARI_ENTER", "SAFARI_EXIT", "POKEMON_CATCH_ATTEMPT", "POKEMON_CATCH_FAIL"][i % 5],
         f"2026-08-2{i % 7}T0{i % 9}:00:00", {"money": i, "wildUid": "w", "mapId": "s001"})
        for i in range(300)
    ]
    view(spark, rows).write.parquet(f"{tmp_path}/v")
    v = spark.read.parquet(f"{tmp_path}/v")
    assert scans(metrics.money_series(v)) == 1
    assert scans(metrics.safari_session(v)) == 1
    assert scans(metrics.catch_attempt(v)) == 2
