"""Random small tables against plain Python."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallylake.operators import profile, reload
from tallylake.operators.skew import balanced_join, rows_with_key_in
from tallylake.schema import BUSINESS_KEY

from samples import MOVEMENT

FEW = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

amounts = st.sampled_from([None, "-1.00", "0.00", "0.01", "7.50"]).map(
    lambda v: None if v is None else Decimal(v)
)
rows = st.lists(
    st.tuples(
        st.integers(1, 6),
        amounts,
        st.sampled_from([None, "", "a"]),
        st.sampled_from([None, "2024-01-01"]),
        st.sampled_from([None, 1, 2]),
    ),
    max_size=30,
)
keys = st.lists(st.sampled_from([None, 1, 1, 1, 2, 3]), max_size=40)


@FEW
@given(rows)
def test_profile(spark, data):
    got = profile.measure(spark.createDataFrame(data, MOVEMENT), BUSINESS_KEY).counts.first()
    values = [r[1] for r in data]
    assert got.total == len(data)
    assert got.distinct_keys == len({r[1:] for r in data})
    assert got.valid == sum(v is not None and v > 0 for v in values)
    assert got.invalid == sum(v is not None and v <= 0 for v in values)
    assert got.missing == values.count(None)
    for i in range(5):
        assert got[f"nulls_{i}"] == sum(r[i] is None for r in data)


@FEW
@given(rows)
def test_one_row_per_key(spark, data):
    kept = reload.first_per_key(spark.createDataFrame(data, MOVEMENT), BUSINESS_KEY).collect()
    smallest = {}
    for r in data:
        smallest[r[1:]] = min(smallest.get(r[1:], r[0]), r[0])
    assert {tuple(r)[1:]: r.id for r in kept} == smallest
    assert len(kept) == len(smallest)


@FEW
@given(keys, keys)
def test_balanced_join(spark, left, right):
    l = spark.createDataFrame(list(enumerate(left)), "row int, k int")
    r = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "rk int, x int")
    got = Counter(tuple(x) for x in balanced_join(l, r, "k", "rk", F.col("row"), "inner", 4).collect())
    want = Counter(
        (i, k, rk, j)
        for i, k in enumerate(left)
        for j, rk in enumerate(right)
        if k is not None and k == rk
    )
    assert got == want


@FEW
@given(keys)
def test_rows_of_repeated_keys(spark, data):
    df = spark.createDataFrame(list(enumerate(data)), "row int, k int")
    counts = df.where("k is not null").groupBy(F.col("k").alias("key")).agg(F.count("*").alias("n"))
    got = rows_with_key_in(df, "k", counts.where("n > 1"), 4)
    n = Counter(data)
    assert sorted(r.row for r in got.collect()) == [
        i for i, k in enumerate(data) if k is not None and n[k] > 1
    ]
