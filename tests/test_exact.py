"""Exact sums against math.fsum."""

import math
import random

import pytest

from assayer.functions.exact import exact_sums

TRICKY = [
    [], [0.0], [0.1] * 10, [1e300, 1e-300, -1e300], [1.0, 2.0**-53, 2.0**-106], [1.0, 2.0**-53],
    [1.0, 2.0**-52, 2.0**-53, -(2.0**-106)], [5e-324] * 3, [1.7e308, -1.7e308, 5e-324], [-0.0, 0.0],
    [2.0**53, 1.0, 1.0], [65536.0, 65535.999999999993, -1e-5], [1e16, 1.0, -1e16], [-1.0, -(2.0**-53), -(2.0**-106)],
]


def values(rng, n):
    return [rng.choice((-1, 1)) * rng.random() * 2.0 ** rng.randint(-1000, 1000) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_sums_are_correctly_rounded(spark, partitions):
    rng = random.Random(7)
    sets = [*TRICKY, *[values(rng, n) for n in (1, 2, 3, 30, 300)]]
    sets += [[x, -x * (1 + 2**-52), 1e-9] for x in values(rng, 20)]
    rows = [(i, x) for i, own in enumerate(sets) for x in [*own, None]]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id int, x double").repartition(partitions)
    found = {r["id"]: r["total"] for r in exact_sums(df, "x", ["id"]).collect()}
    assert found == {i: math.fsum(own) for i, own in enumerate(sets)}


def test_special_values_and_empty_tables(spark):
    rows = [(0, math.nan), (0, 1.0), (1, math.inf), (1, -1e300), (2, math.inf), (2, -math.inf), (3, None)]
    df = spark.createDataFrame(rows, "id int, x double")
    found = {r["id"]: r["total"] for r in exact_sums(df, "x", ["id"]).collect()}
    assert math.isnan(found[0]) and found[1] == math.inf and math.isnan(found[2]) and found[3] == 0
    assert exact_sums(df.limit(0), "x", ["id"]).count() == 0
    assert exact_sums(df.limit(0), "x").first()["total"] == 0


def test_one_group_of_many_rows_has_few_bins(spark):
    df = spark.range(300_000).selectExpr("if(id % 2 = 0, 1e300, -1e300) + 0.1 * id AS x", "id")
    wide = df.selectExpr("if(id % 3 = 0, x, 0.1 * id) AS x")
    assert exact_sums(wide, "x").first()["total"] == math.fsum(r["x"] for r in wide.collect())
