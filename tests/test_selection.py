import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assayer.operators import selection as sel


def records(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("fpb-"), "id").alias("id"), F.concat(F.lit("text "), "id").alias("text")
    )


def in_order(ids, seed=7):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


@pytest.fixture
def narrow(monkeypatch):
    # make every range "large", so that the narrowing passes run on small data too
    monkeypatch.setattr(sel, "_SMALL_RANGE", 3)
    monkeypatch.setattr(sel, "_SMALL_LIMIT", 3)


@pytest.mark.parametrize("n,test_size,cap", [
    (1000, 0.2, None), (399, 0.2, 50), (7, 0.5, 0), (1, 0.2, None), (0, 0.2, None), (40, 0.0, 9),
    (40, 1.0, None), (30, 0.2, 500),
])
def test_split_equals_a_sort(spark, n, test_size, cap):
    train, test = sel.train_test_split(records(spark, n), "id", test_size, max_train=cap)
    order = in_order([f"fpb-{i}" for i in range(n)])
    k = int(n * (1 - test_size))
    assert ids(train) == set(order[:k][:cap] if cap else order[:k])
    assert ids(test) == set(order[k:])


def test_split_with_narrowing(spark, narrow):
    train, test = sel.train_test_split(records(spark, 30_000), "id", 0.37, seed=11, max_train=400)
    order = in_order([f"fpb-{i}" for i in range(30_000)], 11)
    k = int(30_000 * (1 - 0.37))
    assert ids(train) == set(order[:400]) and ids(test) == set(order[k:])


def multiset(*frames):
    return sum((Counter(tuple(r) for r in f.collect()) for f in frames), Counter())


@pytest.mark.parametrize("test_size", [0.1, 0.3, 0.5, 0.7, 0.9])
def test_split_of_one_hot_id_and_copies(spark, narrow, test_size):
    hot = spark.range(600).select(F.lit(None).cast("string").alias("id"), F.lit("copy").alias("text"))
    same_id = spark.range(600).select(F.lit("x").alias("id"), F.col("id").cast("string").alias("text"))
    df = records(spark, 300).union(hot).union(same_id)
    train, test = sel.train_test_split(df, "id", test_size, max_train=None)
    assert train.count() == int(1500 * (1 - test_size))
    assert multiset(train, test) == multiset(df)
    again, _ = sel.train_test_split(df.repartition(5), "id", test_size)
    assert multiset(again) == multiset(train)


def test_repeat_makes_many_copies(spark):
    row = spark.createDataFrame([("a", [1, 2])], "id string, v array<int>")
    copies = sel._repeat(row, 2_500_001)
    assert copies.columns == ["id", "v"] and copies.count() == 2_500_001
    assert copies.distinct().count() == 1


def test_negative_caps_are_rejected(spark):
    df = records(spark, 3)
    with pytest.raises(ValueError):
        sel.train_test_split(df, max_train=-1)
    with pytest.raises(ValueError):
        sel.first_rows(df, "id", -1)


def test_first_rows(spark, narrow):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003 - 1000).alias("key"))
    keys = sorted(r["key"] for r in df.collect())
    for n in (1, 3, 4, 100, 4999, 5000, 9000):
        assert sorted(r["key"] for r in sel.first_rows(df, "key", n).collect()) == keys[:n]
    for none in (0, None):
        assert sel.first_rows(df, "key", none).count() == 5000
    assert sel.exactly_first_rows(df, "key", 0).count() == 0
    assert sel.exactly_first_rows(df.limit(0), "key", 10).count() == 0


def test_first_rows_by_other_orders(spark, narrow):
    df = spark.range(300).selectExpr("id % 3 AS a", "string(id) AS b")
    rows = sorted((r["a"], r["b"]) for r in df.collect())
    for n in (2, 150, 400):
        assert sorted(map(tuple, sel.first_rows(df, ["a", "b"], n).collect())) == rows[:n]
    names = sorted(b for _, b in rows)
    assert sorted(r["b"] for r in sel.first_rows(df, "b", 120).collect()) == names[:120]


def test_first_rows_with_a_hot_key(spark, narrow):
    df = spark.range(900).select(
        F.when(F.col("id") < 300, F.col("id")).otherwise(300).alias("key"), F.lit("t").alias("text")
    )
    assert sel.first_rows(df, "key", 500).groupBy("key").count().where("key = 300").first()[1] == 200


def test_first_rows_over_the_whole_bigint_range(spark, narrow):
    keys = [-(2**63), -5, 0, 7, 8, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "key bigint")
    assert sorted(r["key"] for r in sel.first_rows(df, "key", 5).collect()) == keys[:5]
    assert sorted(r["key"] for r in sel.first_rows(df.where("key < 9"), "key", 4).collect()) == keys[:4]


def test_first_rows_filter_reaches_the_scan(spark, tmp_path, narrow, capsys):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    sel.first_rows(spark.read.parquet(str(tmp_path / "t")), "id", 600).explain("formatted")
    assert "LessThanOrEqual(id,599)" in capsys.readouterr().out


def test_permutation(spark):
    df = records(spark, 2000)
    found = sel.permute(df, seed=3).orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(2000))
    assert [r["id"] for r in found] == in_order([f"fpb-{i}" for i in range(2000)], 3)


def test_permutation_of_copies(spark):
    df = records(spark, 1).union(records(spark, 1)).union(records(spark, 5))
    assert sorted(r["position"] for r in sel.permute(df).collect()) == list(range(7))


def test_first_rows_with_missing_and_equal_keys(spark, narrow):
    rows = [(None if i % 6 == 0 else i // 9, f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "key int, text string")
    whole = [r["text"] for r in df.orderBy("key", sel._content_code(df)).collect()]
    for n in (1, 3, 20, 49, 50, 51, 120, 299, 300, 310):
        found = {r["text"] for r in sel.exactly_first_rows(df.repartition(3), "key", n).collect()}
        assert found == set(whole[:n]), n


def test_quotas(spark, narrow):
    df = spark.range(400).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'rare' ELSE 'often' END AS kind")
    first = {k: in_order([i for i in range(400) if (i % 10 == 0) == (k == "rare")])
             for k in ("rare", "often")}
    found = sel.balanced_sample(df, "kind", ["rare", "often"])
    assert ids(found) == {i for own in first.values() for i in own[:40]}
    found = sel.weighted_mixture(df, "kind", {"rare": 1, "often": 2}, 100)
    assert ids(found) == {*first["rare"][:33], *first["often"][:67]}
    assert sel.quota_sample(df, "kind", {"rare": 99, "none": 5, "often": 0}).count() == 40
    with pytest.raises(ValueError):
        sel.weighted_mixture(df, "kind", {"rare": 0}, 10)


def test_short_sources_are_errors_or_drawn_from_again(spark):
    df = spark.range(400).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'rare' ELSE 'often' END AS kind")
    first = {k: in_order([i for i in range(400) if (i % 10 == 0) == (k == "rare")]) for k in ("rare", "often")}
    with pytest.raises(ValueError, match="'rare' has 40 of the 50 rows"):
        sel.weighted_mixture(df, "kind", {"rare": 1, "often": 1}, 100)
    with pytest.raises(ValueError, match="'none' has 0 of the 1 rows"):
        sel.quota_sample(df, "kind", {"none": 1}, short="repeat")
    found = sel.weighted_mixture(df, "kind", {"rare": 1, "often": 1}, 200, short="repeat").collect()
    assert len(found) == 200
    times = {i: sum(r["id"] == i for r in found) for i in first["rare"]}
    assert [times[i] for i in first["rare"]] == [3] * 20 + [2] * 20
    assert {r["id"] for r in found if r["kind"] == "often"} == set(first["often"][:100])
    assert sel.quota_sample(df, "kind", {"rare": 80}, short="repeat").count() == 80


def test_quotas_of_hot_ids_and_copies(spark):
    rows = [(7, "a", i % 5) for i in range(300)] + [(i, "a", 0) for i in range(100, 400)]
    df = spark.createDataFrame(rows, "id long, kind string, x int").repartition(5)
    for n in (1, 150, 299, 450, 599, 600, 700):
        found = sel.quota_sample(df, "kind", {"a": n}).collect()
        assert len(found) == min(n, 600)
        copies = sum(r["id"] == 7 for r in found)
        assert copies in (0, 300) or 0 < copies < 300 and len({r["id"] for r in found}) == n - copies + 1


def test_a_thousand_sources_are_read_in_a_few_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).selectExpr("id", "concat('s', id % 1000) AS kind").write.parquet(path)
    df = spark.read.parquet(path)
    found = sel.quota_sample(df, "kind", {f"s{i}": i % 12 for i in range(1000)})
    assert found.groupBy("kind").count().where("count > 11").isEmpty()
    assert found.count() == sum(i % 12 for i in range(1000))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count(str(tmp_path)) <= 2


def test_permutation_of_copies_and_hot_ids(spark):
    rows = [(7, "copy")] * 400 + [(7, f"x{i}") for i in range(50)] + [(i, "y") for i in range(100, 500)]
    rows += [(None, "z"), (None, "z"), (9, None)] + [(8, "w")] * 200
    df = spark.createDataFrame(rows, "id long, text string").repartition(6)
    found = sel.permute(df).collect()
    assert sorted(r["position"] for r in found) == list(range(len(rows)))
    assert sorted((str(r["id"]), str(r["text"])) for r in found) == sorted((str(a), str(b)) for a, b in rows)
    by_place = [r["id"] for r in sorted(found, key=lambda r: r["position"])]
    expected = sorted(
        (i for i, _ in rows),
        key=lambda i: hashlib.md5(f"7:{'' if i is None else i}".encode()).hexdigest(),
    )
    assert by_place == expected
    # Copies fill several partitions, and the texts of an id stand in one order.
    parts = sel._permutation_cuts(
        df.select(F.lit("abcd").alias("__prefix"), F.lit("abcdef").alias("__hash"), F.lit(1).cast("long").alias("__content"))
    )
    assert parts[1] >= 8 and parts[0][0][2][0][3] >= 8
    again = [r["text"] for r in sorted(sel.permute(df.repartition(2)).collect(), key=lambda r: r["position"])]
    assert again == [r["text"] for r in sorted(found, key=lambda r: r["position"])]
    assert sel.permute(df.limit(0)).count() == 0
