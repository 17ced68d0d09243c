import csv
from itertools import product

from pyspark.sql import Row
from pyspark.sql import functions as F

from assayer.operators import experiments as ex
from assayer.sources import log_runs, read_runs, write_csv

# The four lists of the standard grid.
MODELS = ["meta-llama/Meta-Llama-3-8B-Instruct", "Qwen/Qwen2.5-7B-Instruct"]
RATES = [0.00005, 0.0001, 0.0002, 0.0003]
RANKS = [8, 16, 32]
MIXTURES = ["flue_100", "flue_80_openorca_20", "flue_60_openorca_40"]


def test_flatten_keeps_scalars_only(spark):
    df = spark.createDataFrame(
        [(("qwen", 32), [1, 2], None, True, {"a": 1})],
        "model struct<name:string,layers:int>, list_value array<int>, nothing string, "
        "flag boolean, extra map<string,int>",
    )
    assert ex.flatten(df).columns == ["model.name", "model.layers", "nothing", "flag"]
    found = {r["key"]: r["value"] for r in ex.flatten_params(df).collect()}
    assert found == {"model.name": "qwen", "model.layers": "32", "flag": "true", "extra.a": "1"}


def test_flatten_params_without_a_map_value(spark):
    df = spark.createDataFrame([(1, None)], "a int, m map<string,string>")
    assert [r["key"] for r in ex.flatten_params(df).collect()] == ["a"]


def test_scalar_metrics(spark):
    df = spark.createDataFrame([Row(run="r", accuracy=0.5, n=3, ok=True, name="x")])
    found = {r["key"]: r["value"] for r in ex.scalar_metrics(df, ["run"]).collect()}
    assert found == {"accuracy": 0.5, "n": 3.0, "ok": 1.0}


def test_ablation_manifest(spark, tmp_path):
    manifest = ex.ablation_manifest(spark, MODELS, RATES, RANKS, MIXTURES)
    found = sorted(tuple(r) for r in manifest.collect())
    assert found == [
        (f"ablation-{i:03d}", *values)
        for i, values in enumerate(product(MODELS, RATES, RANKS, MIXTURES), 1)
    ]
    write_csv(manifest, str(tmp_path / "m"), manifest.columns)
    rows = [r for f in (tmp_path / "m").glob("*.csv") for r in csv.DictReader(f.open())]
    assert len(rows) == 72 and list(rows[0]) == manifest.columns
    assert float(rows[0]["learning_rate"]) == 0.00005


def test_run_ids_grow_beyond_three_digits(spark):
    manifest = ex.ablation_manifest(spark, ["m"] * 10, [0.1] * 10, list(range(10)), ["a"])
    assert manifest.where("run_id = 'ablation-1000'").count() == 1


def test_expand_grid_per_row(spark):
    df = spark.createDataFrame([("s", ["a", "b"], [1, 2]), ("t", ["c"], [])],
                               "sweep string, x array<string>, y array<int>")
    found = [tuple(r) for r in ex.expand_grid(df, {"p": "x", "q": "y"}, ["sweep"]).collect()]
    assert found == [("s", "ablation-001", "a", 1), ("s", "ablation-002", "a", 2),
                     ("s", "ablation-003", "b", 1), ("s", "ablation-004", "b", 2)]


def test_large_grids_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(ex, "ROWS_PER_TASK", 1000, raising=False)
    rows = spark.range(100).selectExpr("id", "sequence(1, 10) AS x", "IF(id = 7, NULL, sequence(1, 10)) AS y")
    grid = ex.expand_grid(rows.coalesce(1), {"p": "x", "q": "y"}, ["id"])
    tasks = grid.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 9_900 and max(r["count"] for r in tasks) <= 2_000
    assert grid.where("run_id != format_string('ablation-%03d', 10 * p + q - 10)").count() == 0
    assert grid.distinct().count() == 9_900


def test_tracking_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    # r1 is logged again with another accuracy, r2 as it was
    for run, accuracy in (("r1", 0.25), ("r2", 0.75), ("r1", 0.5), ("r2", 0.75)):
        params = spark.createDataFrame(
            [("exp", run, ("qwen", [1]))],
            "experiment string, run_id string, model struct<name:string,ranks:array<int>>",
        )
        metrics = spark.createDataFrame([Row(experiment="exp", run_id=run, accuracy=accuracy,
                                             note="n")])
        log_runs(params, metrics, path)
    rows = read_runs(spark, path).collect()
    found = {(r["run_id"], r["kind"], r["key"], r["value"], r["number"]) for r in rows}
    assert len(rows) == 4 and found == {
        ("r1", "param", "model.name", "qwen", None), ("r1", "metric", "accuracy", None, 0.5),
        ("r2", "param", "model.name", "qwen", None), ("r2", "metric", "accuracy", None, 0.75),
    }


def test_params_are_flattened_through_structs_and_maps(spark):
    df = spark.sql("""SELECT struct(map('x', 1) AS m, struct(map('y', true) AS n) AS s) AS a,
      map('o', map('i', 'v')) AS b, map('k', struct(2 AS z, array(1) AS l)) AS c, array(1) AS d,
      CAST(NULL AS map<string,int>) AS e""")
    found = {r["key"]: r["value"] for r in ex.flatten_params(df).collect()}
    assert found == {"a.m.x": "1", "a.s.n.y": "true", "b.o.i": "v", "c.k.z": "2"}
