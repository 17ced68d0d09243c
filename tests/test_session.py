import os

from assayer import session


def test_written_tables_are_below_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == folder
    df = session.written(spark.range(5).selectExpr("id", "rand() AS r"), "five")
    assert sorted(df.collect()) == sorted(df.collect()) and df.count() == 5
    own = f"{folder}/assayer-{spark.sparkContext.applicationId}"
    assert any(name.startswith("five-") for name in os.listdir(own))


def test_remove_written_deletes_only_its_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    (tmp_path / "other").mkdir()
    session.written(spark.range(5), "five")
    assert len(os.listdir(tmp_path)) == 2
    session.remove_written(spark)
    assert os.listdir(tmp_path) == ["other"]
