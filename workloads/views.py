"""Record sets derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_to_label(code: Column) -> Column:
    return F.when(code == 0, "negative").when(code == 1, "neutral").otherwise("positive")


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, sentence, code, label, lang``: documents with a label code 0, 1 or 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("sentence"), "lang")
    labels = table(spark, sf_dir, "labels")
    code = F.col("quality") - F.col("toxic") + 1
    return docs.join(labels, "doc_id").select(
        "doc_id", "sentence", code.alias("code"), code_to_label(code).alias("label"), "lang"
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, headline, sentence, spelled, label`` with missing texts and label spellings.

    Headlines are empty in German and missing in French texts, and blank in other
    short ones. ``spelled`` labels can all be normalized unless their text is blank;
    among the ``label`` values Spanish and short texts have unsupported ones.
    """
    docs = labeled(spark, sf_dir)
    lang, label, code = F.col("lang"), F.col("label"), F.col("code")
    short = F.length("sentence") < 200
    alias = F.when(code == 0, "bearish").when(code == 1, "mixed").otherwise("bullish")
    spelled = (
        F.when(lang == "fr", F.concat(F.lit(" "), F.upper(label), F.lit("\t")))
        .when(lang == "en", alias)
        .otherwise(label)
    )
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(lang == "de", "")
        .when(lang == "fr", None)
        .when(short, "  \t")
        .otherwise(F.col("sentence"))
        .alias("headline"),
        F.concat(F.lit(" "), "sentence", F.lit("\n")).alias("sentence"),
        F.when(short & lang.isin("en", "es"), "n/a").otherwise(spelled).alias("spelled"),
        F.when(short, "n/a").when(lang == "es", "unsure").otherwise(spelled).alias("label"),
    )


def _gold() -> Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "A", "negative").when(flag == "N", "neutral").otherwise("positive")


def _answer() -> Column:
    return F.when(F.col("l_linestatus") == "F", _gold()).otherwise("neutral")


def _completion() -> Column:
    number, word = F.col("l_linenumber"), _answer()
    return (
        F.when(number == 1, word)
        .when(number == 2, F.concat(F.lit("The label is "), word))
        .when(number == 3, F.concat(F.lit("  "), F.upper(word), F.lit(" ")))
        .when(number == 4, F.concat(word, F.lit(".")))
        .when(number == 5, "buy")
        .when(number == 6, "positive negative")
        .when(F.col("l_partkey") % 3 != 0, F.concat(word, F.lit(" sell")))
    )


def predictions(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """``keep`` columns and ``label, prediction, confidence, latency_ms`` from lineitem."""
    return table(spark, sf_dir, "lineitem").select(
        *keep,
        _gold().alias("label"),
        _completion().alias("prediction"),
        ((F.col("l_quantity") - 5) / 40).alias("confidence"),
        F.col("l_extendedprice").alias("latency_ms"),
    )


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _gold().alias("label"),
        F.lit("neutral").alias("prediction"),
        (F.col("l_quantity") / 50).alias("confidence"),
        F.col("l_extendedprice").alias("latency_ms"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on the same examples, read in one scan."""

    def run(name: str, prediction: Column, confidence: Column) -> Column:
        return F.struct(
            F.lit(name).alias("run"),
            _gold().alias("label"),
            prediction.alias("prediction"),
            confidence.alias("confidence"),
            F.col("l_extendedprice").alias("latency_ms"),
        )

    quantity = F.col("l_quantity")
    rows = F.array(
        run("base", F.lit("neutral"), quantity / 50),
        run("sft", _completion(), (quantity - 5) / 40),
        run("dpo", _answer(), F.lit(0.6) + quantity / 200),
    )
    return table(spark, sf_dir, "lineitem").select(F.inline(rows))


def event_predictions(events: DataFrame, *keep: Column) -> DataFrame:
    kind = F.col("event_type")
    gold = F.when(kind == "purchase", "positive").when(kind == "error", "negative")
    return events.select(
        *keep,
        "ts",
        gold.otherwise("neutral").alias("label"),
        F.when(F.col("value") < 5, "positive")
        .when(F.col("value") < 20, "The label is neutral")
        .otherwise(kind)
        .alias("prediction"),
        (F.col("value") / 50).alias("confidence"),
        F.col("value").alias("latency_ms"),
    )


def token_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq_id, step, scores, chosen``: five steps of 64 scores per sequence."""
    return table(spark, sf_dir, "embeddings").select(
        F.expr("vec_id DIV 5").alias("seq_id"),
        (F.col("vec_id") % 5).alias("step"),
        F.col("embedding").alias("scores"),
        F.col("label").alias("chosen"),
    )


def rule_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled texts in which the commonest word of one language is ``profit``."""
    return labeled(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        F.replace(F.col("sentence"), F.lit("the"), F.lit("profit")).alias("text"),
        "label",
    )


def sweeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sweep of 2 x 4 x 3 x 3 runs per part."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.array("p_brand", "p_type").alias("models"),
        F.array(*map(F.lit, (0.00005, 0.0001, 0.0002, 0.0003))).alias("rates"),
        F.array(*map(F.lit, (8, 16, 32))).alias("ranks"),
        F.array(*map(F.lit, ("flue_100", "flue_80_openorca_20", "flue_60_openorca_40"))).alias(
            "mixtures"
        ),
    )


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tracked run per event, with nested parameters."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("experiment"),
        F.concat(F.lit("run-"), "event_id").alias("run_id"),
        F.struct(
            F.from_json("props", "k int").alias("props"),
            F.col("event_type").alias("kind"),
            F.array("user_id").alias("users"),
        ).alias("model"),
        F.col("user_id").alias("user"),
    )


def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("experiment"),
        F.concat(F.lit("run-"), "event_id").alias("run_id"),
        "value",
        "user_id",
        (F.col("value") > 20).alias("large"),
        F.col("props").alias("note"),
    )
