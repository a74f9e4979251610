"""Small awkward inputs shared by the tests of the corpus operators."""

from pyspark.sql import DataFrame, SparkSession

LONG = "the long word list goes on " * 4000
#: Nulls, empty and very long texts, ties, repeated rows.
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en"),
    (2, "Alpha  beta\tgamma delta epsilon zeta eta theta iota kappa lambda mu", None),
    (3, None, "en"), (4, "", "de"), (5, LONG, None), (6, "password = hunter2secret", "fr"),
    (7, "Released under the MIT License.", "en"), (7, "Released under the MIT License.", "en"),
    (None, "no id here", "en"), (8, "x", None), (9, "Été naïve \U0001f600 \x00 end", "fr"),
]


def awkward(spark: SparkSession) -> DataFrame:
    """With columns whose names clash with those that operators return or use."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.selectExpr("*", "'a' AS score", "1 AS words", "2 AS fp", "3 AS size", "'z' AS digest", "4 AS slot", "5 AS ids", "6 AS start")


def on_disk(df: DataFrame, tmp_path) -> DataFrame:
    df.write.mode("overwrite").parquet(str(tmp_path / "docs"))
    return df.sparkSession.read.parquet(str(tmp_path / "docs"))
