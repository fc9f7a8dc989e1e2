"""Text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_training_csv(manifest: DataFrame, path: str) -> None:
    """The manifest as CSV parts in path order, each with a header.

    Quoting follows the usual CSV rules: quotes doubled, empty fields bare,
    spaces and backslashes untouched.
    """
    (
        manifest.select("video", "prompt")
        .orderBy("video")
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_training_csv(spark, path: str) -> DataFrame:
    rows = (
        spark.read.schema("video string, prompt string")
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return rows.select("video", F.coalesce("prompt", F.lit("")).alias("prompt"))


def write_corrupt_log(log: DataFrame, path: str) -> None:
    """One ``path TAB error`` line per corrupt file."""
    lines = log.select(F.concat_ws("\t", "path", "error").alias("value"))
    lines.write.mode("overwrite").text(path)
