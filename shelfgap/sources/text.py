"""Header CSV in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


MALFORMED = "row_text"


def read_text(
    spark: SparkSession, path: str | list[str], line_breaks: bool = False, malformed: str | None = None
) -> DataFrame:
    """Every column as text, named by the header; blanks around values stay, an empty value is
    NULL and a quoted empty one is ''.

    ``line_breaks`` allows them within quotes. A file is then read by one task, so it is only for
    many files of moderate size. A row of too few or too many values is filled up or cut, as Spark
    does; ``malformed`` names one more column, which has the text of such a row and is NULL in others.
    """
    reader = spark.read.option("header", True).option("emptyValue", "").option("nullValue", None)
    reader = reader.option("multiLine", line_breaks).option("escape", '"')
    if malformed is None:
        return reader.csv(path)
    schema = reader.csv(path).schema.add(malformed, "string")
    # Rows are judged by all columns, whichever a query takes.
    reader = reader.option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
    return reader.schema(schema).csv(path)


def write_text(df: DataFrame, path: str) -> None:
    """Replaces the folder; each task writes its own part, values are kept as they are. '' is
    quoted, so it stays apart from NULL."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""')
        .option("escape", '"')
        .csv(path)
    )
