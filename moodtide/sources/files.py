"""CSV and JSON files in and out."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.sources import split_csv

# Cell contents that mean "missing" in a CSV.
NA_VALUES = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

REVIEWS_FILE = "reviews_demo.csv"
MARKET_FILE = "market_demo.csv"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    na_values: Sequence[str] = NA_VALUES,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """CSV with header; every column is a string, missing-value words become NULL.

    Quoted texts may hold line breaks, for which Spark reads each file in one task. For large
    files without line breaks in quotes, ``multi_line=False`` lets them be split. ``split`` reads
    large files with line breaks in many tasks too, at the price of a second pass and a shuffle; it
    refuses quotes in fields that are not quoted.
    """
    df = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path if isinstance(path, str) else list(path))
    )
    if split and multi_line and df.columns:
        df = split_csv.read(spark, [path] if isinstance(path, str) else list(path), df.columns)
    if not na_values:
        return df
    words = list(na_values)
    # Headers may contain dots or blanks, so columns are addressed by quoted name.
    return df.select(*[_null_if_in(c, words).alias(c) for c in df.columns])


def _null_if_in(name: str, words: Sequence[str]):
    c = F.col(f"`{name.replace('`', '``')}`")
    return F.when(~c.isin(list(words)), c)


def read_reviews(spark: SparkSession, path: str, **options) -> DataFrame:
    """Reviews from a CSV or Parquet path."""
    return spark.read.parquet(path) if _is_parquet(path) else read_csv(spark, path, **options)


def read_market(spark: SparkSession, path: str, **options) -> DataFrame:
    """Daily returns from a CSV or Parquet path."""
    return spark.read.parquet(path) if _is_parquet(path) else read_csv(spark, path, **options)


def _is_parquet(path: str) -> bool:
    return PurePosixPath(path.rstrip("/")).suffix == ".parquet"


def load_demo(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The demo pair in ``folder``; an error names the folder when a file is missing."""
    paths = [f"{folder.rstrip('/')}/{name}" for name in (REVIEWS_FILE, MARKET_FILE)]
    try:
        return read_csv(spark, paths[0]), read_csv(spark, paths[1])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"demo files {REVIEWS_FILE} and {MARKET_FILE} not found in {folder}") from e


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """CSV files with a header and quoted quotes, readable by :func:`read_csv`."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)
