"""File datasets: format dispatch, optional inputs, partitioned and dated outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

FORMATS = {".parquet": "parquet", ".csv": "csv"}


def format_of(path: str, file_format: str | None = None) -> str:
    """Explicit format, else the one the suffix names; anything else is an error."""
    if file_format is not None:
        if file_format not in FORMATS.values():
            raise ValueError(f"unsupported format {file_format!r}")
        return file_format
    for suffix, name in FORMATS.items():
        if path.endswith(suffix):
            return name
    raise ValueError(f"cannot tell the format of {path!r}")


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header; the schema is declared, never inferred from the data."""
    return spark.read.schema(schema).csv(path, header=True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def read_dataset(
    spark: SparkSession, path: str, file_format: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    if format_of(path, file_format) == "parquet":
        return read_parquet(spark, path)
    if schema is None:
        raise ValueError("a CSV dataset needs a schema")
    return read_csv(spark, path, schema)


def write_dataset(df: DataFrame, path: str, file_format: str | None = None, mode: str = "overwrite") -> None:
    if format_of(path, file_format) == "parquet":
        write_parquet(df, path, mode)
    else:
        write_csv(df, path, mode)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The dataset, or an empty table of the declared schema where the path is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_partitioned(
    df: DataFrame, path: str, by: list[str], overwrite: bool = False, files: int = 8
) -> None:
    """One folder per partition value; an existing output is an error unless ``overwrite``.

    Overwriting replaces only the partitions present in ``df``. Rows are dealt
    by partition value and a hash of the row into ``files`` parts: a value is
    written by at most that many tasks, each writing one file, and by more than
    one if it is large.
    """
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(files).cast("bigint"))
    writer = df.repartition(*by, part).write.partitionBy(*by)
    if overwrite:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("errorifexists").parquet(path)


def latest_slice(df: DataFrame, on: str) -> DataFrame:
    """Rows of the latest date."""
    return df.filter(F.col(on) == df.agg(F.max(on)).scalar())
