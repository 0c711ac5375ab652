"""Readers. Schemas are given, never inferred by an extra pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.session import scratch_path
from tallyweave.sources.nulls import normalise_missing


def read_csv(spark: SparkSession, path, schema, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with a header; quotes are doubled inside quoted fields."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )
    return normalise_missing(df)


def read_parts(spark: SparkSession, paths) -> DataFrame:
    """Several Parquet part files or folders as one table, one scan, columns matched by name."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def table_name(file_name: str, prefix: str = "", suffix: str = "_dataset") -> str:
    """Table name of a file: extension, common prefix and suffix removed."""
    name = file_name.rsplit("/", 1)[-1].removesuffix(".csv").removeprefix(prefix)
    return name.removesuffix(suffix)


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> list[str]:
    """Paths below ``folder`` whose name matches, in order, through the file system that the path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, glob))
    return sorted(f.getPath().toString() for f in found or [])


def register_csv_catalog(spark: SparkSession, files: str | dict[str, T.StructType], prefix: str = "", glob: str = "*.csv", schemas=None) -> dict[str, DataFrame]:
    """One de-duplicated temp view per CSV file, named after the file.

    ``files`` is a folder, which is listed, or a schema for each path. A listed file takes the schema that ``schemas`` has
    for its table name; without one its columns are those of its header, as text.
    """
    if isinstance(files, str):
        known = schemas or {}
        files = {f: known.get(table_name(f, prefix)) for f in list_files(spark, files, glob)}
    views = {}
    for path, schema in files.items():
        if schema is None:
            schema = spark.read.option("header", True).option("escape", '"').csv(path).schema
        df = read_csv(spark, path, schema).dropDuplicates()
        name = table_name(path, prefix)
        df.createOrReplaceTempView(name)
        views[name] = df
    return views


def read_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """SQL text with named bind parameters (``:name``)."""
    return spark.sql(text, args=params)


def cached_dataset(spark: SparkSession, path: str, build, unfiltered: bool = True) -> DataFrame:
    """Unfiltered result: computed once, then read from ``path``. Filtered: always computed."""
    if not unfiltered:
        return build()
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_binary(spark: SparkSession, path, glob: str = "*") -> DataFrame:
    """Files as rows (path, modificationTime, length, content), folders searched recursively."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    )


FOOD_FIELDS = ("foodId", "label", "category", "foodContentsLabel", "image")  # fixed names of the answer document
_FOOD = T.StructType([T.StructField(f, T.StringType()) for f in FOOD_FIELDS])
_ENTRY = T.ArrayType(T.StructType([T.StructField("food", _FOOD)]))
FOOD_ANSWER = T.StructType([T.StructField("parsed", _ENTRY), T.StructField("hints", _ENTRY)])


def food_items(answers: DataFrame, column: str = "json") -> DataFrame:
    """Foods of the ``parsed`` and ``hints`` lists that have all five fields."""
    doc = F.from_json(F.col(column), FOOD_ANSWER)
    both = F.concat(
        F.coalesce(doc["parsed"], F.array().cast(_ENTRY)), F.coalesce(doc["hints"], F.array().cast(_ENTRY))
    )
    items = answers.select(F.explode(both).alias("entry")).select("entry.food.*")
    return items.dropna("any", subset=list(FOOD_FIELDS))


def via_scratch(df: DataFrame, name: str, write) -> str:
    """Write ``df`` with ``write(writer, path)`` to a fresh shared path and return the path."""
    path = scratch_path(df.sparkSession, name)
    write(df.write.mode("overwrite"), path)
    return path
