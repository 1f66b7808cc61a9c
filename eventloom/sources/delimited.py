"""Delimited text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.missing import NULL_TEXTS, null_if_in
from eventloom.functions.time import parse_timestamp
from eventloom.spec import col
from eventloom.staging import stage

TRANSITIONS = "state long, action_index long, action string, next_state long, probability double"


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";") -> DataFrame:
    """Read with a header; all usual spellings of a missing value become null.

    Columns are matched to ``schema`` by name; a cell that does not parse as
    its type is null, and so is every cell of a column that the file lacks.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False)

    found = {f.name: _cast(null_if_in(col(f.name), NULL_TEXTS), f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType) for f in wanted}
    return raw.select(*[cell.alias(n) for n, cell in found.items()])


def _cast(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    return parse_timestamp(text) if isinstance(kind, T.TimestampType) else F.trim(text).try_cast(kind)


CORRUPT = "_corrupt_record"
REJECTS = "file string, reason string, attribute string, text string"


def read_delimited_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";", most_rejected: float = 0.0
) -> tuple[DataFrame, DataFrame]:
    """The table of :func:`read_delimited` without the lines that do not fit the header, and what could not be read (staged).

    The second table has a row for each line with too few or too many cells (``text``
    is the line) and for each cell that is not of its type and so becomes null. A column of the schema that the
    file lacks is an error, and so are more rejected lines than a share of ``most_rejected``.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = spark.read.csv(path, sep=sep, header=True, inferSchema=False).columns
    absent = [f.name for f in wanted if f.name not in names]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    layout = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(layout).csv(path, sep=sep, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    # Spark does not answer queries over the rejected lines alone, so they are written first
    lines = stage(raw.select("*", F.col("_metadata.file_path").alias("__file")), "lines")
    good = lines.where(F.col(CORRUPT).isNull())
    texts = {f.name: null_if_in(col(f.name), NULL_TEXTS) for f in wanted}
    table = good.select(*[_cast(texts[f.name], f.dataType).alias(f.name) for f in wanted])
    broken = lines.where(F.col(CORRUPT).isNotNull()).select(
        F.col("__file").alias("file"), F.lit("not as many cells as the header").alias("reason"), F.lit(None).cast("string").alias("attribute"), F.col(CORRUPT).alias("text")
    )
    cells = [
        F.struct((texts[f.name].isNotNull() & _cast(texts[f.name], f.dataType).isNull()).alias("bad"), F.lit(f"not of type {f.dataType.simpleString()}").alias("reason"), F.lit(f.name).alias("attribute"), texts[f.name].alias("text"))
        for f in wanted
        if not isinstance(f.dataType, T.StringType)
    ]
    if cells:
        bad = good.select(F.col("__file").alias("file"), F.inline(F.array(*cells))).where("bad")
        rejects = stage(broken.unionByName(bad.select("file", "reason", "attribute", "text")), "rejects")
    else:
        rejects = stage(broken, "rejects")
    lost, read = rejects.where("attribute is null").count(), good.count()
    if lost > most_rejected * (lost + read):
        raise ValueError(f"{lost} of {lost + read} lines cannot be read, more than a share of {most_rejected}")
    return table, rejects


def read_all_text(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Every column as text, missing spellings as null."""
    raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False)
    return raw.select(*[null_if_in(col(n), NULL_TEXTS).alias(n) for n in raw.columns])


def number_rows(df: DataFrame, sequence: str = "seq") -> DataFrame:
    """Add the position in the file as a tie-break. Stage the result before using it twice."""
    return df.withColumn(sequence, F.monotonically_increasing_id())


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "errorifexists") -> None:
    """Write with a header, nulls as empty cells."""
    times = {f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    bools = {f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)}
    cells = [
        F.initcap(col(n).cast("string")).alias(n)
        if n in bools
        else (F.date_format(col(n), "yyyy-MM-dd HH:mm:ss.SSSSSSXXX").alias(n) if n in times else col(n))
        for n in df.columns
    ]
    df.select(*cells).write.mode(mode).csv(path, sep=sep, header=True, nullValue="", emptyValue='""')


def read_states(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return read_delimited(spark, path, schema, ",")


def read_transitions(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, TRANSITIONS, ",")
