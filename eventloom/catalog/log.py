"""The test tables as an event log: a case is one user's day in ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.bins import fixed_bins
from eventloom.operators import temporal
from eventloom.operators.scan import Splits, find_splits
from eventloom.plans.discovery import DecisionModel, discover
from eventloom.plans.preprocess import canonical
from eventloom.spec import LogSpec

SPEC = LogSpec(
    case="case_id",
    activity="activity",
    timestamp="ts",
    sequence="seq",
    static_categorical=("segment",),
    dynamic_categorical=("activity", "resource"),
    dynamic_numeric=("value", "k"),
    rename={"case:concept:name": "case_id", "concept:name": "activity", "time:timestamp": "ts", "org:resource": "resource"},
    strip_prefix="case:",
)

BUCKET_EDGES = (20.0, 50.0)
BUCKET_LABELS = ("low", "medium", "high")


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log under the names that log files use."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    ts, k = F.col("ts").cast("timestamp"), F.col("k")
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    rows = events.select(
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("case:concept:name"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("concept:name"),
        ts.alias("time:timestamp"),
        "value",
        "k",
        F.when(k % 5 != 0, F.concat(F.lit("r"), (k % 7).cast("string"))).alias("org:resource"),
    )
    joined = rows.join(customer, F.col("user_id") == F.col("c_custkey"), "left")
    return joined.withColumnRenamed("c_mktsegment", "case:segment").drop("user_id", "c_custkey")


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(raw_log(spark, sf_dir), SPEC)


def bucket_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with the value's bucket."""
    return load_log(spark, sf_dir).withColumn("bucket", fixed_bins(F.col("value"), BUCKET_EDGES, BUCKET_LABELS))


def position_log(spark: SparkSession, sf_dir: str, splits: Splits) -> DataFrame:
    """The log with the event number and k modulo 10."""
    log = load_log(spark, sf_dir)
    return temporal.with_time_features(log, SPEC, splits).withColumn("k10", F.col("k") % 10)


def log_splits(log: DataFrame) -> Splits:
    """The cuts of its large cases; they hold for the log with more columns, too."""
    return find_splits(log, [SPEC.case], SPEC.order)


def model_of(log: DataFrame, attributes: list[str], keep: tuple[str, ...] = (), **options) -> DecisionModel:
    """The decision model of one of the logs; its steps keep the columns ``keep``."""
    return discover(log, SPEC, attributes, keep=keep, **options)


def bucket_model(spark: SparkSession, sf_dir: str) -> DecisionModel:
    """States: last action and value bucket."""
    return model_of(bucket_log(spark, sf_dir), ["bucket"])


def position_model(spark: SparkSession, sf_dir: str, **options) -> DecisionModel:
    """States: last action, event number and k modulo 10."""
    splits = log_splits(load_log(spark, sf_dir))
    return model_of(position_log(spark, sf_dir, splits), ["event_nr", "k10"], splits=splits, **options)


def level_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a number in three far groups."""
    level = 1000.0 * (F.col("k") % 3) + F.col("k") % 2
    return load_log(spark, sf_dir).withColumn("level", level)


def described(spark: SparkSession, sf_dir: str) -> tuple[DecisionModel, DataFrame]:
    """The bucket model and its described states, all attributes as text or numbers."""
    model = model_of(bucket_log(spark, sf_dir), ["bucket"], ("segment", "resource", "value", "k"))
    return model, model.describe(["segment", "resource"], ["value", "k"])
