"""Surveys, phone logs, ring and watch rows derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortloom import schemas
from cohortloom.operators import reshape

QUESTIONS = ["q1", "q2", "q3", "q4"]


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is looked up once, not by every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def quarters(column: str) -> Column:
    """Value cut to quarters, whose sums are exact in any order."""
    return F.floor(F.col(column) * 4) / 4


def _choice(number: Column, *answers: str) -> Column:
    return F.element_at(F.array(*[F.lit(a) for a in answers]), (number + 1).cast("int"))


def surveys_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One submission per order; answers from its line items, some blank."""
    answers = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").cast("bigint").alias("quantity"),
            F.max("l_partkey").alias("part"),
            F.max("l_suppkey").alias("supplier"),
            F.count("*").alias("lines"),
        )
    )
    kind = F.when(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), F.lit("UCLA_")
    ).otherwise(F.lit("PHQ_"))
    stem = F.concat(kind, "o_orderpriority", F.lit("_"), text("o_orderkey"))
    return (
        table(spark, sf_dir, "orders")
        .join(answers, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            text("o_custkey").alias("participant"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            F.concat(stem, F.lit(".csv")).alias("file_name"),
            stem.alias("file_stem"),
            _choice(F.col("quantity") % 5, "Never", "Rarely", "sometimes", "Often", "Often").alias("q1"),
            _choice(F.col("part") % 4, "never", "Rarely", "Sometimes", "often").alias("q2"),
            _choice(F.col("supplier") % 5, "Never", "Rarely", "Sometimes", "Often", " ").alias("q3"),
            _choice(F.col("lines") % 4, "Never", "Rarely", "Sometimes", "Often").alias("q4"),
        )
    )


def surveys_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = surveys_wide(spark, sf_dir)
    ids = reshape.metadata_columns(wide.columns)
    return reshape.unpivot_answers(wide, ids, reshape.question_columns(wide.columns))


def _events(spark: SparkSession, sf_dir: str, kind: str, shift: int) -> DataFrame:
    """All events of a kind; shifted ids give each log participants that others lack."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return events.withColumn("user_id", F.col("user_id") + shift)


def _code(modulus: int, shift: int = 0) -> Column:
    return text(F.col("event_id") % modulus + shift)


PHONE_SOURCES = {
    "battery": ("view", 0),
    "calls": ("click", 10),
    "messages": ("signup", 20),
    "notifications": ("purchase", 30),
    "screen": ("error", 40),
}


def phone_log(spark: SparkSession, sf_dir: str, log: str) -> DataFrame:
    kind, shift = PHONE_SOURCES[log]
    measures = {
        "battery": {
            "battery_charge_start": quarters("value"),
            "battery_charge_end": quarters("value") * 0.5,
        },
        "calls": {"dur": quarters("value"), "type": _code(3, 1)},
        "messages": {"message_type": _code(2, 1)},
        "notifications": {"package_category": _code(6)},
        "screen": {"screen_status": _code(4)},
    }[log]
    return _events(spark, sf_dir, kind, shift).select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        text("user_id").alias("participant"),
        *[column.alias(name) for name, column in measures.items()],
    )


def ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ring record per line item; each measure is missing on a seventh of the lines."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    measures = [
        f"CASE WHEN l_linenumber % 7 <> {i % 7} THEN l_quantity + {i} END AS {measure}"
        for i, measure in enumerate(schemas.RING_AVERAGES, start=1)
    ]
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "CAST(o_custkey AS string) AS participant",
        "unix_seconds(CAST(l_shipdate AS timestamp)) AS timestamp",
        *measures,
    )


def watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        text("user_id").alias("participant"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        quarters("value").alias("hrm"),
        *[
            (quarters("value") * (F.col("event_id") % m)).alias(axis)
            for axis, m in (("accx", 7), ("accy", 11), ("accz", 13))
        ],
    )


def log(spark: SparkSession, sf_dir: str, modality: str) -> DataFrame:
    return ring(spark, sf_dir) if modality == "ring" else phone_log(spark, sf_dir, modality)


def logs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {modality: log(spark, sf_dir, modality) for modality in (*PHONE_SOURCES, "ring")}


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models, five folds; scores repeat, so ties are ranked."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("model"),
        (F.col("l_orderkey") % 5).cast("int").alias("fold"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_quantity") / 50).alias("score"),
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
    )


def brand_importance(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    """An importance-like table: each brand's share of a summed measure."""
    hundredths = F.round(F.col(measure) * 100).cast("bigint")
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("feature"), hundredths.alias("n"))
    total = part.agg(F.sum("n").cast("double")).scalar()
    brands = part.groupBy("feature").agg(F.sum("n").cast("double").alias("n"))
    return brands.select("feature", (F.col("n") / total).alias("importance"))


def file_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys built from page ids: unsafe characters, clean names and many clashes."""
    page = F.col("page_id")
    form = F.concat(F.lit("form"), text(page % 3))
    unsafe = F.concat(form, F.lit(" "), F.translate(text(page), "0123456789", " :?#=&+,;!"))
    numbered = F.concat(form, F.lit("_"), text((page / 10).cast("bigint")))
    name = F.when(page % 10 == 0, numbered).otherwise(unsafe)
    folder = F.concat(F.lit("Participant_"), text(page % 4), F.lit("/Surveys/"))
    return table(spark, sf_dir, "pages").select(
        F.concat(folder, name, F.lit(".csv")).alias("key")
    )


def page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.concat("url", F.lit(".csv")).alias("key"))
