"""Report files (K5, K6).

The reference exports one day's report as a pretty-printed JSON file and
keeps a CSV of the long table; here every day is written at once, by the
executors, one JSON object per line / one CSV row per cell. Nothing is
gathered on the driver. An export by day replaces the days it is given and
no others; ``read_report_json`` reads both forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill.schemas import SALES

REPORT_DOCUMENT = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("total_sales", SALES, True),
        T.StructField(
            "province_sales",
            T.ArrayType(T.StructType([T.StructField("province", T.StringType()), T.StructField("sales", SALES)])),
        ),
        T.StructField(
            "city_sales",
            T.ArrayType(T.StructType([T.StructField("city", T.StringType()), T.StructField("sales", SALES)])),
        ),
    ]
)

REPORT_LONG = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("dimension", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("sales", SALES, True),
    ]
)


def write_report_json(doc: DataFrame, path: str) -> None:
    """K5: one JSON document per day (UTF-8, non-ASCII kept as is)."""
    doc.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(path)


def write_report_days(doc: DataFrame, path: str) -> None:
    """K5 by day: a folder for each document's day; days not among them are left as they are."""
    # As many writers as a shuffle has tasks: each day is a file of its own, however small.
    tasks = int(doc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = doc.repartition(tasks, "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("dateFormat", "yyyy-MM-dd")
    writer.partitionBy("date").json(path)


def read_report_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_DOCUMENT).option("dateFormat", "yyyy-MM-dd").json(path)


def write_report_csv(long: DataFrame, path: str) -> None:
    """K6: the long report as CSV with a header row."""
    long.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_LONG).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
