"""Landed weather responses: good rows, and bodies that could not be used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidemark.functions.scalars import blank_as, to_day, to_number

# The feed's result code and station ids.
GOOD_RESULT = "00"
STATIONS = {"108": "Region_A", "112": "Region_B", "119": "Region_C", "98": "Region_D"}


def _texts(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


RESPONSE_SCHEMA = StructType(
    [
        StructField(
            "response",
            StructType(
                [
                    StructField("header", _texts("resultCode", "resultMsg")),
                    StructField(
                        "body",
                        StructType(
                            [
                                StructField(
                                    "items",
                                    StructType(
                                        [StructField("item", ArrayType(_texts("tm", "avgTa", "sumRn", "max1hrRn")))]
                                    ),
                                )
                            ]
                        ),
                    ),
                ]
            ),
        ),
        StructField("_corrupt", StringType()),
    ]
)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landed files, one response per file, with the station taken from the folder.

    ``path`` holds ``station_id=<id>/`` folders; all years and stations are one read.
    """
    return (
        spark.read.option("basePath", path)
        .text(path, wholetext=True)
        .select(F.col("station_id").cast("string").alias("station_id"), F.col("value").alias("raw"))
    )


def parse_responses(raw: DataFrame) -> DataFrame:
    """Add the parsed body and a status: ``ok``, ``not_json`` or ``error_code``."""
    body = F.from_json("raw", RESPONSE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # As a generator's input the parse stays one: the optimizer copies a plain column into every place that reads it.
    parsed = raw.select("*", F.explode(F.array(body)).alias("parsed"))
    code = F.col("parsed.response.header.resultCode")
    broken = F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull()
    return parsed.withColumn(
        "status",
        F.when(broken, "not_json").when(code.eqNullSafe(GOOD_RESULT), "ok").otherwise("error_code"),
    )


def quarantined(responses: DataFrame) -> DataFrame:
    """Unusable responses whole, with a short reason for the run report."""
    code = F.col("parsed.response.header.resultCode")
    detail = F.when(F.col("status") == "not_json", F.substring("raw", 1, 200)).otherwise(
        F.concat_ws(": ", code, F.col("parsed.response.header.resultMsg"))
    )
    keep = [c for c in responses.columns if c not in ("parsed", "status")]
    return responses.where(F.col("status") != "ok").select(*keep, "status", detail.alias("detail"))


def daily_rows(responses: DataFrame, stations: dict[str, str] = STATIONS) -> DataFrame:
    """One row per station and day. Rain defaults to 0, temperature does not."""
    pairs = [F.lit(x) for item in stations.items() for x in item]
    region = F.try_element_at(F.create_map(*pairs), F.col("station_id"))
    return (
        responses.where(F.col("status") == "ok")
        .select(region.alias("region"), F.explode("parsed.response.body.items.item").alias("item"))
        .select(
            to_day("item.tm").alias("ds"),
            "region",
            to_number("item.avgTa").alias("avg_temp"),
            to_number(blank_as("item.sumRn", "0.0")).alias("rain_total"),
            to_number(blank_as("item.max1hrRn", "0.0")).alias("rain_max_1h"),
        )
    )


def sorted_weather(daily: DataFrame) -> DataFrame:
    return daily.orderBy("ds", "region")
