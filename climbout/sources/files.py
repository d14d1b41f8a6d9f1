"""Readers: the chart metafile (XML), facility tables (CSV, also inside zip archives), page texts, issues."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()


def _attr(*names: str) -> list[T.StructField]:
    return [T.StructField(f"_{n}", _S) for n in names]


_RECORD = T.StructType([T.StructField(n, _S) for n in ("chart_code", "chart_name", "pdf_name")])
_AIRPORT = T.StructType([*_attr("ID", "military", "apt_ident", "icao_ident", "alnum"), T.StructField("record", T.ArrayType(_RECORD))])
_CITY = T.StructType([*_attr("ID", "volume"), T.StructField("airport_name", T.ArrayType(_AIRPORT))])
#: Explicit, so that a single child is still an array; the row is the ancestor that carries the state.
STATE = T.StructType([*_attr("ID", "state_fullname"), T.StructField("city_name", T.ArrayType(_CITY))])


def metafile(spark: SparkSession, path: str) -> DataFrame:
    """(lid, icao, name, city, state, volume, pdf_name) of the airports with a takeoff-minimums chart.

    Of rows for one lid the last in the file wins; an empty ICAO id is null.
    """
    rows = spark.read.format("xml").option("rowTag", "state_code").schema(STATE).load(path)
    rows = rows.select(F.monotonically_increasing_id().alias("s"), F.col("_ID").alias("state"), F.posexplode("city_name").alias("c", "city"))
    rows = rows.select("s", "state", "c", F.col("city._ID").alias("city"), F.posexplode("city.airport_name").alias("a", "airport"))
    chart = F.filter("airport.record", lambda r: (r["chart_code"] == "MIN") & (r["chart_name"] == "TAKEOFF MINIMUMS") & r["pdf_name"].endswith("TO.PDF"))
    rows = rows.select("s", "c", "a", F.col("airport._apt_ident").alias("lid"), F.nullif("airport._icao_ident", F.lit("")).alias("icao"), F.col("airport._ID").alias("name"), "city", "state", F.try_element_at(chart, F.lit(1))["pdf_name"].alias("pdf_name"))
    rows = rows.where("pdf_name is not null").withColumn("volume", F.regexp_replace("pdf_name", r"TO\.PDF\z", ""))
    last = rows.groupBy("lid").agg(F.max_by(F.struct("icao", "name", "city", "state", "volume", "pdf_name"), F.struct("s", "c", "a")).alias("x"))
    return last.select("lid", "x.*")


def zipped_csv(spark: SparkSession, path: str, member: str, columns: list[str]) -> DataFrame:
    """The named columns of a CSV member of the zip archives at path, all as strings."""
    schema = T.StructType([T.StructField(c, _S) for c in columns])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open(member) as rows:
                    for part in pd.read_csv(rows, dtype=str, keep_default_na=False, usecols=columns, chunksize=20_000):
                        yield part[columns]

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, schema)


def pages(spark: SparkSession, path: str) -> DataFrame:
    """(volume, page, text) of text files, one per volume, pages separated by form feeds."""
    texts = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/.]+)\.[^/]*\z", 1).alias("volume"), "value")
    return texts.select("volume", F.posexplode(F.split("value", "\f")).alias("at", "text")).select("volume", (F.col("at") + 1).alias("page"), "text")


def open_issues(spark: SparkSession, path: str, marker: str = r"<!-- key: ([0-9a-f]{40}) -->") -> DataFrame:
    """(key, number, title, body) of issues that carry the marker."""
    rows = spark.read.schema("number int, title string, body string").json(path, multiLine=True)
    return rows.select(F.nullif(F.regexp_extract("body", marker, 1), F.lit("")).alias("key"), "number", "title", "body").where("key is not null")
