"""Readers and writers: CSV inventories and catalogs by position, results, review sheets, health reports."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import vocab as V
from weftline.functions.pricing import parsed_price
from weftline.sources.scratch import written

PUBLIC = ("code", "drug_name", "matched_product_name_en", "matched_product_name_ar", "matched_store_product_id", "match_score", "verified", "match_method", "ai_confidence", "ai_review_confidence")
REVIEW_BLANKS = ("manual_decision", "manual_reason", "correct_store_product_id")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """df as a written table in the shared folder."""
    return written(df, name)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, quotes doubled inside quotes, a byte order mark dropped, NA tokens as null."""
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
    return raw.select(*(F.when(~F.col(f"`{c}`").isin(*V.NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in raw.columns))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df with a contiguous row number from 0 in its own order: per-partition counts and offsets, no global sort."""
    rows = scratch(df.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()), name)
    sizes = rows.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    base = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_p", "_first", base.alias("_base"))  # a row for each partition
    # ids of a partition are consecutive, so the place within it is a difference
    return rows.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_base") + F.col("_i") - F.col("_first")).drop("_p", "_i", "_first", "_base")


def price_column(columns: Iterable[str]) -> str | None:
    """The first column with a price's name, else the fifth column."""
    columns = list(columns)
    named = [c for c in columns if c.strip().lower() in V.PRICE_COLUMNS]
    return named[0] if named else columns[4] if len(columns) >= 5 else None


def inventory(df: DataFrame) -> DataFrame:
    """row_index, code, drug_name, drug_price by position. A null name reads 'nan', as text of a missing value."""
    cols = [F.col(f"`{c}`") for c in df.columns if c != "row_index"]
    price = cols[2] if len(cols) > 2 else F.lit(None).cast("string")
    return df.select("row_index", cols[0].cast("string").alias("code"), F.coalesce(cols[1].cast("string"), F.lit("nan")).alias("drug_name"), price.cast("string").alias("drug_price"))


def catalog(df: DataFrame) -> DataFrame:
    """idx, product_name_ar, product_name_en, store_product_id, price by position; the price by name or place."""
    names = [c for c in df.columns if c != "idx"]
    cols = [F.col(f"`{c}`") for c in names]
    price = price_column(names)
    parsed = parsed_price(F.col(f"`{price}`")) if price else F.lit(None).cast("double")
    return df.select("idx", cols[0].cast("string").alias("product_name_ar"), F.coalesce(cols[1].cast("string"), F.lit("")).alias("product_name_en"), cols[2].cast("string").alias("store_product_id"), parsed.alias("price"))


def row_slice(df: DataFrame, start: int = 0, end: int = 0, limit: int = 0) -> DataFrame:
    """Rows [start, end) by row_index, at most limit; 0 means no end and no limit."""
    stop = [x for x in (end or None, start + limit if limit else None) if x]
    out = df.where(F.col("row_index") >= start)
    return out.where(F.col("row_index") < min(stop)) if stop else out


def public(results: DataFrame) -> DataFrame:
    """Without internal columns, which begin with an underscore."""
    return results.select(*(c for c in results.columns if not c.startswith("_") and c != "row_index"))


def write_results(results: DataFrame, path: str) -> None:
    public(results).write.mode("overwrite").parquet(path)


def with_mark(df: DataFrame) -> DataFrame:
    """df with a byte order mark before its first header, from which spreadsheets know UTF-8."""
    return df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])


def write_sheet(results: DataFrame, path: str) -> None:
    """For people: one CSV file, blanks for missing values."""
    with_mark(public(results).na.fill("")).coalesce(1).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def manual_review(results: DataFrame, verify_threshold: float) -> DataFrame:
    """Unmatched, weakly matched and component-flagged rows, with three columns for a person to fill."""
    matched = F.coalesce(F.col("matched_product_name_en"), F.lit("")) != ""
    weak = matched & (F.coalesce(F.col("match_score"), F.lit(0.0)) < verify_threshold)
    flagged = F.coalesce(F.col("_ai_component_reason"), F.lit("")) != "" if "_ai_component_reason" in results.columns else F.lit(False)
    return results.where(~matched | weak | flagged).withColumns({c: F.lit("") for c in REVIEW_BLANKS})


def write_health(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def read_health(spark: SparkSession, path: str, schema: T.StructType, oldest: Column) -> DataFrame:
    """Reports from files modified at `oldest` or later."""
    rows = spark.read.schema(schema).json(path).select("*", F.col("_metadata.file_modification_time").alias("_at"))
    return rows.where(F.col("_at") >= oldest).drop("_at")


def save_progress(path: str, last_end: int, total: int, start: int) -> None:
    """A few numbers on the driver; streaming.resume does the same with a checkpoint."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"last_end": last_end, "total_loaded": total, "start": start}, f)


def load_progress(path: str) -> dict:
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (FileNotFoundError, json.JSONDecodeError):
        return {}
