"""Resumable matching: new inventory files stream against a static catalog; the checkpoint remembers what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weftline.operators.config import Matching
from weftline.operators.matching import match
from weftline.sources.scratch import collected, delete

INVENTORY = T.StructType([T.StructField("row_index", T.LongType()), T.StructField("code", T.StringType()), T.StructField("drug_name", T.StringType()), T.StructField("drug_price", T.StringType())])


def match_stream(spark: SparkSession, source: str, catalog: DataFrame, sink: str, checkpoint: str, cfg: Matching = Matching(), files_per_batch: int = 1, fuzzy: bool = True):
    """Match every inventory file under `source` once, in batches; returns the query when all present files are done.

    A batch writes its own folder under the sink, overwriting it if the batch is run again, so a restart after a
    failure neither loses nor doubles rows. Its scratch tables go when its folder is written.
    """

    def one(batch: DataFrame, number: int) -> None:
        with collected() as made:
            match(batch, catalog, cfg, fuzzy).write.mode("overwrite").parquet(f"{sink}/batch={number}")
            delete(spark, made)
            made.clear()

    stream = spark.readStream.schema(INVENTORY).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def matched_so_far(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop("batch")
