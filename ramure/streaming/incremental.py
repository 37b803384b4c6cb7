"""Scoring files as they arrive, each row once, safe to restart."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, LongType, StructField, StructType

from ramure.functions.text import DEFAULT_STOPWORDS, preprocess_text

#: Partition column of the sink that `score_new_keys` writes.
BATCH = "batch"


def clean_stream(spark: SparkSession, source: str, schema: StructType | str, text: str, words: Sequence[str] = DEFAULT_STOPWORDS,
                 max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream with clean texts; `max_files` bounds what one batch reads."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return preprocess_text(reader.parquet(source), text, words)


def score_incrementally(stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Score all files that arrived since the last run and append them to the parquet sink, then stop.

    The checkpoint remembers the files done and the sink the batches written, so a run after a failure neither loses
    nor repeats a row. `score` must be a row-wise transformation.
    """
    return (
        score(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def _written_keys(spark: SparkSession, sink: str, key: str, key_type: DataType, batch_id: int) -> DataFrame | None:
    """Keys that other batches have written, None as long as there is no sink; only the key's column is read."""
    schema = StructType([StructField(key, key_type), StructField(BATCH, LongType())])
    try:
        return spark.read.schema(schema).parquet(sink).where(F.col(BATCH) != batch_id).select(key)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_new_keys(batch: DataFrame, batch_id: int, score: Callable[[DataFrame], DataFrame], sink: str, key: str) -> None:
    """Score the rows of a batch whose key no other batch has written, into the batch's own partition of the sink.

    The partition is overwritten, so a batch that was killed and comes again leaves each key once. Of rows with the same key the
    least by its other columns counts. Rows without a key can't be told apart and are all kept.
    """
    others = [name for name in batch.columns if name != key]
    keyed = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("__row")).select(key, "__row.*")
    done = _written_keys(batch.sparkSession, sink, key, batch.schema[key].dataType, batch_id)
    fresh = keyed.join(done, key, "left_anti") if done is not None else keyed
    rows = fresh.unionByName(batch.where(F.col(key).isNull()))
    score(rows.select(*batch.columns)).write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch_id}")


def score_new_keys(stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, key: str = "id") -> StreamingQuery:
    """Score what arrived since the last run, each key once, then stop; `score` may be any batch plan that keeps the key.

    Unlike `score_incrementally`, it takes models that join, group or write tables, and keys that arrive again in later files are
    skipped. Every batch is a partition `batch={id}` of the sink; start a new checkpoint only with a new sink, as batch ids begin at 0.
    """
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: write_new_keys(batch, batch_id, score, sink, key))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
