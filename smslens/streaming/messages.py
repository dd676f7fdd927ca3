"""Incremental reads of message folders and running results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from smslens.functions.text import normalize_text
from smslens.operators.extract import extract_templates
from smslens.sources.messages import delivered_only


def stream_messages(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, delivered: bool = True) -> DataFrame:
    """New parquet files of a folder as a stream; bounded batches when files_per_batch is given."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(path)
    return delivered_only(rows) if delivered else rows


def stream_templates(messages: DataFrame, rules=None) -> DataFrame:
    """Template columns for a stream of raw messages."""
    return extract_templates(messages.withColumn("cleaned_message", normalize_text("Message")), rules=rules)


def running_template_counts(messages: DataFrame, rules=None) -> DataFrame:
    """Count, first and last arrival per template over everything seen so far (fixed-width state)."""
    return (
        stream_templates(messages, rules)
        .groupBy("template_id", "template_text")
        .agg(F.count(F.lit(1)).alias("frequency"), F.min("ArrivalDate").alias("first_seen"), F.max("ArrivalDate").alias("last_seen"))
    )


def running_message_counts(messages: DataFrame, *columns: str) -> DataFrame:
    """Running counts per value of the given columns."""
    return messages.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("messages"))


def first_sightings(templated: DataFrame, watermark: str | None = None) -> DataFrame:
    """Each template id once, when it first appears.

    With a watermark an id is forgotten once it has not appeared for that long, which bounds the state.
    """
    rows = templated.select("template_id", "template_text", "applied_rules", "ArrivalDate")
    if watermark:
        timed = rows.withColumn("event_time", F.col("ArrivalDate").cast("timestamp")).withWatermark("event_time", watermark)
        return timed.dropDuplicatesWithinWatermark(["template_id"]).drop("event_time")
    return rows.dropDuplicates(["template_id"])


#: Batches of one generation; the first batch of the next one rewrites what is current.
BATCHES_KEPT = 100


def _folder(path: str, batch_id: int, every: int) -> str:
    return f"{path}/gen={batch_id // every:09d}/batch={batch_id:09d}"


def _generation(spark: SparkSession, path: str, gen: int | None = None) -> DataFrame | None:
    """Rows of one generation (default: the last), with their batch; none if nothing is written yet."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:  # the first batch finds no folder
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    gen = rows.agg(F.max("gen")).first()[0] if gen is None else gen
    return None if gen is None else rows.where(F.col("gen") == gen).drop("gen")


def _forget(spark: SparkSession, path: str, gen: int) -> None:
    """Delete a generation that no reader or repeated batch needs any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/gen={gen:09d}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _latest(rows: DataFrame, keys) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")


def write_running(result: DataFrame, path: str, checkpoint: str, keys=("template_id", "template_text"), kept: int = BATCHES_KEPT) -> StreamingQuery:
    """Write the groups each batch changed to their own folder; process what is there, then stop.

    A repeated batch rewrites its own folder.  Every ``kept`` batches the current row of every group is written anew
    and the generation before the last is deleted, so history holds two generations at most.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        rows, gen = batch, batch_id // kept
        if gen and batch_id % kept == 0:
            before = _generation(batch.sparkSession, path, gen - 1)
            if before is not None:
                now = batch.withColumn("batch", F.lit(batch_id)).select(*before.columns)
                rows = _latest(before.unionByName(now), keys)
        rows.write.mode("overwrite").parquet(_folder(path, batch_id, kept))
        if gen > 1 and batch_id % kept == 0:
            _forget(batch.sparkSession, path, gen - 2)

    return result.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_running(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The current row of every group written by ``write_running``."""
    rows = _generation(spark, path)
    if rows is None:
        raise FileNotFoundError(path)
    return _latest(rows, keys)


def write_first_sightings(templated: DataFrame, path: str, checkpoint: str, kept: int = BATCHES_KEPT) -> StreamingQuery:
    """Each template once, with its first arrival in the batch that brought it; process what is there, then stop.

    A batch collapses to one row per template in every task before anything is shuffled, so a template that holds a
    third of the messages leaves each task once.  Known ids are those written so far; a repeated batch rewrites its own folder.
    Every ``kept`` batches the known templates are written as one folder.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, gen = batch.sparkSession, batch_id // kept
        # strings as keys, fixed-width values: a hash aggregation with a map-side part
        rows = batch.groupBy("template_id", "template_text", "applied_rules").agg(F.min("ArrivalDate").alias("ArrivalDate"))
        first = F.struct("ArrivalDate", "template_text", "applied_rules")
        fresh = rows.groupBy("template_id").agg(F.min(first).alias("f")).select("template_id", "f.template_text", "f.applied_rules", "f.ArrivalDate")
        turn = gen > 0 and batch_id % kept == 0
        before = _generation(spark, path, gen - 1 if turn else gen)
        before = None if before is None else before.where(F.col("batch") < batch_id)
        new = fresh if before is None else fresh.join(before.select("template_id"), "template_id", "left_anti")
        whole = before.select(*new.columns).unionByName(new) if turn and before is not None else new
        whole.write.mode("overwrite").parquet(_folder(path, batch_id, kept))
        if gen > 1 and turn:
            _forget(spark, path, gen - 2)

    return templated.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def known_sightings(spark: SparkSession, path: str) -> DataFrame:
    """All templates written by ``write_first_sightings``."""
    rows = _generation(spark, path)
    if rows is None:
        raise FileNotFoundError(path)
    return rows.drop("batch")


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once; process what is there, then stop."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
