"""Classification of a stream of templates into the result log and the keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from smslens.operators.cascade import cascade
from smslens.operators.classify import classify_rules
from smslens.operators.store import TemplateStore
from smslens.operators.votes import DEFAULT_THRESHOLD, resolve_votes
from smslens.sources.jsonl import JSON_TIMES


def as_results(resolved: DataFrame, classified_at: str) -> DataFrame:
    """Resolved templates as rows of the result log."""
    return resolved.withColumn("classified_at", F.lit(classified_at)).withColumn("is_synthetic", F.lit(False))


def classify_stream(
    templates: DataFrame, votes: DataFrame, arbiter: DataFrame, store: TemplateStore, log_path: str, checkpoint: str,
    classified_at: str, threshold: float = DEFAULT_THRESHOLD, rules=None, model=None, similar: bool = False,
) -> StreamingQuery:
    """Resolve each micro-batch, write its part of the log, then insert it into the table.

    With ``similar``, templates that no rule labels take the label of a similar one in the table as it is when the
    batch starts; ``model`` (a ``learn.CascadeModel``) labels what is left before the judges' votes count.

    Both writes are keyed by batch id: a repeated batch rewrites its log folder and is skipped by the table.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        known = store.table() if similar else None
        done = as_results(resolve_votes(cascade(classify_rules(batch, rules), known, model=model), votes, arbiter, threshold), classified_at)
        part = f"{log_path}/batch={batch_id:09d}"
        done.write.mode("overwrite").options(**JSON_TIMES).json(part)
        written = batch.sparkSession.read.schema(done.schema).json(part)
        store.insert(written, f"stream-{batch_id}")

    return templates.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
