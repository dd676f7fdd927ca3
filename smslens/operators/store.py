"""The keyed table of classified templates: first insert wins, frequencies are updated in batches.

The pure functions take and return DataFrames.  ``TemplateStore`` keeps the table as parquet snapshots,
partitioned by the leading digits of the id so that lookups by id read one folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Column, type, not null, default - the layout of the table.
LAYOUT = (
    ("template_id", "string", True, None),
    ("template_text", "string", True, None),
    ("label", "string", True, None),
    ("category", "string", True, None),
    ("subcategory", "string", True, ""),
    ("confidence", "double", True, 0.0),
    ("level_used", "string", True, None),
    ("rule_name", "string", False, None),
    ("original_message", "string", False, None),
    ("cleaned_message", "string", False, None),
    ("client_name", "string", False, None),
    ("client_id", "bigint", False, None),
    ("phone_number", "string", False, None),
    ("operator_name", "string", False, None),
    ("account_name", "string", False, None),
    ("priority_description", "string", False, None),
    ("panel_judge_1", "string", False, None),
    ("panel_judge_1_conf", "double", False, None),
    ("panel_judge_2", "string", False, None),
    ("panel_judge_2_conf", "double", False, None),
    ("arbiter_label", "string", False, None),
    ("arbiter_reasoning", "string", False, None),
    ("arbiter_abstained", "boolean", False, False),
    ("needs_human_review", "boolean", True, False),
    ("frequency", "bigint", True, 1),
    ("applied_rules", "array<string>", False, None),
    ("timestamp_original", "timestamp_ntz", False, None),
    ("first_seen", "timestamp_ntz", False, None),
    ("last_seen", "timestamp_ntz", False, None),
    ("classified_at", "timestamp_ntz", True, None),
)
COLUMNS = [name for name, *_ in LAYOUT]
TABLE_SCHEMA = ", ".join(f"{n} {t}" for n, t, *_ in LAYOUT)


def conform(results: DataFrame) -> DataFrame:
    """Bring results to the table's columns and types: absent columns null, defaults applied.

    first_seen and last_seen start as classified_at.
    """
    present = set(results.columns)
    out = []
    for name, dtype, _, default in LAYOUT:
        source = "classified_at" if name in ("first_seen", "last_seen") else name
        c = F.col(f"`{source}`").cast(dtype) if source in present else F.lit(None).cast(dtype)
        out.append((F.coalesce(c, F.lit(default).cast(dtype)) if default is not None else c).alias(name))
    return results.select(*out)


def check_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected rows lack a value that may not be null."""
    missing = F.lit(False)
    for name, _, required, _ in LAYOUT:
        if required:
            missing = missing | F.col(name).isNull()
    return rows.where(~missing), rows.where(missing)


def new_rows(existing_ids: DataFrame, incoming: DataFrame, order_by: str = "classified_at") -> DataFrame:
    """The incoming rows that get inserted: the first per id, unless the id is already there.

    Ties on ``order_by`` go to the smaller label, then level.
    """
    absent = incoming.join(existing_ids.select("template_id"), "template_id", "left_anti")
    whole = F.struct(*[F.col(f"`{c}`") for c in incoming.columns])
    first = absent.groupBy("template_id").agg(F.min_by(whole, F.struct(order_by, "label", "level_used")).alias("r"))
    return first.select("r.*")


def upsert_first_wins(existing: DataFrame, incoming: DataFrame, order_by: str = "classified_at") -> DataFrame:
    """The table after inserting ``incoming``."""
    return existing.unionByName(new_rows(existing, incoming, order_by))


def frequency_deltas(seen: DataFrame) -> DataFrame:
    """Sightings (template_id, last_seen) reduced to one row per id."""
    return seen.groupBy("template_id").agg(F.count(F.lit(1)).alias("d_count"), F.max("last_seen").alias("d_last"))


def apply_frequency(existing: DataFrame, seen: DataFrame) -> DataFrame:
    """The table with every sighting counted and last_seen moved on; unknown ids change nothing."""
    deltas = frequency_deltas(seen)
    hit = F.col("d_count").isNotNull()
    columns = []
    for c in existing.columns:
        col = F.col(f"`{c}`")
        if c == "frequency":
            col = F.when(hit, col + F.col("d_count")).otherwise(col).alias(c)
        elif c == "last_seen":
            col = F.when(hit, F.col("d_last")).otherwise(col).alias(c)
        columns.append(col)
    return existing.join(deltas, "template_id", "left").select(*columns)


def get_template(table: DataFrame, template_id: str) -> DataFrame:
    return table.where(F.col("template_id") == template_id)


def query_by_level(table: DataFrame, level: str, limit: int = 100) -> DataFrame:
    """Newest first."""
    return table.where(F.col("level_used") == level).orderBy(F.desc("classified_at"), "template_id").limit(limit)


def query_by_confidence(table: DataFrame, low: float = 0.0, high: float = 1.0, limit: int = 100) -> DataFrame:
    """Lowest first; both ends included."""
    return table.where(F.col("confidence").between(low, high)).orderBy("confidence", "template_id").limit(limit)


def query_by_client(table: DataFrame, client_name: str, limit: int = 100) -> DataFrame:
    return table.where(F.col("client_name") == client_name).orderBy(F.desc("classified_at"), "template_id").limit(limit)


def query_needing_review(table: DataFrame, limit: int = 100) -> DataFrame:
    return table.where("needs_human_review").orderBy(F.desc("classified_at"), "template_id").limit(limit)


def stats_by_level(table: DataFrame) -> DataFrame:
    return table.groupBy("level_used").agg(F.count(F.lit(1)).alias("templates"), F.avg("confidence").alias("avg_confidence"))


def export_csv(table: DataFrame, path: str, limit: int = 10_000) -> None:
    """The first ``limit`` rows by id as CSV with header; arrays joined to text."""
    flat = table.select(
        *[F.array_join(F.col(f.name), ", ").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in table.schema.fields]
    )
    flat.orderBy("template_id").limit(limit).write.mode("overwrite").option("header", "true").csv(path)


@dataclass
class TemplateStore:
    """Parquet parts ``root/data/v=N`` and a log ``root/commits`` of the finished ones.

    An insert adds a part with only the new rows; counting sightings writes a whole new table.  A part
    counts only once its line is in the log, so a writer that dies leaves the previous state readable.
    One writer at a time.
    """

    spark: SparkSession
    root: str
    id_digits: int = 1

    def _commits(self) -> list:
        """Log lines, one per batch ever written."""
        try:
            return self.spark.read.schema("version bigint, batch string, whole boolean").json(f"{self.root}/commits").collect()
        except Exception as e:  # the first use finds no log
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def version(self) -> int:
        return max((c.version for c in self._commits()), default=-1)

    def has_batch(self, batch: str) -> bool:
        return any(c.batch == batch for c in self._commits())

    def _rows(self) -> DataFrame:
        """The parts since the last whole table."""
        log = self._commits()
        start = max((c.version for c in log if c.whole), default=0)
        parts = [c.version for c in log if c.version >= start]
        if not parts:
            return self.spark.createDataFrame([], f"{TABLE_SCHEMA}, id_prefix string, v bigint")
        data = self.spark.read.schema(f"{TABLE_SCHEMA}, v bigint, id_prefix string").parquet(f"{self.root}/data")
        return data.where(F.col("v").isin(parts))

    def table(self) -> DataFrame:
        return self._rows().select(*COLUMNS)

    def get(self, template_id: str) -> DataFrame:
        """One row or none; reads one folder of each part."""
        rows = self._rows().where(F.col("id_prefix") == template_id[: self.id_digits])
        return get_template(rows, template_id).select(*COLUMNS)

    def _publish(self, rows: DataFrame, batch: str, whole: bool) -> int:
        version = self.version() + 1
        keyed = rows.withColumn("id_prefix", F.substring("template_id", 1, self.id_digits))
        # Ids are hash values, so ranges of ids are even; sorting inside by level keeps its min/max narrow.
        (
            keyed.repartitionByRange("id_prefix", "template_id")
            .sortWithinPartitions("id_prefix", "level_used", "template_id")
            .write.mode("overwrite")
            .partitionBy("id_prefix")
            .parquet(f"{self.root}/data/v={version}")
        )
        line = self.spark.createDataFrame([(version, batch, whole)], "version bigint, batch string, whole boolean")
        line.coalesce(1).write.mode("append").json(f"{self.root}/commits")
        return version

    def insert(self, results: DataFrame, batch: str) -> int:
        """Insert results whose id is absent; a batch already in the log is skipped.  Returns the version."""
        if self.has_batch(batch):
            return self.version()
        accepted, _ = check_rows(conform(results))
        return self._publish(new_rows(self.table(), accepted), batch, whole=self.version() < 0)

    def count_sightings(self, seen: DataFrame, batch: str) -> int:
        """Apply sightings to the whole table; also merges the parts inserted since the last time."""
        if self.has_batch(batch):
            return self.version()
        return self._publish(apply_frequency(self.table(), seen), batch, whole=True)
