"""Dimension inputs: classification CSV, taxonomy, phone lists."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession, functions as F

from smslens.functions.text import clean_string
from smslens.functions.vocabulary import TAXONOMY_LABELS

EXPORT_HEADERS = (  # fixed values: headers of the exported CSV
    "ID Plantilla", "Plantilla (Template)", "Etiqueta (Label)", "Categoría", "Subcategoría",
    "Regla Usada", "Frecuencia", "Confianza", "Reglas Aplicadas (Regex)",
)


def plain_header(name: str) -> str:
    """Lower case, blanks to underscores, accents off."""
    flat = unicodedata.normalize("NFD", name.lower().replace(" ", "_"))
    return "".join(ch for ch in flat if not unicodedata.combining(ch))


def _find(columns: list[str], test, what: str | None) -> str | None:
    for c in columns:
        if test(plain_header(c)):
            return c
    if what:
        raise KeyError(f"no column for {what} among {columns}")
    return None


def classification_lookup(rows: DataFrame, order_by: str | None = None) -> DataFrame:
    """One row per template id with categoria, subcategoria and label; the last duplicate wins.

    "Last" is by ``order_by``; without it by the order in which Spark numbers the rows of the input.
    Blank categories become 'unknown'.
    """
    cols = [c for c in rows.columns if c != order_by]
    key = _find(cols, lambda c: "id" in c and "plantilla" in c, "the template id")
    cat = _find(cols, lambda c: "categoria" in c and "subcategoria" not in c, "the category")
    sub = _find(cols, lambda c: "subcategoria" in c, "the subcategory")
    label = _find(cols, lambda c: "etiqueta" in c or "label" in c, None)

    def known(name: str):
        return F.coalesce(clean_string(F.col(f"`{name}`")), F.lit("unknown"))

    ordinal = F.col(order_by) if order_by else F.monotonically_increasing_id()
    values = F.struct(
        known(cat).alias("categoria"),
        known(sub).alias("subcategoria"),
        (F.col(f"`{label}`").cast("string") if label else F.lit(None).cast("string")).alias("label"),
    )
    picked = rows.select(F.col(f"`{key}`").cast("string").alias("template_id"), values.alias("v"), ordinal.alias("o"))
    return picked.groupBy("template_id").agg(F.max_by("v", "o").alias("v")).select("template_id", "v.*")


def read_classification_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported CSV (any accent or case in its headers) as a lookup.

    Of duplicates the last one wins, by file name and then place in the file; a file is read by one task, since its
    values may hold line breaks.
    """
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    place = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id().alias("row"))
    return classification_lookup(rows.select("*", place.alias("_place")), "_place")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """label, description, category, subcategory from the taxonomy JSON."""
    raw = spark.read.option("multiLine", "true").json(path)
    item = raw.select(F.explode("labels").alias("l")).select("l.label", "l.description")
    parts = F.split("label", "::")
    return item.withColumn("category", F.get(parts, F.lit(0))).withColumn("subcategory", F.get(parts, F.lit(1)))


def default_taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(x, *x.split("::")) for x in TAXONOMY_LABELS], "label string, category string, subcategory string"
    )


def phone_requests(spark: SparkSession, path: str | None = None, phones=()) -> DataFrame:
    """Requested phones with their place in the request; arguments follow the file's lines.

    Blank entries are dropped.  The list itself comes from an operator, not from data.
    """
    parts = []
    if path is not None:
        lines = spark.read.text(path).select(
            F.monotonically_increasing_id().alias("ordinal"), F.trim("value").alias("phone_number")
        )
        parts.append(lines)
    listed = [(2**62 + i, p.strip()) for i, p in enumerate(phones)]
    parts.append(spark.createDataFrame(listed, "ordinal bigint, phone_number string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("phone_number") != "")
