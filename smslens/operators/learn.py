"""Text classifier on labelled templates (levels 2 and 3): training set, confusion, thresholds, submodels, saved models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from smslens.functions.labels import label_category
from smslens.session import shared_folder


def training_rows(classified: DataFrame, min_confidence: float = 0.8) -> DataFrame:
    """Labelled templates at or above a confidence."""
    return classified.where((F.trim("label") != "") & (F.col("confidence") >= min_confidence))


def training_readiness(classified: DataFrame, min_confidence: float = 0.8, min_examples: int = 500) -> DataFrame:
    """Examples per label and whether there are enough."""
    counts = training_rows(classified, min_confidence).groupBy("label").agg(F.count(F.lit(1)).alias("examples"))
    return counts.withColumn("ready", F.col("examples") >= min_examples)


def fit_text_classifier(rows: DataFrame, text_col: str = "template_text", label_col: str = "label", features: int = 1 << 16) -> PipelineModel:
    """Flat classifier over all labels: hashed words, inverse document frequency, logistic regression.

    Every stage reads all rows, so the texts are hashed once and the stages are fitted on the stored word counts.
    """
    tokens, counts = Tokenizer(inputCol=text_col, outputCol="words"), HashingTF(inputCol="words", outputCol="tf", numFeatures=features)
    shared_folder(rows.sparkSession)
    hashed = counts.transform(tokens.transform(rows.select(label_col, text_col))).select(label_col, "tf").checkpoint()
    index = StringIndexer(inputCol=label_col, outputCol="label_index", stringOrderType="alphabetAsc").fit(hashed)
    idf = IDF(inputCol="tf", outputCol="features").fit(hashed)
    fitted = LogisticRegression(featuresCol="features", labelCol="label_index", maxIter=30, regParam=0.01).fit(idf.transform(index.transform(hashed)))
    return PipelineModel(stages=[index, tokens, counts, idf, fitted])


def predict_labels(model: PipelineModel, rows: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Add predicted_label, prediction_confidence and accepted (confidence at or above the threshold)."""
    scorer = PipelineModel(stages=list(model.stages[1:]))
    names = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=model.stages[0].labels)
    scored = names.transform(scorer.transform(rows))
    confidence = F.array_max(vector_to_array("probability"))
    return scored.select(
        *[F.col(f"`{c}`") for c in rows.columns], "predicted_label", confidence.alias("prediction_confidence"),
        (confidence >= threshold).alias("accepted"),
    )


def confusion(predictions: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per (label, predicted_label)."""
    return predictions.groupBy(F.col(label_col).alias("label"), "predicted_label").agg(F.count(F.lit(1)).alias("rows"))


def submodel_categories(confusions: DataFrame, min_rate: float = 0.2) -> DataFrame:
    """Per category: rows, rows confused inside the category, their rate, and whether a submodel pays."""
    true, predicted = label_category("label"), label_category("predicted_label")
    inside = (true == predicted) & (F.col("label") != F.col("predicted_label"))
    sums = confusions.groupBy(true.alias("category")).agg(
        F.sum("rows").alias("rows"), F.coalesce(F.sum(F.when(inside, F.col("rows"))), F.lit(0)).alias("confused_inside")
    )
    rate = F.col("confused_inside").cast("double") / F.col("rows")
    return sums.withColumn("confusion_rate", rate).withColumn("needs_submodel", rate >= min_rate)


def text_features(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with the flat model's features."""
    return PipelineModel(stages=list(model.stages[1:-1])).transform(rows)


def fit_submodels(model: PipelineModel, rows: DataFrame, categories: list[str], label_col: str = "label") -> DataFrame:
    """(category, feature, labels, weights): one classifier per listed category, over the flat model's features.

    Each is fitted on its category's labels alone.  All are one table: a row per category and feature with a weight per
    label of the category (feature -1 holds the intercepts), so that scoring is one join.  A category with a
    single label has that label with weight 0.  Rows: categories times used features, bounded by the feature count.
    """
    spark = rows.sparkSession
    featured = text_features(model, rows).select(F.col(label_col).alias("label"), "features")
    out = []
    for category in categories:
        mine = featured.where(label_category("label") == category)
        names = [r.label for r in mine.select("label").distinct().orderBy("label").collect()]  # labels of one category
        if not names:
            continue
        if len(names) == 1:
            out.append((category, -1, names, [0.0]))
            continue
        indexed = StringIndexer(inputCol="label", outputCol="label_index", stringOrderType="alphabetAsc").fit(mine).transform(mine)
        fitted = LogisticRegression(featuresCol="features", labelCol="label_index", maxIter=30, regParam=0.01, family="multinomial").fit(indexed)
        weights = fitted.coefficientMatrix.toArray()
        out.append((category, -1, names, fitted.interceptVector.toArray().tolist()))
        out += [(category, int(f), names, weights[:, f].tolist()) for f in weights.any(axis=0).nonzero()[0]]
    return spark.createDataFrame(out, "category string, feature int, labels array<string>, weights array<double>")


def predict_submodels(model: PipelineModel, submodels: DataFrame, rows: DataFrame, category_col: str, id_col: str = "template_id") -> DataFrame:
    """(id, predicted_label, prediction_confidence) of rows whose category has a submodel, all submodels in one pass.

    A row's features meet its own category's weights in a join; the sums per label go through a softmax.  Ids are
    unique.  Ties go to the label that comes first.
    """
    featured = text_features(model, rows.where(F.col(category_col).isNotNull())).select(F.col(id_col).alias("id"), F.col(category_col).alias("category"), "features")
    arrays = F.struct(F.lit(-1).alias("feature"), F.lit(1.0).alias("value"))
    pairs = featured.select("id", "category", F.explode(F.concat(F.array(arrays), _nonzeros("features"))).alias("f")).select("id", "category", "f.*")
    products = pairs.join(submodels, ["category", "feature"]).select("id", "labels", "value", F.posexplode("weights").alias("at", "weight"))
    sums = products.groupBy("id", "at", F.get("labels", F.col("at")).alias("label")).agg(F.sum(F.col("value") * F.col("weight")).alias("margin"))
    listed = sums.groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("margin")).alias("m"), "label"))).alias("s"))  # labels of one category
    top = F.col("s")[0]
    total = F.aggregate("s", F.lit(0.0), lambda acc, x: acc + F.exp(top["m"] - x["m"]))
    return listed.select(F.col("id").alias(id_col), top["label"].alias("predicted_label"), (1.0 / total).alias("prediction_confidence"))


def _nonzeros(column: str) -> Column:
    """array<struct<feature, value>> of a sparse or dense vector column's entries."""
    values = vector_to_array(F.col(column))
    entries = F.transform(values, lambda v, i: F.struct(i.alias("feature"), v.alias("value")))
    return F.filter(entries, lambda e: e["value"] != 0.0)


def label_cuts(curve: DataFrame, min_precision: float = 0.9, min_predicted: int = 1) -> DataFrame:
    """Per label the smallest threshold from which on its precision holds, with precision and recall there.

    It has to hold at that threshold and at every higher one that still has ``min_predicted`` predictions.  A label
    whose precision never holds has no row.
    """
    seen = curve.where(F.col("predicted") >= min_predicted)
    above = Window.partitionBy("label").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)  # `steps` rows
    held = seen.withColumn("least", F.min("precision").over(above)).where(F.col("least") >= min_precision)
    first = held.groupBy("label").agg(F.min(F.struct("threshold", "precision", "recall")).alias("c"))
    return first.select("label", F.col("c.threshold").alias("cut"), F.col("c.precision").alias("precision"), F.col("c.recall").alias("recall"))


def accept_by_cut(predictions: DataFrame, cuts: DataFrame, steps: int = 20) -> DataFrame:
    """``accepted`` by each predicted label's own cut instead of one threshold; labels without a cut are not accepted.

    Confidences are compared in the curve's steps.
    """
    step = F.least(F.floor(F.col("prediction_confidence") * steps), F.lit(steps - 1)) / F.lit(float(steps))
    limits = F.broadcast(cuts.select(F.col("label").alias("predicted_label"), "cut"))  # one row a label of the taxonomy
    joined = predictions.drop("accepted").join(limits, "predicted_label", "left")
    return joined.withColumn("accepted", F.coalesce(step >= F.col("cut"), F.lit(False))).drop("cut")


@dataclass
class CascadeModel:
    """Levels 2 and 3: a flat classifier with a cut per label, a router over categories and submodels for some of them."""

    flat: PipelineModel
    router: PipelineModel
    submodels: DataFrame
    cuts: DataFrame
    submodel_threshold: float = 0.7

    def save(self, path: str) -> None:
        """Write every part under ``path``, in a folder all executors share."""
        self.flat.write().overwrite().save(f"{path}/flat")
        self.router.write().overwrite().save(f"{path}/router")
        self.submodels.write.mode("overwrite").parquet(f"{path}/submodels")
        self.cuts.withColumn("submodel_threshold", F.lit(self.submodel_threshold)).write.mode("overwrite").parquet(f"{path}/cuts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> CascadeModel:
        cuts = spark.read.parquet(f"{path}/cuts")
        first = cuts.select("submodel_threshold").first()
        return CascadeModel(
            PipelineModel.load(f"{path}/flat"), PipelineModel.load(f"{path}/router"), spark.read.parquet(f"{path}/submodels"),
            cuts.drop("submodel_threshold"), first[0] if first else 0.7,
        )

    def predict(self, rows: DataFrame) -> DataFrame:
        """rows (template_id, template_text, ...) plus predicted_label, prediction_confidence, level (l2 / l3), accepted.

        The router's category decides: one with a submodel goes there and is accepted from submodel_threshold on;
        other rows keep the flat label and need its cut.  template_id has to be unique and not null.
        """
        flat = accept_by_cut(predict_labels(self.flat, rows), self.cuts)
        routed = predict_labels(self.router, rows).select("template_id", F.col("predicted_label").alias("__category"))
        owned = self.submodels.select(F.col("category").alias("__category")).distinct()
        routed = routed.join(F.broadcast(owned), "__category")
        sub = predict_submodels(self.flat, self.submodels, rows.join(routed, "template_id"), "__category")
        sub = sub.select("template_id", F.col("predicted_label").alias("__label"), F.col("prediction_confidence").alias("__confidence"))
        by = F.col("__label").isNotNull()
        return flat.join(sub, "template_id", "left").select(
            *[F.col(f"`{c}`") for c in rows.columns],
            F.coalesce("__label", "predicted_label").alias("predicted_label"),
            F.coalesce("__confidence", "prediction_confidence").alias("prediction_confidence"),
            F.when(by, F.lit("l3")).otherwise(F.lit("l2")).alias("level"),
            F.when(by, F.col("__confidence") >= self.submodel_threshold).otherwise(F.col("accepted")).alias("accepted"),
        )


def fit_cascade(
    rows: DataFrame, held_out: DataFrame, min_precision: float = 0.9, min_confusion: float = 0.2, submodel_threshold: float = 0.7, features: int = 1 << 14
) -> CascadeModel:
    """Fit on labelled rows (template_text, label); cuts and confused categories come from ``held_out`` rows."""
    flat = fit_text_classifier(rows, features=features)
    router = fit_text_classifier(rows.withColumn("label", label_category("label")), features=features)
    judged = predict_labels(flat, held_out)
    shared_folder(rows.sparkSession)
    judged = judged.select("label", "predicted_label", "prediction_confidence").checkpoint()
    confused = submodel_categories(confusion(judged), min_confusion).where("needs_submodel")
    categories = [r.category for r in confused.select("category").orderBy("category").collect()]  # of the taxonomy
    cuts = label_cuts(threshold_curve(judged), min_precision).select("label", "cut").checkpoint()
    return CascadeModel(flat, router, fit_submodels(flat, rows, categories), cuts, submodel_threshold)


def threshold_curve(predictions: DataFrame, label_col: str = "label", steps: int = 20) -> DataFrame:
    """Precision and recall per predicted label at thresholds 0, 1/steps, ..., (steps-1)/steps.

    One aggregation into confidence steps, then running sums over at most ``steps`` rows per label.
    """
    step = F.least(F.floor(F.col("prediction_confidence") * steps), F.lit(steps - 1)).cast("int")
    hits = predictions.groupBy(F.col("predicted_label").alias("label"), step.alias("step")).agg(
        F.count(F.lit(1)).alias("predicted"), F.count_if(F.col(label_col) == F.col("predicted_label")).alias("correct")
    )
    actual = predictions.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("actual"))
    grid = hits.select("label").distinct().select("label", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
    filled = grid.join(hits, ["label", "step"], "left")
    above = Window.partitionBy("label").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    sums = filled.select(
        "label", "step",
        F.sum(F.coalesce("predicted", F.lit(0))).over(above).alias("predicted"),
        F.sum(F.coalesce("correct", F.lit(0))).over(above).alias("correct"),
    ).join(actual, "label", "left")
    return sums.select(
        "label", (F.col("step") / F.lit(float(steps))).alias("threshold"), "predicted", "correct",
        F.when(F.col("predicted") > 0, F.col("correct").cast("double") / F.col("predicted")).alias("precision"),
        F.when(F.col("actual") > 0, F.col("correct").cast("double") / F.col("actual")).otherwise(F.lit(0.0)).alias("recall"),
    )
