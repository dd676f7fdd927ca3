"""Between the rules and the judges: labels of similar known templates, the text model and its submodels.

A template that no rule labels first takes the label of its nearest known template (few words changed, shared
n-grams, close vectors).  Known templates are kept as an index of keys, so new ones probe it and known ones
are not compared with each other again.  What is left goes to the flat text model (level ``l2``), and, where its
category is one that the flat model confuses inside, to that category's submodel (``l3``).  Only rows that no
level accepts stay ``pending``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from smslens.functions.labels import label_category, label_subcategory
from smslens.operators import similarity
from smslens.operators.similarity import id_number, id_text

LINK_SCHEMA = "template_id string, similar_id string, method string, score double"


# --- Similar known templates ------------------------------------------------------------------


def labelled(known: DataFrame) -> DataFrame:
    """Known templates that can give a label: template_id, template_text, sender, label, confidence."""
    sender = F.col("client_name") if "client_name" in known.columns else F.lit(None).cast("string")
    rows = known.select("template_id", "template_text", sender.alias("sender"), "label", "confidence")
    return rows.where("template_id is not null and trim(label) <> '' and label <> 'ERROR' and label <> 'ABSTAIN'")


def word_index(known: DataFrame, max_changed: int = 2) -> DataFrame:
    """(kind, k1, k2, m0, m1, m2): for every key of the known templates the smallest id of each role.

    Unique on the key, so a probe is a lookup; indexes of several days are merged with ``merge_word_index``.
    """
    keys = similarity._word_keys(known, max_changed)
    least = [F.min(F.when(F.col("left_out") == r, F.col("id"))).alias(f"m{r}") for r in range(3)]
    return keys.groupBy("kind", "k1", "k2").agg(*least)


def merge_word_index(*parts: DataFrame) -> DataFrame:
    """One index from several, of other days or other known templates."""
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("kind", "k1", "k2").agg(*[F.min(f"m{r}").alias(f"m{r}") for r in range(3)])


def probe_words(new: DataFrame, index: DataFrame, max_changed: int = 2) -> DataFrame:
    """Links of new templates (template_id, template_text, sender) to the nearest indexed one of the same sender.

    score is the number of words changed; a template that is indexed itself is not its own neighbour only if the
    index holds another one as near, so probe ids that are not known.
    """
    keys = similarity._word_keys(new, max_changed)
    kind, role = F.col("kind"), F.col("left_out")
    offers = [
        ((kind == 0) & (role == 0), 1, "m1"), ((kind == 0) & (role == 1), 1, "m0"), ((kind == 1) & (role == 1), 1, "m1"),
        ((kind == 0) & (role == 0), 2, "m2"), ((kind == 0) & (role == 1), 2, "m1"), ((kind == 0) & (role == 2), 2, "m0"),
        ((kind == 1) & (role == 1), 2, "m2"), ((kind == 1) & (role == 2), 2, "m1"), ((kind == 2) & (role == 2), 2, "m2"),
    ]
    listed = F.array(*[F.struct(F.lit(d).alias("changed"), F.when(where, F.col(m)).alias("partner")) for where, d, m in offers if d <= max_changed])
    found = keys.join(index, ["kind", "k1", "k2"]).select("id", F.inline(listed)).where("partner is not null and partner <> id")
    # (distance, id) as one struct of fixed width: a hash aggregation keeps its minimum as two columns
    near = found.groupBy("id").agg(F.min("changed").alias("changed"), F.min(F.when(F.col("changed") == 1, F.col("partner"))).alias("p1"), F.min("partner").alias("p2"))
    partner = F.when(F.col("changed") == 1, F.col("p1")).otherwise(F.col("p2"))
    return near.select(id_text("id").alias("template_id"), id_text(partner).alias("similar_id"), F.lit("words").alias("method"), F.col("changed").cast("double").alias("score"))


def gram_index(known: DataFrame, shingle: int = 3, hashes: int = 32, bands: int = 8) -> tuple[DataFrame, DataFrame]:
    """(band, bucket, id) and (id, grams) of known templates, both written tables in production."""
    sets = known.select(id_number("template_id").alias("id"), similarity.word_grams("template_text", shingle).alias("grams"))
    sets = similarity._checkpointed(sets)
    return similarity._minhash_buckets(sets, hashes, bands).select("band", "bucket", "id"), sets


def probe_grams(
    new: DataFrame, index: tuple[DataFrame, DataFrame], min_similarity: float = 0.8, shingle: int = 3, hashes: int = 32, bands: int = 8
) -> DataFrame:
    """Links of new templates to the most similar indexed one that shares a bucket, by Jaccard of the n-gram sets.

    Ties go to the smaller id.  A bucket's known ids are all compared: known templates are distinct texts.
    """
    buckets, known_sets = index
    sets = similarity._checkpointed(new.select(id_number("template_id").alias("id"), similarity.word_grams("template_text", shingle).alias("grams")))
    mine = similarity._minhash_buckets(sets, hashes, bands).withColumnRenamed("id", "src")
    pairs = mine.join(buckets.withColumnRenamed("id", "dst"), ["band", "bucket"]).where("src <> dst").select("src", "dst").distinct()
    left = pairs.join(sets.select(F.col("id").alias("src"), F.col("grams").alias("x")), "src")
    both = left.join(known_sets.select(F.col("id").alias("dst"), F.col("grams").alias("y")).hint("shuffle_merge"), "dst")
    common = F.size(F.array_intersect("x", "y"))
    scored = both.select("src", "dst", (common / (F.size("x") + F.size("y") - common).cast("double")).alias("s")).where(F.col("s") >= min_similarity)
    best = scored.groupBy("src").agg(F.min(F.struct((-F.col("s")).alias("s"), "dst")).alias("b"))
    return best.select(id_text("src").alias("template_id"), id_text("b.dst").alias("similar_id"), F.lit("ngrams").alias("method"), (-F.col("b.s")).alias("score"))


def probe_vectors(new: DataFrame, known: DataFrame, min_cosine: float = 0.9) -> DataFrame:
    """Links of new to known vectors (both template_id, vector), the closest of at least that cosine, then the smaller id.

    Ids of the two tables are distinct.  Equal vectors are compared once.
    """
    rows = new.select("template_id", "vector", F.lit(True).alias("new")).unionByName(known.select("template_id", "vector", F.lit(False).alias("new")))
    rows = similarity._checkpointed(rows.select(id_number("template_id").alias("id"), "vector", "new"))
    members, unit = similarity.vector_classes(rows, "id", "vector")
    marked = members.join(rows.select("id", "new"), "id")
    asked = marked.where("new").select("id", "class")
    held = marked.where("not new").groupBy(F.col("class").alias("other")).agg(F.min("id").alias("dst"))
    links = similarity._checkpointed(similarity.class_links(unit, min_cosine))
    near = links.select(F.col("src").alias("class"), F.col("dst").alias("other"), "cosine")
    near = near.unionByName(links.select(F.col("dst").alias("class"), F.col("src").alias("other"), "cosine"))
    near = near.unionByName(held.select(F.col("other").alias("class"), "other", F.lit(1.0).alias("cosine")))
    best = near.join(held, "other").groupBy("class").agg(F.min(F.struct((-F.col("cosine")).alias("s"), "dst")).alias("b"))
    best = asked.join(best, "class").select(F.col("id").alias("src"), "b")
    return best.select(id_text("src").alias("template_id"), id_text("b.dst").alias("similar_id"), F.lit("vectors").alias("method"), (-F.col("b.s")).alias("score"))


def _settled(rows: DataFrame, hit: Column, values: dict[str, Column]) -> DataFrame:
    """rows with the result columns replaced where ``hit``; category and subcategory follow the label."""
    label = F.when(hit, values["label"]).otherwise(F.col("label"))
    out = rows.withColumns({
        "__label": label,
        "confidence": F.when(hit, values["confidence"]).otherwise(F.col("confidence")),
        "agreement": F.when(hit, F.lit(True)).otherwise(F.col("agreement")),
        "level_used": F.when(hit, values["level_used"]).otherwise(F.col("level_used")),
    })
    return out.withColumns({"label": F.col("__label"), "category": label_category("__label"), "subcategory": label_subcategory("__label")}).drop("__label")


def resolve_similar(classified: DataFrame, known: DataFrame, *links: DataFrame) -> DataFrame:
    """Pending rows with a link take the known template's label: level ``similar``; the others stay as they are.

    ``links``: LINK_SCHEMA tables in order of preference, one row a template each.  Adds similar_id, similar_method and
    similar_score as evidence; the confidence is the known template's.  A link to a template that is not in
    ``known`` or gives no label is passed over.
    """
    ranked = None
    for order, part in enumerate(links):
        part = part.select("template_id", "similar_id", "method", "score", F.lit(order).alias("order"))
        ranked = part if ranked is None else ranked.unionByName(part)
    source = labelled(known).select(F.col("template_id").alias("similar_id"), F.col("label").alias("s_label"), F.col("confidence").alias("s_conf"))
    good = ranked.join(source, "similar_id").groupBy("template_id").agg(F.min(F.struct("order", "similar_id", "method", "score", "s_label", "s_conf")).alias("__s"))
    joined = classified.join(good, "template_id", "left").withColumn("__hit", (F.col("level_used") == "pending") & F.col("__s").isNotNull())
    hit = F.col("__hit")
    out = _settled(joined, hit, {"label": F.col("__s.s_label"), "confidence": F.col("__s.s_conf"), "level_used": F.lit("similar")})
    evidence = {f"similar_{new}": F.when(hit, F.col(f"__s.{c}")) for new, c in (("id", "similar_id"), ("method", "method"), ("score", "score"))}
    return out.withColumns(evidence).drop("__s", "__hit")


def similar_level(classified: DataFrame, known: DataFrame, index: DataFrame, grams: tuple[DataFrame, DataFrame] | None = None, max_changed: int = 2) -> DataFrame:
    """Classified templates with the similarity levels applied; only what words leave pending is probed by n-grams."""
    classified = similarity._checkpointed(classified)
    pending = classified.where("level_used = 'pending'").select("template_id", "template_text", F.col("client_name").alias("sender"))
    by_words = similarity._checkpointed(probe_words(pending, index, max_changed))
    links = [by_words]
    if grams is not None:
        rest = pending.join(by_words.select("template_id"), "template_id", "left_anti")
        links.append(probe_grams(rest, grams))
    return resolve_similar(classified, known, *links)


# --- Text model and submodels -----------------------------------------------------------------


def model_level(classified: DataFrame, model) -> DataFrame:
    """Pending rows that the text model (``learn.CascadeModel``) accepts: level ``l2``, or ``l3`` by a submodel.

    Adds model_label and model_confidence for every pending row, accepted or not: candidates for the judges.
    """
    classified = similarity._checkpointed(classified)
    pending = classified.where("level_used = 'pending'").select("template_id", "template_text").dropDuplicates(["template_id"])
    made = model.predict(pending).select("template_id", F.col("predicted_label").alias("model_label"), F.col("prediction_confidence").alias("model_confidence"), "level", "accepted")
    joined = classified.join(made, "template_id", "left").withColumn("__hit", (F.col("level_used") == "pending") & F.coalesce("accepted", F.lit(False)))
    values = {"label": F.col("model_label"), "confidence": F.col("model_confidence"), "level_used": F.col("level")}
    return _settled(joined, F.col("__hit"), values).drop("level", "accepted", "__hit")


def cascade(classified: DataFrame, known: DataFrame | None = None, index: DataFrame | None = None, grams=None, model=None) -> DataFrame:
    """Rules first (done), then similar templates, then the model; a level that is not given is left out."""
    out = classified
    if known is not None:
        out = similar_level(out, known, word_index(labelled(known)) if index is None else index, grams)
    return out if model is None else model_level(out, model)


def level_counts(results: DataFrame) -> DataFrame:
    """Templates and messages per level."""
    return results.groupBy("level_used").agg(F.count(F.lit(1)).alias("templates"), F.coalesce(F.sum("frequency"), F.lit(0)).alias("messages"))
