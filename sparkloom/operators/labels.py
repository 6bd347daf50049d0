"""Labels: vocabularies, thresholds, distributions, and multi-label measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(rows: DataFrame, vocabulary: DataFrame, *, key: str = "file_pk", labels: str = "labels") -> DataFrame:
    """key and names: the label ids of each row as names, in order; unknown ids as label_<id>; none for null."""
    each = rows.select(key, F.posexplode_outer(labels).alias("pos", "label_id")).join(vocabulary.select("label_id", "name"), "label_id", "left")
    name = F.coalesce("name", F.concat(F.lit("label_"), F.col("label_id").cast("string")))
    packed = F.array_sort(F.collect_list(F.when(F.col("label_id").isNotNull(), F.struct("pos", name.alias("name")))))
    return each.groupBy(key).agg(F.transform(packed, lambda x: x["name"]).alias("names"))


def ids_of(rows: DataFrame, vocabulary: DataFrame, *, key: str = "file_pk", names: str = "names") -> DataFrame:
    """key and labels: the sorted ids of known names."""
    each = rows.select(key, F.explode_outer(names).alias("name")).join(vocabulary.select("label_id", "name"), "name", "left")
    return each.groupBy(key).agg(F.array_sort(F.collect_list("label_id")).alias("labels"))


def above(probabilities: Column, vocabulary: list[str], threshold: float) -> Column:
    """array<struct<p, name>> of the labels that reach the threshold, likeliest first, then by place."""
    pairs = F.transform(probabilities, lambda p, i: F.struct((-p).alias("q"), i.alias("i"), p.alias("p"), F.get(F.array(*map(F.lit, vocabulary)), i).alias("name")))
    return F.transform(F.array_sort(F.filter(pairs, lambda x: x["p"] >= threshold)), lambda x: F.struct(x["p"], x["name"]))


def without_labels(rows: DataFrame, excluded: list[int], labels: str = "labels") -> DataFrame:
    return rows.filter(~F.coalesce(F.arrays_overlap(labels, F.array(*map(F.lit, excluded)).cast("array<int>")), F.lit(False)))


def distribution(rows: DataFrame, labels: str = "names") -> DataFrame:
    """name and n, the most frequent first, then by name."""
    return rows.select(F.explode(labels).alias("name")).groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name")


def distribution_totals(rows: DataFrame, labels: str = "names") -> DataFrame:
    """One row: images, classes, mean labels of an image."""
    each = rows.select(F.explode_outer(labels).alias("name"))
    classes = each.agg(F.count_distinct("name").alias("classes"))
    return rows.agg(F.count("*").alias("images"), F.avg(F.size(labels)).alias("mean_labels")).crossJoin(F.broadcast(classes))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def per_label(pairs: DataFrame) -> DataFrame:
    """label, tp, fp, fn, support, precision, recall, f1 of (sample, label, truth, predicted) rows, of labels that are true
    somewhere; 0 where a ratio is undefined."""
    return label_counts(pairs).filter("support > 0")


def label_counts(pairs: DataFrame) -> DataFrame:
    """What per_label() gives, of all labels."""
    t, p = F.col("truth"), F.col("predicted")
    n = lambda c: F.count(F.when(c, 1)).cast("long")
    sums = pairs.groupBy("label").agg(n(t & p).alias("tp"), n(~t & p).alias("fp"), n(t & ~p).alias("fn"), n(t).alias("support"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.withColumn("precision", _ratio(tp, tp + fp)).withColumn("recall", _ratio(tp, tp + fn)).withColumn("f1", _ratio(2 * tp, 2 * tp + fp + fn))


def multilabel(pairs: DataFrame) -> DataFrame:
    """One row: subset accuracy, Hamming loss, F1 (macro, micro, weighted), macro precision and recall."""
    samples = pairs.groupBy("sample").agg(F.min((F.col("truth") == F.col("predicted")).cast("int")).alias("all_right"))
    tp, fp, fn, support = F.sum("tp"), F.sum("fp"), F.sum("fn"), F.sum("support")
    classes = label_counts(pairs).agg(
        F.avg("f1").alias("f1_macro"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_micro"), _ratio(F.sum(F.col("f1") * F.col("support")), support).alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
    )
    loss = pairs.agg(F.avg((F.col("truth") != F.col("predicted")).cast("int")).alias("hamming_loss"))
    return samples.agg(F.avg("all_right").alias("subset_accuracy")).crossJoin(F.broadcast(loss)).crossJoin(F.broadcast(classes))


def threshold_sweep(scores: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold and macro F1, precision and recall of (sample, label, truth, score) rows, by one pass over the rows."""
    each = scores.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds)))).withColumn("predicted", F.col("score") >= F.col("threshold"))
    t, p = F.col("truth"), F.col("predicted")
    n = lambda c: F.count(F.when(c, 1))
    sums = each.groupBy("threshold", "label").agg(n(t & p).alias("tp"), n(~t & p).alias("fp"), n(t & ~p).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    mean = lambda x: F.round(F.avg(x), 12)  # noqa: E731  beyond that, a mean depends on the order of its terms
    return sums.groupBy("threshold").agg(mean(_ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"), mean(_ratio(tp, tp + fp)).alias("precision"), mean(_ratio(tp, tp + fn)).alias("recall"))


def checked_labels(reply: Column, uncertain: list[int]) -> Column:
    """struct(labels, error) of a JSON reply: sorted distinct ids, or why it is refused."""
    ids = F.from_json(reply, "labels array<int>")["labels"]
    good = F.get_json_object(reply, "$.labels").rlike(r"^\s*\[\s*(-?[0-9]+\s*(,\s*-?[0-9]+\s*)*)?\]\s*$")
    clean = F.array_sort(F.array_distinct(ids))
    doubt = F.array_intersect(clean, F.array(*map(F.lit, uncertain)).cast("array<int>"))
    error = F.when(~F.coalesce(good, F.lit(False)), "labels must be a list of integers").when(
        F.size(doubt) > 0, F.concat(F.lit("uncertain_label_ids=["), F.array_join(doubt.cast("array<string>"), ", "), F.lit("]"))
    )
    return F.struct(F.when(error.isNull(), clean).alias("labels"), error.alias("error"))
