"""Evaluation of a binary classifier by conditional sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import ratio, steady_round


def _share(part: Column, whole: Column) -> Column:
    """Ratio of counts; 0 for an empty whole."""
    return F.coalesce(ratio(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _harmonic(precision: Column, recall: Column) -> Column:
    return F.coalesce(ratio(2 * precision * recall, precision + recall), F.lit(0.0))


def confusion(rows: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """One row of counts: `tp, fp, fn, tn`."""
    actual, guess = F.col(label) == 1, F.col(predicted) == 1
    return rows.agg(
        F.count_if(actual & guess).alias("tp"),
        F.count_if(~actual & guess).alias("fp"),
        F.count_if(actual & ~guess).alias("fn"),
        F.count_if(~actual & ~guess).alias("tn"),
    )


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Counts with accuracy, precision, recall and F1 of the positive class."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _share(tp, tp + fp), _share(tp, tp + fn)
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        steady_round(_share(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
        steady_round(precision, 4).alias("precision"),
        steady_round(recall, 4).alias("recall"),
        steady_round(_harmonic(precision, recall), 4).alias("f1"),
    )


def classification_report(counts: DataFrame, names: tuple[str, str] = ("HOLD", "BUY")) -> DataFrame:
    """Per class and on average: precision, recall, F1 and support."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    figures = {}
    for name, hit, wrong, missed in ((names[0], tn, fn, fp), (names[1], tp, fp, fn)):
        p, r = _share(hit, hit + wrong), _share(hit, hit + missed)
        figures[name] = (p, r, _harmonic(p, r), hit + missed)
    low, high = figures[names[0]], figures[names[1]]
    accuracy = _share(tp + tn, total)
    macro = [(a + b) / 2 for a, b in zip(low[:3], high[:3])]
    weighted = [
        F.coalesce(ratio(a * low[3] + b * high[3], total.cast("double")), F.lit(0.0))
        for a, b in zip(low[:3], high[:3])
    ]
    rows = {
        **figures,
        "accuracy": (accuracy, accuracy, accuracy, total),
        "macro avg": (*macro, total),
        "weighted avg": (*weighted, total),
    }
    lines = [
        F.struct(
            F.lit(name).alias("class"),
            steady_round(p, 4).alias("precision"),
            steady_round(r, 4).alias("recall"),
            steady_round(f, 4).alias("f1"),
            support.alias("support"),
        )
        for name, (p, r, f, support) in rows.items()
    ]
    return counts.select(F.inline(F.array(*lines)))


def auc(rows: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: area under the ROC curve, exact, equal scores sharing their rank.

    Rows are first counted per score. The negatives below each score are then
    summed over 2^10 wide ranges between the lowest and the highest score, 2^20
    narrow ones, and the distinct scores within a narrow range, so no task holds
    all scores. A row without a score is an error, as its rank is unknown.
    """
    known = F.when(F.col(score).isNull(), F.raise_error(F.lit("a row has no score"))).otherwise(
        F.col(score)
    )
    scores = rows.groupBy(known.cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    low, high = scores.agg(F.min("score")).scalar(), scores.agg(F.max("score")).scalar()
    place = F.coalesce(ratio(F.col("score") - low, high - low), F.lit(0.0))
    scores = scores.withColumn("_place", place).withColumns(
        {
            "wide": F.floor(F.col("_place") * (2**10 - 1)),
            "narrow": F.floor(F.col("_place") * (2**20 - 1)),
        }
    )

    def below(df: DataFrame, order: str, *within: str) -> Column:
        w = Window.partitionBy(*within).orderBy(order)
        return F.coalesce(
            F.sum("neg").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    wide = scores.groupBy("wide").agg(F.sum("neg").alias("neg"))
    wide = wide.select("wide", below(wide, "wide").alias("below_wide"))
    narrow = scores.groupBy("wide", "narrow").agg(F.sum("neg").alias("neg"))
    narrow = narrow.select("wide", "narrow", below(narrow, "narrow", "wide").alias("below_narrow"))
    ranked = (
        scores.withColumn("below_score", below(scores, "score", "wide", "narrow"))
        .join(narrow, ["wide", "narrow"])
        .join(wide, "wide")
    )
    under = F.col("below_wide") + F.col("below_narrow") + F.col("below_score")
    # Twice the number of ordered pairs, a whole number.
    pairs = F.sum((F.col("pos") * (2 * under + F.col("neg"))).cast("decimal(38,0)"))
    return ranked.agg(
        steady_round(
            ratio(
                pairs.cast("double"),
                2.0 * F.sum("pos").cast("double") * F.sum("neg").cast("double"),
            ),
            6,
        ).alias("auc")
    )
