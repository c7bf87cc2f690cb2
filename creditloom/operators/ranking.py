"""Ranking metrics and curves from scored rows (key, label, score).

Equal scores are merged first, so ties cost one row and are handled exactly; the
running counts over the distinct scores use the bucketed order of ``ordering``.
"""

from pyspark.sql import functions as F

from creditloom.operators.ordering import running_totals


def per_score(scored, label="label", score="score"):
    """Distinct scores with their positives and negatives."""
    return scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def _accumulated(scored, label="label", score="score"):
    return running_totals(
        per_score(scored, label, score), "score", {"tp": F.col("pos"), "fp": F.col("neg")},
        cuts_from=scored.select(F.col(score).alias("score")),
    )


def _double(name):
    return F.col(name).cast("double")


def roc_auc(scored, label="label", score="score"):
    """Area under the ROC curve; tied pairs count one half."""
    sums = _accumulated(scored, label, score).agg(
        F.sum(_double("pos") * (_double("fp") - _double("neg") / 2)).alias("lost"),
        F.sum(_double("pos")).alias("p"),
        F.sum(_double("neg")).alias("n"),
    )
    pairs = F.col("p") * F.col("n")
    return sums.select(F.bround(F.try_divide(pairs - F.col("lost"), pairs), 4).alias("auc_roc"))


def avg_precision(scored, label="label", score="score"):
    """Average precision as a step sum over the distinct scores."""
    sums = _accumulated(scored, label, score).agg(
        F.sum(_double("pos") * _double("tp") / (_double("tp") + _double("fp"))).alias("steps"),
        F.sum(_double("pos")).alias("p"),
    )
    return sums.select(F.bround(F.try_divide(F.col("steps"), F.col("p")), 4).alias("avg_precision"))


def ranking_summary(scored, label="label", score="score"):
    """Both ranking metrics from one ordering."""
    sums = _accumulated(scored, label, score).agg(
        F.sum(_double("pos") * (_double("fp") - _double("neg") / 2)).alias("lost"),
        F.sum(_double("pos") * _double("tp") / (_double("tp") + _double("fp"))).alias("steps"),
        F.sum(_double("pos")).alias("p"),
        F.sum(_double("neg")).alias("n"),
    )
    pairs = F.col("p") * F.col("n")
    return sums.select(
        F.bround(F.try_divide(pairs - F.col("lost"), pairs), 4).alias("auc_roc"),
        F.bround(F.try_divide(F.col("steps"), F.col("p")), 4).alias("avg_precision"),
    )


def class_totals(scored, label="label", score="score"):
    """Numbers of positives and negatives with a score, as floats: one pass, one row."""
    row = scored.where(F.col(score).isNotNull()).agg(
        F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    ).first()
    return float(row[0]), float(row[1])


def _share(count, whole):
    return F.try_divide(_double(count), F.lit(whole))


def _point(spark, **values):
    return spark.range(1).select([F.lit(v).cast("double").alias(name) for name, v in values.items()])


def roc_curve(scored, label="label", score="score"):
    """One point per distinct score, highest first, after the origin; collinear points are kept."""
    p, n = class_totals(scored, label, score)
    points = _accumulated(scored, label, score).select(
        "score", _share("fp", n).alias("fpr"), _share("tp", p).alias("tpr")
    )
    return _point(scored.sparkSession, score=None, fpr=0.0, tpr=0.0).unionByName(points)


def pr_curve(scored, label="label", score="score"):
    """Precision and recall per distinct score, the end point (1, 0), and the base rate beside them."""
    p, n = class_totals(scored, label, score)
    base = p / (p + n) if p + n else None
    points = _accumulated(scored, label, score).select(
        "score",
        (_double("tp") / (_double("tp") + _double("fp"))).alias("precision"),
        _share("tp", p).alias("recall"),
        F.lit(base).cast("double").alias("base_rate"),
    )
    end = _point(scored.sparkSession, score=None, precision=1.0, recall=0.0, base_rate=base)
    return points.unionByName(end)


def confusion(scored, label="label", predicted="predicted"):
    """Counts by true class (rows) and predicted class (columns)."""
    return scored.groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count_if(F.col(predicted) == 0).alias("predicted_0"),
        F.count_if(F.col(predicted) == 1).alias("predicted_1"),
    )


def class_report(scored, label="label", predicted="predicted"):
    """Precision, recall and F1 of the positive class; 0 where undefined."""
    hit = (F.col(label) == 1) & (F.col(predicted) == 1)
    counts = scored.agg(
        F.count_if(hit).alias("tp"),
        F.count_if((F.col(label) == 0) & (F.col(predicted) == 1)).alias("fp"),
        F.count_if((F.col(label) == 1) & (F.col(predicted) == 0)).alias("fn"),
    )
    return counts.select(
        rate("tp", F.col("tp") + F.col("fp")).alias("precision_default"),
        rate("tp", F.col("tp") + F.col("fn")).alias("recall_default"),
        f_score(1.0).alias("f1_default"),
    )


def rate(part, whole):
    """Quotient rounded to 4 digits, 0 where undefined."""
    return F.bround(F.coalesce(F.try_divide(_double(part), whole.cast("double")), F.lit(0.0)), 4)


def f_score(beta):
    """F-beta from columns tp, fp, fn."""
    square = beta * beta
    top = F.lit(1 + square) * _double("tp")
    return F.bround(
        F.coalesce(F.try_divide(top, top + F.lit(square) * _double("fn") + _double("fp")), F.lit(0.0)), 4
    )


def cumulative_gain(scored, key="SK_ID_CURR", label="label", score="score"):
    """Every row by falling score with its share of the population and of the positives so far."""
    rows = scored.select(key, F.col(label).alias("label"), F.col(score).alias("score"))
    p, n = class_totals(rows)
    placed = running_totals(
        rows, "score", {"position": F.lit(1), "positives": F.col("label")}, tiebreak=key
    )
    return placed.select(
        key, "score", "label", F.col("position").cast("long").alias("position"),
        (_share("position", p + n) * 100).alias("population_pct"),
        (_share("positives", p) * 100).alias("gain_pct"),
    )


def top_share_capture(scored, share=0.2, key="SK_ID_CURR", label="label", score="score"):
    """Percentage of positives among the rows with the highest scores, and the multiple of random.

    The rows are counted off along the global order; none are gathered.
    """
    rows = scored.select(key, F.col(label).alias("label"), F.col(score).alias("score"))
    p, n = class_totals(rows)
    placed = running_totals(rows, "score", {"position": F.lit(1)}, tiebreak=key)
    caught = F.count_if((F.col("position") <= int((p + n) * share)) & (F.col("label") == 1))
    pct = F.try_divide(caught.cast("double"), F.lit(p)) * 100
    return placed.agg(pct.alias("capture_pct"), (pct / F.lit(share * 100)).alias("lift"))
