"""Choice of a decision threshold by F-beta."""

from pyspark.sql import functions as F

from creditloom import settings as S
from creditloom.operators.ranking import f_score, rate


def threshold_counts(scored, thresholds=None, label="label", score="score"):
    """True and false positives and false negatives at each threshold.

    One pass counts the rows of each class reaching each threshold; the single
    row of counts is unfolded into one row per threshold.
    """
    thresholds = thresholds or S.SWEEP
    positive, negative = F.col(label) == 1, F.col(label) == 0
    reached = [F.col(score) >= F.lit(t) for t in thresholds]
    counts = scored.where(F.col(score).isNotNull()).agg(
        F.count_if(positive).alias("p"),
        *[F.count_if(positive & r).alias(f"tp{i}") for i, r in enumerate(reached)],
        *[F.count_if(negative & r).alias(f"fp{i}") for i, r in enumerate(reached)],
    )
    steps = [
        F.struct(
            F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
            (F.col("p") - F.col(f"tp{i}")).alias("fn"),
        )
        for i, t in enumerate(thresholds)
    ]
    return counts.select(F.inline(F.array(*steps)))


def fbeta_sweep(scored, beta=S.BETA, thresholds=None, label="label", score="score"):
    """F-beta, precision, recall and F1 of the positive class at each threshold."""
    return threshold_counts(scored, thresholds, label, score).select(
        F.bround("threshold", 2).alias("threshold"),
        f_score(beta).alias("fbeta"),
        rate("tp", F.col("tp") + F.col("fp")).alias("precision"),
        rate("tp", F.col("tp") + F.col("fn")).alias("recall"),
        f_score(1.0).alias("f1"),
    )


def best_threshold(sweep):
    """The sweep row with the highest F-beta, the lowest threshold among equals."""
    return sweep.orderBy(F.desc("fbeta"), "threshold").limit(1)
