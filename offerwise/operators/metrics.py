"""Class shares, weights and model quality; each is one partially aggregated pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwise.schemas import LABEL, OUTCOMES, PROBABILITIES

# Report row names and the clipping of probabilities in log loss.
OUTCOME_NAMES = ("accept", "downgrade", "churn")
CLIP = 1e-15


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value of a low-cardinality column, by value; NULLs are left out.

    The total is summed over the aggregated rows, one per value.
    """
    counts = df.groupBy(column).agg(F.count(column).alias("n")).where(F.col("n") > 0)
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share_percent", share).orderBy(column)


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row per class: n / (classes * n_class). Rows without a label do not count."""
    everything = Window.partitionBy()
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn(
        "class_weight",
        F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n")),
    )


def with_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Attach the balanced weight of its class to every row; without a label it is NULL."""
    weights = class_weights(df, label).select(label, "class_weight")
    return df.join(F.broadcast(weights), label, "left")  # one row per class


def confusion(predicted: DataFrame, label: str = LABEL, prediction: str = "prediction"):
    return predicted.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def _class_scores(label: Column, prediction: Column) -> DataFrame:
    """Per class: precision, recall, F1 and support as one struct of aggregates."""
    scores = []
    for k in OUTCOMES:
        hit = F.count_if((label == k) & (prediction == k)).cast("double")
        said = F.count_if(prediction == k).cast("double")
        is_k = F.count_if(label == k).cast("double")
        precision, recall = _ratio(hit, said), _ratio(hit, is_k)
        f1 = _ratio(2 * hit, said + is_k)
        scores.append((precision, recall, f1, is_k))
    return scores


def class_report(
    predicted: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    y, guess = F.col(label), F.col(prediction)
    scores = _class_scores(y, guess)
    total = sum((s[3] for s in scores[1:]), scores[0][3])

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.cast("bigint").alias("support"),
        )

    accuracy = _ratio(F.count_if(y == guess).cast("double"), total)
    macro = [sum((s[i] for s in scores[1:]), scores[0][i]) / len(scores) for i in range(3)]
    weighted = [
        _ratio(sum((s[i] * s[3] for s in scores[1:]), scores[0][i] * scores[0][3]), total)
        for i in range(3)
    ]
    rows = [row(name, *s) for name, s in zip(OUTCOME_NAMES, scores, strict=True)]
    rows.append(row("accuracy", accuracy, accuracy, accuracy, total))
    rows.append(row("macro avg", *macro, total))
    rows.append(row("weighted avg", *weighted, total))
    return predicted.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def macro_f1(label: Column, prediction: Column) -> Column:
    """Aggregate: unweighted mean of the classes' F1."""
    scores = [s[2] for s in _class_scores(label, prediction)]
    return sum(scores[1:], scores[0]) / len(scores)


def log_loss(label: Column, probabilities: Sequence[Column] | None = None) -> Column:
    """Aggregate: mean negative log of the probability given to the true class.

    Rows without a label are left out. A NULL or NaN probability of a labelled row makes the
    result NULL: such a model has no loss.
    """
    p0, p1, p2 = probabilities or [F.col(p) for p in PROBABILITIES]
    given = F.when(label == 0, p0).when(label == 1, p1).when(label == 2, p2)
    broken = label.isin(*OUTCOMES) & (given.isNull() | F.isnan(given))
    loss = -F.ln(F.least(F.greatest(given, F.lit(CLIP)), F.lit(1 - CLIP)))
    mean = F.avg(F.when(given.isNotNull(), loss))  # the bounds would stand in for a NULL
    return F.when(F.count_if(broken) == 0, mean)


def improvement_percent(base: Column, enhanced: Column, lower_is_better: bool = False) -> Column:
    """Relative gain over `base` in percent; NULL where the base is 0."""
    gain = base - enhanced if lower_is_better else enhanced - base
    return F.when(base != 0, gain / base * 100)
