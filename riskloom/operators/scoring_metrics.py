"""Classification, ranking, regression and fairness measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom import constants as K
from riskloom.functions import numbers as N
from riskloom.functions.display import formatted
from riskloom.operators import ordered as R
from riskloom.operators.quality import long_form


def _ratio(a: Column, b: Column) -> Column:
    """a / b with 0 for an empty denominator."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: str, flag: Column | str, by: Sequence[str] = ()) -> DataFrame:
    y = F.col(label) == 1
    hit = (F.col(flag) if isinstance(flag, str) else flag) == 1
    return df.groupBy(*by).agg(
        F.count_if(~y & ~hit).alias("tn"), F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"), F.count_if(y & hit).alias("tp"),
    )


def precision_recall(df: DataFrame, label: str, flag: Column | str, by: Sequence[str] = ()) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return confusion(df, label, flag, by).select(
        *by, "tn", "fp", "fn", "tp",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: ties collapse before any sort."""
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve from average ranks; NULL with only one class."""
    sized = score_counts(df, label, score, by).withColumn("c", F.col("p") + F.col("n"))
    placed = R.running_totals(sized, by, "score", {"upto": "c"})
    mean_rank = F.col("upto") - (F.col("c") - 1) / 2
    pos, neg = F.sum("p"), F.sum("n")
    area = (F.sum(F.col("p") * mean_rank) - pos * (pos + 1) / 2) / F.nullif(pos * neg, F.lit(0))
    return placed.groupBy(*by).agg(area.alias("auc"), pos.alias("positives"), neg.alias("negatives"))


def _descending(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    counted = score_counts(df, label, score, by)
    return R.running_totals(counted, by, "score", {"tp": "p", "fp": "n"}, descending=True)


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum of recall steps times precision, scores from high to low."""
    steps = _descending(df, label, score, by)
    return steps.groupBy(*by).agg(
        (
            F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp")))
            / F.nullif(F.sum("p"), F.lit(0))
        ).alias("average_precision")
    )


def roc_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rates at every distinct score used as a cut-off."""
    steps = R.kept(_descending(df, label, score, by))
    sizes = steps.groupBy(*by).agg(F.sum("p").alias("_pos"), F.sum("n").alias("_neg"))
    joined = R.join_on(steps, sizes, by) if by else steps.withColumns(
        {"_pos": sizes.select("_pos").scalar(), "_neg": sizes.select("_neg").scalar()}
    )
    return joined.select(
        *by, F.col("score").alias("threshold"), "tp", "fp",
        (F.col("fp") / F.nullif(F.col("_neg"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("_pos"), F.lit(0))).alias("tpr"),
    )


def threshold_curve(
    df: DataFrame,
    label: str,
    score: str,
    cost_fn: float = K.COST_FALSE_NEGATIVE,
    cost_fp: float = K.COST_FALSE_POSITIVE,
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Confusion counts and cost at every cut-off; rows without a score (NULL or NaN) or label don't count.

    Each row falls into one of len(thresholds)+1 intervals, so the table shrinks to that
    many rows in one partial aggregation; the running sums work on those.
    """
    cuts = list(thresholds) if thresholds is not None else K.threshold_grid()
    known = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull()
    per_interval = (
        df.where(known)
        .groupBy(N.cut_index(score, cuts).alias("interval"))
        .agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))
    )
    grid = df.sparkSession.createDataFrame(
        [(0, None)] + [(i + 1, t) for i, t in enumerate(cuts)], "interval int, threshold double"
    )
    filled = grid.join(per_interval, "interval", "left").na.fill(0, ["p", "n"])
    # len(thresholds)+1 rows: a fixed number, whatever the table's size.
    below = Window.orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.orderBy("interval").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    counted = filled.withColumns(
        {
            "fn": F.coalesce(F.sum("p").over(below), F.lit(0)),
            "tn": F.coalesce(F.sum("n").over(below), F.lit(0)),
            "tp": F.sum("p").over(above),
            "fp": F.sum("n").over(above),
        }
    ).where("interval > 0")
    return counted.select(
        "threshold", "tn", "fp", "fn", "tp",
        (F.col("fn") * cost_fn + F.col("fp") * cost_fp).alias("cost"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def cheapest_threshold(df: DataFrame, label: str, score: str, **options) -> DataFrame:
    """Cut-off with the smallest cost; the lowest one among equals."""
    return threshold_curve(df, label, score, **options).orderBy("cost", "threshold").limit(1)


def regression_metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    error = F.col(truth) - F.col(predicted)
    spread = F.var_pop(truth)
    return df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.avg(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )


def _by_subgroup(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    rows = long_form(df, columns, keep)
    return rows.withColumn("value", F.coalesce("value", F.lit("missing")))


def subgroup_recalls(df: DataFrame, columns: Sequence[str], label: str, flag: str) -> DataFrame:
    """Recall per (column, value); values without positives are left out."""
    rows = _by_subgroup(df, columns, [label, flag])
    pos = F.count_if(F.col(label) == 1)
    return (
        rows.groupBy("column", "value")
        .agg(pos.alias("positives"), F.count_if((F.col(label) == 1) & (F.col(flag) == 1)).alias("tp"))
        .where("positives > 0")
        .withColumn("recall", F.col("tp") / F.col("positives"))
    )


def subgroup_recall_gap(df: DataFrame, columns: Sequence[str], label: str, flag: str) -> DataFrame:
    """Per column: largest minus smallest recall; NULL gap below two values."""
    return (
        subgroup_recalls(df, columns, label, flag)
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("groups"),
            F.when(F.count(F.lit(1)) >= 2, F.max("recall") - F.min("recall")).alias("gap"),
        )
    )


def largest_recall_gap(df: DataFrame, columns: Sequence[str], label: str, flag: str) -> DataFrame:
    return subgroup_recall_gap(df, columns, label, flag).agg(
        F.coalesce(F.max("gap"), F.lit(0.0)).alias("gap")
    )


def fairness_audit(
    df: DataFrame, columns: Sequence[str], label: str, flag: str, min_size: int = K.MIN_AUDIT_SIZE
) -> DataFrame:
    """Size, actual rate, alert rate and recall per named subgroup of enough members."""
    rows = long_form(df, columns, [label, flag]).where(F.col("value").isNotNull())
    y, hit = F.col(label) == 1, F.col(flag) == 1
    return (
        rows.groupBy("column", "value")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.avg(y.cast("int")).alias("actual_rate"),
            F.avg(hit.cast("int")).alias("alert_rate"),
            (F.count_if(y & hit) / F.nullif(F.count_if(y), F.lit(0))).alias("recall"),
        )
        .where(F.col("size") >= min_size)
    )


def cost_table(df: DataFrame, model: str, metric: str, cost: str, reference: str) -> DataFrame:
    """Cost ratio, gain and cost per point gained against one reference model, which must be there once."""
    base = df.where(F.col(model) == reference)
    if (n := base.limit(2).count()) != 1:
        raise ValueError(f"reference model {reference!r} has {'no row' if n == 0 else 'more than one row'}")
    ref_metric, ref_cost = base.agg(F.min(metric)).scalar(), base.agg(F.min(cost)).scalar()
    out = df.withColumns({"_m": ref_metric, "_c": ref_cost})
    gain = F.col(metric) - F.col("_m")
    return out.withColumns(
        {
            "cost_ratio": F.col(cost) / F.col("_c"),
            "gain": gain,
            "cost_per_point": F.when(gain > 0, (F.col(cost) - F.col("_c")) / F.nullif(gain, F.lit(0.0)))
            .otherwise(F.lit(float("inf"))),
        }
    ).drop("_m", "_c")


def run_summary(df: DataFrame, metric: str = "auc") -> DataFrame:
    """Training runs with emissions in grams; missing measurements stay NULL."""
    return df.select(
        F.col("label").alias("model"), "duration_s", "energy_kwh",
        (F.col("emissions_kg") * 1000.0).alias("co2_g"), metric,
    )


def metric_sheet(metrics: DataFrame) -> DataFrame:
    """Known metrics of a (key, value) table with label and display text."""
    labels = metrics.sparkSession.createDataFrame(
        [(i, k, v) for i, (k, v) in enumerate(K.METRIC_LABELS.items())],
        "position int, key string, label string",
    )
    x = F.col("value").cast("double")
    shown = F.when(F.col("key").startswith("n_"), formatted("%.0f", x)).otherwise(formatted("%.3f", x))
    return metrics.join(F.broadcast(labels), "key").select("position", "key", "label", shown.alias("text"))


def monitored_periods(
    df: DataFrame, period: str, label: str, flag: str, score: str, columns: Sequence[str]
) -> DataFrame:
    """Performance and fairness alert per period.

    AUC under the floor, recall lower than the period before by more than the allowed
    drop, or a recall or alert-rate gap between subgroups above the limit.
    """
    base = precision_recall(df, label, flag, [period]).select(period, "recall")
    auc = roc_auc(df, label, score, [period]).select(period, "auc")
    rows = _by_subgroup(df, columns, [period, label, flag])
    y, hit = F.col(label) == 1, F.col(flag) == 1
    groups = rows.groupBy(period, "column", "value").agg(
        F.avg(hit.cast("int")).alias("rate"),
        (F.count_if(y & hit) / F.nullif(F.count_if(y), F.lit(0))).alias("rec"),
    )
    gaps = (
        groups.groupBy(period, "column")
        .agg((F.max("rate") - F.min("rate")).alias("rate_gap"), (F.max("rec") - F.min("rec")).alias("rec_gap"))
        .groupBy(period)
        .agg(F.max("rate_gap").alias("alert_rate_gap"), F.max("rec_gap").alias("recall_gap"))
    )
    # One row per period from here on.
    by_period = Window.orderBy(period)
    out = base.join(auc, period).join(gaps, period)
    drop = F.lag("recall").over(by_period) - F.col("recall")
    return out.withColumn("recall_drop", drop).withColumn(
        "alert",
        F.coalesce(F.col("auc") < K.MIN_AUC, F.lit(False))
        | F.coalesce(F.col("recall_drop") > K.MAX_RECALL_DROP, F.lit(False))
        | F.coalesce(F.col("recall_gap") > K.MAX_FAIRNESS_GAP, F.lit(False))
        | F.coalesce(F.col("alert_rate_gap") > K.MAX_FAIRNESS_GAP, F.lit(False)),
    )
