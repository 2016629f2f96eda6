"""Exact additive explanations of linear scores, for every row and without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import constants as K
from riskloom.functions import display as D, text as X
from riskloom.operators import ordered as R
from riskloom.operators.scoring_metrics import roc_auc
from riskloom.operators.splitting import split_hash


def log_odds(coefficients: Mapping[str, float], intercept: float) -> Column:
    total = F.lit(float(intercept))
    for name, weight in coefficients.items():
        total = total + F.lit(float(weight)) * F.col(name)
    return total


def probability(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def with_contributions(
    df: DataFrame, coefficients: Mapping[str, float], intercept: float,
    centre: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add ``contributions`` (array of name, value, contribution), ``log_odds``, ``proba``.

    The intercept plus the contributions is the log-odds. With ``centre`` the
    contribution of a feature is coefficient * (value - background mean).
    """
    centre = centre or {}
    items = [
        F.struct(
            F.lit(name).alias("name"),
            F.col(name).cast("double").alias("value"),
            (F.lit(float(weight)) * (F.col(name) - F.lit(float(centre.get(name, 0.0))))).alias("contribution"),
        )
        for name, weight in coefficients.items()
    ]
    z = log_odds(coefficients, intercept)
    return df.withColumns(
        {"contributions": F.array(*items), "log_odds": z, "proba": probability(z)}
    )


def vector_contributions(df: DataFrame, vector: str, names: Sequence[str], weights: Sequence[float]) -> DataFrame:
    """``contributions`` from an assembled feature vector and the model's coefficients."""
    from pyspark.ml.functions import vector_to_array

    if len(names) != len(weights):
        raise ValueError("feature names and coefficients differ in number")
    values = vector_to_array(vector)
    known = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(float(w)).alias("w")) for n, w in zip(names, weights)])
    products = F.zip_with(
        known, values,
        lambda k, v: F.struct(k["n"].alias("name"), v.alias("value"), (k["w"] * v).alias("contribution")),
    )
    return df.withColumn("contributions", products)


def top_factors(
    increasing: bool, n: int = 5, contributions: str = "contributions", sources: Sequence[str] | None = None
) -> Column:
    """The n strongest contributions of one sign, displayable ones only when sources are given.

    Sorting happens inside the row's own array, so no row leaves its task.
    """
    def keep(c: Column) -> Column:
        value = c["contribution"]
        sign = value > K.NEGLIGIBLE_CONTRIBUTION if increasing else value < -K.NEGLIGIBLE_CONTRIBUTION
        return sign & D.displayable(D.source_column(c["name"], sources)) if sources is not None else sign

    chosen = F.filter(contributions, keep)
    keyed = F.transform(chosen, lambda c: F.struct((-F.abs(c["contribution"])).alias("k"), c.alias("c")))
    return F.transform(F.slice(F.array_sort(keyed), 1, n), lambda s: s["c"])


def _both_directions(n: int, sources: Sequence[str] | None = None) -> Column:
    """Risk and protective factors in one array, so a table is read once for both."""
    def placed(direction: str, factors: Column) -> Column:
        return F.transform(factors, lambda c, i: F.struct(
            F.lit(direction).alias("direction"), (i + 1).alias("position"), c.alias("c")
        ))

    parts = [
        placed(direction, top_factors(increasing, n, sources=sources))
        for increasing, direction in ((True, "risk"), (False, "protective"))
    ]
    return F.concat(*parts)


def factor_rows(df: DataFrame, keep: Sequence[str], n: int = 5) -> DataFrame:
    """One row per shown factor: direction, position and contribution."""
    return df.select(*keep, F.explode(_both_directions(n)).alias("_s")).select(
        *keep, "_s.direction", "_s.position", F.col("_s.c.name").alias("name"), F.col("_s.c.contribution").alias("contribution")
    )


def factor_sheet(df: DataFrame, keep: Sequence[str], sources: Sequence[str], n: int = 5) -> DataFrame:
    """Label and raw value of the displayable factors, as a reader sees them.

    ``df`` still carries the raw source columns; the standardised value is never shown.
    """
    raw = F.create_map(*[x for c in sources for x in (F.lit(c), F.col(c).cast("string"))])
    rows = df.withColumn("_raw", raw).select(*keep, "_raw", F.explode(_both_directions(n, sources)).alias("_s"))
    source = D.source_column("_s.c.name", sources)
    return rows.select(
        *keep, "_s.direction", "_s.position", D.feature_label(F.col("_s.c.name")).alias("label"),
        shown_value(source, F.col("_raw")[source]).alias("value"),
    )


def shown_value(name: Column, text: Column) -> Column:
    number = X.plain_number(text)
    return F.when(number.isNotNull(), D.number_text(name, number)).otherwise(D.word_text(text))


def mean_absolute_contribution(df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float] | None = None) -> DataFrame:
    """Mean |coefficient * (x - mean)| per feature over the whole table.

    Without given background means, the table's own means are read first.
    """
    if means is None:
        row = df.agg(*[F.avg(c).alias(c) for c in coefficients]).first()
        means = row.asDict()
    wide = df.agg(
        *[
            F.avg(F.abs(F.lit(float(w)) * (F.col(c) - F.lit(float(means[c]))))).alias(c)
            for c, w in coefficients.items()
        ]
    )
    return wide.unpivot([], list(coefficients), "feature", "importance")


def permuted_scores(
    df: DataFrame, names: Sequence[str], contributions: Column, key: str, label: str, repeat: int
) -> DataFrame:
    """(feature, label, score) with each feature replaced by another random row's value.

    Rows are put in a random order by a hash of their key, and each takes the values of
    the next row in that order: one permutation of the table, shared by all features.
    A linear score is a sum of per-feature contributions, so swapping one of them gives
    the permuted score without scoring again.
    """
    base = df.select(F.col(key).alias("_k"), F.col(label).alias("label"), contributions.alias("_x"))
    placed = R.kept(
        R.global_rank(base.withColumn("_h", split_hash("_k", 1000 + repeat)), [F.col("_h"), F.col("_k")], "_r")
    )
    size = placed.agg(F.count(F.lit(1))).scalar()
    other = placed.select((F.pmod(F.col("_r") - 2, size) + 1).alias("_r"), F.col("_x").alias("_y"))
    total = F.aggregate("_x", F.lit(0.0), lambda acc, v: acc + v)
    listed = F.array(*[F.lit(c) for c in names])
    swapped = F.arrays_zip(listed.alias("feature"), F.col("_x").alias("own"), F.col("_y").alias("other"))
    return (
        placed.join(other, "_r")
        .select("label", total.alias("_z"), F.explode(swapped).alias("e"))
        .select(
            F.col("e.feature").alias("feature"), "label",
            (F.col("_z") - F.col("e.own") + F.col("e.other")).alias("score"),
        )
    )


def permutation_importance(
    df: DataFrame, names: Sequence[str], contributions: Column, key: str, label: str, repeats: int = 8
) -> DataFrame:
    """Mean drop of the exact AUC when a feature's values are permuted.

    ``contributions`` is the row's array of per-feature shares of the log-odds, in the
    order of ``names``.
    """
    z = F.aggregate(contributions, F.lit(0.0), lambda acc, v: acc + v)
    plain = roc_auc(df.select(F.col(label).alias("label"), z.alias("score")), "label", "score")
    runs = None
    for repeat in range(repeats):
        one = permuted_scores(df, names, contributions, key, label, repeat).withColumn("run", F.lit(repeat))
        runs = one if runs is None else runs.unionByName(one)
    return (
        roc_auc(runs, "label", "score", ["feature", "run"])
        .groupBy("feature")
        .agg(F.avg("auc").alias("_permuted"))
        .select("feature", (plain.select("auc").scalar() - F.col("_permuted")).alias("importance"))
    )
