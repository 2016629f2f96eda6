"""Reads over scored cohorts: latest scores, scopes, filters, pages, group statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom import constants as K
from riskloom.functions import numbers as N, text as X
from riskloom.operators import ordered as R


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``; NULL keys form one group.

    The ``row_number() = 1`` form lets Spark keep one row per key already before the
    shuffle (window group limit), so a key with very many rows sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_ids(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Rows whose id is the largest of their key, as aggregate plus semi-join."""
    newest = df.groupBy(*keys).agg(F.max(id_col).alias(id_col)).select(id_col)
    return df.join(newest, id_col, "left_semi")


def with_groups(
    scores: DataFrame,
    members: DataFrame,
    on: Sequence[str],
    group: str,
    scope: Sequence[str] | None = None,
) -> DataFrame:
    """Attach the group of each score; a scope makes the join inner and restricts it.

    Without a scope nothing is lost (left join). With one, rows whose group cannot be
    shown to be allowed stay invisible, and an empty scope matches nothing.
    """
    lookup = members.select(*on, group)
    if scope is None:
        return scores.join(lookup, list(on), "left")
    return scores.join(in_scope(lookup, group, scope), list(on), "inner")


def in_scope(df: DataFrame, group: str, scope: Sequence[str] | None) -> DataFrame:
    if scope is None:
        return df
    return df.where(F.col(group).isin(*scope)) if scope else df.where(F.lit(False))


def filtered(
    df: DataFrame,
    batch_id=None,
    group_value: str | None = None,
    alerts_only: bool = False,
    batch: str = "batch_id",
    group: str = "filiere",
    alert: str = "alerte",
) -> DataFrame:
    """Batch, group and alert filters; the group text is cleaned and title-cased first."""
    out = df if batch_id is None else df.where(F.col(batch) == batch_id)
    if group_value is not None:
        wanted = X.title_key(X.clean_text(F.lit(group_value)))
        out = out.where(wanted.isNull() | (F.col(group) == wanted))
    return out.where(F.col(alert) == 1) if alerts_only else out


def visible_groups(df: DataFrame, group: str, scope: Sequence[str] | None = None) -> DataFrame:
    """Distinct named groups a reader may filter on."""
    return (
        in_scope(df, group, scope)
        .select(X.clean_text(group).alias(group))
        .where(F.col(group).isNotNull())
        .distinct()
    )


def counts(df: DataFrame, alert: str = "alerte") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(alert), F.lit(0)).cast("long").alias("alerts"),
    )


def risk_order(score: str, id_col: str) -> list[Column]:
    return [F.col(score).desc(), F.col(id_col).asc()]


def page(df: DataFrame, score: str, id_col: str, number: int, size: int) -> DataFrame:
    """One page by descending risk with ranks that run on across pages."""
    number = max(1, number)
    skipped = (number - 1) * size
    shown = df.orderBy(*risk_order(score, id_col)).offset(skipped).limit(size)
    # At most ``size`` rows reach this window.
    place = F.row_number().over(Window.orderBy(*risk_order(score, id_col)))
    return shown.withColumn("rank", (place + skipped).cast("long"))


def page_info(df: DataFrame, number: int, size: int) -> DataFrame:
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(size))) if size > 0 else F.lit(1)
    number = max(1, number)
    return (
        counts(df)
        .withColumn("pages", pages.cast("long"))
        .withColumn("has_previous", F.lit(number > 1))
        .withColumn("has_next", F.lit(number) < F.col("pages"))
    )


def ranked(df: DataFrame, score: str, id_col: str, name: str = "rank") -> DataFrame:
    """Every row with its risk rank (whole table; see ``global_rank``)."""
    return R.global_rank(df, risk_order(score, id_col), name)


def top(df: DataFrame, score: str, id_col: str, k: int) -> DataFrame:
    return df.orderBy(*risk_order(score, id_col)).limit(max(0, k))


def most_recent(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_coverage(df: DataFrame, score: str, id_col: str, k: int, alert: str = "alerte") -> DataFrame:
    """Alerts within the k highest scores, all alerts, and their ratio; ``df`` is computed once."""
    narrow = R.kept(df.select(score, id_col, alert))
    alerts = F.coalesce(F.sum(alert), F.lit(0)).cast("long")
    covered = top(narrow, score, id_col, k).agg(alerts.alias("covered"))
    # One row on either side.
    both = narrow.agg(alerts.alias("alerts")).join(F.broadcast(covered))
    return both.select("covered", "alerts", (F.col("covered") / F.nullif(F.col("alerts"), F.lit(0))).alias("coverage"))


def alerts_at(df: DataFrame, score: str, threshold: float) -> DataFrame:
    return df.agg(F.count_if(F.col(score) >= threshold).alias("alerts"))


def current_model(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Model version and threshold of the newest score."""
    newest = F.max_by(F.struct("model_version", "threshold"), id_col)
    return df.agg(newest.alias("m")).select(
        X.clean_text("m.model_version").alias("model_version"), F.col("m.threshold").alias("threshold")
    )


def group_statistics(
    df: DataFrame,
    group: str,
    score: str,
    alert: str,
    min_size: int = K.MIN_GROUP_SIZE,
    pool_label: str = K.SMALL_GROUPS_LABEL,
    unknown_label: str = K.UNKNOWN_GROUP_LABEL,
) -> DataFrame:
    """Size, alerts, median and upper decile per group, small groups pooled.

    Groups under ``min_size`` are published only together, and not at all when the pool
    is itself too small. ``hidden_groups`` counts the groups that were pooled.
    """
    # Three passes follow; a stored narrow table spares them the joins behind ``df``.
    named = R.kept(
        df.select(
            F.coalesce(X.clean_text(group), F.lit(unknown_label)).alias("_g"),
            F.col(score).alias("_s"), F.col(alert).alias("_a"),
        )
    )
    sizes = R.sized(
        named.groupBy("_g").agg(
            F.count(F.lit(1)).alias("_size"), F.count("_s").alias("_n"), F.sum("_a").cast("long").alias("alertes")
        )
    )
    pooled = F.col("_size") < min_size
    label = F.when(pooled, F.lit(pool_label)).otherwise(F.col("_g")).alias(group)
    rows = R.join_on(named, sizes.select("_g", "_size"), ["_g"]).select(label, pooled.alias("aggregated"), "_s")
    stats = R.order_statistics(
        rows, [group, "aggregated"], "_s",
        {**R.median_picks(), **R.upper_decile_picks()},
        measures={"alertes": F.sum("alertes")},
        count_name="effectif",
        sizes=sizes.groupBy(label, pooled.alias("aggregated")).agg(
            F.sum("_n").alias("_n"), F.sum("alertes").alias("alertes")
        ),
    )
    hidden = sizes.where(pooled).agg(F.count(F.lit(1)).alias("n"))
    return stats.where(F.col("effectif") >= min_size).select(
        group, "effectif", "alertes",
        (F.col("alertes") / F.col("effectif")).alias("taux_alerte"),
        R.median_value().alias("proba_mediane"),
        R.upper_decile_value("effectif").alias("proba_decile_sup"),
        "aggregated",
        hidden.scalar().alias("hidden_groups"),
    )


def presentation_order() -> list[Column]:
    """Pooled rows last, then the highest alert rate first."""
    return [F.col("aggregated").asc(), F.col("taux_alerte").desc()]


def fixed_histogram(df: DataFrame, score: str, bins: int = 10) -> DataFrame:
    """Counts per equal-width bin of [0, 1]; the last bin includes 1. Empty bins stay."""
    width = 1.0 / bins
    lows = [i * width for i in range(bins)]
    highs = [low + width for low in lows]
    inside = (F.col(score) >= 0.0) & (F.col(score) <= highs[-1])
    hits = (
        df.where(inside).groupBy(N.cut_index(score, lows[1:]).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = df.sparkSession.createDataFrame(
        [(i, lows[i], highs[i]) for i in range(bins)], "bin int, lower double, upper double"
    )
    return edges.join(hits, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def history(
    df: DataFrame, key: str, order: Sequence[str], score: str, slice_by: Column
) -> DataFrame:
    """Each score with the one before it, oldest first per key."""
    out = R.previous_row(df, [key], order, slice_by, [score])
    return out.withColumn("previous_score", F.col(f"previous.{score}")).drop("previous")


def history_trend(df: DataFrame, key: str, order: Sequence[str], score: str) -> DataFrame:
    """First, last and direction of change per key, as one aggregate."""
    at = F.struct(*order)
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("scores"),
            F.min_by(score, at).alias("first_score"),
            F.max_by(score, at).alias("last_score"),
        )
        .withColumn("delta", F.col("last_score") - F.col("first_score"))
        .withColumn(
            "trend", F.when(F.col("scores") > 1, N.trend("first_score", "last_score"))
        )
    )


def missing_parents(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Distinct child keys without a parent row."""
    return children.select(key).distinct().join(parents.select(key), key, "left_anti")


def split_survivors(batches: DataFrame, cutoff: Column, expires: str = "expires_at"):
    """(expired, surviving) batches: a deadline equal to the cutoff has passed."""
    gone = F.col(expires) <= cutoff
    return batches.where(gone), batches.where(~gone | F.col(expires).isNull())


def without_batches(rows: DataFrame, expired: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows of batches that are not expired; the id list is measured before it is broadcast,
    since a shuffle by batch would put a large batch into one task."""
    return rows.join(R.sized(expired.select(batch)), batch, "left_anti")
