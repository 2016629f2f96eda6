"""Stratified splits, folds and class weights that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators import ordered as R


def split_hash(key, seed: int = 42) -> Column:
    """60-bit number from a row key; the same in every run and on every cluster."""
    x = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}|"), x.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _shares(n: Column) -> tuple[Column, Column]:
    return F.round(n * 0.2).cast("long"), F.round(n * 0.2).cast("long")


def stratified_split(
    df: DataFrame, label: str | None, key: str, seed: int = 42, name: str = "split_set"
) -> DataFrame:
    """60/20/20 labels with exact shares per class.

    The rank of a row's hash within its class decides. Instead of ranking a class in one
    task, the hashes at the two cut ranks are found exactly and compared with.
    """
    strata = F.col(label) if label else F.lit(0)
    hashed = df.withColumns({"_stratum": strata, "_h": split_hash(key, seed)})

    def test_rank(n: Column) -> Column:
        return _shares(n)[0]

    def validation_rank(n: Column) -> Column:
        return _shares(n)[0] + _shares(n)[1]

    cuts = R.order_statistics(
        hashed, ["_stratum"], "_h",
        {"_test": test_rank, "_validation": validation_rank},
    )
    # One row per class.
    marked = R.join_on(hashed, R.sized(cuts.select("_stratum", "_test", "_validation")), ["_stratum"])
    return marked.withColumn(
        name,
        F.when(F.col("_h") <= F.col("_test"), "test")
        .when(F.col("_h") <= F.col("_validation"), "validation")
        .otherwise("train"),
    ).drop("_stratum", "_h", "_test", "_validation")


def ranked_split(df: DataFrame, key: str, name: str = "split_set") -> DataFrame:
    """Hold out the ends of the key order: the last fifth for test, a quarter of the rest before it.

    Each held-out part has one row at least as long as one is left to train on. Positions are
    global ranks and the bounds are numbers, so any number of rows takes the same path.
    """
    n = df.count()
    test = max(1, round(n / 5)) if n > 1 else 0
    validation = max(1, round((n - test) / 4)) if n > 2 else 0
    ranked = R.global_rank(df, [F.col(key).asc_nulls_first()], "_rank")
    part = F.when(F.col("_rank") > n - test, "test").when(F.col("_rank") > n - test - validation, "validation")
    return ranked.withColumn(name, part.otherwise("train")).drop("_rank")


def split_policy(df: DataFrame, label: str) -> str:
    """``stratified``, ``shuffled`` or ``refused``, from one row of class statistics.

    Classes are shared out when each has two rows or more. That needs a test part, and while
    the smallest class keeps two rows also a validation part, with a row for every class.
    """
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    n, number, smallest = classes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1)), F.min("size")).first()
    test = -(-n // 5)
    validation = -(-(n - test) // 4)
    if n < 5 or number < 2 or smallest < 2:
        return "shuffled" if n >= 3 else "refused"
    left = smallest - round(smallest * 0.2)
    fits = min(test, n - test) >= number and (left < 2 or min(validation, n - test - validation) >= number)
    return "stratified" if fits else "refused"


def assign_split(
    df: DataFrame, label: str, key: str, seed: int = 42, allow_fallback: bool = False,
    name: str = "split_set",
) -> DataFrame:
    """Stratify when every class can be shared out, else shuffle, else fall back or refuse."""
    policy = split_policy(df, label)
    if policy == "refused" and not allow_fallback:
        raise ValueError("too few rows for the number of classes")
    if policy == "refused":
        return ranked_split(df, key, name)
    return stratified_split(df, label if policy == "stratified" else None, key, seed, name)


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold numbers whose class shares differ by one row at most.

    Rows are ranked by (class, hash of the key); neighbours go to different folds, so each
    class is dealt out evenly wherever its ranks begin.
    """
    # The hash is a column: a sort works out an expression anew in every comparison of two rows.
    hashed = df.withColumn("_h", split_hash(key, seed + 1))
    ranked = R.global_rank(hashed, [F.col(label).asc_nulls_first(), F.col("_h"), F.col(key)], "_rank")
    return ranked.withColumn(name, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank", "_h")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (classes * class size) per class."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    whole = sizes.agg((F.sum("size") / F.count(F.lit(1))).alias("w")).scalar()
    return sizes.withColumn("weight", whole / F.col("size"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = R.sized(class_weights(df, label).select(label, F.col("weight").alias(name)))
    return R.join_on(df, weights, [label])


def split_counts(df: DataFrame, label: str, name: str = "split_set") -> DataFrame:
    return df.groupBy(name, label).agg(F.count(F.lit(1)).alias("n"))


def rows_in(df: DataFrame, part: str, name: str = "split_set") -> DataFrame:
    return df.where(F.col(name) == part)


__all__: Sequence[str] = [
    "split_hash", "stratified_split", "ranked_split", "split_policy", "assign_split", "stratified_folds",
    "class_weights", "with_class_weights", "split_counts", "rows_in",
]
