"""Fit, choose the threshold by cost, measure, score and explain with Spark ML."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier,
)
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StandardScaler, StandardScalerModel, StringIndexer, StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom import constants as K
from riskloom.functions import numbers as N
from riskloom.operators import (
    cleaning as CL, explain as E, ordered as R, perimeter as PM, quality as Q,
    scoring_metrics as M, splitting as S,
)
from riskloom.operators.lineage import traced

#: Folds that are fitted side by side.
FOLDS_AT_ONCE = 5
#: Feature values (rows x columns) worth a task of their own in a fit, and the most that one task should take.
FIT_VALUES = 1_000_000, 5_000_000
FEATURES = "features"


@dataclass
class ModelBundle:
    """A fitted pipeline with everything scoring needs to repeat the preparation."""

    model: PipelineModel
    feature_cols: list[str]
    threshold: float
    catalogue: DataFrame | None = None
    since: date | None = None
    metadata: dict[str, Any] = field(default_factory=dict)

    @property
    def version(self) -> str | None:
        return self.metadata.get("model_version") or self.metadata.get("trained_at")

    def save(self, path: str) -> None:
        root = path.rstrip("/")
        self.model.write().overwrite().save(f"{root}/model")
        if self.catalogue is not None:
            self.catalogue.write.mode("overwrite").parquet(f"{root}/catalogue")
        card = {
            "feature_cols": self.feature_cols, "threshold": self.threshold, "metadata": self.metadata,
            "since": self.since.isoformat() if self.since else None,
            "has_catalogue": self.catalogue is not None,
        }
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(card, default=str),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{root}/card")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ModelBundle:
        root = path.rstrip("/")
        card = json.loads(spark.read.text(f"{root}/card").first()[0])
        return cls(
            PipelineModel.load(f"{root}/model"), card["feature_cols"], card["threshold"],
            spark.read.parquet(f"{root}/catalogue") if card["has_catalogue"] else None,
            date.fromisoformat(card["since"]) if card["since"] else None, card["metadata"],
        )


@dataclass
class TrainingResult:
    bundle: ModelBundle
    metrics: dict[str, Any]
    scored: DataFrame


# --- preprocessing ----------------------------------------------------------


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median of each numeric column; 0 for a column without values."""
    rows = Q.long_form(df, columns, kind="double").where(F.col("value").isNotNull())
    found = R.order_statistics(rows, ["column"], "value", R.median_picks()).select(
        "column", R.median_value().alias("m")
    )
    known = {r["column"]: r["m"] for r in found.collect()}  # one row per column
    return {c: known.get(c, 0.0) for c in columns}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent text of each column, the smallest among equals."""
    rows = Q.long_form(df, columns).where(F.col("value").isNotNull())
    counted = rows.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("column").agg(F.max("n").alias("n"))
    tied = counted.join(best, ["column", "n"]).groupBy("column").agg(F.min("value").alias("v"))
    known = {r["column"]: r["v"] for r in tied.collect()}  # one row per column
    return {c: known.get(c, "") for c in columns}


Fills = tuple[dict[str, float], dict[str, str]]


def fills_by_fold(df: DataFrame, features: Sequence[str], fold: str, folds: int) -> dict[int | None, Fills]:
    """``medians`` and ``modes`` of all rows (key None) and of the rows outside each fold.

    The values of a fold are counted once; what lies outside of it is the sum of the others' counts.
    """
    numeric, other = PM.split_by_type(df, features)
    parts = range(folds) if folds > 1 else ()
    outside = F.array(*[F.lit(i) for i in (-1, *parts)])

    def counted(columns: Sequence[str], kind: str) -> DataFrame:
        rows = Q.long_form(df, columns, keep=[fold], kind=kind).where(F.col("value").isNotNull())
        sums = R.stored(rows.groupBy("column", fold, "value").agg(F.count(F.lit(1)).alias("_c")))
        return sums.select("column", "value", "_c", F.explode(F.filter(outside, lambda i: i != F.col(fold))).alias("_set"))

    middle: dict = {}
    common: dict = {}
    if numeric:
        found = R.order_statistics(counted(numeric, "double"), ["column", "_set"], "value", R.median_picks(), weight="_c")
        # One row per column and fold, here and below.
        middle = {(r["_set"], r["column"]): r["m"] for r in found.select("column", "_set", R.median_value().alias("m")).collect()}
    if other:
        sums = R.kept(counted(other, "string").groupBy("column", "_set", "value").agg(F.sum("_c").alias("n")))
        best = sums.groupBy("column", "_set").agg(F.max("n").alias("n"))
        tied = sums.join(best, ["column", "_set", "n"]).groupBy("column", "_set").agg(F.min("value").alias("v"))
        common = {(r["_set"], r["column"]): r["v"] for r in tied.collect()}
    return {
        None if i < 0 else i: ({c: middle.get((i, c), 0.0) for c in numeric}, {c: common.get((i, c), "") for c in other})
        for i in (-1, *parts)
    }


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def preprocessing_stages(df: DataFrame, features: Sequence[str], fills: Fills | None = None) -> list:
    """Fill, scale and one-hot stages fitted on ``df``; ``fills``: its medians and modes where they are known.

    Numbers: exact median, then standardisation. Texts: mode, then one column per value,
    all zero for a value unseen in training (the extra slot never occurs there, so its
    coefficient stays 0).
    """
    numeric, other = PM.split_by_type(df, features)
    middle, common = fills or (medians(df, numeric), modes(df, other))
    filled = [f"coalesce(nullif(cast(`{c}` as double), double('NaN')), {middle[c]!r}D) AS `num__{c}`" for c in numeric]
    filled += [f"coalesce(cast(`{c}` as string), {_sql_text(common[c])}) AS `cat__{c}`" for c in other]
    stages: list = [SQLTransformer(statement="SELECT *, " + ", ".join(filled) + " FROM __THIS__")]
    parts = []
    if numeric:
        stages += [
            VectorAssembler(inputCols=[f"num__{c}" for c in numeric], outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ]
        parts.append("_scaled")
    if other:
        stages += [
            StringIndexer(
                inputCols=[f"cat__{c}" for c in other], outputCols=[f"_ix_{c}" for c in other],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"_ix_{c}" for c in other], outputCols=[f"_oh_{c}" for c in other],
                dropLast=False,
            ),
        ]
        parts += [f"_oh_{c}" for c in other]
    return [*stages, VectorAssembler(inputCols=parts, outputCol=FEATURES)]


def transformed_names(bundle: ModelBundle) -> list[str]:
    """Name of every slot of the feature vector."""
    names: list[str] = []
    for stage in bundle.model.stages:
        if isinstance(stage, VectorAssembler) and stage.getOutputCol() == "_numbers":
            names += stage.getInputCols()
        if isinstance(stage, StringIndexerModel):
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                # one slot per label and one for unknown values
                names += [f"{column}_{label}" for label in labels]
                names += [f"{column}___unknown"]
    return names


# --- fitting ----------------------------------------------------------------


def fit_partitions(values: int, cores: int, at_once: int) -> int:
    """Partitions for the vectors of one of ``at_once`` fits that run side by side.

    Every step of a fit is a job that waits for all its tasks and for a tree over their sums, so few
    rows take few tasks; many take the fit's share of the cores, and more once a task would hold too much.
    """
    few, many = (-(-values // most) for most in FIT_VALUES)
    return max(1, many, min(few, -(-cores // at_once)))


def fit_logistic(
    train: DataFrame, features: Sequence[str], label: str, key: str,
    c_grid: Sequence[float] = tuple(K.C_GRID), folds: int = K.CV_FOLDS, seed: int = 42,
) -> tuple[PipelineModel, float, float]:
    """(model, best C, mean validation AUC) of a balanced L2 logistic regression.

    ``regParam`` is 1/(C n) with the n of the rows fitted: the loss is averaged here and summed in
    the usual C form. Preprocessing is fitted anew in every fold. The columns in use are stored once,
    so no later pass repeats what made them; a fold's vectors stay in memory (or spill) for its fits.
    One count of the values gives the fills of all folds, and the held rows' scores by all models are
    stored and measured together. A fold whose held rows have one class has no AUC and doesn't count.
    """
    used = R.stored(train.select(*dict.fromkeys([*features, label, key])))
    rows = S.stratified_folds(S.with_class_weights(used, label, "_weight"), label, key, folds, seed, "_fold")
    rows = R.stored(rows.withColumn("_label", F.col(label).cast("double")), spread=True)
    lr = LogisticRegression(
        featuresCol=FEATURES, labelCol="_label", weightCol="_weight", maxIter=200,
        standardization=False, elasticNetParam=0.0,
    )
    fills = fills_by_fold(rows, features, "_fold", folds)
    total, at_once = rows.count(), max(1, min(folds, FOLDS_AT_ONCE))
    parts = fit_partitions(total * len(features) * (folds - 1) // folds, rows.sparkSession.sparkContext.defaultParallelism, at_once)

    def validated(fold: int) -> DataFrame:
        # Fills, scales and value lists come from the fold's own training rows.
        inner = rows.where(F.col("_fold") != fold)
        prepared = Pipeline(stages=preprocessing_stages(inner, features, fills[fold])).fit(inner)
        inner = prepared.transform(inner).select(FEATURES, "_label", "_weight").coalesce(parts).persist()
        n = inner.count()
        scored = prepared.transform(rows.where(F.col("_fold") == fold)).select("_fold", "_label", FEATURES)
        for place, model in lr.fitMultiple(inner, [{lr.regParam: 1.0 / (c * n)} for c in c_grid]):
            # The measure needs the raw score only.
            scored = model.setProbabilityCol("").setPredictionCol("").setRawPredictionCol(f"_raw{place}").transform(scored)
        raw = [vector_to_array(f"_raw{place}")[1].alias(str(place)) for place in range(len(c_grid))]
        scored = R.stored(scored.select("_fold", "_label", *raw), "held")
        inner.unpersist()
        return scored

    # Folds run side by side; each is a chain of small jobs.
    means = dict.fromkeys(c_grid, float("nan"))
    if folds > 1:
        with ThreadPool(at_once) as pool:
            scored = pool.map(inheritable_thread_target(rows.sparkSession)(validated), range(folds), chunksize=1)
        held = Q.long_form(reduce(DataFrame.unionByName, scored), [str(i) for i in range(len(c_grid))], ["_fold", "_label"], "double", "place")
        # One row per fold and C.
        areas = M.roc_auc(held, "_label", "value", ["place", "_fold"]).where("auc IS NOT NULL").orderBy("_fold").collect()
        for place, c in enumerate(c_grid):
            found = [r["auc"] for r in areas if r["place"] == str(place)]
            means[c] = sum(found) / len(found) if found else float("nan")
    best = max(c_grid, key=lambda c: means[c]) if folds > 1 else c_grid[0]
    stages = [*preprocessing_stages(rows, features, fills[None]), lr.setRegParam(1.0 / (best * total))]
    return Pipeline(stages=stages).fit(rows), best, means[best]


def with_probability(df: DataFrame, model: PipelineModel, name: str = "proba_abandon") -> DataFrame:
    return model.transform(df).withColumn(name, vector_to_array("probability")[1])


def measure(scored: DataFrame, label: str, score: str, threshold: float, subgroups: Sequence[str]) -> dict[str, float]:
    """Test metrics as driver scalars; each is one distributed aggregate."""
    flagged = scored.withColumn("_flag", N.alert_flag(score, threshold))
    pr = M.precision_recall(flagged, label, "_flag").first()
    present = [c for c in subgroups if c in scored.columns]
    gap = M.largest_recall_gap(flagged, present, label, "_flag").first()[0] if present else 0.0
    return {
        "auc_test": M.roc_auc(scored, label, score).first()["auc"],
        "average_precision_test": M.average_precision(scored, label, score).first()[0],
        "recall_test": pr["recall"], "precision_test": pr["precision"], "f1_test": pr["f1"],
        "fairness_recall_gap_test": gap,
    }


def train_gold(
    gold: DataFrame, features: Sequence[str], label: str, key: str, seed: int = 42,
    subgroups: Sequence[str] = ("sexe", "boursier"), cost_fn: float = K.COST_FALSE_NEGATIVE,
    cost_fp: float = K.COST_FALSE_POSITIVE, c_grid: Sequence[float] = tuple(K.C_GRID), folds: int = K.CV_FOLDS,
) -> TrainingResult:
    """Fit on train, choose the cut-off on validation, report on the untouched test part."""
    PM.assert_not_derived(gold, features, {label, *PM.FORBIDDEN})
    split = gold if "split_set" in gold.columns else S.assign_split(gold, label, key, seed)
    split = R.kept(split)
    sizes = {r[0]: r[1] for r in split.groupBy("split_set").count().collect()}
    model, best_c, auc_cv = fit_logistic(S.rows_in(split, "train"), features, label, key, c_grid, folds, seed)
    scored = R.kept(
        with_probability(S.rows_in(split, "validation").unionByName(S.rows_in(split, "test")), model).select(
            *split.columns, "proba_abandon"
        )
    )
    chosen = M.cheapest_threshold(
        S.rows_in(scored, "validation"), label, "proba_abandon", cost_fn=cost_fn, cost_fp=cost_fp
    ).first()
    threshold = float(chosen["threshold"])
    at = datetime.now(timezone.utc)
    metrics: dict[str, Any] = {
        "trained_at": at.isoformat(timespec="seconds"), "model_version": f"local-{at:%Y%m%d-%H%M%S}",
        "auc_cv": auc_cv, **measure(S.rows_in(scored, "test"), label, "proba_abandon", threshold, subgroups),
        "threshold": threshold, "threshold_selection": "validation_cost_minimization",
        "threshold_validation_stats": {k: float(v) for k, v in chosen.asDict().items() if k != "threshold"},
        "best_params": {"C": best_c}, "cost_fn_fp": [cost_fn, cost_fp],
        "settings": {
            "model_class": type(model.stages[-1]).__name__, "folds": folds, "chosen_C": best_c, "classes": "weighted",
            "cost_false_negative": cost_fn, "cost_false_positive": cost_fp, "columns": len(features),
        },
        "n_train": sizes.get("train", 0), "n_validation": sizes.get("validation", 0),
        "n_test": sizes.get("test", 0), "n_features": len(features),
    }
    return TrainingResult(ModelBundle(model, list(features), threshold, metadata=metrics), metrics, scored)


def train(
    raw: DataFrame, catalogue: DataFrame, seed: int = 42, key: str = "student_id", **options
) -> TrainingResult:
    """Whole workflow from raw records."""
    cleaned = R.kept(traced(CL.clean(raw)))
    since = CL.first_day(cleaned) if "date_inscription_parsed" in cleaned.columns else None
    prepared = CL.add_features(CL.enrich(cleaned, catalogue), since)
    features = PM.feature_columns(prepared)
    gold = PM.gold(prepared, keep=K.ID_COLS).withColumn(K.TARGET_CLF, F.col(K.TARGET_CLF).cast("int"))
    result = train_gold(gold, features, K.TARGET_CLF, key, seed, **options)
    result.bundle.catalogue, result.bundle.since = catalogue, since
    return result


# --- a fitted model as tables -------------------------------------------------


def parameters(bundle: ModelBundle) -> DataFrame:
    """A linear model as rows: ``slot, column, value, fill, centre, scale, weight``.

    One row per number (with the fill, mean and deviation it was fitted with), one per text value
    (``value``; ``fill`` is the column's most frequent text), one for values unseen in training and the
    intercept (``column`` null). The rows are as many as the model has coefficients.
    """
    if not can_explain(bundle):
        raise ValueError("only a linear model can be written as a table of weights")
    spark, linear = SparkSession.active(), bundle.model.stages[-1]
    numbers: list[str] = []
    texts: list[tuple[str, Sequence[str]]] = []
    centre = scale = ()
    for stage in bundle.model.stages:
        if isinstance(stage, VectorAssembler) and stage.getOutputCol() == "_numbers":
            numbers = stage.getInputCols()
        elif isinstance(stage, StandardScalerModel):
            centre, scale = stage.mean.toArray().tolist(), stage.std.toArray().tolist()
        elif isinstance(stage, StringIndexerModel):
            texts = list(zip(stage.getInputCols(), stage.labelsArray))
    # What the fill stage makes of a record without values.
    absent = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in bundle.feature_cols])
    fills = bundle.model.stages[0].transform(absent).first().asDict()
    weights = iter(linear.coefficients.toArray().tolist())
    rows = [(n, n.split("__", 1)[1], None, str(fills[n]), m, d, next(weights)) for n, m, d in zip(numbers, centre, scale)]
    for name, labels in texts:
        column = name.split("__", 1)[1]
        rows += [(f"{name}_{v}", column, v, fills[name], None, None, next(weights)) for v in labels]
        rows.append((f"{name}___unknown", column, None, fills[name], None, None, next(weights)))
    rows.append(("intercept", None, None, None, None, None, float(linear.intercept)))
    return spark.createDataFrame(rows, "slot string, column string, value string, fill string, centre double, scale double, weight double")


def score_by_table(gold: DataFrame, table: DataFrame, key: str, name: str = "proba_abandon") -> DataFrame:
    """``key`` and probability from a parameter table: a long form, a join by column and a sum.

    A model written once can so be applied where no model library is. Keys must be unique.
    """
    # One row per coefficient.
    known = table.where(F.col("column").isNotNull())
    columns = [r[0] for r in known.select("column").distinct().orderBy("column").collect()]
    rows = gold.select(F.col(key), *[(F.col(c) if c in gold.columns else F.lit(None)).cast("string").alias(c) for c in columns if c != key])
    long = Q.long_form(rows, columns, keep=[key])
    numbers = known.where("centre IS NOT NULL").select("column", "fill", "centre", "scale", "weight")
    texts = known.where("centre IS NULL AND value IS NOT NULL").select("column", F.col("value").alias("text"), "weight")
    first = known.where("centre IS NULL").groupBy("column").agg(F.max("fill").alias("fill"))
    x = F.coalesce(F.nullif(F.col("value").try_cast("double"), F.lit(float("nan"))), F.col("fill").cast("double"))
    scaled = F.when(F.col("scale") > 0, (x - F.col("centre")) / F.col("scale")).otherwise(F.lit(0.0))
    parts = long.join(F.broadcast(numbers), "column").select(key, (scaled * F.col("weight")).alias("part"))
    worded = long.join(F.broadcast(first), "column").withColumn("text", F.coalesce("value", "fill")).drop("fill")
    parts = parts.unionByName(worded.join(F.broadcast(texts), ["column", "text"], "left").select(key, F.coalesce("weight", F.lit(0.0)).alias("part")))
    intercept = table.where(F.col("column").isNull()).select("weight").scalar()
    return parts.groupBy(key).agg(F.sum("part").alias("_sum")).select(key, E.probability(F.col("_sum") + intercept).alias(name))


def gradient(rows: DataFrame, bundle: ModelBundle, label: str, c: float) -> DataFrame:
    """``slot, gradient`` of the weighted, L2-regularised loss at the stored coefficients.

    The loss is convex, so a fit is the optimum just where its gradient vanishes; the intercept
    is not regularised. ``rows``: the rows the model was fitted on. One pass, one number per slot.
    """
    weighted = S.with_class_weights(rows, label, "_weight")
    linear, names = bundle.model.stages[-1], transformed_names(bundle)
    scored = bundle.model.transform(weighted).select(
        vector_to_array(FEATURES).alias("_x"), vector_to_array("probability")[1].alias("_p"), F.col(label).cast("double").alias("_y"), F.col("_weight").alias("_w"),
    )
    error = F.col("_w") * (F.col("_p") - F.col("_y"))
    long = scored.select("_w", F.posexplode(F.array_append(F.transform("_x", lambda x: x * error), error)).alias("place", "part"))
    weights = [float(w) for w in linear.coefficients.toArray()]
    slots = rows.sparkSession.createDataFrame([(i, n, w) for i, (n, w) in enumerate(zip([*names, "intercept"], [*weights, 0.0]))], "place int, slot string, weight double")
    summed = long.groupBy("place").agg(F.sum("part").alias("_s"), F.sum("_w").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    return summed.join(F.broadcast(slots), "place").select("slot", (F.col("_s") / F.col("_n") + F.col("weight") / (F.lit(float(c)) * F.col("_rows"))).alias("gradient"))


# --- scoring and explaining -------------------------------------------------


def prepare_features(raw: DataFrame, bundle: ModelBundle, keep: Sequence[str] = ()) -> DataFrame:
    """The model's feature columns for raw records; one row out per row in."""
    df = CL.clean(raw, drop_duplicates=False)
    if bundle.catalogue is not None:
        df = CL.enrich(df, bundle.catalogue)
    df = CL.add_features(df, bundle.since)
    return PM.reindex(df, bundle.feature_cols, keep)


def score(raw: DataFrame, bundle: ModelBundle, keep: Sequence[str] = ()) -> DataFrame:
    """``proba_abandon`` and ``alerte`` per raw record, with carried columns."""
    return score_gold(prepare_features(raw, bundle, keep), bundle, keep)


def score_gold(gold: DataFrame, bundle: ModelBundle, keep: Sequence[str] = ()) -> DataFrame:
    scored = with_probability(PM.reindex(gold, bundle.feature_cols, keep), bundle.model)
    return scored.select(
        *keep, "proba_abandon", N.alert_flag("proba_abandon", bundle.threshold).alias("alerte")
    )


def can_explain(bundle: ModelBundle) -> bool:
    stages = getattr(bundle.model, "stages", None)
    return bool(stages) and isinstance(stages[-1], LogisticRegressionModel)


def explain(gold: DataFrame, bundle: ModelBundle, keep: Sequence[str] = ()) -> DataFrame:
    """Contributions of every transformed feature, log-odds and probability, all rows."""
    if not can_explain(bundle):
        raise ValueError("only a linear model can be decomposed exactly")
    linear = bundle.model.stages[-1]
    names, weights = transformed_names(bundle), [float(w) for w in linear.coefficients.toArray()]
    rows = bundle.model.transform(PM.reindex(gold, bundle.feature_cols, keep))
    out = E.vector_contributions(rows, FEATURES, names, weights)
    total = F.aggregate("contributions", F.lit(float(linear.intercept)), lambda acc, c: acc + c["contribution"])
    return out.withColumn("log_odds", total).select(
        *dict.fromkeys([*keep, *bundle.feature_cols]), "contributions",
        F.lit(float(linear.intercept)).alias("intercept"), "log_odds",
        E.probability(F.col("log_odds")).alias("proba"),
    )


def explanation_sheet(raw: DataFrame, bundle: ModelBundle, keep: Sequence[str], n: int = 5) -> DataFrame:
    """Display-ready risk and protective factors per record."""
    explained = explain(prepare_features(raw, bundle, keep), bundle, keep)
    return E.factor_sheet(explained, keep, bundle.feature_cols, n)


def source_contributions(explained: DataFrame, bundle: ModelBundle) -> DataFrame:
    """``shares``: contribution of each source column, its one-hot slots added up."""
    names = [n.split("__", 1)[1] for n in transformed_names(bundle)]
    slots: dict[str, list[int]] = {c: [] for c in bundle.feature_cols}
    for position, name in enumerate(names, start=1):
        matching = [c for c in bundle.feature_cols if name == c or name.startswith(f"{c}_")]
        slots[max(matching, key=len)].append(position)

    def share(positions: list[int]) -> Column:
        total = F.lit(0.0)
        for p in positions:
            total = total + F.element_at("contributions", p)["contribution"]
        return total

    return explained.withColumn("shares", F.array(*[share(slots[c]) for c in bundle.feature_cols]))


# --- comparisons ------------------------------------------------------------


def compare_candidates(
    train_rows: DataFrame, validation: DataFrame, features: Sequence[str], label: str, key: str,
    trees: int = 300, boosting_rounds: int = 400, seed: int = 42,
) -> DataFrame:
    """Validation metrics of a prior-rate baseline, a linear model, a forest and boosting."""
    rows = R.kept(
        S.with_class_weights(train_rows, label, "_weight").withColumn("_label", F.col(label).cast("double"))
    )
    prior = float(rows.agg(F.avg("_label")).first()[0])
    stages = preprocessing_stages(rows, features)
    common = dict(featuresCol=FEATURES, labelCol="_label", weightCol="_weight")
    families = {
        "logistic": LogisticRegression(standardization=False, regParam=1.0 / rows.count(), **common),
        "forest": RandomForestClassifier(numTrees=trees, seed=seed, **common),
        "boosting": GBTClassifier(maxIter=boosting_rounds, maxDepth=4, stepSize=0.05, subsamplingRate=0.9, seed=seed, **common),
    }
    # The baseline draws a class with the training share, from a hash of the key.
    drawn = F.pmod(S.split_hash(key, seed), F.lit(1_000_000)) < F.lit(int(prior * 1_000_000))
    scored = {"baseline": validation.withColumn("_p", drawn.cast("double"))}
    for name, estimator in families.items():
        model = Pipeline(stages=[*stages, estimator]).fit(rows)
        scored[name] = with_probability(validation, model, "_p")
    out = None
    for name, df in scored.items():
        one = df.select(F.lit(name).alias("model"), F.col(label).alias("label"), F.col("_p").alias("score"))
        out = one if out is None else out.unionByName(one)
    out = R.kept(out)
    flagged = out.withColumn("flag", N.alert_flag("score", 0.5))
    return (
        M.roc_auc(out, "label", "score", ["model"]).select("model", "auc")
        .join(M.average_precision(out, "label", "score", ["model"]), "model")
        .join(M.precision_recall(flagged, "label", "flag", ["model"]).select("model", "precision", "recall", "f1"), "model")
    )


def compare_regressors(
    train_rows: DataFrame, test: DataFrame, features: Sequence[str], target: str, trees: int = 300, seed: int = 42
) -> DataFrame:
    """MAE, RMSE and R2 of ridge regression and a random forest."""
    rows = R.kept(train_rows.where(F.col(target).isNotNull()).withColumn("_y", F.col(target).cast("double")))
    stages = preprocessing_stages(rows, features)
    families = {
        "ridge": LinearRegression(
            featuresCol=FEATURES, labelCol="_y", elasticNetParam=0.0, standardization=False,
            regParam=1.0 / max(1, rows.count()),
        ),
        "forest": RandomForestRegressor(featuresCol=FEATURES, labelCol="_y", numTrees=trees, seed=seed),
    }
    out = None
    for name, estimator in families.items():
        model = Pipeline(stages=[*stages, estimator]).fit(rows)
        one = model.transform(test).select(F.lit(name).alias("model"), F.col(target).alias("y"), "prediction")
        out = one if out is None else out.unionByName(one)
    return M.regression_metrics(out, "y", "prediction", ["model"])
