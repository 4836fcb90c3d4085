"""Logistic propensity models: fit, score, evaluate, explain, save."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Propensity:
    """A fitted model with its label and source columns."""

    model: PipelineModel
    label: str
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical


def _numbers(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return df.withColumns({f"__num_{c}": F.col(c).cast("double") for c in numeric})


def fit_propensity(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str],
                   max_iter: int = 5, max_categories: int = 10_000) -> Propensity:
    """Logistic regression on a 0/1 label with one-hot texts and balanced class weights n / (2 n_class); missing numbers
    become the mean of their column, which the model keeps.

    Weights and checks come from one aggregation row; the fit itself aggregates gradients over the partitions. The
    distinct texts of a column come to the driver, so a column of more than about ``max_categories`` is refused.
    """
    row = df.agg(F.count(label).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"),
                 *[F.approx_count_distinct(c).alias(f"c{i}") for i, c in enumerate(categorical)],
                 *[F.count(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(numeric)]).first()
    n, pos = row["n"], row["pos"] or 0
    if pos in (0, n):
        raise ValueError("the label has one class only")
    if wide := [c for i, c in enumerate(categorical) if row[f"c{i}"] > max_categories]:
        raise ValueError(f"too many distinct texts in {wide}")
    if bare := [c for i, c in enumerate(numeric) if not row[f"v{i}"]]:
        raise ValueError(f"no value in {bare}")
    weight = F.when(F.col(label) == 1, n / (2 * pos)).otherwise(n / (2 * (n - pos)))
    rows = _numbers(df, numeric).withColumn("__weight", weight).withColumn("__label", F.col(label).cast("double"))
    idx, hot = [f"__idx_{c}" for c in categorical], [f"__hot_{c}" for c in categorical]
    stages = [StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                            stringOrderType="alphabetAsc"),
              OneHotEncoder(inputCols=idx, outputCols=hot)] if categorical else []
    filled = [f"__fill_{c}" for c in numeric]
    if numeric:
        stages.append(Imputer(strategy="mean", inputCols=[f"__num_{c}" for c in numeric], outputCols=filled))
    stages += [VectorAssembler(inputCols=filled + hot, outputCol="__features"),
               LogisticRegression(featuresCol="__features", labelCol="__label", weightCol="__weight",
                                  predictionCol="__prediction", probabilityCol="__probability",
                                  rawPredictionCol="__raw", maxIter=max_iter)]
    return Propensity(Pipeline(stages=stages).fit(rows), label, tuple(categorical), tuple(numeric))


def _transform(p: Propensity, df: DataFrame) -> DataFrame:
    return p.model.transform(_numbers(df, p.numeric))


def predict(p: Propensity, df: DataFrame) -> DataFrame:
    """All columns plus the predicted label and an array of (label, prob), the positive class first."""
    probs = vector_to_array("__probability")
    pair = lambda label: F.struct(F.lit(label).alias("label"), F.get(probs, F.lit(label)).alias("prob"))
    out = _transform(p, df)
    return out.select(*df.columns, F.col("__prediction").cast("int").alias(f"predicted_{p.label}"),
                      F.array(pair(1), pair(0)).alias(f"predicted_{p.label}_probs"))


def _sizes(p: Propensity) -> list[tuple[str, int]]:
    """Source columns in the order of the feature vector with their number of slots."""
    sizes = [(c, 1) for c in p.numeric]
    if p.categorical:
        sizes += list(zip(p.categorical, [s for s in p.model.stages[1].categorySizes], strict=True))
    # One-hot drops the last of the kept categories (the one for unseen texts).
    return [(c, n if c in p.numeric else n - 1) for c, n in sizes]


def _contributions(p: Propensity, df: DataFrame, background: DataFrame) -> tuple[DataFrame, list[str]]:
    lr = p.model.stages[-1]
    coef = [float(x) for x in lr.coefficients]
    mean = [float(x) for x in _transform(p, background).select(Summarizer.mean(F.col("__features"))).first()[0]]
    out = _transform(p, df).withColumn("__x", vector_to_array("__features"))
    names, start = [], 0
    for c, n in _sizes(p):
        w = F.array(*[F.lit(v) for v in coef[start:start + n]]) if n else F.array().cast("array<double>")
        m = sum(a * b for a, b in zip(coef[start:start + n], mean[start:start + n], strict=True))
        part = F.zip_with(F.slice("__x", start + 1, n), w, lambda x, k: x * k)
        out = out.withColumn(f"__c_{c}", F.aggregate(part, F.lit(0.0), lambda s, v: s + v) - F.lit(m))
        names.append(c)
        start += n
    base = float(lr.intercept) + sum(a * b for a, b in zip(coef, mean, strict=True))
    return out.withColumn("__base", F.lit(base)), names


def explain(p: Propensity, df: DataFrame, background: DataFrame, k: int = 3) -> DataFrame:
    """All columns plus probability, baseline and the ``k`` largest attributions per row.

    The model is linear in the logit: a source column adds coefficient times (value - mean), the one-hot
    slots of a text added together. Baseline plus all attributions is the logit.
    """
    out, names = _contributions(p, df, background)
    items = F.array(*[F.struct((-F.abs(F.col(f"__c_{c}"))).alias("o"), F.lit(c).alias("feature"),
                               F.col(f"__c_{c}").alias("attribution")) for c in names])
    top = F.transform(F.slice(F.array_sort(items), 1, k), lambda s: F.struct(s["feature"], s["attribution"]))
    total = F.aggregate(F.array(*[F.col(f"__c_{c}") for c in names]), F.col("__base"), lambda s, v: s + v)
    return out.select(*df.columns, F.get(vector_to_array("__probability"), F.lit(1)).alias("probability"),
                      F.col("__base").alias("baseline"), total.alias("logit"), top.alias("top_feature_attributions"))


def global_importance(p: Propensity, df: DataFrame) -> DataFrame:
    """Mean absolute attribution per source column."""
    out, names = _contributions(p, df, df)
    wide = out.agg(*[F.avg(F.abs(F.col(f"__c_{c}"))).alias(f"__g{i}") for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"__g{i}").alias("attribution"))
                     for i, c in enumerate(names)])
    return wide.select(F.inline(rows)).orderBy(F.col("attribution").desc(), "feature")


def evaluate(scored: DataFrame, label: str, prob: str, threshold: float = 0.5, buckets: int = 1000) -> DataFrame:
    """Precision, recall, accuracy, F1, log loss and the exact area under the ROC curve, as one row.

    The curve needs a running count over all scores. Scores are first counted per distinct value, then
    running counts are taken inside fixed score buckets and offset by the totals of the buckets below, so
    no task sees more than one bucket of distinct scores or the list of buckets.
    """
    y, s = F.col(label) == 1, F.col(prob)
    hit = s >= threshold
    clipped = F.least(F.greatest(s, F.lit(1e-15)), F.lit(1 - 1e-15))
    basic = scored.agg(
        F.count_if(y & hit).alias("tp"), F.count_if(~y & hit).alias("fp"), F.count_if(y & ~hit).alias("fn"),
        F.count_if(~y & ~hit).alias("tn"),
        F.avg(-F.when(y, F.log(clipped)).otherwise(F.log(1 - clipped))).alias("log_loss"))
    values = scored.groupBy(s.alias("s"), F.least(F.floor(s * buckets), F.lit(buckets - 1)).alias("b")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    # At most ``buckets`` rows: the one window without partition is over this list.
    below = values.groupBy("b").agg(F.sum("neg").alias("n")).withColumn(
        "below", F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("neg").over(Window.partitionBy("b").orderBy("s").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    ranked = values.withColumn("inside", inside).join(below.select("b", "below"), "b")
    wins = ranked.agg(F.sum(F.col("pos") * (2 * (F.col("below") + F.col("inside")) + F.col("neg"))).alias("w"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return basic.withColumn("w", wins.scalar()).select(
        F.try_divide(tp.cast("double"), tp + fp).alias("precision"), F.try_divide(tp.cast("double"), tp + fn).alias("recall"),
        F.try_divide((tp + tn).cast("double"), tp + fp + fn + tn).alias("accuracy"),
        F.try_divide((2 * tp).cast("double"), 2 * tp + fp + fn).alias("f1_score"), F.round("log_loss", 9).alias("log_loss"),
        F.try_divide(F.col("w").cast("double"), (2 * (tp + fn) * (fp + tn))).alias("roc_auc"))


def split(df: DataFrame, key: str, test_tenths: int = 2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a stable hash of the key."""
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(10))
    return df.where(bucket >= test_tenths), df.where(bucket < test_tenths)


def save_model(p: Propensity, root: str, version: str, metrics: DataFrame, spark: SparkSession) -> DataFrame:
    """Save a model version and append its metrics to the table of runs; returns the runs."""
    p.model.write().overwrite().save(f"{root}/models/{version}")
    run = metrics.withColumns({
        "version": F.lit(version), "label": F.lit(p.label), "features": F.lit(", ".join(p.features)),
        "saved_at": F.lit(datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")})
    run.write.mode("append").parquet(f"{root}/runs")
    return spark.read.parquet(f"{root}/runs")


def load_model(root: str, version: str, label: str, categorical: Sequence[str], numeric: Sequence[str]) -> Propensity:
    return Propensity(PipelineModel.load(f"{root}/models/{version}"), label, tuple(categorical), tuple(numeric))


def reason(items: str | Column, i: int) -> Column:
    """``feature (attribution)`` of the i-th attribution."""
    item = F.get(F.col(items) if isinstance(items, str) else items, F.lit(i))
    return F.concat(item["feature"], F.lit(" ("), item["attribution"].cast("decimal(18,3)").cast("string"), F.lit(")"))
