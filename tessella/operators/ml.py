"""A stacked classifier with MLlib: a linear model's out-of-fold margins under boosted trees, and labels cleaned by models that have not seen them.

Rows have a key, y (0.0 or 1.0), fold (0 to folds - 1), x (a vector) and numbers for the second stage. Every model is fitted by
Spark over all rows of its folds; nothing but class counts and models comes to the driver.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import HashingTF, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella import session

FOLDS = 5
SHRINK = 0.02  # of the linear model: the weight of its losses' sum against half its coefficients' squares
DEPTH, TREES = 3, 20
DOUBT = 0.3  # positives to which models without them give less are dropped
WORDS = 512  # hashed words


def _weighted(rows: DataFrame) -> tuple[DataFrame, int]:
    """rows with weight, which makes both classes count the same, and how many they are."""
    n = {int(r["y"]): r["count"] for r in rows.groupBy("y").count().collect()}  # a row a class
    total = sum(n.values())
    share = lambda k: total / (2 * max(n.get(k, 0), 1))
    return rows.withColumn("weight", F.when(F.col("y") == 1, share(1)).otherwise(share(0))), total


def linear(rows: DataFrame) -> Model:
    """Scaled x, then a logistic regression with balanced classes. Its intercept, which nothing shrinks, does what centring x would, and sparse vectors stay sparse."""
    rows, n = _weighted(rows)
    regression = LogisticRegression(featuresCol="x_", labelCol="y", weightCol="weight", regParam=1 / (SHRINK * max(n, 1)), maxIter=100, rawPredictionCol="raw_", probabilityCol="prob_", predictionCol="pred_")
    return Pipeline(stages=[StandardScaler(inputCol="x", outputCol="x_"), regression]).fit(rows)


def with_margin(model: Model, rows: DataFrame) -> DataFrame:
    """rows and margin, positive for class 1."""
    return model.transform(rows).withColumn("margin", vector_to_array("raw_")[1]).select(*rows.columns, "margin")


def trees(extra: list[str]) -> Callable[[DataFrame], Model]:
    """Boosted trees over the margin and the numbers of `extra`, with balanced classes."""

    def fit(rows: DataFrame) -> Model:
        boosted = GBTClassifier(featuresCol="z_", labelCol="y", weightCol="weight", maxDepth=DEPTH, maxIter=TREES, seed=1, predictionCol="pred_")
        boosted.setRawPredictionCol("raw_").setProbabilityCol("prob_")
        return Pipeline(stages=[VectorAssembler(inputCols=["margin", *extra], outputCol="z_"), boosted]).fit(_weighted(rows)[0])

    return fit


def with_score(model: Model, rows: DataFrame) -> DataFrame:
    """rows and score, the probability of class 1."""
    return model.transform(rows).withColumn("score", vector_to_array("prob_")[1]).select(*rows.columns, "score")


def out_of_fold(rows: DataFrame, fit: Callable[[DataFrame], Model], apply: Callable[[Model, DataFrame], DataFrame], folds: int = FOLDS) -> DataFrame:
    """Each fold's rows as the model of the other folds sees them."""
    out = None
    for k in range(folds):
        part = apply(fit(rows.filter(F.col("fold") != k)), rows.filter(F.col("fold") == k))
        out = part if out is None else out.unionByName(part)
    return session.cut(out)


@dataclass
class Stacked:
    """Both stages. held: the rows that they were fitted on, with their out-of-fold margins."""

    first: Model
    second: Model
    held: DataFrame

    def score(self, rows: DataFrame) -> DataFrame:
        """rows with margin and score."""
        return with_score(self.second, with_margin(self.first, rows))

    def accuracy(self) -> float:
        """Share of the rows whose out-of-fold margin has their label's sign."""
        return self.held.agg(F.avg(((F.col("margin") > 0) == (F.col("y") == 1)).cast("double"))).first()[0] or 0.0


def fit_stacked(rows: DataFrame, extra: list[str], folds: int = FOLDS) -> Stacked:
    """The second stage learns from margins of linear models that have not seen their rows."""
    held = out_of_fold(rows, linear, with_margin, folds)
    return Stacked(linear(rows), trees(extra)(held), held)


def fit_clean(rows: DataFrame, extra: list[str], doubt: float = DOUBT, folds: int = FOLDS) -> tuple[Stacked, DataFrame]:
    """Both stages fitted on the labels that are left when positives are dropped to which both stages, fitted without their fold, give less
    than `doubt`; and all rows with that out-of-fold margin and score, and kept."""
    held = out_of_fold(rows, linear, with_margin, folds)
    judged = out_of_fold(held, trees(extra), with_score, folds).withColumn("kept", ~((F.col("y") == 1) & (F.col("score") < doubt)))
    return fit_stacked(session.cut(judged.filter("kept").select(*rows.columns)), extra, folds), judged


EXTRA = ["n_chars", "distinct"]


def document_rows(docs: DataFrame, labels: DataFrame, label: Column) -> DataFrame:
    """Hashed words, length and share of different words of the labelled documents; folds by the id's CRC-32."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    rows = docs.select("doc_id", text.alias("text")).join(labels.select("doc_id", label.cast("double").alias("y")).filter("y is not null"), "doc_id")
    rows = rows.select("doc_id", "y", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)).alias("fold"), words.alias("w"), F.log1p(F.length("text")).alias("n_chars"), (F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))).alias("distinct"))
    return session.cut(HashingTF(inputCol="w", outputCol="x", numFeatures=WORDS).transform(rows).drop("w"))


def held_out_accuracy(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """quality, accuracy and n: how many of each label's documents the first stage, fitted without their fold, puts on their label's side."""
    with session.scratch(docs.sparkSession):
        held = out_of_fold(document_rows(docs, labels, F.col("quality")), linear, with_margin)
        right = ((F.col("margin") > 0) == (F.col("y") == 1)).cast("double")
        return held.groupBy(F.col("y").cast("int").alias("quality")).agg(F.avg(right).alias("accuracy"), F.count("*").alias("n")).checkpoint(eager=True)


def stacked_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality, oof (the first stage's out-of-fold probability) and score (of both stages) of labelled documents."""
    with session.scratch(docs.sparkSession):
        model = fit_stacked(document_rows(docs, labels, F.col("quality")), EXTRA)
        out = with_score(model.second, model.held)
        return out.select("doc_id", F.col("y").cast("int").alias("quality"), (1 / (1 + F.exp(-F.col("margin")))).alias("oof"), "score").checkpoint(eager=True)


def cleaned_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality, oof (of both stages), kept (false: a positive that other folds do not bear out) and score, by the stages that were fitted again without those, of labelled documents."""
    with session.scratch(docs.sparkSession):
        rows = document_rows(docs, labels, F.col("quality"))
        model, judged = fit_clean(rows, EXTRA)
        scored = model.score(rows).select("doc_id", "score")
        out = judged.select("doc_id", F.col("y").cast("int").alias("quality"), F.col("score").alias("oof"), "kept").join(scored, "doc_id")
        return out.checkpoint(eager=True)
