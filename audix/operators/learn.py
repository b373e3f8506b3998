"""Sparse linear click models and their evaluation.

The reference trains an external online learner on text lines. Here features named
``namespace^token`` are hashed to 2^bits slots (M1) and the weights of the slots are a
table (operators/linear.py): ``train`` minimises squared, logistic, hinge or quantile
loss over all rows, weighted by importance and without intercept; ``train_online`` takes
adaptive steps in one pass over the rows, as the reference's feature dumps do;
``cross_validate`` fits the models of all folds together. Models are saved and loaded as
files. An online learner's exact weights are not reproduced; the objective and the
ranking of strong features are.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audix.functions.features import NAMESPACES, namespaced_tokens
from audix.functions.rank import row_index
from audix.operators import linear
from audix.session import cut_lineage

LOSSES = ("squared", "logistic", "hinge", "quantile")
# The reference's slots: 2^24 for the feature dump, 2^30 in cross-validation.
DEFAULT_BITS = 24
CV_BITS = 30
DEFAULT_PASSES = 10


def training_frame(rows: DataFrame, id_col: str = "sid") -> DataFrame:
    """(row_id, label, importance, feats) from rows with label, importance and
    the five namespace arrays."""
    return rows.select(F.col(id_col).alias("row_id"), F.col("label").cast("double").alias("label"),
                       F.col("importance").cast("double").alias("importance"),
                       F.array_distinct(namespaced_tokens()).alias("feats"))


def _padded(feature) -> Column:
    """A feature padded to whole 4-byte words: on these, the hash that places
    features into slots and Spark SQL's ``hash`` agree. Tokens hold no spaces,
    so different features stay different."""
    return F.concat(feature, F.repeat(F.lit(" "), F.pmod(-F.octet_length(feature), F.lit(4)).cast("int")))


def slot(feature, bits: int) -> Column:
    """M1: the slot of a feature among 2^bits."""
    return F.pmod(F.hash(_padded(feature)), F.lit(2 ** bits))


def vectorize(train: DataFrame, bits: int = DEFAULT_BITS):
    """M1: binary sparse vectors over 2^bits hash slots, as the reference's
    learner has them: the model's size is fixed by ``bits``, not by the data,
    and no feature is dropped; features that share a slot share a weight."""
    tf = HashingTF(inputCol="_padded", outputCol="features", numFeatures=2 ** bits, binary=True)

    def transform(df: DataFrame) -> DataFrame:
        return tf.transform(df.withColumn("_padded", F.transform("feats", _padded))).drop("_padded")
    return transform, transform(train)


def slots(feats, bits: int) -> Column:
    """The distinct slots of an array of features."""
    return F.array_distinct(F.transform(F.coalesce(feats, F.array().cast("array<string>")),
                                        lambda f: slot(f, bits).cast("int")))


def _slotted(df: DataFrame, bits: int, *more: str) -> DataFrame:
    return df.select(F.monotonically_increasing_id().alias("_row"), "label", "importance", *more,
                     slots(F.col("feats"), bits).alias("slots"))


def _named(train: DataFrame, weights: DataFrame, bits: int) -> DataFrame:
    """M3: (ns, token, weight) of every feature with a weight: the features' own
    slots are joined to the model's, so names never pass through the driver."""
    names = train.select(F.explode("feats").alias("feature")).distinct()
    found = names.withColumn("slot", slot(F.col("feature"), bits).cast("int")).join(weights, "slot")
    return _split_feature(found, "weight")


def _split_feature(df: DataFrame, weight_col: str) -> DataFrame:
    return df.select(F.substring_index("feature", "^", 1).alias("ns"),
                     F.expr("substr(feature, instr(feature, '^') + 1)").alias("token"),
                     F.col(weight_col).alias("weight"))


def train_model(rows: DataFrame, loss: str = "squared", passes: int = DEFAULT_PASSES,
                bits: int = DEFAULT_BITS) -> linear.Model:
    """M2 + M4: the model that ``passes`` steps over all rows lead to."""
    weights, _ = linear.fit(_slotted(rows, bits), loss, passes)
    return linear.Model(loss, bits, weights.select("slot", "weight"))


def train_online(rows: DataFrame, loss: str = "squared", passes: int = 1, bits: int = DEFAULT_BITS,
                 **options) -> linear.Model:
    """M2 + M4: the model after one pass, or more, of adaptive steps row by row."""
    ready = rows.select("row_id", "label", "importance", slots(F.col("feats"), bits).alias("slots"))
    return linear.Model(loss, bits, linear.fit_online(ready, loss, passes, **options))


def named_weights(rows: DataFrame, model: linear.Model) -> DataFrame:
    """M3: (ns, token, weight) of the features of ``rows``."""
    return _named(rows, model.weights, model.bits)


def predict(model: linear.Model, df: DataFrame) -> DataFrame:
    """M5: ``df`` with ``score`` by a model, trained or loaded."""
    return model.score(df, slots(F.col("feats"), model.bits))


def train(rows: DataFrame, loss: str = "squared", passes: int = DEFAULT_PASSES, bits: int = DEFAULT_BITS):
    """M2 + M4: returns (predict_fn, weights DataFrame[ns, token, weight])."""
    model = train_model(rows, loss, passes, bits)
    return (lambda df: predict(model, df)), named_weights(rows, model)


def binary_prediction(scored: DataFrame) -> DataFrame:
    """M5: {-1, 1} from the score."""
    return scored.withColumn("pred", F.when(F.col("score") > 0, 1.0).otherwise(-1.0))


def assign_folds(df: DataFrame, k: int = 10, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """T6 + M6: deterministic shuffle by xxhash64(id, seed); fold =
    floor((rank - 1) / ceil(N / k)), so folds hold ceil(N/k) rows and the last
    the rest (fewer than k folds can exist, K6). Rank is exact and distributed."""
    n = df.count()
    size = max(1, math.ceil(n / k)) if n else 1
    h = df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)))
    ranked = row_index(h, [F.col("_h"), F.col(id_col)], "_rank")
    return ranked.withColumn("fold", F.floor((F.col("_rank") - 1) / size).cast("int")).drop("_h", "_rank")


def accuracy(scored: DataFrame) -> float:
    """M8: share of rows whose binary prediction equals the label."""
    r = binary_prediction(scored).agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    return float(r) if r is not None else float("nan")


def cross_validate(rows: DataFrame, loss: str = "squared", k: int = 10, passes: int = DEFAULT_PASSES,
                   seed: int = 42, bits: int = CV_BITS) -> DataFrame:
    """M7 + M9 + A15: train on k-1 folds, test on one, for each fold made; mean
    accuracy over the folds actually made (K6). The models of all folds are
    fitted together: a pass over the rows steps every one of them, and a row's
    margin under the model that left it out is its test.
    Returns (loss, fold, n_test, accuracy) rows plus a fold = -1 mean row."""
    spark = rows.sparkSession
    folded = cut_lineage(assign_folds(rows, k, seed))
    made = sorted(r["fold"] for r in folded.select("fold").distinct().collect())
    out = []
    if len(made) > 1:       # a single fold leaves nothing to train on
        _, scored = linear.fit(_slotted(folded, bits, "fold"), loss, passes, made)
        own = F.get("margins", F.array_position(F.array(*[F.lit(f) for f in made]), F.col("fold")).cast("int") - 1)
        right = binary_prediction(scored.withColumn("score", own)).groupBy("fold").agg(
            F.count("*").alias("n"), F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))
        out = [(loss, int(r.fold), r.n, r.accuracy) for r in right.orderBy("fold").collect()]
    mean = sum(a for *_, a in out) / len(out) if out else float("nan")
    out.append((loss, -1, int(sum(n for _, _, n, _ in out)), mean))
    return spark.createDataFrame(out, "loss string, fold int, n_test long, accuracy double")


def fold_sizes(rows: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """(fold, n) of the k-fold split."""
    return assign_folds(rows, k, seed).groupBy("fold").agg(F.count("*").alias("n"))


__all__ = ["LOSSES", "NAMESPACES", "training_frame", "vectorize", "slots", "train", "train_model", "train_online",
           "named_weights", "predict", "binary_prediction", "assign_folds", "accuracy", "cross_validate", "fold_sizes"]
