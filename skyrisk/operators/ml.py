"""Risk classifier: assemble, train, score, evaluate, persist.

Training and scoring are MLlib (distributed tree induction; scoring is a
map-only ``transform``).  Evaluation reads the predictions once into a
(label, prediction) count table - at most classes² rows - and derives all
four metrics from it, where four ``MulticlassClassificationEvaluator`` runs
would scan the predictions four times.
"""

from __future__ import annotations

import json
import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.functions.rules import prediction_text
from skyrisk.schemas import EVENT_COLUMNS, FEATURE_COLUMNS

# Forest parameters of the reference.
NUM_TREES = 30
MAX_DEPTH = 5
SEED = 42


def assembler(features: list[str] = FEATURE_COLUMNS) -> VectorAssembler:
    """G1: the eight features in fixed order.  ``handleInvalid='error'``:
    rows with nulls must be removed by the clean rule first."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def forest(label: str = "risk_label", num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH,
           seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol="features",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed)


def train(train_df: DataFrame, label: str = "risk_label", **kw) -> PipelineModel:
    """Assembler + forest in one pipeline so feature order cannot drift
    between training and scoring.

    Tree induction makes one pass over the input per tree level (plus the
    split-candidate sample), so only the columns it needs are kept and
    cached for the fit; otherwise every pass recomputes the whole upstream
    plan (measured: 35 s -> 3.7 s on 7k rows).
    """
    from pyspark import StorageLevel
    cols = list(dict.fromkeys(FEATURE_COLUMNS + [label]))
    data = train_df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[assembler(), forest(label, **kw)]).fit(data)
    finally:
        data.unpersist()


def score(model, df: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Map-only scoring (batch or stream) + projection.

    ``carry`` keeps extra input columns (e.g. the true label for
    evaluation), so no join back to the input is needed.
    """
    out = model.transform(df).withColumn("risk_prediction", prediction_text("prediction"))
    keep = (["event_id"] if "event_id" in df.columns else []) + EVENT_COLUMNS + [
        "prediction", "risk_prediction"] + list(carry or [])
    return out.select(*keep)


# ---------------------------------------------------------------- C9
def confusion(predictions: DataFrame, label: str = "risk_label",
              prediction: str = "prediction") -> DataFrame:
    return (predictions.groupBy(F.col(label).cast("double").alias("label"),
                                F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))


def metrics_from_confusion(conf: DataFrame) -> DataFrame:
    """accuracy, weightedPrecision, weightedRecall, f1 as
    ``MulticlassClassificationEvaluator`` defines them (classes = the label
    values present; per-class precision 0 when nothing was predicted)."""
    per_pred = conf.groupBy("prediction").agg(F.sum("count").alias("pred_n"))
    per_label = conf.groupBy("label").agg(
        F.sum("count").alias("label_n"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)).alias("tp"))
    # both sides have at most (number of classes) rows
    cls = per_label.join(F.broadcast(per_pred), per_label.label == per_pred.prediction, "left")
    p = F.when(F.coalesce("pred_n", F.lit(0)) > 0, F.col("tp") / F.col("pred_n")).otherwise(0.0)
    r = F.col("tp") / F.col("label_n")
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    cls = cls.select("label_n", "tp", p.alias("p"), r.alias("r"), f1.alias("f1"))
    total = F.sum("label_n")
    return cls.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("p") * F.col("label_n")) / total).alias("weightedPrecision"),
        (F.sum(F.col("r") * F.col("label_n")) / total).alias("weightedRecall"),
        (F.sum(F.col("f1") * F.col("label_n")) / total).alias("f1"),
    )


def evaluate(predictions: DataFrame, label: str = "risk_label") -> DataFrame:
    return metrics_from_confusion(confusion(predictions, label))


# ---------------------------------------------------------------- A8, K11
POINTER_SCHEMA = "version string, path string, saved_ns long, number long"


def _claim_version(spark: SparkSession, root: str, version: str | None) -> tuple[int, str]:
    """The next model number, claimed by creating its file, and the version's name
    (``v<number>`` unless given); a name that was ever claimed is refused."""
    from skyrisk.sinks.claims import create_once, hadoop_path
    if version is not None and not create_once(spark, f"{root}/claims/names/{version}.json", "{}"):
        raise FileExistsError(f"model version {version} exists under {root}")
    fs, folder = hadoop_path(spark, f"{root}/claims")
    fs.mkdirs(folder)
    while True:
        made = [int(s.getPath().getName()[:-5]) for s in fs.listStatus(folder) if s.isFile() and s.getPath().getName()[:-5].isdigit()]
        number = max(made, default=0) + 1
        if create_once(spark, f"{root}/claims/{number:012d}.json", json.dumps({"version": version})):
            if version is not None:
                return number, version
            name = f"v{number}"
            if create_once(spark, f"{root}/claims/names/{name}.json", "{}"):
                return number, name  # else someone gave that name by hand: take the next number


def save_versioned(model: PipelineModel, spark: SparkSession, root: str, version: str | None = None) -> str:
    """Write the model under ``root/v=<version>``, then add one row to
    the table ``root/latest``.  Rows are only added, after the model is whole, so
    a reader at any time finds the newest or the one before.

    Which is newest is told by numbers claimed before the save, not by clocks: of two
    trainers at a time the one that claimed later wins, whichever ends first.  A version
    is never written twice."""
    root = root.rstrip("/")
    from skyrisk.sinks.claims import hadoop_path
    number, version = _claim_version(spark, root, version)
    path = f"{root}/v={version}"
    try:
        model.write().save(path)  # refuses an existing folder, as of versions saved before claims were kept
    except Exception:
        fs, name = hadoop_path(spark, f"{root}/claims/names/{version}.json")
        fs.delete(name, False)  # the name may be tried again
        raise
    (spark.range(1).select(F.lit(version).alias("version"), F.lit(path).alias("path"),
                           F.lit(time.time_ns()).alias("saved_ns"), F.lit(number).cast("long").alias("number"))
     .coalesce(1).write.parquet(f"{root}/latest/{number:012d}"))  # its own folder: appends to one would share a commit folder
    return path


def load_latest(spark: SparkSession, root: str) -> PipelineModel:
    """Load the model with the highest number; a clear error if none exists.  Any
    other failure to read is raised as it is."""
    from skyrisk.sources.files import path_exists
    table = f"{root.rstrip('/')}/latest"
    row = spark.read.schema(POINTER_SCHEMA).option("recursiveFileLookup", "true").parquet(table) \
        .orderBy(F.desc_nulls_last("number"), F.desc("saved_ns")).first() if path_exists(spark, table) else None
    if row is None:
        raise FileNotFoundError(f"no trained model under {root}; train first")
    return PipelineModel.load(row["path"])
