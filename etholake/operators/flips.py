"""Orientation of images: frame ranges, augmentation, a random-forest classifier, and its use on a recording.

Frames are rows (uuid, frame, pixels), pixels a flat row-major array; ranges are rows (uuid, left, start, stop)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.images import flip_x, flip_xy, flip_y
from .frames import portable_hash


def selected(ranges: DataFrame) -> DataFrame:
    """uuid, frame, left: the frames of all half-open ranges, each once for either side."""
    return ranges.where("stop > start").select("uuid", "left", F.explode(F.sequence(F.col("start"), F.col("stop") - 1)).alias("frame")).distinct()


def selected_total(ranges: DataFrame, most: int = 1_000_000) -> DataFrame:
    return ranges.agg(F.coalesce(F.sum(F.col("stop") - F.col("start")), F.lit(0)).alias("frames")).withColumn("enough", F.col("frames") >= most)


def corrected(frames: DataFrame, ranges: DataFrame, width: int) -> DataFrame:
    """The selected frames, all facing right: those marked left are flipped."""
    chosen = frames.join(selected(ranges), ["uuid", "frame"])
    return chosen.withColumn("pixels", F.when(F.col("left"), flip_x(F.col("pixels"), width)).otherwise(F.col("pixels")))


def augmented(frames: DataFrame, width: int) -> DataFrame:
    """Four rows for each frame: flipped in x and in both (label 1), flipped in y and as it is (label 0)."""
    p = F.col("pixels")
    kinds = (("x", flip_x(p, width), 1.0), ("xy", flip_xy(p), 1.0), ("y", flip_y(p, width), 0.0), ("none", p, 0.0))
    every = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("pixels"), F.lit(y).alias("label")) for k, v, y in kinds])
    return frames.select("uuid", "frame", F.explode(every).alias("v")).select("uuid", "frame", "v.*")


def split(rows: DataFrame, test_percent: int, *key: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) by an arithmetic hash of the key, alike at every run."""
    h = F.lit(0).cast("long")
    for c in key:
        h = h * 31 + F.col(c).cast("long")
    test = portable_hash(h, 100) < test_percent
    return rows.where(~test), rows.where(test)


def fit(train: DataFrame, trees: int = 100, depth: int = 6, seed: int = 0) -> PipelineModel:
    """Random forest on the pixels: gini, at least one row a leaf."""
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, impurity="gini", minInstancesPerNode=1, seed=seed)
    return Pipeline(stages=[forest]).fit(_with_features(train))


def _with_features(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.col("pixels").cast("array<double>")))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(_with_features(rows)).drop("features", "rawPrediction", "probability")


def accuracy(model: PipelineModel, test: DataFrame) -> DataFrame:
    """rows, accuracy in percent, and whether it is over 90."""
    hit = F.avg((F.col("prediction") == F.col("label")).cast("int")) * 100
    return predict(model, test).agg(F.count("*").alias("rows"), hit.alias("accuracy")).withColumn("accepted", F.col("accuracy") > 90)


def smoothed(flags: DataFrame, flag: str = "flip", kernel: int = 51) -> DataFrame:
    """A running median of a 0/1 flag by session: the majority within the kernel."""
    half = kernel // 2
    w = Window.partitionBy("uuid").orderBy("frame").rowsBetween(-half, half)
    return flags.withColumn(flag, (F.avg(F.col(flag).cast("double")).over(w) > 0.5).cast("int"))


def apply(model: PipelineModel, frames: DataFrame, kernel: int = 51) -> DataFrame:
    """Frames turned by half a circle where the smoothed prediction says so, with pi added to their angle."""
    found = smoothed(predict(model, frames).withColumn("flip", F.col("prediction").cast("int")).drop("prediction"), "flip", kernel)
    turned = F.when(F.col("flip") == 1, flip_xy(F.col("pixels"))).otherwise(F.col("pixels"))
    out = found.withColumn("pixels", turned)
    return out.withColumn("angle", F.col("angle") + F.col("flip") * F.pi()) if "angle" in frames.columns else out
