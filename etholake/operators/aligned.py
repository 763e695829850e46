"""Tables brought together: model labels with scalars, statistics with heat maps, sessions with what was made of them,
nodes with statistics; and the small counts over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What statistics and heat maps have in common.
MAP_KEYS = ("grp", "SessionName", "SubjectName", "uuid", "syllable")
OBJECTIVES = ("duration", "jsd", "median_loglikelihood")


def model_labels(models: DataFrame) -> DataFrame:
    """uuid, frame, label from a model's results (uuid, labels: an array in order of frames)."""
    return models.select("uuid", F.posexplode("labels").alias("frame", "label")).select("uuid", F.col("frame").cast("long").alias("frame"), "label")


def with_labels(scalars: DataFrame, labels: DataFrame) -> DataFrame:
    """Frames of scalars with their labels, joined on session and frame; frames that the model lacks have none."""
    return scalars.join(labels.select("uuid", "frame", "label"), ["uuid", "frame"], "left")


def with_heatmaps(stats: DataFrame, maps: DataFrame, keys: Sequence[str] = MAP_KEYS) -> DataFrame:
    """Statistics with the heat map of the same session and syllable; rows that lack either go."""
    return stats.join(maps, list(keys))


def syllable_info(stats: DataFrame, columns: Sequence[str] = ("syllable", "label", "desc", "crowd_movie_path")) -> DataFrame:
    """What is told of each syllable, once."""
    return stats.select(*columns).distinct()


def running_maximum(stats: DataFrame, stat: str, group: str = "grp") -> DataFrame:
    """Each group's greatest value, and the greatest so far in order of groups: where a slider ends as groups are drawn."""
    # one row for each group
    return stats.groupBy(group).agg(F.max(stat).alias("greatest")).withColumn("so_far", F.max("greatest").over(Window.orderBy(group)))


def group_of(index: DataFrame, key: str = "SessionName", group: str = "grp") -> DataFrame:
    """The group of each session: of several, that of the least uuid."""
    return index.groupBy(key).agg(F.min_by(group, "uuid").alias(group))


def node_vectors(nodes: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The statistics of a graph's nodes (grp, syllable), in order: pos, syllable and columns, with 0 for what is NULL or
    NaN. Nodes without statistics have no place."""
    pos = F.row_number().over(Window.partitionBy("grp").orderBy("syllable")) - 1
    values = stats.select("grp", "syllable", *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in columns])
    return nodes.select("grp", "syllable").join(values, ["grp", "syllable"]).withColumn("pos", pos.cast("int"))


def extraction_progress(sessions: DataFrame, extracted: DataFrame) -> DataFrame:
    """Each session (name, path) with the path of its extraction (name, path, complete), or its own, and its state:
    extracted, incomplete or missing."""
    e = extracted.groupBy(F.col("name").alias("_name")).agg(F.max_by("path", F.struct(F.coalesce("complete", F.lit(False)), "path")).alias("_path"), F.max(F.coalesce("complete", F.lit(False))).alias("_complete"))
    d = sessions.join(e, F.col("name") == F.col("_name"), "left")
    state = F.when(F.col("_complete"), "extracted").when(F.col("_name").isNotNull(), "incomplete").otherwise("missing")
    return d.select("name", F.coalesce("_path", "path").alias("path"), state.alias("state"))


def progress_counts(progress: DataFrame) -> DataFrame:
    """One row: sessions, and how many of them are in each state."""
    n = lambda s: F.count_if(F.col("state") == s).alias(s)
    return progress.agg(F.count("*").alias("sessions"), n("extracted"), n("incomplete"), n("missing"))


def batches(frames: DataFrame, size: int, overlap: int = 0) -> DataFrame:
    """Frames with their batch: batches of `size` frames begin every size - overlap frames, so that a frame may be in
    several."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap
    first = F.greatest(F.lit(0), F.floor((F.col("frame") - size) / step) + 1)
    return frames.withColumn("batch", F.explode(F.sequence(first.cast("long"), F.floor(F.col("frame") / step).cast("long"))))


def running_selected(ranges: DataFrame) -> DataFrame:
    """Ranges (uuid, start, stop, at: when each was chosen) with the number of frames chosen so far (ties of at together), and it
    as shown."""
    n = F.sum(F.greatest(F.col("stop") - F.col("start"), F.lit(0))).over(Window.partitionBy("uuid").orderBy("at"))
    return ranges.withColumn("selected", n).withColumn("shown", F.concat(F.lit("Current Total Selected Frames: "), n.cast("string")))


def number_after_colon(text: Column) -> Column:
    """The first integer after a colon, NULL where there is none."""
    return F.nullif(F.regexp_extract(text, r":\s*(-?\d+)", 1), F.lit("")).cast("long")


def best_model(models: DataFrame, objective: str, target: float | None = None) -> DataFrame:
    """The row of models (model, and a column for each objective) that fits best: the duration nearest to the target (of
    the change points), the least jsd, or the greatest median log likelihood; ties by model."""
    if objective not in OBJECTIVES:
        raise ValueError(f"objective must be one of {OBJECTIVES}, not {objective!r}")
    if objective == "duration" and target is None:
        raise ValueError("the objective 'duration' needs a target")
    cost = {"duration": F.abs(F.col(objective) - F.lit(target)), "jsd": F.col(objective), "median_loglikelihood": -F.col(objective)}[objective]
    return models.where(F.col(objective).isNotNull()).orderBy(cost, "model").limit(1)
