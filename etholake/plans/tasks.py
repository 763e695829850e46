"""What a user asks for in one call: tables in, tables out; the steps are operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aligned as al
from ..operators import fingerprint as fp
from ..operators import flips, hypothesis, quality, similarity
from ..operators import frames as fr
from ..operators import stats as st
from ..operators import transitions as tr

KEYS = ("uuid", "grp", "SessionName", "SubjectName")


def validate_extractions(frames: DataFrame, scalars: Sequence[str], area: str, speed: str, ts: str = "ts", outliers: str = "robust") -> dict[str, DataFrame]:
    """Quality of sessions' frames (uuid, grp, ts, scalars): flags (each flag's share and whether it is raised), outliers
    (sessions whose mean scalars lie apart: by a robust covariance, or by quartiles, 'iqr'), warnings (how many have any
    flag)."""
    if outliers not in ("robust", "iqr"):
        raise ValueError(f"outliers must be 'robust' or 'iqr', not {outliers!r}")
    flagged = quality.flags(quality.counts(frames, area, speed, scalars), quality.dropped_frames(frames, ts))
    find = quality.robust_outliers if outliers == "robust" else quality.iqr_outliers
    outliers = find(quality.summary(frames, scalars), [f"{c}_mean" for c in scalars])
    return {"flags": flagged, "outliers": outliers, "warnings": quality.warnings(flagged)}


def labelled_frames(scalars: DataFrame, models: DataFrame, max_syllables: int | None = None, count: str = "usage") -> DataFrame:
    """Frames of scalars with a model's labels (uuid, labels), as places by descending usage; only the first so many."""
    frames = al.with_labels(scalars, al.model_labels(models)).withColumnRenamed("label", "syllable")
    out = fr.relabelled(fr.labelled(frames), "syllable", count)
    return out if max_syllables is None else out.where(F.col("syllable") < max_syllables)


def scalar_summary(frames: DataFrame, scalars: Sequence[str], groups: DataFrame | None = None) -> DataFrame:
    """Mean and deviation of each scalar by session and group; groups (uuid, grp) takes the place of the sessions' own groups,
    sessions that it lacks keep theirs."""
    if groups is not None:
        new = groups.select("uuid", F.col("grp").alias("_grp"))
        frames = frames.join(new, "uuid", "left").withColumn("grp", F.coalesce("_grp", "grp")).drop("_grp")
    return quality.summary(frames, scalars)


def label_syllables(frames: DataFrame, info: DataFrame, most: int = 20, n_explained: float | None = None, select_median_duration_instances: bool = False, max_syllables: int | None = None, least_frames: int = 3, most_frames: int = 60) -> dict[str, DataFrame]:
    """examples (bouts to look at, those nearest the median duration if asked), info (descriptions with each group's usage
    and duration). Syllables are places by usage; only the first max_syllables, or as many as explain n_explained percent
    of the frames, are labelled."""
    # bouts and usages are those of all frames, whatever is labelled
    bouts, means = fr.bouts(frames), st.behavioural_stats(frames, ["grp"])
    if max_syllables is not None:
        bouts, means = (d.where(F.col("syllable") < max_syllables) for d in (bouts, means))
    elif n_explained is not None:
        most_used = F.broadcast(fr.explained_cutoff(frames, n_explained))  # one row
        bouts, means = (d.join(most_used, F.col("syllable") < F.col("max_syllables"), "left_semi") for d in (bouts, means))
    examples = fr.bout_examples(bouts, most, least_frames, most_frames, by_median=select_median_duration_instances)
    return {"examples": examples, "info": info.join(st.group_info(means, ["usage", "duration"]), "syllable", "left")}


def syllable_stats(frames: DataFrame, scalars: Sequence[str], stat: str = "usage", control: str | None = None, experiment: str | None = None, errors: str = "SEM", test: str | None = None, info: DataFrame | None = None, text: str | None = None, between: tuple[float, float] | None = None) -> dict[str, DataFrame]:
    """stats (by session and syllable, absent ones 0), order (by the statistic, or by the difference of two groups), bars
    (means and error bars by group) and, with a test, significant syllables.

    Bars are of the syllables whose label (in info) contains the text, and whose group mean lies in the range, if given."""
    stats = st.zero_filled(st.behavioural_stats(frames, KEYS, scalars), KEYS, frames.select("syllable").distinct())
    both = control is not None and experiment is not None
    order = st.sort_by_difference(stats, stat, control, experiment) if both else st.sort_by_stat(stats, stat)
    bars = st.error_bars(stats, "grp", stat, errors)
    if between is not None:
        bars = st.threshold(bars, "mean", *between)
    if text is not None:
        if info is None:
            raise ValueError("a search needs the syllables' descriptions")
        bars = st.search(bars, info, text)
    out = {"stats": stats, "order": order, "bars": st.ordered_by(bars, order)}
    if test is not None:
        if not both:
            raise ValueError("a test needs a control and an experiment group")
        out["significant"] = hypothesis.significant(stats, stat, test, control, experiment)
    return out


def transition_graphs(frames: DataFrame, normalisation: str = "bigram", max_syllables: int | None = None, p: tuple[float, float] = (0.0, 1.0), usage: tuple[float, float] = (0.0, 1.0), anchor: str | None = None, layout: str = "circular", keep_orphans: bool = False) -> dict[str, DataFrame]:
    """edges and nodes of each group's graph, differences of groups, entropies and each node's neighbours.

    Edges and nodes count if they are within the thresholds; with an anchor, its graph's edges are those of all groups. keep_orphans adds
    nodes that no edge touches. layout is 'circular' or 'spring'."""
    if layout not in ("circular", "spring"):
        raise ValueError(f"layout must be 'circular' or 'spring', not {layout!r}")
    steps = tr.steps(fr.bouts(frames), max_syllables)
    used = st.behavioural_stats(frames, ["grp"])
    every = tr.normalised(tr.edges(steps), normalisation)
    edges = tr.thresholded(every, used, p, usage)
    if anchor is not None:
        shape = edges.where(F.col("grp") == anchor).select("src", "dst")
        edges = every.join(shape, ["src", "dst"], "left_semi").select(*every.columns)
    nodes = edges.select("grp", F.col("src").alias("syllable")).union(edges.select("grp", "dst")).distinct()
    alone = tr.orphans(used.where(F.col("usage").between(*usage)), edges)
    nodes = nodes.union(alone) if keep_orphans else nodes
    styled = tr.node_style(nodes.join(used, ["grp", "syllable"]))
    placed = tr.circular_layout(styled) if layout == "circular" else styled.join(tr.spring_layout(nodes, edges), ["grp", "syllable"])
    gaps = tr.differences(used, ["syllable"], ["usage"])
    return {
        "edges": tr.edge_style(edges), "nodes": placed, "orphans": alone,
        "differences": tr.edge_style(tr.differences(edges, ["src", "dst"], ["p"]), difference=True), "difference_nodes": tr.node_style(gaps, difference=True),
        "entropies": tr.entropies(steps), "neighbours": tr.neighbours(edges), "vectors": al.node_vectors(nodes, used, ["usage", "duration"]),
    }


def compare_positions(frames: DataFrame, x: str, y: str, bins: int = 50, level: str = "grp") -> DataFrame:
    """The mean map, for each group, subject or session, of where its sessions spend a syllable."""
    if level not in st.LEVELS:
        raise ValueError(f"level must be one of {st.LEVELS}, not {level!r}")
    return fp.mean_heatmap(fp.position_heatmap(frames, ["uuid", level, "syllable"], x, y, bins), [level, "syllable"], ["uuid"])


def dendrogram(vectors: DataFrame, key: str, vector: str, metric: str = "euclidean") -> DataFrame:
    """Merges of complete linkage over the syllables' mean vectors."""
    return similarity.complete_linkage(similarity.pair_distances(similarity.centroids(vectors, key, vector), key, metric))


def dendrogram_leaves(vectors: DataFrame, key: str, vector: str, metric: str = "euclidean", info: DataFrame | None = None, color_by_cluster: bool = False, share: float = 0.7) -> DataFrame:
    """pos, syllable, text of the leaves from left to right: 'label-id' with descriptions (syllable, label). color_by_cluster adds
    cluster: leaves that merge below `share` of the last merge's height are one, numbered from the left."""
    centres = similarity.centroids(vectors, key, vector)
    leaves = similarity.leaves(similarity.complete_linkage(similarity.pair_distances(centres, key, metric)), share)
    items = sorted(r[0] for r in centres.select(key).distinct().collect())  # a model's syllables
    rows = [(pos, items[leaf], cluster) for pos, (leaf, cluster) in enumerate(leaves)] if len(items) > 1 else [(0, x, 0) for x in items]
    d = vectors.sparkSession.createDataFrame(rows, f"pos int, syllable {vectors.schema[key].dataType.simpleString()}, cluster int")
    return similarity.leaf_labels(d if color_by_cluster else d.drop("cluster"), info)


def train_flip_classifier(frames: DataFrame, ranges: DataFrame, width: int, path: str | None = None, test_percent: int = 20) -> tuple[PipelineModel, DataFrame]:
    """Classifier of orientation from chosen ranges of frames, and its accuracy on those held back; written to a path."""
    train, test = flips.split(flips.augmented(flips.corrected(frames, ranges, width), width), test_percent, "frame")
    model = flips.fit(train)
    if path:
        model.write().overwrite().save(path)
    return model, flips.accuracy(model, test)


def load_flip_classifier(path: str) -> PipelineModel:
    return PipelineModel.load(path)
