"""Queries of operators.aligned, of aliases and of syllable descriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import aliases
from ..operators import aligned as al
from ..operators import fingerprint as fp
from ..operators import frames as fr
from ..operators import stats as st
from ..operators import transitions as tr
from ..sources import descriptions, sessions
from . import tables as tb
from .queries import query, rounded


def _model(spark, sf):
    """The labels of events as a model's results: one array for each session."""
    e = tb.event_frames(spark, sf)
    return e.groupBy("uuid").agg(F.array_sort(F.collect_list(F.struct("frame", "event_type")))["event_type"].alias("labels"))


@query(f"WITH {tb.FRAMES} SELECT uuid, frame, event_type AS label FROM f")
def model_results(spark, sf):
    return al.model_labels(_model(spark, sf))


@query(f"WITH {tb.FRAMES} SELECT uuid, frame, round(value, 6) AS value, syllable FROM fr")
def scalars_with_labels(spark, sf):
    labels = fr.relabelled(al.model_labels(_model(spark, sf)), "label", "frames")
    d = al.with_labels(tb.event_frames(spark, sf).select("uuid", "frame", "value"), labels.select("uuid", "frame", F.col("syllable").alias("label")))
    return rounded(d.withColumnRenamed("label", "syllable"), "value")


@query(f"WITH {tb.STATS}, g AS (SELECT min(value) AS a, max(value) AS b, min(k) AS c, max(k) AS d FROM fr), n AS (SELECT uuid, grp, SessionName, SubjectName, syllable, least(floor((value - a) / (b - a) * 50), 49)::INT AS xbin, least(floor((k - c) / (d - c) * 50), 49)::INT AS ybin, count(*) AS n FROM fr, g GROUP BY ALL) "
       "SELECT n.uuid, n.syllable, xbin, ybin, round(n / sum(n) OVER (PARTITION BY n.uuid, n.syllable), 6) AS pdf, round(usage, 6) AS usage FROM n JOIN s USING (uuid, grp, SessionName, SubjectName, syllable)")
def stats_with_heatmaps(spark, sf):
    maps = fp.position_heatmap(tb.labelled_frames(spark, sf), list(al.MAP_KEYS), "value", "k")
    d = al.with_heatmaps(tb.session_stats(spark, sf), maps)
    return rounded(d.select("uuid", "syllable", "xbin", "ybin", "pdf", "usage"), "pdf", "usage")


_SPEEDS = {"velocity_2d_mm_mean": "value_mean", "velocity_3d_mm_mean": "k_mean", "height_ave_mm_mean": "value_max", "dist_to_center_px_mean": "k_std"}


def _named(spark, sf):
    s = tb.session_stats(spark, sf)
    return s.select(*tb.KEYS, "syllable", "usage", "duration", *[F.col(c).alias(n) for n, c in _SPEEDS.items()])


@query(f"WITH {tb.STATS} SELECT uuid, syllable, round(usage, 6) AS usage, round(duration, 6) AS duration, round(value_mean, 6) AS speed_2d, round(k_mean, 6) AS speed_3d, round(value_max, 6) AS height, round(k_std, 6) AS dist_to_center FROM s")
def drawn_names(spark, sf):
    return rounded(aliases.aliased(_named(spark, sf), aliases.DRAWN, "uuid", "syllable"), *aliases.DRAWN)


@query(f"WITH {tb.STATS} SELECT grp, syllable, round(avg(duration), 6) AS duration, round(avg(value_mean), 6) AS speeds_2d, round(avg(k_mean), 6) AS speeds_3d, round(avg(value_max), 6) AS heights, round(avg(k_std), 6) AS dists FROM s GROUP BY ALL")
def graph_scalars(spark, sf):
    d = _named(spark, sf).groupBy("grp", "syllable").agg(*[F.avg(c).alias(c) for c in aliases.SCALARS.values()])
    return rounded(aliases.aliased(d, aliases.SCALARS, "grp", "syllable"), *aliases.SCALARS)


@query(f"WITH {tb.STATS}, x AS (SELECT syllable, round(avg(duration), 6) AS chosen FROM s GROUP BY ALL) SELECT syllable, chosen FROM x")
def chosen_statistic(spark, sf):
    return rounded(_named(spark, sf).groupBy("syllable").agg(F.avg(aliases.column_of("duration")).alias("chosen")), "chosen")


@query(f"WITH {tb.EDGES}, nd AS (SELECT DISTINCT grp, src AS syllable FROM p WHERE p > 0.03 UNION SELECT grp, dst FROM p WHERE p > 0.03), u AS (SELECT grp, syllable, avg(frames) / 30 AS duration, count(*) AS bouts FROM b GROUP BY ALL), "
       "m AS (SELECT grp, syllable, stddev_samp(k) AS k_std FROM fr GROUP BY ALL) SELECT grp, CAST(row_number() OVER (PARTITION BY grp ORDER BY syllable) - 1 AS INT) AS pos, syllable, round(duration, 6) AS duration, round(coalesce(k_std, 0), 6) AS k_std FROM nd JOIN u USING (grp, syllable) JOIN m USING (grp, syllable)")
def graph_node_vectors(spark, sf):
    frames = tb.labelled_frames(spark, sf)
    e = tr.normalised(tr.edges(tr.steps(fr.bouts(frames)))).where("p > 0.03")
    nodes = e.select("grp", F.col("src").alias("syllable")).union(e.select("grp", "dst")).distinct()
    stats = st.behavioural_stats(frames, ["grp"], ("k",), aggregates=("std",))
    return rounded(al.node_vectors(nodes, stats, ["duration", "k_std"]), "duration", "k_std").select("grp", "pos", "syllable", "duration", "k_std")


@query(f"WITH {tb.STATS}, m AS (SELECT grp, max(usage) AS greatest FROM s GROUP BY grp) SELECT grp, round(greatest, 6) AS greatest, round(max(greatest) OVER (ORDER BY grp), 6) AS so_far FROM m")
def running_maximum_by_group(spark, sf):
    return rounded(al.running_maximum(tb.session_stats(spark, sf), "usage"), "greatest", "so_far")


@query("SELECT c_name AS \"SessionName\", min_by(c_mktsegment, c_custkey) AS grp FROM customer GROUP BY c_name")
def group_of_session(spark, sf):
    c = tb.read(spark, sf, "customer").select(F.col("c_custkey").alias("uuid"), F.col("c_name").alias("SessionName"), F.col("c_mktsegment").alias("grp"))
    return al.group_of(c)


def _progress(spark, sf):
    c = tb.read(spark, sf, "customer").select(F.col("c_name").alias("name"), F.concat(F.lit("/data/"), F.col("c_custkey").cast("string")).alias("path"))
    o = tb.read(spark, sf, "orders").join(tb.read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return al.extraction_progress(c, o.select(F.col("c_name").alias("name"), F.concat(F.lit("/out/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit(".mp4")).alias("path"), (F.col("o_orderstatus") == "F").alias("complete")))


_PROGRESS = """x AS (SELECT c_name AS name, '/data/' || c_custkey AS own, '/out/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.mp4' AS path, o_orderstatus = 'F' AS complete FROM customer LEFT JOIN orders ON o_custkey = c_custkey),
pr AS (SELECT name, coalesce(arg_max(path, (complete, path)), any_value(own)) AS path, CASE WHEN bool_or(complete) THEN 'extracted' WHEN count(path) > 0 THEN 'incomplete' ELSE 'missing' END AS state FROM x GROUP BY name)"""


@query(f"WITH {_PROGRESS} SELECT name, path, state FROM pr")
def extraction_states(spark, sf):
    return _progress(spark, sf)


@query(f"WITH {_PROGRESS} SELECT count(*) AS sessions, count(*) FILTER (state = 'extracted') AS extracted, count(*) FILTER (state = 'incomplete') AS incomplete, count(*) FILTER (state = 'missing') AS missing FROM pr")
def extraction_counts(spark, sf):
    return al.progress_counts(_progress(spark, sf))


@query(f"WITH {tb.FRAMES}, b AS (SELECT uuid, frame, unnest(range(greatest(0, floor((frame - 16) / 12) + 1)::BIGINT, floor(frame / 12)::BIGINT + 1)) AS batch FROM f) SELECT uuid, batch, min(frame) AS first, max(frame) AS last, count(*) AS frames FROM b GROUP BY ALL")
def batches_with_overlap(spark, sf):
    d = al.batches(tb.event_frames(spark, sf), 16, 4)
    return d.groupBy("uuid", "batch").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), F.count("*").alias("frames"))


@query("SELECT l_suppkey AS uuid, l_orderkey * 10 + l_linenumber AS at, CAST(sum(trunc(l_quantity)) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 10 + l_linenumber) AS BIGINT) AS selected, CAST(sum(trunc(l_quantity)) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 10 + l_linenumber) AS BIGINT) AS read_back FROM lineitem")
def selected_frames_counter(spark, sf):
    r = tb.read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("uuid"), F.lit(0).cast("long").alias("start"), F.col("l_quantity").cast("long").alias("stop"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return al.running_selected(r).select("uuid", "at", "selected", al.number_after_colon(F.col("shown")).alias("read_back"))


@query("SELECT 'duration' AS objective, (SELECT p_partkey FROM part ORDER BY abs(p_size - 25.5), p_partkey LIMIT 1) AS model UNION ALL SELECT 'jsd', (SELECT p_partkey FROM part ORDER BY p_retailprice, p_partkey LIMIT 1) UNION ALL SELECT 'median_loglikelihood', (SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1)")
def best_fit_model(spark, sf):
    p = tb.read(spark, sf, "part")
    m = p.select(F.col("p_partkey").alias("model"), F.col("p_size").cast("double").alias("duration"), F.col("p_retailprice").alias("jsd"), F.col("p_retailprice").alias("median_loglikelihood"))
    best = [al.best_model(m, o, 25.5).select(F.lit(o).alias("objective"), "model") for o in al.OBJECTIVES]
    return best[0].unionByName(best[1]).unionByName(best[2])


@query(f"WITH {tb.FRAMES} SELECT syllable, event_type AS label, '' AS \"desc\", '' AS crowd_movie_path FROM o")
def syllable_descriptions(spark, sf):
    frames = tb.labelled_frames(spark, sf)
    labels = frames.select("syllable", F.col("event_type").alias("label")).distinct()
    info = descriptions.described(descriptions.initial(spark, labels.count()), labels)
    return al.syllable_info(tb.session_stats(spark, sf).join(info, "syllable"))


@query(f"WITH {tb.STATS}, x AS (SELECT grp, syllable, 'usage' AS stat, list(usage ORDER BY uuid) AS v FROM s GROUP BY ALL UNION ALL SELECT grp, syllable, 'duration', list(duration ORDER BY uuid) FROM s GROUP BY ALL), "
       "d AS (SELECT grp, syllable, stat, b, max(v[((b * 7919 + i * 104729) % 2147483647 * 48271 % 1000003) % len(v) + 1]) AS m FROM x, range(1, 101) r(b), range(1, len(v) + 1) q(i) GROUP BY ALL) "
       "SELECT grp, syllable, stat, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM d GROUP BY ALL")
def bootstrap_of_several(spark, sf):
    d = st.long_form(tb.session_stats(spark, sf), ["grp", "syllable", "uuid"], ["usage", "duration"])
    return rounded(st.hashed_bootstrap(d, ["grp", "syllable", "stat"], "value", ["uuid"], function=F.array_max), "low", "high")


@query("""WITH f AS (SELECT o_custkey, o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'depth.dat' WHEN 1 THEN 'proc/results_00.mp4' WHEN 2 THEN 'proc/results_00_flipped.mp4' ELSE 'notes.dat' END AS file FROM orders)
SELECT 'recordings' AS kind, '/data/s' || o_orderkey || '/' || file AS path FROM f WHERE file = 'depth.dat' UNION ALL SELECT 'extracted', '/data/s' || o_orderkey || '/' || file FROM f WHERE file = 'proc/results_00.mp4' UNION ALL SELECT 'flipped', '/data/s' || o_orderkey || '/' || file FROM f WHERE file LIKE '%flipped.mp4'""")
def session_paths_by_kind(spark, sf):
    o, r = tb.read(spark, sf, "orders"), F.col("o_orderkey") % 4
    name = F.when(r == 0, "depth.dat").when(r == 1, "proc/results_00.mp4").when(r == 2, "proc/results_00_flipped.mp4").otherwise("notes.dat")
    files = o.select(F.concat(F.lit("/data/s"), F.col("o_orderkey").cast("string"), F.lit("/"), name).alias("path"))
    kinds = [("recordings", {}), ("extracted", {"extracted": True}), ("flipped", {"extracted": True, "flipped": True})]
    found = [sessions.session_paths(files, **how).select(F.lit(k).alias("kind"), "path") for k, how in kinds]
    return found[0].unionByName(found[1]).unionByName(found[2])
