"""One query for each capability over the driver's tables, each with the SQL that another engine checks it with.

Numbers are rounded to six places on both sides, since sums of floats depend on their order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import images, text
from ..operators import fingerprint as fp
from ..operators import arena, flips, hypothesis, quality, similarity
from ..operators import frames as fr
from ..operators import stats as st
from ..operators import transitions as tr
from ..sources import sessions
from ..streaming import bouts as stream
from . import tables as tb
from . import tasks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
#: Test statistics compare the first two groups in order.
A, B = "AUTOMOBILE", "BUILDING"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(d: DataFrame, *columns: str) -> DataFrame:
    return d.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


# ---- labels, bouts, statistics


@query(f"WITH {tb.BOUTS}, u AS (SELECT grp, syllable, count(*) AS bouts, CAST(sum(frames) AS BIGINT) AS frames, avg(frames) / 30 AS duration FROM b GROUP BY ALL), "
       "m AS (SELECT grp, syllable, avg(value) AS value_mean FROM fr GROUP BY ALL) "
       "SELECT grp, syllable, bouts, frames, round(duration, 6) AS duration, round(bouts / sum(bouts) OVER (PARTITION BY grp), 6) AS usage, round(value_mean, 6) AS value_mean FROM u JOIN m USING (grp, syllable)")
def usage_duration_by_group(spark, sf):
    d = st.behavioural_stats(tb.labelled_frames(spark, sf), ["grp"], ("value",), aggregates=("mean",))
    return rounded(d, "duration", "usage", "value_mean")


@query(f"WITH {tb.BOUTS} SELECT grp, syllable, CAST(sum(frames) AS BIGINT) AS frames, round(sum(frames) / sum(sum(frames)) OVER (PARTITION BY grp), 6) AS usage FROM b GROUP BY grp, syllable")
def frame_usage_by_group(spark, sf):
    d = st.behavioural_stats(tb.labelled_frames(spark, sf), ["grp"], count="frames")
    return rounded(d.select("grp", "syllable", "frames", "usage"), "usage")


@query(f"WITH {tb.FRAMES} SELECT event_type, n, syllable AS sorted_id FROM o")
def relabel_by_usage(spark, sf):
    return fr.usage_order(tb.event_frames(spark, sf), "event_type")


@query(f"WITH {tb.BOUTS} SELECT uuid, run, syllable, start, frames, round(value, 6) AS value FROM b")
def bouts(spark, sf):
    b = fr.bouts(tb.labelled_frames(spark, sf), keep=(), means=("value",))
    return rounded(b.select("uuid", F.col("run").cast("long").alias("run"), "syllable", "start", "frames", "value"), "value")


_ZERO = "z AS (SELECT k.*, o.syllable, coalesce(s.bouts, 0) AS bouts, coalesce(s.frames, 0) AS frames, coalesce(s.usage, 0) AS usage, coalesce(s.duration, 0) AS duration, coalesce(s.value_mean, 0) AS value_mean FROM (SELECT DISTINCT uuid, grp, SessionName, SubjectName FROM s) k CROSS JOIN o LEFT JOIN s ON s.uuid = k.uuid AND s.syllable = o.syllable)"


def _zero_filled(spark, sf):
    frames = tb.labelled_frames(spark, sf)
    return st.zero_filled(tb.session_stats(spark, sf), tb.KEYS, frames.select("syllable").distinct())


@query(f"WITH {tb.STATS}, {_ZERO} SELECT uuid, grp, SessionName, SubjectName, syllable, bouts, frames, round(usage, 6) AS usage, round(duration, 6) AS duration, round(value_mean, 6) AS value_mean FROM z")
def session_syllable_stats(spark, sf):
    d = _zero_filled(spark, sf).select(*tb.KEYS, "syllable", "bouts", "frames", "usage", "duration", "value_mean")
    return rounded(d, "usage", "duration", "value_mean")


@query(f"WITH {tb.STATS} SELECT uuid, syllable, " + ", ".join(f"round({c}_{a}, 6) AS {c}_{a}" for c in ("value", "k") for a in ("mean", "std", "min", "max")) + " FROM s")
def session_scalar_aggregates(spark, sf):
    names = [f"{c}_{a}" for c in ("value", "k") for a in ("mean", "std", "min", "max")]
    return rounded(tb.session_stats(spark, sf).select("uuid", "syllable", *names), *names)


@query(f"WITH {tb.STATS}, {_ZERO} SELECT grp, syllable, round(avg(usage), 6) AS usage, round(avg(duration), 6) AS duration, count(*) AS sessions FROM z GROUP BY ALL")
def group_mean_of_session_means(spark, sf):
    return rounded(st.mean_of_sessions(_zero_filled(spark, sf), ["grp"], ["usage", "duration"]), "usage", "duration")


@query(f"WITH {tb.STATS} SELECT CASE WHEN grouping(grp) = 0 THEN 'grp' WHEN grouping(SessionName) = 0 THEN 'SessionName' ELSE 'SubjectName' END AS level, coalesce(grp, SessionName, SubjectName) AS key, syllable, round(avg(usage), 6) AS usage, round(avg(duration), 6) AS duration "
       "FROM s GROUP BY GROUPING SETS ((grp, syllable), (SessionName, syllable), (SubjectName, syllable))")
def rollup_group_session_subject(spark, sf):
    return rounded(st.roll_up(tb.session_stats(spark, sf), list(st.LEVELS), ["usage", "duration"]), "usage", "duration")


def _errors(kind: str):
    return f"""WITH {tb.STATS}, m AS (SELECT grp, syllable, avg(usage) AS mean, {kind} AS error FROM s GROUP BY ALL)
SELECT grp, syllable, round(mean, 6) AS mean, round(error, 6) AS error, round(mean - coalesce(error, 0), 6) AS low, round(mean + coalesce(error, 0), 6) AS high FROM m"""


@query(_errors("stddev_samp(usage) / sqrt(count(usage))"))
def errorbars_sem(spark, sf):
    return rounded(st.error_bars(tb.session_stats(spark, sf), "grp", "usage", "SEM"), "mean", "error", "low", "high")


@query(_errors("stddev_samp(usage)"))
def errorbars_std(spark, sf):
    return rounded(st.error_bars(tb.session_stats(spark, sf), "grp", "usage", "STD"), "mean", "error", "low", "high")


@query(_errors("CAST(NULL AS DOUBLE)"))
def errorbars_none(spark, sf):
    return rounded(st.error_bars(tb.session_stats(spark, sf), "grp", "usage", "None"), "mean", "error", "low", "high")


def _mixed(source: str, x: str, into: str) -> str:
    """CTEs that add portable_mix(x) to a source."""
    once = lambda y: f"({y} * {y} + 12345 * {y} + 1013904223) % 2147483647"
    y = "y_"
    return (f"{into}_a AS (SELECT *, ({x}) % 2147483647 AS {y} FROM {source}), {into}_b AS (SELECT * EXCLUDE ({y}), ({once(y)} + 374761393) % 2147483647 AS {y} FROM {into}_a), "
            f"{into} AS (SELECT * EXCLUDE ({y}), {once(y)} AS {into}_u FROM {into}_b)")


@query(f"""WITH {tb.STATS}, {_mixed("s", "uuid * 7919", "m1")}, d AS (SELECT grp, syllable, uuid, usage, m1_u, b FROM m1, range(1, 10001) r(b)), {_mixed("d", "m1_u + b * 104729", "m2")},
pw AS (SELECT grp, syllable, b, usage, {" + ".join(f"(m2_u > {int(c * 2_147_483_647)})::INT" for c in st.POISSON)} AS w FROM m2),
r AS (SELECT grp, syllable, b, sum(w * usage) / sum(w) AS m FROM pw GROUP BY ALL HAVING sum(w) > 0), a AS (SELECT grp, syllable, avg(usage) AS mean FROM s GROUP BY ALL)
SELECT grp, syllable, round(any_value(mean), 6) AS mean, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM r JOIN a USING (grp, syllable) GROUP BY ALL""")
def bootstrap_ci(spark, sf):
    return rounded(st.merged_bootstrap(tb.session_stats(spark, sf), ["grp", "syllable"], "usage", unit=F.col("uuid")), "mean", "low", "high")


@query(f"""WITH {tb.STATS}, x AS (SELECT grp, syllable, list(usage ORDER BY uuid) AS v FROM s GROUP BY ALL),
d AS (SELECT grp, syllable, b, avg(v[((b * 7919 + i * 104729) % 2147483647 * 48271 % 1000003) % len(v) + 1]) AS m FROM x, range(1, 101) r(b), range(1, len(v) + 1) q(i) GROUP BY ALL)
SELECT grp, syllable, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM d GROUP BY ALL""")
def bootstrap_ci_hashed(spark, sf):
    return rounded(st.hashed_bootstrap(tb.session_stats(spark, sf), ["grp", "syllable"], "usage", ["uuid"]), "low", "high")


@query(f"WITH {tb.FRAMES} SELECT CAST(min(syllable) + 1 AS BIGINT) AS max_syllables FROM (SELECT syllable, sum(n) OVER (ORDER BY syllable) / (SELECT sum(n) FROM o) AS c FROM o) WHERE c * 100 >= 75")
def explained_variance_cutoff(spark, sf):
    return fr.explained_cutoff(tb.event_frames(spark, sf), 75.0, "event_type")


@query(f"WITH {tb.STATS}, m AS (SELECT syllable, avg(duration) AS value FROM s GROUP BY ALL) SELECT syllable, round(value, 6) AS value, CAST(row_number() OVER (ORDER BY value DESC, syllable) - 1 AS INT) AS pos FROM m")
def sort_by_stat(spark, sf):
    return rounded(st.sort_by_stat(tb.session_stats(spark, sf), "duration"), "value")


@query(f"WITH {tb.STATS}, m AS (SELECT syllable, avg(usage) FILTER (grp = '{B}') - avg(usage) FILTER (grp = '{A}') AS value FROM s GROUP BY ALL) SELECT syllable, round(value, 6) AS value, CAST(row_number() OVER (ORDER BY value DESC, syllable) - 1 AS INT) AS pos FROM m")
def sort_by_group_difference(spark, sf):
    return rounded(st.sort_by_difference(tb.session_stats(spark, sf), "usage", A, B), "value")


@query(f"WITH {tb.STATS}, i AS (SELECT syllable, event_type AS label FROM o) SELECT uuid, syllable, label, round(usage, 6) AS usage FROM s JOIN i USING (syllable) WHERE usage BETWEEN 0.1 AND 0.3 AND contains(lower(label), 'i')")
def stat_threshold_and_search(spark, sf):
    info = fr.usage_order(tb.event_frames(spark, sf), "event_type").select(F.col("sorted_id").alias("syllable"), F.col("event_type").alias("label"))
    d = st.search(st.threshold(tb.session_stats(spark, sf), "usage", 0.1, 0.3), info, "I")
    return rounded(d.select("uuid", "syllable", "label", "usage"), "usage")


@query(f"WITH {tb.STATS} SELECT syllable, grp, round(avg(usage), 6) AS usage, round(avg(duration), 6) AS duration, round(avg(value_mean), 6) AS value_mean FROM s GROUP BY ALL")
def group_info_map(spark, sf):
    metrics = ["usage", "duration", "value_mean"]
    d = st.group_info(st.mean_of_sessions(tb.session_stats(spark, sf), ["grp"], metrics), metrics)
    return rounded(d.select("syllable", F.explode("group_info").alias("grp", "m")).select("syllable", "grp", "m.*"), *metrics)


@query(f"""WITH {tb.BOUTS}, c AS (SELECT *, row_number() OVER (PARTITION BY syllable ORDER BY (uuid * 1000 + run) % 2147483647 * 48271 % 1000003, uuid, run) AS example FROM b WHERE frames BETWEEN 2 AND 60)
SELECT syllable, uuid, run, start, frames, CAST(example AS INT) AS example, greatest(start - 10, 0) AS from_frame, start + frames + 10 AS to_frame FROM c WHERE example <= 20""")
def bout_examples(spark, sf):
    b = fr.bouts(tb.labelled_frames(spark, sf)).withColumn("run", F.col("run").cast("long"))
    return fr.bout_examples(b, 20, 2).select("syllable", "uuid", "run", "start", "frames", "example", "from_frame", "to_frame")


# ---- transitions


def _steps(spark, sf):
    return tr.steps(fr.bouts(tb.labelled_frames(spark, sf)))


def _p(spark, sf, how="bigram"):
    return tr.normalised(tr.edges(_steps(spark, sf)), how)


@query(f"WITH {tb.EDGES} SELECT grp, src, dst, n, round(p, 6) AS p FROM p")
def transitions_bigram(spark, sf):
    return rounded(_p(spark, sf), "p")


@query(f"WITH {tb.EDGES} SELECT grp, src, dst, n, round(n / sum(n) OVER (PARTITION BY grp, src), 6) AS p FROM e")
def transitions_rows(spark, sf):
    return rounded(_p(spark, sf, "rows"), "p")


@query(f"WITH {tb.EDGES} SELECT grp, src, dst, n, round(n / sum(n) OVER (PARTITION BY grp, dst), 6) AS p FROM e")
def transitions_columns(spark, sf):
    return rounded(_p(spark, sf, "columns"), "p")


@query(f"WITH {tb.EDGES} SELECT g.grp, CAST(a.i AS INT) AS src, CAST(c.i AS INT) AS dst, round(coalesce(p.p, 0), 6) AS p FROM (SELECT DISTINCT grp FROM e) g CROSS JOIN range(5) a(i) CROSS JOIN range(5) c(i) LEFT JOIN p ON p.grp = g.grp AND p.src = a.i AND p.dst = c.i")
def transition_dense_matrix(spark, sf):
    return rounded(tr.dense(_p(spark, sf), 5), "p")


_ENTROPY = f"""{tb.EDGES}, se AS (SELECT uuid, grp, src, dst, count(*) AS n FROM t WHERE dst IS NOT NULL GROUP BY ALL),
sp AS (SELECT *, n / sum(n) OVER (PARTITION BY uuid, src) AS r, n / sum(n) OVER (PARTITION BY uuid, dst) AS c FROM se),
eo AS (SELECT grp, syllable, avg(h) AS ent_out FROM (SELECT uuid, grp, src AS syllable, sum(-r * log2(r)) AS h FROM sp GROUP BY ALL) GROUP BY ALL),
ei AS (SELECT grp, syllable, avg(h) AS ent_in FROM (SELECT uuid, grp, dst AS syllable, sum(-c * log2(c)) AS h FROM sp GROUP BY ALL) GROUP BY ALL),
en AS (SELECT * FROM eo FULL JOIN ei USING (grp, syllable))"""


@query(f"WITH {_ENTROPY} SELECT grp, syllable, round(ent_out, 6) AS ent_out, round(ent_in, 6) AS ent_in FROM en")
def transition_entropy_in_out(spark, sf):
    return rounded(tr.entropies(_steps(spark, sf)), "ent_out", "ent_in")


@query(f"""WITH {tb.EDGES}, se AS (SELECT uuid, grp, src, dst, count(*) AS n FROM t WHERE dst IS NOT NULL GROUP BY ALL),
cell AS (SELECT u.uuid, u.grp, a.i::INT AS src, c.i::INT AS dst, coalesce(n, 0) + 1 AS m FROM (SELECT DISTINCT uuid, grp FROM se) u CROSS JOIN range(5) a(i) CROSS JOIN range(5) c(i) LEFT JOIN se ON se.uuid = u.uuid AND se.src = a.i AND se.dst = c.i),
q AS (SELECT *, m / sum(m) OVER (PARTITION BY uuid, src) AS r, m / sum(m) OVER (PARTITION BY uuid, dst) AS c FROM cell),
eo AS (SELECT grp, syllable, avg(h) AS ent_out FROM (SELECT uuid, grp, src AS syllable, sum(-r * log2(r)) AS h FROM q GROUP BY ALL) GROUP BY ALL),
ei AS (SELECT grp, syllable, avg(h) AS ent_in FROM (SELECT uuid, grp, dst AS syllable, sum(-c * log2(c)) AS h FROM q GROUP BY ALL) GROUP BY ALL)
SELECT grp, syllable, round(ent_out, 6) AS ent_out, round(ent_in, 6) AS ent_in FROM eo JOIN ei USING (grp, syllable)""")
def transition_entropy_smoothed(spark, sf):
    return rounded(tr.entropies(_steps(spark, sf), smoothing=1.0, k=5), "ent_out", "ent_in")


@query(f"WITH {_ENTROPY} SELECT y.grp || '-' || x.grp AS series, syllable, round(y.ent_out - x.ent_out, 6) AS ent_out, round(y.ent_in - x.ent_in, 6) AS ent_in FROM en x JOIN en y USING (syllable) WHERE x.grp < y.grp")
def entropy_group_difference(spark, sf):
    return rounded(tr.differences(tr.entropies(_steps(spark, sf)), ["syllable"], ["ent_out", "ent_in"]), "ent_out", "ent_in")


@query(f"""WITH {tb.EDGES}, g AS (SELECT DISTINCT grp FROM e), k AS (SELECT DISTINCT src, dst FROM e)
SELECT y.grp || '-' || x.grp AS series, src, dst, round(coalesce(py.p, 0) - coalesce(px.p, 0), 6) AS p FROM g x JOIN g y ON x.grp < y.grp CROSS JOIN k
LEFT JOIN p px USING (src, dst) LEFT JOIN p py USING (src, dst) WHERE FALSE""".replace(
    "LEFT JOIN p px USING (src, dst) LEFT JOIN p py USING (src, dst) WHERE FALSE",
    "LEFT JOIN p px ON px.grp = x.grp AND px.src = k.src AND px.dst = k.dst LEFT JOIN p py ON py.grp = y.grp AND py.src = k.src AND py.dst = k.dst WHERE px.p IS NOT NULL OR py.p IS NOT NULL").replace(
    "AS series, src, dst,", "AS series, k.src, k.dst,"))
def transition_group_difference(spark, sf):
    return rounded(tr.differences(_p(spark, sf), ["src", "dst"], ["p"]), "p")


def _usage(spark, sf):
    return st.behavioural_stats(tb.labelled_frames(spark, sf), ["grp"]).select("grp", "syllable", "usage")


_GRAPH = f"""{tb.EDGES}, u AS (SELECT grp, syllable, count(*) / sum(count(*)) OVER (PARTITION BY grp) AS usage FROM b GROUP BY grp, syllable),
h AS (SELECT * FROM p WHERE p BETWEEN 0.045 AND 1 AND (grp, src) IN (SELECT (grp, syllable) FROM u WHERE usage >= 0.19) AND (grp, dst) IN (SELECT (grp, syllable) FROM u WHERE usage >= 0.19))"""


def _graph(spark, sf):
    return tr.thresholded(_p(spark, sf), _usage(spark, sf), (0.045, 1.0), (0.19, 1.0))


@query(f"WITH {_GRAPH} SELECT grp, src, dst, n, round(p, 6) AS p FROM h")
def graph_thresholded_edges(spark, sf):
    return rounded(_graph(spark, sf), "p")


@query(f"WITH {_GRAPH} SELECT grp, syllable FROM u WHERE (grp, syllable) NOT IN (SELECT (grp, src) FROM h UNION ALL SELECT (grp, dst) FROM h)")
def graph_orphans(spark, sf):
    return tr.orphans(_usage(spark, sf), _graph(spark, sf))


@query(f"WITH {_GRAPH} SELECT grp, src, dst, round(p, 6) AS p FROM p WHERE (src, dst) IN (SELECT (src, dst) FROM h WHERE grp = '{A}')")
def graph_anchored_edges(spark, sf):
    e = _p(spark, sf)
    anchor = _graph(spark, sf).where(F.col("grp") == A).select("src", "dst", "grp")
    return rounded(e.join(F.broadcast(anchor.select("src", "dst")), ["src", "dst"], "left_semi").select("grp", "src", "dst", "p"), "p")


@query(f"""WITH {tb.EDGES} SELECT coalesce(a.grp, c.grp) AS grp, coalesce(a.node, c.node) AS node, coalesce(a.l, '') AS successors, coalesce(c.l, '') AS predecessors FROM
(SELECT grp, src AS node, string_agg(dst, ',' ORDER BY p DESC, dst) AS l FROM p GROUP BY ALL) a FULL JOIN (SELECT grp, dst AS node, string_agg(src, ',' ORDER BY p DESC, src) AS l FROM p GROUP BY ALL) c ON a.grp = c.grp AND a.node = c.node""")
def graph_neighbors(spark, sf):
    d = tr.neighbours(_p(spark, sf))
    return d.select("grp", "node", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("successors", "predecessors")])


@query(f"WITH {_GRAPH} SELECT h.grp, h.src, h.dst, CASE WHEN r.src IS NOT NULL THEN 'both' WHEN h.src = 0 THEN 'out' ELSE 'in' END AS class FROM h LEFT JOIN h r ON r.grp = h.grp AND r.src = h.dst AND r.dst = h.src WHERE h.src = 0 OR h.dst = 0")
def graph_edge_classes(spark, sf):
    return tr.edge_classes(_graph(spark, sf), F.lit(0)).select("grp", "src", "dst", "class")


@query(f"WITH {_GRAPH} SELECT h.grp, h.src, h.dst FROM h JOIN h r ON r.grp = h.grp AND r.src = h.dst AND r.dst = h.src")
def bidirectional_edges(spark, sf):
    return tr.bidirectional(_graph(spark, sf)).select("grp", "src", "dst")


@query(f"WITH {_GRAPH} SELECT grp, syllable, round(greatest(15, abs(usage * 1000)), 6) AS size, 'red' AS colour FROM u")
def graph_node_style(spark, sf):
    return rounded(tr.node_style(_usage(spark, sf)).select("grp", "syllable", "size", "colour"), "size")


@query(f"WITH {tb.EDGES} SELECT grp, src, dst, round(p * 250, 6) AS width, 'black' AS colour FROM p")
def graph_edge_style(spark, sf):
    return rounded(tr.edge_style(_p(spark, sf)).select("grp", "src", "dst", "width", "colour"), "width")


_USAGE_GAP = """d AS (SELECT y.grp || '-' || x.grp AS series, k.syllable, coalesce(py.usage, 0) - coalesce(px.usage, 0) AS usage FROM (SELECT DISTINCT grp FROM u) x JOIN (SELECT DISTINCT grp FROM u) y ON x.grp < y.grp CROSS JOIN (SELECT DISTINCT syllable FROM u) k
LEFT JOIN u px ON px.grp = x.grp AND px.syllable = k.syllable LEFT JOIN u py ON py.grp = y.grp AND py.syllable = k.syllable WHERE px.usage IS NOT NULL OR py.usage IS NOT NULL)"""


@query(f"WITH {_GRAPH}, {_USAGE_GAP} SELECT series, syllable, round(greatest(15, 15 + abs(usage * 1000)), 6) AS size, CASE WHEN usage > 0 THEN 'blue' ELSE 'red' END AS colour FROM d")
def graph_difference_node_style(spark, sf):
    d = tr.node_style(tr.differences(_usage(spark, sf), ["syllable"], ["usage"]), difference=True)
    return rounded(d.select("series", "syllable", "size", "colour"), "size")


@query(f"""WITH {tb.EDGES}, d AS (SELECT y.grp || '-' || x.grp AS series, k.src, k.dst, coalesce(py.p, 0) - coalesce(px.p, 0) AS p FROM (SELECT DISTINCT grp FROM e) x JOIN (SELECT DISTINCT grp FROM e) y ON x.grp < y.grp CROSS JOIN (SELECT DISTINCT src, dst FROM e) k
LEFT JOIN p px ON px.grp = x.grp AND px.src = k.src AND px.dst = k.dst LEFT JOIN p py ON py.grp = y.grp AND py.src = k.src AND py.dst = k.dst WHERE px.p IS NOT NULL OR py.p IS NOT NULL)
SELECT series, src, dst, round(abs(p) * 400, 6) AS width, CASE WHEN p > 0 THEN 'blue' ELSE 'red' END AS colour FROM d""")
def graph_difference_edge_style(spark, sf):
    d = tr.edge_style(tr.differences(_p(spark, sf), ["src", "dst"], ["p"]), difference=True)
    return rounded(d.select("series", "src", "dst", "width", "colour"), "width")


@query(f"WITH {tb.EDGES} SELECT grp, round(min(p), 6) AS up_min, round(max(p), 6) AS up_max, 0.0::DOUBLE AS down_min, 0.0::DOUBLE AS down_max, round(ceil(max(p) * 1000) / 1000, 6) AS slider FROM p GROUP BY grp")
def graph_edge_minmax(spark, sf):
    return rounded(tr.weight_range(_p(spark, sf)), "up_min", "up_max", "down_min", "down_max", "slider")


@query(f"WITH {_GRAPH} SELECT grp, syllable, round(cos(2 * pi() * (row_number() OVER (PARTITION BY grp ORDER BY syllable) - 1) / count(*) OVER (PARTITION BY grp)), 6) + 0.0 AS x, round(sin(2 * pi() * (row_number() OVER (PARTITION BY grp ORDER BY syllable) - 1) / count(*) OVER (PARTITION BY grp)), 6) + 0.0 AS y FROM u")
def graph_circular_layout(spark, sf):
    d = rounded(tr.circular_layout(_usage(spark, sf).select("grp", "syllable")), "x", "y")
    return d.withColumns({c: F.col(c) + F.lit(0.0) for c in ("x", "y")})


@query()
def graph_spring_layout(spark, sf):
    return rounded(tr.spring_layout(_usage(spark, sf), _graph(spark, sf)), "x", "y")


# ---- what a user asks for in one call


def _info(spark, sf):
    return fr.usage_order(tb.event_frames(spark, sf), "event_type").select(F.col("sorted_id").alias("syllable"), F.col("event_type").alias("label"))


@query(f"""WITH {tb.BOUTS}, x AS (SELECT CAST(min(syllable) + 1 AS BIGINT) AS most FROM (SELECT syllable, sum(n) OVER (ORDER BY syllable) / (SELECT sum(n) FROM o) AS c FROM o) WHERE c * 100 >= 75),
k AS (SELECT b.* FROM b, x WHERE syllable < most AND frames BETWEEN 2 AND 60), d AS (SELECT syllable, median(frames) AS m FROM k GROUP BY ALL),
c AS (SELECT k.*, row_number() OVER (PARTITION BY syllable ORDER BY abs(frames - m), uuid, run) AS example FROM k JOIN d USING (syllable))
SELECT syllable, uuid, run, start, frames, CAST(example AS INT) AS example FROM c WHERE example <= 20""")
def task_label_examples(spark, sf):
    d = tasks.label_syllables(tb.labelled_frames(spark, sf), _info(spark, sf), n_explained=75, select_median_duration_instances=True, least_frames=2)["examples"]
    return d.select("syllable", "uuid", F.col("run").cast("long").alias("run"), "start", "frames", "example")


@query(f"WITH {_GRAPH} SELECT grp, src, dst, round(p, 6) AS p, round(p * 250, 6) AS width FROM p WHERE (src, dst) IN (SELECT (src, dst) FROM h WHERE grp = '{A}')")
def task_transition_graph(spark, sf):
    d = tasks.transition_graphs(tb.labelled_frames(spark, sf), p=(0.045, 1.0), usage=(0.19, 1.0), anchor=A)["edges"]
    return rounded(d.select("grp", "src", "dst", "p", "width"), "p", "width")


@query(f"WITH {tb.FRAMES}, g AS (SELECT min(value) AS a, max(value) AS b, min(k) AS c, max(k) AS d FROM fr), n AS (SELECT uuid, SubjectName, syllable, least(floor((value - a) / (b - a) * 20), 19)::INT AS xbin, least(floor((k - c) / (d - c) * 20), 19)::INT AS ybin, count(*) AS n FROM fr, g GROUP BY ALL), "
       "h AS (SELECT *, n / sum(n) OVER (PARTITION BY uuid, SubjectName, syllable) AS pdf FROM n), q AS (SELECT SubjectName, syllable, count(DISTINCT uuid) AS m FROM h GROUP BY ALL) SELECT SubjectName, syllable, xbin, ybin, round(sum(pdf) / any_value(m), 6) AS pdf FROM h JOIN q USING (SubjectName, syllable) GROUP BY ALL")
def task_positions_by_subject(spark, sf):
    return rounded(tasks.compare_positions(tb.labelled_frames(spark, sf), "value", "k", 20, "SubjectName"), "pdf")


@query(f"""WITH {tb.STATS}, {_ZERO}, m AS (SELECT grp, syllable, avg(usage) AS mean, stddev_samp(usage) / sqrt(count(usage)) AS error FROM z GROUP BY ALL),
r AS (SELECT syllable, CAST(row_number() OVER (ORDER BY avg(usage) FILTER (grp = '{B}') - avg(usage) FILTER (grp = '{A}') DESC, syllable) - 1 AS INT) AS pos FROM z GROUP BY syllable)
SELECT m.grp, m.syllable, event_type AS label, pos, round(mean, 6) AS mean, round(error, 6) AS error FROM m JOIN r USING (syllable) JOIN o USING (syllable) WHERE contains(lower(event_type), 'i') AND mean BETWEEN 0.1 AND 0.3""")
def task_syllable_stats(spark, sf):
    d = tasks.syllable_stats(tb.labelled_frames(spark, sf), ("value",), "usage", A, B, info=_info(spark, sf), text="I", between=(0.1, 0.3))["bars"]
    return rounded(d.select("grp", "syllable", "label", "pos", "mean", "error"), "mean", "error")


# ---- quality


_TS = "(epoch_us(ts) / 1e6)"


@query(f"WITH {tb.FRAMES}, d AS (SELECT uuid, avg(x) AS m FROM (SELECT uuid, {_TS} - lag({_TS}) OVER (PARTITION BY uuid ORDER BY frame) AS x FROM f) GROUP BY uuid), r AS (SELECT uuid, CASE WHEN m > 10 THEN m / 1000 ELSE m END AS m FROM d) SELECT uuid, round(abs(30 - 1 / m) / 30, 6) AS dropped FROM r")
def dropped_frame_error(spark, sf):
    return rounded(quality.dropped_frames(_timed(spark, sf)), "dropped")


def _timed(spark, sf):
    return tb.event_frames(spark, sf).withColumn("ts", F.expr("unix_micros(cast(ts AS timestamp))") / 1e6)


_COUNTS = f"""{tb.LINES}, q AS (SELECT *, stddev_samp(quantity) OVER (PARTITION BY uuid) AS sd FROM l),
c AS (SELECT uuid, count(*) AS n, count(*) FILTER (quantity IS NULL OR price IS NULL OR discount IS NULL OR tax IS NULL) AS nan_rows, count(*) FILTER (quantity = 0) AS missing_rows, count(*) FILTER (quantity < 2 * sd) AS small_rows, count(*) FILTER (discount < 0.02) - 1 AS slow_rows FROM q GROUP BY uuid)"""
_SCALARS = ("quantity", "price", "discount", "tax")


def _counts(spark, sf):
    return quality.counts(tb.line_frames(spark, sf), "quantity", "discount", _SCALARS, slow=0.02)


@query(f"WITH {_COUNTS} SELECT * FROM c")
def session_quality_counts(spark, sf):
    return _counts(spark, sf)


def _flags(spark, sf):
    drops = quality.dropped_frames(_timed(spark, sf))
    return quality.flags(_counts(spark, sf), drops)


_FLAGS = f"""{_COUNTS}, {tb.FRAMES}, d AS (SELECT uuid, avg(x) AS m FROM (SELECT uuid, {_TS} - lag({_TS}) OVER (PARTITION BY uuid ORDER BY frame) AS x FROM f) GROUP BY uuid),
r AS (SELECT uuid, abs(30 - 1 / (CASE WHEN m > 10 THEN m / 1000 ELSE m END)) / 30 AS dropped FROM d),
y AS (SELECT c.uuid, missing_rows / n AS missing_pct, small_rows / n AS size_anomaly_pct, slow_rows / n AS stationary_pct, nan_rows / n AS corrupted_pct, dropped AS dropped_frames_pct FROM c LEFT JOIN r USING (uuid)),
x AS (SELECT *, coalesce(missing_pct >= 0.05, FALSE) AS missing, coalesce(size_anomaly_pct >= 0.05, FALSE) AS size_anomaly, coalesce(stationary_pct >= 0.05, FALSE) AS stationary, coalesce(corrupted_pct >= 0.05, FALSE) AS corrupted, coalesce(dropped_frames_pct >= 0.05, FALSE) AS dropped_frames FROM y)"""


@query(f"WITH {_FLAGS} SELECT uuid, " + ", ".join(f"round({k}_pct, 6) AS {k}_pct, {k}" for k in quality.FLAGS) + " FROM x")
def session_quality_flags(spark, sf):
    return rounded(_flags(spark, sf), *[f"{k}_pct" for k in quality.FLAGS])


@query(f"WITH {_FLAGS} SELECT count(*) AS sessions, count(*) FILTER ({' OR '.join(quality.FLAGS)}) AS raised FROM x")
def session_warnings(spark, sf):
    return quality.warnings(_flags(spark, sf))


@query(f"WITH {tb.LINES} SELECT uuid, grp, " + ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std" for c in _SCALARS) + " FROM l GROUP BY uuid, grp")
def scalar_summary_mean_std(spark, sf):
    return rounded(quality.summary(tb.line_frames(spark, sf), _SCALARS), *[f"{c}_{a}" for c in _SCALARS for a in ("mean", "std")])


def _means(spark, sf):
    return tb.line_frames(spark, sf).groupBy("uuid").agg(*[F.avg(c).alias(c) for c in _SCALARS])


@query(f"WITH {tb.LINES}, m AS (SELECT uuid, " + ", ".join(f"avg({c}) AS {c}" for c in _SCALARS) + " FROM l GROUP BY uuid), q AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3" for c in _SCALARS) + " FROM m) SELECT uuid, "
       + " OR ".join(f"{c} NOT BETWEEN {c}_1 - 1.5 * ({c}_3 - {c}_1) AND {c}_3 + 1.5 * ({c}_3 - {c}_1)" for c in _SCALARS) + " AS outlier FROM m, q")
def scalar_outlier_sessions_iqr(spark, sf):
    return quality.iqr_outliers(_means(spark, sf), _SCALARS)


@query()
def scalar_outlier_sessions(spark, sf):
    return quality.robust_outliers(_means(spark, sf), _SCALARS)


@query(f"WITH {tb.LINES} SELECT uuid, CASE WHEN uuid % 3 = 0 THEN 'moved' ELSE grp END AS grp, " + ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std" for c in _SCALARS) + " FROM l GROUP BY ALL")
def task_scalar_summary(spark, sf):
    moved = tb.read(spark, sf, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("uuid"), F.lit("moved").alias("grp"))
    return rounded(tasks.scalar_summary(tb.line_frames(spark, sf), _SCALARS, moved), *[f"{c}_{a}" for c in _SCALARS for a in ("mean", "std")])


@query()
def task_dendrogram_leaves(spark, sf):
    e = tb.read(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return tasks.dendrogram_leaves(e, "label", "embedding", color_by_cluster=True)


# ---- tests


_RANKS = f"""{tb.STATS}, k AS (SELECT *, rank() OVER (PARTITION BY syllable ORDER BY usage) + (count(*) OVER (PARTITION BY syllable, usage) - 1) / 2 AS rk, count(*) OVER (PARTITION BY syllable, usage) AS ties FROM s)"""


@query(f"""WITH {_RANKS}, g AS (SELECT syllable, grp, sum(rk) AS r, count(*) AS c, sum(ties * ties - 1) AS t FROM k GROUP BY ALL), z AS (SELECT syllable, sum(c) AS n, sum(r * r / c) AS q, sum(t) AS t, count(*) AS groups FROM g GROUP BY ALL)
SELECT syllable, round((12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - t / (n::DOUBLE * n * n - n)), 6) AS h, groups, CAST(n AS BIGINT) AS n FROM z""")
def kruskal_h_statistic(spark, sf):
    return rounded(hypothesis.kruskal(tb.session_stats(spark, sf), "usage", p_values=False), "h")


def _upper_gamma(a: str, x: str) -> str:
    """The upper tail of the gamma distribution, one less its series (all terms positive)."""
    return f"CASE WHEN {x} <= 0 THEN 1.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(400), lambda i: exp(({a} + i) * ln({x}) - ({x}) - lgamma({a} + i + 1))))) END"


_H = f"""{_RANKS}, g AS (SELECT syllable, grp, sum(rk) AS r, count(*) AS c, sum(ties * ties - 1) AS t FROM k GROUP BY ALL), z AS (SELECT syllable, sum(c) AS n, sum(r * r / c) AS q, sum(t) AS t, count(*) AS groups FROM g GROUP BY ALL),
kw AS (SELECT syllable, (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - t / (n::DOUBLE * n * n - n)) AS h, groups, n, t FROM z), kp AS (SELECT *, {_upper_gamma("((groups - 1) / 2.0)", "(h / 2)")} AS p FROM kw)"""
_DUNN = f"""{_H}, dp AS (SELECT x.syllable, x.grp AS a, y.grp AS b, (x.r / x.c - y.r / y.c) / sqrt((n * (n + 1) / 12 - z.t / (12 * (n - 1))) * (1 / x.c + 1 / y.c)) AS z FROM g x JOIN g y ON x.syllable = y.syllable AND x.grp < y.grp JOIN z ON z.syllable = x.syllable),
dq AS (SELECT *, {_upper_gamma("0.5", "(z * z / 2)")} AS p FROM dp),
dh AS (SELECT *, least(1.0, p * (count(*) OVER (PARTITION BY syllable) - row_number() OVER (PARTITION BY syllable ORDER BY p, a, b) + 1)) AS step FROM dq),
du AS (SELECT syllable, a, b, z, p, max(step) OVER (PARTITION BY syllable ORDER BY p, a, b ROWS UNBOUNDED PRECEDING) AS adjusted FROM dh)"""


@query(f"WITH {_H} SELECT syllable, round(h, 6) AS h, groups, CAST(n AS BIGINT) AS n, round(p, 6) AS p FROM kp")
def kruskal_p_values(spark, sf):
    return rounded(hypothesis.kruskal(tb.session_stats(spark, sf), "usage"), "h", "p")


@query(f"WITH {_DUNN} SELECT syllable, a, b, round(z, 6) AS z, round(p, 6) AS p, round(adjusted, 6) AS adjusted, adjusted < 0.05 AS is_sig FROM du")
def dunn_pairs(spark, sf):
    return rounded(hypothesis.dunn(tb.session_stats(spark, sf), "usage"), "z", "p", "adjusted")


_TWO = f"""{tb.STATS}, y AS (SELECT *, rank() OVER (PARTITION BY syllable ORDER BY usage) + (count(*) OVER (PARTITION BY syllable, usage) - 1) / 2 AS rk FROM s WHERE grp IN ('{A}', '{B}')),
mo AS (SELECT syllable, count(*) FILTER (grp = '{A}') AS na, avg(usage) FILTER (grp = '{A}') AS ma, var_samp(usage) FILTER (grp = '{A}') AS va, count(*) FILTER (grp = '{B}') AS nb, avg(usage) FILTER (grp = '{B}') AS mb, var_samp(usage) FILTER (grp = '{B}') AS vb, sum(rk) FILTER (grp = '{A}') AS ra FROM y GROUP BY ALL)"""


@query(f"WITH {_TWO} SELECT syllable, round(ra - na * (na + 1) / 2, 6) AS statistic FROM mo")
def mann_whitney_u(spark, sf):
    return rounded(hypothesis.pairwise(tb.session_stats(spark, sf), "usage", A, B, "Mann-Whitney", p_values=False), "statistic")


@query(f"WITH {_TWO} SELECT syllable, round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)), 6) AS statistic FROM mo")
def t_statistic(spark, sf):
    s = tb.session_stats(spark, sf).where(F.col("grp").isin(A, B))
    return rounded(hypothesis.pairwise(s, "usage", A, B, "T-test", p_values=False), "statistic")


@query(f"WITH {_TWO} SELECT syllable, round((ma - mb) / sqrt(va / na + vb / nb), 6) AS statistic FROM mo")
def z_statistic(spark, sf):
    s = tb.session_stats(spark, sf).where(F.col("grp").isin(A, B))
    return rounded(hypothesis.pairwise(s, "usage", A, B, "Z-test", p_values=False), "statistic")


@query()
def significant_syllables(spark, sf):
    s = tb.session_stats(spark, sf)
    found = [hypothesis.significant(s, "usage", t, A, B).withColumn("test", F.lit(t)) for t in hypothesis.TESTS]
    out = found[0]
    for d in found[1:]:
        out = out.unionByName(d)
    return out


# ---- similarity, images, histograms


_CENTRES = "v AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings), c AS (SELECT label, dim, avg(x::DOUBLE) AS value FROM v GROUP BY ALL)"


def _centres(spark, sf):
    e = tb.read(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return similarity.centroids(e, "label", "embedding")


@query(f"WITH {_CENTRES} SELECT a.label AS a, b.label AS b, round(sqrt(sum((a.value - b.value) ** 2)), 6) AS dist FROM c a JOIN c b USING (dim) WHERE a.label < b.label GROUP BY a.label, b.label")
def syllable_distance_pairs(spark, sf):
    return rounded(similarity.pair_distances(_centres(spark, sf), "label"), "dist")


@query(f"WITH {_CENTRES} SELECT a.label AS a, b.label AS b, round(1 - sum(a.value * b.value) / (sqrt(sum(a.value ** 2)) * sqrt(sum(b.value ** 2))), 6) AS dist FROM c a JOIN c b USING (dim) WHERE a.label < b.label GROUP BY a.label, b.label")
def syllable_distance_pairs_cosine(spark, sf):
    return rounded(similarity.pair_distances(_centres(spark, sf), "label", "cosine"), "dist")


@query()
def dendrogram_linkage(spark, sf):
    return similarity.complete_linkage(similarity.pair_distances(_centres(spark, sf), "label"))


def _images(spark, sf):
    e = tb.read(spark, sf, "embeddings")
    return e.select(F.col("label").cast("long").alias("uuid"), F.col("vec_id").alias("frame"), F.col("embedding").cast("array<double>").alias("pixels"))


_IMG = "m AS (SELECT label::BIGINT AS uuid, vec_id AS frame, list_transform(embedding, lambda x: x::DOUBLE) AS px FROM embeddings), i AS (SELECT uuid, frame, px, flatten(list_transform(range(8), lambda r: list_reverse(px[r * 8 + 1 : r * 8 + 8]))) AS fx, flatten(list_transform(range(8), lambda r: px[(7 - r) * 8 + 1 : (7 - r) * 8 + 8])) AS fy, list_reverse(px) AS fxy FROM m)"
_AUG = f"{_IMG}, a AS (SELECT uuid, frame, 'x' AS kind, fx AS pixels, 1.0::DOUBLE AS label FROM i UNION ALL SELECT uuid, frame, 'xy', fxy, 1.0 FROM i UNION ALL SELECT uuid, frame, 'y', fy, 0.0 FROM i UNION ALL SELECT uuid, frame, 'none', px, 0.0 FROM i)"


@query(f"WITH {_AUG} SELECT uuid, frame, kind, label, round(pixels[1], 6) AS first, round(pixels[8], 6) AS eighth, round(list_dot_product(pixels, list_transform(range(64), lambda j: j::DOUBLE)), 6) AS moment FROM a")
def image_augment(spark, sf):
    d = flips.augmented(_images(spark, sf), 8)
    moment = F.aggregate(F.zip_with("pixels", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda j: j.cast("double")), lambda p, j: p * j), F.lit(0.0), lambda s, x: s + x)
    return rounded(d.select("uuid", "frame", "kind", "label", F.get("pixels", 0).alias("first"), F.get("pixels", 7).alias("eighth"), moment.alias("moment")), "first", "eighth", "moment")


#: Over the frames of every label's images, whatever their number n: right [0, 2n/3) and [n/3, n/2), left [n/2, n).
def _ranges(images):
    n = images.groupBy("uuid").agg((F.max("frame") + 1).alias("n"))
    part = lambda left, a, b: F.struct(F.lit(left).alias("left"), F.expr(f"n * {a} div 6").alias("start"), F.expr(f"n * {b} div 6").alias("stop"))
    return n.select("uuid", F.explode(F.array(part(False, 0, 4), part(False, 2, 3), part(True, 3, 6))).alias("r")).select("uuid", "r.*")


_SEL = "n AS (SELECT label::BIGINT AS uuid, max(vec_id) + 1 AS n FROM embeddings GROUP BY label), rg AS (SELECT uuid, r.\"left\", n * a // 6 AS start, n * b // 6 AS stop FROM n, (VALUES (FALSE, 0, 4), (FALSE, 2, 3), (TRUE, 3, 6)) r(\"left\", a, b)), sel AS (SELECT DISTINCT uuid, \"left\", unnest(range(start, stop)) AS frame FROM rg)"


@query(f"WITH {_IMG}, {_SEL} SELECT i.uuid, i.frame, \"left\", round((CASE WHEN \"left\" THEN fx ELSE px END)[1], 6) AS first, round((CASE WHEN \"left\" THEN fx ELSE px END)[64], 6) AS last FROM i JOIN sel ON sel.uuid = i.uuid AND sel.frame = i.frame")
def image_flip_correct(spark, sf):
    d = flips.corrected(_images(spark, sf), _ranges(_images(spark, sf)), 8)
    return rounded(d.select("uuid", "frame", "left", F.get("pixels", 0).alias("first"), F.get("pixels", 63).alias("last")), "first", "last")


@query(f"WITH {_SEL} SELECT uuid, \"left\", count(*) AS frames, CAST(sum(frame) AS BIGINT) AS total FROM sel GROUP BY ALL")
def frame_range_selection(spark, sf):
    return flips.selected(_ranges(_images(spark, sf))).groupBy("uuid", "left").agg(F.count("*").alias("frames"), F.sum("frame").alias("total"))


@query(f"WITH {_IMG} SELECT uuid, frame, round(list_sum(list_transform(range(1, 65), lambda j: fx[j] - px[j])), 6) + 0.0 AS gap, len(list_filter(px, lambda p: p BETWEEN 0 AND 0.1))::BIGINT AS inside FROM i")
def image_background_and_threshold(spark, sf):
    p = F.col("pixels")
    gap = F.aggregate(images.subtract(images.flip_x(p, 8), p), F.lit(0.0), lambda s, x: s + x)
    inside = F.size(F.filter(images.clipped(p, 0.0, 0.1), lambda x: x != 0)) + F.size(F.filter(p, lambda x: x == 0))
    d = rounded(_images(spark, sf).select("uuid", "frame", gap.alias("gap"), inside.cast("long").alias("inside")), "gap")
    return d.withColumn("gap", F.col("gap") + F.lit(0.0))


_ARENA = """e AS (SELECT label::BIGINT AS uuid, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS pixel FROM embeddings),
g AS (SELECT uuid, pixel, median(v) AS z, (pixel % 8)::DOUBLE AS x, (pixel // 8)::DOUBLE AS y FROM e GROUP BY uuid, pixel),
c AS (SELECT uuid, t, j, ((t * 3 + j + 1) * 2654435761) % 4294967296 * 64 // 4294967296 AS pixel FROM (SELECT DISTINCT uuid FROM g), range(100) AS r(t), range(3) AS s(j)),
k AS (SELECT uuid, t, max(x) FILTER (j = 0) AS x0, max(y) FILTER (j = 0) AS y0, max(z) FILTER (j = 0) AS z0, max(x) FILTER (j = 1) - x0 AS x1, max(y) FILTER (j = 1) - y0 AS y1, max(z) FILTER (j = 1) - z0 AS z1,
  max(x) FILTER (j = 2) - x0 AS x2, max(y) FILTER (j = 2) - y0 AS y2, max(z) FILTER (j = 2) - z0 AS z2 FROM c JOIN g USING (uuid, pixel) GROUP BY uuid, t),
p AS (SELECT uuid, t, (z1 * y2 - z2 * y1) / (x1 * y2 - x2 * y1) AS a, (x1 * z2 - x2 * z1) / (x1 * y2 - x2 * y1) AS b, z0 - a * x0 - b * y0 AS d FROM k WHERE x1 * y2 <> x2 * y1),
v AS (SELECT uuid, t, a, b, d, count(*) AS votes FROM g JOIN p USING (uuid) WHERE abs(z - (a * x + b * y + d)) <= 0.015 GROUP BY uuid, t, a, b, d QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY votes DESC, t) = 1),
q AS (SELECT uuid, any_value(votes) AS votes, covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(y, y) AS yy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM g JOIN v USING (uuid) WHERE abs(z - (a * x + b * y + d)) <= 0.015 GROUP BY uuid),
f AS (SELECT uuid, votes, (xz * yy - yz * xy) / (xx * yy - xy * xy) AS a, (yz * xx - xz * xy) / (xx * yy - xy * xy) AS b, mz - a * mx - b * my AS d FROM q)"""


@query(f"WITH {_ARENA} SELECT uuid, votes, round(a, 6) AS a, round(b, 6) AS b, round(d, 6) AS d FROM f")
def arena_floor(spark, sf):
    return rounded(arena.floors(arena.background(_images(spark, sf)), 8, 0.015), "a", "b", "d")


@query(f"WITH {_ARENA}, m AS (SELECT uuid, pixel, x, y, abs(z - (a * x + b * y + d)) <= 0.015 AS i FROM g JOIN f USING (uuid)), "
       "w AS (SELECT m.uuid, m.pixel, m.x, m.y, bool_or(n.i) AS i FROM m JOIN m n ON m.uuid = n.uuid AND abs(m.x - n.x) + abs(m.y - n.y) <= 1 GROUP BY ALL) "
       "SELECT w.uuid, w.pixel::INT AS pixel, bool_and(n.i) AS inside FROM w JOIN w n ON w.uuid = n.uuid AND n.x - w.x IN (-1, 0) AND n.y - w.y IN (-1, 0) GROUP BY ALL")
def arena_mask(spark, sf):
    background = arena.background(_images(spark, sf))
    flat = arena.on_floor(background, 8, arena.floors(background, 8, 0.015), 0.015)
    return arena.eroded(arena.dilated(flat, 8, arena.element("ellipse", (3, 3))), 8, arena.element("rect", (2, 2)))


@query()
def flip_classifier_accuracy(spark, sf):
    train, test = flips.split(flips.augmented(_images(spark, sf), 8), 20, "frame")
    return flips.accuracy(flips.fit(train), test)


@query()
def flip_classifier_apply(spark, sf):
    train, _ = flips.split(flips.augmented(_images(spark, sf), 8), 20, "frame")
    frames = _images(spark, sf).withColumn("angle", F.lit(0.0))
    return flips.apply(flips.fit(train), frames).select("uuid", "frame", "flip", "angle")


@query(f"WITH {tb.FRAMES}, g AS (SELECT min(value) AS a, max(value) AS b, min(k) AS c, max(k) AS d FROM fr), n AS (SELECT grp, syllable, least(floor((value - a) / (b - a) * 50), 49)::INT AS xbin, least(floor((k - c) / (d - c) * 50), 49)::INT AS ybin, count(*) AS n FROM fr, g GROUP BY ALL) SELECT grp, syllable, xbin, ybin, round(n / sum(n) OVER (PARTITION BY grp, syllable), 6) AS pdf FROM n")
def position_heatmap(spark, sf):
    return rounded(fp.position_heatmap(tb.labelled_frames(spark, sf), ["grp", "syllable"], "value", "k"), "pdf")


@query(f"WITH {tb.FRAMES}, g AS (SELECT min(value) AS a, max(value) AS b, min(k) AS c, max(k) AS d FROM fr), n AS (SELECT uuid, grp, syllable, least(floor((value - a) / (b - a) * 50), 49)::INT AS xbin, least(floor((k - c) / (d - c) * 50), 49)::INT AS ybin, count(*) AS n FROM fr, g GROUP BY ALL), "
       "h AS (SELECT *, n / sum(n) OVER (PARTITION BY uuid, grp, syllable) AS pdf FROM n), q AS (SELECT grp, syllable, count(DISTINCT uuid) AS m FROM h GROUP BY ALL) SELECT grp, syllable, xbin, ybin, round(sum(pdf) / any_value(m), 6) AS pdf FROM h JOIN q USING (grp, syllable) GROUP BY ALL")
def position_pdf_by_group(spark, sf):
    maps = fp.position_heatmap(tb.labelled_frames(spark, sf), ["uuid", "grp", "syllable"], "value", "k")
    return rounded(fp.mean_heatmap(maps, ["grp", "syllable"], ["uuid"]), "pdf")


@query(f"WITH {tb.STATS}, g AS (SELECT quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b, quantile_cont(k, 0.01) AS c, quantile_cont(k, 0.99) AS d FROM fr), x AS (SELECT uuid, 'value' AS scalar, value AS y, a AS lo, b AS hi FROM fr, g UNION ALL SELECT uuid, 'k', k, c, d FROM fr, g), "
       "n AS (SELECT uuid, scalar, CASE WHEN y BETWEEN lo AND hi THEN least(floor((y - lo) / (hi - lo) * 20), 19)::INT END AS bin, count(*) AS n FROM x GROUP BY ALL), h AS (SELECT uuid, scalar, bin, n / sum(n) OVER (PARTITION BY uuid, scalar) AS share FROM n) "
       "SELECT uuid, scalar, bin, round(share, 6) AS share FROM h WHERE bin IS NOT NULL UNION ALL SELECT uuid, 'usage', syllable, round(usage, 6) FROM s")
def fingerprint_hist(spark, sf):
    frames = tb.labelled_frames(spark, sf)
    return rounded(fp.fingerprint(frames, tb.session_stats(spark, sf), ("value", "k"), 20), "share")


@query(f"WITH {tb.LINES}, x AS (SELECT uuid, quantity AS y FROM l), g AS (SELECT min(y) AS lo, max(y) AS hi FROM x), n AS (SELECT uuid, least(floor((y - lo) / (hi - lo) * 10), 9)::INT AS bin, count(*) AS n FROM x, g GROUP BY ALL), h AS (SELECT uuid, 'quantity' AS scalar, bin, n / sum(n) OVER (PARTITION BY uuid) AS share FROM n) "
       "SELECT uuid, scalar, bin, round(coalesce((share - min(share) OVER (PARTITION BY uuid)) / nullif(max(share) OVER (PARTITION BY uuid) - min(share) OVER (PARTITION BY uuid), 0), 0), 6) AS share FROM h")
def fingerprint_scaled(spark, sf):
    h = fp.histograms(tb.line_frames(spark, sf), ("quantity",), 10, "full")
    return rounded(fp.scaled(h, ["uuid", "scalar"], "share"), "share")


# ---- sessions, sources, text


@query("SELECT 'user-' || user_id AS uuid, 'default' AS \"group\", min(strftime(ts, '%Y-%m-%d')) AS \"StartTime\", 'Customer-' || user_id AS \"SessionName\", 'results_' || user_id || '.h5' AS filename FROM events GROUP BY user_id")
def index_flatten(spark, sf):
    return sessions.flatten_index(_index(spark, sf), ["SessionName", "StartTime"]).drop("path")


def _index(spark, sf):
    e = tb.read(spark, sf, "events")
    u = F.col("user_id").cast("string")
    per = e.groupBy("user_id").agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("day"))
    meta = F.create_map(F.lit("SessionName"), F.concat(F.lit("Customer-"), u), F.lit("StartTime"), F.col("day"))
    path = F.array(F.concat(F.lit("/data/"), u, F.lit("/proc/results_"), u, F.lit(".h5")), F.concat(F.lit("/data/"), u, F.lit("/proc/results_"), u, F.lit(".yaml")))
    return per.select(F.concat(F.lit("user-"), u).alias("uuid"), F.lit("default").alias("group"), path.alias("path"), meta.alias("metadata"))


@query("SELECT 'user-' || u AS uuid, CASE WHEN u % 3 = 0 THEN 'treated' ELSE 'default' END AS \"group\" FROM (SELECT DISTINCT user_id AS u FROM events)")
def index_group_update(spark, sf):
    index = _index(spark, sf)
    updates = tb.read(spark, sf, "customer").where(F.col("c_custkey") % 3 == 0).select(F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("uuid"), F.lit("treated").alias("group"))
    return sessions.with_groups(index, updates).select("uuid", "group")


@query("SELECT DISTINCT 'user-' || user_id AS uuid FROM events WHERE contains('user-' || user_id, '-1')")
def uuid_lookup(spark, sf):
    return sessions.lookup(_index(spark, sf), "-1").select("uuid")


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS host, regexp_extract(url, '/([a-z]{2})/', 1) AS lang, TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS INT) AS number, 'syllable_' || TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS INT) || ' - ' || page_id AS label FROM pages""")
def session_name_regex(spark, sf):
    n = F.regexp_extract("url", "/([0-9]+)", 1).try_cast("int")
    return tb.read(spark, sf, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)/", 1).alias("host"), F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"), n.alias("number"), text.display_label(F.concat(F.lit("syllable_"), n.cast("string")), F.col("page_id")).alias("label"))


@query("""WITH m AS (SELECT p_partkey, 'syllable_sorted-id-' || lpad(CAST(p_size AS VARCHAR), 3, '0') || ' (usage)_original-id-' || lpad(CAST(p_partkey % 100 AS VARCHAR), 3, '0') || '.mp4' AS path FROM part) SELECT p_partkey, path AS crowd_movie_path, p_size AS sorted_id, 'usage' AS sort_type, CAST(p_partkey % 100 AS INT) AS original_id FROM m JOIN part USING (p_partkey)""")
def crowd_movie_ids(spark, sf):
    p = tb.read(spark, sf, "part")
    path = F.concat(F.lit("syllable_sorted-id-"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit(" (usage)_original-id-"), F.lpad((F.col("p_partkey") % 100).cast("string"), 3, "0"), F.lit(".mp4"))
    a, kind, b = text.movie_ids(F.col("crowd_movie_path"))
    return p.select("p_partkey", path.alias("crowd_movie_path")).withColumns({"sorted_id": a, "sort_type": kind, "original_id": b})


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def sessions_without_results(spark, sf):
    c = tb.read(spark, sf, "customer").select("c_custkey")
    return sessions.missing_from(c, tb.read(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT NOT EXISTS (SELECT 1 FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)) AS subset, NOT EXISTS (SELECT 1 FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)) AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)) AS equal")
def session_set_checks(spark, sf):
    e = tb.read(spark, sf, "events").select(F.col("user_id").alias("id"))
    return sessions.same_keys(e, tb.read(spark, sf, "customer").select(F.col("c_custkey").alias("id")), "id")


@query("SELECT o_orderkey AS path, 'dir-' || o_custkey AS folder, CASE WHEN count(*) OVER (PARTITION BY o_custkey) = 1 THEN 'dir-' || o_custkey ELSE 'rec-' || o_orderkey || '.dat' END AS name FROM orders WHERE o_orderkey % 2 = 0")
def session_discovery(spark, sf):
    o = tb.read(spark, sf, "orders")
    kind = F.when(F.col("o_orderkey") % 2 == 0, ".dat").otherwise(".txt")
    path = F.concat(F.lit("dir-"), F.col("o_custkey").cast("string"), F.lit("/rec-"), F.col("o_orderkey").cast("string"), kind)
    files = o.select(path.alias("path"), F.col("o_orderdate").alias("modificationTime"), F.lit(1).alias("length"))
    d = sessions.name_sessions(files, ["dat"])
    return d.select(F.regexp_extract("path", "rec-([0-9]+)", 1).cast("long").alias("path"), "folder", "name")


#: Orders as the files of their customers' sessions, what file each is by its number.
_KINDS = ("depth.dat", "ir.dat", "metadata.json", "proc/results_00.h5", "proc/results_00.yaml", "proc/results_00_flipped.mp4", "notes.txt")
_LISTING = "f AS (SELECT o_custkey AS c, o_orderkey % 7 AS k, '/data/dir-' || o_custkey || '/' || CASE o_orderkey % 7 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_KINDS)) + " END AS path FROM orders)"


def _listing(spark, sf):
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return tb.read(spark, sf, "orders").select(F.concat(F.lit("/data/dir-"), F.col("o_custkey").cast("string"), F.lit("/"), kind).alias("path"))


_STATES = f"{_LISTING}, s AS (SELECT '/data/dir-' || c AS folder, count(*) FILTER (k = 0) AS recordings, bool_or(k = 2) AS metadata, bool_or(k = 3) AS extracted, bool_or(k = 3) AND bool_or(k = 4) AS complete, bool_or(k = 5) AS flipped FROM f GROUP BY c HAVING count(*) FILTER (k = 0) > 0 OR bool_or(k = 3))"


@query(f"WITH {_STATES} SELECT * FROM s")
def session_states(spark, sf):
    return sessions.session_states(_listing(spark, sf))


@query(f"WITH {_STATES} SELECT count(*) AS sessions, count(*) FILTER (metadata) AS with_metadata, count(*) FILTER (extracted) AS extracted, count(*) FILTER (complete) AS complete, count(*) FILTER (flipped) AS flipped, FALSE AS pca, FALSE AS pca_scores, FALSE AS changepoints, FALSE AS \"index\", 0::BIGINT AS models FROM s")
def project_state(spark, sf):
    return sessions.project_state(_listing(spark, sf))


@query(f"WITH {_LISTING}, h AS (SELECT DISTINCT c FROM f WHERE k = 3), a AS (SELECT DISTINCT c FROM f WHERE k IN (0, 1)) SELECT 'dir-' || a.c AS name, '/data/dir-' || a.c || '/proc/results_00.h5' AS path FROM a JOIN h ON a.c = h.c")
def session_results(spark, sf):
    files = _listing(spark, sf)
    own = files.where(F.endswith("path", F.lit(".dat"))).select(F.regexp_extract("path", "/(dir-[0-9]+)/", 1).alias("name"), "path").dropDuplicates(["name"])
    return sessions.results_of(own, files)


@query("SELECT p_partkey, CASE WHEN TRUE THEN '#' || lpad(lower(printf('%x', least(255, floor((p_partkey % 256) * 1.6))::INT)), 2, '0') || lpad(lower(printf('%x', least(255, floor((p_size % 256) * 1.6))::INT)), 2, '0') || '1e' END AS colour FROM part")
def colorscale_hex(spark, sf):
    p = tb.read(spark, sf, "part")
    part = lambda c: F.lpad(F.lower(F.hex(c.cast("long") % 256)), 2, "0")
    raw = F.concat(F.lit("#"), part(F.col("p_partkey")), part(F.col("p_size")), F.lit("13"))
    return p.select("p_partkey", text.colorscale(raw, 1.6).alias("colour"))


@query(f"WITH {tb.FRAMES}, x AS (SELECT uuid, syllable, ts, sum(CASE WHEN ts - lag_ts < INTERVAL 600 SECOND THEN 0 ELSE 1 END) OVER (PARTITION BY uuid, syllable ORDER BY ts, event_id) AS g FROM (SELECT *, lag(ts) OVER (PARTITION BY uuid, syllable ORDER BY ts, event_id) AS lag_ts FROM fr)) SELECT uuid, syllable, count(*) AS frames, epoch_us(min(ts)) AS start, epoch_us(max(ts)) + 600000000 AS stop FROM x GROUP BY uuid, syllable, g")
def stream_label_sessions(spark, sf):
    d = stream.label_sessions(tb.labelled_frames(spark, sf))
    return d.select("uuid", "syllable", "frames", F.unix_micros("start").alias("start"), F.unix_micros("stop").alias("stop"))


@query(f"WITH {tb.FRAMES} SELECT syllable, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start, count(*) AS frames FROM fr GROUP BY ALL")
def stream_usage_by_hour(spark, sf):
    d = stream.usage_by_window(tb.labelled_frames(spark, sf))
    return d.select("syllable", F.unix_micros("start").alias("start"), "frames")


# the queries of the tables brought together register themselves
from . import aligned  # noqa: E402,F401
