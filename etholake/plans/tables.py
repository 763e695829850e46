"""The engine's tables from the driver's: users are sessions, their market segment the group, event types the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import frames as fr
from ..operators import stats as st

KEYS = ["uuid", "grp", "SessionName", "SubjectName"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with the raw label event_type and the scalars value and k."""
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("uuid"), "event_id", "ts", "event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uuid"), F.col("c_mktsegment").alias("grp"), F.col("c_name").alias("SessionName"), F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("SubjectName"))
    return fr.numbered(fr.nan_as_null(e, ["value", "k"]).join(c, "uuid"), "ts", "event_id")


def labelled_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with syllable, the label's place by descending number of frames."""
    return fr.relabelled(event_frames(spark, sf_dir), "event_type", "frames")


def session_stats(spark: SparkSession, sf_dir: str, count: str = "usage") -> DataFrame:
    return st.behavioural_stats(labelled_frames(spark, sf_dir), KEYS, ("value", "k"), count)


def line_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as sessions of line items with four scalars; quantity is taken for an area, discount for a speed."""
    d = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("uuid"), F.col("l_returnflag").alias("grp"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return fr.nan_as_null(d, ["quantity", "price", "discount", "tax"])


#: The same tables as SQL, for the oracles.
FRAMES = """
f AS (SELECT user_id AS uuid, c_mktsegment AS grp, c_name AS SessionName, 'nation-' || c_nationkey AS SubjectName, event_id, ts, event_type, value,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame
  FROM events JOIN customer ON user_id = c_custkey),
o AS (SELECT event_type, n, CAST(row_number() OVER (ORDER BY n DESC, event_type) - 1 AS INT) AS syllable FROM (SELECT event_type, count(*) AS n FROM f GROUP BY event_type)),
fr AS (SELECT f.*, o.syllable FROM f JOIN o USING (event_type))"""
BOUTS = FRAMES + """,
w AS (SELECT *, sum(new) OVER (PARTITION BY uuid ORDER BY frame) AS run FROM (SELECT *, CASE WHEN syllable <> lag(syllable) OVER (PARTITION BY uuid ORDER BY frame) THEN 1 ELSE 0 END AS new FROM fr)),
b AS (SELECT uuid, grp, SessionName, SubjectName, CAST(run AS BIGINT) AS run, syllable, min(frame) AS start, count(*) AS frames, avg(value) AS value FROM w GROUP BY uuid, grp, SessionName, SubjectName, run, syllable)"""
STATS = BOUTS + """,
s0 AS (SELECT uuid, grp, SessionName, SubjectName, syllable, count(*) AS bouts, CAST(sum(frames) AS BIGINT) AS frames, avg(frames) / 30 AS duration FROM b GROUP BY ALL),
v AS (SELECT uuid, syllable, avg(value) AS value_mean, stddev_samp(value) AS value_std, min(value) AS value_min, max(value) AS value_max,
  avg(k) AS k_mean, stddev_samp(k) AS k_std, min(k) AS k_min, max(k) AS k_max FROM fr GROUP BY ALL),
s AS (SELECT s0.*, bouts / sum(bouts) OVER (PARTITION BY uuid) AS usage, frames / sum(frames) OVER (PARTITION BY uuid) AS share, v.* EXCLUDE (uuid, syllable) FROM s0 JOIN v USING (uuid, syllable))"""
EDGES = BOUTS + """,
t AS (SELECT uuid, grp, syllable AS src, lead(syllable) OVER (PARTITION BY uuid ORDER BY run) AS dst FROM b),
e AS (SELECT grp, src, dst, count(*) AS n FROM t WHERE dst IS NOT NULL GROUP BY ALL),
p AS (SELECT *, n / sum(n) OVER (PARTITION BY grp) AS p FROM e)"""
LINES = """
l AS (SELECT l_suppkey AS uuid, l_returnflag AS grp, l_orderkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem)"""
