"""Sessions in and out: index files, discovery of recordings, scalar tables, group edits, exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import basename, with_extension

INDEX_SCHEMA = "uuid string, `group` string, path array<string>, metadata map<string, string>"


def index_from_yaml(spark: SparkSession, text: str) -> DataFrame:
    """The sessions of an index document: uuid, group, path, filename, and a column for each metadata key.

    A list in the metadata counts as its first value, and every value as text."""
    import yaml

    doc = yaml.safe_load(text) or {}
    one = lambda v: None if v is None else str(v[0] if isinstance(v, list) and v else v)
    rows = [(str(f["uuid"]), str(f.get("group", "default")), [str(p) for p in f.get("path", [])], {str(k): one(v) for k, v in (f.get("metadata") or {}).items()}) for f in doc.get("files", [])]
    d = spark.createDataFrame(rows, INDEX_SCHEMA)
    keys = sorted({k for r in rows for k in r[3]})
    return flatten_index(d, keys)


def flatten_index(index: DataFrame, keys: Sequence[str]) -> DataFrame:
    columns = [F.try_element_at("metadata", F.lit(k)).alias(k) for k in keys]
    return index.select("uuid", "group", "path", *columns, basename(F.try_element_at("path", F.lit(1))).alias("filename"))


def index_to_yaml(index: DataFrame, pca_path: str = "") -> str:
    """The index as a document again, without derived columns; one entry per session."""
    import yaml

    fixed = {"uuid", "group", "path", "filename"}
    files = [{"uuid": r["uuid"], "group": r["group"], "path": list(r["path"] or []), "metadata": {k: v for k, v in r.asDict().items() if k not in fixed and v is not None}} for r in index.orderBy("uuid").collect()]
    return yaml.safe_dump({"files": files, "pca_path": pca_path}, sort_keys=False)


def with_groups(index: DataFrame, updates: DataFrame) -> DataFrame:
    """The index with the groups that `updates` (uuid, group) gives; others keep theirs."""
    u = updates.select(F.col("uuid").alias("_uuid"), F.col("group").alias("_group"))
    d = index.join(u, F.col("uuid") == F.col("_uuid"), "left")
    return d.withColumn("group", F.coalesce("_group", "group")).select(*index.columns)


def upserted(config: DataFrame, new: DataFrame, key: str, overwrite: bool = False) -> DataFrame:
    """Rows of new whose key config lacks are added; with overwrite, new rows also take the place of old ones."""
    if overwrite:
        return config.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)
    return config.unionByName(new.join(config.select(key), key, "left_anti"), allowMissingColumns=True)


def find_sessions(spark: SparkSession, folder: str, extensions: Sequence[str] = ("dat", "mkv", "avi", "tar.gz")) -> DataFrame:
    """path, folder, name, modified, bytes of recordings under a folder, any depth; infra-red films are left out.

    name is that of the file's folder, or of the file where its folder has several."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "modificationTime", "length")
    return name_sessions(files, extensions)


def name_sessions(files: DataFrame, extensions: Sequence[str]) -> DataFrame:
    """find_sessions over a listing (path, modificationTime, length)."""
    wanted = F.lit(False)
    for e in extensions:
        wanted = wanted | F.endswith("path", F.lit(f".{e}"))
    base, parts = basename(F.col("path")), F.split("path", "/")
    d = files.where(wanted & ~(F.contains(base, F.lit("ir.avi")) | F.contains(base, F.lit("ir.dat")))).withColumns({"folder": F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"), "_file": base})
    n = d.groupBy("folder").agg(F.count("*").alias("_n"))
    named = d.join(n, "folder").withColumn("name", F.when(F.col("_n") == 1, basename(F.col("folder"))).otherwise(F.col("_file")))
    return named.select("path", "folder", "name", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def session_paths(files: DataFrame, extracted: bool = False, flipped: bool = False, extensions: Sequence[str] = ("dat", "mkv", "avi")) -> DataFrame:
    """Sessions' files of a listing (path): recordings, of which .dat and .avi ones must be of depth; or extracted films in
    proc folders, flipped ones or those that are not. name is that of the session's folder, or of the file where the
    folder has several."""
    base, parts = basename(F.col("path")), F.split("path", "/")
    if extracted:
        wanted = (F.get(parts, F.size(parts) - 2) == "proc") & F.endswith(base, F.lit(".mp4")) & (F.endswith(base, F.lit("_flipped.mp4")) == F.lit(flipped))
        folder = F.get(parts, F.size(parts) - 3)
    else:
        wanted = F.lit(False)
        for e in extensions:
            of_depth = F.contains(base, F.lit("depth")) if e in ("dat", "avi") else F.lit(True)
            wanted = wanted | (F.endswith(base, F.lit(f".{e}")) & of_depth)
        folder = F.get(parts, F.size(parts) - 2)
    d = files.where(wanted).withColumns({"_folder": folder, "_base": base})
    n = d.groupBy("_folder").agg(F.count("*").alias("_n"))
    return d.join(n, "_folder").select("path", F.when(F.col("_n") == 1, F.col("_folder")).otherwise(F.col("_base")).alias("name"))


def resolved(sessions: DataFrame, *tables: DataFrame) -> DataFrame:
    """Sessions (name) with the path of their results: of the first of the tables (name, path) that has it, such as those
    of proc folders and of aggregate_results; sessions without any go."""
    d, paths = sessions, []
    for i, t in enumerate(tables):
        d = d.join(t.groupBy("name").agg(F.min("path").alias(f"_path{i}")), "name", "left")
        paths.append(F.col(f"_path{i}"))
    return d.select("name", F.coalesce(*paths).alias("path")).where("path is not null")


def results_of(sessions: DataFrame, files: DataFrame) -> DataFrame:
    """Sessions (name, path) with the path of their extraction, by a listing (path) of what there is: proc/results_00.h5 beside
    the session's file; else the file itself, if it is an .h5; else the .h5 beside its .mp4. Flipped ones, and sessions with
    none of these, go."""
    path = F.col("path")
    folder = F.regexp_replace(path, "/[^/]*$", "")
    ways = F.array(
        F.concat(folder, F.lit("/proc/results_00.h5")), F.when(F.endswith(path, F.lit(".h5")), path),
        F.when(F.endswith(path, F.lit(".mp4")), F.concat(F.expr("substr(path, 1, length(path) - 4)"), F.lit(".h5"))),
    )
    asked = sessions.where(~F.contains("name", F.lit("_flipped"))).select("name", F.col("path").alias("_own"), F.posexplode(ways).alias("_way", "path")).where("path IS NOT NULL")
    there = files.select("path").distinct()
    # an .mp4 must be there itself
    mp4 = files.where(F.endswith("path", F.lit(".mp4"))).select(F.col("path").alias("_own"), F.lit(True).alias("_film")).distinct()
    found = asked.join(there, "path", "left_semi").join(mp4, "_own", "left").where((F.col("_way") < 2) | F.col("_film"))
    return found.groupBy("name").agg(F.min_by("path", "_way").alias("path"))


#: The files that tell a finished step of a project, by the end of their path.
STEPS = {"pca": "/_pca/pca.h5", "pca_scores": "/_pca/pca_scores.h5", "changepoints": "/_pca/changepoints.h5", "index": "/moseq2-index.yaml"}
#: Endings of model files.
MODELS = (".p", ".pz", ".pkl", ".h5")


def session_states(files: DataFrame, extensions: Sequence[str] = ("dat", "mkv", "avi")) -> DataFrame:
    """One row per session folder of a listing (path): folder, recordings (depth ones), metadata, extracted, complete, flipped.

    All states come from one pass over the listing: files are keyed by their session's folder, a proc folder's by the one above."""
    base = basename(F.col("path"))
    folder = F.regexp_replace(F.regexp_replace("path", "/[^/]*$", ""), "/proc$", "")
    recorded = F.lit(False)
    for e in extensions:
        of_depth = F.contains(base, F.lit("depth")) if e in ("dat", "avi") else F.lit(True)
        recorded = recorded | (F.endswith(base, F.lit(f".{e}")) & of_depth)
    in_proc = F.col("path").rlike("/proc/[^/]*$")
    d = files.select(folder.alias("folder"), (recorded & ~in_proc).alias("r"), (base == "metadata.json").alias("m"), (in_proc & (base == "results_00.h5")).alias("h"), (in_proc & (base == "results_00.yaml")).alias("y"), (in_proc & F.endswith(base, F.lit("_flipped.mp4"))).alias("f"))
    states = d.groupBy("folder").agg(F.count_if("r").alias("recordings"), F.bool_or("m").alias("metadata"), F.bool_or("h").alias("extracted"), (F.bool_or("h") & F.bool_or("y")).alias("complete"), F.bool_or("f").alias("flipped"))
    return states.where((F.col("recordings") > 0) | F.col("extracted"))


def project_state(files: DataFrame, models: str = "/models/") -> DataFrame:
    """One row for a listing (path): sessions, with_metadata, extracted, complete, flipped, models, and whether each of STEPS is
    done; models are files under a folder of that name."""
    steps = {k: F.coalesce(F.bool_or(F.endswith("path", F.lit(v))), F.lit(False)) for k, v in STEPS.items()}
    ends = F.lit(False)
    for e in MODELS:
        ends = ends | F.endswith("path", F.lit(e))
    whole = files.agg(*[c.alias(k) for k, c in steps.items()], F.count_if(F.contains("path", F.lit(models)) & ends).alias("models"), F.lit(0).alias("_k"))
    n = lambda c: F.count_if(c).alias(c)
    sums = session_states(files).agg(F.count("*").alias("sessions"), F.count_if("metadata").alias("with_metadata"), n("extracted"), n("complete"), n("flipped"), F.lit(0).alias("_k"))
    return sums.join(whole, "_k").drop("_k")


def unextracted(sessions: DataFrame, results: DataFrame, metadata: DataFrame) -> DataFrame:
    """Sessions with metadata (folder) and without complete results (folder, complete)."""
    done = results.where(F.coalesce("complete", F.lit(False))).select("folder").distinct()
    return sessions.join(metadata.select("folder").distinct(), "folder", "left_semi").join(done, "folder", "left_anti")


def newest(models: DataFrame, time: str = "modified") -> DataFrame:
    return models.orderBy(F.desc(time), "path").limit(1)


def scalar_table(spark: SparkSession, paths: Sequence[str], sidecars: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Frames of many sessions' Parquet files as one table; sessions without a sidecar row (uuid, SessionName,
    SubjectName) are left out; grp is 'default'; columns that a file lacks are NULL."""
    tables = spark.read.option("mergeSchema", True).parquet(*paths)
    d = tables.join(F.broadcast(sidecars) if sidecars.limit(100_001).count() <= 100_000 else sidecars, "uuid").withColumn("grp", F.lit("default"))
    return d.withColumnsRenamed(dict(columns or {}))


def lookup(index: DataFrame, text: str) -> DataFrame:
    """Sessions whose uuid contains the text."""
    return index.where(F.contains("uuid", F.lit(text)))


def missing_from(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of a that b lacks."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: subset (a within b) and equal."""
    ab, ba = missing_from(a, b, key).agg(F.count("*").alias("n")), missing_from(b, a, key).agg(F.count("*").alias("n"))
    both = ab.withColumn("side", F.lit("a")).unionByName(ba.withColumn("side", F.lit("b")))
    n = lambda s: F.sum(F.when(F.col("side") == s, F.col("n")))
    return both.agg((n("a") == 0).alias("subset"), ((n("a") == 0) & (n("b") == 0)).alias("equal"))


def sidecar(path: Column) -> Column:
    """Where a film's metadata lies."""
    return with_extension(path, ".yaml")


def base64_blobs(spark: SparkSession, folder: str, glob: str = "*.mp4") -> DataFrame:
    """path, content as base64."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", F.base64("content").alias("content"))


def export_csv(table: DataFrame, path: str, by: str | None = None) -> None:
    writer = table.write.mode("overwrite").option("header", True)
    (writer.partitionBy(by) if by else writer).csv(path)


def cache_is_stale(cached: DataFrame, max_syllables: int) -> bool:
    """Whether stored statistics have fewer syllables than are asked for."""
    return cached.select(F.countDistinct("syllable")).first()[0] < max_syllables
