"""Transitions between syllables, their normalisation and entropy, graphs of them and differences of groups.

Matrices are edge lists; frames shrink to bouts, bouts to edges, and all that follows works on edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NORMALISATIONS = ("bigram", "rows", "columns")


def steps(b: DataFrame, max_syllables: int | None = None) -> DataFrame:
    """One row per transition from a bout to the next in its session: uuid, grp, src, dst."""
    nxt = F.lead("syllable").over(Window.partitionBy("uuid").orderBy("run"))
    out = b.withColumn("dst", nxt).where("dst IS NOT NULL AND syllable >= 0 AND dst >= 0").withColumnRenamed("syllable", "src")
    if max_syllables is not None:
        out = out.where((F.col("src") < max_syllables) & (F.col("dst") < max_syllables))
    return out.select("uuid", "grp", "src", "dst")


def edges(s: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    return s.groupBy(*by, "src", "dst").agg(F.count("*").alias("n"))


def normalised(e: DataFrame, how: str = "bigram", by: Sequence[str] = ("grp",), smoothing: float = 0.0, k: int | None = None) -> DataFrame:
    """p: an edge's share of all transitions, of those out of its source (rows) or into its target (columns).

    Smoothing is added to every cell of the matrix of k syllables, seen or not; a cell without an edge has no row here."""
    if how not in NORMALISATIONS:
        raise ValueError(f"how must be one of {NORMALISATIONS}, not {how!r}")
    if smoothing and k is None:
        raise ValueError("smoothing needs k, the number of syllables")
    within = {"bigram": [], "rows": ["src"], "columns": ["dst"]}[how]
    cells = (k * k if how == "bigram" else k) if smoothing else 0
    return e.withColumn("p", (F.col("n") + smoothing) / (F.sum("n").over(Window.partitionBy(*by, *within)) + smoothing * cells))


def dense(e: DataFrame, k: int, by: Sequence[str] = ("grp",)) -> DataFrame:
    """Every pair of the first k syllables for each key, with p 0 where there is no edge."""
    keys = e.select(*by).distinct()
    ids = F.sequence(F.lit(0), F.lit(k - 1))
    every = keys.withColumn("src", F.explode(ids)).withColumn("dst", F.explode(ids))
    return every.join(e.select(*by, "src", "dst", "p"), [*by, "src", "dst"], "left").fillna(0.0, subset=["p"])


def entropies(s: DataFrame, base: float = 2.0, smoothing: float = 0.0, k: int | None = None) -> DataFrame:
    """grp, syllable, ent_out, ent_in: the means over sessions of the entropy of what follows and precedes a syllable.

    With smoothing, a session's row has k cells, of which those without an edge are alike: their part is in closed form,
    so nothing is made dense; a session without the syllable has log k, and every group has all k syllables. Without it, only
    sessions with the syllable count."""
    if smoothing and k is None:
        raise ValueError("smoothing needs k, the number of syllables")
    e = edges(s, ("uuid", "grp"))
    log = lambda x: F.log(x) / F.log(F.lit(base))

    def one(end: str, name: str) -> DataFrame:
        if not smoothing:
            p = normalised(e, {"src": "rows", "dst": "columns"}[end], ("uuid", "grp"))
            per = p.groupBy("uuid", "grp", F.col(end).alias("syllable")).agg(F.sum(-F.col("p") * log(F.col("p"))).alias("_e"))
            return per.groupBy("grp", "syllable").agg(F.avg("_e").alias(name))
        # -sum(p log p) with p = m / t is log t - sum(m log m) / t, where m is smoothing in every cell without an edge
        m = F.col("n") + smoothing
        t = F.sum("n") + smoothing * k
        empty = (k - F.count("*")) * (smoothing * log(F.lit(float(smoothing))))
        per = e.groupBy("uuid", "grp", F.col(end).alias("syllable")).agg((log(t) - (F.sum(m * log(m)) + empty) / t).alias("_e"))
        sums = per.groupBy("grp", "syllable").agg(F.sum("_e").alias("_e"), F.count("*").alias("_with"))
        cohorts = e.groupBy("grp").agg(F.countDistinct("uuid").alias("_all"))
        every = cohorts.withColumn("syllable", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).join(sums, ["grp", "syllable"], "left")
        with_ = F.coalesce("_with", F.lit(0))
        return every.select("grp", "syllable", ((F.coalesce("_e", F.lit(0.0)) + (F.col("_all") - with_) * log(F.lit(float(k)))) / F.col("_all")).alias(name))

    return one("src", "ent_out").join(one("dst", "ent_in"), ["grp", "syllable"], "full")


def differences(values: DataFrame, on: Sequence[str], columns: Sequence[str], group: str = "grp") -> DataFrame:
    """series ('b-a' for groups a < b), on, and b's values less a's; what a group lacks is 0.

    Each side has a row for each group and key; pairs of groups are joined on the key, so this is an equi-join."""
    groups = [r[0] for r in values.select(group).distinct().orderBy(group).collect()]  # a handful of cohorts
    keyed = values.groupBy(*on).agg(F.map_from_entries(F.collect_list(F.struct(F.col(group), F.struct(*columns)))).alias("_m"))
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for i, a in enumerate(groups) for b in groups[i + 1 :]])
    if len(groups) < 2:
        kind = values.schema[group].dataType.simpleString()
        pairs = F.array().cast(f"array<struct<a:{kind},b:{kind}>>")
    out = keyed.withColumn("_p", F.explode(pairs)).where(F.map_contains_key("_m", F.col("_p.a")) | F.map_contains_key("_m", F.col("_p.b")))
    value = lambda side, c: F.coalesce(F.try_element_at("_m", F.col(f"_p.{side}"))[c], F.lit(0.0))
    return out.select(F.concat_ws("-", "_p.b", "_p.a").alias("series"), *on, *[(value("b", c) - value("a", c)).alias(c) for c in columns])


def thresholded(e: DataFrame, usage: DataFrame, p: tuple[float, float] = (0.0, 1.0), u: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """Edges whose p, and whose ends' usage in the group, are in range (inclusive)."""
    nodes = usage.where(F.col("usage").between(*u)).select("grp", "syllable")
    ends = lambda name: nodes.withColumnRenamed("syllable", name)
    return e.where(F.col("p").between(*p)).join(ends("src"), ["grp", "src"], "left_semi").join(ends("dst"), ["grp", "dst"], "left_semi")


def orphans(nodes: DataFrame, e: DataFrame) -> DataFrame:
    """Nodes (grp, syllable) that no edge touches."""
    touched = e.select("grp", F.col("src").alias("syllable")).union(e.select("grp", F.col("dst").alias("syllable"))).distinct()
    return nodes.select("grp", "syllable").join(touched, ["grp", "syllable"], "left_anti")


def anchored(e: DataFrame, anchor: str) -> DataFrame:
    """The edges of all groups whose ends the anchor group's graph has."""
    pairs = e.where(F.col("grp") == anchor).select("src", "dst")
    return e.join(F.broadcast(pairs), ["src", "dst"], "left_semi")


def neighbours(e: DataFrame) -> DataFrame:
    """grp, node, successors and predecessors, heaviest first (ties by id)."""
    heavy = lambda c: F.transform(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("w"), F.col(c).alias("id")))), lambda x: x["id"])
    out = e.groupBy("grp", F.col("src").alias("node")).agg(heavy("dst").alias("successors"))
    into = e.groupBy("grp", F.col("dst").alias("node")).agg(heavy("src").alias("predecessors"))
    empty = F.array().cast("array<int>")
    return out.join(into, ["grp", "node"], "full").select("grp", "node", F.coalesce("successors", empty).alias("successors"), F.coalesce("predecessors", empty).alias("predecessors"))


def edge_classes(e: DataFrame, node: Column) -> DataFrame:
    """Edges at a node, as 'in', 'out', or 'both' where the reversed edge is there too."""
    back = e.select("grp", F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(True).alias("_back"))
    near = e.where((F.col("src") == node) | (F.col("dst") == node)).join(back, ["grp", "src", "dst"], "left")
    return near.withColumn("class", F.when(F.col("_back"), "both").when(F.col("src") == node, "out").otherwise("in")).drop("_back")


def bidirectional(e: DataFrame) -> DataFrame:
    """Edges whose reverse is there too."""
    back = e.select("grp", F.col("dst").alias("src"), F.col("src").alias("dst"))
    return e.join(back, ["grp", "src", "dst"], "left_semi")


def edge_style(e: DataFrame, difference: bool = False) -> DataFrame:
    """width and colour of edges: differences by sign."""
    p = F.col("p")
    if difference:
        return e.withColumns({"width": F.abs(p) * 400, "colour": F.when(p > 0, "blue").otherwise("red")})
    return e.withColumns({"width": p * 250, "colour": F.lit("black")})


def node_style(nodes: DataFrame, difference: bool = False) -> DataFrame:
    """size and colour of nodes by usage."""
    u = F.abs(F.col("usage") * 1000)
    if difference:
        return nodes.withColumns({"size": F.greatest(F.lit(15.0), 15 + u), "colour": F.when(F.col("usage") > 0, "blue").otherwise("red")})
    return nodes.withColumns({"size": F.greatest(F.lit(15.0), u), "colour": F.lit("red")})


def weight_range(e: DataFrame, by: Sequence[str] = ("grp",)) -> DataFrame:
    """Least and greatest weight of either sign, 0 where there is none; and the greatest, rounded up to thousandths."""
    p = F.col("p")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return e.groupBy(*by).agg(
        zero(F.min(F.when(p > 0, p))).alias("up_min"), zero(F.max(F.when(p > 0, p))).alias("up_max"),
        zero(F.min(F.when(p < 0, p))).alias("down_min"), zero(F.max(F.when(p < 0, p))).alias("down_max"),
        (F.ceil(F.max(F.abs(p)) * 1000) / 1000).alias("slider"),
    )


def circular_layout(nodes: DataFrame) -> DataFrame:
    """x, y: a group's nodes around a circle, in order of syllable."""
    w = Window.partitionBy("grp").orderBy("syllable")
    angle = 2 * F.pi() * (F.row_number().over(w) - 1) / F.count("*").over(Window.partitionBy("grp"))
    return nodes.withColumns({"x": F.cos(angle), "y": F.sin(angle)})


def spring_layout(nodes: DataFrame, e: DataFrame, rounds: int = 50, seed: int = 0) -> DataFrame:
    """grp, syllable, x, y: force-directed layouts (Fruchterman and Reingold 1991) of all groups' graphs at once, scaled into
    the unit square about 0. Nodes begin at places hashed from the seed and their syllable, so a layout is the same whenever
    it is drawn; edges pull with their p, and every node pushes every other.

    A graph is one row, its nodes and the matrix of its edges as arrays: a model's syllables are some hundreds at most."""
    part = lambda salt: F.pmod(F.xxhash64("syllable", F.lit(seed), F.lit(salt)), F.lit(1_000_003)) / 1_000_003.0
    drawn = nodes.select("grp", "syllable").distinct().withColumns({"x": part(0), "y": part(1)})
    graph = drawn.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("syllable", "x", "y"))).alias("_p"))
    ends = graph.select("grp", F.col("_p.syllable").alias("_ids")).select("grp", "_ids", F.explode("_ids").alias("src")).select("grp", "src", F.explode("_ids").alias("dst"))
    cells = ends.join(e.select("grp", "src", "dst", "p"), ["grp", "src", "dst"], "left").groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("src", "dst", F.coalesce("p", F.lit(0.0)).alias("p")))).alias("_e"))
    d = graph.join(cells, "grp").select("grp", "_p", F.col("_e.p").alias("_a"), F.size("_p").alias("_n"))
    xs, ys = F.col("_p.x"), F.col("_p.y")
    reach = F.greatest(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys)) * 0.1
    best = F.sqrt(1.0 / F.col("_n"))

    def force(p: Column, i: Column) -> Column:
        def add(s: Column, j: Column) -> Column:
            dx, dy = F.get(p, i)["x"] - F.get(p, j)["x"], F.get(p, i)["y"] - F.get(p, j)["y"]
            far = F.greatest(F.sqrt(dx * dx + dy * dy), F.lit(0.01))
            push = best * best / (far * far) - F.get("_a", i * F.col("_n") + j) * far / best
            return F.struct((s["x"] + dx * push).alias("x"), (s["y"] + dy * push).alias("y"))

        return F.aggregate(F.sequence(F.lit(0), F.col("_n") - 1), F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), add)

    def moved(p: Column, heat: Column) -> Column:
        forces = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.struct(F.get(p, i).alias("p"), force(p, i).alias("f")))
        step = lambda v: heat / F.greatest(F.sqrt(v["f"]["x"] * v["f"]["x"] + v["f"]["y"] * v["f"]["y"]), F.lit(0.01))
        return F.transform(forces, lambda v: F.struct((v["p"]["x"] + v["f"]["x"] * step(v)).alias("x"), (v["p"]["y"] + v["f"]["y"] * step(v)).alias("y")))

    start = F.transform("_p", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    places = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, lambda p, k: moved(p, F.col("_reach") * (1 - k / (rounds + 1.0))))
    d = d.withColumn("_reach", reach).select("grp", F.col("_p.syllable").alias("_ids"), places.alias("_q"))
    mean = lambda c: F.aggregate(F.col(f"_q.{c}"), F.lit(0.0), lambda s, v: s + v) / F.size("_q")
    d = d.withColumns({"_mx": mean("x"), "_my": mean("y")})
    wide = F.greatest(F.array_max(F.transform(F.col("_q.x"), lambda v: F.abs(v - F.col("_mx")))), F.array_max(F.transform(F.col("_q.y"), lambda v: F.abs(v - F.col("_my")))))
    out = d.withColumn("_w", wide).select("grp", "_mx", "_my", "_w", F.explode(F.arrays_zip("_ids", "_q")).alias("_z"))
    at = lambda c: F.coalesce(F.try_divide(F.col(f"_z._q.{c}") - F.col(f"_m{c}"), F.col("_w")), F.lit(0.0)).alias(c)
    return out.select("grp", F.col("_z._ids").alias("syllable"), at("x"), at("y"))


def graph_grid(names: Sequence[str], groups: Sequence[str]) -> list[list[str | None]]:
    """Upper triangle of graphs: groups down the diagonal, the differences beside it, row by row in the order given."""
    others = iter([x for x in names if x not in set(groups)])
    n = len(groups)
    return [[None if j < i else groups[i] if j == i else next(others, None) for j in range(n)] for i in range(n)]
