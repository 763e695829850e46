"""Operator 3: document fingerprints as Merkle trees over sections and paragraphs. DataFrame and SQL functions only.

A text is cut at blank lines into sections, these at line ends into paragraphs, and these into leaves, runs of a few words.
A leaf's hash is that of its words, any other node's that of its children's hashes in order, so equal roots mean equal
texts, and where roots differ, the differing branches lead to the edited leaves. How like two fingerprints are is found by
the same descent: what equal branches hold is alike, and of the leaves under branches that differ, the shared ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import n_shuffle

LEAF_WORDS = 8


def leaves(text: Column) -> Column:
    """The text as sections of paragraphs of leaves' hashes."""

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words), F.lit(LEAF_WORDS))
        return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(words, i, F.lit(LEAF_WORDS)), " "), 256))

    def of(paragraph: Column) -> Column:
        # bound by a one-element transform, so that a paragraph is split once
        return F.get(F.transform(F.array(F.split(paragraph, " ")), runs), 0)

    return F.transform(F.split(text, "\n\n"), lambda s: F.transform(F.split(s, "\n"), of))


def paragraphs(leaves: Column) -> Column:
    """Sections, as arrays of their paragraphs' hashes."""
    return F.transform(leaves, lambda s: F.transform(s, lambda p: F.sha2(F.array_join(p, ""), 256)))


def sections(paragraphs: Column) -> Column:
    """The sections' hashes."""
    return F.transform(paragraphs, lambda ps: F.sha2(F.array_join(ps, ""), 256))


def root(sections: Column) -> Column:
    """The fingerprint: lowercase hex hash of the sections' hashes."""
    return F.sha2(F.array_join(sections, ""), 256)


def _unlike(leaves: Column, mine: tuple[Column, Column], other: tuple[Column, Column]) -> Column:
    """The leaves under paragraphs that differ from the other tree's at their place; (paragraphs, sections) are the hashes
    of either tree, and only sections that differ are looked into."""
    (own_paragraphs, own_sections), (paragraphs, sections) = mine, other
    odd = F.filter(F.sequence(F.lit(0), F.size(own_sections) - 1), lambda i: ~F.get(own_sections, i).eqNullSafe(F.get(sections, i)))

    def within(i: Column) -> Column:
        return F.flatten(F.filter(F.get(leaves, i), lambda _, j: ~F.get(F.get(own_paragraphs, i), j).eqNullSafe(F.get(F.get(paragraphs, i), j))))

    return F.flatten(F.transform(odd, within))


def n_leaves(leaves: Column) -> Column:
    return F.aggregate(leaves, F.lit(0), lambda n, s: n + F.aggregate(s, F.lit(0), lambda m, p: m + F.size(p)))


def likeness(total: Column, own: Column, other: Column) -> Column:
    """Of a tree with so many leaves: those under equal branches and those, of the leaves under branches that differ (own
    and the other tree's, once each), that are shared; as a share of the larger tree's. 1 for equal trees."""
    alike, own_set, other_set = total - F.size(own), F.array_distinct(own), F.array_distinct(other)
    return (alike + F.size(F.array_intersect(own_set, other_set))) / (alike + F.greatest(F.size(own_set), F.size(other_set)))


def differing(a: Column, b: Column, ha: Column, hb: Column) -> Column:
    """(section, paragraph) numbers of the branches that differ, from the paragraphs' and sections' hashes; only sections
    whose hashes differ are looked into."""
    odd = F.filter(F.sequence(F.lit(0), F.greatest(F.size(ha), F.size(hb)) - 1), lambda i: ~F.get(ha, i).eqNullSafe(F.get(hb, i)))

    def within(pair: Column, i: Column) -> Column:
        x, y = pair["x"], pair["y"]
        every = F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y)) - 1)
        return F.transform(F.filter(every, lambda j: ~F.get(x, j).eqNullSafe(F.get(y, j))), lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    pairs = F.transform(odd, lambda i: F.struct(i.alias("i"), F.get(a, i).alias("x"), F.get(b, i).alias("y")))
    return F.flatten(F.transform(pairs, lambda p: within(p, p["i"])))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the text of the next row in ascending order of doc_id (ties by text, null ids last);
    after the last comes the first. Null texts are empty here; a lone row is its own next; repeated rows follow each other.

    Rows are dealt by ranges of the id, and each range also gets the next range's first row, so no task sees all."""
    spark = docs.sparkSession
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = 3 * n_shuffle(spark)
    cuts = sorted(set(d.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000).alias("c")).first()["c"] or []))
    under = F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    d = d.withColumn("_part", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(under))
    # one row for each range: its first id
    starts = sorted(d.groupBy("_part").agg(F.min("doc_id").alias("first")).collect(), key=lambda r: r["_part"])
    links = [(starts[i - 1]["_part"], i == 0, r["_part"], r["first"]) for i, r in enumerate(starts)]
    goes = spark.createDataFrame(links, "_to int, _wraps boolean, _of int, _first long")
    joined = d.join(F.broadcast(goes), (F.col("_part") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_first")))
    tails = joined.select("doc_id", "text", F.col("_to").alias("_part"), F.lit(1).alias("_tail"))
    w = Window.partitionBy("_part").orderBy("_tail", F.col("doc_id").asc_nulls_last(), "text")
    both = d.withColumn("_tail", F.lit(0)).unionByName(tails)
    return both.withColumn("next_text", F.lead("text").over(w)).where("_tail = 0").select("doc_id", "text", "next_text")


def edited(text: Column, other: Column) -> Column:
    """The text with its last quarter of code points replaced by as many of the other's first, or all of them."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.left(text, F.length(text) - quarter), F.left(other, quarter))


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, leaves, paragraphs and sections of every row's whole text. A null text counts as empty; other
    columns are not read."""
    d = docs.select("doc_id", leaves(F.coalesce("text", F.lit(""))).alias("leaves"))
    d = d.withColumn("paragraphs", paragraphs(F.col("leaves"))).withColumn("sections", sections(F.col("paragraphs")))
    return d.withColumn("fingerprint", root(F.col("sections")))


def edits(docs: DataFrame) -> DataFrame:
    """For every row: its fingerprint, that of its edited text, how like it is to that and to the next row's, and the
    (section, paragraph) of the first and the number of all branches that the edit changed."""
    d = with_next(docs).withColumn("other", edited(F.col("text"), F.col("next_text")))
    d = d.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("other", 256).alias("edited_sha256"),
        leaves(F.col("text")).alias("la"), leaves(F.col("other")).alias("lb"), leaves(F.col("next_text")).alias("lc"),
    )
    d = d.withColumns({x: paragraphs(F.col(f"l{x}")) for x in "abc"})
    d = d.withColumns({f"h{x}": sections(F.col(x)) for x in "abc"})
    tree = {x: (F.col(x), F.col(f"h{x}")) for x in "abc"}
    d = d.withColumns({f"u{x}{y}": _unlike(F.col(f"l{x}"), tree[x], tree[y]) for x, y in ("ab", "ba", "ac", "ca")}).withColumn("n", n_leaves(F.col("la")))
    d = d.withColumn("odd", differing(F.col("a"), F.col("b"), F.col("ha"), F.col("hb")))
    return d.select(
        "doc_id", "n_chars", "edited_sha256", root(F.col("ha")).alias("fingerprint"), root(F.col("hb")).alias("edited_fingerprint"),
        likeness(F.col("n"), F.col("uab"), F.col("uba")).alias("near_edited"), likeness(F.col("n"), F.col("uac"), F.col("uca")).alias("near_next"),
        F.get("odd", 0)["section"].alias("first_section"), F.get("odd", 0)["paragraph"].alias("first_paragraph"), F.size("odd").alias("n_branches"),
    )


#: The same for DuckDB.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id NULLS LAST, text), first_value(text) OVER (ORDER BY doc_id NULLS LAST, text)) AS nxt FROM d),
e AS (SELECT *, left(text, length(text) - length(text) // 4) || left(nxt, length(text) // 4) AS other FROM n),
w AS (SELECT *,
  list_transform(string_split(text, '\n\n'), lambda s: list_transform(string_split(s, '\n'), lambda p: string_split(p, ' '))) AS wa,
  list_transform(string_split(other, '\n\n'), lambda s: list_transform(string_split(s, '\n'), lambda p: string_split(p, ' '))) AS wb,
  list_transform(string_split(nxt, '\n\n'), lambda s: list_transform(string_split(s, '\n'), lambda p: string_split(p, ' '))) AS wc FROM e),
l AS (SELECT *,
  list_transform(wa, lambda s: list_transform(s, lambda p: list_transform(range(0, (len(p) + 7) // 8), lambda i: sha256(array_to_string(p[i * 8 + 1 : i * 8 + 8], ' '))))) AS la,
  list_transform(wb, lambda s: list_transform(s, lambda p: list_transform(range(0, (len(p) + 7) // 8), lambda i: sha256(array_to_string(p[i * 8 + 1 : i * 8 + 8], ' '))))) AS lb,
  list_transform(wc, lambda s: list_transform(s, lambda p: list_transform(range(0, (len(p) + 7) // 8), lambda i: sha256(array_to_string(p[i * 8 + 1 : i * 8 + 8], ' '))))) AS lc FROM w),
h AS (SELECT *,
  list_transform(la, lambda s: list_transform(s, lambda p: sha256(array_to_string(p, '')))) AS ha,
  list_transform(lb, lambda s: list_transform(s, lambda p: sha256(array_to_string(p, '')))) AS hb,
  list_transform(lc, lambda s: list_transform(s, lambda p: sha256(array_to_string(p, '')))) AS hc FROM l),
o AS (SELECT *, flatten(list_transform(range(0, greatest(len(ha), len(hb))), lambda i: list_transform(
  list_filter(range(0, greatest(coalesce(len(ha[i + 1]), 0), coalesce(len(hb[i + 1]), 0))), lambda j: ha[i + 1][j + 1] IS DISTINCT FROM hb[i + 1][j + 1]), lambda j: [i, j]))) AS odd,
  flatten(list_transform(range(0, len(ha)), lambda i: flatten(list_transform(list_filter(range(0, len(ha[i + 1])), lambda j: ha[i + 1][j + 1] IS DISTINCT FROM hb[i + 1][j + 1]), lambda j: la[i + 1][j + 1])))) AS uab,
  flatten(list_transform(range(0, len(hb)), lambda i: flatten(list_transform(list_filter(range(0, len(hb[i + 1])), lambda j: hb[i + 1][j + 1] IS DISTINCT FROM ha[i + 1][j + 1]), lambda j: lb[i + 1][j + 1])))) AS uba,
  flatten(list_transform(range(0, len(ha)), lambda i: flatten(list_transform(list_filter(range(0, len(ha[i + 1])), lambda j: ha[i + 1][j + 1] IS DISTINCT FROM hc[i + 1][j + 1]), lambda j: la[i + 1][j + 1])))) AS uac,
  flatten(list_transform(range(0, len(hc)), lambda i: flatten(list_transform(list_filter(range(0, len(hc[i + 1])), lambda j: hc[i + 1][j + 1] IS DISTINCT FROM ha[i + 1][j + 1]), lambda j: lc[i + 1][j + 1])))) AS uca,
  len(flatten(flatten(la))) AS n FROM h)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(other) AS edited_sha256,
  sha256(array_to_string(list_transform(ha, lambda s: sha256(array_to_string(s, ''))), '')) AS fingerprint,
  sha256(array_to_string(list_transform(hb, lambda s: sha256(array_to_string(s, ''))), '')) AS edited_fingerprint,
  (n - len(uab) + len(list_intersect(uab, uba)))::DOUBLE / (n - len(uab) + greatest(len(list_distinct(uab)), len(list_distinct(uba)))) AS near_edited,
  (n - len(uac) + len(list_intersect(uac, uca)))::DOUBLE / (n - len(uac) + greatest(len(list_distinct(uac)), len(list_distinct(uca)))) AS near_next,
  odd[1][1]::INT AS first_section, odd[1][2]::INT AS first_paragraph, len(odd)::INT AS n_branches
FROM o"""
