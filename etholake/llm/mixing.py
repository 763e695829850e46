"""Operator 5: mixing sources to target weights with a multivariate-hypergeometric splitting tree. DataFrame and SQL functions only.

Each source's documents stand in a line in random (hashed) order, one word after the other. The line is cut into blocks
of equal numbers of words and may be passed over twice; the source's quota is a number of blocks. A splitting tree shares
the quotas out among output shards: each node's blocks are halved, and how many of each source go left is drawn from the
multivariate hypergeometric distribution, one source after the other. So every shard has its exact number of blocks, as
if all blocks had been shuffled together, but nothing larger than the table of quotas is looked at to decide it. Shards
draw disjoint runs of each pass's permuted blocks and shuffle them locally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import WORD, written

WEIGHTS = (3, 1, 2)
RATIO, CAP = 1.5, 2.0
BLOCK_WORDS = 256
#: Blocks that an output shard should hold; documents of a source that a task puts in line at a time.
SHARD_BLOCKS, LINE_DOCS = 1_024, 2_000
#: Levels of the splitting tree that one task grows; below, its nodes are dealt to tasks.
TOP_LEVELS = 10
SEED = 17
#: The sixteen largest primes below 2^31, steps of permutations of a pass's blocks.
PRIMES = (
    2_147_483_647, 2_147_483_629, 2_147_483_587, 2_147_483_579, 2_147_483_563, 2_147_483_549, 2_147_483_543, 2_147_483_497,
    2_147_483_489, 2_147_483_477, 2_147_483_423, 2_147_483_399, 2_147_483_353, 2_147_483_323, 2_147_483_269, 2_147_483_249,
)


def n_words(text: Column) -> Column:
    """Number of words of the whole text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Sorts as the source does by code points, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sized: DataFrame, ratio: float = RATIO, cap: float = CAP, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per source: _key, docs, source_size, target.

    Weights repeat over the sources in order. All targets together are ratio times all sizes; a target stops at cap times
    its source's size, and the excess is shared by weight among the others until none is above: there is one level L
    with target = least(cap * size, L * weight), found from running sums over the sources by cap * size / weight."""
    by = sized.groupBy("_key").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    # one row for each source: these windows see as many rows as there are sources
    rank = F.row_number().over(Window.orderBy("_key")) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    by = by.withColumn("weight", w).withColumn("most", cap * F.col("source_size")).withColumn("goal", ratio * F.sum("source_size").over(everything))
    order = Window.orderBy(F.col("most") / F.col("weight"), "_key")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumn("level", (F.col("goal") - before) / rest)
    level = F.max("level").over(everything)
    return by.select("_key", "docs", "source_size", F.least("most", level * F.col("weight")).alias("target"))


#: Draws how many of K marked among N blocks lie in the n that go left, by the uniform u: the inverse of the
#: distribution function, with weights relative to eight deviations under the mode. An SQL expression of N, K, n, u.
def _hypergeometric(total: str, marked: str, drawn: str, uniform: str) -> str:
    mode = f"floor(({drawn} + 1d) * ({marked} + 1d) / ({total} + 2d))"
    share = f"(cast({marked} as double) / greatest({total}, 1))"
    spread = f"(8 * sqrt({drawn} * {share} * (1 - {share}) * ({total} - {drawn}) / greatest({total} - 1, 1)) + 8)"
    low = f"cast(greatest(0, {drawn} - ({total} - {marked}), {mode} - {spread}) as bigint)"
    high = f"cast(least({drawn}, {marked}, {mode} + {spread}) as bigint)"
    ratio = f"(({marked} - x) * cast({drawn} - x as double) / ((x + 1d) * ({total} - {marked} - {drawn} + x + 1)))"
    start = "named_struct('w', 1d, 'sum', 0d)"
    add = f"named_struct('w', s.w * {ratio}, 'sum', s.sum + s.w)"
    all_ = f"aggregate(sequence({low}, {high}), {start}, (s, x) -> {add}, s -> s.sum)"
    find = f"named_struct('w', s.w * {ratio}, 'left', s.left - s.w, 'at', if(s.left > 0, x, s.at))"
    begin = f"named_struct('w', 1d, 'left', {uniform} * {all_}, 'at', {low})"
    return f"aggregate(sequence({low}, {high}), {begin}, (s, x) -> {find}, s -> s.at)"


def split_tree(quotas: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """shard, keys, q (blocks of each source in keys) for the 2 ** levels leaves under one row with keys and q."""
    uniform = f"(shiftrightunsigned(xxhash64({seed}, level, shard, size(a.left)), 11) / 9007199254740992d)"
    draw = _hypergeometric("a.n_all", "k", "a.n_left", uniform)
    step = f"named_struct('n_all', a.n_all - k, 'n_left', a.n_left - d, 'left', concat(a.left, array(d)))"
    start = "named_struct('n_all', total, 'n_left', total div 2, 'left', cast(array() as array<bigint>))"
    # d is bound by a one-element transform, so that a draw is computed once
    left = f"aggregate(q, {start}, (a, k) -> element_at(transform(array({draw}), d -> {step}), 1), a -> a.left)"
    nodes = quotas.selectExpr("0L as shard", "keys", "q")
    for level in range(levels):
        if level == TOP_LEVELS:
            nodes = nodes.repartition("shard")
        nodes = nodes.selectExpr("shard", "keys", "q", f"{level} as level", "aggregate(q, 0L, (a, k) -> a + k) as total")
        nodes = nodes.selectExpr("shard", "keys", "q", f"{left} as l")
        nodes = nodes.selectExpr(
            "shard", "keys", "explode(array(named_struct('side', 0L, 'q', l), named_struct('side', 1L, 'q', zip_with(q, l, (a, b) -> a - b)))) as c"
        ).selectExpr("shard * 2 + c.side as shard", "keys", "c.q as q")
    return nodes


def levels_for(target_words: float) -> int:
    blocks = max(1.0, target_words / BLOCK_WORDS)
    n = 0
    while blocks / (1 << n) > SHARD_BLOCKS:
        n += 1
    return n


def mix(docs: DataFrame, seed: int = SEED, ratio: float = RATIO, cap: float = CAP, weights: tuple[float, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces). Rows: every row of docs with _row (its number), size, source_size, target. Pieces: _row, pass (0 or
    1), block, from_word, words, shard, _order (its place in the shard).

    Null texts and texts without words have size 0 and no pieces; null is a source of its own, the last; repeated rows
    are rows of their own, and no row gives more than cap times its words; no rows give none."""
    sized = written(docs.select("doc_id", F.xxhash64("text").alias("_text"), source_key(F.col("source")).alias("_key"), n_words(F.col("text")).alias("size")), "sizes")
    goals = written(targets(sized, ratio, cap, weights), "targets")
    # a source's documents in hashed order, cut into stretches of about LINE_DOCS, so that no task has a whole source
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "_text"), 11) / F.lit(float(1 << 53))
    lined = (
        sized.withColumn("_u", u)
        .join(F.broadcast(goals) if _few(goals) else goals, "_key")
        .withColumn("_stretch", F.floor(F.col("_u") * F.ceil(F.col("docs") / LINE_DOCS)))
    )
    part = Window.partitionBy("_key", "_stretch")
    order = part.orderBy("_u", "doc_id", "_text", "size")
    stretches = lined.groupBy("_key", "_stretch").agg(F.sum("size").alias("_words"))
    along = Window.partitionBy("_key").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select("_key", "_stretch", F.coalesce(F.sum("_words").over(along), F.lit(0)).alias("_before"))
    rows = (
        lined.withColumn("_nth", F.row_number().over(order))
        .withColumn("_at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(stretches, ["_key", "_stretch"])
        .withColumn("_at", F.col("_at") + F.col("_before"))
        .withColumn("_row", F.struct("_key", "_stretch", "_nth"))
        .select("_row", "doc_id", "_text", "_key", "size", "source_size", "target", "_at")
    )
    rows = written(rows, "lines")
    return rows, pieces(rows, goals, seed)


def _few(goals: DataFrame, most: int = 10_000) -> bool:
    """Whether there are few sources, so that their table may be broadcast."""
    return goals.select("_key").limit(most + 1).count() <= most


def quotas(goals: DataFrame) -> DataFrame:
    """_key, source_size, in_pass (blocks of one pass), blocks (the quota), spare (words that the last block drawn leaves
    out, so that the words taken are the target, rounded)."""
    words = F.round("target").cast("long")
    most, size = F.lit(BLOCK_WORDS), F.col("source_size")
    first = F.least(words, size)
    blocks = F.ceil(first / most) + F.ceil((words - first) / most)
    # all blocks of a pass are full but its last, which is drawn last
    drawn = F.least(F.ceil(first / most) * most, size) + F.least(F.ceil((words - first) / most) * most, size)
    return goals.select("_key", "source_size", F.ceil(size / most).alias("in_pass"), blocks.alias("blocks"), (drawn - words).alias("spare"))


def drawn_blocks(goals: DataFrame, seed: int = SEED) -> DataFrame:
    """shard, _key, pass, block, _words (as many as are taken from the block's beginning) of every block drawn."""
    table = quotas(goals)
    total = goals.agg(F.sum("target")).first()[0] or 0.0
    lists = table.agg(F.array_sort(F.collect_list(F.struct("_key", "blocks"))).alias("s")).selectExpr("transform(s, x -> x._key) as keys", "transform(s, x -> x.blocks) as q")
    leaves = split_tree(lists, levels_for(total), seed)
    shares = leaves.select("shard", F.explode(F.arrays_zip("keys", "q")).alias("x")).select("shard", F.col("x.keys").alias("_key"), F.col("x.q").alias("n"))
    first = F.coalesce(F.sum("n").over(Window.partitionBy("_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = shares.withColumn("first", first).where("n > 0").select("_key", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("_place"))
    places = places.join(F.broadcast(table) if _few(goals) else table, "_key")
    # each pass of a source has a permutation of its own, drawn from the seed, of all blocks but the last, which may be short and
    # has the last place: a prime above their number has no divisor with it, so its multiples meet every block once
    h = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), "_key", "pass")
    step = F.element_at(F.array(*[F.lit(x).cast("long") for x in PRIMES]), (F.pmod(h(0), F.lit(len(PRIMES))) + 1).cast("int"))
    others, place = F.col("in_pass") - 1, F.col("_place") % F.col("in_pass")
    moved = F.pmod(place * step + F.pmod(h(1), F.greatest(others, F.lit(1))), F.greatest(others, F.lit(1)))
    places = places.selectExpr("*", "_place div in_pass as pass").withColumn("block", F.when(place == others, others).otherwise(moved))
    full = F.least(F.lit(BLOCK_WORDS), F.col("source_size") - F.col("block") * BLOCK_WORDS)
    return places.select("shard", "_key", F.col("pass").cast("int").alias("pass"), "block", (full - F.when(F.col("_place") == F.col("blocks") - 1, F.col("spare")).otherwise(0)).alias("_words"))


def pieces(rows: DataFrame, goals: DataFrame, seed: int = SEED) -> DataFrame:
    blocks = drawn_blocks(goals, seed)
    cut = rows.where("size > 0").select("_row", "_key", "_at", "size", F.explode(F.array(F.lit(0), F.lit(1))).alias("pass"))
    cut = cut.withColumn("block", F.explode(F.sequence(F.expr(f"_at div {BLOCK_WORDS}"), F.expr(f"(_at + size - 1) div {BLOCK_WORDS}"))))
    start = F.col("block") * BLOCK_WORDS
    lo, hi = F.greatest("_at", start), F.least(F.col("_at") + F.col("size"), start + F.col("_words"))
    found = cut.join(blocks.hint("merge"), ["_key", "pass", "block"]).where(lo < hi)
    return found.select(
        "_row", "pass", "block", (lo - F.col("_at")).alias("from_word"), (hi - lo).alias("words"), "shard",
        F.struct(F.xxhash64(F.lit(seed + 1), "shard", "_key", "pass", "block").alias("h"), "_key", "pass", "block", lo.alias("at")).alias("_order"),
    )


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words that the mix takes) of every row, and the pieces taken: shard, pass,
    block, from_word and words."""
    rows, parts = mix(docs)
    piece = F.struct("shard", "pass", "block", "from_word", "words")
    got = parts.groupBy("_row").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list(piece)).alias("pieces"))
    out = rows.join(got, "_row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "pieces")


def mixed_pieces(docs: DataFrame) -> DataFrame:
    """The mix as rows of docs, all columns, one for each piece, with _run: its shard, _order in it, from_word, words and
    the size of its row. Text is that of the piece, with the white space before its words; pieces of all words of a text
    are the text."""
    rows, parts = mix(docs)
    run = F.struct("shard", "_order", "from_word", "words", "size")
    runs = rows.select("_row", "doc_id", "_text", "size").join(parts, "_row").groupBy("doc_id", "_text").agg(F.collect_list(run).alias("_runs"))
    # repeated rows are one row with the runs of all
    keyed = docs.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).alias("d")
    out = keyed.join(runs.alias("r"), F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d._text") == F.col("r._text")))
    tokens = F.regexp_extract_all("text", F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0))

    def cut(t: Column, r: Column) -> Column:
        whole = (r["from_word"] == 0) & (r["words"] == r["size"])
        part = F.array_join(F.slice(t, (r["from_word"] + 1).cast("int"), r["words"].cast("int")), "")
        return F.struct(r.alias("run"), F.when(whole, F.col("d.text")).otherwise(part).alias("text"))

    # the text is cut into words once, whatever the number of its pieces
    cuts = F.flatten(F.transform(F.array(tokens), lambda t: F.transform(F.col("r._runs"), lambda r: cut(t, r))))
    out = out.select("d.*", F.explode(cuts).alias("_cut"))
    out = out.select(*[F.col("_cut.text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], F.col("_cut.run").alias("_run"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixed(docs: DataFrame) -> DataFrame:
    """The mix as rows of docs, all columns: a row for each piece of a text that a block takes, each shard's rows together,
    shuffled by blocks."""
    return mixed_pieces(docs).repartition("_run.shard").sortWithinPartitions("_run.shard", "_run._order").select(*docs.columns)
