"""Operator 13: alignment of two tokenisers' tokens by the bytes that they cover.

Python only tokenises: each text gets, for both tokenisers, its ids and the byte offsets where its tokens end. All else
is Spark's functions over arrays: array_intersect of the ends gives the cuts, a sort of cuts and ends together gives each
cut's position among the tokens (so nothing is searched), transform and sequence take groups out of the ids (one step for the many groups of one token
on either side), aggregate adds up links.

A text's links are kept as its distinct id pairs and how often each occurs; within a group only distinct ids are paired, so
a long stretch without a common end stays small.

Neither tokeniser has a token across a single space between two other characters, and both begin anew there. So the groups
of a document are those of its stretches between such spaces, one after the other, and digests() aligns each distinct stretch
of some megabytes of documents once: these make one row, of the stretches' tokens and of each document's stretches by number.
How many documents hold a pair is counted after partial aggregation in each task; the counts come back to the documents by a
join on the pair, broadcast only if their number is below BROADCAST_PAIRS, else by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import bpe
from ._common import chunks, written_at

#: Pairs with counts up to which they are broadcast: about 100 MB as a hash table.
BROADCAST_PAIRS = 1 << 21
#: Ids, where each token ends, and both packed: the end in the high half, the token's place (from 1) in the low one.
TOKENS = "a_ids array<int>, a_ends array<int>, a_at array<bigint>, b_ids array<int>, b_ends array<int>, b_at array<bigint>"
_LOW = 0xFFFFFFFF
#: Characters of the texts whose stretches are aligned together (a longer text is alone), and of distinct stretches whose tokens a task keeps.
TOGETHER, KEPT_CHARS = 2_000_000, 3_000_000
#: Cuts of a text up to which each is looked up among the tokens' ends.
FEW_CUTS = 16
#: A stretch: it begins with a space and ends before the next single space between two characters that are none.
_STRETCH = re.compile(r"\s+\S*(?:(?! \S)\s+\S*)*")


class Pieces:
    """A sentencepiece model and the bytes of its pieces."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.vocab_size()
        data = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.sizes = np.fromiter(map(len, data), dtype=np.int64, count=n)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(data), dtype=np.uint8)
        #: No piece lies across the beginning of a space.
        self.by_stretch = not any(re.search("[^▁]▁", self.model.id_to_piece(i)) for i in range(n))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.model.encode(texts, num_threads=1)
        n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter((i for row in ids for i in row), dtype=np.int64, count=int(n.sum())), n


def _ends(table, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Where each token ends in its own text, and the joined bytes of each text."""
    flat, sizes = bpe.take(table.bytes, table.starts[ids], table.sizes[ids])
    upto = np.append(0, np.cumsum(sizes))
    of_text = upto[np.append(0, np.cumsum(n))]
    data = flat.tobytes()
    return upto[1:] - np.repeat(of_text[:-1], n), [data[a:b] for a, b in zip(of_text[:-1].tolist(), of_text[1:].tolist())]


_NAMES = [f.split()[0] for f in TOKENS.split(", ")]


class Both:
    """Both tokenisers on texts that begin with a space (or are empty)."""

    def __init__(self, bpe_path: str, piece_path: str) -> None:
        self.encoder, self.pieces = bpe.Encoder(bpe_path, special=False), Pieces(piece_path)

    def __call__(self, spaced: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[pa.Array]]:
        """Whether both sides' bytes are the text, the number of tokens on each side, and TOKENS; where not, none."""
        sides = [self.encoder(spaced), self.pieces([t[1:] for t in spaced])]
        ends = [_ends(table, *side) for table, side in zip((self.encoder.v, self.pieces), sides)]
        good = np.fromiter((a == b == s.encode() for a, b, s in zip(ends[0][1], ends[1][1], spaced)), dtype=bool, count=len(spaced))
        columns, counts = [], []
        for (ids, n), (end, _) in zip(sides, ends):
            counts.append(np.where(good, n, 0))
            keep, offsets = np.repeat(good, n), pa.array(np.append(0, np.cumsum(counts[-1])), pa.int32())
            place = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n) + 1
            columns += [pa.ListArray.from_arrays(offsets, pa.array(x[keep], t)) for x, t in ((ids, pa.int32()), (end, pa.int32()), (end << 32 | place, pa.int64()))]
        return good, counts, columns


def tokens(docs: DataFrame, bpe_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """doc_id and TOKENS for every row: space and text by the byte-level BPE (a), text by the pieces (b), special strings as
    plain text. Null and empty texts, and those whose tokens' bytes are not a space and the text, have empty arrays. Other
    columns are not read."""
    import public_tokenizers

    bpe_path = bpe_path or bpe.default_path()
    piece_path = piece_path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Both(bpe_path, piece_path)
        for batch in batches:
            for start, texts in chunks(batch.column("text").to_pylist()):
                *_, columns = both([" " + t if t else "" for t in texts])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(texts)), *columns], ["doc_id", *_NAMES])

    kind = docs.schema["doc_id"].dataType
    assert to_arrow_type(kind) is not None
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, {TOKENS}")


def stretches(docs: DataFrame, bpe_path: str | None = None, piece_path: str | None = None, together: int = TOGETHER) -> DataFrame:
    """Rows of some documents each: `words`, the tokens of their distinct stretches (ids and ends as in TOKENS), and `texts`, the
    documents, with their stretches in order (`own`, from 0) and how many tokens these have (n_a, n_b). Documents without
    tokens, as in tokens(), have no stretches."""
    import public_tokenizers

    bpe_path = bpe_path or bpe.default_path()
    piece_path = piece_path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Both(bpe_path, piece_path)
        if not both.pieces.by_stretch:
            raise ValueError("pieces across the beginning of a space")
        kept = Kept(both)
        for batch in batches:
            for start, texts in chunks(batch.column("text").to_pylist(), together):
                found = [_STRETCH.findall(" " + t) if t else [] for t in texts]
                n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
                numbers, own = np.unique(kept(found, int(n.sum())), return_inverse=True)
                del found
                good, sizes, words = kept.take(numbers)
                bad = np.diff(np.append(0, np.cumsum(~good[own]))[np.append(0, np.cumsum(n))]) > 0
                own, n = own[np.repeat(~bad, n)], np.where(bad, 0, n)
                ends = np.append(0, np.cumsum(n))
                n_a, n_b = (np.diff(np.append(0, np.cumsum(x[own]))[ends]) for x in sizes)
                own = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(own, pa.int32()))
                rows = pa.StructArray.from_arrays([batch.column("doc_id").slice(start, len(texts)), pa.array(n_a), pa.array(n_b), own], ["doc_id", "n_a", "n_b", "own"])
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (words, rows)], ["words", "texts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    word = "struct<a_ids: array<int>, a_ends: array<int>, b_ids: array<int>, b_ends: array<int>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"words array<{word}>, texts array<struct<doc_id: {kind}, n_a: bigint, n_b: bigint, own: array<int>>>")


class Kept:
    """Distinct stretches that a task has met, by number, with their tokens."""

    def __init__(self, both: Both) -> None:
        self.both, self.chars, self.numbers = both, 0, {}
        self.good, self.sizes = np.zeros(0, dtype=bool), np.zeros((2, 0), dtype=np.int64)
        self.flat = [np.zeros(0, dtype=np.int32)] * 4

    def __call__(self, found: list[list[str]], n: int) -> np.ndarray:
        """The numbers of all stretches found, n in all."""
        if self.chars > KEPT_CHARS:
            self.both.encoder._begin()
            self.__init__(self.both)
        numbers, before = self.numbers, len(self.numbers)
        of = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in found for w in ws), dtype=np.int64, count=n)
        new = list(islice(numbers, before, None))
        self.chars += sum(map(len, new))
        parts = [self.both(some) for _, some in chunks(new)]
        if parts:
            self.good = np.concatenate([self.good, *(good for good, _, _ in parts)])
            self.sizes = np.hstack([self.sizes, *(counts for _, counts, _ in parts)])
            self.flat = [np.concatenate([x, *(columns[k].values.to_numpy() for *_, columns in parts)]) for x, k in zip(self.flat, (0, 1, 3, 4))]
        return of

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
        """Whether these have tokens, how many on each side, and the ids and ends."""
        columns = []
        for k, size in enumerate(self.sizes):
            starts = (np.cumsum(size) - size)[numbers]
            offsets = pa.array(np.append(0, np.cumsum(size[numbers])), pa.int32())
            columns += [pa.ListArray.from_arrays(offsets, pa.array(bpe.take(x, starts, size[numbers])[0], pa.int32())) for x in self.flat[2 * k : 2 * k + 2]]
        return self.good[numbers], self.sizes[:, numbers], pa.StructArray.from_arrays(columns, [c for c in _NAMES if not c.endswith("_at")])


def _high(x: Column) -> Column:
    return F.shiftleft(x.cast("long"), 32)


def _let(value: Column, body) -> Column:
    """body(value) with the value worked out once, wherever the body names it."""
    return F.transform(F.array(value), body)[0]


def _at(a_ends: Column, b_ends: Column, a_at: Column, b_at: Column) -> Column:
    """For each group, the places of its last tokens, a's in the high half and b's in the low one, after a zero.

    Few cuts are looked up one by one. Many are sorted together with the tokens by the byte where they end; a cut stands just
    before the token that ends there."""
    low = lambda x: x.bitwiseAND(F.lit(_LOW))
    last = lambda cuts, at: _let(F.sort_array(F.concat(F.transform(cuts, _high), at)), lambda q: F.filter(q, lambda x, i: low(F.get(q, i - 1)) == 0))
    many = lambda cuts: F.zip_with(last(cuts, a_at), last(cuts, b_at), lambda x, y: F.shiftleft(low(x), 32) + low(y))
    few = lambda cuts: F.transform(cuts, lambda e: F.shiftleft(F.array_position(a_ends, e), 32) + F.array_position(b_ends, e))
    at = _let(F.array_intersect(a_ends, b_ends), lambda cuts: F.when(F.size(cuts) <= FEW_CUTS, few(cuts)).otherwise(many(cuts)))
    # one by one, if both sides' tokens end at the same places
    step = F.lit((1 << 32) + 1)
    return F.when(a_ends == b_ends, F.sequence(F.lit(0).cast("long"), F.size(a_ends) * step, step)).otherwise(F.concat(F.array(F.lit(0).cast("long")), at))


def cut(tokens: DataFrame) -> DataFrame:
    """tokens with `at`: for each group, the places of its last tokens, a's in the high half and b's in the low one, after a zero."""
    return tokens.withColumn("at", _at(*map(F.col, ("a_ends", "b_ends", "a_at", "b_at")))).drop("a_ends", "b_ends", "a_at", "b_at")


def _ids(at: Column, ids: Column, side: str, i: Column) -> Column:
    """The ids of a side's tokens in group i."""
    place = (lambda x: F.shiftright(x, 32).cast("int")) if side == "a" else lambda x: x.bitwiseAND(F.lit(_LOW)).cast("int")
    # not slice(), which walks over all that lies before its start
    return F.transform(F.sequence(place(F.get(at, i)), place(F.get(at, i + 1)) - 1), lambda j: F.get(ids, j))


def _group(at: Column, a_ids: Column, b_ids: Column, i: Column) -> Column:
    return F.struct(_ids(at, a_ids, "a", i).alias("a"), _ids(at, b_ids, "b", i).alias("b"))


def _numbers(at: Column) -> Column:
    """0, 1, ... for the groups."""
    return F.when(F.size(at) > 1, F.sequence(F.lit(0), F.size(at) - 2)).otherwise(F.array().cast("array<int>"))


def groups(cuts: DataFrame) -> DataFrame:
    """cut() with `groups`, array<struct<a: array<int>, b: array<int>>>: the ids between cuts, in order."""
    return cuts.withColumn("groups", F.transform(_numbers(F.col("at")), lambda i: _group(F.col("at"), F.col("a_ids"), F.col("b_ids"), i)))


def _single(at: Column, a_ids: Column, b_ids: Column) -> Column:
    """Of each group of one token on either side, its pair (a's id in the high half), of others -1."""
    place = lambda x: (F.shiftright(x, 32).cast("int") - 1, x.bitwiseAND(F.lit(_LOW)).cast("int") - 1)

    def pair(i: Column) -> Column:
        a, b = place(F.get(at, i + 1))
        one = F.get(at, i + 1) - F.get(at, i) == (1 << 32) + 1
        return F.when(one, _high(F.get(a_ids, a)) + F.get(b_ids, b)).otherwise(F.lit(-1).cast("long"))

    alone = (F.size(a_ids) == F.size(at) - 1) & (F.size(b_ids) == F.size(at) - 1)
    return F.when(alone, F.zip_with(a_ids, b_ids, lambda x, y: _high(x) + y)).otherwise(F.transform(_numbers(at), pair))


def single(cuts: DataFrame) -> DataFrame:
    """cut() with `single`: of each group of one token on either side, its pair (a's id in the high half), of others -1."""
    return cuts.withColumn("single", _single(*map(F.col, ("at", "a_ids", "b_ids"))))


def _large(at: Column, single: Column, a_ids: Column, b_ids: Column) -> Column:
    """The groups of more than one token on a side."""
    several = lambda: F.filter(_numbers(at), lambda i: F.get(single, i) < 0)
    found = F.transform(several(), lambda i: _group(at, a_ids, b_ids, i))
    return F.when(F.array_contains(single, F.lit(-1).cast("long")), found).otherwise(F.array().cast("array<struct<a:array<int>,b:array<int>>>"))


def _entries(single: Column, large: Column) -> Column:
    """The distinct pairs of each group, one group after the other."""
    pairs = lambda g: _let(F.array_distinct(g["b"]), lambda b: F.flatten(F.transform(F.array_distinct(g["a"]), lambda x: F.transform(b, lambda y: _high(x) + y))))
    return F.concat(F.array_remove(single, F.lit(-1).cast("long")), F.flatten(F.transform(large, pairs)))


def _more(large: Column) -> Column:
    """pair and times beyond _entries(), of groups that repeat ids."""
    repeats = F.filter(large, lambda g: (F.size(F.array_distinct(g["a"])) < F.size(g["a"])) | (F.size(F.array_distinct(g["b"])) < F.size(g["b"])))
    beyond = lambda g: F.flatten(F.transform(F.array_distinct(g["a"]), lambda x: F.transform(F.array_distinct(g["b"]), lambda y: F.struct((_high(x) + y).alias("pair"), (_times(g["a"], x) * _times(g["b"], y) - 1).alias("times")))))
    return F.filter(F.flatten(F.transform(repeats, beyond)), lambda x: x["times"] > 0)


def _times(ids: Column, x: Column) -> Column:
    return (F.size(ids) - F.size(F.array_remove(ids, x))).cast("long")


def _distinct(entries: Column) -> Column:
    """Distinct pairs, ascending, and how often each occurs: the lengths of runs of the sorted pairs."""

    def runs(s: Column) -> Column:
        stops = F.filter(F.transform(s, lambda x, i: F.when(F.get(s, i + 1) == x, 0).otherwise(i + 1)), lambda p: p > 0)
        since = lambda e, i: F.when(i == 0, 0).otherwise(F.get(e, i - 1))
        return _let(stops, lambda e: F.struct(F.transform(e, lambda p: F.get(s, p - 1)).alias("pairs"), F.transform(e, lambda p, i: (p - since(e, i)).cast("long")).alias("times")))

    once = lambda s: F.struct(s.alias("pairs"), F.array_repeat(F.lit(1).cast("long"), F.size(s)).alias("times"))
    return _let(F.sort_array(entries), lambda s: F.when(F.size(F.array_distinct(s)) == F.size(s), once(s)).otherwise(runs(s)))


def links(cuts: DataFrame) -> DataFrame:
    """cut() with n_links, `pairs` (distinct linked pairs, a's id in the high half), `times` (how many groups hold each), `more`
    (pair and times beyond that, where a group itself repeats ids) and `single`.

    Within a group only distinct ids are paired."""
    with_single = single(cuts)
    d = with_single.withColumn("_large", _large(*map(F.col, ("at", "single", "a_ids", "b_ids")))).withColumn("_d", _distinct(_entries(F.col("single"), F.col("_large"))))
    large = F.aggregate("_large", F.lit(0).cast("long"), lambda acc, g: acc + F.size(g["a"]).cast("long") * F.size(g["b"]))
    n = large + F.size("single") - F.size("_large")
    return d.select(*with_single.columns, n.alias("n_links"), F.col("_d.pairs").alias("pairs"), F.col("_d.times").alias("times"), _more(F.col("_large")).alias("more"))


def pair_counts(linked: DataFrame) -> DataFrame:
    """pair, count (rows that hold it), best (no pair of the same a has more)."""
    counted = linked.select(F.explode(F.array_distinct("pairs")).alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    a = F.shiftright("pair", 32)
    most = counted.groupBy(a.alias("a")).agg(F.max("count").alias("most"))
    return counted.withColumn("a", a).join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, bpe_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """doc_id, a_ids, b_ids, groups, n_links, pairs, times, more for every row of docs; repeated rows are aligned each."""
    return groups(links(cut(tokens(docs, bpe_path, piece_path)))).drop("at", "single")


def text_of(at: Column, pairs: Column, a_ids: Column, b_ids: Column) -> Column:
    """Groups as text: ids by commas, sides by a bar, groups by semicolons."""
    words = lambda side, ids, i: F.array_join(_ids(at, ids, side, i).cast("array<string>"), ",")
    one = lambda x: F.concat(F.shiftright(x, 32).cast("string"), F.lit("|"), x.bitwiseAND(F.lit(_LOW)).cast("string"))
    return F.array_join(F.transform(pairs, lambda x, i: F.when(x >= 0, one(x)).otherwise(F.concat(words("a", a_ids, i), F.lit("|"), words("b", b_ids, i)))), ";")


def _aligned_word(w: Column) -> Column:
    """Of a stretch: its groups as text, their number, the distinct pairs of each group, and the times beyond."""
    a_ids, b_ids = w["a_ids"], w["b_ids"]
    packed = lambda ends: F.transform(ends, lambda e, i: _high(e) + i + 1)

    def made(at: Column, single: Column, large: Column) -> Column:
        return F.struct(text_of(at, single, a_ids, b_ids).alias("text"), F.size(single).cast("long").alias("n_groups"), _entries(single, large).alias("pairs"), _more(large).alias("more"))

    at = _at(w["a_ends"], w["b_ends"], packed(w["a_ends"]), packed(w["b_ends"]))
    return _let(at, lambda at: _let(_single(at, a_ids, b_ids), lambda s: _let(_large(at, s, a_ids, b_ids), lambda g: made(at, s, g))))


def _joined(found: DataFrame) -> DataFrame:
    """stretches() as rows of documents: doc_id, n_a, n_b, n_groups, groups_sha256, `pairs` (the distinct pairs of each group), `more`."""
    names = ("text", "n_groups", "pairs", "more")

    def row(t: Column, of: dict[str, Column]) -> Column:
        own = t["own"]
        each = lambda c: F.transform(own, lambda i: F.get(of[c], i))
        sha = F.when(F.size(own) > 0, F.sha2(F.array_join(each("text"), ";"), 256)).otherwise("")
        n_groups = F.aggregate(own, F.lit(0).cast("long"), lambda acc, i: acc + F.get(of["n_groups"], i))
        more = F.when(of["any"], F.flatten(each("more"))).otherwise(F.array().cast("array<struct<pair:bigint,times:bigint>>"))
        return F.struct(t["doc_id"].alias("doc_id"), t["n_a"].alias("n_a"), t["n_b"].alias("n_b"), n_groups.alias("n_groups"), sha.alias("groups_sha256"), F.flatten(each("pairs")).alias("pairs"), more.alias("more"))

    def rows(left: tuple[str, ...], words: Column, of: dict[str, Column]) -> Column:
        """The texts' rows, with each field of the words taken out once."""
        if left:
            return _let(words[left[0]], lambda x: rows(left[1:], words, {**of, left[0]: x}))
        return _let(F.exists(of["more"], lambda x: F.size(x) > 0), lambda x: F.transform("texts", lambda t: row(t, {**of, "any": x})))

    return found.select(F.inline(_let(F.transform("words", _aligned_word), lambda words: rows(names, words, {}))))


def digests(docs: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS, together: int = TOGETHER) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows, _ = written_at(_joined(stretches(docs, together=together)).withColumn("_row", F.monotonically_increasing_id()), "alignment")
    counts, _ = written_at(pair_counts(rows), "alignment-counts")
    each = rows.select("_row", F.explode("pairs").alias("pair")).withColumn("times", F.lit(1).cast("long"))
    each = each.unionAll(rows.select("_row", F.inline("more")))
    few = counts.limit(broadcast_pairs + 1).count() <= broadcast_pairs
    if not few:
        each = each.groupBy("_row", "pair").agg(F.sum("times").alias("times"))
    sums = each.join(F.broadcast(counts) if few else counts, "pair").groupBy("_row").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    found, zero = rows.drop("pairs", "more").join(sums, "_row", "left"), F.lit(0).cast("long")
    return found.select("doc_id", "n_a", "n_b", "n_groups", *(F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")), "groups_sha256")
