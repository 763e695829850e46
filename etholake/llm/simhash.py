"""Operator 6: SimHash near-duplicates with vantage-point trees.

A document's fingerprint is the bitwise majority of its shingles' hashes. Copies share a fingerprint, so the search
runs over distinct fingerprints. A vantage-point tree partitions them by their Hamming distance to vantage points, down
to shards; a fingerprint lives in one shard, and as a guest it also goes to those shards beyond a boundary that the
triangle bound cannot exclude. A shard grows its own tree in the same way and compares whole fingerprints, exactly, where
the bound ends; it sends on only a spanning forest of the links that it finds, never all pairs. Groups meet in a
connected-components job.

The trees over shards are grown on a bounded sample, but every fingerprint is routed by them. A shard that no vantage
point divides (a dense cluster) is split into pieces, and each two pieces meet in a block of their own.

The bound excludes the less, the wider the links are for the spread of distances: a tree over whole fingerprints of 64
bits, with links of 4 bits, sends so many guests that five times the documents made 14 times the rows. So each of several
short parts of the fingerprint has a tree: two that differ in at most 4 bits differ in at most one bit of one of four
parts (pigeonhole). What is near in a part is compared as a whole; near-duplicates, whose links are too wide for that,
have more parts in a longer fingerprint, and are confirmed by their shingles.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import WORD, chunks, mix64, remove, scratch, temporary, written, written_at

_WORDS = re.compile(WORD.encode())
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SEED = 42
#: Distinct fingerprints that a shard should hold, and that a leaf of a shard's own tree compares directly.
SHARD_ROWS, LEAF_ROWS = 8_192, 128
#: Fingerprints that the trees over shards are grown on, about; and at least so many of them in a shard.
SAMPLE, LEAST_SAMPLE = 32_768, 16
#: Pairs that a shard looks at in one step, and links that it holds before it thins them out to a spanning forest.
STEP_PAIRS, MOST_LINKS = 1 << 21, 1 << 20
#: Parts of a 64-bit fingerprint with a tree each.
PARTS = 4
#: Near-duplicates: words of a shingle, similarity of the sets of shingles, 64-bit words of the longer fingerprint, bits
#: of a part, bits in which parts may differ, and bits in which whole fingerprints may (at a similarity of 0.8, 29 on
#: average with a standard deviation of 5; of unrelated texts, 96 with one of 7).
SHINGLE, SIMILARITY, SKETCH_WORDS, PART_BITS, PART_SLACK, SKETCH_RADIUS = 5, 0.8, 3, 16, 1, 48
_TURNS = [np.uint64(x) for x in (0, 0x5851F42D4C957F2D, 0x14057B7EF767814F)]


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of k words, A-Z lower-cased, joined by single spaces; of all words if they are fewer."""
    words = _WORDS.findall((text or "").encode("utf-8", "replace").translate(_LOWER))
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n <= k:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: n - k + 1].tolist(), ends[k - 1 :].tolist())], dtype=np.uint64)


def _majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each slice of hashes, the bits that are set in over half of it; none for an empty slice."""
    out = np.zeros(len(bounds) - 1, dtype=np.uint64)
    count = np.diff(bounds)
    some = np.flatnonzero(count)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, bounds[:-1][some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * sums > count[some][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(texts: list[str | None], k: int = 4) -> np.ndarray:
    """64-bit fingerprints: of all shingles, repeats included."""
    out = np.zeros(len(texts), dtype=np.uint64)
    for at, part in chunks(texts, 1_000_000):
        hashes = [shingle_hashes(t, k) for t in part]
        bounds = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
        out[at : at + len(part)] = _majority(np.concatenate(hashes), bounds)
    return out


def with_fingerprints(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = fingerprints(b.column("text").to_pylist(), k)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def with_sketches(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, _text (hash of the text), node (a digest of its set of shingles: equal sets, equal nodes), w0, w1, ... (the
    words of a longer fingerprint of that set) and shingles (the set, as 32-bit hashes), of every row's whole text."""
    names = [f"w{i}" for i in range(SKETCH_WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, part in chunks(b.column("text").to_pylist(), 1_000_000):
                sets = [np.unique(shingle_hashes(t, k)) for t in part]
                bounds = np.concatenate([[0], np.cumsum([len(h) for h in sets])])
                joined = np.concatenate(sets)
                nodes = pa.array([hashlib.blake2b(h.tobytes(), digest_size=16).hexdigest() for h in sets])
                words = [pa.array(_majority(mix64(joined ^ t) if i else joined, bounds).view(np.int64)) for i, t in enumerate(_TURNS[:SKETCH_WORDS])]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((joined >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                here = slice(at, at + len(part))
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[here], b.column("_text")[here], nodes, *words, lists], ["doc_id", "_text", "node", *names, "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, _text long, node string, {', '.join(f'{w} long' for w in names)}, shingles array<int>"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("_text")).mapInArrow(run, fields)


# ---- vantage-point trees


class Part(NamedTuple):
    """A run of bits of a fingerprint that a tree is grown over, and in how many of them linked fingerprints may differ."""

    word: int
    shift: int
    bits: int
    slack: int

    def of(self, words: np.ndarray) -> np.ndarray:
        kind = np.uint16 if self.bits <= 16 else np.uint32 if self.bits <= 32 else np.uint64
        return (words[:, self.word] >> np.uint64(self.shift) & np.uint64((1 << self.bits) - 1)).astype(kind)


def short_parts(words: int = SKETCH_WORDS, bits: int = PART_BITS, slack: int = PART_SLACK) -> list[Part]:
    return [Part(w, s, bits, slack) for w in range(words) for s in range(0, 64, bits)]


def divide(values: np.ndarray, slack: int, guests: int, rng: np.random.Generator):
    """(vantage point, bound) that leave the fewest comparisons between the two sides' residents and their guests, of a
    few vantage points tried; nothing if none saves much."""
    some = values if len(values) <= 4096 else rng.choice(values, 4096, replace=False)
    n, g = len(some), guests * len(some) / len(values)
    best, least = None, 0.95 * n * (n + g)
    for v in rng.choice(some, min(6, n), replace=False):
        under = np.cumsum(np.bincount(np.bitwise_count(some ^ v), minlength=64 + 2 * slack + 2)) / n
        bound = np.arange(64)
        inner, outer = under[bound], 1 - under[bound]
        near = under[bound + slack]
        # under[bound - slack], 0 below the least distance
        far = np.concatenate([np.zeros(slack), under[: 64 - slack]])
        cost = n * inner * (n * inner + g * near) + n * outer * (n * (1 - far) + g * (1 - far))
        cost[(inner == 0) | (outer == 0)] = np.inf
        at = int(cost.argmin())
        if cost[at] < least:
            best, least = (v, at), cost[at]
    return best


def sides(values: np.ndarray, residents: np.ndarray, guests: np.ndarray, vantage, bound: int, slack: int, meet: bool = True):
    """Residents and guests inside the bound, and outside it.

    A value at distance d from the vantage point has no neighbour inside unless d - slack <= bound, and none outside
    unless d + slack > bound: the triangle inequality. Residents inside that may have neighbours outside are guests
    there, so that every pair of neighbours meets once."""
    d = np.bitwise_count(values[residents] ^ vantage).astype(np.int64)
    e = np.bitwise_count(values[guests] ^ vantage).astype(np.int64)
    inside = d <= bound
    cross = residents[inside & (d + slack > bound)] if meet else residents[:0]
    return (residents[inside], guests[e - slack <= bound]), (residents[~inside], np.concatenate([guests[e + slack > bound], cross]))


class Leaf(NamedTuple):
    """A shard, or the pieces of one: blocks of two pieces each, numbered from first."""

    first: int
    pieces: int

    def block(self, i: int, j: int) -> int:
        return self.first + j * (j + 1) // 2 + i


def grow(sample: np.ndarray, slack: int, scale: float, first: int, rng: np.random.Generator):
    """(tree, next free block): the tree is a Leaf, or (vantage, bound, tree inside, tree outside). A sampled fingerprint
    stands for scale of them."""
    if len(sample) * scale > SHARD_ROWS and len(sample) >= 2 * LEAST_SAMPLE and (cut := divide(sample, slack, 0, rng)):
        inside = np.bitwise_count(sample ^ cut[0]) <= cut[1]
        inner, first = grow(sample[inside], slack, scale, first, rng)
        outer, first = grow(sample[~inside], slack, scale, first, rng)
        return (*cut, inner, outer), first
    pieces = max(1, round(len(sample) * scale / (2 * SHARD_ROWS)))
    return Leaf(first, pieces), first + pieces * (pieces + 1) // 2


def depth(tree) -> int:
    return 0 if isinstance(tree, Leaf) else 1 + max(depth(tree[2]), depth(tree[3]))


#: What a row is to its block: a guest; a resident; a resident that is compared with guests only.
GUEST, RESIDENT, HOST = 0, 1, 2


def route(tree, values: np.ndarray, slack: int, pick: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(block, role, indices of values) for all values; pick deals the residents of a leaf to its pieces."""
    stack = [(tree, np.arange(len(values)), np.zeros(0, dtype=np.int64))]
    while stack:
        node, residents, guests = stack.pop()
        if not isinstance(node, Leaf):
            inside, outside = sides(values, residents, guests, node[0], node[1], slack)
            stack += [(node[2], *inside), (node[3], *outside)]
            continue
        piece = pick[residents] % np.uint64(node.pieces)
        for i in range(node.pieces):
            own = residents[piece == i]
            yield node.block(i, i), GUEST, guests
            for j in range(node.pieces):
                yield (node.block(i, j), GUEST if i < j else RESIDENT, own) if i <= j else (node.block(j, i), HOST, own)


# ---- exact search within a block


def spanning(n: int, a: np.ndarray, b: np.ndarray, dist: np.ndarray) -> np.ndarray:
    """Indices of links (a, b) that make a spanning forest of all links over n nodes, nearer links first."""
    of, kept = np.arange(n), []

    def roots(i: np.ndarray) -> np.ndarray:
        r = of[i]
        while ((up := of[r]) != r).any():
            r = up
        return r

    for d in np.unique(dist):
        i = np.flatnonzero(dist == d)
        while len(i):
            x, y = roots(a[i]), roots(b[i])
            i, x, y = (c[x != y] for c in (i, x, y))
            high, first = np.unique(np.maximum(x, y), return_index=True)
            # each root but the least of those that meet gets one smaller root
            of[high] = np.minimum(x, y)[first]
            kept.append(i[first])
            of = of[of]
    return np.concatenate(kept) if kept else np.zeros(0, dtype=np.int64)


class Links:
    """Links found so far, thinned out to a spanning forest when they are many."""

    def __init__(self, n: int) -> None:
        self.n, self.found, self.size = n, [], 0

    def add(self, a: np.ndarray, b: np.ndarray, dist: np.ndarray) -> None:
        if len(a):
            self.found.append((a, b, dist))
            self.size += len(a)
        if self.size > MOST_LINKS + self.n:
            self.forest()

    def forest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = np.zeros(0, dtype=np.int64)
        a, b, dist = (np.concatenate(c) for c in zip(*self.found)) if self.found else (none, none, none)
        i = spanning(self.n, a, b, dist)
        self.found, self.size = [(a[i], b[i], dist[i])], len(i)
        return self.found[0]


class Alike(Links):
    """Links that are confirmed as they are found: pairs of different classes whose sets of shingles have the similarity. A link
    makes its two classes one, so what is kept is a spanning forest of the classes that are alike.

    sets are the nodes' shingles, one after the other, and bounds where each begins and ends."""

    def __init__(self, classes: np.ndarray, sets: np.ndarray, bounds: np.ndarray, similarity: float) -> None:
        super().__init__(len(classes))
        self.classes, self.bounds, self.similarity = classes.copy(), bounds, similarity
        self.ids = np.unique(sets, return_inverse=True)[1]
        self.marked = np.zeros(self.ids.max(initial=-1) + 1, dtype=bool)
        self.sizes = np.diff(bounds)

    def add(self, a: np.ndarray, b: np.ndarray, dist: np.ndarray) -> None:
        order = np.argsort(a, kind="stable")
        a, b, dist = a[order], b[order], dist[order]
        starts = np.flatnonzero(np.diff(a, prepend=-1))
        for start, stop in zip(starts.tolist(), np.append(starts[1:], len(a)).tolist()):
            self._of_one(int(a[start]), b[start:stop], dist[start:stop])

    def _of_one(self, node: int, others: np.ndarray, dist: np.ndarray) -> None:
        size = self.sizes[node]
        # sets of too different sizes cannot be alike
        near = (self.classes[others] != self.classes[node]) & (np.minimum(self.sizes[others], size) >= self.similarity * np.maximum(self.sizes[others], size))
        others, dist = others[near], dist[near]
        if not len(others):
            return
        own = self.ids[self.bounds[node] : self.bounds[node + 1]]
        self.marked[own] = True
        sizes = self.sizes[others]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.bounds[others] - (ends - sizes), sizes)
        upto = np.append(0, np.cumsum(self.marked[self.ids[at]]))
        self.marked[own] = False
        shared = upto[ends] - upto[ends - sizes]
        for i in np.flatnonzero(shared >= self.similarity * (sizes + size - shared)).tolist():
            old, new = self.classes[others[i]], self.classes[node]
            if old != new:
                self.classes[self.classes == old] = new
                self.found.append((np.array([node]), others[i : i + 1], dist[i : i + 1]))


def block_links(words: np.ndarray, role: np.ndarray, part: Part, radius: int, found: Links | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What `found` keeps, a spanning forest by default, as (index, index, distance), of the links between a block's residents
    and between these and its guests: pairs that differ in at most part.slack bits of the part and in at most radius bits in all."""
    values, found, rng = part.of(words), found or Links(len(words)), np.random.default_rng(SEED)
    meet = not (role == HOST).any()

    def compare(residents: np.ndarray, others: np.ndarray, same: bool) -> None:
        step = max(1, STEP_PAIRS // max(1, len(residents)))
        for start in range(0, len(others), step):
            q = others[start : start + step]
            r = residents[start:] if same else residents
            i, j = np.nonzero(np.bitwise_count(values[q][:, None] ^ values[r][None, :]) <= part.slack)
            if same:
                i, j = i[j > i], j[j > i]
            a, b = q[i], r[j]
            dist = np.bitwise_count(words[a] ^ words[b]).sum(axis=1, dtype=np.int64)
            near = dist <= radius
            found.add(a[near], b[near], dist[near])

    stack = [(np.flatnonzero(role != GUEST), np.flatnonzero(role == GUEST))]
    while stack:
        residents, guests = stack.pop()
        if not len(residents) or not (len(guests) or meet and len(residents) > 1):
            continue
        cut = divide(values[residents], part.slack, len(guests), rng) if len(residents) > LEAF_ROWS else None
        if cut:
            stack += sides(values, residents, guests, *cut, part.slack, meet)
            continue
        compare(residents, guests, False)
        if meet:
            compare(residents, residents, True)
    return found.forest()


def links(nodes: DataFrame, parts: list[Part], radius: int, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): links between nodes(node, w0, w1, ...), distinct fingerprints with a name. All that are near in a part and
    within radius are connected by what is returned.

    With columns `root` (the class that a node is in) and `shingles`, only links between classes count, and only those whose
    sets of shingles have the similarity: they connect all such classes."""
    names = [c for c in nodes.columns if re.fullmatch(r"w\d+", c)]
    more = [c for c in ("root", "shingles") if c in nodes.columns]
    kind = nodes.schema["node"].dataType.simpleString()
    total = nodes.count()
    one_in = total // SAMPLE + 1
    # about SAMPLE rows at most, however many there are
    sample = nodes.select(*names).where(F.pmod(F.xxhash64(*names, F.lit(1)), F.lit(one_in)) == 0).collect()
    sample = np.array([tuple(r) for r in sorted(sample)], dtype=np.int64).reshape(-1, len(names)).view(np.uint64)
    rng, trees, first = np.random.default_rng(SEED), [], 0
    for part in parts:
        tree, first = grow(part.of(sample), part.slack, total / max(1, len(sample)), first, rng)
        trees.append(tree)

    def words_of(t: pa.Table | pa.RecordBatch) -> np.ndarray:
        return np.stack([t.column(w).to_numpy() for w in names], axis=1).view(np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                b = whole.slice(start, 4096)
                words = words_of(b)
                pick = mix64(np.bitwise_xor.reduce(words, axis=1))
                for k, (part, tree) in enumerate(zip(parts, trees)):
                    sent = [x for x in route(tree, part.of(words), part.slack, pick) if len(x[2])]
                    at = np.concatenate([x[2] for x in sent])
                    counts = [len(x[2]) for x in sent]
                    block, role = (np.repeat(np.array([x[i] for x in sent], dtype=np.int32), counts) for i in (0, 1))
                    rows = b.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(np.full(len(at), k, dtype=np.int32)), pa.array(role), *rows.columns], ["block", "part", "role", *rows.schema.names])

    def search(t: pa.Table) -> pa.Table:
        node, found = t.column("node"), None
        if more:
            sets = t.column("shingles").combine_chunks()
            roots = np.unique(np.array(t.column("root").to_pylist()), return_inverse=True)[1]
            bounds = sets.offsets.to_numpy().astype(np.int64)
            found = Alike(roots, sets.values.to_numpy()[bounds[0] : bounds[-1]], bounds - bounds[0], similarity)
        a, b, _ = block_links(words_of(t), t.column("role").to_numpy(), parts[t.column("part")[0].as_py()], radius, found)
        return pa.table({"a": node.take(pa.array(a)), "b": node.take(pa.array(b))})

    fields = f"block int, part int, role int, node {kind}, {', '.join(f'{w} long' for w in names)}"
    fields += f", root {kind}, shingles array<int>" if more else ""
    sent = nodes.select("node", *names, *more).mapInArrow(send, fields)
    return sent.groupBy("block").applyInArrow(search, f"a {kind}, b {kind}")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in edges (a, b): root is the smallest node reachable. Large-star and small-star
    rounds (Kiveris et al. 2014), each written to the shared folder, until nothing changes."""
    e, at = written_at(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    # both are sets of pairs, so they are equal if counts and order-free sums of hashes are
    sums = [F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.hash("b", "a").cast("long"))]
    before = e.agg(*sums).first()
    while before[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.where("b <> a").groupBy("a").agg(F.min("b").alias("m"))
        small = large.where("b <> a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        e, new_at = written_at(small.where("a <> b").distinct(), "links")
        remove(at)
        after, at = e.agg(*sums).first(), new_at
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def named(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, root and component_id, of nodes(node, _least): all nodes that edges connect have one root, the least of them,
    and one component_id, the least _least."""
    found = components(edges).withColumnRenamed("node", "_node")
    # a node without links is its own component
    member = nodes.join(found, F.col("node") == F.col("_node"), "left").select("node", "_least", F.coalesce("root", "node").alias("root"))
    return member.join(member.groupBy("root").agg(F.min("_least").alias("component_id")), "root").select("node", "root", "component_id")


def classes(prints: DataFrame, radius: int = 4) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links) of every row of prints(doc_id, fp);
    fingerprints that differ in at most radius bits are linked.

    A null id names a component only if that has no others; repeated rows are in one component; no rows give none."""
    prints, _ = written_at(prints, "fingerprints")
    nodes = prints.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("_least"))
    found = named(nodes, links(nodes.select("node", F.col("node").alias("w0")), short_parts(1, 64 // PARTS, radius // PARTS), radius))
    return prints.join(found, F.col("fp") == F.col("node")).select("doc_id", "fp", "component_id")


def confirmed(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """pairs(a, b) with `alike`: whether the nodes' sets of shingles have at least this Jaccard similarity."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = written(sketches.join(needed, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("s")), "shingles")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", (shared >= F.lit(similarity) * (F.size("x") + F.size("y") - shared)).alias("alike"))


def unsettled(nodes: DataFrame, judged: DataFrame) -> DataFrame:
    """Those nodes, with root, whose candidates connect several classes of confirmed links: only between these classes can
    a link be missing."""
    near = components(judged.select("a", "b")).withColumnRenamed("root", "_group")
    sure = components(judged.where("alike").select("a", "b"))
    member = near.join(sure, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = member.groupBy("_group").agg((F.min("root") != F.max("root")).alias("_several")).where("_several")
    return nodes.join(member.join(several, "_group", "left_semi").select("node", "root"), "node")


def alike(sketches: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): pairs of nodes of sketches(node, w0, ..., shingles) whose sets of shingles have at least this Jaccard
    similarity; they connect all such pairs that are candidates (near in a part and within the radius).

    First a spanning forest of each block's candidates is confirmed. Where that fails for a link, the classes on its two sides
    may still be alike by other candidates: their nodes are searched again, now with their shingles, so that a block confirms
    each candidate between two classes itself, however many there are, and only sends on what it confirmed."""
    words = [c for c in sketches.columns if re.fullmatch(r"w\d+", c)]
    nodes, parts = sketches.groupBy("node").agg(*[F.first(w).alias(w) for w in words]), short_parts(len(words))
    candidates = written(links(nodes, parts, SKETCH_RADIUS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    judged = written(confirmed(candidates, sketches, similarity), "judged")
    sure = judged.where("alike").select("a", "b")
    if judged.where(~F.col("alike")).isEmpty():
        return sure
    again = written(unsettled(nodes, judged), "unsettled")
    sets = sketches.join(again.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))
    again = written(again.join(sets, "node"), "unsettled-sets")
    found = links(again, parts, SKETCH_RADIUS, similarity).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return sure.union(written(found.distinct(), "confirmed"))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, _text (hash of the text), root (names the class) and component_id of every row: texts whose sets of shingles of five words
    have a Jaccard similarity of at least 0.8 are linked (also two without words), and component_id is the smallest doc_id
    reachable."""
    sketches, _ = written_at(with_sketches(docs), "sketches")
    nodes = sketches.groupBy("node").agg(F.min("doc_id").alias("_least"))
    found = named(nodes, alike(sketches, similarity))
    return sketches.select("doc_id", "_text", "node").join(found, "node").select("doc_id", "_text", "root", "component_id")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, all columns, that have the smallest doc_id of their class of near-duplicates.

    Of repeated rows one stays, and so does one of several texts under one id that are in one class; others under that
    id are in classes of their own. Rows without an id cannot be named and stay."""
    ids = docs.where("doc_id is not null")
    path = scratch(docs.sparkSession, "kept")
    with temporary():
        # sketches, candidates and links have done their work once the ids that stay are written
        first = near_classes(ids, similarity).where("doc_id = component_id").groupBy("root", "doc_id", "_text").agg(F.count("*").alias("rows"))
        first = first.groupBy("root").agg(F.min(F.struct("doc_id", "_text", "rows")).alias("k")).select("k.*")
        kept = written(first, path=path)

    def of(some: DataFrame) -> DataFrame:
        is_kept = (F.col("d.doc_id") == F.col("k.doc_id")) & (F.xxhash64("d.text") == F.col("k._text"))
        return ids.alias("d").join(some.alias("k"), is_kept, "left_semi")

    out = of(kept.where("rows = 1")).unionByName(docs.where("doc_id is null"))
    # only rows that occur several times need a shuffle by text
    repeated = kept.where("rows > 1")
    return out if repeated.isEmpty() else out.unionByName(of(repeated).dropDuplicates(["doc_id", "text"]))
