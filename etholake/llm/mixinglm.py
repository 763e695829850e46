"""Operator 8: language-model scoring by logistic context mixing.

Texts are of several kinds, such as languages: clusters of the pairs of bytes that occur in them. A text's kind is stated
first, at equal cost for all. A byte is eight binary decisions, and four predictors, of hashed contexts (the last two and
three bytes with the kind, the last four, and the word so far with the kind), each give a probability for every decision from counts over the training corpus. A mixer adds up their
logits with weights that a gate selects by the bit's place and by how well the two longest contexts are known. All training
documents teach it: each group of them learns weights online, bit after bit, against counts that leave out its fold, a
fourth of the groups, and the weights are averaged by how often each gate was open. Texts are then scored by all counts.

Two such weight sets and a memory of words are mixed again. The memory has how often each word, with its case and what ends
it, occurs in the training corpus: it grows with the corpus, and no machine holds it all. Scoring refines adaptively: after
each block of words of a text, the experts' shares follow how well they have predicted the text so far. Each expert, and so
their mix, is a probability distribution of texts.

Documents are dealt into groups. A group sends its distinct words with their counts, packed, to buckets, which add up
and answer each group's words with their counts over the corpus; and what its contexts add to the predictors' tables,
slice by slice, which is added up in two steps. The tables of byte contexts have a fixed size, the words' counts have not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard as zstd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_mod, mix64, n_shuffle, written
from .suffixes import _by, part_of

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What ends a word: white space and the end mark, which is no byte of UTF-8.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32, 255]] = True
#: Bytes of a word that its hash as a context takes in.
PREFIX = 48
#: Slots of the tables of contexts of two, three and four bytes and the word so far, as powers of two.
TABLE_BITS = (18, 21, 22, 23)
SLICES = 64
ORDERS = len(TABLE_BITS)
START, END = b"\n" * 4, b"\xff"
#: The end of a text as a token, by its hash; and the hash of no bytes.
END_TOKEN, EMPTY = 0x6E64, np.uint64(0x2545F4914F6CDD1D)
#: Words of a block, and the shares that the experts (weight sets, memory of words) begin a text with, as so many words.
BLOCK, PRIOR, PRIOR_WORDS = 32, (0.74, 0.25, 0.01), 12.0
#: Groups are dealt into so many folds: the mixer learns on a fold's texts with the counts of the others.
FOLDS = 4
#: Step size of the mixer's learning; a step has a distinct context for so many bytes of the group, and so many at least and most.
RATE, BYTES_A_CONTEXT, BATCH = 0.08, 1024, (256, 8192)
#: Text that one group of documents should hold, that is prepared at a time, and bytes that are scored at a time.
GROUP_BYTES, CHUNK_BYTES, STEP = 16 << 20, 2 << 20, 8192
#: Groups whose words one bucket adds up, by their number; groups whose slots, or whose kinds, are brought together.
GROUPS_A_BUCKET, FAN_IN = 8, 32
_SIZES = [1 << b for b in TABLE_BITS]
_BASE = np.concatenate([[0], np.cumsum(_SIZES)]).astype(np.int64)
_WIDE = -(-int(_BASE[-1]) // SLICES)
#: Added to a slot's zeros and ones.
PSEUDO = 0.15
#: A cell: the slot's logit in quarters (-32 to 31), and in the low two bits how well it is known.
_LOGIT = ((np.arange(256) >> 2) - 32).astype(np.float32) / 4
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
#: Kinds of rows. Words are lower-cased tokens or units (with case and what ends them).
TOKENS, SLOTS, ANSWERS, UNITS, UNIT_ANSWERS = range(5)
#: A unit is known by 40 bits of its hash.
UNIT_SHIFT = 24


def _dump(*columns: np.ndarray) -> bytes:
    """Columns packed byte by byte: all first bytes, all second bytes, and so on."""
    planes = (np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T).tobytes() for c in columns)
    return zstd.ZstdCompressor(level=1).compress(b"".join(planes))


def _load(blob: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    raw = np.frombuffer(zstd.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, out, at = len(raw) // sum(sizes), [], 0
    for k, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(k).ravel())
        at += n * size
    return out


def _dump_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and their counts."""
    return _dump(np.diff(keys, prepend=np.uint64(0)), counts.astype("<u4"))


def _load_counts(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(np.cumsum(k, dtype=np.uint64), c) for k, c in (_load(b, ("<u8", "<u4")) for b in blobs)]
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, "<u4"))


#: Kinds of texts, and dimensions of the profile of a text's pairs of bytes.
KINDS, PROFILE = 16, 512


def profiles(texts: list[bytes]) -> np.ndarray:
    """How often hashed pairs of bytes occur in each text: square roots, of length one."""
    out = np.zeros((len(texts), PROFILE), dtype=np.float32)
    for i, t in enumerate(texts):
        x = np.frombuffer(t, dtype=np.uint8).astype(np.uint32)
        out[i] = np.bincount(((x[:-1] << 8 | x[1:]) * np.uint32(0x9E3779B1)) >> np.uint32(23), minlength=PROFILE) if len(x) > 1 else 0
    out = np.sqrt(out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def kinds_of(texts: list[bytes], centres: np.ndarray) -> np.ndarray:
    return (profiles(texts) @ centres.T).argmax(1) if len(texts) else np.zeros(0, dtype=np.int64)


def _cluster(x: np.ndarray, weight: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres of KINDS clusters of weighted profiles, drawn apart from each other at first, and the weight of each."""
    rng = np.random.default_rng(0)
    centres, near = x[:1], x @ x[0]
    while len(centres) < KINDS:
        far = np.cumsum(weight * np.maximum(1 - near, 0), dtype=np.float64)
        centres = np.vstack([centres, x[min(int(np.searchsorted(far, rng.random() * far[-1], side="right")), len(x) - 1)]])
        near = np.maximum(near, x @ centres[-1])
    for _ in range(rounds):
        of = (x @ centres.T).argmax(1)
        belongs = (of == np.arange(KINDS)[:, None]) * weight.astype(np.float32)
        sums = belongs @ x
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-6), centres)
    return centres, np.bincount((x @ centres.T).argmax(1), weight, KINDS)


def cluster(texts: list[bytes], rounds: int = 12) -> np.ndarray:
    """Centres of KINDS clusters of texts."""
    x = profiles(texts) if texts else np.zeros((1, PROFILE), dtype=np.float32)
    return _cluster(x, np.ones(len(x)), rounds)[0]


class Prepared:
    """Texts one after the other: for every byte and every end, the byte with the four before it (keys, 40 bits) and the
    hash of the word so far, lower-cased (prefixes), both with the text's kind; and the hashes of all words, with an end
    token for each text."""

    def __init__(self, texts: list[bytes], centres: np.ndarray) -> None:
        buffer = np.frombuffer(b"".join(x for t in texts for x in (START, t, END)) + bytes(8), dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(self.bounds[-1]) + 4 * np.repeat(np.arange(len(texts)), lengths)
        self.keys = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))[at] & np.uint64(0xFFFFFFFFFF)
        low, space = _LOWER[buffer], _SPACE[buffer]
        space[-8:] = True
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        so_far = np.full(len(buffer), EMPTY, dtype=np.uint64)
        size, h, live = ends - starts, np.full(len(starts), EMPTY, dtype=np.uint64), np.arange(len(starts))
        for k in range(PREFIX + 1):
            place = starts[live] + k
            so_far[place] = h[live]
            go = size[live] > k
            live = live[go]
            if not len(live) or k == PREFIX:
                break
            x = (h[live] ^ low[place[go]]) * np.uint64(0x9E3779B97F4A7C15)
            h[live] = x ^ (x >> np.uint64(29))
        # of a longer word, the context stays that of its beginning, and the hash takes in the rest
        for i in live.tolist():
            so_far[starts[i] + PREFIX : ends[i] + 1] = h[i]
            h[i] = np.uint64(xxhash.xxh3_64_intdigest(low[starts[i] : ends[i]].tobytes()))
        # the place before each key's byte, counted in the buffer, is four before its own
        kind = np.repeat(kinds_of(texts, centres).astype(np.uint64), lengths)
        self.keys = self.keys | kind << np.uint64(40)
        self.prefixes = so_far[at + 4] + kind * _ODD[1]
        first = at[self.bounds[:-1]]
        owner = np.searchsorted(first, starts, side="right") - 1
        counts = np.bincount(owner, minlength=len(texts))
        self.token_bounds = np.concatenate([[0], np.cumsum(counts + 1)])
        self.tokens = np.full(self.token_bounds[-1], END_TOKEN, dtype=np.uint64)
        words = mix64(h + size.astype(np.uint64))
        self.tokens[np.arange(len(starts)) + owner] = words
        # units: a word, its case, and the byte that ends it; between words, each byte is a unit that no memory has
        upper = np.flatnonzero((buffer >= 65) & (buffer <= 90))
        of = np.searchsorted(starts, upper, side="right") - 1
        case = np.zeros(len(starts), dtype=np.uint64)
        np.add.at(case, of, mix64((upper - starts[of] + 1).astype(np.uint64)))
        self.words = mix64(words ^ mix64(case) ^ (buffer[ends].astype(np.uint64) + np.uint64(1)) * _ODD[0]) >> np.uint64(UNIT_SHIFT)
        unit_ends = np.flatnonzero(_SPACE[_last_bytes(self.keys)])
        self.unit_starts = np.concatenate([[0], unit_ends[:-1] + 1]).astype(np.int64)
        self.is_word = unit_ends > self.unit_starts
        self.unit_bounds = np.searchsorted(self.unit_starts, self.bounds)

    def distinct(self, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(code of each place, a place of each code) of equal keys and prefixes, at the wanted places or all."""
        both = mix64(self.keys) ^ self.prefixes
        codes, values = pd.factorize(both if wanted is None else both[wanted])
        place = np.empty(len(values), dtype=np.int64)
        place[codes[::-1]] = np.arange(len(codes))[::-1]
        return codes, place if wanted is None else wanted[place]


def _contexts(keys: np.ndarray, prefixes: np.ndarray) -> list[np.ndarray]:
    u, kind = np.uint64, keys >> np.uint64(40)
    return [*(mix64(((keys >> u(8 * (4 - k))) & u((1 << 8 * k) - 1)) + u(k << 40) + ((kind << u(44)) if k < 4 else u(0))) for k in (2, 3, 4)), mix64(prefixes)]


def _last_bytes(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(32)).astype(np.uint8)


def _line(context: np.ndarray, order: int, half: np.ndarray | int) -> np.ndarray:
    """First of the sixteen slots of a context's next four decisions: half is 0, or 16 and the byte's first half."""
    h = (context ^ (np.uint64(half) * _ODD[0])) * _ODD[1]
    return ((h >> np.uint64(68 - TABLE_BITS[order])) << np.uint64(4)).astype(np.int64)


def _decisions(byte: np.ndarray) -> Iterator[tuple[np.ndarray | int, np.ndarray, np.ndarray]]:
    """(half, node in the line, bit) of the byte's eight decisions."""
    for half, four in ((0, byte >> 4), (16 + (byte >> 4), byte & 15)):
        node = np.ones(len(byte), dtype=np.int64)
        for j in (3, 2, 1, 0):
            bit = (four >> j) & 1
            yield half, node, bit
            node = 2 * node + bit


class Tally:
    """Zeros and ones of the slots of one order of contexts."""

    def __init__(self, order: int) -> None:
        self.order, self.sums = order, np.zeros(2 * _SIZES[order], dtype=np.int32)

    def add(self, context: np.ndarray, byte: np.ndarray, count: np.ndarray) -> None:
        if self.order < ORDERS - 1:
            codes, values = pd.factorize(context + byte.astype(np.uint64) * _ODD[0])
            at = np.empty(len(values), dtype=np.int64)
            at[codes] = np.arange(len(codes))
            context, byte, count = context[at], byte[at], np.bincount(codes, count, len(at))
        few, last, line = count.astype(np.int32), None, None
        for half, node, bit in _decisions(byte.astype(np.int64)):
            if half is not last:
                last, line = half, 2 * _line(context, self.order, half)
            np.add.at(self.sums, line + (2 * node + bit), few)

    def slots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot over all tables, zeros, ones), by slot."""
        at = np.flatnonzero(self.sums.view(np.int64))
        return at + _BASE[self.order], self.sums[2 * at], self.sums[2 * at + 1]


class MixingModel:
    """Tables of cells and the mixer's weights.

    A weight set adds up the logits of its orders, each times a weight that the gate selects: by the decision's place in
    the byte and by how well the two longest contexts are known."""

    SETS = ((0, 1, 2, 3), (0, 1))

    def __init__(self, cells: np.ndarray, centres: np.ndarray) -> None:
        self.cells, self.centres = cells, centres
        # by weight set: (order, or last the bias; the bit's place; gate)
        self.weights = [np.zeros((len(x) + 1, 8, 16), dtype=np.float32) for x in self.SETS]
        for x, w in zip(self.SETS, self.weights):
            w[:-1] = 1.2 / len(x)

    def _inputs(self, contexts: list[np.ndarray], byte: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """(bit, gate and cell by order, in one number) of the bytes' eight decisions."""
        last, lines = None, []
        for half, node, bit in _decisions(byte):
            if half is not last:
                last, lines = half, [_line(c, k, half) + _BASE[k] for k, c in enumerate(contexts)]
            cells = [self.cells.take(x + node) for x in lines]
            gate = ((cells[3] & 3) << 2 | cells[2] & 3).astype(np.int64) << 8
            yield bit, [gate | c for c in cells]

    def _parts(self, j: int) -> list[np.ndarray]:
        """What each order adds to the logits at a bit's place, by gate and cell: for both sets (real, imaginary), or for the first
        alone. The bias goes with the first order."""
        w, v = (x[:, j, :, None] for x in self.weights)
        both = [w[k] * _LOGIT + 1j * (v[k] * _LOGIT) for k in self.SETS[1]]
        both[0] = both[0] + (w[-1] + 1j * v[-1])
        return [*(x.astype(np.complex64).ravel() for x in both), *((w[k] * _LOGIT).ravel() for k in self.SETS[0][len(both) :])]

    @staticmethod
    def _logits(parts: list[np.ndarray], at: list[np.ndarray]) -> np.ndarray:
        """A row for each decision, a column for each set."""
        z = parts[0].take(at[0])
        z += parts[1].take(at[1])
        z = z.view(np.float32).reshape(-1, 2)
        z[:, 0] += parts[2].take(at[2]) + parts[3].take(at[3])
        return z

    def learn(self, texts: list[bytes], rate: float = RATE, batch: int | None = None) -> np.ndarray:
        """One online pass over the distinct contexts of each chunk: after each batch of them the weights of the gates seen follow
        the error (AdaGrad). Returns how many decisions each gate had at each place."""
        seen = np.zeros((8, 16))
        batch = batch or int(np.clip(sum(map(len, texts)) // BYTES_A_CONTEXT, *BATCH))
        squares = [np.full_like(w, 1e-2) for w in self.weights]
        for _, part in _byte_chunks(texts):
            given = Prepared(part, self.centres)
            codes, place = given.distinct()
            # mixed, as frequent contexts are met first
            mixed = np.random.default_rng(0).permutation(len(place))
            many, place = np.bincount(codes, minlength=len(place)).astype(float)[mixed], place[mixed]
            keys, prefixes = given.keys[place], given.prefixes[place]
            for start in range(0, len(keys), batch):
                some, times = keys[start : start + batch], many[start : start + batch]
                contexts = _contexts(some, prefixes[start : start + batch])
                for j, (bit, at) in enumerate(self._inputs(contexts, _last_bytes(some).astype(np.int64))):
                    z = self._logits(self._parts(j), at)
                    np.clip(z, -30, 30, out=z)
                    np.exp(np.negative(z, out=z), out=z)
                    z += 1
                    errors = [(bit - 1 / x) * times for x in z.T]
                    here = np.bincount(at[0] >> 8, times, 16)
                    seen[j] += here
                    for orders, weights, square, err in zip(self.SETS, self.weights, squares, errors):
                        sums = [np.bincount(at[k], err, 4096).reshape(16, 256) for k in orders]
                        step = np.array([*(x @ _LOGIT for x in sums), sums[0].sum(1)]) / np.maximum(here, 1)
                        square[:, j] += step**2
                        weights[:, j] += rate * step / np.sqrt(square[:, j])
        return seen

    def costs(self, keys: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
        """Natural log probabilities of the keys' last bytes, a row for each weight set."""
        out = np.zeros((len(self.SETS), len(keys)), dtype=np.float32)
        parts = [self._parts(j) for j in range(8)]
        for start in range(0, len(keys), STEP):
            some = keys[start : start + STEP]
            contexts = _contexts(some, prefixes[start : start + STEP])
            # the inverse probabilities of eight decisions, multiplied: at most (1 + e**10) ** 8
            product = np.ones((len(some), len(self.SETS)), dtype=np.float32)
            for j, (bit, at) in enumerate(self._inputs(contexts, _last_bytes(some).astype(np.int64))):
                z = self._logits(parts[j], at)
                z *= (1 - 2 * bit).astype(np.float32)[:, None]
                np.clip(z, -10, 10, out=z)
                np.exp(z, out=z)
                z += 1
                product *= z
            out[:, start : start + STEP] = -np.log(product).T
        return out

    def score(self, given: Prepared, counts: np.ndarray, n_units: int) -> np.ndarray:
        """log10 probability of each whole text and its end; counts: in training texts, of the text's words as units, of
        n_units in all."""
        codes, place = given.distinct()
        per = self.costs(given.keys[place], given.prefixes[place])
        logs = np.full((len(self.SETS) + 1, len(given.unit_starts)), -np.inf)
        for g, row in enumerate(per):
            logs[g] = np.add.reduceat(row[codes], given.unit_starts, dtype=np.float64) if len(codes) else 0.0
        with np.errstate(divide="ignore"):
            logs[-1, given.is_word] = np.log(counts) - np.log(max(n_units, 1))
        bounds = given.unit_bounds
        n = np.diff(bounds)
        # all texts' t-th blocks at once; longest texts first, so that those still going are a prefix
        order = np.argsort(-n, kind="stable")
        first, size = bounds[:-1][order], n[order]
        seen, total = np.tile(PRIOR_WORDS * np.array(PRIOR)[:, None], len(n)), np.zeros(len(n))
        for t in range(0, int(size[0]) if len(n) else 0, BLOCK):
            live = int(np.searchsorted(-size, -t, side="left"))
            at = first[:live, None] + np.minimum(np.arange(t, t + BLOCK), size[:live, None] - 1)
            there = np.arange(t, t + BLOCK) < size[:live, None]
            share = np.log(seen[:, :live] / seen[:, :live].sum(0))
            joint = share[:, :, None] + logs[:, at]
            top = joint.max(0)
            part = np.exp(joint - top)
            whole = part.sum(0)
            total[:live] += ((top + np.log(whole)) * there).sum(1)
            seen[:, :live] += (part / whole * there).sum(2)
        out = np.empty(len(n))
        out[order] = total / np.log(10) - np.log10(KINDS)
        return out


def _byte_chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t) + 16
    if start < len(texts):
        yield start, texts[start:]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inverse = np.unique(keys, return_inverse=True)
    return u, np.bincount(inverse, counts, len(u)).astype(np.int64)


def _table(rows: list[tuple]) -> pa.Table:
    kinds = {"key": pa.int32(), "kind": pa.int32(), "payload": pa.binary(), "total": pa.int64(), "distinct": pa.int64()}
    return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(kinds.items())})


ROWS = "key int, kind int, payload binary, total long, distinct long"


def _dumped_slots(s: np.ndarray, z: np.ndarray, o: np.ndarray) -> bytes:
    return _dump(np.diff(s, prepend=0).astype("<u4"), z.astype("<u4"), o.astype("<u4"))


def _added_slots(blobs: list[bytes]) -> np.ndarray:
    """(zeros, ones) over one slice, of slots counted from its beginning."""
    sums = np.zeros((2, _WIDE), dtype=np.int64)
    for b in blobs:
        s, z, o = _load(b, ("<u4", "<u4", "<u4"))
        at = np.cumsum(s, dtype=np.int64)
        sums[0, at] += z
        sums[1, at] += o
    return sums


def packed(docs: DataFrame) -> DataFrame:
    """docs (doc_id long, text, held_out, _part), each text compressed by itself, as it lies on disk for several passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstd.ZstdCompressor(level=3)
        for b in batches:
            texts = pa.array([press.compress(x or b"") for x in b.column("text").cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), texts, b.column("held_out"), b.column("_part")], ["doc_id", "text", "held_out", "_part"])

    return docs.select("doc_id", "text", "held_out", "_part").mapInArrow(run, "doc_id long, text binary, held_out boolean, _part int")


def _texts(t: pa.Table) -> list[bytes]:
    release = zstd.ZstdDecompressor()
    return [release.decompress(x) for x in t.column("text").to_pylist()]


def _training(t: pa.Table) -> list[bytes]:
    """A group's training texts, in an order that does not depend on how they came."""
    return sorted(_texts(t.filter(pc.invert(t.column("held_out")))))


def kinds(dealt: DataFrame, n: int) -> np.ndarray:
    """Centres of the kinds of all training texts of dealt (as packed() gives them): clusters of the profiles of some thousands,
    whose centres, with their weights, are clustered again, group by group, until one set is left."""
    out = "key int, payload binary, weights binary"

    def row(key: int, x: np.ndarray, weight: np.ndarray) -> pa.Table:
        centres, weight = _cluster(x, weight, 12)
        return pa.table({"key": pa.array([key], pa.int32()), "payload": [centres.astype("<f4").tobytes()], "weights": [weight.astype("<f8").tobytes()]})

    def local(t: pa.Table) -> pa.Table:
        texts = _training(t)
        some = [_cluster(profiles(texts[i : i + 4096]), np.ones(len(texts[i : i + 4096])), 12) for i in range(0, len(texts), 4096)]
        none = (np.zeros((1, PROFILE), dtype=np.float32), np.zeros(1))
        return row(t.column("_part")[0].as_py(), *(np.concatenate(x) for x in zip(*(some or [none]))))

    def together(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        x, weight = (np.frombuffer(b"".join(t.column(c).to_pylist()), dtype=k) for c, k in (("payload", "<f4"), ("weights", "<f8")))
        x, real = x.reshape(-1, PROFILE), weight > 0
        return row(t.column("key")[0].as_py() // FAN_IN, *((x[real], weight[real]) if real.any() else (x[:1], weight[:1])))

    found = dealt.select("text", "held_out", "_part").groupBy("_part").applyInArrow(local, out)
    while n > 1:
        found, n = found.groupBy(F.floor(F.col("key") / FAN_IN).cast("int")).applyInArrow(together, out), -(-n // FAN_IN)
    r = found.first()
    return np.frombuffer(r["payload"], dtype="<f4").reshape(KINDS, PROFILE) if r else cluster([])


def count(dealt: DataFrame, n: int, buckets: int, centres: np.ndarray) -> DataFrame:
    """Counts over dealt (as packed() gives it): rows of ANSWERS and UNIT_ANSWERS (key: the group that asked; its words and
    their counts in training texts), of TOKENS and UNITS (totals), and of SLOTS (key: the slice of the tables; distinct: the
    fold), packed."""
    fans = -(-n // (FAN_IN * FOLDS))
    slots_from = 2 * buckets

    def words_of(parts: list[tuple[np.ndarray, np.ndarray]], kind: int, first: int, me: int) -> list[tuple]:
        hashes, c = _summed(*(np.concatenate(x) for x in zip(*parts)))
        of = (mix64(hashes) >> np.uint64(33)).astype(np.int64) % buckets
        return [(first + k, kind, _dump_counts(hashes[i], c[i]), me, 0) for k, i in _by(of, buckets)]

    def run(t: pa.Table) -> pa.Table:
        me = t.column("_part")[0].as_py()
        texts = _texts(t)
        held = np.array(t.column("held_out").to_pylist(), dtype=bool)
        tokens, units, tallies = [], [], [Tally(k) for k in range(ORDERS)]
        for first, part in _byte_chunks(texts):
            given = Prepared(part, centres)
            here = slice(first, first + len(part))
            codes, distinct = pd.factorize(given.tokens)
            learned = np.repeat(~held[here], np.diff(given.token_bounds))
            tokens.append((distinct, np.bincount(codes, learned, len(distinct)).astype(np.int64)))
            # the tokens but the last of each text are its words
            codes, distinct = pd.factorize(given.words)
            learned = np.repeat(~held[here], np.diff(given.token_bounds) - 1)
            units.append((distinct, np.bincount(codes, learned, len(distinct)).astype(np.int64)))
            if not held[here].all():
                codes, place = given.distinct(np.flatnonzero(np.repeat(~held[here], np.diff(given.bounds))))
                many, keys = np.bincount(codes, minlength=len(place)), given.keys[place]
                for tally, context in zip(tallies, _contexts(keys, given.prefixes[place])):
                    tally.add(context, _last_bytes(keys), many)
        rows = words_of(tokens, TOKENS, 0, me) + words_of(units, UNITS, buckets, me)
        fold, fan = me % FOLDS, me // FOLDS % fans
        while tallies:
            slots, zeros, ones = tallies.pop().slots()
            edges = np.searchsorted(slots, np.arange(SLICES + 1) * _WIDE)
            for s in np.flatnonzero(np.diff(edges)).tolist():
                i = slice(edges[s], edges[s + 1])
                rows.append((slots_from + (s * FOLDS + fold) * fans + fan, SLOTS, _dumped_slots(slots[i] - s * _WIDE, zeros[i], ones[i]), s, fold))
        return _table(rows)

    def merge(t: pa.Table) -> pa.Table:
        blobs, kind = t.column("payload").to_pylist(), t.column("kind")[0].as_py()
        if kind == SLOTS:
            sums = _added_slots(blobs)
            at = np.flatnonzero(sums.any(0))
            return _table([(t.column("total")[0].as_py(), kind, _dumped_slots(at, sums[0, at], sums[1, at]), 0, t.column("distinct")[0].as_py())])
        hashes, counts = _summed(*_load_counts(blobs))
        rows = [(t.column("key")[0].as_py(), kind, b"", int(counts.sum()), int((counts > 0).sum()))]
        for asked, blob in zip(t.column("total").to_pylist(), blobs):
            k, _ = _load_counts([blob])
            c = counts[np.searchsorted(hashes, k)]
            rows.append((asked, ANSWERS if kind == TOKENS else UNIT_ANSWERS, _dump_counts(k[c > 0], c[c > 0]), 0, 0))
        return _table(rows)

    return dealt.select("text", "held_out", "_part").groupBy("_part").applyInArrow(run, ROWS).groupBy("key").applyInArrow(merge, ROWS)


def build(counts: DataFrame) -> np.ndarray:
    """The tables' cells, a row without each fold and a last one with all; SLICES rows of fixed size in all."""

    def dense(t: pa.Table) -> pa.Table:
        blobs, folds = t.column("payload").to_pylist(), t.column("distinct").to_pylist()
        by_fold = np.array([_added_slots([b for b, x in zip(blobs, folds) if x == k]) for k in range(FOLDS)])
        out, whole = b"", by_fold.sum(0)
        for sums in (*(whole - x for x in by_fold), whole):
            logit = np.clip(np.rint(4 * np.log((sums[1] + PSEUDO) / (sums[0] + PSEUDO))), -32, 31).astype(np.int64)
            out += ((logit + 32) << 2 | np.digitize(sums[0] + sums[1], [1, 3, 20])).astype(np.uint8).tobytes()
        return _table([(t.column("key")[0].as_py(), SLOTS, out, 0, 0)])

    # a slot without counts: a logit of zero, not known
    cells = np.full((FOLDS + 1, _WIDE * SLICES), 32 << 2, dtype=np.uint8)
    for r in counts.where(F.col("kind") == SLOTS).groupBy("key").applyInArrow(dense, ROWS).toLocalIterator():
        cells[:, r["key"] * _WIDE : (r["key"] + 1) * _WIDE] = np.frombuffer(r["payload"], dtype=np.uint8).reshape(FOLDS + 1, -1)
    return cells


def learned(dealt: DataFrame, cells: np.ndarray, centres: np.ndarray) -> MixingModel:
    """The model with the cells of all training texts, its weights learned on all of them: each group's online, with the cells
    that leave its fold out, then averaged by how many decisions each gate had."""
    shared = [dealt.sparkSession.sparkContext.broadcast(x) for x in cells[:FOLDS]]

    def run(t: pa.Table) -> pa.Table:
        model = MixingModel(shared[t.column("_part")[0].as_py() % FOLDS].value, centres)
        seen = model.learn(_training(t))
        sums = np.concatenate([(w * seen).ravel() for w in model.weights] + [seen.ravel()])
        return pa.table({"place": pa.array(range(len(sums)), pa.int32()), "total": sums})

    each = dealt.select("text", "held_out", "_part").groupBy("_part").applyInArrow(run, "place int, total double")
    model, found = MixingModel(cells[FOLDS], centres), each.groupBy("place").agg(F.sum("total").alias("total")).orderBy("place").collect()
    if found:
        sizes = [w.size for w in model.weights]
        *sums, seen = np.split(np.array([r["total"] for r in found]), np.cumsum(sizes))
        seen = seen.reshape(8, 16)
        model.weights = [np.where(seen > 0, x.reshape(w.shape) / np.maximum(seen, 1), w).astype(np.float32) for x, w in zip(sums, model.weights)]
    for x in shared:
        x.destroy()
    return model


def score(docs: DataFrame, modulus: int = 7, held: int = 2) -> DataFrame:
    """For every row's whole text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Rows whose crc32 of the id leaves `held` modulo `modulus` are not learned from (null ids are: they have no
    remainder). A null text counts as empty; the end of a text is scored too, so an empty one has a score; repeated rows
    count and are scored each; without rows, or without training rows, counts are zero and tables even."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", crc_mod(F.col("doc_id"), modulus) == held)
    total = d.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(n_shuffle(spark), -(-total // GROUP_BYTES), FOLDS)
    buckets = max(n_shuffle(spark), n // GROUPS_A_BUCKET)
    # texts lie with their groups on disk for the four passes over them, and are shuffled once
    dealt = packed(d.withColumn("_part", part_of(F.col("doc_id"), n))).repartition(n, "_part").persist(StorageLevel.DISK_ONLY)
    centres = kinds(dealt, n)
    counts = written(count(dealt, n, buckets, centres), "counts")
    sums = {r["kind"]: r for r in counts.where(F.col("kind").isin(TOKENS, UNITS)).groupBy("kind").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).collect()}
    n_train, n_distinct = (sums[TOKENS]["total"], sums[TOKENS]["distinct"]) if sums else (0, 0)
    n_units = sums[UNITS]["total"] if UNITS in sums else 0
    shared = spark.sparkContext.broadcast(learned(dealt, build(counts), centres))  # of a fixed size

    def finish(t: pa.Table, answers: pa.Table) -> pa.Table:
        kinds, blobs = answers.column("kind").to_pylist(), answers.column("payload").to_pylist()
        found = {}
        for kind in (ANSWERS, UNIT_ANSWERS):
            known, c = _load_counts([b for b, k in zip(blobs, kinds) if k == kind])
            order = np.argsort(known)
            found[kind] = known[order], c[order]

        def counts_of(kind: int, hashes: np.ndarray) -> np.ndarray:
            known, c = found[kind]
            at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            return np.where(known[at] == hashes, c[at], 0).astype(np.int64) if len(known) else np.zeros(len(hashes), dtype=np.int64)

        texts = _texts(t)
        n_tokens, n_known, logs, scores = (np.zeros(len(texts), dtype=k) for k in (np.int64, np.int64, float, float))
        for first, part in _byte_chunks(texts):
            given = Prepared(part, shared.value.centres)
            codes, distinct = pd.factorize(given.tokens)
            own = counts_of(ANSWERS, distinct)
            here, begin = slice(first, first + len(part)), given.token_bounds[:-1]
            n_tokens[here] = np.diff(given.token_bounds)
            n_known[here] = np.add.reduceat((own > 0).astype(np.int64)[codes], begin)
            logs[here] = np.add.reduceat(np.log10(own + 1.0)[codes], begin)
            codes, distinct = pd.factorize(given.words)
            scores[here] = shared.value.score(given, counts_of(UNIT_ANSWERS, distinct)[codes], n_units)
        base = logs - n_tokens * np.log10(n_train + 1.0 * (n_distinct + 1))
        bits = -scores * np.log2(10) / np.maximum(1, np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
        columns = [t.column("doc_id"), t.column("held_out"), *map(pa.array, (n_tokens, n_known, np.full(len(texts), n_train, dtype=np.int64), base, scores, bits))]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    answers = counts.where(F.col("kind").isin(ANSWERS, UNIT_ANSWERS))
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return dealt.groupBy("_part").cogroup(answers.groupBy("key")).applyInArrow(finish, out)
