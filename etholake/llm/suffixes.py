"""Operator 2: removing long repeats with a suffix array refined by bucket pointers.

Wanted: every byte covered by a MATCH-byte string that also starts in a document with a smaller doc_id. Sorting all
suffixes of a corpus would shuffle many times the corpus, so the suffix array is sparse:

1. Anchors. In every window of MATCH bytes the q-grams with the least hash are anchors. Equal windows have the same
   anchors at the same places, so a repeat is found at its anchors, about one in seventeen bytes.
2. Buckets by q-gram. Tasks send (hash of the q-gram, hashes of what lies around it, document, place), packed, to the
   bucket of the q-gram. All that one of MATCH bytes around an anchor can see is its surroundings. Anchors that may have
   equal surroundings in another document, or partly equal ones (17 bytes on one side at least), are open: hashes choose
   what is compared and settle nothing. Of copies within a task, compared byte by byte, one is sent.
3. Refinement. Open anchors are settled byte by byte: their surroundings, of equal ones in a group of documents one, go
   to the bucket. Of equal surroundings all but those with the least id are settled; of the others, suffixes are ordered
   by bucket pointers (Schuermann and Stoye 2005): the first buckets hold equal 8-byte beginnings, and buckets of more
   than one suffix are refined by the bucket pointers of the suffixes 8, 16 and 18 places on, with each round's pointers
   used by the next, up to depth 50. Comparison is exact.
4. The intervals found are cut out of the texts.

A q-gram that very many documents have, with ever other surroundings, would fill one bucket. A sample finds such hot
q-grams. Their anchors go another way: every string of MATCH bytes around them to the bucket of the string, by its 128-bit
hash and after equal ones in a task are settled by their bytes, so that no bucket has more than a string's own rows, of
which each task sends one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import mix64, n_shuffle, written

MATCH, Q = 50, 16
SPREAD = MATCH - Q
HALF = SPREAD // 2
GAP = 64
CHUNK_BYTES, CHUNK_DOCS = 3 << 20, 60_000
#: Buckets of open anchors for each group of documents: what is refined at a time is small.
FINER = 4
#: Text that one group of documents should hold.
PART_BYTES = 24 << 20
#: A q-gram is hot from so many anchors on, by the estimate of a sample of one in so many documents.
HOT_ANCHORS, HOT_ONE_IN = 50_000, 64
NULL_ID = np.iinfo(np.int64).max
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_PRIME = (1 << 31) - 1


def part_of(doc_id: Column, n: int) -> Column:
    """Which of n groups a document is in."""
    return (F.pmod(F.pmod(F.coalesce(doc_id.cast("long"), F.lit(int(NULL_ID))), F.lit(_PRIME)) * 48271, F.lit(_PRIME)) % n).cast("int")


def _parts(doc_ids: np.ndarray, n: int) -> np.ndarray:
    return doc_ids % _PRIME * 48271 % _PRIME % n


class Layout:
    """Documents one after the other in a buffer, with gaps of zeros between them."""

    def __init__(self, texts: list[bytes]) -> None:
        self.lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        gap = bytes(GAP)
        self.buffer = np.frombuffer(gap + b"".join(x for t in texts for x in (t, gap)), dtype=np.uint8)
        self.starts = GAP + np.concatenate([[0], np.cumsum(self.lengths + GAP)[:-1]]).astype(np.int64)
        self.words = np.ndarray((len(self.buffer) - 7,), "<u8", self.buffer, strides=(1,))


def _running(a: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over each run of width values, by doubling."""
    x, have = a, 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    n = len(a) - width + 1
    return pick(x[:n], x[width - have : width - have + n])


def _gram_hash(words: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the Q bytes at the places given, or at all."""
    a, b = (words[:-8], words[8:]) if at is None else (words[at], words[at + 8])
    h = a * _K[0]
    h ^= h >> np.uint64(32)
    h += b * _K[1]
    h ^= h >> np.uint64(29)
    h *= _K[2]
    return h


def anchors(x: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in it, hash) of the anchors of all windows."""
    none = np.zeros(0, dtype=np.int64)
    if not (x.lengths >= MATCH).any():
        return none, none, none.astype(np.uint64)
    h = _gram_hash(x.words)
    g = np.maximum((h >> np.uint64(32)).astype(np.uint32), np.uint32(1))
    least = _running(g, SPREAD + 1, np.minimum)
    valid = np.zeros(len(least) + 1, dtype=np.int8)
    long_ = x.lengths >= MATCH
    valid[x.starts[long_]] = 1
    valid[np.minimum(x.starts[long_] + x.lengths[long_] - MATCH + 1, len(least))] -= 1
    least[np.cumsum(valid[:-1], dtype=np.int8) == 0] = 0
    # a place is an anchor if it is the least of some window that covers it
    padded = np.concatenate([np.zeros(SPREAD, np.uint32), least])
    found = np.flatnonzero(_running(padded, SPREAD + 1, np.maximum) == g[: len(least)])
    doc = np.searchsorted(x.starts, found, side="right") - 1
    return doc, found - x.starts[doc], h[found]


#: Where the words of an anchor's surroundings begin.
_WORDS_AROUND = (-34, -26, -18, -10, -8, 16, 24, 32, 40, 42)


def _around(x: Layout, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of an anchor's surroundings (what of its document lies within SPREAD bytes before and MATCH after), of the
    HALF bytes before it and of those after; 0 for a half that the document does not have."""
    at = x.starts[doc] + place
    before, after = np.minimum(place, SPREAD), np.minimum(x.lengths[doc] - place, MATCH)

    def hashed(offsets: tuple[int, ...], h: np.ndarray) -> np.ndarray:
        for o in offsets:
            h = (h ^ x.words[at + o]) * _K[0]
            h ^= h >> np.uint64(31)
        return mix64(h)

    whole = hashed(_WORDS_AROUND, (before * 64 + after).astype(np.uint64))
    left = (hashed((-17, -9, -8), np.zeros(len(at), np.uint64)) >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
    right = (hashed((16, 24, 25), np.ones(len(at), np.uint64)) >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
    return whole, np.where(before >= HALF, left, 0).astype(np.uint16), np.where(after >= Q + HALF, right, 0).astype(np.uint16)


def _same(x: Layout, doc: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether anchors i and j have the same q-gram and surroundings, byte by byte."""
    at = x.starts[doc] + place
    before, after = np.minimum(place, SPREAD), np.minimum(x.lengths[doc] - place, MATCH)
    out = (before[i] == before[j]) & (after[i] == after[j])
    for o in (0, 8, *_WORDS_AROUND):
        out &= x.words[at[i] + o] == x.words[at[j] + o]
    return out


# ---- packed columns


def _dump(**columns: np.ndarray) -> bytes:
    return zstd.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns.values()))


def _load(blob: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    raw = zstd.ZstdDecompressor().decompress(blob)
    n, out, at = len(raw) // sum(np.dtype(k).itemsize for k in kinds), [], 0
    for k in kinds:
        size = n * np.dtype(k).itemsize
        out.append(np.frombuffer(raw[at : at + size], dtype=k))
        at += size
    return out


def _loaded(blobs: list[bytes], kinds: tuple[str, ...]) -> list[np.ndarray]:
    if not blobs:
        return [np.zeros(0, dtype=k) for k in kinds]
    return [np.concatenate(c) for c in zip(*(_load(b, kinds) for b in blobs))]


def _by(key: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(value, indices) of each value under n that occurs."""
    order = np.argsort(key, kind="stable")
    cut = np.searchsorted(key[order], np.arange(n + 1))
    for i in range(n):
        if cut[i] < cut[i + 1]:
            yield i, order[cut[i] : cut[i + 1]]


ENTRY = ("<u4", "<u8", "<u2", "<u2", "<i8", "<u4", "<u2", "<u2")
FOUND = ("<i8", "<u4", "<u4", "<u4")
SENT = "bucket int, kind int, payload binary"
ANSWER = "part int, kind int, payload binary"
#: Kinds of rows: anchors; intervals settled; anchors to be settled byte by byte; strings around anchors of hot q-grams.
ANCHORS, SETTLED, OPEN, STRINGS = 0, 1, 2, 3
STRING = ("<u8", "<u8", "<i8", "<u4", "<u4")
#: Where the words of a string of MATCH bytes begin.
_WORDS_WITHIN = (0, 8, 16, 24, 32, 40, 42)


def _interval(place: np.ndarray, length: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(place - SPREAD, 0), np.minimum(place + MATCH, length)


def _strings(x: Layout, ids: np.ndarray, keys: np.ndarray, doc: np.ndarray, place: np.ndarray, n: int) -> list[tuple[int, int, bytes]]:
    """The strings of MATCH bytes around these anchors by bucket, of equal ones the least id's, and what that settles."""
    first = np.maximum(place - SPREAD, 0)
    count = np.minimum(place, x.lengths[doc] - MATCH) - first + 1
    start = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    doc, start = np.divmod(np.unique(np.repeat(doc, count) << 32 | start), 1 << 32)
    at, d = x.starts[doc] + start, ids[doc]
    h, g = np.zeros(len(at), np.uint64), np.ones(len(at), np.uint64)
    for o in _WORDS_WITHIN:
        h = mix64((h ^ x.words[at + o]) * _K[0])
        g = mix64((g + x.words[at + o]) * _K[1])
    order = np.lexsort((d, g, h))
    h, g, d, at, doc, start = (c[order] for c in (h, g, d, at, doc, start))
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
    leader = np.flatnonzero(new)[np.cumsum(new) - 1]
    gone = d > d[leader]
    for o in _WORDS_WITHIN:
        gone &= x.words[at + o] == x.words[at[leader] + o]
    k, a = keys[doc], start.astype("<u4")
    rows = [(int(keys[0] % n), SETTLED, _dump(d=d[gone], k=k[gone], a=a[gone], b=a[gone] + np.uint32(MATCH)))] if gone.any() else []
    stay = np.flatnonzero(~gone)
    for b, i in _by((h[stay] % np.uint64(n)).astype(np.int64), n):
        j = stay[i]
        rows.append((b, STRINGS, _dump(h=h[j], g=g[j], d=d[j], k=k[j], a=a[j])))
    return rows


def _repeated_strings(blobs: list[bytes]) -> bytes:
    """What the strings of a bucket settle: those that a smaller id has too."""
    h, g, d, k, a = _loaded(blobs, STRING)
    order = np.lexsort((d, g, h))
    h, g, d, k, a = (c[order] for c in (h, g, d, k, a))
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
    gone = d > d[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return _dump(d=d[gone], k=k[gone], a=a[gone], b=a[gone] + np.uint32(MATCH))


def _send(ids: np.ndarray, texts: list[bytes], n: int, hot: np.ndarray) -> pa.RecordBatch:
    """A chunk's anchors by bucket, one of equal ones (the least id's), and what that settles."""
    x = Layout(texts)
    keys = np.fromiter(map(zlib.crc32, texts), dtype=np.uint32, count=len(texts))
    doc, place, h = anchors(x)
    rows: list[tuple[int, int, bytes]] = []
    if len(hot) and (often := np.isin(h, hot)).any():
        rows += _strings(x, ids, keys, doc[often], place[often], n)
        doc, place, h = doc[~often], place[~often], h[~often]
    whole, left, right = _around(x, doc, place)
    d = ids[doc]
    same = mix64(h) ^ whole
    order = np.lexsort((d, same))
    first = np.concatenate([[True], same[order][1:] != same[order][:-1]]) if len(order) else np.zeros(0, bool)
    leader = order[first][np.cumsum(first) - 1] if len(order) else order
    more = d[order] > d[leader]
    order, leader = order[more], leader[more]
    settled = np.sort(order[_same(x, doc, place, order, leader)])
    go = np.ones(len(d), dtype=bool)
    go[settled] = False
    if len(settled):
        a, b = _interval(place[settled], x.lengths[doc[settled]])
        rows.append((int(zlib.crc32(texts[0]) % n), SETTLED, _dump(d=d[settled], k=keys[doc[settled]], a=a.astype("<u4"), b=b.astype("<u4"))))
    at = np.flatnonzero(go)
    for b, i in _by(((h[at] >> np.uint64(33)) % np.uint64(n)).astype(np.int64), n):
        j = at[i]
        rows.append((b, ANCHORS, _dump(h=h[j].astype("<u4"), w=whole[j], l=left[j], r=right[j], d=d[j], k=keys[doc[j]], lo=(place[j] & 0xFFFF).astype("<u2"), hi=(place[j] >> 16).astype("<u2"))))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "kind", "payload"])


def _answer(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "kind": pa.array([r[1] for r in rows], pa.int32()), "payload": pa.array([r[2] for r in rows], pa.binary())})


def _bucket(t: pa.Table, n: int) -> pa.Table:
    """Within a bucket of q-grams: anchors whose surroundings may be, by their hashes, equal or partly equal to those in
    another document are open. What tasks have settled is passed on."""
    kinds, blobs = t.column("kind").to_pylist(), t.column("payload").to_pylist()
    h, w, left, right, d, k, lo, hi = _loaded([b for b, x in zip(blobs, kinds) if x == ANCHORS], ENTRY)
    place = lo.astype(np.int64) | hi.astype(np.int64) << 16
    order = np.lexsort((d, left.astype(np.uint32) << np.uint32(16) | right, w, h))
    h, w, left, right, d, k, place = (c[order] for c in (h, w, left, right, d, k, place))
    fresh = lambda *cs: np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in cs])]) if len(cs[0]) else np.zeros(0, bool)
    new = fresh(h, w, left, right)
    group = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    least = d[at][group] if len(d) else d
    several = np.zeros(len(at), dtype=bool)
    several[group[d > least]] = True
    # of each kind of surroundings one row: does another kind share the q-gram and a half?
    shares = np.zeros(len(at), dtype=bool)
    for half in (left, right):
        _, inverse, count = np.unique(h[at].astype(np.uint64) << np.uint64(16) | half[at].astype(np.uint64), return_inverse=True, return_counts=True)
        shares |= (count[inverse] > 1) & (half[at] > 0)
    open_ = (several | shares)[group] if len(group) else np.zeros(0, bool)
    rows = [(0, SETTLED, b) for b, x in zip(blobs, kinds) if x == SETTLED]
    if strings := [b for b, x in zip(blobs, kinds) if x == STRINGS]:
        rows.append((0, SETTLED, _repeated_strings(strings)))
    sd, sk, sa, sb = _loaded([b for *_, b in rows], FOUND)
    out = [(p, SETTLED, _dump(d=sd[i], k=sk[i], a=sa[i], b=sb[i])) for p, i in _by(_parts(sd, n), n)]
    od, ok, op = d[open_], k[open_], place[open_].astype("<u4")
    out += [(p, OPEN, _dump(d=od[i], k=ok[i], a=op[i], b=op[i])) for p, i in _by(_parts(od, n), n)]
    return _answer(out)


def _named(t: pa.Table) -> tuple[list[bytes], np.ndarray, dict[tuple[int, int], list[int]]]:
    """Texts and ids of a group of documents, and the rows of each (id, crc of the text)."""
    texts = [x or b"" for x in t.column("text").cast(pa.binary()).to_pylist()]
    ids = np.array([NULL_ID if x is None else x for x in t.column("doc_id").to_pylist()], dtype=np.int64)
    rows: dict[tuple[int, int], list[int]] = {}
    for i, (d, x) in enumerate(zip(ids.tolist(), texts)):
        rows.setdefault((d, zlib.crc32(x)), []).append(i)
    return texts, ids, rows


def _copies(pieces: list[bytes], ids: np.ndarray) -> np.ndarray:
    """Whether a piece's bytes are also those of a piece with a smaller id."""
    number: dict[bytes, int] = {}
    of = np.fromiter((number.setdefault(x, len(number)) for x in pieces), dtype=np.int64, count=len(pieces))
    least = np.full(len(number), NULL_ID, dtype=np.int64)
    np.minimum.at(least, of, ids)
    return ids > least[of] if len(pieces) else np.zeros(0, bool)


def _surroundings(docs: pa.Table, found: pa.Table, n: int) -> pa.Table:
    """The bytes around the open anchors, by the bucket of their q-gram; copies within the group of documents are settled."""
    d, k, place, _ = _loaded([b for b, x in zip(found.column("payload").to_pylist(), found.column("kind").to_pylist()) if x == OPEN], FOUND)
    if not len(d) or not docs.num_rows:
        return _answer([])
    texts, _, rows = _named(docs)
    pieces = []
    for i, (doc, key, p) in enumerate(zip(d.tolist(), k.tolist(), place.tolist())):
        t = texts[rows[doc, key][0]]
        pieces.append(t[max(0, p - SPREAD) : p + MATCH])
    size = np.fromiter(map(len, pieces), dtype=np.uint32, count=len(pieces))
    start = np.maximum(place.astype(np.int64) - SPREAD, 0).astype("<u4")
    gone = _copies(pieces, d)
    out = []
    if gone.any():
        out.append((int(k[0] % (FINER * n)), SETTLED, _dump(d=d[gone], k=k[gone], a=start[gone], b=start[gone] + size[gone])))
        pieces = [x for x, g in zip(pieces, gone.tolist()) if not g]
        d, k, place, size, start = (c[~gone] for c in (d, k, place, size, start))
    grams = Layout([x[min(p, SPREAD) : min(p, SPREAD) + Q] for x, p in zip(pieces, place.tolist())])
    hashes = _gram_hash(grams.words, grams.starts)
    for b, i in _by(((hashes >> np.uint64(33)) % np.uint64(FINER * n)).astype(np.int64), FINER * n):
        head = _dump(d=d[i], k=k[i], a=start[i], b=size[i])
        body = zstd.ZstdCompressor(level=1).compress(b"".join(pieces[j] for j in i.tolist()))
        out.append((b, len(head), head + body))
    return _answer(out)


def refined_buckets(buffer: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, bucket pointers) of all MATCH-byte suffixes that begin in the pieces: equal pointers, equal strings."""
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))

    def places(depth: int) -> np.ndarray:
        count = np.maximum(size - depth + 1, 0)
        return np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())

    pointer = np.full(len(padded), -1, dtype=np.int32)
    at = places(8)
    pointer[at] = np.unique(words[at], return_inverse=True)[1]
    for depth, offset in ((16, 8), (32, 16), (MATCH, MATCH - 32)):
        at = places(depth)
        here = pointer[at]
        several = np.bincount(here, minlength=1)[here] > 1 if len(here) else np.zeros(0, bool)
        # a bucket of one suffix needs no refinement; the others get new pointers, behind all old ones
        top = int(pointer.max()) + 1
        now = np.full(len(padded), -1, dtype=np.int32)
        now[at] = here
        work = at[several]
        now[work] = top + np.unique(pointer[work].astype(np.int64) * top + pointer[work + offset], return_inverse=True)[1]
        pointer = now
    return at, pointer[at]


def _refine(t: pa.Table, n: int) -> pa.Table:
    """Within a bucket of q-grams: the runs of MATCH-byte strings that also begin in a smaller document."""
    heads, bodies, rows = [], [], []
    for size, blob in zip(t.column("kind").to_pylist(), t.column("payload").to_pylist()):
        if size == SETTLED:
            rows.append(_load(blob, FOUND))
            continue
        heads.append(blob[:size])
        bodies.append(zstd.ZstdDecompressor().decompress(blob[size:]))
    d, k, first, size = _loaded(heads, FOUND)
    joined = b"".join(bodies)
    start = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    pieces = [joined[i:j] for i, j in zip(start[:-1].tolist(), start[1:].tolist())]
    gone = _copies(pieces, d)
    rows.append([d[gone], k[gone], first[gone], first[gone] + size[gone]])
    if len(d) and not gone.all():
        rows.append(_runs(b"".join(x for x, g in zip(pieces, gone.tolist()) if not g), d[~gone], k[~gone], first[~gone], size[~gone].astype(np.int64)))
    d, k, a, b = (np.concatenate(c) for c in zip(*rows))
    return _answer([(q, SETTLED, _dump(d=d[i], k=k[i], a=a[i], b=b[i])) for q, i in _by(_parts(d, n), n)])


def _runs(joined: bytes, d: np.ndarray, k: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """(id, crc, from, to) of the runs of the pieces' MATCH-byte strings that also begin in a piece with a smaller id."""
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    at, pointer = refined_buckets(np.frombuffer(joined, dtype=np.uint8), start, size)
    none = np.zeros(0, dtype=np.int64)
    piece = np.searchsorted(start, at, side="right") - 1
    ids = d[piece]
    _, pointer = np.unique(pointer, return_inverse=True)
    least = np.full(len(at), NULL_ID, dtype=np.int64)
    np.minimum.at(least, pointer, ids)
    hit = ids > least[pointer]
    at, piece = at[hit], piece[hit]
    if not len(at):
        return [c.astype(x) for c, x in zip((none,) * 4, FOUND)]
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (piece[1:] != piece[:-1])])
    last = np.concatenate([new[1:], [True]])
    p = piece[new]
    a = first[p] + (at[new] - start[p])
    b = first[p] + (at[last] - start[p]) + MATCH
    return [d[p], k[p], a.astype("<u4"), b.astype("<u4")]


def _cut(docs: pa.Table, found: pa.Table) -> pa.Table:
    """The rows of docs with what is left of their texts."""
    d, k, a, b = _loaded([x for x, kind in zip(found.column("payload").to_pylist(), found.column("kind").to_pylist()) if kind == SETTLED], FOUND)
    texts, _, rows = _named(docs)
    removed, spans, kept, digest = [0] * len(texts), [0] * len(texts), list(texts), [""] * len(texts)
    order = np.lexsort((k, d))
    d, k, a, b = d[order], k[order], a[order], b[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])])) if len(d) else np.zeros(0, int)
    for i, j in zip(new.tolist(), [*new[1:].tolist(), len(d)]):
        for row in rows.get((int(d[i]), int(k[i])), ()):
            t = np.frombuffer(texts[row], dtype=np.uint8)
            edge = np.zeros(len(t) + 1, dtype=np.int32)
            np.add.at(edge, a[i:j], 1)
            np.add.at(edge, np.minimum(b[i:j], len(t)), -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed[row] = int(gone.sum())
            spans[row] = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept[row] = t[~gone].tobytes()
    digest = [hashlib.sha256(x).hexdigest() for x in kept]
    out = docs.drop_columns(["_part"])
    for name, values in (("_n_bytes", pa.array(map(len, texts), pa.int64())), ("_n_removed", pa.array(removed, pa.int64())), ("_n_spans", pa.array(spans, pa.int64())), ("_kept", pa.array(kept, pa.binary())), ("_sha256", pa.array(digest))):
        out = out.append_column(name, values)
    return out


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(ids, texts) of about CHUNK_BYTES each."""
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0
    for b in batches:
        for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
            ids.append(NULL_ID if d is None else d)
            texts.append(t or b"")
            size += len(texts[-1])
            if size >= CHUNK_BYTES or len(texts) >= CHUNK_DOCS:
                yield np.array(ids, dtype=np.int64), texts
                ids, texts, size = [], [], 0
    if texts:
        yield np.array(ids, dtype=np.int64), texts


def hot_grams(named: DataFrame) -> np.ndarray:
    """Hashes of the q-grams that have HOT_ANCHORS anchors or more, as estimated from one in HOT_ONE_IN documents. Which
    they are decides only the way they go; there are at most as many as all anchors make groups of HOT_ANCHORS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunked(batches):
            h, n = np.unique(anchors(Layout(texts))[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    some = named.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(HOT_ONE_IN)) == 0)
    many = some.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_ANCHORS / HOT_ONE_IN)
    return np.array(sorted(r["h"] for r in many.select("h").collect()), dtype=np.int64).view(np.uint64)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, with _n_bytes, _n_removed, _n_spans (maximal removed runs), _kept (the bytes left)
    and _sha256 of these.

    A null text is empty. A null id counts as larger than all others, and equal ids as no smaller than each other, so
    rows that repeat an id lose nothing to one another. Texts under MATCH bytes lose nothing. No rows give none."""
    columns = docs.columns
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(n_shuffle(docs.sparkSession), -(-total // PART_BYTES))

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hot = hot_grams(named)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunked(batches):
            yield _send(ids, texts, n, hot)

    found = written(named.mapInArrow(send, SENT).groupBy("bucket").applyInArrow(lambda t: _bucket(t, n), ANSWER), "repeats")
    # the documents by group, dealt once and read twice
    dealt = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("_part", part_of(F.col("doc_id"), n))
    texts = dealt.select("doc_id", "text", "_part")
    open_ = found.where(F.col("kind") == OPEN)
    around = texts.groupBy("_part").cogroup(open_.groupBy("part")).applyInArrow(lambda a, b: _surroundings(a, b, n), ANSWER)
    refined = around.groupBy("part").applyInArrow(lambda t: _refine(t, n), ANSWER)
    settled = found.where(F.col("kind") == SETTLED).unionByName(refined)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.select(*columns).schema.fields)
    schema = fields + ", _n_bytes long, _n_removed long, _n_spans long, _kept binary, _sha256 string"
    return dealt.groupBy("_part").cogroup(settled.groupBy("part")).applyInArrow(_cut, schema)


def digests(docs: DataFrame) -> DataFrame:
    found = without_repeats(docs.select("doc_id", "text"))
    return found.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.col("_sha256").alias("kept_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, with the repeats cut out of their texts; bytes of a character cut in two go too.
    Rows of which nothing is left go, but those that were empty before stay."""
    found = without_repeats(docs)
    text = F.when(F.col("_n_removed") == 0, F.col("text")).otherwise(_text(F.col("_kept")))
    out = found.where("_n_removed < _n_bytes or _n_bytes = 0").withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _text(kept: Column) -> Column:
    """Bytes as UTF-8, without those that are no character."""
    return F.replace(F.make_valid_utf8(kept.cast("string")), F.lit("�"), F.lit(""))
