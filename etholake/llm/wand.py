"""Operator 12: ranked lexical search by Block-Max WAND.

The index is dealt by documents: each task reads its own splits, gathers shards of SHARD_CHARS characters and writes, for
every term of a shard, its postings in blocks of BLOCK documents. A block is compressed (differences of document numbers and
term frequencies in the fewest whole bytes) and stores its last document and its largest impact uncompressed. Nothing is
shuffled to build it, and every row with a term is in it.

A search joins the queries' terms with the index, so only their postings move, and works shard by shard, at most BATCH queries
at a time. The ends of all lists' blocks cut the shard's documents into intervals; in each, every list's shallow pointer
stands on one block, and the sum of these blocks' largest impacts bounds any score there. Intervals bounded below the
threshold (the k-th best score so far) are skipped before anything is decompressed. In the others the documents whose own lists'
bounds reach the threshold are scored, and raise it. The shards' best are merged, each task keeping k for a query.

Scores are whole numbers: weight * ((10^9 * tf) div (1000 * tf + 20 * m)), with m from the document's length.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import chunks, written

#: A term: a run of ASCII letters and digits and of all that is not ASCII. Valid in Java, Python and RE2 patterns.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same over UTF-8: bytes of terms, A-Z lower-cased, and spaces for all else.
_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()
_MARKS = bytes(32 if b == 32 else 97 for b in _BYTES)
BLOCK = 128
SHARD_CHARS = 1 << 25
BATCH = 256
#: Documents that a search decompresses at a time, at least one interval.
STEP = 2048
INDEX = "shard long, term string, df long, lasts binary, impacts binary, widths binary, deltas binary, tfs binary, ids array<bigint>, norms array<bigint>"
_FIELDS = tuple(f.split()[0] for f in INDEX.split(", "))


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit(TERM), F.lit(0))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_BYTES).split()


def totals(docs: DataFrame) -> tuple[int, int]:
    """N, the documents with a term, and L, all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # a term begins where a byte of one follows a space
            n = [(b" " + (t or "").encode().translate(_MARKS)).count(b" a") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"n": [sum(x > 0 for x in n)], "l": [sum(n)]})

    found = docs.select("text").mapInArrow(run, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return found["n"] or 0, found["l"] or 0


def _impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * norm)


def _bytes_of(values: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The low `width` bytes of each value, one value after the other."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < width[:, None]]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of a byte array as Arrow binaries."""
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def _compressed(shard: int, names: list[str], term: np.ndarray, doc: np.ndarray, ids: list, lengths: np.ndarray, n_docs: int, n_terms: int) -> pa.RecordBatch:
    """A shard's rows: one for each term, and one without a term that holds its documents. term and doc: of each occurrence."""
    key, tf = np.unique(term.astype(np.int64) << 32 | doc, return_counts=True)
    term, doc = key >> 32, key & 0xFFFFFFFF
    norms = 50 + (50 * lengths * n_docs) // n_terms
    df = np.bincount(term, minlength=len(names))
    at = np.cumsum(df) - df
    within = np.arange(len(term)) - at[term]
    start = np.flatnonzero(within % BLOCK == 0)
    of_block = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(term))))
    last = doc[np.append(start[1:], len(term)) - 1]
    delta = np.where(within == 0, doc + 1, doc - np.append(-1, doc[:-1]))
    largest = np.maximum.reduceat(_impact(tf, norms[doc]), start)
    width = lambda x: np.select([x < 1 << 8, x < 1 << 16], [1, 2], 4)
    wide_d, wide_t = (width(np.maximum.reduceat(x, start)) for x in (delta, tf))
    upto = np.cumsum(-(-df // BLOCK))  # blocks up to each term
    ends = lambda w: np.cumsum(np.diff(np.append(start, len(term))) * w)[upto - 1]
    columns = [
        pa.array(names, pa.string()), pa.array(df, pa.int64()),
        _binary(last.astype("<u4").view(np.uint8), 4 * upto), _binary(largest.astype("<u4").view(np.uint8), 4 * upto), _binary((wide_d | wide_t << 4).astype(np.uint8), upto),
        _binary(_bytes_of(delta, wide_d[of_block]), ends(wide_d)), _binary(_bytes_of(tf, wide_t[of_block]), ends(wide_t)),
    ]
    own = [[None], [None], [None], [None], [None], [None], [None]]
    columns = [pa.concat_arrays([c, pa.array(o, c.type)]) for c, o in zip(columns, own)]
    n = len(names)
    none = pa.array([None] * n, pa.list_(pa.int64()))
    columns += [pa.concat_arrays([none, pa.array([list(x)], pa.list_(pa.int64()))]) for x in (ids, norms.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n + 1, shard), pa.int64()), *columns], list(_FIELDS))


def index(docs: DataFrame, n_docs: int, n_terms: int, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """INDEX of all rows of docs with a term; n_docs and n_terms are totals(). Null texts have none; repeated rows are rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base, n_shard = (context.partitionId() if context else 0) << 32, 0
        number: dict[bytes, int] = {}
        held, ids, lengths, chars = [], [], [], 0

        def emit() -> pa.RecordBatch:
            n = np.array(lengths, dtype=np.int64)
            return _compressed(base + n_shard, [w.decode() for w in number], np.concatenate(held), np.repeat(np.arange(len(n)), n), ids, n, n_docs, n_terms)

        for b in batches:
            doc_ids = b.column("doc_id").to_pylist()
            for start, texts in chunks(b.column("text").to_pylist()):
                for d, t in zip(doc_ids[start : start + len(texts)], texts):
                    found = terms_of(t)
                    if found:
                        held.append(np.fromiter((number.setdefault(w, len(number)) for w in found), dtype=np.int32, count=len(found)))
                        ids.append(d)
                        lengths.append(len(found))
                        chars += len(t)
                    if chars >= shard_chars:
                        yield emit()
                        number, held, ids, lengths, chars, n_shard = {}, [], [], [], 0, n_shard + 1
        if ids:
            yield emit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


class Postings:
    """One term's list in a shard: uncompressed maxima, blocks decompressed when first needed."""

    def __init__(self, weight: int, lasts: bytes, impacts: bytes, widths: bytes, deltas: bytes, tfs: bytes, df: int) -> None:
        self.lasts = np.frombuffer(lasts, dtype="<u4").astype(np.int64)
        self.bounds = np.append(weight * np.frombuffer(impacts, dtype="<u4").astype(np.int64), 0)
        self.weight, self.df, self.data = weight, df, (deltas, tfs)
        wide = np.frombuffer(widths, dtype=np.uint8)
        n = np.full(len(wide), BLOCK)
        n[-1] = df - BLOCK * (len(wide) - 1)
        self.wide = (wide & 15, wide >> 4)
        self.at = tuple(np.append(0, np.cumsum(n * w)) for w in self.wide)
        self.docs: dict[int, np.ndarray] = {}
        self.freqs: dict[int, np.ndarray] = {}

    def _read(self, which: int, j: int) -> np.ndarray:
        a, b = self.at[which][j : j + 2]
        return np.frombuffer(self.data[which][a:b], dtype=f"<u{self.wide[which][j]}").astype(np.int64)

    def docs_of(self, j: int) -> np.ndarray:
        if j not in self.docs:
            self.docs[j] = (self.lasts[j - 1] if j else -1) + np.cumsum(self._read(0, j))
        return self.docs[j]

    def freqs_of(self, j: int) -> np.ndarray:
        if j not in self.freqs:
            self.freqs[j] = self._read(1, j)
        return self.freqs[j]


def best(lists: list[Postings], norms: np.ndarray, order: np.ndarray, k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers) and scores of the k best with a score above 0; ties by `order` (each document's id)."""
    found, scores, threshold = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 1
    ends = np.unique(np.concatenate([p.lasts for p in lists])) + 1
    block = [np.searchsorted(p.lasts, ends - 1) for p in lists]  # the shallow pointers
    bound = sum(p.bounds[j] for p, j in zip(lists, block))
    starts = np.append(0, ends[:-1])
    i = 0
    while i < len(ends):
        live = i + np.flatnonzero(bound[i:] >= threshold)
        if not len(live):
            break
        live = live[: max(1, np.searchsorted(ends[live], starts[live[0]] + step, "right"))]
        i = live[-1] + 1
        low, high = starts[live[0]], ends[live[-1]]
        inside = np.zeros(high - low + 1, dtype=np.int64)
        np.add.at(inside, starts[live] - low, 1)
        np.add.at(inside, ends[live] - low, -1)
        inside = np.cumsum(inside[:-1]) > 0
        reach = np.zeros(high - low, dtype=np.int64)
        parts = []
        for p, at in zip(lists, block):
            for j in np.unique(at[live]):
                if j < len(p.lasts):
                    docs = p.docs_of(j)
                    a, b = np.searchsorted(docs, (low, high))
                    reach[docs[a:b] - low] += p.bounds[j]
                    parts.append((p, j, a, docs[a:b]))
        wanted = inside & (reach >= threshold)
        if not wanted.any():
            continue
        total = np.zeros(high - low, dtype=np.int64)
        for p, j, a, docs in parts:
            mine = np.flatnonzero(wanted[docs - low])
            if len(mine):
                docs = docs[mine]
                total[docs - low] += p.weight * _impact(p.freqs_of(j)[a + mine], norms[docs])
        new = np.flatnonzero(wanted & (total >= threshold))
        found, scores = np.append(found, new + low), np.append(scores, total[new])
        keep = np.lexsort((order[found], -scores))[:k]
        found, scores = found[keep], scores[keep]
        if len(found) == k:
            threshold = scores[-1]
    return found, scores


def search(indexed: DataFrame, queries: DataFrame, n_docs: int, k: int = 50, batch: int = BATCH) -> DataFrame:
    """queries has key columns and `text`; for every row, its k best documents of the index: the keys, rank (from 1), doc_id, score.

    Equal scores rank by doc_id, null first. A text without terms that the index holds has no rows; repeated rows are
    searched each."""
    keys = [c for c in queries.columns if c != "text"]
    asked = written(queries.withColumn("_q", F.monotonically_increasing_id()).withColumn("_terms", F.array_distinct(terms(F.col("text")))).drop("text"), "wand-queries")
    pairs = asked.select("_q", F.expr(f"_q div {batch}").alias("_batch"), F.explode("_terms").alias("term"))
    held = indexed.where("term IS NOT NULL")
    df = held.select("term", "df").join(pairs.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("_df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("_df") + 1))).cast("long")
    wanted = pairs.join(df, "term").groupBy("_batch", "term").agg(F.collect_list("_q").alias("qs"), F.first(weight).alias("weight")).where("weight > 0")
    # written, so that Spark knows its size and broadcasts it if it is small
    wanted = written(wanted, "wand-terms")
    lists = held.drop("ids", "norms").join(wanted, "term")
    shards = indexed.where("term IS NULL").select("shard", "ids", "norms").join(lists.select("shard", "_batch").distinct(), "shard").select(F.col("shard").alias("_shard"), F.col("_batch").alias("_part"), "ids", "norms")
    kind = "_q long, doc_id long, score long"

    def run(rows: pa.Table, shard: pa.Table) -> pa.Table:
        ids = shard.column("ids").combine_chunks().flatten() if shard.num_rows else pa.array([], pa.int64())
        norms = np.array(shard.column("norms").combine_chunks().flatten(), dtype=np.int64)
        order = np.array(ids.fill_null(np.iinfo(np.int64).min), dtype=np.int64)
        of: dict[int, list[Postings]] = {}
        for r in rows.select(["weight", "lasts", "impacts", "widths", "deltas", "tfs", "df", "qs"]).to_pylist():
            qs = r.pop("qs")
            p = Postings(**r)
            for q in qs:
                of.setdefault(q, []).append(p)
        out: list[tuple[int, np.ndarray, np.ndarray]] = [(q, *best(ps, norms, order, k)) for q, ps in of.items()]
        found = np.concatenate([d for _, d, _ in out]) if out else np.zeros(0, dtype=np.int64)
        q = np.repeat([q for q, _, _ in out], [len(d) for _, d, _ in out]) if out else found
        score = np.concatenate([s for _, _, s in out]) if out else found
        return pa.table({"_q": pa.array(q, pa.int64()), "doc_id": ids.take(pa.array(found, pa.int64())), "score": pa.array(score, pa.int64())})

    hits = lists.groupBy("shard", "_batch").cogroup(shards.groupBy("_shard", "_part")).applyInArrow(run, kind)
    place = F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("score"), F.asc("doc_id"))).cast("int")
    top = hits.withColumn("rank", place).where(F.col("rank") <= k)
    return top.join(asked.select("_q", *keys), "_q").select(*keys, "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 50, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents for each row of items (item_id, text); other columns are not read."""
    n_docs, n_terms = totals(docs)
    indexed = written(index(docs, n_docs, max(n_terms, 1), shard_chars), "wand-index")
    return search(indexed, items.select("item_id", "text"), n_docs, k)


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{TERM}') AS ts FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{TERM}')) AS term FROM benchmark),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
o AS (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM o WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, n_docs),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""
