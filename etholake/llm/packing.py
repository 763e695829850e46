"""Operator 10: hierarchical packing of tokenised documents into sequences of several context sizes.

Full windows are cut off long documents; what is left, and the shorter documents, are routed to tiers by length.
Each tier's windows are opened by its own documents, longest first; gaps are filled with whole documents of shorter
tiers, best fit first, and the last gap with a cut piece, so that windows come out full. Sequences of one size form
step groups with the same number of tokens each.

Each task packs the documents of its own input split, so nothing is shuffled; a split's end leaves one short
sequence at most.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

TIERS = (2048, 1024, 512, 256)
#: Cuts at a split's very end go down to this size; what is still shorter is padded, once a split.
LEAST = 64
END_ID = 1
STEP_TOKENS = 8 * TIERS[0]
#: Tokens that are packed at a time.
GROUP_TOKENS = 1 << 20
#: Characters for which both tokenizer libraries surely split alike: ASCII but for odd controls, and Latin letters.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step_id long"


class Ids:
    """Token ids of whole texts, as the tokenizers library gives them without special tokens, then END_ID.

    Where a text has plain characters only, the same vocabulary is applied by tiktoken, which is five times as fast
    and gives the same ids; any other text goes to tokenizers itself."""

    def __init__(self, json_path: str, ranks_path: str | None = None) -> None:
        self.paths = (json_path, ranks_path)

    def __getstate__(self) -> dict:
        return {"paths": self.paths}

    def _exact(self):
        if not hasattr(self, "_t"):
            from tokenizers import Tokenizer

            self._t = Tokenizer.from_file(self.paths[0])
        return self._t

    def _quick(self):
        if not hasattr(self, "_q"):
            import public_tokenizers
            import tiktoken

            with open(self.paths[1], "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self._q = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return self._q

    def exact(self, text: str) -> np.ndarray:
        return np.array(self._exact().encode(text, add_special_tokens=False).ids, dtype="<u4")

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.paths[1] and "<|" not in text and _PLAIN.fullmatch(text):
            ids = np.array(self._quick().encode_ordinary(text), dtype="<u4")
        else:
            ids = self.exact(text)
        return np.append(ids, np.uint32(END_ID)).astype("<u4")


def default_ids() -> Ids:
    import public_tokenizers

    return Ids(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


class Pool:
    """Pieces (key, start, length) by length."""

    def __init__(self) -> None:
        self.by: dict[int, list[tuple[int, int]]] = {}
        self.lengths: list[int] = []
        self.total = 0

    def add(self, key: int, start: int, length: int) -> None:
        if length:
            if not self.by.setdefault(length, []):
                insort(self.lengths, length)
            self.by[length].append((key, start))
            self.total += length

    def take(self, at_most: int) -> tuple[int, int, int] | None:
        """The longest piece of at most so many tokens."""
        i = bisect_right(self.lengths, at_most)
        if not i:
            return None
        length = self.lengths[i - 1]
        key, start = self.by[length].pop()
        if not self.by[length]:
            del self.lengths[i - 1]
        self.total -= length
        return key, start, length


def fill(pool: Pool, size: int, pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fill a window up to its size: whole pieces, best fit first, then one that is cut."""
    gap = size - sum(p[2] for p in pieces)
    while gap and pool.total:
        p = pool.take(gap)
        if p is None:
            key, start, length = pool.take(1 << 62)
            pool.add(key, start + gap, length - gap)
            p = (key, start, gap)
        pieces.append(p)
        gap -= p[2]
    return pieces


def pack(pool: Pool, last: bool) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """(size, pieces) of full windows, tier by tier from the longest; what fills no window stays in the pool, unless
    these are the last: then it goes to ever shorter powers of two."""
    for size, least in zip(TIERS, (*TIERS[1:], 0)):
        while pool.total >= size and pool.lengths[-1] > least:
            first = pool.take(size)
            if first is None:
                key, start, length = pool.take(1 << 62)
                pool.add(key, start + size, length - size)
                first = (key, start, size)
            yield size, fill(pool, size, [first])
    if last:
        size = TIERS[0]
        while size >= LEAST:
            while pool.total >= size:
                yield size, fill(pool, size, [])
            size //= 2
        if pool.total:
            yield TIERS[0], fill(pool, TIERS[0], [])


def pack_documents(docs: DataFrame, ids: Ids | None = None) -> DataFrame:
    """One row per piece: doc_id, then SCHEMA. The ids of a row's text lie in exactly one piece each; a null or empty
    text is its end id alone; repeated rows are packed each; other columns are not read."""
    ids = ids or default_ids()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        pool, held, doc_ids = Pool(), {}, {}
        left: dict[int, int] = {}
        key = n_seq = 0
        steps, n_step = {t: (0, 0) for t in (2048 >> i for i in range(12))}, 0

        def emit(last: bool) -> pa.RecordBatch | None:
            nonlocal n_seq, n_step
            rows = []
            for size, pieces in pack(pool, last):
                step, have = steps[size]
                if have == 0:
                    step, n_step = n_step, n_step + 1
                steps[size] = (step, (have + size) % STEP_TOKENS)
                offset = 0
                for k, start, length in pieces:
                    part = held[k][start : start + length]
                    rows.append((doc_ids[k], start, length, zlib.crc32(part.tobytes()), len(held[k]), base + n_seq, offset, size, base + step))
                    offset += length
                    left[k] -= length
                    if not left[k]:
                        del left[k], held[k], doc_ids[k]
                n_seq += 1
            if not rows:
                return None
            columns = [pa.array(v, type=None if i else kind) for i, v in enumerate(zip(*rows))]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", *(c.split()[0] for c in SCHEMA.split(", "))])

        for b in batches:
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                x = ids(t)
                held[key], doc_ids[key], left[key] = x, d, len(x)
                whole = len(x) // TIERS[0] * TIERS[0]
                for start in range(0, whole, TIERS[0]):
                    pool.add(key, start, TIERS[0])
                pool.add(key, whole, len(x) - whole)
                key += 1
                if pool.total >= GROUP_TOKENS and (out := emit(False)) is not None:
                    yield out
        if (out := emit(True)) is not None:
            yield out

    spark_kind = docs.schema["doc_id"].dataType
    kind = to_arrow_type(spark_kind)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {spark_kind.simpleString()}, {SCHEMA}")
