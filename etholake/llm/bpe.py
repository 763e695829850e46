"""Operator 11: byte-level BPE encoding and decoding by batched numpy merge rounds.

A batch's distinct words lie one after the other in one flat array of symbols. Each round finds the rank of every pair
that is new by binary search over the sorted keys of the mergeable pairs, takes the lowest rank of each word and merges
all its occurrences at once; words without a mergeable pair leave the array. Very long words (a page of one letter)
go rank by rank instead, touching only the neighbours of what was merged, so that their cost stays near linear.

Merging all pairs of the lowest rank at once equals merging one after the other only if a merge never makes a pair of
lower rank; that holds when each merge makes a symbol of its own and takes older symbols, which is checked on loading.

Nothing is shuffled; a task keeps the words that it has met, up to KEPT_IDS ids, and then begins anew.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from ._common import chunks

#: Words of more symbols go rank by rank.
LONG = 256
#: Ids of distinct words that a task keeps.
KEPT_IDS = 1 << 22
NONE = np.int64(1 << 40)
#: The pattern of byte-level BPE that splits a text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = regex.compile(SPLIT)
#: Characters that every edition of Unicode sorts alike into letters, digits, spaces and others; a text with any other
#: character is split by the tokenizers library itself.
_PLAIN = regex.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable in Latin-1, else the
    next free one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class Vocabulary:
    """Byte-level BPE from a tokenizers file, as sorted arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"] or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        self.path = path
        chars = byte_characters()
        value = {c: b for b, c in enumerate(chars)}
        self.byte_ids = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.special = {}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError("added tokens that take spaces or whole words are not covered")
            self.special[t["content"]] = t["id"]
        n = max([*vocab.values(), *self.special.values()]) + 1
        tokens = [b""] * n
        for t, i in vocab.items():
            tokens[i] = bytes(map(value.__getitem__, t))
        for t, i in self.special.items():
            tokens[i] = t.encode()
        self.known = np.zeros(n, dtype=bool)
        self.known[[*vocab.values(), *self.special.values()]] = True
        self.sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=n)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        age = np.full(n, -1, dtype=np.int64)
        age[made] = np.arange(len(made))
        if len(np.unique(made)) < len(made) or (np.maximum(age[left], age[right]) >= np.arange(len(made))).any() or (age[self.byte_ids] >= 0).any():
            raise ValueError("merges whose symbols are not made once, in order")
        key = left << 32 | right
        self.by_rank = key
        order = np.argsort(key)
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs by binary search; NONE where a pair does not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def _alternate(chosen: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of runs of overlapping pairs (aaa) every second one, from the left."""
    at = np.arange(len(chosen))
    first = np.maximum.accumulate(np.where(follows, 0, at))
    return chosen[(at - first) % 2 == 0]


def merge_rounds(v: Vocabulary, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and sizes of words (none empty), flat, after all their merges."""
    word = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.append(word[1:] != word[:-1], True) if len(word) else np.zeros(0, dtype=bool)
    rank = np.full(len(symbols), NONE)
    inner = np.flatnonzero(~ends)
    rank[inner] = v.rank(symbols[inner], symbols[inner + 1])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        low = np.minimum.reduceat(rank, starts)
        lens = np.diff(np.append(starts, len(symbols)))
        active = np.repeat(low < NONE, lens)
        done.append((word[~active], symbols[~active]))
        low = np.repeat(low, lens)[active]
        word, symbols, rank = word[active], symbols[active], rank[active]
        chosen = np.flatnonzero(rank == low)
        if not len(chosen):
            break
        chosen = _alternate(chosen, np.append(False, chosen[1:] == chosen[:-1] + 1))
        symbols[chosen] = v.made[rank[chosen]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[chosen + 1] = False
        place = np.cumsum(keep) - 1
        new = place[chosen]
        word, symbols, rank = word[keep], symbols[keep], rank[keep]
        rank[new] = NONE
        stale = np.unique(np.concatenate([new, new[new > 0] - 1]))
        stale = stale[stale < len(word) - 1]
        stale = stale[word[stale] == word[stale + 1]]
        rank[stale] = v.rank(symbols[stale], symbols[stale + 1])
    words, out = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, dtype=np.int64),) * 2
    return out[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(sizes))


def merge_long(v: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """One word's symbols after all merges, rank by rank over linked positions."""
    n = len(symbols)
    symbols, after, before = symbols.copy(), np.append(np.arange(1, n), -1), np.arange(-1, n - 1)
    alive = np.ones(n, dtype=bool)
    at_rank: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(positions: np.ndarray) -> None:
        positions = positions[after[positions] >= 0]
        ranks = v.rank(symbols[positions], symbols[after[positions]])
        positions, ranks = positions[ranks < NONE], ranks[ranks < NONE]
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        for part in np.split(np.arange(len(ranks)), np.flatnonzero(np.diff(ranks)) + 1):
            if len(part):
                r = int(ranks[part[0]])
                if r not in at_rank:
                    at_rank[r] = []
                    heapq.heappush(heap, r)
                at_rank[r].append(positions[part])

    enter(np.arange(n))
    while heap:
        r = heapq.heappop(heap)
        p = np.unique(np.concatenate(at_rank.pop(r)))
        p = p[alive[p] & (after[p] >= 0)]
        p = p[(symbols[p] << 32 | symbols[after[p]]) == v.by_rank[r]]
        if not len(p):
            continue
        p = _alternate(p, np.append(False, p[1:] == after[p[:-1]]))
        gone = after[p]
        symbols[p], alive[gone] = v.made[r], False
        after[p] = after[gone]
        linked = p[after[p] >= 0]
        before[after[linked]] = linked
        left = before[p]
        enter(np.unique(np.concatenate([p, left[left >= 0]])))
    return symbols[alive]


class _Index(dict):
    """Numbers of words; a word not met before gets the next number and waits in `new`."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.new.append(word)
        return i


class Encoder:
    """Encodes texts; with `special`, the strings of special tokens in a text become those tokens, as the library does by
    default, without it they are plain text."""

    def __init__(self, path: str, special: bool = True) -> None:
        self.v, self.library = Vocabulary(path), None
        self.special = self.v.special if special else {}
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self._begin()

    def _begin(self) -> None:
        self.index = _Index()
        for t, i in self.special.items():
            self.index[(t,)] = len(self.index)
        self.ids = np.array([*self.special.values()], dtype=np.int64)
        self.sizes = np.ones(len(self.special), dtype=np.int64)

    def _split(self, text: str) -> list:
        if _PLAIN.fullmatch(text):
            return _WORDS.findall(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.v.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def words(self, text: str) -> list:
        """The words of a text; a special token is a tuple of its string."""
        if self.cut is None or not any(t in text for t in self.special):
            return self._split(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [*self._split(text[at : m.start()]), (m.group(),)]
            at = m.end()
        return out + self._split(text[at:])

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for distinct words."""
        data = [w.encode() for w in words]
        size = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        short = size <= LONG
        flat = np.frombuffer(b"".join(d for d, s in zip(data, short) if s), dtype=np.uint8)
        ids, n = merge_rounds(self.v, self.v.byte_ids[flat], size[short])
        if short.all():
            return ids, n
        parts, at = [], 0
        left = iter(np.split(ids, np.cumsum(n)))
        for d, s in zip(data, short):
            parts.append(next(left) if s else merge_long(self.v, self.v.byte_ids[np.frombuffer(d, dtype=np.uint8)]))
        return np.concatenate(parts), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and their number for each text (null: none)."""
        if len(self.ids) > KEPT_IDS:
            self._begin()
        words = [self.words(t or "") for t in texts]
        per_text = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        number = np.fromiter((self.index[w] for ws in words for w in ws), dtype=np.int64, count=int(per_text.sum()))
        if self.index.new:
            ids, n = self.merged(self.index.new)
            self.ids, self.sizes, self.index.new = np.append(self.ids, ids), np.append(self.sizes, n), []
        starts = np.cumsum(self.sizes) - self.sizes
        flat, n = take(self.ids, starts[number], self.sizes[number])
        ends = np.append(0, np.cumsum(n))
        upto = np.append(0, np.cumsum(per_text))
        return flat, np.diff(ends[upto])


def take(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of values one after the other, and their sizes."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    return values[at], sizes


def decode_ids(v: Vocabulary, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Texts of flat ids; an unknown id is left out, bytes that are no UTF-8 become U+FFFD, as the library has it."""
    known = (ids >= 0) & (ids < len(v.sizes))
    known[known] = v.known[ids[known]]
    upto = np.append(0, np.cumsum(known))[np.append(0, np.cumsum(sizes))]
    ids = ids[known]
    flat, n = take(v.bytes, v.starts[ids], v.sizes[ids])
    ends = np.append(0, np.cumsum(n))[upto]
    data = flat.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _with(df: DataFrame, name: str, kind) -> StructType:
    return StructType([f for f in df.schema.fields if f.name != name]).add(name, kind)


def _put(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], [*names, name])


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, special: bool = True) -> DataFrame:
    """The rows of df and a last column `out`, array<int>: the ids of their whole texts (null and empty texts: none). Repeated
    rows stay, other columns are passed on, a column named `out` is replaced."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, special)
        for b in batches:
            for start, texts in chunks(b.column(text).to_pylist()):
                ids, n = encoder(texts)
                yield _put(b.slice(start, len(texts)), out, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(ids, pa.int32())))

    return df.mapInArrow(run, _with(df, out, ArrayType(IntegerType())))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None, chunk_ids: int = 1 << 19) -> DataFrame:
    """The rows of df and a last column `out`: the text of their ids, special tokens included. Null ids give an empty text,
    null elements nothing."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(path)
        for b in batches:
            column = b.column(ids)
            n = np.array(column.value_lengths().fill_null(0), dtype=np.int64)
            part = np.cumsum(n) // chunk_ids
            for rows in np.split(np.arange(len(n)), np.flatnonzero(np.diff(part)) + 1) if len(n) else []:
                piece = column.slice(rows[0], len(rows))
                flat = np.array(piece.flatten().fill_null(-1), dtype=np.int64)
                yield _put(b.slice(rows[0], len(rows)), out, pa.array(decode_ids(v, flat, n[rows]), pa.string()))

    return df.mapInArrow(run, _with(df, out, StringType()))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of docs, both ways through the operator."""
    both = decode(encode(docs.select("doc_id", "text")).drop("text"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
