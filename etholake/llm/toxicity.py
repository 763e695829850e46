"""Operator 1: toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on windows of toxic text. A text is cut into
short windows; each is compressed with either, and the bytes that the toxic one saves tell how toxic the window is.
Logistic calibration on labelled rows that the dictionaries have not seen turns the counts of a document's windows by
savings into a score; its threshold, at 0.5, lets MOST_WRONG of the ordinary ones pass as toxic.

Toxic documents are mostly ordinary text, so the toxic dictionary is trained on those of their windows that hold a run of
bytes which far more toxic than ordinary documents have; and its compressor has the ordinary dictionary before it, cut to
the same length, so that plain windows compress alike under both.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import apply_logistic, crc_mod, fit_logistic

WINDOW_WORDS = 3
_WINDOWS = re.compile(rb"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]*){1,%d}" % WINDOW_WORDS)
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
#: Bytes of the ordinary and of the toxic dictionary, and of the pieces that these are made of; toxic ones of each length are tried.
ORDINARY_BYTES, TOXIC_BYTES, ORDINARY_PIECE, TOXIC_PIECES = 8_192, 2_048, 48, (12, 16, 24)
#: Length of a telling run of bytes, and how many times the share of toxic documents must have it that ordinary ones have.
RUN_BYTES, RATIO = 6, 6.0
#: Windows of ordinary text that a dictionary is trained on at most; folds of the labelled rows; and the share of ordinary
#: ones that may score 0.5 or more.
MAX_WINDOWS, FOLDS, MOST_WRONG = 60_000, 4, 0.02
PRIMER_BYTES = 64
#: A thorough search with matches of four bytes: a window's length then depends little on chance.
PARAMS = {"window_log": 18, "hash_log": 17, "chain_log": 17, "search_log": 6, "min_match": 4, "target_length": 24, "strategy": zstd.STRATEGY_LAZY2}
SAVINGS = (2, 3, 4, 5, 6)
N_FEATURES = len(SAVINGS) + 3
#: Labelled rows of either class that the model is fitted on at most; longer texts than this are left out of the sample.
MAX_TOXIC, MAX_ORDINARY, MAX_SAMPLE_CHARS = 1_500, 3_000, 20_000


def plain(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def windows(text: str | None) -> list[bytes]:
    """Whole text, lower-cased, as windows of a few words; white space only or null gives none."""
    return _WINDOWS.findall(plain(text))


def _dictionary(samples: list[bytes], size: int, piece: int) -> bytes:
    """The content of a trained dictionary, most useful pieces last; too few samples are used as they are."""
    try:
        trained = zstd.train_dictionary(size + 600, samples, k=piece, d=6).as_bytes()
    except zstd.ZstdError:
        return b" ".join(samples)[-size:]
    # the content follows the entropy tables, which end with three offsets: 1, 4 and 8
    at = trained.find(bytes([1, 0, 0, 0, 4, 0, 0, 0, 8, 0, 0, 0]))
    return (trained[at + 12 :] if at >= 0 else trained)[-size:].lstrip(b"\0")


def _distinct(texts: list[bytes], span: int = 5, share: float = 0.5) -> np.ndarray:
    """Which texts are mostly new: copies of earlier ones would make their words look like their class's."""
    seen: set[int] = set()
    keep = np.zeros(len(texts), dtype=bool)
    for i, t in enumerate(texts):
        w = _WORDS.findall(t)
        own = {zlib.crc32(b" ".join(w[j : j + span])) for j in range(max(1, len(w) - span + 1))}
        keep[i] = len(own & seen) <= share * len(own)
        if keep[i]:
            seen |= own
    return keep


def _runs(text: bytes) -> np.ndarray:
    """The runs of RUN_BYTES bytes at all places of a text, as numbers."""
    raw = np.frombuffer(text + bytes(8), dtype=np.uint8)
    words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))[: max(0, len(text) - RUN_BYTES + 1)]
    return words & np.uint64((1 << 8 * RUN_BYTES) - 1)


class _Telling:
    """In how many texts of each class and fold a run of bytes occurs, of those that toxic texts have."""

    def __init__(self, texts: list[bytes], group: np.ndarray, n_groups: int) -> None:
        self.runs = np.unique(np.concatenate([np.unique(_runs(t)) for t, g in zip(texts, group) if g % 2] + [np.zeros(1, np.uint64)]))
        self.counts = np.zeros((len(self.runs), n_groups), dtype=np.int32)
        for t, g in zip(texts, group):
            own = np.unique(_runs(t))
            at = np.minimum(np.searchsorted(self.runs, own), len(self.runs) - 1)
            self.counts[at[self.runs[at] == own], g] += 1

    def runs_of(self, toxic: np.ndarray, ordinary: np.ndarray, n_toxic: int, n_ordinary: int) -> np.ndarray:
        a, b = self.counts[:, toxic].sum(1), self.counts[:, ordinary].sum(1)
        return self.runs[(a >= 3 + 0.01 * n_toxic) & (a * n_ordinary > RATIO * n_toxic * (b + 1))]


def _telling_windows(text: bytes, telling: np.ndarray) -> list[bytes]:
    """Windows of one word, with the space around it, that hold a telling run."""
    hit = np.concatenate([[0], np.cumsum(np.isin(_runs(text), telling)), np.zeros(RUN_BYTES)])
    hit[len(hit) - RUN_BYTES :] = hit[len(hit) - RUN_BYTES - 1]
    spans = ((max(0, m.start() - 1), min(len(text), m.end() + 1)) for m in _WORDS.finditer(text))
    return [text[a:b] for a, b in spans if hit[max(a, b - RUN_BYTES + 1)] > hit[a]]


class ToxicityModel:
    """Two compressors and the calibration of their difference."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        #: Stands before each window: a piece that both dictionaries have. It pays a block's fixed cost, below
        #: which zstandard would store a short window as it is and hide what a dictionary saves.
        self.primer = ordinary[-PRIMER_BYTES:]
        self.ordinary, self.toxic = ordinary, ordinary[len(toxic) : max(len(toxic), len(ordinary) - PRIMER_BYTES)] + toxic + self.primer
        self.calibration: tuple | None = None
        self.prior = 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _compressors(self) -> tuple:
        if not hasattr(self, "_c"):
            params = zstd.ZstdCompressionParameters(write_content_size=0, write_checksum=0, write_dict_id=0, **PARAMS)
            self._c = tuple(
                zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=params) for d in (self.ordinary, self.toxic)
            )
        return self._c

    def savings(self, parts: list[bytes]) -> np.ndarray:
        """Bytes by which the toxic dictionary shortens each window."""
        a, b = (c.compress for c in self._compressors())
        p = self.primer
        return np.array([len(a(p + w)) - len(b(p + w)) for w in parts], dtype=np.int32)

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), N_FEATURES))
        for i, t in enumerate(texts):
            s = self.savings(windows(t))
            if len(s):
                out[i] = (*(np.log1p((s >= k).sum()) for k in SAVINGS), np.sqrt((s >= 3).mean()), np.sqrt((s >= 4).mean()), np.log1p(len(s)))
        return out

    def calibrate(self, texts: list[str], y: np.ndarray) -> float:
        """Fit the calibration to texts that the dictionaries have not seen; the share of the toxic ones that it catches."""
        x = self.features(texts)
        mean, scale, w = fit_logistic(x, y.astype(float), l2=1e-3)
        z = ((x - mean) / scale) @ w[:-1] + w[-1]
        if (y == 0).any() and (y == 1).any():
            # the threshold: 0.5 is where MOST_WRONG of the ordinary texts end
            cut = float(np.quantile(z[y == 0], 1 - MOST_WRONG)) + 1e-6
            w[-1] -= cut
            self.calibration = (mean, scale, w)
            return float((z[y == 1] >= cut).mean())
        self.calibration = (mean, scale, w)
        return 0.0

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.calibration is None:
            return np.full(len(texts), self.prior)
        return np.clip(apply_logistic(self.features(texts), self.calibration), 0.0, 1.0)


def train(texts: list[str], labels: list[int]) -> ToxicityModel:
    """Dictionaries and calibration from labelled texts. Each fold in turn is held back from the dictionaries, which are made
    of pieces of several lengths, and calibrates them; of all, those that catch most of their held toxic rows are taken."""
    y = np.array(labels, dtype=int)
    if not len(y) or y.min() == y.max():
        model = ToxicityModel(b" ", b" ")
        model.prior = float(y.mean() >= 0.5) * 0.9 if len(y) else 0.0
        return model
    enc = [plain(t) for t in texts]
    new, fold = _distinct(enc), np.zeros(len(y), dtype=int)
    for c in (0, 1):
        fold[y == c] = np.arange((y == c).sum()) % FOLDS
    at = np.flatnonzero(new)
    telling = _Telling([enc[i] for i in at], (fold * 2 + y)[at], 2 * FOLDS)
    rng = np.random.default_rng(1)

    best, best_caught = None, -1.0
    for f in range(FOLDS):
        others, held = np.array([g for g in range(FOLDS) if g != f]), np.flatnonzero(fold == f)
        use = new & (fold != f)
        n = [max(1, int((use & (y == c)).sum())) for c in (0, 1)]
        runs = telling.runs_of(2 * others + 1, 2 * others, n[1], n[0])
        toxic = [w for i in np.flatnonzero(use & (y == 1)) for w in _telling_windows(enc[i], runs)]
        ordinary = [w for i in np.flatnonzero(use & (y == 0)) for w in _WINDOWS.findall(enc[i])]
        if len(ordinary) > MAX_WINDOWS:
            ordinary = [ordinary[i] for i in np.sort(rng.permutation(len(ordinary))[:MAX_WINDOWS])]
        base = _dictionary(ordinary, ORDINARY_BYTES, ORDINARY_PIECE)
        for piece in TOXIC_PIECES:
            model = ToxicityModel(base, _dictionary(toxic, TOXIC_BYTES, piece))
            caught = model.calibrate([texts[i] for i in held], y[held])
            if caught > best_caught:
                best, best_caught = model, caught
    return best


def fit(docs: DataFrame, labels: DataFrame, modulus: int | None = 5) -> ToxicityModel:
    """Model from a bounded sample of labelled rows: at most MAX_TOXIC and MAX_ORDINARY, in the order of a hash of
    the id. With a modulus, ids whose crc32 it divides are held out. Null ids and labels are no labels.

    A task trains on the sample; the driver gets only the model, of fixed size, and no text."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    if modulus:
        known = known.where(crc_mod(F.col("_id"), modulus) != 0)
    known = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    part = lambda y, n: known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = part(1, MAX_TOXIC).union(part(0, MAX_ORDINARY))  # bounded by its limits, so it may be broadcast
    rows = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(chosen), "_id").where(F.length("text") < MAX_SAMPLE_CHARS)

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = [r for b in batches for r in zip(b["_id"], b["text"], b["_y"])]
        own.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[1]))
        yield pd.DataFrame({"model": [pickle.dumps(train([r[1] for r in own], [r[2] for r in own]))]})

    found = rows.select("_id", "text", "_y").repartition(1).mapInPandas(one, "model binary").first()
    return pickle.loads(found["model"]) if found else train([], [])


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every row's whole text. Null and empty texts have no windows and get the score
    of a text without savings; repeated rows are scored each; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(b.column("text").to_pylist()))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose text scores under the threshold. Null texts stay."""

    @F.pandas_udf("double")
    def of(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(text.tolist()))

    return docs.where(of(F.col("text")) < threshold)
