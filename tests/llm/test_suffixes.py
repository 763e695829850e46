import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from etholake.llm import suffixes
from tests.llm.conftest import table


def brute(rows):
    """(n_bytes, n_removed, n_spans, sha256 of what is left) of (id, text) rows, straight from the definition."""
    rows = [(np.inf if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in rows:
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(first.get(t[i : i + 50], np.inf), d)
    out = []
    for d, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < d:
                gone[i : i + 50] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0, hashlib.sha256(kept).hexdigest()))
    return out


def check(d):
    rows = [(r["doc_id"], r["text"]) for r in d.collect()]
    want = sorted(zip([str(x[0]) for x in rows], brute(rows)))
    got = sorted((str(r["doc_id"]), tuple(r)[1:]) for r in suffixes.digests(d).collect())
    assert got == want
    return sum(w[1][1] for w in want)


def test_equals_brute_force(docs):
    assert check(docs) > 1000


@pytest.mark.parametrize("text", ["ab" * 200, "a" * 300, "the of and " * 40])
def test_periodic(spark, text):
    check(table(spark, [text, text[:60] + "X" + text[60:], text[5:], "Y" + text[:49], "Z" + text[:50]]))


def test_exact_length(spark):
    base = "".join(chr(97 + (i * 7 + i // 5) % 26) for i in range(200))
    check(table(spark, [base, "##" + base[30:80] + "##", "##" + base[30:79] + "##", base[100:150] + "!", "!" + base[:50] + "!" + base[60:120]]))


def test_common_core_in_many_documents(spark):
    """Only the whole surroundings tell the anchors of a passage's ends apart: unshared text must stay."""
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    passage = noise(70)
    check(table(spark, [noise(40) + passage + noise(40) for _ in range(3000)]))


def test_equal_hashes_settle_nothing(monkeypatch):
    """With all hashes of surroundings equal, only what is equal byte by byte is settled."""
    monkeypatch.setattr(suffixes, "_around", lambda x, doc, place: (np.zeros(len(doc), np.uint64), np.ones(len(doc), np.uint16), np.ones(len(doc), np.uint16)))
    core = bytes(range(65, 115))
    texts = [b"a" * 9 + core + b"b" * 9, b"c" * 9 + core + b"d" * 9]
    for other, settled in ((texts[1], False), (texts[0], True)):
        sent = suffixes._send(np.array([1, 2]), [texts[0], other], 1, np.zeros(0, np.uint64))
        found = suffixes._bucket(pa.Table.from_batches([sent]), 1)
        assert (suffixes.SETTLED in found.column("kind").to_pylist()) == settled


def test_odd_rows(odd, empty):
    check(odd)
    assert suffixes.digests(empty).count() == 0
    kept = suffixes.deduplicated(odd)
    assert kept.columns == odd.columns


def test_cut_characters(spark):
    a = "é" * 40 + "abc"
    out = suffixes.deduplicated(table(spark, [a, "ü" + "é" * 30 + "z"])).orderBy("doc_id").collect()
    assert out[0]["text"] == a and "�" not in out[1]["text"] and out[1]["n_chars"] == len(out[1]["text"])


def test_bucket_pointers():
    rng = np.random.default_rng(0)
    buffer = rng.integers(97, 99, 3000).astype(np.uint8)
    buffer[1000:1400] = buffer[200:600]
    start, size = np.array([0, 900, 1800]), np.array([900, 900, 1200])
    at, pointer = suffixes.refined_buckets(buffer, start, size)
    names = {}
    for p, q in zip(at.tolist(), pointer.tolist()):
        assert names.setdefault(buffer[p : p + 50].tobytes(), q) == q
    assert len(set(names.values())) == len(names) and len(at) == sum(s - 49 for s in size)



@pytest.mark.parametrize("least", [3, 40])
def test_hot_grams_go_another_way(spark, docs, monkeypatch, least):
    """With strings instead of buckets for frequent q-grams, the result is the same."""
    monkeypatch.setattr(suffixes, "HOT_ANCHORS", least)
    monkeypatch.setattr(suffixes, "HOT_ONE_IN", 1)
    assert len(suffixes.hot_grams(docs.select("doc_id", "text"))) > 0 or least > 3
    assert check(docs) > 1000
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    passage = noise(70)
    some = table(spark, [noise(40) + passage + noise(40) for _ in range(300)])
    assert len(suffixes.hot_grams(some.select("doc_id", "text"))) > 0
    assert check(some) > 60 * 299
