import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from etholake.llm import mixinglm

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return [*WORD.findall(low), None]


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check_base(rows, got):
    """n_tokens, n_known, train_tokens and base_score, straight from the definition."""
    known = Counter()
    for d, t in rows:
        if not is_held(d):
            known.update(tokens(t))
    n, v = sum(known.values()), len(known)
    want = []
    for d, t in rows:
        own = tokens(t)
        want.append((str(d), is_held(d), len(own), sum(known[w] > 0 for w in own), n, sum(math.log10((known[w] + 1) / (n + v + 1)) for w in own)))
    have = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got]
    for a, b in zip(sorted(want), sorted(have), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def test_base_and_scores(docs):
    got = mixinglm.score(docs).collect()
    check_base([(r["doc_id"], r["text"]) for r in docs.collect()], got)
    assert all(r["score"] < 0 for r in got)
    held = [r["bits_per_byte"] for r in got if r["held_out"]]
    assert held and np.mean(held) < 5


def test_reruns_agree(docs):
    one = {r["doc_id"]: r["score"] for r in mixinglm.score(docs).collect()}
    two = {r["doc_id"]: r["score"] for r in mixinglm.score(docs.repartition(5)).collect()}
    assert one == pytest.approx(two, rel=1e-5)


def test_odd_rows(odd, empty):
    got = mixinglm.score(odd).collect()
    check_base([(r["doc_id"], r["text"]) for r in odd.collect()], got)
    assert all(np.isfinite(r["score"]) for r in got)
    assert mixinglm.score(empty).count() == 0


def test_unseen_text_costs_more(spark):
    unseen = next(i for i in range(40, 400) if is_held(i))
    rows = [(i, "the cat sat on the mat and the dog lay by the door") for i in range(40)] + [(unseen, "qzx vvk jjq xxw zzk qqj wvx")]
    got = {r["doc_id"]: r for r in mixinglm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[unseen]["held_out"] and got[1]["bits_per_byte"] < 0.5 * got[unseen]["bits_per_byte"]
    assert got[1]["bits_per_byte"] < 2


def test_all_training_rows_count(spark):
    """Also those that the mixer is tuned on, and long ones: without a text, its own score falls."""
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    rows = [(i, text(40)) for i in range(30)] + [(100, text(4000))]
    trained = [i for i, _ in rows if not is_held(i)]
    own = {r["doc_id"]: r["bits_per_byte"] for r in mixinglm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 100 in trained and max(own[i] for i in trained) < min(v for i, v in own.items() if is_held(i))


def _model(text):
    centres = mixinglm.cluster([text])
    given = mixinglm.Prepared([text], centres)
    cells = np.full(mixinglm._WIDE * mixinglm.SLICES, 128, np.uint8)
    for k, context in enumerate(mixinglm._contexts(given.keys, given.prefixes)):
        t = mixinglm.Tally(k)
        t.add(context, mixinglm._last_bytes(given.keys), np.ones(len(given.keys), dtype=np.int64))
        slots, zeros, ones = t.slots()
        assert (zeros + ones).sum() == 8 * len(given.keys) and (np.diff(slots) > 0).all()
        cells[slots] = (np.clip(np.rint(4 * np.log((ones + 0.3) / (zeros + 0.3))), -32, 31).astype(int) + 32 << 2 | 2).astype(np.uint8)
    model = mixinglm.MixingModel(cells, centres)
    model.learn([text])
    return model, given


def test_probabilities_add_up():
    """Over all 256 next bytes the model's probabilities add up to one, in every context."""
    model, given = _model(b"to be or not to be that is the question " * 20)
    for place in (0, 7, 100, 333):
        rest = given.keys[place] & ~np.uint64(0xFF << 32)
        keys = rest | (np.arange(256, dtype=np.uint64) << np.uint64(32))
        p = np.exp(model.costs(keys, np.repeat(given.prefixes[place], 256)).astype(float))
        assert p.sum(axis=1) == pytest.approx([1, 1], abs=1e-3)


def test_whole_text_is_a_mix_of_experts():
    """The score is that of a plain walk over units: words with what ends them, and other bytes."""
    model, _ = _model(b"to be or not to be that is the question " * 20)
    texts = [b"", b"a", b"to be  or\nTo BE", b" " * 70, b"to be or nought " * 30, b"end "]
    memory = {b"to ": 40, b"be ": 30, b"or ": 9, b"to\xff": 3}
    given = mixinglm.Prepared(texts, model.centres)
    units = [re.findall(rb"[^\x20\x09-\x0D\xff]*[\x20\x09-\x0D\xff]", t + b"\xff") for t in texts]
    words = [u for own in units for u in own if len(u) > 1]
    assert len(given.words) == len(words) and [len({h for h, w in zip(given.words.tolist(), words) if w == x}) for x in set(words)] == [1] * len(set(words))
    got = model.score(given, np.array([memory.get(w, 0) for w in words]), 100)
    costs = model.costs(given.keys, given.prefixes).astype(float)
    for i, own in enumerate(units):
        seen, at, total = mixinglm.PRIOR_WORDS * np.array(mixinglm.PRIOR), given.bounds[i], -math.log10(mixinglm.KINDS)
        for start in range(0, len(own), mixinglm.BLOCK):
            share, more = seen / seen.sum(), np.zeros(3)
            for u in own[start : start + mixinglm.BLOCK]:
                p = np.array([*np.exp(costs[:, at : at + len(u)].sum(1)), memory.get(u, 0) / 100 if len(u) > 1 else 0]) * share
                total, more, at = total + math.log10(p.sum()), more + p / p.sum(), at + len(u)
            seen = seen + more
        assert got[i] == pytest.approx(total, rel=1e-4)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_held_out_score_beats_the_base(spark):
    r = mixinglm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").selectExpr("sum(score) as score", "sum(base_score) as base").first()
    assert r["score"] > r["base"]


def test_mixer_and_kinds_learn_from_all_training_rows(spark):
    """Also from long texts, and from all of many: none of these would have been picked as a tuning document before."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice(x) for _ in range(5)) for _ in range(4000)) for x in ["abcd", "wxyz", "äöüß"] for _ in range(3)]
    rows = [(i, t, i == 4, i % 5) for i, t in enumerate(texts)]
    dealt = mixinglm.packed(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean, _part int"))
    centres = mixinglm.kinds(dealt, 5)
    assert len(set(mixinglm.kinds_of([t.encode() for t in texts[::3]], centres))) == 3
    cells = np.tile(np.random.default_rng(1).integers(0, 256, mixinglm._WIDE * mixinglm.SLICES).astype(np.uint8), (mixinglm.FOLDS + 1, 1))
    model, fresh = mixinglm.learned(dealt, cells, centres), mixinglm.MixingModel(cells[-1], centres)
    assert all((a != b).all() for a, b in zip(model.weights, fresh.weights))
    without = mixinglm.learned(dealt.where("doc_id <> 8"), cells, centres)
    assert all((a != b).any() for a, b in zip(model.weights, without.weights))
    held = mixinglm.learned(dealt.where("doc_id <> 4"), cells, centres)
    assert all(a == pytest.approx(b, rel=1e-5) for a, b in zip(model.weights, held.weights))


def test_each_decision_of_a_text_teaches():
    model, given = _model(b"to be or not to be that is the question " * 20)
    assert model.learn([b"to be or not", b""]).sum() == 8 * (len(b"to be or not") + 2)
