import math
import random
import re

import numpy as np

from etholake.llm import quality
from tests.llm.conftest import corpus, table, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed, straight from the definition."""
    t = text or ""
    w = WORD.findall(t)
    lines, dup, seen = [x for x in t.split("\n") if WORD.search(x)], 0, set()
    for x in lines:
        dup += x in seen
        seen.add(x)
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside), len(w) < 20 or 100 * len(inside) > 30 * len(w)


def check(d, labels):
    want = sorted((str(r["doc_id"]), *plain(r["text"])) for r in d.collect())
    got = quality.judge(d, quality.fit(d, labels)).collect()
    have = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got)
    assert have == want
    assert not any(r["kept"] and r["base_failed"] for r in got)
    return got


def test_statistics(docs, labels):
    check(docs, labels)


def test_odd_rows(odd, empty, labels):
    check(odd, labels)
    assert quality.judge(empty, quality.fit(empty, labels)).count() == 0
    assert len(check(odd, labels.limit(0))) == odd.count()


def test_repeats_that_overlap():
    for t in ("a " * 50, "a b c d e f g h " * 3, "x " + "a b c d e f g h " * 2 + "y", "one two three four five six seven eight\n" * 2):
        assert quality.rule_stats([t])[0, 4] == plain(t)[4]


def test_junk_is_anomalous(spark):
    """Documents of symbols are rejected, ordinary ones stay: held-out rows tell."""
    rng = random.Random(2)
    good = [t for t in corpus(6, 400) if not plain(t)[5]]
    vocabulary = good[0].split()
    junk = [" ".join("".join(rng.choice("#*$%&|<>") for _ in range(6)) if rng.random() < 0.5 else rng.choice(vocabulary) for _ in range(60)) for _ in range(60)]
    texts = good + junk
    y = [1] * len(good) + [0] * len(junk)
    labels = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y) if i % 2], "doc_id long, quality int, toxic int")
    d = table(spark, texts)
    got = {r["doc_id"]: r["kept"] for r in quality.judge(d, quality.fit(d, labels)).collect()}
    held = [i for i in range(len(texts)) if not i % 2]
    assert np.mean([got[i] for i in held if y[i]]) > 0.95
    assert np.mean([not got[i] for i in held if not y[i] and not plain(texts[i])[5]]) > 0.8


def test_isolation_forest_tells_outliers():
    rng = np.random.default_rng(1)
    forest = quality.IsolationForest(rng.normal(size=(1000, 3)))
    near, far = forest.score(rng.normal(size=(50, 3))), forest.score(rng.normal(8, 1, size=(50, 3)))
    assert near.mean() < 0.5 < far.min()


def test_threshold_is_of_all_labelled_rows(spark, monkeypatch):
    """The values at ranks are exact, and the threshold is that of all labelled rows, however many."""
    rng = random.Random(4)
    xs = [rng.choice([0.0, 1e9, rng.random() ** 9, -rng.random()]) for _ in range(3000)]
    rows = spark.createDataFrame([(i % 2, x) for i, x in enumerate(xs)], "f int, v double")
    assert quality._at_ranks(rows, {0: 700, 1: 1499}) == {0: sorted(xs[::2])[700], 1: sorted(xs[1::2])[1499]}
    monkeypatch.setattr(quality, "TREES", 4)
    monkeypatch.setattr(quality, "SUBSAMPLE", 8)
    n = 7000
    stats = spark.range(n).selectExpr("id doc_id", "100 + id % 50 n_words", "500 + id % 97 word_chars", "id % 3 n_symbols", "0L n_dup_lines", "0L n_repeat_words", "5 + id % 4 n_lines")
    model = quality.fit_statistics(stats, spark.range(n).selectExpr("id doc_id", "int(id % 10 > 0) quality"))
    got = [r for r in quality.judge_statistics(stats, model).collect() if r["doc_id"] % 10]
    ok = sorted(r["anomaly"] for r in got)
    floor = ok[min(len(ok) - 1, math.ceil(len(ok) * (1 - quality.MAX_FALSE)))]
    bad = [r["anomaly"] for r in quality.judge_statistics(stats, model).collect() if r["doc_id"] % 10 == 0 and r["anomaly"] > floor]
    assert model.threshold == ((floor + min(bad)) / 2 if bad else floor + 1e-9)


def test_words_of_fixture():
    assert words(random.Random(1), 3, ["a"]) == "a a a"
