import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from etholake.llm import wand
from tests.helpers import connection
from tests.llm.conftest import SCHEMA, corpus, table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=50):
    """From the definition, every document for every item."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, total = len(counted), sum(x for _, _, x in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, size in counted:
            m = 50 + (50 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m)) for w in set(terms(text)) if w in c)
            if s > 0:
                scores.append((-s, d is not None, d if d is not None else 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def items(spark, texts):
    return spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "item_id long, text string, rank string")


def check(spark, d, asked, **more):
    got = sorted((tuple(r) for r in wand.rank(d, asked, **more).collect()), key=str)
    want = brute([(r["doc_id"], r["text"]) for r in d.collect()], [(r["item_id"], r["text"]) for r in asked.collect()])
    assert got == want
    return got


@pytest.mark.parametrize("shard_chars", [300, 4000, 1 << 25])
def test_ranks(spark, shard_chars):
    texts = corpus(11, 160)
    asked = items(spark, [texts[3], texts[40][:80], "SUN ko-ti.re", "nothing of this_kind", "", None, texts[3]])
    got = check(spark, table(spark, texts).repartition(3), asked, shard_chars=shard_chars)
    assert got and max(r[1] for r in got) == 50


def test_ties_and_repeated_rows(spark):
    d = table(spark, ["same words here"] * 70 + ["other words", "here"]).repartition(4)
    d = d.unionByName(d.where("doc_id < 3"))
    check(spark, d, items(spark, ["same here", "words"]))


def test_odd_rows(spark, odd, empty):
    check(spark, odd, items(spark, ["three w1 TEXT", "é" * 80, "w5 w6 elsewhere", None]))
    assert wand.rank(empty, items(spark, ["x"])).count() == 0
    assert wand.rank(odd, items(spark, ["x"]).where("item_id < 0")).count() == 0
    assert wand.rank(spark.createDataFrame([(1, "?!", None, None, 2)], SCHEMA), items(spark, ["x"])).count() == 0


def lists(rng, n_docs, n_lists, clustered):
    """Lists of a shard, as they are built, with each document's terms."""
    lengths = np.array([rng.randint(1, 400) for _ in range(n_docs)])
    term, doc = [], []
    for t in range(n_lists):
        low = rng.randrange(n_docs) if clustered else 0
        high = min(n_docs, low + rng.randint(1, 700)) if clustered else n_docs
        for d in rng.sample(range(low, high), k=rng.randint(1, high - low)):
            count = rng.choice([1, 1, 2, 3, 300, 70_000])
            term += [t] * count
            doc += [d] * count
    batch = wand._compressed(7, [f"t{i}" for i in range(n_lists)], np.array(term), np.array(doc), list(range(n_docs)), lengths, n_docs, int(lengths.sum()))
    rows = batch.to_pylist()
    norms = np.array(rows[-1]["norms"])
    made = [wand.Postings(rng.choice([1, 5, 700, 9000]), *(r[c] for c in ("lasts", "impacts", "widths", "deltas", "tfs", "df"))) for r in rows[:-1]]
    return made, norms, Counter(zip(term, doc))


@pytest.mark.parametrize("clustered", [False, True])
def test_blocks_hold_what_was_put_in(clustered):
    made, norms, want = lists(random.Random(1), 1500, 5, clustered)
    for t, p in enumerate(made):
        docs = np.concatenate([p.docs_of(j) for j in range(len(p.lasts))])
        freqs = np.concatenate([p.freqs_of(j) for j in range(len(p.lasts))])
        assert {(t, d): f for d, f in zip(docs.tolist(), freqs.tolist())} == {k: v for k, v in want.items() if k[0] == t}
        for j in range(len(p.lasts)):
            impact = wand._impact(p.freqs_of(j), norms[p.docs_of(j)])
            assert p.bounds[j] == p.weight * impact.max() and p.lasts[j] == p.docs_of(j)[-1] and len(impact) <= wand.BLOCK


@pytest.mark.parametrize("seed", range(8))
def test_best_of_lists(seed):
    """All scores at once, against blocks that are skipped; some are never decompressed."""
    rng = random.Random(seed)
    made, norms, _ = lists(rng, 3000, 6, seed % 2)
    order = np.array(rng.sample(range(3000), 3000))
    total = np.zeros(3000, dtype=np.int64)
    for p in made:
        for j in range(len(p.lasts)):
            total[p.docs_of(j)] += p.weight * wand._impact(p.freqs_of(j), norms[p.docs_of(j)])
        p.docs, p.freqs = {}, {}
    want = np.lexsort((order, -total))[:10]
    docs, scores = wand.best(made, norms, order, 10, step=64)
    assert docs.tolist() == want[: (total[want] > 0).sum()].tolist() and scores.tolist() == total[docs].tolist()


def test_low_blocks_stay_compressed():
    p = wand._compressed(0, ["a"], np.zeros(1280 + 500, dtype=int), np.append(np.arange(1280), np.full(500, 5)), list(range(1280)), np.full(1280, 10), 1280, 12800).to_pylist()[0]
    one = wand.Postings(3, *(p[c] for c in ("lasts", "impacts", "widths", "deltas", "tfs", "df")))
    docs, _ = wand.best([one], np.full(1280, 100), np.arange(1280), 1, step=64)
    assert docs.tolist() == [5] and set(one.docs) == {0} and set(one.freqs) == {0}


def test_agrees_with_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in wand.rank(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")).collect())
    assert got == sorted(connection(sf).execute(wand.ORACLE_SQL).fetchall())
