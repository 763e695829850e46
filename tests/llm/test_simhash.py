import os
import random

import numpy as np
import pytest
import xxhash

from etholake.llm import simhash
from tests.helpers import SF
from tests.llm.conftest import table


def plain_fingerprint(text, k=4):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: 32 for i in range(9, 14)}).split(" ")
    w = [x for x in w if x]
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if hs and 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids, prints, radius):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(ids[i])
    return {ids[i]: min(groups[root(i)]) for i in range(len(ids))}


def test_equals_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    got = simhash.classes(simhash.with_fingerprints(docs), 4).collect()
    assert {r["doc_id"]: r["fp"] % 2**64 for r in got} == {r["doc_id"]: p for r, p in zip(rows, prints)}
    assert {r["doc_id"]: r["component_id"] for r in got} == plain_components([r["doc_id"] for r in rows], prints, 4)


@pytest.mark.parametrize("shard", [8, 1 << 20])
def test_dense_clusters(spark, monkeypatch, shard):
    """Chains and clusters at the radius, over many shards or one."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard)
    monkeypatch.setattr(simhash, "LEAST_SAMPLE", 4)
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 12, dtype=np.uint64)
    prints = []
    for s in seeds:
        x = s
        for _ in range(25):
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
                x ^= np.uint64(1) << np.uint64(b)
            prints.append(int(x))
    d = spark.createDataFrame([(1000 - i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(d, 4).collect()}
    assert got == plain_components([1000 - i for i in range(len(prints))], prints, 4)


def test_cluster_that_no_vantage_point_divides(spark, monkeypatch):
    """Its pieces meet two by two."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", 40)
    prints = [(1 << i) | (1 << j) for i in range(30) for j in range(i)] + [0xFFFF << 40, 0xFFFE << 40]
    d = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(d, 4).collect()}
    assert got == plain_components(list(range(len(prints))), prints, 4) and len(set(got.values())) == 2


def test_triangle_bound(monkeypatch):
    """Every two values within the slack meet in a block, and few others do."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", 100)
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 1 << 16, 3000)).astype(np.uint16)
    tree, blocks = simhash.grow(values, 1, 1.0, 0, rng)
    assert blocks > 16 and simhash.depth(tree) > 4
    home, guests = {}, {}
    for block, role, i in simhash.route(tree, values, 1, np.zeros(len(values), dtype=np.uint64)):
        for k in i.tolist():
            if role == simhash.GUEST:
                guests.setdefault(k, set()).add(block)
            else:
                assert home.setdefault(k, block) == block
    assert len(home) == len(values)
    for i in range(0, len(values), 37):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 1).tolist():
            assert home[i] == home[j] or home[j] in guests.get(i, ()) or home[i] in guests.get(j, ())
    assert sum(map(len, guests.values())) < 0.2 * blocks * len(values)


def test_block_forest_connects_what_is_linked(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_ROWS", 8)
    monkeypatch.setattr(simhash, "MOST_LINKS", 50)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(8)])
    a, b, dist = simhash.block_links(prints[:, None], np.full(len(prints), simhash.RESIDENT), simhash.Part(0, 0, 64, 4), 4)
    assert len(a) < len(prints) and (np.bitwise_count(prints[a] ^ prints[b]) == dist).all() and (dist <= 4).all()
    parent = list(range(len(prints)))
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = parent[i], parent[j]
        parent = [x if p == y else p for p in parent]
    want = plain_components(list(range(len(prints))), [int(p) for p in prints], 4)
    assert {(parent[i] == parent[j]) == (want[i] == want[j]) for i in range(len(prints)) for j in range(i)} == {True}


def plain_near(rows, similarity=0.8):
    """component_id of each (doc_id, text), by comparing the sets of five-word shingles of all pairs."""
    sets = [frozenset(simhash.shingle_hashes(t, 5).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def test_near_copies_equal_brute_force(spark):
    """Edits of long and short texts, at similarities on both sides of 0.8."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(900)]
    texts = []
    for n in (30, 60, 200, 600):
        for _ in range(12):
            base = [rng.choice(vocabulary) for _ in range(n)]
            texts.append(" ".join(base))
            for _ in range(3):
                w = list(base)
                for _ in range(rng.randint(1, max(1, n // 25))):
                    w[rng.randrange(n)] = rng.choice(vocabulary)
                texts.append(" ".join(w))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_classes(table(spark, texts)).collect()}
    root = plain_near(list(enumerate(texts)))
    want = {i: min(j for j in range(len(texts)) if root[j] == root[i]) for i in range(len(texts))}
    go = {i for i in want if want[i] != i}
    assert len(go) > 40 and len({i for i in go if got[i] != i}) >= 0.95 * len(go)
    # nothing goes that is not like another text
    assert all(want[i] != i for i in got if got[i] != i)


def test_large_group_of_near_copies(spark):
    """Some hundreds of edits of one text are one class, though no list of all their pairs is made."""
    rng = random.Random(9)
    base = [f"b{rng.randrange(500)}" for _ in range(300)]
    texts = []
    for _ in range(400):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(300)] = f"e{rng.randrange(10_000)}"
        texts.append(" ".join(w))
    assert [r["doc_id"] for r in simhash.one_of_each(table(spark, texts)).collect()] == [0]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_near_copies_of_driver_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    root = plain_near(rows)
    want = {d: min(rows[j][0] for j in range(len(rows)) if root[j] == root[i]) for i, (d, _) in enumerate(rows)}
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_one_of_each(docs):
    kept = simhash.one_of_each(docs)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and 0 in ids
    texts = [r["text"] for r in docs.collect()]
    assert len(ids) <= len(set(texts)) and len({r["text"] for r in kept.collect()}) == len(ids)


def test_texts_under_one_id(spark):
    """Different texts under one id stay, repeated rows are one, and a copy under a larger id goes."""
    rows = [(6, "one text about the sea and the wind over it"), (6, "quite another text of other words about hills"), (6, "quite another text of other words about hills"), (9, "one text about the sea and the wind over it"), (None, "x"), (None, "x")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, kept)) == sorted(f"Row(doc_id={d}, text={t!r})" for d, t in [rows[0], rows[1], rows[4], rows[5]])


def test_odd_rows(odd, empty, spark):
    rows = odd.select("doc_id", "text").collect()
    got = simhash.classes(simhash.with_fingerprints(odd), 4).collect()
    assert sorted(str((r["doc_id"], r["fp"] % 2**64)) for r in got) == sorted(str((r["doc_id"], plain_fingerprint(r["text"]))) for r in rows)
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert simhash.classes(simhash.with_fingerprints(empty), 4).count() == 0
    kept = simhash.one_of_each(odd)
    # texts without words are one class, repeated rows one row, and a null id stays
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "6", "6", "7", "8", "None"]
    assert simhash.one_of_each(empty).count() == 0
    assert simhash.one_of_each(table(spark, ["same words in a row here"] * 5)).count() == 1


def _sketches(spark, prints, sets):
    """Sketches as they are made, but with fingerprints and sets of shingles of our choice."""
    rows = [(f"n{i:03d}", *(int(np.uint64(w).view(np.int64)) for w in p), sorted(s)) for i, (p, s) in enumerate(zip(prints, sets))]
    return spark.createDataFrame(rows, "node string, w0 long, w1 long, w2 long, shingles array<int>")


def test_a_link_behind_two_that_fail(spark):
    """Of three that are near each other only the two farthest are alike: a spanning tree of the candidates misses them."""
    bits = lambda *at: sum(1 << i for i in at)
    prints = [(0, 0, 0), (bits(*range(6), *range(20, 26)), 0, 0), (bits(*range(10)), 0, 0)]
    d = [[int(np.bitwise_count(np.uint64(a[0] ^ b[0]))) for b in prints] for a in prints]
    assert (d[0][2], d[1][2], d[0][1]) == (10, 10, 12)
    sets = [set(range(100)), {*range(5, 105)}, set(range(500, 600))]
    assert [tuple(r) for r in simhash.alike(_sketches(spark, prints, sets)).collect()] == [("n000", "n001")]


def test_many_candidates_that_are_not_alike(spark):
    """Forty near each other in every part, of which a few pairs are alike: more than one round of confirming takes."""
    rng = np.random.default_rng(5)
    prints = []
    for _ in range(40):
        p = np.zeros(3, dtype=np.uint64)
        for b in rng.choice(192, rng.integers(1, 16), replace=False):
            p[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
        prints.append(tuple(int(x) for x in p))
    sets = [set(range(100 * i, 100 * i + 60)) for i in range(40)]
    want = {(3, 31), (7, 8), (8, 39), (12, 20)}
    for i, j in want:
        sets[j] = sets[i] | {10_000 + j}
    got = {tuple(int(n[1:]) for n in r) for r in simhash.alike(_sketches(spark, prints, sets)).collect()}
    assert got <= want | {(7, 39)} and {frozenset(g) for g in got} >= {frozenset(w) for w in ((3, 31), (12, 20))}
    assert len(got & {(7, 8), (8, 39), (7, 39)}) >= 2
