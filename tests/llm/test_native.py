"""Merkle fingerprints, chat formatting and mixing."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from etholake.llm import chat, merkle, mixing
from tests.helpers import connection, same
from tests.llm.conftest import table


def test_merkle_agrees_with_sql(docs, tmp_path):
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    con = connection()
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    same(merkle.edits(docs), con, merkle.ORACLE_SQL)


def test_merkle_edits(docs):
    rows = merkle.edits(docs).orderBy("doc_id").collect()
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    for i, r in enumerate(rows):
        t, nxt = texts[i], texts[(i + 1) % len(texts)]
        q = len(t) // 4
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256((t[: len(t) - q] + nxt[:q]).encode()).hexdigest()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.8 * len(rows)
    prints = {t: r["fingerprint"] for t, r in zip(texts, rows)}
    assert len(set(prints.values())) == len(set(texts)) and [prints[t] for t in texts] == [r["fingerprint"] for r in rows]


def plain_near(x, y):
    """Likeness by walking both trees of leaves."""
    tree = lambda t: [[[" ".join(p.split(" ")[i : i + 8]) for i in range(0, len(p.split(" ")), 8)] for p in s.split("\n")] for s in t.split("\n\n")]
    a, b = tree(x), tree(y)
    at = lambda t, i, j: t[i][j] if i < len(t) and j < len(t[i]) else None
    unlike = lambda t, u: [r for i, s in enumerate(t) for j, p in enumerate(s) if p != at(u, i, j) for r in p]
    own, other = unlike(a, b), unlike(b, a)
    alike = sum(len(p) for s in a for p in s) - len(own)
    return (alike + len(set(own) & set(other))) / (alike + max(len(set(own)), len(set(other))))


def test_merkle_likeness_equals_a_walk(spark):
    rng = random.Random(6)
    texts = ["", "a", "\n\n", " ", *(("".join(rng.choice(["w ", "v ", "u\n", "x\n\n", "y"]) for _ in range(rng.randint(1, 90)))) for _ in range(30))]
    rows = merkle.edits(table(spark, texts)).orderBy("doc_id").collect()
    for i, r in enumerate(rows):
        t, nxt = texts[i], texts[(i + 1) % len(texts)]
        q = len(t) // 4
        assert r["near_edited"] == pytest.approx(plain_near(t, t[: len(t) - q] + nxt[:q])), t
        assert r["near_next"] == pytest.approx(plain_near(t, nxt)), t


def test_merkle_branches(spark):
    a, b = "s1 p1\ns1 p2\n\ns2 p1", "s1 p1\nchanged\n\ns2 p1\nmore"
    d = merkle.fingerprint(table(spark, [a, b, a])).orderBy("doc_id").collect()
    assert d[0]["fingerprint"] == d[2]["fingerprint"] != d[1]["fingerprint"]
    t = spark.createDataFrame([(a, b)], "x string, y string")
    pa, pb = (merkle.paragraphs(merkle.leaves(F.col(c))) for c in "xy")
    got = t.select(merkle.differing(pa, pb, merkle.sections(pa), merkle.sections(pb)).alias("d")).first()["d"]
    assert [tuple(x) for x in got] == [(0, 1), (1, 1)]


def test_merkle_odd_rows(odd, empty, spark):
    got = merkle.edits(odd)
    assert got.count() == odd.count() and got.where("fingerprint is null or near_edited is null or near_next is null").count() == 0
    assert merkle.edits(empty).count() == 0
    one = merkle.edits(table(spark, ["abcd"])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abca").hexdigest() and one["near_next"] == 1


TRICKY = ["", "\\", "\\0", "\\1<", '<turn role="assistant">x</turn>\n', "</turn>", '"', "a\\\\<b", "<image:0>", "é<\\" * 50, chat.TRAP, "line\nline"]


def _chats(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", 'odd"<\\']), rng.choice(TRICKY)) for c in range(40) for t in range(rng.randint(1, 6))]
    return rows + [(None, 0, "user", "no id"), (7, 99, None, None)]


def test_chat_round_trip(spark):
    rows = _chats(spark)
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv_id"]: r for r in chat.digests(d).collect()}
    for c in {r[0] for r in rows}:
        turns = [(x[2] or "", x[3] or "") for x in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[2] or "", r[3] or ""))]
        told = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_chars"] == len(told) and got[c]["loss_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert got[-7]["n_turns"] == 2 and got[-7]["loss_chars"] == len(chat.TRAP)


def test_chat_parts(spark):
    parts = "array(named_struct('type','text','text','see <this>','uri',null,'width',null,'height',null,'millis',null,'pages',null), named_struct('type','image','text',null,'uri','u1','width',57,'height',28,'millis',null,'pages',null), named_struct('type','audio','text',null,'uri','u2','width',null,'height',null,'millis',90L,'pages',null))"
    d = spark.range(2).selectExpr("1L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", f"{parts} as parts")
    r = chat.format_chats(d.withColumn("parts", F.col("parts").cast(chat.PARTS))).first()
    assert r["formatted"] == '<turn role="user">see \\1this><image:0><audio:1></turn>\n<turn role="assistant">see \\1this><image:2><audio:3></turn>\n'
    assert [(a["number"], a["uri"], a["tokens"]) for a in r["attachments"]] == [(0, "u1", 3), (1, "u2", 3), (2, "u1", 3), (3, "u2", 3)]
    assert r["expanded_tokens"] == 12 and len(r["loss"]) == 1
    s = r["loss"][0]
    assert r["formatted"][s["start"] : s["start"] + s["length"]] == "see \\1this><image:2><audio:3>"


def test_chat_empty_and_long(spark):
    e = spark.createDataFrame([], "conv_id long, turn long, role string, text string, formatted string, loss string")
    assert [r["conv_id"] for r in chat.digests(e).collect()] == [-7]
    long_ = "<\\" * 200_000
    d = spark.createDataFrame([(1, 0, "assistant", long_)], "conv_id long, turn long, role string, text string")
    assert chat.digests(d).where("conv_id = 1").first()["loss_sha256"] == hashlib.sha256(long_.encode()).hexdigest()


def plain_targets(sizes, ratio=1.5, cap=2.0):
    """The shares, by the rule as it is told: again and again, the excess over a cap goes to the others by weight."""
    w = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    goal = ratio * sum(sizes)
    while free:
        level = (goal - sum(out[i] for i in range(len(sizes)) if i not in free)) / sum(w[i] for i in free)
        over = {i for i in free if level * w[i] > cap * sizes[i]}
        if not over:
            for i in free:
                out[i] = level * w[i]
            break
        for i in over:
            out[i] = cap * sizes[i]
        free -= over
    return out


def test_mixing_targets_and_takes(docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 2)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 16)
    rows = mixing.taken(docs).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.taken(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    names = sorted({s for s in source.values() if s}) + [None]
    sizes = [sum(r["size"] for r in rows if source[r["doc_id"]] == s) for s in names]
    for s, size, target in zip(names, sizes, plain_targets(sizes)):
        own = [r for r in rows if source[r["doc_id"]] == s]
        assert {r["source_size"] for r in own} == {size} and own[0]["target"] == pytest.approx(target)
        assert abs(sum(r["taken"] for r in own) - target) <= 1 and all(0 <= r["taken"] <= 2 * r["size"] for r in own)


def test_shards_hold_what_the_tree_drew(docs, monkeypatch):
    """Each shard's blocks of each source are as many as the leaf's quota, no block is drawn twice, and the mixed rows hold
    just their words."""
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 8)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 16)
    sized = docs.select("doc_id", mixing.source_key(F.col("source")).alias("_key"), mixing.n_words(F.col("text")).alias("size"))
    goals = mixing.targets(sized)
    quota = {r["_key"]: r["blocks"] for r in mixing.quotas(goals).collect()}
    base = docs.sparkSession.createDataFrame([(sorted(quota), [quota[k] for k in sorted(quota)])], "keys array<string>, q array<bigint>")
    levels = mixing.levels_for(sum(r["target"] for r in goals.collect()))
    tree = {(r["shard"], k): q for r in mixing.split_tree(base, levels).collect() for k, q in zip(r["keys"], r["q"]) if q}
    drawn = mixing.drawn_blocks(goals).collect()
    assert levels > 2 and {k: sum((b["shard"], b["_key"]) == k for b in drawn) for k in tree} == tree
    assert len({(b["_key"], b["pass"], b["block"]) for b in drawn}) == len(drawn) == sum(tree.values())
    words = {}
    for b in drawn:
        words[b["shard"], b["_key"]] = words.get((b["shard"], b["_key"]), 0) + b["_words"]
    got = {}
    for r in mixing.mixed_pieces(docs).collect():
        key = r["_run"]["shard"], "1" if r["source"] is None else "0" + r["source"]
        assert len(r["text"].split()) == r["_run"]["words"] and r["n_chars"] == len(r["text"])
        got[key] = got.get(key, 0) + r["_run"]["words"]
    assert got == words
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text"] in whole[r["doc_id"]] for r in mixing.mixed(docs).collect())


def test_blocks_are_permuted_by_the_seed(spark):
    """240 full blocks and a short one, drawn one and a half times: each pass has an order of its own, another seed others."""
    assert all(p % d for p in mixing.PRIMES for d in range(2, 46_341))
    size = 240 * mixing.BLOCK_WORDS + 5
    goals = spark.createDataFrame([("0a", size, 1.5 * size), ("0b", 3, 6.0), ("0c", mixing.BLOCK_WORDS, 1.0)], "_key string, source_size long, target double")

    def order(seed):
        rows = mixing.drawn_blocks(goals, seed).collect()
        assert len({(r["_key"], r["pass"], r["block"]) for r in rows}) == len(rows)
        assert sum(r["_words"] for r in rows if r["_key"] == "0a") == round(1.5 * size)
        out = {}
        for r in sorted(rows, key=lambda r: r["shard"]):
            if r["_key"] == "0a":
                out.setdefault(r["pass"], []).append(r["block"])
        return out

    one, two = order(1), order(2)
    assert sorted(one[0]) == list(range(241)) and 119 <= len(one[1]) <= 122 and 240 not in one[1]
    assert one == order(1) and set(one[1]) != set(two[1]) and set(one[1]) != set(range(len(one[1])))


def test_split_tree_is_exact(spark):
    q = [1000, 3, 0, 77, 20_000]
    base = spark.createDataFrame([(list("abcde"), q)], "keys array<string>, q array<bigint>")
    leaves = [r["q"] for r in mixing.split_tree(base, 5, seed=3).collect()]
    assert len(leaves) == 32 and [sum(x) for x in zip(*leaves)] == q
    assert max(map(sum, leaves)) - min(map(sum, leaves)) <= 1 and min(map(min, leaves)) >= 0
    assert len({x[0] for x in leaves}) > 5


def test_hypergeometric_moments(spark):
    """Mean and variance of the draws over many uniforms."""
    n_all, marked, drawn = 60, 25, 30
    e = mixing._hypergeometric(str(n_all), str(marked), str(drawn), "((id + 0.5d) / 2000)")
    r = spark.range(2000).selectExpr(f"{e} as x").selectExpr("avg(x)", "var_pop(x)", "min(x)", "max(x)").first()
    p = marked / n_all
    assert r[0] == pytest.approx(drawn * p, abs=0.02) and r[1] == pytest.approx(drawn * p * (1 - p) * (n_all - drawn) / (n_all - 1), rel=0.03)


def test_mixing_odd_rows(odd, empty):
    rows = mixing.taken(odd).collect()
    assert len(rows) == odd.count() and all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.taken(empty).count() == 0
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and mixing.mixed(empty).count() == 0
    total = sum(len((r["text"] or "").split()) for r in out.collect())
    assert abs(total - sum(r["taken"] for r in rows)) <= 2
