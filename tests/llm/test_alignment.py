"""Alignment against a plain walk over both tokenisers' tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from etholake.llm import alignment, bpe
from tests.llm.conftest import table

A = Tokenizer.from_file(bpe.default_path())
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
_VALUE = {c: b for b, c in enumerate(bpe.byte_characters())}
TEXTS = ["hello world", "hello world", "onesen erblest it hein", "x" * 3000, "<|endoftext|> <s> a  b</s>", "with ▁ inside", "漢字かな🙂 é", " leading", "trailing ", "a\nb\tc", "<0x41> is text", " ".join("a" * i for i in range(40))]


def sides(text):
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(_VALUE[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (list(zip(a, a_bytes)), list(zip(b, b_bytes))) if b"".join(a_bytes) == whole == b"".join(b_bytes) else ([], [])


def groups(a, b):
    out, ca, cb, na, nb = [], [], [], 0, 0
    a, b = a[::-1], b[::-1]
    while a or b:
        if na <= nb:
            i, x = a.pop()
            ca.append(i)
            na += len(x)
        else:
            i, x = b.pop()
            cb.append(i)
            nb += len(x)
        if na == nb and ca and cb:
            out.append((ca, cb))
            ca, cb = [], []
    return out


def brute(rows):
    each = []
    for d, t in rows:
        a, b = sides(t) if t else ([], [])
        each.append((d, len(a), len(b), groups(a, b)))
    linked = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for *_, g in each]
    held = Counter(p for c in linked for p in c)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (d, na, nb, g), c in zip(each, linked):
        text = ";".join("|".join(",".join(map(str, s)) for s in x) for x in g)
        out.append((d, na, nb, len(g), sum(c.values()), sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items()), hashlib.sha256(text.encode()).hexdigest() if na else ""))
    return sorted(map(str, out))


def check(d, **more):
    assert sorted(str(tuple(r)) for r in alignment.digests(d, **more).collect()) == brute([(r["doc_id"], r["text"]) for r in d.collect()])


@pytest.mark.parametrize("broadcast_pairs", [0, alignment.BROADCAST_PAIRS])
def test_alignment(spark, broadcast_pairs):
    check(table(spark, TEXTS).repartition(3), broadcast_pairs=broadcast_pairs)


def test_corpus(docs):
    check(docs)


def test_odd_rows(odd, empty):
    check(odd)
    assert alignment.digests(empty).count() == 0


def test_groups_and_links(spark):
    """The operator's own rows: groups cover all ids in order; pairs, times and more add up to all links."""
    for r in alignment.aligned(table(spark, TEXTS)).collect():
        assert [i for g in r["groups"] for i in g["a"]] == r["a_ids"] and [i for g in r["groups"] for i in g["b"]] == r["b_ids"]
        got = Counter({p: n for p, n in zip(r["pairs"], r["times"])})
        for m in r["more"]:
            got[m["pair"]] += m["times"]
        assert got == Counter(x << 32 | y for g in r["groups"] for x in g["a"] for y in g["b"]) and r["n_links"] == sum(got.values())


def test_a_group_that_repeats_ids_stays_small(spark):
    """Two thousand by two thousand links of one pair are one entry."""
    packed = lambda ends: [e << 32 | i + 1 for i, e in enumerate(ends)]
    a, b = [*range(1, 3999, 2), 4001], [*range(2, 4000, 2), 4001]
    tokens = spark.createDataFrame([(1, [7] * 2000, a, packed(a), [9] * 2000, b, packed(b))], "doc_id long, " + alignment.TOKENS)
    r = alignment.links(alignment.cut(tokens)).first()
    assert r["n_links"] == 4_000_000 and r["pairs"] == [7 << 32 | 9] and [tuple(m) for m in r["more"]] == [(7 << 32 | 9, 3_999_999)]


def test_a_repeated_stretch_is_aligned_once(spark):
    """Ten thousand documents of the same few words: their tokens reach the alignment once for each of its rows, not for each document."""
    d = spark.range(10_000).selectExpr("id as doc_id", "repeat('hello wörld, onesen  erblest ', 20) as text").coalesce(2)
    rows = alignment.stretches(d).collect()
    assert sum(len(r["texts"]) for r in rows) == 10_000 and len(rows) < 10 and all(0 < len(r["words"]) <= 4 for r in rows)
    assert alignment.digests(d).groupBy("n_a", "n_links", "count_sum", "groups_sha256").count().collect()[0]["count"] == 10_000


def test_stretches_between_all_kinds_of_spaces(spark):
    """A stretch ends only where both tokenisers begin anew; also with each text by itself."""
    rng = random.Random(3)
    parts = [" ", " ", "  ", "   ", "\n", "\n ", " \n", "\t", "\r\n", "\u00a0", "\u3000", "\u0085", "\x1c", "\u200b", "'s", "'", "it", "12", "word", "é", "漢字", "▁", "\u0301", "🙂", ",", "<|endoftext|>", "<s>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(600)]
    check(table(spark, texts).repartition(3), together=0)
