import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from etholake.llm import packing
from tests.llm.conftest import corpus, table


def check(d):
    """Every id in one piece, sequences without gaps; returns the tokens of padding."""
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = defaultdict(list)
    for r in d.select("doc_id", "text").collect():
        want[r["doc_id"]].append([*exact.encode(r["text"] or "", add_special_tokens=False).ids, 1])
    rows = packing.pack_documents(d).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(want)
    for doc_id, own in want.items():
        assert sum(r["length"] for r in pieces[doc_id]) == sum(map(len, own))
        for r in pieces[doc_id]:
            a, b = r["start"], r["start"] + r["length"]
            fits = [ids for ids in own if len(ids) == r["doc_tokens"] and zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()) == r["ids_crc32"]]
            assert fits and r["length"] > 0
        if len(own) == 1:
            at = 0
            for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
    padded = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and len({r["tier"] for r in s}) == 1
        padded += (at if at & (at - 1) == 0 else 2048) - at
    return padded


def test_pieces(docs):
    check(docs)


def test_padding_is_little(spark):
    # a split's end leaves one short sequence at most, whatever the split's size
    assert check(table(spark, corpus(3, 600)).repartition(2)) < 2 * 2048


def test_odd_rows(odd, empty):
    check(odd)
    assert packing.pack_documents(empty).count() == 0


def test_same_ids_by_either_library():
    ids = packing.default_ids()
    for t in corpus(9, 80) + ["", " ", "a  b\n\n c", "x y é ü", "tab\tand\r\nline", "<|endoftext|>", "漢字 mixed 🙂", "can't won't I'll", "1234567 12.5%"]:
        assert ids(t).tolist() == [*ids.exact(t).tolist(), 1], t


def test_step_groups_are_balanced(spark):
    rows = packing.pack_documents(table(spark, corpus(4, 400)).coalesce(1)).groupBy("sequence_id", "step_id", "tier").agg(F.sum("length")).groupBy("step_id").agg(F.sum("tier").alias("n"), F.countDistinct("tier").alias("tiers")).collect()
    assert all(r["tiers"] == 1 and r["n"] <= packing.STEP_TOKENS for r in rows)
    assert sum(r["n"] < packing.STEP_TOKENS for r in rows) <= 12
