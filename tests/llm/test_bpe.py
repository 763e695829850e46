import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from etholake.llm import bpe
from tests.llm.conftest import corpus

LIBRARY = Tokenizer.from_file(bpe.default_path())
TEXTS = [
    "", "a", " ", "  two  spaces ", "\n\n \t x\r\n", "it's we'll I'LL don't", "x" * 5000, "ab" * 301, " " * 4000, "é" * 800, "x" * bpe.LONG, "x" * (bpe.LONG + 1),
    "<|endoftext|>", " <|endoftext|><|endoftext|>x<|endoftext", "<|endoftext|> <|ENDOFTEXT|>", "漢字かな交じり文🙂" * 90, "\x00\x01\x1c\x85\xa0 ", "①²½ ªº ʰ", "1234567 12.5%",
]


def ids_of(encoder, texts):
    flat, n = encoder(texts)
    return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]


def want(texts):
    return [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_are_those_of_the_library():
    encoder = bpe.Encoder(bpe.default_path())
    texts = TEXTS + corpus(3, 80)
    for _ in range(2):  # the second time from the words that it has met
        assert ids_of(encoder, texts) == want(texts)


def test_long_words_of_many_letters():
    rng = random.Random(5)
    texts = ["".join(rng.choice(a) for _ in range(n)) for a in ("ab", "abcdefgh", "etaoin shrdlu", "éaü") for n in (300, 4000)]
    assert ids_of(bpe.Encoder(bpe.default_path()), texts) == want(texts)


def test_both_ways_of_merging_agree():
    v, rng = bpe.Vocabulary(bpe.default_path()), random.Random(6)
    for _ in range(200):
        word = v.byte_ids[[rng.choice(b"aab tehin") for _ in range(rng.randint(1, 60))]]
        one, n = bpe.merge_rounds(v, word.copy(), np.array([len(word)]))
        assert one.tolist() == bpe.merge_long(v, word).tolist() and n.tolist() == [len(one)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ids_of(bpe.Encoder(bpe.default_path()), texts) == want(texts) if texts else True


def test_words_are_begun_anew(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_IDS", 50)
    encoder = bpe.Encoder(bpe.default_path())
    for t in corpus(4, 12):
        assert ids_of(encoder, [t, "<|endoftext|>"]) == want([t, "<|endoftext|>"])


def test_decoding_as_the_library():
    v, rng = bpe.Vocabulary(bpe.default_path()), random.Random(7)
    rows = [[rng.randrange(50257) for _ in range(rng.randint(0, 12))] for _ in range(300)]
    got = bpe.decode_ids(v, np.array([i for r in rows for i in r]), np.array([len(r) for r in rows]))
    assert got == LIBRARY.decode_batch(rows, skip_special_tokens=False)
    assert bpe.decode_ids(v, np.array([-1, 64, 10**6]), np.array([2, 1])) == [LIBRARY.decode([64]), ""]


def test_special_strings_as_plain_text():
    plain = Tokenizer.from_file(bpe.default_path())
    plain.encode_special_tokens = True
    text = "a<|endoftext|> b"
    assert ids_of(bpe.Encoder(bpe.default_path(), special=False), [text]) == [plain.encode(text, add_special_tokens=False).ids]


def test_vocabularies_that_rounds_cannot_merge(tmp_path):
    import json

    with open(bpe.default_path(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    path = tmp_path / "reversed.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(path))


def check(d):
    got = sorted(map(str, (tuple(r) for r in bpe.digests(d).collect())))
    out = []
    for r in d.select("doc_id", "text").collect():
        ids = want([r["text"]])[0]
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        assert back == (r["text"] or "")
        out.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(map(str, out))


def test_digests(docs):
    check(docs)


def test_odd_rows(odd, empty):
    check(odd)
    assert bpe.digests(empty).count() == 0
    # other columns pass, one of the same name is replaced
    d = bpe.encode(odd.withColumn("ids", F.lit("clash")))
    assert d.columns == [*odd.columns, "ids"] and d.where("doc_id = 5").select("ids", "score").distinct().count() == 1
