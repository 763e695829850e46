import random

import numpy as np
import pytest

from etholake.llm import licences
from tests.llm.conftest import corpus, table


def test_families_are_found(spark):
    """Templates, also with lost words, within texts; texts without licences are unknown."""
    rng = np.random.default_rng(1)
    texts, want = [], []
    for i, t in enumerate(corpus(8, 120)):
        if i % 2:
            family = licences.FAMILIES[(i // 2) % len(licences.FAMILIES)]
            template = random.Random(i).choice(licences.TEMPLATES[family])
            t = t + "\n" + " ".join(w for w in template.split() if rng.random() > 0.05)
            want.append(family)
        else:
            want.append("unknown")
        texts.append(t)
    d = table(spark, texts)
    got = {r["doc_id"]: r for r in licences.scan(d, licences.fit(d)).collect()}
    assert np.mean([got[i]["family"] == w for i, w in enumerate(want)]) > 0.9
    assert all(got[i]["family"] == "unknown" for i, w in enumerate(want) if w == "unknown")


def test_words_of_licences_alone_are_no_licence(spark):
    d = table(spark, ["the permission to park was granted", "a licence to drive a car needs a test", *corpus(2, 30)])
    got = {r["doc_id"]: r["family"] for r in licences.scan(d, licences.fit(d)).collect()}
    assert got[0] == got[1] == "unknown"


def test_every_template_is_its_family():
    model = licences.train(corpus(1, 60))
    for family, templates in licences.TEMPLATES.items():
        for t in templates:
            found = model.classify(t)
            assert found and found[0] == family, t


def test_odd_rows(odd, empty):
    got = licences.scan(odd, licences.fit(odd)).collect()
    assert len(got) == odd.count()
    assert all(r["n_paragraphs"] == 0 and r["family"] == "unknown" for r in got if r["doc_id"] in (1, 2, 3))
    assert licences.scan(empty, licences.fit(empty)).count() == 0


def test_wrapped_and_near_families():
    """Wrapped notices are found as blocks, pieces without tell-tale words are classified, and lesser and Affero licences
    are not taken for the general one."""
    model = licences.train([line for t in corpus(1, 60) for line in t.split("\n")])
    mit = licences.TEMPLATES["MIT"][0].split()
    wrapped = "\n".join(" ".join(mit[i : i + 8]) for i in range(0, len(mit), 8))
    n, found = model.scan(["some words before\n\n" + wrapped + "\n\nsome words after"])[0]
    assert n == wrapped.count("\n") + 3 and {c[0] for c, _ in found} == {"MIT"}
    assert model.classify("with or without modification, are permitted provided that the following conditions are met")[0] == "BSD"
    for family, notice in (("LGPL", "This file is part of a library licensed under the GNU Lesser General Public License, version 3."), ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this server.")):
        assert (model.classify(notice) or (family,))[0] == family
    for other in licences.OTHERS[1::2]:
        assert model.classify(other) is None


def test_scan_equals_one_by_one():
    """Line by line, a scan gives what a plain softmax over the words and pairs of words gives."""
    texts = corpus(4, 30)
    texts[3] += "\nReleased under the MIT License.\n\n" + licences.TEMPLATES["BSD"][0]
    model = licences.train([line for t in texts for line in t.split("\n")])

    def plain(line):
        w = [licences.zlib.crc32(x.encode()) | 1 << 32 for x in licences._TOKEN.findall(line.lower())]
        pairs = [(a * 0x9E3779B97F4A7C15 + b) % 2**64 for a, b in zip(w, w[1:])]
        at = (licences.mix64(np.array(w + pairs, dtype=np.uint64)) & np.uint64((1 << licences.BITS) - 1)).astype(int)
        z = model.weights[at].sum(0) * 3 / max(1, len(at)) ** 0.5
        z[-1] += 1
        e = np.exp(z - z.max())
        return e / e.sum()

    for t, (n, found) in zip(texts, model.scan(texts)):
        lines = [x for x in t.split("\n") if x.strip()]
        assert n == len(lines)
        for i, line in enumerate(lines):
            p = plain(line)
            assert model.probabilities(line) == pytest.approx(p, abs=1e-4)
            if (own := model.classify(line)) is not None:
                assert (own[0], i) in [(c[0], j) for c, j in found]
