import zlib

import numpy as np
from pyspark.sql import functions as F

from etholake.llm import queries, toxicity
from tests.llm.conftest import corpus, table, words


def _labelled(spark):
    import random

    rng = random.Random(3)
    base, bad = corpus(5, 400), ["grumble", "snarlix", "vexator", "blightor"]
    texts, toxic = [], []
    for i, t in enumerate(base):
        w = t.split(" ")
        if i % 2:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts.append(" ".join(w))
        toxic.append(i % 2)
    return table(spark, texts), spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)] + [(None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int"), toxic


def test_held_out_accuracy(spark, tmp_path):
    docs, labels, toxic = _labelled(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = queries.op1_toxicity(spark, str(tmp_path)).toPandas()
    assert len(got) == 400
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    out = got[got.held_out]
    assert (out.predicted == [toxic[d] for d in out.doc_id]).mean() > 0.9
    assert ((got.score >= 0) & (got.score <= 1)).all()


def test_whole_texts_count(spark):
    docs, labels, _ = _labelled(spark)
    model = toxicity.fit(docs, labels)
    plain = " ".join(corpus(9, 30))
    a, b = model.score([plain, plain + " grumble vexator snarlix blightor"])
    assert b > a


def test_odd_rows(spark, odd, empty, labels):
    model = toxicity.fit(odd, labels)
    assert toxicity.score(odd, model).where("score is null").count() == 0
    assert toxicity.score(odd, model).count() == odd.count()
    assert toxicity.without_toxic(odd, model).columns == odd.columns
    none = toxicity.fit(empty, labels.limit(0))
    assert toxicity.score(empty, none).count() == 0
    assert set(np.array(none.score(["a", None, ""]))) == {0.0}
    assert odd.withColumn("x", F.lit(1)).count() == toxicity.score(odd.withColumn("x", F.lit(1)), none).count()
    assert words


def test_without_labels(spark, docs, labels):
    """No labels, or one class only: a constant score."""
    for some in (labels.limit(0), labels.where("toxic = 0")):
        model = toxicity.fit(docs, some)
        assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    assert np.array_equal(model.score([None, ""]), [0.0, 0.0])


def test_driver_trains_nothing(spark, monkeypatch):
    """A task trains: the driver gets the model and no texts."""
    docs, labels, _ = _labelled(spark)

    def here(*_):
        raise AssertionError("trained in the driver")

    monkeypatch.setattr(toxicity.ToxicityModel, "calibrate", here)
    model = toxicity.fit(docs, labels)
    monkeypatch.undo()
    rows = [(r["text"], r["toxic"]) for r in docs.join(labels.where("doc_id is not null and toxic is not null"), "doc_id").collect()]
    assert model.calibration is not None and model.score([rows[1][0]])[0] != 0.5
