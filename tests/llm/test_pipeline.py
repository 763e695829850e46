"""The corpus pipeline, stage by stage, against plain versions."""

import pytest

import corpus_pipeline
from etholake.llm import _common, mixing, simhash, toxicity
from tests.llm.conftest import table
from tests.llm.test_suffixes import brute
from tests.llm.test_toxicity import _labelled


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    docs, labels, _ = _labelled(spark)
    docs.write.parquet(str(path / "documents.parquet"))
    labels.write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name == "packing":
            tokens = out.groupBy("doc_id", "doc_tokens").sum("length").collect()
            assert tokens and all(r["sum(length)"] % r["doc_tokens"] == 0 for r in tokens)
            continue
        assert out.columns == docs.columns
        out = out.cache()
        before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (docs, out))
        assert set(after) <= set(before)
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"), modulus=None)
            assert set(after) == {d for d, t in before.items() if model.score([t])[0] < 0.5} and len(after) < len(before)
        if name == "near_dedup":
            # copies go, whatever has no copy stays
            assert len(set(after.values())) == len(after) and set(after.values()) <= set(before.values())
        if name == "suffix_dedup":
            rows = sorted(before.items())
            assert {d: len((t or "").encode()) for d, t in after.items()} == {d: n - gone for (d, _), (n, gone, *_) in zip(rows, brute(rows)) if gone < n or not n}
        if name == "mixing":
            taken = sum(r["taken"] for r in mixing.taken(docs).collect())
            assert abs(sum(len(r["text"].split()) for r in out.collect()) - taken) <= 2
        docs = out


def test_run(spark, folder):
    mark = set(_common._WRITTEN)
    packed = corpus_pipeline.run(spark, folder)
    # of all that the stages wrote, the last one's input is left
    assert [p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in set(_common._WRITTEN) - mark] == ["pipeline-mixing"]
    assert packed.count() > 0


def test_stages_compose_without_writes(spark, folder):
    """No stage deletes what another's result, or another query, still reads."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one = corpus_pipeline.toxicity_stage(spark, docs, folder)
    classes = simhash.classes(simhash.with_fingerprints(one))
    two = corpus_pipeline.near_dedup_stage(spark, one, folder)
    three = corpus_pipeline.suffix_dedup_stage(spark, two, folder)
    four = corpus_pipeline.mixing_stage(spark, three, folder)
    assert corpus_pipeline.packing_stage(spark, four, folder).count() > 0
    assert classes.count() == one.count() >= two.count() >= three.count() > 0


def test_packing_takes_odd_rows(spark, odd, empty, folder):
    assert corpus_pipeline.packing_stage(spark, odd, folder).select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()
    assert corpus_pipeline.packing_stage(spark, empty, folder).count() == 0


def test_stages_take_odd_rows(spark, odd, empty, folder):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, folder).columns == odd.columns, name
        assert stage(spark, empty, folder).count() == 0, name
        # the mix takes a document up to twice
        assert stage(spark, table(spark, ["only one text here"]), folder).distinct().count() in (0, 1, 2), name
