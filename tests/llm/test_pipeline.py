"""The corpus pipeline stage by stage and as a whole."""

import collections
import os
import uuid

import pytest
from pyspark import cloudpickle

import corpus_pipeline as pipeline
from citymill.llm import bpe, common, mixing, toxicity

BIG = "/root/testdata/sf0.01"  # enough labels to learn from
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage over the small tables."""
    folder, sf_dir, out = tmp_path_factory.mktemp("stages"), BIG, []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        done = spark.read.parquet(f"{folder}/{k}")
        out.append((name, docs.collect(), done.collect(), done.columns))
        docs = done
    return out


def test_stages_are_named_and_keep_columns(stages):
    assert [s[0] for s in stages] == ["toxicity", "near_duplicates", "private_data", "source_mix", "byte_bpe"]
    assert all(s[3] == COLUMNS for s in stages[:-1])


def test_decisions_take_effect(stages):
    _, before, after, _ = stages[0]
    assert 0.7 * len(before) < len(after) < len(before) and not any("idiot" in r.text and "moron" in r.text for r in after)
    _, before, after, _ = stages[1]
    assert len({r.text for r in before}) >= len(after) and len({r.text for r in after}) == len(after)
    _, before, after, _ = stages[2]
    assert len(before) == len(after) and sum(a.text != b.text for a, b in zip(sorted(before), sorted(after), strict=True)) > 0
    _, before, after, _ = stages[3]
    times = collections.Counter(r.doc_id for r in after)
    assert max(times.values()) <= 2 and set(times) <= {r.doc_id for r in before}
    by = collections.Counter()
    for r in before:
        by[r.source] += len(r.text.split(" "))
    _, before, after, _ = stages[4]
    path, pattern = bpe.vocabulary()
    own = bpe.encoder(path, pattern)
    expected = collections.Counter((r.doc_id, tuple(next(own.encode([r.text]))[0])) for r in before)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in after) == expected and all(r.round_trip for r in after)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    rows = pipeline.run(spark, BIG).collect()
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in rows) == collections.Counter((r.doc_id, tuple(r.ids)) for r in stages[-1][2])


def test_stages_on_odd_rows(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, "en", None, None), (2, "", "en", "a", 0), (3, "one two three", "en", "a", 13), (3, "one two three", "en", "a", 13), (None, "no id", "en", "b", 5), (None, "no id", "en", "b", 5), (4, "w " * 3000, "en", "b", 6000)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            n = out.count()
            assert n <= 2 * docs.count() and (name in ("byte_bpe",) or out.columns == COLUMNS)
            if name == "near_duplicates" and docs.count():
                assert n == 6
            if name == "source_mix" and docs.count():
                taken = collections.Counter((r.doc_id, r.text) for r in out.collect())
                assert all(t <= 2 * rows.count(next(x for x in rows if x[:2] == key)) for key, t in taken.items())
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0


def test_toxicity_index_is_made_by_tasks(spark, sf_dir, monkeypatch):
    """The driver has no room for the examples' words or the index: it passes bytes on."""

    def refuse(*_):
        raise AssertionError("the driver builds the index")

    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    want = {r.doc_id: r.score for r in toxicity.judge(docs, toxicity.train(docs, labels)).collect()}
    for name in ("__init__", "_build", "__setstate__"):
        monkeypatch.setattr(toxicity.Index, name, refuse)
    assert {r.doc_id: r.score for r in toxicity.op5_toxic_neighbours(spark, sf_dir).collect()} == want
    assert pipeline.reject_toxic(spark, docs, sf_dir).count() == sum(s < 0.5 for s in want.values())


def test_workers_drop_the_index_with_each_task(spark, sf_dir, tmp_path):
    """Workers are taken in turn, so one that waits would hold an index for nothing."""
    folder = str(tmp_path)

    class Marked:
        ids, labels, live = (), (), False

        def mark(self, what):
            open(f"{folder}/{what}-{uuid.uuid4()}", "w").close()

        def __getstate__(self):
            return {"live": True}

        def __setstate__(self, state):
            self.__dict__.update(state)
            self.mark("read")

        def __del__(self):
            if self.live:
                self.mark("dropped")

        def nearest_of(self, texts):
            return [[] for _ in texts]

        def score(self, found):
            return 0.5

    docs = common.read(spark, sf_dir, "documents").repartition(6)
    judged = toxicity.judge(docs, toxicity.Packed(cloudpickle.dumps(Marked())), evidence=False)
    assert {r.predicted for r in judged.select("predicted").collect()} == {1}
    marks = collections.Counter(name.split("-")[0] for name in os.listdir(folder))
    assert marks["read"] == marks["dropped"] > 0


def test_toxicity_postings_hold_rare_terms_once(spark):
    """Common terms are in the matrix; their postings beside it would be held twice."""
    docs, labels = common.read(spark, BIG, "documents"), common.read(spark, BIG, "labels")
    index = toxicity.train(docs, labels)
    assert 0 < len(index.rows) == len(index.values) == int((index.of >= len(index.dense)).sum()) < len(index.of)
    assert sum(len(rows) for blocks in index.postings.values() for rows, _ in blocks.values()) == len(index.of)
