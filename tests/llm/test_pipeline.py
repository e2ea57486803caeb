"""Each stage of the pipeline against a brute-force version on its own input, on whole tables at sf0.01."""

import brute
import corpus_pipeline
import pytest
from support import DIR, rows  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The frames that the stages got, written and read again, and what the last returned."""
    top = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{DIR}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], DIR).write.parquet(f"{top}/{i}")
        frames.append(spark.read.parquet(f"{top}/{i}"))
    return frames


def texts(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


def test_columns(stages):
    assert [f.columns for f in stages[1:-1]] == [stages[0].columns] * 4


def test_quality(stages):
    docs = [tuple(r) for r in stages[0].select("doc_id", "text", "lang", "source").collect()]
    kept = brute.quality_kept(docs)
    assert sorted(texts(stages[1])) == sorted((i, t) for i, t, _, _ in docs if kept[i])
    assert 0 < sum(kept.values()) < len(kept)


def test_lines(stages):
    want = brute.line_dedup(texts(stages[1]))
    assert dict(texts(stages[2])) == {i: t for i, (_, _, t) in want.items()}


def test_near(stages):
    docs = texts(stages[2])
    group = brute.near(docs, 5)
    assert sorted(texts(stages[3])) == sorted((i, t) for i, t in docs if group[i][2])
    assert stages[3].count() < len(docs)


def test_benchmark(stages, rows):
    docs = texts(stages[3])
    want = brute.cut_overlaps(docs, rows("benchmark", "item_id", "text"))
    assert sorted(texts(stages[4])) == sorted(want) and set(want) != set(docs)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_packing_and_run(spark, stages):
    got = [r.asDict() for r in stages[5].collect()]
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(brute.words(t)) for i, t in texts(stages[4])}
    assert len(got) == stages[4].count()
    batches = {}
    for r in got:
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for rs in batches.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
        assert len(rs) == 1 or len(rs) * rs[0]["bucket_length"] <= 16_384
    key = lambda r: tuple(r[c] for c in sorted(r))
    assert sorted(map(key, got)) == sorted(key(r.asDict()) for r in corpus_pipeline.run(spark, DIR).collect())
