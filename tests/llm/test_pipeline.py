"""The pipeline's stages against brute force, and the registered queries on the smallest data."""

import pytest

import helpers as h

import __spark_entry__ as entry
import corpus_pipeline
from evidara.llm import decontamination, mixing, toxicity
from evidara.llm.common import stash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stash(stage(spark, docs, SF))
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_the_columns(stages):
    assert [name for name, *_ in stages] == ["toxicity", "minhash_near_dedup", "substring_dedup", "decontamination", "mixing"]
    assert all(after.columns == COLUMNS for _, _, after in stages[:-1])


def test_toxic_documents_go(spark, stages):
    _, before, after = stages[0]
    said = toxicity.toxicity(before, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert sorted(d for d, _ in _rows(after)) == sorted(r.doc_id for r in said if not r.predicted)


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    want = [d for d, _, _, kept in h.near_duplicates(_rows(before), 5, 80) if kept]
    assert sorted(d for d, _ in _rows(after)) == sorted(want)


def test_repeated_passages_go(stages):
    _, before, after = stages[2]
    want = {d: (removed, digest) for d, _, removed, digest in h.word_removal(_rows(before), 13)}
    texts = dict(_rows(before))
    for d, t in _rows(after):
        assert (t == texts[d]) if not want[d][0] else h.sha(t.encode()) == want[d][1]
    assert len(want) == after.count()


def test_contaminated_documents_go(spark, stages):
    _, before, after = stages[3]
    said = decontamination.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert sorted(d for d, _ in _rows(after)) == sorted(r.doc_id for r in said if not r.contaminated)


def test_sample_follows_the_mixture(stages):
    _, before, after = stages[4]
    said = mixing.mixture(before).collect()
    assert sorted(d for d, _ in _rows(after)) == sorted(r.doc_id for r in said if r.selected)


def test_run_is_its_stages(spark, stages):
    assert h.same(_rows(corpus_pipeline.run(spark, SF)), _rows(stages[-1][2]))


def test_pipeline_of_nothing_and_of_odd_rows(spark, tmp_path):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, key string, tokens int"
    odd = [(None, None, None, None, None, None, None), (1, "", "en", "a", 0, "x", 1), (1, "", "en", "a", 0, "x", 1), (2, h.LONG, "en", None, 5, None, 2),
           (3, "short text", None, "b", 10, "y", 3), (3, "short text", None, "b", 10, "y", 3)]
    for rows in ([], odd):
        where = str(tmp_path / f"data{len(rows)}")
        spark.createDataFrame(rows, kinds).write.parquet(f"{where}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
        spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
        docs = spark.read.parquet(f"{where}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stash(stage(spark, docs, where))
            assert docs.columns == [k.split()[0] for k in kinds.split(", ")] and docs.count() == len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, where).count() <= len(rows)


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
