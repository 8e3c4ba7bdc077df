import corpus_pipeline
import pytest

from hazecast.session import new_folder


@pytest.fixture(scope="module")
def steps(spark, small):
    """Rows before and after every stage."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(steps):
    assert [s.columns for s in steps[:-1]] == [steps[0].columns] * 5
    assert {"doc_id", "text", "ids", "n_tokens", "round_trip"} <= set(steps[-1].columns)


def test_toxic_documents_go_and_clean_ones_stay(spark, small):
    larger = small.replace("sf0.001", "sf0.01")  # a handful of toxic documents teaches no word
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    kept = [r.toxic for r in corpus_pipeline.without_toxic(spark, docs, larger).join(labels, "doc_id").collect()]
    toxic = [r.toxic for r in labels.collect()]
    assert kept.count(0) >= 0.98 * toxic.count(0) and kept.count(1) <= 0.4 * toxic.count(1)


def test_one_of_each_group_stays(steps):
    from hazecast.llm.simhash import near_duplicates

    want = {r.component_id for r in near_duplicates(steps[1]).collect()}
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(want)


def test_repeats_go(steps):
    from hazecast.llm.repeats import removed_repeats

    want = {r.doc_id: bytes(r.kept).decode(errors="ignore") for r in removed_repeats(steps[2]).collect()}
    assert {r.doc_id: r.text for r in steps[3].collect()} == want


def test_documents_come_as_often_as_they_are_taken(steps):
    from hazecast.llm.mixing import taken_words

    want = sum(r.copies for r in taken_words(steps[3]).collect())
    assert steps[4].count() == want
    assert set(steps[4].collect()) <= set(steps[3].collect())


def test_ids_decode(steps):
    assert steps[5].count() == steps[4].count() and steps[5].where("not round_trip").count() == 0


def test_run_and_empty_tables(spark, small, steps, tmp_path):
    assert corpus_pipeline.run(spark, small).count() == steps[5].count()
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        assert docs.count() == 0
