import numpy as np

from hazecast.llm.common import held_out
from hazecast.llm.language import Filter, _letters, _slot, HASHES, fit, identified, ngrams


def test_ngrams_by_definition():
    texts = ["Ab c", "", "1!", "dé"]
    hashes, owner = ngrams(texts, _letters())
    grams = [ngrams([w], _letters())[0].tolist() for w in ("ab", "c", "dé")]
    assert sorted(hashes.tolist()) == sorted(sum(grams, []))
    assert set(owner.tolist()) == {0, 3}
    # blank-ab-blank: " a" "ab" "b " " ab" "ab " " ab "
    assert len(grams[0]) == 6 and len(grams[1]) == 3


def test_filters_hold_all_their_ngrams_and_few_others():
    draw = np.random.default_rng(1)
    sets = [draw.integers(0, 1 << 64, 2000, np.uint64) for _ in range(3)]
    masks = np.zeros(1 << 16, np.uint64)
    for i, own in enumerate(sets):
        for k in range(HASHES):
            masks[_slot(own, k, len(masks))] |= np.uint64(1 << i)
    model = Filter(["a", "b", "c"], masks, np.zeros(3), np.ones(3))
    for i, own in enumerate(sets):
        assert ((model.votes(own) >> np.uint64(i)) & np.uint64(1)).all()
    strange = model.votes(draw.integers(0, 1 << 64, 20_000, np.uint64))
    expected = np.mean([((masks >> np.uint64(i)) & np.uint64(1)).mean() ** HASHES for i in range(3)])
    found = np.mean([((strange >> np.uint64(i)) & np.uint64(1)).mean() for i in range(3)])
    assert abs(found - expected) < 0.002


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = identified(docs, fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 20 and (got.lang == got.lang_pred).mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_odd_rows_and_no_teachers(spark, odd, none):
    rows = {r.doc_id: r for r in identified(odd, fit(odd)).collect()}
    assert rows[0].lang_pred == rows[1].lang_pred == rows[2].lang_pred == "und" and rows[0].score == 0
    assert identified(odd, fit(odd)).count() == odd.count()
    assert {r.lang_pred for r in identified(odd, fit(none)).collect()} == {"und"}
    assert identified(none, fit(odd)).count() == 0


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, "zz yy xx" if i % 2 else "aa bb cc", "a" if i % 2 else "b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("out", held_out())
    false = docs.selectExpr("doc_id", "CASE WHEN out THEN 'qq qq qq' ELSE text END AS text", "lang")
    assert (fit(false).masks == fit(docs.where("not out").drop("out")).masks).all()
