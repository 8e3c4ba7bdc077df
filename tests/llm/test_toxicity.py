import itertools
import math
import time

import numpy as np
import pytest

from hazecast.llm.toxicity import (
    DOUBLED, DROPPED, KINDS, LETTERS, LOST, MEANT, REPLACED, STRETCHED, Restorer, clean, fit, scored, trigram_counts,
)


@pytest.fixture(scope="module")
def corpus(spark):
    words = "the cat sat on mat while other people were reading long books about distant rivers".split()
    draw = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(400):
        own = draw.choice(words, 30).tolist()
        toxic = i % 4 == 0
        if toxic:
            own[3], own[9] = draw.choice(["idiot", "stupid", "scumbag"], 2)
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(corpus):
    return fit(*corpus)


def test_trigrams_by_definition(spark):
    counts = trigram_counts(spark.createDataFrame([("aB a",), (None,), ("b",)], "text string"))
    a, b = LETTERS.index("a") + 1, LETTERS.index("b") + 1
    assert counts.shape == (KINDS,) * 3
    assert counts[0, a, b] == 1 and counts[a, b, 0] == 1 and counts[b, 0, a] == 1 and counts[0, 0, b] >= 1


@pytest.mark.parametrize(
    ("noisy", "word"),
    [("1d10t", "idiot"), ("iiidiooot", "idiot"), ("i.d.i.o.t", "idiot"), ("$tupid", "stupid"), ("stup1d!!", "stupid"), ("5cumb4g", "scumbag"),
     ("books", "books"), ("(rivers),", "rivers"), ("12345", "12345"), ("sat%%%", "sat"), ("", "")],
)
def test_words_are_restored(model, noisy, word):
    assert model.restorer.word(noisy) == word


def test_viterbi_finds_the_best_path():
    draw = np.random.default_rng(2)
    restorer = Restorer.from_counts(draw.integers(0, 50, (KINDS,) * 3).astype(float))

    def score(word):
        s = [0, 0, *(LETTERS.index(c) + 1 for c in word), 0]
        return sum(restorer.log[s[i], s[i + 1], s[i + 2]] for i in range(len(s) - 2))

    for noisy, paths in {"b1t": ["bit", "blt"], "1|": ["ii", "il", "li", "ll", "i", "l"], "9o0": ["goo"]}.items():
        assert restorer.restored(noisy) == max(paths, key=score)


def best_by_enumeration(restorer, noisy):
    """Total of the best path among all: every character kept, replaced or dropped."""
    ways = []
    for char in noisy:
        own = [(char, 0.0)] if char.isalpha() else [(m, REPLACED) for m in MEANT.get(char, "")]
        ways.append([*own, (None, None)])
    totals = {}
    for path in itertools.product(*ways):
        total, kept = 0.0, [0, 0]
        for i, (own, cost) in enumerate(path):
            kind = LETTERS.find(noisy[i]) + 1
            if own is not None:
                kept.append(LETTERS.find(own) + 1)
                total += cost + restorer.log[kept[-3], kept[-2], kept[-1]]
            elif kind and kind == kept[-1]:
                total += STRETCHED if noisy[i] * 3 in noisy[max(0, i - 2) : i + 3] else DOUBLED
            else:
                total += LOST if noisy[i].isalnum() else DROPPED
        total += restorer.log[kept[-2], kept[-1], 0]
        word = "".join(own for own, _ in path if own is not None)
        totals[word] = max(total, totals.get(word, -math.inf))
    found = {w: t for w, t in totals.items() if w} or totals
    return found


@pytest.mark.parametrize("spread", [1, 50, 10**9])
def test_restored_words_by_enumeration(spread):
    """The pruned search finds a best path, under flat and under steep character models."""
    draw = np.random.default_rng(spread)
    restorer = Restorer.from_counts(np.floor(spread ** draw.random((KINDS,) * 3)))
    alphabet = list("aabe101$|.-éд!")
    for _ in range(60):
        noisy = "".join(draw.choice(alphabet, int(draw.integers(0, 8))))
        noisy = noisy.replace("a", "a" * int(draw.integers(1, 4)), 1)
        found = best_by_enumeration(restorer, noisy)
        assert found[restorer.restored(noisy)] == pytest.approx(max(found.values()), abs=1e-6), noisy


def test_long_noisy_words_take_linear_time(model):
    draw = np.random.default_rng(3)
    word = "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz0123456789+/"), 200_000))
    begun = time.perf_counter()
    assert len(model.restorer.restored(word)) > 100_000
    assert time.perf_counter() - begun < 20


def test_other_scripts_stay(model):
    assert model.restorer.word("дур-ак") == "дурак"
    assert model.restorer.word("głup.i") == "głupi"
    assert model.restorer.word("_дурак_") == "дурак"


def test_spaced_letters_are_joined(model):
    assert "idiot" in model.restorer.words("he is an i d i o t really", {})
    assert "stupid" in model.restorer.words("so s-t-u-p-i-d is that", {})


def test_held_out_accuracy_and_disguise(spark, corpus, model):
    docs, labels = corpus
    got = scored(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 40 and (got.toxic == got.predicted).mean() >= 0.97
    hidden = spark.createDataFrame([(1, "the 1d10t was stuuupid"), (2, "the cat sat on a mat"), (3, None), (4, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in scored(hidden, model).collect()}
    assert rows[1].predicted == 1 and rows[2].predicted == rows[3].predicted == rows[4].predicted == 0
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in rows.values())


def test_odd_rows(spark, odd, none, model):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (3, 1)], "doc_id long, toxic int")
    assert scored(odd, fit(odd, labels)).count() == odd.count()
    assert scored(odd, fit(odd, labels.limit(0))).where("predicted = 1").count() == 0
    assert scored(none, model).count() == 0 and fit(none, labels).odds == {}
    assert clean(odd, model).columns == odd.columns
