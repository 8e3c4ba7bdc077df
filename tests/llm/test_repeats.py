import random
from collections import Counter

import numpy as np
import pytest

from hazecast.llm.repeats import _without, removed_repeats, repeated_starts, without_repeats


def slow(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        kept = bytes(c for c, gone in zip(t, mask, strict=True) if not gone)
        out.append((len(t), sum(mask), len([p for p in bytes(mask).split(b"\0") if p]), kept))
    return out


def answers(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


@pytest.mark.parametrize(("length", "gram", "crowd"), [(400, 128, 5000), (400, 128, 1), (20, 8, 5000), (20, 20, 2), (7, 1, 1)])
def test_against_brute_force(odd, odd_rows, length, gram, crowd):
    want = slow([(r[1] or "").encode() for r in odd_rows], length)
    got = answers(removed_repeats(odd, length, gram, crowd))
    assert got == sorted(((r[0], *w) for r, w in zip(odd_rows, want, strict=True)), key=str)


@pytest.mark.parametrize("crowd", [5000, 3])
def test_passages_with_different_surroundings(spark, crowd):
    draw = random.Random(2)

    def text(n):
        return "".join(draw.choice("abcdefghé ") for _ in range(n))

    passage, other = text(500), text(900)
    texts = [passage, text(300) + passage + text(100), passage[20:480] + text(700), other + "xyz" + other, other[100:]]
    texts += [text(399), passage[:399], passage[:400], "ab" * 700, "a" * 399] + [text(20) + passage + text(20) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, *w) for i, w in enumerate(slow([t.encode() for t in texts], 400))]
    assert answers(removed_repeats(docs, crowd=crowd)) == sorted(want, key=str)


def test_columns_of_the_transform_by_definition():
    draw = random.Random(4)
    window, length = 5, 6
    groups, segments, before = [], [], []
    for g in range(30):
        for _ in range(draw.randint(1, 6)):
            lo, starts = draw.randint(0, window - 1), draw.randint(1, window)
            starts = min(starts, lo + 1)
            groups.append(g)
            before.append(lo)
            segments.append(bytes(draw.choice(b"ab") for _ in range(starts - 1 + length)))
    hits = repeated_starts(np.array(groups), segments, np.array(before), length, window)
    strings = Counter()
    for g, s, b in zip(groups, segments, before, strict=True):
        for i in range(len(s) - length + 1):
            strings[g, window - 1 - b + i, s[i : i + length]] += 1
    for row, (g, s, b) in enumerate(zip(groups, segments, before, strict=True)):
        for column in range(window):
            i = column - (window - 1 - b)
            want = 0 <= i <= len(s) - length and strings[g, column, s[i : i + length]] > 1
            assert hits[row, column] == want


def test_spans_are_joined():
    assert _without(b"0123456789", None) == (b"0123456789", 0)
    assert _without(b"0123456789", [{"begin": 5, "stop": 7}, {"begin": 0, "stop": 2}, {"begin": 2, "stop": 3}]) == (b"34789", 2)


def test_rows_and_columns_stay(odd, odd_rows, none):
    out = without_repeats(odd, 20, 8)
    assert out.columns == odd.columns and out.count() == len(odd_rows)
    assert out.where("text is null").count() == sum(r[1] is None for r in odd_rows)
    assert out.where("n_chars <> length(text)").count() == 0
    for df in (without_repeats(none), removed_repeats(none)):
        assert df.count() == 0


def test_gram_is_checked(odd):
    with pytest.raises(ValueError, match="gram"):
        removed_repeats(odd, length=10, gram=11)
