import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazecast.llm.quality import ERROR, METRICS, REACH, filtered, judged, sketches, text_stats, thresholds


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeated = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside), len(lines)


@given(st.text(alphabet="ab #|\n\t é\x0b", max_size=120))
@settings(deadline=None, max_examples=300)
def test_figures_by_definition(text):
    assert text_stats(text) == slow(text)


def test_rows_against_brute_force(odd, odd_rows, none):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in judged(odd).collect()}
    want = set()
    for row in odd_rows:
        n, chars, symbols, dup, rep, _ = slow(row[1] or "")
        want.add((row[0], n, chars, symbols, dup, rep, n < 10 or 100 * rep > 20 * n))
    assert got == want
    assert judged(odd).count() == len(odd_rows)
    assert judged(none).count() == 0 and filtered(none).columns == none.columns


def slow_verdicts(rows, least):
    """(doc_id, kept) by sorted lists of rounded values per group."""
    base, measured = math.log((1 + ERROR) / (1 - ERROR)), []
    for doc_id, text, lang, source, *_ in rows:
        stats = dict(zip(["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"], slow(text or ""), strict=True))
        failed = stats["n_words"] < 10 or 100 * stats["n_repeat_words"] > 20 * stats["n_words"]
        values = {m: stats[a] / stats[b] for m, (a, b, _, _) in METRICS.items() if stats[b]}
        measured.append((doc_id, lang, source, failed, values))
    held = defaultdict(list)
    for _, lang, source, failed, values in measured:
        for metric, v in values.items() if not failed else ():
            near = math.exp(math.ceil(math.log(v) / base) * base) * (1 - ERROR) if v else 0.0
            for group in {(lang, source), (lang, "*"), ("*", "*")}:
                held[group, metric].append(near)
    out = []
    for doc_id, lang, source, failed, values in measured:
        keep = not failed
        for metric, v in values.items() if keep else ():
            choices = [held[g, metric] for g in [(lang, source), (lang, "*")] if len(held[g, metric]) >= least]
            ranked = sorted((choices or [held[("*", "*"), metric]])[0])
            q1, q3 = (ranked[math.ceil(share * len(ranked)) - 1] for share in (0.25, 0.75))
            _, _, floor, both = METRICS[metric]
            reach = REACH * max(q3 - q1, floor)
            keep &= v <= q3 + reach and (not both or v >= q1 - reach)
        out.append((doc_id, keep))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [2, 6, 200])
def test_verdicts_against_brute_force(spark, odd, odd_rows, least):
    draw = np.random.default_rng(least)
    plain = "some words of very common length stand here in many texts today".split()
    strange = ["incomprehensibilities", "##", "a"]
    more = []
    for i in range(60):
        words = draw.choice(plain, 40).tolist() + draw.choice(strange, 30 * (i % 6 == 0)).tolist()
        text = " ".join(words[:20]) + "\n" + " ".join(words[20:]) + ("\nsame line\nsame line" if i % 7 == 0 else "")
        more.append((100 + i, text, ["en", "fr"][i % 2], ["a", None][i % 5 == 0], None, "x", i, "y", 1))
    df = odd.unionByName(spark.createDataFrame(more, odd.schema))
    got = sorted(((r.doc_id, r.kept) for r in judged(df, least=least).collect()), key=str)
    want = slow_verdicts(odd_rows + more, least)
    assert got == want
    passed = [k for (d, k) in want if d is not None and d >= 100]
    assert any(passed) and not all(passed)


def figures(spark, n=900):
    draw = np.random.default_rng(0)
    rows = []
    for i in range(n):
        words = int(draw.integers(20, 200))
        rows.append((i, ["en", "de"][i % 2], ["a", "b", "rare"][0 if i % 3 else 1 + (i % 30 == 0)], words, int(words * draw.normal(5 + i % 2, 0.2)), int(i % 13 == 0) * words, 0, 0, 5))
    names = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    return spark.createDataFrame(rows, names)


def test_fences_follow_the_quartiles(spark):
    stats = figures(spark)
    frame = stats.toPandas()
    rows = thresholds(stats, least=100).collect()
    for r in rows:
        own = frame[(frame.lang == r.lang) & (frame.source == r.source)]
        own = own if len(own) >= 100 else frame[frame.lang == r.lang]
        ratio = own.word_chars / own.n_words
        q1, q3 = np.quantile(ratio, [0.25, 0.75], method="inverted_cdf")
        spread = max(q3 - q1, 0.5)
        assert abs(r.fences["word_length"].low - (q1 - 4 * spread)) < 0.15
        assert abs(r.fences["word_length"].high - (q3 + 4 * spread)) < 0.15
        assert r.fences["symbol_ratio"].high < 1  # an outlier share of a thirteenth doesn't move it


def test_sketches_merge_whatever_the_order(spark):
    stats = figures(spark)
    once = sorted(map(tuple, sketches(stats).collect()), key=str)
    parts = sketches(stats.where("doc_id < 300")).union(sketches(stats.where("doc_id >= 300")))
    merged = parts.groupBy("lang", "source", "metric", "bin").sum("n")
    assert once == sorted(map(tuple, merged.collect()), key=str)


def test_clean_documents_stay_and_junk_goes(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    verdicts = judged(docs).join(labels, "doc_id").toPandas()
    good = verdicts[(verdicts.quality == 1) & ~verdicts.base_failed]
    bad = verdicts[verdicts.quality == 0]
    assert good.kept.mean() >= 0.95 and bad.kept.mean() <= 0.2
    assert filtered(docs).count() == judged(docs).where("kept").count()


def test_repeaters_in_a_clean_group_go(spark):
    def text(i, words=200, repeated=0, same_lines=0):
        own = [f"w{i}x{j}" for j in range(words - repeated)]
        width = words if repeated else 10
        own += own[: repeated // 2] * 2
        lines = [" ".join(own[j : j + width]) for j in range(0, len(own), width)]
        return "\n".join(lines + ["end"] * same_lines)

    rows = [(i, text(i), "en", "a") for i in range(300)]
    rows += [(1000, text(1000, repeated=20), "en", "a"), (1001, text(1001, same_lines=13), "en", "a")]
    got = {r.doc_id: r for r in judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert 0.13 <= got[1000].n_repeat_words / got[1000].n_words <= 0.17
    assert not got[1000].base_failed and not got[1001].base_failed
    assert got[1000].broken == ["repeat_ratio"] and not got[1000].kept
    assert "dup_line_ratio" in got[1001].broken
    assert all(got[i].kept for i in range(300))
