import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hazecast.llm import manifest
from hazecast.llm.manifest import proofs, tampered_text


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    for row in tree[:-1]:
        first = i // 3 * 3
        yield row[first:i], row[i + 1 : first + 3]
        i //= 3


def slow(rows, tamper):
    """rows of (doc_id, source, lang, n_chars, text) -> doc_id, leaf, subroot, root, proof, folded root, verified."""
    by = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))):
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([leaf(*r) for r in by[s]]) for s in order]
    top = levels([t[-1][0] for t in trees])
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            steps = [*path(trees[k], i), *path(top, k)]
            folded = leaf(*r[:4], tamper(r[0], r[4]))
            for before, after in steps:
                folded = digest("".join([*before, folded, *after]))
            proof = "".join("".join(before + after) for before, after in steps)
            yield r[0], leaf(*r), trees[k][-1][0], top[-1][0], proof, folded, folded == top[-1][0]


def without_feeds(doc_id, text):
    even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
    return text.replace("\n", "") if even and text is not None else text


NAMES = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]


def result(df):
    assert df.columns == NAMES
    return sorted(map(tuple, df.collect()), key=str)


def fields(rows):
    return [(r[0], r[3], r[2], r[4], r[1]) for r in rows]  # the odd rows have text second


def test_odd_rows_against_brute_force(odd, odd_rows, none):
    want = sorted(slow(fields(odd_rows), without_feeds), key=str)
    assert result(proofs(odd, tampered_text())) == want
    assert result(proofs(odd.repartition(5), tampered_text())) == want
    assert 0 < sum(not r[-1] for r in want) < len(want)
    assert proofs(none).count() == 0


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [[1], [1, 1], [3, 1, 4], [9, 10, 27, 28, 2], [1] * 10])
def test_trees_of_any_size(spark, sizes):
    rows = [(10 * k + i, None if k == 0 else f"s{k}", "en", i, f"text\n{k} {i}") for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert result(proofs(docs)) == sorted(slow(rows, lambda _, text: text), key=str)
    assert result(proofs(docs, tampered_text())) == sorted(slow(rows, without_feeds), key=str)


def test_nodes_that_many_leaves_pass_stand_in_copies(spark, monkeypatch):
    monkeypatch.setattr(manifest, "SPREAD", 5)
    seen = {}

    climbed = manifest._climbed

    def kept(leaves, nodes):
        seen["most"] = nodes.groupBy("tree", "level", "pos").count().agg(F.max("count")).first()[0]
        plan = leaves.join(nodes.withColumnRenamed("pos", "at_pos"), "at_pos")._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed" in plan
        return climbed(leaves, nodes)

    monkeypatch.setattr(manifest, "_climbed", kept)
    rows = [(i, "big" if i % 3 else f"small {i}", None, None, f"{i}\n") for i in range(300)]
    got = result(proofs(spark.createDataFrame(rows, SCHEMA), tampered_text()))
    assert got == sorted(slow(rows, without_feeds), key=str)
    assert seen["most"] >= 10


def test_the_row_limit_is_put_back(spark):
    spark.conf.set(manifest.ROW_LIMIT, "50")  # far fewer than the climb has rows
    try:
        rows = [(i, "a", None, None, None) for i in range(40)]
        assert result(proofs(spark.createDataFrame(rows, SCHEMA))) == sorted(slow(rows, without_feeds), key=str)
        assert spark.conf.get(manifest.ROW_LIMIT) == "50"
    finally:
        spark.conf.unset(manifest.ROW_LIMIT)
