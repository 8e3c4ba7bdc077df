import functools
import hashlib
import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazecast.llm import repair
from hazecast.llm.repair import ASSISTANT, START, align, best_edits, damaged, final, joined_all, pattern, repaired, report

SCHEMA = "conv_id long, turn long, role string, text string, digest string, part int, seen string"
GRAMMAR = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def slow(rows):
    """Cheapest edits and least audit by trying every edit before every row."""

    @functools.cache
    def after(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in (0, 3) else []
        if inserted < 2:
            found += [(c + 2, "I" + a) for (s, x), t in GRAMMAR.items() if s == state and x != "s" for c, a in after(i, t, inserted + 1)]
        if i < len(rows):
            initial, gone, cut = rows[i]
            found += [(c + 3, "D" + a) for c, a in after(i + 1, state, 0)]
            if not gone:
                for (s, x), t in GRAMMAR.items():
                    if s == state and (x == initial or x != "s"):
                        price, letter = (0, "K") if x == initial else (2, "R")
                        found += [(c + price + cut, letter + a) for c, a in after(i + 1, t, 0)]
        return [min(found)] if found else []

    return after(0, 0, 0)[0]


rows_of = st.lists(st.tuples(st.sampled_from("suuaax "), st.sampled_from([False, False, True]), st.booleans()), max_size=14)
rows_of = rows_of.map(lambda rows: [(i, gone, cut and not gone) for i, gone, cut in rows])


@given(rows_of)
@settings(deadline=None, max_examples=400)
def test_edits_against_brute_force(rows):
    assert final(best_edits(rows, whole=True)) == slow(rows)


@given(rows_of, st.integers(1, 5))
@settings(deadline=None, max_examples=200)
def test_pieces_join_to_the_whole(rows, size):
    pieces = [best_edits(rows[i : i + size]) for i in range(0, len(rows), size)] or [best_edits([])]
    assert final(joined_all(pieces)) == slow(rows)


@given(rows_of, st.integers(0, 16), st.integers(0, 60))
@settings(deadline=None, max_examples=300)
def test_a_band_finds_all_that_its_bound_allows(rows, length, bound):
    wanted = pattern("u", length)
    free = align(rows, wanted, 1 << 20)
    assert align(rows, wanted, bound) == (free if free[0] <= bound else None)


def by_hand(conv):
    """Figures of one conversation from its rows after damage, in order."""
    faults, edits, seen, illegal = Counter(), [], set(), 0
    for k, (_, role, text) in enumerate(conv):
        bare = text.rstrip(repair.BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        edits.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal += k > 0 and conv[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    cost, audit = slow(edits)
    turns = {t for t, _, _ in conv if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    out, k = [], 0
    for i, e in enumerate(audit):
        follow = len(audit[i + 1 :].replace("D", ""))
        role, text = ("assistant", "user")[follow % 2], ""
        if e != "I":
            role, text = (conv[k][1] if e == "K" else role), conv[k][2]
            k += 1
        if e != "D":
            out.append((role, text))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest), out


def in_order(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in convs.items()}


def damaged_by_hand(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fault == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)


@pytest.fixture(scope="module")
def talk():
    draw = random.Random(3)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?", "Ünï. ", None, "long " * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [(c, t, draw.choice(roles), draw.choice(texts)) for c in range(40) for t in range(draw.randint(1, 9))]
    rows += [(None, t, draw.choice(roles), draw.choice(texts)) for t in [None, None, 1, 2, 2, 7]]
    rows += [(50, None, "user", "Yes.")] * 3 + [(51, 0, None, None)]
    rows += [(52, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(150)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_damage(spark, talk):
    got = Counter(map(tuple, damaged(table(spark, talk)).collect()))
    assert got == Counter(damaged_by_hand(talk))


def test_report_against_brute_force(spark, talk, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 8)
    rows = list(damaged_by_hand(talk))
    convs = in_order(rows)
    nothing = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    want = {c: by_hand(convs[c])[0] if c in convs else nothing for c, *_ in talk}
    given = table(spark, talk)
    assert result(report(damaged(given), given)) == want
    assert result(report(damaged(given.repartition(7)), given)) == want
    assert nothing in want.values() or len(convs) == len(want)


def test_repaired_turns(spark, talk):
    convs = in_order(talk)
    want = {(c, i, r, t) for c, rows in convs.items() for i, (r, t) in enumerate(by_hand(rows)[1])}
    got = repaired(table(spark, talk)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_one_conversation_over_many_ranges(spark):
    draw = random.Random(1)
    rows = [(1, t, draw.choice(["user", "assistant", "system"]), draw.choice(["Ok.", f"Turn {t}.", "cut", ""])) for t in range(3000)]
    got = result(report(table(spark, rows).repartition(8), table(spark, rows)))
    # the walk over states, row by row, has no pieces and no bands
    faults, seen = [], set()
    for _, _, role, text in rows:
        fault = "b" if not text else "d" if (role, text) in seen else "" if text[-1] == "." else "t"
        seen.add((role, text))
        faults.append((role[0], fault in ("b", "d"), fault == "t"))
    best = {START: (0, ""), 2: (2, "I"), ASSISTANT: (4, "II")}
    for initial, gone, cut in faults:
        moved = [(s, c + 3, a + "D") for s, (c, a) in best.items()]
        if not gone:
            for (s, x), t in GRAMMAR.items():
                if s in best and (x == initial or x != "s"):
                    moved.append((t, best[s][0] + 2 * (x != initial) + cut, best[s][1] + ("K" if x == initial else "R")))
        for _ in range(2):
            moved += [(t, c + 2, a + "I") for s, c, a in moved for (f, x), t in GRAMMAR.items() if f == s and x != "s"]
        best = {s: min((c, a) for t, c, a in moved if t == s) for s in {m[0] for m in moved}}
    assert got[1][5:7] == min(best[s] for s in (START, ASSISTANT) if s in best)


def test_no_rows(spark):
    none = table(spark, [])
    assert report(damaged(none), none).count() == 0 and repaired(none).count() == 0
    some = table(spark, [(1, 1, "user", "Yes.")])
    nothing = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    assert result(report(none, some)) == {1: nothing}
