import random

import pytest

from tests.llm.helpers import corpus, ordered, rows_of, table, words
from varloom.llm import jaccard_join as J


def sets_of(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1))


def brute(rows, k=4, percent=85):
    sets = [(i, sets_of(t, k)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and i is not None and j is not None:
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return ordered([(i, len(s), None if i is None else find(i)) for i, s in sets])


def check(spark, rows, k=4, percent=85):
    got = rows_of(J.jaccard_components(table(spark, rows), k, percent), "doc_id", "n_shingles", "component_id")
    assert got == brute(rows, k, percent)


def near(seed, families=4, size=30, edits=9):
    """Families of near copies around the threshold."""
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(families):
        base = words(rng, rng.randrange(60, 200), 5000)
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(edits)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((i, " ".join(w)))
            i += 1
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    check(spark, corpus())


@pytest.mark.parametrize("block,chunk", [(64, 128), (3, 4)])
def test_near_copies_around_the_threshold(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "CHUNK", chunk)
    monkeypatch.setattr(J, "ASKERS", chunk)
    check(spark, near(2))
    check(spark, near(3, edits=14), 5, 80)


def test_short_texts_and_exact_ratio(spark):
    rows = [(i, " ".join(f"x{j}" for j in range(n))) for i, n in enumerate([1, 1, 2, 3, 4, 5, 6, 20, 21, 22, 23, 24, 103, 88, 120])]
    check(spark, rows)


def test_no_links_and_empty_table(spark):
    check(spark, [(1, "a b c d e"), (2, "f g h i j")])
    assert J.jaccard_components(table(spark, [])).count() == 0


def test_filter_keeps_one_of_each(spark):
    docs = table(spark, [(4, "a b c d e f"), (2, "a b c d e f"), (7, "q r s t u v"), (8, None), (9, None)])
    out = J.keep_one_of_each(docs)
    assert out.columns == docs.columns and rows_of(out, "doc_id") == [(2,), (7,), (8,), (9,)]


def test_an_id_on_rows_of_very_different_length(spark):
    rng = random.Random(4)
    long = words(rng, 120, 5000)
    rows = [(1, "a b c d e f g h"), (1, " ".join(long)), (2, " ".join([*long[:-2], "x"])), (3, "a b c d e f g h i"), (0, " ".join(["q", *long]))]
    check(spark, rows)


def test_hot_classes_are_joined_apart(spark, monkeypatch):
    from varloom.llm import common

    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    rows = [(i, "a b c d e f") for i in range(1, 1_200)] + [(0, None), (5_000, "u v w x y z"), (5_001, "u v w x y z")]
    got = rows_of(J.jaccard_components(table(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == ordered([(0, 0, 0), (5_000, 3, 5_000), (5_001, 3, 5_000), *[(i, 3, 1) for i in range(1, 1_200)]])


def test_a_line_shared_by_short_texts_makes_no_pairs(spark, monkeypatch):
    """Texts of 19 words, 10 of them a shared line in one of three places, some near copies: few candidates, and the same links."""
    rng = random.Random(6)
    line, rows = words(rng, 10, 5000), []
    for i in range(700):
        own = [f"o{rng.randrange(10**6)}" for _ in range(9)]
        cut = rng.choice([0, 4, 9])
        rows.append((i, " ".join(own[:cut] + line + own[cut:])))
        if i % 50 == 0:
            rows.append((10_000 + i, rows[-1][1] + " more"))
    seen = []
    whole = J.candidates
    monkeypatch.setattr(J, "candidates", lambda *a: seen.append(whole(*a).count()) or whole(*a))
    check(spark, rows)
    assert seen[0] < 2 * len(rows)
