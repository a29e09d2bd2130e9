from tests.llm.helpers import corpus, ordered, rows_of, sha, table, words
from varloom.llm import substring_dedup as S


def brute(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((i, len(w), len(gone), sha(kept)))
    return ordered(out)


def check(spark, rows, window):
    got = rows_of(S.substring_dedup(table(spark, rows), window=window), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute(rows, window)


def test_matches_brute_force(spark):
    rows = corpus()
    check(spark, rows, 50)
    check(spark, rows[:80], 7)


def test_many_salts(spark, monkeypatch):
    monkeypatch.setattr(S, "SALT_ANCHORS", 3)
    check(spark, corpus(seed=5), 20)


def test_one_passage_in_all_texts_and_periodic_text(spark):
    import random

    rng = random.Random(1)
    passage = words(rng, 60)
    rows = [(i, " ".join(words(rng, 5) + passage + words(rng, 5))) for i in range(40)]
    rows += [(100 + i, " ".join(["a", "b"] * (30 + i))) for i in range(4)]
    check(spark, rows, 50)


def test_empty_table(spark):
    assert S.substring_dedup(table(spark, [])).count() == 0


def test_the_result_hangs_on_the_automaton(spark):
    """Without patterns, or with wrong ones, nothing is found."""
    rows = corpus()
    gone = lambda: sum(r.n_removed for r in S.substring_dedup(table(spark, rows)).collect())
    assert gone() > 0
    a = S.Automaton(6)
    a.add(1, S.Words("a b c d e f g h i j"))
    hit = lambda text, doc=2: S.runs(a.covered(doc, S.Words(text)))
    assert [x.tolist() for x in hit("x a b c d e f g y")] == [[1], [8]]
    assert [x.tolist() for x in hit("x a b c d e y")] == [[], []] and [x.tolist() for x in hit("a b c d e f", 1)] == [[], []]
    wrong = S.Automaton(6)
    wrong.add(1, S.Words("a b c d e f g h i j"))
    wrong._places = {tuple(reversed(k)): v for k, v in wrong._places.items()}
    assert not wrong.covered(2, S.Words("x a b c d e f g y")).any()
    empty = S.Automaton(6)
    empty.add(1, S.Words("a b c d e f g h i j"))
    empty._places = {}
    assert not empty.covered(2, S.Words("x a b c d e f g y")).any()


def test_automaton_against_brute_force():
    import random

    import numpy as np

    rng = random.Random(9)
    for trial in range(300):
        window = rng.choice([2, 3, 5, 8])
        alphabet = rng.choice(["ab", "abc", "abcdefgh"])
        passages = [(rng.randrange(6), [rng.choice(alphabet) for _ in range(rng.randrange(window, 25))]) for _ in range(rng.randrange(1, 5))]
        doc_id, text = rng.randrange(7), [rng.choice(alphabet) for _ in range(rng.randrange(1, 40))]
        if rng.random() < 0.5:
            text += rng.choice(passages)[1]
        a = S.Automaton(window)
        for first, p in passages:
            a.add(first, S.Words(" ".join(p)))
        want = np.zeros(len(text), bool)
        known = {tuple(p[k : k + window]) for first, p in passages if first < doc_id for k in range(len(p) - window + 1)}
        for k in range(len(text) - window + 1):
            if tuple(text[k : k + window]) in known:
                want[k : k + window] = True
        assert (a.covered(doc_id, S.Words(" ".join(text))) == want).all()


def test_hits_that_come_to_nothing_are_not_compared_place_by_place():
    """A line said again and again: each copy has other words put in, so nearly every word is a hit with many places, few of
    which reach as far as a window."""
    import random
    import time

    import numpy as np

    rng, window, line = random.Random(4), 50, [f"w{i}" for i in range(12)]
    copies = []
    for i in range(60):
        text = line * 40
        for k in range(rng.randrange(60), len(text), 45 if i % 3 else 70):
            text[k] = f"new{i}"
        copies.append((i, text))
    first, a = {}, S.Automaton(window)
    for i, text in copies:
        for k in range(len(text) - window + 1):
            first.setdefault(tuple(text[k : k + window]), i)
        a.add(i, S.Words(" ".join(text)))
    began, got = time.process_time(), [a.covered(i, S.Words(" ".join(text))) for i, text in copies]
    assert time.process_time() - began < 2.5  # 6.3 s when each hit was compared with each place
    for (i, text), covered in zip(copies, got):
        want = np.zeros(len(text), bool)
        for k in range(len(text) - window + 1):
            if first[tuple(text[k : k + window])] < i:
                want[k : k + window] = True
        assert (covered == want).all()
