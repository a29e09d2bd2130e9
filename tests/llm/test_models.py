import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import corpus, ordered, table
from varloom.llm import attention as A
from varloom.llm import language_id, lm_scoring, toxicity
from varloom.llm.common import durable


def held(i, modulus, remainder):
    return i is not None and zlib.crc32(str(i).encode()) % modulus == remainder


SYLLABLES = {"aa": "ka lo mi ru".split(), "bb": "zet ulf org int".split(), "cc": "éa ôu îe àn".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language_held_out_accuracy(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, rng.randrange(5, 60)), lang) for i in range(240) for lang in [rng.choice(list(SYLLABLES))]]
    rows += [(1000, None, "aa"), (1001, "", None), (1002, "123 !!", "bb"), (1003, "漢字", None), (1004, prose(rng, "aa", 20_000), None), (None, prose(rng, "bb", 9), "bb"), rows[0]]
    got = language_id.identify(table(spark, rows), reject=False).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in rows[:240]}
    out = [(r.lang_pred == truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(out) > 20 and sum(out) / len(out) > 0.97
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1004)] == ["und", "und", "und", "aa"] and by[1000].score == 0
    assert by[1003].lang_pred in SYLLABLES
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id, 5, 0) for r in got)
    assert {r.doc_id: r.lang_pred for r in language_id.identify(table(spark, rows)).collect()}[1003] == "und"


def test_language_without_languages(spark):
    assert [r.lang_pred for r in language_id.identify(table(spark, [(1, "abc")])).collect()] == ["und"]
    assert language_id.identify(table(spark, [])).count() == 0


def toxic_rows():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        toxic = rng.random() < 0.2
        words = prose(rng, "aa", rng.randrange(10, 80)).split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vilething", "grimword"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows()
    rows += [(900, None), (901, ""), (None, "vilething"), (902, " ".join(["ka"] * 30_000)), rows[0]]
    lab = spark.createDataFrame([*labels, (901, 1, None), (None, 1, 1), (5000, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(table(spark, rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == held(r.doc_id, 3, 1) for r in got)
    truth = {i: t for i, _, t in labels}
    out = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in out) / len(out) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[900].predicted == by[901].predicted == by[902].predicted == 0
    kept = {r.doc_id for r in toxicity.drop_toxic(table(spark, rows), lab).collect()}
    assert kept == {r.doc_id for r in got if not r.predicted}


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in toxicity.score_toxicity(table(spark, [(1, "a b"), (2, None)]), none).collect()] == pytest.approx([0.5, 0.5])
    assert toxicity.score_toxicity(table(spark, []), none).count() == 0


def slow(model, x, classes=None):
    """log p of every class at every scored place, from hidden() and the heads, in float64."""
    h = model.hidden(x)[0].astype(float)
    g = h @ model.p["u"] + model.p["bu"] + model.off_group
    inner = np.einsum("nd,gdm->ngm", h, model.p["u2"].astype(float)) + model.p["bu2"] + model.off
    norm = lambda a: a - a.max(-1, keepdims=True) - np.log(np.exp(a - a.max(-1, keepdims=True)).sum(-1, keepdims=True))
    return (norm(g)[:, :, None] + norm(inner)).reshape(len(h), -1)


def test_attention_gradients_and_fast_scoring():
    rng = np.random.default_rng(0)
    n = A.GROUPS * A.MEMBERS
    used = rng.random(n) < 0.8
    m = A.Attention(seed=1, used=used)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    some = np.flatnonzero(used)
    x, y = rng.integers(0, n + 1, (3, A.OVERLAP + A.SCORED)).astype(np.int16), rng.choice(some, (3, A.SCORED))
    y[0, :5] = -1
    _, g = m.gradients(x, y)
    for name in m.p:
        at = (int(x[0, A.OVERLAP]), 2) if name == "e" else (int(y[1, 3]) // A.MEMBERS, *(0,) * (m.p[name].ndim - 1)) if name in ("u2", "bu2") else tuple(rng.integers(0, s) for s in m.p[name].shape)
        old = m.p[name][at]
        side = []
        for d in (1e-4, -1e-4):
            m.p[name][at] = old + d
            side.append(m.gradients(x, y)[0])
        m.p[name][at] = old
        assert (side[0] - side[1]) / 2e-4 == pytest.approx(float(g[name][at]), abs=2e-4)
    f = A.Attention(seed=1, used=used)
    lp, begins = f.log_probs(x, y, 3)
    every, t = slow(f, x), y.ravel()
    assert lp.ravel() == pytest.approx(np.where(t >= 0, every[np.arange(len(t)), np.maximum(t, 0)], 0), abs=1e-4)
    assert begins.ravel() == pytest.approx(np.where(t >= 0, np.log(np.exp(every[:, : 3 * A.MEMBERS]).sum(1)), 0), abs=1e-4)
    assert np.exp(every).sum(1) == pytest.approx(1) and np.exp(every[:, ~used]).max() == 0


def test_attention_is_scored_where_powers_of_logits_vanish():
    """A kind of groups that has next to no probability still tells its own groups apart."""
    n = A.GROUPS * A.MEMBERS
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, n + 1, (40, A.OVERLAP + A.SCORED)).astype(np.int16), rng.integers(0, n, (40, A.SCORED))
    for first, shift in ((3, -300), (3, 300), (20, -300)):
        f = A.Attention(seed=1)
        f.p["bu"][:first] += shift
        every, t = slow(f, x), y.ravel()
        lp, begins = f.log_probs(x, y, first)
        opens = every[:, : first * A.MEMBERS].max(1)
        opens += np.log(np.exp(every[:, : first * A.MEMBERS] - opens[:, None]).sum(1))
        assert lp.ravel() == pytest.approx(every[np.arange(len(t)), t], rel=1e-5, abs=1e-3)
        assert begins.ravel() == pytest.approx(opens, rel=1e-5, abs=1e-3)


def test_attention_gradients_add_up_over_blocks(monkeypatch):
    """Many windows give the mean of the gradients of their parts, by targets."""
    rng = np.random.default_rng(4)
    n = A.GROUPS * A.MEMBERS
    x, y = rng.integers(0, n + 1, (2 * A.BLOCK + 7, A.OVERLAP + A.SCORED)).astype(np.int16), rng.integers(-1, n, (2 * A.BLOCK + 7, A.SCORED))
    f = A.Attention(seed=3)
    loss, whole = f.gradients(x, y)
    monkeypatch.setattr(A, "BLOCK", 1_000)
    cuts = (slice(0, 50), slice(50, 60), slice(60, None))
    parts = [(np.count_nonzero(y[c] >= 0), *f.gradients(x[c], y[c])) for c in cuts]
    total = sum(k for k, _, _ in parts)
    assert loss == pytest.approx(sum(k * v for k, v, _ in parts) / total, rel=1e-5)
    for name in f.p:
        assert whole[name] == pytest.approx(sum(k * g[name] for k, _, g in parts) / total, abs=1e-5)


def test_texts_coded_at_once_as_one_by_one():
    path = lm_scoring.public_tokenizers.path(lm_scoring.VOCABULARY)
    texts = [None, "", " \t\n\x0b\x0c\r", "a\x1cb \x85c\u00a0d\u2003e", " X  Y ÀÉ\x00z\x0b\x0cQ", "one", "w " * 130 + "x", "z " * lm_scoring.PART]
    sub = lm_scoring.Subwords(path, (b"w", b"one"))
    want = sub.code([lm_scoring.words_of(t) for t in texts])
    for column in (pa.array(texts), pa.array(["zz", *texts])[1:]):
        words, numbers, ids, begins, at = sub.code_texts(column)
        assert [w.encode() for w in words.to_pylist()] == [w for t in texts for w in lm_scoring.words_of(t)]
        for i, (k, of, starts) in enumerate(want):
            assert numbers[at[i] : at[i + 1]].tolist() == [*k, sub.end_number]
            assert ids[begins[at[i]] : begins[at[i + 1]]].tolist() == of.tolist()
            assert (begins[at[i] : at[i + 1]] - begins[at[i]]).tolist() == starts.tolist()
    rows, first = A.all_spans(np.arange(60, dtype=np.int16), np.array([24, 1, 35]), np.array([7, 8, 9]), 1024)
    parts = [A.spans(np.arange(a, b, dtype=np.int16), c, 1024) for a, b, c in ((0, 24, 7), (24, 25, 8), (25, 60, 9))]
    assert (rows == np.concatenate(parts)).all() and first.tolist() == [0, 1, 2]


def test_windows_score_each_token_once_and_see_no_future():
    c = np.arange(70, dtype=np.int16)
    x = A.windows(c, 99, A.GROUPS * A.MEMBERS)
    assert x.shape == (3, A.OVERLAP + A.SCORED) and x[0, A.OVERLAP] == 99
    for j, row in enumerate(x):
        for k in range(A.SCORED):
            place = j * A.SCORED + k
            if 0 < place < 70:
                assert row[A.OVERLAP + k] == place - 1
    f = A.Attention(seed=1)
    y = np.full((1, A.SCORED), 5)
    a, b = x[1:2].copy(), x[1:2].copy()
    b[0, A.OVERLAP + 10 :] = 7
    assert f.log_probs(a, y)[0][0, :10] == pytest.approx(f.log_probs(b, y)[0][0, :10], abs=1e-5)


def test_lm_base_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "COMMON_WORDS", 40)
    rows = corpus()
    tokens = lambda t: [*(t or "").encode().lower().split(), "end"]
    c = Counter(x for i, t in rows if not held(i, 10, 0) for x in tokens(t))
    n, v = sum(c.values()), len(c)
    want = [(i, held(i, 10, 0), len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t)), 5)) for i, t in rows]
    got = lm_scoring.score_texts(table(spark, rows)).collect()
    assert ordered([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got]) == ordered(want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    by = {r.doc_id: r.score for r in got if r.doc_id is not None}
    assert by[900] == pytest.approx(by[901])
    assert lm_scoring.score_texts(table(spark, [])).count() == 0


def test_lm_probabilities_sum_to_one():
    """Over all strings of subwords of a toy vocabulary and the end, the words' probabilities and what is left to longer
    words sum to one, at a text's start and inside it; so does the mixture."""
    begins = np.array([True, True, True, False, False, True])  # the last is the end
    f = A.Folding(np.array([5.0, 3, 2, 4, 1, 2]), begins, 4, 2)
    assert np.bincount(f.class_of, np.exp(f.log_in), 8)[f.used] == pytest.approx(1)
    m = A.Attention(seed=3, groups=4, members=2, used=f.used)
    start = int(f.class_of[5])

    def at(ids):
        """log p of each id after these, and that a word begins there."""
        c = np.append(f.class_of[ids], 0)
        place = len(ids)
        x = A.windows(c, start, f.pad)
        every = slow(m, x)[place]
        return every[f.class_of] + f.log_in, np.log(np.exp(every[: f.first * 2]).sum())

    for context in ([], [0, 3, 1], [0, 3, 4, 4, 2] * 6):
        p, b = at(context)
        total = math.exp(p[5] - b)  # the end
        todo = [((i,), p[i] - b) for i in (0, 1, 2)]
        for word, lp in todo:
            q, closed = at([*context, *word])
            total += math.exp(lp + closed)
            if len(word) < 4:
                todo += [((*word, i), lp + q[i]) for i in (3, 4)]
            else:
                total += math.exp(lp) * (1 - math.exp(closed))
        assert total == pytest.approx(1, abs=1e-5)
    counts = np.array([4.0, 1, 1, 2, 2])
    w = lm_scoring.Weights(counts.sum(), 5, 2, 2)
    model_p = np.array([0.1, 0.2, 0.1, 0.1, 0.1, 0.3, 0.1])  # two words that were never seen
    assert (10 ** w.mixed(np.append(counts, [0, 0]), np.log(model_p))).sum() == pytest.approx(1)


def test_lm_scores_by_brute_force(spark, monkeypatch):
    """Every text's score from plain loops over its subwords, with a model that wasn't trained."""
    monkeypatch.setattr(lm_scoring, "COMMON_WORDS", 40)
    monkeypatch.setattr(lm_scoring, "train", lambda rows, folding, path, tokens: A.Attention(seed=5, used=folding.used))
    rows = corpus(n=20)[:34] + [(901, None), (902, "w1 " * 90 + "neverseen"), (None, "w1 w2")]
    got = {r.doc_id: r.score for r in lm_scoring.score_texts(table(spark, rows)).collect()}
    path = lm_scoring.public_tokenizers.path(lm_scoring.VOCABULARY)
    sub = lm_scoring.Subwords(path)
    tokens = lambda t: (t or "").encode().lower().split()
    c = Counter(x for i, t in rows if not held(i, 10, 0) for x in tokens(t))
    ends = sum(not held(i, 10, 0) for i, _ in rows)
    ids = np.zeros(sub.n_ids)
    for word, n in c.items():
        for k in sub._core.encode_single_piece(b" " + word):
            ids[k] += n
    ids[sub.end] = ends
    f, total, values = A.Folding(ids, sub.begins), sum(c.values()) + ends, [*c.values(), ends]
    d = values.count(1) / (values.count(1) + 2 * values.count(2)) if values.count(1) and values.count(2) else 0.5
    rest = 1 - lm_scoring.SEEN * (1 - d * len(values) / total)
    m, start = A.Attention(seed=5, used=f.used), int(f.class_of[sub.end])
    for i, t in rows[::3] + rows[-3:]:
        pieces = [sub._core.encode_single_piece(b" " + w) for w in tokens(t)] + [[sub.end]]
        flat = [k for p in pieces for k in p]
        every = slow(m, A.windows(f.class_of[flat], start, f.pad))
        first = np.log(np.exp(every[:, : f.first * A.MEMBERS]).sum(1))
        at, score = 0, 0.0
        for w, p in zip([*tokens(t), None], pieces):
            lp = sum(every[at + j, f.class_of[k]] + f.log_in[k] for j, k in enumerate(p)) - first[at]
            at += len(p)
            lp += first[at] if w is not None else 0
            n = ends if w is None else c[w]
            score += math.log10(lm_scoring.SEEN * max(0, n - d) / total + rest * math.exp(lp))
        assert got[i] == pytest.approx(score, rel=1e-4), i


def test_lm_is_trained_on_windows_of_every_text(spark, monkeypatch):
    """A text that is longer than all others, null ids and repeated rows are learnt from, and one round misses none."""
    rows = [*corpus(), (910, " ".join(["long"] * 60_000))]
    sub, frame = lm_scoring.subwords(lm_scoring.public_tokenizers.path(lm_scoring.VOCABULARY)), table(spark, rows)
    coded = [ids for _, ids, _ in sub.code([lm_scoring.words_of(t) for _, t in rows])]
    counts = np.bincount(np.concatenate(coded), minlength=sub.n_ids).astype(float)
    f, kept = A.Folding(counts, sub.begins), {}
    start = int(f.class_of[sub.end])
    want = Counter()
    for _, t in rows:
        w = lm_scoring.words_of(t)
        for k in range(0, len(w) + 1, lm_scoring.PART):
            ids = sub.code([w[k : k + lm_scoring.PART]])[0][1]
            last = k + lm_scoring.PART > len(w)
            want.update(r.tobytes() for r in A.spans(f.class_of[ids if last else ids[:-1]], f.pad if k else start, f.pad))
    monkeypatch.setattr(lm_scoring, "DRAWN", 1.0)
    monkeypatch.setattr(lm_scoring, "STEPS", 24)  # so few that the texts are dealt over all rounds
    monkeypatch.setattr(lm_scoring, "durable", lambda df, label, *by: kept.__setitem__(label, durable(df, label, *by)) or kept[label])
    model = lm_scoring.train(frame, f, lm_scoring.public_tokenizers.path(lm_scoring.VOCABULARY), float(counts.sum()))
    dealt = kept["lm-spans"].collect()
    width = 2 * (A.OVERLAP + A.SCORED + 1)
    assert {r.turn for r in dealt} == set(range(A.ROUNDS))
    assert Counter(bytes(r.spans[i : i + width]) for r in dealt for i in range(0, len(r.spans), width)) == want
    c = f.class_of[coded[-1]]
    x, y = A.unspan(A.spans(c, start, f.pad), f.pad)
    assert (A.windows(c, start, f.pad)[:-1] == x[:-1]).all() and (y.ravel()[: len(c)] == c).all() and (y.ravel()[len(c) :] == -1).all()
    assert model.log_probs(x, y)[0].sum() / len(c) > A.Attention(used=f.used).log_probs(x, y)[0].sum() / len(c) + 1
    monkeypatch.setattr(lm_scoring, "DRAWN", 0.25)  # where windows are drawn, about this share of them is, from all rows
    monkeypatch.setattr(lm_scoring, "STEPS", 1)
    lm_scoring.train(frame.repartition(9), f, lm_scoring.public_tokenizers.path(lm_scoring.VOCABULARY), float(counts.sum()))
    drawn = Counter(bytes(r.spans[i : i + width]) for r in kept["lm-spans"].collect() for i in range(0, len(r.spans), width))
    assert not drawn - want and 0.1 < sum(drawn.values()) / sum(want.values()) < 0.4


def test_lm_leaves_no_window_out_of_a_corpus_with_enough_for_all_steps(spark, monkeypatch):
    rows = [*corpus(), (910, " ".join(f"w{i % 300}" for i in range(60_000)))]
    path, kept = lm_scoring.public_tokenizers.path(lm_scoring.VOCABULARY), {}
    sub = lm_scoring.subwords(path)
    counts = np.bincount(np.concatenate([ids for _, ids, _ in sub.code([lm_scoring.words_of(t) for _, t in rows])]), minlength=sub.n_ids).astype(float)
    f, want = A.Folding(counts, sub.begins), Counter()
    start = int(f.class_of[sub.end])
    for _, t in rows:
        w = lm_scoring.words_of(t)
        for k in range(0, len(w) + 1, lm_scoring.PART):
            ids = sub.code([w[k : k + lm_scoring.PART]])[0][1]
            last = k + lm_scoring.PART > len(w)
            want.update(r.tobytes() for r in A.spans(f.class_of[ids if last else ids[:-1]], f.pad if k else start, f.pad))
    monkeypatch.setattr(lm_scoring, "STEPS", 10)  # a few batches are enough for them
    monkeypatch.setattr(lm_scoring, "durable", lambda df, label, *by: kept.__setitem__(label, durable(df, label, *by)) or kept[label])
    lm_scoring.train(table(spark, rows), f, path, float(counts.sum()))
    width = 2 * (A.OVERLAP + A.SCORED + 1)
    assert Counter(bytes(r.spans[i : i + width]) for r in kept["lm-spans"].collect() for i in range(0, len(r.spans), width)) == want


def test_lm_gives_the_commonest_ids_classes_of_their_own():
    counts, begins = 1e6 / np.arange(1, 50_001), np.arange(50_000) % 3 > 0
    f = A.Folding(counts, begins)
    own, n = np.bincount(f.class_of, minlength=1024), f.first * A.MEMBERS
    for kind, a, b in ((begins, 0, n), (~begins, n, 1024)):
        single = int((b - a) * A.SINGLE)
        ids = np.flatnonzero(kind)
        assert (f.class_of[ids] >= a).all() and (f.class_of[ids] < b).all()
        assert (own[a : a + single] == 1).all() and (f.class_of[ids[:single]] == a + np.arange(single)).all() and (own[a:b] > 0).all()


def test_toxicity_fit_by_brute_force(spark, monkeypatch):
    """The whole fit once more with dense matrices: counts, choice of n-grams, weights, folds and bias."""
    from pyspark.sql import functions as F

    from varloom.llm.ngrams import folded, gram_bins

    monkeypatch.setattr(toxicity, "FEATURES", 60)  # read by the driver alone
    rng = random.Random(12)
    words = ["river", "stone", "cloud", "garden", "window", "paper"]
    rows = [(i, " ".join(rng.choices(words + (["vilest", "scumbag"] if i % 3 == 0 else []), k=8))) for i in range(90)] + [(200, None), (201, "ab")]
    labels = [(i, int(i % 3 == 0)) for i, _ in rows]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(table(spark, rows), lab).collect()}
    fold = {r[0]: r[1] for r in lab.select("doc_id", F.pmod(F.hash("doc_id"), F.lit(toxicity.FOLDS))).collect()}
    held = {i: set(np.concatenate([*gram_bins(folded(t), toxicity.SIZES, toxicity.BITS), np.empty(0, np.int64)]).tolist()) for i, t in rows}
    learn = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = dict(labels)

    def model(ids):
        y = np.array([toxic[i] for i in ids], float)
        bins = sorted(set().union(*(held[i] for i in ids)))
        x = np.array([[b in held[i] for b in bins] for i in ids], float)
        t, c, share = x[y == 1].sum(0), x[y == 0].sum(0), y.mean()
        with np.errstate(all="ignore"):
            gain = np.where(t > 0, t * np.log(t / ((t + c) * share)), 0) + np.where(c > 0, c * np.log(c / ((t + c) * (1 - share))), 0)
        best = sorted(range(len(bins)), key=lambda k: (-round(gain[k], 9), bins[k]))[:60]
        ratio = np.log((t[best] + 0.5) / (y.sum() + 1)) - np.log((c[best] + 0.5) / (len(y) - y.sum() + 1))
        x = x[:, best] * ratio
        balance = np.where(y == 1, 1 / (2 * y.sum()), 1 / (2 * (1 - y).sum()))
        w, bias, g2, gb = np.zeros(len(best)), 0.0, 1e-8, 1e-8
        for _ in range(toxicity.ROUNDS):
            err = (1 / (1 + np.exp(-(x @ w + bias))) - y) * balance
            g = toxicity.DECAY * w + x.T @ err
            g2, gb = g2 + g * g, gb + err.sum() ** 2
            w, bias = w - toxicity.RATE * g / np.sqrt(g2), bias - toxicity.RATE * err.sum() / np.sqrt(gb)
        weight = dict(zip([bins[k] for k in best], w * ratio))
        return lambda i: sum(weight.get(b, 0.0) for b in held[i])

    apart = [(model([j for j in learn if fold[j] != f])(i), toxic[i]) for f in range(toxicity.FOLDS) for i in learn if fold[i] == f]
    clean, bad = [z for z, t in apart if not t], [z for z, t in apart if t]
    low, high = np.quantile(clean, toxicity.CLEAN_BELOW), np.quantile(bad, toxicity.TOXIC_BELOW)
    cut = low + toxicity.UP * min(1, toxicity.FEW_CLEAN / len(clean)) * max(0, high - low)
    final = model(learn)
    for i, t in rows:
        want = 1 / (1 + np.exp(-(final(i) - cut + np.log(0.7 / 0.3)))) if len(t or "") > 1 else np.mean([toxic[j] for j in learn])
        assert got[i] == pytest.approx(want, abs=1e-7), i
