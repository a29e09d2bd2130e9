import heapq
import math
import random
import re
from collections import Counter

import numpy as np

from tests.llm.helpers import ordered, rows_of, table, words
from varloom.llm.lexical_search import best_of_shard, build_index, pack, search, unpack

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
COLS = ("item_id", "rank", "doc_id", "score")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k=20):
    found = [(i, Counter(w), len(w)) for i, w in ((i, terms(t)) for i, t in docs) if w]
    n_docs, total = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in found:
            m = 100 - 25 + (25 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return ordered(out)


def fixture():
    rng = random.Random(11)
    docs = [(i, " ".join(words(rng, rng.randrange(1, 60), 50)) + " the") for i in range(90)]
    docs += [(200 + i, docs[3][1]) for i in range(25)]  # more equal scores than results
    docs += [(300, None), (301, ""), (302, " .,; "), (None, docs[3][1]), (None, "W1 w2"), (5, docs[5][1]), (303, "ÄPFEL äpfel W1-w2"), (304, " ".join(words(rng, 20_000, 50)))]
    items = [(1, docs[3][1]), (2, "w1 w1 w1 W2, the THE"), (3, None), (4, ""), (5, "nowhere"), (6, "äpfel"), (None, "w7 w8"), (2, "w9"), (7, " ".join(words(rng, 300, 60)))]
    return docs, items


def queries(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, score int")


def test_matches_brute_force_in_small_shards_and_query_parts(spark):
    docs, items = fixture()
    want = brute(docs, items)
    assert rows_of(search(build_index(table(spark, docs)), queries(spark, items)), *COLS) == want
    index = build_index(table(spark, docs).coalesce(1), shard_docs=7, piece=10)
    assert index.filter("term IS NULL").count() > 10
    assert rows_of(search(index, queries(spark, items), part_bytes=200), *COLS) == want
    assert rows_of(search(index, queries(spark, items), k=3), *COLS) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = fixture()
    assert search(build_index(table(spark, [])), queries(spark, items)).count() == 0
    assert search(build_index(table(spark, [(1, None), (2, " ")])), queries(spark, items)).count() == 0
    assert search(build_index(table(spark, docs)), queries(spark, [])).count() == 0


def test_packed_integers_come_back():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(0, 1 << int(b), 50) for b in range(1, 62)] + [[0, 127, 128, 16383, 16384]])
    data, ends = pack(v)
    assert unpack(data.tobytes()).tolist() == v.tolist() and ends[-1] == len(data)
    assert unpack(b"").tolist() == []


def test_merge_leaves_out_nothing_that_could_be_among_the_best():
    """Random lists with many ties, against sorting all scores."""
    rng = random.Random(5)
    for k in (1, 3, 20):
        for _ in range(60):
            total, lists = Counter(), []
            for _ in range(rng.randrange(1, 8)):
                docs = sorted(rng.sample(range(200), rng.randrange(1, 120)))
                parts = [rng.randrange(0, 6) * 10 ** rng.randrange(0, 2) for _ in docs]
                total.update(dict(zip(docs, parts)))
                lists.append((docs, parts, max(parts), heapq.nlargest(k, parts)[-1] if len(parts) >= k else 0))
            want = sorted(((s, -d) for d, s in total.items() if s > 0), reverse=True)[:k]
            assert best_of_shard(lists, k) == [(s, -d) for s, d in want]
