import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import ordered, rows_of, words
from varloom.llm import common
from varloom.llm import source_mix as sm
from varloom.llm.source_mix import mix_sources, mix_totals

COLS = ("doc_id", "size", "source_size", "target", "taken")


def md5(t):
    return hashlib.md5(t.encode()).hexdigest()


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(rows, weights, passes):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    got, full = {}, set()
    while True:
        left, rest = sum(sizes.values()) - sum(passes * sizes[s] for s in full), [s for s in names if s not in full]
        got = {s: float(passes * sizes[s]) if s in full else left / sum(w[x] for x in rest) * w[s] for s in names}
        over = {s for s in rest if got[s] > passes * sizes[s]}
        if not over:
            return sizes, got
        full |= over


def brute(rows, weights=(5, 2, 1), passes=3):
    sizes, got = targets(rows, weights, passes)
    out = []
    for s, n in sizes.items():
        take, at = min(passes * n, math.floor(got[s] + 0.5)), 0
        for _, i, t in sorted((md5(f"{'null' if i is None else i} " + md5(t or "")), i, t) for i, t, x in rows if x == s):
            k = size(t)
            out.append((i, k, n, got[s], (take // n * k + max(0, min(k, take % n - at))) if n else 0))
            at += k
    return ordered(out)


def fixture():
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng, rng.randrange(1, 90))), rng.choice(["a", "a", "a", "b", "ü", "Z"])) for i in range(150)]
    rows += [(200, None, "a"), (201, "", "b"), (202, " \t\n ", "only empty"), (203, "one  two\tthree ", None), (204, "x", ""), (None, "no id\x0bhere\x1cstays", "b"), (None, "a b", "b"), (5, "same id, other text", "a")]
    rows += [rows[7]] * 3 + [(300, " ".join(words(rng, 9_000)), "long")]
    return rows


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, "y", 2) for i, t, s in rows], "doc_id long, text string, source string, src string, at int, key string, size int")


@pytest.mark.parametrize("block", [7, 1024])
def test_totals_match_brute_force(spark, monkeypatch, block):
    rows = fixture()
    got = mix_totals(docs(spark, rows), block=block)
    assert ordered((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in rows_of(got, *COLS)) == ordered((*r[:3], round(r[3], 6), r[4]) for r in brute(rows))
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(sm, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(sm, "CHUNK_BITS", 3)
    again = mix_totals(docs(spark, rows).repartition(5), block=block)
    assert rows_of(again, *COLS) == rows_of(got, *COLS)


def test_mixture_has_every_block_once_and_interleaves_sources_by_weight(spark):
    rows, block = fixture(), 16
    mixed = mix_sources(docs(spark, rows), block=block).collect()
    sizes, got = targets(rows, (5, 2, 1), 3)
    blocks = defaultdict(list)
    for r in mixed:
        blocks[r.slot, r.source, r.nth].append(r)
    assert len({k[0] for k in blocks}) == len({k[1:] for k in blocks}) == len(blocks)
    for s, n in sizes.items():
        take = min(3 * n, math.floor(got[s] + 0.5))
        mine = sorted((k[2], sum(x.words for x in v)) for k, v in blocks.items() if k[1] == s)
        assert [m[0] for m in mine] == list(range(math.ceil(take / block)))
        assert all(w == block for _, w in mine[:-1]) and sum(w for _, w in mine) == take
    # any run of slots holds a source about as often as its target asks
    order, total = [k[1] for k in sorted(blocks, key=lambda k: k[0])], sum(got.values())
    for upto in (len(order) // 4, len(order) // 2, len(order)):
        seen = Counter(order[:upto])
        assert all(abs(seen[s] - upto * got[s] / total) < 6 for s in got)


def test_edges(spark):
    assert mix_totals(docs(spark, [])).count() == 0 and mix_sources(docs(spark, [])).count() == 0
    nothing = [(1, None, "a"), (2, "", None), (2, "", None)]
    assert rows_of(mix_totals(docs(spark, nothing)), *COLS) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    one = [(i, "a b c", "s") for i in range(4)]
    assert rows_of(mix_totals(docs(spark, one)), *COLS) == [(i, 3, 12, 12.0, 3) for i in range(4)]


def test_native_plan(spark):
    plan = mix_totals(docs(spark, fixture()))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
