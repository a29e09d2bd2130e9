import hashlib
import random
import zlib
from collections import defaultdict

from tests.llm.helpers import ordered, rows_of
from varloom.llm import common
from varloom.llm import prefix_trie as pt
from varloom.llm.prefix_trie import prefix_trie

COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes[tuple(p[:d])].append(c)
    kids = defaultdict(list)
    for n in nodes:
        if n:
            kids[n[:-1]].append(n)

    def below(n):
        yield n
        for k in kids[n]:
            yield from below(k)

    out = []
    for n, members in nodes.items():
        sub = list(below(n))
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(n))
        saved = sum((len(nodes[u]) - 1) * len(u[-1][1]) for u in sub if u)
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(kids[n]), sum(not kids[u] for u in sub), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return ordered(out)


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, depth int, place string, owner string")


def fixture():
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 60), *range(100, 130), 205, 206, 207, 340, 5_001, 5_002]:
        start = rng.randrange(3)  # families that share their first turns without rebuilding too
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"shared {start}{t} ☃" if rng.random() < 0.7 else f"own {rng.randrange(30)}"))
    rows += [(7, None, None, "first"), (7, None, "user", None), (8, 3, "user", ""), (8, 3, "user", ""), (9, 3, "a", "tie"), (9, 3, "b", "tie"), (None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(c, t, "user", f"copy {t}") for c in range(400, 440) for t in range(4)]
    rows += [(50_000, t, "user", f"long {t % 11}" + "x" * (t % 50)) for t in range(3_000)] + [(50_001, t, "user", f"long {t % 11}" + "x" * (t % 50)) for t in range(3_000)]
    return rows


def short(rows):
    return [r for r in rows if r[0] is None or r[0] < 50_000]


def test_matches_brute_force_however_it_is_cut(spark, monkeypatch):
    rows = short(fixture())
    want = brute(rows)
    assert rows_of(prefix_trie(turns(spark, rows)), *COLS) == want
    monkeypatch.setattr(pt, "CHUNK", 2)
    monkeypatch.setattr(pt, "RUN", 3)
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    assert rows_of(prefix_trie(turns(spark, rows).repartition(7)), *COLS) == want


def test_long_conversations_span_chunks_and_ranges(spark):
    rows = [r for r in fixture() if r[0] in (50_000, 50_001)]
    got = prefix_trie(turns(spark, rows)).groupBy("conv_id").count().orderBy("conv_id").collect()
    h = [zlib.crc32(str(c).encode()) % 6 for c in (50_000, 50_001)]
    assert h[1] >= 0 and [tuple(r) for r in got] == [(50_000, 3_001)]  # both are the same path
    r = prefix_trie(turns(spark, rows)).filter("depth = 0").first()
    assert (r.n_convs, r.n_leaves, r.saved_tokens) == (2, 1, sum(len(x[3]) for x in rows) // 2)


def test_edges(spark):
    assert prefix_trie(turns(spark, [])).count() == 0
    assert prefix_trie(turns(spark, [(None, 1, "a", "b")])).count() == 0
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 4)  # its turns all go, and no base gives any
    rows = [(lone, 0, "a", "b"), (lone, 1, "a", "c")]
    assert rows_of(prefix_trie(turns(spark, rows)), *COLS) == brute(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    rows = [(1_000, 0, "a", "t" * 200_000), (1_000, 1, "b", "u"), (1_001, 0, "a", "t" * 200_000)]
    assert rows_of(prefix_trie(turns(spark, rows)), *COLS) == brute(rows)
