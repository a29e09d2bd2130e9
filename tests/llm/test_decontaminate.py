import random
import re

from tests.llm.helpers import ordered, rows_of, sha, table, words
from varloom.llm.decontaminate import drop_contaminated, find_leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items, window=10):
    wins = {}
    for item, t in items:
        w = WORD.findall(lower(t))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add("null" if item is None else str(item))
    out = []
    for i, t in docs:
        w, hit, found = WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return ordered(out)


def fixture():
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randrange(1, 40), 60))) for i in range(12)] + [(12, None), (13, "..."), (1, "Äpfel und, BIRNEN!"), (None, "null item words here")]
    docs = [(i, " ".join(words(rng, 50, 60))) for i in range(30)]
    docs += [(100 + i, "x y " + items[i][1].upper().replace(" ", ", ") + " z") for i in range(12)]
    docs += [(200, None), (201, ""), (202, "äpfel UND birnen"), (203, "Äpfel-und-birnen null item words here"), (None, items[3][1]), (5, docs[5][1]), (204, " ".join(words(rng, 20_000, 60)))]
    return docs, items


COLS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force_in_one_part_and_in_many(spark):
    docs, items = fixture()
    for size in (8_000_000, 100):
        got = rows_of(find_leaks(table(spark, docs), bench(spark, items), part_bytes=size), *COLS)
        assert got == brute(docs, items)


def test_spans_and_filter(spark):
    docs, items = fixture()
    bad = {r[0] for r in brute(docs, items) if r[-1]}
    clean = drop_contaminated(table(spark, docs), bench(spark, items), part_bytes=200)
    assert clean.columns == table(spark, docs).columns
    assert rows_of(clean, "doc_id") == ordered([(i,) for i, t in docs if i not in bad])
    r = find_leaks(table(spark, [(1, "zz " + items[-1][1])]), bench(spark, items[-1:])).first()
    assert r.items == ["null"] and [(s.start, s.end) for s in r.spans] == [(1, 5)]


def test_empty_tables(spark):
    assert find_leaks(table(spark, []), bench(spark, [(1, "a b")])).count() == 0
    assert rows_of(find_leaks(table(spark, [(1, "a b")]), bench(spark, [])), "n_words", "n_hit", "contaminated") == [(2, 0, False)]
