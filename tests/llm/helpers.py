"""Small tables and brute-force versions that the operators are held against."""

import hashlib
import random
import re

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, score string, token string, h string"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def table(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang); further columns clash with names that operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", None, "x", None, "y", "z") for r in rows]
    return spark.createDataFrame(full, COLUMNS)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=3, n=60):
    """Texts with copies, near copies, shared passages, nulls, empties, ties, repeated rows, and a very long one."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 160)) for _ in range(n)]
    passage = words(rng, 70)
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(n, n + 25):
        w = list(base[i % 7])
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    for i in range(n + 25, n + 35):
        rows.append((i, " ".join(words(rng, 30) + passage[: rng.randrange(45, 71)] + words(rng, 20))))
    rows += [(900, None), (901, ""), (902, " \t\n "), (903, rows[0][1].replace(" ", "\t\n ")), (904, "one"), (905, "ONE"), (906, "one two three"), (907, " ".join(words(rng, 20_000)))]
    rows += [(5, rows[5][1]), (None, rows[1][1]), (None, None)]
    return rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df, *cols):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
