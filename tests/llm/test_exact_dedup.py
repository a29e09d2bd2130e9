from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.helpers import SPACE, corpus, ordered, rows_of, sha, table
from varloom.llm import exact_dedup as exact
from varloom.llm.exact_dedup import drop_copies, exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    out = []
    for i, t in rows:
        norm = SPACE.sub(" ", t or "")
        ids = [x for x in groups[norm] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[norm]), i == keep, sha(norm)))
    return ordered(out)


def test_matches_brute_force_even_with_a_colliding_hash(spark):
    rows = corpus()
    for weak in (exact.hash128, lambda c: F.substring(F.md5(c), 1, 1)):
        got = rows_of(exact_dedup(table(spark, rows), content_hash=weak), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
        assert got == brute(rows)


def test_empty_table_and_filter_keeps_columns(spark):
    assert exact_dedup(table(spark, [])).count() == 0
    docs = table(spark, [(3, "a b"), (1, "a  b"), (2, "c"), (None, "d")])
    out = drop_copies(docs)
    assert out.columns == docs.columns
    assert rows_of(out, "doc_id") == [(None,), (1,), (2,)]


def test_filter_drops_rows_not_ids(spark, monkeypatch):
    """Of an id on two rows only the copy goes; a null id goes where its text is a copy, and stays where it isn't."""
    docs = table(spark, [(1, "a b"), (7, "a  b"), (7, "alone"), (None, "a b"), (None, "only here"), (8, "alone")])
    want = [(None, "only here"), (1, "a b"), (7, "alone")]
    assert rows_of(drop_copies(docs), "doc_id", "text") == want
    monkeypatch.setattr(exact, "BROADCAST_IDS", 0)
    assert rows_of(drop_copies(docs), "doc_id", "text") == want


def test_the_hash_makes_the_groups_and_hot_groups_are_joined_apart(spark, monkeypatch):
    """A hash that tells all rows apart finds no copies; groups beyond the broadcast bound give the same result."""
    from varloom.llm import common

    rows = [(i, "same text") for i in range(1_100)] + [(i, f"text {i % 7}") for i in range(2_000, 2_020)]
    assert all(r.kept for r in exact_dedup(table(spark, rows), content_hash=lambda c: F.uuid()).collect())
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    got = rows_of(exact_dedup(table(spark, rows)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute(rows)
