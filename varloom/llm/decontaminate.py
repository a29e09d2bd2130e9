"""Operator 8, benchmark decontamination: Wu-Manber search for test-set passages over words.

The alphabet is words and a block is two of them. A shift table says how far the search may jump at a block that ends
no pattern; at a block that ends one, the block's bucket gives the patterns with this suffix, and these are compared
word by word. Documents stream through one Arrow map and nothing is shuffled. The test set is cut by item into parts
of a bounded number of bytes; with more than one part, the documents pass once for each part and hits add up.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import durable, key_rows, runs, slices, table

#: Consecutive words of a window, and words of a shift block.
WINDOW, BLOCK = 10, 2
#: Bytes of test text whose tables one pass holds and broadcasts.
PART_BYTES = 8_000_000

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TO = bytes(b if b in _KEPT else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters a-z and characters from 128 on, after A-Z are lower-cased."""
    return (text or "").encode("utf-8").translate(_TO).split()


class WuManber:
    """Patterns of one length in words."""

    def __init__(self, patterns: dict[tuple, frozenset], length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.jump = length - self.block + 1
        self.shift: dict = {}
        self.buckets = defaultdict(list)
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                key = self._key(words, end - 1)
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            self.buckets[self._key(words, length - 1)].append((list(words), items))

    def _key(self, words, i: int):
        return words[i] if self.block == 1 else (words[i - 1], words[i])

    def search(self, words: list[bytes], hit: bytearray, items: set) -> None:
        """Mark the words of every occurrence in hit and add its items."""
        n, m, jump, shift, i = len(words), self.length, self.jump, self.shift.get, self.length - 1
        ones, single = b"\1" * m, self.block == 1
        while i < n:
            key = words[i] if single else (words[i - 1], words[i])
            step = shift(key, jump)
            if step:
                i += step
                continue
            first = i - m + 1
            for pattern, found in self.buckets[key]:
                if pattern[0] == words[first] and pattern == words[first : i + 1]:
                    hit[first : i + 1] = ones
                    items |= found
            i += 1


def searchers(rows, window: int) -> list[WuManber]:
    """One searcher for each length of window; rows: (item id as text, text)."""
    by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in rows:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            by_length[size][tuple(words[i : i + size])].add(item)
    return [WuManber({k: frozenset(v) for k, v in p.items()}, size) for size, p in sorted(by_length.items())]


def _parts(benchmark: DataFrame, part_bytes: int) -> list[list]:
    """The test set's rows in parts of about part_bytes, one at a time."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / part_bytes))
    for k in range(n):
        yield n, [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).collect()]


def _scan(found: list[WuManber], text: str | None, hit: bytes | None, items: list | None):
    words = words_of(text)
    marks, ids = bytearray(hit or bytes(len(words))), set(items or ())
    for s in found:
        s.search(words, marks, ids)
    return len(words), marks, ids


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items and spans.

    items: ids of the test items with an occurring window, sorted as text. spans: [start, end) runs of hit words.
    A null text has no words. A test item without words has no window; a null item id is called null. Repeated items
    count once and repeated documents each have their row. An empty test set hits nothing."""
    rows = key_rows(docs, id_col, text_col)
    spark = docs.sparkSession
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<start: int, end: int>>"
    for k, (n, part) in enumerate(_parts(benchmark, part_bytes)):
        tables = spark.sparkContext.broadcast(searchers(part, window))
        if k + 1 < n:
            rows = durable(rows.mapInArrow(_pass(tables), "doc_id long, text string, hit binary, items array<string>"), "leaks")
        else:
            return rows.mapInArrow(_last(tables), schema)


def _each(batch):
    cols = batch.schema.names
    return zip(batch.column("text").to_pylist(), *(batch.column(c).to_pylist() if c in cols else [None] * len(batch) for c in ("hit", "items")))


def _pass(tables):
    def run(batches):
        for b in slices(batches):
            out = [_scan(tables.value, *row) for row in _each(b)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": b.column("text"), "hit": pa.array([bytes(x[1]) for x in out], pa.binary()), "items": pa.array([sorted(x[2]) for x in out], pa.list_(pa.string()))})

    return run


def _last(tables):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for b in slices(batches):
            out = [_scan(tables.value, *row) for row in _each(b)]
            items = [sorted(x[2]) for x in out]
            hits = [sum(x[1]) for x in out]
            spans = [[{"start": int(s), "end": int(e)} for s, e in zip(*runs(np.frombuffer(x[1], np.int8) > 0))] if h else [] for x, h in zip(out, hits)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n_words": pa.array([x[0] for x in out], pa.int64()), "n_hit": pa.array(hits, pa.int64()),
                "n_items": pa.array([len(x) for x in items], pa.int64()), "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                "contaminated": pa.array([h > 0 for h in hits], pa.bool_()), "items": pa.array(items, pa.list_(pa.string())), "spans": pa.array(spans, pa.list_(span)),
            })

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES, text_col: str = "text") -> DataFrame:
    """docs, all columns, without the rows in which a window of the test set occurs. A row with a null text stays."""
    for _, part in _parts(benchmark, part_bytes):
        tables = docs.sparkSession.sparkContext.broadcast(searchers(part, window))

        def clean(batches, tables=tables):
            for b in slices(batches):
                yield b.filter(pa.array([not any(_scan(tables.value, t, None, None)[1]) for t in b.column(text_col).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "spans")


OP8_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bwin AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS win
         FROM bw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bwin),
dwin AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
         FROM dw, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
hits AS (SELECT doc_id, item_id, i, size FROM dwin JOIN bwin USING (size, win)),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(pos) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
