"""Operator 2, substring dedup: repeated-phrase automata.

1. Each window of 50 words is named by its anchor, the least hash of the 10-word runs inside it; equal windows have
equal anchors, so only windows whose anchor stands in two documents can recur. About one word in 21 is an anchor.
2. Documents that hold recurring anchors give their stretches of such windows as segments, dealt by the first
document that holds the anchor (the owner), and a hot owner's segments over many salts by document.
3. Confirm: (owner, window hash) pairs with two documents or more, aggregated in each task first. The first document's
runs of confirmed windows are the recurring passages.
4. Each owner's passages are compiled into an Aho-Corasick automaton over words, with a phrase of 25 words at every
26th word of a passage: any 50 words of a passage hold a whole phrase. A hot owner's automaton is compiled once for each
salt. All segments stream through their owner's automaton; each hit is a phrase with the places in passages where it
stands, and the words on both sides are compared with the passage there. Nothing is found but through a hit. A partition
reads its passages, then its segments, row after row; no group is gathered.

Documents reach the automata by their anchors: a stretch without recurring anchors holds no window that recurs, so no
automaton could report in it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import HOT_KEYS, Words, discard, drop_ids, durable, keep_ids, key_rows, runs, table, window_min

WINDOW = 50
#: Anchors of one owner that one salt holds, about; a segment has some dozens.
SALT_ANCHORS = 20_000
#: Hits that an automaton remembers by the words around them; beyond it, it forgets them all.
REMEMBERED = 50_000


def anchor_words(window: int) -> int:
    return max(1, min(10, window // 2))


def anchors_of(w: Words, window: int) -> np.ndarray:
    """The anchor of every window, in order."""
    k = anchor_words(window)
    return window_min(w.grams(k), window - k + 1) if len(w) >= window else np.empty(0, np.uint64)


def _anchors(window: int):
    def run(batches):
        for b in batches:
            found = [np.unique(anchors_of(Words(t), window)) for t in b.column("text").to_pylist()]
            ids = np.repeat(np.array(b.column("doc_id").to_pylist(), np.int64), [len(x) for x in found])
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)), "doc_id": pa.array(ids)})

    return run


def _segments(window: int):
    """Stretches of windows whose anchors have one owner: texts of [start, start + n_windows + window - 1)."""

    def run(batches):
        for b in batches:
            out = {k: [] for k in ("owner", "salts", "doc_id", "th", "start", "text")}
            for doc_id, th, text, marks in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "text", "marks"))):
                w = Words(text)
                found = anchors_of(w, window)
                if not len(found):
                    continue
                keys = np.array([m["anchor"] for m in marks], np.int64).view(np.uint64)
                order = np.argsort(keys)
                at = order[np.minimum(np.searchsorted(keys, found, sorter=order), len(keys) - 1)]
                owners = np.array([m["owner"] for m in marks], np.int64)[at]
                salts = np.array([m["salts"] for m in marks], np.int64)[at]
                ok = keys[at] == found
                change = np.flatnonzero((owners[1:] != owners[:-1]) | (ok[1:] != ok[:-1])) + 1
                for s, e in zip([0, *change], [*change, len(found)]):
                    if ok[s]:
                        for k, v in zip(out, (int(owners[s]), int(salts[s]), doc_id, th, int(s), w.span(s, e + window - 1))):
                            out[k].append(v)
            kinds = {"text": pa.binary(), "start": pa.int32()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})

    return run


def _segment(data: bytes) -> Words:
    return Words(data.decode("utf-8"))


def _window_hashes(window: int):
    def run(batches):
        for b in batches:
            found = [np.unique(_segment(t).grams(window)) for t in b.column("text").to_pylist()]
            rep = [len(x) for x in found]
            cols = {k: pa.array(np.repeat(np.array(b.column(k).to_pylist(), np.int64), rep)) for k in ("owner", "doc_id")}
            yield pa.RecordBatch.from_pydict(cols | {"wh": pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64))})

    return run


def _passages(window: int):
    """Runs of confirmed windows in the first document's segments."""

    def run(batches):
        for b in batches:
            out = {"owner": [], "salts": [], "doc_id": [], "text": []}
            for owner, salts, doc_id, text, hashes in zip(*(b.column(c).to_pylist() for c in ("owner", "salts", "doc_id", "text", "hashes"))):
                w = _segment(text)
                for s, e in zip(*runs(np.isin(w.grams(window).view(np.int64), np.array(hashes, np.int64)))):
                    for k, v in zip(out, (owner, salts, doc_id, w.span(s, e + window - 1))):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "text" else pa.int64()) for k, v in out.items()})

    return run


class Automaton:
    """Passages, each with the document that has it first, behind the phrases that they hold.

    A phrase of a passage with the words around it, as far as a window with the phrase can reach, is a place. Places
    with equal words are one place, of the least document, so that a periodic passage has few. A hit is compared with all
    places of its phrase at once, and what it gave is remembered by the words around it, so that periodic texts and near
    copies, whose hits stand in the same words again and again, aren't compared anew."""

    def __init__(self, window: int):
        self.window, self.phrase = window, max(1, window // 2)
        self.stride = window - self.phrase + 1
        self.vocabulary: dict[bytes, int] = {}
        self._places: dict[tuple, dict] = {}
        self._tree = None
        self._met: dict[tuple[int, bytes], tuple] = {}

    def add(self, first: int, passage: Words) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in passage.data.split(b" ")]
        reach = self.window - self.phrase
        for t in range(0, len(ids) - self.phrase + 1, self.stride):
            before = min(reach, t)
            words = tuple(ids[t - before : t + self.window])
            places = self._places.setdefault(tuple(ids[t : t + self.phrase]), {})
            places[before, words] = min(first, places.get((before, words), first))

    def compile(self) -> None:
        self._tree = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        reach = self.window - self.phrase
        for n, (phrase, places) in enumerate(self._places.items()):
            # a row for each place, in order of its document, with -1 where the passage has ended
            rows = np.full((len(places), reach + self.window), -1, np.int32)
            ranked = sorted(places.items(), key=lambda x: x[1])
            for row, ((before, words), _) in zip(rows, ranked):
                row[reach - before : reach - before + len(words)] = words
            self._tree.add_word(phrase, (n, rows, np.array([first for _, first in ranked], np.int64)))
        if self._places:
            self._tree.make_automaton()

    def _reached(self, rows: np.ndarray, firsts: np.ndarray, own: np.ndarray) -> tuple:
        """(documents, starts, ends): from the hit's words on, what the places of this document and all before it cover."""
        reach = self.window - self.phrase
        differ = rows != own
        # from the phrase on to both sides, with one word that differs beyond the end
        left = np.concatenate([differ[:, reach - 1 :: -1] if reach else differ[:, :0], np.ones((len(rows), 1), bool)], 1).argmax(1)
        right = np.concatenate([differ[:, reach + self.phrase :], np.ones((len(rows), 1), bool)], 1).argmax(1)
        out: tuple[list, list, list] = [], [], []
        start = end = -1  # all stretches hold the phrase, so those of the documents so far make one
        for k in np.flatnonzero(left + right >= reach).tolist():
            if left[k] > start or right[k] > end:
                start, end = max(start, int(left[k])), max(end, int(right[k]))
                for x, v in zip(out, (int(firsts[k]), -start, self.phrase + end)):
                    x.append(v)
        return out

    def covered(self, doc_id: int, segment: Words) -> np.ndarray:
        """Which words lie in a window of a passage that a smaller document has first."""
        if self._tree is None:
            self.compile()
        n = len(segment)
        if not self._places or n < self.window:
            return np.zeros(n, bool)
        ids = [self.vocabulary.get(w, 0) for w in segment.data.split(b" ")]
        reach, steps = self.window - self.phrase, np.zeros(n + 1, np.int64)
        own = np.full(n + reach + self.window, -2, np.int32)  # -2: outside of the segment
        own[reach : reach + n] = ids
        data, size = own.tobytes(), own.itemsize
        for end, (phrase, rows, firsts) in self._tree.iter(tuple(ids)):
            at = end - self.phrase + 1
            words = data[at * size : (at + reach + self.window) * size]
            found = self._met.get((phrase, words))
            if found is None:
                if len(self._met) >= REMEMBERED:
                    self._met.clear()
                found = self._met[phrase, words] = self._reached(rows, firsts, own[at : at + reach + self.window])
            documents, starts, ends = found
            k = bisect_left(documents, doc_id) - 1
            if k >= 0:
                steps[at + starts[k]] += 1
                steps[at + ends[k]] -= 1
        return np.cumsum(steps[:-1]) > 0


def _stream(window: int):
    """Rows in the order owner, salt, passages before segments: covered runs in words of the document."""

    def run(batches):
        group, automaton = None, None
        for b in batches:
            out = {"doc_id": [], "th": [], "start": [], "end": []}
            for owner, salt, start, doc_id, th, text in zip(*(b.column(c).to_pylist() for c in ("owner", "salt", "start", "doc_id", "th", "text"))):
                if group != (owner, salt):
                    group, automaton = (owner, salt), Automaton(window)
                if start < 0:
                    automaton.add(doc_id, _segment(text))
                    continue
                for s, e in zip(*runs(automaton.covered(doc_id, _segment(text)))):
                    for k, v in zip(out, (doc_id, th, start + int(s), start + int(e))):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return run


def repeated_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Durable table (doc_id, th, start, end): words [start, end) are to go. docs: doc_id, text, th."""
    named = docs.filter("doc_id is not null")
    anchors = durable(named.mapInArrow(_anchors(window), "anchor long, doc_id long"), "anchors")
    owners = anchors.groupBy("anchor").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner < last").drop("last")
    marks = durable(anchors.join(owners, "anchor"), "recurring")
    discard(anchors)
    # only owners above the bound have salts, HOT_KEYS of them at most, so that their table is broadcast
    bound = max(SALT_ANCHORS, marks.count() // HOT_KEYS)
    salts = marks.groupBy("owner").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > bound).select("owner", F.ceil(F.col("c") / SALT_ANCHORS).alias("salts"))
    dealt = marks.join(F.broadcast(salts), "owner", "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("long")))
    lists = dealt.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "owner", "salts")).alias("marks"))  # one document's
    ids = durable(marks.select("doc_id").distinct(), "recurring-ids")
    holders = keep_ids(named, ids).join(lists, "doc_id")
    segments = durable(holders.select("doc_id", "th", "text", "marks").mapInArrow(_segments(window), "owner long, salts long, doc_id long, th long, start int, text binary"), "segments")
    discard(marks, ids)
    hashes = segments.select("owner", "doc_id", "text").mapInArrow(_window_hashes(window), "owner long, doc_id long, wh long")
    confirmed = hashes.groupBy("owner", "wh").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    firsts = confirmed.groupBy("owner", F.col("first").alias("doc_id")).agg(F.collect_list("wh").alias("hashes"))  # one document's
    passages = segments.join(firsts, ["owner", "doc_id"]).select("owner", "salts", "doc_id", "text", "hashes").mapInArrow(_passages(window), "owner long, salts long, doc_id long, text binary")
    passages = passages.distinct().select("owner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(-1).alias("start"), "doc_id", F.lit(0).cast("long").alias("th"), "text")
    rows = segments.select("owner", F.pmod(F.xxhash64("doc_id"), "salts").alias("salt"), "start", "doc_id", "th", "text")
    dealt = passages.unionByName(rows).repartition("owner", "salt").sortWithinPartitions("owner", "salt", "start")
    repeated = durable(dealt.mapInArrow(_stream(window), "doc_id long, th long, start long, end long"), "repeated")
    discard(segments)
    return repeated


def _kept(text: str | None, spans: list) -> tuple[int, int, str]:
    words = (text or "").encode("utf-8").split()
    keep = np.ones(len(words), bool)
    for s in spans or ():
        keep[s["start"] : s["end"]] = False
    n = int(keep.sum())
    left = b" ".join(words if n == len(words) else [w for w, k in zip(words, keep) if k])
    return len(words), len(words) - n, left.decode("utf-8")


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256 and, if wanted, kept_text.

    A null text has no words. A null id comes after all others: its rows lose nothing and take nothing from others.
    Rows that repeat an id don't count against each other. Texts shorter than the window stay whole. The rest of a text
    from which all is removed is empty. An empty table gives an empty result; other columns of docs are not read; very
    long texts are read whole."""
    rows = key_rows(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("th"))
    gone = repeated_runs(rows, window)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def finish(batches):
        for b in batches:
            spans = b.column("spans").to_pylist() if "spans" in b.schema.names else [None] * len(b)
            got = [_kept(t, s) for t, s in zip(b.column("text").to_pylist(), spans)]
            cols = {"doc_id": b.column("doc_id"), "n_words": pa.array([x[0] for x in got], pa.int64()), "n_removed": pa.array([x[1] for x in got], pa.int64()), "kept_sha256": pa.array([hashlib.sha256(x[2].encode()).hexdigest() for x in got], pa.string())}
            yield pa.RecordBatch.from_pydict(cols | ({"kept_text": pa.array([x[2] for x in got], pa.string())} if with_text else {}))

    ids = durable(gone.select("doc_id").distinct(), "repeated-ids")
    spans = gone.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # one document's
    cut = keep_ids(rows, ids).join(spans, ["doc_id", "th"], "left").select("doc_id", "text", "spans").mapInArrow(finish, schema)
    return drop_ids(rows, ids).select("doc_id", "text").mapInArrow(finish, schema).unionByName(cut)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
seen AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM win),
gone AS (SELECT DISTINCT doc_id, pos FROM seen, unnest(range(i, i + 50)) AS t(pos) WHERE first < doc_id),
words AS (SELECT doc_id, pos, w[pos] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(pos)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
