"""Operator 11, ranked lexical search: document-at-a-time merge of compressed postings, shard by shard.

Index: each task cuts its documents into shards of bounded size and writes, for each shard, a header row (ids and lengths of
its documents, by id) and a row for each term (gaps and frequencies as variable-length integers). Nothing is shuffled for it,
and a term of a third of all documents is spread over all shards. Search: the rows of the queries' terms meet by shard. There
each query's postings are merged by a heap of list heads, document by document, into a heap of the k best, keyed by score,
then id. Bounds make it leave out only what can't be among the k best: a list whose terms can't lift a document above the
k-th score is looked up for documents of other lists rather than merged. The best of shards are merged in two steps.

Queries are taken in parts of bounded bytes, with a pass over the index for each.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm.common import discard, durable, key_rows, table
from varloom.llm.decontaminate import _TO

#: Documents and bytes of text of a shard at most (a longer text is a shard of its own); bytes of a piece that is cut into words.
SHARD_DOCS, SHARD_BYTES, PIECE = 8_192, 16_000_000, 1_000_000
#: Results of a query; bytes of query text of a part; first-step groups that each query's results are merged in.
TOP, PART_BYTES, MERGE = 20, 2_000_000, 64
_INDEX = "shard long, term string, df long, tokens long, postings binary"


def term_pieces(text: str | None, piece: int = PIECE):
    """Terms of a text, in lists of about piece bytes: runs of digits, letters and characters from 128 on, A-Z lower-cased."""
    raw, at = (text or "").encode("utf-8").translate(_TO), 0
    while at < len(raw):
        end = raw.find(b" ", at + piece)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


class _Codes(dict):
    def __missing__(self, term):
        code = self[term] = len(self)
        return code


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length integers of seven bits a byte, the high bit set but in the last; and where each ends."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << (7 * k))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(v) else 0, np.uint8)
    starts = ends - size
    for k in range(int(size.max()) if len(v) else 0):
        on = size > k
        more = (size[on] > k + 1).astype(np.uint8) << 7
        out[starts[on] + k] = ((v[on] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out, ends


def unpack(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.empty(0, np.int64)
    last = np.flatnonzero(b < 128)
    starts = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(b)) - np.repeat(starts, last - starts + 1)
    return np.add.reduceat((b & 127).astype(np.int64) << (7 * place), starts)


def _shard(number: int, docs: list, codes: _Codes) -> pa.RecordBatch:
    """docs: ids and the codes of their terms."""
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0]))
    lengths = np.array([len(c) for _, c in docs], np.int64)
    keys = np.concatenate([c for _, c in docs]).astype(np.int64) * len(docs) + np.repeat(np.arange(len(docs)), lengths)
    keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    tf, term, doc = np.diff(np.append(new, len(keys))), keys[new] // len(docs), keys[new] % len(docs)
    first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    gap = np.diff(doc, prepend=-1) - 1
    gap[first] = doc[first]
    data, ends = pack(np.stack([gap, tf - 1], 1).ravel())
    df = np.diff(np.append(first, len(term)))
    cuts = np.concatenate([[0], ends[2 * (first + df) - 1]])
    nulls = sum(i is None for i, _ in docs)
    header = np.concatenate([[len(docs), nulls], [i for i, _ in docs if i is not None], lengths]).astype("<i8").tobytes()
    names = [t.decode("utf-8", "replace") for t in codes]  # codes count up in the order of the dictionary
    raw = data.tobytes()
    blobs = [header] + [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    n = len(names) + 1
    return pa.RecordBatch.from_pydict({
        "shard": pa.array(np.full(n, number)), "term": pa.array([None] + names, pa.string()), "df": pa.array(np.concatenate([[len(docs)], df]), pa.int64()),
        "tokens": pa.array(np.concatenate([[lengths.sum()], np.zeros(n - 1)]), pa.int64()), "postings": pa.array(blobs, pa.binary()),
    })


def _index(shard_docs: int, shard_bytes: int, piece: int):
    def run(batches):
        base, number, held, size, codes = TaskContext.get().partitionId() << 32, 0, [], 0, _Codes()
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                text = text.as_py()
                parts = [np.fromiter(map(codes.__getitem__, words), np.int32, len(words)) for words in term_pieces(text, piece)]
                found = np.concatenate(parts) if parts else ()
                if len(found):
                    held.append((doc_id, found))
                    size += len(text)
                if len(held) >= shard_docs or size >= shard_bytes:
                    yield _shard(base + number, held, codes)
                    number, held, size, codes = number + 1, [], 0, _Codes()
        if held:
            yield _shard(base + number, held, codes)

    return run


def build_index(docs: DataFrame, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES, piece: int = PIECE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A durable table of shards' headers (term null) and postings. Documents without terms are not in it."""
    return durable(key_rows(docs, id_col, text_col).mapInArrow(_index(shard_docs, shard_bytes, piece), _INDEX), "postings")


def best_of_shard(lists: list, k: int) -> list[tuple[int, int]]:
    """The k best (score, document), highest first, equal scores by ascending document; scores of 0 are none.

    lists: for each term (documents ascending, parts of the score, the greatest part, the k-th greatest or 0)."""
    lists = sorted((x for x in lists if x[2] > 0), key=lambda x: x[2])
    sums, width = list(accumulate(x[2] for x in lists)), max(1, len(lists))
    floor = max([0, *(x[3] - 1 for x in lists)])  # k documents reach a list's k-th greatest part
    low = bisect_left(sums, floor + 1)  # lists before low can't lift a document above floor by themselves
    heads, at, best = [lists[j][0][0] * width + j for j in range(low, len(lists))], [0] * width, []
    heapq.heapify(heads)
    while heads:
        doc, score = heads[0] // width, 0
        end = (doc + 1) * width
        while heads and heads[0] < end:
            j = heads[0] - doc * width
            docs, parts = lists[j][:2]
            i = at[j]
            score += parts[i]
            at[j] = i = i + 1
            if i < len(docs):
                heapq.heapreplace(heads, docs[i] * width + j)
            else:
                heapq.heappop(heads)
        for j in range(low - 1, -1, -1):
            if score + sums[j] <= floor:
                break
            docs, parts = lists[j][:2]
            i = bisect_left(docs, doc)
            if i < len(docs) and docs[i] == doc:
                score += parts[i]
        if score > floor:
            (heapq.heappush if len(best) < k else heapq.heappushpop)(best, (score, -doc))
            if len(best) == k and best[0][0] > floor:
                floor = best[0][0]
                if low < len(lists) and sums[low] <= floor:
                    low = bisect_left(sums, floor + 1)
                    heads = [h for h in heads if h % width >= low]
                    heapq.heapify(heads)
    return [(score, -doc) for score, doc in sorted(best, reverse=True)]


def _search(given, k: int):
    schema = pa.schema([("q", pa.int64()), ("shard", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        queries, weights, n_docs, n_tokens = given.value
        terms, blobs, shard = group.column("term").to_pylist(), group.column("postings").to_pylist(), group.column("shard")[0].as_py()
        head = np.frombuffer(blobs[terms.index(None)], "<i8")
        n, nulls = int(head[0]), int(head[1])
        ids = head[2 : 2 + n - nulls].tolist() + [None] * nulls
        m = np.array([75 + 25 * x * n_docs // n_tokens for x in head[2 + n - nulls :].tolist()], np.int64)
        lists = {}
        for term, blob in zip(terms, blobs):
            if term is not None:
                v = unpack(blob)
                docs, tf = np.cumsum(v[::2] + 1) - 1, v[1::2] + 1
                part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[docs]))
                kth = int(np.partition(part, len(part) - k)[len(part) - k]) if len(part) >= k else 0
                lists[term] = docs.tolist(), part.tolist(), int(part.max()), kth
        rows = []
        for q, wanted in queries:
            mine = []
            for term, times in wanted.items():
                if found := lists.get(term):
                    mine.append(found if times == 1 else (found[0], [p * times for p in found[1]], found[2] * times, found[3] * times))
            rows += [(q, shard, ids[doc], score) for score, doc in best_of_shard(mine, k)]
        return pa.table([list(c) for c in zip(*rows)] if rows else [[]] * 4, schema=schema)

    return run


def _best(rows: DataFrame, k: int, *by: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = TOP, part_bytes: int = PART_BYTES, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The k best documents of each row of queries: item_id, rank (from 1), doc_id, score, as a durable table.

    Scores are those of the operator's contract. Documents with a score of 0 are no result, so queries without terms (null,
    empty) have none. A null item_id stays null; rows that repeat an item_id are ranked each by itself. Null doc_ids are
    documents like others, after all ids among equal scores; rows that repeat a document each have their rank. An empty index
    or query table gives no rows."""
    spark = index.sparkSession
    n_docs, n_tokens = index.filter("term IS NULL").agg(F.sum("df"), F.sum("tokens")).first()
    items = queries.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    n_parts = max(1, math.ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / part_bytes))
    found = []
    for p in range(n_parts if n_docs else 0):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)) == p).collect()  # about part_bytes of text
        wanted = [(q, Counter(t.decode("utf-8", "replace") for words in term_pieces(r.text) for t in words)) for q, r in enumerate(rows)]
        terms = spark.createDataFrame([(t,) for t in sorted(set().union(*(c for _, c in wanted)))], "term string")
        hits = index.join(F.broadcast(terms), "term")
        df = dict(hits.groupBy("term").agg(F.sum("df")).collect())  # terms of one part at most
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        given = spark.sparkContext.broadcast((wanted, weights, n_docs, n_tokens))
        shards = hits.select(index.columns).unionByName(index.filter("term IS NULL"))
        near = shards.groupBy("shard").applyInArrow(_search(given, k), "q long, shard long, doc_id long, score long")
        best = _best(_best(near.withColumn("of", F.pmod(F.xxhash64("shard"), F.lit(MERGE))), k, "q", "of").drop("rank"), k, "q")
        names = spark.createDataFrame([(q, r.item_id) for q, r in enumerate(rows)], "q long, item_id long")
        found.append(durable(best.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"), "ranked"))
        given.destroy()
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in found:
        out = out.unionByName(part)
    return found[0] if len(found) == 1 else out


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"))
    out = search(index, table(spark, sf_dir, "benchmark"))
    discard(index)
    return out


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM b) GROUP BY ALL),
c AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY term, nn),
m AS (SELECT r, doc_id, 100 - 25 + ((25 * len(d.w) * nn) // ll) AS m FROM d, c WHERE len(d.w) > 0),
s AS (SELECT item_id, r, doc_id, CAST(sum(times * w.w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 20
"""
