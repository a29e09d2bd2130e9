"""Pieces that the text operators share: reading, durable tables, id filters, word bytes."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts: space and the characters 9 to 13.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
#: Ids that drop_ids() and keep_ids() broadcast at most: 2 million longs are 16 MB. Beyond it they join by shuffle.
BROADCAST_IDS = 2_000_000
#: Rows of a keyed table that join_keyed() broadcasts whole; and, of a larger one, at most so many of the hottest keys.
BROADCAST_KEYS, HOT_KEYS = 250_000, 10_000
#: Folders of the tables that durable() wrote.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a folder of the warehouse, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    return folder


def durable(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: it cuts the lineage and survives lost executors.
    by: columns whose values have folders of their own."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that durable() wrote, once all that reads them is written as well."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(df))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def key_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator reads, under the names doc_id and text, so that no other column can clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def small_ids(ids: DataFrame) -> bool:
    """Whether ids (a durable one-column table) may be broadcast."""
    return ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS


def _by_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    ids = ids.select(F.col(ids.columns[0]).cast("long").alias("_the_id"))
    ids = F.broadcast(ids) if small_ids(ids) else ids
    return docs.join(ids, docs[f"`{id_col}`"].cast("long") == ids["_the_id"], how)


def drop_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs without the rows whose id is in ids. A row with a null id stays."""
    return _by_ids(docs, ids, id_col, "left_anti")


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs whose id is in ids."""
    return _by_ids(docs, ids, id_col, "left_semi")


def join_keyed(left: DataFrame, right: DataFrame, by: list[str], size: str, how: str = "inner") -> DataFrame:
    """left joined with right (durable; one row for each key, none of them null), inner or left. size: a column of right
    that bounds how many rows of left have the key.

    A small right is broadcast. Of a larger one the hottest keys are, HOT_KEYS of them at most since their sizes share
    one total, so that no key's rows of left meet in one task; left is read twice then."""
    n, total = right.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    if n <= BROADCAST_KEYS:
        return left.join(F.broadcast(right), by, how)
    hot = F.broadcast(right.filter(F.col(size) > max(1_000, total // HOT_KEYS)))
    cold = right.filter(F.col(size) <= max(1_000, total // HOT_KEYS))
    return left.join(hot, by).unionByName(left.join(hot, by, "left_anti").join(cold, by, how))


def held_out(id_col: str, modulus: int, remainder: int):
    """Column: crc32 of the id as text leaves this remainder. A null id isn't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def slices(batches, rows: int = 1_000):
    """The Arrow batches in pieces, so that what is made of a piece stays small."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


# ---- words as bytes --------------------------------------------------------------------------------------------------

_MIX = np.uint64(0x9E3779B97F4A7C15)
_P = 0xD6E8FEB86659FD93
_POW: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if len(_POW["p"]) <= n:
        size = max(1 << 18, 1 << n.bit_length())
        inv = pow(_P, -1, 1 << 64)
        for k, base in (("p", _P), ("i", inv)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POW[k] = np.cumprod(a, dtype=np.uint64)
    return _POW["p"], _POW["i"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of one text: data is the words joined by single spaces, starts and ends are their byte offsets.

    grams(k) hashes every run of k words; equal runs have equal hashes wherever they stand."""

    __slots__ = ("data", "starts", "ends", "_sums")

    def __init__(self, text: str | None, lower: bool = False):
        raw = (text or "").encode("utf-8")
        if lower:
            raw = raw.lower()  # bytes.lower() changes A-Z only
        self.data = b" ".join(raw.split())  # bytes.split() cuts at space and 9 to 13
        a = np.frombuffer(self.data, np.uint8)
        gaps = np.flatnonzero(a == 32)
        n = len(gaps) + 1 if len(a) else 0
        self.starts = np.empty(n, np.int64)
        self.ends = np.empty(n, np.int64)
        if n:
            self.starts[0], self.starts[1:], self.ends[:-1], self.ends[-1] = 0, gaps + 1, gaps, len(a)
        self._sums = None

    def __len__(self) -> int:
        return len(self.starts)

    def grams(self, k: int) -> np.ndarray:
        n = len(self) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        p, inv = _powers(len(self.data) + 1)
        if self._sums is None:
            a = np.frombuffer(self.data, np.uint8).astype(np.uint64)
            a += np.uint64(1)
            a *= p[: len(a)]
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(a, dtype=np.uint64)])
        s, e = self.starts[:n], self.ends[k - 1 :]
        h = (self._sums[e] - self._sums[s]) * inv[s]
        return mix64(h ^ ((e - s).astype(np.uint64) * _MIX))

    def span(self, a: int, b: int) -> bytes:
        """Words a to b - 1, joined by single spaces."""
        return self.data[self.starts[a] : self.ends[b - 1]] if b > a else b""


def window_min(h: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours of h; of all of h where it has fewer."""
    if len(h) <= w:
        return h[:0] if not len(h) else np.array([h.min()], h.dtype)
    out, have = h, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (w - have)], out[w - have :]) if w > have else out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    d = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)
