"""Operator 3, token-id output: training-order materialisation.

Texts become token ids, an end id closes each, and a text is cut into sequences of a fixed number of ids (the last is
padded). Sequences are numbered by (doc_id, digest of the text, part): ranges of that order are sorted, a task numbers
its own range, and the ranges' totals, one number each, shift them. So the numbers follow from the documents alone, not
from how they were partitioned. A keyed Feistel permutation of [0, N), by walking cycles of the next power of four, gives each sequence its slot in
the training order. Slots are cut into ranges of `shard_rows`; each range is one partition, sorted by slot, and is
written as one file of records of a fixed stride, so that a reader finds a slot by multiplication and can resume.

materialise() does all of it and reads the shards back, shuffling and writing one range of shards after the other, so that
the disk never holds the shuffled records of all of them; training_order() ends at the sorted records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import discard, durable, key_rows, mix64, shared_dir, slices, table

LENGTH, SHARD_ROWS, KEY, ROUNDS = 512, 16_384, 20_240_607, 6
#: Ranges of shards that materialise() writes one after the other.
WAVES = 4
#: Whether shuffle files go when the query that made them has ended, not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_RECORDS = "slot long, shard long, doc_id long, part int, n_tokens int, record binary"
_WRITTEN = "slot long, shard long, doc_id long, part int, n_tokens int, place long, record_sha256 string"


class Feistel:
    """A keyed bijection of [0, n)."""

    def __init__(self, n: int, key: int, rounds: int = ROUNDS):
        self.n, self.half = n, max(1, (max(1, n - 1).bit_length() + 1) // 2)
        keys = hashlib.shake_256(str(key).encode()).digest(8 * rounds)
        self.keys = np.frombuffer(keys, "<u8")
        self.mask = np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ (mix64(left + k) & self.mask), left
            else:
                left, right = right, left ^ (mix64(right + k) & self.mask)
        return left << np.uint64(self.half) | right

    def _walk(self, x, back: bool) -> np.ndarray:
        out = self._once(np.asarray(x, np.uint64), back)
        while len(far := np.flatnonzero(out >= self.n)):
            out[far] = self._once(out[far], back)
        return out.astype(np.int64)

    def slots(self, numbers) -> np.ndarray:
        return self._walk(numbers, False)

    def numbers(self, slots) -> np.ndarray:
        return self._walk(slots, True)


@lru_cache(maxsize=2)
def encoding(path: str) -> tuple[tiktoken.Encoding, int]:
    """The tokenizer and its end id, the first that is free."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("shards", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1


def id_type(path: str) -> str:
    return "<u2" if encoding(path)[1] < 65_536 else "<u4"


def training_order(docs: DataFrame, path: str | None = None, length: int = LENGTH, shard_rows: int = SHARD_ROWS, key: int = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sequence: slot, shard, doc_id, part (of its text), n_tokens (without padding), record (its bytes).

    Slots are 0 to N - 1 without gaps; a shard holds slots [shard * shard_rows, (shard + 1) * shard_rows) as one sorted
    partition. A null or empty text is one sequence with the end id alone. Null ids stay; repeated rows each have their
    sequences. An empty table gives an empty result; other columns of docs are not read; very long texts are cut, not cut
    off. The same documents have the same slots on any cluster: null ids come first, and rows of equal id and text have
    equal records. Tokens are kept in a table of the shared folder, so lost executors change no number."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = _numbered(docs, path, length, id_col, text_col)
    return _ordered(coded, _totals(coded), path, length, shard_rows, key)


def _numbered(docs: DataFrame, path: str, length: int, id_col: str, text_col: str) -> DataFrame:
    """Durable table of the texts' ids: pid (of its range), local (its first sequence's number in the range), parts."""
    kind = id_type(path)

    def encode(batches):
        enc, end = encoding(path)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            ids = [np.append(enc.encode_to_numpy(t, disallowed_special=()), end).astype(kind).tobytes() for t in texts]  # there are no special tokens
            digest = [hashlib.blake2b(t.encode("utf-8"), digest_size=16).digest() for t in texts]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "digest": pa.array(digest, pa.binary()), "ids": pa.array(ids, pa.binary())})

    def number(batches):
        pid, so_far = TaskContext.get().partitionId(), 0
        for b in batches:
            n = pc.binary_length(b.column("ids")).to_numpy().astype(np.int64) // np.dtype(kind).itemsize
            parts = -(-n // length)
            local = so_far + np.cumsum(parts) - parts
            so_far += int(parts.sum())
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "pid": pa.array(np.full(len(n), pid), pa.int32()), "local": pa.array(local), "parts": pa.array(parts), "ids": b.column("ids")})

    coded = key_rows(docs, id_col, text_col).mapInArrow(encode, "doc_id long, digest binary, ids binary")
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = key_rows(docs, id_col, text_col).agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] if ranges > 1 else None
    # ranges by the quantiles of the ids alone, since repartitionByRange() would encode all texts once more for its sample
    at = F.aggregate(F.array(*map(F.lit, sorted(set(bounds)))), F.lit(0), lambda n, x: n + F.when(F.col("doc_id") > x, 1).otherwise(0)) if bounds else F.lit(0)
    coded = coded.repartitionById(ranges, at).sortWithinPartitions("doc_id", "digest")
    return durable(coded.mapInArrow(number, "doc_id long, pid int, local long, parts long, ids binary"), "token-ids")


def _totals(coded: DataFrame) -> tuple[dict[int, int], int]:
    """Of a table that _numbered() made: the first sequence's number of each range, and how many there are in all."""
    starts, n = {}, 0
    for pid, m in sorted(map(tuple, coded.groupBy("pid").agg(F.sum("parts")).collect())):  # a number for each range
        starts[pid], n = n, n + m
    return starts, n


def _ordered(coded: DataFrame, totals: tuple[dict[int, int], int], path: str, length: int, shard_rows: int, key: int, first: int = 0, end: int | None = None) -> DataFrame:
    """The sequences of the shards [first, end) of a table that _numbered() made, in training order; end: all if None."""
    kind, (starts, n) = id_type(path), totals
    order = Feistel(n, key)
    end = max(1, -(-n // shard_rows)) if end is None else end
    low, high = first * shard_rows, end * shard_rows

    def place(batches):
        fill = encoding(path)[1]
        for b in slices(batches):
            parts, coded_ids = b.column("parts").to_numpy(), b.column("ids")
            begins = np.cumsum(parts) - parts
            at = np.repeat(np.array([starts[p] for p in b.column("pid").to_pylist()], np.int64) + b.column("local").to_numpy(), parts)
            part = np.arange(len(at)) - np.repeat(begins, parts)
            slot = order.slots(at + part)
            here = np.flatnonzero((slot >= low) & (slot < high))
            row, part, slot = np.repeat(np.arange(len(b)), parts)[here], part[here].astype(np.int32), slot[here]
            sizes, records, held = np.empty(len(here), np.int32), [], -1
            for i, (r, k) in enumerate(zip(row.tolist(), part.tolist())):
                if r != held:
                    held, ids = r, np.frombuffer(coded_ids[r].as_buffer(), kind)
                some = ids[k * length : (k + 1) * length]
                sizes[i] = len(some)
                records.append(some.tobytes() if len(some) == length else np.append(some, np.full(length - len(some), fill, kind)).tobytes())
            if records:
                yield pa.RecordBatch.from_pydict({"slot": pa.array(slot), "shard": pa.array(slot // shard_rows), "doc_id": b.column("doc_id").take(pa.array(row)), "part": pa.array(part), "n_tokens": pa.array(sizes), "record": pa.array(records, pa.binary())})

    return coded.mapInArrow(place, _RECORDS).repartitionById(max(1, end - first), (F.col("shard") - first).cast("int")).sortWithinPartitions("slot")


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in folder:
        return pa.fs.FileSystem.from_uri(folder)
    return pa.fs.LocalFileSystem(), folder.removeprefix("file:")


def _digest(fs, path: str) -> str:
    with fs.open_input_stream(path) as f:
        return hashlib.sha256(f.read()).hexdigest()


def _save(folder: str, shard: int, records: list[bytes]) -> tuple[str, int, str]:
    """Write a shard unless it is there with the same bytes: (path, bytes, digest)."""
    fs, root = _store(folder)
    path, data = f"{root}/shard-{shard:08d}.bin", b"".join(records)
    digest = hashlib.sha256(data).hexdigest()
    if not (fs.get_file_info(path).size == len(data) and _digest(fs, path) == digest):
        draft = f"{root}/.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as f:
            f.write(data)
        fs.move(draft, path)
    return path, len(data), digest


def _by_shard(batches):
    """(shard, its records as rows of a table); a shard's records follow each other."""
    at, held = None, []
    for b in batches:
        shards = b.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                if held and shards[i] != at:
                    yield at, pa.Table.from_batches(held)
                    held = []
                at = int(shards[i])
                held.append(b.slice(i, j - i))
    if held:
        yield at, pa.Table.from_batches(held)


def write_shards(records: DataFrame, folder: str) -> DataFrame:
    """Write each shard as folder/shard-NNNNNNNN.bin, records in slot order; one row per shard: shard, path, first_slot,
    rows, bytes, sha256. folder: a path or URI that pyarrow can write to, shared by all executors.

    A shard appears under its name only when whole; one that is there with the same bytes isn't written again, so a job
    that was cut off goes on where it stopped. Shards of another job, which may have the same size, are replaced; those
    beyond the last one of this job stay. records: from training_order()."""
    fs, root = _store(folder)
    fs.create_dir(root, recursive=True)

    def run(batches):
        for shard, rows in _by_shard(batches):
            path, size, digest = _save(folder, shard, rows.column("record").to_pylist())
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "first_slot": rows.column("slot")[0].as_py(), "rows": len(rows), "bytes": size, "sha256": digest}])

    return records.select("shard", "slot", "record").mapInArrow(run, "shard long, path string, first_slot long, rows long, bytes long, sha256 string")


def write_sequences(records: DataFrame, folder: str) -> DataFrame:
    """Write the shards as write_shards() does; one row per sequence: slot, shard, doc_id, part, n_tokens, place (of its
    record in the shard's file) and record_sha256."""
    fs, root = _store(folder)
    fs.create_dir(root, recursive=True)

    def run(batches):
        for shard, rows in _by_shard(batches):
            held = rows.column("record").to_pylist()
            _save(folder, shard, held)
            places = np.cumsum([0, *map(len, held[:-1])])
            digests = [hashlib.sha256(r).hexdigest() for r in held]
            out = rows.drop_columns("record").append_column("place", pa.array(places, pa.int64())).append_column("record_sha256", pa.array(digests, pa.string()))
            yield from out.combine_chunks().to_batches()

    return records.mapInArrow(run, _WRITTEN)


def read_sequences(rows: DataFrame, folder: str, stride: int) -> DataFrame:
    """rows of write_sequences() with the records, read from their places in the shards; one that isn't what was written is
    an error. A shard's rows are read from first to last, so its file is read once, in order."""

    def run(batches):
        at, f = None, None
        for b in slices(batches):
            records = []
            for shard, place, digest in zip(*(b.column(c).to_pylist() for c in ("shard", "place", "record_sha256"))):
                if shard != at:
                    if f:
                        f.close()
                    fs, root = _store(folder)
                    at, f = shard, fs.open_input_file(f"{root}/shard-{shard:08d}.bin")
                f.seek(place)
                records.append(f.read(stride))
                if hashlib.sha256(records[-1]).hexdigest() != digest:
                    raise ValueError(f"shard {shard} doesn't hold what was written at {place}")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(records, pa.binary())], names=[*b.schema.names, "record"])
        if f:
            f.close()

    return rows.mapInArrow(run, f"{_WRITTEN}, record binary")


def materialise(docs: DataFrame, folder: str, path: str | None = None, length: int = LENGTH, shard_rows: int = SHARD_ROWS, key: int = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all sequences of docs in training order as shards in folder, and read them back: one row per sequence, with the
    columns of write_sequences() and record. Null ids, empty texts, repeated rows and empty tables: as in training_order().

    The shards are written before this returns, in WAVES ranges one after the other, each with a pass over the table of token
    ids and a shuffle of its own records, whose files are deleted before the next. The table of token ids is deleted then, and
    what the result reads are the shards and tables of the sequences' places. Tasks that are run again find their shards
    there."""
    path, conf = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), docs.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        coded = _numbered(docs, path, length, id_col, text_col)
        totals = _totals(coded)
        shards = max(1, -(-totals[1] // shard_rows))
        cuts = sorted({shards * k // WAVES for k in range(WAVES + 1)})
        rows = [durable(write_sequences(_ordered(coded, totals, path, length, shard_rows, key, a, b), folder), "sequences") for a, b in zip(cuts, cuts[1:])]
    finally:
        conf.set(_CLEANUP, before)
    discard(coded)
    return read_sequences(reduce(DataFrame.unionByName, rows), folder, length * np.dtype(id_type(path)).itemsize)


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, shard_rows: int = SHARD_ROWS, kind: str = "<u2"):
    """Yield the ids of `count` sequences from slot `first` on, by seeking in the shards."""
    fs, root = _store(folder)
    stride = length * np.dtype(kind).itemsize
    while count > 0:
        shard, row = divmod(first, shard_rows)
        with fs.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
            take = min(count, shard_rows - row, f.size() // stride - row)
            if take <= 0:
                return
            f.seek(row * stride)
            yield from np.frombuffer(f.read(take * stride), kind).reshape(take, length)
        first, count = first + take, count - take


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}")
