"""Position indexes of block gzip variant files, and reads of regions that open only the blocks they need.

An index stands beside its file, with .tbi added to the name, in the usual binary form: bins with chunks of the file and, for
each window of 16,384 positions, the first place of a line that reaches into it. A place is the offset of a block in the file
and one in the block's text, 16 bits of them the latter. Tasks read the file in splits, whose places count from the split's
first block; sums over the splits before make them absolute. Indexes are right for lines in any
order, and small for files in genome order.
"""

from __future__ import annotations

import gzip
import struct
import uuid
from bisect import bisect_right

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.sources.blockgzip import BLOCK_TEXT, HEADER, _splits, block_records, deflate, inflate, own_names
from varloom.sources.files import list_files

# Fixed values of the format: positions of the smallest bin, positions of all, first bins of the levels, number of bins.
SHIFT, REACH, LEVELS, BINS = 14, 1 << 29, (4681, 585, 73, 9, 1, 0), 37450
#: Compressed bytes that a task reads of a file at once, where the index knows a place to cut.
PIECE = 8_000_000
_ROWS = pa.schema({"file": pa.string(), "start": pa.int64(), "contig": pa.string(), "bin": pa.int32(), "window": pa.int32(), "beg": pa.int64(), "stop": pa.int64()})
_ENDS = pa.schema({"file": pa.string(), "start": pa.int64(), "part": pa.int32(), "ended": pa.bool_(), "piece": pa.binary(), "place": pa.int64(), "bytes": pa.int64()})


def bin_of(beg: int, stop: int) -> int:
    """The smallest bin that holds the zero-based, half-open range."""
    shift = SHIFT
    for first in LEVELS:
        if beg >> shift == (stop - 1) >> shift:
            return first + (beg >> shift)
        shift += 3
    return 0


def bins_over(beg: int, stop: int) -> list[int]:
    """All bins that may hold something which overlaps the range."""
    return [b for i, first in enumerate(LEVELS) for b in range(first + (beg >> SHIFT + 3 * i), first + ((stop - 1) >> SHIFT + 3 * i) + 1)]


def _extent(line: bytes) -> tuple[str, int, int] | None:
    """Contig and zero-based, half-open range of a line: that of its reference allele, or up to the field END."""
    if not line or line[:1] == b"#":
        return None
    f = line.split(b"\t", 8)
    beg = int(f[1]) - 1
    stop = beg + max(1, len(f[3]))
    if len(f) > 7 and b"END=" in f[7]:
        stop = max(beg + 1, next((int(x[4:]) for x in f[7].split(b";") if x.startswith(b"END=")), stop))
    if not 0 <= beg < stop <= REACH:
        raise ValueError(f"a position outside of the index: {line[:60]!r}")
    return f[0].decode(), beg, stop


class _Found:
    """What the lines of a split add to the index: chunks by bin, lines that follow each other in one bin being one chunk, and
    first places by window."""

    def __init__(self):
        self.chunks: list[list] = []
        self.first: dict[tuple, int] = {}

    def add(self, line: bytes, beg: int, stop: int) -> None:
        at = _extent(line)
        if at is None:
            return
        contig, b, s = at
        own = bin_of(b, s)
        if self.chunks and self.chunks[-1][:2] == [contig, own] and self.chunks[-1][3] == beg:
            self.chunks[-1][3] = stop
        else:
            self.chunks.append([contig, own, beg, stop])
        for w in range(b >> SHIFT, (s - 1 >> SHIFT) + 1):
            self.first[contig, w] = min(beg, self.first.get((contig, w), beg))

    def batches(self, file: str, start: int):
        rows = [(file, start, c, b, None, beg, stop) for c, b, beg, stop in self.chunks] + [(file, start, c, None, w, beg, None) for (c, w), beg in self.first.items()]
        for at in range(0, len(rows), 100_000):
            yield _batch(rows[at : at + 100_000], _ROWS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _blocks(file: str, start: int, records):
    """(offset of a block from the split's first, its size, its text)."""
    at = 0
    for k, r in enumerate(records):
        if r and k == 0 and start == 0:
            raise ValueError(f"not block gzip: {file}")
        if r:
            size = struct.unpack("<H", r[:2])[0] + 1
            yield at, size, inflate(r)
            at += size


def _inner(batches):
    """Index rows of the lines that begin and end inside a split."""
    for file, start, records in _splits(batches):
        found, held, begun = _Found(), b"", None
        for at, size, text in _blocks(file, start, records):
            pos = 0
            while (cut := text.find(b"\n", pos)) >= 0:
                after = at + size << 16 if cut + 1 == len(text) else at << 16 | cut + 1
                if begun is not None:
                    found.add(held + text[pos:cut], begun, after)
                held, begun, pos = b"", after, cut + 1
            if begun is not None:
                held += text[pos:]
        yield from found.batches(file, start)


def _outer(batches):
    """Of each split what stands before its first line end (part 0, with the place after it) and after its last (part 1, with
    its place), and the bytes of its blocks."""
    for file, start, records in _splits(batches):
        first, held, ended, after, last, total = [], [], False, 0, 0, 0
        for at, size, text in _blocks(file, start, records):
            total = at + size
            place = lambda cut: at + size << 16 if cut + 1 == len(text) else at << 16 | cut + 1  # noqa: B023, E731
            cut = text.rfind(b"\n")
            if not ended and cut >= 0:
                first.append(text[: text.find(b"\n")])
                ended, after = True, place(text.find(b"\n"))
            elif not ended:
                first.append(text)
            if ended and cut >= 0:
                held, last = [text[cut + 1 :]], place(cut)
            elif ended:
                held.append(text)
        rows = [(file, start, 0, ended, b"".join(first), after, total)] + ([(file, start, 1, False, b"".join(held), last, None)] if ended else [])
        yield _batch(rows, _ENDS)


def _mended(batches):
    """Index rows of the lines that several splits hold, whose places are absolute."""
    for b in batches:
        for x in b.to_pylist():
            found = _Found()
            found.add(x["line"], x["beg"], x["stop"])
            yield from found.batches(x["file"], 0)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def index_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, contig, bin, beg, stop of chunks (window null), and file, contig, window, beg of first places (bin null)."""
    records, named = block_records(spark, paths)
    if records is None:
        return spark.createDataFrame([], "file string, contig string, bin int, window int, beg long, stop long")
    ends = records.mapInArrow(_outer, _ddl(_ENDS))
    before = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
    # two rows a split: the sums are of part 0 alone, so a split's part 1 takes its own bytes off again
    here = F.coalesce(F.sum("bytes").over(before), F.lit(0)) - F.when(F.col("part") == 1, F.lag("bytes").over(Window.partitionBy("file").orderBy("start", "part"))).otherwise(0)
    ends = ends.withColumn("base", here).withColumn("line", F.sum("part").over(upto))
    place = F.shiftleft(F.col("base"), 16) + F.col("place")
    pieces = F.expr("array_join(transform(array_sort(collect_list(struct(start, part, hex(piece)))), x -> x.col3), '')")
    cut = ends.groupBy("file", "line").agg(
        F.unhex(pieces).alias("line_"), F.coalesce(F.max(F.when(F.col("part") == 1, place)), F.lit(0)).alias("beg"),
        F.coalesce(F.max(F.when(F.col("ended"), place)), F.max(F.shiftleft(F.col("base") + F.col("bytes"), 16)), F.max(place)).alias("stop"),
    )
    mended = cut.select("file", F.col("line_").alias("line"), "beg", F.greatest("stop", F.col("beg") + 1).alias("stop")).mapInArrow(_mended, _ddl(_ROWS))
    bases = ends.filter("part = 0").select("file", "start", "base")
    inner = records.mapInArrow(_inner, _ddl(_ROWS)).join(bases, ["file", "start"], "left")
    add = F.shiftleft(F.col("base"), 16)
    inner = inner.withColumns({"beg": F.col("beg") + add, "stop": F.col("stop") + add}).select("file", "contig", "bin", "window", "beg", "stop")
    rows = inner.unionByName(mended.select("file", "contig", "bin", "window", "beg", "stop"))
    windows = rows.filter("bin is null").groupBy("file", "contig", "window").agg(F.min("beg").alias("beg"))
    chunks = rows.filter("bin is not null")
    return own_names(chunks.unionByName(windows.select("file", "contig", F.lit(None).cast("int").alias("bin"), "window", "beg", F.lit(None).cast("long").alias("stop"))), named)


def _assemble(rows: pd.DataFrame) -> bytes:
    """The index of one file, not yet compressed."""
    firsts = rows[rows.bin.notna()].groupby("contig").beg.min().sort_values()
    names = list(firsts.index)
    text = b"".join(n.encode() + b"\0" for n in names)
    out = [b"TBI\1", struct.pack("<8i", len(names), 2, 1, 2, 0, ord("#"), 0, len(text)), text]
    for name in names:
        own = rows[rows.contig == name]
        bins: dict[int, list] = {}
        for b, beg, stop in own[own.bin.notna()].sort_values(["bin", "beg"])[["bin", "beg", "stop"]].itertuples(index=False):
            chunks = bins.setdefault(int(b), [])
            if chunks and beg >> 16 <= chunks[-1][1] >> 16:  # the same block, or the next place of it
                chunks[-1][1] = max(chunks[-1][1], int(stop))
            else:
                chunks.append([int(beg), int(stop)])
        out.append(struct.pack("<i", len(bins)))
        for b, chunks in bins.items():
            out.append(struct.pack("<Ii", b, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
        first = dict(own[own.bin.isna()][["window", "beg"]].astype("int64").itertuples(index=False))
        windows, least = [0] * (max(first) + 1), max(first.values())
        for w in range(len(windows) - 1, -1, -1):  # the first place of this window or a later one, whatever the order of lines
            windows[w] = least = min(least, first.get(w, least))
        out.append(struct.pack(f"<i{len(windows)}Q", len(windows), *windows))
    return b"".join(out)


def _store(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a file and its path there; Spark writes local files as file:/path."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri else (pa.fs.LocalFileSystem(), uri)


def write_index(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Write the index of each block gzip file beside it; returns the indexes' names. Files without lines get none.

    A file's index is put together in one task: it has at most a chunk for each bin and block and a number for each window, a
    few MB for a whole genome, whatever the number of lines. Tasks write through a store that pyarrow knows; an index appears
    under its name only when whole. An index doesn't change with how the file was split."""

    def save(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fs, path = _store(key[0] + ".tbi")
        raw = _assemble(rows)
        draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as f:
            f.write(b"".join(deflate(raw[i : i + BLOCK_TEXT]) for i in range(0, len(raw), BLOCK_TEXT)) + deflate(b""))
        fs.move(draft, path)
        return pd.DataFrame({"index": [key[0] + ".tbi"]})

    made = index_rows(spark, paths).groupBy("file").applyInPandas(save, "index string")
    return sorted(r[0] for r in made.collect())  # a name a file


def parse_index(raw: bytes) -> dict[str, tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """Of each contig its chunks by bin and its first places by window."""
    if raw[:4] != b"TBI\1":
        raise ValueError("not a position index")
    n, *_, size = struct.unpack_from("<8i", raw, 4)
    names, at, out = raw[36 : 36 + size].split(b"\0")[:n], 36 + size, {}
    for name in names:
        (many,), bins = struct.unpack_from("<i", raw, at), {}
        at += 4
        for _ in range(many):
            b, k = struct.unpack_from("<Ii", raw, at)
            places = struct.unpack_from(f"<{2 * k}Q", raw, at + 8)
            if b < BINS - 1:  # a bin beyond them holds counts
                bins[b] = list(zip(places[::2], places[1::2]))
            at += 8 + 16 * k
        (k,) = struct.unpack_from("<i", raw, at)
        out[name.decode()] = bins, list(struct.unpack_from(f"<{k}Q", raw, at + 4))
        at += 4 + 8 * k
    return out


def chunks_of(index: dict, intervals: list[tuple[str, int, int]], piece: int = PIECE) -> list[tuple[int, int]]:
    """Places (from, to) of a file that hold all lines which overlap the closed one-based intervals; none overlap, and long
    ones are cut where the index knows the place of a line."""
    wanted, cuts = [], set()
    for contig, first, last in intervals:
        bins, windows = index.get(contig, ({}, []))
        if not windows or (first - 1) >> SHIFT >= len(windows):
            continue  # the contig's lines end before
        least = windows[max(0, first - 1) >> SHIFT]
        cuts.update(windows)
        for b in bins_over(max(0, first - 1), min(REACH, last)):
            wanted += [(max(beg, least), stop) for beg, stop in bins.get(b, ()) if stop > least]
    merged: list[list[int]] = []
    for beg, stop in sorted(wanted):
        if merged and beg <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([beg, stop])
    out, known = [], sorted(cuts)
    for beg, stop in merged:
        for cut in known[bisect_right(known, beg) :]:
            if cut >= stop:
                break
            if (cut >> 16) - (beg >> 16) >= piece:
                out.append((beg, cut))
                beg = cut
        out.append((beg, stop))
    return out


def _lines_between(f, beg: int, stop: int):
    """Lines of an open file that begin at places from beg on and before stop; only their blocks are read."""
    at, skip, held, place = beg >> 16, beg & 0xFFFF, b"", beg
    while True:
        f.seek(at)
        head = f.read(len(HEADER) + 2)
        if not head:
            if held:
                yield held
            return
        if head[: len(HEADER)] != HEADER:
            raise ValueError("a place of the index isn't a block's")
        size = struct.unpack("<H", head[-2:])[0] + 1
        text = inflate(head[-2:] + f.read(size - len(head)))
        pos = skip
        skip = 0
        while (cut := text.find(b"\n", pos)) >= 0:
            yield held + text[pos:cut]
            held, pos = b"", cut + 1
            place = at + size << 16 if pos == len(text) else at << 16 | pos
            if place >= stop:
                return
        held += text[pos:]
        at += size
        if not held and at << 16 >= stop:
            return


def region_lines(spark: SparkSession, files: list[str], intervals: list[tuple[str, int, int]]) -> DataFrame:
    """value and file of the lines of indexed block gzip files that overlap any of the closed one-based intervals, each line
    once. files: block gzip files whose indexes write_index() or another tool made, without the indexes' names.

    Tasks read the indexes, then only the blocks that these name; the pieces are dealt over tasks by file and place. A file
    without an index is an error. Intervals are a list that a user gives; empty, nothing is read."""
    wanted = [(c, int(a), int(b)) for c, a, b in intervals if b >= a and b >= 1]
    own = [x for f in files for x in list_files(spark, f) if not x.endswith(".tbi")]
    if not wanted or not own:
        return spark.createDataFrame([], "value string, file string")
    for f in own:
        list_files(spark, f + ".tbi")  # an error where it isn't there

    def plan(batches):
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                places = chunks_of(parse_index(gzip.decompress(content)), wanted)
                yield pa.RecordBatch.from_pydict({"file": pa.array([path[:-4]] * len(places), pa.string()), "beg": pa.array([p[0] for p in places], pa.int64()), "stop": pa.array([p[1] for p in places], pa.int64())})

    by_contig: dict[str, list] = {}
    for c, a, b in wanted:
        by_contig.setdefault(c, []).append((a - 1, b))

    def read(batches):
        for b in batches:
            for file, beg, stop in zip(*(b.column(c).to_pylist() for c in ("file", "beg", "stop"))):
                fs, path = _store(file)
                held = []
                with fs.open_input_file(path) as f:
                    for line in _lines_between(f, beg, stop):
                        at = _extent(line)
                        if at and any(at[1] < s and at[2] > a for a, s in by_contig.get(at[0], ())):
                            held.append(line.decode())
                        if len(held) == 10_000:
                            yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.string()), "file": pa.array([file] * len(held), pa.string())})
                            held = []
                yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.string()), "file": pa.array([file] * len(held), pa.string())})

    indexes = spark.read.format("binaryFile").load([f + ".tbi" for f in own]).select("path", "content")
    places = indexes.mapInArrow(plan, "file string, beg long, stop long")
    return places.repartition("file", "beg").mapInArrow(read, "value string, file string")
