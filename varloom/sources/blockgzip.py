"""Block gzip: text files that many tasks read and write, cut at the boundaries of their compressed blocks.

Each block is a gzip member of up to 64 KB of text whose header is constant but for its size. Spark's text source takes that
header as the separator of records, so a record is a block's body, splits are planned like those of plain text, and any store
that Spark reads will do. Blocks don't end with lines: a task leaves the first and last piece of its split, and those pieces,
two a split, are put together by file.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.sources.files import list_files

# Fixed values of the format: the header before a block's size, the empty block that ends a file, text bytes of a block.
HEADER = bytes.fromhex("1f8b08040000000000ff060042430200")
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK_TEXT = 65_280
#: Bytes of blocks that the writer hands over as one row.
ROW_BYTES = 1_000_000
_LATIN = "ISO-8859-1"


def deflate(text: bytes, level: int = 6) -> bytes:
    """One block."""
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(text) + c.flush()
    return HEADER + struct.pack("<H", len(body) + len(END) - 3) + body + struct.pack("<II", zlib.crc32(text), len(text))


def inflate(record: bytes) -> bytes:
    """A block's text, from what follows the header."""
    size, (crc, n) = struct.unpack("<H", record[:2])[0], struct.unpack("<II", record[-8:])
    if size + 1 != len(record) + len(HEADER):
        raise ValueError("a block's size isn't what its header says")
    text = zlib.decompress(record[2:-8], -15)
    if len(text) != n or zlib.crc32(text) != crc:
        raise ValueError("a block's text doesn't have its length and checksum")
    return text


def _splits(batches):
    """(file, start of split, records in order) of what a task reads; records come lazily, and all must be taken."""
    rows = (r for b in batches for r in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), b.column("record")))
    row = next(rows, None)
    while row is not None:
        key, state = row[:2], [row]

        def records(key=key, state=state):
            while state[0] is not None and state[0][:2] == key:
                record = state[0][2].as_py()
                state[0] = next(rows, None)
                yield record

        yield *key, records()
        row = state[0]


def _texts(file: str, start: int, records):
    for k, r in enumerate(records):
        if r and k == 0 and start == 0:
            raise ValueError(f"not block gzip: {file}")
        if r:
            yield inflate(r)


_OUT = pa.schema([("value", pa.string()), ("file", pa.string())])
_ENDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("part", pa.int32()), ("ended", pa.bool_()), ("piece", pa.binary())])


def _lines(batches):
    """The lines that begin and end inside a split."""
    for file, start, records in _splits(batches):
        held = None  # text since the last line end; None before the first
        for text in _texts(file, start, records):
            cut = text.find(b"\n")
            if held is None:
                if cut < 0:
                    continue
                held, text = [], text[cut + 1 :]
            last = text.rfind(b"\n")
            if last < 0:
                held.append(text)
                continue
            whole = (b"".join(held) + text[:last]).split(b"\n")
            held = [text[last + 1 :]]
            yield pa.RecordBatch.from_arrays([pa.array(whole, pa.binary()).cast(pa.string()), pa.array([file] * len(whole), pa.string())], schema=_OUT)


def _ends(batches):
    """What stands before the first line end of a split (part 0, ended) and after the last (part 1); of one without any, all
    (part 0, not ended)."""
    for file, start, records in _splits(batches):
        first, held, ended = [], [], False
        for text in _texts(file, start, records):
            cut = text.rfind(b"\n")
            if not ended and cut >= 0:
                first.append(text[: text.find(b"\n")])
                ended = True
            elif not ended:
                first.append(text)
            if ended:
                held = [text[cut + 1 :]] if cut >= 0 else [*held, text]
        rows = [(file, start, 0, ended, b"".join(first))] + ([(file, start, 1, False, b"".join(held))] if ended else [])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENDS)], schema=_ENDS)


def block_records(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame | None, dict[str, str]]:
    """(record, file, start): the blocks of files, without their headers, and the starts of the splits they are read in; and the
    files' own names by those they are read under. None where there are no files. Position indexes beside files are left out."""
    named, view = {}, f"blocks-{uuid.uuid4().hex}"
    reader = spark.read.format("text").option("lineSep", HEADER.decode(_LATIN)).option("encoding", _LATIN)
    for path in [paths] if isinstance(paths, str) else paths:
        for file in list_files(spark, path):
            if file.endswith(".tbi"):
                continue
            if file.endswith(".gz"):
                link = f"/{len(named)}.blocks"
                reader = reader.option(f"fs.viewfs.mounttable.{view}.link.{link}", file)
                named[f"viewfs://{view}{link}"] = file
            else:
                named[file] = file
    if not named:
        return None, named
    return reader.load(list(named)).select(F.col("value").cast("binary").alias("record"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")), named


def own_names(df: DataFrame, named: dict[str, str]) -> DataFrame:
    """df with the files' own names in its column file."""
    links = [(k, v) for k, v in named.items() if k != v]
    if not links:
        return df
    names = df.sparkSession.createDataFrame(links, "file string, _own string")  # as long as the list of files that was given
    return df.join(F.broadcast(names), "file", "left").withColumn("file", F.coalesce("_own", "file")).select(df.columns)


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of block gzip files: value and file. Folders stand for the files in them.

    Tasks are planned by spark.sql.files.maxPartitionBytes, whatever the files' names: the codec that Spark would choose for
    .gz can't be cut, so such files are read under another name, through links of a view file system. Plain gzip, and a
    damaged block, are errors. The files are read twice, the second time for the pieces at the ends of splits."""
    records, named = block_records(spark, paths)
    if records is None:
        return spark.createDataFrame([], "value string, file string")
    whole = records.mapInArrow(_lines, "value string, file string")
    pieces = records.mapInArrow(_ends, "file string, start long, part int, ended boolean, piece binary")
    order = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
    line = F.expr("array_join(transform(array_sort(collect_list(struct(start, part, hex(piece)))), x -> x.col3), '')")
    mended = pieces.withColumn("line", F.sum("part").over(order)).groupBy("file", "line").agg(F.unhex(line).cast("string").alias("value"), F.max("ended").alias("ended"))
    mended = mended.filter("ended OR value <> ''")  # the text after a file's last line end is a line unless empty
    return own_names(whole.unionByName(mended.select("value", "file")), named)


def write_lines(lines: DataFrame, path: str, head: list[str] | None = None, head_once: bool = False) -> list[str]:
    """Write the column value of lines, in the order of its partitions and rows, as block gzip; returns the files' names.

    head: lines that each file begins with; once: only that of the first partition, so that the files laid end to end are one.
    An empty block follows each row of blocks, so that the last one ends the file; the format allows empty blocks anywhere. A
    partition without lines has no file."""

    def blocks(batches):
        here = head if head and (not head_once or TaskContext.get().partitionId() == 0) else []
        held, out = [x.encode("utf-8") + b"\n" for x in here], []
        size, begun = sum(map(len, held)), head_once and bool(here)
        for b in batches:
            begun = begun or len(b) > 0
            texts = [t.encode("utf-8") + b"\n" for t in b.column(0).to_pylist()]
            held += texts
            size += sum(map(len, texts))
            if size >= BLOCK_TEXT:
                text = b"".join(held)
                whole = len(text) - len(text) % BLOCK_TEXT
                for at in range(0, whole, BLOCK_TEXT):
                    out.append(deflate(text[at : at + BLOCK_TEXT]))
                    if sum(map(len, out)) >= ROW_BYTES:
                        yield pa.RecordBatch.from_pydict({"value": pa.array([b"".join(out)], pa.binary())})
                        out = []
                held, size = [text[whole:]], len(text) - whole
        if size and begun:
            out.append(deflate(b"".join(held)))
        if out:
            yield pa.RecordBatch.from_pydict({"value": pa.array([b"".join(out)], pa.binary())})

    made = lines.select("value").mapInArrow(blocks, "value binary").select(F.col("value").cast("string").alias("value"))
    made.write.mode("overwrite").option("lineSep", END.decode(_LATIN)).option("encoding", _LATIN).text(path)
    names = [f.rsplit("/", 1)[-1] for f in list_files(lines.sparkSession, path)]
    if head_once and head and not names:  # a table without rows may have no first partition
        return write_lines(lines.sparkSession.createDataFrame([(x,) for x in head], "value string").coalesce(1), path)
    return names
