"""Operator 9, byte-level BPE: overlapping chunks are pre-tokenised, stitched, and their pieces encoded.

Every text is cut into chunks that overlap, which are pre-tokenised apart and stitched; a short text is one chunk. Two
scans of the pattern that share one cut agree from there on, since the pattern looks only ahead: the stitch follows
one chunk's cuts until the next chunk has the same cut inside the overlap. Where no cut is shared (a run of one class
longer than the overlap) the text is scanned on from the last sure cut until it meets the next chunk's cuts. The chunks
of a text of more than `spread` characters are dealt over all tasks; those of other texts stay in the text's task, so
that nothing is shuffled for them.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import key_rows, slices, table

#: Characters of a chunk and of what it shares with the next; of texts whose chunks are dealt over tasks, at least.
CHUNK, OVERLAP, SPREAD = 4_096, 256, 131_072
#: A cut this close to a chunk's end may differ from the whole text's: the pattern looks at most this far ahead of a match.
UNSURE = 4
#: Pieces whose ids a worker remembers; beyond it, it forgets them all.
REMEMBERED = 300_000


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


class Coder(dict):
    """Ids of pieces by a rank file, remembered as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self._core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self._core.encode_single_piece(piece.encode("utf-8"))).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode_pieces(self, pieces) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def cuts_of(pattern, text: str, at_end: bool) -> list[int]:
    """Ends of the pattern's matches; without those that more text could move, unless the text ends here."""
    ends = [m.end() for m in pattern.finditer(text)]
    if not at_end:
        while ends and ends[-1] > len(text) - UNSURE:
            ends.pop()
    return ends


def stitch(pattern, text: str, chunks: list[tuple[int, list[int]]]) -> list[int]:
    """The cuts of the whole text from (start, cuts inside) of its chunks, in order of start."""
    out = [start + c for start, cuts in chunks[:1] for c in cuts]
    for start, cuts in chunks[1:]:
        theirs = [start + c for c in cuts]
        known = set(theirs)
        # within the part that both have seen, the first cut that they share
        k = next((i for i in range(int(np.searchsorted(out, start, "right")), len(out)) if out[i] in known), None)
        if k is not None:
            out = out[: k + 1]
        else:
            at = out[-1] if out else 0
            for m in pattern.finditer(text, at):
                out.append(m.end())
                if m.end() in known:
                    break
        if out:
            out += theirs[int(np.searchsorted(theirs, out[-1], "right")) :]
    return out


def chunks_of(text: str, chunk: int, overlap: int):
    """(start, part, whether it is the last)."""
    for start in range(0, max(1, len(text) - overlap), chunk - overlap):
        yield start, text[start : start + chunk], start + chunk >= len(text)


def pieces_of(text: str, cuts: list[int]) -> list[str]:
    return [text[a:b] for a, b in zip([0, *cuts], cuts)]


def _digest(doc_ids: list, encoded: list[bytes], c: Coder, with_ids: bool) -> pa.RecordBatch:
    sha = [hashlib.sha256(x).hexdigest() for x in encoded]
    back = [hashlib.sha256(c.decode(x)).hexdigest() for x in encoded]
    cols = {"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array([len(x) // 4 for x in encoded], pa.int64()), "ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(back, pa.string())}
    if with_ids:
        cols["ids"] = pa.array(encoded, pa.binary())
    return pa.RecordBatch.from_pydict(cols)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD, with_ids: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids (binary, <u4).

    A null or empty text has no ids. Repeated rows give repeated results; ids of rows may be null. Rows that repeat an
    id with long texts are kept apart by a row key. An empty table gives an empty result; other columns of docs are not
    read. overlap must be less than chunk."""
    path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    rows = key_rows(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def at_once(batches):
        c = coder(path, pattern)
        for b in slices(batches):
            encoded = []
            for t in b.column("text").to_pylist():
                cuts = stitch(c.pattern, t, [(start, cuts_of(c.pattern, part, last)) for start, part, last in chunks_of(t, chunk, overlap)])
                encoded.append(c.encode_pieces(pieces_of(t, cuts)))
            yield _digest(b.column("doc_id").to_pylist(), encoded, c, with_ids)

    def cut_up(batches):
        for b in batches:
            for row, t in zip(b.column("row").to_pylist(), b.column("text").to_pylist()):
                got = list(chunks_of(t, chunk, overlap))
                for i in range(0, len(got), 1_000):
                    starts, parts, last = zip(*got[i : i + 1_000])
                    yield pa.RecordBatch.from_pydict({"row": pa.array([row] * len(starts), pa.string()), "start": pa.array(starts, pa.int32()), "part": pa.array(parts, pa.string()), "last": pa.array(last, pa.bool_())})

    def pre_tokenise(batches):
        c = coder(path, pattern)
        for b in slices(batches):
            cuts = [array("i", cuts_of(c.pattern, t, e)).tobytes() for t, e in zip(b.column("part").to_pylist(), b.column("last").to_pylist())]
            yield pa.RecordBatch.from_pydict({"row": b.column("row"), "start": b.column("start"), "cuts": pa.array(cuts, pa.binary())})

    def join_up(batches):
        c = coder(path, pattern)
        for b in slices(batches):
            encoded = []
            for text, parts in zip(b.column("text").to_pylist(), b.column("parts").to_pylist()):
                chunks = sorted((p["start"], array("i", p["cuts"]).tolist()) for p in parts)
                encoded.append(c.encode_pieces(pieces_of(text, stitch(c.pattern, text, chunks))))
            yield _digest(b.column("doc_id").to_pylist(), encoded, c, with_ids)

    size = F.length("text")
    short = rows.filter(size <= spread).mapInArrow(at_once, schema)
    key = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|"), F.col("text")), 256)  # no id reads as null
    long = rows.filter(size > spread).select("doc_id", "text", key.alias("row"))
    chunks = (
        long.dropDuplicates(["row"]).select("row", "text").mapInArrow(cut_up, "row string, start int, part string, last boolean")
        .repartition("row", "start").mapInArrow(pre_tokenise, "row string, start int, cuts binary")
        .groupBy("row").agg(F.collect_list(F.struct("start", "cuts")).alias("parts"))  # as many as one text has chunks
    )
    joined = long.join(chunks, "row").select("doc_id", "text", "parts").mapInArrow(join_up, schema)
    return short.unionByName(joined)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), with_ids=False)
