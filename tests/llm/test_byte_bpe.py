import base64
import hashlib
from array import array

import public_tokenizers
import pytest
import tiktoken

from tests.llm.helpers import corpus, ordered, rows_of, table
from varloom.llm.byte_bpe import encode


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap,spread", [(4_096, 256, 131_072), (300, 20, 100_000), (300, 20, 1_000), (64, 4, 64)])
def test_as_the_library_and_round_trip(spark, library, chunk, overlap, spread):
    rows = corpus()[:95:3] + [(None, None), (-1, ""), (-2, " " * 3000 + "x"), (-3, "a" * 2000 + "'re" * 300), (-4, "it's  \n\n x" * 200), (-4, "it's  \n\n x" * 200), (-5, "\x1c \x85   é漢字🙂" * 200), (-6, "'s" * 900), (-7, "1 " * 600)]
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = rows_of(encode(table(spark, rows), chunk=chunk, overlap=overlap, spread=spread), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == ordered(want)


def merge(ranks, piece):
    """The plain loop: the neighbours of least rank are joined, the first of them first, until no pair has a rank."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not known:
            return [ranks[p] for p in parts]
        i = min(known)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def regex_pieces():
    import regex

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return ranks, lambda t: regex.findall(public_tokenizers.PATTERN, t)


def test_as_plain_merges(spark):
    ranks, pieces = regex_pieces()
    rows = [(1, "The quick brown foxes' dens aren't here, 12345 times!"), (2, "naïve façade 漢字かな 🙂🙂  \n\n\t x"), (3, "antidisestablishmentarianism" * 3), (4, "\x00\x01 <|endoftext|> ")]
    want = []
    for i, t in rows:
        ids = [x for piece in pieces(t) for x in merge(ranks, piece.encode())]
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest()))
    assert rows_of(encode(table(spark, rows), chunk=16, overlap=6), "doc_id", "n_tokens", "ids_sha256") == want


def test_null_ids_beside_ids_that_look_alike(spark, library):
    t = "some words here " * 30
    rows = [(5, t), (None, "5|" + t), (None, t), (5, "null|" + t)]
    want = ordered([(i, len(library.encode_ordinary(x))) for i, x in rows])
    assert rows_of(encode(table(spark, rows), chunk=64, overlap=8, spread=64), "doc_id", "n_tokens") == want


def test_empty_table(spark):
    assert encode(table(spark, [])).count() == 0
