"""Position indexes of block gzip files and reads of regions."""

import gzip
import random

import pytest

from varloom.operators.matrix import MatrixFrame
from varloom.sinks import text
from varloom.sources import blockgzip, readers, regions
from varloom.sources.files import list_files


def sites(shuffled=False):
    rng, out = random.Random(8), []
    for contig in ("chr1", "chr2", "chrX"):
        at = 0
        for i in range(1_500):
            at += rng.choice([1, 40, 900, 9_000])
            ref, info = "A" * rng.choice([1, 1, 1, 30]), rng.choice([".", ".", f"DP=3;END={at + rng.choice([0, 50, 40_000])}"])
            out.append((contig, at, ref, info, "\t".join([contig, str(at), ".", ref, "C", ".", ".", info, "".join(rng.choices("0123456789", k=100_000 if i % 700 == 3 else rng.choice([3, 300])))])))
    if shuffled:
        rng.shuffle(out)
    return out


def overlapping(rows, intervals):
    def extent(at, ref, info):
        return at, int(info.split("END=")[1]) if "END=" in info else at + len(ref) - 1

    return sorted(line for c, at, ref, info, line in rows if any(c == k and extent(at, ref, info)[0] <= b and extent(at, ref, info)[1] >= a for k, a, b in intervals))


def written(spark, path, rows):
    df = spark.createDataFrame([(i, r[-1]) for i, r in enumerate(rows)], "i int, value string").repartitionByRange(2, "i").sortWithinPartitions("i")
    return [f"{path}/{n}" for n in blockgzip.write_lines(df, path, head=["##a", "#CHROM\tPOS"])]


WANTED = [
    [("chr1", 1, 5)], [("chr1", 1_000_000, 1_000_000)], [("chr2", 30_000, 90_000), ("chr2", 60_000, 61_000), ("chrX", 1, 200_000)], [("chr1", 1, 1 << 29), ("chr2", 1, 1 << 29), ("chrX", 1, 1 << 29)],
    [("chr9", 1, 1_000)], [("chr2", 500_000_000, 510_000_000)], [("chr2", 7, 6)], [],
]


@pytest.mark.parametrize("shuffled", [False, True])
def test_regions_by_brute_force(spark, tmp_path, shuffled):
    rows = sites(shuffled)
    files = written(spark, f"file://{tmp_path}/v", rows)
    old, indexes = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    try:
        for size in ("9k", "50k", "10m"):  # an index doesn't depend on how its file was split
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            made = regions.write_index(spark, f"file://{tmp_path}/v")
            indexes.append([gzip.decompress(open(x[5:], "rb").read()) for x in made])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(indexes[0]) == 2 and indexes[0] == indexes[1] == indexes[2]
    for intervals in WANTED:
        assert sorted(r.value for r in regions.region_lines(spark, files, intervals).collect()) == overlapping(rows, intervals)


def test_pieces_hold_each_line_once(spark, tmp_path):
    rows = sites()
    files = written(spark, f"file://{tmp_path}/v", rows)
    for name in regions.write_index(spark, files):
        path = name[5:]
        index = regions.parse_index(gzip.decompress(open(path, "rb").read()))
        every = [(c, 1, 1 << 29) for c in index]
        places = regions.chunks_of(index, every, piece=10_000)
        assert len(places) > 3 and all(a[1] <= b[0] for a, b in zip(places, places[1:]))
        with open(path[:-4], "rb") as f:
            lines = [x.decode() for beg, stop in places for x in regions._lines_between(f, beg, stop)]
        assert lines == [x for x in gzip.open(path[:-4], "rt").read().split("\n")[:-1] if x[0] != "#"]


def test_only_the_blocks_of_a_region_are_read(spark, tmp_path):
    rows = sites()
    files = written(spark, f"file://{tmp_path}/v", rows)
    regions.write_index(spark, files)
    want = overlapping(rows, [("chr1", 100_000, 150_000)])
    assert want and files
    for name in list_files(spark, f"file://{tmp_path}/v"):
        if not name.endswith(".tbi"):
            data = bytearray(open(name[5:], "rb").read())
            index = regions.parse_index(gzip.decompress(open(name[5:] + ".tbi", "rb").read()))
            places = regions.chunks_of(index, [("chr1", 100_000, 150_000)])
            kept = bytearray(len(data))
            for beg, stop in places:  # from the first block to the end of the last
                last = (stop >> 16) + int.from_bytes(data[(stop >> 16) + 16 : (stop >> 16) + 18], "little") + 1
                kept[beg >> 16 : last] = data[beg >> 16 : last]
            assert sum(map(bool, kept)) < len(data) / 4
            open(name[5:], "wb").write(kept)  # all other blocks are lost
            crc = tmp_path / "v" / f".{name.rsplit('/', 1)[-1]}.crc"
            assert not crc.exists() or crc.unlink() is None
    assert sorted(r.value for r in regions.region_lines(spark, files, [("chr1", 100_000, 150_000)]).collect()) == want


def test_indexed_shards_of_sites_and_matrices(spark, tmp_path):
    cells = spark.createDataFrame([(c, p, ["A", "C"], s, (0, 1, False), 9, 8, [3, 5]) for c in ("chr1", "chr10", "chr2") for p in range(1, 400) for s in "ab"], "contig string, position int, alleles array<string>, s string, GT struct<a0:int,a1:int,phased:boolean>, GQ int, DP int, AD array<int>")
    m = MatrixFrame.from_long(cells, spark.createDataFrame([(0, "a"), (1, "b")], "col_idx int, s string"), ["contig", "position", "alleles"], ["GT", "GQ", "DP", "AD"])
    path = f"file://{tmp_path}/m"
    names = text.write_matrix(m, path, shards=3, compression="block", index=True)
    assert len(names) == 3 and names == sorted(names)
    whole = gzip.decompress(b"".join((tmp_path / "m" / n).read_bytes() for n in names)).decode().splitlines()
    assert [x.split("\t")[0] for x in whole if x[0] != "#"] == ["chr1"] * 399 + ["chr2"] * 399 + ["chr10"] * 399 and sum(x.startswith("#CHROM") for x in whole) == 1
    got = readers.read_variants(spark, [f"{path}/{n}" for n in names], genotypes=True, intervals=[("chr2", 100, 103)]).collect()
    assert sorted((r.contig, r.position, tuple(r.samples)) for r in got) == [("chr2", p, ("0/1:9:8:3,5",) * 2) for p in range(100, 104)]
    text.write_sites(m.rows.select("contig", "position", "alleles"), f"file://{tmp_path}/s", 2, compression="block", index=True)
    listed = [x for x, _ in readers.read_manifest(spark, f"file://{tmp_path}/s/shard-manifest.txt")]
    assert len(listed) == 2 and not any(x.endswith(".tbi") for x in listed)
    assert readers.read_variants(spark, f"file://{tmp_path}/s/parts", intervals=[("chr10", 399, 500)]).count() == 1
    assert readers.read_variants(spark, f"file://{tmp_path}/s/parts", block_gzip=True).count() == 3 * 399  # indexes aren't read as text
    with pytest.raises(ValueError, match="only block gzip"):
        text.write_sites(m.rows, f"file://{tmp_path}/t", 2, index=True)


def test_edges_of_indexes(spark, tmp_path):
    path = f"file://{tmp_path}/e"
    blockgzip.write_lines(spark.createDataFrame([], "value string").coalesce(1), path, head=["#CHROM"], head_once=True)
    assert regions.write_index(spark, path) == []
    (tmp_path / "f.gz").write_bytes(blockgzip.deflate(b"#h\nchr1\t5\t.\tA\tC\nchr1\t9\t.\tAA") + blockgzip.deflate(b"A\tC") + blockgzip.END)  # no line end at the end
    with pytest.raises(ValueError, match="no such file"):
        regions.region_lines(spark, [f"file://{tmp_path}/f.gz"], [("chr1", 11, 12)])
    assert regions.write_index(spark, f"file://{tmp_path}/f.gz") == [f"file:{tmp_path}/f.gz.tbi"]
    assert [r.value for r in regions.region_lines(spark, [f"file://{tmp_path}/f.gz"], [("chr1", 11, 12)]).collect()] == ["chr1\t9\t.\tAAA\tC"]
    (tmp_path / "g.gz").write_bytes(blockgzip.deflate(b"chr1\t0\t.\tA\tC\n") + blockgzip.END)
    with pytest.raises(Exception, match="outside of the index"):
        regions.write_index(spark, f"file://{tmp_path}/g.gz")


def test_bins():
    for beg, stop in ((0, 1), (0, 1 << 29), (16_383, 16_385), (131_071, 131_073), (5, 16_384)):
        assert regions.bin_of(beg, stop) in regions.bins_over(beg, stop) and regions.bin_of(beg, stop) in regions.bins_over(stop - 1, stop)
    assert regions.bin_of(0, 1) == 4681 and regions.bin_of(0, 1 << 29) == 0 and len(regions.bins_over(0, 1 << 29)) == 37449
