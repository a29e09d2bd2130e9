import hashlib
import os
import time

import numpy as np
import public_tokenizers
import pytest

from tests.llm.helpers import corpus, table
from varloom.llm.token_shards import Feistel, encoding, materialise, read_slots, training_order, write_shards


def test_feistel_is_a_bijection():
    for n in (1, 2, 3, 17, 1000, 4097):
        f = Feistel(n, 7)
        slots = f.slots(np.arange(n))
        assert sorted(slots) == list(range(n)) and (f.numbers(slots) == np.arange(n)).all()
    assert (Feistel(1000, 1).slots(np.arange(1000)) != Feistel(1000, 2).slots(np.arange(1000))).any()


def test_records_hold_all_tokens_and_files_read_back(spark, tmp_path):
    rows = corpus()
    out = training_order(table(spark, rows), length=32, shard_rows=50).cache()
    enc, end = encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = sorted([*enc.encode_ordinary(t or ""), end] for _, t in rows)
    got = out.collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert all(r.shard == r.slot // 50 and len(r.record) == 64 for r in got)
    files = write_shards(out, str(tmp_path)).collect()
    again = write_shards(out, str(tmp_path)).collect()
    assert sorted(files) == sorted(again) and sum(f.rows for f in files) == len(got)
    by_slot = {r.slot: r for r in got}
    texts, current = {}, list(read_slots(str(tmp_path), 0, len(got), 32, 50))
    assert len(current) == len(got)
    for slot, ids in enumerate(current):
        r = by_slot[slot]
        assert ids.tobytes() == bytes(r.record) and (ids[r.n_tokens :] == end).all()
        texts.setdefault((r.doc_id, r.part), []).append(ids[: r.n_tokens].tolist())
    flat = sorted(x for v in texts.values() for p in v for x in p)
    assert flat == sorted(x for t in want for x in t)
    assert [x.tolist() for x in read_slots(str(tmp_path), 49, 3, 32, 50)] == [x.tolist() for x in current[49:52]]


def test_empty_table(spark):
    assert training_order(table(spark, [])).count() == 0


def test_shards_of_another_key_are_replaced(spark, tmp_path):
    rows = corpus()
    for key in (1, 2):
        out = training_order(table(spark, rows), length=32, shard_rows=50, key=key).cache()
        files = write_shards(out, str(tmp_path)).collect()
        assert all(hashlib.sha256(open(f.path, "rb").read()).hexdigest() == f.sha256 for f in files)
        want = [bytes(r.record) for r in out.orderBy("slot").collect()]
        assert [x.tobytes() for x in read_slots(str(tmp_path), 0, len(want), 32, 50)] == want


def test_every_slot_by_brute_force_however_the_table_is_dealt(spark):
    rows = corpus()
    enc, end = encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    numbered = []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0], hashlib.blake2b((r[1] or "").encode(), digest_size=16).digest())):
        ids = [*enc.encode_ordinary(t or ""), end]
        for part in range(-(-len(ids) // 32)):
            held = ids[32 * part : 32 * part + 32]
            numbered.append((i, part, len(held), np.array(held + [end] * (32 - len(held)), "<u2").tobytes()))
    slots = Feistel(len(numbered), 5).slots(np.arange(len(numbered))).tolist()
    want = sorted((slot, slot // 50, *x) for slot, x in zip(slots, numbered))
    for dealt in (table(spark, rows).coalesce(1), table(spark, rows[::-1]).repartition(7)):
        out = training_order(dealt, length=32, shard_rows=50, key=5)
        assert sorted((r.slot, r.shard, r.doc_id, r.part, r.n_tokens, bytes(r.record)) for r in out.collect()) == want


def test_materialise_writes_and_reads_back_what_training_order_has(spark, tmp_path):
    rows = corpus()
    want = sorted((r.slot, r.shard, r.doc_id, r.part, r.n_tokens, bytes(r.record)) for r in training_order(table(spark, rows), length=32, shard_rows=50).collect())
    for folder in (str(tmp_path / "a"), f"file://{tmp_path}/b", f"file:{tmp_path}/c"):
        out = materialise(table(spark, rows), folder, length=32, shard_rows=50)
        plain = "/" + folder.removeprefix("file:").lstrip("/")
        assert sorted(x for x in os.listdir(plain) if not x.startswith(".")) == [f"shard-{i:08d}.bin" for i in range(-(-len(want) // 50))]  # before any action on out
        got = out.collect()
        assert sorted((r.slot, r.shard, r.doc_id, r.part, r.n_tokens, bytes(r.record)) for r in got) == want
        assert all(r.place == r.slot % 50 * 64 for r in got)
    with open(f"{plain}/shard-00000000.bin", "r+b") as f:
        f.write(b"\xff" * 64)
    with pytest.raises(Exception, match="doesn't hold what was written"):
        out.collect()
    assert materialise(table(spark, []), str(tmp_path / "d")).count() == 0


def test_shards_are_written_range_after_range_and_shuffled_records_go_between(spark, tmp_path, monkeypatch):
    """When a range of shards is shuffled, those before it are written and neither their records nor the first shuffle's ids
    are on disk any more."""
    from varloom.llm import token_shards as T

    rows, seen, local = corpus() * 20, [], spark.conf.get("spark.local.dir", None) or os.environ.get("SPARK_LOCAL_DIRS") or "/tmp"
    blocks = lambda: {f for d, _, files in os.walk(local) if "blockmgr" in d for f in files if f.startswith("shuffle_") and f.endswith(".data") and os.stat(f"{d}/{f}").st_mtime >= began}

    def watched(df, label, *by):
        seen.append((label, len(blocks()), sum(x.endswith(".bin") for x in os.listdir(tmp_path / "a"))))
        return T_durable(df, label, *by)

    T_durable, began = T.durable, time.time()
    os.makedirs(tmp_path / "a")
    monkeypatch.setattr(T, "durable", watched)
    out = materialise(table(spark, rows), str(tmp_path / "a"), length=32, shard_rows=50)
    waves = [x for x in seen if x[0] == "sequences"]
    assert len(waves) == T.WAVES and [n for _, n, _ in waves] == [0] * T.WAVES and not blocks()
    shards = len([x for x in os.listdir(tmp_path / "a") if x.endswith(".bin")])
    assert [n for *_, n in waves] == [shards * k // T.WAVES for k in range(T.WAVES)]
    monkeypatch.setattr(T, "durable", T_durable)
    plain = training_order(table(spark, rows), length=32, shard_rows=50)
    want = sorted((r.slot, r.shard, r.doc_id, r.part, bytes(r.record)) for r in plain.collect())
    assert blocks()  # those of other queries stay until the driver collects its garbage
    assert sorted((r.slot, r.shard, r.doc_id, r.part, bytes(r.record)) for r in out.collect()) == want
