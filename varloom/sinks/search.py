"""Search-index documents: flat rows, field names, mappings, bulk files."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.sources.readers import checkpoint, exists

# How a field name's special characters are written.
SPECIAL = {".": "_$dot$_", ",": "_$comma$_", "#": "_$hash$_", "*": "_$star$_", "(": "_$lp$_", ")": "_$rp$_", "[": "_$lsb$_", "]": "_$rsb$_", "{": "_$lcb$_", "}": "_$rcb$_"}
BAD_FIRST = ("_", "-", "+")
_LEAF = {T.IntegerType: "integer", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.StringType: "keyword", T.BooleanType: "boolean"}
SETTINGS = {"number_of_replicas": 0, "refresh_interval": -1, "index.mapping.total_fields.limit": 10_000, "codec": "best_compression"}


def encode_name(name: str) -> str:
    """A name the index accepts: $ is doubled, special characters are spelt, a bad first character gets a $ before it."""
    out = "".join(SPECIAL.get(c, c) for c in name.replace("$", "$$"))
    return "$" + out if out.startswith(BAD_FIRST) else out


def flatten(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Structs become columns with dotted names."""
    out = []

    def walk(path: list[str], t: T.DataType) -> None:
        if isinstance(t, T.StructType):
            for f in t.fields:
                walk([*path, f.name], f.dataType)
        else:
            out.append(F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)))

    for f in df.schema.fields:
        if f.name not in drop:
            walk([f.name], f.dataType)
    return df.select(*out)


def index_rows(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Flat rows under names that the index accepts."""
    flat = flatten(df, drop)
    return flat.toDF(*[encode_name(c.replace(".", "_")) for c in flat.columns])


def mapping(t: T.DataType) -> dict:
    """The index mapping of a type; arrays are mapped as their element, of structs as nested objects."""
    if isinstance(t, T.StructType):
        return {"properties": {f.name: mapping(f.dataType) for f in t.fields}}
    if isinstance(t, T.ArrayType):
        inner = mapping(t.elementType)
        return {"type": "nested"} | inner if isinstance(t.elementType, T.StructType) else inner
    if type(t) in _LEAF:
        return {"type": _LEAF[type(t)]}
    raise NotImplementedError(f"the index has no type for {t.simpleString()}")


def index_body(df: DataFrame, shards: int, meta: dict | None = None) -> dict:
    """Settings and mapping of a new index; meta: the table's globals."""
    body = mapping(df.schema)
    return {"mappings": body | ({"_meta": meta} if meta else {}), "settings": {"index": SETTINGS | {"number_of_shards": shards}}}


def write_bulk(df: DataFrame, path: str, index: str, id_col: str | None = None) -> None:
    """Bulk files: an action line before each document; NULL fields are written."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), *([F.col(id_col).cast("string").alias("_id")] if id_col else [])).alias("index")))
    doc = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    df.select(F.concat(action, F.lit("\n"), doc).alias("value")).write.mode("overwrite").text(path)


# Below so many shards the export waits until none stands on the nodes that only load.
FEW_SHARDS, LOADING_NODES = 25, "elasticsearch-es-data-loading*"


def _again(call, retries: int | None, wait: float, longest: float = 300.0):
    """call(), tried again after pauses that double; retries: how often, None without end."""
    tried = 0
    while True:
        try:
            return call()
        except Exception:
            if tried == retries:
                raise
            time.sleep(min(longest, wait * 2**tried))
            tried += 1


def wait_for_shards(client, index: str, attempts: int = 1000, wait: float = 5.0) -> None:
    """Return once no shard of the index stands on a loading node."""
    for _ in range(attempts):
        if LOADING_NODES not in client.shards(index):
            return
        time.sleep(wait)
    raise TimeoutError(f"shards of {index} didn't leave the loading nodes")


def export(df: DataFrame, client, index: str, shards: int, staging: str, batch: int = 5_000, meta: dict | None = None, done: str | None = None, retries: int | None = None, wait: float = 30.0) -> None:
    """Load a live index; each document lands once, however often tasks or the whole export are run again.

    Documents are first written to `staging` with ids of their own, so that a task that runs again, on another executor too,
    sends the same ids. An export that was stopped goes on with its index and the staged documents; one that begins drops an
    index of this name. Bulk requests are tried again with growing pauses, without end unless retries says how often. Then
    segments are merged, a small index waits for its shards, and the flag `done` is written (a folder with one file). An
    export whose flag is there does nothing.

    client: exists(name), delete(name), create(name, body), bulk(name, list of (id, document)), merge(name), shards(name); it
    is pickled. Timeouts of requests are its own. The table's folder may be deleted after the export."""
    spark = df.sparkSession
    if done and exists(spark, done):
        return
    if not (exists(spark, staging) and client.exists(index)):
        value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        checkpoint(df.select(F.monotonically_increasing_id().alias("id"), value.alias("value")), staging)
        if client.exists(index):
            client.delete(index)
        client.create(index, index_body(df, shards, meta))

    def send(rows):
        held = []
        for r in rows:
            held.append((str(r["id"]), json.loads(r["value"])))
            if len(held) == batch:
                _again(lambda: client.bulk(index, held), retries, wait)
                held = []
        if held:
            _again(lambda: client.bulk(index, held), retries, wait)

    spark.read.parquet(staging).foreachPartition(send)
    client.merge(index)
    if shards < FEW_SHARDS:
        wait_for_shards(client, index)
    if done:
        spark.createDataFrame([("done",)], "value string").coalesce(1).write.mode("overwrite").text(done)
