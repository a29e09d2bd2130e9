"""Keyed tables: hashed by key into buckets, so that lookups and zips by that key join without a shuffle."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _name(path: str) -> str:
    return "keyed_" + hashlib.sha256(path.encode()).hexdigest()[:32]


def write_keyed(df: DataFrame, path: str, key: list[str], buckets: int) -> DataFrame:
    """df as a table of so many buckets by key, each sorted by it, at path (replacing what is there); read again.

    One shuffle, by bucket, so each bucket is one file. Tables that are joined with each other should have the same key and
    number of buckets; of others Spark shuffles the one that doesn't fit. Beside the table stands path.keyed, which says what
    read_keyed() has to know."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    dealt = df.repartition(buckets, *key)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(_name(path))
    what = json.dumps({"key": key, "buckets": buckets, "ddl": df.schema.json()})
    spark.createDataFrame([(what,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.keyed")
    return read_keyed(spark, path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """A table that write_keyed() wrote, also in another session: the catalog gets to know its buckets again."""
    if not spark.catalog.tableExists(_name(path)):
        what = json.loads(spark.read.text(f"{path}.keyed").first()[0])
        from pyspark.sql.types import StructType

        fields = StructType.fromJson(json.loads(what["ddl"])).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        by = ", ".join(f"`{k}`" for k in what["key"])
        spark.sql(f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {what['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(_name(path))


def zip_keyed(left: DataFrame, right: DataFrame, key: list[str], name: str) -> DataFrame:
    """Rows of both tables by key: left's columns and a struct `name` of right's; a key of one side has NULL for the other.
    A key that stands on several rows of both sides is an error of the data: it gives a row for each pair of them."""
    side = right.select(*[F.col(k).alias(f"_r_{k}") for k in key], F.struct(*[c for c in right.columns if c not in key]).alias(name))
    joined = left.join(side, [left[k] == side[f"_r_{k}"] for k in key], "full")
    return joined.select(*[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in key], *[c for c in left.columns if c not in key], name)
