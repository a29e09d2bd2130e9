"""Running values over groups that may hold a third of all rows: windows over bounded chunks, and offsets of the chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import durable


def dealt(df: DataFrame, label: str, *order: Column) -> DataFrame:
    """df as a durable table in ranges of order, with the number of each row's range as _part: parts ascend with order, and
    equal rows share theirs."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return durable(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), label)


def running(df: DataFrame, by: list[str], chunk: str, order: list, sums: dict[str, str], xors: dict[str, str] | None = None) -> DataFrame:
    """df with a running sum for each of sums, and a running exclusive or for each of xors (name by column of longs), over the
    rows of its group up to itself.

    chunk: a column, never null, that cuts groups into pieces of bounded size and doesn't descend in order. Rows meet by group
    and chunk; of chunks only the totals meet by group. by: columns that are never null. df is read twice."""
    named = [(name, c, F.sum, Column.__add__) for name, c in sums.items()] + [(name, c, F.bit_xor, Column.bitwiseXOR) for name, c in (xors or {}).items()]
    inside = Window.partitionBy(*by, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*by, F.col(chunk).alias("_chunk")).agg(F.lit(1).alias("_one"), *(add(c).alias(f"_t_{name}") for name, c, add, _ in named))
    offsets = totals.select(*(F.col(b).alias(f"_b_{b}") for b in by), "_chunk", F.count("_one").over(before).alias("_nth"), *(add(f"_t_{name}").over(before).alias(f"_o_{name}") for name, _, add, _ in named))
    offsets = offsets.filter("_nth > 0")  # the first chunk, often the only one, has no offset
    here = df.select("*", *(add(c).over(inside).alias(f"_i_{name}") for name, c, add, _ in named))
    met = here.join(offsets, [here[b] == offsets[f"_b_{b}"] for b in by] + [here[chunk] == offsets["_chunk"]], "left")
    zero = F.lit(0).cast("long")
    return met.select(*(here[c] for c in df.columns), *(plus(F.col(f"_i_{name}"), F.coalesce(f"_o_{name}", zero)).alias(name) for name, _, _, plus in named))
