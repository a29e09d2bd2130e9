"""A variant-by-sample matrix: one row per variant with its sample entries, a column table, and globals.

A matrix made from cells holds of each row the cells that are there (CELLS), so what it takes follows the cells and not
variants times samples; `entries`, with an element for each column, is made of them where a plan names it. Cells and entries
lie beside the variant's fields, so per-variant work needs no shuffle, and Spark reads only the entry fields that a plan
names. long() gives one row per cell for work that shuffles by something else."""

from __future__ import annotations

import json
import math
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.functions.calls import is_non_ref

#: Column of the cells that are there, in order of columns: {pos: place of the column, s, e: the entry}.
CELLS = "_cells"
#: Columns up to which the column axis is sent to all tasks.
BROADCAST_COLS = 1_000_000


class MatrixFrame:
    """rows: key and row fields and `entries` in the order of cols; cols: col_idx and s; globals: plain values.

    It is made of rows with entries or with CELLS; tests and fields of rows may name either, where cells are held."""

    def __init__(self, rows: DataFrame, cols: DataFrame, globals: dict | None = None):
        self.held, self.cols, self.globals = rows, cols, globals or {}

    @classmethod
    def from_long(cls, cells: DataFrame, cols: DataFrame, keys: list[str], entry: list[str], first: str | None = None) -> MatrixFrame:
        """From one row per (keys, s): each row's cells sorted by col_idx, a NULL entry where a cell is absent; of a repeated
        cell the one with the least of the field `first`, then the least entry stays."""
        m = cls(cells, cols)
        cell = F.struct("pos", *([first] if first else []), "s", F.struct(*entry).alias("e"))
        held = cells.join(m._axis("s"), "s").groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("_all"))
        one = F.filter("_all", lambda x, i: (i == 0) | (x["pos"] > F.get("_all", i - 1)["pos"]))
        m.held = held.select(*keys, (F.transform(one, lambda x: x.dropFields(first)) if first else one).alias(CELLS))
        return m

    @cached_property
    def n_cols(self) -> int:
        return self.cols.count()

    def _axis(self, *fields: str) -> DataFrame:
        """pos and these fields of the columns, sent to all tasks unless they are very many."""
        place = self.cols.select(*fields, (F.row_number().over(Window.orderBy("col_idx")) - 1).alias("pos"))  # the column axis
        return F.broadcast(place) if self.n_cols <= BROADCAST_COLS else place

    def _like(self, rows: DataFrame) -> MatrixFrame:
        m = MatrixFrame(rows, self.cols, self.globals)
        if "n_cols" in self.__dict__:
            m.n_cols = self.n_cols
        return m

    def gaps(self, one, absent) -> tuple[Column, Column]:
        """For each held cell one(cell, number of absent columns between it and the cell before), and absent(number of columns
        after the last)."""
        place = lambda i: F.when(i > 0, F.get(CELLS, i - 1)["pos"]).otherwise(-1)
        last = F.coalesce(F.get(CELLS, F.size(CELLS) - 1)["pos"], F.lit(-1))
        return F.transform(CELLS, lambda x, i: one(x, x["pos"] - place(i) - 1)), absent(F.lit(self.n_cols) - 1 - last)

    @property
    def _entries(self) -> Column:
        kind = self.held.schema[CELLS].dataType.elementType["e"].dataType
        absent = lambda k: F.array_repeat(F.lit(None).cast(kind), k)
        each, rest = self.gaps(lambda x, k: F.concat(absent(k), F.array(x["e"])), absent)
        return F.concat(F.flatten(each), rest).alias("entries")

    @property
    def _both(self) -> DataFrame:
        return self.held.select("*", self._entries) if CELLS in self.held.columns else self.held

    @property
    def rows(self) -> DataFrame:
        return self.held.select(*[self._entries if c == CELLS else c for c in self.held.columns])

    def cells(self) -> MatrixFrame:
        """The same matrix by its cells: rows with CELLS, whatever it was made of."""
        if CELLS in self.held.columns:
            return self
        ids = F.split(F.lit("\n".join(self.sample_ids())), "\n")
        each = F.filter(F.transform("entries", lambda e, i: F.struct(i.alias("pos"), F.get(ids, i).alias("s"), e.alias("e"))), lambda c: c["e"].isNotNull())
        return self._like(self.held.withColumn(CELLS, each).drop("entries"))

    def long(self, absent: bool = False) -> DataFrame:
        """One row per cell: the row fields, col_idx, s and the entry's fields; absent cells are left out, or, where asked for,
        have NULL fields and are made in place: nothing that follows their number is shuffled or held."""
        keep = [c for c in self.held.columns if c not in ("entries", CELLS)]
        if absent:
            cells = self.rows.select(*keep, F.posexplode("entries").alias("pos", "_e"))
            return cells.join(self._axis("s", "col_idx"), "pos").select(*keep, "col_idx", "s", "_e.*")
        if CELLS in self.held.columns:
            cells = self.held.select(*keep, F.explode(CELLS).alias("_c")).select(*keep, "_c.pos", "_c.s", F.col("_c.e").alias("_e"))
            return cells.join(self._axis("col_idx"), "pos").select(*keep, "col_idx", "s", "_e.*")
        cells = self.held.select(*keep, F.posexplode("entries").alias("pos", "_e")).filter(F.col("_e").isNotNull())
        return cells.join(self._axis("s", "col_idx"), "pos").select(*keep, "col_idx", "s", "_e.*")

    def sample_ids(self) -> list[str]:
        return [r[0] for r in self.cols.orderBy("col_idx").select("s").collect()]

    def filter_rows(self, test: Column | str) -> MatrixFrame:
        return self._like(self._both.filter(test).select(*self.held.columns))

    def annotate_rows(self, **fields: Column) -> MatrixFrame:
        rows = self._both.withColumns(fields)
        return self._like(rows.drop(CELLS if "entries" in fields else "entries" if CELLS in self.held.columns else CELLS))

    def annotate_cols(self, **fields: Column) -> MatrixFrame:
        return MatrixFrame(self.held, self.cols.withColumns(fields), self.globals)

    def annotate_globals(self, **values) -> MatrixFrame:
        m = self._like(self.held)
        m.globals = self.globals | values
        return m

    def drop(self, *names: str) -> MatrixFrame:
        return self._like(self.held.drop(*names, *([CELLS] if "entries" in names else [])))

    def subset_samples(self, ids: list[str], drop_reference_rows: bool = True) -> MatrixFrame:
        """Only these samples, all of which must be there; then only rows where one of them isn't reference."""
        have = self.sample_ids()
        if missing := sorted(set(ids) - set(have)):
            raise ValueError(f"{len(missing)} sample ids aren't in the matrix: {missing[:10]}")
        wanted, kept = set(ids), 0
        to = []  # the new place of each column
        for s in have:
            to.append(kept if s in wanted else -1)
            kept += s in wanted
        place = F.split(F.lit(",".join(map(str, to))), ",").cast("array<int>")  # becomes one literal, which a list of literals doesn't in time
        chosen = F.filter(CELLS, lambda c: F.get(place, c["pos"]) >= 0)
        rows = self.cells().held.withColumn(CELLS, F.transform(chosen, lambda c: F.struct(F.get(place, c["pos"]).alias("pos"), c["s"].alias("s"), c["e"].alias("e"))))
        if drop_reference_rows:
            rows = rows.filter(F.exists(F.col(CELLS)["e"]["GT"], is_non_ref))
        spark = self.cols.sparkSession
        return MatrixFrame(rows, self.cols.join(F.broadcast(spark.createDataFrame([(s,) for s in sorted(wanted)], "s string")), "s", "left_semi"), self.globals)

    def write(self, path: str, mode: str = "overwrite") -> None:
        self.held.write.mode(mode).parquet(f"{path}/rows")
        self.cols.write.mode(mode).parquet(f"{path}/cols")
        spark = self.held.sparkSession
        spark.createDataFrame([(json.dumps(self.globals),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/globals")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> MatrixFrame:
        text = spark.read.text(f"{path}/globals").first()
        return cls(spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/cols"), json.loads(text[0]) if text else {})

    def shard_count(self, cells_per_shard: float = 5e8) -> int:
        return math.ceil(self.held.count() * self.n_cols / cells_per_shard)


def read_any(spark: SparkSession, path: str):
    """A matrix (.mt) or a table (.ht), by the path's ending."""
    end = path.rstrip("/").rsplit(".", 1)[-1]
    if end == "mt":
        return MatrixFrame.read(spark, path)
    if end == "ht":
        return spark.read.parquet(path)
    raise ValueError(f"neither .mt nor .ht: {path}")
