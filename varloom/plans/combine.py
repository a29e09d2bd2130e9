"""Building a cohort step by step: samples go, samples come, each step written and not done twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varloom.operators.joins import check_removals
from varloom.operators.sparse import SparseFrame
from varloom.plans.stages import combiner_action
from varloom.sources.readers import exists


def build_cohort(spark: SparkSession, path: str, temp: str, previous: str | None = None, new: list[SparseFrame] | None = None, gone: DataFrame | None = None, branch: int = 50, target_records: int | None = None, threshold: int = 20, confirmed: bool = False) -> SparseFrame:
    """The cohort at path, made of the previous one without the samples `gone` (column s) and with the new ones.

    Removal comes first. With nothing to add its result goes to path; else to temp, where it and the merges that are whole are
    found again by a run that follows one that was stopped. Many removals need to be confirmed; nothing to do is an error."""
    names = [r[0] for r in gone.select("s").distinct().limit(1_000_000).collect()] if gone is not None else []  # ids of a request
    action = combiner_action(previous is not None, new or [], names)
    check_removals(len(names), confirmed, threshold)
    base = [SparseFrame.read(spark, previous)] if previous else []
    if "remove" in action:
        target = path if action == "remove" else f"{temp}/removed"
        if not exists(spark, f"{target}/cols"):
            base[0].remove(spark.createDataFrame([(n,) for n in names], "s string")).write(target, ranges=True, target_records=target_records)
        base = [SparseFrame.read(spark, target)]
    if action != "remove":
        SparseFrame.merge_tree([*base, *new], f"{temp}/merged", branch, target_records).write(path, ranges=True, target_records=target_records)
    return SparseFrame.read(spark, path)
