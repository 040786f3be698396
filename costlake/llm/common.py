"""Helpers shared by the training-data operators: folds, written tables, grouped batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import costlake
from costlake.session import run_folder
from costlake.sources.sinks import materialise

WORD_BREAK = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(costlake.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="costlake-code-"), "costlake.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("costlake", os.path.relpath(full, root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    return materialise(df, run_folder(df.sparkSession, purpose))


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until the frame has no such column (Spark tells no case apart)."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def positions(df: DataFrame, order: list[Column], name: str, purpose: str) -> DataFrame:
    """``df`` with a column ``name``: the row's place, from 0, in ``order``. No task sees all rows: they are
    dealt by ranges of the order and written, and each range begins after the rows of those before it.
    One count per range comes to the driver."""
    part, place = unused(df, "part"), unused(df, "place")
    ordered = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(place, F.monotonically_increasing_id() - F.shiftleft(F.col(part).cast("long"), 33)),
        purpose,
    )
    starts, before = [], 0
    for row in sorted(ordered.groupBy(part).count().collect()):
        starts.append((row[part], before))
        before += row["count"]
    first = unused(ordered, "first")
    offsets = df.sparkSession.createDataFrame(starts, f"{part} int, {first} long")
    return (
        ordered.join(F.broadcast(offsets), part)
        .withColumn(name, F.col(first) + F.col(place))
        .select(*df.columns, name)
    )


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)) % folds


def words(text: Column) -> Column:
    """Words between ASCII white space; a null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def bounded_rows(df: DataFrame, key: Column, most: int, seed: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of ``key``: the same rows in every run."""
    total = df.count()
    if total <= most:
        return df
    grain = 1 << 30
    share = int(grain * (most / total))
    return df.filter(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(grain)) < share)


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: list[str]
) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Runs of equal ``key`` in sorted batches: tables with the (start, end) of each whole group.

    At most one incomplete group is held back, so memory is bounded by a batch and the largest group.
    """
    import numpy as np

    held: list[pa.RecordBatch] = []

    def cut(last: bool) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
        nonlocal held
        rows = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(rows.num_rows - 1, dtype=bool)
        for name in key:
            values = rows.column(name).to_numpy()
            change |= values[1:] != values[:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist()]
        if last:
            bounds.append(rows.num_rows)
        held = [] if last else rows.slice(bounds[-1]).to_batches()
        if len(bounds) > 1:
            yield rows, list(zip(bounds, bounds[1:]))

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        first, end = held[0], batch.num_rows - 1
        if any(first.column(name)[0] != batch.column(name)[end] for name in key):
            yield from cut(False)
    if held:
        yield from cut(True)


def in_slices(rows: DataFrame, key: list[str], item: str, most: int, least: int = 1) -> DataFrame:
    """Split groups of over ``most`` rows so that every pair of a group still meets once.

    A group of S slices becomes the tasks (i, j), i <= j < S. A row of slice s goes to the S tasks
    that contain s; task (i, i) compares all its rows, task (i, j) only rows of i with rows of j.
    Adds ``slice``, ``slice_i``, ``slice_j``. Groups of fewer than ``least`` rows are left out.
    """
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__size"))
    big = sizes.filter(F.col("__size") > (most if least < 2 else least - 1)).withColumn(
        "slices", F.ceil(F.col("__size") / most).cast("int")
    )
    sliced = (
        rows.join(big.select(*key, "slices"), key, "left" if least < 2 else "inner")
        .withColumn("slices", F.coalesce("slices", F.lit(1)))
        .withColumn("slice", F.pmod(F.xxhash64(item, F.lit(7)), "slices").cast("int"))
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .withColumn("slice_i", F.least("slice", "__other"))
        .withColumn("slice_j", F.greatest("slice", "__other"))
    )
    return sliced.drop("__other", "slices")
