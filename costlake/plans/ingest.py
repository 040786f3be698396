"""Landing to bronze: technical columns, required keys, dedupe, run statistics."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.functions.rules import all_present, landed_event_rule
from costlake.functions.values import parse_double, parse_timestamp
from costlake.operators.dedupe import dedupe_rows, total_order
from costlake.operators.lookups import keep_directories
from costlake.operators.splits import require_keys, split
from costlake.sources.keyed import load_keyed
from costlake.sources.readers import read_landing
from costlake.sources.schemas import LANDING_TABLES, TableSpec
from costlake.sources.sinks import write_partitions

# Day columns that exist when their source timestamp does.
DAY_OF = {"created_date": "created_at", "touch_date": "timestamp"}


def check_batch_date(text: str) -> str:
    try:
        date.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"batch date {text!r} is not YYYY-MM-DD") from error
    return text


def select_tables(names: str | None = None) -> list[TableSpec]:
    """Table specs from a comma-separated list of names; all tables without one."""
    if names is None:
        return list(LANDING_TABLES.values())
    wanted = [name.strip() for name in names.split(",") if name.strip()]
    unknown = sorted(set(wanted) - LANDING_TABLES.keys())
    if unknown:
        raise ValueError(f"unknown tables: {', '.join(unknown)}")
    return [LANDING_TABLES[name] for name in wanted]


def with_technical_columns(rows: DataFrame, batch_date: str) -> DataFrame:
    """Adds load time and dates; ``source_file`` comes with the scan."""
    batch_day = F.lit(check_batch_date(batch_date)).cast("date")
    days = {day: F.to_date(ts) for day, ts in DAY_OF.items() if ts in rows.columns}
    return rows.withColumns(
        {
            "ingest_ts": F.current_timestamp(),
            "batch_date": batch_day,
            "load_date": batch_day,
            **days,
        }
    )


def to_bronze(landed: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with all required columns, one per natural key. Which copy stays depends on the rows alone,
    not on file order: a rerun must not move a key to another partition and leave the old one behind."""
    complete = require_keys(landed, list(spec.required))
    order = total_order(complete, [*spec.schema.fieldNames(), "source_file"])
    return dedupe_rows(complete, list(spec.keys), order)


def ingest_stats(landed: DataFrame, spec: TableSpec) -> DataFrame:
    """Row counts at each step, in one aggregate over the landed rows.

    Counting distinct keys gives the rows left after dedupe, which are the rows written. Counters
    inside the write job would count a task twice when it is rerun after an executor loss.
    """
    complete = all_present(list(spec.required))
    kept = F.count_distinct(F.when(complete, F.struct(*spec.keys)))
    return landed.agg(
        F.lit(spec.name).alias("table_name"),
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(complete).alias("records_after_quality"),
        kept.alias("records_after_dedupe"),
    ).withColumn("records_written", F.col("records_after_dedupe"))


def with_totals(stats: list[DataFrame]) -> DataFrame:
    """Stats of several tables, with one more row that sums them."""
    tables = reduce(DataFrame.unionByName, stats)
    counts = [name for name in tables.columns if name != "table_name"]
    with_total = tables.rollup("table_name").agg(*[F.sum(name).alias(name) for name in counts])
    return with_total.fillna("total", ["table_name"])


def ingest(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    batch_date: str,
    tables: str | None = None,
) -> DataFrame:
    """Load the selected landing tables into bronze; returns the run statistics.

    Statistics are taken table by table, right after the load, and don't change with landing files that come
    later. ``records_written`` is counted in the written partitions, so a load that fails reports none.
    """
    stats = []
    for spec in select_tables(tables):
        landed = with_technical_columns(read_landing(spark, spec, landing_root), batch_date)
        path = f"{bronze_root}/batch/{spec.name}"
        rows = to_bronze(landed, spec)
        if spec.may_move:
            load_keyed(rows, path, list(spec.keys), spec.partition_by)
        else:
            write_partitions(rows, path, [spec.partition_by])
        stats.append(written_stats(landed, rows.schema, spec, path))
    return with_totals(stats)


def written_stats(landed: DataFrame, schema: T.StructType, spec: TableSpec, path: str) -> DataFrame:
    """``ingest_stats`` with the rows found in the partitions that the load replaced, one row of values."""
    spark = landed.sparkSession
    counts = ingest_stats(landed, spec)
    complete = landed.filter(all_present(list(spec.required)))
    replaced = keep_directories(spark.read.schema(schema).parquet(path), complete, [spec.partition_by])
    row = counts.first().asDict() | {"records_written": replaced.count()}
    return spark.createDataFrame([tuple(row[name] for name in counts.columns)], counts.schema)


def with_event_columns(landed: DataFrame) -> DataFrame:
    """Parsed time and value of landed events, and whether the value is no number."""
    return (
        landed.withColumns(
            {
                "ingest_ts": F.current_timestamp(),
                "event_ts": parse_timestamp("timestamp"),
                "value_num": parse_double("value"),
            }
        )
        .withColumns(
            {
                "event_date": F.to_date("event_ts"),
                "batch_date": F.to_date("ingest_ts"),
                "is_value_cast_error": F.col("value").isNotNull() & F.col("value_num").isNull(),
            }
        )
    )


def split_landed_events(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) events; takes the frame with event columns."""
    return split(landed, landed_event_rule())
