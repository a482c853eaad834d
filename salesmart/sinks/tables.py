"""File sinks: staging, fact and marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.clean import money
from salesmart.functions.curve import interleaved, of_day, of_key
from salesmart.functions.keys import row_digest
from salesmart.operators.facts import fact_sales
from salesmart.operators.upsert import unseen_members
from salesmart.plans.quality import bad_row_reasons
from salesmart.schema import FLAT_COLUMNS, MART_SCHEMAS, MART_SORT_KEYS
from salesmart.session import DROP_SHUFFLES, with_settings
from salesmart.sinks.snapshots import Attempt, read_parts, snapshot
from salesmart.sources.csv import CORRUPT, csv_files, read_sales_csv


# Tables and the note of a staging folder.
ROWS, FILES, LOADS = "rows", "files", "loads"
# A task has a file open for each status, so that rows are not sorted by it before. Spark sorts
# what is left as soon as this many files are open, so it is more than there are statuses.
WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "3"}


@dataclass(frozen=True)
class LoadAudit:
    files: int
    rows_read: int
    rows_loaded: int
    rows_rejected: int


def read_staging(spark: SparkSession, staging: str, parts: Sequence[str] | None = None) -> DataFrame:
    """All staged rows with ``status`` (loaded, rejected) and ``reasons``, or those of some loads."""
    rows = snapshot(spark, staging).tables.get(ROWS)
    if rows is None:
        raise ValueError(f"nothing is staged in {staging}")
    return read_parts(spark, staging, rows, None if parts is None else tuple(parts))


def staged_sales(spark: SparkSession, staging: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The well-formed flat rows; the rejected ones are another partition and not read."""
    return read_staging(spark, staging, parts).where("status = 'loaded'").select(*FLAT_COLUMNS)


def staged_loads(spark: SparkSession, staging: str) -> dict[str, dict]:
    """What is noted of every load, by the name of its part of the staged rows."""
    return dict(snapshot(spark, staging).notes.get(LOADS, {}))


def new_files(spark: SparkSession, files: list[str], staged: DataFrame | None) -> list[str]:
    """Those of the files that no committed load lists; the listed names stay on the executors."""
    if staged is None:
        return files
    listed = spark.createDataFrame([(f,) for f in files], "source_file string")
    return sorted(r.source_file for r in listed.join(staged, "source_file", "left_anti").collect())


def load_csv(spark: SparkSession, path: str, staging: str) -> LoadAudit:
    """Append the CSV files that are not staged yet; one pass loads, sorts out and counts,
    after those that find blocks and records over lines.

    Malformed records and rows with an impossible date go to the partition
    ``status=rejected`` with their reasons and, where malformed, their text.

    A load is a version of the staging folder (see ``snapshots``): its rows, the names of
    its files and a note of its counts, its money and a digest of its rows are committed
    together. A load that dies leaves nothing that is read, and a file of a committed load
    is left alone: to find out, only the lists of files are read, no row.
    """
    files = csv_files(spark, path)
    if not files:
        return LoadAudit(0, 0, 0, 0)
    attempt = Attempt(spark, staging)
    known = attempt.read(FILES) if FILES in attempt.base.tables else None
    files = new_files(spark, files, known)
    if not files:
        return LoadAudit(0, 0, 0, 0)
    rejected = F.size("reasons") > 0
    with with_settings(spark, DROP_SHUFFLES | WRITERS):
        rows = (
            read_sales_csv(spark, files, attempt.aside)
            .withColumn("reasons", bad_row_reasons(CORRUPT))
            .withColumn("status", F.when(rejected, F.lit("rejected")).otherwise(F.lit("loaded")))
        )
        attempt.add(
            ROWS,
            rows,
            lambda w: w.partitionBy("status").option("compression", "zstd"),
            rows_read=F.count(F.lit(1)),
            rows_rejected=F.count(F.when(rejected, 1)),
            revenue=money(F.sum(F.when(~rejected, F.col("sale_total_price")))),
            digest=row_digest(*FLAT_COLUMNS),
        )
    attempt.add(FILES, spark.createDataFrame([(f,) for f in files], "source_file string").coalesce(1))
    counts = attempt.observed[ROWS]
    audit = LoadAudit(
        len(files),
        counts["rows_read"],
        counts["rows_read"] - counts["rows_rejected"],
        counts["rows_rejected"],
    )
    (part,) = attempt.new[ROWS].parts
    noted = {**asdict(audit), "revenue": str(counts["revenue"] or 0), "digest": str(counts["digest"] or 0)}
    attempt.notes[LOADS] = {**attempt.notes.get(LOADS, {}), part: noted}
    attempt.commit()
    return audit


def mart_rows(mart: DataFrame, name: str) -> DataFrame:
    """Rows of a mart in its sort order, across and within the files they are written to."""
    order = MART_SORT_KEYS[name]
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in MART_SCHEMAS[name]]
    return mart.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)


def write_mart(mart: DataFrame, name: str, path: str) -> None:
    """Replace a stored mart, its rows in the mart's sort order across and within files."""
    mart_rows(mart, name).write.mode("overwrite").parquet(path)


def fact_rows(keyed: DataFrame) -> DataFrame:
    """The fact with its day and its sale year, by which its files are partitioned.

    Within a year, rows follow a space-filling curve over day, product and store. Files and
    the pieces in them then hold narrow ranges of all three, and their statistics let a filter
    on any one of them skip most. Ranges of the curve are dealt evenly, so that a big year
    has several tasks and small years share one.
    """
    fact = fact_sales(
        keyed.withColumn("sale_year", F.year("sale_date")), extra=("sale_date", "sale_year")
    )
    place = interleaved(
        [of_day(F.col("sale_date")), of_key(F.col("product_id")), of_key(F.col("store_id"))]
    )
    fact = fact.withColumn("place", place).repartitionByRange("sale_year", "place", "source_id")
    return fact.sortWithinPartitions("sale_year", "place").drop("place")


def write_fact(keyed: DataFrame, path: str) -> None:
    """Replace the stored fact, partitioned by sale year."""
    fact_rows(keyed).write.mode("overwrite").partitionBy("sale_year").parquet(path)


def write_dimension(dimension: DataFrame, path: str) -> None:
    """Replace a stored dimension."""
    dimension.write.mode("overwrite").parquet(path)


def append_dimension(spark: SparkSession, members: DataFrame, path: str) -> None:
    """Add the members a stored dimension does not have; a second run adds none."""
    stored = spark.read.schema(members.schema).parquet(path)
    unseen_members(members, stored).write.mode("append").parquet(path)
