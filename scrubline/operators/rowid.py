"""Row numbers in the order of the files.

Spark rows have no order, so every "first N" or "Row n" needs an explicit
order column.  Scan partitions do not follow the files (Spark packs the splits of a
folder by size), so a row is placed by its file, the start of its split in the
file and its place within the split: ``with_places`` takes these from the scan's
``_metadata``.  ``number_rows`` counts the rows of every split (a pre-aggregated
``groupBy`` that reads no column of a columnar file), adds them up in the order of path and
split start, and gives each row its exact 0-based number in (path, line) order by
a broadcast join with one narrow row per split.  No row is sorted or shuffled.

Rows of a plan that is no plain file scan are numbered by partition and place in it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_dir

ROW_ID = "_row_id"
FILE, BLOCK, PLACE = "_in_file", "_in_block", "_in_place"
BROADCAST_SPLITS = 1_000_000  # three longs each; the splits of a table of 100 TB at 128 MB are about 800,000
_PART_BITS = 33  # bits that monotonically_increasing_id leaves for the place in a partition


def with_places(df: DataFrame) -> DataFrame:
    """``df`` with the file, the split and the place in it of every row; to be called on the scan itself."""
    place = F.monotonically_increasing_id()
    try:
        return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), place.alias(PLACE))
    except AnalysisException:  # no file scan
        return (df.withColumn(PLACE, place).withColumn(FILE, F.lit(""))
                .withColumn(BLOCK, F.shiftright(F.col(PLACE), _PART_BITS)))


def split_starts(placed: DataFrame) -> tuple[DataFrame, bool]:
    """Written table ``(key, block, base)``: what to add to a row's place for its number; and whether its
    size allows to broadcast it."""
    path = F.col(FILE)
    per_split = placed.groupBy(path, F.col(BLOCK)).agg(F.count(F.lit(1)).alias("n"), F.min(PLACE).alias("first"))
    before = Window.orderBy(FILE, BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    starts = per_split.select(path, F.xxhash64(path).alias("_key"), F.col(BLOCK).alias("_block"),
                              (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("_base"))
    out = new_run_dir(placed.sparkSession, "splits")
    starts.write.parquet(out)
    table = placed.sparkSession.read.schema(starts.schema).parquet(out)
    n, files, keys = table.agg(F.count(F.lit(1)), F.count_distinct(FILE), F.count_distinct("_key")).first()
    if files != keys:  # two paths with one hash
        raise ValueError("paths collide: read the files in two groups")
    return table.drop(FILE), n <= BROADCAST_SPLITS


def number_rows(placed: DataFrame, name: str = ROW_ID) -> DataFrame:
    """A table with places -> the same without them and with the 0-based number of each row in file order.

    Runs a small job (the row counts of the splits).
    """
    starts, small = split_starts(placed)
    starts = F.broadcast(starts) if small else starts
    same = (F.xxhash64(placed[FILE]) == starts["_key"]) & (placed[BLOCK] == starts["_block"])
    return placed.join(starts, same).withColumn(name, F.col(PLACE) + F.col("_base")).drop(
        FILE, BLOCK, PLACE, "_key", "_block", "_base")


def with_row_id(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """A scan with the 0-based number of each row in the order of (path, line)."""
    return number_rows(with_places(df), name)


def row_number(row_id: str = ROW_ID):
    """The 1-based "Row n" of a numbered row."""
    return (F.col(row_id) + 1).cast("bigint").alias("row_number")
