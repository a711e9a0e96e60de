"""Profile of all CSV tables below a folder, whatever their columns are.

Lines of all files are scanned together: once for the places of the first lines, then twice. The first of these splits lines into cells and learns, for each file and place of a
cell, the name (the cell of the first line), how many cells are filled, which types they could have, and about how many
different ones there are. The second only looks at the places named as label, attack flag and address, and counts
their values exactly. Nothing but one row for each column of a file is held anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlog.session import materialize

# Columns that are looked at more closely, and how many labels are listed.
ATTACK_COLUMN, LABEL_COLUMN, ADDRESS_COLUMN, TIME_COLUMN = "is_attack", "label", "source_ip", "timestamp"
TOP_LABELS = 10
# Relative standard error of the sketched number of different values.
SKETCH_ERROR = 0.02

CELL_BORDER = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # a comma outside quotes
TYPES = ("bigint", "double", "boolean", "timestamp")


def unquoted(cell: Column) -> Column:
    whole = F.trim(cell)
    inner = F.regexp_replace(F.regexp_extract(whole, r'(?s)^"(.*)"$', 1), '""', '"')
    return F.when(whole.startswith('"') & whole.endswith('"') & (F.length(whole) > 1), inner).otherwise(whole)


def csv_cells(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size, names, cells`` of every line that is not blank; ``names`` is true for the first line of a file."""
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(folder)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                     F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"),
                     F.regexp_replace("value", "\r$", "").alias("value"))).where("trim(value) <> ''")
    heads = materialize(lines.where("_block = 0").groupBy("path").agg(F.min("_id").alias("_first")), "csv-heads")
    return lines.join(heads, "path").select("path", "size", (F.col("_id") == F.col("_first")).alias("names"),
                                            F.split("value", CELL_BORDER, -1).alias("cells"))


def column_profile(cells: DataFrame) -> DataFrame:
    """``path, size, place, name, lines, filled, type, about`` of each named column of each file.

    The type is the first of ``TYPES`` that all filled cells have, else ``string``; ``about`` is the sketched number of
    different filled cells.
    """
    tall = cells.select("path", "size", "names", F.posexplode("cells").alias("place", "cell"))
    tall = tall.withColumn("cell", F.nullif(unquoted(F.col("cell")), F.lit("")))
    named = tall.where("names and cell is not null").select("path", "place", F.col("cell").alias("name"))
    value = F.when(~F.col("names"), F.col("cell"))
    unfit = [F.count_if(value.isNotNull() & value.try_cast(t).isNull()).alias(f"not_{t}") for t in TYPES]
    found = tall.groupBy("path", "size", "place").agg(
        F.count_if(~F.col("names")).alias("lines"), F.count(value).alias("filled"), *unfit,
        F.approx_count_distinct(value, SKETCH_ERROR).alias("about"))
    kind = F.lit("string")
    for t in reversed(TYPES):
        kind = F.when((F.col("filled") > 0) & (F.col(f"not_{t}") == 0), t).otherwise(kind)
    return found.join(named, ["path", "place"]).select("path", "size", "place", "name", "lines", "filled", kind.alias("type"), "about")


def most_frequent(counts: DataFrame, name: str, as_: str) -> DataFrame:
    """``path`` and the ``TOP_LABELS`` most frequent values of a column with their numbers."""
    order = Window.partitionBy("path").orderBy(F.desc("n"), "value")
    best = counts.where(F.col("name") == name).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= TOP_LABELS)
    listed = F.array_sort(F.collect_list(F.struct("_rank", "value", "n")))
    return best.groupBy("path").agg(F.transform(listed, lambda v: F.struct(v["value"].alias("value"), v["n"].alias("n"))).alias(as_))


def folder_profile(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each CSV file below ``folder``, at any depth.

    ``path, size_mb, rows, columns`` (name and type, in order), ``has_timestamp, attack_counts, label_counts`` (value and number,
    the ten most frequent, ties to the smaller value), ``unique_ips`` (exact) and ``about_ips`` (a sketch with a
    relative standard error of 0.02). What a file has no column for is null; a file with names only has no rows, and one
    without a line is not listed. The first line holds the names. A cell may be quoted but must not hold a line
    break; cells without a name are left out.
    """
    cells = csv_cells(spark, folder)
    columns = materialize(column_profile(cells), "csv-columns")
    in_order = F.array_sort(F.collect_list(F.struct("place", "name", "type")))  # the columns of a file
    files = columns.groupBy("path", "size").agg(
        F.max("lines").alias("rows"), F.transform(in_order, lambda c: F.struct(c["name"].alias("name"), c["type"].alias("type"))).alias("columns"),
        F.count_if(F.col("name") == TIME_COLUMN).alias("times"), F.max(F.when(F.col("name") == ADDRESS_COLUMN, F.col("about"))).alias("about_ips"))
    wanted = columns.where(F.col("name").isin(ATTACK_COLUMN, LABEL_COLUMN, ADDRESS_COLUMN)).select("path", "place", "name")
    value = F.nullif(unquoted(F.get("cells", F.col("place"))), F.lit(""))
    counted = cells.where("not names").join(wanted, "path").select("path", "name", value.alias("value")).where("value is not null")
    counts = materialize(counted.groupBy("path", "name", "value").agg(F.count(F.lit(1)).alias("n")), "csv-values")
    addresses = counts.where(F.col("name") == ADDRESS_COLUMN).groupBy("path").agg(F.count(F.lit(1)).alias("unique_ips"))
    for part in (most_frequent(counts, ATTACK_COLUMN, "attack_counts"), most_frequent(counts, LABEL_COLUMN, "label_counts"), addresses):
        files = files.join(part, "path", "left")
    return files.select("path", F.round(F.col("size") / (1024 * 1024), 2).alias("size_mb"), "rows", "columns", (F.col("times") > 0).alias("has_timestamp"),
                        "attack_counts", "label_counts", "unique_ips", "about_ips")
