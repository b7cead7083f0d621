"""Files that hold near values of two columns, so that a filter on either reads few of them.

Each column's values are cut into ranges of about equally many rows, and a row's place is where a curve that
fills the plane of both ranges passes it: the curve keeps what is near on it near in both columns. Rows
are written in order of the curve, and the least and largest value of each column in each file are kept
beside the files. A read looks those up first and opens only the files that can hold what it asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 6  # of a column's range number: 64 ranges a column, 4096 places on the curve
SAMPLE = 100_000  # rows that the ranges are cut by


def ranges(df: DataFrame, columns: Sequence[str], bits: int = BITS, sample: int = SAMPLE, seed: int = 7) -> dict[str, list]:
    """Upper bounds of ranges of about equal size per column, from a sample of at most about ``sample`` rows.

    The sample decides where rows lie, never whether they are kept. Of a value that fills several ranges
    one bound remains.
    """
    total = df.count()
    some = df.select(*columns) if total <= sample else df.select(*columns).sample(sample / total, seed)
    cuts = {}
    for c in columns:
        # One row per distinct sampled value, with how many rows lie below it.
        counted = some.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").alias("v")).agg(F.count("*").alias("n")).orderBy("v").collect()
        rows, bounds, seen = sum(r["n"] for r in counted), [], 0
        for r in counted:
            seen += r["n"]
            if seen * (1 << bits) >= rows * (len(bounds) + 1):
                bounds.append(r["v"])
        cuts[c] = bounds[:(1 << bits) - 1]
    return cuts


def range_number(value: Column, bounds: list) -> Column:
    """How many bounds lie below a value; nulls come first."""
    if not bounds:
        return F.lit(0)
    held = F.lit(bounds) if not isinstance(bounds[0], bytes) else F.array(*[F.lit(b) for b in bounds])
    return F.when(value.isNull(), 0).otherwise(F.size(F.filter(held, lambda b: b < value)))


def curve_place(x: int, y: int, bits: int = BITS) -> int:
    """The place of a cell on Hilbert's curve: from the highest bit down, each step picks one of four squares and
    turns the rest, so that following places are always neighbours."""
    place = 0
    for k in reversed(range(bits)):
        half = 1 << k
        right, upper = x >> k & 1, y >> k & 1
        place += (3 * right ^ upper) * half * half
        x, y = x & (half - 1), y & (half - 1)
        if not upper:
            x, y = (half - 1 - y, half - 1 - x) if right else (y, x)
    return place


def placed(df: DataFrame, columns: tuple[str, str], cuts: Mapping[str, list], target: str = "_place") -> DataFrame:
    """The rows with their place on the curve, looked up by their cell."""
    side = 1 << BITS
    # One row per cell of the plane: 4,096 at any size of the table.
    curve = df.sparkSession.createDataFrame(
        [(x * side + y, curve_place(x, y)) for x in range(side) for y in range(side)], f"_cell int, {target} int")
    cell = sum(range_number(F.col(f"`{c}`"), cuts[c]) * weight for c, weight in zip(columns, (side, 1)))
    return df.withColumn("_cell", cell.cast("int")).join(F.broadcast(curve), "_cell").drop("_cell")


def write_clustered(df: DataFrame, path: str, columns: tuple[str, str], files: int) -> None:
    """The rows as about ``files`` files in order of the curve, and the columns' bounds per file.

    A cell with more rows than a file is to have is split by the row, so equal values do not make one task.
    """
    spark = df.sparkSession
    rows = placed(df, columns, ranges(df, columns))
    split = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    (rows.repartitionByRange(files, F.col("_place"), split).sortWithinPartitions("_place").drop("_place")
     .write.parquet(f"{path}/rows"))
    written = spark.read.parquet(f"{path}/rows")
    bounds = [b for c in columns for b in (F.min(f"`{c}`").alias(f"{c}_least"), F.max(f"`{c}`").alias(f"{c}_most"),
                                           F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}_nulls"))]
    written.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("n_rows"), *bounds).write.parquet(f"{path}/index")


def files_for(spark: SparkSession, path: str, wanted: Mapping[str, tuple]) -> DataFrame:
    """The index rows of the files that can hold rows with every column within its closed range."""
    index = spark.read.parquet(f"{path}/index")
    for c, (low, high) in wanted.items():
        index = index.where((F.col(f"{c}_most") >= F.lit(low)) & (F.col(f"{c}_least") <= F.lit(high)))
    return index


def read_clustered(spark: SparkSession, path: str, wanted: Mapping[str, tuple]) -> DataFrame:
    """The rows with every named column within its closed range, from the files that can hold them."""
    rows = spark.read.parquet(f"{path}/rows")
    names = [r["file_path"] for r in files_for(spark, path, wanted).select("file_path").collect()]
    # A condition on the path alone, which Spark applies to its list of files.
    rows = rows.where(F.col("_metadata.file_path").isin(names)) if names else rows.where("false")
    for c, (low, high) in wanted.items():
        rows = rows.where(F.col(f"`{c}`").between(F.lit(low), F.lit(high)))
    return rows
