"""Tables of very many small folders on a local or mounted file system.

For each file that Hadoop's local file system makes it starts two ``chmod`` processes, which with a folder per
entity is nearly all that a write does. Here tasks write the files themselves and Spark does the rest: it sorts
the rows into ranges, formats CSV lines and keeps the list of what was written.

A task writes below a folder of its own attempt, so only files of attempts that succeeded are listed. Once all
are there, tasks put the listed files in place, each with one rename, and remove what a folder held before.
Both steps may run twice: names hold the run, so a file that is in place already is told from an older one.

Spark's reader keeps the status of every file in the driver and opens each in about 3 ms, so tables of very many
files are also listed and read by tasks. The driver then holds nothing that grows with the number of folders.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyloom.session import as_table
from tallyloom.sinks.commits import _hadoop

TEXT_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
              T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
PLAIN_TYPES = {"csv": TEXT_TYPES, "parquet": (*TEXT_TYPES, T.BinaryType)}
FEW_FILES = 10_000  # tables with no more are left to Spark's own reader
PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst|zstd)$"  # text that Spark unpacks by the ending of its name


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder on a local or mounted file system; None for any other store."""
    _, target, system = _hadoop(spark, path)
    return system.makeQualified(target).toUri().getPath() if system.getScheme() == "file" else None


def can_write(df: DataFrame, path: str, by: Sequence[str], fmt: str) -> bool:
    """Whether ``write_folders`` takes these rows; all others are for Spark's own writer, which also names their errors."""
    names, rest = [c.lower() for c in df.columns], [f for f in df.schema if f.name not in by]
    plain = all(isinstance(f.dataType, PLAIN_TYPES.get(fmt, ())) for f in rest)
    return (bool(rest) and plain and len(set(names)) == len(names) == len(rest) + len(by)
            and local_path(df.sparkSession, path) is not None)


def _stager(staging: str, run: str, by: list[str], fmt: str, header: str | None, facts: dict):
    """Writes the files of one range; runs in tasks and needs nothing of this package there."""
    size, width, flush = len(by), len(by) + 1, 64 << 20

    def stage(batches):
        import os

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        odd = {*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"}  # what Spark does not leave in a folder's name

        def escaped(text):
            return "".join(f"%{ord(c):02X}" if c in odd else c for c in text) if text else "__HIVE_DEFAULT_PARTITION__"

        task = TaskContext.get()
        place, part = f"t{task.taskAttemptId()}", f"part-{task.partitionId():05d}-{run}"
        os.makedirs(f"{staging}/{place}", exist_ok=True)
        key = sink = None  # the folder that is being written
        done, held, rows = [], [], 0
        n_files = 0

        def opened(label):
            nonlocal n_files
            name = f"{part}.c{n_files:06d}.{fmt}"
            n_files += 1
            done.append(("/".join(f"{escaped(n)}={escaped(v)}" for n, v in zip(by, label)), f"{place}/{name}", name))
            if fmt == "csv":
                file = open(f"{staging}/{place}/{name}", "wb")
                if header is not None:
                    file.write(f"{header}\n".encode())
                return file
            return f"{staging}/{place}/{name}", None

        def flushed(last):
            """Parquet rows held so far as a row group."""
            nonlocal sink, held
            path, writer = sink
            table = pa.Table.from_batches(held)
            table = table.replace_schema_metadata(facts)
            # Most files are a few rows: a dictionary, the Arrow schema and a file handle of their own cost more than these.
            small = writer is None and last and table.num_rows < 1000
            out = pa.BufferOutputStream() if small else path
            writer = writer or pq.ParquetWriter(out, table.schema, compression="snappy", use_dictionary=not small,
                                                store_schema=False)
            writer.write_table(table)
            sink, held = (path, writer), []
            if last:
                writer.close()
            if small:
                with open(path, "wb") as file:
                    file.write(out.getvalue())

        def closed():
            if sink is not None:
                sink.close() if fmt == "csv" else flushed(True)

        def report():
            nonlocal done
            names = zip(*done) if done else ([], [], [])
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in names], names=["folder", "staged", "name"])
            done = []
            return out

        for batch in batches:
            labels = list(zip(*[batch.column(i).to_pylist() for i in range(size)]))
            lines = batch.column(size).to_pylist() if fmt == "csv" else None
            data = None if fmt == "csv" else batch.select(range(size, batch.num_columns))
            start = 0
            while start < len(labels):
                end = start + 1
                while end < len(labels) and labels[end] == labels[start]:
                    end += 1
                if sink is None or labels[start] != key:
                    closed()
                    key = labels[start]
                    sink = opened(key)
                if fmt == "csv":
                    sink.write(("\n".join(lines[start:end]) + "\n").encode())
                else:
                    held.append(data.slice(start, end - start))
                    if len(held) > 1 and sum(h.nbytes for h in held) > flush:
                        flushed(False)
                start = end
            # The file still open is listed as well; a task that fails later lists nothing.
            yield report()
        closed()
        yield report()

    return stage


def _publisher(root: str, staging: str, run: str):
    """Puts listed files in place; runs in tasks."""

    def publish(batches):
        import os
        import shutil

        import pyarrow as pa

        seen = None
        for batch in batches:
            for folder, staged, name in zip(*[c.to_pylist() for c in batch.columns]):
                target = f"{root}/{folder}"
                if folder != seen:
                    os.makedirs(target, exist_ok=True)
                    for entry in os.scandir(target):
                        if f"-{run}." not in entry.name:
                            try:
                                shutil.rmtree(entry.path) if entry.is_dir(follow_symlinks=False) else os.unlink(entry.path)
                            except FileNotFoundError:
                                pass  # another task puts files in this folder too
                    seen = folder
                try:
                    os.replace(f"{staging}/{staged}", f"{target}/{name}")
                except FileNotFoundError:
                    if not os.path.exists(f"{target}/{name}"):
                        raise
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return publish


def write_folders(rows: DataFrame, path: str, by: Sequence[str], fmt: str, replace: str = "partitions",
                  header: bool = False) -> None:
    """Rows, in ranges sorted by ``by``, under ``<by>=`` folders as Spark's own writer lays them out.

    ``partitions`` replaces the folders that the rows fall into as a whole, ``all`` the whole table.
    """
    spark, by = rows.sparkSession, list(by)
    root, run = local_path(spark, path), uuid.uuid4().hex
    staging = f"{root}/.staging-{run}"
    rest = [f for f in rows.schema if f.name not in by]
    labels = [F.col(f"`{c}`").cast("string").alias(f"_by{i}") for i, c in enumerate(by)]
    head, facts = None, {}
    if fmt == "csv":
        picked = rows.select(*labels, F.to_csv(F.struct(*[f"`{f.name}`" for f in rest])).alias("_line"))
        if header:
            names = F.struct(*[F.lit(f.name).alias(f"c{i}") for i, f in enumerate(rest)])
            head = spark.range(1).select(F.to_csv(names)).first()[0]
    else:
        picked = rows.select(*labels, *[f"`{f.name}`" for f in rest])
        facts = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": T.StructType(
            [T.StructField(f.name, f.dataType, True, f.metadata) for f in rest]).json()}
    os.makedirs(staging)
    try:
        staged = as_table(picked.mapInArrow(_stager(staging, run, by, fmt, head, facts), "folder string, staged string, name string"),
                          "staged-files")
        if replace == "all":
            for entry in os.scandir(root):
                if entry.path != staging:
                    shutil.rmtree(entry.path) if entry.is_dir(follow_symlinks=False) else os.unlink(entry.path)
        staged.mapInArrow(_publisher(root, staging, run), "n long").agg(F.sum("n")).first()
        open(f"{root}/_SUCCESS", "w").close()
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def folder_value(name: str) -> Column:
    """The value that the folder ``<name>=`` of a row's file stands for, of files read with ``recursiveFileLookup``.

    Spark finds partitions from folder names in time that grows with the square of their number, so very
    many folders are read as plain files.
    """
    raw = F.regexp_extract("_metadata.file_path", f".*/{re.escape(name)}=([^/]*)/", 1)

    def decoded(text: Column) -> Column:
        return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))

    # Escaped once as a folder's name and once more as part of a URI.
    return F.when(raw != "__HIVE_DEFAULT_PARTITION__", decoded(decoded(raw)))


def has_many(root: str) -> bool:
    """Whether there are more files than Spark's reader is given; no more than those are looked at."""
    def files(folder: str) -> Iterator[str]:
        with os.scandir(folder) as found:
            for entry in found:
                if entry.is_dir():
                    yield from files(entry.path)
                else:
                    yield entry.path

    return sum(1 for _ in islice(files(root), FEW_FILES + 1)) > FEW_FILES


def _lister(root: str, deep: bool):
    """Puts what folders hold in their place, and with ``deep`` all files below them; runs in tasks."""

    def listing(batches):
        import os

        import pyarrow as pa

        def hidden(name):  # to Spark's readers
            return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)

        def report(paths, kinds):
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(kinds, pa.bool_())], names=["path", "folder"])

        paths, kinds = [], []
        for batch in batches:
            for given, folder in zip(*[c.to_pylist() for c in batch.columns]):
                left = [given] if folder else []
                if not folder:
                    paths.append(given)
                    kinds.append(False)
                while left:
                    above = left.pop()
                    with os.scandir(f"{root}/{above}") as found:
                        for entry in found:
                            if hidden(entry.name):
                                continue
                            path, inner = f"{above}/{entry.name}" if above else entry.name, entry.is_dir()
                            if inner and deep:
                                left.append(path)
                                continue
                            paths.append(path)
                            kinds.append(inner)
                            if len(paths) >= 10_000:
                                yield report(paths, kinds)
                                paths, kinds = [], []
        yield report(paths, kinds)

    return listing


def list_files(spark: SparkSession, root: str, levels: int) -> DataFrame:
    """Paths below ``root`` of a table's files. Tasks list them, each level of folders spread anew."""
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spark.range(1).select(F.lit("").alias("path"), F.lit(True).alias("folder"))
    for level in range(levels + 1):
        found = found.repartition(count, "path").mapInArrow(_lister(root, level == levels), "path string, folder boolean")
    return found.select("path")


def _labels(by: list[str]):
    """The values that a path's folders stand for; runs in tasks."""

    def labels(path):
        import re

        found = dict(part.split("=", 1) for part in path.split("/")[:-1] if "=" in part)
        values = [found.get(name, "") for name in by]
        return [None if v == "__HIVE_DEFAULT_PARTITION__" else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), v)
                for v in values]

    return labels


def _text_reader(root: str, by: list[str], header: bool):
    """The lines of text files as Spark's reader takes them; runs in tasks."""
    labels, names = _labels(by), [*[f"_by{i}" for i in range(len(by))], "_file", "_line", "_text"]

    def read(batches):
        import pyarrow as pa

        blank = "".join(map(chr, range(33)))
        rows, size = [[] for _ in names], 0

        def report():
            nonlocal rows, size
            types = [*[pa.string()] * (len(by) + 1), pa.int64(), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)
            rows, size = [[] for _ in names], 0
            return out

        for batch in batches:
            for path in batch.column(0).to_pylist():
                values, n = [*labels(path), path.rsplit("/", 1)[-1]], -1 if header else 0
                with open(f"{root}/{path}", encoding="utf-8", errors="replace") as file:
                    first = True
                    while chunk := file.readlines(1 << 20):
                        if first:
                            chunk[0], first = chunk[0].removeprefix("\ufeff"), False
                        kept = [line.removesuffix("\n") for line in chunk if line.strip(blank)]
                        if n < 0 and kept:
                            n, kept = 0, kept[1:]
                        for column, value in zip(rows, values):
                            column.extend([value] * len(kept))
                        rows[-2].extend(range(n, n + len(kept)))
                        rows[-1].extend(kept)
                        n, size = n + len(kept) if n >= 0 else n, size + sum(map(len, kept))
                        if len(rows[-1]) >= 10_000 or size >= 4 << 20:
                            yield report()
        yield report()

    return read


def _parquet_reader(root: str, by: list[str], schema):
    """The rows of Parquet files in the columns and types of ``schema``, as far as these widen; runs in tasks."""
    labels, names = _labels(by), [*[f"_by{i}" for i in range(len(by))], *schema.names]

    def read(batches):
        import os

        import pyarrow as pa
        import pyarrow.parquet as pq

        fixed = (pa.types.is_string, pa.types.is_large_string, pa.types.is_binary, pa.types.is_large_binary, pa.types.is_boolean)
        held, values, rows = [], [[] for _ in by], 0

        def fitted(table, path):
            if table.schema.equals(schema):
                return table
            there = {c.lower(): i for i, c in reversed([*enumerate(table.column_names)])} | {c: i for i, c in enumerate(table.column_names)}
            columns = []
            for field in schema:
                at = there.get(field.name, there.get(field.name.lower()))
                column = pa.nulls(table.num_rows, field.type) if at is None else table.column(at)
                text = {"large_string": "string", "large_binary": "binary"}.get(str(column.type), str(column.type))
                if text != str(field.type) and any(kind(t) for kind in fixed for t in (column.type, field.type)):
                    raise TypeError(f"{path}: {field.name} is {column.type}, not {field.type}")
                columns.append(column.cast(field.type))
            return pa.Table.from_arrays(columns, schema=schema)

        def report():
            nonlocal held, values, rows
            table = pa.concat_tables([schema.empty_table(), *held]).combine_chunks()
            columns = [*[pa.array(v, pa.string()) for v in values], *table.columns]
            held, values, rows = [], [[] for _ in by], 0
            return pa.Table.from_arrays(columns, names=names).combine_chunks().to_batches()

        for batch in batches:
            for path in batch.column(0).to_pylist():
                whole = f"{root}/{path}"
                if not (size := os.path.getsize(whole)):
                    continue
                source, found = whole, labels(path)
                if size < 1 << 20:
                    with open(whole, "rb") as file:
                        source = pa.BufferReader(file.read())
                file = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
                tables = ([file.read(use_threads=False)] if file.metadata.num_rows <= 50_000 else
                          (pa.Table.from_batches([b]) for b in file.iter_batches(50_000, use_threads=False)))
                for table in tables:
                    held.append(fitted(table.replace_schema_metadata(None), path))
                    for column, value in zip(values, found):
                        column.extend([value] * table.num_rows)
                    rows += table.num_rows
                    if rows >= 20_000 or len(held) >= 5_000:
                        yield from report()
        yield from report()

    return read


def _listed(spark: SparkSession, path: str, by: Sequence[str]) -> tuple[str, DataFrame] | None:
    """Root and files of a table that tasks read, spread over them; None for one that Spark's own reader takes."""
    root = local_path(spark, path)
    if root is None or not has_many(root):
        return None
    return root, as_table(list_files(spark, root, len(by)), "listed-files")


def _spread(files: DataFrame) -> DataFrame:
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")


def read_lines(spark: SparkSession, path: str, by: Sequence[str], header: bool = False) -> DataFrame | None:
    """Lines of text files below ``<by>=`` folders as ``by``, ``_file`` (its name), ``_line`` (from 0) and ``_text``.

    None for a table that Spark's own reader takes: one of few files, of packed files, or in another store.
    Empty lines, and with ``header`` the first line of a file, are left out as Spark's CSV reader does.
    """
    listed = _listed(spark, path, by)
    if listed is None or not listed[1].where(F.col("path").rlike(PACKED)).isEmpty():
        return None
    root, files = listed
    types = ", ".join([*[f"_by{i} string" for i in range(len(by))], "_file string, _line long, _text string"])
    rows = _spread(files).mapInArrow(_text_reader(root, list(by), header), types)
    return rows.select(*[F.col(f"_by{i}").alias(c) for i, c in enumerate(by)], "_file", "_line", "_text")


def read_parquet(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame | None:
    """Rows of Parquet files below ``<by>=`` folders, these as text behind the columns of the first file.

    None for a table that Spark's own reader takes: one of few files, of nested types, or in another store.
    """
    listed = _listed(spark, path, by)
    if listed is None:
        return None
    root, files = listed
    first = files.agg(F.min("path")).first()[0]
    schema = spark.read.option("recursiveFileLookup", True).parquet(f"{path.rstrip('/')}/{first}").schema
    names = [f.name.lower() for f in schema]
    if len({*names, *by}) < len(names) + len(by) or not all(isinstance(f.dataType, PLAIN_TYPES["parquet"]) for f in schema):
        return None
    types = T.StructType([*[T.StructField(f"_by{i}", T.StringType()) for i in range(len(by))], *schema])
    rows = _spread(files).mapInArrow(_parquet_reader(root, list(by), to_arrow_schema(schema)), types)
    return rows.select(*[f"`{f.name}`" for f in schema], *[F.col(f"_by{i}").alias(c) for i, c in enumerate(by)])


def count_folders(spark: SparkSession, root: str, suffix: str) -> int:
    """Folders of a table with one level that hold a file of this kind; no file is opened."""
    if has_many(root):
        held = F.col("path").rlike(f"^[^/]*=[^/]*/[^/]*{re.escape(suffix)}$")
        return list_files(spark, root, 1).where(held).select(F.substring_index("path", "/", 1)).distinct().count()
    return sum(any(name.endswith(suffix) for name in os.listdir(entry.path))
               for entry in os.scandir(root) if "=" in entry.name and entry.is_dir())
