"""Sources and sinks.

* delimited line lists and interim tables are read with declared types given
  as a compact type string (``c`` text, ``i`` integer, ``d`` double, ``D``
  date), never inferred, so codes keep their leading zeros;
* ``NA`` and the empty field both read as NULL;
* a headerless sheet export is read as text and its first ``skip`` lines per
  file are dropped, without funnelling the file through one task;
* tables are written as CSV with a header, ``NA`` for NULL and ISO dates, or
  as parquet (the default interim format).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import Selector, select_names
from ..session import materialize

TYPE_LETTERS: dict[str, T.DataType] = {
    "c": T.StringType(), "i": T.IntegerType(), "d": T.DoubleType(), "D": T.DateType(),
    "l": T.LongType(), "n": T.DoubleType(), "T": T.TimestampType(),
}


def type_string_schema(types: str, names: Sequence[str]) -> T.StructType:
    """``"cDi"`` + names -> StructType, one letter per column."""
    if len(types) != len(names):
        raise ValueError(f"type string {types!r} has {len(types)} letters for {len(names)} columns")
    return T.StructType([T.StructField(n, TYPE_LETTERS[t], True) for n, t in zip(names, types)])


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def _na_to_null(df: DataFrame) -> DataFrame:
    """The literal text NA is missing too (a quoted empty field may survive as '')."""
    fixes = {f.name: F.when(F.col(f.name).isin("NA", ""), F.lit(None)).otherwise(F.col(f.name))
             for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(fixes) if fixes else df


def read_delimited(spark: SparkSession, path: str, types: str, names: Sequence[str] | None = None,
                   sep: str = ",", header: bool = True,
                   columns: Selector | Sequence[str] | None = None, quoted_breaks: bool = False) -> DataFrame:
    """Delimited scan with declared types; optional column subset.

    Names come from ``names`` or, when omitted, from the file header.
    Non-string columns are parsed with ``NA`` as NULL; unparsable numbers or
    dates give NULL (permissive mode), as the reference's reader does.
    With ``quoted_breaks`` quoted cells may hold line breaks and doubled quotes, at and
    across file splits (``quoted_records``; one more pass counts the quotes). The header
    is the first line of each file then, and blank lines between records are no rows.
    """
    names = list(names) if names is not None else _header(spark, path, sep)
    schema = type_string_schema(types, names)
    options = {"sep": sep, "nullValue": "NA", "mode": "PERMISSIVE", "dateFormat": "yyyy-MM-dd"}
    if quoted_breaks:
        lines = _numbered_lines(spark, path)
        records = quoted_records(_without_first(lines, 1) if header else lines).where(F.trim("value") != "")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        df = records.select(F.from_csv("value", ddl, options | {"escape": '"'}).alias("__row")).select("__row.*")
    else:
        df = spark.read.schema(schema).options(header=header, **options).csv(path)
    df = _na_to_null(df)
    if columns is not None:
        df = df.select(*select_names(df, columns))
    return df


def read_line_list(spark: SparkSession, path: str, types: str, sep: str = ";", quoted_breaks: bool = False) -> DataFrame:
    """Semicolon line list, names from its header, types by position."""
    return read_delimited(spark, path, types, sep=sep, quoted_breaks=quoted_breaks)


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, row): the lines of text files with their split and their order in it."""
    return (spark.read.option("lineSep", "\n").text(path)
                 .select("value", F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("row")))


def _without_first(lines: DataFrame, skip: int) -> DataFrame:
    """Numbered lines without the first ``skip`` of every file.

    Each file's first split is identified by ``_metadata.file_block_start = 0``;
    line positions inside it come from ``monotonically_increasing_id``, which
    numbers the rows of one input partition consecutively. The first rows, one a
    file, are broadcast, so the lines stay where and in the order in which they are read.
    """
    starts = materialize(lines.where(F.col("block") == 0).groupBy("file").agg(F.min("row").alias("r0")), "starts")
    return (lines.join(F.broadcast(starts), "file", "left")
                 .where((F.col("block") > 0) | (F.col("row") - F.col("r0") >= skip)).drop("r0"))


def _records_of_splits(borders: bool):
    """Work on batches of (split, opened, value), a split's lines in order: its whole records, or with ``borders``
    the pieces of records that cross its begin or its end, as (split, rec, value).

    ``opened`` counts the lines with an odd number of quotes before the split in its file.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, turn, rec, held = None, 0, None, []      # rec: the number of the held record if it began before the split

        def ended(rec: int | None) -> Iterator[pa.RecordBatch]:
            if held and (rec is not None) == borders:
                text = "\n".join(v for part in held for v in part.to_pylist())
                yield from given(pa.array([text]), rec)
            held.clear()

        def given(values: pa.Array, rec: int | None = None) -> Iterator[pa.RecordBatch]:
            if borders and rec is not None:
                yield pa.RecordBatch.from_arrays([pa.array([split]), pa.array([rec]), values], ["split", "rec", "value"])
            elif not borders and len(values):
                yield pa.RecordBatch.from_arrays([values], ["value"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True]))) if len(ids) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if ids[a] != split:
                    yield from ended((turn + 1) // 2)       # still open: it goes on in the next split
                    split, turn = int(ids[a]), batch.column(1)[int(a)].as_py()
                    rec = (turn + 1) // 2 if turn % 2 else None
                values = batch.column(2).slice(a, b - a)
                odd = pc.count_substring(values, '"').to_numpy() % 2
                after = turn + np.cumsum(odd)
                turn = int(after[-1])
                starts = np.flatnonzero((after - odd) % 2 == 0)
                first = int(starts[0]) if len(starts) else len(values)
                if first:
                    held.append(values.slice(0, first))
                if len(starts) or turn % 2 == 0:
                    yield from ended(rec)
                    rec = None
                last = int(starts[-1]) if len(starts) and turn % 2 else len(values)
                if not borders and first < last:
                    ends = np.append(starts[starts < last], last) - first
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.slice(first, last - first))
                    yield from given(pc.binary_join(lists, "\n"))
                if last < len(values):
                    held.append(values.slice(last))
        yield from ended((turn + 1) // 2)

    return run


def quoted_records(lines: DataFrame) -> DataFrame:
    """(value): whole records from the lines of delimited text, where quoted cells may hold line breaks.

    A line break ends a record when the quotes before it in the file are even in number, so
    lines with an odd number of quotes open and close records in turn.  One small pass counts
    them in every file split; a running sum over a file's splits gives the state in which each
    split begins.  With it every split puts its lines together where they are read.  Only the
    pieces of records that cross a border between splits are shuffled, two a border.  A quote
    that is never closed holds the rest of its file, as in a whole-file read.

    ``lines`` has value, file, block and row, as a text scan numbers and orders them.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = (quotes % 2 == 1).cast("long")
    out = lambda df: df.select(F.regexp_replace("value", r"\r$", "").alias("value"))
    counts = materialize(lines.groupBy("file", "block").agg(F.sum(odd).alias("k")), "splits")
    if counts.where("k > 0").isEmpty():
        return out(lines)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(counts.withColumn("opened", F.coalesce(F.sum("k").over(earlier), F.lit(0)))
                         .withColumn("split", F.monotonically_increasing_id()), "splits")
    # a row a split, broadcast: the lines keep their order
    ordered = lambda some: lines.join(F.broadcast(some), ["file", "block"]).select("split", "opened", "value")
    whole = ordered(splits).mapInArrow(_records_of_splits(False), "value string")
    crossed = splits.where("opened % 2 = 1 OR (opened + k) % 2 = 1")
    if crossed.isEmpty():
        return out(whole)
    pieces = ordered(crossed).mapInArrow(_records_of_splits(True), "split bigint, rec bigint, value string").join(splits, "split")
    parts = pieces.groupBy("file", "rec").agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("l"))
    joined = parts.select(F.array_join(F.transform("l", lambda v: v["value"]), "\n").alias("value"))
    return out(whole.unionByName(joined))


def read_sheet(spark: SparkSession, path: str, skip: int, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Headerless sheet export; drop the first ``skip`` lines of every file.

    The rest is put together into records (quoted cells may hold line breaks) and
    parsed with ``from_csv`` on the executors.
    """
    body = _without_first(_numbered_lines(spark, path), skip)
    schema = ", ".join(f"`{n}` STRING" for n in names)
    options = {"sep": sep, "nullValue": "NA", "escape": '"'}
    parsed = quoted_records(body).select(F.from_csv("value", schema, options).alias("__row"))
    return _na_to_null(parsed.select("__row.*"))


def load_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The geographic dimension (parquet)."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "csv", sep: str = ",") -> str:
    """Write with a header, NULL as ``NA`` and ISO dates (csv), or as parquet."""
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        (df.write.mode("overwrite").option("header", True).option("sep", sep)
           .option("nullValue", "NA").option("dateFormat", "yyyy-MM-dd").csv(path))
    return path


def write_with_preamble(df: DataFrame, path: str, preamble: Sequence[str], sep: str = ",") -> str:
    """Write ``df`` as headerless delimited text, each file starting with ``preamble`` lines.

    This is how a spreadsheet export looks; used to exercise ``read_sheet``.
    """
    cols = df.columns
    quoted = [F.when(F.col(c).isNull(), F.lit("NA"))
               .otherwise(F.concat(F.lit('"'), F.regexp_replace(F.col(c), '"', '""'), F.lit('"'))) for c in cols]
    lines = df.select(F.concat_ws(sep, *quoted).alias("value"))
    head = list(preamble)

    def with_head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": head})
        yield from batches

    lines.mapInPandas(with_head, "value string").write.mode("overwrite").text(path)
    return path
