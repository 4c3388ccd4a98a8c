"""Rows of stored tables by their place, and removal of rows without moving the others.

A row of a Parquet table is named by its file and its place in it, which every read finds
again, whatever executor does it and however the files are cut into tasks. `with_row_key`
gives that as one long. `without_rows` removes rows by such keys: the keys are packed as
bitmaps (one of 4 KB for 32,768 rows of a file), and the table looks its rows up in them.
Only the bitmaps are sent around, so texts stay where they are read.

Bitmaps take a bit per row. They are broadcast in blocks of at most `BITMAPS` (32 MB, or
those of one file): a table that has more is read block by block, of each the files whose
bitmaps it holds. An empty table, no key and equal keys are allowed; null keys name no row.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.session import materialise

# Rows of one file fit into this many bits of a key, files into the rest.
_ROW_BITS = 40
# Bitmaps of one broadcast.
BITMAPS = 8192
_BITMAP_ROWS = 8 * 4096


class Keyed(NamedTuple):
    """A stored table, the same with a key of each row, that column's name, and its files:
    a key is the file's place in this list, followed by the row's place in the file."""

    source: DataFrame
    frame: DataFrame
    key: str
    files: list[str]


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of the frame has, in any case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def stored(df: DataFrame) -> DataFrame:
    """The frame itself if it is files as they are read, else a stored copy."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRelation" and df.inputFiles():
        return df
    return materialise(df, "rows")


def with_row_key(df: DataFrame, wanted: str = "_key") -> Keyed:
    """The table, stored if it is not, with a key of each row."""
    df = stored(df)
    # As many rows as there are files, which the driver lists to read the table at all.
    found = df.select(F.col("_metadata.file_path").alias("path")).distinct().collect()
    files = sorted(r.path for r in found)
    key = free_name(df, wanted)
    return Keyed(df, _keyed(df, key, files, 0), key, files)


def _keyed(df: DataFrame, key: str, files: list[str], first: int) -> DataFrame:
    path, base = free_name(df, "_path"), free_name(df, "_base")
    bases = df.sparkSession.createDataFrame(
        [(p, n << _ROW_BITS) for n, p in enumerate(files, first)], f"`{path}` string, `{base}` long"
    )
    every = [f"`{c}`" for c in df.columns]
    place = df.select(*every, F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(key))
    return place.join(F.broadcast(bases), path).select(*every, (F.col(key) + F.col(base)).alias(key))


def _file(key: str) -> Column:
    return F.shiftright(key, _ROW_BITS)


def _row(key: str) -> Column:
    return F.col(key).bitwiseAND((1 << _ROW_BITS) - 1)


def without_rows(keyed: Keyed, removed: DataFrame, bitmaps: int = BITMAPS) -> DataFrame:
    """The rows of the table, with its own columns, whose keys are not among `removed`."""
    source, frame, key, files = keyed
    file, chunk, bits = (free_name(frame, n) for n in ("_file", "_chunk", "_bits"))
    packed = materialise(
        removed.filter(F.col(key).isNotNull())
        .groupBy(_file(key).alias(file), F.floor(_row(key) / _BITMAP_ROWS).alias(chunk))
        .agg(F.bitmap_construct_agg(_row(key) % _BITMAP_ROWS).alias(bits)),
        "removed",
    )
    begins, held = [0], 0
    for row in packed.groupBy(file).count().orderBy(file).collect():
        if held and held + row["count"] > bitmaps:
            begins.append(row[file])
            held = 0
        held += row["count"]
    if len(begins) == 1:
        return _unmarked(frame, key, packed, (file, chunk, bits)).select(*[f"`{c}`" for c in source.columns])
    kept = []
    for low, high in zip(begins, [*begins[1:], len(files)], strict=True):
        some = files[low:high]
        rows = _keyed(source.filter(F.col("_metadata.file_path").isin(some)), key, some, low)
        maps = packed.filter((F.col(file) >= low) & (F.col(file) < high))
        kept.append(_unmarked(rows, key, maps, (file, chunk, bits)))
    return reduce(DataFrame.unionAll, kept).select(*[f"`{c}`" for c in source.columns])


def _unmarked(rows: DataFrame, key: str, maps: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    file, chunk, bits = names
    place = _row(key) % _BITMAP_ROWS
    byte = F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))
    marked = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1
    where = (_file(key) == F.col(file)) & (F.floor(_row(key) / _BITMAP_ROWS) == F.col(chunk))
    return rows.join(F.broadcast(maps), where, "left").filter(~F.coalesce(marked, F.lit(False)))
