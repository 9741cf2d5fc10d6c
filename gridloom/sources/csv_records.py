"""CSV records of files that are read in many pieces at once, also where quoted cells hold line breaks.

A line maps the state before it (outside or inside of quotes) to the state after it. Each piece of a
file reports the composition of its lines' maps, a prefix scan over the pieces gives the state at
which each begins, and then every piece cuts its own records. Only the records that cross
a border between pieces are put together by a shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.session import scratch_path

OUTSIDE, INSIDE, CLOSED = 0, 1, 2
#: Pieces of all files at most: their states are sent to the tasks, about 50 bytes for each. At 128 MB a piece that is 256 TB.
MAX_SENT_PIECES = 2_000_000
_RECORDS = "file long, start long, part int, header boolean, record string"
WHOLE, HEAD, TAIL, MIDDLE = range(4)


def state_after(line: Column, inside: bool) -> Column:
    """1 if the line ends inside of quotes, else 0, when it begins outside (a record begins) or inside of them.

    A quote opens only at the beginning of a cell; anywhere else outside of quotes it is data. Inside, two
    quotes are one, and a single one closes. The line is cut at its quotes and the pieces are folded.
    """
    pieces = F.split(line, '"')
    first = F.get(pieces, 0)
    start = F.struct(F.lit(INSIDE if inside else OUTSIDE).alias("state"), (F.lit("") if inside else F.concat(F.lit(","), first)).alias("before"))

    def step(acc: Column, piece: Column) -> Column:
        opens = acc["before"].endswith(",")
        state = (
            F.when(acc["state"] == INSIDE, F.lit(CLOSED))
            .when((acc["state"] == CLOSED) & (acc["before"] == ""), F.lit(INSIDE))
            .otherwise(F.when(opens, F.lit(INSIDE)).otherwise(F.lit(OUTSIDE)))
        )
        return F.struct(state.alias("state"), piece.alias("before"))

    folded = F.aggregate(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), start, step, lambda acc: (acc["state"] == INSIDE).cast("int"))
    return F.when(F.contains(line, F.lit('"')), folded).otherwise(F.lit(int(inside)))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, value``: lines without their line feed, in order within a piece; ``file`` is a hash of the path, ``start`` where the piece begins."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def has_open_lines(lines: DataFrame) -> bool:
    """Whether a record goes on in a second line; ends at the first one found."""
    return not lines.where(F.contains("value", F.lit('"'))).where(state_after(F.col("value"), False) == INSIDE).isEmpty()


def _runs(pdf: pd.DataFrame) -> Iterator[tuple[int, int, int, int]]:
    """``(file, start, first row, end)`` of the rows of one piece that stand together."""
    file, start = pdf["file"].to_numpy(), pdf["start"].to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(pdf)]):
        if b > a:
            yield int(file[a]), int(start[a]), int(a), int(b)


def _compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per piece: the states after it, from outside and from inside."""
    key, now = None, (0, 1)
    for pdf in batches:
        for file, start, a, b in _runs(pdf):
            if key != (file, start):
                if key is not None:
                    yield pd.DataFrame([(*key, *now)], columns=["file", "start", "from_outside", "from_inside"])
                key, now = (file, start), (0, 1)
            outside, inside = pdf["after_outside"].to_numpy()[a:b], pdf["after_inside"].to_numpy()[a:b]
            fixed = np.flatnonzero(outside == inside)
            last = fixed[-1] if len(fixed) else -1
            odd = int((outside[last + 1 :] > inside[last + 1 :]).sum()) & 1  # lines that swap the states
            now = (int(outside[last]) ^ odd,) * 2 if len(fixed) else (now[0] ^ odd, now[1] ^ odd)
    if key is not None:
        yield pd.DataFrame([(*key, *now)], columns=["file", "start", "from_outside", "from_inside"])


def piece_states(lines: DataFrame) -> DataFrame:
    """``file, start, inside, ends_inside`` (0/1) of every piece; a window over one row per piece of a file."""
    maps = lines.select("file", "start", state_after(F.col("value"), False).alias("after_outside"), state_after(F.col("value"), True).alias("after_inside"))
    pieces = maps.mapInPandas(_compose, "file long, start long, from_outside int, from_inside int")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum(F.when(F.col("from_outside") > F.col("from_inside"), 1).otherwise(0)).over(before), F.lit(0))
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.struct("from_outside", "swaps"))
    last = F.last(fixed, ignorenulls=True).over(before)
    known = pieces.withColumn("swaps", swaps).withColumn("last", last)
    since = F.col("swaps") - F.coalesce("last.swaps", F.lit(0))
    inside = (F.coalesce("last.from_outside", F.lit(OUTSIDE)) + since) % 2
    return known.select("file", "start", inside.cast("int").alias("inside"), F.when(inside == 1, F.col("from_inside")).otherwise(F.col("from_outside")).alias("ends_inside"))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records of each piece, ``WHOLE`` or, at its borders, ``HEAD``, ``TAIL`` or ``MIDDLE`` parts of one."""
    key, state, open_lines, part, header = None, OUTSIDE, [], WHOLE, False
    out: list[tuple] = []

    def close(lines: list[str], kind: int) -> None:
        text = "\n".join(lines)
        out.append((*key, kind, header, text.removesuffix("\r") if kind in (WHOLE, HEAD) else text))

    for pdf in batches:
        values, outside, inside, begins = (pdf[name].to_numpy() for name in ("value", "after_outside", "after_inside", "inside"))
        for file, start, a, b in _runs(pdf):
            if key != (file, start):
                if open_lines:
                    close(open_lines, MIDDLE if part == HEAD else TAIL)
                key, state, open_lines = (file, start), int(begins[a]), []
                part, header = HEAD if state == INSIDE else WHOLE, start == 0
            for i in range(a, b):
                open_lines.append(values[i])
                state = inside[i] if state else outside[i]
                if not state:
                    close(open_lines, part)
                    open_lines, part, header = [], WHOLE, False
        if out:
            yield pd.DataFrame(out, columns=["file", "start", "part", "header", "record"])
            out.clear()
    if open_lines:
        close(open_lines, MIDDLE if part == HEAD else TAIL)
        yield pd.DataFrame(out, columns=["file", "start", "part", "header", "record"])


def csv_records(lines: DataFrame, max_sent: int = MAX_SENT_PIECES) -> DataFrame:
    """``header, record``: one text per record, its line breaks kept; ``header`` marks the first record of each file.

    A quote that never closes makes the rest of its file one record, as there is no later end.
    """
    spark = lines.sparkSession
    path = scratch_path(spark, "csv-pieces")
    piece_states(lines).write.parquet(path)
    states = spark.read.parquet(path)
    if states.count() > max_sent:  # a shuffle join would lose the order of the lines
        raise ValueError(f"more than {max_sent} pieces of text; raise spark.sql.files.maxPartitionBytes")
    # a piece that the first scan did not see would be read from a wrong state
    begins = F.coalesce("inside", F.raise_error(F.lit("the files were split in another way between two scans")).cast("int"))
    rows = lines.join(F.broadcast(states), ["file", "start"], "left").select(
        "file", "start", begins.alias("inside"), F.coalesce("ends_inside", F.lit(0)).alias("ends_inside"), "value",
        state_after(F.col("value"), False).alias("after_outside"), state_after(F.col("value"), True).alias("after_inside"),
    )
    columns = ["file", "start", "inside", "value", "after_outside", "after_inside"]
    border = rows.where((F.col("inside") == INSIDE) | (F.col("ends_inside") == INSIDE)).select(*columns).mapInPandas(_cut, _RECORDS)
    parts = scratch_path(spark, "csv-parts")
    border.where(F.col("part") != WHOLE).write.parquet(parts)
    pieces = spark.read.parquet(parts)
    owner = F.last(F.when(F.col("part") == TAIL, F.col("start")), ignorenulls=True).over(Window.partitionBy("file").orderBy("start", "part"))
    joined = (
        pieces.withColumn("owner", owner)
        .groupBy("file", "owner")
        .agg(F.max("header").alias("header"), F.sort_array(F.collect_list(F.struct("start", "part", "record"))).alias("parts"))
        .select("header", F.array_join(F.col("parts.record"), "\n").alias("record"))
    )
    whole = rows.select(*columns).mapInPandas(_cut, _RECORDS).where(F.col("part") == WHOLE).select("header", "record")
    return whole.unionByName(joined)


def read_csv_records(spark: SparkSession, path: str, lines: DataFrame) -> DataFrame:
    """The table of text columns of files with line breaks in quotes; names come from the first record of the first file."""
    names = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    records = csv_records(lines).where(~F.col("header") & (F.trim("record") != ""))
    return records.select(F.from_csv("record", schema, {"escape": '"'}).alias("r")).select("r.*")


# Tasks get the code by value: executors need pandas and numpy, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
