"""Quoted text tables read by many tasks, however large one file is.

A quoted field may hold line breaks, so the state at a split (inside quotes or
not) depends on all bytes before it; Spark's own multi-line reader gives a file
to one task. Here lines are read in splits as plain text. A first pass reduces
each split to a function, the state at its end for either state at its start;
composing these over a file's splits is a prefix scan of one row a split. The
second pass then knows every split's state and puts its lines together to
records; a record over several splits travels as one piece a split.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Numbers of records within a split take so many bits of a record's position, the split's rank the bits above.
POSITION_BITS = 31


def ends_inside(line: str, inside: bool, sep: str = "\t") -> bool:
    """Whether a line ends inside quotes; quotes open at the start of a field, a doubled quote inside is one quote."""
    if '"' not in line:
        return inside
    i = 0
    while True:
        while inside:
            j = line.find('"', i)
            if j < 0:
                return True
            inside = line[j + 1:j + 2] == '"'  # a doubled quote: still inside
            i = j + 2 if inside else j + 1
            if not inside:
                t = line.find(sep, i)  # what follows a closing quote belongs to the field
                if t < 0:
                    return False
                i = t + 1
        if line[i:i + 1] == '"':
            inside, i = True, i + 1
            continue
        t = line.find(sep, i)
        if t < 0:
            return False
        i = t + 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def split_states(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """(file, block, inside, rank): the state at the start of every split, and the split's place among all."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, outside, inside = None, False, True
        for b in batches:
            for file, block, value in zip(*(c.to_pylist() for c in b.columns)):
                if (file, block) != now:
                    if now:
                        yield _split_row(now, outside, inside)
                    now, outside, inside = (file, block), False, True
                outside, inside = ends_inside(value, outside, sep), ends_inside(value, inside, sep)
        if now:
            yield _split_row(now, outside, inside)

    def scan(splits: pd.DataFrame) -> pd.DataFrame:
        splits, state, states = splits.sort_values("block"), False, []
        for row in splits.itertuples():
            states.append(state)
            state = bool(row.if_inside if state else row.if_outside)
        return pd.DataFrame({"file": splits["file"], "block": splits["block"], "inside": states})

    functions = lines.mapInArrow(reduce, "file string, block bigint, if_outside boolean, if_inside boolean")
    # one row a split, and a group is one file's splits
    states = functions.groupBy("file").applyInPandas(scan, "file string, block bigint, inside boolean")
    return states.withColumn("rank", F.row_number().over(Window.orderBy("file", "block")).cast("bigint") - 1)


def _split_row(split: tuple, outside: bool, inside: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([split[0]], pa.string()), pa.array([split[1]], pa.int64()), pa.array([outside]), pa.array([inside])],
                                      ["file", "block", "if_outside", "if_inside"])


def quoted_records(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(position, file, value): the records of all files under ``path`` as text, blank ones left out.

    ``position`` orders the records of the input and is the same in every run
    with the same splits.
    """
    lines = _lines(spark, path)
    states = split_states(lines, sep)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "position", "kind", "value"]
        now, inside, held, n, kind, out = None, False, [], 0, "whole", []

        def done(kind_: str) -> None:
            out.append((now[0], (now[2] << POSITION_BITS) + n, kind_, "\n".join(held)))

        for b in batches:
            for file, block, value, starts_inside, rank in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or (file, block) != now[:2]:
                    if now and held:
                        done("through" if kind == "head" else "tail")
                    now, inside, held, n, kind = (file, block, rank), starts_inside, [], 0, "head" if starts_inside else "whole"
                held.append(value)
                inside = ends_inside(value, inside, sep)
                if not inside:
                    done(kind)
                    held, n, kind = [], n + 1, "whole"
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string(), pa.string()))], names)
                out = []
        if now and held:
            done("through" if kind == "head" else "tail")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string(), pa.string()))], names)

    known = lines.join(F.broadcast(states), ["file", "block"])  # one row a split
    pieces = known.select("file", "block", "value", "inside", "rank").mapInArrow(put_together, "file string, position bigint, kind string, value string")
    # a record over several splits: its tail of the first, whole splits, and the head of the last; at most two pieces a split
    parts = pieces.where("kind <> 'whole'").withColumn(
        "record", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(Window.partitionBy("file").orderBy("position")))
    joined = parts.groupBy("file", "record").agg(F.min("position").alias("position"), F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "value"))), lambda p: p["value"]), "\n").alias("value"))
    records = pieces.where("kind = 'whole'").select("position", "file", "value").unionByName(joined.select("position", "file", "value"))
    return records.withColumn("value", F.regexp_replace("value", r"\r\z", "")).where("value <> ''")
