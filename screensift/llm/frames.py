"""Small helpers shared by the pipeline operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screensift.session import scratch_path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can reach, keeps size statistics
    for later joins, and makes several readers share one computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def packed(df: DataFrame, **extra: Column) -> DataFrame:
    """One struct column ``row`` with the input row, plus the operator's own columns.

    Own column names can then never clash with a column of the input.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in extra.items()])


def unpacked(df: DataFrame, **extra: Column) -> DataFrame:
    """The input row again, plus columns of the operator; these take the place of input columns of their name."""
    taken = {n.lower() for n in extra}
    own = [F.col(f"row.`{f.name}`") for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*own, *[c.alias(n) for n, c in extra.items()])


def text_of(name: str = "text") -> Column:
    """The text column, NULL read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def chunks(batches: Iterable[pa.RecordBatch], text: str, max_chars: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slice Arrow batches so that a slice holds about ``max_chars`` bytes of ``text`` (one row at least)."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text))).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and size + (n or 0) > max_chars:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
