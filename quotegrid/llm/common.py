"""What several text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.session import ship_package

# Words are what stands between these characters: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, a null text as an empty one."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def packed(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The columns ``used`` and all others as one (``rest``), so that no name can clash; and the way back.

    The way back takes names of columns to put behind those of ``docs``.
    """
    others = [c for c in docs.columns if c not in used]
    rest = F.struct(*[docs[f"`{c}`"].alias(c) for c in others]) if others else F.lit(None).cast("int")

    def unpack(df: DataFrame, *more: str) -> DataFrame:
        return df.select(*[c if c in used else F.col("rest")[c].alias(c) for c in docs.columns], *more)

    return docs.select(*used, rest.alias("rest")), unpack


def held_out(doc_id: Column) -> Column:
    """Rows nothing is learnt from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_slices(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 1
        if batch.num_rows > start:
            yield batch.slice(start)
