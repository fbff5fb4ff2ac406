"""A bit set of hashed values that thins out rows before a shuffle. It lets some others through, and never loses one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import packed
from quotegrid.session import materialize

PAGE = 1024  # words of 64 bits
LEAST, MOST = 1 << 16, 1 << 26  # bits: 8 KB to 8 MB, whatever the number of values


def bit_filter(values: DataFrame, *columns: str) -> Callable[..., Column]:
    """A test that is true for every row whose columns are among ``values``, and for few others."""
    n = values.count()
    bits = LEAST
    while bits < 8 * n and bits < MOST:
        bits *= 2
    place = lambda *c: F.pmod(F.xxhash64(*c), F.lit(bits))
    at = values.select(place(*columns).alias("p"))
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("b")
    )
    every = values.sparkSession.range(bits // 64).withColumnRenamed("id", "w")
    dense = every.join(words, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    in_order = lambda k: F.transform(F.array_sort(F.collect_list(F.struct(k, "b"))), lambda x: x["b"])
    pages = dense.groupBy(F.floor(F.col("w") / PAGE).alias("page")).agg(in_order("w").alias("b"))
    one = materialize(pages.groupBy().agg(in_order("page").alias("bits")), "bits").scalar()

    def test(*c) -> Column:
        p = place(*c)
        word = F.get(F.get(one, F.shiftright(p, 16).cast("int")), (F.shiftright(p, 6) % PAGE).cast("int"))
        return F.call_function("shiftright", word, (p % 64).cast("int")).bitwiseAND(1) == 1

    return test


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows of these ``doc_id``s; few of the rows that stay are shuffled."""
    ids = materialize(ids.select("doc_id").distinct(), "ids")
    hit = bit_filter(ids, "doc_id")(F.col("doc_id"))
    rows, unpack = packed(docs, "doc_id")
    of = ids.withColumnRenamed("doc_id", "gone")
    kept = rows.where(hit).join(of, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti")
    return unpack(rows.where(~hit).unionByName(kept))
