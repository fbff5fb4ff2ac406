"""Prefix trie of conversations, with totals of every subtree by time-forward processing.

A turn is hashed to 128 bits where it lies; texts are not shuffled. A prefix is named by its depth and the exclusive or of
its turns' hashes, each salted with its place, so the prefixes of one conversation can be taken in pieces: a conversation
that holds most of the turns is sorted by many tasks.

Totals go from the leaves up. Nodes are sorted in reverse level order (deepest first, then by name). Each adds the messages
its children sent to its own values and sends the sum on to its parent, through a priority queue in the same order that writes
sorted runs to the shared folder when it grows beyond its share of memory. Nodes of more than ``crowd`` members form the top
of the trie. What hangs below them falls apart into subtrees of few members, the shards, which are hashed to tasks and
worked off in parallel; the messages of shard roots are added up by parent and a second pass goes over the top alone. ``crowd`` grows
with the input, so that the top has at most ``TOP`` nodes. Below a node of one member there is a chain without branches: its totals
are known, and it sends its message without waiting in a queue.

Defined results: a null role or text is empty; turns of one number are ordered by role, then by a hash of the text; a null turn
comes first; a null conversation id is a conversation, smaller than all others and an empty string in digests; repeated rows are turns
like others; an empty table has no node; other columns are not read. Two different prefixes are taken for one with a probability
of 2^-128.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.llm import files
from quotegrid.llm.common import width
from quotegrid.session import materialize, scratch_path, small_side

CROWD = 4096  # members; nodes of more belong to the top
TOP = 1 << 20  # nodes of the top
QUEUE = 1 << 17  # messages a queue holds in memory
IDS = 1024  # conversation ids that are packed to one string

_MESSAGE = struct.Struct("<qqqqqq")  # level, two halves of the name, children, leaves, saved


class SpillingQueue:
    """Messages to nodes in reverse level order; beyond ``most`` of them a sorted run is written to ``folder``."""

    def __init__(self, folder: str, most: int = QUEUE):
        self.folder, self.most = folder, most
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # the first message of each run, and the rest of it
        self.written: list[str] = []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        system, folder = files.open_folder(self.folder)
        system.create_dir(folder, recursive=True)
        path = files.join(folder, uuid.uuid4().hex)
        with system.open_output_stream(path) as out:
            for message in sorted(self.heap):
                out.write(_MESSAGE.pack(*message))
        self.written.append(path)
        self.heap = []
        run = self._read(system, path)
        heapq.heappush(self.runs, (next(run), len(self.written), run))

    @staticmethod
    def _read(system, path: str) -> Iterator[tuple]:
        with system.open_input_stream(path, buffer_size=1 << 16) as f:
            while block := f.read(_MESSAGE.size * 1024):
                yield from _MESSAGE.iter_unpack(block)

    def take(self, node: tuple[int, int, int]) -> tuple[int, int, int]:
        """Adds up the messages to ``node`` and takes them away. Nodes have to be asked for in order."""
        children = leaves = saved = 0
        while True:
            of_run = bool(self.runs) and (not self.heap or self.runs[0][0] < self.heap[0])
            if not of_run and not self.heap:
                break
            first = self.runs[0][0] if of_run else self.heap[0]
            if first[:3] > node:
                break
            if first[:3] < node:
                raise ValueError("a message went to a node that is not in this shard")
            children, leaves, saved = children + first[3], leaves + first[4], saved + first[5]
            if not of_run:
                heapq.heappop(self.heap)
            elif following := next(self.runs[0][2], None):
                heapq.heapreplace(self.runs, (following, *self.runs[0][1:]))
            else:
                heapq.heappop(self.runs)
        return children, leaves, saved

    def close(self) -> None:
        system, _ = files.open_folder(self.folder)
        for path in self.written:
            system.delete_file(path)


# -- turns and prefixes


def turn_table(said: DataFrame) -> DataFrame:
    """conv_id, turn, role, ha, hb (hashes of role and text) and chars of each row."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    ha = F.xxhash64(F.lit(1), role, F.lit(2), text)
    hb = F.xxhash64(F.lit("b"), text, F.lit(3), role, F.length(text))
    return said.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        ha.alias("ha"),
        hb.alias("hb"),
        F.length(text).cast("long").alias("chars"),
    )


def _pieces(rows: DataFrame, *order: str) -> DataFrame:
    """The rows dealt out by ranges of their order, with ``piece``: also one conversation's rows go to many tasks."""
    dealt = rows.repartitionByRange(width(rows.sparkSession), "conv_id", *order)
    return materialize(dealt.withColumn("piece", F.spark_partition_id()), "turns")


def _before(parts: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """``parts`` (a row per conversation and piece) with the sums over earlier pieces of the conversation."""
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("conv_id", "piece", *[f(earlier).alias(c) for c, f in sums.items()])


def _met(rows: DataFrame, side: DataFrame, *on: str) -> DataFrame:
    """Inner join on columns that may be null."""
    names = {c: f"_{c}" for c in on}
    condition = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return rows.join(side.withColumnsRenamed(names), condition).drop(*names.values())


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``turns`` with ``pos``, from 0 on in their conversation, and ``piece``."""
    rows = _pieces(turns, "turn", "role", "ha", "hb")
    counts = rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    ahead = _before(counts, {"ahead": lambda w: F.coalesce(F.sum("n").over(w), F.lit(0))})
    here = Window.partitionBy("conv_id", "piece").orderBy("turn", "role", "ha", "hb")
    at = rows.withColumn("k", F.row_number().over(here) - 1)
    both = _met(at, ahead, "conv_id", "piece")
    return both.select("conv_id", "piece", (F.col("ahead") + F.col("k")).alias("pos"), "ha", "hb", "chars")


def own_turns(turns: DataFrame) -> DataFrame:
    """conv_id, depth (from 1 on), ha, hb, chars of each turn, and a row of depth 0 for each conversation."""
    turns = materialize(numbered_turns(turns).drop("piece"), "numbered")
    return _with_tops(turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "ha", "hb", "chars"), turns)


def _with_tops(rows: DataFrame, turns: DataFrame) -> DataFrame:
    """A row of depth 0 for each conversation, also for those without a turn."""
    tops = turns.select("conv_id").distinct()
    return rows.unionByName(tops.select("conv_id", *[_long(0).alias(c) for c in ("depth", "ha", "hb", "chars")]))


def rebuilt_turns(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """As ``own_turns``, but each conversation c opens with the first h turns of conversation c - c % every.

    Here h is crc32 of the id as text modulo ``most``; c's own turns follow after its first h. At most ``every`` conversations
    share an opening, and it has fewer than ``most`` turns.
    """
    turns = materialize(numbered_turns(turns).drop("piece"), "numbered")
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % most, F.lit(0)).cast("long")
    convs = turns.select("conv_id").distinct().select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    openings = turns.where((F.col("pos") < most) & (F.col("conv_id") % every == 0))
    lent = F.least(F.count("*"), F.lit(most)).alias("lent")
    lent = openings.groupBy(F.col("conv_id").alias("base")).agg(lent)
    plan = convs.join(lent, "base", "left")
    plan = materialize(plan.select("conv_id", "h", "base", F.least("h", F.coalesce("lent", F.lit(0))).alias("lent")), "plan")
    opening = openings.select(F.col("conv_id").alias("base"), "pos", "ha", "hb", "chars")
    opening = plan.where("lent > 0").join(opening, "base").where("pos < lent")
    opening = opening.select("conv_id", (F.col("pos") + 1).alias("depth"), "ha", "hb", "chars")
    rest = _met(turns, plan.select("conv_id", "h", "lent"), "conv_id").where("pos >= h")
    rest = rest.select("conv_id", (F.col("lent") + F.col("pos") - F.col("h") + 1).alias("depth"), "ha", "hb", "chars")
    return _with_tops(opening.unionByName(rest), turns)


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, a, b (name of the prefix), pa, pb (of the one before it), chars."""
    salted = rows.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.xxhash64(F.col("depth"), F.col("ha"), F.col("hb"))).otherwise(0).alias("za"),
        F.when(F.col("depth") > 0, F.xxhash64(F.col("hb"), F.lit("z"), F.col("ha"), F.col("depth"))).otherwise(0).alias("zb"),
        "chars",
    )
    cut = _pieces(salted, "depth")
    parts = cut.groupBy("conv_id", "piece").agg(F.bit_xor("za").alias("xa"), F.bit_xor("zb").alias("xb"))
    none = F.lit(0).cast("long")
    sums = {c: (lambda w, c=c: F.coalesce(F.bit_xor(c).over(w), none)) for c in ("xa", "xb")}
    here = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = cut.withColumns({"ra": F.bit_xor("za").over(here), "rb": F.bit_xor("zb").over(here)})
    both = _met(run, _before(parts, sums), "conv_id", "piece")
    a, b = F.col("xa").bitwiseXOR(F.col("ra")), F.col("xb").bitwiseXOR(F.col("rb"))
    return both.select(
        "conv_id",
        "depth",
        a.alias("a"),
        b.alias("b"),
        a.bitwiseXOR(F.col("za")).alias("pa"),
        b.bitwiseXOR(F.col("zb")).alias("pb"),
        "chars",
    )


# -- nodes


def node_table(found: DataFrame) -> DataFrame:
    """A row per prefix: depth, a, b, pa, pb, chars, first (its smallest member, in a struct as it may be null), n_convs."""
    same = ("depth", "a", "b", "pa", "pb", "chars")
    return found.groupBy(*same).agg(F.min(F.struct("conv_id")).alias("first"), F.count("*").alias("n_convs"))


def _shards(nodes: DataFrame, found: DataFrame, crowd: int) -> DataFrame:
    """The nodes of 2 to ``crowd`` members with ``sa``, ``sb``: the name of their highest ancestor of the kind."""
    top = small_side(nodes.where(F.col("n_convs") > crowd).select("depth", "a", "b"))
    # of each conversation, how far down the top reaches
    deep = found.join(top, ["depth", "a", "b"], "left_semi").groupBy("conv_id").agg(F.max("depth").alias("deep"))
    low = nodes.where((F.col("n_convs") > 1) & (F.col("n_convs") <= crowd)).withColumn("conv_id", F.col("first.conv_id"))
    low = _left(low, deep, "conv_id").withColumn("s", F.coalesce("deep", F.lit(-1).cast("long")) + 1).drop("deep")
    roots = _left(found, deep, "conv_id").where(F.col("depth") == F.coalesce("deep", F.lit(-1).cast("long")) + 1)
    roots = roots.select("conv_id", F.col("a").alias("sa"), F.col("b").alias("sb"))
    return _met(low, roots, "conv_id").drop("conv_id")


def _left(rows: DataFrame, side: DataFrame, on: str) -> DataFrame:
    name = f"_{on}"
    side = side.withColumnRenamed(on, name)
    return rows.join(side, F.col(on).eqNullSafe(F.col(name)), "left").drop(name)


_TOTALS = "depth long, a long, b long, pa long, pb long, is_root boolean, n_children long, n_leaves long, saved_tokens long"
_ARROW = pa.schema(
    [(n, pa.bool_() if t == "boolean" else pa.int64()) for n, t in (c.split() for c in _TOTALS.split(", "))]
)


def _time_forward(folder: str, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Totals of the nodes of a partition, which come in reverse level order; a message row precedes the node it is for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(folder, most)
        try:
            for batch in batches:
                out = []
                columns = [c.to_pylist() for c in batch.columns]
                for depth, a, b, is_node, pa_, pb, own, is_root, children, leaves, saved in zip(*columns, strict=True):
                    if not is_node:
                        queue.push((-depth, a, b, children, leaves, saved))
                        continue
                    children, leaves, saved = queue.take((-depth, a, b))
                    leaves, saved = max(leaves, 1), saved + own
                    out.append((depth, a, b, pa_, pb, is_root, children, leaves, saved))
                    if not is_root:
                        queue.push((1 - depth, pa_, pb, 1, leaves, saved))
                cols = list(zip(*out, strict=True)) if out else [[]] * len(_ARROW)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW.types, strict=True)], schema=_ARROW)
        finally:
            queue.close()

    return run


_FLOW = ("depth", "a", "b", "is_node", "pa", "pb", "own", "is_root", "children", "leaves", "saved")
_KEY = ["depth", "a", "b"]


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _nodes_in_flow(nodes: DataFrame, is_root: Column, *more: str) -> DataFrame:
    own = ((F.col("n_convs") - 1) * F.col("chars")).alias("own")
    none = [_long(0).alias(c) for c in ("children", "leaves", "saved")]
    return nodes.select(*_KEY, F.lit(True).alias("is_node"), "pa", "pb", own, is_root.alias("is_root"), *none, *more)


def _messages_in_flow(sent: DataFrame) -> DataFrame:
    """Messages of ``depth``, ``pa``, ``pb``, children, leaves, saved, added up by the receiver at the depth above."""
    sums = [F.sum(c).alias(c) for c in ("children", "leaves", "saved")]
    to = sent.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(*sums)
    none = [_long(0).alias(c) for c in ("pa", "pb", "own")]
    return to.select(*_KEY, F.lit(False).alias("is_node"), *none, F.lit(False).alias("is_root"), "children", "leaves", "saved")


def subtree_totals(nodes: DataFrame, found: DataFrame, crowd: int, most: int = QUEUE) -> DataFrame:
    """n_children, n_leaves and saved_tokens of every node, by ``depth``, ``a``, ``b``.

    ``nodes`` and ``found`` have to be written tables, as they are read several times.
    """
    spark = nodes.sparkSession
    run = _time_forward(scratch_path(spark, "queues"), most)
    order = (F.col("depth").desc(), "a", "b", "is_node")
    # chains of one member: the topmost node tells its parent all there is to know
    single, shared = nodes.where("n_convs = 1"), nodes.where("n_convs > 1")
    parents = shared.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"))
    heads = single.join(parents, ["depth", "pa", "pb"], "left_semi")
    heads = heads.select("depth", "pa", "pb", _long(1).alias("children"), _long(1).alias("leaves"), _long(0).alias("saved"))
    heads = materialize(_messages_in_flow(heads), "heads")
    low = materialize(_shards(nodes, found, crowd), "shards")
    is_root = F.col("depth") == F.col("s")
    mail = heads.join(low.select(*_KEY, "sa", "sb"), _KEY).select(*_FLOW, "sa", "sb")
    flow = _nodes_in_flow(low, is_root, "sa", "sb").unionByName(mail)
    dealt = flow.repartition(width(spark), "sa", "sb").sortWithinPartitions(*order)
    below = materialize(dealt.select(*_FLOW).mapInArrow(run, _TOTALS), "totals")
    # the top: few nodes, and two messages at most for each of them
    top = nodes.where(F.col("n_convs") > crowd)
    sums = [_long(1).alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")]
    to_top = _messages_in_flow(below.where("is_root and depth > 0").select("depth", "pa", "pb", *sums))
    to_top = to_top.unionByName(heads.join(top.select(*_KEY), _KEY, "left_semi").select(*_FLOW))
    flow = _nodes_in_flow(top, F.col("depth") == 0).unionByName(to_top)
    above = flow.repartition(1).sortWithinPartitions(*order).mapInArrow(run, _TOTALS)
    # a node of a chain has a child unless its conversation ends there
    followed = single.select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    followed = followed.distinct().withColumn("n_children", _long(1))
    chain = single.select(*_KEY).join(followed, _KEY, "left")
    chain = chain.select(*_KEY, F.coalesce("n_children", _long(0)).alias("n_children"), _long(1).alias("n_leaves"), _long(0).alias("saved_tokens"))
    wanted = (*_KEY, "n_children", "n_leaves", "saved_tokens")
    return below.select(*wanted).unionByName(above.select(*wanted)).unionByName(chain)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node, joined by commas; pieces of a node come one after the other."""
    now, sha = None, None
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
    as_batch = lambda rows: pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
    for batch in batches:
        rows = []
        for *node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node == now:
                sha.update(b",")
            else:
                if sha:
                    rows.append((*now, sha.hexdigest()))
                now, sha = node, hashlib.sha256()
            sha.update(text.encode())
        yield as_batch(rows)
    yield as_batch([(*now, sha.hexdigest())] if sha else [])


def end_digests(found: DataFrame) -> DataFrame:
    """ends_sha256 of the nodes where a conversation ends.

    A digest needs its node's conversations in order, in one task; they come as strings of up to ``IDS`` ids, made by many.
    """
    spark = found.sparkSession
    ends = found.groupBy("conv_id").agg(F.max(F.struct(*_KEY)).alias("end")).select("conv_id", "end.*")
    dealt = ends.repartitionByRange(width(spark), *_KEY, "conv_id")
    dealt = materialize(dealt.withColumn("piece", F.spark_partition_id()), "ends")
    here = Window.partitionBy("piece", *_KEY).orderBy("conv_id")
    dealt = dealt.withColumn("k", F.floor((F.row_number().over(here) - 1) / IDS))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("conv_id"))), lambda x: F.coalesce(x["conv_id"].cast("string"), F.lit("")))
    packed = dealt.groupBy("piece", *_KEY, "k").agg(F.array_join(ids, ",").alias("text"))
    in_order = packed.repartition(width(spark), *_KEY).sortWithinPartitions(*_KEY, "piece", "k")
    return in_order.select(*_KEY, "text").mapInArrow(_digests, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, crowd: int | None = None, most: int = QUEUE) -> DataFrame:
    """The trie's nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` are conv_id, depth, ha, hb, chars as ``own_turns`` and ``rebuilt_turns`` give them. A node is named by its smallest member
    and its depth. saved_tokens counts, over the subtree, the code points that are said again: each node's last text
    once for every member but one.
    """
    found = materialize(prefixes(turns), "prefixes")
    crowd = crowd or max(CROWD, -(-found.count() // TOP))
    nodes = materialize(node_table(found), "nodes")
    totals = subtree_totals(nodes, found, crowd, most)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("first").alias("parent"))
    named = nodes.join(parents, ["depth", "pa", "pb"], "left")
    empty = hashlib.sha256().hexdigest()
    rows = named.join(totals, _KEY).join(end_digests(found), _KEY, "left")
    return rows.select(
        F.col("first.conv_id").alias("conv_id"),
        "depth",
        F.col("parent.conv_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
