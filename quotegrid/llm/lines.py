"""Fuzzy line deduplication across documents, with DataFrame operations only.

Lines are normalised to their lower-cased words. A line's SimHash is taken over its pairs of neighbouring words (single words
would give all lines of a language nearly the same bits): 64 counters, eight in each of 8 sums, are added up while pairs stream by. Two lines within ``radius`` bits agree in two of five blocks
of the SimHash at least (pigeonhole), so each pair of blocks is a join key. Two lines that alone have a key are compared while
keys are counted. In a larger group of equal keys every line is compared
with the group's first one; those it does not match are compared with all of the group that is not connected to them by then,
so that thousands of copies make a star and not all pairs, and no link between groups is lost. Candidates within the radius and of fitting
lengths are verified by edit similarity of the normalised lines. Of each connected group of lines the first
occurrence stays: smallest document id, first place in it.

Texts are not shuffled to find the groups. Where lines have to be fetched for verification, and where documents are
rewritten, a bit set sends on only the documents concerned.

Defined results: lines of fewer than ``min_words`` words are no candidates and stay, blank ones too; a null text stays null;
rows that repeat a document (same id and text) are one document and are rewritten alike; a null id comes first;
a document may be left without a line (its text is then empty); other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.bitfilter import bit_filter
from quotegrid.llm.common import packed
from quotegrid.llm.components import connected_components, with_links
from quotegrid.session import materialize

BLOCKS = (13, 13, 13, 13, 12)  # bits
FEW = (6, 24, 96, 384)  # edits that are tried first, as far as the similarity allows them
AT_ONCE = 2  # pairs of words a row carries to the sums
SHORT = 126  # pairs of words whose counters have 8 bits, the sign bit unused; an even number
# ASCII characters that are no letters or digits, one by one: Java looks these up in a table and tries ranges one after the other
NO_WORD = "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum())


@dataclass(frozen=True)
class LineConfig:
    min_words: int = 5
    similarity: float = 0.8  # 1 - edits / characters of the longer line
    radius: int = 3  # differing bits of two SimHashes


def normal(line: Column) -> Column:
    """Lower case; one space for every run of ASCII characters that are no letters or digits."""
    return F.trim(F.regexp_replace(F.lower(line), f"[{NO_WORD}]+", " "))


def n_words(norm: Column) -> Column:
    return F.when(norm == "", 0).otherwise(F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _ones(lanes: int) -> int:
    """A bit at the foot of each of the lanes of a word."""
    return sum(1 << (64 // lanes * k) for k in range(lanes))


def _lane_sums(hashes: list[str], lanes: int) -> list[Column]:
    """64 / lanes sums over some columns of hashes; each lane of a sum counts one bit of them."""
    one = F.lit(_ones(lanes))
    bits = lambda i: reduce(lambda a, b: a + b, [F.shiftrightunsigned(h, i).bitwiseAND(one) for h in hashes])
    return [F.sum(bits(i)).alias(f"s{i}") for i in range(64 // lanes)]


def _widened(lanes: int) -> list[Column]:
    """The 64 / lanes sums of that many lanes that hold what eight sums of eight lanes hold."""
    mask = F.lit(255 * _ones(lanes))
    return [F.shiftrightunsigned(f"s{i % 8}", i - i % 8).bitwiseAND(mask) for i in range(64 // lanes)]


def _majority(n: Column, lanes: int, sums: list[Column]) -> Column:
    """The bits that are set in more than half of the n features, a lane of counters at a time.

    With ``top`` two bits below a lane's end, twice a count and 2^top - 1 - n reaches bit ``top`` if, and only if, it is more than n.
    """
    top, one = 64 // lanes - 2, F.lit(_ones(lanes))
    reach = (F.lit((1 << top) - 1) - n) * one
    every = [F.shiftrightunsigned(2 * x + reach, top).bitwiseAND(one) for x in sums]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(x, i) for i, x in enumerate(every)])


def line_table(docs: DataFrame, cfg: LineConfig = LineConfig()) -> DataFrame:
    """doc_id, t (hash of the text), pos, h (hash of the normalised line), sim, chars of each line long enough.

    Counters have 8 bits for every ``SHORT`` pairs of words; those of longer lines are added up in counters of 30 bits.
    """
    # rows that repeat a document are kept apart: their counters must not be added up
    row = F.monotonically_increasing_id().alias("row")
    rows = docs.where("text is not null").select(row, "doc_id", F.xxhash64("text").alias("t"), "text")
    split = rows.select("row", "doc_id", "t", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    norm = split.select("row", "doc_id", "t", "pos", normal(F.col("line")).alias("norm"))
    # the line's own columns before its words are dealt out, or they would be computed for each word
    own = ("row", "doc_id", "t", "pos", "h", "chars")
    line = norm.select("row", "doc_id", "t", "pos", F.xxhash64("norm").alias("h"), F.length("norm").alias("chars"), F.split("norm", " ", -1).alias("words"))
    line = line.select(*own, "words", F.size("words").alias("n"))
    # short lines pass with one pair and go after the sums: a filter that reached this place would cut lines into words twice
    least = max(cfg.min_words, 2)
    last = F.when(F.col("n") >= least, F.col("n") - 2).otherwise(0)
    each = line.select(*own, "n", "words", F.explode(F.sequence(F.lit(0), last, F.lit(AT_ONCE))).alias("i"))
    word = [F.get("words", F.col("i") + k) for k in range(AT_ONCE + 1)]
    # behind the last pair stands 0, which counts nothing
    pairs = [F.when(b.isNotNull(), F.xxhash64(a, b)).otherwise(F.lit(0).cast("long")).alias(f"w{k}") for k, (a, b) in enumerate(zip(word, word[1:], strict=False))]
    sums = each.select(*own, "n", F.expr(f"i div {SHORT}").alias("part"), *pairs).groupBy(*own, "part")
    sums = sums.agg(F.max("n").alias("n"), *_lane_sums([f"w{k}" for k in range(AT_ONCE)], 8)).where(F.col("n") >= least)
    whole = F.col("n") - 1 <= SHORT
    sim = F.when(whole, _majority(F.col("n") - 1, 4, _widened(4))).alias("sim")
    parts = [F.when(~whole, F.col(f"s{i}")).alias(f"s{i}") for i in range(8)]
    every = materialize(sums.select(*own, "n", sim, *parts), "lines")
    columns = ("doc_id", "t", "pos", "h", "sim", "chars")
    short, long_ = every.where("sim is not null").select(*columns), every.where("sim is null")
    if long_.isEmpty():
        return short
    sums = long_.groupBy(*own).agg(F.max("n").alias("n"), *[F.sum(x).alias(f"w{i}") for i, x in enumerate(_widened(2))])
    long_ = sums.withColumn("sim", _majority(F.col("n") - 1, 2, [F.col(f"w{i}") for i in range(32)])).select(*columns)
    return short.unionByName(materialize(long_, "lines"))


def _keys() -> Column:
    """A join key for each pair of blocks."""
    masks, at = [], 0
    for size in BLOCKS:
        masks.append(((1 << size) - 1) << at)
        at += size
    return F.array(
        *[
            F.xxhash64(F.lit(k), F.col("sim").bitwiseAND(F.lit(_signed(a | b))))
            for k, (a, b) in enumerate(combinations(masks, 2))
        ]
    )


def _near(a: str, b: str, cfg: LineConfig) -> Column:
    """Within the radius, and of lengths that allow the similarity."""
    x, y = F.col(f"{a}.chars"), F.col(f"{b}.chars")
    return (F.bit_count(F.col(f"{a}.sim").bitwiseXOR(F.col(f"{b}.sim"))) <= cfg.radius) & (
        F.least(x, y) >= cfg.similarity * F.greatest(x, y)
    )


def _fetch(docs: DataFrame, occurrences: DataFrame, wanted: DataFrame) -> DataFrame:
    """``h`` and the normalised line of the wanted hashes, from one occurrence of each."""
    has = bit_filter(wanted, "h")
    found = occurrences.where(has(F.col("h"))).join(wanted, "h", "left_semi")
    one = found.groupBy("h").agg(F.min(F.struct("doc_id", "t", "pos")).alias("o")).select("h", "o.*")
    one = materialize(one, "wanted-lines")
    texts = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("t"), "text")
    texts = texts.where(bit_filter(one, "t")(F.col("t")))
    of = one.withColumnsRenamed({"doc_id": "_d", "t": "_t"})
    met = texts.join(of, (F.col("t") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    line = F.get(F.split("text", "\n", -1), F.col("pos"))
    return materialize(met.select("h", normal(line).alias("line")).distinct(), "lines")


def _word_edits(x: str, y: str) -> Column:
    """No fewer edits than turn x into y: each word for the word in its place. Null if the lines differ in their number of words."""
    a, b = F.split(x, " ", -1), F.split(y, " ", -1)
    each = F.zip_with(a, b, lambda v, w: F.when(v == w, 0).otherwise(F.greatest(F.length(v), F.length(w))))
    return F.when(F.size(a) == F.size(b), F.aggregate(each, F.lit(0), lambda n, e: n + e))


def _verified(pairs: DataFrame, lines: DataFrame, cfg: LineConfig) -> DataFrame:
    """The pairs a, b whose edit similarity is high enough."""
    both = pairs.join(lines.select(F.col("h").alias("a"), F.col("line").alias("x")), "a")
    both = both.join(lines.select(F.col("h").alias("b"), F.col("line").alias("y")), "b")
    most = F.greatest(F.length("x"), F.length("y"))
    # as many edits as the similarity allows; -1 stands for more. Copies have few, and few are found fast
    allowed = F.floor((1 - F.lit(cfg.similarity)) * most + 1e-9).cast("int")
    within = lambda n: F.call_function("levenshtein", F.col("x"), F.col("y"), n) >= 0
    # most near copies differ in a few words and need no edit distance
    found = (F.coalesce(_word_edits("x", "y"), allowed + 1) <= allowed) | within(F.least(allowed, F.lit(FEW[0])))
    for few, more in zip(FEW, (*(F.least(allowed, F.lit(n)) for n in FEW[1:]), allowed), strict=True):
        found = found | ((allowed > few) & within(more))
    return both.where(found).select("a", "b")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    side = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def unique_lines(occurrences: DataFrame) -> DataFrame:
    """h, sim, chars of the different normalised lines, and n, how often a line occurs."""
    unique = occurrences.groupBy("h").agg(F.max("sim").alias("sim"), F.max("chars").alias("chars"), F.count("*").alias("n"))
    return materialize(unique, "unique-lines")


def similar_lines(docs: DataFrame, occurrences: DataFrame, unique: DataFrame, cfg: LineConfig = LineConfig()) -> DataFrame:
    """``node`` and ``component`` of each normalised line, by its hash, that is similar to a different one."""
    keyed = unique.select("h", "sim", "chars", F.explode(_keys()).alias("key"))
    # two lines of a key are a pair at once, or far apart and none: what chance brings together is joined with nothing
    shared = keyed.groupBy("key").agg(
        F.min("h").alias("first"), F.count("*").alias("n"), F.bit_xor("h").alias("ends"), F.bit_xor("sim").alias("apart")
    )
    shared = materialize(shared.where((F.col("n") > 2) | (F.col("n") == 2) & (F.bit_count("apart") <= cfg.radius)), "shared-keys")
    two = shared.where("n = 2").select(F.col("first").alias("a"), F.col("first").bitwiseXOR(F.col("ends")).alias("b"))
    large = shared.where("n > 2").select("key", "first")
    members = materialize(keyed.where(bit_filter(large, "key")(F.col("key"))).join(large, "key"), "members")
    # every member with the first of its group
    others, heads = members.where("h <> first"), members.where("h = first").select("key", "sim", "chars")
    near = others.alias("x").join(heads.alias("y"), F.col("x.key") == F.col("y.key")).where(_near("x", "y", cfg))
    near = near.select(F.col("x.first").alias("a"), F.col("x.h").alias("b"))
    near = materialize(near.unionByName(two).distinct(), "near")
    lines = _fetch(docs, occurrences, near.select(F.explode(F.array("a", "b")).alias("h")).distinct())
    # one first line for each line, then the others as far as they would connect more
    one = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    linked = materialize(_verified(one, lines, cfg), "linked")
    found = materialize(connected_components(linked), "groups")
    more = materialize(_verified(_apart(near.join(one, ["a", "b"], "left_anti"), found), lines, cfg), "linked")
    if not more.isEmpty():
        linked, found = linked.unionByName(more), materialize(with_links(found, more), "groups")
    # the others with the rest of their group, as far as the stars have not connected them already
    groups = found.withColumnRenamed("node", "h")
    large = others.join(groups, "h", "left").withColumn("group", F.coalesce("component", "h"))
    large = materialize(large.select("key", "first", "h", "sim", "chars", "group"), "members")
    tied = linked.select(F.col("a").alias("first"), F.col("b").alias("h"))
    loose = large.join(tied, ["first", "h"], "left_anti").alias("x")
    rest = loose.join(large.alias("y"), F.col("x.key") == F.col("y.key"))
    rest = rest.where((F.col("x.group") != F.col("y.group")) & _near("x", "y", cfg))
    pairs = rest.select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b")).distinct()
    pairs = materialize(pairs, "near")
    if pairs.isEmpty():
        return found
    missing = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct().join(lines, "h", "left_anti")
    missing = materialize(missing, "missing")
    if not missing.isEmpty():
        lines = lines.unionByName(_fetch(docs, occurrences, missing))
    return materialize(with_links(found, _verified(pairs, lines, cfg)), "groups")


def dropped_lines(docs: DataFrame, cfg: LineConfig = LineConfig()) -> DataFrame:
    """doc_id, t, pos of every line that is not the first of its group."""
    found = line_table(docs, cfg)
    unique = unique_lines(found)
    groups = similar_lines(docs, found, unique, cfg).withColumnRenamed("node", "h")
    # only lines that repeat, or have a similar one
    alone = unique.where("n > 1").select("h", F.col("h").alias("group")).join(groups, "h", "left_anti")
    of = materialize(alone.unionByName(groups.select("h", F.col("component").alias("group"))), "groups")
    repeated = found.where(bit_filter(of, "h")(F.col("h"))).join(of, "h").select("doc_id", "t", "pos", "group")
    repeated = materialize(repeated, "repeated")
    first = repeated.groupBy("group").agg(F.min(F.struct("doc_id", "t", "pos")).alias("first"))
    first = materialize(first, "first")  # apart from the join, which can then split a large group
    here = F.struct("doc_id", "t", "pos")
    return repeated.join(first, "group").where(~here.eqNullSafe(F.col("first"))).select("doc_id", "t", "pos")


def _marks(dropped: DataFrame) -> DataFrame:
    """``_d``, ``_t`` and a bit for each dropped line of a document, 64 to a word."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % 64).cast("int"))
    words = dropped.groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_t"), F.shiftright("pos", 6).alias("w"))
    listed = words.agg(F.bit_or(bit).alias("b")).groupBy("_d", "_t").agg(
        F.collect_list(F.struct("w", "b")).alias("words"), F.max("w").alias("most")
    )
    at = F.map_from_entries("words")
    every = F.transform(F.sequence(F.lit(0), "most"), lambda i: F.coalesce(F.element_at(at, i), F.lit(0).cast("long")))
    return materialize(listed.select("_d", "_t", every.alias("_gone")), "drops")


def dedup_lines(docs: DataFrame, cfg: LineConfig = LineConfig(), counts: bool = False) -> DataFrame:
    """``docs`` with the texts rewritten; with ``counts`` also ``n_lines`` (before) and ``n_removed``."""
    marks = _marks(dropped_lines(docs, cfg))
    rows, unpack = packed(docs, "doc_id", "text")
    lines = F.split("text", "\n", -1)
    before = F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0))
    hash_ = F.xxhash64("text")
    hit = F.col("text").isNotNull() & F.coalesce(bit_filter(marks, "_t")(hash_), F.lit(False))
    met = rows.where(hit).withColumn("hash", hash_)
    met = met.join(marks, (F.col("hash") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")

    def stays(_, i):
        word = F.coalesce(F.get("_gone", F.shiftright(i, 6)), F.lit(0).cast("long"))
        return F.call_function("shiftright", word, i % 64).bitwiseAND(1) == 0

    kept = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    removed = F.coalesce(F.aggregate("_gone", F.lit(0), lambda n, w: n + F.bit_count(w)), F.lit(0))
    same = rows.where(~hit).select("doc_id", "text", "rest", before.alias("n_lines"), F.lit(0).alias("n_removed"))
    met = met.select("doc_id", kept.alias("text"), "rest", before.alias("n_lines"), removed.alias("n_removed"))
    return unpack(same.unionByName(met), *("n_lines", "n_removed") * counts)
