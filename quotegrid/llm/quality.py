"""Quality rules whose cutoffs keep the risk of a false rejection within bounds, with DataFrame operations only.

Every rule rejects a document on one side of a cutoff. For each stratum (language), rule and cutoff the
labelled good documents it would reject are counted, and the exact binomial test says whether the
false rejection rate is below the limit: P(Bin(n, limit) <= rejected) must not exceed the error level,
divided by the number of tests (strata x cutoffs of all rules). A rule shares the limit with the other rules, so that
a stratum's false rejection rate is within the whole limit, all at once with the given confidence. Of the cutoffs
that pass, the one that rejects most bad documents, less the good ones, is taken; ties go to the more lenient.
A stratum with too few labels has no cutoffs, and nothing is rejected there.

Base figures are computed over each whole text, in the row: five-word windows are hashed, and
only texts with a repeated one are looked at further. Labels meet narrow rows of figures, not texts.

Defined results: a null or blank text has no words (and fails the base rule); a null stratum is one of its
own; several labels of one document count as good if one of them does; a null label is none;
labels without a document say nothing; repeated rows give repeated rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import BLANK
from quotegrid.session import materialize

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Rejects where ``over / under`` is above (sign 1) or below (sign -1) a cutoff."""

    name: str
    over: str
    under: str
    sign: int
    cutoffs: tuple[float, ...]  # strict to lenient


RULES = (
    Rule("symbols", "n_symbols", "n_words", 1, (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0)),
    Rule("long_words", "word_chars", "n_words", 1, (5.5, 6.0, 6.5, 7.0, 8.0, 10.0, 12.0)),
    Rule("short_words", "word_chars", "n_words", -1, (4.0, 3.5, 3.0, 2.5, 2.0)),
    Rule("dup_lines", "n_dup_lines", "n_lines", 1, (0.1, 0.2, 0.3, 0.5)),
    Rule("repeats", "n_repeat_words", "n_words", 1, (0.05, 0.1, 0.15)),
)


@dataclass(frozen=True)
class RiskConfig:
    limit: float = 0.05  # false rejections among good documents of a stratum, all rules together
    error: float = 0.05  # chance that any of the statements is wrong


def text_figures(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text"))
    bare = F.btrim("_text", F.lit(SPACES))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = rows.select(
        *keep,
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK, -1)).alias("_words"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    word = lambda i, k: F.get("_words", i + k)
    windows = F.when(
        F.size("_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*[word(i, k) for k in range(WINDOW)])
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    done = [*keep, "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    rows = rows.select(
        *done[:-3],
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    # only where a window is repeated: windows in order of their hash, each with its place
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.select(*done, F.when(repeated, placed).otherwise(none).alias("_placed"))
    twin = lambda x, k: (F.get("_placed", k - 1)["h"] == x["h"]) | (F.get("_placed", k + 1)["h"] == x["h"])
    starts = F.sort_array(
        F.transform(F.filter("_placed", lambda x, k: F.coalesce(twin(x, k), F.lit(False))), lambda x: x["i"])
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n")),
    )["n"]
    return rows.select(*done, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _ratio(rule: Rule) -> Column:
    return F.when(F.col(rule.under) > 0, F.col(rule.over) / F.col(rule.under))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed in logarithms; 1 where k is not below the mean."""
    odds = F.lit(p / (1 - p))
    begin = F.struct((n * F.log1p(F.lit(-p))).alias("t"), (n * F.log1p(F.lit(-p))).alias("s"))

    def step(acc, i):
        t = acc["t"] + F.log((n - i + 1) / i * odds)
        top = F.greatest(acc["s"], t)
        return F.struct(t.alias("t"), (top + F.log(F.exp(acc["s"] - top) + F.exp(t - top))).alias("s"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, 1.0).otherwise(F.exp(F.aggregate(terms, begin, step)["s"]))


def certified_cutoffs(labelled: DataFrame, cfg: RiskConfig = RiskConfig(), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``stratum`` and a column with each rule's cutoff, null where none is certified.

    ``labelled``: stratum, good (boolean) and the figures of documents that pass the base rule. The counts are
    one aggregate over all labelled documents, combined before the shuffle.
    """
    tests = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(c).alias("cutoff"),
            F.lit(k).alias("leniency"),
            F.coalesce((_ratio(rule) - c) * rule.sign > 0, F.lit(False)).alias("hit"),
        )
        for rule in rules
        for k, c in enumerate(rule.cutoffs)
    ]
    tested = labelled.select("stratum", "good", F.explode(F.array(*tests)).alias("t")).select("stratum", "good", "t.*")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).alias
    counts = tested.groupBy("stratum", "rule", "cutoff", "leniency").agg(
        one(F.col("good"))("n"), one(F.col("good") & F.col("hit"))("k"), one(~F.col("good") & F.col("hit"))("bad")
    )
    counts = materialize(counts, "risk")
    strata = counts.select("stratum").distinct().count()
    level = cfg.error / max(1, strata * len(tests))
    passed = counts.where(binomial_tail(F.col("n"), F.col("k"), cfg.limit / len(rules)) <= level).where("bad > k")
    best = passed.groupBy("stratum", "rule").agg(F.max(F.struct(F.col("bad") - F.col("k"), "leniency", "cutoff"))["cutoff"].alias("c"))
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("c"))).alias(f"cut_{r.name}") for r in rules]
    )


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, cfg: RiskConfig = RiskConfig(), rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """doc_id, the figures, base_failed and kept of every document. ``labels``: doc_id and quality (1: good)."""
    narrow = docs.select("doc_id", "text", F.col("lang").alias("stratum"))
    rows = materialize(text_figures(narrow, "doc_id", "stratum"), "figures").withColumn("base_failed", base_failed())
    good = labels.where("quality is not null").groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))
    labelled = rows.where(~F.col("base_failed")).join(good, "doc_id")
    cuts = certified_cutoffs(labelled, cfg, rules).withColumnRenamed("stratum", "_stratum")
    met = rows.join(cuts, rows["stratum"].eqNullSafe(F.col("_stratum")), "left")
    hit = F.lit(False)
    for r in rules:
        hit = hit | F.coalesce((_ratio(r) - F.col(f"cut_{r.name}")) * r.sign > 0, F.lit(False))
    figures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return met.select("doc_id", *figures, "base_failed", (~F.col("base_failed") & ~hit).alias("kept"))
