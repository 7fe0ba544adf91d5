"""Quality rules with risk-controlled thresholds (operator 3, DataFrame functions only).

Per text a few shares are measured; a rule rejects a text whose share is above a cutoff.
Cutoffs come from labelled texts: within a stratum (language) every rule walks a fixed
list of cutoffs from lenient to strict and tests, at each, the hypothesis "the rule
rejects more than alpha / rules of the clean texts" with the exact binomial tail

    p = P(Binomial(clean texts, alpha / rules) <= clean texts rejected).

The walk goes on while p is at most delta / (strata * rules): a fixed sequence within a
rule, Bonferroni over strata and rules. With probability 1 - delta every stratum loses at
most alpha of its clean texts, whatever cutoffs are used. Among the certified cutoffs the
one that rejects most bad texts net of clean ones is used, the most lenient on a tie. A
stratum with too few labels certifies nothing, and its texts are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import GAP, let, staged, word_array

SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 5

CUTOFFS = (0.90, 0.80, 0.70, 0.60, 0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20, 0.16, 0.13, 0.10, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02)
RULES = ("symbol_share", "upper_share", "dup_line_share", "repeat_share")


@dataclass(frozen=True)
class Risk:
    """alpha: clean texts a stratum may lose; delta: chance that any stratum loses more."""
    alpha: float = 0.02
    delta: float = 0.05
    cutoffs: tuple[float, ...] = CUTOFFS
    rules: tuple[str, ...] = RULES


def _covered(words: Column, n: Column) -> Column:
    """Words that lie in a 5-word window found twice or more in the array ``words``."""
    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]))

    def spread(starts: Column) -> Column:
        steps = F.transform(F.sequence(F.lit(1), F.size(starts)), lambda k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, k) - F.get(starts, k - 1), F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

    def repeated(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])),
            lambda x: x["i"])))
        return let(starts, spread)

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(repeated(w))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(n < WINDOW, F.lit(0)).otherwise(let(hashes, lambda h: let(windows(h), count)))


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, the base columns of the contract and the shares the rules test.

    A null text has no words. Windows are compared by a 64-bit hash of their five words'
    hashes (a clash inside one text of 10,000 words has odds of 3e-12).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = word_array(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, GAP, "")) > 0)
    first = docs.select(*[F.col(f"`{c}`") for c in keep], text.alias("__text"), words.alias("__words"), lines.alias("__lines"))
    n = F.size("__words")
    joined = F.array_join("__words", "")
    measured = first.select(
        *[F.col(f"`{c}`") for c in keep],
        n.cast("long").alias("n_words"),
        F.char_length(joined).cast("long").alias("word_chars"),
        (F.char_length("__text") - F.char_length(F.regexp_replace("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("__words"), n).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.char_length("__text") - F.char_length(F.regexp_replace("__text", r"\p{Lu}+", ""))).cast("long").alias("n_upper"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return (measured
            .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
            .withColumn("symbol_share", share("n_symbols", "word_chars"))
            .withColumn("upper_share", share("n_upper", "word_chars"))
            .withColumn("dup_line_share", share("n_dup_lines", "n_lines"))
            .withColumn("repeat_share", share("n_repeat_words", "n_words")))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed term by term in logarithms."""
    import math
    first = n * F.lit(math.log1p(-p))
    odds = math.log(p) - math.log1p(-p)
    start = F.struct(first.alias("t"), F.exp(first).alias("s"))

    def step(a: Column, i: Column) -> Column:
        t = a["t"] + F.ln((n - i + 1) / i) + F.lit(odds)
        return F.struct(t.alias("t"), (a["s"] + F.exp(t)).alias("s"))

    return F.when(k < 1, F.exp(first)).otherwise(
        F.aggregate(F.sequence(F.lit(1).cast("long"), k), start, step, lambda a: a["s"]))


def stratum() -> Column:
    return F.coalesce(F.concat(F.lit("lang "), F.col("lang")), F.lit("no lang"))


def certify(measured: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """(stratum, rule, cutoff) of every rule with a certified cutoff.

    ``measured``: doc_id, lang, base_failed and the shares; ``labels``: doc_id, quality.
    Only texts that pass the base rules count: the rules decide about no others. A text
    with labels that disagree counts once per label; null labels are ignored.
    """
    n_rules, steps = len(risk.rules), len(risk.cutoffs)
    stricter = lambda s: sum((F.when(s > c, 1).otherwise(0) for c in risk.cutoffs), F.lit(0))
    known = (measured.filter(~F.col("base_failed")).select("doc_id", stratum().alias("stratum"), *risk.rules)
             .join(labels.filter("quality is not null").select("doc_id", F.col("quality").alias("__good")), "doc_id")
             .select("stratum", "__good", F.explode(F.array(*[
                 F.struct(F.lit(r).alias("rule"), stricter(F.col(r)).alias("above")) for r in risk.rules])).alias("r")))
    # above: how many cutoffs, counted from the strictest, the share is above.
    cells = known.groupBy("stratum", F.col("r.rule").alias("rule"), F.col("r.above").alias("above")).agg(
        F.sum(F.when(F.col("__good") == 1, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("__good") == 0, 1).otherwise(0)).alias("bad"))
    per = (cells.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n"),
        *[F.sum(F.when(F.col("above") >= steps - i, F.col("good")).otherwise(0)).alias(f"g{i}") for i in range(steps)],
        *[F.sum(F.when(F.col("above") >= steps - i, F.col("bad")).otherwise(0)).alias(f"b{i}") for i in range(steps)]))
    grid = per.select("stratum", "rule", "n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(c).alias("cutoff"), F.col(f"g{i}").alias("good"), F.col(f"b{i}").alias("bad"))
        for i, c in enumerate(risk.cutoffs)])).alias("x")).select("stratum", "rule", "n", "x.*")
    strata = measured.select(stratum().alias("stratum")).distinct().count()
    level = risk.delta / max(1, strata * n_rules)
    alpha = risk.alpha / n_rules
    p = F.when(F.col("good") >= alpha * F.col("n"), F.lit(1.0)).otherwise(binomial_cdf(F.col("good"), F.col("n"), alpha))
    walk = Window.partitionBy("stratum", "rule").orderBy("step")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc(F.col("bad") - F.col("good")), "step")
    return (grid.withColumn("p", p)
            .withColumn("worst", F.max("p").over(walk)).filter(F.col("worst") <= level)
            .filter("bad > good")
            .withColumn("rank", F.row_number().over(best)).filter("rank = 1")
            .select("stratum", "rule", "cutoff"))


def verdict(cutoffs: list, risk: Risk = Risk()) -> Column:
    """Whether a measured text is kept. ``cutoffs``: rows of :func:`certify`.

    They are few whatever the input: a stratum certifies nothing below
    ln(strata * rules / delta) * rules / alpha clean labels (over 800).
    """
    fails = F.lit(False)
    for r in sorted(cutoffs, key=lambda r: (r["stratum"], r["rule"])):
        fails = fails | ((stratum() == F.lit(r["stratum"])) & (F.col(r["rule"]) > F.lit(r["cutoff"])))
    return ~F.col("base_failed") & ~fails


def judge(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, lang) with its measures and ``kept``.

    Null texts have no words and fail the base rule; a null lang is a stratum of its own;
    repeated rows get equal verdicts; without labels only the base rule rejects; an empty
    table gives no rows. Extra columns are not carried.
    """
    rows = staged(measures(docs, "doc_id", "lang"), "measures")
    return rows.withColumn("kept", verdict(certify(rows, labels, risk).collect(), risk))


def keep(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` the rules keep, columns unchanged. Only the labelled texts are
    measured twice (once to choose cutoffs)."""
    # Labels grow with the documents: the same shuffled join at every size.
    known = docs.join(labels.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    strata = docs.select("lang").distinct()
    sample = staged(measures(known, "doc_id", "lang"), "measures")
    # strata without any label still count in the correction, as in judge()
    padded = sample.unionByName(strata.select("lang", F.lit(True).alias("base_failed")), allowMissingColumns=True)
    cutoffs = certify(padded, labels, risk).collect()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "lang", "text")
    return measures(rows, "row", "lang").filter(verdict(cutoffs, risk)).select("row.*")
