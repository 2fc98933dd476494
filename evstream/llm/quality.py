"""Quality rules: statistics by DataFrame expressions and a learned, ordered list of conditions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from evstream.llm.common import query, saved, table, without

WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
# At most so many labelled rows are fitted; which ones depends on a hash of the id alone.
MAX_LABELLED = 20_000
# Hash buckets the labelled rows are counted in: 2 to this power, at most so many counts.
HASH_BITS = 16
# A rule stays if it is right on so large a share of the held-out rows it fires on.
MIN_PRECISION = 0.95
MAX_CONDITIONS, MAX_RULES = 4, 12
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Whole numbers, so that thresholds and comparisons are exact: per thousand, but for the first two.
FEATURES = ["n_words", "n_lines", "chars_per_word", "symbols_per_word", "dup_line_share",
            "repeat_share", "upper_share", "bangs_per_word", "distinct_share"]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its counts over whole texts; clashing columns are replaced.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and the extras ``n_lines,
    n_upper, n_bangs, n_distinct``. NULL and empty texts count 0 everywhere. Five-word windows are
    compared by 64-bit hashes; only texts that hold a window twice are sorted.
    """
    own = [*BASE, "n_lines", "n_upper", "n_bangs", "n_distinct"]
    df = without(docs, *own, "_w", "_l", "_h", "_g", "_s", "_p")
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_w", F.array_remove(F.split(t, WORD_BREAK), ""))
    df = df.withColumn("_l", F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    df = df.withColumn("_g", F.when(F.size("_h") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_h") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))))
    twice = F.size(F.array_distinct("_g")) < F.size("_g")
    df = df.select(
        "*", F.size("_w").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_w")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.regexp_count(t, F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit("!")).cast("long").alias("n_bangs"),
        F.size(F.array_distinct("_h")).cast("long").alias("n_distinct"),
        F.when(twice, F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))).alias("_s"),
    ).drop("_w", "_l", "_h", "_g")
    same = lambda e, j: (F.get("_s", j - 1)["g"] == e["g"]) | (F.get("_s", j + 1)["g"] == e["g"])
    df = df.withColumn("_p", F.array_sort(F.transform(
        F.filter("_s", lambda e, j: F.coalesce(F.when(j > 0, same(e, j)).otherwise(F.get("_s", j + 1)["g"] == e["g"]),
                                               F.get("_s", j - 1)["g"] == e["g"], F.lit(False))),
        lambda e: e["i"])))
    step = F.zip_with("_p", F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1))),
                      lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    repeat = F.coalesce(F.aggregate(step, F.lit(0), lambda x, y: x + y), F.lit(0)).cast("long")
    return df.withColumn("n_repeat_words", repeat).drop("_s", "_p")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def features(stats: DataFrame) -> DataFrame:
    """``stats`` with :data:`FEATURES`, whole numbers; shares of nothing are 0."""
    share = lambda a, b: F.coalesce(F.expr(f"1000 * {a} div nullif({b}, 0)"), F.lit(0)).cast("long")
    return stats.withColumns({
        "chars_per_word": share("word_chars", "n_words"), "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"), "bangs_per_word": share("n_bangs", "n_words"),
        "distinct_share": share("n_distinct", "n_words")})


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c < F.lit(self.threshold)

    def mask(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v > self.threshold if self.above else v < self.threshold


Rule = tuple[Condition, ...]


def _fires(rule: Sequence[Condition], x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, [c.mask(x) for c in rule], np.ones(len(x), bool))


def _grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    """Add the threshold of largest information gain until no good row is covered."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS and len(bad) and not bad.all() and bad.any():
        now, best = np.log2(bad.mean()), (0.0, None)
        for k, name in enumerate(FEATURES):
            order = np.argsort(x[:, k], kind="stable")
            v, hits = x[order, k], np.cumsum(bad[order])
            cut = np.flatnonzero(v[1:] > v[:-1])  # between rows cut and cut + 1
            if not len(cut):
                continue
            for above in (False, True):
                p = hits[-1] - hits[cut] if above else hits[cut]
                n = len(v) - 1 - cut if above else cut + 1
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - now), 0.0)
                i = int(gain.argmax())
                if gain[i] > best[0] + 1e-9:
                    best = (gain[i], Condition(name, above, float(v[cut[i]] + v[cut[i] + 1]) / 2))
        if best[1] is None:
            break
        rule.append(best[1])
        keep = best[1].mask(x)
        x, bad = x[keep], bad[keep]
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """Cut the rule after the condition where (bad - good) / covered is largest on held-out rows."""
    def worth(r):
        hit = _fires(r, x)
        return (2 * bad[hit].sum() - hit.sum()) / max(1, hit.sum())

    return max((rule[:n] for n in range(len(rule), 0, -1)), key=worth)


def learn(x: np.ndarray, bad: np.ndarray, held: np.ndarray) -> list[Rule]:
    """Sequential covering: grow a rule, prune it on the held-out third, keep it if it is precise
    there, take the rows it covers away, and go on. Ordered; rows no rule covers are kept."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    while len(rules) < MAX_RULES and bad[left & ~held].any():
        rule = _grow(x[left & ~held], bad[left & ~held])
        if not rule:
            break
        rule = _prune(rule, x[left & held], bad[left & held])
        hit = _fires(rule, x) & left
        out = hit & held
        if not out.any() or bad[out].mean() < MIN_PRECISION or bad[hit].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(stats: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> list[Rule]:
    """Learn which documents to reject from ``labels`` (quality 0 is bad).

    ``stats`` has ``doc_id`` and :data:`FEATURES`. Rows without a quality, and ids with two
    different ones, are left out; repeated equal labels count once. At most ``limit`` rows, those
    of smallest id hash, are fitted. Rows are counted by the first bits of their hash, so that
    tasks send the driver these rows and the rest of one hash bucket. No labels: no rules.
    """
    known = (labels.where("quality is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("_q"), F.max("quality").alias("_q2")).where("_q = _q2"))
    seen = F.xxhash64("doc_id", F.lit(7))
    # Of several texts under one id the one of least counts, whichever task comes first.
    own = stats.where(~base_failed()).groupBy("doc_id").agg(F.min(F.struct(*FEATURES)).alias("_s")).select("doc_id", "_s.*")
    known = saved(own.join(known, "doc_id").select(seen.alias("_o"), "_q", *FEATURES), "labelled")
    bucket = F.shiftright("_o", 64 - HASH_BITS)
    sizes = sorted(known.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
    if not sizes:
        return []
    upto = next((b for (b, _), n in zip(sizes, accumulate(n for _, n in sizes), strict=True) if n >= limit), sizes[-1][0])
    rows = known.where(bucket <= upto).orderBy("_o").limit(limit).collect()
    a = np.array([tuple(r) for r in rows], dtype=np.int64)
    return learn(a[:, 2:].astype(float), a[:, 1] == 0, a[:, 0] % 3 == 0)


def verdict(rules: Sequence[Rule]) -> Column:
    """Number of the first rule that fires, from 1; 0 if none does."""
    out = F.lit(0)
    for n, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(reduce(lambda a, b: a & b, [c.column() for c in rule]), F.lit(n)).otherwise(out)
    return out


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``rule`` and ``kept`` of every row of ``docs``.

    Texts are read once: the counts are saved, fitted on, and judged. NULL ids are judged too.
    """
    stats = saved(features(statistics(docs.select("doc_id", "text"))).drop("text"), "quality")
    rule = verdict(fit(stats, labels))
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("rule", F.when(F.col("base_failed"), F.lit(-1)).otherwise(rule))
            .withColumn("kept", F.col("rule") == 0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged. Rows are judged where they stand: the rules are
    learned first, then counts and verdict are computed beside each row, without a join."""
    known = docs.select("doc_id", "text").join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    stats = saved(features(statistics(known)).drop("text"), "quality")
    rule = verdict(fit(stats, labels))
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("text"))
    # The row number keeps the condition above the counts: pushed below them, it would work them
    # out again for every place that names one.
    counted = features(statistics(whole)).withColumn("_n", F.monotonically_increasing_id())
    return counted.where(~base_failed() & (rule == 0) & (F.col("_n") >= 0)).select("_row.*")


@query("op7_quality_rules")
def op7_quality_rules(spark, folder):
    out = judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.select("doc_id", *BASE, "base_failed", "kept", "rule")
