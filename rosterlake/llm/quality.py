"""Quality rules with risk-controlled cutoffs.

Base figures of every text, a fixed base rule, and cutoffs on four ratios that are chosen on labelled
holdouts: per stratum a cutoff whose false rejections are limited by an exact binomial bound.

Risk control: ``alpha`` is the largest accepted rate of good documents that the learned rules together reject in
a stratum, ``delta`` the probability that the promise fails anywhere; each stratum gets delta / strata
(Bonferroni). A part of the good holdout documents (``TUNING``, by a hash of the id) and all bad ones lay out a
path of rule sets before the others are looked at: from no rule on, the rule and cutoff that reject most further bad
documents less ``PRICE`` times the good ones, one step of the grid at a time, so every set contains the one before.
The other good documents test the sets along that path, each as a whole, and the first one that fails ends the
search (fixed sequence, no further correction). A set passes if P(Binomial(n, alpha) <= k) is at most the
stratum's level, where k of the n good documents break any of its rules. All sets that pass hold the promise
together, so the one is taken that rejects most bad documents less ``PRICE`` times the good ones; on a tie the
loosest. A path that rejects no labelled bad document gives no rule.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# fixed values: the base rule and the characters that count as symbols
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
BLANK = "\t\n\x0b\x0c\r "
#: rule -> grid of cutoffs from loose to strict; a document is rejected if its ratio is greater.
GRIDS = {
    "symbol_ratio": [round(2.0 * 0.85**i, 6) for i in range(30)],
    "repeat_ratio": [round(0.2 * 0.85**i, 6) for i in range(20)],
    "dup_line_ratio": [round(0.95 - 0.03 * i, 6) for i in range(30)],
    "word_length": [round(40 * 0.93**i, 6) for i in range(25)],
}
ALPHA, DELTA, PRICE = 0.02, 0.05, 20
TUNING, SEED = 0.25, 11
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]


def repeated_words(words: np.ndarray, size: int = REPEAT_WINDOW) -> int:
    """Words covered by windows of ``size`` words that occur twice or more in the text."""
    if len(words) < size:
        return 0
    grams = common.windows(words, size)
    _, place, count = np.unique(grams, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[place] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def figures(text: str | None) -> tuple[int, int, int, int, int, int]:
    text = text or ""
    data = text.encode("utf-8", "replace")
    blanks = sum(text.count(c) for c in BLANK)
    words = common.word_hashes(text)
    seen, lines, again = set(), 0, 0
    for line in data.split(b"\n"):
        if line.strip(common.SPACES):
            lines += 1
            again += line in seen
            seen.add(line)
    return len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), again, lines, repeated_words(words)


def ratios() -> dict:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbol_ratio": F.col("n_symbols") / words, "repeat_ratio": F.col("n_repeat_words") / words,
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), "word_length": F.col("word_chars") / words}


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), summed exactly in logarithms."""
    i = np.arange(k + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(n - i[:-1]) - np.log(i[1:]))]) + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def cutoff(beyond: list[int], n: int, bad: list[int], grid: list, rate: float, level: float) -> int | None:
    """Place in the sequence (loose to strict) of the cutoff or rule set to use; None if none passes or none helps."""
    best, gain = None, 0
    for i, k in enumerate(beyond):
        if n == 0 or k > n * rate or binomial_tail(k, n, rate) > level:
            break
        if bad[i] - PRICE * k > gain:
            best, gain = i, bad[i] - PRICE * k
    return best


def rejected(places: np.ndarray, rules: tuple[int, ...]) -> np.ndarray:
    """Which rows of first broken grid places break any of the rules (a place per rule, -1 for none)."""
    return (places <= np.array(rules)).any(axis=1)


def rule_path(places: np.ndarray, good: np.ndarray, bad: np.ndarray, sizes: list[int], price: float) -> list[tuple[int, ...]]:
    """Nested rule sets from loose to strict, laid out on rows with numbers of good and of bad documents."""
    at, path = [-1] * len(sizes), []
    while True:
        left = ~rejected(places, tuple(at))
        gain = 0.0
        for rule, size in enumerate(sizes):
            mine = np.minimum(places[left, rule], size)
            worth = np.bincount(mine, bad[left] - price * good[left], size + 1)[:size].cumsum()
            if size and worth.max() > gain:
                gain, step = worth.max(), (rule, int(worth.argmax()))
        if not gain:
            return path
        rule, place = step
        for i in range(at[rule] + 1, place + 1):
            at[rule] = i
            path.append(tuple(at))


def learn_cutoffs(holdout: DataFrame, alpha: float = ALPHA, delta: float = DELTA, grids: dict | None = None) -> DataFrame:
    """``stratum``, ``rule``, ``cutoff``, ``n_good``, ``beyond``: from rows with ``doc_id``, ``stratum``, ``good`` and the ratios.

    ``n_good`` good documents tested the stratum's rule set, ``beyond`` of them break one of its rules. One grouped
    count over all labelled rows leaves a row per stratum and combination of grid places, whose number the grids
    bound; only strata with labels appear. A null ratio breaks no rule.
    """
    grids = grids or GRIDS
    rules, sizes = list(grids), [len(g) for g in grids.values()]
    first = [F.coalesce(F.size(F.filter(F.array(*map(F.lit, grid)), lambda c: c >= F.col(rule))) + F.col(rule) * 0, F.lit(len(grid)))  # noqa: B023
             .cast("int").alias(rule) for rule, grid in grids.items()]
    tuning = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int(TUNING * (1 << 20))
    cells = common.store(holdout.select("stratum", "good", tuning.alias("tuning"), *first).groupBy("stratum", "good", "tuning", *rules)
                         .agg(F.count(F.lit(1)).alias("n")), "holdout")
    level = delta / max(1, cells.select("stratum").distinct().count())

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        places, n = frame[rules].to_numpy(), frame["n"].to_numpy()
        good, tunes = frame["good"].to_numpy(bool), frame["tuning"].to_numpy(bool)
        bad, tested = np.where(good, 0, n), np.where(good & ~tunes, n, 0)
        path = rule_path(places, np.where(good & tunes, n, 0), bad, sizes, PRICE / TUNING)
        broken = [rejected(places, rules_) for rules_ in path]
        i = cutoff([int(tested[b].sum()) for b in broken], int(tested.sum()), [int(bad[b].sum()) for b in broken], path, alpha, level)
        rows = [] if i is None else [(frame["stratum"].iloc[0], rule, grids[rule][place], int(tested.sum()), int(tested[broken[i]].sum()))
                                     for rule, place in zip(rules, path[i]) if place >= 0]
        return pd.DataFrame(rows, columns=["stratum", "rule", "cutoff", "n_good", "beyond"])

    return cells.groupBy("stratum").applyInPandas(choose, "stratum string, rule string, cutoff double, n_good long, beyond long")


def quality_rules(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  stratum_column: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """A row per document: the base figures, ``base_failed``, ``stratum``, ``broken_rules``, ``kept`` and ``text_hash``.
    Rows that share an id are judged each by its own text.

    Holdout documents are those with a ``quality`` label (good if any label of the id is 1) that pass the base
    rule. A null stratum is the stratum ''. A stratum without labels has no cutoff, so only the base
    rule applies there; null text has no words and fails the base rule.
    """
    common.prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
                         F.coalesce(F.col(stratum_column).cast("string"), F.lit("")).alias("stratum")).withColumn("text_hash", F.xxhash64("text"))

    def build(frames):
        for frame in frames:
            rows = [(i, s, h, *figures(t)) for i, t, s, h in zip(frame["id"], frame["text"], frame["stratum"], frame["text_hash"])]
            yield pd.DataFrame(rows, columns=["id", "stratum", "text_hash", *FIGURES])

    found = narrow.select(F.col("doc_id").cast("string").alias("id"), "text", "stratum", "text_hash").mapInPandas(
        build, "id string, stratum string, text_hash long, " + ", ".join(f"{c} long" for c in FIGURES))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    found = common.store(found.select(F.col("id").cast("long").alias("doc_id"), *found.columns[1:])
                         .withColumn("base_failed", base).withColumns(ratios()), "figures")
    judged = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality").cast("int") == 1).alias("good"))
              .where("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good")))
    holdout = found.where("NOT base_failed").join(common.store(judged, "judged"), "doc_id")
    wide = common.store(learn_cutoffs(holdout, alpha, delta).groupBy("stratum").pivot("rule", list(GRIDS)).agg(F.first("cutoff")), "cutoffs")
    limits = wide.select("stratum", *[F.col(rule).alias(f"max_{rule}") for rule in GRIDS])
    broken = F.filter(F.array(*[F.when(F.col(rule) > F.col(f"max_{rule}"), F.lit(rule)) for rule in GRIDS]), lambda x: x.isNotNull())
    return (found.join(limits, "stratum", "left").withColumn("broken_rules", broken)
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    "stratum", "broken_rules", "text_hash"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, each row by its own text and language. Rows without an id are judged by
    none of them and stay."""
    bad = (quality_rules(docs, labels).where("NOT kept AND doc_id IS NOT NULL")
           .select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"), F.col("stratum").alias("bad_stratum")).distinct())
    same = ((F.col("d.doc_id") == F.col("b.bad_id")) & (F.xxhash64(F.col("d.text")) == F.col("b.bad_hash"))
            & (F.coalesce(F.col("d.lang").cast("string"), F.lit("")) == F.col("b.bad_stratum")))
    return docs.alias("d").join(bad.alias("b"), same, "left_anti")
