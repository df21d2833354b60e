"""Quality rules with risk-controlled thresholds.

Fixed base rules reject what nobody wants. Beyond them each rule has a score (higher is worse) and a
ladder of cutoffs. On the labelled documents that pass the base rules, every step of a ladder is
tested, from the most lenient down, against the hypothesis that it rejects more than its share of
the good documents of a stratum. The p-value is the exact binomial tail (the Clopper-Pearson bound
turned round); the ladder stops at the first step that is not proven (fixed-sequence testing), and
the ladders of all rules and strata share the error level (Bonferroni). So, with probability
``1 - delta``, no stratum loses more than ``alpha`` of its good documents to all rules together.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Batches, give_back, identified, in_slices, only_rows, text_of
from tidemark.session import settle, settle_sized

#: Rule scores and the ladders of cutoffs; a document fails a rule when its score exceeds the cutoff.
LADDERS: dict[str, list[float]] = {
    "symbols_per_word": [3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1],
    "shouted_share": [0.98, 0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "repeated_share": [0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15],
    "copied_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "marks_per_word": [3.0, 2.0, 1.5, 1.2, 1.0, 0.8, 0.6],
}
BROADCAST_BYTES = 16 << 20

_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_BLANKS = " \t\n\v\f\r"


def repeated_words(words: list[bytes]) -> int:
    """Words inside any 3-word window that occurs at least twice."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    _, pair = np.unique(number[:-1] * len(known) + number[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(known) + number[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= again
    return int(covered.sum())


def _without(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def measures(text: str) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the scores of ``LADDERS``."""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols, copies, again = _without(data, _SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)
    letters, count = _without(data, _LETTERS), max(len(words), 1)
    return (len(words), len(text) - sum(map(text.count, _BLANKS)), symbols, copies, again,
            symbols / count, _without(data, _UPPER) / letters if letters else 0.0, again / count,
            copies / len(lines) if lines else 0.0, _without(data, _MARKS) / count)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("stratum", pa.string()),
                     *[(c, pa.int64()) for c in _COUNTS], *[(c, pa.float64()) for c in LADDERS]])
_DDL = ", ".join(["uid long, doc_id long, stratum string", *[f"{c} long" for c in _COUNTS],
                  *[f"{c} double" for c in LADDERS]])


def _measure(batches: Batches) -> Batches:
    for batch in in_slices(batches):
        uid, doc_id, stratum, body = batch.columns
        columns = list(zip(*map(measures, body.to_pylist()))) or [[]] * (len(_SCHEMA) - 3)
        yield pa.RecordBatch.from_arrays(
            [uid, doc_id, stratum, *(pa.array(c, f.type) for c, f in zip(columns, list(_SCHEMA)[3:]))], schema=_SCHEMA)
    give_back()


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """The counts and scores of every row; uid numbers the rows. NULL text counts as empty."""
    rows = identified(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"),
                           "stratum": F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")),
                           "body": text_of(text)})
    return rows.mapInArrow(_measure, _DDL).withColumn("base_failed", (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def binomial_tail(errors: int, trials: int, rate: float) -> float:
    """P(X <= errors) of X ~ Binomial(trials, rate), summed from its largest term outwards."""
    if errors >= trials:
        return 1.0
    top = min(errors, int((trials + 1) * rate))
    odds = rate / (1 - rate)
    first = math.exp(
        math.lgamma(trials + 1) - math.lgamma(top + 1) - math.lgamma(trials - top + 1)
        + top * math.log(rate) + (trials - top) * math.log1p(-rate))
    total = term = first
    for k in range(top, 0, -1):
        term *= k / (trials - k + 1) / odds
        total += term
        if term < 1e-18 * total:
            break
    term = first
    for k in range(top, errors):
        term *= (trials - k) / (k + 1) * odds
        total += term
        if term < 1e-18 * total:
            break
    return min(total, 1.0)


def chosen_cutoff(cutoffs: list[float], good: list[int], bad: list[int], n_good: int, rate: float,
                  level: float) -> tuple[float | None, int]:
    """The cutoff among the proven ones that gains most, and the number of proven steps.

    ``good[k]`` and ``bad[k]`` count the labelled documents above ``cutoffs[k]``. Gain: bad documents
    rejected, less ten for each good one; ties go to the more lenient cutoff. None if no step is proven
    or none gains.
    """
    best, best_gain, proven = None, 0, 0
    for cutoff, wrong, right in zip(cutoffs, good, bad):
        if n_good == 0 or binomial_tail(wrong, n_good, rate) > level:
            break
        proven += 1
        if right - 10 * wrong > best_gain:
            best, best_gain = cutoff, right - 10 * wrong
    return best, proven


def _choose(alpha: float, delta: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rule, tests = frame["rule"].iloc[0], int(frame["strata"].iloc[0]) * len(LADDERS)
        ladder = LADDERS[rule]
        above = {0: [0] * len(ladder), 1: [0] * len(ladder)}
        totals = {0: 0, 1: 0}
        for label, steps, n in zip(frame["good"], frame["steps"], frame["n"]):
            totals[label] += n
            for k in range(len(ladder)):
                above[label][k] += n if steps > len(ladder) - 1 - k else 0
        cutoff, proven = chosen_cutoff(ladder, above[1], above[0], totals[1], alpha / len(LADDERS), delta / tests)
        return pd.DataFrame({"stratum": [frame["stratum"].iloc[0]], "rule": [rule], "cutoff": [cutoff],
                             "proven": [proven], "n_good": [totals[1]]}).astype({"cutoff": "float64"})

    return run


def thresholds(scores: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Per stratum and rule: cutoff (NULL: the rule is off there), proven ladder steps, n_good.

    ``scores`` comes from ``measured``; ``labels`` has doc_id and quality (1 good, 0 bad). All labelled
    documents that pass the base rules take part. Repeated labels of a document count once, the
    worst one; rows without identifier or label are left out. Only counts per ladder step leave the
    scan, so a stratum of any size meets as a few rows. Writes these counts (an action).
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") > 0).cast("int").alias("good"))
    held = scores.where(~F.col("base_failed")).join(known, "doc_id")
    # a score above k cutoffs fails the k lowest steps of its ladder
    steps = [F.struct(F.lit(rule).alias("rule"),
                      sum((F.col(rule) > F.lit(c)).cast("int") for c in ladder).alias("steps"))
             for rule, ladder in LADDERS.items()]
    counts = settle(held.select("stratum", "good", F.inline(F.array(*steps))).groupBy(
        "stratum", "rule", "steps", "good").agg(F.count(F.lit(1)).alias("n")))
    strata = counts.agg(F.count_distinct("stratum")).first()[0]
    return counts.withColumn("strata", F.lit(strata)).groupBy("stratum", "rule").applyInPandas(
        _choose(alpha, delta), "stratum string, rule string, cutoff double, proven int, n_good long")


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", stratum: str = "lang",
           alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Per row of ``docs``: uid, doc_id, stratum, the counts and scores, base_failed, failed_rule, kept.

    NULL or empty texts have no words and fail the base rules. A NULL stratum is a stratum of its own;
    one without enough labels to prove any cutoff rejects by the base rules only. Repeated rows are
    judged alike, an empty table gives an empty result, other columns are not read. Writes the
    measures once and the table of cutoffs, which is broadcast up to 16 MB and joined by key beyond.
    """
    scores = settle(measured(docs, text, doc_id, stratum))
    cutoffs = thresholds(scores, labels, alpha, delta).where("cutoff IS NOT NULL").groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"max_{rule}") for rule in LADDERS])
    cutoffs, size = settle_sized(cutoffs)
    joined = scores.join(F.broadcast(cutoffs) if size <= BROADCAST_BYTES else cutoffs, "stratum", "left")
    failed = F.coalesce(*[F.when(F.col(rule) > F.col(f"max_{rule}"), F.lit(rule)) for rule in LADDERS])
    return joined.select(*scores.columns, failed.alias("failed_rule")).withColumn(
        "kept", ~F.col("base_failed") & F.col("failed_rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that ``judged`` rejects; all columns stay.

    The verdicts are joined by row number: repeated and missing identifiers are safe.
    """
    return only_rows(docs, judged(docs, labels, **options).where("kept"))
