"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, a posterior decides. DataFrame only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from receiptflow.llm.shared import without, written

_SPACE = r"[\x20\x09-\x0D]"
#: Bits of a window's place in its text when place and hash share a long; an array has under 2**31 elements.
_PLACE = 31


@dataclass(frozen=True)
class Vote:
    """``good`` and ``bad`` are SQL conditions on the measures; where neither holds the rule abstains."""

    name: str
    good: str
    bad: str


#: Shares per word or line, as is usual for web text.
VOTES = (
    Vote("length", "n_words >= 100", "n_words < 50"),
    Vote("word_size", "word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Vote("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    Vote("lines", "n_dup_lines = 0", "10 * n_dup_lines > 3 * n_lines"),
    Vote("repetition", "10 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    Vote("endings", "2 * n_ended_lines >= n_lines", "10 * n_ended_lines < n_lines"),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines")


def _neighbours(array: str, key):
    """The elements of a sorted array column whose ``key`` equals that of the one before or after."""
    a = F.col(array)
    same = lambda x, y: F.coalesce(key(x) == key(y), F.lit(False))
    return F.filter(a, lambda x, i: same(x, F.get(a, i + 1)) | same(x, F.get(a, i - 1)))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by its measures (all long); see ``judge_quality``."""
    out = without(docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit(""))), [text_col, *MEASURES])
    text, words, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    n = F.size(words)
    out = out.withColumns(
        {
            "__words": F.filter(F.split(text, _SPACE + "+"), lambda w: w != ""),
            "__lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "word_chars": (F.length(text) - F.regexp_count(text, F.lit(_SPACE))).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        }
    )
    # equal windows of three words have equal hashes; one sort of plain numbers brings those next to each other
    trigrams = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_ended_lines": F.size(F.filter(lines, lambda x: x.rlike(r"[.!?\"')\]][\x20\x09-\x0D]*\z"))).cast("long"),
            "__hash": F.slice(trigrams, F.lit(1), F.greatest(n - 2, F.lit(0))),
        }
    ).drop("__text", "__words", "__lines")
    place = F.lit((1 << _PLACE) - 1)
    packed = F.transform("__hash", lambda h, i: h.bitwiseAND(F.lit(-(1 << _PLACE))).bitwiseOR(i.cast("long")))
    out = out.withColumn("__sorted", F.sort_array(packed))
    # windows whose hashes share the upper bits: few, and all that come twice are among them; the whole hash decides
    out = out.withColumn("__like", _neighbours("__sorted", lambda x: F.shiftright(x, _PLACE))).drop("__sorted")
    own = F.transform(
        "__like", lambda x: F.struct(F.get("__hash", x.bitwiseAND(place).cast("int")).alias("h"), x.bitwiseAND(place).alias("i"))
    )
    out = out.withColumn("__like", F.sort_array(own)).drop("__hash")
    out = out.withColumn("__at", F.sort_array(F.transform(_neighbours("__like", lambda x: x["h"]), lambda x: x["i"]))).drop("__like")
    at = F.col("__at")
    fresh = F.transform(at, lambda p, k: F.coalesce(F.least(F.lit(3), F.get(at, k + 1) - p), F.lit(3)).cast("long"))
    return out.withColumn("n_repeat_words", F.aggregate(fresh, F.lit(0).cast("long"), lambda s, x: s + x)).drop("__at")


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def fit_votes(patterns: list[Row], n_rules: int, rounds: int = 50) -> tuple[float, list[float]]:
    """EM over counted vote patterns: the prior log odds of good, and each rule's log odds of being right.

    A rule is taken to be right equally often on good and bad texts where it votes, better than chance, and
    independently of the others. Patterns are at most three to the number of rules, whatever the number of texts.
    """
    prior, right = 0.7, [0.8] * n_rules
    rows = [(tuple(r)[:n_rules], tuple(r)[n_rules]) for r in patterns]
    for _ in range(rounds):
        good, voted, fit = 0.0, [0.0] * n_rules, [0.0] * n_rules
        for votes, count in rows:
            odds = _logit(prior) + sum(v * _logit(a) for v, a in zip(votes, right, strict=True))
            p = 1 / (1 + math.exp(-odds))
            good += count * p
            for j, v in enumerate(votes):
                if v:
                    voted[j] += count
                    fit[j] += count * (p if v > 0 else 1 - p)
        total = sum(c for _, c in rows)
        if not total:
            break
        prior = min(0.95, max(0.05, good / total))
        right = [min(0.95, max(0.55, f / v)) if v else a for f, v, a in zip(fit, voted, right, strict=True)]
    return _logit(prior), [_logit(a) for a in right]


def judge_quality(docs: DataFrame, text_col: str = "text", votes: tuple[Vote, ...] = VOTES, at_least: float = 0.5) -> DataFrame:
    """Measures, votes and verdict of each row of ``docs``; the text itself is not returned.

    Adds the seven ``MEASURES`` (long), a ``vote_<name>`` of 1, -1 or 0 for each rule, ``base_failed`` (under 50 words,
    or more than half of the words in windows of three that come twice), ``p_good`` and ``kept`` (not failed and
    ``p_good`` at least ``at_least``). The rules' accuracies and the prior come from EM over the votes of all rows.
    The measured rows are written once to the shared folder, without texts.

    Null and empty texts have no words and fail; a very long text is one row, measured by sorting its windows; repeated
    rows are judged alike and each counts; an empty table gives an empty one; other columns pass through, but those named
    like outputs, and ``__text``, ``__words``, ``__lines``, ``__hash``, ``__sorted``, ``__like`` and ``__at``, which are
    used on the way, are replaced. A probability equal to ``at_least`` is kept.
    """
    names = [f"vote_{v.name}" for v in votes]
    table = without(measure(docs, text_col), [*names, "base_failed", "p_good", "kept"])
    cast = {n: F.expr(f"CASE WHEN {v.good} THEN 1 WHEN {v.bad} THEN -1 ELSE 0 END") for n, v in zip(names, votes, strict=True)}
    table = written(table.withColumns(cast), "quality-votes")
    prior, weights = fit_votes(table.groupBy(*names).count().orderBy(*names).collect(), len(names))
    odds = F.lit(prior)
    for n, w in zip(names, weights, strict=True):
        odds = odds + F.col(n) * F.lit(w)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return table.withColumns({"base_failed": failed, "p_good": 1 / (1 + F.exp(-odds))}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= at_least)
    )
