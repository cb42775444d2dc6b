"""Weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides.

Only DataFrame functions touch rows. Votes are summed into a table of vote patterns, which has at most
3 ** len(RULES) rows whatever the corpus; the estimation runs over that table, and its result goes back
into the plan as literal log-odds, so no row is joined or shuffled for the verdict.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.names import private

#: Characters that part words, and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """Votes bad (-1) where `bad` holds, else good (1) where `good` holds, else abstains (0).

    A condition that is null, as any about the share of nothing, does not hold.
    """

    name: str
    bad: Column | None = None
    good: Column | None = None

    def vote(self) -> Column:
        bad = F.lit(False) if self.bad is None else self.bad
        good = F.lit(False) if self.good is None else self.good
        return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))


def rules() -> list[Rule]:
    """The voting rules over `text_measures`.

    Most look for one defect and abstain without it, for a text free of one defect may have another.
    """
    symbols, upper = _share("n_symbols", "word_chars"), _share("n_upper", "word_chars")
    repeated, short = _share("n_repeat_words", "n_words"), _share("n_short", "n_words")
    length, lines = _share("word_chars", "n_words"), _share("n_dup_lines", "n_lines")
    return [
        Rule("symbols", bad=symbols >= 0.05),
        Rule("shouting", bad=upper >= 0.25),
        Rule("exclaims", bad=_share("n_exclaims", "n_words") >= 0.15),
        Rule("repeated_words", bad=repeated >= 0.30),
        Rule("repeated_lines", bad=lines >= 0.30),
        Rule("few_short_words", bad=short < 0.05),
        Rule("word_length", bad=(length < 2.0) | (length > 12.0)),
        Rule("digits", bad=_share("n_digits", "word_chars") >= 0.25),
        Rule("prose", good=(short >= 0.15) & (symbols <= 0.02) & (upper <= 0.12)),
        Rule("varied", good=(repeated <= 0.10) & (lines <= 0.10) & (symbols <= 0.02) & (upper <= 0.12)),
    ]


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_upper", "n_exclaims", "n_digits", "n_short", "n_lines", "n_dup_lines", "n_repeat_words",
)


def text_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` without `text`, with counts over each whole text; null is the text without characters.

    n_words, word_chars (code points in words), n_symbols, n_lines and n_dup_lines (lines with a word;
    those equal to an earlier one), n_repeat_words (words inside a window of three that occurs twice
    or more in the text), n_upper, n_exclaims, n_digits, n_short (words of up to three characters).
    Windows are told apart by their 64-bit hashes. Columns of those names are replaced. A text costs
    n log n in its words; nothing leaves its row. An empty table stays empty.
    """
    rest = [c for c in df.columns if c.lower() not in (text.lower(), *MEASURES)]
    w, whole, lined, windows, ordered, placed_at = private(df, "_words", "_text", "_lines", "_windows", "_sorted", "_placed")
    split = df.select(*rest, F.coalesce(F.col(text), F.lit("")).alias(whole)).withColumn(
        w, F.array_remove(F.split(whole, SPACE), "")
    )
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    left = lambda pattern: F.length(whole) - F.length(F.regexp_replace(whole, pattern, ""))
    n = F.size(w)
    counted = split.select(
        *rest,
        w,
        n.cast("bigint").alias("n_words"),
        F.length(F.regexp_replace(whole, SPACE, "")).cast("bigint").alias("word_chars"),
        left("[#*$%&|<>]+").cast("bigint").alias("n_symbols"),
        left(r"\p{Lu}+").cast("bigint").alias("n_upper"),
        left("!+").cast("bigint").alias("n_exclaims"),
        left("[0-9]+").cast("bigint").alias("n_digits"),
        lines.alias(lined),
        F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("bigint").alias("n_short"),
        F.when(
            n >= 3,
            F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
        ).alias(windows),
    ).withColumn(ordered, F.sort_array(windows))
    # Few texts repeat a window, so positions are sorted only where neighbours in the sorted hashes agree.
    repeats = F.exists(
        F.sequence(F.lit(1), F.size(ordered) - 1), lambda i: F.get(ordered, i) == F.get(ordered, i - 1)
    )
    placed = counted.withColumn(
        placed_at,
        F.when(
            (F.size(ordered) >= 2) & F.when(F.size(ordered) >= 2, repeats).otherwise(False),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twice = F.filter(
        placed_at,
        lambda x, i: (x["h"] == F.get(placed_at, i - 1)["h"]) | (x["h"] == F.get(placed_at, i + 1)["h"]),
    )
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return placed.select(
        *rest,
        "n_words", "word_chars", "n_symbols", "n_upper", "n_exclaims", "n_digits", "n_short",
        F.size(lined).cast("bigint").alias("n_lines"),
        (F.size(lined) - F.size(F.array_distinct(lined))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col(placed_at).isNotNull(), F.size(covered)).otherwise(0).cast("bigint").alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class LabelModel:
    """The share of good texts taken for granted, and each rule's accuracy: P(its vote is right | it votes)."""

    balance: float
    accuracies: tuple[float, ...]

    def posterior(self, votes: list[Column]) -> Column:
        """P(good | votes), as an expression of literals; the balance where every rule abstains."""
        odds = F.lit(math.log(self.balance / (1 - self.balance)))
        for vote, a in zip(votes, self.accuracies, strict=True):
            odds = odds + vote.cast("double") * math.log(a / (1 - a))
        return 1 / (1 + F.exp(-odds))


#: The accuracy that estimation starts from, held to by so many votes, and the range of estimates.
START, START_VOTES, LEAST, MOST = 0.8, 10.0, 0.55, 0.99


def fit_label_model(
    patterns: list[tuple[tuple[int, ...], int]], n_rules: int, balance: float = 0.5, rounds: int = 50
) -> LabelModel:
    """Expectation-maximisation over (votes, number of texts with them).

    Rules are taken to err independently and to abstain without regard to the class; `balance` is
    given, not estimated, so that a rare defect is not explained away. Sums are taken in the order of the
    patterns, so the result does not depend on how Spark dealt the rows. A rule without votes keeps
    the starting accuracy.
    """
    accuracies = [START] * n_rules
    patterns = sorted(patterns)
    for _ in range(rounds):
        right, cast = [START * START_VOTES] * n_rules, [START_VOTES] * n_rules
        for votes, n in patterns:
            odds = math.log(balance / (1 - balance))
            odds += sum(v * math.log(a / (1 - a)) for v, a in zip(votes, accuracies, strict=True))
            good = 1 / (1 + math.exp(-odds))
            for j, vote in enumerate(votes):
                if vote:
                    right[j] += n * (good if vote == 1 else 1 - good)
                    cast[j] += n
        accuracies = [min(max(r / c, LEAST), MOST) for r, c in zip(right, cast, strict=True)]
    return LabelModel(balance, tuple(accuracies))


def judged(measures: DataFrame, threshold: float = 0.5) -> DataFrame:
    """`measures` with `quality_posterior`, `base_failed` and `kept`.

    `base_failed` is the base rule (fewer than 50 words, or over half of them in repeated windows); such a text votes
    like any other but is never kept. A text is kept if the posterior reaches `threshold`. `measures`
    is read twice: pass a stored table. Empty texts fail the base rule; an empty table stays empty.
    """
    named = rules()
    votes = [r.vote().alias(f"v{i}") for i, r in enumerate(named)]
    counted = measures.select(*votes).groupBy(*[f"v{i}" for i in range(len(named))]).count()
    # at most 3 ** len(rules) rows, counted by Spark before they come here
    patterns = [(tuple(row)[:-1], row["count"]) for row in counted.collect()]
    model = fit_label_model(patterns, len(named))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measures.withColumn("base_failed", failed)
        .withColumn("quality_posterior", model.posterior([r.vote() for r in named]))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality_posterior") >= threshold))
    )
