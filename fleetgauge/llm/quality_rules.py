"""Quality rules: decision lists learned from labels, applied as Spark conditions.

``text_statistics`` measures texts with built-in functions. ``learn_rules``
covers the labelled rows one rule at a time: a rule grows by the threshold that
gains most, is pruned on rows held back, and is kept while it is precise.
``verdict`` turns the list into one ordered conditional expression.

Defined results: a null or empty text has no words and fails the base rule. A
doc_id that is null or repeated is judged by its own row's text alone. Columns
of the input other than the text are never read. Without labels of both kinds
the list is empty and only the base rule rejects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.session import stored

SYMBOLS = "#*$%&|<>"
WINDOW = 3

RATIOS = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9)
COUNTS = (1, 5, 10, 20, 30, 50, 75, 100, 150, 200, 400, 800, 1600, 5000, 20000)

#: Feature, its value from the statistics, and the thresholds a rule may use.
FEATURES = {
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", RATIOS),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", RATIOS),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", RATIOS),
    "shout_share": ("n_shouts / greatest(word_chars, 1)", RATIOS),
    "mean_word": ("word_chars / greatest(n_words, 1)", (2, 3, 3.5, 4, 5, 6, 7, 8, 9, 10, 12, 15)),
    "n_words": ("n_words", COUNTS),
}


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _words(text: Column) -> Column:
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add word, symbol, line and repetition counts of each text.

    Words are runs without white space. A word counts as repeated if it lies
    in a window of three words that the text holds twice or more. Windows are
    compared by a 64-bit hash: sorted with their places, equal ones are
    neighbours, so the work is n log n within a row and nothing is shuffled.
    Existing columns of these names are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.array_remove(F.split(F.col("_body"), "\n"), "")
    spaced = docs.withColumn("_body", body).withColumn("_words", _words(F.col("_body")))
    windows = spaced.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length("_body") - F.length(_without(F.col("_body"), SYMBOLS))).cast(
                "long"
            ),
            "n_shouts": (F.length("_body") - F.length(F.replace("_body", F.lit("!"), F.lit("")))).cast(
                "long"
            ),
            "_lines": F.filter(lines, lambda x: F.trim(x, F.lit(" \t\x0b\x0c\r")) != ""),
            "_windows": F.expr(
                "sort_array(slice(transform(_words, (w, i) -> struct("
                "xxhash64(w, get(_words, i + 1), get(_words, i + 2)) AS h, i AS i)), "
                f"1, greatest(size(_words) - {WINDOW - 1}, 0)))"
            ),
        }
    )
    repeats = windows.withColumn(
        "_repeats",
        F.expr(
            "sort_array(array_compact(transform(_windows, (x, k) -> if("
            "coalesce(x.h = get(_windows, k - 1).h, false) "
            "OR coalesce(x.h = get(_windows, k + 1).h, false), x.i, NULL))))"
        ),
    )
    counted = repeats.withColumns(
        {
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.expr(
                f"aggregate(_repeats, struct(-{WINDOW} AS last, 0L AS n), (a, i) -> struct("
                f"i AS last, a.n + least({WINDOW}, i - a.last) AS n), a -> a.n)"
            ),
        }
    )
    return counted.drop("_body", "_words", "_lines", "_windows", "_repeats")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature][0])
        return value >= self.threshold if self.at_least else value < self.threshold

    def on_bins(self) -> Column:
        rank = FEATURES[self.feature][1].index(self.threshold) + 1
        bin_of = F.col(f"bin_{self.feature}")
        return bin_of >= rank if self.at_least else bin_of < rank


Rule = tuple[Condition, ...]


def _all(columns: list[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def _any(columns: list[Column]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | c
    return out


def labelled_cells(labelled: DataFrame, bad: Column, key: str) -> DataFrame:
    """Labelled statistics: how many rows of each class lie in each cell of the grid.

    The number of cells is bounded by the grid, however many rows there are.
    A third of the rows, by a hash of their key, is set aside for pruning.
    """
    bins = {
        f"bin_{name}": sum(
            ((F.expr(value) >= t).cast("int") for t in thresholds), F.lit(0)
        )
        for name, (value, thresholds) in FEATURES.items()
    }
    rows = labelled.select(
        *[c.alias(n) for n, c in bins.items()],
        bad.alias("bad"),
        (F.pmod(F.xxhash64(key), F.lit(3)) != 0).alias("grow"),
    )
    return stored(rows.groupBy(*rows.columns).count(), "rule-cells")


def _best_condition(cells: DataFrame, covered: Column) -> tuple[Condition, int, int] | None:
    """The threshold whose side has the largest gain in information on bad rows."""
    from math import log2

    columns = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.col(f"bin_{name}").alias("bin"))
            for name in FEATURES
        ]
    )
    counts = (
        cells.where(covered & F.col("grow"))
        .select(F.inline(columns), "bad", "count")
        .groupBy("feature", "bin")
        .agg(
            F.sum(F.when(F.col("bad"), F.col("count")).otherwise(0)).alias("p"),
            F.sum(F.when(F.col("bad"), 0).otherwise(F.col("count"))).alias("n"),
        )
        .collect()
    )
    by = {name: {} for name in FEATURES}
    for r in counts:
        by[r["feature"]][r["bin"]] = (r["p"], r["n"])
    best = None
    for name, (_, thresholds) in FEATURES.items():
        p_all = sum(p for p, _ in by[name].values())
        n_all = sum(n for _, n in by[name].values())
        if not p_all:
            return None
        before = log2(p_all / (p_all + n_all))
        for rank, threshold in enumerate(thresholds, 1):
            p_up = sum(p for b, (p, _) in by[name].items() if b >= rank)
            n_up = sum(n for b, (_, n) in by[name].items() if b >= rank)
            for at_least, p, n in ((True, p_up, n_up), (False, p_all - p_up, n_all - n_up)):
                if p and p + n < p_all + n_all:
                    gain = p * (log2(p / (p + n)) - before)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, Condition(name, at_least, threshold), p, n)
    return best and best[1:]


def learn_rules(
    labelled: DataFrame,
    bad: Column,
    key: str = "doc_id",
    most_rules: int = 8,
    most_conditions: int = 3,
    precision: float = 0.9,
    support: int = 10,
) -> list[Rule]:
    """An ordered list of rules, each a conjunction that marks bad rows.

    A rule is kept while it is right for ``precision`` of the rows held back
    and covers ``support`` of them; the first that is not ends the list. Each
    step is one aggregation whose result has a row per feature and bin.
    """
    cells = labelled_cells(labelled, bad, key)
    rules: list[Rule] = []
    open_rows = F.lit(True)
    while len(rules) < most_rules:
        rule: Rule = ()
        while len(rule) < most_conditions:
            found = _best_condition(cells, open_rows & _all([c.on_bins() for c in rule]))
            if not found:
                break
            rule += (found[0],)
            if not found[2]:
                break
        if not rule:
            break
        rule, good = _pruned(cells, open_rows, rule, precision, support)
        if not good:
            break
        rules.append(rule)
        open_rows = ~_any([_all([c.on_bins() for c in r]) for r in rules])
    return rules


def _pruned(cells, open_rows, rule: Rule, precision: float, support: int) -> tuple[Rule, bool]:
    """The prefix of a rule that does best on the rows held back."""
    prefixes = [rule[: i + 1] for i in range(len(rule))]
    held = cells.where(open_rows & ~F.col("grow"))
    sums = held.agg(
        *[
            F.coalesce(
                F.sum(
                    F.when(
                        _all([c.on_bins() for c in prefix]) & (F.col("bad") == wanted),
                        F.col("count"),
                    )
                ),
                F.lit(0),
            ).alias(f"{'p' if wanted else 'n'}{i}")
            for i, prefix in enumerate(prefixes)
            for wanted in (True, False)
        ]
    ).first()
    scored = [
        ((sums[f"p{i}"] + 1) / (sums[f"p{i}"] + sums[f"n{i}"] + 2), -i) for i in range(len(prefixes))
    ]
    best = -max(scored)[1]
    p, n = sums[f"p{best}"], sums[f"n{best}"]
    return prefixes[best], p + n >= support and p >= precision * (p + n)


def first_rule(rules: list[Rule]) -> Column:
    """Number of the first rule that fits, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all([c.column() for c in rule]), F.lit(number)).otherwise(out)
    return out


def rules_from(statistics: DataFrame, labels: DataFrame, **options) -> list[Rule]:
    """Learn what marks rows of quality 0 among those that the base rule lets through.

    Other labels count as good, null ones do not count.
    """
    quality = labels.where("quality IS NOT NULL").select(
        F.col("doc_id").alias("_labelled"), (F.col("quality") == 0).alias("_bad")
    )
    labelled = statistics.where(~base_failed()).join(quality, F.col("doc_id") == F.col("_labelled"))
    return learn_rules(labelled, F.col("_bad"), **options)


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    failed = statistics.withColumns({"base_failed": base_failed(), "rule": first_rule(rules)})
    return failed.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Statistics and verdict of every document; texts are measured once."""
    measured = stored(
        text_statistics(docs.select("doc_id", "text")).drop("text"), "rule-statistics"
    )
    judged = judge(measured, rules_from(measured, labels, **options))
    return judged.select("doc_id", *STATISTICS, "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the base rule and the learned list let through.

    Rows are stored with their statistics before any is filtered: a filter
    would otherwise be moved below the statistics and repeat them.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")
    measured = stored(text_statistics(rows).drop("text"), "rule-statistics")
    rules = rules_from(measured.drop("_row"), labels, **options)
    return judge(measured, rules).where("kept").select("_row.*")
