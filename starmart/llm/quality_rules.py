"""Quality rules: a decision list learned by sequential covering, applied as Spark conditional expressions."""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import one_row_each

SPACE = r"[ \t\n\x0B\f\r]+"
WINDOW = 5
SAMPLE = 20_000
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks"]


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def feature_columns() -> dict[str, Column]:
    return {
        **{name: F.col(name).cast("double") for name in STATISTICS},
        "mean_word": _share("word_chars", "n_words"),
        "symbol_share": _share("n_symbols", "word_chars"),
        "upper_share": _share("n_upper", "word_chars"),
        "mark_share": _share("n_marks", "n_words"),
        "repeat_share": _share("n_repeat_words", "n_words"),
    }


def statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (doc_id by default) and STATISTICS of the whole text; null text has no words.

    Repeats within a text are found inside the row: five-word windows are hashed, and only where some hash comes twice
    are they sorted with their positions. Nothing is shuffled, and a long text costs n log n.
    """
    keep = keep or ["doc_id"]
    text = F.coalesce("text", F.lit(""))
    split = docs.select(*keep, text.alias("_text")).select(
        *keep,
        F.array_remove(F.split("_text", SPACE), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")).alias("_lines"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
        F.regexp_count("_text", F.lit(r"[!?]")).cast("bigint").alias("n_marks"),
    )
    rest = [*keep, "n_symbols", "n_upper", "n_marks"]
    n = F.size("_words")
    window = lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW)))
    counted = split.select(
        *rest,
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).otherwise(F.array().cast("array<bigint>")).alias("_hashes"),
    )
    rest += ["n_words", "word_chars", "n_dup_lines"]
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    pairs = F.sort_array(F.transform("_hashes", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    ordered = counted.select(*rest, F.when(repeats, pairs).alias("_pairs"))
    same = lambda x, i: F.coalesce(F.get("_pairs", i)["h"] == x["h"], F.lit(False))
    twice = F.filter("_pairs", lambda x, i: same(x, i - 1) | same(x, i + 1))
    placed = ordered.select(*rest, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_places"))
    # each window adds the words between it and the one before, at most its own five
    added = F.transform("_places", lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), x - F.get("_places", k - 1))))
    covered = F.aggregate(added, F.lit(0).cast("bigint"), lambda a, x: a + x)
    done = placed.select(*rest, F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"))
    # a filter on a statistic must not be pushed below: there it would compute arrays again for each of their elements
    return done.select(*keep, F.inline(F.array(F.struct(*STATISTICS))))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


# ---- learning


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.feature] > self.threshold if self.above else values[self.feature] <= self.threshold

    def column(self) -> Column:
        value = feature_columns()[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    for condition in rule:
        rows = rows & condition.holds(values)
    return rows


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, steps: int, longest: int) -> Rule:
    """Adds the condition of most information gain until only bad rows are covered or nothing gains."""
    rule: Rule = ()
    while len(rule) < longest:
        p, n = (rows & bad).sum(), (rows & ~bad).sum()
        if not p or not n:
            break
        best, gain = None, 1e-9
        for feature, all_values in values.items():
            for threshold in np.unique(np.quantile(all_values[rows], np.linspace(0, 1, steps + 1)[1:-1])).tolist():
                above = all_values > threshold
                for side in (True, False):
                    at = rows & (above if side else ~above)
                    q, m = (at & bad).sum(), (at & ~bad).sum()
                    if q and (own := q * (np.log2(q / (q + m)) - np.log2(p / (p + n)))) > gain:
                        best, gain = Condition(feature, side, threshold), own
        if best is None:
            break
        rule = (*rule, best)
        rows = rows & best.holds(values)
    return rule


def learn(values: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, least_rows: int = 5, steps: int = 40, longest: int = 4, most_rules: int = 16) -> list[Rule]:
    """Sequential covering: grow a conjunction on two thirds of the rows not yet covered, prune its last conditions on the
    other third, keep it while it is right for at least ``precision`` of what it covers there."""
    rest, rules = np.ones(len(bad), bool), []
    third = np.random.default_rng(11).random(len(bad)) < 1 / 3
    while len(rules) < most_rules and (rest & bad).sum() >= least_rows:
        rule = _grow(values, bad, rest & ~third, steps, longest)
        worth = []
        for n in range(1, len(rule) + 1):
            at = _covered(rule[:n], values, rest & third)
            p, m = (at & bad).sum(), (at & ~bad).sum()
            worth.append(((p - m) / max(p + m, 1), p, m))
        if not worth:
            break
        best = max(range(len(worth)), key=lambda i: (worth[i][0], -i))
        _, p, m = worth[best]
        at = _covered(rule[: best + 1], values, rest)
        if p < precision * (p + m) or (at & bad).sum() < max(least_rows, precision * at.sum()):
            break
        rules.append(rule[: best + 1])
        rest &= ~at
    return rules


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **settings) -> list[Rule]:
    """Rules for poor quality (label quality = 0) from at most ``sample`` labelled documents, those whose hashed doc_id comes first.

    Labels that share a doc_id count with the worst, documents that share one count once; rows with a null id or label are left out. Documents that the
    base rule drops anyway are not learned from. Without labelled rows there are no rules.
    """
    marked = labels.dropna(subset=["doc_id", "quality"]).groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` ids are broadcast, and as many rows of numbers collected, one for each id
    texts = one_row_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "text", "_quality")
    known = statistics(texts, ["_quality"]).filter(~base_failed())
    rows = sorted(tuple(r) for r in known.select((F.col("_quality") == 0).alias("bad"), *(c.alias(k) for k, c in feature_columns().items())).collect())
    if not rows:
        return []
    table = np.array(rows, float)
    return learn({k: table[:, i + 1] for i, k in enumerate(feature_columns())}, table[:, 0] > 0, **settings)


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """The decision list as ordered conditions: kept, and the text of the rule that decided (null: none)."""
    kept, why = F.lit(True), F.lit(None).cast("string")
    for rule in reversed(rules):
        met = functools.reduce(operator.and_, (c.column() for c in rule))
        kept, why = F.when(met, F.lit(False)).otherwise(kept), F.when(met, F.lit(" and ".join(map(str, rule)))).otherwise(why)
    return kept, why


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, statistics, base_failed, kept and rule per document row. Null and empty texts fail the base rule."""
    kept, why = verdict(rules)
    return statistics(docs).withColumn("base_failed", base_failed()).select(
        "*", (~F.col("base_failed") & kept).alias("kept"), F.when(~F.col("base_failed"), why).alias("rule")
    )
