"""Quality rules: one threshold table, compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import column, fresh

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = r"[\x20\x09-\x0D]+"

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it with as was on by at from or are this "
    "der die und das von zu ist den mit im des auf für als ein eine sich nicht "
    "de la le et les un une en du que est pour dans des "
    "el y los se del las por con para su lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """`part / whole` must lie in [least, most] where `whole` reaches `from_whole`."""

    name: str
    part: str
    whole: str
    least: float | None = None
    most: float | None = None
    from_whole: int = 1

    def broken(self, measure: dict[str, Column]) -> Column:
        part, whole = measure[self.part].cast("double"), measure[self.whole].cast("double")
        bad = F.lit(False)
        if self.least is not None:
            bad = bad | (part < whole * self.least)
        if self.most is not None:
            bad = bad | (part > whole * self.most)
        return (measure[self.whole] >= self.from_whole) & bad


RULES = (
    Rule("few_words", "n_words", "one", least=10),
    Rule("repeated_words", "n_repeat_words", "n_words", most=0.2),
    Rule("short_words", "word_chars", "n_words", least=2.0),
    Rule("long_words", "word_chars", "n_words", most=12.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("few_stop_words", "n_stop_words", "n_words", least=0.03, from_whole=60),
    Rule("equal_neighbours", "n_equal_neighbours", "n_words", most=0.25),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.4, from_whole=5),
)
#: Rules of the base verdict.
BASE = ("few_words", "repeated_words")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside a window that occurs twice or more.

    Windows compare by 64-bit hash. Only a text with equal hashes is sorted:
    equal windows stand side by side then, and their starts, in order, cover
    up to `WINDOW` words each.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))),
    )

    def covered(starts):
        gaps = F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.get(starts, k + 1) - p))
        return F.aggregate(gaps, F.lit(0), lambda total, g: total + F.coalesce(g, F.lit(WINDOW)))

    def starts(pairs):
        same = lambda x, k: (x.h == F.get(pairs, k - 1).h) | (x.h == F.get(pairs, k + 1).h)
        found = F.filter(pairs, lambda x, k: F.coalesce(same(x, k), F.lit(False)))
        return let(F.sort_array(F.transform(found, lambda x: x.i)), covered)

    def count(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(pairs, starts))

    return F.when(F.size(words) <= WINDOW, 0).otherwise(let(windows, count))


def _measures(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))

    def of_words(w):
        equal = F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False)))
        return F.struct(
            F.size(w).alias("n_words"),
            F.char_length(F.array_join(w, "")).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop_words"),
            F.size(equal).alias("n_equal_neighbours"),
        )

    def of_lines(x):
        return F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))

    return F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("x"), symbols.alias("n_symbols"))


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` and a struct `quality` (in place of a column so named): measures, base_failed, broken rules, kept.

    One projection, no shuffle, no user function. A null text has no words and
    is not kept. Texts are measured whole; repeated rows are judged alike.
    """
    keep = [c for c in docs.columns if c.lower() != "quality"]
    inner = fresh(docs.columns, "measures")
    measured = docs.withColumn(inner, let(column(text), _measures))
    measure = {
        "one": F.lit(1),
        **{n: F.col(f"{inner}.w.{n}") for n in ("n_words", "word_chars", "n_repeat_words", "n_stop_words", "n_equal_neighbours")},
        **{n: F.col(f"{inner}.x.{n}") for n in ("n_lines", "n_dup_lines")},
        "n_symbols": F.col(f"{inner}.n_symbols"),
    }
    broken = {r.name: r.broken(measure) for r in rules}
    false = F.lit(False)
    base, any_broken = false, false
    for rule in rules:
        any_broken = any_broken | broken[rule.name]
        if rule.name in BASE:
            base = base | broken[rule.name]
    names = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in broken.items())))
    fields = [c.cast("long").alias(n) for n, c in measure.items() if n != "one"]
    verdict = F.struct(*fields, base.alias("base_failed"), names.alias("broken"), (~any_broken).alias("kept"))
    return measured.select(*map(column, keep), verdict.alias("quality"))


def kept_rows(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` that break no rule, with their columns as they were."""
    row, value = "row", "judged_text"
    judged = judge(docs.select(F.struct(*map(column, docs.columns)).alias(row), column(text).alias(value)), value, rules)
    return judged.where("quality.kept").select(f"{row}.*")
