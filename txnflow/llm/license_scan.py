"""License scans: ordered signatures, tried only where their keyword stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import column, fresh
from txnflow.llm.license_rules import BASE, Signature, anchored, reach, signatures
from txnflow.llm.quality import let

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rules(rules: list[Signature]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(s.keyword).alias("keyword"),
                F.lit(anchored(s)).alias("pattern"),
                F.lit(s.label).alias("label"),
                F.lit(s.tier).alias("tier"),
                F.lit(s.score).alias("score"),
                F.lit(s in BASE).alias("base"),
            )
            for s in rules
        )
    )


def _finds(words: Column, rules: list[Signature]) -> Column:
    """The finds around each keyword in a text's words, keywords in their order."""
    keywords = sorted({s.keyword for s in rules})
    most_before, most_after = reach(rules)
    places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(keywords), i)), lambda i: i.isNotNull())

    def at(i):
        first = F.greatest(i - most_before, F.lit(0))
        around = F.concat_ws(
            " ",
            F.slice(words, first + 1, i - first),
            F.concat(F.lit("@"), F.get(words, i)),
            F.slice(words, i + 2, most_after),
        )

        def tried(context):
            def find(rule):
                hit = F.regexp_substr(context, rule.pattern)
                start = i - (F.size(F.split(F.split_part(hit, F.lit("@"), F.lit(1)), " ")) - 1)
                return F.when(
                    hit.isNotNull(),
                    F.struct(
                        start.alias("start"),
                        (-(start + F.size(F.split(hit, " ")))).alias("minus_end"),
                        rule.tier.alias("tier"),
                        rule.label.alias("label"),
                        rule.score.alias("score"),
                        rule.base.alias("base"),
                    ),
                )

            own = F.filter(_rules(rules), lambda r: r.keyword == F.get(words, i))
            return F.array_compact(F.transform(own, find))

        return let(around, tried)

    return F.transform(places, at)


def _in_order(finds: Column) -> Column:
    """Distinct finds by start, longest first, lowest tier first."""
    return let(F.array_sort(F.flatten(finds)), lambda own: F.filter(own, lambda x, k: (k == 0) | (x != F.get(own, k - 1))))


def _kept(finds: Column, rules: list[Signature]) -> Column:
    """Finds that lie in no other of the same or a lower tier.

    A find has its keyword inside it. Two finds that share a word have keywords
    no further apart than the rules reach to both sides, so that many keywords
    to either side are looked at, whatever the length of the text.
    """
    wide = sum(reach(rules))

    def alone(around, own):
        def free(find):
            holds = lambda e: (e < find) & (e.minus_end <= find.minus_end) & (e.tier <= find.tier)
            return ~F.exists(around, lambda others: F.exists(others, holds))

        return F.filter(own, free)

    def place(own, k):
        first = F.greatest(k - wide, F.lit(0))
        return let(F.slice(finds, first + 1, F.lit(2 * wide + 1)), lambda around: alone(around, own))

    return F.transform(finds, place)


def scan_licenses(docs: DataFrame, text: str = "text", rules: list[Signature] | None = None) -> DataFrame:
    """`docs` and a struct `licenses` (in place of a column so named).

    Fields: n_words; base, the finds of the base phrases; finds, those of the
    other rules without suppressed ones; both arrays of structs with start,
    end (in words), label, score. One projection without shuffle; a text
    without any keyword is only split into words. A null text has no words and
    no finds. Texts are scanned whole.
    """
    rules = signatures() if rules is None else rules
    keep = [c for c in docs.columns if c.lower() != "licenses"]
    keywords = "|".join(sorted({s.keyword for s in rules}))
    value = F.coalesce(column(text), F.lit(""))
    words = F.array_remove(F.split(value, SEPARATORS), "")
    plain = F.array_remove(F.split(F.translate(value, UPPER, LOWER), SEPARATORS), "")
    found = let(plain, lambda w: _finds(w, rules))
    span = lambda x: F.struct(x.start, (-x.minus_end).alias("end"), x.label, x.score)

    def result(finds):
        return F.struct(
            F.transform(F.filter(_in_order(finds), lambda x: x.base), span).alias("base"),
            F.transform(_in_order(_kept(finds, rules)), span).alias("finds"),
        )

    gated = F.when(value.rlike(f"(?i)(?:{keywords})"), found)
    inner = fresh(docs.columns, "found")
    counted = docs.withColumn(inner, F.struct(F.size(words).cast("long").alias("n_words"), let(gated, result).alias("r")))
    licenses = F.struct(
        F.col(f"{inner}.n_words"),
        F.coalesce(F.col(f"{inner}.r.base"), F.array()).alias("base"),
        F.coalesce(F.col(f"{inner}.r.finds"), F.array()).alias("finds"),
    )
    return counted.select(*map(column, keep), licenses.alias("licenses"))


def label_list(*arrays: str) -> Column:
    """Distinct labels of some arrays of finds, sorted and comma-joined."""
    labels = F.flatten(F.array(*(F.col(f"{a}.label") for a in arrays)))
    return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))


def score(*arrays: str) -> Column:
    """The highest score of some arrays of finds, or 0."""
    scores = F.flatten(F.array(*(F.col(f"{a}.score") for a in arrays)))
    return F.coalesce(F.array_max(scores), F.lit(0.0))
