import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnflow.llm.queries import QUERIES
from txnflow.llm.source_mix import fitted, mix_sources, repeated


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    free, rest = set(names), float(sum(sizes.values()))
    while rest > 1e-9 and free:
        whole = sum(weight[s] for s in free)
        for s in free:
            target[s] += rest * weight[s] / whole
        rest = sum(max(0.0, target[s] - most * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= most * sizes[s]:
                target[s] = float(most * sizes[s])
                free.discard(s)
    return target


def check(rows, docs, most=3):
    """Sizes, targets, whole copies, and words taken near the target."""
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += words(text)
    targets = plain_targets(sizes, most=most)
    want = Counter((d, words(t), sizes[s], round(targets[s], 4)) for d, t, s in docs)
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 4)) for r in rows) == want
    taken, lengths = Counter(), defaultdict(list)
    for r in rows:
        assert r["taken"] == 0 if not r["size"] else r["taken"] % r["size"] == 0 and 0 <= r["taken"] <= most * r["size"]
        taken[r["source_size"], round(r["target"], 4)] += r["taken"]
        lengths[r["source_size"], round(r["target"], 4)].append(r["size"])
    for (size, target), got in taken.items():
        alike = sum(1 for s in sizes if sizes[s] == size and round(targets[s], 4) == target)
        assert abs(got - alike * target) <= alike * max(1, max(lengths[size, target])), (size, target, got)
    return taken


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), min_size=1, max_size=5), st.integers(0, 300))
def test_fitted_is_as_near_as_any_choice(counts, budget):
    sizes = np.array(sorted(counts))
    held = np.array([counts[s] for s in sizes.tolist()])
    taken = fitted(sizes, held, budget)
    assert ((taken >= 0) & (taken <= held)).all()
    sums = {sum(n * s for n, s in zip(ns, sizes.tolist())) for ns in product(*(range(c + 1) for c in held.tolist()))}
    assert abs(int(taken @ sizes) - budget) == min(abs(s - budget) for s in sums)


def test_fitted_hits_large_budgets():
    rng = np.random.default_rng(3)
    sizes = np.unique(rng.integers(3, 20_000, 4000))
    counts = rng.integers(1, 500, len(sizes))
    whole = int((sizes * counts).sum())
    least = int(sizes[0])
    for budget in (1, least - 1, least, whole // 3, whole // 2 + 1, whole - least, whole - 1, whole, whole + 9):
        taken = fitted(sizes, counts, budget)
        assert ((taken >= 0) & (taken <= counts)).all()
        near = {1: 0, least - 1: least, whole - 1: whole, whole + 9: whole}
        assert int(taken @ sizes) == near.get(budget, budget)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_plain_sums(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = [r.asDict() for r in QUERIES["op11_source_mix"](spark, f"/root/testdata/{sf}").collect()]
    taken = check(rows, docs)
    if sf == "sf0.01":  # 50 documents a source: as good as every rest is met to the word
        assert all(abs(got - target) < 2 for (_, target), got in taken.items())
    again = [r.asDict() for r in QUERIES["op11_source_mix"](spark, f"/root/testdata/{sf}").collect()]
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_odd_rows(spark):
    docs = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", None), (None, "q " * 5000, None), (4, "one", "é"), (5, " \t\n", "z")]
    docs += [(9, "same text here", "x")] * 7 + [(10 + k, "w " * (k % 5), "y") for k in range(40)]
    df = spark.createDataFrame([(*d, {"k": "v"}, 1) for d in docs], "doc_id long, text string, source string, `a.b` map<string,string>, mix int")
    out = mix_sources(df)
    assert out.columns == ["doc_id", "text", "source", "a.b", "mix", "mix_"]
    rows = [{"doc_id": r["doc_id"], **r["mix_"].asDict()} for r in out.collect()]
    check(rows, docs)
    emitted = repeated(out, "mix_")
    assert emitted.columns == df.columns
    assert emitted.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] == sum(r["taken"] for r in rows)
    assert repeated(out, "mix_").count() == sum(r["copies"] for r in rows)


def test_weights_bounds_and_no_rows(spark):
    docs = [(k, "w " * (1 + k % 9), "abc"[k % 3] if k % 7 else "d") for k in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    for weights, most in [((1,), 1), ((1, 100), 2), ((5, 2, 1), 3)]:
        rows = [r["mix"].asDict() for r in mix_sources(df, weights=weights, most=most).collect()]
        sizes = Counter()
        for _, text, source in docs:
            sizes[source] += words(text)
        targets = plain_targets(sizes, weights, most)
        for s in sizes:
            own = [r for r in rows if r["source_size"] == sizes[s] and abs(r["target"] - targets[s]) < 1e-6]
            assert abs(sum(r["taken"] for r in own) - targets[s]) < 1
    assert mix_sources(df.limit(0)).collect() == []
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None)], df.schema)
    assert [r["mix"]["taken"] for r in mix_sources(empty).collect()] == [0, 0]
