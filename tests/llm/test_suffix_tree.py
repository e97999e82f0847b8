import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from txnflow.llm import suffix_tree as st
from txnflow.llm.queries import QUERIES

END = None


def tokens_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


def brute(rows):
    """(n_tokens, n_known, train_tokens, base_score, score) of (training, text) rows, with plain dictionaries."""
    counts, grams = Counter(), defaultdict(Counter)
    for training, text in rows:
        if training:
            counts.update(tokens_of(text))
    total, kinds = sum(counts.values()), len(counts)
    for training, text in rows:
        own = tokens_of(text) if training else []
        for size in range(2, st.DEPTH + 2):
            for i in range(size - 1, len(own)):
                grams[size][tuple(own[i - size + 1 : i + 1])] += 1
    listed = {g: n for by in grams.values() for g, n in by.items() if n >= st.LEAST_TIMES}
    unknown = (sum(n == 1 for n in counts.values()) + 0.5) / (total + 1) if total else 1.0
    root = lambda w: (1 - unknown) * counts[w] / total if counts[w] else unknown
    kept, after = {}, defaultdict(dict)
    for gram, n in listed.items():
        after[gram[:-1]][gram[-1]] = n

    def chance(context, word):
        while context and context not in kept:
            context = context[1:]
        if not context:
            return root(word)
        of, left = kept[context]
        return after[context].get(word, 0) / (of + st.BORROWED) + left * chance(context[1:], word)

    for context in sorted(after, key=len):
        of = counts[context[0]] if len(context) == 1 else listed.get(context, 0)
        if of < st.LEAST_TIMES:
            continue
        rest = of - sum(after[context].values())
        left = (rest + st.BORROWED) / (of + st.BORROWED)
        gain = rest * math.log(left) if rest else 0.0
        for word, n in after[context].items():
            below = chance(context[1:], word)
            gain += n * math.log((n / (of + st.BORROWED) + left * below) / below)
        if gain >= st.LEAST_GAIN and gain >= st.LEAST_DIVERGENCE * of:
            kept[context] = of, left
    out = []
    for _, text in rows:
        own = tokens_of(text)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own)
        score = sum(math.log10(chance(tuple(own[max(0, i - st.DEPTH) : i]), t)) for i, t in enumerate(own))
        out.append((len(own), sum(counts[t] > 0 for t in own), total, base, score))
    return out, kept, chance


@pytest.mark.parametrize("least", [2, 4, 20])
def test_query_equals_brute_force(spark, sf_dir, monkeypatch, least):
    monkeypatch.setattr(st, "LEAST_TIMES", least)
    monkeypatch.setattr(st, "COUNTED", 20_000)
    if least == 4:  # most codes meet their weights in a join
        monkeypatch.setattr(st, "BROADCAST_CODES", 50)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    training = [zlib.crc32(str(d.doc_id).encode()) % 7 != 2 for d in docs]
    rows = {r.doc_id: r for r in QUERIES["op1_lm_scoring"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    want, kept, _ = brute([(t, d.text) for d, t in zip(docs, training)])
    assert {len(c) for c in kept} >= ({1, 2, 3} if least < 20 else {1})
    for doc, train, (n, known, total, base, score) in zip(docs, training, want):
        r = rows[doc.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not train, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
        assert abs(r.score - score) < 1e-6 * abs(score), doc.doc_id


def test_probabilities_sum_to_one():
    texts = ["the cat sat on the mat", "the cat sat on the hat", "a dog sat"] * 8
    _, kept, chance = brute([(True, t) for t in texts])
    words = {w for t in texts for w in t.split()} | {END, "unheard"}
    assert {len(c) for c in kept} == {1, 2}
    for context in [(), *kept, ("the", "mat"), ("unheard", "sat")]:
        assert abs(sum(chance(context, w) for w in words) - 1) < 1e-9


def test_held_out_texts_score_better_than_by_base_counts(spark):
    rows = QUERIES["op1_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert sum(r.score > r.base_score for r in rows) > 0.95 * len(rows)


TEXTS = [None, "", "a b A c", "a a a", " \t\n", "é x\x0by", "b " * 20_000, "q" * 50_000, "a b c", "z", "a b a b c"]


@pytest.mark.parametrize("least", [2, 4])
def test_small_cases(spark, monkeypatch, least):
    monkeypatch.setattr(st, "LEAST_TIMES", least)
    rows = [(i if i != 3 else None, t, i != 9) for i, t in enumerate(TEXTS)] * 4
    docs = spark.createDataFrame([(i, t, k, 0.5) for i, t, k in rows], "doc_id long, text string, kind boolean, score double")
    got = st.score_texts(docs, F.col("kind")).collect()
    want, _, _ = brute([(k, t) for _, t, k in rows])
    key = lambda r: (r[0] is None, r[0] or 0)
    assert len(got) == len(rows)
    for r, (doc, (n, known, total, base, score)) in zip(sorted(got, key=key), sorted(zip([i for i, _, _ in rows], want), key=key)):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (doc, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and abs(r.score - score) < 1e-6 * abs(score)


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in st.score_texts(docs, F.lit(None).cast("boolean")).collect()}
    assert rows[1].train_tokens == 0 and rows[1].n_known == 0 and rows[1].n_tokens == 3
    assert rows[1].base_score == 0 and rows[1].score == 0
    assert st.score_texts(docs.limit(0), F.lit(True)).count() == 0


def test_what_is_kept_does_not_shrink_with_the_corpus(spark):
    filler = " ".join(f"w{i % 5000}x{i % 7}" for i in range(600_000))
    rows = [(True, "the rare phrase stands here")] * 4 + [(True, filler)] * 2 + [(False, "the rare phrase stands here")]
    docs = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(rows)], "doc_id long, text string, kind boolean")
    got = {r.doc_id: r for r in st.score_texts(docs, F.col("kind")).collect()}
    # Four times in 1.2 million tokens, below 2**-18 of them: 'rare phrase stands here' is all but certain after 'the'.
    assert 4 < got[6].train_tokens * 2.0**-18
    assert got[6].score > -9 > got[6].base_score
