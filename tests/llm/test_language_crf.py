import itertools
import zlib

import numpy as np
import pytest

from txnflow.llm import language_crf as crf
from txnflow.llm.queries import QUERIES


def test_posteriors_equal_the_sum_over_all_paths():
    random = np.random.default_rng(1)
    labels = ["a", "b", "c"]
    model = crf.LanguageModel(labels, np.zeros((crf.BUCKETS, 3)), random.normal(size=(3, 3)), random.normal(size=3))
    sizes = [1, 5, 2, 6]
    emissions = random.normal(size=(sum(sizes), 3)) * 2
    first = np.zeros(sum(sizes), bool)
    first[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = True
    got, at = model.posteriors(emissions, first), 0
    for size in sizes:
        own, want = emissions[at : at + size], np.zeros((size, 3))
        for path in itertools.product(range(3), repeat=size):
            log = model.start[path[0]] + sum(own[t, p] for t, p in enumerate(path))
            log += sum(model.transitions[a, b] for a, b in zip(path, path[1:]))
            for t, p in enumerate(path):
                want[t, p] += np.exp(log)
        assert np.allclose(got[at : at + size], want / want.sum(1, keepdims=True))
        at += size


def test_gradient_equals_differences():
    random = np.random.default_rng(2)
    emission, gold, step = random.normal(size=(2, 4, 3)), random.integers(3, size=(2, 4)), random.normal(size=(3, 3))

    def likelihood(e, a):
        total = 0.0
        for lane in range(2):
            score = lambda p: sum(e[lane, t, x] for t, x in enumerate(p)) + sum(a[x, y] for x, y in zip(p, p[1:]))  # noqa: B023, E731
            every = [score(p) for p in itertools.product(range(3), repeat=4)]
            total += score(gold[lane]) - np.log(np.sum(np.exp(every)))
        return total

    by_word, by_pair = crf._gradient(emission, gold, step)
    for i in np.ndindex(2, 4, 3):
        moved = emission.copy()
        moved[i] += 1e-6
        assert abs((likelihood(moved, step) - likelihood(emission, step)) / 1e-6 - by_word[i]) < 1e-4
    for i in np.ndindex(3, 3):
        moved = step.copy()
        moved[i] += 1e-6
        assert abs((likelihood(emission, moved) - likelihood(emission, step)) / 1e-6 - by_pair[i]) < 1e-4


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return crf.train(docs.where(crf.remainder("doc_id", 3) != 1))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op7_language_id"](spark, folder).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_words(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    pick = lambda lang: next(crf.words_of(d.text)[20:60] for d in docs if d.lang == lang and len(crf.words_of(d.text)) > 90)
    words = pick("en") + pick("de") + pick("es")
    found = [x for _, x in crf.label_words(model, " ".join(words))]
    want = ["en"] * 40 + ["de"] * 40 + ["es"] * 40
    assert sum(a == b for a, b in zip(found, want)) >= 110
    assert np.all(np.diag(model.transitions) == model.transitions.max(1))


def test_odd_texts_other_columns_and_empty_tables(spark, model):
    texts = [None, "", " 12 34 ?!", "²", "the", "Ünd " * 30_000, "x" * 100_000, "日本語"]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)] * 2, "doc_id long, text string, LANG_PRED string")
    got = crf.label_documents(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "lang_score"]
    rows = got.collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id < 4) and 0 <= r.lang_score <= 1
    kept = crf.keep_known(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} <= {4, 5, 6, 7}
    assert crf.label_documents(docs.limit(0), model).count() == 0
    assert crf.train(docs.select("doc_id", "text", docs.text.alias("lang")).limit(0)) is None
    assert {r.lang_pred for r in crf.label_documents(docs, None).collect()} == {"und"}


def test_small_cache_changes_no_label(model, monkeypatch):
    texts = ["the house and of " * 5, "der die und von " * 5, "la casa y de los " * 5] * 3
    want = crf.Labeller(model).label(texts)
    monkeypatch.setattr(crf, "CACHE_WORDS", 1)
    monkeypatch.setattr(crf, "CHUNK_WORDS", 10)
    got = crf.Labeller(model).label(texts)
    assert got[0] == want[0] and np.allclose(got[1], want[1])
