import hashlib
import re

import pytest

from txnflow.llm import decontaminate
from txnflow.llm.decontaminate import cut_spans, drop_contaminated, scan_benchmark
from txnflow.llm.queries import QUERIES


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(texts, items, size=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for text in texts:
        words, hit, own = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    own |= found
        out.append((len(words), len(hit), len(own), hashlib.sha256(",".join(sorted(map(str, own))).encode()).hexdigest()))
    return out


def test_query_equals_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op4_benchmark_decontamination"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert len(got) == len(docs)
    for doc, want in zip(docs, brute([d.text for d in docs], items)):
        r = got[doc.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == want
        assert r.contaminated == (want[1] > 0)
    assert any(r.contaminated for r in got.values())


ITEMS = [(7, "One two, three"), (70, "ONE two three"), (8, None), (9, "  "), (None, "zz"), (1, " ".join(f"w{i}" for i in range(14)))]
TEXTS = [
    None, "", "one TWO-three four one two three", "zz zz", "w0 " + " ".join(f"w{i}" for i in range(14)) + " w3", "three two one",
    " ".join(f"w{i}" for i in range(9)), " ".join(f"w{i}" for i in range(4, 14)), "é one two three", "x" * 100_000 + " one two three",
]


@pytest.mark.parametrize("block", [500_000, 2])
def test_small_cases_in_one_and_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    docs = spark.createDataFrame(list(enumerate(TEXTS)) * 2, "doc_id long, text string").withColumnRenamed("doc_id", "N_WORDS_OF")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = scan_benchmark(docs, bench).collect()
    assert len(got) == 2 * len(TEXTS)
    want = brute(TEXTS, [("" if i is None else str(i), t) for i, t in ITEMS])
    for r in got:
        n, hits, items, _ = want[r["N_WORDS_OF"]]
        assert (r.n_words, len(r.hits), len(r["items"])) == (n, hits, items)


def test_drop_and_cut(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, hits int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 5, 6]
    cut = {r.doc_id: r for r in cut_spans(docs, bench).collect()}
    assert cut[2].text == " four " and cut[0].text is None and cut[5].text == "three two one" and cut[2].hits == 5


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [list(r.hits) for r in scan_benchmark(docs, bench).collect()] == [[]]
    assert scan_benchmark(docs.limit(0), bench).count() == 0
