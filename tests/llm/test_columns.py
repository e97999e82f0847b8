"""Columns beside the text keep their names, types and values, whatever these are."""

import public_tokenizers
import pytest

from txnflow.llm import bpe_count, decontaminate, jaccard_join, language_crf, license_scan, quality, quote_threads, source_mix, url_filter

NAMES = ["doc_id", "text", "a.b", "row", "m", "x y"]
SCHEMA = "doc_id long, text string, `a.b` int, row string, m map<string,int>, `x y` array<int>"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, f"the words of text number {k} are here for all of us to read and to keep", k, "r", {"k": k}, [k]) for k in range(3)]
    rows.append((9, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([("i1", "nothing of this is in any text that stands here at all")], "item_id string, text string")


def others(df):
    return sorted((r["doc_id"], r["a.b"], r["row"], str(r["m"]), str(r["x y"])) for r in df.collect())


def test_operators_keep_other_columns(docs, benchmark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    mixed = source_mix.mix_sources(docs, source="row")
    found = {
        "judge": quality.judge(docs),
        "scan_licenses": license_scan.scan_licenses(docs),
        "count_tokens": bpe_count.count_tokens(docs, model),
        "scan_benchmark": decontaminate.scan_benchmark(docs, benchmark),
        "label_documents": language_crf.label_documents(docs, None),
        "filter_urls": url_filter.filter_urls(docs, "text"),
        "mix_sources": mixed,
    }
    for name, df in found.items():
        assert set(NAMES) <= set(df.columns), name
        assert others(df) == others(docs), name


def test_filters_keep_rows_as_they_are(docs, benchmark):
    for kept in (quality.kept_rows(docs), decontaminate.drop_contaminated(docs, benchmark), decontaminate.cut_spans(docs, benchmark), jaccard_join.keep_one(docs)):
        assert kept.columns == NAMES and set(others(kept)) <= set(others(docs)) and kept.count() >= 1


def test_threads_beside_maps_and_dots(spark):
    rows = [(1, k, "user", f"line {k}", {"k": k}, k) for k in range(3)] * 2
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, m map<string,int>, `a.b` int")
    found = quote_threads.link_quotes(messages)
    assert found.columns == ["conv_id", "turn", "role", "text", "m", "a.b", "thread"]
    assert sorted((r["turn"], r["m"]["k"], r["a.b"]) for r in found.collect()) == [(k, k, k) for k in range(3)]
