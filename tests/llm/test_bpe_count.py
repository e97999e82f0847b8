import public_tokenizers
import pytest
import sentencepiece

from txnflow.llm.bpe_count import PieceMerges, count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "   a", "a  b\n\tc<s> </s><unk>  é中 ", "\n\n\r\n", "Ünïcödé 😀😀 ▁ x", "aaaaaaaaaaaaaaaa" * 20,
    "word " * 3000, "ab" * 4000, "end of 　 line\x00\x01", "▁▁ ▁", "The quick brown fox.\nDer schnelle Fuchs, naïve!",
    "<0x0A>", "日本語のテキスト 中文", "tab\tand sep", "    indented\n        code(x, y)", "é combining",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library(spark, library, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = count_tokens(docs, MODEL).collect()
    assert len(got) == 200
    for row in got:
        assert (row.n_bytes, row.n_tokens) == (len(row.text.encode()), len(library.encode(row.text)))
        assert row.over_limit == (row.n_tokens > 4096)


def test_odd_texts(library):
    merges = PieceMerges(MODEL)
    for text in TEXTS:
        assert merges.count(text or "") == len(library.encode(text or "")), repr(text)


def test_cache_limit_changes_nothing(library, monkeypatch):
    from txnflow.llm import bpe_count

    monkeypatch.setattr(bpe_count, "CACHE_WORDS", 2)
    merges = PieceMerges(MODEL)
    text = "one two three one two three four one"
    assert merges.count(text) == len(library.encode(text))


def test_nulls_repeats_clashing_names_and_empty_table(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a b", None), (2, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS string")
    got = count_tokens(docs, MODEL)
    assert got.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(((r.doc_id or 0), r.n_bytes, r.n_tokens) for r in got.collect()) == [(0, 3, 2), (1, 0, 0), (1, 0, 0), (2, 0, 0)]
    assert count_tokens(docs.limit(0), MODEL).count() == 0
