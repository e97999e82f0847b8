import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from txnflow.llm.packing import ByteTokens, best_configuration, configurations, pack, plan_sequences
from txnflow.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


TEXTS = [
    None, "", " ", "a  b\n\n c\t d", "It's we'll 'd don't 12 3x _y__ ?!", "x<|endoftext|>y", "naïve Œuvre ½ ² ª", "日本 語 x y", "  lead",
    "trail  ", "\x1c\x85\x0b\x0c", "a" * 5000, "word " * 3000, "Éeaux ñ ß ü\r\nz", "á e", "١٢٣ 12", "tab\t\t x\n \n y",
]


def test_ids_equal_the_library(library, spark):
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    tokens = ByteTokens(PATH, 2)
    slow = ByteTokens(PATH, 2)
    slow.fast = None
    assert tokens.fast is not None
    for number, text in enumerate(texts):
        want = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert tokens.ids(text) == struct.pack(f"<{len(want)}I", *want), repr(text)
        if number < 100:
            assert slow.ids(text) == tokens.ids(text)


def check(rows, texts, library, size=1024):
    """Every piece is right, and every sequence is filled from 0 without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // size)))
        at = 0
        for r in own:
            assert r.start == at and (r.length == size or r.piece == 0)
            part = ids[at : at + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence), sum(r.length for r in rows)


def test_query_packs_everything_tightly(spark, sf_dir, library):
    rows = QUERIES["op5_best_fit_packing"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sequences, total = check(rows, texts, library)
    assert sequences <= -(-total // 1024) + 2


def test_small_cases(spark, library):
    docs = spark.createDataFrame([(i, t, "p") for i, t in enumerate(TEXTS)], "doc_id long, text string, PIECE string")
    rows = pack(docs, PATH, size=64).collect()
    check(rows, dict(enumerate(TEXTS)), library, 64)
    assert pack(docs.limit(0), PATH).count() == 0
    same = spark.createDataFrame([(1, "one two")] * 500 + [(None, "x")], "doc_id long, text string")
    rows = pack(same, PATH, size=7).collect()
    assert len(rows) == 501 and len({(r.sequence_id, r.offset) for r in rows}) == 501
    assert len({r.sequence_id for r in rows}) == 251


def test_knapsack_and_program():
    random = np.random.default_rng(3)
    for _ in range(20):
        counts, value = random.integers(0, 3, 9), random.random(9)
        found = best_configuration(value, counts, 9)
        best, tried = 0.0, [(0, 0.0, 0)]
        for i in range(9):
            tried = [(r + k * (i + 1), v + k * value[i], 0) for r, v, _ in tried for k in range(int(counts[i]) + 1) if r + k * (i + 1) <= 9]
        best = max(v for _, v, _ in tried)
        assert np.all(found <= counts) and np.dot(found, np.arange(1, 10)) <= 9
        assert abs(np.dot(found, value) - best) < 1e-9
    counts = np.bincount(random.integers(0, 1024, 20_000), minlength=1024)
    counts[-1] = 0
    covered = sum(x * c for c, x in configurations(counts, 1024))
    assert np.allclose(covered, counts)
    plan = plan_sequences(counts, 1024)
    assert plan.placed == {i + 1: int(n) for i, n in enumerate(counts) if n}
    assert plan.sequences <= np.dot(counts, np.arange(1, 1025)) / 1024 * 1.01 + 2
