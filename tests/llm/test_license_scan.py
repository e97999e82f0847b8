import re
import time

import pytest
from pyspark.sql import functions as F

from txnflow.llm.license_rules import AFTER, BASE, BEFORE, Signature, anchored, reach, signatures
from txnflow.llm.license_scan import scan_licenses
from txnflow.llm.queries import QUERIES

RULES = signatures()
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base(text):
    words = words_of(text)
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({x for _, x in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def brute_finds(text):
    """Kept finds by comparing all with all."""
    words, found = words_of(text), set()
    for i, word in enumerate(words):
        for s in RULES:
            if s.keyword == word:
                context = " ".join([*words[max(0, i - BEFORE) : i], "@" + word, *words[i + 1 : i + 1 + AFTER]])
                hit = re.search(anchored(s), context)
                if hit:
                    start = i - (len(hit[0].split("@")[0].split(" ")) - 1)
                    found.add((start, -(start + len(hit[0].split(" "))), s.tier, s.label, s.score, s in BASE))
    order = sorted(found)
    kept = [f for k, f in enumerate(order) if not any(e[1] <= f[1] and e[2] <= f[2] for e in order[:k])]
    return {(f[0], -f[1], f[3]) for f in kept}


TEXTS = [
    None, "", "no words of law here", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0. All rights reserved.", "Released under the MIT License.\n\nAll Rights\nReserved cc by cc by sa 4.0",
    "SPDX-License-Identifier: GPL-2.0-or-later", "spdx license identifier apache 2.0 apache", "ALL  RIGHTS -- reserved é cc_by cc\x00by",
    "permission is hereby granted, free of charge, to any person", "general public license general public license", "mit bsd isc general cc rights",
    "x " * 50_000 + "copyright (c) 2019 2021 and all rights reserved", "all rights reserved " * 300,
]


def test_small_cases(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) * 2, "doc_id long, text string")
    rows = scan_licenses(docs).collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        n, places, first, last, labels = base(TEXTS[r.doc_id])
        starts = [x.start for x in r.licenses.base]
        assert (r.licenses.n_words, len(starts), min(starts, default=None), max(starts, default=None)) == (n, places, first, last)
        assert ",".join(sorted({x.label for x in r.licenses.base})) == labels
        assert {(x.start, x.end, x.label) for x in r.licenses.finds} == brute_finds(TEXTS[r.doc_id]), TEXTS[r.doc_id][:80]
    found = {r.doc_id: {x.label for x in r.licenses.finds} for r in rows}
    assert found[3] == {"cc-by-nc-4.0"} and found[4] == {"gpl-3"} and found[5] == {"apache-2.0", "reserved"}
    assert found[7] == {"gpl-2.0"} or "gpl-2" in found[7]


def test_query_equals_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op8_license_scans"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        r = got[doc.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(doc.text)
        kept = {x for _, _, x in brute_finds(doc.text)}
        assert r.labels == ",".join(sorted(kept | set(filter(None, r.base_labels.split(",")))))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_hundreds_of_rules_and_other_columns(spark):
    assert len(signatures()) > 200 and len({anchored(s) for s in signatures()}) == len(signatures())
    docs = spark.createDataFrame([(1, "cc by", 2, "x")], "doc_id long, text string, LICENSES int, found string")
    assert scan_licenses(docs).columns == ["doc_id", "text", "found", "licenses"]
    assert scan_licenses(docs.limit(0)).count() == 0


def whole_text_finds(text):
    """Kept finds by searching the whole text, without a window."""
    words, found = words_of(text), set()
    for i, word in enumerate(words):
        context = " ".join([*words[:i], "@" + word, *words[i + 1 :]])
        for s in RULES:
            hit = re.search(anchored(s), context) if s.keyword == word else None
            if hit:
                start = i - hit[0].split("@")[0].count(" ")
                found.add((start, start + len(hit[0].split(" ")), s.tier, s.label))
    return {
        (a, z, label) for a, z, tier, label in found
        if not any((b, -y, t, other) < (a, -z, tier, label) and y >= z and t <= tier for b, y, t, other in found)
    }


def test_longest_matches_are_found_whole(spark):
    terms = "licensed to you under the terms of the"
    names = ["GNU General Public License", "GNU GPL v3", "GNU Lesser General Public License", "GNU AGPL", "SIL OFL 1.1", "3-Clause BSD",
             "GNU Free Documentation License version 1.3"]
    texts = [f"This work is {dual}{terms} {name} or not" for dual in ("", "dual ") for name in names]
    docs = spark.createDataFrame(list(enumerate([*texts, *TEXTS])), "doc_id long, text string")
    got = {r.doc_id: {(x.start, x.end, x.label) for x in r.licenses.finds} for r in scan_licenses(docs).collect()}
    assert got == {i: whole_text_finds(t) for i, t in enumerate([*texts, *TEXTS])}
    assert all(min(start for start, _, _ in got[i]) == 2 for i in range(len(texts)))
    assert {label for _, _, label in got[names.index("3-Clause BSD")]} == {"bsd"}


def test_rules_without_bound_are_refused():
    with pytest.raises(ValueError):
        reach([Signature("x", "x", "(?:very )*@x", 1, 0.5)])


def test_time_grows_with_the_finds_only(spark):
    """Tens of thousands of finds in one text, nested ones among them, beside a text of a tenth of that."""
    unit = "licensed under the apache license version 2.0 cc by gnu gpl v3 cc by "
    texts = [unit * n for n in (1_000, 10_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    took, counts = [], []
    for k in (0, 0, 1):  # the first run compiles
        began = time.time()
        r = scan_licenses(docs.where(F.col("doc_id") == k)).select("licenses.n_words", F.size("licenses.base"), F.size("licenses.finds")).first()
        took.append(time.time() - began)
        counts.append(tuple(r))
    assert counts[2][0] == 10 * counts[1][0] and counts[2][1] == 20_000 and counts[2][1] + counts[2][2] >= 40_000
    assert took[2] < 25 * took[1] and took[2] < 120
