import math
import re

import pytest
from pyspark.sql import functions as F

from txnflow.llm import url_filter
from txnflow.llm.queries import QUERIES
from txnflow.llm.url_filter import HELD_BACK, PAD, RULES, STEPS, WIDTH, _gram_counts, filter_urls, gains_of, gram_keys


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, rule and rule.text, rule and rule.verdict


def test_query_follows_rules_and_judges_the_rest(spark, sf_dir):
    rows = QUERIES["op6_url_filters"](spark, "/root/testdata/sf0.01").collect()
    urls = {r.page_id: r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


URLS = [
    None, "", "nothing", "http://", "http://EXAMPLE.org", "http://a.example.org/es/1#x", "https://x.Org?y=/de/", "ftp://org/",
    "http://badexample.org/en/1", "http://example.org/en/12?q", "http://b.com/fr/", "http://com/de/a://b/c", "x://é.net/ü#?/", "http://h.com/" + "a" * 50_000,
]


def test_small_cases(spark):
    pages = spark.createDataFrame([(i, u, "n") for i, u in enumerate(URLS)] * 2, "page_id long, url string, Host string")
    got = filter_urls(pages)
    assert got.columns == ["page_id", "url", "Host", "url_check"]
    rows = got.collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path, rule, verdict = brute(URLS[r.page_id])
        c = r.url_check
        assert (c.host, c.path, c.rule) == (host, path, rule) and c.verdict == (verdict or c.verdict)
    assert filter_urls(pages.limit(0)).count() == 0


def test_model_separates_what_rules_teach(spark):
    good = [f"http://site{i}.org/news/page{i % 17}" for i in range(300)]
    bad = [f"http://pills{i}.com/de/buy-cheap{i % 13}" for i in range(300)]
    more = ["http://site7.net/news/page3", "http://pills9.net/buy-cheap4"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad + more)], "page_id long, url string")
    found = {r.url: r.url_check.verdict for r in filter_urls(pages).collect()}
    assert found[more[0]] == "allow" and found[more[1]] == "block"


def plain_model(texts):
    """The chance of a byte after a context, from plain counts of byte strings."""
    pairs, kinds = {}, {}
    for text in texts:
        padded = bytes(WIDTH - 1) + text
        for i in range(WIDTH - 1, len(padded)):
            for size in range(WIDTH):
                context = padded[i - size : i]
                pairs[size, context, padded[i]] = pairs.get((size, context, padded[i]), 0) + 1
                kinds.setdefault((size, context), set()).add(padded[i])

    def chance(context, byte):
        p = 1 / 256
        for size in range(WIDTH):
            own = context[len(context) - size :]
            if (size, own) in kinds:
                n = sum(pairs[size, own, b] for b in kinds[size, own])
                k = len(kinds[size, own])
                p = (pairs.get((size, own, byte), 0) + k * p) / (n + k)
        return p

    return chance


def number(raw):
    return int.from_bytes(raw, "big")


def test_probabilities_equal_a_plain_count_and_sum_to_one(spark):
    texts = {"allow": [b"banana\x03", b"bandana\x03", b"\x03"], "block": [b"bond\x03"]}
    rows = [(label, t[:-1].decode()) for label, own in texts.items() for t in own]
    grams = _gram_counts(spark.createDataFrame(rows, "label string, address string"), "label", "address")
    wanted = [number(b"\0\0bana") >> 8 << 8 | b for b in range(256)]
    wanted += [k for own in texts.values() for k in gram_keys(own, WIDTH, PAD).tolist()]
    windows = spark.createDataFrame([(k, 1) for k in sorted(set(wanted))], "key long, n long")
    found = {r["key"]: r for r in gains_of(grams, windows).collect()}
    assert set(found) == set(wanted)
    for label, own in texts.items():
        chance = plain_model(own)
        for key, r in found.items():
            raw = key.to_bytes(WIDTH, "big")
            assert abs(math.exp(r[label]) - chance(raw[:-1], raw[-1])) < 1e-12
            assert abs(r["gain"] - (r["allow"] - r["block"])) < 1e-12
        assert abs(sum(math.exp(found[k][label]) for k in wanted[:256]) - 1) < 1e-9


@pytest.mark.parametrize("most", [1 << 19, 300])
def test_verdicts_of_the_model_equal_those_of_plain_counts(spark, monkeypatch, most):
    """The whole query, with windows all broadcast or mostly joined."""
    monkeypatch.setattr(url_filter, "BROADCAST_WINDOWS", most)
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    rows = pages.select("*", (F.pmod(F.xxhash64(F.concat(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")))), F.lit(HELD_BACK)) == 0).alias("held")).collect()
    facts = {r.page_id: (*brute(r.url), r.held) for r in rows}
    address = {k: (host + path).encode() + b"\x03" for k, (host, path, *_) in facts.items()}
    models = {x: plain_model([address[k] for k, f in facts.items() if f[3] == x and not f[4]]) for x in ("allow", "block")}

    def ratio(raw):
        padded = bytes(WIDTH - 1) + raw
        parts = [(padded[i - WIDTH + 1 : i], padded[i]) for i in range(WIDTH - 1, len(padded))]
        return sum(math.log(models["allow"](*p)) - math.log(models["block"](*p)) for p in parts) / len(raw)

    ratios = {k: ratio(raw) for k, raw in address.items()}
    held = {x: [round(ratios[k] * STEPS) for k, f in facts.items() if f[3] == x and f[4]] for x in ("allow", "block")}
    right = lambda cut: sum(s >= cut for s in held["allow"]) / len(held["allow"]) + sum(s < cut for s in held["block"]) / len(held["block"])
    cuts = {0, *held["allow"], *held["block"]}
    best = max(cuts, key=lambda cut: (right(cut), -abs(cut), -cut))
    got = {r.page_id: r for r in filter_urls(pages).select("page_id", "url_check.*").collect()}
    assert len(got) == len(facts) and sum(f[3] is None for f in facts.values()) > 20
    for k, (_, _, rule, verdict, _) in facts.items():
        assert abs(got[k].ratio - ratios[k]) < 1e-9
        if abs(ratios[k] * STEPS - math.floor(ratios[k] * STEPS) - 0.5) > 1e-6:
            assert got[k].verdict == (verdict or ("allow" if round(ratios[k] * STEPS) >= best else "block"))
