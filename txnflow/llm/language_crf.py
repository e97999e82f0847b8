"""Language ID: a linear-chain conditional random field over the words of a text.

Each word has features: its affixes and other n-grams of 2 to 4 bytes, and
itself as a lexicon entry. Their weights and the transitions between labels are
learned together by forward-backward on sequences spliced from documents of one
or several languages, as code-switched text is. A text's language is the one
with the largest expected share of words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.llm.common import column, fresh, map_texts, mixed

#: Bounds of the training sample: documents of each language, spans of each, words of a span.
SAMPLE_DOCS, SAMPLE_SPANS, SPAN_WORDS = 400, 3, 32
#: Feature buckets, n-gram lengths, passes over the sample, words of a training sequence.
BUCKETS, GRAMS, EPOCHS, SEQUENCE = 1 << 17, (2, 3, 4), 3, 64
#: Words whose weights a task keeps; beyond, it starts anew.
CACHE_WORDS = 300_000
#: Words that one forward-backward pass takes at least, short of the end of the input.
CHUNK_WORDS = 150_000
UNKNOWN = "und"

_words = re.compile(r"[^\W\d_]+").findall


def remainder(column: str, divisor: int) -> Column:
    """crc32 of a value as text, modulo `divisor`; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; none if the text has no letter."""
    words = _words((text or "").lower())
    if words and not any(map(str.isalpha, words[:64])) and not any(c.isalpha() for c in text):
        return []
    return words


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all words in a row, and where each word's begin (every word has some)."""
    raw = [b"\x01" + w.encode() + b"\x02" for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    stream = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(raw)), sizes)
    buckets, owners = [], []
    for width in GRAMS:
        n = len(stream) - width + 1
        if n <= 0:
            continue
        key = np.full(n, width, np.uint64)
        for k in range(width):
            key = (key << np.uint64(8)) | stream[k : k + n]
        inside = owner[width - 1 :] == owner[:n]
        buckets.append(mixed(key[inside]))
        owners.append(owner[:n][inside])
    whole = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw))
    buckets.append(whole)
    owners.append(np.arange(len(raw)))
    owners, buckets = np.concatenate(owners), np.concatenate(buckets) % np.uint64(BUCKETS)
    order = np.argsort(owners, kind="stable")
    starts = np.searchsorted(owners[order], np.arange(len(raw)))
    return buckets[order].astype(np.int64), starts


@dataclass
class LanguageModel:
    labels: list[str]
    weights: np.ndarray  # buckets x labels
    transitions: np.ndarray  # labels x labels, log
    start: np.ndarray  # labels, log

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log weights of the labels for each word."""
        buckets, starts = word_features(words)
        sizes = np.diff(np.append(starts, len(buckets)))
        return np.add.reduceat(self.weights[buckets], starts) / np.sqrt(sizes)[:, None]

    def posteriors(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Marginal probabilities of the labels of all words; `first` marks where a text begins.

        Texts stand in one row, cut into blocks that advance side by side:
        each block's matrix product gives the state in which the next begins.
        """
        n, k = emissions.shape
        size = max(1, int(np.sqrt(n)))
        blocks = -(-n // size)
        weight = np.ones((blocks * size, k))
        weight[:n] = np.exp(emissions - emissions.max(1, keepdims=True))
        reset = np.zeros(blocks * size, bool)
        reset[:n], reset[0], reset[n:] = first, True, True  # what pads the last block is a text of its own
        weight, reset = weight.reshape(blocks, size, k), reset.reshape(blocks, size)
        step = np.exp(self.transitions - self.transitions.max())
        begin = np.exp(self.start - self.start.max())

        product = np.tile(np.eye(k), (blocks, 1, 1))
        for t in range(size):
            on = (product.reshape(-1, k) @ step).reshape(blocks, k, k)
            anew = product.sum(2, keepdims=True) * begin
            product = np.where(reset[:, t, None, None], anew, on) * weight[:, t, None, :]
            product /= product.max((1, 2), keepdims=True)
        into, out = np.ones((blocks, k)), np.ones((blocks, k))
        for b in range(1, blocks):
            state = into[b - 1] @ product[b - 1]
            into[b] = state / state.sum()
        for b in range(blocks - 2, -1, -1):
            state = product[b + 1] @ out[b + 1]
            out[b] = state / state.sum()
        forward = np.empty((blocks, size, k))
        state = into
        for t in range(size):
            state = np.where(reset[:, t, None], begin, state @ step) * weight[:, t]
            state /= state.sum(1, keepdims=True)
            forward[:, t] = state
        state = out
        for t in range(size - 1, -1, -1):
            forward[:, t] *= state
            later = weight[:, t] * state
            state = np.where(reset[:, t, None], 1.0, later @ step.T)
            state /= state.sum(1, keepdims=True)
        found = forward.reshape(-1, k)[:n]
        return found / found.sum(1, keepdims=True)


def _sample(docs: DataFrame, text: str, lang: str, seed_column: str) -> list[tuple[str, list[str]]]:
    """Spans of words from a bounded number of documents of each language, spread over their whole texts."""
    rows = docs.where(column(text).isNotNull() & column(lang).isNotNull())
    rows = rows.select(column(lang).alias("lang"), column(text).alias("text"), F.xxhash64(F.lit(11), F.col(seed_column)).alias("draw"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return []
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, 2 * SAMPLE_DOCS / n))).otherwise(share)
    drawn = rows.where(F.pmod(F.col("draw"), F.lit(1 << 30)) < share * (1 << 30))

    def build():
        def work(texts):
            found = []
            for value in texts:
                words = words_of(value)
                gap = max(1, len(words) // SAMPLE_SPANS)
                found.append([" ".join(words[i : i + SPAN_WORDS]) for i in range(0, len(words), gap)][:SAMPLE_SPANS])
            return (found,)

        return work

    spans = map_texts(drawn, "text", ["lang", "draw"], {"spans": "strings"}, build)
    first = Window.partitionBy("lang").orderBy("draw", "spans")
    spans = spans.withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE_DOCS)
    found = [(r["lang"], s.split()) for r in spans.orderBy("lang", "place").collect() for s in r["spans"]]
    return [(name, words) for name, words in found if words]


def _sequences(sample: list[tuple[str, list[str]]], labels: list[str], random: np.random.Generator):
    """Sequences of `SEQUENCE` words and labels; half are of one language, half switch between some."""
    by_label = [[words for name, words in sample if name == label] for label in labels]
    total = sum(len(w) for _, w in sample)
    for _ in range(max(64, 2 * total // SEQUENCE)):
        words, marks = [], []
        own, mixed_up = int(random.integers(len(labels))), random.random() < 0.5
        while len(words) < SEQUENCE:
            if mixed_up and words:
                own = int(random.integers(len(labels)))
            span = by_label[own][int(random.integers(len(by_label[own])))]
            size = int(random.integers(4, SPAN_WORDS + 1)) if mixed_up else SPAN_WORDS
            start = int(random.integers(max(1, len(span) - size + 1)))
            part = span[start : start + size]
            words += part
            marks += [own] * len(part)
        yield words[:SEQUENCE], marks[:SEQUENCE]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", seed_column: str = "doc_id") -> LanguageModel | None:
    """A field learned from a bounded sample of the labelled rows of `docs`; None if there are none.

    The sample holds at most `SAMPLE_DOCS` documents of each language with
    `SAMPLE_SPANS` spans of `SPAN_WORDS` words, drawn by hash.
    """
    sample = _sample(docs, text, lang, seed_column)
    if not sample:
        return None
    labels = sorted({name for name, _ in sample})
    random, k = np.random.default_rng(5), len(labels)
    names = sorted({w for _, words in sample for w in words})
    code = {w: i for i, w in enumerate(names)}
    buckets, starts = word_features(names)
    ends = np.append(starts[1:], len(buckets))
    model = LanguageModel(labels, np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k))
    seen = [np.full_like(x, 1e-6) for x in (model.weights, model.transitions)]
    rate, lanes = 0.3, 64
    for _ in range(EPOCHS):
        sequences = list(_sequences(sample, labels, random))
        for at in range(0, len(sequences), lanes):
            part = sequences[at : at + lanes]
            ids = np.array([[code[w] for w in words] for words, _ in part])
            gold = np.array([marks for _, marks in part])
            used, place = np.unique(ids, return_inverse=True)
            place = place.reshape(ids.shape)
            sizes = ends[used] - starts[used]
            own = np.concatenate([buckets[a:b] for a, b in zip(starts[used], ends[used])])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            weight = np.add.reduceat(model.weights[own], first) / np.sqrt(sizes)[:, None]
            emission, pairs = _gradient(weight[place], gold, model.transitions)
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, place.ravel(), emission.reshape(-1, k))
            by_word /= np.sqrt(sizes)[:, None]
            touched, where = np.unique(own, return_inverse=True)
            change = np.zeros((len(touched), k))
            np.add.at(change, where, np.repeat(by_word, sizes, axis=0))
            seen[0][touched] += change**2
            model.weights[touched] += rate * change / np.sqrt(seen[0][touched])
            seen[1] += pairs**2
            model.transitions += rate * pairs / np.sqrt(seen[1])
    model.weights = model.weights.astype(np.float32)
    return model


def _gradient(emission: np.ndarray, gold: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the log-likelihood of the gold labels, by word and by transition."""
    lanes, size, k = emission.shape
    weight = np.exp(emission - emission.max(2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    forward = np.empty((lanes, size, k))
    state = weight[:, 0]
    for t in range(size):
        if t:
            state = (state @ step) * weight[:, t]
        state = state / state.sum(1, keepdims=True)
        forward[:, t] = state
    pairs = np.zeros((k, k))
    np.add.at(pairs, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1.0)
    marginal, back = np.empty((lanes, size, k)), np.ones((lanes, k))
    for t in range(size - 1, -1, -1):
        now = forward[:, t] * back
        marginal[:, t] = now / now.sum(1, keepdims=True)
        if t:
            later = weight[:, t] * back
            joint = forward[:, t - 1, :, None] * step * later[:, None, :]
            pairs -= (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            back = later @ step.T
            back = back / back.sum(1, keepdims=True)
    grad = -marginal
    grad.reshape(-1, k)[np.arange(lanes * size), gold.ravel()] += 1.0
    return grad, pairs


class Labeller:
    """Languages of many texts, with the weights of words kept."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model.labels)), np.float32)

    def _codes(self, words: list[str]) -> np.ndarray:
        codes = list(map(self.code.get, words))
        if None in codes:
            new = sorted({w for w, c in zip(words, codes) if c is None})
            start = len(self.code)
            self.code.update(zip(new, range(start, start + len(new))))
            while start + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            for i in range(0, len(new), 50_000):
                part = new[i : i + 50_000]
                self.table[start + i : start + i + len(part)] = self.model.emissions(part)
            codes = list(map(self.code.__getitem__, words))
        return np.array(codes, np.int64)

    def shares(self, texts: list[list[str]]) -> np.ndarray:
        """Expected shares of the labels for texts that all have words."""
        if len(self.code) > CACHE_WORDS:
            self._forget()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        codes = self._codes([w for words in texts for w in words])
        first = np.zeros(len(codes), bool)
        first[starts] = True
        found = self.model.posteriors(self.table[codes].astype(float), first)
        return np.add.reduceat(found, starts) / sizes[:, None]

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        waiting: list[tuple[int, list[str]]] = []
        pending = 0
        for i, text in enumerate(texts):
            words = words_of(text)
            if words:
                waiting.append((i, words))
                pending += len(words)
            if waiting and (pending >= CHUNK_WORDS or i == len(texts) - 1):
                shares = self.shares([w for _, w in waiting])
                for (at, _), best, share in zip(waiting, shares.argmax(1), shares.max(1)):
                    names[at], scores[at] = self.model.labels[best], float(min(1.0, share))
                waiting, pending = [], 0
        return names, scores


def label_words(model: LanguageModel, text: str) -> list[tuple[str, str]]:
    """Each word of a text with its most probable label."""
    words = words_of(text)
    if not words:
        return []
    first = np.zeros(len(words), bool)
    found = model.posteriors(model.emissions(words).astype(float), first)
    return [(w, model.labels[i]) for w, i in zip(words, found.argmax(1))]


def label_documents(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and lang_score (0 to 1) in place of columns so named. One pass without shuffle.

    lang_score is the expected share of words in lang_pred. A text that is null
    or has no letter gets `und` and 0, as does every text without a model.
    Ties go to the label first in order. Whole texts are read; repeated rows
    get the same label up to rounding of the score; an empty table stays empty.
    """
    made = {"lang_pred", "lang_score"}
    keep = [c for c in docs.columns if c.lower() not in made]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def build():
        if shared.value is None:
            return lambda texts: ([UNKNOWN] * len(texts), [0.0] * len(texts))
        return Labeller(shared.value).label

    return map_texts(docs, text, keep, {"lang_pred": "string", "lang_score": "double"}, build)


def keep_known(docs: DataFrame, model: LanguageModel | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs` with a language that has at least the share `least`, with their columns as they were."""
    value = fresh(["row"], "labelled_text")
    packed = docs.select(F.struct(*map(column, docs.columns)).alias("row"), column(text).alias(value))
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= least)
    return label_documents(packed, model, value).where(known).select("row.*")
