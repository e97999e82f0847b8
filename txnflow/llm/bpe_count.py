"""Token counts by byte-pair merging, without making identifiers.

A word starts as one symbol per character. A heap holds its adjacent pairs by
rank (ties: leftmost); the lowest is popped, its right symbol is unlinked from
the list, and the new neighbours' pairs are pushed. The count is the initial
symbols minus the merges; a character outside the vocabulary stays one symbol
and counts as its bytes.
"""

from __future__ import annotations

import heapq
import os
import re
from functools import lru_cache

from pyspark.sql import DataFrame

from txnflow.llm.common import fresh, map_texts

#: The mark that stands for a space.
SPACE = "▁"
#: Words whose counts a task keeps; beyond, it starts anew. Bounds memory, changes no result.
CACHE_WORDS = 500_000
#: Longer words are counted each time.
CACHE_CHARS = 40


class PieceMerges:
    """Merge ranks of a sentencepiece BPE model, and counts of texts by them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        pieces = self.rank.keys()
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("pieces of this vocabulary span words")
        # A character that only stands alone ends a segment, as does a space mark.
        joined = {c for p in pieces if len(p) > 1 for c in p}
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
        self.segments = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else "")).findall
        self.cache: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Tokens of one segment."""
        n = len(word)
        rank = self.rank
        symbols: list[str | None] = list(word)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(word[i : i + 2])
            if r is not None:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, size = heapq.heappop(heap)
            left = symbols[i]
            if left is None:
                continue
            j = after[i]
            if j >= n or len(left) + len(symbols[j]) != size:
                continue  # one of the two has been merged since
            both = left + symbols[j]
            symbols[i], symbols[j] = both, None
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                r = rank.get(both + symbols[k])
                if r is not None:
                    heapq.heappush(heap, (r, i, size + len(symbols[k])))
            h = before[i]
            if h >= 0:
                r = rank.get(symbols[h] + both)
                if r is not None:
                    heapq.heappush(heap, (r, h, size + len(symbols[h])))
        # Single characters outside the vocabulary fall back to their bytes.
        return n - merges + sum(len(s.encode()) - 1 for s in symbols if s is not None and len(s) == 1 and s not in rank)

    def count(self, text: str) -> int:
        """Tokens of a whole text, which gets a space before its start."""
        if not text:
            return 0
        words = self.segments(SPACE + text.replace(" ", SPACE))
        cache = self.cache
        counts = list(map(cache.get, words))
        if None in counts:
            for at, known in enumerate(counts):
                if known is None:
                    word = words[at]
                    known = cache.get(word)
                    if known is None:
                        known = self.merged(word)
                        if len(word) <= CACHE_CHARS:
                            if len(cache) >= CACHE_WORDS:
                                cache.clear()
                            cache[word] = known
                    counts[at] = known
        return sum(counts)


@lru_cache(maxsize=1)
def _merges(path: str) -> PieceMerges:
    return PieceMerges(path)


def count_tokens(docs: DataFrame, model: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """`docs` with n_bytes, n_tokens and over_limit in place of any columns so named.

    One pass without shuffle. `model` is a file that every executor has. Null
    and empty texts have no bytes and no tokens. Texts are counted whole,
    whatever their length; repeated rows give repeated results; an empty table
    gives an empty table.
    """
    made = {"n_bytes", "n_tokens", "over_limit"}
    keep = [c for c in docs.columns if c.lower() not in made]
    temp = {fresh(keep, name): kind for name, kind in (("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean"))}

    def build():
        if not os.path.exists(model):
            raise FileNotFoundError(model)
        merges = _merges(model)

        def work(texts):
            sizes = [len((t or "").encode()) for t in texts]
            counts = [merges.count(t or "") for t in texts]
            return sizes, counts, [c > limit for c in counts]

        return work

    return map_texts(docs, text, keep, temp, build)
