"""Evaluation texts leaking into training text.

The words of a batch of documents become numbers. Places whose next words open
with those of some item are found by binary search in the items' sorted first
words; no other place can start a match. The passages at these places and all
items then form one suffix array, built by prefix doubling over the word
numbers, and each place looks up its two neighbours among the suffixes of an
item by binary search. The longer of the two common prefixes is the longest
verbatim match there, so no pairs of places are formed, however repetitive a
text is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tagloom.llm.visible import visible

LEAST_WORDS = 12
#: Characters of item text searched for in one pass over the corpus; more items take more passes.
BLOCK_CHARS = 32_000_000
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits, case ignored."""
    return _WORD.findall(text.lower())


def keys(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The n words from each start as byte strings that sort like the words' numbers."""
    window = ids[starts[:, None] + np.arange(n)] + 1
    return np.ascontiguousarray(window.astype(">u4")).view(f"S{4 * n}").ravel()


def rank_levels(ids: np.ndarray, longest: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... numbers, up to the first power beyond ``longest``: prefix doubling."""
    levels = [np.unique(ids, return_inverse=True)[1]]
    while 1 << (len(levels) - 1) <= longest:
        step, now = 1 << (len(levels) - 1), levels[-1]
        after = np.zeros(len(now), np.int64)
        after[:-step] = now[step:] + 1
        levels.append(np.unique(now << 32 | after, return_inverse=True)[1])
    return levels


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many numbers the suffixes at ``a`` and ``b`` share, the greatest power of two first."""
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < len(levels[k])) & (b < len(levels[k]))
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = same.astype(np.int64) << k
        a, b, out = a + step, b + step, out + step
    return out


NONE = pd.DataFrame({"doc": [], "item_id": [], "n_words": [], "at": []}, dtype="int64")
#: Lookups (places times the items that share their first words) worked on at once, which bounds memory and changes no result.
LOOKUPS = 2_000_000


class Items:
    """The test items as one sequence of word numbers, each closed by a number of its own, and the sorted first n words of its suffixes."""

    def __init__(self, rows: list[tuple[int, str]], n: int):
        self.n = n
        self.index: dict[str, int] = {}
        self.names = np.unique(np.array([i for i, _ in rows], np.int64))
        ids, owner, left = [], [], []
        for k, (item, text) in enumerate(rows):
            own = [self.index.setdefault(w, len(self.index)) for w in words(visible(text or ""))]
            ids += [*own, -1 - k]
            owner += [int(np.searchsorted(self.names, item))] * (len(own) + 1)
            left += range(len(own), -1, -1)
        self.ids, self.owner, self.left = np.array(ids, np.int64), np.array(owner, np.int64), np.array(left, np.int64)
        self.starts = np.flatnonzero(self.left >= n)
        self.longest = int(self.left.max(initial=0))
        found = keys(self.ids, self.starts, n) if len(self.starts) else np.zeros(0, f"S{4 * n}")
        self.keys, group = np.unique(found, return_inverse=True)
        # the items that hold each of these openings, as ranges of one array
        held = np.unique(group.astype(np.int64) << 32 | self.owner[self.starts]) if len(group) else np.zeros(0, np.int64)
        self.holders = held & 0xFFFFFFFF
        self.first = np.searchsorted(held >> 32, np.arange(len(self.keys) + 1))

    def search(self, texts: list[str | None]) -> pd.DataFrame:
        """``doc, item_id, n_words, at``: the longest match of each item in each text, and the first word where it starts."""
        n, get = self.n, self.index.get
        ids: list[int] = []
        bounds = [0]
        for text in texts:
            if text:
                ids += [get(w, -1) for w in words(visible(text))]
            ids.append(-1)
            bounds.append(len(ids))
        seq = np.array(ids, np.int64)
        # how many words from each place on occur in some item
        stop = np.flatnonzero(seq < 0)
        run = stop[np.searchsorted(stop, np.arange(len(seq)))] - np.arange(len(seq))
        starts = np.flatnonzero(run >= n)
        if not len(starts) or not len(self.keys):
            return NONE
        suffix = keys(seq, starts, n)
        group = np.minimum(np.searchsorted(self.keys, suffix), len(self.keys) - 1)
        hit = self.keys[group] == suffix
        starts, group = starts[hit], group[hit]
        if not len(starts):
            return NONE
        # the passages from these places on, each closed by a number of its own, behind the items
        cover = np.zeros(len(seq) + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + np.minimum(run[starts], self.longest), -1)
        inside = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
        closes = np.append(np.flatnonzero(np.diff(inside) > 1), len(inside) - 1)
        passages = np.insert(seq[inside], closes + 1, -1 - len(self.ids) - np.arange(len(closes)))
        of = len(self.ids) + np.searchsorted(inside, starts)
        of += np.searchsorted(closes, of - len(self.ids))  # the closing numbers before it
        levels = rank_levels(np.concatenate([self.ids, passages]), self.longest)
        rank, size = levels[-1], len(levels[-1])
        ordered = self.owner[self.starts] * size + rank[self.starts]
        order = np.argsort(ordered)
        ordered, place = ordered[order], self.starts[order]
        doc = np.searchsorted(np.array(bounds), starts, "right") - 1
        at = starts - np.array(bounds)[doc]
        count = self.first[group + 1] - self.first[group]
        parts, ends = [], np.cumsum(count)
        low = 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + LOOKUPS, "right")))
            of_hit = np.repeat(np.arange(low, high), count[low:high])
            within = np.arange(len(of_hit)) - np.repeat(ends[low:high] - count[low:high] - (ends[low - 1] if low else 0), count[low:high])
            item = self.holders[self.first[group[of_hit]] + within]
            spot = of[of_hit]
            above = np.searchsorted(ordered, item * size + rank[spot])
            length = np.zeros(len(spot), np.int64)
            for near in (above - 1, above):
                there = (near >= 0) & (near < len(ordered))
                there[there] = ordered[near[there]] // size == item[there]
                length[there] = np.maximum(length[there], common_prefix(levels, place[near[there]], spot[there]))
            found = pd.DataFrame({"doc": doc[of_hit], "item_id": self.names[item], "n_words": length, "at": at[of_hit]})
            parts.append(found.sort_values(["doc", "item_id", "n_words", "at"], ascending=[True, True, False, True]).drop_duplicates(["doc", "item_id"]))
            low = high
        found = pd.concat(parts)
        return found.sort_values(["doc", "item_id", "n_words", "at"], ascending=[True, True, False, True]).drop_duplicates(["doc", "item_id"])


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in items.select(item_col, text_col).distinct().toLocalIterator():
        if size and size + len(r[1] or "") > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1] or "")
    yield block


def matches(documents: DataFrame, items: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, item_id, n_words, at_word``: each item a document holds ``least_words`` consecutive words of.

    ``n_words`` is the longest verbatim match and ``at_word`` the word of the
    visible text where it starts, counted from 0. Items are sent out in blocks of
    bounded size, one pass over the corpus each, so no more than a block is ever
    broadcast. Null and empty texts and items shorter than the limit match
    nothing; repeated documents give their rows each, repeated items one.
    One scan a block and no shuffle.
    """
    context = documents.sparkSession.sparkContext
    out = None
    for block in _blocks(items, "item_id", "text"):
        sent = context.broadcast(Items(block, least_words))

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                found = sent.value.search(pdf["text"].tolist())
                yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[found["doc"].to_numpy()], "item_id": found["item_id"], "n_words": found["n_words"], "at_word": found["at"]})

        part = documents.select("doc_id", "text").mapInPandas(run, "doc_id long, item_id long, n_words long, at_word long")
        out = part if out is None else out.unionByName(part)
    return out


def clean(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no passage of an item."""
    return documents.join(matches(documents, items).select("doc_id").distinct(), "doc_id", "left_anti")


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id``, distinct."""
    return matches(documents, items).select("doc_id", "item_id").distinct()
