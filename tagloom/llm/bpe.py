"""Encoding of a corpus with a public byte-level BPE tokenizer.

The merges run in numpy: the symbols of many words lie in one flat array, and
each round finds every word's lowest-rank pair by binary search over the sorted
pair keys and merges it everywhere at once. Words are encoded once a worker and
kept in a bounded memory; paragraphs that repeat within a batch, as those of
page revisions do, are cut into words once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

TOKENIZERS = "/opt/tokenizers"
#: Words kept between batches; past this the memory starts anew, which costs time and changes no result.
WORD_MEMORY = 300_000
NONE = np.int64(1) << 40

# Fixed value: the pattern that parts a text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The same for ASCII text, where the plain engine is twice as fast.
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable ones for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    hidden = (b for b in range(256) if b not in set(shown))
    return out | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Sorted pair keys with their ranks and results, and the id of each byte."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        order = np.argsort(left << 32 | right, kind="stable")
        self.keys = (left << 32 | right)[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.bytes = np.zeros(256, np.int64)
        for symbol, b in byte_symbols().items():
            self.bytes[b] = vocab[symbol]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the bounds of each word in it."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), lengths)
        done_ids, done_words = [], []
        while len(symbols):
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.ranks[at], NONE), NONE)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            low = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            # words without a pair are done and leave the arrays
            alive = low < NONE
            if not alive.all():
                done_ids.append(symbols[~alive])
                done_words.append(word[~alive])
            hit = np.flatnonzero(alive & (rank == low))
            if not len(hit):
                break
            # overlapping hits occur in runs of one symbol: every second one counts, from the left
            run = np.flatnonzero(np.append(True, np.diff(hit) > 1))
            offset = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
            hit = hit[offset % 2 == 0]
            symbols[hit] = self.merged[at[hit]]
            alive[hit + 1] = False
            symbols, word = symbols[alive], word[alive]
        ids = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
        of = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
        order = np.argsort(of, kind="stable")
        return ids[order].astype(np.int32), np.append(0, np.cumsum(np.bincount(of, minlength=len(raw))))


def take_ranges(flat: np.ndarray, bounds: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges ``picks`` of a flat array one after another, and the running ends."""
    sizes = bounds[picks + 1] - bounds[picks]
    ends = np.cumsum(sizes)
    if not len(picks) or not ends[-1]:
        return flat[:0], ends
    return flat[np.repeat(bounds[picks] - (ends - sizes), sizes) + np.arange(ends[-1])], ends


class Encoder:
    def __init__(self, path: str):
        self.merges = Merges(path)
        self.cut = regex.compile(WORDS)
        self.cut_ascii = re.compile(ASCII_WORDS, re.ASCII)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = [np.zeros(0, np.int32)]
        self.bounds = np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """A list of ids for each text; null and empty texts give an empty list."""
        if len(self.index) > WORD_MEMORY:
            self.forget()
        places: dict[str, int] = {}
        of_text, n_of_text = [], []
        for text in texts:
            n = 0
            if text:
                for part in paragraphs(text):
                    of_text.append(places.setdefault(part, len(places)))
                    n += 1
            n_of_text.append(n)
        new: list[str] = []
        index, known = self.index, len(self.index)
        words, n_words = [], []
        for part in places:
            found = (self.cut_ascii if part.isascii() else self.cut).findall(part)
            ids = list(map(index.get, found))
            if None in ids:
                for i, w in enumerate(found):
                    if ids[i] is None:
                        ids[i] = index.get(w)
                        if ids[i] is None:
                            ids[i] = index[w] = known + len(new)
                            new.append(w)
            words += ids
            n_words.append(len(found))
        if new:
            flat, bounds = self.merges.encode(new)
            self.bounds = np.append(self.bounds, self.bounds[-1] + bounds[1:])
            self.flat = [np.concatenate([*self.flat, flat])]
        ids, ends = take_ranges(self.flat[0], self.bounds, np.array(words, np.int64))
        part_bounds = np.append(0, ends)[np.append(0, np.cumsum(np.array(n_words, np.int64))).astype(np.int64)]
        ids, ends = take_ranges(ids, part_bounds, np.array(of_text, np.int64))
        offsets = np.append(0, ends)[np.append(0, np.cumsum(np.array(n_of_text, np.int64))).astype(np.int64)]
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))


def paragraphs(text: str) -> list[str]:
    """A text in parts that no word spans: each but the first starts with a line break that follows no white space."""
    lines = text.split("\n")
    if len(lines) == 1:
        return lines
    out, held = [], lines[0]
    for line in lines[1:]:
        if held and not held[-1].isspace():
            out.append(held)
            held = "\n" + line
        else:
            held = f"{held}\n{line}"
    out.append(held)
    return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_ids(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``doc_id, ids``: the token ids of every row, without special tokens.

    Strings that look like special tokens are ordinary text. Null and empty
    texts give an empty list, never null; repeated rows give one row each. One
    scan, no shuffle; each executor reads the vocabulary from ``folder``.
    """
    path = f"{folder}/{tokenizer}.json"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), enc.encode(b.column(1).to_pylist())], names=["doc_id", "ids"])

    kind = dict(documents.dtypes)[id_col]
    return documents.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>")
