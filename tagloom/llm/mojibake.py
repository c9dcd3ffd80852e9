"""Garbled text from wrong character encoding.

A swap of single-byte code pages is a substitution cipher. The ciphers of each
source (table and field) are learned by expectation-maximisation against the
bigrams of the letters: texts are laid against every ordered pair of the
single-byte pages the runtime knows, those that a pair explains give their
pairs of shown characters, and from these a posterior over letters is worked out
for every shown character, with the pair of pages as the prior. What comes out
is a table of characters, applied with ``translate()``. Encodings of several
bytes are no ciphers, so their layers are undone by decoding, each as deep as it
goes. All readings of a text, as it stands included, then compete: a bigram
model and the share of each swap in the source give their probabilities, and
these weigh the counts from which model and shares are estimated anew.
"""

from __future__ import annotations

import codecs
import encodings
import pkgutil
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.tables import Scratch, spread

# Encodings that are read wrongly, and those that are taken for them.
SINGLE_PAGES = ("cp1252", "cp1251", "cp1250", "mac_roman", "cp437", "cp850", "cp866", "koi8_r", "iso8859_5", "iso8859_7")
WIDE_PAGES = ("cp932", "gbk", "cp949", "big5")
WIDE_SOURCES = ("cp932", "euc_jp", "cp949", "gbk", "big5")
#: Single-byte pages met most, which stand before the others where several pairs of pages give one reading.
FIRST_PAGES = ("cp1252", "cp1251", "koi8_r", "iso8859_5", "cp866", "cp1253", "cp1250", "iso8859_7", "mac_roman", "mac_cyrillic", "cp437", "cp850")

ROUNDS = 3
#: Expected share of garbled texts before anything is learned, and the weight of that expectation in texts.
PRIOR, PRIOR_TEXTS = 0.02, 50.0
SMOOTHING = 0.5
LOST = chr(0xFFFD)
#: C1 control and private characters, which no right decoding of a name gives.
STRAY = f"{chr(0x80)}-{chr(0x9F)}{chr(0xE000)}-{chr(0xF8FF)}"
CONTROL = regex.compile(f"[{STRAY}]")
#: Sights of garbling, which keep a text out of the first model and decide nothing: signs within words, mixed scripts, runs of accented letters.
ODD = regex.compile(r"\p{L}[^\p{L}\p{N}\x00-\x7f\p{P}][\p{L}\p{So}\p{Sc}]|[^\x00-\x7f\p{L}\p{N}]{2}|\p{Cyrillic}\p{Latin}|\p{Latin}\p{Cyrillic}|\p{Latin}\p{Han}|\p{Han}\p{Latin}|[\u00c0-\u024f]{3}|[\uff61-\uff9f]|\p{Latin}[\u00a1-\u00bf\u2018-\u2022\u0192\u201a]")
UTF8 = regex.compile(b"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")
PIECE = regex.compile(r"[ _()\-]+")


@lru_cache(maxsize=200_000)
def page_byte(c: str, page: str) -> int:
    """The byte that a single-byte page shows as a character, or -1. Undefined bytes are shown as control characters."""
    try:
        return c.encode(page)[0]
    except UnicodeEncodeError:
        return ord(c) if 0x80 <= ord(c) <= 0x9F or (page == "cp1252" and ord(c) <= 0xFF) else -1


@lru_cache(maxsize=200_000)
def byte_options(c: str, page: str) -> tuple[int, ...]:
    """The byte of a character, and that of its other case."""
    other = c.swapcase()
    out = [page_byte(c, page)]
    if len(other) == 1 and other != c:
        out.append(page_byte(other, page))
    return tuple(b for b in out if b >= 0)


@lru_cache(maxsize=None)
def may_hold_utf8(page: str) -> regex.Pattern:
    """Finds a character that may be a lead byte, in either case, before one that may follow it."""
    shown = {bytes([b]).decode(page, "replace") for b in range(128, 256)} | {chr(b) for b in range(128, 256)}
    every = sorted(c for c in shown | {c.swapcase() for c in shown} if len(c) == 1)
    lead = [c for c in every if any(0xC2 <= b <= 0xF4 for b in byte_options(c, page))]
    tail = [c for c in every if any(0x80 <= b <= 0xBF for b in byte_options(c, page))]
    return regex.compile(f"[{regex.escape(''.join(lead), literal_spaces=True)}][{regex.escape(''.join(tail), literal_spaces=True)}]")


def undo_utf8(s: str, page: str) -> str:
    """The text with every valid UTF-8 sequence among its bytes decoded; the rest stays as it is."""
    codes = [page_byte(c, page) for c in s]
    out, i = [], 0
    raw = bytes(b if b >= 0 else 0 for b in codes)
    for m in UTF8.finditer(raw):
        out.append(s[i : m.start()])
        out.append(m.group().decode("utf-8"))
        i = m.end()
    return "".join(out) + s[i:] if out else s


def undo_recased(s: str, page: str) -> str:
    """The same where the case of the garbled text was changed: each character may stand for either case's byte."""
    out, i, n = [], 0, len(s)
    while i < n:
        best = None
        if ord(s[i]) > 127:
            for lead in sorted(byte_options(s[i], page)):
                size = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 0
                if not size or i + size > n:
                    continue
                tails = [[b for b in byte_options(c, page) if 0x80 <= b <= 0xBF] for c in s[i + 1 : i + size]]
                if not all(tails):
                    continue
                try:
                    best = (bytes([lead, *(t[0] for t in tails)]).decode("utf-8"), size)
                    break
                except UnicodeDecodeError:
                    continue
        if best:
            out.append(best[0])
            i += best[1]
        else:
            out.append(s[i])
            i += 1
    return "".join(out)


def undo_wide(s: str, source: str) -> str | None:
    """A multi-byte text read byte by byte: decoded piece by piece where a piece decodes as a whole."""
    raw = [page_byte(c, "cp1252") for c in s]
    if -1 not in raw:
        try:
            return bytes(raw).decode(source)
        except UnicodeDecodeError:
            pass
    changed, out, at = False, [], 0
    for m in [*PIECE.finditer(s), None]:
        piece = s[at : m.start() if m else len(s)]
        if not piece.isascii() and -1 not in (codes := raw[at : at + len(piece)]):
            try:
                piece, changed = bytes(codes).decode(source), True
            except UnicodeDecodeError:
                pass
        out.append(piece)
        if m:
            out.append(m.group())
            at = m.end()
    return "".join(out) if changed else None


@lru_cache(maxsize=None)
def page_letters(page: str) -> frozenset[str]:
    """The high characters of a single-byte page. Undefined bytes are shown as control characters."""
    return frozenset(chr(b) if (c := bytes([b]).decode(page, "replace")) == LOST else c for b in range(128, 256))


def undo_wide_page(s: str, page: str) -> str | None:
    """UTF-8 read in a multi-byte page, stretch by stretch between characters the page does not hold."""
    try:
        text = s.encode(page).decode("utf-8")
        return text if text != s else None
    except UnicodeDecodeError:
        return None
    except UnicodeEncodeError:
        pass
    out, held, changed = [], bytearray(), False

    def flush(stretch: str) -> None:
        nonlocal changed
        try:
            out.append(held.decode("utf-8"))
            changed |= out[-1] != stretch
        except UnicodeDecodeError:
            out.append(stretch)
        held.clear()

    start = 0
    for i, c in enumerate(s):
        try:
            held += c.encode(page)
        except UnicodeEncodeError:
            flush(s[start:i])
            out.append(c)
            start = i + 1
    flush(s[start:])
    return "".join(out) if changed else None


WIDE_SHOWN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\uff61-\uff9f]")
#: Characters of no text: control, unassigned, private and surrogate ones.
NO_TEXT = regex.compile(r"[\p{Cc}\p{Cn}\p{Co}\p{Cs}--[\t\n]]", regex.V1)


def candidates(s: str) -> list[tuple[str, str]]:
    """``(swap, text)`` of all texts that a text read through encodings of several bytes may have been."""
    found: dict[str, str] = {}
    ended = regex.sub("([ÃРà√])(?=[ _]|$)", "\\1" + chr(0xA0), s)  # a no-break space that was trimmed or folded away
    wide = WIDE_SHOWN.search(s) is not None
    for t in dict.fromkeys((s, ended)):
        layer = {t: ""}
        while layer:  # each layer may have been read in another page, and makes the text shorter
            under: dict[str, str] = {}
            for now, path in layer.items():
                for page in SINGLE_PAGES:
                    if not may_hold_utf8(page).search(now):
                        continue
                    for kind, undo in (("", undo_utf8), ("~", undo_recased)):
                        then = undo(now, page)
                        if then != now and then not in found:
                            found[then] = f"{path}utf-8>{page}{kind}"
                            under[then] = found[then] + " "
            layer = under
        for page in WIDE_PAGES if wide else ():
            if (r := undo_wide_page(t, page)) is not None:
                found.setdefault(r, f"utf-8>{page}")
    if not page_letters("cp1252").isdisjoint(s):
        for source in WIDE_SOURCES:
            for t, kind in ((s, ""), (s.upper(), "~")):
                if (r := undo_wide(t, source)) is not None:
                    found.setdefault(r, f"{source}>cp1252{kind}")
    found.pop(s, None)
    return [(k, t) for t, k in found.items() if not NO_TEXT.search(t)]


# Letters as numbers: their code point, but for what counts as one letter.
EDGE, WIDE = 0x110000, 0x110001
SPACE, DIGIT, HAN, HANGUL = ord("_"), ord("0"), 0x4E00, 0xAC00
IDEOGRAPHS = ((0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """The number of each character's letter: digits, blanks, ideographs and syllables count as one each, and so do cases."""
    out = np.arange(EDGE + 2)
    for o in range(0x20000):
        c = chr(o)
        low = c.lower()
        out[o] = DIGIT if c.isdigit() else SPACE if c in " _\t\n" else ord(low) if len(low) == 1 else o
    for low, high in IDEOGRAPHS:
        out[low : high + 1] = HAN
    out[0xAC00:0xD7A4] = HANGUL
    return out


class Steps:
    """The steps from letter to letter of a batch of texts: ``a``, ``b`` and the text ``of`` each, and what stands for ideographs."""

    def __init__(self, texts: list[str]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.full(int(sizes.sum()) + len(texts) + 1, EDGE, np.int64)
        of = np.repeat(np.arange(len(texts)), sizes + 1) if len(texts) else np.zeros(0, np.int64)
        inside = np.ones(len(codes), bool)
        inside[np.append(0, np.cumsum(sizes + 1))] = False
        codes[inside] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        letters = folded()[codes]
        keep = np.append(True, ~((letters[1:] == SPACE) & (letters[:-1] == SPACE)))
        letters, codes, of = letters[keep], codes[keep], np.append(-1, of)[keep]
        some = (letters[:-1] != EDGE) | (letters[1:] != EDGE)
        self.a, self.b, self.of, self.n = letters[:-1][some], letters[1:][some], of[1:][some], len(texts)
        wide = (letters == HAN) | (letters == HANGUL)
        self.wide, self.wide_of = codes[wide], of[wide]

    def counts(self, weight: np.ndarray | None = None) -> pd.DataFrame:
        """``a, b, n``: how often each step occurs, and behind ``WIDE`` each ideograph, by the weights of the texts."""
        w = np.ones(self.n) if weight is None else weight
        keys = np.concatenate([self.a << 21 | self.b, WIDE << 21 | self.wide])
        which, place = np.unique(keys, return_inverse=True)
        n = np.bincount(place, np.concatenate([w[self.of], w[self.wide_of]]), len(which))
        return pd.DataFrame({"a": which >> 21, "b": which & 0x1FFFFF, "n": n})[n > 0]


class Letters:
    """Bigrams of letters, and the share of each character among ideographs and among syllables."""

    def __init__(self, counts: pd.DataFrame):
        self._grid: np.ndarray | None = None
        self.counts = counts = counts.groupby(["a", "b"], as_index=False)["n"].sum()
        pairs, wide = counts[counts["a"] != WIDE], counts[counts["a"] == WIDE]
        self.keys = pairs["a"].to_numpy(np.int64) << 21 | pairs["b"].to_numpy(np.int64)
        self.n = pairs["n"].to_numpy(float)
        self.total = np.bincount(pairs["a"].to_numpy(np.int64), self.n, EDGE + 2)
        self.single = np.bincount(pairs["b"].to_numpy(np.int64), self.n, EDGE + 2)
        self.all = self.single.sum() or 1.0
        self.wide = np.bincount(wide["b"].to_numpy(np.int64), wide["n"].to_numpy(float), EDGE + 2)
        self.wide_total = self.total_of_wide()
        known = self.step(self.keys >> 21, self.keys & 0x1FFFFF)
        #: What a step of a text costs on average, and how far it spreads.
        self.mean = float((known * self.n).sum() / max(self.n.sum(), 1e-9))
        self.spread = float(np.sqrt((((known - self.mean) ** 2) * self.n).sum() / max(self.n.sum(), 1e-9)))

    def __reduce__(self):
        return Letters, (self.counts,)  # sent small, worked out anew

    def total_of_wide(self) -> np.ndarray:
        out = np.zeros(EDGE + 2)
        out[HAN] = sum(self.wide[low : high + 1].sum() for low, high in IDEOGRAPHS)
        out[HANGUL] = self.wide[0xAC00:0xD7A4].sum()
        return out

    def step(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The log of the probability of each step."""
        keys, k = a << 21 | b, SMOOTHING * 4
        n = np.zeros(len(keys))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            n = np.where(self.keys[at] == keys, self.n[at], 0.0)
        return np.log((n + k * (self.single[b] + 0.01) / (self.all + 50.0)) / (self.total[a] + k))

    def grid(self, symbols: np.ndarray) -> np.ndarray:
        """The log of the probability of every step between some letters, worked out once."""
        if self._grid is None:
            self._grid = self.step(np.repeat(symbols, len(symbols)), np.tile(symbols, len(symbols))).reshape(len(symbols), -1).astype(np.float32)
        return self._grid

    def scores(self, steps: Steps) -> np.ndarray:
        out = np.bincount(steps.of, self.step(steps.a, steps.b), steps.n)
        share = np.log((self.wide[steps.wide] + 0.05) / (self.wide_total[folded()[steps.wide]] + 500.0))
        return out + np.bincount(steps.wide_of, share, steps.n)


@lru_cache(maxsize=1)
def single_byte_pages() -> tuple[str, ...]:
    """Every single-byte code page over ASCII that the runtime knows, those met most first."""
    out = list(FIRST_PAGES)
    for name in sorted({m.name for m in pkgutil.iter_modules(encodings.__path__)}):
        try:
            if name.endswith("escape") or not codecs.lookup(name)._is_text_encoding or bytes(range(32, 127)).decode(name) != bytes(range(32, 127)).decode("ascii"):
                continue
            high = [bytes([b]).decode(name, "replace") for b in range(128, 256)]
            two = bytes(range(128, 256)).decode(name, "replace")
        except (LookupError, UnicodeError, ValueError):
            continue
        # one character a byte, alone and in a row, some of them letters of the page's own
        if name not in out and all(len(c) == 1 for c in high) and "".join(high) == two and sum(c.isalpha() for c in high) >= 20 and high != [chr(b) for b in range(128, 256)]:
            out.append(name)
    return tuple(out)


def shown_as(page: str) -> list[str]:
    """What a page shows for the bytes from 128 on. Undefined bytes are shown as control characters."""
    return [chr(b) if (c := bytes([b]).decode(page, "replace")) == LOST else c for b in range(128, 256)]


class Pairs:
    """All ordered pairs of single-byte pages as substitutions: for each the letter behind every shown character, -1 where it fits none."""

    def __init__(self):
        pages = single_byte_pages()
        shown = {p: shown_as(p) for p in pages}
        self.chars = np.array(sorted({ord(c) for p in pages for c in shown[p]}), np.int64)
        letter = np.array([chr(c).isalpha() for c in self.chars])
        rows, self.names, seen = [], [], set()
        alone = np.where(letter, -1, self.chars)
        at = {p: np.searchsorted(self.chars, [ord(c) for c in shown[p]]) for p in pages}
        for page in pages:
            for source in pages:
                was = np.array([ord(c) if c.isalpha() else -1 for c in shown[source]])
                row = alone.copy()
                row[at[page][was >= 0]] = was[was >= 0]
                if source != page and row.tobytes() not in seen:
                    seen.add(row.tobytes())
                    rows.append(row)
                    self.names.append(f"{source}>{page}")
        self.original = np.array(rows)
        found = np.where(self.original >= 0, folded()[self.original], -1).T
        #: The letters that may stand in a reading, and the place of each among them: one row a shown character.
        self.symbols = np.unique(np.concatenate([found[found >= 0], folded()[:128], [EDGE]]))
        self.letters = np.where(found >= 0, np.searchsorted(self.symbols, found), -1).astype(np.int32)
        self.shown = np.searchsorted(self.symbols, folded()[self.chars]).clip(max=len(self.symbols) - 1)
        self.same = self.symbols[self.shown] == folded()[self.chars]
        self.is_letter = letter


@lru_cache(maxsize=1)
def pairs() -> Pairs:
    return Pairs()


#: How much likelier than the text as it stands a reading must be, in nats, before a pair of pages takes part; there are some thousand pairs.
GAIN = 8.0
#: A cipher changes a letter of the text it is of, a sign between letters, or at least so many signs.
LEAST_SIGNS = 3
#: Stands for any sign of a cipher.
SIGN = chr(0xF8FF)


def explained(values: list[str], others: list[list[str]], letters: Letters) -> list[tuple[int, str]]:
    """``(pair of pages, text)`` for the texts that some pair makes far likelier than they are as they stand and than their other readings.

    Only texts less probable than texts are on average take part in this
    learning. The first of equally likely pairs counts, so texts of one cipher
    meet in one pair.
    """
    known = pairs()
    grid = letters.grid(known.symbols)
    ascii_places = np.searchsorted(known.symbols, folded()[:128])
    steps = Steps(values)
    score, size = letters.scores(steps), np.bincount(steps.of, minlength=steps.n)
    odd = score < size * letters.mean - letters.spread * np.sqrt(size)
    np.maximum.at(score, np.repeat(np.arange(len(values)), [len(o) for o in others]), letters.scores(Steps([t for o in others for t in o])))
    out = []
    for i in np.flatnonzero(odd):
        codes = np.frombuffer(values[i].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        high = codes > 127
        at = np.minimum(np.searchsorted(known.chars, codes[high]), len(known.chars) - 1)
        if not high.any() or (known.chars[at] != codes[high]).any():
            continue
        alpha = np.fromiter(map(str.isalpha, values[i]), bool, len(codes))
        inner = np.append(False, alpha[:-1]) & np.append(alpha[1:], False)
        own = known.letters[at]  # shown characters by pairs
        changed = (own != known.shown[at][:, None]) | ~known.same[at][:, None]
        fit = np.flatnonzero((own >= 0).all(axis=0) & ((changed & (known.is_letter[at] | inner[high])[:, None]).any(axis=0) | (changed.sum(axis=0) >= LEAST_SIGNS)))
        if not len(fit):
            continue
        text = np.full((len(codes) + 2, len(fit)), np.searchsorted(known.symbols, EDGE), np.int32)
        text[1:-1][~high] = ascii_places[codes[~high]][:, None]
        text[1:-1][high] = own[:, fit]
        total = grid[text[:-1], text[1:]].sum(axis=0)
        best = int(np.argmax(total))
        if total[best] > score[i] + GAIN:
            out.append((int(fit[best]), values[i]))
    return out


#: Weight of the pair of pages in the posterior over letters, and how often a character must be met to be read otherwise.
PRIOR_LETTER, LEAST_SHOWN, SURE = 0.9, 5, 0.9


def learn_cipher(pair: int, shown: pd.DataFrame, letters: Letters, rounds: int = 8) -> dict[str, str]:
    """The original of every shown character of a cipher, from how often shown characters follow each other (``a, b, n``).

    Expectation-maximisation with the mapping as the hidden variable: each
    shown character has a posterior over the letters of the model, worked out
    from those of its neighbours. The pair of pages gives the prior; where it
    has no letter, all are alike. No two shown characters come to stand for one
    letter, as a cipher is one to one.
    """
    known = pairs()
    prior = {int(c): int(o) for c, o in zip(known.chars, known.original[pair]) if o >= 0 and o != c and c > 127}
    fold = folded()
    alphabet = np.array([x for x in np.unique(letters.keys >> 21) if 127 < x < EDGE and x not in (HAN, HANGUL) and chr(x).isalpha()], np.int64)
    out = {chr(c): chr(o) for c, o in prior.items()}
    if not len(alphabet) or shown.empty:
        return out
    a, b, n = (shown[c].to_numpy() for c in ("a", "b", "n"))
    free = np.array(sorted(x for x in set(a.tolist()) | set(b.tolist()) if 127 < x < EDGE and chr(x).isalpha()), np.int64)
    if not len(free):
        return out
    was = np.array([fold[prior[c]] if c in prior else -1 for c in free.tolist()])
    match = was[:, None] == alphabet[None, :]
    log_prior = np.log(np.where(match.any(axis=1)[:, None], np.where(match, PRIOR_LETTER, (1 - PRIOR_LETTER) / len(alphabet)), 1 / len(alphabet)))
    fixed = np.array([x for x in np.unique(np.concatenate([a, b])) if x not in set(free.tolist())], np.int64)
    fixed_letters = np.array([fold[prior.get(int(x), int(x))] if x < EDGE else EDGE for x in fixed], np.int64)
    every = np.concatenate([alphabet, fixed_letters])
    grid = letters.step(np.repeat(every, len(every)), np.tile(every, len(every))).reshape(len(every), -1)
    place = {int(x): i for i, x in enumerate(np.concatenate([free, fixed]))}
    count = np.zeros((len(place), len(place)))
    np.add.at(count, ([place[int(x)] for x in a], [place[int(x)] for x in b]), n)
    belief = np.zeros((len(place), len(every)))
    belief[np.arange(len(free), len(place)), np.arange(len(alphabet), len(every))] = 1.0
    belief[: len(free), : len(alphabet)] = np.exp(log_prior)
    for _ in range(rounds):
        log = log_prior + ((count @ belief @ grid.T) + (count.T @ belief @ grid))[: len(free), : len(alphabet)]
        log -= log.max(axis=1, keepdims=True)
        posterior = np.exp(log)
        belief[: len(free), : len(alphabet)] = posterior / posterior.sum(axis=1, keepdims=True)
    met = count.sum(axis=0)[: len(free)]
    taken = set(out.values())
    for k, c in enumerate(free.tolist()):
        best = int(belief[k, : len(alphabet)].argmax())
        if met[k] >= LEAST_SHOWN and belief[k, best] >= SURE and alphabet[best] != was[k] and taken.isdisjoint((chr(alphabet[best]), chr(alphabet[best]).upper())):
            out[chr(c)] = chr(alphabet[best])
            taken.add(out[chr(c)])
    return out


def is_lost(s: str) -> bool:
    """Text that no encoding swap restores and no right decoding gives: replacement or C1 control characters."""
    return LOST in s or CONTROL.search(s) is not None


def posteriors(pdf: pd.DataFrame, letters: Letters, share: dict[tuple[str, str], float]) -> tuple[list[str], list[str], np.ndarray, np.ndarray, Steps]:
    """All readings of a batch, each text as it stands first: texts, swaps, the row of each, its probability in the row, and its steps."""
    texts, swaps, row = [], [], []
    for i, (v, cands) in enumerate(zip(pdf["value"], pdf["cands"])):
        texts += [v, *(c["text"] for c in cands)]
        swaps += ["", *(c["swap"] for c in cands)]
        row += [i] * (len(cands) + 1)
    rows = np.array(row, np.int64)
    clean: dict[str, float] = {}
    for (source, _), n in share.items():
        clean[source] = clean.get(source, 0.0) + n
    sources = pdf["source"].tolist()
    options = np.bincount(rows, minlength=len(pdf)) - 1
    if share:
        weight = np.array([share.get((sources[r], k), 1e-6) if k else max(1e-6, 1.0 - clean.get(sources[r], 0.0)) for r, k in zip(row, swaps)])
    else:
        weight = np.array([PRIOR / max(20, options[r]) if k else max(1e-6, 1.0 - PRIOR) for r, k in zip(row, swaps)])
    steps = Steps(texts)
    log = np.log(weight) + letters.scores(steps)
    top = np.full(len(pdf), -np.inf)
    np.maximum.at(top, rows, log)
    p = np.exp(log - top[rows])
    return texts, swaps, rows, p / np.bincount(rows, p, len(pdf))[rows], steps


_CANDIDATES = "source string, value string, odd boolean, cands array<struct<swap:string,text:string>>"
_COUNTS = "a long, b long, n double"
_SHARES = "source string, swap string"


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf[["source", "value"]].assign(odd=[ODD.search(v) is not None for v in pdf["value"]], cands=[[{"swap": k, "text": t} for k, t in candidates(v)] for v in pdf["value"]])


def _plain_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield Steps([v for v in pdf["value"] if not is_lost(v)]).counts()


#: Rows of counts taken to the driver; alphabets and ideographs together stay far below, so more is an error and no cut.
MOST_COUNTS = 20_000_000


def _collect(parts: DataFrame) -> pd.DataFrame:
    """Sums of counts. They are bounded by the square of the letters of alphabets and the number of ideographs, whatever the input; the bound is checked."""
    keys = [c for c in parts.columns if c != "n"]
    sums = parts.groupBy(*keys).agg(F.sum("n").alias("n")).limit(MOST_COUNTS + 1).toPandas()
    if len(sums) > MOST_COUNTS:
        raise ValueError(f"more than {MOST_COUNTS} counts")
    return sums


def learn_ciphers(foreign: DataFrame, letters: Letters) -> dict[str, dict[str, dict[str, str]]]:
    """The ciphers of each source, by name: the original of every shown character."""
    sent = foreign.sparkSession.sparkContext.broadcast(letters)

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for source, part in pdf.groupby("source"):
                met: dict[int, list[str]] = {}
                for pair, text in explained(part["value"].tolist(), [[c["text"] for c in cands] for cands in part["cands"]], sent.value):
                    met.setdefault(pair, []).append(text)
                for pair, texts in met.items():
                    codes = [np.array([EDGE, *map(ord, t), EDGE]) for t in texts]
                    yield pd.DataFrame({"source": source, "pair": pair, "a": np.concatenate([c[:-1] for c in codes]), "b": np.concatenate([c[1:] for c in codes]), "n": 1.0})

    found = _collect(foreign.select("source", "value", "cands").mapInPandas(meet, f"source string, pair int, {_COUNTS}"))
    out: dict[str, dict[str, dict[str, str]]] = {}
    for (source, pair), shown in found.groupby(["source", "pair"]):
        out.setdefault(source, {})[pairs().names[pair]] = learn_cipher(pair, shown, letters)
    return out


def readings(ciphers: dict[str, dict[str, dict[str, str]]]):
    """The texts that the ciphers of a row's source make of its value, by ``translate()``, as an array of swap and text."""
    value, none = F.col("value"), F.array().cast("array<struct<swap:string,text:string>>")
    out = none
    for source, tables in sorted(ciphers.items()):
        found = []
        for name, table in sorted(tables.items()):
            shown = "".join(sorted(table))
            text = F.translate(value, shown, "".join(table[c] for c in sorted(table)))
            rest = F.translate(value, shown, "")
            letters, signs = "".join(filter(str.isalpha, shown)), "".join(c for c in shown if not c.isalpha())
            changed = F.length(value) - F.length(rest)
            letter = F.length(F.translate(value, letters, "")) < F.length(value)
            inner = F.translate(value, signs, SIGN * len(signs)).rlike(f"\\p{{L}}{SIGN}\\p{{L}}")
            fits = (changed > 0) & (letter | (changed >= LEAST_SIGNS) | inner) & ~rest.rlike("[\\p{L}&&[^\\x00-\\x7f]]")
            found.append(F.when(fits, F.struct(F.lit(name).alias("swap"), text.alias("text"))))
        out = F.when(F.col("source") == source, F.filter(F.array(*found), lambda x: x.isNotNull())).otherwise(out)
    return out


def garbled_values(values: DataFrame, rounds: int = ROUNDS, scratch: Scratch | None = None) -> DataFrame:
    """``source, value, garbled, swap, restored`` for every text of ``values`` that may be garbled.

    ``values`` holds distinct ``source`` and ``value``, none null. ``garbled``
    is true where the text as it stands is the less probable or holds characters
    no decoding gives; ``restored`` is the most probable original, null if there
    is none. All texts count in the model, none are sampled; what reaches the
    driver are bigram counts, bounded by the alphabets, and one share a source
    and swap.
    """
    scratch = scratch or Scratch(values.sparkSession)
    context = values.sparkSession.sparkContext
    high = F.col("value").rlike("[^\\x00-\\x7f]")
    found = scratch.put(spread(values.where(high).select("source", "value")).mapInPandas(_find, _CANDIDATES))
    plain = values.where(~high).select("value").unionByName(found.where("not odd").select("value"))
    base = _collect(plain.mapInPandas(_plain_counts, _COUNTS))
    ciphers = learn_ciphers(found, Letters(base))
    several = scratch.put(found.withColumn("cands", F.concat("cands", readings(ciphers))))
    scratch.drop(found)
    open_cases = several.where("size(cands) > 0")
    counts, share = base, {}
    fixed = _collect(values.where(~high).select("value").unionByName(several.where("size(cands) = 0").select("value")).mapInPandas(_plain_counts, _COUNTS)) if rounds > 1 else base
    sizes = {r["source"]: r["n"] for r in values.groupBy("source").agg(F.count("*").alias("n")).collect()}  # one row a source
    for _ in range(rounds - 1):
        sent = context.broadcast((Letters(counts), share))

        def expect(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                texts, swaps, rows, p, steps = posteriors(pdf, *sent.value)
                weight = np.array([0.0 if q <= 1e-3 or is_lost(t) else q for t, q in zip(texts, p)])
                yield steps.counts(weight).assign(source=None, swap=None)
                taken = pd.DataFrame({"source": pdf["source"].to_numpy()[rows], "swap": swaps, "n": p})
                yield taken[taken["swap"] != ""].groupby(["source", "swap"], as_index=False)["n"].sum().assign(a=-1, b=-1)[["a", "b", "n", "source", "swap"]]

        more = _collect(open_cases.mapInPandas(expect, f"{_COUNTS}, {_SHARES}"))
        counts = pd.concat([fixed, more.loc[more["a"] >= 0, ["a", "b", "n"]]])
        taken = more[more["a"] < 0]
        share = {(s, k): (n + PRIOR * PRIOR_TEXTS / 20) / (sizes[s] + PRIOR_TEXTS) for s, k, n in zip(taken["source"], taken["swap"], taken["n"])}
    sent = context.broadcast((Letters(counts), share))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, swaps, rows, p, _ = posteriors(pdf, *sent.value)
            first = np.searchsorted(rows, np.arange(len(pdf) + 1))
            out = []
            for i, (source, v) in enumerate(zip(pdf["source"], pdf["value"])):
                own = p[first[i] + 1 : first[i + 1]]
                garbled = is_lost(v) or p[first[i]] < 0.5
                best = first[i] + 1 + int(own.argmax()) if garbled and len(own) else None
                out.append((source, v, garbled, swaps[best] if best else None, texts[best] if best else None))
            yield pd.DataFrame(out, columns=["source", "value", "garbled", "swap", "restored"])

    return several.where((F.size("cands") > 0) | F.col("value").rlike(f"[{STRAY}{LOST}]")).mapInPandas(judge, "source string, value string, garbled boolean, swap string, restored string")


FIELDS = (("tags", "source_tag", "tag_id"), ("tags", "tag", "tag_id"), ("tag_aliases", "alias", "alias_index"))


def garbled_fields(tags: DataFrame, aliases: DataFrame) -> DataFrame:
    """``table_name, field_name, row_id, value, swap, restored`` of every garbled field.

    Null, empty and ASCII texts are never garbled. Texts are judged once a
    source, which is a table and field, and the rows meet their text's verdict
    in a join of which the verdicts' side holds garbled texts only; repeated rows
    give one row each.
    """
    scratch = Scratch(tags.sparkSession)
    frames = {"tags": tags, "tag_aliases": aliases}
    rows = reduce(
        DataFrame.unionByName,
        (
            frames[table].select(F.lit(table).alias("table_name"), F.lit(field).alias("field_name"), F.lit(f"{table}.{field}").alias("source"), F.col(key).alias("row_id"), F.col(field).alias("value")).where("value is not null")
            for table, field, key in FIELDS
        ),
    )
    judging = Scratch(tags.sparkSession)
    verdicts = scratch.put(garbled_values(rows.select("source", "value").distinct(), scratch=judging).where("garbled").drop("garbled"))
    judging.close()
    return rows.where(F.col("value").rlike("[^\\x00-\\x7f]")).join(verdicts, ["source", "value"]).select("table_name", "field_name", "row_id", "value", "swap", "restored")
