"""Fill-in-the-middle: texts cut in three at boundaries of units, found by ranks in a wavelet matrix.

Every character has a class, chosen so that each unit's boundaries are the characters of some classes.
The classes of all texts of a block stand one behind the other in one wavelet matrix: a bit vector per
binary digit of the class, each stably parted by the one before. ``rank(c, i)`` counts a class among the
first ``i`` characters in as many lookups as a class has digits. Sums of ranks at a text's two ends
give its number of boundaries; the place of the k-th one is found by bisection on such sums, for
all texts of the block at once. Cuts, order and markers then follow from hashes of the ids.

Tasks work on blocks of texts of bounded size, a longer text being a block by itself; no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.llm.common import SPACE_CHARS, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK_CHARS = 4 << 20

# Classes. A word begins at a character that is no white space and has none before it.
REST, WORD_START, SPACE, LINE_END = range(4)
DIGITS = 2
#: Classes of the characters that end a unit, and of those that begin one.
ENDS = {"line": (LINE_END,), "character": (REST, WORD_START, SPACE, LINE_END)}
BEGINS = {"word": (WORD_START,)}

_WORD_BITS = 64


class BitVector:
    """Bits with the number of ones before any place: a count per 64 bits and the bits themselves."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // _WORD_BITS + 1, dtype="<u8")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of small symbols in a sequence."""

    def __init__(self, symbols: np.ndarray, digits: int = DIGITS):
        self.size, self.levels, self.zeros = len(symbols), [], []
        for digit in reversed(range(digits)):
            bits = (symbols >> digit & 1).astype(bool)
            self.levels.append(BitVector(bits))
            self.zeros.append(len(bits) - int(np.count_nonzero(bits)))
            if digit:
                symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``at`` symbols, for an array of places."""
        begin = np.zeros_like(at)
        for depth, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            begin_ones, at_ones = level.ones(begin), level.ones(at)
            if symbol >> (len(self.levels) - 1 - depth) & 1:
                begin, at = zeros + begin_ones, zeros + at_ones
            else:
                begin, at = begin - begin_ones, at - at_ones
        return at - begin


def classes_of(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every code point; ``starts`` are the places where texts begin."""
    found = np.full(len(codes), REST, dtype=np.uint8)
    space = np.zeros(len(codes), dtype=bool)
    for char in SPACE_CHARS:
        space |= codes == ord(char)
    after_space = np.empty(len(codes), dtype=bool)
    after_space[1:] = space[:-1]
    after_space[starts[starts < len(codes)]] = True
    found[after_space] = WORD_START
    found[space] = SPACE
    found[codes == ord("\n")] = LINE_END
    return found


class Boundaries:
    """The units of all texts of a block."""

    def __init__(self, texts: list[str], unit: str):
        if unit not in ENDS and unit not in BEGINS:
            raise ValueError(f"unit is one of {sorted([*ENDS, *BEGINS])}")
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.matrix = WaveletMatrix(classes_of(codes, self.starts))
        self.symbols, self.at_begin = (BEGINS[unit], True) if unit in BEGINS else (ENDS[unit], False)
        self.offset = self.marks(self.starts)
        marked = self.marks(self.ends) - self.offset
        if self.at_begin:
            # What comes before the first word belongs to it; white space alone is one unit.
            self.units = np.maximum(marked, lengths > 0)
        else:
            # What follows the last end is a unit too.
            last = np.where(lengths > 0, self.marks(self.ends) - self.marks(np.maximum(self.ends - 1, 0)), 1)
            self.units = marked + (last == 0)

    def marks(self, at: np.ndarray) -> np.ndarray:
        """Characters of the unit's classes among the first ``at``: a sum of ranks."""
        return sum(self.matrix.rank(s, at) for s in self.symbols)

    def places(self, k: np.ndarray) -> np.ndarray:
        """Where the first ``k`` units of each text end, counted from the text's beginning.

        The smallest place with ``k`` ends before it, or the place of the begin number ``k + 1``, found by
        bisection on ranks.
        """
        wanted = self.offset + k + self.at_begin
        low, high = self.starts.copy(), self.ends.copy()
        while np.any(low < high):
            middle = (low + high) // 2
            enough = self.marks(middle) >= wanted
            open_ = low < high
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        if self.at_begin:
            low = np.where(k >= self.units, self.ends, low - 1)
        return np.where(k <= 0, 0, np.where(k >= self.units, self.ends, low) - self.starts)


@dataclass(frozen=True)
class Recipe:
    """``rate`` and ``spm_rate`` are percentages: texts to be cut, and cut texts with the suffix first."""

    unit: str = "line"
    seed: int = 7
    rate: int = 100
    spm_rate: int = 50

    def draws(self, key: str) -> list[int]:
        """Four numbers below 2^32 that follow from the seed and the id."""
        digest = hashlib.sha256(f"{self.seed}:{key}".encode()).digest()
        return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def is_plain(text: str, draw: int, recipe: Recipe) -> bool:
    return not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or draw % 100 >= recipe.rate


def transform_block(keys: list[str], texts: list[str], recipe: Recipe) -> list[tuple]:
    """(n, form, prefix_chars, middle_chars, output) for each text."""
    units = Boundaries(texts, recipe.unit)
    draws = np.array([recipe.draws(k) for k in keys], dtype=np.int64).reshape(-1, 4)
    first, second = draws[:, 0] % (units.units + 1), draws[:, 1] % (units.units + 1)
    begin, end = units.places(np.minimum(first, second)), units.places(np.maximum(first, second))
    out = []
    for text, n, b, e, (_, _, kept, order) in zip(texts, units.units.tolist(), begin.tolist(), end.tolist(), draws.tolist()):
        if is_plain(text, kept, recipe):
            out.append((n, "plain", None, None, text))
            continue
        prefix, middle, suffix = text[:b], text[b:e], text[e:]
        if order % 100 < recipe.spm_rate:
            out.append((n, "spm", b, e - b, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"))
        else:
            out.append((n, "psm", b, e - b, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"))
    return out


def restored(output: str, form: str) -> str:
    """The text that ``output`` was made of. No marker is in a text that was cut, and a marker has its first
    character nowhere else, so each is found where it was put."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(first):
        raise ValueError(f"not in the form {form}")
    one, found, rest = output[len(first) :].partition(second)
    two, also, middle = rest.partition(MIDDLE)
    if not found or not also:
        raise ValueError(f"not in the form {form}")
    return one + middle + two if form == "psm" else two + middle + one


def blocks(keys: list[str], texts: list[str]) -> Iterator[tuple[list[str], list[str]]]:
    """Rows in order, a block ending when it has ``BLOCK_CHARS`` characters."""
    begin, held = 0, 0
    for k, text in enumerate(texts, 1):
        held += len(text)
        if held >= BLOCK_CHARS or k == len(texts):
            yield keys[begin:k], texts[begin:k]
            begin, held = k, 0


def fill_in_middle(key: Column, text: Column, recipe: Recipe = Recipe()) -> Column:
    """(n, form, prefix_chars, middle_chars, output): the text cut after two boundaries of units drawn by key.

    Units are lines with their line end, words with the white space behind them (that before the first word
    belongs to it), or characters. ``n`` counts them; the middle lies between the two drawn boundaries and
    may be empty, as may prefix and suffix. Lengths count code points. Texts that are empty or null, hold a
    marker or are not drawn stay ``plain``, with null lengths. A null key is drawn as the empty key; rows
    with equal keys and texts, repeated ones too, get equal results. A very long text takes time in
    proportion to its length and memory for a few bytes a character. Works on the two columns alone: other
    columns and their names play no part; an empty table gives an empty one.
    """

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def cut(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [row for some in blocks(keys.tolist(), texts.tolist()) for row in transform_block(*some, recipe)]
        frame = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"], dtype=object)
        return frame.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return cut(F.coalesce(key.cast("string"), F.lit("")), text_of(text))


def restore(output: Column, form: Column) -> Column:
    """The text that an output of ``fill_in_middle`` was made of; null where either is null."""

    @F.pandas_udf("string")
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None or f is None else restored(o, f) for o, f in zip(outputs, forms)], dtype=object)

    return back(output, form)
