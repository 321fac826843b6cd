"""Byte-level BPE encoding by a lazily determinised transducer, decoding by an incremental UTF-8 machine.

**Encoding.** Merges by rank give the tokens t1 ... tn if and only if every token is what its own bytes
merge to and every two neighbours stay apart when their bytes are merged alone: merges on either side
of a place that no merge crosses do not depend on each other. So the merges compile into a transducer
that reads bytes and guesses where tokens end: a guess holds the token before and the bytes of the open
one, a token may end only if it fits the one before. Every prefix has exactly one encoding, so there is
at most one guess per place where the open token may have begun, fewer than the longest token has bytes.

The transducer is determinised while it runs: a state is the list of guesses with the tokens on which
they do not agree yet; what all guesses agree on is emitted at once. A step from a state by a byte is
worked out when it is first taken and looked up afterwards. Guesses whose open token leads nowhere
die out, so the lookahead is bounded and so is a state; a text's length plays no part. Steps, pairs
and distinct pieces are kept in tables of bounded size that are emptied when full; that costs time only.

**Decoding** reads ids in blocks and gives text as far as characters are complete. The machine's state is
the beginning of a character that is not complete yet, three bytes at most.

No shuffle, nothing is sent to the driver; the vocabulary goes to the tasks as bytes.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.llm.common import text_of

MAX_STATES = 300_000
MAX_PAIRS = 400_000
MAX_PIECES = 250_000
# Pieces that begin alike share the steps by their first bytes.
HEAD, MAX_HEADS = 5, 150_000
LONG_PIECE = 64
BLOCK = 50_000
LONG_TEXT = 1 << 20
NONE = -1

#: White space of the pattern, as the property White_Space has it.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

NODE_BITS = 20
NODE_MASK = (1 << NODE_BITS) - 1


class Trails:
    """Tokens that wait to be emitted, as numbers: a trail is another one and a token behind it.

    The trails 0 to the number of ids are empty; they only know the token before them (id + 1, 0 for none),
    which a trail that has tokens need not know.
    """

    def __init__(self, size: int):
        self.size = size
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.clear()

    def clear(self) -> None:
        empty = self.size + 1
        self.before = list(range(-1, self.size))  # the last token, or the one before an empty trail
        self.first = [NONE] * empty
        self.parent = [NONE] * empty
        self.ids = [b""] * empty
        self.known: dict[int, int] = {}
        self.shorter: dict[int, int] = {}

    def extend(self, trail: int, token: int) -> int:
        if self.first[trail] == NONE:
            # The token before the first waiting one says nothing of what follows.
            trail = 0
        key = trail * self.size + token
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.before)
            self.before.append(token)
            self.first.append(token if self.first[trail] == NONE else self.first[trail])
            self.parent.append(trail)
            self.ids.append(self.ids[trail] + self.packed[token])
        return found

    def rest(self, trail: int) -> int:
        """The trail without its first token, which then is the token before."""
        found = self.shorter.get(trail)
        if found is None:
            parent, token = self.parent[trail], self.before[trail]
            found = token + 1 if self.first[parent] == NONE else self.extend(self.rest(parent), token)
            self.shorter[trail] = found
        return found

    def tokens(self, trail: int) -> tuple[int, list[int]]:
        """The empty trail at the beginning and the tokens behind it."""
        found = []
        while self.first[trail] != NONE:
            found.append(self.before[trail])
            trail = self.parent[trail]
        return trail, found[::-1]


class Transducer:
    """Bytes to token ids. A guess is a number: the trail of tokens not emitted yet, and in the lower bits
    the node of the tree of tokens that the open one has reached."""

    def __init__(self, ranks: dict[bytes, int]):
        lacking = [b for b in range(256) if bytes([b]) not in ranks]
        if lacking:
            raise ValueError(f"the vocabulary has no token for the bytes {lacking}")
        self.ranks = ranks
        self.token_bytes = {i: t for t, i in ranks.items()}
        self.size = max(self.token_bytes) + 1
        self._grow_tree()
        self.trails = Trails(self.size)
        self.spines: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.guesses: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.steps: dict[int, tuple[int, bytes]] = {}
        # What is left where a text ends in a state, and steps by several bytes from the start at once.
        self.ends: list[bytes] = []
        self.heads: dict[bytes, tuple[int, bytes]] = {}
        self._number((0,))

    def _grow_tree(self) -> None:
        """Children by (node, byte), the token that ends at a node, and whether a longer one goes on."""
        self.children: dict[int, int] = {}
        self.token_at, self.goes_on = [NONE], [True]
        for token, data in self.token_bytes.items():
            node = 0
            for byte in data:
                self.goes_on[node] = True
                key = node << 8 | byte
                node = self.children.get(key, NONE)
                if node == NONE:
                    node = self.children[key] = len(self.token_at)
                    self.token_at.append(NONE)
                    self.goes_on.append(False)
            self.token_at[node] = token
        if len(self.token_at) > NODE_MASK:
            raise ValueError("the vocabulary has too many tokens")

    def _start_anew(self, guesses: list[int]) -> tuple[int, ...]:
        """Empty the tables but for the start and ``guesses``, whose new numbers are returned."""
        held = [(*self.trails.tokens(g >> NODE_BITS), g & NODE_MASK) for g in guesses]
        for kept in (self.guesses, self.numbers, self.steps, self.ends, self.heads, self.trails):
            kept.clear()
        self._number((0,))
        found = []
        for trail, tokens, node in held:
            for token in tokens:
                trail = self.trails.extend(trail, token)
            found.append(trail << NODE_BITS | node)
        return tuple(found)

    def _number(self, guesses: tuple[int, ...]) -> int:
        found = self.numbers.setdefault(guesses, len(self.guesses))
        if found == len(self.guesses):
            self.guesses.append(guesses)
            # The newest guess has all bytes in whole tokens.
            self.ends.append(self.trails.ids[guesses[-1] >> NODE_BITS])
        return found

    def encode(self, data: bytes) -> bytes:
        """The ids of ``data`` as little-endian unsigned 32-bit integers."""
        head = data[:HEAD]
        found = self.heads.get(head)
        if found is None:
            found = self._run(0, head)
            if len(self.heads) >= MAX_HEADS:
                self.heads.clear()
            self.heads[head] = found
        state, emitted = found
        if len(data) > HEAD:
            state, more = self._run(state, data[HEAD:])
            emitted += more
        return emitted + self.ends[state]

    def _run(self, state: int, data: bytes) -> tuple[int, bytes]:
        """The state that ``data`` leads to, and what is emitted on the way."""
        out, known = [], self.steps.get
        for byte in data:
            step = known(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
            state, emitted = step
            if emitted:
                out.append(emitted)
        return state, b"".join(out)

    def _step(self, state: int, byte: int) -> tuple[int, bytes]:
        """Work out one step of the determinised machine and keep it."""
        child, token_at, goes_on, trails = self.children.get, self.token_at, self.goes_on, self.trails
        going: list[int] = []
        ended = NONE
        for guess in self.guesses[state]:
            node = child((guess & NODE_MASK) << 8 | byte)
            if node is None:
                continue
            if ended == NONE:
                token = token_at[node]
                if token != NONE:
                    trail = guess >> NODE_BITS
                    if self._fits(trails.before[trail], token):
                        ended = trails.extend(trail, token) << NODE_BITS
            if goes_on[node]:
                going.append((guess & ~NODE_MASK) | node)
        if ended == NONE:
            raise AssertionError("every prefix has an encoding")
        going.append(ended)
        emitted = b""
        while True:
            # Most often the oldest guess waits for its first token.
            token = trails.first[going[0] >> NODE_BITS]
            if token == NONE or any(trails.first[g >> NODE_BITS] != token for g in going):
                break
            emitted += trails.packed[token]
            going = [trails.rest(g >> NODE_BITS) << NODE_BITS | g & NODE_MASK for g in going]
        if len(self.guesses) >= MAX_STATES:
            return self._number(self._start_anew(going)), emitted
        step = self.steps[state << 8 | byte] = self._number(tuple(going)), emitted
        return step

    def _spine(self, token: int) -> tuple | None:
        """How a token's own bytes merge: the ranks of the merges in order, then a number above all, and
        the first and the last part before each of them and at the end. None if they do not merge to
        the token."""
        if token not in self.spines:
            data, ranks, never = self.token_bytes[token], self.ranks, self.size
            parts = [data[k : k + 1] for k in range(len(data))]
            order, firsts, lasts = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                rank, k = min((ranks.get(parts[k] + parts[k + 1], never), k) for k in range(len(parts) - 1))
                if rank == never:
                    break
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                order.append(rank)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            self.spines[token] = ([*order, never], firsts, lasts) if len(parts) == 1 else None
        return self.spines[token]

    def _fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left``: no merge crosses the place between them."""
        key = left * self.size + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self._apart(left, right)
        return found

    def _apart(self, left: int, right: int) -> bool:
        follows = self._spine(right)
        if follows is None or left == NONE:
            return follows is not None
        order, _, lasts = self._spine(left)
        next_order, firsts, _ = follows
        rank_of, never = self.ranks.get, self.size
        i = j = 0
        while True:
            a, b = order[i], next_order[j]
            across = rank_of(lasts[i] + firsts[j], never)
            # The lowest rank first, of equal ones the leftmost.
            if across < a and across <= b and across != never:
                return False
            if a <= b:
                if a == never:
                    return True
                i += 1
            else:
                j += 1


def ids_to_bytes(ids: Iterable[int]) -> bytes:
    return b"".join(i.to_bytes(4, "little") for i in ids)


class Pieces(dict):
    """Ids of distinct pieces. A piece that is a token itself is taken whole, as the library does.

    A full table becomes the old one, in which pieces are looked for before they are encoded again: what
    is frequent stays, and at most two tables are held.
    """

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            data = piece.encode()
            whole = self.machine.ranks.get(data)
            found = ids_to_bytes([whole]) if whole is not None else self.machine.encode(data)
        if len(piece) <= LONG_PIECE:
            if len(self) >= MAX_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


class Utf8Stream:
    """Bytes to text in any portions; what is no UTF-8 becomes U+FFFD, one for each longest beginning
    of a character.

    The state is the beginning of a character at the end of what came so far. It is carried into the next
    portion; a byte that begins a character ends whatever was before it, so all up to there is settled.
    """

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        """The characters that ``data`` completes; the beginning of another one is held."""
        data = self.held + data
        settled = len(data) - unfinished(data[-3:])
        self.held = data[settled:]
        return data[:settled].decode("utf-8", "replace")

    def close(self) -> str:
        """What is left when no byte follows."""
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def unfinished(tail: bytes) -> int:
    """How many of the last bytes, three at most, begin a character that can still be completed."""
    for k in range(len(tail) - 1, -1, -1):
        wanted, low, high = lead(tail[k])
        if wanted == NONE:
            continue  # no first byte: look for the one before
        for byte in tail[k + 1 :]:
            if not wanted or not low <= byte <= high:
                return 0
            wanted, low, high = wanted - 1, 0x80, 0xBF
        return len(tail) - k if wanted else 0
    return 0


def lead(byte: int) -> tuple[int, int, int]:
    """Bytes that follow a first byte, and the range of the next; ``NONE`` if it begins no character."""
    if byte < 0x80:
        return 0, 0, 0
    if 0xC2 <= byte <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte <= 0xF4:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return NONE, 0, 0


def decoded(blocks: Iterable[np.ndarray], token_bytes: dict[int, bytes]) -> Iterator[str]:
    """The text of a stream of ids, in portions; ids that are no tokens raise KeyError."""
    stream = Utf8Stream()
    for block in blocks:
        yield stream.feed(b"".join(map(token_bytes.__getitem__, block.tolist())))
    yield stream.close()


@dataclass(frozen=True)
class Vocabulary:
    """What the tasks get: the rank file, the pattern, the pattern with ranges in place of classes for
    any text and for ASCII alone, and the code points (ranges) on whose class the pattern's library and
    the splitting library here do not agree."""

    ranks: bytes
    pattern: str
    exact_pattern: str
    ascii_pattern: str
    disputed: str

    def __hash__(self) -> int:
        return hash((self.ranks, self.pattern))


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """The rank file and the pattern, read on the driver.

    The two libraries follow different versions of Unicode, so letters of late versions are letters to
    one only. Each is asked for its classes once, here.
    """
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}

    def members(kind: str) -> str:
        library = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
        return bytes(library.encode_ordinary(every)).decode()

    letters, numbers = members(r"\p{L}"), members(r"\p{N}")
    disputed = set(letters) ^ set(regex.findall(r"\p{L}", every)) | set(numbers) ^ set(regex.findall(r"\p{N}", every))
    return Vocabulary(
        Path(path).read_bytes(), pattern, with_ranges(pattern, letters, numbers),
        with_ranges(pattern, filter(str.isascii, letters), filter(str.isascii, numbers)), as_ranges(sorted(disputed)),
    )


def with_ranges(pattern: str, letters: Iterable[str], numbers: Iterable[str]) -> str:
    """``pattern`` with explicit ranges in place of its classes."""
    letters, numbers = as_ranges(letters), as_ranges(numbers)
    classes = {
        r"[^\s\p{L}\p{N}]": f"[^{SPACES}{letters}{numbers}]", r"\p{L}": f"[{letters}]", r"\p{N}": f"[{numbers}]",
        r"\S": f"[^{SPACES}]", r"\s": f"[{SPACES}]",
    }
    for name, ranges in classes.items():
        pattern = pattern.replace(name, ranges)
    if "\\p" in pattern:
        raise ValueError("the pattern uses classes other than letters, numbers and white space")
    return pattern


def as_ranges(chars: Iterable[str]) -> str:
    """Sorted characters as ranges inside a character class."""
    codes = np.array([ord(c) for c in chars], dtype=np.int64)
    if not len(codes):
        return ""
    breaks = np.flatnonzero(np.diff(codes) != 1)
    firsts, lasts = codes[np.r_[0, breaks + 1]], codes[np.r_[breaks, len(codes) - 1]]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts.tolist(), lasts.tolist()))


class Codec:
    """Both directions for one vocabulary, one per worker process."""

    _loaded: dict[Vocabulary, Codec] = {}

    def __init__(self, vocabulary: Vocabulary):
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in vocabulary.ranks.splitlines() if line)}
        self.machine = Transducer(ranks)
        self.pieces = Pieces(self.machine)
        self.pattern = regex.compile(vocabulary.pattern)
        self.exact = re.compile(vocabulary.exact_pattern)
        self.ascii = re.compile(vocabulary.ascii_pattern)
        self.disputed = re.compile(f"[{vocabulary.disputed}]") if vocabulary.disputed else None

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> Codec:
        if vocabulary not in cls._loaded:
            cls._loaded[vocabulary] = cls(vocabulary)
        return cls._loaded[vocabulary]

    def encode(self, text: str) -> np.ndarray:
        # All three split alike where they are used; they differ in speed.
        if text.isascii():
            pattern = self.ascii
        else:
            pattern = self.exact if self.disputed is not None and self.disputed.search(text) else self.pattern
        ids_of = self.pieces.__getitem__
        if len(text) < LONG_TEXT:
            found = b"".join(map(ids_of, pattern.findall(text)))
        else:
            matches = (m.group() for m in pattern.finditer(text))
            blocks = iter(lambda: b"".join(map(ids_of, islice(matches, BLOCK))), b"")
            found = b"".join(blocks)
        return np.frombuffer(found, dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        return "".join(decoded((ids[k : k + BLOCK] for k in range(0, len(ids), BLOCK)), self.machine.token_bytes))


def _id_lists(found: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(found) if found else np.array([], dtype="<u4")
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))


def encode(text: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a text as an array of integers.

    Every match of the vocabulary's pattern is encoded by itself, without special tokens; their strings
    are ordinary text. Null and empty texts have no ids. A very long text takes time in proportion to its
    length; memory holds its ids and one block of its pieces. Works on the column alone: other
    columns, their names, ties and repeated rows play no part; an empty table gives an empty one.
    """

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        codec = Codec.of(vocabulary)
        return _id_lists([codec.encode(t.as_py()) for t in texts])

    return ids(text_of(text))


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of an array of ids; null for null, empty for no ids. Bytes that are no UTF-8 become U+FFFD."""

    @F.arrow_udf("string")
    def texts(batch: pa.Array) -> pa.Array:
        codec = Codec.of(vocabulary)
        return pa.array([codec.decode(np.array(x.as_py(), dtype=np.int64)) if x.is_valid else None for x in batch], pa.string())

    return texts(ids)


def round_trip(text: Column, vocabulary: Vocabulary) -> Column:
    """(ids, text): the ids as ``encode`` gives them and what ``decode`` makes of these ids, in one pass
    through one worker."""

    @F.arrow_udf("ids array<int>, text string")
    def both(texts: pa.Array) -> pa.Array:
        codec = Codec.of(vocabulary)
        found = [codec.encode(t.as_py()) for t in texts]
        back = pa.array([codec.decode(x) for x in found], pa.string())
        return pa.StructArray.from_arrays([_id_lists(found), back], ["ids", "text"])

    return both(text_of(text))


def decimal_ids(ids: Column) -> Column:
    """The ids as decimal numbers joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
