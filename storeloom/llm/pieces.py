"""Byte-level BPE over arrays: pre-tokens of many texts at once, each distinct one encoded once.

The pre-token pattern is the one of the tokenizer files. Its matches are runs
of letters, numbers, other marks or white space, with three adjustments: one
space joins the run after it, a longer white-space run gives up its last
character, and a lone apostrophe joins one of seven endings. So boundaries come
from class changes, without a regular expression over the text.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import tiktoken
from tokenizers import Tokenizer

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Endings after an apostrophe (fixed values of the pattern).
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
#: Pre-tokens longer than this are looked up by their text, shorter ones by a hash.
HASHED = 64
#: Characters per step; bounds the arrays of a step to some 100 MB.
STEP = 1 << 20
#: Distinct pre-tokens kept by a worker.
KEPT = 1 << 20


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point, by the regular expressions of the library itself."""
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    every = "".join(map(chr, points))
    single = {bytes([i]): i for i in range(256)}
    table = np.zeros(0x110000, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        hits = bytes(found.encode_ordinary(every)).decode()
        table[np.frombuffer(hits.encode("utf-32-le"), "<u4")] = kind
    return table


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(
            2 * STEP, b, dtype=np.uint64))]) for b in (base, pow(base, -1, 1 << 64)))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def boundaries(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point; texts start at ``starts``."""
    size = len(points)
    if not size:
        return np.zeros(0, dtype=bool)
    kind = _classes()[points]
    first = np.empty(size, dtype=bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    heads = np.zeros(size + 1, dtype=bool)
    heads[starts] = True
    heads[size] = True
    first |= heads[:size]
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], size)
    inner = ~heads[end]  # the text goes on after the run

    blank = end[(kind[begin] == SPACE) & inner]
    first[blank - 1] = True
    first[blank[points[blank - 1] == 32]] = False

    quote = begin[(points[begin] == 39) & (end == begin + 1) & inner]
    quote = quote[first[quote]]
    tail = np.concatenate([points, np.zeros(3, points.dtype)])
    for ending in ENDINGS:
        match = quote
        for i, letter in enumerate(ending, start=1):
            match = match[(tail[match + i] == ord(letter))]
            match = match[~heads[match + i]]
        first[match + 1] = False
        after = match + 1 + len(ending)
        first[after[after < size]] = True
    return first


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a tokenizer file.

    Visible characters stand for themselves, other bytes for the letters from 256 on.
    """
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = sorted(set(range(256)) - set(visible))
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PieceEncoder:
    """Encodes texts by a rank file (``.tiktoken``) or a tokenizer file (``.json``).

    Added tokens of a tokenizer file become their ids in ``encode``, as in the
    library; a rank file has none.
    """

    def __init__(self, path: str):
        self.tokens: list[bytes] = []
        self._added: dict[str, int] = {}
        self._bytes: tuple[np.ndarray, ...] | None = None
        if path.endswith(".tiktoken"):
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
            self.tokens = [b""] * (max(ranks.values()) + 1)
            for token, rank in ranks.items():
                self.tokens[rank] = token
            encoding = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
            self._encode = lambda pieces: [encoding.encode_ordinary(p) for p in pieces]
        else:
            library = Tokenizer.from_file(path)
            model = library.model
            for token in json.loads(library.to_str())["added_tokens"]:
                if token["single_word"] or token["lstrip"] or token["rstrip"]:
                    raise ValueError(f"added token {token['content']!r} takes more than its text, which is not supported")
                self._added[token["content"]] = token["id"]
            byte = _byte_letters()
            self._encode = lambda pieces: [
                [t.id for t in model.tokenize(p.encode().decode("latin-1").translate(byte))] for p in pieces]
        # Of tokens that start at one place the longest one counts.
        self._marks = re.compile("(" + "|".join(
            map(re.escape, sorted(self._added, key=len, reverse=True))) + ")") if self._added else None
        self._reset()

    def _reset(self) -> None:
        self._keys = np.zeros(0, dtype=np.uint64)  # sorted hashes and their slots
        self._key_slots = np.zeros(0, dtype=np.int64)
        self._long: dict[str, int] = {}
        self._ids = np.zeros(1 << 16, dtype=np.uint32)
        self._from = np.zeros(1 << 16, dtype=np.int64)
        self._count = np.zeros(1 << 16, dtype=np.int64)
        self._used = self._slots_used = 0

    def _learn(self, pieces: list[str]) -> int:
        """Encode new pieces into the next slots; the first slot."""
        encoded = self._encode(pieces)
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        slot, total = self._slots_used, int(counts.sum())
        stop = slot + len(pieces)
        while stop > len(self._from):
            self._from, self._count = (np.concatenate([a, np.zeros_like(a)]) for a in (self._from, self._count))
        while self._used + total > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        self._count[slot:stop] = counts
        self._from[slot:stop] = self._used + np.cumsum(counts) - counts
        self._ids[self._used:self._used + total] = np.fromiter(chain.from_iterable(encoded), np.uint32, total)
        self._used, self._slots_used = self._used + total, stop
        return slot

    def _slots(self, joined: str, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self._slots_used > KEPT:
            self._reset()
        powers, inverse = _powers()
        with np.errstate(over="ignore"):
            sums = np.zeros(len(points) + 1, dtype=np.uint64)
            np.cumsum((points + np.uint64(1)) * powers[:len(points)], out=sums[1:])
            keys = (sums[end] - sums[begin]) * inverse[begin]
            keys ^= (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        slots = np.empty(len(begin), dtype=np.int64)
        is_long = end - begin > HASHED
        short = np.flatnonzero(~is_long) if is_long.any() else slice(None)
        slots[short] = self._short_slots(joined, keys[short], begin[short], end[short])
        for i in np.flatnonzero(is_long).tolist():
            piece = joined[begin[i]:end[i]]
            if piece not in self._long:
                self._long[piece] = self._learn([piece])
            slots[i] = self._long[piece]
        return slots

    def _short_slots(self, joined: str, keys: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        ranked = keys[order]
        head = np.empty(len(ranked), dtype=bool)
        head[:1] = True
        np.not_equal(ranked[1:], ranked[:-1], out=head[1:])
        distinct, where = ranked[head], order[head]
        at = np.searchsorted(self._keys, distinct)
        known = at < len(self._keys)
        known[known] = self._keys[at[known]] == distinct[known]
        found = np.empty(len(distinct), dtype=np.int64)
        found[known] = self._key_slots[at[known]]
        fresh = ~known
        if fresh.any():
            some = where[fresh]
            slot = self._learn([joined[a:b] for a, b in zip(begin[some].tolist(), end[some].tolist())])
            found[fresh] = slot + np.arange(len(some))
            self._key_slots = np.insert(self._key_slots, at[fresh], found[fresh])
            self._keys = np.insert(self._keys, at[fresh], distinct[fresh])
        slots = np.empty(len(keys), dtype=np.int64)
        slots[order] = found[np.cumsum(head) - 1]
        return slots

    def encode_pieces(self, joined: str, points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, begin, ends)``: piece starts and, per piece, where its ids end."""
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], len(points))
        if not len(begin):
            return np.zeros(0, np.uint32), begin, begin
        slots = self._slots(joined, points, begin, end)
        counts = self._count[slots]
        ends = np.cumsum(counts)
        index = np.repeat(self._from[slots] - (ends - counts), counts) + np.arange(ends[-1])
        return self._ids[index], begin, ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self._marks is None or not any(map(self._marks.search, texts)):
            return self._encode_plain(texts)
        # Every second part is an added token; what is between two is a text of its own.
        parts = [self._marks.split(t) for t in texts]
        plain = iter(self._encode_plain([p for held in parts for p in held[::2]]))
        return [np.concatenate([np.array([self._added[p]], dtype=np.uint32) if i % 2 else next(plain)
                                for i, p in enumerate(held)]) for held in parts]

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, added tokens being ordinary text."""
        out: list[np.ndarray] = []
        group: list[str] = []
        size = 0
        for text in texts:
            if size + len(text) > STEP and group:
                out += self._encode_group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return out + (self._encode_group(group) if group else [])

    def encode_at(self, text: str, starts: np.ndarray) -> np.ndarray:
        """The ids of a text whose pre-tokens start at ``starts``."""
        first = np.zeros(len(text), dtype=bool)
        first[starts] = True
        return self._encode_spans(text, code_points(text), first)[0]

    def _encode_group(self, texts: list[str]) -> list[np.ndarray]:
        joined = "".join(texts)
        points = code_points(joined)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(sizes) - sizes
        ids, before = self._encode_spans(joined, points, boundaries(points, starts[sizes > 0]))
        cuts = before[np.append(starts, len(points))]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _encode_spans(self, joined: str, points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids, and how many of them lie before each character."""
        parts, begun = [], 0
        # A text longer than a step is cut at pre-tokens, which are encoded apart.
        while begun < len(points):
            stop = len(points)
            if stop - begun > 2 * STEP:
                marks = np.flatnonzero(first[begun + 1:begun + 2 * STEP])
                stop = begun + 1 + int(marks[-1]) if len(marks) else begun + 1 + int(
                    np.argmax(np.append(first[begun + 1:], True)))
            parts.append(self._span(joined, points, first, begun, stop))
            begun = stop
        ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint32)
        before = np.zeros(len(points) + 1, dtype=np.int64)
        for _, at, counts in parts:
            before[at + 1] = counts
        return ids, np.cumsum(before)

    def _span(self, joined: str, points: np.ndarray, first: np.ndarray, begun: int, stop: int):
        """Ids of a span of whole pieces, the piece starts and their counts."""
        if stop - begun > 2 * STEP:  # one pre-token beyond any step
            ids = np.asarray(self._encode([joined[begun:stop]])[0], dtype=np.uint32)
            return ids, np.array([begun]), np.array([len(ids)])
        ids, begin, ends = self.encode_pieces(joined[begun:stop], points[begun:stop], first[begun:stop])
        return ids, begin + begun, np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids (rank files only)."""
        if self._bytes is None:
            sizes = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
            self._bytes = np.frombuffer(b"".join(self.tokens), np.uint8), np.cumsum(sizes) - sizes, sizes
        flat, start, size = self._bytes
        out = []
        for i in range(0, len(ids), STEP):
            some = ids[i:i + STEP]
            counts = size[some]
            ends = np.cumsum(counts)
            out.append(flat[np.repeat(start[some] - (ends - counts), counts) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


@lru_cache(4)
def encoder(path: str) -> PieceEncoder:
    """One encoder per worker and file."""
    return PieceEncoder(path)
