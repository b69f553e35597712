"""Byte-level BPE ids of texts of any length, as the ``tokenizers`` library gives them.

The library first splits a text into pieces by a fixed pattern and then merges bytes inside
each piece, so the ids of a text are the ids of its pieces. Pieces repeat, hence their ids
are merged once per worker and cached. Texts whose characters
are all of the ranges below are split here by the same pattern, all
others by the library's own pre-tokenizer.

Long texts are encoded in overlapping chunks. A piece boundary depends on the text to its right
only, so an offset that is a boundary in two overlapping chunks, well before
the end of the first, is a boundary of the whole text: the chunks are spliced there. If
the overlap holds no common boundary, it is widened, up to the whole text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

# fixed values: the tokenizer's special string and its pattern's character classes, spelt out for
# U+0000-U+024F and common punctuation, where the Unicode categories are settled
SPECIAL = "<|endoftext|>"
KNOWN = "\x00-ɏ‐-‧‰-⁞€"
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGIT = "0-9²³¹¼-¾"
SPACE = "\t-\r \x85\xa0"
# the letters' branch stands first: no other branch can match where it does
PIECE = re.compile(rf" ?[{LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{DIGIT}]+| ?[^{SPACE}{LETTER}{DIGIT}]+"
                   rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
UNKNOWN = re.compile(f"[^{KNOWN}]")

CHUNK = 1 << 18       # characters encoded at once
OVERLAP = 1 << 10     # first overlap of neighbouring chunks
MARGIN = 64           # a boundary this far before a chunk's end does not depend on the cut
CACHE = 400_000       # pieces remembered per worker

_open: dict[str, "PieceEncoder"] = {}


def encoder(path: str) -> "PieceEncoder":
    """The worker's encoder for a tokenizer file."""
    if path not in _open:
        _open[path] = PieceEncoder(path)
    return _open[path]


class PieceEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = self.library.token_to_id(SPECIAL)
        self.special = b"" if special is None else special.to_bytes(4, "little")
        self.cache: dict[str, bytes] = {}
        self.merge = self._merger()

    def _merger(self):
        """The ids of one piece. Where ids rise in the order of the merges, the vocabulary is a table of
        ranks, which the tiktoken library merges several times as fast; else the tokenizer's model."""
        vocab = self.library.get_vocab(with_added_tokens=False)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [c for c in range(256) if c not in printable]
        chars = {c: chr(c) for c in printable} | {c: chr(256 + i) for i, c in enumerate(others)}
        byte = {v: k for k, v in chars.items()}
        model = json.loads(self.library.to_str())["model"]
        ids = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if ids == sorted(ids) and min(ids, default=256) > 255:
            import tiktoken

            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t != SPECIAL}
            return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks,
                                     special_tokens={}).encode_ordinary
        one = self.library.model.tokenize
        return lambda piece: [t.id for t in one("".join(map(chars.__getitem__, piece.encode())))]

    def pieces(self, text: str) -> list[str]:
        """The text's pieces in order; the special string is a piece of its own."""
        if self.special and SPECIAL in text:
            out = []
            for i, part in enumerate(text.split(SPECIAL)):
                if i:
                    out.append(SPECIAL)
                if part:
                    out += self.pieces(part)
            return out
        if text.isascii() or not UNKNOWN.search(text):
            return PIECE.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        cache = self.cache
        got = list(map(cache.get, pieces))
        if None in got:
            merge = self.merge
            for p in {p for p, g in zip(pieces, got) if g is None}:
                cache[p] = self.special if p == SPECIAL else array("I", merge(p)).tobytes()
            got = list(map(cache.__getitem__, pieces))
            if len(cache) > CACHE:
                cache.clear()
        return got

    def encode(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[bytes]:
        """Ids of the whole text in consecutive byte strings."""
        if len(text) <= chunk:
            yield b"".join(self.ids(self.pieces(text)))
            return
        start, end, done = 0, chunk, 0  # the chunk's place; ids before the offset ``done`` are out
        here = self.pieces(text[start:end])
        while end < len(text):
            width = min(overlap, end - start)
            while True:
                next_start = end - width
                there_end = min(len(text), end + chunk)
                there = self.pieces(text[next_start:there_end])
                ends = list(accumulate(map(len, here), initial=start))
                common = self._common(ends, there, next_start, max(done, next_start), end - MARGIN)
                if common is not None:
                    break
                if width < end - start:
                    width = min(2 * width, end - start)  # widen the overlap to the left
                else:  # the whole chunk has no common boundary: lengthen the chunk itself
                    end = min(len(text), end + chunk)
                    here = self.pieces(text[start:end])
                    if end == len(text):
                        break
                    width = min(2 * width, end - start)
            if common is None:
                break
            first, last = _index(ends, done), _index(ends, common)
            yield b"".join(self.ids(here[first:last]))
            start, end, done, here = next_start, there_end, common, there
        ends = list(accumulate(map(len, here), initial=start))
        yield b"".join(self.ids(here[_index(ends, done):]))

    @staticmethod
    def _common(ends: list[int], there: list[str], start: int, low: int, high: int) -> int | None:
        """The first offset in (low, high] where both chunks have a piece boundary."""
        mine = {e for e in ends if low < e <= high}
        for e in accumulate(map(len, there), initial=start):
            if e > high:
                return None
            if e in mine and e > start:
                return e
        return None


def _index(ends: list[int], offset: int) -> int:
    from bisect import bisect_left

    i = bisect_left(ends, offset)
    assert ends[i] == offset
    return i
