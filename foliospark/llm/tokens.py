"""Token ids of whole texts by the ``tokenizers`` library.

The vocabularies used here never merge across the end of a word. So a text is cut where that is certain (before white space, and between a Latin letter
and an ASCII character that is none), each distinct piece goes through the library once per worker, and a text's ids are joined from its words, and a new word's from its
pieces. A text with any other kind of white space than blank, tab and line ends goes through the library as it is.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Sequence
from itertools import chain, islice, repeat

import numpy as np

from foliospark.llm.common import held

_OTHER_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_W, _L = " \\t\\n\\r\\x0b\\x0c", "A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u012f\\u0131-\\u024f"  # not U+0130, whose lower case ends in a mark
# No piece ends between a character and a following one beyond ASCII, which may be a letter or combine with it.
_PIECES = re.compile(f"[{_W}]*+[{_L}]++(?![^\\x00-\\x7f])|[{_W}]*+[^{_W}{_L}]++[{_L}]*+(?![^\\x00-\\x7f])|[{_W}]*+[^{_W}]++|[{_W}]++")
_WORDS = re.compile(f"[{_W}]*+[^{_W}]++|[{_W}]++")
_PLAIN, _PLAIN_LED = re.compile(f"[{_L}]++"), re.compile(f" [{_L}]++")
KNOWN_BYTES = 160 << 20  # of words and pieces kept per worker, the first ones; others are encoded again when they come back
ENTRY_BYTES = 190  # of an entry besides twice its characters
RUN_WORDS = 2_000
CHARS_AT_ONCE = 1 << 19


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, known_bytes: int = KNOWN_BYTES):
        self.known_bytes = known_bytes
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        # The ids of words and pieces, one after another; both have the same ids where they are the same.
        self.code: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype="<u4")
        self.start, self.size = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.used = self.bytes = 0
        vocabulary = self.library.get_vocab()
        self.marks_end = any(t.endswith("</w>") for t in vocabulary)
        self.marked = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.marked[number] = token.endswith("</w>") if self.marks_end else token.startswith("\u0120")

    def _keep(self, words: Sequence[str], ids: np.ndarray, size: np.ndarray) -> None:
        """Note the ids of new words, ``size`` of them each."""
        n, used = len(self.code), self.used + len(ids)
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(used, dtype="<u4")])
        if n + len(words) > len(self.start):
            more = np.zeros(n + len(words), dtype=np.int64)
            self.start, self.size = np.concatenate([self.start, more]), np.concatenate([self.size, more])
        self.ids[self.used:used] = ids
        self.size[n:n + len(words)] = size
        self.start[n:n + len(words)] = self.used + np.cumsum(size) - size
        self.code.update(zip(words, range(n, n + len(words))))
        self.used = used

    def _codes(self, words: Iterable[str], count: int) -> np.ndarray:
        return np.fromiter(map(self.code.get, words, repeat(-1)), dtype=np.int64, count=count)

    def _ids_of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words, and how many each has."""
        size = self.size[code]
        stop = np.cumsum(size)
        return self.ids[np.arange(int(stop[-1]) if len(code) else 0) + np.repeat(self.start[code] - stop + size, size)], size

    def _alone(self, pieces: list[str]) -> None:
        found = [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self._keep(pieces, np.fromiter(chain.from_iterable(found), dtype="<u4", count=int(size.sum())), size)

    def _in_runs(self, pieces: list[str]) -> None:
        """Runs of letters, many in one string: the vocabulary marks the token that ends a word, or begins one after a blank."""
        for at in range(0, len(pieces), RUN_WORDS):
            run = pieces[at:at + RUN_WORDS]
            ids = np.array(self.library.encode_batch_fast([(" " if self.marks_end else "").join(run)], add_special_tokens=False)[0].ids, dtype="<u4")
            edge = np.flatnonzero(self.marked[ids])
            cut = np.concatenate([[0], edge + 1] if self.marks_end else [edge, [len(ids)]])
            if len(cut) != len(run) + 1:
                raise ValueError("words and tokens do not match")
            self._keep(run, ids, np.diff(cut))

    def _add(self, new: set[str]) -> None:
        """Encode new words; one that is no plain run of letters is joined from its pieces."""
        plain = (_PLAIN if self.marks_end else _PLAIN_LED).fullmatch
        letters = set(filter(plain, new))
        parts = {w: [w] if _OTHER_SPACE.search(w) else _PIECES.findall(w) for w in new - letters}
        pieces = {p for some in parts.values() for p in some if p not in self.code}
        letters.update(filter(plain, pieces))
        self._in_runs(list(letters))
        self._alone([p for p in pieces if p not in letters])
        joined = [w for w, some in parts.items() if len(some) != 1]
        count = np.fromiter((len(parts[w]) for w in joined), dtype=np.int64, count=len(joined))
        ids, size = self._ids_of(self._codes((p for w in joined for p in parts[w]), int(count.sum())))
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        self._keep(joined, ids, np.diff(ends))

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, a part of the texts at a time, so that memory is bounded unless a single text is large."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= CHARS_AT_ONCE):
                size += len(texts[stop])
                stop += 1
            out += self._encoded(texts[at:stop])
            at = stop
        return out

    def _encoded(self, texts: Sequence[str]) -> list[bytes]:
        # Where the vocabulary marks the ends of words, white space has no ids of its own.
        split = str.split if self.marks_end else _WORDS.findall
        split_texts = [[t] if _OTHER_SPACE.search(t) else split(t) for t in texts]
        words = list(chain.from_iterable(split_texts))
        before, used = len(self.code), self.used
        code = self._codes(words, len(words))
        missing = np.flatnonzero(code < 0)
        if len(missing):
            unknown = [words[i] for i in missing.tolist()]
            self._add(set(unknown))
            code[missing] = self._codes(unknown, len(unknown))
        ids, size = self._ids_of(code)
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(list(map(len, split_texts)), dtype=np.int64)])].tolist()
        data = memoryview(ids.tobytes())
        out = [bytes(data[4 * a:4 * b]) for a, b in zip(ends, ends[1:])]
        added = list(islice(reversed(self.code), len(self.code) - before))
        grown = ENTRY_BYTES * len(added) + 2 * sum(map(len, added))
        if self.bytes + grown > self.known_bytes:
            for w in added:
                del self.code[w]
            self.used = used
        else:
            self.bytes += grown
        return out


def encoder(path: str, known_bytes: int = KNOWN_BYTES) -> Encoder:
    """The worker's encoder of this vocabulary file; a smaller table of words costs time, not results."""
    return held(("encoder", path, known_bytes), lambda: Encoder(path, known_bytes))
