"""Token ids by the tokenizers library, fast on repeating text.

A text is cut where the tokenizer itself always cuts, every different piece is encoded
once, and the ids of a text are gathered from those of its pieces.  Plain texts are cut
by numpy over the bytes of many texts at once, and a piece of up to 15 bytes is its own
key in a table of two 64-bit columns; unusual white space and long pieces take a slower
way with the same result.  ``test_llm_tokens`` checks against encoding whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np

from salesforge.llm.common import SHORT, KeyTable, kept, packed

# Unicode White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
# A run of these letters ends where one of these marks, a blank, a line end or the text's
# end follows: there every tokenizer here cuts.  Anything else stays in one piece.
LETTERS, MARKS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", ".,|!?%*#&$"
_LETTERS, _MARKS = rf"[{LETTERS}]+(?=[ \n{MARKS}]|\Z)", rf"[{MARKS}]+(?=[ \n]|\Z)"
#: Byte-level pieces: words with the blank before them; runs of white space, whose last
#: character is on its own or part of the word after it.
BYTE_PIECES = re.compile(f" ?{_LETTERS}|{_MARKS}| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Tokenizers that drop white space: what stands between ASCII white space.
WORD_PIECES = re.compile(rf"{_LETTERS}|{_MARKS}|[^ \t-\r]+")


BLANK, LINE, LETTER, MARK, OTHER, GAP = range(6)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[ord(" "), ord("\n")]] = BLANK, LINE
_CLASS[[c for c in range(128) if chr(c).isalpha()]] = LETTER
_CLASS[[ord(c) for c in MARKS]] = MARK
#: Bytes that are white space, or may begin white space in UTF-8: such texts go the slow way.
_RARE = np.zeros(256, bool)
_RARE[[9, 11, 12, 13, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte; Latin-1 letters (two bytes, 0xC3 first) are letters."""
    cls = _CLASS[data]
    first = np.flatnonzero(data[:-1] == 0xC3)
    second = data[first + 1]
    first = first[(second != 0x97) & (second != 0xB7)]  # the times and division signs
    cls[first] = cls[first + 1] = LETTER
    return cls


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def cuts_of(cls: np.ndarray, blank: bool) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the pieces of plain texts; ``blank``: the blank before a word
    belongs to it, and line ends are pieces."""
    solid = cls > LINE
    solid &= cls != GAP
    edge = np.flatnonzero(np.diff(solid.view(np.int8), prepend=0, append=0))
    start, stop = edge[::2], edge[1::2]
    # A word of letters and then marks is two pieces; anything else stays whole.
    kinds = _sums(cls == LETTER), _sums(cls == MARK)
    letters, marks = (k[stop] - k[start] for k in kinds)
    two = (letters > 0) & (marks > 0) & (letters + marks == stop - start)
    two &= kinds[0][np.where(two, start + letters, start)] - kinds[0][start] == letters
    middle = np.where(two, start + letters, stop)
    if blank:
        before = np.where(start > 0, cls[start - 1], GAP)
        line = start[before == LINE] - 1
        first = start - (before == BLANK)
        starts = np.concatenate([first, middle[two], line])
        stops = np.concatenate([middle, stop[two], line + 1])
    else:
        starts, stops = np.concatenate([start, middle[two]]), np.concatenate([middle, stop[two]])
    order = np.argsort(starts, kind="stable")
    return starts[order], stops[order]


class Encoder:
    """``pieces`` is the pattern of the cuts.  The store of encoded pieces is bounded: it
    is emptied when it holds ``max_pieces`` of them or ``max_bytes`` bytes."""

    def __init__(self, path: str, pieces: re.Pattern, max_pieces: int = 1_200_000, max_bytes: int = 30_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        # Found in any case, for tokenizers that lower-case before they look.
        self.added = re.compile(b"|".join(re.escape(a.encode()) for a in added), re.IGNORECASE) if added else None
        self.pieces, self.max_pieces, self.max_bytes = pieces, max_pieces, max_bytes
        self.blank = pieces is BYTE_PIECES
        self._empty()

    def _empty(self) -> None:
        self.long: dict[bytes, int] = {}
        self.bytes = 0
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.ends, self.size = np.zeros(1 << 16, np.int64), 1  # slot i: ids from ends[i - 1] to ends[i]
        self.slots = KeyTable(self.max_pieces)  # of short pieces

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """The slots of pieces that are encoded now."""
        first = self.size
        for at in range(0, len(new), 10_000):
            part = new[at:at + 10_000]
            found = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            lists = [x.ids for x in found]
            ends = self.used + np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
            while len(self.ids) < ends[-1]:
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            while len(self.ends) < self.size + len(part):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.ids[self.used:ends[-1]] = np.fromiter(chain.from_iterable(lists), np.uint32, int(ends[-1]) - self.used)
            self.ends[self.size:self.size + len(part)] = ends
            self.used, self.size = int(ends[-1]), self.size + len(part)
            self.bytes += sum(map(len, part))
        return np.arange(first, self.size)

    def _by_dict(self, pieces: list[bytes]) -> np.ndarray:
        new = list({p: None for p in pieces if p not in self.long})
        if new:
            self.long.update(zip(new, self._learn(new).tolist()))
        return np.fromiter(map(self.long.__getitem__, pieces), np.int64, len(pieces))

    def _slots_of(self, line: bytes, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        out, lens = np.zeros(len(starts), np.int64), stops - starts
        short = np.flatnonzero(lens <= SHORT)
        at, n = starts[short], lens[short]
        a, b = packed(data, at, n)
        found = self.slots.find(a, b)
        miss = np.flatnonzero(found == 0)
        if len(miss):
            first: dict[bytes, int] = {}
            for i, s, e in zip(miss.tolist(), at[miss].tolist(), (at + n)[miss].tolist()):
                first.setdefault(line[s:e], i)
            places = np.fromiter(first.values(), np.int64, len(first))
            self.slots.put(a[places], b[places], self._learn(list(first)))
            found[miss] = self.slots.find(a[miss], b[miss])
        out[short] = found
        rest = np.flatnonzero(lens > SHORT)
        out[rest] = self._by_dict([line[s:e] for s, e in zip(starts[rest].tolist(), stops[rest].tolist())])
        return out

    def _ids(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the slots one after the other, and where each slot's begin."""
        starts = self.ends[slots - 1]
        lens = self.ends[slots] - starts
        total = np.zeros(len(slots) + 1, np.int64)
        np.cumsum(lens, out=total[1:])
        places = np.repeat(starts - total[:-1], lens)
        places += np.arange(total[-1])
        return self.ids[places], total

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text (UTF-8)."""
        if self.size > self.max_pieces or self.bytes > self.max_bytes:
            self._empty()
        line = b"\0".join([*texts, bytes(16)])
        data = np.frombuffer(line, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes + 1) - 1  # the byte between two texts
        cls = classes(data)
        cls[ends] = cls[ends[-1]:] = GAP
        white = cls <= LINE
        # Not plain: white space other than blanks and line ends, more than one together
        # or one at the end of the text.
        odd = np.flatnonzero(_RARE[data] | (white & np.append(white[1:] | (cls[1:] == GAP), True)))
        slow = np.zeros(len(texts) + 1, bool)
        slow[np.searchsorted(ends, odd)] = True
        whole = sorted({int(np.searchsorted(ends, m.start())) for m in self.added.finditer(line)}) if self.added else []
        slow[whole] = True
        starts, stops = cuts_of(cls, self.blank)
        doc = np.searchsorted(ends, starts)
        keep = ~slow[doc]
        starts, stops, doc = starts[keep], stops[keep], doc[keep]
        ids, begin = self._ids(self._slots_of(line, data, starts, stops))
        at = begin[np.searchsorted(doc, np.arange(len(texts) + 1))].tolist()
        out = [ids[s:e] for s, e in zip(at, at[1:])]
        slow[whole] = False
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids, np.uint32)
        for i in np.flatnonzero(slow[:-1]).tolist():
            pieces = [p.encode() for p in self.pieces.findall(texts[i].decode())]
            out[i] = self._ids(self._by_dict(pieces))[0]
        return out

    def documents(self, texts: list[bytes], end_id: int, room: int = 1_000_000) -> Iterator[np.ndarray]:
        """The ids of each text with ``end_id`` after them, a few texts at a time."""
        at = 0
        while at < len(texts):
            stop, left = at, room
            while stop < len(texts) and (stop == at or left >= len(texts[stop])):
                left -= len(texts[stop])
                stop += 1
            for ids in self.encode(texts[at:stop]):
                yield np.append(ids, np.uint32(end_id))
            at = stop


def encoder(path: str, pieces: re.Pattern) -> Encoder:
    """This worker's encoder for a tokenizer file, kept for its next tasks."""
    same = BYTE_PIECES if pieces.pattern == BYTE_PIECES.pattern else pieces
    return kept(("encoder", path, pieces.pattern), lambda: Encoder(path, same))
