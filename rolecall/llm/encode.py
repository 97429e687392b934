"""Text to token ids, with the ids of recurring pieces remembered.

A byte-pair tokenizer first cuts a text into pieces and encodes each piece by itself, so the ids
of a whole text are the ids of its pieces in order. Remembering pieces gives the same ids several
times faster. The cuts used here are never finer than the tokenizer's own.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterable, Iterator

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters that this module and the tokenizers may not agree on; texts with them go in whole.
_ODD = re.compile("[\x1c-\x1f\x85᠎​﻿]")
#: White space to Python, but not to the tokenizers.
_SPLIT_HERE_ONLY = "\x1c\x1d\x1e\x1f\x85"
_OTHER_WHITE = re.compile(r"[^\S \n]")
_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Pieces longer than this are not remembered.
_LONG = 48
#: Words learned in one call, and characters of texts that wait for it.
_LEARNED_AT_ONCE = 4000
_HELD_CHARS = 1 << 19
#: Signs that are tokens apart from the letter or digit before them, if they end a word.
_SIGNS = string.punctuation


def _whole(special) -> re.Pattern:
    """What sends a text in whole: its pieces may not stand alone. A special token is known by its first two characters."""
    return re.compile("|".join([_ODD.pattern, *sorted({re.escape(t.content[:2]) for t in special})]))


def _groups(pieces: set[str], keeps_spaces: bool) -> list[tuple[str, list[str]]]:
    """(what to put between them, pieces) that can stand in one text without changing each other."""
    if not keeps_spaces:
        return [(" ", list(pieces))] if pieces else []
    spaced, bare, rest = [], [], []
    for p in pieces:
        if not p[0].isspace():
            bare.append(p)  # as at the start of a line
        elif len(p) > 1 and not p[1].isspace():
            spaced.append(p)  # their own space parts them
        else:
            rest.append(p)
    return [(by, found) for by, found in [("", spaced), ("\n", bare), *(("", [p]) for p in rest)] if found]


def _token_spans(found, pieces: list[str], between: str) -> tuple[list[int], list[int]]:
    """First token of each piece of a text encoded as one, and the one after its last."""
    if len(pieces) == 1:
        return [0], [len(found.ids)]
    begins = np.array([b for b, _ in found.offsets], dtype=np.int64)
    sizes = np.array([len(p) for p in pieces])
    stops = np.cumsum(sizes + len(between)) - len(between)
    return np.searchsorted(begins, stops - sizes).tolist(), np.searchsorted(begins, stops).tolist()


def words_of(text: str) -> list[str]:
    """One key per word of a text that begins with a space or a line end: words after a space, line ends with the word after them."""
    led = text[0] == " "
    return (text[1:] if led else text).replace("\n", " \n").split(" ")[not led :]


def plain_words(keys: set[str], together: str) -> bool:
    """Whether no other white space than single spaces and line ends parts the words of these keys."""
    return not ("" in keys or "\n" in keys or _OTHER_WHITE.search(together))


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    keeps_spaces: whether the tokenizer's pieces carry white space (byte-level) or drop it.
    plain_special: whether special tokens' strings inside a text are plain text; else they are the special tokens,
    as the library has it unless told otherwise.
    remembered: most pieces held at once; the bound on memory.
    """

    def __init__(self, path: str, keeps_spaces: bool, plain_special: bool = False, remembered: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_special
        self.whole = _whole([] if plain_special else self.tokenizer.get_added_tokens_decoder().values())
        self.keeps_spaces = keeps_spaces
        self.learn = self.keys_of if keeps_spaces else self.pieces_of
        # byte-level tokenizers part words and signs by a pattern
        self.parts_signs = keeps_spaces and getattr(self.tokenizer.pre_tokenizer, "use_regex", False)
        self.signs: dict[str, bytes] = {}
        self.line_end = self.direct(["\n"])[0]
        # bytes of each id, where entries spell bytes as letters
        vocabulary = self.tokenizer.get_vocab() if keeps_spaces else {}
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.sizes[list(vocabulary.values())] = [len(entry) for entry in vocabulary]
        self.half = remembered // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def direct(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def pieces_of(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of each piece by itself, from few calls."""
        out = {}
        for between, some in _groups(pieces, self.keeps_spaces):
            found = self.tokenizer.encode(between.join(some), add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4").tobytes()
            for piece, b, e in zip(some, *_token_spans(found, some, between), strict=True):
                out[piece] = ids[4 * b : 4 * e]
        return out

    def keys_of(self, keys: set[str]) -> dict[str, bytes]:
        """Ids of the keys of ``words_of``: a word after a space, or a line end and a word.

        All are one text for the library. Where a key ends in the ids is told by the bytes that each id stands for, since
        offsets cost as much as the ids.
        """
        spaced = [k for k in keys if k[0] != "\n"]
        order = [*spaced, *(k for k in keys if k[0] == "\n")]
        text = " " * bool(spaced) + " ".join(spaced) + "".join(order[len(spaced) :])
        if text:
            found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.cumsum(self.sizes[found])
            sizes = np.fromiter(map(len, order if text.isascii() else map(str.encode, order)), dtype=np.int64, count=len(order))
            sizes[: len(spaced)] += 1
            stops = np.cumsum(sizes)
            if len(ends) and ends[-1] == stops[-1]:
                at = np.searchsorted(ends, stops)
                if np.array_equal(ends[at], stops):
                    ids, cuts = found.tobytes(), (4 * (at + 1)).tolist()
                    return {k: ids[b:e] for k, b, e in zip(order, [0, *cuts[:-1]], cuts, strict=True)}
        found = self.pieces_of({" " + k for k in spaced} | {k[1:] for k in keys if k[0] == "\n"})
        return {k: self.line_end + found[k[1:]] if k[0] == "\n" else found[" " + k] for k in keys}

    def _put_together(self, unseen: set[str]) -> dict[str, bytes]:
        """Ids of the pieces that are a remembered one with signs behind it."""
        own = {}
        for piece in unseen:
            if piece[-1] in _SIGNS:
                word = piece.rstrip(_SIGNS)
                if word and word[-1] < "\u0250" and word[-1].isalpha() and word in self.young:
                    tail = piece[len(word) :]
                    if tail not in self.signs:
                        if len(self.signs) >= _LEARNED_AT_ONCE:
                            self.signs.clear()
                        self.signs[tail] = self.direct([tail])[0]
                    own[piece] = self.young[word] + self.signs[tail]
        return own

    def _learned(self, unseen: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not in the younger half of the memory; all but long ones are now remembered."""
        if len(self.young) + len(unseen) > self.half:
            self.old, self.young = self.young, {}
        own = {p: self.old[p] for p in unseen if p in self.old}
        if self.parts_signs:
            own.update(self._put_together(unseen.difference(own)))
        own.update(self.learn(unseen.difference(own)))
        short = max(map(len, own)) <= _LONG
        self.young.update(own if short else {p: ids for p, ids in own.items() if len(p) <= _LONG})
        return own

    def __call__(self, text: str | None) -> bytes:
        return next(self.many([text]))

    def many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text in turn. New words are learned for several texts at once: a call costs as much as many words."""
        held, unseen, size = [], set(), 0
        for text in texts:
            held.append(self._met(text))
            unseen |= held[-1][3]
            size += len(text or "")
            if len(unseen) >= _LEARNED_AT_ONCE or size >= _HELD_CHARS:
                yield from self._joined(held, unseen)
                held, unseen, size = [], set(), 0
        yield from self._joined(held, unseen)

    def _met(self, text: str | None) -> tuple[int, list[str], list[bytes | None], set[str]]:
        """(bytes to leave out in front, pieces, their ids as far as they are remembered, the other pieces)."""
        if not text:
            return 0, [], [], set()
        before = 0
        if self.keeps_spaces:
            # a first word counts as after a line end
            led = text[0] == " "
            before = 0 if led else len(self.line_end)
            pieces = words_of(text if led else "\n" + text)
        elif any(c in text for c in _SPLIT_HERE_ONLY):
            return 0, [], self.direct([text]), set()
        else:
            pieces = text.split()
        parts = list(map(self.young.get, pieces))
        if None not in parts:
            return before, [], parts, set()
        # remembered pieces are known to stand alone: only unseen ones are looked into
        unseen = {p for p, ids in zip(pieces, parts, strict=True) if ids is None}
        together = "".join(unseen)
        if len(unseen) > self.half or self.whole.search(together):
            return 0, [], self.direct([text]), set()
        if self.keeps_spaces and not plain_words(unseen, together):
            return 0, [], [self._spaced(text)], set()
        return before, pieces, parts, unseen

    def _joined(self, held: list[tuple[int, list[str], list[bytes | None], set[str]]], unseen: set[str]) -> Iterator[bytes]:
        own = self._learned(unseen) if unseen else {}
        for before, pieces, parts, new in held:
            found = b"".join(map(own.get, pieces, parts) if new else parts)
            yield found[before:] if before else found

    def _spaced(self, text: str) -> bytes:
        """By way of the tokenizer's own cuts, for texts with other white space than single spaces and line ends."""
        if self.whole.search(text):
            return self.direct([text])[0]
        found = _SPACED.findall(text)
        return b"".join(map(self.pieces_of(set(found)).__getitem__, found))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, keeps_spaces: bool, plain_special: bool = False) -> Encoder:
    """One encoder per Python worker: its file is read once, its memory is kept between tasks."""
    key = (path, keeps_spaces, plain_special)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, keeps_spaces, plain_special)
    return _ENCODERS[key]


class SpanEncoder:
    """(begin, end) characters of each token of a text, as two arrays.

    Recurring pieces are remembered as the spans of their tokens from the piece's first character.
    """

    def __init__(self, path: str, keeps_spaces: bool, remembered: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.whole = _whole(self.tokenizer.get_added_tokens_decoder().values())
        self.keeps_spaces = keeps_spaces
        self.cut = _SPACED if keeps_spaces else re.compile(r"[^ \n]+")
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def direct(self, texts: list[str]) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [tuple(zip(*x.offsets, strict=True)) or ((), ()) for x in found]

    def pieces_of(self, pieces: set[str]) -> dict[str, bytes]:
        """(begin, end) of each piece's tokens within the piece, as pairs of 32-bit integers."""
        out = {}
        for between, some in _groups(pieces, self.keeps_spaces):
            found = self.tokenizer.encode(between.join(some), add_special_tokens=False)
            spans = np.array(found.offsets, dtype="<i4").reshape(-1, 2)
            starts = np.cumsum([0, *(len(p) + len(between) for p in some[:-1])]).astype("<i4")
            if len(spans):
                spans = spans - starts[np.searchsorted(starts, spans[:, 0], side="right") - 1][:, None]
            pairs = spans.tobytes()
            for piece, b, e in zip(some, *_token_spans(found, some, between), strict=True):
                out[piece] = pairs[8 * b : 8 * e]
        return out

    def _cut(self, text: str) -> tuple[list[str], np.ndarray]:
        """(pieces, where each begins)."""
        if self.keeps_spaces:  # the pieces cover the text
            pieces = self.cut.findall(text)
            sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
            return pieces, np.cumsum(sizes) - sizes
        found = [(m.start(), m[0]) for m in self.cut.finditer(text)]
        return [p for _, p in found], np.array([at for at, _ in found], dtype=np.int64)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        if not text or self.whole.search(text):
            begins, ends = self.direct([text])[0] if text else ((), ())
            return np.array(begins, dtype=np.int64), np.array(ends, dtype=np.int64)
        pieces, starts = self._cut(text)
        known = self.known
        own = self.pieces_of(set(pieces).difference(known))
        if own:
            spans = [own[p] if p in own else known[p] for p in pieces]
            if len(known) + len(own) > self.remembered:
                known.clear()
            known.update((p, s) for p, s in own.items() if len(p) <= _LONG)
        else:
            spans = list(map(known.__getitem__, pieces))
        counts = np.fromiter(map(len, spans), dtype=np.int64, count=len(spans)) >> 3
        pairs = np.frombuffer(b"".join(spans), dtype="<i4").reshape(-1, 2)
        shift = np.repeat(starts, counts)
        return pairs[:, 0] + shift, pairs[:, 1] + shift


_SPANS: dict[tuple, SpanEncoder] = {}


def spans_encoder(path: str, keeps_spaces: bool) -> SpanEncoder:
    key = (path, keeps_spaces)
    if key not in _SPANS:
        _SPANS[key] = SpanEncoder(path, keeps_spaces)
    return _SPANS[key]
