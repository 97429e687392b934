"""Operator 12: cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers, A and B, cut one text into tokens. Where a token of A and a token of B end at the same byte they are
linked, and those bytes cut both token lists into aligned groups. How often a pair of ids is linked in the whole corpus
says how well it stands for the same thing.

* Each text is encoded once by both, from words that are aligned once each, many texts at a time. Its row keeps its digest
  columns and its different pairs with their multiplicities.
* Postings: for each pair, the documents that hold it, as compressed bitmaps of 65,536 document numbers (a sorted list
  of 16-bit numbers, or the bits themselves once that is shorter). Plane 0 has every document of the pair; plane k has those
  whose multiplicity, less one, has bit k - 1 set. Tasks write partial bitmaps, which are OR-merged by pair and block.
* Popcounts of plane 0 add up to a pair's document count, popcounts of all planes, each with its weight, to its link count.
* Postings then return the scores: a pair's count goes along its bitmaps to the documents, times the multiplicity the planes
  give, and is added up in one array per block of documents. No row per (pair, document) is ever written.

A block has at most one bitmap per pair and plane, so a pair that stands in every document has one short row per
65,536 documents, and no group is longer than a block's documents.

Defined results: a null or empty text, and one whose tokens' bytes do not give back the text (as where a tokenizer
rewrites it), has no tokens: zeros and an empty digest; long texts are encoded whole; repeated rows count once each; ties for
a B id's highest count all count as best; null document ids stay null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolecall.llm.common import stored
from rolecall.llm.encode import _SIGNS, encoder, plain_words, words_of

ALIGNED = (
    "doc_no long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs binary, times binary"
)
BITMAPS = "pair long, block long, plane int, bits binary"
#: Documents of a block, and the size of its bits: lists of 16-bit numbers are shorter than it.
BLOCK, BLOCK_BYTES = 1 << 16, 1 << 13
#: Entries held before partial bitmaps are handed over.
HELD = 1 << 21
#: Bytes and number of the texts that are aligned at once, words learned at once, and rows handed over at once: pairs of
#: very long texts add up.
TEXT_BYTES, TEXTS, LEARNED, ROWS = 1 << 22, 1 << 12, 1 << 15, 1 << 8

#: Letters of which a word is one piece to a byte-level tokenizer's pattern, whatever Unicode version it knows.
_LETTERS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ɏ]+")
_CHUNK = re.compile(r" +[^ ]*")
LOST = b"!"  # no ids are one byte long


# --- tokens as bytes --------------------------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: ids of a text, and each id's bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.encode = encoder(path, True, True)
        letters = _byte_letters()
        vocabulary = self.encode.tokenizer.get_vocab()
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for entry, no in vocabulary.items():
            self.pieces[no] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.sizes = np.array([len(p) for p in self.pieces], dtype=np.int64)
        # words of letters, spelled in byte letters, need no pattern
        tokenizer = self.encode.tokenizer
        plain = tokenizer.normalizer is None and all(t.special for t in tokenizer.get_added_tokens_decoder().values())
        self.parts_signs = self.encode.parts_signs and plain
        self.by_space = Tokenizer(tokenizer.model)
        self.by_space.pre_tokenizer = CharDelimiterSplit(" ")
        self.spelled = {b: " " * (b == 32) + c for c, b in letters.items()}

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), dtype="<u4")

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words of letters, each after a space, and how many each has."""
        raw = (" " + " ".join(words)).encode()
        found = self.by_space.encode_batch_fast([raw.decode("latin-1").translate(self.spelled)[1:]], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype="<u4")
        ends = np.cumsum(self.sizes[ids])
        stops = np.append(np.flatnonzero(np.frombuffer(raw, dtype=np.uint8)[1:] == 32) + 1, len(raw))
        at = np.searchsorted(ends, stops)
        if not len(ends) or ends[-1] != len(raw) or not np.array_equal(ends[at], stops):
            return None
        return ids, np.diff(at, prepend=-1)

    def keys_of(self, keys: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The keys of ``words_of`` in some order, their ids, and how many ids each has."""
        fit = [k for k in keys if _LETTERS.fullmatch(k)] if self.parts_signs else []
        found = self._letters(fit) if fit else None
        if found is None:
            fit, found = [], (np.empty(0, "<u4"), np.empty(0, np.int64))
        rest = list(set(keys).difference(fit)) if len(fit) < len(keys) else []
        own = self.encode.keys_of(set(rest)) if rest else {}
        ids = [own[k] for k in rest]
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        return [*fit, *rest], np.concatenate([found[0], np.frombuffer(b"".join(ids), "<u4")]), np.concatenate([found[1], counts])


class Pieces:
    """Tokenizer B: ids of a text, which it gives a space of its own first, and each id's bytes.

    No piece goes on after a space that ends it, so the ids of a text are those of its chunks (spaces and what follows
    them), which are remembered. A vocabulary with such pieces is asked for whole texts. A chunk whose pieces do not give
    back its bytes is remembered as LOST.
    """

    def __init__(self, path: str, remembered: int = 600_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [self._bytes(name) for name in names]
        self.apart = all("▁" not in name.lstrip("▁") for name in names)
        # a line end is a token of its own, so what follows one is cut as it would be alone
        self.line_ends_alone = self.apart and all(p == b"\n" or b"\n" not in p for p in self.pieces)
        self.parts_signs = self._parts_signs(names)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.lossy = False  # whether any chunk so far was LOST

    def _parts_signs(self, names: list[str]) -> bool:
        """Whether no piece goes on from a letter to a sign, and texts are taken as they are: signs are then cut off every word."""
        try:
            from sentencepiece import sentencepiece_model_pb2
        except ImportError:  # it needs protobuf
            return False
        model = sentencepiece_model_pb2.ModelProto.FromString(self.model.serialized_model_proto())
        bpe = model.trainer_spec.model_type == model.trainer_spec.BPE
        if not bpe or model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.normalization_rule_tsv:
            return False
        of_text = [n for i, n in enumerate(names) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        return not any(x.isalpha() and y in _SIGNS for n in of_text for x, y in zip(n, n[1:]))  # noqa: B905

    @staticmethod
    def _bytes(name: str) -> bytes:
        if re.fullmatch(r"<0x[0-9A-F]{2}>", name):
            return bytes([int(name[3:5], 16)])
        return name.replace("▁", " ").encode()

    def _learned(self, chunks: list[str]) -> dict[str, bytes]:
        found = self.model.encode([c[1:] for c in chunks], num_threads=1)
        flat = np.fromiter(chain.from_iterable(found), dtype="<u4").tobytes()
        out, at = {}, 0
        for chunk, ids in zip(chunks, found, strict=True):
            end = at + 4 * len(ids)
            if chunk == " ":  # no text at all: the library would give nothing for it
                out[chunk] = np.array([self.model.piece_to_id("▁")], dtype="<u4").tobytes()
            else:
                out[chunk] = flat[at:end] if b"".join([self.pieces[i] for i in ids]) == chunk.encode() else LOST
                self.lossy |= out[chunk] is LOST
            at = end
        return out

    def keys_of(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the keys of ``words_of``, and how many each has: none where its line end is not cut off the space before it."""
        found = self.model.encode(keys, num_threads=1)
        for i, k in enumerate(keys):
            if k[0] == "\n":  # the model gives it a space first, which is a token of its own
                found[i] = found[i][1:] if self.pieces[found[i][0]] == b" " else []
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype="<u4", count=counts.sum()), counts

    def __call__(self, text: str) -> np.ndarray | None:
        """Ids, or None where they do not give back a space and the text."""
        if not self.apart:
            ids = self.model.encode(text, num_threads=1)
            same = b"".join([self.pieces[i] for i in ids]) == (" " + text).encode()
            return np.array(ids, dtype="<u4") if same else None
        chunks = _CHUNK.findall(" " + text)
        parts = list(map(self.known.get, chunks))
        if None in parts:
            own = self._learned(list({c for c, ids in zip(chunks, parts, strict=True) if ids is None}))
            parts = [own[c] if ids is None else ids for c, ids in zip(chunks, parts, strict=True)]
            if len(self.known) + len(own) > self.remembered:
                self.known = {}
            self.known.update((c, ids) for c, ids in own.items() if len(c) <= 48)
        return None if self.lossy and LOST in parts else np.frombuffer(b"".join(parts), dtype="<u4")


class Strings:
    """A list of byte strings as one buffer, to join many of them at once."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> bytes:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        return self.flat[shift + np.arange(len(shift))].tobytes()

    def spell(self, numbers: np.ndarray, counts: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Whether each word is what its numbers spell; ``counts``: how many each has."""
        ends = np.concatenate([[0], np.cumsum(self.sizes[numbers])])
        stops = np.cumsum(counts)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        right = ends[stops] - ends[stops - counts] == sizes
        if right.any():
            spelled = np.frombuffer(self.joined(numbers[np.repeat(right, counts)]), dtype=np.uint8)
            wanted = np.frombuffer(b"".join(compress(words, right)), dtype=np.uint8)
            sizes = sizes[right]
            right[right] = np.logical_and.reduceat(spelled == wanted, np.cumsum(sizes) - sizes)
        return right


def _binary(values: np.ndarray | bytes, ends: np.ndarray, kind=np.int32) -> pa.Array:
    """Binary rows from the bytes at which they end, the first one 0."""
    offsets = pa.py_buffer(ends.astype(kind))
    large = pa.large_binary() if kind is np.int64 else pa.binary()
    return pa.Array.from_buffers(large, len(ends) - 1, [None, offsets, pa.py_buffer(values)])


def _ends(column: pa.Array) -> np.ndarray:
    """Where the rows of large binaries end in their bytes, and before them where the first begins."""
    return np.frombuffer(column.buffers()[1], dtype="<i8")[column.offset : column.offset + len(column) + 1]


def _words(groups: pa.Array, pairs: pa.Array, n_a: np.ndarray, n_b: np.ndarray) -> pa.RecordBatch:
    """Aligned words. n_a is 0 where a word cannot be aligned, and less where it may not stand alone."""
    counts = [pa.array(n.astype(np.int32)) for n in (n_a, n_b)]
    return pa.RecordBatch.from_arrays([groups, pairs, *counts], names=["groups", "pairs", "n_a", "n_b"])


class Aligner:
    """Digest and pairs of texts under two tokenizers.

    Where both tokenizers cut a text before every word, words are aligned by themselves, once each, and remembered; a text
    is then put together from its words. Where both cut signs off the letter before them, a word that signs end is put
    together from both. Other texts are aligned whole. ``remembered``: words held at once, and those of the last call.
    """

    NOTHING = (0, 0, 0, 0, "", b"", b"")

    def __init__(self, a, b, remembered: int = 700_000):
        self.a, self.b = a, b
        self.sizes = [np.array([len(p) for p in t.pieces], dtype=np.int64) for t in (a, b)]
        self.a_bytes, self.b_bytes = Strings(a.pieces), Strings(b.pieces)
        self.marked = Strings([f"{i}{mark}".encode() for i in range(max(len(a.pieces), len(b.pieces))) for mark in ",|;"])
        self.half = remembered // 2
        # rows of ``words`` and ``old_words`` by key
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.words = self.old_words = self._learned([])[1]
        self.letter = self._learned(["a"])[1].to_pylist()[0]
        self.parts_signs = a.parts_signs and b.parts_signs and self.letter["n_a"] > 0
        self.signs, self.sign_words = {}, self.words

    def __call__(self, text: str | None) -> tuple[int, int, int, int, str, bytes, bytes]:
        """n_a, n_b, n_groups, n_links, groups_sha256, pairs (a << 32 | b, sorted), times."""
        if not text:
            return self.NOTHING
        words = self._words(" " + text) if self.b.line_ends_alone else None
        if words is None:
            return self._whole(text)
        groups, pairs, n_a, n_b = (c.to_pylist() for c in words.columns)
        if 0 in n_a:
            return self.NOTHING
        return self._row(sum(n_a), sum(n_b), b"".join(groups), np.frombuffer(b"".join(pairs), dtype="<i8"))

    def _whole(self, text: str) -> tuple[int, int, int, int, str, bytes, bytes]:
        spaced = " " + text
        a, b = self.a(spaced), self.b(text)
        if b is None or self.a_bytes.joined(a) != spaced.encode():
            return self.NOTHING
        at_a, at_b, pairs = self._links(a, b)
        return self._row(len(a), len(b), self.marked.joined(self.groups(a, b, at_a, at_b)), pairs)

    def rows(self, texts: pa.Array) -> list[pa.Array]:
        """What each text gives, as columns. A word is looked up once for all texts."""
        n = len(texts)
        totals, digests, flat = np.zeros((3, n), dtype=np.int64), [""] * n, []
        b_bits = len(self.b.pieces).bit_length()
        text_bits = b_bits + len(self.a.pieces).bit_length()

        def add(no, pairs: np.ndarray) -> None:
            flat.append(np.int64(no) << text_bits | pairs >> 32 << b_bits | pairs & 0xFFFFFFFF)

        filled = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
        apart = filled
        if len(filled) and self.b.line_ends_alone:
            # as in words_of
            lists = pc.split_pattern(pc.replace_substring(texts.take(pa.array(filled)).cast(pa.large_string()), "\n", " \n"), " ")
            cuts = lists.offsets.to_numpy()
            keys = lists.flatten().dictionary_encode()
            numbers = self._numbers(keys.dictionary.to_pylist())[keys.indices.to_numpy()]
            groups, pairs, n_a, n_b = self.words.take(pa.array(numbers)).columns
            least = np.minimum.reduceat(n_a.to_numpy(), cuts[:-1])
            apart, whole = filled[least < 0], least > 0
            n_links = np.diff(_ends(pairs)[cuts]) // 8
            sums = [np.add.reduceat(x.to_numpy(), cuts[:-1], dtype=np.int64) for x in (n_a, n_b)]
            totals[:, filled] = np.where(whole, [*sums, n_links], 0)
            held, ends = memoryview(groups.buffers()[2] or b""), _ends(groups)[cuts].tolist()
            for at in np.flatnonzero(whole).tolist():
                digests[filled[at]] = hashlib.sha256(held[ends[at] : ends[at + 1] - 1]).hexdigest()
            own = np.repeat(whole, n_links)
            add(np.repeat(filled, n_links)[own], np.frombuffer(pairs.buffers()[2] or b"", dtype="<i8", count=len(own))[own])
        for at in apart.tolist():
            totals[0, at], totals[1, at], totals[2, at], _, digests[at], pairs, times = self._whole(texts[at].as_py())
            add(at, np.repeat(np.frombuffer(pairs, dtype="<i8"), np.frombuffer(times, dtype="<u4")))
        flat = np.sort(np.concatenate([np.empty(0, np.int64), *flat]))
        starts = np.flatnonzero(np.concatenate([flat[:1] >= 0, flat[1:] != flat[:-1]]))
        times, flat = np.diff(starts, append=len(flat)).astype("<u4"), flat[starts]
        pairs = (flat >> b_bits & (1 << text_bits - b_bits) - 1) << 32 | flat & (1 << b_bits) - 1
        ends = np.searchsorted(flat >> text_bits, np.arange(n + 1))
        n_a, n_b, n_links = map(pa.array, totals)
        return [n_a, n_b, n_links, n_links, pa.array(digests, pa.string()), _binary(pairs.astype("<i8"), 8 * ends), _binary(times, 4 * ends)]

    @staticmethod
    def _row(n_a: int, n_b: int, groups: bytes, pairs: np.ndarray) -> tuple[int, int, int, int, str, bytes, bytes]:
        n = len(pairs)
        pairs, times = np.unique(pairs, return_counts=True)
        return n_a, n_b, n, n, hashlib.sha256(groups[:-1]).hexdigest(), pairs.astype("<i8").tobytes(), times.astype("<u4").tobytes()

    def _links(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the tokens of A and of B that end together, and their pairs of ids."""
        a_ends, b_ends = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        # tokens are never empty, so an end stands once in each list, and a shared one is one link
        at_a = np.searchsorted(a_ends, b_ends)
        at_b = np.flatnonzero(a_ends[at_a] == b_ends)
        at_a = at_a[at_b]
        return at_a, at_b, a[at_a].astype(np.int64) << 32 | b[at_b]

    def _words(self, spaced: str) -> pa.RecordBatch | None:
        """The aligned words of a text in order; None if words may not stand alone."""
        numbers = self._numbers(words_of(spaced))
        found = self.words.take(pa.array(numbers))
        return None if pc.min(found.column("n_a")).as_py() < 0 else found

    def _numbers(self, keys: list[str]) -> np.ndarray:
        """Rows of these keys in ``self.words``, to which new ones are added."""
        if len(self.young) > self.half or self.words.nbytes > 128 * self.half:
            self.old, self.old_words, self.young, self.words = self.young, self.words, {}, self.words.slice(0, 0)
        unseen = {k for k in keys if k not in self.young}
        if unseen:
            signed = self._signed(unseen) if self.parts_signs else {}
            asked = unseen.difference(signed).union(w for w in signed.values() if w not in self.young)
            kept = [k for k in asked if k in self.old]
            self._add(kept, self.old_words.take(pa.array([self.old[k] for k in kept], pa.int64())))
            new = list(asked.difference(kept))
            for at in range(0, len(new), LEARNED):
                self._add(*self._learned(new[at : at + LEARNED]))
            if signed:
                self._add(list(signed), self._put_together(signed))
        return np.fromiter(map(self.young.__getitem__, keys), dtype=np.int64, count=len(keys))

    def _add(self, keys: list[str], rows: pa.RecordBatch) -> None:
        self.young.update(zip(keys, range(len(self.young), len(self.young) + len(keys)), strict=True))
        self.words = pa.concat_batches([self.words, rows])

    def _signed(self, keys: set[str]) -> dict[str, str]:
        """Keys that are a word that ends in a letter with signs behind it, and that word."""
        out = {}
        for k in keys:
            if k and k[-1] in _SIGNS and len(k) <= 48 and k not in self.old:
                word = k.rstrip(_SIGNS)
                if word and word[-1] < "\u0250" and word[-1].isalpha():
                    out[k] = word
        return out

    def _put_together(self, signed: dict[str, str]) -> pa.RecordBatch:
        """The words of keys from ``_signed``, whose own words are known."""
        tails = [k[len(word) :] for k, word in signed.items()]
        if len(self.signs) > 4000:
            self.signs, self.sign_words = {}, self.words.slice(0, 0)
        if new := set(tails).difference(self.signs):
            keys, found = self._learned(["a" + t for t in new])
            rows = found.to_pylist()
            for row in rows:
                if row["n_a"] > 0:  # the letter's groups and pairs come first
                    row.update({c: row[c][len(x) :] if isinstance(x, bytes) else row[c] - x for c, x in self.letter.items()})
            self.signs.update(zip([k[1:] for k in keys], range(len(self.signs), len(self.signs) + len(keys)), strict=True))
            self.sign_words = pa.concat_batches([self.sign_words, pa.RecordBatch.from_pylist(rows, schema=found.schema)])
        both = pa.concat_batches([self.words, self.sign_words])
        numbers = np.empty(2 * len(signed), dtype=np.int64)
        numbers[::2] = list(map(self.young.__getitem__, signed.values()))
        numbers[1::2] = list(map(self.signs.__getitem__, tails))
        numbers[1::2] += self.words.num_rows
        *binaries, n_a, n_b = both.take(pa.array(numbers)).columns
        groups, pairs = (_binary(c.buffers()[2] or b"", _ends(c)[::2], np.int64) for c in binaries)
        n_a, n_b = n_a.to_numpy().reshape(-1, 2), n_b.to_numpy().reshape(-1, 2)
        least = n_a.min(axis=1)
        return _words(groups, pairs, np.where(least > 0, n_a.sum(axis=1), least), n_b.sum(axis=1))

    def _learned(self, keys: list[str]) -> tuple[list[str], pa.RecordBatch]:
        """The keys in some order, and their words.

        Words are aligned as one text: both tokenizers end a token where a word ends, so groups keep to their word.
        """
        apart, together, odd = [], "".join(keys), self.a.encode.whole.search
        if odd(together) or not plain_words(keys, together):
            apart = [k for k in keys if odd(k) or not plain_words([k], k)]
            keys = list(set(keys).difference(apart))
        keys, a, n_a = self.a.keys_of(keys)
        b, n_b = self.b.keys_of(keys)
        raw = [k.encode() if k[0] == "\n" else b" " + k.encode() for k in keys]
        fits = self.a_bytes.spell(a, n_a, raw) & self.b_bytes.spell(b, n_b, raw)
        if not fits.all():
            a, b = a[np.repeat(fits, n_a)], b[np.repeat(fits, n_b)]
            n_a, n_b = n_a * fits, n_b * fits
        at_a, at_b, pairs = self._links(a, b)
        line = self.groups(a, b, at_a, at_b)
        none = np.zeros(len(apart), dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(self.marked.sizes[line])])[np.cumsum(np.concatenate([[0], n_a + n_b, none]))]
        cuts = 8 * np.searchsorted(at_b, np.cumsum(np.concatenate([[0], n_b, none])))
        groups = _binary(self.marked.joined(line), ends, np.int64)
        n_a, n_b = np.concatenate([n_a, none - 1]), np.concatenate([n_b, none - 1])
        return [*keys, *apart], _words(groups, _binary(pairs.astype("<i8"), cuts, np.int64), n_a, n_b)

    def groups(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
        """``a1,a2|b1;a3|b2,b3;``: the groups' ids in order, as numbers of marked ids."""
        n, m = len(a), len(b)
        # token i of A stands after the i tokens of A and the tokens of B of the groups before its own
        group_a, group_b = np.searchsorted(at_a, np.arange(n)), np.searchsorted(at_b, np.arange(m))
        before_b = np.concatenate([[0], at_b + 1])
        place_a = np.arange(n) + before_b[group_a]
        place_b = np.arange(m) + at_a[group_b] + 1
        marks_a, marks_b = np.zeros(n, dtype=np.int64), np.zeros(m, dtype=np.int64)
        marks_a[at_a], marks_b[at_b] = 1, 2
        line = np.empty(n + m, dtype=np.int64)
        line[place_a], line[place_b] = 3 * a.astype(np.int64) + marks_a, 3 * b.astype(np.int64) + marks_b
        return line


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose texts are aligned at once."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[at] - sizes[at] + TEXT_BYTES, side="right"))
        stop = max(at + 1, min(stop, at + TEXTS))
        yield batch.slice(at, stop - at)
        at = stop


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(ByteLevel(a_path), Pieces(b_path))
    return _ALIGNERS[a_path, b_path]


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: doc_no (its number, in blocks of its task), digest columns, pairs and times.

    Store it before use: numbers hold for one reading of the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path)
        names = [f.split()[0] for f in ALIGNED.replace("\n", " ").split(",")]
        for part in (p for batch in batches for p in _parts(batch)):
            columns = [part.column("doc_no"), part.column("doc_id"), *align.rows(part.column("text"))]
            found = pa.RecordBatch.from_arrays(columns, names=names)
            for at in range(0, found.num_rows, ROWS):
                yield found.slice(at, ROWS)

    rows = docs.select(
        F.monotonically_increasing_id().alias("doc_no"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return rows.mapInArrow(run, ALIGNED)


# --- bitmaps ------------------------------------------------------------------------------------------------------------------


def packed(lows: np.ndarray) -> bytes:
    """Compressed bitmap of sorted different 16-bit numbers."""
    if 2 * len(lows) < BLOCK_BYTES:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(BLOCK, dtype=np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpacked(bits: bytes) -> np.ndarray:
    raw = np.frombuffer(bits, dtype=np.uint8)
    if len(raw) < BLOCK_BYTES:
        return raw.view("<u2")
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")).astype("<u2")


def either(parts: list[bytes]) -> bytes:
    """OR of bitmaps."""
    return packed(np.unique(np.concatenate([unpacked(p) for p in parts])))


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All document numbers of a column of bitmaps, and how many each row has (its popcount)."""
    sizes = np.diff(np.frombuffer(column.buffers()[1], dtype="<i4")[column.offset : column.offset + len(column) + 1])
    if len(sizes) and sizes.max() >= BLOCK_BYTES:
        parts = [unpacked(x.as_py()) for x in column]
        return np.concatenate(parts), np.array([len(p) for p in parts])
    begin = np.frombuffer(column.buffers()[1], dtype="<i4")[column.offset] if len(column) else 0
    held = column.buffers()[2]
    lows = np.frombuffer(held, dtype=np.uint8)[begin : begin + sizes.sum()].view("<u2") if held else np.empty(0, "<u2")
    return lows, sizes // 2


def _plane_rows(block: int, lows: np.ndarray, pairs: np.ndarray, plane: int) -> Iterator[pa.RecordBatch]:
    """Bitmaps of one plane from (document, pair) in order of pair and document."""
    if not len(pairs):
        return
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    stops = np.concatenate([starts[1:], [len(pairs)]])
    if 2 * (stops - starts).max() < BLOCK_BYTES:  # all are plain lists: one buffer holds them
        offsets = (2 * np.concatenate([starts, [len(pairs)]])).astype(np.int32)
        bits = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lows.tobytes())])
    else:
        bits = pa.array([packed(lows[s:e]) for s, e in zip(starts, stops, strict=True)], pa.binary())
    same = [pa.array(np.full(len(starts), block)), pa.array(np.full(len(starts), plane, dtype=np.int32))]
    yield pa.RecordBatch.from_arrays([pa.array(pairs[starts]), *same, bits], names=["pair", "block", "plane", "bits"])


def _bitmap_rows(block: int, lows: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Bitmaps of one block from its entries (document, pair, multiplicity), documents in order."""
    order = np.argsort(pairs, kind="stable")
    lows, pairs, more = lows[order].astype("<u2"), pairs[order], times[order].astype(np.int64) - 1
    yield from _plane_rows(block, lows, pairs, 0)
    plane = 0
    while True:
        left = more >= 1 << plane
        lows, pairs, more = lows[left], pairs[left], more[left]
        if not len(pairs):
            return
        wanted = (more >> plane & 1).astype(bool)
        plane += 1
        yield from _plane_rows(block, lows[wanted], pairs[wanted], plane)


def partial_bitmaps(rows: DataFrame) -> DataFrame:
    """Bitmaps of the documents of ``rows`` (stored, of ``aligned``), part by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, entries, held = None, 0, []

        def handed() -> Iterator[pa.RecordBatch]:
            if held:
                yield from _bitmap_rows(block, *(np.concatenate(x) for x in zip(*held, strict=True)))

        for batch in batches:
            for no, pairs, times in zip(*(batch.column(c).to_pylist() for c in ("doc_no", "pairs", "times")), strict=True):
                if held and (no // BLOCK != block or entries > HELD):
                    yield from handed()
                    entries, held = 0, []
                block = no // BLOCK
                found = np.frombuffer(pairs, dtype="<i8")
                held.append((np.full(len(found), no % BLOCK, dtype="<u2"), found, np.frombuffer(times, dtype="<u4")))
                entries += len(found)
        yield from handed()

    return rows.filter(F.length("pairs") > 0).select("doc_no", "pairs", "times").mapInArrow(run, BITMAPS)


def merged_bitmaps(partials: DataFrame) -> DataFrame:
    """One bitmap per pair, block and plane, and its popcount ``n``: partial ones are OR-merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pair", "block", "plane", "bits", "n"]
        last, parts = None, []

        def closed(done: list[tuple[tuple, list[bytes]]]) -> Iterator[pa.RecordBatch]:
            whole = [(*key, bits[0] if len(bits) == 1 else either(bits)) for key, bits in done if bits]
            if whole:
                pair, block, plane, bits = zip(*whole, strict=True)
                bits = pa.array(bits, pa.binary())
                columns = [pa.array(pair, pa.int64()), pa.array(block, pa.int64()), pa.array(plane, pa.int32()), bits]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(_numbers(bits)[1].astype(np.int64))], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in ("pair", "block", "plane")]
            new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
            starts = np.flatnonzero(new)
            stops = np.concatenate([starts[1:], [batch.num_rows]])
            # keys that stand once, away from the batch's ends, go on as they are
            alone = np.flatnonzero((stops - starts == 1) & (starts > 0) & (stops < batch.num_rows))
            if len(alone):
                singles = batch.take(pa.array(starts[alone]))
                bits = singles.column("bits")
                yield pa.RecordBatch.from_arrays([*singles.columns, pa.array(_numbers(bits)[1].astype(np.int64))], names=names)
            done = []
            for at in np.setdiff1d(np.arange(len(starts)), alone).tolist():
                s, e = int(starts[at]), int(stops[at])
                key = tuple(int(k[s]) for k in keys)
                if key != last:
                    done.append((last, parts))
                    last, parts = key, []
                parts = parts + batch.column("bits").slice(s, e - s).to_pylist()
            yield from closed(done)
        yield from closed([(last, parts)])

    ordered = partials.repartition("pair", "block").sortWithinPartitions("pair", "block", "plane")
    return ordered.mapInArrow(run, BITMAPS + ", n long")


def _weight():
    """Links that a document in a plane's bitmap stands for."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.col("plane") - 1, F.lit(0)))


def pair_counts(postings: DataFrame) -> DataFrame:
    """pair, a, b, documents, links, best: popcounts of a pair's bitmaps, and whether no pair of its b has more links."""
    counts = postings.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("documents"), F.sum(F.col("n") * _weight()).alias("links")
    )
    counts = stored(
        counts.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "documents", "links"),
        "pair_counts",
    )
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "documents", "links", (F.col("links") == F.col("most")).alias("best"))


def returned_scores(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_no, n_best, count_sum: pairs' counts, sent along their bitmaps to the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen, best, total = None, None, None, None

        def closed() -> Iterator[pa.RecordBatch]:
            if at is not None:
                lows = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lows + at * BLOCK), pa.array(best[lows]), pa.array(total[lows])], names=["doc_no", "n_best", "count_sum"]
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, links = batch.column("block").to_numpy(), batch.column("links").to_numpy()
            weights = batch.column("weight").to_numpy()
            top = batch.column("best").to_numpy(zero_copy_only=False)
            lows, sizes = _numbers(batch.column("bits"))
            ends = np.cumsum(sizes)
            starts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
            for s, e in zip(starts, [*starts[1:], len(blocks)], strict=True):
                if blocks[s] != at:
                    yield from closed()
                    at = int(blocks[s])
                    seen, best, total = np.zeros(BLOCK, dtype=bool), np.zeros(BLOCK, dtype=np.int64), np.zeros(BLOCK, dtype=np.int64)
                own = lows[ends[s] - sizes[s] : ends[e - 1]].astype(np.int64)
                seen[own] = True
                np.add.at(total, own, np.repeat((links * weights)[s:e], sizes[s:e]))
                np.add.at(best, own, np.repeat((top * weights)[s:e], sizes[s:e]))
        yield from closed()

    sent = postings.join(counts.select("pair", "links", "best"), "pair").select("block", "bits", _weight().alias("weight"), "links", "best")
    return sent.repartition("block").sortWithinPartitions("block").mapInArrow(run, "doc_no long, n_best long, count_sum long")


def cross_aligned(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """(a row per document, the pairs with their counts).

    docs: doc_id, text; a_path: a byte-level tokenizer's file; b_path: a piece model's. The first table has doc_id, n_a,
    n_b, n_groups, n_links, n_best, count_sum, groups_sha256; the second is that of ``pair_counts``.
    """
    rows = stored(aligned(docs, a_path, b_path), "aligned")
    postings = stored(merged_bitmaps(partial_bitmaps(rows)), "postings")
    counts = stored(pair_counts(postings), "pair_scores")
    scores = returned_scores(postings, counts)
    zero = F.lit(0).cast("long")
    found = rows.drop("pairs", "times").join(scores, "doc_no", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
    return found, counts
