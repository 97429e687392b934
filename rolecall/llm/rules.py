"""Operator 11: quality rules as a short-circuit cascade.

A document is kept if it passes every rule. Rules only look at one text, so their order changes what they cost and never
the verdict. The order is estimated: on a sample of whole documents every rule is tried, its time is taken and its
rejections are counted, together with those of all other rules. Rules are then ordered by rejection per cost, one after the
other: the next rule is the one that rejects most, for its cost, of the sampled documents that the rules before it let
through. A document then meets the rules in that order and leaves the cascade at the first one it fails.

The base counts (words, characters, symbols, repeated lines, repeated words) are worked out for every document, and a text
that fails the base rule (too few words, or mostly repeated windows) meets no other rule.

The sample has about ``sample`` documents whatever the input (rows are drawn evenly, in each partition); its passes are held
as one bit a rule, so that at most ``sample`` counted patterns reach the driver. Everything else reads all documents. A
document is read whole, in its task, in time about proportional to its length.

Defined results: a null, empty or blank text has zero words and fails the base rule; long texts are counted whole;
repeated rows and ties are judged alike, each by itself; null document ids stay null; an empty table gives no rows;
other columns are ignored. ``rejected_by`` and ``n_tried`` follow the estimated order, all else does not.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE, SYMBOLS = b" \t\n\x0b\f\r", b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; percent of words in repeated windows

VERDICTS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, rejected_by string, n_tried int"
)


class Counts(NamedTuple):
    """Base counts of a text; ``lines``: lines with a word."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: int


class Rule(NamedTuple):
    """``passes``: whether (text, words, base counts) passes the rule."""

    name: str
    passes: Callable[[str, list[str], Counts], bool]


def repeated_words(words: list[str]) -> int:
    """Words that stand in a three-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) ** 3 >= 1 << 62:  # keep the windows' numbers within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    held = np.zeros(n, dtype=bool)
    for shift in range(3):
        held[shift : n - 2 + shift] |= again
    return int(held.sum())


def counted(text: str, words: list[str]) -> Counts:
    raw = text.encode()
    filled = [line for line in text.split("\n") if WORD.search(line)]
    return Counts(
        len(words), len(text) - len(raw) + len(raw.translate(None, WHITE)), len(raw) - len(raw.translate(None, SYMBOLS)),
        len(filled) - len(set(filled)), repeated_words(words), len(filled),
    )


def base_failed(c: Counts) -> bool:
    return c.n_words < LEAST_WORDS or 100 * c.n_repeat_words > MOST_REPEATED * c.n_words


# --- the rules: shares are compared as whole numbers; none depends on a language or on a text's length ------------------


def few_symbols(text: str, words: list[str], c: Counts) -> bool:
    """At most one symbol in ten words."""
    return 10 * c.n_symbols <= c.n_words


def few_repeated_lines(text: str, words: list[str], c: Counts) -> bool:
    """At most three lines in ten repeat an earlier one."""
    return 10 * c.n_dup_lines <= 3 * c.lines


def usual_words(text: str, words: list[str], c: Counts) -> bool:
    """Words of 2 to 12 characters on average, or a text whose words are not set apart by blanks."""
    return 2 * c.n_words <= c.word_chars <= 12 * c.n_words


def words_with_letters(text: str, words: list[str], c: Counts) -> bool:
    """Seven words in ten hold a letter."""
    plain = sum(map(str.isalpha, words))
    mixed = sum(any(map(str.isalpha, w)) for w in words if not w.isalpha())
    return 10 * (plain + mixed) >= 7 * c.n_words


def few_capitals(text: str, words: list[str], c: Counts) -> bool:
    """At most half of the letters are capitals."""
    return 2 * sum(map(str.isupper, text)) <= sum(map(str.isalpha, text))


def no_ruling_word(text: str, words: list[str], c: Counts) -> bool:
    """No word makes up over a quarter of all."""
    return 4 * max(Counter(words).values(), default=0) <= c.n_words


def few_list_marks(text: str, words: list[str], c: Counts) -> bool:
    """At most nine filled lines in ten start like a list's, and at most half end in dots that trail off."""
    lines = [x for x in (line.strip(" \t\x0b\f\r") for line in text.split("\n")) if x]
    marked = sum(line[0] in "-*•‣◦" for line in lines)
    trailing = sum(line.endswith(("...", "…")) for line in lines)
    return 10 * marked <= 9 * len(lines) and 2 * trailing <= len(lines)


RULES = [
    Rule(f.__name__, f)
    for f in (few_symbols, few_repeated_lines, usual_words, words_with_letters, few_capitals, no_ruling_word, few_list_marks)
]


# --- the order -------------------------------------------------------------------------------------------------------------


def cascade_order(patterns: Sequence[tuple[int, int]], costs: Sequence[float]) -> list[int]:
    """Rules by rejection per cost of what is left.

    patterns: (bits of the rules a document fails, number of such documents); costs: seconds of each rule.
    """
    left, rules, order = dict(patterns), list(range(len(costs))), []
    while rules:
        rejected = {r: sum(n for bits, n in left.items() if bits >> r & 1) for r in rules}
        # of rules that reject nothing more, the cheaper one first
        best = max(rules, key=lambda r: (rejected[r] / max(costs[r], 1e-12), -costs[r], -r))
        order.append(best)
        rules.remove(best)
        left = {bits: n for bits, n in left.items() if not bits >> best & 1}
    return order


def estimated_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = 2000, seed: int = 7) -> list[int]:
    """Order of the rules, from about ``sample`` documents on which every rule is tried and timed."""
    rows = docs.count()
    if not rows:
        return list(range(len(rules)))

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: Counter[int] = Counter()
        spent = [0] * len(rules)
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                words = WORD.findall(text)
                counts = counted(text, words)
                if base_failed(counts):
                    continue
                mask = 0
                for r, rule in enumerate(rules):
                    began = time.perf_counter_ns()
                    mask |= (not rule.passes(text, words, counts)) << r
                    spent[r] += time.perf_counter_ns() - began
                bits[mask] += 1
        keys = [*(("mask", k, n) for k, n in bits.items()), *(("spent", r, ns) for r, ns in enumerate(spent))]
        columns = list(zip(*keys, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["kind", "no", "n"])

    some = docs.select("text").sample(fraction=min(1.0, sample / rows), seed=seed)
    found = some.mapInArrow(tried, "kind string, no long, n long").groupBy("kind", "no").agg(F.sum("n").alias("n")).collect()
    costs = {x.no: x.n for x in found if x.kind == "spent"}
    return cascade_order([(x.no, x.n) for x in found if x.kind == "mask"], [costs.get(r, 0) / 1e9 for r in range(len(rules))])


def verdicts(docs: DataFrame, rules: Sequence[Rule] = RULES, order: Sequence[int] | None = None, sample: int = 2000) -> DataFrame:
    """One row per document: base counts, base_failed, kept, the rule that ended its cascade and how many it met.

    docs: doc_id, text. ``order``: numbers of the rules, estimated on a sample if not given.
    """
    rules = list(rules)
    chosen = [rules[r] for r in (estimated_order(docs, rules, sample) if order is None else order)]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                words = WORD.findall(text)
                counts = counted(text, words)
                failed = base_failed(counts)
                ended, met = None, 0
                if not failed:
                    for rule in chosen:
                        met += 1
                        if not rule.passes(text, words, counts):
                            ended = rule.name
                            break
                rows.append((*counts[:5], failed, not failed and ended is None, ended, met))
            if not rows:
                continue
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.string(), pa.int32()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = [field.split()[0] for field in VERDICTS.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judged, VERDICTS)
