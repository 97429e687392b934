"""Operator 9: token counts of fields or sections, by character offsets.

Each document is encoded once, whole. Every token spans characters of the text; sections do too.
The two lists of spans are joined in order, and every token is allocated by one rule:

    a token belongs to the section that holds the most of its characters, white space aside;
    of equals, to the earlier one. A token that is white space alone counts all its characters.
    A token with no character in any section belongs to section -1, the text outside.

So the counts of a document's sections always add up to the document's tokens. ``n_crossing`` counts
those of a section's tokens that also touch another section or the outside.

Defined results: a null or empty text gives its sections zero tokens, and section -1 a row with zero;
null sections are no sections; sections are cut to the text, and where two overlap the later one
starts where the earlier one ends; null document ids stay null; repeated rows are counted once each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.llm.encode import spans_encoder

COUNTS = (
    "doc_id long, section int, section_from long, section_to long, n_tokens long, n_crossing long, doc_tokens long"
)


def line_chunks(text: str, longest: int = 1000) -> list[tuple[int, int]]:
    """Character spans of a text's lines, without their line ends, those over ``longest`` cut into chunks of that many."""
    spans, at = [], 0
    for line in text.split("\n"):
        end = at + len(line)
        spans += [(b, min(b + longest, end)) for b in range(at, max(end, at + 1), longest)]
        at = end + 1
    return spans


def line_sections(text: Column) -> Column:
    """Character spans of a text's lines, without their line ends: array of (from, to).

    Copies the spans line by line: for texts of few lines. ``line_chunks`` takes any text.
    """
    ends = F.transform(F.split(text, "\n", -1), F.length)
    step = F.aggregate(
        ends,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans")),
        lambda acc, n: F.struct(
            (acc["at"] + n + 1).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("from"), (acc["at"] + n).alias("to")))).alias("spans"),
        ),
    )
    return step["spans"]


def chunk_sections(text: Column, longest: int = 1000) -> Column:
    """The lines, those over ``longest`` characters cut into chunks of that many."""
    def chunks(span: Column) -> Column:
        starts = F.sequence(span["from"], F.greatest(span["to"] - 1, span["from"]), F.lit(longest))
        return F.transform(starts, lambda s: F.struct(s.alias("from"), F.least(s + longest, span["to"]).alias("to")))

    return F.flatten(F.transform(line_sections(text), chunks))


def clean_sections(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Spans cut to the text and to each other, in the order given."""
    found, last = [], 0
    for begin, end in spans:
        begin = max(last, min(begin, size))
        end = max(begin, min(end, size))
        found.append((begin, end))
        last = end
    return found


def allocate(
    text: str, begins: np.ndarray, ends: np.ndarray, sections: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses). ``sections``: in order, not overlapping."""
    starts = np.array([s for s, _ in sections], dtype=np.int64)
    stops = np.array([e for _, e in sections], dtype=np.int64)
    if not len(starts):
        return np.full(len(begins), -1), np.zeros(len(begins), dtype=bool)
    at = np.searchsorted(starts, begins, side="right") - 1
    inside = (at >= 0) & (ends <= stops[np.maximum(at, 0)]) & (begins < stops[np.maximum(at, 0)])
    owner = np.where(inside, at, -1)
    crossing = np.zeros(len(begins), dtype=bool)
    # a single character outside all sections is no one's and crosses nothing
    for i in np.flatnonzero(~inside & (ends - begins > 1)):
        b, e = int(begins[i]), int(ends[i])
        chars = [c for c in range(b, e) if not text[c].isspace()] or list(range(b, e))
        homes = np.searchsorted(starts, chars, side="right") - 1
        homes = np.where((homes >= 0) & (np.array(chars) < stops[np.maximum(homes, 0)]), homes, -1)
        where, counts = np.unique(homes[homes >= 0], return_counts=True)
        if len(where):
            owner[i] = where[np.argmax(counts)]
            touched = np.searchsorted(starts, np.arange(b, e), side="right") - 1
            touched = np.where((touched >= 0) & (np.arange(b, e) < stops[np.maximum(touched, 0)]), touched, -1)
            crossing[i] = len(np.unique(touched)) > 1
    return owner, crossing


def section_tokens(
    docs: DataFrame, tokenizer: str, keeps_spaces: bool = True, sections: str | Callable = "sections"
) -> DataFrame:
    """Token counts per section of doc_id and text.

    sections: the column with an array of (from, to) character spans, or a function of a text (never
    null) that gives them, such as ``line_chunks``.
    """
    column = sections if isinstance(sections, str) else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = spans_encoder(tokenizer, keeps_spaces)
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            given_spans = batch.column(2).to_pylist() if column else [None] * batch.num_rows
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), given_spans, strict=True):
                text = text.as_py() or ""
                if column:
                    given = [(s["from"], s["to"]) for s in spans or [] if s and s["from"] is not None and s["to"] is not None]
                else:
                    given = sections(text)
                clean = clean_sections(given, len(text))
                full = [i for i, (b, e) in enumerate(clean) if b < e]
                begins, ends = encode(text)
                owner, crossing = allocate(text, begins, ends, [clean[i] for i in full])
                n = np.bincount(owner + 1, minlength=len(full) + 1)
                x = np.bincount(owner[crossing] + 1, minlength=len(full) + 1)
                tokens, crossings = np.zeros(len(clean) + 1, dtype=np.int64), np.zeros(len(clean) + 1, dtype=np.int64)
                places = np.array([0] + [i + 1 for i in full])
                tokens[places], crossings[places] = n, x
                columns[0] += [doc_id] * (len(clean) + 1)
                columns[1] += range(-1, len(clean))
                columns[2] += [None] + [b for b, _ in clean]
                columns[3] += [None] + [e for _, e in clean]
                columns[4] += tokens.tolist()
                columns[5] += crossings.tolist()
                columns[6] += [len(begins)] * (len(clean) + 1)
            kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 5
            names = ["doc_id", "section", "section_from", "section_to", "n_tokens", "n_crossing", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    spans = [F.col(column).cast("array<struct<from:int,to:int>>").alias("sections")] if column else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *spans)
    return rows.mapInArrow(count, COUNTS)
