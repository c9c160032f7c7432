"""Token counts per section, by the places of tokens in whole encoded documents.

A document is encoded once as a whole. Its tokens are intervals of the text, and so are its sections; the
tokens' intervals are joined to the sections' by sorted search, and a token that crosses a boundary goes to
exactly one section, by ``rule``:

* ``first``: the section of its first byte,
* ``last``: the section of its last byte,
* ``most``: the section that holds most of its bytes, the earliest of equals.

So the counts of all sections add up to the document's tokens. A null text counts as empty; a document
without characters has one empty section without tokens. Rows are handled one by one: repeated rows give
repeated results, a null ``doc_id`` stays null, other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.kernels import TokenIds, text_chunks

SCHEMA = "doc_id long, section long, start_char long, end_char long, n_tokens long, n_crossing long, doc_tokens long"


def line_starts(data: np.ndarray) -> np.ndarray:
    """Bytes after a line feed: a line owns the line feed that ends it."""
    return np.flatnonzero(data[:-1] == 10) + 1 if len(data) else np.zeros(0, dtype=np.int64)


def paragraph_starts(data: np.ndarray) -> np.ndarray:
    """Bytes that follow an empty line."""
    feeds = np.flatnonzero(data[:-1] == 10)
    return feeds[(feeds > 0) & (data[feeds - 1] == 10) & (data[feeds + 1] != 10)] + 1 if len(data) else feeds


def sentence_starts(data: np.ndarray) -> np.ndarray:
    """Bytes after a full stop, question or exclamation mark and the one white space that follows, or after a line feed.

    A white space usually belongs to the token of the word after it, so these boundaries fall inside tokens.
    """
    if len(data) < 3:
        return line_starts(data)
    stop = (data[:-2] == 46) | (data[:-2] == 33) | (data[:-2] == 63)
    space = (data[1:-1] == 32) | (data[1:-1] == 10)
    return np.union1d(np.flatnonzero(stop & space) + 2, line_starts(data))


SECTIONS = {"lines": line_starts, "paragraphs": paragraph_starts, "sentences": sentence_starts}


def owners(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(owning section, crosses) per token; ``sections`` are the places where sections begin, the first at 0."""
    low = np.searchsorted(sections, starts, "right") - 1
    high = np.searchsorted(sections, ends - 1, "right") - 1
    owner = (high if rule == "last" else low).copy()
    if rule == "most":
        for i in np.flatnonzero(low != high):
            edges = np.concatenate(([starts[i]], sections[low[i] + 1 : high[i] + 1], [ends[i]]))
            owner[i] = low[i] + int(np.argmax(np.diff(edges)))
    return owner, low != high


def count_by_section(docs: DataFrame, tokenizer: str, sections: str = "sentences", rule: str = "first") -> DataFrame:
    """One row per document and section: its code point range, its tokens, and its tokens that cross its end."""
    if rule not in ("first", "last", "most"):
        raise ValueError(f"unknown rule {rule!r}")
    split = SECTIONS[sections]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenIds(tokenizer)
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(1)):
                ids, first = encoder.encode(data, offsets)
                ends = np.cumsum(encoder.width[ids])
                starts = ends - encoder.width[ids]
                inner = split(data)
                begins = np.sort(np.concatenate([offsets[:-1], inner[~np.isin(inner, offsets)]]))
                # An empty text shares its place with the next one: the last of equal places owns the tokens.
                doc = np.searchsorted(offsets[:-1], begins, "right") - 1
                same = np.flatnonzero(np.diff(begins) == 0)
                for i in same[::-1]:
                    doc[i] = doc[i + 1] - 1
                owner, crosses = owners(starts, ends, begins, rule)
                chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                stops = np.append(begins[1:], len(data))
                tokens = np.bincount(owner, minlength=len(begins))
                low = np.searchsorted(begins, starts[crosses], "right") - 1
                crossing = np.bincount(low, minlength=len(begins))
                here = np.searchsorted(doc, np.arange(len(offsets) - 1))
                columns = [
                    batch.column(0).take(pa.array(doc + row)),
                    pa.array(np.arange(len(doc)) - here[doc]),
                    pa.array(chars[begins] - chars[offsets[doc]]),
                    pa.array(chars[stops] - chars[offsets[doc]]),
                    pa.array(tokens),
                    pa.array(crossing),
                    pa.array(np.diff(first)[doc]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, SCHEMA)
