"""Token counts attributed to sections by character offsets.

A document is encoded once, whole, with a byte-level BPE.  Each token's byte
span follows from the lengths of the tokens before it; the spans are joined
with the spans of the document's sections (an interval join of two sorted
lists), and a token that crosses a boundary goes to one section by an explicit
rule:

* ``first``: the section that holds the token's first byte;
* ``last``: the section that holds its last byte;
* ``most``: the section that holds most of its bytes, the first of ties.

So a document's counts add up to the tokens of the whole document, which
counting its sections one by one would not give.

Sections are the lines of the text (a line feed belongs to the line it ends),
or several columns: ``fields`` are joined with line feeds, each of which belongs
to the field before it.

Edge cases: a null or empty text is one section without tokens; null fields are
empty; a document of any length is one call, and memory grows with one document
and the rows of one Arrow batch.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col

RULES = ("first", "last", "most")
#: Default place of the vocabulary (a parameter of the operator).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts are cut before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str):
    """The encoding and the byte length of each token."""
    import tiktoken

    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


#: White space as the pattern has it, and a run so long that it is cut off before the pattern sees it.
_SPACES, LONG_RUN = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]", 4096


def token_ids(encoding, text: str, long_run: int = LONG_RUN) -> list[int]:
    """The ids of a text. Of a long run of white space, whose matching would take too deep a stack, the pattern makes
    one piece of all of it at the end of the text, and of all but its last character elsewhere; that piece is cut off
    here and merged by itself."""
    ids, at = [], 0
    for m in re.finditer(_SPACES + "{%d,}" % long_run, text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        ids += encoding.encode_ordinary(text[at:m.start()])
        ids += encoding._encode_single_piece(text[m.start():end])
        at = end
    return ids + encoding.encode_ordinary(text[at:])


def attribute(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens of each section; spans tile the text and are given by their ends.

    A section is given the crossing tokens that the rule allots to it.  Empty
    sections hold no byte and so no token.
    """
    starts = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    owner = first if rule != "last" else last
    crossing = first != last
    if rule == "most":
        owner = first.copy()
        for i in np.nonzero(crossing)[0]:
            parts = np.arange(first[i], last[i] + 1)
            ends = np.minimum(section_ends[parts], token_ends[i])
            held = np.diff(np.concatenate([[starts[i]], ends]))
            owner[i] = parts[int(np.argmax(held))]
    n = len(section_ends)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def sections_of(parts: Sequence[str]) -> np.ndarray:
    """Ends in bytes of the parts of a text."""
    return np.cumsum([len(p.encode("utf-8")) for p in parts])


def _counted(path: str, rule: str, lines: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoding, sizes = encoder(path)
    for batch in batches:
        columns: list[list] = [[] for _ in range(7)]
        for row, fields in enumerate(batch.column(1).to_pylist()):
            fields = [x or "" for x in fields]
            if lines:
                text = fields[0]
                parts = [x + "\n" for x in text.split("\n")]
                parts[-1] = parts[-1][:-1]
                if len(parts) > 1 and not parts[-1]:
                    parts.pop()
            else:
                parts = [x + "\n" for x in fields[:-1]] + fields[-1:]
                text = "".join(parts)
            ends = np.cumsum(sizes[np.array(token_ids(encoding, text), np.int64)])
            got, crossing = attribute(ends, sections_of(parts), rule)
            stops = np.cumsum([len(p) for p in parts])
            n = len(parts)
            for into, values in zip(columns, (np.full(n, row), np.arange(n), stops - [len(p) for p in parts], stops,
                                              got, crossing, np.full(n, len(ends)))):
                into.append(values)
        arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(arrays[0])), *(pa.array(a.astype(np.int64)) for a in arrays[1:])],
            names=["id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fields: Sequence[str] = (),
                 rule: str = "first", vocabulary: str = VOCABULARY) -> DataFrame:
    """A row for each section: id, section from 0, its code points [start, end), its tokens, those of them that cross
    a boundary, and the document's tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = df.select(col(id_col).alias("id"),
                     F.array(*[col(c).cast("string") for c in (fields or [text_col])]).alias("fields"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(partial(_counted, vocabulary, rule, not fields),
                          f"id {kind}, section long, start long, end long, n_tokens long, n_crossing long, "
                          "doc_tokens long")
    return out.withColumnRenamed("id", id_col)
