"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

Spaces become marks (U+2581), a mark is put before the text, and the text is cut
before each run of marks: no piece of the model has a mark after another
character, so no piece crosses such a cut and every marked word can be encoded
by itself.  The distinct marked words of a batch are sorted, which lists the
trie of their prefixes depth-first, and each prefix is solved once: the forward
table of the path to the word before is kept up to the common prefix.

The model is a merge model (BPE), whose right segmentation isn't that of the
largest sum of scores.  So the forward table holds, for each prefix, the last
piece of its segmentation, and a piece may follow another only if merging the
two strings together gives just these two (``_follows``).  A sequence in which
all neighbours may follow each other is the merge result, and there is exactly
one for each prefix: the admissible path takes the place of the best one, and
the ids equal those of the library.

Characters without a piece stand alone and become their UTF-8 bytes.  Words with several marks
are merged directly (with a heap), since pieces of marks alone share one score.

Work and memory: one Arrow batch at a time, in groups of texts whose words are
solved together, as the more words are sorted the more prefixes they share. Words
are numbered and solved into one flat array of ids; a text's ids are gathered from
it by the numbers of its words, and the bytes that they decode to from those of
the pieces. A bounded memory of solved words is carried on and only saves work.

Edge cases: null and empty texts have no ids and decode to the empty text; a
mark in the text itself reads as a space, as in the library; long texts and long
words are solved whole, in time linear in their length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, ids_and_texts, released

MARK = "▁"
#: Default place of the model (a parameter of the operators).
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Solved words that a worker remembers (and four times as many checked pairs); once beyond, it starts anew.
MEMORY = 300_000

_WORDS = re.compile(f"{MARK}+[^{MARK}]*")
_NEVER = float("inf")


class _Numbers(dict):
    """Words by number, in the order of their first sight; ``fresh`` has the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [begin, end), one after the other, and how many there are before each range and after all."""
    sizes = end - begin
    upto = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(upto[-1]) + np.repeat(begin - upto[:-1], sizes), upto


def _marked(text: str) -> list[str]:
    """The marked words of a text."""
    return _WORDS.findall(MARK + text.replace(" ", MARK)) if text else []


class Codec:
    def __init__(self, path: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.bytes_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(self.text) if i not in special}
        self.cost = {p: -sp.get_score(i) for p, i in self.ids.items()}  # lower merges first
        self.plain = [b"" if i in special else p.replace(MARK, " ").encode() for i, p in enumerate(self.text)]
        for b, i in enumerate(self.bytes_id):
            self.plain[i] = bytes([b])
        self._plain_bytes = np.frombuffer(b"".join(self.plain), np.uint8)
        self._plain_ends = np.cumsum([0, *map(len, self.plain)])
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces of this model cross the cuts between marked words")
        self._steps: dict[str, tuple | None] = {}
        self._whole = [i not in special and self._history(p) is not None for i, p in enumerate(self.text)]
        self._pairs: dict[int, bool] = {}
        self._forget()
        self._link()

    # merging

    def merged(self, text: str, log: list | None = None) -> list[str]:
        """The pieces of a string, by merging the neighbours of the least cost, leftmost first."""
        parts, n = list(text), len(text)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (cost := self.cost.get(both := parts[i] + parts[j])) is not None:
                heappush(heap, (cost, i, both))

        for i in range(n - 1):
            offer(i)
        while heap:
            cost, i, both = heappop(heap)
            if not parts[i] or right[i] >= n or parts[i] + parts[right[i]] != both:
                continue  # one of the two has been merged meanwhile
            j = right[i]
            parts[i], parts[j] = both, ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            if log is not None:
                log.append((cost, parts[0], next(p for p in reversed(parts) if p)))
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [p for p in parts if p]

    def _history(self, piece: str) -> tuple | None:
        """Costs of the merges that make a piece, and its first and last part after each; None if they don't make it."""
        if piece not in self._steps:
            log = [(0.0, piece[0], piece[-1])]
            whole = self.merged(piece, log) == [piece]
            self._steps[piece] = tuple(zip(*log)) if whole else None
        return self._steps[piece]

    def _follows(self, u: str, v: str) -> bool:
        """Whether merging u + v keeps the two apart: no merge across comes first at any time."""
        a, b = self._history(u), self._history(v)
        if a is None or b is None:
            return False
        i = k = 0
        while True:
            across = self.cost.get(a[2][i] + b[1][k], _NEVER)
            next_u = a[0][i + 1] if i + 1 < len(a[0]) else _NEVER
            next_v = b[0][k + 1] if k + 1 < len(b[0]) else _NEVER
            if across < next_u and across <= next_v:
                return False
            if next_u == next_v == _NEVER:
                return True
            if next_u <= next_v:
                i += 1
            else:
                k += 1

    # the forward table

    def _link(self) -> None:
        """The pieces as an automaton: from the state of a string, ``_go`` leads by a character to that of the longer
        string, and ``_ending`` has the pieces that end there, as (length, id), the longest first."""
        go, own = [{}], [None]
        for piece, i in self.ids.items():
            state = 0
            for ch in piece:
                if ch not in go[state]:
                    go[state][ch] = len(go)
                    go.append({})
                    own.append(None)
                state = go[state][ch]
            own[state] = (len(piece), i)
        back, ending, level = [0] * len(go), [()] * len(go), [0]
        children = [dict(g) for g in go]
        while level:
            below = []
            for state in level:
                ending[state] = ((own[state],) if own[state] else ()) + (ending[back[state]] if state else ())
                for ch, nxt in children[state].items():
                    at = back[state]
                    while state and at and ch not in children[at]:
                        at = back[at]
                    back[nxt] = children[at].get(ch, 0) if state else 0
                    below.append(nxt)
            level = below
        self._go, self._back, self._children, self._ending = go, back, children, ending
        self._known_steps = 0

    def _step(self, state: int, ch: str) -> int:
        """Where ``ch`` leads when the state's string has no longer piece by it: remembered, up to a bound."""
        at = state
        while at and ch not in self._children[at]:
            at = self._back[at]
        nxt = self._children[at].get(ch, 0)
        if self._known_steps > MEMORY * 2:
            self._go = [dict(c) for c in self._children]
            self._known_steps = 0
        self._go[state][ch] = nxt
        self._known_steps += 1
        return nxt

    def solve(self, words: Iterable[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Ids of distinct words, given in sorted order."""
        pairs, whole, text, ending, raw = self._pairs, self._whole, self.text, self._ending, self.bytes_id
        # of each prefix of the current word: its last piece (-1: none), where that begins, the automaton's state
        last, starts, states = [-1], [0], [0]
        before = ""
        for word in words:
            if word.startswith(MARK * 2):
                yield word, tuple(chain.from_iterable(map(self._id, self.merged(word))))
                continue
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del last[shared + 1:], starts[shared + 1:], states[shared + 1:]
            state, go = states[-1], self._go
            for end in range(shared + 1, len(word) + 1):
                ch = word[end - 1]
                nxt = go[state].get(ch)
                if nxt is None:
                    nxt, go = self._step(state, ch), self._go
                state = nxt
                found = ending[state]
                begin, piece = end - 1, -1
                if found:
                    shortest = found[-1]
                    for one in found:  # the longest first; exactly one fits, so the shortest if no other does
                        size, piece = one
                        begin = end - size
                        if one is shortest:
                            break
                        u = last[begin]
                        if u < 0:
                            fits = whole[piece]
                        else:
                            key = u << 20 | piece
                            fits = pairs.get(key)
                            if fits is None:
                                fits = pairs[key] = self._follows(text[u], text[piece])
                        if fits:
                            break
                last.append(piece)
                starts.append(begin)
                states.append(state)
            before = word
            out, end = [], len(word)
            while end:
                piece, begin = last[end], starts[end]
                if piece >= 0:
                    out.append(piece)
                else:
                    out += [raw[x] for x in reversed(word[begin:end].encode("utf-8"))]
                end = begin
            out.reverse()
            yield word, out
        if len(pairs) > MEMORY * 4:
            pairs.clear()

    def _id(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [known] if known is not None else [self.bytes_id[b] for b in piece.encode("utf-8")]

    def _forget(self) -> None:
        self._number = _Numbers()
        # ids of solved words, one after the other, and where each word's begin and end, by its number
        self._flat, self._begin, self._end = array("i"), array("q"), array("q")

    def _numbered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the texts' words, one text after the other, and where each text's end; all of them solved."""
        if len(self._number) > MEMORY:
            self._forget()
        number, flat = self._number, self._flat
        numbers, ends = array("i"), array("q", [0])
        for t in texts:
            numbers.extend(map(number.__getitem__, _marked(t)))
            ends.append(len(numbers))
        fresh, number.fresh = number.fresh, []
        self._begin.extend([0] * len(fresh))
        self._end.extend([0] * len(fresh))
        begin, end = self._begin, self._end
        fresh.sort()
        for word, ids in self.solve(fresh):
            n = number[word]
            begin[n] = len(flat)
            flat.extend(ids)
            end[n] = len(flat)
        return np.frombuffer(numbers, np.int32), np.frombuffer(ends, np.int64)

    def _ids_of(self, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and where those of each text end, whose words end at ``ends``."""
        begin, end = np.frombuffer(self._begin, np.int64)[numbers], np.frombuffer(self._end, np.int64)[numbers]
        places, upto = _ranges(begin, end)
        return np.frombuffer(self._flat, np.int32)[places], upto[ends]

    def _plain_of(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that ids decode to (with the space of the first mark), and where each text's end."""
        places, upto = _ranges(self._plain_ends[ids], self._plain_ends[ids + 1])
        return self._plain_bytes[places], upto[ends]

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, ends = self._ids_of(*self._numbered(texts))
        return [ids[i:j].tolist() for i, j in zip(ends[:-1], ends[1:])]

    def encoded(self, texts: list[str], at_once: int) -> Iterator[tuple]:
        """(texts, ids, ends, bytes, ends) of the texts, solved together and given out ``at_once`` code points at a time."""
        numbers, stops = self._numbered(texts)
        done = 0
        for some in _groups(texts, at_once):
            own = stops[done:done + len(some) + 1]
            ids, ends = self._ids_of(numbers[own[0]:own[-1]], own - own[0])
            yield some, ids, ends, *self._plain_of(ids, ends)
            done += len(some)

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


codec = lru_cache(maxsize=1)(Codec)

#: Code points of texts that are solved together, or one text; and of texts that are written together.
_TOGETHER, _SLICE = 2_000_000, 250_000


def _groups(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _encoded(model: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = codec(model)
    for batch in released(batches):
        at = 0
        for group in _groups((t.as_py() or "" for t in batch.column(1)), _TOGETHER):
            for texts, ids, ends, plain, stops in c.encoded(group, _SLICE):
                crcs, same = [], []
                for t, i, j in zip(texts, stops[:-1].tolist(), stops[1:].tolist()):
                    back = plain[min(i + 1, j):j].tobytes()  # without the space of the first mark
                    crcs.append(zlib.crc32(back))
                    same.append(back == t.replace(MARK, " ").encode("utf-8"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(np.diff(ends)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                     pa.array(crcs, pa.int64()), pa.array(same, pa.bool_())],
                    names=["id", "n_tokens", "token_ids", "decoded_crc32", "round_trip"])
                at += len(texts)


def _decoded(model: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = codec(model)
    for batch in released(batches):
        texts = [c.decode(x.as_py() or ()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])


def sp_encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per row of ``df``: the id, n_tokens, token_ids, the CRC-32 of the text they decode to, and whether
    that is the text."""
    rows = ids_and_texts(df, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, token_ids array<int>, decoded_crc32 long, round_trip boolean"
    return rows.mapInArrow(partial(_encoded, model), schema).withColumnRenamed("id", id_col)


def sp_decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids", text_col: str = "text",
              model: str = MODEL) -> DataFrame:
    """The id and the text of each row's token ids (null ids: the empty text)."""
    rows = df.select(col(id_col).alias("id"), col(ids_col).cast("array<int>").alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(partial(_decoded, model), f"id {kind}, text string").select(
        F.col("id").alias(id_col), F.col("text").alias(text_col))
