"""Secret scan by assignment-aware lexing.

A text is lexed into name-literal pairs, in the notations that source and
configuration files share: ``name = "literal"``, ``name: literal``, ``"name":
"literal"``, ``name="literal"`` inside a tag, ``name => literal``, ``name: type =
"literal"``, ``var name type = "literal"``, ``table["name"] = "literal"``,
``setName("literal")``, ``<name>literal</name>``, ``scheme://user:literal@host``;
a literal may have a prefix (``b"..."``), three quotes, brackets around it, be the
default or the only argument of a call, or be put together with ``+``.
Constants are propagated: a name whose right-hand side is another name takes
that name's literal.  Every literal is scored by the most sensitive target name
it reaches and by its own make-up (length, kinds of characters, entropy); those
that reach ``MIN_SCORE`` are reported as spans of kind ``lexed``.

The base kinds are found by their patterns (leftmost, not overlapping, then too
short ones dropped) and always stay; a lexed literal that lies inside a base
span isn't reported a second time. Where a base assignment ends inside a quoted
literal, as at a space, the whole literal is reported.

Positions count code points, ends are exclusive.  Edge cases: null and empty
texts have no spans; texts of any length are read whole, one at a time.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, ids_and_texts, packed, released

#: Base kinds in their order, with pattern, group that is measured, and least length.
BASE = (
    ("assign", re.compile(r"""((?ia:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
     2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
KINDS = {kind: i for i, kind in enumerate([*(k for k, *_ in BASE), "lexed"])}

#: Parts of names and how sensitive they make a name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "private": 0.6, "key": 0.5, "auth": 0.5, "bearer": 0.9, "access": 0.4,
    "signature": 0.6, "salt": 0.6, "dsn": 0.6, "pass": 0.9, "signing": 0.5, "client": 0.3,
}
MIN_SCORE = 0.9

# "client" alone makes no name sensitive; before "://" there may be a login
_HINT = re.compile("|".join([*sorted(set(SENSITIVE) - {"client"}), "://[^\\s/@:]*:"]), re.IGNORECASE | re.ASCII)
_PAIR = re.compile(
    # a run of name characters is tried once, from its start: parts that begin with a digit or point aren't the name's
    r"""(?<![A-Za-z0-9_.-])["']?(?:[0-9.][A-Za-z0-9_.]*+-++|-++)*+(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)["']?[ \t]*"""
    r"""(?:=>|:=|=(?!=)|:(?!//))[ \t]*"""
    r"""(?:"(?P<dq>[^"\\\n]*(?:\\.[^"\\\n]*)*)"|'(?P<sq>[^'\\\n]*(?:\\.[^'\\\n]*)*)'|(?P<bare>[^\s"',;<>(){}\[\]]+))""")
_QUOTED = r"""(?:\"{3}(?P<td>(?:(?!\"{3}).)*+)\"{3}|'{3}(?P<ts>(?:(?!'{3}).)*+)'{3}|"(?P<dq>[^"\\\n]*(?:\\.[^"\\\n]*)*)"|'(?P<sq>[^'\\\n]*(?:\\.[^'\\\n]*)*)')"""
_PLAIN_STRING = r"""(?:"[^"\\\n]*(?:\\.[^"\\\n]*)*"|'[^'\\\n]*(?:\\.[^'\\\n]*)*')"""
_START = r"(?<![A-Za-z0-9_.-])"
_WORD = r"[A-Za-z_][A-Za-z0-9_.-]*+"
# what may stand between the sign of an assignment and its literal: a bracket, or a call (with a first argument)
_BEFORE = r"(?:(?P<call>[A-Za-z_][A-Za-z0-9_.]*+)?\([ \t]*(?P<first>" + _PLAIN_STRING + r"[ \t]*,[ \t]*)?)?[rbfuRBFU]{0,2}"
_MORE = r"(?P<more>(?:[ \t]*\+[ \t]*" + _PLAIN_STRING + r")*+)"
#: Notations besides the plain pair, each with a name and a quoted literal.
_NOTATIONS = [re.compile(p, re.DOTALL) for p in (
    # name = ("..."), b"...", triple quotes, call("..."), call("...", "..."), "..." + "..."
    _START + r"(?P<name>" + _WORD + r")[\"']?[ \t]*(?:=>|:=|=(?!=)|:(?!//))[ \t]*" + _BEFORE + _QUOTED + _MORE,
    # name: type = "..."
    _START + r"(?P<name>" + _WORD + r")[ \t]*:[ \t]*&?(?:'static )?[A-Za-z_][A-Za-z0-9_.]*+(?:[\[<][^\]\[<>\n=:]*+[\]>])?[?!]?[ \t]*="
    r"[ \t]*" + _BEFORE + _QUOTED + _MORE,
    # var name type = "..."
    r"\b(?:var|const|let|final)[ \t]+(?P<name>" + _WORD + r")[ \t]+[*A-Za-z_][A-Za-z0-9_.*]*+[ \t]*=[ \t]*" + _BEFORE + _QUOTED + _MORE,
    # table["name"] = "..."
    r"\[[ \t]*[\"'](?P<name>" + _WORD + r")[\"'][ \t]*\][ \t]*(?:=>|:=|=(?!=))[ \t]*" + _BEFORE + _QUOTED + _MORE,
    # setName("...")
    r"(?<![A-Za-z0-9_])(?:set|with|use)_?(?P<name>[A-Z_a-z][A-Za-z0-9_]*+)\([ \t]*[rbfuRBFU]{0,2}" + _QUOTED + _MORE + r"[ \t]*\)",
)]
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.:-]*+)(?:\s[^<>]*+)?>(?P<text>[^<>]++)</(?P=name)\s*+>")
_LOGIN = re.compile(r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s:/@]*+:(?P<text>[^\s@/]++)@")
#: Calls whose only argument is where a value is found, not the value.
_FETCH = re.compile(r"(?i)get|env|read|load|fetch|input|prompt|find|lookup|param|config|open|file|import|require")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
_STRINGS = re.compile(_PLAIN_STRING)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def sensitivity(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = ["".join(x) for x in zip(parts, parts[1:])]
    return min(1.5, sum(sorted((SENSITIVE.get(p, 0.0) for p in {*parts, *joined}), reverse=True)[:2]))


def strength(literal: str) -> float:
    """How much a literal looks like a secret by itself: 0 for short or plain ones, to 1."""
    if len(literal) < 6 or " " in literal or literal.lower() in ("example", "changeme", "placeholder", "undefined"):
        return 0.0
    counts = Counter(literal)
    bits = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    kinds = sum(any(f(c) for c in literal) for f in (str.islower, str.isupper, str.isdigit))
    return min(1.0, bits / 4.0) * min(1.0, len(literal) / 12) * (0.55 + 0.15 * kinds)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    for kind, pattern, group, least in BASE:
        if kind == "access" and "AKIA" not in text:
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), m.end(), kind))
    return out


def pairs(text: str) -> Iterator[tuple[str, int, int, str, bool]]:
    """(name, start, end, value, quoted) of all names and literals, the plain pairs first."""
    for m in _PAIR.finditer(text):
        kind = m.lastgroup
        value = m[kind]
        if kind == "bare":
            value = (value.strip("${}") if value.startswith("$") else value).rstrip(".")
        yield m["name"], m.start(kind), m.start(kind) + len(value), value, kind != "bare"
    for notation in _NOTATIONS:
        for m in notation.finditer(text):
            kind = next(k for k in ("td", "ts", "dq", "sq") if m[k] is not None)
            found = m.groupdict()
            if found.get("call") and not found.get("first") and _FETCH.search(found["call"]):
                continue
            start, end, value = m.start(kind), m.end(kind), m[kind]
            for more in _STRINGS.finditer(m["more"]):
                end = m.start("more") + more.end() - 1
                value += more.group()[1:-1]
            yield m["name"], start, end, value, True
    for m in _ELEMENT.finditer(text):
        value = m["text"].strip()
        start = m.start("text") + len(m["text"]) - len(m["text"].lstrip())
        yield m["name"], start, start + len(value), value, True
    for m in _LOGIN.finditer(text):
        yield "password", m.start("text"), m.end("text"), m["text"], True


def lexed_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, target name, score) of the literals that reach MIN_SCORE."""
    if not _HINT.search(text):
        return []
    literals: dict[str, list[tuple[int, int, str]]] = {}  # name: its literals
    sources: dict[str, set[str]] = {}  # name: names whose value it takes
    for name, start, end, value, quoted in pairs(text):
        if not quoted and _NAME.match(value) and value != name:
            sources.setdefault(name, set()).add(value)
        literals.setdefault(name, []).append((start, end, value))
    weight = {name: sensitivity(name) for name in literals}
    target: dict[str, str] = {}  # name: the most sensitive name that its literal reaches
    for best in sorted(weight, key=lambda n: (-weight[n], n)):  # each name is visited once, from its best target
        todo = [] if best in target else [best]
        while todo:
            if (name := todo.pop()) not in target:
                target[name] = best
                todo += sources.get(name, ())
    out: dict[tuple[int, int], tuple[int, int, str, float]] = {}  # of a literal with several names, the best
    for name, found in literals.items():
        top = weight[target[name]]
        if top <= 0:
            continue
        for start, end, value in found:
            if value in literals and value != name:  # a reference, not a literal
                continue
            own = strength(value)
            score = top * 0.7 + own * 0.6 if own > 0.45 else 0.0
            if score >= MIN_SCORE and ((start, end) not in out or score > out[start, end][3]):
                out[start, end] = (start, end, target[name], round(score, 4))
    return sorted(out.values())


def _cut_short(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The quoted literals that a base assignment reaches into, but not to the end."""
    assigned = [(s, e) for s, e, kind in base if kind == "assign"]
    if not assigned:
        return []
    starts = [s for s, _ in assigned]
    out = set()
    for _, start, end, _, quoted in pairs(text):
        i = bisect_right(starts, start) - 1
        if quoted and i >= 0 and start < assigned[i][1] < end:
            out.add((start, end))
    return sorted(out)


def scan(text: str) -> dict:
    base = base_spans(text)
    base.sort(key=lambda s: (s[0], KINDS[s[2]]))
    starts, reach = [s for s, *_ in base], list(accumulate((e for _, e, _ in base), max))
    inside = lambda s, e: (i := bisect_right(starts, s)) > 0 and reach[i - 1] >= e
    more = sorted({(s, e) for s, e, *_ in lexed_spans(text) if not inside(s, e)} | set(_cut_short(text, base)))
    spans = sorted([*base, *((s, e, "lexed") for s, e in more)], key=lambda s: (s[0], KINDS[s[2]], s[1]))
    told = lambda xs: ",".join(f"{k}:{s}:{e}" for s, e, k in xs)
    count = Counter(k for *_, k in base)
    return {"n_assign": count["assign"], "n_access": count["access"], "n_hex": count["hex"],
            "base_sha256": hashlib.sha256(told(base).encode()).hexdigest(), "spans": told(spans),
            "n_lexed": len(more), "places": spans}


def redacted(text: str, places: list[tuple[int, int, str]], mark: str = "[secret]") -> str:
    """The text with every span replaced by ``mark``; spans that overlap are replaced as one."""
    out, at = [], 0
    for start, end, _ in sorted(places):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


_FIELDS = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(),
           "spans": pa.string(), "n_lexed": pa.int64()}


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        found = [scan(t.as_py() or "") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([x[k] for x in found], kind) for k, kind in _FIELDS.items())],
            names=["id", *_FIELDS])


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        texts = []
        for t in batch.column(1):
            text = t.as_py()
            places = scan(text)["places"] if text else []
            texts.append(redacted(text, places) if places else text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])


def secret_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, counts of the base kinds, their digest, and all spans."""
    rows = ids_and_texts(df, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_scanned, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                     "spans string, n_lexed long").withColumnRenamed("id", id_col)


def without_secrets(df: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """``df`` with every span replaced in the text; ``size_col``, if there, counts the new text's code points (of a null
    text, it stays)."""
    other = packed(df.drop(text_col)) if len(df.columns) > 1 else F.struct(F.lit(0).alias("none")).alias("row")
    rows = df.select(other, col(text_col).cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(_redacted, f"row {kind}, text string")
    size = lambda c: F.coalesce(F.char_length("text"), F.col("row")[c]).cast(df.schema[c].dataType)
    return out.select(*[F.col("text").alias(c) if c == text_col else (size(c) if c == size_col else F.col("row")[c])
                        .alias(c) for c in df.columns])
