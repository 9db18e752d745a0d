"""Plain Python versions of what the operators must return."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return (text or "").translate(LOWER)


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    found = [(i, label) for p, label in phrases.items() for i in range(len(words))
             if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def fingerprint(text):
    words = SPACED.findall(lowered(text))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """[(id, fingerprint)] -> the smallest id of each row's class."""
    marks = sorted({f for _, f in rows})
    root = {f: f for f in marks}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(marks):
        for b in marks[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for i, f in rows:
        if i is not None:
            ids[find(f)].append(i)
    return [(i, f, min(ids[find(f)], default=None)) for i, f in rows]


def quality_counts(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def quality(rows):
    """[(text, lang, source)] -> counts, base_failed and kept."""
    slack = {"symbol_share": 100, "dup_line_share": 1500, "repeat_share": 1000, "word_size": 50}
    counts = [quality_counts(t) for t, *_ in rows]
    share = lambda a, b, by: a * by // b if b else 0
    for c in counts:
        c.update(symbol_share=share(c["n_symbols"], c["word_chars"], 10_000),
                 dup_line_share=share(c["n_dup_lines"], c["n_lines"], 10_000),
                 repeat_share=share(c["n_repeat_words"], c["n_words"], 10_000),
                 word_size=share(c["word_chars"], c["n_words"], 100))

    def bucket(v):
        width = 1 << max(0, v.bit_length() - 6)
        return v - v % width

    def quartiles(values):
        values = sorted(map(bucket, values))
        at = lambda q: values[-(-len(values) * q // 4) - 1]
        return at(1), at(3)

    for (_, lang, source), c in zip(rows, counts):
        c["base_failed"] = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        c["kept"] = not c["base_failed"]
        for m, s in slack.items():
            for level in (lambda r: r[1:] == (lang, source), lambda r: r[1] == lang, lambda r: True):
                seen = [x[m] for r, x in zip(rows, counts) if level(r)]
                if len(seen) >= 50:
                    break
            q1, q3 = quartiles(seen)
            spread = max(q3 - q1, s)
            if c[m] > q3 + 3 * spread or m == "word_size" and c[m] < q1 - 3 * spread:
                c["kept"] = False
    return counts


def base_secrets(text):
    text = text or ""
    out = []
    kinds = (("assign", r"""((?ia:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
             ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))
    for order, (kind, pattern, group, least) in enumerate(kinds):
        out += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text)
                if len(m.group(group)) >= least]
    out.sort()
    told = [s for *_, s in out]
    count = Counter(s.split(":")[0] for s in told)
    return (count["assign"], count["access"], count["hex"], hashlib.sha256(",".join(told).encode()).hexdigest()), told


def language_base(rows):
    """[(id, text)] -> (held_out, n_tokens, n_known, N, base score)."""
    import math

    tokens = [SPACED.findall(lowered(t)) + [None] for _, t in rows]
    out = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, out) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(h, len(ws), sum(counts[w] > 0 for w in ws), n,
             sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for ws, h in zip(tokens, out)]


UNITS = set("mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr hours minutes seconds days weeks months years "
            "percent dollars euros usd eur meters metres miles kilometers kilometres grams pounds liters litres".split())


def template_words(text):
    """[(lower-cased word, mark)]: the mark is "name" inside a sentence, "maybe" where a word is capitalised elsewhere."""
    import regex

    out = []
    text = (text or "").translate({1: " ", 2: " "})
    for m in regex.finditer(r"[\p{L}\p{M}\p{N}]+(?:(?<=\p{N})[.,](?=\p{N})[\p{L}\p{M}\p{N}]+)*", text):
        mark = ""
        if regex.match(r"\p{Lu}\p{Ll}", m.group()):
            mark = "name" if regex.search(r"[\p{L}\p{N},;:)] \Z", text[:m.start()][-2:]) else "maybe"
        out.append((m.group().lower(), mark))
    return out


def is_number(word):
    return "0" <= word[:1] <= "9"


def kinds(words, names, before=None):
    """The canonical form of words, and their values: ``names`` says of each whether it is one."""
    out, values = [], []
    for (word, _), name in zip(words, names):
        values.append(("name " if name else "") + word)
        if name:
            out.append("<name>")
        elif is_number(word):
            out.append("<number>")
        elif word in UNITS and before is not None and not before[1] and is_number(before[0]):
            out.append("<unit>")
        else:
            out.append(word)
        before = (word, name)
    return out, values


MARKS = {"<name>", "<number>", "<unit>"}


def item_windows(words):
    """(rows, of): each row is (at, size, strict, canonical window, slot values)."""
    import itertools

    n, rows = len(words), []
    if n < 4:
        return [], 0
    size = min(n, 8)
    for at in range(max(n - 8, 0) + 1):
        part = words[at:at + size]
        before = (words[at - 1][0], words[at - 1][1]) if at else None
        choices = [(True,) if mark == "name" else (False, True) if mark == "maybe" else (False,) for _, mark in part]
        few = []
        for names in itertools.product(*choices):
            canon, values = kinds(part, names, before and (before[0], before[1] != ""))
            few.append(sum(c not in MARKS for c in canon) < 4)
            rows.append((at, size, few[0], few[-1], tuple(canon), [v for v, c in zip(values, canon) if c in MARKS]))
    told = {at for at, _, weak, *_ in rows if not weak}
    of = len(told) or len({r[0] for r in rows})
    return [(at, size, strict or of == 1, canon, asked) for at, size, weak, strict, canon, asked in rows if not told or not weak], of


def is_leak(hits, of):
    """hits: (at, place, size, asked, found) of one document and item."""
    by_shift = defaultdict(list)
    for hit in hits:
        by_shift[hit[1] - hit[0]].append(hit)
    groups = [(False, held) for held in by_shift.values()]
    shifts, cluster = sorted(by_shift), []
    for shift in [*shifts, None]:
        if cluster and (shift is None or shift - cluster[-1] > 8):
            if len(cluster) > 1:
                rank = lambda h: (len(by_shift[h[1] - h[0]]), -(h[1] - h[0]))
                near = [h for s in cluster for h in by_shift[s]]
                for by in (1, 0):  # of a place, then of a window of the item, the hit of the fullest diagonal
                    best = {}
                    for h in near:
                        if h[by] not in best or rank(h) > rank(best[h[by]]):
                            best[h[by]] = h
                    near = list(best.values())
                groups.append((True, near))
            cluster = []
        if shift is not None:
            cluster.append(shift)
    for merged, held in groups:
        ats, size = sorted({h[0] for h in held}), max(h[2] for h in held)
        run, first, end = 0, 0, -1
        for at in ats:
            first = first if at <= end else at
            end = at + size
            run = max(run, end - first)
        pairs = {p for h in held for p in zip(h[3], h[4])}
        if (len(ats) >= 0.5 * of or run >= 13 and not merged) and len(pairs) == len({a for a, _ in pairs}):
            return True
    return False


def leaks(docs, items):
    """[(id, text)], [(item, text)] -> {(id, item)}"""
    asked = {(i, t or ""): item_windows(template_words(t)) for i, t in items}
    sizes = {8} | {r[1] for rows, _ in asked.values() for r in rows}
    by_form = defaultdict(list)
    for key, (rows, of) in asked.items():
        for at, size, strict, canon, values in rows:
            by_form[canon].append((key, of, at, size, strict, values))
    out = set()
    for doc, text in docs:
        words = template_words(text)
        inside, maybe = ({w for w, m in words if m == mark} for mark in ("name", "maybe"))
        known = (inside & maybe) - {w for w, m in words if not m}
        names = [m == "name" or m == "maybe" and w in known for w, m in words]
        canon, values = kinds(words, names)
        found = defaultdict(list)
        for size in sizes:
            for p in range(len(canon) - size + 1):
                for key, of, at, _, strict, own in by_form.get(tuple(canon[p:p + size]), ()):
                    held = [v for v, c in zip(values[p:p + size], canon[p:p + size]) if c in MARKS]
                    if not strict or own == held:
                        found[key, of].append((at, p, size, own, held))
        out |= {(doc, key[0]) for (key, of), hits in found.items() if is_leak(hits, of)}
    return out
