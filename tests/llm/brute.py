"""Plain reference forms of the corpus operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_rules(text):
    found = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = Counter(tuple(found[i:i + 8]) for i in range(len(found) - 7))
    covered = set()
    for i in range(len(found) - 7):
        if windows[tuple(found[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    return {
        "n_words": len(found), "word_chars": sum(map(len, found)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": len(found) < 20 or 100 * len(covered) > 30 * len(found),
    }


def shingles(text, size=5):
    found = words(text)
    if not found:
        return Counter()
    return Counter(tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1)))


def probability_jaccard(x, y):
    total = 0.0
    for d in x.keys() & y.keys():
        total += 1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys())
    return total


def roots(vertices, edges):
    """Smallest vertex of each vertex's component."""
    above = {v: v for v in vertices}

    def top(v):
        while above[v] != v:
            above[v] = above[above[v]]
            v = above[v]
        return v

    for a, b in edges:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {v: top(v) for v in vertices}


def near_duplicates(docs, least=0.8):
    """doc_id -> smallest doc_id its links reach; docs: (doc_id, text)."""
    sets = [(i, shingles(t)) for i, t in docs]
    edges, seen = [], defaultdict(list)
    for at, (i, x) in enumerate(sets):
        met = {j for s in x for j in seen[s]}
        for j in met:
            y = sets[j][1]
            common = len(x.keys() & y.keys())
            if common >= 0.5 * max(len(x), len(y)) and probability_jaccard(x, y) >= least:
                edges.append((i, sets[j][0]))
        for s in x:
            seen[s].append(at)
    return roots([i for i, _ in docs], edges)


def repeated_words(docs, size=50):
    """doc_id -> set of word positions inside windows that another document holds too."""
    held = defaultdict(set)
    for i, text in docs:
        found = words(text)
        for s in range(len(found) - size + 1):
            held[tuple(found[s:s + size])].add(i)
    out = {}
    for i, text in docs:
        found = words(text)
        covered = set()
        for s in range(len(found) - size + 1):
            if len(held[tuple(found[s:s + size])]) > 1:
                covered.update(range(s, s + size))
        out[i] = covered
    return out, held


def sequences_needed(lengths, capacity):
    return math.ceil(sum(lengths) / capacity)


# --- secrets, filters, phrases -----------------------------------------------------------

_SECRETS = (
    ("assign", re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
_LOOSE = re.compile(r"[A-Za-z0-9_-]+")


def _looks_live(value):
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "-" for c in value]
    changes = sum((a, b) in {("l", "u"), ("l", "d"), ("u", "d"), ("d", "l"), ("d", "u")}
                  for a, b in zip(kinds, kinds[1:]))
    return len(value) >= 20 and kinds.count("d") >= 3 and changes >= 5 and len(set(value)) >= 10


def secrets(rows, owners_of_example=4):
    """Per row of (doc_id, text, owner): base counts, base spans and all spans."""
    uses = []
    for at, (_, text, owner) in enumerate(rows):
        text = text or ""
        base = [(m.start(), k, m.end(), m.group(group))
                for k, (_, pattern, group, least) in enumerate(_SECRETS)
                for m in pattern.finditer(text) if len(m.group(group)) >= least]
        loose = [(m.start(), 3, m.end(), m.group()) for m in _LOOSE.finditer(text)
                 if len(m.group()) >= 12 and re.search("[0-9]", m.group())
                 and not any(b < m.end() and m.start() < e for b, _, e, _ in base)]
        uses += [(at, owner, s, k, e, v.strip("+/_.=-"), _looks_live(v) or k < 2)
                 for s, k, e, v in base + loose]
    owners, assigned = {}, set()
    for _, owner, _, kind, _, key, _ in uses:
        owners.setdefault(key, set()).add(owner)
        if kind < 2:
            assigned.add(key)
    out = []
    names = [*(n for n, *_ in _SECRETS), "owned"]
    for at, (doc, _, _) in enumerate(rows):
        own = sorted((s, k, e, len(owners[v]) < owners_of_example and (live or v in assigned))
                     for i, _, s, k, e, v, live in uses if i == at)
        out.append((
            doc, *(sum(k == i for _, k, _, _ in own) for i in range(3)),
            ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in own if k < 3),
            ",".join(f"{names[k]}:{s}:{e}" for s, k, e, good in own if k < 3 or good)))
    return out


def filter_figures(rows, labels):
    """All figures by walking every document through every order of the filters."""
    from itertools import permutations

    good = {d for d, q, _ in labels if q == 1} - {None}
    toxic = {d for d, _, t in labels if t == 1} - {None}
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    out = {}
    for doc, text, part in rows:
        text, part = text or "", part or ""
        own = words(text)
        fails = {
            "A": len(own) < 50, "B": 100 * len(set(own)) < 65 * len(own),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc is not None and doc > first[text]}
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, name in enumerate(order, 1):
                row = out.setdefault((part, order, step), [0] * 6)
                if fails[name]:
                    row[3] += sum(fails.values()) == 1
                    row[2] += gone
                    row[1] += not gone
                    row[4] += not gone and doc in good
                    row[5] += not gone and doc in toxic
                    gone = True
                row[0] += not gone
    total = {}
    for (part, order, step), row in out.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + row[1]
    return {k: (*row, total[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


def phrases(rows, least, best, longest=5):
    """Scored phrases per language of rows of (text, lang)."""
    found, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            own = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(own)
            for size in range(1, longest + 1):
                for i in range(len(own) - size + 1):
                    key = lang, tuple(own[i: i + size])
                    found[key] = found.get(key, 0) + 1
    out = []
    for lang in totals:
        held = {p: f for (l, p), f in found.items() if l == lang and len(p) > 1 and f >= least}
        rows_ = []
        for p, a in held.items():
            inside = any(
                len(o) > len(p) and f >= a and any(o[i: i + len(p)] == p for i in range(len(o)))
                for o, f in held.items())
            if inside:
                continue
            cuts = [(1000 * a * totals[lang] // (found[lang, p[:k]] * found[lang, p[k:]]), k)
                    for k in range(1, len(p))]
            score, k = min(cuts)
            rows_.append((-score, -a, " ".join(p).encode(), found[lang, p[:k]], found[lang, p[k:]]))
        for rank, (score, a, text, l, r) in enumerate(sorted(rows_)[:best], 1):
            out.append((lang, rank, text.decode(), -a, l, r, totals[lang], -score))
    return out
