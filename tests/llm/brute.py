"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered |= set(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and _luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def pii(text):
    return {k: [m.span() for m in r.finditer(text or "") if _valid(k, m[0])] for k, r in PII.items()}


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
SECRETS = ("assign", "access", "hex")


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k):
    w = words(lower(text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def near(rows, k, percent=80):
    """Component (smallest id reachable) of each (id, text)."""
    sets = [shingles(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                top[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        root = find(i)
        if d is not None and (least[root] is None or d < least[root]):
            least[root] = d
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)]


def repeats(texts, width):
    """Kept words per text."""
    split = [words(t) for t in texts]
    often = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if often[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def line_entries(text, min_words):
    seen, out = Counter(), {}
    for i, raw in enumerate((text or "").split("\n")):
        cut = raw.strip(" \t\r\x0b\x0c")
        if len(words(cut)) >= min_words:
            out[(cut, seen[cut])] = i
            seen[cut] += 1
    return out


def partners(found, rare):
    """Per document, the earlier ones it is to be aligned with."""
    owner, df = {}, Counter()
    for i, entries in enumerate(found):
        for e in entries:
            owner.setdefault(e, i)
            df[e] += 1
    for i, entries in enumerate(found):
        least = defaultdict(lambda: len(found) + 1)
        for e in entries:
            if owner[e] != i:
                least[owner[e]] = min(least[owner[e]], df[e])
        limit = max([rare, *([min(least.values())] if least else [])])
        yield sorted(o for o, n in least.items() if n <= limit)


def rise(pairs):
    """A longest rising run, as pairs: piles of patience sorting, each card pointing to the top of the pile before."""
    piles, back = [], {}
    for i, (_, q) in enumerate(pairs):
        k = next((k for k, pile in enumerate(piles) if pairs[pile[-1]][1] >= q), len(piles))
        if k == len(piles):
            piles.append([])
        back[i] = piles[k - 1][-1] if k else None
        piles[k].append(i)
    out, i = [], piles[-1][-1] if piles else None
    while i is not None:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def deleted(rows, rare=64, min_words=4):
    """Positions each (id, text) loses; ids distinct and in order."""
    cut = [[x.strip(" \t\r\x0b\x0c") for x in (t or "").split("\n")] for _, t in rows]
    entries = [line_entries(t, min_words) for _, t in rows]
    chosen = [dict(e) | ({("whole", tuple(x for x in c if x)): -1} if e else {}) for e, c in zip(entries, cut, strict=True)]
    out = []
    for i, others in enumerate(partners(chosen, rare)):
        gone = set()
        for j in others:
            kept = rise(sorted((p, entries[j][e]) for e, p in entries[i].items() if e in entries[j]))
            for p, q in kept:
                gone.add(p)
                for step in (1, -1):
                    a, b = p + step, q + step
                    while True:
                        while 0 <= a < len(cut[i]) and not cut[i][a]:
                            a += step
                        while 0 <= b < len(cut[j]) and not cut[j][b]:
                            b += step
                        if not (0 <= a < len(cut[i]) and 0 <= b < len(cut[j])) or cut[i][a] != cut[j][b] or len(words(cut[i][a])) >= min_words:
                            break
                        gone.add(a)
                        a, b = a + step, b + step
        out.append(gone)
    return out


def deleted_lines(rows, rare, min_words):
    """Number of deleted lines per (id, text), ids distinct and in order."""
    return [len(x) for x in deleted(rows, rare, min_words)]


def contained(docs, items, k=5, percent=80):
    def split(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def sets(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    wanted = [(i, w, min(k, len(w))) for i, w in ((i, split(t)) for i, t in items) if w]
    out = []
    for d, t in docs:
        own = split(t)
        for i, w, n in wanted:
            all_, found = sets(w, n), sets(w, n) & sets(own, n)
            if 100 * len(found) >= percent * len(all_):
                out.append((d, i, len(found), len(all_)))
    return out


def runs(w, min_words=6, min_periods=4):
    """(start, length, period) of every periodic run, straight from the definition."""
    out = []
    for q in range(1, len(w) // min_periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            stretch = w[i : i + length]
            if j > i and length >= max(min_words, min_periods * q):
                smaller = any(all(stretch[x] == stretch[x + p] for x in range(length - p)) for p in range(1, q))
                if not smaller:
                    out.append((i, length, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)
