"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cov = {i + o for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for o in range(3)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(cov)}


def lines(docs):
    """docs: (doc_id, text) rows; results in the same order."""
    holders = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            k = x.strip(SPACE).translate(A_Z)
            if len(k) >= 10:
                holders[k].add((i is None, i or 0))
    out = []
    for i, t in docs:
        parts = (t or "").split("\n")
        def gone(x):
            h = holders.get(x.strip(SPACE).translate(A_Z), ())
            return len(h) > 1 and min(h) != (i is None, i or 0)
        kept = [x for x in parts if not gone(x)]
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def shingles(text, width=4):
    w = WORD.findall((text or "").translate(A_Z))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def near(docs, width=4, percent=80):
    sets = [(i, shingles(t, width)) for i, t in docs]
    parent = {i: i for i, _ in docs if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    live = [(i, s) for i, s in sets if i is not None and s]
    for a in range(len(live)):
        for b in range(a):
            (i, s), (j, u) = live[a], live[b]
            both = len(s & u)
            if 100 * both >= percent * (len(s) + len(u) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    # rows of one doc_id are one node, but an empty text of it stays by itself
    return [(i, len(s), root(i) if i is not None and s else i, i is None or (root(i) if s else i) == i) for i, s in sets]


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for item, t in items:
        w = FOLDED.findall((t or "").translate(A_Z))
        z = min(size, len(w))
        for i in range(len(w) - z + 1 if z else 0):
            windows[tuple(w[i:i + z])].add("null" if item is None else str(item))
    out = []
    for d, t in docs:
        w = FOLDED.findall((t or "").translate(A_Z))
        hit, ids = set(), set()
        for z in {len(x) for x in windows}:
            for i in range(len(w) - z + 1):
                found = windows.get(tuple(w[i:i + z]))
                if found:
                    ids |= found
                    hit |= set(range(i, i + z))
        out.append((d, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    found.sort()
    kinds = ("assign", "access", "hex")
    n = Counter(k for _, k, _ in found)
    return n[0], n[1], n[2], ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Water filling by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, done = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in done]
        left = total - sum(done.values())
        if not rest:
            return done
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] >= cap * sizes[s]]
        if not over:
            return done | share
        done |= {s: cap * sizes[s] for s in over}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(docs, items, top=20):
    bags = [(d, Counter(TERM.findall((t or "").translate(A_Z)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    wanted = defaultdict(Counter)
    for i, t in items:
        wanted[i].update(TERM.findall((t or "").translate(A_Z)))
    out = []
    for i, q in wanted.items():
        found = []
        for d, b in bags:
            m = 75 + (25 * sum(b.values()) * n_docs) // n_words
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * b[w]) // (1000 * b[w] + 12 * m))
                    for w, times in q.items() if w in b)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(i, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return out


def collocations(docs, low=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, t, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(A_Z)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for z in range(1, 5):
                for i in range(len(w) - z + 1):
                    f[lang][tuple(w[i:i + z])] += 1
    out = []
    for lang, g in f.items():
        cands = {p: a for p, a in g.items() if len(p) > 1 and a >= low}
        longer = Counter()
        for p, a in cands.items():
            for z in range(2, len(p)):
                for i in range(len(p) - z + 1):
                    longer[p[i:i + z]] = max(longer[p[i:i + z]], a)
        kept = []
        for p, a in cands.items():
            if 100 * longer[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (g[p[:k]] + g[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), g[p[:k]], g[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(kept)[:top])]
    return out


def repeats(docs, length, keep_first=False):
    """(doc_id, n_bytes, spans, rest) of each row.  Rows come in order of id; those equal in id
    and text count as one place with ``keep_first``."""
    starts = defaultdict(list)
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    raw = [(t or "").encode() for _, t in docs]
    for i in order:
        for p in range(len(raw[i]) - length + 1):
            starts[raw[i][p:p + length]].append((docs[i], p))
    out = []
    for i, (d, _) in enumerate(docs):
        cover = bytearray(len(raw[i]))
        for p in range(len(raw[i]) - length + 1):
            where = starts[raw[i][p:p + length]]
            if (where[0] != (docs[i], p)) if keep_first else len(where) > 1:
                cover[p:p + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(cover))]
        out.append((d, len(raw[i]), spans, bytes(b for b, c in zip(raw[i], cover) if not c)))
    return out
