"""Plain single-machine versions of the operators, to compare with on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").encode().lower().decode()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def near(docs, size, num, den):
    """{id: (set size, component)} of (id, text) rows."""
    sets = {d: shingle_set(t, size) for d, t in docs}
    owners = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            owners[x].append(d)
    links = []
    for d, s in sets.items():
        common = Counter(o for x in s for o in owners[x] if o > d)
        links += [(d, o) for o, k in common.items() if den * k >= num * (len(s) + len(sets[o]) - k)]
    root = roots(sets, links)
    return {d: (len(s), root[d]) for d, s in sets.items()}


def contaminated(docs, items, window=10):
    """{id: (words, hit words, sorted item ids)}."""
    runs = defaultdict(set)
    for item, text in items:
        w = PLAIN.findall(lower(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            runs[tuple(w[i : i + window])].add(item)
    lengths = {len(r) for r in runs}
    out = {}
    for d, text in docs:
        w = PLAIN.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                owners = runs.get(tuple(w[i : i + n]))
                if owners:
                    found |= owners
                    hit |= set(range(i, i + n))
        out[d] = (len(w), len(hit), sorted(found))
    return out


def items_digest(items):
    return hashlib.sha256(",".join(sorted(str(i) for i in items)).encode()).hexdigest()


def without_later_runs(texts, least):
    """Texts without the lines of later copies of runs with at least `least` words, in the order of ids; {id: text}."""
    first, runs = {}, []
    for d in sorted(texts):
        lines = (texts[d] or "").split("\n")
        bare = [x.strip(" \t\r") for x in lines]
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in bare]
        spans = set()
        for i in range(len(lines)):
            for step in (1, -1):
                total, k = 0, i
                while 0 <= k < len(lines) and total < least:
                    total += words[k]
                    k += step
                if total >= least:
                    spans.add((i, k) if step == 1 else (k + 1, i + 1))
        runs += [(tuple(bare[a:b]), d, a, b) for a, b in spans]
    gone = defaultdict(set)
    for run, d, a, b in sorted(runs, key=lambda r: (r[1], r[2])):
        if run in first:
            gone[d] |= set(range(a, b))
        first.setdefault(run, (d, a))
    return {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[d]) if gone[d] else t for d, t in texts.items()}


def hard_negatives(rows, anchors, n_positives=5, n_negatives=10, low=30, high=90):
    """Rows (anchor, positive, rank, negative, positive's score, negative's score) of (id, label, numbers) rows."""
    rows = [r for r in rows if None not in r and None not in r[2]]
    out = []
    for a, label, v in sorted({(i, b, tuple(v)) for i, b, v in rows if anchors(i)}):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, b) for i, b, w in rows if len(w) == len(v))
        positives = [(i, -s) for s, i, b in scored if b == label and i != a][:n_positives]
        for p, ps in positives:
            fits = [(i, -s) for s, i, b in scored if b != label and low * ps <= -100 * s <= high * ps][:n_negatives]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(fits)]
    return sorted(out)


def spelling(docs, noise=None, least_letters=6, least_count=5, ratio=5):
    """{word: (form, root, n, near words, n of the form)}; pairs by trying all edits."""
    n = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_letters and k >= least_count}
    letters = sorted({c for w in n for c in w})
    near = {}
    for w in n:
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cuts} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}
        near[w] = sorted((e for e in edits - {w} if e in n), key=lambda e: (-n[e], e))
    form = {w: e[0] if e and n[e[0]] >= ratio * n[w] else None for w, e in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def fingerprint(text, size=64):
    """Packed anchors of a text, ascending."""
    import regex
    import xxhash

    alone = "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)))
    tokens = regex.findall(rf"(?V1)[[\p{{L}}\p{{M}}\p{{N}}]--[{alone}]]+|[{alone}]|[^\s\p{{L}}\p{{M}}\p{{N}}]", lower(text))

    def chain(numbers):
        seed = 42
        for x in numbers:
            seed = xxhash.xxh64_intdigest((x % 2**64).to_bytes(8, "little"), seed)
        return seed

    h = [xxhash.xxh64_intdigest(t.encode(), 42) for t in tokens]
    if 0 < len(h) < 4:
        found = [(chain(h), 0)]
    else:
        s = [chain(h[i : i + 2]) for i in range(len(h) - 1)]
        found = [(chain((s[i], s[i + 2])), i) for i in range(len(h) - 3) if min(map(signed, (s[i], s[i + 2]))) <= signed(s[i + 1])]
    first = {}
    for x, place in found:
        first.setdefault(signed(x) >> 20, place)
    return sorted((x << 20) | min(p, 2**20 - 1) for x, p in first.items())[:size]


def likeness(a, b, size=64):
    a, b = {x >> 20 for x in a}, {x >> 20 for x in b}
    both = a | b
    if len(a) >= size or len(b) >= size:
        both = set(sorted(both)[:size])
    return len(a & b & both) / len(both) if both else 1.0


def edited(docs):
    """{id: (characters, edited text's digest, fingerprint, edited fingerprint, both likenesses)} of distinct ids."""
    order = sorted(docs, reverse=True)
    out = {}
    for k, (d, text) in enumerate(order):
        text, ahead = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        new = text[: len(text) - third] + ahead[:third]
        marks, changed, after = fingerprint(text), fingerprint(new), fingerprint(ahead)
        as_text = ["".join(f"{x % 2**64:016X}" for x in m) for m in (marks, changed)]
        out[d] = (len(text), hashlib.sha256(new.encode()).hexdigest(), *as_text, likeness(marks, changed), likeness(marks, after))
    return out
