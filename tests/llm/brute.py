"""Plain Python versions of the operators, for small fixtures."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import string
import zlib

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def held(doc, modulus, remainder):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % modulus == remainder


def decontaminate(docs, items, window=10):
    """docs, items: (id, text) lists -> rows aligned with docs."""
    windows = collections.defaultdict(set)
    for item, text in items:
        words = WORD.findall(lower(text or ""))
        if item is None or not words:
            continue
        k = min(window, len(words))
        for s in range(len(words) - k + 1):
            windows[tuple(words[s : s + k])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = WORD.findall(lower(text or "")), set(), set()
        for k in sizes:
            for s in range(len(words) - k + 1):
                got = windows.get(tuple(words[s : s + k]))
                if got:
                    hit.update(range(s, s + k))
                    found |= got
        out.append((doc, len(words), len(hit), sorted(found)))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c)
        total += v if k % 2 == 0 else (v * 2 - 9 if v > 4 else v * 2)
    return total % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [(k, *m.span()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m[0])]


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def near_components(docs, width, percent=80):
    """{id: (set size, component)} by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def remove_lines(docs, min_sites=2):
    """docs: (id, text, source) -> {id: text} with cross-site lines and repeated passages cut."""
    sites, owners, first = collections.defaultdict(set), collections.defaultdict(set), {}

    def boilerplate(line):
        if len(line) >= 300 or len(line.split(" ")) > 50:
            return len(owners[line]) >= 2
        return len(sites[line]) >= (max(5, min_sites) if len(line) < 30 else min_sites)

    for doc, text, source in sorted(docs, key=lambda d: d[0]):
        for pos, raw in enumerate((text or "").split("\n")):
            line = raw.strip(" \t\r")
            if line:
                sites[line].add(source)
                owners[line].add(doc)
                first.setdefault(line, (doc, pos))
    out = {}
    for doc, text, _ in docs:
        parts = [
            raw
            for pos, raw in enumerate((text or "").split("\n"))
            if not raw.strip(" \t\r") or not boilerplate(raw.strip(" \t\r")) or first[raw.strip(" \t\r")] == (doc, pos)
        ]
        out[doc] = "\n".join(parts)
    return out


def mix(docs, weights=(3, 1, 2), fraction=1.5, repeats=2):
    """docs: (id, text, source) -> {id: taken}; sorts by hash."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in docs}
    per = collections.Counter()
    for i, _, s in docs:
        per[s] += size[i]
    names = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % 3] for n, s in enumerate(names)}
    budget, target, free = fraction * sum(per.values()), {}, set(names)
    while free:  # share, cap, share the rest again
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > repeats * per[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: float(repeats * per[s]) for s in over}
        free -= over
    taken = {}
    for s in names:
        mine = sorted((int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i) for i, _, t in docs if t == s)
        full = int(target[s] // per[s]) if per[s] else 0
        need, before = target[s] - full * per[s], 0
        for _, i in mine:
            more = need - before >= size[i] / 2
            taken[i] = size[i] * (full + more)
            before += size[i]
    return target, taken


def ctw_bits(training, text, depth=3):
    """Code length of ``text`` by a context tree built with plain recursion."""
    counts = collections.defaultdict(lambda: [0, 0])
    children = collections.defaultdict(set)
    for t in training:
        padded = b"\0" * depth + t
        for i in range(depth, len(padded)):
            for bit in range(8):
                node = (1 << bit) | (padded[i] >> (8 - bit))
                for d in range(depth + 1):
                    context = padded[i - d : i]
                    counts[context, node][padded[i] >> (7 - bit) & 1] += 1
                    if d:
                        children[context[1:], node].add(context)

    def log_kt(n):
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    memo = {}

    def weighted(context, node):
        if (context, node) not in memo:
            pe = log_kt(counts[context, node])
            if len(context) == depth:
                memo[context, node] = (pe, 1.0)
            else:
                below = sum(weighted(c, node)[0] for c in children[context, node])
                top = max(pe, below)
                pw = top + math.log(0.5 * math.exp(pe - top) + 0.5 * math.exp(below - top))
                memo[context, node] = (pw, 0.5 * math.exp(pe - pw))
        return memo[context, node]

    known = {c for c, _ in list(counts)}
    bits, padded = 0.0, b"\0" * depth + text
    for i in range(depth, len(padded)):
        deepest = max(d for d in range(depth + 1) if d == 0 or padded[i - d : i] in known)
        for bit in range(8):
            node, value = (1 << bit) | (padded[i] >> (8 - bit)), padded[i] >> (7 - bit) & 1
            p = None
            for d in range(deepest, -1, -1):
                context = padded[i - d : i]
                n = counts[context, node] if (context, node) in counts else [0, 0]
                own = (n[1] + 0.5) / (sum(n) + 1)
                share = 1.0 if p is None or not sum(n) else weighted(context, node)[1]
                p = own if p is None else share * own + (1 - share) * p
            bits -= math.log2(p if value else 1 - p)
    return bits


def discovered(rows, spans, rounds=4, support=3, confidence=0.8, smoothing=1.0):
    """Spans found by contexts: {(id, kind, start, end)}.  ``spans`` gives the
    base spans (kind, start, end) of a text."""
    import math
    from collections import defaultdict

    kinds = ("email", "ip", "card", "phone")
    mark = string.punctuation
    token = re.compile(r"\+[0-9][ ().0-9-]+[0-9]|(?<!\S)[^\s0-9@]*[0-9@]\S*")
    places = []
    for doc, text in rows:
        at = 0
        for m in token.finditer(text):
            before, whole = text[at : m.start()], m.group()
            at = m.end()
            core = whole.rstrip(mark.replace("+", "")).lstrip(mark.replace("+", "").replace("(", ""))
            if not core:
                continue
            start = m.start() + len(whole.rstrip(mark.replace("+", ""))) - len(core)
            own = [k for k, a, b in spans(core) if (a, b) == (0, len(core))]
            words = before[-80:].lower().split()[-2:]
            left = " ".join(words)
            shape = re.sub("[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", core))
            patterns = [(left, shape)] + ([left] if words else [])
            digits = sum(c.isdigit() for c in core)
            may = ["email"] if "@" in core else [k for k in kinds[1:] if digits >= 4]
            places.append((doc, start, start + len(core), core, own[0] if own else None, may, patterns))
    count = defaultdict(lambda: defaultdict(int))
    facts = {}
    for _, _, _, core, seed, may, patterns in places:
        facts[core] = (seed, may)
        for p in patterns:
            count[p][core] += 1
    known = {(v, seed): 1.0 for v, (seed, _) in facts.items() if seed}
    scores, weight = dict(known), {}
    for _ in range(rounds):
        weight = {}
        for p, values in count.items():
            for k in kinds:
                if sum(scores.get((v, k), 0) >= confidence for v in values) >= support:
                    mass = sum(n * scores.get((v, k), 0) for v, n in values.items())
                    weight[p, k] = round(mass / (sum(values.values()) + smoothing), 9)
        scores = dict(known)
        for v, (seed, may) in facts.items():
            for k in may if seed is None else ():
                own = [weight[p, k] for p in count if v in count[p] and (p, k) in weight]
                if own:
                    scores[v, k] = round(1 - math.prod(1 - min(t, 0.999) for t in own), 9)
    out = set()
    for doc, a, b, _, seed, may, patterns in places:
        own = [(weight[p, k], k) for p in patterns for k in may if weight.get((p, k), 0) >= confidence]
        if seed is None and own:
            out.add((doc, max(own)[1], a, b))
    return out
