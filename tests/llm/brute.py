"""Plain versions of the operators, for small inputs."""

import math
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text) if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, k=5):
    w = words(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1)))


def components(texts):
    """The smallest index each text reaches over links of 80 per cent."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def repeats(texts, length=200):
    """Per text: kept bytes, bytes removed, spans removed."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = []
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                if gone and i <= gone[-1][1]:
                    gone[-1][1] = i + length
                else:
                    gone.append([i, i + length])
        at = [0, *[x for g in gone for x in g], len(d)]
        kept = b"".join(d[a:b] for a, b in zip(at[::2], at[1::2]))
        out.append((kept, len(d) - len(kept), len(gone)))
    return out


def clean_lines(docs, min_docs=3, depth=3, agree=0.7):
    """Texts by id without lines whose template recurs; ``docs`` maps id to text."""
    lines, leaf_docs, forms = [], defaultdict(set), defaultdict(Counter)
    for i, text in sorted(docs.items()):
        for pos, line in enumerate((text or "").split("\n")):
            form = tuple("<*>" if re.search("[0-9]", t) else t for t in words(line))
            if form:
                leaf = (len(form), form[:depth])
                lines.append((i, pos, leaf, form))
                leaf_docs[leaf].add(i)
                forms[leaf][form] += 1
    template, holders, first, seeds = {}, defaultdict(set), {}, {}
    for leaf, found in forms.items():
        left = sorted(found, key=lambda f: (-found[f], f))
        while left:
            seed, rest = left[0], []
            for form in left:
                if sum(a == b for a, b in zip(form, seed)) >= agree * len(form):
                    seeds[leaf, form] = seed
                else:
                    rest.append(form)
            left = rest
    for i, pos, leaf, form in lines:
        if len(leaf_docs[leaf]) >= min_docs:
            template[i, pos] = (leaf, seeds[leaf, form])
            holders[template[i, pos]].add(i)
            first.setdefault(template[i, pos], (i, pos))
    return {i: "\n".join(line for pos, line in enumerate((text or "").split("\n"))
                         if (i, pos) not in template or len(holders[template[i, pos]]) < min_docs
                         or first[template[i, pos]] == (i, pos)) for i, text in docs.items()}


class KneserNey:
    """Interpolated modified Kneser-Ney over bytes, by its recursive definition."""

    def __init__(self, texts, order):
        self.order = order
        top = Counter()
        for t in texts:
            t = bytes(order - 1) + t
            top.update(t[i:i + order] for i in range(len(t) - order + 1))
        self.counts = {order: top}
        for m in range(order - 1, 0, -1):
            self.counts[m] = Counter(g[1:] for g in self.counts[m + 1])
        self.discounts = {}
        for m, c in self.counts.items():
            n = Counter(c.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            self.discounts[m] = [
                min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) if n[i] else 0.5
                for i in (1, 2, 3)]

    def p(self, gram):
        m = len(gram)
        if m == 0:
            return 1 / 256
        d = self.discounts[m]
        follow = [(g, n) for g, n in self.counts[m].items() if g[:-1] == gram[:-1]]
        if not follow:
            return self.p(gram[1:])
        total = sum(n for _, n in follow)
        left = sum(d[min(n, 3) - 1] for _, n in follow)
        n = self.counts[m][gram]
        own = n - d[min(n, 3) - 1] if n else 0
        return own / total + left / total * self.p(gram[1:])

    def bits(self, text):
        t = bytes(self.order - 1) + text
        return -sum(math.log2(self.p(t[i:i + self.order])) for i in range(len(t) - self.order + 1))


def winnow(hashes, gram=4, window=8):
    """Chosen (hash, position) of word hashes by definition, for texts of ``gram`` words or more."""
    def rotated(x, bits):
        return ((x << bits) | (x >> (64 - bits))) & (2**64 - 1) if bits else x
    grams = []
    for i in range(len(hashes) - gram + 1):
        h = 0
        for j in range(gram):
            h ^= rotated(hashes[i + j], 7 * (gram - 1 - j))
        grams.append((h & (2**39 - 1), i))
    chosen = []
    for i in range(max(len(grams) - window + 1, 1)):
        best = min(grams[i:i + window], key=lambda g: (g[0], -g[1]))
        if not chosen or chosen[-1] != best:
            chosen.append(best)
    return chosen
