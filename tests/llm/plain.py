"""Plain versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import xxhash


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
    if not w:
        return 0
    k = min(3, len(w))
    shingles = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in shingles) > len(shingles))


def shingle_set(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
    k = min(k, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def classes(keys, linked):
    """The smallest key reachable, for each position."""
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(keys)):
        for j in range(i + 1, len(keys)):
            if linked(i, j):
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [least.get(find(i)) for i in range(len(keys))]


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def contamination(docs, items, window=10):
    """For each text (words, words hit, items)."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = defaultdict(set)
    for item, t in items:
        w = split(t)
        if k := min(window, len(w)):
            for i in range(len(w) - k + 1):
                windows[tuple(w[i : i + k])].add("" if item is None else str(item))
    out = []
    for t in docs:
        w, hit, found = split(t), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if s := windows.get(tuple(w[i : i + k])):
                    hit |= set(range(i, i + k))
                    found |= s
        out.append((len(w), len(hit), sorted(found)))
    return out


def katz(texts, train, discounts, k, tail, order=3):
    """Per text: tokens, known ones, training tokens, base score and log10 probability, by the recursion as it is written."""
    import math

    split = [re.findall(r"[^\x20\x09-\x0D]+", lowered(t)) + ["\n"] for t in texts]
    grams = [None, *(Counter() for _ in range(order))]
    for w, use in zip(split, train, strict=True):
        if use:
            padded = [" "] * (order - 1) + w
            for i in range(order - 1, len(padded)):
                for m in range(1, order + 1):
                    grams[m][tuple(padded[i - m + 1 : i + 1])] += 1
    n, v = sum(grams[1].values()), len(grams[1])
    tables = [None] + [discounts([sum(x == r for x in g.values()) for r in range(1, k + 2)]) for g in grams[1:]]
    d = lambda m, r: tables[m][r] if r <= k else 1 - tail
    unknown = 1 - sum(d(1, c) * c / n for c in grams[1].values()) if n else 1
    followers = [None, *(defaultdict(list) for _ in range(order))]
    for m in range(2, order + 1):
        for g, c in grams[m].items():
            followers[m][g[:-1]].append((g[-1], c))
    alphas = {}

    def alpha(h):
        if h not in alphas:
            m, own = len(h) + 1, followers[len(h) + 1][h]
            total = sum(c for _, c in own)
            alphas[h] = (1 - sum(d(m, c) * c / total for _, c in own)) / (1 - sum(p(h[1:], w) for w, _ in own)) if own else 1
        return alphas[h]

    totals = {}

    def p(h, w):
        m = len(h) + 1
        if m == 1:
            return d(1, grams[1][w,]) * grams[1][w,] / n if grams[1][w,] else unknown
        if c := grams[m][(*h, w)]:
            if h not in totals:
                totals[h] = sum(x for _, x in followers[m][h])
            return d(m, c) * c / totals[h]
        return alpha(h) * p(h[1:], w)

    for h in list(followers[order])[:40]:  # the probabilities of a history sum to one
        assert abs(sum(p(h, w) for (w,) in grams[1]) + p(h, None) - 1) < 1e-9
    out = []
    for w in split:
        base = sum(math.log10((grams[1][x,] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        padded = [" "] * (order - 1) + w
        logs = sum(math.log10(p(tuple(padded[i - order + 1 : i]), padded[i])) for i in range(order - 1, len(padded)))
        out.append((len(w), sum(grams[1][x,] > 0 for x in w), n, base, logs))
    return out


class _Article(HTMLParser):
    """Blocks of text inside an article and outside of adverts, for pages whose markup is plain."""

    def __init__(self):
        super().__init__()
        self.open, self.parts, self.blocks = [], [], []

    def cut(self):
        if t := " ".join("".join(self.parts).split()):
            self.blocks.append(t)
        self.parts = []

    def handle_starttag(self, tag, attributes):
        if tag == "br":
            self.parts.append(" ")
        elif tag not in ("b", "a", "meta"):
            self.cut()
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            self.cut()
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        if "article" in self.open:
            self.parts.append(data)


def article(page):
    a = _Article()
    a.feed(page or "")
    a.close()
    a.cut()
    return " ".join(a.blocks)
