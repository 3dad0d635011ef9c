"""Plain, slow versions of the operators' definitions, for small inputs."""

import math
import zlib

import numpy as np
import xxhash


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def vector_links(rows, threshold):
    """rows: (id, label, vector); index pairs that link."""
    def ok(r):
        v = r[2]
        return r[0] is not None and r[1] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    out = []
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i], rows[j]
            if ok(a) and ok(b) and a[1] == b[1] and len(a[2]) == len(b[2]):
                x, y = np.array(a[2], float), np.array(b[2], float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    out.append((i, j))
    return out


def simhash(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


class ContextTree:
    """Context-tree weighting by its recursive definition, one dictionary node at a time."""

    def __init__(self, depth):
        self.depth, self.counts = depth, {}

    def path(self, text):
        data = b"\xff" * self.depth + text.lower() + b"\xff"
        for i in range(self.depth, len(data)):
            context = data[i - self.depth:i]
            for k in range(8):
                yield context, (k, data[i] >> (8 - k)), data[i] >> (7 - k) & 1

    def learn(self, text):
        for context, bits, bit in self.path(text):
            for d in range(self.depth + 1):
                node = self.counts.setdefault((context[self.depth - d:], bits), [0, 0])
                node[bit] += 1

    def build(self):
        children = {}
        for context, bits in self.counts:
            if context:
                children.setdefault((context[1:], bits), []).append((context, bits))
        self.pw, self.alpha = {}, {}
        for node in sorted(self.counts, key=lambda n: -len(n[0])):
            a, b = self.counts[node]
            kt = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
            if len(node[0]) == self.depth:
                self.pw[node], self.alpha[node] = kt, 1.0
            else:
                below = sum(self.pw[c] for c in children[node])
                top = max(kt, below)
                self.pw[node] = top + math.log(math.exp(kt - top) + math.exp(below - top)) - math.log(2)
                self.alpha[node] = math.exp(kt - math.log(2) - self.pw[node])

    def log10(self, text):
        total = 0.0
        for context, bits, bit in self.path(text):
            nodes = []
            for d in range(self.depth + 1):
                node = (context[self.depth - d:], bits)
                if node not in self.counts:
                    break
                nodes.append(node)
            one = 0.5
            for i, node in enumerate(reversed(nodes)):
                a, b = self.counts[node]
                kt = (b + .5) / (a + b + 1)
                one = kt if i == 0 else self.alpha[node] * kt + (1 - self.alpha[node]) * one
            total += math.log10(one if bit else 1 - one)
        return total


def crc_mod(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n
