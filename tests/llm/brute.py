"""Plain single-machine versions of the llm operators, for tests."""

import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def jaccard_components(docs):
    """[(id, text)] -> [(id, n, component)], by comparing every pair that shares a shingle."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    seen = defaultdict(list)
    for i, s in enumerate(sets):
        for other, n in Counter(j for x in s for j in seen[x]).items():
            if 100 * n >= 75 * (len(s) + len(sets[other]) - n):
                parent[root(i)] = root(other)
        for x in s:
            seen[x].append(i)
    low = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        if d is not None:
            low[r] = min(d, low.get(r, d))
    return [(d, len(s), d if not s else low.get(root(i))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def removed_bytes(texts, length):
    """Per text: (bytes, spans) after removing every byte of a repeated string of ``length`` bytes."""
    raws = [(t or "").encode() for t in texts]
    where = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if where[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((kept, spans))
    return out


def spelled_words(docs):
    """{word: n} of runs of letters after the typing rule, at least 7 letters and twice."""
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def spelling_forms(words):
    """(word, form, root, n, n_near, form_n) by deleting and replacing at every place."""
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1:]].add(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w] |= holes[w[:i] + "\0" + w[i + 1:]] - {w}
            if (short := w[:i] + w[i + 1:]) in words:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None
