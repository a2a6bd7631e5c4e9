"""Induced sorting of suffixes with common-prefix values, through disk-backed queues.

A suffix is S if it is smaller than the next one, else L; a star is an S
suffix after an L one.  Sorted stars give all L suffixes in one ascending
pass and those all S suffixes in one descending pass: each suffix that leaves
the priority queue puts its predecessor in, keyed by the predecessor's first
symbol.  As tuples leave in order, those of one symbol stay in order of
arrival, so the queue is one first-in-first-out run per symbol; runs beyond the
memory limit go to files.  A tuple carries its common-prefix value with the one
before it: one more than the least value met since that symbol's last tuple.

Stars are sorted by naming the substrings between them and sorting the string
of names the same way, recursively, until it is small enough for memory.
Values are only needed up to ``cap``.
"""

from __future__ import annotations

import io
import uuid
from collections import deque

import numpy as np

FAR = np.int32(1 << 30)


class Queues:
    """First-in-first-out runs of (position, value) by key; the largest go to files when memory is short."""

    def __init__(self, files=None, memory_bytes: int = 64 << 20):
        self.files, self.limit, self.held = files, memory_bytes, 0
        self.runs: dict[int, deque] = {}
        self.size: dict[int, int] = {}

    def push(self, key: int, positions: np.ndarray, values: np.ndarray) -> None:
        self.runs.setdefault(key, deque()).append((positions, values))
        grown = positions.nbytes + values.nbytes
        self.size[key] = self.size.get(key, 0) + grown
        self.held += grown
        while self.files is not None and self.held > self.limit:
            key = max(self.size, key=self.size.get)
            run, plain = self.runs[key], []
            while run and not isinstance(run[-1], str):
                plain.append(run.pop())
            plain.reverse()
            run.append(self.files.put(*(np.concatenate([x[i] for x in plain]) for i in (0, 1))))
            self.held -= self.size.pop(key)

    def _joined(self, parts: list, key: int) -> tuple[np.ndarray, np.ndarray]:
        freed = sum(p.nbytes + v.nbytes for p, v in parts)
        self.size[key] -= freed
        self.held -= freed
        return parts[0] if len(parts) == 1 else tuple(np.concatenate([x[i] for x in parts]) for i in (0, 1))

    def pop(self, key: int):
        """The first tuples of a key (all that are in memory, or one file's), or None."""
        run = self.runs.get(key)
        if not run:
            return None
        if isinstance(run[0], str):
            return self.files.take(run.popleft())
        parts = []
        while run and not isinstance(run[0], str):
            parts.append(run.popleft())
        return self._joined(parts, key)

    def pop_last(self, key: int):
        """The last tuples of a key, in order of arrival, or None."""
        run = self.runs.get(key)
        if not run:
            return None
        if isinstance(run[-1], str):
            return self.files.take(run.pop())
        parts = []
        while run and not isinstance(run[-1], str):
            parts.append(run.pop())
        return self._joined(parts[::-1], key)


class Files:
    """Spill files of one task in a shared folder; any file system that Arrow reaches."""

    def __init__(self, folder: str):
        from pyarrow.fs import FileSystem

        self.fs, base = FileSystem.from_uri(folder)
        self.base = f"{base}/{uuid.uuid4().hex}"
        self.made = self.count = 0

    def put(self, *arrays: np.ndarray) -> str:
        if not self.made:
            self.fs.create_dir(self.base, recursive=True)
            self.made = 1
        path = f"{self.base}/{self.count}"
        self.count += 1
        out = io.BytesIO()
        for a in arrays:
            np.save(out, a)
        with self.fs.open_output_stream(path, compression=None) as f:
            f.write(out.getvalue())
        return path

    def take(self, path: str) -> tuple[np.ndarray, ...]:
        with self.fs.open_input_stream(path, compression=None) as f:
            data = io.BytesIO(f.read())
        self.fs.delete_file(path)
        return np.load(data), np.load(data)

    def close(self) -> None:
        if self.made:
            self.fs.delete_dir(self.base)


def range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first..last]) per query, FAR where the range is empty."""
    out = np.full(len(first), FAR, values.dtype)
    width = last - first + 1
    level = np.where(width > 0, np.frexp(np.maximum(width, 1).astype(np.float64))[1] - 1, -1)
    table, step = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[first[at]], table[last[at] - step + 1])
        table = np.minimum(table[:-step], table[step:])
        step *= 2
    return out


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is S; the last symbol is the unique smallest."""
    n = len(text)
    up = np.empty(n, np.int8)
    up[-1] = 1
    up[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1]).astype(np.int8)
    nxt = np.minimum.accumulate(np.where(up != 0, np.arange(n), n - 1)[::-1])[::-1]
    return up[nxt] > 0


def run_lengths(text: np.ndarray, at: np.ndarray, cap: int) -> np.ndarray:
    """Length of the run of one symbol from each position, up to ``cap``."""
    out = np.zeros(len(at), np.int32)
    for i, p in enumerate(at):
        part = text[p:p + cap]
        other = np.flatnonzero(part != part[0])
        out[i] = other[0] if len(other) else len(part)
    return out


def name_substrings(text: np.ndarray, is_s: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """Dense ranks of the substrings from star to star (inclusive), in text order."""
    m = len(stars)
    length = np.append(np.diff(stars), 0) + 1
    code = text.astype(np.int64) * 2 + is_s + 1
    bits = int(code.max()).bit_length()
    per = max(1, 62 // bits)
    rank, active, done = np.zeros(m, np.int64), np.arange(m), 0
    while len(active):
        word = np.zeros(len(active), np.int64)
        for t in range(per):
            inside = length[active] > done + t
            word = (word << bits) | np.where(inside, code[np.minimum(stars[active] + done + t, len(text) - 1)], 0)
        order = np.argsort(word) if not done else np.lexsort((word, rank[active]))
        active, word, old = active[order], word[order], rank[active[order]]
        at = np.arange(len(active))
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))  # start of the old group
        new = np.maximum.accumulate(np.where(np.append(True, (old[1:] != old[:-1]) | (word[1:] != word[:-1])), at, 0))
        rank[active] = old + new - group
        done += per
        sizes = np.bincount(new, minlength=len(active))[new]
        active = active[(sizes > 1) & (length[active] > done)]
    # members of one group keep one rank; ranks become dense
    return np.unique(rank, return_inverse=True)[1]


def by_doubling(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a string in memory, and common prefixes in symbols, exact up to ``cap``."""
    n = len(names)
    order = np.argsort(names)
    rank, at = np.empty(n, np.int64), np.arange(n)
    head = np.append(True, names[order][1:] != names[order][:-1])
    rank[order] = np.maximum.accumulate(np.where(head, at, 0))  # a group's rank is where it starts
    ranks, k = [rank.astype(np.int32)], 1
    alone = head & np.append(head[1:], True)
    open_ = np.flatnonzero(~alone)  # places in the order that are not settled
    while len(open_) and k < min(cap, n):
        p = order[open_]
        behind = np.where(p + k < n, rank[np.minimum(p + k, n - 1)] + 1, 0)
        key = rank[p] * (n + 1) + behind
        by = np.argsort(key)
        p, key = p[by], key[by]
        order[open_] = p
        new = np.append(True, key[1:] != key[:-1])
        rank[p] = np.maximum.accumulate(np.where(new, open_, 0))
        ranks.append(rank.astype(np.int32))
        open_ = open_[~(new & np.append(new[1:], True))]
        k *= 2
    common = np.zeros(n, np.int32)
    a, b = order[1:], order[:-1]
    length = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step, r = 1 << level, ranks[level]
        for _ in range(2 if level == len(ranks) - 1 else 1):
            x, y = a + length, b + length
            ok = (x < n) & (y < n)
            same = ok & (r[np.minimum(x, n - 1)] == r[np.minimum(y, n - 1)])
            length += np.where(same, step, 0)
    common[1:] = np.minimum(length, cap)
    return order, common


class Induction:
    """Sorts the suffixes of one text; see the module's head."""

    def __init__(self, cap: int, files=None, memory_bytes: int = 64 << 20, base: int = 1 << 22):
        self.cap, self.files, self.memory, self.base = cap, files, memory_bytes, base

    def stars(self, text: np.ndarray, is_s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Star positions in suffix order, and their common prefixes in symbols of ``text``."""
        star = is_s.copy()
        star[0] = False
        star[1:] &= ~is_s[:-1]
        at = np.flatnonzero(star)
        names = name_substrings(text, is_s, at)
        if names.max(initial=0) == len(at) - 1:
            order, common = np.argsort(names), np.zeros(len(at), np.int64)
        elif len(names) <= self.base:
            order, common = by_doubling(names, self.cap)
        else:
            order, common = self.order(names)
        # whole names in common, then symbol by symbol into the first that differ
        ends = np.append(at, len(text))
        x, y = at[order], np.append(0, at[order][:-1])
        length = np.minimum(ends[np.minimum(order + common, len(at))] - x, self.cap).astype(np.int32)
        length[0] = 0
        open_ = np.flatnonzero(length < self.cap)
        open_ = open_[open_ > 0]
        while len(open_):
            p, q = x[open_] + length[open_], y[open_] + length[open_]
            inside = (p < len(text)) & (q < len(text))
            same = inside & (text[np.minimum(p, len(text) - 1)] == text[np.minimum(q, len(text) - 1)])
            open_ = open_[same]
            length[open_] += 1
            open_ = open_[length[open_] < self.cap]
        return x, length

    def _step(self, queue: Queues, since: np.ndarray, positions, values, text, is_s, want_s: bool) -> None:
        """Put the predecessors of a batch of suffixes, which leave in this order, into the queue."""
        before = np.maximum(positions - 1, 0)
        k = np.flatnonzero((positions > 0) & (is_s[before] == want_s))
        least = values.min()
        if not len(k):
            np.minimum(since, least, out=since)
            return
        order = np.argsort(text[before[k]], kind="stable")
        k = k[order]
        target = text[before[k]]
        head = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        start = np.append(0, k[:-1] + 1)
        start[head] = 0
        met = range_min(values, start, k)
        keys = target[head].astype(np.int64)
        met[head] = np.minimum(met[head], since[keys])
        tail = np.append(head[1:], len(k)) - 1
        np.minimum(since, least, out=since)
        since[keys] = range_min(values, k[tail] + 1, np.full(len(tail), len(values) - 1))
        out, value = before[k], np.minimum(met + 1, self.cap).astype(np.int32)
        for key, a, b in zip(keys.tolist(), head.tolist(), (tail + 1).tolist(), strict=True):
            queue.push(key, out[a:b], value[a:b])

    def _passes(self, text: np.ndarray):
        """Yields (symbol, kind, positions, values) in the order of the passes: L ascending, then S descending."""
        is_s = suffix_types(text)
        stars, common = self.stars(text, is_s)
        symbols = int(text.max()) + 1
        present = np.flatnonzero(np.bincount(text, minlength=symbols)).tolist()
        cuts = np.searchsorted(text[stars], np.arange(symbols + 1))
        queue, kept, since = Queues(self.files, self.memory), Queues(self.files, self.memory), np.full(symbols, -1, np.int32)
        last_l: dict[int, int] = {}
        for c in present:
            while (batch := queue.pop(c)) is not None:
                yield c, "L", *batch
                kept.push(c, *batch)
                last_l[c] = int(batch[0][-1])
                self._step(queue, since, *batch, text, is_s, False)
            mine = stars[cuts[c]:cuts[c + 1]]
            if len(mine):
                values = common[cuts[c]:cuts[c + 1]].copy()
                values[0] = run_lengths(text, np.array([last_l[c], mine[0]]), self.cap).min() if c in last_l else 0
                self._step(queue, since, mine, values, text, is_s, False)
        queue, since = Queues(self.files, self.memory), np.full(symbols, -1, np.int32)
        queue.push(int(text[-1]), np.array([len(text) - 1]), np.zeros(1, np.int32))
        for c in reversed(present):
            last_s = None
            while (batch := queue.pop(c)) is not None:
                yield c, "S", *batch
                last_s = int(batch[0][-1])
                self._step(queue, since, *batch, text, is_s, True)
            carry = 0
            if last_s is not None and c in last_l:
                carry = int(run_lengths(text, np.array([last_s, last_l[c]]), self.cap).min())
                yield c, "seam", np.array([last_l[c], last_s]), np.array([0, carry], np.int32)
            while (batch := kept.pop_last(c)) is not None:
                positions, values = batch[0][::-1], np.append(carry, batch[1][:0:-1]).astype(np.int32)
                carry = int(batch[1][0])
                self._step(queue, since, positions, values, text, is_s, True)

    def repeated(self, text: np.ndarray) -> np.ndarray:
        """True where another suffix shares the first ``cap`` symbols."""
        out, before = np.zeros(len(text), bool), None
        for c, kind, positions, values in self._passes(text):
            long = np.flatnonzero(values >= self.cap)
            if len(long):
                out[positions[long]] = True
                out[positions[long[long > 0] - 1]] = True
                if long[0] == 0 and before is not None and before[:2] == (c, kind):
                    out[before[2]] = True
            before = (c, kind, int(positions[-1]))
        return out

    def order(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array and common prefixes (up to ``cap``) of a text with a unique smallest last symbol."""
        lows, highs, seams = {}, {}, {}
        for c, kind, positions, values in self._passes(text):
            if kind == "seam":
                seams[c] = int(values[1])
            else:
                (lows if kind == "L" else highs).setdefault(c, []).append((positions, values))
        order, common = [], []
        for c in sorted({*lows, *highs}):
            if c in lows:
                order += [p for p, _ in lows[c]]
                common += [v for _, v in lows[c]]
            if c in highs:
                p, v = (np.concatenate([x[i] for x in highs[c]])[::-1] for i in (0, 1))
                order.append(p)
                common.append(np.append(seams.get(c, 0), v[:-1]))
        return np.concatenate(order), np.concatenate(common).astype(np.int64)
