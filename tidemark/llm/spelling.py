"""Spelling variants: words one edit apart, found through k-d trees over letter counts.

Replacing a letter takes one from a letter's count and adds one to another's;
inserting adds one, deleting takes one.  So the near words of a word lie, in the
space of letter counts of one length, within one step up and one step down
(L1 distance two), and for the next length within one step up.

1. Words and their numbers of occurrences are counted over whole texts.
2. For each length a k-d tree over letter counts is fitted to a bounded sample
   of words (``SAMPLE``); its leaves hold about ``LEAF`` words each.  The trees
   decide only how the work is divided: every word is indexed and searched.
3. A word goes to its own leaf, and as a query to all leaves of the three
   lengths whose boxes the range search can't exclude.  A leaf with more than
   twice ``LEAF`` words is divided into blocks, and queries go to each block.
4. A task builds a finer tree over the words of a block, runs the range
   searches of all queries side by side and verifies the order of the letters.
   It returns a number of near words and the best of them for each query, no
   pairs.

Defined results: null and empty texts have no words; a null id counts as empty
text in the typing rule; repeated rows count as often as they stand there; very
long runs are words like others; an empty table, or one without words that
occur twice, gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

LEAST_LETTERS = 7
LEAST_TIMES = 2
#: A word's form occurs at least this many times as often.
TIMES = 10
#: Every how many (document, run) pairs lose a letter.
SLIP_EVERY = 31
#: Words whose letter counts the trees are fitted to at most.
SAMPLE = 1 << 16
#: Words of a leaf, as the sample lets expect.
LEAF = 8192
#: Words of the finest boxes inside a task, and candidates looked at side by side.
BOX = 16
CANDIDATES = 1 << 21
#: Distinct words a task counts before it hands them on.
HELD = 400_000
_FIRST = ord("a")
LETTERS = 26 + 64
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS,
                least_times: int = LEAST_TIMES, slip_every: int = SLIP_EVERY) -> DataFrame:
    """word, n: the runs of letters after the typing rule, with at least ``least_letters`` and ``least_times`` occurrences.

    A run shorter than ``least_letters`` never becomes a word, since the rule only deletes.
    """
    find = _RUN if least_letters == LEAST_LETTERS else re.compile(f"[a-zÀ-ÿ]{{{max(1, least_letters)},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                if not (text := text.as_py()):
                    continue
                seed = zlib.crc32(f"{key.as_py() or ''}:".encode())
                for word, n in Counter(find.findall(text.encode("utf-8").lower().decode("utf-8"))).items():
                    h = zlib.crc32(word.encode("utf-8"), seed)
                    if h % slip_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_letters:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield flush()
                    held.clear()
        yield flush()

    counted = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)


def letter_codes(words: list[str]) -> np.ndarray:
    """Codes 0 to LETTERS - 1 of all letters, one after another."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    return np.where(points < 128, points - _FIRST, points - 0xC0 + 26)


def letter_counts(words: list[str]) -> np.ndarray:
    sizes = np.array([len(w) for w in words], np.int64)
    cells = np.repeat(np.arange(len(words)), sizes) * LETTERS + letter_codes(words)
    return np.bincount(cells, minlength=len(words) * LETTERS).reshape(len(words), LETTERS).astype(np.int32)


class Tree:
    """K-d tree over letter counts: per node the split letter, the largest count to the left and the two children.

    A negative child -1 - k is leaf k.  ``low`` and ``high`` are the split letter's bounds in the node's box.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        self.letter, self.most, self.low, self.high, self.left, self.right = [], [], [], [], [], []
        self.leaves = 0
        big = np.iinfo(np.int32).max
        self.members: list[np.ndarray] = []
        todo = [(np.arange(len(points)), {}, -1, False)]
        while todo:
            mine, bounds, parent, is_right = todo.pop()
            letter, most = self._split(points[mine]) if len(mine) > leaf else (-1, 0)
            if letter < 0:
                at = -1 - self.leaves
                self.leaves += 1
                self.members.append(mine)
            else:
                at = len(self.letter)
                low, high = bounds.get(letter, (0, big))
                for column, value in zip((self.letter, self.most, self.low, self.high, self.left, self.right), (letter, most, low, high, 0, 0), strict=True):
                    column.append(value)
                small = points[mine, letter] <= most
                todo.append((mine[small], bounds | {letter: (low, most)}, at, False))
                todo.append((mine[~small], bounds | {letter: (most + 1, high)}, at, True))
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = at
        self.root = 0 if self.letter else -1
        self.nodes = np.array([self.letter, self.most, self.low, self.high, self.left, self.right], np.int32).reshape(6, -1)
        del self.letter, self.most, self.low, self.high, self.left, self.right

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int]:
        """The letter and count that part the points most evenly; -1 where all are equal."""
        best, found = 0, (-1, 0)
        for most in range(int(points.max(initial=0))):
            inside = (points <= most).sum(axis=0)
            even = np.minimum(inside, len(points) - inside)
            letter = int(even.argmax())
            if even[letter] > best:
                best, found = int(even[letter]), (letter, most)
            elif not even.any():
                break
        return found

    def visit(self, counts: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of all boxes within ``up`` steps up and ``down`` steps down of the queries' counts."""
        query = np.arange(len(counts))
        node = np.full(len(counts), self.root, np.int32)
        ups, downs = np.zeros(len(counts), np.int32), np.zeros(len(counts), np.int32)
        queries, leaves = [], []
        while len(query):
            done = node < 0
            if done.any():
                queries.append(query[done])
                leaves.append(-1 - node[done])
                query, node, ups, downs = query[~done], node[~done], ups[~done], downs[~done]
                if not len(query):
                    break
            letter, most, low, high, left, right = (column[node] for column in self.nodes)
            x = counts[query, letter]
            # the part of the distance that this letter has already
            was_up, was_down = np.maximum(low - x, 0), np.maximum(x - high, 0)
            l_down = downs - was_down + np.maximum(x - most, 0)
            r_up = ups - was_up + np.maximum(most + 1 - x, 0)
            a, b = l_down <= down, r_up <= up
            query, node, ups, downs = (np.concatenate([query[a], query[b]]), np.concatenate([left[a], right[b]]),
                                       np.concatenate([ups[a], r_up[b]]), np.concatenate([l_down[a], downs[b]]))
        if not queries:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(queries), np.concatenate(leaves).astype(np.int64)


#: A query of length L searches L, L + 1 and L - 1: (difference of length, steps up, steps down).
SEARCHES = ((0, 1, 1), (1, 1, 0), (-1, 0, 1))


def fit_trees(words: DataFrame, sample: int = SAMPLE, leaf: int = LEAF) -> tuple[dict[int, Tree], int]:
    """A tree for each length in a sample of at most ``sample`` words, and the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([len(w) for w in names], pa.int32()), pa.array([r.astype("<i4").tobytes() for r in letter_counts(names)], pa.binary())],
                                             names=["length", "counts"])

    total = words.count()
    picked = words.select("word").orderBy(F.xxhash64("word"), "word").limit(sample) if total > sample else words.select("word")
    rows = picked.mapInArrow(run, "length int, counts binary").collect()  # at most ``sample`` rows of fixed width
    by: dict[int, list[bytes]] = {}
    for r in rows:
        by.setdefault(r["length"], []).append(bytes(r["counts"]))
    share = max(1, int(leaf * len(rows) / max(1, total)))
    trees = {length: Tree(np.frombuffer(b"".join(sorted(v)), "<i4").reshape(-1, LETTERS), share) for length, v in by.items()}
    for tree in trees.values():
        tree.members = []
    return trees, total


def _places(trees: dict[int, Tree], words: list[str], searches) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf key) for the given searches; a length without a tree is one leaf."""
    counts, sizes = letter_counts(words), np.array([len(w) for w in words], np.int64)
    rows, keys = [], []
    for length in np.unique(sizes).tolist():
        mine = np.flatnonzero(sizes == length)
        for more, up, down in searches:
            tree = trees.get(length + more)
            q, leaf = tree.visit(counts[mine], up, down) if tree else (np.arange(len(mine)), np.zeros(len(mine), np.int64))
            rows.append(mine[q])
            keys.append((length + more << 20) + leaf)
    return np.concatenate(rows), np.concatenate(keys)


def route(words: DataFrame, trees: dict[int, Tree], leaf: int = LEAF, batch_rows: int = 4096) -> DataFrame:
    """key, block, side, word, n: each word in its own leaf (side 0) and, as a query (side 1), in all leaves it may have near words in."""
    sent = words.sparkSession.sparkContext.broadcast(trees)  # fewer leaves than words in the sample

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_places(sent.value, batch.column(0).to_pylist(), ((0, 0, 0),))[1])], names=["key"])

    sizes = words.select("word").mapInArrow(own, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # leaves beyond twice the expected size: at most as many as the trees have leaves, or lengths beyond the sample
    large = {r["key"]: -(-r["n"] // leaf) for r in sizes.where(F.col("n") > 2 * leaf).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                names = part.column(0).to_pylist()
                row, key = _places(sent.value, names, ((0, 0, 0),))
                blocks = np.array([large.get(k, 1) for k in key.tolist()])
                block = np.array([zlib.crc32(names[r].encode("utf-8")) for r in row.tolist()]) % blocks
                q, q_key = _places(sent.value, names, SEARCHES)
                many = np.array([large.get(k, 1) for k in q_key.tolist()]) if large else np.ones(len(q), np.int64)
                q_block = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                q, q_key = np.repeat(q, many), np.repeat(q_key, many)
                row, side = np.append(row, q), np.append(np.zeros(len(row), np.int32), np.ones(len(q), np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.append(key, q_key)), pa.array(np.append(block, q_block).astype(np.int32)), pa.array(side.astype(np.int32)),
                                                  part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))], names=["key", "block", "side", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, block int, side int, word string, n long")


class Leaf:
    """The words of one length and box, in a finer tree, ready for range searches."""

    def __init__(self, words: list[str], times: list[int]):
        self.length = len(words[0])
        counts = letter_counts(words)
        self.tree = Tree(counts, BOX)
        order = np.concatenate(self.tree.members)
        self.words, self.times = [words[i] for i in order.tolist()], np.array(times)[order]
        sizes = np.array([len(m) for m in self.tree.members])
        self.start, self.size = np.cumsum(sizes) - sizes, sizes
        self.codes, self.packed, self.sums = _forms(self.words, self.length)
        by_word = np.empty(len(order), np.int64)
        by_word[sorted(range(len(order)), key=self.words.__getitem__)] = np.arange(len(order))
        # larger is better: more occurrences, then the smaller word
        self.rank = np.empty(len(order), np.int64)
        self.rank[np.lexsort((-by_word, self.times))] = np.arange(len(order))
        self.by_rank = np.argsort(self.rank)

    def search(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per query (all of one length) the number of near words and the rank of the best, -1 without any."""
        length = len(queries[0])
        found, best = np.zeros(len(queries), np.int64), np.full(len(queries), -1, np.int64)
        up, down = next((u, d) for more, u, d in SEARCHES if length + more == self.length)
        counts = letter_counts(queries)
        codes, packed, sums = _forms(queries, length)
        q, box = self.tree.visit(counts, up, down)
        n = self.size[box]
        ends = np.cumsum(n)
        cuts = np.searchsorted(ends, np.arange(CANDIDATES, int(ends[-1]) if len(ends) else 0, CANDIDATES)).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(q)], strict=True):
            m = n[a:b]
            mine = np.repeat(q[a:b], m)
            other = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m - self.start[box[a:b]], m)
            if length == self.length:
                near = _one_replaced(packed, mine, self.packed, other)
            else:
                d = self.sums[:, other] - sums[:, mine] if length < self.length else sums[:, mine] - self.sums[:, other]
                near = np.flatnonzero((d[0] > 0) & (d[1] == d[0] * d[0]))
                short, long = (codes[mine[near]], self.codes[other[near]]) if length < self.length else (self.codes[other[near]], codes[mine[near]])
                near = near[_one_inserted(short, long)]
            found += np.bincount(mine[near], minlength=len(queries))
            np.maximum.at(best, mine[near], self.rank[other[near]])
        return found, best


def _forms(words: list[str], length: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Letters as rows of bytes, eight letters to an integer, and the sums of the codes and of their squares."""
    codes = (letter_codes(words) + 1).astype(np.uint8).reshape(len(words), length)
    wide = np.zeros((len(words), -(-length // 8) * 8), np.uint8)
    wide[:, :length] = codes
    packed = [np.ascontiguousarray(wide[:, k:k + 8]).view("<u8").ravel() for k in range(0, wide.shape[1], 8)]
    large = codes.astype(np.int64)
    return codes, packed, np.stack([large.sum(axis=1), (large * large).sum(axis=1)])


def _bytes_set(x: np.ndarray) -> np.ndarray:
    """How many of the eight bytes are not zero."""
    x = x | (x >> np.uint64(4))
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    x &= np.uint64(0x0101010101010101)
    return np.bitwise_count(x)


def _one_replaced(a: list[np.ndarray], left: np.ndarray, b: list[np.ndarray], right: np.ndarray) -> np.ndarray:
    """Pairs that differ in exactly one byte."""
    live, seen = None, 0
    for x, y in zip(a, b, strict=True):
        found = _bytes_set(x[left] ^ y[right]) + seen
        keep = np.flatnonzero(found <= 1)
        live, seen = (keep if live is None else live[keep]), found[keep]
        left, right = left[keep], right[keep]
    return live[seen == 1]


def _one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows in which the longer word is the shorter one with one letter more."""
    n = short.shape[1]
    ahead = (short == long[:, :n]).cumprod(axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    behind = (short == long[:, 1:])[:, ::-1].cumprod(axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    return ahead + behind >= n


def near_words(words: DataFrame, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """word, n_near, best_n, best: for every word (a stored table of word, n) with near words."""
    trees, total = fit_trees(words, sample, leaf)
    tasks = max(1, 2 * total // leaf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, times, ready = None, [], [], None
        for batch in batches:
            key, block, side = (batch.column(i).to_numpy() for i in range(3))
            new = np.flatnonzero((np.diff(key) != 0) | (np.diff(block) != 0) | (np.diff(side) != 0)) + 1
            out = [[], [], [], []]
            for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
                here = (int(key[a]), int(block[a]))
                if here != at:
                    at, names, times, ready = here, [], [], None
                words = batch.column(3).slice(a, b - a).to_pylist()
                if side[a] == 0:  # a block's words come before its queries
                    names += words
                    times += batch.column(4).slice(a, b - a).to_pylist()
                    continue
                if not names:
                    continue
                ready = ready or Leaf(names, times)
                by: dict[int, list[str]] = {}
                for w in words:
                    by.setdefault(len(w), []).append(w)
                for group in by.values():
                    found, best = ready.search(group)
                    for i in np.flatnonzero(found).tolist():
                        k = ready.by_rank[best[i]]
                        for column, value in zip(out, (group[i], int(found[i]), int(ready.times[k]), ready.words[k]), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                             names=["word", "n_near", "best_n", "best"])

    routed = route(words, trees, leaf).repartition(tasks, "key", "block").sortWithinPartitions("key", "block", "side")
    found = routed.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best")))


def group_variants(words: DataFrame, times: int = TIMES, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of word, n.

    A form occurs ``times`` as often as the word, so chains are short; roots are followed by doubling the step.
    """
    words = stored(words, "words")
    near = near_words(words, sample, leaf)
    is_form = F.col("best_n") >= times * F.col("n")
    formed = stored(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
                                                           F.when(is_form, F.col("best_n")).alias("form_n")), "word-forms")
    roots = stored(formed.where("form is not null").select("word", F.col("form").alias("root")), "word-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        discard(roots)
        roots = further.select("word", "root")
        roots.stored_path = further.stored_path
        if further.where("moved").isEmpty():
            break
    discard(words)
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variants of all words of whole texts."""
    return group_variants(count_words(docs))
