"""Toxicity by a linear-chain conditional random field over words.

Training (on a bounded sample of labelled documents): words and word
beginnings that labelled toxic documents use and clean ones do not become
labelled tokens; a two-state chain (clean, toxic) with weights for a word and
its beginnings, and for transitions, is fitted to them by gradient ascent on
the conditional likelihood; then the document score is a logistic function of
the marginals' maximum and sum, fitted to the document labels.

Scoring: forward-backward over every word of every document, vectorised over
blocks of the batch (the two-state recursions are fractional linear maps, so
blocks are first reduced to 2x2 matrices and then run side by side).  Marginals
give the document score and the character offsets of toxic spans.

Defined results: null and empty texts have no words and get the score of a
document without toxic words; ids may be null or repeat; without labelled rows
of both kinds every score is 0; further columns are ignored, and nothing but
the text enters a score.
"""

from __future__ import annotations

import math
import re
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

#: Bounds of the training sample: documents of each label, and the longest text used to learn from.
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 20_000
#: Characters of the sample's texts, in all, for each label: what training holds in memory is bounded by it.
SAMPLE_TOTAL = 16 << 20
#: Segments of SEGMENT words that the chain is fitted to at most.
SEGMENTS = 25_000
THRESHOLD = 0.3
FEATURES = 1 << 18
SEGMENT = 64
WORD = re.compile(r"\w+")
STEP = 128
#: Words whose weights a worker remembers (memory only).
REMEMBERED = 200_000


def features(word: str) -> list[int]:
    """Hashed features: the word and its beginnings of 3 to 5 letters."""
    return [zlib.crc32(f"{n}:{word[:n] if n else word}".encode()) % FEATURES for n in (0, 3, 4, 5) if n == 0 or len(word) > n]


def beginnings(word: str) -> list[str]:
    return [word, *(word[:n] + "-" for n in (4, 5) if len(word) > n)]


class Sample:
    """Coded texts: each word is a row of two tables, its hashed features and the numbers of its beginnings."""

    def __init__(self, texts: list[np.ndarray], labels: list[int], features: np.ndarray, begins: np.ndarray):
        self.texts, self.labels, self.features, self.begins = texts, labels, features, begins

    def part(self, which: list[int]) -> Sample:
        return Sample([self.texts[i] for i in which], [self.labels[i] for i in which], self.features, self.begins)


def code_words(texts: Iterator[str], ids: dict[str, int]) -> Iterator[np.ndarray]:
    """Each text as 64-bit hashes of its words; ``ids`` gathers them."""
    for text in texts:
        words = WORD.findall(text.lower())
        for w in set(words) - ids.keys():
            ids[w] = xxhash.xxh3_64_intdigest(w)
        yield np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))


def coded_sample(sample: DataFrame) -> Sample:
    """The sample (i, t, y) in arrays; its words never reach the driver, only their codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch, ids = whole.slice(at, 64), {}
                keys, texts = batch.column(0).to_pylist(), list(code_words(batch.column(1).to_pylist(), ids))
                told = [np.array((features(w) + [FEATURES] * 4)[:4], "<i4").tobytes() for w in ids]
                begun = [np.array(([xxhash.xxh3_64_intdigest(b) for b in beginnings(w)] + [0, 0])[:3], "<u8").tobytes() for w in ids]
                n, m = len(keys), len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys + [None] * m, pa.string()), pa.array(batch.column(2).to_pylist() + [None] * m, pa.int32()),
                     pa.array([t.astype("<u8").tobytes() for t in texts] + [None] * m, pa.binary()), pa.array([None] * n + [i - (1 << 63) for i in ids.values()], pa.int64()),
                     pa.array([None] * n + told, pa.binary()), pa.array([None] * n + begun, pa.binary())],
                    names=["i", "y", "words", "id", "features", "begins"])

    coded = stored(sample.select(F.col("i").cast("string"), "t", F.col("y").cast("int")).mapInArrow(run, "i string, y int, words binary, id long, features binary, begins binary"), "coded-sample")
    words = coded.where("id is not null").dropDuplicates(["id"]).select("id", "features", "begins").orderBy("id").toArrow()  # bounded by the sample
    docs = coded.where("i is not null").select("i", "y", "words").toArrow().to_pylist()
    discard(coded)
    docs.sort(key=lambda r: (zlib.crc32(r["i"].encode()), r["i"]))
    known = words.column("id").to_numpy()
    begins = np.frombuffer(b"".join(words.column("begins").to_pylist()), "<u8").reshape(-1, 3)
    _, numbered = np.unique(np.append(begins.ravel(), 0), return_inverse=True)  # 0 stands for no beginning, and comes first
    texts = [np.searchsorted(known, (np.frombuffer(r["words"], "<u8") ^ np.uint64(1 << 63)).view(np.int64)).astype(np.int32) for r in docs]
    return Sample(texts, [r["y"] for r in docs], np.frombuffer(b"".join(words.column("features").to_pylist()), "<i4").reshape(-1, 4),
                  numbered[:-1].reshape(-1, 3).astype(np.int32))


def toxic_terms(sample: Sample, least_docs: int = 3, least_odds: float = 1.0, errors: float = 2.0) -> np.ndarray:
    """Which beginnings (a flag for each number) toxic documents use more: the log-odds of their document counts for the
    words read, less ``errors`` times their standard error, reach ``least_odds``."""
    many = int(sample.begins.max(initial=0)) + 1
    df, n = np.zeros((2, many), np.int64), [1, 1]
    for words, y in zip(sample.texts, sample.labels, strict=True):
        df[y, np.unique(sample.begins[np.unique(words)])] += 1
        n[y] += len(words)
    c, k = df[1] + 0.5, df[0] + 0.5
    odds = np.log(c) - math.log(n[1]) - np.log(k) + math.log(n[0])
    flags = (df[1] >= least_docs) & (odds - errors * np.sqrt(1 / c + 1 / k) >= least_odds)
    flags[0] = False
    return flags


def without_copies(sample: Sample) -> Sample:
    """One text of each group of copies (most near copies too): texts whose two least five-word hashes agree.

    Words of a text that was copied often would otherwise look like words of many texts.
    """
    seen, kept = set(), []
    turns = np.random.default_rng(3).integers(1, 1 << 63, 5, dtype=np.uint64)
    for i, t in enumerate(sample.texts):
        t = t.astype(np.uint64) + np.uint64(1)
        m = max(1, len(t) - 4)
        runs = np.zeros(m, np.uint64)
        for j in range(5):
            part = t[j:j + m] * turns[j]
            runs[:len(part)] += part
        runs = np.unique(runs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16))
        if (key := (sample.labels[i], *runs[:2].tolist())) not in seen:
            seen.add(key)
            kept.append(i)
    return sample.part(kept)


class Chain:
    """Two-state chain: emission log-odds per word, transition matrix, initial log-odds; then the document rule."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, start: float, rule: tuple[float, float, float] = (0.0, 1.0, 0.0)):
        self.weights, self.moves, self.start, self.rule = weights, moves, start, rule
        self.known: dict[str, float] = {}

    def emissions(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = float(np.clip(self.weights[features(w)].sum(), -30, 30))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def marginals(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(toxic) per word; ``first`` marks the first word of each document."""
        n = len(e)
        if not n:
            return np.zeros(0)
        last = np.append(first[1:], True)
        a, (t00, t01), (t10, t11) = np.exp(e), *self.moves
        one = np.ones(n)
        # odds of the state at t given words up to t: a (t01 + t11 o) / (t00 + t10 o); a document's first word forgets o
        ahead = np.where(first, 0, [[a * t11], [one * t10]]), np.where(first, [[a * math.exp(self.start)], [one]], [[a * t01], [one * t00]])
        # odds of the words after t: (t10 + t11 a' b') / (t00 + t01 a' b'), 1 after a document's last word
        nxt = np.append(a[1:], 1.0)
        back = np.where(last, 0, [[t11 * nxt], [t01 * nxt]]), np.where(last, 1.0, [[t10 * one], [t00 * one]])
        o = _recur(ahead[0][0, 0], ahead[1][0, 0], ahead[0][1, 0], ahead[1][1, 0])
        b = _recur(*(x[::-1] for x in (back[0][0, 0], back[1][0, 0], back[0][1, 0], back[1][1, 0])))[::-1]
        odds = o * b
        return odds / (1 + odds)

    def document_scores(self, p: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        most, total = np.full(docs, 1e-6), np.zeros(docs)
        np.maximum.at(most, doc, np.clip(p, 1e-6, 1 - 1e-6))
        np.add.at(total, doc, np.where(p > 0.05, p, 0.0))
        c, wm, wt = self.rule
        z = c + wm * np.log(most / (1 - most)) + wt * np.log1p(total)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _recur(m11, m12, m21, m22) -> np.ndarray:
    """x_t = (m11 x + m12) / (m21 x + m22) from any start that the first map forgets; blocks side by side."""
    n = len(m11)
    blocks = max(1, -(-n // STEP))
    pad = blocks * STEP - n
    cells = [np.concatenate([m, np.full(pad, v)]).reshape(blocks, STEP).T for m, v in zip((m11, m12, m21, m22), (1.0, 0.0, 0.0, 1.0), strict=True)]
    p, q, r, s = (c[0].copy() for c in cells)
    for t in range(1, STEP):
        a, b, c, d = (x[t] for x in cells)
        p, q, r, s = a * p + b * r, a * q + b * s, c * p + d * r, c * q + d * s
        scale = p + q + r + s
        p, q, r, s = p / scale, q / scale, r / scale, s / scale
    x, starts = 1.0, np.empty(blocks)
    for k in range(blocks):
        starts[k] = x
        x = (p[k] * x + q[k]) / (r[k] * x + s[k])
    out, x = np.empty((STEP, blocks)), starts
    for t in range(STEP):
        a, b, c, d = (y[t] for y in cells)
        x = (a * x + b) / (c * x + d)
        out[t] = x
    return out.T.reshape(-1)[:n]


def fit_chain(sample: Sample, rounds: int = 40, rate: float = 0.5, penalty: float = 1e-3) -> Chain:
    """Chain fitted to token labels derived from document labels."""
    toxic = toxic_terms(sample)[sample.begins].any(axis=1)
    rows, tags = [], []
    for words, y in zip(sample.texts, sample.labels, strict=True):
        t = toxic[words] & (y == 1)
        for at in range(0, len(words), SEGMENT):
            if y == 0 or t[at:at + SEGMENT].any():
                rows.append(words[at:at + SEGMENT])
                tags.append(t[at:at + SEGMENT])
    rows, tags = rows[:SEGMENTS], tags[:SEGMENTS]
    if not rows:  # texts without words
        return Chain(np.zeros(FEATURES), np.ones((2, 2)), -3.0)
    used, x_flat = np.unique(np.concatenate(rows), return_inverse=True)
    width = 4
    feats = np.concatenate([sample.features[used], np.full((1, width), FEATURES)]).astype(np.int64)
    n = len(rows)
    size = np.array([len(r) for r in rows])
    x = np.full((n, SEGMENT), len(used), np.int64)
    y = np.zeros((n, SEGMENT))
    inside = np.arange(SEGMENT) < size[:, None]
    x[inside], y[inside] = x_flat, np.concatenate(tags)
    mask = np.arange(SEGMENT) < size[:, None]
    y_next = y[:, 1:]
    both = mask[:, 1:]
    seen = np.array([[((1 - y[:, :-1]) * (1 - y_next) * both).sum(), ((1 - y[:, :-1]) * y_next * both).sum()],
                     [(y[:, :-1] * (1 - y_next) * both).sum(), (y[:, :-1] * y_next * both).sum()]])
    weights, moves, start = np.zeros(FEATURES + 1), np.zeros((2, 2)), -3.0
    moves[0, 1] = moves[1, 0] = -1.0
    past_w, past_m, past_s = np.full(FEATURES + 1, 1e-8), np.full((2, 2), 1e-8), 1e-8
    for _ in range(rounds):
        per_word = weights[feats].sum(axis=1)
        per_word[-1] = 0
        e = np.clip(per_word[x], -30, 30)
        t = np.exp(moves)
        # forward and backward with unit-sum messages
        f0, f1 = np.empty((SEGMENT, n)), np.empty((SEGMENT, n))
        a0, a1 = np.ones(n), np.exp(e[:, 0] + start)
        f0[0], f1[0] = a0 / (a0 + a1), a1 / (a0 + a1)
        for k in range(1, SEGMENT):
            a0 = f0[k - 1] * t[0, 0] + f1[k - 1] * t[1, 0]
            a1 = (f0[k - 1] * t[0, 1] + f1[k - 1] * t[1, 1]) * np.exp(e[:, k])
            f0[k], f1[k] = a0 / (a0 + a1), a1 / (a0 + a1)
        b0, b1 = np.full(n, 0.5), np.full(n, 0.5)
        p, moved = np.zeros((n, SEGMENT)), np.zeros((2, 2))
        for k in range(SEGMENT - 1, -1, -1):
            live = mask[:, k]
            z = f0[k] * b0 + f1[k] * b1
            p[:, k] = np.where(live, f1[k] * b1 / z, 0)
            if not k:
                break
            g = np.exp(e[:, k])
            pair = np.array([[f0[k - 1] * t[0, 0] * b0, f0[k - 1] * t[0, 1] * g * b1], [f1[k - 1] * t[1, 0] * b0, f1[k - 1] * t[1, 1] * g * b1]])
            moved += (pair / pair.sum(axis=(0, 1)) * live).sum(axis=2)
            n0, n1 = t[0, 0] * b0 + t[0, 1] * g * b1, t[1, 0] * b0 + t[1, 1] * g * b1
            b0, b1 = np.where(live, n0 / (n0 + n1), 0.5), np.where(live, n1 / (n0 + n1), 0.5)
        diff = np.where(mask, y - p, 0)
        by_word = np.bincount(x.ravel(), diff.ravel(), len(feats))
        grad = np.zeros(FEATURES + 1)
        np.add.at(grad, feats, np.repeat(by_word[:, None], width, axis=1))
        grad[-1] = 0
        grad -= penalty * weights
        past_w += grad**2
        weights += rate * grad / np.sqrt(past_w)
        grad_m = seen - moved
        past_m += grad_m**2
        moves += rate * 0.2 * grad_m / np.sqrt(past_m)
        grad_s = float((y[:, 0] - p[:, 0]).sum())
        past_s += grad_s**2
        start += rate * 0.2 * grad_s / math.sqrt(past_s)
    moves -= moves.max()
    return Chain(weights[:FEATURES], np.exp(moves), start)


def fit_rule(chain: Chain, sample: Sample, rounds: int = 300) -> None:
    """Logistic rule from the marginals' maximum and sum to the document label."""
    texts, labels = sample.texts, sample.labels
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.zeros(0, bool)
    weight = np.clip(np.append(chain.weights, 0.0)[sample.features].sum(axis=1), -30, 30)
    p = chain.marginals(weight[np.concatenate(texts)], first)
    most, total = np.full(len(texts), 1e-6), np.zeros(len(texts))
    np.maximum.at(most, doc, np.clip(p, 1e-6, 1 - 1e-6))
    np.add.at(total, doc, np.where(p > 0.05, p, 0.0))
    x = np.stack([np.ones(len(texts)), np.log(most / (1 - most)), np.log1p(total)], axis=1)
    y, w = np.array(labels, float), np.array([-2.0, 0.5, 0.5])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (q * (1 - q) + 1e-6)[:, None]).T @ x + np.diag([1e-3, 1e-2, 1e-2]) * len(texts) * 0.01
        step = np.linalg.solve(h, x.T @ (y - q) - np.array([1e-3, 1e-2, 1e-2]) * len(texts) * 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    chain.rule = tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, sample_total: int = SAMPLE_TOTAL) -> Chain | None:
    """Fit on at most ``sample_rows`` documents per label, chosen by a hash of the id, of at most ``sample_chars`` and ``sample_total`` in all."""
    order = F.md5(F.col(id_col).cast("string"))
    known = labels.where(may_learn).where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("_y"))
    texts = docs.select(id_col, text_col).where(F.length(text_col).between(1, sample_chars))
    sizes = texts.groupBy(id_col).agg(F.max(F.length(text_col)).alias("_n"))
    usable = known.join(sizes, id_col)
    picked = usable.where("_y = 1").orderBy(order, id_col).limit(sample_rows).unionByName(usable.where("_y = 0").orderBy(order, id_col).limit(sample_rows))
    rows, held = [], {0: 0, 1: 0}
    for r in picked.withColumn("_o", order).orderBy("_o", id_col).collect():  # ids, bounded by the sample
        held[r["_y"]] += r["_n"]
        if held[r["_y"]] <= sample_total:
            rows.append((r[id_col], r["_y"]))
    y = {v for _, v in rows}
    if y != {0, 1}:
        unused = {r["_y"] for r in known.select("_y").distinct().collect()} - y
        if unused:
            warnings.warn(f"no text of 1 to {sample_chars} characters has label {sorted(unused)}: every score is 0", stacklevel=2)
        return None
    chosen = docs.sparkSession.createDataFrame(rows, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, y int")
    sample = texts.join(F.broadcast(chosen), id_col).groupBy(F.col(id_col).alias("i")).agg(F.min(text_col).alias("t"), F.max("y").alias("y"))
    sample = without_copies(coded_sample(sample))
    # the document rule is fitted on rows that the chain was not fitted on
    n = range(len(sample.texts))
    chain, rule = fit_chain(sample.part([*n[::2], *n[1::4]])), sample.part([*n[3::4]])
    fit_rule(chain, rule if {0, 1} <= set(rule.labels) else sample)
    return chain


def score_documents(docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text", spans: bool = False,
                    span_at: float = 0.5, batch_words: int = 1 << 18, carry: tuple[str, ...] = (), score_col: str = "score") -> DataFrame:
    """The id, the columns of ``carry`` and a score per document, for whole texts (and spans: start, end, probability, in characters)."""
    head = [id_col, *(c for c in carry if c != id_col)]
    spec = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in head) + f"{score_col} double" + (", spans array<struct<start:int,end:int,p:double>>" if spans else "")
    empty = [*[F.col(f"`{c}`") for c in head], F.lit(0.0).alias(score_col)] + ([F.expr("cast(array() as array<struct<start:int,end:int,p:double>>)").alias("spans")] if spans else [])
    if chain is None:
        return docs.select(*empty)
    sent = docs.sparkSession.sparkContext.broadcast((chain.weights.astype(np.float32), chain.moves, chain.start, chain.rule))  # FEATURES weights
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, moves, start, rule = sent.value
        chain = Chain(weights, moves, start, rule)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                words, sizes, low, begun = [], [], [], at
                while at < batch.num_rows and len(words) < batch_words:
                    text = batch.column(text_at)[at].as_py() or ""
                    lower = text.lower()
                    kept = len(lower) == len(text)  # a few letters become two; then places hold in the text as it is
                    found = WORD.findall(lower) if kept else [w.lower() for w in WORD.findall(text)]
                    low.append((lower if kept else text) if spans else None)
                    words += found
                    sizes.append(len(found))
                    at += 1
                doc = np.repeat(np.arange(len(sizes)), sizes)
                first = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.zeros(0, bool)
                p = chain.marginals(chain.emissions(words), first)
                cols = [*(batch.column(i).slice(begun, len(sizes)) for i in range(len(head))), pa.array(chain.document_scores(p, doc, len(sizes)))]
                if spans:
                    ends = np.cumsum(sizes)
                    cols.append(pa.array([_spans(low[i], p[ends[i] - n:ends[i]], span_at) for i, n in enumerate(sizes)], span_type))
                yield pa.RecordBatch.from_arrays(cols, names=[*head, score_col, "spans"][:len(cols)])

    sent_cols = head if text_col in head else [*head, text_col]
    text_at = sent_cols.index(text_col)
    return docs.select(*[F.col(f"`{c}`") for c in sent_cols]).mapInArrow(run, spec)


def _spans(text: str, p: np.ndarray, least: float) -> list[dict]:
    """Runs of toxic words with their place in the text."""
    if not (p >= least).any():
        return []
    out, open_word = [], -2
    for i, m in enumerate(WORD.finditer(text)):
        if p[i] >= least:
            if open_word == i - 1:
                out[-1] |= {"end": m.end(), "p": max(out[-1]["p"], float(p[i]))}
            else:
                out.append({"start": m.start(), "end": m.end(), "p": float(p[i])})
            open_word = i
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "utf-8")) % 4 == 2


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending spans for every document."""
    scored = score_documents(docs, train(docs, labels, ~held_out()), spans=True)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
