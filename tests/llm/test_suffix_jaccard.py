"""Suffix sorting, repeated strings and the Jaccard join on small cases."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard, substring_dedup
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_sets, word_hashes
from tidemark.llm.suffix import Files, Induction


def _suffixes(t):
    order = sorted(range(len(t)), key=lambda i: t[i:])
    common = [0]
    for a, b in zip(order, order[1:], strict=False):
        k = 0
        while max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        common.append(k)
    return order, common


@pytest.mark.parametrize("base", [0, 1 << 20])      # recursion to the end, or doubling in memory
def test_induced_order(base, tmp_path):
    rnd = random.Random(3)
    for round_ in range(150):
        t = [rnd.randint(1, rnd.choice([1, 2, 3, 9])) for _ in range(rnd.randint(1, 60))]
        if rnd.random() < 0.5:
            t += t[:rnd.randint(1, len(t))]
        t.append(0)
        order, common = _suffixes(t)
        files = Files(f"file://{tmp_path}") if round_ % 3 == 0 else None      # queues that spill to files at once
        sorter = Induction(1000, files, 64 if files else 1 << 20, base)
        got = sorter.order(np.array(t))
        assert got[0].tolist() == order and got[1].tolist() == common
        for cap in (1, 3, 8):
            again = Induction(cap, files, 64 if files else 1 << 20, base).repeated(np.array(t))
            both = np.zeros(len(t), bool)
            both[order] = [max(common[i], common[i + 1] if i + 1 < len(t) else 0) >= cap for i in range(len(t))]
            assert (again == both).all()
        if files:
            files.close()
    assert not any(tmp_path.iterdir())


def _removed(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("spans", F.lit("clash"))
    rows = substring_dedup.remove_repeats(df, **kw).collect()
    return {r.doc_id: tuple(r)[1:] for r in rows}


def _expected(texts, length):
    out = {}
    for i, (t, (kept, spans)) in enumerate(zip(texts, brute.removed_bytes(texts, length), strict=True)):
        n = len((t or "").encode())
        out[i] = (n, n - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_strings(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.randint(1, 6))) for _ in range(40)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    passage = " ".join(rnd.choice(words) for _ in range(20))
    texts += [t[:rnd.randint(0, len(t))] + passage + t[-5:] for t in texts[:20]] + texts[:3] * 4 + [None, "", "x", "a" * 500, "ab" * 300, "b" * 39]
    for length, leader in ((12, 5), (40, 10), (30, 30)):
        got = _removed(spark, texts, length=length, leader=leader, shard_bytes=4000, queue_bytes=2000, base=16)
        assert got == _expected(texts, length), length


def test_rows_that_repeat_and_keep(spark):
    df = spark.createDataFrame([(1, "0123456789" * 3), (1, "0123456789" * 3), (None, "tail 0123456789"), (2, "nothing")], "doc_id long, text string")
    rows = substring_dedup.remove_repeats(df, length=10, leader=4, keep=True).collect()
    assert sorted((r.n_removed, r.kept.decode()) for r in rows) == [(0, "nothing"), (10, "tail "), (30, ""), (30, "")]
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0


def test_hot_leader_is_divided(spark, monkeypatch):
    rnd = random.Random(11)

    def some(n):
        return "".join(rnd.choice("abcdefgh") for _ in range(n))

    near, exact = some(39), some(60)      # one byte short of a repeat, and a passage that goes
    texts = [some(rnd.randint(0, 50)) + near + some(rnd.randint(0, 50)) for _ in range(150)]
    texts += [some(30) + exact[rnd.randint(0, 25):] + near + some(30) for _ in range(60)] + [near[:k] + some(50) for k in (12, 25, 39)]
    texts += texts[:5] + [t[10:] for t in texts[150:170]] + [None, "", "a" * 90, near, "\u00e9" * 45]
    largest, sort = [], substring_dedup.repeated_windows

    def watched(contents, *args):
        largest.append(contents.groupBy("fp").agg(F.sum(F.length("raw") + 1).alias("b")).agg(F.max("b")).first()[0])
        return sort(contents, *args)

    monkeypatch.setattr(substring_dedup, "repeated_windows", watched)
    for length, leader, bound in ((40, 10, 1500), (40, 10, 100), (40, 39, 100), (40, 10, 1 << 30)):
        got = _removed(spark, texts, length=length, leader=leader, shard_bytes=4000, group_bytes=bound)
        assert got == _expected(texts, length), (leader, bound)
    assert max(largest[0] / 1500, *(x / 100 for x in largest[1:3])) <= 1 and largest[3] > 6000


def test_long_texts_in_pieces(spark, monkeypatch):
    rnd = random.Random(8)
    a = "".join(rnd.choice("abcd") for _ in range(3000))
    texts = [a, a[500:900] + "".join(rnd.choice("efgh") for _ in range(2000)) + a[2000:2600], "q" * 700]
    monkeypatch.setattr(substring_dedup, "PIECE", 1 << 9)
    listed = list(substring_dedup._listed([t.encode() for t in texts], 40, 10))
    windows = sorted((int(d[i]), int(f[i]) + k) for d, f, own, *_ in listed for i in range(len(d)) for k in range(own[i]))
    assert windows == [(d, k) for d, t in enumerate(texts) for k in range(len(t) - 39)]


# --- shingles and the join ---------------------------------------------------------------------

def test_shingle_sets_are_those_of_words():
    rnd = random.Random(2)
    parts = ["a", "B", "É", " ", "\x1c", "word", " ", "\t", "\n", "\x0b", "\r"]
    texts = ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 40))) for _ in range(300)] + [None, "", " \n", "x" * 5000]
    got, want = shingle_sets(texts), [brute.shingles(t) for t in texts]
    seen = {}
    for g, w in zip(got, want, strict=True):
        assert len(g) == len(w) and seen.setdefault(w, g.tobytes()) == g.tobytes()
    for i in range(0, 300, 7):
        for j in range(0, 300, 11):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_long_data_in_pieces(monkeypatch):
    from tidemark.llm import shingles

    data = b"aa  bbb c " * 700 + b"x" * 3000 + b" y"
    whole = word_hashes(data)
    monkeypatch.setattr(shingles, "PIECE", 64)
    parts = word_hashes(data)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all() and len(set(whole[1].tolist())) == 5


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.comp for r in components(df).collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e}
    assert components(df.limit(0)).count() == 0


def _near(rnd, words, text, share):
    return [rnd.choice(words) if rnd.random() < share else w for w in text]


def _corpus(seed):
    """Unrelated texts, pairs and groups of near copies on both sides of the threshold, a passage in most texts, short texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rnd.choice(words) for _ in range(25)]
    texts = []
    for _ in range(60):
        t = [rnd.choice(words) for _ in range(rnd.randint(1, 120))]
        texts.append(t)
        if rnd.random() < 0.6:
            texts += [_near(rnd, words, t, rnd.choice([0.0, 0.01, 0.02, 0.04])) for _ in range(rnd.randint(1, 3))]
    texts += [t[:20] + passage + t[20:] for t in texts[::3]]
    base = [rnd.choice(words) for _ in range(90)]
    texts += [_near(rnd, words, base, rnd.choice([0.01, 0.02, 0.03])) for _ in range(70)]
    texts += [["a", "b"], ["A", "b"], ["a", "b", "c"], ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e", "f"]] * 2
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(9000, None), (9001, ""), (9002, " \t"), (9003, None)]


@pytest.mark.parametrize("rare", [1, 4, 32])
def test_links_and_components(spark, rare, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = _corpus(rare)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cls", F.lit("clash")).repartition(3)
    got = jaccard.link_components(df, rare=rare).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute.jaccard_components(rows))


def test_odd_ids(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "A B c d e f"), (5, "other words stand here now"), (None, "alone in the world tonight"), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_components(df).collect()), key=str)
    assert got == sorted(brute.jaccard_components(rows), key=str)
    assert jaccard.link_components(df.limit(0)).count() == 0


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 500, rng.integers(0, 200)).astype(np.uint64)) for _ in range(30)]
    got = jaccard.shared_counts(sets[:13], sets[13:], columns=64)
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[13:]] for a in sets[:13]]).all()


def _thue_morse(n, a="a", b="b"):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


def test_patterns_that_collide_under_powers_of_a_base(spark):
    """Sums of bytes times powers of any odd base, modulo 2^64, agree for these texts."""
    one, two = _thue_morse(1024), _thue_morse(1024, "b", "a")
    assert word_hashes(one.encode())[1] != word_hashes(two.encode())[1]
    rows = jaccard.link_components(spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 2, 3: 1}
    rnd = random.Random(5)
    tail = "".join(rnd.choice("qwertyuiop ") for _ in range(434))
    texts = [_thue_morse(128, "ab", "cd") + tail, _thue_morse(128, "cd", "ab") + tail]
    rows = substring_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [(r.n_bytes, r.n_removed) for r in rows] == [(690, 434)] * 2
