"""Preference formatting, sharding, block naming and mixing on small cases."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import block_naming, mixing, preference, sharding

DOCS = "doc_id long, text string, source string, size long, rank int, shard int, _p int, comp long"


def docs(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, s, -1, -1, -1, -1, -1) for d, t, s in rows], DOCS)


# --- preference formatting -------------------------------------------------------

def test_common_prefix_is_the_prompt(spark):
    t = "pair_id long, pos long, role string, text string"
    c = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "ok"), (2, 0, "user", "same"), (3, 0, "user", "a"), (None, 0, "user", "n")], t)
    r = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (2, 0, "user", "same"), (3, 0, "assistant", "a"), (4, 0, "assistant", "alone")], t)
    rows = preference.preference_turns(c, r)
    got = {r.pair_id: r for r in preference.assemble(rows).collect()}
    assert got[1].prompt == "<|im_start|>user\nhi<|im_end|>\n"
    assert got[1].chosen == "<|im_start|>assistant\nyes<|im_end|>\n<|im_start|>user\nok<|im_end|>\n"
    assert [got[1].chosen[s.start:s.start + s.length] for s in got[1].chosen_train] == ["yes<|im_end|>\n"]
    assert [got[1].rejected[s.start:s.start + s.length] for s in got[1].rejected_train] == ["no<|im_end|>\n"]
    assert (got[2].prompt, got[2].chosen, got[2].rejected) == ("<|im_start|>user\nsame<|im_end|>\n", "", "")
    assert got[3].prompt == "" and got[3].chosen_train == [] and len(got[3].rejected_train) == 1
    assert got[4].chosen == "" and got[4].rejected.endswith("alone<|im_end|>\n") and got[None].chosen.endswith("n<|im_end|>\n")
    assert preference.preference_turns(c.limit(0), r.limit(0)).count() == 0


def test_turn_rows_with_gaps_repeats_and_nulls(spark):
    rows = [(7, 5, "user", "a"), (7, 5, "user", "a"), (7, 9, "assistant", None), (7, None, None, "z"), (7, 5, "assistant", "b"), (None, 1, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("clash"))
    got = {(r.conv_id, r.pos): (r.role, r.text) for r in preference.numbered_turns(df).collect()}
    assert got == {(7, 0): ("assistant", "b"), (7, 1): ("user", "a"), (7, 2): ("assistant", ""), (7, 3): ("", "z"), (None, 0): ("user", "q")}


# --- sharding ----------------------------------------------------------------------

def test_hypergeometric_draws():
    rng = np.random.default_rng(1)
    for good, bad, n in ((30, 70, 20), (10**9, 3 * 10**9, 40_000)):      # numpy's own draw, and the one beyond its range
        x = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(4000)])
        p, total = good / (good + bad), good + bad
        mean, var = n * p, n * p * (1 - p) * (total - n) / (total - 1)
        assert abs(x.mean() - mean) < 5 * math.sqrt(var / 4000) and abs(x.var() / var - 1) < 0.15
    assert sharding.hypergeometric(rng, 0, 5, 3) == 0 and sharding.hypergeometric(rng, 5, 0, 3) == 3
    m = sharding.communication_matrix([5, 0, 17, 100, 3], 4, 3)
    assert m.sum(axis=1).tolist() == [5, 0, 17, 100, 3] and sorted(m.sum(axis=0).tolist()) == [31, 31, 31, 32] and m.min() >= 0


def test_every_shard_is_as_likely(spark):
    d = docs(spark, [(i, f"t{i % 7}", "s") for i in range(160)])
    seen = Counter()
    for seed in range(6):
        rows = sharding.shard_documents(d, seed=seed, partitions=8).collect()
        assert Counter(r.shard for r in rows) == {s: 10 for s in range(16)}
        seen.update((r.doc_id, r.shard) for r in rows)
    assert max(seen.values()) <= 5 and len({s for i, s in seen if i == 3}) > 1
    again = sorted(tuple(r) for r in sharding.shard_documents(d, seed=5, partitions=8).collect())
    assert again == sorted(tuple(r) for r in sharding.shard_documents(d.repartition(7), seed=5, partitions=8).collect())


def test_sharding_of_odd_rows(spark):
    d = docs(spark, [(None, None, None)] * 3 + [(1, "", "s"), (1, "", "s"), (2, "x" * 100_000, "s")])
    rows = sharding.shard_documents(d).collect()
    assert sorted(r.size for r in rows) == [1, 1, 1, 1, 1, 100_001] and len({r.shard for r in rows}) == 6 and {r.slot for r in rows} == {0}
    assert sharding.shard_documents(d.limit(0)).count() == 0


# --- block naming ------------------------------------------------------------------

def _duplicates(rows):
    groups = {}
    for d, t, _ in rows:
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        groups.setdefault(key, []).append(d)
    return sorted(((d, max((x for x in g if x is not None), default=None), len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for d in g), key=str)


def test_block_names_with_colliding_hashes(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("aAbÉ") for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    texts += [t.swapcase() if i % 3 else t for i, t in enumerate(texts)] + ["ab" * 300, "ab" * 299 + "aB", "ab" * 299 + "aa", None, None, ""]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    # hashes of a few bits only: names then rest on the ranks among colliding blocks
    for mask in (-1, 0xF00, 0x700):
        got = block_naming.exact_duplicates(docs(spark, rows), block_bytes=4, rank_bits=8, hash_mask=mask).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == _duplicates(rows)
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_block_naming_of_odd_rows(spark):
    rows = [(None, "x", "s"), (None, "X", "s"), (4, "y", "s"), (4, "y", "s"), (5, "long " * 50_000, "s"), (6, "LONG " * 50_000, "s")]
    got = block_naming.exact_duplicates(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == _duplicates(rows)
    assert Counter((r.keep_id, r.kept) for r in got) == {(None, True): 1, (None, False): 1, (4, True): 1, (4, False): 1, (6, True): 1, (6, False): 1}
    assert block_naming.exact_duplicates(docs(spark, rows).limit(0)).count() == 0


# --- mixing -------------------------------------------------------------------------

def _targets(sizes):
    """Shares by weight, the excess of full sources shared again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] >= 3 * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_and_words_taken(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60)), rnd.choice(["a", "b", "b", "b", "c", "d", None, "é", "B"])) for i in range(900)]
    rows += [(1000, None, "only-null"), (1001, " \t\n", "blank"), (5, "again w", "b"), (5, "again w", "b")]
    got = mixing.mix(docs(spark, rows)).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = _targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 61 for s in sizes)
    again = mixing.mix(docs(spark, rows).repartition(5)).collect()
    assert sum(r.taken for r in again) == sum(r.taken for r in got)
    assert mixing.mix(docs(spark, rows).limit(0)).count() == 0
