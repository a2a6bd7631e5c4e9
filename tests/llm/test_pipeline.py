"""The pipeline's stages against plain versions, on a small corpus of its own."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tidemark.llm import mixing, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6))) for _ in range(500)]
    bad = ["grimly", "grimness", "grimmest", "fouler", "foulest"]
    rows, labels = [], []
    for i in range(420):
        t = [rnd.choice(words) for _ in range(rnd.randint(4, 90))]
        if i % 7 == 0:
            for _ in range(3):
                t.insert(rnd.randint(0, len(t)), rnd.choice(bad))
        labels.append((i, 1, int(i % 7 == 0)))
        rows.append((i, " ".join(t), "en", f"src{i % 4}", 0))
    for i in range(60):      # copies, copies in other case, near copies of clean documents
        source = rows[rnd.choice([k for k in range(420) if k % 7])]
        t = source[1] if i % 3 == 0 else source[1].upper() if i % 3 == 1 else source[1] + " tail"
        rows.append((1000 + i, t, "en", source[3], 0))
    rows += [(2000, None, None, None, None), (2001, "", "en", "src1", 0), (None, "a row without an id", "en", "src2", 0), (7, rows[8][1], "en", "src1", 0)]
    rows += [rows[9]] * 2
    path = tmp_path_factory.mktemp("corpus")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def _run(spark, df, tmp_path, name):
    df.write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("copies", F.lit(7)).withColumn("score", F.lit("clash"))
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing to target weights", "best-two-fit packing"]
    at = [docs]
    for name, stage in cp.STAGES:
        at.append(_run(spark, stage(spark, at[-1], folder), tmp_path, name))
        if name != cp.STAGES[-1][0]:
            assert at[-1].columns == docs.columns and at[-1].schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    rows = [[tuple(r) for r in d.collect()] for d in at]

    # toxicity: the same chain, word by word
    chain = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), ~toxicity.held_out())

    def score(text):
        w = toxicity.WORD.findall((text or "").lower())
        p = chain.marginals(chain.emissions(w), np.arange(len(w)) == 0)
        return chain.document_scores(p, np.zeros(len(w), int), 1)[0]

    assert Counter(rows[1]) == Counter(r for r in rows[0] if score(r[1]) < toxicity.THRESHOLD)
    assert sum(r[0] is not None and r[0] < 420 and r[0] % 7 == 0 for r in rows[1]) <= 2
    assert sum(r[0] is not None and r[0] < 420 and r[0] % 7 > 0 for r in rows[1]) >= 355

    # exact dedup: one row a text, the one with the largest id
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    best = {}
    for r in rows[1]:
        key = low(r[1])
        best[key] = max(best.get(key, -2), -1 if r[0] is None else r[0])
    assert Counter((low(r[1]), -1 if r[0] is None else r[0]) for r in rows[2]) == Counter(best.items())

    # near copies: one row a component, the one with the smallest id; texts without words stay
    comps = brute.jaccard_components([(n, r[1]) for n, r in enumerate(rows[2])])
    groups = defaultdict(list)
    for (n, size, comp), r in zip(comps, rows[2], strict=True):
        groups[comp if size else ("empty", n)].append((r[0] is not None, r[0] or 0, r))
    assert Counter(rows[3]) == Counter(min(g)[2] for g in groups.values()) and len(rows[3]) < len(rows[2])

    # mixing: whole copies of kept rows, in the numbers the operator takes
    taken = {(r.doc_id, r.source): r.copies for r in mixing.mix(at[3]).collect()}
    assert {(r[0], r[3]): n for r, n in Counter(rows[4]).items()} == {k: n for k, n in taken.items() if n}

    # packing: all of it
    assert {r[0] for r in rows[5]} == {r[0] for r in rows[4]}
    assert sum(r.piece == 0 for r in at[5].collect()) == len(rows[4])


def test_run(spark, folder):
    out = cp.run(spark, folder)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns) and out.count() > 100


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_rows_that_differ_in_places_of_nulls(spark, folder, tmp_path):
    """Nulls, names that the stages use themselves, arrays: no row is taken for another one."""
    rows = [(None, None, "hello", "a", 1, "x", [None, "p"]), (None, "hello", None, "a", 1, "x", [None, "p"]), (None, "hello b", None, "a", None, "x", ["p", None]),
            (None, "hello b", "a", None, None, "x", ["p", None]), (5, "hello five", "en", "a", 1, None, None), (5, "hello six", "en", "a", 1, None, [])]
    docs = _run(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _key1 long, _toxicity string, _Times array<string>"), tmp_path, "docs")
    assert Counter(map(str, cp.without_copies(spark, docs, folder).collect())) <= Counter(map(str, docs.collect()))
    assert sorted(r.text or "" for r in cp.without_copies(spark, docs, folder).collect()) == ["", "hello", "hello b", "hello five", "hello six"]
    for _, stage in cp.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        if stage is not cp.without_copies:
            assert {str(r) for r in kept.collect()} <= {str(r) for r in docs.collect()}
    keyed, key = cp._keyed(docs)
    assert key == ("__key1", "_key2") and keyed.select(*key).distinct().count() == 6
    assert cp.without_toxic(spark, docs, folder).count() == 6
