"""SentencePiece coding, spelling variants and whitening against plain versions."""

import hashlib
import math
import random

import brute
import numpy as np
import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from tidemark.llm import piece_coding, spelling, whitening
from tidemark.llm.queries import REGISTRY

# --- pieces ------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, n_tokens string"


def _processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_coding.model_path())


def _digests(texts):
    model, out = _processor(), []
    for t in texts:
        ids = model.encode(t or "", add_bos=True, add_eos=True)
        out.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block_chars", [1, 300, 1 << 24])
def test_coding_is_the_library(spark, block_chars):
    rnd = random.Random(3)
    parts = ["word", "Été", " ", "  ", "\n", "\t", " ", "▁", "it's", "12", "!?", "日本", "<s>", "</s>", "<0x0A>", "\x00", "é", "🙂", "ﬁ", "x" * 40]
    texts = ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 25))) for _ in range(150)]
    texts += [None, "", " ", "   ", "▁", "a", "a ", "long words " * 30_000, "x" * 200_000, "a", "a"]
    ids = [None if i % 50 == 7 else i // 2 for i in range(len(texts))]
    rows = piece_coding.encode_documents(spark.createDataFrame([(i, t, "other") for i, t in zip(ids, texts, strict=True)], DOCS).repartition(3), block_chars=block_chars,
                                         part_chars=100_000, with_ids=True, with_text=True).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), (r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in rows) == \
        sorted(((i is None, i or 0), d) for i, d in zip(ids, _digests(texts), strict=True))
    for r in rows:
        assert hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() == r.ids_sha256 and hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256


def test_coding_of_nothing_and_carried_columns(spark):
    assert piece_coding.encode_documents(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(1, "a b", 5)], "doc_id long, text string, kind int")
    assert piece_coding.encode_documents(docs, carry=("kind",)).select("doc_id", "kind", "n_tokens").collect() == [(1, 5, 4)]


def test_documents_that_differ_between_readings(spark):
    def noise(batches):
        import os

        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([os.urandom(8).hex() for _ in range(b.num_rows)])], names=["doc_id", "text"])

    with pytest.raises(Exception, match="store them first"):
        piece_coding.encode_documents(spark.range(40).mapInArrow(noise, "doc_id long, text string")).collect()


def test_a_block_holds_each_chunk_once():
    coder, block = piece_coding.Segmenter(piece_coding.model_path()), piece_coding.Block()
    for t in ("to be or not to be", "", "be to  be"):
        block.add(t, coder.chunks(t))
    rows, (sizes, numbers) = block.parts(4), block.codes()
    assert list(block.seen) == ["to", "be", "or", "not", "▁be"]
    assert sorted(n for _, part, _, _ in rows for n in piece_coding.unsqueeze(part)) == [0, 1, 2, 3, 4]
    assert piece_coding.unsqueeze(sizes).tolist() == [6, 0, 3] and len(piece_coding.unsqueeze(numbers)) == 9


def test_op11(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in REGISTRY["op11_distinct_chunk_coding"](spark, SF_SMALL).collect()}
    assert got == {d.doc_id: x for d, x in zip(docs, _digests([d.text for d in docs]), strict=True)}


# --- spelling ----------------------------------------------------------------------------------


def test_words_are_typed_by_the_rule(spark):
    rows = [(i, t) for i, t in enumerate(["Letters lettersÉa x LETTERS", None, "", "ÀÀÀÀÀÀÀÀ ÷÷÷÷÷÷÷×", "sevenxx_sevenxx1sevenxx", "a" * 5000] * 40)] + [(None, "Letters letters")] * 3
    got = {r.word: r.n for r in spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.spelled_words(rows)


@pytest.mark.parametrize(("sample", "leaf"), [(50, 20), (1 << 16, 30), (1 << 16, 8192)])
def test_variants_against_all_pairs(spark, sample, leaf):
    rnd = random.Random(leaf)
    words = {}
    for _ in range(60):
        base = "".join(rnd.choice("abcdeé") for _ in range(rnd.choice([7, 8, 9, 17, 30])))
        for _ in range(rnd.randint(1, 12)):
            w = list(base)
            for _ in range(rnd.randint(0, 2)):
                at, kind = rnd.randrange(len(w)), rnd.random()
                if kind < 0.3 and len(w) > 7:
                    del w[at]
                elif kind < 0.6:
                    w.insert(at, rnd.choice("abÿ"))
                else:
                    w[at] = rnd.choice("abcÿ")
            words["".join(w)] = rnd.choice([2, 3, 20, 35, 200, 4000])
    anagrams = {"".join(rnd.sample("abcdefg", 7)): rnd.choice([2, 30]) for _ in range(200)}  # no tree parts them
    words |= anagrams | {"b" * 7: 2, "b" * 8: 20, "b" * 9: 200, "b" * 10: 200, "aaaaaaa": 5, "aaaaaab": 50, "aaaaaac": 50}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {tuple(r) for r in spelling.group_variants(table, sample=sample, leaf=leaf).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == set(brute.spelling_forms(words))


def test_chains_lead_to_the_last_form(spark):
    table = spark.createDataFrame([("aaaaaaa", 2), ("aaaaaaab", 20), ("aaaaaaabb", 200), ("aaaaaaabbb", 2000), ("aaaaaaabbbb", 20000)], "word string, n long")
    assert {r.root for r in spelling.group_variants(table).collect()} == {"aaaaaaabbbb"}


def test_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, "short one two"), (3, "loneliest")], "doc_id long, text string")).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_edit_by_columns():
    words = ["abcdefghij", "abcdefghiq", "xbcdefghij", "abcdefghik"]
    _, packed, _ = spelling._forms(words, 10)
    left, right = np.array([0, 0, 0, 1]), np.array([0, 1, 2, 2])
    assert spelling._one_replaced(packed, left, packed, right).tolist() == [1, 2]


def test_op12(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in REGISTRY["op12_spelling_variants"](spark, SF_SMALL).collect()}
    assert got == set(brute.spelling_forms(brute.spelled_words(docs)))


# --- whitening ---------------------------------------------------------------------------------


def _plain(vectors):
    """n, S, covariance of the fit list, in exact integers and doubles."""
    xs = sorted({tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors})
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    y = np.array([[float(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in xs])
    return n, sums, y.T @ y / n


def _check(rows, vectors):
    ok = {i: v for i, v in vectors.items() if v and all(c is not None and math.isfinite(c) for c in v)}
    n, sums, cov = _plain(ok.values())
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    k = max(by[next(iter(by))])
    assert set(by) == set(ok) and all(sorted(v) == list(range(1, k + 1)) for v in by.values())
    got = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in ok])
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in ok.values()]
    y = np.array([[float(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in x])
    want = y @ basis[:, :k] / np.sqrt(values[:k])
    gaps = np.append(np.abs(np.diff(values)), np.inf) / values[0]
    for c in range(k):
        if gaps[c] > 1e-6 and (not c or gaps[c - 1] > 1e-6):  # the direction is determined
            sign = np.sign((got[:, c] * want[:, c]).sum())
            assert np.allclose(got[:, c] * sign, want[:, c], atol=1e-7 * np.abs(want[:, c]).max())
    for i, v in zip(ok, x, strict=True):
        r = by[i][1]
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) and r.identity_error < 1e-8
        for c in range(k):
            assert math.isclose(by[i][c + 1].explained, values[c] / np.trace(cov), rel_tol=1e-9)
    return k


EMBEDDINGS = "vec_id long, embedding array<double>, component string"


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    basis = rng.normal(size=(20, 20)) * np.array([50, 50, 9, 9, 9] + [1] * 15)[:, None]
    vectors = {i: (rng.normal(size=20) @ basis / 8).tolist() for i in range(400)}
    for i in range(400, 700):
        vectors[i] = vectors[0]  # copies count once
    vectors |= {900: None, 901: [], 902: [None] + [0.0] * 19, 903: [float("nan")] + [0.0] * 19, 904: [float("inf")] + [0.0] * 19}
    rows = whitening.whiten(spark.createDataFrame([(i, v, "x") for i, v in vectors.items()], EMBEDDINGS).repartition(5)).collect()
    assert _check(rows, vectors) == 16


def test_few_directions_and_nothing(spark):
    line = {i: [float(i), 2.0 * i, 3.0] for i in range(10)}
    rows = whitening.whiten(spark.createDataFrame([(i, v, "x") for i, v in line.items()], EMBEDDINGS)).collect()
    assert _check(rows, line) == 1
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "x")] * 3, EMBEDDINGS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], EMBEDDINGS)).count() == 0
    mixed = {1: [1.0, 2.0], 2: [3.0, 1.0], 3: [1.0], None: [0.0, 0.5]}
    rows = whitening.whiten(spark.createDataFrame([(i, v, "x") for i, v in mixed.items()], EMBEDDINGS)).collect()
    assert {r.vec_id for r in rows} == {1, 2, None} and {r.n for r in rows} == {3}


def test_deviations_are_exact():
    y = np.array([[1 << 40, -3], [2, 5]])
    n, offset = 1000, np.array([7, 9])
    assert whitening.deviations(y, n, offset) == [None, sum((n * a - b) ** 2 for a, b in ((2, 7), (5, 9)))]


@pytest.mark.parametrize("kind", ["random", "repeated", "graded", "diagonal", "tiny", "one"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(8)
    n = 1 if kind == "one" else 40
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = {"random": rng.uniform(0, 5, n), "repeated": np.repeat([9.0, 5.0, 5.0, 1.0], n // 4 or 1)[:n], "graded": 10.0 ** -np.arange(n), "tiny": rng.uniform(0, 5, n) * 1e-200,
              "diagonal": np.arange(n), "one": np.ones(1)}[kind]
    a = np.diag(values) if kind == "diagonal" else (q * values) @ q.T
    a = (a + a.T) / 2
    k = min(n, 16)
    got, vectors = whitening.leading_eigenvectors(a, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    top = np.abs(want).max()
    assert np.allclose(got, want, rtol=0, atol=1e-13 * top)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-10)
    assert np.abs(a @ vectors - vectors * got).max() < 1e-12 * top


def test_op13(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", F.col("embedding")).collect()}
    assert _check(REGISTRY["op13_embedding_whitening"](spark, SF_MID).collect(), vectors) == 16
