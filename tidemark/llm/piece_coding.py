"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model runs from another character into a whitespace marker, so
a normalised text falls into chunks (a run of markers and what follows up to
the next marker) that the model segments independently.  Each distinct chunk is
segmented once and its ids are laid back by position:

1. A block of documents (about ``BLOCK_CHARS`` of text, whole documents) is
   normalised and coded: the distinct chunks of the block get numbers, and each
   document becomes numbers of chunks.  The block's chunks travel in parts by a
   hash of the chunk, one row for each part.
2. A part segments each of its chunks once, whatever number of blocks hold it.
3. The ids go back to their block.  The documents are read and coded a second
   time (cheaper than to keep their codes) and meet the ids, where they are put
   together and decoded.

A chunk crosses the network once for each block that holds it, never once for
each occurrence, and the codes of a document once.  A frequent word is one
entry of its part in any block, so no key is hot.  Both readings must give the
same rows in the same partitions, as a table does; a digest of the block's
chunks is compared, and a difference is an error.  Store other inputs first.

Defined results: null text is empty, and an empty text has the begin and end
ids alone; very long texts are blocks of their own; ids may be null or repeat
(rows are told apart by place, each row gives one row); an empty table gives an
empty table; further columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Characters of a block of documents; a longer document is a block of its own.
BLOCK_CHARS = 32 << 20
#: Characters of the corpus for each part of the distinct chunks.
PART_CHARS = 32 << 20
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Segmenter:
    """The library's processor, by chunks."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) or self.model.normalize("a b") != f"{MARK}a{MARK}b":
            raise ValueError("the model's pieces cross whitespace markers: its chunks can't be segmented apart")
        self.alone = self.model.piece_to_id(MARK)

    def chunks(self, text: str) -> list[str]:
        """The chunks, each without its first marker."""
        marked = self.model.normalize(text)
        plain = marked[1:].split(MARK)
        if "" not in plain:
            return plain
        return [c[1:] for c in _CHUNK.findall(marked)]  # runs of markers, or no text

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """The ids of each chunk; the library puts the first marker back."""
        found = self.model.encode(chunks, num_threads=1)
        return [ids if c else [self.alone] for c, ids in zip(chunks, found, strict=True)]


@functools.lru_cache(maxsize=2)
def segmenter(path: str) -> Segmenter:
    """One processor for each worker process."""
    return Segmenter(path)


def squeeze(numbers) -> bytes:
    """Unsigned 32-bit numbers, byte planes apart, compressed."""
    raw = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)
    return zlib.compress(np.ascontiguousarray(raw.T).tobytes(), 1)


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Numbers(dict):
    """Numbers its keys as they are asked for."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class Block:
    """The distinct chunks of a block of documents, and each document as numbers of them."""

    def __init__(self):
        self.seen = Numbers()
        self.texts: list[np.ndarray] = []
        self.chars = 0

    def add(self, text: str, chunks: list[str]) -> None:
        self.texts.append(np.fromiter(map(self.seen.__getitem__, chunks), np.int32, len(chunks)))
        self.chars += len(text)

    def _ordered(self) -> tuple[np.ndarray, np.ndarray]:
        """All numbers, and the chunks from the most frequent on."""
        flat = np.concatenate([*self.texts, np.zeros(0, np.int32)])
        return flat, np.argsort(-np.bincount(flat, minlength=len(self.seen)), kind="stable")

    def digest(self) -> bytes:
        return hashlib.blake2b("\0".join(self.seen).encode("utf-8"), digest_size=16).digest()

    def parts(self, parts: int) -> list[tuple[int, bytes, bytes, bytes]]:
        """Rows (part, numbers, chunk lengths, chunks)."""
        names, often = list(self.seen), self._ordered()[1]
        raws = [names[i].encode("utf-8") for i in often.tolist()]
        part = np.fromiter((zlib.crc32(r) % parts for r in raws), np.int64, len(raws))
        by = np.argsort(part, kind="stable")
        rows = []
        for group in np.split(by, np.flatnonzero(np.diff(part[by])) + 1) if len(by) else []:
            mine = [raws[i] for i in group.tolist()]
            rows.append((int(part[group[0]]), squeeze(group), squeeze([len(r) for r in mine]), zlib.compress(b"".join(mine), 1)))
        return rows

    def codes(self) -> tuple[bytes, bytes]:
        """The chunk count of each text, and all numbers; frequent chunks have small ones, which compress well."""
        flat, often = self._ordered()
        number = np.empty(len(often), np.int32)
        number[often] = np.arange(len(often))
        return squeeze([len(t) for t in self.texts]), squeeze(number[flat])


def encode_documents(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                     with_ids: bool = False, with_text: bool = False, block_chars: int = BLOCK_CHARS, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per document: the id, ``carry``, n_tokens, ids_sha256, decoded_sha256 (and ``ids``, ``decoded``)."""
    path = model or model_path()
    head = [id_col, *(c for c in carry if c != id_col)]
    docs = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(head)], F.col(f"`{text_col}`").alias("t"))
    fields = ", ".join(f"c{i}: {docs.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(head)))
    chars = docs.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    docs = docs.withColumn("p", F.spark_partition_id())
    parts = 1 + chars // part_chars

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block, pa.Array]]:
        """(number, block, columns of its documents)"""
        coder, number = segmenter(path), None
        heads, held = [], Block()
        for batch in batches:
            if number is None and batch.num_rows:
                number = batch.column(len(head) + 1)[0].as_py() << 32
            owners = pa.StructArray.from_arrays(batch.columns[:len(head)], names=[f"c{i}" for i in range(len(head))])
            begun = 0
            for i, t in enumerate(batch.column(len(head))):
                t = t.as_py() or ""
                held.add(t, coder.chunks(t))
                if held.chars >= block_chars:
                    yield number, held, pa.concat_arrays([*heads, owners.slice(begun, i + 1 - begun)])
                    heads, held, begun, number = [], Block(), i + 1, number + 1
            heads.append(owners.slice(begun))
        if held.texts:
            yield number, held, pa.concat_arrays(heads)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, _ in blocks(batches):
            if rows := block.parts(parts):
                digest = block.digest()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(rows), pa.int64()), pa.array([digest] * len(rows), pa.binary()),
                     *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True))],
                    names=["block", "digest", "part", "numbers", "sizes", "words"])

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, owners in blocks(batches):
            sizes, numbers = block.codes()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([1], pa.int32()), pa.array([block.digest()], pa.binary()), pa.array([numbers], pa.binary()),
                                              pa.array([sizes], pa.binary()), pa.array([None], pa.binary()),
                                              pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), owners)],
                                             names=["block", "kind", "digest", "numbers", "sizes", "ids", "owners"])

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, known, at = segmenter(path), {}, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["part"] != at:  # rows come in order of their part
                    known, at = {}, row["part"]
                raw, ends = zlib.decompress(row["words"]), np.cumsum(unsqueeze(row["sizes"]), dtype=np.int64).tolist()
                words = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                fresh = [w for w in words if w not in known]
                known.update(zip(fresh, coder.segment([w.decode("utf-8") for w in fresh]), strict=True))
                found = [known[w] for w in words]
                out.append((row["block"], row["digest"], row["numbers"], squeeze([len(f) for f in found]), squeeze([i for f in found for i in f])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), *[pa.binary()] * 4), strict=True)],
                                                 names=["block", "digest", "numbers", "sizes", "ids"])

    extra = [("ids", pa.list_(pa.int32()), "array<int>")] * with_ids + [("decoded", pa.string(), "string")] * with_text

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = segmenter(path).model
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        digests = set()
        for batch in batches:
            for i in range(batch.num_rows):
                numbers, sizes = unsqueeze(batch.column(3)[i].as_py()), unsqueeze(batch.column(4)[i].as_py())
                digests.add(batch.column(2)[i].as_py())
                if not batch.column(1)[i].as_py():  # the ids of a part come before the block's documents
                    held.append((numbers, sizes, unsqueeze(batch.column(5)[i].as_py())))
                    continue
                entries = sum(len(h[0]) for h in held)
                if len(digests) > 1 or (len(numbers) and int(numbers.max()) >= entries):
                    raise ValueError("the documents differ between two readings: store them first")
                count, start = np.zeros(entries, np.int64), np.zeros(entries, np.int64)
                ids = np.concatenate([h[2] for h in held]) if held else np.zeros(0, "<u4")
                if held:
                    every = np.concatenate([h[1] for h in held]).astype(np.int64)
                    where = np.concatenate([h[0] for h in held])
                    count[where], start[where] = every, np.cumsum(every) - every
                owners, held, digests = batch.column(6)[i].values, [], set()
                cut = np.append(0, np.cumsum(sizes, dtype=np.int64)).tolist()
                rows = []
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    mine = numbers[a:b]
                    n = count[mine]
                    ends = np.cumsum(n)
                    pick = np.repeat(start[mine] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
                    whole = np.concatenate([[model.bos_id()], ids[pick], [model.eos_id()]]).astype("<u4")
                    listed = whole.tolist()
                    text = model.decode(listed)
                    rows.append((len(listed), hashlib.sha256(whole.tobytes()).hexdigest(), hashlib.sha256(text.encode("utf-8")).hexdigest(),
                                 *([listed] if with_ids else []), *([text] if with_text else [])))
                types = (pa.int64(), pa.string(), pa.string(), *[t for _, t, _ in extra])
                for a in range(0, len(rows), 1024):
                    part = owners.slice(a, 1024)
                    yield pa.RecordBatch.from_arrays(
                        [*part.flatten(), *(pa.array(c, t) for c, t in zip(zip(*rows[a:a + 1024], strict=True), types, strict=True))],
                        names=[f"c{k}" for k in range(len(head))] + ["n_tokens", "ids_sha256", "decoded_sha256", *[n for n, _, _ in extra]])

    owned = f"array<struct<{fields}>>"
    found = (docs.mapInArrow(chunks, "block long, digest binary, part int, numbers binary, sizes binary, words binary").repartition(parts, "part").sortWithinPartitions("part")
             .mapInArrow(segment, "block long, digest binary, numbers binary, sizes binary, ids binary"))
    coded = docs.mapInArrow(codes, f"block long, kind int, digest binary, numbers binary, sizes binary, ids binary, owners {owned}")
    back = (found.select("block", F.lit(0).alias("kind"), "digest", "numbers", "sizes", "ids", F.lit(None).cast(owned).alias("owners")).union(coded)
            .repartition(2 * parts, "block").sortWithinPartitions("block", "kind"))
    spec = ", ".join(f"c{i} {docs.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(head)))
    out = back.mapInArrow(lay, f"{spec}, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join(f", {n} {t}" for n, _, t in extra))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(head)], "n_tokens", "ids_sha256", "decoded_sha256", *[n for n, _, _ in extra])
