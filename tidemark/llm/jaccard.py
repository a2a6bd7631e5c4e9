"""N-gram Jaccard join with token-combination prefixes.

Two documents link when their shingle sets have a Jaccard similarity of at
least 3/4.  Let n be a set's size: linked sets share at least ceil(3n/4)
elements, so in any common order of elements the first n - ceil(3n/4) + j of
each share at least j (the extended prefix).

1. Sets: one row per document with the size and a key of its set; documents
   with equal sets are one class from here on.  Elements that are frequent
   within a batch are noted; the most frequent ones, a bounded list, come last
   in the order of elements.
2. Extended prefixes (j = n/5) of all classes meet by element; an element met
   in one class only says nothing and goes.  A class that keeps fewer than j
   elements has no partner.
3. Index: the remaining elements in order of frequency, again cut to a prefix.
   Rare elements are index keys by themselves.  Frequent ones are so only in
   combination: two linked classes share a rare element, or at least j frequent
   ones, and then two of those stand close together in both lists, so only
   pairs within that distance are keys.
4. Candidates: classes under one key are compared with the key's first class.
   Where a key's classes are still in several components, all pairs of
   different components are: pair by pair under keys of few classes, and under
   larger ones by blocks of classes in order of size, block against block,
   where only blocks of compatible sizes meet and a block pair gives at most
   one link per pair of components.  Nothing is capped: every pair under a key
   is compared or known to be connected.
5. Verification: exact intersection of the whole sets, as merged lists, or
   for blocks as a product of their element matrices.

Sets are held as 64-bit hashes of shingles, classes as 64-bit hashes of sets:
the chance that any two of n differing ones collide is below n**2 / 2**65.

Defined results: null text, empty text and text without words have an empty
set and link with nothing, each a component of its own; a null id takes part
and is named by the others, ids that repeat share a component only if their
texts link; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_on, prefix_sum, stored
from .components import components
from .shingles import mix, set_key, shingle_sets

#: Elements in more classes than this are frequent.
RARE = 32
#: Share of a batch's classes that makes an element locally frequent, and how many such elements are listed (8 bytes each).
LOCAL_SHARE, LISTED = 0.02, 100_000
TEXTS, BATCH, BATCH_BYTES = 256, 2048, 8 << 20
#: Keys of more classes go by blocks of so many classes.
FEW, BLOCK, BLOCK_TOKENS = 8, 256, 1 << 17
#: Prefix elements a bucket should hold.
BUCKET_ENTRIES = 1 << 20
LAST = np.uint32(0xFFFFFFFF)


def needed(n):
    """Shared elements that a set of n needs with any linked set: ceil(3n/4)."""
    return n - n // 4


def spare(n):
    """j: elements by which prefixes are extended."""
    return np.maximum(1, n // 5)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list, list[np.ndarray]]]:
    """Parts of at most BATCH documents and about BATCH_BYTES of text, so that a worker holds few sets at a time."""
    for whole in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(whole.column(1)), 0).to_numpy(), dtype=np.int64)
        begin = 0
        while begin < whole.num_rows:
            most = np.searchsorted(ends, (int(ends[begin - 1]) if begin else 0) + BATCH_BYTES, side="right")
            batch = whole.slice(begin, min(BATCH, max(1, int(most) - begin)))
            begin += batch.num_rows
            sets = []
            for at in range(0, batch.num_rows, TEXTS):
                sets += shingle_sets(batch.column(1).slice(at, TEXTS).to_pylist())
            yield batch, batch.column(0).to_pylist(), sets


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, columns of ``carry``, n, cls (key of the set, null if empty), hot (locally frequent elements with their counts, on some rows)."""
    def run(batches):
        for batch, ids, sets in _batches(batches):
            sizes = [len(s) for s in sets]
            keys = [set_key(s) if len(s) else None for s in sets]
            hot = [None] * len(ids)
            distinct = {k: s for k, s in zip(keys, sets, strict=True) if k is not None}
            if distinct:
                values, counts = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                often = counts >= max(RARE, LOCAL_SHARE * len(distinct))
                hot[0] = [{"t": int(t), "c": int(c)} for t, c in zip(values[often].astype(np.int64), counts[often], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *batch.columns[2:], pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                                              pa.array(hot, pa.list_(pa.struct([("t", pa.int64()), ("c", pa.int64())])))], names=["doc_id", *carry, "n", "cls", "hot"])

    carried = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col), *carry).mapInArrow(run, f"doc_id long, {carried}n long, cls long, hot array<struct<t:long,c:long>>")


def _pack(array) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each bucket that occurs."""
    if not len(bucket):
        return iter(())
    order = np.argsort(bucket, kind="stable")
    there, first = np.unique(bucket[order], return_index=True)
    return zip(there.tolist(), np.split(order, first[1:]), strict=True)


def _buckets(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of one bucket after another, from batches in order of their buckets."""
    at, held = None, []
    for batch in batches:
        for r in zip(*(batch.column(c) for c in ("bucket", *columns)), strict=True):
            bucket, *row = (v.as_py() for v in r)
            if bucket != at:
                if held:
                    yield at, held
                at, held = bucket, []
            held.append(tuple(row))
    if held:
        yield at, held


def index_entries(docs: DataFrame, listed: np.ndarray, buckets: int, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE) -> DataFrame:
    """(key, cls, n): index keys of every class that can have a partner.

    ``listed``: sorted hashes of the elements that come last in the order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(listed)  # at most LISTED values
    row = ["bucket", "kind", "a", "b", "c"]

    def prefixes(batches):
        """Per batch: elements of extended prefixes by element bucket (kind 0), sizes and listed elements by class bucket (kind 1, 2)."""
        last = sent.value
        for *_, sets in _batches(batches):
            distinct = {set_key(s): s for s in sets if len(s)}
            if not distinct:
                continue
            keys, owner, tokens, kept_owner, kept = np.array(list(distinct), np.int64), [], [], [], []
            sizes = np.array([len(s) for s in distinct.values()], np.int64)
            for i, s in enumerate(distinct.values()):
                n = len(s)
                long = min(n, int(n - needed(n) + spare(n)))
                is_last = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s if len(last) else np.zeros(n, bool)
                own = s[~is_last][:long]
                tokens.append(own)
                owner.append(np.full(len(own), i))
                rest = s[is_last][:long - len(own)]
                kept.append(rest)
                kept_owner.append(np.full(len(rest), i))
            tokens, owner = np.concatenate(tokens), np.concatenate(owner)
            place = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            out = {c: [] for c in row}

            def emit(bucket, kind, a, b, c, out=out):
                for k, v in zip(row, (bucket, kind, _pack(a), _pack(b), _pack(c)), strict=True):
                    out[k].append(v)

            for b, at in _by_bucket(place):
                used, local = np.unique(owner[at], return_inverse=True)
                emit(b, 0, tokens[at], local.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32), keys[used])
            kept, kept_owner = np.concatenate(kept), np.concatenate(kept_owner).astype(np.int64)
            for b, at in _by_bucket((keys.astype(np.uint64) % np.uint64(buckets)).astype(np.int64)):
                emit(b, 1, keys[at], sizes[at].astype(np.uint32), [])
            mine = keys[kept_owner]
            for b, at in _by_bucket((mine.astype(np.uint64) % np.uint64(buckets)).astype(np.int64)):
                emit(b, 2, mine[at], kept[at], np.full(len(at), LAST))
            yield pa.RecordBatch.from_pydict(out, schema=packed)

    packed = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
    spec = "bucket int, kind int, a binary, b binary, c binary"

    def meet(batches):
        """Elements met in several classes, back to their classes (kind 2); one bucket at a time."""
        for _, parts in _buckets(batches, ("a", "b", "c")):
            token = np.concatenate([np.frombuffer(a, np.uint64) for a, _, _ in parts])
            # owners are 2 bytes each where the batch has few classes
            cls = np.concatenate([np.frombuffer(c, np.int64)[np.frombuffer(b, np.uint16 if 4 * len(b) == len(a) else np.uint32)] for a, b, c in parts])
            del parts
            order = np.lexsort((cls, token))
            token, cls = token[order], cls[order]
            new = np.append(True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1]))  # copies of a class in several batches
            token, cls = token[new], cls[new]
            start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            df = np.diff(np.append(start, len(token)))
            shared = np.repeat(df > 1, df)
            token, cls, df = token[shared], cls[shared], np.repeat(df, df)[shared].astype(np.uint32)
            out = {c: [] for c in row}
            for b, at in _by_bucket((cls.astype(np.uint64) % np.uint64(buckets)).astype(np.int64)):
                for k, v in zip(row, (b, 2, _pack(cls[at]), _pack(token[at]), _pack(df[at])), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=packed)

    def index(batches):
        """Index keys of the classes of a bucket, one bucket at a time."""
        for _, rows in _buckets(batches, ("kind", "a", "b", "c")):
            sizes, parts = ([r[1:] for r in rows if r[0] == kind] for kind in (1, 2))
            del rows
            if not sizes or not parts:
                continue
            known = np.concatenate([np.frombuffer(a, np.int64) for a, _, _ in sizes])
            known, first = np.unique(known, return_index=True)
            n_of = np.concatenate([np.frombuffer(b, np.uint32) for _, b, _ in sizes]).astype(np.int64)[first]
            cls, token, df = (np.concatenate([np.frombuffer(p[i], t) for p in parts]) for i, t in ((0, np.int64), (1, np.uint64), (2, np.uint32)))
            order = np.lexsort((token, df, cls))
            cls, token, df = cls[order], token[order], df[order]
            new = np.append(True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1]))  # listed elements come once per batch
            cls, token, df = cls[new], token[new], df[new]
            start = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
            keys, owners, ns = [], [], []
            for a, b in zip(start, np.append(start[1:], len(cls)), strict=True):
                n = int(n_of[np.searchsorted(known, cls[a])])
                j = int(spare(needed(n)))  # elements shared with any partner, whose size is at least ceil(3n/4)
                if b - a < j:
                    continue
                often = np.flatnonzero(df[a:b] > rare)
                end = b - a - j + 1  # one shared element at least among the first
                if len(often) and often[0] < end:
                    end = b - a  # else j shared ones among all, rare or frequent
                t = token[a:a + end]
                own = [t[df[a:a + end] <= rare]]
                f = t[len(own[0]):]
                if j == 1:  # one shared element may be all there is; partners that share more look for combinations
                    own.append(f)
                reach = len(f) - 1 if j == 1 else int(2 * (len(f) - 1) // (j - 1))
                own += [mix(f[:-g] * np.uint64(3) + f[g:]) for g in range(1, min(reach, len(f) - 1) + 1)]
                own = np.concatenate(own)
                keys.append(own)
                owners.append(np.full(len(own), cls[a]))
                ns.append(np.full(len(own), n))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(owners)), pa.array(np.concatenate(ns))],
                                                 names=["key", "cls", "n"])

    # by element bucket, then by class bucket; sizes and listed elements go to their class at once
    out = stored(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(prefixes, spec), "prefixes")
    met = out.where("kind = 0").repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, spec)
    entries = met.union(out.where("kind > 0")).repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(index, "key long, cls long, n long")
    return entries


def class_sets(docs: DataFrame, reps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(cls, tokens) of the classes in ``reps`` (cls, rep): one document each is read again."""
    def run(batches):
        for *_, sets in _batches(batches):
            found = {set_key(s): s for s in sets if len(s)}
            del sets
            if found:
                values = pa.array(np.concatenate(list(found.values())).view(np.int64))
                tokens = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found.values())]), pa.int32()), values)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), tokens], names=["cls", "tokens"])

    wanted = join_on(docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")), reps.select("rep").distinct(), ["rep"])
    # ids may repeat: other texts of the same id go again, and equal ones are one
    return wanted.select("rep", "text").mapInArrow(run, "cls long, tokens array<long>").join(reps.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link; row by row, as two sets may be long."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", (F.size("x") + F.size("y")).cast("long").alias("n"), F.size(F.array_intersect("x", "y")).cast("long").alias("both"))
    return met.where("100 * both >= 75 * (n - both)").select("a", "b")


def _similar_size():
    return 4 * F.least("n", "m") >= 3 * F.greatest("n", "m")


def shared_counts(xs: list[np.ndarray], ys: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all xs with all ys, as a product of element matrices."""
    out = np.zeros((len(xs), len(ys)), np.float32)
    common = np.intersect1d(np.concatenate(xs), np.concatenate(ys))
    sides = []
    for sets in (xs, ys):
        element = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(common, element), max(len(common) - 1, 0))
        hit = common[at] == element if len(common) else np.zeros(len(element), bool)
        order = np.argsort(at[hit])
        sides.append((at[hit][order], owner[hit][order]))
    for begin in range(0, len(common), columns):
        parts = []
        for (at, owner), sets in zip(sides, (xs, ys), strict=True):
            a, b = np.searchsorted(at, [begin, begin + columns])
            m = np.zeros((len(sets), min(columns, len(common) - begin)), np.float32)
            m[owner[a:b], at[a:b] - begin] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def block_links(members: DataFrame, known: DataFrame, block: int = BLOCK, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Links (a, b) between classes of one cluster and different components, from (cluster, cls, n, comp).

    Block against block: at most ``block`` classes and ``block_tokens`` elements, or one class that begins before
    that bound.  Of several links that join the same two components one is enough.
    """
    share = block_tokens // block
    ranked = prefix_sum(members, ["cluster"], "n", ["cls"], F.greatest(F.col("n"), F.lit(share)).cast("long"), "rank")
    ranked = stored(ranked.withColumn("block", F.expr(f"rank div {share * block}")), "cluster-members")
    blocks = ranked.join(known, "cls").groupBy("cluster", "block").agg(F.collect_list(F.struct("cls", "comp", "tokens")).alias("sets"))
    blocks = stored(blocks, "cluster-blocks")
    sizes = ranked.groupBy("cluster", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    left = sizes.select("cluster", *[F.col(c).alias(f"{c}_x") for c in ("block", "lo", "hi", "c0", "c1")])
    right = sizes.select("cluster", *[F.col(c).alias(f"{c}_y") for c in ("block", "lo", "hi", "c0", "c1")])
    units = left.join(right, "cluster").where("block_x <= block_y and 4 * hi_x >= 3 * lo_y and (c0_x <> c1_x or c0_y <> c1_y or c0_x <> c0_y)") \
        .select("cluster", "block_x", "block_y")

    def classes_of(column) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        members = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
        cls, comp, tokens = members.flatten()
        ends = tokens.offsets.to_numpy()
        values = tokens.values.to_numpy().view(np.uint64)
        return cls.to_numpy(), comp.to_numpy(), [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def run(unit: pa.Table) -> pa.Table:
        """One unit at a time: its sets, not a batch of units, fit a worker."""
        out = {"a": [], "b": []}
        for i in range(unit.num_rows):
            (x, cx, xs), (y, cy, ys) = (classes_of(unit.column(c).slice(i, 1)) for c in ("x", "y"))
            both = shared_counts(xs, ys)
            total = np.array([len(t) for t in xs])[:, None] + np.array([len(t) for t in ys]) - both
            row, col = np.nonzero((100 * both >= 75 * total) & (cx[:, None] != cy))
            first = np.unique(np.stack([np.minimum(cx[row], cy[col]), np.maximum(cx[row], cy[col])]), axis=1, return_index=True)[1]
            out["a"].append(x[row[first]])
            out["b"].append(y[col[first]])
        return pa.table({k: pa.array(np.concatenate([*v, np.zeros(0, np.int64)])) for k, v in out.items()})

    pairs = (units.join(blocks.select("cluster", F.col("block").alias("block_x"), F.col("sets").alias("x")), ["cluster", "block_x"])
             .join(blocks.select("cluster", F.col("block").alias("block_y"), F.col("sets").alias("y")), ["cluster", "block_y"]))
    return pairs.groupBy("cluster", "block_x", "block_y").applyInArrow(run, "a long, b long")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, comp and ``carry``.

    component_id is the smallest doc_id reachable; comp is the component's own key, null for empty sets.
    """
    spark = docs.sparkSession
    sets = stored(document_sets(docs, id_col, text_col, carry), "sets")
    hot = (sets.where("hot is not null").select(F.explode("hot").alias("h")).groupBy("h.t").agg(F.sum("h.c").alias("c"))
           .orderBy(F.desc("c"), "t").limit(LISTED).collect())  # bounded: LISTED values
    listed = np.sort(np.array([r["t"] for r in hot], np.int64).astype(np.uint64))
    classes = stored(sets.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "classes")
    load = classes.agg(F.sum(F.col("n") * 3 / 10)).first()[0] or 0
    buckets = max(8, int(load // BUCKET_ENTRIES) + 1)
    entries = stored(index_entries(docs, listed, buckets, id_col, text_col, rare).distinct(), "index")
    keys = entries.groupBy("key").agg(F.min(F.struct("cls", "n")).alias("lo"), F.max(F.struct("cls", "n")).alias("hi"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    entries = stored(entries.join(keys, "key"), "postings")  # keys of one class say nothing
    known = stored(class_sets(docs, entries.select("cls").distinct().join(classes.select("cls", "rep"), "cls"), id_col, text_col), "class-sets")

    def against(rows, end):
        star = rows.select("cls", "n", F.col(f"{end}.cls").alias("other"), F.col(f"{end}.n").alias("m")).where("cls <> other").where(_similar_size())
        return star.select(F.greatest("cls", "other").alias("a"), F.least("cls", "other").alias("b")).distinct()

    tested = stored(against(entries, "lo"), "pairs1")
    links = stored(linked(tested, known), "links1")
    comp = stored(components(links), "components1")
    placed = entries.where("classes > 2").join(comp.select(F.col("node").alias("cls"), "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    split = placed.groupBy("key").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).where("_x <> _y").select("key")
    apart = stored(placed.join(split, "key", "left_semi"), "apart")
    if not apart.isEmpty():
        few, many = apart.where(F.col("classes") <= FEW), apart.where(F.col("classes") > FEW)
        other = few.select("key", F.col("cls").alias("cls2"), F.col("n").alias("m"), F.col("comp").alias("comp2"))
        pairs = (few.select("key", "cls", "n", "comp").join(other, "key").where("cls > cls2 and comp <> comp2").where(_similar_size())
                 .select(F.col("cls").alias("a"), F.col("cls2").alias("b")).distinct())
        fresh = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs2")
        more = linked(fresh, known)
        if not many.isEmpty():
            cluster = components(many.select(F.col("cls").alias("a"), F.col("lo.cls").alias("b")))
            members = many.select("cls", "n", "comp").distinct().join(cluster.select(F.col("node").alias("cls"), F.col("comp").alias("cluster")), "cls")
            more = more.union(block_links(stored(members, "clusters"), known))
        more = stored(more, "links2")
        if not more.isEmpty():
            comp = stored(components(links.union(more)), "components2")
    # a component's name is the smallest doc_id of its classes
    placed = classes.select(F.col("cls").alias("node"), "rep").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = placed.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_class = stored(placed.join(names, "comp").select(F.col("node").alias("cls"), "component_id", "comp"), "class-components")
    discard(entries, known)
    return (sets.select("doc_id", F.col("n").alias("n_shingles"), "cls", *carry).join(by_class, "cls", "left")
            .select("doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "comp", *carry))
