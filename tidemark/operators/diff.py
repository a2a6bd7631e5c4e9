"""Snapshot diff: added / modified / removed chunks between two runs.

Plan shape per side: Exchange on ``(start_url, chunk_id)`` -> sort -> last-wins
aggregation -> full outer sort-merge join.  A hash of the key leads it, so sorts
compare numbers instead of long equal beginnings.  Rows are sorted once, behind the
shuffle: an aggregate of texts is a sort aggregate in Spark, and chunk ids are
nearly unique, so a sort before the shuffle would spill the whole table and
combine next to nothing.  Copies of one id meet in one task, which sorts them with
spilling.  Both sides are partitioned and sorted on the join key by their own
aggregation, so the join adds no shuffle.  Every value is an aggregate of its own:
a caller that reads no text (counts, labels, routes) shuffles none.  Stored
snapshots have a form with one shuffle and no join (``diff_snapshots``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["start_url", "chunk_id"]
HASHED_KEY = ["_key", *KEY]
PAYLOAD = ["url", "heading_path", "text", "chunk_hash"]


def last_wins(chunks: DataFrame, whole: bool = False) -> DataFrame:
    """One row per ``(start_url, chunk_id)``.

    The value is the last row in crawl order ``(page_seq, order)``; the
    position reported is the first occurrence, as when a keyed map is
    overwritten in place.  Rows tied on position (a table can hold the same
    position twice, a crawl cannot) are ordered by hash, then url, so the
    winner never depends on task scheduling.  ``whole``: see :func:`by_key`.
    """
    return _last_wins(chunks, whole).drop("_key")


def last_wins_in_buckets(chunks: DataFrame, bucket: Column) -> DataFrame:
    """:func:`last_wins` with ``bucket`` (which follows from the key), by which its rows are dealt and ordered."""
    dealt = unpack_hash(pack_hash(chunks, True).withColumn("bucket", bucket).repartition("bucket"), True)
    return _whole_winners(dealt.withColumn("_key", F.hash(*KEY)), ["bucket", *HASHED_KEY]).drop("_key")


def _whole_winners(rows: DataFrame, key: list[str]) -> DataFrame:
    won = rows.groupBy(*key).agg(F.max(_whole_rank()).alias("_v"), F.min(_position()).alias("_first"))
    return won.select(*key, *[F.col(f"_v.{c}").alias(c) for c in PAYLOAD], F.col("_first.s").alias("pos_seq"), F.col("_first.o").alias("pos_order"))


def _last_wins(chunks: DataFrame, whole: bool) -> DataFrame:
    """:func:`last_wins` with the hash of the key, by which its rows are dealt and sorted."""
    if whole:
        return _whole_winners(by_key(chunks, whole), HASHED_KEY)
    rank, rows = _rank(), by_key(chunks).groupBy(*HASHED_KEY)
    return (
        rows.agg(F.max(rank).alias("_v"), F.max(_hash_rank()).alias("_h"), F.max_by("text", rank).alias("text"), F.min(_position()).alias("_first"))
        .select(*HASHED_KEY, F.col("_v.url").alias("url"), F.col("_v.heading_path").alias("heading_path"), "text",
                F.col("_h.chunk_hash").alias("chunk_hash"), F.col("_first.s").alias("pos_seq"), F.col("_first.o").alias("pos_order"))
    )


def _position():
    return F.struct(F.col("page_seq").alias("s"), F.col("order").alias("o"))


def _hash_rank():
    """The leading part of :func:`_rank`, which decides the hash that wins."""
    return F.struct(F.col("page_seq"), F.col("order"), F.col("chunk_hash"))


def _rank():
    """Total order of rows sharing an id: crawl position, then hash, url and path as tie-breaks."""
    return F.struct(F.col("page_seq"), F.col("order"), F.col("chunk_hash"), F.col("url"), F.col("heading_path"))


def _whole_rank():
    """:func:`_rank` with the text, for callers that read it: one aggregate gives all values of the row that wins."""
    return F.struct(*[F.col(c) for c in _RANKED])


_RANKED = ("page_seq", "order", "chunk_hash", "url", "heading_path", "text")


def mark_winners(rows: DataFrame, dealt: list[str]) -> DataFrame:
    """Adds ``wins`` (the row of an id that :func:`last_wins` keeps) and, on such a row, ``first_at``: the id's first position if it is another.

    ``dealt``: columns that follow from the key and by which the rows are dealt; no shuffle is added.
    """
    copies = Window.partitionBy(*dealt, *KEY).orderBy(*_RANKED)  # the first row has the least position, the last one wins
    first = F.first(_position()).over(copies.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = rows.withColumns({"wins": F.lead(F.lit(True)).over(copies).isNull(), "first_at": first})
    return marked.withColumn("first_at", F.when(F.col("wins") & ~F.col("first_at").eqNullSafe(_position()), F.col("first_at")))


def winners(stored: DataFrame) -> DataFrame:
    """The rows of stored runs that win, see :func:`mark_winners`; rows stored without marks are all kept."""
    return stored.where(F.coalesce("wins", F.lit(True))).drop("wins")


def pack_hash(rows: DataFrame, whole: bool = False) -> DataFrame:
    """``chunk_hash`` of the form ``sha256:<64 lower-case hex digits>`` as 32 bytes in ``_sha``; any other value stays as it is.

    ``whole``: none at all where it is the hash of the row's own text, which is checked for each row.
    """
    sha = F.unhex(F.substring("chunk_hash", 8, 64))
    packed = rows.withColumn("_sha", sha).withColumn("_sha", F.when(_hash_text("_sha") == F.col("chunk_hash"), F.col("_sha")))
    if whole:
        packed = packed.withColumn("_sha", F.when(F.col("chunk_hash") == _text_hash(), F.lit(b"")).otherwise(F.col("_sha")))
    return packed.withColumn("chunk_hash", F.when(F.col("_sha").isNull(), F.col("chunk_hash")))


def unpack_hash(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Undoes :func:`pack_hash`."""
    packed = F.coalesce("chunk_hash", _hash_text("_sha"))
    if whole:
        packed = F.when(F.col("_sha") == F.lit(b""), _text_hash()).otherwise(packed)
    return rows.withColumn("chunk_hash", packed).drop("_sha")


def _hash_text(sha: str):
    return F.concat(F.lit("sha256:"), F.lower(F.hex(sha)))


def _text_hash():
    return F.concat(F.lit("sha256:"), F.sha2("text", 256))


def by_key(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Rows dealt by ``(start_url, chunk_id)`` with a hash of it; chunk hashes, which do not compress as text, cross the network as bytes.

    ``whole``: the caller reads the texts, so hashes of texts are made again behind the shuffle and do not cross it.
    """
    return unpack_hash(pack_hash(rows, whole).withColumn("_key", F.hash(*KEY)).repartition(*HASHED_KEY), whole)


def diff_snapshots(prev: DataFrame | None, cur: DataFrame, whole: bool = False) -> DataFrame:
    """:func:`diff_chunks` for stored snapshots: one shuffle and one sort for both, no join.

    Rows are tagged by run and dealt by key together; one aggregation gives the
    winner and the first position of each run.  Same rows as :func:`diff_chunks`,
    without rows whose site, id or winning position is null.  ``whole``: see :func:`by_key`.
    """
    return _diff_snapshots(prev, cur, whole).drop("_key")


def _diff_snapshots(prev: DataFrame | None, cur: DataFrame, whole: bool = False) -> DataFrame:
    """:func:`diff_snapshots` with the hash of the key, by which its rows are dealt."""
    marked = ["first_at"] if "first_at" in cur.columns else []
    both = _tagged(prev, cur, [*KEY, "page_seq", "order", *PAYLOAD, *marked])
    position = F.coalesce("first_at", _position()) if marked else _position()
    sides = {"c": F.col("_cur"), "p": ~F.col("_cur")}
    aggs = []
    for s, here in sides.items():
        aggs.append(F.min(F.when(here, position)).alias(f"_f{s}"))
        if whole:
            aggs.append(F.max(F.when(here, _whole_rank())).alias(f"_v{s}"))
        else:
            aggs += [F.max(F.when(here, _rank())).alias(f"_v{s}"), F.max(F.when(here, _hash_rank())).alias(f"_h{s}"),
                     F.max(F.when(here, F.struct(_rank().alias("r"), F.col("text")))).alias(f"_t{s}")]
    j = by_key(both, whole).groupBy(*HASHED_KEY).agg(*aggs)
    if whole:
        j = j.withColumns({f"_{a}{s}": F.col(f"_v{s}") for a in "ht" for s in sides})
    in_c, in_p = F.col("_hc").isNotNull(), F.col("_hp").isNotNull()
    change = (F.when(~in_p, F.lit("added")).when(~in_c, F.lit("removed"))
              .when(F.col("_hc.chunk_hash") != F.col("_hp.chunk_hash"), F.lit("modified")))

    def pick(agg, field):
        return F.when(in_c, F.col(f"_{agg}c.{field}")).otherwise(F.col(f"_{agg}p.{field}"))

    # a row without site, id or position is no chunk of a stored run
    known = F.col("start_url").isNotNull() & F.col("chunk_id").isNotNull() & pick("h", "page_seq").isNotNull() & pick("h", "order").isNotNull()
    return (j.where(known & change.isNotNull())
             .select("_key", "start_url", change.alias("change_type"), "chunk_id", pick("v", "url").alias("url"), pick("v", "heading_path").alias("heading_path"),
                     pick("t", "text").alias("text"), pick("h", "chunk_hash").alias("chunk_hash"), F.when(in_c, 0).otherwise(1).alias("change_side"),
                     pick("f", "s").alias("pos_seq"), pick("f", "o").alias("pos_order")))


def _tagged(prev: DataFrame | None, cur: DataFrame, names: list[str]) -> DataFrame:
    """The rows of both runs, ``_cur`` for those of the current one."""
    rows = cur.select(*names, F.lit(True).alias("_cur"))
    return rows if prev is None else rows.unionByName(prev.select(*names, F.lit(False).alias("_cur")))


def diff_chunks(prev: DataFrame | None, cur: DataFrame, whole: bool = False) -> DataFrame:
    """Change rows for every site present in either snapshot.

    ``prev``/``cur``: chunk tables with ``start_url, page_seq, chunk_id, url,
    heading_path, text, chunk_hash, order``.  ``prev=None`` (first run) makes
    every current chunk ``added``.  Output: ``start_url, change_type,
    chunk_id, url, heading_path, text, chunk_hash`` plus the order key
    ``change_side`` (0 current, 1 removed), ``pos_seq``, ``pos_order``:
    current-run changes in crawl order, then removals in previous order.
    Removed rows carry the previous values.  ``whole``: see :func:`by_key`.
    """
    c = _last_wins(cur, whole).withColumn("_in_cur", F.lit(True))
    if prev is None:
        p = c.limit(0).withColumnRenamed("_in_cur", "_in_prev")
    else:
        p = _last_wins(prev, whole).withColumn("_in_prev", F.lit(True))
    j = c.alias("c").join(p.alias("p"), HASHED_KEY, "full_outer")
    in_c, in_p = F.col("c._in_cur").isNotNull(), F.col("p._in_prev").isNotNull()
    change = (F.when(~in_p, F.lit("added"))
              .when(~in_c, F.lit("removed"))
              .when(F.col("c.chunk_hash") != F.col("p.chunk_hash"), F.lit("modified")))
    side = F.when(in_c, F.lit("c")).otherwise(F.lit("p"))

    def pick(name):
        return F.when(in_c, F.col(f"c.{name}")).otherwise(F.col(f"p.{name}")).alias(name)

    return (
        j.select(*KEY, change.alias("change_type"), *[pick(n) for n in PAYLOAD],
                 F.when(side == "c", 0).otherwise(1).alias("change_side"),
                 pick("pos_seq"), pick("pos_order"))
        .where(F.col("change_type").isNotNull())
        .select("start_url", "change_type", "chunk_id", *PAYLOAD, "change_side", "pos_seq", "pos_order")
    )


def winning_hashes(chunks: DataFrame) -> DataFrame:
    """``start_url, chunk_id, chunk_hash`` of the rows :func:`last_wins` keeps, from narrow columns only."""
    narrow = chunks.select(*KEY, "page_seq", "order", "chunk_hash")
    return by_key(narrow).groupBy(*HASHED_KEY).agg(F.max(_hash_rank()).alias("_w")).select(*KEY, F.col("_w.chunk_hash").alias("chunk_hash"))


def diff_added(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Current chunk ids absent from the previous run."""
    return last_wins(cur).join(prev.select(*KEY).distinct(), KEY, "left_anti")


def diff_removed(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Previous chunk ids absent now (previous values)."""
    return last_wins(prev).join(cur.select(*KEY).distinct(), KEY, "left_anti")


def diff_modified(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Ids in both runs whose text hash differs (current values)."""
    p = winning_hashes(prev).withColumnRenamed("chunk_hash", "_prev_hash")
    return (last_wins(cur).join(p, KEY, "inner")
            .where(F.col("chunk_hash") != F.col("_prev_hash")).drop("_prev_hash"))


def change_summary(changes: DataFrame, runs: DataFrame) -> DataFrame:
    """``runs(start_url, ...)`` + counts per change type; runs without changes get zeros.

    A partial/final hash aggregation on ``start_url`` (map-side combine: a
    site with a third of all changes still sends one row per map task).
    """
    counts = changes.groupBy("start_url").agg(
        F.count_if(F.col("change_type") == "added").alias("added"),
        F.count_if(F.col("change_type") == "modified").alias("modified"),
        F.count_if(F.col("change_type") == "removed").alias("removed"),
    )
    return runs.join(counts, "start_url", "left").select(
        *runs.columns, *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n)
                         for n in ("added", "modified", "removed")])


def changeset_header(changes: DataFrame, runs: DataFrame) -> DataFrame:
    """``run_at, prev_run_at, start_url, summary struct`` per run.

    The changed chunks themselves stay a flat table ordered by
    ``(start_url, change_side, pos_seq, pos_order)``; the document sink
    writes the two parts side by side instead of nesting an unbounded array
    into one row.
    """
    s = change_summary(changes, runs)
    return s.select("run_at", "prev_run_at", "start_url",
                    F.struct("added", "modified", "removed").alias("summary"))


def change_audit(changes: DataFrame, prev: DataFrame | None, cur: DataFrame) -> DataFrame:
    """Contradictions between reported changes and the two snapshots (empty = consistent).

    added: id must be in current and not in previous; removed: the reverse;
    modified: in both with different hashes; the reported hash must be the
    hash of the side it claims to describe.
    """
    # both runs in one pass: rows tagged by run, the last one of each run by key
    rows = by_key(_tagged(prev, cur, [*KEY, "page_seq", "order", "chunk_hash"]))
    won = rows.groupBy(*HASHED_KEY).agg(F.max(F.when(F.col("_cur"), _hash_rank())).alias("c"), F.max(F.when(~F.col("_cur"), _hash_rank())).alias("p"))
    if "_key" not in changes.columns:  # else they are dealt by it and stay where they are
        changes = changes.withColumn("_key", F.hash(*KEY))
    j = changes.join(won.select(*HASHED_KEY, F.col("c.chunk_hash").alias("cur_hash"), F.col("p.chunk_hash").alias("prev_hash")), HASHED_KEY, "left")
    ok = (
        F.when(F.col("change_type") == "added",
               F.col("cur_hash").isNotNull() & F.col("prev_hash").isNull()
               & (F.col("chunk_hash") == F.col("cur_hash")))
        .when(F.col("change_type") == "removed",
              F.col("cur_hash").isNull() & F.col("prev_hash").isNotNull()
              & (F.col("chunk_hash") == F.col("prev_hash")))
        .when(F.col("change_type") == "modified",
              F.col("cur_hash").isNotNull() & F.col("prev_hash").isNotNull()
              & (F.col("cur_hash") != F.col("prev_hash")) & (F.col("chunk_hash") == F.col("cur_hash")))
        .otherwise(F.lit(False))
    )
    return j.where(~F.coalesce(ok, F.lit(False))).select(*KEY, "change_type", "cur_hash", "prev_hash")


def run_id_set_diff(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Key-set comparison of two runs: ``(start_url, chunk_id, side)`` with side in
    ``only_current``, ``only_previous``, ``hash_changed`` (a hash of the current run that the previous one lacks).

    Each run is read once: rows tagged by run are aggregated by key and hash, then by key.
    """
    both = cur.select(*KEY, "chunk_hash", F.lit(True).alias("c"), F.lit(False).alias("p")).unionByName(
        prev.select(*KEY, "chunk_hash", F.lit(False).alias("c"), F.lit(True).alias("p")))
    by_hash = both.groupBy(*KEY, "chunk_hash").agg(F.max("c").alias("c"), F.max("p").alias("p"))
    by_key = by_hash.groupBy(*KEY).agg(F.max("c").alias("c"), F.max("p").alias("p"), F.max(F.col("c") & ~F.col("p")).alias("fresh"))
    side = (F.when(~F.col("p"), F.lit("only_current")).when(~F.col("c"), F.lit("only_previous"))
            .when(F.col("fresh"), F.lit("hash_changed")))
    return by_key.select(*KEY, side.alias("side")).where(F.col("side").isNotNull())


def duplicate_chunk_ids(chunks: DataFrame) -> DataFrame:
    """Ids that occur more than once inside one page."""
    return (chunks.groupBy("start_url", "page_seq", "chunk_id")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
