"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver's tables (or inputs derived from them in
:mod:`tidemark.plans.inputs`) in full; queries that compare two crawls leave
out what one of the crawls did not see.  Array columns are rendered as text
(``' > '``-joined paths) so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..functions import urls as U
from ..operators import chunk as C
from ..operators import diff as D
from ..operators import extract as E
from ..operators import order as O
from ..operators.parallel import session_partitions, spread
from ..session import ensure_checkpoint_dir, shuffles_dropped
from ..sources.tables import scan_raw_pages as scan_raw
from ..sources.tables import table
from . import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _path_text(df: DataFrame) -> DataFrame:
    return df.withColumn("heading_path", F.array_join("heading_path", " > "))


# --- text rules over whole documents ---------------------------------------

@query("normalize_text")
def normalize_text(spark, sf):
    d = spread(table(spark, sf, "documents"), "doc_id", partitions=session_partitions(spark))
    return d.select("doc_id", T.normalize("text").alias("normalized"))


@query("text_hash")
def text_hash(spark, sf):
    d = spread(table(spark, sf, "documents"), "doc_id", partitions=session_partitions(spark))
    return d.select("doc_id", T.text_hash("text").alias("text_hash"))


@query("token_estimate")
def token_estimate(spark, sf):
    d = spread(table(spark, sf, "documents"), "doc_id", partitions=session_partitions(spark))
    return d.select("doc_id", T.token_estimate("text").alias("token_estimate"))


# --- extraction -------------------------------------------------------------

def _all(spark, sf):
    """Every row of ``pages`` as one crawl."""
    return spread(I.raw_pages(spark, sf, "all"), "url", partitions=session_partitions(spark))


@query("scan_raw_pages")
def scan_raw_pages(spark, sf):
    """Fetched pages written as a corpus and scanned by the raw page reader."""
    path = f"{ensure_checkpoint_dir(spark)}/raw-{uuid.uuid4().hex}"
    _all(spark, sf).write.parquet(path)
    return scan_raw(spark, path).select("url", "raw_html", "status", "fetched_at", "depth")


@query("page_markdown")
def page_markdown(spark, sf):
    r = _all(spark, sf)
    return r.select("page_seq", "url", H.page_markdown("raw_html").alias("markdown"))


@query("page_markdown_fallback")
def page_markdown_fallback(spark, sf):
    """Pages reduced to their furniture (nav + footer): main content is empty,
    so the whole document is converted."""
    r = _all(spark, sf).select(
        "start_url", "page_seq", "url", "status", "fetched_at", "depth",
        F.concat(F.lit("<html><body>"), F.regexp_extract("raw_html", r"(?is)<nav\b.*?</nav>", 0),
                 F.regexp_extract("raw_html", r"(?is)<footer\b.*?</footer>", 0),
                 F.lit("</body></html>")).alias("raw_html"))
    return E.extract_pages(r).select("page_seq", "url", "markdown")


@query("page_title")
def page_title(spark, sf):
    p = E.extract_pages(_all(spark, sf))
    return p.select("page_seq", "url", "title")


@query("page_content_hash")
def page_content_hash(spark, sf):
    p = E.extract_pages(_all(spark, sf))
    return p.select("page_seq", "url", "content_hash")


@query("extract_pages")
def extract_pages(spark, sf):
    return E.extract_pages(_all(spark, sf)).drop("start_url")


@query("pages_ok")
def pages_ok(spark, sf):
    return E.pages_ok(_all(spark, sf)).select("page_seq", "url", "status")


@query("pages_nonblank")
def pages_nonblank(spark, sf):
    return E.pipeline_pages(_all(spark, sf)).select("page_seq", "url", "title", "content_hash")


# --- chunking ---------------------------------------------------------------

def _md_pages(spark, sf):
    """All markdown pages: extracted test pages, conversations, accounts."""
    web = E.extract_pages(_all(spark, sf)).select("start_url", "page_seq", "url", "markdown")
    return (web.unionByName(I.conversation_pages(spark, sf))
               .unionByName(I.account_pages(spark, sf)))


@query("markdown_headings")
def markdown_headings(spark, sf):
    p = I.conversation_pages(spark, sf).unionByName(I.account_pages(spark, sf))
    lines = p.select("start_url", "page_seq", F.posexplode(F.split("markdown", "\n", -1)).alias("line_no", "line"))
    return (lines.select("start_url", "page_seq", "line_no", T.heading_level("line").alias("level"),
                         T.heading_text("line").alias("heading"))
                 .where(F.col("level") > 0))


@query("markdown_sections")
def markdown_sections(spark, sf):
    s = C.markdown_sections(_md_pages(spark, sf))
    return s.where(F.col("text") != "").select("start_url", "page_seq", "sec", "level", "heading", "text")


@query("section_breadcrumbs")
def section_breadcrumbs(spark, sf):
    c = C.chunk_pages(_md_pages(spark, sf))
    return _path_text(c.select("start_url", "page_seq", "order", "heading_path"))


@query("heading_slugs")
def heading_slugs(spark, sf):
    p = I.conversation_pages(spark, sf).unionByName(I.account_pages(spark, sf))
    lines = p.select("start_url", "page_seq", F.posexplode(F.split("markdown", "\n", -1)).alias("line_no", "line"))
    h = lines.where(T.heading_level("line") > 0)
    return h.select("start_url", "page_seq", "line_no", T.slug(T.heading_text("line")).alias("slug"))


@query("chunk_id_base")
def chunk_id_base(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.chunk_id_base("url").alias("id_base"))


@query("chunk_ids")
def chunk_ids(spark, sf):
    return C.chunk_pages(_md_pages(spark, sf)).select("start_url", "page_seq", "order", "chunk_id")


@query("chunk_order")
def chunk_order(spark, sf):
    return C.chunk_pages(_md_pages(spark, sf)).select("start_url", "page_seq", "order", "chunk_hash")


@query("chunk_pages")
def chunk_pages(spark, sf):
    return _path_text(C.chunk_pages(_md_pages(spark, sf)))


# --- diff -------------------------------------------------------------------

def _web_chunks(spark, sf, version):
    return C.chunk_pages(E.extract_pages(E.pages_ok(I.raw_pages(spark, sf, version)), partitions=session_partitions(spark)))


def _snapshots(spark, sf):
    """(previous, current) chunk snapshots: web pages plus the ledger."""
    prev = _web_chunks(spark, sf, "prev").unionByName(I.ledger_chunks(spark, sf, "prev"))
    cur = _web_chunks(spark, sf, "cur").unionByName(I.ledger_chunks(spark, sf, "cur"))
    return prev, cur


@query("chunks_last_wins")
def chunks_last_wins(spark, sf):
    """Pages and every ledger line; lines of one part and order share an id."""
    return _path_text(D.last_wins(_all_chunks(spark, sf)))


@query("diff_chunks")
def diff_chunks(spark, sf):
    prev, cur = _snapshots(spark, sf)
    return _path_text(D.diff_chunks(prev, cur))


@query("diff_ordered")
def diff_ordered(spark, sf):
    """The rows of the change document, in its order, numbered per site."""
    prev, cur = _snapshots(spark, sf)
    return _path_text(O.diff_ordered(D.diff_chunks(prev, cur, whole=True)))


@query("diff_unchanged")
def diff_unchanged(spark, sf):
    """A rerun over the same pages: no changes."""
    chunks = _all_chunks(spark, sf)
    return _path_text(D.diff_chunks(chunks, chunks))


@query("diff_added")
def diff_added(spark, sf):
    prev, cur = _snapshots(spark, sf)
    return D.diff_added(prev, cur).select("start_url", "chunk_id", "chunk_hash")


@query("diff_modified")
def diff_modified(spark, sf):
    prev, cur = _snapshots(spark, sf)
    return D.diff_modified(prev, cur).select("start_url", "chunk_id", "chunk_hash")


@query("diff_removed")
def diff_removed(spark, sf):
    prev, cur = _snapshots(spark, sf)
    return D.diff_removed(prev, cur).select("start_url", "chunk_id", "chunk_hash")


@query("diff_first_run")
def diff_first_run(spark, sf):
    return _path_text(D.diff_chunks(None, _all_chunks(spark, sf)))


def _crawl_sites(spark, sf) -> DataFrame:
    """Sites of the two runs, from the crawl inputs themselves (no chunking needed), each table read once."""
    return I.crawled_sites(spark, sf)


@query("change_summary")
def change_summary(spark, sf):
    prev, cur = _snapshots(spark, sf)
    return D.change_summary(D.diff_chunks(prev, cur), _crawl_sites(spark, sf))


@query("changed_chunk_count")
def changed_chunk_count(spark, sf):
    prev, cur = _snapshots(spark, sf)
    return D.diff_chunks(prev, cur).agg(F.count(F.lit(1)).alias("changed_chunks"))


# --- state --------------------------------------------------------------------

from ..operators import deliver as K  # noqa: E402
from ..operators import enrich as N  # noqa: E402
from ..operators import quality as A  # noqa: E402
from ..operators import render as R  # noqa: E402
from ..sources import state as S  # noqa: E402
from ..sources.index_store import BUCKETS, IndexStore  # noqa: E402
from . import jobs as J  # noqa: E402
from ..contract import CHANGE, CHUNK, contract_violations as _violations, record_violations as _record_violations  # noqa: E402
from ..operators.outbox import deliver  # noqa: E402


def _sites(spark, sf):
    return I.page_urls(spark, sf).select("start_url").distinct()


@query("state_key")
def state_key(spark, sf):
    return _sites(spark, sf).select("start_url", S.state_key("start_url").alias("site_key"),
                                    S.kv_state_key("start_url").alias("kv_key"))


def _state(spark) -> S.Snapshots:
    return S.Snapshots(spark, f"{ensure_checkpoint_dir(spark)}/state-{uuid.uuid4().hex}")


def _saved_state(spark, sf) -> S.Snapshots:
    """Both runs saved, as two jobs leave them."""
    state = _state(spark)
    for chunks, run_at in zip(_snapshots(spark, sf), (I.PREV_RUN_AT, I.CUR_RUN_AT), strict=True):
        state.save(chunks, run_at)
    return state


@query("state_load_latest")
def state_load_latest(spark, sf):
    state = _saved_state(spark, sf)
    latest = state.chunks(state.previous()).withColumnRenamed("run_at", "prev_run_at")
    return latest.select("start_url", "site_key", "prev_run_at", "chunk_id", "chunk_hash", "page_seq", "order")


@query("state_previous_run")
def state_previous_run(spark, sf):
    """State as the current run sees it: the latest run strictly before it."""
    state = _saved_state(spark, sf)
    latest = state.chunks(state.previous(I.CUR_RUN_AT)).withColumnRenamed("run_at", "prev_run_at")
    return latest.select("start_url", "prev_run_at", "chunk_id", "chunk_hash")


@query("state_round_trip")
def state_round_trip(spark, sf):
    """A run's state written and loaded as the next run's previous state."""
    prev, _ = _snapshots(spark, sf)
    state = _state(spark)
    commit = state.save(prev, I.PREV_RUN_AT)
    chunks, _ = S.load_previous(spark, state.runs.root, I.CUR_RUN_AT, state.staged_chunks(commit).select("start_url").distinct())
    return _path_text(chunks.select("start_url", "run_at", "page_seq", "chunk_id", "url", "heading_path", "text", "chunk_hash", "order"))


def _is_web() -> Column:
    """The sites of crawled pages; the others are ledgers."""
    return ~F.col("start_url").contains(".ledger.")


@query("state_two_jobs")
def state_two_jobs(spark, sf):
    """Two jobs of one run, each with its own sites, and a retry of the first: both keep their state."""
    prev, _ = _snapshots(spark, sf)
    state = _state(spark)
    web, ledger = prev.where(_is_web()), prev.where(~_is_web())
    state.save(web, I.PREV_RUN_AT)
    state.save(ledger, I.PREV_RUN_AT)
    state.save(web, I.PREV_RUN_AT)
    state.stage(web)  # a job that dies before it publishes
    found = state.chunks(state.previous(I.CUR_RUN_AT))
    return found.groupBy("start_url", "run_at").agg(F.count(F.lit(1)).alias("chunks"), F.countDistinct("chunk_id").alias("ids"),
                                                    F.sum(F.length("text")).alias("letters"))


def _digest_changes(spark, sf, whole: bool = False):
    """The change rows of two stored runs by way of their digests (with the hash of their key), and the second run's manifest row per site."""
    state = _state(spark)
    prev, cur = _snapshots(spark, sf)
    state.save(prev, I.PREV_RUN_AT)
    commit = state.stage(cur)
    previous = state.previous(I.CUR_RUN_AT)
    return state, commit, previous, J._changes_since(state, commit, previous, whole)


@query("diff_by_digests")
def diff_by_digests(spark, sf):
    """The diff of two stored runs; only key ranges whose digests differ are read."""
    return _path_text(_digest_changes(spark, sf, whole=True)[-1].drop("_key"))


@query("run_manifest")
def run_manifest(spark, sf):
    """Sites and counts of a run as its manifest keeps them."""
    state, commit, previous, changes = _digest_changes(spark, sf)
    sites = state.staged_chunks(commit).select("start_url").union(previous.select("start_url")).distinct()
    counts = D.change_summary(changes, sites.join(previous.select("start_url", F.col("run_at").alias("prev_run_at")), "start_url", "left"))
    state.save(None, I.CUR_RUN_AT, sites, counts, commit)
    found = state.runs.manifest(run_at=I.CUR_RUN_AT)
    return found.select("start_url", "site_key", "run_at", "prev_run_at", F.col("rows").alias("chunks"), F.col("keys").alias("ids"), "added", "modified", "removed")


# --- sinks and delivery ---------------------------------------------------------

def _changes(spark, sf, whole: bool = False):
    prev, cur = _snapshots(spark, sf)
    return D.diff_chunks(prev, cur, whole)


@query("jsonl_chunks")
def jsonl_chunks(spark, sf):
    c = C.chunk_pages(I.conversation_pages(spark, sf))
    return R.jsonl(c.select("chunk_id", "url", "heading_path", "text", "token_estimate", "chunk_hash", "order")) \
        .select(F.col("value").alias("line"))


@query("changeset_document")
def changeset_document(spark, sf):
    """The document heads of a run, from the manifest that its job wrote."""
    state, commit, previous, changes = _digest_changes(spark, sf)
    sites = state.staged_chunks(commit).select("start_url").distinct()
    counts = D.change_summary(changes, sites.join(previous.select("start_url", F.col("run_at").alias("prev_run_at")), "start_url", "left"))
    state.save(None, I.CUR_RUN_AT, sites, counts, commit)
    h = J.run_document(spark, state.runs.root, I.CUR_RUN_AT)
    return h.select("run_at", "prev_run_at", "start_url", "summary.added", "summary.modified", "summary.removed")


@query("delta_dataset")
def delta_dataset(spark, sf):
    """The rows a run appends to its change dataset (one per changed chunk)."""
    ch = _changes(spark, sf)
    return _path_text(ch.select(F.lit(I.CUR_RUN_AT).alias("run_at"), "change_type", "chunk_id", "url",
                                "heading_path", "text", "chunk_hash"))


@query("index_rows_flat")
def index_rows_flat(spark, sf):
    r = K.index_rows_flat(_changes(spark, sf))
    return r.select("start_url", "id", "document", "metadata.url", "metadata.heading_path", "metadata.chunk_hash")


@query("index_apply_changes")
def index_apply_changes(spark, sf):
    prev, cur = _snapshots(spark, sf)
    r = K.index_from_snapshots(prev, cur)
    return r.select("start_url", "id", "document", "metadata.url", "metadata.heading_path", "metadata.chunk_hash")


@query("index_merge_stored")
def index_merge_stored(spark, sf):
    """The change table merged into a stored index of the previous run: only touched buckets are rewritten."""
    prev, cur = _snapshots(spark, sf)
    root = f"{ensure_checkpoint_dir(spark)}/index-{uuid.uuid4().hex}"
    store = IndexStore(spark, f"{root}/index")
    store.create(K.index_in_buckets(prev, BUCKETS))
    with shuffles_dropped(spark):
        D.diff_chunks(prev, cur, whole=True).write.option("compression", "zstd").parquet(f"{root}/changes")
    store.merge(spark.read.parquet(f"{root}/changes"))
    return store.read().select("start_url", "id", "document", "metadata.url", "metadata.heading_path", "metadata.chunk_hash")


@query("index_apply_counts")
def index_apply_counts(spark, sf):
    return K.index_apply_counts(_changes(spark, sf))


@query("changes_by_route")
def changes_by_route(spark, sf):
    return K.changes_by_route(_changes(spark, sf)).select("start_url", "chunk_id", "change_type", "route")


@query("change_notification")
def change_notification(spark, sf):
    prev, cur = _snapshots(spark, sf)
    s = D.change_summary(D.diff_chunks(prev, cur), _crawl_sites(spark, sf))
    return K.change_notification(s, "Change tracker")


def _fake_embed(texts):
    """Deterministic stand-in embedder: code points of the first and last character, and the number of blanks."""
    return [[float(ord(t[0])), float(ord(t[-1])), float(t.count(" "))] if t else [0.0, 0.0, 0.0] for t in texts]


class _NoStore:
    """Takes everything."""

    def upsert(self, batch_id, ids, documents, metadatas):
        pass

    def delete(self, batch_id, ids):
        pass


@query("store_ledger")
def store_ledger(spark, sf):
    """The change rows sent to a store through the outbox; what its ledger records, by route."""
    ledger = deliver(spark, _changes(spark, sf, whole=True), f"{ensure_checkpoint_dir(spark)}/outbox-{uuid.uuid4().hex}", _NoStore)
    return ledger.groupBy("route").agg(F.sum("rows").alias("rows"))


@query("embed_changes")
def embed_changes(spark, sf):
    e = N.embed_changes(_changes(spark, sf), _fake_embed)
    return e.select("start_url", "chunk_id", F.array_join(F.transform("embedding", lambda x: x.cast("string")), ",")
                    .alias("embedding"))


@query("index_rows_json_embedding")
def index_rows_json_embedding(spark, sf):
    e = N.embed_changes(_changes(spark, sf), _fake_embed)
    return K.index_rows_json_embedding(e).select(
        "start_url", "chunk_id", "document", "metadata", F.array_join(F.transform("embedding", lambda x: x.cast("string")), ",")
        .alias("embedding"))


@query("index_rows_vector_item")
def index_rows_vector_item(spark, sf):
    e = N.embed_changes(_changes(spark, sf), _fake_embed)
    return K.index_rows_vector_item(e, "ns").select("start_url", F.to_json("item").alias("item"), "namespace")


# --- enrichment -------------------------------------------------------------------

@query("removed_labels")
def removed_labels(spark, sf):
    return N.removed_labels(_changes(spark, sf)).withColumn("tags", F.array_join("tags", ","))


@query("enrich_prompts")
def enrich_prompts(spark, sf):
    return N.enrich_prompts(_changes(spark, sf))


@query("enrich_requests_chat")
def enrich_requests_chat(spark, sf):
    return N.enrich_requests_chat(_changes(spark, sf), model="summary-model", system_prompt=I.SYSTEM_PROMPT)


@query("enrich_requests_messages")
def enrich_requests_messages(spark, sf):
    return N.enrich_requests_messages(_changes(spark, sf), model="summary-model", system_prompt=I.SYSTEM_PROMPT)


def _responses(changes: DataFrame) -> DataFrame:
    """Model answers as an API would return them: chat form for added, messages form for
    modified, and a non-JSON answer for removed rows (the parse-error path)."""
    inner = F.concat(F.lit('{"summary": "Changed '), F.col("chunk_id"), F.lit('", "tags": ["'),
                     F.col("change_type"), F.lit('"]}'))
    esc = F.replace(inner, F.lit('"'), F.lit('\\"'))
    chat = F.concat(F.lit('{"choices": [{"message": {"content": "'), esc, F.lit('"}}]}'))
    msgs = F.concat(F.lit('{"content": [{"type": "text", "text": "'), esc, F.lit('"}]}'))
    bad = F.lit('{"content": [{"type": "text", "text": "no json here"}]}')
    resp = (F.when(F.col("change_type") == "added", chat).when(F.col("change_type") == "modified", msgs)
            .otherwise(bad))
    return changes.select("start_url", "chunk_id", "change_type", resp.alias("response"))


@query("enrich_parsed")
def enrich_parsed(spark, sf):
    p = N.enrich_parsed(_responses(_changes(spark, sf)))
    return p.select("start_url", "chunk_id", "change_type", "summary", F.array_join("tags", ",").alias("tags"), "parse_error")


def _summarize(rec):
    words = rec["text"].split()
    return f"{len(words)} words under {rec['heading_path_text']}", ["words", rec["change_type"]]


@query("enrich_changes")
def enrich_changes(spark, sf):
    e = N.enrich_changes(_changes(spark, sf), _summarize)
    return e.withColumn("tags", F.array_join("tags", ","))


# --- rendering ----------------------------------------------------------------------

def _kept_pages(spark, sf):
    return E.pipeline_pages(_all(spark, sf))


def _stored_pages(spark, sf):
    """The kept pages written once, for queries that read them twice."""
    pages = _kept_pages(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/pages-{uuid.uuid4().hex}"
    pages.write.parquet(path)
    return spark.read.schema(pages.schema).parquet(path)


@query("llms_index")
def llms_index(spark, sf):
    return R.llms_index(_kept_pages(spark, sf), _sites(spark, sf))


@query("llms_full")
def llms_full(spark, sf):
    return R.llms_full(_stored_pages(spark, sf))


def _chunk_job(spark, sf) -> dict:
    return J.run_chunk_job(spark, _all(spark, sf), f"{ensure_checkpoint_dir(spark)}/job-{uuid.uuid4().hex}")


@query("job_chunk_lines")
def job_chunk_lines(spark, sf):
    """The chunk job's JSON lines, read back from its folder."""
    return spark.read.text(_chunk_job(spark, sf)["chunks_jsonl"]).select(F.col("value").alias("line"))


@query("job_site_index")
def job_site_index(spark, sf):
    """The lines of the chunk job's index text of every site, read back."""
    return spark.read.schema("value string, site_key string").text(_chunk_job(spark, sf)["site_index_txt"]).select("site_key", F.col("value").alias("line"))


# --- quality ------------------------------------------------------------------------

def _yield(spark, sf):
    pages = E.extract_pages(_all(spark, sf))
    return A.site_yield(pages, _sites(spark, sf))


@query("site_yield")
def site_yield(spark, sf):
    return _yield(spark, sf)


@query("site_low_yield")
def site_low_yield(spark, sf):
    return _yield(spark, sf).where("likely_js").select("site", "rate")


@query("overall_yield")
def overall_yield(spark, sf):
    return A.overall_yield(_yield(spark, sf))


@query("site_counts")
def site_counts(spark, sf):
    pages = _stored_pages(spark, sf)
    return A.site_counts(pages, C.chunk_pages(pages))


def _events_as_changes(spark, sf):
    """Change-shaped rows from the event stream, with the type taken from the event kind."""
    ev = table(spark, sf, "events")
    kind = (F.when(F.col("event_type") == "view", "added").when(F.col("event_type") == "click", "modified")
            .when(F.col("event_type") == "error", "removed").otherwise(F.col("event_type")))
    return ev.select(F.col("event_id"), kind.alias("change_type"),
                     F.concat(F.lit("events/"), F.col("event_id").cast("string")).alias("chunk_id"),
                     F.concat(F.lit("https://shop.example.com/u/"), F.col("user_id").cast("string")).alias("url"),
                     F.array(F.col("event_type")).alias("heading_path"), F.col("props").alias("text"),
                     F.when(F.col("value") >= 0, F.concat(F.lit("sha256:"), F.sha2("props", 256)))
                     .otherwise(F.lit("md5")).alias("chunk_hash"))


def _all_chunks(spark, sf):
    """Chunks of every page and every ledger line."""
    return C.chunk_pages(E.extract_pages(_all(spark, sf))).unionByName(I.ledger_chunks(spark, sf, "all"))


@query("contract_violations")
def contract_violations(spark, sf):
    chunks = _all_chunks(spark, sf)
    chunks = _violations(chunks.withColumn("key", F.col("chunk_id")), CHUNK, "key")
    events = _violations(_events_as_changes(spark, sf).withColumn("key", F.col("chunk_id")), CHANGE, "key")
    return chunks.unionByName(events)


@query("record_violations")
def record_violations(spark, sf):
    """JSON lines of the conversation chunks, some of them damaged, against the chunk contract."""
    c = C.chunk_pages(I.conversation_pages(spark, sf))
    value = F.to_json(F.struct(*CHUNK.fieldNames()))
    page = F.col("page_seq")
    value = F.when(page % 5 == 0, F.replace(value, F.lit('"token_estimate":'), F.lit('"token_estimates":'))).otherwise(value)
    value = F.when(page % 7 == 1, F.replace(value, F.concat(F.lit('"order":'), F.col("order").cast("string"), F.lit("}")), F.lit('"order":"last"}'))).otherwise(value)
    value = F.when(page % 11 == 2, F.replace(value, F.concat(F.lit('"chunk_hash":"'), F.col("chunk_hash"), F.lit('"')), F.lit('"chunk_hash":null'))).otherwise(value)
    lines = c.select("page_seq", "chunk_id", value.alias("value"))
    lines = lines.withColumn("value", F.when(F.col("page_seq") % 13 == 3, F.substring("value", F.lit(1), F.length("value") - 1)).otherwise(F.col("value")))
    return _record_violations(lines, CHUNK)


@query("duplicate_chunk_ids")
def duplicate_chunk_ids(spark, sf):
    return D.duplicate_chunk_ids(_all_chunks(spark, sf))


@query("change_audit")
def change_audit(spark, sf):
    """The change rows of two stored runs, some of them spoilt, against the runs."""
    state, commit, previous, changes = _digest_changes(spark, sf)
    part = F.pmod(F.length("chunk_id"), F.lit(9))
    spoilt = changes.withColumn("change_type", F.when(part == 3, F.lit("removed")).when(part == 5, F.lit("modified")).otherwise(F.col("change_type"))) \
        .withColumn("chunk_hash", F.when(part == 7, F.lit("sha256:0")).otherwise(F.col("chunk_hash")))
    return D.change_audit(spoilt, state.winners(previous), state.staged_winners(commit))


@query("run_id_set_diff")
def run_id_set_diff(spark, sf):
    prev, cur = _snapshots(spark, sf)
    return D.run_id_set_diff(prev, cur)


# --- discovery --------------------------------------------------------------------------

from ..operators import discover as X  # noqa: E402
from ..sources import discovery as SD  # noqa: E402


@query("sitemap_urls")
def sitemap_urls(spark, sf):
    return SD.sitemap_urls(I.crawl_sitemaps(spark, sf))


@query("robots_rules")
def robots_rules(spark, sf):
    return SD.robots_rules(I.crawl_robots(spark, sf), I.CRAWL_AGENT)


@query("page_links")
def page_links(spark, sf):
    return X.page_links(I.crawl_pages(spark, sf))


@query("links_resolved")
def links_resolved(spark, sf):
    return X.links_resolved(X.page_links(I.crawl_pages(spark, sf)))


@query("urls_defragged")
def urls_defragged(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.defrag("url").alias("url"))


@query("links_same_host")
def links_same_host(spark, sf):
    return X.site_links(I.crawl_pages(spark, sf))


def _site_urls(spark, sf):
    p = I.crawl_pages(spark, sf)
    return p.select("start_url", "url").unionByName(p.select("start_url", F.col("start_url").alias("url")))


@query("pages_glob_filtered")
def pages_glob_filtered(spark, sf):
    return X.pages_glob_filtered(_site_urls(spark, sf), I.crawl_sites(spark, sf))


@query("pages_robots_filtered")
def pages_robots_filtered(spark, sf):
    rules = SD.robots_rules(I.crawl_robots(spark, sf), I.CRAWL_AGENT)
    return X.robots_allowed(_site_urls(spark, sf), rules)


@query("links_first_seen")
def links_first_seen(spark, sf):
    """One expansion from every fetched page at once (seq = page id): the new URLs and their rank."""
    p = I.crawl_pages(spark, sf).where(F.col("status") == 200)
    front = p.select("start_url", "url", F.col("page_id").alias("seq"), F.lit(0).alias("depth"))
    seen = p.select("start_url", "url")
    nxt = X.links_first_seen(front, I.crawl_links(spark, sf), seen)
    return nxt.select("start_url", "url", "depth", F.col("rank.seq").alias("from_seq"),
                      F.col("rank.pos").alias("from_pos"))


@query("fetch_log_resolved")
def fetch_log_resolved(spark, sf):
    return X.fetch_log_resolved(I.fetch_log(spark, sf))


def _bfs(spark, sf, sitemap: bool, robots: bool = True, caps: bool = True):
    sites = I.crawl_sites(spark, sf)
    if not caps:
        sites = sites.withColumn("max_pages", F.lit(None).cast("int"))
    rules = SD.robots_rules(I.crawl_robots(spark, sf), I.CRAWL_AGENT) if robots else None
    sm = SD.sitemap_urls(I.crawl_sitemaps(spark, sf)) if sitemap else None
    return X.site_bfs(I.crawl_responses(spark, sf), I.crawl_links(spark, sf), sites, rules, sm)


@query("site_bfs_depth")
def site_bfs_depth(spark, sf):
    """Link walk of every site (robots and globs on, no cap, no sitemap)."""
    return _bfs(spark, sf, sitemap=False, caps=False)


@query("site_bfs_with_sitemap")
def site_bfs_with_sitemap(spark, sf):
    """Link walk, then sitemap orphans (no cap)."""
    return _bfs(spark, sf, sitemap=True, caps=False)


@query("site_page_cap")
def site_page_cap(spark, sf):
    b = _bfs(spark, sf, sitemap=False)
    return b.groupBy("start_url").agg(F.count(F.lit(1)).alias("pages"), F.max("seq").alias("last_seq"))
