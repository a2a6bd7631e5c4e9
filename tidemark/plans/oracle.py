"""DuckDB SQL for each registered query (the independent oracle).

Written separately from the Spark plans: chunking here works line by line
with window functions, where the Spark operator cuts sections out of the
line array in place.  The derived inputs restate :mod:`tidemark.plans.inputs`.
"""

from __future__ import annotations

from . import sqlfn as Q
from .inputs import CUR_RUN_AT, PREV_RUN_AT

NL2 = "chr(10) || chr(10)"
SQL: dict[str, str] = {}


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    """CTE chain; those that several later ones read are computed once."""
    once = {"prev_chunks", "cur_chunks", "prev_lw", "cur_lw", "changes", "kept", "links", "rules", "walk", "web", "md_pages", "all_chunks"}
    return "WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in once else ''}({s})" for n, s in ctes) + "\n" + final


# --- derived inputs ----------------------------------------------------------

def raw_pages_sql(version: str) -> str:
    if version == "prev":
        html, where, fail, fetched = "html", "page_id % 10 <> 0", 23, PREV_RUN_AT
    else:
        h7 = ("CASE WHEN page_id % 7 = 0 THEN replace(html, '</article>', "
              "'<p>Revised note for page ' || CAST(page_id AS VARCHAR) || '.</p></article>') ELSE html END")
        html = (f"CASE WHEN page_id % 11 = 0 THEN replace({h7}, '</p><p>', "
                f"{Q.lit('</p>' + chr(10) + '   ' + chr(10) + '<p>')}) ELSE {h7} END")
        where, fail, fetched = "page_id % 10 <> 1" if version == "cur" else "true", 29, CUR_RUN_AT
    return (f"SELECT {Q.site_start_url('url')} AS start_url, page_id AS page_seq, url, {html} AS raw_html, "
            f"CAST(CASE WHEN page_id % 17 = 0 THEN 404 WHEN page_id % {fail} = 0 THEN 500 ELSE 200 END AS INTEGER)"
            f" AS status, '{fetched}' AS fetched_at, CAST(page_id % 4 AS INTEGER) AS depth "
            f"FROM pages WHERE {where}")


CONVERSATION_PAGES = (
    "SELECT 'https://chat.example.com/' AS start_url, conv_id AS page_seq, "
    "'https://chat.example.com/c/' || CAST(conv_id AS VARCHAR) AS url, "
    f"'# Conversation ' || CAST(conv_id AS VARCHAR) || {NL2} || "
    f"coalesce(string_agg('## ' || role || {NL2} || text, {NL2} ORDER BY turn), '') AS markdown "
    "FROM conversations GROUP BY conv_id"
)

ACCOUNT_PAGES = (
    "SELECT 'https://accounts.example.com/' AS start_url, c_custkey AS page_seq, "
    "'https://accounts.example.com/' || lower(r_name) || '/' || CAST(c_custkey AS VARCHAR) AS url, "
    f"'Account ' || CAST(c_custkey AS VARCHAR) || {NL2} || '# ' || r_name || {NL2} || '## ' || n_name "
    f"|| {NL2} || '#### ' || c_mktsegment || {NL2} || c_name || ' balance ' "
    "|| CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) || ' cents' AS markdown "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)


def ledger_sql(version: str) -> str:
    if version == "prev":
        where, status = "l_shipdate < TIMESTAMP '1998-01-01'", "'O'"
    else:
        where, status = "l_discount < 0.1" if version == "cur" else "true", "l_linestatus"
    text = ("('Part ' || CAST(l_partkey AS VARCHAR) || ' from supplier ' || CAST(l_suppkey AS VARCHAR) || ': ' "
            "|| CAST(CAST(round(l_quantity * 100) AS BIGINT) AS VARCHAR) || ' hundredths, status ' "
            f"|| {status} || '.')")
    ok, ln = "CAST(l_orderkey AS VARCHAR)", "CAST(l_linenumber AS VARCHAR)"
    host = "(lower(l_returnflag) || '.ledger.example.com')"
    return (f"SELECT 'https://' || {host} || '/' AS start_url, l_orderkey AS page_seq, "
            f"{host} || '/orders/' || {ok} || '#line-' || {ln} AS chunk_id, "
            f"'https://' || {host} || '/orders/' || {ok} AS url, "
            f"'Order ' || {ok} || ' > ' || 'Line ' || {ln} AS heading_path, {text} AS text, "
            f"CAST(len(string_split({text}, ' ')) AS INTEGER) AS token_estimate, "
            f"{Q.sha256_hex(text)} AS chunk_hash, CAST(l_linenumber - 1 AS INTEGER) AS \"order\" "
            f"FROM lineitem WHERE {where}")


# --- operators as CTE chains -------------------------------------------------

def extract_ctes(src: str, p: str) -> list[tuple[str, str]]:
    """CTEs ``{p}_code``, ``{p}_md``, ``{p}`` (PAGE columns + start_url, page_seq)."""
    return [
        (f"{p}_code", f"SELECT *, {Q.strip_code('raw_html')} AS _code FROM {src}"),
        (f"{p}_frag", f"SELECT *, {Q.main_fragment_from_code('_code')} AS _frag FROM {p}_code"),
        (f"{p}_md0", f"SELECT *, {Q.fragment_to_markdown('_frag')} AS _md FROM {p}_frag"),
        (f"{p}_md", f"SELECT *, CASE WHEN _md = '' THEN {Q.fragment_to_markdown('_code', links=True)} ELSE _md END AS markdown "
                    f"FROM {p}_md0"),
        (p, f"SELECT url, {Q.page_title('raw_html', 'markdown')} AS title, markdown, "
            f"{Q.sha256_hex('markdown')} AS content_hash, fetched_at, status, depth, start_url, page_seq "
            f"FROM {p}_md"),
    ]


def chunk_ctes(src: str, p: str) -> list[tuple[str, str]]:
    """Line-wise chunking of ``src(start_url, page_seq, url, markdown)`` into CTE ``{p}``."""
    part = "PARTITION BY start_url, page_seq"
    levels = range(1, 7)
    on_stack = []
    for k in levels:
        conds = [f"s{k} IS NOT NULL"] + [f"(s{j} IS NULL OR s{j} < s{k})" for j in range(1, k)]
        on_stack.append(f"CASE WHEN {' AND '.join(conds)} THEN h{k} END AS e{k}")
    return [
        (f"{p}_lines", f"SELECT start_url, page_seq, url, unnest(string_split(markdown, chr(10))) AS line, "
                       f"generate_subscripts(string_split(markdown, chr(10)), 1) AS ln FROM {src}"),
        (f"{p}_hl", f"SELECT *, {Q.heading_level('line')} AS level, {Q.heading_text('line')} AS heading "
                    f"FROM {p}_lines"),
        (f"{p}_hs", f"SELECT *, sum(CASE WHEN level > 0 THEN 1 ELSE 0 END) OVER ({part} ORDER BY ln "
                    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::INTEGER AS sec FROM {p}_hl"),
        (f"{p}_sec", f"SELECT start_url, page_seq, any_value(url) AS url, sec, CAST(max(level) AS INTEGER) AS level, "
                     f"coalesce(max(heading) FILTER (WHERE level > 0), '') AS heading, "
                     f"coalesce(string_agg(line, chr(10) ORDER BY ln) FILTER (WHERE level = 0), '') AS body "
                     f"FROM {p}_hs GROUP BY start_url, page_seq, sec"),
        (f"{p}_bc", "SELECT *, " + ", ".join(
            f"max(CASE WHEN level = {k} THEN sec END) OVER w AS s{k}, "
            f"last_value(CASE WHEN level = {k} THEN heading END IGNORE NULLS) OVER w AS h{k}" for k in levels)
         + f" FROM {p}_sec WINDOW w AS ({part} ORDER BY sec ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
        (f"{p}_st", f"SELECT start_url, page_seq, url, sec, level, heading, {Q.normalize('body')} AS text, "
                    + ", ".join(on_stack) + f" FROM {p}_bc"),
        (f"{p}_ne", f"SELECT *, concat_ws(' > ', e1, e2, e3, e4, e5, e6) AS heading_path, "
                    f"{Q.chunk_id_base('url')} || '#' || coalesce(nullif(concat_ws('.', "
                    + ", ".join(f"CASE WHEN e{k} IS NULL THEN NULL ELSE {Q.slug(f'e{k}')} END" for k in levels)
                    + f"), ''), 'root') AS base FROM {p}_st WHERE text <> ''"),
        (p, f"SELECT start_url, page_seq, CASE WHEN row_number() OVER ({part}, base ORDER BY sec) = 1 THEN base "
            f"ELSE base || '-' || CAST(row_number() OVER ({part}, base ORDER BY sec) - 1 AS VARCHAR) END "
            f"AS chunk_id, url, heading_path, text, {Q.token_estimate('text')} AS token_estimate, "
            f"{Q.sha256_hex('text')} AS chunk_hash, "
            f"CAST(row_number() OVER ({part} ORDER BY sec) - 1 AS INTEGER) AS \"order\" FROM {p}_ne"),
    ]


def last_wins_ctes(src: str, p: str) -> list[tuple[str, str]]:
    """``{p}``: one row per (start_url, chunk_id): last value, first position."""
    w = "PARTITION BY start_url, chunk_id"
    return [(f"{p}_r", f"SELECT *, row_number() OVER ({w} ORDER BY page_seq DESC, \"order\" DESC, chunk_hash DESC, url DESC, heading_path DESC) AS _rn, "
                       f"first_value(page_seq) OVER ({w} ORDER BY page_seq, \"order\") AS pos_seq, "
                       f"first_value(\"order\") OVER ({w} ORDER BY page_seq, \"order\") AS pos_order FROM {src}"),
            (p, f"SELECT start_url, chunk_id, url, heading_path, text, chunk_hash, pos_seq, pos_order "
                f"FROM {p}_r WHERE _rn = 1")]


def diff_final(prev: str, cur: str) -> str:
    return (
        "SELECT coalesce(c.start_url, p.start_url) AS start_url, "
        "CASE WHEN p.chunk_id IS NULL THEN 'added' WHEN c.chunk_id IS NULL THEN 'removed' ELSE 'modified' END "
        "AS change_type, coalesce(c.chunk_id, p.chunk_id) AS chunk_id, "
        + ", ".join(f"CASE WHEN c.chunk_id IS NOT NULL THEN c.{n} ELSE p.{n} END AS {n}"
                    for n in ("url", "heading_path", "text", "chunk_hash"))
        + ", CASE WHEN c.chunk_id IS NOT NULL THEN 0 ELSE 1 END AS change_side, "
        "CASE WHEN c.chunk_id IS NOT NULL THEN c.pos_seq ELSE p.pos_seq END AS pos_seq, "
        "CASE WHEN c.chunk_id IS NOT NULL THEN c.pos_order ELSE p.pos_order END AS pos_order "
        f"FROM {cur} c FULL OUTER JOIN {prev} p ON c.start_url = p.start_url AND c.chunk_id = p.chunk_id "
        "WHERE p.chunk_id IS NULL OR c.chunk_id IS NULL OR c.chunk_hash <> p.chunk_hash"
    )


def web_chunk_ctes(version: str, p: str) -> list[tuple[str, str]]:
    """raw pages -> status 200 -> extract -> chunk, as CTE ``{p}`` (heading_path as text)."""
    return ([(f"{p}_raw", raw_pages_sql(version) + " AND " + _status_ok(version))]
            + extract_ctes(f"{p}_raw", f"{p}_pg")
            + chunk_ctes(f"{p}_pg", p))


def _status_ok(version: str) -> str:
    fail = 23 if version == "prev" else 29
    return f"page_id % 17 <> 0 AND page_id % {fail} <> 0"


def snapshot_ctes() -> list[tuple[str, str]]:
    cols = "start_url, page_seq, chunk_id, url, heading_path, text, token_estimate, chunk_hash, \"order\""
    return (web_chunk_ctes("prev", "wp") + web_chunk_ctes("cur", "wc")
            + [("lp", ledger_sql("prev")), ("lc", ledger_sql("cur")),
               ("prev_chunks", f"SELECT {cols} FROM wp UNION ALL SELECT {cols} FROM lp"),
               ("cur_chunks", f"SELECT {cols} FROM wc UNION ALL SELECT {cols} FROM lc")]
            + last_wins_ctes("prev_chunks", "prev_lw") + last_wins_ctes("cur_chunks", "cur_lw"))


def md_pages_ctes() -> list[tuple[str, str]]:
    return ([("cur_raw", raw_pages_sql("all"))]
            + extract_ctes("cur_raw", "web")
            + [("conv", CONVERSATION_PAGES), ("acct", ACCOUNT_PAGES),
               ("md_pages", "SELECT start_url, page_seq, url, markdown FROM web UNION ALL "
                            "SELECT start_url, page_seq, url, markdown FROM conv UNION ALL "
                            "SELECT start_url, page_seq, url, markdown FROM acct")])


# --- registered oracles -------------------------------------------------------

SQL["normalize_text"] = f"SELECT doc_id, {Q.normalize('text')} AS normalized FROM documents"
SQL["text_hash"] = f"SELECT doc_id, {Q.text_hash('text')} AS text_hash FROM documents"
SQL["token_estimate"] = f"SELECT doc_id, {Q.token_estimate('text')} AS token_estimate FROM documents"

SQL["scan_raw_pages"] = with_([("r", raw_pages_sql("all"))],
                              "SELECT url, raw_html, status, fetched_at, depth FROM r")
SQL["page_markdown"] = with_(
    [("r", raw_pages_sql("all"))],
    f"SELECT page_seq, url, {Q.fragment_to_markdown(Q.main_fragment_from_code(Q.strip_code('raw_html')))} "
    "AS markdown FROM r")
SQL["page_markdown_fallback"] = with_(
    [("r0", raw_pages_sql("all")),
     ("r", "SELECT start_url, page_seq, url, status, fetched_at, depth, '<html><body>' || "
           f"{Q.rx('raw_html', r'(?is)<nav\b.*?</nav>')} || {Q.rx('raw_html', r'(?is)<footer\b.*?</footer>')}"
           " || '</body></html>' AS raw_html FROM r0")] + extract_ctes("r", "pg"),
    "SELECT page_seq, url, markdown FROM pg")
SQL["page_title"] = with_([("r", raw_pages_sql("all"))] + extract_ctes("r", "pg"),
                          "SELECT page_seq, url, title FROM pg")
SQL["page_content_hash"] = with_([("r", raw_pages_sql("all"))] + extract_ctes("r", "pg"),
                                 "SELECT page_seq, url, content_hash FROM pg")
SQL["extract_pages"] = with_([("r", raw_pages_sql("all"))] + extract_ctes("r", "pg"),
                             "SELECT url, title, markdown, content_hash, fetched_at, status, depth, page_seq FROM pg")
SQL["pages_ok"] = with_([("r", raw_pages_sql("all"))], "SELECT page_seq, url, status FROM r WHERE status = 200")
SQL["pages_nonblank"] = with_([("r", raw_pages_sql("all") + " AND " + _status_ok("all"))] + extract_ctes("r", "pg"),
                              "SELECT page_seq, url, title, content_hash FROM pg WHERE markdown <> ''")

_HEADING_LINES = with_(
    [("conv", CONVERSATION_PAGES), ("acct", ACCOUNT_PAGES),
     ("p", "SELECT start_url, page_seq, markdown FROM conv UNION ALL SELECT start_url, page_seq, markdown FROM acct"),
     ("l", "SELECT start_url, page_seq, unnest(string_split(markdown, chr(10))) AS line, "
           "CAST(generate_subscripts(string_split(markdown, chr(10)), 1) - 1 AS INTEGER) AS line_no FROM p")],
    "SELECT * FROM l")
SQL["markdown_headings"] = (
    f"SELECT start_url, page_seq, line_no, level, heading FROM (SELECT start_url, page_seq, line_no, "
    f"CAST({Q.heading_level('line')} AS INTEGER) AS level, {Q.heading_text('line')} AS heading FROM ({_HEADING_LINES})) WHERE level > 0")
SQL["heading_slugs"] = (
    f"SELECT start_url, page_seq, line_no, {Q.slug(Q.heading_text('line'))} AS slug FROM ({_HEADING_LINES}) "
    f"WHERE {Q.heading_level('line')} > 0")

_CHUNKS = md_pages_ctes() + chunk_ctes("md_pages", "ch")
SQL["markdown_sections"] = with_(
    md_pages_ctes() + chunk_ctes("md_pages", "ch"),
    "SELECT start_url, page_seq, sec, level, heading, text FROM ch_st WHERE text <> ''")
SQL["section_breadcrumbs"] = with_(_CHUNKS, "SELECT start_url, page_seq, \"order\", heading_path FROM ch")
SQL["chunk_id_base"] = f"SELECT page_id, {Q.chunk_id_base('url')} AS id_base FROM pages"
SQL["chunk_ids"] = with_(_CHUNKS, "SELECT start_url, page_seq, \"order\", chunk_id FROM ch")
SQL["chunk_order"] = with_(_CHUNKS, "SELECT start_url, page_seq, \"order\", chunk_hash FROM ch")
SQL["chunk_pages"] = with_(_CHUNKS, "SELECT * FROM ch")

SQL["diff_chunks"] = with_(snapshot_ctes(), diff_final("prev_lw", "cur_lw"))
SQL["diff_added"] = with_(snapshot_ctes(), "SELECT start_url, chunk_id, chunk_hash FROM cur_lw c WHERE NOT EXISTS "
                          "(SELECT 1 FROM prev_lw p WHERE p.start_url = c.start_url AND p.chunk_id = c.chunk_id)")
SQL["diff_removed"] = with_(snapshot_ctes(), "SELECT start_url, chunk_id, chunk_hash FROM prev_lw p WHERE NOT EXISTS "
                            "(SELECT 1 FROM cur_lw c WHERE p.start_url = c.start_url AND p.chunk_id = c.chunk_id)")
SQL["diff_modified"] = with_(snapshot_ctes(), "SELECT c.start_url, c.chunk_id, c.chunk_hash FROM cur_lw c JOIN prev_lw p "
                             "ON p.start_url = c.start_url AND p.chunk_id = c.chunk_id WHERE c.chunk_hash <> p.chunk_hash")
_CHANGES = snapshot_ctes() + [
    ("changes", diff_final("prev_lw", "cur_lw")),
    ("runs", f"SELECT start_url FROM ({raw_pages_sql('prev')}) UNION SELECT start_url FROM ({raw_pages_sql('cur')}) "
             f"UNION SELECT start_url FROM ({ledger_sql('prev')}) UNION SELECT start_url FROM ({ledger_sql('cur')})")]
SQL["change_summary"] = with_(
    _CHANGES,
    "SELECT r.start_url, CAST(count(c.change_type) FILTER (WHERE c.change_type = 'added') AS BIGINT) AS added, "
    "CAST(count(c.change_type) FILTER (WHERE c.change_type = 'modified') AS BIGINT) AS modified, "
    "CAST(count(c.change_type) FILTER (WHERE c.change_type = 'removed') AS BIGINT) AS removed "
    "FROM runs r LEFT JOIN changes c ON r.start_url = c.start_url GROUP BY r.start_url")
SQL["diff_ordered"] = with_(
    _CHANGES, "SELECT start_url, row_number() OVER (PARTITION BY start_url ORDER BY change_side, pos_seq, pos_order, chunk_id) AS seq, "
              "change_type, chunk_id, url, heading_path, text, chunk_hash FROM changes")
SQL["changed_chunk_count"] = with_(_CHANGES, "SELECT count(*) AS changed_chunks FROM changes")


# --- state, sinks, delivery, enrichment, rendering, quality ---------------------------

from .inputs import SYSTEM_PROMPT  # noqa: E402

_SITES = f"SELECT DISTINCT {Q.site_start_url('url')} AS start_url FROM pages"
_SITE_KEY = "substr(sha256(start_url), 1, 16)"
SQL["state_key"] = (f"SELECT start_url, {_SITE_KEY} AS site_key, 'state-' || {_SITE_KEY} AS kv_key "
                    f"FROM ({_SITES})")

_SNAP = snapshot_ctes() + [("snap", f"SELECT *, {_SITE_KEY} AS site_key, '{PREV_RUN_AT}' AS run_at FROM prev_chunks "
                                    f"UNION ALL SELECT *, {_SITE_KEY} AS site_key, '{CUR_RUN_AT}' AS run_at "
                                    "FROM cur_chunks")]
SQL["state_load_latest"] = with_(
    _SNAP + [("latest", "SELECT start_url, max(run_at) AS run_at FROM snap GROUP BY start_url")],
    "SELECT s.start_url, s.site_key, s.run_at AS prev_run_at, s.chunk_id, s.chunk_hash, s.page_seq, s.\"order\" "
    "FROM snap s JOIN latest l ON s.start_url = l.start_url AND s.run_at = l.run_at")
SQL["state_previous_run"] = with_(
    _SNAP + [("latest", f"SELECT start_url, max(run_at) AS run_at FROM snap WHERE run_at < '{CUR_RUN_AT}' "
                        "GROUP BY start_url")],
    "SELECT s.start_url, s.run_at AS prev_run_at, s.chunk_id, s.chunk_hash "
    "FROM snap s JOIN latest l ON s.start_url = l.start_url AND s.run_at = l.run_at")

SQL["state_round_trip"] = with_(
    snapshot_ctes(), f"SELECT start_url, '{PREV_RUN_AT}' AS run_at, page_seq, chunk_id, url, heading_path, text, chunk_hash, \"order\" FROM prev_chunks")

SQL["state_two_jobs"] = with_(
    snapshot_ctes(), f"SELECT start_url, '{PREV_RUN_AT}' AS run_at, count(*) AS chunks, count(DISTINCT chunk_id) AS ids, "
                     "CAST(sum(length(text)) AS BIGINT) AS letters FROM prev_chunks GROUP BY start_url")
SQL["diff_by_digests"] = SQL["diff_chunks"]
SQL["run_manifest"] = with_(
    _CHANGES + [("ps", f"SELECT start_url, '{PREV_RUN_AT}' AS prev_run_at FROM prev_chunks GROUP BY start_url"),
                ("cs", "SELECT start_url, count(*) AS chunks, count(DISTINCT chunk_id) AS ids FROM cur_chunks GROUP BY start_url"),
                ("every", "SELECT start_url FROM ps UNION SELECT start_url FROM cs"),
                ("counts", "SELECT start_url, " + ", ".join(f"count(*) FILTER (WHERE change_type = '{t}') AS {t}" for t in ("added", "modified", "removed"))
                 + " FROM changes GROUP BY start_url")],
    f"SELECT b.start_url, {_SITE_KEY.replace('start_url', 'b.start_url')} AS site_key, '{CUR_RUN_AT}' AS run_at, ps.prev_run_at, coalesce(cs.chunks, 0) AS chunks, coalesce(cs.ids, 0) AS ids, "
    "coalesce(n.added, 0) AS added, coalesce(n.modified, 0) AS modified, coalesce(n.removed, 0) AS removed "
    "FROM every b LEFT JOIN ps ON ps.start_url = b.start_url LEFT JOIN cs ON cs.start_url = b.start_url LEFT JOIN counts n ON n.start_url = b.start_url")

SQL["jsonl_chunks"] = with_(
    [("conv", CONVERSATION_PAGES)] + chunk_ctes("conv", "ch"),
    "SELECT CAST(json_object('chunk_id', chunk_id, 'url', url, 'heading_path', "
    "CASE WHEN heading_path = '' THEN []::VARCHAR[] ELSE string_split(heading_path, ' > ') END, "
    "'text', text, 'token_estimate', token_estimate, 'chunk_hash', chunk_hash, 'order', \"order\") AS VARCHAR) "
    "AS line FROM ch")

_RUNS = [("run_rows", f"SELECT s.start_url, '{CUR_RUN_AT}' AS run_at, p.prev_run_at FROM "
                      "(SELECT DISTINCT start_url FROM cur_chunks) s LEFT JOIN "
                      f"(SELECT DISTINCT start_url, '{PREV_RUN_AT}' AS prev_run_at FROM prev_chunks) p "
                      "ON s.start_url = p.start_url")]
SQL["changeset_document"] = with_(
    _CHANGES + _RUNS,
    "SELECT r.run_at, r.prev_run_at, r.start_url, "
    "CAST(count(c.change_type) FILTER (WHERE c.change_type = 'added') AS BIGINT) AS added, "
    "CAST(count(c.change_type) FILTER (WHERE c.change_type = 'modified') AS BIGINT) AS modified, "
    "CAST(count(c.change_type) FILTER (WHERE c.change_type = 'removed') AS BIGINT) AS removed "
    "FROM run_rows r LEFT JOIN changes c ON r.start_url = c.start_url GROUP BY r.run_at, r.prev_run_at, r.start_url")
SQL["delta_dataset"] = with_(_CHANGES, f"SELECT '{CUR_RUN_AT}' AS run_at, change_type, chunk_id, url, heading_path, "
                                       "text, chunk_hash FROM changes")
_UPS = "SELECT * FROM changes WHERE change_type IN ('added', 'modified')"
SQL["index_rows_flat"] = with_(_CHANGES, "SELECT start_url, chunk_id AS id, text AS document, url, heading_path, chunk_hash "
                                         f"FROM ({_UPS})")
SQL["index_apply_changes"] = with_(
    _CHANGES,
    "SELECT coalesce(c.start_url, p.start_url) AS start_url, coalesce(c.chunk_id, p.chunk_id) AS id, "
    + ", ".join(f"CASE WHEN c.chunk_id IS NULL THEN p.{n} ELSE c.{n} END AS {m}" for n, m in (
        ("text", "document"), ("url", "url"), ("heading_path", "heading_path"), ("chunk_hash", "chunk_hash")))
    + " FROM prev_lw p FULL OUTER JOIN changes c ON c.start_url = p.start_url AND c.chunk_id = p.chunk_id "
    "WHERE c.change_type IS NULL OR c.change_type <> 'removed'")
SQL["index_merge_stored"] = SQL["index_apply_changes"]
SQL["index_apply_counts"] = with_(
    _CHANGES, "SELECT count(*) FILTER (WHERE change_type IN ('added', 'modified')) AS upserted, "
              "count(*) FILTER (WHERE change_type = 'removed') AS deleted FROM changes")
SQL["changes_by_route"] = with_(
    _CHANGES, "SELECT start_url, chunk_id, CASE WHEN change_type IN ('added', 'modified') THEN 'upsert' ELSE 'delete' END AS route, "
              "change_type FROM changes")
_NOTE_TEXT = ("'Change tracker — ' || start_url || ': +' || CAST(added AS VARCHAR) || ' added, ~' || "
              "CAST(modified AS VARCHAR) || ' modified, -' || CAST(removed AS VARCHAR) || ' removed'")
SQL["change_notification"] = with_(
    _CHANGES + [("summ", SQL_SUMMARY := (
        "SELECT r.start_url, count(c.change_type) FILTER (WHERE c.change_type = 'added') AS added, "
        "count(c.change_type) FILTER (WHERE c.change_type = 'modified') AS modified, "
        "count(c.change_type) FILTER (WHERE c.change_type = 'removed') AS removed "
        "FROM runs r LEFT JOIN changes c ON r.start_url = c.start_url GROUP BY r.start_url"))],
    f"SELECT start_url, {_NOTE_TEXT} AS text, CAST(json_object('text', {_NOTE_TEXT}) AS VARCHAR) AS payload FROM summ")

_E = ["CAST(ord(text) AS FLOAT)", "CAST(ord(right(text, 1)) AS FLOAT)", "CAST(length(text) - length(replace(text, ' ', '')) AS FLOAT)"]
_EMB = " || ',' || ".join(f"CAST({e} AS VARCHAR)" for e in _E)
SQL["embed_changes"] = with_(_CHANGES, f"SELECT start_url, chunk_id, {_EMB} AS embedding FROM ({_UPS})")
SQL["index_rows_json_embedding"] = with_(
    _CHANGES, "SELECT start_url, chunk_id, text AS document, CAST(json_object('url', url, 'heading_path', heading_path, "
              f"'chunk_hash', chunk_hash) AS VARCHAR) AS metadata, {_EMB} AS embedding FROM ({_UPS})")
SQL["index_rows_vector_item"] = with_(
    _CHANGES, f"SELECT start_url, CAST(json_object('id', chunk_id, 'values', [{', '.join(_E)}], "
              "'metadata', json_object('url', url, 'heading_path', heading_path, 'chunk_hash', "
              f"chunk_hash, 'document', text)) AS VARCHAR) AS item, 'ns' AS namespace FROM ({_UPS})")

SQL["removed_labels"] = with_(
    _CHANGES, "SELECT start_url, chunk_id, change_type, 'Removed: ' || coalesce(nullif(heading_path, ''), chunk_id) AS summary, "
              "'removed' AS tags FROM changes WHERE change_type = 'removed'")
_PROMPT = f"'[' || change_type || '] ' || heading_path || {NL2} || text"
SQL["enrich_prompts"] = with_(_CHANGES, f"SELECT start_url, chunk_id, change_type, {_PROMPT} AS prompt FROM changes")
SQL["enrich_requests_chat"] = with_(
    _CHANGES, "SELECT start_url, chunk_id, change_type, CAST(json_object('model', 'summary-model', 'messages', json_array("
              f"json_object('role', 'system', 'content', {Q.lit(SYSTEM_PROMPT)}), "
              f"json_object('role', 'user', 'content', {_PROMPT})), 'response_format', "
              f"json_object('type', 'json_object'), 'temperature', 0) AS VARCHAR) AS request FROM ({_UPS})")
SQL["enrich_requests_messages"] = with_(
    _CHANGES, "SELECT start_url, chunk_id, change_type, CAST(json_object('model', 'summary-model', 'max_tokens', 200, "
              f"'system', {Q.lit(SYSTEM_PROMPT)}, 'messages', json_array(json_object('role', 'user', "
              f"'content', {_PROMPT}))) AS VARCHAR) AS request FROM ({_UPS})")
_INNER = ("('{\"summary\": \"Changed ' || chunk_id || '\", \"tags\": [\"' || change_type || '\"]}')")
_ESC = f"replace({_INNER}, '\"', '\\\"')"
_RESP = (f"CASE WHEN change_type = 'added' THEN '{{\"choices\": [{{\"message\": {{\"content\": \"' || {_ESC} "
         "|| '\"}}]}' WHEN change_type = 'modified' THEN '{\"content\": [{\"type\": \"text\", \"text\": \"' || "
         f"{_ESC} || '\"}}]}}' ELSE '{{\"content\": [{{\"type\": \"text\", \"text\": \"no json here\"}}]}}' END")
SQL["enrich_parsed"] = with_(
    _CHANGES + [("resp", f"SELECT start_url, chunk_id, change_type, {_RESP} AS response FROM changes"),
                ("inner_", "SELECT *, coalesce(json_extract_string(response, '$.choices[0].message.content'), "
                           "json_extract_string(response, '$.content[0].text')) AS inner_text FROM resp"),
                ("v", "SELECT *, inner_text IS NOT NULL AND regexp_matches(inner_text, '^\\s*\\{') AS ok FROM inner_")],
    "SELECT start_url, chunk_id, change_type, CASE WHEN ok THEN coalesce(json_extract_string(inner_text, '$.summary'), '') END "
    "AS summary, CASE WHEN ok THEN coalesce(array_to_string(json_extract_string(inner_text, '$.tags[*]'), ','), '') "
    "END AS tags, NOT ok AS parse_error FROM v")
SQL["enrich_changes"] = with_(
    _CHANGES, f"SELECT start_url, chunk_id, change_type, CAST({Q.token_estimate('text')} AS VARCHAR) || ' words under ' || heading_path AS summary, "
              "'words,' || change_type AS tags "
              f"FROM ({_UPS}) UNION ALL SELECT start_url, chunk_id, change_type, 'Removed: ' || "
              "coalesce(nullif(heading_path, ''), chunk_id), 'removed' FROM changes WHERE change_type = 'removed'")

_KEPT = [("kr", raw_pages_sql("all") + " AND " + _status_ok("all"))] + extract_ctes("kr", "kx") + [
    ("kept", "SELECT * FROM kx WHERE markdown <> ''"), ("sites", _SITES)]
_TITLE = f"coalesce(nullif({Q.strip_ws('title')}, ''), url)"
_HEADER = " UNION ALL ".join(
    f"SELECT start_url, 0 AS part, '' AS sort_url, CAST({i} AS BIGINT) AS sort_seq, {line} AS line FROM sites"
    for i, line in enumerate([f"'# ' || {Q.netloc('start_url')}", "''",
                              "'> LLM-ready index of documentation crawled from ' || start_url || '.'", "''",
                              "'## Pages'"]))
SQL["llms_index"] = with_(
    _KEPT, _HEADER + " UNION ALL SELECT start_url, 1, url, page_seq, '- [' || " + _TITLE + " || '](' || url || ')' "
    "FROM kept")
_BLOCK = (f"'# ' || {_TITLE} || chr(10) || '<' || url || '>' || {NL2} || {Q.strip_ws('markdown')} || chr(10)")
SQL["llms_full"] = with_(
    _KEPT + [("ranked", "SELECT *, row_number() OVER (PARTITION BY start_url ORDER BY url DESC, page_seq DESC) AS rk "
                        "FROM kept")],
    f"SELECT start_url, 1 AS part, url AS sort_url, page_seq AS sort_seq, {_BLOCK} || CASE WHEN rk = 1 THEN '' "
    f"ELSE {Q.lit(chr(10) + '---' + chr(10))} END AS record FROM ranked")

_YIELD = [("yr", raw_pages_sql("all"))] + extract_ctes("yr", "yx") + [
    ("sites", _SITES),
    ("agg", "SELECT start_url, count(*) AS fetched, count(*) FILTER (WHERE markdown <> '') AS nonempty FROM yx "
            "WHERE status = 200 GROUP BY start_url"),
    ("sy", "SELECT s.start_url AS site, CAST(coalesce(nonempty, 0) AS BIGINT) AS nonempty, "
           "CAST(coalesce(fetched, 0) AS BIGINT) AS fetched, CASE WHEN coalesce(fetched, 0) = 0 THEN 0.0 "
           "ELSE nonempty / fetched END AS rate FROM sites s LEFT JOIN agg a ON s.start_url = a.start_url"),
    ("sy2", "SELECT *, fetched > 0 AND rate < 0.5 AS likely_js FROM sy")]
SQL["site_yield"] = with_(_YIELD, "SELECT * FROM sy2")
SQL["site_low_yield"] = with_(_YIELD, "SELECT site, rate FROM sy2 WHERE likely_js")
SQL["overall_yield"] = with_(
    _YIELD, "SELECT CAST(sum(nonempty) AS BIGINT) AS nonempty, CAST(sum(fetched) AS BIGINT) AS fetched, "
            "CASE WHEN coalesce(sum(fetched), 0) = 0 THEN 0.0 ELSE sum(nonempty) / sum(fetched) END AS overall_rate, "
            "CASE WHEN coalesce(sum(fetched), 0) = 0 THEN 0.0 ELSE sum(nonempty) / sum(fetched) END >= 0.9 AS passed, "
            "count(*) FILTER (WHERE likely_js) AS likely_js_sites FROM sy2")
SQL["site_counts"] = with_(
    _KEPT + chunk_ctes("kept", "kc"),
    "SELECT coalesce(p.start_url, c.start_url) AS start_url, CAST(coalesce(p.n, 0) AS BIGINT) AS pages, "
    "CAST(coalesce(c.n, 0) AS BIGINT) AS chunks FROM (SELECT start_url, count(*) AS n FROM kept GROUP BY 1) p "
    "FULL OUTER JOIN (SELECT start_url, count(*) AS n FROM kc GROUP BY 1) c ON p.start_url = c.start_url")

_EVENTS = (
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'added' WHEN 'click' THEN 'modified' WHEN 'error' "
    "THEN 'removed' ELSE event_type END AS change_type, 'events/' || CAST(event_id AS VARCHAR) AS chunk_id, "
    "'https://shop.example.com/u/' || CAST(user_id AS VARCHAR) AS url, event_type AS heading_path, props AS text, "
    "CASE WHEN value >= 0 THEN 'sha256:' || sha256(props) ELSE 'md5' END AS chunk_hash FROM events")
_HASH_OK = "regexp_matches(chunk_hash, '^sha256:[0-9a-f]{64}$')"


def _rule_rows(src: str, rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT chunk_id AS key, '{name}' AS rule FROM {src} WHERE {cond}"
                              for name, cond in rules)


_COLS = 'start_url, page_seq, chunk_id, url, heading_path, text, token_estimate, chunk_hash, "order"'
_ALL = ([("ar", raw_pages_sql("all"))] + extract_ctes("ar", "ap") + chunk_ctes("ap", "ac")
        + [("al", ledger_sql("all")), ("all_chunks", f"SELECT {_COLS} FROM ac UNION ALL SELECT {_COLS} FROM al")])
SQL["contract_violations"] = with_(
    _ALL + [("ev", _EVENTS)],
    _rule_rows("all_chunks", [(f"{c}_not_null", f"\"{c}\" IS NULL") for c in
                              ("chunk_id", "url", "heading_path", "text", "token_estimate", "chunk_hash", "order")]
               + [("token_estimate_non_negative", "token_estimate < 0"), ("order_non_negative", "\"order\" < 0"),
                  ("chunk_hash_format", f"NOT {_HASH_OK}")])
    + " UNION ALL "
    + _rule_rows("ev", [(f"{c}_not_null", f"{c} IS NULL") for c in
                        ("change_type", "chunk_id", "url", "heading_path", "text", "chunk_hash")]
                 + [("change_type_enum", "NOT (change_type IN ('added', 'modified', 'removed'))"),
                    ("chunk_hash_format", f"NOT {_HASH_OK}")]))
SQL["chunks_last_wins"] = with_(_ALL + last_wins_ctes("all_chunks", "lw"), "SELECT * FROM lw")
SQL["diff_first_run"] = with_(
    _ALL + last_wins_ctes("all_chunks", "lw"),
    "SELECT start_url, 'added' AS change_type, chunk_id, url, heading_path, text, chunk_hash, 0 AS change_side, "
    "pos_seq, pos_order FROM lw")
SQL["diff_unchanged"] = with_(_ALL + last_wins_ctes("all_chunks", "lw"), diff_final("lw", "lw"))
_DAMAGED = "page_seq % 13 = 3"
SQL["record_violations"] = with_(
    [("conv", CONVERSATION_PAGES)] + chunk_ctes("conv", "ch") + [("whole", f"SELECT * FROM ch WHERE NOT ({_DAMAGED})")],
    f"SELECT page_seq, chunk_id, '' AS field, 'not_json' AS rule FROM ch WHERE {_DAMAGED} "
    "UNION ALL SELECT page_seq, chunk_id, 'token_estimate', 'missing' FROM whole WHERE page_seq % 5 = 0 "
    "UNION ALL SELECT page_seq, chunk_id, 'token_estimates', 'unknown' FROM whole WHERE page_seq % 5 = 0 "
    "UNION ALL SELECT page_seq, chunk_id, 'order', 'type' FROM whole WHERE page_seq % 7 = 1 "
    "UNION ALL SELECT page_seq, chunk_id, 'chunk_hash', 'null' FROM whole WHERE page_seq % 11 = 2")
SQL["job_chunk_lines"] = with_(
    _KEPT + chunk_ctes("kept", "ch"),
    "SELECT CAST(json_object('chunk_id', chunk_id, 'url', url, 'heading_path', "
    "CASE WHEN heading_path = '' THEN []::VARCHAR[] ELSE string_split(heading_path, ' > ') END, "
    "'text', text, 'token_estimate', token_estimate, 'chunk_hash', chunk_hash, 'order', \"order\") AS VARCHAR) AS line FROM ch")
SQL["job_site_index"] = with_(
    _KEPT + [("lines", _HEADER + " UNION ALL SELECT start_url, 1, url, page_seq, '- [' || " + _TITLE + " || '](' || url || ')' FROM kept")],
    f"SELECT {_SITE_KEY} AS site_key, line FROM lines")
SQL["store_ledger"] = with_(
    _CHANGES, "SELECT CASE change_type WHEN 'removed' THEN 'delete' ELSE 'upsert' END AS route, count(*) AS rows FROM changes GROUP BY 1")
SQL["duplicate_chunk_ids"] = with_(
    _ALL, "SELECT start_url, page_seq, chunk_id, count(*) AS n FROM all_chunks GROUP BY ALL HAVING count(*) > 1")
SQL["change_audit"] = with_(
    _CHANGES + [("spoilt", "SELECT start_url, chunk_id, CASE length(chunk_id) % 9 WHEN 3 THEN 'removed' WHEN 5 THEN 'modified' ELSE change_type END AS change_type, "
                           "CASE WHEN length(chunk_id) % 9 = 7 THEN 'sha256:0' ELSE chunk_hash END AS chunk_hash FROM changes")],
    "SELECT c.start_url, c.chunk_id, c.change_type, cl.chunk_hash AS cur_hash, pl.chunk_hash AS prev_hash "
    "FROM spoilt c LEFT JOIN cur_lw cl ON c.start_url = cl.start_url AND c.chunk_id = cl.chunk_id "
    "LEFT JOIN prev_lw pl ON c.start_url = pl.start_url AND c.chunk_id = pl.chunk_id WHERE NOT coalesce("
    "CASE c.change_type WHEN 'added' THEN cl.chunk_hash IS NOT NULL AND pl.chunk_hash IS NULL AND "
    "c.chunk_hash = cl.chunk_hash WHEN 'removed' THEN cl.chunk_hash IS NULL AND pl.chunk_hash IS NOT NULL AND "
    "c.chunk_hash = pl.chunk_hash WHEN 'modified' THEN cl.chunk_hash IS NOT NULL AND pl.chunk_hash IS NOT NULL "
    "AND cl.chunk_hash <> pl.chunk_hash AND c.chunk_hash = cl.chunk_hash ELSE false END, false)")
SQL["run_id_set_diff"] = with_(
    snapshot_ctes(),
    "SELECT start_url, chunk_id, 'only_current' AS side FROM (SELECT start_url, chunk_id FROM cur_chunks EXCEPT "
    "SELECT start_url, chunk_id FROM prev_chunks) UNION ALL SELECT start_url, chunk_id, 'only_previous' FROM "
    "(SELECT start_url, chunk_id FROM prev_chunks EXCEPT SELECT start_url, chunk_id FROM cur_chunks) UNION ALL "
    "SELECT k.start_url, k.chunk_id, 'hash_changed' FROM (SELECT start_url, chunk_id FROM cur_chunks INTERSECT "
    "SELECT start_url, chunk_id FROM prev_chunks) k WHERE EXISTS (SELECT 1 FROM (SELECT start_url, chunk_id, "
    "chunk_hash FROM cur_chunks EXCEPT SELECT start_url, chunk_id, chunk_hash FROM prev_chunks) d "
    "WHERE d.start_url = k.start_url AND d.chunk_id = k.chunk_id)")


# --- discovery ----------------------------------------------------------------------

from .inputs import CRAWL_AGENT  # noqa: E402

CRAWL_PAGES = (f"SELECT page_id, {Q.defrag('url')} AS url, {Q.netloc('url')} AS host, "
               f"{Q.site_start_url('url')} AS start_url, CASE WHEN page_id % 17 = 0 THEN 404 ELSE 200 END AS status, "
               "html FROM pages")
_XML_HEAD = '<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>'
CRAWL_SITEMAPS = (f"SELECT host, page_id AS part, {Q.lit(_XML_HEAD)} || replace(url, '&', '&amp;') || "
                  "'</loc></url></urlset>' AS xml FROM cp WHERE page_id % 3 = 0")
_M_ROBOTS = "User-agent: *\nDisallow: /de/\n\nUser-agent: " + CRAWL_AGENT + "\nDisallow: /fr/\nAllow: /\n"
_W_ROBOTS = "# shared rules\nUser-agent: *\nDisallow: /es/\nDisallow:\n"
CRAWL_ROBOTS = (f"SELECT host, CASE WHEN starts_with(host, 'm.') THEN {Q.lit(_M_ROBOTS)} ELSE {Q.lit(_W_ROBOTS)} "
                "END AS text FROM (SELECT DISTINCT host FROM cp) WHERE starts_with(host, 'm.') OR starts_with(host, 'www.')")
CRAWL_SITES = ("SELECT DISTINCT start_url, CASE WHEN starts_with(host, 'blog.') THEN 5 ELSE 100 END AS max_pages, "
               "NULL::VARCHAR[] AS include, CASE WHEN starts_with(host, 'www.') THEN ['*.html'] END AS exclude FROM cp")


def _xml_unescape(x: str) -> str:
    return f"replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


# the test files use plain line feeds, and plain <loc> elements
LINE_BREAKS = r"\r?\n"
LOC_PATTERN = "<loc>([^<]*)</loc>"


def link_ctes() -> list[tuple[str, str]]:
    return [
        ("cp", CRAWL_PAGES),
        ("pl", f"SELECT url AS src_url, unnest({Q.hrefs('html')}) AS href, "
               f"CAST(generate_subscripts({Q.hrefs('html')}, 1) - 1 AS INTEGER) AS pos, status FROM cp"),
        ("lr", f"SELECT src_url, pos, href, status, {Q.defrag(Q.resolve('src_url', 'href'))} AS dst_url FROM pl"),
        ("nav", f"SELECT src_url, pos, status, dst_url FROM lr WHERE {Q.netloc('dst_url')} = {Q.netloc('src_url')}"),
        ("tree", "SELECT CASE WHEN p.url IS NOT NULL THEN p.url WHEN q.page_id % 3 <> 0 THEN q.start_url END AS src_url, "
                 "CAST(q.page_id + 1000 AS INTEGER) AS pos, q.url AS dst_url FROM cp q LEFT JOIN cp p "
                 "ON q.host = p.host AND q.page_id // 2 = p.page_id"),
        ("links", "SELECT src_url, pos, dst_url FROM nav WHERE status = 200 UNION ALL SELECT * FROM tree WHERE src_url IS NOT NULL"),
    ]


def robots_ctes() -> list[tuple[str, str]]:
    split = f"regexp_split_to_array(text, {Q.lit(LINE_BREAKS)})"
    body = Q.strip_ws(Q.rr("raw", r"#.*"))
    key = f"lower({Q.strip_ws(Q.rx(body, r'^([^:]*):', 1))})"
    value = Q.strip_ws(Q.rx(body, r"(?s)^[^:]*:(.*)$", 1))
    kind = (f"CASE WHEN raw = '' THEN 'blank' WHEN NOT contains({body}, ':') THEN NULL "
            f"WHEN {key} = 'user-agent' THEN 'ua' WHEN {key} = 'allow' THEN 'allow' WHEN {key} = 'disallow' "
            f"THEN 'disallow' WHEN {key} IN ('crawl-delay', 'request-rate') THEN 'other' END")
    w = "PARTITION BY host ORDER BY ln"
    return [
        ("rb", CRAWL_ROBOTS),
        ("rl0", f"SELECT host, unnest({split}) AS raw, CAST(generate_subscripts({split}, 1) - 1 AS INTEGER) AS ln FROM rb"),
        ("rl", f"SELECT host, ln, kind, value FROM (SELECT host, ln, {kind} AS kind, {value} AS value FROM rl0) "
               "WHERE kind IS NOT NULL"),
        ("rp", f"SELECT *, last_value(CASE WHEN kind <> 'blank' THEN kind END IGNORE NULLS) OVER ({w} ROWS BETWEEN "
               "UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_kind FROM rl"),
        ("rg", f"SELECT *, sum(CASE WHEN kind = 'blank' OR (kind = 'ua' AND coalesce(prev_kind <> 'ua', false)) "
               f"THEN 1 ELSE 0 END) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM rp"),
        ("groups", "SELECT host, grp, count(*) FILTER (WHERE kind = 'ua') AS n_agents, "
                   "count(*) FILTER (WHERE kind IN ('allow', 'disallow', 'other')) AS n_rules, "
                   "bool_or(kind = 'ua' AND value = '*') AS has_star, "
                   f"bool_or(kind = 'ua' AND value <> '*' AND contains('{CRAWL_AGENT}', lower(value))) AS names_us "
                   "FROM rg GROUP BY host, grp"),
        ("chosen", "SELECT host, grp FROM (SELECT host, grp, row_number() OVER (PARTITION BY host ORDER BY has_star, grp) "
                   "AS rn FROM groups WHERE n_agents > 0 AND n_rules > 0 AND (has_star OR names_us)) WHERE rn = 1"),
        ("rules", "SELECT r.host, r.ln AS seq, r.kind = 'allow' OR r.value = '' AS allow, r.value AS path FROM rg r "
                  "JOIN chosen c ON r.host = c.host AND r.grp = c.grp WHERE r.kind IN ('allow', 'disallow')"),
    ]


SQL["sitemap_urls"] = with_(
    [("cp", CRAWL_PAGES), ("sm", CRAWL_SITEMAPS),
     ("locs", f"SELECT host, part, unnest(regexp_extract_all(xml, {Q.lit(LOC_PATTERN)}, 1)) AS raw, "
              f"CAST(generate_subscripts(regexp_extract_all(xml, {Q.lit(LOC_PATTERN)}, 1), 1) - 1 AS INTEGER) AS pos "
              "FROM sm")],
    f"SELECT host, part, pos, {Q.strip_ws(_xml_unescape('raw'))} AS url FROM locs WHERE raw <> ''")
SQL["robots_rules"] = with_([("cp", CRAWL_PAGES)] + robots_ctes(), "SELECT * FROM rules")
SQL["page_links"] = with_(link_ctes(), "SELECT src_url, pos, href FROM pl")
SQL["links_resolved"] = with_(link_ctes(), "SELECT src_url, pos, href, dst_url FROM lr")
SQL["urls_defragged"] = f"SELECT page_id, {Q.defrag('url')} AS url FROM pages"
SQL["links_same_host"] = with_(link_ctes(), "SELECT src_url, pos, dst_url FROM nav")
_SITE_URLS = "SELECT start_url, url FROM cp UNION ALL SELECT start_url, start_url AS url FROM cp"
_PATH = Q.url_path("u.url")
SQL["pages_glob_filtered"] = with_(
    [("cp", CRAWL_PAGES), ("sites", CRAWL_SITES), ("u", _SITE_URLS)],
    f"SELECT u.start_url, u.url, u.url = {Q.defrag('u.start_url')} OR "
    f"{Q.glob_ok(f'(CASE WHEN {_PATH} = {chr(39)}{chr(39)} THEN {chr(39)}/{chr(39)} ELSE {_PATH} END)', 's.include', 's.exclude')}"
    " AS allowed FROM u LEFT JOIN sites s ON u.start_url = s.start_url")
SQL["pages_robots_filtered"] = with_(
    [("cp", CRAWL_PAGES)] + robots_ctes() + [
        ("u", _SITE_URLS),
        ("v", f"SELECT d.url, arg_min(r.allow, r.seq) AS v FROM (SELECT DISTINCT url FROM u) d LEFT JOIN rules r "
              f"ON r.host = {Q.netloc('d.url')} AND starts_with({Q.url_path_and_query('d.url')}, r.path) "
              "GROUP BY d.url")],
    "SELECT u.start_url, u.url, coalesce(v.v, true) AS robots_ok FROM u LEFT JOIN v ON u.url = v.url")
SQL["links_first_seen"] = with_(
    link_ctes() + [
        ("front", "SELECT start_url, url, page_id AS seq FROM cp WHERE status = 200"),
        ("out", f"SELECT f.start_url, l.dst_url AS url, f.seq, l.pos FROM front f JOIN links l ON l.src_url = f.url "
                f"WHERE {Q.netloc('l.dst_url')} = {Q.netloc('f.start_url')}"),
        ("firsts", "SELECT start_url, url, arg_min(seq, (seq, pos)) AS from_seq, arg_min(pos, (seq, pos)) AS from_pos "
                   "FROM out GROUP BY start_url, url")],
    "SELECT start_url, url, 1 AS depth, from_seq, from_pos FROM firsts f WHERE NOT EXISTS "
    "(SELECT 1 FROM front s WHERE s.start_url = f.start_url AND s.url = f.url)")
SQL["fetch_log_resolved"] = (
    "SELECT url, arg_min(status, attempt) AS status, min(attempt) AS attempt FROM ("
    "SELECT 'https://shop.example.com/e/' || CAST(event_id // 3 AS VARCHAR) AS url, "
    "CAST(event_id % 3 + 1 AS INTEGER) AS attempt, CAST(CASE event_type WHEN 'error' THEN 503 WHEN 'view' THEN 200 "
    "WHEN 'click' THEN 302 WHEN 'purchase' THEN 404 END AS INTEGER) AS status FROM events) "
    "WHERE status < 500 OR (attempt = 3 AND status >= 500) GROUP BY url")


def walk_ctes(sitemap: bool) -> list[tuple[str, str]]:
    """``walk(start_url, url, phase, depth, path, status)``: the pages each site's crawl fetches.

    Stated by paths instead of queues: a page's place is its depth, then the
    positions of the links that lead to it, compared from the start page on.
    """
    path = Q.url_path("u.url")
    fine = (f"(u.url = {Q.defrag('s.start_url')} OR "
            f"{Q.glob_ok(f'(CASE WHEN {path} = {chr(39)}{chr(39)} THEN {chr(39)}/{chr(39)} ELSE {path} END)', 's.include', 's.exclude')})")
    step = ("SELECT e.start_url, e.url, {0} AS phase, w.depth + 1 AS depth, min(list_append(w.path, e.pos)) AS path, any_value(e.status) AS status "
            "FROM {1} w JOIN edges e ON e.start_url = w.start_url AND e.src_url = w.url WHERE w.status = 200 AND NOT EXISTS "
            "(SELECT 1 FROM recurring.{1} x WHERE x.start_url = e.start_url AND x.url = e.url){2} GROUP BY e.start_url, e.url, w.depth")
    first = [
        ("resp", "SELECT url, arg_min(status, page_id) AS status FROM cp GROUP BY url UNION ALL SELECT DISTINCT start_url, 200 FROM cp"),
        ("verdict", f"SELECT d.url, arg_min(r.allow, r.seq) AS v FROM resp d JOIN rules r ON r.host = {Q.netloc('d.url')} "
                    f"AND starts_with({Q.url_path_and_query('d.url')}, r.path) GROUP BY d.url"),
        ("fetchable", f"SELECT s.start_url, u.url, u.status FROM sites s JOIN resp u ON {Q.netloc('u.url')} = {Q.netloc('s.start_url')} "
                      f"LEFT JOIN verdict v ON v.url = u.url WHERE {fine} AND coalesce(v.v, true)"),
        ("edges", "SELECT f.start_url, l.src_url, l.pos, f.url, f.status FROM links l JOIN fetchable f ON f.url = l.dst_url"),
        ("w1", "SELECT start_url, url, 0 AS phase, 0 AS depth, [0] AS path, status FROM fetchable WHERE url = " + Q.defrag("start_url")
               + " UNION " + step.format(0, "w1", "")),
    ]
    if not sitemap:
        return [*first, ("walk", "SELECT * FROM w1")]
    seen = " AND NOT EXISTS (SELECT 1 FROM w1 y WHERE y.start_url = e.start_url AND y.url = e.url)"
    return first + [
        ("sm", CRAWL_SITEMAPS),
        ("locs", f"SELECT host, part, unnest(regexp_extract_all(xml, {Q.lit(LOC_PATTERN)}, 1)) AS raw, "
                 f"CAST(generate_subscripts(regexp_extract_all(xml, {Q.lit(LOC_PATTERN)}, 1), 1) - 1 AS INTEGER) AS pos FROM sm"),
        ("orphans", f"SELECT f.start_url, f.url, min([l.part, l.pos]) AS path, any_value(f.status) AS status FROM locs l JOIN fetchable f "
                    f"ON f.url = {Q.defrag(_xml_unescape('l.raw'))} AND l.host = {Q.netloc('f.start_url')} "
                    "WHERE NOT EXISTS (SELECT 1 FROM w1 y WHERE y.start_url = f.start_url AND y.url = f.url) GROUP BY f.start_url, f.url"),
        ("w2", "SELECT start_url, url, 1 AS phase, 0 AS depth, path, status FROM orphans UNION " + step.format(1, "w2", seen)),
        ("walk", "SELECT * FROM w1 UNION ALL SELECT * FROM w2"),
    ]


def walk_sql(sitemap: bool, final: str) -> str:
    ctes = link_ctes() + robots_ctes() + [("sites", CRAWL_SITES)] + walk_ctes(sitemap) + [
        ("numbered", "SELECT start_url, url, CAST(depth AS INTEGER) AS depth, CAST(row_number() OVER (PARTITION BY start_url "
                     "ORDER BY phase, depth, path) AS BIGINT) AS seq, status FROM walk")]
    text = with_(ctes, final).replace("WITH ", "WITH RECURSIVE ", 1)
    for name in ("w1", "w2"):
        text = text.replace(f"{name} AS (", f"{name}(start_url, url, phase, depth, path, status) USING KEY (start_url, url) AS (", 1)
    return text


SQL["site_bfs_depth"] = walk_sql(False, "SELECT * FROM numbered")
SQL["site_bfs_with_sitemap"] = walk_sql(True, "SELECT * FROM numbered")
SQL["site_page_cap"] = walk_sql(False, "SELECT n.start_url, count(*) AS pages, max(seq) AS last_seq FROM numbered n JOIN sites s "
                                       "ON s.start_url = n.start_url WHERE n.seq <= s.max_pages GROUP BY n.start_url")
