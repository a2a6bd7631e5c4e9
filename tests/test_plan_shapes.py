"""Scale properties of the plans, pinned so that refactors keep them."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import chunk as C
from tidemark.operators import diff as D
from tidemark.operators import discover as X
from tidemark.operators import extract as E
from tidemark.operators import quality as A
from tidemark.plans import inputs as I


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_core_path_has_no_python(spark):
    prev = C.chunk_pages(E.extract_pages(E.pages_ok(I.raw_pages(spark, SF_SMALL, "prev"))))
    cur = C.chunk_pages(E.extract_pages(E.pages_ok(I.raw_pages(spark, SF_SMALL, "cur"))))
    p = plan(D.diff_chunks(prev, cur))
    assert "EvalPython" not in p and "PythonUDF" not in p and "MapInPandas" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.extract_pages(I.raw_pages(spark, SF_SMALL, "cur")).select("url", "content_hash"))
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in p
    led = plan(I.ledger_chunks(spark, SF_SMALL, "cur").select("chunk_id"))
    assert "l_extendedprice" not in led and "PushedFilters: [IsNotNull(l_discount), LessThan(l_discount,0.1)]" in led


def test_pages_are_numbered_by_range_partitions(spark):
    """Never by a window over a whole site."""
    pages = I.crawl_pages(spark, SF_SMALL).select("start_url", "url", F.struct(F.col("page_id").alias("seq"), F.lit(0).alias("pos")).alias("rank"))
    p = plan(X.number_within(pages, "start_url", "rank", X._LevelStore(spark)))
    assert "WindowGroupLimit" not in p and "_pid" in p


def test_a_level_opens_the_folders_of_its_pages(spark, monkeypatch):
    monkeypatch.setattr(X, "LINKS_PER_FOLDER", 50)
    links = I.crawl_links(spark, SF_SMALL).select(F.lit("s").alias("start_url"), "src_url", "pos", "dst_url", F.lit(200).alias("edge_status"))
    edges = X._Edges(links, X._LevelStore(spark))
    assert edges.folders > 4
    one = links.limit(1).select("start_url", F.col("src_url").alias("url"))
    near, all_ = edges.of(one), edges.of(links.select("start_url", F.col("src_url").alias("url")))
    assert len({f.split("folder=")[1].split("/")[0] for f in near.inputFiles()}) == 1
    assert near.count() < all_.count() == links.count()
    want = links.join(one.withColumnRenamed("url", "src_url"), ["start_url", "src_url"]).count()
    assert near.join(one.withColumnRenamed("url", "src_url"), ["start_url", "src_url"]).count() == want > 0
    assert edges.of(one.limit(0)).count() == 0


def test_set_diff_reads_each_run_once(spark):
    p = plan(D.run_id_set_diff(I.ledger_chunks(spark, SF_SMALL, "prev"), I.ledger_chunks(spark, SF_SMALL, "cur")))
    assert p.count("FileScan") == 2 and p.count("Exchange hashpartitioning") == 2


def test_nothing_is_spread_unasked(spark):
    assert "Exchange" not in plan(E.extract_pages(I.raw_pages(spark, SF_SMALL, "cur")))
    assert "Exchange" in plan(E.extract_pages(I.raw_pages(spark, SF_SMALL, "cur"), partitions=4))


def test_site_aggregates_combine_map_side(spark):
    pages = E.extract_pages(I.raw_pages(spark, SF_SMALL, "cur"))
    p = plan(A.site_yield(pages, pages.select("start_url").distinct()))
    assert "partial_count" in p
    lw = plan(D.last_wins(I.ledger_chunks(spark, SF_SMALL, "cur")))
    assert "partial_max_by" in lw and "partial_min" in lw
