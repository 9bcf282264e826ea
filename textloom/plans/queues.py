"""Queries over sources, queues, states and reports, and their SQL, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as fn
from textloom.operators import lifecycle, pages, reports, timeline
from textloom.session import shared_dir, table
from textloom.sources import files
from textloom.streaming import windows

PAGE = 20  # rows of a captured page
SLOTS = ["preprints", "preprints", "preprints", "reader", "reader", "scholar_graph"]


def pdfs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "custom_query_pdf").distinct()


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def paper_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of twenty rows as JSON, read again: status stands for citations, 20 for open access."""
    rows = pdfs(spark, d).groupBy(F.floor(F.col("id") / PAGE).alias("page"))
    body = F.to_json(F.struct(F.collect_list(F.struct(F.col("pdf_url").alias("url"), F.col("status").alias("citationCount"), (F.col("status") >= 20).alias("isOpenAccess"))).alias("data"), F.lit(1).alias("next")))
    captured = rows.agg(body.alias("body"))
    return pages.paper_page(captured, "page", "body", F.col("page"), PAGE, 1000, 10)


def item_files(spark: SparkSession, d: str) -> DataFrame:
    rows = pdfs(spark, d).where("pdf_url is not null").groupBy(F.floor(F.col("id") / 10).alias("item")).agg(F.array_sort(F.collect_list(F.struct("id", "pdf_url"))).alias("x"))
    first = pages.first_file(F.transform("x", lambda x: x["pdf_url"]))
    return rows.select("item", pages.tagged(first, F.lit("archive")).alias("url")).where("url is not null")


def link_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of twenty links as HTML: distinct links in order, those to files only."""
    rows = pdfs(spark, d).where("pdf_url is not null and not contains(pdf_url, '\"')").groupBy(F.floor(F.col("id") / PAGE).alias("page")).agg(F.array_sort(F.collect_list(F.struct("id", "pdf_url"))).alias("x"))
    html = F.array_join(F.transform("x", lambda x: F.concat(F.lit('<li><a href="'), x["pdf_url"], F.lit('">x</a></li>'))), "\n")
    links = pages.page_links(rows.select("page", html.alias("html")), "page", "html")
    return links.where(F.contains(F.lower("link"), F.lit("pdf"))).select("page", "pos", pages.site_link(F.col("link"), "at:", "#site").alias("link"))


def capped_sources(spark: SparkSession, d: str) -> DataFrame:
    criteria = table(spark, d, "mix_target").select("source", (F.col("max_repeats") * 20).alias("max_results"), F.upper("source").alias("tag"))
    rows = pages.capped(table(spark, d, "documents").select("doc_id", "source", "pdf_url"), criteria, "source", "doc_id")
    return rows.select("doc_id", "source", pages.tagged(F.coalesce("pdf_url", F.lit("")), F.col("tag")).alias("url"))


def proxy_lists(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers stand for proxies, listed as text lines, JSON objects, table rows or badly."""
    key = F.col("s_suppkey")
    ip, port = F.concat(F.lit("10.0."), F.floor(key / 256), F.lit("."), key % 256), 8000 + F.col("s_nationkey")
    line = F.when(key % 7 == 0, F.concat(ip, F.lit(":port"))).when(key % 2 == 0, F.concat(F.lit(" "), ip, F.lit(":"), port)).otherwise(F.to_json(F.struct(ip.alias("ip"), port.cast("string").alias("port"), F.array(F.lit("socks4")).alias("protocols"))))
    cells = F.array(ip, port.cast("string"), *[F.lit("-")] * 4, F.when(F.col("s_acctbal") > 0, " Yes ").otherwise("no"))
    rows = table(spark, d, "supplier").select("s_suppkey", F.when(key % 5 == 0, pages.proxy_cells(cells)).otherwise(pages.proxy_line(line)).alias("p"))
    return rows.where("p is not null").select("s_suppkey", "p.ip", "p.port", "p.protocol")


def prompts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunk").where("text is not null")
    return rows.select("chunk_id", pages.filled("Chunk {id} of graph {graph}:\n{text}", {"id": F.col("id"), "graph": F.col("graph_id").cast("string"), "text": F.col("text")}).alias("prompt"))


def proxy_pool(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers joined with nations and regions: free ones past their grace period, best balance first."""
    joined = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # the 25 nations and 5 regions of the world
    free = joined.where(~F.contains("s_name", F.lit("@")) & (F.col("s_suppkey") * 10 < F.lit(100_000) - 300))
    return free.orderBy(F.desc("s_acctbal"), "s_suppkey").limit(50).select("s_suppkey", "s_name", "n_name", "r_name")


def drawn_rows(spark: SparkSession, d: str) -> DataFrame:
    """A thousand documents drawn at random, and one supplier of the top twenty."""
    docs = reports.sampled(table(spark, d, "documents").select(F.lit("document").alias("what"), F.col("doc_id").alias("id")), "id", 1000, 7)
    top = reports.random_of_top(table(spark, d, "supplier").select(F.lit("supplier").alias("what"), F.col("s_suppkey").alias("id"), "s_acctbal"), [F.desc("s_acctbal"), F.col("id")], "id", 20, 7)
    return docs.unionByName(top.drop("s_acctbal"))


def unconverted(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose text is missing: without a graph of their source text, or with an empty one."""
    graphs = table(spark, d, "raw_graph").select(F.col("graph_id").alias("doc_id"), "source_text")
    return table(spark, d, "documents").select("doc_id", "source").join(graphs, "doc_id", "left").where("source_text is null or source_text = ''").select("doc_id", "source")


def region_suppliers(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    return table(spark, d, "supplier").join(wanted, "s_nationkey", "left_semi").select("s_suppkey", "s_nationkey")


def gated_files(spark: SparkSession, d: str) -> DataFrame:
    rows = pdfs(spark, d).select("id", "custom_query_id", "status")
    jobs = rows.groupBy("custom_query_id").agg(F.min("status").alias("job_status"))
    return lifecycle.gated(rows, jobs, "custom_query_id", "job_status", [10, 20]).select("id", "custom_query_id")


def url_totals(spark: SparkSession, d: str) -> DataFrame:
    place = F.coalesce("destination_path", F.lit(""))
    return reports.totals(pdfs(spark, d), {"pending": place == "", "unavailable": place == "NA", "downloaded": ~place.isin("", "NA")})


def run_outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d)
    recent = timeline.trailing(rows.crossJoin(F.broadcast(rows.agg(F.max("ts").alias("now")))), "ts", F.col("now"), 24)  # one row
    return reports.outcomes(recent, "event_type", {"success": F.col("value") <= 10, "failed": F.col("value") > 10})


def user_runs(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, start, end, n): runs of a user's events with gaps of at most half an hour; the end of each user's last run is open."""
    runs = timeline.runs_of(events(spark, d).select("user_id", "ts"), "user_id", "ts", 30)
    last = runs.groupBy("user_id").agg(F.max("start").alias("last"))
    return runs.join(last, "user_id").select("user_id", "start", F.when(F.col("start") < F.col("last"), F.col("end")).alias("end"), "n")


def run_durations(spark: SparkSession, d: str) -> DataFrame:
    runs = user_runs(spark, d).crossJoin(F.broadcast(events(spark, d).agg(F.max("ts").alias("now"))))  # one row
    return reports.durations(runs, "start", "end", F.col("now")).groupBy("user_id").agg(F.count("*").alias("runs"), F.round(F.max("minutes"), 4).alias("longest"), F.round(F.sum("minutes"), 4).alias("minutes"))


def classified_zeros(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d)
    runs = reports.durations(timeline.runs_of(rows.select("user_id", "ts"), "user_id", "ts", 30), "start", "end", F.col("end"))
    return reports.zero_buckets(timeline.filled_buckets(rows.where("event_type = 'error'"), "ts", 15), runs, 15)


def zero_bucket_kinds(spark: SparkSession, d: str) -> DataFrame:
    return classified_zeros(spark, d).select(F.unix_timestamp("bucket").alias("bucket"), "kind")


def alert_list(spark: SparkSession, d: str) -> DataFrame:
    kinds = classified_zeros(spark, d).agg(F.count_if(F.col("kind") == "stall").alias("stalls"), F.count_if(F.col("kind") == "benign_backoff").alias("backoffs"))
    failed = events(spark, d).agg(F.count_if(F.col("value") > 40).alias("failed"))
    c = F.col
    return reports.alerts(kinds.crossJoin(failed), [("bad", "stall", c("stalls") > 0), ("good", "backoff", c("backoffs") > 0), ("warn", "failed runs", c("failed") > 0), ("warn", "no runs", c("failed") < 0)])


def token_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    calls = rows.select(F.col("event_type").alias("stage"), F.col("event_id").alias("order"), k.alias("input"), (k * 2 + 1).alias("output"), F.when(F.col("value") > 30, F.concat(F.lit("too long: "), F.col("event_id"))).alias("error"))
    stats = reports.token_stats(calls, "stage", "order")
    return stats.select("stage", "calls", "input_tokens", "output_tokens", "failures", F.array_join("errors", "; ").alias("errors"))


def file_audit(spark: SparkSession, d: str) -> DataFrame:
    """Texts of the documents as the content of files: every third without a header, every fifth without an end mark."""
    k = F.col("doc_id")
    text = F.coalesce("text", F.lit(""))
    body = F.concat(F.when(k % 3 != 0, F.lit("\0%PDF-1.4 ")).otherwise(""), text, F.when(k % 5 != 0, F.lit("%%EOF")).otherwise(""))
    rows = table(spark, d, "documents").select(pages.file_state(F.encode(body, "UTF-8"), k % 11, F.length(text)).alias("state"), F.length(text).alias("size"))
    return pages.audit(rows, "state", "size")


def config_fields(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("config_summary")
    return table(spark, d, "raw_graph").select("graph_id", pages.config_field(c, "llm_model", "rules").alias("model"), pages.config_field(c, "normalization", "off").alias("normalization"), pages.config_field(c, "resolver", "salience").alias("resolver"))


def form_criteria(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_triplet").where("subject is not null")
    form = {"keywords": F.col("subject"), "query": F.col("relation"), "max_results": F.when(F.col("triplet_id") % 2 == 0, F.col("graph_id").cast("string")), "secret": F.col("object")}
    made = rows.select("triplet_id", pages.criterion(form, ["keywords", "query", "max_results"], ["keywords"]).alias("c"))
    return made.select("triplet_id", F.array_join("c.keywords", "|").alias("keywords"), F.size("c.keywords").alias("n"), "c.query", "c.max_results")


def stepped_files(spark: SparkSession, d: str) -> DataFrame:
    """Files get an event by their source; only steps that the life of a file allows are taken."""
    rows = pdfs(spark, d).select("id", "source_name", F.when(F.col("status") == 20, 5).otherwise(F.col("status")).alias("status"))
    told = rows.select("id", F.lit(5).alias("expected"), F.when(F.length("source_name") > 7, 10).otherwise(20).alias("target"))
    return lifecycle.stepped(rows, told, "id", "status", lifecycle.FILE_STEPS).groupBy("source_name", "status", "moved").agg(F.count("*").alias("n"))


def locked_files(spark: SparkSession, d: str) -> DataFrame:
    rows = pdfs(spark, d).select("id", "custom_query_id", "status")
    return lifecycle.pick_and_lock(rows, "id", "custom_query_id", "status", 0, 5).where("status = 5").select("id", "custom_query_id")


def query_progress(spark: SparkSession, d: str) -> DataFrame:
    files_ = pdfs(spark, d).select("custom_query_id", "status")
    old = files_.select("custom_query_id").distinct().withColumn("status", F.lit(20))
    known = lifecycle.created(old, table(spark, d, "raw_triplet").select(F.col("job_id").alias("custom_query_id")).distinct(), "custom_query_id")
    return lifecycle.query_states(known.drop("status"), files_, "custom_query_id", "status")


def status_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The states of the files that a list of jobs names."""
    asked = table(spark, d, "raw_triplet").select(F.col("job_id").alias("id"))
    return lifecycle.looked_up(pdfs(spark, d), asked, "id", ["status", "source_name"])


def saved_locations(spark: SparkSession, d: str) -> DataFrame:
    rows = pdfs(spark, d).select("id", F.coalesce("destination_path", F.lit("")).alias("location"), "status")
    saved = rows.where("status in (10, 99)").select("id", F.when(F.col("status") == 10, F.concat(F.lit("new/"), F.col("id"))).alias("new_location"))
    return lifecycle.located(rows, saved, "id", "location").select("id", "location")


def success_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").select("s_suppkey", F.lit(10).cast("bigint").alias("successes"))
    won = table(spark, d, "lineitem").where("l_returnflag = 'N'").select(F.col("l_suppkey").alias("s_suppkey"))
    return lifecycle.counted_successes(rows, won, "s_suppkey", "successes")


def deleted_proxies(spark: SparkSession, d: str) -> DataFrame:
    proxies = table(spark, d, "supplier")
    relations = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_returnflag").distinct()
    left, held = lifecycle.deleted(proxies.select("s_suppkey"), relations, proxies.where("s_acctbal < 0"), "s_suppkey")
    return left.join(held.groupBy("s_suppkey").agg(F.count("*").alias("relations")), "s_suppkey", "left").fillna(0, ["relations"])


def claimed_urls(spark: SparkSession, d: str) -> DataFrame:
    """A claim of 200 pending URLs: those claimed within the last five minutes are held by others."""
    rows = pdfs(spark, d).where("status = 0").select("id", F.when(F.col("id") % 3 == 0, F.col("inserted_at").cast("timestamp")).alias("claimed_at"))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return lifecycle.claimed(rows, "id", [F.col("id")], 200, "claimed_at", now).select("id", F.unix_timestamp("claimed_at").alias("claimed_at"), "taken")


def slot_claims(spark: SparkSession, d: str) -> DataFrame:
    rows = pdfs(spark, d).where("status = 0 and pdf_url is not null").select("id", "source_name")
    return lifecycle.slot_claim(rows, "source_name", ["id"], SLOTS, 3, 100)


def site_crawl(spark: SparkSession, d: str) -> DataFrame:
    """Next letter and page, and next rubric and page, of a crawl for each node."""
    rows = table(spark, d, "raw_node").select("node_id", F.chr(F.lit(97) + F.col("graph_id") % 26).alias("letter"), (F.col("node_id") % 5001).cast("int").alias("page"), F.size("mentions").alias("n"))
    rows = rows.select("node_id", lifecycle.next_page(F.col("page"), F.col("letter"), 5000).alias("a"), lifecycle.next_rubric((F.col("node_id") % 40).cast("int"), F.col("page"), F.col("n"), 40).alias("b"))
    return rows.select("node_id", "a.letter", F.col("a.page").alias("page"), "b.rubric", F.col("b.page").alias("rubric_page"))


def crawl_steps(spark: SparkSession, d: str) -> DataFrame:
    """Each graph stands for a crawl; its chunks are what the adapter fetched, null texts are failures."""
    g = F.col("graph_id")
    states = table(spark, d, "raw_graph").select("graph_id", (g % 3).cast("int").alias("criterion_index"), F.when(g % 4 == 0, F.array((g % 3).cast("int"))).otherwise(F.array().cast("array<int>")).alias("done"), F.array(F.lit(True), F.lit(True), F.lit(False)).alias("repeats"), F.when(g % 7 == 0, 2000).alias("resume_at"))
    fetched = table(spark, d, "chunk").select("graph_id", F.col("text").isNotNull().alias("ok"), (F.col("chunk_id") % 2 == 0).alias("has_more"))
    return lifecycle.crawl_step(states, fetched, "graph_id", F.lit(1000)).select("graph_id", "criterion_index", "has_more", "step")


def stale_urls(spark: SparkSession, d: str) -> DataFrame:
    """Pending URLs that may be claimed: unclaimed, or claimed too long ago."""
    from textloom.operators import acquisition

    rows = pdfs(spark, d).where("status = 0").select("id", F.when(F.col("id") % 2 == 0, F.col("inserted_at").cast("timestamp")).alias("claimed_at"))
    return acquisition.stale_claims(rows, "claimed_at", F.lit("2024-01-15 00:00:00").cast("timestamp")).select("id")


def importance_values(spark: SparkSession, d: str) -> DataFrame:
    """Cluster sizes and labels read as importance."""
    rows = table(spark, d, "clustered_node")
    k = F.col("node_id") % 5
    given = F.when(k == 0, "Core ").when(k == 1, "peripheral").when(k == 2, (F.col("cluster_size") / 4).cast("string")).when(k == 3, F.col("label"))
    return rows.select("node_id", fn.importance(given).alias("importance"))


def folder_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Folders of the stored files, the fullest first."""
    folder = F.regexp_extract("destination_path", r"^(.*)/[^/]+$", 1)
    rows = pdfs(spark, d).where("destination_path is not null and contains(destination_path, '/')").groupBy(folder.alias("folder")).agg(F.count("*").alias("files"))
    return rows.orderBy(F.desc("files"), "folder").limit(20)


def path_lists(spark: SparkSession, d: str) -> DataFrame:
    """Files of jobs given as lists of paths, read back one by one."""
    lists = pdfs(spark, d).where("destination_path is not null").groupBy("batch_no", F.floor(F.col("id") / 50).alias("part")).agg(F.array_join(F.array_sort(F.collect_list("destination_path")), ";").alias("paths"))
    return lists.select("batch_no", F.explode(F.split("paths", ";")).alias("path")).groupBy("batch_no", "path").agg(F.count("*").alias("n"))


def text_files(spark: SparkSession, d: str) -> DataFrame:
    """Titles written as text files, one folder a source, and scanned again."""
    path = shared_dir(spark, "texts")
    titles = table(spark, d, "documents").where("title is not null and source is not null").select("source", F.regexp_replace("title", r"[\r\n]+", " ").alias("title"))
    titles.repartition("source").write.partitionBy("source").text(path)
    found = files.text_folder(spark, path, "source=([^/]+)/")
    return found.select(F.col("name").alias("source"), F.explode(F.split(F.rtrim(F.col("text")), "\n")).alias("line")).groupBy("source").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("letters"))


def graph_json(spark: SparkSession, d: str) -> DataFrame:
    """Graphs written as JSON in three shapes (single, variants, thresholds) and read again."""
    nodes = table(spark, d, "clustered_node").select("graph_id", F.struct(F.col("node_id").cast("string").alias("id"), "label", "members", F.lit(0.5).alias("importance")).alias("node"))
    lists = nodes.groupBy("graph_id").agg(F.collect_list("node").alias("nodes"))  # a graph's file holds all its nodes
    g = F.struct("nodes", F.array().cast("array<struct<id:string>>").alias("edges"))
    k = F.col("graph_id") % 3
    shaped = lists.select(F.col("graph_id").cast("string").alias("name"), F.when(k == 0, F.col("nodes")).alias("nodes"), F.when(k == 1, F.create_map(F.lit("e=0.50"), g)).alias("variants"), F.when(k == 2, F.create_map(F.lit("0.5"), g)).alias("thresholds"))
    path = shared_dir(spark, "graphs")
    files.write_json(shaped, path)
    found = files.graph_files(spark, path, lines=True)
    return found.select(F.coalesce("variant", F.lit("single")).alias("variant"), F.explode("nodes").alias("n")).groupBy("variant").agg(F.count("*").alias("nodes"), F.sum(F.coalesce(F.length("n.label"), F.lit(0))).alias("letters"))


def folder_files(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of a folder with a file for each batch of URLs."""
    path = shared_dir(spark, "folder")
    pdfs(spark, d).select(F.col("batch_no").alias("batch"), F.col("id").cast("string").alias("id")).repartition("batch").write.partitionBy("batch").text(path)
    stats = files.folder_statistics(spark, path, "2000-01-01")
    return stats.select(F.regexp_extract("folder", r"batch=(\d+)$", 1).cast("bigint").alias("batch"), "files", "bytes", (F.col("recent") == F.col("files")).alias("all_recent"))


def stream_graph(spark: SparkSession, d: str) -> DataFrame:
    """Relations arrive as a stream; each batch updates the weights of the edges it touches."""
    schema = table(spark, d, "raw_triplet").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/raw_triplet.parquet*").where("subject is not null and object is not null")
    weights = stream.groupBy("graph_id", "subject", "object", "relation").agg(F.count("*").alias("weight"))
    keys = ["graph_id", "subject", "object", "relation"]
    return windows.latest_of(windows.run_updates(weights, spark), keys, "weight")


QUERIES = {
    f.__name__: f
    for f in (
        paper_pages, item_files, link_pages, capped_sources, proxy_lists, prompts, proxy_pool, drawn_rows, unconverted, region_suppliers, gated_files, url_totals, run_outcomes, run_durations, zero_bucket_kinds, alert_list,
        token_statistics, file_audit, config_fields, form_criteria, stepped_files, locked_files, query_progress, status_lookup, saved_locations, success_counts, deleted_proxies, claimed_urls, slot_claims, site_crawl,
        crawl_steps, stale_urls, importance_values, folder_sizes, path_lists, text_files, graph_json, folder_files, stream_graph,
    )
}

_PDF = "(SELECT DISTINCT * FROM custom_query_pdf)"
_RUNS = """e AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 1800000000 THEN 0 ELSE 1 END AS fresh FROM events),
      g AS (SELECT user_id, t, sum(fresh) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS no FROM e), r AS (SELECT user_id, min(t) // 1000000 AS a, max(t) // 1000000 AS b FROM g GROUP BY user_id, no)"""
_ZEROS = f"""WITH {_RUNS}, c AS (SELECT (epoch_us(ts) // 1000000) // 900 * 900 AS bucket FROM events WHERE event_type = 'error'), s AS (SELECT unnest(generate_series(min(bucket), max(bucket), 900)) AS bucket FROM c),
      z AS (SELECT bucket FROM s WHERE bucket NOT IN (SELECT bucket FROM c)),
      o AS (SELECT z.bucket, max(CASE WHEN (b - a) / 60.0 >= 75 THEN 2 WHEN (b - a) / 60.0 BETWEEN 10 AND 20 THEN 1 ELSE 0 END) AS k FROM z JOIN r ON a < z.bucket + 900 AND b > z.bucket AND b > a GROUP BY 1),
      k AS (SELECT z.bucket, CASE o.k WHEN 2 THEN 'stall' WHEN 1 THEN 'benign_backoff' ELSE 'unexplained' END AS kind FROM z LEFT JOIN o ON o.bucket = z.bucket)"""

SQL: dict[str, str] = {
    "paper_pages": f"SELECT id // 20 AS page, pdf_url AS url, (id // 20) * 20 < 1000 AS has_more FROM {_PDF} WHERE pdf_url IS NOT NULL AND status >= 20",
    "item_files": f"SELECT id // 10 AS item, arg_min(pdf_url, id) || '#archive' AS url FROM {_PDF} WHERE lower(pdf_url) LIKE '%.pdf' GROUP BY 1",
    "link_pages": f"""SELECT page, min(pos)::INT AS pos, 'at:' || pdf_url || '#site' AS link FROM (SELECT id // 20 AS page, row_number() OVER (PARTITION BY id // 20 ORDER BY id) - 1 AS pos, pdf_url FROM {_PDF} WHERE pdf_url IS NOT NULL AND NOT contains(pdf_url, '"'))
      WHERE contains(lower(pdf_url), 'pdf') GROUP BY page, pdf_url""",
    "capped_sources": "SELECT doc_id, source, coalesce(pdf_url, '') || '#' || upper(source) AS url FROM (SELECT d.*, max_repeats, row_number() OVER (PARTITION BY d.source ORDER BY doc_id) AS p FROM documents d JOIN mix_target t ON t.source = d.source) WHERE p <= max_repeats * 20",
    "proxy_lists": """SELECT s_suppkey, '10.0.' || (s_suppkey // 256) || '.' || (s_suppkey % 256) AS ip, (8000 + s_nationkey)::INT AS port,
      CASE WHEN s_suppkey % 5 = 0 THEN CASE WHEN s_acctbal > 0 THEN 'https' ELSE 'http' END WHEN s_suppkey % 2 = 0 THEN 'http' ELSE 'socks4' END AS protocol FROM supplier WHERE s_suppkey % 5 = 0 OR s_suppkey % 7 != 0""",
    "prompts": "SELECT chunk_id, replace(replace(replace('Chunk {id} of graph {graph}:' || chr(10) || '{text}', '{id}', coalesce(id, '')), '{graph}', coalesce(graph_id::VARCHAR, '')), '{text}', text) AS prompt FROM chunk WHERE text IS NOT NULL",
    "proxy_pool": "SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_name NOT LIKE '%@%' AND s_suppkey * 10 < 99700 ORDER BY s_acctbal DESC, s_suppkey LIMIT 50",
    "drawn_rows": """SELECT 'document' AS what, doc_id AS id FROM (SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 1000)
      UNION ALL SELECT 'supplier', s_suppkey FROM (SELECT s_suppkey FROM (SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 20) ORDER BY md5('7:' || s_suppkey), s_suppkey LIMIT 1)""",
    "unconverted": "SELECT doc_id, source FROM documents LEFT JOIN raw_graph ON graph_id = doc_id WHERE source_text IS NULL OR source_text = ''",
    "region_suppliers": "SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)",
    "gated_files": f"SELECT id, custom_query_id FROM {_PDF} WHERE custom_query_id IN (SELECT custom_query_id FROM {_PDF} GROUP BY 1 HAVING min(status) IN (10, 20))",
    "url_totals": f"""SELECT count(*) AS n, sum(CASE WHEN p = '' THEN 1 ELSE 0 END)::BIGINT AS pending, sum(CASE WHEN p = 'NA' THEN 1 ELSE 0 END)::BIGINT AS unavailable, sum(CASE WHEN p NOT IN ('', 'NA') THEN 1 ELSE 0 END)::BIGINT AS downloaded
      FROM (SELECT coalesce(destination_path, '') AS p FROM {_PDF})""",
    "run_outcomes": "SELECT event_type, count(*) FILTER (value <= 10) AS success, count(*) FILTER (value > 10) AS failed FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS GROUP BY GROUPING SETS ((event_type), ())",
    "run_durations": f"""WITH {_RUNS}, n AS (SELECT max(epoch_us(ts)) // 1000000 AS now FROM events), l AS (SELECT user_id, a, CASE WHEN a = max(a) OVER (PARTITION BY user_id) THEN now ELSE b END AS b FROM r, n)
      SELECT user_id, count(*) AS runs, round(max((b - a) / 60.0::DOUBLE), 4) AS longest, round(sum((b - a) / 60.0::DOUBLE), 4) AS minutes FROM l GROUP BY 1""",
    "zero_bucket_kinds": f"{_ZEROS} SELECT bucket, kind FROM k",
    "alert_list": f"""{_ZEROS}, f AS (SELECT (SELECT count(*) FROM k WHERE kind = 'stall') AS s, (SELECT count(*) FROM k WHERE kind = 'benign_backoff') AS b, (SELECT count(*) FROM events WHERE value > 40) AS x),
      h AS (SELECT 'bad' AS level, 'stall' AS alert FROM f WHERE s > 0 UNION ALL SELECT 'good', 'backoff' FROM f WHERE b > 0 UNION ALL SELECT 'warn', 'failed runs' FROM f WHERE x > 0)
      SELECT level, alert FROM h UNION ALL SELECT 'good', 'none' WHERE NOT EXISTS (SELECT * FROM h)""",
    "token_statistics": """WITH e AS (SELECT event_type AS stage, event_id, (props->>'$.k')::BIGINT AS k, CASE WHEN value > 30 THEN 'too long: ' || event_id END AS error FROM events),
      x AS (SELECT stage, string_agg(error, '; ' ORDER BY event_id) AS errors FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY event_id) AS p FROM e WHERE error IS NOT NULL) WHERE p <= 10 GROUP BY 1)
      SELECT e.stage, count(*) AS calls, sum(k)::BIGINT AS input_tokens, sum(k * 2 + 1)::BIGINT AS output_tokens, count(error) AS failures, coalesce(any_value(errors), '') AS errors FROM e LEFT JOIN x ON x.stage = e.stage GROUP BY 1""",
    "file_audit": """WITH s AS (SELECT length(coalesce(text, '')) AS size, CASE WHEN doc_id % 3 = 0 OR doc_id % 11 = 0 THEN 'fail' WHEN doc_id % 5 = 0 THEN 'ok_no_eof' WHEN length(coalesce(text, '')) <= 40 THEN 'ok_no_text' ELSE 'ok_clean' END AS state FROM documents)
      SELECT state, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM s), 2) AS percent, round(avg(size), 2) AS mean_size FROM s GROUP BY 1""",
    "config_fields": "SELECT graph_id, coalesce(config_summary->>'$.llm_model', 'rules') AS model, coalesce(config_summary->>'$.normalization', 'off') AS normalization, 'salience' AS resolver FROM raw_graph",
    "form_criteria": """WITH k AS (SELECT *, list_filter(list_transform(string_split(subject, ','), lambda x: trim(x, ' ')), lambda x: x != '') AS ks FROM raw_triplet WHERE subject IS NOT NULL)
      SELECT triplet_id, array_to_string(ks, '|') AS keywords, len(ks)::INT AS n, nullif(trim(relation, ' '), '') AS query, (CASE WHEN triplet_id % 2 = 0 THEN coalesce(graph_id, 200) ELSE 200 END)::INT AS max_results FROM k""",
    "stepped_files": f"""WITH r AS (SELECT source_name, CASE WHEN status = 20 THEN 5 ELSE status END AS s FROM {_PDF}), m AS (SELECT source_name, s, s = 5 AND length(source_name) > 7 AS moved FROM r)
      SELECT source_name, CASE WHEN moved THEN 10 ELSE s END::INT AS status, coalesce(moved, false) AS moved, count(*) AS n FROM m GROUP BY 1, 2, 3""",
    "locked_files": f"SELECT min(id) AS id, custom_query_id FROM {_PDF} WHERE status = 0 AND custom_query_id IS NOT NULL GROUP BY custom_query_id",
    "query_progress": f"""WITH q AS (SELECT custom_query_id FROM {_PDF} UNION SELECT job_id FROM raw_triplet), f AS (SELECT custom_query_id, count(*) AS n, count(*) FILTER (status = 0) AS o FROM {_PDF} GROUP BY 1)
      SELECT q.custom_query_id, coalesce(n, 0) AS files, coalesce(o, 0) AS open, CASE WHEN coalesce(o, 0) = 0 THEN 30 ELSE 20 END::INT AS state FROM q LEFT JOIN f ON f.custom_query_id = q.custom_query_id""",
    "status_lookup": f"SELECT id, status, source_name FROM {_PDF} WHERE id IN (SELECT job_id FROM raw_triplet)",
    "saved_locations": f"SELECT id, CASE status WHEN 10 THEN 'new/' || id WHEN 99 THEN 'NA' ELSE coalesce(destination_path, '') END AS location FROM {_PDF}",
    "success_counts": "SELECT s_suppkey, 10 + (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'N') AS successes FROM supplier",
    "deleted_proxies": "SELECT s_suppkey, count(DISTINCT l_returnflag) AS relations FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey WHERE s_acctbal >= 0 GROUP BY 1",
    "claimed_urls": f"""WITH r AS (SELECT id, CASE WHEN id % 3 = 0 THEN epoch_us(inserted_at) // 1000000 END AS c FROM {_PDF} WHERE status = 0), t AS (SELECT id FROM r WHERE c IS NULL OR c <= 1706745600 - 300 ORDER BY id LIMIT 200)
      SELECT r.id, CASE WHEN t.id IS NOT NULL THEN 1706745600 ELSE c END AS claimed_at, t.id IS NOT NULL AS taken FROM r LEFT JOIN t ON t.id = r.id""",
    "slot_claims": f"""WITH s AS (SELECT * FROM (VALUES ('reader', 0, 4), ('scholar_graph', 1, 5), ('preprints', 2, 0), ('preprints', 3, 1), ('preprints', 4, 2), ('reader', 5, 3)) AS v(source_name, turn, slot)),
      p AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY turn) - 1 AS own, count(*) OVER (PARTITION BY source_name) AS w FROM s),
      r AS (SELECT id, source_name, row_number() OVER (PARTITION BY source_name ORDER BY id) - 1 AS k FROM {_PDF} WHERE status = 0 AND pdf_url IS NOT NULL)
      SELECT id, r.source_name, k // w AS round, slot FROM r JOIN p ON p.source_name = r.source_name AND own = k % w ORDER BY round, turn LIMIT 100""",
    "site_crawl": """WITH r AS (SELECT node_id, chr((97 + graph_id % 26)::INT) AS l, (node_id % 5001)::INT AS p, len(mentions) AS n, (node_id % 40)::INT AS k FROM raw_node)
      SELECT node_id, CASE WHEN p < 5000 THEN l WHEN l < 'z' THEN chr(ascii(l) + 1) END AS letter, CASE WHEN p < 5000 THEN p + 1 WHEN l < 'z' THEN 1 END AS page,
      CASE WHEN n > 0 THEN k WHEN k + 1 < 40 THEN k + 1 END AS rubric, CASE WHEN n > 0 THEN p + 1 WHEN k + 1 < 40 THEN 1 END AS rubric_page FROM r""",
    "crawl_steps": """WITH f AS (SELECT graph_id, bool_and(text IS NOT NULL) AS ok, bool_or(chunk_id % 2 = 0) AS more FROM chunk GROUP BY 1)
      SELECT g.graph_id, CASE WHEN g.graph_id % 4 = 0 THEN (g.graph_id % 3 + 1) % 3 ELSE g.graph_id % 3 END::INT AS criterion_index, coalesce(more, false) AS has_more,
      CASE WHEN g.graph_id % 7 = 0 THEN 'paused' WHEN NOT coalesce(ok, false) THEN 'kept' ELSE 'ready' END AS step FROM raw_graph g LEFT JOIN f ON f.graph_id = g.graph_id""",
    "stale_urls": f"SELECT id FROM {_PDF} WHERE status = 0 AND (id % 2 = 1 OR inserted_at IS NULL OR inserted_at <= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 5 MINUTES)",
    "importance_values": "SELECT node_id, CASE node_id % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.2 WHEN 2 THEN coalesce(least(greatest(cluster_size / 4.0::DOUBLE, 0), 1), 0.5) ELSE 0.5 END::DOUBLE AS importance FROM clustered_node",
    "folder_sizes": f"SELECT regexp_extract(destination_path, '^(.*)/[^/]+$', 1) AS folder, count(*) AS files FROM {_PDF} WHERE contains(destination_path, '/') GROUP BY 1 ORDER BY files DESC, folder LIMIT 20",
    "path_lists": f"SELECT batch_no, destination_path AS path, count(*) AS n FROM {_PDF} WHERE destination_path IS NOT NULL GROUP BY 1, 2",
    "text_files": r"SELECT source, count(*) AS lines, sum(length(regexp_replace(title, '[\r\n]+', ' ', 'g')))::BIGINT AS letters FROM documents WHERE title IS NOT NULL AND source IS NOT NULL GROUP BY 1",
    "graph_json": "SELECT CASE graph_id % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'e=0.50' ELSE '0.5' END AS variant, count(*) AS nodes, sum(coalesce(length(label), 0))::BIGINT AS letters FROM clustered_node GROUP BY 1",
    "folder_files": f"SELECT batch_no AS batch, 1::BIGINT AS files, sum(length(id::VARCHAR) + 1)::BIGINT AS bytes, true AS all_recent FROM {_PDF} GROUP BY 1",
    "stream_graph": "SELECT graph_id, subject, object, relation, count(*) AS weight FROM raw_triplet WHERE subject IS NOT NULL AND object IS NOT NULL GROUP BY 1, 2, 3, 4",
}
