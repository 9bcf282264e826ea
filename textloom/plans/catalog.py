"""Registry of the core queries and their SQL, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as fn
from textloom.operators import acquisition, chunks, concepts, crawl, embeddings, graphs, hierarchy, resolution, timeline
from textloom.plans import queues, texts
from textloom.session import table
from textloom.streaming import windows

# Fixed values of the test tables: sources by URL pattern, folders by tag, and the fair-claim weights.
PATTERNS = (("preprints", "%preprints.example%"), ("reader", "%reader.example%"), ("thesis", "%thesisbank.example%"), ("journals", "%journals-ru.example%"), ("medlib", "%medlib.example%"), ("archive", "%openarchive.example%"))
FOLDERS = (("#arxiv", "arxiv"), ("#english_science", "english"), ("#gujarati_law", "gujarati"), ("#customquery_", "custom"))
WEIGHTS = {"preprints": 3, "reader": 2}


def pdf_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "custom_query_pdf").distinct()


def source_breakdown(spark: SparkSession, d: str) -> DataFrame:
    rows = pdf_rows(spark, d)
    location = F.when(F.col("status") == 99, F.lit("NA")).otherwise(F.coalesce("destination_path", F.lit("")))
    rows = rows.select(acquisition.classify_source(F.coalesce(F.lower("pdf_url"), F.lit("")), PATTERNS).alias("source"), acquisition.download_state(location).alias("state"))
    return acquisition.breakdown(rows, "source", "state")


def url_routing(spark: SparkSession, d: str) -> DataFrame:
    url = F.col("pdf_url")
    rows = pdf_rows(spark, d).where("pdf_url is not null").select("id", acquisition.route(url, FOLDERS, "root").alias("folder"), fn.last_fragment_cut(url).alias("url"), fn.slug(F.col("source_name"), F.col("custom_query_id")).alias("source_slug"))
    return rows


def url_reuse(spark: SparkSession, d: str) -> DataFrame:
    rows = pdf_rows(spark, d).where("pdf_url is not null")
    wanted, done = rows.where("status = 0").select("id", "pdf_url"), rows.where("destination_path is not null").select(F.col("pdf_url").alias("done_url"), "destination_path")
    return acquisition.reusable(wanted, done, "pdf_url", "done_url", "destination_path").select("id", "reuse")


def relation_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_triplet")
    return rows.groupBy("graph_id", "subject", "relation", "object").agg(F.min("triplet_id").alias("first_id"), F.count("*").alias("copies")).select("graph_id", "first_id", "copies")


def idempotent_append(spark: SparkSession, d: str) -> DataFrame:
    rows = pdf_rows(spark, d).where("pdf_url is not null").withColumn("base", fn.url_base(F.col("pdf_url")))
    old, new = rows.where("batch_no <= 20").select("base").distinct(), rows.where("batch_no > 20").select("base")
    return acquisition.append_absent(old, new, "base").groupBy(acquisition.classify_source(F.lower("base"), PATTERNS).alias("source")).agg(F.count("*").alias("n"))


def latest_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("seen_at"), "event_id")
    latest = lambda df: df.groupBy("user_id").agg(F.max(F.struct("seen_at", "event_type")).alias("x")).select("user_id", "x.event_type", "x.seen_at")
    return acquisition.upsert_latest(latest(rows.where("event_id % 2 = 0")), rows.where("event_id % 2 = 1").select("user_id", "event_type", "seen_at"), "user_id", "event_type", "seen_at")


def job_progress(spark: SparkSession, d: str) -> DataFrame:
    files = pdf_rows(spark, d)
    jobs = table(spark, d, "raw_triplet").select(F.col("job_id").alias("custom_query_id")).distinct().unionByName(files.select("custom_query_id")).distinct()
    return acquisition.job_progress(jobs, files, "custom_query_id", "status", [0, 10, 20, 99])


def finished_jobs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_linestatus") == "F", 20).otherwise(10).alias("status"))
    return acquisition.finished_jobs(rows, "l_orderkey", "status", 20)


def throughput_buckets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    return timeline.filled_buckets(rows, "ts", 15).select(F.unix_timestamp("bucket").alias("bucket"), "n")


def run_overlaps(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    runs = timeline.runs_of(rows, "user_id", "ts", 240)
    buckets = timeline.filled_buckets(rows, "ts", 60).select("bucket")
    return timeline.overlaps(runs, buckets, 60).select(F.unix_timestamp("bucket").alias("bucket"), "n_runs", "covered_s")


def trailing_outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    now = rows.agg(F.max("ts").alias("now"))
    joined = rows.crossJoin(F.broadcast(now))  # one row
    return timeline.trailing(joined, "ts", F.col("now"), 24).groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("large"), F.round(F.avg("value"), 4).alias("avg_value"))


def fair_claim(spark: SparkSession, d: str) -> DataFrame:
    rows = pdf_rows(spark, d).where("status = 0 and pdf_url is not null").select("id", "source_name")
    return acquisition.claim(rows, "source_name", ["id"], 500, WEIGHTS).select("id", "source_name", "round", "place")


def recent_list(spark: SparkSession, d: str) -> DataFrame:
    return acquisition.top_ranked(pdf_rows(spark, d).where("status in (0, 20)").select("id", "source_name", "status"), [F.desc("id")], 50)


def chunk_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunk").where("text is not null")
    return chunks.chunk_windows(rows, fn.rough_sentences(F.col("text")), F.lit(3), F.lit(1), ["chunk_id"])


def neighbour_context(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunk").select("graph_id", "chunk_id", F.coalesce("text", F.lit("")).alias("text"))
    return chunks.neighbour_context(rows, ["graph_id"], "chunk_id", "text", 1, 60).select("chunk_id", "context")


def pipe_triplets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_triplet").where("subject is not null and object is not null")
    line = F.concat(F.lit("- "), F.regexp_replace(F.concat_ws(" | ", "subject", "relation", "object"), r"[ \t\n\r]+", " "))
    return rows.select("triplet_id", fn.pipe_triplet(line).alias("t")).where("t is not null").select("triplet_id", "t.subject", "t.relation", "t.object")


def assembled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return graphs.assemble(table(spark, d, "raw_triplet"), "graph_id", "triplet_id", "subject", "relation", "object")


def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    return assembled(spark, d)[0]


def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return assembled(spark, d)[1]


def edge_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_triplet").where("subject is not null and object is not null")
    keys = ["graph_id", "subject", "object", "relation"]
    old = rows.where("job_id % 2 = 0").groupBy(*keys).agg(F.count("*").alias("weight"))
    return graphs.merge_edges(old, rows.where("job_id % 2 = 1"), keys)


def clustered_edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clustered_edge").select("edge_id", "graph_id", "source_id", "target_id", "label", "cluster_size")


def importance_sweep(spark: SparkSession, d: str) -> DataFrame:
    score = F.col("cluster_size") / (F.col("cluster_size") + 2.0)
    nodes = table(spark, d, "clustered_node").select("graph_id", F.col("node_id").alias("node"), score.alias("score"))
    edges = clustered_edges(spark, d).select("graph_id", F.col("source_id").alias("source"), F.col("target_id").alias("target"), score.alias("score"))
    return graphs.importance_sweep(nodes, edges, [0.2, 0.4, 0.6], [0.2, 0.5])


def degree_metrics(spark: SparkSession, d: str) -> DataFrame:
    return graphs.degree_metrics(table(spark, d, "clustered_node"), clustered_edges(spark, d), "graph_id", "source_id", "target_id", "node_id")


def clustering_coefficients(spark: SparkSession, d: str) -> DataFrame:
    return graphs.clustering_coefficients(clustered_edges(spark, d), "graph_id", "source_id", "target_id")


def hubs(spark: SparkSession, d: str) -> DataFrame:
    rows = graphs.hubs(clustered_edges(spark, d), "graph_id", "source_id", "target_id", 10)
    size, _ = graphs.visual_attributes(F.col("degree"), F.col("degree"))
    return rows.withColumn("node_size", size)


def connected_components(spark: SparkSession, d: str) -> DataFrame:
    return graphs.components(clustered_edges(spark, d), "source_id", "target_id")


def cluster_collapse(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "clustered_node").select("graph_id", F.col("node_id").alias("node"), F.lower(F.trim("label")).alias("label"))
    lead = nodes.where("label is not null").groupBy("graph_id", "label").agg(F.min("node").alias("cluster"))
    clusters = nodes.join(lead, ["graph_id", "label"]).select("graph_id", "node", "cluster")
    return graphs.collapse(clustered_edges(spark, d), clusters, "graph_id", "source_id", "target_id", F.col("cluster_size"))


def tfidf_top(spark: SparkSession, d: str) -> DataFrame:
    """Terms of a to z only, as its SQL says; `tfidf_words` takes those of every script."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    return concepts.top_terms(concepts.tfidf(concepts.terms(docs, "doc_id", "text", "[a-z]{2,}"), docs, "doc_id"), "doc_id", 5)


def tfidf_words(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    return concepts.top_terms(concepts.tfidf(concepts.terms(docs, "doc_id", "text"), docs, "doc_id"), "doc_id", 5)


def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return concepts.cooccurrence(table(spark, d, "raw_triplet"), "graph_id", "relation")


def cluster_representatives(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "clustered_node").where(F.size("embedding") == 96)
    return embeddings.representatives(rows, "graph_id", "node_id", "embedding")


def alignment(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    return embeddings.nearest_by_label(rows.where("vec_id % 50 = 0"), rows, "vec_id", "label", "embedding")


def side_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with an even label are the generated side, the others the reference; each query counts once, by its best match on the other side. Means are over the queries, ids divisible by 50."""
    side = F.when(F.col("label") % 2 == 0, "generated").otherwise("reference")
    rows = table(spark, d, "embeddings").select("vec_id", side.alias("side"), "embedding")
    queries = rows.where("vec_id % 50 = 0")
    best = embeddings.nearest_by_label(queries, rows, "vec_id", "side", "embedding").withColumnRenamed("side", "other")
    own = best.join(queries.select(F.col("vec_id").alias("query"), "side"), "query").where("side != other")
    return embeddings.side_metrics(own.select("side", "best"))


def hierarchy_levels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_node").select("graph_id", "node_id")
    return hierarchy.level_sizes(hierarchy.levels(rows, "graph_id", "node_id", 4), "graph_id")


def pronoun_antecedents(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of a graph stand for mentions in order, every fourth one for a pronoun."""
    k = F.col("node_id")
    rows = table(spark, d, "raw_node").select("graph_id", "node_id", F.coalesce("label", F.lit("")).alias("text"), F.floor(k / 3).alias("sent"))
    number = F.when(k % 7 == 0, "plural").otherwise("sing")
    gender = F.when(k % 11 == 0, "male").when(k % 13 == 0, "female").when(k % 3 == 0, "unknown").otherwise("neutral")
    mentions = rows.where("node_id % 4 != 0").select("graph_id", k.alias("token"), "sent", "text", F.when(k % 2 == 0, "nsubj").otherwise("dobj").alias("dep"), F.when(k % 5 == 0, "PROPN").otherwise("NOUN").alias("pos"), gender.alias("gender"), number.alias("number"))
    word = F.when(k % 16 == 0, "They").when(k % 16 == 4, "he").when(k % 16 == 8, "it").otherwise("went")
    pronouns = rows.where("node_id % 4 = 0").select("graph_id", k.alias("token"), "sent", word.alias("word"))
    return hierarchy.antecedents(pronouns, mentions, "graph_id")


def entity_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of a graph with similar vectors are one entity, named by the shortest label."""
    rows = table(spark, d, "clustered_node").where("size(embedding) = 96 and label is not null").select("graph_id", "node_id", "label", "embedding")
    pairs = resolution.pairs_within(rows, "graph_id", "node_id", "embedding", 0.85)
    return resolution.entity_classes(rows, pairs, "node_id", "label")


def first_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = resolution.first_spellings(table(spark, d, "raw_node").where("label is not null"), "graph_id", "node_id", "label")
    return resolution.ranked_cap(rows, "graph_id", F.length("label"), "node_id", 30).select("graph_id", "node_id", "label", "place")


def path_depths(spark: SparkSession, d: str) -> DataFrame:
    """Each node's parent is the smallest neighbour below it in its graph."""
    edges = clustered_edges(spark, d).where("source_id != target_id").select("graph_id", F.greatest("source_id", "target_id").alias("node"), F.least("source_id", "target_id").alias("parent"))
    up = edges.groupBy("graph_id", "node").agg(F.max("parent").alias("parent"))
    tree = table(spark, d, "clustered_node").select("graph_id", F.col("node_id").alias("node")).distinct().join(up, ["graph_id", "node"], "left")
    return hierarchy.paths_to_root(tree, "graph_id", "node", "parent")


def crawl_states(spark: SparkSession, d: str) -> DataFrame:
    """Each custom query stands for a crawl: its rows give criterion, page and whether more pages follow."""
    rows = pdf_rows(spark, d).groupBy("custom_query_id").agg(F.count("*").alias("n"), F.count_if(F.col("status") == 20).alias("k"))
    states = rows.select("custom_query_id", F.pmod("n", F.lit(3)).cast("int").alias("criterion_index"), F.col("k").cast("int").alias("page"), F.expr("if(n % 2 = 0, array(0), cast(array() as array<int>))").alias("done"), F.array(F.lit(True), F.lit(False), F.lit(False)).alias("repeats"), (F.col("n") % 5 == 0).alias("has_more"))
    return crawl.advance(states, F.lit(1000), 60).select("custom_query_id", "criterion_index", "page", F.size("done").alias("n_done"), "resume_at")


def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    return windows.run_to_end(windows.windowed_counts(stream, "ts", "event_type", 60, 30), spark)


QUERIES = {
    f.__name__: f
    for f in (
        source_breakdown, url_routing, url_reuse, relation_dedup, idempotent_append, latest_upsert, job_progress, finished_jobs, throughput_buckets, run_overlaps, trailing_outcomes, fair_claim, recent_list,
        chunk_windows, neighbour_context, pipe_triplets, graph_nodes, graph_edges, edge_merge, importance_sweep, degree_metrics, clustering_coefficients, hubs, connected_components, cluster_collapse,
        tfidf_top, tfidf_words, cooccurrence, cluster_representatives, alignment, side_metrics, hierarchy_levels, pronoun_antecedents, entity_resolution, first_labels, path_depths, crawl_states, stream_windows,
    )
} | queues.QUERIES | texts.QUERIES

_PDF = "(SELECT DISTINCT * FROM custom_query_pdf)"
_SOURCE = "CASE " + " ".join(f"WHEN {{}} LIKE '{p}' THEN '{n}'" for n, p in PATTERNS) + " ELSE 'other' END"
_case = lambda column: _SOURCE.replace("{}", column)
_PAIRS = "SELECT DISTINCT graph_id, least(source_id, target_id) AS u, greatest(source_id, target_id) AS v FROM clustered_edge WHERE source_id != target_id"
_DEGREES = f"""SELECT graph_id, node, sum(d)::BIGINT AS degree FROM (
  SELECT graph_id, u AS node, 1 AS d FROM ({_PAIRS}) UNION ALL SELECT graph_id, v, 1 FROM ({_PAIRS})
  UNION ALL SELECT DISTINCT graph_id, source_id, 2 FROM clustered_edge WHERE source_id = target_id) GROUP BY 1, 2"""
_TRIPLES = "SELECT graph_id, triplet_id, lower(trim(subject)) AS s, lower(trim(object)) AS o, lower(trim(relation)) AS r FROM raw_triplet WHERE lower(trim(subject)) != '' AND lower(trim(object)) != ''"
_NODES = f"""SELECT graph_id, row_number() OVER (PARTITION BY graph_id ORDER BY first_at) - 1 AS node, label, mentions FROM (
  SELECT graph_id, label, min(pos) AS first_at, count(*) AS mentions FROM (
    SELECT graph_id, triplet_id * 2 AS pos, s AS label FROM ({_TRIPLES}) UNION ALL SELECT graph_id, triplet_id * 2 + 1, o FROM ({_TRIPLES})) GROUP BY 1, 2)"""
_ALIGN = """SELECT query, label, max(sim) AS best, arg_min(vec_id, (-sim, vec_id)) AS nearest FROM
  (SELECT q.vec_id AS query, r.label, r.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS sim FROM embeddings r, (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q WHERE q.vec_id != r.vec_id) GROUP BY 1, 2"""

SQL: dict[str, str] = {
    "source_breakdown": f"""SELECT source, count(*) AS total, count(*) FILTER (state = 'downloaded') AS downloaded, count(*) FILTER (state = 'pending') AS pending, count(*) FILTER (state = 'unavailable') AS unavailable
      FROM (SELECT {_case("coalesce(lower(pdf_url), '')")} AS source, CASE WHEN status = 99 THEN 'unavailable' WHEN coalesce(destination_path, '') = '' THEN 'pending' WHEN destination_path = 'NA' THEN 'unavailable' ELSE 'downloaded' END AS state FROM {_PDF}) GROUP BY source""",
    "url_routing": f"""SELECT id, CASE WHEN contains(pdf_url, '#customquery_') THEN 'custom' WHEN contains(pdf_url, '#gujarati_law') THEN 'gujarati' WHEN contains(pdf_url, '#english_science') THEN 'english' WHEN contains(pdf_url, '#arxiv') THEN 'arxiv' ELSE 'root' END AS folder,
      regexp_replace(pdf_url, '#[^#]*$', '') AS url, concat_ws('_', custom_query_id, regexp_replace(source_name, '[^a-zA-Z0-9_-]', '_', 'g')) AS source_slug FROM {_PDF} WHERE pdf_url IS NOT NULL""",
    "url_reuse": f"""SELECT w.id, d.reuse FROM (SELECT id, split_part(pdf_url, '#', 1) AS base FROM {_PDF} WHERE pdf_url IS NOT NULL AND status = 0) w
      LEFT JOIN (SELECT split_part(pdf_url, '#', 1) AS base, min(destination_path) AS reuse FROM {_PDF} WHERE pdf_url IS NOT NULL AND destination_path NOT IN ('', 'NA') GROUP BY 1) d ON w.base = d.base""",
    "relation_dedup": "SELECT graph_id, min(triplet_id) AS first_id, count(*) AS copies FROM raw_triplet GROUP BY graph_id, subject, relation, object",
    "idempotent_append": f"""SELECT {_case("lower(base)")} AS source, count(*) AS n FROM (SELECT DISTINCT split_part(pdf_url, '#', 1) AS base FROM {_PDF} WHERE pdf_url IS NOT NULL) GROUP BY 1""",
    "latest_upsert": """WITH r AS (SELECT user_id, event_type, epoch_us(ts) AS seen_at, event_id FROM events),
      o AS (SELECT user_id, event_type, seen_at FROM r WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seen_at DESC, event_type DESC) = 1),
      n AS (SELECT user_id, event_type, seen_at FROM r WHERE event_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seen_at DESC, event_type DESC) = 1)
      SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.event_type, n.event_type) AS event_type,
        CASE WHEN o.user_id IS NULL THEN n.seen_at WHEN n.event_type = o.event_type AND o.seen_at < n.seen_at THEN n.seen_at ELSE o.seen_at END AS seen_at,
        CASE WHEN o.user_id IS NULL THEN false ELSE (o.event_type = n.event_type AND o.seen_at < n.seen_at) END AS refreshed, o.user_id IS NULL AS added FROM o FULL JOIN n ON o.user_id = n.user_id""",
    "job_progress": f"""WITH f AS (SELECT * FROM {_PDF}), j AS (SELECT job_id AS custom_query_id FROM raw_triplet UNION SELECT custom_query_id FROM f)
      SELECT j.custom_query_id, count(f.id) AS files, count(f.id) FILTER (status = 0) AS status_0, count(f.id) FILTER (status = 10) AS status_10, count(f.id) FILTER (status = 20) AS status_20, count(f.id) FILTER (status = 99) AS status_99
      FROM j LEFT JOIN f ON f.custom_query_id = j.custom_query_id GROUP BY 1""",
    "finished_jobs": "SELECT l_orderkey, count(*) AS files FROM lineitem GROUP BY 1 HAVING bool_and(l_linestatus = 'F')",
    "throughput_buckets": """WITH c AS (SELECT (epoch_us(ts) // 1000000) // 900 * 900 AS bucket, count(*) AS n FROM events GROUP BY 1), s AS (SELECT unnest(generate_series(min(bucket), max(bucket), 900)) AS bucket FROM c)
      SELECT s.bucket, coalesce(n, 0) AS n FROM s LEFT JOIN c ON s.bucket = c.bucket""",
    "run_overlaps": """WITH e AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= 14400000000 THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      g AS (SELECT user_id, t, sum(fresh) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS no FROM e), r AS (SELECT min(t) // 1000000 AS a, max(t) // 1000000 AS b FROM g GROUP BY user_id, no),
      s AS (SELECT unnest(generate_series(min(a) // 3600, max(b) // 3600)) AS k FROM r), x AS (SELECT unnest(generate_series(a // 3600, b // 3600)) AS k, a, b FROM r),
      c AS (SELECT k, count(*) AS n_runs, sum(least(b, (k + 1) * 3600) - greatest(a, k * 3600))::BIGINT AS covered_s FROM x GROUP BY 1)
      SELECT s.k * 3600 AS bucket, coalesce(n_runs, 0) AS n_runs, coalesce(covered_s, 0) AS covered_s FROM s LEFT JOIN c ON s.k = c.k""",
    "trailing_outcomes": "SELECT event_type, count(*) AS n, count(*) FILTER (value > 10) AS large, round(avg(value), 4) AS avg_value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS GROUP BY 1",
    "fair_claim": f"""SELECT id, source_name, round, place FROM (SELECT id, source_name, place, ceil(place / (CASE source_name WHEN 'preprints' THEN 3 WHEN 'reader' THEN 2 ELSE 1 END))::BIGINT AS round FROM
      (SELECT id, source_name, row_number() OVER (PARTITION BY source_name ORDER BY id) AS place FROM {_PDF} WHERE status = 0 AND pdf_url IS NOT NULL)) ORDER BY round, source_name, place LIMIT 500""",
    "recent_list": f"SELECT id, source_name, status FROM {_PDF} WHERE status IN (0, 20) ORDER BY id DESC LIMIT 50",
    "chunk_windows": r"""WITH p AS (SELECT chunk_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) != '') AS s FROM chunk WHERE text IS NOT NULL),
      w AS (SELECT chunk_id, s, unnest(generate_series(0, len(s) - 1, 2)) AS f FROM p WHERE len(s) > 0), k AS (SELECT * FROM w WHERE f = 0 OR f - 2 + 3 < len(s))
      SELECT chunk_id, (f // 2)::INT AS chunk, f::INT AS first_sentence, len(list_slice(s, f + 1, f + 3))::INT AS n_sentences, array_to_string(list_slice(s, f + 1, f + 3), ' ') AS text FROM k""",
    "neighbour_context": """WITH t AS (SELECT graph_id, chunk_id, CASE WHEN length(coalesce(text, '')) > 60 THEN left(coalesce(text, ''), 60) || '...' ELSE coalesce(text, '') END AS s FROM chunk)
      SELECT chunk_id, concat_ws(chr(10), lag(s) OVER w, lead(s) OVER w) AS context FROM t WINDOW w AS (PARTITION BY graph_id ORDER BY chunk_id)""",
    "pipe_triplets": r"""WITH l AS (SELECT triplet_id, regexp_replace(regexp_replace(trim('- ' || regexp_replace(concat_ws(' | ', subject, relation, object), '[ \t\n\r]+', ' ', 'g')), '^[- ]+', ''), '^[0-9.)]+\s*', '') AS b FROM raw_triplet WHERE subject IS NOT NULL AND object IS NOT NULL),
      p AS (SELECT triplet_id, """ + ", ".join(rf"""regexp_replace(trim(regexp_extract(b, '^(.+?)\s*\|\s*(.+?)\s*\|\s*(.+)$', {k})), '^["'']+|["'']+$', '', 'g') AS {c}""" for k, c in ((1, "subject"), (2, "relation"), (3, "object"))) + """ FROM l)
      SELECT * FROM p WHERE subject != '' AND relation != '' AND object != ''""",
    "graph_nodes": f"SELECT graph_id, node, label, mentions FROM ({_NODES})",
    "graph_edges": f"""WITH n AS ({_NODES}) SELECT e.graph_id, a.node AS source, b.node AS target, e.r AS relation, e.weight FROM (SELECT graph_id, s, o, r, count(*) AS weight FROM ({_TRIPLES}) GROUP BY 1, 2, 3, 4) e
      JOIN n a ON a.graph_id = e.graph_id AND a.label = e.s JOIN n b ON b.graph_id = e.graph_id AND b.label = e.o""",
    "edge_merge": "SELECT graph_id, subject, object, relation, count(*) AS weight FROM raw_triplet WHERE subject IS NOT NULL AND object IS NOT NULL GROUP BY 1, 2, 3, 4",
    "importance_sweep": """WITH t AS (SELECT e, r, printf('e=%.2f,r=%.2f', e, r) AS variant FROM (SELECT unnest([0.2, 0.4, 0.6])::DOUBLE AS e), (SELECT unnest([0.2, 0.5])::DOUBLE AS r)),
      n AS (SELECT graph_id, node_id, cluster_size / (cluster_size + 2.0::DOUBLE) AS s FROM clustered_node), k AS (SELECT graph_id, variant, node_id FROM n, t WHERE s >= e),
      g AS (SELECT c.graph_id, variant, source_id, target_id FROM clustered_edge c JOIN n a ON a.graph_id = c.graph_id AND a.node_id = source_id JOIN n b ON b.graph_id = c.graph_id AND b.node_id = target_id, t
        WHERE cluster_size / (cluster_size + 2.0::DOUBLE) >= r AND a.s >= e AND b.s >= e),
      x AS (SELECT graph_id, variant, source_id AS node_id FROM g UNION SELECT graph_id, variant, target_id FROM g), m AS (SELECT graph_id, variant, count(*) AS n_edges FROM g GROUP BY 1, 2)
      SELECT k.graph_id, k.variant, count(*) AS n_nodes, coalesce(any_value(m.n_edges), 0) AS n_edges, count(*) FILTER (x.node_id IS NULL) AS n_orphans
      FROM k LEFT JOIN x ON x.graph_id = k.graph_id AND x.variant = k.variant AND x.node_id = k.node_id LEFT JOIN m ON m.graph_id = k.graph_id AND m.variant = k.variant GROUP BY 1, 2""",
    "degree_metrics": f"""WITH d AS (SELECT n.graph_id, coalesce(x.degree, 0) AS degree FROM (SELECT DISTINCT graph_id, node_id FROM clustered_node) n LEFT JOIN ({_DEGREES}) x ON x.graph_id = n.graph_id AND x.node = n.node_id),
      p AS (SELECT graph_id, count(*) AS n, (sum(degree) // 2)::BIGINT AS e, round(avg(degree), 6) AS avg_degree, max(degree) AS max_degree, min(degree) AS min_degree FROM d GROUP BY 1)
      SELECT *, CASE WHEN n > 1 THEN round(2.0::DOUBLE * e / (n * (n - 1)), 6) ELSE 0.0 END::DOUBLE AS density FROM p""",
    "clustering_coefficients": f"""WITH p AS ({_PAIRS}), b AS (SELECT graph_id, u AS x, v AS y FROM p UNION ALL SELECT graph_id, v, u FROM p), k AS (SELECT graph_id, x AS node, count(*) AS k FROM b GROUP BY 1, 2),
      t AS (SELECT a.graph_id, a.x AS node, count(*) AS t FROM b a JOIN b c ON a.graph_id = c.graph_id AND a.x = c.x AND a.y < c.y JOIN p ON p.graph_id = a.graph_id AND p.u = a.y AND p.v = c.y GROUP BY 1, 2)
      SELECT k.graph_id, k.node, CASE WHEN k > 1 THEN round(2.0::DOUBLE * coalesce(t, 0) / (k * (k - 1)), 6) ELSE 0.0 END::DOUBLE AS coefficient FROM k LEFT JOIN t ON t.graph_id = k.graph_id AND t.node = k.node""",
    "hubs": f"""SELECT graph_id, node, degree, place, least(greatest(10 + 5 * degree, 10), 40) AS node_size FROM (SELECT *, row_number() OVER (PARTITION BY graph_id ORDER BY degree DESC, node) AS place FROM ({_DEGREES})) WHERE place <= 10""",
    "connected_components": """WITH RECURSIVE b AS (SELECT source_id AS x, target_id AS y FROM clustered_edge UNION SELECT target_id, source_id FROM clustered_edge), r(node, seen) AS (SELECT x, x FROM b UNION SELECT r.node, b.y FROM r JOIN b ON r.seen = b.x)
      SELECT node, min(seen) AS component FROM r GROUP BY 1""",
    "cluster_collapse": """WITH n AS (SELECT graph_id, node_id, lower(trim(label)) AS label FROM clustered_node), c AS (SELECT graph_id, node_id, min(node_id) OVER (PARTITION BY graph_id, label) AS cluster FROM n WHERE label IS NOT NULL),
      e AS (SELECT e.graph_id, coalesce(a.cluster, source_id) AS source, coalesce(b.cluster, target_id) AS target, cluster_size FROM clustered_edge e LEFT JOIN c a ON a.graph_id = e.graph_id AND a.node_id = source_id LEFT JOIN c b ON b.graph_id = e.graph_id AND b.node_id = target_id)
      SELECT graph_id, source, target, count(*) AS size, sum(cluster_size)::BIGINT AS weight FROM e WHERE source != target GROUP BY 1, 2, 3""",
    "tfidf_top": """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS term FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2), d AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
      n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, term, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS v FROM c JOIN d USING (term), n),
      s AS (SELECT doc_id, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS score FROM x) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS place FROM s) WHERE place <= 5""",
    "tfidf_words": r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]{2,}')) AS term FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2), d AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
      n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, term, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS v FROM c JOIN d USING (term), n),
      s AS (SELECT doc_id, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS score FROM x) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS place FROM s) WHERE place <= 5""",
    "cooccurrence": "WITH i AS (SELECT DISTINCT graph_id, relation FROM raw_triplet) SELECT a.relation AS a, b.relation AS b, count(*) AS n FROM i a JOIN i b ON a.graph_id = b.graph_id AND a.relation < b.relation GROUP BY 1, 2 HAVING count(*) >= 2",
    "cluster_representatives": """WITH v AS (SELECT graph_id, node_id, embedding::DOUBLE[] AS e FROM clustered_node WHERE len(embedding) = 96), l AS (SELECT graph_id, unnest(generate_series(1, 96)) AS p, unnest(e) AS x FROM v),
      m AS (SELECT graph_id, list(a ORDER BY p) AS m FROM (SELECT graph_id, p, avg(x) AS a FROM l GROUP BY 1, 2) GROUP BY 1),
      s AS (SELECT graph_id, node_id, CASE WHEN list_dot_product(e, e) > 0 AND list_dot_product(m, m) > 0 THEN round(list_dot_product(e, m) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(m, m))), 6) END AS similarity FROM v JOIN m USING (graph_id))
      SELECT graph_id, node_id, similarity, size FROM (SELECT *, count(*) OVER (PARTITION BY graph_id) AS size, row_number() OVER (PARTITION BY graph_id ORDER BY similarity DESC NULLS LAST, node_id) AS rn FROM s) WHERE rn = 1""",
    "alignment": _ALIGN,
    "side_metrics": """WITH s AS (SELECT vec_id, label % 2 AS side, embedding::DOUBLE[] AS e FROM embeddings), b AS (SELECT q.vec_id, q.side, round(max(list_cosine_similarity(q.e, r.e)), 6) AS best FROM s q JOIN s r ON q.side != r.side WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
      m AS (SELECT avg(best) FILTER (side = 0) AS p, avg(best) FILTER (side = 1) AS r FROM b) SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM m""",
    "hierarchy_levels": """WITH RECURSIVE l AS (SELECT graph_id, 0 AS level, count(*) AS n FROM raw_node GROUP BY 1 UNION ALL SELECT graph_id, level + 1, ceil(n / 4)::BIGINT FROM l WHERE n > 1 AND level < 9) SELECT graph_id, level, n FROM l""",
    "pronoun_antecedents": """WITH r AS (SELECT graph_id, node_id, coalesce(label, '') AS text, node_id // 3 AS sent, CASE WHEN node_id % 7 = 0 THEN 'plural' ELSE 'sing' END AS number,
        CASE WHEN node_id % 11 = 0 THEN 'male' WHEN node_id % 13 = 0 THEN 'female' WHEN node_id % 3 = 0 THEN 'unknown' ELSE 'neutral' END AS gender,
        CASE node_id % 16 WHEN 0 THEN 'unknown' WHEN 4 THEN 'male' WHEN 8 THEN 'neutral' END AS g, CASE node_id % 16 WHEN 0 THEN 'plural' WHEN 4 THEN 'sing' WHEN 8 THEN 'sing' END AS n FROM raw_node),
      m AS (SELECT p.graph_id, p.node_id AS token, m.text, m.node_id, greatest(0, 100 - 25 * (p.sent - m.sent)) + CASE WHEN m.node_id % 2 = 0 THEN 80 ELSE 50 END + CASE WHEN m.node_id % 5 = 0 THEN 30 ELSE 0 END AS score
        FROM r p JOIN r m ON p.graph_id = m.graph_id AND m.node_id < p.node_id AND m.node_id % 4 != 0 AND m.number = p.n AND (p.g = 'unknown' OR m.gender = 'unknown' OR m.gender = p.g) WHERE p.node_id % 4 = 0),
      b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY graph_id, token ORDER BY score DESC, node_id) = 1)
      SELECT p.graph_id, p.node_id AS token, b.text AS antecedent, coalesce(b.score, -1)::INT AS score FROM r p LEFT JOIN b ON b.graph_id = p.graph_id AND b.token = p.node_id WHERE p.node_id % 4 = 0""",
    "entity_resolution": """WITH RECURSIVE v AS (SELECT graph_id, node_id, label, embedding::DOUBLE[] AS e FROM clustered_node WHERE len(embedding) = 96 AND label IS NOT NULL),
      p AS (SELECT a.node_id AS x, b.node_id AS y FROM v a JOIN v b ON a.graph_id = b.graph_id AND a.node_id != b.node_id WHERE a.e = b.e OR (list_dot_product(a.e, a.e) > 0 AND list_dot_product(b.e, b.e) > 0
        AND round(list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))), 6) >= 0.85)),
      r(node, seen) AS (SELECT node_id, node_id FROM v UNION SELECT r.node, p.y FROM r JOIN p ON r.seen = p.x), c AS (SELECT node AS node_id, min(seen) AS class FROM r GROUP BY 1)
      SELECT node_id, class, first_value(label) OVER (PARTITION BY class ORDER BY length(label), lower(label), label) AS representative FROM c JOIN v USING (node_id)""",
    "first_labels": """WITH f AS (SELECT graph_id, arg_min(label, node_id) AS label, min(node_id) AS node_id FROM raw_node WHERE label IS NOT NULL AND trim(label) != '' GROUP BY graph_id, lower(trim(label)))
      SELECT graph_id, node_id, label, place FROM (SELECT *, row_number() OVER (PARTITION BY graph_id ORDER BY length(label), node_id) AS place FROM f) WHERE place <= 30""",
    "path_depths": """WITH RECURSIVE u AS (SELECT graph_id, greatest(source_id, target_id) AS node, max(least(source_id, target_id)) AS parent FROM clustered_edge WHERE source_id != target_id GROUP BY 1, 2),
      t AS (SELECT DISTINCT n.graph_id, n.node_id AS node, u.parent FROM clustered_node n LEFT JOIN u ON u.graph_id = n.graph_id AND u.node = n.node_id),
      w AS (SELECT graph_id, node, node AS top, parent, 0 AS depth FROM t UNION ALL SELECT w.graph_id, w.node, t.node, t.parent, depth + 1 FROM w JOIN t ON t.graph_id = w.graph_id AND t.node = w.parent)
      SELECT graph_id, node, depth, top AS root FROM w WHERE parent IS NULL""",
    "crawl_states": """WITH c AS (SELECT custom_query_id, count(*) AS n, count(*) FILTER (status = 20) AS k FROM (SELECT DISTINCT * FROM custom_query_pdf) GROUP BY 1),
      s AS (SELECT custom_query_id, (n % 3)::INT AS i, k::INT AS page, CASE WHEN n % 2 = 0 THEN [0] ELSE []::INT[] END AS done, n % 5 = 0 AS more FROM c),
      d AS (SELECT *, CASE WHEN more OR i = 0 THEN done ELSE list_distinct(list_append(done, i)) END AS done2 FROM s),
      f AS (SELECT *, CASE WHEN more THEN i WHEN NOT list_contains(done2, (i + 1) % 3) THEN (i + 1) % 3 WHEN NOT list_contains(done2, (i + 2) % 3) THEN (i + 2) % 3 WHEN NOT list_contains(done2, i) THEN i END AS nxt FROM d)
      SELECT custom_query_id, nxt AS criterion_index, CASE WHEN more THEN page + 1 ELSE 1 END AS page, len(done2)::INT AS n_done, CASE WHEN NOT more AND i = 0 AND nxt <= i THEN 1060 END AS resume_at FROM f""",
    "stream_windows": """SELECT (epoch_us(ts) // 3600000000) * 3600 AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2
      HAVING (epoch_us(any_value(ts)) // 3600000000 + 1) * 3600000000 <= (SELECT max(epoch_us(ts)) FROM events) - 1800000000""",
} | queues.SQL | texts.SQL
