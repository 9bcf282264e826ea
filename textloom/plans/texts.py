"""Queries over extraction, texts and graph reports, and their SQL, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as fn
from textloom.operators import concepts, embeddings, extraction, graphs, hierarchy, resolution
from textloom.operators.places import placed
from textloom.session import materialize, table

STOP_WORDS = ["the", "of", "and", "with", "that", "und", "die", "der", "что", "для"]


def edges_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clustered_edge").select("edge_id", "graph_id", "source_id", "target_id", "label", "cluster_size", "embedding")


def replies(spark: SparkSession, d: str) -> DataFrame:
    """Ten triplets of a graph as a model's reply each: fenced, with words before it, or plain."""
    rows = table(spark, d, "raw_triplet").groupBy("graph_id", F.floor(F.col("triplet_id") / 10).alias("part")).agg(F.array_sort(F.collect_list(F.struct("triplet_id", "subject", "relation", "object"))).alias("x"))
    weight = lambda t: F.when(t["triplet_id"] % 3 == 0, F.lit("core")).when(t["triplet_id"] % 3 == 1, F.lit("0.25"))
    made = F.transform("x", lambda t: F.struct(t["subject"].alias("subject"), t["relation"].alias("predicate"), t["object"].alias("object"), weight(t).alias("importance"), F.when(t["triplet_id"] % 2 == 0, F.lit("1.5")).alias("confidence")))
    names = F.transform("x", lambda t: F.struct(t["subject"].alias("mention_text"), F.when(t["triplet_id"] % 2 == 0, t["object"]).alias("canonical_name"), weight(t).alias("importance")))
    body = F.to_json(F.struct(names.alias("entities"), made.alias("triplets")))
    k = F.col("part") % 3
    return rows.select("graph_id", "part", F.when(k == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 1, F.concat(F.lit("Here it is: "), body)).otherwise(body).alias("reply"))


def reply_triplets(spark: SparkSession, d: str) -> DataFrame:
    rows = extraction.triplets_of(extraction.parsed_replies(replies(spark, d), ["graph_id", "part"], "reply"), ["graph_id", "part"])
    return rows.select("graph_id", "part", "pos", "subject", "predicate", "object", "importance", "confidence")


def reply_entities(spark: SparkSession, d: str) -> DataFrame:
    return extraction.entities_of(extraction.parsed_replies(replies(spark, d), ["graph_id", "part"], "reply"), ["graph_id", "part"]).select("graph_id", "part", "pos", "mention", "name", "importance")


def broken_replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies that break off behind their first triplet: what is whole comes out."""
    cut = F.locate('},{"subject"', F.col("reply"))
    rows = replies(spark, d).where(cut > 0).select("graph_id", "part", F.substring("reply", F.lit(1), cut + 12).alias("reply"))
    parsed = extraction.parsed_replies(rows, ["graph_id", "part"], "reply")
    return parsed.select("graph_id", "part", F.size("reply.triplets").alias("triplets"), F.size("reply.entities").alias("entities"), "truncated")


def normalized_terms(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_node").where("label is not null and length(label) = octet_length(label)")
    label = F.regexp_replace("label", r"\s+", " ")
    given = F.when(F.col("node_id") % 7 == 0, F.upper(F.substring(F.regexp_replace(label, "[^A-Za-z]", ""), 1, 6))).otherwise(F.concat(F.lit("The "), label))
    return rows.select("node_id", extraction.normalized(given, "en").alias("term"), extraction.chunk_label(given).alias("chunk_label"))


def weighted_graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    entities = table(spark, d, "raw_node").select("graph_id", "node_id", F.col("label").alias("name"), ((F.col("node_id") % 10) / 10).alias("importance"))
    triplets = table(spark, d, "raw_triplet").select("graph_id", F.col("triplet_id").alias("node_id"), "subject", F.col("relation").alias("predicate"), "object", ((F.col("triplet_id") % 10) / 10).alias("importance"))
    return graphs.assemble_weighted(entities, triplets, "graph_id", "node_id")


def weighted_nodes(spark: SparkSession, d: str) -> DataFrame:
    return weighted_graph(spark, d)[0]


def weighted_edges(spark: SparkSession, d: str) -> DataFrame:
    return weighted_graph(spark, d)[1]


def greedy_triplets(spark: SparkSession, d: str) -> DataFrame:
    """Nodes that a greedy pass keeps among the similar ones of a graph; the label stands for the relation."""
    rows = table(spark, d, "clustered_node").where(F.size("embedding") == 96)
    return extraction.greedy_dedup(rows, ["graph_id"], "node_id", "embedding", "label", 0.85)


def substituted_texts(spark: SparkSession, d: str) -> DataFrame:
    """The first two words of each text swapped by changes with places, marked in every other text."""
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("text")).where(r"text rlike '^\\S+ \\S+ '")
    word = lambda k: F.split("text", " ")[k]
    change = lambda start, old, new: F.struct(start.cast("int").alias("start"), (start + F.length(old)).cast("int").alias("stop"), old.alias("original"), new.alias("replacement"))
    changes = F.array(change(F.lit(0), word(0), word(1)), change(F.length(word(0)) + 1, word(1), word(0)), change(F.lit(0), word(0), F.lit(None).cast("string")))
    made = F.when(F.col("doc_id") % 2 == 0, extraction.substituted(F.col("text"), changes)).otherwise(extraction.substituted(F.col("text"), changes, mark=True))
    return rows.select("doc_id", F.md5(made).alias("digest"))


def head_changes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of a graph with one label, whatever its case, as spans of a coreference cluster."""
    spans = table(spark, d, "raw_node").where("label is not null and trim(label) != ''").select("graph_id", F.lower(F.trim("label")).alias("cluster"), F.col("node_id").alias("start"), (F.col("node_id") + 1).alias("stop"), "label")
    return extraction.cluster_heads(spans, ["graph_id", "cluster"], "start", "stop", "label").select("graph_id", "start", "original", "replacement", "score")


def term_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows around the first word of a node's label in the chunks that mention it."""
    mentions = table(spark, d, "raw_node").where("label is not null and length(label) = octet_length(label)").select("graph_id", "node_id", F.substring_index(F.trim("label"), " ", 1).alias("label"), F.explode("mentions.chunk_id").alias("id")).where("id is not null and length(label) > 3").distinct()
    rows = mentions.join(table(spark, d, "chunk").where("text is not null").select("graph_id", "id", "text"), ["graph_id", "id"])
    found = rows.select("node_id", "id", F.posexplode(extraction.windows_around(F.col("text"), F.col("label"), 40, 8)).alias("pos", "window"))
    return found.select("node_id", "id", "pos", F.md5("window").alias("digest"))


def edge_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows around both ends of a triplet in its chunk."""
    rows = table(spark, d, "raw_triplet").where("subject is not null and object is not null and length(trim(subject)) > 3 and length(trim(object)) > 3").select("graph_id", "triplet_id", F.trim("subject").alias("s"), F.trim("object").alias("o"), F.col("chunk_id").alias("id"))
    rows = rows.join(table(spark, d, "chunk").where("text is not null").select("graph_id", "id", "text"), ["graph_id", "id"])
    return rows.select("triplet_id", F.size(extraction.pair_windows(F.col("text"), F.col("s"), F.col("o"))).alias("windows")).where("windows > 0")


def coreference_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sentence").distinct().where("text is not null")
    made = extraction.context_windows(rows, ["graph_id"], "id", "text")
    return made.select("graph_id", "window", F.md5("context").alias("context"), F.md5("text").alias("text"))


def summary_leaves(spark: SparkSession, d: str) -> DataFrame:
    """Every other chunk has a summary as JSON, the others' can't be read."""
    good = F.to_json(F.struct(F.concat(F.lit("About "), "id").alias("summary"), F.col("origin").alias("topic"), F.array(F.struct(F.lit(" index ").alias("name"), F.lit("Core").alias("importance")), F.struct(F.lit("x").alias("name"), F.lit("odd").alias("importance"))).alias("key_concepts")))
    rows = table(spark, d, "chunk").select("chunk_id", "text", F.when(F.col("chunk_id") % 2 == 0, F.concat(F.lit("```json\n"), good, F.lit("\n```"))).otherwise("sorry").alias("reply"))
    made = extraction.leaves(rows, ["chunk_id"], "reply", "text")
    return made.select("chunk_id", F.md5(F.coalesce("summary", F.lit(""))).alias("summary"), "topic", F.array_join(F.transform("concepts", lambda c: F.concat(c["name"], F.lit(":"), c["importance"])), ",").alias("concepts"))


def contexts(spark: SparkSession, d: str) -> DataFrame:
    """Root, path, concepts and neighbours of each chunk as one context."""
    from textloom.operators import chunks

    rows = table(spark, d, "chunk").select("graph_id", "chunk_id", "id", F.coalesce("text", F.lit("")).alias("text"))
    near = chunks.neighbour_context(rows, ["graph_id"], "chunk_id", "text", 2, 200)
    roots = table(spark, d, "raw_graph").select("graph_id", F.coalesce("source_text", F.lit("")).alias("root"))
    made = extraction.assembled_context(F.coalesce("root", F.lit("")), F.array("id"), F.array(F.lit("a"), F.lit("b")), F.col("context"), 600)
    return near.join(roots, "graph_id", "left").select("chunk_id", F.md5(made).alias("digest"), F.length(made).alias("n"))


def noun_terms(spark: SparkSession, d: str) -> DataFrame:
    stop = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    rows = extraction.noun_concepts(table(spark, d, "documents").where("text is not null"), "doc_id", "text", stop)
    return rows.groupBy("concept").agg(F.count("*").alias("documents"), F.sum("n").alias("n"))


def selected_terms(spark: SparkSession, d: str) -> DataFrame:
    """The vocabulary: terms among the fifteen best of any document."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    top = concepts.top_terms(concepts.tfidf(concepts.terms(docs, "doc_id", "text"), docs, "doc_id"), "doc_id", 15)
    return top.select("term").distinct()


def source_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that a graph's nodes come from, in the order of first mention."""
    rows = table(spark, d, "raw_node").select("graph_id", "node_id", F.posexplode("mentions.chunk_id").alias("pos", "chunk"))
    made = extraction.ordered_distinct(rows.withColumn("at", F.col("node_id") * 1000 + F.col("pos")), "graph_id", "at", "chunk")
    return made.select("graph_id", F.array_join("values", ",").alias("chunks"))


def grown_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "raw_node").select("graph_id", F.col("label").alias("node"))
    return graphs.grown_nodes(nodes, table(spark, d, "raw_triplet"), "graph_id", "node", ["subject", "object"])


def valid_edges(spark: SparkSession, d: str) -> DataFrame:
    return graphs.valid_edges(table(spark, d, "raw_triplet"), "subject", "object").select("triplet_id", "graph_id")


def loopless_edges(spark: SparkSession, d: str) -> DataFrame:
    rows = graphs.assemble(table(spark, d, "raw_triplet"), "graph_id", "triplet_id", "subject", "relation", "object", loops=False)[1]
    return rows.groupBy("graph_id").agg(F.count("*").alias("edges"), F.sum("weight").alias("weight"))


def zipped_sweep(spark: SparkSession, d: str) -> DataFrame:
    score = F.col("cluster_size") / (F.col("cluster_size") + 2.0)
    nodes = table(spark, d, "clustered_node").select("graph_id", F.col("node_id").alias("node"), score.alias("score"))
    edges = edges_of(spark, d).select("graph_id", F.col("source_id").alias("source"), F.col("target_id").alias("target"), score.alias("score"))
    levels = [0.2, 0.4, 0.6], [0.2, 0.3, 0.5]
    rows = graphs.importance_sweep(nodes, edges, *levels, zipped=True, drop_orphans=True)
    return rows.withColumn("is_default", F.col("variant") == graphs.default_variant(*levels, zipped=True))


def degree_histogram(spark: SparkSession, d: str) -> DataFrame:
    return graphs.degree_histogram(table(spark, d, "clustered_node"), edges_of(spark, d), "graph_id", "source_id", "target_id", "node_id")


def degree_maps(spark: SparkSession, d: str) -> DataFrame:
    maps = graphs.histogram_maps(degree_histogram(spark, d), "graph_id")
    pairs = F.transform(F.map_entries("degrees"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return maps.select("graph_id", F.array_join(pairs, ",").alias("degrees"), F.coalesce(F.try_element_at("degrees", F.lit(1).cast("bigint")), F.lit(0)).alias("leaves"))


def report_rows(spark: SparkSession, d: str) -> DataFrame:
    """Datasets of a degree chart: every degree that the first graph has, for each graph; missing ones are 0."""
    rows = materialize(degree_histogram(spark, d), "degree-histogram")
    first = rows.join(rows.agg(F.min("graph_id").alias("graph_id")), "graph_id", "left_semi").select("degree")
    spine = rows.select("graph_id").distinct().crossJoin(first)  # the degrees of one graph
    return spine.join(rows, ["graph_id", "degree"], "left").fillna(0, ["n"])


def report_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = graphs.degree_metrics(table(spark, d, "clustered_node"), edges_of(spark, d), "graph_id", "source_id", "target_id", "node_id")
    return rows.agg(F.count("*").alias("graphs"), F.sum("n").alias("nodes"), F.sum("e").alias("edges"), F.round(F.avg("density"), 4).alias("density"))


def mean_clustering(spark: SparkSession, d: str) -> DataFrame:
    return graphs.mean_clustering(table(spark, d, "clustered_node"), edges_of(spark, d), "graph_id", "source_id", "target_id", "node_id")


def component_shares(spark: SparkSession, d: str) -> DataFrame:
    return graphs.component_shares(table(spark, d, "clustered_node"), edges_of(spark, d), "graph_id", "source_id", "target_id", "node_id")


def path_lengths(spark: SparkSession, d: str) -> DataFrame:
    return graphs.path_lengths(table(spark, d, "clustered_node"), edges_of(spark, d), "graph_id", "source_id", "target_id", "node_id")


def leaf_nodes(spark: SparkSession, d: str) -> DataFrame:
    return graphs.leaf_nodes(edges_of(spark, d), "graph_id", "source_id", "target_id")


def ranked_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The twenty nodes of the highest degree, and of the highest clustering coefficient."""
    e = edges_of(spark, d)
    by_degree = graphs.ranked(graphs.degrees(e, "graph_id", "source_id", "target_id"), "degree", "node", 20).select(F.lit("degree").alias("list"), "node", F.col("degree").cast("double").alias("value"))
    by_clustering = graphs.ranked(graphs.clustering_coefficients(e, "graph_id", "source_id", "target_id"), "coefficient", "node", 20).select(F.lit("clustering").alias("list"), "node", F.col("coefficient").alias("value"))
    return by_degree.unionByName(by_clustering)


def collapsed_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges between clusters with the label of the edge nearest to the group's mean and the largest importance."""
    nodes = table(spark, d, "clustered_node").select("graph_id", F.col("node_id").alias("node"), F.lower(F.trim("label")).alias("label"))
    lead = nodes.where("label is not null").groupBy("graph_id", "label").agg(F.min("node").alias("cluster"))
    clusters = nodes.join(lead, ["graph_id", "label"]).select("graph_id", "node", "cluster")
    side = lambda c, name: clusters.select("graph_id", F.col("node").alias(c), F.col("cluster").alias(name))
    e = edges_of(spark, d).join(side("source_id", "cs"), ["graph_id", "source_id"], "left").join(side("target_id", "ct"), ["graph_id", "target_id"], "left")
    e = e.select("edge_id", "label", "embedding", "cluster_size", F.concat_ws(" ", "graph_id", F.coalesce("cs", "source_id"), F.coalesce("ct", "target_id")).alias("pair"), (F.coalesce("cs", "source_id") != F.coalesce("ct", "target_id")).alias("apart")).where("apart")
    e = materialize(e, "collapsing")
    lead = embeddings.representatives(e.where(F.size("embedding") == 96), "pair", "edge_id", "embedding").select("pair", "edge_id")
    named = lead.join(e.select("edge_id", "label"), "edge_id").select("pair", F.col("label").alias("near_label"))
    groups = e.groupBy("pair").agg(F.count("*").alias("size"), F.max("cluster_size").alias("importance"), F.min_by("label", "edge_id").alias("first_label"))
    return groups.join(named, "pair", "left").select("pair", "size", "importance", F.coalesce("near_label", "first_label").alias("label"))


def pooled_labels(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.pooled(table(spark, d, "embeddings"), "label", "embedding").select("label", "place", F.round("value", 6).alias("value"))


def alignment_extremes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    best = embeddings.nearest_by_label(rows.where("vec_id % 50 = 0"), rows, "vec_id", "label", "embedding")
    return embeddings.extremes(best.select("query", "label", "best"), "best", ["query", "label"], 10)


def promoted_edges(spark: SparkSession, d: str) -> DataFrame:
    return graphs.promoted(table(spark, d, "clustered_node").select("graph_id", "node_id"), edges_of(spark, d).select("edge_id", "graph_id", "source_id", "target_id"), "graph_id", "node_id", "source_id", "target_id")[1]


def drawn_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Radius of each cluster's node in a drawing of its graph, and width of its edge."""
    rows = table(spark, d, "clustered_node").select("graph_id", "node_id", "cluster_size")
    span = rows.groupBy("graph_id").agg(F.min("cluster_size").alias("low"), F.max("cluster_size").alias("high"))
    drawn = rows.join(span, "graph_id")
    return drawn.select("node_id", F.round(graphs.cluster_radius(F.col("cluster_size"), F.col("low"), F.col("high")), 6).alias("radius"), graphs.edge_width(F.col("cluster_size")).alias("width"))


def kmeans_clusters(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.kmeans(table(spark, d, "embeddings"), "vec_id", "embedding")


def top_level(spark: SparkSession, d: str) -> DataFrame:
    """Levels of groups of four until at most twenty nodes remain, with a root above them."""
    rows = table(spark, d, "raw_node").select("graph_id", "node_id")
    tree = materialize(hierarchy.levels(rows, "graph_id", "node_id", 4, top=20), "tree")
    last = tree.groupBy("graph_id").agg(F.max("level").alias("level"))
    tops = tree.join(last, ["graph_id", "level"]).groupBy("graph_id", "level").agg(F.count("*").alias("tops"))
    return tops.select("graph_id", "level", "tops", F.when(F.col("tops") == 1, F.concat(F.lit("L"), "level", F.lit("N0"))).otherwise("root").alias("root"))


def token_relations(spark: SparkSession, d: str) -> DataFrame:
    """Triplets as parsed sentences: subject, verb and object as tokens."""
    token = lambda text, pos, dep: F.struct(text.alias("text"), text.alias("lemma"), F.lit(pos).alias("pos"), F.lit(dep).alias("dep"), F.lit(1).alias("head"))
    rows = table(spark, d, "raw_triplet").where("subject is not null and object is not null")
    parsed = rows.select("triplet_id", F.array(token(F.col("subject"), "NOUN", "nsubj"), token(F.col("relation"), "VERB", "ROOT"), token(F.col("object"), "PROPN", "dobj")).alias("tokens"))
    return extraction.token_relations(parsed, ["triplet_id"], "tokens")


def aggregation_parts(spark: SparkSession, d: str) -> DataFrame:
    """Eight chunks of a graph are summarised together, in halves where their text is too long."""
    rows = placed(table(spark, d, "chunk").select("graph_id", "chunk_id", F.length(F.coalesce("text", F.lit(""))).alias("size")), ["graph_id"], "chunk_id", "no")
    groups = rows.groupBy("graph_id", F.floor(F.col("no") / 8).alias("part")).agg(F.transform(F.array_sort(F.collect_list(F.struct("no", "size"))), lambda x: x["size"].cast("bigint")).alias("sizes"))
    cut = hierarchy.aggregation_parts(F.col("sizes"), 1500, 3)  # eight children are halved twice at most
    return groups.select("graph_id", "part", F.array_join(F.transform(cut, lambda s: F.concat_ws("-", s["start"], s["stop"])), ",").alias("cut"))


def capped_concepts(spark: SparkSession, d: str) -> DataFrame:
    """The thirty foremost labels of each graph: core before supporting before peripheral, then as they come; each once whatever its case."""
    rank = F.pmod("node_id", F.lit(3))
    rows = table(spark, d, "raw_node").where("trim(label) != ''").select("graph_id", "label", (rank * 1_000_000_000 + F.col("node_id")).alias("at"), F.element_at(F.array(*map(F.lit, ("core", "supporting", "peripheral"))), (rank + 1).cast("int")).alias("importance"))
    named = resolution.first_spellings(rows, "graph_id", "at", "label")
    return resolution.ranked_cap(named, "graph_id", F.col("at"), "label", 30).select("graph_id", "label", "place")


QUERIES = {
    f.__name__: f
    for f in (
        reply_triplets, reply_entities, broken_replies, normalized_terms, weighted_nodes, weighted_edges, greedy_triplets, substituted_texts, head_changes, term_windows, edge_windows, coreference_windows, summary_leaves,
        contexts, noun_terms, selected_terms, source_chunks, grown_nodes, valid_edges, loopless_edges, zipped_sweep, degree_histogram, degree_maps, report_rows, report_totals, mean_clustering, component_shares, path_lengths,
        leaf_nodes, ranked_nodes, collapsed_edges, pooled_labels, alignment_extremes, promoted_edges, drawn_clusters, kmeans_clusters, top_level, token_relations, aggregation_parts, capped_concepts,
    )
}

_PAIRS = "SELECT DISTINCT graph_id, least(source_id, target_id) AS u, greatest(source_id, target_id) AS v FROM clustered_edge WHERE source_id != target_id"
_DEGREES = f"""SELECT graph_id, node, sum(d)::BIGINT AS degree FROM (
  SELECT graph_id, u AS node, 1 AS d FROM ({_PAIRS}) UNION ALL SELECT graph_id, v, 1 FROM ({_PAIRS})
  UNION ALL SELECT DISTINCT graph_id, source_id, 2 FROM clustered_edge WHERE source_id = target_id) GROUP BY 1, 2"""
_HISTOGRAM = f"SELECT n.graph_id, coalesce(degree, 0) AS degree, count(*) AS n FROM (SELECT DISTINCT graph_id, node_id FROM clustered_node) n LEFT JOIN ({_DEGREES}) x ON x.graph_id = n.graph_id AND x.node = n.node_id GROUP BY 1, 2"
_COEFFICIENTS = f"""SELECT k.graph_id, k.node, CASE WHEN k > 1 THEN round(2.0::DOUBLE * coalesce(t, 0) / (k * (k - 1)), 6) ELSE 0.0 END::DOUBLE AS coefficient FROM
  (SELECT graph_id, x AS node, count(*) AS k FROM b GROUP BY 1, 2) k LEFT JOIN
  (SELECT a.graph_id, a.x AS node, count(*) AS t FROM b a JOIN b c ON a.graph_id = c.graph_id AND a.x = c.x AND a.y < c.y JOIN p ON p.graph_id = a.graph_id AND p.u = a.y AND p.v = c.y GROUP BY 1, 2) t ON t.graph_id = k.graph_id AND t.node = k.node"""
_BOTH = f"p AS ({_PAIRS}), b AS (SELECT graph_id, u AS x, v AS y FROM p UNION ALL SELECT graph_id, v, u FROM p)"
_PARTS = "r AS (SELECT *, triplet_id // 10 AS part, row_number() OVER (PARTITION BY graph_id, triplet_id // 10 ORDER BY triplet_id) - 1 AS pos FROM raw_triplet)"
_IMPORTANCE = "CASE triplet_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.25 ELSE 0.5 END::DOUBLE"
_WEIGHTED = """t AS (SELECT graph_id, triplet_id, trim(coalesce(subject, ''), ' ') AS s, trim(relation, ' ') AS r, trim(coalesce(object, ''), ' ') AS o, (triplet_id % 10) / 10.0::DOUBLE AS i FROM raw_triplet WHERE trim(relation, ' ') != ''),
  a AS (SELECT graph_id, 0 AS late, node_id * 2 AS place, trim(label, ' ') AS label, (node_id % 10) / 10.0::DOUBLE AS i FROM raw_node WHERE label IS NOT NULL UNION ALL SELECT graph_id, 1, triplet_id * 2, s, i FROM t UNION ALL SELECT graph_id, 1, triplet_id * 2 + 1, o, i FROM t),
  n AS (SELECT *, row_number() OVER (PARTITION BY graph_id ORDER BY late, place) - 1 AS node FROM (SELECT graph_id, label, min(late) AS late, min(place) FILTER (late = l) AS place, max(i) AS importance, count(*) AS mentions FROM
    (SELECT *, min(late) OVER (PARTITION BY graph_id, label) AS l FROM a WHERE label != '') GROUP BY 1, 2))"""
_ALIGNED = """SELECT q.vec_id AS query, r.label, round(max(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[])), 6) AS best
  FROM embeddings r, (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q WHERE q.vec_id != r.vec_id GROUP BY 1, 2"""

SQL: dict[str, str] = {
    "reply_triplets": f"""WITH {_PARTS} SELECT graph_id, part, pos::INT AS pos, trim(subject, ' ') AS subject, trim(relation, ' ') AS predicate, trim(object, ' ') AS object, {_IMPORTANCE} AS importance, 1.0::DOUBLE AS confidence FROM r
      WHERE trim(subject, ' ') != '' AND trim(relation, ' ') != '' AND trim(object, ' ') != ''""",
    "reply_entities": f"""WITH {_PARTS}, e AS (SELECT *, trim(coalesce(CASE WHEN triplet_id % 2 = 0 THEN nullif(object, '') END, subject, ''), ' ') AS name FROM r)
      SELECT graph_id, part, pos::INT AS pos, trim(coalesce(nullif(subject, ''), name), ' ') AS mention, name, {_IMPORTANCE} AS importance FROM e WHERE name != ''""",
    "normalized_terms": r"""WITH r AS (SELECT node_id, regexp_replace(label, '[\s]+', ' ', 'g') AS l FROM raw_node WHERE label IS NOT NULL AND length(label) = strlen(label)), g AS (SELECT node_id, CASE WHEN node_id % 7 = 0 THEN upper(left(regexp_replace(l, '[^A-Za-z]', '', 'g'), 6)) ELSE 'The ' || l END AS g FROM r),
      w AS (SELECT node_id, trim(g, ' ') AS b, list_filter(string_split(lower(trim(g, ' ')), ' '), lambda w: w != '') AS w FROM g)
      SELECT node_id, CASE WHEN b = '' OR (b = upper(b) AND b != lower(b) AND length(b) <= 6) THEN b ELSE array_to_string(list_filter(w, lambda x: x NOT IN ('some', 'this', 'these', 'certain', 'various', 'the', 'a', 'an')), ' ') END AS term,
        array_to_string(list_filter(w, lambda x: x NOT IN ('the', 'a', 'an')), ' ') AS chunk_label FROM w""",
    "weighted_nodes": f"WITH {_WEIGHTED} SELECT graph_id, node, label, importance, mentions FROM n",
    "weighted_edges": f"""WITH {_WEIGHTED}, e AS (SELECT graph_id, s, o, r, count(*) AS weight, max(i) AS importance FROM t WHERE s != '' AND o != '' GROUP BY 1, 2, 3, 4)
      SELECT e.graph_id, x.node AS source, y.node AS target, r AS relation, weight, e.importance FROM e JOIN n x ON x.graph_id = e.graph_id AND x.label = s JOIN n y ON y.graph_id = e.graph_id AND y.label = o""",
    "substituted_texts": r"""WITH d AS (SELECT doc_id, regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL), w AS (SELECT doc_id, t, string_split(t, ' ')[1] AS a, string_split(t, ' ')[2] AS b FROM d WHERE regexp_matches(t, '^[^ \t\n\x0B\f\r]+ [^ \t\n\x0B\f\r]+ '))
      SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN b || ' ' || a ELSE b || '{' || a || '} ' || a || '{' || b || '}' END || t[length(a) + length(b) + 2:]) AS digest FROM w""",
    "head_changes": """WITH s AS (SELECT graph_id, lower(trim(label, ' ')) AS c, node_id, label FROM raw_node WHERE label IS NOT NULL AND trim(label, ' ') != ''), h AS (SELECT graph_id, c, min(node_id) AS first, arg_min(label, node_id) AS head FROM s GROUP BY 1, 2)
      SELECT s.graph_id, node_id AS start, label AS original, head AS replacement, 1.0::DOUBLE AS score FROM s JOIN h ON h.graph_id = s.graph_id AND h.c = s.c WHERE node_id != first""",
    "term_windows": """WITH m AS (SELECT DISTINCT graph_id, node_id, split_part(trim(label, ' '), ' ', 1) AS l, unnest(list_transform(mentions, lambda m: m.chunk_id)) AS id FROM raw_node WHERE label IS NOT NULL AND length(label) = strlen(label)),
      p AS (SELECT node_id, c.id, c.text, m.l, string_split(lower(c.text), lower(m.l)) AS s FROM m JOIN chunk c ON c.graph_id = m.graph_id AND c.id = m.id WHERE c.text IS NOT NULL AND length(m.l) > 3),
      k AS (SELECT *, unnest(generate_series(0, least(len(s) - 1, 8) - 1)) AS k FROM p WHERE len(s) > 1), o AS (SELECT *, list_sum(list_transform(s[1:k + 1], lambda x: length(x)))::BIGINT + k * length(l) AS spot FROM k)
      SELECT node_id, id, k::INT AS pos, md5(substring(text, greatest(spot - 40, 0) + 1, least(spot, 40) + length(l) + 40)) AS digest FROM o""",
    "coreference_windows": """WITH s AS (SELECT DISTINCT * FROM sentence), t AS (SELECT graph_id, id, sentence_id, text FROM s WHERE text IS NOT NULL), w AS (SELECT graph_id, id // 5 AS w, string_agg(text, ' ' ORDER BY id, text) AS text FROM t GROUP BY 1, 2),
      c AS (SELECT graph_id, id // 5 + 1 AS w, string_agg(text, ' ' ORDER BY id, text) AS text FROM t WHERE id % 5 >= 2 GROUP BY 1, 2) SELECT w.graph_id, w.w AS "window", md5(coalesce(c.text, '')) AS context, md5(w.text) AS text FROM w LEFT JOIN c ON c.graph_id = w.graph_id AND c.w = w.w""",
    "summary_leaves": """SELECT chunk_id, md5(coalesce(CASE WHEN chunk_id % 2 = 0 THEN 'About ' || id ELSE left(text, 240) END, '')) AS summary, CASE WHEN chunk_id % 2 = 0 THEN coalesce(origin, '') ELSE '' END AS topic,
      CASE WHEN chunk_id % 2 = 0 THEN 'index:core,x:supporting' ELSE '' END AS concepts FROM chunk""",
    "contexts": """WITH t AS (SELECT graph_id, chunk_id, id, CASE WHEN length(coalesce(text, '')) > 200 THEN left(coalesce(text, ''), 200) || '...' ELSE coalesce(text, '') END AS s FROM chunk),
      n AS (SELECT *, concat_ws(chr(10), lag(s, 2) OVER w, lag(s) OVER w, lead(s) OVER w, lead(s, 2) OVER w) AS c FROM t WINDOW w AS (PARTITION BY graph_id ORDER BY chunk_id)),
      x AS (SELECT chunk_id, concat_ws(chr(10) || chr(10), nullif(source_text, ''), nullif(id, ''), 'a, b', nullif(c, '')) AS x FROM n LEFT JOIN raw_graph g ON g.graph_id = n.graph_id), y AS (SELECT chunk_id, CASE WHEN length(x) > 600 THEN left(x, 600) || '…' ELSE x END AS y FROM x)
      SELECT chunk_id, md5(y) AS digest, length(y)::INT AS n FROM y""",
    "noun_terms": r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+')) AS c FROM documents WHERE text IS NOT NULL) SELECT c AS concept, count(DISTINCT doc_id) AS documents, count(*) AS n FROM w
      WHERE length(c) >= 3 AND c NOT IN ("""
    + ", ".join(f"'{w}'" for w in STOP_WORDS)
    + ") GROUP BY 1",
    "selected_terms": r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]{2,}')) AS term FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2), d AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
      n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, term, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS v FROM c JOIN d USING (term), n),
      s AS (SELECT doc_id, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS score FROM x) SELECT DISTINCT term FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS place FROM s) WHERE place <= 15""",
    "source_chunks": """WITH m AS (SELECT graph_id, node_id, unnest(mentions).chunk_id AS c, generate_subscripts(mentions, 1) AS p FROM raw_node), f AS (SELECT graph_id, c, min(node_id * 1000 + p) AS spot FROM m WHERE c IS NOT NULL GROUP BY 1, 2)
      SELECT graph_id, string_agg(c, ',' ORDER BY spot, c) AS chunks FROM f GROUP BY 1""",
    "grown_nodes": "SELECT DISTINCT graph_id, node FROM (SELECT graph_id, label AS node FROM raw_node UNION ALL SELECT graph_id, subject FROM raw_triplet UNION ALL SELECT graph_id, object FROM raw_triplet) WHERE node IS NOT NULL",
    "valid_edges": "SELECT triplet_id, graph_id FROM raw_triplet WHERE trim(coalesce(subject, ''), ' ') != '' AND trim(coalesce(object, ''), ' ') != '' AND trim(subject, ' ') != trim(object, ' ')",
    "loopless_edges": """WITH t AS (SELECT graph_id, lower(trim(subject)) AS s, lower(trim(object)) AS o, lower(trim(relation)) AS r FROM raw_triplet), k AS (SELECT graph_id, s, o, r, count(*) AS w FROM t WHERE s != '' AND o != '' AND s != o AND r IS NOT NULL GROUP BY 1, 2, 3, 4)
      SELECT graph_id, count(*) AS edges, sum(w)::BIGINT AS weight FROM k GROUP BY 1""",
    "zipped_sweep": """WITH t AS (SELECT unnest([0.2, 0.4, 0.6])::DOUBLE AS e, unnest([0.2, 0.3, 0.5])::DOUBLE AS r), v AS (SELECT *, printf('e=%.2f,r=%.2f', e, r) AS variant FROM t),
      n AS (SELECT graph_id, node_id, cluster_size / (cluster_size + 2.0::DOUBLE) AS s FROM clustered_node), k AS (SELECT graph_id, variant, node_id FROM n, v WHERE s >= e),
      g AS (SELECT c.graph_id, variant, source_id, target_id FROM clustered_edge c JOIN n a ON a.graph_id = c.graph_id AND a.node_id = source_id JOIN n b ON b.graph_id = c.graph_id AND b.node_id = target_id, v
        WHERE cluster_size / (cluster_size + 2.0::DOUBLE) >= r AND a.s >= e AND b.s >= e),
      x AS (SELECT graph_id, variant, source_id AS node_id FROM g UNION SELECT graph_id, variant, target_id FROM g), m AS (SELECT graph_id, variant, count(*) AS n_edges FROM g GROUP BY 1, 2)
      SELECT k.graph_id, k.variant, count(x.node_id) AS n_nodes, coalesce(any_value(m.n_edges), 0) AS n_edges, count(*) FILTER (x.node_id IS NULL) AS n_orphans, k.variant = 'e=0.40,r=0.30' AS is_default
      FROM k LEFT JOIN x ON x.graph_id = k.graph_id AND x.variant = k.variant AND x.node_id = k.node_id LEFT JOIN m ON m.graph_id = k.graph_id AND m.variant = k.variant GROUP BY 1, 2""",
    "degree_histogram": _HISTOGRAM,
    "degree_maps": f"WITH h AS ({_HISTOGRAM}) SELECT graph_id, string_agg(degree || '=' || n, ',' ORDER BY degree) AS degrees, coalesce(max(n) FILTER (degree = 1), 0) AS leaves FROM h GROUP BY 1",
    "report_rows": f"WITH h AS ({_HISTOGRAM}), f AS (SELECT degree FROM h WHERE graph_id = (SELECT min(graph_id) FROM h)), s AS (SELECT g.graph_id, f.degree FROM (SELECT DISTINCT graph_id FROM h) g, f) SELECT s.graph_id, s.degree, coalesce(n, 0) AS n FROM s LEFT JOIN h ON h.graph_id = s.graph_id AND h.degree = s.degree",
    "report_totals": f"""WITH p AS (SELECT graph_id, sum(n)::BIGINT AS n, (sum(degree * n) // 2)::BIGINT AS e FROM ({_HISTOGRAM}) GROUP BY 1)
      SELECT count(*) AS graphs, sum(n)::BIGINT AS nodes, sum(e)::BIGINT AS edges, round(avg(CASE WHEN n > 1 THEN round(2.0::DOUBLE * e / (n * (n - 1)), 6) ELSE 0.0 END), 4) AS density FROM p""",
    "mean_clustering": f"WITH {_BOTH}, c AS ({_COEFFICIENTS}) SELECT n.graph_id, round(avg(coalesce(coefficient, 0)), 4) AS clustering FROM (SELECT DISTINCT graph_id, node_id FROM clustered_node) n LEFT JOIN c ON c.graph_id = n.graph_id AND c.node = n.node_id GROUP BY 1",
    "component_shares": """WITH RECURSIVE b AS (SELECT source_id AS x, target_id AS y FROM clustered_edge UNION SELECT target_id, source_id FROM clustered_edge), r(node, seen) AS (SELECT x, x FROM b UNION SELECT r.node, b.y FROM r JOIN b ON r.seen = b.x),
      c AS (SELECT node, min(seen) AS c FROM r GROUP BY 1), s AS (SELECT graph_id, coalesce(c, node_id) AS c, count(*) AS k FROM (SELECT DISTINCT graph_id, node_id FROM clustered_node) LEFT JOIN c ON node = node_id GROUP BY 1, 2)
      SELECT graph_id, sum(k)::BIGINT AS n, count(*) AS components, round(max(k) / sum(k)::DOUBLE, 6) AS largest FROM s GROUP BY 1""",
    "leaf_nodes": f"SELECT graph_id, node FROM ({_DEGREES}) WHERE degree = 1",
    "ranked_nodes": f"""WITH {_BOTH}, c AS ({_COEFFICIENTS}) SELECT 'degree' AS list, node, degree::DOUBLE AS value FROM (SELECT * FROM ({_DEGREES}) ORDER BY degree DESC, node LIMIT 20)
      UNION ALL SELECT 'clustering', node, coefficient FROM (SELECT * FROM c ORDER BY coefficient DESC, node LIMIT 20)""",
    "collapsed_edges": """WITH n AS (SELECT graph_id, node_id, min(node_id) OVER (PARTITION BY graph_id, lower(trim(label))) AS cluster FROM clustered_node WHERE label IS NOT NULL),
      e AS (SELECT edge_id, e.label, embedding::DOUBLE[] AS v, cluster_size, e.graph_id || ' ' || coalesce(a.cluster, source_id) || ' ' || coalesce(b.cluster, target_id) AS pair FROM clustered_edge e
        LEFT JOIN n a ON a.graph_id = e.graph_id AND a.node_id = source_id LEFT JOIN n b ON b.graph_id = e.graph_id AND b.node_id = target_id WHERE coalesce(a.cluster, source_id) != coalesce(b.cluster, target_id)),
      w AS (SELECT * FROM e WHERE len(v) = 96), l AS (SELECT pair, unnest(generate_series(1, 96)) AS p, unnest(v) AS x FROM w), m AS (SELECT pair, list(a ORDER BY p) AS m FROM (SELECT pair, p, avg(x) AS a FROM l GROUP BY 1, 2) GROUP BY 1),
      s AS (SELECT pair, edge_id, w.label, CASE WHEN list_dot_product(v, v) > 0 AND list_dot_product(m, m) > 0 THEN round(list_dot_product(v, m) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(m, m))), 6) END AS sim FROM w JOIN m USING (pair)),
      k AS (SELECT pair, label FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY sim DESC NULLS LAST, edge_id) AS p FROM s) WHERE p = 1), g AS (SELECT pair, count(*) AS size, max(cluster_size) AS importance, arg_min(label, edge_id) AS first FROM e GROUP BY 1)
      SELECT g.pair, size, importance, coalesce(k.label, first) AS label FROM g LEFT JOIN k ON k.pair = g.pair""",
    "pooled_labels": """WITH d AS (SELECT DISTINCT label, embedding::DOUBLE[] AS v FROM embeddings), l AS (SELECT label, unnest(generate_series(0, len(v) - 1)) AS place, unnest(v) AS x FROM d), m AS (SELECT label, place, avg(x) AS a FROM l GROUP BY 1, 2)
      SELECT label, place::INT AS place, round(a / sqrt(sum(a * a) OVER (PARTITION BY label)), 6) AS value FROM m""",
    "alignment_extremes": f"""WITH b AS ({_ALIGNED}) SELECT query, label, best, 'best' AS "end" FROM (SELECT * FROM b ORDER BY best DESC, query, label LIMIT 10) UNION ALL SELECT query, label, best, 'worst' FROM (SELECT * FROM b ORDER BY best, query, label LIMIT 10)""",
    "promoted_edges": """WITH n AS (SELECT graph_id, node_id, 'c' || (row_number() OVER (PARTITION BY graph_id ORDER BY node_id) - 1) AS id FROM clustered_node)
      SELECT e.graph_id, 'ce' || (row_number() OVER (PARTITION BY e.graph_id ORDER BY edge_id) - 1) AS id, a.id AS source, b.id AS target FROM clustered_edge e JOIN n a ON a.graph_id = e.graph_id AND a.node_id = source_id JOIN n b ON b.graph_id = e.graph_id AND b.node_id = target_id""",
    "drawn_clusters": """WITH s AS (SELECT *, min(cluster_size) OVER (PARTITION BY graph_id) AS low, max(cluster_size) OVER (PARTITION BY graph_id) AS high FROM clustered_node)
      SELECT node_id, round(18 + 40 * CASE WHEN high > low THEN (cluster_size - low) / (high - low)::DOUBLE ELSE 0.0 END::DOUBLE, 6) AS radius, (1 + least(0.5::DOUBLE * cluster_size, 4.0::DOUBLE)) AS width FROM s""",
    "token_relations": "SELECT triplet_id, subject, relation, object FROM raw_triplet WHERE subject IS NOT NULL AND object IS NOT NULL",
    "aggregation_parts": """WITH RECURSIVE c AS (SELECT graph_id, (row_number() OVER (PARTITION BY graph_id ORDER BY chunk_id) - 1) AS no, length(coalesce(text, '')) AS size FROM chunk),
      g AS (SELECT graph_id, no // 8 AS part, list(size ORDER BY no) AS sizes FROM c GROUP BY 1, 2),
      s AS (SELECT graph_id, part, sizes, 0 AS a, len(sizes)::INT AS b FROM g UNION ALL
        SELECT graph_id, part, sizes, CASE WHEN h = 0 THEN a ELSE a + (b - a) // 2 END::INT, CASE WHEN h = 0 THEN a + (b - a) // 2 ELSE b END::INT FROM s, (VALUES (0), (1)) AS v(h) WHERE b - a > 2 AND list_sum(sizes[a + 1:b]) > 1500)
      SELECT graph_id, part, string_agg(a || '-' || b, ',' ORDER BY a) AS cut FROM s WHERE NOT (b - a > 2 AND list_sum(sizes[a + 1:b]) > 1500) GROUP BY 1, 2""",
    "capped_concepts": """WITH r AS (SELECT graph_id, label, node_id % 3 AS k, node_id, row_number() OVER (PARTITION BY graph_id, lower(trim(label, ' ')) ORDER BY node_id % 3, node_id) AS first FROM raw_node WHERE trim(label, ' ') != '')
      SELECT graph_id, label, place FROM (SELECT graph_id, label, row_number() OVER (PARTITION BY graph_id ORDER BY k, node_id) AS place FROM r WHERE first = 1) WHERE place <= 30""",
    "top_level": """WITH RECURSIVE l AS (SELECT graph_id, 0 AS level, count(*) AS n FROM raw_node GROUP BY 1 UNION ALL SELECT graph_id, level + 1, ceil(n / 4)::BIGINT FROM l WHERE n > 20 AND level < 9)
      SELECT graph_id, max(level) AS level, arg_max(n, level) AS tops, CASE WHEN arg_max(n, level) = 1 THEN 'L' || max(level) || 'N0' ELSE 'root' END AS root FROM l GROUP BY 1""",
}
