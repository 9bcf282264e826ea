"""Fixtures restated from the behaviour the operators must have."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import text as fn
from textloom.operators import acquisition, chunks, embeddings, graphs, hierarchy, timeline
from textloom.sources import files


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_edge_merge(spark):
    old = spark.createDataFrame([("cat", "dog", "chases", 1)], "a string, b string, r string, weight bigint")
    new = spark.createDataFrame([("cat", "dog", "chases"), ("cat", "fish", "eats")], "a string, b string, r string")
    assert rows(graphs.merge_edges(old, new, ["a", "b", "r"])) == [("cat", "dog", "chases", 2), ("cat", "fish", "eats", 1)]
    assert rows(graphs.merge_edges(old.limit(0), new.limit(0), ["a", "b", "r"])) == []


def test_metrics_of_a_triangle(spark):
    edges = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 1, 3), (1, 3, 1)], "graph_id int, a int, b int")
    nodes = spark.createDataFrame([(1, k) for k in (1, 2, 3)], "graph_id int, node int")
    m = graphs.degree_metrics(nodes, edges, "graph_id", "a", "b", "node").first()
    assert (m["n"], m["e"], m["density"], m["max_degree"], m["min_degree"]) == (3, 3, 1.0, 2, 2)
    assert rows(graphs.clustering_coefficients(edges, "graph_id", "a", "b"), "node", "coefficient") == [(1, 1.0), (2, 1.0), (3, 1.0)]


def test_components_of_a_path_a_pair_and_a_loop(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 20)] + [(50, 51), (70, 70)], "a int, b int")
    got = dict(rows(graphs.components(edges, "a", "b")))
    assert all(got[k] == 1 for k in range(1, 21)) and got[50] == got[51] == 50 and got[70] == 70 and len(got) == 23
    assert graphs.components(edges.limit(0), "a", "b").count() == 0


def test_salience(spark):
    df = spark.createDataFrame([(0, "nsubj", "NOUN"), (1, "nsubj", "NOUN"), (4, "nsubj", "NOUN"), (0, "dobj", "NOUN"), (0, "pobj", "NOUN"), (0, "nsubj", "PROPN")], "d int, dep string, pos string")
    assert [r[0] for r in df.select(fn.salience(F.col("d"), F.col("dep"), F.col("pos"))).collect()] == [180, 155, 80, 150, 140, 210]


def test_antecedent_ties_take_the_earliest(spark):
    mentions = spark.createDataFrame([(1, 0, 0, "Alice", "nsubj", "PROPN", "unknown", "sing"), (1, 1, 0, "Bob", "nsubj", "PROPN", "unknown", "sing")], "g int, token int, sent int, text string, dep string, pos string, gender string, number string")
    pronouns = spark.createDataFrame([(1, 5, 1, "she"), (2, 1, 0, "she")], "g int, token int, sent int, word string")
    assert rows(hierarchy.antecedents(pronouns, mentions, "g"), "g", "antecedent", "score") == [(1, "Alice", 185), (2, None, -1)]


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 40), st.integers(1, 8), st.integers(0, 8))
def test_window_starts_match_the_loop(spark, n, size, overlap):
    want, start, step = [], 0, max(1, size - overlap)
    while n and start < n:
        want.append(start)
        if start + size >= n:
            break
        start += step
    got = spark.range(1).select(chunks.window_starts(F.lit(n), F.lit(size), F.lit(overlap))).first()[0]
    assert got == want


def test_pipe_lines(spark):
    df = spark.createDataFrame([("- a | b | c | d",), ("3D x | is | y",), ("a | b",), ("1. 'q' | r | \"s\"",), (None,), ("",)], "line string")
    got = [r[0] for r in df.select(fn.pipe_triplet(F.col("line"))).collect()]
    assert [tuple(x) if x else None for x in got] == [("a", "b", "c | d"), ("D x", "is", "y"), None, ("q", "r", "s"), None, None]


def test_upsert_guard(spark):
    old = spark.createDataFrame([("1.1.1.1", 80, 10), ("2.2.2.2", 80, 10)], "ip string, port int, at int")
    new = spark.createDataFrame([("1.1.1.1", 80, 20), ("2.2.2.2", 81, 20), ("3.3.3.3", 80, 5)], "ip string, port int, at int")
    assert rows(acquisition.upsert_latest(old, new, "ip", "port", "at"), "ip", "port", "at") == [("1.1.1.1", 80, 20), ("2.2.2.2", 80, 10), ("3.3.3.3", 80, 5)]


def test_jobs(spark):
    files_ = spark.createDataFrame([(1, 20), (1, 20), (2, 20), (2, 10)], "job int, status int")
    jobs = spark.createDataFrame([(1,), (2,), (3,)], "job int")
    assert rows(acquisition.finished_jobs(files_, "job", "status", 20)) == [(1, 2)]
    assert rows(acquisition.job_progress(jobs, files_, "job", "status", [10, 20])) == [(1, 2, 0, 2), (2, 2, 1, 1), (3, 0, 0, 0)]
    assert rows(acquisition.guarded_transition(files_, "status", 10, 15), "status") == [(15,), (20,), (20,), (20,)]


def test_claims(spark):
    pending = spark.createDataFrame([(k, "a") for k in range(6)] + [(10, "b"), (11, "b")], "id int, source string")
    got = [(r["id"], r["round"]) for r in acquisition.claim(pending, "source", ["id"], 5, {"a": 3}).collect()]
    assert got == [(0, 1), (1, 1), (2, 1), (10, 1), (3, 2)]
    times = spark.createDataFrame([(1, None), (2, "2024-01-01 00:00:00"), (3, "2024-01-01 00:09:00")], "id int, t string").withColumn("t", F.to_timestamp("t"))
    assert rows(acquisition.stale_claims(times, "t", F.lit("2024-01-01 00:10:00").cast("timestamp")), "id") == [(1,), (2,)]


def test_gaps_are_filled(spark):
    df = spark.createDataFrame([("2024-01-01 00:01:00",), ("2024-01-01 00:46:00",)], "t string").select(F.to_timestamp("t").alias("t"))
    assert [r["n"] for r in timeline.filled_buckets(df, "t", 15).orderBy("bucket").collect()] == [1, 0, 0, 1]
    assert timeline.filled_buckets(df.limit(0), "t", 15).count() == 0


def test_representative_ties_take_the_smaller_id(spark):
    df = spark.createDataFrame([(1, 2, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 3, [0.0, 1.0])], "g int, id int, v array<float>")
    r = embeddings.representatives(df, "g", "id", "v").first()
    assert (r["id"], r["size"]) == (1, 3)


def test_importance_labels(spark):
    df = spark.createDataFrame([("core",), ("0.3",), ("7",), ("odd",), (None,)], "x string")
    assert [r[0] for r in df.select(fn.importance(F.col("x"))).collect()] == [1.0, 0.3, 1.0, 0.5, 0.5]


def test_graph_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"nodes": [{"id": "n1", "label": "é"}], "edges": []}')
    (tmp_path / "b.json").write_text('{"variants": {"x": {"nodes": [{"id": "n1"}], "edges": []}, "y": {"nodes": [], "edges": []}}}')
    (tmp_path / "c.txt").write_text("text of c")
    got = files.graph_files(spark, str(tmp_path / "*.json"))
    assert sorted((r["variant"] or "", len(r["nodes"])) for r in got.collect()) == [("", 1), ("x", 1), ("y", 0)]
    assert rows(files.text_folder(spark, str(tmp_path))) == [("c", "text of c")]
    stats = files.folder_statistics(spark, str(tmp_path), "2000-01-01 00:00:00").first()
    assert (stats["files"], stats["recent"]) == (3, 3)
    files.write_json(got, str(tmp_path / "out"))
    assert "é" in "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))


CRAWL = [  # (index, page, done), repeats, has_more -> (index, page, done), waits
    ((0, 3, []), [True], True, (0, 4, []), False),
    ((1, 2, [0]), [False, False], True, (1, 3, [0]), False),
    ((0, 5, []), [True, True], False, (1, 1, []), False),
    ((0, 5, []), [True], False, (0, 1, []), True),
    ((0, 2, [1]), [True, False, True], False, (2, 1, [1]), False),
    ((0, 2, []), [False, False], False, (1, 1, [0]), False),
    ((0, 2, []), [False], False, (None, 1, [0]), False),
    ((1, 2, [0]), [False, False], False, (None, 1, [0, 1]), False),
    ((1, 2, []), [True, False], False, (0, 1, [1]), False),
]


def test_crawl_states(spark):
    from textloom.operators import crawl

    data = [(k, *state, repeats, more) for k, (state, repeats, more, _, _) in enumerate(CRAWL)]
    df = spark.createDataFrame(data, "k int, criterion_index int, page int, done array<int>, repeats array<boolean>, has_more boolean")
    for r in crawl.advance(df, F.lit(100), 60).collect():
        want, waits = CRAWL[r["k"]][3:]
        assert (r["criterion_index"], r["page"], sorted(r["done"])) == want, r["k"]
        assert r["resume_at"] == (160 if waits else None), r["k"]
    assert spark.range(1).select(crawl.paused(F.lit(1000), F.lit(500)), crawl.paused(F.lit(500), F.lit(1000)), crawl.paused(F.lit(None).cast("int"), F.lit(1))).first()[:] == (True, False, False)


def test_paths_and_cycles(spark):
    tree = spark.createDataFrame([(1, k, k - 1 if k else None) for k in range(40)] + [(2, 1, 2), (2, 2, 1)], "g int, node int, parent int")
    got = {(r["g"], r["node"]): (r["depth"], r["root"]) for r in hierarchy.paths_to_root(tree.where("g = 1"), "g", "node", "parent").collect()}
    assert got[1, 39] == (39, 0) and got[1, 0] == (0, 0)


def test_entities_take_the_shortest_name(spark):
    from textloom.operators import resolution

    rows = spark.createDataFrame([(1, 1, "the cat", [1.0, 0.0]), (1, 2, "Cat", [1.0, 0.01]), (1, 3, "dog", [0.0, 1.0]), (1, 4, "null", [0.0, 0.0])], "g int, id int, name string, v array<float>")
    pairs = resolution.pairs_within(rows, "g", "id", "v", 0.85)
    got = {r["id"]: (r["class"], r["representative"]) for r in resolution.entity_classes(rows, pairs, "id", "name").collect()}
    assert got == {1: (1, "Cat"), 2: (1, "Cat"), 3: (3, "dog"), 4: (4, "null")}


def test_terms_of_every_script(spark):
    from textloom.operators import concepts

    rows = spark.createDataFrame([(1, "Größe größe x"), (2, "Знание 知识图谱"), (3, "ज्ञान ความรู้"), (4, "a_1 B2")], "doc int, text string")
    got = {(r["doc"], r["term"]): r["tf"] for r in concepts.terms(rows, "doc", "text").collect()}
    assert got == {(1, "größe"): 2, (2, "знание"): 1, (2, "知识图谱"): 1, (3, "ज्ञान"): 1, (3, "ความรู้"): 1, (4, "a_1"): 1, (4, "b2"): 1}
