"""States, reports, extraction and graph extras on small cases and against brute force."""

import json
import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as fn
from textloom.operators import embeddings, extraction, graphs, hierarchy, lifecycle, pages, places, reports
from textloom.streaming import windows


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_places_and_running_best_equal_the_plain_window(spark):
    lot = random.Random(1)
    data = [(g, o, lot.randint(0, 9)) for g in (1, 2) for o in lot.sample(range(400), 120)]
    df = spark.createDataFrame(data, "g int, o bigint, v int")
    want = sorted((g, o, sorted(x for k, x, _ in data if k == g).index(o)) for g, o, _ in data)
    assert rows(places.placed(df, ["g"], "o", "n", width=32), "g", "o", "n") == sorted(want, key=str)
    asked = spark.createDataFrame([(g, o) for g in (1, 2, 3) for o in (0, 77, 200, 399)], "g int, o bigint")
    got = {(r["g"], r["o"]): r["v"] for r in places.running_best(df, asked, "g", "o", "v", width=32).collect()}
    assert got == {(g, o): max((v for k, x, v in data if k == g and x < o), default=None) for g in (1, 2, 3) for o in (0, 77, 200, 399)}


def test_antecedents_agree_and_may_be_far(spark):
    mentions = [(1, 0, 0, "Alice", "nsubj", "PROPN", "unknown", "sing"), (1, 90, 9, "tables", "dobj", "NOUN", "neutral", "plural"), (1, 95, 7, "box", "iobj", "NOUN", "neutral", "sing")]
    m = spark.createDataFrame(mentions, "g int, token bigint, sent int, text string, dep string, pos string, gender string, number string")
    p = spark.createDataFrame([(1, 100, 10, "he"), (1, 101, 10, "They"), (1, 102, 10, "it"), (1, 103, 10, "went"), (2, 5, 0, "she")], "g int, token bigint, sent int, word string")
    assert rows(hierarchy.antecedents(p, m, "g"), "token", "antecedent", "score") == [(100, "Alice", 110), (101, "tables", 125), (102, "Alice", 110), (103, None, -1), (5, None, -1)]
    agree = lambda word, gender, number: one(spark, hierarchy.compatible(F.lit(word), F.lit(gender), F.lit(number)))
    assert [agree(*x) for x in (("he", "male", "sing"), ("he", "female", "sing"), ("they", "unknown", "sing"), ("it", "unknown", "sing"), ("went", "male", "sing"))] == [True, False, False, True, False]


def change(start, stop, original, replacement):
    return F.struct(F.lit(start).alias("start"), F.lit(stop).alias("stop"), F.lit(original).alias("original"), F.lit(replacement).cast("string").alias("replacement"))


def test_substitution(spark):
    text = F.lit("Alice went to the store. She bought milk.")
    she = F.array(change(25, 28, "She", "Alice"), change(0, 5, "Alice", None))
    assert one(spark, extraction.substituted(text, she)) == "Alice went to the store. Alice bought milk."
    assert one(spark, extraction.substituted(text, she, mark=True)) == "Alice went to the store. Alice{She} bought milk."
    assert one(spark, extraction.substituted(F.lit("A B C D E"), F.array(change(2, 3, "B", "Y"), change(6, 7, "D", "X")))) == "A Y C X E"
    assert one(spark, extraction.substituted(F.lit("as it is"), F.array(change(0, 2, "as", None)))) == "as it is"


def test_replies_that_are_fenced_or_break_off(spark):
    assert json.loads(extraction.recovered('{"entities": [{"a": 1}, {"b": "x, y"}, {"c": ')) == {"entities": [{"a": 1}, {"b": "x, y"}]}
    assert json.loads(extraction.recovered('{"summary": "all", "topic": "lo')) == {"summary": "all"}
    assert json.loads(extraction.recovered('{"a": [1, 2,], }')) == {"a": [1, 2]}
    assert extraction.recovered("no json") is None and extraction.recovered(None) is None and extraction.recovered("") is None
    triplet = '{"subject": " s ", "predicate": "p", "object": "o", "importance": "Core", "confidence": "7"}'
    data = [(1, f'```json\n{{"triplets": [{triplet}]}}\n```'), (2, f'So: {{"triplets": [{triplet}, {{"subject": "cut'), (3, "nothing"), (4, None), (5, ""), (6, '{"triplets": [{"subject": "s", "predicate": " ", "object": "o"}], "entities": [{"mention_text": "m"}, {"canonical_name": " "}]}')]
    parsed = extraction.parsed_replies(spark.createDataFrame(data, "id int, reply string"), ["id"], "reply")
    assert rows(extraction.triplets_of(parsed, ["id"]), "id", "subject", "importance", "confidence") == [(1, "s", 1.0, 1.0), (2, "s", 1.0, 1.0)]
    assert rows(extraction.entities_of(parsed, ["id"]), "id", "mention", "name", "importance") == [(6, "m", "m", 0.5)]
    assert dict(rows(parsed, "id", "truncated")) == {1: False, 2: True, 3: True, 4: False, 5: False, 6: False}


def test_terms(spark):
    term = lambda x, lang="en", **how: one(spark, extraction.normalized(F.lit(x), lang, **how))
    assert [term(x) for x in (" The Red  Fox ", "NASA", "ABCDEFG", "", "some")] == ["red fox", "NASA", "abcdefg", "", ""]
    assert term("Данные леса", "ru", lemma=lambda w: F.when(w == "данные", "данный").otherwise(w)) == "леса"
    assert one(spark, extraction.chunk_label(F.lit("The cat of an owner"))) == "cat of owner"


def test_greedy_pass_equals_the_plain_one(spark):
    lot = random.Random(3)
    data = []
    for g in (1, 2):
        for k in range(40):
            base = lot.randrange(6)
            v = [1.0 if i == base else 0.0 for i in range(6)]
            v[(base + 1) % 6] = lot.choice([0.0, 0.2, 0.45])
            data.append((g, g * 100 + k, v, "r" * lot.randint(1, 4)))
    df = spark.createDataFrame(data, "g int, k bigint, v array<double>, rel string")
    want = set()
    for g in (1, 2):
        part = [(k, [x / sum(y * y for y in v) ** 0.5 for x in v], r) for h, k, v, r in data if h == g]
        kept = extraction.greedy_kept([(v, r) for _, v, r in part], 0.92)
        want |= {(g, k) for (k, _, _), ok in zip(part, kept, strict=True) if ok}
    assert {tuple(r) for r in extraction.greedy_dedup(df, ["g"], "k", "v", "rel").collect()} == want


def test_cluster_heads(spark):
    df = spark.createDataFrame([(1, 0, 5, "Alice"), (1, 25, 28, "She"), (1, 40, 43, "her"), (2, 7, 9, "it")], "c int, start int, stop int, text string")
    assert rows(extraction.cluster_heads(df, ["c"], "start", "stop", "text"), "start", "original", "replacement") == [(25, "She", "Alice"), (40, "her", "Alice")]


def test_windows_around_terms(spark):
    text = F.lit("Cat and cat sit. " + "x" * 50 + " CAT end")
    assert one(spark, extraction.occurrences(text, F.lit("cat"), 8)) == [0, 8, 68]
    assert one(spark, extraction.windows_around(text, F.lit("cat"), 2, 2)) == ["Cat a", "d cat s"]
    assert one(spark, extraction.occurrences(text, F.lit("(.*"), 8)) == [] and one(spark, extraction.windows_around(text, F.lit(""), 2, 2)) == []
    both = one(spark, extraction.pair_windows(text, F.lit("cat"), F.lit("end"), apart=10, reach=1))
    assert both == [" CAT end"]
    assert one(spark, extraction.pair_windows(text, F.lit("sit"), F.lit("end"), apart=10, reach=1)) == [" sit.", " end"]


def test_relations_of_tokens():
    t = lambda text, pos, dep, head: {"text": text, "lemma": text.lower().rstrip("s"), "pos": pos, "dep": dep, "head": head}
    tokens = [t("Cats", "NOUN", "nsubj", 3), t("and", "CCONJ", "cc", 0), t("dogs", "NOUN", "conj", 0), t("eat", "VERB", "ROOT", 3), t("fish", "NOUN", "dobj", 3), t("from", "ADP", "prep", 4), t("rivers", "NOUN", "pobj", 5)]
    assert set(extraction.relations_of_tokens(tokens)) == {("cat", "and", "dog"), ("cat", "eat", "fish"), ("dog", "eat", "fish"), ("fish", "from", "river")}


def test_context_windows_and_leaves(spark):
    s = spark.createDataFrame([(1, k, f"s{k}") for k in range(7)], "g int, id int, text string")
    assert rows(extraction.context_windows(s, ["g"], "id", "text"), "window", "context", "text") == [(0, "", "s0 s1 s2 s3 s4"), (1, "s2 s3 s4", "s5 s6")]
    r = spark.createDataFrame([(1, "no json", "x" * 300), (2, '{"summary": " ", "key_concepts": [{"name": "a", "importance": "CORE"}, {"name": " "}]}', "short")], "id int, reply string, text string")
    assert rows(extraction.leaves(r, ["id"], "reply", "text"), "id", "summary", "concepts") == [(1, "x" * 240, []), (2, "short", [("a", "core")])]


def graph(spark, pairs, nodes):
    e = spark.createDataFrame([(g, a, b) for g, a, b in pairs], "g int, a int, b int")
    n = spark.createDataFrame(nodes, "g int, node int")
    return n, e, "g", "a", "b", "node"


def test_paths_shares_and_histograms(spark):
    nodes = [(1, k) for k in (1, 2, 3)] + [(2, k) for k in (11, 12, 13)] + [(3, 1000 + k) for k in range(501)] + [(4, 21)]
    pairs = [(1, 1, 2), (1, 2, 3), (1, 1, 3), (2, 11, 12)] + [(3, 1000 + k, 1001 + k) for k in range(500)]
    given = graph(spark, pairs, nodes)
    assert rows(graphs.path_lengths(*given)) == [(1, 1, 1.0), (2, None, None), (3, None, None), (4, None, None)]
    assert rows(graphs.component_shares(*given), "g", "components", "largest") == [(1, 1, 1.0), (2, 2, 0.666667), (3, 1, 1.0), (4, 1, 1.0)]
    assert rows(graphs.degree_histogram(*given).where("g < 3")) == [(1, 2, 3), (2, 0, 1), (2, 1, 2)]
    assert rows(graphs.mean_clustering(*given).where("g < 3")) == [(1, 1.0), (2, 0.0)]
    path = graph(spark, [(1, k, k + 1) for k in range(4)], [(1, k) for k in range(5)])
    assert rows(graphs.path_lengths(*path)) == [(1, 4, 2.0)]


def test_components_of_a_long_chain(spark):
    e = spark.range(3000).select((F.col("id") * 7 % 3001).alias("a"), ((F.col("id") * 7 + 7) % 3001).alias("b"))
    got = graphs.components(e, "a", "b")
    assert got.select("component").distinct().count() == 1 and got.count() == 3001


def test_weighted_assembly(spark):
    entities = spark.createDataFrame([(1, 1, "cat", 0.2), (1, 2, " ", 1.0)], "g int, k bigint, name string, importance double")
    triplets = spark.createDataFrame([(1, 1, "dog", "eats", "fish", 0.9), (1, 2, "cat", "sees", " ", 0.5), (1, 3, "owl", " ", "cat", 1.0), (1, 4, "dog", "eats", "fish", 0.1)], "g int, k bigint, subject string, predicate string, object string, importance double")
    nodes, edges = graphs.assemble_weighted(entities, triplets, "g", "k")
    assert rows(nodes, "node", "label", "importance", "mentions") == [(0, "cat", 0.5, 2), (1, "dog", 0.9, 2), (2, "fish", 0.9, 2)]
    assert rows(edges, "source", "target", "relation", "weight", "importance") == [(1, 2, "eats", 2, 0.9)]


def test_states_move_only_as_they_may(spark):
    files = spark.createDataFrame([(1, 0), (2, 5), (3, 20), (4, 5)], "id int, status int")
    told = spark.createDataFrame([(1, 0, 20), (2, 5, 10), (3, 5, 10), (4, 5, 99), (4, 5, 10)], "id int, expected int, target int")
    assert rows(lifecycle.stepped(files, told, "id", "status", lifecycle.FILE_STEPS), "id", "status") == [(1, 0), (2, 10), (3, 20), (4, 10)]
    q = lifecycle.query_states(spark.createDataFrame([(1,), (2,), (3,)], "q int"), spark.createDataFrame([(1, 0), (1, 20), (2, 20)], "q int, status int"), "q", "status")
    assert rows(q, "q", "state") == [(1, 20), (2, 30), (3, 30)]
    urls = spark.createDataFrame([(k, s) for k, s in enumerate("aaabbc")], "id int, source string")
    got = lifecycle.slot_claim(urls, "source", ["id"], ["a", "a", "b", "c"], 1, 5).orderBy("round", "slot")
    assert [r["id"] for r in lifecycle.slot_claim(urls, "source", ["id"], ["a", "a", "b", "c"], 1, 5).collect()] and sorted(r["id"] for r in got.collect()) == [0, 1, 3, 4, 5]
    states = spark.createDataFrame([(1, 0, [0], [True, True], None), (2, 0, [], [True], 2000), (3, 1, [], [True, True], None)], "k int, criterion_index int, done array<int>, repeats array<boolean>, resume_at int")
    fetched = spark.createDataFrame([(1, True, True), (2, True, True), (3, False, True)], "k int, ok boolean, has_more boolean")
    assert rows(lifecycle.crawl_step(states, fetched, "k", F.lit(1000)), "k", "criterion_index", "step") == [(1, 1, "ready"), (2, 0, "paused"), (3, 1, "kept")]


def test_pages(spark):
    state = lambda data, n=1, chars=50: one(spark, pages.file_state(F.lit(data), F.lit(n), F.lit(chars)))
    assert [state(b"\0\0%PDF-1.4 x %%EOF"), state(b"%PDF x"), state(b"x %%EOF"), state(b"%PDF %%EOF", 0), state(b"%PDF %%EOF", 1, 40), state(b"%PDF" + b"x" * 3000 + b"%%EOF" + b" " * 3000)] == ["ok_clean", "ok_no_eof", "fail", "fail", "ok_no_text", "ok_no_eof"]
    line = lambda x: one(spark, pages.proxy_line(F.lit(x)))
    assert line("1.2.3.4:80") == ("1.2.3.4", 80, "http") and line("bad") is None and line('{"ip": "a", "port": 1, "protocols": []}') == ("a", 1, "http") and line('{"ip": "a"}') is None
    html = spark.createDataFrame([(1, '<a href="x.pdf">1</a><a href="y">2</a><a href="x.pdf">3</a>')], "id int, body string")
    assert rows(pages.page_links(html, "id", "body"), "pos", "link") == [(0, "x.pdf"), (1, "y")]


@pytest.mark.parametrize(("minutes", "kind"), [(9, "unexplained"), (10, "benign_backoff"), (20, "benign_backoff"), (21, "unexplained"), (74, "unexplained"), (75, "stall")])
def test_empty_buckets(spark, minutes, kind):
    buckets = spark.createDataFrame([("2024-01-01 10:00:00", 0), ("2024-01-01 10:15:00", 3)], "bucket string, n int").withColumn("bucket", F.col("bucket").cast("timestamp"))
    runs = spark.createDataFrame([("2024-01-01 10:05:00",)], "start string").select(F.col("start").cast("timestamp").alias("start"), (F.col("start").cast("timestamp") + F.expr(f"interval {minutes} minutes")).alias("end"), F.lit(float(minutes)).alias("minutes"))
    assert [r["kind"] for r in reports.zero_buckets(buckets, runs, 15).collect()] == [kind]


def test_alerts(spark):
    facts = spark.createDataFrame([(0, 2)], "stalls int, failed int")
    rules = [("bad", "stall", F.col("stalls") > 0), ("warn", "failed", F.col("failed") > 0)]
    assert rows(reports.alerts(facts, rules)) == [("warn", "failed")]
    assert rows(reports.alerts(facts.withColumn("failed", F.lit(0)), rules)) == [("good", "none")]


def test_late_rows_of_a_stream_are_dropped(spark, tmp_path):
    def event(name, *times):
        spark.createDataFrame([(t, "a", 1.0) for t in times], "ts string, event_type string, value double").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value").coalesce(1).write.parquet(str(tmp_path / name))

    event("1", "2024-01-01 10:10:00", "2024-01-01 12:00:00")
    event("2", "2024-01-01 14:00:00")
    event("3", "2024-01-01 10:20:00", "2024-01-01 13:59:00")
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path))
    got = rows(windows.run_to_end(windows.windowed_counts(stream, "ts", "event_type", 60, 30), spark), F.from_unixtime("window_start").alias("w"), "n")
    assert got == [("2024-01-01 10:00:00", 1), ("2024-01-01 12:00:00", 1)]


def test_alignment_against_brute_force(spark):
    lot = random.Random(7)
    data = [(k, k % 3, [lot.gauss(0, 1) for _ in range(8)]) for k in range(60)]
    data[20] = (20, 2, data[5][2])
    df = spark.createDataFrame(data, "id bigint, label int, v array<float>")
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5), 6)
    exact = {r["id"]: list(r["v"]) for r in df.collect()}
    want = set()
    for q in range(0, 60, 7):
        for label in range(3):
            best = max((cos(exact[q], exact[k]), -k) for k in range(60) if k % 3 == label and k != q)
            want.add((q, label, -best[1]))
    got = embeddings.nearest_by_label(df.where("id % 7 = 0"), df, "id", "label", "v", block=3)
    assert {(r["query"], r["label"], r["nearest"]) for r in got.collect()} == want


def test_pipe_lines(spark):
    got = [one(spark, fn.pipe_triplet(F.lit(x))) for x in ("- a | b | c | d", "1. 'x' | y | \"z\"", "a | b", "a | | c", "")]
    assert got == [("a", "b", "c | d"), ("x", "y", "z"), None, None, None]
