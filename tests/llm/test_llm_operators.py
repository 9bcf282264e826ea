"""Each operator against brute force, an exact round trip or planted cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import garbled_text, languages, mixing, scanned_text, sentences, spam_pages, spelling_groups, tokenize, url_index, vector_graph


def test_tokens_equal_the_library_and_round_trip(spark, data):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(tokenize.VOCAB)
    lib.encode_special_tokens = True
    machine = tokenize.automaton()
    extra = ["aaaaaaaaaaaaaaa", " <|endoftext|> don't", "\n\n  \t x", "é" * 300, "𝔘nicode 👩🏽‍🔬", " " * 70]
    texts = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").where("text is not null").collect()] + extra
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [machine.encode(t) for t in texts] == want
    assert all(machine.decode(machine.encode(t)) == t for t in texts)
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["ids"] for r in tokenize.encode_corpus(rows).collect()} == {1: [], 2: [], 3: lib.encode("a b").ids}
    long = "слово word " * 40_000
    coded = tokenize.encode_corpus(spark.createDataFrame([(1, long)], "doc_id bigint, text string"))
    assert tokenize.decode_corpus(coded).first()["text"] == long


def test_spelling_groups_equal_brute_force(spark, data):
    nodes = spark.read.parquet(f"{data}/raw_node.parquet")
    triplets = spark.read.parquet(f"{data}/raw_triplet.parquet")
    first, want = {}, set()
    for r in sorted(nodes.collect(), key=lambda r: r["node_id"]):
        key = (r["graph_id"], spelling_groups.canonical(r["label"]))
        if key[1] and first.setdefault(key, r["node_id"]) != r["node_id"]:
            want.add(("node", first[key], r["node_id"]))
    for r in sorted(triplets.collect(), key=lambda r: r["triplet_id"]):
        ends = sorted(spelling_groups.canonical(r[c]) or "" for c in ("subject", "object"))
        key = (r["graph_id"], r["relation"], *ends)
        if all(ends) and first.setdefault(key, r["triplet_id"]) != r["triplet_id"]:
            want.add(("triplet", first[key], r["triplet_id"]))
    assert {tuple(r) for r in spelling_groups.found(nodes, triplets).collect()} == want
    same = spelling_groups.canonical
    assert same("B; a­a") == same("AA / b") and same("é") == same("é") != same("e") and same(" .,") is None


def test_hot_label_is_one_group(spark):
    nodes = spark.range(3000).select(F.col("id").alias("node_id"), F.lit(1).cast("bigint").alias("graph_id"), F.when(F.col("id") % 3 == 0, "Hot label").otherwise(F.concat(F.lit("l"), F.col("id"))).alias("label"))
    got = spelling_groups.later_copies(spelling_groups.encoded_nodes(nodes), ["graph_id", "code"], "rec_id")
    assert got.count() == 999 and got.select("first_id").distinct().count() == 1


URLS = [
    (1, "https://preprints.example/pdf/2101.00000001v2"), (2, " HTTP://WWW.preprints.example:80//pdf/2101.00000001.pdf#arxiv"), (3, "https://preprints.example/pdf/2101.000000011"),
    (4, "https://reader.example/doi/pdf/10.99999/Kel.1"), (5, "<https://reader.example/fetch?download=1&amp;doi=10.99999%2FKEL.1>,"), (6, "https://reader.example/doi/pdf/10.99999/kel.1.s1"),
    (7, "https://journals-ru.example/article/n/metod-prava-i-tekst-20/pdf"), (8, "https://journals-ru.example/article/n/metod-prva-i-teksst-20.pdf"), (9, "https://journals-ru.example/article/n/metod-prava-i-tekst-20-1/pdf"),
    (10, "https://a.example/bitstream/1/2/3/04_title.pdf"), (11, "https://a.example/bitstream/1/2/3/24_title.pdf"), (12, None), (13, "about:blank"), (14, "NA"), (15, "")]


def found_urls(rows, **how):
    return {tuple(r) for r in url_index.found(rows, **how).collect()}


def test_urls_in_one_batch_and_in_several(spark):
    rows = spark.createDataFrame([(i, u, i) for i, u in URLS], "id bigint, pdf_url string, batch_no bigint")
    want = {(1, 2), (4, 5), (7, 8)}
    assert found_urls(rows) == want
    assert found_urls(rows, deliveries=1) == found_urls(rows, deliveries=4) == want
    index = url_index.UrlIndex(spark)
    assert {tuple(r) for r in index.accept(rows.where("id <= 4")).collect()} == {(1, 2)}
    assert {tuple(r) for r in index.accept(rows.where("id > 4").unionByName(rows.where("id > 4"))).collect()} == {(4, 5), (7, 8)}


def test_items_in_path_and_query():
    item = url_index.item_of
    assert item("https://a.example/pdf/2101.00001v3") == item("https://a.example/get?id=2101.00001&utm_source=x") == item("http://a.example:80/get?id=2101.00001.pdf")
    assert item("https://a.example/get?id=2101.00002") != item("https://a.example/pdf/2101.00001")
    assert item("https://a.example/fetch?handle=bitstream/1/2/3/04_title.pdf") == item("https://a.example/bitstream/1/2/04_title.pdf")
    assert item("https://a.example/get?ref=2101.00001") is None


def test_links_are_closed_whatever_the_batches(spark):
    # each title is within reach of its neighbours only; the one that links all comes last
    base = "metod prava i tekst zakona"
    chain = ["metod prava i tekst zakona", "xxetod prava i tekst zakona zz", "xxetod prava y tekst zakkona zzqq", "other words of a text"]
    titles = [chain[0], chain[2], chain[3], chain[1], base]
    rows = spark.createDataFrame([(k + 1, f"https://j.example/article/n/{t.replace(' ', '-')}", k) for k, t in enumerate(titles)], "id bigint, pdf_url string, batch_no bigint")
    want = {(1, 2), (1, 4), (1, 5)}
    assert found_urls(rows) == found_urls(rows, deliveries=1) == found_urls(rows, deliveries=2) == want
    index = url_index.UrlIndex(spark)
    got = [{tuple(r) for r in index.accept(rows.where(F.col("batch_no") == k)).collect()} for k in range(5)]
    assert got == [set(), set(), set(), {(1, 4), (1, 2)}, {(1, 5)}]


def test_cells_hold_every_match(spark):
    lot = random.Random(4)
    words = ["".join(lot.choice("abcdeprstuvw") for _ in range(lot.randint(3, 9))) for _ in range(12)]
    titles = set()
    for _ in range(60):
        t = "".join(lot.choice(words) for _ in range(3))
        titles.add(t)
        for _ in range(lot.randint(0, 3)):
            k = lot.randrange(len(t))
            t = lot.choice([t[:k] + t[k + 1 :], t[:k] + lot.choice("xyz") + t[k:], t[:k] + lot.choice("xyz") + t[k + 1 :]])
            titles.add(t)
    titles = sorted(titles)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            last, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
        return row[-1]

    near = {(i, j) for i, a in enumerate(titles) for j, b in enumerate(titles) if i != j and distance(a, b) <= min(url_index.SLIPS, min(len(a), len(b)) // 4)}
    rows = spark.createDataFrame([(k, f"https://j.example/n/{t}", 0) for k, t in enumerate(titles)], "id bigint, pdf_url string, batch_no bigint")
    texts = url_index.texts_of(url_index.items(rows))
    held = url_index.in_cells(texts, 0).select("cell", "exact", "title", "vec", F.col("id").alias("other"), F.lit(False).alias("old"))
    met = url_index.matching(url_index.in_cells(texts, url_index.SLIPS), held)
    assert {(r["id"], r["other"]) for r in met.collect() if r["id"] != r["other"]} == near and near


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 96))
    v = (np.repeat(base, 20, axis=0) + 0.4 * rng.normal(size=(1200, 96))).astype(np.float32)
    v[100:130] = v[100]
    rows = [(i, v[i].tolist()) for i in range(1200)] + [(2000, None), (2001, []), (2002, [0.0] * 96), (2003, [1.0] * 48), (2004, [float("nan")] * 96)]
    df = spark.createDataFrame(rows, "id bigint, vec array<float>").select(F.lit("x").alias("src"), "id", "vec").where(vector_graph.usable("vec"))
    got = {(r["id"], r["near_id"]) for r in vector_graph.similar_vectors(df).collect()}
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -9)
    want = {(i, int(j)) for i in range(1200) for j in np.argsort(-s[i], kind="stable")[:5] if s[i, j] >= 0.7}
    assert len(got & want) >= 0.98 * len(want) and len(got & want) >= 0.98 * len(got)
    assert {j for i, j in got if i == 115} == {100, 101, 102, 103, 104}


def test_garbled_words_are_found_and_restored(spark, data):
    text = "Формальный закон описывает редкий прибор"
    clean = [(k, "text", f"{text} {k}") for k in range(5)] + [(10, "text", "naïve “café” – 5"), (11, "text", "ok")]
    bad = [(20, text.encode().decode("cp1251", "replace")), (21, text.encode("cp1251").decode("latin-1")), (22, "na" + "ï".encode().decode("cp1252") + "ve"), (23, text.encode("koi8-r").decode("cp1251"))]
    good = [(30, text), (31, "São SÃO Ђурађ § ©"), (32, ""), (33, None), (34, "Why?? plain")]
    chunk = spark.createDataFrame([(k, o, t) for k, o, t in clean] + [(k, "legacy", t) for k, t in bad + good], "chunk_id bigint, origin string, text string")
    empty = spark.createDataFrame([], "sentence_id bigint, origin string, text string")
    assert sorted(r["rec_id"] for r in garbled_text.found(chunk, empty).collect()) == [20, 21, 22, 23]
    fixed = {r["rec_id"]: r["text"] for r in garbled_text.restored(chunk, empty).collect()}
    assert fixed[21] == text and fixed[23] == text and fixed[22] == "naïve"


TOTALS = [(side, script, 60, 40) for side in ("close", "open") for script in ("latn", "cyrl", "hani", "thai", "deva", "gujr")]


def test_sentences_of_plain_cases():
    model = sentences.Model([*TOTALS, ("close", "latn", 41, 111)], [("close", "latn", "Dr", 0, 50), ("close", "latn", "now", 40, 60), ("close", "latn", "<none>", 1, 1)])
    parts = lambda t: [t[a:b] for a, b in sentences.split_text(t, model)]
    assert parts("Title\n\nDr. May left now. “It broke. Nobody knew,” he said.") == ["Title", "Dr. May left now.", "“It broke. Nobody knew,” he said."]
    assert parts("价格下降了。“为什么？”他问道。") == ["价格下降了。", "“为什么？”他问道。"]
    assert parts("") == parts("  \n\n ") == sentences.split_text(None, model) == []
    assert parts("— Закон? Да никогда! — сказал он. Новый день.") == ["— Закон? Да никогда! — сказал он.", "Новый день."]
    long = "Now it works now. " * 3000
    assert len(parts(long)) == 3000
    for n in (100, 300, 3000):  # one quotation, however many boundaries it holds
        quoted = "He said: “" + "It works now. " * n + "It is fine,” she told us."
        assert parts(f"{quoted} A new day now.") == [quoted, "A new day now."]


def test_search_equals_all_pairs():
    lot = random.Random(1)
    for _ in range(150):
        k = lot.randint(2, 50)
        at = sorted(lot.sample(range(1, k * lot.choice([4, 20, 200])), k))
        starts, ends = [0, *(p + 1 for p in at[:-1]), at[-1]], [0, *at]
        gain = [0.0, *(lot.uniform(-8, 3) for _ in range(k - 1)), 0.0]
        said = [(lot.choice([0.0, -3.0]), s + lot.randint(1, 400), lot.choice([0.0, -4.0])) for s in starts]
        span = lambda i, j: -(ends[j] - starts[i] < 10) - 0.002 * max(0, ends[j] - starts[i] - 300) + said[i][2 if ends[j] >= said[i][1] else 0] + gain[j]  # noqa: B023, E731
        best = [0.0]
        for j in range(1, len(ends)):
            best.append(max(best[i] + span(i, j) for i in range(j)))
        came, j, total = sentences.best_parting(starts, ends, gain, 10, said), len(ends) - 1, 0.0
        while j:
            total, j = total + span(came[j], j), came[j]
        assert abs(total - best[-1]) < 1e-6


def test_joined_counts_give_the_same_spans(spark, data):
    rows = sentences.corpus(spark.read.parquet(f"{data}/chunk.parquet"), spark.read.parquet(f"{data}/sentence.parquet"))
    counts = sentences.fit(rows.select("text"))
    spans = lambda **how: {tuple(r) for r in sentences.spans_of(rows, counts, ["src", "rec_id"], **how).collect()}
    assert spans() == spans(model_rows=0)


def test_sentences_split_joined_rows(spark, data):
    rows = sentences.corpus(spark.read.parquet(f"{data}/chunk.parquet"), spark.read.parquet(f"{data}/sentence.parquet"))
    counts = sentences.fit(rows.select("text")).collect()
    totals = {}
    for side, script, _, yes, no in counts:
        a, b = totals.get((side, script), (0, 0))
        totals[side, script] = (a + yes, b + no)
    model = sentences.Model([(*k, *v) for k, v in totals.items()], [tuple(r) for r in counts])
    singles = [r["text"].strip() for r in rows.where("src = 'sentence'").collect() if r["text"].strip() and len(sentences.split_text(r["text"], model)) == 1 and r["text"].strip()[-1] in ".!?"]
    lot = random.Random(5)
    right = total = 0
    for _ in range(100):
        pair = lot.sample(singles, 2)
        total += 1
        right += [" ".join(pair)[a:b] for a, b in sentences.split_text(" ".join(pair), model)] == pair
    assert right >= 0.9 * total


def test_language_codes_and_accuracy(spark, data):
    df = spark.createDataFrame([("EN-us",), ("ger",), ("zho",), ("und",), ("",), (None,), (" RU ",)], "x string")
    assert [r[0] for r in df.select(languages.label_language(F.col("x"))).collect()] == ["en", "de", "zh", None, None, None, "ru"]
    got = languages.sentence_languages(spark.read.parquet("/root/testdata/sf0.01/chunk.parquet"), spark.read.parquet("/root/testdata/sf0.01/raw_graph.parquet"))
    text = spark.read.parquet("/root/testdata/sf0.01/chunk.parquet").select("chunk_id", "text")
    both = got.join(text, "chunk_id").select("lang", F.expr("substring(text, start_pos + 1, end_pos - start_pos)").alias("s")).collect()
    telltale = [(r["lang"], "uk" if any(c in r["s"] for c in "іїєґ") else "ru") for r in both if any(c in r["s"] for c in "іїєґыэъё") and r["lang"] in ("ru", "uk")]
    assert sum(a == b for a, b in telltale) >= 0.9 * len(telltale)


def test_scanned_page(spark):
    page = "16  A Survey of Narrative Protein\nThe formal index supports the narrative\ncata1yst within the same collec-\n- 17 -\ntion of large-\nscale polymers.\n\n2. Methods\n\nThe index ends here."
    clean = ["The formal index supports the narrative catalyst within the same collection of large-scale polymers.", "The catalyst ends here."] * 3
    chunk = spark.createDataFrame([(1, 1, "scan", page), (2, 1, "scan", ""), (3, 1, "scan", None)] + [(10 + k, 2, "text", t) for k, t in enumerate(clean)], "chunk_id bigint, graph_id bigint, origin string, text string")
    graph = spark.createDataFrame([], "graph_id bigint, origin string, source_text string")
    sentence = spark.createDataFrame([], "sentence_id bigint, origin string, text string")
    assert {(r["line_no"], r["kind"]) for r in scanned_text.found(chunk, graph, sentence).collect()} == {(0, "header"), (2, "misread"), (2, "hyphen"), (3, "page")}
    text = next(r["text"] for r in scanned_text.repaired(chunk, graph, sentence).collect() if r["rec_id"] == 1)
    assert text == "The formal index supports the narrative catalyst within the same collection of large-scale polymers.\n\n2. Methods\n\nThe index ends here."


def test_mixture_keeps_shares_and_caps(spark):
    docs = spark.createDataFrame([(k, "a", "word " * 20) for k in range(200)] + [(1000 + k, "b", "word " * 20) for k in range(20)] + [(2000, "c", None), (2001, "z", "word")], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 4), ("c", 0.05, 2), ("none", 0.05, 1)], "source string, target_share double, max_repeats int")
    mix = mixing.queue(docs, targets)
    used = {r["source"]: r["tokens"] for r in mixing.report(mix, targets).collect()}
    assert abs(used["a"] / used["b"] - 2) < 0.1 and used["none"] == used["c"] == 0
    assert mix.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 4
    assert mix.select("doc_id", "copy").distinct().count() == mix.count()


def test_no_copy_of_a_mixture_is_cut_off():
    lot = random.Random(2)
    for _ in range(100):
        sources = [(lot.uniform(0.1, 1), [lot.randint(1, 50) for _ in range(lot.randint(1, 30))], lot.randint(1, 4)) for _ in range(lot.randint(1, 5))]
        whole = sum(share for share, _, _ in sources)
        copies = []
        for share, sizes, repeats in sources:
            done = 0
            for size in sizes * repeats:
                done += size
                copies.append((done * whole / share, size))
        cut = lot.randint(1, sum(size for _, size in copies) + 20)
        end = mixing.last_finish([(share / whole, sum(sizes) * repeats, max(sizes)) for share, sizes, repeats in sources], cut)
        total, kept = 0, []
        for finish, size in sorted(copies):
            total += size
            if total > cut:
                break
            kept.append(finish)
        assert all(finish <= end * (1 + 1e-9) for finish in kept)


def test_spam_lists_are_told_from_prose(spark):
    rows = []
    for k in range(20):
        rows.append((100 + k, "s", "".join("Buy term paper | SKU A%d | SALE\n" % (10000 + 31 * k + i) for i in range(20))))
        rows.append((200 + k, None, " ".join(f"http://a.example/x{k}{i}" for i in range(30))))
        rows.append((300 + k, "s", f"The model {k} was tested in the second edition. It explains most of the cases that we know of, as appendix {k} shows. " * 3))
        rows.append((400 + k, "t", "\n".join(f"{1990 + i}\t{i * 7 + k}.5\t{i * 3}.25" for i in range(30))))
    rows += [(3, "s", "short"), (5, "s", None), (6, "s", " "), (7, "s", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, site string, text string")
    assert sorted(r["doc_id"] for r in spam_pages.found(docs).collect()) == [*range(100, 120), *range(200, 220)]


def scanned(spark, pages, clean):
    chunk = spark.createDataFrame([(k, 1, "scan", t) for k, t in enumerate(pages)] + [(1000 + k, 2, "text", t) for k, t in enumerate(clean)], "chunk_id bigint, graph_id bigint, origin string, text string")
    graph = spark.createDataFrame([], "graph_id bigint, origin string, source_text string")
    sentence = spark.createDataFrame([], "sentence_id bigint, origin string, text string")
    return {r["rec_id"]: r["text"] for r in scanned_text.repaired(chunk, graph, sentence).collect()}


def test_tokens_compete_with_their_look_alikes(spark):
    plain = "a boat came over the water and the old man went to the house by the lake with his son"
    sky = "the sky was clear over the lake of the north"
    rest = [f"his {w} friend came by" for w in ("near", "bear", "deal", "dead", "tear", "year", "dean", "fear", "heap", "deep")]
    pages = ["my dear friend came by the lake", "the sky was c1ear 0f the north"] + [f"{plain} {k}" for k in range(60)]
    got = scanned(spark, pages, [plain] * 60 + [sky] * 5 + rest)
    assert got[0] == pages[0]  # a new word, well spelled, against a word of five occurrences
    assert got[1] == "the sky was clear of the north"
    pages[0] = "the sky was dear over the lake"
    pages += ["the doud over the dock", "the dimate of the north", "the dass went by the lake"] * 5
    got = scanned(spark, pages, [plain] * 60 + [sky] * 80 + rest + ["the cloud over the clock", "the climate of the north", "the class went by the lake"] * 10 + ["my dear friend came by"] * 2)
    assert got[0] == "the sky was clear over the lake"  # a word of its own, but not here


def test_many_vectors_of_one_direction_go_by_smallest_id(spark):
    rng = np.random.default_rng(3)
    line = rng.normal(size=96)
    rows = [(k, [float(x) for x in line * (1 + k * 0.37)]) for k in rng.permutation(400).tolist()] + [(1000 + k, [float(x) for x in rng.normal(size=96)]) for k in range(400)]
    df = spark.createDataFrame(rows, "id bigint, vec array<float>").select(F.lit("x").alias("src"), "id", "vec").repartition(4)
    got = {}
    for r in vector_graph.similar_vectors(df).collect():
        got.setdefault(r["id"], set()).add(r["near_id"])
    assert got == {k: set([x for x in range(6) if x != k][:5]) for k in range(400)}


def test_words_are_replaced_where_they_stand(spark):
    plain = "they are open to the march and the search of the north"
    pages = ["they arc open to the march and the search"] + [f"they are open to the march {k}" for k in range(30)] + ["doors arc open to the search", "the gates arc open to the march"] * 3
    got = scanned(spark, pages, [plain] * 80 + [f"the doors {w} open to the search" for w in ("are", "were")] * 20)
    assert got[0] == "they are open to the march and the search"
    assert scanned_text.corrected(["The Doud and the doud", "of tbe cot-", "ton, tbe"], {(0, 4): "cloud", (0, 1): "cloud", (1, 2): "button"}) == ["The Cloud and the cloud", "of tbe but-", "ton, tbe"]


def test_any_character_of_a_new_word_may_be_misread(spark):
    clean = ["the house by the lake was open to the north and the garden was near the lake"] * 60
    pages = ["the gavden was near the lake", "the houqe by the lake was open", "the garden was open to tbe north", "the lake by the garden"] * 3
    got = scanned(spark, pages, clean)
    assert got[0] == "the garden was near the lake" and got[1] == "the house by the lake was open"


def test_the_line_decides_between_look_alikes():
    # one place with two candidates of equal score: pairs with the neighbours decide, not their order
    steps = [[("the", 0.0, 9)], [("dear", -1.0, 5), ("clear", -1.0, 5)], [("sky", 0.0, 9)]]
    assert scanned_text.decode_line(steps, {("clear", "sky"): 5}, 100.0) == ["the", "clear", "sky"]
    assert scanned_text.decode_line(steps, {("dear", "sky"): 5}, 100.0) == ["the", "dear", "sky"]
    assert scanned_text.confusions("c1earn", "clearm") == ["n>m", "1>l"] and scanned_text.confusions("rnodel", "model") == ["rn>m"]


def test_vectors_in_many_blocks(spark):
    rng = np.random.default_rng(5)
    v = np.repeat(rng.normal(size=(40, 96)), 15, axis=0) + 0.3 * rng.normal(size=(600, 96))
    df = spark.createDataFrame([(i, v[i].tolist()) for i in range(600)], "id bigint, vec array<float>").select(F.lit("x").alias("src"), "id", "vec")
    pairs = lambda **how: {(r["id"], r["near_id"]) for r in vector_graph.similar_vectors(df, **how).collect()}
    one, many = pairs(), pairs(block_rows=50)
    assert one == many


def test_lossy_originals_are_not_called_whole(spark):
    text = "Формальный закон описывает редкий прибор"
    lossy = text.encode().decode("cp1252", "replace")
    rows = [(k, "text", f"{text} {k}") for k in range(5)] + [(20, "legacy", lossy), (21, "legacy", text.encode("cp1251").decode("latin-1"))]
    chunk = spark.createDataFrame(rows, "chunk_id bigint, origin string, text string")
    empty = spark.createDataFrame([], "sentence_id bigint, origin string, text string")
    got = {r["rec_id"]: r["whole"] for r in garbled_text.restored(chunk, empty).collect()}
    assert got == {20: False, 21: True}


def test_urls_in_hundreds_of_batches(spark):
    rows = spark.createDataFrame([(k, f"https://a.example/pdf/2101.{10000 + k % 1000}", k) for k in range(1200)] + [(5000, "https://a.example/pdf/2101.10007", None)], "id bigint, pdf_url string, batch_no bigint")
    assert found_urls(rows, deliveries=3) == {(k, k + 1000) for k in range(200)} | {(7, 5000)}


def test_large_batches_meet_the_same_history(spark, monkeypatch):
    rows = spark.createDataFrame([(i, u, i % 3) for i, u in URLS], "id bigint, pdf_url string, batch_no bigint")
    want = found_urls(rows)
    monkeypatch.setattr(url_index, "SENT_ROWS", 0)
    monkeypatch.setattr(url_index, "BUCKET_ROWS", 3)
    assert found_urls(rows) == want == {(1, 2), (4, 5), (7, 8)}
    monkeypatch.setattr(url_index, "SENT_TEXTS", 0)
    monkeypatch.setattr(url_index, "BATCH_MEETS", 0)
    assert found_urls(rows) == want


def test_vectors_of_many_shards_and_blocks_are_not_copied(spark):
    rng = np.random.default_rng(6)
    v = (np.repeat(rng.normal(size=(60, 96)), 20, axis=0) + 0.3 * rng.normal(size=(1200, 96))).astype(np.float32)
    df = spark.createDataFrame([(i, v[i].tolist()) for i in range(1200)], "id bigint, vec array<float>").select(F.lit("x").alias("src"), "id", "vec")

    def written():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(k).length() for k in range(files.size()))

    before = written()
    got = {(r["id"], r["near_id"]) for r in vector_graph.similar_vectors(df, shard_rows=100, block_rows=20).collect()}
    assert written() - before < 10 * v.nbytes
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -9)
    want = {(i, int(j)) for i in range(1200) for j in np.argsort(-s[i], kind="stable")[:5] if s[i, j] >= 0.7}
    assert len(got & want) >= 0.98 * len(want) and len(got & want) >= 0.98 * len(got)
