"""States of files, jobs, custom queries, proxies and crawls as snapshots: each step takes a table and gives the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The states of files and of jobs, and where each may go.
FILE_STEPS = ((0, 5), (5, 10), (10, 15), (15, 20), (5, 99), (15, 99))
JOB_STEPS = ((0, 5), (5, 10), (10, 20), (20, 30), (5, 99), (20, 99))


def stepped(rows: DataFrame, events: DataFrame, key: str, status: str, allowed: tuple[tuple[int, int], ...]) -> DataFrame:
    """Rows after one event (key, expected, target) each: a row moves only from the expected status and along an allowed step; of several events the smallest target counts."""
    one = events.groupBy(key, "expected").agg(F.min("target").alias("target")).withColumnRenamed("expected", status)
    steps = F.lit(False)
    for a, b in allowed:
        steps = steps | ((F.col(status) == a) & (F.col("target") == b))
    joined = rows.join(one, [key, status], "left")
    moved = F.col("target").isNotNull() & steps
    return joined.select(*(c for c in rows.columns if c != status), F.when(moved, F.col("target")).otherwise(F.col(status)).alias(status), moved.alias("moved"))


def pick_and_lock(rows: DataFrame, key: str, group: str, status: str, free: int, locked: int) -> DataFrame:
    """Rows after the first free one of each group is locked."""
    first = rows.where(F.col(status) == free).groupBy(group).agg(F.min(key).alias("_first"))
    joined = rows.join(first, group, "left")
    taken = F.coalesce(F.col(key) == F.col("_first"), F.lit(False)) & (F.col(status) == free)
    return joined.select(*(c for c in rows.columns if c != status), F.when(taken, F.lit(locked)).otherwise(F.col(status)).alias(status))


def gated(files: DataFrame, jobs: DataFrame, job: str, status: str, open_states: list[int]) -> DataFrame:
    """Files whose job is in an open state."""
    return files.join(jobs.where(F.col(status).isin(open_states)).select(job).distinct(), job, "left_semi")


def query_states(queries: DataFrame, files: DataFrame, query: str, status: str) -> DataFrame:
    """(query, files, open, state): complete (30) when no file is open (0), vacuously so without files; else under way (20)."""
    counts = files.groupBy(query).agg(F.count("*").alias("files"), F.count_if(F.col(status) == 0).alias("open"))
    joined = queries.join(counts, query, "left").fillna(0, ["files", "open"])
    return joined.select(query, "files", "open", F.when(F.col("open") == 0, 30).otherwise(20).alias("state"))


def created(queries: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Queries after new ones come in with status 0; known keys stay as they are."""
    new = fresh.join(queries.select(key), key, "left_anti").dropDuplicates([key]).withColumn("status", F.lit(0))
    return queries.unionByName(new, allowMissingColumns=True)


def looked_up(rows: DataFrame, ids: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, columns) of the rows asked for."""
    return rows.select(key, *columns).join(ids.select(key).distinct(), key, "left_semi")


def located(rows: DataFrame, saved: DataFrame, key: str, location: str) -> DataFrame:
    """Rows with the locations of `saved` (key, new_location) put in; a null one marks the file as not available (`NA`)."""
    one = saved.groupBy(key).agg(F.max("new_location").alias("_at")).withColumn("_hit", F.lit(True))
    joined = rows.join(one, key, "left")
    return joined.select(*(c for c in rows.columns if c != location), F.when(F.col("_hit"), F.coalesce("_at", F.lit("NA"))).otherwise(F.col(location)).alias(location))


def counted_successes(rows: DataFrame, events: DataFrame, key: str, counter: str) -> DataFrame:
    """Rows whose counter grows by their events."""
    plus = events.groupBy(key).agg(F.count("*").alias("_plus"))
    joined = rows.join(plus, key, "left")
    return joined.select(*(c for c in rows.columns if c != counter), (F.col(counter) + F.coalesce("_plus", F.lit(0))).alias(counter))


def deleted(rows: DataFrame, relations: DataFrame, broken: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows and relations without the broken keys."""
    keys = broken.select(key).distinct()
    return rows.join(keys, key, "left_anti"), relations.join(keys, key, "left_anti")


def claimed(rows: DataFrame, key: str, order: list[Column], n: int, claimed_at: str, now: Column, minutes: int = 5) -> DataFrame:
    """Rows after the first n that nobody holds, or whose claim is too old, are claimed now."""
    free = F.col(claimed_at).isNull() | (F.col(claimed_at) <= now - F.expr(f"INTERVAL {minutes} MINUTES"))
    taken = rows.where(free).orderBy(*order).limit(n).select(key).withColumn("_taken", F.lit(True))
    joined = rows.join(taken, key, "left")
    return joined.select(*(c for c in rows.columns if c != claimed_at), F.when(F.col("_taken"), now).otherwise(F.col(claimed_at)).alias(claimed_at), F.coalesce("_taken", F.lit(False)).alias("taken"))


def slot_claim(rows: DataFrame, source: str, order: list[str], slots: list[str], last: int, n: int) -> DataFrame:
    """(…, round, slot): the n rows that claims one after the other take, going round the slots from the one after `last`; a source may hold several slots.

    The k-th row of a source goes to its k-th slot from there on. The largest
    (round, slot) of the result is the next `last`.
    """
    turn = [slots[(last + 1 + i) % len(slots)] for i in range(len(slots))]
    places = F.create_map(*[x for s in sorted(set(slots)) for x in (F.lit(s), F.array(*[F.lit(i) for i, t in enumerate(turn) if t == s]))])
    top = Window.partitionBy(source).orderBy(*order)
    ranked = rows.where(F.col(source).isin(sorted(set(slots)))).withColumn("_k", F.row_number().over(top)).where(F.col("_k") <= n)
    own = places[F.col(source)]
    ranked = ranked.withColumn("round", F.floor((F.col("_k") - 1) / F.size(own))).withColumn("_at", F.get(own, F.pmod(F.col("_k") - 1, F.size(own)).cast("int")))
    first = ranked.orderBy("round", "_at").limit(n)
    return first.withColumn("slot", F.pmod(F.col("_at") + last + 1, F.lit(len(slots)))).drop("_k", "_at")


def next_page(page: Column, letter: Column, most: int) -> Column:
    """(letter, page) of a site crawl by letters: after the last page the next letter begins; null after z."""
    over = page >= most
    following = F.chr(F.ascii(letter) + 1)
    return F.when(~over, F.struct(letter.alias("letter"), (page + 1).alias("page"))).when(letter < "z", F.struct(following.alias("letter"), F.lit(1).cast("int").alias("page")))


def next_rubric(rubric: Column, page: Column, n_links: Column, rubrics: int) -> Column:
    """(rubric, page) of a crawl by rubrics: a page without links ends its rubric; null after the last."""
    return F.when(n_links > 0, F.struct(rubric.alias("rubric"), (page + 1).alias("page"))).when(rubric + 1 < rubrics, F.struct((rubric + 1).alias("rubric"), F.lit(1).cast("int").alias("page")))


def crawl_step(states: DataFrame, fetched: DataFrame, key: str, now: Column) -> DataFrame:
    """States with what a search run has to do next: `paused` ones wait, a fetch that failed or is missing leaves its state as it is, others are `ready` to advance.

    fetched (key, ok, has_more): what the adapter gave for each state. A state whose criterion is done already is recovered to the next open one.
    """
    from textloom.operators.crawl import next_criterion, paused

    joined = states.join(fetched.groupBy(key).agg(F.bool_and("ok").alias("ok"), F.bool_or("has_more").alias("has_more")), key, "left")
    recovered = F.when(F.array_contains("done", F.col("criterion_index")), next_criterion(F.col("criterion_index"), F.size("repeats"), F.col("done"))).otherwise(F.col("criterion_index"))
    step = F.when(paused(F.col("resume_at"), now), "paused").when(~F.coalesce("ok", F.lit(False)), "kept").otherwise("ready")
    return joined.select(*(c for c in states.columns if c != "criterion_index"), recovered.alias("criterion_index"), F.coalesce("has_more", F.lit(False)).alias("has_more"), step.alias("step"))
