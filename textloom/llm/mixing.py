"""Sources mixed to target weights by weighted fair queueing.

Every copy of a document gets a virtual finish time: the tokens of its source
up to and with it, in shuffled order, divided by the source's weight. All
copies are range-sorted by that time and the sequence is cut at the budget.
Copies of one pass over a source come before the next pass, and no document is
used more often than max_repeats allows.

Running sums are taken in two levels (buckets of the shuffle or time range,
then within a bucket), so a source that holds a third of the rows is never
sorted in one task. Only one row a source comes to the driver.

Defined results: sources without documents and documents without a target
source take no part (the shares of the others are scaled up to 1); empty and
null texts have no tokens and are not used; ties go to the smaller id; without
a budget the largest one is taken at which no source falls short of its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tokenize import VOCAB, count_tokens
from textloom.session import materialize

BUCKETS = 1024


def running_sum(rows: DataFrame, groups: list[str], bucket: str, order: list[str | Column], value: str, name: str) -> DataFrame:
    """Adds the running sum of value over (bucket, order) within the groups, by bucket totals first."""
    totals = rows.groupBy(*groups, bucket).agg(F.sum(value).alias("_t"))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    within = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(starts, [*groups, bucket])
    return joined.withColumn(name, F.col("_before") + F.sum(value).over(within)).drop("_before")


def queue(docs: DataFrame, targets: DataFrame, budget: int | None = None, path: str = VOCAB, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, source, copy, n_tokens, finish): the copies in the mixture; finish is the virtual time."""
    sized = docs.select("doc_id", "source").join(count_tokens(docs.select("doc_id", "text"), "doc_id", "text", path), "doc_id")
    wanted = targets.groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("max_repeats")).where("share > 0 and max_repeats > 0")
    sized = materialize(sized.where("n_tokens > 0").join(wanted, "source"), "mix-sizes")
    sums = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.max("n_tokens").alias("largest"), F.max("share").alias("share"), F.max("max_repeats").alias("max_repeats")).collect()  # a row for each target source
    whole = sum(r["share"] for r in sums)
    most = min((r["tokens"] * r["max_repeats"] * whole / r["share"] for r in sums), default=0)
    cut = int(budget if budget is not None else most)
    end = last_finish([(r["share"] / whole, r["tokens"] * r["max_repeats"], r["largest"]) for r in sums], cut)
    spent = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(buckets)).cast("int"))
    spent = running_sum(spent, ["source"], "bucket", [F.xxhash64("doc_id", F.lit(11)), F.col("doc_id")], "n_tokens", "upto")
    tokens = F.lit(0)
    for r in sums:
        tokens = F.when(F.col("source") == r["source"], F.lit(r["tokens"])).otherwise(tokens)
    finish = lambda copy: (copy * tokens + F.col("upto")) / (F.col("share") / F.lit(whole or 1.0))
    used = F.filter(F.sequence(F.lit(0), F.col("max_repeats") - 1), lambda k: finish(k) <= F.lit(end))
    timed = spent.select("doc_id", "source", "share", "n_tokens", "upto", F.explode(used).alias("copy")).withColumn("finish", finish(F.col("copy")))
    timed = timed.withColumn("slot", F.floor(F.col("finish") / F.lit(max(1.0, end / buckets))).cast("int"))
    mixed = running_sum(timed, [], "slot", ["finish", "source", "doc_id", "copy"], "n_tokens", "total")
    return mixed.where(F.col("total") <= cut).select("doc_id", "source", (F.col("copy") + 1).alias("copy"), "n_tokens", "finish")


def last_finish(sources: list[tuple[float, int, int]], cut: int) -> float:
    """A virtual time behind which no copy can be in a mixture of `cut` tokens. sources (share, tokens with all repeats, tokens of the largest document).

    By time t a source has given at least min(t * share, all its tokens) less one
    document; the first t at which these reach the cut is enough. Where the
    sources can't, it is the time at which the last one is used up.
    """
    given = lambda t: sum(min(t * share, held) - (largest if t * share < held else 0) for share, held, largest in sources)
    high = max((held / share for share, held, _ in sources), default=0.0)
    if given(high) <= cut:
        return high
    low = 0.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if given(middle) >= cut else (middle, high)
    return high


def report(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, tokens, actual_share, documents, most_repeats) of every target source."""
    used = mixture.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count_distinct("doc_id").alias("documents"), F.max("copy").alias("most_repeats"))
    rows = targets.groupBy("source").agg(F.sum("target_share").alias("target_share")).join(used, "source", "left").fillna(0, ["tokens", "documents", "most_repeats"])
    total = mixture.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("all_tokens"))
    rows = rows.crossJoin(F.broadcast(total))  # one row
    share = F.when(F.col("all_tokens") > 0, F.round(F.col("tokens") / F.col("all_tokens"), 6)).otherwise(0.0)
    return rows.select("source", "target_share", "tokens", share.alias("actual_share"), "documents", "most_repeats")
