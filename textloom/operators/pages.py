"""Captured pages of document sources as rows: JSON pages, item files, links, proxy lists, criteria."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAPER = "struct<url: string, citationCount: bigint, isOpenAccess: boolean>"


def paper_page(pages: DataFrame, key: str, body: str, page: Column, size: int, most: int, least_citations: int = 0, open_only: bool = True) -> DataFrame:
    """(key, url, has_more) of JSON pages `{data: [...], next}`; papers without URL, with too few citations or, if asked, not open are left out."""
    parsed = pages.select(key, F.from_json(body, f"data array<{PAPER}>, next bigint").alias("p"), page.alias("_page"))
    papers = parsed.select(key, F.explode("p.data").alias("x"), (F.col("p.next").isNotNull() & (F.col("_page") * size < most)).alias("has_more"))
    kept = (F.col("x.url").isNotNull()) & (F.coalesce("x.citationCount", F.lit(0)) >= least_citations)
    if open_only:
        kept = kept & F.coalesce("x.isOpenAccess", F.lit(False))
    return papers.where(kept).select(key, "x.url", "has_more")


def first_file(files: Column, ending: str = ".pdf") -> Column:
    """The first of an item's files with the ending, whatever its case; null for none."""
    return F.get(F.filter(files, lambda f: F.endswith(F.lower(f), F.lit(ending))), 0)


def tagged(url: Column, tag: Column) -> Column:
    """The URL with a fragment that names its source."""
    return F.concat(url, F.lit("#"), tag)


def page_links(pages: DataFrame, key: str, body: str) -> DataFrame:
    """(key, pos, link): the distinct link targets of an HTML page at the place of their first appearance."""
    links = pages.select(key, F.posexplode(F.regexp_extract_all(body, F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "link"))
    return links.groupBy(key, "link").agg(F.min("pos").alias("pos"))


def full_page(n_links: Column, per_page: int) -> Column:
    """Whether more pages follow: a page that holds less than it may is the last."""
    return n_links >= per_page


def site_link(href: Column, prefix: str, suffix: str = "") -> Column:
    """The absolute address of a site's link."""
    return F.concat(F.lit(prefix), href, F.lit(suffix))


def capped(rows: DataFrame, criteria: DataFrame, source: str, order: str) -> DataFrame:
    """Rows of the sources that have a criterion (source, max_results, tag), the first max_results of each."""
    most = criteria.agg(F.max("max_results")).first()[0]  # one row
    joined = rows.join(criteria, source)
    ranked = joined.withColumn("place", F.row_number().over(Window.partitionBy(source).orderBy(order)))
    return ranked.where((F.col("place") <= int(most or 0)) & (F.col("place") <= F.col("max_results")))  # the number alone limits groups before the shuffle


def proxy_line(line: Column) -> Column:
    """(ip, port, protocol) of a line `ip:port` or of a JSON object with ip, port and protocols; null for anything else."""
    plain = F.regexp_extract(line, r"^\s*(\d{1,3}(?:\.\d{1,3}){3}):(\d{1,5})\s*$", 1)
    port = F.regexp_extract(line, r"^\s*(\d{1,3}(?:\.\d{1,3}){3}):(\d{1,5})\s*$", 2)
    j = F.from_json(line, "ip string, port string, protocols array<string>")
    given = F.struct(j["ip"].alias("ip"), j["port"].try_cast("int").alias("port"), F.coalesce(F.get(j["protocols"], 0), F.lit("http")).alias("protocol"))
    text = F.struct(plain.alias("ip"), port.try_cast("int").alias("port"), F.lit("http").alias("protocol"))
    found = F.when(plain != "", text).when(j["ip"].isNotNull(), given)
    return F.when(found["port"].isNotNull(), found)


def proxy_cells(cells: Column) -> Column:
    """(ip, port, protocol) of an HTML table row; the seventh cell says whether it speaks https."""
    port = F.get(cells, 1).try_cast("int")
    return F.when((F.size(cells) >= 7) & port.isNotNull(), F.struct(F.get(cells, 0).alias("ip"), port.alias("port"), F.when(F.lower(F.trim(F.get(cells, 6))) == "yes", "https").otherwise("http").alias("protocol")))


def criterion(form: dict[str, Column], allowed: list[str], lists: list[str], max_results: int = 200) -> Column:
    """A search criterion of form fields: only the allowed ones, comma lists split, trimmed and without blanks, a default for max_results."""
    split = lambda c: F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    fields = [(split(c) if name in lists else F.nullif(F.trim(c), F.lit(""))).alias(name) for name, c in form.items() if name in allowed]
    cap = F.coalesce(form["max_results"].try_cast("int"), F.lit(max_results)) if "max_results" in form else F.lit(max_results)
    return F.struct(*[f for f, name in zip(fields, [n for n in form if n in allowed], strict=True) if name != "max_results"], cap.alias("max_results"))


def config_field(config: Column, name: str, default: str) -> Column:
    """A field of a JSON configuration, or its default."""
    return F.coalesce(F.get_json_object(config, f"$.{name}"), F.lit(default))


def filled(template: str, values: dict[str, Column]) -> Column:
    """A prompt template with its {names} replaced, one after the other; nulls are empty."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


def file_state(data: Column, pages: Column, n_chars: Column) -> Column:
    """How whole a PDF is: `fail`, `ok_no_eof`, `ok_no_text` or `ok_clean`.

    The header stands in the first 1024 bytes after leading NULs, the end mark in the last 2048.
    """
    text = F.decode(data, "ISO-8859-1")
    bare = F.ltrim(text, F.lit("\0"))
    head = F.contains(F.substring(bare, 1, 1024), F.lit("%PDF"))
    tail = F.contains(F.when(F.length(text) > 2048, F.substring(text, -2048, 2048)).otherwise(text), F.lit("%%EOF"))
    return F.when(~F.coalesce(head, F.lit(False)) | ~F.coalesce(pages > 0, F.lit(False)), "fail").when(~tail, "ok_no_eof").when(~F.coalesce(n_chars > 40, F.lit(False)), "ok_no_text").otherwise("ok_clean")


def audit(rows: DataFrame, state: str, size: str) -> DataFrame:
    """(state, n, percent, mean_size)."""
    total = rows.agg(F.count("*").alias("all"))
    per = rows.groupBy(state).agg(F.count("*").alias("n"), F.round(F.avg(size), 2).alias("mean_size")).crossJoin(F.broadcast(total))  # one row
    return per.select(state, "n", F.round(100.0 * F.col("n") / F.col("all"), 2).alias("percent"), "mean_size")
