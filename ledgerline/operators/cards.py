"""Presentation rows: summaries, cards, feed items and feed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.keys import percent_encoded_path
from ledgerline.operators import select
from ledgerline.sources.views import instant

#: Where links lead; a parameter of every deployment.
WEB_BASE, FEED_BASE = "https://registry.example/", "https://data.example/"
#: What XML can't hold.
XML_INVALID = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def entry_path() -> Column:
    return F.concat(F.lit("entries/"), "id", F.lit("-v"), "version", F.lit(".json"))


def summary(records: DataFrame) -> DataFrame:
    return records.select("id", "version", "title", F.lit("registered").alias("status"), entry_path().alias("path"))


def version_summary(records: DataFrame) -> DataFrame:
    return records.select("id", "version", "submission_id", instant(F.col("registered_at")).alias("registered"), "title", F.lit("registered").alias("status"), entry_path().alias("path"), F.concat_ws("|", "brand", "type").alias("classification"))


def card(current: DataFrame, active_records: DataFrame) -> DataFrame:
    """The nested card of each current record; versions counts its active versions."""
    versions = active_records.groupBy("id").agg(F.count("*").alias("versions"))
    cards = current.join(versions, "id")
    classification = F.struct(F.array("brand").alias("brand"), F.array("type").alias("type"))
    source = F.struct("repository", "project_path", "commit_sha")
    return cards.select("id", "version", "versions", "title", entry_path().alias("path"), instant(F.col("registered_at")).alias("published_at"), classification.alias("classification"), source.alias("source"), F.array(F.struct(F.col("owner").alias("name"))).alias("authors"), "registered_at")


def source_mapping(records: DataFrame, mappings: DataFrame) -> DataFrame:
    """The one entry of a record's mapping list whose repository (in lower case) and commit match its source; matches other than one are errors.

    mappings: id, version, mapping array<struct<repository, commit, fork>>.
    """
    joined = records.join(mappings, ["id", "version"])
    own = F.filter("mapping", lambda m: (F.lower(m["repository"]) == F.lower(F.col("repository"))) & (m["commit"] == F.col("commit_sha")))
    return joined.select("id", "version", F.size(own).cast("long").alias("matches"), F.when(F.size(own) == 1, F.get(own, 0)["fork"]).alias("fork"))


def escaped_html(text: Column) -> Column:
    """Text for HTML: what XML can't hold replaced, then five signs escaped, & first."""
    out = F.regexp_replace(text, XML_INVALID, "�")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def escaped_xml(text: Column) -> Column:
    out = text
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def rfc2822(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))


def feed_items(rows: DataFrame, web_base: str = WEB_BASE) -> DataFrame:
    """Link, guid, escaped title and description, date and categories of each row."""
    link = F.concat(F.lit(f"{web_base}entry.html?id="), "id", F.lit("&version="), "version")
    return rows.withColumns({
        "link": link, "guid": link,
        "item_title": escaped_xml(F.regexp_replace("title", XML_INVALID, "�")),
        "description": escaped_xml(escaped_html(F.concat_ws(" ", "title", "type"))),
        "pub_date": rfc2822(F.col("registered_at")),
        "categories": F.concat(F.lit("brand:"), "brand", F.lit(",type:"), "type"),
    })


def feed_documents(items: DataFrame, feed_base: str = FEED_BASE) -> DataFrame:
    """One RSS text per (kind, code) of ranked items (see feed_items); at most the front list's rows each."""
    element = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    category = F.concat(F.lit('<category domain="brand">'), escaped_xml(F.col("brand")), F.lit('</category><category domain="type">'), escaped_xml(F.col("type")), F.lit("</category>"))
    item = element("item", F.concat(element("title", F.col("item_title")), element("link", escaped_xml(F.col("link"))), F.lit('<guid isPermaLink="true">'), escaped_xml(F.col("guid")), F.lit("</guid>"), element("description", F.col("description")), element("pubDate", F.col("pub_date")), category))
    grouped = items.withColumn("item", item).groupBy("kind", "code").agg(F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("items"), F.max("registered_at").alias("built"))
    body = F.array_join(F.transform("items", lambda x: x["item"]), "")
    title = F.concat(F.lit("New results: "), "code")
    url = F.concat(F.lit(f"{feed_base}feeds/"), "kind", F.lit("/"), percent_encoded_path(F.col("code")), F.lit(".xml"))
    document = F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?><rss version="2.0"><channel>'), element("title", escaped_xml(title)), element("lastBuildDate", rfc2822(F.col("built"))), element("link", url), body, F.lit("</channel></rss>"))
    return grouped.select("kind", "code", F.size("items").cast("long").alias("n_items"), document.alias("document"))


def recent_renders(recent_rows: DataFrame, prior: DataFrame, fresh: DataFrame) -> DataFrame:
    """The render hash of each recent row: a fresh one before a prior one; null where there is neither, which is a violation."""
    both = prior.withColumn("p", F.lit(1)).unionByName(fresh.withColumn("p", F.lit(0)))
    order = Window.partitionBy("id", "version").orderBy("p", "tree_sha256")
    first = both.withColumn("n", F.row_number().over(order)).where("n = 1").select("id", "version", "tree_sha256")
    return recent_rows.select("id", "version").join(first, ["id", "version"], "left")


def front(current: DataFrame, n: int = 50) -> DataFrame:
    return select.top_per_code(current, n)
