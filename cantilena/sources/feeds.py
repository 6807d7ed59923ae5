"""Podcast feeds: items, enclosures, and a feed written back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extension_of, feed_date, safe_file_name
from ..operators.relational import keep_first

ITEM = "title string, pubDate string, description string, guid string, enclosure array<struct<_url:string,_type:string,_VALUE:string>>"


def feed_items(spark: SparkSession, path: str) -> DataFrame:
    """(feed, title, published, description, id, links) of the items of RSS files; missing fields are the text None."""
    rows = spark.read.format("xml").option("rowTag", "item").schema(ITEM).load(path).withColumn("feed", F.input_file_name())
    none = lambda c: F.coalesce(F.col(c), F.lit("None"))
    links = F.transform(F.coalesce("enclosure", F.expr("cast(array() as array<struct<_url:string,_type:string,_VALUE:string>>)")), lambda e: F.struct(F.lit("enclosure").alias("rel"), e["_url"].alias("href"), e["_type"].alias("type")))
    return rows.select("feed", none("title").alias("title"), none("pubDate").alias("published"), none("description").alias("description"), none("guid").alias("id"), links.alias("links"))


def downloads(items: DataFrame) -> DataFrame:
    """Items with one enclosure, without repeats (the first feed's stays): name, url, extension. Several enclosures, or an unknown type, raise an error."""
    one = F.filter("links", lambda x: x["rel"] == "enclosure")
    rows = items.withColumn("_l", F.when(F.size(one) > 1, F.raise_error(F.lit("several enclosures")).cast("array<struct<rel:string,href:string,type:string>>")).otherwise(one)).where(F.size("_l") == 1)
    rows = keep_first(rows, ["title", "published"], [F.col("feed"), F.col("id").desc()])
    link = F.get("_l", F.lit(0))
    return rows.select("feed", "title", "published", safe_file_name(F.concat_ws(" ", feed_date(F.col("published")), F.col("title"))).alias("name"), link["href"].alias("url"), extension_of(link["type"]).alias("extension"))


def feed_text(items: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, content): a feed of each channel. items: the keys, channel_title, channel_link and channel_description, and at (their order), id, title,
    description, uploaded (yyyymmdd) and url. A missing title is "No title"; items without a date have none."""
    safe = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), safe(F.coalesce(c, F.lit(""))), F.lit(f"</{name}>"))
    day = F.date_format(F.try_to_timestamp("uploaded", F.lit("yyyyMMdd")), "EEE, dd MMM yyyy HH:mm:ss")
    kind = F.when(F.col("url").contains("soundcloud"), "soundcloud").otherwise("video/mp4")
    link = F.concat(F.lit('<enclosure url="'), safe(F.coalesce("url", F.lit(""))), F.lit('" length="0" type="'), kind, F.lit('"/>'))
    date = F.coalesce(F.concat(F.lit("<pubDate>"), day, F.lit(" +0000</pubDate>")), F.lit(""))
    item = F.concat(F.lit("<item>"), tag("title", F.coalesce("title", F.lit("No title"))), tag("link", F.col("url")), tag("guid", F.col("id")), tag("description", F.col("description")), date, link, F.lit("</item>"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "id", item.alias("item")))), lambda x: x["item"]), "\n")
    rows = items.groupBy(*keys).agg(said.alias("_i"), *[F.min(f"channel_{c}").alias(f"_{c}") for c in ("title", "link", "description")])
    head = F.concat(*[tag(c, F.col(f"_{c}")) for c in ("title", "link", "description")])
    return rows.select(*keys, F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel>'), head, F.lit("\n"), F.col("_i"), F.lit("\n</channel></rss>\n")).alias("content"))


def write_feed(items: DataFrame, path: str) -> None:
    """items as RSS item elements."""
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").mode("overwrite").save(path)
