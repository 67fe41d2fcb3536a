"""Image URLs from fetched search pages: extraction, filtering, paging, union and quotas."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.operators.ranking import GROUP_BOUND, first_per_key, running_before

# ---- fixed values: markup of the sites -------------------------------------

MEDIA_PATTERNS = [
    r'"murl"\s*:\s*"(https?://[^"]+?\.(?:jpg|jpeg|png|webp))"',
    r"murl&quot;:&quot;(https?://[^&]+)",
    r'mediaurl=(https%3a%2f%2f[^"&]+)',
]
IMAGE_URL = r"(?i)\.(?:jpg|jpeg|png|webp)(?:$|\?)"
HOUZZ_HOST = "hzcdn.com"
HOUZZ_PATTERNS = [
    r'"url"\s*:\s*"(https://st\.hzcdn\.com/simgs/[^"]+)"',
    r'data-src="(https://st\.hzcdn\.com/simgs/[^"]+)"',
    r'src="(https://st\.hzcdn\.com/simgs/[^"]+)"',
]
FLICKR_PHOTOS = r'(?s)"photos"\s*:\s*\{[^}]*"photo"\s*:\s*(\[.*?\])'
FLICKR_INLINE = r'(?:src=|displayUrl\\":|url\\":)"?(?:https?:)?(//live\.staticflickr\.com/\d+/\d+_[a-z0-9]+_[a-z]\.jpg)'
DEZEEN_PATTERN = r"""(https://static\.dezeen\.com/uploads/\d{4}/\d{2}/[^"'<>\s]+?\.(?:jpg|jpeg|webp))"""
# in which part of an URL its size stands, and the large one
HOUZZ_SIZE = (r"_\d+_\d+\.(jpg|jpeg)", r"_1000_666.\1")
FLICKR_SIZE = (r"_[a-z]\.jpg$", "_b.jpg")
DEZEEN_SIZE = (r"-\d+x\d+\.", "-1704x958.")
NOISE = ["thumb", "small", "icon", "60x", "80x", "100x"]
# source, per-query target, page limit, results a page needs for the next one to be fetched
SOURCES = [("bing", 120, None, 20), ("houzz", 80, 2, 0), ("flickr", 60, 5, 0), ("dezeen", 40, 4, 0)]

# ---- end of fixed values ---------------------------------------------------


def _all(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


#: named references that end in a semicolon, as the standard library lists them
NAMED = {f"&{name}": char for name, char in html.entities.html5.items() if name.endswith(";")}
REFERENCE = r"(?s)(&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[A-Za-z][A-Za-z0-9]*;|[^&]+|&)"


def unescape(text: Column) -> Column:
    """Character references decoded once, by name or code point; unknown names stay, impossible code points become U+FFFD."""
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")

    def decoded(part: Column) -> Column:
        hexed = F.lower(F.substring(part, 3, 1)) == "x"
        digits = F.regexp_extract(part, "([0-9a-fA-F]+);$", 1)
        code = F.when(hexed, F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        possible = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.when(possible, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")
        return (
            F.when(~part.startswith("&") | (part == "&"), part).when(part == "&amp;", "&")
            .when(part.startswith("&#"), char).otherwise(F.coalesce(F.try_element_at(names, part), part))
        )

    parts = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)), decoded)
    return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)


def percent_decode(text: Column) -> Column:
    """Percent sequences decoded, a plus sign kept; text that cannot be decoded stays."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def media_urls(html: Column) -> Column:
    """Image URLs of a result page, by pattern and position, each once."""
    raw = F.concat(*[_all(html, p) for p in MEDIA_PATTERNS])

    def clean(url: Column) -> Column:
        plain = unescape(url)
        return F.when(plain.startswith("https%3a%2f%2f"), percent_decode(plain)).otherwise(plain)

    return F.array_distinct(F.filter(F.transform(raw, clean), lambda u: u.rlike(IMAGE_URL)))


def houzz_urls(html: Column) -> Column:
    """Gallery URLs raised to 1000x666, first occurrence first."""
    raw = F.concat(*[_all(html, p) for p in HOUZZ_PATTERNS])
    return F.array_distinct(F.transform(raw, _large))


def _large(url: Column) -> Column:
    return F.regexp_replace(url, HOUZZ_SIZE[0], HOUZZ_SIZE[1].replace("\\", "$"))


def flickr_json_urls(html: Column) -> Column:
    """URLs built from the page's photo list; entries with a missing part are left out."""
    photos = F.from_json(F.regexp_extract(html, FLICKR_PHOTOS, 1),
                         "array<struct<farm:string,server:string,id:string,secret:string>>")

    def whole(p: Column) -> Column:
        # farm is a number, the others are text
        test = ~F.coalesce(p["farm"], F.lit("")).isin("", "0")
        for c in ("server", "id", "secret"):
            test = test & (F.coalesce(p[c], F.lit("")) != "")
        return test

    urls = F.transform(F.filter(photos, whole), lambda p: F.concat(
        F.lit("https://farm"), p["farm"], F.lit(".staticflickr.com/"), p["server"], F.lit("/"), p["id"],
        F.lit("_"), p["secret"], F.lit("_b.jpg")))
    return F.coalesce(urls, F.array().cast("array<string>"))


def flickr_inline_urls(html: Column) -> Column:
    return F.transform(_all(html, FLICKR_INLINE),
                       lambda u: F.regexp_replace(F.concat(F.lit("https:"), u), *FLICKR_SIZE))


def dezeen_urls(html: Column) -> Column:
    return F.transform(_all(html, DEZEEN_PATTERN), lambda u: F.regexp_replace(u, *DEZEEN_SIZE))


def flickr_pages(pages: DataFrame, html: str = "html", bound: int = GROUP_BOUND) -> DataFrame:
    """Add ``urls``: the photo list, or the inline images while no earlier page of the query gave any URL."""
    listed, inline = flickr_json_urls(F.col(html)), flickr_inline_urls(F.col(html))
    df = pages.withColumns({"_json": listed, "_inline": inline})
    some = ((F.size("_json") > 0) | (F.size("_inline") > 0)).cast("int")
    df = running_before(df, ["query"], ["page_no"], {"_had": ("max", some)}, bound)
    take = (F.size("_json") == 0) & (F.coalesce("_had", F.lit(0)) == 0)
    return df.withColumn("urls", F.when(take, F.col("_inline")).otherwise(F.col("_json"))).drop("_json", "_inline", "_had")


def is_noise(url: Column) -> Column:
    """Thumbnails, icons and the like."""
    return F.lower(url).rlike("|".join(NOISE))


def pages_taken(pages: DataFrame, target: int, max_pages: int | None, min_found: int, bound: int = GROUP_BOUND) -> DataFrame:
    """Pages (query, page_no, found, kept, ...) a crawl reads before it stops.

    A page is read while every earlier page had at least ``min_found`` results (and one at
    least for sites with a minimum) and fewer than ``target`` were kept so far. Page numbers start at 0.
    """
    if max_pages is not None:
        pages = pages.where(F.col("page_no") < max_pages)
    before = running_before(pages, ["query"], ["page_no"], {
        "_least": ("min", F.col("found")), "_sum": ("sum", F.col("kept"))}, bound)
    return before.where(
        (F.coalesce("_least", F.lit(min_found)) >= min_found) & (F.coalesce("_sum", F.lit(0)) < target)
    ).drop("_least", "_sum")


def dedupe_urls(urls: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First occurrence of each key by ``order``."""
    return first_per_key(urls, keys, [F.col(o) for o in order])


def union_sources(urls: DataFrame) -> DataFrame:
    """(query, url, source, source_rank, rank): per source the first distinct URLs up to its target, then one per URL.

    ``urls`` has (query, source, page_no, pos, url). An URL of several sources stays with the first.
    """
    names = F.array(*[F.lit(s[0]) for s in SOURCES])
    targets = F.array(*[F.lit(s[1]) for s in SOURCES])
    at = F.array_position(names, F.col("source")).cast("int")
    distinct = dedupe_urls(urls.where(at > 0), ["query", "source", "url"], ["page_no", "pos"])
    order = W.partitionBy("query", "source").orderBy("page_no", "pos", "url")
    top = max(s[1] for s in SOURCES)
    ranked = distinct.withColumn("rank", F.row_number().over(order)).where(
        (F.col("rank") <= top) & (F.col("rank") <= F.element_at(targets, at))
    ).withColumn("source_rank", at)
    return dedupe_urls(ranked, ["query", "url"], ["source_rank", "rank"]).select("query", "url", "source", "source_rank", "rank")


def with_fallback(own: DataFrame, other: DataFrame, target: int) -> DataFrame:
    """(query, url, fallback, rank): a gallery's own URLs, filled up to ``target`` with its hits among other results.

    Both sides have (query, page_no, pos, url). Hits are URLs of the gallery's image host, raised to its large size.
    """
    hits = other.where(F.col("url").contains(HOUZZ_HOST)).withColumn("url", _large(F.col("url")))
    names = ["query", "page_no", "pos", "url"]
    offers = own.select(*names, F.lit(False).alias("fallback")).unionByName(hits.select(*names, F.lit(True).alias("fallback")))
    order = ["fallback", "page_no", "pos"]
    once = dedupe_urls(offers, ["query", "url"], order)
    rank = F.row_number().over(W.partitionBy("query").orderBy(*order, "url"))
    return once.withColumn("rank", rank).where(F.col("rank") <= target).select("query", "url", "fallback", "rank")


def unseen(arrivals: DataFrame, seen: DataFrame, key: str = "content_key", order: tuple[str, ...] = ("ts", "arrival_id")) -> DataFrame:
    """First arrival of each content that is not among the seen hashes, over all classes.

    Copies collapse before the join, so a content that arrives very often costs one row.
    """
    fresh = first_per_key(arrivals, [key], [F.col(o) for o in order])
    return fresh.join(seen.select(key).distinct(), key, "left_anti")


def within_quota(fresh: DataFrame, existing: DataFrame, target: int = V.TARGET_PER_CLASS,
                 order: tuple[str, ...] = ("ts", "arrival_id")) -> DataFrame:
    """Arrivals accepted until each class reaches its target, with ``rank``.

    ``existing`` has (label, have). The fixed bound on the rank lets Spark cut each class
    to ``target`` rows before the shuffle.
    """
    w = W.partitionBy("label").orderBy(*order)
    ranked = fresh.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= target)
    return ranked.join(existing, "label", "left").where(
        F.col("rank") <= target - F.coalesce("have", F.lit(0))).drop("have")
