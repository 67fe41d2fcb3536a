"""Queries on fetched search pages and on arriving images."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.operators import crawl as C
from boxloom.plans.catalog import query
from boxloom.plans.inputs import Inputs
from boxloom.plans.oracle_inputs import compose


def _all(html: str, pattern: str) -> str:
    """SQL for the first group of all matches; the patterns stand in ``operators/crawl.py``."""
    return f"regexp_extract_all({html}, '{pattern.replace("'", "''")}', 1)"


NOISE_SQL = f"regexp_matches(lower(url), '{'|'.join(C.NOISE)}')"
MEDIA_RAW_SQL = f"""select page_id, query, page_no, list_concat(list_concat(
    list_transform({_all("html", C.MEDIA_PATTERNS[0])}, lambda u: replace(u, '&amp;', '&')), {_all("html", C.MEDIA_PATTERNS[1])}),
    list_transform({_all("html", C.MEDIA_PATTERNS[2])}, lambda u: url_decode(replace(u, '+', '%2B')))) as raw from search_pages"""
MEDIA_SQL = {
    "media_raw": MEDIA_RAW_SQL,
    "media_all": f"""select page_id, query, page_no, url, n from (select page_id, query, page_no, unnest(raw) as url, unnest(range(len(raw))) as n from media_raw)
      where regexp_matches(url, '{C.IMAGE_URL}')""",
    "media_urls": """select page_id, query, page_no, url, (row_number() over (partition by page_id order by min(n)) - 1)::int as pos
      from media_all group by page_id, query, page_no, url""",
}


def _media(i: Inputs):
    return i.search_pages().select("page_id", "query", "page_no", F.posexplode(C.media_urls(F.col("html"))).alias("pos", "url"))


@query("extract_media_urls", compose(["search_pages"], "select page_id, pos, url from media_urls", MEDIA_SQL))
def extract_media_urls(i: Inputs):
    return _media(i).select("page_id", "pos", "url")


CDN_SQL = {
    "houzz_raw": f"""select page_id, list_transform({"list_concat(" * (len(C.HOUZZ_PATTERNS) - 1)}{_all("cdn_html", C.HOUZZ_PATTERNS[0])}{"".join(
        f", {_all('cdn_html', p)})" for p in C.HOUZZ_PATTERNS[1:])}, lambda u: regexp_replace(u, '{C.HOUZZ_SIZE[0]}', '{C.HOUZZ_SIZE[1]}', 'g')) as raw from search_pages""",
    "houzz": """select page_id, (row_number() over (partition by page_id order by min(n)) - 1)::int as pos, url
      from (select page_id, unnest(raw) as url, unnest(range(len(raw))) as n from houzz_raw) group by page_id, url""",
    "flickr": f"""select page_id, query, page_no,
        list_transform({_all("flickr_html", C.FLICKR_INLINE)}, lambda u: regexp_replace('https:' || u, '{C.FLICKR_SIZE[0]}', '{C.FLICKR_SIZE[1]}')) as inline_urls,
        case when page_id % 3 = 0 then ['https://farm' || (page_id % 9 + 1) || '.staticflickr.com/s' || page_id % 77 || '/' || page_id || '_x' || page_id * 7 || '_b.jpg'] else [] end as json_urls
      from search_pages""",
    "flickr_used": """select page_id, case when len(json_urls) = 0 and coalesce(max(case when len(json_urls) + len(inline_urls) > 0 then 1 else 0 end)
        over (partition by query order by page_no rows between unbounded preceding and 1 preceding), 0) = 0 then inline_urls else json_urls end as urls from flickr""",
    "dezeen": f"""select page_id, list_transform({_all("cdn_html", C.DEZEEN_PATTERN)}, lambda u: regexp_replace(u, '{C.DEZEEN_SIZE[0]}', '{C.DEZEEN_SIZE[1]}', 'g')) as urls
      from search_pages""",
}


@query("extract_cdn_urls", compose(["search_pages"], """
select 'houzz' as source, page_id, pos, url from houzz union all
select 'flickr', page_id, unnest(range(len(urls)))::int, unnest(urls) from flickr_used union all
select 'dezeen', page_id, unnest(range(len(urls)))::int, unnest(urls) from dezeen""", CDN_SQL))
def extract_cdn_urls(i: Inputs):
    pages = i.search_pages()
    flickr = C.flickr_pages(pages, "flickr_html")
    parts = [("houzz", pages, C.houzz_urls(F.col("cdn_html"))), ("flickr", flickr, F.col("urls")), ("dezeen", pages, C.dezeen_urls(F.col("cdn_html")))]
    frames = [df.select(F.lit(name).alias("source"), "page_id", F.posexplode(urls).alias("pos", "url")) for name, df, urls in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("url_filter", compose(["search_pages"], f"""
select page_id, pos, url from media_urls where not {NOISE_SQL}""", MEDIA_SQL))
def url_filter(i: Inputs):
    return _media(i).where(~C.is_noise(F.col("url"))).select("page_id", "pos", "url")


@query("url_dedupe", compose(["search_pages"], """
select query, url, page_no, pos from (select *, row_number() over (partition by query, url order by page_no, pos) as rn from media_urls) where rn = 1""", MEDIA_SQL))
def url_dedupe(i: Inputs):
    return C.dedupe_urls(_media(i).drop("page_id"), ["query", "url"], ["page_no", "pos"])


@query("page_take_while", compose(["search_pages"], f"""
select query, page_no, found, kept from (select *, coalesce(min(found) over w, 20) as low, coalesce(sum(kept) over w, 0) as had
  from (select query, page_no, count(url) as found, count(case when not {NOISE_SQL} then 1 end) as kept
    from (select p.query, p.page_no, m.url from search_pages p left join media_urls m using (page_id)) group by query, page_no)
  window w as (partition by query order by page_no rows between unbounded preceding and 1 preceding)) where low >= 5 and had < 20""", MEDIA_SQL))
def page_take_while(i: Inputs):
    """Stops after a page with fewer than 5 results or once 20 were kept."""
    urls = C.media_urls(F.col("html"))
    pages = i.search_pages().select("query", "page_no", F.size(urls).cast("long").alias("found"),
                                    F.size(F.filter(urls, lambda u: ~C.is_noise(u))).cast("long").alias("kept"))
    return C.pages_taken(pages, target=20, max_pages=None, min_found=5)


UNION_SQL = MEDIA_SQL | CDN_SQL | {
    "offers": f"""select query, 'bing' as source, page_no, pos, url from media_urls where not {NOISE_SQL}
      union all select p.query, 'houzz', p.page_no, h.pos, h.url from houzz h join search_pages p using (page_id)
      union all select p.query, 'flickr', p.page_no, f.pos, f.url from (select page_id, unnest(range(len(urls)))::int as pos, unnest(urls) as url from flickr_used) f join search_pages p using (page_id)
      union all select p.query, 'dezeen', p.page_no, d.pos, d.url from (select page_id, unnest(range(len(urls)))::int as pos, unnest(urls) as url from dezeen) d join search_pages p using (page_id)""",
    "sources": f"select * from (values {', '.join(f"('{n}', {k + 1}, {t})" for k, (n, t, *_) in enumerate(C.SOURCES))}) s(source, source_rank, target)",
    "firsts": "select * from (select *, row_number() over (partition by query, source, url order by page_no, pos) as rn from offers join sources using (source)) where rn = 1",
    "ranked_offers": "select *, row_number() over (partition by query, source order by page_no, pos, url)::int as rank from firsts",
}


@query("source_union", compose(["search_pages"], """
select query, url, source, source_rank, rank from (select *, row_number() over (partition by query, url order by source_rank, rank) as best
  from ranked_offers where rank <= target) where best = 1""", UNION_SQL))
def source_union(i: Inputs):
    pages = i.search_pages()
    bing = _media(i).where(~C.is_noise(F.col("url"))).select("query", F.lit("bing").alias("source"), "page_no", "pos", "url")
    flickr = C.flickr_pages(pages, "flickr_html")
    out = bing
    for name, df, urls in (("houzz", pages, C.houzz_urls(F.col("cdn_html"))), ("flickr", flickr, F.col("urls")),
                           ("dezeen", pages, C.dezeen_urls(F.col("cdn_html")))):
        out = out.unionByName(df.select("query", F.lit(name).alias("source"), "page_no", F.posexplode(urls).alias("pos", "url")))
    return C.union_sources(out)


FILLED = 6
FALLBACK_SQL = MEDIA_SQL | CDN_SQL | {
    "hits": f"""select query, page_no, pos, regexp_replace(replace(url, 'https://img.example.com/', 'https://st.hzcdn.com/fimgs/'), '{C.HOUZZ_SIZE[0]}', '{C.HOUZZ_SIZE[1]}', 'g') as url
      from media_urls where page_no % 2 = 0 and contains(url, 'https://img.example.com/')""",
    "both_kinds": """select p.query, p.page_no, h.pos, h.url, false as fallback from houzz h join search_pages p using (page_id) where p.page_no = 0
      union all select query, page_no, pos, url, true from hits""",
    "once": "select * from (select *, row_number() over (partition by query, url order by fallback, page_no, pos) as rn from both_kinds) where rn = 1",
}


@query("fallback_urls", compose(["search_pages"], f"""
select query, url, fallback, rank from (select *, (row_number() over (partition by query order by fallback, page_no, pos, url))::int as rank from once)
where rank <= {FILLED}""", FALLBACK_SQL))
def fallback_urls(i: Inputs):
    """The gallery's first page, filled up with its hits among the other results."""
    own = i.search_pages().where("page_no = 0").select("query", "page_no", F.posexplode(C.houzz_urls(F.col("cdn_html"))).alias("pos", "url"))
    other = _media(i).where(F.col("page_no") % 2 == 0).withColumn(
        "url", F.replace("url", F.lit("https://img.example.com/"), F.lit("https://st.hzcdn.com/fimgs/")))
    return C.with_fallback(own, other, FILLED)


CUTOFF = "2024-01-02 00:00:00"
SEEN_SQL = {
    "seen": f"select distinct content_key from arrivals where ts < timestamp '{CUTOFF}'",
    "fresh": f"""select * from (select *, row_number() over (partition by content_key order by ts, arrival_id) as rn from arrivals
      where ts >= timestamp '{CUTOFF}') where rn = 1 and content_key not in (select content_key from seen)""",
    "existing": f"select label, count(distinct content_key) as have from arrivals where ts < timestamp '{CUTOFF}' group by label",
}


def _arrivals(i: Inputs):
    a = i.arrivals()
    early = F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz")
    return a.where(early), a.where(~early)


@query("seen_hash_filter", compose(["arrivals"], "select arrival_id, label, content_key from fresh", SEEN_SQL))
def seen_hash_filter(i: Inputs):
    old, new = _arrivals(i)
    return C.unseen(new, old).select("arrival_id", "label", "content_key")


@query("class_quota", compose(["arrivals"], """
select arrival_id, label, rank from (select f.*, row_number() over (partition by label order by ts, arrival_id)::int as rank from fresh f)
left join existing using (label) where rank <= 300 - coalesce(have, 0)""", SEEN_SQL))
def class_quota(i: Inputs):
    old, new = _arrivals(i)
    have = old.select("label", "content_key").distinct().groupBy("label").agg(F.count(F.lit(1)).alias("have"))
    return C.within_quota(C.unseen(new, old), have, 300).select("arrival_id", "label", "rank")
