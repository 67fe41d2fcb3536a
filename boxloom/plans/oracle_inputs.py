"""The same derivations as SQL common table expressions, for the side-by-side check."""

from __future__ import annotations

from boxloom import vocabulary as V


def _list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


REVIEW_LIST = _list(V.REVIEW_CLASSES)
COLLECTION_LIST = _list(V.COLLECTION_CLASSES)
MERGED_LIST = _list(V.MERGED_CLASSES)

_MAP = ", ".join(
    f"({i}, '{n}', '{V.MERGE_MAP[n]}', {V.MERGED_CLASSES.index(V.MERGE_MAP[n])})"
    for i, n in enumerate(V.REVIEW_CLASSES)
)
_GROUP_NAMES = {g: n[:2] for g, n in V.GROUPS.items()} | {"unknown": ["a", "b"]}


def _group_name(index: str) -> str:
    arms = " ".join(
        f"when grp = '{g}' then (case when {index} = 0 then '{two[0]}' else '{two[1]}' end)"
        for g, two in _GROUP_NAMES.items()
    )
    return f"(case {arms} end)"


CTES = {
    "class_map": ([], f"select * from (values {_MAP}) t(class_id, source_class, target_class, target_id)"),
    "classes": ([], "select class_id, source_class as label from class_map"),
    "boxes": ([], """
        select l_orderkey as image_id,
          l_linenumber::bigint * 1000000000
            + (l_partkey * 7919 + l_suppkey * 104729 + l_quantity::bigint * 1299709) % 1000000000 as line_no,
          (l_suppkey % 20)::int as class_id,
          (0.125 + (l_partkey % 4) * 0.25)::double as xc,
          (0.125 + (l_linenumber % 4) * 0.25)::double as yc,
          (0.125 + (l_quantity::bigint % 3) * 0.1875)::double as w,
          (0.125 + (l_suppkey % 3) * 0.1875)::double as h,
          0.20::double + l_discount * 6 + l_tax as score,
          l_linenumber % 5 = 4 as second_pass
        from lineitem"""),
    "mapped_boxes": (["class_map", "boxes"], """
        select b.*, m.source_class, m.target_class, m.target_id,
          xc - w / 2 as x1, yc - h / 2 as y1, xc + w / 2 as x2, yc + h / 2 as y2
        from boxes b join class_map m using (class_id)"""),
    "detections": (["boxes"], f"""
        select image_id, line_no as pos, ({REVIEW_LIST})[class_id + 1] as label, score,
          case when second_pass then 'expected_fallback' else 'full_prompt' end as source,
          xc * 1024 - w * 1024 / 2 as x1, yc * 768 - h * 768 / 2 as y1,
          xc * 1024 + w * 1024 / 2 as x2, yc * 768 + h * 768 / 2 as y2
        from boxes"""),
    "scenes": ([], f"""
        select o_orderkey as image_id, ({REVIEW_LIST})[o_custkey % 20 + 1] as expected_class,
          1024 as width, case when o_orderstatus = 'P' then 384 else 768 end as height
        from orders"""),
    "images": ([], f"""
        select doc_id as image_id, source as folder,
          ({REVIEW_LIST})[regexp_extract(source, '(\\d+)$', 1)::int % 20 + 1] as label,
          source || '/' || doc_id || '.jpg' as path,
          (256 + n_chars % 1793)::int as width, (256 + (doc_id * 37) % 1280)::int as height,
          n_chars as file_size, sha1(text) as sha1
        from documents"""),
    "scene_images": ([], f"""
        select o_orderkey as image_id, label as folder, label, label || '/' || o_orderkey || '.jpg' as path,
          1024 as width, case when o_orderstatus = 'P' then 384 else 768 end as height, o_orderkey % 1000 + 1 as file_size,
          sha1(case when o_orderkey % 10 < 7 then 'o' || o_orderkey
            else 'c' || (case when o_orderkey % 10 = 9 then o_custkey // 2 else o_custkey end) || o_orderstatus end) as sha1
        from (select *, ({REVIEW_LIST})[o_custkey % 20 + 1] as label from orders)"""),
    "label_lines": ([], """
        select o_orderkey as k, o_custkey % 6 as n, case when i % 2 = 0 then ((o_orderkey + i) % 20)::varchar
          else ((o_orderkey + i) % 20)::varchar || '.0' end
          || ' ' || (0.125 + ((o_orderkey + i) % 4) * 0.25)::double::varchar
          || ' ' || (0.125 + (i % 4) * 0.25)::double::varchar
          || ' ' || (0.125 + ((o_orderkey + i) % 3) * 0.1875)::double::varchar
          || ' ' || (0.125 + (i % 3) * 0.1875)::double::varchar as line, i
        from orders, range(0, 5) r(i) where i < o_custkey % 6"""),
    "label_files": (["label_lines"], """
        select o_orderkey as image_id, case o_orderkey % 10
            when 0 then 'not a box' || chr(10) || t
            when 1 then t || chr(10) || '3 1.5 -0.25 0.5 0.5'
            when 2 then replace(t, chr(10), chr(13) || chr(10))
            when 3 then chr(10) || t || chr(10)
            when 4 then t || chr(10) || '7 0.5 0.5 0.25 0.25 0.9'
            when 5 then t || chr(10) || '25 0.5 0.5 0.25 0.25'
            when 6 then '1 0.5 x 0.25 0.25' || chr(10) || t
            else t end as text
        from (select o_orderkey, coalesce(string_agg(line, chr(10) order by i), '') as t
              from orders left join label_lines on k = o_orderkey group by o_orderkey)"""),
    "file_lines": (["label_files"], """
        select image_id, unnest(range(len(parts))) as line_no, unnest(parts) as line
        from (select image_id, string_split_regex(text, '\\r\\n|\\n|\\r') as parts from label_files)"""),
    "fields": (["file_lines"], """
        select image_id, line_no, trim(line) as line, string_split_regex(trim(line), '\\s+') as f from file_lines"""),
    "vectors": ([], """
        select vec_id * 3 + k as vec_id, 'f' || label as folder, (vec_id * 3 + k) % 7 as pixels,
          (vec_id * 3 + k) % 5 as width,
          list_transform(range(1, len(embedding) + 1), lambda i: embedding[i]::double
            + k * 0.07::double * embedding[i % len(embedding) + 1]::double) as vector
        from embeddings, range(0, 3) r(k)"""),
    "predictions": ([], f"""
        select sample_id, grp as "group", split, split || '/' || {_group_name('quality')} || '/' || sample_id || '.png' as path,
          {_group_name('quality')} as true_label, {_group_name('pred')} as top_label,
          {_group_name('1 - pred')} as other_label, {_group_name('0')} as first_name, {_group_name('1')} as second_name,
          pred, conf, 1 - conf as second
        from (select doc_id as sample_id, quality, (['plant', 'table', 'door', 'window', 'unknown'])[doc_id % 5 * 2 % 5 + 1] as grp,
            case when doc_id % 10 < 8 then 'train' when doc_id % 10 = 8 then 'val' else 'test' end as split,
            case when doc_id % 5 = 0 then 1 - quality else quality end as pred,
            0.5::double + (doc_id % 50 + 1) / 100.0::double as conf
          from labels)"""),
    "search_pages": ([], r"""
        select page_id, 'q' || (page_id // 8) as query, (page_id % 8)::int as page_no,
          replace(regexp_replace(regexp_replace(html, 'href="/([^"/?&]{1,40})"', '"murl":"https://img.example.com/\1.jpg"', 'g'),
            'href="https?://([^"/]+)/([^"?&]{1,60})[^"]*"',
            'murl&quot;:&quot;https://\1/\2.png&quot; mediaurl=https%3a%2f%2f\1%2fthumb%2f\2.webp&', 'g'), 'example.com/t', 'example.com/thumb/t') as html,
          cdn as cdn_html,
          case when page_id % 3 = 0 then printf('"photos":{"page":1,"photo":[{"farm":%d,"server":"s%d","id":"%d","secret":"x%d"},{"farm":0,"server":"","id":"1"}]}',
            page_id % 9 + 1, page_id % 77, page_id, page_id * 7) || cdn else cdn end as flickr_html
        from (select *, regexp_replace(html, 'href="/([^"/?&]{1,40})"',
            'data-src="https://st.hzcdn.com/simgs/\1_4_8.jpg" "https://static.dezeen.com/uploads/2020/01/\1-411x274.jpg" src="//live.staticflickr.com/65535/123_ab_m.jpg"', 'g') as cdn
          from pages)"""),
    "arrivals": ([], """
        select event_id as arrival_id, ts, event_type as label, md5(user_id || '|' || event_type) as content_key from events"""),
}
CTES["classes"] = (["class_map"], CTES["classes"][1])


def compose(needs: list[str], body: str, more: dict[str, str] | None = None, recursive: bool = False) -> str:
    """One statement from the named derivations, further named steps and the final select."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{n} as ({CTES[n][1]})" for n in order]
    parts += [f"{n} as ({sql})" for n, sql in (more or {}).items()]
    if not parts:
        return body
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(parts) + "\n" + body
