"""Queries on image tables: hashes, duplicates, near duplicates, splits, renumbering, manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.cluster import cut
from boxloom.functions import bitmaps, pixels
from boxloom.functions import text as X
from boxloom.operators import dedupe, detections as D, flags, manifests, neardup, splits, stats
from boxloom.plans.box_queries import SAME_CLASS_BODY, nms_oracle
from boxloom.plans.catalog import query
from boxloom.plans.inputs import Inputs
from boxloom.plans.oracle_inputs import COLLECTION_LIST, REVIEW_LIST, compose

QUALITY_SQL = "{'p': width::bigint * height, 'w': width, 'f': file_size, 'n': path}"
DECISIONS_SQL = f"""
select least(best, q).n as remove_image, greatest(best, q).n as keep_image, final as final_keep,
  'exact_duplicate' as reason, 1.0::double as score
from (select {QUALITY_SQL} as q,
    max({QUALITY_SQL}) over (partition by sha1 order by path rows between unbounded preceding and 1 preceding) as best,
    (max({QUALITY_SQL}) over (partition by sha1)).n as final
  from images) where best is not null"""


@query("content_hash", "select doc_id as image_id, md5(text) as md5, sha1(text) as sha1 from documents")
def content_hash(i: Inputs):
    return i.documents().select(F.col("doc_id").alias("image_id"), F.md5("text").alias("md5"), F.sha1("text").alias("sha1"))


@query("path_parts", compose(["images"], r"""
select image_id, split_part(path, '/', -1) as file_name, regexp_extract(split_part(path, '/', -1), '^(.*)\.[^.]*$', 1) as stem,
  'jpg' as suffix, folder as leaf, folder as parent, 'images/' || folder || '_x' as mirrored, lower(trim(replace(folder, 's', 'S '))) as plain,
  'labels/' || folder as labels_dir, image_id || '.txt' as label_name
from images"""))
def path_parts(i: Inputs):
    p = F.col("path")
    return i.images().select(
        "image_id", X.file_name(p).alias("file_name"), X.stem(p).alias("stem"), X.suffix(p).alias("suffix"),
        X.leaf_folder(p).alias("leaf"), X.parent(p).alias("parent"),
        X.forward_slashes(F.concat(F.lit("images\\"), F.col("folder"), F.lit("_x"))).alias("mirrored"),
        F.lower(F.trim(F.replace("folder", F.lit("s"), F.lit("S ")))).alias("plain"),
        X.labels_dir(F.concat(F.lit("images/"), F.col("folder"))).alias("labels_dir"),
        X.with_suffix(X.file_name(p), ".txt").alias("label_name"))


@query("export_stem", compose(["images"], """
select image_id, label || '__' || image_id || '__' || substr(sha1, 1, 12) as export_stem from images"""))
def export_stem(i: Inputs):
    return i.images().select("image_id", X.export_stem(F.col("label"), F.col("path"), F.col("sha1")).alias("export_stem"))


@query("quarantine_unreadable", compose(["images"], """
select case when height <= 300 then 'skipped' else 'kept' end as outcome, image_id, path,
  case when height <= 300 then 'cannot be decoded' else '' end as reason from images"""))
def quarantine_unreadable(i: Inputs):
    """Images whose decode gave no size (here: the lowest ones) leave the run with a reason."""
    from boxloom.sources.images import quarantine

    decoded = i.images().withColumn("height", F.when(F.col("height") <= 300, -1).otherwise(F.col("height")))
    good, skipped = quarantine(decoded)
    none = F.lit("").alias("reason")
    return good.select(F.lit("kept").alias("outcome"), "image_id", "path", none).unionByName(
        skipped.select(F.lit("skipped").alias("outcome"), "image_id", "path", "reason"))


@query("quality_gate", compose(["images"], """
select image_id, case when file_size < 2000 then 'few_bytes' when least(width, height) < 512 then 'small_side'
    when white > 0.72 then 'white' when dark > 0.88 then 'dark' when red_std < 8 then 'flat' else 'ok' end as verdict
from (select *, (image_id % 100) / 100.0::double as white, (image_id % 90) / 100.0::double as dark, (image_id % 50)::double as red_std from images)"""))
def quality_gate(i: Inputs):
    d = F.col("image_id")
    table = i.images().withColumns({
        "white": (d % 100) / 100.0, "dark": (d % 90) / 100.0, "red_std": (d % 50).cast("double")})
    return table.select("image_id", pixels.verdict(min_bytes=2000).alias("verdict"))


@query("reasons_by_group", compose(["images"], """
select folder, case when file_size < 2000 then 'few_bytes' when least(width, height) < 512 then 'small_side' when image_id % 100 > 72 then 'white'
  when image_id % 90 > 88 then 'dark' when image_id % 50 < 8 then 'flat' else 'ok' end as reason, count(*) as n from images group by all"""))
def reasons_by_group(i: Inputs):
    """How often each folder's images go to review for which reason."""
    d = F.col("image_id")
    table = i.images().withColumns({"white": (d % 100) / 100.0, "dark": (d % 90) / 100.0, "red_std": (d % 50).cast("double")})
    return stats.reasons_by_group(table, "folder", pixels.verdict(min_bytes=2000))


@query("per_class_limit", compose(["images"], """
select image_id, folder, path from (select *, row_number() over (partition by folder order by md5('42|' || path)) as r from images) where r <= 5"""))
def per_class_limit(i: Inputs):
    """The feature is the limit: so many images of each folder, in seeded order."""
    return splits.per_class_limit(i.images(), "folder", "path", 5).select("image_id", "folder", "path")


@query("dup_flags", compose(["images"], """
select image_id, case when n > 1 and lo <> hi then 'cross_class_duplicate;exact_duplicate' when n > 1 then 'exact_duplicate' else '' end as flags
from (select image_id, count(*) over (partition by sha1) as n, min(label) over (partition by sha1) as lo,
  max(label) over (partition by sha1) as hi from images)"""))
def dup_flags(i: Inputs):
    return flags.duplicate_flags(i.images()).select("image_id", F.array_join("dup_flags", ";").alias("flags"))


PRIMARY_SQL = f"""
select sha1, label, size from (
  select sha1, label, sum(n) over (partition by sha1)::bigint as size,
    row_number() over (partition by sha1 order by n desc, list_position({COLLECTION_LIST}, label)) as rn
  from (select sha1, label, count(*) as n from images group by sha1, label)) where rn = 1"""


@query("primary_class", compose(["images"], PRIMARY_SQL))
def primary_class(i: Inputs):
    return splits.primary_classes(i.images(), V.position(V.COLLECTION_CLASSES, F.col("label")))


@query("exact_dup_decisions", compose(["images"], DECISIONS_SQL))
def exact_dup_decisions(i: Inputs):
    return dedupe.exact_decisions(i.images())


@query("after_exact_dedupe", compose(["images"], f"""
select image_id, path, sha1 from (select *, row_number() over (partition by sha1 order by {QUALITY_SQL} desc) as rn from images) where rn = 1"""))
def after_exact_dedupe(i: Inputs):
    images = i.images()
    return dedupe.without(images, dedupe.exact_decisions(images)).select("image_id", "path", "sha1")


def _two_rounds(i: Inputs):
    """Exact decisions, and a second opinion on the same images with varying scores."""
    exact = dedupe.exact_decisions(i.images()).withColumn("pos", F.lit(0))
    score = F.lit(0.995) + F.length("remove_image") % 3 * 0.0025
    again = exact.select("remove_image", F.col("final_keep").alias("keep_image"), "final_keep",
                         F.lit("near_duplicate").alias("reason"), score.alias("score"), F.lit(1).alias("pos"))
    return exact.unionByName(again)


TWO_ROUNDS_SQL = {"exact": DECISIONS_SQL, "both": """select *, 0 as pos from exact union all
  select remove_image, final_keep, final_keep, 'near_duplicate', 0.995::double + length(remove_image) % 3 * 0.0025::double, 1 from exact"""}
ONE_SQL = """select remove_image, keep_image, reason, score from (
  select *, row_number() over (partition by remove_image order by score desc, pos) as rn from both) where rn = 1"""


@query("dedupe_decisions", compose(["images"], ONE_SQL.replace("both", '"both"'), {
    "exact": DECISIONS_SQL, '"both"': TWO_ROUNDS_SQL["both"]}))
def dedupe_decisions(i: Inputs):
    return dedupe.one_per_removed(_two_rounds(i)).select("remove_image", "keep_image", "reason", "score")


RENUMBER_SQL = """
select image_id, path, folder || '/' || folder || '_' || lpad(row_number() over (partition by folder order by path)::varchar, 6, '0') || '.jpg' as new_path
from {}"""


@query("renumber", compose(["images"], RENUMBER_SQL.format("images")))
def renumber(i: Inputs):
    return dedupe.renumber(i.images()).select("image_id", "path", "new_path")


SURVIVORS_SQL = f"select * from (select *, row_number() over (partition by sha1 order by {QUALITY_SQL} desc) as rn from images) where rn = 1"


@query("manifest_update", compose(["images"], """
select new_path as export_image, regexp_replace(new_path, 'jpg$', 'txt') as export_label, image_id from renamed""",
    {"survivors": SURVIVORS_SQL, "renamed": RENUMBER_SQL.format("survivors")}))
def manifest_update(i: Inputs):
    images = i.images()
    removed = dedupe.exact_decisions(images)
    renames = dedupe.rename_plan(dedupe.renumber(dedupe.exact_survivors(images)))
    manifest = images.select(F.col("path").alias("export_image"), X.with_suffix(F.col("path"), ".txt").alias("export_label"), "image_id")
    return dedupe.update_manifest(manifest, removed, renames)


@query("dedupe_report", compose(["images"], """
select 'removed_total' as key, count(*) as value from one union all
select 'removed_exact_duplicates', count(*) from one where reason like 'exact_duplicate%' union all
select 'removed_near_duplicates', count(*) from one where reason like 'near_duplicate%' union all
select 'renamed_files', count(*) from renamed where path <> new_path union all
select 'unreadable_images', count(*) from images where height <= 300""",
    {"exact": DECISIONS_SQL, '"both"': TWO_ROUNDS_SQL["both"], "one": ONE_SQL.replace("both", '"both"'),
     "survivors": SURVIVORS_SQL, "renamed": RENUMBER_SQL.format("survivors")}))
def dedupe_report(i: Inputs):
    images = i.images()
    renames = dedupe.rename_plan(dedupe.renumber(dedupe.exact_survivors(images)))
    return dedupe.report(dedupe.one_per_removed(_two_rounds(i)), renames, images.where(F.col("height") <= 300))


# ---- pixels of bitmaps in a table ------------------------------------------

BMP_HEAD = "424df6000000000000003600000028000000" + "08000000" + "08000000" + "01001800" + "00000000" + "c0000000" + "00" * 16
GREY_SQL = "select vec_id as image_id, list_transform(embedding, lambda e: greatest(0, least(255, floor(128 + 500 * e::double)))::int) as v from embeddings"


def _bitmaps(i: Inputs):
    """(image_id, content): each vector as a grey bitmap of 8 x 8 points with 24 bits."""
    grey = F.transform("embedding", lambda e: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(128 + 500 * e.cast("double")))))
    points = F.transform(grey, lambda v: F.repeat(F.lpad(F.hex(v.cast("long")), 2, "0"), F.lit(3)))
    rows = F.transform(F.sequence(F.lit(7), F.lit(0), F.lit(-1)), lambda y: F.array_join(F.slice(points, y * 8 + 1, 8), ""))  # from the bottom
    return i.table("embeddings").select(
        F.col("vec_id").alias("image_id"), F.unhex(F.concat(F.lit(BMP_HEAD), F.array_join(rows, ""))).alias("content"))


def _seen(i: Inputs):
    return _bitmaps(i).select("image_id", bitmaps.image("content").alias("image"))


@query("pixel_signature", compose([], """
select image_id, 8 as width, 8 as height, sha1('8x8'::blob || unhex(array_to_string(list_transform(v, lambda x: repeat(printf('%02x', x), 3)), ''))) as signature
from grey""", {"grey": GREY_SQL}))
def pixel_signature(i: Inputs):
    image = F.col("image")
    return _seen(i).select("image_id", image["width"].alias("width"), image["height"].alias("height"), pixels.signature(image).alias("signature"))


@query("average_hash", compose([], """
select image_id, array_to_string([printf('%x', b[4 * i + 1] * 8 + b[4 * i + 2] * 4 + b[4 * i + 3] * 2 + b[4 * i + 4]) for i in range(0, 16)], '') as ahash
from (select image_id, list_transform(v, lambda x: case when 64 * x >= list_sum(v) then 1 else 0 end) as b from grey)""", {"grey": GREY_SQL}))
def average_hash(i: Inputs):
    return _seen(i).select("image_id", pixels.statistics(F.col("image"))["ahash"].alias("ahash"))


@query("pixel_features", compose([], """
select image_id, len(list_filter(v, lambda x: x > 225)) / 64.0::double as white, len(list_filter(v, lambda x: x < 15)) / 64.0::double as dark,
  round(sqrt(list_sum(list_transform(v, lambda x: (x - list_sum(v) / 64.0::double) ** 2)) * 16 / 1023), 6) as red_std from grey""", {"grey": GREY_SQL}))
def pixel_features(i: Inputs):
    f = pixels.statistics(F.col("image"))
    return _seen(i).select("image_id", f.alias("f")).select("image_id", "f.white", "f.dark", F.round("f.red_std", 6).alias("red_std"))


# ---- near duplicates -------------------------------------------------------

MASKS = (1, 8, 32)
UNIT_SQL = """select vec_id, folder, pixels, width, list_transform(vector, lambda x: x / norm) as vector
  from (select *, sqrt(list_sum(list_transform(vector, lambda x: x * x))) as norm from vectors)"""
NEAR_PAIRS_SQL = """select a.folder, a.vec_id as a, b.vec_id as b, list_inner_product(a.vector, b.vector) as sim
  from unit a join unit b on a.folder = b.folder and a.vec_id < b.vec_id
  where list_inner_product(a.vector, b.vector) >= 0.995"""


def _vectors(i: Inputs):
    return i.vectors().withColumn("vector", neardup.unit(F.col("vector")))


@query("near_dup_pairs", compose(["vectors"], "select folder, a, b, round(sim, 6) as sim from near", {
    "every": UNIT_SQL, "unit": "select folder, vector, min(vec_id) as vec_id from every group by folder, vector", "near": NEAR_PAIRS_SQL}))
def near_dup_pairs(i: Inputs):
    """Pairs of different vectors; rows with equal vectors are stood for by the smallest id."""
    reps = cut(neardup.distinct_vectors(_vectors(i)))
    return neardup.similar_pairs(reps).select("folder", "a", "b", F.round("sim", 6).alias("sim"))


# The greedy walk of a folder: one position per step, with the list of removed rows as state.
NEAR_SQL = {
    "unit": UNIT_SQL, "near": NEAR_PAIRS_SQL,
    "quality": "select folder, vec_id, {'p': pixels, 'w': width, 'v': vec_id} as q from vectors",
    "bases": "select folder, a, row_number() over (partition by folder order by a) as step from (select distinct folder, a from near)",
    "sizes": "select folder, count(*) as steps from bases group by folder",
    "neighbours": """select n.folder, n.a, list({'id': n.b, 'q': q.q}) as others from near n
      join quality q on q.folder = n.folder and q.vec_id = n.b group by n.folder, n.a""",
    "base_rows": """select b.folder, b.step, b.a, n.others, q.q as qa from bases b
      join neighbours n on n.folder = b.folder and n.a = b.a join quality q on q.folder = b.folder and q.vec_id = b.a""",
    "walk": """
      select folder, 0::bigint as step, []::bigint[] as gone, []::struct(r bigint, k bigint)[] as pairs from sizes
      union all
      select folder, step, list_concat(gone, list_transform(fresh, lambda x: x.r)), list_concat(pairs, fresh)
      from (select folder, step, gone, pairs,
          list_transform(list_filter(members, lambda m: m.id <> keep), lambda m: {'r': m.id, 'k': keep}) as fresh
        from (select folder, step, gone, pairs, members,
            list_reverse_sort(list_transform(members, lambda m: {'q': m.q, 'id': m.id}))[1].id as keep
          from (select w.folder, b.step, w.gone, w.pairs,
              case when list_contains(w.gone, b.a) then [] else
                list_concat([{'id': b.a, 'q': b.qa}], list_filter(b.others, lambda o: not list_contains(w.gone, o.id))) end as members
            from walk w join base_rows b on b.folder = w.folder and b.step = w.step + 1)))""",
    "final": "select w.folder, unnest(w.pairs) as p from walk w join sizes s on s.folder = w.folder and s.steps = w.step",
}


@query("near_dup_decisions", compose(["vectors"], """
select f.folder, p.r as remove_id, p.k as keep_id, round(list_inner_product(x.vector, y.vector), 6) as score
from final f join unit x on x.folder = f.folder and x.vec_id = p.r join unit y on y.folder = f.folder and y.vec_id = p.k""",
    NEAR_SQL, recursive=True))
def near_dup_decisions(i: Inputs):
    rows = _vectors(i).select("folder", "vec_id", "vector", F.struct(
        F.col("pixels").alias("p"), F.col("width").alias("w"), F.col("vec_id").alias("v")).alias("quality"))
    return neardup.near_decisions(rows, masks=MASKS).select("folder", "remove_id", "keep_id", F.round("score", 6).alias("score"))


# ---- splits ----------------------------------------------------------------

RANKED_SQL = """select *, row_number() over (partition by folder order by md5('42|' || path)) as r,
  count(*) over (partition by folder) as n from images"""


@query("split_plan", compose(["images"], """
select image_id, case when n <= 2 then (case when r = 1 then 'train' else 'val' end)
  when r <= t then 'train' when r <= t + v then 'val' else 'test' end as split
from (select image_id, r, n, case when t + v >= n and t > v then t - 1 else t end as t, case when t + v >= n and t <= v then v - 1 else v end as v
  from (select image_id, r, n, t, case when t + v >= n then greatest(1, n - t) else v end as v
    from (select *, greatest(1, floor(n * 0.8::double)) as t, greatest(1, floor(n * 0.1::double)) as v from ranked)))""",
    {"ranked": RANKED_SQL}))
def split_plan(i: Inputs):
    return splits.plan(i.images(), "folder", "path").select("image_id", "split")


@query("split_cut", compose(["images"], """
select image_id, case when n <= 2 then (case when r = 1 then 'train' else 'val' end)
  when r <= t then 'train' when r <= least(n, t + v) then 'val' else 'test' end as split
from (select image_id, r, n, t, case when t + v >= n then greatest(1, n - t) else v end as v
  from (select *, greatest(1, floor(n * 0.8::double)) as t, greatest(1, floor(n * 0.1::double)) as v from ranked))""",
    {"ranked": RANKED_SQL}))
def split_cut(i: Inputs):
    return splits.plan(i.images(), "folder", "path", rule=splits.cut_points).select("image_id", "split")


GROUP_SPLIT_SQL = {
    "primary_class": PRIMARY_SQL,
    "queue": "select *, row_number() over (partition by label order by size desc, md5('42|' || sha1)) as rn from primary_class",
    "totals": """select label, sum(size) * 0.8::double as t, sum(size) * 0.1::double as v, sum(size) * (1.0::double - 0.8::double - 0.1::double) as e,
      count(*) as steps from primary_class group by label""",
    "walk": """
      select label, 0::bigint as step, '' as sha1, '' as split, 0::bigint as ct, 0::bigint as cv, 0::bigint as ce from totals
      union all
      select label, step, sha1, pick, ct + case when pick = 'train' then size else 0 end,
        cv + case when pick = 'val' then size else 0 end, ce + case when pick = 'test' then size else 0 end
      from (select w.label, q.rn as step, q.sha1, q.size, w.ct, w.cv, w.ce,
          list_reverse_sort([{'d': t.t - w.ct, 'c': -w.ct, 'o': 3, 's': 'train'}, {'d': t.v - w.cv, 'c': -w.cv, 'o': 2, 's': 'val'},
            {'d': t.e - w.ce, 'c': -w.ce, 'o': 1, 's': 'test'}])[1].s as pick
        from walk w join totals t on t.label = w.label join queue q on q.label = w.label and q.rn = w.step + 1)""",
}


@query("group_split", compose(["images"], "select image_id, i.sha1, split from images i join walk w on i.sha1 = w.sha1",
                              GROUP_SPLIT_SQL, recursive=True))
def group_split(i: Inputs):
    idx = V.position(V.COLLECTION_CLASSES, F.col("label"))
    return splits.group_split(i.images(), idx).select("image_id", "sha1", "split")


# no test rows at all
FALLBACK_SQL = {"sets": """select folder, image_id, case when image_id % 4 = 0 then 'val' else 'train' end as split from images"""}


@query("split_fallback", compose(["images"], """
select image_id, split, split as used_as from sets union all
select image_id, split, 'val' from sets where split = 'train' and not exists (select 1 from sets where split = 'val') union all
select image_id, split, 'test' from sets where split = (case when exists (select 1 from sets where split = 'val') then 'val' else 'train' end)
  and not exists (select 1 from sets where split = 'test')""", FALLBACK_SQL))
def split_fallback(i: Inputs):
    sets = i.images().select("image_id", F.when(F.col("image_id") % 4 == 0, "val").otherwise("train").alias("split"))
    return splits.fill_empty_splits(sets)


# ---- the label stage on all scenes -----------------------------------------

def labelled_images(i: Inputs):
    """Images with suppressed boxes, quality and duplicate flags, routing, split."""
    images = i.scene_images().withColumn("expected_class", F.col("label"))
    boxes = D.suppress(i.detections())
    flagged = flags.quality_flags(images, boxes)
    both = flags.duplicate_flags(flagged).withColumn("flags", F.sort_array(F.array_union("flags", "dup_flags")))
    return flags.route(both)


LABELLED_MORE = {
    "described": f"""select i.*, coalesce(b.n, 0) as box_count, coalesce(b.labels, []) as labels, b.low, b.fb,
        coalesce(list_contains(b.labels, i.label), false) as found,
        count(*) over (partition by sha1) as copies, min(label) over (partition by sha1) <> max(label) over (partition by sha1) as crossed
      from scene_images i left join (select image_id, count(*) as n, list(distinct label) as labels, min(score) as low,
        max(case when source = 'expected_fallback' then 1 else 0 end) as fb from kept group by image_id) b using (image_id)""",
    "flagged": """select *, list_sort(list_filter([case when least(width, height) < 512 then 'small_image' end,
        case when box_count = 0 then 'empty_detection' end, case when not found then 'expected_missing' end,
        case when found and fb = 1 then 'fallback_used' end, case when box_count > 0 and not found then 'cross_class_only' end,
        case when low < 0.35 then 'low_confidence' end, case when box_count >= 8 then 'busy_scene' end,
        case when copies > 1 then 'exact_duplicate' end, case when copies > 1 and crossed then 'cross_class_duplicate' end],
        lambda f: f is not null)) as flags from described""",
    "routed": """select *, list_has_any(flags, ['empty_detection', 'expected_missing', 'cross_class_duplicate']) as critical from flagged""",
}


@query("route_review", nms_oracle(["detections", "scene_images"], "detections", """
select image_id, array_to_string(flags, ';') as flags, critical::int as review_required,
  case when critical then 'review' else 'kept' end as routed from routed""", None, LABELLED_MORE))
def route_review(i: Inputs):
    return labelled_images(i).select("image_id", F.array_join("flags", ";").alias("flags"),
                                     F.col("review_required").cast("int").alias("review_required"), "routed")


@query("quality_flags", nms_oracle(["detections", "scenes"], "detections", """
select image_id, box_count, array_to_string(list_sort(list_filter([case when least(width, height) < 512 then 'small_image' end,
    case when box_count = 0 then 'empty_detection' end, case when not found then 'expected_missing' end,
    case when found and fb = 1 then 'fallback_used' end, case when box_count > 0 and not found then 'cross_class_only' end,
    case when low < 0.35 then 'low_confidence' end, case when box_count >= 8 then 'busy_scene' end], lambda f: f is not null)), ';') as flags
from (select s.*, coalesce(b.n, 0) as box_count, coalesce(list_contains(b.labels, s.expected_class), false) as found, b.low, b.fb
  from scenes s left join (select image_id, count(*) as n, list(distinct label) as labels, min(score) as low,
    max(case when source = 'expected_fallback' then 1 else 0 end) as fb from kept group by image_id) b using (image_id))"""))
def quality_flags(i: Inputs):
    flagged = flags.quality_flags(i.scenes(), D.suppress(i.detections()))
    return flagged.select("image_id", "box_count", F.array_join("flags", ";").alias("flags"))


REVIEW_FLAGS_SQL = """select s.*, coalesce(b.n, 0) as box_count, coalesce(b.labels, []) as labels,
  list_sort(list_filter(['manual_review_all', case when b.n is null then 'empty_detection' end,
    case when b.n is null or not list_contains(b.labels, s.expected_class) then 'source_class_missing' end,
    case when b.n is not null and not list_contains(b.labels, s.expected_class) then 'cross_class_only' end,
    case when b.low < 0.35 then 'low_confidence' end, case when b.n >= 8 then 'busy_scene' end], lambda f: f is not null)) as flags
from {images} s left join (select image_id, count(*) as n, list(distinct label) as labels, min(score) as low
  from {boxes} group by image_id) b using (image_id)"""


@query("review_flags", compose(["detections", "scenes"], "select image_id, box_count, array_to_string(flags, ';') as flags from ("
                               + REVIEW_FLAGS_SQL.format(images="scenes", boxes="detections") + ")"))
def review_flags(i: Inputs):
    flagged = flags.review_flags(i.scenes(), i.detections())
    return flagged.select("image_id", "box_count", F.array_join("flags", ";").alias("flags"))


@query("flag_counts", compose(["detections", "scenes"], "select flag, count(*) as n from (select unnest(flags) as flag from ("
                              + REVIEW_FLAGS_SQL.format(images="scenes", boxes="detections") + ")) group by flag"))
def flag_counts(i: Inputs):
    return stats.flag_counts(flags.review_flags(i.scenes(), i.detections()))


@query("class_counts", nms_oracle(["detections", "scene_images", "classes"], "detections", """
select class_id, c.label, count(image_id) as source, count(case when not critical then 1 end) as kept,
  count(case when critical then 1 end) as review
from classes c left join routed r on r.label = c.label group by class_id, c.label""", None, LABELLED_MORE))
def class_counts(i: Inputs):
    return stats.class_counts(labelled_images(i), V.classes(i.spark, V.REVIEW_CLASSES))


@query("split_manifest", nms_oracle(["detections", "scene_images"], "detections", f"""
select path as source_image, r.label as expected_class, coalesce(w.split, 'review') as split, critical::int as review_required,
  array_to_string(flags, ';') as flags, box_count, sha1, substr(sha1, 1, 16) as ahash,
  array_to_string(list_transform(list_sort(list_transform(labels, lambda n: {{'i': list_position({COLLECTION_LIST}, n), 'n': n}})), lambda s: s.n), ';') as detected_labels
from (select * from routed) r left join (select sha1, split from walk where step > 0) w using (sha1)""",
    None, LABELLED_MORE | {"chosen": "select * from routed where not critical"}
    | {k: v.replace("from images group by", "from chosen group by") for k, v in GROUP_SPLIT_SQL.items()}).replace(
        "left join (select sha1, split from walk where step > 0) w using (sha1)",
        "left join (select sha1, split from walk where step > 0) w on w.sha1 = r.sha1 and not r.critical").replace(
        "box_count, sha1, substr(sha1, 1, 16) as ahash", "box_count, r.sha1, substr(r.sha1, 1, 16) as ahash"))
def split_manifest(i: Inputs):
    """The routed table is written once: the split plan and the manifest both read it."""
    routed = cut(labelled_images(i).withColumn("ahash", F.substring("sha1", 1, 16)))
    idx = V.position(V.COLLECTION_CLASSES, F.col("label"))
    kept = splits.group_split(routed.where(F.col("routed") == "kept"), idx)
    review = routed.where(F.col("routed") == "review").withColumn("split", F.lit(None).cast("string"))
    return manifests.split_manifest(kept.unionByName(review))


@query("review_manifest", nms_oracle(["detections", "scene_images"], "detections", """
select label || '/' || stem || '.jpg' as export_image, label || '/' || stem || '.txt' as export_label, path as source_image,
  label as source_class, width, height, box_count, array_to_string(list_sort(labels), ';') as detected_labels,
  array_to_string(flags, ';') as flags, sha1, """ + ", ".join(
    f"list_contains(labels, '{n}')::int as pred_{n}, '' as human_check_{n}" for n in V.REVIEW_CLASSES) + """
from (select *, label || '__' || image_id || '__' || substr(sha1, 1, 12) as stem from flagged)""", None, {
    "expected": "select *, label as expected_class from scene_images",
    "flagged": REVIEW_FLAGS_SQL.format(images="expected", boxes="kept")}))
def review_manifest(i: Inputs):
    images = i.scene_images().withColumn("expected_class", F.col("label"))
    boxes = D.suppress(i.detections())
    return manifests.review_manifest(flags.review_flags(images, boxes))


@query("cache_pending", compose(["images"], """
select image_id, case when image_id % 3 <> 0 and image_id % 7 <> 0 then 'cached' else 'pending' end as state from images"""))
def cache_pending(i: Inputs):
    """The cache lacks every third image and holds an outdated hash for every seventh."""
    d = F.col("image_id")
    images = i.images().select("image_id", "sha1", F.col("label").alias("source_class"),
                               X.export_stem(F.col("label"), F.col("path"), F.col("sha1")).alias("export_stem"))
    cache = images.where(d % 3 != 0).withColumn("sha1", F.when(d % 7 == 0, F.reverse("sha1")).otherwise(F.col("sha1")))
    cached, pending = manifests.split_cache(images, cache.drop("image_id"))
    return cached.select("image_id", F.lit("cached").alias("state")).unionByName(
        pending.select("image_id", F.lit("pending").alias("state")))


@query("needs_fallback", compose(["detections", "scenes"], """
select 'any' as rule, image_id, expected_class from scenes s where not exists
  (select 1 from detections d where d.image_id = s.image_id and d.label = s.expected_class)
union all
select 'confident', image_id, expected_class from scenes s where not exists
  (select 1 from detections d where d.image_id = s.image_id and d.label = s.expected_class and d.score >= 0.35)"""))
def needs_fallback(i: Inputs):
    from boxloom.operators.scoring import missing_expected

    scenes = i.scenes().select("image_id", "expected_class")
    any_ = missing_expected(scenes, i.detections()).withColumn("rule", F.lit("any"))
    sure = missing_expected(scenes, i.detections(), V.LOW_SCORE).withColumn("rule", F.lit("confident"))
    return any_.unionByName(sure)


@query("audit_missing_all", compose(["detections", "scenes", "classes"], """
select image_id, c.label from scenes, classes c where not exists
  (select 1 from detections d where d.image_id = scenes.image_id and d.label = c.label)"""))
def audit_missing_all(i: Inputs):
    from boxloom.operators.scoring import missing_classes

    return missing_classes(i.scenes(), i.detections(), V.REVIEW_CLASSES)


@query("review_queue", compose(["detections", "scenes", "mapped_boxes"], """
select mode, image_id from (select image_id, unnest(list_filter(['all', case when opened then 'unreviewed_all' end,
    case when opened and size > 0 then 'high_risk' end, case when opened and overlap then 'duplicate_boxes' end,
    case when opened and size > 0 then 'pending_risk' end], lambda m: m is not null)) as mode
  from (select f.image_id, image_id % 3 <> 0 as opened, len(list_filter(flags, lambda x: x <> 'manual_review_all')) + overlap::int as size, overlap
    from (select f.*, f.image_id in (select image_id from same_class) as overlap from flagged f) f))""",
    {"flagged": REVIEW_FLAGS_SQL.format(images="scenes", boxes="detections"), "same_class": SAME_CLASS_BODY}))
def review_queue(i: Inputs):
    """Flags that say more than "review all", plus overlaps found on the boxes; every third image is reviewed."""
    scenes = i.scenes()
    flagged = flags.review_flags(scenes, i.detections()).withColumn("flags", F.array_remove("flags", "manual_review_all"))
    local = D.same_class_overlaps(i.boxes()).withColumn("flags", F.array(F.lit("same_class_overlap")))
    return flags.review_queue(scenes, flags.known_flags(flagged, local), scenes.where(F.col("image_id") % 3 == 0))


@query("coverage", compose(["scenes", "classes"], """
select class_id, label, images, case when images >= 750 then 'OK' when images >= 450 then '..' else '!!' end as status,
  rpad(repeat('#', floor(least(images, 750) * 30 / 750)::int), 30, '-') as bar, images < 525 as short
from (select class_id, label, count(image_id) as images from classes left join scenes on expected_class = label group by class_id, label)"""))
def coverage(i: Inputs):
    counted = i.scenes().withColumn("label", F.col("expected_class"))
    return stats.coverage(counted, V.classes(i.spark, V.REVIEW_CLASSES), 750)
