"""Queries on label files, per-image statistics, train lists and the merged training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.cluster import cut
from boxloom.functions import text as X
from boxloom.operators import dedupe
from boxloom.operators import detections as D
from boxloom.operators import manifests as M
from boxloom.operators import stats
from boxloom.plans.box_queries import COMPONENTS_SQL
from boxloom.plans.catalog import query
from boxloom.plans.inputs import Inputs
from boxloom.plans.oracle_inputs import compose
from boxloom.sources import descriptors
from boxloom.sources import labels as L

NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
READABLE = f"len(list_filter(f[1:5], lambda x: not regexp_matches(x, '{NUMERIC}'))) = 0"
LARGE = 0.2  # the derived boxes cover a quarter of the picture at most


@query("parse_labels_strict", compose(["fields", "class_map"], f"""
select image_id, line_no, 'box' as outcome, source_class, target_class, xc, yc, w, h from parsed where source_class is not null and ok
union all
select image_id, line_no, case when ok then 'unknown_class' else 'unreadable_number' end, '', '', -1.0, -1.0, -1.0, -1.0
from parsed where source_class is null or not ok""", {"parsed": f"""
  select image_id, line_no, {READABLE} as ok, m.source_class, m.target_class, try_cast(f[2] as double) as xc,
    try_cast(f[3] as double) as yc, try_cast(f[4] as double) as w, try_cast(f[5] as double) as h
  from fields left join class_map m on m.class_id = trunc(try_cast(f[1] as double))::int where len(f) = 5"""}))
def parse_labels_strict(i: Inputs):
    rows = L.parsed_strict(i.label_files(), V.class_map(i.spark))
    good = F.col("reason").isNull()
    names = [F.when(good, F.col(c)).otherwise("").alias(c) for c in ("source_class", "target_class")]
    numbers = [F.when(good, F.col(c)).otherwise(-1.0).alias(c) for c in ("xc", "yc", "w", "h")]
    return rows.select("image_id", F.col("line_no").cast("long").alias("line_no"),
                       F.coalesce("reason", F.lit("box")).alias("outcome"), *names, *numbers)


@query("parse_labels_tolerant", compose(["fields"], f"""
select image_id, line_no, valid, case when valid then trunc(try_cast(f[1] as double))::int else -1 end as class_id,
  case when valid then greatest(0.0, least(1.0, try_cast(f[2] as double))) else -1.0 end as xc,
  case when valid then greatest(0.0, least(1.0, try_cast(f[3] as double))) else -1.0 end as yc
from (select *, len(f) = 5 and {READABLE} as valid from fields where line <> '')"""))
def parse_labels_tolerant(i: Inputs):
    parsed = L.parse_tolerant(i.label_files())
    return parsed.select("image_id", F.col("line_no").cast("long").alias("line_no"), "valid",
                         F.coalesce("class_id", F.lit(-1)).alias("class_id"),
                         F.coalesce("xc", F.lit(-1.0)).alias("xc"), F.coalesce("yc", F.lit(-1.0)).alias("yc"))


def _label_paths(i: Inputs):
    """Label files by name, and images that lack every seventh file and have odd suffixes or two versions."""
    key = F.col("image_id")
    files = i.label_files().withColumn("path", F.concat(F.lit("d"), (key % 7).cast("string"), F.lit("/"), key.cast("string"), F.lit(".txt")))
    endings = F.when(key % 7 == 3, F.array().cast("array<string>")).when(key % 5 == 0, F.array(F.lit("png"))).when(
        key % 5 == 1, F.array(F.lit("webp"), F.lit("jpg"))).otherwise(F.array(F.lit("jpg")))
    images = files.select("image_id", F.explode(endings).alias("_e"), "path").select(
        "image_id", F.regexp_replace("path", "txt$", F.col("_e")).alias("path"))
    return files, images


PATHS_SQL = {
    "files": "select *, 'd' || image_id % 7 || '/' || image_id || '.txt' as path from label_files",
    "pictures": """select image_id, 'd' || image_id % 7 || '/' || image_id || '.' || unnest(case when image_id % 7 = 3 then [] when image_id % 5 = 0
      then ['png'] when image_id % 5 = 1 then ['webp', 'jpg'] else ['jpg'] end) as path from label_files""",
}


@query("label_image_match", compose(["label_files"], """
select f.path, coalesce(p.image_path, '') as image_path, p.image_path is not null as matched from files f
left join (select image_id, max(path) as image_path from pictures group by image_id) p using (image_id)""", PATHS_SQL))
def label_image_match(i: Inputs):
    matched, missing = L.match_images(*_label_paths(i))
    return matched.select("path", "image_path", F.lit(True).alias("matched")).unionByName(
        missing.select("path", F.lit("").alias("image_path"), F.lit(False).alias("matched")))


@query("resolve_image", compose(["label_files"], """
select f.path, coalesce(p.image_path, '') as image_path from files f left join (
  select image_id, min({'o': path not like '%.jpg', 'p': path}).p as image_path from pictures group by image_id) p using (image_id)""", PATHS_SQL))
def resolve_image(i: Inputs):
    return L.resolve_images(*_label_paths(i)).select("path", F.coalesce("image_path", F.lit("")).alias("image_path"))


@query("mirrored_files", compose(["label_files"], """
select i.path, l.path as label_path, coalesce(e.extra_paths, '') as extra_paths
from pictures i left join files l on l.image_id = i.image_id and l.image_id % 4 <> 1
left join (select image_id, string_agg(path, ';' order by path) as extra_paths from files_extra group by image_id) e on e.image_id = i.image_id""", PATHS_SQL | {
    "files_extra": "select image_id, 'd' || image_id % 7 || '/' || image_id || '.' || unnest(['json', 'xml']) as path from label_files where image_id % 3 = 0"}))
def mirrored_files(i: Inputs):
    """Each image with the label file and the other files of the same folder and stem."""
    files, images = _label_paths(i)
    extras = files.where(F.col("image_id") % 3 == 0).select(F.explode(F.array(*[
        F.regexp_replace("path", "txt$", e) for e in ("json", "xml")])).alias("path"))
    found = dedupe.attach_mirrors(images.select("path"), files.where(F.col("image_id") % 4 != 1).select("path"), extras)
    return found.select("path", "label_path", F.array_join("extra_paths", ";").alias("extra_paths"))


@query("label_match_stats", compose(["label_files", "fields"], f"""
select count(distinct p.image_id) as total_images, (select count(*) from files) as total_label_files,
  (select count(*) from hit) as matched_images, (select count(*) from hit where valid = 0) as empty_label_files,
  (select count(*) from files) - (select count(*) from hit) as missing_images, (select sum(invalid)::bigint from hit) as invalid_label_lines
from pictures p""", PATHS_SQL | {
    "per_file": f"""select image_id, count(case when ok then 1 end) as valid, count(case when not ok then 1 end) as invalid from (
        select image_id, line, len(f) = 5 and {READABLE} as ok from fields where line <> '') group by image_id""",
    "hit": """select f.image_id, coalesce(valid, 0) as valid, coalesce(invalid, 0) as invalid from files f left join per_file using (image_id)
        where f.image_id in (select image_id from pictures)"""}))
def label_match_stats(i: Inputs):
    files, images = _label_paths(i)
    matched, missing = L.match_images(files, images)
    return stats.label_match_stats(matched, missing, L.parse_tolerant(matched), images)


DEFAULT_NAMES = ["first", "second"]
_QUOTES = "'''\"'"  # both kinds of quotation marks, as an SQL string
NAMES_SQL = {
    "written": """select 'd' || d || '.yaml' as file, k as line_no, case when k = 0 then 'train: images/' || p_type when k = 1 then '0: early'
        when k = 2 then '' when k = 3 then case when d % 4 = 3 then 'labels:' else 'names:' end when k = 4 then '  # ' || p_name
        when k = 12 then case when d % 3 = 0 then 'names:' else '  note' end
        when k = 16 then case when d % 5 < 3 then 'val: ' || p_name else '  7 : ''' || p_brand || '''' end
        when k = 17 then '  3: ' || p_name when k = 18 then '- ' || p_brand when d % 4 = 0 then '  ' || (k * 2 - 9) || ': "' || p_name || '"'
        when d % 4 = 1 then '  - ''' || p_name || '''' when d % 4 = 2 then chr(9) || '''' || p_partkey % 7 || ''' : ' || p_brand
        else '  ' || p_partkey % 5 || ': ' || p_brand end as value
      from (select *, p_partkey // 24 as d, (p_partkey % 24)::int as k from part)""",
    "parts": """select file, line_no, s, value like ' %' or value like chr(9) || '%' as inside, contains(s, ':') as colon,
        trim(split_part(s, ':', 1)) as l, case when contains(s, ':') then trim(substr(s, strpos(s, ':') + 1)) else '' end as r
      from (select *, trim(value, ' ' || chr(9)) as s from written)""",
    "begun": """select * from (select *, min(case when s = 'names:' then line_no end) over (partition by file) as lo from parts
      where s <> '' and s not like '#%') where line_no > lo and s <> 'names:'""",
    "kinds": f"select *, colon and regexp_full_match(trim(l, {_QUOTES}), '[0-9]+') as mapped from begun",
    "loose": """select * from (select *, min(case when not mapped and s not like '- %' and not inside then line_no end) over (partition by file) as hi
      from kinds) where hi is null or line_no < hi""",
    "ids": f"select file, trim(l, {_QUOTES})::int as class_id, arg_max(trim(r, {_QUOTES}), line_no) as label from loose where mapped group by all",
    "tight": f"""select * from (select *, min(case when not inside then line_no end) over (partition by file) as hi from begun)
      where (hi is null or line_no < hi) and colon and regexp_full_match(l, '[0-9]+') and trim(r, {_QUOTES}) <> ''""",
    "ordered": f"select file, l::int as class_id, arg_max(trim(r, {_QUOTES}), line_no) as label from tight group by all",
}


@query("class_dictionaries", compose([], f"""
select 'tolerant' as reader, e.file, e.class_id, coalesce(i.label, 'class_' || e.class_id) as label
from (select file, unnest(range(0, max(class_id) + 1))::int as class_id from ids group by file) e left join ids i using (file, class_id) union all
select 'tolerant', file, (row_number() over (partition by file order by line_no) - 1)::int, trim(trim(substr(s, 3)), {_QUOTES}) from loose
where not mapped and s like '- %' and file not in (select file from ids) union all
select 'scoped', file, (row_number() over (partition by file order by class_id) - 1)::int, label from ordered union all
select 'scoped', file, k::int, ({DEFAULT_NAMES})[k + 1] from (select distinct file from written where file not in (select file from ordered)), range(0, 2) t(k)
union all select 'strict', file, l::int, arg_max(r, line_no) from parts where colon and regexp_full_match(l, '[0-9]+') group by file, l::int""", NAMES_SQL))
def class_dictionaries(i: Inputs):
    """Descriptors of 24 lines, written from the parts, through the three readers of class names."""
    lines = _descriptor_lines(i)
    read = {"tolerant": descriptors.tolerant(lines), "scoped": descriptors.scoped(lines, DEFAULT_NAMES), "strict": descriptors.strict(lines)}
    named = [df.select(F.lit(n).alias("reader"), "file", "class_id", "label") for n, df in read.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _descriptor_lines(i: Inputs):
    k, d, name, brand = F.col("p_partkey") % 24, F.floor(F.col("p_partkey") / 24), F.col("p_name"), F.col("p_brand")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    other = (
        F.when(d % 4 == 0, text("  ", k * 2 - 9, ': "', name, '"')).when(d % 4 == 1, text("  - '", name, "'"))
        .when(d % 4 == 2, text("\t'", F.col("p_partkey") % 7, "' : ", brand)).otherwise(text("  ", F.col("p_partkey") % 5, ": ", brand)))
    value = (
        F.when(k == 0, text("train: images/", F.col("p_type"))).when(k == 1, "0: early").when(k == 2, "")
        .when(k == 3, F.when(d % 4 == 3, "labels:").otherwise("names:")).when(k == 4, text("  # ", name))
        .when(k == 12, F.when(d % 3 == 0, "names:").otherwise("  note"))
        .when(k == 16, F.when(d % 5 < 3, text("val: ", name)).otherwise(text("  7 : '", brand, "'")))
        .when(k == 17, text("  3: ", name)).when(k == 18, text("- ", brand)).otherwise(other))
    return i.table("part").select(text("d", d, ".yaml").alias("file"), k.cast("int").alias("line_no"), value.alias("value"))


@query("label_presence", compose(["detections", "classes"], """
select class_id, c.label, count(distinct image_id) as images, count(image_id) as instances
from classes c left join detections d on d.label = c.label group by class_id, c.label"""))
def label_presence(i: Inputs):
    return stats.label_presence(i.detections(), V.classes(i.spark, V.REVIEW_CLASSES))


# ---- statistics and lists --------------------------------------------------

STATS_SQL = {
    "stats": f"""select s.image_id, count(b.line_no) as box_count, count(distinct class_id) as distinct_class_count,
      count(case when w * h >= {LARGE} then 1 end) as large_box_count,
      list_sort(list(distinct class_id) filter (where class_id is not null)) as class_ids
      from scenes s left join boxes b using (image_id) group by s.image_id""",
    "limits": """select ceil(quantile_cont(box_count, 0.95))::bigint as box_count_gt, ceil(quantile_cont(distinct_class_count, 0.95))::bigint as distinct_classes_gt,
      greatest(2, ceil(quantile_cont(large_box_count, 0.99)))::bigint as large_boxes_gt from stats""",
    "judged": """select s.*, box_count > box_count_gt as r1, distinct_class_count > distinct_classes_gt as r2, large_box_count > large_boxes_gt as r3,
      box_count_gt, distinct_classes_gt, large_boxes_gt from stats s, limits""",
    "present": """select c.class_id, c.label, count(b.image_id) as images from classes c left join (select distinct image_id, class_id from boxes) b
      using (class_id) group by c.class_id, c.label""",
    "cuts": "select quantile_cont(images, 0.25) as q25, quantile_cont(images, 0.40) as q40, quantile_cont(images, 0.50) as median from present",
    "tiers": """select p.*, q25, q40, median, case when images <= q25 then 'severe' when images <= q40 then 'moderate' else 'common' end as tier
      from present p, cuts""",
    "factored": """select s.image_id, coalesce(max(case tier when 'severe' then 3 when 'moderate' then 2 else 1 end), 1)::int as repeat_factor
      from scenes s left join boxes b using (image_id) left join tiers using (class_id) group by s.image_id""",
}
STATS_NEEDS = ["boxes", "scenes", "classes"]


def _stats(i: Inputs):
    return M.image_stats(i.scenes(), i.boxes(), LARGE)


def _classes(i: Inputs):
    return V.classes(i.spark, V.REVIEW_CLASSES)


@query("image_stats", compose(STATS_NEEDS, """
select image_id, box_count, distinct_class_count, large_box_count, coalesce(array_to_string(class_ids, ';'), '') as class_ids from stats""", STATS_SQL))
def image_stats(i: Inputs):
    ids = F.array_join(F.col("class_ids").cast("array<string>"), ";").alias("class_ids")
    return _stats(i).select("image_id", "box_count", "distinct_class_count", "large_box_count", ids)


@query("thresholds", compose(STATS_NEEDS, "select * from limits", STATS_SQL))
def thresholds(i: Inputs):
    return M.thresholds(_stats(i))


@query("noisy_images", compose(STATS_NEEDS, """
select image_id, box_count, distinct_class_count, large_box_count, array_to_string(list_transform(class_ids, lambda c: (select list(label order by class_id) from classes)[c + 1]), ';') as class_names
from judged where r1 or r2 or r3""".replace("(select list(label order by class_id) from classes)", "["
    + ", ".join(f"'{n}'" for n in V.REVIEW_CLASSES) + "]"), STATS_SQL))
def noisy_images(i: Inputs):
    s = _stats(i)
    noisy = M.with_noise(s, M.thresholds(s)).where("noisy")
    names = F.array_join(F.transform("class_ids", lambda c: V.pick(V.REVIEW_CLASSES, c)), ";")
    return noisy.select("image_id", "box_count", "distinct_class_count", "large_box_count", names.alias("class_names"))


@query("removal_reasons", compose(STATS_NEEDS, """
select 'box_count_gt_' || box_count_gt as reason, count(*) as n from judged where r1 group by 1 union all
select 'distinct_classes_gt_' || distinct_classes_gt, count(*) from judged where r2 group by 1 union all
select 'large_boxes_gt_' || large_boxes_gt, count(*) from judged where r3 group by 1""", STATS_SQL))
def removal_reasons(i: Inputs):
    s = _stats(i)
    return M.removal_reasons(M.with_noise(s, M.thresholds(s)))


@query("rarity_tiers", compose(STATS_NEEDS, "select * from tiers", STATS_SQL))
def rarity_tiers(i: Inputs):
    return M.rarity(M.presence(_stats(i), _classes(i)))


@query("balanced_manifest", compose(STATS_NEEDS, "select image_id, unnest(range(1, repeat_factor + 1))::int as copy from factored", STATS_SQL))
def balanced_manifest(i: Inputs):
    s = _stats(i)
    return M.train_list(M.repeat_factors(s, M.rarity(M.presence(s, _classes(i)))))


@query("effective_presence", compose(STATS_NEEDS, """
select c.class_id, c.label, count(b.image_id) as images, coalesce(sum(repeat_factor), 0)::bigint as lines
from classes c left join (select distinct image_id, class_id from boxes) b using (class_id) left join factored using (image_id)
group by c.class_id, c.label""", STATS_SQL))
def effective_presence(i: Inputs):
    s = _stats(i)
    return M.effective_presence(M.repeat_factors(s, M.rarity(M.presence(s, _classes(i)))), _classes(i))


@query("repeat_histogram", compose(STATS_NEEDS, "select repeat_factor, count(*) as images from factored group by 1", STATS_SQL))
def repeat_histogram(i: Inputs):
    s = _stats(i)
    return M.repeat_histogram(M.repeat_factors(s, M.rarity(M.presence(s, _classes(i)))))


@query("presence_by_noise", compose(STATS_NEEDS, """
select c.class_id, c.label, count(case when not (r1 or r2 or r3) then 1 end) as clean, count(case when r1 or r2 or r3 then 1 end) as removed
from classes c left join (select distinct image_id, class_id from boxes) b using (class_id) left join judged using (image_id) group by all""", STATS_SQL))
def presence_by_noise(i: Inputs):
    s = _stats(i)
    return M.presence_by_noise(M.with_noise(s, M.thresholds(s)), _classes(i))


# ---- the merged training set -----------------------------------------------

STATUS_SQL = COMPONENTS_SQL | {
    "pictures": """select image_id, expected_class || '/' || image_id || '.jpg' as path, expected_class as source_folder from scenes""",
    "ranked": """select *, row_number() over (partition by source_folder order by md5('42|' || path)) as r,
      count(*) over (partition by source_folder) as n from pictures""",
    "shares": "select *, greatest(1, floor(n * 0.8::double)) as t, greatest(1, floor(n * 0.1::double)) as v0 from ranked",
    "shares2": "select *, case when t + v0 >= n then greatest(1, n - t) else v0 end as v from shares",
    "planned": """select *, case when n <= 2 then (case when r = 1 then 'train' else 'val' end)
      when r <= (case when t + v >= n and t > v then t - 1 else t end) then 'train'
      when r <= (case when t + v >= n then t + v - 1 else t + v end) then 'val' else 'test' end as split from shares2""",
    "clashes": "select * from pairs where iou >= 0.98 and a_target <> b_target",
    "status": """select p.image_id, path, source_folder, case when p.image_id in (select image_id from clashes) then 'review_conflicts' else split end as status,
      coalesce(c.n_all, 0)::bigint as source_box_count, coalesce(c.n_kept, 0) as export_box_count
      from planned p left join (select image_id, sum(merged_from) as n_all, count(*) as n_kept from merged group by image_id) c using (image_id)""",
}
STATUS_NEEDS = ["mapped_boxes", "scenes"]


def _scenes(i: Inputs):
    return i.scenes().select("image_id", F.concat_ws("/", "expected_class", F.concat(F.col("image_id").cast("string"), F.lit(".jpg"))).alias("path"),
                             F.col("expected_class").alias("source_folder"))


@query("conflict_free_split", compose(STATUS_NEEDS, "select * from status", STATUS_SQL, recursive=True))
def conflict_free_split(i: Inputs):
    return M.training_status(_scenes(i), D.image_folds(i.mapped_boxes()))


@query("conflict_rows", compose(STATUS_NEEDS, """
select path as image, source_folder, a_line as box_a_index, a_source as box_a_source_class, a_target as box_a_target_class,
  b_line as box_b_index, b_source as box_b_source_class, b_target as box_b_target_class, round_even(iou, 6) as overlap_ratio
from clashes join pictures using (image_id)""", STATUS_SQL, recursive=True))
def conflict_rows(i: Inputs):
    return D.conflict_rows(D.conflicts(i.mapped_boxes()), _scenes(i))


@query("split_counts", compose(STATUS_NEEDS, """
select 'status' as section, status as key, count(*) as n from status group by status union all
select 'source_folder', source_folder, count(*) from status group by source_folder""", STATUS_SQL, recursive=True))
def split_counts(i: Inputs):
    return stats.counts_by(M.training_status(_scenes(i), D.image_folds(i.mapped_boxes())), "status", "source_folder")


@query("source_target_presence", compose(STATUS_NEEDS, """
select source_class || '->' || target_class as pair, count(distinct image_id) as images from mapped_boxes
where image_id in (select image_id from status where status <> 'review_conflicts') group by 1""", STATUS_SQL, recursive=True))
def source_target_presence(i: Inputs):
    """Only conflicts and class mappings are asked for, so neither merged boxes nor splits are worked out."""
    folds = cut(D.image_folds(i.mapped_boxes()).select("image_id", "clash_pairs", "mappings"))
    return M.source_target_presence(M.conflict_status(_scenes(i), folds), folds)


@query("dataset_summary", compose(STATUS_NEEDS, """
select 'total' as section, 'images' as key, count(*)::bigint as value from status union all
select 'total', 'review_conflict_images', count(*) from status where status = 'review_conflicts' union all
select 'total', 'review_conflict_pairs', count(*) from clashes union all
select 'total', 'merged_box_drop_count', sum(source_box_count - export_box_count)::bigint from status union all
select 'total', 'missing_label_count', count(*) from status where image_id not in (select image_id from mapped_boxes) union all
select 'review_folder', source_folder, count(*) from status where status = 'review_conflicts' group by source_folder union all
select 'split', status, count(*) from status where status <> 'review_conflicts' group by status union all
select 'target_instances', target_class, count(*) from merged where image_id in (select image_id from status where status <> 'review_conflicts') group by target_class""",
    STATUS_SQL, recursive=True))
def dataset_summary(i: Inputs):
    folds = cut(D.image_folds(i.mapped_boxes()))
    return M.training_summary(cut(M.training_status(_scenes(i), folds)), folds)


@query("label_text", compose(["mapped_boxes"], """
select image_id, part, string_agg(target_id || ' ' || printf('%.6f', xc) || ' ' || printf('%.6f', yc) || ' ' || printf('%.6f', w) || ' ' || printf('%.6f', h),
  chr(10) order by target_id, line_no) || chr(10) as label_text
from (select *, (row_number() over (partition by image_id order by target_id, line_no) - 1) // 4096 as part from merged)
group by image_id, part""", COMPONENTS_SQL, recursive=True))
def label_text(i: Inputs):
    merged = cut(D.merge_overlaps(i.mapped_boxes()))
    return L.label_text(merged.select("image_id", "target_id", "line_no", L.box_line(F.col("target_id")).alias("line")), ["target_id", "line_no"])
