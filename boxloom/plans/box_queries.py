"""Queries on boxes: geometry, pairs, suppression, merging, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import boxes as B
from boxloom.operators import detections as D
from boxloom.operators import scoring
from boxloom.plans.catalog import query
from boxloom.plans.inputs import Inputs
from boxloom.plans.oracle_inputs import COLLECTION_LIST, MERGED_LIST, compose

IOU_SQL = """case when least(a.x2, b.x2) > greatest(a.x1, b.x1) and least(a.y2, b.y2) > greatest(a.y1, b.y1)
  then ((least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)))
     / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1)
        - (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)))
  else 0.0 end"""

PAIRS_SQL = f"""
select a.image_id, a.line_no as a_line, b.line_no as b_line, a.source_class as a_source, b.source_class as b_source,
  a.target_class as a_target, b.target_class as b_target, {IOU_SQL} as iou
from mapped_boxes a join mapped_boxes b on a.image_id = b.image_id and a.line_no < b.line_no"""

# greedy suppression of an ordered list, one box per step
def nms_sql(source: str) -> str:
    return f"""
select image_id, label, 1 as step, 1 as taken, boxes, [boxes[1]] as kept from
  (select image_id, label, list({{'score': score, 'pos': pos, 'source': source, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}
     order by -score, pos) as boxes from {source} group by image_id, label)
union all
select image_id, label, step + 1, 0, boxes,
  case when len(list_filter(kept, lambda k: {IOU_SQL.replace('a.', 'k.').replace('b.', 'boxes[step + 1].')} >= 0.5)) > 0
    then kept else list_append(kept, boxes[step + 1]) end
from suppression where step < len(boxes)"""


NMS_KEPT_SQL = """
select image_id, label, k.score as score, k.pos as pos, k.source as source, k.x1 as x1, k.y1 as y1, k.x2 as x2, k.y2 as y2
from (select image_id, label, unnest(kept) as k from suppression where step = len(boxes))"""


def nms_oracle(needs: list[str], source: str, final: str, more: dict | None = None, after: dict | None = None) -> str:
    steps = dict(more or {})
    steps["suppression"] = nms_sql(source)
    steps["kept"] = NMS_KEPT_SQL
    steps |= after or {}
    return compose(needs, final, steps, recursive=True)


@query("iou", compose(["mapped_boxes"], f"""
select a.image_id, a.line_no, {IOU_SQL} as iou from mapped_boxes a,
  (select 0.0::double as x1, 0.0::double as y1, 0.5::double as x2, 0.5::double as y2) b"""))
def iou(i: Inputs):
    """IoU of each box with the top-left quarter of the picture."""
    quarter = tuple(F.lit(v) for v in (0.0, 0.0, 0.5, 0.5))
    return D.with_corners(i.boxes()).select("image_id", "line_no", B.iou(B.corner_columns(), quarter).alias("iou"))


@query("to_yolo", compose(["detections", "scenes"], """
select image_id, pos,
  printf('%.6f', greatest(0.0, least(1.0, (x1 + x2) / 2 / width))) || ' ' ||
  printf('%.6f', greatest(0.0, least(1.0, (y1 + y2) / 2 / height))) || ' ' ||
  printf('%.6f', greatest(0.001, least(1.0, (x2 - x1) / width))) || ' ' ||
  printf('%.6f', greatest(0.001, least(1.0, (y2 - y1) / height))) as line
from detections join scenes using (image_id)"""))
def to_yolo(i: Inputs):
    d = i.detections().join(i.scenes(), "image_id")
    return d.select("image_id", "pos", B.yolo_text(B.corner_columns(), F.col("width"), F.col("height")).alias("line"))


@query("box_corners", compose(["boxes", "detections"], """
select b.image_id, b.line_no, xc - w / 2 as nx1, yc - h / 2 as ny1, xc + w / 2 as nx2, yc + h / 2 as ny2, x1, y1, x2, y2,
  (x1 + x2) / 2 / 1024 as back_xc, (y2 - y1) / 768 as back_h
from boxes b join detections d on d.image_id = b.image_id and d.pos = b.line_no"""))
def box_corners(i: Inputs):
    c = [F.col(n) for n in ("xc", "yc", "w", "h")]
    size = F.lit(1024), F.lit(768)
    pixels = B.to_pixels(*c, *size)
    named = dict(zip(("nx1", "ny1", "nx2", "ny2"), B.to_corners(*c))) | dict(zip(D.CORNERS, pixels))
    back = B.from_pixels(pixels, *size)
    return i.boxes().select("image_id", "line_no", *[v.alias(k) for k, v in named.items()],
                            back[0].alias("back_xc"), back[3].alias("back_h"))


@query("box_polygon", compose(["detections", "scenes"], """
select image_id, pos, array_to_string(list_transform([x1 / width, y1 / height, x2 / width, y1 / height, x2 / width, y2 / height,
   x1 / width, y2 / height], lambda v: printf('%.6f', greatest(0.0, least(1.0, v)))), ' ') as points
from detections join scenes using (image_id)"""))
def box_polygon(i: Inputs):
    d = i.detections().join(i.scenes(), "image_id")
    points = B.polygon(B.corner_columns(), F.col("width"), F.col("height"))
    return d.select("image_id", "pos", F.array_join(F.transform(points, B.six), " ").alias("points"))


@query("crop_window", compose(["detections", "scenes"], """
select image_id, pos,
  greatest(0, x1 - trunc(greatest(1, x2 - x1) * 0.08::double)::int)::int as left_x,
  greatest(0, y1 - trunc(greatest(1, y2 - y1) * 0.08::double)::int)::int as top_y,
  least(width, x2 + trunc(greatest(1, x2 - x1) * 0.08::double)::int)::int as right_x,
  least(height, y2 + trunc(greatest(1, y2 - y1) * 0.08::double)::int)::int as bottom_y
from (select image_id, pos, round_even(x1, 0)::int as x1, round_even(y1, 0)::int as y1, round_even(x2, 0)::int as x2,
        round_even(y2, 0)::int as y2 from detections) join scenes using (image_id)"""))
def crop_window(i: Inputs):
    d = i.detections().join(i.scenes(), "image_id")
    window = B.crop_window(B.corner_columns(), F.col("width"), F.col("height"))
    names = ("left_x", "top_y", "right_x", "bottom_y")
    return d.select("image_id", "pos", *[c.alias(n) for c, n in zip(window, names)])


@query("inference_size", compose(["images"], """
select image_id, case when greatest(width, height) <= 1000 then width
    else greatest(1, round_even(width * (1000.0::double / greatest(width, height)), 0)::int) end as scaled_width,
  case when greatest(width, height) <= 1000 then height
    else greatest(1, round_even(height * (1000.0::double / greatest(width, height)), 0)::int) end as scaled_height
from images"""))
def inference_size(i: Inputs):
    w, h = B.inference_size(F.col("width"), F.col("height"), 1000)
    return i.images().select("image_id", w.alias("scaled_width"), h.alias("scaled_height"))


@query("area_filter", compose(["detections", "scenes"], """
select image_id, pos, label, (x2 - x1) * (y2 - y1) / greatest(1, width * height)::double as ratio
from detections join scenes using (image_id)
where (x2 - x1) * (y2 - y1) / greatest(1, width * height)::double between 0.05 and 0.15"""))
def area_filter(i: Inputs):
    d = D.in_area_range(i.detections().join(i.scenes(), "image_id"), 0.05, 0.15)
    return d.select("image_id", "pos", "label",
                    B.area_ratio(B.corner_columns(), F.col("width"), F.col("height")).alias("ratio"))


@query("class_map", compose(["mapped_boxes"],
                            "select image_id, line_no, source_class, target_class, target_id from mapped_boxes"))
def class_map(i: Inputs):
    return i.mapped_boxes().select("image_id", "line_no", "source_class", "target_class", "target_id")


@query("box_overlaps", compose(["mapped_boxes"], """
select image_id, a_line, b_line, a_target, b_target, iou from pairs where iou >= 0.98""", {"pairs": PAIRS_SQL}))
def box_overlaps(i: Inputs):
    return D.overlaps(i.mapped_boxes()).select(
        "image_id", F.col("a.line_no").alias("a_line"), F.col("b.line_no").alias("b_line"),
        F.col("a.target_class").alias("a_target"), F.col("b.target_class").alias("b_target"), "iou")


@query("conflicts", compose(["mapped_boxes"], """
select image_id, a_line as box_a_index, a_source as box_a_source_class, a_target as box_a_target_class,
  b_line as box_b_index, b_source as box_b_source_class, b_target as box_b_target_class, round_even(iou, 6) as overlap_ratio
from pairs where iou >= 0.98 and a_target <> b_target""", {"pairs": PAIRS_SQL}))
def conflicts(i: Inputs):
    return D.conflicts(i.mapped_boxes())


SAME_CLASS_BODY = """
select distinct image_id from (
  select image_id, shared, area_a, area_b, dx, dy, shared / least(area_a, area_b) as cover,
    case when area_a + area_b - shared > 0 then shared / (area_a + area_b - shared) else 0 end as iou,
    greatest(area_a, area_b) / greatest(least(area_a, area_b), 1e-6) as ratio
  from (select a.image_id,
      greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) as shared,
      greatest(a.w * a.h, 1e-6) as area_a, greatest(b.w * b.h, 1e-6) as area_b,
      abs(a.xc - b.xc) / greatest(least(a.w, b.w), 1e-6) as dx, abs(a.yc - b.yc) / greatest(least(a.h, b.h), 1e-6) as dy
    from mapped_boxes a join mapped_boxes b on a.image_id = b.image_id and a.class_id = b.class_id and a.line_no < b.line_no))
where shared > 0 and (cover >= 0.72 or iou >= 0.45 or (ratio <= 1.8 and dx <= 0.35 and dy <= 0.35))"""


@query("same_class_overlap", compose(["mapped_boxes"], SAME_CLASS_BODY))
def same_class_overlap(i: Inputs):
    return D.same_class_overlaps(i.boxes())


@query("nms", nms_oracle(["detections"], "detections", "select * from kept"))
def nms(i: Inputs):
    return D.suppress(i.detections())


@query("two_pass_nms", nms_oracle(
    ["detections"], "unioned", "select image_id, label, score, pos, source from kept", {"unioned": """
select image_id, pos, label, score, source, x1, y1, x2, y2 from detections where source = 'full_prompt' and score > 0.28
union all
select image_id, pos, label, score, source, x1, y1, x2, y2 from detections where source = 'expected_fallback' and score > 0.22"""}))
def two_pass_nms(i: Inputs):
    d = i.detections()
    first = D.above(d.where(F.col("source") == "full_prompt"), V.FULL_THRESHOLD)
    second = D.above(d.where(F.col("source") == "expected_fallback"), V.FALLBACK_THRESHOLD)
    return D.suppress(first.unionByName(second)).select("image_id", "label", "score", "pos", "source")


CASCADE_SQL = {
    "first_pass": "select * from detections where source = 'full_prompt' and score > 0.28",
    "missing": """select image_id, expected_class from scenes s where not exists
      (select 1 from first_pass f where f.image_id = s.image_id and f.label = s.expected_class)""",
    "unioned": """select image_id, pos, label, score, source, x1, y1, x2, y2 from first_pass union all
      select d.image_id, d.pos, m.expected_class, d.score, 'expected_fallback', d.x1, d.y1, d.x2, d.y2
      from detections d join missing m using (image_id) where d.source = 'expected_fallback' and d.score > 0.22""",
}


@query("cascade", nms_oracle(["detections", "scenes"], "unioned",
                             "select image_id, label, score, pos, source from kept", CASCADE_SQL))
def cascade(i: Inputs):
    """Second-pass boxes count only for images whose first pass missed the expected class."""
    d = i.detections()
    first = D.above(d.where(F.col("source") == "full_prompt"), V.FULL_THRESHOLD)
    second = D.above(d.where(F.col("source") == "expected_fallback"), V.FALLBACK_THRESHOLD)
    return scoring.cascade(i.scenes(), first, second).select("image_id", "label", "score", "pos", "source")


@query("topk_instances", nms_oracle(["detections", "scenes"], "allowed", f"""
select image_id, label, score, pos, rank from (
  select *, row_number() over (partition by image_id order by -score, list_position({COLLECTION_LIST}, label), pos)::int as rank from kept)
where rank <= 5""", {"allowed": """select d.* from detections d join scenes using (image_id)
  where (x2 - x1) * (y2 - y1) / greatest(1, width * height)::double between 0.002 and 0.95"""}))
def topk_instances(i: Inputs):
    d = i.detections().join(i.scenes().drop("expected_class"), "image_id")
    return D.top_instances(d, counted=i.detections()).select("image_id", "label", "score", "pos", "rank")


@query("best_detection", nms_oracle(["detections", "scenes"], "allowed", f"""
select image_id, label, score, pos from (
  select *, row_number() over (partition by image_id order by -score, list_position({COLLECTION_LIST}, label), pos) as rn from kept)
where rn = 1""", {"allowed": """select d.* from detections d join scenes using (image_id)
  where (x2 - x1) * (y2 - y1) / greatest(1, width * height)::double between 0.002 and 0.95"""}))
def best_detection(i: Inputs):
    d = i.detections().join(i.scenes().drop("expected_class"), "image_id")
    return D.best_detection(d).select("image_id", "label", "score", "pos")


# components by repeated smallest neighbour
COMPONENTS_SQL = {
    "pairs": PAIRS_SQL,
    "links": """select image_id, a_line as u, b_line as v from pairs where iou >= 0.98 and a_target = b_target union all
      select image_id, b_line, a_line from pairs where iou >= 0.98 and a_target = b_target""",
    "reach": """select image_id, line_no as u, line_no as v from mapped_boxes union
      select r.image_id, r.u, l.v from reach r join links l on l.image_id = r.image_id and l.u = r.v""",
    "rooted": "select image_id, u as line_no, min(v) as root from reach group by image_id, u",
    "merged": """select image_id, line_no, source_class, target_class, target_id, xc, yc, w, h, merged_from from (
      select b.*, row_number() over (partition by b.image_id, root order by w * h desc, b.line_no) as rn,
        count(*) over (partition by b.image_id, root) as merged_from
      from mapped_boxes b join rooted using (image_id, line_no)) where rn = 1""",
}


@query("merge_boxes", compose(["mapped_boxes"], "select * from merged", COMPONENTS_SQL, recursive=True))
def merge_boxes(i: Inputs):
    return D.merge_overlaps(i.mapped_boxes()).select(
        "image_id", "line_no", "source_class", "target_class", "target_id", "xc", "yc", "w", "h", "merged_from")


@query("mask_route", compose(["detections", "scenes"], """
select image_id, pos, case when mask_area < 256 then 'box_fallback' else 'sam_mask' end as route,
  case when mask_area < 256 then array_to_string(list_transform([x1 / width, y1 / height, x2 / width, y1 / height,
     x2 / width, y2 / height, x1 / width, y2 / height], lambda v: printf('%.6f', greatest(0.0, least(1.0, v)))), ' ')
   else '' end as points
from (select *, pos % 512 as mask_area from detections) join scenes using (image_id)"""))
def mask_route(i: Inputs):
    d = i.detections().withColumn("mask_area", F.col("pos") % 512).join(i.scenes(), "image_id")
    routed = scoring.route_masks(d)
    return routed.select("image_id", "pos", "route",
                         F.coalesce(F.array_join(F.transform("points", B.six), " "), F.lit("")).alias("points"))
