"""Queries on free-text labels and the hard-sample loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import text as X
from boxloom.operators import review as R
from boxloom.plans.catalog import query
from boxloom.plans.inputs import Inputs
from boxloom.plans.oracle_inputs import compose

# Part names carry no furniture words, so they get a dictionary of their own; "ring" is tried after "hot ring".
PART_ALIASES = {"heated": ["hot ring", "hot plate"], "plain_ring": ["ring"], "plate": ["plate", "large plate"], "tool": ["Anvil!", "wid"], "rod": ["old rod"]}
PART_PRIORITY = ["heated", "plain_ring", "plate", "tool"]


@query("canonical_label", r"""
select p_partkey, coalesce(case when t like '%hot ring%' or t like '%hot plate%' then 'heated' when t like '%ring%' then 'plain_ring'
  when t like '%plate%' then 'plate' when t like '%anvil%' or t like '%wid%' then 'tool' when t like '%old rod%' then 'rod' end, '') as label
from (select p_partkey, trim(regexp_replace(lower(p_name || ' #' || p_size), '[^\p{L}\p{N}]+', ' ', 'g')) as t from part)""")
def canonical_label(i: Inputs):
    raw = F.concat(F.col("p_name"), F.lit(" #"), F.col("p_size").cast("string"))
    label = X.canonical_label(raw, PART_ALIASES, PART_PRIORITY)
    return i.table("part").select("p_partkey", F.coalesce(label, F.lit("")).alias("label"))


@query("normalize_text", r"""
select doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) as text from documents""")
def normalize_text(i: Inputs):
    return i.documents().select("doc_id", X.normalize_text(F.col("text")).alias("text"))


HARD_SQL = {"scored": """select *, top_label as pred_label, conf as confidence, conf - second as margin, top_label <> true_label as error from predictions""",
            "hard": """select *, list_filter([case when error then 'misclassified' end, case when confidence < 0.70 then 'low_confidence' end,
              case when margin < 0.20 then 'low_margin' end], lambda r: r is not null) as reasons from scored
              where error or confidence < 0.70 or margin < 0.20""",
            "manifest": """select *, printf('%.6f', confidence)::double as conf6, printf('%.6f', margin)::double as margin6 from hard""",
            "acted": """select *, case when error and conf6 >= rc and margin6 >= rm then 'relabel_candidate'
              when error and conf6 <= ac and margin6 <= am then 'ambiguous_candidate' else 'general_review' end as suggested_action
              from (select *, case "group" when 'plant' then 0.82 when 'table' then 0.88 else 0.80 end as rc,
                case "group" when 'plant' then 0.18 when 'table' then 0.22 else 0.16 end as rm,
                case "group" when 'plant' then 0.58 else 0.60 end as ac,
                case "group" when 'plant' then 0.08 when 'table' then 0.08 else 0.10 end as am from manifest)"""}


def _hard(i: Inputs):
    return R.hard_samples(R.top_two(i.predictions()))


@query("hard_samples", compose(["predictions"], """
select sample_id, pred_label, confidence, round(margin, 9) as margin, error, array_to_string(reasons, '|') as reasons from hard""", HARD_SQL))
def hard_samples(i: Inputs):
    return _hard(i).select("sample_id", "pred_label", "confidence", F.round("margin", 9).alias("margin"), "error",
                           F.array_join("reasons", "|").alias("reasons"))


@query("hard_priority", compose(["predictions"], """
select "group", path, error::int as error, confidence from hard order by error desc, confidence, margin, (split <> 'train'), path""", HARD_SQL))
def hard_priority(i: Inputs):
    return R.by_priority(_hard(i)).select("group", "path", F.col("error").cast("int").alias("error"), "confidence")


@query("review_export", compose(["predictions"], """
select "group", rank, lpad(rank::varchar, 3, '0') || '_' || split || '_' || true_label || '_as_' || pred_label || '_' || sample_id || '.png' as export_name
from (select *, row_number() over (partition by "group" order by error desc, confidence, margin, (split <> 'train'), path)::int as rank from hard)
where rank <= 120""", HARD_SQL))
def review_export(i: Inputs):
    return R.review_export(_hard(i)).select("group", "rank", "export_name")


@query("suggest_actions", compose(["predictions"], 'select "group", path, suggested_action from acted', HARD_SQL))
def suggest_actions(i: Inputs):
    return R.suggest_actions(R.manifest_rows(_hard(i))).select("group", "path", "suggested_action")


@query("mining_summary", compose(["predictions"], """
select "group", 'total' as section, 'flagged' as key, count(*) as value from hard group by "group" union all
select "group", 'total', 'misclassified', count(*) from hard where error group by "group" union all
select "group", 'by_true_label', true_label, count(*) from hard group by "group", true_label union all
select "group", 'by_reason', r, count(*) from (select "group", unnest(reasons) as r from hard) group by "group", r union all
select "group", 'misclassified_by_pair', true_label || '->' || pred_label, count(*) from hard where error group by "group", 3""", HARD_SQL))
def mining_summary(i: Inputs):
    return R.mining_summary(_hard(i))


@query("action_summary", compose(["predictions"], """
select "group", 'counts' as section, suggested_action as key, count(*) as value from acted group by "group", suggested_action union all
select "group", 'top_' || suggested_action, pair, n from (
  select *, row_number() over (partition by "group", suggested_action order by n desc, pair) as rn from (
    select "group", suggested_action, true_label || '->' || pred_label as pair, count(*) as n from acted
    where error and suggested_action <> 'general_review' group by 1, 2, 3)) where rn <= 10""", HARD_SQL))
def action_summary(i: Inputs):
    return R.action_summary(R.suggest_actions(R.manifest_rows(_hard(i))))


CONFUSION_SQL = {"cells": "select true_label, top_label as pred_label, count(*) as n from predictions group by 1, 2"}


@query("confusion_matrix", compose(["predictions"], "select * from cells", CONFUSION_SQL))
def confusion_matrix(i: Inputs):
    return R.confusion(R.top_two(i.predictions()))


@query("per_class_accuracy", compose(["predictions"], """
select true_label, sum(n)::bigint as total, sum(case when true_label = pred_label then n else 0 end)::bigint as correct,
  sum(case when true_label = pred_label then n else 0 end) / sum(n) as accuracy from cells group by true_label""", CONFUSION_SQL))
def per_class_accuracy(i: Inputs):
    return R.per_class_accuracy(R.confusion(R.top_two(i.predictions())))


@query("overall_accuracy", compose(["predictions"], """
select sum(n)::bigint as samples, sum(case when true_label = pred_label then n else 0 end)::bigint as correct,
  sum(case when true_label = pred_label then n else 0 end) / greatest(1, sum(n)) as accuracy from cells""", CONFUSION_SQL))
def overall_accuracy(i: Inputs):
    return R.overall_accuracy(R.confusion(R.top_two(i.predictions())))


def _relabels(i: Inputs):
    """Four samples share a file name; the classes cycle over three, so places are taken and freed in turn."""
    d, names = F.col("doc_id"), V.GROUPS["plant"]
    cell = F.floor(d / 4).cast("string")
    path = F.concat(F.lit("train/"), V.pick(names, (d + F.col("quality")) % 3), F.lit("/"), cell, F.lit(".png"))
    base = i.table("labels").select(F.lit("plant").alias("group"), path.alias("path"), "doc_id", "quality")
    candidates = base.groupBy("group", "path").agg(F.min("doc_id").alias("order")).withColumn(
        "pred_label", V.pick(names, F.col("order") % 3))
    short = candidates.where(F.col("order") % 11 == 0).select("group", F.concat(F.lit("lost/"), F.col("order").cast("string")).alias("path"), "order", "pred_label")
    return base.select("group", "path").distinct(), candidates.unionByName(short)


@query("apply_relabels", compose([], """
select "group", path, pred_label, "order", moved from acted_rows
union all select 'plant', 'lost/' || "order", pred_label, "order", false from candidates where "order" % 11 = 0""", {
    "base": """select 'plant' as "group", label, cell, min(doc_id) as "order" from (
      select (['broad_leaf_live', 'fake_plant', 'sharp_leaf_live'])[(doc_id + quality) % 3 + 1] as label, doc_id // 4 as cell, doc_id from labels) group by label, cell""",
    "candidates": """select *, 'train/' || label || '/' || cell || '.png' as path,
      (['broad_leaf_live', 'fake_plant', 'sharp_leaf_live'])["order" % 3 + 1] as pred_label,
      row_number() over (partition by cell order by "order") as rn from base""",
    "walk": """select cell, 0::bigint as rn, list(label) as taken, false as moved from base group by cell
      union all
      select cell, rn, case when can then list_append(list_filter(taken, lambda t: t <> label), pred_label) else taken end, can
      from (select w.cell, c.rn, w.taken, c.label, c.pred_label, list_contains(w.taken, c.label) and not list_contains(w.taken, c.pred_label) as can
        from walk w join candidates c on c.cell = w.cell and c.rn = w.rn + 1)""",
    "acted_rows": """select c.*, w.moved from candidates c join walk w on w.cell = c.cell and w.rn = c.rn"""}, recursive=True))
def apply_relabels(i: Inputs):
    return R.apply_relabels(*_relabels(i))
