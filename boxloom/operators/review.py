"""The hard-sample loop: mine, rank, suggest actions, apply relabels, evaluate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import boxes as B
from boxloom.functions import text as X


def top_two(df: DataFrame, probs: str = "probs", names: str = "names") -> DataFrame:
    """Add pred_label, confidence and margin from class probabilities; one class alone has margin = confidence."""
    ordered = F.sort_array(probs, asc=False)
    best = F.array_max(probs)
    second = F.coalesce(F.try_element_at(ordered, F.lit(2)), F.lit(0.0))
    return df.withColumns({
        "pred_label": F.element_at(names, F.array_position(probs, best).cast("int")),
        "confidence": best, "margin": best - second,
    })


def hard_samples(df: DataFrame, min_confidence: float = 0.70, min_margin: float = 0.20) -> DataFrame:
    """Samples with at least one reason: misclassified, low_confidence, low_margin."""
    error = F.col("pred_label") != F.col("true_label")
    reasons = F.array_compact(F.array(
        F.when(error, "misclassified"),
        F.when(F.col("confidence") < min_confidence, "low_confidence"),
        F.when(F.col("margin") < min_margin, "low_margin"),
    ))
    return df.withColumns({"error": error, "reasons": reasons}).where(F.size("reasons") > 0)


def priority(order_last: str = "path") -> list[Column]:
    """Errors first, then low confidence, low margin, train before the rest; a last column settles ties."""
    return [F.desc("error"), F.asc("confidence"), F.asc("margin"), (F.col("split") != "train").asc(), F.asc(order_last)]


def by_priority(hard: DataFrame) -> DataFrame:
    """All hard samples in review order (a range-partitioned sort)."""
    return hard.orderBy(*priority())


def review_export(hard: DataFrame, k: int = 120) -> DataFrame:
    """The first ``k`` samples of each group with their ranked export name.

    The bound on the rank lets Spark cut each group to k rows before the shuffle.
    """
    ranked = hard.withColumn("rank", F.row_number().over(W.partitionBy("group").orderBy(*priority())))
    name = F.concat_ws("_", F.lpad(F.col("rank").cast("string"), 3, "0"), "split", "true_label",
                       F.lit("as"), "pred_label", X.file_name(F.col("path")))
    return ranked.where(F.col("rank") <= k).withColumn("export_name", name)


def manifest_rows(hard: DataFrame) -> DataFrame:
    """The hard-sample manifest: numbers as six-decimal text, error as 0/1, reasons joined by |."""
    return hard.select(
        "group", "path", "split", "true_label", "pred_label", B.six(F.col("confidence")).alias("confidence"),
        B.six(F.col("margin")).alias("margin"), F.col("error").cast("int").cast("string").alias("error"),
        F.array_join("reasons", "|").alias("reasons"),
    )


def suggest_actions(manifest: DataFrame) -> DataFrame:
    """Add ``suggested_action`` to manifest rows; unreadable numbers count as 0, unknown groups use the default limits."""
    def number(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))

    def limit(at: int) -> Column:
        chain = None
        for group, values in V.ACTION_LIMITS.items():
            test = F.col("group") == group
            chain = F.when(test, values[at]) if chain is None else chain.when(test, values[at])
        return chain.otherwise(V.ACTION_LIMITS[V.DEFAULT_LIMITS_GROUP][at])

    conf, margin, error = number("confidence"), number("margin"), F.col("error") == "1"
    return manifest.withColumn("suggested_action", (
        F.when(error & (conf >= limit(0)) & (margin >= limit(1)), "relabel_candidate")
        .when(error & (conf <= limit(2)) & (margin <= limit(3)), "ambiguous_candidate")
        .otherwise("general_review")
    ))


def mining_summary(hard: DataFrame) -> DataFrame:
    """(group, section, key, value): flagged total, errors, by reason, by true label, by error pair. One pass."""
    pair = F.concat_ws("->", "true_label", "pred_label")

    def entry(section: str, key: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), key.alias("key"))

    entries = F.concat(
        F.array(entry("total", F.lit("flagged")), entry("by_true_label", F.col("true_label"))),
        F.transform("reasons", lambda r: entry("by_reason", r)),
        F.when(F.col("error"), F.array(entry("total", F.lit("misclassified")), entry("misclassified_by_pair", pair)))
        .otherwise(F.array().cast("array<struct<section:string,key:string>>")),
    )
    return (
        hard.select("group", F.inline(entries)).groupBy("group", "section", "key").agg(F.count(F.lit(1)).alias("value"))
    )


def action_summary(actions: DataFrame, k: int = 10) -> DataFrame:
    """(group, section, key, value): rows per action and the k most frequent error pairs of the two candidate actions.

    Pairs are counted first, so the ranking runs over (group, action, pair) rows only.
    """
    pair = F.concat_ws("->", "true_label", "pred_label")
    counts = actions.groupBy("group", "suggested_action", pair.alias("pair"), (F.col("error") == "1").alias("is_error")).agg(
        F.count(F.lit(1)).alias("value"))
    totals = counts.groupBy("group", F.col("suggested_action").alias("key")).agg(F.sum("value").alias("value"))
    ranked = counts.where(F.col("is_error") & (F.col("suggested_action") != "general_review"))
    order = W.partitionBy("group", "suggested_action").orderBy(F.desc("value"), "pair")
    top = ranked.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    return totals.select("group", F.lit("counts").alias("section"), "key", "value").unionByName(
        top.select("group", F.concat(F.lit("top_"), "suggested_action").alias("section"), F.col("pair").alias("key"), "value"))


def parse_slot(path: Column) -> tuple[Column, Column, Column, Column]:
    """(ok, split, label, file) of a path relative to its group root; three parts are needed."""
    parts = F.split(path, "/")
    return (F.size(parts) >= 3, F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2)),
            F.try_element_at(parts, F.lit(-1)))


def apply_relabels(samples: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates with ``moved``: a sample moves when it is still there and its new place is free.

    ``samples`` (group, path) and ``candidates`` (group, path, pred_label, order). Rows act
    in order; a place freed by an earlier row is free. Only rows of one (group, split, file) can
    affect each other, and a file has at most one place and one candidate per class.
    """
    ok, split, label, name = parse_slot(F.col("path"))
    at = ["group", "_split", "_file"]

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumns({"_ok": ok, "_split": split, "_label": label, "_file": name})

    taken = placed(samples).where("_ok").groupBy(*at).agg(F.collect_set("_label").alias("_taken"))
    rows = placed(candidates)
    row = F.struct("order", "path", "pred_label", F.col("_label").alias("label"))
    moves = (
        rows.where("_ok").groupBy(*at).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
        .join(taken, at, "left").withColumn("_taken", F.coalesce("_taken", F.array().cast("array<string>")))
    )
    outcome = "array<struct<path:string,pred_label:string,order:bigint,moved:boolean>>"
    start = F.struct(F.col("_taken").alias("taken"), F.array().cast(outcome).alias("done"))

    def act(state: Column, r: Column) -> Column:
        can = F.array_contains(state["taken"], r["label"]) & ~F.array_contains(state["taken"], r["pred_label"])
        after = F.when(can, F.array_append(F.array_remove(state["taken"], r["label"]), r["pred_label"])).otherwise(state["taken"])
        done = F.struct(r["path"].alias("path"), r["pred_label"].alias("pred_label"),
                        r["order"].cast("long").alias("order"), can.alias("moved"))
        return F.struct(after.alias("taken"), F.concat(state["done"], F.array(done)).alias("done"))

    acted = moves.select("group", F.inline(F.aggregate("_rows", start, act, lambda s: s["done"])))
    short = rows.where(~F.col("_ok")).select("group", "path", "pred_label", F.col("order").cast("long").alias("order"),
                                             F.lit(False).alias("moved"))
    return acted.unionByName(short)


def confusion(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(true_label, pred_label, n); with ``names`` every cell of the square, zero when empty."""
    counts = df.groupBy("true_label", "pred_label").agg(F.count(F.lit(1)).alias("n"))
    if names is None:
        return counts
    known = F.array(*[F.lit(n) for n in names])
    cells = (
        df.sparkSession.range(1).select(F.explode(known).alias("true_label"))
        .select("true_label", F.explode(known).alias("pred_label"))
    )
    return cells.join(counts, ["true_label", "pred_label"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def overall_accuracy(matrix: DataFrame) -> DataFrame:
    """One row (samples, correct, accuracy) from a confusion table; without samples the accuracy is 0."""
    hit = F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)
    sums = matrix.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("samples"), F.coalesce(F.sum(hit), F.lit(0)).alias("correct"))
    return sums.withColumn("accuracy", F.col("correct") / F.greatest(F.lit(1), "samples"))


def per_class_accuracy(matrix: DataFrame) -> DataFrame:
    """(true_label, total, correct, accuracy) from a confusion table; an empty class has accuracy 0."""
    hit = F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)
    sums = matrix.groupBy("true_label").agg(F.sum("n").alias("total"), F.sum(hit).alias("correct"))
    return sums.withColumn("accuracy", F.coalesce(F.try_divide("correct", "total"), F.lit(0.0)))
