"""Operator inputs derived from the driver's tables.

Every derivation is row-local (no shuffle), so its cost is the scan. Coordinates
are multiples of 1/64, hence areas and intersections are exact in binary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.cluster import spread
from boxloom.functions import boxes as B

WIDTH, HEIGHT = 1024, 768


class Inputs:
    """Frames over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # boxes from lineitem: image = order, class = supplier
    def boxes(self) -> DataFrame:
        """(image_id, line_no, class_id, xc, yc, w, h, score, second_pass)."""
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        qty = F.col("l_quantity").cast("long")
        mix = (part * 7919 + supp * 104729 + qty * 1299709) % 1_000_000_000
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("image_id"),
            (F.col("l_linenumber").cast("long") * 1_000_000_000 + mix).alias("line_no"),
            (supp % 20).cast("int").alias("class_id"),
            (F.lit(0.125) + (part % 4) * 0.25).alias("xc"),
            (F.lit(0.125) + (F.col("l_linenumber") % 4) * 0.25).alias("yc"),
            (F.lit(0.125) + (qty % 3) * 0.1875).alias("w"),
            (F.lit(0.125) + (supp % 3) * 0.1875).alias("h"),
            (F.lit(0.20) + F.col("l_discount") * 6 + F.col("l_tax")).alias("score"),
            (F.col("l_linenumber") % 5 == 4).alias("second_pass"),
        )

    def mapped_boxes(self) -> DataFrame:
        """Boxes with source and merged class names."""
        return self.boxes().join(F.broadcast(V.class_map(self.spark)), "class_id")

    def detections(self) -> DataFrame:
        """(image_id, pos, label, score, source, x1..y2) in pixels of a 1024x768 picture."""
        b = self.boxes()
        x1, y1, x2, y2 = B.to_pixels(*(F.col(c) for c in ("xc", "yc", "w", "h")), F.lit(WIDTH), F.lit(HEIGHT))
        return b.select(
            "image_id", F.col("line_no").alias("pos"), V.pick(V.REVIEW_CLASSES, F.col("class_id")).alias("label"),
            "score", F.when(F.col("second_pass"), "expected_fallback").otherwise("full_prompt").alias("source"),
            x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"),
        )

    def scenes(self) -> DataFrame:
        """Images the boxes lie in, with or without boxes: one per order."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("image_id"),
            V.pick(V.REVIEW_CLASSES, F.col("o_custkey") % 20).alias("expected_class"),
            F.lit(WIDTH).alias("width"),
            F.when(F.col("o_orderstatus") == "P", 384).otherwise(HEIGHT).alias("height"),
        )

    def scene_images(self) -> DataFrame:
        """The scenes as files: as ``images``, for all boxes; three in ten share their bytes with others."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        label = V.pick(V.REVIEW_CLASSES, cust % 20)
        content = F.when(key % 10 < 7, F.concat(F.lit("o"), key.cast("string"))).otherwise(
            F.concat(F.lit("c"), F.floor(cust / F.when(key % 10 == 9, 2).otherwise(1)).cast("string"), F.col("o_orderstatus")))
        return self.table("orders").select(
            key.alias("image_id"), label.alias("folder"), label.alias("label"),
            F.concat(label, F.lit("/"), key.cast("string"), F.lit(".jpg")).alias("path"),
            F.lit(WIDTH).alias("width"), F.when(F.col("o_orderstatus") == "P", 384).otherwise(HEIGHT).alias("height"),
            (key % 1000 + 1).alias("file_size"), F.sha1(content).alias("sha1"),
        )

    # images from documents: bytes = text, class folder = source
    def images(self) -> DataFrame:
        """(image_id, folder, label, path, width, height, file_size, sha1)."""
        d = self.table("documents")
        number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
        return d.select(
            F.col("doc_id").alias("image_id"), F.col("source").alias("folder"),
            V.pick(V.REVIEW_CLASSES, number % 20).alias("label"),
            F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("path"),
            (F.lit(256) + F.col("n_chars") % 1793).cast("int").alias("width"),
            (F.lit(256) + (F.col("doc_id") * 37) % 1280).cast("int").alias("height"),
            F.col("n_chars").alias("file_size"), F.sha1("text").alias("sha1"),
        )

    def documents(self) -> DataFrame:
        return self.table("documents")

    # label files from orders: a few lines of text per order, with known defects
    def label_files(self) -> DataFrame:
        """(image_id, text): whole label files, some with defects (see the branches)."""
        key, n = F.col("o_orderkey"), (F.col("o_custkey") % 6).cast("int")

        def line(i: Column) -> Column:
            return F.concat_ws(
                " ",
                F.when(i % 2 == 0, ((key + i) % 20).cast("string"))
                .otherwise(F.concat(((key + i) % 20).cast("string"), F.lit(".0"))),
                (F.lit(0.125) + ((key + i) % 4) * 0.25).cast("string"),
                (F.lit(0.125) + (i % 4) * 0.25).cast("string"),
                (F.lit(0.125) + ((key + i) % 3) * 0.1875).cast("string"),
                (F.lit(0.125) + (i % 3) * 0.1875).cast("string"),
            )

        lines = F.transform(F.slice(F.sequence(F.lit(0), F.lit(5)), F.lit(1), n), line)
        unix, dos = F.array_join(lines, "\n"), F.array_join(lines, "\r\n")
        case = key % 10
        text = (
            F.when(case == 0, F.concat_ws("\n", F.lit("not a box"), unix))
            .when(case == 1, F.concat_ws("\n", unix, F.lit("3 1.5 -0.25 0.5 0.5")))
            .when(case == 2, dos)
            .when(case == 3, F.concat_ws("\n", F.lit(""), unix, F.lit("")))
            .when(case == 4, F.concat_ws("\n", unix, F.lit("7 0.5 0.5 0.25 0.25 0.9")))
            .when(case == 5, F.concat_ws("\n", unix, F.lit("25 0.5 0.5 0.25 0.25")))
            .when(case == 6, F.concat_ws("\n", F.lit("1 0.5 x 0.25 0.25"), unix))
            .otherwise(unix)
        )
        return spread(self.table("orders")).select(key.alias("image_id"), text.alias("text"))

    # near-equal vectors from embeddings: each with two growing perturbations
    def vectors(self) -> DataFrame:
        """(vec_id, folder, vector, quality): unit vectors; a base and two jittered versions each."""
        base = spread(self.table("embeddings")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
        e = F.col("embedding").cast("array<double>")
        shifted = F.concat(F.slice(e, 2, F.size(e)), F.slice(e, 1, 1))
        raw = F.zip_with(e, shifted, lambda a, b: a + F.col("k") * F.lit(0.07) * b)
        ident = F.col("vec_id") * 3 + F.col("k")
        return base.select(
            ident.alias("vec_id"), F.concat(F.lit("f"), F.col("label").cast("string")).alias("folder"),
            raw.alias("vector"), (ident % 7).alias("pixels"), (ident % 5).alias("width"),
        )

    # predictions from labels
    def predictions(self) -> DataFrame:
        """(sample_id, group, split, path, true_label, pred_label, probs): two-class softmax outputs."""
        d, q = F.col("doc_id"), F.col("quality")
        names = {g: n[:2] for g, n in V.GROUPS.items()} | {"unknown": ["a", "b"]}
        groups = list(names)
        conf = F.lit(0.5) + (d % 50 + 1) / 100.0
        pred = F.when(d % 5 == 0, 1 - q).otherwise(q)
        group = V.pick(groups, d % 5 * 2 % 5)

        def name(index: Column) -> Column:
            out = None
            for g, two in names.items():
                value = F.when(index == 0, two[0]).otherwise(two[1])
                out = F.when(group == g, value) if out is None else out.when(group == g, value)
            return out

        split = F.when(d % 10 < 8, "train").when(d % 10 == 8, "val").otherwise("test")
        return self.table("labels").select(
            d.alias("sample_id"), group.alias("group"), split.alias("split"),
            F.concat(split, F.lit("/"), name(q), F.lit("/"), d.cast("string"), F.lit(".png")).alias("path"),
            name(q).alias("true_label"), F.array(name(F.lit(0)), name(F.lit(1))).alias("names"),
            F.when(pred == 0, F.array(conf, 1 - conf)).otherwise(F.array(1 - conf, conf)).alias("probs"),
        )

    # search pages: the links of the stored pages rewritten as result markup
    def search_pages(self) -> DataFrame:
        """(page_id, query, page_no, html): the stored pages with their links as media URLs."""
        h = F.col("html")
        media = F.regexp_replace(h, r'href="/([^"/?&]{1,40})"', r'"murl":"https://img.example.com/$1.jpg"')
        media = F.regexp_replace(media, r'href="https?://([^"/]+)/([^"?&]{1,60})[^"]*"',
                                 r'murl&quot;:&quot;https://$1/$2.png&quot; mediaurl=https%3a%2f%2f$1%2fthumb%2f$2.webp&')
        media = F.replace(media, F.lit("example.com/t"), F.lit("example.com/thumb/t"))
        cdn = F.regexp_replace(
            h, r'href="/([^"/?&]{1,40})"',
            r'data-src="https://st.hzcdn.com/simgs/$1_4_8.jpg" "https://static.dezeen.com/uploads/2020/01/$1-411x274.jpg" '
            r'src="//live.staticflickr.com/65535/123_ab_m.jpg"')
        photos = F.format_string(
            '"photos":{"page":1,"photo":[{"farm":%d,"server":"s%d","id":"%d","secret":"x%d"},{"farm":0,"server":"","id":"1"}]}',
            F.col("page_id") % 9 + 1, F.col("page_id") % 77, F.col("page_id"), F.col("page_id") * 7)
        return spread(self.table("pages")).select(
            "page_id", F.concat(F.lit("q"), F.floor(F.col("page_id") / 8).cast("string")).alias("query"),
            (F.col("page_id") % 8).cast("int").alias("page_no"), media.alias("html"), cdn.alias("cdn_html"),
            F.when(F.col("page_id") % 3 == 0, F.concat(photos, cdn)).otherwise(cdn).alias("flickr_html"),
        )

    # arrivals from events
    def arrivals(self) -> DataFrame:
        """(arrival_id, ts, label, content_key)."""
        return self.table("events").select(
            F.col("event_id").alias("arrival_id"), "ts", F.col("event_type").alias("label"),
            F.md5(F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_type"))).alias("content_key"),
        )
