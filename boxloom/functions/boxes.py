"""Box geometry as column expressions, usable on columns and inside higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxloom import vocabulary as V

Corners = tuple[Column, Column, Column, Column]


def corner_columns(alias: str = "") -> Corners:
    dot = f"{alias}." if alias else ""
    return tuple(F.col(f"{dot}{c}") for c in ("x1", "y1", "x2", "y2"))


def to_corners(xc: Column, yc: Column, w: Column, h: Column) -> Corners:
    """Centre form to corner form."""
    return xc - w / 2, yc - h / 2, xc + w / 2, yc + h / 2


def to_pixels(xc: Column, yc: Column, w: Column, h: Column, width: Column, height: Column) -> Corners:
    """Normalised centre form to pixel corners."""
    half_w, half_h = w * width / 2, h * height / 2
    cx, cy = xc * width, yc * height
    return cx - half_w, cy - half_h, cx + half_w, cy + half_h


def from_pixels(box: Corners, width: Column, height: Column) -> Corners:
    """Pixel corners to normalised centre form, unclamped."""
    x1, y1, x2, y2 = box
    return (x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def area(box: Corners) -> Column:
    x1, y1, x2, y2 = box
    return F.greatest(F.lit(0.0), x2 - x1) * F.greatest(F.lit(0.0), y2 - y1)


def intersection(a: Corners, b: Corners) -> Column:
    wide = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    high = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), high)


def iou(a: Corners, b: Corners) -> Column:
    """Intersection over union; 0 when the boxes are apart or the union has no area."""
    shared = intersection(a, b)
    union = area(a) + area(b) - shared
    return F.when((shared > 0) & (union > 0), shared / union).otherwise(F.lit(0.0))


def partner_levels(side: Column, threshold: float) -> Column:
    """Power-of-two size levels a partner of this side length can have."""
    if threshold <= 0:
        raise ValueError("the threshold must be above 0: boxes that need not overlap have no nearest cells")
    low = F.floor(F.log2(side * F.lit(threshold * (1 - 1e-9)))).cast("int")
    high = F.floor(F.log2(side / F.lit(threshold * (1 - 1e-9)))).cast("int")
    return F.sequence(low, high)


def partner_cells(centre: Column, side: Column, level: Column, threshold: float) -> Column:
    """Cells of one level that a partner's centre can lie in."""
    size = F.pow(F.lit(2.0), level + 1)
    reach = side * F.lit((1.0 - threshold) / threshold) + size * 1e-9
    return F.sequence(F.floor((centre - reach) / size), F.floor((centre + reach) / size))


def area_ratio(box: Corners, width: Column, height: Column) -> Column:
    """Share of the picture a pixel box covers."""
    return area(box) / F.greatest(F.lit(1), width * height).cast("double")


def area_in_range(box: Corners, width: Column, height: Column,
                  low: float = V.AREA_RANGE[0], high: float = V.AREA_RANGE[1]) -> Column:
    ratio = area_ratio(box, width, height)
    return (ratio >= low) & (ratio <= high)


def six(value: Column) -> Column:
    return F.format_string("%.6f", value)


def yolo_text(box: Corners, width: Column, height: Column) -> Column:
    """Label-file form of a pixel box: centre within [0, 1], size within [0.001, 1], six decimals."""
    xc, yc, w, h = from_pixels(box, width, height)
    return F.concat_ws(" ", six(clamp(xc)), six(clamp(yc)), six(clamp(w, 0.001)), six(clamp(h, 0.001)))


def polygon(box: Corners, width: Column, height: Column) -> Column:
    """The four corners, clockwise from top left, normalised and clamped, as one flat array."""
    x1, y1, x2, y2 = box[0] / width, box[1] / height, box[2] / width, box[3] / height
    return F.transform(F.array(x1, y1, x2, y1, x2, y2, x1, y2), lambda v: clamp(v))


def polygon_text(class_id: Column, points: Column) -> Column:
    """Label-file form of a polygon."""
    return F.concat_ws(" ", class_id.cast("string"), F.array_join(F.transform(points, six), " "))


def crop_window(box: Corners, width: Column, height: Column, padding: float = V.CROP_PADDING) -> Corners:
    """Integer pixel box grown by a share of its size on every side and clipped to the picture."""
    x1, y1, x2, y2 = (F.bround(c).cast("int") for c in box)
    grow_x = (F.greatest(F.lit(1), x2 - x1) * F.lit(padding)).cast("int")
    grow_y = (F.greatest(F.lit(1), y2 - y1) * F.lit(padding)).cast("int")
    return (
        F.greatest(F.lit(0), x1 - grow_x), F.greatest(F.lit(0), y1 - grow_y),
        F.least(width, x2 + grow_x), F.least(height, y2 + grow_y),
    )


def inference_size(width: Column, height: Column, max_side: int) -> tuple[Column, Column]:
    """Size with the long side brought down to ``max_side``, halves rounded to even, at least 1."""
    longest = F.greatest(width, height)
    scale = F.lit(float(max_side)) / longest

    def side(value: Column) -> Column:
        return F.when((F.lit(max_side) <= 0) | (longest <= max_side), value).otherwise(
            F.greatest(F.lit(1), F.bround(value * scale).cast("int"))
        )

    return side(width), side(height)


def suspicious_same_class(a: Corners, b: Corners) -> Column:
    """Two normalised boxes of one class that are probably the same object.

    They must meet, and one of: the smaller is covered to 0.72, IoU of 0.45, or
    similar areas (1.8) with both centre offsets within 0.35 of the smaller side.
    """
    shared = intersection(a, b)
    tiny = F.lit(1e-6)
    wa, ha, wb, hb = a[2] - a[0], a[3] - a[1], b[2] - b[0], b[3] - b[1]
    area_a, area_b = F.greatest(wa * ha, tiny), F.greatest(wb * hb, tiny)
    union = area_a + area_b - shared
    overlap = F.when(union > 0, shared / union).otherwise(F.lit(0.0))
    cover = shared / F.least(area_a, area_b)
    ratio = F.greatest(area_a, area_b) / F.greatest(F.least(area_a, area_b), tiny)
    dx = F.abs((a[0] + a[2]) / 2 - (b[0] + b[2]) / 2) / F.greatest(F.least(wa, wb), tiny)
    dy = F.abs((a[1] + a[3]) / 2 - (b[1] + b[3]) / 2) / F.greatest(F.least(ha, hb), tiny)
    return (shared > 0) & (
        (cover >= 0.72) | (overlap >= 0.45) | ((ratio <= 1.8) & (dx <= 0.35) & (dy <= 0.35))
    )
