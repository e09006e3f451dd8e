"""Box geometry as Column expressions; boxes are normalised centre boxes (xc, yc, w, h)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iou(ax: Column, ay: Column, aw: Column, ah: Column, bx: Column, by: Column, bw: Column, bh: Column) -> Column:
    """Intersection over union; 0 where the union is not positive (DOM-20)."""
    across = F.greatest(F.lit(0.0), F.least(ax + aw / 2.0, bx + bw / 2.0) - F.greatest(ax - aw / 2.0, bx - bw / 2.0))
    down = F.greatest(F.lit(0.0), F.least(ay + ah / 2.0, by + bh / 2.0) - F.greatest(ay - ah / 2.0, by - bh / 2.0))
    both = across * down
    union = aw * ah + bw * bh - both
    return F.when(union > 0, both / F.when(union > 0, union)).otherwise(0.0)


def struct_iou(a: Column, b: Column) -> Column:
    return iou(*[a[f] for f in ("xc", "yc", "w", "h")], *[b[f] for f in ("xc", "yc", "w", "h")])


#: The same expression for SQL oracles; a and b are prefixes.
def iou_sql(a: str, b: str) -> str:
    across = f"greatest(0e0, least({a}xc + {a}w / 2e0, {b}xc + {b}w / 2e0) - greatest({a}xc - {a}w / 2e0, {b}xc - {b}w / 2e0))"
    down = f"greatest(0e0, least({a}yc + {a}h / 2e0, {b}yc + {b}h / 2e0) - greatest({a}yc - {a}h / 2e0, {b}yc - {b}h / 2e0))"
    union = f"({a}w * {a}h + {b}w * {b}h - {across} * {down})"
    return f"(case when {union} > 0 then {across} * {down} / {union} else 0e0 end)"


def corners_to_centre(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> list[Column]:
    """VOC corners in pixels to a centre box (DOM-04)."""
    return [((x0 + x1) / 2.0 / width).alias("xc"), ((y0 + y1) / 2.0 / height).alias("yc"), ((x1 - x0) / width).alias("w"), ((y1 - y0) / height).alias("h")]


def xywh_to_centre(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    """COCO top-left boxes in pixels to a centre box (DOM-05)."""
    return [((x + w / 2.0) / width).alias("xc"), ((y + h / 2.0) / height).alias("yc"), (w / width).alias("w"), (h / height).alias("h")]


def letterbox(width: Column, height: Column, side: int = 640) -> dict[str, Column]:
    """Scale, new size and padding that fit an image into a square (DOM-112)."""
    scale = F.least(F.lit(float(side)) / width, F.lit(float(side)) / height)
    w, h = F.floor(width * scale), F.floor(height * scale)
    return {"scale": scale, "new_w": w, "new_h": h, "pad_x": F.floor((F.lit(side) - w) / 2.0), "pad_y": F.floor((F.lit(side) - h) / 2.0)}


def reproject(xc: Column, yc: Column, w: Column, h: Column, width: Column, height: Column, side: int = 640) -> list[Column]:
    """A box after letterboxing, clamped to [0, 1] (DOM-113)."""
    fit = letterbox(width, height, side)
    clamp = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))
    s = float(side)
    return [
        clamp((xc * width * fit["scale"] + fit["pad_x"]) / s).alias("xc"), clamp((yc * height * fit["scale"] + fit["pad_y"]) / s).alias("yc"),
        clamp(w * width * fit["scale"] / s).alias("w"), clamp(h * height * fit["scale"] / s).alias("h"),
    ]
