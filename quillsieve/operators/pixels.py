"""Pixel metrics and perceptual hashes (DOM-40..48, DOM-100); numpy per image, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = "origin string, width int, height int, corrupted boolean, blur double, gray_mean double, exposure_pct double, lightness double, contrast double, noise double, dhash string"


def gray_of(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Gray levels 0..255 of BGR(A) or gray bytes."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.float64)
    return x[:, :, 0] if channels == 1 else np.floor(x[:, :, 2] * 0.299 + x[:, :, 1] * 0.587 + x[:, :, 0] * 0.114 + 0.5)


def laplacian_variance(gray: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian, borders mirrored without repeating the edge (DOM-40)."""
    p = np.pad(gray, 1, mode="reflect" if min(gray.shape) > 1 else "edge")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * gray).var())


def noise_of(gray: np.ndarray) -> float:
    """Mean absolute difference to a 3x3 Gaussian (DOM-42)."""
    p = np.pad(gray, 1, mode="reflect" if min(gray.shape) > 1 else "edge")
    rows = (p[:-2] + 2 * p[1:-1] + p[2:]) / 4
    return float(np.abs(gray - (rows[:, :-2] + 2 * rows[:, 1:-1] + rows[:, 2:]) / 4).mean())


def _weights(size: int, to: int) -> np.ndarray:
    scale = max(size / to, 1.0)
    centre = (np.arange(to) + 0.5) * size / to
    x = (np.arange(size)[None, :] + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0)
    return w / w.sum(1, keepdims=True)


def dhash(gray: np.ndarray, size: int = 8) -> str:
    """Difference hash over a Lanczos reduction; a bit is left > right, each row one byte, lowest bit first (DOM-100)."""
    narrow = np.clip(np.floor(gray @ _weights(gray.shape[1], size + 1).T + 0.5), 0, 255)
    small = np.clip(np.floor(_weights(gray.shape[0], size) @ narrow + 0.5), 0, 255)
    return np.packbits(small[:, :-1] > small[:, 1:], axis=1, bitorder="little").tobytes().hex()


def _measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for r in frame.itertuples():
            if r.height <= 0 or r.data is None:
                rows.append((r.origin, None, None, True, *[None] * 7))
                continue
            g = gray_of(r.data, r.height, r.width, r.nChannels)
            mean = float(g.mean())
            rows.append((r.origin, r.width, r.height, False, laplacian_variance(g), mean, mean / 255 * 100, mean / 255, float(g.std()), noise_of(g), dhash(g)))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in METRICS.split(", ")]).astype({"width": "Int32", "height": "Int32"})


def measured(images: DataFrame) -> DataFrame:
    """Metrics of decoded images (``readers.pixels``); files that do not decode are corrupted (DOM-44)."""
    return images.select("origin", "height", "width", "nChannels", "data").mapInPandas(_measure, METRICS)


def with_defaults(metrics: DataFrame) -> DataFrame:
    """Unreadable images count as blur 50 and gray 127 in a calibrated scan (DOM-48)."""
    return metrics.withColumns({"blur": F.coalesce("blur", F.lit(50.0)), "gray_mean": F.coalesce("gray_mean", F.lit(127.0))})


def patch_metrics(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Laplacian variance, mean and deviation of 64 numbers as an 8x8 patch, natively; borders mirrored."""
    mirror = lambda k: 1 if k < 0 else 6 if k > 7 else k
    v = lambda r, c: F.get(vector, mirror(r) * 8 + mirror(c)).cast("double")
    laplacian = F.array(*[v(r - 1, c) + v(r + 1, c) + v(r, c - 1) + v(r, c + 1) - v(r, c) * 4.0 for r in range(8) for c in range(8)])
    plain = F.transform(F.col(vector), lambda x: x.cast("double"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    variance = lambda a: total(F.transform(a, lambda x: x * x)) / 64.0 - (total(a) / 64.0) * (total(a) / 64.0)
    out = vectors.select(F.col(id_column), laplacian.alias("l"), plain.alias("p"))
    return out.select(id_column, variance(F.col("l")).alias("blur"), (total(F.col("p")) / 64.0).alias("mean"), F.sqrt(F.greatest(F.lit(0.0), variance(F.col("p")))).alias("deviation"))
