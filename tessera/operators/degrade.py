"""The degradation chain as one record-to-record pass: segmentation, albedo, shading, recombination."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tessera.functions import images as I
from tessera.functions import masks as M

SIDE = 16
RESULT = "coverage double, regions long, method string, kind string, pattern string, mean_albedo double, mean_shading double, mean_out double, error string"
# Degradation kinds with their weights.
KINDS = (("soft_shading", 0.5), ("pattern_shadow", 0.3), ("environment", 0.2))


def image_of(data: bytes) -> np.ndarray:
    """A small image from all of a record's bytes: repeated to fill it, and folded by their mean where there are more."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        raise ValueError("empty image")
    size = SIDE * SIDE * 3
    layers = -(-len(raw) // size)
    return np.resize(raw, layers * size).reshape(layers, SIDE, SIDE, 3).mean(axis=0) / 255.0


def segment(image: np.ndarray) -> np.ndarray:
    """A stand-in for the model: the union of the large regions brighter than the mean."""
    light = I.blur(image @ I.LUMA, 1.0)
    labels, n = M.components(light > light.mean())
    sizes = np.bincount(labels.ravel(), minlength=n + 1)
    large = [labels == k for k in range(1, n + 1) if sizes[k] >= 8]
    return M.union(large, [1.0] * len(large), labels.shape)[0]


def degraded(key: object, data: bytes, seed: int) -> tuple:
    """One record's chain. The random state comes from seed and key, so a retried task gives the same."""
    rng = np.random.default_rng([seed, zlib.crc32(str(key).encode())])
    image = image_of(data)
    mask = segment(image)
    base, method = I.albedo(image, rng.uniform(0.15, 0.25))
    depth = I.blur(image @ I.LUMA, 2.0)
    n = I.normals(depth * 4)
    u, at, kind = rng.random(), 0.0, KINDS[-1][0]
    for name, weight in KINDS:
        at += weight
        if u < at:
            kind = name
            break
    pattern = None
    elevation, azimuth = np.radians(rng.uniform(20, 80)), np.radians(rng.uniform(0, 360))
    light = np.array([np.cos(elevation) * np.cos(azimuth), np.cos(elevation) * np.sin(azimuth), np.sin(elevation)])
    highlight = I.specular(n, light, 16.0)
    if kind == "environment":
        shading = np.clip(I.sh_lighting(n, rng.normal(0.4, 0.3, 9)) * I.ambient_occlusion(depth), 0, 1)
    else:
        shading = I.lambert(n, light, rng.uniform(0.3, 0.6))
        if kind == "pattern_shadow":
            pattern = sorted(I.PATTERNS)[int(rng.integers(len(I.PATTERNS)))]
            shading = shading * I.cast(I.shadow(SIDE, SIDE, pattern, int(rng.integers(1 << 30)), rng.uniform(0.4, 0.8), rng.uniform(0.8, 2.0)), n, depth)
    out = I.composited(I.shaded(base, shading, highlight, 0.1), mask, image)
    return float(mask.mean()), M.components(mask)[1], method, kind, pattern, float(base.mean()), float(shading.mean()), float(out.mean()), None


def degrade(df: DataFrame, key: str, content: str, seed: int = 42) -> DataFrame:
    """``key`` with what the chain measured; a record that fails carries its error and the rest go on."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        for f in frames:
            rows = []
            for k, data in zip(f[key], f[content], strict=True):
                try:
                    rows.append((k, *degraded(k, bytes(data or b""), seed)))
                except ValueError as e:
                    rows.append((k, *[None] * (len(names) - 1), str(e)))
            yield pd.DataFrame(rows, columns=[key, *names])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, content).mapInPandas(run, f"{key} {kind}, {RESULT}")
