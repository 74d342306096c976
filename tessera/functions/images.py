"""Image kernels on float arrays in 0..1, height by width by 3 unless said otherwise."""

from __future__ import annotations

import numpy as np

# Weights of the luminance, and the real spherical harmonics of the first nine terms.
LUMA = np.array([0.299, 0.587, 0.114])
SH = (0.282095, 0.488603, 0.488603, 0.488603, 1.092548, 1.092548, 0.315392, 1.092548, 0.546274)


def blur(image: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian, separable, edges repeated."""
    radius = max(1, int(3 * sigma + 0.5))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    out = image.astype(float)
    for axis in (0, 1):
        pad = [(radius, radius) if a == axis else (0, 0) for a in range(out.ndim)]
        padded = np.pad(out, pad, mode="edge")
        out = sum(k * np.take(padded, range(i, i + image.shape[axis]), axis=axis) for i, k in enumerate(kernel))
    return out


def stretched(x: np.ndarray) -> np.ndarray:
    return (x - x.min()) / (x.max() - x.min() + 1e-8)


def retinex(image: np.ndarray, sigmas: tuple[float, ...] = (1.0, 2.0, 4.0)) -> np.ndarray:
    """Mean over scales of log image less log of its surround, stretched to 0..1."""
    image = image + 1e-3
    return stretched(np.mean([np.log10(image) - np.log10(blur(image, s)) for s in sigmas], axis=0))


def balanced(image: np.ndarray, low: float = 1, high: float = 99) -> np.ndarray:
    """Each channel between two percentiles."""
    a, b = np.percentile(image, [low, high], axis=(0, 1))
    return np.clip((image - a) / (b - a + 1e-8), 0, 1)


def flattened_lightness(image: np.ndarray, sigma: float = 4.0) -> np.ndarray:
    """Luminance divided by its surround, colours kept in ratio."""
    light = image @ LUMA
    target = np.clip(light / (blur(light, sigma) + 1e-3) * light.mean(), 0, 1)
    return np.clip(image * (target / (light + 1e-3))[..., None], 0, 1)


def divided(image: np.ndarray, shading: np.ndarray) -> np.ndarray:
    return np.clip(image / np.maximum(shading, 1e-3)[..., None], 0, 1)


def sharpened(image: np.ndarray, amount: float = 0.5, sigma: float = 1.0) -> np.ndarray:
    return np.clip(image + amount * (image - blur(image, sigma)), 0, 1)


def blended(a: np.ndarray, b: np.ndarray, ratio: float) -> np.ndarray:
    return ratio * a + (1 - ratio) * b


def albedo(image: np.ndarray, ratio: float) -> tuple[np.ndarray, str]:
    """The first method that gives finite values, blended with the image; (albedo, method)."""
    for name, method in (("retinex", lambda x: balanced(retinex(x))), ("lightness", flattened_lightness)):
        made = method(image)
        if np.isfinite(made).all() and made.std() > 1e-6:
            return blended(image, made, ratio), name
    return image, "identity"


def normals(depth: np.ndarray) -> np.ndarray:
    """Unit vectors of (-dz/dx, -dz/dy, 1)."""
    dy, dx = np.gradient(depth)
    n = np.stack((-dx, -dy, np.ones_like(depth)), axis=-1)
    return n / np.linalg.norm(n, axis=-1, keepdims=True)


def lambert(n: np.ndarray, light: np.ndarray, ambient: float) -> np.ndarray:
    return ambient + (1 - ambient) * np.maximum(0, n @ light)


def specular(n: np.ndarray, light: np.ndarray, shininess: float, view: np.ndarray = np.array([0.0, 0.0, 1.0])) -> np.ndarray:
    """The highlight of Phong's model."""
    reflected = 2 * (n @ light)[..., None] * n - light
    return np.where(n @ light > 0, np.maximum(0, reflected @ view) ** shininess, 0.0)


def shaded(image: np.ndarray, shading: np.ndarray, highlight: np.ndarray | None = None, strength: float = 0.0) -> np.ndarray:
    out = image * shading[..., None]
    return np.clip(out if highlight is None else out + strength * highlight[..., None], 0, 1)


def sh_basis(n: np.ndarray) -> np.ndarray:
    x, y, z = n[..., 0], n[..., 1], n[..., 2]
    terms = (np.ones_like(x), y, z, x, x * y, y * z, 3 * z * z - 1, x * z, x * x - y * y)
    return np.stack([c * t for c, t in zip(SH, terms, strict=True)], axis=-1)


def sh_lighting(n: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    return np.maximum(0, sh_basis(n) @ coefficients)


def ambient_occlusion(depth: np.ndarray, radius: int = 2, strength: float = 1.0) -> np.ndarray:
    """Less light where the surroundings stand higher."""
    local = blur(depth, radius)
    return np.clip(1 - strength * np.maximum(0, local - depth) / (np.abs(local).max() + 1e-8), 0, 1)


def composited(front: np.ndarray, mask: np.ndarray, back: np.ndarray | None = None) -> np.ndarray:
    """Over a background, grey where none is given."""
    back = np.full_like(front, 0.5) if back is None else back
    m = mask.astype(float)[..., None]
    return front * m + back * (1 - m)


def _grid(h: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    return np.meshgrid(np.linspace(0, 1, h), np.linspace(0, 1, w), indexing="ij")


def _blobs(h: int, w: int, rng: np.random.Generator, n: int, size: float) -> np.ndarray:
    y, x = _grid(h, w)
    out = np.zeros((h, w))
    for cy, cx, r in zip(rng.random(n), rng.random(n), size * (0.5 + rng.random(n)), strict=True):
        out = np.maximum(out, ((y - cy) ** 2 + (x - cx) ** 2 < r * r).astype(float))
    return out


#: Shadow patterns by name: 1 is full shadow; each takes height, width and a random generator.
PATTERNS = {
    "blinds": lambda h, w, rng: (np.sin(2 * np.pi * (4 + 6 * rng.random()) * _grid(h, w)[0] + rng.random()) > 0).astype(float),
    "stripes": lambda h, w, rng: (np.sin(2 * np.pi * (3 + 5 * rng.random()) * sum(_grid(h, w))) > 0).astype(float),
    "window": lambda h, w, rng: 1 - ((np.abs(_grid(h, w)[0] % 0.5 - 0.25) < 0.2) & (np.abs(_grid(h, w)[1] % 0.5 - 0.25) < 0.2)).astype(float),
    "foliage": lambda h, w, rng: _blobs(h, w, rng, 30, 0.06),
    "branches": lambda h, w, rng: np.clip(sum((np.abs(_grid(h, w)[0] - a - b * _grid(h, w)[1]) < 0.02).astype(float) for a, b in zip(rng.random(6), rng.normal(size=6), strict=True)), 0, 1),
    "grid": lambda h, w, rng: ((_grid(h, w)[0] * 6 % 1 < 0.15) | (_grid(h, w)[1] * 6 % 1 < 0.15)).astype(float),
    "gradient": lambda h, w, rng: _grid(h, w)[int(rng.integers(2))],
    "spots": lambda h, w, rng: 1 - _blobs(h, w, rng, 8, 0.12),
    "half": lambda h, w, rng: (_grid(h, w)[1] < 0.3 + 0.4 * rng.random()).astype(float),
    "noise": lambda h, w, rng: stretched(blur(rng.random((h, w)), 2.0)),
}


def shadow(h: int, w: int, name: str, seed: int, opacity: float, softness: float) -> np.ndarray:
    """Light left by a pattern: its opacity and blur are honoured, the seed repeats it."""
    return 1 - opacity * np.clip(blur(PATTERNS[name](h, w, np.random.default_rng(seed)), softness), 0, 1)


def cast(light: np.ndarray, n: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """A pattern's shadow weakens on surfaces turned away or far."""
    facing = np.clip(n[..., 2], 0, 1) * (1 - 0.5 * stretched(depth))
    return 1 - (1 - light) * facing
