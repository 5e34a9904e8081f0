"""Numpy kernels for stacks of grey images of one shape, ``(count, height, width)`` bytes; whole numbers only, so results are exact."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

#: Binary grey map ("P5"): magic, width, height, largest value, one blank, then one byte a pixel.
HEADER = re.compile(rb"P5(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)\s")


def decode(content: bytes | None) -> np.ndarray | None:
    """Pixels of an 8-bit grey map; None if the bytes are no such image or do not fit its header."""
    head = HEADER.match(content) if content else None
    if not head:
        return None
    width, height, top = (int(g) for g in head.groups())
    if not (width and height and 0 < top < 256) or len(content) - head.end() != width * height:
        return None
    return np.frombuffer(content, np.uint8, offset=head.end()).reshape(height, width)


def encode(image: np.ndarray) -> bytes:
    height, width = image.shape
    return b"P5\n%d %d\n255\n" % (width, height) + np.ascontiguousarray(image, np.uint8).tobytes()


def centre_crop(stack: np.ndarray, height: int, width: int) -> np.ndarray:
    """The middle of every image; a side that is shorter already stays."""
    h, w = min(height, stack.shape[1]), min(width, stack.shape[2])
    top, left = (stack.shape[1] - h) // 2, (stack.shape[2] - w) // 2
    return stack[:, top:top + h, left:left + w]


def _line(size: int, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each wanted pixel the two source pixels around its centre and the second one's weight in parts of ``2 * wanted``."""
    at = np.clip((2 * np.arange(wanted, dtype=np.int64) + 1) * size - wanted, 0, (size - 1) * 2 * wanted)
    low = at // (2 * wanted)
    return low, np.minimum(low + 1, size - 1), at % (2 * wanted)


def resize(stack: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned, halves rounded up."""
    top, below, down = _line(stack.shape[1], height)
    left, right, across = _line(stack.shape[2], width)
    wide = stack.astype(np.int64)
    rows = wide[:, :, left] * (2 * width - across) + wide[:, :, right] * across
    down = down[:, None]
    both = rows[:, top] * (2 * height - down) + rows[:, below] * down
    whole = 4 * height * width
    return ((both + whole // 2) // whole).astype(np.uint8)


def mirror(stack: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The images that ``which`` marks, left and right exchanged."""
    return np.where(which[:, None, None], stack[:, :, ::-1], stack)


def by_shape(images: list[np.ndarray | None], change: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray | None]:
    """``change(stack, places)`` once for all images of one shape; None stays None."""
    groups: dict[tuple[int, ...], list[int]] = {}
    for i, image in enumerate(images):
        if image is not None:
            groups.setdefault(image.shape, []).append(i)
    out: list[np.ndarray | None] = [None] * len(images)
    for places in groups.values():
        for i, made in zip(places, change(np.stack([images[i] for i in places]), np.array(places))):
            out[i] = made
    return out
