"""Page images: PNG files, and the steps from a scan to a readable page, in arrays of gray values.

An image is straightened by the median slope of its lines, its content put in the middle of a page of one
size, then lightly cleaned; a stronger contrast is there for faint pages. All works on one page at a time.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

#: What counts as paper and as ink, spots, gamma, percentiles.
PAPER, INK, SPOT, SQUARE_SPOT, GAMMA, LOW, HIGH = 240, 200, 15, 50, 0.92, 2, 98
#: Gap that joins letters to a line, least pixels and length of a line, lines that are enough.
GAP, LINE_PIXELS, LINE_ASPECT, LINES = 50, 500, 5.0, 5
#: Strong contrast: tiles each way, clip limit, weights and width of the sharpening.
TILES, CLIP, SHARP, BLUR, SIGMA = 8, 4.0, 1.7, -0.7, 1.2


@dataclass
class Page:
    """The size of a page and how far it is straightened."""

    width: int = 2550
    height: int = 3300
    margin: int = 75
    pad: int = 10
    least_angle: float = 0.5
    most_angle: float = 10.0


def pixels(samples: bytes, height: int, width: int) -> np.ndarray:
    """Red, green and blue bytes as gray values."""
    rgb = np.frombuffer(samples, np.uint8).reshape(height, width, 3)
    return np.round(rgb @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def png(gray: np.ndarray, level: int = 6) -> bytes:
    """A file of eight-bit gray values."""
    h, w = gray.shape
    raw = np.zeros((h, w + 1), np.uint8)
    raw[:, 1:] = gray
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + chunk(b"IEND", b"")


def from_png(data: bytes) -> np.ndarray:
    """Gray values of a file of eight-bit gray or colour without interlace; ValueError on others."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, packed, shape = 8, b"", None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            w, h, depth, colour, *_, interlace = struct.unpack(">IIBBBBB", body)
            channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
            if depth != 8 or interlace or channels is None:
                raise ValueError("a kind of PNG that is not read")
            shape = (h, w, channels)
        elif kind == b"IDAT":
            packed += body
        at += 12 + size
    if shape is None:
        raise ValueError("a PNG without a header")
    h, w, channels = shape
    rows = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.uint8)
    before = np.zeros(w * channels, np.int64)
    for y in range(h):
        before = _unfiltered(int(rows[y, 0]), rows[y, 1:].astype(np.int64), before, channels)
        out[y] = before
    out = out.reshape(h, w, channels)
    return out[:, :, 0].copy() if channels < 3 else pixels(np.ascontiguousarray(out[:, :, :3]).tobytes(), h, w)


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return row
    if kind == 2:
        return (row + above) & 255
    out = row.copy()
    for i in range(len(row)):
        left, up, corner = (int(out[i - step]) if i >= step else 0), int(above[i]), (int(above[i - step]) if i >= step else 0)
        if kind == 1:
            add = left
        elif kind == 3:
            add = (left + up) // 2
        else:
            p = left + up - corner
            add = min((left, up, corner), key=lambda x: abs(p - x))  # noqa: B023
        out[i] = (out[i] + add) & 255
    return out


def weights(size: int, to: int) -> np.ndarray:
    """How much each of ``size`` pixels counts for each of ``to``: shares of area when smaller, a windowed sine when larger."""
    scale = size / to
    if scale >= 1:
        edges = np.arange(to + 1) * scale
        at = np.arange(size)
        found = np.clip(np.minimum(edges[1:, None], at + 1) - np.maximum(edges[:-1, None], at), 0, None)
    else:
        x = (np.arange(to) + 0.5)[:, None] * scale - 0.5 - np.arange(size)
        found = np.where(np.abs(x) < 4, np.sinc(x) * np.sinc(x / 4), 0)
    return found / found.sum(1, keepdims=True)


def resized(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    out = weights(gray.shape[0], height) @ gray.astype(float) @ weights(gray.shape[1], width).T
    return np.clip(np.round(out), 0, 255).astype(np.uint8)


def centred(gray: np.ndarray, page: Page | None = None) -> np.ndarray:
    """The content, what is not paper, as large as fits within the margins, in the middle of a white page."""
    page = page or Page()
    ys, xs = np.flatnonzero((gray <= PAPER).any(1)), np.flatnonzero((gray <= PAPER).any(0))
    if not len(ys):
        return resized(gray, page.height, page.width)
    y, x = max(0, ys[0] - page.pad), max(0, xs[0] - page.pad)
    h, w = min(gray.shape[0] - y, ys[-1] + 1 - ys[0] + 2 * page.pad), min(gray.shape[1] - x, xs[-1] + 1 - xs[0] + 2 * page.pad)
    room_w, room_h = page.width - 2 * page.margin, page.height - 2 * page.margin
    scale = min(room_w / w, room_h / h)
    new_h, new_w = max(1, int(h * scale)), max(1, int(w * scale))
    out = np.full((page.height, page.width), 255, np.uint8)
    top, left = page.margin + (room_h - new_h) // 2, page.margin + (room_w - new_w) // 2
    out[top : top + new_h, left : left + new_w] = resized(gray[y : y + h, x : x + w], new_h, new_w)
    return out


def components(mask: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Runs (row, begin, end) of the mask and the component of each, joined also across corners."""
    edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    begins, ends = np.argwhere(edges == 1), np.argwhere(edges == -1)
    runs = [(int(r), int(b), int(e)) for (r, b), (_, e) in zip(begins, ends, strict=True)]
    parent = list(range(len(runs)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted([r for r, _, _ in runs], np.arange(mask.shape[0] + 1))
    for y in range(1, mask.shape[0]):
        i, j = int(first[y - 1]), int(first[y])
        while i < first[y] and j < first[y + 1]:
            (_, b, e), (_, c, f) = runs[i], runs[j]
            if c <= e and b <= f:
                parent[root(i)] = root(j)
            if e < f:
                i += 1
            else:
                j += 1
    return np.array([root(i) for i in range(len(runs))], np.int64), runs


def without_spots(gray: np.ndarray, most: int = SPOT) -> np.ndarray:
    """Dark spots of few pixels, or of some and nearly square, become paper."""
    names, runs = components(gray <= INK)
    out = gray.copy()
    if not runs:
        return out
    r = np.array(runs)
    kinds, at = np.unique(names, return_inverse=True)
    area = np.bincount(at, weights=r[:, 2] - r[:, 1])

    def extent(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        a, b = np.full(len(kinds), np.iinfo(np.int64).max), np.zeros(len(kinds), np.int64)
        np.minimum.at(a, at, low)
        np.maximum.at(b, at, high)
        return b - a

    width, height = extent(r[:, 1], r[:, 2]), extent(r[:, 0], r[:, 0] + 1)
    square = np.maximum(width, height) / np.maximum(1, np.minimum(width, height)) < 2
    gone = (area <= most) | ((area <= SQUARE_SPOT) & square)
    for (y, b, e), k in zip(runs, at, strict=True):
        if gone[k]:
            out[y, b:e] = 255
    return out


def stretched(gray: np.ndarray) -> np.ndarray:
    """The low and high percentiles become black and white."""
    low, high = np.percentile(gray, (LOW, HIGH))
    return np.clip((gray - low) * (255.0 / (high - low)), 0, 255).astype(np.uint8) if high > low else gray.copy()


def median3(gray: np.ndarray) -> np.ndarray:
    """The median of each pixel and its eight neighbours; the border is repeated."""
    wide, (h, w) = np.pad(gray, 1, mode="edge"), gray.shape
    return np.median([wide[y : y + h, x : x + w] for y in range(3) for x in range(3)], axis=0).astype(np.uint8)


def cleaned(gray: np.ndarray) -> np.ndarray:
    """Noise, contrast, white paper, spots and gamma, in this order."""
    out = stretched(median3(gray))
    out = without_spots(np.where(out > PAPER, 255, out).astype(np.uint8))
    return ((np.arange(256) / 255.0) ** (1 / GAMMA) * 255).astype(np.uint8)[out]


def ink_level(gray: np.ndarray) -> int:
    """The value that parts ink and paper best: the largest variance between the two."""
    n = np.bincount(gray.reshape(-1), minlength=256).astype(float)
    below, total = np.cumsum(n), n.sum()
    value = np.cumsum(n * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (value[-1] * below / total - value) ** 2 / (below * (total - below))
    return int(np.nan_to_num(between, posinf=0).argmax())


def skew(gray: np.ndarray, page: Page | None = None) -> float:
    """Degrees by which the lines rise to the right of level, the median over long ones; 0 where there are too few."""
    page = page or Page()
    ink = gray <= ink_level(gray)
    held = np.cumsum(np.pad(ink, ((0, 0), (GAP // 2 + 1, GAP // 2))).astype(np.int32), axis=1)
    lines = held[:, GAP:] - held[:, :-GAP] > 0
    names, runs = components(lines)
    angles = []
    for kind in np.unique(names):
        mine = np.array([runs[i] for i in np.flatnonzero(names == kind)])
        size = mine[:, 2] - mine[:, 1]
        across = mine[:, 2].max() - mine[:, 1].min()
        if size.sum() <= LINE_PIXELS or across < LINE_ASPECT * (np.ptp(mine[:, 0]) + 1) * 0.5:
            continue
        x, y = (mine[:, 1] + mine[:, 2]) / 2, mine[:, 0].astype(float)
        x, y = x - np.average(x, weights=size), y - np.average(y, weights=size)
        spread = np.average(x * x + size**2 / 12, weights=size)
        angles.append(-np.degrees(np.arctan2(np.average(x * y, weights=size), spread)))
    angles = [a for a in angles if abs(a) <= page.most_angle]
    return float(np.median(angles)) if len(angles) >= LINES else 0.0


def rotated(gray: np.ndarray, degrees: float) -> np.ndarray:
    """Turned about the middle, clockwise; what comes in is paper."""
    h, w = gray.shape
    a = np.radians(degrees)
    y, x = np.mgrid[0:h, 0:w].astype(float)
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sx = np.cos(a) * (x - cx) + np.sin(a) * (y - cy) + cx
    sy = -np.sin(a) * (x - cx) + np.cos(a) * (y - cy) + cy
    wide = np.pad(gray, 1, constant_values=255).astype(float)
    sx, sy = np.clip(sx + 1, 0, w + 0.999), np.clip(sy + 1, 0, h + 0.999)
    x0, y0 = np.minimum(sx.astype(int), w), np.minimum(sy.astype(int), h)
    fx, fy = sx - x0, sy - y0
    out = (wide[y0, x0] * (1 - fx) + wide[y0, x0 + 1] * fx) * (1 - fy) + (wide[y0 + 1, x0] * (1 - fx) + wide[y0 + 1, x0 + 1] * fx) * fy
    return np.clip(np.round(out), 0, 255).astype(np.uint8)


def straightened(gray: np.ndarray, page: Page | None = None) -> tuple[np.ndarray, float]:
    """The image with level lines, and the degrees it was off; small angles stay."""
    page = page or Page()
    angle = skew(gray, page)
    return (rotated(gray, angle), angle) if abs(angle) >= page.least_angle else (gray, angle)


def blurred(gray: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(np.ceil(4 * sigma))
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    k /= k.sum()
    wide = np.pad(gray.astype(float), reach, mode="reflect")
    rows = sum(c * wide[i : i + gray.shape[0]] for i, c in enumerate(k))
    return sum(c * rows[:, i : i + gray.shape[1]] for i, c in enumerate(k))


def locally_equalized(gray: np.ndarray, tiles: int = TILES, clip: float = CLIP) -> np.ndarray:
    """Histograms equalised by tile, clipped, and blended between the tiles' middles."""
    h, w = gray.shape
    th, tw = -(-h // tiles), -(-w // tiles)
    wide = np.pad(gray, ((0, th * tiles - h), (0, tw * tiles - w)), mode="edge")
    tables = np.zeros((tiles, tiles, 256))
    limit = max(1.0, clip * th * tw / 256)
    for i in range(tiles):
        for j in range(tiles):
            n = np.bincount(wide[i * th : (i + 1) * th, j * tw : (j + 1) * tw].reshape(-1), minlength=256).astype(float)
            over = np.clip(n - limit, 0, None).sum()
            tables[i, j] = np.cumsum(np.minimum(n, limit) + over / 256) * 255 / (th * tw)
    y, x = (np.arange(h) + 0.5) / th - 0.5, (np.arange(w) + 0.5) / tw - 0.5
    y0, x0 = np.clip(np.floor(y).astype(int), 0, tiles - 1), np.clip(np.floor(x).astype(int), 0, tiles - 1)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    fy, fx = np.clip(y - y0, 0, 1)[:, None], np.clip(x - x0, 0, 1)[None]
    told = lambda a, b: tables[a[:, None], b[None], gray]
    out = (told(y0, x0) * (1 - fx) + told(y0, x1) * fx) * (1 - fy) + (told(y1, x0) * (1 - fx) + told(y1, x1) * fx) * fy
    return np.clip(np.round(out), 0, 255).astype(np.uint8)


def contrasted(gray: np.ndarray) -> np.ndarray:
    """Strong local contrast and sharpening, for faint pages."""
    boosted = locally_equalized(stretched(gray))
    return np.clip(np.round(SHARP * boosted + BLUR * blurred(boosted, SIGMA)), 0, 255).astype(np.uint8)


def right_column(gray: np.ndarray, share: float = 0.3) -> np.ndarray:
    """What lies right of a share of the width, five pixels on."""
    w = gray.shape[1]
    return gray[:, min(w - 1, max(0, int(w * share) + 5)) :]


def enhanced(image: bytes, page: Page | None = None) -> bytes:
    """A page's image straightened, centred and cleaned."""
    return png(cleaned(centred(straightened(from_png(image), page)[0], page)))


def for_reading(image: bytes, name: str, column: float = 0.3) -> bytes:
    """The image that a reading gets: the text column, a stronger contrast, or the page as it is."""
    if name == "textcol":
        return png(right_column(from_png(image), column))
    return png(contrasted(from_png(image))) if name == "faint_fallback" else image
