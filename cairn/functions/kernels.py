"""Arrow kernels for similarities that Spark has no function for; meant for distinct pairs after blocking."""
from __future__ import annotations

import sys
from functools import cache

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def indel_ratio(a: str, b: str) -> float:
    """100 times twice the longest common subsequence over both lengths; bit-parallel."""
    if not a or not b:
        return 0.0
    if a == b:
        return 100.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & masks.get(c, 0)
        s = (s + u | s - u) & full
    return 200.0 * (len(a) - s.bit_count()) / (len(a) + len(b))


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def fuzzy(a: str, b: str) -> float:
    """The better of plain and token-sorted ratio; never a token-set one."""
    return max(indel_ratio(a, b), token_sort_ratio(a, b))


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    used, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    m = len(hits)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(hits, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def phonetic(word: str) -> str:
    """A consonant skeleton: spellings that sound alike in most Latin scripts meet."""
    out = []
    w = word
    for old, new in (("ph", "f"), ("ck", "k"), ("sch", "x"), ("sh", "x"), ("ch", "x"), ("th", "0"), ("qu", "k"), ("gh", "g"), ("wr", "r"), ("kn", "n")):
        w = w.replace(old, new)
    for i, c in enumerate(w):
        if c in "aeiouy" and i:
            continue
        if c == "c":
            c = "s" if w[i + 1 : i + 2] in ("e", "i", "y") else "k"
        c = {"z": "s", "q": "k", "v": "f", "j": "g"}.get(c, c)
        if c == "h" and i:
            continue
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out).upper()


@cache
def _pairwise(f):
    """Made at first use: a worker that imports this module has no session to make one with."""

    def run(a, b):
        import pyarrow as pa

        seen: dict = {}
        out = []
        for p in zip(a.to_pylist(), b.to_pylist(), strict=True):
            if p not in seen:
                seen[p] = None if None in p else float(f(*p))
            out.append(seen[p])
        return pa.array(out, pa.float64())

    return F.arrow_udf(run, "double")


@cache
def _phonetic():
    def run(keys):
        import pyarrow as pa

        return pa.array([None if k is None else " ".join(phonetic(w) for w in k.split()) for k in keys.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")


@cache
def _features():
    def run(a, b):
        import pyarrow as pa

        return pa.array([None if None in p else pair_features(*p) for p in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")


@cache
def _nearest():
    def run(values, allowed):
        import pyarrow as pa

        out = []
        for v, choices in zip(values.to_pylist(), allowed.to_pylist(), strict=True):
            scores = [fuzzy(v, c or "") for c in choices] if v is not None and choices else []
            best = max(scores, default=0.0)
            out.append({"at": scores.index(best), "score": best} if best > 0 else None)
        return pa.array(out, pa.struct([("at", pa.int32()), ("score", pa.float64())]))

    return F.arrow_udf(run, "struct<at:int,score:double>")


def nearest(value, allowed) -> Column:
    """Place and score of the likest of the allowed keys, the first of equals."""
    return _nearest()(value, allowed)


def phonetic_key(c) -> Column:
    return _phonetic()(c)


def fuzzy_score(a, b) -> Column:
    return _pairwise(fuzzy)(a, b)


def jaro_winkler_score(a, b) -> Column:
    return _pairwise(jaro_winkler)(a, b)


def feature_vector(a, b) -> Column:
    return _features()(a, b)


def pair_features(a: str, b: str) -> list[float]:
    """Thirteen likeness features of two keys, each 0 to 1."""
    x, y = a.split(), b.split()
    sx, sy = set(x), set(y)
    both, either = len(sx & sy), max(1, len(sx | sy))
    common = " ".join(sorted(sx & sy))
    settle = max((indel_ratio(common, " ".join(sorted(s))) for s in (sx, sy)), default=0.0) if common else 0.0
    short, long = sorted((a, b), key=len)
    windows = max((indel_ratio(short, long[i : i + len(short)]) for i in range(len(long) - len(short) + 1)), default=0.0) if short else 0.0
    return [
        jaro_winkler(a, b), indel_ratio(a, b) / 100, token_sort_ratio(a, b) / 100, settle / 100, windows / 100, both / either,
        float(sx <= sy or sy <= sx), both / max(1, len(sx)), both / max(1, len(sy)), float(x[:1] == y[:1]), float(x[-1:] == y[-1:]),
        jaro_winkler(a.replace(" ", ""), b.replace(" ", "")), 1 - abs(len(a) - len(b)) / max(1, len(a), len(b)),
    ]


#: An image needs 50 opaque pixels; a pixel is coloured from a saturation of 0.25 on, an image from 12 of 100 pixels on; hues vote in 24 bins.
FEWEST_PIXELS, COLOURED, COLOURED_SHARE, HUES = 50, 0.25, 0.12, 24


def dominant_rgb(pixels: bytes, channels: int) -> tuple[int, int, int] | None:
    """Median colour of the commonest hue among an image's coloured pixels, else of all its opaque ones; null for too few.

    Raw bytes, row by row, three channels or four with opacity.
    """
    import numpy as np

    grid = np.frombuffer(pixels, np.uint8).reshape(-1, channels)
    rgb = (grid[grid[:, 3] > 200] if channels == 4 else grid)[:, :3].astype(float)
    if len(rgb) < FEWEST_PIXELS:
        return None
    top, span = rgb.max(axis=1), np.ptp(rgb, axis=1)
    strong = (span >= COLOURED * top) & (top > 0.15 * 255) & (top < 0.97 * 255)
    chosen = rgb
    if strong.sum() >= FEWEST_PIXELS and strong.mean() >= COLOURED_SHARE:
        vivid, wide = rgb[strong], span[strong]
        first = vivid.argmax(axis=1)  # of equal channels the first leads
        at = np.arange(len(vivid))
        turn = (vivid[at, (first + 1) % 3] - vivid[at, (first + 2) % 3]) / wide + 2 * first
        bins = np.minimum((np.mod(turn, 6) * HUES / 6).astype(int), HUES - 1)
        chosen = vivid[bins == np.bincount(bins, minlength=HUES).argmax()]
    r, g, b = np.median(chosen, axis=0).astype(int)
    return int(r), int(g), int(b)


@cache
def _dominant():
    def run(pixels, channels):
        import pyarrow as pa

        found = (None if p is None or not c else dominant_rgb(p, c) for p, c in zip(pixels.to_pylist(), channels.to_pylist(), strict=True))
        return pa.array([x and dict(zip("rgb", x, strict=True)) for x in found], pa.struct([(x, pa.int32()) for x in "rgb"]))

    return F.arrow_udf(run, "r int, g int, b int")


def dominant_color(pixels, channels) -> Column:
    """(r, g, b) of an image's raw pixels; null for none or too few."""
    return _dominant()(pixels, channels)
