"""The area that two polygons share, by signed triangles of both that are clipped against each other: slow and plain."""

import numpy as np


def _triangles(rings) -> list[tuple[float, np.ndarray]]:
    """Signed triangles of all rings' edges with one corner of the polygon; their signed sum is the polygon."""
    points = [np.array([(p["x"], p["y"]) for p in r], dtype=float) for r in rings if len(r) > 2]
    if not points:
        return []
    o, out = points[0][0], []
    for ring in points:
        for a, b in zip(ring, np.roll(ring, -1, axis=0), strict=True):
            cross = (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
            if cross:
                out.append((1.0 if cross > 0 else -1.0, np.array([o, a, b] if cross > 0 else [o, b, a])))
    return out


def _clip(subject: list, triangle: np.ndarray) -> list:
    for a, b in zip(triangle, np.roll(triangle, -1, axis=0), strict=True):
        side = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for p in subject]
        out = []
        for i, p in enumerate(subject):
            q, s, t = subject[i - 1], side[i], side[i - 1]
            if (s >= 0) != (t >= 0):
                k = t / (t - s)
                out.append((q[0] + k * (p[0] - q[0]), q[1] + k * (p[1] - q[1])))
            if s >= 0:
                out.append((p[0], p[1]))
        subject = out
        if len(subject) < 3:
            return []
    return subject


def intersection_area(a, b) -> float:
    """Area of the intersection of two polygons, of any shape, given as rings."""
    total, right = 0.0, [(s, t, t.min(axis=0), t.max(axis=0)) for s, t in _triangles(b)]
    for s, t in _triangles(a):
        low, high = t.min(axis=0), t.max(axis=0)
        for u, v, v0, v1 in right:
            if (low <= v1).all() and (v0 <= high).all() and (p := _clip([tuple(x) for x in t], v)):
                x, y = np.array(p).T
                total += s * u * 0.5 * abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))))
    return abs(total)


