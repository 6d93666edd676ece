"""Two geometry helpers on NumPy arrays, run over Arrow batches: points in polygons and simplification that keeps shapes valid."""

from __future__ import annotations

import numpy as np

#: Points times edges tested at once.
TESTED = 1 << 21


def ring_hits(x: np.ndarray, y: np.ndarray, ring: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point whether it lies on a closed ring, and how many of its edges a ray to the right crosses."""
    ax, ay, bx, by = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
    x, y = x[:, None], y[:, None]
    cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
    inside = (np.minimum(ax, bx) <= x) & (x <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= y) & (y <= np.maximum(ay, by))
    spans = (ay > y) != (by > y)
    at = ax + (y - ay) * (bx - ax) / np.where(by == ay, 1.0, by - ay)
    return ((np.abs(cross) <= 1e-12) & inside).any(1), (spans & (x < at)).sum(1)


def covers(x: np.ndarray, y: np.ndarray, polygons: list[list[np.ndarray]]) -> np.ndarray:
    """For each point whether a multipolygon (rings, the first outer, others holes) covers it; boundaries belong to it."""
    out = np.zeros(len(x), bool)
    for rings in polygons:
        step = max(1, TESTED // max(len(r) for r in rings))
        for k in range(0, len(x), step):
            on, odd = np.zeros(len(x[k : k + step]), bool), np.zeros(len(x[k : k + step]), np.int64)
            for r in rings:
                edge, crossed = ring_hits(x[k : k + step], y[k : k + step], r)
                on |= edge
                odd += crossed
            out[k : k + step] |= on | (odd % 2 == 1)
    return out


class Segments:
    """Segments in the cells of a grid: which of them a new one would touch. Cells are as wide as the segments given first are on average."""

    def __init__(self, lines: list[np.ndarray]) -> None:
        first = np.concatenate([np.hstack([p[:-1], p[1:]]) for p in lines])
        self.cell = float(np.abs(first[:, 2:] - first[:, :2]).max(1).mean()) or 1.0
        self.ends, self.alive, self.cells = first.tolist(), [True] * len(first), {}
        for k, s in enumerate(self.ends):
            self._enter(k, s)

    def _columns(self, s: list[float]):
        """The cells that a segment passes, column by column."""
        (ax, ay, bx, by), w = (s if s[0] <= s[2] else [s[2], s[3], s[0], s[1]]), self.cell
        first, last = int(ax // w), int(bx // w)
        for c in range(first, last + 1):
            at = [ay + (by - ay) * ((min(max(v, ax), bx) - ax) / (bx - ax)) for v in (c * w, (c + 1) * w)] if first < last else [ay, by]
            slack = 1e-9 * w + 1e-12 * max(abs(ay), abs(by))
            for r in range(int((min(at) - slack) // w), int((max(at) + slack) // w) + 1):
                yield c, r

    def _enter(self, k: int, s: list[float]) -> None:
        for cell in self._columns(s):
            self.cells.setdefault(cell, []).append(k)

    def replace(self, gone: range | list[int], s: list[float]) -> int:
        for k in gone:
            self.alive[k] = False
        self.ends.append(s)
        self.alive.append(True)
        self._enter(len(self.ends) - 1, s)
        return len(self.ends) - 1

    def meets(self, s: list[float], own: range | list[int]) -> bool:
        """Whether s meets any segment but its own elsewhere than in an end that both have."""
        own = set(own)
        near = {k for cell in self._columns(s) for k in self.cells.get(cell, ()) if self.alive[k] and k not in own}
        if not near:
            return False
        t = np.array([self.ends[k] for k in near])
        px, py, qx, qy = s
        cx, cy, dx, dy = t.T
        side = lambda ax, ay, bx, by, x, y: np.sign((bx - ax) * (y - ay) - (by - ay) * (x - ax))
        o1, o2, o3, o4 = side(px, py, qx, qy, cx, cy), side(px, py, qx, qy, dx, dy), side(cx, cy, dx, dy, px, py), side(cx, cy, dx, dy, qx, qy)
        box = (np.minimum(cx, dx) <= max(px, qx)) & (np.maximum(cx, dx) >= min(px, qx)) & (np.minimum(cy, dy) <= max(py, qy)) & (np.maximum(cy, dy) >= min(py, qy))
        hit = box & (o1 * o2 <= 0) & (o3 * o4 <= 0)
        c_end, d_end = ((cx == px) & (cy == py)) | ((cx == qx) & (cy == qy)), ((dx == px) & (dy == py)) | ((dx == qx) & (dy == qy))
        share = c_end | d_end
        at_p = ((cx == px) & (cy == py)) | ((dx == px) & (dy == py))
        ox, oy = np.where(c_end, dx, cx), np.where(c_end, dy, cy)  # the other end, seen from the common one
        ux, uy = np.where(at_p, qx - px, px - qx), np.where(at_p, qy - py, py - qy)
        vx, vy = np.where(at_p, ox - px, ox - qx), np.where(at_p, oy - py, oy - qy)
        along = (ux * vy - uy * vx == 0) & (ux * vx + uy * vy > 0)
        return bool((hit & np.where(share, (c_end & d_end) | along, True)).any())


def _in_pocket(x: float, y: float, ring: np.ndarray) -> bool:
    on, crossed = ring_hits(np.array([x]), np.array([y]), np.vstack([ring, ring[:1]]))
    return bool(on[0] or crossed[0] % 2)


def _anchors(ring: np.ndarray) -> list[int]:
    """Three vertices that stay: the first, the one farthest from it, and the one farthest from the line through both."""
    away = ((ring[:-1] - ring[0]) ** 2).sum(1)
    far = int(np.argmax(away))
    d = ring[far] - ring[0]
    third = int(np.argmax(np.abs(d[0] * (ring[:-1, 1] - ring[0, 1]) - d[1] * (ring[:-1, 0] - ring[0, 0]))))
    return sorted({0, far, third})


def simplify_rings(rings: list[np.ndarray], tolerance: float) -> list[np.ndarray]:
    """Closed rings of one shape with fewer vertices, none of which was farther than the tolerance from the line that replaces it.

    A line is refused, and its stretch divided at the farthest vertex, if it would meet another line of the shape, simplified or
    not, or shut a ring out or in that lay on the other side. Each ring keeps three corners that are no line. Valid shapes stay
    valid: rings do not cross, holes stay inside, and none is lost. Rings of under four points or without area stay as they are.
    """
    if not rings:
        return []
    segments = Segments([r for r in rings if len(r) > 1] or [np.zeros((2, 2))])
    boxes = np.array([[*r.min(0), *r.max(0)] if len(r) else [0.0] * 4 for r in rings])
    out, base = [], 0
    for n, ring in enumerate(rings):
        own = list(range(base, base + len(ring) - 1))
        base += max(0, len(ring) - 1)
        anchors = _anchors(ring) if len(ring) > 3 else []
        if len(anchors) < 3:
            out.append(ring)
            continue
        keep = np.zeros(len(ring), bool)
        keep[[*anchors, -1]] = True
        todo = list(zip(anchors, [*anchors[1:], len(ring) - 1], strict=True))
        while todo:
            i, j = todo.pop()
            if j - i < 2:
                continue
            p, q, m = ring[i], ring[j], ring[i + 1 : j]
            d = q - p
            square = float(d @ d)
            t = np.clip(((m - p) @ d) / square, 0, 1) if square else np.zeros(len(m))
            away = np.hypot(*(m - p - t[:, None] * d).T)
            k = int(np.argmax(away))
            line = [*p.tolist(), *q.tolist()]
            if away[k] <= tolerance and square and not segments.meets(line, own[i:j]) and not _shuts(ring[i : j + 1], n, rings, boxes, ring[next(a for a in anchors if a not in (i, j % (len(ring) - 1)))]):
                segments.replace(own[i:j], line)
            else:
                keep[i + 1 + k] = True
                todo += [(i, i + 1 + k), (i + 1 + k, j)]
        out.append(ring[keep])
    return out


def _shuts(stretch: np.ndarray, n: int, rings: list[np.ndarray], boxes: np.ndarray, anchor: np.ndarray) -> bool:
    """Whether another ring, or the rest of its own, lies between a stretch and the line that would replace it."""
    low, high = stretch.min(0), stretch.max(0)
    inside = (boxes[:, :2] >= low).all(1) & (boxes[:, 2:] <= high).all(1)
    inside[n] = False
    spots = [rings[k][0] for k in np.nonzero(inside)[0] if len(rings[k])]
    if (anchor >= low).all() and (anchor <= high).all():
        spots.append(anchor)
    return any(_in_pocket(float(x), float(y), stretch) for x, y in spots)
