"""Overlay of polygons for what columns can't express: a small helper inside tasks.

Coordinates snap to a grid of GRID degrees. Directed edges are split where they
cross; a piece between crossings knows by how much each shape's winding number
changes across it, and a ray from its middle gives the numbers on one side. Pieces
that part inside from outside are joined to rings.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

GRID = 1e-9
R = 6371008.8
#: Pairs of edges, or of pieces and rays, that are looked at at once.
BLOCK = 2_000_000
#: Edges that one overlay of many problems takes.
EDGES = 4_000
#: Rounds of splitting after which an overlay is given up.
ROUNDS = 200
Ring = list[list[float]]
Polygon = list[Ring]


def _signed(p: np.ndarray) -> float:
    q = p - p[0]
    return float((q[:-1, 0] * q[1:, 1] - q[1:, 0] * q[:-1, 1]).sum())


def _turned(ring: Ring, left: bool) -> np.ndarray:
    """The ring counter-clockwise (left) or clockwise."""
    p = np.array(ring, float)
    return p if (_signed(p) > 0) == left else p[::-1]


def _edges(curves: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directed edges in grid steps from an origin, the group of each, the origin."""
    out, group = [np.zeros((0, 4))], []
    for i, rings in enumerate(curves):
        for ring in rings:
            p = np.round(ring / GRID)
            keep = (p[1:] != p[:-1]).any(1)
            out.append(np.concatenate([p[:-1][keep], p[1:][keep]], axis=1))
            group += [i] * int(keep.sum())
    e = np.concatenate(out)
    at = e[:, :2].min(0) if len(e) else np.zeros(2)
    return e - np.tile(at, 2), np.array(group, int), at


def _near(e: np.ndarray, fresh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of edges whose boxes meet, one of them at least being fresh.

    Edges are listed in upright strips, about as wide as edges are on average, and swept
    upwards within each; a pair counts in the strip where the later of the two begins.
    """
    lo, hi = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    least, wide = lo.min(0), max(1.0, float((hi[:, 0] - lo[:, 0]).mean()))
    first = np.floor((lo[:, 0] - least[0]) / wide).astype(int)
    spans = np.floor((hi[:, 0] - least[0]) / wide).astype(int) - first + 1
    own = np.repeat(np.arange(len(e)), spans)
    strip = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(spans) - spans, spans)
    high = float(hi[:, 1].max() - least[1]) + 1
    below, above = strip * high + (lo[own, 1] - least[1]), strip * high + (hi[own, 1] - least[1])
    order = np.argsort(below, kind="stable")
    own, strip, below, above = own[order], strip[order], below[order], above[order]
    # What follows in the strip: for a fresh edge all others, for the rest those that are fresh.
    new = fresh[own]
    news = np.flatnonzero(new)
    start = np.where(new, np.arange(1, len(own) + 1), np.cumsum(new))
    many = np.where(new, np.searchsorted(below, above, "right"), np.searchsorted(below[news], above, "right")) - start
    total = np.cumsum(many)
    at = 0
    while at < len(own):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, "right")))
        n = many[at:stop]
        i = np.repeat(np.arange(at, stop), n)
        j = start[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        if len(news) < len(own):
            some = np.flatnonzero(~new[i])
            j[some] = news[j[some]]
        here = strip[i]
        i, j = own[i], own[j]
        meet = (lo[i, 0] <= hi[j, 0]) & (lo[j, 0] <= hi[i, 0]) & (np.maximum(first[i], first[j]) == here)
        yield i[meet], j[meet]
        at = stop


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]


def _split(e: np.ndarray, problem: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges between all crossings, and which edge each is of.

    Edges of a problem that a round has cut nothing of are done; of the others pairs
    are looked at again where one of them is new. Rounding moves a crossing by less
    than a step, so a round or two more mostly finds what that brings together; edges
    that all but run together part from each other a step or two a round.
    """
    of = np.arange(len(e))
    problem = np.zeros(len(e), int) if problem is None else problem
    fresh, done = np.ones(len(e), bool), []
    for _ in range(ROUNDS):
        cut_edge, cut_at, cut_point = [], [], []

        def cut(k: np.ndarray, p: np.ndarray) -> None:
            a, d = e[k, :2], e[k, 2:] - e[k, :2]
            inner = (p != a).any(1) & (p != e[k, 2:]).any(1)
            k, p = k[inner], p[inner]
            cut_edge.append(k)
            cut_at.append(((p - e[k, :2]) * d[inner]).sum(1))
            cut_point.append(p)

        for i, j in _near(e, fresh):
            i, j = np.minimum(i, j), np.maximum(i, j)  # a crossing is reckoned from the first, whichever way they were found
            a, b, c, d = e[i, :2], e[i, 2:], e[j, :2], e[j, 2:]
            u, v, w = b - a, d - c, c - a
            x = _cross(u, v)
            with np.errstate(divide="ignore", invalid="ignore"):
                t, s = _cross(w, v) / x, _cross(w, u) / x
            et, es = 0.5 / np.hypot(*u.T), 0.5 / np.hypot(*v.T)
            met = (x != 0) & (t >= -et) & (t <= 1 + et) & (s >= -es) & (s <= 1 + es)
            t, s, et, es = t[met], s[met], et[met], es[met]
            p = a[met] + np.round(t[:, None] * u[met])  # rounded from an end on, so that where a shape is set down makes no difference
            for at, eps, end0, end1 in ((t, et, a, b), (s, es, c, d)):
                p = np.where((np.abs(at) <= eps)[:, None], end0[met], np.where((np.abs(at - 1) <= eps)[:, None], end1[met], p))
            cut(i[met], p)
            cut(j[met], p)
            line = (x == 0) & (_cross(w, u) == 0)
            for k, ends in ((i, (c, d)), (j, (a, b))):
                for p in ends:
                    o, q = e[k, :2], e[k, 2:]
                    on = line & (((p - o) * (q - o)).sum(1) > 0) & (((p - q) * (o - q)).sum(1) > 0)
                    cut(k[on], p[on])
        k = np.concatenate(cut_edge)
        open_ = np.isin(problem, problem[k])
        done.append((e[~open_], of[~open_]))
        if not len(k):
            break
        own = np.flatnonzero(open_)
        edge = np.concatenate([own, k, own])
        at = np.concatenate([np.full(len(own), -np.inf), *cut_at, np.full(len(own), np.inf)])
        point = np.concatenate([e[own, :2], *cut_point, e[own, 2:]])
        order = np.lexsort((point[:, 1], point[:, 0], at, edge))
        edge, point = edge[order], point[order]
        keep = (edge[1:] == edge[:-1]) & (point[1:] != point[:-1]).any(1)
        edge, was = edge[:-1][keep], np.zeros(len(e), bool)
        was[k] = True
        of, problem, fresh = of[edge], problem[edge], was[edge]
        e = np.concatenate([point[:-1][keep], point[1:][keep]], axis=1)
    else:
        raise ArithmeticError("edges still cross after being split")
    return np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])


def _sides(e: np.ndarray, net: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winding numbers left and right of each piece; pieces run to higher x, or upwards."""
    x0, y0, x1, y1 = e.T
    mx, my = (x0 + x1) / 2, (y0 + y1) / 2
    upright = x0 == x1
    left = np.zeros_like(net)
    slope = (y1 - y0) / np.where(upright, 1.0, x1 - x0)
    back = (x1 - x0) / np.where(y1 == y0, 1.0, y1 - y0)
    edge, group = np.nonzero(net)
    for ray in (False, True):
        # Midpoints in order: an edge lies over a range of them, and only these are looked at.
        which = np.flatnonzero(upright == ray)
        which = which[np.argsort((my if ray else mx)[which], kind="stable")]
        line = (my if ray else mx)[which]
        lo, hi = (np.minimum(y0, y1), np.maximum(y0, y1)) if ray else (x0, x1)
        first = np.searchsorted(line, lo)[edge]
        many = np.searchsorted(line, hi)[edge] - first
        total = np.cumsum(many)
        start = 0
        while start < len(edge):
            stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + BLOCK, "right")))
            n = many[start:stop]
            at = np.repeat(np.arange(start, stop), n)
            k = which[first[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
            c = edge[at]
            if ray:  # to the right: what lies there is the right side
                over = (my[k] - y0[c]) * back[c] > mx[k] - x0[c]
            else:  # upwards: what lies there is the left side
                over = (mx[k] - x0[c]) * slope[c] > my[k] - y0[c]
            over &= k != c
            k, c, g = k[over], c[over], group[at[over]]
            left += np.bincount(k * net.shape[1] + g, net[c, g] * (np.sign(y1 - y0)[c] if ray else -1.0), left.size).reshape(left.shape)
            start = stop
        if ray:
            left[which] += net[which]
    return left, left - net


def _traced(e: np.ndarray, origin: np.ndarray) -> list[Polygon]:
    """Polygons with holes of directed edges that have the inside on their left."""
    follow: dict[tuple, list[tuple]] = defaultdict(list)
    for ax, ay, bx, by in e.tolist():
        follow[ax, ay].append((bx, by))
    rings = []
    while follow:
        start = min(follow)
        ring, at = [start], start
        while True:
            ahead = follow[at]
            if len(ahead) == 1:
                to = ahead[0]
                del follow[at]
            else:
                # The sharpest turn to the right splits rings that touch in a point.
                back = math.atan2(ring[-2][1] - at[1], ring[-2][0] - at[0]) if len(ring) > 1 else math.pi
                to = min(ahead, key=lambda p: (back - math.atan2(p[1] - at[1], p[0] - at[0])) % (2 * math.pi) or 2 * math.pi)
                ahead.remove(to)
            ring.append(to)
            at = to
            if at == start or at not in follow:
                break
        p = np.array(ring)
        q = p[:-1]
        turn = _cross(q - np.concatenate([q[-1:], q[:-1]]), np.concatenate([q[1:], q[:1]]) - q) != 0
        if at == start and turn.sum() > 2:
            p = q[turn]
            rings.append(np.concatenate([p, p[:1]]))
    signed = [_signed(r) for r in rings]
    found = {i: [rings[i]] for i, s in enumerate(signed) if s > 0}
    outer = list(found)
    for i, s in enumerate(signed):
        if s < 0:
            a, b = rings[i][0], rings[i][1]
            d = (b - a) / math.hypot(*(b - a))
            x, y = (a + b) / 2 + 0.25 * np.array([-d[1], d[0]])
            holders = [j for j in outer if _inside(x, y, np.concatenate([rings[j][:-1], rings[j][1:]], axis=1))]
            if holders:
                found[min(holders, key=lambda j: signed[j])].append(rings[i])
    return [[((r + origin) * GRID).tolist() for r in rs] for rs in found.values()]


def _overlaid(batch: list[tuple], out: list) -> None:
    """One overlay of all problems of a batch, each set down right of and above the one before, so that none meets another."""
    starts, edges, groups, wide = [], [], [], 0.0
    for _, _, e, group, _ in batch:
        starts.append(wide)
        edges.append(e + wide)
        groups.append(group)
        wide += e.max() + 16
    group = np.concatenate(groups)
    e, of = _split(np.concatenate(edges), np.repeat(np.arange(len(batch)), [len(x) for x in edges]))
    ahead = (e[:, 0] < e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] < e[:, 3]))
    e = np.where(ahead[:, None], e, e[:, [2, 3, 0, 1]])
    order = np.lexsort((e[:, 3], e[:, 2], e[:, 1], e[:, 0]))
    e = e[order]
    new = np.r_[True, (e[1:] != e[:-1]).any(1)] if len(e) else np.zeros(0, bool)
    net = np.zeros((int(new.sum()), int(group.max()) + 1))
    np.add.at(net, (np.cumsum(new) - 1, group[of[order]]), np.where(ahead[order], 1.0, -1.0))
    e = e[new]
    real = net.any(1)
    e, net = e[real], net[real]
    left, right = _sides(e, net)
    stops = [*np.searchsorted(e[:, 0], starts)[1:].tolist(), len(e)]
    at = 0
    for (i, keep, _, _, origin), start, stop in zip(batch, starts, stops, strict=True):
        a, b = keep(left[at:stop]), keep(right[at:stop])
        sides = e[at:stop][a != b]
        out[i] = _traced(np.where(a[a != b][:, None], sides, sides[:, [2, 3, 0, 1]]), origin - start)
        at = stop


def windings(problems: list[list[list[np.ndarray]]], keeps: list[Callable[[np.ndarray], np.ndarray]], lenient: bool = False) -> list[list[Polygon]]:
    """`winding` of many problems, in batches of some EDGES edges; lenient gives None for what can't be split."""
    out: list = [[] for _ in problems]

    def settle(batch: list[tuple]) -> None:
        try:
            _overlaid(batch, out)
        except ArithmeticError:
            if len(batch) > 1:
                settle(batch[: len(batch) // 2])
                settle(batch[len(batch) // 2 :])
            elif lenient:
                out[batch[0][0]] = None
            else:
                raise

    batch, many, most = [], 0, 0
    for i, (curves, keep) in enumerate(zip(problems, keeps, strict=True)):
        e, group, origin = _edges(curves)
        if not len(e):
            continue
        if batch and (many + len(e) > EDGES or max(most, len(curves)) * (many + len(e)) > 16 * EDGES):
            settle(batch)
            batch, many, most = [], 0, 0
        batch.append((i, keep, e, group, origin))
        many, most = many + len(e), max(most, len(curves))
    if batch:
        settle(batch)
    return out


def winding(curves: list[list[np.ndarray]], keep: Callable[[np.ndarray], np.ndarray]) -> list[Polygon]:
    """Where `keep` says so of the winding numbers (a row for each point, a column for each group of closed curves, and maybe further ones of zeros): polygons with holes."""
    return windings([curves], [keep])[0]


def _inside(x: float, y: float, e: np.ndarray) -> bool:
    e = e[(e[:, 1] > y) != (e[:, 3] > y)]
    return bool((e[:, 0] + (y - e[:, 1]) * (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1]) > x).sum() % 2)


def _curves(polygons: list[Polygon]) -> list[np.ndarray]:
    return [_turned(ring, k == 0) for rings in polygons for k, ring in enumerate(rings) if len(ring) > 3]


def _in_both(w: np.ndarray) -> np.ndarray:
    return (w[:, :2] > 0).all(1)


def _in_any(w: np.ndarray) -> np.ndarray:
    return (w > 0).any(1)


def _in_first(w: np.ndarray) -> np.ndarray:
    return (w[:, 0] > 0) & ~(w[:, 1:] > 0).any(1)


def intersections(pairs: list[tuple[list[Polygon], list[Polygon]]]) -> list[list[Polygon]]:
    return windings([[_curves(a), _curves(b)] for a, b in pairs], [_in_both] * len(pairs))


def unions(rows: list[list[list[Polygon]]]) -> list[list[Polygon]]:
    return windings([[_curves(p) for p in parts] for parts in rows], [_in_any] * len(rows))


def differences(rows: list[tuple[list[Polygon], list[list[Polygon]]]], lenient: bool = False) -> list[list[Polygon]]:
    """Of each row (a, others) a less the others."""
    return windings([[_curves(x) for x in (a, *others)] for a, others in rows], [_in_first] * len(rows), lenient)


def intersection(a: list[Polygon], b: list[Polygon]) -> list[Polygon]:
    return intersections([(a, b)])[0]


def union(*parts: list[Polygon]) -> list[Polygon]:
    return unions([list(parts)])[0]


def difference(a: list[Polygon], *others: list[Polygon]) -> list[Polygon]:
    return differences([(a, list(others))])[0]


def area(polygons: list[Polygon], radius: float = R) -> float:
    total = 0.0
    for rings in polygons:
        for k, ring in enumerate(rings):
            p = np.radians(np.array(ring, float)[:-1])
            part = abs(float(((np.roll(p[:, 0], -2) - p[:, 0]) * np.sin(np.roll(p[:, 1], -1))).sum())) * radius * radius / 2
            total += -part if k else part
    return total


def bounds(polygons: list[Polygon]) -> tuple[float, float, float, float]:
    p = np.concatenate([np.array(rings[0], float) for rings in polygons])
    return (*p.min(0).tolist(), *p.max(0).tolist())


def apart(a: list[Polygon], b: list[Polygon]) -> bool:
    """Boxes that share no area."""
    if not a or not b:
        return True
    x, y = bounds(a), bounds(b)
    return x[0] >= y[2] or y[0] >= x[2] or x[1] >= y[3] or y[1] >= x[3]


def touches_or_meets(a: list[Polygon], b: list[Polygon]) -> bool:
    """Common points, borders included."""
    ea, eb = (np.concatenate([np.zeros((0, 4)), *(np.concatenate([p[:-1], p[1:]], axis=1) for p in (np.round(c / GRID) for c in _curves(x)))]) for x in (a, b))
    if not len(ea) or not len(eb):
        return False
    if _inside(*ea[0, :2], eb) or _inside(*eb[0, :2], ea):
        return True
    d, f = ea[:, None, 2:] - ea[:, None, :2], eb[None, :, 2:] - eb[None, :, :2]
    side = lambda v, o, p: v[..., 0] * (p[..., 1] - o[..., 1]) - v[..., 1] * (p[..., 0] - o[..., 0])
    s1, s2 = side(d, ea[:, None, :2], eb[None, :, :2]), side(d, ea[:, None, :2], eb[None, :, 2:])
    s3, s4 = side(f, eb[None, :, :2], ea[:, None, :2]), side(f, eb[None, :, :2], ea[:, None, 2:])
    box = (np.minimum(ea[:, None, [0, 1]], ea[:, None, [2, 3]]) <= np.maximum(eb[None, :, [0, 1]], eb[None, :, [2, 3]])).all(-1) & (np.minimum(eb[None, :, [0, 1]], eb[None, :, [2, 3]]) <= np.maximum(ea[:, None, [0, 1]], ea[:, None, [2, 3]])).all(-1)
    return bool((box & (s1 * s2 <= 0) & (s3 * s4 <= 0)).any())


def _offset(p: np.ndarray, d: float, quarter: int) -> np.ndarray:
    """The curve at distance d to the right of a closed ring, in metres: arcs of `quarter` steps to a right angle at left turns, by way of the corner at others.

    The curve adds up the ring, a strip of width d beside each edge and the arcs'
    wedges. By way of a corner it goes twice round what its two strips share there;
    that is left out at once, the curve turning where they meet, if it lies in both
    strips: of the strips over a point there is always one more than of such turns, but
    if it is beside all of a ring's edges. So what is wound about stays the same.
    """
    p = p[np.r_[True, (p[1:] != p[:-1]).any(1)]]
    long = np.hypot(*(p[1:] - p[:-1]).T)
    u = (p[1:] - p[:-1]) / long[:, None]
    before = np.concatenate([u[-1:], u[:-1]])
    turn = np.arctan2(_cross(before, u), (before * u).sum(1))
    right = turn <= 0
    meet = right & (turn >= -math.pi / 2) & (d * np.sin(-turn) <= np.minimum(long, np.roll(long, 1)))
    if meet.all() and np.ptp(p, axis=0).max() <= 3 * d:
        meet[0] = False
    k = np.where(meet, 0, np.where(right, 2, np.maximum(1, np.ceil(turn / (math.pi / 2) * quarter - 1e-9)))).astype(int)
    # Of each corner k points from the normal before on, and one on the normal after, or between both.
    i = np.repeat(np.arange(len(u)), k + 1)
    j = np.arange(len(i)) - np.repeat(np.cumsum(k + 1) - k - 1, k + 1)
    last = j == k[i]
    between = (before + u) / (1 + np.maximum(0, (before * u).sum(1)))[:, None]
    to = np.where(meet[i][:, None], between[i], np.where(last[:, None], u[i], before[i]))
    angle = np.where(last | right[i], 0.0, turn[i] * j / np.maximum(k[i], 1))
    c, s = np.cos(angle), np.sin(angle)
    far = np.where(~last & right[i] & (j == 1), 0.0, d)[:, None]
    out = p[i] + far * np.stack([to[:, 1] * c + to[:, 0] * s, to[:, 1] * s - to[:, 0] * c], axis=1)
    return np.concatenate([out, out[:1]])


def _is_convex(p: np.ndarray) -> bool:
    """A closed counter-clockwise ring that turns left at every point, once round."""
    d = p[1:] - p[:-1]
    after = np.roll(d, -1, 0)
    turn = np.arctan2(_cross(d, after), (d * after).sum(1))
    return bool((turn > 1e-9).all() and turn.sum() < 7)


def _ring_of(curve: np.ndarray) -> list[Polygon]:
    """A curve that doesn't meet itself, on the grid, as `winding` gives it: from its least point on, without points on a line."""
    p = np.round(curve / GRID)
    p = p[:-1][(p[1:] != p[:-1]).any(1)]
    p = p[_cross(p - np.roll(p, 1, 0), np.roll(p, -1, 0) - p) != 0]
    p = np.roll(p, -int(np.lexsort((p[:, 1], p[:, 0]))[0]), 0)
    return [[(np.concatenate([p, p[:1]]) * GRID).tolist()]]


def _grown(polygons: list[Polygon], metres: float, quarter: int) -> list[Polygon] | tuple[list, Callable]:
    """The shape grown, where that takes no overlay, or else the curves and what to keep of them.

    A box narrower than twice the metres has nothing left, and so has what lies beyond
    a pole, where metres of longitude would count the wrong way round: shrinking never grows.
    """
    if not polygons or not metres:
        return polygons
    x0, y0, x1, y1 = bounds(polygons)
    ky, cos = 180 / (math.pi * R), math.cos(math.radians((y0 + y1) / 2))
    if metres < 0 and (cos <= 0 or min((x1 - x0) * cos, y1 - y0) < -2 * metres * ky):
        return []
    k, at = np.array([min(ky / max(abs(cos), 1e-12), 360 / abs(metres)), ky]), np.array([x0, y0])
    if metres > 0 and len(polygons) == 1 and len(polygons[0]) == 1:
        p = (_turned(polygons[0][0], True) - at) / k
        if _is_convex(p):
            return _ring_of(_offset(p, metres, quarter) * k + at)
    curves, holes = [], []
    for rings in polygons:
        holes.append(range(len(curves) + 1, len(curves) + len(rings)))
        for i, ring in enumerate(rings):
            grows = (metres > 0) == (i == 0)
            curves.append([_offset((_turned(ring, grows) - at) / k, abs(metres), quarter) * k + at])

    def keep(w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(w), bool)
        for own in holes:
            first = own.start - 1
            inside = w[:, first] > 0 if metres > 0 else w[:, first] < 0
            for h in own:
                inside &= ~(w[:, h] < 0 if metres > 0 else w[:, h] > 0)
            out |= inside
        return out

    return curves, keep


def all_buffered(shapes: list[list[Polygon]], metres: list[float], quarter: int = 8) -> list[list[Polygon]]:
    """`buffered` of many shapes, each by its own metres."""
    out: list = [_grown(p, m, quarter) for p, m in zip(shapes, metres, strict=True)]
    asked = [i for i, x in enumerate(out) if isinstance(x, tuple)]
    for i, x in zip(asked, windings([out[i][0] for i in asked], [out[i][1] for i in asked]), strict=True):
        out[i] = x
    return out


def buffered(polygons: list[Polygon], metres: float, quarter: int = 8) -> list[Polygon]:
    """The shape grown by `metres`, or shrunk if negative: a curve beside each ring; outsides grow where holes shrink."""
    return all_buffered([polygons], [metres], quarter)[0]


def has_room(polygon: Polygon, metres: float, n: int = 12) -> bool:
    """Whether one of n by n points over the box is inside and further than `metres` from all borders: then something is left when the shape shrinks by them. False says nothing."""
    x0, y0, x1, y1 = bounds([polygon])
    ky, cos = 180 / (math.pi * R), math.cos(math.radians((y0 + y1) / 2))
    if cos <= 0:
        return False
    k, at = np.array([ky / cos, ky]), np.array([x0, y0])
    e = np.concatenate([np.concatenate([r[:-1], r[1:]], axis=1) for r in ((np.array(ring, float) - at) / k for ring in polygon)])
    x, y = (((np.arange(n) + 0.5) / n)[:, None] * (np.array([x1, y1]) - at) / k).T
    x, y = np.repeat(x, n), np.tile(y, n)
    ax, ay, bx, by = e.T
    over = (ay > y[:, None]) != (by > y[:, None])
    hit = over & (ax + (y[:, None] - ay) * ((bx - ax) / np.where(over, by - ay, 1.0)) > x[:, None])
    inside = hit.sum(1) % 2 == 1
    x, y = x[inside, None], y[inside, None]
    dx, dy = bx - ax, by - ay
    t = np.clip(((x - ax) * dx + (y - ay) * dy) / np.maximum(dx * dx + dy * dy, 1e-18), 0, 1)
    far = ((x - ax - t * dx) ** 2 + (y - ay - t * dy) ** 2).min(1, initial=np.inf)
    return bool((far > (1.05 * metres) ** 2).any())


def polygons_of(geom) -> list[Polygon]:
    """A GeoJSON-like polygon as plain lists."""
    return [[[list(map(float, p)) for p in ring] for ring in geom["coordinates"]]] if geom is not None and geom["coordinates"] is not None and len(geom["coordinates"]) else []


def meets(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether two shapes' rings have common points."""
    for a, b in frames:
        yield pd.Series([touches_or_meets(polygons_of({"coordinates": x}), polygons_of({"coordinates": y})) for x, y in zip(a, b, strict=True)], dtype=bool)


def _pairs(a: pd.Series, b: pd.Series) -> list[tuple[list[Polygon], list[Polygon]]]:
    return [(polygons_of({"coordinates": x}), polygons_of({"coordinates": y})) for x, y in zip(a, b, strict=True)]


def common_areas(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Square metres that two shapes share."""
    for a, b in frames:
        yield pd.Series([area(p) for p in intersections(_pairs(a, b))], dtype=float)


def clipped(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The polygons that two shapes share."""
    for a, b in frames:
        yield pd.Series([[{"type": "Polygon", "coordinates": p} for p in found] for found in intersections(_pairs(a, b))], dtype=object)
