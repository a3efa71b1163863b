"""Array and graph kernels that run inside one task: NumPy and plain Python on one group's rows."""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Callable

import numpy as np
import pandas as pd


def _adjacent(edges: pd.DataFrame) -> dict[int, list[tuple[int, float]]]:
    out: dict[int, list[tuple[int, float]]] = {}
    for a, b, w in zip(edges["src"].tolist(), edges["dst"].tolist(), edges["w"].tolist()):
        out.setdefault(a, []).append((b, w))
        out.setdefault(b, [])
    for near in out.values():
        near.sort()
    return out


def depth_first(edges: pd.DataFrame, start: int) -> pd.DataFrame:
    near = _adjacent(edges)
    depth, found, left, pred, clock = {}, {}, {}, {}, 0
    if start in near:
        stack = [(start, iter(near[start]))]
        depth[start], found[start], pred[start], clock = 0, 0, None, 1
        while stack:
            v, rest = stack[-1]
            u = next((u for u, _ in rest if u not in found), None)
            if u is None:
                left[v] = clock
                stack.pop()
            else:
                depth[u], found[u], pred[u] = depth[v] + 1, clock, v
                stack.append((u, iter(near[u])))
            clock += 1
    order = list(found)
    return pd.DataFrame({"v": order, "d": [depth[v] for v in order], "discover": [found[v] for v in order], "finish": [left[v] for v in order], "pred": pd.array([pred[v] for v in order], "Int64")})


def biconnected(edges: pd.DataFrame) -> pd.DataFrame:
    """Parts of an undirected component given both ways."""
    near = _adjacent(edges)
    low, seen, parts, cuts = {}, {}, {}, set()
    root = min(near)
    seen[root] = low[root] = 0
    stack, pending, children = [(root, None, iter(near[root]))], [], 0
    while stack:
        v, parent, rest = stack[-1]
        step = next(rest, None)
        if step is not None:
            u = step[0]
            if u == parent:
                continue
            if u not in seen:
                seen[u] = low[u] = len(seen)
                pending.append((v, u))
                stack.append((u, v, iter(near[u])))
            elif seen[u] < seen[v]:
                pending.append((v, u))
                low[v] = min(low[v], seen[u])
            continue
        stack.pop()
        if parent is None:
            continue
        low[parent] = min(low[parent], low[v])
        if low[v] >= seen[parent]:
            if parent == root:
                children += 1
            else:
                cuts.add(parent)
            at = pending.index((parent, v))
            group = [tuple(sorted(e)) for e in pending[at:]]
            name = "-".join(map(str, min(group)))
            parts |= {e: name for e in group}
            del pending[at:]
    if children > 1:
        cuts.add(root)
    rows = [(a, b, parts[min(a, b), max(a, b)], a in cuts) for a, b in zip(edges["src"].tolist(), edges["dst"].tolist())]
    return pd.DataFrame(rows, columns=["src", "dst", "part", "cut"])


def max_flow(edges: pd.DataFrame, source: int, sink: int) -> pd.DataFrame:
    """Shortest augmenting paths on level graphs."""
    head: dict[int, list[int]] = {source: [], sink: []}
    to, cap = [], []
    for a, b, w in zip(edges["src"].tolist(), edges["dst"].tolist(), edges["w"].tolist()):
        head.setdefault(a, []).append(len(to))
        to.append(b), cap.append(w)
        head.setdefault(b, []).append(len(to))
        to.append(a), cap.append(0.0)
    original = list(cap)
    level: dict[int, int] = {}

    def levels() -> bool:
        level.clear()
        level[source] = 0
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for e in head[v]:
                if cap[e] > 1e-12 and to[e] not in level:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        return sink in level

    while levels():
        at = {v: 0 for v in head}
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                amount = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= amount
                    cap[e ^ 1] += amount
                path, v = [], source
                continue
            while at[v] < len(head[v]):
                e = head[v][at[v]]
                if cap[e] > 1e-12 and level.get(to[e]) == level[v] + 1:
                    break
                at[v] += 1
            if at[v] < len(head[v]):
                path.append(head[v][at[v]])
                v = to[path[-1]]
            elif path:
                v = to[path.pop() ^ 1]
                at[v] += 1
            else:
                break
    flow = [original[e] - cap[e] for e in range(0, len(to), 2)]
    return pd.DataFrame({"src": edges["src"].tolist(), "dst": edges["dst"].tolist(), "cap": edges["w"].astype(float).tolist(), "flow": flow, "cut": [a in level for a in edges["src"].tolist()]})


def maximum_matching(edges: pd.DataFrame) -> pd.DataFrame:
    """Augmenting paths with contracted blossoms, on an undirected component given both ways."""
    near = {v: [u for u, _ in us] for v, us in _adjacent(edges).items()}
    mate: dict[int, int] = {}

    def augment(root: int) -> bool:
        parent: dict[int, int] = {}
        base = {v: v for v in near}
        outer, queue = {root}, deque([root])

        def meeting(a: int, b: int) -> int:
            path = set()
            while True:
                a = base[a]
                path.add(a)
                if a not in mate:
                    break
                a = parent[mate[a]]
            while base[b] not in path:
                b = parent[mate[base[b]]]
            return base[b]

        def mark(v: int, top: int, child: int, blossom: set[int]) -> None:
            while base[v] != top:
                blossom |= {base[v], base[mate[v]]}
                parent[v] = child
                child = mate[v]
                v = parent[mate[v]]

        while queue:
            v = queue.popleft()
            for u in near[v]:
                if base[v] == base[u] or mate.get(v) == u:
                    continue
                if u == root or (u in mate and mate[u] in parent):
                    top, blossom = meeting(v, u), set()
                    mark(v, top, u, blossom)
                    mark(u, top, v, blossom)
                    for x in near:
                        if base[x] in blossom:
                            base[x] = top
                            if x not in outer:
                                outer.add(x)
                                queue.append(x)
                elif u not in parent:
                    parent[u] = v
                    if u not in mate:
                        while u is not None:
                            before = parent[u]
                            following = mate.get(before)
                            mate[u], mate[before] = before, u
                            u = following
                        return True
                    outer.add(mate[u])
                    queue.append(mate[u])
        return False

    for v in sorted(near):
        if v not in mate:
            augment(v)
    found = sorted((a, b) for a, b in mate.items() if a < b)
    return pd.DataFrame(found, columns=["src", "dst"])


def dominators(edges: pd.DataFrame, start: int) -> pd.DataFrame:
    """Iterated intersection in reverse post-order."""
    order = depth_first(edges, start).sort_values("finish", ascending=False)["v"].tolist()
    place = {v: i for i, v in enumerate(order)}
    before: dict[int, list[int]] = {v: [] for v in order}
    for a, b in zip(edges["src"].tolist(), edges["dst"].tolist()):
        if a in place and b in place:
            before[b].append(a)
    idom = {start: start}
    changed = True
    while changed:
        changed = False
        for v in order[1:]:
            known = [u for u in before[v] if u in idom]
            best = known[0]
            for u in known[1:]:
                a, b = best, u
                while a != b:
                    while place[a] > place[b]:
                        a = idom[a]
                    while place[b] > place[a]:
                        b = idom[b]
                best = a
            if idom.get(v) != best:
                idom[v], changed = best, True
    return pd.DataFrame({"v": order, "idom": pd.array([None if v == start else idom[v] for v in order], "Int64")})


def astar(edges: pd.DataFrame, start: int, goal: int, heuristic: Callable[[int], float]) -> pd.DataFrame:
    near = _adjacent(edges)
    best, pred, queue = {start: 0.0}, {}, [(heuristic(start), start)]
    while queue:
        f, v = heapq.heappop(queue)
        if v == goal:
            break
        if f > best[v] + heuristic(v) + 1e-12:
            continue
        for u, w in near.get(v, []):
            if best[v] + w < best.get(u, np.inf):
                best[u], pred[u] = best[v] + w, v
                heapq.heappush(queue, (best[u] + heuristic(u), u))
    path = [goal] if goal in best else []
    while path and path[-1] != start:
        path.append(pred[path[-1]])
    path.reverse()
    return pd.DataFrame({"step": range(len(path)), "v": path, "dist": [best[v] for v in path]}).astype({"step": "int64", "v": "int64", "dist": "float64"})


def labelled(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """4-connected components of a mask: labels from 1 in scan order, and their number."""
    out = np.zeros(mask.shape, np.int32)
    n = 0
    for y, x in zip(*np.nonzero(mask)):
        if out[y, x]:
            continue
        n += 1
        out[y, x] = n
        queue = deque([(y, x)])
        while queue:
            i, j = queue.popleft()
            for a, b in ((i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)):
                if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not out[a, b]:
                    out[a, b] = n
                    queue.append((a, b))
    return out, n


def watershed(levels: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Seeded region growing: pixels join the neighbour region that reaches them first, by level, then by age."""
    out = seeds.copy()
    queue, age = [], 0
    for y, x in zip(*np.nonzero(seeds)):
        heapq.heappush(queue, (levels[y, x], age, y, x))
        age += 1
    while queue:
        level, _, y, x = heapq.heappop(queue)
        for a, b in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
            if 0 <= a < out.shape[0] and 0 <= b < out.shape[1] and not out[a, b]:
                out[a, b] = out[y, x]
                heapq.heappush(queue, (max(level, levels[a, b]), age, a, b))
                age += 1
    return out


def threshold_sweep(p: np.ndarray, thresholds: list[float], least: int) -> list[np.ndarray]:
    """For each threshold: boundaries (gradient not 0) of the watershed grown from components of p < threshold of `least` pixels or more."""
    out = []
    for t in thresholds:
        seeds, n = labelled(p < t)
        small = np.bincount(seeds.ravel(), minlength=n + 1) < least
        seeds[small[seeds]] = 0
        grown = watershed(p, seeds)
        gy, gx = np.gradient(grown.astype(float)) if min(p.shape) > 1 else (np.zeros(p.shape), np.zeros(p.shape))
        out.append((gx != 0) | (gy != 0))
    return out


def graph_cut(p: np.ndarray, smooth: float, threshold: float) -> np.ndarray:
    """Binary labelling by a minimum cut: terminals from p - threshold, 4-neighbour links of weight `smooth`."""
    h, w = p.shape
    rows = []
    for y in range(h):
        for x in range(w):
            v, d = y * w + x, 2 * (p[y, x] - threshold)
            rows.append((-1, v, d) if d >= 0 else (v, -2, -d))
            for a, b in ((y, x + 1), (y + 1, x)):
                if a < h and b < w:
                    rows += [(v, a * w + b, smooth), (a * w + b, v, smooth)]
    edges = pd.DataFrame(rows, columns=["src", "dst", "w"])
    cut = max_flow(edges, -1, -2)
    side = {int(a): bool(c) for a, c in zip(cut["src"], cut["cut"])}
    return np.array([side.get(v, False) for v in range(h * w)]).reshape(h, w)


def inpainted(labels: np.ndarray, reach: float) -> np.ndarray:
    """Background within `reach` of a label takes the nearest one (the smaller on ties)."""
    out = labels.copy()
    r = int(reach)
    best = np.full(labels.shape, np.inf)
    for dy in range(-r, r + 1):
        for dx in range(-r, r + 1):
            d = dy * dy + dx * dx
            if d == 0 or d > reach * reach:
                continue
            moved = np.zeros_like(labels)
            ys, yd = (slice(dy, None), slice(None, labels.shape[0] - dy)) if dy >= 0 else (slice(None, dy), slice(-dy, None))
            xs, xd = (slice(dx, None), slice(None, labels.shape[1] - dx)) if dx >= 0 else (slice(None, dx), slice(-dx, None))
            moved[yd, xd] = labels[ys, xs]
            better = (labels == 0) & (moved > 0) & ((d < best) | ((d == best) & (moved < out)))
            out[better], best[better] = moved[better], d
    return out


def correlated(image: np.ndarray, template: np.ndarray) -> np.ndarray:
    """Normalised cross-correlation of the same size, reflect-101 padding; 0 where the window is flat."""
    py, px = template.shape[0] // 2, template.shape[1] // 2
    padded = np.pad(image, ((py, template.shape[0] - 1 - py), (px, template.shape[1] - 1 - px)), "reflect")
    windows = np.lib.stride_tricks.sliding_window_view(padded, template.shape)
    t = template - template.mean()
    centred = windows - windows.mean(axis=(2, 3), keepdims=True)
    norm = np.sqrt((centred**2).sum(axis=(2, 3)) * (t**2).sum())
    return np.divide((centred * t).sum(axis=(2, 3)), norm, out=np.zeros(image.shape), where=norm > 1e-12)


def membrane_template(size: int, width: int, angle: float) -> np.ndarray:
    """A dark line of `width` through the centre of a bright square, turned by `angle` degrees."""
    c = size // 2
    y, x = np.mgrid[:size, :size] - c
    a = np.deg2rad(angle)
    return np.where(np.abs(x * np.cos(a) + y * np.sin(a)) <= width / 2, -1.0, 1.0)


def convolution_layer(x: np.ndarray, weights: np.ndarray, bias: np.ndarray, pool: int = 1) -> np.ndarray:
    """tanh(max-pool(valid convolution) + bias) of (channels, h, w) with (out, channels, kh, kw)."""
    kh, kw = weights.shape[2:]
    windows = np.lib.stride_tricks.sliding_window_view(x, (kh, kw), axis=(1, 2))
    y = np.einsum("cijkl,ockl->oij", windows, weights[:, :, ::-1, ::-1])
    if pool > 1:
        h, w = y.shape[1] // pool * pool, y.shape[2] // pool * pool
        y = y[:, :h, :w].reshape(len(y), h // pool, pool, w // pool, pool).max(axis=(2, 4))
    return np.tanh(y + bias[:, None, None])


def dense_layer(x: np.ndarray, weights: np.ndarray, bias: np.ndarray, last: bool = False) -> np.ndarray:
    """tanh, or softmax in the last layer, of x @ weights + bias."""
    y = x @ weights + bias
    if not last:
        return np.tanh(y)
    e = np.exp(y - y.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def maxout(x: np.ndarray, weights: np.ndarray, bias: np.ndarray, pieces: int) -> np.ndarray:
    y = x @ weights + bias
    return y.reshape(*y.shape[:-1], -1, pieces).max(axis=-1)


def heaviest_links(links: list[tuple[int, int, float]]) -> float:
    """The largest total worth of links (a, b, worth) of which each a and each b has one at most, by augmenting paths."""
    out: dict[int, dict[int, float]] = {}
    for a, b, w in links:
        if w > 0:
            out.setdefault(a, {})[b] = max(w, out.get(a, {}).get(b, 0.0))
    mate: dict[int, int] = {}  # b -> a
    total = 0.0
    while True:
        # The best gain of a path from a free a to each b, going back along links that are taken.
        taken = {a: b for b, a in mate.items()}
        gain = {a: (0.0 if a not in taken else -np.inf) for a in out}
        before: dict[int, int] = {}
        reach: dict[int, float] = {}
        for _ in range(2 * len(out) + 1):
            changed = False
            for a, near in out.items():
                for b, w in near.items():
                    if mate.get(b) != a and gain[a] + w > reach.get(b, -np.inf) + 1e-12:
                        reach[b], before[b], changed = gain[a] + w, a, True
                        if b in mate and reach[b] - out[mate[b]][b] > gain[mate[b]] + 1e-12:
                            gain[mate[b]] = reach[b] - out[mate[b]][b]
            if not changed:
                break
        ends = [b for b in reach if b not in mate]
        # A path may also end by giving up the link of a taken a.
        last = max(ends, key=lambda b: reach[b], default=None)
        worth = reach[last] if last is not None else 0.0
        loose = max((a for a in taken), key=lambda a: gain[a], default=None)
        if max(worth, gain[loose] if loose is not None else 0.0) <= 1e-12:
            return total
        if last is None or (loose is not None and gain[loose] > worth):
            total += gain[loose]
            b = taken[loose]
        else:
            total += worth
            b = last
        while True:
            a = before[b]
            following = taken.get(a)
            mate[b] = a
            if following is None:
                break
            b = following


def best_selection(worth: list[float], excluded: list[set[int]], links: list[tuple[int, int, float]]) -> tuple[float, list[int]]:
    """The exact fusion of a conflict component: segments of largest total worth, at most one of each excluded set, with
    the links whose ends are both chosen, each segment linked at most once upwards and once downwards.

    Segments that exclude none are chosen (worths are not negative). The others are decided one by one, the most worth
    first, on a stack; the bound adds the worth of what may still be chosen, of each segment's first set only the most,
    and all links between what is or may be chosen.
    """
    n = len(worth)
    conflicts = {i: set().union(*[s for s in excluded if i in s]) - {i} for i in range(n)}
    free = [i for i in range(n) if not conflicts[i]]
    order = sorted((i for i in range(n) if conflicts[i]), key=lambda i: (-worth[i], i))
    clique = {i: next(k for k, s in enumerate(excluded) if i in s and len(s) > 1) for i in order}

    def value(chosen: set[int]) -> float:
        return sum(worth[i] for i in chosen) + heaviest_links([l for l in links if l[0] in chosen and l[1] in chosen])

    best, found = -1.0, []
    stack: list[tuple[int, frozenset[int]]] = [(0, frozenset(free))]
    while stack:
        k, chosen = stack.pop()
        if k == len(order):
            now = value(set(chosen))
            if now > best + 1e-12:
                best, found = now, sorted(chosen)
            continue
        maybe = [i for i in order[k:] if not conflicts[i] & chosen]
        most: dict[int, float] = {}
        for i in maybe:
            most[clique[i]] = max(most.get(clique[i], 0.0), worth[i])
        alive = chosen | set(maybe)
        up: dict[int, float] = {}
        for a, b, w in links:
            if a in alive and b in alive:
                up[a] = max(up.get(a, 0.0), w)
        if sum(worth[i] for i in chosen) + sum(most.values()) + sum(up.values()) <= best + 1e-12:
            continue
        i = order[k]
        stack.append((k + 1, chosen))
        if not conflicts[i] & chosen:
            stack.append((k + 1, chosen | {i}))
    return max(best, 0.0), found


def padded(lists) -> tuple[np.ndarray, np.ndarray]:
    """Lists of numbers (an Arrow array) as the rows of a matrix, zero where a list ends or has a null, and where it has numbers."""
    long = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    row, column = np.repeat(np.arange(len(long)), long), np.arange(len(flat)) - np.repeat(np.cumsum(long) - long, long)
    values, there = np.zeros((len(long), long.max(initial=0))), np.zeros((len(long), long.max(initial=0)), bool)
    values[row, column], there[row, column] = flat.fill_null(0).to_numpy(zero_copy_only=False), flat.is_valid().to_numpy(zero_copy_only=False)
    return values, there


def two_nearest(asked: tuple[np.ndarray, np.ndarray], known: tuple[np.ndarray, np.ndarray], ids: np.ndarray, unit: float = 1e-9, rows: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of asked, id, distance): what can be among the two of the known rows nearest to each of asked, by (distance
    rounded to unit, id). A distance is the sum, from the first place on, of squared differences where both have numbers.

    Products of matrices tell which rows can't be among them, with a margin for their error; the others are summed place by
    place, so that the outcome is that of the plain sum. Of equal distances the two least ids are enough.
    """
    k = max(asked[0].shape[1], known[0].shape[1])
    (q, qn), (r, rn) = (tuple(np.pad(m, ((0, 0), (0, k - m.shape[1]))) for m in side) for side in (asked, known))
    full = bool(qn.all() and rn.all())
    r2, out = r * r, []
    for start in range(0, len(q), rows):
        own, has = q[start : start + rows], qn[start : start + rows]
        about = -2 * (own @ r.T) + ((own * own).sum(1)[:, None] + r2.sum(1) if full else (own * own) @ rn.T.astype(float) + has.astype(float) @ r2.T)
        about[np.isnan(about)] = np.inf
        second = np.partition(about, 1, axis=1)[:, 1] if len(r) > 1 else np.full(len(own), np.inf)
        error = 8 * (k + 8) * np.finfo(float).eps * ((own * own).sum(1) + r2.sum(1).max(initial=0.0))
        i, j = np.nonzero(~(about > (second + 2 * unit + error)[:, None]))
        d, n = np.zeros(len(i)), np.zeros(len(i), np.int64)
        for c in range(k):
            both = has[i, c] & rn[j, c]
            d += np.where(both, (own[i, c] - r[j, c]) ** 2, 0.0)
            n += both
        i, j, d = i[n > 0], j[n > 0], d[n > 0]
        order = np.lexsort((ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.flatnonzero(np.diff(i, prepend=-1))
        last = np.minimum(first + 1, np.append(first[1:], len(i)) - 1)
        keep = ~(d > np.repeat(d[last], np.diff(np.append(first, len(i)))) + 2 * unit)
        keep[2:] &= (i[2:] != i[:-2]) | (d[2:] != d[:-2])
        out.append((i[keep] + start, ids[j[keep]], d[keep]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), ids[:0], np.zeros(0))


def least_connected(tile: np.ndarray, y: np.ndarray, x: np.ndarray, pid: np.ndarray) -> np.ndarray:
    """The least pid of the 4-connected component of each pixel within its tile; pixels are sorted by (tile, y, x)."""
    if not len(tile):
        return pid
    side = int(x.max() - x.min()) + 2
    high = int(y.max() - y.min()) + 2
    key = (tile.astype(np.int64) * high + (y - y.min())) * side + (x - x.min())
    run = np.cumsum(np.diff(key, prepend=key[0]) > 1)
    place = np.searchsorted(key, key + side)
    below = np.flatnonzero(key[np.minimum(place, len(key) - 1)] == key + side)
    a, b = run[below], run[place[below]]
    root = np.arange(run[-1] + 1)
    while len(a):
        low, far = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, far, low)
        while not np.array_equal(up := root[root], root):
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    least = np.full(len(root), np.iinfo(np.int64).max)
    np.minimum.at(least, root[run], pid)
    return least[root[run]]
