"""Line segments of one matrix in one loop: what the detector over tiles is compared with."""

from math import log10, pi

import numpy as np

from prismcube.operators.segments import _apart, level_lines, log_nfa, subsample


def find_segments(m: np.ndarray, scale=0.8, sigma_scale=0.6, quant=2.0, ang_th=22.5, log_eps=0.0, density_th=0.7, n_bins=1024) -> list[tuple]:
    """x1, y1, x2, y2, width, p, -log10(NFA) of the segments, in the frame's coordinates."""
    tau, p = pi * ang_th / 180, ang_th / 180
    angle, size = level_lines(subsample(m, scale, sigma_scale), quant / np.sin(tau))
    rows, cols = angle.shape
    if not rows or not cols:
        return []
    tests = 5 * (log10(rows + 1) + log10(cols + 1)) / 2 + log10(11)
    least = int(-tests / log10(p))
    usable = ~np.isnan(angle)
    top = size[usable].max(initial=0)
    bins = np.minimum((size / top * n_bins).astype(int), n_bins - 1) if top else np.zeros(size.shape, int)
    ys, xs = np.nonzero(usable)
    order = np.argsort(-bins[ys, xs], kind="stable")
    out = []

    def grow(y, x, tolerance):
        part, sx, sy = [(y, x)], np.cos(angle[y, x]), np.sin(angle[y, x])
        usable[y, x], theta, i = False, angle[y, x], 0
        while i < len(part):
            a, b = part[i]
            i += 1
            for c in range(max(a - 1, 0), min(a + 2, rows)):
                for d in range(max(b - 1, 0), min(b + 2, cols)):
                    if usable[c, d] and _apart(angle[c, d], theta) <= tolerance:
                        usable[c, d] = False
                        part.append((c, d))
                        sx, sy = sx + np.cos(angle[c, d]), sy + np.sin(angle[c, d])
                        theta = np.arctan2(sy, sx)
        return np.array(part), theta

    def rectangle(part, theta):
        w = size[part[:, 0], part[:, 1]]
        c = (part * w[:, None]).sum(0) / w.sum()
        d = part - c
        yy, xx, xy = (w * d[:, 0] ** 2).sum(), (w * d[:, 1] ** 2).sum(), (w * d[:, 0] * d[:, 1]).sum()
        v = np.linalg.eigh(np.array([[yy, xy], [xy, xx]]))[1][:, 1]  # the direction in which the region is longest
        t = np.arctan2(v[0], v[1])
        t = t + pi if _apart(t, theta) > pi / 2 else t
        u = np.array([np.sin(t), np.cos(t)])
        along, across = d @ u, d @ np.array([np.cos(t), -np.sin(t)])
        width = max(across.max() - across.min(), 1.0)
        return c, t, u, along.min(), along.max(), across, width

    for y, x in zip(ys[order].tolist(), xs[order].tolist(), strict=True):
        if not usable[y, x]:
            continue
        part, theta = grow(y, x, tau)
        if len(part) < least:
            continue
        rec = rectangle(part, theta)
        density = len(part) / max((rec[4] - rec[3]) * rec[6], 1e-9)
        if density < density_th:  # a tighter tolerance, from the angles near the seed; then a shorter reach
            near = part[np.hypot(*(part - part[0]).T) < rec[6]]
            spread = np.sqrt((_apart(angle[near[:, 0], near[:, 1]], angle[y, x]) ** 2).mean())
            usable[part[:, 0], part[:, 1]] = True
            part, theta = grow(y, x, 2 * spread)
            if len(part) < 2:
                continue
            rec = rectangle(part, theta)
            reach = max(abs(rec[3]), abs(rec[4]))
            while len(part) / max((rec[4] - rec[3]) * rec[6], 1e-9) < density_th and len(part) >= 2:
                reach *= 0.75
                far = np.hypot(*(part - part[0]).T) > reach
                usable[part[far][:, 0], part[far][:, 1]] = True
                part = part[~far]
                if len(part) >= 2:
                    rec = rectangle(part, theta)
            if len(part) < 2:
                continue
        c, t, u, lo, hi, across, width = rec
        best = None
        for wide in [width - 0.5 * i for i in range(6) if width - 0.5 * i >= 0.5] or [width]:  # narrower rectangles may mean more
            for prob in (p, p / 2, p / 4):
                gy, gx = np.mgrid[max(int(c[0] - (hi - lo) - wide), 0) : min(int(c[0] + (hi - lo) + wide) + 2, rows), max(int(c[1] - (hi - lo) - wide), 0) : min(int(c[1] + (hi - lo) + wide) + 2, cols)]
                d = np.stack([gy - c[0], gx - c[1]], -1)
                al, ac = d @ u, d @ np.array([np.cos(t), -np.sin(t)])
                inside = (al >= lo - 0.5) & (al <= hi + 0.5) & (np.abs(ac) <= wide / 2)
                angles = angle[gy[inside], gx[inside]]
                k = int((_apart(angles, t) <= prob * pi).sum())
                value = log_nfa(int(inside.sum()), k, prob, tests)
                if best is None or value > best[0]:
                    best = (value, wide, prob)
        if best[0] > log_eps:
            a, b = c + u * lo + 0.5, c + u * hi + 0.5
            s = scale
            out.append((a[1] / s, a[0] / s, b[1] / s, b[0] / s, best[1] / s, best[2], best[0]))
    return out
