"""Plain-Python trajectories, to compare with."""

import math
from itertools import groupby

PI, RADIUS = 3.1415926, 6371393


def metres(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = (v * PI / 180 for v in (lat1, lon1, lat2, lon2))
    a = math.sin(abs(lat2 - lat1) / 2) ** 2
    a += math.cos(lat1) * math.cos(lat2) * math.sin(abs(lon2 - lon1) / 2) ** 2
    return 2 * math.asin(math.sqrt(a)) * RADIUS


def analyse(points, digits=6, swap=False):
    """``points`` are (ts, seq, lat, lon) of one trajectory; gives one dict per point, in order."""
    points = sorted(points)
    n, out = len(points), []
    for i, (ts, seq, lat, lon) in enumerate(points):
        row = {"seq": seq, "ts": ts, "id": i, "speed": 0.0}
        row["gap"] = (ts - points[i - 1][0]).total_seconds() if i else 0.0
        if 0 < i < n - 1:
            a, b = points[i - 1][2:], (lat, lon)
            dist = metres(a[1], a[0], b[1], b[0]) if swap else metres(*a, *b)
            row["speed"] = round(dist / row["gap"], digits) if row["gap"] else None
        out.append(row)
    for i, row in enumerate(out):
        slow = [r["speed"] is not None and r["speed"] < 0.4 for r in out[i : i + 2]]
        row["stop"] = int(any(slow))
        row["acc"] = 0.0
        if i:
            pair = (row["speed"], out[i - 1]["speed"])
            row["acc"] = None if None in pair or not row["gap"] else (pair[0] - pair[1]) / row["gap"]
        row["direct"] = 1 if row["acc"] is not None and row["acc"] > 0 else -1
        row["change"] = int(i > 0 and row["direct"] != out[i - 1]["direct"])
    for i, row in enumerate(out):
        row["in_range"] = i < n - 1 and not (row["change"] and out[i + 1]["change"])
        row["up"] = row["in_range"] and row["acc"] is not None and row["acc"] > 0
        row["down"] = row["in_range"] and row["acc"] is not None and row["acc"] < 0
    return out


def intervals(out):
    """(seq, range index) of the points in intervals."""
    kept, found = [r for r in out if r["in_range"]], []
    for i, row in enumerate(kept):
        near = kept[max(i - 1, 0) : i] + kept[i + 1 : i + 2]
        if any(r["direct"] == row["direct"] for r in near):
            index = sum(r["change"] for r in kept if r["ts"] <= row["ts"])
            if index:
                found.append((row["seq"], index))
    return found


def runs(out, least=2):
    """(seq, value, run number, length, member number)."""

    def value(row):
        if row["id"] in (0, len(out) - 1) or not row["acc"]:
            return None
        return 1 if row["acc"] > 0 else -1

    found, numbers = [], {1: 0, -1: 0}
    for v, group in groupby(out, value):
        members = list(group)
        if v and len(members) >= least:
            numbers[v] += 1
            found += [(r["seq"], v, numbers[v], len(members), i) for i, r in enumerate(members, 1)]
    return found
