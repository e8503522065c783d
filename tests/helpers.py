"""Small frames for tests, and brute-force answers in plain Python."""

from __future__ import annotations

import random

# 2019-05-21 09:26:40 UTC, in seconds; fixtures stay away from epoch 0
BASE_S = 1558430800
BASE_MS = BASE_S * 1000


def logins(spark, rows):
    """``(user, ip, kind, offset_ms)`` rows; ids number the rows."""
    return spark.createDataFrame(
        [(i, u, ip, kind, BASE_MS + at) for i, (u, ip, kind, at) in enumerate(rows)],
        "event_id bigint, user_id bigint, ip string, event_type string, event_time bigint",
    )


def orders(spark, rows):
    """``(order, kind, offset_ms)`` rows."""
    return spark.createDataFrame(
        [(i, o, kind, BASE_MS + at) for i, (o, kind, at) in enumerate(rows)],
        "event_id bigint, order_id bigint, event_type string, event_time bigint",
    )


def random_logins(seed, n=400, users=3, span_ms=60_000, hot=0.5):
    """Rows of which a share belongs to user 1 and many share an instant."""
    rng = random.Random(seed)
    return [
        (1 if rng.random() < hot else rng.randrange(2, 2 + users), f"ip{i}",
         rng.choice(["fail", "fail", "success"]), rng.randrange(0, span_ms // 250) * 250)
        for i in range(n)
    ]


def per_user(rows):
    """Rows of each user in (time, id) order: ``(time, id, ip, kind)``."""
    users = {}
    for i, (u, ip, kind, at) in enumerate(rows):
        users.setdefault(u, []).append((at, i, ip, kind))
    return {u: sorted(events) for u, events in users.items()}


def brute_sequences(rows, fails, within, consecutive=False):
    out = []
    for user, events in per_user(rows).items():
        for i, (at, start, _, kind) in enumerate(events):
            if kind != "fail" or i + 1 >= len(events) or events[i + 1][3] != "fail":
                continue
            seen, last = 1, None
            for t, _, _, k in events[i + 1:]:
                if k == "fail":
                    seen += 1
                elif consecutive:
                    break
                if seen == fails:
                    last = t
                    break
            if last is not None and last - at < within:
                out.append((user, start, events[i + 1][1], events[i + 1][2]))
    return sorted(out)


def brute_bursts(rows, reach, all_cut):
    """``(user, cut, [rows])`` of bursts of two or more."""
    out = []
    for user, events in per_user(rows).items():
        cuts = sorted({at + reach for at, _, _, kind in events if all_cut or kind == "fail"})
        waiting = [e for e in events if e[3] == "fail"]
        for cut in cuts:
            taken = [e for e in waiting if e[0] <= cut]
            waiting = waiting[len(taken):]
            if len(taken) > 1:
                out.append((user, cut, taken))
    return out


def brute_orders(rows, within):
    out = []
    groups = {}
    for i, (order, kind, at) in enumerate(rows):
        groups.setdefault(order, []).append((at, i, kind))
    for order, events in groups.items():
        events.sort()
        for n, (at, i, kind) in enumerate(events):
            if kind == "create":
                pay = next((t for t, _, k in events[n + 1:] if k == "pay"), None)
                ok = pay is not None and pay - at < within
                out.append((order, i, "success" if ok else "timeout"))
    return sorted(out)


def brute_sliding(rows, size, slide):
    """Counts of ``(key, ms)`` rows per key and window end."""
    out = {}
    for key, at in rows:
        start = at - at % slide
        while start > at - size:
            out[key, start + size] = out.get((key, start + size), 0) + 1
            start -= slide
    return sorted((k, end, n) for (k, end), n in out.items())
