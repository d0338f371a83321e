"""Record-by-record and window-by-window models of the semantics, for brute-force tests."""

import datetime as dt
from collections import defaultdict


def month_of(day):
    return day.replace(day=1)


def plus_months(month, k):
    n = month.year * 12 + month.month - 1 + k
    return dt.date(n // 12, n % 12 + 1, 1)


def replay(records, delay_days=1):
    """``records`` of ``(day, sales)`` in arrival order -> closed sums, late ones, open months.

    The closed sums come as a list in the order of emission.
    """
    state, emitted, late, watermark = defaultdict(float), [], [], None
    for day, sales in records:
        month = month_of(day)
        if watermark is not None and plus_months(month, 1) <= watermark:
            late.append((day, sales))
        else:
            state[month] += sales
        mark = day - dt.timedelta(days=delay_days)
        if watermark is None or mark > watermark:
            watermark = mark
            for done in sorted(m for m in state if plus_months(m, 1) <= watermark):
                emitted.append((done, state.pop(done)))
    return emitted, late, sorted(state)


def windows(months, size=17):
    """Complete sliding windows over ``[(month, sales)]``."""
    return [months[i - size:i] for i in range(size, len(months) + 1)]


def forecast(window, predict, mode, ranges=None):
    """Twelve ``(date, sales)`` of one window. ``predict`` takes a list of 11 features.

    ``ranges`` is the list of (low, high) of ``difference, lag_1 .. lag_11``.
    """
    def down(x, c):
        if ranges is None:
            return x
        low, high = ranges[c]
        width = (high - low) or 1.0
        return 2.0 * (x - low) / width - 1.0

    def up(y, c):
        if ranges is None:
            return y
        low, high = ranges[c]
        width = (high - low) or 1.0
        return (y + 1.0) / 2.0 * width + low

    sales = [s for _, s in window]
    diffs = [b - a for a, b in zip(sales, sales[1:])]
    last = window[-1][1]
    if mode == "compat":
        changes = []
        for end in range(10, 16):
            row = [diffs[end - k] for k in range(11)]
            changes.append(up(predict([down(x, c) for c, x in enumerate(row)]), 11))
        levels = [last + changes[0]] + [a + b for a, b in zip(changes, changes[1:])]
    else:
        known, levels = diffs[::-1][:11], []
        for _ in range(6):
            change = up(predict([down(x, c + 1) for c, x in enumerate(known)]), 0)
            levels.append((levels[-1] if levels else last) + change)
            known = [change] + known[:-1]
    ahead = [(plus_months(window[-1][0], k + 1), v) for k, v in enumerate(levels)]
    return window[-6:] + ahead


def result_table(months, predict, mode, ranges=None):
    """Upsert all windows' records by date, in window order."""
    table = {}
    for window in windows(months):
        table.update(forecast(window, predict, mode, ranges))
    return table
