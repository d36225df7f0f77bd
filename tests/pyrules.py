"""Plain-Python pairing rules: an independent test oracle (tests only).

Each takes one key's events as (times, register) pairs and returns the
list of (enter, exit) stays.  Events are ordered by (times, register), a
null code first.
"""

ENTER, EXIT = 1, 2


def _sorted(events):
    return sorted(events, key=order)


def order(event):
    """By time, then code; a null code comes first."""
    t, r = event
    return t, r is not None, r or 0


def robust(events):
    rows = _sorted(events)
    out, inside, enter = [], False, None
    for i, (t, r) in enumerate(rows):
        if r == ENTER:
            if not inside:
                inside, enter = True, t
        elif r == EXIT and inside:
            nxt_enter = i == len(rows) - 1 or rows[i + 1][1] == ENTER
            if nxt_enter:
                out.append((enter, t))
                inside, enter = False, None
    return out


def adjacent(events):
    rows = _sorted(events)
    return [(rows[i - 1][0], t) for i, (t, r) in enumerate(rows)
            if i > 0 and r == EXIT and rows[i - 1][1] == ENTER]


def ordinal(events):
    rows = _sorted(events)
    en = [t for t, r in rows if r == ENTER]
    ex = [t for t, r in rows if r == EXIT]
    return list(zip(en, ex))


def first_exit(events):
    rows = _sorted(events)
    out = set()
    for i, (t, r) in enumerate(rows):
        if r != ENTER or (i > 0 and rows[i - 1][1] == ENTER):
            continue
        later = [u for u, s in rows if s == EXIT and u >= t]
        if later:
            out.add((t, min(later)))
    return sorted(out)


RULES = {"robust": robust, "adjacent": adjacent, "ordinal": ordinal, "first_exit": first_exit}


def contacts(stays_by_phone, subjects, include):
    """stays: list of (phone, cellid, enter, exit)."""
    subj = [s for s in stays_by_phone if s[0] in subjects]
    out = set()
    for p, c, e, x in stays_by_phone:
        for _, sc, se, sx in subj:
            if sc == c and e <= sx and x >= se:
                out.add(p)
                break
    if not include:
        out -= set(subjects)
    return sorted(out)
