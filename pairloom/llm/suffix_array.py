"""Suffix arrays of shards by recursive induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classified, their leftmost-smaller substrings are sorted by induction and named, the string of names is
sorted by the same procedure unless all names differ, and the order found induces that of all suffixes. Over a small
alphabet the induction walks the buckets and handles a bucket's entries at once; over a large one, as names are, it is
the plain scan. Either way its work is linear in the string.
"""

from __future__ import annotations


def classify(t):
    """(smaller-type flags, positions of leftmost smaller suffixes); the last symbol must be the unique smallest."""
    import numpy as np

    n = len(t)
    d = t[1:].astype(np.int32) - t[:-1]
    step = np.where(d != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(step[::-1])[::-1]
    small = np.r_[d[np.minimum(following, n - 2)] > 0, True] if n > 1 else np.ones(1, bool)
    return small, np.flatnonzero(small[1:] & ~small[:-1]) + 1


def induce(t, lms, sigma: int):
    """The order of all suffixes of ``t`` that its leftmost-smaller suffixes, given in order, induce."""
    import numpy as np

    n = len(t)
    if 16 * sigma > n:
        return _scan(t, lms, sigma)
    seeds = t[lms]
    order = np.argsort(seeds, kind="stable")
    cut = np.searchsorted(seeds[order], np.arange(sigma + 1))
    lms = lms[order]
    queue: list[list] = [[] for _ in range(sigma)]
    larger, smaller = [None] * sigma, [None] * sigma
    none = np.zeros(0, np.int64)

    def deal(source, c: int, up: bool):
        y = source[source > 0] - 1
        s = t[y]
        ok = s > c if up else s < c
        y, s = y[ok], s[ok]
        if len(y):
            o = np.argsort(s, kind="stable")
            y, s = y[o], s[o]
            at = np.r_[0, np.flatnonzero(s[1:] != s[:-1]) + 1, len(s)]
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                queue[s[a]].append(y[a:b])

    def chain(c: int):
        x = np.concatenate(queue[c]) if queue[c] else none
        out = [x]
        while len(x):
            y = x[x > 0] - 1
            x = y[t[y] == c]
            out.append(x)
        return np.concatenate(out)

    for c in range(sigma):
        larger[c] = chain(c)
        queue[c] = []
        own = lms[cut[c] : cut[c + 1]]
        if len(larger[c]) or len(own):
            deal(np.concatenate([larger[c], own]), c, True)
    queue[t[n - 1]].append(np.array([n - 1]))
    for c in reversed(range(sigma)):
        down = chain(c)
        smaller[c] = down[::-1]
        if len(down) or len(larger[c]):
            deal(np.concatenate([down, larger[c][::-1]]), c, False)
    return np.concatenate([x for c in range(sigma) for x in (larger[c], smaller[c])])


def words_at(t):
    """The eight symbols (below 256 after the shift that callers make) from every position, packed; zeros behind the end."""
    import numpy as np

    p = np.r_[t.astype(np.uint64), np.zeros(8, np.uint64)]
    w = p[:-7].copy()
    for k in range(1, 8):
        w = (w << np.uint64(8)) | p[k : len(p) - 7 + k]
    return w[: len(t)]


def _equal(words, a, b, length):
    """Whether the ``length`` symbols from each a and b agree."""
    import numpy as np

    same, last = np.ones(len(a), bool), len(words) - 1
    todo, done = np.arange(len(a)), 0
    while len(todo):
        left = length[todo] - done
        x, y = words[np.minimum(a[todo] + done, last)], words[np.minimum(b[todo] + done, last)]
        drop = (8 * np.clip(8 - left, 0, 8)).astype(np.uint64)
        eq = np.where(drop >= 64, True, (x >> np.minimum(drop, 63)) == (y >> np.minimum(drop, 63)))
        same[todo[~eq]] = False
        todo = todo[eq & (left > 8)]
        done += 8
    return same


def _scan(t, lms, sigma: int):
    """``induce`` one suffix at a time."""
    import numpy as np

    ends = np.cumsum(np.bincount(t, minlength=sigma))
    head, tail, small = [0, *ends[:-1].tolist()], ends.tolist(), classify(t)[0].tolist()
    n, t, out = len(t), t.tolist(), [-1] * len(t)
    for x in reversed(lms.tolist()):
        tail[t[x]] -= 1
        out[tail[t[x]]] = x
    for i in range(n):
        x = out[i] - 1
        if x >= 0 and not small[x]:
            out[head[t[x]]] = x
            head[t[x]] += 1
    tail = ends.tolist()
    for i in range(n - 1, -1, -1):
        x = out[i] - 1
        if x >= 0 and small[x]:
            tail[t[x]] -= 1
            out[tail[t[x]]] = x
    return np.array(out)


def _same(t, a, b, length):
    """``_equal`` for symbols of any size."""
    import numpy as np

    same, todo, last = np.ones(len(a), bool), np.arange(len(a)), len(t) - 1
    for k in range(int(length.max()) if len(length) else 0):
        todo = todo[length[todo] > k]
        if not len(todo):
            break
        eq = t[np.minimum(a[todo] + k, last)] == t[np.minimum(b[todo] + k, last)]
        same[todo[~eq]] = False
        todo = todo[eq]
    return same


def suffix_array(t):
    """Positions of ``t`` (symbols from 0; the last one the unique smallest) in the order of their suffixes."""
    import numpy as np

    sigma = int(t.max()) + 1
    _, lms = classify(t)
    if len(lms) == 0:
        return induce(t, lms, sigma)
    first = induce(t, lms, sigma)
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    by_substring = first[is_lms[first]]
    until = np.full(len(t), 0)
    until[lms] = np.r_[lms[1:], len(t) - 1]  # where the substring ends: at the next leftmost smaller position
    length = until[by_substring] - by_substring + 1
    a, b, least = by_substring[1:], by_substring[:-1], np.minimum(length[1:], length[:-1])
    agree = _equal(words_at(t), a, b, least) if t.dtype == np.uint8 else _same(t, a, b, least)
    name = np.cumsum(np.r_[True, ~((length[1:] == length[:-1]) & agree)]) - 1
    if int(name[-1]) + 1 == len(lms):
        return induce(t, by_substring, sigma)
    names = np.empty(len(t), np.int64)
    names[by_substring] = name
    return induce(t, lms[suffix_array(names[lms])], sigma)


def common_prefixes(t, order, most: int):
    """The permuted common prefixes: for each position in text order its common prefix, up to ``most``, with its forerunner.

    ``order`` has all suffixes or some of them, sorted; the forerunner is the one before in it. -1: none, or not in it.
    """
    import numpy as np

    words, last = words_at(t), len(t) - 1
    before = np.full(len(t), -1)
    before[order[1:]] = order[:-1]
    out = np.full(len(t), -1, np.int64)
    todo = np.flatnonzero(before >= 0)
    out[todo] = 0
    other = before[todo]
    for done in range(0, most, 8):
        if not len(todo):
            break
        x = words[np.minimum(todo + done, last)] ^ words[np.minimum(other + done, last)]
        inside = np.maximum(todo, other) + done <= last
        whole = (x == 0) & inside
        odd = inside & ~whole
        y, same = x[odd], np.zeros(int(odd.sum()), np.int64)
        for k in range(1, 8):  # leading equal symbols of the word
            same += (y >> np.uint64(8 * (8 - k))) == 0
        out[todo[odd]] = done + same
        out[todo[inside & whole]] = done + 8
        todo, other = todo[whole], other[whole]
    return np.minimum(out, most)
