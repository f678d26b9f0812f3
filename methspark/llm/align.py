"""Banded alignment of sequences of word hashes, many pairs at a time: one row of all their bands in each step."""

from __future__ import annotations

import numpy as np

ONE = 1 << 32  # scores are packed above 32 bits that count matches, so equal scores prefer more matches
CELLS = 1 << 14
MOVES = 1 << 23
LOOKED_UP = 1 << 18


class Block:
    """Pairs (a, b, lo, hi) side by side: column c of row i of a pair compares a[i] with b[i + lo + c], on diagonals lo to hi."""

    def __init__(self, pairs: list[tuple[np.ndarray, np.ndarray, int, int]]):
        self.length = np.array([len(a) for a, _, _, _ in pairs])
        self.width = np.array([hi - lo + 1 for _, _, lo, hi in pairs])
        n, w = int(self.length.max()), int(self.width.max())
        self.a = np.zeros((len(pairs), n), np.uint32)
        self.b = np.zeros((len(pairs), n + w), np.uint32)
        self.there = np.zeros((len(pairs), n + w), bool)
        for k, (a, b, lo, _) in enumerate(pairs):
            self.a[k, : len(a)] = a
            s, e = max(0, -lo), min(n + w, len(b) - lo)
            if e > s:
                self.b[k, s:e] = b[s + lo : e + lo]
                self.there[k, s:e] = True
        self.inside, self.shortest = np.arange(w) < self.width[:, None], int(self.length.min())
        # half as wide numbers where scores and matches fit
        self.kind, self.one = (np.int32, 1 << 16) if n + w < 32_000 else (np.int64, ONE)
        self.steps = np.arange(w, dtype=self.kind) * self.kind(self.one)
        self.least = self.kind(-(1 << (30 if self.kind is np.int32 else 60)))
        self.column = np.broadcast_to(np.arange(w, dtype=np.int32), (len(pairs), w))

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Which cells of row i exist, and which of them match."""
        w = self.inside.shape[1]
        cells = self.there[:, i : i + w] & self.inside
        if i >= self.shortest:
            cells &= (i < self.length)[:, None]
        return cells, cells & (self.b[:, i : i + w] == self.a[:, i : i + 1])

    def gain(self, equal: np.ndarray) -> np.ndarray:
        """What a match or a mismatch adds."""
        return equal.astype(self.kind) * self.kind(2 * self.one + 1) - self.kind(self.one)

    def along(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best scores with gap words of b before them, and the column each comes from."""
        lifted = score + self.steps
        top = np.maximum.accumulate(lifted, axis=1)
        return top - self.steps, np.maximum.accumulate((lifted == top) * self.column, axis=1)


def blocks(pairs: list[tuple], cells: int, area: int | None = None):
    """Numbers of pairs of like width and length, as many as fit in `cells` of a row and `area` of a block."""
    kind = [(pairs[k][3] - pairs[k][2] + 1).bit_length() for k in range(len(pairs))]
    order = sorted(range(len(pairs)), key=lambda k: (kind[k], len(pairs[k][0])))
    own, width = [], 0
    for k in order:
        n, w = len(pairs[k][0]), max(width, pairs[k][3] - pairs[k][2] + 1)
        if own and (kind[k] != kind[own[0]] or (len(own) + 1) * w > cells or n > 64 + 5 * len(pairs[own[0]][0]) // 4 or area and (len(own) + 1) * w * n > area):
            yield own
            own, w = [], pairs[k][3] - pairs[k][2] + 1
        own.append(k)
        width = w
    if own:
        yield own


def local(pairs: list[tuple[np.ndarray, np.ndarray, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Best local alignment of each pair on its diagonals (b's place less a's).

    (score, matches, start in a, end, start in b, end) each; ends are exclusive. Score: 1 for a match, -1 for a
    mismatch or a gap word; ties go to more matches, then to the earliest end in a, then b."""
    out: list = [(0, 0, 0, 0, 0, 0)] * len(pairs)
    for own in blocks(pairs, CELLS):
        block = Block([pairs[k] for k in own])
        n, w = len(own), block.inside.shape[1]
        one, score = block.one, np.zeros((n, w + 1), block.kind)
        start = np.zeros((n, w + 1), np.int32 if block.a.shape[1] * w < 1 << 31 else np.int64)
        fresh_at, corner = np.arange(w, dtype=start.dtype), np.arange(n)[:, None] * w
        best, begin, end = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(block.a.shape[1]):
            cells, equal = block.row(i)
            gone = ~cells
            d = score[:, :w]
            fresh = d < one
            s = np.where(fresh, fresh_at, start[:, :w])
            fresh_at += w
            d = np.where(fresh, block.kind(0), d)
            d += block.gain(equal)
            up = score[:, 1:] - block.kind(one)
            take = up > d
            np.copyto(d, up, where=take)
            np.copyto(s, start[:, 1:], where=take)
            d[gone] = block.least
            d, source = block.along(d)
            s = s.ravel().take(source + corner)
            d[gone] = 0
            np.maximum(d, 0, out=d)
            top = d.max(1)
            better = np.flatnonzero(top > best)
            if len(better):
                k = d[better].argmax(1)
                best[better], begin[better], end[better] = top[better], s[better, k], i * w + k
            score[:, :w], start[:, :w] = d, s
        for x, k in enumerate(own):
            if best[x]:
                lo, (i, c), (j, e) = pairs[k][2], divmod(int(begin[x]), w), divmod(int(end[x]), w)
                out[k] = (int(best[x]) // one, int(best[x]) % one, i, j + 1, i + lo + c, j + lo + e + 1)
    return out


def matched_places(pairs: list[tuple[np.ndarray, np.ndarray, int, int]], free: bool = False) -> list[np.ndarray]:
    """The place in b of each word of a that matches, else -1, in a best alignment of all of a with all of b on the pair's diagonals.

    free: with any part of b, the first of equals."""
    out: list = [None] * len(pairs)
    for own in blocks(pairs, CELLS, MOVES):
        block = Block([pairs[k] for k in own])
        n, w = len(own), block.inside.shape[1]
        origin = np.array([-pairs[k][2] for k in own])
        least = block.least
        score = np.full((n, w + 1), least, block.kind)
        fits = (origin >= 0) & (origin < block.width)
        if free:
            score[:, :w] = 0
        score[np.flatnonzero(fits), origin[fits]] = 0  # before both: no word of a, none of b
        c = np.array([len(pairs[k][1]) - len(pairs[k][0]) - pairs[k][2] for k in own])
        moves, sources = [], []
        for i in range(block.a.shape[1]):
            cells, equal = block.row(i)
            d, up = score[:, :w] + block.gain(equal), score[:, 1:] - block.kind(block.one)
            moves.append(np.where(up > d, 2, equal).astype(np.int8))  # 0 a mismatch, 1 a match, 2 a word of a alone
            d = np.where(cells, np.maximum(d, up), least)
            d, source = block.along(d)
            sources.append(source.astype(np.int16 if w < 1 << 15 else np.int32))
            score[:, :w] = np.where(cells, np.maximum(d, least), least)
            done = np.flatnonzero(block.length == i + 1)
            if free and len(done):
                c[done] = score[done, :w].argmax(1)
        places = np.full(block.a.shape, -1)
        for i in range(block.a.shape[1] - 1, -1, -1):
            on = np.flatnonzero((i < block.length) & (c >= 0) & (c < block.width))
            if len(on):
                from_ = sources[i][on, c[on]].astype(np.int64)
                move = moves[i][on, from_]
                places[on, i] = np.where(move == 1, i - origin[on] + from_, -1)
                c[on] = from_ + (move == 2)
        for x, k in enumerate(own):
            out[k] = places[x, : block.length[x]]
    return out


def dense(flags: np.ndarray, least: int, share: float) -> list[tuple[int, int]]:
    """Disjoint intervals of at least `least` places, `share` of them true, their ends true: the longest, then so in what lies before and after it."""
    if len(flags) < least:
        return []
    total = np.concatenate(([0.0], np.cumsum(flags - share)))
    low = np.minimum.accumulate(np.where(flags, total[:-1], np.inf))
    ends = np.flatnonzero(flags[least - 1 :]) + least
    # the first start from which the sum up to each end is not negative
    begins = np.searchsorted(-low, -(total[ends] + 1e-6), side="left")
    size = np.where(ends - begins >= least, ends - begins, 0)
    if not size.any():
        return []
    k = int(size.argmax())
    s, e = int(begins[k]), int(ends[k])
    return [*dense(flags[:s], least, share), (s, e), *((x + e, y + e) for x, y in dense(flags[e:], least, share))]


def straight(flags: np.ndarray) -> tuple[int, int, int, int]:
    """(score, matches, start, end) of the best local alignment on one diagonal, where flags tell which words match: as local() finds it."""
    total = np.concatenate(([0], np.cumsum(np.where(flags, 1, -1))))
    low = np.minimum.accumulate(total)
    e = int((total - low).argmax())
    s = int(np.flatnonzero(total[: e + 1] == low[e])[-1])
    return int(total[e] - low[e]), int(flags[s:e].sum()), s, e


def along_diagonal(flags: np.ndarray, least: int, share: float) -> list[tuple[int, int, int]]:
    """As passages(), for a band of one diagonal."""
    if len(flags) < least:
        return []
    score, matched, s, e = straight(flags)
    if score <= 0 or score < (3 * share - 2) * least:
        return []
    own = [(s, e, matched)] if e - s >= least and matched >= share * (e - s) else [(s + x, s + y, int(flags[s + x : s + y].sum())) for x, y in dense(flags[s:e], least, share)]
    return [*along_diagonal(flags[:s], least, share), *own, *((x + e, y + e, n) for x, y, n in along_diagonal(flags[e:], least, share))]


def within_band(pairs: list[tuple[np.ndarray, np.ndarray, int, int]]) -> list[np.ndarray]:
    """Which words of each pair's a stand in its b on one of the pair's diagonals."""
    place = lambda n: np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    n, m = (np.array([len(p[side]) for p in pairs]) for side in (0, 1))
    of, at = np.repeat(np.arange(len(pairs)), n), place(n)
    a, b = ((np.repeat(np.arange(len(pairs)), size) << 32) | np.concatenate([p[side] for p in pairs]).astype(np.int64) for side, size in ((0, n), (1, m)))
    order = np.argsort(b, kind="stable")  # by pair and word, then by place
    word, number = np.unique(b[order], return_inverse=True)
    own = np.minimum(np.searchsorted(word, a), len(word) - 1)
    to = place(m)[order]
    lo, hi = (np.array([p[side] for p in pairs])[of] + at for side in (2, 3))
    next_ = np.minimum(np.searchsorted((number << 32) | to, (own << 32) | np.maximum(lo, 0)), len(to) - 1)
    return np.split((word[own] == a) & (number[next_] == own) & (to[next_] >= lo) & (to[next_] <= hi), np.cumsum(n)[:-1])


def hopeful(flags: np.ndarray, least: int, share: float) -> bool:
    """Whether `share` of some `least` or more consecutive places are true."""
    total = np.concatenate(([0.0], np.cumsum(flags - share)))
    return bool((total[least:] - np.minimum.accumulate(total)[: len(total) - least]).max() > -1e-3)


def passages(pairs: list[tuple[np.ndarray, np.ndarray, int, int]], least: int, share: float) -> list[list[tuple[int, int, int]]]:
    """(start, end, matches) in each pair's a, in order: disjoint passages of at least `least` words, `share` of which match b on the band.

    The best local alignment, or its parts that pass if it does not as a whole; then so what lies before and after it in both.
    What has too few words that stand in b at all, on the band, holds no passage and is not aligned."""
    out: list = [[] for _ in pairs]
    todo = [(k, 0, *p) for k, p in enumerate(pairs)]
    while todo:
        ready = []
        for k, at, a, b, lo, hi in todo:
            if len(a) < least or not len(b) or hi < lo:
                continue
            if len(a) == len(b) and lo <= 0 <= hi and (a == b).all():
                out[k].append((at, at + len(a), len(a)))
            elif lo == hi:
                flags, i, j = np.zeros(len(a), bool), max(0, -lo), min(len(a), len(b) - lo)
                if j > i:
                    flags[i:j] = a[i:j] == b[i + lo : j + lo]
                out[k] += along_diagonal(flags, least, share)
            else:
                ready.append((k, at, a, b, lo, hi))
        if ready:
            size = np.cumsum([len(a) + len(b) for _, _, a, b, _, _ in ready]) // LOOKED_UP
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(ready)]
            ready = [x for s, e in zip(cuts, cuts[1:], strict=False) for x, flags in zip(ready[s:e], within_band([x[2:] for x in ready[s:e]]), strict=True) if hopeful(flags, least, share)]
        todo, part = [], []
        for (k, at, a, b, lo, hi), (score, matched, s, e, c, d) in zip(ready, local([x[2:] for x in ready]), strict=True):
            # a passage with m of n words matched has at most n - m words of a alone and hi - lo more of b alone: no lower score than this
            if score <= 0 or score < (3 * share - 2) * least - (hi - lo):
                continue
            if e - s >= least and matched >= share * (e - s):
                out[k].append((at + s, at + e, matched))
            elif e - s >= least:
                part.append((k, at + s, a[s:e], b[c:d], lo + s - c, hi + s - c))
            todo += [(k, at, a[:s], b[:c], lo, hi), (k, at + e, a[e:], b[d:], lo + e - d, hi + e - d)]
        for (k, at, *_), places in zip(part, matched_places([x[2:] for x in part]), strict=True):
            flags = places >= 0
            out[k] += [(at + x, at + y, int(flags[x:y].sum())) for x, y in dense(flags, least, share)]
    return [sorted(x) for x in out]
