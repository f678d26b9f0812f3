"""Exact n-gram Jaccard self-join by universe-partition pigeonhole.

A text's set are its distinct shingles (hashes of ``size`` words). Sets are banded by size; for each
band the hash universe is cut into segments, more than two linked sets can differ in. So two linked
sets agree on at least one segment; a document is indexed under the hash of what it has in each. A
one-deletion segment is indexed under all its subsets with one shingle less, too, and so counts twice;
``allocate`` picks how many of each kind cost least. A few segments are spare: each set leaves out that
many of its exact ones, those with the fewest infrequent shingles first, in an order all sets agree on,
so the best segment two linked sets agree on is never left out.

Equal sets are one node. The nodes of one index hash meet as a unit, named by the hash's least node or,
if hot, by the hash itself. A unit is resolved without pairing its nodes: its centre are the shingles
more than half of its nodes hold, and each set is written as its differences from the centre. Two sets
whose differences are few in sum are surely linked, and then both with the node of fewest differences;
all other linked pairs must share a certain number of differences, which few nodes do and which are
counted over lists of the nodes that share each. A list that is long itself is a unit with a centre of
its own, of half the nodes at most. Units too large for a task are split so by Spark, round by round.
Sets are compared as wholes, by 64-bit hashes of their shingles.

Defined results: null, empty and wordless texts have an empty set and are linked with nothing (their
component is their own id); shorter texts than a shingle have their whole word sequence as one; null ids
take no part in the choice of a component's id; repeated rows are one node; an empty table gives no row;
extra columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import Sieve, components, shared
from ._text import SPACED, U, chunks, mix, table, thrifty

SHINGLE = 4
PERCENT = 85
SAMPLE_ROWS = 4_096
HOT_SHARE = 0.002
FLUSH = 1_000_000
HOT_ROWS = 256
UNIT_SHINGLES = 2_000_000
TASK_SHINGLES = 1_000_000
LONG_LIST = 256


def shingles(words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and their texts."""
    at, h = words.windows(size)
    doc = words.doc[at]
    for n in range(1, size):
        few = np.flatnonzero(words.count == n)
        if len(few):
            start, short = words.windows(n)
            keep = np.isin(words.doc[start], few)
            doc, h = np.concatenate((doc, words.doc[start][keep])), np.concatenate((h, short[keep]))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.empty(0, bool)
    return doc[new], h[new]


def set_hash(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and a 63-bit hash of each set (0: empty)."""
    size = np.bincount(doc, minlength=n)
    total = np.zeros(n, U)
    if len(h):
        at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        total[doc[at]] = np.add.reduceat(mix(h ^ U(0xA0761D6478BD642F)), at)
    node = np.where(size > 0, (mix(total + size.astype(U)) >> U(1)) | U(1), U(0))
    return size, node.astype(np.int64)


def bands(percent: int, most: int) -> list[int]:
    """Lower ends of the size bands; a set and any larger one it links with lie in one band or two neighbours."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * 100 // percent + 1)
    return out


def differences(band_end: int, percent: int) -> int:
    """In how many elements two linked sets can differ, when the smaller has fewer than band_end."""
    small = band_end - 1
    return (100 - percent) * (small + small * 100 // percent) // (100 + percent)


@cache
def allocate(h: int, size: int, sets: float, agree: float) -> tuple[int, int, int]:
    """(exact segments, one-deletion segments, spare): least index entries plus expected chance pairs.

    agree: the chance that a set's shingle also lies in another set."""
    spare = 1 + h // 8
    need, best = h + 1 + spare, None
    for deletion in range(need // 2 + 1):
        exact = need - 2 * deletion
        per = size / need
        entries = exact + deletion * (2 + 2 * per)
        chance = exact * agree**per + deletion * (2 * per + 1) * agree ** max(0.0, 2 * per - 1)
        cost = entries + sets * chance / 2
        if best is None or cost < best[0]:
            best = (cost, exact, deletion)
    return best[1], best[2], spare


class Plan:
    def __init__(self, percent: int, most: int, sets: float, agree: float, hot: np.ndarray):
        self.percent, self.low, self.hot = percent, bands(percent, most), hot
        self.plan = []
        for b in range(len(self.low) - 1):
            h = differences(self.low[b + 1], percent)
            self.plan.append((h, *allocate(h, self.low[b], round(sets / len(self.low), -2), round(agree, 3))))

    def entries(self, doc: np.ndarray, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index hashes and the text of each."""
        out = [(np.empty(0, U), np.empty(0, np.int64))]
        low = np.array(self.low)
        own = np.searchsorted(low, size, side="right") - 1
        cold = ~np.isin(h, self.hot)
        for back in (0, 1):
            band = own - back
            fits = (size > 0) & (band >= 0)
            if back:  # only as the larger of two
                fits &= size * self.percent <= (low[np.maximum(own, 0)] - 1) * 100
            number = np.array([x[0] for x in self.plan])
            fits &= number[np.maximum(band, 0)] > 0
            out += self._band(doc, h, cold, fits, np.maximum(band, 0))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _band(self, doc, h, cold, fits, band):
        exact, deletion, spare = (np.array([x[k] for x in self.plan])[band] * fits for k in (1, 2, 3))
        weight, count = exact + 2 * deletion, exact + deletion
        first = np.concatenate(([0], np.cumsum(count)))
        keep = fits[doc]
        d, x, c = doc[keep], h[keep], cold[keep]
        if not len(d):
            return
        unit = ((x >> U(32)) * weight[d].astype(U) >> U(32)).astype(np.int64)
        seg = np.where(unit < exact[d], unit, exact[d] + (unit - exact[d]) // 2)
        key = first[d] + seg
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        part = mix(x)
        total, cold_n = np.zeros(first[-1], U), np.zeros(first[-1], np.int64)
        total[key[at]] = np.add.reduceat(part, at)
        cold_n[key[at]] = np.add.reduceat(c.astype(np.int64), at)
        of = np.repeat(np.arange(len(count)), count)
        number = np.arange(first[-1]) - first[of]
        tag = mix(band[of].astype(U) * U(1 << 24) + number.astype(U) + U(1))
        entry, single = mix(total + tag), number < exact[of]
        # the spare ones: least infrequent shingles, then fewest; all of this follows from the segment's content
        order = np.lexsort((entry, np.bincount(key, minlength=len(of)), cold_n, ~single, of))
        emit = np.ones(len(of), bool)
        emit[order] = np.arange(len(of)) - first[of[order]] >= np.minimum(spare, np.maximum(exact - (deletion == 0), 0))[of[order]]
        yield entry[emit], of[emit]
        twice = np.flatnonzero(~single[key])
        if len(twice):
            yield mix(total[key[twice]] - part[twice] + tag[key[twice]]), of[key[twice]]


def _blobs(bucket: np.ndarray, n: int, *arrays: np.ndarray) -> list[tuple]:
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(1, n))
    return [(b, *(x.tobytes() for x in parts)) for b, parts in enumerate(zip(*(np.split(a[order], cut) for a in arrays), strict=True)) if len(parts[0])]


def _frequent(own: DataFrame, n_docs: int, size: int, sample_rows: int, hot_share: float) -> tuple[np.ndarray, float, int]:
    """Frequent shingles, the chance of agreement and the largest set in a bounded sample; these set costs, not results."""
    sample = own.where(F.expr(f"pmod(xxhash64(text, 11), 1000000) < {int(np.ceil(1e6 * min(1.0, sample_rows / max(1, n_docs))))}"))

    def count(batches):
        for batch in batches:
            for _, j, words in chunks(batch.column("text"), SPACED):
                doc, h = shingles(words, size)
                u, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    least = max(20, int(hot_share * min(n_docs, sample_rows)))
    counts = sample.mapInArrow(thrifty(count), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    hot = counts.where(F.col("n") >= least).toLocalIterator()
    rows = [(r["h"], r["n"]) for r in hot]
    seen = np.array([r[1] for r in rows], float)
    agree = min(0.9, float((seen**2).sum() / max(1.0, seen.sum()) / max(1, min(n_docs, sample_rows)))) if len(rows) else 1e-3
    return np.sort(np.array([r[0] for r in rows], np.int64).view(U)), agree


def nodes_of(own: DataFrame, kind: str, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i, j, words in chunks(batch.column("text"), SPACED):
                n, node = set_hash(*shingles(words, size), j - i)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(node)], ["id", "n_shingles", "node"])

    return own.mapInArrow(thrifty(run), f"id {kind}, n_shingles long, node long")


def index_units(own: DataFrame, plan, size: int, buckets: int) -> DataFrame:
    """(unit, node), distinct: the nodes that meet under one index hash, for hashes of several nodes."""

    def index(batches):
        held, total, seen = [], 0, np.empty(0, np.int64)

        def flush():
            h, node = (np.concatenate(x) for x in zip(*held, strict=True))
            _, at, n = np.unique(h, return_inverse=True, return_counts=True)
            hot = n[at] > HOT_ROWS
            # a hot hash's nodes go anywhere, and node 0 tells its bucket that it is hot
            marks = np.unique(h[hot])
            rows = [(b, False, *x) for b, *x in _blobs(np.concatenate((h[~hot], marks)).view(np.int64) % buckets, buckets, np.concatenate((h[~hot], marks)), np.concatenate((node[~hot], np.zeros(len(marks), np.int64))))]
            rows += [(b, True, *x) for b, *x in _blobs((node[hot] >> 1) % buckets, buckets, h[hot], node[hot])]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], ["bucket", "hot", "hashes", "nodes"])

        for batch in batches:
            for i, j, words in chunks(batch.column("text"), SPACED):
                doc, h = shingles(words, size)
                n, node = set_hash(doc, h, j - i)
                _, first = np.unique(node, return_index=True)
                first = first[~np.isin(node[first], seen)]
                seen = np.concatenate((seen, node[first]))
                new = np.zeros(j - i, bool)
                new[first] = True
                keep = new[doc]
                entry, of = plan.value.entries(doc[keep], h[keep], np.where(new, n, 0))
                if len(entry):
                    held.append((entry, node[of]))
                    total += len(entry)
                if total > FLUSH:
                    yield flush()
                    held, total, seen = [], 0, np.empty(0, np.int64)
        if held:
            yield flush()

    def meet(rows: pa.Table) -> pa.Table:
        hot = np.array(rows["hot"].to_pylist(), bool)
        parts = [(np.frombuffer(h, U), np.frombuffer(n, np.int64)) for h, n in zip(rows["hashes"].to_pylist(), rows["nodes"].to_pylist(), strict=True)]
        none = (np.empty(0, U), np.empty(0, np.int64))
        far_h, far = (np.concatenate(x) for x in zip(none, *[p for p, k in zip(parts, hot, strict=True) if k], strict=True))
        h, node = (np.concatenate(x) for x in zip(none, *[p for p, k in zip(parts, hot, strict=True) if not k], strict=True))
        order = np.lexsort((node, h))
        h, node = h[order], node[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (node[1:] != node[:-1])))[: len(h)]
        h, node = h[new], node[new]
        start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))[: len(h)])
        length = np.diff(np.append(start, len(h)))
        first = np.repeat(node[start], length)
        keep = (np.repeat(length, length) > 1) & (node > 0)
        name = lambda h: ((h >> U(2)) << U(1)).astype(np.int64)  # noqa: E731  even; nodes are odd
        unit = np.concatenate((np.where(first > 0, first, name(h))[keep], name(far_h)))
        pairs = np.unique(np.stack((unit, np.concatenate((node[keep], far))), 1), axis=0)
        return pa.table({"unit": pa.array(pairs[:, 0]), "node": pa.array(pairs[:, 1])})

    sent = own.select("text").mapInArrow(thrifty(index), "bucket int, hot boolean, hashes binary, nodes binary")
    return sent.groupBy("bucket").applyInArrow(thrifty(meet), "unit long, node long").distinct()


def texts_of(own: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """(node, text) of the nodes in `needed`, which is stored and distinct."""
    sieve = Sieve(needed)

    def texts(batches):
        for batch in batches:
            for i, j, words in chunks(batch.column("text"), SPACED):
                _, node = set_hash(*shingles(words, size), j - i)
                _, first = np.unique(node, return_index=True)
                first = first[node[first] > 0]
                keep = first[sieve.passes(node[first])]
                yield pa.RecordBatch.from_arrays([pa.array(node[keep]), batch.column("text").slice(i, j - i).take(pa.array(keep))], ["node", "text"])

    return own.select("text").mapInArrow(thrifty(texts), "node long, text string").groupBy("node").agg(F.first("text").alias("text")).join(needed, "node", "left_semi")


def resolve(unit: np.ndarray, node: np.ndarray, doc: np.ndarray, h: np.ndarray, percent: int) -> list[np.ndarray]:
    """Links (two arrays of nodes) that join all linked nodes of each unit. doc, h: the rows' shingles."""
    lose, take = 100 - percent, 100 + percent
    _, unit = np.unique(unit, return_inverse=True)
    size = np.bincount(doc, minlength=len(node))
    members = np.bincount(unit)
    order = np.lexsort((h, unit[doc]))
    doc, h = doc[order], h[order]
    of = unit[doc]
    new = np.concatenate(([True], (of[1:] != of[:-1]) | (h[1:] != h[:-1])))
    run, start = np.cumsum(new) - 1, np.flatnonzero(new)
    count = np.diff(np.append(start, len(h)))
    central = 2 * count > members[of[start]]
    centre = np.bincount(of[start], central, len(members)).astype(np.int64)[unit]
    hit = np.bincount(doc, central[run], len(node)).astype(np.int64)
    # linked: take * differences <= lose * (size + size), where differences = own + own - 2 * shared
    cost = take * (size + centre - 2 * hit) - lose * size
    order = np.lexsort((node, cost, unit))
    head = order[np.flatnonzero(np.diff(unit[order], prepend=-1))][unit]
    rows = np.arange(len(node))
    sure = (cost + cost[head] <= 0) & (head != rows)
    out = [np.stack((node[head[sure]], node[sure]))]
    common = np.bincount(doc, ~central[run] & (count[run] > 1), len(node)).astype(np.int64) + centre - hit
    live = cost + cost[head] <= 2 * take * common
    others = np.bincount(unit[live & ~sure & (head != rows)], minlength=len(members))
    live &= (others > 0)[unit]
    for u in np.flatnonzero((others > 0) & (np.bincount(unit[live], minlength=len(members)) > 1)).tolist():
        mine = np.flatnonzero(live & (unit == u))
        label = np.where(sure[mine] | (head[mine] == mine), head[mine], mine)
        a, b = np.searchsorted(of, (u, u + 1))
        out += differing(mine, label, cost, node, doc[a:b], h[a:b], central[run[a:b]], percent)
    return out


def differing(mine, label, cost, node, doc, h, central, percent) -> list[np.ndarray]:
    """Links between rows `mine` of one unit with different labels, by the differences they share. doc, h, central: the unit's shingles by hash."""
    take, out = 2 * (100 + percent), []
    label, cost, names = label.copy(), cost[mine], node[mine]
    place = np.full(max(int(doc.max()), int(mine.max())) + 1, -1)
    place[mine] = np.arange(len(mine))
    kept = place[doc] >= 0
    mine_doc, mine_h, mine_central = place[doc[kept]], h[kept], central[kept]
    code, item = np.unique(mine_h, return_inverse=True)
    middle = np.unique(h[central])
    # differences: own shingles outside the centre, and the centre's shingles that a row lacks
    has = np.searchsorted(middle, mine_h[mine_central])
    lacks = np.ones((len(mine), len(middle)), bool) if len(mine) * len(middle) < 10_000_000 else None
    if lacks is not None:
        lacks[mine_doc[mine_central], has] = False
        who, what = np.nonzero(lacks)
    else:
        own = np.sort(mine_doc[mine_central].astype(np.int64) * len(middle) + has)
        whole = [np.setdiff1d(np.arange(r * len(middle), (r + 1) * len(middle)), own[slice(*np.searchsorted(own, (r * len(middle), (r + 1) * len(middle))))], assume_unique=True) for r in range(len(mine))]
        whole = np.concatenate(whole)
        who, what = whole // len(middle), whole % len(middle)
    row = np.concatenate((mine_doc[~mine_central], who))
    item = np.concatenate((item[~mine_central], len(code) + what))
    alive = np.ones(len(mine), bool)
    while True:  # rows that share too few differences go, and what only they shared
        keep = alive[row]
        row, item = row[keep], item[keep]
        n = np.bincount(item, minlength=len(code) + len(middle))
        keep = n[item] > 1
        row, item = row[keep], item[keep]
        least = cost[alive].min() if alive.any() else 0
        still = alive & (cost + least <= take * np.bincount(row, minlength=len(mine)))
        if still.sum() == alive.sum():
            break
        alive = still
    if len(np.unique(label[alive])) < 2:
        return out

    def join(x, others):
        for c in np.unique(label[others]):
            if c != label[x]:
                y = others[label[others] == c][0]
                out.append(np.array([[names[x]], [names[y]]]))
                label[label == c] = label[x]

    order = np.lexsort((row, item))
    row, item = row[order], item[order]
    first = np.flatnonzero(np.diff(item, prepend=-1))
    n = np.diff(np.append(first, len(item)))
    for k in np.flatnonzero(n > LONG_LIST)[np.argsort(-n[n > LONG_LIST], kind="stable")].tolist():
        part = row[first[k] : first[k] + n[k]]
        if len(np.unique(label[part])) > 1:  # a unit of its own, of at most half the nodes
            inside = np.full(len(mine), -1)
            inside[part] = np.arange(len(part))
            sub = inside[mine_doc] >= 0
            at = {int(x): k for k, x in enumerate(names)}
            for link in resolve(np.zeros(len(part), np.int64), names[part], inside[mine_doc[sub]], mine_h[sub], percent):
                for a, b in link.T:
                    join(at[int(a)], np.array([at[int(b)]]))
    short = np.repeat(n <= LONG_LIST, n)
    row, item = row[short], item[short]
    first = np.flatnonzero(np.diff(item, prepend=-1))
    n = np.diff(np.append(first, len(item)))
    group = np.repeat(np.arange(len(first)), n)
    by_row = np.argsort(row, kind="stable")
    cut = np.searchsorted(row[by_row], np.arange(len(mine) + 1))
    for x in np.flatnonzero(alive).tolist():
        lists = group[by_row[cut[x] : cut[x + 1]]]
        if len(lists):
            lo, size = first[lists], n[lists]
            other = row[np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())]
            other, both = np.unique(other[(label[other] != label[x]) & (other > x)], return_counts=True)
            join(x, other[cost[x] + cost[other] <= take * both])
    return out


def resolve_units(members: DataFrame, total: int, percent: int, size: int) -> DataFrame:
    """Links (a, b) of units that fit a task. members: unit, node, text; total: their shingles."""

    def run(rows: pa.Table) -> pa.Table:
        parts = [(doc + i, h) for i, _, words in chunks(rows["text"], SPACED) for doc, h in [shingles(words, size)]]
        doc, h = (np.concatenate(x) for x in zip(*parts, strict=True))
        unit, node = (rows[c].to_numpy() for c in ("unit", "node"))
        found = np.concatenate(resolve(unit, node, doc, h, percent), 1)
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    bucket = F.expr(f"cast(pmod(xxhash64(unit), {1 + total // TASK_SHINGLES}) as int)")
    return members.select("unit", "node", "text", bucket.alias("bucket")).groupBy("bucket").applyInArrow(thrifty(run), "a long, b long")


def split_units(members: DataFrame, percent: int, size: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) and smaller units (unit, node) that hold all other linked pairs. members: unit, node, text, n, stored."""
    lose, take = 100 - percent, 100 + percent

    def each(batches):
        for batch in batches:
            for i, j, words in chunks(batch.column("text"), SPACED):
                doc, h = shingles(words, size)
                yield pa.RecordBatch.from_arrays([batch.column("unit").take(pa.array(i + doc)), pa.array(h.view(np.int64))], ["unit", "h"])

    nodes = members.groupBy("unit").agg(F.count("*").alias("members"))
    held = members.select("unit", "text").mapInArrow(thrifty(each), "unit long, h long").groupBy("unit", "h").agg(F.count("*").alias("count"))
    centres = nodes.join(held.join(nodes, "unit").where("2 * count > members").groupBy("unit").agg(F.collect_list("h").alias("centre")), "unit", "left").select("unit", "centre").checkpoint()

    def differ(batches):
        for batch in batches:
            centre = [np.array(x or [], np.int64).view(U) for x in batch.column("centre").to_pylist()]
            for i, j, words in chunks(batch.column("text"), SPACED):
                doc, h = shingles(words, size)
                own = [np.setxor1d(x, centre[i + k], assume_unique=True).view(np.int64) for k, x in enumerate(np.split(h, np.searchsorted(doc, np.arange(1, j - i))))]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i) for c in ("unit", "node", "n")] + [pa.array(own, pa.list_(pa.int64()))], ["unit", "node", "n", "items"])

    rows = members.join(centres, "unit").mapInArrow(thrifty(differ), "unit long, node long, n long, items array<long>")
    rows = rows.select("unit", "node", (take * F.size("items") - lose * F.col("n")).alias("cost"), "items").checkpoint()
    heads = rows.groupBy("unit").agg(F.min(F.struct("cost", "node")).alias("head"))
    rows = rows.join(heads, "unit").withColumn("sure", F.expr("cost + head.cost <= 0"))
    links = rows.where("sure and node <> head.node").select(F.col("head.node").alias("a"), F.col("node").alias("b"))
    items = rows.select("unit", "node", "cost", F.col("head.cost").alias("least"), "sure", F.explode("items").alias("item"))
    many = items.groupBy("unit", "item").agg(F.count("*").alias("count"), F.bool_and("sure").alias("all_sure")).where("count > 1")
    by_row = Window.partitionBy("unit", "node")
    # a prefix of the rarest: two linked rows share more differences than either leaves out
    items = items.join(many, ["unit", "item"]).withColumn("rank", F.row_number().over(by_row.orderBy("count", "item"))).withColumn("common", F.count("*").over(by_row))
    items = items.where(f"not all_sure and rank <= common + 1 - greatest(1, ceil((cost + least) / {2 * take}))")
    units = items.select(F.xxhash64("unit", "item").alias("unit"), "node").distinct()
    return links, units


def links_between(own: DataFrame, units: DataFrame, nodes: DataFrame, percent: int, size: int, unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """Links (a, b) that join all linked nodes of each unit (unit, node). nodes: node, n (shingles), stored."""
    units = units.checkpoint()
    texts = texts_of(own, units.select("node").distinct().checkpoint(), size).checkpoint()
    found = None
    while True:
        sized = units.join(nodes, "node")
        totals = sized.groupBy("unit").agg(F.sum("n").alias("total"), F.count("*").alias("members")).where("members > 1").checkpoint()
        fits = F.col("total") <= unit_shingles
        total, large = totals.agg(F.coalesce(F.sum(F.when(fits, F.col("total"))), F.lit(0)), F.count(F.when(~fits, 1))).first()
        small = units.join(totals.where(fits), "unit", "left_semi").join(texts, "node")
        links = resolve_units(small, total, percent, size).checkpoint()
        found = links if found is None else found.unionAll(links)
        if not large:
            return found
        members = sized.join(totals.where(~fits), "unit", "left_semi").join(texts, "node").checkpoint()
        links, units = split_units(members, percent, size)
        found, units = found.unionAll(links.checkpoint()), units.checkpoint()


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, hot_share: float = HOT_SHARE, buckets: int | None = None, unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """id, n_shingles, component_id (the smallest id reachable by links), node (equal for equal sets); one row for each document."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    shared(spark)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    buckets = buckets or 16 << max(0, (docs.rdd.getNumPartitions() // 8).bit_length())
    facts = nodes_of(own, kind, size).checkpoint()
    n_docs, most = facts.agg(F.count("*"), F.coalesce(F.max("n_shingles"), F.lit(1))).first()
    hot, agree = _frequent(own, n_docs, size, sample_rows, hot_share)
    plan = spark.sparkContext.broadcast(Plan(percent, max(1, most), n_docs, agree, hot))
    nodes = facts.where("node > 0").groupBy("node").agg(F.first("n_shingles").alias("n")).checkpoint()
    links = links_between(own, index_units(own, plan, size, buckets), nodes, percent, size, unit_shingles)
    roots = components(nodes, links).checkpoint()
    named = facts.join(roots, "node", "left").select("id", "n_shingles", "node", "root").checkpoint()
    least = named.where("root is not null").groupBy("root").agg(F.min("id").alias("least")).checkpoint()
    out = named.join(least, "root", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("least", "id").alias("component_id"), "node")


def query(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("node")
