"""Identity: relatedness, pedigrees, sex, flags, hubs, pass lists and groups of identical samples."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import spreads


#: Members of a block; the counters of two blocks are 48 MB.
MEMBER_BLOCK = 1024
#: Genotypes of whole sites that a task looks at together (more only where one site has more).
CHUNK = 1 << 18
#: A site with at most so many carriers a block of members is passed on as its pairs, another as the lists of its blocks.
CROWD = 4
#: Blocks of members are dealt in at most so many groups; each member's own counts are sent once for each of them.
GROUPS = 64
HET, HOM, MISSING = 1, 2, 3
#: Pairs of genotypes that are looked at together.
STEP = 1 << 20
#: Counters of a block for one pair of genotypes at a time, from which on only the pair's counters are touched.
SPARSE = 4
#: Hub candidates that are peeled together on the driver, with the pairs between them (half a million at most).
TOP = 1024
_PAIR = "sample_a long, sample_b long, shared_hets long, ibs0 long, ibs2 long, n long, hets_a long, hets_b long"
_DEALT = "group_a int, group_b int, low int, high int, first array<short>, second array<short>"


def _weights() -> np.ndarray:
    """What a pair of genotypes (code of one, code of the other, from 1) adds: shared, het and het, same, both missing, rows of both, hom with a row."""
    x, y = np.repeat([1, 2, 3], 3), np.tile([1, 2, 3], 3)
    seen = (x < 3) & (y < 3)
    return np.array([seen, (x == HET) & (y == HET), (x == y) & seen, (x == MISSING) & (y == MISSING), np.ones(9, bool), (x == HOM) * 1 + (y == HOM)], np.int64)


def _pack(values: np.ndarray, starts: np.ndarray, sort: bool = True) -> pa.Array:
    """Whole numbers as a list of 16-bit units for each of the rows that begin at starts: 15 bits a unit, of the steps between sorted ones."""
    step = values.astype(np.int64)
    if sort:
        step[1:] -= values[:-1]
        step[starts] = values[starts]
    long = np.flatnonzero(step >= 1 << 15)
    more = 1 + (step[long] >= 1 << 30)
    size = np.ones(len(step), np.int64)
    size[long] += more
    begin = np.cumsum(size) - size
    units = np.empty(len(step) + int(more.sum()), np.uint16)
    units[begin] = step & 32767
    for k in (1, 2):
        here = begin[long] + k
        units[here - 1] |= 32768
        units[here] = step[long] >> 15 * k & 32767
        long = long[more > 1]
        more = more[more > 1]
    offsets = np.append(begin[starts], len(units)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(units.view(np.int16)))


class _Unpacked:
    """Rows of _pack, by number: steps added up (row) or as they are (plain)."""

    def __init__(self, column: pa.ListArray):
        offsets = column.offsets.to_numpy().astype(np.int64)
        units = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].view(np.uint16)
        offsets -= offsets[0]
        last = units < 32768
        end = np.flatnonzero(last)
        if len(end) == len(units):
            self.values, self.begin = units.astype(np.int64), offsets
        else:
            start = np.concatenate([[0], end[:-1] + 1])
            self.values = (units[start] & 32767).astype(np.int64)
            for k in (1, 2):
                here = np.flatnonzero(end - start >= k)
                self.values[here] |= (units[start[here] + k].astype(np.int64) & 32767) << 15 * k
            self.begin = np.searchsorted(start, offsets)
        self.sums = np.concatenate([[0], np.cumsum(self.values)])

    def plain(self, i: int) -> np.ndarray:
        return self.values[self.begin[i] : self.begin[i + 1]]

    def row(self, i: int) -> np.ndarray:
        lo, hi = self.begin[i], self.begin[i + 1]
        return self.sums[lo + 1 : hi + 1] - self.sums[lo]


class Found:
    """Counts of pairs of members of two blocks, made when they are looked at.

    a, b: places of the members in their blocks, which begin at the ids low and high; x, y: the members' own counts by code; sums: one for each
    of the weights, or three and three of them in a number.
    """

    def __init__(self, low: int, high: int, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, sums: np.ndarray, sites: int):
        self.low, self.high, self.a, self.b, self.x, self.y, self.sums, self.sites = low, high, a, b, x, y, sums, sites

    def where(self, mask: np.ndarray) -> Found:
        at = np.flatnonzero(mask)
        return Found(self.low, self.high, self.a[at], self.b[at], self.x, self.y, self.sums[:, at], self.sites)

    def _sum(self, i: int) -> np.ndarray:
        return self.sums[i] if len(self.sums) == 6 else _part(self.sums[i // 3], i % 3)

    @cached_property
    def sample_a(self) -> np.ndarray:
        return self.low + self.a

    @cached_property
    def sample_b(self) -> np.ndarray:
        return self.high + self.b

    @cached_property
    def shared_hets(self) -> np.ndarray:
        return self._sum(1)

    @cached_property
    def ibs0(self) -> np.ndarray:
        return self.x[HOM - 1][self.a] + self.y[HOM - 1][self.b] - self._sum(5)

    @cached_property
    def ibs2(self) -> np.ndarray:
        return self._sum(2) + self.sites - self.x.sum(axis=0)[self.a] - self.y.sum(axis=0)[self.b] + self._sum(4)

    @cached_property
    def n(self) -> np.ndarray:
        return self.sites - self.x[MISSING - 1][self.a] - self.y[MISSING - 1][self.b] + self._sum(3)

    @cached_property
    def hets_a(self) -> np.ndarray:
        return self.x[HET - 1][self.a]

    @cached_property
    def hets_b(self) -> np.ndarray:
        return self.y[HET - 1][self.b]

    @cached_property
    def relatedness(self) -> np.ndarray:
        """(shared hets - 2 ibs0) / the smaller number of hets of the two; no number where one has none."""
        least = np.minimum(self.hets_a, self.hets_b)
        return np.where(least > 0, (self.shared_hets - 2.0 * self.ibs0) / np.maximum(least, 1), np.nan)


_TYPES = {"relatedness": "double"}


def rows_of(columns: Sequence[str], keep: Callable[[Found], np.ndarray] | None = None):
    """A function of found pairs that makes the rows of those that keep marks, and the rows' schema."""

    def shape(found: Found):
        found = found if keep is None else found.where(keep(found))
        made = [pa.array(v, pa.float64(), mask=np.isnan(v)) if c in _TYPES else pa.array(v.astype(np.int64)) for c, v in ((c, getattr(found, c)) for c in columns)]
        return pa.RecordBatch.from_arrays(made, list(columns))

    return shape, ", ".join(f"{c} {_TYPES.get(c, 'long')}" for c in columns)


def _largest(at: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The largest value of each place; minus infinity if it has none."""
    most = np.full(int(at.max(initial=-1)) + 1, -np.inf)
    np.fmax.at(most, at, value)
    return most


def best_of_each(found: Found) -> np.ndarray:
    """Marks, for each member of the pairs (in order of sample_a, sample_b), the first pair of the largest relatedness."""
    mask = np.zeros(len(found.a), bool)
    for at in (found.a, found.b):
        best = np.flatnonzero(found.relatedness == _largest(at, found.relatedness)[at])
        mask[best[np.unique(at[best], return_index=True)[1]]] = True
    return mask


def one_of_each(wanted: Callable[[Found], np.ndarray]) -> Callable[[Found], np.ndarray]:
    """Marks pairs that wanted marks until each of their members has been in a marked one: the members of the marked pairs are those of the wanted ones."""
    known: set = set()  # of a task

    def keep(found: Found) -> np.ndarray:
        mask, at = np.zeros(len(found.sample_a), bool), np.flatnonzero(wanted(found))
        for member in (found.sample_a[at], found.sample_b[at]):
            each, first = np.unique(member, return_index=True)
            fresh = [i for m, i in zip(each.tolist(), first.tolist()) if m not in known]
            mask[at[fresh]] = True
            known.update(each.tolist())
        return mask

    return keep


class _BlockPair:
    """Counts over all sites of the members of two blocks (or of one with itself).

    Only genotypes that are not called hom-ref are given.  What hom-ref is counted in follows from each member's own counts (rows by
    code) and from the sites at which both members have a row, so no dense genotypes are made.  Pairs of genotypes are sorted and
    counted; counters for all pairs of members are only made where lists come or pairs are many.
    """

    def __init__(self, low: int, high: int, size: int):
        self.low, self.high, self.size = low, high, size
        self.sums, self.events, self.held = None, [], 0

    def _counters(self) -> np.ndarray:
        if self.sums is None:
            self.sums = np.zeros((6, self.size * self.size), np.int64)
        return self.sums

    def _decoded(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code, rest = packed & 3, packed >> 2
        return rest // self.size, rest % self.size, code

    def _count(self, i: int, at: np.ndarray) -> None:
        if len(at) * SPARSE < self.sums.shape[1]:
            np.add.at(self.sums[i], at, 1)  # few pairs: the counters are not gone through
        else:
            self.sums[i] += np.bincount(at, minlength=self.sums.shape[1])

    def _seen(self, at: np.ndarray, kind: np.ndarray) -> None:
        self._counters()
        for i, weight in enumerate(_weights()):
            for times in (1, 2):
                hit = weight[kind] >= times
                if times == 1 or i == 5:
                    self._count(i, at[hit])

    def add_pairs(self, pairs: np.ndarray) -> None:
        """Pairs of genotypes: (member of low, member of high) * 9 + kind."""
        self.events.append(pairs)
        self.held += len(pairs)
        if self.held > STEP:
            found = np.concatenate(self.events).astype(np.int64)
            self._seen(found // 9, found % 9)
            self.events, self.held = [], 0

    def add_lists(self, first: np.ndarray, second: np.ndarray) -> None:
        """Packed genotypes (site, member, code; sorted) of the same sites; of one block twice where it meets itself."""
        a, b = self._decoded(first), self._decoded(second)
        begin, end = np.searchsorted(b[0], a[0], "left"), np.searchsorted(b[0], a[0], "right")
        until = np.cumsum(end - begin)
        lo = 0
        while lo < len(until):
            hi = max(lo + 1, int(np.searchsorted(until, (until[lo - 1] if lo else 0) + STEP, "right")))
            many = (end - begin)[lo:hi]
            left = np.repeat(np.arange(lo, hi), many)
            right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[lo:hi], many)
            self._seen(a[1][left] * self.size + b[1][right], (a[2][left] - 1) * 3 + b[2][right] - 1)
            lo = hi

    def _sparse(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of members that are both called at a site, with their sums, from the sorted pairs of genotypes."""
        found = np.sort(np.concatenate(self.events))
        at = found // 9
        kind = found - at * 9
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        weights = _weights()  # three sums are added as one number (_part): of STEP each at most, the last of 2 * STEP
        first, last = (weights[i] + (weights[i + 1] << 21) + (weights[i + 2] << 42) for i in (0, 3))
        sums = np.add.reduceat(first[kind], starts)
        seen = np.flatnonzero(_part(sums, 0))
        return at[starts[seen]].astype(np.int64), np.array([sums[seen], np.add.reduceat(last[kind], starts)[seen]])

    def rows(self, known: np.ndarray, own: dict, sites: int, every: bool, shape):
        """Record batches, as shape makes them, of the pairs that share a site at which both carry an allele, or of every pair."""
        x, y = own[self.low], own[self.high]
        if self.sums is None and self.events and not every:
            at, sums = self._sparse()
        else:
            sums = self._counters()
            if self.events:
                found = np.concatenate(self.events).astype(np.int64)
                self._seen(found // 9, found % 9)
            wanted = (x.sum(axis=0)[:, None] > 0) & (y.sum(axis=0)[None, :] > 0) if every else sums[0].reshape(self.size, self.size) > 0
            at = np.flatnonzero(np.triu(wanted, 1) if self.low == self.high else wanted)
            sums = sums[:, at]
        for lo in range(0, len(at), 1 << 16):
            here = slice(lo, lo + (1 << 16))
            a, b = np.divmod(at[here], self.size)
            made = shape(Found(int(known[self.low]) * self.size, int(known[self.high]) * self.size, a, b, x, y, sums[:, here], sites))
            if made.num_rows:
                yield made


def _part(sums: np.ndarray, i: int) -> np.ndarray:
    """One of three sums in a number."""
    return sums >> 21 * i & (1 << (22 if i == 2 else 21)) - 1


def _whole_sites(batches, chunk: int):
    """Arrays (site, sample, code) of about chunk rows, cut between sites only; the rows come sorted by site."""
    held, rows = [], 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += len(batch)
        if rows >= chunk and held[-1][0][-1] != held[0][0][0]:
            site, sample, code = (np.concatenate(c) for c in zip(*held))
            cut = int(np.searchsorted(site, site[-1], "left"))
            yield site[:cut], sample[:cut], code[:cut]
            held, rows = [[site[cut:], sample[cut:], code[cut:]]], len(site) - cut
    if rows:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _dealt(low: np.ndarray, high: np.ndarray, first: pa.Array, second: pa.Array, of: int):
    columns = [low // of, high // of, low, high]
    return pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in columns], first, second], [c.split()[0] for c in _DEALT.split(", ")])


def _deal_pairs(begin: np.ndarray, block: np.ndarray, member: np.ndarray, code: np.ndarray, size: int, blocks: int, of: int):
    """All pairs of rows of a site, by pair of blocks; begin: the row after the site's last, for each row."""
    later = begin - np.arange(len(begin)) - 1
    until = np.cumsum(later)
    lo = 0
    while lo < len(until):
        hi = max(lo + 1, int(np.searchsorted(until, (until[lo - 1] if lo else 0) + 4 * STEP, "right")))
        many = later[lo:hi]
        left = np.repeat(np.arange(lo, hi), many)
        right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + left + 1
        lo = hi
        if not len(left):
            continue
        width = size * size * 9
        kind = (member[left] * size + member[right]) * 9 + (code[left] - 1) * 3 + code[right] - 1
        keyed = np.sort((block[left] * blocks + block[right]) * width + kind)
        key, kind = keyed // width, keyed % width
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield _dealt(key[starts] // blocks, key[starts] % blocks, _pack(kind, starts), pa.nulls(len(starts), pa.list_(pa.int16())), of)


def _deal_lists(no: np.ndarray, block: np.ndarray, member: np.ndarray, code: np.ndarray, size: int, of: int):
    """The packed rows of every block present, for each pair of these blocks."""
    order = np.lexsort((member, no, block))
    packed, block = ((no * size + member) * 4 + code)[order], block[order]
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    lists, here = _pack(packed, starts), block[starts]
    for i, low in enumerate(here):
        for j in range(i, len(here), 64):
            high = here[j : j + 64]
            yield _dealt(np.full(len(high), low), high, lists.take(pa.array([i] * len(high))), lists[j : j + 64], of)


def pair_counts(gt: DataFrame, every: bool = False, member_block: int = MEMBER_BLOCK, chunk: int = CHUNK, crowd: int = CROWD, shape=None) -> DataFrame:
    """Counts per pair of members over the sites both are fully called at: shared_hets, ibs0 (hom-ref against hom-alt), ibs2 (the same
    genotype), n, and the hets of each.  Pairs that carry an allele at a common site, or every pair of members with a row.

    gt: site_id, sample_id, alt, called; a member without a row at a site is called hom-ref there, one with fewer than two called alleles
    is missing.  Rows meet by site.  A site of few carriers is passed on as its pairs of genotypes, about two bytes each; one that has more
    than crowd carriers a block of members as the lists of its blocks, each once for every block present.  So what is exchanged grows
    with the pairs that share a site, and never with the pairs of all blocks; blocks that meet at no site cost nothing (but where every pair
    is wanted).  Each pair of blocks is one run of sorted rows over counters of fixed size.

    gt is read three times: a caller keeps it where it is costly to make.  shape: what a task makes of found pairs, and its schema; pairs
    that a caller does not need then never leave the task that counts them.
    """
    shape, schema = shape or rows_of([c.split()[0] for c in _PAIR.split(", ")], None)
    code = F.when(F.coalesce("called", F.lit(0)) < 2, MISSING).otherwise(F.coalesce("alt", F.lit(0)))
    gt = gt.select("site_id", "sample_id", code.cast("int").alias("code"))
    rows = gt.where("code > 0 and site_id is not null and sample_id is not null")
    block = F.floor(F.col("sample_id") / member_block).cast("long")
    sites = gt.select("site_id").distinct().count()  # no site_id is one more
    known = gt.where("code > 0").select(block.alias("block")).distinct().where("block is not null").toPandas()["block"].to_numpy(np.int64)
    known = np.sort(known)  # one for a block of members
    of = max(1, -(-len(known) // GROUPS))
    groups = -(-len(known) // of)

    def deal(batches):
        for site, sample, code in _whole_sites(batches, chunk):
            at = np.searchsorted(known, sample // member_block)
            member, code = sample % member_block, code.astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], site[1:] != site[:-1]]))
            ends = np.append(starts[1:], len(site))
            fresh = np.concatenate([[True], (site[1:] != site[:-1]) | (at[1:] != at[:-1])])
            few = np.repeat(ends - starts <= crowd * np.add.reduceat(fresh.astype(np.int64), starts), ends - starts)
            after = np.repeat(ends, ends - starts)
            if few.any():
                yield from _deal_pairs(np.cumsum(few)[after[few] - 1], at[few], member[few], code[few], member_block, len(known), of)
            if not few.all():
                no = np.repeat(np.arange(len(starts)), ends - starts)[~few]
                yield from _deal_lists(no - no[0], at[~few], member[~few], code[~few], member_block, of)

    def own_counts(batches):  # a block's, one list of units
        for batch in batches:
            for low, values in zip(batch.column("low").to_pylist(), batch.column("own")):
                counted, values = np.zeros((3, member_block), np.int64), values.values.to_numpy(zero_copy_only=False)
                counted[:, values[0::4]] = values.reshape(-1, 4)[:, 1:].T
                yield pa.RecordBatch.from_arrays([pa.array([low], pa.int32()), _pack(counted.ravel(), np.array([0]), False)], ["low", "first"])

    met = rows.repartition("site_id").sortWithinPartitions("site_id", "sample_id").mapInArrow(deal, _DEALT)
    counts = rows.groupBy("sample_id").agg(*[F.count_if(F.col("code") == c).cast("int").alias(f"n{c}") for c in (HET, HOM, MISSING)])
    own = F.array(F.pmod("sample_id", F.lit(member_block)).cast("int"), *[F.col(f"n{c}") for c in (HET, HOM, MISSING)])
    blocks = counts.groupBy(block.alias("block")).agg(F.flatten(F.collect_list(own)).alias("own"))
    numbers = gt.sparkSession.createDataFrame([(int(k), i) for i, k in enumerate(known)], "block long, low int")
    blocks = blocks.join(F.broadcast(numbers), "block").select("low", "own").mapInArrow(own_counts, "low int, first array<short>")
    blocks = blocks.withColumn("group", F.floor(F.col("low") / of).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(max(0, groups - 1)))))
    blocks = blocks.select(F.least("group", "other").alias("group_a"), F.greatest("group", "other").alias("group_b"), "low", F.lit(-1).alias("high"), "first", F.lit(None).cast("array<short>").alias("second"))
    dealt = blocks.unionByName(met).repartition("group_a", "group_b").sortWithinPartitions("group_a", "group_b", "high", "low")

    def run(batches):
        group, own, now, done = None, {}, None, set()

        def rest():  # pairs of blocks that no site brought together
            for high in sorted(own):
                for low in sorted(own):
                    if low <= high and (low // of, high // of) == group and (low, high) not in done:
                        yield from _BlockPair(low, high, member_block).rows(known, own, sites, True, shape)

        for batch in batches:
            group_a, group_b, low, high = (c.to_pylist() for c in batch.columns[:4])
            first, second, pairs = _Unpacked(batch.column(4)), _Unpacked(batch.column(5)), batch.column(5).is_null().to_pylist()
            for i in range(len(batch)):
                if group != (group_a[i], group_b[i]) or (now is not None and (now.low, now.high) != (low[i], high[i])):
                    if now is not None:
                        yield from now.rows(known, own, sites, every, shape)
                        done.add((now.low, now.high))
                        now = None
                if group != (group_a[i], group_b[i]):
                    if every and group is not None:
                        yield from rest()
                    group, own, done = (group_a[i], group_b[i]), {}, set()
                if high[i] < 0:
                    own[low[i]] = first.plain(i).reshape(3, member_block)
                    continue
                now = now or _BlockPair(low[i], high[i], member_block)
                if pairs[i]:
                    now.add_pairs(first.row(i).astype(np.int32))
                else:
                    now.add_lists(first.row(i), second.row(i))
        if now is not None:
            yield from now.rows(known, own, sites, every, shape)
            done.add((now.low, now.high))
        if every and group is not None:
            yield from rest()

    return dealt.mapInArrow(run, schema)


def with_relatedness(pairs: DataFrame) -> DataFrame:
    """(shared hets - 2 ibs0) / the smaller number of hets of the two; null where one has none."""
    return pairs.withColumn("relatedness", F.try_divide(F.col("shared_hets") - 2.0 * F.col("ibs0"), F.least("hets_a", "hets_b"))).drop("hets_a", "hets_b")


#: What a list of pairs has.
MEASURED = ("sample_a", "sample_b", "shared_hets", "ibs0", "ibs2", "n", "relatedness")


def relatedness(gt: DataFrame, keep: Callable[[Found], np.ndarray] | None = None, columns: Sequence[str] = MEASURED) -> DataFrame:
    """Counted pairs with their relatedness: those that keep marks (it is given many found pairs at once, in each task), with the columns named.

    Relatedness and ibs0 of a pair follow from the rows of its two members only: where a caller wants the pairs of some members, it gives
    the rows of these alone (n and ibs2 count all sites that have a row).
    """
    return pair_counts(gt, shape=rows_of(columns, keep))


def close_partners(gt: DataFrame, close: float) -> DataFrame:
    """Per member with pairs: close_pairs (those of relatedness close or more) and max_relatedness; added up by each task before they are sent on."""

    def shape(found: Found):
        value, sides = found.relatedness, []
        for at, block in ((found.a, found.low), (found.b, found.high)):
            most, here = _largest(at, value), np.flatnonzero(np.bincount(at))
            sides.append((here + block, np.bincount(at, value >= close, len(most)).astype(np.int64)[here], most[here]))
        some, near, most = (np.concatenate(c) for c in zip(*sides))
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(near), pa.array(most, mask=np.isneginf(most))], ["sample_id", "close_pairs", "max_relatedness"])

    found = pair_counts(gt, shape=(shape, "sample_id long, close_pairs long, max_relatedness double"))
    return found.groupBy("sample_id").agg(F.sum("close_pairs").alias("close_pairs"), F.max("max_relatedness").alias("max_relatedness"))


def declared_relatedness(declared: DataFrame, gt: DataFrame) -> DataFrame:
    """Declared (child, parent) with the relatedness of the pair in either order, null where they carry an allele at no common site.

    Only the declared pairs are counted: the rows of the one meet those of the other by site, so the work grows with the rows of the members
    that are declared, and not with the pairs of all members.  gt as in pair_counts; it is read four times.
    """
    code = F.when(F.coalesce("called", F.lit(0)) < 2, MISSING).otherwise(F.coalesce("alt", F.lit(0))).cast("int")
    rows = gt.select("site_id", "sample_id", code.alias("code")).where("code > 0 and site_id is not null and sample_id is not null")
    of = lambda side: rows.select("site_id", F.col("sample_id").alias(f"sample_{side}"), F.col("code").alias(f"code_{side}"))
    wanted = declared.select(F.least("child", "parent").alias("sample_a"), F.greatest("child", "parent").alias("sample_b")).where("sample_a < sample_b").distinct()
    met = wanted.join(of("a"), "sample_a").join(of("b"), ["sample_b", "site_id"])
    one, other = F.col("code_a"), F.col("code_b")
    sums = met.groupBy("sample_a", "sample_b").agg(
        F.count_if((one < MISSING) & (other < MISSING)).alias("shared"),
        F.count_if((one == HET) & (other == HET)).alias("shared_hets"),
        (F.count_if(one == HOM) + F.count_if(other == HOM)).alias("homs"),
    )
    own = rows.groupBy("sample_id").agg(F.count_if(F.col("code") == HET).alias("hets"), F.count_if(F.col("code") == HOM).alias("hom"))
    found = sums.where("shared > 0")
    for side in ("a", "b"):
        found = found.join(own.select(*[F.col(c).alias(f"{n}_{side}") for c, n in (("sample_id", "sample"), ("hets", "hets"), ("hom", "hom"))]), f"sample_{side}")
    found = with_relatedness(found.withColumn("ibs0", F.col("hom_a") + F.col("hom_b") - F.col("homs"))).select("sample_a", "sample_b", "relatedness")
    low, high = F.least("child", "parent") == F.col("sample_a"), F.greatest("child", "parent") == F.col("sample_b")
    return declared.join(found, low & high, "left").select("child", "parent", *[c for c in declared.columns if c not in ("child", "parent")], "relatedness")


def pedigree(members: DataFrame) -> DataFrame:
    """PED rows: children with parents, and founders for parents outside the members (sex code 1, 2 or 0)."""
    code = F.when(F.col("sex") == "XY", 1).when(F.col("sex") == "XX", 2).otherwise(0)
    own = members.select(F.col("sample_id").alias("id"), F.coalesce("father_id", F.lit(0)).alias("father"), F.coalesce("mother_id", F.lit(0)).alias("mother"), code.alias("sex"), F.lit(True).alias("member"))
    parents = members.select(F.explode(F.array(F.struct(F.col("father_id").alias("id"), F.lit(1).alias("sex")), F.struct(F.col("mother_id").alias("id"), F.lit(2).alias("sex")))).alias("p")).select("p.*")
    outside = parents.where("id is not null").groupBy("id").agg(F.min("sex").alias("sex")).join(members.select(F.col("sample_id").alias("id")), "id", "left_anti")
    return own.unionByName(outside.select("id", F.lit(0).cast("long").alias("father"), F.lit(0).cast("long").alias("mother"), "sex", F.lit(False).alias("member")))


def parent_pairs(members: DataFrame) -> DataFrame:
    """(child, parent, role) of the declared parents."""
    both = F.array(F.struct(F.col("father_id").alias("parent"), F.lit("father").alias("role")), F.struct(F.col("mother_id").alias("parent"), F.lit("mother").alias("role")))
    return members.select(F.col("sample_id").alias("child"), F.explode(both).alias("p")).select("child", "p.*").where("parent is not null")


def both_ways(pairs: DataFrame, one: str, other: str, *columns: str) -> DataFrame:
    """Each pair in both orders, in one pass over the pairs (which may be costly to make)."""
    ends = F.array(*[F.struct(F.col(f"sample_{x}").alias(one), F.col(f"sample_{y}").alias(other), *columns) for x, y in ("ab", "ba")])
    return pairs.select(F.explode(ends).alias("p")).select("p.*")


#: Declared pairs up to which they are sent to the pairs, instead of the pairs to them.
DECLARED = 5_000_000


def declared_pairs(declared: DataFrame, pairs: DataFrame) -> DataFrame:
    """Declared (child, parent) with the measured relatedness of the pair in either order.

    The measured pairs are many more than the declared ones: only those that are declared are exchanged.
    """
    wanted = declared.select(F.least("child", "parent").alias("low"), F.greatest("child", "parent").alias("high")).distinct()
    wanted = F.broadcast(wanted) if declared.count() <= DECLARED else wanted  # counted
    found = pairs.select(F.least("sample_a", "sample_b").alias("low"), F.greatest("sample_a", "sample_b").alias("high"), "relatedness").join(wanted, ["low", "high"])
    low, high = F.least("child", "parent") == F.col("low"), F.greatest("child", "parent") == F.col("high")
    return declared.join(found, low & high, "left").select("child", "parent", *[c for c in declared.columns if c not in ("child", "parent")], "relatedness")


def duplicate_warnings(members: DataFrame, pairs: DataFrame, floor: float) -> DataFrame:
    """Pairs of a list at or above the floor: the value of the newest run that saw the pair in either order."""
    low, high = F.least("sample_a", "sample_b"), F.greatest("sample_a", "sample_b")
    seen = pairs.select(low.alias("a"), high.alias("b"), "relatedness", "finished_at")
    ids = members.select("sample_id")
    ids = F.broadcast(ids) if members.count() <= DECLARED else ids  # counted; pairs outside the list are not exchanged
    inside = seen.join(ids.withColumnRenamed("sample_id", "a"), "a", "left_semi").join(ids.withColumnRenamed("sample_id", "b"), "b", "left_semi")
    newest = inside.groupBy("a", "b").agg(F.max_by("relatedness", "finished_at").alias("relatedness"))
    return newest.where(F.col("relatedness") >= floor)


def resolve_sex(df: DataFrame, xx_min: float, xy_max: float) -> DataFrame:
    """Sex from the sheet, else from coverage, else from the X het ratio; messages where two sources disagree."""
    called = F.when(F.col("x_het") >= xx_min, "XX").when(F.col("x_het") <= xy_max, "XY")
    sheet = F.when(F.col("sheet_sex") != "", F.col("sheet_sex"))
    out = df.withColumn("x_call", called)
    said = F.array_compact(
        F.array(
            F.when(sheet != F.col("coverage_sex"), F.concat(F.lit("sheet "), sheet, F.lit(" but coverage "), F.col("coverage_sex"))),
            F.when(sheet != called, F.concat(F.lit("sheet "), sheet, F.lit(" but X hets "), called)),
        )
    )
    source = F.when(sheet.isNotNull(), "sheet").when(F.col("coverage_sex").isNotNull(), "coverage").when(called.isNotNull(), "x_het").otherwise("none")
    return out.select("sample_id", F.coalesce(sheet, "coverage_sex", called, F.lit("")).alias("sex"), source.alias("source"), F.array_join(said, "; ").alias("messages"))


def qc_members(near: DataFrame, samples: DataFrame, ancestry: DataFrame | None = None, xx_min: float = 0.3, xy_max: float = 0.15) -> DataFrame:
    """Per member: het ratio, number of close pairs, the largest relatedness, the X call, and the likeliest ancestry.

    near: sample_id, close_pairs, max_relatedness (close_partners); samples: sample_id, n_het, n_called, x_het, x_called (at sites of chrX); the call is XX from xx_min hets a called site on, XY up to xy_max,
    null between and without a site.  ancestry: sample_id, label, probability; ties go to the smaller label.
    """
    near = near.withColumn("max_relatedness", F.round("max_relatedness", 6))
    share = F.try_divide(F.col("x_het"), F.col("x_called"))
    call = F.when(share >= xx_min, "XX").when(share <= xy_max, "XY")
    out = samples.select("sample_id", F.round(F.try_divide(F.col("n_het"), F.col("n_called")), 6).alias("het_ratio"), F.round(share, 6).alias("x_het_ratio"), call.alias("x_call")).join(near, "sample_id", "left")
    if ancestry is None:
        return out
    best = ancestry.groupBy("sample_id").agg(F.max_by("label", F.struct("probability", -F.col("label"))).alias("ancestry"), F.round(F.max("probability"), 6).alias("ancestry_probability"))
    return out.join(best, "sample_id", "left")


def identity_flags(pairs: DataFrame, members: DataFrame, hubs: DataFrame, duplicate: float, related: float, parent: tuple[float, float], mads: float, save) -> DataFrame:
    """Rows (sample_id, code, severity): duplicates, undeclared relatives (neither of them a hub), hubs, parents outside their range,
    het outliers and sex mismatches.

    pairs: sample_a, sample_b, relatedness, expected (null if not declared); members: sample_id, het_ratio, sex, called_sex;
    hubs: sample_id.
    """
    declared = F.coalesce("expected", F.lit(0.0)) > 0
    ends = hubs.select("sample_id")
    kind = F.when(F.col("relatedness") >= duplicate, "duplicate").when((F.col("relatedness") >= related) & ~declared, "related")
    found = pairs.withColumn("code", kind).where("code is not null").select("sample_a", "sample_b", "code")
    clear = found.where("code = 'related'")
    for side in ("sample_a", "sample_b"):
        clear = clear.join(ends.withColumnRenamed("sample_id", side), side, "left_anti")
    off = pairs.where(declared & ~F.col("relatedness").between(*parent)).select("sample_a", "sample_b", F.lit("pedigree_mismatch").alias("code"))
    both = found.where("code = 'duplicate'").unionByName(clear).unionByName(off)
    of_pairs = both.select(F.explode(F.array("sample_a", "sample_b")).alias("sample_id"), "code").distinct()
    of_hubs = ends.distinct().select("sample_id", F.lit("related_hub").alias("code"))
    odd = median_outliers(members.select("sample_id", "het_ratio"), "het_ratio", mads, save).select("sample_id", F.lit("het_outlier").alias("code"))
    sex = members.where("sex <> '' and called_sex is not null and sex <> called_sex").select("sample_id", F.lit("sex_mismatch").alias("code"))
    level = F.when(F.col("code").isin("duplicate", "sex_mismatch", "pedigree_mismatch", "related_hub"), "fail").otherwise("warn")
    return of_pairs.unionByName(of_hubs).unionByName(odd).unionByName(sex).withColumn("severity", level)


def median_outliers(rows: DataFrame, value: str, mads: float, save, least: int = 4) -> DataFrame:
    """Rows further from the median than so many scaled median deviations; none if fewer than least values or no deviation."""
    rows = save(rows, "values")
    far = rows.crossJoin(F.broadcast(spreads(rows, [], value, save)))  # one row beside each
    away = F.abs(F.col(value) - F.col("median"))
    return far.where((F.col("n") >= least) & (F.col("mad") > 0) & (away > mads * 1.4826 * F.col("mad"))).select(*rows.columns)


def _peel(degree: dict, pairs: list, hub_min: int, outside: tuple | None) -> list[tuple]:
    """(member, degree when it leaves) in the order of leaving, as long as the largest (degree, member) is above that of outside."""
    near: dict = {m: [] for m in degree}
    for a, b in pairs:
        near[a].append(b)
        near[b].append(a)
    heap, out = [(-n, -m) for m, n in degree.items()], []
    heapq.heapify(heap)
    while heap:
        n, m = (-x for x in heapq.heappop(heap))
        if degree.get(m) != n:
            continue  # left, or lowered since
        if n < hub_min or (outside is not None and (n, m) < outside):
            break
        out.append((m, n))
        del degree[m]
        for other in near[m]:
            if other in degree:
                degree[other] -= 1
                heapq.heappush(heap, (-degree[other], -other))
    return out


def related_hubs(pairs: DataFrame, lo: float, hi: float, hub_min: int, save) -> DataFrame:
    """Hubs (sample_id, degree when it left) as peeled off one by one, the most connected first, until no member has hub_min related
    pairs.  Ties go to the larger id; pairs with an ``expected`` above 0 are declared and don't count, if that column is there.

    Only candidates (members with hub_min pairs or more) and the pairs between them matter: degrees only fall, so no other member
    becomes one.  A round takes the TOP candidates with the most pairs and peels them in order as long as no candidate outside has more.
    With them leave all candidates that come before each of their neighbours: such a one keeps its pairs until its turn, whatever is
    peeled elsewhere.  The round then lowers the degrees of their neighbours by what left.  State is kept in tables by save(df, name).
    """
    near = (F.col("relatedness") >= lo) & (F.col("relatedness") < hi)
    if "expected" in pairs.columns:
        near &= ~(F.coalesce("expected", F.lit(0.0)) > 0)
    edges = save(both_ways(pairs.where(near), "u", "v"), "edges")
    able = save(edges.groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= hub_min), "candidates")
    edges = save(edges.join(able.select("u"), "u", "left_semi").join(able.select(F.col("u").alias("v")), "v", "left_semi").select("u", "v"), "edges")
    state, rounds = save(able.withColumn("left", F.lit(False)), "hubs"), []
    while True:
        able = state.where(~F.col("left") & (F.col("n") >= hub_min)).select("u", "n")
        top = able.orderBy(F.desc("n"), F.desc("u")).limit(TOP + 1).collect()
        if not top:
            break
        number = F.broadcast(edges.sparkSession.createDataFrame([(r["u"], r["n"]) for r in top[:TOP]], "u long, n long"))
        among = edges.where("u < v").join(number.select("u"), "u", "left_semi").join(number.select(F.col("u").alias("v")), "v", "left_semi").select("u", "v").collect()
        outside = (top[TOP]["n"], top[TOP]["u"]) if len(top) > TOP else None
        peeled = edges.sparkSession.createDataFrame(_peel({r["u"]: r["n"] for r in top[:TOP]}, among, hub_min, outside), "u long, peeled long")
        if outside is None:
            rounds.append(peeled.select("u", F.col("peeled").alias("n"), F.lit(True).alias("left")))
            break
        between = edges.join(able, "u").join(able.select(F.col("u").alias("v"), F.col("n").alias("m")), "v")
        beaten = between.where(F.struct("n", "u") < F.struct("m", "v")).select("u").distinct().withColumn("beaten", F.lit(True))
        marked = able.join(beaten, "u", "left").join(F.broadcast(peeled), "u", "left")  # TOP at most
        marked = marked.select("u", F.coalesce("peeled", "n").alias("n"), (F.col("peeled").isNotNull() | F.col("beaten").isNull()).alias("left"))
        lost = edges.join(marked.where("left").select("u"), "u", "left_semi").groupBy(F.col("v").alias("u")).agg(F.count("*").alias("lost"))
        lower = F.when(F.col("left"), F.col("n")).otherwise(F.col("n") - F.coalesce("lost", F.lit(0)))
        state = save(marked.join(lost, "u", "left").select("u", lower.alias("n"), "left"), "hubs")
        rounds.append(state)
    if not rounds:
        return state.where("left").select(F.col("u").alias("sample_id"), F.col("n").alias("degree"))
    return reduce(DataFrame.union, rounds).where("left").select(F.col("u").alias("sample_id"), F.col("n").alias("degree"))


def connected(edges: DataFrame, save) -> DataFrame:
    """Components of (sample_a, sample_b): node and component (its smallest member), by passing on the smallest label until no
    label changes."""
    both = save(both_ways(edges, "u", "v").distinct(), "edges")
    labels = save(both.select(F.col("u").alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("v"), "component"), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near"))
        new = labels.join(heard, "node").select("node", F.least("component", "near").alias("near"), "component")
        # a label's own label shortens long chains
        own = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        new = save(new.join(own, "near", "left").select("node", F.least("near", F.coalesce("far", "near")).alias("component"), F.col("component").alias("old")), "labels")
        labels = new.select("node", "component")
        if new.where("component <> old").isEmpty():
            break
    return labels


def identity_pass(members: DataFrame, pairs: DataFrame, related: float, save) -> DataFrame:
    """Members in sheet order: kept, or out because failed or related to an earlier kept member.

    Decided in rounds by joins: of the members still open, those without an earlier open relative stay and their later relatives
    go.  Each round settles at least one member; the state is a table of open pairs, and no component is gathered.
    """
    place = lambda side: F.struct(F.col(f"position_{side}"), F.col(f"sample_{side}"))
    able = members.where(F.col("status").isNull() | (F.col("status") != "fail"))
    named = lambda side: able.select(F.col("sample_id").alias(f"sample_{side}"), F.col("position").alias(f"position_{side}"))
    edges = pairs.where((F.col("relatedness") >= related) & F.col("expected").isNull()).select("sample_a", "sample_b")
    both = both_ways(edges, "sample_a", "sample_b").distinct().join(named("a"), "sample_a").join(named("b"), "sample_b")
    arcs = save(both.where(place("a") < place("b")).select("sample_a", "sample_b"), "related")
    open_, out = arcs, None
    while not open_.isEmpty():
        later = open_.select(F.col("sample_b").alias("sample_a")).distinct()
        gone = save(open_.join(later, "sample_a", "left_anti").select("sample_b").distinct(), "out")
        out = gone if out is None else save(out.union(gone), "out")
        open_ = open_.join(gone, "sample_b", "left_anti").join(gone.withColumnRenamed("sample_b", "sample_a"), "sample_a", "left_anti")
        open_ = save(open_.select("sample_a", "sample_b"), "related")
    kept = arcs if out is None else arcs.join(out.withColumnRenamed("sample_b", "sample_a"), "sample_a", "left_anti")
    why = kept.groupBy(F.col("sample_b").alias("sample_id")).agg(F.min("sample_a").alias("earlier"))
    reason = F.when(F.col("status") == "fail", "failed").when(F.col("earlier").isNotNull(), F.concat(F.lit("related to "), F.col("earlier").cast("string"))).otherwise("")
    return members.join(why, "sample_id", "left").select("sample_id", (reason == "").alias("kept"), reason.alias("reason"))


def duplicate_groups(pairs: DataFrame, floor: float, save) -> DataFrame:
    """Groups of identical samples: members of pairs at or above the floor, with the smallest member of the group."""
    return connected(pairs.where(F.col("relatedness") >= floor), save).select(F.col("node").alias("sample_id"), F.col("component").alias("group_id"))


def explode_labels(members: DataFrame, column: str, sep: str = ";") -> DataFrame:
    """One row per member and label; every member has the label ALL."""
    labels = F.array_union(F.array(F.lit("ALL")), F.filter(F.split(F.coalesce(column, F.lit("")), sep), lambda x: x != ""))
    return members.select("sample_id", F.explode(labels).alias("label"))


def eligible(members: DataFrame, floors: dict[str, float], required: Sequence[str] = ()) -> DataFrame:
    """members with reason: the first of missing digest, failing flag or a metric below its floor; empty if eligible."""
    reason = F.when(~F.col("present"), "no digest").when(F.col("failed"), "failing flag")
    for metric, least in floors.items():
        reason = reason.when(F.col(metric).isNull() | (F.col(metric) < least), f"{metric} below {least:g}")
    return members.withColumn("reason", reason.otherwise(""))
