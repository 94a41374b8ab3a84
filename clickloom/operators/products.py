"""Products of a sparse rating matrix by inverted joins.

The matrix arrives as cells (user_id, item_id, weight). Joining it with itself would emit every pair of
cells that share a member. Here entities are dealt into groups by a hash of their id. A group asks for the members its own
cells name, each once, and an inverted join brings it the cells of these members and of nothing else: a cell travels to the
groups that reach it, never to all. Where everything reaches everything each group costs one more copy of the cells, so there
are no more groups than cores, unless a group's own cells would be too many for a task. Cells travel in packs of bounded size.
A task sums products entity by entity and lets only sums leave, of a top-k only what can still be among the best.

Links that would reach more than ``REACH`` cells are split by the reached entity: each task of a group then has whole sums of
some pairs, so nothing but the best leaves it. Scores, which need two steps, hold the cells in a few bytes each; only a group that
reaches ``HELD`` times as many is dealt to several tasks by the reached user, whose partial sums Spark adds up. Which cells a group
reaches for scores is looked up only where that can leave many out: users that each group meets ``COVERED`` times are sent to all.

With at most ``FEW`` entities the products are summed member by member instead: each cell travels once, a task reads its members
in batches and holds one table of pairs. Rows go straight to their partition, and nothing is sorted."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialize

# The task functions below travel with the job; executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORK = 100_000_000  # multiplications that a group does, on average
SMALL_WORK = 4_000_000  # below the number of cores, groups are made for so many
REACH = 4_000_000  # cells that a task holds
HELD = 12  # times as many that a task holds for scores, in a few bytes each
FEW = 1024  # entities whose pairs fit into one table
TABLE = 2_000_000  # numbers of a dense table that a task fills at a time
MASK = 62  # groups that the bits of a number can name
PACK = 4096  # cells of one member that travel as one row
FLUSH = 500_000  # result rows that a task holds before it sends them
CUTS = 128  # stretches of scores whose maxima give a first bound for the k-th best
STRETCH = 200_000  # entries of a matrix that are worked on at a time while it is built
COVERED = 4  # times that a group meets a user, on average, from which on all cells are sent to all groups
RUN = 200_000  # cells that are put in order of users at a time
LINE = 8  # numbers that are read at a time
HALF = 32  # bits of each of two sums that share a number


def groups_for(work: float, entities: int, cores: int) -> int:
    """Number of groups for so many multiplications: at least one, at most one for each entity, and no last round of tasks for a few."""
    wanted = -(-work // WORK)
    wanted = min(cores, -(-work // SMALL_WORK)) if wanted <= cores else round(wanted / cores) * cores
    return int(max(1, min(wanted, entities)))


def _cores(cells: DataFrame) -> int:
    return cells.sparkSession.sparkContext.defaultParallelism


def _group_of(entity: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(entity), F.lit(groups)).cast("int")


def _salt_of(member: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(member, F.lit(1)), F.lit(salts)).cast("int")


def packed(cells: DataFrame, keys: list[str], largest: int, *columns: str) -> DataFrame:
    """Rows (keys, n, one array for each column): the cells of equal keys in packs of about ``PACK`` for keys of ``largest`` cells, so of at most
    about that for any; ``n`` is the pack's size."""
    pack = F.pmod(F.xxhash64(columns[0], F.lit(3)), F.lit(-(-largest // PACK) or 1))
    # One list of structs, so that the arrays stay in step.
    held = cells.groupBy(*keys, pack.alias("pack")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct(*columns))).alias("cells"))
    return held.select(*keys, "n", *[F.col(f"cells.{name}").alias(name) for name in columns])


@dataclass(frozen=True)
class Size:
    """Of the cells: how many, how many the largest entity has, and the sum of squared numbers of cells of the entities."""

    entities: int = 0
    cells: int = 0
    largest: int = 0
    pairs: int = 0


def _salts(reached: DataFrame, size: Size) -> int:
    """Salts that the largest group needs, for rows (group, n)."""
    most = REACH * HELD
    if size.cells <= most:  # no group can reach so many cells
        return 1
    largest = reached.groupBy("group").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    return max(1, -(-largest // most))


def _placed(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartitionById(parts, F.col("part"))


def _flat(batch, names):
    """Of the lists of a batch: the length of each row's, and the entries of each column."""
    sizes = pa.compute.list_value_length(batch.column(names[0])).to_numpy(zero_copy_only=False)
    return sizes, [pa.compute.list_flatten(batch.column(name)).to_numpy(zero_copy_only=False) for name in names]


def _narrow(value: np.ndarray) -> np.ndarray:
    """Weights in fewer bytes, if these hold the same numbers."""
    for kind in (np.uint8, np.float32):
        small = value.astype(kind)
        if np.array_equal(small, value):
            return small
    return value


def _joined(parts: list, kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


class _Rows:
    """A sparse matrix by rows: ``column`` and ``value`` of row r lie at start[r] : start[r + 1].

    Made from a stretch of rows at a time, so that the order of all entries is never held."""

    width = 1  # numbers that a step of ``start`` stands for

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int) -> None:
        sizes = np.zeros(rows, np.int64)
        for begin in range(0, len(row), TABLE):
            sizes += np.bincount(row[begin : begin + TABLE], minlength=rows)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.column, self.value = np.empty(len(row), np.int32), np.empty(len(row), value.dtype)
        cuts = np.searchsorted(self.start, np.arange(0, len(row), 2 * TABLE)[1:])
        edges = np.unique(np.concatenate([[0], cuts, [rows]]))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            at = np.flatnonzero((row >= low) & (row < high)) if len(edges) > 2 else np.arange(len(row))
            at = at[np.sort((row[at].astype(np.int64) - low) << HALF | np.arange(len(at))) & (1 << HALF) - 1]
            place = slice(self.start[low], self.start[high])
            self.column[place], self.value[place] = column[at], value[at]

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of some rows, and how many each row has."""
        begins = self.start[rows]
        sizes = self.start[rows + 1] - begins
        return np.arange(sizes.sum()) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes), sizes

    @staticmethod
    def gathered(runs: np.ndarray, sizes: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int) -> "_Rows":
        """From runs of entries that each belong to one row, a row may have several."""
        found = object.__new__(_Rows)
        found.start = np.concatenate([[0], np.cumsum(np.bincount(runs, sizes, rows).astype(np.int64))])
        if (runs[1:] >= runs[:-1]).all():
            found.column, found.value = column, value
            return found
        order = np.argsort(runs, kind="stable")
        begins, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        ends = np.cumsum(sizes)
        found.column, found.value = np.empty_like(column), np.empty_like(value)
        cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(0, len(column), STRETCH)[1:]), [len(sizes)]]))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            place = slice(ends[low] - sizes[low], ends[high - 1])
            at = np.arange(place.start, place.stop) + np.repeat((begins - ends + sizes)[low:high], sizes[low:high])
            found.column[place], found.value[place] = column[at], value[at]
        return found

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Columns and values of some rows, and how many each row has."""
        at, sizes = self.entries(rows)
        return self.column[at], self.value[at], sizes

    def stretches(self):
        """First and last row of stretches of about ``STRETCH`` entries."""
        cuts = np.searchsorted(self.start, np.arange(0, self.start[-1], -(-STRETCH // self.width))[1:])
        edges = np.unique(np.concatenate([[0], cuts, [len(self.start) - 1]]))
        return zip(edges[:-1], edges[1:], strict=True)

    def part(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and value of the entries of some rows that follow each other."""
        here = slice(self.start[low], self.start[high])
        return np.repeat(np.arange(low, high), np.diff(self.start[low : high + 1])), self.column[here], self.value[here]

    def squares(self) -> np.ndarray:
        """The sum of squared values of each row."""
        found = np.zeros(len(self.start) - 1)
        for low, high in self.stretches():
            row, _, value = self.part(low, high)
            found[low:high] = np.bincount(row - low, value.astype(float) ** 2, high - low)
        return found


class _Lines(_Rows):
    """The same for weights of one byte, column and value in one number and rows in whole lines of ``LINE`` numbers, which are read faster: filled up
    with entries of no weight in a column after the last. ``start`` counts lines."""

    width = LINE

    def __init__(self, rows: _Rows, columns: int) -> None:
        sizes = np.diff(rows.start)
        self.start = np.concatenate([[0], np.cumsum(-(-sizes // LINE))])
        self.bits, self.columns = int(rows.value.max()).bit_length(), columns
        kind = np.uint32 if (columns + 1) << self.bits < 1 << 32 else np.int64
        self.line = np.full((self.start[-1], LINE), columns << self.bits, kind)
        flat = self.line.reshape(-1)
        for low, high in rows.stretches():
            row, column, value = rows.part(low, high)
            at = np.arange(rows.start[low], rows.start[high]) + (LINE * self.start - rows.start)[row]
            flat[at] = column.astype(np.int64) << self.bits | value

    def _opened(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = (held & np.array((1 << self.bits) - 1, held.dtype)).astype(np.uint8)
        held >>= np.array(self.bits, held.dtype)
        return held.astype(np.int64), value

    def part(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        column, value = self._opened(self.line[self.start[low] : self.start[high]].reshape(-1).copy())
        row = np.repeat(np.arange(low, high), LINE * np.diff(self.start[low : high + 1]))
        filled = column < self.columns
        return row[filled], column[filled], value[filled]

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, sizes = self.entries(rows)
        return *self._opened(self.line.take(at, 0).reshape(-1)), LINE * sizes


def _turned(rows: _Rows, columns: int, some: np.ndarray) -> _Rows:
    """Rows and columns exchanged, for the entries of some rows; made from a stretch of rows at a time."""
    found, sizes = object.__new__(_Rows), np.zeros(columns, np.int64)
    for low, high in rows.stretches():
        row, column, value = rows.part(low, high)
        sizes += np.bincount(column if some[low:high].all() else column[some[row]], minlength=columns)
    found.start = np.concatenate([[0], np.cumsum(sizes)])
    found.column, found.value = np.empty(found.start[-1], np.int32), np.empty(found.start[-1], value.dtype)
    free = found.start[:-1].copy()  # the next place of each
    for low, high in rows.stretches():
        row, column, value = rows.part(low, high)
        if not some[low:high].all():
            kept = some[row]
            row, column, value = row[kept], column[kept], value[kept]
        order = np.sort(column.astype(np.int64) << HALF | np.arange(len(column))) & (1 << HALF) - 1
        counts = np.bincount(column, minlength=columns)
        begins = np.cumsum(counts) - counts
        place = np.arange(len(order)) + (free - begins)[column[order]]
        found.column[place], found.value[place] = row[order], value[order]
        free += counts
    return found


def _best(scores: np.ndarray, k: int | None, tolerance: float) -> np.ndarray:
    """Places of the scores above zero, with ``k`` of those not more than ``tolerance`` below the k-th best."""
    if k is None:
        return np.flatnonzero(scores > 0)
    width = len(scores) // CUTS
    if width and k <= CUTS:
        # The k-th best maximum of a stretch is not above the k-th best score.
        bound = np.partition(scores[: width * CUTS].reshape(CUTS, width).max(axis=1), -k)[-k]
        above = np.flatnonzero(scores >= max(bound - tolerance, np.finfo(float).tiny))
    else:
        above = np.flatnonzero(scores > 0)
    if len(above) <= k:
        return above
    edge = np.partition(scores[above], -k)[-k]
    return above[scores[above] >= edge - tolerance]


class _Out:
    """Result rows, sent in batches."""

    def __init__(self, names: list[str]) -> None:
        self.names, self.parts, self.rows = names, [], 0

    def add(self, *columns):
        """A batch once enough rows are held."""
        self.parts.append(columns)
        self.rows += len(columns[0])
        if self.rows >= FLUSH:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
        self.parts, self.rows = [], 0
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], self.names)

    def rest(self):
        if self.parts:
            yield self.batch()


def _pairs(batches):
    """Sums over whole members of products of two entities' weights: as they are, and divided by the member's norm."""
    ids, dot, share, square = np.empty(0, np.int64), np.zeros((0, 0)), np.zeros((0, 0)), np.empty(0)
    for batch in batches:
        sizes, (entity, weight, squares) = _flat(batch, ("entity", "weight", "square"))
        if not len(entity):
            continue
        known = np.union1d(ids, entity)
        if len(known) > len(ids):
            at = np.searchsorted(known, ids)
            grown = [np.zeros((len(known), len(known))) for _ in range(2)]
            for new, old in zip(grown, (dot, share), strict=True):
                new[np.ix_(at, at)] = old
            (dot, share), ids = grown, known
            square = np.zeros(len(ids)) if len(square) == 0 else np.bincount(at, square, len(ids))
        column = np.searchsorted(ids, entity)
        square[column] = squares
        row = np.repeat(np.arange(len(sizes)), sizes)
        step = max(1, TABLE // len(ids))
        for begin in range(0, len(sizes), step):
            cells = slice(*np.searchsorted(row, [begin, begin + step]))
            table = np.zeros((min(step, len(sizes) - begin), len(ids)))
            np.add.at(table, (row[cells] - begin, column[cells]), weight[cells])
            norm = np.sqrt(np.bincount(row[cells] - begin, weight[cells] ** 2, len(table)))
            norm[norm == 0] = 1
            dot += table.T @ table
            share += table.T @ (table / norm[:, None])
    a, b = np.nonzero(dot)
    if len(a):
        columns = ids[a], ids[b], dot[a, b], share[a, b], square[a] * square[b]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "dot", "share", "squares"])


def _few(cells: DataFrame, member: str) -> DataFrame:
    """For cells (member, entity, weight, square) of few entities: rows (a, b, dot, share, squares), one for each pair that shares a member and for each entity with itself."""
    parts = _cores(cells)
    held = cells.groupBy(member).agg(F.collect_list(F.struct("entity", "weight", "square")).alias("cells"))
    rows = held.select(_salt_of(member, parts).alias("part"), *[F.col(f"cells.{name}").alias(name) for name in ("entity", "weight", "square")])
    found = _placed(rows, parts).drop("part").mapInArrow(_pairs, "a bigint, b bigint, dot double, share double, squares double")
    return found.groupBy("a", "b").agg(F.sum("dot").alias("dot"), F.sum("share").alias("share"), F.first("squares").alias("squares"))


REACHED, OWN, EXTRA = 0, 1, 2  # what a row of a task holds: cells that it reaches, cells of its own entities, numbers of entities


def _similar(k: int | None, tolerance: float):
    def run(batches):
        parts = {kind: ([], [], []) for kind in (REACHED, OWN, EXTRA)}
        for batch in batches:
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            for kind in np.unique(kinds):
                some = batch.filter(pa.array(kinds == kind))
                sizes, (entity, weight) = _flat(some, ("entity", "weight"))
                shared = np.empty(0, np.int64) if kind == EXTRA else np.repeat(some.column("shared").to_numpy(zero_copy_only=False), sizes)
                for held, new in zip(parts[kind], (shared, entity, weight), strict=True):
                    held.append(new)
        if not parts[OWN][0] or not parts[REACHED][0]:
            return
        _, ids, square = map(np.concatenate, parts[EXTRA])
        order = np.argsort(ids)
        ids, square = ids[order], square[order]
        shared, entity, weight = map(np.concatenate, parts[OWN])
        members, column = np.unique(shared, return_inverse=True)
        homes, row = np.unique(entity, return_inverse=True)
        mine, squares = _Rows(row, column, _narrow(weight), len(homes)), np.bincount(row, weight**2, len(homes))
        shared, entity, weight = map(np.concatenate, parts[REACHED])
        parts.clear()
        column, row = np.searchsorted(members, shared), np.searchsorted(ids, entity)
        dense = len(ids) * len(members) <= 4 * len(row)
        if dense:  # so many cells that a product of whole tables is less work
            others = np.zeros((len(members), len(ids)))
            np.add.at(others, (column, row), weight)
        else:
            by_member = _Rows(column, row, _narrow(weight), len(members))
        del shared, entity, weight, column, row
        out = _Out(["entity", "neighbour", "dot", "squares"])
        step = max(1, TABLE // len(ids)) if dense else 1
        for begin in range(0, len(homes), step):
            here = np.arange(begin, min(begin + step, len(homes)))
            at, sizes = mine.entries(here)
            if dense:
                table = np.zeros((len(here), len(members)))
                np.add.at(table, (np.repeat(here - begin, sizes), mine.column[at]), mine.value[at])
                rows = table @ others
            else:
                to, each = by_member.entries(mine.column[at])
                rows = np.bincount(by_member.column[to], np.repeat(mine.value[at].astype(float), each) * by_member.value[to], len(ids))[None]
            own = np.minimum(np.searchsorted(ids, homes[here]), len(ids) - 1)
            for r, dots, itself in zip(here, rows, own, strict=True):
                if ids[itself] == homes[r]:
                    dots[itself] = 0
                near = _best(dots / np.sqrt(square * squares[r]), k, tolerance)
                yield from out.add(np.full(len(near), homes[r]), ids[near], dots[near], square[near] * squares[r])
        yield from out.rest()

    return run


def neighbours(cells: DataFrame, entities: int, shared: Size, k: int | None = None, tolerance: float = 2e-6) -> DataFrame:
    """Cosines above zero of different entities: (entity, neighbour, sim).

    ``cells``: entity, shared, weight and ``square``, the entity's sum of squared weights; ``entities`` is the number of these, ``shared``
    the size of the cells by shared member. With ``k`` a task passes on only what can still be among the k largest of an entity: all
    not more than ``tolerance`` below the k-th; the choice is made afterwards."""
    named = cells.select("shared", "entity", F.col("weight").cast("double").alias("weight"), F.col("square").cast("double").alias("square"))
    if entities <= FEW:
        found = _few(named, "shared").where("a <> b").select(F.col("a").alias("entity"), F.col("b").alias("neighbour"), "dot", "squares")
        return found.select("entity", "neighbour", (F.col("dot") / F.sqrt("squares")).alias("sim"))
    blocks = max(1, -(-shared.cells // REACH))
    groups = max(min(groups_for(shared.pairs, entities, _cores(cells)), _cores(cells)), min(blocks, entities))
    named = named.withColumns({"group": _group_of("entity", groups), "block": _salt_of("entity", blocks)})
    own = materialize(packed(named, ["shared", "group"], shared.largest, "entity", "weight"), "own")
    reached = packed(named, ["shared", "block"], shared.largest, "entity", "weight")
    # The groups that a member's own entities live in are those that ask for it.
    met = own.select("shared", "group").distinct().join(reached, "shared")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    extra = named.groupBy("entity", "block").agg(F.first("square").alias("square"))
    extra = packed(extra, ["block"], entities, "entity", "square").select("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "entity", "square")
    part = (F.col("group") * blocks + F.col("block")).alias("part")
    rows = met.select(part, F.lit(REACHED).alias("kind"), "shared", "entity", "weight")
    rows = rows.unionByName(own.withColumn("block", every).select(part, F.lit(OWN).alias("kind"), "shared", "entity", "weight"))
    rows = rows.unionByName(extra.select(part, F.lit(EXTRA).alias("kind"), F.lit(None).cast("bigint").alias("shared"), "entity", F.col("square").alias("weight")))
    found = _placed(rows, groups * blocks).mapInArrow(_similar(k, tolerance), "entity bigint, neighbour bigint, dot double, squares double")
    return found.select("entity", "neighbour", (F.col("dot") / F.sqrt("squares")).alias("sim"))


def _chosen(by_items: np.ndarray, by_users: np.ndarray, k: int | None, tolerance: float) -> np.ndarray:
    if k is None:
        return np.flatnonzero((by_items > 0) | (by_users > 0))
    return np.union1d(_best(by_items, k, tolerance), _best(by_users, k, tolerance))


def _all_of(ids: np.ndarray) -> np.ndarray:
    """The different ids in order, by a table where these lie close together."""
    low, span = int(ids.min()), int(ids.max()) - int(ids.min()) + 1
    if span <= len(ids):
        there = np.zeros(span, bool)
        for begin in range(0, len(ids), STRETCH):
            there[ids[begin : begin + STRETCH].astype(np.int64) - low] = True
        return np.flatnonzero(there) + low
    found = np.empty(0, np.int64)
    for begin in range(0, len(ids), TABLE):
        found = np.union1d(found, ids[begin : begin + TABLE])
    return found


def _coded(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of ids in sorted known ones, by a table where these lie close together."""
    low, span = int(known[0]), int(known[-1]) - int(known[0]) + 1
    if span > 4 * len(known) + TABLE:
        return np.searchsorted(known, ids).astype(np.int32)
    table = np.zeros(span, np.int32)
    table[known - low] = np.arange(len(known))
    return table[ids - low if low else ids]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.flatnonzero(np.append(values[1:] != values[:-1], len(values) > 0))]


def _kth(scores: np.ndarray, k: int):
    """A bound for the k-th best score of different items, where all entries of an item have its score; 0 if there are fewer scores."""
    found = _distinct(scores)  # equal scores count as one, so this is not above the k-th best
    return found[-k] if len(found) >= k else 0


def _ahead(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the entries that are at least some score, which those of ``k`` items are if there are so many above zero."""
    width, most = len(scores) // CUTS, min(12 * k, CUTS)
    if width:
        rough = int(np.partition(scores[: width * CUTS].reshape(CUTS, width).max(axis=1), -most)[-most])
        at = np.flatnonzero(scores >= max(rough, 1))
        if len(at) >= k and _kth(scores[at], k) > 0:
            return at
    return np.flatnonzero(scores > 0)


class _Sums:
    """Sums by item of what a user's neighbours bring, for few of very many items."""

    def __init__(self, inorm: np.ndarray, largest: float, whole: bool) -> None:
        self.inorm, self.largest, self.whole = inorm, largest, whole
        self.by_items, self.by_users = np.zeros(len(inorm)), np.zeros(len(inorm))
        self.both = np.zeros(len(inorm) if whole else 0, np.int64)
        self.inverse = 1 / inorm
        self.steepest = float(self.inverse.max())

    def all(self, scaled, plain, sizes, there, theirs, seen):
        np.add.at(self.by_items, there, np.repeat(scaled, sizes) * theirs)
        np.add.at(self.by_users, there, np.repeat(plain, sizes) * theirs)
        self.by_items[seen] = self.by_users[seen] = 0
        near = np.unique(there)
        found = near, self.by_items[near] / self.inorm[near], self.by_users[near]
        self.by_items[near] = self.by_users[near] = 0
        return found

    def best(self, scaled, plain, sizes, there, theirs, seen, k: int | None, tolerance: float):
        """Items that can be among the k best, and both sums. Whole weights allow to add up both at once, rounded down, in the halves
        of one number; items that by these, with all that rounding can have taken, are not far enough below the k-th best get their sums in full."""
        most = self.largest * scaled.sum(), self.largest * plain.sum()
        if k is None or not self.whole or min(most) <= 0:
            return self.all(scaled, plain, sizes, there, theirs, seen)
        # One bit stays free for the sign, and some room for the rounding of the totals.
        units = [((1 << bits) - 1) * (1 - 1e-9) / total for bits, total in zip((HALF - 1, HALF), most, strict=True)]
        coded = ((scaled * units[0]).astype(np.int64) << HALF) + (plain * units[1]).astype(np.int64)
        added = np.repeat(coded, sizes)
        added *= theirs
        np.add.at(self.both, there, added)
        self.both[seen] = 0
        totals = self.both[there]
        self.both[there] = 0
        by_users = totals & (1 << HALF) - 1
        lost = self.largest * len(scaled)
        first = _ahead(by_users, k)
        low = int(_kth(by_users[first], k) - lost - tolerance * units[1]) - 1
        # The same items have a k-th best score by items, too. The lower half that these totals still have is less than a unit.
        by_items = totals.astype(float)
        by_items *= self.inverse[there]
        lost = ((lost + 1) * self.steepest + tolerance * units[0]) * (1 << HALF)
        edge = _kth(by_items[first], k) * (1 - 1e-9) - lost
        if low < 1 or edge < 1:
            return self.all(scaled, plain, sizes, there, theirs, seen)
        second = np.flatnonzero(by_items >= edge)
        by_items = by_items[second]
        second = second[by_items >= _kth(by_items, k) * (1 - 1e-9) - lost]
        first = first[by_users[first] >= low] if by_users[first].min() <= low else np.flatnonzero(by_users >= low)
        at = _distinct(np.concatenate([first, second]))
        codes = there[at]
        near = _distinct(codes)
        place = np.searchsorted(near, codes)
        row, value = np.searchsorted(np.cumsum(sizes), at, "right"), theirs[at]
        by_items, by_users = (np.bincount(place, brought[row] * value, len(near)) for brought in (scaled, plain))
        return near, by_items / self.inorm[near], by_users


class _Grown:
    """Arrays that follow each other, in one that is made for so many numbers and holds them in few bytes each. What is not filled takes no memory."""

    def __init__(self, kind, room: int) -> None:
        self.held, self.n = np.empty(max(room, 1), kind), 0

    def add(self, part: np.ndarray) -> None:
        kind, end = np.result_type(self.held.dtype, part.dtype), self.n + len(part)
        if kind != self.held.dtype or end > len(self.held):
            grown = np.empty(max(len(self.held), 2 * end if end > len(self.held) else 0), kind)
            grown[: self.n] = self.held[: self.n]
            self.held = grown
        self.held[self.n : end] = part
        self.n = end

    def all(self) -> np.ndarray:
        return self.held[: self.n]


def _score(k: int | None, tolerance: float, room: int):
    def run(batches):
        runs, norms = [], []
        column, value = _Grown(np.int32, room), _Grown(np.uint8, room)
        for batch in batches:
            sizes, (item, weight) = _flat(batch, ("item_id", "weight"))
            user = batch.column("user_id")
            if batch.num_rows and user.null_count:
                extra = np.repeat(user.is_null().to_numpy(zero_copy_only=False), sizes)
                norms.append((item[extra], weight[extra]))
                item, weight = item[~extra], weight[~extra]
                batch = batch.filter(user.is_valid())
                sizes = pa.compute.list_value_length(batch.column("item_id")).to_numpy(zero_copy_only=False)
            if batch.num_rows:
                small = item.astype(np.int32)
                column.add(small if np.array_equal(small, item) else item)
                value.add(_narrow(weight))
                flags = [batch.column(name).to_numpy(zero_copy_only=False).astype(bool) for name in ("own", "reached")]
                runs.append((batch.column("user_id").to_numpy(), sizes.astype(np.int32), *flags))
        if not column.n:
            return
        del batch, user, item, weight, small
        pa.default_memory_pool().release_unused()
        column, value = column.all(), value.all()
        runs, sizes, is_own, is_reached = map(np.concatenate, zip(*runs, strict=True))
        users, runs = np.unique(runs, return_inverse=True)
        own, reached = (np.bincount(runs, flags, len(users)) > 0 for flags in (is_own, is_reached))
        if norms:
            items, inorm = (np.concatenate(x) for x in zip(*norms, strict=True))
            order = np.argsort(items)
            items, inorm = items[order], inorm[order].astype(float)
        else:  # all cells are here
            items, inorm = _all_of(column), None
        for begin in range(0, len(column), STRETCH):
            column[begin : begin + STRETCH] = _coded(column[begin : begin + STRETCH], items)
        column = column.astype(np.int32, copy=False)
        if inorm is None:
            inorm = np.zeros(len(items))
            for begin in range(0, len(column), STRETCH):
                inorm += np.bincount(column[begin : begin + STRETCH], value[begin : begin + STRETCH].astype(float) ** 2, len(items))
            inorm = np.sqrt(inorm)
        inorm[inorm == 0] = 1
        inorm = np.append(inorm, 1)  # of the column that fills up
        by_user = _Rows.gathered(runs, sizes, column, value, len(users))
        del runs, sizes, column, value
        unorm = np.sqrt(by_user.squares())
        unorm[unorm == 0] = 1
        own &= np.diff(by_user.start) > 0
        largest = float(by_user.value.max())
        whole = by_user.value.dtype == np.uint8 and largest > 0
        if whole:
            by_user = _Lines(by_user, len(items))
        by_item = _turned(by_user, len(items), reached)
        out = _Out(["user_id", "item_id", "item_score", "user_score"])
        sums = _Sums(inorm, largest, whole)
        # The C library then keeps what arrays of a few MB gave back, instead of asking the system for each one's pages.
        np.empty(31 << 17)
        for n, r in enumerate(np.flatnonzero(own)):
            seen, rated, _ = by_user.of(np.array([r]))
            seen, rated = seen[seen < len(items)], rated[seen < len(items)].astype(float)
            met, common, sizes = by_item.of(seen)
            # What the user has in common with each other user reached: divided by the norms of the items, and as it is.
            others = met != r  # the own cells add nothing to items that are not seen
            met, plain = met[others], (np.repeat(rated, sizes) * common)[others]
            scaled = plain / np.repeat(inorm[seen], sizes)[others]
            if n % 8 == 0:  # worth adding up users that share several items?
                shared = 5 * len(_distinct(met)) < 4 * len(met)
            if shared:
                met, place = np.unique(met, return_inverse=True)
                scaled, plain = np.bincount(place, scaled, len(met)), np.bincount(place, plain, len(met))
            plain = plain / (unorm[met] * np.sqrt(rated @ rated))
            there, theirs, sizes = by_user.of(met)
            if 4 * len(there) < len(items):  # few of the items: only these are added up and looked at
                near, a, b = sums.best(scaled, plain, sizes, there, theirs, seen, k, tolerance)
                chosen = _chosen(a, b, k, tolerance)
                yield from out.add(np.full(len(chosen), users[r]), items[near[chosen]], a[chosen], b[chosen])
            else:
                a = np.bincount(there, np.repeat(scaled, sizes) * theirs, len(inorm)) / inorm
                b = np.bincount(there, np.repeat(plain, sizes) * theirs, len(inorm))
                a[seen] = b[seen] = 0
                chosen = _chosen(a, b, k, tolerance)
                yield from out.add(np.full(len(chosen), users[r]), items[chosen], a[chosen], b[chosen])
        yield from out.rest()

    return run


def _runs(batches):
    """Cells (user_id, item_id, weight) as rows (user_id, one array for each of the others): a stretch is put in order of its users, rows have at most ``PACK`` cells."""
    held, n = [], 0

    def rows():
        table = pa.Table.from_batches(held)
        user = table.column("user_id").to_numpy()
        order = None if (user[1:] >= user[:-1]).all() else np.argsort(user, kind="stable")
        user = user if order is None else user[order]
        begins = np.concatenate([[0], np.flatnonzero(user[1:] != user[:-1]) + 1]) if len(user) else np.empty(0, int)
        pieces = -(-np.diff(np.append(begins, len(user))) // PACK)
        begins = np.repeat(begins, pieces) + PACK * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        offsets = pa.array(np.append(begins, len(user)).astype(np.int32))
        lists = []
        for name in ("item_id", "weight"):
            values = table.column(name).combine_chunks()
            lists.append(pa.ListArray.from_arrays(offsets, values if order is None else values.take(pa.array(order))))
        return pa.RecordBatch.from_arrays([pa.array(user[begins]), *lists], ["user_id", "item_id", "weight"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= RUN:
            yield rows()
            held, n = [], 0
    if n:
        yield rows()


def _score_few(k: int | None, tolerance: float):
    def run(batches):
        links, packs = [], []
        for batch in batches:
            user = batch.column("user_id")
            for some, held in ((batch.filter(user.is_null()), links), (batch.filter(user.is_valid()), packs)):
                if some.num_rows:
                    single = some.column("a" if held is links else "user_id").to_numpy(zero_copy_only=False)
                    sizes, (item, weight, share) = _flat(some, ("item_id", "weight", "share"))
                    held.append((np.repeat(single, sizes), item, weight, share) if held is links else (np.repeat(single, sizes), item, weight))
        if not packs or not links:
            return
        a, b, cosine, share = map(np.concatenate, zip(*links, strict=True))
        items = np.unique(a)
        tables = np.zeros((2, len(items), len(items)))
        at = np.searchsorted(items, a), np.searchsorted(items, b)
        tables[0][at], tables[1][at] = cosine, share
        user, item, weight = map(np.concatenate, zip(*packs, strict=True))
        users, row = np.unique(user, return_inverse=True)
        mine = _Rows(row, np.searchsorted(items, item), _narrow(weight), len(users))
        out = _Out(["user_id", "item_id", "item_score", "user_score"])
        step = max(1, TABLE // len(items))
        for begin in range(0, len(users), step):
            cells = slice(mine.start[begin], mine.start[min(begin + step, len(users))])
            sizes = np.diff(mine.start[begin : begin + step + 1])
            here = np.repeat(np.arange(len(sizes)), sizes), mine.column[cells]
            table = np.zeros((len(sizes), len(items)))
            np.add.at(table, here, mine.value[cells])
            norm = np.sqrt((table**2).sum(axis=1))
            norm[norm == 0] = 1
            by_items, by_users = table @ tables[0], (table @ tables[1]) / norm[:, None]
            by_items[here] = by_users[here] = 0
            for r in range(len(sizes)):
                chosen = _chosen(by_items[r], by_users[r], k, tolerance)
                yield from out.add(np.full(len(chosen), users[begin + r]), items[chosen], by_items[r][chosen], by_users[r][chosen])
        yield from out.rest()

    return run


def item_norms(cells: DataFrame) -> DataFrame:
    """Rows (item_id, weight): the root of the sum of an item's squared weights."""
    squares = cells.groupBy("item_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("square"))
    return squares.select("item_id", F.sqrt(F.col("square").cast("double")).alias("weight"))


_SCORES = "user_id bigint, item_id bigint, item_score double, user_score double"


def _scores_of_few(named: DataFrame, own: DataFrame, size: Size, k: int | None, tolerance: float) -> DataFrame:
    """Scores by the links of the items, which fit into one table: each task has them all, and some users' cells."""
    links = _few(named.select("user_id", F.col("item_id").alias("entity"), "weight", (F.col("item_norm") * F.col("item_norm")).alias("square")), "user_id")
    listed = F.sort_array(F.collect_list(F.struct(F.col("b").alias("item_id"), (F.col("dot") / F.sqrt("squares")).alias("weight"), "share")))
    links = materialize(links.groupBy("a").agg(listed.alias("cells")), "links")
    parts = max(_cores(named), -(-size.cells // REACH))
    fields = [F.col(f"cells.{name}").alias(name) for name in ("item_id", "weight", "share")]
    links = links.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(None).cast("bigint").alias("user_id"), "a", *fields)
    users = packed(own, ["user_id"], size.largest, "item_id", "weight")
    users = users.select(_salt_of("user_id", parts).alias("part"), "user_id", F.lit(None).cast("bigint").alias("a"), "item_id", "weight", F.array().cast("array<double>").alias("share"))
    return _placed(links.unionByName(users), parts).mapInArrow(_score_few(k, tolerance), _SCORES)


def candidate_scores(
    cells: DataFrame, work: float, entities: int, users: Size, items: Size, k: int | None = None, wanted: DataFrame | None = None, tolerance: float = 2e-6, own_cells: int | None = None
) -> DataFrame:
    """Scores of unseen items: (user_id, item_id, item_score, user_score), at least one above zero.

    item_score = sum over rated items j of w_uj * cos(j, i); user_score = sum over other users v of cos(u, v) * w_vi. Both follow from what u has in common
    with each v, the first divided by the norms of the items, so neither items x items nor users x users are written. With few items both follow
    from sums over all v for each pair (j, i): v = u adds nothing to an item that u has not rated.

    ``cells``: user_id, item_id, weight; read several times. ``wanted`` (user_id) limits for whom scores are made, ``entities``
    is their number, ``own_cells`` that of their cells, ``users`` and ``items`` the size of the cells by each and ``work`` the number of products. With ``k`` a task
    passes on only what can still be among a user's k best by either score, see ``neighbours``. A task holds at least the whole row of each user that it reaches."""
    if items.entities <= FEW:
        named = cells.select("user_id", "item_id", F.col("weight").cast("double").alias("weight"))
        named = materialize(named.join(item_norms(cells).withColumnRenamed("weight", "item_norm"), "item_id"), "normed")
        own = named if wanted is None else named.join(wanted.select("user_id").distinct(), "user_id", "left_semi")
        return _scores_of_few(named, own, users, k, tolerance)
    groups = min(groups_for(work, entities, _cores(cells)), _cores(cells), MASK)
    home = _group_of("user_id", groups)
    met_by_group = (users.cells if own_cells is None else own_cells) / groups * items.pairs / max(users.cells, 1)
    if users.cells <= REACH * HELD and met_by_group >= COVERED * users.entities:
        # Every group meets nearly every user, and a task holds all cells: nothing to look up, and the norms follow from the cells.
        kind = cells.schema["weight"].dataType.simpleString()
        kind = kind if kind in ("tinyint", "smallint", "int") else "double"
        held = cells.dropna(subset=["user_id", "item_id"]).select("user_id", "item_id", F.col("weight").cast(kind).alias("weight"))
        runs = held.mapInArrow(_runs, f"user_id bigint, item_id array<bigint>, weight array<{kind}>")
        part = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
        rows = runs.select(part, "user_id", F.lit(True).alias("reached"), "item_id", "weight")
        rows = rows.withColumn("own", (home == F.col("part")) if wanted is None else F.lit(False))
        if wanted is not None:
            none = [F.array().cast(rows.schema[name].dataType).alias(name) for name in ("item_id", "weight")]
            rows = rows.unionByName(wanted.select("user_id").distinct().select(home.alias("part"), "user_id", F.lit(False).alias("reached"), *none, F.lit(True).alias("own")))
        return _placed(rows, groups).mapInArrow(_score(k, tolerance, users.cells), _SCORES)
    named = cells.select("user_id", "item_id", F.col("weight").cast("double").alias("weight"))
    own = named if wanted is None else named.join(wanted.select("user_id").distinct(), "user_id", "left_semi")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), home)
    # The groups that ask for an item, and for a user, are the bits of one number: few bytes leave here for many pairs.
    asked = own.groupBy("item_id").agg(F.bit_or(bit).alias("mask"))
    reached = named.select("item_id", "user_id").join(asked, "item_id").groupBy("user_id").agg(F.bit_or("mask").alias("mask"))
    if wanted is None:
        reached = reached.withColumn("wanted", F.lit(True))
    else:
        chosen = wanted.select("user_id").distinct().withColumn("found", F.lit(True))
        reached = reached.join(chosen, "user_id", "left").select("user_id", "mask", F.col("found").isNotNull().alias("wanted"))
    names = F.filter(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.call_function("getbit", F.col("mask"), g) == 1)
    met = materialize(packed(named, ["user_id"], users.largest, "item_id", "weight").join(reached, "user_id"), "packs")
    met = met.select("user_id", "n", "item_id", "weight", "wanted", F.explode(names).alias("group"))
    salts = _salts(met, users)
    salt = _salt_of("user_id", salts)
    mine = F.col("wanted") & (home == F.col("group"))
    if salts == 1:
        rows = met.withColumn("salt", F.lit(0)).withColumn("reached", F.lit(True))
    else:  # a group's own users are needed in all its tasks
        rows = met.withColumn("salt", F.explode(F.when(mine, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(salt)))).withColumn("reached", F.col("salt") == salt)
    rows = rows.select((F.col("group") * salts + F.col("salt")).alias("part"), "user_id", mine.alias("own"), "reached", "item_id", "weight")
    norms = packed(item_norms(cells).withColumn("all", F.lit(0)), ["all"], items.entities, "item_id", "weight")
    norms = norms.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups * salts - 1))).alias("part"), F.lit(None).cast("bigint").alias("user_id"), F.lit(False).alias("own"), F.lit(False).alias("reached"), "item_id", "weight"
    )
    found = _placed(rows.unionByName(norms), groups * salts).mapInArrow(_score(k if salts == 1 else None, tolerance, users.cells), _SCORES)
    if salts == 1:
        return found
    return found.groupBy("user_id", "item_id").agg(F.sum("item_score").alias("item_score"), F.sum("user_score").alias("user_score"))
