"""Deep forests grown and scored without ever being held as a whole.

MLlib sums every candidate split of every node in every partition, also where a node has
a handful of rows left, and the driver holds all nodes. Here a task grows some trees of a
fold, one after the other. It gets the fold's binned rows once, keeps them in a file of its
own and reads what a tree asks for block by block, so that it holds no more than
``NODE_ROWS`` rows of a bag: larger nodes are split by sums over the blocks first. The rows
to be predicted take part in no split; they walk down with the tree as it grows, nodes that
none of them reaches are not grown, and only the sums of what they are told leave the task.

The trees are MLlib's otherwise: variance, one bag with Poisson weights a tree, all
features at every split, candidates between the values of a feature or at its quantiles.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.models.regression import BINS, SEED, spread
from furrow.operators.evaluation import LABEL
from furrow.session import settle

#: Rows of a bag that a task holds to grow the rest of a tree from.
NODE_ROWS = 1_000_000
#: Nodes whose candidate sums are made together, so that they stay in a core's cache.
NODES_AT_ONCE = 2_048
#: P(weight <= k) of a row in a bag.
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 15)]))
#: A fall of the squared error below this share of the node's is rounding.
TINY = 1e-10


def candidates(rows: DataFrame, names: Sequence[str], cuts: Sequence[tuple[int, int]], bins: int) -> list[tuple[list[np.ndarray], int, float]]:
    """Of the rows that each fold learns from, per feature the values ``t`` of its splits
    ``value <= t``: between its values if they are at most ``bins``, else its quantiles. With
    them the number of rows and their mean label. The same two passes tell it for all folds."""
    shares = [i / bins for i in range(1, bins)]
    folds = F.explode(F.array(*[F.when(F.col("year") < first, F.lit(i)) for i, (first, _) in enumerate(cuts)]))
    learned = rows.select(folds.alias("_fold"), F.col(LABEL).alias("_y"), *[F.col(f"`{n}`").cast("double").alias(f"_{i}") for i, n in enumerate(names)])
    by_fold = learned.where("_fold is not null").groupBy("_fold")
    told = by_fold.agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("m"), *[
        F.struct(F.approx_count_distinct(f"_{i}").alias("k"), F.percentile_approx(f"_{i}", shares, 10_000).alias("q")).alias(str(i)) for i in range(len(names))
    ]).orderBy("_fold").collect()
    few = [i for i in range(len(names)) if any(r[str(i)]["k"] <= 2 * bins for r in told)]
    # A feature with many values in this fold has few in another: its set stays empty here.
    kept = {i: F.array(*[F.lit(r["_fold"]) for r in told if r[str(i)]["k"] <= 2 * bins]) for i in few}
    sets = by_fold.agg(*[F.collect_set(F.when(F.array_contains(kept[i], F.col("_fold")), F.col(f"_{i}"))).alias(str(i)) for i in few]).orderBy("_fold").collect() if few else []
    found = []
    for place, r in enumerate(told):
        edges = [np.unique(r[str(i)]["q"]) for i in range(len(names))]
        for i in few:
            own = sets[place][str(i)]
            if r[str(i)]["k"] <= 2 * bins and len(own) <= bins:
                values = np.sort(own)
                edges[i] = (values[:-1] + values[1:]) / 2
        found.append((edges, r["n"], r["m"]))
    return found


def weights(ids: np.ndarray, tree: int, fold: int) -> np.ndarray:
    """How often each row is in the bag of a tree, from a hash of its id."""
    with np.errstate(over="ignore"):
        h = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(1 + tree + 65536 * (fold + 64 * SEED))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15), (30, 0xBF58476D1CE4E5B9)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(POISSON, (h >> np.uint64(11)) / 2.0**53, side="right")


def _total(cells: np.ndarray) -> np.ndarray:
    """The sum over the first axis, in the order in which numpy adds up a row of that length:
    a split that rounding decides is then the same for one node and for many."""
    size, whole = len(cells), len(cells) // 8 * 8
    total = np.zeros_like(cells[0])
    if whole:
        r = cells[:8].copy()
        for i in range(8, whole, 8):
            r += cells[i:i + 8]
        total += ((r[0] + r[1]) + (r[2] + r[3])) + ((r[4] + r[5]) + (r[6] + r[7]))
    for i in range(whole, size):
        total += cells[i]
    return total


def _gains(cells: np.ndarray) -> np.ndarray:
    """Per candidate (first axis) and node, what the squares of the sums gain by the split.
    ``cells`` are the weights of each bin, and as imaginary parts the weighted labels."""
    before = np.cumsum(cells, axis=0)[:-1]
    after = _total(cells) - before
    left, below, right, above = before.real.copy(), before.imag.copy(), after.real.copy(), after.imag.copy()
    parted = (left > 0.5) & (right > 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        np.divide(np.multiply(below, below, out=below), left, out=below)
        np.divide(np.multiply(above, above, out=above), right, out=above)
        gains = np.add(below, above, out=below)
    np.copyto(gains, -np.inf, where=~parted)
    return gains


def grow(b: np.ndarray, w: np.ndarray, y: np.ndarray, asked: np.ndarray, sizes: Sequence[int], start: int, ends: Sequence[int]) -> np.ndarray:
    """What a tree grown from binned rows ``b`` at depth ``start`` predicts for the rows
    ``asked`` if it ends at each depth of ``ends``; ``sizes`` are the bins of each feature."""
    told, last = np.zeros((len(asked), len(ends))), np.zeros(len(asked))
    middle = np.average(y, weights=w)
    # Weights and weighted labels are added up in one pass, as the parts of a complex number.
    both, squares = w + 1j * (w * (y - middle)), w * (y - middle) ** 2
    # By feature, as each is summed on its own.
    b, asked = np.ascontiguousarray(b.T), np.ascontiguousarray(asked.T)
    at, k = np.zeros(len(y), dtype=np.int64), 1
    rows, down = np.arange(len(told)), np.zeros(len(told), dtype=np.int64)
    for depth in range(start, max(ends) + 1):
        if k:
            sums = np.zeros(k, dtype=complex)
            np.add.at(sums, at, both)
            n, s = sums.real, sums.imag
            last[rows] = middle + (s / n)[down]
        for i, end in enumerate(ends):
            if end == depth:
                told[:, i] = last
        if depth == max(ends) or not k:
            continue
        best, feature, cut = s * s / n + TINY * np.bincount(at, squares, k), np.full(k, -1), np.zeros(k, dtype=np.int64)
        # Where no row is asked for, none is told. Deep down many nodes hold one row, or equal
        # ones, and no split gains by them.
        wanted = np.bincount(down, minlength=k) > 0
        if k > NODES_AT_ONCE:
            some = np.zeros(k)
            some[at] = y
            wanted &= np.bincount(at, y != some[at], k) > 0
        tried, node = np.flatnonzero(wanted), at
        if len(tried) < k:
            place_of = np.full(k, -1)
            place_of[tried] = np.arange(len(tried))
            node = place_of[at]
            own = np.flatnonzero(node >= 0)
            b, y, both, squares, at, node = np.take(b, own, axis=1), y[own], both[own], squares[own], at[own], node[own]
        # Many nodes come sorted, each with its rows in their old order.
        step = NODES_AT_ONCE if k > NODES_AT_ONCE else max(k, 1)
        for lo in range(0, len(tried), step):
            here, m = tried[lo:lo + step], min(step, len(tried) - lo)
            own = slice(*np.searchsorted(node, [lo, lo + m])) if m < len(tried) else slice(None)
            values, places = both[own], node[own] - lo if lo else node[own]
            cell = np.empty(len(places), dtype=np.int64)
            for f, size in enumerate(sizes):
                if size < 2:
                    continue
                np.multiply(b[f, own], m, out=cell, dtype=np.int64)
                cell += places
                cells = np.zeros(size * m, dtype=complex)
                np.add.at(cells, cell, values)
                gains = _gains(cells.reshape(size, m))
                gain = gains.max(axis=0)
                better = np.flatnonzero(gain > best[here])
                if len(better):
                    best[here[better]], feature[here[better]], cut[here[better]] = gain[better], f, gains[:, better].argmax(axis=0)
        child = 2 * (np.cumsum(feature >= 0) - 1)
        k = 2 * int((feature >= 0).sum())
        split = feature[at]
        stays, many = split >= 0, len(at)
        own = np.arange(many)
        if not stays.all():
            own = np.flatnonzero(stays)
            split, at = split[own], at[own]
        at = child[at] + (b.ravel()[split * many + own] > cut[at])
        if k > NODES_AT_ONCE:
            order = np.argsort(at.astype(np.uint16) if k <= 2**16 else at, kind="stable")
            own, at = own[order], at[order]
        if k and (k > NODES_AT_ONCE or len(own) < many):
            b, y, both, squares = np.take(b, own, axis=1), y[own], both[own], squares[own]
        stays = feature[down] >= 0
        rows, down = rows[stays], down[stays]
        down = child[down] + (asked[feature[down], rows] > cut[down])
    return told


class Rows:
    """The binned rows of a fold in a file of the task's own, read by blocks in the order of
    their places, however they arrive: rounding, which breaks ties, depends on the order. A
    block holds ids, labels and then each feature's bins."""

    def __init__(self, features: int, kind: str) -> None:
        self.features, self.kind = features, np.dtype(kind)
        self.file, self.index = tempfile.TemporaryFile(), []

    def add(self, place: int, learns: bool, n: int, block: bytes) -> None:
        self.index.append((learns, place, n, self.file.tell()))
        self.file.write(block)

    def blocks(self, learns: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for _, _, n, start in sorted(i for i in self.index if i[0] == learns):
            self.file.seek(start)
            block = self.file.read(n * (16 + self.features * self.kind.itemsize))
            yield np.frombuffer(block, "<i8", n), np.frombuffer(block, "<f8", n, 8 * n), np.frombuffer(block, self.kind, offset=16 * n).reshape(self.features, n)


def _packed(ids: np.ndarray, y: np.ndarray, b: np.ndarray) -> bytes:
    return ids.astype("<i8").tobytes() + y.astype("<f8").tobytes() + b.tobytes()


class Top:
    """The splits of the nodes of a tree that are too large to be held, and what they predict.
    A node's children are numbered 2 * node and 2 * node + 1; the root is 1."""

    def __init__(self, rows: Rows, fold: int, tree: int, sizes: Sequence[int], n: int, mean: float, deepest: int, node_rows: int) -> None:
        self.rows, self.fold, self.tree, self.sizes, self.mean = rows, fold, tree, sizes, mean
        self.values, self.splits = {1: mean}, {}
        #: The rows of each node that is held, at most. None of a large one that no split parts.
        self.held: dict[int, int] = {} if n > node_rows else {1: n}
        opened = [1] if n > node_rows else []
        while opened:
            opened = self._split(opened, deepest, node_rows)

    def route(self, b: np.ndarray) -> np.ndarray:
        at = np.ones(b.shape[1], dtype=np.int64)
        for node, (feature, cut) in sorted(self.splits.items()):
            here = np.flatnonzero(at == node)
            at[here] = 2 * node + (b[feature, here] > cut)
        return at

    def bag(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Node, weight, label and bins of the rows in the tree's bag, by blocks."""
        for ids, y, b in self.rows.blocks(True):
            w = weights(ids, self.tree, self.fold)
            own = np.flatnonzero(w > 0)
            b = b[:, own]
            yield self.route(b), w[own].astype(float), y[own], b

    def _split(self, opened: list[int], deepest: int, node_rows: int) -> list[int]:
        """One more level: the open nodes are split by sums over the blocks."""
        nodes, k = np.array(opened), len(opened)
        counts = [np.zeros(size * k, dtype=np.int64) for size in self.sizes]
        sums, squares = [np.zeros(size * k, dtype=complex) for size in self.sizes], np.zeros(k)
        for at, w, y, b in self.bag():
            place = np.minimum(np.searchsorted(nodes, at), k - 1)
            own = np.flatnonzero(nodes[place] == at)
            place, w, y = place[own], w[own], y[own] - self.mean
            squares += np.bincount(place, w * y * y, k)
            both = w + 1j * (w * y)
            for f, size in enumerate(self.sizes):
                cell = b[f, own] * np.int64(k) + place
                counts[f] += np.bincount(cell, minlength=size * k)
                np.add.at(sums[f], cell, both)
        counts, cells = ([part.reshape(size, k) for part, size in zip(all_, self.sizes)] for all_ in (counts, sums))
        gains = [_gains(own) for own in cells]
        left = []
        for i, node in enumerate(opened):
            whole = cells[0][:, i].sum()
            n, y = whole.real, whole.imag
            self.values[node] = self.mean + y / n if n else self.mean
            best, found = y * y / n + TINY * squares[i] if n else 0.0, None
            for f, size in enumerate(self.sizes):
                if size < 2 or node.bit_length() > deepest:
                    continue
                gain = gains[f][:, i]
                if gain.max() > best:
                    best, found = gain.max(), (f, int(gain.argmax()))
            if found is None:
                self.held[node] = 0
                continue
            self.splits[node] = found
            sides = counts[found[0]][:, i]
            for child, m in ((2 * node, int(sides[:found[1] + 1].sum())), (2 * node + 1, int(sides[found[1] + 1:].sum()))):
                if m > node_rows:
                    left.append(child)
                else:
                    self.held[child] = m
        return sorted(left)

    def told(self, many: int, ends: Sequence[int], node_rows: int) -> np.ndarray:
        """What the tree predicts for each of the ``many`` rows asked for, per depth of ``ends``."""
        told = np.zeros((many, len(ends)))
        together: list[list[int]] = [[]]
        for node, n in sorted(self.held.items()):
            if together[-1] and sum(self.held[other] for other in together[-1]) + n > node_rows:
                together.append([])
            together[-1].append(node)
        for nodes in together:
            grown = [node for node in nodes if self.held[node]]
            learned = [(at[own], w[own], y[own], b[:, own]) for at, w, y, b in self.bag() for own in [np.flatnonzero(np.isin(at, grown))]] if grown else []
            asked, before = [], 0
            for _, _, b in self.rows.blocks(False):
                at = self.route(b)
                own = np.flatnonzero(np.isin(at, nodes))
                asked.append((at[own], before + own, b[:, own]))
                before += len(at)
            if not asked:
                continue
            at, place, b = (np.concatenate(part, axis=-1) for part in zip(*asked))
            del asked
            whole = [np.concatenate(part, axis=-1) for part in zip(*learned)]
            del learned
            for node in nodes:
                here = np.flatnonzero(at == node)
                own = np.flatnonzero(whole[0] == node) if whole else []
                told[place[here]] = self._grown(node, [part[..., own] for part in whole[1:]] if len(own) else [], b[:, here], ends)
        return told

    def _grown(self, node: int, learned: list[np.ndarray], asked: np.ndarray, ends: Sequence[int]) -> np.ndarray:
        depth = node.bit_length() - 1
        later = [e for e in ends if e >= depth]
        told = np.zeros((asked.shape[1], len(ends)))
        for i, end in enumerate(ends):
            if end < depth or not learned:
                told[:, i] = self.values[node >> max(0, depth - end)]
        if learned and later and asked.shape[1]:
            w, y, b = learned
            told[:, len(ends) - len(later):] = grow(b.T, w, y, asked.T, self.sizes, depth, later)
        return told


def fold_errors(
    features: DataFrame, names: Sequence[str], cuts: Sequence[tuple[int, int]], grid: Sequence[tuple[int, int]], bins: int = BINS, node_rows: int = NODE_ROWS
) -> list[list[float]]:
    """Per fold, which learns from the years before ``first`` and is scored on those before
    ``end``, the mean absolute error of each (trees, depth) cut out of one forest."""
    most, ends = max(t for t, _ in grid), sorted({d for _, d in grid})
    assembled = VectorAssembler(inputCols=list(names), outputCol="_features").transform(spread(features))
    # Written, so that a row keeps its id and with it its place in the bags.
    base = settle(assembled.select(F.monotonically_increasing_id().alias("id"), "year", F.col(LABEL).cast("double").alias("y"), vector_to_array("_features").alias("x")))
    learned = candidates(features, names, cuts, bins)
    edges, kind = [own for own, _, _ in learned], "<u2" if bins > 256 else "u1"
    sizes = [[len(t) + 1 for t in own] for own in edges]

    def deal(batches):
        for i, batch in enumerate(batches):
            if not len(batch):
                continue
            place = (TaskContext.get().partitionId() << 32) + i
            x, year, ids, y = np.vstack(batch["x"].to_numpy()), *(batch[c].to_numpy() for c in ("year", "id", "y"))
            for fold, (first, end) in enumerate(cuts):
                for learns, own in ((True, np.flatnonzero(year < first)), (False, np.flatnonzero((year >= first) & (year < end)))):
                    if len(own):
                        b = np.stack([np.searchsorted(t, x[own, f], side="left") for f, t in enumerate(edges[fold])]).astype(kind)
                        yield pd.DataFrame([(fold, learns, place, len(own), _packed(ids[own], y[own], b))], columns=["fold", "learns", "place", "n", "rows"])

    def finish(batches):
        held: dict[tuple[int, int], Rows] = {}
        for batch in batches:
            for fold, part, place, learns, n, rows in zip(*(batch[c] for c in ("fold", "part", "place", "learns", "n", "rows"))):
                if (fold, part) not in held:
                    held[fold, part] = Rows(len(names), kind)
                held[fold, part].add(place, learns, n, rows)
        for (fold, part), rows in held.items():
            many = sum(n for learns, _, n, _ in rows.index if not learns)
            shares = np.zeros((many, len(grid)))
            for tree in range(part, most, parts):
                told = Top(rows, fold, tree, sizes[fold], *learned[fold][1:], max(ends), node_rows).told(many, ends, node_rows)
                for i, (t, d) in enumerate(grid):
                    if tree < t:
                        shares[:, i] += told[:, ends.index(d)] / t
            before = 0
            for ids, y, _ in rows.blocks(False):
                own = shares[before:before + len(ids)]
                before += len(ids)
                yield pd.DataFrame({"fold": fold, "id": ids, "y": y, **{f"p{i}": own[:, i] for i in range(len(grid))}})

    # A task for some trees of a fold; the folds with the most rows come first.
    parts = min(most, features.sparkSession.sparkContext.defaultParallelism)
    dealt = base.mapInPandas(deal, "fold int, learns boolean, place long, n int, rows binary").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    task = (F.lit(len(cuts) - 1) - F.col("fold")) * F.lit(parts) + F.col("part")
    shape = ", ".join(["fold int, id long, y double", *[f"p{i} double" for i in range(len(grid))]])
    told = dealt.repartitionById(len(cuts) * parts, task.cast("int")).mapInPandas(finish, shape)
    scored = told.groupBy("fold", "id").agg(F.max("y").alias("y"), *[F.sum(f"p{i}").alias(f"p{i}") for i in range(len(grid))])
    errors = scored.groupBy("fold").agg(F.array(*[F.avg(F.abs(F.col("y") - F.col(f"p{i}"))) for i in range(len(grid))]).alias("mae"))
    return [r["mae"] for r in errors.orderBy("fold").collect()]
