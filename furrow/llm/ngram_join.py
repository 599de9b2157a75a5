"""N-gram Jaccard join: prefix filter between documents, prefix trees within a block.

Two texts link when ``percent`` % of the union of their shingle sets is common.

1. Texts with equal sets are collapsed to one row of the smallest id.
2. A global order of the shingles: first the shingles of one hash class (one in
   ``_share``), rarest first, then the others by hash. The frequencies are counted
   over all documents. Two linked sets share a shingle among the first
   ``n - ceil(t n) + 1`` of each, whatever the order; the order only decides how
   few other pairs meet.
3. The documents of a shingle's posting meet in the block of the posting's
   smallest document, so a set is sent once per block and not once per shingle.
4. A block is a prefix tree of its ordered sets. Each set walks down the tree,
   shares the overlap counted so far between all sets below a node, and leaves a
   subtree when the remaining lengths cannot reach the threshold or when no set
   below is wanted. Blocks over ``BLOCK_SETS`` sets are split, each pair of parts
   being a task of its own.
5. The links that join up a block go to the distributed components.

A block never emits pairs: for the components at most one link less than it has sets,
and, where links are counted, one sum for each of its sets. For the components alone
a set looks only at sets that are not connected to it yet. To count links it looks at
all sets that it has not met in an earlier block, so that each pair is compared and
counted once: a set carries the homes of its blocks, and a pair belongs to the
smallest home that both have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import broadcast_if_small, local_components, narrow, segments, shingle_set
from furrow.llm.components import connected_components
from furrow.session import settle

#: A block with more sets, or more shingles in them, is split.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 4_000_000


def _share(percent: int) -> int:
    """One in how many shingles belongs to the counted class: about 2 to 2.5 times as
    many as a prefix needs, at most 5."""
    return max(1, min(5, 50 // max(1, 100 - percent)))


def _prefix(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _scan(k: int, percent: int):
    share = np.uint64(_share(percent))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = shingle_set(text, k)
                own = (s >> np.uint64(7)) % share == 0
                picked, need = s[own], _prefix(len(s), percent)
                rest = s[~own][: max(0, need - len(picked))]
                # Two independent 64-bit sums of the set.
                mixed = (s ^ (s >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
                a, b = mixed.sum(dtype=np.uint64), (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
                b = b.sum(dtype=np.uint64)
                rows.append((len(s), a.astype(np.int64), b.astype(np.int64), picked.view(np.int64), rest.view(np.int64)))
            out = pd.DataFrame(rows, columns=["n", "s1", "s2", "picked", "rest"])
            for at, name in enumerate(("node", "id", "void", "text_hash")):
                out.insert(at, name, batch[name].to_numpy())
            yield out

    return run


def _sets(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(text, k).view(np.int64) for text in batch["text"]]
            yield batch.drop(columns="text").assign(shingles=sets)

    return run


class PrefixTree:
    """The compressed prefix tree of ordered sets, as arrays over its nodes.

    Shingles that one set alone has cannot match and count only as length."""

    def __init__(self, sets: list[np.ndarray], rank_of: np.ndarray, inverse: np.ndarray, shared: np.ndarray):
        ends = np.cumsum([len(s) for s in sets])
        self.n = np.array([len(s) for s in sets])
        paths = []
        for start, end in zip(ends - self.n, ends, strict=True):
            ranks = inverse[start:end]
            paths.append(np.sort(rank_of[ranks[shared[ranks]]]))
        keys = [p.astype(">u4").tobytes() for p in paths]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.paths = [paths[i] for i in self.order]
        self.n = self.n[self.order]
        self.lengths = np.array([len(p) for p in self.paths])
        common = [0]
        for x, y in zip(self.paths[:-1], self.paths[1:], strict=True):
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            common.append(int(differ[0]) if len(differ) else m)
        self._build(np.array(common))

    def _build(self, common: np.ndarray) -> None:
        low, high, leaf, depth, parts, children = [], [], [], [], [], []
        todo = [(0, len(self.paths), 0, -1)]
        while todo:
            a, b, start, parent = todo.pop()
            node = len(low)
            end = self.lengths[a] if b - a == 1 else int(common[a + 1 : b].min())
            low.append(a), high.append(b), leaf.append(b - a == 1), depth.append(end)
            parts.append(self.paths[a][start:end])
            children.append([])
            if parent >= 0:
                children[parent].append(node)
            if b - a > 1:
                cuts = [a, *(np.flatnonzero(common[a + 1 : b] == end) + a + 1).tolist(), b]
                todo += [(x, y, end, node) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        self.low, self.high, self.leaf, self.depth = np.array(low), np.array(high), np.array(leaf), np.array(depth)
        sizes = np.array([len(p) for p in parts])
        self.flat = np.concatenate(parts)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.kids = np.array([c for own in children for c in own], dtype=np.int64)
        self.kid_ends = np.cumsum([len(own) for own in children])
        self.kid_starts = self.kid_ends - np.array([len(own) for own in children])
        self.longest = np.array([self.lengths[a:b].max() for a, b in zip(low, high, strict=True)])
        self.fewest = np.array([self.n[a:b].min() for a, b in zip(low, high, strict=True)])
        # The last rank on the way to a node: later shingles of a probe are still open.
        self.last = np.array([self.paths[a][d - 1] if d else -1 for a, d in zip(low, depth, strict=True)])

    @staticmethod
    def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return np.arange(sizes.sum()) + shift

    def partners(self, i: int, wanted: np.ndarray, percent: int, has: np.ndarray) -> np.ndarray:
        """The places of ``wanted`` whose sets link with the one at place ``i``."""
        probe = self.paths[i]
        has[probe] = True
        below = np.concatenate([[0], np.cumsum(wanted)])
        nodes, overlap, found = np.array([0]), np.array([0]), []
        while len(nodes):
            starts, ends = self.starts[nodes], self.ends[nodes]
            matched = np.concatenate([[0], np.cumsum(has[self.flat[self._ranges(starts, ends)]])])
            bounds = np.cumsum(ends - starts)
            overlap = overlap + matched[bounds] - matched[bounds - (ends - starts)]
            open_here = len(probe) - np.searchsorted(probe, self.last[nodes], side="right")
            most = overlap + np.minimum(self.longest[nodes] - self.depth[nodes], open_here)
            alive = ((100 + percent) * most >= percent * (self.n[i] + self.fewest[nodes])) & (
                below[self.high[nodes]] > below[self.low[nodes]]
            )
            nodes, overlap = nodes[alive], overlap[alive]
            at_leaf = self.leaf[nodes]
            # At a leaf nothing is open, so the bound was the exact test.
            found.append(self.low[nodes[at_leaf]])
            nodes, overlap = nodes[~at_leaf], overlap[~at_leaf]
            a, b = self.kid_starts[nodes], self.kid_ends[nodes]
            overlap = np.repeat(overlap, b - a)
            nodes = self.kids[self._ranges(a, b)]
        has[probe] = False
        return np.concatenate(found) if found else np.array([], dtype=np.int64)


class Meetings:
    """Which sets of a block have met in an earlier block, by the homes they share."""

    def __init__(self, homes: list[np.ndarray]):
        sizes = np.array([len(h) for h in homes])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        every = np.concatenate(homes) if len(homes) else np.array([], dtype=np.int64)
        values, self.which = np.unique(every, return_inverse=True)
        self.members = np.repeat(np.arange(len(homes)), sizes)[np.argsort(self.which, kind="stable")]
        self.to = np.cumsum(np.bincount(self.which, minlength=len(values)))
        self.fro = np.concatenate([[0], self.to[:-1]])

    def of(self, i: int) -> np.ndarray:
        own = self.which[self.starts[i] : self.ends[i]]
        return self.members[PrefixTree._ranges(self.fro[own], self.to[own])] if len(own) else own


def block_links(
    sets: list[np.ndarray],
    side: np.ndarray,
    across: bool,
    percent: int,
    weight: np.ndarray | None = None,
    homes: list[np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """For each set of a block the smallest place it is connected to in the block, and
    the sum of the weights of the sets it links with.

    ``across``: only sets of different sides are compared, else all. Without ``weight``
    the sums are zero and sets that are already connected are not compared. With it
    sets that share one of ``homes``, the earlier blocks of each, are left to those."""
    every = np.concatenate(sets) if sets else np.array([], dtype=np.int64)
    values, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
    order = np.lexsort((values, count))
    rank_of = np.empty(len(values), dtype=np.int64)
    rank_of[order] = np.arange(len(values))
    tree = PrefixTree(sets, rank_of, inverse, count > 1)
    side = side[tree.order]
    label, has = np.arange(len(sets)), np.zeros(len(values), dtype=bool)
    place, sums = np.arange(len(sets)), np.zeros(len(sets), dtype=np.int64)
    if weight is not None:
        heavy = np.asarray(weight, dtype=np.int64)[tree.order]
        met = Meetings([homes[i] for i in tree.order])
    for i in range(len(sets)):
        if across and side[i] != side.min():
            continue
        wanted = (side != side[i]) if across else (place > i)
        if weight is None:
            wanted &= label != label[i]
        else:
            wanted[met.of(i)] = False
        if not wanted.any():
            continue
        found = tree.partners(i, wanted, percent, has)
        found = found[wanted[found]]
        if weight is not None:
            sums[i] += heavy[found].sum()
            sums[found] += heavy[i]
        joined = np.unique(label[found])
        joined = joined[joined != label[i]]
        if len(joined):
            label[np.isin(label, joined) | (label == label[i])] = min(label[i], joined[0])
    back, total = np.empty(len(sets), dtype=np.int64), np.empty(len(sets), dtype=np.int64)
    back[tree.order] = np.array(tree.order)[label]
    total[tree.order] = sums
    return local_components(len(sets), np.arange(len(sets)), back), total


def _walk(percent: int, count_links: bool):
    def work(key: str, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        _, i, j = key.split(":")
        # Rows alike in id and text brought the same set along.
        rows = rows.drop_duplicates("node")
        sets = [np.asarray(s) for s in rows["shingles"]]
        ids, weight, homes = rows["id"].to_numpy(), None, None
        if count_links:
            weight, homes = rows["copies"].to_numpy(), [np.asarray(h, dtype=np.int64) for h in rows["homes"]]
        root, sums = block_links(sets, rows["part"].to_numpy(), i != j, percent, weight, homes)
        out = pd.DataFrame({"node": rows["node"].to_numpy(), "links": sums, "a": ids, "b": ids[root]})
        yield out[(out["links"] > 0) | (out["a"] != out["b"])]

    return work


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, count_links: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles`` and ``component_id``, the
    smallest id reachable over links between shingle sets. With ``count_links`` also
    ``n_links``, the number of other rows that the row links with directly, copies
    counted one by one.

    A null, empty or wordless text has an empty set and links with nothing. A row
    without an id keeps a null component, takes no part and has no links. Rows that
    share an id are one node of the components, tied even where their texts do not
    link; ``n_links`` is counted for each of them alone, over all rows. Texts with
    equal sets are linked. An empty table gives an empty one, and further columns are
    left behind. Words are separated by ASCII white space, with A-Z in lower case;
    shingles are compared by 64-bit hashes.
    """
    # A null id is carried as a flag: pandas would turn the whole column to floats.
    base = narrow(docs, id=id_col, text=text_col).select(
        F.coalesce("id", F.lit(0)).cast("long").alias("id"), F.col("id").isNull().alias("void"), F.xxhash64("text").alias("text_hash"), "text"
    )
    scanned = settle(
        base.select(F.monotonically_increasing_id().alias("node"), "*").mapInPandas(
            _scan(k, percent),
            "node long, id long, void boolean, text_hash long, n int, s1 long, s2 long, picked array<long>, rest array<long>",
        )
    )
    sets = scanned.where("not void and n > 0")
    equal = ["n", "s1", "s2"]
    copies = settle(
        sets.groupBy(*equal).agg(F.min(F.struct("id", "node")).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    )
    placed = scanned.select("id", "void", "node", *equal).join(copies, equal, "left").select(
        "id",
        "void",
        "node",
        "n",
        F.when(~F.col("void"), F.coalesce("first.id", "id")).alias("rep"),
        F.coalesce("first.node", "node").alias("own"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
    )
    # Of rows with equal sets one is compared, as a node of its own.
    left = broadcast_if_small(settle(placed.where("not void and n > 0 and own != node").select("node")))
    kept = sets.join(left, "node", "left_anti")
    spread = kept.select("node", F.explode("picked").alias("g"))
    common = spread.groupBy("g").agg(F.count("*").alias("df")).where("df > 1")
    meta = kept.select("node", "n", F.size("picked").alias("counted"))
    by_rank = Window.partitionBy("node").orderBy("df", "g")
    ranked = spread.join(common, "g").select(
        "node", "g", F.row_number().over(by_rank).alias("place"), F.count("*").over(Window.partitionBy("node")).alias("met")
    )
    need = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    first = ranked.join(meta, "node").where(F.col("place") <= need - (F.col("counted") - F.col("met"))).select("node", "g", "n")
    postings = settle(first.union(kept.select("node", F.explode("rest").alias("g"), "n")))
    homes = postings.groupBy("g").agg(F.min("node").alias("home"), F.max("node").alias("far")).where("home < far").drop("far")
    met = settle(postings.join(homes, "g").groupBy("home", "node").agg(F.max("n").alias("n")))
    sizes = met.groupBy("home").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("parts")
    )
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("long")
    dealt = (
        met.join(sizes, "home")
        .select("home", "node", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
        .select(
            "node",
            "home",
            F.concat_ws(":", "home", F.least("part", "with"), F.greatest("part", "with"), "part").alias("group"),
        )
    )
    met_in = F.collect_set("home") if count_links else F.array().cast("array<long>")
    grouped = dealt.groupBy("node").agg(F.collect_list("group").alias("groups"), met_in.alias("met_in"))
    owners = kept.select("node", "id", "text_hash", *equal).join(copies.drop("first"), equal, "left")
    groups = settle(
        owners.select("node", "id", "text_hash", F.coalesce("copies", F.lit(1)).alias("copies")).join(grouped, "node")
    )
    home = F.substring_index("group", ":", 1).cast("long")
    blocks = (
        base.drop("void")
        .join(broadcast_if_small(groups, 200_000), ["id", "text_hash"])
        .select("node", "id", "copies", "met_in", "groups", "text")
        .mapInPandas(_sets(k), "node long, id long, copies long, met_in array<long>, groups array<string>, shingles array<long>")
        .select("node", "id", "copies", "met_in", "shingles", F.explode("groups").alias("group"))
        .select(
            "node",
            "id",
            "copies",
            F.filter("met_in", lambda other: other < home).alias("homes"),
            "shingles",
            F.substring_index("group", ":", 3).alias("block"),
            F.substring_index("group", ":", -1).cast("int").alias("part"),
        )
    )
    links = segments(blocks, "block", _walk(percent, count_links), "node long, links long, a long, b long")
    if count_links:
        links = settle(links)
    ids = placed.where("not void and n > 0").groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    several = settle(ids.where("low != high").select("id"))
    tied = placed.where("not void and n > 0").join(broadcast_if_small(several), "id", "left_semi").select("id", "rep")
    roots = connected_components(links.where("a != b").select("a", "b").union(tied)).select(F.col("node").alias("rep"), "component")
    rooted = placed.join(roots, "rep", "left")
    found = [
        F.when(~F.col("void"), F.col("id")).alias("id"),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "rep").alias("component_id"),
    ]
    if not count_links:
        return rooted.select(*found)
    counted = links.groupBy("node").agg(F.sum("links").alias("links")).where("links > 0").withColumnRenamed("node", "own")
    n_links = F.when(~F.col("void") & (F.col("n") > 0), F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0)
    return rooted.join(counted, "own", "left").select(*found, n_links.cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all columns kept.

    Rows without an id and texts without words stay. Of rows that share an id, all stay or
    all go. An empty table gives an empty one."""
    groups = jaccard_components(docs, id_col, text_col, k, percent)
    gone = broadcast_if_small(settle(groups.where("id != component_id").select("id").distinct()))
    return docs.join(gone, docs[id_col] == gone["id"], "left_anti")
