"""Second-order boosted trees on Spark: regularised gains, depth-wise or leaf-wise growth, patience, learned directions for nulls.

The rows are binned once and kept as blocks of arrays. A pass over the blocks builds histograms of gradients, Hessians and counts per
(tree node, feature, bin); they are summed by a shuffle on groups of features, where the best split of each node is found too, so
neither histograms nor rows reach the driver: it receives one candidate split per node and feature group.

Several fits (candidates, folds) share each pass, each at its own tree, so a search takes as many passes as its longest fit.
A table of at most PART_ROWS rows is one partition, so its histograms need no shuffle: each fit is then one task that goes through all its
passes, and the fits run beside each other. Of two siblings it counts only the one with fewer rows; the other is the parent's histogram less
that. Passes over several partitions count both, as keeping histograms from one job to the next costs more. Results are the same either way.
Blocks are RDD elements: growing a tree is imperative work on arrays per partition that no DataFrame operator expresses.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayput import presets
from stayput.session import scratch, ship

#: Bins of a feature: 0 holds nulls and NaN, the others values, so a feature has at most MAX_BINS - 2 inner bounds.
MAX_BINS = presets.MAX_BINS
#: Rows of a block, about; rows up to which a table is one partition; rows of a partition of a larger one; feature groups in which
#: histograms are summed.
BLOCK_ROWS, PART_ROWS, SPREAD_ROWS, GROUPS = 50_000, 200_000, 100_000, 8
#: Joint values of features that are counted together.
JOINT = 1024
#: Bytes of margins and gradients that a Python worker keeps from one pass to the next.
KEPT_BYTES = 64 << 20
#: Trees that a stored margin may lag behind; margins stored between two checkpoints.
LAG, STORED = 3, 5
#: Gradients are multiples of this, so their sums do not depend on the order of tasks.
GRAIN = 2.0 ** -24
#: A split must gain more than this beside ``gamma``.
LEAST_GAIN = 1e-6


@dataclass
class Setting:
    """Parameters of one fit, by their usual names; ``num_leaves`` (or ``max_leaves``) bounds the leaves and makes growth leaf-wise."""

    n_estimators: int = 100
    max_depth: int = 6                 # -1 or 0: bounded by the leaves alone
    max_leaves: int = 0                # 0: bounded by the depth alone
    leafwise: bool = False
    learning_rate: float = 0.3
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    min_child_samples: int = 1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    scale_pos_weight: float = 1.0

    @classmethod
    def of(cls, params: Mapping, ratio: float = 1.0) -> "Setting":
        """From booster-style parameters; a ``scale_pos_weight`` of None or none at all stands for ``ratio``. An unknown name is an error."""
        p = dict(params)
        p.pop("max_bin", None)
        leaves = p.pop("num_leaves", None)
        policy = p.pop("grow_policy", "lossguide" if leaves is not None else "depthwise")
        if leaves is not None:
            p["max_leaves"] = leaves
        weight = p.pop("scale_pos_weight", None)
        made = cls(**p, scale_pos_weight=float(weight or ratio), leafwise=policy == "lossguide")
        if made.max_depth < 1 and made.max_leaves < 1:
            raise ValueError("a tree needs a bound on its depth or its leaves")
        return made

    @property
    def depth(self) -> int:
        return self.max_depth if self.max_depth > 0 else self.max_leaves

    @property
    def leaves(self) -> float:
        return self.max_leaves if self.max_leaves > 0 else math.inf


@dataclass
class Job:
    """One fit: its setting, the values of the part column whose rows train it, and those whose rows stop it."""

    setting: Setting
    train: Sequence[int]
    valid: Sequence[int] = ()
    patience: int = presets.EARLY_STOPPING_ROUNDS


@dataclass
class Tree:
    """Node arrays: an inner node sends rows of bins up to ``bin`` of ``feature`` left, nulls by ``null_left``; ``feature`` is -1 on leaves."""

    feature: np.ndarray
    bin: np.ndarray
    null_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def reached(self, bins: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """The node that each column of ``bins`` (features, rows) ends in, from the root or the nodes ``start``."""
        n = bins.shape[1]
        at = np.zeros(n, np.int32) if start is None else start.copy()
        if start is None:
            under_way = [(0, None)]
        else:   # the rows at each node, in one sort
            order = np.argsort(at.astype(np.uint16) if len(self.feature) < 1 << 16 else at, kind="stable")
            cuts = np.searchsorted(at[order], np.arange(len(self.feature) + 1))
            under_way = [(node, order[i:j]) for node, (i, j) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if i < j]
        low = np.arange(256)
        while under_way:
            node, rows = under_way.pop()
            f = self.feature[node]
            if f < 0:
                at[slice(None) if rows is None else rows] = node
                continue
            goes_left = low <= self.bin[node]
            goes_left[0] = self.null_left[node]
            left = goes_left[bins[f] if rows is None else bins[f].take(rows)]
            for child, some in ((self.left[node], left), (self.right[node], ~left)):
                some = np.flatnonzero(some) if rows is None else rows[some]
                if len(some):
                    under_way.append((int(child), some))
        return at


@dataclass
class Boosted:
    """A fitted ensemble. ``losses`` is the validation loss after each number of rounds from 0 on; the trees end at the best round."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree]
    losses: list[float] = field(default_factory=list)
    rounds_built: int = 0
    stopped: bool = False

    @property
    def best_round(self) -> int:
        return len(self.trees)

    def rows(self) -> list[tuple]:
        """The ensemble in the form of ``score.TREE_SCHEMA``: tree 0 is the base margin, nulls fail a test, so the test is turned where they go left."""
        out = [(0, 0, None, None, None, None, None, float(self.base))]
        for t, tree in enumerate(self.trees, 1):
            for node, f in enumerate(tree.feature.tolist()):
                if f < 0:
                    out.append((t, node, None, None, None, None, None, float(tree.value[node])))
                    continue
                b, left, right = int(tree.bin[node]), int(tree.left[node]), int(tree.right[node])
                bound = repr(float(self.edges[f][b - 1])) if b <= len(self.edges[f]) else None
                if bound is None:  # values against nulls
                    out.append((t, node, self.features[f], "<=", "inf", left, right, None))
                elif tree.null_left[node]:
                    out.append((t, node, self.features[f], ">=", bound, right, left, None))
                else:
                    out.append((t, node, self.features[f], "<", bound, left, right, None))
        return out

    def importances(self) -> list[float]:
        """Total gain of each feature's splits, as shares that sum to 1 (all 0 without a split)."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return (total / total.sum() if total.sum() else total).tolist()


# -- bins and blocks -------------------------------------------------------------------

def _number(name: str):
    c = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(c), c)


def fit_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Inner bin bounds of each feature: approximate quantiles in one pass, all its values where these are few; none for a column of nulls.

    At most ``max_bins`` numbers per feature reach the driver.
    """
    probs = np.linspace(0, 1, max_bins - 1).tolist()
    found = df.select(*[_number(c).alias(str(i)) for i, c in enumerate(features)]) \
        .approxQuantile([str(i) for i in range(len(features))], probs, 1.0 / (8 * max_bins))
    return [np.unique([x for x in q if math.isfinite(x)])[1:] for q in found]


BLOCK = "n long, uid binary, y binary, w binary, part binary, bins binary"


def blocks(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], label: str = "label", part: str | None = None,
           weight: str | None = None, key: Sequence[str] = ()) -> DataFrame:
    """One row per block of rows: label, weight, part and bins as arrays, written to the shared folder. Rows without a label are left out.

    ``key`` names columns that identify a row for row sampling, so a sample does not depend on where rows lie; else its values do.
    """
    names = list(features)
    spark = df.sparkSession
    ship(spark)
    whole = F.xxhash64(*(key or names))
    cols = df.where(F.col(label).isNotNull()).select(
        whole.alias("_u"), F.col(label).cast("double").alias("_y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"),
        (F.col(part).cast("int") if part else F.lit(0)).alias("_p"), *[_number(c).alias(f"_{i}") for i, c in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            bins = np.empty((len(names), table.num_rows), np.uint8)
            for i, e in enumerate(edges):
                x = table.column(4 + i).to_numpy()
                bins[i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, "right"))
            parts = [np.ascontiguousarray(table.column(k).to_numpy(), t).tobytes() for k, t in enumerate((np.int64, np.float64, np.float64, np.int32))]
            return pa.RecordBatch.from_arrays([pa.array([table.num_rows], pa.int64()), *(pa.array([x], pa.binary()) for x in (*parts, bins.tobytes()))],
                                              ["n", "uid", "y", "w", "part", "bins"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    path = f"{scratch(spark, 'boost')}/blocks"
    cols.mapInArrow(run, BLOCK).write.parquet(path)
    return spark.read.schema(BLOCK).parquet(path)


@dataclass
class _Block:
    uid: np.ndarray
    y: np.ndarray
    w: np.ndarray
    part: np.ndarray
    bins: np.ndarray
    margin: np.ndarray        # (jobs, rows), behind by the pending trees


def _block(row, features: int, bases: np.ndarray) -> _Block:
    n = row.n
    return _Block(np.frombuffer(row.uid, np.int64), np.frombuffer(row.y, np.float64), np.frombuffer(row.w, np.float64),
                  np.frombuffer(row.part, np.int32), np.frombuffer(row.bins, np.uint8).reshape(features, n),
                  np.repeat(bases[:, None], n, axis=1))


def _sampled(uid: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Rows of a seeded sample of ``share``, by a hash of their id."""
    with np.errstate(over="ignore"):
        x = uid.view(np.uint64) + np.uint64(seed % (1 << 63)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < share


def gradients(y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted logistic loss, as multiples of GRAIN."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(w * (p - y) / GRAIN) * GRAIN, np.rint(w * p * (1.0 - p) / GRAIN) * GRAIN


def _bundles(sizes: Sequence[int], most: int) -> list[list[int]]:
    """Features that are counted together: neighbours whose numbers of bins multiply to ``most`` at most, or one feature."""
    out, cells = [], math.inf
    for f, size in enumerate(sizes):
        if cells * size > most:
            out.append([])
            cells = 1
        out[-1].append(f)
        cells *= size
    return out


def histogram(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, n_bins: int = MAX_BINS) -> np.ndarray:
    """(3, slots, features, bins): sums of g, h and rows, from bins (features, rows) and the slot of each row.

    Features of few bins are counted by their joint values, far fewer than there are rows; sums of multiples of GRAIN are the same in any order.
    """
    out = np.zeros((3, slots, len(bins), n_bins))
    sizes = (bins.max(axis=1).astype(np.int64) + 1).tolist() if bins.size else [1] * len(bins)
    first = slot.astype(np.int64)
    for some in _bundles(sizes, min(JOINT, len(slot) // (4 * max(slots, 1)))):
        shape = [sizes[f] for f in some]
        joint = bins[some[0]].astype(np.uint16)
        for f in some[1:]:
            joint *= np.uint16(sizes[f])
            joint += bins[f]
        cells = math.prod(shape)
        at = first * cells + joint
        for k, weight in enumerate((g, h, None)):
            sums = np.bincount(at, weight, slots * cells).reshape(slots, *shape)
            for i, f in enumerate(some):
                out[k, :, f, :sizes[f]] = sums.sum(axis=tuple(j + 1 for j in range(len(shape)) if j != i))
    return out


def leaf_value(g: float, h: float, s: Setting) -> float:
    """The weight that minimises the regularised loss: a soft threshold on the gradient, over the Hessian and L2."""
    down = h + s.reg_lambda
    return -np.sign(g) * max(abs(g) - s.reg_alpha, 0.0) / down if down > 0 else 0.0


def _worth(g, h, s: Setting):
    down = h + s.reg_lambda
    return np.divide(np.maximum(np.abs(g) - s.reg_alpha, 0.0) ** 2, down, out=np.zeros_like(down), where=down > 0)


def split_gains(hist: np.ndarray, s: Setting) -> tuple[np.ndarray, np.ndarray]:
    """(gain, left): of every cut of every feature, nulls right and nulls left. gain is (2, slots, features, bins - 1), -inf where a
    side would be too light or empty; left (2, 3, slots, features, bins - 1) the sums of the left side. Cut j sends bins 1 to j + 1 left;
    the last cut parts values from nulls."""
    nulls, values = hist[..., :1], np.cumsum(hist[..., 1:], axis=-1)
    total = values[..., -1:] + nulls
    left = np.stack([values, values + nulls])
    right = total[None] - left
    gain = _worth(left[:, 0], left[:, 1], s) + _worth(right[:, 0], right[:, 1], s) - _worth(total[0], total[1], s)[None]
    least = max(s.min_child_samples, 1)
    fits = (left[:, 1] >= s.min_child_weight) & (right[:, 1] >= s.min_child_weight) & (left[:, 2] >= least) & (right[:, 2] >= least)
    return np.where(fits, gain, -np.inf), left


def best_splits(hist: np.ndarray, names: np.ndarray, s: Setting) -> np.ndarray:
    """(slots, 9): gain, feature, bin, nulls left, sums of the left side (3), total g and h; features as in ``names``. First of equals."""
    gain, left = split_gains(hist, s)
    slots, f, cuts = gain.shape[1:]
    # order of equals: feature, cut, nulls right first
    flat = gain.transpose(1, 2, 3, 0).reshape(slots, -1)
    best = flat.argmax(axis=1)
    feature, rest = np.divmod(best, cuts * 2)
    cut, side = np.divmod(rest, 2)
    rows = np.arange(slots)
    total = hist[:, :, 0, :].sum(axis=-1)
    return np.column_stack([flat[rows, best], names[feature], cut + 1, side, *left[side, :, rows, feature, cut].T, total[0], total[1]])


# -- growing ---------------------------------------------------------------------------

class _Growing:
    """A tree under way on the driver: the best split of every counted node, and which of them are taken."""

    def __init__(self):
        self.split: dict[int, np.ndarray] = {}
        self.child: dict[int, tuple[int, int]] = {}
        self.depth, self.sums = [0], [None]

    def taken(self, s: Setting) -> tuple[list[int], list[int]]:
        """(inner nodes in the order they are split, those of them whose children are not counted yet).

        Nodes are taken best first (leaf-wise) or level by level, as long as there are leaves left. A node's best split depends on its own
        rows only, so all nodes that would be next are split in one pass; what better children displace is dropped at the end.
        """

        def entry(node):
            gain = self.split[node][0]
            return (0 if s.leafwise else self.depth[node], -gain, node)

        def good(node):
            return node in self.split and self.split[node][0] > max(s.gamma, LEAST_GAIN) and self.depth[node] < s.depth

        heap = [entry(0)] if good(0) else []
        inner, open_ = [], []
        while heap and len(inner) + 1 < s.leaves:
            node = heapq.heappop(heap)[-1]
            inner.append(node)
            if node not in self.child:
                open_.append(node)
                continue
            for c in self.child[node]:
                if good(c):
                    heapq.heappush(heap, entry(c))
        return inner, open_

    def expand(self, node: int, s: Setting) -> tuple[int, int] | None:
        """Give a node its children; (smaller, larger) if they can be split again."""
        row = self.split[node]
        left = row[4:7]
        total = np.array([row[7], row[8], self.sums[node][2]])
        ids = (len(self.depth), len(self.depth) + 1)
        for part in (left, total - left):
            self.depth.append(self.depth[node] + 1)
            self.sums.append(part)
        self.child[node] = ids
        if self.depth[node] + 1 >= s.depth:
            return None
        return ids if left[2] <= total[2] - left[2] else ids[::-1]

    def tree(self, inner: Sequence[int], s: Setting, renumber: bool) -> Tree:
        """The node arrays with ``inner`` as inner nodes; without ``renumber`` all nodes keep their numbers (rows on their way)."""
        chosen = set(inner)
        order = list(range(len(self.depth)))
        if renumber:
            order = [0]
            for node in order:
                if node in chosen:
                    order += self.child[node]
        at = {node: i for i, node in enumerate(order)}
        n = len(order)
        out = Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n, np.int32), np.zeros(n, np.int32),
                   np.zeros(n), np.zeros(n))
        for i, node in enumerate(order):
            if node in chosen:
                row = self.split[node]
                out.feature[i], out.bin[i], out.null_left[i], out.gain[i] = row[1], row[2], row[3] > 0, row[0]
                out.left[i], out.right[i] = (at[c] for c in self.child[node])
            elif self.sums[node] is not None:
                out.value[i] = s.learning_rate * leaf_value(self.sums[node][0], self.sums[node][1], s)
        return out


def _groups(features: np.ndarray, bins: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(features, the most bins of any of them): groups of features of about as many bins, so few bins of a histogram are empty."""
    order = features[np.lexsort((features, bins[features]))]
    return [(np.sort(g), int(bins[g].max())) for g in np.array_split(order, GROUPS) if len(g)]


def _bins(edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of each feature, that of nulls and the cut between nulls and values among them."""
    return np.array([len(e) + 2 for e in edges], np.int64)


class _Fit:
    """One job on the driver: its finished trees, the tree under way, its losses."""

    def __init__(self, at: int, job: Job, base: float, bins: np.ndarray, seed: int):
        self.at, self.job, self.base, self.seed, self.bins = at, job, base, seed, bins
        self.trees: list[Tree] = []
        self.stored = 0               # trees in the stored margins
        self.losses: list[float] = []
        self.done, self.stopped = False, False
        self.begin()

    def begin(self) -> None:
        s = self.job.setting
        self.growing, self.pairs, self.root = _Growing(), [], True
        rng = np.random.default_rng([self.seed, len(self.trees)])
        n = len(self.bins)
        some = rng.permutation(n)[:max(1, math.ceil(n * s.colsample_bytree - 1e-9))] if s.colsample_bytree < 1 else np.arange(n)
        self.groups = _groups(some, self.bins)

    def wanted(self, both: bool) -> dict:
        """What the next pass does for this job: slots to count (``both`` or the smaller of siblings), and whether to sum the validation loss."""
        s = self.job.setting
        last = len(self.trees) >= s.n_estimators
        tree = self.growing.tree(list(self.growing.child), s, renumber=False)
        slot = np.full(len(tree.feature), -1, np.int32)
        nodes = [] if last else [0] if self.root else [n for a, b, _ in self.pairs for n in ((a, b) if both else (a,))]
        slot[nodes] = np.arange(len(nodes))
        return {"at": self.at, "setting": s, "train": np.array(self.job.train, np.int32), "valid": np.array(self.job.valid, np.int32),
                "seed": self.seed * 1_000_003 + len(self.trees), "tree": tree, "slot": slot, "slots": len(nodes), "nodes": nodes, "groups": self.groups,
                "pending": self.trees[self.stored:], "stored": self.stored, "loss": self.root and len(self.job.valid) > 0, "root": self.root,
                "pairs": list(self.pairs)}

    def judge(self, loss: np.ndarray | None) -> None:
        """After a pass that summed the validation loss: go on, or stop and cut back to the best round."""
        s = self.job.setting
        if loss is not None:
            self.losses.append(float(loss[0] / loss[1]) if loss[1] else math.inf)
            best = int(np.argmin(self.losses))
            flat = len(self.losses) - 1 - best >= self.job.patience
            if flat or len(self.trees) >= s.n_estimators:
                self.done, self.stopped = True, flat and len(self.trees) < s.n_estimators
        elif len(self.trees) >= s.n_estimators:
            self.done = True

    def learn(self, found: dict[int, np.ndarray]) -> None:
        """Best splits of newly counted nodes; the tree grows as far as they reach, or ends and the next begins."""
        s, tree = self.job.setting, self.growing
        if self.root:
            row = found.get(0)
            if row is None:  # no rows
                self.done = True
                return
            tree.sums[0] = np.array([row[7], row[8], row[9]])
        tree.split.update({node: row[:9] for node, row in found.items()})
        self.root, self.pairs = False, []
        while True:
            inner, open_ = tree.taken(s)
            if not open_:
                break
            for node in open_:
                pair = tree.expand(node, s)
                if pair:
                    self.pairs.append((*pair, node))
            if self.pairs:
                return
        self.trees.append(tree.tree(inner, s, renumber=True))
        self.begin()
        self.done = len(self.trees) >= s.n_estimators and not self.job.valid


class _Way:
    """How far a task is with one job's rows of one block: the margin after ``trees`` trees and, of the tree under way, the rows that train it,
    their bins and gradients, and the node that each has come to in a tree of ``nodes`` nodes."""

    def __init__(self, trees: int, margin: np.ndarray):
        self.trees, self.margin, self.rows = trees, margin, None

    def bytes(self) -> int:
        return self.margin.nbytes + (0 if self.rows is None else sum(x.nbytes for x in (self.rows, self.bins, self.g, self.h, self.at)))


#: (run, job, partition, block) -> way: what this worker process has from earlier passes, the one used last at the end. A pass that finds
#: nothing starts from the stored margins, with the same outcome.
_WAYS: OrderedDict = OrderedDict()


def _kept_ways(run: str, part: int) -> dict:
    """The ways of a partition that this worker still has; those of other runs go."""
    for key in [k for k in _WAYS if k[0] != run]:
        del _WAYS[key]
    return {(j, i): w for (_, j, p, i), w in _WAYS.items() if p == part}


def _keep_ways(run: str, part: int, ways: dict) -> None:
    for (j, i), way in ways.items():
        _WAYS.pop((run, j, part, i), None)
        _WAYS[run, j, part, i] = way
    held = sum(w.bytes() for w in _WAYS.values())
    while held > KEPT_BYTES:
        held -= _WAYS.popitem(last=False)[1].bytes()


def _count(rows: list[_Block], plans: list[dict], ways: dict, most: float = math.inf) -> dict:
    """((job, group), histograms) and ((job, -1), loss sums) of one partition, summed over its blocks. ``ways`` holds how far earlier passes
    came, by (job, block), and is brought up to date; of those, some ``most`` bytes stay."""
    out: dict[tuple, np.ndarray] = {}
    kept = 0

    def add(key, value):
        out[key] = out[key] + value if key in out else value

    for i, b in enumerate(rows):
        for p in plans:
            s, j, tree = p["setting"], p["at"], p["tree"]
            way = ways.get((j, i))
            if way is None or not p["stored"] <= way.trees <= p["stored"] + len(p["pending"]):   # none yet, or of another pass
                way = ways[j, i] = _Way(p["stored"], b.margin[j].copy())
            for done in p["pending"][way.trees - p["stored"]:]:
                way.margin += done.value[done.reached(b.bins)]
                way.trees, way.rows = way.trees + 1, None
            if p["loss"]:
                held = np.isin(b.part, p["valid"])
                m, y = way.margin[held], b.y[held]
                # the loss of a row is at most some ten; whole multiples of GRAIN add up in any order
                add((j, -1), np.array([(np.rint((np.logaddexp(0, m) - y * m) / GRAIN) * GRAIN).sum(), float(held.sum())]))
            if not p["slots"]:
                continue
            if way.rows is None:
                use = np.isin(b.part, p["train"])
                if s.subsample < 1:
                    use &= _sampled(b.uid, s.subsample, p["seed"])
                way.rows = rows_ = np.flatnonzero(use)
                way.bins = b.bins[:, rows_]
                way.g, way.h = gradients(b.y[rows_], b.w[rows_] * np.where(b.y[rows_] > 0, s.scale_pos_weight, 1.0), way.margin[rows_])
                way.at, way.nodes = np.zeros(len(rows_), np.int32), 1
            way.at = tree.reached(way.bins, way.at if way.nodes <= len(tree.feature) else None)
            way.nodes = len(tree.feature)
            slot = p["slot"][way.at]
            met = np.flatnonzero(slot >= 0)
            slot, g, h = slot[met], way.g[met], way.h[met]
            for k, (group, n_bins) in enumerate(p["groups"]):
                some = way.bins[group]
                add((j, k), histogram(some if len(met) == len(way.at) else some.take(met, axis=1), slot, g, h, p["slots"], n_bins))
            kept += way.bytes()
            if kept > most:
                del ways[j, i]
    return out


def _searched(sums: dict, before: dict | None, plans: dict[int, dict]) -> tuple[list, dict]:
    """Best splits of all wanted nodes and the histograms to go on with. With ``before``, those of the last pass, the histograms of the larger
    siblings are found by subtraction."""
    found, kept = [], {}
    for (j, k), hist in sums.items():
        if k < 0:
            found.append((j, -1, hist))
            continue
        p = plans[j]
        old = {}
        if p["root"] or before is None:
            nodes, whole = p["nodes"], hist
        else:
            old = before[j, k]
            nodes, parts = [], []
            for at, (small, large, parent) in enumerate(p["pairs"]):
                nodes += [small, large]
                parts += [hist[:, at], old[parent] - hist[:, at]]
                whole = np.stack(parts, axis=1)
        rows = best_splits(whole, p["groups"][k][0], p["setting"])
        count = whole[2, :, 0, :].sum(axis=-1)
        found.append((j, nodes, np.column_stack([rows, count])))
        gone = {parent for _, _, parent in p["pairs"]}
        kept[j, k] = {n: h for n, h in old.items() if n not in gone} | {n: whole[:, i] for i, n in enumerate(nodes)}
    return found, kept


def fit_many(blocks_df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], jobs: Sequence[Job], seed: int = presets.SEED) -> list[Boosted]:
    """Fit all jobs side by side on the blocks; results do not depend on which jobs share the passes, nor on partitions.

    Rows that neither train nor stop a job do not touch it. A job without rows, or with one class, gets the base margin alone or trees of
    one leaf. Margins of all jobs are kept with the blocks (8 bytes a row and job), stored every LAG rounds and checkpointed in the shared folder.
    """
    n_features = len(features)
    names = list(features)
    n_rows = blocks_df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = 1 if n_rows <= PART_ROWS else n_rows // SPREAD_ROWS + 1
    ship(blocks_df.sparkSession)
    rows = blocks_df.coalesce(parts).rdd
    parts = rows.getNumPartitions()
    shares = dict(rows.flatMap(lambda r: _class_sums(r)).reduceByKey(np.add).collect())  # two numbers for each part
    fits = []
    for at, job in enumerate(jobs):
        pos, neg = sum((shares[p] for p in job.train if p in shares), np.zeros(2))
        pos = pos * job.setting.scale_pos_weight
        p = min(max(pos / (pos + neg), 1e-6), 1 - 1e-6) if pos + neg else 0.5
        fits.append(_Fit(at, job, math.log(p / (1 - p)), _bins(edges), seed))
    if parts == 1:
        fits = _alone(rows, fits, n_features)
    else:
        _together(rows, fits, n_features, parts)
    out = []
    for f in fits:
        kept = f.trees[:int(np.argmin(f.losses))] if f.losses else f.trees
        out.append(Boosted(names, list(edges), f.base, kept, f.losses, len(f.trees), f.stopped))
    return out


def _met(found: list, fits: Mapping[int, _Fit], plans: list[dict]) -> None:
    """Tell the fits of a pass what it found, the outcome of all feature groups."""
    best: dict[int, dict] = {}
    losses: dict[int, np.ndarray] = {}
    for j, nodes, table in found:
        if isinstance(nodes, int):
            losses[j] = table
            continue
        of = best.setdefault(j, {})
        for node, row in zip(nodes, table):
            if node not in of or (row[0], -row[1]) > (of[node][0], -of[node][1]):
                of[node] = row
    for p in plans:
        f = fits[p["at"]]
        if p["root"]:
            f.judge(losses.get(f.at) if p["loss"] else None)
        if not f.done:
            f.learn(best.get(f.at, {}))


def _alone(rows: RDD, fits: list[_Fit], n_features: int) -> list[_Fit]:
    """Each fit as one task over the one partition of ``rows``, all passes in it; the finished fits come back."""

    def grown(fit: _Fit):
        def run(blocks_: Iterator) -> Iterator[_Fit]:
            held = [_block(r, n_features, np.zeros(0)) for r in blocks_]
            for b in held:
                b.margin = {fit.at: np.full(len(b.y), fit.base)}
            ways, before = {}, None
            while not fit.done:
                plan = fit.wanted(both=False)
                found, before = _searched(_count(held, [plan], ways), before, {fit.at: plan})
                _met(found, {fit.at: fit}, [plan])
                if not fit.root:     # finished trees are in the margins of the ways: none is pending any more
                    fit.stored = len(fit.trees)
            fit.growing = fit.groups = None
            yield fit
        return run

    if not fits:
        return fits
    done = {f.at: f for f in rows.context.union([rows.mapPartitions(grown(f)) for f in fits]).collect()}
    return [done.get(f.at, f) for f in fits]      # a table without a partition has no task


def _together(rows: RDD, fits: list[_Fit], n_features: int, parts: int) -> None:
    """All fits in passes over all partitions of ``rows``, at the same tree each."""
    run = uuid.uuid4().hex
    bases = np.array([f.base for f in fits])
    state = rows.mapPartitionsWithIndex(lambda at, it: [(at, [_block(r, n_features, bases) for r in it])]) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    reducers = min(parts, GROUPS * len(fits), rows.context.defaultParallelism)      # one wave of tasks
    stored = 0
    while True:
        # fits wait for each other between trees, so that all finished trees can be stored
        under_way = [f for f in fits if not f.done and not f.root]
        plans = [f.wanted(both=True) for f in under_way or fits if not f.done]
        if not plans:
            break
        _met(_pass(run, state, plans, reducers), dict(enumerate(fits)), plans)
        if any(len(f.trees) - f.stored >= LAG for f in fits if not f.done) and all(f.done or f.root for f in fits):
            stored += 1
            state = _stored(state, fits, stored)
    state.unpersist()


def _class_sums(row) -> list:
    part, y, w = np.frombuffer(row.part, np.int32), np.frombuffer(row.y, np.float64), np.frombuffer(row.w, np.float64)
    return [(int(p), np.array([w[(part == p) & (y > 0)].sum(), w[(part == p) & (y <= 0)].sum()])) for p in np.unique(part)]


def _pass(run: str, state: RDD, plans: list[dict], reducers: int) -> list:
    """What one pass finds: the best splits of each feature group, and the losses."""
    by_job = {p["at"]: {k: v for k, v in p.items() if k not in ("tree", "slot", "pending")} for p in plans}

    def counted(part: int, held: list[_Block]):
        ways = _kept_ways(run, part)
        out = _count(held, plans, ways, KEPT_BYTES)
        _keep_ways(run, part, ways)
        return out.items()

    sums = state.flatMap(lambda e: counted(*e)).reduceByKey(np.add, reducers)
    return sums.mapPartitions(lambda it: _searched(dict(it), None, by_job)[0]).collect()


def _stored(state: RDD, fits: list[_Fit], times: int) -> RDD:
    """The blocks with all finished trees in their margins; a reliable checkpoint every STORED times keeps the lineage short."""
    new = [(f.at, f.trees[f.stored:]) for f in fits]

    def brought(entry: tuple) -> tuple:
        for b in entry[1]:
            for j, trees in new:
                for tree in trees:
                    b.margin[j] += tree.value[tree.reached(b.bins)]
        return entry

    after = state.map(brought).persist(StorageLevel.MEMORY_AND_DISK)
    if times % STORED == 0:
        after.checkpoint()
    after.count()
    state.unpersist()
    for f in fits:
        f.stored = len(f.trees)
    return after


def fit(df: DataFrame, features: Sequence[str], params: Mapping, label: str = "label", part: str | None = None, train: Sequence[int] = (0,),
        valid: Sequence[int] = (), patience: int = presets.EARLY_STOPPING_ROUNDS, weight: str | None = None, ratio: float = 1.0,
        key: Sequence[str] = (), edges: Sequence[np.ndarray] | None = None, seed: int = presets.SEED) -> Boosted:
    """One boosted ensemble on the numeric columns ``features`` (nulls allowed) of the rows whose ``part`` is in ``train``.

    With ``valid`` the log loss of those rows is summed after every round; training ends after ``patience`` rounds without a new best
    and the model is cut back to the best round. Bin bounds come from the training rows unless given.
    """
    trn = df.where(F.col(part).isin(list(train))) if part else df
    edges = fit_edges(trn, features) if edges is None else list(edges)
    held = blocks(df, features, edges, label, part, weight, key)
    return fit_many(held, features, edges, [Job(Setting.of(params, ratio), train, valid, patience)], seed)[0]


def root_gains(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], s: Setting, label: str = "label",
               weight: str | None = None) -> DataFrame:
    """(feature, threshold, nulls_left, gain, n_left, n_right): every allowed split of all rows, before the first tree.

    Values below the threshold go left; a null threshold parts values (left) from nulls. The table has at most two rows per bin.
    """
    held = blocks(df, features, edges, label, weight=weight)
    rows = held.rdd
    shares = dict(rows.flatMap(_class_sums).reduceByKey(np.add).collect()).get(0, np.zeros(2))
    pos, neg = shares[0] * s.scale_pos_weight, shares[1]
    base = math.log(pos / neg) if pos and neg else 0.0
    groups = _groups(np.arange(len(features)), _bins(edges))
    plan = {"at": 0, "setting": s, "train": np.array([0]), "slots": 1, "slot": np.zeros(1, np.int32), "seed": 0, "pending": [], "stored": 0, "loss": False,
            "tree": Tree(np.array([-1]), *(np.zeros(1, t) for t in (int, bool, int, int, float, float))), "groups": groups}

    def gains(entry):
        (_, k), hist = entry
        gain, left = split_gains(hist, s)
        total = int(hist[2, 0, 0].sum())
        for i, f in enumerate(groups[k][0]):
            for cut in range(len(edges[f]) + 1):
                at = cut if cut < len(edges[f]) else gain.shape[-1] - 1
                for side in (0, 1):
                    g = gain[side, 0, i, at]
                    if g > -np.inf and (cut < len(edges[f]) or side == 0):
                        n = int(left[side, 2, 0, i, at])
                        yield features[f], float(edges[f][cut]) if cut < len(edges[f]) else None, bool(side), float(g), n, total - n

    counted = rows.flatMap(lambda r: _count([_block(r, len(features), np.array([base]))], [plan], {}).items()).reduceByKey(np.add).flatMap(gains)
    return df.sparkSession.createDataFrame(counted, "feature string, threshold double, nulls_left boolean, gain double, n_left long, n_right long")


def held_out(blocks_df: DataFrame, models: Sequence[Boosted], jobs: Sequence[tuple]) -> DataFrame:
    """(candidate, fold, label, score): the probability that each model gives the rows of its held-out part, as one long table.

    ``jobs`` holds (candidate, fold) of each model; the fold is the value of the part column that the model did not see.
    """
    n_features = len(models[0].features)
    ship(blocks_df.sparkSession)
    shared = blocks_df.sparkSession.sparkContext.broadcast([(m.base, m.trees) for m in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = np.frombuffer(row["part"], np.int32)
                y = np.frombuffer(row["y"], np.float64)
                bins = np.frombuffer(row["bins"], np.uint8).reshape(n_features, row["n"])
                for (candidate, fold), (base, trees) in zip(jobs, shared.value):
                    held = part == fold
                    margin = np.full(int(held.sum()), base)
                    some = bins[:, held]
                    for tree in trees:
                        margin += tree.value[tree.reached(some)]
                    n = len(margin)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, candidate, np.int32)), pa.array(np.full(n, fold, np.int32)),
                                                      pa.array(y[held].astype(np.int32)), pa.array(1.0 / (1.0 + np.exp(-margin)))],
                                                     ["candidate", "fold", "label", "score"])

    return blocks_df.mapInArrow(run, "candidate int, fold int, label int, score double")


def model_table(spark: SparkSession, model: Boosted) -> DataFrame:
    """The fitted ensemble as a tree table (``score.TREE_SCHEMA``): what it predicts is the sum of the reached leaves."""
    from stayput.operators.score import as_table

    return as_table(spark, model.rows())
