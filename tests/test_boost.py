"""The boosted-tree learner against plain NumPy, its growth policies, patience, nulls, saved trees, partitions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayput import catalog
from stayput.operators import boost, score, train
from stayput.operators.evaluate import ranking_metrics
from stayput.operators.encode import assemble
from tests.conftest import SF01

NAMES = ["a", "b", "c"]


def table(spark, n=400, seed=1, parts=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 12, n), rng.normal(size=n).round(2), rng.integers(0, 3, n)
    logit = 0.4 * a - 2 + np.where(b > 0, b, 0) - (c == 1) * a * 0.3 + rng.normal(size=n)
    rows = [(i, float(a[i]) if i % 9 else None, float(b[i]) if i % 7 else float("nan"), int(c[i]), int(logit[i] > 0), i % 5) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c int, label int, part int").repartition(parts, "id")


def plain_gains(rows, edges, s):
    """(feature, threshold or None, nulls left) -> gain of the root, row by row."""
    pos = sum(r.label for r in rows) / len(rows)
    g = [(pos - r.label) for r in rows]
    h = pos * (1 - pos)

    def worth(idx):
        total = sum(g[i] for i in idx)
        return max(abs(total) - s.reg_alpha, 0) ** 2 / (len(idx) * h + s.reg_lambda)

    out = {}
    for name, edge in zip(NAMES, edges):
        x = [None if r[name] is None or math.isnan(r[name]) else r[name] for r in rows]
        for t in [*edge, None]:
            for nulls_left in (False, True) if t is not None else (False,):
                left = [i for i, v in enumerate(x) if (nulls_left if v is None else t is None or v < t)]
                right = [i for i in range(len(x)) if i not in set(left)]
                if min(len(left), len(right)) >= max(s.min_child_samples, 1) and min(len(left), len(right)) * h >= s.min_child_weight:
                    out[name, t, nulls_left] = worth(left) + worth(right) - worth(range(len(x)))
    return out


@pytest.mark.parametrize("params", [{}, {"reg_alpha": 2.0, "reg_lambda": 3.0, "min_child_weight": 4}, {"min_child_samples": 60, "reg_lambda": 0.0}])
def test_root_gains_equal_a_plain_walk(spark, params):
    df = table(spark, 200)
    s = boost.Setting.of(params | {"max_depth": 3})
    edges = boost.fit_edges(df, NAMES)
    got = {(r.feature, r.threshold, r.nulls_left): r.gain for r in boost.root_gains(df, NAMES, edges, s).collect()}
    want = plain_gains(df.collect(), edges, s)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-4 for k in want)


def by_walk(rows, model):
    """Margins by walking the tree table row by row in plain Python."""
    nodes = {(r[0], r[1]): r for r in model.rows()}
    out = []
    for row in rows:
        total = 0.0
        for t in sorted({k[0] for k in nodes}):
            n = nodes[t, 0]
            while n[2] is not None:
                v = row[n[2]]
                v = None if v is None or math.isnan(v) else v
                test = v is not None and {"<": v < float(n[4]), ">=": v >= float(n[4]), "<=": v <= float(n[4])}[n[3]]
                n = nodes[t, n[5] if test else n[6]]
            total += n[7]
        out.append(total)
    return out


def test_saved_trees_predict_as_the_bins_do_and_nulls_have_a_side(spark):
    df = table(spark, 300)
    model = boost.fit(df, NAMES, {"n_estimators": 25, "max_depth": 4, "learning_rate": 0.2}, key=["id"])
    rows = df.orderBy("id").collect()
    scored = [r.raw_score for r in score.ensemble_score(df, boost.model_table(spark, model)).orderBy("id").collect()]
    assert np.allclose(scored, by_walk(rows, model), atol=1e-9)
    held = boost.blocks(df, NAMES, model.edges, key=["id"])
    again = {r.score for r in boost.held_out(held, [model], [(0, 0)]).collect()}
    assert np.allclose(sorted(again), sorted({1 / (1 + math.exp(-x)) for x in scored}), atol=1e-9)
    ops = {r[3] for r in model.rows()}
    assert "<" in ops and (">=" in ops or "<=" in ops)      # some nulls go left, or apart


def test_result_does_not_depend_on_partitions_or_company(spark, monkeypatch):
    params = {"n_estimators": 8, "max_depth": 4, "learning_rate": 0.3, "subsample": 0.7, "colsample_bytree": 0.7}
    df = table(spark, 500)
    edges = boost.fit_edges(df, NAMES)
    one = boost.fit(df, NAMES, params, key=["id"], edges=edges)
    monkeypatch.setattr(boost, "PART_ROWS", 60)
    monkeypatch.setattr(boost, "LAG", 3)
    monkeypatch.setattr(boost, "STORED", 2)
    held = boost.blocks(table(spark, 500, parts=7), NAMES, edges, key=["id"], part=None)
    jobs = [boost.Job(boost.Setting.of(params), [0]), boost.Job(boost.Setting.of({"n_estimators": 3, "num_leaves": 6, "max_depth": -1}), [0])]
    many = boost.fit_many(held, NAMES, edges, jobs)
    assert many[0].rows() == one.rows() and len(many[1].trees) == 3


def jobs_of(spark, name, run):
    """What ``run`` returns, and the number of Spark jobs that it took."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_of_a_small_table_do_not_grow_with_rounds(spark):
    df = table(spark, 400)
    edges = boost.fit_edges(df, NAMES)
    held = boost.blocks(df, NAMES, edges, key=["id"], part="part")
    counts = []
    for n in (2, 30):
        job = boost.Job(boost.Setting.of({"n_estimators": n, "max_depth": 4}), [0, 1, 2], [3], 50)
        models, jobs = jobs_of(spark, f"rounds-{n}", lambda: boost.fit_many(held, NAMES, edges, [job, job]))
        assert [m.rounds_built for m in models] == [n, n] and models[0].rows() == models[1].rows()
        counts.append(jobs)
    assert counts[0] == counts[1] < 10


@pytest.mark.parametrize("kept", [0, 1 << 26])
def test_passes_agree_with_or_without_what_a_worker_keeps(spark, monkeypatch, kept):
    """Patience, samples and several jobs over many partitions: as one task finds them."""
    df = table(spark, 600, parts=6)
    edges = boost.fit_edges(df, NAMES)
    held = boost.blocks(df, NAMES, edges, key=["id"], part="part")
    jobs = [boost.Job(boost.Setting.of({"n_estimators": 9, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.7}), [0, 1, 2], [3], 3),
            boost.Job(boost.Setting.of({"n_estimators": 5, "num_leaves": 5, "max_depth": -1}), [1, 2])]
    alone = boost.fit_many(held, NAMES, edges, jobs)
    monkeypatch.setattr(boost, "PART_ROWS", 0)
    monkeypatch.setattr(boost, "SPREAD_ROWS", 150)
    monkeypatch.setattr(boost, "KEPT_BYTES", kept)
    monkeypatch.setattr(boost, "LAG", 2)
    spread = boost.fit_many(held, NAMES, edges, jobs)
    assert [(m.rows(), m.losses, m.rounds_built, m.stopped) for m in spread] == [(m.rows(), m.losses, m.rounds_built, m.stopped) for m in alone]


def plain_best_first(gain_of, leaves):
    """Leaves by always splitting the leaf of the largest gain."""
    import heapq
    heap, count, inner = [(-gain_of[0][0], 0)], 1, []
    while heap and count < leaves:
        g, n = heapq.heappop(heap)
        if -g <= boost.LEAST_GAIN:
            break
        inner.append(n)
        count += 1
        for c in gain_of[n][1]:
            if c in gain_of:
                heapq.heappush(heap, (-gain_of[c][0], c))
    return inner


def test_leafwise_tree_has_31_leaves_and_is_deep(spark):
    df = catalog._records(spark, SF01).select("customerID", F.col("tenure").alias("a"), F.col("MonthlyCharges").alias("b"), F.col("TotalCharges").alias("c"),
                                              (F.col("Departed") == "Yes").cast("int").alias("label"))
    params = {"n_estimators": 1, "num_leaves": 31, "max_depth": -1, "reg_lambda": 0.0, "min_child_weight": 1e-3, "min_child_samples": 5}
    tree = boost.fit(df, NAMES, params, key=["customerID"]).trees[0]

    def depth(n):
        return 0 if tree.feature[n] < 0 else 1 + max(depth(tree.left[n]), depth(tree.right[n]))

    assert (tree.feature < 0).sum() == 31 and depth(0) > 5
    # the same splits as growing without a bound and then taking the best first
    whole = boost.fit(df, NAMES, params | {"num_leaves": 100_000, "max_depth": 40}, key=["customerID"]).trees[0]
    gains = {n: (whole.gain[n], (whole.left[n], whole.right[n])) for n in range(len(whole.feature)) if whole.feature[n] >= 0}
    assert sorted(np.round([whole.gain[n] for n in plain_best_first(gains, 31)], 9)) == sorted(np.round(tree.gain[tree.feature >= 0], 9))


def test_patience_stops_51_rounds_after_the_best(spark):
    df = table(spark, 300, seed=5)
    fast = {"n_estimators": 400, "max_depth": 4, "learning_rate": 0.8, "reg_lambda": 0.1}
    model = boost.fit(df, NAMES, fast, part="part", train=(0, 1, 2), valid=(3,), patience=50, key=["id"])
    best = int(np.argmin(model.losses))
    assert model.stopped and model.rounds_built == best + 50 and model.best_round == best == len(model.trees)
    info = train.early_stop_info(spark, model, 400).first()
    assert (info.best_round, info.rounds_built, info.max_iter, info.stopped_early) == (best, best + 50, 400, True)
    assert abs(info.best_loss - min(model.losses)) < 1e-12
    # the loss of the kept rounds is that of the validation rows
    val = score.score_ensemble(df.where("part = 3"), model.rows()).collect()
    loss = -sum(math.log(r.probability if r.label else 1 - r.probability) for r in val) / len(val)
    assert abs(loss - min(model.losses)) < 1e-6


def test_edges_of_the_learner(spark):
    df = table(spark, 60)
    empty = boost.fit(df.limit(0), NAMES, {"n_estimators": 3, "max_depth": 2})
    assert empty.base == 0.0 and empty.trees == []
    one = boost.fit(df.withColumn("label", F.lit(1)), NAMES, {"n_estimators": 2, "max_depth": 2})
    assert all((t.feature < 0).all() for t in one.trees) and one.base > 10
    nothing = df.withColumn("a", F.lit(None).cast("double"))
    model = boost.fit(nothing, ["a"], {"n_estimators": 2, "max_depth": 2})
    assert score.score_ensemble(nothing, model.rows()).select("probability").distinct().count() == 1 and model.importances() == [0.0]
    with pytest.raises(TypeError):
        boost.Setting.of({"no_such_parameter": 1})
    with pytest.raises(ValueError):
        boost.Setting.of({"max_depth": -1})


def test_auc_is_not_below_mllib(spark):
    s = catalog._records(spark, SF01).select("customerID", "tenure", F.coalesce("MonthlyCharges", F.lit(65.0)).alias("m"), (F.col("Contract") == "Month-to-month").cast("int").alias("x"),
                                             (F.col("InternetService") == "Fiber optic").cast("int").alias("f"), (F.col("PaymentMethod") == "Electronic check").cast("int").alias("e"),
                                             (F.col("Departed") == "Yes").cast("int").alias("label"), (F.abs(F.xxhash64("customerID")) % 5).cast("int").alias("part")).persist()
    names, params = ["tenure", "m", "x", "f", "e"], {"n_estimators": 20, "max_depth": 3, "learning_rate": 0.2}
    ours = boost.fit(s, names, params, part="part", train=(0, 1, 2), key=["customerID"])
    held = score.score_model(s.where("part > 2"), ours)
    mllib = train.train_mllib(assemble(s.where("part <= 2"), names, "features"), params)
    theirs = score.score_model(assemble(s.where("part > 2"), names, "features"), mllib)
    a, b = (ranking_metrics(x, "label", "probability").first()["roc_auc"] for x in (held, theirs))
    assert a >= b - 0.005, (a, b)


def test_reached_equals_a_walk_and_goes_on_from_nodes():
    rng = np.random.default_rng(2)
    tree = boost.Tree(np.array([1, 0, -1, 2, -1, -1, -1], np.int32), np.array([100, 30, 0, 200, 0, 0, 0], np.int32),
                      np.array([True, False, False, True, False, False, False]), np.array([1, 3, 0, 5, 0, 0, 0], np.int32),
                      np.array([2, 4, 0, 6, 0, 0, 0], np.int32), np.zeros(7), np.zeros(7))
    bins = rng.integers(0, 256, (3, 500)).astype(np.uint8)
    bins[:, :40] = 0

    def walk(column, node):
        while tree.feature[node] >= 0:
            b = column[tree.feature[node]]
            node = tree.left[node] if (tree.null_left[node] if b == 0 else b <= tree.bin[node]) else tree.right[node]
        return node

    assert tree.reached(bins).tolist() == [walk(c, 0) for c in bins.T]
    start = rng.integers(0, 7, 500).astype(np.int32)
    assert tree.reached(bins, start).tolist() == [walk(c, s) for c, s in zip(bins.T, start)]
    assert tree.reached(bins[:, :0]).tolist() == []


def test_passes_over_several_partitions_walk_few_finished_trees(spark, monkeypatch):
    """A pass that finds nothing kept walks the trees that the stored margins lag behind: 3 at most, not up to 10."""
    monkeypatch.setattr(boost, "PART_ROWS", 0)
    monkeypatch.setattr(boost, "SPREAD_ROWS", 150)
    pending, pass_ = [], boost._pass

    def watched(run, state, plans, reducers):
        pending.extend(len(p["pending"]) for p in plans)
        return pass_(run, state, plans, reducers)

    monkeypatch.setattr(boost, "_pass", watched)
    model = boost.fit(table(spark, 300, parts=2), NAMES, {"n_estimators": 8, "max_depth": 1})
    assert len(model.trees) == 8 and max(pending) <= 3


def test_features_of_few_bins_are_counted_together(monkeypatch):
    """The sums are those of counting each feature alone, in fewer counts."""
    rng = np.random.default_rng(6)
    n, sizes, slots = 20_000, [3, 3, 3, 4, 4, 10, 74, 250], 5
    bins = np.stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    slot = rng.integers(0, slots, n).astype(np.int32)
    g, h = boost.gradients(rng.integers(0, 2, n).astype(float), np.ones(n), rng.normal(size=n))
    counts, plain = [], np.bincount
    monkeypatch.setattr(boost.np, "bincount", lambda *a: counts.append(1) or plain(*a))
    got = boost.histogram(bins, slot, g, h, slots, 256)
    for f, b in enumerate(bins):
        for k, w in enumerate((g, h, None)):
            assert (got[k, :, f] == plain(slot * 256 + b.astype(np.int64), w, slots * 256).reshape(slots, 256)).all()
    assert len(counts) <= 3 * 4
    assert boost.histogram(bins[:, :0], slot[:0], g[:0], h[:0], 2, 256).tolist() == np.zeros((3, 2, len(bins), 256)).tolist()
    few = boost.histogram(bins[:, :7], slot[:7], g[:7], h[:7], slots, 256)
    assert few[2].sum() == 7 * len(bins)
