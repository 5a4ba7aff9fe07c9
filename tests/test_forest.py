"""Forests without a limit of depth: against brute force, and the same by every way."""

import tracemalloc

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import forest, learning as M

NAMES = ["a", "b", "c"]


def rows_of(spark, n, seed=0, classify=False):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.integers(0, 9, n), draw.integers(0, 25, n), draw.normal(size=n).round(3)]).astype(float)
    y = 3 * (x[:, 0] > 4) * x[:, 1] + x[:, 2] + draw.normal(size=n)
    y = (y > np.median(y)).astype(float) if classify else y
    cells = np.column_stack([x, y]).tolist()
    return spark.createDataFrame([(i, *r) for i, r in enumerate(cells)], "id long, a double, b double, c double, y double")


def fitted(df, **settings):
    values = dict(trees=1, depth=40, bins=32, bootstrap=False, seed=3) | settings
    return M.fit(df, M.Model(lambda f: forest.Forest(**values, **M._columns())), NAMES, "y")


def brute(x, y, cuts, depth):
    """The tree that splits at the best cut, as a function of a row; gains by feature."""
    gains = np.zeros(x.shape[1])

    def below(at, depth):
        best, own = (1e-9, None, None), y[at]
        for f, values in enumerate(cuts):
            for c in values if depth else ():
                left = own[x[at, f] <= c]
                if 0 < len(left) < len(own):
                    right = own[x[at, f] > c]
                    gain = len(own) * own.var() - len(left) * left.var() - len(right) * right.var()
                    if gain > best[0] + 1e-9:
                        best = (gain, f, c)
        gain, f, c = best
        if f is None:
            return own.mean(), None
        gains[f] += gain
        side = x[at, f] <= c
        return f, c, below(at[side], depth - 1), below(at[~side], depth - 1)

    root = below(np.arange(len(y)), depth)

    def value(row):
        node = root
        while len(node) == 4:
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node[0]

    return value, gains / gains.sum()


@pytest.mark.parametrize("depth", [1, 3, 40])
@pytest.mark.parametrize("task_rows", [30, 10**6])
def test_tree_is_the_best_one(spark, monkeypatch, depth, task_rows):
    monkeypatch.setattr(forest, "TASK_ROWS", task_rows)
    df = rows_of(spark, 300)
    model = fitted(df, depth=depth)
    table = df.orderBy("id").toPandas()
    x, y = table[NAMES].to_numpy(), table["y"].to_numpy()
    cuts = forest.cut_points(df.select(F.array(*NAMES).alias("x")), 3, 32)
    assert len(cuts[0]) == 8 and len(cuts[1]) == 24 and len(cuts[2]) == 31
    value, shares = brute(x, y, cuts, depth)
    got = M.predict(model, df).orderBy("id").toPandas()["predicted"].to_numpy()
    assert np.abs(got - [value(r) for r in x]).max() < 1e-9
    # in nodes of two or three rows several features split them alike
    assert np.abs(model.stages[-1].featureImportances.toArray() - shares).max() < (1e-9 if depth < 40 else 1e-3)


@pytest.mark.parametrize("classify", [False, True])
def test_every_way_gives_the_same(spark, monkeypatch, tmp_path, classify):
    df = rows_of(spark, 400, 1, classify)
    model = fitted(df, trees=7, bootstrap=True, tried=-1, classify=classify)
    score = (lambda m: M.classify(m, df).select("id", "score", "prediction")) if classify else (lambda m: M.predict(m, df).select("id", "predicted"))
    want = sorted(map(tuple, score(model).collect()))
    assert len(want) == 400 and len({r[1] for r in want}) > 5
    again = fitted(df.repartition(7), trees=7, bootstrap=True, tried=-1, classify=classify)
    assert sorted(map(tuple, score(again).collect())) == want
    monkeypatch.setattr(forest, "SENT_NODES", 10)
    joined = sorted(map(tuple, score(model).collect()))
    assert np.abs(np.array(joined) - np.array(want)).max() < 1e-12
    monkeypatch.undo()
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert sorted(map(tuple, score(loaded).collect())) == want
    assert M.importances(loaded, df).agg(F.round(F.sum("importance"), 9)).first()[0] == 1.0


def test_unlimited_trees_end_in_pure_leaves(spark):
    df = rows_of(spark, 250, 2).dropDuplicates(["a", "b"])
    n = df.count()
    model = fitted(df)
    wrong = M.predict(model, df).where("abs(predicted - y) > 1e-9").count()
    assert wrong == 0 and model.stages[-1].totalNumNodes == 2 * n - 1


def test_draws():
    w = forest.drawn(np.arange(200_000), 3, 42, True)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(w, forest.drawn(np.arange(200_000), 4, 42, True))[0, 1]) < 0.02


def test_odd_inputs(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0, 3.0, float(i % 2)) for i in range(10)], rows_of(spark, 1).schema)
    got = M.classify(fitted(same, trees=3, classify=True), same).select("score", "prediction").distinct().collect()
    assert [tuple(r) for r in got] == [(0.5, 0.0)]
    assert M.predict(fitted(same), same.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fitted(same.limit(0))


@pytest.mark.parametrize("classify", [False, True])
def test_rows_of_known_leaves_stay_where_they_are(spark, monkeypatch, classify):
    """Large nodes at the limit of depth, or that nothing splits, are leaves by their sums."""
    df = rows_of(spark, 600, 5, classify)
    sent, dealt = [], forest.Forest._blocks

    def seen(self, *args):
        sent.append(dealt(self, *args).selectExpr("sum(length(y)) / 8").first()[0] or 0)
        return dealt(self, *args)

    monkeypatch.setattr(forest.Forest, "_blocks", seen)
    settings = dict(depth=2, classify=classify)
    found = {}
    for rows in (10**6, 10):
        monkeypatch.setattr(forest, "TASK_ROWS", rows)
        found[rows] = {r.id: r.predicted for r in M.predict(fitted(df, **settings), df).collect()}
    assert sent[0] == 600 and sent[1] < 40
    assert found[10] == pytest.approx(found[10**6], rel=1e-12)
    same = df.withColumn("y", F.lit(1.0))
    assert {r.predicted for r in M.predict(fitted(same, classify=classify, tried=-1 if classify else 0), same).collect()} == {1.0}
    assert sent[2] == 0


def _noise(n, seed=1):
    """Binned rows, weights and cut points of five features that tell nothing of the label."""
    draw = np.random.default_rng(seed)
    cuts = [np.arange(31.0), np.arange(31.0), np.arange(31.0), np.arange(5.0), np.arange(0.0)]
    bins = np.column_stack([draw.integers(0, len(c) + 1, n) for c in cuts]).astype(np.uint8)
    return bins, draw.random(n), draw.integers(1, 4, n).astype(float), cuts


def test_growing_a_deep_tree_needs_memory_of_its_rows_only():
    """Not of a full histogram for each of its tens of thousands of nodes."""
    bins, y, w, cuts = _noise(60_000)
    tracemalloc.start()
    nodes = forest.grow(bins, y, w, cuts, 1 << 20, len(cuts), np.random.default_rng(0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(nodes.n) > 30_000
    assert peak < 16e6  # 23e6 with full histograms


@pytest.mark.parametrize("at_once", [3, 2048])
def test_splits_are_those_of_full_histograms(monkeypatch, at_once):
    """At every node, to the last digit and with the first of equal gains, for few nodes at a time too."""
    monkeypatch.setattr(forest, "NODES_AT_ONCE", at_once)
    bins, y, w, cuts = _noise(700)
    for labels in (y, np.round(y), np.round(3 * y)):
        nodes = forest.grow(bins, labels, w, cuts, 1 << 20, len(cuts), np.random.default_rng(0))
        at, cells = np.zeros(len(bins), int), 32
        for node in range(len(nodes.n)):  # parents come before children
            own = np.flatnonzero(at == node)
            assert nodes.n[node] == w[own].sum()
            found = []
            for f in range(len(cuts)):
                sums = forest._histogram(bins[own], np.zeros(len(own), int), w[own], labels[own], 1, cells, f)
                cut, gain = forest._gains(*sums)
                found.append((gain[0], -f, cut[0]))
            gain, f, cut = max(found)
            if nodes.left[node] < 0:
                assert gain <= 1e-9
                continue
            assert (nodes.feature[node], nodes.threshold[node], nodes.gain[node]) == (-f, cuts[-f][cut], gain)
            right = bins[own, -f] > cut
            at[own] = np.where(right, nodes.right[node], nodes.left[node])


@pytest.mark.parametrize("classify, task_rows", [(False, 60), (True, 10**6)])
def test_large_forests_grow_where_their_rows_are_sent(spark, monkeypatch, classify, task_rows):
    """The same trees as of rows that are dealt out, large nodes and cells of several rows too; scores
    write neither a table of the model nor rows for each tree."""
    monkeypatch.setattr(forest, "TASK_ROWS", task_rows)
    settings = dict(trees=5, bootstrap=True, classify=classify, depth=9, tried=2 if classify else 0)
    score = (lambda m, df: M.classify(m, df).select("id", "score")) if classify else (lambda m, df: M.predict(m, df).select("id", "predicted"))
    odd = rows_of(spark, 120, 9).withColumn("id", F.col("id") + 1000).withColumn("a", F.lit(-1e9))
    for df in (rows_of(spark, 500, 1, classify), rows_of(spark, 400, 2, classify).withColumns({"a": F.lit(1.0), "c": F.round("c")})):
        asked = df.unionByName(odd).unionByName(odd)
        dealt = fitted(df, **settings)
        want = sorted(map(tuple, score(dealt, asked).collect()))
        monkeypatch.setattr(forest, "SENT_NODES", 10)
        monkeypatch.setattr(forest.Forest, "_blocks", lambda *args: pytest.fail("rows are dealt out"))
        monkeypatch.setattr(forest, "BLOCK", 64)
        model = fitted(df, **settings)
        stored = []
        monkeypatch.setattr(forest, "durable", lambda table, kept=forest.durable: stored.append(table.columns) or kept(table))
        got = sorted(map(tuple, score(model, asked).collect()))
        assert [r[0] for r in got] == [r[0] for r in want] and len(got) == df.count() + 240
        assert [r[1] for r in got] == pytest.approx([r[1] for r in want], rel=1e-9)
        assert stored == [["_cell"], ["_cell", "_value"]]
        nodes = ["tree", "part", "node", "left", "right", "feature", "threshold", "n"]
        tables = [sorted(map(tuple, m.stages[-1].node_table().select(*nodes).fillna(-1).collect())) for m in (dealt, model)]
        assert tables[0] == tables[1]
        again = sorted(map(tuple, score(model, asked).collect()))  # now from the table
        assert [r[1] for r in again] == pytest.approx([r[1] for r in want], rel=1e-9)
        monkeypatch.setattr(forest, "SENT_BYTES", 300)  # cells in several parts, fits on rows that are dealt out
        again = sorted(map(tuple, score(model, asked).collect()))
        assert [r[1] for r in again] == pytest.approx([r[1] for r in want], rel=1e-9)
        monkeypatch.undo()
        monkeypatch.setattr(forest, "TASK_ROWS", task_rows)


def test_equal_rows_are_put_together(spark):
    """By counting, by sorting, and where keys of 64 bits cannot tell all cells apart."""
    draw = np.random.default_rng(4)
    for features, bins in ((3, 9), (5, 32), (16, 32)):
        x = draw.integers(0, bins, (200, features)).astype(np.uint8)[draw.integers(0, 200, 5000)]
        first, cell = forest._cells(x, [np.arange(bins - 1.0)] * features)
        assert len(first) == len(np.unique(x, axis=0)) and (x[first][cell] == x).all()
    assert forest._cells(np.arange(250, dtype=np.uint8)[:, None], [np.arange(255.0)]) is None


@pytest.mark.parametrize("cells", [6, 25, 32, 40])
def test_splits_of_small_nodes_are_those_of_full_histograms(cells):
    """Only bins with rows get a place there; sums are the same to the last digit."""
    draw = np.random.default_rng(cells)
    node, bins = np.sort(draw.integers(0, 300, 3000)), draw.integers(0, cells, 3000).astype(np.uint8)
    node = np.unique(node, return_inverse=True)[1]
    w = draw.integers(1, 4, 3000).astype(float)
    for s in (w * draw.normal(size=3000), w * draw.integers(0, 2, 3000)):
        n, sums = (np.bincount(node * cells + bins, v, (node[-1] + 1) * cells).reshape(-1, cells) for v in (w, s))
        cut, gain = forest._gains(n, sums)
        at, most = forest._best_present(bins, node, w, s, len(n), cells, False)
        some = np.isfinite(gain)
        assert some.any() and (gain == most).all() and (cut == at)[some].all()
