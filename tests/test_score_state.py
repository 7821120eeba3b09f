"""Score states: merged batches equal the whole; edges."""

from pyspark.sql import functions as F

from scorecraft.operators import evaluation as ev
from scorecraft.operators import score_state as ss


def scored(spark):
    rows = [(i, "ab"[i % 2], float(i * 7 % 23) / 23, int(i * 5 % 7 < 3), int(i % 3 == 0)) for i in range(400)]
    rows += [(400, "a", None, 1, 0), (401, "a", 0.5, None, 1), (402, None, 0.5, 1, None), (403, None, 0.25, 0, 0)]
    return spark.createDataFrame(rows, "id int, g string, score double, label int, prediction int")


def brute(rows):
    rows = [r for r in rows if r.label is not None]
    at = lambda r: -1.0 if r.score is None else r.score
    pos, neg = [at(r) for r in rows if r.label], [at(r) for r in rows if not r.label]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    ks = max(abs(sum(x >= t for x in pos) / len(pos) - sum(x >= t for x in neg) / len(neg)) for t in pos + neg)
    ap = sum(sum(x >= t for x in pos) / sum(x >= t for x in pos + neg) for t in pos) / len(pos)
    hits = sum(r.prediction == r.label for r in rows)
    return len(rows), len(pos), round(auc, 6), round(100 * ks, 4), round(ap, 6), round(hits / len(rows), 6)


def test_batches_equal_brute_force(spark, tmp_path):
    df, path = scored(spark), str(tmp_path / "states")
    for i in range(3):
        ss.store_batch(ss.score_state(df.filter(F.col("id") % 3 == i), by=["g"], prediction="prediction"), path, f"{i}")
    # a batch that runs again replaces itself
    ss.store_batch(ss.score_state(df.filter(F.col("id") % 3 == 1), by=["g"], prediction="prediction"), path, "1")
    merged = ss.merge_states(ss.read_states(spark, path), ["g"])
    got = {r.g: tuple(r)[1:] for r in ss.metrics_from_state(merged, ["g"]).collect()}
    rows = df.collect()
    assert set(got) == {"a", "b", None}
    for g in got:
        want = brute([r for r in rows if r.g == g])
        assert got[g][:2] == want[:2]
        assert all(abs(x - y) < 2e-6 for x, y in zip(got[g][2:], want[2:], strict=True)), (g, got[g], want)


def test_merges_of_merges(spark):
    df = scored(spark)
    parts = [ss.score_state(df.filter(F.col("id") % 4 == i)) for i in range(4)]
    two = [ss.merge_states(parts[0].unionByName(parts[1])), ss.merge_states(parts[2].unionByName(parts[3]))]
    key = lambda r: (r.score is None, r.score or 0)
    assert sorted(ss.merge_states(two[0].unionByName(two[1])).collect(), key=key) == sorted(
        ss.score_state(df).collect(), key=key)
    m = ss.metrics_from_state(ss.score_state(df.filter("score IS NOT NULL"))).first()
    assert m.accuracy is None and m.auc == ev.auc_roc(df.filter("score IS NOT NULL AND label IS NOT NULL")).first().auc


def test_curves_and_one_class(spark):
    df = scored(spark).filter("g = 'b'")
    got = {(r.threshold, r.fpr, r.recall) for r in ss.curve_points(ss.score_state(df)).collect()}
    assert got == {tuple(r) for r in ev.roc_points(df).collect()}
    one = ss.metrics_from_state(ss.score_state(df.filter("label = 1"))).first()
    assert (one.auc, one.ks, one.average_precision) == (None, None, 1.0)
    assert ss.metrics_from_state(ss.score_state(df.filter("false"), by=["g"]), ["g"]).count() == 0
