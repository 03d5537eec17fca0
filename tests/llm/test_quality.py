"""Statistics by hand, the fit against one-machine least squares, and held-out
accuracy of the registered query."""
import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import types as T

from tessera.llm import quality as Q
from tessera.llm.queries import QUERIES


def stat(text):
    return dict(zip(Q.FEATURES, Q.statistics(pa.array([text]))[0], strict=True))


def test_statistics_by_hand():
    s = stat("The cat, THE dog!\nA1 bird\nA1 bird")
    words = "The cat, THE dog! A1 bird A1 bird".split()
    assert s["log_words"] == np.log1p(8) and s["log_bytes"] == np.log1p(33)
    assert s["distinct_words"] == 6 / 8 and s["top_word"] == 2 / 8 and s["repeat_pairs"] == 1 - 6 / 7
    assert s["word_len"] == np.mean([len(w) for w in words]) and s["caps_words"] == 3 / 8 and s["title_words"] == 1 / 8
    assert s["repeat_lines"] == 1 - 2 / 3 and s["short_lines"] == 2 / 3 and s["newline"] == 2 / 8
    assert not Q.statistics(pa.array(["", " \n"]))[0].any()
    both = Q.statistics(pa.array(["one two", "", "Three! four\nfive"]))
    assert np.allclose(both[2], Q.statistics(pa.array(["Three! four\nfive"]))[0]) and np.allclose(both[0], Q.statistics(pa.array(["one two"]))[0])


def test_isotonic_levels_rise():
    rng = np.random.default_rng(2)
    good = rng.binomial(20, np.linspace(0.1, 0.9, 50))
    at, levels = Q.isotonic(np.arange(50.0), np.full(50, 20.0), good.astype(float))
    assert (np.diff(at) > 0).all() and (np.diff(levels) >= -0.05).all() and 0 < levels[0] < levels[-1] < 1


def test_fit_equals_least_squares(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["good", "text", "runs"], 20)) if i % 2 else " ".join(rng.choice(["BAD!!", "###"], 20)) for i in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    model = Q.fit(Q.features(df), labels)
    x = Q.statistics(pa.array(texts))
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i in range(200)])
    use = (fold != 0) & (fold != 4)
    z, y = Q.fourier(x[use], model.mean, model.scale), np.arange(200)[use] % 2
    penalty = np.eye(z.shape[1]) * Q.RIDGE * use.sum()
    penalty[-1, -1] = 1e-9
    assert np.allclose(z @ model.weights, z @ np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)
    assert np.allclose(model.mean, x[fold != 0].mean(0))
    rows = {r.doc_id: r for r in Q.score(df, labels).collect()}
    assert all(rows[i].held_out == (fold[i] == 0) and (rows[i].score > 0.5) == bool(i % 2) for i in range(200))


def test_odd_rows(spark):
    schema = T.StructType.fromDDL("doc_id long, text string, quality int, score string, stats int, y double")
    df = spark.createDataFrame([(1, None, 5, "s", 1, 0.0), (2, "", 5, "s", 1, 0.0), (None, "x", 5, "s", 1, 0.0), (3, "a b", 5, "s", 1, 0.0), (3, "a b", 5, "s", 1, 0.0)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = Q.score(df, none).collect()
    assert len(rows) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    some = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    assert len(Q.score(df, some).collect()) == 5
    assert Q.score(df.limit(0), some).count() == 0
    out = Q.accepted(df, some)
    assert out.columns == df.columns


def test_query_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op2_quality"](spark, sf_dir).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    held = [(rows[d].score, q, rows[d].predicted) for d, q in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(rows[d].held_out for d, _ in labels if zlib.crc32(str(d).encode()) % 5 == 0)
    good, bad = np.array([s for s, q, _ in held if q]), np.array([s for s, q, _ in held if not q])
    assert (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean() > 0.98
    assert np.mean([p == q for _, q, p in held]) > 0.97 and np.mean([p for _, q, p in held if q]) > 0.99
