import numpy as np
from rosterlake.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, node long, hi long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.95):
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def unit(i):
        v = rows[i][1]
        if rows[i][0] is None or not v or any(x is None or not np.isfinite(np.float32(x)) for x in v) or not any(v):
            return None
        x = np.asarray(v, np.float32).astype(float)
        return x / np.linalg.norm(x)

    units = [unit(i) for i in range(n)]
    for a in range(n):
        for b in range(a):
            if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold:
                links[a] += 1
                links[b] += 1
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = {r: min((rows[i][0] for i in range(n) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    return sorted(((rows[i][0], links[i], least[root[i]]) for i in range(n)), key=str)


def result(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(25):
        base = rng.standard_normal(64)
        rows += [(int(1000 + c * 40 + k), (base + rng.standard_normal(64) * rng.choice([0.05, 0.2, 0.32])).tolist()) for k in range(12)]
    rows += [(5000 + i, rows[0][1]) for i in range(30)]
    want = brute(rows)
    assert result(embeddings.near_vectors(table(spark, rows))) == want
    monkeypatch.setattr(embeddings, "BLOCK", 16)  # every bucket in pairs of blocks
    assert result(embeddings.near_vectors(table(spark, rows))) == want


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, float("nan")]), (5, [1.0, None]), (6, [float("inf"), 1.0]), (7, v), (8, v),
            (9, [2 * x for x in v]), (None, v), (10, [1.0]), (11, [3.0]), (12, [-1.0]), (7, v), (13, [0.0, 1.0]), (14, [-0.0, 1.0]), (15, [1e-30, 1e38]),
            (2**60, [-x for x in v]), (7, [5.0, 1.0, 0.0]), (16, [5.0, 1.0, 0.1]), (8, [1.0])]
    assert result(embeddings.near_vectors(table(spark, rows))) == brute(rows)
    assert embeddings.near_vectors(table(spark, [])).count() == 0


def test_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    x = embeddings.unit_rows(list(rng.standard_normal((400, 64))))
    turned, signs, factor = embeddings.codes(x)
    code = (signs * 2.0 - 1) / 8
    error = code @ turned.T / factor[:, None] - x @ x.T
    bound = embeddings.CONFIDENCE * np.sqrt((1 - factor**2) / factor**2 / 63)
    assert abs(error.mean()) < 0.005 and (np.abs(error) <= bound[:, None]).all()


def test_plan_holds_the_promised_miss():
    for rows in (10, 10_000, 10**9):
        bits, tables = embeddings.plan(rows)
        meet = (1 - np.arccos(0.95) / np.pi) ** bits
        assert (1 - meet) ** tables <= 1e-4
