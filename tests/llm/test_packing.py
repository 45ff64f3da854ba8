import random

import pandas as pd
from rosterlake.llm import packing


def slow_best_fit(items, capacity):
    """Reference: scan all bins for the tightest compatible one. items: (words, source, cluster) in packing order."""
    bins, out = [], []
    for words, source, cluster in items:
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= words and source not in b["s"] and cluster not in b["c"]]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"room": capacity, "s": set(), "c": set()})
            i = len(bins) - 1
        bins[i]["room"] -= words
        bins[i]["s"] |= {source} - {None}
        bins[i]["c"] |= {cluster} - {None}
        out.append(i)
    return out


def test_tightest_compatible_bin():
    rng = random.Random(1)
    for size in (1, 10, 400):
        rows = pd.DataFrame({"row": [f"{i:04d}" for i in range(size)], "words": [rng.randint(0, 99) for _ in range(size)],
                             "source": [rng.choice(["hot", "hot", None, *map(str, range(80))]) for _ in range(size)],
                             "cluster": [rng.choice([None, *map(str, range(100))]) for _ in range(size)]})
        out = packing.pack(rows, 100)
        ordered = rows.sort_values(["words", "row"], ascending=[False, True])
        want = dict(zip(ordered["row"], slow_best_fit(list(zip(ordered["words"], ordered["source"], ordered["cluster"])), 100)))
        assert dict(zip(out["row"], out["bin"])) == want


def facts(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, n_words int, source string, cluster string, bin int, shard int")
    return packing.best_fit(df, **options)


def test_whole_table(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 5, 40, 99, 100, 101, 350]), rng.choice(["hot", "hot", "a", "b"]), rng.choice([None, "x", str(i)]), 0, 0) for i in range(900)]
    out = facts(spark, rows, capacity=100, shard_rows=100).toPandas()
    words = {i: w for i, w, *_ in rows}
    assert out.groupby("doc_id")["words"].sum().to_dict() == words
    bins = out.groupby(["shard", "bin"])
    assert out["shard"].nunique() == 9 and bins["words"].sum().max() <= 100
    assert ((bins["words"].sum() + bins["left"].first()) == 100).all()
    out["source"] = out["doc_id"].map({r[0]: r[2] for r in rows})
    out["cluster"] = out["doc_id"].map({r[0]: r[3] for r in rows})
    assert not out.duplicated(["shard", "bin", "source"]).any()
    assert not out[out["cluster"].notna()].duplicated(["shard", "bin", "cluster"]).any()
    parts = out.sort_values(["doc_id", "part"])
    assert (parts["start"] == parts["part"] * 100).all()


def test_odd_rows(spark, frame, odd_rows):
    rows = [(None, 5, None, None, 1, 1), (None, None, "s", "c", 1, 1), (1, -4, "s", "c", 1, 1), (1, 4, "s", "c", 1, 1), (2**60, 5000, None, None, 1, 1)]
    out = facts(spark, rows).toPandas()
    assert len(out) == 7 and out["words"].sum() == 5009
    assert facts(spark, []).count() == 0
    sized = packing.sized(frame(odd_rows))
    assert sorted(r["n_words"] for r in sized.collect()) == sorted(len((t or "").split()) for _, t in odd_rows)
    assert packing.best_fit(sized).agg({"words": "sum"}).first()[0] == sum(len((t or "").split()) for _, t in odd_rows)
