import math

from pyspark.sql import functions as F
from rosterlake.llm import quality


def brute(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


TEXTS = ["", None, "  \n\n ", "a b c d e a b c d e", "x " * 30, "l1\nl1\nl1 \n\n\nl2\r\nl2\r\n", "é ß # * $ % & | < > ü", "a b\x0bc\x1cd\x85e f\u00a0g",
         "one two three four five six seven eight nine ten", "p q r s t u v p q r s t w w w w w w w w w"]


def test_base_figures(spark, frame):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality_rules(frame(list(enumerate(TEXTS))), labels).collect()
    assert len(out) == len(TEXTS)
    for r in out:
        want = brute(TEXTS[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r["kept"] == (not r["base_failed"])  # one label allows no rule


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.3), (12, 0.05), (200, 0.02)):
        for k in range(min(n, 8)):
            want = sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
            assert abs(quality.binomial_tail(k, n, p) - want) < 1e-12


def test_cutoff_stops_at_the_first_failure():
    assert quality.cutoff([0, 0, 50, 0], 2000, [1, 5, 90, 99], [4, 3, 2, 1], 0.005, 0.01) == 1
    assert quality.cutoff([0, 0], 500, [9, 9], [2, 1], 0.005, 0.01) is None  # too few labels for the promise
    assert quality.cutoff([0, 0], 2000, [0, 0], [2, 1], 0.005, 0.01) is None  # of no use
    assert quality.cutoff([0, 1], 4000, [5, 30], [2, 1], 0.005, 0.01) == 1


def test_learned_rules_reject_junk_only(spark):
    n = 3000
    docs = spark.range(2 * n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < n, F.concat_ws(" ", *[F.concat(F.lit("w"), F.col("id") * 20 + i) for i in range(12)])).otherwise(
            F.concat_ws("$$ ", *[F.concat(F.lit("w"), F.col("id") * 20 + i) for i in range(12)])).alias("text"),
        F.when(F.col("id") % n < 2850, "en").otherwise("few").alias("lang"))
    labels = spark.range(2 * n).select(F.col("id").alias("doc_id"), (F.col("id") < n).cast("int").alias("quality"))
    out = quality.quality_rules(docs, labels).groupBy("stratum", (F.col("doc_id") < n).alias("good"), "kept").count().collect()
    found = {(r["stratum"], r["good"], r["kept"]): r["count"] for r in out}
    assert found == {("en", True, True): 2850, ("en", False, False): 2850, ("few", True, True): 150, ("few", False, True): 150}


def test_bound_holds_on_fresh_documents():
    import numpy as np
    rng = np.random.default_rng(0)
    alpha, broken, used = 0.02, 0, 0
    for _ in range(200):  # the ratio of good documents is uniform, so the true rate beyond c is 1 - c
        good, bad = np.sort(rng.random(3000)), rng.random(3000) * 0.2 + 0.9
        grid = [1 - 0.001 * i for i in range(60)]
        k = [int((good > c).sum()) for c in grid]
        i = quality.cutoff(k, 3000, [int((bad > c).sum()) * 100 for c in grid], grid, alpha, 0.05)
        used += i is not None
        broken += i is not None and 1 - grid[i] > alpha
    assert used > 150 and broken <= 20


def test_odd_rows(spark, frame, odd_rows):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (6, 1, 0), (6, 0, 0), (4, 0, None)], "doc_id long, quality int, toxic int")
    rows = [*odd_rows, (9, "ten words " * 5, None, None)]
    assert quality.quality_rules(frame(rows), labels).count() == len(rows)
    kept = quality.keep_good(frame(rows), labels)
    assert kept.columns == frame([]).columns and {r["doc_id"] for r in kept.collect()} == {None, 4, 5}
    assert quality.quality_rules(frame([]), labels).count() == 0
    assert quality.quality_rules(frame(rows), labels.limit(0)).count() == len(rows)


def test_rule_path_is_nested_and_prefers_cheap_rules():
    import numpy as np
    places = np.array([[0, 3], [1, 3], [2, 3], [2, 0], [2, 1], [1, 1]])  # the first broken place of two rules; 2 and 3 are none
    good, bad = np.array([0, 0, 50, 0, 0, 2]), np.array([5, 4, 0, 3, 1, 0])
    path = quality.rule_path(places, good, bad, [2, 3], 4)
    assert path == [(0, -1), (0, 0)]  # places 1 of both rules cost two good documents
    assert quality.rule_path(places, good * 0, bad, [2, 3], 4) == [(0, -1), (1, -1), (1, 0), (1, 1)]
    assert quality.rule_path(places, good, bad * 0, [2, 3], 4) == []
    for low, high in zip(path, path[1:]):
        assert not (quality.rejected(places, low) & ~quality.rejected(places, high)).any()


def test_combined_rules_keep_the_promise_on_fresh_documents():
    """Four noisy ratios, 400 good documents a draw: the chosen union rejects more than alpha of fresh ones in few draws."""
    import numpy as np
    rng = np.random.default_rng(1)
    size, broken, used, caught = 20, 0, 0, []
    draw = lambda n, shift: np.minimum(rng.geometric(shift, (n, 4)) - 1, size)
    for _ in range(150):
        good, bad, fresh = size - draw(400, 0.45), size - draw(60, 0.06), size - draw(20_000, 0.45)
        tunes = rng.random(400) < quality.TUNING
        places = np.concatenate([good, bad])
        path = quality.rule_path(places, np.concatenate([tunes, np.zeros(60)]), np.concatenate([np.zeros(400), np.ones(60)]), [size] * 4,
                                 quality.PRICE / quality.TUNING)
        k = [int(quality.rejected(good[~tunes], r).sum()) for r in path]
        i = quality.cutoff(k, int((~tunes).sum()), [int(quality.rejected(bad, r).sum()) for r in path], path, 0.02, 0.05)
        if i is not None:
            used += 1
            broken += quality.rejected(fresh, path[i]).mean() > 0.02
            caught.append(quality.rejected(bad, path[i]).mean())
    assert used > 100 and broken <= 0.05 * 150 + 6 and np.mean(caught) > 0.5


def test_labelled_bad_documents_of_small_strata_are_rejected(spark):
    folder = "/root/testdata/sf0.1/"
    docs, labels = (spark.read.parquet(f"{folder}{t}.parquet") for t in ("documents", "labels"))
    out = quality.quality_rules(docs, labels).where("NOT base_failed").join(labels.where("quality IS NOT NULL"), "doc_id")
    rows = out.groupBy("stratum", "quality").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("gone")).collect()
    share = {(r["stratum"], r["quality"]): r["gone"] / r["n"] for r in rows}
    for lang in ("de", "en", "es", "fr"):
        assert share[(lang, 0)] > 0.9 and share[(lang, 1)] <= 0.02, share


def test_rows_of_one_id_are_judged_apart(spark, frame):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    good = "one two three four five six seven eight nine ten eleven"
    rows = [(7, good), (7, "too short"), (7, None), (8, good)]
    kept = quality.keep_good(frame(rows), labels).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(7, good), (8, good)]
