import math
import random
import re
from collections import Counter

import pytest

from themeweave.functions import fixed_values as fv
from themeweave.operators import terms


def plain_ctfidf(docs, n=10):
    """docs: list of (cluster, text). Scores by the formula, ties to the later term."""
    stop = set(fv.STOPWORDS["pt"])
    split = [(c, [t for t in re.findall(r"\b\w\w+\b", x.lower()) if t not in stop]) for c, x in docs if c != -1]
    df = Counter(t for _, ts in split for t in set(ts))
    vocabulary = {t for t, f in df.items() if 2 <= f <= 0.95 * len(split)}
    clusters = {c: Counter() for c, _ in split}
    for c, ts in split:
        clusters[c].update(t for t in ts if t in vocabulary)
    total = sum(clusters.values(), Counter())
    mean = sum(sum(c.values()) for c in clusters.values()) / len(clusters)
    out = {}
    for c, counts in clusters.items():
        scored = [(f * math.log(1 + mean / (total[t] + 1)), t) for t, f in counts.items()]
        out[c] = [(t, s) for s, t in sorted(scored, reverse=True)[:n]]
    return out


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    words = [f"palavra{i}" for i in range(60)] + ["de", "não", "Casa", "casa", "x"]
    rows = [(rng.choice([-1, 0, 0, 0, 1, 2]), " ".join(rng.choices(words, k=rng.randint(1, 40))) + ".") for _ in range(200)]
    return rows + [(7, "sozinho")]


def frame(spark, docs):
    return spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(docs)], "doc_id long, c int, texto_modelo string").repartition(5)


def test_top_terms_equal_plain_python(spark, docs):
    got = {}
    for r in terms.ctfidf_top_terms(frame(spark, docs), "c").orderBy("cluster_id", "rank").collect():
        got.setdefault(r["cluster_id"], []).append((r["term"], r["score"]))
    want = {c: v for c, v in plain_ctfidf(docs).items() if v}
    assert {c: [t for t, _ in v] for c, v in got.items()} == {c: [t for t, _ in v] for c, v in want.items()}
    for c in want:
        assert [s for _, s in got[c]] == pytest.approx([s for _, s in want[c]], abs=1e-9)


def test_cluster_without_vocabulary_counts_in_the_mean(spark, docs):
    counts = terms.count_terms(frame(spark, docs), "c")
    vocabulary = terms.cluster_term_counts(counts)
    assert 7 not in {r["cluster_id"] for r in vocabulary.collect()}
    words = sum(r["tf"] for r in vocabulary.collect())
    assert terms.mean_cluster_words(counts, vocabulary).first()[0] == pytest.approx(words / 4)


def test_padding_fills_short_clusters_with_last_terms(spark, docs):
    df = frame(spark, docs + [(8, "palavra1"), (8, "palavra2 palavra2")])
    padded = [r for r in terms.ctfidf_top_terms(df, "c", pad_zero=True).orderBy("rank").collect() if r["cluster_id"] == 8]
    assert len(padded) == 10 and [r["score"] > 0 for r in padded] == [True, True] + [False] * 8
    vocabulary = sorted({r["term"] for r in terms.cluster_term_counts(terms.count_terms(df, "c")).collect()}, reverse=True)
    own = {r["term"] for r in padded[:2]}
    assert [r["term"] for r in padded[2:]] == [t for t in vocabulary if t not in own][:8]


def test_impossible_bounds_raise(spark):
    with pytest.raises(ValueError, match="too few"):
        terms.ctfidf_top_terms(frame(spark, [(0, "uma casa"), (0, "duas casas")]), "c")


def test_empty_vocabulary_raises(spark):
    with pytest.raises(ValueError, match="no term"):
        terms.ctfidf_top_terms(frame(spark, [(0, "uma casa"), (1, "dois carros"), (1, "tres pontes")]), "c")


def test_counting_terms_shuffles_once(spark, docs):
    plan = terms.term_occurrences(frame(spark, docs), "c").groupBy("cluster_id", "term").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Generate inline") == 1 and text.count("Exchange hashpartitioning") == 1
