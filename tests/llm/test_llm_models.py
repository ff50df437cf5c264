"""Language model, language identification and quality classifier."""

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import empty, odd, odd_rows, prose, words

from themeweave.llm import language_id, language_model, quality


def brute_force_model(rows, held, order):
    texts = [(d, words(t, lower=True)) for d, t in rows]
    train = [w for d, w in texts if not held(d)]
    tokens, levels = Counter(), {order: Counter()}

    def grams(w):
        line = [*[1] * (order - 1), *w, 2]
        return [tuple(line[i : i + order]) for i in range(len(w) + 1)]

    for w in train:
        tokens.update([*w, 2])
        levels[order].update(grams(w))
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    after = defaultdict(dict)
    for k in range(2, order + 1):
        for g, n in levels[k].items():
            after[g[:-1]][g[-1]] = n
    counts_of = lambda c: [sum(1 for n in c.values() if n == k) for k in (1, 2, 3, 4)]
    d = {k: language_model.discounts(counts_of(c)) for k, c in levels.items()}
    n, v, types = sum(tokens.values()), len(tokens), sum(levels[1].values())
    rest = sum(d[1][min(k, 3)] for k in levels[1].values()) / types

    def p(h, w):
        if not h:
            before = levels[1][(w,)]
            return max(before - d[1][min(before, 3)], 0) / types + rest / (v + 1)
        lower, seen, e = p(h[1:], w), after[h], d[len(h) + 1]
        if not seen:
            return lower
        saved = sum(e[min(k, 3)] for k in seen.values())
        c = seen.get(w, 0)
        return (max(c - e[min(c, 3)], 0) + saved * lower) / sum(seen.values())

    out = []
    for i, w in texts:
        out.append((i, held(i), len(w) + 1, sum(tokens[x] > 0 for x in [*w, 2]), n,
                    sum(math.log10((tokens[x] + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, 2]),
                    sum(math.log10(p(g[:-1], g[-1])) for g in grams(w))))
    return out, p, list(tokens)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


@pytest.mark.parametrize("order, shard", [(2, 5_000), (3, 5_000), (3, 100_000_000), (4, 3_000)])
def test_scores_equal_brute_force(spark, monkeypatch, order, shard):
    monkeypatch.setattr(language_model, "SHARD", shard)  # several shards
    monkeypatch.setattr(language_model, "CHUNK", 4_000)  # and several packets for each
    rows = [r[:2] for r in odd_rows()]
    want, p, vocabulary = brute_force_model(rows, held, order)
    for history in [(1,) * (order - 1), ("never",) * (order - 2) + ("the",), ("of",) * (order - 2) + ("unseen",)]:
        assert abs(sum(p(history, w) for w in [*vocabulary, "unseen"]) - 1) < 1e-9
    got = [tuple(r) for r in language_model.score_held_out(odd(spark), order=order).collect()]
    key = lambda r: repr(r[:5])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_a_longer_context_tells_texts_apart(spark):
    """What follows two words is known to trigrams only."""
    rows = [(i, f"a x {'p' if i % 2 else 'q'} b x {'q' if i % 2 else 'p'}") for i in range(1)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("text")
    models = {k: language_model.train(docs, k) for k in (2, 3)}
    asked = spark.createDataFrame([(1, "a x q b x p", False), (2, "a x p b x q", False)], "doc_id long, text string, held_out boolean")
    scores = {k: dict(language_model.score(asked, m).select("doc_id", "score").collect()) for k, m in models.items()}
    assert scores[3][1] - scores[3][2] > 1 + scores[2][1] - scores[2][2]


@pytest.mark.parametrize("n", [1, 31, 5_000, 200_000])
def test_short_arrays_find_what_they_hold(tmp_path, n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, 2 * n, np.uint64, endpoint=False) & np.uint64((1 << 63) - 1)
    keys = keys[np.argsort(keys << np.uint64(16))]
    held, other = keys[::2], keys[1::2]
    sizes = {0: language_model.ShortArrays.write(str(tmp_path), 0, held, np.arange(n, dtype=np.uint64))}
    found, (value,) = language_model.ShortArrays(str(tmp_path), 1, sizes, [np.dtype(np.uint64)]).find(np.concatenate([other, held]))
    assert found.tolist() == [False] * n + [True] * n and value[n:].tolist() == list(range(n))


def test_model_without_training_texts(spark):
    assert language_model.score_held_out(empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, "a b", True)], "doc_id long, text string, held_out boolean")
    row = language_model.score(docs, language_model.train(empty(spark))).first()
    assert row["score"] == 0 and row["n_known"] == 0 and row["train_tokens"] == 0


def test_best_paths_equal_enumeration():
    rng = np.random.default_rng(3)
    lengths = [0, 1, 5, 4, 0, 6, 1]
    first = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=(first[-1], 3)).astype(np.float32)
    label = language_id.best_paths(scores, first, 0.7)

    def value(path, s):
        return sum(s[t, k] for t, k in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))

    for a, b in zip(first, first[1:]):
        best = max(value(p, scores[a:b]) for p in itertools.product(range(3), repeat=b - a))
        assert math.isclose(value(label[a:b], scores[a:b]), best, rel_tol=1e-5, abs_tol=1e-6)


def language_rows():
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "клмно"}
    rng = np.random.default_rng(1)
    text = lambda lang, n: " ".join("".join(rng.choice(list(alphabets[lang]), 4)) for _ in range(n))
    rows = [(i, text(lang, 30), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    return rows, text


def test_more_languages_than_a_byte_counts():
    for n in (130, 300):
        scores = np.zeros((2 * n, n), np.float32)
        scores[np.arange(2 * n), np.repeat(np.arange(n), 2)] = 5.0
        label = language_id.best_paths(scores, np.arange(0, 2 * n + 1, 2), 0.7)
        assert label.tolist() == np.repeat(np.arange(n), 2).tolist()


def test_languages_beyond_the_hundred_and_twenty_seventh(spark):
    word = lambda k: "".join(chr(0x4E00 + 3 * k + j) for j in range(3))
    rows = [(i, " ".join([word(i % 130)] * 6), f"l{i % 130:03d}") for i in range(1040)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    wrong = [r["doc_id"] for r in got if r["lang_pred"] != f"l{r['doc_id'] % 130:03d}"]
    assert not wrong


def test_mixed_text_is_cut_where_the_language_changes(spark):
    rows, text = language_rows()
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    docs = [(1, text("aa", 20) + " 12 " + text("bb", 30)), (2, text("cc", 5)), (3, "12 !"), (4, None), (5, ""), (6, "漢字 漢字")]
    found = language_id.predict(spark.createDataFrame([(i, t, False) for i, t in docs], "doc_id long, text string, held_out boolean"), model)
    got = {r["doc_id"]: (r["lang_pred"], [(s["words"], s["lang"]) for s in r["spans"]], r["score"]) for r in found.collect()}
    assert got[1][0] == "bb" and got[1][2] == 0.6
    assert got[1][1] in ([(20, "aa"), (31, "bb")], [(21, "aa"), (30, "bb")])
    assert got[2] == ("cc", [(5, "cc")], 1.0)
    assert got[3] == got[4] == got[5] == ("und", [], 0.0)
    assert got[6][0] in ("aa", "bb", "cc")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)


def test_languages_of_odd_documents(spark):
    got = language_id.identify(odd(spark)).collect()
    assert len(got) == len(odd_rows())
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert language_id.identify(empty(spark)).count() == 0
    unlabelled = odd(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_expectation_maximisation_finds_the_kinds_of_bad():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.85
    kind = rng.integers(0, 3, len(good))
    votes = np.full((len(good), 4), quality.GOOD)
    for k in range(3):
        votes[~good & (kind == k) & (rng.random(len(good)) < 0.9), k] = quality.BAD
    votes[good & (rng.random(len(good)) < 0.001), 3] = quality.BAD
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    believed = quality.posterior(patterns, n.astype(float))
    for pattern, p in zip(patterns, believed):
        assert (p < 0.5) == (pattern[:3] == quality.BAD).any() or (pattern[3] == quality.BAD)


def test_classifier_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    got = quality.classify(docs, quality.fit(docs, labels)).join(labels.withColumnRenamed("quality", "q"), "doc_id").collect()
    clean = [r["kept"] for r in got if r["q"] == 1 and r["toxic"] == 0]
    bad = [r["kept"] for r in got if r["q"] == 0]
    toxic = [r["kept"] for r in got if r["q"] == 1 and r["toxic"] == 1]
    assert np.mean(clean) > 0.98 and np.mean(bad) < 0.1 and np.mean(toxic) < 0.4


def test_classifier_on_odd_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0), (7, None, None), (None, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = odd(spark)
    got = quality.classify(docs, quality.fit(docs, labels)).collect()
    assert len(got) == len(odd_rows())
    assert not any(r["kept"] for r in got if r["doc_id"] in (3, 4, 5))
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)
    none = empty(spark)
    assert quality.classify(none, quality.fit(none, labels.limit(0))).count() == 0


def test_prose_is_good_and_noise_is_not(spark):
    rows = [(i, prose(i, 80)) for i in range(80)] + [(100 + i, prose(i, 40).replace(" ", "### ")) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r["doc_id"]: r["kept"] for r in quality.classify(docs, quality.fit(docs, labels)).collect()}
    assert all(kept == (i < 100) for i, kept in got.items())


def test_model_of_an_empty_table_can_be_used(spark):
    models = quality.fit(empty(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    rows = quality.classify(odd(spark), models).collect()
    blank = [r for r in rows if r["doc_id"] in (3, 4, 5)]
    assert all(r["score"] == 0 and not r["kept"] for r in blank) and len(rows) == len(odd_rows())
    assert {r["score"] for r in rows} == {0.0, 0.5}


def test_unseen_votes_are_judged_by_the_rates():
    votes = np.array([[1, 1, 1], [0, 1, 1], [1, 0, 1], [2, 2, 2], [0, 0, 1]])
    found = quality.estimate(votes, np.array([900.0, 30, 30, 400, 20]))
    seen = found.members(votes)[:, 0]
    assert np.allclose(seen, quality.posterior(votes, np.array([900.0, 30, 30, 400, 20])))
    # by hand for a pattern that never came
    new = np.array([[2, 0, 1]])
    each = found.share * np.prod([found.rates[:, k, v] for k, v in enumerate(new[0])], axis=0)
    assert np.isclose(found.members(new)[0, 0], each[0] / each.sum())


def test_a_repeated_id_does_not_widen_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 50)
    drawn = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda *a, **k: drawn.append(len(a[2])) or train(*a, **k))
    docs = spark.createDataFrame([(1 if i % 2 else i, f"words of row {i} that go on") for i in range(400)], "doc_id long, text string")
    quality.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert drawn == [50, 50]
