"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import components, empty, odd, odd_rows, prose, words

from themeweave.llm import exact_dedup, hash_arrays, near_dedup, substring_dedup
from themeweave.llm.words import blocks


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups_of_odd_documents(spark):
    groups = defaultdict(list)
    for r in odd_rows():
        groups[normal(r[1])].append(r[0])
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    got = [tuple(r) for r in exact_dedup.exact_groups(odd(spark)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_fingerprints_do_not_depend_on_the_cut(spark):
    docs = odd(spark)
    whole = exact_dedup.fingerprints(docs).drop("doc_id").collect()
    for chunk in (1, 7, 64):
        assert sorted(exact_dedup.fingerprints(docs, chunk).drop("doc_id").collect()) == sorted(whole)
    by_text = {(r["f1"], r["f2"], r["n_bytes"]) for r in whole}
    assert len(by_text) == len({r["text_sha256"] for r in whole})


def test_texts_of_one_fingerprint_are_compared(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "a c"), (4, "x"), (5, "x")], "doc_id long, text string")
    prints = spark.createDataFrame([(i, 7 if i < 4 else 8, 7, 3) for i in range(1, 6)], "doc_id long, f1 long, f2 long, n_bytes long")
    groups = spark.createDataFrame([(7, 7, 3), (8, 7, 3)], "f1 long, f2 long, n_bytes long")
    assert [r["f1"] for r in exact_dedup.unequal(docs, prints, groups, piece=1).collect()] == [7]


def test_dropping_copies_keeps_the_columns(spark):
    docs = odd(spark)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 3, 6, 7, 8, 9, 10, 11, None, 12, 20, 5]))


def shingles(text, k):
    w = words(text, lower=True)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near(rows, k, percent):
    sets = [(d, shingles(t, k)) for d, t in rows]
    edges = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if a is not None and b is not None and both and 100 * both >= percent * (len(x) + len(y) - both):
                edges.append((a, b))
    root = components({d for d, _ in rows if d is not None}, edges)
    return sorted(repr((d, len(s), root.get(d), d == root.get(d))) for d, s in sets)


def edited(text, rng, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.random()}"
    return " ".join(w)


def crowd_rows():
    rng, rows = random.Random(5), []
    bases = [prose(100 + k, 120) for k in range(3)]
    shared = prose(99, 40)  # a passage in many documents that are not alike
    for i in range(150):
        rows.append((i, edited(bases[0], rng, rng.randrange(8))))
    for i in range(150, 190):
        rows.append((i, edited(bases[1 + i % 2], rng, rng.randrange(4))))
    for i in range(190, 260):
        rows.append((i, shared + " " + prose(i, 60)))
    return rows + [(7, prose(300, 30)), (261, prose(300, 30) + " x")]  # id 7 repeats and joins others


@pytest.mark.parametrize(("size", "percent", "small"), [(3, 85, True), (5, 80, True), (3, 85, False)])
def test_near_components_with_a_crowd(spark, monkeypatch, size, percent, small):
    if small:  # nodes branch and families are dealt into blocks
        monkeypatch.setattr(near_dedup, "NODE", 6)
        monkeypatch.setattr(near_dedup, "FAMILY", 700)
    rows = crowd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(repr(tuple(r)) for r in near_dedup.near_duplicates(docs, size, percent).collect())
    assert got == near(rows, size, percent)


@pytest.mark.parametrize("similarity, stated", [(0.8, 1.8e-3), (0.85, 1.4e-4)])
def test_trees_miss_as_rarely_as_stated(similarity, stated):
    rng, missed, n = np.random.default_rng(4), 0, 2_000_000
    for _ in range(20):
        agree = rng.random((n // 20, near_dedup.TOKENS), np.float32) < similarity
        missed += int((~agree[:, near_dedup._CHOICE].all(axis=2).any(axis=1)).sum())
    assert missed / n < 1.2 * stated


def test_near_duplicates_of_odd_documents(spark):
    docs = odd(spark)
    got = sorted(repr(tuple(r)) for r in near_dedup.near_duplicates(docs, 3, 85).collect())
    assert got == near([r[:2] for r in odd_rows()], 3, 85)
    kept = near_dedup.drop_near(docs, 3, 85)
    assert kept.columns == docs.columns and kept.where("doc_id in (2, 6, 11)").count() == 0


def without_repeats(rows, window):
    spelled = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in spelled for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, spelled):
        covered = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((d, len(w), len(covered), " ".join(x for j, x in enumerate(w) if j not in covered)))
    return sorted(map(repr, out))


@pytest.mark.parametrize(("window", "anchor"), [(35, 8), (6, 3), (5, 5)])
def test_repeated_passages_of_odd_documents(spark, window, anchor):
    rows = [r[:2] for r in odd_rows()] + [(30, "one two three four five six " * 9), (31, "a " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(repr(tuple(r)) for r in substring_dedup.without_repeats(docs, window, anchor).collect())
    assert got == without_repeats(rows, window)


def test_automata_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PHRASES", 5)
    monkeypatch.setattr(substring_dedup, "ENTRIES", 20)
    rows = crowd_rows()[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(repr(tuple(r)) for r in substring_dedup.without_repeats(docs, 8, 4).collect())
    assert got == without_repeats(rows, 8)


def test_no_automaton_is_opened_again_for_each_block(spark, monkeypatch):
    """All files are opened once, with 20 automata or more and however many blocks follow."""
    monkeypatch.setattr(substring_dedup, "PHRASES", 20)
    rows = [(i, prose(i % 60, 40)) for i in range(120)]
    docs, held, cleaned = spark.createDataFrame(rows, "doc_id long, text string"), [], substring_dedup._cleaned
    monkeypatch.setattr(substring_dedup, "_cleaned", lambda *given: held.append(given) or cleaned(*given))
    substring_dedup.without_repeats(docs, 8, 4)
    opened, open_folder = Counter(), hash_arrays.open_folder
    monkeypatch.setattr(hash_arrays, "open_folder", lambda path: opened.update([path]) or open_folder(path))
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    run = cleaned(*held[0])
    first = list(run([batch]))
    files = sum(opened.values())
    assert files >= 20 and first[0].column("n_removed").to_pylist() == [40] * 120
    assert all(again.equals(first[0]) for again in run([batch] * 5))
    assert sum(opened.values()) == files


@pytest.mark.parametrize("shards", [1, 7, 60])
def test_automata_locate_all_phrases_and_no_others(spark, shards):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 60, n)) for n in (1, 2, 700, 0, 3, 900)]
    (block,) = blocks(pa.array(texts))
    hashes = block.hashes()
    codes = substring_dedup.word_codes(hashes)
    opening = codes[:-1] << np.uint32(16) | codes[1:]
    some = rng.choice(np.unique(opening), 500, replace=False)
    phrases = spark.createDataFrame([(int(x),) for x in some.view(np.int32)], "opening int").repartition(3)
    opens = substring_dedup._located(block, hashes, substring_dedup.compiled(phrases, shards))
    same = np.diff(block.owner()) == 0  # a phrase lies in one document
    assert opens.tolist() == [*(np.isin(opening, some) & same), False]


def test_empty_tables(spark):
    none = empty(spark)
    assert exact_dedup.exact_groups(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert substring_dedup.without_repeats(none).count() == 0


def test_long_texts_are_hashed_in_little_memory():
    import tracemalloc

    text = (b"some words \t\n and more  words " * 700_000)[: 20 << 20]
    data = np.frombuffer(text, np.uint8)
    offsets = np.array([0, len(data)])
    tables = [exact_dedup.powers(base, exact_dedup.CHUNK) for base in exact_dedup.BASES]
    tracemalloc.start()
    short, ends = exact_dedup.squeeze(data, offsets)
    each, columns = exact_dedup.chunk_hashes(short, ends, exact_dedup.CHUNK, tables)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * len(data) + (64 << 20)
    assert bytes(short[:100_000]) == re.sub(rb"[\x20\x09-\x0D]+", b" ", text)[:100_000] and len(short) == len(re.sub(rb"[\x20\x09-\x0D]+", b" ", text))
    # chunk by chunk, by definition
    for k in (0, 1, int(each[0]) - 1):
        part = short[k * exact_dedup.CHUNK : (k + 1) * exact_dedup.CHUNK].tolist()
        for base, found in zip(exact_dedup.BASES, (columns[0], columns[2])):
            want = 0
            for byte in reversed(part):
                want = (want * base + byte + 1) % exact_dedup.PRIME
            assert found[k] == want
