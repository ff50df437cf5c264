"""Repaired conversations, fill-in-the-middle documents and files of token ids."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import WORD, empty, odd, odd_rows
from tokenizers import Tokenizer

from themeweave.llm import conversation_repair as cr
from themeweave.llm import fill_in_middle as fm
from themeweave.llm import token_files as tf

# Conversations

LEGAL = re.compile("(s?(ua)+)?")


def cheapest(rows: list[tuple[str, bool, bool]], inserts: int = 2) -> tuple[int, str, str]:
    """All edits with so many inserted rows at most, by enumeration."""
    best = None
    choices = []
    for initial, faulty, cut in rows:
        kept = [] if faulty else [(5 * cut, "K", initial)] + [(5 * cut + 1, "R", x) for x in "ua"]
        choices.append([(2, "D", ""), *kept])
    for n in range(inserts + 1):
        for gaps in itertools.combinations_with_replacement(range(len(rows) + 1), n):
            for added in itertools.product("ua", repeat=n):
                for picked in itertools.product(*choices):
                    steps = []
                    for k in range(len(rows) + 1):
                        steps += [(5, "I", x) for g, x in zip(gaps, added) if g == k]
                        steps += picked[k : k + 1]
                    roles = "".join(x for _, _, x in steps)
                    if LEGAL.fullmatch(roles):
                        given_ = "".join(x for _, e, x in steps if e in "RI")
                        found = (sum(c for c, _, _ in steps), "".join(e for _, e, _ in steps), given_)
                        best = found if best is None else min(best, found)
    return best


ROWS = st.lists(
    st.tuples(st.sampled_from("suax"), st.sampled_from([False, False, True]), st.sampled_from([False, False, True])), max_size=4
)


@settings(max_examples=120, deadline=None)
@given(ROWS)
def test_repair_equals_enumeration(rows):
    parser = cr.Parser(cr.Grammar(cr.GRAMMAR))
    for row in rows:
        parser.row(*row)
    assert parser.end() == cheapest(rows)


def test_tables_accept_what_the_grammar_does():
    grammar = cr.Grammar(cr.GRAMMAR)
    for n in range(7):
        for roles in itertools.product("sua", repeat=n):
            tops = [0]
            for role in roles:
                tops = [after for top in tops for after in grammar.after(top, role)]
            ends = any(grammar.after(top, cr.Grammar.END) for top in tops)
            assert ends == bool(LEGAL.fullmatch("".join(roles)))
    assert len(grammar.state) < 20  # stacks are few, however long the input


def test_an_ambiguous_grammar_is_followed_on_all_ways():
    # both rules for one user's turn apply, with one symbol to look at
    grammar = cr.Grammar((("talk", ("left", "a", "a")), ("talk", ("right", "a", "u")), ("left", ("u",)), ("right", ("u",))))
    for roles, legal in (("uaa", True), ("uau", True), ("uu", False)):
        tops = [0]
        for role in roles:
            tops = [after for top in tops for after in grammar.after(top, role)]
        assert any(grammar.after(top, "$") for top in tops) == legal


def test_long_audits_are_compared_across_chunks():
    a = b = cr.Audit()
    for k in range(3 * cr.CHUNK):
        a, b = a.then("D"), b.then("K" if k == 1 else "D")
    assert len(a.text()) == 3 * cr.CHUNK and a.before(b) and not b.before(a)


def repaired_plainly(rows):
    """Per conversation what the query gives, without Spark and by another search."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r[:4] for r in rows if r[0] == conv):
            one = lambda x: " " if x is None else str(x)
            kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
            role, text = one(role), one(text)
            if kind:
                text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
                kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            words = WORD.findall(text)
            fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1][-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            faults.append((role[:1], fault < 2, bool(words) and words[-1][-1] not in ".!?"))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))
        # shortest paths over (rows read, state), the state being what the grammar may do next
        ways = {(0, "e"): (0, "", ())}
        moves = {"s": {"e": "s"}, "u": {"e": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}
        for k in range(len(faults) + 1):
            for _ in range(3):
                for state in "esua":
                    if (k, state) in ways:
                        cost, audit, lines = ways[k, state]
                        for x, name in (("u", "user"), ("a", "assistant")):
                            if state in moves[x]:
                                found = (cost + 5, audit + "I", (*lines, f"{name}:"))
                                there = (k, moves[x][state])
                                ways[there] = min(ways.get(there, found), found)
            if k == len(faults):
                break
            (initial, bad, cut), (_, role, text) = faults[k], kept[k]
            for state in "esua":
                if (k, state) in ways:
                    cost, audit, lines = ways[k, state]
                    steps = [(state, cost + 2, "D", lines)]
                    if not bad:
                        if state in moves.get(initial, {}):
                            steps.append((moves[initial][state], cost + 5 * cut, "K", (*lines, f"{role}:{text}")))
                        for x, name in (("u", "user"), ("a", "assistant")):
                            if state in moves[x]:
                                steps.append((moves[x][state], cost + 1 + 5 * cut, "R", (*lines, f"{name}:{text}")))
                    for after, price, letter, said in steps:
                        found = (price, audit + letter, said)
                        ways[k + 1, after] = min(ways.get((k + 1, after), found), found)
        cost, audit, lines = min(ways[len(faults), s] for s in "ea" if (len(faults), s) in ways)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_conversations_with_all_faults(spark):
    rng = random.Random(5)
    texts = ["Well.", "Well.", "so it goes", "é!\n", "", " \t\n", None, "really?", "a. b", "漢字。"]
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randrange(9)):
            role = rng.choice(["system" if turn == 0 else "user", "user", "assistant", "assistant", "tool", None, "", "User"])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None, 0, -3]), role, rng.choice(texts), 1, "x"))
    rows += [(500, 5 * k + 1, ("user", "assistant")[k % 2], f"turn {k}.", 1, "x") for k in range(900)]  # a long one
    rows += [(501, k % 3, "user", "same words.", 1, "x") for k in range(200)]  # repeated rows
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int, code string").repartition(5)
    got = {r["conv_id"]: tuple(r)[1:] for r in cr.digest(docs).collect()}
    assert got == repaired_plainly(rows)


def test_repaired_rows_are_legal_and_ordered(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate([("user", "Hi."), ("user", "What now?"), ("assistant", "No idea."), ("assistant", "No idea.")])]
    made = cr.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    frame = spark.createDataFrame(made)
    out = [tuple(r) for r in cr.repaired(frame, cr.parse(frame)).orderBy("place").collect()]
    assert [p for _, p, _, _ in out] == list(range(len(out)))
    assert LEGAL.fullmatch("".join(r[0] for _, _, r, _ in out))


def test_no_conversations(spark):
    docs = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.digest(docs).collect() == []


# Fill in the middle


def cut_plainly(doc_id, text, rule=fm.Rule()):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    code = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(code[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, s, m = rule.marks
    if not text or any(x in text for x in rule.marks) or h3 % 100 >= rule.percent:
        return n, "plain", None, None, text
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < rule.spm_percent:
        return n, "spm", len(pre), len(mid), f"{s}{suf}{p}{pre}{m}{mid}"
    return n, "psm", len(pre), len(mid), f"{p}{pre}{s}{suf}{m}{mid}"


ANY = st.text(alphabet="abZ <>PSM\n\0é漢😀𝒳ß.", max_size=40)


@settings(max_examples=80, deadline=None)
@given(st.lists(ANY, max_size=6), st.integers(1, 9))
def test_blocks_are_cut_as_whole_texts_are(texts, piece):
    column = pa.array(texts, pa.string())
    old, fm.PIECE = fm.PIECE, piece
    try:
        got = []
        for low, offsets, data in fm.spans(column):
            got += fm._block(pa.array(range(low, low + len(offsets) - 1), pa.int64()), offsets, data, fm.Rule()).to_pylist()
    finally:
        fm.PIECE = old
    assert [tuple(r.values())[1:] for r in got] == [cut_plainly(i, t) for i, t in enumerate(texts)]


@settings(max_examples=60, deadline=None)
@given(ANY)
def test_cuts_go_both_ways(text):
    raw = text.encode()
    index = fm.Exceptions(np.frombuffer(raw, np.uint8))
    assert len(index.at) == sum(ord(c) > 127 for c in text)
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:k].encode()) for k in chars])
    assert (index.bytes(chars) == cuts).all() and (index.chars(cuts) == chars).all()


def test_transform_of_odd_documents(spark):
    rows = [r[:2] for r in odd_rows()] + [(100 + k, f"x <{m}> y") for k, m in enumerate("PSMQ")] + [(200, "漢" * 70_000 + "ab"), (201, "<S"), (202, "P>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = fm.transform(docs)
    got = made.withColumn("back", fm.restored(made["output"], made["form"])).collect()
    assert sorted(repr(tuple(r)[:6]) for r in got) == sorted(repr((d, *cut_plainly(d, t))) for d, t in rows)
    assert sorted(repr((r["doc_id"], r["back"])) for r in got) == sorted(repr((d, t or "")) for d, t in rows)
    again = made.join(docs.dropDuplicates(["doc_id"]), "doc_id")
    assert {(r["doc_id"], r["output"]) for r in fm.recut(again).collect()} == {(r["doc_id"], r["output"]) for r in got if r["doc_id"] is not None}
    assert fm.digest(fm.transform(odd(spark))).count() == len(odd_rows())
    assert fm.transform(empty(spark)).count() == 0


def test_other_marks_and_shares(spark):
    rule = fm.Rule("seed", 50, 70, ("<|a|>", "(b)", "[c]"))
    rows = [(k, f"Some text {k} (b) é" if k % 9 == 0 else f"Some text {k} [é] ß") for k in range(200)]
    made = fm.transform(spark.createDataFrame(rows, "doc_id long, text string"), rule)
    got = made.withColumn("back", fm.restored(made["output"], made["form"], rule)).collect()
    assert {tuple(r)[:6] for r in got} == {(d, *cut_plainly(d, t, rule)) for d, t in rows}
    assert {(r["doc_id"], r["back"]) for r in got} == set(rows)
    with pytest.raises(ValueError):
        fm.Rule(marks=("<P>", "><S>", "<M>"))


# Token ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 5000), st.integers(0, 2**32 - 1))
def test_blocks_of_ids_decode(spread, n, seed):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.geometric(10.0**-spread, n), 2**24 - 1).astype(np.uint32)
    table = tf.Table.of(dict(zip(*(x.tolist() for x in np.unique(ids, return_counts=True)))))
    assert table.shares.sum() == 1 << table.bits and table.shares.min() > 0
    old = tf.LANES, tf.EVERY
    tf.LANES, tf.EVERY = int(rng.integers(1, 64)), int(rng.integers(1, 40))
    try:
        data = tf.encode_block(ids, tf.Table.load(table.dump()))
        assert (tf.decode_block(data, table) == ids).all()
        low, high = sorted(rng.integers(0, n + 1, 2).tolist())
        assert (tf.decode_block(data, table, low, high) == ids[low:high]).all()
        hurt = bytearray(data)
        hurt[int(rng.integers(16, len(data)))] ^= 1
        with pytest.raises(ValueError):
            tf.decode_block(bytes(hurt), table)
    finally:
        tf.LANES, tf.EVERY = old


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.4, 1 << 20), 40_000).astype(np.uint32)
    counts = np.bincount(ids)
    p = counts[counts > 0] / len(ids)
    table = tf.Table.of({i: int(c) for i, c in enumerate(counts) if c})
    bits = 8 * len(tf.encode_block(ids, table)) / len(ids)
    assert bits < -(p * np.log2(p)).sum() + 0.3


TOKENIZER = Tokenizer.from_file(PATH)
TOKEN_TEXTS = st.text(alphabet="abTHEsé ́Åßfi'.,!?-_<|>0١\n\t \0漢😀", max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TOKEN_TEXTS, st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>.", "don't've it's.", "'S'll", "a" * 30, "Ǆx,", "a.́", "x<|startoftext|>Y."])), max_size=5).map(" ".join), st.integers(1, 30))
def test_words_encode_as_texts_do(text, piece):
    texts = [text, "", text[::-1], text + " " + text.upper()]
    column = pa.array(texts, pa.string())
    known = tf.WordIds(TOKENIZER)
    old, tf.PIECE = tf.PIECE, piece
    try:
        (_, offsets, data), *_ = tf.spans(column)
        for _ in range(2):  # the second time words are known
            ids, counts = tf._ids_by_word(known, offsets, data)
            want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
            assert counts.tolist() == [len(w) for w in want]
            assert ids.tolist() == [i for w in want for i in w]
    finally:
        tf.PIECE = old


def test_words_displace_each_other(monkeypatch):
    monkeypatch.setattr(tf, "SLOTS", 16)
    monkeypatch.setattr(tf, "LONG_WORDS", 3)
    rng = random.Random(3)
    known = tf.WordIds(TOKENIZER)
    for _ in range(6):
        text = " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 30))) for _ in range(300))
        (_, offsets, data), *_ = tf.spans(pa.array([text]))
        ids, _ = tf._ids_by_word(known, offsets, data)
        assert ids.tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def expected_files(rows, end_id=1):
    """doc_id -> sorted ids, as there is no order of rows of one doc_id."""
    coded = [(d, [*TOKENIZER.encode(t or "", add_special_tokens=False).ids, end_id]) for d, t in rows]
    return sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0))


@pytest.mark.parametrize("by_word", [True, False])
def test_files_hold_all_documents(spark, monkeypatch, by_word):
    rows = [r[:2] for r in odd_rows()] + [(30 + k, f"Number {k}, it's <|endoftext|> <b>Tom's</b>.") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    files = tf.write_documents(docs, PATH, end_id=1, by_word=by_word)
    got = sorted(tf.read_digests(spark, files).collect(), key=lambda r: r["start"])
    want = expected_files(rows)
    assert [r["doc_id"] for r in got] == [d for d, _ in want]
    starts = np.cumsum([0] + [r["n_tokens"] for r in got]).tolist()
    assert [r["start"] for r in got] == starts[:-1] and files.n_ids == starts[-1] == sum(len(i) for _, i in want)
    code = lambda d, ids: (repr(d), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(code(d, i) for d, i in want)
    # any stretch can be read alone
    texts = {d: i for d, i in want}
    for r in got[3:40:7]:
        assert tf.read_between(files, r["start"], r["start"] + r["n_tokens"]).tolist() == texts[r["doc_id"]]


def test_files_of_an_empty_table(spark):
    files = tf.write_documents(empty(spark), PATH, end_id=1, by_word=True)
    assert files.n_ids == 0 and tf.read_digests(spark, files).count() == 0
    assert tf.read_between(files, 0, 10).tolist() == []


def test_files_with_many_blocks_and_a_wrong_table(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice(["the", "of", "Ünïcödé", f"w{rng.randrange(5000)}"]) for _ in range(40_000 if k == 3 else 400))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    encoded = tf.encode(docs, PATH, 1, True).persist()
    table = tf.count(encoded)
    files = tf.write(encoded, table, str(tmp_path))
    got = {r["doc_id"]: r["ids_crc32"] for r in tf.read_digests(spark, files).collect()}
    assert got == {d: zlib.crc32(np.array(i, "<u4").tobytes()) for d, i in expected_files(rows)}
    other = tf.Table.of({1: 3, 2: 5})
    with pytest.raises(ValueError):
        tf.Reader(str(tmp_path), files.numbers[0], other)
    encoded.unpersist()
