"""Odd documents that every operator must take, and plain counterparts."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use inside
    "family string, node int, label int, u long, v long, id int, n int, toxic string, kept string, keep_id int, "
    "kept_id int, leaked_id int, score int, held_out string, words int, bits int, h int, place string, code string"
)
_EXTRA = ("x", 1, 2, 3, 4, 5, 6, "y", "z", 7, 8, 9, 10, "w", 11, 12, 13, "p", "q")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    base = prose(1, 60)
    texts = [
        (1, base, "en", "a"),
        (2, base.replace(" ", " \n\t", 5), "en", "a"),  # equal but for separators
        (3, None, "en", "b"),
        (4, "", None, None),
        (5, " \t\n", "de", None),
        (6, base + " end", "en", "b"),
        (7, prose(2, 30_000), "en", "b"),  # very long
        (8, prose(3, 2), "fr", "c"),
        (9, "Ünïcödé – 漢字 кот " + prose(4, 40), "de", "c"),
        (10, prose(5, 40) + " " + base + " " + prose(6, 40), "en", "a"),
        (11, base.upper(), "en", "a"),
        (None, prose(7, 50), "en", "a"),
        (12, "token = 9f86d081884c7d659a2feaa0c55ad015 mail a.b@c.org +1 (555) 123-4567 10.0.0.1 4111 1111 1111 1111", "fr", "a"),
    ]
    texts += [(20, prose(8, 45), "en", "a")] * 2  # a repeated row
    return [(d, t, lang, source, len(t or "")) + _EXTRA for d, t, lang, source in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None, lower: bool = False) -> list[str]:
    return WORD.findall((text or "").translate(LOW) if lower else text or "")


def components(nodes, edges) -> dict:
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
