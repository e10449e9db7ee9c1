"""Phrase collocations against counts by hand; double-array tries against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tierstone.llm import phrases
from tierstone.llm.double_array import build, digits_for, joined, walk

from .conftest import LOWER, same_rows

PIECE, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def by_hand(rows, min_count, top):
    found, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER)):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for k in range(1, 6):
                found.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in found.items() if a >= min_count and len(p) > 2}
    kept = {}
    for phrase, a in frequent.items():
        inner = " ".join(phrase[1:])
        if any(
            other[0] == phrase[0] and len(other) > len(phrase) and f >= a and f" {inner} " in f" {' '.join(other[1:])} "
            for other, f in frequent.items()
        ):
            continue
        cuts = []
        for k in range(2, len(phrase)):
            left, right = found[phrase[:k]], found[(phrase[0], *phrase[k:])]
            cuts.append((1000 * a * n[phrase[0]] // (left * right), k, left, right))
        kept[phrase] = min(cuts)
    out = []
    for lang in n:
        mine = [(-c[0], -frequent[p], " ".join(p[1:]).encode(), c) for p, c in kept.items() if p[0] == lang]
        for rank, (score, a, phrase, cut) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, cut[2], cut[3], n[lang], -score))
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "x", "é", "É", "a\x00b", "naïve", "中", "-", "#1", " "]
    rows = []
    for _ in range(n):
        text = "".join(
            rng.choice(words) + rng.choice([" "] * 8 + ["  ", "\t", ", ", ".", "!\n", ":", "\x0b"]) for _ in range(rng.randrange(30))
        )
        rows.append((text + rng.choice(["", "New York City Hall", "new york city"]), rng.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [("", "en"), (None, "en"), (None, None), ("one", "zz"), (" . , ", "yy"), ("the of " * 3000, "en")]


@pytest.mark.parametrize(
    "min_count, top, sizes",
    [(100, 2000, {}), (12, 2000, {}), (12, 7, {}), (12, 2000, {"shard_size": 5, "broadcast_bytes": 1}), (9, 50, {"shard_size": 30, "broadcast_bytes": 60_000})],
)
def test_against_counts_by_hand(spark, min_count, top, sizes):
    rows = corpus(min_count)
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "text string, lang string, id int, word string")
    got = phrases.collocations(docs.repartition(3), min_count, top, **sizes)
    assert got.schema.simpleString() == "struct<" + phrases.RESULT.replace(" ", ":").replace(",:", ",") + ">"
    expected = by_hand(rows, min_count, top)
    assert expected
    same_rows(got.collect(), expected)


def test_repeated_rows_and_many_copies(spark):
    rows = [("Over and over again, and over again", "en")] * 300 + [("and over", None)] * 100
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    same_rows(phrases.collocations(docs, 100).collect(), by_hand(rows, 100, 2000))


def test_nothing_to_count(spark):
    for rows in ([], [("a b c", "en")], [(None, None)], [("word. word! word", "en")] * 60 + [("word", "en")] * 60):
        docs = spark.createDataFrame(rows, "text string, lang string")
        assert phrases.collocations(docs, 100).collect() == []


def test_scores_beyond_64_bits_are_exact(spark):
    big = 9_007_199_254_740_993  # no double has this value
    level = [(1, "en", [1], "a", big), (2, "en", [2], "b", big - 2)]
    schema = "id bigint, lang string, words array<int>, phrase string, f bigint"
    one = spark.createDataFrame(level, schema)
    two = spark.createDataFrame([(1, "en", [1, 2], "a b", big - 4)], schema)
    totals = spark.createDataFrame([("en", 3 * big)], "lang string, n bigint")
    row = phrases._scored(two, 2, [one, two], totals).collect()[0]
    assert row.score == 1000 * (big - 4) * 3 * big // (big * (big - 2))


def test_tries_against_a_dictionary():
    rng = random.Random(1)
    for largest, length in ((3, 3), (40, 2), (2000, 4), (1 << 21, 2), (1 << 30, 3)):
        n_digits = digits_for(largest)
        common = [rng.randrange(1, largest + 1) for _ in range(6)]
        pick = lambda: rng.choice(common) if rng.random() < 0.7 else rng.randrange(1, largest + 1)
        known = sorted({tuple(pick() for _ in range(length)) for _ in range(500)})
        halves = known[::2], known[1::2]
        tries = [build(np.array(h), n_digits) for h in halves]
        trie, roots = joined(tries, [0, len(halves[0])])
        number = {p: i for i, p in enumerate([*halves[0], *halves[1]])}
        words = np.array([pick() for _ in range(3000)] + [w for p in known for w in p])
        at = np.arange(len(words) - length + 1)
        for half, root in zip(halves, roots, strict=True):
            ((ids, places),) = walk(trie, np.full(len(at), root), words, at, length, n_digits)
            inside = set(half)
            expected = {i: number[p] for i in at.tolist() if (p := tuple(words[i : i + length].tolist())) in inside}
            assert dict(zip(places.tolist(), ids.tolist(), strict=True)) == expected and expected
