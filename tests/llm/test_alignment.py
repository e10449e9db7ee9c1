"""Cross-tokenizer alignment against the tokenizers themselves, token by token."""

import hashlib
import random
from bisect import bisect_right
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tierstone.llm import cross_tokenizer as ct
from tierstone.llm.fragments import Fragment, Tokens, align, compose, fragment

from .conftest import same_rows

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def a_bytes(a, i):
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
    return bytes(of[c] for c in a.id_to_token(i))


def b_bytes(b, i):
    piece = b.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()


def by_hand(rows, a, b):
    documents, found = Counter(), []
    for _, text in rows:
        full = (" " + (text or "")).encode()
        ids = (a.encode(full.decode(), add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts = [[a_bytes(a, i) for i in ids[0]], [b_bytes(b, i) for i in ids[1]]]
        if not text or any(b"".join(p) != full for p in parts):
            found.append(None)
            continue
        ends = [np.cumsum([len(t) for t in p]).tolist() for p in parts]
        links, i, j = [], 0, 0
        while i < len(ids[0]) and j < len(ids[1]):  # the tokens over each byte, once for each pair
            links.append((ids[0][i], ids[1][j]))
            end = min(ends[0][i], ends[1][j])
            i, j = i + (ends[0][i] == end), j + (ends[1][j] == end)
        groups, last = [], 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            own = [list(map(str, ids[k][bisect_right(ends[k], last) : bisect_right(ends[k], end)])) for k in (0, 1)]
            groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
            last = end
        documents.update(set(links))
        found.append((len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (x, _), n in documents.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (doc_id, _), row in zip(rows, found, strict=True):
        if row is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        counts = [documents[link] for link in row[3]]
        n_best = sum(n == best[x] for n, (x, _) in zip(counts, row[3], strict=True))
        out.append((doc_id, *row[:3], len(counts), n_best, sum(counts), row[4]))
    return out


def odd_texts():
    rng = random.Random(9)
    bits = [
        " ", "  ", "\n", "\t", " \n ", " ", " ", "　", " ", "\u0085", "᠎", "\x00", "\x1c", "a", "the",
        " Word", "é", "Ünder", "中文字", "ñ", "🙂", "👩‍👩‍👧", "é", "ﬁ", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>",
        "'ll", "don't", "123", "½", "...", "#!", "x" * 40, "﻿", "�", "ا", "नमस्ते",
    ]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 30))) for _ in range(160)]
    return texts + ["▁x", "a ▁ b", "", None, " ", "   ", "a" * 3000, "word " * 900, "日本" * 700, " lead", "trail "]


@pytest.mark.parametrize("range_bytes, pairs_at_once", [(1 << 16, 1 << 22), (37, 200), (5, 40)])
def test_odd_texts_against_the_libraries(spark, libraries, range_bytes, pairs_at_once):
    rows = list(enumerate(odd_texts())) + [(3, "repeated id"), (3, "repeated id"), (None, "no id at all")]
    docs = spark.createDataFrame([(i, t, "x", 1, 2.0) for i, t in rows], "doc_id bigint, text string, row string, place int, a double")
    got = ct.report(docs.repartition(3), A_PATH, B_PATH, range_bytes=range_bytes, pairs_at_once=pairs_at_once)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    same_rows(got.collect(), by_hand(rows, *libraries))


def test_documents_of_the_fixture(spark, documents, rows, libraries):
    got = ct.report(documents, A_PATH, B_PATH, range_bytes=500).collect()
    same_rows(got, by_hand([r[:2] for r in rows], *libraries))


def test_no_documents(spark, nothing):
    got = ct.report(nothing, A_PATH, B_PATH)
    assert got.count() == 0 and got.columns[0] == "doc_id"


def random_tokens(rng, n):
    ends = [sorted({*rng.sample(range(1, n), rng.randrange(n // 2)), n}) for _ in range(2)]
    a, b = (np.array(e, np.int64) for e in ends)
    return Tokens(np.array([rng.randrange(90) for _ in a]), a, np.array([rng.randrange(90) for _ in b]), b)


def test_fragments_compose_in_any_order():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randrange(4, 40)
        t = random_tokens(rng, n)
        cuts = sorted({0, n, *rng.sample(range(1, n), rng.randrange(min(n - 1, 9)))})
        parts = []
        for low, high in zip(cuts, cuts[1:], strict=False):
            a, b = ((e > low) & (e <= high) for e in (t.a_ends, t.b_ends))
            parts.append(fragment(Tokens(t.a[a], t.a_ends[a], t.b[b], t.b_ends[b]))[0])
        parts = [Fragment(), *parts]
        while len(parts) > 1:  # any two neighbours first
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [Fragment.unpack(compose(parts[i], parts[i + 1])[0].pack())]
        whole = align(t)
        keys, times = np.unique(whole.links, return_counts=True)
        got = parts[0]
        assert (got.n_a, got.n_b, got.n_groups) == (len(t.a), len(t.b), len(whole.common))
        assert got.keys.tolist() == keys.tolist() and got.times.tolist() == times.tolist()
        assert got.closed and not got.head and not got.tail


def test_text_of_groups_goes_on_over_ranges():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randrange(4, 40)
        t = random_tokens(rng, n)
        open_, text = Fragment(), b""
        cuts = sorted({0, n, *rng.sample(range(1, n), rng.randrange(min(n - 1, 9)))})
        for low, high in zip(cuts, cuts[1:], strict=False):
            a, b = ((e > low) & (e <= high) for e in (t.a_ends, t.b_ends))
            leaf, own = fragment(Tokens(t.a[a], t.a_ends[a], t.b[b], t.b_ends[b]))
            open_, between = compose(open_, leaf)
            text += between + own
        assert text == align(t).text


def test_ranges_cover_a_text_and_its_words():
    rng = random.Random(2)
    for _ in range(100):
        full = np.frombuffer((" " + "".join(rng.choices(["a", " b", "ccc", "\n", "é"], k=60))).encode(), np.uint8)
        found = ct.ranges_of(full, rng.randrange(2, 30))
        assert found[0][0] == 0 and found[-1][1] == len(full)
        assert all(x[1] == y[0] for x, y in zip(found, found[1:], strict=False))
        assert all(begin <= low and high <= end for low, high, begin, end in found)
    assert ct.ranges_of(np.frombuffer(b" " + b"x" * 500, np.uint8), 20) == [(0, 501, 0, 501)]
