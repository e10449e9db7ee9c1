"""SimHash, suffix-array and line dedup against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tierstone.llm import components, line_dedup, simhash_dedup, suffix_dedup, suffix_spans
from tierstone.llm import textbytes as tb

from .conftest import LOWER, WORD, prose, same_rows


def groups(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_copies(rows):
    fps = [simhash(r[1]) for r in rows]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = groups(len(rows), near)
    least = {}
    for r, g in zip(rows, root, strict=True):
        least[g] = min((x for x in (least.get(g), r[0]) if x is not None), default=None)
    return [(r[0], f"{fp:016x}", least[g]) for r, fp, g in zip(rows, fps, root, strict=True)], root


def test_near_copies(documents, rows):
    same_rows(simhash_dedup.near_copies(documents).collect(), expected_copies(rows)[0])


def test_one_row_of_each_group_stays(documents, rows):
    kept = simhash_dedup.drop_near_copies(documents)
    assert kept.columns == documents.columns
    found, root = expected_copies(rows)
    assert kept.count() == len(set(root))
    same_rows([(r.doc_id,) for r in kept.collect()], {(g, f[2]) for f, g in zip(found, root, strict=True)} and
              [(least,) for least in {g: f[2] for f, g in zip(found, root, strict=True)}.values()])


@pytest.mark.parametrize("tree", [4, 4096])
def test_links_of_dense_and_split_shards(spark, tree):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 4)
    fps = {int(c) ^ sum(1 << int(b) for b in rng.choice(62, rng.integers(0, 4), False)) for c in centres for _ in range(60)}
    fps = sorted(fps)
    found = simhash_dedup.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), tree=tree).collect()
    at = {f: i for i, f in enumerate(fps)}
    assert all((a ^ b).bit_count() <= 64 for a, b in found)
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert groups(len(fps), [(at[a], at[b]) for a, b in found]) == groups(len(fps), near)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (500, 500)] * 2
    found = dict(components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert set(found) == {*range(41), *range(100, 160)}
    assert len({found[i] for i in range(41)}) == 1 and len({found[i] for i in range(100, 160)}) == 1
    assert found[0] != found[100]


def brute_removed(texts, match):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + match] for b in bodies for i in range(len(b) - match + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - match + 1):
            if seen[b[i : i + match]] > 1:
                gone[i : i + match] = b"\1" * match
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        kept = bytes(v for v, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("match", [400, 60])
def test_repeated_bytes(documents, rows, match):
    found = suffix_dedup.removed(documents, match).collect()
    same_rows(found, [(r[0], *x) for r, x in zip(rows, brute_removed([r[1] for r in rows], match), strict=True)])


def test_repeats_across_bucket_boundaries(spark):
    shared = [prose(i, 30) for i in range(3)]
    texts = [prose(50 + i, 12) + shared[i % 3] * (1 + i % 2) + prose(90 + i, 12) for i in range(40)] + ["a" * 900, "ab" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    same_rows(suffix_dedup.removed(docs, 100).collect(), [(i, *x) for i, x in enumerate(brute_removed(texts, 100))])


def test_second_tokens_keep_all_bits(spark):
    """One shared first half, then continuations of which many agree in 32 bits of their fingerprint."""
    match, token = 40, suffix_spans.token_bytes(40)
    rng = np.random.default_rng(9)
    n = 300_000
    tails = rng.integers(97, 123, (n, match - token), dtype=np.uint8)
    bodies = np.hstack([np.full((n, token), 65, np.uint8), tails])
    lasts = tb.SpanHash(bodies[:, -token:].ravel()).windows(token)[::token]
    order = np.argsort(lasts)
    high = lasts[order] >> np.uint64(32)
    close = np.flatnonzero((high[1:] == high[:-1]) & (lasts[order][1:] != lasts[order][:-1]))
    assert len(close) > 2
    texts = [bodies[i].tobytes().decode() for k in close for i in order[k : k + 2]]
    rows = [(t, i, match, [(0, 0, 0, 0)]) for i, t in enumerate(texts)] + [(texts[0], len(texts), match, [(0, 0, 0, 0)])]
    ranges = "array<struct<low int, high int, open_low int, open_high int>>"
    docs = spark.createDataFrame(rows, f"text string, text_hash bigint, text_bytes int, ranges {ranges}")
    found = suffix_dedup.repeated_suffixes(suffix_dedup.leading_tokens(docs, match), len(rows)).collect()
    assert sorted(r.text_hash for r in found) == [0, len(texts)]


def test_multikey_order():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, 5, 500) for _ in range(3)]
    order = suffix_dedup.multikey_order(keys)
    assert [k[order].tolist() for k in keys] == [k[np.lexsort(keys[::-1])].tolist() for k in keys]


def test_sliding_minimum():
    x = np.random.default_rng(2).integers(0, 99, 57).astype(np.uint64)
    for width in (1, 2, 7, 57):
        assert suffix_spans._sliding_minimum(x, width).tolist() == [x[i : i + width].min() for i in range(58 - width)]


def brute_lines(rows):
    first, used = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        for k, line in enumerate((rows[i][1] or "").split("\n")):
            n = line_dedup.normalise(line)
            if n.strip():
                used.append((i, k, n))
    texts = list(dict.fromkeys(n for *_, n in used))

    near = [(i, j) for i in range(len(texts)) for j in range(i) if line_dedup.similar(texts[i], texts[j])]
    root = dict(zip(texts, groups(len(texts), near), strict=True))
    gone = defaultdict(set)
    for i, k, n in used:
        key = (rows[i][0], rows[i][1], k)
        if first.setdefault(root[n], key) != key:
            gone[i].add(k)
    return gone


def test_fuzzy_lines(spark):
    line = "The quick brown fox jumps over 12 lazy dogs, and then it sleeps for a very long time indeed."
    texts = [line, line.upper().replace("12", "99") + "!", "head\n" + line + "\nshort line\nshort line", None, "", "\n\n"]
    texts += [prose(i, 60) for i in range(12)] + [prose(i, 60) + "\n" + line.replace(",", " ;") for i in range(6)]
    rows = [(i, t, f"x{i}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lines string").repartition(3)
    gone = brute_lines(rows)
    kept = ["\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[i]) for i, t in enumerate(texts)]
    expected = [
        (i, len((t or "").split("\n")), len(gone[i]), hashlib.sha256(kept[i].encode()).hexdigest()) for i, t in enumerate(texts)
    ]
    same_rows(line_dedup.report(docs).collect(), expected)
    clean = line_dedup.dedup_lines(docs)
    assert clean.columns == docs.columns
    same_rows(clean.collect(), [(i, kept[i] if texts[i] is not None else None, f"x{i}") for i in range(len(texts))])


def test_fuzzy_lines_of_edge_cases(documents, rows):
    found = line_dedup.report(documents).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in found)) == sorted((r[0] is None, r[0] or 0) for r in rows)
    copies = next(r for r in found if r.doc_id == 36)
    assert (copies.n_lines, copies.n_removed) == (12, 11)


def blocks_of(*lines):
    raw = np.frombuffer("\n".join(lines).encode(), np.uint8)
    *_, low, high, normal = line_dedup._normal_lines(raw, np.array([0, len(raw)]))
    return line_dedup._fingerprints(tb.SpanHash(np.frombuffer(normal, np.uint8)), low, high)


def shared_block_share(n_words, replaced, n=300):
    """Share of lines with words replaced, of edit similarity 0.8 or more, that share a block with their original."""
    rng = np.random.default_rng(n_words)
    found = []
    while len(found) < n:
        words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 9))) for _ in range(n_words + replaced)]
        a, b = words[:n_words], words[:n_words]
        for k, at in enumerate(rng.choice(n_words, replaced, False)):
            b[at] = words[n_words + k]
        if line_dedup.similar(" ".join(a), " ".join(b)):
            one, other = blocks_of(" ".join(a), " ".join(b))
            found.append(((one == other) & (one != 0)).any())
    return np.mean(found)


@pytest.mark.parametrize(("n_words", "replaced"), [(6, 1), (8, 1), (10, 1), (15, 1), (15, 2), (30, 1), (30, 3), (60, 6)])
def test_lines_with_other_words_share_a_block(n_words, replaced):
    assert shared_block_share(n_words, replaced) >= 0.9


def test_fingerprint_bits_are_majorities():
    """Each block by hand: its distinct strings by hash, the least of them vote, ties are zeros."""
    rng = np.random.default_rng(8)
    for n in (1, 3, 20, 400):
        grams = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        grams = np.append(grams, grams[: n // 2])
        bits, sizes = [], []
        for block in range(line_dedup.BLOCKS):
            own = {int(g) % (1 << 48) for g in grams if (int(g) >> 48) * line_dedup.BLOCKS >> 16 == block}
            votes = [int(v) for v in tb.mix(np.array(sorted(own)[: line_dedup.VOTES], np.uint64))]
            bits.append(sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes)))
            sizes.append(len(votes))
        bits = np.array(bits, np.uint64)
        own = tb.mix(bits + np.arange(1, line_dedup.BLOCKS + 1, dtype=np.uint64))
        both = tb.mix(own ^ np.roll(bits, -1))
        expected = [0 if not k else int(o if k >= 3 else p) for k, o, p in zip(sizes, own, both, strict=True)]
        assert line_dedup._blocks(grams, np.zeros(len(grams), np.int64), 1)[0].tolist() == expected


def test_crowded_shards_and_slots_lose_no_link(spark, monkeypatch):
    """The same groups when a slot is settled in many parts and a shard dealt to pairs of parts."""
    base = prose(5, 30).replace("\n", " ")
    texts = [f"{base} {a}{b}" for a in "abcdefgh" for b in "qrstuvwx"] + [prose(100 + i, 20).replace("\n", " ") for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    whole = sorted(line_dedup.report(docs).collect())
    assert sum(r.n_removed for r in whole) == 63
    held = line_dedup._Slot()
    rows = [(k, h) for k in (1, 2, 3) for h in range(50)] + [(9, 1)]
    monkeypatch.setattr(line_dedup, "SLOT_KEYS", 8)
    out = []
    for k, h in rows:
        out += held.add(0, np.array([k], "<u4").tobytes(), np.array([h], "<i8").tobytes())
    out += held.settle(0, True)
    found = defaultdict(set)
    for batch in out:
        for _, shard, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found[shard].add(h)
    assert list(found.values()) == [set(range(50))] * 3
    monkeypatch.setattr(line_dedup, "PART", 16)
    assert sorted(line_dedup.report(docs).collect()) == whole


def test_lines_with_another_word_go(spark):
    line = prose(77, 30).replace("\n", " ")
    other = line.split(" ")
    other[12] = "zzzz"
    docs = spark.createDataFrame([(0, line), (1, " ".join(other))], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.n_removed) for r in line_dedup.report(docs).collect()) == [(0, 0), (1, 1)]


def test_every_line_but_blank_ones_takes_part(spark):
    lines = ["Heading", "- - - - -", "=====", "日本語の段落は空白なしで書かれている。", "two words", " \t", ""]
    docs = spark.createDataFrame([(i, "\n".join(lines)) for i in range(3)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.n_removed) for r in line_dedup.report(docs).collect()) == [(0, 0), (1, 5), (2, 5)]


def test_normal_lines():
    """Rows, numbers and texts of lines as line by line, rulers, runs of white space and empty rows included."""
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("aB1 \t\r\n.-é\n "), rng.integers(0, 40))) for _ in range(400)] + ["", "", "---", "\n=\n"]
    bodies = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, bodies)])
    row, number, low, high, normal = line_dedup._normal_lines(np.frombuffer(b"".join(bodies), np.uint8), offsets)
    found = [(int(r), int(k), normal[a:b].decode()) for r, k, a, b in zip(row, number, low, high, strict=True)]
    lines = [(i, k, line_dedup.normalise(x)) for i, t in enumerate(texts) for k, x in enumerate(t.split("\n"))]
    assert found == [x for x in lines if x[2]]


def test_edit_distance():
    def table(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
            last = now
        return last[-1]

    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abé"), rng.integers(0, 12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == table(a, b)
    verdicts = []
    for _ in range(600):
        words = [prose(int(rng.integers(40)), 1).split(" ")[0][:8] for _ in range(rng.integers(1, 9))]
        a, b = " ".join(words), list(" ".join(words))
        for _ in range(rng.integers(0, 1 + len(b) // 3)):
            b[rng.integers(len(b))] = str(rng.choice(["", "x", "é", " ", "yz"]))
        if rng.integers(2):
            b = [*b[len(b) // 8 :], "z"]
        b = "".join(b)
        verdicts.append(line_dedup.similar(a, b))
        assert verdicts[-1] == (table(a, b) <= (1 - line_dedup.SIMILARITY) * max(len(a), len(b)))
    assert 100 < sum(verdicts) < 500


def test_empty_tables(nothing):
    for found in (
        simhash_dedup.near_copies(nothing), simhash_dedup.drop_near_copies(nothing),
        suffix_dedup.removed(nothing), line_dedup.report(nothing), line_dedup.dedup_lines(nothing),
    ):
        assert found.collect() == []


def test_span_hashes_tell_spans_apart():
    data = np.frombuffer(b"abcabc abc" + bytes(range(256)), np.uint8)
    h = tb.SpanHash(data)
    a = h.spans(np.array([0, 3, 7, 0]), np.array([3, 6, 10, 2]))
    assert a[0] == a[1] == a[2] != a[3]
    assert h.windows(3)[[0, 3, 7]].tolist() == a[:3].tolist()


def test_bound_never_parts_similar_lines():
    """Pieces of the shorter line in their bands: no more than the edit distance, and enough for lines that differ."""
    rng = np.random.default_rng(12)
    texts = []
    for n in (1, 5, 40, 64, 65, 130, 400, 400, 700):
        line = "".join(rng.choice(list("etaoin shrdlu"), n))
        for share in (0, 0.05, 0.15, 0.19, 0.25):
            other = list(line)
            for at in rng.choice(n, int(share * n), False):
                other[at] = str(rng.choice(["", "q", "zy", "日", other[at - 1]]))
            texts.append("".join(other) if rng.integers(2) else "".join(other)[n // 10 :] or "x")
    sizes = np.array([len(t) for t in texts])
    codes = (np.array([ord(c) for t in texts for c in t]) % line_dedup.LETTERS).astype(np.uint8)
    one, other = (x.ravel() for x in np.indices((len(texts), len(texts))))
    unlike = line_dedup._unlike(codes, np.cumsum(sizes) - sizes, sizes, one, other)
    alike = np.array([line_dedup.similar(texts[i], texts[j]) for i, j in zip(one, other, strict=True)])
    assert not (unlike & alike).any()
    assert alike.sum() > 2 * len(texts) and unlike.sum() > 0.9 * (~alike).sum()
    for i, j in zip(one[::7], other[::7], strict=True):
        exact = line_dedup.edit_distance(texts[i], texts[j])
        assert exact <= line_dedup._edits_found(texts[i], texts[j], len(texts[i]) + len(texts[j]))


def test_shards_are_parted_by_length():
    """Lengths that leave a gap part a shard; lengths of lines that can be similar never do."""
    n = np.arange(1, 30_000)
    apart = line_dedup.length_class(n).astype(int) - line_dedup.length_class(np.ceil(n * line_dedup.SIMILARITY - 1e-9))
    assert apart.max() <= line_dedup.CLASSES
    held = line_dedup._Slot()
    classes = np.array([50, 10, 52, 12, 90, 200], "u1")
    list(held.add(0, np.full(6, 7, "<u4").tobytes(), np.arange(6, dtype="<i8").tobytes(), classes.tobytes()))
    (batch,) = held.settle(0, True)
    found = defaultdict(set)
    for _, shard, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        found[shard].add(h)
    assert sorted(map(sorted, found.values())) == [[0, 2], [1, 3]]


def test_far_lines_are_not_measured(spark, monkeypatch):
    """Long lines that only share passages are parted by their bound, without their distance."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("etaoinshr"), rng.integers(1, 6))) for _ in range(60)]
    texts = [" ".join(rng.choice(words, 150)) for _ in range(40)]
    monkeypatch.setattr(line_dedup, "similar", lambda a, b: pytest.fail("measured"))
    assert line_dedup._shard_links(texts, np.arange(40), [list(range(40))]) == []
