"""Line dedup's Java against its Python: the same lines, keys, texts and groups, and many pairs in little time."""

import time

import numpy as np
from pyspark.sql import functions as F

from tierstone.llm import bloom, line_dedup
from tierstone.llm import textbytes as tb


def odd_texts():
    rng = np.random.default_rng(6)
    letters = list("aB1 \t\r\n.-é\n 😀日\x0b\x0c")
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(300)]
    words = ["".join(rng.choice(list("etaoin"), rng.integers(1, 9))) for _ in range(90)]
    texts += [" ".join(rng.choice(words, n)) for n in (3, 40, 400, 2000)]
    return texts + ["", None, "---", "\n=\n", "--- ==\t- ", texts[0], texts[-1]]


def test_java_gives_the_lines_keys_and_texts_of_python(spark):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    lines, keys, bodies = [], {}, {}
    for i, text in enumerate(texts):
        body = (text or "").encode()
        _, number, low, high, normal = line_dedup._normal_lines(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
        hashes = tb.SpanHash(np.frombuffer(normal, np.uint8))
        found = hashes.spans(low, high).view(np.int64).tolist()
        for k, h, blocks, a, b in zip(number.tolist(), found, line_dedup._fingerprints(hashes, low, high), low, high, strict=True):
            lines.append((i, k, h))
            bodies[h] = normal[a:b].decode()
            length = int(line_dedup.length_class(np.array([len(bodies[h])]))[0])
            keys[h, length] = {(x >> 32) % 5 << 32 | x & 0xFFFFFFFF for x in blocks.tolist() if x}
    rows = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    assert sorted(tuple(r) for r in line_dedup._lines(rows).drop("row").collect()) == sorted(lines)
    dealt = {}
    for slot, *pack in line_dedup._dealt(docs, 5).collect():
        columns = (np.frombuffer(x, kind).tolist() for x, kind in zip(pack, ("<u4", "<i8", "u1"), strict=True))
        for key, h, length in zip(*columns, strict=True):
            dealt.setdefault((h, length), set()).add(slot << 32 | key)
    assert dealt == keys
    wanted = bloom.build(spark.createDataFrame([(h,) for h in list(bodies)[::2]], "h bigint"))
    through = {h for h in bodies if wanted.might_hold(np.array([h]))[0]}
    found = line_dedup._texts(docs, wanted).collect()
    assert {r.text_hash: r.text for r in found} == {h: bodies[h] for h in through}


def joined(links):
    root = {}
    for pair in links:
        tops = []
        for x in pair:
            while root.setdefault(x, x) != x:
                x = root[x]
            tops.append(x)
        root[max(tops)] = min(tops)
    groups = {}
    for x in root:
        top = x
        while root[top] != top:
            top = root[top]
        groups.setdefault(top, set()).add(x)
    return sorted(map(sorted, groups.values()))


def shards_of(spark, rows):
    return spark.createDataFrame(rows, "lead bigint, text_hash bigint, shards array<bigint>")


def test_java_links_what_is_similar_in_a_shard(spark):
    """Texts around the border of similarity, of all lengths, in shards that overlap, against every pair by itself."""
    rng = np.random.default_rng(9)
    texts = []
    for n in (1, 4, 5, 10, 50, 63, 64, 65, 128, 200, 500, 900):
        line = rng.choice(list("etaoin shrdlu日😀"), n)
        texts.append("".join(line))
        for share in (0.02, 0.1, 0.17, 0.2, 0.22, 0.3):
            other = list(line)
            for at in rng.choice(n, round(share * n), False):
                other[at] = str(rng.choice(["", "q", "zy", "é", "😀", other[at - 1]]))
            moved = int(share * n / 2)
            texts.append("".join(other) if rng.integers(2) else "".join(line[moved:]) + "x" * moved)
    texts = list(dict.fromkeys(t for t in texts if t))
    shards = [(lead, h, sorted({int(s) for s in rng.integers(0, 3, 2)})) for lead in (1, 2, 3) for h in range(len(texts)) if rng.random() < 0.7]
    expected = []
    for lead in (1, 2, 3):
        for name in range(3):
            own = [h for at, h, names in shards if at == lead and name in names]
            expected += [(i, j) for i in own for j in own if i < j and line_dedup.similar(texts[i], texts[j])]
    found = line_dedup._verified(shards_of(spark, shards), spark.createDataFrame(list(enumerate(texts)), "text_hash bigint, text string"))
    links = [tuple(r) for r in found.collect()]
    assert all(line_dedup.similar(texts[a], texts[b]) for a, b in links)
    assert joined(links) == joined(expected)
    assert len(joined(expected)) > 8 and sum(map(len, joined(expected))) < len(texts)


def test_many_far_pairs_cost_little(spark):
    """Half a million pairs of long lines without a link: less than ten times what Python takes for a 25th of them."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("etaoinshr"), rng.integers(1, 6))) for _ in range(80)]
    texts = [" ".join(rng.choice(words, 200)) for _ in range(1000)]
    known = spark.createDataFrame(list(enumerate(texts)), "text_hash bigint, text string").cache()

    def taken(n):
        began = time.perf_counter()
        assert line_dedup._verified(shards_of(spark, [(1, h, [7]) for h in range(n)]), known).collect() == []
        return time.perf_counter() - began

    taken(20)
    began = time.perf_counter()
    assert line_dedup._shard_links(texts[:200], np.arange(200), [list(range(200))]) == []
    by_python = time.perf_counter() - began
    assert taken(1000) < 10 * by_python
    known.unpersist()
