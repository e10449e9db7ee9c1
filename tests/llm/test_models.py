"""Quality rules, classifier, language model, mixing and decontamination."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tierstone.llm import (
    decontaminate,
    labelled,
    lm_scoring,
    maxent,
    mixing,
    quality_classifier,
    quality_rules,
)

from .conftest import LOWER, WORD, prose, same_rows


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered, lines, dup = set(), set(), 0
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_rule_statistics(documents, rows, labels):
    forest = quality_rules.fit(documents, labels)
    found = quality_rules.rate(documents, forest).collect()
    expected = []
    for r in rows:
        c = rule_counts(r[1])
        expected.append((r[0], *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    same_rows([tuple(r)[:7] for r in found], expected)
    assert all(not (r.base_failed and r.kept) for r in found)
    kept = quality_rules.filter_quality(documents, forest)
    assert kept.columns == documents.columns
    same_rows([(r.doc_id,) for r in kept.collect()], [(r.doc_id,) for r in found if r.kept])


def test_pieces_do_not_change_statistics(rows):
    import pyarrow as pa

    column = pa.array([r[1] for r in rows])
    whole = labelled.statistics(column)
    alone = np.concatenate([labelled.statistics(column.slice(i, 1)) for i in range(len(column))])
    assert (whole == alone).all()


def test_rules_without_labels(documents, labels, rows):
    forest = quality_rules.fit(documents, labels.limit(0))
    assert forest is None
    found = quality_rules.rate(documents, forest).collect()
    assert all(r.kept == (not r.base_failed) for r in found) and len(found) == len(rows)


def test_a_labelled_id_of_many_rows_is_bounded(spark):
    rows = [(1, prose(n, 12 + n % 50)) for n in range(700)] + [(k, prose(k, 30)) for k in range(2, 60)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 3 and 1) for k in range(1, 60)], "doc_id bigint, quality int")
    forest = quality_rules.fit(docs, labels, sample=100)
    assert forest.rows <= 100
    again = quality_rules.fit(docs.repartition(3), labels, sample=100)
    assert all((a == b).all() for a, b in zip(forest.cut, again.cut, strict=True))
    # Repeated rows change nothing.
    once = quality_rules.fit(docs.distinct(), labels, sample=100)
    assert all((a == b).all() for a, b in zip(forest.cut, once.cut, strict=True))


def test_forest_and_threshold_count_all_labelled_rows(spark):
    rows = [(n, prose(n, 12 + n % 60)) for n in range(900)]
    rows += [(n, " ".join(f"#{n}%{i}&" for i in range(30 + n % 9))) for n in range(900, 960)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    marks = [(n, int(n < 900 and n % 90 > 0)) for n in range(960)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    forest = quality_rules.fit(docs, labels, sample=32)
    stats = labelled.statistics(pa.array([text for _, text in rows]))
    usual = ~quality_rules.base_failed(stats)
    x, good = quality_rules.rule_features(stats)[usual], np.array([m for _, m in marks])[usual] == 1
    full = np.arange(33)
    for feature, left, depth, node in zip(forest.feature, forest.left, forest.depth, forest.leaves(x), strict=True):
        level = {0: 0}
        for k in np.flatnonzero(feature >= 0):
            level[left[k]] = level[left[k] + 1] = level[k] + 1
        for k, count in Counter(node.tolist()).items():
            expected = np.interp(count * 32 / len(x), full, quality_rules.mean_path(full))
            assert depth[k] == pytest.approx(level[k] + expected)
    scores = np.floor(forest.score(x) * quality_rules.LEVELS) / quality_rules.LEVELS
    assert forest.threshold == quality_rules.calibrate(scores, good) < 1
    rejected = scores >= forest.threshold
    assert (rejected & good).sum() <= 0.01 * good.sum() and (rejected & ~good).sum() >= 50


def test_isolation_forest():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (600, 4)), rng.normal(9, 1, (30, 4))])
    forest = quality_rules.grow_forest(x)
    s = forest.score(x)
    assert s[600:].min() > np.quantile(s[:600], 0.95)
    again = quality_rules.grow_forest(x)
    assert (again.score(x) == s).all()
    # Paths by walking each tree, against the vectorised ones.
    for row in (0, 605):
        total = 0.0
        for feature, cut, left, depth in zip(forest.feature, forest.cut, forest.left, forest.depth, strict=True):
            node = 0
            while feature[node] >= 0:
                node = left[node] + (x[row, feature[node]] >= cut[node])
            total += depth[node]
        assert s[row] == pytest.approx(2 ** (-total / len(forest.feature) / quality_rules.mean_path(forest.rows)))
    threshold = quality_rules.calibrate(s, np.arange(630) < 600)
    assert (s[600:] >= threshold).mean() > 0.9 and (s[:600] >= threshold).mean() <= quality_rules.MAX_LOSS
    assert quality_rules.calibrate(s, np.ones(630, bool)) == np.inf


def test_isotonic():
    levels = quality_classifier.isotonic(np.array([1.0, 3, 2, 2, 5, 4]), np.array([1.0, 1, 1, 2, 1, 1]))
    assert levels.tolist() == pytest.approx([1, 2.25, 2.25, 2.25, 4.5, 4.5])


def test_classifier(spark):
    good = [(i, prose(i, 60 + i % 40), f"x{i}") for i in range(300)]
    bad = [(300 + i, " | ".join(prose(i, 40).upper().split()) + " $$$", "y") for i in range(150)]
    more = [(1000, None, "z"), (1001, "", "z"), (None, "some text", "z"), (1002, "x " * 50_000, "z"), good[1]]
    docs = spark.createDataFrame(good + bad + more, "doc_id bigint, text string, score string").repartition(4)
    labels = spark.createDataFrame(
        [(i, int(i < 300), 0) for i in range(450) if i % 7] + [(None, 1, 0), (2000, 0, 0), (5, None, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    found = quality_classifier.classify(docs, labels).collect()
    assert len(found) == 455
    for r in found:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 450]
    assert np.mean([r.predicted == (r.doc_id < 300) for r in held]) > 0.95
    assert len({r.score for r in found if r.doc_id == 1}) == 1


def test_classifier_without_labels(documents, labels, rows):
    found = quality_classifier.classify(documents, labels.limit(0)).collect()
    assert len(found) == len(rows) and {r.score for r in found} == {0.5}


def base_scores(rows):
    tokens = [WORD.findall((r[1] or "").translate(LOWER)) + [None] for r in rows]
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 1 for r in rows]
    counts = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in ts)
    n, v = sum(counts.values()), len(counts)
    total = math.log10(n + 0.5 * (v + 1))
    return [
        (r[0], h, len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10(counts[t] + 0.5) - total for t in ts))
        for r, h, ts in zip(rows, held, tokens, strict=True)
    ]


@pytest.mark.parametrize("known", [20, 1 << 18])
def test_language_model(documents, rows, known):
    found = lm_scoring.score(documents, known=known).collect()
    expected = base_scores(rows)

    def rounded(row):
        return (*row[:5], round(row[5], 6))

    same_rows([rounded(r) for r in found], [rounded(r) for r in expected])
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    same = [r.score for r in found if r.doc_id == 3]
    assert len(same) == 3 and max(same) - min(same) < 1e-9


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(5)
    n = 1200
    hashes = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64))
    counts = np.sort(rng.integers(1, 999, n))[::-1].copy()
    rank = rng.permutation(n)
    words = maxent.Vocabulary(hashes, rank, counts[rank], int(counts.sum()) + 50, n + 20)
    weights = maxent.Weights(
        rng.normal(0, 0.5, (maxent.FEATURES * maxent.BUCKETS, maxent.CLASSES)).astype(np.float32),
        rng.normal(0, 0.5, (maxent.FEATURES * maxent.BUCKETS, maxent.HEAD_WIDTH)).astype(np.float32),
    )
    history = maxent.features(hashes[:4], np.zeros(4, int))[:, 3:]
    ranks = np.append(np.arange(n), -1)
    step = maxent.Step(words, weights, ranks, np.repeat(history, n + 1, axis=1))
    p = np.exp(step.log_probability(words, ranks))
    assert p[:-1].sum() + p[-1] * words.rest == pytest.approx(1, abs=1e-4)


def test_words_three_back_and_late_ranks_have_a_say():
    """The model keeps its four features and wide head: a word that only the one three back tells, of rank 900."""
    assert (maxent.FEATURES, maxent.HEAD_CLASSES, maxent.MIDDLE, maxent.BATCH) == (4, 31, 16, 8192)
    rng = np.random.default_rng(8)
    n = 1000
    hashes = np.sort(rng.integers(2, 1 << 63, n).astype(np.uint64))
    words = maxent.Vocabulary(hashes, np.arange(n), np.arange(n, 0, -1), n * (n + 1) // 2, n)
    assert words.class_of_rank[991] < maxent.HEAD_CLASSES
    picks = rng.integers(0, 2, 12_000)
    rank = np.stack([picks, *rng.integers(2, 6, (2, len(picks))), 900 + picks], axis=1).ravel()
    found, weights = maxent.features(hashes[rank], np.repeat(np.arange(len(picks)), 4)), maxent.Weights.zeros()
    squares = [np.zeros(t.T.shape, np.float32) for t in (weights.classes, weights.words)]
    touched = [np.zeros(len(weights.classes)), np.zeros(len(weights.words))]
    for low in range(0, len(rank), 1000):
        maxent.Step(words, weights, rank[low : low + 1000], found[:, low : low + 1000]).descend(squares, touched)
    logs = maxent.Step(words, weights, rank[-4000:], found[:, -4000:]).log_probability(words, rank[-4000:])
    assert logs[3::4].mean() > 0.5 * math.log(0.5)


def test_words_are_found_and_slots_move_as_by_hand():
    rng = np.random.default_rng(4)
    hashes = np.sort(np.concatenate([
        rng.integers(1, 1 << 63, 500).astype(np.uint64) * np.uint64(2), np.uint64(77 << 48) + np.arange(40, dtype=np.uint64),
        np.array([1, (1 << 64) - 1], np.uint64),
    ]))
    n = len(hashes)
    words = maxent.Vocabulary(hashes, rng.permutation(n), np.arange(n, 0, -1), n * n, n)
    asked = np.concatenate([hashes, hashes + np.uint64(1), hashes - np.uint64(1), np.array([0, 5 << 48], np.uint64)])
    by_hand = dict(zip(hashes.tolist(), words.rank.tolist(), strict=True))
    assert words.find(asked).tolist() == [by_hand.get(h, -1) for h in asked.tolist()]

    table = rng.normal(size=(maxent.FEATURES * maxent.BUCKETS, 5)).astype(np.float32)
    squares, touched = rng.random(table.shape).astype(np.float32), np.zeros(len(table))
    slots = rng.integers(0, 9, (maxent.FEATURES, 300)) + np.arange(maxent.FEATURES)[:, None] * maxent.BUCKETS
    g = rng.normal(size=(300, 5)).astype(np.float32)
    moved, past = table.copy(), squares.copy()
    maxent._apply(moved, past, slots, g, touched)
    for slot in [f * maxent.BUCKETS + k for f in range(maxent.FEATURES) for k in (*range(12), maxent.BUCKETS - 1)]:
        met = np.flatnonzero((slots == slot).any(0)) if slot % maxent.BUCKETS < 9 else []
        total = g[met].sum(0, dtype=float)
        assert touched[slot] == len(met) and past[slot] == pytest.approx(squares[slot] + total**2, rel=1e-4)
        assert moved[slot] == pytest.approx(table[slot] - maxent.RATE * total / np.sqrt(past[slot] + 1), abs=1e-4)
        if not len(met):
            assert (moved[slot] == table[slot]).all()


def test_training_beats_the_base(spark):
    a, b = ["the cat", "sat on"], ["le chien", "dort sur"]
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice(a if i % 2 else b, 80))) for i in range(400)]
    found = lm_scoring.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mixing(documents, rows):
    found = mixing.plan_mix(documents).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    target = brute_targets(sizes)
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    same_rows(
        [(r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in found],
        [(r[0], n, sizes[r[3]], round(target[r[3]], 6)) for r, n in zip(rows, size, strict=True)],
    )
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    largest = max(size)
    for s, t in target.items():
        taken = sum(r.taken for r in found if round(r.target, 6) == round(t, 6) and r.source_size == sizes[s])
        assert abs(taken - t * len([1 for x in target if round(target[x], 6) == round(t, 6) and sizes[x] == sizes[s]])) <= largest
    again = mixing.plan_mix(documents.repartition(5)).collect()
    same_rows([tuple(r) for r in again], [tuple(r) for r in found])
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    copies = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    plan = Counter()
    for r in found:
        plan[r.doc_id] += r.epochs
    by_id = Counter()
    for (doc_id, *_), n in copies.items():
        by_id[doc_id] += n
    assert +plan == by_id


def test_fill_up_to_caps(spark):
    sizes = {"a": 5, "b": 1000, "c": 0, "d": 40, "é": 7, None: 300}
    rows = [(s, n, 1) for s, n in sizes.items()]
    found = mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint, n_docs bigint")).collect()
    expected = brute_targets(sizes)
    assert {r.source: round(r.target, 6) for r in found} == {s: round(t, 6) for s, t in expected.items()}


ITEMS = [
    (1, "If Anna buys 12 apples and Ben buys 7 pears how much fruit do Anna and Ben carry home together"),
    (2, "The quick question of the day asks for the sum of all of these numbers"),
    (3, "five words make one item"),
    (4, "too short"),
    (5, None),
    (6, "A road of 12 km takes 3 hours on foot so how long is it"),
]


def test_decontamination(spark):
    texts = {
        1: prose(1, 50) + " If Anna buys 12 apples and Ben buys 7 pears how much fruit " + prose(2, 20),
        2: "x. If Maria buys 99 apples and Tom buys 5 pears how much fruit do Maria and Tom carry home together",
        3: "x. If Maria buys 99 apples and Maria buys nothing more than that",
        4: "THE QUICK QUESTION, of the day - asks for the sum!",
        5: prose(3, 200),
        6: "some five words make one item here",
        7: "too short",
        8: "Today a road of 5 miles takes 1 day on foot so how",
        9: None, 10: "",
    }
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = spark.createDataFrame([(i, t, "w") for i, t in texts.items()] + [(1, texts[1], "w"), (None, texts[4], "w")],
                                 "doc_id bigint, text string, windows string").repartition(3)
    found = decontaminate.report(docs, benchmark).collect()
    hit = {r.doc_id: r.item_id for r in found if r.contaminated}
    assert hit == {1: 1, 2: 1, 4: 2, 6: 3, 8: 6, None: 2}
    assert len(found) == 12 and all((r.windows > 0) == r.contaminated for r in found)
    assert len({r.windows for r in found if r.doc_id == 1}) == 1
    clean = decontaminate.clean(docs, benchmark)
    assert clean.columns == docs.columns
    same_rows([(r.doc_id,) for r in clean.collect()], [(i,) for i in (3, 5, 7, 9, 10)])
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == 12


NAMES = "Anna Ben Carla Dmitri Elena Farid Greta Hugo Ines Jonas Kemal Laura".split()
UNIT_WORDS = "km miles kg hours days litres".split()


def question(rng):
    """A question as words, with its slots as ``(type, number of the variable)``; names open sentences too."""
    words = []
    for sentence in range(int(rng.integers(1, 4))):
        if rng.random() < 0.6 or not sentence:
            words.append(("name", int(rng.integers(2))))
        else:
            words.append("Then")
        for _ in range(int(rng.integers(6, 14))):
            kind = rng.random()
            if kind < 0.08:
                words.append(("name", int(rng.integers(3))))
            elif kind < 0.16:
                words += [("number", int(rng.integers(3))), ("unit", 0)]
            else:
                words.append("".join(rng.choice(list("abcdeiou"), int(rng.integers(2, 7)))))
        words.append("ends.")
    return words


def filled(words, rng):
    """The question with values drawn for its variables, other ones for each of them."""
    values = {
        "name": rng.permutation(NAMES), "unit": rng.permutation(UNIT_WORDS),
        "number": rng.permutation(np.arange(2, 900))[:9].astype(str),
    }
    return " ".join(w if isinstance(w, str) else str(values[w[0]][w[1]]) for w in words)


def readings(text, which):
    """Words as ``(token, value of the slot)``, by loops over words instead of patterns over text."""
    words, out = re.split("[ \t-\r]", text or ""), []
    for i, word in enumerate(words):
        inside = word.lstrip("\"'(")
        capital = len(inside) > 1 and inside[0].isupper() and inside[1].islower() and len(word) - len(inside) <= 3
        opens = i == 0 or not words[i - 1] or words[i - 1][-1] in ".!?:"
        bare = re.sub("[^\\w]|_", "", word.lower())
        value = inside.lower().rstrip(".,;:!?\"')(")
        if capital and (which == "all" or which == "inner" and not opens and inside == word):
            out.append(("<name>", value))
        elif any(c.isdigit() for c in word):
            out.append(("<number>", value))
        elif out and out[-1][0] == "<number>" and re.match(rf"({'|'.join(decontaminate.UNITS)})(\W|$)", word.lower()):
            out.append(("<unit>", value))
        elif bare:
            out.append((bare, None))
    return out


def substitutes(a, b):
    """Whether two windows are one but for their values, and those map onto each other."""
    if [t for t, _ in a] != [t for t, _ in b]:
        return False
    slots = [((t, x), (t, y)) for (t, x), (_, y) in zip(a, b, strict=True) if x is not None]
    if 2 * len(slots) > len(a) and any(x != y for x, y in slots):
        return False
    return len({x for x, _ in slots}) == len({y for _, y in slots}) == len(set(slots))


def matches(doc, items):
    tokens = readings(doc, "all")
    for item in items:
        for which in ("all", "inner", "none"):
            known = readings(item, which)
            n = min(len(known), decontaminate.WINDOW)
            if n < decontaminate.MIN_TOKENS:
                continue
            for j in range(len(known) - n + 1):
                if any(substitutes(known[j : j + n], tokens[i : i + n]) for i in range(len(tokens) - n + 1)):
                    return True
    return False


def test_names_that_open_sentences_and_copies_in_other_case(spark):
    items = ["Tom has 12 apples and pears. Tom eats 3 of them daily. How many are left?", "What is the capital of France?"]
    texts = {
        1: "x. Anna has 40 apples and pears. Anna eats 7 of them daily. How many are left?",
        2: "so (2) What is the capital of France? " + prose(5, 20),
        3: "we ask what is the capital of france? " + prose(6, 20),
        4: "WHAT IS THE CAPITAL OF FRANCE?",
        5: "then (\"What is the\ncapital of France\")",
        6: "Anna has 40 plums and pears. Ben eats 7 of those daily. How few were left?",
        7: "what is the capital in france?",
        8: prose(7, 200),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    hit = {r.doc_id: r.item_id for r in decontaminate.report(docs, benchmark).collect() if r.contaminated}
    assert hit == {1: 0, 2: 1, 3: 1, 4: 1, 5: 1}


def test_reparameterised_questions_are_found_and_others_left(spark):
    rng = np.random.default_rng(8)
    asked = [question(rng) for _ in range(320)]
    items = [filled(q, rng) for q in asked]
    others = [filled(question(rng), rng) for _ in range(300)]
    forms = [str, str.lower, str.upper, lambda t: "(3) " + t, lambda t: t.replace(" ", "\n", 3)]
    texts, planted = [], set()
    for n, q in enumerate(asked):
        text = filled(q, rng) if n % 2 else items[n]
        form = forms[n % len(forms)] if n % 2 == 0 else forms[n // 2 % 2 * 3]
        texts.append(f"{prose(n, 15)}. {form(text)} {prose(n + 1, 15)}")
        planted.add(n)
    texts += [f"{prose(n, 10)}. {t}" for n, t in enumerate(others)]
    texts += [None, "", prose(900, 60_000) + " " + items[0]]
    planted.add(len(texts) - 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    hit = {r.doc_id for r in decontaminate.report(docs, benchmark).collect() if r.contaminated}
    clean = set(range(len(texts))) - planted
    print("recall", len(hit & planted) / len(planted), "clean text hit", len(hit & clean) / len(clean))
    assert len(hit & planted) >= 0.9 * len(planted)
    assert len(hit & clean) <= 0.01 * len(clean)
    some = [*range(0, 320, 8), *range(320, 400, 8)]
    assert [n in hit for n in some] == [matches(texts[n], items) for n in some]


def test_native_plans_have_no_python(documents, spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for df in (mixing.plan_mix(documents), mixing.mix(documents), decontaminate.clean(documents, benchmark)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_empty_tables(nothing, labels, spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for found in (
        quality_rules.rate(nothing, quality_rules.fit(nothing, labels)), quality_classifier.classify(nothing, labels),
        lm_scoring.score(nothing), mixing.plan_mix(nothing), mixing.mix(nothing),
        decontaminate.report(nothing, benchmark), decontaminate.clean(nothing, benchmark),
    ):
        assert found.collect() == []
