"""Language identification: held-out accuracy, the hierarchy, and every odd case."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tierstone.llm import lang_id
from tierstone.llm.lang_id import Model, families_of, fit, identify, machine, predict

SOUNDS = {  # two families of two: each pair shares its consonants, not all of its endings
    "aa": ("bdgmn", "aei", ["en", "ie"]),
    "ab": ("bdgmn", "aei", ["el", "ig"]),
    "ka": ("кстпр", "уыо", ["ов", "ый"]),
    "kb": ("кстпр", "уыо", ["ет", "ам"]),
}


def text_of(rng, lang, n):
    consonants, vowels, endings = SOUNDS[lang]
    word = lambda: "".join(rng.choice(consonants) + rng.choice(vowels) for _ in range(rng.randrange(1, 4))) + rng.choice(endings)
    return " ".join(word().capitalize() if rng.random() < 0.1 else word() for _ in range(n))


def labelled(n=240):
    rng = random.Random(6)
    return [(i, text_of(rng, lang, rng.randrange(8, 60)), lang) for i in range(n) for lang in [rng.choice(list(SOUNDS))]]


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(7)
    rows = labelled() + [(900, None, "aa"), (901, "", "aa"), (902, " 12 .,\n\t№ ½ 🙂", "ab"), (903, "中", None)]
    rows += [(904, text_of(rng, "ka", 40_000), None), (905, text_of(rng, "kb", 30), None), (None, text_of(rng, "aa", 40), "aa")]
    rows += [(906, "copied " * 9, "aa")] * 50 + [(7, text_of(rng, "ab", 30), None), (907, "É", None)]
    return rows


@pytest.fixture(scope="module")
def predicted(spark, odd_rows):
    docs = spark.createDataFrame([(*r, "s", 1.0) for r in odd_rows], "doc_id bigint, text string, lang string, __x string, score double")
    got = identify(docs.repartition(4))
    assert got.schema.simpleString() == "struct<doc_id:bigint,held_out:boolean,lang_pred:string,score:double>"
    return got.collect()


def test_held_out_rows_are_told_apart(odd_rows, predicted):
    truth = {r[0]: r[2] for r in labelled()}
    held = [r for r in predicted if r.held_out and r.doc_id in truth and r.doc_id != 7]
    assert len(held) > 30
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97


def test_every_row_has_an_answer(odd_rows, predicted):
    assert len(predicted) == len(odd_rows)
    assert sorted(str(r.doc_id) for r in predicted) == sorted(str(r[0]) for r in odd_rows)
    assert all(0 <= r.score <= 1 for r in predicted)
    by_id = {r.doc_id: r for r in predicted}
    for i in (900, 901, 902):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[903].lang_pred != "und" and by_id[907].lang_pred != "und"
    assert by_id[904].lang_pred == "ka" and by_id[905].lang_pred == "kb"
    for r in predicted:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)


def test_labels_of_held_out_rows_do_not_matter(spark, predicted, odd_rows):
    flipped = [(i, t, "aa" if zlib.crc32(str(i).encode()) % 5 == 0 and i is not None else lang) for i, t, lang in odd_rows]
    docs = spark.createDataFrame(flipped, "doc_id bigint, text string, lang string")
    assert sorted(map(str, identify(docs).collect())) == sorted(map(str, predicted))


def test_families_are_languages_alike(spark):
    rng = random.Random(1)
    rows = [(text_of(rng, lang, 30), lang) for lang in SOUNDS for _ in range(40)]
    train = spark.createDataFrame(rows, "text string, lang string")
    assert fit(train).families == [["aa", "ab"], ["ka", "kb"]]
    given = fit(train, families=[["aa", "ka", "zz"], ["kb"], ["none"]])
    assert given.families == [["aa", "ka"], ["kb"]]
    assert families_of({}) == [] and families_of({"x": np.ones(4)}) == [["x"]]


def test_one_language_and_none(spark):
    docs = spark.createDataFrame([(1, "some words", "xx"), (2, "others", "xx"), (3, "..", "xx"), (5, "more", None)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs).collect()}
    assert got == {1: ("xx", 1.0), 2: ("xx", 1.0), 3: ("und", 0.0), 5: ("xx", 1.0)}
    unknown = identify(docs.withColumn("lang", docs.lang.substr(99, 1)).where("lang IS NULL")).collect()
    assert [(r.lang_pred, r.score) for r in unknown] == [("und", 0.0)] * len(unknown)
    assert identify(docs.limit(0)).count() == 0


def test_a_machine_separates_what_can_be():
    rng = np.random.default_rng(0)

    def vector(first):
        at = np.sort(rng.choice(np.arange(first, first + 50), 20, replace=False)).astype(np.uint16)
        values = np.full(20, 20**-0.5, np.float32)
        return at.tobytes() + values.tobytes()

    vectors = [vector(100 if i % 3 else 120) for i in range(90)]
    signs = np.array([1.0 if i % 3 else -1.0 for i in range(90)])
    weights = machine(vectors, signs)
    found = [weights[at].dot(v) for at, v in map(lang_id._unpack, vectors)]
    assert np.mean(np.sign(found) == signs) > 0.95


def test_blocks_and_pieces_change_nothing(monkeypatch):
    rng = random.Random(3)
    texts = [text_of(rng, rng.choice(list(SOUNDS)), rng.randrange(60)) for _ in range(40)]
    weights = np.random.default_rng(2).normal(size=(lang_id.SLOTS, 2)).astype(np.float32)
    model = Model([["aa", "ab"], ["ka"]], weights, [weights[:, :1], weights[:, :0]])
    whole = model.predict(pa.array(texts))
    monkeypatch.setattr(lang_id, "_BLOCK", 7)
    small = model.predict(pa.array(texts))
    assert whole[0] == small[0] and np.allclose(whole[1], small[1])
    one_by_one = [model.predict(pa.array([t])) for t in texts]
    assert whole[0] == [names[0] for names, _ in one_by_one]
    assert predict.__doc__
