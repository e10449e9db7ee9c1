import random
import re

import pytest

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
#: Further columns, with names that the operators use inside.
EXTRA = "row string, fp string, doc string, size string, epochs string, text_hash string, kept string"


def prose(seed, n, words=None):
    rng = random.Random(seed)
    words = words or ["".join(rng.choices("abcdeéßn", k=rng.randint(2, 7))) for _ in range(400)]
    out = []
    for i in range(n):
        w = rng.choice(words)
        out.append(w.capitalize() if i % 9 == 0 else w)
        if i % 9 == 8:
            out[-1] += rng.choice([".", ".\n"])
    return re.sub(r"\n ", "\n", " ".join(out))


def document_rows():
    """Nulls, empty and long texts, ties, repeated rows, near copies, shared passages."""
    base = prose(1, 120)
    passage = prose(2, 90)
    texts = [prose(10 + i, 30 + 7 * i) for i in range(24)]
    texts += [base, base, base + " more", base.replace("a", "A"), passage + " " + prose(3, 40)]
    texts += [prose(4, 60) + "\n" + passage + "\n" + prose(5, 20), prose(6, 3000), "one two", "", None]
    texts += [" \t\n", "word " * 60, "\n".join(["the same line of five words"] * 12), "| # * $ %" * 9, " nbsp　x é"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[24], (7, "another text with the id seven", "de", "s1", 30)]
    rows += [(None, base, None, "s0", None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return document_rows()


@pytest.fixture(scope="session")
def documents(spark, rows):
    schema = f"doc_id bigint, text string, lang string, source string, n_chars int, {EXTRA}"
    return spark.createDataFrame([(*r, "r", "f", "d", "s", "e", "t", "k") for r in rows], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i < 32), 0) for i in range(39)] + [(None, 1, 0), (500, 1, 0), (3, None, None), (4, 0, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def same_rows(got, expected):
    def key(row):
        return [(v is None, str(v)) for v in row]

    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)
