"""Token files, archives and the pipeline: round trips and edge cases."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from tierstone.llm import huffman, quality_rules, token_ids, warc
from tierstone.session import shared_scratch

from .conftest import same_rows
from .test_dedup import expected_copies
from .test_models import brute_targets

PATH = public_tokenizers.path("byte_bpe_50k.json")


def tokenizer():
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    return plain


HARD = [
    "a  b", "a   b", " a", " ", "  ", "a ", " \n b", "a \n\n  b\t c", "　 z \x1c q", "don't  we'll 12 34", "a\n b",
    "a \nb", "<|endoftext|> x", "é  è", "", "\x85 x", "a\x1c b \x1c c", "x  y", "tab\t\tx", "日本語 テキスト 🙂🙂", "a" * 5000,
]


def test_pieces_encode_as_whole_texts_do(rows):
    texts = HARD + [r[1] or "" for r in rows]
    ids, sizes = token_ids.PieceEncoder(PATH).encode(texts)
    expected = [tokenizer().encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_literal_added_tokens_get_their_ids(spark):
    plain = Tokenizer.from_file(PATH)
    texts = HARD + ["a <|endoftext|> x", "<|endoftext|>", "a<|endoftext|>  b<|endoftext|><|endoftext|>\n", "<|endoftext"]
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    ids, sizes = token_ids.PieceEncoder(PATH, added_tokens=True).encode(texts)
    assert sizes.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]
    found = token_ids.store(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), PATH).collect()
    coded = [np.array([*e, token_ids.END_ID], "<u4") for e in expected]
    same_rows([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found],
              [(i, len(e), zlib.crc32(e.tobytes())) for i, e in enumerate(coded)])


def test_forgetting_changes_nothing(rows, monkeypatch):
    texts = HARD + [r[1] or "" for r in rows]
    expected = token_ids.PieceEncoder(PATH).encode(texts)[0]
    monkeypatch.setattr(token_ids, "REMEMBERED", 5)
    assert token_ids.PieceEncoder(PATH).encode(texts)[0].tolist() == expected.tolist()


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    ids, sizes = token_ids.PieceEncoder(path).encode(["Two  words", "", "x"])
    assert ids.tolist() == [i for t in ("Two  words", "", "x") for i in plain.encode(t, add_special_tokens=False).ids]
    assert sizes.sum() == len(ids)


@pytest.mark.parametrize("seed", range(6))
def test_huffman_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = [1, 2, 300, 5000, 50257, 40][seed]
    weights = 1 / np.arange(1, n + 1) ** (3 if seed == 5 else 1.1)
    ids = rng.choice(n, 30_000, p=weights / weights.sum())
    counts = np.bincount(ids, minlength=n)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= huffman.MAX_BITS and ((lengths > 0) == (counts > 0)).all()
    assert (2.0 ** -lengths[lengths > 0]).sum() <= 1
    codec = huffman.Codec(lengths)
    sizes = np.array([0, 1, 255, 256, 257, 512, 513, 9000, 0, len(ids) - 10_794])
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    blocks = codec.encode(ids, sizes)
    for got, expected in zip(codec.decode(blocks), parts, strict=True):
        assert got.tolist() == expected.tolist()
    if n > 2:
        p = counts[counts > 0] / counts.sum()
        assert (counts * lengths).sum() / counts.sum() < -(p * np.log2(p)).sum() + 1


def test_codes_longer_than_the_limit():
    counts = np.array([int(1.7**i) + 1 for i in range(40)])
    lengths = huffman.code_lengths(counts)
    assert lengths.max() == huffman.MAX_BITS and (2.0 ** -lengths).sum() <= 1


def expected_tokens(rows):
    plain, start, out = tokenizer(), 0, []
    coded = [(r[0], [*plain.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in rows]
    for doc_id, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]))):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [1 << 20, 200])
def test_token_files(documents, rows, monkeypatch, file_ids):
    monkeypatch.setattr(token_ids, "FILE_IDS", file_ids)
    same_rows(token_ids.store(documents, PATH).collect(), expected_tokens(rows))


def test_token_files_of_nothing(nothing):
    assert token_ids.store(nothing, PATH).collect() == []


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_archives(spark):
    copies = "<html>" + "x" * 50 + "</html>"
    rows = [(i, f"http://h/{i}", f"<p>{i} {'é' * i}</p>", "w") for i in range(200)]
    rows += [(300 + i, "http://h/c", copies, "w") for i in range(50)] + [(400, None, None, "w"), (401, "a\r\nb: c", "", "w")]
    rows += [(500, "u", "\r\n\r\nWARC/1.1\r\n\r\n", None), (501, "u", "long " * 300_000, None), (None, "u", copies, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string").repartition(3)
    found = warc.archive(pages).collect()
    last = {}
    for page_id, _, html, _ in rows:
        if page_id is not None:
            last[html or ""] = max(last.get(html or "", -1), page_id)
    expected = []
    for page_id, _, html, _ in rows:
        to = None if page_id == last[html or ""] else last[html or ""]
        expected.append((page_id, len((html or "").encode()), digest(html), "response" if to is None else "revisit", to))
    same_rows(found, expected)
    few = warc.archive(pages, min_bytes=20).collect()
    assert {r.record_type for r in few if r.page_id in (400, 401)} == {"response"}


def test_archive_layout(spark):
    rows = [(i, "http://h/" + str(i), "<html><body>" + "common words " * 30 + str(i) + "</body></html>") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    folder = shared_scratch(spark, "archive_test")
    (manifest,) = warc.write_archives(pages, folder).collect()
    assert manifest.records == 300
    with warc.open_file(manifest.path) as stream:
        body = stream.read()
    magic, size = np.frombuffer(body[:8], "<u4")
    assert magic == warc.DICTIONARY_FRAME
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(body[8 : 8 + size]))
    at, n = 8 + int(size), 0
    while at < len(body):
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        text = one.decompress(body[at:])
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        at, n = len(body) - len(one.unused_data), n + 1
    assert n == 300 and len(body) < sum(len(r[2]) for r in rows) / 2


def test_several_archives_in_a_task(spark):
    rows = [(i, "u", f"page {i} " * 40) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    manifest = warc.write_archives(pages, shared_scratch(spark, "archives"), archive_bytes=5000)
    path = shared_scratch(spark, "manifest")
    manifest.write.parquet(path)
    manifest = spark.read.parquet(path)
    assert manifest.count() > 3
    assert sorted(r.page_id for r in warc.read_archives(manifest).collect()) == list(range(60))


def test_archives_of_nothing(spark):
    assert warc.archive(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


@pytest.fixture(scope="module")
def folder(spark, documents, labels):
    path = shared_scratch(spark, "pipeline_test")
    benchmark = spark.createDataFrame([(1, " ".join(f"w{c}ord" for c in "abcdefghijk"))], "item_id bigint, text string")
    leak = spark.createDataFrame(
        [(900, "so " + " ".join(f"w{c}ord" for c in "abcdefghijk") + " it is said here", "en", "s1", 9)],
        "doc_id bigint, text string, lang string, source string, n_chars int",
    )
    documents.select(leak.columns).union(leak).write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_stages(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "decontamination", "mixing", "token_ids"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        path = shared_scratch(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append([tuple(r) for r in docs.collect()])
        assert name == "token_ids" or docs.columns == columns
    rules, unique, clean, mixed, tokens = seen
    source = spark.read.parquet(f"{folder}/documents.parquet")
    forest = quality_rules.fit(source, spark.read.parquet(f"{folder}/labels.parquet"))
    same_rows([r[:1] for r in rules], [(r.doc_id,) for r in quality_rules.rate(source, forest).where("kept").collect()])
    found, root = expected_copies(rules)
    assert len(unique) == len(set(root))
    assert {r[0] for r in unique} == {f[2] for f in found}
    assert {r[0] for r in unique} - {r[0] for r in clean} == {900}
    sizes = Counter()
    for r in clean:
        sizes[r[3]] += len(r[1].split(" "))
    assert {r[3] for r in mixed} <= set(brute_targets(sizes)) and max(Counter(mixed).values()) <= 2
    same_rows(tokens, expected_tokens(mixed))


def test_pipeline_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


