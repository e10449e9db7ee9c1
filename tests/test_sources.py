"""Paged source, page prefix, RAW files."""

import json
import os
import random
import sys
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tierstone.errors import ApiResponseError, ExtractionError
from tierstone.operators.paging import explode_pages, page_prefix
from tierstone.operators import sinks
from tierstone.operators.sinks import write_raw
from tierstone.functions.records import payloads_from_list
from tierstone.sources.paged import (
    paged_json,
    HttpPages,
    StoredPages,
    fetch_all,
    land_pages,
    page_records,
    probe_pages,
    read_pages,
)
from tierstone.sources.raw import read_raw_arrays, read_raw_lines

# Tasks cannot import this module; ``Answers`` below travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pages_of(spark, sizes):
    rows = [(n, [json.dumps({"id": f"{n}-{i}"}) for i in range(size)]) for n, size in sizes.items()]
    return spark.createDataFrame(rows, "page_number INT, records ARRAY<STRING>")


@pytest.mark.parametrize(
    "sizes, max_pages, kept",
    [
        ({1: 2, 2: 2, 3: 0, 4: 2}, None, [1, 2]),
        ({1: 2, 2: 2, 3: 2}, 2, [1, 2]),
        ({1: 2, 2: 2, 3: 2}, None, [1, 2, 3]),
        ({1: 2, 2: 2, 3: 2}, 9, [1, 2, 3]),
        ({1: 0}, 5, []),
        ({1: 2, 2: 2}, 0, []),
        ({1: 2, 2: 2}, -1, []),
        ({0: 2, 1: 2}, None, [1]),
        ({1: 2, 3: 2, 4: 2}, None, [1]),
        ({2: 2, 3: 2}, None, []),
        ({}, None, []),
    ],
)
def test_page_prefix(spark, sizes, max_pages, kept):
    pages = pages_of(spark, sizes)
    prefix = page_prefix(pages, max_pages)
    assert sorted(r.page_number for r in prefix.collect()) == kept
    assert explode_pages(prefix).count() == 2 * len(kept)


def test_page_prefix_looks_for_the_end_without_reading_records(spark, path):
    pages = pages_of(spark, {1: 2, 2: 0}).withColumn("n_records", F.size("records"))
    pages.write.parquet(f"{path}/pages")
    prefix = page_prefix(spark.read.parquet(f"{path}/pages"))
    assert prefix.count() == 1
    plan = prefix._jdf.queryExecution().executedPlan().toString()
    schemas = {s.split("\n")[0] for s in plan.split("ReadSchema: ")[1:]}
    assert schemas == {
        "struct<page_number:int,n_records:int>",
        "struct<page_number:int,records:array<string>,n_records:int>",
    }
    assert plan.count("records:array") < plan.count("ReadSchema")


class Answers:
    """Page texts by number; a missing page is empty, an exception is raised."""

    def __init__(self, texts, asked=None):
        self.texts, self.asked = texts, asked

    def __call__(self, page_number, per_page):
        if self.asked:
            open(os.path.join(self.asked, f"{page_number}-{os.urandom(4).hex()}"), "w").close()
        text = self.texts.get(page_number, "[]")
        if text == "down":
            raise ExtractionError("no answer")
        if text == "bug":
            raise RuntimeError("a fault of the fetcher")
        return text


def ids(df):
    return [json.loads(r.payload)["id"] for r in df.collect()]


def numbered(n):
    return {k: json.dumps([{"id": k}]) for k in range(1, n + 1)}


def test_read_pages_is_one_row_per_page(spark):
    pages = read_pages(spark, Answers(numbered(3)), last=4, pages_per_task=3)
    rows = pages.orderBy("page_number").collect()
    assert [(r.page_number, r.n_records, r.error) for r in rows] == [
        (1, 1, None), (2, 1, None), (3, 1, None), (4, 0, None),
    ]


@pytest.mark.parametrize("max_pages, expected", [(5, 5), (None, 40), (0, 0), (100, 40)])
def test_fetch_all(spark, path, max_pages, expected):
    got = fetch_all(spark, Answers(numbered(40)), f"{path}/pages", max_pages=max_pages)
    assert sorted(ids(got)) == list(range(1, expected + 1))


def test_each_page_is_asked_for_once(spark, path):
    asked = f"{path}/asked"
    os.mkdir(asked)
    records = fetch_all(spark, Answers(numbered(20), asked), f"{path}/pages", max_pages=None)
    assert records.count() == records.count() == 20
    pages = [int(name.split("-")[0]) for name in os.listdir(asked)]
    assert len(pages) == len(set(pages)) and set(pages) >= set(range(1, 22))


def test_waves_stop_growing(spark, path):
    got = fetch_all_small_waves(spark, path)
    assert sorted(ids(got)) == list(range(1, 51))


def fetch_all_small_waves(spark, path):
    pages = land_pages(spark, Answers(numbered(50)), f"{path}/p", max_pages=None, largest_wave=8)
    return explode_pages(page_prefix(pages))


def asked_pages(folder):
    return sorted(int(name.split("-")[0]) for name in os.listdir(folder))


@pytest.mark.parametrize("bad", [1, 2, 9, 37, 60])
def test_a_failed_extraction_goes_on(spark, path, bad):
    asked = f"{path}/asked"
    os.mkdir(asked)
    with pytest.raises(ExtractionError, match=f"page {bad}"):
        fetch_all(spark, Answers({**numbered(60), bad: "down"}, asked), f"{path}/pages")
    for name in os.listdir(asked):  # the page that failed may be asked for again
        if name.startswith(f"{bad}-"):
            os.remove(f"{asked}/{name}")
    got = fetch_all(spark, Answers(numbered(60), asked), f"{path}/pages", resume=True)
    assert sorted(ids(got)) == list(range(1, 61))
    pages = asked_pages(asked)
    assert len(pages) == len(set(pages)) and set(pages) >= set(range(1, 62))
    # A landing with the end of the source is not asked about again.
    assert fetch_all(spark, Answers({1: "bug"}, asked), f"{path}/pages", resume=True).count() == 60
    assert asked_pages(asked) == pages
    # Without resuming it is replaced.
    assert ids(fetch_all(spark, Answers(numbered(1)), f"{path}/pages")) == [1]
    assert ids(fetch_all(spark, Answers({}), f"{path}/pages", resume=True)) == [1]


def test_an_extraction_that_fails_again_and_again(spark, path):
    texts, asked = numbered(150), f"{path}/asked"
    os.mkdir(asked)
    bad = [3, 5, 6, 20, 21, 70, 149]
    for n in range(len(bad)):
        # Each attempt mends one page.
        fails = Answers({**texts, **dict.fromkeys(bad[n:], "down")}, asked)
        with pytest.raises(ExtractionError, match=f"page {bad[n]}:"):
            land_pages(spark, fails, f"{path}/p", resume=True)
    got = land_pages(spark, Answers(texts, asked), f"{path}/p", resume=True)
    assert sorted(ids(explode_pages(got))) == list(range(1, 151))
    counts = Counter(asked_pages(asked))
    assert all(counts[k] == 1 for k in range(1, 151) if k not in bad)


def test_a_wave_that_broke_off_is_fetched_anew(spark, path):
    land_pages(spark, Answers(numbered(40)), f"{path}/p")
    os.remove(f"{path}/p/wave=1/_SUCCESS")
    got = land_pages(spark, Answers(numbered(45)), f"{path}/p", resume=True)
    assert sorted(ids(explode_pages(got))) == list(range(1, 46))


def test_a_resumed_landing_keeps_to_its_page_size_and_cap(spark, path):
    with pytest.raises(ExtractionError):
        land_pages(spark, Answers({**numbered(9), 4: "down"}), path, max_pages=6)
    with pytest.raises(ExtractionError, match="pages of 50"):
        land_pages(spark, Answers(numbered(9)), path, per_page=7, resume=True)
    below = land_pages(spark, Answers({1: "bug"}), path, max_pages=3, resume=True)
    assert sorted(ids(explode_pages(below))) == [1, 2, 3]
    got = land_pages(spark, Answers(numbered(9)), path, max_pages=8, resume=True)
    assert sorted(ids(explode_pages(got))) == list(range(1, 9))


@pytest.mark.parametrize(
    "bad, error",
    [("down", ExtractionError), ("{", ApiResponseError), ('{"id": 1}', ApiResponseError)],
)
def test_failed_page_loses_the_extraction(spark, path, bad, error):
    with pytest.raises(ExtractionError) as caught:
        fetch_all(spark, Answers({**numbered(3), 2: bad}), f"{path}/a", max_pages=3)
    assert type(caught.value) is error and "page 2" in str(caught.value)
    # Past the end of the source nobody would have asked.
    after = {**numbered(2), 4: bad}
    assert sorted(ids(fetch_all(spark, Answers(after), f"{path}/b", max_pages=4))) == [1, 2]
    # Past the page cap as well.
    capped = {**numbered(2), 3: bad}
    assert sorted(ids(fetch_all(spark, Answers(capped), f"{path}/c", max_pages=2))) == [1, 2]


def test_fault_of_a_fetcher_is_an_extraction_error(spark, path):
    with pytest.raises(ExtractionError, match="a fault of the fetcher"):
        fetch_all(spark, Answers({1: "bug"}), path)
    with pytest.raises(ExtractionError, match="a fault of the fetcher"):
        probe_pages(spark, Answers({1: "bug"}))


def test_probe(spark):
    probe_pages(spark, Answers(numbered(1)))
    with pytest.raises(ExtractionError, match="no record"):
        probe_pages(spark, Answers({}))
    with pytest.raises(ApiResponseError):
        probe_pages(spark, Answers({1: "<html>"}))


def test_page_text():
    assert page_records('[{"a": null, "b": "é"}, 1]') == ['{"a": null, "b": "é"}', "1"]
    assert page_records("[]") == []


def test_http_parameters_and_errors(path):
    fetch = HttpPages("http://host/x?", params={"page": 99, "by_type": "micro"})
    assert fetch.url(2, 50) == "http://host/x?page=2&by_type=micro&per_page=50"
    listed = HttpPages("http://host/x", params={"a": ["1", "2"], "b": None})
    assert listed.url(1, 5) == "http://host/x?a=1&a=2&page=1&per_page=5"
    assert HttpPages("http://host/x?k=v").url(1, 5) == "http://host/x?k=v&page=1&per_page=5"
    # file: stands in for a server; the query string is part of the file name.
    with open(f"{path}/list?page=1&per_page=2", "w", encoding="utf-8") as out:
        out.write('[{"id": "é"}]')
    local = HttpPages(f"file://{path}/list")
    assert page_records(local(1, 2)) == ['{"id": "é"}']
    with pytest.raises(ExtractionError):
        local(2, 2)


def test_stored_pages(spark, path):
    os.makedirs(f"{path}/page_number=1")
    with open(f"{path}/page_number=1/part-0.txt", "w", encoding="utf-8") as out:
        out.write('[{"id": 1}, {"id": 2}]\n')
    for root in (path, f"file:{path}", f"file://{path}"):
        fetch = StoredPages(root, per_page=2)
        assert len(page_records(fetch(1, 2))) == 2
        assert len(page_records(fetch(1, 1))) == 1
        assert page_records(fetch(2, 2)) == []
    with pytest.raises(ExtractionError):
        StoredPages(path, per_page=2)(2, 1)
    write(f"{path}/page_number=1", "part-1.txt", '[{"id": 3}]')
    assert len(page_records(StoredPages(path, per_page=3)(1, 3))) == 3
    with pytest.raises(ExtractionError, match="no folder"):
        StoredPages(f"{path}/nowhere", per_page=2)(1, 2)


def test_all_pages_by_default(spark, path):
    assert sorted(ids(fetch_all(spark, Answers(numbered(10)), path))) == list(range(1, 11))
    with pytest.raises(Exception, match="lastPage"):
        spark.dataSource.register(paged_json(Answers(numbered(1))))
        spark.read.format("paged_json").load().collect()


def test_a_fault_past_the_end_is_not_asked_about(spark, path):
    pages = {**numbered(2), 4: "bug", 5: "bug"}
    assert sorted(ids(fetch_all(spark, Answers(pages), path, max_pages=8))) == [1, 2]


def test_fetching_reads_the_landing_once(spark, path):
    got = fetch_all(spark, Answers(numbered(4)), path)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan


# --- RAW ----------------------------------------------------------------------


def write(path, name, text):
    with open(f"{path}/{name}", "w", encoding="utf-8") as out:
        out.write(text)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("[]", []),
        ('[1,"x",null,true]', ["1", "x", None, "true"]),
        ('[{"a":12345678901234567890}]', ['{"a":12345678901234567890}']),
        ('[{"b": 1, "a": null}, {"é": "ü"}]\n', ['{"b":1,"a":null}', '{"é":"ü"}']),
        ('[\n  {"a": [1,\n 2]}\n]', ['{"a":[1,2]}']),
    ],
)
def test_raw_array(spark, path, text, expected):
    write(path, "a.json", text)
    got = read_raw_arrays(spark, path, positions=True).orderBy("file", "position").collect()
    assert [r.payload for r in got] == expected


@pytest.mark.parametrize("text", ['{"a":1}', '[{"a":1},', "null", " "])
def test_raw_array_that_is_none_fails(spark, path, text):
    write(path, "a.json", text)
    with pytest.raises(Exception, match="MALFORMED|blank|array"):
        read_raw_arrays(spark, path).collect()


def test_large_array_file_is_split_and_whole(spark, path):
    records = [{"i": i, "s": "é" * (i % 40), "l": [{"a": i}], "e": {}} for i in range(20_000)]
    write(path, "big.json", json.dumps(records, ensure_ascii=False))
    write(path, "small.json", json.dumps([{"i": -1}]))
    write(path, "one.json", json.dumps([{"i": -2, "s": "x" * 9000}]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        got = read_raw_arrays(spark, path)
        assert spark.read.text(path, lineSep="}, {").rdd.getNumPartitions() > 10
        back = [json.loads(r.payload) for r in got.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(back, key=lambda r: r["i"])[2:] == records
    assert sorted(r["i"] for r in back)[:2] == [-2, -1]


@pytest.mark.parametrize("records", [[{}], [{}, {}], [{"a": 1}], [{"a": [{"b": 1}]}, {"c": [2]}]])
def test_split_edges(spark, path, records):
    write(path, "a.json", json.dumps(records))
    got = read_raw_arrays(spark, path).collect()
    assert sorted(r.payload for r in got) == sorted(json.dumps(r, separators=(",", ":")) for r in records)


@pytest.mark.parametrize("record_break", ["}, {", "},{", "},\n  {", "}\n\t,\r\n{"])
def test_other_record_breaks(spark, path, record_break):
    records = [{"i": i} for i in range(500)]
    text = record_break.join(json.dumps(r)[1:-1] for r in records)
    write(path, "a.json", "[{" + text + "}]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = read_raw_arrays(spark, path, positions=True).orderBy("file", "position").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [json.loads(r.payload)["i"] for r in got] == list(range(500))


def test_scratch_without_a_shared_folder(spark):
    from tierstone import session

    class Unset:
        class conf:
            get = staticmethod(lambda key, default: default)

        sparkContext = spark.sparkContext

    first, second = session.shared_scratch(Unset, "a"), session.shared_scratch(Unset, "a")
    assert first != second and os.path.dirname(first) == os.path.dirname(second)
    assert first.startswith("file:") and os.path.isdir(os.path.dirname(first.removeprefix("file:")))

    class Cluster(Unset):
        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_scratch(Cluster, "a")


@pytest.mark.parametrize(
    "text, expected",
    [
        ('[{"a": "x}, {y"}, {"b": 1}]', ['{"a":"x}, {y"}', '{"b":1}']),
        ('[{"a": [{"b": 1}, {"b": 2}, {"b": 3}]}]', ['{"a":[{"b":1},{"b":2},{"b":3}]}']),
    ],
)
def test_breaks_within_a_record(spark, path, text, expected):
    write(path, "a.json", text)
    assert sorted(r.payload for r in read_raw_arrays(spark, path).collect()) == expected


@pytest.mark.parametrize(
    "text",
    [
        '[{"a": 1}, {"b": 2}',
        '"a": 1}, {"b": 2}]',
        '[{"a": 1}, {"b": 2}]}, {"c": 3}]',
        '[{"a": 1}, {"x": 5}]\n[{"b": 2}, {"c": 3}]',
        '[{"a": 1}] tail',
        "[1]]",
    ],
)
def test_anything_but_one_whole_array_fails(spark, path, text):
    write(path, "a.json", text)
    with pytest.raises(Exception, match="MALFORMED|array"):
        read_raw_arrays(spark, path).collect()


def test_raw_lines_round_trip(spark, path):
    records = [{"id": "a\nb", "n": None, "s": "é\u2028x\r"}, {"id": 'q"\\'}]
    odd = ['{"id":\n"1"}', "not\njson", None, "", " ", "\n", "\t \r", "null", '"x"', '"', "\ufeffa", "a\x00b\x0c"]
    payloads = payloads_from_list(spark, records).union(
        spark.createDataFrame([(text,) for text in odd], "payload STRING")
    )
    for _ in range(2):  # a retry replaces
        raw = write_raw(payloads, path, "20250101T000000")
    assert raw == f"{path}/run_id=20250101T000000"
    back = [r.payload for r in read_raw_lines(spark, raw).collect()]
    texts = [json.dumps(record, ensure_ascii=False) for record in records]
    assert sorted(back, key=repr) == sorted([*texts, *odd], key=repr)
    lines = [r.value for r in spark.read.text(raw).collect()]
    assert texts[1] in lines and len(lines) == len(texts) + len(odd)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.none() | st.text(st.sampled_from('\n\r\t "\\{}null:é\ufeff\x0b\x00\u2028,[]')), min_size=30, max_size=60))
def test_any_payload_survives_raw(spark, tmp_path_factory, texts):
    rows = spark.createDataFrame([(text,) for text in texts], "payload STRING")
    raw = write_raw(rows, str(tmp_path_factory.mktemp("raw")), "r")
    back = [r.payload for r in read_raw_lines(spark, raw).collect()]
    assert sorted(back, key=repr) == sorted(texts, key=repr)


def test_raw_is_landed_compressed_in_bounded_files(spark, path, monkeypatch):
    monkeypatch.setattr(sinks, "RAW_FILE_LINES", 300)
    records = [{"id": str(n), "name": f"name {n % 7}", "brewery_type": None, "address_1": None} for n in range(1000)]
    raw = write_raw(payloads_from_list(spark, records).coalesce(1), path, "r")
    files = [f"{raw}/{name}" for name in os.listdir(raw) if name.startswith("part-")]
    assert len(files) == 4  # each is read by one task
    texts = [json.dumps(record) for record in records]
    assert sum(map(os.path.getsize, files)) * 4 < sum(map(len, texts))
    assert sorted(r.payload for r in read_raw_lines(spark, raw).collect()) == sorted(texts)


def test_foreign_lines_stay_as_they_are(spark, path):
    write(path, "a.json", '"x"\nnull\n\n{"a": 1}\n')
    got = read_raw_lines(spark, path, encoded=False).collect()
    assert [r.payload for r in got] == ['"x"', "null", '{"a": 1}']


def test_arrays_are_read_in_two_scans(spark, path):
    """A third is planned, and run only where a split ends within a record."""
    write(path, "a.json", json.dumps([{"i": i, "s": "x" * 90} for i in range(3000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        got = read_raw_arrays(spark, path)
        assert got.rdd.count() == 3000
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert plan.count("FileScan") == 2 and plan.count(" Exchange ") == 1


def test_arrays_are_read_in_any_session_of_an_application(spark, path):
    write(path, "a.json", '[{"a": 1}, {"a": 2}]')
    for session in (spark, spark.newSession(), spark.newSession()):
        assert read_raw_arrays(session, path).count() == 2


def test_arrays_of_many_files_and_splits_keep_their_order(spark, path):
    rng = random.Random(5)
    expected = []
    for name in range(6):
        records = [{"n": [name, i], "l": [{"x": "}, {"}] * rng.randrange(9)} for i in range(rng.randrange(1, 400))]
        write(path, f"{name}.json", json.dumps(records, indent=rng.choice([None, 1])))
        expected += [r["n"] for r in records]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = read_raw_arrays(spark, path, positions=True).orderBy("file", "position").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [json.loads(r.payload)["n"] for r in got] == expected


# --- against brute force --------------------------------------------------------


def prefix_by_hand(sizes, max_pages):
    kept, page = [], 1
    while (max_pages is None or page <= max_pages) and sizes.get(page, 0):
        kept.append(page)
        page += 1
    return kept


def test_page_prefix_against_a_loop(spark):
    rng = random.Random(7)
    for _ in range(12):
        sizes = {p: rng.choice([0, 1, 3, 3, 3]) for p in range(1, 9) if rng.random() < 0.9}
        cap = rng.choice([None, 3, 20])
        got = page_prefix(pages_of(spark, sizes), cap).select("page_number").collect()
        assert sorted(r[0] for r in got) == prefix_by_hand(sizes, cap), (sizes, cap)


def test_split_of_random_records(spark, path):
    """Quotes, brackets, breaks and nesting in every place: always the right records."""
    rng = random.Random(11)
    pieces = ['"', "\\", "{", "}", "[", "]", ", ", "},{", "}, {", "é", "\n", "x", "'", "null", ":"]

    def text():
        return "".join(rng.choices(pieces, k=rng.randrange(6)))

    def value(depth):
        kind = rng.randrange(6 if depth else 4)
        if kind == 0:
            return rng.choice([None, True, rng.randrange(10**12)])
        if kind < 4:
            return text()
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        return {text(): value(depth - 1) for _ in range(rng.randrange(3))}

    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    try:
        for n in range(2):
            folder = f"{path}/{n}"
            os.mkdir(folder)
            records = [{text(): value(3) for _ in range(rng.randrange(4))} for _ in range(300)]
            write(folder, "a.json", json.dumps(records, ensure_ascii=False))
            got = [json.loads(r.payload) for r in read_raw_arrays(spark, folder).collect()]
            assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, records))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_null_elements_stay_rows_all_the_way(spark, path):
    os.mkdir(f"{path}/dump")
    write(f"{path}/dump", "a.json", '[null, {"id": "1"}, null]')
    raw = write_raw(read_raw_arrays(spark, f"{path}/dump"), f"{path}/raw", "r")
    assert read_raw_lines(spark, raw).count() == 3
