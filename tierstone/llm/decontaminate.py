"""Benchmark decontamination by canonical templates.

A text becomes a row of template tokens: words lower-cased and without punctuation;
any word with a digit is a NUMBER, a unit after a number a UNIT, and a capitalised word
that is not all capitals a NAME. So a name that opens a sentence is a slot like others, and
so is any word there: a window is only found with a word in its place that is capitalised
too. Where a text has no capitals it has no names; therefore items are indexed in three
readings, with every capitalised word as a NAME, with those only that open no sentence, and
with none. They catch copies in lower case or in capitals, and those that go on a sentence.
Windows of ``WINDOW`` tokens of the documents are
hash-joined with those of the benchmark, so a question with other numbers, names or
units is still found. A match counts if the slots of its window are consistent, that is,
if one substitution of values in each direction turns the benchmark's window into the
document's, and if at least half its tokens are words or all its values are equal too.
An item shorter than a window is one window of its own length.

Only hashes of the windows are joined; the texts of documents with a matching hash are
then read again for the check of slots. Windows that many items share are one row. The
benchmark's side is broadcast up to ``BROADCAST_WINDOWS`` windows, and the matching
windows of the documents up to ``BROADCAST_FOUND``, both counted first; beyond, the join
is a shuffle.

Cases: null or empty texts, of either side, match nothing; nor do items of fewer than
``MIN_TOKENS`` tokens, as everyday phrases are as long. Repeated rows get equal
verdicts; a null id is an id like others. Without a benchmark every row stays. ``clean``
keeps all columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch

WINDOW = 8
MIN_TOKENS = 5
BROADCAST_WINDOWS = 1_000_000
BROADCAST_FOUND = 500_000

#: Words that are units of measure when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft feet foot yd yard yards mi mile miles mg g kg gram grams "
    "kilogram kilograms t ton tons tonnes oz ounce ounces lb lbs pound pounds ml l litre litres "
    "liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years percent dollar dollars euro euros cent cents mph kmh "
    "degree degrees watt watts volt volts meter meters metre metres"
).split()

# One private character stands for each type of slot.
NUMBER, UNIT, NAME = "\ue001", "\ue002", "\ue003"
_SLOTS = f"{NUMBER}{UNIT}{NAME}"
_SPACE = "[\\x20\\x09-\\x0D]"


#: What is a NAME: each capitalised word, those that open no sentence, or none.
ALL, INNER, NONE = "all", "inner", "none"
_NAMES = {
    ALL: "(?<![^\\x20\\x09-\\x0D])[^\\p{L}\\p{N}\\x20\\x09-\\x0D]{0,3}\\p{Lu}(?=\\p{Ll})[^\\x20\\x09-\\x0D]*",
    INNER: "(?<=[^.!?:\\x20\\x09-\\x0D]\\x20)\\p{Lu}(?=\\p{Ll})[^\\x20\\x09-\\x0D]*",
}


def _template(text: Column, names: str = ALL) -> Column:
    """The text with typed placeholders; its words stay as many as they were."""
    named = F.regexp_replace(text, _NAMES[names], NAME) if names in _NAMES else text
    numbered = F.when(
        F.regexp_like(text, F.lit("[0-9]")),
        F.regexp_replace(
            F.regexp_replace(named, "[^\\x20\\x09-\\x0D]*[0-9][^\\x20\\x09-\\x0D]*", NUMBER),
            f"(?i)(?<={NUMBER}[\\x20\\x09-\\x0D])({'|'.join(UNITS)})(?=[^\\p{{L}}]|$)",
            UNIT,
        ),
    ).otherwise(named)
    return F.regexp_replace(F.lower(numbered), f"[^\\p{{L}}\\p{{M}}{_SLOTS}\\x20\\x09-\\x0D]+", "")


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(_template(F.coalesce(text, F.lit(""))), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))


def _pairs(text: Column, names: str = ALL) -> Column:
    """Template token and plain word of each token, in step."""
    text = F.coalesce(text, F.lit(""))
    zipped = F.arrays_zip(
        F.split(_template(text, names), _SPACE).alias("token"), F.split(text, _SPACE).alias("word")
    )
    return F.filter(zipped, lambda p: p["token"] != "")


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value taken once: as the variable of a lambda."""
    return F.transform(F.array(value), body)[0]


def _hash(tokens: Column) -> Column:
    return F.xxhash64(F.concat_ws(" ", tokens))


def _starts(n: Column, length: int) -> Column:
    return F.when(n >= length, F.sequence(F.lit(1), n - (length - 1))).otherwise(F.array().cast("array<int>"))


def window_hashes(text: Column, lengths: list[int]) -> Column:
    """Hashes of all template windows of the given lengths; positions are kept apart."""

    def windows(tokens: Column, length: int) -> Column:
        return F.transform(
            _starts(F.size(tokens), length),
            lambda i: F.struct(_hash(F.slice(tokens, i, length)).alias("h"), i.alias("i"), F.lit(length).alias("n")),
        )

    return _bind(_tokens(text), lambda t: F.concat(*(windows(t, n) for n in lengths)))


def _slots(pairs: Column) -> Column:
    """What the check compares: which slots hold equal values, and a hash of the values."""
    return _bind(
        F.transform(
            F.filter(pairs, lambda p: p["token"].isin(NUMBER, UNIT, NAME)),
            lambda p: F.concat(p["token"], F.regexp_replace(F.lower(p["word"]), "^[\"'(]+|[.,;:!?\"')(]+$", "")),
        ),
        lambda values: F.struct(
            F.transform(values, lambda v: F.array_position(values, v)).alias("pattern"),
            F.when(2 * F.size(values) > F.size(pairs), F.xxhash64(F.concat_ws(" ", values)))
            .otherwise(F.lit(0).cast("bigint"))
            .alias("values"),
        ),
    )


def _checked(rows: DataFrame, positions: Column) -> DataFrame:
    """Rows ``h, pattern, values`` of the windows at ``positions`` of ``pairs``, with the other columns."""
    others = [c for c in rows.columns if c not in ("pairs", "at")]

    def windows(pairs: Column) -> Column:
        return F.transform(
            positions,
            lambda p: F.struct(
                p["h"].alias("h"), _bind(F.slice(pairs, p["i"], p["n"]), _slots).alias("slots")
            ),
        )

    found = rows.select(*others, F.explode(_bind(F.col("pairs"), windows)).alias("w"))
    return found.select(
        *others,
        "w.h",
        F.concat_ws(",", F.col("w.slots.pattern").cast("array<string>")).alias("pattern"),
        F.col("w.slots.values").alias("values"),
    )


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``h, n, pattern, values, item_id, items`` of each distinct window of the benchmark, in its three readings."""
    readings = F.array(*(_pairs(F.col("text"), names) for names in (ALL, INNER, NONE)))
    items = benchmark.select("item_id", F.explode(readings).alias("pairs"))
    size = F.size("pairs")
    length = F.least(size, F.lit(window))
    items = items.where(size >= MIN_TOKENS).select(
        "item_id",
        "pairs",
        length.alias("n"),
        F.transform(
            F.sequence(F.lit(1), size - length + 1),
            lambda i: F.struct(
                _hash(F.transform(F.slice("pairs", i, length), lambda p: p["token"])).alias("h"),
                i.alias("i"),
                length.alias("n"),
            ),
        ).alias("at"),
    )
    found = _checked(items, F.col("at"))
    return found.groupBy("h", "n", "pattern", "values").agg(
        F.min("item_id").alias("item_id"), F.count_distinct("item_id").alias("items")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, key: list[str], window: int = WINDOW) -> DataFrame:
    """``key..., windows, item_id`` of each document that matches: how many different
    windows of it do, and the smallest id of an item they match."""
    spark = docs.sparkSession
    base = shared_scratch(spark, "decontaminate")
    benchmark_windows(benchmark, window).write.parquet(f"{base}/benchmark")
    known = spark.read.parquet(f"{base}/benchmark")
    hashes = known.select("h").distinct()
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())
    small = known.count() <= BROADCAST_WINDOWS

    def side(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if small else rows

    found = (
        docs.select(*key, F.explode(window_hashes(F.col("text"), lengths or [window])).alias("w"))
        .select(*key, "w.h", "w.i", "w.n")
        .join(side(hashes), "h")
        .groupBy(*key)
        # A document's windows are no more than its words.
        .agg(F.collect_set(F.struct("h", "i", "n")).alias("at"))
    )
    found.write.parquet(f"{base}/found")
    found = spark.read.parquet(f"{base}/found")
    few = (found.agg(F.sum(F.size("at"))).first()[0] or 0) <= BROADCAST_FOUND
    found = found.select(*(F.col(k).alias(f"_{k}") for k in key), "at")
    found = F.broadcast(found) if few else found
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    texts = docs.select(*key, "text").join(found, same).select(*key, _pairs(F.col("text")).alias("pairs"), "at")
    matches = _checked(texts, F.col("at")).join(
        side(known.select("h", "pattern", "values", "item_id")), ["h", "pattern", "values"]
    )
    return matches.groupBy(*key).agg(F.count_distinct("h").alias("windows"), F.min("item_id").alias("item_id"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, contaminated, windows, item_id`` for every document."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    found = contaminated(keyed, benchmark, ["doc_id", "row"], window).withColumnsRenamed(
        {"doc_id": "_id", "row": "_row"}
    )
    same = (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return keyed.join(found, same, "left").select(
        "doc_id",
        F.col("windows").isNotNull().alias("contaminated"),
        F.coalesce("windows", F.lit(0)).cast("bigint").alias("windows"),
        "item_id",
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that match nothing, with all their columns."""
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64("text").alias("row"))
    flat = rows.select("doc.doc_id", "doc.text", "row")
    found = contaminated(flat, benchmark, ["doc_id", "row"], window).select(
        F.col("doc_id").alias("_id"), F.col("row").alias("_row")
    )
    same = (F.col("row") == F.col("_row")) & F.col("doc.doc_id").eqNullSafe(F.col("_id"))
    return rows.join(found, same, "left_anti").select("doc.*")
