"""Benchmark decontamination by templates.

Texts of documents and benchmark items become token sequences in which numbers, names and units are
typed placeholders. Windows of such tokens are hashed and joined. Where windows of an item line up in
a document, the item's slot values must go with the document's one to one; windows that break this
do not count. A document that holds enough of an item's windows, or a long enough passage of it at one
shift, leaks it, either verbatim or with other slot values.

Tokens are runs of letters, lower-cased, and numbers with their points and commas. A number, also a
small one in words, is a number slot. A unit right after a number is a unit slot. A capitalised word
(not all capitals) that does not begin a sentence is a name slot; names in a row are one. Case and
punctuation decide on names, so texts are also compared blind to both, with numbers and units as the
only slots; either way is enough.

Defined results: null and empty texts leak nothing, nor do items without a token. An item shorter
than a window is one window: of a whole document as short, and, from ``LEAST`` tokens on, anywhere in
a document. If more than three eighths of it are slots, its values must be the same there. Rows with equal ids are told apart by their texts. Benchmark rows
without an id take no part. Empty tables give an empty result.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import held, stored

#: Tokens of a window, and placeholders up to which a window is telling.
WINDOW, SLOTS = 8, 3
#: Share of an item's windows that makes a leak.
SHARE = 0.4
#: Tokens in a row, at one shift, that make a leak.
RUN = 16
#: Tokens of the shortest item that is looked for inside longer documents.
LEAST = 3
#: Windows of a benchmark, 8 bytes each, up to which they are broadcast; more are joined.
BROADCAST_WINDOWS = 2_000_000
#: Leaking texts, 8 bytes each, up to which they are broadcast; more are joined.
BROADCAST_TEXTS = 1_000_000
REMEMBERED = 500_000

# Numbers in words and units.
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen
fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty
ninety hundred thousand million billion""".split()
UNITS = """mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram
kilograms ounce ounces oz pound pounds lb lbs ton tons ml l litre litres liter liters gallon gallons
second seconds sec s minute minutes min hour hours h day days week weeks month months year years
dollar dollars usd cent cents euro euros eur pence percent degree degrees celsius fahrenheit kelvin
meter meters metre metres centimeter centimeters kilometer kilometers kmh mph volt volts watt watts
joule joules newton newtons pascal pascals hz byte bytes kb mb gb""".split()

_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n]")
_PLAIN, _CAPITAL, _NUMBER, _UNIT, _END = range(5)
_draw = np.random.default_rng(77)
_PLACE = _draw.integers(0, 1 << 63, WINDOW, "uint64") * 2 + 1
_SLOT = {k: np.uint64(x) for k, x in zip((_CAPITAL, _NUMBER, _UNIT), _draw.integers(1, 1 << 62, 3))}
_MIX = np.uint64(0x9E3779B97F4A7C15)
# Ways to compare: whole windows with names or blind to case, and short items in the same ways or by value.
_NAMED, _BLIND, _SHORT_NAMED, _SHORT_BLIND, _SHORT_VALUES = range(5)
_NUMBERS, _UNITS = set(NUMBER_WORDS), set(UNITS)


def _kind(token: str) -> int:
    if token in ".!?:\n":
        return _END
    low = token.lower()
    if token[0].isdigit() or low in _NUMBERS:
        return _NUMBER
    if low in _UNITS:
        return _UNIT
    return _CAPITAL if token[0].isupper() and not (len(token) > 1 and token.isupper()) else _PLAIN


class Templates:
    """Windows of a text."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.hashes, self.kinds = np.zeros(1 << 12, "uint64"), np.zeros(1 << 12, "int8")

    def _learn(self, tokens: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        n = len(self.known) + len(tokens)
        if n > len(self.hashes):
            self.hashes, self.kinds = (np.resize(x, 2 * n) for x in (self.hashes, self.kinds))
        for token in tokens:
            place = self.known[token] = len(self.known)
            self.hashes[place] = xxhash.xxh3_64_intdigest(token.lower()) | 1
            self.kinds[place] = _kind(token)

    def tokens(self, text: str) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Template tokens, and the value in each slot (0 where a token is none): with names, and blind."""
        found = _TOKEN.findall(text)
        distinct = set(found)
        if new := distinct.difference(self.known):
            # a memory that would overflow is emptied, and then all of the text's tokens are new
            self._learn(new if len(self.known) <= REMEMBERED else distinct)
        ids = np.fromiter(map(self.known.__getitem__, found), "int64", len(found))
        kinds, value = self.kinds[ids], self.hashes[ids]
        starts = np.concatenate([[True], kinds[:-1] == _END])[: len(kinds)]
        kept = kinds != _END
        kinds, value, starts = kinds[kept], value[kept], starts[kept]
        after_number = np.concatenate([[False], kinds[:-1] == _NUMBER])[: len(kinds)]
        kinds = np.where((kinds == _CAPITAL) & starts, _PLAIN, kinds)
        kinds = np.where((kinds == _UNIT) & ~after_number, _PLAIN, kinds)
        name = (kinds == _CAPITAL) & ~starts
        blind = _marked(np.where(name, _PLAIN, kinds), value)
        if not name.any():
            return blind, blind
        first = ~(name & np.concatenate([[False], name[:-1]])[: len(name)])
        at = np.flatnonzero(first)
        if len(at) < len(kinds):
            value = np.add.reduceat(value, at)
            kinds = kinds[at]
        return _marked(kinds, value), blind

    def windows(self, text: str, ways: list[tuple[int, int]]) -> Iterator[tuple]:
        """Of each way and length: hash of the window at each place, and the text's slot values."""
        named, blind = self.tokens(text)
        sums: dict[tuple, tuple] = {}
        for way, length in ways:
            same = (named is blind or way in (_NAMED, _SHORT_NAMED), way == _SHORT_VALUES)
            if same not in sums:
                token, slot = named if way in (_NAMED, _SHORT_NAMED) else blind
                if way == _SHORT_VALUES:
                    token, slot = np.where(slot != 0, slot, token), np.zeros_like(slot)
                if 0 < len(token) < WINDOW:  # the text is one window of full length
                    slot = np.concatenate([slot, np.zeros(WINDOW - len(slot), "uint64")])
                sums[same] = _sums(token), slot
            total, slot = sums[same]
            total = total[length] + np.uint64(way * 16 + length) * _PLACE[-1]
            total = (total ^ (total >> np.uint64(32))) * _MIX
            yield way, length, total ^ (total >> np.uint64(29)), slot


def _sums(token: np.ndarray) -> list[np.ndarray]:
    """Weighted sums of the tokens from each place on, by the number of tokens up to a window's."""
    total, out = np.zeros(len(token), "uint64"), [token[:0]]
    for i, by in enumerate(_PLACE):
        if i < len(token):
            total = total[: len(token) - i] + token[i:] * by
            out.append(total)
        else:
            out.append(total[:0] if i + 1 < WINDOW else total)
    return out


def _marked(kinds: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    token = value.copy()
    for kind, mark in _SLOT.items():
        token[kinds == kind] = mark
    return token, np.where(kinds == _PLAIN, np.uint64(0), value)


def _ways(named: int, blind: int) -> list[tuple[int, int]]:
    """The ways to look for an item of so many tokens, and the lengths of its windows."""
    ways = [(_NAMED, WINDOW), (_BLIND, WINDOW)]
    if LEAST <= named < WINDOW:
        ways.append((_SHORT_NAMED, named))
    if LEAST <= blind < WINDOW:
        ways += [(_SHORT_BLIND, blind), (_SHORT_VALUES, blind)]
    return ways


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``window, way, length, item_id, item_at, item_slots, item_windows`` of an item's telling windows.

    An item without a telling window has all its windows.
    """

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates()
        for part in parts:
            for item, text in zip(part["item_id"], part["text"], strict=True):
                sizes = (len(token) for token, _ in templates.tokens(text))
                for way, length, window, slot in templates.windows(text, _ways(*sizes)):
                    if not len(window):
                        continue
                    slots = np.lib.stride_tricks.sliding_window_view(slot, length)[: len(window)]
                    held = (slots != 0).sum(axis=1)
                    telling = held * WINDOW <= SLOTS * length
                    if length < WINDOW and not telling.all():
                        continue
                    at = np.flatnonzero(telling) if telling.any() else np.arange(len(held))
                    if not len(at):
                        continue
                    yield pd.DataFrame(
                        {
                            "window": window[at].view("int64"),
                            "way": way,
                            "length": length,
                            "item_id": item,
                            "item_at": at,
                            "item_slots": [x.view("int64") for x in slots[at].astype("uint64")],
                            "item_windows": len(np.unique(window[at])),
                        }
                    )

    rows_of = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), "text")
    return rows_of.where("item_id is not null and text is not null").mapInPandas(
        rows,
        "window long, way int, length int, item_id long, item_at long, item_slots array<long>, "
        "item_windows long",
    )


def _sieve(wanted: np.ndarray) -> np.ndarray:
    """Low bits of what is wanted; most other windows need no search."""
    sieve = np.zeros(1 << max(16, (16 * len(wanted)).bit_length()), "bool")
    sieve[wanted & (len(sieve) - 1)] = True
    return sieve


def document_windows(
    docs: DataFrame, wanted: np.ndarray | None, ways: list[tuple[int, int]]
) -> DataFrame:
    """``doc_id, text_key, window, at, slots``: windows of documents, of those ``wanted`` if given."""
    schema = "doc_id long, text_key long, window long, at long, slots array<long>"
    fields = pa.schema(
        [(x, pa.int64()) for x in ("doc_id", "text_key", "window", "at")]
        + [("slots", pa.list_(pa.int64()))]
    )
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, sought = held("templates", Templates), shared.value
        sieve = None if sought is None else _sieve(sought)
        for part in parts:
            docs_, keys, out = part.column(0).to_pylist(), part.column(1).to_pylist(), []
            for doc, key, text in zip(docs_, keys, part.column(2).to_pylist(), strict=True):
                for _, length, window, slot in templates.windows(text or "", ways):
                    window = window.view("int64")
                    at = np.arange(len(window))
                    if sought is not None:
                        at = np.flatnonzero(sieve[window & (len(sieve) - 1)])
                        place = np.minimum(np.searchsorted(sought, window[at]), len(sought) - 1)
                        at = at[sought[place] == window[at]] if len(at) else at
                    for i in at:
                        out.append((doc, key, window[i], i, slot[i : i + length].view("int64")))
                if len(out) > 50_000:
                    yield _batch(out, fields)
                    out = []
            if out:
                yield _batch(out, fields)

    keyed = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    return keyed.mapInArrow(rows, schema)


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(x), f.type) for x, f in zip(columns, fields, strict=True)], schema=fields
    )


def _longest(places):
    """Tokens in a row that windows at these places hold; a window begins where another ends, or before."""
    start = F.struct(*(F.lit(0).cast("long").alias(x) for x in ("first", "next", "best")))

    def step(state, at):
        first = F.when((at > state["next"]) | (state["best"] == 0), at).otherwise(state["first"])
        best = F.greatest(state["best"], at + WINDOW - first)
        return F.struct(first.alias("first"), (at + WINDOW).alias("next"), best.alias("best"))

    return F.aggregate(places, start, step, lambda state: state["best"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, item_id, windows, coverage, slots, changed, kind``: a row for each leak.

    ``kind`` is ``verbatim`` or ``reparameterised``; ``changed`` counts distinct slot values of the
    item that stand for others in the document.
    """
    index = stored(benchmark_windows(benchmark), "benchmark-windows")
    wanted = None
    if index.count() <= BROADCAST_WINDOWS:
        wanted = np.unique(
            index.select("window").distinct().toPandas()["window"].to_numpy(dtype="int64")
        )
    ways = sorted((x.way, x.length) for x in index.select("way", "length").distinct().collect())
    found = document_windows(docs.select("doc_id", "text"), wanted, ways).join(index, "window")
    found = stored(found, "window-hits")
    found = found.withColumn("shift", F.col("at") - F.col("item_at"))
    own = ["doc_id", "text_key", "item_id", "way", "shift"]
    pair = F.explode(F.arrays_zip("item_slots", "slots")).alias("pair")
    values = (
        found.select(*own, pair)
        .select(*own, F.col("pair.item_slots").alias("asked"), F.col("pair.slots").alias("given"))
        .where("asked != 0")
        .distinct()
    )
    # a value that goes with two others, on either side, breaks the passage's windows around it
    ways = values.groupBy(*own, "asked").agg(
        F.count("*").alias("ways"), F.min("given").alias("given")
    )
    back = ways.where("ways = 1").groupBy(*own, "given").agg(F.count("*").alias("uses"))
    fits = (
        ways.join(back, [*own, "given"], "left")
        .groupBy(*own)
        .agg(
            F.count("*").alias("slots"),
            F.count(F.when((F.col("ways") > 1) | (F.col("uses") > 1), 1)).alias("broken"),
            F.count(F.when(F.col("asked") != F.col("given"), 1)).alias("changed"),
        )
    )
    null_safe = [F.col(f"a.{x}").eqNullSafe(F.col(f"b.{x}")) for x in own]
    windows = found.groupBy(*own).agg(
        F.collect_set("window").alias("seen"),
        F.first("item_windows").alias("item_windows"),
        _longest(F.array_sort(F.collect_set("item_at"))).alias("run"),
    )
    passages = (
        windows.alias("a")
        .join(fits.alias("b"), null_safe, "left")
        .select("a.*", *(F.coalesce(f"b.{x}", F.lit(0)).alias(x) for x in ("slots", "broken", "changed")))
        .where(F.col("broken") * 4 <= F.col("slots"))
    )
    seen = F.size(F.array_distinct(F.flatten(F.collect_list("seen"))))
    columns = ["windows", "coverage", "slots", "changed"]
    return (
        passages.groupBy("doc_id", "text_key", "item_id", "way")
        .agg(
            seen.cast("long").alias("windows"),
            F.first("item_windows").alias("item_windows"),
            F.max("slots").alias("slots"),
            F.min("changed").alias("changed"),
            F.max("run").alias("run"),
        )
        .withColumn("coverage", F.col("windows") / F.col("item_windows"))
        .where((F.col("coverage") >= SHARE) | (F.col("run") >= RUN))
        .groupBy("doc_id", "text_key", "item_id")
        .agg(F.min(F.struct("way", *columns)).alias("leak"))
        .select("doc_id", "text_key", "item_id", *(F.col(f"leak.{x}") for x in columns))
        .withColumn("kind", F.when(F.col("changed") > 0, "reparameterised").otherwise("verbatim"))
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    leaking = stored(leaks(docs, benchmark).select("text_key").distinct(), "leaking-texts")
    leaking = F.broadcast(leaking) if leaking.count() <= BROADCAST_TEXTS else leaking
    return docs.join(leaking, F.xxhash64(docs["text"]) == leaking["text_key"], "left_anti")
