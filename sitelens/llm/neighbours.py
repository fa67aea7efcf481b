"""Approximate nearest neighbours along shifted space-filling curves.

Unit vectors are centred and rotated at random for each curve; some coordinates are shifted, cut to
whole numbers by the range of a sample, and become a place on a Hilbert curve. Spark
range-partitions each curve by place, so every vector gets a rank there. Windows of ranks around
each query are read, their vectors are compared exactly, and the windows' best are merged.

How many ranks are read is measured: some queries are compared with every vector, and windows are
widened, then more of them read, until enough of the true nearest would have been met.

Parallel vectors, equal ones included, are one numbered entry of the index with its smallest ids, so
a direction that a third of all rows share is neither a large window nor many candidates.

Scores are computed one way for every candidate, from the original vectors, and kept to 13 decimals,
below which sums of doubles differ by their order only; 1 is the largest. So vectors of equal
cosine tie, whatever their lengths, and of a window's ties those with the smallest ids are kept.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component takes no
part; vectors of other lengths are separate indexes; rows with equal ids are rows of their own, but
no neighbours of each other, and ask once if their vectors are parallel too; a row without an id
takes no part. Fewer candidates than asked for give fewer rows, an empty table none. Other columns
of the table are left out, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import stored

#: Curves, coordinates and bits of each curve.
CURVES, AXES, BITS = 24, 8, 7
#: Ranks in the narrowest and widest window; a query reads its own window and ones on both sides.
WINDOW, WIDEST = 1024, 16_384
#: Recall that a search must reach, two standard errors below what a sample of queries finds.
RECALL = 0.9
#: Queries, at most, of which the recall is measured.
SAMPLE = 256
#: Vectors at most that fit centre and widths of an index.
FIT_ROWS = 4096
#: Decimals of a score, of a direction that parallel vectors share, and what a product may be off.
DECIMALS, SAME, SLACK = 13, 1e12, 1e-9


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"])
    return rows.where("vec_id is not null and embedding is not null").where(finite & some)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole coordinates below 2**bits.

    Works down from the highest bit: the state of a row is how its cube is turned, kept by turning
    the lower bits of its coordinates.
    """
    x = cells.astype("int64").T.copy()
    axes = len(x)
    for bit in range(bits - 1, 0, -1):
        mask = 1 << bit
        low = mask - 1
        for i in range(axes):
            upper = (x[i] & mask) > 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


class Fitted:
    """Centre, and the curves' directions, shifts and widths, for vectors of one length."""

    def __init__(self, sample: np.ndarray):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.centre = unit.mean(axis=0)
        size = unit.shape[1]
        random = np.random.default_rng(size)
        self.curves = []
        for _ in range(CURVES):
            turn, _ = np.linalg.qr(random.normal(size=(size, size)))
            axes = turn[:, :AXES]
            at = (unit - self.centre) @ axes
            low, high = at.min(axis=0), at.max(axis=0)
            width = np.where(high > low, high - low, 1) * 1.5
            self.curves.append((axes, low - random.random(len(low)) * width / 3, width))

    def places(self, vectors: np.ndarray) -> Iterator[np.ndarray]:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True) - self.centre
        top = (1 << BITS) - 1
        for axes, low, width in self.curves:
            cells = np.clip((unit @ axes - low) / width * (top + 1), 0, top)
            yield hilbert(cells, BITS)


def _fit(entries: DataFrame) -> dict[int, Fitted]:
    """An index for each length of vector, from at most ``FIT_ROWS`` vectors of it."""
    drawn = _drawn(entries, FIT_ROWS).select("dims", "embedding").toPandas()
    return {
        int(dims): Fitted(np.array(part["embedding"].tolist(), dtype="float64"))
        for dims, part in drawn.groupby("dims")
    }


def _ranked(entries: DataFrame, fitted: dict[int, Fitted]) -> DataFrame:
    """``curve, entry, rank``: the rank of every entry on every curve."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for dims, own in part.groupby("dims"):
                vectors = np.array(own["embedding"].tolist(), dtype="float64")
                for curve, place in enumerate(fitted[int(dims)].places(vectors)):
                    yield pd.DataFrame(
                        {"dims": dims, "curve": curve, "place": place, "entry": own["entry"]}
                    )

    placed = entries.select("dims", "entry", "embedding").mapInPandas(
        rows, "dims int, curve int, place long, entry long"
    )
    # the sample that cuts the ranges reads its input as well
    placed = stored(placed, "curve-places")
    order = ["dims", "curve", "place", "entry"]
    cut = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = cut.withColumn("at", F.monotonically_increasing_id())
    cut = stored(cut.withColumn("part", F.spark_partition_id()), "curve-order")
    parts = cut.groupBy("dims", "curve", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    upto = Window.partitionBy("dims", "curve").orderBy("part")
    before = F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("dims", "curve", "part", "first", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("at") - F.col("first")
    return cut.join(F.broadcast(parts), ["dims", "curve", "part"]).select(
        "dims", "curve", "entry", rank.alias("rank")
    )


def _true_nearest(entries: DataFrame, top: int) -> dict[int, dict[int, list[int]]]:
    """Of each length of vector, some queries and their nearest entries among all."""
    long = entries.groupBy("dims").count().where(F.col("count") > 2 * WINDOW).select("dims")
    drawn = _drawn(entries.where("asks").join(F.broadcast(long), "dims"), SAMPLE)
    drawn = drawn.select("dims", "entry", "embedding").toPandas()
    if not len(drawn):
        return {}
    sample = {}
    for dims, own in drawn.groupby("dims"):
        vectors = np.array(own["embedding"].tolist(), dtype="float64")
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        sample[int(dims)] = own["entry"].to_numpy(), vectors
    shared = entries.sparkSession.sparkContext.broadcast(sample)

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for dims, own in part.groupby("dims"):
                if dims not in shared.value:
                    continue
                query, asked = shared.value[dims]
                vectors = np.array(own["embedding"].tolist(), dtype="float64")
                vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
                score, entry = asked @ vectors.T, own["entry"].to_numpy()
                score[query[:, None] == entry] = -2
                n = min(top, len(entry))
                best = np.argpartition(-score, n - 1, axis=1)[:, :n]
                yield pd.DataFrame(
                    {
                        "dims": dims,
                        "query": np.repeat(query, n),
                        "entry": entry[best].ravel(),
                        "score": np.take_along_axis(score, best, 1).ravel(),
                    }
                )

    found = entries.select("dims", "entry", "embedding").mapInPandas(
        rows, "dims int, query long, entry long, score double"
    )
    best = _at_most(found.where("query != entry"), ["dims", "query"], [F.desc("score"), "entry"], top)
    out: dict[int, dict[int, list[int]]] = {}
    for x in best.collect():
        out.setdefault(x["dims"], {}).setdefault(x["query"], []).append(x["entry"])
    return out


def _met(ranks: dict[int, np.ndarray], truth: dict[int, list[int]], width: int, reach: int) -> np.ndarray:
    """Of each sampled query, the share of its nearest that windows on some curve hold."""
    shares = []
    for query, near in truth.items():
        at = np.array([ranks[x] for x in near]) // width
        shares.append((np.abs(at - ranks[query] // width) <= reach).any(axis=1).mean())
    return np.array(shares)


def widths(entries: DataFrame, ranked: DataFrame, top: int) -> dict[int, tuple[int, int, float]]:
    """Of each length of vector: ranks in a window, windows read on each side, recall measured."""
    out = {}
    truth = _true_nearest(entries, top)
    wanted = sorted({(d, x) for d, own in truth.items() for q, near in own.items() for x in (q, *near)})
    if not wanted:
        return out
    few = entries.sparkSession.createDataFrame(wanted, "dims int, entry long")
    found = ranked.join(F.broadcast(few), ["dims", "entry"]).toPandas()
    counts = {x["dims"]: x["n"] for x in ranked.groupBy("dims").agg(F.max("rank").alias("n")).collect()}
    for dims, own in found.groupby("dims"):
        own = own.sort_values(["entry", "curve"])
        ranks = {int(entry): part["rank"].to_numpy() for entry, part in own.groupby("entry")}
        width, reach = WINDOW, 1
        while True:
            met = _met(ranks, truth[int(dims)], width, reach)
            error = met.std() / np.sqrt(len(met))
            if met.mean() - 2 * error >= RECALL or width * reach > counts[dims]:
                break
            if 2 * width <= WIDEST:
                width *= 2
            else:
                reach *= 2
        out[int(dims)] = width, reach, float(met.mean())
    return out


def cosines(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Cosine of each row with a vector, the same for a pair in whatever company it is computed."""
    length = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((one * one).sum())
    return np.clip(np.round((rows * one).sum(axis=1) / length, DECIMALS), -1, 1)


def _best(top: int):
    schema = "query long, entry long, score double"

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        given = np.array(part["embedding"].tolist(), dtype="float64")
        vectors = given / np.sqrt((given * given).sum(axis=1, keepdims=True))
        entry, kin, low = (part[x].to_numpy() for x in ("entry", "kin", "low"))
        own = np.flatnonzero(part["holds"].to_numpy())
        asking = np.flatnonzero(part["asks"].to_numpy())
        alone = len(np.unique(kin[own])) == len(own)
        out = []
        for i in asking if len(own) else ():
            some = own
            if alone and len(own) > 2 * top:
                score = vectors[own] @ vectors[i]
                some = own[score >= np.partition(score, -2 * top)[-2 * top] - SLACK]
            score = cosines(given[some], given[i])
            best = np.lexsort((entry[some], low[some], -score))
            if not alone:  # entries of one id alone, of which no query needs more than ``top``
                same = kin[some[best]]
                best = best[(pd.Series(same).groupby(same).cumcount() < top).to_numpy()]
            best = best[: 2 * top]
            out.append(pd.DataFrame({"query": entry[i], "entry": entry[some[best]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "entry": [], "score": []})

    return compare, schema


def _direction(vector: Column) -> Column:
    """What parallel vectors share: the unit vector in whole steps, by way of the largest component."""
    largest = F.array_max(F.transform(vector, F.abs)).cast("double")
    scaled = F.transform(vector, lambda x: x.cast("double") / largest)
    length = F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda total, x: total + x * x))
    return F.transform(scaled, lambda x: F.rint(x / length * SAME).cast("long"))


def _entries(rows: DataFrame) -> DataFrame:
    """``entry, key, key2, embedding, dims, asks, low, kin``: a row for each class of parallel vectors.

    Entries are numbered in the order of their hashes and hold the vector of their smallest id,
    ``low``. ``kin`` is shared by entries whose rows all have the same one id.
    """
    same = ["key", "key2"]
    one = F.when(F.col("low") == F.col("high"), F.xxhash64(F.lit(0), "low"))
    classes = rows.groupBy(*same).agg(
        F.min_by("embedding", F.struct("vec_id", "embedding")).alias("embedding"),
        F.max("asked").alias("asks"),
        F.min("vec_id").alias("low"),
        F.max("vec_id").alias("high"),
    )
    classes = stored(
        classes.select(
            *same,
            "embedding",
            F.size("embedding").alias("dims"),
            "asks",
            "low",
            F.coalesce(one, F.xxhash64(F.lit(1), *same)).alias("kin"),
        ),
        "classes",
    )
    ordered = classes.repartitionByRange(*same).sortWithinPartitions(*same)
    return stored(ordered.withColumn("entry", F.monotonically_increasing_id()), "entry-vectors")


def _at_most(rows: DataFrame, of: list[str], order: list, most: int) -> DataFrame:
    """Of the rows that agree in ``of``, the first ``most``."""
    place = F.row_number().over(Window.partitionBy(*of).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= most).drop("place")


def _drawn(entries: DataFrame, most: int) -> DataFrame:
    """Of each length of vector, ``most`` entries by chance, or all if there are fewer.

    A first draw by hash leaves about twice as many of a length, so that few rows are ranked.
    """
    counts = entries.groupBy("dims").agg(F.count("*").alias("n"))
    ticket = F.pmod(F.xxhash64(F.lit(1), "entry"), F.lit(1 << 40)) / float(1 << 40)
    few = entries.withColumn("ticket", ticket).join(F.broadcast(counts), "dims")
    few = few.where(F.col("ticket") * F.col("n") <= 2 * most)
    return _at_most(few, ["dims"], ["ticket", "entry"], most).drop("ticket", "n")


def nearest(vectors: DataFrame, asked, top: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``top`` nearest found of every row where ``asked``.

    ``asked`` is a condition on ``vec_id``. Nearness is the cosine of the original vectors.
    """
    rows = usable(vectors).withColumn("direction", _direction(F.col("embedding")))
    rows = rows.select(
        "vec_id",
        "embedding",
        F.xxhash64("direction").alias("key"),
        F.xxhash64(F.lit(1), F.reverse("direction")).alias("key2"),
        asked.alias("asked"),
    )
    rows = stored(rows, "vectors")
    same = ["key", "key2"]
    entries = _entries(rows)
    # a query passes over rows of its own id, so of one id ``top`` are enough, of all twice as many
    ids = _at_most(rows.select("vec_id", *same), [*same, "vec_id"], ["vec_id"], top)
    ids = _at_most(ids, same, ["vec_id"], 2 * top)
    named = stored(ids.join(entries.select("entry", *same), same).select("entry", "vec_id"), "entries")
    ranked = stored(_ranked(entries, _fit(entries)), "ranks")
    chosen = [(dims, *x[:2]) for dims, x in widths(entries, ranked, top).items()]
    chosen = entries.sparkSession.createDataFrame(chosen, "dims int, width long, reach long")
    width, reach = F.coalesce("width", F.lit(WINDOW)), F.coalesce("reach", F.lit(1))
    placed = (
        ranked.join(F.broadcast(chosen), "dims", "left")
        .withColumn("window", F.floor(F.col("rank") / width))
        .withColumn("reach", reach)
        .join(entries.drop("dims"), "entry")
    )
    beside = F.explode(F.sequence(F.col("window") - F.col("reach"), F.col("window") + F.col("reach")))
    held = placed.withColumn("holds", F.lit(True)).withColumn("asks", F.lit(False))
    asking = placed.where("asks").withColumn("window", beside).withColumn("holds", F.lit(False))
    columns = ["dims", "curve", "window", "entry", "embedding", "low", "kin", "asks", "holds"]
    compare, schema = _best(top)
    found = (
        held.select(*columns)
        .unionByName(asking.select(*columns))
        .groupBy("dims", "curve", "window")
        .applyInPandas(compare, schema)
        .groupBy("query", "entry")
        .agg(F.max("score").alias("score"))
    )
    listed = found.join(named, "entry").select(F.col("query").alias("entry"), "vec_id", "score")
    nearest_first = [F.desc("score"), "vec_id"]
    listed = _at_most(listed, ["entry", "vec_id"], nearest_first, top)
    listed = stored(_at_most(listed, ["entry"], nearest_first, 2 * top), "candidates")
    queries = rows.where("asked").select(F.col("vec_id").alias("query_id"), *same).distinct()
    queries = queries.join(entries.select(*same, "entry"), same).select("query_id", "entry")
    own = Window.partitionBy("query_id", "entry").orderBy(*nearest_first)
    return (
        queries.join(listed, "entry")
        .where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
