"""MinHash near-duplicates with sequential Bayesian verification.

Texts become sets of five-word shingles; texts of equal sets are one class, and classes are
compared. Bands of a MinHash signature give buckets. Classes are first compared with the smallest
members of their buckets, which links a group of near copies without forming its pairs. Members of a
bucket that are still in different components are then compared with each other, block by block. A
comparison reads the signatures batch by batch and stops as soon as the posterior
chance that the similarity reaches the threshold falls below a chosen miss probability. Whatever
survives is verified on the full shingle sets; only verified links count.

Defined results: ASCII letters are lower-cased and words are runs of bytes other than blank, tab,
line feed, vertical tab, form feed and carriage return. A text of under five words is one shingle of
all its words. A null text, or one without words, has an empty set, links to nothing and is kept.
Rows with equal ids keep a row each; an id that is null never names a component, and a component
without any id has a null name. An empty table gives an empty result.

Shingles are told apart by 64-bit hashes. With 32 bands of 4 rows a pair of similarity 0.75 shares
no band with a chance of 5e-6.
"""

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import held, stored
from sitelens.llm.components import components

WORDS = 5
#: A link needs ``100 * shared >= PERCENT * all``.
PERCENT = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Signature values that are compared at a time, and the chance to miss a link by stopping early.
BATCH = 16
MISS = 1e-6
#: Members of a bucket, and their shingles, that are compared with each other at a time.
BLOCK, BLOCK_SHINGLES = 1024, 500_000
#: Members of a bucket up to which its open pairs are joined instead.
SMALL = 32
#: Texts that are looked up by a broadcast of their keys, 24 bytes each; more are joined.
BROADCAST_SETS = 1_000_000
#: Words that a worker remembers.
REMEMBERED = 100_000
#: Texts that a worker works on at once.
AT_ONCE = 256

_draw = np.random.default_rng(20_240_501)
_SCALE = _draw.integers(0, 1 << 31, HASHES, "uint32") * 2 + 1
_SHIFT = _draw.integers(0, 1 << 32, HASHES, "uint32")
_PLACE = _draw.integers(0, 1 << 63, WORDS, "uint64") * 2 + 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Shingles:
    """Sorted distinct shingle numbers of a text."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        numbers = np.fromiter(map(known.__getitem__, words), "uint64", len(words))
        if 0 < len(numbers) < WORDS:
            total = np.full(1, len(numbers), "uint64")
            for i in range(len(numbers)):
                total = _mixed(total + numbers[i : i + 1] * _PLACE[i])
            return total
        n = max(0, len(numbers) - WORDS + 1)
        total = np.zeros(n, "uint64")
        for i, by in enumerate(_PLACE):
            total += numbers[i : i + n] * by
        return np.unique(_mixed(total))


def _slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``AT_ONCE`` rows, so that few texts and sets are Python objects."""
    for part in parts:
        for at in range(0, part.num_rows, AT_ONCE):
            yield part.slice(at, AT_ONCE)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of each of ``HASHES`` hashes over the set."""
    low = (shingles >> np.uint64(16)).astype("uint32")
    best = np.full(HASHES, 0xFFFFFFFF, "uint32")
    for i in range(0, len(low), 2048):
        hashed = low[i : i + 2048] * _SCALE[:, None] + _SHIFT[:, None]
        np.minimum(best, hashed.min(axis=1), out=best)
    return best


def least_matches(miss: float = MISS, percent: int = PERCENT) -> list[tuple[int, int]]:
    """``(values compared, matches needed)`` after each batch.

    With an even prior and m matches in n values, the similarity reaches t with the chance that
    n + 1 draws of chance t succeed at most m times.
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, 0
        while (
            chance := chance + comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        ) < miss:
            m += 1
        out.append((n, m))
    return out


def signed(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text_key, n_shingles, node, sig`` of every row.

    ``node`` numbers the shingle set and is null for an empty one.
    """
    schema = "row long, doc_id long, text_key long, n_shingles long, node long, sig binary"
    fields = pa.schema(
        [(x, "int64") for x in ("row", "doc_id", "text_key", "n_shingles", "node")]
        + [("sig", "binary")]
    )

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = held("shingles", Shingles)
        for part in _slices(parts):
            counts, nodes, sigs = [], [], []
            for text in part.column(3).to_pylist():
                own = shingles(text)
                counts.append(len(own))
                if not len(own):
                    nodes.append(None)
                    sigs.append(None)
                    continue
                nodes.append(int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).view("int64")))
                sigs.append(signature(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    part.column(2),
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(sigs, pa.binary()),
                ],
                schema=fields,
            )

    keyed = docs.select(
        "row", docs["doc_id"].cast("long"), F.xxhash64(docs["text"]).alias("text_key"), "text"
    )
    return keyed.mapInArrow(rows, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(docs["text"]).alias("text_key"),
        docs["text"].alias("text"),
    )


def _matrix(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), "uint32").reshape(len(sigs), HASHES)


def _keys(sig: np.ndarray) -> np.ndarray:
    """The bucket of each row in each band."""
    sig = sig.reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype="uint64"), sig.shape[:2])
    for i in range(ROWS):
        key = _mixed(key * _MIX + sig[:, :, i])
    return key.view("int64")


def buckets(classes: DataFrame) -> DataFrame:
    """``bucket, node``: a row for each band of each class."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                key = _keys(_matrix(part["sig"].tolist()))
                yield pd.DataFrame(
                    {
                        "bucket": key.ravel(),
                        "node": np.repeat(part["node"].to_numpy(), BANDS),
                    }
                )

    return classes.select("node", "sig").mapInPandas(rows, "bucket long, node long")


def _alike(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Which pairs of signature rows are not ruled out by sizes or by any batch."""
    left = np.flatnonzero(100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb))
    matches = np.zeros(len(left), "int32")
    for n, least in least_matches():
        part = slice(n - BATCH, n)
        matches += (a[left, part] == b[left, part]).sum(axis=1, dtype="int32")
        stay = matches >= least
        left, matches = left[stay], matches[stay]
    return left


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``u, v`` that sequential comparison does not rule out."""
    of = classes.select("node", "n_shingles", "sig")
    joined = pairs
    for x in ("u", "v"):
        joined = joined.join(of.toDF(x, f"n_{x}", f"sig_{x}"), x)

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                left = _alike(
                    _matrix(part["sig_u"].tolist()),
                    _matrix(part["sig_v"].tolist()),
                    part["n_u"].to_numpy(),
                    part["n_v"].to_numpy(),
                )
                yield part[["u", "v"]].iloc[left]

    return joined.mapInPandas(rows, "u long, v long")


def _across(members: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``u, v`` between members of one large bucket that are in different components.

    ``members`` holds ``bucket, node, label``. A bucket is cut into blocks, and a task compares two
    of them, signatures first and then the full sets. A pair that shares several buckets is compared
    in the first band only. Only links leave a task, and none that a chain of them already gives.
    """
    nodes = stored(members.select("node").distinct(), "large-members")
    held = classes.select("node", "n_shingles", "sig").join(_full_sets(nodes, docs, classes), "node")
    held = stored(held, "large-sets")
    sizes = members.join(held.select("node", "n_shingles"), "node").groupBy("bucket")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES))
    sizes = sizes.agg(blocks.cast("int").alias("blocks"))
    dealt = (
        members.join(sizes, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .join(held, "node")
        .drop("blocks", "other")
    )

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node", ignore_index=True)
        sig, n = _matrix(part["sig"].tolist()), part["n_shingles"].to_numpy()
        node, own, sets = part["node"].to_numpy(), part["block"].to_numpy(), part["members"].tolist()
        _, label = np.unique(part["label"].to_numpy(), return_inverse=True)
        band = np.flatnonzero(_keys(sig[:1])[0] == key[0])[0]
        rows, same, out = sig.reshape(len(sig), BANDS, ROWS), key[1] == key[2], []
        for i in range(len(part) - 1):
            rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
            if not same:
                rest = rest[own[rest] != own[i]]
            first = (sig[rest, :BATCH] == sig[i, :BATCH]).sum(axis=1)
            rest = rest[first >= _FIRST]
            rest = rest[_alike(np.broadcast_to(sig[i], (len(rest), HASHES)), sig[rest], n[[i]], n[rest])]
            rest = rest[(rows[rest] == rows[i]).all(axis=2).argmax(axis=1) == band]
            for j in rest:
                if label[j] != label[i] and _linked(sets[i], sets[j]):
                    out.append((node[i], node[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return dealt.groupBy("bucket", "low", "high").applyInPandas(compare, "u long, v long")


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are as similar as a link asks."""
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


_FIRST = least_matches()[0][1]


def _full_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, members``: the shingle sets of ``nodes``, from the text of one document of each."""
    wanted = stored(classes.join(nodes, "node").select("node", F.col("named.*")), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_SETS else wanted
    keyed = _keyed(docs)
    same = (keyed["text_key"] == wanted["text_key"]) & keyed["doc_id"].eqNullSafe(wanted["doc_id"])

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = held("shingles", Shingles)
        for part in _slices(parts):
            found = [shingles(x).view("int64") for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "members"]
            )

    texts = keyed.join(wanted, same).select(wanted["node"], keyed["text"])
    full = stored(texts.mapInArrow(sets, "node long, members array<long>"), "full-sets")
    return full.dropDuplicates(["node"])


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``u, v`` whose full sets are as similar as a link asks."""
    pairs = stored(pairs, "plausible")
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    full = _full_sets(nodes, docs, classes)
    joined = pairs
    for x in ("u", "v"):
        joined = joined.join(full.toDF(x, f"set_{x}"), x)
    shared = F.size(F.array_intersect("set_u", "set_v"))
    union = F.size("set_u") + F.size("set_v") - F.col("shared")
    found = joined.withColumn("shared", shared)
    return found.where(F.col("shared") * 100 >= union * PERCENT).select("u", "v")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """``bucket, node, label`` with the component that ``links`` put each member in."""
    return members.join(components(links), "node", "left").select(
        "bucket", "node", F.coalesce("label", "node").alias("label")
    )


def _open(labelled: DataFrame) -> DataFrame:
    """``bucket, head, head_label, size`` of the buckets that hold more than one component."""
    spans = labelled.groupBy("bucket").agg(
        F.min(F.struct("node", "label")).alias("first"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.count("*").alias("size"),
    )
    return spans.where("low < high").select(
        "bucket", F.col("first.node").alias("head"), F.col("first.label").alias("head_label"), "size"
    )


def links_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Verified links ``u, v`` between classes, enough of them to join every component.

    A class is compared with the smallest class that it shares a bucket with; then members of still
    open buckets with their bucket's smallest; then whatever is open with each other.
    """
    band = stored(buckets(classes), "buckets")
    heads = band.groupBy("bucket").agg(F.min("node").alias("u"), F.max("node").alias("last"))
    members = stored(
        band.join(heads.where("u < last").select("bucket", "u"), "bucket"), "bucket-members"
    )
    tried = stored(
        members.groupBy(F.col("node").alias("v")).agg(F.min("u").alias("u")).where("u < v"), "stars"
    )
    links = stored(_verified(_plausible(tried, classes), docs, classes), "star-links")
    labelled = stored(_labelled(members.select("bucket", "node"), links), "bucket-labels")
    more = (
        labelled.join(_open(labelled), "bucket")
        .where("label != head_label")
        .select(F.col("head").alias("u"), F.col("node").alias("v"))
        .distinct()
        .join(tried, ["u", "v"], "left_anti")
    )
    more = stored(more, "more-stars")
    found = _verified(_plausible(more, classes), docs, classes)
    links = stored(links.unionByName(found), "more-links")
    tried = tried.unionByName(more)
    labelled = stored(_labelled(labelled.select("bucket", "node"), links), "more-labels")
    open_ = stored(labelled.join(_open(labelled).select("bucket", "size"), "bucket"), "open")
    small = open_.where(F.col("size") <= SMALL)
    pairs = (
        small.alias("a")
        .join(small.alias("b"), "bucket")
        .where("a.node < b.node and a.label != b.label")
        .select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))
        .distinct()
        .join(tried, ["u", "v"], "left_anti")
    )
    found = _verified(_plausible(pairs, classes), docs, classes)
    large = open_.where(F.col("size") > SMALL).drop("size")
    if large.isEmpty():
        return links.unionByName(found)
    return links.unionByName(found).unionByName(_across(large, docs, classes))


def _placed(docs: DataFrame) -> DataFrame:
    """``row, doc_id, n_shingles, label`` of every row of ``docs`` (``row, doc_id, text``)."""
    rows = stored(signed(docs), "signed")
    classes = stored(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.first("n_shingles").alias("n_shingles"),
            F.first("sig").alias("sig"),
            F.min(F.struct("doc_id", "text_key")).alias("named"),
        ),
        "classes",
    )
    label = components(links_of(docs, classes))
    placed = rows.join(label, "node", "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("label", "node").alias("label")
    )
    return stored(placed, "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, label`` of every row of ``docs``.

    ``component_id`` is the smallest id of the component; ``label`` numbers the component, and is
    null for an empty set.
    """
    placed = _placed(docs.select(F.lit(0).cast("long").alias("row"), "doc_id", "text"))
    smallest = placed.groupBy("label").agg(F.min("doc_id").alias("smallest"))
    component = F.coalesce("smallest", "doc_id")
    return placed.join(stored(smallest, "smallest"), "label", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "label",
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns; rows with an empty set stay.

    The row of the smallest id stays, of repeated rows one. The numbered rows are written once, so
    that nothing depends on ``docs`` being read twice in the same splits.
    """
    number = "_row"
    while number in docs.columns:
        number += "_"
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    placed = _placed(numbered.select(F.col(number).alias("row"), "doc_id", "text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    stays = stored(placed.groupBy("label").agg(first).select("label", "first.row"), "staying")
    stays = stays.withColumnRenamed("row", "stays")
    gone = placed.join(stays, "label").where("row != stays").select(F.col("row").alias(number))
    gone = stored(gone, "leaving")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_SETS else gone
    return numbered.join(gone, number, "left_anti").drop(number)
