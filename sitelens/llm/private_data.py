"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Four kinds have base patterns: e-mail and IP addresses, card and phone numbers. Their spans are seeds.
A candidate is a word with a digit or an at-sign, with the words of digits that follow it; its
contexts are the word before it, and the two words before it. Contexts and candidate values form a
graph. In each round a context gets a confidence for each kind: the share of accepted values of the
kind among its values, where values of other kinds and shapes count whole, and values that may be of
the kind count by a third, with one doubt added. Contexts with enough accepted values and confidence
stand; a value of the kind's wider shape is accepted when the contexts it occurs in are together sure
enough, and supports contexts in the next round. Occurrences of accepted values in contexts that
stand are added to the base spans.

Everything is DataFrame functions. A text is read once: a pattern's matches and the pieces between
them give each match's place by running sums of lengths, so a span needs no text again. Patterns are
written so that no text makes them slow: runs are possessive, and begin where no run goes on.

Defined results: a null text is empty and has no spans. Every row is a document, whatever its id.
Places are code points, ends exclusive. Base spans of different kinds may overlap; added ones overlap
no base span. Counts by kind are of base spans; ``n_added`` counts the others. A context is read from
the 64 characters before a candidate, or fewer up to the candidate before it, and of each word the
last 24. An empty table has an empty result. Other columns are ignored, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import stored
from sitelens.operators.sizing import is_small, sized_join_side

KINDS = ("email", "ip", "card", "phone")

_BLANK = r"\x20\x09-\x0D"
# The base patterns. What may come before a run is said so that a run is tried once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_CANDIDATE = (
    rf"(?<![^{_BLANK}])[^{_BLANK}0-9@]*+[0-9@][^{_BLANK}]*+"
    rf"(?:\x20[().-]*+[0-9][0-9().-]*+(?![^{_BLANK}]))*+"
)
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
#: Signs around a word that are no part of it.
_AROUND = "\"'`“”‘’«»<>[]{}*#:;,!?$%&|=~_"

ROUNDS = 3
#: Accepted values that a context needs, and its least confidence.
SUPPORT, SURE = 3, 0.7
#: Weight of a value that may be of the kind, and least confidence of a value.
UNKNOWN, ACCEPT = 1 / 3, 0.8
#: Characters of a candidate, at most; a longer word is no identifier.
LONGEST = 64


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether up to 19 digits have the check digit of card numbers."""
    padded = F.lpad(digits, 19, "0")

    def add(total, i):
        digit = padded.substr(i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.lit(19)), F.lit(0), add)
    return total % 10 == 0


def base_valid(kind: Column, text: Column) -> Column:
    """Whether a base pattern's match passes its test."""
    digits = _digits(text)
    count = F.length(digits)
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, text.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == 2, count.between(16, 19) & passes_luhn(F.when(count <= 19, digits)))
        .when(kind == 3, count.between(8, 15))
        .otherwise(F.lit(False))
    )


def may_be(kind: int, value: Column) -> Column:
    """Whether a value has the wider shape that contexts may find for a kind."""
    count = F.length(_digits(value))
    if kind == 0:
        return F.contains(value, F.lit("@")) & (F.length(value) >= 5)
    if kind == 1:
        return value.rlike(r"^[0-9]++(?:[.:][0-9]++){2,}+$")
    if kind == 2:
        return value.rlike(r"^[0-9\x20-]++$") & count.between(12, 19)
    return value.rlike(r"^[0-9()\x20+./-]++$") & count.between(7, 15)


def _spots(text: Column, pattern: str, guard: Column) -> Column:
    """Matches of a pattern, each with the length and the end of the piece before it."""
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(
        F.transform(pieces, F.length).alias("gap"),
        F.transform(pieces, lambda x: F.right(x, F.lit(64))).alias("tail"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
    )
    return F.when(guard, F.filter(zipped, lambda x: x["found"].isNotNull()))


def _located(scanned: DataFrame, kinds: list[str]) -> DataFrame:
    """``row, kind, pos, start, stop, found, tail`` of all matches of some patterns."""
    each = F.array(*(F.struct(F.lit(n).alias("kind"), F.col(k).alias("spots")) for n, k in enumerate(kinds)))
    rows = scanned.select("row", F.inline(each)).select("row", "kind", F.posexplode("spots").alias("pos", "x"))
    rows = rows.select("row", "kind", "pos", "x.gap", "x.tail", "x.found", F.length("x.found").alias("size"))
    so_far = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.col("size")).over(so_far) - F.col("size")
    return rows.select(
        "row", "kind", "pos", start.alias("start"), (start + F.col("size")).alias("stop"), "found", "tail"
    )


def _touching(spans: DataFrame) -> DataFrame:
    """Spans with a row for each block of 64 characters that they touch."""
    blocks = F.sequence(F.shiftright("start", 6), F.shiftright(F.col("stop") - 1, 6))
    return spans.withColumn("block", F.explode(blocks))


def candidates(scanned: DataFrame, base: DataFrame) -> DataFrame:
    """``row, start, stop, value, one, two, kind``: words that may be identifiers, their contexts,
    and the kind of a base span that they overlap."""
    rows = _located(scanned, ["words"])
    bare = F.ltrim(F.rtrim("found", F.lit(_AROUND + ".")), F.lit(_AROUND))
    left = F.length(F.ltrim("found", F.lit(_AROUND)))
    start = F.col("start") + F.length("found") - left
    before = F.transform(
        F.regexp_extract_all(F.lower("tail"), F.lit(rf"[^{_BLANK}]+"), F.lit(0)),
        lambda x: F.right(x, F.lit(24)),
    )
    # before the first word of a piece stands the candidate before it, or the text begins
    edge = F.when(F.col("pos") == 0, F.array(F.lit("^"), F.lit("^"))).otherwise(
        F.array(F.lit("^"), F.lit("<id>"))
    )
    before = F.concat(edge, before)
    rows = rows.select(
        "row", start.alias("start"), (start + F.length(bare)).alias("stop"), F.lower(bare).alias("value"),
        F.element_at(before, -1).alias("one"),
        F.concat_ws(" ", F.element_at(before, -2), F.element_at(before, -1)).alias("two"),
    ).where(F.length("value") > 0)
    rows = stored(rows, "candidates")
    near = _touching(rows.select("row", "start", "stop")).alias("c").join(
        _touching(base.select("row", "kind", "start", "stop")).alias("b"), ["row", "block"]
    )
    over = near.where("c.start < b.stop and b.start < c.stop").groupBy("row", "c.start").agg(
        F.min("kind").alias("kind")
    )
    return stored(rows.join(over, ["row", "start"], "left"), "labelled-candidates")


def _looked_up(rows: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(sized_join_side(side, is_small(side)), on)


def graph(words: DataFrame) -> DataFrame:
    """Edges ``context, value, kind, shapes``: the value's base kind (-1 for none), and the kinds
    whose wider shape it has, as bits."""
    shapes = sum((F.when(may_be(k, F.col("value")), 1 << k).otherwise(0) for k in range(4)), F.lit(0))
    contexts = F.array(F.concat(F.lit("1 "), "one"), F.concat(F.lit("2 "), "two"))
    values = words.where(F.length("value") <= LONGEST)
    return values.select(
        F.explode(contexts).alias("context"), "value", F.coalesce("kind", F.lit(-1)).alias("kind"), shapes.alias("shapes")
    ).groupBy("context", "value").agg(F.max("kind").alias("kind"), F.max("shapes").alias("shapes"))


def context_scores(edges: DataFrame, accepted: DataFrame) -> DataFrame:
    """``context, kind, sure`` of contexts that stand, given accepted ``value, kind, known``."""
    known = edges.select("context", "value", "shapes").join(
        accepted.select("value", "kind"), "value", "left"
    )
    good = [F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"g{k}") for k in range(4)]
    open_ = [
        F.sum(F.when(F.col("kind").isNull() & (F.col("shapes").bitwiseAND(1 << k) != 0), 1).otherwise(0)).alias(f"o{k}")
        for k in range(4)
    ]
    sums = known.groupBy("context").agg(F.count("*").alias("n"), *good, *open_)
    # values that are neither accepted nor possible speak against the kind
    share = lambda k: F.col(f"g{k}") / (F.col("n") - (1 - UNKNOWN) * F.col(f"o{k}") + 1)
    each = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"g{k}").alias("good"), share(k).alias("sure")) for k in range(4)))
    return sums.select("context", F.inline(each)).where((F.col("good") >= SUPPORT) & (F.col("sure") >= SURE)).drop("good")


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Contexts that stand after some rounds, and the values that they accepted.

    ``context, kind, sure`` and ``value, kind, sure``; values of base spans are not among the latter.
    """
    edges = stored(edges, "edges")
    seeds = edges.where("kind >= 0").groupBy("value").agg(F.max("kind").alias("kind"))
    seeds = stored(seeds, "seeds")
    accepted = seeds
    unknown = edges.where("shapes != 0").join(seeds, "value", "left_anti")
    for _ in range(rounds):
        contexts = stored(context_scores(edges, accepted), "contexts")
        named = _looked_up(unknown.select("context", "value", "shapes"), contexts, ["context"])
        named = named.where("(shapes & shiftleft(1, kind)) != 0")
        doubt = F.sum(F.log(1 - F.least("sure", F.lit(0.999))))
        scored = named.groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("sure"))
        best = scored.groupBy("value").agg(F.max(F.struct("sure", -F.col("kind"))).alias("x"))
        found = best.select("value", (-F.col("x.col2")).cast("int").alias("kind"), "x.sure")
        found = stored(found.where(F.col("sure") >= ACCEPT), "accepted")
        accepted = seeds.unionByName(found.select("value", "kind"))
    return contexts, found


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """A row for each document, with its base spans counted and hashed, and all spans."""
    text = F.coalesce(docs["text"], F.lit(""))
    digit = text.rlike("[0-9]")
    at = F.contains(text, F.lit("@"))
    guards = {"email": at, "ip": digit, "card": digit, "phone": F.contains(text, F.lit("+"))}
    scanned = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        *(_spots(text, PATTERNS[k], guards[k]).alias(k) for k in KINDS),
        _spots(text, _CANDIDATE, digit | at).alias("words"),
    )
    scanned = stored(scanned, "scanned")
    base = _located(scanned, list(KINDS))
    base = base.where(base_valid(F.col("kind"), F.col("found"))).select("row", "kind", "start", "stop")
    base = stored(base, "base-spans")
    words = candidates(scanned, base)
    contexts, values = bootstrap(graph(words), rounds)
    unknown = words.where("kind is null").drop("kind")
    named = _looked_up(unknown, values.select("value", "kind"), ["value"])
    both = named.withColumn(
        "context", F.explode(F.array(F.concat(F.lit("1 "), "one"), F.concat(F.lit("2 "), "two")))
    )
    added = _looked_up(both, contexts.select("context", "kind"), ["context", "kind"])
    added = added.select("row", "kind", "start", "stop").distinct()
    every = base.withColumn("base", F.lit(True)).unionByName(added.withColumn("base", F.lit(False)))
    listed = every.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", "stop", "base"))).alias("x")
    )
    names = F.array(*map(F.lit, KINDS))
    said = lambda xs: F.array_join(
        F.transform(xs, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["stop"])), ","
    )
    own = F.coalesce("x", F.expr("array()").cast("array<struct<kind:int,start:bigint,stop:bigint,base:boolean>>"))
    result = scanned.select("row", "doc_id").join(listed, "row", "left").withColumn("x", own)
    of_base = F.filter("x", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(of_base, lambda x: x["kind"] == kind))
    return result.select(
        "doc_id",
        *(count(n).cast("long").alias(f"n_{k}") for n, k in enumerate(KINDS)),
        F.sha2(said(of_base), 256).alias("base_sha256"),
        said(F.col("x")).alias("spans"),
        (F.size("x") - F.size(of_base)).cast("long").alias("n_added"),
    )
