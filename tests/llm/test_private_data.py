import hashlib
import math
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitelens.llm import private_data
from sitelens.llm.private_data import KINDS, personal_data

RAW = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(RAW[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((k, m.start(), m.end()))
    return out


def words(text):
    """Candidates of a text: place, value, contexts, base kind."""
    out, last, found = [], None, base(text)
    blank = "\x20\x09-\x0d"
    pattern = rf"(?<![^{blank}])[^{blank}]*[0-9@][^{blank}]*(?:\x20[().-]*[0-9][0-9().-]*(?![^{blank}]))*"
    around = private_data._AROUND
    for m in re.finditer(pattern, text or ""):
        piece = text[last or 0 : m.start()]
        edge = ["^", "^"] if last is None else ["^", "<id>"]
        last = m.end()
        before = edge + [w[-24:] for w in re.findall(rf"[^{blank}]+", piece[-64:].lower())]
        bare = m.group().rstrip(around + ".").lstrip(around)
        start = m.start() + len(m.group()) - len(m.group().lstrip(around))
        stop = start + len(bare)
        kinds = [k for k, a, b in found if a < stop and start < b]
        if bare:
            out.append((start, stop, bare.lower(), before[-1], " ".join(before[-2:]), min(kinds, default=None)))
    return out


def shaped(kind, value):
    n = len(re.sub("[^0-9]", "", value))
    return [
        "@" in value and len(value) >= 5,
        bool(re.fullmatch(r"[0-9]+([.:][0-9]+){2,}", value)),
        bool(re.fullmatch(r"[0-9\x20-]+", value)) and 12 <= n <= 19,
        bool(re.fullmatch(r"[0-9()\x20+./-]+", value)) and 7 <= n <= 15,
    ][kind]


def brute(rows):
    every = [(i, t, words(t)) for i, t in rows]
    edges = defaultdict(set)
    seeds = {}
    for _, _, found in every:
        for _, _, value, one, two, kind in found:
            if len(value) <= private_data.LONGEST:
                edges["1 " + one].add(value)
                edges["2 " + two].add(value)
                if kind is not None:
                    seeds[value] = max(kind, seeds.get(value, -1))
    taken = dict(seeds)
    for _ in range(private_data.ROUNDS):
        sure = {}
        for context, values in edges.items():
            for k in range(4):
                good = sum(taken.get(v) == k for v in values)
                maybe = sum(v not in taken and shaped(k, v) for v in values)
                share = good / (len(values) - (1 - private_data.UNKNOWN) * maybe + 1)
                if good >= private_data.SUPPORT and share >= private_data.SURE:
                    sure[context, k] = share
        scores = defaultdict(list)
        for (context, k), s in sure.items():
            for v in edges[context]:
                if v not in seeds and shaped(k, v):
                    scores[v, k].append(s)
        best = {}
        for (v, k), s in scores.items():
            best[v] = max(best.get(v, (0, 0)), (1 - math.prod(1 - min(x, 0.999) for x in s), -k))
        new = {v: -k for v, (s, k) in best.items() if s >= private_data.ACCEPT}
        taken = {**new, **seeds}
    out = []
    for i, t, found in every:
        own = base(t)
        more = [
            (new[v], a, b)
            for a, b, v, one, two, kind in found
            if kind is None and v in new and (("1 " + one, new[v]) in sure or ("2 " + two, new[v]) in sure)
        ]
        said = lambda xs: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(xs))
        counts = [sum(k == n for k, _, _ in own) for n in range(4)]
        sha = hashlib.sha256(said(own).encode()).hexdigest()
        out.append((i, *counts, sha, said(own + more), len(more)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = [
    None, "", "a@b.c+d@e.f.g@h.i", "1.2.3.4.5.6.7.8 0255.1.1.256 255.255.255.255", "x@y z@.w @ 12@3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 0000000000000000", "+1 (437) 555-0689. +12 +1234567 8",
    "é😀 mail:jo.doe@mail.example.com, ip 10.0.0.1!", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0", "+1+2 3 4 5 6 7 8 9",
    "tab\t12\n34 5\r6\x0b7\x0c8", "(555) 123-4567 89", "a.b@c-d.e- f@g.h..i",
]


def planted():
    rows = []
    for n in range(12):
        rows.append(f"please call our office phone: +1 (437) 555-{1000 + 7 * n} today")
        rows.append(f"write to the desk, mail= jo{n}@mail{n}.example.com thanks")
    for n in range(6):
        rows.append(f"another office phone: 555-{3000 + n} maybe")
        rows.append(f"the desk, mail= root{n}@localhost thanks")
        rows.append(f"in the year 19{10 + n} there were {7654321 + n} of them")
        # values that phone: found make another context stand, which finds more
        rows.append(f"reach me under 555-{3000 + n} at night")
    rows += [f"reach me under 555-{4000 + n} at night" for n in range(3)]
    rows.append("an office phone: 1990 it was")
    return rows


def test_equals_brute_force(spark, frame, prose):
    texts = ODD + planted() + [prose(i, 50) + f" {i * 7919}" for i in range(30)] + planted()[:5]
    rows = list(enumerate(texts)) + [(None, "jo@x.yz"), (3, "the id again 10.1.2.3")]
    found = personal_data(frame(*rows).repartition(3))
    assert found.columns == (
        "doc_id n_email n_ip n_card n_phone base_sha256 spans n_added".split()
    )
    assert got(found) == brute(rows)


def test_contexts_find_unseen_identifiers(spark, frame):
    texts = planted()
    found = {r.doc_id: r for r in personal_data(frame(*enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        spans = [text[int(a) : int(b)] for _, a, b in (x.split(":") for x in found[i].spans.split(",") if x)]
        if "another office phone" in text or "mail= root" in text or "reach me" in text:
            assert spans == [text.split()[3]] and found[i].n_added == 1
        elif "year" in text or text.startswith("an "):
            assert spans == []
    # seeds and the first round do not reach the last context
    once = {r.doc_id: r for r in personal_data(frame(*enumerate(texts)), rounds=1).collect()}
    late = [i for i, t in enumerate(texts) if "under 555-4" in t]
    assert late and all(once[i].n_added == 0 and found[i].n_added == 1 for i in late)


def test_clean_prose_and_empty_table(spark, frame, prose):
    clean = personal_data(frame(*((i, prose(i, 200)) for i in range(20))))
    assert {(r.spans, r.n_added) for r in clean.collect()} == {("", 0)}
    assert personal_data(frame((1, "x")).limit(0)).count() == 0


@pytest.mark.parametrize(
    "text",
    ["a" * 400_000, "1" * 400_000, "1 " * 200_000, "a@" * 200_000, "1." * 200_000, "+1 " * 130_000, "-" * 400_000 + "1",
     "a@b" + ".c" * 150_000, "jo@x.yz " * 30_000, "@" * 300_000, "1-" * 200_000 + "x", ".@." * 100_000],
    ids=lambda t: t[:6],
)
def test_long_texts(spark, frame, text):
    rows = [(1, text)]
    (row,) = personal_data(frame(*rows), rounds=1).collect()
    if text[:6] in ("aaaaaa", "111111", "1.1.1.", "------", "@@@@@@", "1-1-1-"):
        # too slow by the plain patterns: nothing of these is a span but addresses of four parts
        assert row.n_email == row.n_card == row.n_phone == 0
        assert row.n_ip == (50_000 if text[:2] == "1." else 0)
    else:
        own = base(text)
        assert row.base_sha256 == hashlib.sha256(
            ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in own).encode()
        ).hexdigest()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="a1.@+- (0\n5é", max_size=40), min_size=20, max_size=60))
def test_base_spans_of_any_text(spark, texts):
    import pyspark.sql.functions as F

    rows = list(enumerate(texts))
    scanned = spark.createDataFrame(rows, "row long, text string").select(
        "row", *(private_data._spots(F.col("text"), private_data.PATTERNS[k], F.lit(True)).alias(k) for k in KINDS)
    )
    found = private_data._located(scanned, list(KINDS))
    found = found.where(private_data.base_valid(F.col("kind"), F.col("found")))
    mine = sorted((r.row, r.kind, r.start, r.stop) for r in found.collect())
    assert mine == sorted((i, *s) for i, t in rows for s in base(t))
