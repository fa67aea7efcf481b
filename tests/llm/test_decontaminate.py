from sitelens.llm.decontaminate import leaks, uncontaminated

QUESTION = (
    "A farmer named Alice Smith sold 24 crates of apples for 12 dollars each before noon. Then the "
    "helper of Alice Smith carried 24 more crates across 3 miles to the market near Springfield."
)
OTHER = (
    "A farmer named Bob sold 31 crates of apples for 15 euros each before noon. Then the "
    "helper of Bob carried 31 more crates across 7 km to the market near Shelbyville."
)
# the numbers and names that were one are two here
BROKEN = (
    "A farmer named Bob sold 31 crates of apples for 31 euros each before noon. Then the "
    "helper of Carol carried 77 more crates across 31 km to the market near Bob."
)


def items(spark, *rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, lang string")


def found(docs, bench):
    return {(r.doc_id, r.item_id): r for r in leaks(docs, bench).collect()}


def test_verbatim_and_reparameterised(spark, frame, prose):
    bench = items(spark, (1, QUESTION), (2, prose(900, 40)), (3, None), (None, prose(901)), (4, ""))
    docs = frame(
        (1, prose(1) + "\n" + QUESTION + "\n" + prose(2)),
        (2, prose(3) + "\n" + OTHER),
        (3, prose(4) + "\n" + BROKEN),
        (4, prose(5, 3000)),
        (5, prose(6) + " " + prose(900, 40) + " " + QUESTION),
        (6, None),
        (7, ""),
        (8, prose(901)),
        (1, prose(7)),
        (None, QUESTION),
    )
    got = found(docs, bench)
    assert set(got) == {(1, 1), (2, 1), (5, 1), (5, 2), (None, 1)}
    assert got[1, 1].kind == "verbatim" and got[2, 1].kind == "reparameterised"
    assert got[2, 1].changed > 0 and got[1, 1].changed == 0
    assert got[5, 2].coverage > 0.9


def test_windows_against_brute_force(spark, frame, prose):
    """Without slots a leak is the share of an item's eight-word windows that a document holds."""
    import re

    passages = [re.sub("[A-Z]", lambda m: m[0].lower(), prose(i, 30)) for i in range(6)]
    texts = [
        prose(50 + i, 80) + ". " + " ".join(passages[i % 6].split()[: 9 + 3 * (i % 8)]) for i in range(30)
    ]

    def windows(text):
        words = re.findall(r"[^\W\d_]+", text.lower())
        return {tuple(words[i : i + 8]) for i in range(len(words) - 7)}

    want = {
        (d, i)
        for d, t in enumerate(texts)
        for i, p in enumerate(passages)
        if len(windows(t) & windows(p)) >= 0.4 * len(windows(p))
    }
    docs = frame(*enumerate(texts))
    assert set(found(docs, items(spark, *enumerate(passages)))) == want and want


def test_broadcast_and_join_agree(spark, frame, prose, monkeypatch):
    from sitelens.llm import decontaminate

    bench = items(spark, (1, QUESTION))
    docs = frame((1, QUESTION), (2, prose(1)))
    few = set(found(docs, bench))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert set(found(docs, bench)) == few == {(1, 1)}


def test_short_item_is_one_window(spark, frame):
    assert set(found(frame((1, "so it begins here"), (2, "so it ends")), items(spark, (1, "So it begins here.")))) == {(1, 1)}


def test_long_passage_and_short_items(spark, frame, prose):
    long = prose(31, 200).lower()
    bench = items(spark, (1, long), (2, "So it begins here."), (3, "Is 7 of 12?"), (4, "Yes."))
    docs = frame(
        (1, prose(32) + ". " + " ".join(long.split()[90:120]) + ". " + prose(33)),
        (2, prose(34) + " and so it begins here, " + prose(35)),
        (3, prose(36) + " so it begins " + prose(37)),
        (4, prose(38) + ". Is 7 of 12? " + prose(39)),
        (5, prose(40) + ". Is 8 of 13, yes? " + prose(41)),
        (6, "yes"),
    )
    assert set(found(docs, bench)) == {(1, 1), (2, 2), (4, 3), (6, 4)}


def test_light_edits(spark, frame, prose):
    import re

    item = "The old mill stands by Mary Ann. Every wheel turns at dawn. Nobody knows why it is so."
    bare = re.sub("[.]", "", item)
    docs = frame(
        (1, prose(1) + " " + bare + " " + prose(2)),
        (2, prose(3) + ". " + item.title() + " " + prose(4)),
        (3, prose(5) + ". " + item.upper() + " " + prose(6)),
        (4, prose(7, 400)),
    )
    assert set(found(docs, items(spark, (1, item)))) == {(1, 1), (2, 1), (3, 1)}


def test_stage_keeps_the_rest(spark, frame, prose):
    docs = frame((1, QUESTION), (2, prose(1)), (2, prose(1)), (3, None), (None, ""))
    got = uncontaminated(docs, items(spark, (1, QUESTION)))
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["2", "2", "3", "None"]


def test_empty(spark, frame):
    assert leaks(frame(), items(spark, (1, QUESTION))).count() == 0
    assert leaks(frame((1, QUESTION)), items(spark)).count() == 0
