import random
import re

from termtide.llm import neardup


def brute(rows, percent=85):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    label = list(range(len(rows)))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    moved = True
    while moved:
        moved = False
        for i, j in links:
            m = min(label[i], label[j], key=lambda x: rows[x][0])
            moved |= label[i] != m or label[j] != m
            label[i] = label[j] = m
    return sorted((r[0], len(s), rows[c][0], rows[c][0] == r[0]) for r, s, c in zip(rows, sets, label, strict=True))


def corpus():
    rnd = random.Random(5)
    vocab = [f"w{i}é" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one\ttwo"), (5, "one two three")]
    for _ in range(12):
        base = rnd.choices(vocab, k=rnd.randint(30, 120))
        for _ in range(9):
            own = list(base)
            for _ in range(rnd.randint(0, 4)):
                own[rnd.randrange(len(own))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(own)))
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", neardup.F.lit("x")).withColumn("node", neardup.F.lit(1)).withColumn("mark", neardup.F.lit(1))
    got = sorted(tuple(r) for r in neardup.near_duplicates(docs).collect())
    assert got == brute(rows)
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [g[0] for g in got if g[3]]
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", 0)
    assert sorted(tuple(r) for r in neardup.near_duplicates(docs).collect()) == got
    assert sorted(r["doc_id"] for r in neardup.deduplicate(docs).collect()) == [g[0] for g in got if g[3]]


def test_repeats_missing_ids_and_empty(spark):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "q"), (9, "A B c d e f"), (None, None), (None, " ")]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(made).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [(0, 0, False)] * 3 + [(0, 7, False), (7, 7, True), (7, 7, True), (9, 7, False)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).count() == 0 and neardup.deduplicate(empty).count() == 0


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    """Repeated ids, repeated rows and rows without ids: each text is left once, rows without words all stay."""
    rows = [(1, "one row of two that are equal"), (1, "one row of two that are equal"), (5, "some text under five here now"), (5, "some other text under five that is longer")]
    rows += [(8, "some other text under five that is longer"), (None, "a text that no id names at all"), (None, "a text that no id names at all"), (None, "one row of two that are equal")]
    rows += [(9, ""), (9, ""), (None, None), (10, "\t")]
    rows += [(5, "some text under five here now")] * 40 + [(None, "a text that no id names at all")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in neardup.deduplicate(docs).collect()), key=str)
    want = [(1, rows[0][1]), (5, rows[2][1]), (5, rows[3][1]), (None, rows[5][1]), (9, ""), (9, ""), (None, None), (10, "\t")]
    assert got == sorted(want, key=str)


def test_large_groups_meet_their_first_member(spark, monkeypatch):
    """A chain of near copies and a crowd around one page, far larger than a block: as brute force says."""
    rnd = random.Random(17)
    page = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(70):
        own = list(page)
        own[rnd.randrange(60)] = f"x{i}"
        rows.append((i + 100, " ".join(own)))
    for _ in range(40):  # each differs from the one before by a little, and from the first by a lot
        page = list(page)
        page[rnd.randrange(60)] = f"y{len(rows)}"
        rows.append((300 - len(rows), " ".join(page)))
    monkeypatch.setattr(neardup, "BLOCK", 8)
    got = sorted(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=80).collect())
    assert got == brute(rows, 80)


def test_very_long_texts(spark):
    rnd = random.Random(18)
    long = [f"w{rnd.randrange(50_000)}" for _ in range(200_000)]  # over BATCH_BYTES
    near = long[:100_000] + ["changed"] * 10 + long[100_010:]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(long[::-1])), (4, "short text of a few words here")]
    got = {r["doc_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["component_id"] for i in range(1, 5)] == [1, 1, 3, 4]
    assert got[1]["n_shingles"] == len({tuple(long[i : i + 5]) for i in range(len(long) - 4)})


def test_components_of_a_chain_and_a_hub(spark, monkeypatch):
    from termtide.llm import graph

    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(500)] + [(3000 - i, 3000) for i in range(1, 300)] + [(5, 5)]
    want = {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1501)}, **{i: 2701 for i in range(2701, 3001)}}
    for most in (graph.LOCAL_LINKS, 10):  # followed in one task, and in rounds of joins
        monkeypatch.setattr(graph, "LOCAL_LINKS", most)
        got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
