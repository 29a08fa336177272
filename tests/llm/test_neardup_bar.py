"""The pipeline's near-dedup stage against brute force at its own bar."""

import random

import corpus_pipeline
from termtide.llm import neardup


def kept_brute(rows, percent):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return {rows[i][0] for i in label}


def corpus():
    rnd = random.Random(12)
    rows = []
    for group in range(40):
        base = [f"g{group}w{rnd.randrange(10**6)}" for _ in range(100)]
        rows.append((len(rows), " ".join(base)))
        for changed in ((50, 55), (40, 60), (30, 50, 70))[group % 3], (50,):
            own = list(base)
            for at in changed:
                own[at] = f"new{rnd.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    return rows


def test_stage_links_at_its_own_bar(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()}
    assert got == kept_brute(rows, 80) and len(got) < len(kept_brute(rows, 85))
    assert {r["doc_id"] for r in neardup.deduplicate(docs).collect()} == kept_brute(rows, 85)


def test_bands_follow_from_the_bar():
    assert (neardup.bar_at(85).bands, neardup.bar_at(80).bands) == (24, 36)
    for percent in (60, 75, 80, 85, 95):
        bar = neardup.bar_at(percent)
        assert (1 - (percent / 100) ** neardup.ROWS) ** bar.bands < 1e-6 and len(bar.factor) * 2 == bar.values > bar.agree > 0
