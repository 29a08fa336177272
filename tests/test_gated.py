import pytest
from pyspark.sql import functions as F

from termtide.operators import crossterm
from termtide.sources.gated import GatedTable

SCHEMA = "year int, term string, code string, tag string, bad boolean"


def test_only_a_good_attempt_shows(spark, tmp_path):
    rows = lambda n, tag="x", bad=0: [(2024, "1", f"C{i}", tag, i < bad) for i in range(n)] + [(2024, "2", f"C{i}", "y", None) for i in range(4)]
    df = lambda r: spark.createDataFrame(r, SCHEMA)
    table = GatedTable(spark, str(tmp_path), df([]).schema)
    scanned = spark.sparkContext.accumulator(0)
    terms = [(2024, "1"), (2024, "2")]

    def once(batches):
        for b in batches:
            scanned.add(b.num_rows)
            yield b

    publish = lambda r, **kw: table.publish(df(r).mapInArrow(once, SCHEMA), terms, F.col("tag").isNotNull(), F.col("bad"), **kw)
    assert table.read().count() == 0
    assert publish(rows(10)) == {(2024, "1"): "ok", (2024, "2"): "ok"} and scanned.value == 14  # one scan
    assert publish(rows(8)) == {(2024, "1"): "shrunk", (2024, "2"): "ok"} and table.read().count() == 14
    assert publish(rows(10, tag=None))[2024, "1"] == "no_tags" and publish(rows(12, bad=2))[2024, "1"] == "failures" and publish(rows(0))[2024, "1"] == "empty"
    assert table.read().count() == 14 and len(table.published()) == 1
    assert publish(rows(12, bad=2) + [(2023, "1", "C", "x", False)], max_failed=0.5) == {(2024, "1"): "ok", (2024, "2"): "ok"}
    assert table.read().count() == 14 and {r["code"] for r in table.read().where("term = '1'").collect()} == {f"C{i}" for i in range(2, 12)}
    assert [r["version"] for r in table.published()] == [0, 1]


def test_a_lost_attempt_leaves_the_table(spark, tmp_path):
    df = spark.createDataFrame([(2024, "1", "C", "x", False)], SCHEMA)
    table = GatedTable(spark, str(tmp_path), df.schema)
    args = [(2024, "1")], F.lit(True), F.lit(False)
    table.publish(df, *args)
    with pytest.raises(Exception, match="lost"):
        table.publish(df.withColumn("code", F.raise_error(F.lit("lost"))), *args)
    assert [r["code"] for r in table.read().collect()] == ["C"]


def test_codes_of_one_name_meet_only_near_in_time(spark):
    """A generic name: many codes, each with two neighbouring terms; candidates stay near the pairs found."""
    n = 3000
    rows = [(f"P{i}", ["Seminar"], [(t, "001", "Seminar", "p", "d", 3) for t in (i % 400, i % 400 + 1)]) for i in range(n)]
    schema = "sbjt_cd string, names array<string>, offerings array<struct<term_idx:int,lt_no:string,name:string,professor:string,department:string,credits:int>>"
    history = spark.createDataFrame(rows, schema)
    found = crossterm.infer_code_links(history)
    got = {tuple(r) for r in found.collect()}
    times = [(i, i % 400) for i in range(n)]
    want = {(f"P{p}", f"P{q}", "high" if a - (b + 1) == 1 else "low") for p, a in times for q, b in times if b < a <= b + 1 + 4}
    assert got == want
    plan = found._jdf.queryExecution().executedPlan()
    met = [m for m in _metrics(plan)]
    assert met and max(met) <= 2 * len(want)


def _metrics(plan):
    """Rows that joins of a finished plan gave out."""
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    todo, out = [plan], []
    while todo:
        p = todo.pop()
        if "Join" in p.nodeName():
            out.append(p.metrics().apply("numOutputRows").value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
    return out


def test_links_of_alike_codes_are_gathered_once(spark):
    """300 codes of three kinds: what joins give out grows with the kinds, not with the pairs of codes."""
    rows = [(f"P{i}", ["Seminar"], [(i % 3 * 2, "001", "Seminar", "p", "d", i % 2)]) for i in range(300)]
    history = spark.createDataFrame(rows, "sbjt_cd string, names array<string>, offerings array<struct<term_idx:int,lt_no:string,name:string,professor:string,department:string,credits:int>>")
    four = F.col("code").endswith("4")
    found = crossterm.link_lists(history, four, lambda conf, older, newer: F.when(older & ~newer, "confirmed").when(~older, conf))
    ends = lambda x: tuple(map(tuple, x or []))
    got = {(c, ends(r["prev"]), ends(r["next"])) for r in found.collect() for c in r["codes"]}
    pairs = crossterm.infer_code_links(history)
    old, new = F.col("prev").endswith("4"), F.col("next").endswith("4")
    suppress, links = pairs.where(old & new).select(F.col("next").alias("a"), F.col("prev").alias("b")), pairs.where(old & ~new).select("prev", "next")
    want = crossterm.apply_code_links(pairs, links, suppress, history.select(F.col("sbjt_cd").alias("code"))).collect()
    assert got == {(r["code"], ends(r["prev"]), ends(r["next"])) for r in want} and got
    assert max(_metrics(found._jdf.queryExecution().executedPlan())) <= 200 < pairs.count()
