import json

from termtide.llm import toolcalls

CALL = "conv_id long, turn long, call_id string, name string, arguments string"
RESULT = "conv_id long, turn long, call_id string, content string"
SCHEMA = "name string, argument string, type string, required boolean"


def test_links_orders_validates_and_writes(spark):
    calls = [
        (1, 5, "c", "add", '{"x":"$b","y":2}'), (1, 1, "a", "add", '{"y":1,"x":3}'), (1, 3, "b", "add", '{"x":"$a","y":"é\\"q"}'),
        (1, 9, "a", "add", '{"x":1}'), (2, 1, "p", "add", '{"x":"$q"}'), (2, 2, "q", "add", '{"x":"$p"}'), (3, 1, "m", "add", "{oops"),
        (None, 1, "a", "add", "{}"), (4, 1, None, "add", "{}"), (4, 2, "z", "none", '{"k":"$gone"}'),
    ]
    results = [(1, 2, "a", 'r "1"\n'), (1, 4, "a", "later"), (1, 6, "c", None), (2, 3, "p", "x"), (None, 2, "a", "n")]
    schemas = [("add", "x", "number", True), ("add", "y", "integer", False)]
    make = spark.createDataFrame
    got = {(r["conv_id"], r["call_id"], r["turn"]): r for r in toolcalls.link_calls(make(calls, CALL), make(results, RESULT), make(schemas, SCHEMA)).collect()}
    assert len(got) == len(calls)
    assert [got[1, i, t]["level"] for i, t in (("a", 1), ("b", 3), ("c", 5))] == [0, 1, 2]
    assert got[1, "a", 1]["status"] == "ok" and got[1, "a", 1]["result_turn"] == 2
    assert json.loads(got[1, "a", 1]["canonical"]) == {"arguments": {"x": 3, "y": 1}, "id": "a", "name": "add", "result": 'r "1"\n'}
    assert got[1, "a", 1]["canonical"].startswith('{"arguments":{"x":3,"y":1},"id":"a"')
    assert got[1, "b", 3]["problems"] == "type:y" and got[1, "a", 9]["status"] == "duplicate"
    assert got[2, "p", 1]["level"] is None and got[3, "m", 1]["problems"] == "malformed,missing:x"
    assert got[4, "z", 2]["problems"] == "unknown:k" and got[4, "z", 2]["level"] == 0
    assert got[None, "a", 1]["status"] == "invalid" and got[None, "a", 1]["result_turn"] is None
    empty = toolcalls.link_calls(make([], CALL), make([], RESULT), make([], SCHEMA))
    assert empty.count() == 0


def test_levels_of_chains_joints_and_cycles(spark):
    edges = {0: [], 1: [0], 2: [1], 3: [2, 0], 4: [3], 5: [4, 2], 6: [5], 7: [8], 8: [7], 9: [7, 1], 10: [9], **{i: [i - 1] for i in range(12, 60)}, 11: []}
    calls = [(1, i, str(i), "f", "{" + ",".join(f'"k{j}":"${d}"' for j, d in enumerate(on)) + "}") for i, on in edges.items()]
    want = {}
    while len(want) < len(edges) and (new := {i: 1 + max((want[d] for d in on), default=-1) for i, on in edges.items() if i not in want and all(d in want for d in on)}):
        want |= new
    got = toolcalls.link_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame([], RESULT), spark.createDataFrame([], SCHEMA)).collect()
    assert {int(r["call_id"]): r["level"] for r in got} == {i: want.get(i) for i in edges}


def test_ladders_have_as_many_levels_as_they_need(spark):
    """Each call uses the two before it."""
    n = 600
    calls = [(1, i, str(i), "f", "{" + ",".join(f'"k{j}":"${d}"' for j, d in enumerate(range(max(0, i - 2), i))) + "}") for i in range(n)]
    got = toolcalls.link_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame([], RESULT), spark.createDataFrame([], SCHEMA))
    rows = got.withColumn("clash", toolcalls.F.lit(1)).collect()
    assert {int(r["call_id"]): r["level"] for r in rows} == {i: i for i in range(n)}
    assert [int(r["call_id"]) for r in sorted(rows, key=lambda r: r["place"])] == list(range(n))


def test_calls_and_results_meet_in_a_hash_join(spark, monkeypatch):
    calls = spark.createDataFrame([(1, 1, "a", "f", "{}")], CALL).withColumn("linked", toolcalls.F.lit("x")).withColumn("content", toolcalls.F.lit("y"))
    results = spark.createDataFrame([(1, 2, "a", "t" * 100_000)], RESULT)
    made = toolcalls.link_calls(calls, results, spark.createDataFrame([], SCHEMA))
    assert "ShuffledHashJoin" in made._jdf.queryExecution().executedPlan().toString()
    row = made.first()
    assert row["status"] == "invalid" or row["status"] == "ok" and "t" * 100_000 in row["canonical"]


def test_query_equals_sql(spark, tmp_path):
    import duckdb

    from termtide.llm import queries

    rows = []
    for conv in range(30):
        for turn in range(1 + conv % 14):
            if (conv * 7 + turn) % 11:
                rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", None if (conv + turn) % 13 == 0 else "é" * ((conv * 5 + turn * 3) % 19)))
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op5_tool_call_links(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(queries.ORACLE_SQL["op5_tool_call_links"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)
    assert {r["status"] for r in got.collect()} == {"ok", "no_result", "invalid", "duplicate"}


def test_backward_ladder_and_wide_joints(spark):
    """Each call uses two that come after it; one uses all others."""
    n = 300
    edges = {i: [d for d in (i + 1, i + 2) if d < n] for i in range(n)} | {n: list(range(n))}
    calls = [(1, i, str(i), "f", json.dumps({f"k{d}": f"${d}" for d in on})) for i, on in edges.items()]
    got = toolcalls.link_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame([], RESULT), spark.createDataFrame([], SCHEMA)).collect()
    assert {int(r["call_id"]): r["level"] for r in got} == {i: n - 1 - i for i in range(n)} | {n: n}


def test_values_keep_their_kinds(spark):
    types = ["string", "integer", "number", "boolean", "object", "array", "null", "enum:fast,slow"]
    values = {
        '"5"': {"string"}, '"fast"': {"string", "enum:fast,slow"}, "5": {"integer", "number"}, "-7": {"integer", "number"}, "123456789012345678901234567890": {"integer", "number"}, "2.5": {"number"}, "1e3": {"number"},
        "true": {"boolean"}, "null": {"null"}, '{"b":1,"a":[1,{"z":null,"y":"é\\n"}]}': {"object"}, '[1,"x",null]': {"array"}, "{}": {"object"}, "[]": {"array"}, '""': {"string"},
    }
    calls = [(1, i, f"{i}-{t}", t, f'{{"v": {v}}}') for i, v in enumerate(values) for t in types]
    schemas = [(t, "v", t, True) for t in types]
    broken = ['{"n":1,"n":2}', "[1]", "5", '"x"', "{oops", "", None, '{"v":1}}']
    calls += [(2, i, str(i), "string", b) for i, b in enumerate(broken)]
    got = {(r["conv_id"], r["call_id"]): r for r in toolcalls.link_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame([], RESULT), spark.createDataFrame(schemas, SCHEMA)).collect()}
    for i, (v, fitting) in enumerate(values.items()):
        for t in types:
            row = got[1, f"{i}-{t}"]
            assert row["problems"] == ("" if t in fitting else "type:v"), (v, t, row)
            assert json.loads(row["canonical"])["arguments"] == {"v": json.loads(v)} and type(json.loads(row["canonical"])["arguments"]["v"]) is not str or v.startswith('"')
    nested = got[1, "9-object"]["canonical"]
    assert nested.startswith('{"arguments":{"v":{"a":[1,{"y":"é\\n","z":null}],"b":1}},"id"')
    assert all(got[2, str(i)]["problems"] == "malformed,missing:v" and json.loads(got[2, str(i)]["canonical"])["arguments"] is None for i in range(len(broken)))
