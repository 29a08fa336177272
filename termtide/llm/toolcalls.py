"""Tool-call linking in chats, in DataFrame operations only.

Messages carry calls `{"id", "name", "arguments"}` (arguments: a JSON object as text) or results
`{"id", "content"}`. Calls and results meet in a shuffled hash join on (conversation, id), whose hash side has one
row an id; the first result of a call (smallest turn, then content) counts. An argument that is `$other_id` makes the call depend on that call of the
same conversation: calls are ordered by dependency level, then turn, then id. Levels are found by pointer
doubling along chains and by rounds over the rest, of which each follows up to CHUNK calls of a conversation in the order
of their turns, forward and backward by turns; calls on a cycle, or behind one, get a null level and come last. `place` is a text that sorts the calls of a
conversation in that order.
Arguments are parsed to variants, so that values keep their kinds: `"5"` is a string and 5 a number. They are checked
against a schema table (tool, argument, type, required); types are string, integer (written without point or exponent),
number, boolean, object, array, null, and `enum:a,b` for one of these strings. A null value is of type null only. Each
linked call is written as canonical JSON: keys in order at every depth, no spaces.

Rows with a null conversation, id or name are kept and never linked; a repeated id keeps its first call
(smallest turn, then text) and marks the others `duplicate`. Arguments that are no JSON object, that name one key twice,
or that are longer than a variant (16 MB) are `malformed`, and written as null. Other texts are written whole, whatever
their length; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termtide.llm.common import cut

#: What `schema_of_variant` says of values of each type.
TYPES = {
    "string": "^STRING$", "integer": r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL.*|FLOAT|DOUBLE)$", "boolean": "^BOOLEAN$",
    "object": "^OBJECT<", "array": "^ARRAY<", "null": "^VOID$",
}
#: Calls of one conversation that a round follows.
CHUNK = 256


def _quoted(text: Column) -> Column:
    """A JSON string literal (taken from a one-field object, so that Spark escapes it)."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def _shortcut(single: DataFrame) -> DataFrame:
    """(conv, id, to, dist): from each call with one dependency, the first call behind it that has none or several.

    Pointers double their reach each round, so a chain takes the logarithm of its length; calls on cycles of
    such chains never arrive and are left out.
    """
    jumps = cut(single.select("conv", "id", F.col("on").alias("to"), F.lit(1).cast("long").alias("dist")))
    for _ in range(max(1, jumps.count()).bit_length() + 1):
        onward = jumps.select("conv", F.col("id").alias("to"), F.col("to").alias("next"), F.col("dist").alias("more"))
        joined = cut(jumps.join(onward, ["conv", "to"], "left"))
        jumps = joined.select("conv", "id", F.coalesce("next", "to").alias("to"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), F.col("next").isNull().alias("arrived"))
        if jumps.where("not arrived").isEmpty():
            break
    return jumps.where("arrived").drop("arrived")


def _resolved(state: DataFrame, forward: bool) -> DataFrame:
    """(conv, id, level) of the calls that wait for nothing, and of those that follow from them among CHUNK neighbours by turn.

    state: conv, id, turn, known (the level by what is known), open (`to` and `dist` of what is not).
    """
    ready = state.where(F.size("open") == 0).select("conv", "id", F.col("known").alias("level"))
    turn = F.col("turn").asc_nulls_last() if forward else F.col("turn").desc_nulls_last()
    near = state.withColumn("n", F.row_number().over(Window.partitionBy("conv").orderBy(turn, "id"))).where(F.col("n") <= CHUNK)
    near = near.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("n", "id", "known", "open"))).alias("calls"))

    def step(found: Column, call: Column) -> Column:
        met = F.transform(call["open"], lambda o: F.element_at(found, o["to"]) + o["dist"] + 1)
        level = F.greatest(call["known"], F.array_max(met))
        return F.when(F.exists(met, lambda m: m.isNull()), found).otherwise(F.map_concat(found, F.create_map(call["id"], level)))

    found = F.aggregate("calls", F.create_map().cast("map<string,bigint>"), step)
    follow = near.select("conv", F.explode(found).alias("id", "level"))
    return follow.unionByName(ready.join(near.select("conv", F.explode("calls.id").alias("id")), ["conv", "id"], "left_anti"))


def _levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv, id, level) of calls (conv, id, turn): 0 for calls without dependencies, else one more than the highest of them.

    Chains of single dependencies are cut short first; only calls with several dependencies take rounds.
    """
    degree = needs.groupBy("conv", "id").agg(F.count(F.lit(1)).alias("n"))
    needs = cut(needs.join(degree, ["conv", "id"]))
    done = cut(calls.join(degree, ["conv", "id"], "left_anti").select("conv", "id", F.lit(0).cast("long").alias("level")))
    if needs.isEmpty():
        return done.withColumn("level", F.col("level").cast("int"))
    chains = cut(_shortcut(needs.where("n = 1")))
    way = chains.select("conv", F.col("id").alias("on"), "to", "dist")
    alone = needs.where("n = 1").select("conv", F.col("id").alias("on"))  # on a cycle unless `way` has it
    edges = needs.where("n > 1").join(way, ["conv", "on"], "left").join(alone.withColumn("single", F.lit(True)), ["conv", "on"], "left")
    edges = cut(edges.select("conv", "id", F.coalesce("to", F.when(F.col("single").isNull(), F.col("on"))).alias("to"), F.coalesce("dist", F.lit(0)).alias("dist")))
    left = edges.select("conv", "id").distinct().join(calls, ["conv", "id"]).withColumn("known", F.lit(None).cast("long"))
    parts, fresh, forward = [done], done, True
    while True:
        told = edges.join(fresh.select("conv", F.col("id").alias("to"), "level"), ["conv", "to"], "left")
        state = told.groupBy("conv", "id").agg(F.max(F.col("level") + F.col("dist") + 1).alias("now"), F.collect_list(F.when(F.col("level").isNull(), F.struct("to", "dist"))).alias("open"))
        state = cut(left.join(state, ["conv", "id"]).select("conv", "id", "turn", F.greatest("known", "now").alias("known"), "open"))
        fresh = cut(_resolved(state, forward))
        if fresh.isEmpty():
            break
        parts, forward = [*parts, fresh], not forward
        left = state.join(fresh.select("conv", "id"), ["conv", "id"], "left_anti")
        edges = left.select("conv", "id", F.explode("open").alias("e")).select("conv", "id", "e.*")
        left = left.drop("open")
    done = parts[0]
    for part in parts[1:]:
        done = done.unionByName(part)
    behind = chains.join(done.select("conv", F.col("id").alias("to"), "level"), ["conv", "to"]).select("conv", "id", (F.col("level") + F.col("dist")).alias("level"))
    return done.unionByName(behind).withColumn("level", F.col("level").cast("int"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, turn, name, level, place, status, problems, result_turn, canonical) of each call.

    calls: conv_id, turn, call_id, name, arguments; results: conv_id, turn, call_id, content; schemas: name,
    argument, type, required. status: ok, no_result, invalid or duplicate.
    """
    first = Window.partitionBy("conv", "id").orderBy(F.col("turn").asc_nulls_last(), "name", "arguments")
    known = F.col("conv").isNotNull() & F.col("id").isNotNull() & F.col("name").isNotNull()
    base = cut(
        calls.select(F.col("conv_id").alias("conv"), F.col("call_id").alias("id"), "turn", "name", "arguments")
        .withColumn("whole", F.try_parse_json(F.concat(F.lit("["), "arguments", F.lit("]"))))  # in brackets, so that nothing may follow the object
        .withColumn("given", F.when(F.try_variant_get("whole", "$[1]", "variant").isNull(), F.try_variant_get("whole", "$[0]", "variant")))
        .withColumn("given", F.when(F.schema_of_variant("given").startswith("OBJECT<"), F.col("given"))).drop("whole")
        .withColumn("copy", F.when(known, F.row_number().over(first)).otherwise(1))
        .withColumn("linked", known & (F.col("copy") == 1))
    )
    single = base.where("linked")
    fields = F.map_entries(F.variant_get("given", "$", "map<string,variant>"))
    pairs = single.select("conv", "id", "name", F.explode(fields).alias("e")).select("conv", "id", "name", F.col("e.key").alias("argument"), F.col("e.value").alias("value"))
    kind, text = F.coalesce(F.schema_of_variant("value"), F.lit("VOID")), F.try_variant_get("value", "$", "string")
    pairs = pairs.select("conv", "id", "name", "argument", kind.alias("kind"), F.when(kind == "STRING", text).alias("text"))
    needs = pairs.where(F.startswith("text", F.lit("$"))).select("conv", "id", F.expr("substring(text, 2)").alias("on")).distinct()
    needs = needs.join(single.select("conv", F.col("id").alias("on")), ["conv", "on"], "left_semi")
    levels = _levels(single.select("conv", "id", "turn"), needs)

    pattern = F.coalesce(*(F.when(F.col("type") == t, F.lit(p)) for t, p in TYPES.items()), F.lit("^$"))
    listed = F.when(F.startswith("type", F.lit("enum:")), F.array_contains(F.split(F.expr("substring(type, 6)"), ","), F.col("text")))
    fits = F.coalesce(listed, F.rlike("kind", pattern)) | F.startswith("text", F.lit("$"))
    expected = schemas.select("name", "argument", "type", "required")
    asked = single.select("conv", "id", "name").join(expected.where("required"), "name")
    missing = asked.join(pairs.select("conv", "id", "argument"), ["conv", "id", "argument"], "left_anti").select("conv", "id", F.concat(F.lit("missing:"), "argument").alias("problem"))
    seen = pairs.join(expected.withColumn("known", F.lit(True)), ["name", "argument"], "left")
    wrong = seen.where(F.col("known").isNull() | ~F.coalesce(fits, F.lit(False)))
    wrong = wrong.select("conv", "id", F.concat(F.when(F.col("known"), "type:").otherwise("unknown:"), "argument").alias("problem"))
    broken = single.where("given is null").select("conv", "id", F.lit("malformed").alias("problem"))
    problems = missing.unionByName(wrong).unionByName(broken).groupBy("conv", "id").agg(F.array_sort(F.collect_set("problem")).alias("problems"))

    answer = Window.partitionBy("conv", "id").orderBy(F.col("turn").asc_nulls_last(), "content")
    answered = (
        results.select(F.col("conv_id").alias("conv"), F.col("call_id").alias("id"), "turn", "content")
        .where("conv is not null and id is not null").withColumn("n", F.row_number().over(answer)).where("n = 1")
        .select("conv", "id", F.col("turn").alias("result_turn"), "content", F.lit(True).alias("linked"))
    )
    extra = levels.join(problems, ["conv", "id"], "full").withColumn("linked", F.lit(True))
    hashed = lambda side: side.hint("shuffle_hash")
    joined = base.join(hashed(answered), ["conv", "id", "linked"], "left").join(hashed(extra), ["conv", "id", "linked"], "left")
    bad = F.coalesce(F.size("problems") > 0, F.lit(False))
    status = F.when(F.col("copy") > 1, "duplicate").when(~F.col("linked"), "invalid").when(bad, "invalid").when(F.col("result_turn").isNull(), "no_result").otherwise("ok")
    arguments = F.coalesce(F.to_json("given"), F.lit("null"))
    line = F.concat(
        F.lit('{"arguments":'), arguments, F.lit(',"id":'), _quoted(F.col("id")), F.lit(',"name":'), _quoted(F.col("name")),
        F.lit(',"result":'), F.when(F.col("result_turn").isNull() | F.col("content").isNull(), "null").otherwise(_quoted(F.col("content"))), F.lit("}"),
    )
    digits = lambda n, width: F.lpad(F.coalesce(n.cast("string"), F.lit("9" * width)), width, "0")
    place = F.concat_ws(":", digits(F.col("level"), 10), digits(F.col("turn"), 19), "id")
    return joined.select(
        F.col("conv").alias("conv_id"), F.col("id").alias("call_id"), "turn", "name", "level", place.alias("place"), status.alias("status"),
        F.coalesce(F.array_join("problems", ","), F.lit("")).alias("problems"), "result_turn", F.when(F.col("linked"), line).alias("canonical"),
    )


def chat_trace(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a plain chat implies: each question calls `reply`, each answer is a result.

    A user turn is the call `turn-<turn>` with its text's length, from its third turn on a reference to the question
    before, and in every eighth turn from the fifth on a second one to the question before that; the assistant's turn
    answers the question one turn earlier. As in real traces some calls are faulty: by the length modulo 7 a call
    lacks its argument (0), has an unknown one (1), a wrong type (2), broken JSON (3), or is sent again a turn later (4).
    """
    at, size = F.col("turn"), F.coalesce(F.length("text"), F.lit(0))
    kind = size % 7
    part = lambda when, text: F.when(when, text)
    arguments = F.concat_ws(
        ",", part(kind == 2, F.lit('"n_chars":"many"')), part(~kind.isin(0, 2), F.concat(F.lit('"n_chars":'), size)), part(kind == 1, F.lit('"extra":true')),
        part(at >= 2, F.concat(F.lit('"after":"$turn-'), at - 2, F.lit('"'))), part((at >= 4) & (at % 8 == 4), F.concat(F.lit('"also":"$turn-'), at - 4, F.lit('"'))),
    )
    asked = conversations.where("role = 'user'").select(
        "conv_id", "turn", F.concat(F.lit("turn-"), at).alias("call_id"), F.lit("reply").alias("name"),
        F.when(kind == 3, "{oops").otherwise(F.concat(F.lit("{"), arguments, F.lit("}"))).alias("arguments"), (kind == 4).alias("twice"),
    )
    again = asked.where("twice").select("conv_id", (at + 1).alias("turn"), "call_id", "name", F.lit('{"n_chars":0}').alias("arguments"))
    told = conversations.where("role = 'assistant'").select("conv_id", "turn", F.concat(F.lit("turn-"), at - 1).alias("call_id"), F.col("text").alias("content"))
    return asked.drop("twice").unionByName(again), told
