"""Rooms: the index, meetings, free rooms, clashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termtide.functions import scalars


def rooms_index(classes: DataFrame, slots: DataFrame) -> DataFrame:
    """Per room its latest (year, term) and in how many terms it was used; `rank` sorts campus, building, name."""
    used = slots.where("room <> ''").join(classes.select("class_id", "year", "term"), "class_id").select("year", "term", F.explode(F.split("room", "/")).alias("raw")).distinct()
    rooms = used.withColumn("r", scalars.normalize_room("raw")).where("r is not null").select("r.*", "year", "term")
    out = rooms.groupBy("campus", "building", "name").agg(F.max(F.struct("year", "term")).alias("last"), F.count_distinct("year", "term").alias("n_terms"))
    campus = F.coalesce(*(F.when(F.col("campus") == c, i) for i, c in enumerate([scalars.DEFAULT_CAMPUS, *scalars.CAMPUS_MARKS.values()])), F.lit(9))
    return out.select("campus", "building", "name", "last.year", "last.term", "n_terms", F.struct(campus.alias("c"), scalars.building_rank("building").alias("b"), "name").alias("rank"))


def room_meetings(slots: DataFrame) -> DataFrame:
    """Each meeting once in each of its rooms, with the other rooms named."""
    rooms = F.filter(F.split("room", "/"), lambda r: r != "")
    one = slots.withColumn("all", rooms).withColumn("raw", F.explode("all"))
    others = F.array_join(F.filter("all", lambda r: r != F.col("raw")), "/")
    return one.withColumn("r", scalars.normalize_room("raw")).where("r is not null").select("class_id", "day_index", "start_time", "end_time", "r.*", others.alias("others"))


#: Hours of a band of the day by which gaps and questions meet, and a time after all times of a day.
BAND, DAY_END = 4, "~"


def _band(time: Column) -> Column:
    return F.coalesce(F.floor(F.substring(time, 1, 2).try_cast("int") / BAND), F.when(time == DAY_END, 23 // BAND).otherwise(0)).cast("int")


def _places(building: Column) -> Column:
    """What a question may ask for to get a building: everything, its name, or the stem of its parts."""
    parts = F.split(F.coalesce(building, F.lit("")), "-")
    stems = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.lit("~"), F.array_join(F.slice(parts, 1, i), "-")))
    return F.concat(F.array(F.lit("*"), F.concat(F.lit("="), building)), stems)


def room_gaps(meetings: DataFrame, scope: Sequence[str] = (), wanted: DataFrame | None = None) -> DataFrame:
    """(scope, campus, building, name, day_index, gap_start, gap_end): when each room that has meetings is free, on days 0 to 6.

    wanted: (scope, campus, day_index) to which the table is limited.

    Meetings of a room and day are swept by their start: a gap lies before each one that starts no earlier than all
    before it have ended, and after the last. The day's first gap starts at '' and its last ends at DAY_END. Meetings
    without a start or end, or that end before they start, hold no room.
    """
    room = [*scope, "campus", "building", "name"]
    held = meetings.where("start_time <= end_time").select(*room, "day_index", "start_time", "end_time")
    used, week = meetings.select(*room).distinct(), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("day_index")
    if wanted is None:
        days = used.select(*room, week)
    else:
        wanted = wanted.select(*scope, "campus", "day_index").distinct()
        held, days = held.join(wanted, [*scope, "campus", "day_index"], "left_semi"), used.join(wanted, [*scope, "campus"]).select(*room, "day_index")
    rows = held.unionByName(days.select(*room, "day_index", F.lit(DAY_END).alias("start_time"), F.lit(DAY_END).alias("end_time")))
    before = Window.partitionBy(*room, "day_index").orderBy("start_time", "end_time").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("gap_start", F.coalesce(F.max("end_time").over(before), F.lit("")))
    return rows.where("start_time >= gap_start and day_index between 0 and 6").select(*room, "day_index", "gap_start", F.col("start_time").alias("gap_end"))


def free_rooms(meetings: DataFrame, index: DataFrame, queries: DataFrame, other_terms: bool = False, scope: Sequence[str] = ()) -> DataFrame:
    """(scope, query_id, campus, building, name, next_start, last_term): rooms without a meeting in [start, end).

    queries: query_id, day_index, start, end, campus, building (a name, `name-*` for its parts, or null), and the
    columns of `scope`, within which meetings count. With `other_terms` rooms known only from the index are free as
    well, and carry their last term. A question whose end is not after its start gets no room.

    A question meets the one gap of each room that may hold it: gaps are keyed by what may be asked for (all, a name, a
    stem) and the bands of hours that they touch, questions by the band of their start.
    """
    room = ["campus", "building", "name"]
    stem = F.regexp_replace("building", r"-\*$", "")
    place = F.when(F.col("building").isNull(), "*").when(F.endswith("building", F.lit("-*")), F.concat(F.lit("~"), stem)).otherwise(F.concat(F.lit("="), F.col("building")))
    asked = queries.where("start < end").select(*scope, "query_id", "day_index", "start", "end", "campus", place.alias("place"), _band(F.col("start")).alias("band"))
    gaps = room_gaps(meetings.join(index.select(*room), room, "left_semi"), scope, asked)
    bands = F.explode(F.sequence(_band(F.col("gap_start")), _band(F.col("gap_end"))))
    keyed = gaps.withColumn("band", bands).withColumn("place", F.explode(_places(F.col("building"))))
    fits = (F.col("gap_start") <= F.col("start")) & (F.col("gap_end") >= F.col("end"))
    found = keyed.join(asked, [*scope, "campus", "day_index", "place", "band"]).where(fits)
    later = F.when(F.col("gap_end") != DAY_END, F.col("gap_end"))
    out = found.select(*scope, "query_id", *room, later.alias("next_start"), F.lit(None).cast("string").alias("last_term"))
    if not other_terms:
        return out
    known = index.select(*room, F.concat_ws("-", "year", "term").alias("last_term"), F.explode(_places(F.col("building"))).alias("place"))
    rest = known.join(asked.drop("band"), ["campus", "place"]).join(meetings.select(*scope, *room).distinct(), [*scope, *room], "left_anti")
    return out.unionByName(rest.select(*scope, "query_id", *room, F.lit(None).cast("string").alias("next_start"), "last_term"))


def meeting_conflicts(meetings: DataFrame, by: Sequence[str], id_col: str = "class_id") -> DataFrame:
    """Pairs of meetings of different classes that overlap on the same day and the same `by` columns.

    Meetings join only within the hours that they touch; a pair counts in the hour in which its later one starts.
    """
    cols = [id_col, "start_time", "end_time"]
    hour = lambda c: F.substring(c, 1, 2).cast("int")
    one = meetings.select(*by, "day_index", *cols).distinct().where("start_time < end_time").withColumn("hour", F.explode(F.sequence(hour("start_time"), hour("end_time"))))
    side = lambda p: one.select(*by, "day_index", "hour", *(F.col(c).alias(f"{p}_{c}") for c in cols))
    both = side("a").join(side("b"), [*by, "day_index", "hour"])
    overlap = (F.col(f"a_{id_col}") < F.col(f"b_{id_col}")) & (F.col("a_start_time") < F.col("b_end_time")) & (F.col("a_end_time") > F.col("b_start_time"))
    return both.where(overlap & (F.col("hour") == hour(F.greatest("a_start_time", "b_start_time")))).drop("hour")
