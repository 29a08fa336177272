"""Column expressions: meeting and room text, quotas, normalisers, deterministic ids, clock conversion."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday letters Monday to Sunday, campus marks, and professor separators of the source texts.
DAYS = "월화수목금토일"
CAMPUS_MARKS = {"#": "연건", "*": "평창"}
DEFAULT_CAMPUS = "관악"
UNTIMED = "시간미정"
NAME_PARTS = r"\s*[/·、；;]\s*"
BLOCK = r"([월화수목금토일])\((\d{1,2}:\d{2})~(\d{1,2}:\d{2})\)"
#: Namespace of professor ids; any fixed uuid does.
IDENTITY_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "termtide/identity")


def _text(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def parse_blocks(col: Column | str) -> Column:
    """Meeting text to array<struct<day_index, period, start_time, end_time>>; period counts hours from eight, 0 at least."""
    text = _text(col)
    pick = lambda g: F.regexp_extract_all(text, F.lit(BLOCK), F.lit(g))
    return F.transform(
        F.arrays_zip(pick(1).alias("d"), pick(2).alias("s"), pick(3).alias("e")),
        lambda b: F.struct(
            (F.instr(F.lit(DAYS), b["d"]) - 1).alias("day_index"),
            F.greatest(F.lit(0), F.split(b["s"], ":")[0].cast("int") - 8).alias("period"),
            b["s"].alias("start_time"), b["e"].alias("end_time"),
        ),
    )


def parse_quota(col: Column | str) -> Column:
    """`130 (120)` to struct<total, returning>; a plain number has no second; without digits both are null."""
    numbers = F.regexp_extract_all(_text(col), F.lit(r"\d+"), F.lit(0))
    return F.struct(F.get(numbers, 0).cast("int").alias("total"), F.get(numbers, 1).cast("int").alias("returning"))


def _room_parts(col: Column | str) -> Column:
    return F.transform(F.split(_text(col), "/"), lambda p: F.trim(F.regexp_replace(p, r"\(.*?\)", "")))


def parse_room(col: Column | str) -> Column:
    """Rooms of a cell without notes, blanks and repeats, joined by `/` in order."""
    return F.array_join(F.array_distinct(F.filter(_room_parts(col), lambda p: p != "")), "/")


def pair_rooms(times: Column | str, rooms: Column | str) -> Column:
    """Meeting blocks with their rooms: by position if the counts agree, else the only distinct room, else ''."""
    rparts, tparts = _room_parts(rooms), F.split(_text(times), "/")
    distinct = F.array_distinct(F.filter(rparts, lambda r: r != ""))
    single = F.when(F.size(distinct) == 1, F.get(distinct, 0)).otherwise("")
    aligned = F.size(tparts) == F.size(rparts)
    each = F.transform(tparts, lambda part, i: F.transform(parse_blocks(part), lambda b: b.withField("room", F.when(aligned, F.get(rparts, i)).otherwise(single))))
    return F.flatten(each)


def norm_name(col: Column | str) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(_text(col), r"^\s+|\s+$", "")), r"\s+", " ")


def int_or_null(col: Column | str) -> Column:
    """The first integer in a text."""
    return F.regexp_extract(_text(col), r"-?\d+", 0).try_cast("long")


def truncated_int(col: Column | str) -> Column:
    """A numeric text cut at the decimal point; null if it is not a number."""
    return F.trim(_text(col)).try_cast("double").try_cast("long")


def split_names(col: Column | str) -> Column:
    """Professor names of a field in order, each once; a blank field gives one blank name."""
    parts = F.array_distinct(F.filter(F.transform(F.split(_text(col), NAME_PARTS), lambda p: F.trim(p)), lambda p: p != ""))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))


def uuid5(key: Column, space: uuid.UUID = IDENTITY_SPACE) -> Column:
    """The version-5 uuid of a text, from the built-in sha1."""
    h = F.sha1(F.concat(F.unhex(F.lit(space.hex)), F.encode(key, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def name_id(name: Column | str, dept: Column | str) -> Column:
    return uuid5(F.concat(norm_name(name), F.lit("|"), F.trim(_text(dept))))


def email_id(email: Column | str) -> Column:
    """Only this digest of an address may leave a job, never the address."""
    return uuid5(F.concat(F.lit("email:"), F.lower(F.trim(_text(email)))))


def prof_id(name: Column | str, dept: Column | str, email: Column | str) -> Column:
    return F.when(F.trim(_text(email)) != "", email_id(email)).otherwise(name_id(name, dept))


def to_epoch(col: Column | str, tz: str) -> Column:
    """Seconds since 1970 of a wall-clock time in a zone."""
    return F.unix_timestamp(F.to_utc_timestamp(col, tz))


def normalize_room(col: Column | str) -> Column:
    """struct<campus, building, name>, null for a blank room: campus by first letter, zeros stripped, building guessed."""
    raw = F.trim(_text(col))
    first = F.substring(raw, 1, 1)
    marked = first.isin(*CAMPUS_MARKS)
    campus = F.coalesce(*(F.when(first == m, F.lit(c)) for m, c in CAMPUS_MARKS.items()), F.lit(DEFAULT_CAMPUS))
    body = F.when(marked, F.substring(raw, 2, 1_000_000)).otherwise(raw)
    parts = F.filter(F.split(body, "-"), lambda p: p != "")
    parts = F.transform(parts, lambda p: F.when(p.rlike("^[0-9]+$"), F.regexp_replace(p, "^0+(?=.)", "")).otherwise(p))
    second = F.get(parts, 1)
    building = F.when((F.size(parts) >= 3) & second.rlike("^[0-9]{1,2}$"), F.concat_ws("-", F.get(parts, 0), second)).otherwise(F.get(parts, 0))
    return F.when((raw != "") & (F.size(parts) > 0), F.struct(campus.alias("campus"), building.alias("building"), F.array_join(parts, "-").alias("name")))


def building_rank(col: Column | str) -> Column:
    """A sortable struct: numeric buildings by their numbers (shorter first), then the others by text."""
    parts = F.split(_text(col), "-")
    numeric = ~F.exists(parts, lambda p: ~p.rlike("^[0-9]+$"))
    numbers = F.when(numeric, F.transform(parts, lambda p: p.try_cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.struct(F.when(numeric, 0).otherwise(1).alias("kind"), numbers.alias("numbers"), F.when(numeric, "").otherwise(_text(col)).alias("text"))


def slot_signature(slots: Column | str) -> Column:
    """Sorted (day, start, end) of the timed slots; the room is no part of it."""
    timed = F.filter(slots, lambda s: F.coalesce(s["start_time"], F.lit("")) != "")
    return F.array_sort(F.transform(timed, lambda s: F.concat_ws("~", s["day_index"], s["start_time"], F.coalesce(s["end_time"], F.lit("")))))


def slot_text(slots: Column | str) -> Column:
    """`월09:00~10:15/...` in order of day and start, or the word for no known time."""
    timed = F.filter(slots, lambda s: s["day_index"].isNotNull() & (F.coalesce(s["start_time"], F.lit("")) != ""))
    ordered = F.array_sort(F.transform(timed, lambda s: F.struct(s["day_index"], s["start_time"], F.coalesce(s["end_time"], F.lit("")).alias("end_time"))))
    day = lambda d: F.when(d.between(0, 6), F.substring(F.lit(DAYS), d + 1, F.lit(1))).otherwise("?")
    text = F.array_join(F.transform(ordered, lambda s: F.concat(day(s["day_index"]), s["start_time"], F.lit("~"), s["end_time"])), "/")
    return F.when(F.coalesce(F.size(timed), F.lit(0)) > 0, text).otherwise(UNTIMED)
