import itertools

from termtide.operators import rooms

DAYS = "term string, campus string, building string, name string, day_index int, start_time string, end_time string"


def test_free_rooms_equal_a_plain_search(spark):
    times = ["09:00", "10:15", "10:15", "12:00", "13:30", "17:00", "23:30"]
    places = [("A", "5", "1"), ("A", "5-1", "2"), ("A", "5-1-2", "3"), ("A", "55", "4"), ("B", "5", "1"), ("A", "6", "9")]
    met, n = [], 0
    for term, (c, b, r), day in itertools.product(("s", "f"), places, range(7)):
        n += 1
        if r == "9" and term == "f":
            continue
        for k in range(n % 5):
            i = (n * 7 + k * 3) % (len(times) - 1)
            met.append((term, c, b, r, day, times[i], times[i + 1 if (n + k) % 3 else i]))
    met += [("s", "A", "5", "1", 0, None, None), ("s", "A", "5", "1", 0, "12:00", "11:00")]
    asked = [(q, term, day, s, e, c, b) for q, (term, day, (s, e), (c, b)) in enumerate(itertools.product(("s", "f", "x"), (0, 3, 6), (("09:30", "10:15"), ("10:15", "10:20"), ("08:00", "23:59"), ("00:00", "00:30"), ("12:00", "12:00")), (("A", None), ("A", "5"), ("A", "5-*"), ("A", "5-1-*"), ("B", None), ("C", None))))]
    index = [(c, b, r, 2024, "s") for c, b, r in places] + [("A", "5-1", "old", 2020, "f")]
    known = {(t, c, b, r) for t, c, b, r, *_ in met}
    want = set()
    for q, term, day, s, e, c, b in asked:
        for ic, ib, ir, y, t in index:
            inside = b is None or (ib == b[:-2] or ib.startswith(b[:-2] + "-") if b.endswith("-*") else ib == b)
            if ic != c or not inside or s >= e:
                continue
            if (term, ic, ib, ir) not in known:
                want.add((q, ic, ib, ir, None, f"{y}-{t}"))
                continue
            own = [m[5:] for m in met if m[:5] == (term, ic, ib, ir, day) and m[5] and m[5] <= m[6]]
            if not any(a < e and z > s for a, z in own):
                want.add((q, ic, ib, ir, min((a for a, _ in own if a >= e), default=None), None))
    args = spark.createDataFrame(met, DAYS), spark.createDataFrame(index, "campus string, building string, name string, year int, term string"), spark.createDataFrame(asked, "query_id int, term string, day_index int, start string, end string, campus string, building string")
    cols = ("query_id", "campus", "building", "name", "next_start", "last_term")
    got = [tuple(r) for r in rooms.free_rooms(*args, other_terms=True, scope=["term"]).select(*cols).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    used = [tuple(r) for r in rooms.free_rooms(*args, scope=["term"]).select(*cols).collect()]
    assert set(used) == {w for w in want if w[5] is None} and rooms.free_rooms(args[0].limit(0), args[1], args[2], scope=["term"]).count() == 0
