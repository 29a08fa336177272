import numpy as np
from pyspark.sql import functions as F

from termtide.llm import decontaminate, language, sharding, urls, vectors

TEXTS = {"en": "the house and the garden with this thing", "de": "das haus und der garten mit dieser sache", "es": "la casa y el jardín con esta cosa"}


def test_language_on_held_out_rows(spark):
    rnd = np.random.default_rng(0)
    rows = [(i, " ".join(rnd.choice(TEXTS[lang].split(), 12)), lang) for i, lang in enumerate(np.random.default_rng(1).choice(list(TEXTS), 300).tolist())]
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "12 %%", "es"), (None, rows[0][1], "en"), (1, rows[1][1], rows[1][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    want = {r[0]: r[2] for r in rows}
    held = [r for r in got if r["held_out"] and (r["doc_id"] or 0) < 1000]
    assert len(held) > 50 and np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.97
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if (r["doc_id"] or 0) >= 1000)
    assert all(0 <= r["score"] <= 1 for r in got)
    few = [r for r in language.identify(docs, per_language=10, landmarks=24).collect() if (r["doc_id"] or 0) < 1000]
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in few]) > 0.9
    assert [r["lang_pred"] for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()] == ["und"] * len(rows)
    assert language.identify(docs.limit(0)).count() == 0


def invented(n, words, seed):
    """n vocabularies of their own syllables each."""
    rnd = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    out = []
    for _ in range(n):
        syllables = ["".join(rnd.choice(letters, rnd.integers(2, 4))) for _ in range(60)]
        out.append(["".join(rnd.choice(syllables, rnd.integers(1, 4))) for _ in range(words)])
    return out


def test_rare_languages_are_learned(spark):
    rnd = np.random.default_rng(10)
    rows = []
    for k, vocabulary in enumerate(invented(120, 200, 11)):
        rows += [(len(rows) + i, " ".join(rnd.choice(vocabulary, 40)), f"l{k:03}") for i in range(40 if k < 100 else 30)]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("held_out").collect()
    right = {k: np.mean([r["lang_pred"] == rows[r["doc_id"]][2] for r in got if (rows[r["doc_id"]][2] >= "l100") == k]) for k in (False, True)}
    assert right[False] > 0.95 and right[True] > 0.95, right


def test_long_texts_keep_their_language(spark):
    rnd = np.random.default_rng(12)
    vocabularies = invented(3, 20_000, 13)
    rows = [(i, " ".join(rnd.choice(vocabularies[i % 3], 60)), f"l{i % 3}") for i in range(300)]
    # three tenths of the words come from all vocabularies, so that together all n-grams occur
    long = [" ".join(np.where(rnd.random(200_000) < 0.7, rnd.choice(v, 200_000), rnd.choice(sum(vocabularies, []), 200_000)))[:1_000_000] for v in vocabularies]
    rows += [(1000 + k, text, None) for k, text in enumerate(long)]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(len(t) > 900_000 for t in long)
    assert [got[1000 + k]["lang_pred"] for k in range(3)] == ["l0", "l1", "l2"]
    assert min(got[1000 + k]["score"] for k in range(3)) >= 0.2, [got[1000 + k]["score"] for k in range(3)]  # the least that the pipeline keeps


def test_null_and_repeated_ids_are_learned_at_any_size(spark):
    """More rows than a slice holds, all with null ids or with one id, and a row repeated thousands of times."""
    rnd = np.random.default_rng(14)
    for ids in (lambda i: None, lambda i: 7):
        rows = [(ids(i), " ".join(rnd.choice(TEXTS[lang].split(), 12)), lang) for lang in ("en", "de") for i in range(7000)]
        rows += [(None, "la casa y el jardín con esta cosa", "es")] * 7000
        got = language.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang"))
        assert got.where("lang = lang_pred").count() > 0.97 * len(rows)


def test_only_letters_count_as_letters(spark):
    rows = [(i, TEXTS[lang], lang) for i, lang in enumerate(("en", "de", "es") * 4)] + [(100, "½ ²", "de"), (101, "Ⅷ ①", None), (102, "12 ٣ _", None), (103, "中", None), (104, "ª", None)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[i] for i in (100, 101, 102)] == ["und"] * 3 and got[103] != "und" and got[104] != "und"


def test_prediction_equals_plain_kernel_ridge_regression(spark):
    """The tasks' scores against the same regression written out with n-gram sets."""
    rnd = np.random.default_rng(15)
    rows = [(i, " ".join(rnd.choice(TEXTS[lang].split(), 10)), lang) for i, lang in enumerate(("en", "de", "es") * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, "doc_id", "text", "lang", landmarks=60)
    grams = [{t.lower().encode()[i : i + n] for n in range(1, 5) for i in range(len(t.encode()) - n + 1)} for _, t, _ in rows]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in grams] for a in grams])
    values, vectors = np.linalg.eigh(kernel)
    good = values > 1e-6 * values[-1]
    phi = kernel @ (vectors[:, good] / np.sqrt(values[good]))
    y = np.array([[lang == k for k in model.languages] for _, _, lang in rows], float)
    centred = phi - phi.mean(0)
    beta = np.linalg.solve(centred.T @ centred + 1e-4 * len(rows) * np.eye(phi.shape[1]), centred.T @ y)
    want = centred @ beta + y.mean(0)
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in range(60)] == [model.languages[w] for w in want.argmax(1)]
    assert np.abs(np.clip(want.max(1), 0, 1) - [got[i]["score"] for i in range(60)]).max() < 0.03


def shards_of(rows, spark, **kw):
    return sharding.histogram_shards(spark.createDataFrame(rows, "doc_id long, text string"), **kw).collect()


def test_shards_are_even_and_gapless(spark):
    import zlib

    rnd = np.random.default_rng(2)
    rows = [(i, "é" * int(rnd.integers(0, 400))) for i in range(3000)] + [(None, "n" * 50), (5, None), (6, "")] + [(7, "same copy")] * 1500 + [(8, None)] * 3
    for kw in ({}, {"rows_per_range": 40}):
        got = shards_of(rows, spark, **kw)
        assert len(got) == len(rows)
        size = np.zeros(24)
        slots = {}
        for r in got:
            size[r["shard"]] += r["size"]
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert size.max() - size.min() <= 2 * 808 + 0.002 * size.mean()
        assert all(r["grown_shard"] is None and r["law"] == "bytes" for r in got)
        assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, len((t or "").encode()) + 8, zlib.crc32(t.encode()) if t is not None else None) for i, t in rows}
        ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
        ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
        assert ids == sorted(ids)
    assert shards_of([], spark) == [] and len(shards_of([(1, "one")], spark)) == 1


def test_every_splitter_is_the_exact_cut_or_within_its_tolerance(spark):
    """Boundaries between shards against all cuts between rows in key order; long texts, repeats, clashing columns."""
    rnd = np.random.default_rng(22)
    rows = [(int(rnd.integers(-500, 500)), "x" * int(rnd.integers(0, 300))) for _ in range(2000)] + [(3, "y" * 20_000), (3, "y" * 20_000), (None, None), (4, "")]
    for tolerance in (0.0005, 0.0):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"size": F.lit("x"), "key": F.lit(1), "shard": F.lit(2), "part": F.lit(3)})
        got = sorted(sharding.histogram_shards(docs, tolerance=tolerance).collect(), key=lambda r: (r["shard"], r["slot"]))
        assert [-(2**63) if r["doc_id"] is None else r["doc_id"] for r in got] == sorted(-(2**63) if i is None else i for i, _ in rows)
        ends = np.concatenate([[0], np.cumsum([r["size"] for r in got])])
        shard = np.array([r["shard"] for r in got])
        ideal = ends[-1] / 24
        for j in range(1, 24):
            cut = ends[np.searchsorted(shard, j)]
            nearest = np.abs(ends - ideal * j).min()
            assert abs(cut - ideal * j) <= max(nearest, tolerance * ideal) + 1e-6, (j, cut, ideal * j, nearest)


def test_url_parts_and_rules_equal_plain_reading(spark):
    rnd = np.random.default_rng(23)
    hosts, paths = ["a.com", "Example.com", "www.example.com", "x.NET", "net", "com.net", "example.com.net", "é.org", "1.2.3.4", ""], ["", "/", "/en/", "/en", "/es/x", "/fr/", "/EN/", "/a/b.c-d"]
    made = ["".join(rnd.choice(part) for part in (["http://", "https://", "", "x", "ftp://http://"], hosts, paths, ["", "?q=/en/", "#/es/", "?a=1&b=://"])) for _ in range(1500)]
    rows = [*enumerate(made), (9000, "http://long.net/es/" + "a" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("x"), "length": F.lit(1), "features": F.lit(2), "prediction": F.lit(3), "label": F.lit(4)})
    got = {r["page_id"]: r for r in urls.filter_urls(pages).collect()}
    assert len(got) == len(rows)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, url in rows:
        rest = url.split("://", 1)[1] if "://" in url else ""
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:end].translate(lower), rest[end:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
        fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.name), default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, best and best.name)
        assert got[i]["verdict"] in (("allow", "block") if best is None else (best.verdict,))


def test_url_rules_and_verdicts(spark):
    cases = {
        "https://a.b.com/x": ("a.b.com", "/x", "com/", "allow"), "http://EXAMPLE.com/en/1?q=/#x": ("example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"), "http://x.www.example.com/en/9": ("x.www.example.com", "/en/9", "www.example.com/en/", "allow"),
        "ftp://q.net/es/x": ("q.net", "/es/x", "net/es/", "block"), "ftp://q.net/fr/": ("q.net", "/fr/", "net/fr/", "block"), "http://com": ("com", "", None, None), "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "no scheme": ("", "", None, None), "": ("", "", None, None), "http://É.com?x://y/": ("É.com".replace("É", "É"), "", None, None),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(100, None), (0, "https://a.b.com/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("tld", F.lit(1))
    got = urls.filter_urls(pages).collect()
    assert len(got) == len(rows) and all(r["verdict"] in ("allow", "block") for r in got)
    for r in got:
        if r["page_id"] < 100:
            host, path, rule, verdict = cases[rows[r["page_id"]][1]]
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and verdict in (None, r["verdict"])
        else:
            assert (r["host"], r["path"], r["rule"]) == ("", "", None)
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_trees_learn_the_rules_of_unjudged_urls(spark):
    rules = (urls.Rule("bad.org", "/", "block"), urls.Rule("good.org", "/", "allow"))
    rows = [(i, f"http://bad.org/{'9' * 20}{i}?a=1&b=2&c={i}" if i % 2 else f"https://good.org/page{i % 7}") for i in range(400)]
    rows += [(1000 + i, f"http://other.net/{'9' * 20}{i}?a=1&b=2&c={i}" if i % 2 else f"https://other.net/page{i % 7}") for i in range(40)]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).where("page_id >= 1000").collect()
    assert np.mean([(r["verdict"] == "block") == (r["page_id"] % 2 == 1) for r in got]) > 0.95


def windows_brute(docs, items):
    import re

    pick = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for i, t in docs:
        w, hit, seen = pick(t), set(), set()
        for item, text in items:
            b = pick(text)
            n = min(10, len(b))
            wins = {tuple(b[j : j + n]) for j in range(len(b) - n + 1)} if n else set()
            for j in range(len(w) - n + 1 if n else 0):
                if tuple(w[j : j + n]) in wins:
                    hit |= set(range(j, j + n))
                    seen.add(str(item))
        out.append((i, len(w), len(hit), len(seen), bool(hit)))
    return sorted(out, key=str)


def test_decontamination_equals_brute_force(spark):
    rnd = np.random.default_rng(4)
    vocab = [f"W{i}É" for i in range(25)] + ["a", "b"]
    words = lambda n: " ".join(rnd.choice(vocab, n))
    items = [(1, words(30)), (2, words(12)), (3, words(10)), (4, "a b a"), (5, "W1É"), (6, words(7)), (7, "..."), (8, None), (9, "b b b b b b b b b")]
    docs = [(i, words(40) + (". " + items[i % 3][1] + "! " if i % 2 else "") + words(5)) for i in range(60)] + [(100, None), (101, ""), (3, "x y z"), (4, "a B-a"), (4, "a B-a")]
    made = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (200_000, 0):
        got = decontaminate.find_hits(made, bench, most_windows=most).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got), key=str) == windows_brute(docs, items)
    long_items = bench.where("item_id <= 3")
    clean = decontaminate.remove_hits(made, long_items)
    assert clean.columns == made.columns and clean.count() == sum(not r[4] for r in windows_brute(docs, items[:3]))
    assert decontaminate.find_hits(made.limit(0), bench).count() == 0 and decontaminate.remove_hits(made, bench.limit(0)).count() == len(docs)


def test_decontamination_by_shuffle_sends_no_texts(spark):
    """Ten thousand texts and one of 20,000 words, beyond the bound of the broadcast: brute force, and what is shuffled."""
    rnd = np.random.default_rng(24)
    vocab = np.array([f"word{i}" for i in range(3000)])
    items = [(i, " ".join(rnd.choice(vocab, 25))) for i in range(40)] + [(90, "short item"), (91, "word1 word2 word3 word4 word5 word6 word7")]
    docs = [(i, " ".join(rnd.choice(vocab, 60))) for i in range(10_000)]
    docs += [(20_000 + i, f"{docs[i][1]} {items[i % 40][1]} {docs[i + 1][1]}") for i in range(200)]
    long = rnd.choice(vocab, 20_000)
    long[9000:9025] = items[7][1].split()
    docs += [(30_000, " ".join(long)), (30_001, "a Short, item! of word1 word2 word3 word4 word5 word6 word7"), (None, items[3][1]), (None, items[3][1])]
    made = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    sent = {}
    for most in (200_000, 0):
        before = _shuffled(spark)
        got = decontaminate.find_hits(made, bench, most_windows=most).collect()
        sent[most] = _shuffled(spark) - before
        few = {i: t for i, t in docs if i is not None and (i % 50 == 0 or i >= 20_000)}
        want = {r[0]: r for r in windows_brute(few.items(), items)}
        assert len(got) == len(docs)
        for r in got:
            if r["doc_id"] in want:
                assert (r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == want[r["doc_id"]]
        assert [(r["n_hit"], r["n_items"]) for r in got if r["doc_id"] is None] == [(25, 1)] * 2
    size = sum(len(t) for _, t in docs)
    assert sent[0] < sent[200_000] + 2 * size, (sent, size)


def _shuffled(spark) -> int:
    """Bytes of shuffle written so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def vectors_brute(x):
    """(links of each vector, its component) by all cosines."""
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = u @ u.T >= 0.95
    np.fill_diagonal(links, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min([label[i], *label[links[i]]]) for i in range(len(x))])
        if (new == label).all():
            return links.sum(1), label
        label = new


def test_vector_recall_and_components(spark, monkeypatch):
    rnd = np.random.default_rng(6)
    base = rnd.normal(size=(400, 32))
    x = np.concatenate([base, *(base[:60] + rnd.normal(size=(60, 32)) * s for s in (0.1, 0.2, 0.3)), np.repeat(base[5:6], 300, 0) + rnd.normal(size=(300, 32)) * 0.12, base[:10]]).astype(np.float32)
    n_links, label = vectors_brute(x)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(9001, None), (9002, [0.0] * 32), (9003, [float("nan")] + [1.0] * 31), (9004, [None] + [1.0] * 31), (9005, [1.0]), (9006, []), (None, rows_of(x)[0])]
    clash = {"list": F.lit(0), "own": F.lit(1), "probes": F.lit("x"), "d": F.lit(2)}
    for per_list, block, kind in ((64, 100, "float"), (16, 7, "float"), (64, 1024, "double")):
        monkeypatch.setattr(vectors, "PER_LIST", per_list)
        monkeypatch.setattr(vectors, "BLOCK", block)
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns(clash)
        got = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
        assert len(got) == len(rows)
        found = np.array([got[i]["n_links"] for i in range(len(x))]) - [int((x[i] == x[0]).all()) for i in range(len(x))]  # the row without id is a copy of the first
        assert all(found <= n_links + 1) and 0.97 * n_links.sum() <= found.sum() <= n_links.sum() + (n_links[0] + 1), (per_list, found.sum(), n_links.sum())
        assert np.mean([got[i]["component_id"] == label[i] for i in range(len(x))]) > 0.97
        assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in range(9001, 9007))
        assert got[None]["component_id"] == 0 and not got[None]["kept"]
        assert vectors.near_vectors(df.limit(0)).count() == 0


def rows_of(x):
    return [[float(a) for a in v] for v in x]


def test_vectors_of_several_lengths_link_among_themselves(spark):
    rnd = np.random.default_rng(7)
    sets = {3: rnd.normal(size=(200, 3)), 2: rnd.normal(size=(40, 2)), 5: rnd.normal(size=(1, 5))}
    rows, want = [], {}
    for d, x in sets.items():
        x = np.concatenate([x, x[:1]])
        n, label = vectors_brute(x)
        first = len(rows)
        for i, v in enumerate(rows_of(x)):
            want[len(rows)] = (n[i], first + label[i])
            rows.append((len(rows), v))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == want


def test_probes_suffice_without_clusters(spark, monkeypatch):
    """Vectors in no clusters, each with a partner at just over the threshold, in many lists: recall against brute force."""
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(3000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rnd.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    y = 0.955 * x + np.sqrt(1 - 0.955**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    monkeypatch.setattr(vectors, "PER_LIST", 100)
    both = np.concatenate([x, y])
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(spark.createDataFrame(list(enumerate(rows_of(both))), "vec_id long, embedding array<double>")).collect()}
    n, _ = vectors_brute(both)
    found = np.array([got[i] for i in range(len(both))])
    assert (found <= n).all() and found.sum() >= 0.98 * n.sum()
