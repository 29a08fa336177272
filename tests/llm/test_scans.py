import hashlib
import random
import re

import numpy as np

from termtide.llm import pii, secrets
from termtide.llm.textlike import WORDS

rnd = random.Random(3)
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
RANDOM = ["".join(rnd.choices(B64, k=44)) for _ in range(30)]
WORDY = [f"{a}-{b}-{a}-release-notes-{n}" for n, (a, b) in enumerate(zip(["processing", "statement", "configure"] * 10, ["internal", "overview", "assessment"] * 10, strict=True))]
TEXTS = [
    None, "", "pay 4111 1111 1111 1111 now", 'api_key: "abcdef" Token=abc secret:token:abcdefghij PASSWORD = x1y2z3w4', "AKIA" + "A1" * 8 + " AKIAshort aKIA" + "B" * 20,
    "x" + "0a" * 12 + "g " + "f" * 23, "héé " + "ab12" * 8, *(f"see {t} ok" for t in RANDOM), *(f"see {t} ok" for t in WORDY),
]


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secret_query_base_spans_and_random_tokens(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (None, TEXTS[6]), (6, TEXTS[6])], "doc_id long, text string").withColumn("found", secrets.F.lit(1))
    got = secrets.scan(docs).collect()
    assert len(got) == len(TEXTS) + 2
    by = {r["doc_id"]: r for r in got}
    for i, text in enumerate(TEXTS):
        want = base(text)
        label = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert by[i]["base_sha256"] == hashlib.sha256(label.encode()).hexdigest()
        assert [by[i][f"n_{k}"] for k in secrets.KINDS[:3]] == [sum(w[1] == k for w in want) for k in range(3)]
        assert set(filter(None, label.split(","))) <= set(by[i]["spans"].split(","))
    first = TEXTS.index(f"see {RANDOM[0]} ok")
    flagged = [by[i]["spans"] for i in range(first, first + len(RANDOM))]
    assert sum(s == "random:4:48" for s in flagged) >= 0.9 * len(RANDOM)
    assert all(by[i]["spans"] == "" for i in range(first + len(RANDOM), len(TEXTS)))
    assert secrets.scan(docs.limit(0)).count() == 0


def test_redaction_keeps_rows_and_clean_texts(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert len(got) == len(TEXTS) and got[0] is None and got[1] == "" and got[2] == TEXTS[2]
    assert got[6] == "héé <hex>" and "<assign>" in got[3] and "<access>" in got[4]


def test_random_keys_of_any_length_and_share(spark):
    own = random.Random(9)
    alphabets = {"HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base64": B64}
    keys = {(name, n): ["".join(own.choices(a, k=n)) for _ in range(40)] for name, a in alphabets.items() for n in (20, 32, 40, 64)}
    keys["uuid", 36] = [f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}" for h in ("%032x" % own.getrandbits(128) for _ in range(40))]
    want = {key: [(t, k) for t in own_keys if any(c.isdigit() for c in t) and any(c.isalpha() for c in t)] for k, (key, own_keys) in enumerate(keys.items())}
    for text in ([], WORDY):  # keys alone, and keys beside text
        rows = [(t, k) for part in want.values() for t, k in part] + [(t, -1) for t in text]
        docs = spark.createDataFrame([(i, f"see {t} ok") for i, (t, _) in enumerate(rows)], "doc_id long, text string")
        spans = {r["doc_id"]: r["spans"] for r in secrets.scan(docs).collect()}
        for k, key in enumerate(want):
            hit = [spans[i] == f"random:4:{4 + len(t)}" for i, (t, kind) in enumerate(rows) if kind == k]
            assert len(hit) > 30 and sum(hit) >= 0.9 * len(hit), (key, sum(hit), len(hit))
        assert all(spans[i] == "" for i, (_, kind) in enumerate(rows) if kind == -1)


def test_text_in_any_encoding_is_no_secret(spark):
    import base64

    words = "this is a plain sentence of ordinary prose about the house and the garden".split()
    plain = [" ".join(words[i:] + words[:i])[:40] for i in range(12)]
    tokens = [base64.b64encode(p.encode()).decode().rstrip("=") for p in plain] + [base64.b32encode(p.encode()).decode().rstrip("=") for p in plain] + [p.encode().hex().upper() for p in plain]
    docs = spark.createDataFrame([(i, f"see {t} ok") for i, t in enumerate(tokens + RANDOM)], "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan(docs).collect()}
    assert not any("random" in spans[i] for i in range(len(tokens)))


PERSONAL = [
    None, "", "mail a.b+c@x-y.co.uk, d@e f@g.h.i@j.k", "ip 10.0.0.255 256.1.1.1 1.2.3.4.5 01.02.03.004", "card 4111 1111 1111 1111, 4111-1111-1111-1112 1234567890123456789012",
    "tel +49 (30) 1234-5678 +1 2 +44.20.7946.0958.1234.99", "phone: 212-555-0123 or (415) 555 0100 code 123-456-78901", "write to jane [at] example [dot] org", "1" * 5000 + " @" + "a" * 5000,
]


def personal(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]{1,70}@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]{1,70}(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_personal_data_base_spans_and_more(spark):
    docs = spark.createDataFrame([*enumerate(PERSONAL), (2, PERSONAL[2]), (None, PERSONAL[3])], "doc_id long, text string")
    rows = pii.find(docs).collect()
    assert len(rows) == len(PERSONAL) + 2
    by = {r["doc_id"]: r for r in rows}
    for i, text in enumerate(PERSONAL):
        label = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in personal(text))
        assert by[i]["base_sha256"] == hashlib.sha256(label.encode()).hexdigest(), text[:50]
        assert set(filter(None, label.split(","))) <= set(by[i]["spans"].split(","))
    assert by[0]["spans"] == "" and pii.find(docs.limit(0)).count() == 0


def test_addresses_with_long_runs_of_zeros(spark):
    texts = ["0" * 5000 + ".1.2.3", "at 1." + "0" * 4301 + "255.2.3 and 1.2.3." + "0" * 6000, "0" * 5000 + "256.1.2.3"]
    rows = {r["doc_id"]: r for r in pii.find(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert [rows[i]["n_ip"] for i in range(3)] == [1, 2, 0]
    assert rows[0]["spans"] == f"ip:0:{len(texts[0])}"


def test_em_finds_both_rates_of_each_labeler():
    gen = np.random.default_rng(1)
    truth = gen.random(8000) < 0.4
    skill = np.array([[0.95, 0.85, 0.7, 0.99, 0.9], [0.9, 0.6, 0.8, 0.01, 0.95]])  # the fourth votes for whatever it sees
    v = np.stack([np.where(gen.random(8000) < 0.2, 1, np.where(gen.random(8000) < np.where(truth, a, 1 - b), 2, 0)) for a, b in skill.T], 1)
    pattern, back, n = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    chance, right = pii.em(pattern, n.astype(float))
    assert np.abs(right - skill).max() < 0.05 and ((chance[back.ravel()] > 0.5) == truth).mean() > 0.93


def test_all_personal_spans_equal_a_plain_run(spark):
    """The query's whole `spans` column against the same votes, EM and classifier over a list of all spans."""
    own = random.Random(21)
    cards = ["4111 1111 1111 1112", "4111 1111 1111 1111", "9111-1111-1111-1112"]
    texts = PERSONAL + [
        own.choice(["write to ann [at] site [dot] org please", "call (415) 555 0100 now", "phone: 212-555-0199", "order 212-555-0123x", f"card {own.choice(cards)} ok", "isbn 9781234567897123", "mail x@y.de", "tel +49 30 1234567", "host 10.1.2.3", "nothing here"])
        + " " * own.randint(1, 3) + own.choice(["", "mail jo at (at) home.example.com", "fax 030-123-4567 or (030) 123 4567 890"])
        for _ in range(300)
    ]
    fixed_spans = [pii.base_spans(t or "") for t in texts]
    spans = [[(*b, 1) for b in own] + [(*b, 0) for b in pii.proposed(t or "", own)] for t, own in zip(texts, fixed_spans, strict=True)]
    shapes = [[(k, pii.shape(pii.votes(t, k, s, e), t, s, e)) for k, s, e, _ in found] for t, found in zip(texts, spans, strict=True)]
    counted = {}
    for row in sum(shapes, []):
        counted[row] = counted.get(row, 0) + 1
    good = pii.train([(k, s, n) for (k, s), n in counted.items()], 0.9)
    want = [sorted((k, s, e) for (k, s, e, fixed), mark in zip(found, own_shapes, strict=True) if fixed or mark in good) for found, own_shapes in zip(spans, shapes, strict=True)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").withColumn("kind", pii.F.lit("x")).withColumn("n_ip", pii.F.lit(1)).withColumn("found", pii.F.lit(1))
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in w) for w in want]
    assert any(not fixed and mark in good for found, marks in zip(spans, shapes, strict=True) for (*_, fixed), mark in zip(found, marks, strict=True))
    for found in spans:  # proposed spans overlap nothing
        for k, s, e, fixed in found:
            assert fixed or not any(a < e and s < b for j, a, b, _ in found if (j, a, b) != (k, s, e))


def test_long_texts_of_many_spans_take_linear_time(spark):
    import time

    log = "token=abcdef12 1.2.3.4 key " + "Ab1" * 8 + " 4111 1111 1111 1112 x\n"
    began = time.time()
    for scan in (secrets.scan, pii.find):
        row = scan(spark.createDataFrame([(1, log * 20_000)], "doc_id long, text string")).first()
        assert row["spans"].count(",") >= 20_000 - 1
    assert time.time() - began < 60


def benjamini_hochberg(ps, q):
    """How many of the sorted p-values are rejected."""
    return max((i + 1 for i, p in enumerate(sorted(ps)) if p <= q * (i + 1) / len(ps)), default=0)


def test_false_discovery_bound_equals_brute_force():
    own = random.Random(31)
    for _ in range(300):
        bins = [own.choice([own.randint(0, 60), own.randint(0, 400), 0]) for _ in range(own.randint(1, 60))]
        counts = {b: bins.count(b) for b in bins}
        limit = secrets.first_rejected(counts, 0.01)
        assert sum(b >= limit for b in bins) == benjamini_hochberg([10 ** (-b / secrets.BINS_PER_DECADE) for b in bins], 0.01)


def wordy_tokens(n, seed):
    own = random.Random(seed)
    words = [w for w in WORDS if len(w) > 3]
    return [own.choice("-_/").join(own.choices(words, k=5)) + own.choice(["-", "/", ""]) + str(own.randint(1, 99)) for _ in range(n)]


def test_keys_of_40_symbols_are_found_whatever_else_there_is(spark):
    """Alone, mixed, and among a million wordy tokens; of wordy ones hardly any is reported."""
    own = random.Random(32)
    keys = ["".join(own.choices(B64, k=40)) for _ in range(200)]
    keys = [k for k in keys if any(c.isdigit() for c in k)]
    wordy = wordy_tokens(4000, 33)
    for texts in (keys[:1], keys, keys + wordy, keys[:5] + wordy):
        spans = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame([(i, f"see {t} ok") for i, t in enumerate(texts)], "doc_id long, text string")).collect()}
        hit = [spans[i] == f"random:4:{4 + len(t)}" for i, t in enumerate(texts)]
        n = sum(t in keys for t in texts)
        assert sum(hit[:n]) >= 0.97 * n and sum(hit[n:]) <= max(1, 0.01 * sum(hit)), (n, sum(hit[:n]), sum(hit[n:]))
    marks = lambda t: (secrets.battery(*(at := secrets.infer(t))), secrets.text_bin(t, *at))
    random_bins, text_bins = [[] for _ in "12"], [[] for _ in "12"]
    for group, tokens in enumerate((keys, wordy)):
        for p, b in map(marks, tokens):
            random_bins[group].append(secrets.p_bin(p))
            text_bins[group].append(b)
    many = 1_000_000 // len(wordy)
    limit, least = (secrets.first_rejected({b: groups[0].count(b) + many * groups[1].count(b) for b in {*groups[0], *groups[1]}}, 0.01) for groups in (random_bins, text_bins))
    assert sum(r < limit and t >= least for r, t in zip(random_bins[0], text_bins[0], strict=True)) >= 0.97 * len(keys)


def test_keys_of_every_alphabet_and_length_are_found(spark):
    """Alone in their class or among identifiers that are made of no listed word."""
    own = random.Random(41)
    low, up, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = {"base36": digits + low, "upper": digits + up, "base58": dict(secrets.ENCODINGS)["base58"], "base62": digits + low + up, "base64": B64}
    syllables = ["tor", "lun", "mek", "sab", "rin", "dol", "vet", "kur", "pon", "fas", "gil", "nep", "hob", "wim", "jat", "zet", "bra", "sto", "cle", "fri"]
    word = lambda: "".join(own.choices(syllables, k=own.randint(2, 3)))
    identifiers = [own.choice("-_/").join(word() for _ in range(own.randint(4, 6))) + own.choice(["", "-v2", "_2023", "-17", "3"]) for _ in range(500)]
    identifiers += ["".join(word().capitalize() for _ in range(own.randint(4, 6))) + own.choice(["", "2", "V1", "2024", "3D"]) for _ in range(500)]
    keys = [("".join(own.choices(symbols, k=n)), name, n) for name, symbols in alphabets.items() for n in (24, 32, 40, 64, 100, 200) for _ in range(30)]
    texts = [k for k, _, _ in keys] + identifiers
    rows = secrets.scan(spark.createDataFrame([(i, f"see {t} ok") for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    spans = {r["doc_id"]: r["spans"] for r in rows}
    hit = [bool(spans[i]) for i in range(len(texts))]
    for name in alphabets:
        short, longer = ([h for h, (_, a, n) in zip(hit, keys, strict=False) if a == name and (n < 32) == few] for few in (True, False))
        assert sum(longer) >= 0.97 * len(longer) and sum(short) >= 0.8 * len(short), (name, sum(short), sum(longer))
    assert sum(hit[len(keys):]) <= 0.05 * len(identifiers), sum(hit[len(keys):])


def test_the_battery_gives_the_p_values_of_its_definitions():
    """Chi-squared, runs and serial correlation by plain formulas, and their spread over random keys."""
    import math

    own = random.Random(42)
    ps = []
    for k in (16, 32, 36, 58, 62, 64):
        for n in (24, 40, 100):
            for _ in range(40):
                at = [own.randrange(k) for _ in range(n)]
                expected = n / k
                x = sum((at.count(s) - expected) ** 2 / expected for s in range(k))
                v = 2 / (9 * (k - 1))
                chi = 0.5 * math.erfc(((x / (k - 1)) ** (1 / 3) - 1 + v) / math.sqrt(2 * v))
                high = [2 * a >= k for a in at]
                n1, n2, runs = high.count(True), high.count(False), 1 + sum(a != b for a, b in zip(high, high[1:]))
                mean = 2 * n1 * n2 / n + 1
                sd = math.sqrt((mean - 1) * (mean - 2) / (n - 1))
                run = math.erfc(abs(runs - mean) / sd / math.sqrt(2))
                m = sum(at) / n
                r = sum((a - m) * (b - m) for a, b in zip(at, at[1:])) / sum((a - m) ** 2 for a in at)
                serial = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
                h = -math.log(chi * run * serial)
                assert abs(secrets.battery(at, k) - math.exp(-h) * (1 + h + h * h / 2)) < 1e-9
                ps.append(secrets.battery(at, k))
    assert abs(sum(p < 0.1 for p in ps) / len(ps) - 0.1) < 0.05 and sum(p < 0.001 for p in ps) < 8
    assert secrets.battery([0] * 40, 36) < 1e-9 and secrets.battery([0, 35] * 20, 36) < 1e-9


def test_context_words_begin_words_and_addresses_of_any_case_are_proposed():
    context = lambda before, kind: pii.votes(f"{before} 030 123 4567", kind, len(before) + 1, len(before) + 13)[2]
    assert [context(b, 3) for b in ("hotel", "excellent", "tel", "Telefon:", "my cell", "Anruf", "order no")] == [1, 1, 2, 2, 2, 2, 0]
    assert [context(b, 1) for b in ("description", "ip", "server")] == [1, 2, 2]
    for text in ("jane (At) siTe.org", "JANE (AT) SITE.ORG", "jane (aT) site (dot) org"):
        assert [p[0] for p in pii.proposed(text, [])] == [0]
