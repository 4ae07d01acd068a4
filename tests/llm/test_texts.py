"""Operators that look into texts: SimHash, packing, fingerprints, secrets, language, scores, pipeline."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallywell.llm import langid, lm, packing, queries, secrets, simhash, sketch
from tallywell.llm.graph import components
from tallywell.llm.secrets import scan_secrets


def fingerprint_by_hand(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def by_hand(prints, radius=3):
    """The least key each key reaches."""
    label = dict((k, k) for k in prints)
    moved = True
    while moved:
        moved = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[b] < label[a]:
                    label[a], moved = label[b], True
    return label


def test_simhash(spark, plain, texts, docs, data, empty):
    got = {r.doc_id: r for r in queries.op8_simhash(spark, plain).collect()}
    prints = {k: fingerprint_by_hand(t) for k, t in texts.items()}
    assert {k: int(r.fingerprint, 16) for k, r in got.items()} == prints
    assert {k: r.component_id for k, r in got.items()} == by_hand(prints)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = by_hand({k: fingerprint_by_hand(t) for k, t in texts.items()})
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.simhash_components(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0
    assert simhash.simhash_components(docs).count() == len(data)


def test_every_pair_within_the_radius_shares_a_table():
    r = random.Random(5)
    for depth, masks in enumerate(simhash.mask_levels(3)):
        for _ in range(300):
            difference = sum(1 << b for b in r.sample(range(64), 3))
            assert any(not m & difference for m in masks), depth


@pytest.mark.parametrize("bucket", [2, 512])
def test_large_buckets_lose_no_link(spark, bucket):
    r = random.Random(7)
    centre = r.getrandbits(64)
    prints = {centre}
    for _ in range(120):
        prints.add(r.choice(sorted(prints)) ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3, 4]))))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    table = spark.createDataFrame(signed, "simhash long")
    roots = {r.node: r.root for r in components(simhash.near_fingerprints(table, 3, bucket)).collect()}
    want = by_hand({s: s & (2**64 - 1) for (s,) in signed})
    assert {s: roots.get(s, s) for (s,) in signed} == want


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.tokenizer_path())


def test_ids_are_those_of_the_whole_text(tokenizer):
    r, words = random.Random(3), packing.WordIds(queries.tokenizer_path())
    letters = " \n\t\r　 ab.,'s|é中😀1!ÄᾳʰⅫ²½​<|endoftext|>_Ġ-"
    for i in range(4000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 14)))
        text = text.replace("  ", " ") if i % 3 else text.replace("a", "<|endoftext|>")
        assert np.frombuffer(words.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(rows, ids_of, capacity):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids_of.keys()
    for k, own in pieces.items():
        ids, at = ids_of[k], 0
        for i, p in enumerate(sorted(own, key=lambda p: p.piece)):
            assert (p.piece, p.start) == (i, at) and 0 < p.length <= capacity and (i == 0 or p.length == capacity)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids) and (len(own) == 1 or len(ids) > capacity)
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(map(len, ids_of.values())) // capacity)


def test_packing(spark, plain, texts, tokenizer, docs, empty, data):
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts.items()}
    used, least = check_packing(queries.op10_packing(spark, plain).collect(), ids, 2048)
    assert used <= least + 1
    small = packing.pack(spark.read.parquet(f"{plain}/documents.parquet"), queries.tokenizer_path(), 100)
    check_packing(small.collect(), ids, 100)
    repeated = packing.pack(docs, queries.tokenizer_path()).collect()
    assert sum(r.piece == 0 for r in repeated) == len(data)
    assert len({(r.sequence_id, r.offset) for r in repeated}) == len(repeated)
    assert packing.pack(empty, queries.tokenizer_path()).count() == 0


def test_bins():
    r = random.Random(11)
    for _ in range(200):
        capacity = r.choice([10, 30, 97])
        lengths = Counter(r.randint(1, capacity) for _ in range(r.randint(0, 60)))
        plan = packing.plan_bins(lengths, capacity)
        packed = Counter()
        for bins, items in plan:
            assert bins > 0 and sum(n * k for n, k in items) <= capacity
            assert sum(k for n, k in items if 3 * n > capacity) <= 2
            for n, k in items:
                packed[n] += bins * k
        assert packed == lengths
    assert len(packing.plan_bins({6: 1, 4: 1, 3: 2, 2: 2}, 10)) == 2


def test_fingerprints(spark, plain, texts, docs, data, empty):
    got = {r.doc_id: r for r in queries.op3_fingerprints(spark, plain).collect()}
    order = sorted(texts)
    bodies = {k: texts[k] or "" for k in order}

    def likeness(a, b):
        a, b = (set(sketch.paragraph_digests(x).tolist()) for x in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, k in enumerate(order):
        text, following = bodies[k], bodies[order[(i + 1) % len(order)]]
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert math.isclose(r.near_edited, likeness(text, changed)) and math.isclose(r.near_next, likeness(text, following))
    assert got[3].fingerprint == got[24].fingerprint != got[5].fingerprint
    # every block boundary has its neighbour
    small = sketch.with_next(spark.read.parquet(f"{plain}/documents.parquet"), "doc_id", "text", 4)
    assert small.filter("not extra").count() == len(order) and small.select("block").distinct().count() > 4
    assert sketch.fingerprint_edits(docs).count() == len(data)
    assert sketch.fingerprint_edits(empty).count() == 0
    lone = sketch.fingerprint_edits(docs.filter("doc_id = 7")).first()
    assert lone.near_next == 1.0


def test_peeling_recovers_differences():
    r = np.random.default_rng(1)
    pairs = [(int(a), int(b), int(c)) for a, b, c in r.integers(0, 400, (40, 3))] + [(0, 0, 0), (5, 0, 0), (0, 3000, 0)]
    keys = [r.integers(0, 2**63, a + b + c, dtype=np.uint64) for a, b, c in pairs]
    only_a, only_b = sketch.differences(
        [k[: a + c] for k, (a, _, c) in zip(keys, pairs)], [np.concatenate([k[a : a + c], k[a + c :]]) for k, (a, _, c) in zip(keys, pairs)]
    )
    assert only_a.tolist() == [p[0] for p in pairs] and only_b.tolist() == [p[1] for p in pairs]


BASE = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), "assign", lambda m: len(m[2]) >= 12),
    (re.compile("AKIA[A-Z0-9]+"), "access", lambda m: len(m[0]) >= 18),
    (re.compile("[0-9a-f]+"), "hex", lambda m: len(m[0]) >= 16),
]


def base_by_hand(text):
    return sorted((m.start(), i, m.end(), kind) for i, (p, kind, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m))


def battery_by_hand(s, kind):
    """The three tests, from their definitions."""

    def tail(z):
        return math.erfc(z / math.sqrt(2)) / 2

    a = secrets.ALPHABETS[kind]
    k, n, d = len(a.digits), len(s), [a.digits.index(c) for c in s]
    edges = np.cumsum(a.classes)
    cls = [int(np.searchsorted(edges, x, side="right")) for x in d]
    chi = max(0, sum(v * v for v in Counter(d).values()) * k / n - n)
    uniform = tail(((chi / (k - 1)) ** (1 / 3) - (1 - 2 / 9 / (k - 1))) / math.sqrt(2 / 9 / (k - 1)))
    q = [c / k for c in a.classes]
    p, both = 1 - sum(x * x for x in q), sum(x * (1 - x) ** 2 for x in q)
    spread = math.sqrt((n - 1) * p * (1 - p) + 2 * (n - 2) * (both - p * p))
    runs = 2 * tail(abs(sum(x != y for x, y in zip(cls, cls[1:])) - (n - 1) * p) / spread)
    mean = sum(d) / n
    power = sum((x - mean) ** 2 for x in d)
    serial = 2 * tail(abs(sum((x - mean) * (y - mean) for x, y in zip(d, d[1:])) / power * math.sqrt(n))) if power else 0
    return 1 - (1 - min(uniform, runs, serial, 1)) ** 3


UP, LOW, NUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
FAMILIES = {
    "hex": (NUM + "abcdef", 32), "HEX": (NUM + "ABCDEF", 20), "base32": (UP + "234567", 32), "base36": (NUM + LOW, 32), "BASE36": (NUM + UP, 32),
    "base62": (UP + LOW + NUM, 18), "base64": (UP + LOW + NUM + "+/", 24), "letters": (UP + LOW, 40), "lower": (LOW, 64),
}


def test_battery_is_that_of_the_definitions(spark):
    r = random.Random(3)
    rows = [(k, "".join(r.choices(a.digits, k=r.randint(a.least, 90)))) for k, a in secrets.ALPHABETS.items() for _ in range(20)]
    rows += [("random_base62", "getUserAccountNameById2"), ("random_base36", "a" * 30), ("random_letters", "thequickbrownfoxjumpsoverthelazydogandrunsaway" * 2)]
    table = spark.createDataFrame(rows, "kind string, plain string")
    for got in table.select("*", secrets.battery(F.col("plain"), F.col("kind")).alias("p")).collect():
        assert math.isclose(got.p, battery_by_hand(got.plain, got.kind), abs_tol=2e-6), got


def test_random_strings_are_found_and_words_are_not(spark):
    r = random.Random(6)
    words = sorted(set(re.findall("[a-z]{3,9}", " ".join((m.__doc__ or "") for m in (random, re, hashlib, math, np)).lower())))
    table = [(name, "".join(r.choices(letters, k=n))) for name, (letters, n) in FAMILIES.items() for _ in range(200)]
    for _ in range(300):
        camel = r.choice(words) + "".join(w.capitalize() for w in r.choices(words, k=4))
        table += [("camel", camel), ("snake", re.sub("([A-Z])", r"_\1", camel).lower()), ("numbered", f"{camel.lower()}{r.randrange(1000)}")]
    found = Counter()
    docs = spark.createDataFrame([(i, name, f"x {s}, y") for i, (name, s) in enumerate(table)], "doc_id long, name string, text string")
    got = scan_secrets(docs).join(docs, "doc_id").collect()
    for row in got:
        found[row.name] += any(s.start == 2 and s.end == len(row.text) - 3 and s.place > 2 for s in row.found)
    assert all(found[name] >= 180 for name in FAMILIES), found
    assert found["camel"] <= 15 and found["snake"] <= 6 and found["numbered"] <= 6, found


def test_a_text_of_many_strings(spark):
    r = random.Random(7)
    text = " ".join("".join(r.choices(UP + LOW + NUM, k=20)) for _ in range(8000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    scan_secrets(docs.limit(0)).collect()
    start = time.time()
    (row,) = scan_secrets(docs).collect()
    assert time.time() - start < 8 and sum(s.kind == "random_base62" for s in row.found) > 7200


def test_limits_leave_random_strings_alone():
    even = {b: round(2000 * (10 ** (-b / 20) - 10 ** (-(b + 1) / 20))) for b in range(60)}
    assert secrets.limit_of(even, 0.05) < 0.01
    mixed = {**even, 30: even[30] + 500, 50: 900}
    assert 10 ** (-31 / 20) < secrets.limit_of(mixed, 0.05) <= 0.05
    assert secrets.limit_of({3: 1}, 0.05) == secrets.limit_of({8: 1}, 0.05) == 0 and secrets.limit_of({100: 1}, 0.05) == 10**-5 and secrets.limit_of({26: 1}, 0.05) == 0.05


def test_secret_query(spark, plain, texts):
    for r in queries.op9_secrets(spark, plain).collect():
        want = base_by_hand(texts[r.doc_id])
        n = Counter(kind for *_, kind in want)
        spans = [f"{kind}:{start}:{end}" for start, _, end, kind in want]
        assert (r.n_assign, r.n_access, r.n_hex) == (n["assign"], n["access"], n["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if not x.startswith("random_") and x] == spans


def test_secrets(spark, docs, data, empty):
    r = random.Random(2)
    base64 = "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=60))
    table = [
        (1, f"é😀 PassWord : 'abcdef123456' and token=short api_key=\"{base64}\" end"),
        (2, "secret: token: abcdefghijklmnop AKIAAKIAABCDEFGH12 AKIASHORT feedfacefeedface0"),
        (3, "aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1aB1"), (4, None), (5, ""),
    ]
    got = {r.doc_id: r.found for r in scan_secrets(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    for k, text in table:
        assert [(s.start, s.place, s.end, s.kind) for s in got[k] if s.place < 3] == base_by_hand(text)
    mixed = {r.doc_id: r.found for r in scan_secrets(docs).collect()}
    for k, text, *_ in data:
        if k is not None:
            assert [(s.start, s.place, s.end, s.kind) for s in mixed[k] if s.place < 3] == base_by_hand(text)
    assert any(s.kind == "random_base64" for s in got[1]) and not any(s.place > 2 for s in got[3])
    assert got[4] == got[5] == []
    assert scan_secrets(docs).count() == len(data) and scan_secrets(empty).count() == 0


def test_languages(spark, docs, data, empty):
    small = langid.Training(bits=12, per_language=500, shards=2)
    model = langid.fit(docs.filter("doc_id < 18"), training=small)
    assert model.languages == ["de", "en"] and model.temperature > 0
    got = langid.predict(docs, model).collect()
    assert len(got) == len(data)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and 18 <= r.doc_id < 24:
            assert r.lang_pred == r.lang
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    none = langid.fit(empty, training=small)
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}


def test_temperature_is_that_of_smoothed_labels():
    r = np.random.default_rng(5)
    # all right: the chance of a mistake is that of one in n + 2, not none
    sure = np.eye(3)[np.arange(90) % 3] * 0.5
    t = langid.best_temperature(sure, np.arange(90) % 3)
    assert math.isclose(langid.softmax(sure[:1] / t).max(), 1 - 1 / 92, rel_tol=1e-3)
    # labels drawn at a known temperature
    logits = r.normal(size=(40_000, 4))
    labels = np.array([r.choice(4, p=p) for p in langid.softmax(logits / 0.4)])
    assert abs(langid.best_temperature(logits, labels) - 0.4) < 0.03
    assert langid.best_temperature(np.zeros((0, 3)), np.array([], int)) == 1


def ftrl_by_hand(rows, classes, t):
    """One weight after another."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(p, c):
        if abs(z[p, c]) <= t.l1:
            return 0.0
        return -(z[p, c] - math.copysign(t.l1, z[p, c])) / ((t.beta + math.sqrt(n[p, c])) / t.rate + t.l2)

    order = np.random.default_rng(t.seed)
    for _ in range(t.epochs):
        for i in order.permutation(len(rows)):
            label, places, values = rows[i]
            w = {(p, c): weight(p, c) for p in places for c in range(classes)}
            e = [math.exp(sum(v * w[p, c] for p, v in zip(places, values))) for c in range(classes)]
            for c in range(classes):
                error = e[c] / sum(e) - (c == label)
                for p, v in zip(places, values):
                    g = v * error
                    z[p, c] += g - (math.sqrt(n[p, c] + g * g) - math.sqrt(n[p, c])) / t.rate * w[p, c]
                    n[p, c] += g * g
    return {k: weight(*k) for k in list(z)}


def test_weights_are_those_of_plain_ftrl():
    r, t = random.Random(1), langid.Training(bits=5)
    rows = []
    for i in range(30):
        places = sorted(r.sample(range(32), 6))
        rows.append((i % 3, places, [r.random() for _ in places]))
    got = langid.train_shard(pd.DataFrame(rows, columns=["label", "places", "values"]).map(lambda x: np.array(x) if isinstance(x, list) else x), 3, t)
    for (p, c), w in ftrl_by_hand(rows, 3, t).items():
        assert math.isclose(got[p, c], w, abs_tol=1e-9)


def test_language_query(spark, plain, texts):
    rows = queries.op2_langid(spark, plain).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not any(c.isalpha() for c in texts[r.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("de", "en") and 0.5 <= r.score < 1
    long = [r for r in rows if r.doc_id < 24]
    assert sum(r.lang_pred == ("en", "de")[r.doc_id % 2] for r in long) >= 23


def test_score_query(spark, plain, texts):
    rows = queries.op4_lm_scores(spark, plain).collect()
    assert {r.doc_id: r.held_out for r in rows} == {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    words = {k: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None] for k, t in texts.items()}
    c = Counter(w for r in rows if not r.held_out for w in words[r.doc_id])
    n, v = sum(c.values()), len(c)
    for r in rows:
        own = words[r.doc_id]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, base, abs_tol=1e-6) and r.score < 0


def test_scores(spark, docs, data, empty):
    table = docs.withColumn("learn", F.coalesce(F.col("doc_id"), F.lit(0)) % 4 != 1)
    got = lm.score_texts(table, "learn", parameters=lm.Parameters(symbols=8, frequent=20)).collect()
    assert len(got) == len(data)
    bodies = [(r[1], (r[0] or 0) % 4 != 1) for r in data]
    split = [((re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None]), learn) for t, learn in bodies]
    c = Counter(w for words, learn in split if learn for w in words)
    total, distinct = sum(c.values()), len(c)
    want = sorted(
        (len(words), sum(c[w] > 0 for w in words), round(sum(math.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words), 6))
        for words, _ in split
    )
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total}
    assert all(r.score < 0 and math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens)) for r in got)
    held = [r for r in got if not r.learn and r.n_tokens > 50]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.score_texts(empty.withColumn("learn", F.lit(True)), "learn").count() == 0
    assert lm.score_texts(docs.withColumn("learn", F.lit(False)), "learn").count() == len(data)


def small_corpus():
    r = np.random.default_rng(8)
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(70)]
    weights = 1 / np.arange(1, 71)
    return [" ".join(r.choice(words, 40, p=weights / weights.sum())) for _ in range(30)], words


def test_rare_words_after_every_word(spark):
    """Outcomes add up to one after any word, and restaurants of pairs are those that plain counts make."""
    learned, words = small_corpus()
    p = lm.Parameters(symbols=5, frequent=20)
    c = Counter(w for t in learned for w in t.split())
    ranked = sorted(c, key=lambda w: (-c[w], w))
    before = [ranked[0], ranked[9], *ranked[30:36], "neverbefore"]
    asked = [*before, *(f"{u} {w}" for u in before for w in [*ranked, "neverthere"])]
    table = spark.createDataFrame([(i, t, i < len(learned)) for i, t in enumerate([*learned, *asked])], "doc_id long, text string, learn boolean").repartition(4)
    score = {r.text: r.score for r in table.join(lm.score_texts(table, "learn", parameters=p).drop("learn"), "doc_id").collect()}

    # the model's symbols, to take the ends of texts out of the scores
    texts = table.filter("learn")
    top = lm.frequent_words(lm.word_counts(texts, "text"), p.frequent)[0].toPandas()
    vocabulary = lm.Vocabulary([bytes(w) for w in top.word], top.c.to_numpy(np.int64), p.symbols)
    frequent = {w.decode() for w in vocabulary.words}
    assert 5 < len(frequent) <= 20
    symbols = lm.symbol_model(lm.symbol_counts(texts, "text", vocabulary), p)
    kind = {w: vocabulary.symbol_of[vocabulary.index.get(w.encode(), -1)] for w in [*ranked, *before, "neverthere"]}

    def log10(w, u):
        return score[f"{u} {w}"] - symbols[kind[w], vocabulary.end] - score[u] + symbols[kind[u], vocabulary.end]

    for u in before:
        total = sum(10 ** log10(w, u) for w in [*ranked, "neverthere"]) + 10 ** symbols[kind[u], vocabulary.end]
        assert math.isclose(total, 1, rel_tol=1e-4)

    # rare words after rare words: counts, one table for a single customer, and the parent's share
    pairs = Counter((u, w) for t in learned for u, w in zip([None, *t.split()], t.split()) if w not in frequent)
    n = Counter(pairs.values())
    d = lm.discount(np.array([1, 2]), np.array([n[1], n[2]]))
    for u in before[2:-1]:
        own = {w: k for (v, w), k in pairs.items() if v == u}
        for w in (x for x in ranked if x not in frequent):
            parent, found = (10 ** (log10(w, v) - symbols[vocabulary.rare, vocabulary.rare]) for v in ("neverbefore", u))
            k, tables, customers = own.get(w, 0), len(own), sum(own.values())
            # several customers have several tables at most
            spare = sum(x - 1 for x in own.values())
            low, high = ((k - d * max(t, 0) + (1 + d * total) * parent) / (customers + 1) for t, total in ((k, tables), (min(k, 1), tables + spare)))
            assert low * 0.999 <= found <= high * 1.001
            if not spare:
                assert math.isclose(low, found, rel_tol=1e-3)


def test_frequent_words_after_every_word(spark):
    """Restaurants of frequent words after words that are no symbols are those that plain counts make."""
    learned, words = small_corpus()
    # a frequent word that never stands after one that is as frequent as it, and after a rare one
    learned += [f"{words[12]} {words[8]} {words[50]} {words[2]}"] * 6
    p = lm.Parameters(symbols=5, frequent=20)
    c = Counter(w for t in learned for w in t.split())
    texts = spark.createDataFrame([(t,) for t in learned], "text string")
    top = lm.frequent_words(lm.word_counts(texts, "text"), p.frequent)[0].toPandas()
    vocabulary = lm.Vocabulary([bytes(w) for w in top.word], top.c.to_numpy(np.int64), p.symbols)
    frequent = [w.decode() for w in vocabulary.words]
    symbols, others = frequent[:5], frequent[5:]
    assert len(others) > 5
    model = lm.symbol_model(lm.symbol_counts(texts, "text", vocabulary), p)
    kind = {w: vocabulary.symbol_of[vocabulary.index.get(w.encode(), -1)] for w in [*c, "neverbefore"]}
    rare = [w for w in c if w not in frequent]
    before = [*others, *rare[:8], words[50], "neverbefore"]
    asked = [*{*symbols, *before}, *(f"{u} {w}" for u in {*symbols, *before} for w in frequent)]
    table = spark.createDataFrame([(i, t, i < len(learned)) for i, t in enumerate([*learned, *asked])], "doc_id long, text string, learn boolean").repartition(4)
    score = {r.text: r.score for r in table.join(lm.score_texts(table, "learn", parameters=p).drop("learn"), "doc_id").collect()}

    def chance(w, u, given):
        """Of a word after another, given that a word of some kind follows."""
        return 10 ** (score[f"{u} {w}"] - model[kind[w], vocabulary.end] - score[u] + model[kind[u], vocabulary.end]) / given

    def check(us, ws, parent):
        pairs = Counter((u, w) for t in learned for u, w in zip(t.split(), t.split()[1:]) if u in us and w in ws)
        n = Counter(k for (u, w), k in Counter((u, w) for t in learned for u, w in zip([None, *t.split()], t.split()) if (u in symbols or u is None) == (us == symbols) and w in ws).items())
        d = lm.discount(np.array([1, 2]), np.array([n[1], n[2]]))
        for u in us:
            own = {w: k for (v, w), k in pairs.items() if v == u}
            customers, tables, spare = sum(own.values()), len(own), sum(x - 1 for x in own.values())
            after = sum(10 ** model[kind[u], : vocabulary.other + 1]) if us != symbols else 10 ** model[kind[u], vocabulary.other]
            found = {w: chance(w, u, after) for w in ws}
            assert math.isclose(sum(found.values()), 1, rel_tol=1e-3)
            for w in ws:
                k, above = own.get(w, 0), parent(u, w)
                low, high = ((k - d * t + (1 + d * total) * above) / (customers + 1) for t, total in ((k, tables), (min(k, 1), tables + spare)))
                assert low * 0.999 <= found[w] <= high * 1.001

    by_itself = {w: chance(w, "neverbefore", 10 ** model[vocabulary.rare, vocabulary.other]) for w in others}

    def of_class(u, w):
        kinds = model[kind[u], : vocabulary.other + 1]
        logs = model[kind[u], kind[w]] + (math.log10(by_itself[w]) if w in others else 0)
        return 10**logs / sum(10**kinds)

    check(symbols, others, lambda u, w: by_itself[w])
    check(before, frequent, of_class)
    assert score[f"{words[12]} {words[8]}"] > score[f"{words[12]} {words[9]}"] + 0.3


def test_pairs_of_rare_words_are_remembered(spark):
    learned, _ = small_corpus()
    copy = " ".join(f"rare{i}" for i in range(30))
    shuffled = " ".join(f"rare{i * 7 % 30}" for i in range(30))
    rows = [*((t, True) for t in [*learned, copy, copy]), (copy, False), (shuffled, False)]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, learn boolean")
    got = {r.doc_id: r.score for r in lm.score_texts(table, "learn", parameters=lm.Parameters(symbols=5, frequent=20)).collect()}
    last = len(rows) - 1
    assert got[last - 1] > got[last] + 20 and math.isclose(got[last - 1], got[last - 2])


def test_restaurants_add_up_to_one():
    r = np.random.default_rng(4)
    counts = r.poisson(0.7, (30, 30))
    p = lm.symbol_model(counts.copy(), lm.Parameters())
    assert np.allclose((10.0**p).sum(axis=1), 1)
    customers = r.poisson(50, 2000)
    tables = lm.seat(customers, np.full(2000, 0.4), 0.6, np.arange(2000, dtype=np.uint64), 1)
    assert (tables <= customers).all() and (tables[customers > 0] >= 1).all()
    # as many as one customer after another would open, on average
    by_hand = []
    for n in customers[:400]:
        t = 0
        for i in range(n):
            t += i == 0 or r.random() < 0.4 / (0.4 + i - 0.6 * t)
        by_hand.append(t)
    assert abs(np.mean(by_hand) - tables.mean()) < 0.15


def test_pipeline(spark, plain, texts, docs, empty):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "source_mix", "packing"]
    kept = spark.read.parquet(f"{plain}/documents.parquet")
    columns = kept.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, plain).cache()
        assert kept.columns == columns
        ids = {r.doc_id for r in kept.collect()}
        if name == "quality_rules":
            assert set(range(24)) <= ids and not ids & {27, 28, 29, 30, 31, 32}
        if name == "near_dedup":
            assert len(ids) == kept.count() and not {24, 25} & ids and {3, 5} <= ids
        assert ids <= {r.doc_id for r in before.collect()}
    packed = corpus_pipeline.run(spark, plain).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in kept.collect())
    for table in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, table, plain)
            assert name == "packing" or got.columns == docs.columns
            got.count()
