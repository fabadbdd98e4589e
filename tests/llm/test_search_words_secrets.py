"""Ranked search, spelling variants and secret scans against plain versions of their definitions."""

import random
import re
from collections import Counter
from hashlib import sha256
from math import floor, log
from zlib import crc32

import numpy as np
import pytest

pytest.importorskip("prismcube.llm")
from pyspark.sql import functions as F  # noqa: E402

from prismcube.llm import lexical, secret_scan, spelling  # noqa: E402
from prismcube.llm.common import Scratch  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# -- ranked search


def plain_search(docs, items, k=10):
    rows = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    n, total = len(rows), sum(x[2] for x in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    asked = {}
    for item, text in set(items):
        if text is not None:
            asked.setdefault(item, Counter()).update(TERM.findall(lower(text)))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c, length in rows:
            m = 100 - 75 + (75 * length * n) // total
            s = sum(q * floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in terms.items() if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return out


def search_case(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "ÀB", "Über", "日本"]
    some = lambda n: " ".join(words[min(int(rng.expovariate(0.12)), 63)] for _ in range(n))
    docs = [(i, some(rng.randrange(1, 60))) for i in range(300)] + [(400 + i, "w1 w2 w3 w50 copy") for i in range(40)]
    docs += [(None, "w1 w9 w60 no id")] * 2 + [(None, None), (900, None), (901, ""), (902, " .,\n"), (5, some(9)), (5, some(9)), (903, "w7 " * 5000 + "w8")]
    items = [(i, some(8)) for i in range(25)] + [(30, "w1 w1 W1 w2"), (31, None), (32, "!!"), (33, "unheard of"), (None, "w9 w60"), (34, "copy"), (34, "copy"), (35, "w3"), (35, "w50 w3")]
    return docs, items


def test_search_equals_scoring_all(spark):
    docs, items = search_case()
    want = sorted(plain_search(docs, items), key=str)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("shard", F.lit("x")).withColumn("term", F.lit(1)).repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x"))
    index = lexical.build_index(d, Scratch(spark), shard_docs=37)
    assert index.filter("term is null").count() >= 9
    for block in (1_000_000, 40):  # one block of items, and several
        got = sorted(map(tuple, lexical.search(index, q, Scratch(spark), block_terms=block).collect()), key=str)
        assert got == want


def test_search_of_empty_tables(spark):
    docs, items = search_case()
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for a, b in ((d.limit(0), q), (d, q.limit(0)), (d.filter("text is null"), q)):
        scratch = Scratch(spark)
        assert lexical.search(lexical.build_index(a, scratch), b, scratch).collect() == []


def test_non_essential_lists_are_probed_only_while_documents_qualify():
    rng = np.random.default_rng(2)
    n = 20_000
    lists = {0: np.sort(rng.choice(n, 200, replace=False)), 1: np.arange(n), 2: np.sort(rng.choice(n, 15_000, replace=False))}
    weights = np.array([9000, 30, 300], np.int64)
    s = lexical.ShardSearch(list(range(n)), rng.integers(5, 90, n).tolist(), n, 50 * n, weights)
    plain = np.zeros(n, np.int64)
    for t, docs in lists.items():
        tf = rng.integers(1, 4, len(docs)).astype(np.int32)
        s.add(t, docs.astype(np.uint16), tf)
        plain[docs] += weights[t] * lexical.impact(tf.astype(np.int64), s.m[docs])
    none = np.zeros(0, np.int64)
    scores, ids, _ = s.top([(t, 1) for t in lists], (none, none, none.astype(bool)), 10)
    best = np.lexsort((np.arange(n), -plain))[:10]
    assert ids.tolist() == best.tolist() and scores.tolist() == plain[best].tolist()
    assert s.read < 0.25 * sum(map(len, lists.values()))  # the common lists are hardly read


# -- spelling variants


def plain_words(docs):
    out = Counter()
    for i, text in docs:
        for w in map(lower, re.findall(r"[A-Za-zÀ-ÿ]+", text or "")):
            h = crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += len(w) >= 6
    return {w: n for w, n in out.items() if n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def variants(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows.collect()}


@pytest.mark.parametrize("block", [2048, 4, 0])
def test_spelling_equals_all_pairs(spark, block):
    rng = random.Random(block)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 11))) for _ in range(60)] + ["prefixed" + c for c in "abcdefgàßþÿ"] + ["x" * n for n in range(6, 12)] + ["l" * 900, "l" * 899 + "m"]
    words = {}
    for w in base:
        words[w] = rng.choice([5, 25, 125, 700])
        for _ in range(3):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("abcé") + w[i + 1 :]])
            if len(v) >= 6:
                words.setdefault(v, rng.choice([5, 6, 30, 150]))
    scratch = Scratch(spark)
    near = spelling.near_words(scratch, scratch.save(spark.createDataFrame(list(words.items()), "word string, n long"), "words"), block)
    got = sorted((r.word, r.near, r.n) for r in near.collect())
    assert got == sorted((w, v, words[v]) for w in words for v in words if w != v and one_edit(w, v))  # each once


def test_spelling_of_documents_equals_plain(spark):
    rng = random.Random(8)
    pool = ["anthology", "anthologie", "Anthology", "antholgy", "straße", "strasse", "strase", "naïveté", "naivete", "ÀÉÎÕÜ×÷", "shorts", "short", "x" * 5000]
    pool += [w[:i] + c + w[i:] for w in ("anthology", "straße") for i in (0, 3) for c in "xyz"]
    docs = [(i, " ".join(rng.choices(pool, [40 if w == "anthology" else 9 if w == "antholgy" else 2 for w in pool], k=60)) + ".1and日本anthology_") for i in range(60)]
    docs += [(None, "anthology straße"), (None, None), (70, ""), (71, None), (7, "anthology"), (7, "anthology"), (80, "longer " * 200_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("word", "n", "near", "root", "kind", "head"):
        df = df.withColumn(name, F.lit("x"))
    got = variants(spelling.spelling_variants(df))
    assert got == plain_variants(plain_words(docs))
    assert any(f for f, *_ in got.values()) and spelling.spelling_variants(df.limit(0)).collect() == []


def test_forms_are_followed_to_the_last(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [(f"v{i}", "w3") for i in range(50)], "word string, form string")
    assert {r.word: r.root for r in spelling.follow_forms(Scratch(spark), forms).collect()} == {x: "w11" for x in [f"w{i}" for i in range(11)] + [f"v{i}" for i in range(50)]}


# -- secrets

KEYWORDS = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in KEYWORDS.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def secret_docs():
    rng = random.Random(6)
    draw = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    alphabets = secret_scan.ALPHABETS
    prose = " ".join(draw("aaeeiinnoorrsstt dlmu", 6) for _ in range(4000))
    planted = {100 + i: draw(alphabets[a], n) for i, (a, n) in enumerate([("base64", 40), ("base64", 64), ("base36", 44), ("base32", 60), ("base64url", 43), ("HEX", 128), ("base64", 30_000)])}
    names = ["getElementsByTagNameNs2", "MyClassName2FactoryBeanFactory", "com/example/project7/ApplicationContext", "THE_LONG_CONSTANT_NAME_64", "aaaaaaaaaaaaaaaaaaaaaaA1", "abcdefghijklmnopqrstuvwxyzA0123456789", "internationalization20", "ABABABABABABABAB12121212"]
    docs = [(i, prose[i * 300 : i * 300 + 2000]) for i in range(60)]
    docs += [(i, f"é {prose[:50]} {s} {prose[:30]} 日") for i, s in planted.items()] + [(200 + i, f"text {s} text") for i, s in enumerate(names)]
    docs += [
        (300, 'API_KEY = "abcDEF123456/+=" and password:short Token="' + "Z" * 12 + '"'),
        (301, "ünï AKIA" + "Q7" * 8 + " AKIAshort AKIA" + "A" * 14),
        (302, "0123456789abcdef0 secret=deadbeefdeadbeef " + "f" * 15),
        (303, "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop"),
        (304, "password" + " " * 50_000 + "= " + "x1" * 20),
        (305, "token=" + draw(alphabets["base64"][:62], 40)),
        (306, None), (307, ""), (None, "passwd: aaaaaaaaaaaa"), (None, None), (300, "one id, two texts"),
    ]
    return docs + [docs[0]] * 3, planted


def test_secrets_base_and_planted(spark):
    docs, planted = secret_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("pair", F.lit("x"))
    rows = secret_scan.secret_scan(df).collect()
    assert len(rows) == len(docs)
    got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows)
    want = Counter()
    for i, t in docs:
        base = plain_base(t or "")
        want[(i, *(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")), sha256(",".join(base).encode()).hexdigest())] += 1
    assert got == want
    texts = dict(docs)
    random_spans = {}
    for r in rows:
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == plain_base(texts[r.doc_id] or "") or r.doc_id in (None, 300)
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
        for s in spans:
            if s.startswith("random"):
                _, a, b = s.split(":")
                random_spans.setdefault(r.doc_id, []).append(texts[r.doc_id][int(a) : int(b)])
    assert random_spans == {i: [s] for i, s in planted.items()}  # all that is planted, no name and no word
    assert secret_scan.secret_scan(df.limit(0)).collect() == []


def test_battery_level_and_power():
    for name, alphabet in secret_scan.ALPHABETS.items():
        for n in (16, 24, 40, 96):
            draws = np.random.default_rng(n).integers(0, len(alphabet), (3000, n))
            kept = (secret_scan.battery(draws, name) <= secret_scan.random_limit(name, n)).mean()
            assert 0.975 < kept < 0.998  # about 1 - ALPHA
    steps = np.arange(36)[None, :] % 36  # a sequence: uniform, but its neighbours are correlated
    assert secret_scan.battery(steps, "base36")[0] > secret_scan.random_limit("base36", 36)
    assert secret_scan.encoding(b"0123456789012345") is None and secret_scan.encoding(b"abcdefghijklmnopq") is None and secret_scan.encoding(b"ABCDEF2345670ABC") == "HEX"


def test_benjamini_hochberg_equals_sorted_p_values():
    rng = random.Random(1)
    bins = Counter(int(rng.expovariate(1 / 60)) for _ in range(2000)) + Counter(int(900 + rng.expovariate(1 / 300)) for _ in range(100))
    p = sorted(-b / 100 for b in bins.elements())
    fine = [x for i, x in enumerate(p, 1) if x <= log(0.05 * i / len(p))]
    assert secret_scan.largest_log_p(list(bins.items()), 0.05) == max(fine)
    assert secret_scan.largest_log_p([(0, 50)], 0.05) is None and secret_scan.largest_log_p([], 0.05) is None


def test_short_runs_have_to_look_more_random():
    pairs = np.zeros((256, 256))
    text = np.frombuffer(b"the rain in spain stays mainly in the plain and 12 or 34 of 1999 Names Were There " * 50, np.uint8)
    np.add.at(pairs, (text[:-1], text[1:]), 1)
    total = 7.0  # an ordinary sum of a random run
    p = [secret_scan.log_p(total, secret_scan.text_null("base64", n, pairs)) for n in (16, 24, 40, 64)]
    assert p == sorted(p, reverse=True) and p[0] > 2 * p[-1]
