"""Token counts, license scans, classifier, token files, decontamination, mixing and chat against brute force."""

import hashlib
import random
import re
import zlib

import pytest

pytest.importorskip("prismcube.llm")
P = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from prismcube.llm import chat, decontaminate, license_scan, mixing, quality, token_counts, token_files  # noqa: E402
from prismcube.llm.common import read  # noqa: E402

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "  two  spaces ", "\n\tx\r\n", "<|endoftext|> a", "é中文\U0001d4b3 ß", "MIT License mit-license", "▁a ▁▁ b", "<unk>中<unk> a", "it's 12 'll!! ..x y  z \x1c q", "a, b. ½. x².,; ab_. don't. it's, 'ré's é! #!? _. __a z-"]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def odd_docs(spark):
    rows = [(i, t, None if i % 2 else "en", f"s{i % 3}", None) for i, t in enumerate(ODD)]
    rows += [(None, "null id", None, None, 3), (3, ODD[3], None, "s0", 1), (3, ODD[3], None, "s0", 1)]
    rows += [(100, "long word " + "x" * 50_000 + " apache license " * 300, None, None, None)]
    return spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit(1)).withColumn("size", F.lit("x"))


def texts(spark, sf):
    return [r.text for r in read(spark, sf, "documents").select("text").collect()]


def test_token_counts_equal_the_library(spark, sf):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_counts.vocabulary(P.path("piece_bpe_32k.model"))
    tok = Tokenizer(models.Unigram(pieces, 0, True))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = token_counts.Counter(pieces)
    rng = random.Random(1)
    some = [t or "" for t in ODD] + texts(spark, sf)[:60] + ["".join(rng.choice("ab▁ <unk>0x中é\n") for _ in range(60)) for _ in range(200)]
    assert [counter.text(t) for t in some] == [len(e.ids) for e in tok.encode_batch(some, add_special_tokens=False)]
    small = [("?", 0.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.5), ("ab", -2.5), ("▁", -0.5), ("▁a", -1.5)]  # ties everywhere, no bytes
    tok, counter = Tokenizer(models.Unigram(small, 0, False)), token_counts.Counter(small)
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    some = ["".join(rng.choice("aab c") for _ in range(12)) for _ in range(300)]
    assert [counter.text(t) for t in some] == [len(tok.encode(t, add_special_tokens=False).ids) for t in some]
    got = token_counts.token_counts(odd_docs(spark), P.path("piece_bpe_32k.model")).collect()
    assert len(got) == len(ODD) + 4 and {r.n_tokens for r in got if r.doc_id in (0, 1)} == {0}


def test_token_counts_of_long_words(spark, monkeypatch):
    from tokenizers import Tokenizer, models, pre_tokenizers

    small = [("?", 0.0), ("a", -1.0), ("aa", -2.0), ("aaab", -2.5), ("b", -1.5), ("▁", -0.5), ("▁a", -1.5)]
    tok, rng = Tokenizer(models.Unigram(small, 0, False)), random.Random(3)
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    monkeypatch.setattr(token_counts, "WINDOW", 16)  # the window moves on
    counter = token_counts.Counter(small)
    for _ in range(100):
        t = "".join(rng.choice("aaabx") for _ in range(rng.randrange(1, 300)))
        assert counter.text(t) == len(tok.encode(t, add_special_tokens=False).ids)
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    got = token_counts.token_counts(df, P.path("piece_bpe_32k.model"))
    assert got.schema["doc_id"].dataType.simpleString() == "int" and got.filter("n_tokens = 0").count() == 1
    assert token_counts.token_counts(df.limit(0), P.path("piece_bpe_32k.model")).collect() == []


def test_license_base_places(spark, sf):
    docs = odd_docs(spark).unionByName(read(spark, sf, "documents"), allowMissingColumns=True)
    got = license_scan.license_scan(docs.select("doc_id", "text")).collect()
    want = []
    for r in docs.collect():
        words = WORD.findall(lower(r.text))
        places = [(i, label) for phrase, label in license_scan.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in places]
        want.append((r.doc_id, len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    key = lambda x: str(x)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.score == 0) == (r.labels == "")


def test_license_rules_and_suppression():
    scanner = license_scan.Scanner()
    assert len(scanner.rules) > 200
    labels = lambda t: [(scanner.rules[i].label, scanner.rules[i].kind) for _, _, i in scanner.scan(t.encode())]
    assert labels("SPDX-License-Identifier: MIT") == [("mit", "spdx")]
    assert ("apache-2.0", "grant") in labels("Licensed under the Apache License, Version 2.0.") and ("apache", "base") in labels("Licensed under the Apache License, Version 2.0.")
    assert labels("Creative Commons Attribution 4.0, CC BY-NC 4.0") == [("cc-by-4.0", "title"), ("cc-by-nc-4.0", "title")]
    assert ("gpl-3.0", "grant") in labels("This work is licensed under the GNU General Public License, version 3.")
    assert labels("all is permitted, admit licenses") == []


LICENSE_TEXTS = [
    "Released under the terms of the GNU Lesser General Public License, version 2.1 or later; see gnu.org/licenses/lgpl-2.1.html.",
    "// SPDX-License-Identifier: MIT OR (Apache-2.0 AND GPL-2.0+)\nMIT License, MIT license mit license",
    "Apache License 2.0, Apache License, Version 2.0, ASL 2.0 and http://www.apache.org/licenses/LICENSE-2.0.txt",
    "This is dual licensed under the MIT X11 license and the new BSD license. BSD licensed. All rights reserved.",
    "This work is licensed under CC BY-NC-SA 4.0, not under CC BY 3.0 nor Creative Commons.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "opensource.org/licenses/mitre-thing fooUnlicense.org https://unlicense.org/ www.opensource.org/licenses/mit-license.php. unlicense.org.evil.com",
    "GPLv2 GPL-2.0 gpl 3 LGPLv3+ agpl v3.0 GNU GPL; gpl 20; the ISC license; mpl-2.0",
    "Mozilla Public License Mozilla Public License 1.1 MPL 2",
]


def test_license_labels_equal_brute_force(spark):
    # every rule on every text without keywords, grants by one whole pattern, and suppression by all pairs
    scanner, rng = license_scan.Scanner(), random.Random(8)
    rules, ranks = scanner.rules, scanner.ranks
    words = " ".join(LICENSE_TEXTS).split()
    some = LICENSE_TEXTS + [" ".join(rng.choice(words) for _ in range(60)) for _ in range(150)] + ["", "mit license " * 30]
    granting = rf"{license_scan.START}(?:{license_scan._spread(license_scan.GRANTS)}){license_scan.SEP}(?:(?:the|a|an|gnu|same|terms|of){license_scan.SEP}){{0,4}}"
    grants = {i: re.compile(granting + "(?=" + r.pattern.pattern + ")", re.S) for i, r in enumerate(rules) if r.kind == "title"}
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").withColumn("label", F.lit(1))).collect()}
    seen = set()
    for n, text in enumerate(some):
        t, found = text.lower(), []
        for i, r in enumerate(rules):
            if r.kind == "spdx":
                for e in license_scan.EXPRESSION.finditer(t):
                    found += [(m.start(), m.end(), i) for m in re.finditer(r"(?<![0-9a-z.+-])" + r.pattern.pattern + r"\+?(?![0-9a-z:+-]|\.[0-9a-z])", t[: e.end(1)]) if m.start() >= e.start(1)]
            elif r.kind != "grant":
                for m in r.pattern.finditer(t):
                    before = [g for g in grants[i].finditer(t) if g.end() == m.start()] if i in grants else []
                    found.append((before[0].start(), m.end(), i + 1) if before else (*m.span(), i))
        found.sort(key=lambda f: (ranks[f[2]], f[0] - f[1], f[2], f[0]))
        kept = []
        for a, b, i in found:
            if ranks[i] == 0 or not any(x <= a and b <= y for x, y, _ in kept):
                kept.append((a, b, i))
        best = {}
        for _, _, i in kept:
            best[rules[i].label] = max(best.get(rules[i].label, 0), license_scan.KINDS[rules[i].kind][1])
        miss = 1.0
        for c in best.values():
            miss *= 1 - c
        assert scanner.scan(text.encode()) == sorted(kept), text
        assert got[n].labels == ",".join(sorted(best)) and abs(got[n].score - (1 - miss)) < 1e-12
        seen |= set(best)
    assert len(seen) > 15
    assert license_scan.license_scan(spark.createDataFrame([], "doc_id int, text string")).collect() == []


def test_license_addresses_and_versions():
    scanner = license_scan.Scanner()
    labels = lambda t: {scanner.rules[i].label for _, _, i in scanner.scan(t.encode())}
    assert labels("opensource.org/licenses/mitre-thing") == set() and labels("fooUnlicense.org") == set() and labels("unlicense.org.evil.com") == set()
    assert labels("see http://www.opensource.org/licenses/MIT.") == {"mit"} and labels("(https://unlicense.org/)") == {"unlicense"}
    assert labels("GPLv2") == labels("GPL-2.0") == labels("GNU GPL, version 2 or any later version") == {"gpl-2.0"} and labels("gpl 20") == set()
    assert labels("the LGPL version 2.1") == {"lgpl-2.1"} and labels("Zero-Clause BSD") == {"0bsd"} and labels("CC-BY-SA-4.0 International") == {"cc-by-sa-4.0"}


def test_license_suppression_is_linear():
    import time

    found = [(3 * i, 3 * i + 2 + (i % 7) * 3, i % 5) for i in range(100_000)] + [(0, 200_000, 1)]
    began = time.time()
    kept = license_scan.suppressed(found, [0, 1, 2, 3, 3])
    assert time.time() - began < 1 and (0, 200_000, 1) in kept and len(kept) > 20_000


def test_license_expressions():
    scanner = license_scan.Scanner()
    found = lambda t: [(scanner.rules[i].label, scanner.rules[i].kind, t[a:b]) for a, b, i in scanner.scan(t.encode())]
    spdx = lambda t: [(label, x) for label, kind, x in found(t) if kind == "spdx"]
    assert found("// SPDX-License-Identifier: MIT OR Apache-2.0\n") == [("mit", "spdx", "MIT"), ("apache-2.0", "spdx", "Apache-2.0")]
    assert spdx("SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR GPL-2.0+") == [("mit", "MIT"), ("bsd-3-clause", "BSD-3-Clause"), ("gpl-2.0", "GPL-2.0+")]
    assert spdx("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0") == [("gpl-2.0", "GPL-2.0-only")]
    assert spdx("SPDX-License-Identifier:MIT/Apache-2.0, ISC.") == [("mit", "MIT"), ("apache-2.0", "Apache-2.0"), ("isc", "ISC")]
    assert spdx("SPDX-License-Identifier: " + "LicenseRef-some-long-name OR " * 20 + "Zlib\nMIT") == [("zlib", "Zlib")]
    assert spdx("SPDX-License-Identifier: Apache-2.0 ist mit dem ruby") == [("apache-2.0", "Apache-2.0")]
    assert spdx("SPDX-License-Identifier: MIT OR\nISC") == [("mit", "MIT")] and spdx("SPDX: MIT OR ISC") == []


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    from prismcube.llm.queries import QUERIES

    got = QUERIES["op5_quality"](spark, sf).join(read(spark, sf, "labels"), "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    test = [r for r in got if r.held_out]
    for y in (0, 1):
        part = [r for r in test if r.quality == y]
        assert sum(r.predicted == y for r in part) >= 0.9 * len(part)
    docs = odd_docs(spark)
    none = quality.train_on(docs.limit(0), read(spark, sf, "labels"))
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}


def test_quality_equals_a_dense_model(spark):
    # 200 rows: counts, ratios, scaled indicators and the hinge loss against dense matrices and another solver
    import numpy as np

    rng, vocabulary = random.Random(12), [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary[:40] if i % 2 else vocabulary[20:], k=rng.randrange(1, 15))), i % 2 if i % 11 else 1 - i % 2) for i in range(198)] + [(198, "", 1), (199, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    dims = 512
    model, features = quality.train(df, dims), quality.Features(dims)
    x, y = np.zeros((200, dims)), np.array([1.0 if r[2] else -1.0 for r in rows])
    for i, t, _ in rows:
        x[i, features.ids((t or "").encode())] = 1
    p, q = x[y > 0].sum(0) + 1, x[y < 0].sum(0) + 1
    r = np.log((p / p.sum()) / (q / q.sum()))
    assert np.allclose(model.ratio2, r * r, rtol=1e-5)
    z = x * r
    z = np.column_stack([z / np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-300), np.ones(200)])
    top = np.where(y > 0, 200 / (2 * (y > 0).sum()), 200 / (2 * (y < 0).sum()))
    k = (z * y[:, None]) @ (z * y[:, None]).T
    a, step = np.zeros(200), 1 / np.linalg.eigvalsh(k)[-1]
    for _ in range(20_000):  # projected gradient on the dual
        a = np.clip(a + step * (1 - k @ a), 0, top)
    loss = lambda w: w @ w / 2 + (top * np.maximum(1 - y * (z @ w), 0)).sum()
    best = (a * y) @ z
    w, bias = quality.dual_coordinate_descent([features.ids((t or "").encode()) for _, t, _ in rows], y, r, epochs=400)
    assert abs(loss(np.append(w, bias)) - loss(best)) < 1e-3 * loss(best)
    got = {s.doc_id: s.score for s in quality.quality_scores(df, model).collect()}
    margin = z @ np.append(model.weights / np.where(r == 0, 1, r), model.bias)
    assert all(abs(got[i] - 1 / (1 + np.exp(-(model.slope * margin[i] + model.offset)))) < 1e-4 for i in range(200))
    assert sum((got[i] >= 0.5) != (y[i] > 0) for i in range(198)) < 20


def test_quality_cross_validation(spark):
    # the choice of indicators, on training rows alone
    sf = "/root/testdata/sf0.01"
    known = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id").filter(~quality.held_out()).orderBy("doc_id").collect()
    texts, labels = [(r.text or "").encode() for r in known], [r.quality for r in known]
    errors = {f: quality.cross_validate(texts, labels, f) for f in (("words",), quality.FAMILIES[:4], quality.FAMILIES)}
    assert errors[quality.FAMILIES] <= errors[quality.FAMILIES[:4]] <= errors["words",]


def test_quality_repeated_rows(spark):
    # a labelled row that is given again and again is one row of the fit
    rows = [(1, "good text here", 1)] * 3000 + [(i, f"bad words {i}", 0) for i in range(2, 40)] + [(i, f"good words {i}", 1) for i in range(40, 80)]
    model = quality.train(spark.createDataFrame(rows, "doc_id long, text string, label int"), 1 << 12, fit_rows=200)
    got = quality.quality_scores(spark.createDataFrame([(1, "bad words 99"), (2, "good words 99")], "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.score >= 0.5 for r in got} == {1: False, 2: True}


def test_token_files_equal_the_library(spark, sf):
    import numpy as np
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = odd_docs(spark).select("doc_id", "text").unionByName(read(spark, sf, "documents").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    got = sorted(map(tuple, token_files.tokenise(docs, P.path("byte_bpe_50k.json")).collect()), key=lambda r: r[1])
    at, want = 0, []
    for i, t in sorted(map(tuple, docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert token_files.tokenise(docs.limit(0), P.path("byte_bpe_50k.json")).collect() == []
    assert [len(x) // 2 for x in token_files.Encoder(P.path("byte_bpe_50k.json")).encode(["a <|endoftext|> b", "a b", "<|endoftext|>"])] == [4, 2, 1]
    other = token_files.Encoder(P.path("word_bpe_49k.json"))
    assert not other.chunked and len(other.encode(["Hello there"])[0]) == 4


def test_pieces_equal_the_library(monkeypatch):
    import numpy as np
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    monkeypatch.setattr(token_files, "KEPT_PIECES", 2000)  # generations change
    monkeypatch.setattr(token_files, "LONGEST_PIECE", 12)
    encoder, rng = token_files.Encoder(P.path("byte_bpe_50k.json")), random.Random(4)
    latin = [chr(i) for i in range(256)]
    pools = [latin, latin + list("\u4e2d\u6587\u2019\u2026\u2028\u3000\u200b\u01c5\u02b0\u03a9\u0663\u2167\U0001d4b3"), list("ab  '\nstre.,1\u00e9\u00a0\u0085\x1c"), ["the ", " foo", "'ll", "don't", "\n", " ", ".", " \u00e9t\u00e9", "\u00df", "1", " 12", "\u00b2", "\u4e2d"]]
    for _ in range(30):
        some = ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for pool in pools for _ in range(60)]
        assert encoder.encode(some) == [np.array(e.ids, encoder.kind).tobytes() for e in tok.encode_batch(some, add_special_tokens=False)]


@pytest.mark.parametrize("block_words", [2_000_000, 300])
def test_decontaminate(spark, sf, block_words):
    bench = read(spark, sf, "benchmark").unionByName(spark.createDataFrame([(900, "short item"), (901, "mit"), (902, "--"), (903, None), (904, "short item")], "item_id long, text string"))
    docs = odd_docs(spark).select("doc_id", "text").unionByName(read(spark, sf, "documents").select("doc_id", "text")).unionByName(spark.createDataFrame([(7777, "a Short, ITEM b short item short")], "doc_id long, text string"))
    got = decontaminate.contamination(docs, bench, block_words=block_words).collect()
    items = [(r.item_id, WORD.findall(lower(r.text))) for r in bench.collect()]
    windows = {}
    for i, w in items:
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    want = []
    for r in docs.collect():
        w, hit, named = WORD.findall(lower(r.text)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    named |= found
        want.append((r.doc_id, len(w), len(hit), sorted(named)))
    assert any(x[2] for x in want)
    assert sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.item_ids) for r in got), key=str) == sorted(want, key=str)
    assert decontaminate.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_decontaminate_large_benchmark():
    # a million words, the most of a block: tables stay small and find what a set of windows finds
    import resource

    rng, vocabulary = random.Random(6), [f"w{i:x}".encode() for i in range(120_000)]
    pieces = [(i, b" ".join(rng.choices(vocabulary, k=200)), 10) for i in range(5_000)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    packed = decontaminate.pack(pieces)  # one block
    assert len(packed) < 100e6 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000
    matcher, windows = decontaminate.Matcher(packed), {}
    for i, text, _ in pieces[:300]:
        w = text.split()
        for k in range(len(w) - 9):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    for _ in range(200):
        _, text, _ = rng.choice(pieces[:300])
        w, at = text.split(), rng.randrange(150)
        words = rng.choices(vocabulary, k=30) + w[at : at + rng.choice([9, 10, 25])] + rng.choices(vocabulary, k=30)
        want = [(k, k + 10) for k in range(len(words) - 9) if tuple(words[k : k + 10]) in windows]
        assert matcher.scan(words) == (decontaminate.merge(want), set().union(*(windows[tuple(words[a:b])] for a, b in want)))


def test_decontaminate_rows(spark):
    # long items in pieces, repeated and null items, null and repeated rows, clashing names, an empty table
    rng = random.Random(2)
    item = " ".join(f"v{rng.randrange(50)}" for _ in range(400))
    bench = spark.createDataFrame([(None, item), (None, item), (5, "one two"), (5, "one two"), (6, "zwei")], "item_id long, text string")
    rows = [(None, f"x {item} y"), (None, None), (1, "A one TWO b"), (1, "A one TWO b"), (2, "zwei zwei"), (3, "one  three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit(1)).withColumn("key", F.lit("k")).withColumn("spans", F.lit(2))
    decontaminate.PIECE, piece = 40, decontaminate.PIECE
    try:
        for block_words in (10_000, 100):
            got = decontaminate.contamination(docs, bench, block_words=block_words, carry=True).collect()
            assert sorted((str(r.doc_id), r.n_words, [tuple(s) for s in r.spans], r.item_ids) for r in got) == sorted(
                [("None", 402, [(1, 401)], [None]), ("None", 0, [], []), ("1", 4, [(1, 3)], [5]), ("1", 4, [(1, 3)], [5]), ("2", 2, [(0, 2)], [6]), ("3", 2, [], [])]
            )
            assert all(r._row.text == dict(zip(range(6), [t for _, t in rows], strict=True))[rows.index((r.doc_id, r._row.text))] and r._row.key == "k" for r in got)
            assert decontaminate.decontaminate(docs.limit(0), bench).collect() == []
    finally:
        decontaminate.PIECE = piece


def test_mix(spark, sf):
    docs = odd_docs(spark).unionByName(read(spark, sf, "documents"), allowMissingColumns=True)
    items = mixing.sizes(docs)
    got = mixing.mix(items).collect()
    assert sorted(map(str, mixing.mix(items.repartition(7)).collect())) == sorted(map(str, got))
    by = {}
    for r in docs.collect():
        by.setdefault(r.source, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    sizes, weight = {s: sum(by[s]) for s in order}, {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        target = {s: 3.0 * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            break
        full |= set(over)
    source = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        source[r.source] = source.get(r.source, 0) + r.taken
    assert all(abs(source[s] - target[s]) <= 1 for s in order)
    assert mixing.mix(items.limit(0)).collect() == []
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns and whole.count() > 0


def test_chat(spark):
    rows = [(1, 1, "assistant", "b<|end|>\\<\\[ [INST]"), (1, 0, "user", "a\n<|text|>"), (1, 2, "assistant", None), (2, None, None, ""), (None, 0, "user", "x"), (None, 0, "user", "x"), (3, 0, "sys<|text|>tem", "é\\")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.read_chat(chat.format_chat(df)).collect()}
    assert [(t.role, t.text, t.loss) for t in got[1].read] == [("user", "a\n<|text|>", False), ("assistant", "b<|end|>\\<\\[ [INST]", True), ("assistant", "", True)]
    assert [(t.role, t.text) for t in got[3].read] == [("sys<|text|>tem", "é\\")] and len(got[None].read) == 2 and [(t.role, t.text) for t in got[2].read] == [("", "")]
    for r in got.values():
        for t, x in zip(r.turns, r.read, strict=True):
            assert re.sub(r"([<\[\\])\\", r"\1", r.formatted[t.start : t.start + t.length]) == x.text
        assert "[INST]" not in r.formatted
    assert chat.format_chat(df.limit(0)).collect() == []


def test_chat_parts(spark):
    parts = "array<struct<kind: string, text: string, ref: string, amount: bigint>>"
    df = spark.sql(f"""SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, CAST(array(named_struct('kind','text','text','see','ref',null,'amount',null), named_struct('kind','image','text',null,'ref','a.png','amount',400)) AS {parts}) AS parts
        UNION ALL SELECT 1L, 1L, 'assistant', CAST(array(named_struct('kind','audio','text',null,'ref','b.wav','amount',81), named_struct('kind','document','text',null,'ref','c.pdf','amount',2)) AS {parts})""")
    (r,) = chat.format_chat(df).collect()
    assert r.formatted == "<|turn|>user<|text|>see<|image:0|><|end|><|turn|>assistant<|text|><|audio:1|><|document:2|><|end|>"
    assert [tuple(a) for a in r.attachments] == [(0, "image", "a.png", 3, 0), (1, "audio", "b.wav", 3, 1), (2, "document", "c.pdf", 2048, 1)] and r.expanded_tokens == 2054


def test_chat_odd_parts(spark):
    parts = "array<struct<kind: string, text: string, ref: string, amount: bigint>>"
    part = lambda kind, text: f"named_struct('kind', {kind}, 'text', {text}, 'ref', 'r', 'amount', null)"
    df = spark.sql(f"SELECT 1L AS conv_id, 0L AS turn, 'assistant' AS role, CAST(array({part('null', repr('a<b'))}, {part(repr('vi[deo'), 'null')}, {part(repr('text'), 'null')}, null) AS {parts}) AS parts")
    (r,) = chat.read_chat(chat.format_chat(df)).collect()
    assert r.formatted == "<|turn|>assistant<|text|>a<\\b<|vi[\\deo:0|><|end|>" and r.read[0].learned == "a<b<|vi[deo:0|>"
    (f,) = chat.format_chat(df).collect()
    assert [tuple(a) for a in f.attachments] == [(0, "vi[deo", "r", 0, 0)] and f.expanded_tokens == 0
    short = spark.sql("SELECT 1 AS conv_id, 0 AS turn, 'user' AS role, array(named_struct('kind', 'image', 'amount', 400)) AS parts")
    assert [tuple(a) for a in chat.format_chat(short).first().attachments] == [(0, "image", None, 3, 0)]
    for other in ("'x'", "array(1)", "array(named_struct('a', 1))", "null"):
        (r,) = chat.format_chat(spark.sql(f"SELECT 1 AS conv_id, 0 AS turn, 'user' AS role, 'hi' AS text, {other} AS parts")).collect()
        assert r.formatted == "<|turn|>user<|text|>hi<|end|>"
    assert chat.read_chat(chat.format_chat(df.limit(0))).collect() == []


def test_chat_is_native(spark, sf, capsys):
    from prismcube.llm.queries import QUERIES

    df = QUERIES["op10_chat"](spark, sf)
    df.explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)
    r = {x.conv_id: x for x in df.collect()}[-1]
    said = "</s>[INST] ok [/INST]"
    assert r.n_turns == 2 and r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest() and r.loss_chars == len(said)


def test_license_grants_behind_any_separators():
    scanner = license_scan.Scanner()
    for between in (" ", " " * 200, " " * 20_000, "\n# " + "*" * 170 + "\n"):
        ((a, b, rule),) = scanner.scan(f"x released under the{between}BSD 3-Clause License".encode())
        assert (a, scanner.rules[rule].kind) == (2, "grant") and b == 40 + len(between)
    (one,) = scanner.scan(b"in accordance with the terms of the GNU General Public License, version 2")[:1]
    assert scanner.rules[one[2]].kind == "grant"
