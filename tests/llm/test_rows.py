"""Every operator and every stage on null, empty, long and repeated rows, on empty tables and on columns of any name."""

import random

import pytest

pytest.importorskip("prismcube.llm")
P = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from prismcube.llm import chat, decontaminate, embedding_dup, html_text, lexical, license_scan, mixing, near_dup, quality, secret_scan, spelling, token_counts, token_files  # noqa: E402
from prismcube.llm.common import Scratch, read  # noqa: E402

CLASHING = "score _id _times _copy _text parts text_key _row key spans tie size before part wanted_id scored_text label hash n_tokens links component bucket host page h0".split()


def clashing(df):
    """df with columns that operators could name alike."""
    for i, name in enumerate(c for c in CLASHING if c not in df.columns):
        df = df.withColumn(name, F.lit("x" if i % 2 else i))
    return df


def documents(spark):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(400)}" for _ in range(80))
    rows = [(i, f"{text} end {i}", "en", "s0", 1) for i in range(5)] + [(10 + i, " ".join(f"v{rng.randrange(300)}" for _ in range(60)), None, f"s{i % 3}", None) for i in range(12)]
    rows += [(None, "no id at all here", None, None, None)] * 3 + [(None, None, None, None, None), (30, None, "en", "s1", 0), (31, "", "de", "s1", 0), (32, " \n\t", "de", None, 0)]
    rows += [(7, "given twice", "en", "s2", 1)] * 2 + [(8, "one id", "en", "s2", 1), (8, "two texts", "en", "s1", 1)]
    rows += [(40, "long " + "x" * 70_000 + " word" * 30_000, "en", "s0", 9)]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def run(spark, name, df, sf):
    bench = read(spark, sf, "benchmark")
    labels, scratch = read(spark, sf, "labels"), Scratch(spark)
    one = {
        "op1": lambda: token_counts.token_counts(df, P.path("piece_bpe_32k.model")),
        "op2": lambda: license_scan.license_scan(df),
        "op3": lambda: near_dup.near_duplicates(df, near_dup.OP3),
        "op4": lambda: html_text.extract(df.withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "html").withColumn("url", F.col("source"))),
        "op5": lambda: quality.quality_scores(df, quality.train_on(df.unionByName(read(spark, sf, "documents"), allowMissingColumns=True), labels)),
        "op6": lambda: token_files.tokenise(df, P.path("byte_bpe_50k.json")),
        "op7": lambda: decontaminate.decontaminate(df, bench),
        "op8": lambda: embedding_dup.embedding_duplicates(vectors(df)),
        "op9": lambda: mixing.mix(mixing.sizes(df)),
        "op11": lambda: lexical.search(lexical.build_index(df, scratch), df.select(F.col("doc_id").alias("item_id"), "text", *(c for c in df.columns if c not in ("doc_id", "text"))), scratch),
        "op12": lambda: spelling.spelling_variants(df),
        "op13": lambda: secret_scan.secret_scan(df),
        "op10": lambda: chat.read_chat(chat.format_chat(df.withColumnRenamed("doc_id", "conv_id").withColumn("turn", F.lit(1)).withColumn("role", F.col("lang")))),
    }
    return one[name]()


def vectors(df):
    base = df.drop("label").withColumnRenamed("doc_id", "vec_id").withColumn("label", F.lit(1))
    return base.withColumn("embedding", F.when(F.col("text").isNotNull(), F.array(F.length("text").cast("double"), F.lit(1.0))))


@pytest.mark.parametrize("name", [f"op{i}" for i in range(1, 14)])
def test_operator_rows(spark, sf, name):
    docs = documents(spark)
    rows = docs.count()
    got = run(spark, name, docs, sf).collect()
    if name == "op10":
        assert len(got) == docs.select("doc_id").distinct().count() and sum(len(r.read) for r in got) == rows
    elif name == "op11":
        from test_search_words_secrets import plain_search

        pairs = [(r.doc_id, r.text) for r in docs.collect()]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_search(pairs, pairs)))
    elif name == "op12":
        from test_search_words_secrets import plain_variants, plain_words

        assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain_variants(plain_words([(r.doc_id, r.text) for r in docs.collect()]))
    else:
        assert len(got) == rows
    # further columns, whatever their names, change nothing
    plain = run(spark, name, docs.select("doc_id", "text", "lang", "source", "n_chars"), sf).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain))
    assert run(spark, name, docs.limit(0), sf).collect() == []


def test_turns_of_many_parts(spark):
    # time in proportion to the parts: 40,000 in a turn
    part = "struct<kind: string, text: string, ref: string, amount: long>"
    parts = [("text", f"t{i} <|@|> ", None, None) if i % 2 else ("image", None, f"r{i}", 196) for i in range(40_000)]
    rows = spark.createDataFrame([(1, 0, "user", None, parts), (1, 1, "assistant", "ok", None)], f"conv_id long, turn long, role string, text string, parts array<{part}>")
    (r,) = chat.format_chat(rows).collect()
    assert len(r.attachments) == 20_000 and [a.number for a in r.attachments] == list(range(20_000)) and r.expanded_tokens == 20_000
    (back,) = chat.read_chat(chat.format_chat(rows)).collect()
    want = "".join(f"t{i} <|@|> " if i % 2 else f"<|image:{i // 2}|>" for i in range(40_000))
    assert back.read[0].text.replace("<\\", "<") == want.replace("<\\", "<") and back.read[1].learned == "ok"


def test_pages_of_any_depth_and_length(spark):
    story = "<p>One of the paragraphs here.</p>"
    rows = [(1, "http://a.b/1", "<div>" * 100_000 + story + "</div>" * 100_000), (2, "http://a.b/2", f"<article>{story * 30_000}</article>"), (3, "http://a.b/3", "<b>" * 50_000 + "x</i>" * 50_000), (4, None, None)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "One of the paragraphs here." and got[2].count("One of") == 30_000 and got[3] == "x" * 50_000 and got[4] in ("", None)


@pytest.mark.parametrize("name", ["quality", "near_dup", "decontaminate", "mix", "tokens"])
def test_stage_rows(spark, sf, name):
    pipeline = pytest.importorskip("corpus_pipeline")
    stage, docs = dict(pipeline.STAGES)[name], documents(spark)
    out = stage(spark, docs, sf)
    if name == "tokens":
        assert out.count() == docs.count()
    else:
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        got, given = out.collect(), {str(r) for r in docs.collect()}
        assert got and {str(r) for r in got} <= given
    if name == "near_dup":
        assert sum(r.doc_id is None for r in got) == 4 and sum(r.doc_id in range(5) for r in got) == 1 and sum(r.doc_id == 7 for r in got) == 1
    if name == "decontaminate":
        assert len(got) == docs.count()  # clean ones stay, those without id or text, too
    if name == "mix":
        assert all(r.text and r.text.split() for r in got) and max(sum(x == r for x in got) for r in got) <= 3 * 3
    assert stage(spark, docs.limit(0), sf).collect() == []


def test_mix_repeats_each_row_by_its_own_place(spark):
    # a third of the rows without id and of one source: each is taken by its own place, and sizes come to the targets
    rows = [(None if i % 3 == 0 else i, f"{i} " + "w " * (i % 7 + 1), f"s{i % 2}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {}
    for r in mixing.mixed_documents(docs).collect():
        taken[r.text] = taken.get(r.text, 0) + 1
    size = {t: len(t.split()) for _, t, _ in rows}
    total = sum(size.values())
    for s, share in (("s0", 1 / 3), ("s1", 2 / 3)):
        got = sum(taken.get(t, 0) * size[t] for _, t, x in rows if x == s)
        assert abs(got - total * share) <= 10
    assert max(taken.values()) <= 3


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from prismcube.llm.common import shared_dir

    none = SimpleNamespace(isDefined=lambda: False)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none))))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake)
