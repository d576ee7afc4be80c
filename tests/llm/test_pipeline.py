import glob
import os
import random

import corpus_pipeline as pipeline

from .test_language_id import prose
from .test_ngram_join import brute
from .test_tokens import check_pieces

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(21)
    out = []
    for i in range(240):
        lang = rnd.choice(["en", "fr", "de"])
        text = prose(lang, rnd.randint(30, 300), rnd)
        if out and rnd.random() < 0.3:
            old = rnd.choice(out)
            lang, text = old[2], rnd.choice([old[1], old[1].upper() if old[1].isascii() else old[1], f"{old[1]} extra", old[1]])
        out.append((i, text, lang, rnd.choice(["a", "a", "b", "c", None]), len(text)))
    return [*out, (500, None, "en", "a", 0), (501, "12 34", "en", "a", 5), (502, "", None, None, 0), (3, out[3][1], "en", "a", 1), (None, prose("en", 99, rnd), "en", "b", 1)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_stages(spark):
    from tokenizers import Tokenizer

    from loomlog.llm.mixing import targets

    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = pipeline.language_id(spark, docs, "")
    assert kept.columns == docs.columns and rows_of(kept) == sorted((r for r in rows if r[0] not in (500, 501, 502)), key=str)

    once = pipeline.exact_dedup(spark, kept, "")
    assert once.columns == docs.columns
    first = {}
    for r in kept.collect():
        t = lower(r["text"])
        first[t] = max(first.get(t, (-2,)), (-1 if r["doc_id"] is None else r["doc_id"],))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], lower(r["text"])) for r in once.collect()) == sorted((v[0], t) for t, v in first.items())

    near = pipeline.ngram_join(spark, once, "")
    left = [(r["doc_id"], r["text"]) for r in once.collect()]
    want = {d for d, _, c in brute(left) if d == c}
    assert near.columns == docs.columns and sorted((r["doc_id"] for r in near.collect()), key=str) == sorted(want, key=str)

    mixed = pipeline.mixing(spark, near, "").cache()
    count = lambda t: len((t or "").split())
    sizes, taken, own, per = {}, {}, {}, {}
    for r in near.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + count(r["text"])
        own[r["doc_id"]] = count(r["text"])
    for r in mixed.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + count(r["text"])
        per[r["doc_id"]] = per.get(r["doc_id"], 0) + count(r["text"])
        assert r["n_chars"] == len(r["text"])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    for s, goal in zip(order, targets([sizes[s] for s in order], [(5.0, 2.0, 1.0)[i % 3] for i in range(len(order))], 3)):
        assert abs(taken.get(s, 0) - goal) <= 0.02 * goal + 32
    assert mixed.columns == docs.columns and all(n <= 3 * own[d] for d, n in per.items())

    texts = [(i, r["text"]) for i, r in enumerate(mixed.collect())]
    packed = pipeline.packing(spark, spark.createDataFrame(texts, "doc_id long, text string"), "").withColumnRenamed("doc_id", "doc").collect()
    check_pieces([r.asDict() for r in packed], texts, Tokenizer.from_file(pipeline.tokenizer("word_bpe_49k.json")), 4096)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []


def test_run(spark, tmp_path):
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    shared = pipeline.ensure_checkpoint_dir(spark).removeprefix("file:")
    tables = lambda: {os.path.relpath(p, shared) for g in ("table-*", "pipeline-*/*") for p in glob.glob(f"{shared}/{g}")}
    before = tables()
    out = pipeline.run(spark, str(tmp_path))
    assert out.count() > 100 and "sequence_id" in out.columns
    # Left of the tables on the way: the one that the result is computed from, and the lists of the n-gram join.
    assert sorted(p.split("/")[-1].split("-")[0] for p in tables() - before) == ["3", "table"]
