"""A training-data pipeline over ``documents``: five stages, each an operator of ``loomlog.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of ``documents``; a stage's result is written as Parquet in the shared folder and read again by the next one.
The method's own decisions (seeded selection, dynamic programming) can't be told in SQL, so ORACLE_SQL is None and the
tests compare with brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.llm.common import discard, documents, durable, pick, prepare, tidy
from loomlog.llm.exact_dedup import exact_duplicates
from loomlog.llm.language_id import from_documents, identify
from loomlog.llm.membership import Members, key, may_hold, without
from loomlog.llm.mixing import mix, render, with_sizes
from loomlog.llm.ngram_join import jaccard_components
from loomlog.llm.packing import pack_sequences
from loomlog.llm.queries import tokenizer
from loomlog.session import ensure_checkpoint_dir

COLUMNS = {"doc_id": "doc_id long", "text": "text string", "lang": "lang string", "source": "source string", "n_chars": "n_chars long"}


def keyed(docs: DataFrame) -> DataFrame:
    return pick(docs, **COLUMNS).withColumn("mark", F.xxhash64("text"))


def selected(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of docs (doc_id, mark, ...) that are to stay. verdicts: doc_id, mark, keep, one, a row for each row of docs.

    Texts stay where they are: rows are told by filters of bounded size (see membership). Rows with one identifier and
    one text share a verdict; of those that are kept and marked ``one`` a single one stays, and only these rows meet.
    """
    by_key = verdicts.withColumn("k", key("doc_id", "mark")).groupBy("k.a", "k.b").agg(F.max("keep").alias("keep"), (F.max("one") & (F.count("*") > 1)).alias("several"))
    by_key = durable(by_key)
    rest = without(docs, by_key.select("a", "b", (~F.col("keep") | F.col("several")).alias("drop")), "doc_id", "mark")
    once = by_key.where("keep and several").select("a", "b")
    if not (n := once.count()):
        return rest
    some = may_hold(docs, Members(once, n), "doc_id", "mark").dropDuplicates(["doc_id", "mark"]).withColumn("k", key("doc_id", "mark"))
    some = some.join(once, (F.col("k.a") == F.col("a")) & (F.col("k.b") == F.col("b")), "left_semi").drop("k")
    return rest.unionByName(some)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no letters, no likely language, low posterior) go.

    Rows are judged one by one; rows with one identifier and one text go together if one of them goes. Null and empty
    texts go; a very long text is judged by all of it; ties go as the operator breaks them; other columns than those of
    documents are left out; an empty table stays empty.
    """
    docs = keyed(docs)
    found = identify(from_documents(docs)).withColumn("k", key("doc", "mark")).select("k.a", "k.b", (~F.col("kept")).alias("drop"))
    return without(docs, durable(found), "doc_id", "mark").drop("mark")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal after lower-casing A-Z, the one with the largest doc_id stays, as in op10.

    Null text equals empty text; of rows with one identifier and equal texts one stays; a null identifier stays only
    where no equal row has another one; very long texts are compared whole; other columns than those of documents are
    left out; an empty table stays empty.
    """
    docs = keyed(docs)
    found = exact_duplicates(docs, keep="largest").select(F.col("doc").alias("doc_id"), "mark", F.col("kept").alias("keep"), F.lit(True).alias("one"))
    return selected(docs, found).drop("mark")


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays.

    Where several texts of a group have that identifier, or none has one, the text with the least hash stays, and of
    equal rows one. Texts without words, null ones too, are linked with nothing and stay. Very long texts are compared
    whole; other columns than those of documents are left out; an empty table stays empty.
    """
    docs = keyed(docs)
    found = durable(jaccard_components(docs).select(F.col("doc").alias("doc_id"), "mark", "n_shingles", "component", "root"))
    first = found.where("n_shingles > 0 and doc_id <=> component")
    verdicts = found.select("doc_id", "mark", F.expr("doc_id <=> component").alias("keep"), (F.col("n_shingles") > 0).alias("one"), "root")
    several = durable(first.groupBy("root").agg(F.min("mark").alias("least"), F.max("mark").alias("most")).where("least != most").select("root", "least"))
    if not several.isEmpty():
        verdicts = verdicts.join(several, "root", "left").withColumn("keep", F.col("keep") & (F.col("least").isNull() | (F.col("mark") == F.col("least")))).drop("least")
    return selected(docs, verdicts.drop("root")).drop("mark")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; of a part that it takes the row has only those words.

    Null and wordless texts are never taken; a null source is one of its own; rows are taken one by one, repeated ones
    too; null identifiers are dealt by their texts; of a very long text a run of words may be taken; other columns than
    those of documents are left out; an empty table stays empty.
    """
    prepare(spark)
    rows = pick(docs, doc="doc_id long", source="source string", text="text string", lang="lang string")
    mixed = mix(with_sizes(rows, ["text", "lang"]), sums_of=durable(with_sizes(rows, [])))
    out = mixed.where("taken > 0").mapInArrow(tidy(render), "doc long, source string, lang string, text string")
    return out.select(F.col("doc").alias("doc_id"), "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return pack_sequences(docs, tokenizer("word_bpe_49k.json"), length=4096, end_id=2, memory=100_000).withColumnRenamed("doc", "doc_id")


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("ngram_join", ngram_join), ("mixing", mixing), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are a table in the shared folder, deleted when the next one
    is written. The last table stays, as the result is computed from it."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = documents(spark, sf_dir), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{folder}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                discard(spark, before)
            before = path
    return docs
