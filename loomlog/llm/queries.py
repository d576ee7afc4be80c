"""The registered queries of the training-data operators, and SQL for those that SQL can express.

Every query applies its operator to the whole of its table. DuckDB reads the same tables as views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.llm.common import documents

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.packing import pack_sequences

    return pack_sequences(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), length=4096, end_id=2).withColumnRenamed("doc", "doc_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.token_counts import token_counts

    return token_counts(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), limit=512).withColumnRenamed("doc", "doc_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.language_id import from_documents, identify

    return identify(from_documents(documents(spark, sf_dir))).drop("mark").withColumnRenamed("doc", "doc_id")


def op3_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over web pages, with the markup's language, address suffixes and hosts."""
    from loomlog.llm.language_id import from_pages, identify

    return identify(from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))).drop("mark").withColumnRenamed("doc", "page_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.mixing import mix_documents

    return mix_documents(documents(spark, sf_dir)).select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.ngram_join import jaccard_components

    out = jaccard_components(documents(spark, sf_dir))
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


OP5_SQL = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
n as (select doc_id, list_sort(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) end) as sh from d),
c as (select row_number() over () as c, sh, len(sh) as n, min(doc_id) as least from n where len(sh) > 0 group by sh),
p as (select c, n, unnest(sh) as g from c),
l as (select a.c as a, b.c as b from p a join p b on a.g = b.g and a.c < b.c and 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
      group by a.c, b.c, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e as (select a, b from l union all select b, a from l),
r as (select c as a, c as b from c union select r.a, e.b from r join e on r.b = e.a),
k as (select r.a as c, min(c.least) as component from r join c on r.b = c.c group by r.a)
select n.doc_id, cast(len(n.sh) as bigint) as n_shingles, coalesce(k.component, n.doc_id) as component_id
from n left join c on n.sh = c.sh left join k on c.c = k.c
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.quality_rules import quality_rules

    out = quality_rules(documents(spark, sf_dir)).withColumnRenamed("doc", "doc_id")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP6_SQL = r"""
with t as (select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
p as (select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from t),
b as (select r, doc_id, text, w, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) as n_lines,
             len(lines) - len(list_distinct(lines)) as n_dup_lines,
             len(regexp_extract_all(text, '[A-Z]')) as n_upper, len(regexp_extract_all(text, '[0-9]')) as n_digits from p),
s as (select r, i, w[i:i+7] as win from (select r, w, unnest(generate_series(1, n_words - 7)) as i from b where n_words > 8)),
d as (select r, i from (select r, i, count(*) over (partition by r, win) as c from s) where c > 1),
c as (select r, count(distinct i + k) as n from d, (select unnest(generate_series(0, 7)) as k) group by r),
f as (select b.*, coalesce(c.n, 0) as n_repeat_words from b left join c using (r)),
g as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (2 * n_symbols > n_words or (2 * n_dup_lines > n_lines and n_dup_lines >= 3)
         or word_chars > 25 * n_words or word_chars < 2 * n_words or 2 * n_upper > word_chars or 2 * n_digits > word_chars) as kept
from g
"""


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.lm_scoring import score_documents

    return score_documents(documents(spark, sf_dir)).withColumnRenamed("doc", "doc_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.pii import find_pii

    return find_pii(documents(spark, sf_dir)).withColumnRenamed("doc", "doc_id")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.sharding import balanced_shards

    out = balanced_shards(documents(spark, sf_dir), shards=16)
    return out.select(F.col("doc").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomlog.llm.exact_dedup import exact_duplicates

    out = exact_duplicates(documents(spark, sf_dir), keep="largest")
    return out.select(F.col("doc").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("group_size"), F.col("kept"), F.col("sha").alias("text_sha256"))


OP10_SQL = f"""
with n as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n
"""

QUERIES = {
    "op1_packing": op1_packing,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op3_language_id_pages": op3_language_id_pages,
    "op4_mixing": op4_mixing,
    "op5_ngram_join": op5_ngram_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_pii": op8_pii,
    "op9_sharding": op9_sharding,
    "op10_exact_dedup": op10_exact_dedup,
}
ORACLES = {"op5_ngram_join": OP5_SQL, "op6_quality_rules": OP6_SQL, "op10_exact_dedup": OP10_SQL}
