"""Language identification by Bayesian evidence fusion.

    posterior(l) ~ prior(l | host, address suffix) * P(declared | l) * P(text | l)^w

* text: byte trigrams of the whole text under one smoothed model for each language. Which languages exist follows from
  the declarations of all rows; each one's model is fitted on a hashed sample of its own of TRAIN_ROWS to 2 * TRAIN_ROWS
  rows or, if it has fewer, on all of them (the only sample; all else covers every row). Trigrams overlap, so a text
  counts as at most TEXT_STRENGTH independent ones.
* declared: a markup or metadata language; P(declared | l) is a smoothed table over all rows.
* host: counts over all rows by grouped aggregation, smoothed from host to address suffix to the whole table; a row's
  own vote is left out.

A text whose trigrams (with a letter, without a digit) are clearly likelier under a uniform model than under every
language, or that has no letters, is undetermined ("und") and rejected, as is one whose best posterior is under ``least``.

A language lacks a model beyond the MAX_LANGUAGES most declared ones, or if its sample has under LEAST_TRIGRAMS trigrams
(a model that small is hardly worse than none for any text) and it makes under LEAST_SHARE of the declarations. A text
with letters that would be rejected keeps a declared language without a model, and else, if it declares none and looks
like no known language, that of the majority of its host's declarations. The confidence is then the share of all
declarations with a model that the texts confirm, for hosts times the share of the majority.

One map-only scan leaves a narrow table (a few numbers a row), which is checkpointed; hot hosts are salted in both the
aggregation and the join. The model has 65,536 cells for each of at most MAX_LANGUAGES languages (64 MB at most).

Defined results: null or empty text is "und"; null declared or host count as no evidence; ties go to the first
language by code; repeated rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import durable, lowered, per_row, pick, prepare, tidy, utf8

TRAIN_ROWS, MAX_LANGUAGES = 4000, 256
#: Trigrams of a sample that make a model, or else share of the declarations.
LEAST_TRIGRAMS, LEAST_SHARE = 5000, 0.002
#: Cells of the hashed trigram model; bytes scored at a time.
CELLS, SLICE = 1 << 16, 1 << 19
#: Weights: trigrams that a text counts as at most, pseudo-rows of the host's and suffix's parents, and of tables.
TEXT_STRENGTH, HOST_ROWS, SUFFIX_ROWS, PSEUDO = 60.0, 5.0, 20.0, 0.5
UNIFORM = -float(np.log(CELLS))
#: "und" is believed beforehand of one text in a hundred: the log-odds that its evidence must overcome.
UND_MARGIN = float(np.log(99))

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def trigrams(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of all texts: first row, one past the last row, row starts in the slice, cells, and which count."""
    for s in range(0, len(raw), SLICE):
        e = min(s + SLICE, len(raw))
        part = lowered(raw[s : e + 2]).astype(np.uint32)
        part = np.append(part, np.zeros(2, np.uint32)) if e == len(raw) else part
        n = e - s
        code = (part[:n] << 16) | (part[1 : n + 1] << 8) | part[2 : n + 2]
        cells = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int32)
        letter, digit = _LETTER[part.astype(np.uint8)], (part >= 48) & (part <= 57)
        counts = (letter[:n] | letter[1 : n + 1] | letter[2 : n + 2]) & ~(digit[:n] | digit[1 : n + 1] | digit[2 : n + 2])
        first, last = int(np.searchsorted(at, s, "right")) - 1, int(np.searchsorted(at, e, "left"))
        for back in (1, 2):
            edge = at[first + 1 :] - back - s
            counts[edge[(edge >= 0) & (edge < n)]] = False
        yield first, last, np.clip(at[first : last + 1] - s, 0, n), cells, counts


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("declared").to_pylist()
        for l in langs:
            rows[l] = rows.get(l, 0) + 1
        raw, at = utf8(batch.column("text"))
        for first, last, starts, cells, counts in trigrams(raw, at):
            for i, a, b in zip(range(first, last), starts.tolist(), starts.tolist()[1:]):
                if b > a:
                    own = found.setdefault(langs[i], np.zeros(CELLS, np.int64))
                    own += np.bincount(cells[a:b][counts[a:b]], minlength=CELLS)
    yield _vectors(found, rows)


def _vectors(found: dict[str, np.ndarray], rows: dict[str, int]) -> pa.RecordBatch:
    names = sorted(found)
    return pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()), pa.array([rows[n] for n in names], type=pa.int64()), pa.array([found[n].tobytes() for n in names], type=pa.binary())], names=["lang", "n", "cells"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for l, n, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found[l] = found.get(l, 0) + np.frombuffer(v, np.int64)
            rows[l] = rows.get(l, 0) + n
    yield _vectors(found, rows)


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages by code and log P(cell | language), from a sample of each declared language's rows."""
    labelled = rows.where("declared is not null and declared != '' and text is not null")
    said = labelled.groupBy("declared").count().orderBy(F.col("count").desc(), "declared").limit(MAX_LANGUAGES).collect()
    rates = rows.sparkSession.createDataFrame([(r["declared"], max(1, r["count"] // train_rows)) for r in said], "declared string, each long")
    lot = F.pmod(F.xxhash64(F.lit(3), "doc", "host", F.xxhash64("text")), F.col("each"))
    sample = labelled.join(F.broadcast(rates), "declared").where(lot == 0).select("declared", "text")
    schema = "lang string, n long, cells binary"
    sums = sample.mapInArrow(tidy(_train), schema).repartition(8, "lang").mapInArrow(_add, schema)
    got = {r["lang"]: np.frombuffer(r["cells"], np.int64) for r in sums.collect()}
    least = LEAST_SHARE * sum(r["count"] for r in said)
    langs = sorted(r["declared"] for r in said if r["declared"] in got and (got[r["declared"]].sum() >= LEAST_TRIGRAMS or r["count"] >= least))
    table = np.empty((len(langs), CELLS), np.float32)
    for k, l in enumerate(langs):
        table[k] = np.log((got[l] + PSEUDO) / (got[l].sum() + PSEUDO * CELLS))
    return langs, table


def _score(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value
        for batch in batches:
            raw, at = utf8(batch.column("text"))
            n = np.zeros(batch.num_rows)
            sums = np.zeros((len(table), batch.num_rows))
            for first, last, starts, cells, counts in trigrams(raw, at):
                total = lambda x: np.diff(np.append(0.0, np.cumsum(x, dtype=np.float64))[starts])
                n[first:last] += total(counts)
                for k, own in enumerate(table):
                    sums[k, first:last] += total(own[cells] * counts)
            mean = sums / np.maximum(n, 1)
            best = mean.argmax(axis=0) if len(table) else np.zeros(batch.num_rows, int)
            known = (n > 0) & (np.minimum(n, TEXT_STRENGTH) * (UNIFORM - mean.max(axis=0)) < UND_MARGIN) if len(table) else np.zeros(batch.num_rows, bool)
            # Letters without a trigram: no evidence of the text, the others decide.
            blank = (n == 0) & (per_row(_LETTER[raw | 32], at) > 0)
            text = pa.array(np.where(known, best, np.where(n > 0, -1, -2)), type=pa.int32(), mask=blank)
            weighed = (mean * np.minimum(n, TEXT_STRENGTH)).T
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc", "mark", "declared", "suffix", "host")), text, pa.array(list(weighed), type=pa.list_(pa.float64()))], names=["doc", "mark", "declared", "suffix", "host", "text_lang", "ll"])

    return score


def from_documents(docs: DataFrame) -> DataFrame:
    """Evidence of documents: the lang column is the declared language, the source is the host."""
    return pick(docs, doc="doc_id long", text="text string", declared="lang string", host="source string").withColumn("suffix", F.lit(None).cast("string"))


def from_pages(pages: DataFrame) -> DataFrame:
    """Evidence of web pages: visible text, the markup's lang attribute, the host and the last label of its name."""
    rows = pick(pages, doc="page_id long", url="url string", html="html string")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    lang = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    rows = rows.select("doc", text.alias("text"), F.nullif(lang, F.lit("")).alias("declared"), F.nullif(host, F.lit("")).alias("host"))
    return rows.withColumn("suffix", F.regexp_extract("host", r"([^.]+)$", 1))


def identify(evidence: DataFrame, least: float = 0.5) -> DataFrame:
    """evidence: doc, text, declared, suffix, host -> doc, mark, lang, confidence, text_lang, declared, kept."""
    spark = evidence.sparkSession
    prepare(spark)
    langs, table = fit(evidence)
    model = spark.sparkContext.broadcast(table)
    rows = evidence.withColumn("mark", F.xxhash64("text"))
    schema = "doc long, mark long, declared string, suffix string, host string, text_lang int, ll array<double>"
    scored = durable(rows.mapInArrow(tidy(_score(model)), schema))
    size = len(langs)
    names = F.array(*[F.lit(x) for x in langs]).cast("array<string>")
    declares = F.coalesce(F.col("declared") != "", F.lit(False))
    # What is declared: null if nothing, empty if a language with a model, or else the language that lacks one.
    voted = scored.withColumn("tag", F.when(declares & F.col("declared").isin(langs), F.lit("")).when(declares, F.col("declared")))
    lacks = F.coalesce(F.col("tag") != "", F.lit(False))
    if not size:
        # No text has a trigram: declarations are all there is, and nothing confirms or contradicts them.
        told = lacks & (F.coalesce("text_lang", F.lit(-1)) == -1)
        out = voted.select("doc", "mark", F.when(told, F.col("declared")).otherwise("und").alias("lang"), F.when(told, F.lit(0.5)).otherwise(F.lit(0.0)).alias("confidence"), F.lit("und").alias("text_lang"), "declared")
        return out.withColumn("kept", (F.col("lang") != "und") & (F.col("confidence") >= least))

    # Votes of the text alone, by declared language: a small table (languages known to the model, or another).
    voted = voted.withColumn("said", F.when(F.col("tag") == "", (F.array_position(names, F.col("declared")) - 1).cast("int")).when(F.col("declared").isNotNull(), F.lit(size)))
    seen = voted.where("text_lang >= 0").groupBy("text_lang", "said").count().collect()
    whole = np.full(size, PSEUDO)
    says = np.full((size + 1, size), PSEUDO)
    for r in seen:
        whole[r["text_lang"]] += r["count"]
        if r["said"] is not None:
            says[r["said"], r["text_lang"]] += r["count"]
    prior = whole / whole.sum()
    words = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.log(says / says.sum(axis=0)))], "said int, word array<double>")
    trust = float((np.trace(says[:size]) - size * PSEUDO + 1) / (says[:size].sum() - size * size * PSEUDO + 2))

    # Hierarchical priors by grouped aggregation: whole table -> suffix -> host.
    codes = F.sequence(F.lit(0), F.lit(size - 1))
    count_of = lambda votes: F.transform(codes, lambda k: F.aggregate(F.filter(votes, lambda x: x["text_lang"] == k), F.lit(0.0), lambda a, x: a + x["c"]))
    vote = F.collect_list(F.when(F.col("text_lang") >= 0, F.struct("text_lang", "c")))
    placed = voted.withColumn("place", F.struct("suffix", "host")).withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(64)))
    cells = placed.groupBy("place", "salt", "text_lang", "tag").agg(F.count("*").alias("c"))
    cells = durable(cells.groupBy("place", "text_lang", "tag").agg(F.sum("c").alias("c"), F.collect_set("salt").alias("salts")))
    suffixes = cells.groupBy(F.col("place.suffix").alias("of"), "text_lang").agg(F.sum("c").alias("c")).groupBy("of").agg(vote.alias("votes")).select("of", count_of(F.col("votes")).alias("s"))
    tags = cells.where("tag is not null").groupBy("place", "tag").agg(F.sum("c").alias("c")).groupBy("place")
    other = F.when(F.col("tag") != "", F.struct("c", "tag"))
    tags = tags.agg(F.max(other).alias("most"), F.sum("c").alias("all")).where("2 * most.c > all and place.host is not null").select("place", F.col("most.tag").alias("host_tag"), (F.col("most.c") / F.col("all")).alias("host_share"))
    hosts = cells.groupBy("place").agg(vote.alias("votes"), F.array_distinct(F.flatten(F.collect_list("salts"))).alias("salts"))
    hosts = hosts.join(tags, "place", "left").join(suffixes, F.col("place.suffix").eqNullSafe(F.col("of")))
    hosts = hosts.select("place", "host_tag", "host_share", "s", count_of(F.col("votes")).alias("v"), F.explode("salts").alias("salt"))

    joined = placed.join(hosts, ["place", "salt"]).join(F.broadcast(words), "said", "left")
    # Without its own vote; a text that tells nothing has none.
    own = F.transform(codes, lambda k: F.when(k == F.col("text_lang"), F.lit(1.0)).otherwise(F.lit(0.0)))
    less = lambda a: F.zip_with(F.col(a), F.col("own"), lambda x, o: x - o)
    total = lambda a: F.aggregate(F.col(a), F.lit(0.0), lambda t, x: t + x)
    literal = lambda v: F.array(*[F.lit(float(x)) for x in v])
    joined = joined.withColumn("own", own)
    joined = joined.withColumn("up", F.zip_with(less("s"), literal(SUFFIX_ROWS * prior), lambda x, p: x + p)).withColumn("up_all", total("up"))
    joined = joined.withColumn("lo", F.zip_with(less("v"), F.col("up"), lambda x, u: x + HOST_ROWS * u / F.col("up_all"))).withColumn("lo_all", total("lo"))
    # Without a host there is only the table's own prior.
    base = F.when(F.col("host").isNull(), literal(np.log(prior))).otherwise(F.transform("lo", lambda x: F.log(x / F.col("lo_all"))))
    score = F.zip_with(base, F.coalesce("word", literal(np.zeros(size))), lambda x, w: x + w)
    score = F.zip_with(score, F.col("ll"), lambda x, t: x + t)
    scores = joined.select("doc", "mark", "declared", "tag", "host_tag", "host_share", "text_lang", score.alias("score"))
    scores = scores.withColumn("top", F.array_max("score"))
    lang = F.get(names, (F.array_position("score", F.col("top")) - 1).cast("int"))
    best = F.lit(1.0) / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    scores = scores.withColumn("best", best)
    und = F.coalesce(F.col("text_lang") < 0, F.lit(False))
    strange = F.coalesce(F.col("text_lang") == -1, F.lit(False))
    told = lacks & (strange | (~und & (F.col("best") < least)))
    hosted = strange & ~declares & F.col("host_tag").isNotNull()
    out = scores.select(
        "doc",
        "mark",
        F.when(told, F.col("declared")).when(hosted, F.col("host_tag")).when(und, F.lit("und")).otherwise(lang).alias("lang"),
        F.when(told, F.lit(trust)).when(hosted, F.lit(trust) * F.col("host_share")).when(und, F.lit(0.0)).otherwise(F.col("best")).alias("confidence"),
        F.when(und, F.lit("und")).otherwise(F.get(names, F.col("text_lang"))).alias("text_lang"),
        "declared",
    )
    return out.withColumn("kept", (F.col("lang") != "und") & (F.col("confidence") >= least))
