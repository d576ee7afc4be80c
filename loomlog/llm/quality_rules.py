"""Quality rules as a short-circuit cascade of native expressions.

Each rule's cost (bytes that it reads of a row) and selectivity are estimated on a sample; the cascade evaluates rules
by rejection per cost, and a row that one rule rejects is never shown to the next. The verdict is the same in any order,
and the order is the same in every run. The base columns are results of every row, so no rule can spare them; what the
cascade spares are further passes over the text. Only built-in functions run on the executors; nothing but the sample is shuffled or gathered.

Repeated windows need no shuffle either: a text's windows are hashed, and only where one occurs twice are they sorted
(n log n) to mark the words they cover.

Defined results: null text has no words and fails; empty tables give no rows; every row is judged by itself, so ties
and repeated rows change nothing; rules of equal worth go by cost, then by name; a very long text is judged whole;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import durable, pick, prepare

#: Patterns of the words and of the symbols that are counted.
WORD, BREAK, SYMBOL = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"
#: Rows that the estimates are made on.
SAMPLE_ROWS = 1000
#: Bytes of a number.
NUMBER = 8
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over the row's columns; it is true for a text to drop."""

    name: str
    rejects: str


#: Rules on top of the base ones; ratios are generous, so that only texts that are mostly junk go.
RULES = (
    Rule("symbols", "2 * n_symbols > n_words"),
    Rule("repeated lines", "2 * n_dup_lines > n_lines and n_dup_lines >= 3"),
    Rule("word length", "word_chars > 25 * n_words or word_chars < 2 * n_words"),
    Rule("capitals", r"2 * (size(split(text, '[A-Z]', -1)) - 1) > word_chars"),
    Rule("digits", r"2 * (size(split(text, '[0-9]', -1)) - 1) > word_chars"),
)


def _repeat_words() -> Column:
    """Words in windows that occur twice or more; ``hashes`` holds one hash for each word."""
    return F.expr(f"""
        case when n_words <= {WINDOW} then 0L else
          transform(array(transform(sequence(0, n_words - {WINDOW}), i -> xxhash64(slice(hashes, cast(i as int) + 1, {WINDOW})))), h ->
            case when size(array_distinct(h)) = size(h) then 0L else
              transform(array(sort_array(transform(h, (x, i) -> struct(x as h, i as i)))), s ->
                aggregate(
                  sort_array(transform(
                    filter(s, (e, k) -> (k > 0 and get(s, k - 1).h = e.h) or (k < size(s) - 1 and get(s, k + 1).h = e.h)),
                    e -> e.i)),
                  named_struct('n', 0L, 'last', -{WINDOW}),
                  (a, p) -> named_struct('n', a.n + least({WINDOW}, p - a.last), 'last', p),
                  a -> a.n))[0]
            end)[0]
        end""")


def base_columns(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed to doc, text."""
    text = docs.withColumn("text", F.coalesce("text", F.lit("")))
    parts = text.select("*", F.expr(rf"filter(split(text, r'{BREAK}', -1), x -> x != '')").alias("w"), F.expr(rf"filter(split(text, '\n', -1), x -> x rlike r'{WORD}')").alias("lines"))
    counted = parts.select(
        "doc",
        "text",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", SYMBOL, -1)) - 1).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("hashes"),
    )
    done = counted.withColumn("n_repeat_words", _repeat_words().cast("long")).drop("hashes")
    return done.withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / self.cost


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A hashed sample of about ``rows`` rows, at most four times as many, for the estimates alone."""
    each = max(1, docs.count() // rows)
    chosen = F.pmod(F.xxhash64(F.lit(11), "doc", "text"), F.lit(each)) == 0
    return durable(base_columns(docs.where(chosen).limit(4 * rows)))


def estimate(sample: DataFrame, rules: tuple[Rule, ...]) -> list[Estimate]:
    """Cost and share of rejected rows of each rule over the sample, best worth first.

    A rule's cost are the bytes that it reads of a row: NUMBER for each number, the whole text for each use of it. That
    is what a row costs in generated code, where timings of a sample this small are mostly a job's latency and would
    give another order from run to run. One job answers for all rules.
    """
    columns = [c for c in sample.columns if c != "text"]
    mentions = lambda r, name: len(re.findall(rf"\b{name}\b", r.rejects))
    found = sample.agg(F.avg(F.octet_length("text")).alias("bytes"), *[F.avg(F.expr(r.rejects).cast("int")).alias(f"r{i}") for i, r in enumerate(rules)]).first()
    cost = lambda r: max(NUMBER, NUMBER * sum(mentions(r, c) for c in columns) + (found["bytes"] or 0.0) * mentions(r, "text"))
    out = [Estimate(r, float(cost(r)), found[f"r{i}"] or 0.0) for i, r in enumerate(rules)]
    return sorted(out, key=lambda e: (-e.worth, e.cost, e.rule.name))


def cascade(order: list[Rule]) -> Column:
    """The first rule that rejects the row, null if none does; CASE stops at the first hit."""
    out = None
    for r in order:
        hit = F.coalesce(F.expr(r.rejects), F.lit(False))
        out = F.when(hit, F.lit(r.name)) if out is None else out.when(hit, F.lit(r.name))
    return F.lit(None).cast("string") if out is None else out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: doc, the base columns, base_failed, rejected_by and kept."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc=f"{id_col} long", text=f"{text_col} string")
    order = [e.rule for e in estimate(sample_of(rows), rules)]
    verdict = base_columns(rows).withColumn("rejected_by", F.when(~F.col("base_failed"), cascade(order)))
    return verdict.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()).drop("text")
