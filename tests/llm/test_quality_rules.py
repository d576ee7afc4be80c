import random
import re

from loomlog.llm.quality_rules import RULES, Estimate, Rule, cascade, estimate, quality_rules, sample_of

SCHEMA = "doc_id long, text string, n_words int, w string, hashes string, doc string, kept int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines, dup = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    n, chars, symbols = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text))
    failed = n < 20 or 100 * len(covered) > 30 * n
    rejected = 2 * symbols > n or 2 * dup > lines and dup >= 3 or chars > 25 * n or chars < 2 * n or 2 * len(re.findall("[A-Z]", text)) > chars or 2 * len(re.findall("[0-9]", text)) > chars
    return n, chars, symbols, dup, len(covered), failed, not failed and not rejected


def texts():
    rnd = random.Random(4)
    pool = ["word", "é", "#", "$$", "UPPER", "12", "longer-word", "a"]
    out = []
    for _ in range(400):
        some = pool if rnd.random() < 0.5 else [f"w{i}" for i in range(rnd.choice([30, 3000]))]
        out.append("".join(rnd.choice(some) + rnd.choice([" ", " ", " ", "\n", "\t", "  "]) for _ in range(rnd.randint(0, 120))))
    line = "one two three four five six seven eight nine ten\n"
    return [*out, None, "", " \n ", "a b c d e f g h", line * 4, line * 2 + " ".join(f"x{i}" for i in range(60)), "a " * 30_000, "x" * 100_000]


def test_against_brute_force(spark):
    rows = [(i if i % 60 else None, t, 1, "w", "h", "d", 1) for i, t in enumerate(texts())]
    rows += rows[:4]
    got = quality_rules(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    names = ["doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert quality_rules(spark.createDataFrame([], SCHEMA)).collect() == []


def test_order_is_rejection_per_cost(spark):
    a, b = Estimate(Rule("a", "true"), 0.1, 0.5), Estimate(Rule("b", "true"), 0.1, 0.1)
    assert a.worth > b.worth
    rows = [(i, t, 1, "w", "h", "d", 1) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id as doc", "text")
    found = estimate(sample_of(docs), RULES)
    assert {e.rule for e in found} == set(RULES) and [e.worth for e in found] == sorted((e.worth for e in found), reverse=True)
    assert [e.rule for e in estimate(sample_of(docs.repartition(3)), RULES)] == [e.rule for e in found]  # the same in every run
    mean = docs.selectExpr("avg(octet_length(coalesce(text, '')))").first()[0]
    cost = {e.rule.name: e.cost for e in found}
    assert cost["symbols"] == 16 and cost["digits"] == cost["capitals"] and abs(cost["digits"] - 8 - mean) < 1e-6 * mean
    share = {e.rule.name: e.rejected for e in found}
    rules = {r.name: sum(r_ is True for r_ in [x[0] for x in sample_of(docs).selectExpr(r.rejects).collect()]) for r in RULES}
    assert all(abs(share[k] - n / len(rows)) < 0.02 for k, n in rules.items())
    got = docs.selectExpr("doc", "doc as n").select(cascade([Rule("x", "n > 5"), Rule("y", "n > 3")]).alias("r"), "n").collect()
    assert all(r["r"] == ("x" if r["n"] > 5 else "y" if r["n"] > 3 else None) for r in got)
