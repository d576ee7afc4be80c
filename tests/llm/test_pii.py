import hashlib
import random
import re

import numpy as np

from loomlog.llm import pii

SCHEMA = "doc_id long, text string, base int, spans string, n int, doc string"
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            own = m.group()
            digits = re.sub("[^0-9]", "", own)
            ok = k == 0 or k == 1 and all(int(x) <= 255 for x in own.split(".")) or k == 2 and 14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0 or k == 3 and 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def soup(rnd, n):
    pool = ["a", "B", ".", "@", "-", " ", "+", "1", "23", "255", "256", "0", "(", ")", "é", "a@b.co", "1.2.3.4", "4111 1111 1111 1111", "4111111111111111", "+1 (743) 555-3824", "007", ".com", "%", "\n", "5500-0000-0000-0004"]
    return "".join(rnd.choice(pool) for _ in range(n))


def test_base_spans_equal_the_patterns():
    rnd = random.Random(5)
    for _ in range(6000):
        text = soup(rnd, rnd.randint(0, 25))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for run in ("1" * 300_000, "a" * 300_000 + "@", "a@" * 100_000, "1." * 100_000, "+1" + " " * 300_000, "1 " * 100_000):
        pii.base_spans(run)
        pii.loose_spans(run, [])


def test_query(spark):
    rnd = random.Random(6)
    rows = [(i if i % 50 else None, soup(rnd, 30)) for i in range(300)]
    rows += [(1000 + i, f"Please call me: (743) 555-{rnd.randint(1000, 9999)} today, or email bob [at] mail [dot] com. My phone +1 (743) 555-3824, mail x.{i}@mail.example.com") for i in range(60)]
    rows += [(2000 + i, f"clean text number {i} of 2024, 3.14 and 12-34") for i in range(60)]
    rows += [(3000, None), (3001, ""), (3002, "x" * 200_000), rows[0], rows[0]]
    df = spark.createDataFrame([(i, t, 1, "s", 1, "d") for i, t in rows], SCHEMA).repartition(4)
    got = pii.find_pii(df).collect()
    want = {}
    for i, t in rows:
        b = brute(t)
        want.setdefault(i, []).append((*(sum(s[1] == k for s in b) for k in range(4)), hashlib.sha256(pii.joined(b).encode()).hexdigest()))
    have = {}
    for r in got:
        have.setdefault(r["doc"], []).append(tuple(r[c] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256")))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    text = dict(rows)
    for r in got:
        spans = [tuple(s.split(":")) for s in r["spans"].split(",")] if r["spans"] else []
        order = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in spans]
        assert order == sorted(order) and (r["doc"] is None or set(brute(text[r["doc"]])) <= set(order))
        if r["doc"] is not None and 1000 <= r["doc"] < 2000:
            assert len(order) == 4
        if r["doc"] is not None and 2000 <= r["doc"] < 3000:
            assert order == [] and r["n_spans"] == 0
    assert pii.find_pii(spark.createDataFrame([], SCHEMA)).collect() == []


def card(rnd, start, n):
    digits = start + "".join(rnd.choice("0123456789") for _ in range(n - len(start) - 1))
    return next(digits + c for c in "0123456789" if pii.luhn(digits + c))


def planted(rnd):
    """(kind, sentence, span text): personal data that the strict patterns miss."""
    d = lambda n, first="0123456789": rnd.choice(first) + "".join(rnd.choice("0123456789") for _ in range(n - 1))
    name, host = rnd.choice(["anna", "j.ruiz", "bob_k", "lee42"]), rnd.choice(["mail.example.com", "corp.example.org", "uni.example.fr"])
    us = (d(3, "23456789"), d(3, "23456789"), d(4))
    four = card(rnd, rnd.choice(["4", "51", "55"]), 16)
    groups = [four[i : i + 4] for i in (0, 4, 8, 12)]
    kind, says, own = rnd.choice(
        [
            (0, "you can write to {} any day", f"{name} [at] {host.replace('.', ' [dot] ')}"),
            (0, "contact {} for more", f"{name}(at){host.replace('.', '(dot)')}"),
            (1, "connect to the server {} now", ":".join("%x" % rnd.randrange(1, 65536) for _ in range(8))),
            (1, "her login came from address {} again", "2001:db8::" + "%x:%x" % (rnd.randrange(1, 65536), rnd.randrange(1, 65536))),
            (1, "the host {} is bad", "[.]".join(str(rnd.randrange(1, 224)) for _ in range(4))),
            (2, "paid with card {} yesterday", ".".join(groups)),
            (2, "my visa {} expires soon", "/".join(groups)),
            (2, "credit card 4417 or {} were used", four),
            (3, "call me at {} tonight", f"({us[0]}) {us[1]}-{us[2]}"),
            (3, "phone {} after six", "-".join(us)),
            (3, "her mobile is {} now", "0049 " + d(3, "123456789") + " " + d(7)),
            (3, "ring {} or come by", "0" + d(1, "12345") + " " + " ".join(d(2) for _ in range(4))),
            (4, 'config: api_key = "{}"', "".join(rnd.choice("abcdef0123456789") for _ in range(40))),
            (4, "the token: {} must stay secret", "ghp_" + "".join(rnd.choice("abcdefghijkLMNOPQ0123456789") for _ in range(36))),
        ]
    )
    return kind, says, own


def harmless(rnd):
    d = lambda n: "".join(rnd.choice("123456789") for _ in range(n))
    return rnd.choice(
        [
            f"on 20{d(2)}-0{rnd.randint(1, 9)}-1{rnd.randint(0, 9)} it rained", f"version 1.{d(1)}.{d(2)} of the tool", f"it cost $ {d(1)},{d(3)}.{d(2)} in all", f"see figure {d(1)}.{d(1)}",
            f"ISBN 978-{d(1)}-{d(4)}-{d(3)}-{d(1)}", f"order {d(8)} was sent", f"pi is 3.{d(12)} or so", f"from 19{d(2)} - 20{d(2)}", f"at 1{rnd.randint(0, 9)}:{rnd.randint(10, 59)}:{rnd.randint(10, 59)} sharp",
            f"{d(3)} 000 000 people", f"a very-long-word-with-many-parts-{d(1)}", f"https://example.com/a/{d(6)}/some-title-of-a-page-{d(2)}", f"{d(1)}{d(2)} km and {d(2)} mm", f"ratio 1:{d(2)} and 2::3",
        ]
    )


def test_recall_and_precision_on_planted_spans(spark):
    rnd = random.Random(31)
    words = "the river runs along a quiet town where people walk and talk of work and weather".split()
    rows, want = [], {}
    for i in range(1500):
        text, spans = "", set()
        for _ in range(rnd.randint(1, 4)):
            text += " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 12))) + ". "
            if rnd.random() < 0.4:
                text += harmless(rnd) + ". "
            if rnd.random() < 0.4:
                kind, says, own = planted(rnd)
                at = len(text) + says.index("{}")
                spans.add((at, kind, at + len(own)))
                text += says.format(own) + ". "
            if rnd.random() < 0.2:
                text += f"mail x{i}@example.org or +1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}. "
        rows.append((i, text))
        want[i] = spans
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kinds = {k: i for i, k in enumerate(pii.ALL_KINDS)}
    found = {r["doc"]: {(int(a), kinds[k], int(b)) for x in (r["spans"], r["secrets"]) if x for k, a, b in [p.split(":") for p in x.split(",")]} - set(pii.base_spans(rows[r["doc"]][1])) for r in got}
    base = {i: set(pii.base_spans(t)) for i, t in rows}
    planted_spans = {(i, *s) for i, spans in want.items() for s in spans if s not in base[i]}
    added = {(i, *s) for i, spans in found.items() for s in spans}
    hit = planted_spans & added
    assert len(planted_spans) > 800
    assert len(hit) >= 0.9 * len(planted_spans), (len(hit), len(planted_spans))
    assert len(hit) >= 0.95 * len(added), (len(hit), len(added))
    for k in range(len(pii.ALL_KINDS)):
        own = {s for s in planted_spans if s[2] == k}
        assert len(own & hit) >= 0.8 * len(own) > 0, pii.ALL_KINDS[k]
    assert all(r["n_added"] + len([x for x in (r["secrets"] or "").split(",") if x]) == len(found[r["doc"]]) for r in got)


def test_em_finds_the_reliable_labelers():
    rnd = np.random.default_rng(2)
    truth = rnd.random(4000) < 0.4
    right = np.array([0.95, 0.85, 0.6])
    say = np.where(rnd.random((4000, 3)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    table, counts = np.unique(say, axis=0, return_counts=True)
    posterior, reliability = pii.expectation_maximisation(table, counts.astype(float))
    assert np.allclose(reliability[:, 1, 2], right, atol=0.06)
    which = {tuple(t): p for t, p in zip(table, posterior)}
    guess = np.array([which[tuple(s)] > 0.5 for s in say])
    assert (guess == truth).mean() > 0.94
