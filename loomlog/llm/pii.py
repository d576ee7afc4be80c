"""Personal data by weak supervision: labelers vote, EM weighs them, and a span classifier learns from the result.

A map-only scan finds in each whole text the base spans (strict patterns with their checks) and candidates beside them:

* e-mail with written-out signs, or with letters outside ASCII before what the strict pattern finds;
* addresses of version 6 and defused ones;
* cards and phones inside digit runs that the strict patterns drop whole, such as a number next to another, with
  other separators, or without the international sign;
* secrets: long words of letters and digits, such as keys and tokens. They are a kind of their own beside the base ones.

Labelers of three families vote yes, no or nothing on every span:

* patterns: the strict form and its checks (octets, Luhn, digits, an assignment);
* gazetteers: domain endings, numbering plans, card issuers, address blocks, beginnings of keys;
* context: words and signs on both sides of the span, and its shape.

Votes and discrete features are counted over all rows; the pattern space is fixed, so the driver gets a bounded table.
Expectation-maximisation over these counts estimates each labeler's reliability for each kind and the posterior of
each pattern. A logistic classifier over the features is trained on the posteriors, and the candidates that it accepts
are added. Base spans always stay. Whether a span is a base span is no feature: it would explain everything.

The patterns are matched in linear time: runs of digits or address characters are entered at their first character
only, which gives the same leftmost matches.

Defined results: null text is empty and has no spans; offsets are code points, ends exclusive; spans go by start, then
by kind; of candidates of one kind that overlap the first, then the longest, stands; repeated rows and null identifiers
are handled one by one; a very long text is read whole; further columns are ignored, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import ipaddress
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import durable, per_row, pick, prepare, tidy, utf8

#: The base kinds, and those that only the method finds.
KINDS, MORE_KINDS = ("email", "ip", "card", "phone"), ("secret",)
ALL_KINDS = KINDS + MORE_KINDS
#: Posterior from which a loose candidate is taken, and rounds of EM and of the classifier.
TAKE, EM_ROUNDS, FIT_ROUNDS = 0.9, 50, 200
#: Characters of context on each side.
CONTEXT = 40

# The base patterns (see linear-time note above for the guards), and the loose ones.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOOSE_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\[at\]|\(at\)|\{at\}| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\{dot\}| dot ) ?[A-Za-z0-9-]{2,63}){1,4}", re.IGNORECASE)
_DEFUSED = re.compile(r"(?<![0-9.\]])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
_COLONS = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:]{3,39}(?![0-9A-Za-z:])")
_DIGITS = re.compile(r"[0-9]+(?:[ ./()\u00a0\u2011\u2013-]{1,2}[0-9]+)*+")
_GROUP = re.compile(r"[0-9]+")
_LONG_WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,200}(?![A-Za-z0-9+/_-])")

# Gazetteers. Country codes of two digits (1 and 7 have one, all others three), card issuers with the
# lengths of their numbers, beginnings of keys.
_ENDINGS = frozenset("com org net edu gov mil int info biz io dev app me tv co uk de fr es it nl eu us ca ch at be pl se no dk fi pt ie cz gr hu ro ua tr au nz jp cn kr tw hk sg in br mx ar cl za il ru".split())
_TWO = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_ISSUERS = ((re.compile(r"4"), (13, 16, 19)), (re.compile(r"5[1-5]|2[2-7]"), (16,)), (re.compile(r"3[47]"), (15,)), (re.compile(r"6011|65|64[4-9]"), (16, 19)), (re.compile(r"35"), (16,)), (re.compile(r"3[068]"), (14, 16)))
_KEYS = re.compile(r"AKIA|ASIA|gh[pousr]_|sk[-_]|pk_|xox[abprs]-|AIza|eyJ|glpat-|ya29")
_SAYS = {
    "email": re.compile(r"e-?mail|mail|contact|write|kontakt|correo|courriel|@", re.I),
    "ip": re.compile(r"\bip(?:v[46])?\b|address|host|server|login|adresse|ping|connect", re.I),
    "card": re.compile(r"card|visa|master|credit|payment|karte|carte|tarjeta|amex|paid", re.I),
    "phone": re.compile(r"phone|call|\btel\b|mobile|\bcell\b|\bfax\b|telefon|t[ée]l[ée]phone|tel[ée]fono|\bring\b|dial|whatsapp|\bext\b", re.I),
    "secret": re.compile(r"token|secret|passw|pwd|api.?key|\bkey\b|\bauth|bearer|credential|contrase|passwort|mot de passe", re.I),
}
_DENIES = re.compile(r"(?:\bv(?:ersion)?\.? ?|\bfig(?:ure)?\.? ?|\bsection ?|\bisbn[: -]*|\bissn[: -]*|\bdoi[: -]*|\bpages? ?|\border ?|\bno\.? ?|\bsha\S* ?|\bmd5\S* ?|\bcommit ?|[$€£#] ?|[*/^] ?|[0-9][.,])$", re.I)
_UNIT = re.compile(r" ?(?:%|km|kg|mm|cm|ms|mb|gb|usd|eur|dollars|euros|years|pages|times|hours|minutes)\b", re.I)
_DATE = re.compile(r"(?:19|20)[0-9]{2}[-./](?:0?[1-9]|1[0-2])[-./][0-3]?[0-9](?:[ ][0-2]?[0-9])?|[0-3]?[0-9][-./][0-3]?[0-9][-./](?:19|20)?[0-9]{2}|(?:19|20)[0-9]{2}[- –](?:19|20)[0-9]{2}")
_ASSIGNED = re.compile(r"[=:]\s{0,2}[\"'`]?$")

#: Labelers in the order of their votes, and the number of binary features of the classifier.
LABELERS = ("pattern", "gazetteer", "context", "shape")
FEATURES = 10
#: Feature bits that are votes for and against a span, and how many more must be for it.
YES, NO, MARGIN = (3, 5, 7, 9), (4, 6, 8), 2


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain.domain, by way of the @ signs."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if octets(m.group())]
    out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out)


def issued(digits: str) -> bool:
    return any(len(digits) in lengths and p.match(digits) for p, lengths in _ISSUERS)


def planned(digits: str, international: bool) -> bool:
    """Whether numbering plans allow the digits: with a country code, or as they are dialled inside a country."""
    if international:
        code = 1 if digits[0] in "17" else 2 if digits[:2] in _TWO else 3
        rest = digits[code:]
        return digits[0] != "0" and (len(rest) == 10 and rest[0] in "23456789" and rest[3] in "23456789" if digits[0] == "1" else 7 <= len(rest) <= 12)
    if len(digits) == 10 and digits[0] != "0":
        return digits[0] in "23456789" and digits[3] in "23456789"
    if len(digits) == 11 and digits[0] == "1":
        return planned(digits[1:], False)
    return digits[0] == "0" and digits[1:2] != "0" and 9 <= len(digits) <= 12


def _windows(text: str, groups: list[tuple[int, int]], low: int, high: int) -> Iterator[tuple[int, int, str]]:
    """Runs of whole groups with low to high digits, by start, longest first."""
    for i in range(len(groups)):
        n, found = 0, []
        for j in range(i, len(groups)):
            n += groups[j][1] - groups[j][0]
            if n > high:
                break
            if n >= low:
                found.append((groups[i][0], groups[j][1]))
        for a, b in reversed(found):
            yield a, b, _digits(text[a:b])


def _numbers(text: str) -> Iterator[tuple[int, int, int]]:
    """Cards and phones inside digit runs."""
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() < 9:
            continue
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        done, cards = 0, []
        for a, b, digits in _windows(text, groups, 13, 19):
            if a >= done and luhn(digits) and issued(digits):
                cards.append((a, b))
                done = b
        yield from ((a, 2, b) for a, b in cards)
        done = 0
        for a, b, digits in _windows(text, groups, 9, 15):
            if a < done or any(a < d and c < b for c, d in cards):
                continue
            first = a == m.start()
            plus = first and text[a - 1 : a] == "+"
            zeros = digits.startswith("00")
            if plus or zeros:
                ok = planned(digits[2:] if zeros else digits, True)
            else:
                ok = any(not c.isdigit() for c in text[a:b]) and planned(digits, False)
            if ok:
                start = a - 1 if plus or (first and text[a - 1 : a] == "(" and ")" in text[a:b]) else a
                yield start, 3, b
                done = b


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates beside the base spans: none overlaps a base span, but for an address that has it as its end."""
    found = list(_numbers(text))
    if "[.]" in text or "(.)" in text:
        found += [(m.start(), 1, m.end()) for m in _DEFUSED.finditer(text) if octets(re.sub(r"[^0-9]+", ".", m.group()))]
    for m in _COLONS.finditer(text) if "::" in text or text.count(":") >= 7 else ():
        try:
            found += [(m.start(), 1, m.end())] if ipaddress.IPv6Address(m.group()) and sum(c != ":" for c in m.group()) >= 3 else []
        except ValueError:
            pass
    if "dot" in text.lower():
        found += [(m.start(), 0, m.end()) for m in _LOOSE_EMAIL.finditer(text)]
    for m in _LONG_WORD.finditer(text):
        own = m.group()
        if any(c.isdigit() for c in own) and any(c.isalpha() for c in own) and len(set(own)) >= 8:
            found.append((m.start(), 4, m.end()))
    out: list[tuple[int, int, int]] = []
    spans = sorted(base)
    for f in sorted(found, key=lambda x: (x[0], -x[2])):
        k = bisect.bisect_left(spans, (f[0], -1, -1))
        near = [*spans[max(0, k - len(KINDS)) : k], *itertools.takewhile(lambda s: s[0] < f[2], spans[k:])]
        if not any(f[0] < b and a < f[2] for a, _, b in near) and not any(o[1] == f[1] and f[0] < o[2] for o in out[-4:]):
            out.append(f)
    for a, k, b in base:
        if k == 0 and a and text[a - 1].isalpha():
            start = a
            while start and a - start < 64 and (text[start - 1].isalnum() or text[start - 1] in _LOCAL):
                start -= 1
            out.append((start, 0, b))
    return sorted(out)


def votes(text: str, span: tuple[int, int, int], strict: bool) -> tuple[int, ...]:
    """One vote of each labeler: 1 yes, -1 no, 0 nothing."""
    start, kind, end = span
    own, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _digits(own)
    if kind == 0:
        tail = re.split(r"[^A-Za-z0-9-]+", own.rstrip())[-1].lower()
        known, shape = (1 if tail in _ENDINGS else 0 if tail.isalpha() and 2 <= len(tail) <= 24 else -1), (1 if len(own) < 64 else -1)
        checked = 1 if strict or "@" in own else 0
    elif kind == 1:
        first = int(_GROUP.match(own).group()[:9]) if "." in own else 1
        known, shape, checked = (1 if 1 <= first <= 223 else -1), (-1 if re.match(r"\.?[0-9]", after) else 1), 1
    elif kind == 2:
        known = 1 if issued(digits) else -1
        even = len({len(g) for g in _GROUP.findall(own)}) == 1
        shape, checked = (-1 if len(set(digits)) <= 3 else 1 if even or digits[0] == "3" else 0), (1 if luhn(digits) and 13 <= len(digits) <= 19 else -1)
    elif kind == 3:
        international = own.startswith(("+", "00"))
        known = 1 if planned(digits[2:] if digits.startswith("00") else digits, international) else -1
        shape = -1 if _DATE.fullmatch(own) or own.count(".") == 1 and not re.search(r"[ ()/-]", own) else 1 if len(_GROUP.findall(own)) > 1 else 0
        sizes = [len(g) for g in _GROUP.findall(own)]
        checked = 1 if strict or international or "(" in own or len(sizes) > 2 and max(sizes) <= 4 else 0
    else:
        most = max(own.count(c) for c in set(own)) / len(own)
        known = 1 if _KEYS.match(own) else 0
        shape = -1 if most > 0.3 or own.count("/") > 2 or own.count("-") > 4 else 1 if re.fullmatch(r"[0-9a-fA-F]{32,128}", own) or any(c.isdigit() for c in own[len(own) // 2 :]) and any(c.isdigit() for c in own[: len(own) // 2]) else 0
        checked = 1 if _ASSIGNED.search(before) else -1 if re.search(r"https?:\S*$", before) else 0
    says = _SAYS[ALL_KINDS[kind]]
    context = -1 if _DENIES.search(before) or _UNIT.match(after) else 1 if says.search(before) or says.search(after) else 0
    return checked, known, context, shape


def features(text: str, span: tuple[int, int, int], strict: bool, v: tuple[int, ...]) -> int:
    """Discrete features of a span as bits; the first only tells base spans from others and isn't learnt from."""
    start, kind, end = span
    left, right = text[start - 1 : start] if start else "", text[end : end + 1]
    bits = (strict, not left or left.isspace() or left in "\"'(", not right or right.isspace() or right in ".,;:!?)\"'", v[1] > 0, v[1] < 0, v[2] > 0, v[2] < 0, v[3] > 0, v[3] < 0, v[0] > 0)
    return sum(1 << i for i, b in enumerate(bits) if b)


def _code(v: tuple[int, ...]) -> int:
    return sum((x + 1) * 3**i for i, x in enumerate(v))


_SPAN = "struct<start:int,kind:int,end:int,code:int,feature:int>"
_SCAN = f"doc long, base string, n array<long>, spans array<{_SPAN}>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    struct = pa.struct([(n, pa.int32()) for n in ("start", "kind", "end", "code", "feature")])
    for batch in batches:
        raw, at = utf8(batch.column(1))
        mark = ((raw >= 48) & (raw <= 57)) | (raw == 64)
        # "dot" alone can be part of a written-out address, "::" of one of version 6; other texts without digits and @
        # have nothing to find.
        low = raw | 32
        mark[:-2] |= (low[:-2] == 100) & (low[1:-1] == 111) & (low[2:] == 116) if len(raw) > 2 else False
        mark[:-1] |= (raw[:-1] == 58) & (raw[1:] == 58) if len(raw) > 1 else False
        some = per_row(mark, at) > 0
        data, at = raw.tobytes(), at.tolist()
        base, counts, spans = [], [], []
        for i in range(batch.num_rows):
            strict: list[tuple[int, int, int]] = []
            own = []
            if some[i]:
                text = data[at[i] : at[i + 1]].decode("utf-8")
                strict = base_spans(text)
                for s, sure in [*((s, True) for s in strict), *((s, False) for s in loose_spans(text, strict))]:
                    v = votes(text, s, sure)
                    own.append((*s, _code(v), features(text, s, sure, v)))
            base.append(hashlib.sha256(joined(strict).encode()).hexdigest())
            counts.append([sum(s[1] == k for s in strict) for k in range(len(KINDS))])
            spans.append([dict(zip(("start", "kind", "end", "code", "feature"), s)) for s in own])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base), pa.array(counts, type=pa.list_(pa.int64())), pa.array(spans, type=pa.list_(struct))], names=["doc", "base", "n", "spans"])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def expectation_maximisation(table: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """table: patterns x labelers of votes (-1, 0, 1); counts: rows of each -> posteriors, reliabilities.

    reliabilities[labeler, truth, vote + 1] = P(vote | truth, it votes); of abstaining it holds how often that happens,
    which is no evidence. Starts from the majority of the votes.
    """
    posterior = 1 / (1 + np.exp(-1.5 * table.sum(axis=1)))
    shown = (table[:, :, None] == np.array([-1, 0, 1])).astype(float)  # pattern, labeler, vote
    cast = shown * np.array([1.0, 0.0, 1.0])
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        # A labeler is believed beforehand to be better than chance.
        seen = np.einsum("tp,plv->ltv", weight, cast) + np.array([[2.0, 0.0, 0.5], [0.5, 0.0, 2.0]])
        reliability = seen / seen.sum(axis=2, keepdims=True)
        log = np.log(prior) + np.einsum("plv,ltv->pt", cast, np.log(np.maximum(reliability, 1e-300)))
        posterior = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))
    reliability[:, :, 1] = np.einsum("p,pl->l", counts / max(counts.sum(), 1.0), shown[:, :, 1])[:, None]
    return posterior, reliability


def train(codes: np.ndarray, soft: np.ndarray, weight: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Weights of a logistic classifier over kind and feature bits, fitted to soft labels by Newton's steps."""
    x = design(codes)
    w = np.zeros(x.shape[1])
    scale = weight / max(weight.sum(), 1.0) * min(weight.sum(), 1e6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (scale * (soft - p)) - 0.1 * w
        hessian = (x * (scale * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def design(codes: np.ndarray) -> np.ndarray:
    """codes: kind * 2^FEATURES + feature bits -> an intercept for each kind, and the bits but the first."""
    kind, bits = codes >> FEATURES, codes & ((1 << FEATURES) - 1)
    return np.column_stack([*(kind == k for k in range(len(ALL_KINDS))), *((bits >> i) & 1 for i in range(1, FEATURES))]).astype(float)


def accepted(patterns: list[tuple[int, int, int, int]], take: float = TAKE) -> tuple[set[int], dict[str, np.ndarray]]:
    """(kind, votes, features, rows) -> codes that the trained classifier takes, and reliabilities by kind."""
    found: dict[str, np.ndarray] = {}
    codes, soft, weight = [], [], []
    for k, name in enumerate(ALL_KINDS):
        own = sorted(p for p in patterns if p[0] == k)
        if own:
            table = np.array([[(p[1] // 3**i) % 3 - 1 for i in range(len(LABELERS))] for p in own])
            counts = np.array([p[3] for p in own], float)
            posterior, found[name] = expectation_maximisation(table, counts)
            codes += [k << FEATURES | p[2] for p in own]
            soft += posterior.tolist()
            weight += counts.tolist()
    if not codes:
        return set(), found
    codes = np.array(codes)
    w = train(codes, np.array(soft), np.array(weight))
    p = 1 / (1 + np.exp(-design(codes) @ w))
    # Most patterns are base spans, so the classifier alone would take what no labeler speaks of.
    bits = lambda c, which: sum(int(c) >> i & 1 for i in which)
    return {int(c) for c, x in zip(codes, p) if x >= take and bits(c, YES) - bits(c, NO) >= MARGIN}, found


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", take: float = TAKE) -> DataFrame:
    """One row per input row: doc, n_email, n_ip, n_card, n_phone and base_sha256 of the base spans; spans: base and
    accepted ones of the base kinds; n_added of them; secrets, likewise joined, and n_spans of all kinds."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc=f"{id_col} long", text=f"{text_col} string")
    found = durable(rows.mapInArrow(tidy(_scan), _SCAN))
    each = found.select(F.explode("spans").alias("s"))
    patterns = each.groupBy("s.kind", "s.code", "s.feature").count().collect()
    codes, _ = accepted([(r["kind"], r["code"], r["feature"], r["count"]) for r in patterns], take)
    # Bit 0 of the features tells a base span.
    is_base = lambda s: s["feature"].bitwiseAND(1) == 1
    chosen = F.filter("spans", lambda s: is_base(s) | (s["kind"] * (1 << FEATURES) + s["feature"]).isin(sorted(codes) or [-1]))
    found = found.withColumn("chosen", F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), is_base(s).alias("base")))))
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    text = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    own, more = F.filter("chosen", lambda s: s["kind"] < len(KINDS)), F.filter("chosen", lambda s: s["kind"] >= len(KINDS))
    return found.select(
        "doc",
        *[F.get("n", F.lit(k)).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.col("base").alias("base_sha256"),
        text(own).alias("spans"),
        F.size(F.filter(own, lambda s: ~s["base"])).cast("long").alias("n_added"),
        text(more).alias("secrets"),
        F.size("chosen").cast("long").alias("n_spans"),
    )
