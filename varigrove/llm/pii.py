"""Personal data by weak supervision.

Spans come from patterns. The contract's patterns are final; wider ones propose
further spans, and labelers vote on every span: the strict form of its kind,
checksums, a gazetteer, the words before it and other personal data nearby. A
labeler says yes, no or nothing. Expectation-maximisation estimates how reliable
each is from how often votes occur together, over all documents, and gives each
combination of votes a probability. A logistic classifier is trained on those
and decides on the proposed spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varigrove.llm.common import in_slices, quoted, saved

#: Kinds in the order in which spans at one place are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "name", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Where a number fails it fails from each of its digits, so only its first one is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_WIDER = (
    ("email", re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}+\s?(?:\(at\)|\[at\]|@)\s?[A-Za-z0-9-]{1,63}+(?:\s?(?:\(dot\)|\[dot\]|\.)\s?[A-Za-z0-9-]{2,63}+){1,4}")),
    ("phone", re.compile(r"(?<![\w+(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?!\w)")),
)
_NAME = re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sra?)\.?\x20((?:[A-Z][a-z]{1,30}\x20){0,2}[A-Z][a-z]{1,30})(?!\w)")

#: Gazetteers: fixed values.
_TOP_LEVEL = frozenset("com org net edu gov de fr es uk eu io info".split())
_CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 81 82 86 90 91".split())
_GIVEN = frozenset("anna james john laura maria mary michael paul peter robert sarah thomas".split())
_COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
_BEFORE = {
    "email": re.compile(r"(?i)mail|contact|write to|reach"),
    "ip": re.compile(r"(?i)\bip\b|address|host|server|client|login"),
    "card": re.compile(r"(?i)card|visa|master|payment|credit|karte|tarjeta|carte"),
    "phone": re.compile(r"(?i)phone|\btel\b|call|mobile|\bfax\b|telefon|contact"),
    "iban": re.compile(r"(?i)iban|account|bank|konto|compte|cuenta"),
    "name": re.compile(r"(?i)name|dear|contact|signed|\bby\b"),
    "ssn": re.compile(r"(?i)\bssn\b|social|security"),
}
_AGAINST = re.compile(r"(?i)version|isbn|issn|order|invoice|serial|sku|ticket|\bpage\b|section|chapter")
LABELERS = ("form", "checksum", "gazetteer", "context", "company")
YES, NO, SILENT = 1, 0, 2
#: Lengths of spans, cut here, are a feature of the classifier.
_LENGTHS = (8, 16, 24)
CONTEXT = 40
COMPANY = 60


def digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(number: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in number[-2::-2]]
    return (sum(map(int, number[-1::-2])) + sum(twice)) % 10 == 0


def octet(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) < 3 or len(bare) == 3 and bare <= "255"


def iban_sum(span: str) -> bool:
    bare = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """`[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, read outwards from each @, so in linear time."""
    done = 0
    at = text.find("@")
    while at != -1:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            done = host.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the contract's spans, in order."""
    found: list[tuple[int, str, int]] = []
    if "@" in text:
        found += [(s, "email", e) for s, e in emails(text)]
    if _DIGIT.search(text):
        found += [(m.start(), "ip", m.end()) for m in _IP.finditer(text) if all(map(octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            number = digits(m[0])
            if 14 <= len(number) <= 19 and luhn(number):
                found.append((m.start(), "card", m.end()))
        if "+" in text:
            found += [(m.start(), "phone", m.end()) for m in _PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return in_order(found)


def in_order(spans: Sequence[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def proposed(text: str, base: Sequence[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Spans of the wider patterns that no span of the contract overlaps."""
    found: list[tuple[int, str, int]] = []
    if _DIGIT.search(text) or "@" in text or "(at)" in text or "[at]" in text:
        found = [(m.start(), kind, m.end()) for kind, p in _WIDER for m in p.finditer(text)]
    found += [(m.start(1), "name", m.end(1)) for m in _NAME.finditer(text)]
    found = in_order(found)
    return [x for x, free in zip(found, _apart(found, base), strict=True) if free]


def _apart(found: Sequence[tuple[int, str, int]], base: Sequence[tuple[int, str, int]]) -> list[bool]:
    """Whether each of `found` overlaps no span of `base`; both are in order."""
    starts = [s for s, _, _ in base]
    reach = np.maximum.accumulate([0, *(e for _, _, e in base)]).tolist()
    # Of the spans that begin before one ends, none may end after it begins.
    return [reach[bisect_left(starts, e)] <= s for s, _, e in found]


def votes(text: str, spans: Sequence[tuple[int, str, int]]) -> list[tuple[int, ...]]:
    """For each span its labelers' votes."""
    out = []
    for n, (start, kind, end) in enumerate(spans):
        span, number = text[start:end], digits(text[start:end])
        before = text[max(0, start - CONTEXT) : start]
        beside = [*spans[max(0, n - 2) : n], *spans[n + 1 : n + 3]]
        near = any(abs(s - end) <= COMPANY or abs(start - e) <= COMPANY for s, _, e in beside)
        context = YES if _BEFORE[kind].search(before) else NO if _AGAINST.search(before) else SILENT
        out.append((_form(kind, span, number), _checksum(kind, span, number), _gazetteer(kind, span, number), context, YES if near else SILENT))
    return out


def _form(kind: str, span: str, number: str) -> int:
    if kind == "email":
        return int(re.fullmatch(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@[A-Za-z0-9.-]+\.[A-Za-z]{2,24}", span) is not None)
    if kind == "phone":
        return int(10 <= len(number) <= 13)
    if kind == "card":
        return int(len(number) in (15, 16) and len(set(number)) > 2)
    if kind == "ip":
        return int(not any(len(p) > 1 and p[0] == "0" for p in span.split(".")))
    if kind == "ssn":
        return int(number[:3] not in ("000", "666") and number[0] != "9" and number[3:5] != "00" and number[5:] != "0000")
    return SILENT


def _checksum(kind: str, span: str, number: str) -> int:
    if kind == "card":
        return int(luhn(number))
    if kind == "iban":
        return int(iban_sum(span))
    return SILENT


def _gazetteer(kind: str, span: str, number: str) -> int:
    if kind == "email":
        return YES if re.split(r"[.\s)\]]+", span)[-1].lower() in _TOP_LEVEL else NO
    if kind == "phone":
        return (YES if any(number[:n] in _CALLING for n in (1, 2)) else NO) if span[0] == "+" else SILENT
    if kind == "card":
        return YES if number[0] in "3456" else NO
    if kind == "ip":
        return NO if number.strip("0") == "" or span.startswith(("127.", "255.")) else SILENT
    if kind == "iban":
        return YES if span[:2] in _COUNTRIES else NO
    if kind == "name":
        return YES if span.split()[0].lower() in _GIVEN else SILENT
    return SILENT


def pattern(kind: str, vote: Sequence[int], length: int) -> int:
    """All that the models know of a span, as one number below PATTERNS."""
    code = KINDS.index(kind)
    for v in vote:
        code = code * 3 + v
    return code * (len(_LENGTHS) + 1) + sum(length >= n for n in _LENGTHS)


PATTERNS = len(KINDS) * 3 ** len(LABELERS) * (len(_LENGTHS) + 1)


def unpacked(code: int) -> tuple[int, list[int], int]:
    """Kind, votes and class of length of a pattern."""
    code, length = divmod(code, len(_LENGTHS) + 1)
    vote = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        vote.append(v)
    return code, vote[::-1], length


def reliabilities(kind: np.ndarray, vote: np.ndarray, n: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Probability that each pattern is personal data, by expectation-maximisation.

    Given the truth, labelers are taken to vote independently: each has a
    probability of every vote for either truth, and each kind a share of truth.
    Votes start as right as their majority, and a labeler keeps a little doubt.
    """
    says = (vote == YES).sum(1) - (vote == NO).sum(1)
    truth = 1 / (1 + np.exp(-(says + 0.5)))
    for _ in range(rounds):
        share = np.array([(n * truth)[kind == k].sum() + 1 for k in range(len(KINDS))]) / np.array([n[kind == k].sum() + 2 for k in range(len(KINDS))])
        yes, no = np.log(share[kind]), np.log(1 - share[kind])
        for k in range(vote.shape[1]):
            for held, weight in ((1, n * truth), (0, n * (1 - truth))):
                # A right vote is given more credit in advance than a wrong one, which tells truth from its opposite.
                prior = np.array([4.0, 1.0, 1.0]) if held == NO else np.array([1.0, 4.0, 1.0])
                table = np.log((np.bincount(vote[:, k], weight, 3) + prior) / (weight.sum() + prior.sum()))
                if held:
                    yes = yes + table[vote[:, k]]
                else:
                    no = no + table[vote[:, k]]
        new = 1 / (1 + np.exp(np.clip(no - yes, -500, 500)))
        if np.abs(new - truth).max() < 1e-6:
            break
        truth = new
    return truth


def accepted(counts: Sequence[tuple[int, int]], ridge: float = 1.0) -> list[int]:
    """The patterns that the classifier takes for personal data, of (pattern, number of spans)."""
    if not counts:
        return []
    known = [unpacked(c) for c, _ in counts]
    kind = np.array([k for k, _, _ in known])
    vote = np.array([v for _, v, _ in known])
    n = np.array([c for _, c in counts], float)
    truth = reliabilities(kind, vote, n)
    x = np.column_stack(
        [np.eye(len(KINDS))[kind], *[np.eye(3)[vote[:, k]][:, :2] for k in range(vote.shape[1])], np.eye(len(_LENGTHS) + 1)[[length for _, _, length in known]]]
    )
    # Newton steps on the expected labels; a pattern weighs as its number of spans, more slowly than in proportion.
    weight, w = np.sqrt(n), np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - truth)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return sorted(c for (c, _), ok in zip(counts, p >= 0.5, strict=True) if ok)


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added.

    Counts and digest are of the contract's spans, written kind:start:end by
    start and then kind, comma-joined, in code points. `spans` has those and the
    ones the classifier accepts, `added` the number of the latter. Null and empty
    texts have none; repeated rows, ties and null ids are answered row by row;
    other columns are not read.
    """

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, found = [], [], []
        for whole in batch.column(1).to_pylist():
            whole = whole or ""
            base = base_spans(whole)
            every = in_order([*base, *proposed(whole, base)])
            voted = votes(whole, every)
            counts.append([sum(k == kind for _, k, _ in base) for kind in BASE_KINDS])
            digests.append(hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in base).encode()).hexdigest())
            final = set(base)
            found.append(
                [
                    {"span": f"{x[1]}:{x[0]}:{x[2]}", "pattern": pattern(x[1], v, x[2] - x[0]), "base": x in final}
                    for x, v in zip(every, voted, strict=True)
                ]
            )
        kind = pa.list_(pa.struct([("span", pa.string()), ("pattern", pa.int32()), ("base", pa.bool_())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([c[n] for c in counts], pa.int64()) for n in range(len(BASE_KINDS))], pa.array(digests, pa.string()), pa.array(found, kind)],
            names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "found"],
        )

    rows = docs.select(quoted(key).alias("doc_id"), quoted(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, found array<struct<span:string,pattern:int,base:boolean>>"
    seen = saved(rows.mapInArrow(in_slices(convert), schema), "pii-spans")
    # At most PATTERNS rows, however many documents there are.
    counts = seen.select(F.explode("found.pattern").alias("pattern")).groupBy("pattern").count().collect()
    good = F.array(*map(F.lit, accepted(sorted((r.pattern, r["count"]) for r in counts))))
    kept = F.filter("found", lambda s: s.base | F.array_contains(good.cast("array<int>"), s.pattern))
    return seen.withColumn("kept", kept).select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        "base_sha256",
        F.array_join("kept.span", ",").alias("spans"),
        F.size(F.filter("kept", lambda s: ~s.base)).cast("long").alias("added"),
    )
