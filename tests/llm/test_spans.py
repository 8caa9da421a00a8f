"""Personal data and secrets."""

import base64
import bz2
import gzip
import hashlib
import io
import json
import lzma
import random
import re
import time
import zlib
from collections import Counter
from urllib.parse import quote

import numpy as np
import pytest
import zstandard

from varigrove.llm import pii, queries, secrets
from varigrove.llm.common import table

#: The smallest tables hold no secrets.
FOLDER = "/root/testdata/sf0.01"

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")


def passes_luhn(number):
    total = 0
    for n, d in enumerate(map(int, reversed(number))):
        total += d if n % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def only_digits(text):
    return re.sub("[^0-9]", "", text)


def personal(t):
    out = [("email", m) for m in EMAIL.finditer(t)]
    out += [("ip", m) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in CARD.finditer(t) if 14 <= len(only_digits(m[0])) <= 19 and passes_luhn(only_digits(m[0]))]
    out += [("phone", m) for m in PHONE.finditer(t) if 10 <= len(only_digits(m[0])) <= 15]
    kinds = ["email", "ip", "card", "phone"]
    return [(k, m.start(), m.end()) for k, m in sorted(out, key=lambda x: (x[1].start(), kinds.index(x[0])))]


def secret(t):
    out = [("assign", m) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [("access", m) for m in ACCESS.finditer(t) if len(m[0]) >= 20]
    out += [("hex", m) for m in HEX.finditer(t) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    return [(k, m.start(), m.end()) for k, m in sorted(out, key=lambda x: (x[1].start(), kinds.index(x[0])))]


def written(found):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


@pytest.mark.parametrize(
    ("bits", "want", "got"),
    [
        (
            [*"ab.@-+%_ ()01234567899", "a@b.c", "1.2.3.4", "255", "4111111111111111", "é", "+1 (555) 123-4567", "٣", "(at)", "Mr Ann"],
            personal,
            lambda t: [(k, s, e) for s, k, e in pii.base_spans(t)],
        ),
        (
            ["password", "PassWD", "secret", "token", "api_key", "apikey", *"=: '\"-x\n", "abc123", "deadbeef01", "AKIA", "ABCDEFGH12", "0123456789abcdef", "Key", "ſecret"],
            secret,
            lambda t: sorted(secrets.scan(t), key=lambda x: (x[1], secrets.KINDS.index(x[0]))),
        ),
    ],
)
def test_base_against_the_patterns(bits, want, got):
    rng = random.Random(4)
    for _ in range(8000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))
        assert got(text) == want(text), text


@pytest.mark.parametrize(("name", "want", "more"), [("op6_personal_data", personal, "added"), ("op8_secret_scan", secret, "layered")])
def test_queries(spark, name, want, more):
    got = {r.doc_id: r for r in queries.registered()[name](spark, FOLDER).collect()}
    docs = table(spark, FOLDER, "documents").collect()
    assert len(got) == len(docs)
    seen = Counter()
    for d in docs:
        base, r = want(d.text), got[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        counts = Counter(k for k, _, _ in base)
        assert all(r[f"n_{k}"] == n for k, n in counts.items())
        listed = [x for x in r.spans.split(",") if x]
        assert set(written(base).split(",")) - {""} <= set(listed) and len(listed) == len(base) + r[more]
        seen += counts
    assert len(seen) >= 2  # these tables hold no access keys


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


PLAIN = "password=hunter2hunter2"


@pytest.mark.parametrize(
    "wrapped",
    [
        quote(PLAIN, safe=""),
        "".join(f"\\u{ord(c):04x}" for c in PLAIN),
        "".join(f"\\x{ord(c):02x}" for c in PLAIN),
        "".join(f"&#{ord(c)};" for c in PLAIN),
        b64(PLAIN),
        b64(PLAIN).rstrip("="),
        b64(b64(b64(PLAIN))),
        *(b64(f(PLAIN.encode())) for f in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress)),
        quote(b64(b64(gzip.compress(quote(PLAIN, safe="").encode()))), safe="").replace("%", "%25"),
        "p%2561ssword%253Dhunter2hunter2",
        b64(gzip.compress(b"x" * 3_000_000 + b" " + PLAIN.encode())),
    ],
)
def test_layers(wrapped):
    text = f"héllo {wrapped} end"
    base, added = secrets.find_secrets(text)
    assert base == [] and added and all(k == "assign" and 6 <= s and e <= 6 + len(wrapped) for k, s, e in added)
    # A run of base64 is found with or without the escaped padding behind it.
    assert max(e - s for _, s, e in added) >= len(wrapped.removesuffix("%253D%253D")) - 2


def lines(run, width=64):
    return "\n".join(run[n : n + width] for n in range(0, len(run), width))


NOISE = " ".join(hashlib.sha256(b"%d" % n).hexdigest()[:20] for n in range(200))


@pytest.mark.parametrize("around", ["\u00a0", "\u3000", "\u200d", "\u00ad", "\ufeff", "\f", "\0"])
def test_any_decoded_text_is_scanned(around):
    assert secrets.find_secrets(f"a {b64(around + ' ' + PLAIN)} b")[1]
    assert secrets.find_secrets(f"a {b64(PLAIN.encode('utf-16'))} b")[1]


@pytest.mark.parametrize("prefix", ["x/", "id_", "abc-", "a/b/", "k_"])
def test_base64_behind_a_prefix_and_over_lines(prefix):
    for inner in (f"{NOISE} {PLAIN}".encode(), gzip.compress(f"{NOISE} {PLAIN}".encode()), zlib.compress(PLAIN.encode())):
        assert secrets.find_secrets(f"a {prefix}{b64(inner)} b")[1]
        for wrapped in (lines(b64(inner)), lines(b64(inner), 76).replace("\n", "\r\n  ")):
            assert secrets.find_secrets(f"a\n{wrapped}\nb")[1]


@pytest.mark.parametrize("level", range(10))
def test_all_members_of_packed_data(level):
    assert secrets.find_secrets(b64(zlib.compress(PLAIN.encode(), level)))[1]
    for pack in (gzip.compress, bz2.compress, lzma.compress, zstandard.compress):
        assert secrets.find_secrets(b64(pack(b"nothing here") + pack(PLAIN.encode())))[1]


def damaged(data, behind=8):
    """`data` with another byte in the checksum at its end."""
    return data[:-behind] + bytes([data[-behind] ^ 255]) + data[len(data) - behind + 1 :]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
@pytest.mark.parametrize("noise", [0, 300_000])
def test_damaged_packed_data_counts_up_to_the_damage(pack, noise):
    content = b"word " * noise + PLAIN.encode() + b" end"
    data = pack(content)
    for bad in (damaged(data, 4 if pack is zlib.compress else 8), damaged(data, 1), data[:-1], data[:-4]):
        assert secrets.find_secrets(f"a {b64(bad)} b")[1]
    checked = zstandard.ZstdCompressor(write_checksum=True).compress(content)
    assert secrets.find_secrets(f"a {b64(damaged(checked, 1))} b")[1]


def test_damage_in_the_middle():
    content = (f"{PLAIN} " + NOISE * 20).encode()
    data = bytearray(gzip.compress(content))
    data[len(data) // 2 :] = b"\xff" * (len(data) - len(data) // 2)
    assert secrets.find_secrets(b64(bytes(data)))[1]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_packed_data_under_escapes(pack):
    data = pack(f"{NOISE} {PLAIN}".encode())
    for written in (
        quote(data, safe=""),
        "".join(f"%{b:02x}" for b in data),
        "".join(f"\\x{b:02X}" for b in data),
        repr(data),
        json.dumps(data.decode("latin-1")),
        quote(quote(data, safe=""), safe=""),
    ):
        text = f"é one\n{written}\nend"
        assert [(k, 6 <= s < e <= 6 + len(written)) for k, s, e in secrets.find_secrets(text)[1]] == [("assign", True)]


def test_raw_deflate_and_headers():
    engine = zlib.compressobj(9, zlib.DEFLATED, -15)
    assert secrets.find_secrets(b64(engine.compress(f"{NOISE} {PLAIN}".encode()) + engine.flush()))[1]
    named = io.BytesIO()
    with gzip.GzipFile("a name", "wb", fileobj=named) as f:
        f.write(PLAIN.encode())
    assert secrets.find_secrets(b64(named.getvalue()))[1]


def test_xz_with_a_large_dictionary():
    filters = [{"id": lzma.FILTER_LZMA2, "dict_size": 3 << 28, "mode": lzma.MODE_FAST, "mf": lzma.MF_HC3, "nice_len": 32}]
    # Written small; the header is what asks for the memory.
    data = lzma.compress(PLAIN.encode(), filters=filters)
    assert secrets.find_secrets(b64(data))[1]


@pytest.mark.parametrize("width", [4, 8, 12, 15, 16, 64])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", "\\r\\n"])
def test_line_ends_and_short_lines(width, end):
    for inner in (f"{NOISE} {PLAIN}".encode(), gzip.compress(f"{NOISE} {PLAIN}".encode())):
        written = lines(b64(inner), width).replace("\n", end)
        assert secrets.find_secrets(f'{{"key": "{written}"}}')[1]


@pytest.mark.parametrize("before", [1 << 20, (1 << 20) - 3000, (1 << 20) - 9000])
def test_runs_over_a_stretch_are_whole(before):
    inner = b64(gzip.compress((" ".join(hashlib.sha256(b"%d" % n).hexdigest()[:20] for n in range(2000)) + " " + PLAIN).encode()))
    assert len(inner) > 20_000
    for run in (inner, lines(inner)):
        text = "x y " * ((before - 8000) // 4) + " " + run + " end" * 1000
        assert secrets.find_secrets(b64(gzip.compress(text.encode())))[1]


def test_layers_leave_open_secrets_alone():
    text = f"{PLAIN} and {quote(PLAIN, safe='')}"
    base, added = secrets.find_secrets(text)
    assert base == [("assign", 0, len(PLAIN))] and len(added) == 1
    assert secrets.find_secrets("plain words of more than sixteenlettersinone and 100%20sure")[1] == []


def test_cycles_end():
    loop = "%2525252525252541" * 20 + "\\u005cu005cu0041" + "&amp;amp;amp;lt;"
    assert secrets.find_secrets(loop) == ([], [])


@pytest.mark.parametrize(
    "text",
    ["x%9C" * 25_000, "BZh91AY&SY%41" * 8_000, "%1f%8b%08" * 11_000, "\\x78\\x9c" * 12_000, "abcd\\n" * 16_000, "word\n" * 20_000, "a" * 99_999, "1." * 50_000, "+1" * 50_000, "+1" + " " * 99_999, "password" * 10_000, "%41" * 30_000, "a@" * 50_000, "1 " * 50_000, "ab" * 50_000, "(at)" * 20_000, "a.a" * 30_000 + "@", "Mr A " * 20_000],
)
def test_time_is_linear(text):
    start = time.process_time()
    base = pii.base_spans(text)
    pii.votes(text, pii.in_order([*base, *pii.proposed(text, base)]))
    secrets.find_secrets(text)
    assert time.process_time() - start < 8


def test_reliabilities_find_the_truth():
    """Labelers of known worth: the estimate parts patterns as Bayes' rule does."""
    rng = np.random.default_rng(3)
    n, right = 20_000, [0.9, 0.8, 0.75, 0.85, 0.7]
    truth = rng.random(n) < 0.4
    vote = np.stack([np.where(rng.random(n) < 0.2, pii.SILENT, np.where(rng.random(n) < r, truth, ~truth)) for r in right], 1)
    rows, back, count = np.unique(vote, axis=0, return_inverse=True, return_counts=True)
    found = pii.reliabilities(np.zeros(len(rows), int), rows, count.astype(float))
    log_odds = np.log(0.4 / 0.6) + sum(
        np.where(rows[:, k] == 1, np.log(r / (1 - r)), np.where(rows[:, k] == 0, -np.log(r / (1 - r)), 0)) for k, r in enumerate(right)
    )
    clear = np.abs(log_odds) > 0.7
    assert ((found > 0.5) == (log_odds > 0))[clear].all()
    assert ((found > 0.5)[back.ravel()] == truth).mean() > 0.85
    assert pii.accepted([]) == []


def test_patterns_are_reversible():
    rng = random.Random(1)
    for _ in range(200):
        kind, vote, length = rng.randrange(len(pii.KINDS)), [rng.randrange(3) for _ in pii.LABELERS], rng.randrange(60)
        code = pii.pattern(pii.KINDS[kind], vote, length)
        assert 0 <= code < pii.PATTERNS and pii.unpacked(code) == (kind, vote, sum(length >= x for x in (8, 16, 24)))


def test_more_personal_data_is_proposed(spark):
    texts = [f"Contact email: user{n} (at) mail.example.com, call +1 212 555 01{n:02d} or tel (212) 555-01{n:02d}" for n in range(60)]
    texts += [f"order version 555-12-{n:04d} of page 1" for n in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_spans(df).collect()}
    assert all(got[n].n_phone == 1 and got[n].added >= 1 and "email:" in got[n].spans for n in range(60))


def test_odd_rows(odd, none):
    for f in (pii.personal_spans, secrets.secret_spans):
        assert f(odd).count() == odd.count() and all(r.spans == "" for r in f(odd).collect())
        assert f(none).collect() == []
