import hashlib
import random
import re

import pytest

from shelfweek.llm import pii

SCHEMA = "doc_id bigint, text string, spans string, n_ip int"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The known forms by their regular expressions as they are stated."""

    def luhn(d):
        double = [int(c) * 2 for c in d[-2::-2]]
        return (sum(map(int, d[-1::-2])) + sum(x - 9 if x > 9 else x for x in double)) % 10 == 0

    def digits(s):
        return re.sub("[^0-9]", "", s)

    tests = [
        (EMAIL, lambda s: True),
        (IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
        (CARD, lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (PHONE, lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (r, ok) in enumerate(tests) for m in r.finditer(text) if ok(m[0]))


TEXTS = [
    "a@b.c@d.e x@y z@w.v. q@-.- .@a.b %+-@a--b.c.d- @a.b a@@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 1..2.3.4.5.6",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 79927398713", "+1 (988) 555-2485 +12345678 +1----- +1.2.3.4.5.6.7.8.9+44 20 7946 0958.",
    "ü@ö.de 10.0.0.1é٣.٣.٣.٣ 1.2.3.٤", "", "none", "+49 4111 1111 1111 1111 a1.2.3.4@h.i", "0.0.0.0.", "999.1.2.3.4.5.6.7",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_by_hand(text):
    assert pii.base_spans(text) == plain(text)


def test_base_on_random_strings():
    chance = random.Random(0)
    for alphabet in ("a@.-1", "12.3 -", "+1 ().-2", "1234567890 -.+@a"):
        for _ in range(3000):
            text = "".join(chance.choices(alphabet, k=chance.randint(1, 40)))
            assert pii.base_spans(text) == plain(text), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 20_000, "@a" * 20_000, "+1 " * 10_000, "a@b." * 10_000):
        base = pii.base_spans(text)
        pii.added_spans(text, base, {"card:bias": -1.0})


@pytest.fixture(scope="module")
def weights(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return pii.trained(docs)


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("write to john dot doe at mail dot example dot com today", 0, "john dot doe at mail dot example dot com"),
        ("call (555) 123-4567 now", 3, "(555) 123-4567"),
        ("call 555-123-4567 now", 3, "555-123-4567"),
        ("card 4111.1111.1111.1111 ok", 2, "4111.1111.1111.1111"),
        ("host 10 dot 0 dot 0 dot 1 yes", 1, "10 dot 0 dot 0 dot 1"),
    ],
)
def test_respelled_forms_are_added(weights, text, kind, span):
    assert not pii.base_spans(text)
    assert [(k, text[a:b]) for a, k, b in pii.added_spans(text, [], weights)] == [(kind, span)]


@pytest.mark.parametrize(
    "text",
    ["in 1999 and 2000, 300 at 25", "version 2.0.14 of 2024-01-31 at 12:30:45", "order 1234567890123456 is late",
     "the dot at the end", "1,000,000 of 7.5 billion", "Apache License, Version 2.0, page 12-14"],
)
def test_ordinary_numbers_are_left_alone(weights, text):
    assert pii.added_spans(text, pii.base_spans(text), weights) == []


@pytest.mark.parametrize(
    "text", ["1² + 2² + 3² + 4²", "① 1 ② 2", "² ² ² ² 1234", "١.٢.٣.٤ 10 dot", "⁴ . ⁴ . ⁴ . ⁴ 12 34"]
)
def test_digits_that_are_no_numbers(weights, text):
    assert pii.added_spans(text, pii.base_spans(text), weights) == []


def test_rare_kinds_are_learnt(spark):
    """A few documents of each kind among thousands that only hold numbers."""
    chance, own = random.Random(3), lambda n: str(chance.randrange(10 ** (n - 1), 10**n))
    texts = [f"in the year {own(4)} there were {own(chance.randint(1, 7))} of them" for _ in range(6000)]
    for n in range(8):
        card = next(c for c in (own(16) for _ in range(1000)) if pii.luhn(c))
        texts += [
            f"write to name{n}.last@host{n}.example.org about it", f"the host at {n}.20.3{n}.4 answers",
            f"paid by {card} in time", f"please call +1 (555) {own(3)}-{own(4)} soon",
        ]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    weights = pii.trained(docs.repartition(3))
    assert pii.trained(docs.repartition(7)) == weights
    for text, kind, span in [
        ("write to john dot doe at mail dot example dot com today", 0, "john dot doe at mail dot example dot com"),
        ("host 10 dot 0 dot 0 dot 1 yes", 1, "10 dot 0 dot 0 dot 1"),
        ("card 4111.1111.1111.1111 ok", 2, "4111.1111.1111.1111"),
        ("call (555) 123-4567 now", 3, "(555) 123-4567"),
    ]:
        assert [(k, text[a:b]) for a, k, b in pii.added_spans(text, [], weights)] == [(kind, span)]
    assert pii.added_spans("in 1999 and 2000, 300 at 25", [], weights) == []


def test_an_at_before_a_host_opens_a_window(weights):
    text = "write to john at example.com today"
    assert [(k, text[a:b]) for a, k, b in pii.added_spans(text, [], weights)] == [(0, "john at example.com")]


def test_spans_of_long_runs_are_whole(weights):
    """A directory of numbers is one run, wherever an entry lies in it."""
    forms = ["(555) 123-4567", "10 dot 0 dot 0 dot 1", "4111.1111.1111.1111"]
    for shift in range(3):
        want, text = [], "x" * 7 * shift
        for n in range(900):
            text += " entry " if n % 3 else " the entry of "
            want.append(text + forms[n % 3])
            text = want[-1]
        want = [(len(t) - len(forms[n % 3]), len(t)) for n, t in enumerate(want)]
        assert [(a, b) for a, _, b in pii.added_spans(text, pii.base_spans(text), weights)] == want


def test_blocks_give_the_best_segmentation_of_the_whole(monkeypatch):
    chance = random.Random(8)
    parts = ["555", "1234", "4111", "-", ".", " ", " dot ", " at ", "mail", "@", "(", ")", "x", "10.0.0.1", "²"]
    weights = {}
    for n in range(60):
        text = "".join(chance.choices(parts, k=150))
        base = pii.base_spans(text) if n % 2 else []
        tokens = list(pii.TOKEN.finditer(text))
        by_end = pii.segments(text, tokens, base)
        for x in sorted({x for ends in by_end for _, _, f in ends for x in f}):
            weights.setdefault(x, chance.uniform(-1, 1))
        want = [(tokens[i].start(), k, tokens[j - 1].end()) for i, k, j in pii.decode(by_end, weights)]
        for block in (1, 5, 40, 1000):
            monkeypatch.setattr(pii, "BLOCK", block)
            assert pii.decode_run(text, 0, len(text), base, weights) == want


def test_clean_documents_are_left_alone(weights, spark):
    """Rows of the test data without any known form get hardly a span."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    clean = [t for t in texts if not plain(t)]
    assert sum(bool(pii.added_spans(t, [], weights)) for t in clean) <= 0.01 * len(clean)


def test_gradient_of_the_likelihood():
    """Expected counts are the derivative of the log partition function."""
    text = "call (555) 123-4567 or 4111 1111 1111 1111 at home"
    by_end = pii.segments(text, list(pii.TOKEN.finditer(text)))
    names = sorted({x for ends in by_end for _, _, f in ends for x in f})
    chance = random.Random(1)
    weights = {x: chance.uniform(-1, 1) for x in names}

    def log_sum_of_all(w):
        total = [0.0]
        for ends in pii._scores(by_end, w)[1:]:
            total.append(pii._log_sum([total[i] + s for i, _, _, s in ends]))
        return total[-1]

    counts = pii.expected(by_end, weights)
    for x in names[::7]:
        up, down = dict(weights), dict(weights)
        up[x] += 1e-5
        down[x] -= 1e-5
        assert counts[x] == pytest.approx((log_sum_of_all(up) - log_sum_of_all(down)) / 2e-5, abs=1e-4)


def test_best_segmentation_is_the_best_of_all():
    text = "x 555 123 4567 y"
    by_end = pii.segments(text, list(pii.TOKEN.finditer(text)))
    chance = random.Random(4)

    def every(j):
        if j == 0:
            yield 0.0, []
        for i, k, f in by_end[j]:
            for score, found in every(i):
                yield score + sum(weights.get(x, 0) for x in f), found + ([(i, k, j)] if k >= 0 else [])

    for _ in range(20):
        weights = {x: chance.uniform(-1, 1) for ends in by_end for _, _, f in ends for x in f}
        found = pii.decode(by_end, weights)
        score = {tuple(f): s for s, f in every(len(by_end) - 1)}
        assert score[tuple(found)] == pytest.approx(max(score.values()))


def test_table(spark):
    rows = [(i, t, "old", 7) for i, t in enumerate(TEXTS)] + [(50, None, None, None), (None, TEXTS[0], "", 0), (0, TEXTS[0], "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = pii.find_personal_data(docs, keep=["doc_id"]).collect()
    assert len(got) == len(rows)
    for r, (_, text, *_) in zip(got, rows):
        base = plain(text or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        own = [tuple(int(x) for x in s.split(":")[1:]) for s in r.spans.split(",") if s]
        known = [(a, b) for a, _, b in base]
        assert set(known) <= set(own)
        assert all(b <= c or d <= a for a, b in known for c, d in set(own) - set(known))
    assert pii.find_personal_data(docs.limit(0)).collect() == []
    assert "spans" in pii.find_personal_data(docs).columns


PROSE = [
    "We met 12 people at the old stone bridge. Then we left",
    "In 1999 the company opened at Main Street. Sales grew",
    "Version 10.2 was shipped at night. Users complained",
    "Table: 100 200 300 400 500", "2021 2022 2023 2024 2025", "The 3 houses at home.The others",
    "1. 2. 3. 4. and so on", "pages 1967 231 4310 and 47.46 550 1907", "at\n10.\nThen dot",
]


@pytest.mark.parametrize("text", PROSE)
def test_prose_is_left_alone(weights, text):
    assert pii.added_spans(text, pii.base_spans(text), weights) == []


def test_ordinary_sentences_hold_no_spans(weights):
    """At most one of a thousand sentences with numbers, 'at' and full stops gets a span."""
    chance = random.Random(4)
    nouns = "people trains houses rooms pages cars books days miles stations lines users".split()
    verbs = "met opened sold counted moved shipped closed built found left".split()
    places = "the old bridge,Main Street,night,the station,noon,the end,level 3,the office,home,port 8080".split(",")

    def number():
        n = chance.randrange(10 ** chance.randint(1, 6))
        return chance.choice([f"{n}", f"{n % 100}.{n % 97}", f"{n % 998 + 1},{chance.randrange(100, 999)}", f"{1900 + n % 130}"])

    hits = []
    for _ in range(4000):
        a, b, c, d, e = (number() for _ in range(5))
        noun, other, verb, place = chance.choice(nouns), chance.choice(nouns), chance.choice(verbs), chance.choice(places)
        text = chance.choice([
            f"In {a} they {verb} {b} {noun} at {place}. Then {c} {other} {verb}.",
            f"The {noun} of {a} {verb} at {place}.The {other} too, {b} - {c}.",
            f"See section {a}, page {b}: {c} {d} {e} at {place}. {a} dot points.",
            f"Scores were {a} {b} {c} {d}; open at {chance.randrange(24)}:{chance.randrange(60):02d}. Call later.",
        ])
        hits += pii.added_spans(text, pii.base_spans(text), weights)
    assert len(hits) <= 4


def test_respelled_forms_are_found_whole(weights):
    chance, missed, n = random.Random(6), [], 0
    for i in range(300):
        digits = "".join(chance.choices("0123456789", k=15))
        card = "4" + digits[:14]
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        forms = [f"dean{i}.{i}@mail{i}.example.com", f"10.{i % 256}.{i % 199}.{i % 77 + 1}", card, f"+1 (2{digits[:2]}) 555-{digits[2:6]}"]
        for kind, form in enumerate(forms):
            span = pii.respelled(form, kind, chance)
            text = f"please use {span} from now on"
            if not pii.base_spans(text):
                n += 1
                got = pii.added_spans(text, [], weights)
                missed += [] if (11, kind, 11 + len(span)) in got else [span]
    assert len(missed) <= 0.1 * n, missed[:20]


def test_dotted_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "a@b.cd", "x", "y")], "doc_id bigint, text string, `a.b` string, body string")
    found = pii.find_personal_data(rows)
    assert found.columns[:4] == rows.columns and found.first().n_email == 1
