"""Personal data: known forms, and spans that a semi-Markov conditional random field adds.

The known forms are regular expressions with checks. The field reads the text
around digits, at-signs and the words that stand for them as tokens. A segment
is a run of at most LONGEST tokens with a kind, or a single token outside; its
score is a weighted sum of features of the whole span (its shape, digit and
part counts, checks, joining words, neighbours). Dynamic programming over the
segmentations of a window finds the best boundaries and kinds together; windows
in which the base forms lie are segmented around them, so those always stay.

The weights maximise the likelihood of segmentations of windows whose spans are
known: a bounded sample of the base matches of each kind, as found and respelled
("name at host dot org", blanks or dots for dashes), beside windows of ordinary
numbers. They are fitted once, in the driver, with the gradient from the
forward and backward sums over all segmentations.
"""

import hashlib
import heapq
import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.llm.common import plainly, quoted, renamed

# Kinds in their order, and the known forms.
KINDS = ("email", "ip", "card", "phone")
EMAIL_LOCALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LONGEST = 12
# Base matches of a kind to learn from, of one document at most, and the longest of them.
MATCHES = 34
OWN_MATCHES = 4
LONGEST_MATCH = 256
# Windows without a base match that are learnt as ordinary text, and the longest of them.
ORDINARY = 136
LONGEST_WINDOW = 400
# Rounds of the fit.
ROUNDS = 15
# Characters on either side of a mark that are read with it, and tokens read at a time.
ROOM = 48
BLOCK = 512

TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
TRIGGER = re.compile(r"[0-9@]|(?i:\bdot\b|[(\[]at[)\]]|\bat\s+\w[\w-]*\.\w)")
BLANK = re.compile(r"\s")
HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def is_number(word: str) -> bool:
    """ASCII digits only: isdigit() is also true for superscripts and circled digits."""
    return word.isascii() and word.isdigit()


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str):
    """Leftmost non-overlapping matches, found from the at-signs: linear in the text."""
    done = at = 0
    while (at := text.find("@", max(at, done))) >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_LOCALS:
            start -= 1
        host = EMAIL_HOST.match(text, at + 1)
        if start < at and host:
            yield start, host.end()
            done = host.end()
        at += 1


def addresses(text: str):
    """Four numbers joined by dots, taken from the left of every dotted run."""
    for run in DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        at, parts = run.start(), run[0].split(".")
        for i in range(0, len(parts), 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + len(four) - 1
            if len(four) == 4 and all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def cards(text: str):
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms in order."""
    if not HINT.search(text):
        return []
    finders = (emails, addresses, cards, phones)
    return sorted((a, k, b) for k, find in enumerate(finders) for a, b in find(text))


# --- the field ---

JOIN_AT = {"at", "@"}
JOIN_DOT = {"dot", "."}


def features(text: str, tokens: list, i: int, j: int, kind: int) -> list[str]:
    """Names of the features of the span of tokens i to j as one segment of ``kind``."""
    words = [t[0] for t in tokens[i:j]]
    span = text[tokens[i].start() : tokens[j - 1].end()]
    lower = [w.lower() for w in words]
    digits = digits_of(span)
    numbers = [w for w in words if is_number(w)]
    k = KINDS[kind]
    found = [f"{k}:bias"]
    if kind == 0:
        at = [n for n, w in enumerate(lower) if w in JOIN_AT]
        dots = [n for n, w in enumerate(lower) if w in JOIN_DOT]
        shaped = (
            len(at) == 1 and 0 < at[0] < len(words) - 3 and any(n > at[0] + 1 for n in dots)
            and re.search("[A-Za-z]{2}", words[-1]) and re.search("[^0-9]", words[0]) and words[0][0].isalnum()
            and re.search("[^0-9]", words[at[0] + 1]) and lower[0] not in JOIN_DOT and lower[-1] not in JOIN_DOT
        )
        signs = any(w in "@[(" for w in words)
        found += [f"email:whole{(signs or words[-1].islower()) and _whole(text, tokens, i, j)}"]
        spelled = shaped and not any(words[n] == "@" for n in at)
        found += [f"email:shaped{bool(shaped)}", f"email:at{len(at)}"]
        found += [f"email:dotword{spelled and any(lower[n] == 'dot' for n in dots)}"] if spelled else []
        found += [f"email:inner{_inner(text, tokens, i, j, at)}"]
        found += [f"email:signs{signs}"]
    elif kind == 1:
        fits = len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
        between = [w for w in lower if not is_number(w)]
        found += [f"ip:four{fits}", f"ip:joined{len(between) == 3 and set(between) <= JOIN_DOT}"]
        found += [f"ip:even{_even(text, tokens, i, j)}"]
    elif kind == 2:
        plain = set(span) <= set("0123456789 -.")
        found += [f"card:length{12 <= len(digits) <= 19}", f"card:plain{plain}"]
        found += [f"card:luhn{plain and 12 <= len(digits) <= 19 and luhn(digits)}"]
        found += [f"card:groups{_groups(text, tokens, i, j)}"]
    else:
        plain = set(span) <= set("0123456789 +-().")
        long = 10 <= len(digits) <= 15
        found += [f"phone:length{long}", f"phone:plain{plain}", f"phone:first{words[0] in ('+', '(')}"]
        found += [f"phone:grouped{plain and long and [len(n) for n in numbers][-2:] == [3, 4]}"]
        found += [f"phone:apart{_apart(text, tokens, i, j)}"]
    edge = words[0].isalnum() or words[0] in "+("
    found += [f"{k}:edges{edge and words[-1].isalnum()}"]
    glued = (i > 0 and tokens[i - 1].end() == tokens[i].start() and tokens[i - 1][0] not in "([<\"',;:=") or (
        j < len(tokens) and tokens[j - 1].end() == tokens[j].start() and tokens[j][0].isalnum()
    )
    found += [f"{k}:glued{glued}"]
    return found


def _even(text, tokens, i, j) -> bool:
    """Joining signs have a blank on both sides or on neither."""
    gaps = [text[tokens[n].end() : tokens[n + 1].start()] for n in range(i, j - 1)]
    return len(set(gaps)) == 1 and gaps[0] in ("", " ")


def _apart(text, tokens, i, j) -> bool:
    """An area code in brackets or groups joined alike, in neither case part of a longer number.

    Groups with blanks between them are of three, three and four digits, and no
    number stands beside them.
    """
    start = tokens[i].start()
    if text[start - 1 : start] in (".", ",") and text[max(start - 2, 0) : start - 1].isdigit():
        return False
    if tokens[i][0] in "+(":
        return True
    spans = [t.span() for t in tokens[i:j] if is_number(t[0])]
    joints = {text[a[1] : b[0]] for a, b in zip(spans, spans[1:])}
    if joints != {" "}:
        return len(joints) == 1
    around = [*tokens[max(i - 1, 0) : i], *tokens[j : j + 1]]
    shape = [b - a for a, b in spans] == [3, 3, 4] and text[spans[0][0]] > "1"
    return shape and not any(is_number(t[0]) for t in around)


def _groups(text, tokens, i, j) -> bool:
    """One number, or numbers of four digits (the last of any) joined alike by more than a blank or hyphen.

    Those with a blank or hyphen are of the known form, or part of a row of numbers.
    """
    spans = [t.span() for t in tokens[i:j] if is_number(t[0])]
    joints = {text[a[1] : b[0]] for a, b in zip(spans, spans[1:])}
    if not joints:
        return True
    return len(joints) == 1 and not joints & {" ", "-"} and all(b - a == 4 for a, b in spans[:-1])


def _whole(text, tokens, i, j) -> bool:
    """Neither the token before nor the one behind goes on with a dotted name."""
    if i:
        t = tokens[i - 1]
        if t[0].lower() == "dot" or t[0] in ".-_+%" and t.end() == tokens[i].start():
            return False
    if j < len(tokens):
        t = tokens[j]
        tight = t[0] in ".-" and t.start() == tokens[j - 1].end()
        if t[0].lower() == "dot" or tight and text[t.end() : t.end() + 1].isalnum():
            return False
    return True


def _inner(text, tokens, i, j, at) -> bool:
    """Single blanks stand only beside joining words and signs."""
    for n in range(i, j - 1):
        if tokens[n].end() != tokens[n + 1].start():
            if text[tokens[n].end() : tokens[n + 1].start()] != " ":
                return False
            pair = {tokens[n][0].lower(), tokens[n + 1][0].lower()}
            if not pair & {"at", "dot", "(", ")", "[", "]"}:
                return False
    return bool(at)


# Without these a span is no candidate of its kind: prose and plain numbers have none.
NEEDED = (
    {"email:shapedTrue", "email:innerTrue", "email:wholeTrue"},
    {"ip:fourTrue", "ip:joinedTrue", "ip:evenTrue"},
    {"card:luhnTrue", "card:groupsTrue"},
    {"phone:groupedTrue", "phone:apartTrue"},
)


def _ending(text: str, tokens: list, held: list, j: int) -> list[tuple[int, int, list[str]]]:
    """The possible segments (start, kind or -1, features) that end before token j."""
    ends = [(j - 1, -1, [])]
    for i in range(max(0, j - LONGEST), j):
        if any(held[i:j]):
            continue
        words = [t[0] for t in tokens[i:j]]
        if JOIN_AT & {w.lower() for w in words} and j - i >= 5:
            found = features(text, tokens, i, j, 0)
            if NEEDED[0].issubset(found):
                ends.append((i, 0, found))
        count = sum(len(w) for w in words if is_number(w))
        if count >= 4 and not any(w.isalpha() and w.lower() != "dot" for w in words):
            for kind in (1, 2, 3):
                found = features(text, tokens, i, j, kind)
                if NEEDED[kind].issubset(found):
                    ends.append((i, kind, found))
    return ends


def _held(tokens: list, fixed) -> list[bool]:
    """Whether a token touches one of the spans, which are in order of their starts."""
    held, at, reach = [], 0, -1
    for t in tokens:
        while at < len(fixed) and fixed[at][0] < t.end():
            reach = max(reach, fixed[at][2])
            at += 1
        held.append(t.start() < reach)
    return held


def segments(text: str, tokens: list, fixed=()) -> list[list[tuple[int, int, list[str]]]]:
    """For every end, the possible segments (start, kind or -1, features) of a window.

    Segments that would touch a base span are left out; its tokens are outside.
    """
    held = _held(tokens, fixed)
    return [[], *(_ending(text, tokens, held, j) for j in range(1, len(tokens) + 1))]


def _scores(by_end, weights):
    return [[(i, k, f, sum(weights.get(x, 0.0) for x in f)) for i, k, f in ends] for ends in by_end]


def decode(by_end, weights) -> list[tuple[int, int, int]]:
    """(first token, kind, end token) of the segments of the best segmentation."""
    best, back = [0.0], [None]
    for j, ends in enumerate(_scores(by_end, weights)[1:], 1):
        score, i, k = max((best[i] + s, i, k) for i, k, _, s in ends)
        best.append(score)
        back.append((i, k))
    found, j = [], len(best) - 1
    while j:
        i, k = back[j]
        if k >= 0:
            found.append((i, k, j))
        j = i
    return found[::-1]


def decode_run(text: str, start: int, end: int, fixed, weights) -> list[tuple[int, int, int]]:
    """(start, kind, end) in the text of the best segmentation of all tokens from start to end.

    What ``decode`` gives for the whole run, but tokens are read in blocks, and
    those before the last boundary that all best segmentations share are let go.
    """
    unread = TOKEN.finditer(text, start, end)
    tokens, held, best, back, found = [], [], [0.0], [None], []
    first = at = 0
    while True:
        block = list(islice(unread, BLOCK))
        # The spans that reach into the block; fixed is in order of starts.
        if block:
            while at < len(fixed) and fixed[at][2] <= block[0].start():
                at += 1
            held += _held(block, fixed[at : bisect_left(fixed, (block[-1].end(),), at)])
        tokens += block
        last = len(block) < BLOCK
        # A segment's features look at the token behind it.
        for j in range(len(best), len(tokens) + last):
            scored = _scores([_ending(text, tokens, held, j)], weights)[0]
            score, i, k = max((best[i] + s, i, k) for i, k, _, s in scored if i >= first)
            best.append(score)
            back.append((i, k))
        ends = {len(best) - 1} if last else set(range(max(first, len(best) - LONGEST), len(best)))
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(back[latest][0])
        (common,) = ends
        own, j = [], common
        while j > first:
            i, k = back[j]
            if k >= 0:
                own.append((tokens[i].start(), k, tokens[j - 1].end()))
            j = i
        found += own[::-1]
        if last:
            return found
        # One token stays, as the features look at the token before a segment.
        drop = max(common - 1, 0)
        first = common - drop
        tokens, held = tokens[drop:], held[drop:]
        best = best[drop:]
        back = [b and (b[0] - drop, b[1]) for b in back[drop:]]


def _log_sum(values):
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def expected(by_end, weights) -> dict[str, float]:
    """Expected number of every feature over all segmentations."""
    scored = _scores(by_end, weights)
    n = len(scored) - 1
    before = [0.0] + [0.0] * n
    for j in range(1, n + 1):
        before[j] = _log_sum([before[i] + s for i, _, _, s in scored[j]])
    after = [-math.inf] * n + [0.0]
    for j in range(n, 0, -1):
        for i, _, _, s in scored[j]:
            v = after[j] + s
            high, low = max(after[i], v), min(after[i], v)
            after[i] = high + math.log1p(math.exp(low - high)) if low > -math.inf else high
    counts = defaultdict(float)
    for j in range(1, n + 1):
        for i, _, f, s in scored[j]:
            if f:
                p = math.exp(before[i] + s + after[j] - before[n])
                for x in f:
                    counts[x] += p
    return counts


def fit(windows: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = ROUNDS) -> dict[str, float]:
    """Weights from windows with known (start, kind, end), by adaptive gradient steps."""
    examples = []
    for text, spans in windows:
        tokens = list(TOKEN.finditer(text))
        by_end = segments(text, tokens)
        gold = defaultdict(float)
        for j, ends in enumerate(by_end):
            for i, k, f in ends:
                if k >= 0 and (tokens[i].start(), k, tokens[j - 1].end()) in spans:
                    for x in f:
                        gold[x] += 1
        examples.append((by_end, gold))
    weights, squares = defaultdict(float), defaultdict(lambda: 1e-3)
    for _ in range(rounds):
        for by_end, gold in examples:
            counts = expected(by_end, weights)
            for x in counts.keys() | gold.keys():
                step = gold.get(x, 0.0) - counts.get(x, 0.0) - 0.002 * weights[x]
                squares[x] += step * step
                weights[x] += 0.6 * step / math.sqrt(squares[x])
    return dict(weights)


def respelled(span: str, kind: int, chance: random.Random) -> str:
    if kind == 0:
        at, dot = chance.choice([(" at ", " dot "), (" (at) ", "."), (" [at] ", " dot ")])
        return span.replace("@", at).replace(".", dot)
    if kind == 1:
        return span.replace(".", chance.choice([" dot ", " . "]))
    digits = digits_of(span)
    if kind == 2:
        joint = chance.choice([".", " - "])
        return joint.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    shape = chance.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"])
    return shape.format(digits[-10:-7], digits[-7:-4], digits[-4:])


def matches(text: str):
    """(draw, kind, left, span, right) of the base matches with nothing known beside them.

    The draw is a hash of the rest, so that it does not depend on where a row is read.
    """
    for a, k, b in base_spans(text):
        left, right = text[max(0, a - 30) : a], text[b : b + 30]
        left, right = left[left.find(" ") + 1 :], right[: right.rfind(" ") + 1]
        if b - a <= LONGEST_MATCH and not base_spans(left) and not base_spans(right):
            own = f"{k}\0{left}\0{text[a:b]}\0{right}".encode("utf-8", "surrogatepass")
            draw = int.from_bytes(hashlib.blake2b(own, digest_size=7).digest())
            yield draw, k, left, text[a:b], right


def ordinary(text: str):
    """Windows around digits, at-signs and joining words without a base match, as ``matches`` gives those.

    Nor do they hold a match that was dropped for its digits: there may be
    personal data inside it.
    """
    base = base_spans(text)
    for a, b in _windows(text, _marks(text, base)):
        if b - a > LONGEST_WINDOW or PHONE.search(text, a, b):
            continue
        if any(len(digits_of(m[0])) >= 12 for m in CARD.finditer(text, a, b)):
            continue
        if not any(s < b and a < e for s, _, e in base):
            own = f"ordinary\0{text[a:b]}".encode("utf-8", "surrogatepass")
            draw = int.from_bytes(hashlib.blake2b(own, digest_size=7).digest())
            yield draw, len(KINDS), text[a:b], "", ""


def examples(found: list[tuple[int, str, str, str]]) -> list[tuple[str, list]]:
    """Windows of matches (kind, left, span, right), as they are and respelled, and ordinary ones.

    A kind beyond KINDS is that of the corpus' own ordinary windows.
    """
    chance, windows = random.Random(9), []
    for k, left, match, right in found:
        if k == len(KINDS):
            windows.append((left, []))
            continue
        for span in dict.fromkeys((match, respelled(match, k, chance))):
            windows.append((left + span + right, [(len(left), k, len(left) + len(span))]))
        number = str(chance.randrange(10 ** chance.randrange(1, 15)))
        large = " . ".join(str(chance.randrange(256, 3000)) for _ in range(4))
        clock = f"{number[:4]}-{number[4:6]}-{number[6:8]} at {number[8:10]}:{number[10:12]}"
        split = f"{number[:3]}.{number[3:6]}", f"at {number}", f"{number[:2]}-{number[2:6]}"
        plain = chance.choice([number, clock, large, large.replace(" ", ""), *split])
        windows.append((left + plain + right, []))
    return windows


def added_spans(text: str, base: list, weights: dict) -> list[tuple[int, int, int]]:
    """Segments of the windows around digits and at-signs that no base span covers."""
    found, at = [], 0
    for start, end in _windows(text, _marks(text, base)):
        while at < len(base) and base[at][2] <= start:
            at += 1
        near = base[at : bisect_left(base, (end,), at)]
        found += decode_run(text, start, end, near, weights)
    return found


def _marks(text: str, base: list):
    """Starts of what may belong to a span and lies in no base span."""
    at, reach = 0, -1
    for m in TRIGGER.finditer(text):
        while at < len(base) and base[at][0] <= m.start():
            reach = max(reach, base[at][2])
            at += 1
        if m.start() >= reach:
            yield m.start()


def _windows(text: str, marks):
    """Runs of whole words on either side of marks, joined where they meet."""
    start = end = None
    for mark in marks:
        if end is None or mark - ROOM > end:
            left, least = max(0, mark - ROOM), end or 0
            while left > least and not text[left - 1].isspace():
                left -= 1
            if end is None:
                start = left
            elif left > end:
                yield start, end
                start = left
        if end is None or mark + ROOM > end:
            blank = BLANK.search(text, min(mark + ROOM, len(text)))
            end = blank.start() if blank else len(text)
    if end is not None:
        yield start, end


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _lowest(batches):
    """Of every kind the MATCHES lowest draws of a task, and of ordinary windows the ORDINARY lowest."""
    most = [*[MATCHES] * len(KINDS), ORDINARY]
    kept: list[set] = [set() for _ in most]
    for batch in batches:
        for text in batch.column("text").to_pylist():
            own: list[set] = [set() for _ in most]
            for match in (*matches(text), *ordinary(text)):
                own[match[1]].add(match)
            for kind, some in enumerate(own):
                if some:
                    kept[kind] = set(heapq.nsmallest(most[kind], kept[kind].union(heapq.nsmallest(OWN_MATCHES, some))))
    rows = [m for some in kept for m in some]
    if rows:
        types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["draw", "kind", "left", "span", "right"]
        )


def trained(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Weights fitted on the windows of MATCHES known forms of each kind and ORDINARY others.

    All rows with a digit or at-sign are searched for them; those of the lowest
    hashes are taken, however rare a kind is, OWN_MATCHES of a document at most.
    A task passes on as many of a kind, and as many reach the driver. Without any
    match no span is ever added.
    """
    text = F.col(quoted(text_col)).cast("string").alias("text")
    most = F.when(F.col("kind") == len(KINDS), ORDINARY).otherwise(MATCHES)
    own = Window.partitionBy("kind").orderBy("draw", "left", "span", "right")
    rows = (
        docs.select(text)
        .where(F.col("text").rlike(HINT.pattern))
        .mapInArrow(_lowest, "draw long, kind int, left string, span string, right string")
        .distinct()
        .withColumn("place", F.row_number().over(own))
        .where((F.col("place") <= ORDINARY) & (F.col("place") <= most))
        .orderBy("draw", "kind")
        .collect()
    )
    if all(r["kind"] == len(KINDS) for r in rows):
        return {}
    return fit(examples([(r["kind"], r["left"], r["span"], r["right"]) for r in rows]))


def _find(weights: dict, keep: list[str]):
    def find(batches):
        for batch in batches:
            rows = []
            for text in batch.column("body").to_pylist():
                base = base_spans(text or "")
                extra = added_spans(text, base, weights) if text and weights else []
                counts = [sum(1 for s in base if s[1] == k) for k in range(len(KINDS))]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, digest, written([*base, *extra])))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))],
                    names=[*keep, *FOUND],
                )

    return find


FOUND = (*(f"n_{k}" for k in KINDS), "base_sha256", "spans")


def find_personal_data(
    docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all by default) with the counts, digest and spans of personal data.

    ``n_<kind>`` count the known forms, ``base_sha256`` is the digest of their
    spans, ``spans`` lists those and the added ones as kind:start:end in code
    points, by start and kind, the end exclusive. A null text is an empty one;
    repeated rows get the same spans; added spans never touch known ones.
    Columns of the input with one of these names are replaced. Texts are read
    whole, one document at a time. An empty table gives no rows.
    """
    keep = [c for c in (keep or docs.columns) if c not in FOUND]
    plain, columns = plainly(keep)
    schema = docs.select(columns).schema
    for name in FOUND:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")
    rows = docs.select(*columns, F.col(quoted(text_col)).cast("string").alias("body"))
    found = rows.mapInArrow(_find(trained(docs, text_col), plain), schema)
    return found.select(*renamed(plain, keep), *FOUND)
