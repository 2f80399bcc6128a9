"""Secret scan: known forms, and tokens that pass a battery of randomness tests.

The known forms are regular expressions. Beyond them, every long token of letters,
digits and the signs of base 64 is read as a number of the smallest alphabet that
holds it (digits, letters of one or both cases, hexadecimal, base 32, base 36, base
64) and tested for being drawn from it at random: chi-squared tests of the symbols
and of their classes, a runs test above and below the middle, and the serial
correlation. Classes of letters are those that words use much, less and rarely, and
for letters the runs of vowels and consonants are tested too; for digits, which have no
classes, the steps from each to the next. The hypothesis of each token is
that it is random, that is a secret; the Benjamini-Hochberg rule over all tokens
of a length class bounds the share of true secrets among those that are thrown
out, so a corpus with very many ordinary tokens of one length keeps the level
for that length. What is not thrown out is a secret.

Everything is built from SQL functions. Positions come from the lengths of the
matches and of the text between them.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The known forms.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGNED = 6
# Tokens that are tested. Shorter ones would hardly ever be thrown out.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
LEVEL = 0.05
# Symbols of the alphabets in the order of their numbers.
HEX_SYMBOLS = "0123456789abcdef"
BASE32_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36_SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyz"
DIGITS, LETTERS = BASE36_SYMBOLS[:10], BASE36_SYMBOLS[10:]
BOTH_CASES = LETTERS.upper() + LETTERS
BASE64_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# Classes: kinds of symbols, and for letters alone how much European languages use them.
KIND_CLASSES = ("[^0-9]", "[^a-z]", "[^A-Z]", "[^+/]")
USE_CLASSES = ("(?i)[^eainrtoslh]", "(?i)[^cdfgmpub]", "(?i)[^jkqvwxyz]")
VOWELS = "aeiouAEIOU"
# p-values are counted by their logarithm, this many steps per factor of ten.
STEPS, LAST = 20, 400

_SPANS = "array<struct<start:int,`end`:int,hit:string,part:string>>"


def spans(text: Column, pattern: str, part: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, end, hit, part) in code points."""
    found = F.arrays_zip(
        F.split(text, pattern).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), part).alias("part"),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state, x):
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"], x["part"])
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    matched = F.filter(found, lambda x: x["hit"].isNotNull())
    return F.when(
        text.rlike(pattern), F.aggregate(matched, begin, step, lambda s: s["spans"])
    ).otherwise(F.array().cast(_SPANS))


def _kind(found: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("kind"), x["end"].alias("end"))
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def upper_tail(z: Column) -> Column:
    """Chance that a standard normal variable exceeds z (a polynomial good to seven places)."""

    def tail(v, t):
        # Coefficients of the approximation.
        poly = F.lit(0.0)
        for c in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
            poly = (poly + c) * t
        return F.exp(-v * v / 2) / 2.5066282746310002 * poly

    def signed(v):
        return let(1 / (1 + 0.2316419 * F.abs(v)), lambda t: F.when(v >= 0, tail(v, t)).otherwise(1 - tail(v, t)))

    return let(z, signed)


def _chi_squared(cells: Column) -> Column:
    """p-value of (count, expected) cells by the cube-root approximation; 1 for a single cell."""

    def p_value(used):
        df = F.size(used) - 1.0
        terms = F.transform(used, lambda c: (c["count"] - c["even"]) * (c["count"] - c["even"]) / c["even"])
        x = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
        z = (F.pow(x / df, F.lit(1 / 3)) - 1 + 2 / (9 * df)) / F.sqrt(2 / (9 * df))
        return F.when(F.size(used) > 1, upper_tail(z)).otherwise(F.lit(1.0))

    return let(F.filter(cells, lambda c: c["even"] > 0), p_value)


def randomness(token: Column) -> Column:
    """p-value of the hypothesis that the token's symbols are drawn at random.

    Four tests, so the smallest of their p-values counts four times. For letters
    the test of the classes is joined with that of the vowels by the product of
    their p-values (Fisher); for digits that of the steps takes its place.
    """

    def read(plain):
        digits = plain.rlike("^[0-9]+$")
        letters = plain.rlike("^[A-Za-z]+$")
        # A capital at the start is that of a word, not of an alphabet of both cases.
        one_case = plain.rlike("^([A-Z]?[a-z]+|[A-Z]+)$")
        hexadecimal = plain.rlike("^([0-9a-f]+|[0-9A-F]+)$")
        base32 = plain.rlike("^[A-Z2-7]+$")
        base36 = plain.rlike("^([0-9a-z]+|[0-9A-Z]+)$")
        lowered = one_case | hexadecimal | base36 & ~base32
        return F.struct(
            F.when(lowered, F.lower(plain)).otherwise(plain).alias("text"),
            F.when(digits, DIGITS)
            .when(one_case, LETTERS)
            .when(letters, BOTH_CASES)
            .when(hexadecimal, HEX_SYMBOLS)
            .when(base32, BASE32_SYMBOLS)
            .when(base36, BASE36_SYMBOLS)
            .otherwise(BASE64_SYMBOLS)
            .alias("symbols"),
            letters.alias("letters"),
        )

    form = let(F.translate(token, "-_", "+/"), read)
    return let(form, lambda f: _battery(f["text"], f["symbols"], f["letters"]))


def _battery(text: Column, symbols: Column, letters: Column) -> Column:
    n, size = F.length(text).cast("double"), F.length(symbols).cast("double")

    def symbol_cell(s):
        count = F.length(text) - F.length(F.replace(text, s, F.lit("")))
        return F.struct(count.cast("double").alias("count"), (n / size).alias("even"))

    def class_cell(others):
        count = F.length(F.regexp_replace(text, others, F.lit("")))
        share = F.length(F.regexp_replace(symbols, others, F.lit(""))) / size
        return F.struct(count.cast("double").alias("count"), (n * share).alias("even"))

    uniform = _chi_squared(F.transform(F.split(symbols, ""), symbol_cell))
    kinds, uses = (
        F.array(*[F.lit(c) for c in classes]) for classes in (KIND_CLASSES, USE_CLASSES)
    )
    by_class = _chi_squared(F.transform(F.when(letters, uses).otherwise(kinds), class_cell))

    # Numbers of the symbols, centred, and the products of neighbours.
    rest = F.length(text) - 1
    value = F.transform(F.split(text, ""), lambda c: F.instr(symbols, c) - (size + 1) / 2)
    products = let(
        value, lambda v: F.zip_with(F.slice(v, 1, rest), F.slice(v, 2, rest), lambda a, b: a * b)
    )

    def neighbours(ps):
        changes = F.size(F.filter(ps, lambda x: x < 0))
        runs = 2 * upper_tail(F.abs(changes - (n - 1) / 2) / F.sqrt((n - 1) / 4))
        serial = F.aggregate(ps, F.lit(0.0), lambda s, x: s + x) / ((size * size - 1) / 12)
        return F.least(runs, 2 * upper_tail(F.abs(serial) / F.sqrt(n - 1)))

    # Neighbours of which one is a vowel: their number's mean and variance for random letters.
    vowel = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(VOWELS), c) > 0)
    share = (len(VOWELS) / 52) * (1 - len(VOWELS) / 52)
    mean, variance = 2 * share * (n - 1), 2 * share * ((n - 1) * (1 - 2 * share) + (n - 2) * (1 - 4 * share))
    changes = let(
        vowel,
        lambda v: F.size(F.filter(F.zip_with(F.slice(v, 1, rest), F.slice(v, 2, rest), lambda a, b: a != b), lambda x: x)),
    )
    syllables = 2 * upper_tail(F.abs(changes - mean) / F.sqrt(variance))

    # Digits are one class; tested instead are the steps from each to the next, around the end.
    place = F.transform(F.split(text, ""), lambda c: F.instr(symbols, c))
    turns = let(
        place, lambda v: F.zip_with(F.slice(v, 1, rest), F.slice(v, 2, rest), lambda a, b: F.pmod(b - a, F.lit(len(DIGITS))))
    )

    def step_cells(found):
        def cell(s):
            count = F.size(F.filter(found, lambda x: x == s)).cast("double")
            return F.struct(count.alias("count"), ((n - 1) / len(DIGITS)).alias("even"))

        return F.transform(F.sequence(F.lit(0), F.lit(len(DIGITS) - 1)), cell)

    by_step = let(turns, lambda found: _chi_squared(step_cells(found)))

    joined = let(F.greatest(by_class * syllables, F.lit(1e-300)), lambda x: x * (1 - F.log(x)))
    kinds_p = F.when(letters, joined).when(symbols == DIGITS, by_step).otherwise(by_class)
    return F.least(F.lit(1.0), 4 * F.least(uniform, kinds_p, let(products, neighbours)))


def scan(docs: DataFrame, text_col: str = "text", found_col: str = "found") -> DataFrame:
    """``docs`` with a column of (start, kind, end) of known forms and tested tokens.

    ``found_col`` is a struct: ``base`` holds the spans of the known forms in
    order of start and kind; ``tokens`` those of the tested tokens outside them,
    with ``p`` and the length class. A null text has none.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    assign = F.filter(spans(text, ASSIGN, 2), lambda x: F.length(x["part"]) >= ASSIGNED)
    base = F.array_sort(
        F.concat(
            _kind(assign, "assign"), _kind(spans(text, ACCESS), "access"), _kind(spans(text, HEX), "hex")
        )
    )
    # Exploding one element keeps the matching from being repeated wherever it is used.
    rows = docs.withColumn(
        found_col, F.explode(F.array(F.struct(base.alias("base"), spans(text, TOKEN).alias("tokens"))))
    )

    def tested(known, tokens):
        outside = F.filter(
            tokens,
            lambda t: ~F.exists(known, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
        )
        p = lambda t: F.greatest(randomness(t["hit"]), F.lit(1e-300))
        return F.transform(
            outside,
            lambda t: F.struct(
                t["start"].alias("start"), t["end"].alias("end"),
                F.floor(F.log2(F.length(t["hit"]))).cast("int").alias("stratum"),
                F.least(F.lit(LAST), F.floor(-F.log10(p(t)) * STEPS)).cast("int").alias("step"),
            ),
        )

    found = F.col(found_col)
    return rows.withColumn(
        found_col, F.struct(found["base"].alias("base"), tested(found["base"], found["tokens"]).alias("tokens"))
    )


def thrown_out(scanned: DataFrame, found_col: str = "found", level: float = LEVEL) -> DataFrame:
    """Per length class, the first p-value step (``limit``) that is thrown out.

    Benjamini-Hochberg over all tokens: of the steps whose upper end is at most
    level * (tokens from there on) / (all tokens), the least extreme one.
    """
    steps = (
        scanned.select(F.explode(F.col(found_col)["tokens"]).alias("t"))
        .groupBy("t.stratum", "t.step")
        .agg(F.count("*").alias("n"))
    )
    all_of = Window.partitionBy("stratum")
    beyond = all_of.orderBy(F.desc("step"))
    upper = F.pow(F.lit(10.0), -F.col("step") / float(STEPS))
    return (
        steps.withColumn("all", F.sum("n").over(all_of))
        .withColumn("beyond", F.sum("n").over(beyond))
        .where(upper <= level * F.col("beyond") / F.col("all"))
        .groupBy("stratum")
        .agg(F.min("step").alias("limit"))
    )


def find_secrets(
    docs: DataFrame, *, text_col: str = "text", found_col: str = "found", level: float = LEVEL
) -> DataFrame:
    """``docs`` with ``found_col``: struct of ``base`` and ``spans``, arrays of (start, kind, end).

    ``kind`` is a place in KINDS, positions are code points, the end is
    exclusive. ``base`` are the known forms exactly, ``spans`` those and the
    random tokens, in order of start and kind. Null and empty texts have no
    spans; repeated rows get the same ones. An existing column ``found_col`` is
    replaced. The corpus is read twice: once to count the p-values of all
    tokens, once to decide.
    """
    tokens = scan(docs.select(text_col), text_col, found_col)
    # At most one limit per power of two of a token's length.
    limits = thrown_out(tokens, found_col, level).collect()
    return _decided(scan(docs, text_col, found_col), found_col, {r[0]: r[1] for r in limits})


def _decided(scanned: DataFrame, found_col: str, by_length: dict[int, int]) -> DataFrame:
    def is_random(t):
        limit = F.lit(LAST + 1)
        for stratum, step in by_length.items():
            limit = F.when(t["stratum"] == stratum, step).otherwise(limit)
        return t["step"] < limit

    found = F.col(found_col)
    random = _kind(F.filter(found["tokens"], is_random), "random")
    return scanned.withColumn(
        found_col,
        F.struct(found["base"].alias("base"), F.array_sort(F.concat(found["base"], random)).alias("spans")),
    )


def of_kind(found: Column, kind: str) -> Column:
    return F.filter(found, lambda x: x["kind"] == KINDS.index(kind))


def written(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or group of overlapping spans, replaced by ``mark``."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s, x):
        gap = F.substring(text, s["at"] + 1, x["start"] - s["at"])
        return F.when(
            x["start"] >= s["at"],
            F.struct(x["end"].alias("at"), F.concat(s["out"], gap, F.lit(mark)).alias("out")),
        ).otherwise(F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out")))

    return F.when(
        F.size(found) > 0,
        F.aggregate(
            found, begin, step,
            lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
        ),
    ).otherwise(text)
