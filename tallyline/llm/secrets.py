"""Secret scan: fixed patterns, and a battery of randomness tests for tokens that no pattern names. DataFrame functions only.

Patterns. ``assign`` is a name such as ``token`` with a value of six characters or more behind ``:`` or ``=``, ``access`` an access key id,
``hex`` 24 or more lower-case hexadecimal digits. Each gives its leftmost non-overlapping matches in the whole text.

Method. Every run of ``SHORTEST`` or more characters of ``[A-Za-z0-9+/_-]`` is a token. The first of ``ENCODINGS`` that has all its characters
is its encoding; a number in decimal digits, and a mix of characters of two encodings such as a path, has none and is not tested.
Three tests ask whether it could be drawn evenly from that alphabet:

* chi-squared of the characters' counts, standardized by its exact mean and variance (which a token shorter than the alphabet needs);
* runs of characters in the lower and the upper half of the alphabet (Wald and Wolfowitz);
* serial correlation of neighbouring characters' places in the alphabet.

The smallest of the three two-sided p values, corrected for being the smallest of three, is the token's own: a random token has any value
with equal probability, a word has a small one, the smaller the longer it is. Short tokens give the tests little to work with, so how
many words get through depends on length. False discoveries are therefore controlled per stratum of encoding and length, over the
different tokens of all documents: as many random tokens lie below a p value of 1/2 as above, so what a stratum has more between the limit
t and 1/2 than its upper half says is counted as false. The lowest limit of ``LIMITS`` at which ``false + 1`` is at most ``FALSE_SHARE`` of the tokens
at or above it is taken; a stratum without one reports nothing. The added one keeps strata of few tokens silent.

A reported token is a span of kind ``random`` unless it overlaps a span of a pattern. Pattern spans always stay.

Scale. One pass over the texts, a map, writes spans and tokens' p values to the shared folder. Only (stratum, 64-bit hash, p) of tokens is
shuffled, once per different token and task. The limits are one row per stratum, ``len(ENCODINGS) * len(LENGTHS)`` at most, and go back as a literal.
Start positions come from the lengths of what lies between matches, summed in blocks, so a text of m matches costs m times a constant;
whether a token overlaps an assignment is looked up span by span, the product of both numbers in one text.

Defined results: a null text has no spans. Ids may be null or repeated; each row is judged for itself, but copies of a token count once in the
statistics. Positions are code points, ends exclusive. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize

KINDS = ["assign", "access", "hex", "random"]


def either_case(name: str) -> str:
    """A pattern for the name with ASCII letters in either case, the same in every engine."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


# Names of secrets, the three patterns and their least lengths.
NAMES = ["password", "passwd", "secret", "token", "api_?key"]
ASSIGN = rf"""({"|".join(map(either_case, NAMES))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

SHORTEST = 20
TOKEN = rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Name, pattern of the whole token, alphabet. The first that fits is taken; letters are words, in any case, until they prove random.
ENCODINGS = [
    ("number", r"[0-9]+", None),
    ("hex", r"[0-9a-f]+", DIGITS + "abcdef"),
    ("upper_hex", r"[0-9A-F]+", DIGITS + "ABCDEF"),
    ("letters", r"[A-Z]?[a-z]+", LOWER),
    ("upper_letters", r"[A-Z]+", UPPER),
    ("base32", r"[A-Z2-7]+", UPPER + "234567"),
    ("base36", r"[0-9a-z]+", DIGITS + LOWER),
    ("upper_base36", r"[0-9A-Z]+", DIGITS + UPPER),
    ("base62", r"[0-9A-Za-z]+", UPPER + LOWER + DIGITS),
    ("base64", r"[0-9A-Za-z+/]+", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"[0-9A-Za-z_-]+", UPPER + LOWER + DIGITS + "-_"),
]
LENGTHS = [20, 24, 32, 48, 64, 96, 128, 256]
LIMITS = [0.001, 0.01, 0.05, 0.1, 0.2, 0.3]
FALSE_SHARE = 0.1

# The rational approximation of the complementary error function (absolute error below 1.5e-7).
ERFC_SCALE = 0.3275911
ERFC = [0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429]

SUM_BLOCK = 256
SPAN = "array<struct<start: bigint, stop: bigint, text: string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda s, x: s + x)


def sums_before(values: Column) -> Column:
    """For each number of an array, the sum of those before it. Blocks keep the work in proportion to the array's size."""

    def within(block: Column, offset: Column) -> Column:
        return F.transform(block, lambda _, i: offset + total(F.slice(block, F.lit(1), i)))

    def of_blocks(blocks: Column) -> Column:
        sums = F.transform(blocks, total)
        offsets = let(sums, lambda s: within(s, F.lit(0).cast("bigint")))
        return F.flatten(F.zip_with(blocks, offsets, within))

    def cut(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / SUM_BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(values, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))
        )

    return let(values, lambda v: let(cut(v), of_blocks))


def matches(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches with their positions. What ``split`` leaves between them has the lengths that are needed."""

    def placed(hits: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))

        def with_gaps(gaps: Column) -> Column:
            steps = F.transform(hits, lambda hit, i: F.get(gaps, i) + F.length(hit))
            return let(
                sums_before(steps),
                lambda before: F.transform(
                    hits,
                    lambda hit, i: F.struct(
                        (F.get(before, i) + F.get(gaps, i)).alias("start"),
                        (F.get(before, i) + F.get(gaps, i) + F.length(hit)).alias("stop"),
                        hit.alias("text"),
                    ),
                ),
            )

        return F.when(F.size(hits) > 0, let(gaps, with_gaps)).otherwise(F.array().cast(SPAN))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def assignments(text: Column) -> Column:
    """Matches of ``ASSIGN`` whose value is long enough."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))

    def long_enough(found: Column) -> Column:
        return let(values, lambda v: F.filter(found, lambda _, i: F.length(F.get(v, i)) >= LEAST_VALUE))

    return let(matches(text, ASSIGN), lambda found: F.when(F.size(found) > 0, long_enough(found)).otherwise(found))


def encoding(token: Column) -> Column:
    """Place in ``ENCODINGS``, or null for a token that is not tested."""
    out = F.lit(None).cast("int")
    for number, (_, pattern, alphabet) in reversed(list(enumerate(ENCODINGS))):
        out = F.when(token.rlike(f"^(?:{pattern})$"), F.lit(number if alphabet else None).cast("int")).otherwise(out)
    return out


def length_class(length: Column) -> Column:
    return sum(((length >= least).cast("int") for least in LENGTHS[1:]), F.lit(0))


def two_sided(z: Column) -> Column:
    """Probability of a standard normal value at least as far from 0."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERFC_SCALE) * x)
    series = F.lit(0.0)
    for factor in reversed(ERFC):
        series = (series + F.lit(factor)) * t
    return series * F.exp(-x * x)


def battery(codes: Column, size: Column) -> Column:
    """p value of a token with these places (from 1) in an alphabet of this size."""
    n = F.size(codes).cast("double")
    counts = F.transform(F.sequence(F.lit(1), size), lambda a: F.size(F.filter(codes, lambda c: c == a)).cast("bigint"))
    squares = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, k: s + k * k)
    chi = ((size * squares / n - n) - (size - 1)) / F.sqrt(2.0 * (size - 1) * (n - 1) / n)

    upper = F.size(F.filter(codes, lambda c: 2 * c > size)).cast("double")
    followed = F.slice(codes, F.lit(2), F.size(codes))
    changes = F.zip_with(followed, codes, lambda b, a: F.when((2 * a > size) != (2 * b > size), 1).otherwise(0))
    changes = F.aggregate(changes, F.lit(0), lambda s, x: s + x)
    product = 2.0 * upper * (n - upper)
    spread = product * (product - n) / (n * n * (n - 1))
    runs = F.when(spread > 0, (changes - product / n) / F.sqrt(spread))

    away = F.zip_with(followed, codes, lambda b, a: ((2 * a - size - 1) * (2 * b - size - 1)).cast("bigint"))
    away = F.slice(away, F.lit(1), F.size(codes) - 1)
    serial = total(away) * 3.0 / (size * size - 1.0) / F.sqrt(n - 1)

    furthest = F.greatest(F.abs(chi), F.abs(runs), F.abs(serial))
    smallest = two_sided(furthest)
    # A token in one half of its alphabet has no runs to test and is not random.
    return F.when(runs.isNull(), 0.0).otherwise(1.0 - F.pow(1.0 - smallest, F.lit(3.0)))


def tested(found: Column, assigned: Column) -> Column:
    """The tokens among the matches with stratum, p value, hash, and whether a pattern's span overlaps them."""
    alphabets = F.array(*(F.lit(alphabet or "") for _, _, alphabet in ENCODINGS))

    def test(span: Column) -> Column:
        token, number = span["text"], encoding(span["text"])

        def judged(number: Column) -> Column:
            alphabet = F.get(alphabets, number)
            plain = F.when(number == _number("letters"), F.lower(token)).otherwise(token)
            codes = F.transform(F.split(plain, "", -1), lambda c: F.position(c, alphabet))
            p = let(codes, lambda c: battery(c, F.length(alphabet)))
            overlapped = token.rlike(HEX) | token.rlike(ACCESS)
            overlapped = overlapped | F.exists(assigned, lambda a: (a["start"] < span["stop"]) & (span["start"] < a["stop"]))
            return F.struct(
                span["start"].alias("start"),
                span["stop"].alias("stop"),
                (number * len(LENGTHS) + length_class(F.length(token))).alias("stratum"),
                F.when(number.isNotNull(), p).alias("p"),
                F.xxhash64(token).alias("hash"),
                overlapped.alias("overlapped"),
            )

        return let(number, judged)

    return F.filter(F.transform(found, test), lambda t: t["stratum"].isNotNull())


def _number(name: str) -> int:
    return [n for n, _, _ in ENCODINGS].index(name)


def scan(docs: DataFrame) -> DataFrame:
    """Per row ``id, text``: the patterns' spans and the tested tokens. A map."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(
        "id",
        assignments(text).alias("assign"),
        matches(text, ACCESS).alias("access"),
        matches(text, HEX).alias("hex"),
        matches(text, TOKEN).alias("tokens"),
    )
    # Not merged with the next projection, which uses the columns several times.
    found = found.select("id", F.explode(F.array(F.struct("assign", "access", "hex", "tokens"))).alias("m"))

    def bare(kind: str) -> Column:
        return F.transform(f"m.{kind}", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))).alias(kind)

    return found.select("id", *map(bare, KINDS[:3]), tested(F.col("m.tokens"), F.col("m.assign")).alias("tokens"))


def limits(tokens: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """The lowest p value at which each ``stratum`` reports, from rows ``stratum, hash, p``; strata that report nothing are absent."""
    once = tokens.groupBy("stratum", "hash").agg(F.first("p").alias("p"))
    upper = F.count_if(F.col("p") >= 0.5).alias("upper")
    above = [F.count_if(F.col("p") >= t).alias(f"above_{k}") for k, t in enumerate(LIMITS)]
    counted = once.groupBy("stratum").agg(upper, *above)
    choices = []
    for k, t in enumerate(LIMITS):
        between = F.col(f"above_{k}") - F.col("upper")
        false = F.greatest(between - F.col("upper") * (0.5 - t) / 0.5, F.lit(0.0))
        choices.append(F.when(false + 1 <= false_share * F.col(f"above_{k}"), t))
    return counted.select("stratum", F.coalesce(*choices).alias("limit")).where("limit is not null")


def find_secrets(docs: DataFrame, false_share: float = FALSE_SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``spans``, an array of ``start, place, stop, kind`` by start, then kind as in ``KINDS``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = materialize(scan(rows), "secret-scan")
    tokens = found.select(F.explode("tokens").alias("t")).select("t.stratum", "t.hash", "t.p")
    chosen = {row["stratum"]: row["limit"] for row in limits(tokens, false_share).collect()}  # a row per stratum at most
    table = F.create_map(*(F.lit(v) for pair in sorted(chosen.items()) for v in pair)) if chosen else None

    def spans(kind: str, of: Column) -> Column:
        place = KINDS.index(kind)
        return F.transform(
            of,
            lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), s["stop"].alias("stop"), F.lit(kind).alias("kind")),
        )

    parts = [spans(kind, F.col(kind)) for kind in KINDS[:3]]
    if table is not None:
        random = F.filter("tokens", lambda t: ~t["overlapped"] & (t["p"] >= F.try_element_at(table, t["stratum"])))
        parts.append(spans("random", random))
    return found.select(F.col("id").alias(id_col), F.array_sort(F.concat(*parts)).alias("spans"))
