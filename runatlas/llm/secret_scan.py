"""Secret scans with column functions only.

Three base patterns give spans of assignments, access keys and long hexadecimal runs. Besides, every
token of 16 or more characters of a known encoding (hexadecimal, base32, base62, base64) goes through a
randomness battery: chi-squared uniformity of its alphabet (with the statistic's exact mean, variance and
skewness, as short tokens need), Wald-Wolfowitz runs about the alphabet's middle, and serial correlation
at lag one. The three p-values (small: not random) are joined by the Cauchy combination.

Errors are controlled on both sides, by the Benjamini-Hochberg procedure, apart for each encoding and length class
over the tokens of all documents:

* a token is cleared as not random by its battery; of the tokens cleared in a class, the expected part of truly
  random ones is at most ``CLEARED_WRONGLY``;
* a token is reported only where it is not written text either. Chains of neighbouring characters, learned from the
  shorter words of all documents, give its likelihood as written text; over that of a random token this is an upper
  bound of its p-value (by Markov's inequality), at every length. Of the tokens so rejected in a class, the expected
  part of written ones is at most ``REPORTED_WRONGLY``.

Tokens that are not cleared, are rejected as written, and overlap no base span are added with the kind ``random``.
p-values are counted in fixed bins, so the thresholds come from a table of fixed size.

Positions are code points, ends exclusive: characters beyond the basic plane are first replaced by one of
it, as Java would count them twice.

Cases: null and empty text have no span. One row in, one row out; ids and other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runatlas.llm.scratch import Scratch, plain_columns

# Fixed patterns. A match that fails its minimal length is dropped after matching, not matched otherwise.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
# What a text must hold to have a match at all: cheaper than marking every match.
MAY_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
MAY_ACCESS = r"AKIA[A-Z0-9]{12}"
LONG_HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+={0,2}"

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings: pattern of the token without padding, alphabet in value order. The first that fits is taken.
ENCODINGS = {
    "hex": ("[0-9a-f]+|[0-9A-F]+", DIGITS + "abcdef"),
    "base32": ("[A-Z2-7]+", UPPER + "234567"),
    "base62": ("[A-Za-z0-9]+", UPPER + LOWER + DIGITS),
    "base64": ("[A-Za-z0-9+/_-]+", UPPER + LOWER + DIGITS + "+/"),
}
CLEARED_WRONGLY = 0.01
REPORTED_WRONGLY = 0.01
BINS_PER_DECADE, LAST_BIN = 10, 300

SYMBOLS = UPPER + LOWER + DIGITS + "+/_-"
#: Words that teach how written text looks: too short to be tested themselves.
WORD = r"[^A-Za-z0-9+/_-]+"
WORD_LENGTHS = (3, 15)
#: Learned beside the corpus, so that one without words still knows written text from random.
PRIOR = (
    "the account name value request response record number section server client service update message "
    "configuration version reference default handler and for with from this that session connection builder"
)
ANY_SHAPE = 0.2  # part of a step's probability that is spread evenly over upper, lower, digit and other
ANY_LETTER = 0.2  # and over the characters of its shape
LOT = 512  # items of a running sum that are appended to before they are joined to the rest
_OPEN, _CLOSE = "\u0001", "\u0002"


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once: column functions work out an operand wherever it stands."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _plain(text: Column) -> Column:
    """The text with one UTF-16 unit per code point and without the marks, at equal positions."""
    text = F.coalesce(text, F.lit(""))
    wide = r"[\x{10000}-\x{10FFFF}]"
    text = F.when(text.rlike(wide), F.regexp_replace(text, wide, "�")).otherwise(text)
    marked = text.contains(_OPEN) | text.contains(_CLOSE)  # far cheaper than translating character by character
    return F.when(marked, F.translate(text, _OPEN + _CLOSE, "\u0003\u0003")).otherwise(text)


def _placed(parts: Column) -> Column:
    """``array<struct<start, end, value>>`` of strings that follow each other.

    Lists grow by lots: appending each string to one list would copy it every time.
    """
    spans = "array<struct<start:int,end:int,value:string>>"

    def one(seen: Column, part: Column) -> Column:
        end = seen["at"] + F.length(part)
        span = F.struct(seen["at"].alias("start"), end.alias("end"), part.alias("value"))
        return F.struct(end.alias("at"), F.concat(seen["found"], F.array(span)).alias("found"))

    def lot(seen: Column, some: Column) -> Column:
        inner = F.aggregate(some, F.struct(seen["at"].alias("at"), F.array().cast(spans).alias("found")), one)
        joined = F.transform(
            F.array(inner), lambda r: F.struct(r["at"].alias("at"), F.concat(seen["lots"], F.array(r["found"])).alias("lots"))
        )
        return F.element_at(joined, 1)

    def placed(all_parts: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(all_parts), F.lit(LOT))
        lots = F.transform(firsts, lambda i: F.slice(all_parts, i, F.lit(LOT)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spans}>").alias("lots"))
        return F.aggregate(lots, start, lot, lambda seen: F.flatten(seen["lots"]))

    return F.element_at(F.transform(F.array(parts), placed), 1)


def matches(text: Column, may: str, pattern: str) -> Column:
    """``array<struct<start, end, value>>`` of the leftmost non-overlapping matches; ``text`` is plain."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    parts = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]", -1)
    # Every second part is a match.
    found = F.filter(_placed(parts), lambda m, i: i % 2 == 1)
    return F.when(text.rlike(may), found).otherwise(none)


def base_spans(text: Column) -> Column:
    """``array<struct<start, kind, end>>`` of the base patterns; ``kind`` is a number, in the order listed."""

    def of(kind: int, found: Column) -> Column:
        return F.transform(
            found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
        )

    assign = F.filter(matches(text, MAY_ASSIGN, ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= 8)
    access = F.filter(matches(text, MAY_ACCESS, ACCESS), lambda m: m["end"] - m["start"] >= 16)
    hexes = F.filter(matches(text, LONG_HEX, LONG_HEX), lambda m: m["end"] - m["start"] >= 32)
    return F.array_sort(F.concat(of(0, assign), of(1, access), of(2, hexes)))


def _upper_normal(z: Column) -> Column:
    """P(Z > z) by the rational approximation of Zelen and Severo (coefficients fixed), error under 1e-7."""

    def above(z: Column) -> Column:
        x = F.abs(z)

        def tail(t: Column) -> Column:
            return F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * (
                t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
            )

        return _with(_with(1 / (1 + 0.2316419 * x), tail), lambda p: F.when(z >= 0, p).otherwise(1 - p))

    return _with(z, above)


def _p_uniform(value: Column, n: Column, size: Column) -> Column:
    """Chi-squared test of equal use of the alphabet's characters.

    The statistic goes with the number of pairs of equal characters, whose first three moments are known for every
    length; a gamma distribution with these moments stands for it (Wilson-Hilferty approximation).
    """
    kinds = F.array_distinct(F.split(value, "", -1))
    count = F.transform(kinds, lambda c: (n - F.length(F.replace(value, c, F.lit("")))).cast("double"))
    squares = F.aggregate(count, F.lit(0.0), lambda a, c: a + c * c)
    pairs, chance = n * (n - 1) / 2, 1 / size
    triples = n * (n - 1) * (n - 2) * (chance * chance - chance * chance * chance)

    def upper(variance: Column) -> Column:
        skew = (variance * (1 - 2 * chance) + triples) / F.pow(variance, F.lit(1.5))
        z = ((squares - n) / 2 - F.lit(0.5) - pairs * chance) / F.sqrt(variance)

        def transformed(df: Column) -> Column:
            spread = 2 / (9 * df)
            ratio = F.greatest(1 + z * F.sqrt(2 / df), F.lit(1e-9))
            return _with(spread, lambda s: _upper_normal((F.pow(ratio, F.lit(1 / 3)) - (1 - s)) / F.sqrt(s)))

        return _with(_with(skew, lambda s: 8 / (s * s)), transformed)

    return _with(pairs * chance * (1 - chance), upper)


def _p_runs(values: Column, n: Column, size: Column) -> Column:
    """Runs above and below the alphabet's middle, two-sided."""

    def tested(high: Column) -> Column:
        turns = F.aggregate(
            F.zip_with(F.slice(high, F.lit(1), n - 1), F.slice(high, F.lit(2), n - 1), lambda a, b: F.abs(a - b)),
            F.lit(0),
            lambda a, v: a + v,
        )

        def of(mean: Column) -> Column:
            def judged(spread: Column) -> Column:
                z = (turns + 1 - mean) / F.sqrt(spread)
                return F.when(spread > 0, 2 * _upper_normal(F.abs(z))).otherwise(F.lit(0.0))

            return _with((mean - 1) * (mean - 2) / (n - 1), judged)

        above = F.aggregate(high, F.lit(0), lambda a, v: a + v).cast("double")
        return _with(_with(above, lambda a: 2 * a * (n - a) / n + 1), of)

    return _with(F.transform(values, lambda v: (v >= size / 2).cast("int")), tested)


def _p_serial(values: Column, n: Column) -> Column:
    """Correlation of neighbouring values, two-sided."""

    def tested(centred: Column) -> Column:
        both = F.zip_with(F.slice(centred, F.lit(1), n - 1), F.slice(centred, F.lit(2), n - 1), lambda a, b: a * b)

        def judged(spread: Column) -> Column:
            z = (F.aggregate(both, F.lit(0.0), lambda a, v: a + v) / spread + 1 / n) * F.sqrt(n)
            return F.when(spread > 0, 2 * _upper_normal(F.abs(z))).otherwise(F.lit(0.0))

        return _with(F.aggregate(centred, F.lit(0.0), lambda a, v: a + v * v), judged)

    mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n
    return _with(_with(mean, lambda m: F.transform(values, lambda v: v - m)), tested)


def written_table(docs: DataFrame) -> list[float]:
    """Logarithms of the chances that a character of ``SYMBOLS`` follows another (or the start) in written text.

    Counted over the words of all ``plain`` texts: distinct words first, then their neighbouring characters. A word that
    stands n times weighs 1 + ln(n), so that repeated texts do not make all else look unwritten.
    A step's chance is that of its shape (upper, lower, digit, other) times that of its character, whatever its case.
    """
    low, high = WORD_LENGTHS
    words = docs.select(F.explode(F.split("plain", WORD, -1)).alias("word"))
    words = words.filter(F.length("word").between(low, high)).groupBy("word").agg(F.count("*").alias("n"))
    steps = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(F.concat(F.lit("^"), "word"), i, F.lit(2)))
    counted = words.select(F.explode(steps).alias("step"), "n").groupBy("step").agg(F.sum(1 + F.log("n")).alias("n")).collect()  # of fixed size
    seen = {r["step"]: r["n"] for r in counted}
    for word in PRIOR.split():
        for step in zip("^" + word, word, strict=False):
            seen["".join(step)] = seen.get("".join(step), 0) + 1

    def shape(c: str) -> str:
        return next((name for name, some in (("U", UPPER), ("L", LOWER), ("D", DIGITS)) if c in some), "^" if c == "^" else "S")

    family = {"U": LOWER, "L": LOWER, "D": DIGITS, "S": "+/_-"}
    shapes: dict[str, dict[str, float]] = {a: dict.fromkeys("ULDS", 1) for a in "^ULDS"}
    follow: dict[tuple[str, str], float] = {}
    for (a, b), n in seen.items():
        shapes[shape(a)][shape(b)] += n
        follow[a.lower(), b.lower()] = follow.get((a.lower(), b.lower()), 0) + n

    def log_chance(a: str, b: str) -> float:
        turn = shapes[shape(a)]
        some = family[shape(b)]
        a, b, to = a.lower(), b.lower(), shape(b)
        within = (follow.get((a, b), 0) + 1) / sum(follow.get((a, c), 0) + 1 for c in some)
        within = (1 - ANY_LETTER) * within + ANY_LETTER / len(some)
        return math.log(((1 - ANY_SHAPE) * turn[to] / sum(turn.values()) + ANY_SHAPE / 4) * within)

    return [log_chance(a, b) if b != "^" else 0.0 for a in "^" + SYMBOLS for b in "^" + SYMBOLS]


def candidates(text: Column, table: list[float]) -> Column:
    """Tokens of a known encoding, ``array<struct<start, end, class, p, w>>``.

    ``p`` is the battery's p-value (small: not random), ``w`` the negative logarithm, base 10, of that of written text.
    """
    chances = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")  # folded to a constant
    width = len(SYMBOLS) + 1
    bare = F.transform(
        matches(text, TOKEN, TOKEN),
        lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.rtrim(m["value"], F.lit("=")).alias("raw")),
    )

    def tested(m: Column) -> Column:
        encoding = F.lit(None)
        for name, (pattern, _) in reversed(ENCODINGS.items()):
            encoding = F.when(m["raw"].rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(encoding)
        return _with(encoding, lambda name: laid_out(m, name))

    def laid_out(m: Column, encoding: Column) -> Column:
        alphabet, size = F.lit(None), F.lit(None)
        for name, (_, letters) in ENCODINGS.items():
            alphabet = F.when(encoding == name, F.lit(letters)).otherwise(alphabet)
            size = F.when(encoding == name, F.lit(float(len(letters)))).otherwise(size)
        url = F.translate(m["raw"], "-_", "+/")
        value = F.when(encoding == "hex", F.lower(m["raw"])).otherwise(url)
        return F.struct(m["start"], m["end"], encoding.alias("encoding"), alphabet.alias("alphabet"), size.alias("size"), m["raw"], value.alias("value"), F.length(value).alias("n"))

    def step(seen: Column, c: Column) -> Column:
        at = F.instr(F.lit(SYMBOLS), c)
        return F.struct(at.alias("last"), (seen["log"] + F.get(chances, seen["last"] * width + at)).alias("log"))

    def battery(m: Column, values: Column) -> Column:
        n, size = m["n"], m["size"]
        ps = (_p_uniform(m["value"], n, size), _p_runs(values, n, size), _p_serial(values, n))
        # A p-value of one, which the few steps of a short token make likely, must not outweigh the other two.
        bounded = [F.least(F.greatest(p, F.lit(1e-15)), F.lit(0.99)) for p in ps]
        return sum((F.tan((0.5 - p) * math.pi) for p in bounded), F.lit(0.0)) / len(bounded)

    def judged(m: Column) -> Column:
        n, size = m["n"], m["size"]
        values = F.transform(F.split(m["value"], "", -1), lambda c: (F.instr(m["alphabet"], c) - 1).cast("double"))
        cauchy = _with(values, lambda v: battery(m, v))
        start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("log"))
        written = F.aggregate(F.split(m["raw"], "", -1), start, step, lambda seen: seen["log"])
        length_class = F.floor(F.log2(n.cast("double")) * 2).cast("int")
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.concat_ws(":", m["encoding"], F.least(length_class, F.lit(24))).alias("class"),
            (0.5 - F.atan(cauchy) / math.pi).alias("p"),
            (-(written + n * F.log(size)) / math.log(10)).alias("w"),
        )

    return F.transform(F.transform(bare, tested), judged)


def _bin(tens: Column) -> Column:
    """The bin of a negative logarithm, base 10, of a p-value."""
    return F.floor(F.least(F.greatest(tens, F.lit(0.0)) * BINS_PER_DECADE, F.lit(LAST_BIN))).cast("int")


def _rejecting_bin(bins: dict[int, int], level: float) -> int:
    """The lowest bin that Benjamini-Hochberg rejects; beyond the last where none is."""
    total, below, least = sum(bins.values()), 0, LAST_BIN + 1
    for number in sorted(bins, reverse=True):
        below += bins[number]
        if 10 ** (-number / BINS_PER_DECADE) <= below * level / total:  # no p of the bin is above this
            least = number
    return least


def thresholds(rows: DataFrame) -> dict[str, tuple[int, int]]:
    """Per class the bins of p-values from which tokens are cleared as not random, and rejected as written."""
    one = rows.select(F.explode("candidates").alias("c"))
    both = F.array(_bin(-F.log10("c.p")), _bin(F.col("c.w")))
    one = one.select(F.col("c.class").alias("class"), F.posexplode(both).alias("side", "bin"))
    counted = one.groupBy("class", "side", "bin").agg(F.count("*").alias("n")).collect()  # of fixed size
    sides: dict[str, tuple[dict, dict]] = {}
    for r in counted:
        sides.setdefault(r["class"], ({}, {}))[r["side"]][r["bin"]] = r["n"]
    return {name: (_rejecting_bin(p, CLEARED_WRONGLY), _rejecting_bin(w, REPORTED_WRONGLY)) for name, (p, w) in sides.items()}


def all_spans(base: Column, found: Column, limits: dict[str, tuple[int, int]]) -> Column:
    """Base spans and those of tokens that are neither cleared nor written and overlap no base span."""
    if not limits:
        return base
    cleared, rejected = (F.create_map(*[F.lit(x) for k, v in sorted(limits.items()) for x in (k, v[i])]) for i in (0, 1))
    random = F.filter(
        found,
        lambda c: (_bin(-F.log10(c["p"])) < F.element_at(cleared, c["class"]))
        & (_bin(c["w"]) >= F.element_at(rejected, c["class"]))
        & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    more = F.transform(random, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return F.array_sort(F.concat(base, more))


def written(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def _found(docs: DataFrame) -> DataFrame:
    plain = docs.withColumn("plain", _plain(F.col("text")))
    table = written_table(plain)
    return plain.withColumn("base", base_spans(F.col("plain"))).withColumn("candidates", candidates(F.col("plain"), table))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: ``doc_id``, counts of base spans, digest of the base spans, all spans written out."""
    scratch = Scratch(docs.sparkSession, "secrets")
    docs = plain_columns(docs, doc_id=id_column, text=text_column)
    rows = scratch.save(_found(docs).select("doc_id", "base", "candidates"), "found")
    spans = all_spans(F.col("base"), F.col("candidates"), thresholds(rows))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return rows.select(
        "doc_id", count(0), count(1), count(2), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(spans).alias("spans")
    )


def redact(docs: DataFrame, text_column: str = "text", mask: str = "<secret>") -> DataFrame:
    """The rows of ``docs`` with every span of the text replaced by ``mask``; all other columns as they are.

    Rows are written once, with what was found in them, and masked as they are read again.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    rows = docs.select(docs[f"`{text_column}`"].alias("text"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = scratch.save(_found(rows).select("row", "base", "candidates"), "found")
    rows = rows.select("row", all_spans(F.col("base"), F.col("candidates"), thresholds(rows)).alias("spans"))
    text = F.col("row")[text_column]
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(seen: Column, span: Column) -> Column:
        # A span that begins inside the one before only carries it on.
        fresh = span["start"] >= seen["at"]
        gap = F.substring(text, seen["at"] + 1, span["start"] - seen["at"])
        return F.struct(
            F.greatest(seen["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(seen["out"], F.array(gap, F.lit(mask)))).otherwise(seen["out"]).alias("out"),
        )

    def finish(seen: Column) -> Column:
        return F.concat(F.array_join(seen["out"], ""), F.substring(text, seen["at"] + 1, F.length(text)))

    masked = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, finish)).otherwise(text)
    return rows.select(*[masked.alias(c) if c == text_column else F.col("row")[c].alias(c) for c in docs.columns])
