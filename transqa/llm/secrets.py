"""Secrets in texts: fixed patterns, and tokens that look random.

The patterns find assignments, access keys and long hexadecimal runs. Beyond them, every
long token of an encoding's alphabet (hexadecimal, base 32, base 64, letters or digits,
inferred from its characters) takes a battery of tests: uniformity of its characters
(chi-squared), runs above and below the middle of the alphabet, and serial correlation. A
token is reported when none of the three rejects randomness and when ordinary writing of its
length, whose characters are uneven, would so seldom be this even that
the Benjamini-Hochberg procedure, within its encoding and length class, keeps the share of
false reports below ``FALSE_SHARE``. Short tokens thus need more, and get it from nothing but
their length. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.llm.common import let, read, stored

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
#: Alphabet, and how much more often two characters of ordinary writing in it agree than
#: two random ones do, as a multiple: the unevenness that a natural token is expected to have.
ENCODINGS = {
    "hex": ("0123456789abcdef", 1.5),
    "digits": ("0123456789", 1.0),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.0),
    "letters": ("abcdefghijklmnopqrstuvwxyz", 0.7),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 3.0),
}
FALSE_SHARE, REJECT = 0.01, 0.001
BINS, PER_DECADE = 120, 4


def _normal_tail(z: Column) -> Column:
    """P(Z > z) by a rational approximation, to 1e-7 near 0 and in proportion beyond."""
    def upper(x: Column) -> Column:
        t = 1 / (1 + 0.2316419 * x)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-x * x / 2) / F.lit(math.sqrt(2 * math.pi)) * poly

    return let(z, lambda v: F.when(v >= 0, upper(v)).otherwise(1 - upper(-v)))


def _tested(token: Column) -> Column:
    """Encoding and length class of a token, its bin of p-values, and whether it looks random."""
    kind = (
        F.when(token.rlike(r"\A[0-9]+\z"), "digits").when(token.rlike(r"\A([0-9a-f]+|[0-9A-F]+)\z"), "hex")
        .when(token.rlike(r"\A([a-z]+|[A-Z]+)\z"), "letters").when(token.rlike(r"\A[A-Z2-7]+\z"), "base32")
        .otherwise("base64"))

    def of(name: str) -> Column:
        alphabet, uneven = ENCODINGS[name]
        text = F.lower(token) if name in ("hex", "letters") else F.translate(token, "-_", "+/")
        size = len(alphabet)
        values = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
        return let(F.filter(values, lambda v: v >= 0), lambda v: _battery(v, size, uneven))

    tested = F.lit(None)
    for name in ENCODINGS:
        tested = F.when(kind == name, of(name)).otherwise(tested)
    return let(tested, lambda t: F.struct(
        F.concat_ws(":", kind, F.floor(F.log2(F.char_length(token))).cast("string")).alias("stratum"),
        F.least(F.lit(BINS), F.floor(-F.log10(F.greatest(t["p"], F.lit(1e-300))) * PER_DECADE)).cast("int").alias("bin"),
        t["random"].alias("random")))


def _battery(v: Column, size: int, uneven: float) -> Column:
    n = F.size(v).cast("double")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    # Sum of squared counts: in order, the k-th of equal values adds 2k - 1.
    squares = F.aggregate(F.sort_array(v), start, lambda s, x: let(
        F.when(s["last"] == x, s["run"] + 1).otherwise(F.lit(1)),
        lambda r: F.struct(x.alias("last"), r.alias("run"), (s["sum"] + 2 * r - 1).alias("sum"))), lambda s: s["sum"])
    middle = (size - 1) / 2
    walk = F.aggregate(
        v, F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("high"), F.lit(1.0).alias("runs"),
                    F.lit(0.0).alias("cross"), F.lit(0.0).alias("square")),
        lambda s, x: let(x.cast("double") - middle, lambda d: F.struct(
            d.alias("last"), (s["high"] + (d > 0).cast("double")).alias("high"),
            (s["runs"] + F.coalesce(((d > 0) != (s["last"] > 0)).cast("double"), F.lit(0.0))).alias("runs"),
            (s["cross"] + F.coalesce(d * s["last"], F.lit(0.0))).alias("cross"),
            (s["square"] + d * d).alias("square"))))

    def judged(chi: Column, w: Column) -> Column:
        free = size - 1
        # Upper tail of chi-squared by the cube root that is nearly normal.
        even = _normal_tail((F.cbrt(chi / free) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)))
        both = w["high"] * (n - w["high"])
        expected = 2 * both / n + 1
        spread = F.sqrt(F.greatest(F.lit(1e-9), (expected - 1) * (expected - 2) / (n - 1)))
        runs = 2 * _normal_tail(F.abs(w["runs"] - expected) / spread)
        serial = 2 * _normal_tail(F.abs(w["cross"] / F.greatest(F.lit(1e-9), w["square"])) * F.sqrt(n))
        natural = _normal_tail(
            (free + n * uneven - chi) / F.sqrt(2 * free + 4 * n * F.lit(uneven)))
        return F.struct(
            natural.alias("p"),
            (F.least(even, runs, serial) >= REJECT / 3).alias("random"))

    return F.when(n < 2, F.struct(F.lit(1.0).alias("p"), F.lit(False).alias("random"))).otherwise(
        let(squares * size / n - n, lambda chi: let(walk, lambda w: judged(chi, w))))


def _spans(text: Column, pattern: str, kind: int, detail=None) -> Column:
    """Where a pattern matches: (start, kind, end, detail), in code points.

    The pieces between the matches and the matches themselves add up to the places.
    """
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,detail:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    details = F.regexp_extract_all(text, F.lit(pattern), F.lit(detail or 0))

    def placed(hits: Column) -> Column:
        parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), details.alias("detail"))
        return F.aggregate(
            F.slice(parts, 1, F.size(hits)), F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda s, x: let(s["at"] + F.char_length(x["gap"]), lambda a: let(a + F.char_length(x["hit"]), lambda e: F.struct(
                e.alias("at"), F.concat(s["out"], F.array(F.struct(
                    a.alias("start"), F.lit(kind).alias("kind"), e.alias("end"),
                    x["detail"].alias("detail")))).alias("out")))), lambda s: s["out"])

    return F.when(text.rlike(pattern), let(found, placed)).otherwise(empty)


def _scanned(docs: DataFrame, text_col: str) -> DataFrame:
    """Add the spans of the patterns and the tested tokens to every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    base = F.sort_array(F.transform(F.concat(
        F.filter(_spans(text, ASSIGN, 0, 2), lambda s: F.char_length(s["detail"]) >= 6),
        _spans(text, ACCESS, 1), _spans(text, HEX, 2)), bare))
    tokens = F.transform(_spans(text, TOKEN, 3), lambda s: let(
        _tested(s["detail"]), lambda t: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
            t["stratum"].alias("stratum"), t["bin"].alias("bin"), t["random"].alias("random"))))
    return docs.withColumn("base_", base).withColumn("tokens_", tokens)


def _limits(scanned: DataFrame) -> dict[str, int]:
    """The first bin that is reported, for each encoding and length class.

    A bin's p-values are at most 10 ** (-bin / PER_DECADE), so binning only makes the
    procedure stricter. Encodings times binary length classes bound this table.
    """
    counts = scanned.select(F.explode("tokens_").alias("t")).groupBy("t.stratum", "t.bin").count().collect()
    by: dict[str, dict[int, int]] = {}
    for stratum, b, n in counts:
        by.setdefault(stratum, {})[b] = n
    limits = {}
    for stratum, bins in by.items():
        total, above, limit = sum(bins.values()), 0, None
        for b in sorted(bins, reverse=True):
            above += bins[b]
            if 10 ** (-b / PER_DECADE) <= FALSE_SHARE * above / total:
                limit = b
        if limit is not None:
            limits[stratum] = limit
    return limits


def _reported(scanned: DataFrame) -> Column:
    limits = _limits(scanned)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if not limits:
        return none
    table = F.create_map(*[F.lit(x) for item in sorted(limits.items()) for x in item])
    passed = F.filter("tokens_", lambda t: t["random"] & (t["bin"] >= F.coalesce(F.try_element_at(table, t["stratum"]), F.lit(1 << 30))))
    return F.transform(passed, lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def found_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The secrets of every whole text (null: empty).

    Returns one row per input row: id, n_assign, n_access, n_hex, base_sha256 (of the pattern
    spans), spans (all of them, kind:start:end by start then kind, in code points) and
    n_random. Overlapping spans of different kinds all stay. Repeated rows and ids are
    scanned each by itself; extra columns are ignored; an empty table gives no rows.
    """
    scanned = stored(_scanned(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text").select(
        "id", "base_", "tokens_"), "spans")
    n = lambda spans, kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scanned.withColumn("all_", F.sort_array(F.concat("base_", _reported(scanned)))).select(
        F.col("id").alias(id_col), n("base_", 0).alias("n_assign"), n("base_", 1).alias("n_access"),
        n("base_", 2).alias("n_hex"), F.sha2(_joined(F.col("base_")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("all_")).alias("spans"), n("all_", 3).alias("n_random"))


def redacted(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The documents with every found span replaced; overlapping spans become one mask.

    Texts without secrets, null ones among them, stay as they are, and so do all other columns.
    """
    scanned = stored(_scanned(docs, text_col), "scanned")
    spans = F.sort_array(F.concat("base_", _reported(scanned)))
    text = F.col(text_col)
    masked = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(F.struct(
            x["end"].alias("at"), F.concat(
                s["out"], F.substring(text, s["at"] + 1, F.greatest(F.lit(0), x["start"] - s["at"])),
                F.when(x["start"] < s["at"], F.lit("")).otherwise(F.lit(mask))).alias("out"))),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.lit(1 << 30))))
    return scanned.withColumn(text_col, F.when(F.size(spans) > 0, masked).otherwise(text)).drop("base_", "tokens_")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_secrets(read(spark, sf_dir, "documents"))
