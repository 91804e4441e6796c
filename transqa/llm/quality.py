"""Quality rules whose cutoffs come with a guarantee.

Each rule rejects documents whose rate lies above a cutoff. Per stratum, labelled
documents test the cutoffs from the laxest to the strictest: a cutoff is certified while
the exact binomial probability of seeing as few good documents rejected, were the
true rate above the rule's share of ``risk``, stays below ``error`` divided by the number of
rules and strata (Bonferroni across them; a fixed sequence along the cutoffs needs no
more). So with probability 1 - error no stratum loses more than ``risk`` of its good
documents to all rules together. Among the certified cutoffs the one with the most
labelled bad documents per good one lost is taken.

That share is small, so it takes about 1,500 good labels in a stratum to certify anything. Jointly
(``joint_cutoffs``) every fifth labelled document chooses a cutoff per rule and the order of the rules, and the
others test what the first rules of that order reject together, at the whole ``risk`` and ``error`` per group.
Strata of too few labels to certify even a loss of nothing are one group: for them the promise
holds for all their good documents taken together, not for each. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transqa.llm.common import WORD, let, read, stored

#: Rates and their cutoffs, laxest first; fixed beforehand, as the tests need.
RULES = {
    "symbols_per_word": (2.0, 1.0, 0.5, 0.2, 0.1),
    "capitals_per_char": (0.9, 0.7, 0.5, 0.3, 0.2),
    "repeated_words": (0.4, 0.3, 0.2, 0.1, 0.05),
    "repeated_lines": (0.9, 0.8, 0.7, 0.6, 0.5),
    "chars_per_word": (20.0, 15.0, 12.0, 10.0, 9.0),
}
RISK, ERROR = 0.02, 0.05
#: Labelled bad documents that a rule must catch for each good one it costs.
WORTH = 10
#: One labelled document in so many chooses the cutoffs of the joint test.
FOLDS = 5
_INDEX_BITS = 24


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str = "lang", **extra: Column) -> DataFrame:
    """Counts over each whole text (null: empty), one row per input row; ``extra`` columns stay with it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    counted = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col), F.lit("")).alias("stratum"),
        let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda s, x: s + F.char_length(x)).alias("word_chars"),
            _repeated(w).cast("long").alias("n_repeat_words"))).alias("w"),
        _count(text, r"[^#*$%&|<>]+").alias("n_symbols"),
        _count(text, r"[^A-Z!]+").alias("n_capitals"),
        let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
        *[column.alias(name) for name, column in extra.items()],
    )
    return counted.select(
        "doc_id", "stratum", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
        "l.n_lines", "n_capitals", *extra)


def _count(text: Column, others: str) -> Column:
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def _repeated(words: Column) -> Column:
    """Words that lie in a window of three found twice or more.

    Windows are hashed and sorted together with their place, so that equal ones are
    neighbours; neighbours are compared word by word.
    """
    def window(i: Column) -> Column:
        return F.array(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def hashed(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    mask = F.lit((1 << _INDEX_BITS) - 1).cast("long")
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    short = F.sort_array(F.transform(starts, lambda i: F.shiftleft(
        F.shiftright(hashed(i), _INDEX_BITS), _INDEX_BITS).bitwiseOR(i.cast("long"))))
    # Texts of 2**24 words and more: hash and place side by side.
    long = F.transform(F.sort_array(F.transform(
        starts, lambda i: F.struct(hashed(i), i.cast("long").alias("i")))), lambda s: s["i"])
    place = F.when(F.size(words) < 1 << _INDEX_BITS, F.transform(short, lambda x: x)).otherwise(long)

    def alike(order: Column, a: Column, b: Column) -> Column:
        x, y = F.get(order, a), F.get(order, b)
        close = F.shiftright(x, _INDEX_BITS) == F.shiftright(y, _INDEX_BITS)
        i, j = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
        same = F.coalesce((F.size(words) >= 1 << _INDEX_BITS) | close, F.lit(False))
        full = window(F.when(F.size(words) < 1 << _INDEX_BITS, i).otherwise(x.cast("int"))) == window(
            F.when(F.size(words) < 1 << _INDEX_BITS, j).otherwise(y.cast("int")))
        return F.when(same, F.coalesce(full, F.lit(False))).otherwise(F.lit(False))

    def covered(order: Column) -> Column:
        hit = F.filter(order, lambda x, k: alike(order, k, k - 1) | alike(order, k, k + 1))
        at = F.sort_array(F.transform(hit, lambda x: F.when(
            F.size(words) < 1 << _INDEX_BITS, x.bitwiseAND(mask)).otherwise(x)))
        return let(at, lambda p: F.aggregate(
            p, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
            lambda s, x: F.struct((s["n"] + F.least(F.lit(3).cast("long"), x - s["last"])).alias("n"),
                                  x.alias("last")), lambda s: s["n"]))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(place, covered))


def _rates() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "capitals_per_char": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / words,
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "chars_per_word": F.col("word_chars") / words,
    }


def _base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X binomial(n, rate), summed in logarithms from the largest term down."""
    odds = math.log(rate) - math.log1p(-rate)
    # log P(X = k), by summing ratios of neighbouring terms up from P(X = 0).
    top = F.aggregate(
        F.sequence(F.lit(1), k), n * F.lit(math.log1p(-rate)),
        lambda s, i: s + F.log((n - i + 1) / i) + F.lit(odds))
    top = F.when(k < 1, n * F.lit(math.log1p(-rate))).otherwise(top)
    # The terms below, relative to that one.
    down = F.aggregate(
        F.sequence(F.lit(1), k),
        F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda s, i: let(
            s["term"] * (k - i + 1) / (n - k + i) * F.lit(math.exp(-odds)),
            lambda t: F.struct((s["sum"] + t).alias("sum"), t.alias("term"))),
        lambda s: s["sum"])
    down = F.when(k < 1, F.lit(1.0)).otherwise(down)
    # A count above the mean has a probability of a half and more.
    return F.when(k > n * F.lit(rate), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * down))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR,
            worth: int = WORTH) -> DataFrame:
    """The cutoff of every rule and stratum that has a certified and worthwhile one.

    ``labels`` has (doc_id, quality), 1 for good. Documents that the base fails are left
    out. Returns (stratum, rule, cutoff, good, lost, caught); a stratum with too few labels
    has none, so its documents stay.
    """
    share = risk / len(RULES)
    judged = measured.where(~_base_failed()).join(labels.select("doc_id", "quality").distinct(), "doc_id")
    tests = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(turn).alias("turn"), F.lit(float(cut)).alias("cutoff"),
                 (rate > cut).cast("int").alias("hit"))
        for (rule, cuts), rate in zip(RULES.items(), _rates().values(), strict=True)
        for turn, cut in enumerate(cuts)])
    counted = (
        judged.select("stratum", "quality", F.explode(tests).alias("t")).groupBy("stratum", "t.rule", "t.turn", "t.cutoff")
        .agg(F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).cast("int").alias("good"),
             F.sum(F.when(F.col("quality") == 1, F.col("t.hit")).otherwise(0)).cast("int").alias("lost"),
             F.sum(F.when(F.col("quality") == 0, F.col("t.hit")).otherwise(0)).cast("int").alias("caught"))
    )
    everywhere = Window.partitionBy()
    strata = F.size(F.collect_set("stratum").over(everywhere))
    lax_first = Window.partitionBy("stratum", "rule").orderBy("turn")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), "turn")
    return (
        counted.withColumn("p", binomial_tail(F.col("good"), F.col("lost"), share))
        .withColumn("passed", (F.col("p") <= F.lit(error) / (strata * len(RULES))).cast("int"))
        .withColumn("certified", F.min("passed").over(lax_first))
        .withColumn("gain", F.col("caught") - worth * F.col("lost"))
        .where("certified = 1 AND gain > 0")
        .withColumn("rank", F.row_number().over(best)).where("rank = 1")
        .select("stratum", "rule", "cutoff", "good", "lost", "caught")
    )


def joint_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR,
                  worth: int = WORTH) -> DataFrame:
    """The cutoffs whose joint rejection is certified, per stratum, from the same tables as ``cutoffs``.

    Returns (stratum, rule, cutoff, good, lost, caught), the counts being those of all rules of its group
    together. Strata without labelled documents have none.
    """
    judged = measured.where(~_base_failed()).join(
        labels.where("quality IN (0, 1)").select("doc_id", "quality").distinct(), "doc_id")
    rates = _rates()
    judged = judged.select(
        "stratum", "quality", (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) == 0).alias("choosing"),
        F.struct(*[rate.alias(rule) for rule, rate in rates.items()]).alias("rates"))
    tests = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(turn).alias("turn"), F.lit(float(cut)).alias("cutoff"),
                 (F.col("rates")[rule] > cut).cast("int").alias("hit"))
        for rule, cuts in RULES.items() for turn, cut in enumerate(cuts)])
    best = Window.partitionBy("rule").orderBy(F.desc("gain"), "turn")
    plan = (
        judged.where("choosing").select("quality", F.explode(tests).alias("t")).groupBy("t.rule", "t.turn", "t.cutoff")
        .agg(F.sum(F.when(F.col("quality") == 0, F.col("t.hit")).otherwise(-worth * F.col("t.hit"))).alias("gain"))
        .where("gain > 0").withColumn("rank", F.row_number().over(best)).where("rank = 1")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("gain")).alias("order"), "rule", "cutoff"))).alias("plan"))
    )
    hits = F.transform("plan", lambda x: F.coalesce(*[
        F.when(x["rule"] == rule, F.col("rates")[rule] > x["cutoff"]) for rule in rates]))
    steps = judged.where("NOT choosing").crossJoin(plan).withColumn("first", F.array_position(hits, F.lit(True))).select(
        "stratum", "quality", "plan", "first", F.explode(F.sequence(F.lit(1), F.size("plan"))).alias("step")
    ).where("step <= size(plan)")
    hit = ((F.col("first") > 0) & (F.col("first") <= F.col("step"))).cast("int")
    per = steps.groupBy("stratum", "step").agg(
        F.first("plan").alias("plan"),
        F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).cast("int").alias("good"),
        F.sum(F.when(F.col("quality") == 1, hit).otherwise(0)).cast("int").alias("lost"),
        F.sum(F.when(F.col("quality") == 0, hit).otherwise(0)).cast("int").alias("caught"))
    # Groups hang on the number of labels alone, and there are never more of them than strata.
    level = F.lit(error) / F.size(F.collect_set("stratum").over(Window.partitionBy()))
    per = per.withColumn("level", level).withColumn("small", F.pow(F.lit(1 - risk), "good") > F.col("level"))
    group = [F.col("small"), F.when(~F.col("small"), F.col("stratum"))]
    together = Window.partitionBy(*group, "step")
    for count in ("good", "lost", "caught"):
        per = per.withColumn(f"all_{count}", F.sum(count).over(together).cast("int"))
    best = Window.partitionBy("stratum").orderBy(F.desc("gain"), "step")
    return (
        per.withColumn("passed", (binomial_tail(F.col("all_good"), F.col("all_lost"), risk) <= F.col("level")).cast("int"))
        .withColumn("certified", F.min("passed").over(Window.partitionBy("stratum").orderBy("step")))
        .withColumn("gain", F.col("all_caught") - worth * F.col("all_lost")).where("certified = 1 AND gain > 0")
        .withColumn("rank", F.row_number().over(best)).where("rank = 1")
        .select("stratum", F.explode(F.slice("plan", 1, F.col("step"))).alias("t"),
                F.col("all_good").alias("good"), F.col("all_lost").alias("lost"), F.col("all_caught").alias("caught"))
        .select("stratum", "t.rule", "t.cutoff", "good", "lost", "caught")
    )


def judged_quality(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR,
                   id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                   certify=cutoffs, **extra: Column) -> DataFrame:
    """Which documents pass the base and the certified rules.

    ``certify`` is ``cutoffs`` or ``joint_cutoffs``. Returns one row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and the rule that rejected it, if one did. Null and
    empty texts fail the base. ``extra`` columns over ``docs`` are returned with their row. A null stratum is a stratum of its own. Labels of other
    values than 0 and 1, of unknown or null ids count for nothing; without labels only the
    base decides. Rows that share an id are judged each by its own text. Extra columns are
    ignored; an empty table gives no rows.
    """
    measured = stored(features(docs, id_col, text_col, stratum_col, **extra), "features")
    chosen = certify(measured, labels, risk, error).groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES])
    hits = F.coalesce(*[
        F.when(rate > F.col(f"cut_{rule}"), F.lit(rule)) for rule, rate in _rates().items()])
    return measured.join(chosen, "stratum", "left").withColumn("rule", hits).select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _base_failed().alias("base_failed"), (~_base_failed() & F.col("rule").isNull()).alias("kept"), "rule", *extra)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("rule")


def _sql() -> str:
    rates = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "capitals_per_char": "n_capitals / greatest(word_chars, 1)",
        "repeated_words": "n_repeat_words / greatest(n_words, 1)",
        "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
        "chars_per_word": "word_chars / greatest(n_words, 1)",
    }
    tests = " UNION ALL ".join(
        f"SELECT stratum, quality, '{rule}' AS rule, {turn} AS turn, {cut}::DOUBLE AS cutoff, ({rates[rule]} > {cut})::INT AS hit FROM judged"
        for rule, cuts in RULES.items() for turn, cut in enumerate(cuts))
    hit = " OR ".join(
        f"coalesce({rate} > (SELECT cutoff FROM chosen c WHERE c.stratum = b.stratum AND c.rule = '{rule}'), false)"
        for rule, rate in rates.items())
    share = RISK / len(RULES)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
), win AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id
), f AS (
  SELECT d.doc_id, stratum, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z!]+', '', 'g'))::BIGINT AS n_capitals, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id
), b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM f),
judged AS (SELECT b.*, quality FROM b JOIN (SELECT DISTINCT doc_id, quality FROM labels) USING (doc_id) WHERE NOT base_failed),
tests AS ({tests}),
counted AS (
  SELECT stratum, rule, turn, cutoff, sum((quality = 1)::INT) AS good, sum(CASE WHEN quality = 1 THEN hit ELSE 0 END) AS lost,
         sum(CASE WHEN quality = 0 THEN hit ELSE 0 END) AS caught FROM tests GROUP BY ALL
), tail AS (
  SELECT *, CASE WHEN lost > good * {share!r} THEN 1 ELSE least(1, list_sum(list_transform(range(0, lost::BIGINT + 1), lambda i:
         exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({share!r}) + (good - i) * ln(1 - {share!r}))))) END AS p
  FROM counted
), passed AS (
  SELECT *, bool_and(p <= {ERROR} / ((SELECT count(DISTINCT stratum) FROM counted) * {len(RULES)})) OVER (PARTITION BY stratum, rule ORDER BY turn) AS certified FROM tail
), chosen AS (
  SELECT stratum, rule, cutoff FROM passed WHERE certified AND caught - {WORTH} * lost > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY caught - {WORTH} * lost DESC, turn) = 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({hit}) AS kept FROM b
"""


OP6_SQL = _sql()
