"""Quality rules with risk-controlled thresholds (operator 3), in built-in functions only.

A text's counts of symbols, repeated lines and repeated word runs give three shares. A
share above a cutoff rejects the text. The cutoffs come from labelled documents: per
stratum (a range of text lengths) and share, candidates are tried from the loosest to
the strictest. A candidate passes while the exact binomial bound says that, but for a
small error probability, it rejects at most the allowed share of good texts; the first
that fails ends the search, so trying many costs no error probability. The error
probability is divided among all strata and shares (Bonferroni), and the allowed false
rejections of a stratum among its shares.

Counting needs no shuffle. The counts are written once, since calibration and verdict
both read them; what is shuffled is the labelled rows' counts and one row per stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from obslayers.llm.quality_classifier import free_name
from obslayers.storage import materialize

# Fixed values of the counts.
WORD = r"[^\x20\x09-\x0D]+"
NOT_IN_WORDS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RUN = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
# What is counted, and out of what.
SHARES = (("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"))
# Strata: texts of fewer words than these, and the rest.
STRATA = (100, 300, 1000)
# Candidate cutoffs in thousandths, from the loosest.
CANDIDATES = (900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100, 75, 50, 40, 30, 20, 10)
# Good texts of a stratum that may be rejected, and the probability that more are.
ALLOWED, ERROR = 0.02, 0.05


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _numbered_hashes(name: str) -> Column:
    """Hashes of all runs of ``RUN`` words from the hashes of the words."""
    h = F.col(name)
    runs = F.slice(h, F.lit(1), F.greatest(F.size(h) - (RUN - 1), F.lit(0)))
    return F.transform(runs, lambda x, i: F.xxhash64(x, *[h[i + k] for k in range(1, RUN)]))


def _covered(places: Column) -> Column:
    """Words in runs that begin at the sorted ``places``."""
    following = F.slice(places, F.lit(2), F.greatest(F.size(places), F.lit(1)))
    steps = F.zip_with(places, following, lambda a, b: F.coalesce(F.least(b - a, F.lit(RUN)), F.lit(RUN)))
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def text_counts(docs: DataFrame, carried: list[str], text_column: str = "text") -> DataFrame:
    """The ``carried`` columns and a struct ``counts`` of the six counts of each whole text.

    Runs of words are compared by 64-bit hashes within their text.
    """
    given = docs.select(F.struct(*carried).alias("row"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(_without(line, NOT_IN_WORDS)) > 0)
    bare = _without(F.col("text"), NOT_IN_WORDS)
    counted = given.select(
        "row",
        F.length(bare).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(0)).alias("words"),
    )
    hashed = counted.select(
        "row",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("words").cast("bigint").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    runs = hashed.withColumn("runs", _numbered_hashes("hashes")).drop("hashes")
    # Most texts repeat no run; only the others sort theirs.
    twice = F.size(F.array_distinct("runs")) < F.size("runs")
    placed = F.transform("runs", lambda x, i: F.struct(x.alias("run"), i.alias("at")))
    ordered = runs.withColumn("ordered", F.when(twice, F.sort_array(placed))).drop("runs")

    def same(i: Column, j: Column) -> Column:
        o = F.col("ordered")
        return F.coalesce(F.get(o, i)["run"] == F.get(o, j)["run"], F.lit(False))

    marked = F.transform("ordered", lambda x, i: F.when(same(i, i - 1) | same(i, i + 1), x["at"]))
    places = F.sort_array(F.filter(marked, lambda at: at.isNotNull()))
    found = ordered.withColumn("places", places).drop("ordered")
    repeated = F.coalesce(_covered(F.col("places")), F.lit(0)).cast("bigint")
    done = found.withColumn("n_repeat_words", repeated)
    return done.select("row.*", F.struct(*COUNTS).alias(free_name(docs.select(*carried), "counts")))


def stratum(n_words: Column) -> Column:
    out = F.lit(len(STRATA))
    for i, below in reversed(list(enumerate(STRATA))):
        out = F.when(n_words < below, i).otherwise(out)
    return out


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


def _over(counts: Column, share: int, thousandths: Column | int) -> Column:
    part, whole = SHARES[share]
    return 1000 * counts[part] > thousandths * counts[whole]


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series beyond a shift that makes it exact to rounding."""
    z = n + 9.0
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    far = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series
    product = F.lit(1.0)
    for i in range(1, 9):
        product = product * (n + float(i))
    return far - F.log(product)


def binomial_below(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial of n trials with probability p, summed from k downwards.

    For k over n p, where no bound is wanted, it is 1. The terms left out, some eight
    standard deviations away, are below the rounding of the sum.
    """
    k, n = k.cast("double"), n.cast("double")
    log_term = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k, F.ceil(8 * F.sqrt(n * p)) + 64).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))

    def add(acc: Column, j: Column) -> Column:
        ratio = (k - j) / (n - k + j + 1) * ((1 - p) / p)
        return F.struct((acc["term"] * ratio).alias("term"), (acc["total"] + acc["term"]).alias("total"))

    total = F.aggregate(F.sequence(F.lit(0), terms), start, add, lambda acc: acc["total"])
    return F.when(k > n * p, 1.0).otherwise(F.exp(log_term) * total)


def cutoffs(counted: DataFrame, labels: DataFrame, id_column: str, counts_name: str, label_column: str) -> DataFrame:
    """Per stratum the cutoff of each share in thousandths, null where none is safe.

    Good texts are those labelled 1 (by all their labels) that the base rules keep.
    """
    good = labels.groupBy(F.col(id_column).alias("labelled")).agg(F.min(label_column).alias("least"))
    good = good.where("least = 1").select("labelled")
    own = counted.select(F.col(id_column).alias("own"), F.col(counts_name).alias("counts"))
    c = F.col("counts")
    own = own.where(~base_failed(c)).withColumn("stratum", stratum(c["n_words"]))
    tried = [
        F.count_if(_over(c, s, t)).alias(f"k{s}_{t}") for s in range(len(SHARES)) for t in CANDIDATES
    ]
    sums = own.join(good, F.col("own") == F.col("labelled")).groupBy("stratum")
    wide = sums.agg(F.count(F.lit(1)).alias("n"), *tried)
    each = F.explode(
        F.array(
            *[
                F.struct(F.lit(s).alias("share"), F.lit(t).alias("cutoff"), F.col(f"k{s}_{t}").alias("k"))
                for s in range(len(SHARES))
                for t in CANDIDATES
            ]
        )
    )
    long = wide.select("stratum", "n", each.alias("try")).select("stratum", "n", "try.*")
    allowed = ALLOWED / len(SHARES)
    error = ERROR / (len(SHARES) * (len(STRATA) + 1))
    passed = (binomial_below(F.col("k"), F.col("n"), allowed) <= error).cast("int")
    so_far = Window.partitionBy("stratum", "share").orderBy(F.desc("cutoff"))
    tested = long.withColumn("passed", passed).withColumn("all_passed", F.min("passed").over(so_far))
    best = tested.where("all_passed = 1").groupBy("stratum")
    return best.agg(*[F.min(F.when(F.col("share") == s, F.col("cutoff"))).alias(f"cutoff_{s}") for s in range(len(SHARES))])


def judge(
    docs: DataFrame,
    labels: DataFrame,
    carried: list[str] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> tuple[DataFrame, str]:
    """Every row's ``carried`` columns and a struct of counts and verdict, and that struct's name.

    The struct has the six counts, ``stratum``, ``base_failed`` and ``kept``. A null text
    counts as empty, and so fails the base rules. Where labels are missing or too few for
    a bound, only the base rules reject.
    """
    carried = carried or [id_column]
    name = free_name(docs.select(*carried), "counts")
    counted = materialize(text_counts(docs, carried, text_column), "counts")
    # One row per stratum: a handful, by the definition of the strata.
    limits = F.broadcast(cutoffs(counted, labels, id_column, name, label_column))
    c = F.col(name)
    own = counted.withColumn(free_name(counted, "stratum_key"), stratum(c["n_words"]))
    key = own.columns[-1]
    limits = limits.select(*[F.col(x).alias(f"limit {x}") for x in limits.columns])
    judged = own.join(limits, F.col(key) == F.col("limit stratum"), "left")
    over = F.lit(False)
    for s in range(len(SHARES)):
        over = over | F.coalesce(_over(c, s, F.col(f"limit cutoff_{s}")), F.lit(False))
    failed = base_failed(c)
    verdict = F.struct(
        *[c[x].alias(x) for x in COUNTS],
        F.col(key).alias("stratum"),
        failed.alias("base_failed"),
        (~failed & ~over).alias("kept"),
    )
    return judged.select(*carried, verdict.alias(name)), name


def verdicts(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the counts, ``stratum``, ``base_failed`` and ``kept``."""
    rows, name = judge(docs, labels, None, id_column, text_column)
    return rows.select(id_column, f"{name}.*")


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are."""
    rows, name = judge(docs, labels, docs.columns, id_column, text_column)
    return rows.where(F.col(name)["kept"]).select(*docs.columns)


# The same in SQL. Counts of runs go by the words themselves.
ORACLE_SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM texts
), runs AS (
    SELECT r, i, array_to_string(words[i:i + 4], ' ') AS run
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM parts)
), repeated AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words
    FROM repeated, (SELECT unnest(range(0, 5)) AS k) GROUP BY r
), counts AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM parts LEFT JOIN covered USING (r)
), judged AS (
    SELECT *, CASE WHEN n_words < {STRATA[0]} THEN 0 WHEN n_words < {STRATA[1]} THEN 1
            WHEN n_words < {STRATA[2]} THEN 2 ELSE 3 END AS stratum,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
    FROM counts
), shares AS (
    SELECT doc_id, stratum, base_failed, s.share, s.part, s.whole
    FROM judged, (SELECT unnest([
        {{'share': 0, 'part': n_symbols, 'whole': word_chars}},
        {{'share': 1, 'part': n_dup_lines, 'whole': n_lines}},
        {{'share': 2, 'part': n_repeat_words, 'whole': n_words}}]) AS s)
), good AS (
    SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1
), tried AS (
    SELECT stratum, share, t, count(*) AS n, count(*) FILTER (1000 * part > t * whole) AS k
    FROM shares JOIN good USING (doc_id), (SELECT unnest([{", ".join(map(str, CANDIDATES))}]) AS t)
    WHERE NOT base_failed GROUP BY ALL
), tested AS (
    SELECT *, CASE WHEN k > n * {ALLOWED / 3!r}::DOUBLE THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
            exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                + i * ln({ALLOWED / 3!r}::DOUBLE) + (n - i) * ln(1 - {ALLOWED / 3!r}::DOUBLE)))) END
        <= {ERROR / 12!r}::DOUBLE AS passed
    FROM tried
), cutoffs AS (
    SELECT stratum, share, min(t) AS cutoff
    FROM (SELECT *, bool_and(passed) OVER (PARTITION BY stratum, share ORDER BY t DESC) AS all_passed FROM tested)
    WHERE all_passed GROUP BY ALL
), over_limit AS (
    SELECT DISTINCT doc_id FROM shares JOIN cutoffs USING (stratum, share) WHERE 1000 * part > cutoff * whole
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    CAST(stratum AS INTEGER) AS stratum, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM over_limit) AS kept
FROM judged"""
