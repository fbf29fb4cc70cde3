"""Quality rules with host verdicts.

Every document is measured by itself. Failures of each rule are then counted per
host, the rates are shrunk towards the corpus rate by a beta prior fitted to all
hosts, and a host whose shrunk rate of any rule passes a limit is rejected with all
its documents. Base rules reject a document alone; soft rules only count for hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, let, whole_row_hash, words_of

MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
HOST_LIMIT = 0.5
#: Prior strength, in documents, when hosts differ no more than chance would have it.
MAX_STRENGTH = 1e6
MIN_STRENGTH = 2.0
#: The documents of a host meet its verdict in so many groups.
HOST_SALTS = 32

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
)


def _windows(words: Column) -> Column:
    """Hashes of all windows of eight words: pairs, pairs of pairs, and once more."""

    def joined(hashes: Column, apart: int) -> Column:
        size = F.size(hashes) - apart
        return F.zip_with(
            F.slice(hashes, F.lit(1), size),
            F.slice(hashes, F.lit(1 + apart), size),
            lambda x, y: F.xxhash64(x, y),
        )

    def eights(hashes: Column) -> Column:
        return let(let(joined(hashes, 1), lambda h: joined(h, 2)), lambda h: joined(h, 4))

    none = F.array().cast("array<bigint>")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashed, lambda h: F.when(F.size(h) >= WINDOW, eights(h)).otherwise(none))


def _covered(windows: Column) -> Column:
    """Words inside windows that are found twice or more, first ones included."""
    placed = F.array_sort(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )

    def repeated(s: Column) -> Column:
        def twice(e: Column, j: Column) -> Column:
            before, after = F.get(s, j - 1), F.get(s, j + 1)
            return F.coalesce(before["h"] == e["h"], F.lit(False)) | F.coalesce(
                after["h"] == e["h"], F.lit(False)
            )

        return F.array_sort(F.transform(F.filter(s, twice), lambda e: e["i"]))

    def union(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda x, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - x, F.lit(WINDOW))
            ),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(placed, repeated), union)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures, ``base_failed`` and one ``fails_*`` column per rule.

    A null or empty text has no words and fails by its length. Columns of these names
    that the input has are replaced. A window is known by 64 bits of hash, compared
    inside one text only.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    plain = F.regexp_replace(body, f"[{SYMBOLS}]+", "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def all_measures(w: Column) -> Column:
        return let(
            lines,
            lambda x: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                (F.length(body) - F.length(plain)).cast("long").alias("n_symbols"),
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                _windows(w).alias("windows"),
            ),
        )

    # One struct out of one expression: the planner cannot take it apart and compute
    # the words again for every measure.
    held = free_name(docs, "_measures")
    found = docs.withColumn(held, let(words_of(body), all_measures))
    windows = F.col(held)["windows"]
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    counted = F.when(repeats, _covered(windows)).otherwise(F.lit(0).cast("long"))
    plain_measures = {m: F.col(held)[m] for m in MEASURES if m != "n_repeat_words"}
    found = found.withColumns({**plain_measures, "n_repeat_words": counted}).drop(held)
    n = F.col("n_words")
    found = found.withColumns(
        {
            "fails_length": n < MIN_WORDS,
            "fails_repeats": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * n,
            "fails_symbols": 10 * F.col("n_symbols") > n,
            "fails_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
            "fails_word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n),
        }
    )
    return found.withColumn("base_failed", F.col("fails_length") | F.col("fails_repeats"))


RULES = ("fails_length", "fails_repeats", "fails_symbols", "fails_lines", "fails_word_length")


def host_verdicts(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: documents, shrunk rate of each rule, ``host_rejected``.

    The prior of a rule has the corpus rate as its mean; its strength follows from
    how much rates differ between hosts beyond binomial chance (moments, weighted by
    documents). Documents without a host get no verdict.
    """
    counts = (
        measured.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("_host"))
        .agg(
            F.count("*").alias("_n"),
            *(F.sum(F.col(r).cast("long")).alias(f"_k_{r}") for r in RULES),
        )
    )
    n = F.col("_n")
    totals = counts.agg(
        F.sum("_n").alias("_docs"),
        F.count("*").alias("_hosts"),
        F.sum(n.cast("double") * n).alias("_squares"),
        *(F.sum(f"_k_{r}").alias(f"_all_{r}") for r in RULES),
        *(F.sum(F.pow(F.col(f"_k_{r}"), 2) / n).alias(f"_kk_{r}") for r in RULES),
    )
    docs, hosts = F.col("_docs").cast("double"), F.col("_hosts").cast("double")
    prior = {}
    for r in RULES:
        mean = F.col(f"_all_{r}") / docs
        spread = mean * (1 - mean)
        between = F.col(f"_kk_{r}") - docs * mean * mean - (hosts - 1) * spread
        room = spread * (docs - F.col("_squares") / docs - (hosts - 1))
        share = F.when((room > 0) & (between > 0), F.least(between / room, F.lit(1.0)))
        strength = F.coalesce((1 - share) / share, F.lit(MAX_STRENGTH))
        prior[f"_mean_{r}"] = mean
        prior[f"_strength_{r}"] = F.least(
            F.greatest(strength, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH)
        )
    # One row of totals meets every host: it is a single row by construction.
    joined = counts.join(F.broadcast(totals.withColumns(prior)), F.lit(True))
    rates = {
        f"host_{r}": (F.col(f"_k_{r}") + F.col(f"_mean_{r}") * F.col(f"_strength_{r}"))
        / (n + F.col(f"_strength_{r}"))
        for r in RULES
    }
    bad = F.greatest(*(F.col(f"host_{r}") for r in RULES)) > HOST_LIMIT
    return (
        joined.withColumns(rates)
        .withColumn("host_rejected", bad)
        .select(F.col("_host").alias(host), F.col("_n").alias("host_docs"), *rates, "host_rejected")
    )


def judge(measured: DataFrame, host: str = "source") -> DataFrame:
    """Adds ``host_rejected`` and ``kept`` to measured documents.

    ``measured`` is read twice, so store it first. A document without a host is
    judged by its base rules alone. Equal rows get equal verdicts; an empty table
    stays empty. Other columns may have any names; ``host_rejected`` and ``kept`` of
    the input are replaced.

    A large host's documents meet its verdict in ``HOST_SALTS`` groups, by a hash of
    the row; documents without a host spread alike.
    """
    helpers = [free_name(measured, n) for n in ("_salt", "_known", "_known_salt", "_verdict")]
    salt, known, known_salt, verdict = helpers
    salts = F.explode(F.sequence(F.lit(0), F.lit(HOST_SALTS - 1)))
    rejected = (
        host_verdicts(measured, host)
        .where("host_rejected")
        .select(F.col(host).alias(known), salts.alias(known_salt), F.lit(True).alias(verdict))
    )
    dealt = F.pmod(whole_row_hash(measured), F.lit(HOST_SALTS)).cast("int")
    met = (F.col(host) == F.col(known)) & (F.col(salt) == F.col(known_salt))
    return (
        measured.withColumn(salt, dealt)
        .join(rejected, met, "left")
        .withColumn("host_rejected", F.coalesce(verdict, F.lit(False)))
        .drop(*helpers)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    )
