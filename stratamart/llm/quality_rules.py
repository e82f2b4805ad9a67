"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation
maximisation over the counts of vote patterns (at most 3 ** rules rows, whatever
the corpus) estimates how often each rule votes either way on good and on bad
documents; a document stays if the posterior probability of being good is at least
one half. A rule that often accuses documents nothing else speaks against loses weight.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import spaced, words
from stratamart.operators.lookups import pin

WINDOW = 8
MIN_WORDS = 20
ITERATIONS = 20
SYMBOLS = "#*$%&|<>"
# Rates at which a rule votes on good and on bad documents, where the iterations start.
START = {"good_up": 0.5, "good_down": 0.005, "bad_up": 0.5, "bad_down": 0.3}
# Share of good documents. It is given, not estimated: abstentions carry no weight,
# so the votes alone cannot tell how many silent documents are good.
GOOD_SHARE = 0.8
# Pseudo-documents with these rates, which keep the estimates off 0 and 1.
PSEUDO = 10.0
# The rules are written so that they rarely accuse a good document. Holding the
# estimates to that keeps a common kind of bad document from being taken for good.
MAX_FALSE_ALARM = 0.02

# Rule -> (condition for a bad vote, condition for a good vote) over the measured
# columns, valid in Spark SQL and DuckDB alike. If neither holds the rule abstains,
# which says nothing: having no odd symbols, say, is no merit.
RULES = {
    "word_length": ("word_chars > 14 * n_words OR 2 * word_chars < 5 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    "variety": ("4 * n_distinct < n_words AND n_distinct < 4 * sqrt(n_words)", "2 * n_distinct >= n_words"),
    "symbols": ("10 * n_symbols > n_words", "FALSE"),
    "repeated_lines": ("2 * n_dup_lines > n_lines", "FALSE"),
    "repeated_words": ("4 * n_repeat_words > n_words", "FALSE"),
    "capitals": ("4 * n_capitals > word_chars", "FALSE"),
    "loud_marks": ("5 * n_loud > n_words", "FALSE"),
}


def _let(value, body):
    """``body`` over ``value`` worked out once. A plain column would be inlined into
    lambdas and worked out again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(tokens):
    """Words inside windows that occur more than once, by sorting (window, position) pairs.

    Windows are compared by hashes of word hashes; the sort is skipped where nothing repeats.
    """

    def covered(at):
        gap = F.transform(at, lambda x, k: F.when(k == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), x - F.get(at, F.greatest(k - 1, F.lit(0))))))
        return F.aggregate(gap, F.lit(0), lambda total, part: total + part)

    def positions(pairs):
        same = lambda p, i: F.get(pairs, i)["g"].eqNullSafe(p["g"])
        repeated = F.filter(pairs, lambda p, k: ((k > 0) & same(p, F.greatest(k - 1, F.lit(0)))) | same(p, k + 1))
        return F.sort_array(F.transform(repeated, lambda p: p["i"]))

    def of_grams(grams):
        pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        found = _let(pairs, lambda p: _let(positions(p), covered))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(found)

    def joined(hashes, parts, step):
        """Hash of each run of ``parts`` elements that stand ``step`` apart."""
        n = F.size(hashes) - (parts - 1) * step
        together = F.arrays_zip(*[F.slice(hashes, 1 + k * step, n) for k in range(parts)])
        return F.transform(together, lambda g: F.xxhash64(g))

    def of_halves(halves):
        # A window that repeats has halves that repeat, and few texts have any.
        windows = _let(joined(halves, 2, WINDOW // 2), of_grams)
        return F.when(F.size(F.array_distinct(halves)) == F.size(halves), 0).otherwise(windows)

    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    found = _let(hashes, lambda h: _let(joined(h, WINDOW // 2, 1), of_halves))
    return F.when(F.size(tokens) < WINDOW, 0).otherwise(found)


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts per document. A null text counts as empty: every count is 0.

    ``n_repeat_words`` compares 8-word windows of one text by 64-bit hash. Arrays
    of one document are the largest thing held; nothing is shuffled.
    """
    long = lambda c: c.cast("long")

    def of_words(tokens):
        return F.struct(
            long(F.size(tokens)).alias("n_words"),
            long(_repeat_words(tokens)).alias("n_repeat_words"),
            long(F.size(F.array_distinct(tokens))).alias("n_distinct"),
        )

    def of_lines(lines):
        return F.struct(
            long(F.size(lines)).alias("n_lines"),
            long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        )

    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    found = lambda chars: long(F.regexp_count(body, F.lit(chars)))
    return docs.select(
        *keep,
        _let(words(F.col(text)), of_words).alias("_w"),
        _let(lines, of_lines).alias("_l"),
        long(F.length(F.replace(spaced(F.col(text)), F.lit(" "), F.lit("")))).alias("word_chars"),
        found(f"[{SYMBOLS}]").alias("n_symbols"),
        found("[A-Z]").alias("n_capitals"),
        found("[!?]").alias("n_loud"),
    ).select(
        *keep, "_w.n_words", "word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words",
        "_l.n_lines", "n_capitals", "n_loud", "_w.n_distinct",
    )


def vote(measured: DataFrame) -> DataFrame:
    """Adds ``vote_<rule>``, and ``base_failed``. A text without words gets no vote at all."""
    votes = {
        f"vote_{rule}": F.expr(f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END")
        for rule, (bad, good) in RULES.items()
    }
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words")
    return measured.withColumns(votes | {"base_failed": failed})


def start_model() -> dict:
    return {rule: dict(START) for rule in RULES}


def log_odds(model: dict) -> Column:
    """Log odds of a good document given its votes."""
    total = F.lit(math.log(GOOD_SHARE / (1 - GOOD_SHARE)))
    for rule in RULES:
        rate, v = model[rule], F.col(f"vote_{rule}")
        total += (
            F.when(v == 1, math.log(rate["good_up"] / rate["bad_up"]))
            .when(v == -1, math.log(rate["good_down"] / rate["bad_down"]))
            .otherwise(0.0)
        )
    return total


def posterior(model: dict) -> Column:
    return 1 / (1 + F.exp(-log_odds(model)))


def fit(voted: DataFrame, iterations: int = ITERATIONS) -> dict:
    """Estimate each rule's rates on good and on bad documents.

    One row of sums per iteration reaches the driver. An empty table leaves the
    starting values.
    """
    names = [f"vote_{rule}" for rule in RULES]
    patterns, _ = pin(voted.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n")), "votes")
    model = start_model()
    for _ in range(iterations):
        weight = {"good": F.col("n") * F.col("_p"), "bad": F.col("n") * (1 - F.col("_p"))}
        sums = [F.sum(weight["good"]).alias("good"), F.sum(weight["bad"]).alias("bad")]
        for rule, name in zip(RULES, names):
            for side, share in weight.items():
                sums += [
                    F.sum(F.when(F.col(name) == sign, share).otherwise(0.0)).alias(f"{rule}_{side}_{label}")
                    for sign, label in ((1, "up"), (-1, "down"))
                ]
        row = patterns.withColumn("_p", posterior(model)).agg(*sums).first()
        if row["good"] is None:
            break
        rate = lambda hits, total, start: (hits + PSEUDO * start) / (total + PSEUDO)
        model = {}
        for rule in RULES:
            model[rule] = {key: rate(row[f"{rule}_{key}"], row[key.split("_")[0]], start) for key, start in START.items()}
            model[rule]["good_down"] = min(MAX_FALSE_ALARM, model[rule]["good_down"])
    return model


def quality_rules(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Judge every row of ``docs``.

    Returns ``keep``, the measured columns, ``base_failed``, ``quality`` (posterior
    probability) and ``kept``. Null and empty texts have no words and fail the base
    rules. Equal rows get equal results, once each; an empty table gives no rows.
    Only ``keep`` and ``text`` are read, so further columns may have any name.
    """
    measured, _ = pin(measure(docs, text, keep), "quality-rules")  # read for the fit and for the verdicts
    voted = vote(measured)
    model = fit(voted)
    return voted.withColumn("quality", posterior(model)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    ).drop(*[f"vote_{rule}" for rule in RULES])


def oracle() -> str:
    """The query in DuckDB, with its own count of repeats and a recursive query for the iterations."""
    names = list(RULES)
    votes = ", ".join(
        f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS vote_{rule}"
        for rule, (bad, good) in RULES.items()
    )
    odds = f"ln({GOOD_SHARE / (1 - GOOD_SHARE)})" + "".join(
        f" + CASE vote_{r} WHEN 1 THEN ln(m.{r}_good_up / m.{r}_bad_up) WHEN -1 THEN ln(m.{r}_good_down / m.{r}_bad_down) ELSE 0.0 END"
        for r in names
    )
    begin = "0 AS step, " + ", ".join(
        f"{start}::DOUBLE AS {r}_{key}" for r in names for key, start in START.items()
    )

    def rate(rule: str, key: str, start: float) -> str:
        side, label = key.split("_")
        weight = "n * p" if side == "good" else "n * (1 - p)"
        hits = f"coalesce(sum({weight}) FILTER (vote_{rule} = {1 if label == 'up' else -1}), 0)"
        value = f"({hits} + {PSEUDO * start}) / (sum({weight}) + {PSEUDO})"
        return f"least({MAX_FALSE_ALARM}, {value})" if key == "good_down" else value

    update = "step + 1, " + ", ".join(
        rate(r, key, start) for r in names for key, start in START.items()
    )
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
grams AS (
  SELECT doc_id, CASE WHEN len(w) >= 8 THEN list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) ELSE []::VARCHAR[] END AS g
  FROM split),
flat AS (SELECT doc_id, unnest(g) AS g, unnest(range(len(g))) AS i FROM grams),
hits AS (SELECT doc_id, i FROM flat QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
steps AS (SELECT doc_id, least(8, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 8)) AS s FROM hits),
repeats AS (SELECT doc_id, sum(s)::BIGINT AS n_repeat_words FROM steps GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals, length(regexp_replace(t, '[^!?]', '', 'g'))::BIGINT AS n_loud,
    len(list_distinct(w))::BIGINT AS n_distinct
  FROM split LEFT JOIN repeats USING (doc_id)),
voted AS MATERIALIZED (SELECT *, {votes}, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM measured),
patterns AS MATERIALIZED (SELECT {", ".join(f"vote_{r}" for r in names)}, count(*)::DOUBLE AS n FROM voted GROUP BY ALL),
model AS (
  SELECT {begin}
  UNION ALL
  SELECT {update} FROM (SELECT m.step, patterns.*, 1 / (1 + exp(-({odds}))) AS p FROM patterns, model m WHERE m.step < {ITERATIONS}) GROUP BY step)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND 1 / (1 + exp(-({odds}))) >= 0.5) AS kept
FROM voted, (SELECT * FROM model WHERE step = {ITERATIONS}) m
"""
