"""Quality rules by weak supervision, in DataFrame operations only.

Rules vote "good", "bad" or abstain on a document.  Votes are correct with
unknown probabilities, which expectation-maximisation estimates from how the
rules agree: for each rule the accuracy of its good and of its bad votes.
A document's posterior probability of being good, not an all-must-pass test,
decides.  As documents enter only through their votes, EM runs over the counts
of vote patterns: at most 3 ** rules rows, however many documents there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import documents, numbered, quoted, saved

_BLANK = r"[\x20\x09-\x0D]+"
ROUNDS = 25
SMOOTHING = 1.0
BELIEF, BELIEF_WEIGHT = 0.95, 0.5  # accuracy a rule is written for, and what that counts
MOST_GOOD, MOST_PRIOR = math.log(1.2), math.log(4.0)
ABSTAIN, GOOD, BAD = 0, 1, 2


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _only(text: Column, characters: str) -> Column:
    """How many of a set of characters a text has."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("long")


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more.

    Each window becomes one number: hash bits above, position below; sorting
    brings equal windows together.  Neighbours of equal hash bits are compared
    word by word."""
    n = F.size(words) - 2
    mask = (F.pow(F.lit(2.0), F.ceil(F.log2(n + 1.0))) - 1).cast("long")

    def covered(mask):
        window = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
            F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.bitwise_not(mask))
            .bitwiseOR(i.cast("long")))

        def place(x):
            return x.bitwiseAND(mask).cast("int")

        def same(x, y):
            bits = x.bitwiseXOR(y)
            return F.coalesce((bits >= 0) & (bits <= mask)
                              & (F.slice(words, place(x) + 1, 3) == F.slice(words, place(y) + 1, 3)), F.lit(False))

        def places(s):
            return F.sort_array(F.transform(F.filter(
                s, lambda x, i: same(x, F.get(s, i + 1)) | same(x, F.get(s, i - 1))), place))

        found = let(F.sort_array(window), places)
        return F.aggregate(found, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, p: F.struct(
            (a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"), (p + 3).alias("end")), lambda a: a["n"])

    return F.when(n >= 2, let(mask, covered)).otherwise(0).cast("long")


def statistics(text: Column) -> Column:
    """A struct of the counts that the rules look at."""

    def of_words(words):
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _only(text, "#*$%&|<>").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("lines"),
            _repeated(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: ~w.rlike(r"[\p{L}\p{N}]"))).cast("long").alias("n_signs"),
            _only(text, "A-Z").alias("n_upper"),
            _only(text, "!").alias("n_exclaim"))

    return let(F.array_remove(F.split(text, _BLANK), ""), of_words)


def _vote(bad: Column, good: Column | None = None) -> Column:
    out = F.when(bad, BAD)
    return (out if good is None else out.when(good, GOOD)).otherwise(ABSTAIN)


def rules(c=F.col) -> dict[str, Column]:
    """Votes over the counts ``c(name)``.  Thresholds are fixed values of this rule set."""
    n, chars = c("n_words"), c("word_chars")
    return {
        "length": _vote(n < 50, n >= 80),
        "word_length": _vote((chars < 3 * n) | (10 * chars > 68 * n), (10 * chars >= 40 * n) & (10 * chars <= 64 * n)),
        "symbols": _vote(10 * c("n_symbols") > n, 50 * c("n_symbols") <= n),
        "signs": _vote(10 * c("n_signs") > n, 50 * c("n_signs") <= n),
        "lines": _vote(100 * c("n_dup_lines") > 30 * c("n_lines"),
                       (c("n_lines") >= 3) & (c("n_dup_lines") == 0)),
        "repeats": _vote(100 * c("n_repeat_words") > 35 * n, 100 * c("n_repeat_words") <= 15 * n),
        "capitals": _vote(10 * c("n_upper") > 3 * chars, 10 * c("n_upper") <= chars),
        "exclaims": _vote(10 * c("n_exclaim") > 3 * n, 50 * c("n_exclaim") <= n),
    }


def _measured(df: DataFrame, text_col: str, base: list[str]) -> DataFrame:
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    s = F.col("__s")
    out = df.select(*[F.col(quoted(c)) for c in base], statistics(text).alias("__s")).select(
        *[F.col(quoted(c)) for c in base],
        *(s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols")),
        (s["lines"]["n"] - s["lines"]["d"]).cast("long").alias("n_dup_lines"),
        s["n_repeat_words"].alias("n_repeat_words"), s["lines"]["n"].cast("long").alias("n_lines"),
        s["n_signs"].alias("n_signs"), s["n_upper"].alias("n_upper"), s["n_exclaim"].alias("n_exclaim"))
    counts = F.struct(*(F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                           "n_lines", "n_signs", "n_upper", "n_exclaim")))
    pattern = let(counts, lambda c: sum((v * 3 ** j for j, v in enumerate(rules(lambda name: c[name]).values())),
                                        F.lit(0)))
    return out.withColumn("pattern", pattern.cast("int"))


def _of(pattern: Column, j: int) -> Column:
    return (F.floor(pattern / 3 ** j) % 3).cast("int")


def _log_odds(model: dict) -> Column:
    def of(pattern):
        out = F.lit(model["prior"])
        for j, by_vote in enumerate(model["votes"]):
            out = out + F.element_at(F.array(*map(F.lit, by_vote)), _of(pattern, j) + 1)
        return out

    return let(F.col("pattern"), of)


def _accuracy(right: float, n: float) -> float:
    """A vote's accuracy with the rule author's belief as half as many more votes."""
    more = BELIEF_WEIGHT * n + SMOOTHING
    return (right + BELIEF * more) / (n + more)


def _odds(p: float) -> float:
    return math.log(p / (1 - p))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> dict:
    """EM over (pattern, n): the log odds of "good" before any vote, and those
    that each rule's votes add: of a vote's estimated accuracy, none for an
    abstention.  Good votes, which most documents get from most rules, add
    MOST_GOOD at most, and the prior MOST_PRIOR.  It starts from "bad" where
    any rule says so.  A round is one aggregation to a single row."""
    n_rules = len(rules())
    any_bad = F.lit(False)
    for j in range(n_rules):
        any_bad = any_bad | (_of(F.col("pattern"), j) == BAD)
    q = F.when(any_bad, 0.05).otherwise(0.95)
    model: dict = {}
    for _ in range(rounds):
        weights = patterns.select("pattern", (F.col("n") * q).alias("g"), (F.col("n") * (1 - q)).alias("b"))
        sums = weights.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in "gb"), *(
            F.coalesce(F.sum(F.when(_of(F.col("pattern"), j) == v, F.col(c))), F.lit(0.0)).alias(f"{c}{j}{v}")
            for c in "gb" for j in range(n_rules) for v in (GOOD, BAD))).first()
        prior = math.log((sums["g"] + SMOOTHING) / (sums["b"] + SMOOTHING))
        votes = []
        for j in range(n_rules):
            (gg, gb), (bg, bb) = ((sums[f"g{j}{v}"], sums[f"b{j}{v}"]) for v in (GOOD, BAD))
            votes.append([0.0, min(MOST_GOOD, max(0.0, _odds(_accuracy(gg, gg + gb)))),
                          -max(0.0, _odds(_accuracy(bb, bg + bb)))])
        new = {"prior": min(MOST_PRIOR, max(-MOST_PRIOR, prior)), "votes": votes}
        flat = lambda m: [m["prior"], *(x for v in m["votes"] for x in v)]
        done = model and max(abs(x - y) for x, y in zip(flat(new), flat(model))) < 1e-9
        model = new
        q = 1 / (1 + F.exp(-_log_odds(model)))
        if done:
            break
    return model


def judged(df: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: the columns ``carry`` (default: all but the
    text), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, posterior, and the further counts and the vote pattern.

    A null text counts as empty: no words, so base_failed.  Repeated rows are
    judged each (and count each in the estimate).  Input columns named like an
    output column are replaced.  An empty table gives an empty result.
    """
    made = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_signs", "n_upper",
            "n_exclaim", "pattern", "base_failed", "kept", "posterior"}
    names = [c for c in (df.columns if carry is None else carry)
             if c.lower() not in made and (carry is not None or c != text_col)]
    inner, outer = numbered(names)
    src = df.select(*inner, F.col(quoted(text_col)).alias("text"))
    measured = saved(_measured(src, "text", [f"in{i}" for i in range(len(names))]), "quality-counts")
    patterns = saved(measured.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    return _decided(measured, estimate(patterns)).select(
        *outer, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior", "n_lines", "n_signs", "n_upper", "n_exclaim", "pattern")


def _decided(measured: DataFrame, model: dict) -> DataFrame:
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    posterior = 1 / (1 + F.exp(-_log_odds(model)))
    return (measured.withColumn("base_failed", failed).withColumn("posterior", posterior)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)))


def kept_documents(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules keep, whole.  Each row is written once
    with its counts beside it; the verdict, which needs the estimate over all
    rows, filters what was written, so no text is measured twice or shuffled
    and rows need no key.  A null, empty or blank text has no words and goes;
    an empty table gives an empty result."""
    row = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("__row"),
                    F.col(quoted(text_col)).alias("__text"))
    measured = saved(_measured(row, "__text", ["__row"]), "quality-rows")
    patterns = saved(measured.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    out = _decided(measured, estimate(patterns)).where("kept")
    return out.select(*[F.col("__row")[c].alias(c) for c in df.columns])


def op2_quality_rules(spark, sf_dir):
    return judged(documents(spark, sf_dir, "doc_id", "text"))
