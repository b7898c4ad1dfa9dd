"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule votes 1 (good), 0 (bad) or abstains on a document, from counts taken of its whole text.
How often each combination of votes occurs is counted once over all documents; the table has at most
3 to the number of rules rows whatever the corpus. On it expectation-maximisation estimates, per
rule, how likely a good and a bad document gets each vote, and the share of good documents. The
posterior probability of quality then decides, in place of a demand that every rule be passed.

Estimates start from rules that are mostly right, and are kept on that side, so that the two classes
cannot change places. Everything is built-in functions; texts are scanned once, for the counts, and
never shuffled. Null and empty texts have no words and fail the base.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, narrow

SPACE = r"[\x20\x09-\x0D]+"
ITERATIONS, KEPT = 12, 0.5
#: Rule, (vote 0 if, vote 1 if) over the measures as SQL; otherwise the rule abstains.
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words < 50", "n_words >= 80"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    "repeats": ("100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words < 10 * n_words"),
    "lines": ("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0"),
    "word_size": ("word_chars < 2 * n_words or word_chars > 12 * n_words",
                  "word_chars >= 3 * n_words and word_chars <= 9 * n_words"),
    "capitals": ("10 * n_capitals > 4 * n_letters", "100 * n_capitals < 15 * n_letters"),
    "sentences": ("n_stops = 0 or 60 * n_stops < n_words", "30 * n_stops >= n_words"),
}
#: Estimates start here: how likely a rule's vote is right, and the share of good documents.
RIGHT, SHARE = 0.8, 0.7
LOW, HIGH = 0.02, 0.98


def _count(pattern: str) -> Column:
    return F.length("text") - F.length(F.translate("text", pattern, ""))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts the rules read."""
    rows = narrow(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select(
        "doc_id", F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        _count("#*$%&|<>").cast("long").alias("n_symbols"),
        _count(".!?").cast("long").alias("n_stops"),
        F.length(F.regexp_replace("text", r"[^A-Z]", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace("text", r"[^A-Za-z]", "")).cast("long").alias("n_letters"))
    rows = rows.select(
        "*", F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("""case when size(words) < 4 then cast(array() as array<bigint>) else
            transform(sequence(1, size(words) - 2), i -> xxhash64(
                words[i - 1], ' ', words[i], ' ', words[i + 1])) end""").alias("grams"))
    rows = rows.select("*", F.size(F.array_distinct("grams")).alias("n_different"))
    # sorted with their places, equal windows lie side by side; their places in order then tell
    # how many words they cover: three each, less what the next one covers as well
    rows = rows.withColumn("order", F.expr("""case when n_different = size(grams) then null else
        array_sort(transform(grams, (g, i) -> struct(g as g, i as i))) end"""))
    rows = rows.withColumn("places", F.expr("""array_sort(filter(transform(order, (x, k) ->
        case when (k > 0 and order[greatest(k - 1, 0)].g = x.g)
               or (k < size(order) - 1 and order[least(k + 1, size(order) - 1)].g = x.g)
             then x.i end), i -> i is not null))"""))
    rows = rows.withColumn("n_repeat_words", F.expr("""case when order is null then 0L else
        aggregate(places, named_struct('end', -1, 'n', 0L), (s, i) -> named_struct(
            'end', i + 3, 'n', s.n + cast(i + 3 - greatest(i, s.end) as bigint)), s -> s.n) end"""))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "n_lines", "n_stops", "n_capitals", "n_letters")


def voted(measures: DataFrame, rules: dict[str, tuple[str, str]] = RULES) -> DataFrame:
    return measures.select("*", *[
        F.expr(f"case when {bad} then 0 when {good} then 1 end").alias(f"vote_{name}")
        for name, (bad, good) in rules.items()])


def posterior(names: list[str], share: float, yes: dict[str, tuple[float, float]]) -> Column:
    """Probability of good from the votes. ``yes``: P(vote 1 | good), P(vote 1 | bad) per rule."""
    good, bad = F.log(F.lit(share)), F.log(F.lit(1 - share))
    for name in names:
        vote, (p, q) = F.col(f"vote_{name}"), yes[name]
        term = lambda x: F.when(vote == 1, F.log(F.lit(x))).when(
            vote == 0, F.log(F.lit(1 - x))).otherwise(0.0)  # noqa: B023
        good, bad = good + term(p), bad + term(q)
    return 1 / (1 + F.exp(bad - good))


def fit(votes: DataFrame, names: list[str], iterations: int = ITERATIONS
        ) -> tuple[float, dict[str, tuple[float, float]]]:
    """Share of good documents and the rules' vote probabilities, by expectation-maximisation
    over the counted combinations of votes. Each step is one aggregation to a single row."""
    columns = [f"vote_{n}" for n in names]
    table = materialize(votes.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "rule-votes")
    share, yes = SHARE, dict.fromkeys(names, (RIGHT, 1 - RIGHT))
    for _ in range(iterations):
        p = posterior(names, share, yes)
        good, bad = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sums = table.withColumn("p", p).agg(
            F.sum(good).alias("good"), F.sum("n").alias("n"), *[
                F.coalesce(F.sum(F.when(F.col(c) == v, w)), F.lit(0.0)).alias(f"{c}_{v}_{k}")
                for c in columns for v in (0, 1) for k, w in (("g", good), ("b", bad))]).first()
        if not sums["n"]:
            break
        share = min(max(sums["good"] / sums["n"], LOW), HIGH)
        for name, c in zip(names, columns, strict=True):
            p, q = ((sums[f"{c}_1_{k}"] + a) / (sums[f"{c}_0_{k}"] + sums[f"{c}_1_{k}"] + 1)
                    for k, a in (("g", RIGHT), ("b", 1 - RIGHT)))
            yes[name] = (min(max(p, 0.5), HIGH), min(max(q, LOW), 0.5))
    return share, yes


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: dict[str, tuple[str, str]] = RULES, least: float = KEPT) -> DataFrame:
    """One row per document: the base counts, base_failed, the votes, posterior, kept.

    Repeated rows count each. Without documents the result is empty.
    """
    names = list(rules)
    votes = materialize(voted(measured(docs, id_col, text_col), rules), "rule-measures")
    share, yes = fit(votes, names)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return votes.withColumn("posterior", posterior(names, share, yes)).withColumn(
        "base_failed", failed).withColumn("kept", ~failed & (F.col("posterior") >= least))
