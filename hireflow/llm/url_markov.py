"""Accept or reject addresses by rules, and the rest by two character models.

Addresses that a rule decides train two smoothed variable-order Markov models, one of accepted and
one of rejected addresses: the probability of a character after a context of up to ``ORDER``
characters, mixed with that after the next shorter context in proportion to how many different
characters were seen there (Witten and Bell), down to all characters alike. An address without a
rule is scored by the log-likelihood difference per character and accepted from a threshold on.
The threshold is calibrated on labelled hosts that were kept out of training.

* Null addresses and those without "://" have an empty host and path; the model then sees the
  address as it is, null as empty.
* Without labelled addresses the models agree and everything is accepted.
* Repeated rows are judged one by one, extra columns ignored; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from hireflow.llm.shared import ascii_lower, bounded, let, whole_text, written

#: Longest context, in characters.
ORDER = 4

#: First hexadecimal digits of a host's MD5 that keep it out of training, for calibration.
HELD_OUT = ("0", "1", "2")

#: Width of the steps in which thresholds are tried.
STEP = 0.01

#: Start and end of an address.
START, END = "\x02", "\x03"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(whole_text(url), "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole_text(url), "://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def grams(url: Column) -> Column:
    """Every character of an address, and its end, after the ``ORDER`` characters before it."""
    rest = F.regexp_replace(ascii_lower(whole_text(url)), "^[a-z]*://", "")
    chars = F.concat(
        F.array(*[F.lit(START)] * ORDER),
        F.regexp_extract_all(rest, F.lit("(?s)(.)"), F.lit(1)),
        F.array(F.lit(END)),
    )
    return let(
        chars,
        lambda c: F.transform(
            F.sequence(F.lit(0), F.size(c) - ORDER - 1),
            lambda i: F.array_join(F.slice(c, i + 1, F.lit(ORDER + 1)), ""),
        ),
    )


def model(counts: DataFrame) -> DataFrame:
    """Log-likelihood difference of every gram.

    ``counts``: gram and its number in accepted and rejected addresses, 0 where it is only in others.
    """
    symbols = counts.select(F.substring("gram", ORDER + 1, 1)).distinct().count() + 1
    level = None
    for k in range(ORDER + 1):
        tail = counts.select(
            F.expr(f"right(gram, {k + 1})").alias("gram"), "allow", "block"
        )
        tail = tail.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        context = Window.partitionBy(F.expr(f"left(gram, {k})"))
        for label in ("allow", "block"):
            tail = tail.withColumn(f"{label}_n", F.sum(label).over(context)).withColumn(
                f"{label}_kinds", F.sum((F.col(label) > 0).cast("long")).over(context)
            )
        if level is None:
            tail = tail.select("*", *[F.lit(1 / symbols).alias(f"{x}_low") for x in ("allow", "block")])
        else:
            lower = level.select(
                F.col("gram").alias("low"),
                *[F.col(f"{x}_p").alias(f"{x}_low") for x in ("allow", "block")],
            )
            tail = tail.join(lower, F.expr(f"right(gram, {k})") == F.col("low"))
        level = tail.select("gram", *[_mixed(x).alias(f"{x}_p") for x in ("allow", "block")])
    return level.select("gram", (F.log("allow_p") - F.log("block_p")).alias("gain"))


def _mixed(label: str) -> Column:
    n, kinds, low = F.col(f"{label}_n"), F.col(f"{label}_kinds"), F.col(f"{label}_low")
    return F.when(n > 0, (F.col(label) + kinds * low) / (n + kinds)).otherwise(low)


def threshold(scored: DataFrame) -> float:
    """Threshold with the least balanced error on held-out addresses; 0 without both kinds.

    All thresholds between two scores have one error; the one nearest to 0 is taken.
    """
    steps = scored.groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(
        F.count_if(F.col("verdict") == "allow").alias("allow"),
        F.count_if(F.col("verdict") == "block").alias("block"),
    )
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    error = (
        F.coalesce(F.sum("allow").over(below), F.lit(0)) / F.sum("allow").over(whole)
        + F.lit(1) - F.coalesce(F.sum("block").over(below), F.lit(0)) / F.sum("block").over(whole)
    )
    both = (F.sum("allow").over(whole) > 0) & (F.sum("block").over(whole) > 0)
    lowest = F.coalesce(F.lag("step").over(Window.orderBy("step")) + 1, F.least("step", F.lit(0)))
    tried = steps.select(
        F.least("step", F.greatest(F.lit(0), lowest)).alias("step"),
        F.when(both, error).alias("error"),
    ).where("error is not null")
    best = tried.orderBy(F.round("error", 9), F.abs("step"), "step").limit(1).collect()
    return best[0]["step"] * STEP if best else 0.0


def judged(pages: DataFrame, rules: list[Rule], keep: list[str], url: str = "url") -> DataFrame:
    """``keep`` with host, path, rule, verdict and score (null where a rule decides)."""
    kept = [f"keep_{i}" for i in range(len(keep))]
    parts = pages.select(
        *[F.col(c).alias(k) for c, k in zip(keep, kept)],
        F.monotonically_increasing_id().alias("row"),
        F.col(url).alias("url"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    parts = parts.select("*", rule.alias("rule"), verdict.alias("verdict"))
    held_out = F.substring(F.md5("host"), 1, 1).isin(*HELD_OUT)
    trains = {x: (F.col("verdict") == x) & ~held_out for x in ("allow", "block")}
    counts = (
        parts.select(
            F.explode(grams(F.col("url"))).alias("gram"),
            *[F.coalesce(t, F.lit(False)).alias(x) for x, t in trains.items()],
        )
        .groupBy("gram")
        .agg(*[F.count_if(x).alias(x) for x in trains])
    )
    gains = written(model(written(counts, "url-grams")), "url-model")
    own = ["row", *kept, "host", "path", "rule", "verdict"]
    scored = (
        parts.select(*own, F.explode(grams(F.col("url"))).alias("gram"))
        .join(bounded(gains, 48), "gram")
        .groupBy(*own)
        .agg(F.avg("gain").alias("score"))
    )
    scored = written(scored, "url-scores")
    limit = threshold(scored.where(held_out & F.col("verdict").isNotNull()))
    return scored.select(
        *[F.col(k).alias(c) for k, c in zip(kept, keep)],
        "host",
        "path",
        "rule",
        F.coalesce(
            "verdict", F.when(F.col("score") >= limit, "allow").otherwise("block")
        ).alias("verdict"),
        F.when(F.col("verdict").isNull(), F.col("score")).alias("score"),
    )
