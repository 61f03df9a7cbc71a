"""URL filter: rules first, then a character language-model ratio.

A rule is a host and a path prefix and holds for the host and its subdomains;
the longest rule that fits decides.  The URLs that rules accept and reject
train two variable-order Markov models over characters: the probability of a
character after its last four, smoothed by that after its last three, and so on
down to a uniform one.  A URL without a rule is allowed if the difference of
its two log-likelihoods, a character, lies above the middle of the two classes'
means.

Scores are whole micro-nats, so that sums do not depend on the order of rows.

Defined results: a null URL or one without ``://`` has an empty host and path;
every input row yields one output row (repeated rows and null ids stay); with no
accepted or no rejected URL to train on, a URL without a rule is allowed; an
empty table gives an empty table.  Other columns of the input are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Characters of the longest context, the smoothing mass, and the uniform alphabet.
CONTEXT, MASS, ALPHABET = 4, 1.0, 256
#: Rows up to which a table of n-grams is broadcast (under 100 bytes each).
BROADCAST_ROWS = 200_000
START, END = "\u0002", "\u0003"


def parse(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null without one. rules: (verdict, ``host/path``)."""
    rule = verdict = None
    for action, text in sorted(rules, key=lambda r: -len(r[1])):
        rule_host, _, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(action)) if verdict is None else verdict.when(fits, F.lit(action))
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def _grams(texts: DataFrame) -> DataFrame:
    """A row for each character of ``s`` and its end: ``gram`` has the (padded) four before it and itself.

    The characters are a column of their own, so that they are found once a text
    and each gram takes five of them by position: linear in the text.
    """
    chars = F.concat(F.array(*[F.lit(START)] * CONTEXT), F.filter(F.split("s", ""), lambda c: c != ""), F.array(F.lit(END)))
    gram = lambda i: F.concat(*[F.get("chars", i + k) for k in range(CONTEXT + 1)])
    cut = F.transform(F.sequence(F.lit(0), F.size("chars") - CONTEXT - 1), gram)
    return texts.withColumn("chars", chars).select("id", "said", "n", F.explode(cut).alias("gram"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def gram_scores(grams: DataFrame) -> DataFrame:
    """``gram, score``: ln P_accepted - ln P_rejected of the last character, from ``gram, n_a, n_r``.

    The model is one table of counts by key: ``g`` + the last k characters, and
    ``c`` + the k - 1 before the last.
    """
    n = CONTEXT + 1
    seen = grams.filter("n_a + n_r > 0")
    keys = [F.concat(F.lit("g"), F.substring("gram", n - k + 1, k)) for k in range(1, n + 1)]
    keys += [F.concat(F.lit("c"), F.substring("gram", n - k + 1, k - 1)) for k in range(2, n + 1)]
    model = stored(seen.select(F.explode(F.array(*keys)).alias("key"), "n_a", "n_r").groupBy("key").agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r")), "url-model")
    all_a, all_r = grams.agg(F.coalesce(F.sum("n_a"), F.lit(0)), F.coalesce(F.sum("n_r"), F.lit(0))).first()
    looked = grams.select("gram", F.posexplode(F.array(*keys)).alias("j", "key")).join(_small(model, model.count()), "key", "left")
    at = lambda j, c: F.coalesce(F.max(F.when(F.col("j") == j, F.col(c))), F.lit(0)).cast("double")
    wide = looked.groupBy("gram").agg(*[at(j, f"n_{c}").alias(f"{c}{j}") for j in range(2 * n - 1) for c in "ar"])

    def log_p(c: str, total: int) -> Column:
        p = (F.col(f"{c}0") + MASS / ALPHABET) / (total + MASS)
        for k in range(2, n + 1):
            p = (F.col(f"{c}{k - 1}") + MASS * p) / (F.col(f"{c}{n + k - 2}") + MASS)
        return F.log(p)

    return wide.select("gram", F.round((log_p("a", all_a) - log_p("r", all_r)) * 1e6).cast("long").alias("score"))


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row."""
    host, path = parse(F.col("url"))
    parsed = pages.select("page_id", F.col("url").cast("string")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    parsed = stored(parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"), F.concat("host", "path").alias("s")), "urls")
    texts = parsed.groupBy("s", "said").agg(F.count("*").alias("n"))
    # a row of a gram carries this number, not the text
    texts = stored(texts.withColumn("id", F.monotonically_increasing_id()), "url-texts")
    # few bytes, many grams: the number of partitions is stated so that none are merged
    grams = _grams(texts.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id"))
    counts = stored(grams.groupBy("gram").agg(*[F.sum(F.when(F.col("said") == v, F.col("n")).otherwise(0)).alias(a) for v, a in (("allow", "n_a"), ("block", "n_r"))]), "url-grams")
    scores = stored(gram_scores(counts), "url-scores")
    each = grams.join(_small(scores, scores.count()), "gram")
    means = each.groupBy("id").agg(F.floor(F.sum("score") / F.count("*")).alias("mean"))
    scored = stored(texts.join(means, "id").select("s", "said", "n", "mean"), "url-means")
    mean = lambda v: F.sum(F.when(F.col("said") == v, F.col("mean") * F.col("n"))) / F.sum(F.when(F.col("said") == v, F.col("n")))
    mean_a, mean_r = scored.agg(mean("allow"), mean("block")).first()
    open_ = scored.filter("said is null").select("s", "mean")
    line = None if mean_a is None or mean_r is None else (mean_a + mean_r) / 2
    lm = F.lit("allow") if line is None else F.when(F.col("mean") > line, "allow").otherwise("block")
    out = parsed.join(open_, "s", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", lm).alias("verdict"))
