"""URL filtering by written rules and mined association rules.

A URL's host is what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or
the end, with A-Z lower-cased; its path goes on to the next ``?``, ``#`` or the end. A
written rule (host, path, verdict) fits its host and all subdomains of it if the URL's path
begins with the rule's path; the longest rule (host and path together) that fits wins.

URLs that no written rule fits are judged by rules mined with Spark's FP-growth: a
transaction is a labelled URL's set of tokens (scheme, host and its labels, path words,
query names, suffix, fragment; no numbers) with one item for its label. Rules from a set of
tokens to a label stay if their support and confidence suffice and no rule from a part of
the tokens is as sure ("pruned"). They are matched by an inverted index: each rule stands
under its rarest token, the tokens of a URL look up the rules under them, and a rule
matches if all its tokens are there. Equal token sets are matched once. The surest matching
rule decides, ties for block; a URL without one is allowed.

Defined results: a null URL, or one without ``://``, has empty host and path and no tokens,
so no rule fits and it is allowed, unless a written rule is for the empty host. Rows stay
as they are, repeated ones too; label rows with nulls are not learned from, all others are;
without labels there are no mined rules. Other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import partitions, stored

# The written rules of the query.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: A mined rule's least share of the labelled URLs, least number of them, and least confidence.
SUPPORT, SUPPORT_ROWS, CONFIDENCE = 0.002, 10, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str = "url") -> Column:
    after = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, LOWER)


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: str = "url") -> Column:
    """The distinct tokens of a URL, each with a sign of where it stands."""
    text = F.coalesce(F.col(url), F.lit(""))
    host = host_of(url)
    words = F.filter(F.split(F.lower(path_of(url)), r"[^\p{L}]+"), lambda w: F.length(w) > 0)
    names = F.regexp_extract_all(F.lower(F.regexp_extract(text, r"(?s)\?([^#]*)", 1)),
                                 F.lit(r"(?:^|&)([^=&]+)"), F.lit(1))
    named = lambda sign, xs: F.transform(xs, lambda x: F.concat(F.lit(sign), x))
    scheme = F.lower(F.regexp_extract(text, r"\A([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    return F.when(F.instr(text, "://") > 0, F.array_distinct(F.concat(
        F.array(F.concat(F.lit("s:"), scheme), F.concat(F.lit("h:"), host)),
        named("l:", F.split(host, r"\.")), named("p:", words), named("q:", names),
        F.when(F.instr(text, "#") > 0, F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>"))))
    ).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, rows: int | None = None, support: float = SUPPORT,
         confidence: float = CONFIDENCE) -> DataFrame:
    """rule_id, tokens, key, label, confidence, support. ``labelled``: id, tokens, label.

    All labelled URLs are mined, so supports and confidences are counts of the whole table;
    as ``support`` is a share, the number of itemsets does not grow with it. A caller can ask
    for ``rows`` of them, those with the lowest hash of their id."""
    some = labelled.where("label is not null and size(tokens) > 0")
    if rows is not None:
        some = some.orderBy(F.xxhash64("id", "tokens"), "id").limit(rows)
    baskets = stored(some.select(F.concat("tokens", F.array(F.concat(F.lit("=" ), "label"))).alias("items")), "url-baskets")
    least = min(1.0, max(support, SUPPORT_ROWS / max(1, baskets.count())))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence,
                     numPartitions=partitions(labelled.sparkSession)).fit(baskets)
    rules = (model.associationRules.where(F.element_at("consequent", 1).startswith("="))
             .where(~F.exists("antecedent", lambda t: t.startswith("=")))
             .select(F.array_sort("antecedent").alias("tokens"),
                     F.substring(F.element_at("consequent", 1), 2, 1 << 20).alias("label"), "confidence", "support"))
    rules = stored(rules.withColumn("rule_id", F.xxhash64("tokens", "label")), "url-rules")
    # a rule whose tokens hold those of a shorter rule for the label that is as sure says nothing new
    part = rules.select(F.explode("tokens").alias("t"), F.col("tokens").alias("more"), "rule_id", "label",
                        F.col("confidence").alias("sure"))
    short = rules.select(F.element_at("tokens", 1).alias("t"), "tokens", F.col("label").alias("of"),
                         F.col("confidence").alias("least"))
    idle = (part.join(short, "t").where("label = of and sure <= least and size(tokens) < size(more)")
            .where(F.size(F.array_except("tokens", "more")) == 0).select("rule_id").distinct())
    kept = rules.join(idle, "rule_id", "left_anti")
    often = baskets.select(F.explode("items").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    key = (kept.select("rule_id", F.explode("tokens").alias("t")).join(often, "t")
           .groupBy("rule_id").agg(F.min(F.struct("n", "t"))["t"].alias("key")))
    return kept.join(key, "rule_id")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """set_id, label: the label of the surest rule that a token set holds. ``sets``: set_id,
    tokens, each set once."""
    looked = (sets.select("set_id", F.col("tokens").alias("all"), F.explode("tokens").alias("key"))
              .join(rules, "key").where(F.size(F.array_except("tokens", "all")) == 0))
    return (looked.groupBy("set_id").agg(F.max(F.struct("confidence", (F.col("label") == "block").alias("blocks"),
                                                        "label"))["label"].alias("label")))


def written(rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(length, rule, verdict) of the longest rule that fits host and path, or null."""
    host, path = F.col("host"), F.col("path")
    fits = []
    for h, p, verdict in rules:
        fit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        fits.append(F.when(fit, F.struct(F.lit(len(h) + len(p)).alias("n"), F.lit(h + p).alias("rule"),
                                         F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array_compact(F.array(*fits)))


def judge(pages: DataFrame, labels: DataFrame | None = None,
          rules: Sequence[tuple[str, str, str]] = RULES, rows: int | None = None,
          support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict: one row for each row of ``pages``. ``labels``:
    page_id and label (``block`` or ``allow``) of some pages, all of which are mined."""
    rows_ = stored(pages.select(F.col("page_id").cast("long").alias("page_id"), host_of().alias("host"),
                                path_of().alias("path"), tokens_of().alias("tokens"))
                   .withColumn("fit", written(rules)).withColumn("set_id", F.xxhash64("tokens")), "url-pages")
    base = rows_.select("page_id", "host", "path", "fit.rule", F.col("fit.verdict").alias("said"), "set_id")
    if labels is None:
        mined = rows_.sparkSession.createDataFrame([], "set_id long, label string")
    else:
        marked = (labels.where("page_id is not null and label is not null")
                  .select(F.col("page_id").alias("id"), "label"))
        found = mine(rows_.select(F.col("page_id").alias("id"), "tokens").join(marked, "id"), rows, support, confidence)
        open_sets = rows_.where("fit is null").groupBy("set_id").agg(F.any_value("tokens").alias("tokens"))
        mined = match(open_sets, found)
    return (base.join(mined, "set_id", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("said", "label", F.lit("allow")).alias("verdict")))
