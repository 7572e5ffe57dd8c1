"""Operator 4: URL filtering by association rules.

Association rules say which combinations of URL tokens go with labelled bad pages. Spark's FP-growth
mines the bad pages for every token set that MIN_URLS of them hold, however many pages there are
(an absolute support); tokens of the very same pages are mined as one item, so they don't multiply
into their combinations. Each set is then counted over all labelled pages. Rules are kept by
confidence and by the odds that chance made them, a rule that a shorter, at least as confident rule
already covers (the empty one, the share of bad labels, included) is pruned, and the rest match by an
inverted index: each rule is listed under its rarest token, and a URL looks up only the rules listed
under its own tokens.

Fixed host/path rules go before the mined ones; the longest that fits wins.

Defined results: a null or schemeless URL has empty host and path, fits no rule, has no token and
is allowed; with fewer than MIN_URLS bad labelled rows, or no others, no rule is mined and all is
allowed; repeated rows are each judged; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.session import materialize

# (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# A rule holds for MIN_URLS bad labelled pages, whatever the size of the table: one bad page says
# nothing about its whole domain. CHANCE bounds the odds that as many bad pages come together at the
# share of bad labels (ten of ten pass at any share up to a half).
MIN_CONFIDENCE, MIN_URLS, CHANCE = 0.5, 10, 1e-3
# Rules (or token sets) that may be broadcast as an index; more are joined by a shuffle.
BROADCAST_RULES = 50_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: every suffix of the host, every path segment (with ``#`` for a run of
    digits), the file extension, the keys of the query, and whether there is a fragment."""
    labels = F.filter(F.split(host, r"\."), lambda s: s != "")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
                           lambda i: F.concat(F.lit("host:"), F.array_join(
                               F.slice(labels, i, F.greatest(F.size(labels), F.lit(1))), ".")))
    segments = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""),
                           lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    extension = F.regexp_extract(path, r"\.([A-Za-z]+)$", 1)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^#?]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda p: F.split(p, "=")[0]), lambda k: k != "")
    has = F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(
        suffixes, F.transform(segments, lambda s: F.concat(F.lit("path:"), s)),
        F.when(extension != "", F.array(F.concat(F.lit("ext:"), extension)))
         .otherwise(F.array().cast("array<string>")),
        F.transform(keys, lambda k: F.concat(F.lit("key:"), k)),
        F.when(F.coalesce(url, F.lit("")).contains("#"), F.array(F.lit("fragment")))
         .otherwise(F.array().cast("array<string>"))))
    return F.array_distinct(has)


def doc_of(url: Column) -> Column:
    """The document a URL stands for: the number that its path ends in."""
    return F.regexp_extract(path_of(url), r"/([0-9]{1,18})(?:\.[A-Za-z]+)?/?$", 1).try_cast("long")


def _index(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else df


def token_groups(rows: DataFrame, min_urls: int) -> DataFrame:
    """(token, item): tokens that at least ``min_urls`` bad pages of the baskets ``rows(basket, tokens, n,
    bad)`` hold, but not all pages; tokens of the very same baskets share an ``item``, so that they
    are mined as one and do not multiply into their combinations."""
    sign = lambda seed: F.sum(F.xxhash64(F.lit(seed), "basket").cast("decimal(38,0)"))
    pages = rows.agg(F.sum("n")).scalar()
    names = (rows.select("basket", "n", "bad", F.explode("tokens").alias("token")).groupBy("token")
             .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), sign(1).alias("one"), sign(2).alias("two"))
             .where((F.col("bad") >= min_urls) & (F.col("n") < pages)))
    # the signature (two 64-bit hashes summed over the baskets) stands for the set of baskets
    return materialize(names.select("token", F.xxhash64("n", "bad", "one", "two").alias("item")), "tokens")


def frequent_sets(labelled: DataFrame, min_urls: int = MIN_URLS) -> tuple[DataFrame, DataFrame] | None:
    """((items, n, bad), (token, item)): Spark's FP-growth over the bad pages of ``labelled(tokens, bad)``
    finds every set that at least ``min_urls`` of them hold; ``n`` counts all labelled pages with it."""
    rows = (labelled.groupBy(F.array_sort("tokens").alias("tokens"))
            .agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")))
    rows = materialize(rows.withColumn("basket", F.monotonically_increasing_id()), "baskets")
    names = token_groups(rows, min_urls)
    if not names.limit(1).count():
        return None
    baskets = materialize(
        rows.select("basket", "n", "bad", F.explode("tokens").alias("token")).join(_index(names), "token")
        .groupBy("basket", "n", "bad").agg(F.array_sort(F.collect_set("item")).alias("items"))
        .groupBy("items").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .withColumn("basket", F.monotonically_increasing_id()), "baskets")
    bad_pages = baskets.where("bad > 0").select("items", F.explode(F.sequence(F.lit(1), F.col("bad").cast("int"))))
    total = baskets.agg(F.sum("bad")).first()[0]
    # an absolute support: half a page less keeps a rounded quotient from asking for one page more
    growth = FPGrowth(itemsCol="items", minSupport=min(1.0, (min_urls - 0.5) / total))
    sets = materialize(growth.fit(bad_pages.select("items")).freqItemsets
                       .select(F.array_sort("items").alias("items"), F.col("freq").alias("bad"))
                       .withColumn("set", F.monotonically_increasing_id()), "sets")
    # pages of a set: the baskets of its rarest item that hold the others as well
    held = baskets.select("n", F.col("items").alias("held"), F.explode("items").alias("item"))
    often = held.groupBy("item").agg(F.sum("n").alias("often"))
    rarest = (sets.select("set", F.col("items").alias("all"), "bad", F.explode("items").alias("item")).join(often, "item")
              .groupBy("set", "all", "bad").agg(F.min(F.struct("often", "item"))["item"].alias("item")))
    counted = (held.join(_index(rarest), "item").where(F.size(F.array_except("all", "held")) == 0)
               .groupBy("set", "all", "bad").agg(F.sum("n").alias("n")))
    return materialize(counted.select(F.col("all").alias("items"), "n", "bad"), "sets"), names


def _spell(found: DataFrame, names: DataFrame) -> DataFrame:
    """``found(items, ...)`` with ``tokens`` instead: a row for each choice of one token per item."""
    longest = found.agg(F.max(F.size("items"))).first()[0] or 0
    rows = found.withColumn("tokens", F.array().cast("array<string>"))
    for i in range(longest):  # as long as the longest rule
        rows = (rows.withColumn("item", F.get("items", F.lit(i))).join(_index(names), "item", "left")
                .withColumn("tokens", F.when(F.col("token").isNull(), F.col("tokens")).otherwise(F.array_append("tokens", F.col("token"))))
                .drop("item", "token"))
    return rows.withColumn("tokens", F.array_sort("tokens")).drop("items")


def mine_rules(labelled: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_urls: int = MIN_URLS,
               chance: float = CHANCE) -> DataFrame:
    """(rule_id, tokens, confidence, support) mined from ``labelled(tokens, bad)``; written once."""
    spark = labelled.sparkSession
    labelled = materialize(labelled.where(F.size("tokens") > 0), "labelled")
    seen = labelled.agg(F.count("*").alias("all"), F.count_if("bad").alias("bad")).first()
    mined = frequent_sets(labelled, min_urls) if min_urls <= seen.bad < seen["all"] else None
    if mined is None:
        return spark.createDataFrame([], "rule_id long, tokens array<string>, confidence double, support double")
    sets, names = mined
    # the empty rule is as confident as the share of bad labels: a rule no surer than that (lift 1) is redundant
    share, sure = seen.bad / seen["all"], F.col("confidence")
    # Chernoff's bound of the odds: exp(-n * divergence of the rule's share of bad pages from all labels')
    diverges = sure * F.log(sure / share) + F.when(sure < 1, (1 - sure) * F.log((1 - sure) / (1 - share))).otherwise(0)
    found = (sets.withColumn("confidence", F.col("bad") / F.col("n"))
             .where((sure >= min_confidence) & (sure > share) & (F.exp(-F.col("n") * diverges) <= chance))
             .select("items", "confidence", (F.col("bad") / seen["all"]).alias("support")))
    rules = materialize(found.withColumn("set", F.xxhash64("items")), "rules")
    # a rule is redundant when dropping one of its items leaves a rule at least as confident
    wider = (rules.select("set", "confidence", "items", F.explode("items").alias("i"))
             .select("set", "confidence", F.xxhash64(F.array_remove("items", F.col("i"))).alias("shorter"))
             .join(rules.select(F.col("set").alias("shorter"), F.col("confidence").alias("at_least")), "shorter")
             .where(F.col("at_least") >= F.col("confidence")).select("set").distinct())
    kept = materialize(rules.join(wider, "set", "left_anti").select("items", "confidence", "support"), "rules")
    return materialize(_spell(kept, names).select(F.xxhash64("tokens").alias("rule_id"), "tokens", "confidence", "support"), "rules")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule_id, confidence): the best rule whose tokens are all in the URL's, for each
    distinct ``urls(url, tokens)``, by an inverted index on each rule's rarest token."""
    spread = urls.select("url", "tokens").where(F.size("tokens") > 0).distinct()
    frequency = (spread.select(F.explode("tokens").alias("token")).groupBy("token")
                 .agg(F.count("*").alias("n")))
    listed = (rules.select("rule_id", F.col("tokens").alias("all"), "confidence",
                           F.explode("tokens").alias("token"))
              .join(frequency, "token")
              .groupBy("rule_id", "all", "confidence")
              .agg(F.min(F.struct("n", "token"))["token"].alias("token")))
    small = rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    index = F.broadcast(listed) if small else listed
    return (spread.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
            .where(F.size(F.array_except("all", "tokens")) == 0)
            .groupBy("url").agg(F.max(F.struct("confidence", "rule_id")).alias("best"))
            .select("url", "best.rule_id", "best.confidence"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          min_confidence: float = MIN_CONFIDENCE, min_urls: int = MIN_URLS) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, confidence) for every row of ``pages``.

    A page is labelled bad when the document that its URL names is of low quality or toxic."""
    url = F.col("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    tokens = url_tokens(url, F.col("host"), F.col("path"))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
             .withColumn("bad", (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1))
             .where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("bad")))
             .groupBy("doc_id").agg(F.max("bad").alias("bad")))
    labelled = (rows.select(doc_of(url).alias("doc_id"), tokens.alias("tokens"))
                .where(F.col("doc_id").isNotNull()).join(known, "doc_id").select("tokens", "bad"))
    mined = mine_rules(labelled, min_confidence, min_urls)
    best = matches(rows.select("url", tokens.alias("tokens")), mined)
    fixed = fixed_rule(F.col("host"), F.col("path"), rules)
    return (rows.join(best, "url", "left").withColumn("__fixed", fixed)
            .select("page_id", "host", "path", F.col("__fixed.rule").alias("rule"),
                    F.coalesce(F.col("__fixed.verdict"),
                               F.when(F.col("rule_id").isNotNull(), "block").otherwise("allow")).alias("verdict"),
                    F.col("rule_id").alias("mined_rule"), "confidence"))
