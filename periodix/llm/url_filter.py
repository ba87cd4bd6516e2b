"""URL filtering by association rules: FP-growth mines token combinations that go with a label, an inverted index applies them."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodix.llm.work import work_folder, written

#: A combination must be in this share of the labelled urls, and this share of its urls must have the label.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.9
#: Tokens of a rule at most. Single tokens are tried first: a longer rule must be better than every part of it.
RULE_TOKENS = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``."""
    first = F.locate("://", url)
    rest = F.when(first > 0, F.substring(url, first + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest of the ``host/path`` rules that fits, else null.

    A rule fits its host and all subdomains where the path starts with the rule's.
    """
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r)):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens(url: Column) -> Column:
    """The distinct tokens of a url, sorted: labels and ending of its host, path segments, keys of its query, fragment.

    Runs of digits count as one 0, so pages of a series share their tokens. A null url has none.
    """
    host, path = host_and_path(url)
    plain = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    labels = F.split(F.regexp_replace(plain(host), r"\.?[^.]*$", ""), r"\.")
    after = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(F.lower(plain(after)), "&"), lambda p: F.substring_index(p, "=", 1))
    tagged = lambda tag, parts: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(tag), p))
    ending = F.array(F.substring_index(plain(host), ".", -1))
    segments = F.split(F.lower(plain(path)), "/")
    fragment = F.array(F.lower(plain(F.regexp_extract(url, r"(?s)#(.*)$", 1))))
    parts = F.concat(tagged("host:", labels), tagged("end:", ending), tagged("path:", segments), tagged("query:", keys), tagged("fragment:", fragment))
    return F.array_sort(F.array_distinct(F.coalesce(parts, F.array().cast("array<string>"))))


def mine_rules(labelled: DataFrame, folder: str, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               rule_tokens: int = RULE_TOKENS) -> DataFrame:
    """Rules from (tokens, label) rows: (rule_id, tokens, label, support, confidence), written to ``folder``.

    Labels join the tokens as items of their own; frequent item sets come from Spark's FP-growth. A rule stays if no
    part of it is as confident about the same label. Rows without a label are left out; without rows there are no
    rules. A rule has ``rule_tokens`` tokens at most.

    A url of n tokens has 2**n sets, so FP-growth sees no token that can only be in rules a shorter one beats: single
    tokens are counted first, and those that go with one label alone take part in no longer rule; of tokens that the same
    urls have, one stands for all, and its rules are written out for the others again.
    """
    marked = written(labelled.where("label is not null and size(tokens) > 0").select("tokens", "label"), folder, "marked")
    each = marked.select(F.explode("tokens").alias("token"), "label", F.xxhash64("tokens").alias("url"))
    each = each.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"),
                                     F.sum(F.col("url").cast("decimal(20,0)")).alias("urls"), F.bit_xor("url").alias("mix"))
    each = written(each, folder, "tokens")
    alike = each.where("low <> high").groupBy("n", "urls", "mix").agg(F.array_sort(F.collect_set("token")).alias("alike"))
    alike = written(alike.select(F.col("alike")[0].alias("stands"), "alike"), folder, "alike")
    least = F.ceil(F.lit(min_support) * marked.count())
    sure = each.where((F.col("low") == F.col("high")) & (F.col("n") >= least))
    sure = sure.select(F.array("token").alias("tokens"), F.col("low").alias("label"), F.col("n").alias("support"), F.lit(1.0).alias("confidence"))
    numbered = marked.select("tokens", "label", F.monotonically_increasing_id().alias("row"))
    open_ = written(numbered, folder, "numbered").select("row", "label", F.explode("tokens").alias("stands")).join(alike.select("stands"), "stands")
    open_ = open_.groupBy("row", "label").agg(F.collect_set("stands").alias("stands"))
    open_ = open_.select(F.concat("stands", F.array(F.concat(F.lit("label:"), "label"))).alias("items"))
    # support counts all labelled urls, also those left without an open token
    share = min(1.0, float(-(-min_support * marked.count() // 1)) / max(1, open_.count()))
    found = FPGrowth(itemsCol="items", minSupport=share, minConfidence=1.0).fit(open_).freqItemsets
    is_label = lambda x: F.startswith(x, F.lit("label:"))
    found = found.select(F.array_sort(F.filter("items", lambda x: ~is_label(x))).alias("tokens"),
                         F.try_element_at(F.filter("items", is_label), F.lit(1)).alias("label"), "freq")
    sets = written(found.where(F.size("tokens").between(1, rule_tokens)), folder, "item-sets")
    base = sets.where("label is null").select("tokens", F.col("freq").alias("support_all"))
    scored = sets.where("label is not null").join(base, "tokens")
    scored = written(scored.select("tokens", F.substring("label", 7, 1 << 30).alias("label"), F.col("freq").alias("support"),
                                   (F.col("freq") / F.col("support_all")).alias("confidence")), folder, "scored")
    # proper parts of each rule, by the bits of a number
    size = F.size("tokens")
    masks = F.expr("sequence(1, shiftleft(1, size(tokens)) - 2)")
    long = scored.where(size > 1).select("tokens", "label", "confidence", F.explode(masks).alias("mask"))
    part = F.expr("filter(tokens, (t, i) -> shiftright(mask, i) % 2 = 1)")
    parts = long.select("tokens", "label", "confidence", part.alias("part"))
    known = scored.select(F.col("tokens").alias("part"), "label", F.col("confidence").alias("known"))
    beaten = parts.join(known, ["part", "label"]).where("known >= confidence").select("tokens", "label").distinct()
    rules = scored.where(F.col("confidence") >= min_confidence).join(beaten, ["tokens", "label"], "left_anti")
    # every way to put a like token for each
    parts = rules.select("*", F.posexplode("tokens").alias("at", "stands")).join(alike, "stands")
    parts = parts.groupBy("tokens", "label", "support", "confidence").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "alike"))), lambda p: p.alike).alias("ways"))
    ways = F.aggregate("ways", F.array(F.array().cast("array<string>")), lambda lists, more: F.flatten(
        F.transform(lists, lambda tokens: F.transform(more, lambda t: F.concat(tokens, F.array(t))))))
    rules = parts.select(F.explode(ways).alias("tokens"), "label", "support", "confidence")
    rules = rules.withColumn("tokens", F.array_sort("tokens")).unionByName(sure)
    return written(rules.select(F.xxhash64("tokens", "label").alias("rule_id"), "tokens", "label", "support", "confidence"), folder, "rules")


def match_rules(urls: DataFrame, rules: DataFrame, folder: str) -> DataFrame:
    """(tokens, verdict, confidence, evidence) for the distinct token lists of ``urls`` (a column tokens) that a rule fits.

    Inverted index: every rule is posted under its rarest token. A token list looks up its tokens' rules and keeps those
    whose other tokens it has as well; the most confident wins, then the best supported, then the longer, then by text.
    """
    lists = written(urls.select("tokens").distinct(), folder, "lists")
    words = lists.select("tokens", F.explode("tokens").alias("token"))
    often = words.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    posted = rules.select("rule_id", "label", "support", "confidence", F.col("tokens").alias("rule"), F.explode("tokens").alias("token")).join(often, "token")
    posted = posted.groupBy("rule_id", "label", "support", "confidence", "rule").agg(F.min_by("token", F.struct("often", "token")).alias("token"))
    posted = written(posted, folder, "postings")
    fits = words.join(posted, "token").where(F.forall("rule", lambda t: F.array_contains("tokens", t)))
    best = F.max(F.struct("confidence", "support", F.size("rule").alias("size"), F.array_join("rule", " ").alias("evidence"), "label"))
    return fits.groupBy("tokens").agg(best.alias("best")).select("tokens", F.col("best.label").alias("verdict"), "best.confidence", "best.evidence")


def judge(pages: DataFrame, listed: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow",
          **mining) -> DataFrame:
    """(page_id, host, path, rule, verdict, evidence, confidence) for every row of ``pages``.

    ``listed`` rules (verdict, ``host/path``) decide where one fits. The pages they decide are the labelled examples
    from which token rules are mined; these decide the other pages, with the tokens as ``evidence``; where none fits,
    the verdict is ``otherwise``. Null urls, and those without ``://``, have empty host and path and no tokens.
    Repeated rows are judged alike, an empty table gives an empty result, other columns are ignored.
    """
    folder = work_folder(pages.sparkSession)
    url = F.col(url_col)
    host, path = host_and_path(url)
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), tokens(url).alias("tokens"))
    rows = written(rows.withColumn("listed", listed_rule(F.col("host"), F.col("path"), listed)), folder, "urls")
    rules = mine_rules(rows.select("tokens", F.col("listed.verdict").alias("label")), folder, **mining)
    open_ = rows.where("listed is null")
    found = written(match_rules(open_, rules, folder), folder, "found")
    judged = rows.join(found.withColumnRenamed("verdict", "mined"), "tokens", "left")
    mined = F.col("listed").isNull()
    return judged.select("page_id", "host", "path", F.col("listed.rule").alias("rule"),
                         F.coalesce("listed.verdict", "mined", F.lit(otherwise)).alias("verdict"),
                         F.when(mined, F.col("evidence")).alias("evidence"), F.when(mined, F.col("confidence")).alias("confidence"))
