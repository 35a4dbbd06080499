"""URL filters: allow/block rules, and boosted trees for what no rule fits.

A rule is ``host/path``; it fits that host and its subdomains if the url's
path starts with the rule's, and the longest rule wins.  Other urls get the
verdict of gradient-boosted trees on lexical features: length, depth, digit
ratio, entropy, parameter counts and statistics of the host's suffixes.  The
labelled urls are those a rule decides.  The statistics count all their rows;
the trees learn from at most ``sample`` different ones (smallest hash first,
of each label where those would all have one); with ``out_of_fold`` each has
statistics that leave out its own fold, so that no url's label is among its
features.

DataFrame functions only; the trees are Spark's own.

Cases: a null url, or one without ``://``, has empty host and path and is
judged like any other; if the labelled urls are all allowed or all blocked
that verdict holds for the rest, without labels it is ``allow``; repeated
rows get a verdict each.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.store import keep

#: (verdict, host, path) as the pages' contract has them.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
SAMPLE, SEED = 20_000, 3
#: Parts of the labelled urls, by their hash; a url is fitted with statistics of the other parts.
FOLDS = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (n, rule, verdict), or null.

    The rules, a parameter, become one map literal by host, in which every
    suffix of a url's host is looked up."""
    kind = "array<struct<path:string,n:int,rule:string,verdict:string>>"
    by_host: dict[str, list] = {}
    for verdict, h, p in rules:
        by_host.setdefault(h, []).append(F.struct(F.lit(p).alias("path"), F.lit(len(h + p)).alias("n"),
                                                  F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
    table = (F.create_map(*(x for h, r in by_host.items() for x in (F.lit(h), F.array(*r))))
             if rules else F.create_map().cast(f"map<string,{kind}>"))
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(table, s), F.array().cast(kind))))
    fits = F.filter(known, lambda r: F.startswith(path, r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["n"], r["rule"], r["verdict"])))


def _count(col: Column, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern)).cast("double")


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text)
    share = F.transform(F.array_distinct(F.split(text, "")),
                        lambda c: F.when(c != "", (n - F.length(F.replace(text, c, F.lit("")))) / n).otherwise(0.0))
    return F.coalesce(F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0)),
                      F.lit(0.0))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    size = F.greatest(F.length(text), F.lit(1))
    return {
        "length": F.length(text).cast("double"), "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"), "query_length": F.length(query).cast("double"),
        "depth": _count(path, "/[^/]+"), "labels": _count(host, r"[^.]+"), "hyphens": _count(host, "-"),
        "digit_ratio": _count(text, "[0-9]") / size, "path_digits": _count(path, "[0-9]"),
        "entropy": _entropy(text), "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
        "fragment": F.contains(text, F.lit("#")).cast("double"), "secure": F.startswith(text, F.lit("https:")).cast("double"),
        "extension": F.rlike(path, F.lit(r"\.[A-Za-z0-9]+$")).cast("double"), "slash_end": F.endswith(path, F.lit("/")).cast("double"),
    }


#: Parts of a url whose values have statistics of their own.
SUFFIXES = {"suffix": r"[^.]*$", "domain": r"[^.]*\.[^.]*$"}


def parsed(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str, url_col: str, more: Sequence[str] = ()) -> DataFrame:
    url = F.col(url_col).cast("string")
    rows = (pages.select(F.col(id_col).alias("page_id"), url.alias("url"), *more)
            .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))))
    return (rows.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
            .withColumns(lexical(F.col("url"), F.col("host"), F.col("path")))
            .withColumns({s: F.regexp_extract("host", p, 0) for s, p in SUFFIXES.items()}))


def _labelled(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str) -> DataFrame:
    """url, host, label (1: block), n (its rows) and fold of each different url
    that a rule decides."""
    url = F.col(url_col).cast("string")
    rows = (pages.select(url.alias("url"), host_of(url).alias("host"), rule_for(host_of(url), path_of(url), rules).alias("fit"))
            .where("fit IS NOT NULL"))
    return (rows.groupBy("url", "host", (F.col("fit.verdict") == "block").cast("double").alias("label"))
            .agg(F.count("*").alias("n")).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS))))


def _with_statistics(rows: DataFrame, labelled: DataFrame, out_of_fold: bool = False) -> DataFrame:
    """Smoothed share of blocked urls and the count of each suffix, as
    labelled; ``out_of_fold``: by the urls outside the row's own ``fold``."""
    for s, pattern in SUFFIXES.items():
        of_folds = labelled.groupBy(F.regexp_extract("host", pattern, 0).alias(f"_{s}"), F.col("fold").alias("f")).agg(
            F.sum(F.col("label") * F.col("n")).alias("b"), F.sum("n").alias("n"))
        stats = of_folds.groupBy(f"_{s}").agg(
            F.sum("b").alias("_b"), F.sum("n").alias("_n"),
            F.map_from_entries(F.collect_list(F.struct("f", F.struct("b", "n")))).alias("_own"))  # FOLDS entries at most
        rows = rows.join(stats, F.col(s) == F.col(f"_{s}"), "left")
        blocked, seen = (F.coalesce(F.col(f"_{c}"), F.lit(0)) for c in "bn")
        if out_of_fold:
            own = F.try_element_at("_own", "fold")
            blocked, seen = (x - F.coalesce(own[c], F.lit(0)) for x, c in ((blocked, "b"), (seen, "n")))
        rows = rows.withColumns({f"{s}_blocked": (blocked + 1) / (seen + 2), f"{s}_seen": F.log1p(seen.cast("double"))}).drop(
            f"_{s}", "_b", "_n", "_own")
    return rows


def _fitting_sample(labelled: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` different urls with their labels; both labels, if
    there are both."""
    urls = labelled.select("url", "label", "fold")
    smallest = [F.xxhash64("url"), F.col("url")]
    chosen = urls.orderBy(*smallest).limit(sample)
    if chosen.agg(F.count_distinct("label")).first()[0] > 1:
        return chosen
    share = max(1, sample // 2)
    return (urls.where("label = 0").orderBy(*smallest).limit(share)
            .union(urls.where("label = 1").orderBy(*smallest).limit(share)))


def _judge(rows: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], sample: int, rounds: int, depth: int,
           out_of_fold: bool) -> DataFrame:
    """``rows`` (as ``parsed`` gives them) with ``p_block`` of trees fitted on ``labelled``."""
    n, blocked = labelled.agg(F.count("*"), F.sum("label")).first()
    if n == 0 or blocked in (0, n):
        return rows.withColumn("p_block", F.lit(float(n > 0 and blocked == n)))
    chosen = _fitting_sample(labelled, sample)
    # only the sample is measured
    measured = parsed(chosen, rules, "fold", "url", ["label", "fold"])
    names = [*lexical(F.col("url"), F.col("host"), F.col("path")),
             *(f"{s}_{x}" for s in SUFFIXES for x in ("blocked", "seen"))]
    vector = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=SEED)
    model = trees.fit(vector.transform(_with_statistics(measured, labelled, out_of_fold)).select("features", "label"))
    scored = model.transform(vector.transform(_with_statistics(rows, labelled)))
    return scored.withColumn("p_block", vector_to_array("probability")[1])


def _verdict() -> Column:
    return F.when(F.col("p_block") > 0.5, "block").otherwise("allow")


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, sample: int = SAMPLE,
                 rounds: int = 10, depth: int = 3, id_col: str = "page_id", url_col: str = "url",
                 out_of_fold: bool = False) -> DataFrame:
    """page_id, url, host, path, rule, verdict and, where no rule fits, the
    trees' probability of ``block``.

    ``out_of_fold``: fit with statistics that a url's own label is not part
    of.  Without it, trees learn that the one labelled url of a host tells
    them all, which fits rules for whole hosts and misleads on others."""
    labelled = keep(_labelled(pages, rules, url_col), "labelled")
    judged = _judge(parsed(pages, rules, id_col, url_col), labelled, rules, sample, rounds, depth, out_of_fold)
    return judged.select(
        "page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", _verdict()).alias("verdict"),
        F.when(F.col("fit").isNull(), F.col("p_block")).alias("p_block"))


def held_out_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, sample: int = SAMPLE,
                      rounds: int = 10, depth: int = 3, parts: int = 5, url_col: str = "url",
                      out_of_fold: bool = True) -> DataFrame:
    """url, host, label, verdict, p_block of the different labelled urls of
    one host in ``parts`` (by its hash), judged as if no rule fitted, by trees
    and statistics of the other hosts."""
    labelled = keep(_labelled(pages, rules, url_col).withColumn("out", F.pmod(F.xxhash64("host"), F.lit(parts)) == 0), "labelled")
    rows = parsed(labelled.where("out"), rules, "label", "url", ["label"])
    judged = _judge(rows, labelled.where("NOT out"), rules, sample, rounds, depth, out_of_fold)
    label = F.when(F.col("label") == 1, "block").otherwise("allow")
    return judged.select("url", "host", label.alias("label"), _verdict().alias("verdict"), "p_block")


def digest(verdicts: DataFrame) -> DataFrame:
    return verdicts.select("page_id", "host", "path", "rule", "verdict")
