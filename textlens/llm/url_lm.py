"""URL filter by character language-model ratio (operator 2).

Listed rules decide what they fit.  The URLs they accept and reject teach two
character models of variable order: an order-k probability is interpolated
with the next shorter context's (Witten-Bell), down to a uniform one, so rare
contexts lean on shorter ones.  Every other URL is judged by the mean
log-likelihood difference per character of host and path, against a threshold
calibrated on rule-decided URLs that are held out of the counts.

All counts are aggregations over every URL of the table, and the models are
tables that grow with it; they are joined, never collected.  Equal URL forms
are scored once.  The driver sees a histogram of fixed size.

Defined results: a null URL or one without ``://`` has an empty host and path
and no rule, and is judged by the models like any other; without URLs of both
classes the difference is 0 and the verdict allow; rows that repeat are judged
each; null ids pass through; an empty table gives an empty result; other
columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import cut_lineage

ORDER = 4
BINS, SPAN = 400, 4.0
ALPHABET = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = "\x02", "\x03"
# The production rules.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column."""
    u = F.col(url)
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_for(rules: tuple[tuple[str, str], ...], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (null without one)."""
    rule = verdict = F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        at = r.index("/")
        fits = ((F.col(host) == r[:at]) | F.col(host).endswith("." + r[:at])) & F.col(path).startswith(r[at:])
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _level(grams: DataFrame, k: int, shorter: DataFrame | None) -> DataFrame:
    """(s, pa, pb): probability of the last character of s after its first k, in either class."""
    counts = grams.groupBy(F.expr(f"right(gram, {k + 1})").alias("s")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = counts.withColumn("h", F.expr(f"left(s, {k})"))
    seen = counts.groupBy("h").agg(F.sum("a").alias("na"), F.count_if(F.col("a") > 0).alias("ta"),
                                   F.sum("b").alias("nb"), F.count_if(F.col("b") > 0).alias("tb"))
    both = counts.join(seen, "h")
    if shorter is None:
        both = both.withColumns({"qa": F.lit(1.0 / ALPHABET), "qb": F.lit(1.0 / ALPHABET)})
    else:
        both = both.withColumn("z", F.expr(f"right(s, {k})")).join(
            shorter.select(F.col("s").alias("z"), F.col("pa").alias("qa"), F.col("pb").alias("qb")), "z")

    def mixed(x: str) -> Column:
        n, t = F.col(f"n{x}"), F.col(f"t{x}")
        return F.when(n > 0, (F.col(x) + t * F.col(f"q{x}")) / (n + t)).otherwise(F.col(f"q{x}"))

    return both.select("s", mixed("a").alias("pa"), mixed("b").alias("pb"))


def _grams(forms: DataFrame, order: int, *keep: str) -> DataFrame:
    return forms.select(*keep, F.explode(F.sequence(F.lit(1), F.length("form") - order)).alias("i"), "form").select(
        *keep, F.col("form").substr(F.col("i"), F.lit(order + 1)).alias("gram"))


def threshold(scored: DataFrame) -> float:
    """Where the mean error of the two classes is least; scored: (score, a, b) with numbers of URLs of each."""
    bin_ = F.floor((F.least(F.greatest("score", F.lit(-SPAN)), F.lit(SPAN)) + SPAN) * (BINS / (2 * SPAN)))
    rows = scored.groupBy(bin_.alias("bin")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).orderBy("bin").collect()
    a, b = sum(r["a"] for r in rows), sum(r["b"] for r in rows)
    if not a or not b:
        return 0.0
    best, at, below_a, below_b = 2.0, 0.0, 0, 0
    for r in rows:
        # everything from this bin up is allowed
        err = below_a / a + (b - below_b) / b
        if err < best:
            best, at = err, r["bin"] * (2 * SPAN / BINS) - SPAN
        below_a, below_b = below_a + r["a"], below_b + r["b"]
    return at


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES,
          order: int = ORDER) -> DataFrame:
    """One row per row of ``pages``: (page_id, host, path, rule, verdict, score, threshold)."""
    host, path = parts(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(rules)
    # numbers in paths are names, not words: a digit is a digit
    form = F.concat(F.lit(_START * order), F.regexp_replace(F.concat("host", F.translate("path", _UPPER, _LOWER)), "[0-9]", "0"),
                    F.lit(_END))
    rows = rows.withColumns({"rule": rule, "ruled": verdict, "form": form})
    forms = rows.groupBy("form").agg(F.count_if(F.col("ruled") == "allow").alias("a"),
                                     F.count_if(F.col("ruled") == "block").alias("b"))
    forms = cut_lineage(forms.withColumn("held", F.crc32(F.col("form").cast("binary")) % 5 == 0), "forms")
    taught = forms.withColumns({x: F.when(F.col("held"), 0).otherwise(F.col(x)) for x in "ab"})
    grams = cut_lineage(_grams(taught, order, "a", "b").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "grams")
    level = None
    for k in range(order + 1):
        level = _level(grams, k, level)
    ratio = level.select(F.col("s").alias("gram"), (F.log("pa") - F.log("pb")).alias("ratio"))
    scored = (_grams(forms, order, "form").join(ratio, "gram").groupBy("form").agg(F.avg("ratio").alias("score")))
    scored = cut_lineage(forms.join(scored, "form", "left").withColumn("score", F.coalesce("score", F.lit(0.0))), "scores")
    bar = threshold(scored.filter("held"))
    out = rows.join(scored.select("form", "score"), "form", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "ruled", F.when(F.col("score") >= bar, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"),
        "score", F.lit(bar).alias("threshold"))
