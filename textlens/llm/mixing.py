"""Mixing sources to target weights by iterative proportional fitting (operator 1).

Documents fall into cells of source, language and topic.  Cell weights start
as tokens; sweeps rake them to the target marginal of one dimension after the
other until the marginals of all dimensions hold (to TOLERANCE).  Targets that
no weights meet (and such as are neared ever more slowly) leave a deviation
that stops falling: by less than FALL of itself in each of STALLS jobs running.
Sweeping ends there with a warning that names the deviation.  A document of a cell is then sampled with
probability min(1, scale * weight / tokens), the scale chosen so that the
expected tokens meet the budget, by a hash of seed and id: the same documents
on every run and after every lost executor.

Only DataFrame functions are used.  Tokens are summed per cell before
anything is shuffled; all later work is on cells, whose number depends on the
categories and not on the documents.  The driver sees single numbers only.

Targets: a mapping of values to shares (values of the data that it lacks share
what is left in proportion to their tokens), or a number t: shares in
proportion to tokens ** t.  Values without tokens get no share.

Defined results: null is a value of its own in each dimension; a null or blank
text has no tokens and counts as one token, so that it has a probability;
rows that repeat an id share their fate; null ids are sampled as one id; an
empty table gives an empty result; other columns pass through untouched
(those of the result's names are replaced).
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.llm.common import cut_lineage

SEED = 11
#: Production targets: flatten sources and topics, half of the tokens English.
TARGETS = {"source": 0.5, "lang": {"en": 0.5}, "topic": 0.7}
BUDGET = 0.7
SWEEPS_PER_JOB, TOLERANCE, FALL, STALLS = 2, 1e-12, 1e-3, 3
# Topic rules in order of precedence: (topic, a literal that marks it).
TOPIC_MARKS = (("tables", " | "), ("licences", "icense"), ("shouting", "!!"), ("secrets", "password="), ("mail", "@"))


def topic_of(text: str) -> Column:
    out = F.lit(None).cast("string")
    for topic, mark in reversed(TOPIC_MARKS):
        out = F.when(F.contains(F.col(text), F.lit(mark)), F.lit(topic)).otherwise(out)
    return F.when(F.col(text).isNull(), F.lit("none")).otherwise(F.coalesce(out, F.lit("prose")))


def tokens_of(text: str) -> Column:
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)), F.lit(1)).cast("long")


def uniform(id_col: str, seed: int) -> Column:
    """A number from 0 to 1 that only the id and the seed decide (52 bits of an md5)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _targets(cells: DataFrame, dim: str, target: float | dict[str, float]) -> DataFrame:
    """Cells with the target share of their value of ``dim``."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("have"))
    if isinstance(target, dict):
        given = F.lit(None).cast("double")
        for value, share in target.items():
            given = F.when(F.col(dim) == F.lit("v" + value), F.lit(float(share))).otherwise(given)
        sums = sums.withColumn("given", given)
        rest = sums.agg(F.sum("given").alias("g"), F.sum(F.when(F.col("given").isNull(), F.col("have"))).alias("h"))
        raw = F.coalesce("given", F.greatest(F.lit(0.0), 1 - F.coalesce("g", F.lit(0.0))) * F.col("have") / F.col("h"))
        sums = sums.join(F.broadcast(rest)).withColumn("raw", raw)  # one row
    else:
        sums = sums.withColumn("raw", F.pow("have", F.lit(float(target))))
    whole = sums.agg(F.sum("raw").alias("whole"))
    sums = sums.join(F.broadcast(whole)).select(dim, (F.col("raw") / F.col("whole")).alias(f"want_{dim}"))
    return cells.join(sums, dim)


def _off(cells: DataFrame, dims: list[str]) -> float | None:
    """The largest deviation of a marginal of any dimension from its target (null without cells)."""
    each = F.explode(F.array(*(F.struct(F.lit(d).alias("dim"), F.col(d).alias("value"), F.col(f"want_{d}").alias("want"))
                               for d in dims))).alias("m")
    return (cells.select("weight", each).groupBy("m.dim", "m.value").agg(F.sum("weight").alias("has"), F.first("m.want").alias("want"))
            .agg(F.max(F.abs(F.col("has") - F.col("want")))).first()[0])


def rake(cells: DataFrame, dims: list[str], sweeps: int | None = None) -> DataFrame:
    """Cells (dims, tokens, want_<dim>) with ``weight``, whose marginals meet the targets, or come as near as ``sweeps`` allow."""
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    least, stalls, done = None, 0, 0
    while stalls < STALLS and (sweeps is None or done < sweeps):
        for _ in range(SWEEPS_PER_JOB):
            for dim in dims:
                # a window reads the cells once; a join with their sums would double the plan at every step
                has = F.sum("weight").over(Window.partitionBy(dim))
                cells = cells.withColumn("has", has).withColumn("weight", F.when(
                    F.col("has") > 0, F.col("weight") * F.col(f"want_{dim}") / F.col("has")).otherwise(0.0)).drop("has")
        cells = cut_lineage(cells, "cells")
        done += SWEEPS_PER_JOB
        off = _off(cells, dims)
        if off is None or off < TOLERANCE:
            return cells
        stalls = 0 if least is None or off < least * (1 - FALL) else stalls + 1
        least = off if least is None else min(least, off)
    warnings.warn(f"mixing targets are not met: raking leaves a marginal off by {off:.3g} after {done} sweeps", RuntimeWarning, stacklevel=2)
    return cells


def calibrate(cells: DataFrame, budget: float) -> DataFrame:
    """Cells with ``p``; expected tokens are ``budget`` times all tokens (none where all weights are 0)."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    scale = None
    for _ in range(100):
        full = F.lit(False) if scale is None else F.col("weight") * F.lit(scale) >= F.col("tokens")
        r = cells.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not r[1]:
            break
        new = (budget * total - (r[0] or 0)) / r[1]
        if scale is not None and new <= scale * (1 + 1e-12):
            break
        scale = new
    p = F.least(F.lit(1.0), F.col("weight") * F.lit(float(scale or 0.0)) / F.col("tokens"))
    return cells.withColumn("p", p)


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang", topic: Column | None = None, targets: dict | None = None, budget: float = BUDGET,
        seed: int = SEED, sweeps: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with ``topic``, ``tokens``, ``p`` (probability) and ``kept``.

    ``sweeps`` bounds the raking, to compare with others of a fixed number of steps; None sweeps until the targets hold.
    """
    targets, dims = targets or TARGETS, ["source", "lang", "topic"]
    docs = docs.drop("topic", "tokens", "p", "kept")
    topic = topic_of(text_col) if topic is None else topic

    def value(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))

    keys = {"source": value(F.col(source_col)), "lang": value(F.col(lang_col)), "topic": value(topic)}
    cells = docs.select(*(k.alias(d) for d, k in keys.items()), tokens_of(text_col).alias("tokens"))
    cells = cut_lineage(cells.groupBy(*dims).agg(F.sum("tokens").alias("tokens")), "cells")
    for d in dims:
        # each target reads the cells several times: written, so that the plans stay small
        cells = cut_lineage(_targets(cells, d, targets[d]), "cells")
    cells = calibrate(rake(cells, dims, sweeps), budget)
    odds = cells.select(F.struct(*dims).alias("_cell"), "p")
    return (docs.withColumn("_cell", F.struct(*(k.alias(d) for d, k in keys.items()))).join(odds, "_cell", "left")
            .withColumn("topic", F.expr("nullif(substring(_cell.topic, 2), '')")).drop("_cell")
            .withColumn("tokens", tokens_of(text_col)).withColumn("kept", uniform(id_col, seed) < F.col("p")))
