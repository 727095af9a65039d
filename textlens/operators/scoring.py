"""Scoring: a scorer protocol (U2), a linear weights-table scorer (M2, C9-C11),
whole-table labelling (M3) and ad-hoc texts (M4).

A scorer is any ``Callable[[DataFrame], DataFrame]`` that takes rows with a
cleaned ``_text`` column and a unique ``_rid`` and returns ``_rid, label,
confidence``.  There are two kinds:

* ``IteratorScorer`` plugs in any model: it is loaded once per task and scores
  Arrow batches of texts (or of what a column expression makes of them) inside
  a projection, so nothing is exploded, joined or shuffled.  ``HashedModel`` is
  the linear model that ships with it: weights in vectors of a fixed number of
  slots, so its size does not grow with the vocabulary; ``TermModel`` holds up
  to ``MAX_TERMS`` exact terms.
* ``LinearScorer`` keeps a weight table of any number of exact terms: tokens are
  exploded, joined to it as their sizes ask, and summed per row.
  ``linear_scorer`` takes it where a table has more terms than a ``TermModel`` may hold.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.constants import LABELS
from textlens.functions.text import N_SLOTS, SLOT_BITS, clean_text, hashed_slots, with_bigrams, word_tokens
from textlens.session import cut_lineage

Scorer = Callable[[DataFrame], DataFrame]


def tokens_of(cleaned: Column) -> Column:
    return word_tokens(F.lower(cleaned))


def softmax_argmax(logits: Sequence[Column], labels: Sequence[str] = LABELS) -> tuple[Column, Column]:
    """Label of the largest logit (ties -> lowest id) and its probability."""
    m = F.greatest(*logits) if len(logits) > 1 else logits[0]
    exps = [F.exp(x - m) for x in logits]
    denom = sum(exps[1:], exps[0])
    best = F.lit(len(logits) - 1)
    for i in reversed(range(len(logits) - 1)):
        is_max = F.lit(True)
        for j in range(len(logits)):
            if j != i:
                is_max = is_max & (logits[i] >= logits[j]) if j > i else is_max & (logits[i] > logits[j])
        best = F.when(is_max, F.lit(i)).otherwise(best)
    conf = F.lit(1.0) / denom          # exp(max - max) / sum
    name = F.element_at(F.array(*[F.lit(x) for x in labels]), best + 1)
    return name, conf


SCORED = "struct<label:string,confidence:double>"


class IteratorScorer:
    """A model that is loaded once per task and asked in batches.

    ``load()`` runs in the task; ``predict(model, inputs)`` gets an Arrow array of
    ``batch`` inputs of about the same length (all of an Arrow batch where
    ``batch`` is None) and returns an (inputs x labels) array of probabilities.
    ``prepare`` makes the input of a cleaned text inside the JVM.  A null input
    never reaches the model: it is labelled null.
    """

    def __init__(self, load: Callable[[], object], predict: Callable[[object, pa.Array], np.ndarray],
                 labels: Sequence[str] = LABELS, batch: int | None = 64,
                 prepare: Callable[[Column], Column] = lambda text: text):
        self.load, self.predict, self.labels, self.batch, self.prepare = load, predict, tuple(labels), batch, prepare

    def _scored(self) -> Callable[[object, pa.Array], pa.Array]:
        predict, labels, batch = self.predict, pa.array(self.labels, pa.string()), self.batch

        def run(model, inputs: pa.Array) -> pa.Array:
            best, top = np.full(len(inputs), -1), np.zeros(len(inputs))
            size = lengths(inputs)
            # texts of one batch are about as long, so that little of it is padding; ties keep their order
            order = np.argsort(size, kind="stable")
            order = order[size[order] >= 0]
            for at in range(0, len(order), batch or max(len(order), 1)):
                rows = order[at:at + (batch or len(order))]
                p = np.asarray(predict(model, inputs.take(pa.array(rows))))
                best[rows], top[rows] = p.argmax(1), p.max(1)
            none = best < 0
            return pa.StructArray.from_arrays([labels.take(pa.array(best, mask=none)), pa.array(top, mask=none)],
                                              ["label", "confidence"])
        return run

    def column(self, text: Column) -> Column:
        """Label and confidence of a cleaned text, as one expression.

        Declared non-deterministic: a filter on the results would else be pushed below them, and through
        joins on the text, and each copy would ask the model anew.
        """
        load, run = self.load, self._scored()

        @F.arrow_udf(SCORED)
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                yield run(model, batch)
        return scored.asNondeterministic()(self.prepare(text))

    def columns(self, texts: Column) -> Column:
        """Label and confidence of each of an array of cleaned texts, without taking the array apart."""
        load, run = self.load, self._scored()

        @F.arrow_udf(f"array<{SCORED}>")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                ends = batch.offsets.to_numpy()
                yield pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), run(model, batch.flatten()))
        return scored(F.transform(F.coalesce(texts, F.array().cast("array<string>")), self.prepare))

    def __call__(self, rows: DataFrame) -> DataFrame:
        return rows.select("_rid", self.column(F.col("_text")).alias("_s")).select("_rid", "_s.label", "_s.confidence")


def lengths(inputs: pa.Array) -> np.ndarray:
    """Length of each text or list; -1 for nulls."""
    ends = np.frombuffer(inputs.buffers()[1], np.int32, len(inputs) + 1, 4 * inputs.offset) if len(inputs) else np.zeros(1, np.int32)
    return np.where(inputs.is_valid().to_numpy(zero_copy_only=False), np.diff(ends), -1)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def rows_of(slots: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of every entry of a list array."""
    ends = slots.offsets.to_numpy()
    values = slots.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    return np.repeat(np.arange(len(slots)), np.diff(ends)), values


def slots_of(tokens: pa.Array) -> pa.Array:
    """``hashed_slots`` of lists of words: each word of a batch is hashed once, however often it occurs."""
    ends = tokens.offsets.to_numpy()
    words = tokens.values.slice(ends[0], ends[-1] - ends[0]).cast(pa.binary()).dictionary_encode()
    heads = np.array([int.from_bytes(hashlib.md5(w).digest()[:3]) for w in words.dictionary.to_pylist()], np.int32)
    slots = (heads >> (24 - SLOT_BITS))[words.indices.to_numpy()] if len(heads) else heads
    return pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(slots, pa.int32()))


@dataclass
class HashedModel:
    """A linear model over hashed terms; ``weights`` is N_SLOTS x labels.

    Without ``idf`` a text's features are the counts of its words, which are
    hashed in the task, each once a batch; with it they
    are sublinear TF-IDF weights of its 1-2-grams, L2-normalised, where a slot
    of idf 0 is unknown.
    """
    weights: np.ndarray
    intercepts: np.ndarray
    idf: np.ndarray | None = None
    labels: tuple[str, ...] = LABELS
    version: str = "1"
    #: fingerprint of the split that the model was fitted on ("" = not recorded)
    trained_on: str = ""

    def features(self, text: Column) -> Column:
        tokens = tokens_of(text)
        return tokens if self.idf is None else hashed_slots(with_bigrams(tokens))

    def predict(self, slots: pa.Array) -> np.ndarray:
        row, slot = rows_of(slots_of(slots) if self.idf is None else slots)
        x = np.ones(len(slot))
        if self.idf is not None:
            row, slot, tf = counted(row, slot)
            row, slot, x = tfidf(row, slot, tf, self.idf, len(slots))
        return softmax(logits(row, slot, x, self.weights, self.intercepts, len(slots)))

    def scorer(self, spark: SparkSession) -> IteratorScorer:
        """The model as a scorer; its vectors have a fixed size (about 8 MB) and are sent to the tasks."""
        sent = spark.sparkContext.broadcast(self)
        return IteratorScorer(lambda: sent.value, lambda model, slots: model.predict(slots), self.labels, None, self.features)

    def column(self, text: Column) -> Column:
        return self.scorer(SparkSession.active()).column(text)

    def columns(self, texts: Column) -> Column:
        return self.scorer(SparkSession.active()).columns(texts)

    def __call__(self, rows: DataFrame) -> DataFrame:
        return self.scorer(rows.sparkSession)(rows)

    def save(self, spark: SparkSession, path: str) -> None:
        """Weights and idf as one row per used slot, and what belongs to the model as a whole as one row."""
        used = np.flatnonzero(np.any(self.weights != 0, 1) | (self.idf > 0 if self.idf is not None else False))
        cols = {"slot": used.astype(np.int32), **{f"w{k}": self.weights[used, k] for k in range(len(self.labels))}}
        if self.idf is not None:
            cols["idf"] = self.idf[used]
        spark.createDataFrame(pa.table(cols)).write.parquet(f"{path}/weights")
        meta = {"version": self.version, "labels": list(self.labels), "n_slots": N_SLOTS, "n_used": len(used),
                "intercepts": [float(b) for b in self.intercepts], "idf": self.idf is not None, "trained_on": self.trained_on}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HashedModel:
        """A saved model; raises where its parts do not belong together."""
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        if meta["n_slots"] != N_SLOTS:
            raise ValueError(f"the model has {meta['n_slots']} slots, this library has {N_SLOTS}")
        table = spark.read.parquet(f"{path}/weights").toArrow()        # N_SLOTS rows at most
        slot = table["slot"].to_numpy()
        if len(np.unique(slot)) != len(slot) or len(slot) != meta["n_used"]:
            raise ValueError(f"the model should have {meta['n_used']} weights, {len(slot)} were read")
        weights, idf = np.zeros((N_SLOTS, len(meta["labels"]))), np.zeros(N_SLOTS)
        for k in range(len(meta["labels"])):
            weights[slot, k] = table[f"w{k}"].to_numpy()
        if meta["idf"]:
            idf[slot] = table["idf"].to_numpy()
        return cls(weights, np.array(meta["intercepts"]), idf if meta["idf"] else None, tuple(meta["labels"]),
                   meta["version"], meta["trained_on"])


def counted(row: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, occurrences), each pair once, in order."""
    pair, n = np.unique(row.astype(np.int64) * N_SLOTS + slot, return_counts=True)
    return pair // N_SLOTS, pair % N_SLOTS, n


def tfidf(row: np.ndarray, slot: np.ndarray, tf: np.ndarray, idf: np.ndarray,
          n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, weight): sublinear tf times idf, L2-normalised by row, unknown slots left out."""
    known = idf[slot] > 0
    row, slot = row[known], slot[known]
    x = (1 + np.log(tf[known])) * idf[slot]
    norm = np.sqrt(np.bincount(row, x * x, n))
    return row, slot, x / norm[row]


def logits(row: np.ndarray, slot: np.ndarray, x: np.ndarray, weights: np.ndarray, intercepts: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(row, x * weights[slot, k], n) for k in range(weights.shape[1])], 1) + intercepts


#: Terms that a model sent to every task may hold (64 MB with three labels).
MAX_TERMS = 1 << 21


@dataclass
class TermModel:
    """A linear model over exact terms: the sorted 64-bit hashes of the terms and their weights."""
    keys: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray

    def predict(self, tokens: pa.Array) -> np.ndarray:
        row, key = rows_of(tokens)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
        return softmax(logits(row[known], at[known], 1.0, self.weights, self.intercepts, len(tokens)))


def linear_scorer(weights: DataFrame, intercepts: Sequence[float], labels: Sequence[str] = LABELS) -> Scorer:
    """The scorer of a weight table (term, w0, w1 ...): in one projection where the table is checked to hold at most
    ``MAX_TERMS`` terms, by a join with the table beyond.  Both score alike."""
    spark = weights.sparkSession
    table = LinearScorer(weights, intercepts, labels)           # written once
    if table.weights.count() > MAX_TERMS:
        return table
    got = table.weights.select(F.xxhash64("_term").alias("key"), *[f"w{k}" for k in range(len(labels))]).toArrow()
    order = np.argsort(got["key"].to_numpy())
    model = TermModel(got["key"].to_numpy()[order], np.stack([got[f"w{k}"].to_numpy()[order] for k in range(len(labels))], 1),
                      np.array([float(b) for b in intercepts]))
    sent = spark.sparkContext.broadcast(model)
    return IteratorScorer(lambda: sent.value, lambda m, tokens: m.predict(tokens), labels, None,
                          lambda text: F.transform(tokens_of(text), lambda t: F.xxhash64(t)))


class LinearScorer:
    """logit_k = b_k + sum over token occurrences of w(token, k)."""

    def __init__(self, weights: DataFrame, intercepts: Sequence[float],
                 labels: Sequence[str] = LABELS, term: str = "term"):
        self.labels = list(labels)
        self.k = len(self.labels)
        self.term = term
        cols = [f"w{i}" for i in range(self.k)]
        # the weight table is a model artifact: materialised once (checkpoint)
        self.weights = cut_lineage(weights.select(F.col(term).alias("_term"), *cols))
        self.intercepts = [float(b) for b in intercepts]

    def logits(self, rows: DataFrame) -> DataFrame:
        """Per-row sums of token weights in one pass: ``explode_outer`` keeps
        rows without tokens, the left join keeps tokens without a weight, so
        every row gets its intercepts plus whatever its known tokens add."""
        toks = rows.select("_rid", F.explode_outer(tokens_of(F.col("_text"))).alias("_term"))
        sums = toks.join(self.weights, "_term", "left").groupBy("_rid").agg(
            *[F.sum(F.coalesce(F.col(f"w{i}"), F.lit(0.0))).alias(f"_s{i}") for i in range(self.k)])
        return sums.select("_rid", *[(F.lit(self.intercepts[i]) + F.col(f"_s{i}"))
                                     .alias(f"logit_{i}") for i in range(self.k)])

    def __call__(self, rows: DataFrame) -> DataFrame:
        lg = self.logits(rows)
        name, conf = softmax_argmax([F.col(f"logit_{i}") for i in range(self.k)], self.labels)
        return lg.select("_rid", name.alias("label"), conf.alias("confidence"))


def lexicon_weights(labelled: DataFrame, text: str = "text", label: str = "label_id",
                    n_labels: int = len(LABELS), min_df: int = 2) -> tuple[DataFrame, list[float]]:
    """Log-smoothed per-class document shares of each token (a fixed, fully
    reproducible linear model used as the plugged-in scorer in tests and
    queries): w(t,k) = ln((n_tk + 1) / (n_t + k)), b_k = ln((N_k + 1) / (N + k))."""
    docs = labelled.select(F.col(label).alias("_y"),
                           F.array_distinct(tokens_of(clean_text(F.col(text)))).alias("_t"))
    # outer: a plain explode would have the tokens made once more, in a filter below the exchange
    post = docs.select("_y", F.explode_outer("_t").alias("term"))
    per = post.groupBy("term").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col("_y") == i).alias(f"_n{i}") for i in range(n_labels)])
    per = per.filter((F.col("_n") >= min_df) & F.col("term").isNotNull())
    w = per.select("term", *[F.log((F.col(f"_n{i}") + 1) / (F.col("_n") + n_labels)).alias(f"w{i}")
                             for i in range(n_labels)])
    prior = labelled.agg(F.count(F.lit(1)).alias("n"),
                         *[F.count_if(F.col(label) == i).alias(f"n{i}") for i in range(n_labels)]).first()
    b = [math.log((prior[f"n{i}"] + 1) / (prior["n"] + n_labels)) for i in range(n_labels)]
    return w, b


def lexicon_model(labelled: DataFrame, text: str = "text", label: str = "label_id", n_labels: int = len(LABELS),
                  min_df: int = 2, version: str = "lexicon-v1") -> HashedModel:
    """``lexicon_weights`` by slot instead of by term: one aggregation, N_SLOTS rows at most to the driver."""
    docs = labelled.select(F.col(label).alias("_y"), F.array_distinct(hashed_slots(F.array_distinct(tokens_of(clean_text(F.col(text)))))).alias("_s"))
    per = docs.select("_y", F.explode(F.concat(F.array(F.lit(-1)), F.coalesce("_s", F.array().cast("array<int>")))).alias("slot"))
    per = per.groupBy("slot").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_y") == i).alias(f"n{i}") for i in range(n_labels)])
    got = per.filter((F.col("n") >= min_df) | (F.col("slot") < 0)).toArrow()
    slot, n = got["slot"].to_numpy(), got["n"].to_numpy()
    share = np.stack([np.log((got[f"n{i}"].to_numpy() + 1) / (n + n_labels)) for i in range(n_labels)], 1)
    weights = np.zeros((N_SLOTS, n_labels))
    weights[slot[slot >= 0]] = share[slot >= 0]
    # slot -1 counts the rows themselves
    prior = share[slot < 0][0] if (slot < 0).any() else np.full(n_labels, math.log(1 / n_labels))
    return HashedModel(weights, prior, version=version)


def score(df: DataFrame, scorer: Scorer, text: str = "text", id_col: str | None = None,
          fill_null: bool = True) -> DataFrame:
    """M2: clean -> score -> ``label``, ``confidence`` appended to every row.

    A scorer with a column expression adds its results in place; for any other
    one, rows are scored by id and joined back.
    """
    if hasattr(scorer, "column"):
        text_col = F.coalesce(F.col(text), F.lit("")) if fill_null else F.col(text)
        scored = df.withColumn("_s", scorer.column(clean_text(text_col)))
        return scored.withColumns({"label": F.col("_s.label"), "confidence": F.col("_s.confidence")}).drop("_s")
    if id_col:
        rows = df.withColumn("_rid", F.col(id_col))
    else:
        # a generated id is written before it is used twice: evaluated again it could name another row
        rows = cut_lineage(df.withColumn("_rid", F.monotonically_increasing_id()), "scored-rows")
    src = F.coalesce(F.col(text), F.lit("")) if fill_null else F.col(text)
    rows = rows.withColumn("_text", clean_text(src))
    scored = scorer(rows.select("_rid", "_text"))
    return rows.join(scored, "_rid", "left").drop("_text")


def label_table(df: DataFrame, scorer: Scorer, text_col: str = "text",
                id_col: str | None = None, digits: int = 4) -> DataFrame:
    """M3: all rows kept, null text scored as '', confidence rounded to 4
    places; ``sentiment`` then ``confidence`` follow the input columns (an
    input column of the same name is overwritten in place)."""
    if text_col not in df.columns:
        raise ValueError(f"no text column named {text_col!r} in the table; it has {', '.join(df.columns)}")
    out = score(df, scorer, text_col, id_col, fill_null=True)
    results = {"sentiment": F.col("label"), "confidence": F.round("confidence", digits)}
    cols = [results.pop(c).alias(c) if c in results else F.col(f"`{c}`") for c in df.columns]
    cols += [expr.alias(name) for name, expr in results.items()]
    return out.select(*cols)


def predict_texts(spark: SparkSession, texts: Sequence[str], scorer: Scorer) -> DataFrame:
    """M4: ad-hoc texts -> label + confidence (unrounded)."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "pos long, text string")
    return score(df, scorer, "text", "pos").select("pos", "text", "label", "confidence")
