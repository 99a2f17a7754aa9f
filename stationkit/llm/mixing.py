"""Mixing sources to target weights by soft membership, in DataFrame functions.

1. *Posteriors.*  A labelled table names the domain of some documents.  From a
   bounded sample of it a multinomial logistic regression is fitted on text
   statistics (signs, capitals, digits, distinct words, length) and on hits in
   each domain's most telling words (lower case, without punctuation), which
   the sample gives as well.  Every document then belongs to every domain by
   its posterior.
2. *Rates.*  Each document i of n_i tokens gets a rate r_i >= 0, the expected
   number of its copies.  With posteriors p_id, domain d expects
   sum_i n_i p_id r_i tokens; its target is b_d.  Starting from r = 1, rates
   follow projected gradient descent on

       1/2 sum_d (sum_i n_i p_id r_i - b_d)^2,   r >= 0,

   with the gradient taken by token and preconditioned by the domains' Gram
   matrix G over the documents whose rate is above zero:
   r_i <- max(0, r_i - pace * p_i . G^-1 (A r - b)).  One aggregate per round
   gives the few domain sums of A r and G; the pace halves when the error
   grows.  The state is one column, written out every few rounds, so that
   plans stay short and a lost executor costs little.

Targets are shares of ``weights``; the total is set so that the ``anchor``
domain keeps its tokens.

*At most one copy.*  ``mix_once`` is for a corpus in which a document is kept
or left out: the same descent, projected onto 0 <= r <= 1.  The total aimed at
is the largest that hard membership would allow (the corpus, or the scarcest
domain over its share); soft posteriors may not reach it with rates of one at
most, and then the total, never a share, is lowered in small steps, down to
half of it; a common factor then raises the highest rate to one.  The shares reached are returned with the rates; if they are not
those asked for, a warning names them.

Defined cases: null text counts as empty, with zero tokens, and still has a
rate; documents repeat as rows and each gets its rate; texts of any length count
whole; labels that are null or
of documents that do not exist are ignored; with fewer than two labelled
domains every posterior is the share of equal parts; a domain without tokens
has no target to meet; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_each, stratified, written

#: signs that prose has few of
_SIGNS = "[#$%&*!|=<>{}~^@+/_\\\\\\[\\]]"
#: what is no part of a word of the vocabulary
_PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
STATISTICS = ("signs", "capitals", "digits", "distinct", "length", "word_length", "variety")


def _parts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = "[\\x20\\x09-\\x0D]+"
    plain = F.lower(F.translate(F.col("text"), _PUNCTUATION, " " * len(_PUNCTUATION)))
    return (docs.withColumn("text", text).withColumn("words", F.array_remove(F.split("text", blank), ""))
            .withColumn("vocabulary", F.array_remove(F.array_distinct(F.split(plain, blank)), "")))


def _statistics(df: DataFrame, telling: list[list[str]]) -> DataFrame:
    """``df`` of ``_parts`` with its tokens and features, without texts."""
    chars = F.greatest(F.length("text"), F.lit(1)).cast("double")
    count = F.greatest(F.size("words"), F.lit(1)).cast("double")
    kinds = F.size("vocabulary").cast("double")
    cols = {
        "signs": F.regexp_count("text", F.lit(_SIGNS)) / chars,
        "capitals": F.regexp_count("text", F.lit("[A-Z]")) / chars,
        "digits": F.regexp_count("text", F.lit("[0-9]")) / chars,
        "distinct": kinds / count,
        "length": F.log1p(F.size("words").cast("double")),
        "word_length": F.least(chars / count, F.lit(30.0)),
        "variety": kinds / F.sqrt(count),
        **{f"hits_{k}": (F.least(F.size(F.array_intersect("vocabulary", F.array(*map(F.lit, ws)))), F.lit(5))
                         if ws else F.lit(0)).cast("double") for k, ws in enumerate(telling)}}
    return df.select("doc_id", *([] if "domain" not in df.columns else ["domain"]),
                     F.size("words").cast("long").alias("tokens"),
                     *[c.alias(f"f_{name}") for name, c in cols.items()])


def _telling_words(sample: DataFrame, domains: list[str], words: int = 20, least: int = 8, sure: float = 2.5,
                   sure_words: int = 200) -> list[list[str]]:
    """For each domain, the words whose documents are its most by log odds:
    ``words`` of them, and up to ``sure_words`` of log odds above ``sure``, as
    a corpus of several languages has telling words in each."""
    seen = (sample.select("domain", F.explode("vocabulary").alias("word"))
            .groupBy("word").pivot("domain", domains).count().na.fill(0))
    sizes = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    out = []
    for d in domains:
        rest = max(1, sum(n for k, n in sizes.items() if k != d))
        other = reduce(lambda a, b: a + b, [F.col(f"`{k}`") for k in domains if k != d])
        odds = F.log((F.col(f"`{d}`") + 0.5) / (max(1, sizes.get(d, 0)) + 1)) - F.log((other + 0.5) / (rest + 1))
        enough = min(least, max(2, sizes.get(d, 0) // 4))  # few rows of a domain have few repeated words
        rows = (seen.where((F.col(f"`{d}`") >= enough) & (odds > 1.0)).select("word", F.round(odds, 6).alias("odds"))
                .orderBy(F.desc("odds"), "word").limit(sure_words).collect())
        out.append([r["word"] for k, r in enumerate(rows) if k < words or r["odds"] > sure])
    return out


def posteriors(docs: DataFrame, labelled: DataFrame, per_domain: int = 1500, max_rows: int = 8000) -> tuple:
    """``(table, domains)``: ``doc_id, tokens, p`` for every row of ``docs``,
    p an array of posteriors in the order of ``domains``.  The regression learns
    from up to ``per_domain`` rows of each domain, fewer of each when all would
    be more than ``max_rows``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    known = labelled.where("doc_id is not null and domain is not null").select("doc_id", "domain").distinct()
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    domains = sorted(sizes)
    if len(domains) > 1:
        each = rows_each(per_domain, max_rows, len(domains))
        chosen = stratified(known, "domain", list(sizes.items()), each, "mixing")  # ids and names
        rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        found = [(r["domain"], r["count"]) for r in rows.groupBy("domain").count().collect()]
        sample = written(_parts(stratified(rows, "domain", found, each, "mixing")), "labelled")
        present = {r["domain"] for r in sample.select("domain").distinct().collect()}
    if len(domains) < 2 or len(present) < 2:
        domains = domains or ["all"]
        equal = F.array(*[F.lit(1.0 / len(domains))] * len(domains))
        return (_statistics(_parts(docs.select("doc_id", "text")), [])
                .select("doc_id", "tokens", equal.alias("p")), domains)
    domains = sorted(present)
    telling = _telling_words(sample, domains)
    names = [f"f_{s}" for s in STATISTICS] + [f"f_hits_{k}" for k in range(len(domains))]
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("double") - 1
    weight = F.create_map(*[F.lit(x) for r in sample.groupBy("domain").count().collect()
                            for x in (r["domain"], sizes[r["domain"]] / r["count"])])
    fit = written(assembler.transform(_statistics(sample, telling))
                  .select("features", number.alias("label"), weight[F.col("domain")].alias("weight")), "features")
    model = LogisticRegression(family="multinomial", maxIter=60, regParam=1e-4, weightCol="weight").fit(fit.coalesce(1))
    scored = model.transform(assembler.transform(_statistics(_parts(docs.select("doc_id", "text")), telling)))
    return scored.select("doc_id", "tokens", vector_to_array("probability").alias("p")), domains


def _updated(rate: Column, step: np.ndarray) -> Column:
    """One projected step along the documents' posteriors."""
    move = reduce(lambda a, b: a + b, [F.col("p")[d] * float(s) for d, s in enumerate(step)])
    return F.greatest(F.lit(0.0), rate - move)


def descent_step(gram: np.ndarray, miss: np.ndarray, live: np.ndarray) -> np.ndarray:
    """The domains' shares of one step: the residual ``miss``, preconditioned
    by the Gram matrix of the documents that are free to move."""
    out = np.zeros(len(miss))
    g = gram[np.ix_(live, live)]
    size = np.trace(g) / max(1, len(g))
    if size > 0:
        out[live] = np.linalg.solve(g + 1e-6 * size * np.eye(len(g)), miss[live])
    return np.round(out, 12)


def fit_rates(table: DataFrame, targets: np.ndarray, rounds: int = 30, tolerance: float = 1e-4,
              write_every: int = 6) -> DataFrame:
    """``table`` (``doc_id, tokens, p``) with its ``rate``: projected gradient
    descent until every domain's expected tokens are within ``tolerance`` of
    its target, or ``rounds`` are over."""
    d = len(targets)
    n = F.col("tokens").cast("double")
    p = [F.col("p")[k] for k in range(d)]
    own = np.array([x or 0.0 for x in table.agg(*[F.sum(n * p[k]) for k in range(d)]).first()])
    live = own > 0
    state, rate, pending, pace, before = table.withColumn("rate", F.lit(1.0)), F.col("rate"), 0, 1.0, np.inf
    if not live.any():
        return state
    for _ in range(rounds):
        now = state.select("tokens", "p", rate.alias("rate"))
        free = n * (F.col("rate") > 0).cast("double")
        sums = np.array(now.agg(*[F.sum(n * p[k] * F.col("rate")) for k in range(d)],
                                *[F.sum(free * p[j] * p[k]) for j in range(d) for k in range(d)]).first(), float)
        miss = np.where(live, sums[:d] - targets, 0.0)
        if (np.abs(miss) <= tolerance * np.maximum(targets, 1.0)).all():
            break
        loss = float((miss ** 2 / np.where(live, own, 1.0)).sum())
        pace = pace / 2 if loss > before else min(1.0, pace * 1.5)
        before = loss
        rate, pending = _updated(rate, pace * descent_step(sums[d:].reshape(d, d), miss, live)), pending + 1
        if pending == write_every:
            state, rate, pending = written(state.withColumn("rate", rate), "rates"), F.col("rate"), 0
    return state.withColumn("rate", rate)


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], anchor: str,
        per_domain: int = 1500, rounds: int = 30) -> tuple:
    """``(table, domains)``: ``doc_id, tokens, p, rate`` for every row.
    ``labelled`` has ``doc_id, domain``; domains without a weight get none."""
    scored, domains = posteriors(docs, labelled, per_domain)
    scored = written(scored, "posteriors")
    totals = scored.agg(*[F.sum(F.col("tokens") * F.col("p")[k]) for k in range(len(domains))]).first()
    share = np.array([weights.get(k, 0.0) for k in domains])
    if anchor in domains and weights.get(anchor, 0) > 0:
        at = domains.index(anchor)
        total = (totals[at] or 0.0) / share[at]
    else:  # nothing to hold on to: the corpus keeps its size
        share = share if share.sum() else np.ones(len(domains))
        total = sum(x or 0.0 for x in totals) / share.sum()
    return fit_rates(scored, share * total, rounds), domains


#: totals tried by ``mix_once``, as shares of what hard membership would allow
TOTALS = (1.0, 0.98, 0.96, 0.93, 0.9, 0.85, 0.8, 0.7, 0.6, 0.5)


def _clipped(rate: Column, step: np.ndarray) -> Column:
    """One step along the documents' posteriors, projected onto 0..1."""
    return F.least(F.lit(1.0), _updated(rate, step))


def _descend_once(state: DataFrame, targets: np.ndarray, miss: np.ndarray, live: np.ndarray, rounds: int,
                  tolerance: float, write_every: int) -> tuple:
    """``(state, sums, met)``: projected gradient descent in 0..1 from the rates
    of ``state``, whose domain sums miss the targets by ``miss``."""
    d, n, rate, pending, pace = len(targets), F.col("tokens").cast("double"), F.col("rate"), 0, 1.0
    p = [F.col("p")[k] for k in range(d)]
    losses: list[float] = []
    sums = targets + miss
    for _ in range(rounds):
        down = reduce(lambda a, b: a + b, [p[k] * float(m) for k, m in enumerate(miss)])  # above zero: the rate falls
        free = ((F.col("rate") > 0) & (F.col("rate") < 1)) | ((F.col("rate") >= 1) & (down > 0)) | ((F.col("rate") <= 0) & (down < 0))
        now = state.select("tokens", "p", rate.alias("rate"))
        row = now.agg(*[F.sum(n * p[k] * F.col("rate")) for k in range(d)],
                      *[F.sum(F.when(free, n * p[j] * p[k]).otherwise(0.0)) for j in range(d) for k in range(d)]).first()
        found = np.array([x or 0.0 for x in row], float)
        sums, miss = found[:d], np.where(live, found[:d] - targets, 0.0)
        if (np.abs(miss) <= tolerance * targets.sum()).all():
            return state.withColumn("rate", rate), sums, True
        loss = float(np.square(miss).sum())
        if len(losses) >= 5 and loss > 0.9 * losses[-5]:
            break  # as near as the posteriors come
        pace = pace / 2 if losses and loss > losses[-1] else min(1.0, pace * 1.5)
        losses.append(loss)
        rate, pending = _clipped(rate, pace * descent_step(found[d:].reshape(d, d), miss, live)), pending + 1
        if pending == write_every:
            state, rate, pending = written(state.withColumn("rate", rate), "rates"), F.col("rate"), 0
    return written(state.withColumn("rate", rate), "rates"), sums, False


def fit_once(table: DataFrame, share: np.ndarray, rounds: int = 30, tolerance: float = 2e-4,
             write_every: int = 6) -> DataFrame:
    """``table`` (``doc_id, tokens, p``) with a ``rate`` in 0..1 whose expected
    tokens have the shares ``share``, and ``shares``, the ones reached."""
    d = len(share)
    own = np.array([x or 0.0 for x in table.agg(
        *[F.sum(F.col("tokens") * F.col("p")[k]) for k in range(d)]).first()])
    share = np.where(own > 0, share, 0.0)
    state, sums = table.withColumn("rate", F.lit(1.0)), own
    if share.sum():  # else nothing to hold on to: every document stays
        share = share / share.sum()
        wanted, live = share > 0, own > 0
        most = min(own.sum(), float((own[wanted] / share[wanted]).min()))
        first = None
        for part in TOTALS:
            targets = share * most * part
            state, sums, met = _descend_once(state, targets, np.where(live, sums - targets, 0.0), live, rounds, tolerance,
                                             write_every)
            if met:  # a common factor leaves the shares as they are: the highest rate becomes one
                state = written(state, "rates")
                top = state.where("tokens > 0").agg(F.max("rate")).first()[0] or 1.0
                state = state.withColumn("rate", F.least(F.lit(1.0), F.col("rate") / float(top)))
                break
            first = first or (state, sums)
        else:
            state, sums = first
            warnings.warn(f"mixing: shares {share.round(4).tolist()} are out of the posteriors' reach, "
                          f"{(sums / max(sums.sum(), 1e-300)).round(4).tolist()} are reached", stacklevel=2)
    reached = sums / sums.sum() if sums.sum() else sums
    return state.withColumn("shares", F.array(*[F.lit(float(x)) for x in reached]))


def mix_once(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], per_domain: int = 1500) -> tuple:
    """``(table, domains)`` as of ``mix``, no rate above one, and ``shares``."""
    scored, domains = posteriors(docs, labelled, per_domain)
    return fit_once(written(scored, "posteriors"), np.array([weights.get(k, 0.0) for k in domains])), domains


def chosen_copies(rate: Column, *key: Column) -> Column:
    """Copies of a document: the rate rounded up or down by a hash of ``key``,
    so that its expectation is the rate."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), *key), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + draw).cast("int")
