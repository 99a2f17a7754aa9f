"""Document fingerprints: bottom-k sketches of shingle hashes.

A document's shingles are its runs of ``SHINGLE`` (5) words, words being cut
at ASCII white space (fewer words: the whole sequence; none: no shingle).  A
shingle's hash is the 64-bit hash of its words' hashes.  The sketch is the
``k`` smallest distinct hashes, sorted; so sketches of parts merge into the
sketch of their union, and two sketches estimate

* resemblance: the share of the k smallest hashes of the union in both;
* containment of one in the other, from resemblance and distinct counts;
* the number of distinct shingles: exact below k, else (k - 1) over the k-th
  smallest hash as a fraction of the hash range.

Everything here is column expressions; texts stay in the JVM.

``edited_and_next`` sees each document beside its successor by id.  Rows are
dealt into ranges of ids whose bounds are quantiles of the ids themselves, so
ranges are even however the ids are spread; the first row of a range, which
the last row of the range before needs, is dealt to that one as well.  That is
one shuffle of the texts, and no global order in one task.

Defined cases: null text counts as empty; empty texts have the empty sketch,
which resembles itself fully and any other not at all; rows with a null id
come after all others; rows that repeat an id follow one another by the hash
of their text; a single row is its own successor; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
K = 64
#: rows and texts' characters of one range of ids; and the most ranges
RANGE_ROWS, RANGE_CHARS, MAX_RANGES = 500, 8_000_000, 4096


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Array of the shingles' hashes, in order, repeats included."""
    words = F.transform(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), ""), lambda w: F.xxhash64(w))
    # a one-element array, so that the words are hashed once and then referred to
    return F.flatten(F.transform(F.array(words), lambda h: (
        F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
        .when(F.size(h) < shingle, F.array(F.xxhash64(h)))
        .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - shingle, F.lit(0))),
                               lambda i: F.xxhash64(*[h[i + j] for j in range(shingle)]))))))


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, shingle))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, by: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """Sketch of the union of all parts of each group.  A group's parts are not
    gathered: each map task passes on at most k hashes of a group."""
    least = Window.partitionBy(*by).orderBy("_hash")
    return (parts.select(*by, F.explode(sketch_col).alias("_hash")).distinct()
            .withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= k)
            .groupBy(*by).agg(F.sort_array(F.collect_list("_hash")).alias(sketch_col)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of both."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        F.element_at(F.transform(F.array(merged(a, b, k)),
                                 lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b))
                                 / F.greatest(F.size(u), F.lit(1))), 1).cast("double"))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: the common ones are
    resemblance times the distinct shingles of the union."""
    union = distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k)))


def sketch_text(a: Column) -> Column:
    """The sketch's hashes, 8 bytes each, in base 64."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")))


def _range_of(column: str, bounds: list[int]) -> str:
    """SQL for the number of ``bounds`` at or below ``column``, by halving."""
    def search(lo, hi):  # the answer is in lo..hi
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {column} < {bounds[mid]}L THEN {search(lo, mid)} ELSE {search(mid + 1, hi)} END"
    return f"CASE WHEN {column} IS NULL THEN {len(bounds)} ELSE {search(0, len(bounds))} END"


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                    shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text, sketch, edited, edited_sketch, next_sketch`` per row:
    the edited text has its last quarter (rounded down) replaced by as much
    of the beginning of the next document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"),
                     F.min("doc_id").alias("least")).first()
    ranges = min(MAX_RANGES, max(1, total["n"] // RANGE_ROWS, (total["chars"] or 0) // RANGE_CHARS))
    bounds: list[int] = []
    if ranges > 1 and total["least"] is not None:
        at = [i / ranges for i in range(1, ranges)]
        found = rows.agg(F.percentile_approx("doc_id", at, F.lit(50 * MAX_RANGES))).first()[0]
        bounds = sorted({x for x in found if x > total["least"]})
    own = F.expr(_range_of("doc_id", bounds))
    dealt = F.array(F.struct(own.alias("range"), F.lit(0).alias("turn")))
    if bounds:
        dealt = F.when(F.coalesce(F.col("doc_id").isin(bounds), F.lit(False)),
                       F.concat(dealt, F.array(F.struct((own - 1).alias("range"), F.lit(1).alias("turn"))))
                       ).otherwise(dealt)
    first = F.col("doc_id").eqNullSafe(F.lit(total["least"]))
    wrap = F.struct(F.lit(len(bounds)).alias("range"), F.lit(2).alias("turn"))
    # the last row of all, with or without an id, is followed by the first
    dealt = F.when(first, F.concat(dealt, F.array(wrap))).otherwise(dealt)
    placed = (rows.withColumn("sketch", sketch(F.col("text"), k, shingle))
              .withColumn("dealt", F.explode(dealt))
              .select("doc_id", "text", "sketch", "dealt.range", "dealt.turn"))
    order = Window.partitionBy("range").orderBy("turn", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    return (placed.withColumn("next", F.lead("text").over(order))
            .withColumn("next_sketch", F.lead("sketch").over(order))
            .where("turn = 0")
            .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - quarter),
                                           F.substring(F.col("next"), F.lit(1), quarter)))
            .withColumn("edited_sketch", sketch(F.col("edited"), k, shingle))
            .select("doc_id", "text", "sketch", "edited", "edited_sketch", "next_sketch"))
