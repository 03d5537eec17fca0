"""Bottom-k sketches of shingle hashes, with DataFrame functions only.

A text's fingerprint is the ``k`` least of the 64-bit hashes of its distinct
word shingles, in ascending order.  Sketches of parts merge: the k least of the
union.  Two sketches estimate resemblance (share of the merged sketch that is
in both), containment and distinct shingle counts; a sketch of fewer than k
hashes holds its whole set, then the figures are exact.

Defined cases: NULL or empty text, or text of white space, has the empty sketch
and the empty fingerprint; two empty sketches have resemblance 1, an empty and
another one 0; fewer words than a shingle make one shingle; repeated rows give
one row each; NULL ids come last in descending order; rows of one id are
ordered by hash and text; other columns are ignored; an empty table gives an
empty result; texts are sketched whole.
"""
from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_of

K = 128
SHINGLE = 5
#: parts of a group are first sketched in so many buckets of hashes
MERGE_BUCKETS = 64


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-case words of a text."""
    words = F.array_remove(F.split(F.lower(text), r"\s+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, size: int = SHINGLE) -> Column:
    """Hashes of runs of ``size`` words, given the words' hashes."""
    n = F.size(hashes)
    runs = F.transform(F.slice(hashes, 1, F.greatest(n - (size - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, size)]))
    whole = F.array(F.xxhash64(F.array_join(hashes.cast("array<string>"), " ")))
    return F.when(n >= size, runs).when(n > 0, whole).otherwise(F.expr("cast(array() as array<bigint>)"))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the two shingle sets."""
    whole = (F.size(a) < k) & (F.size(b) < k)  # then both are sets, not samples
    both = F.slice(F.sort_array(F.array_union(a, b)), F.lit(1), F.when(whole, 2 * k).otherwise(k))
    share = F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both)
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(share)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    reach = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    r, x, y = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * (x + y) / ((1 + r) * x)))


def as_string(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def merged(parts: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch a group from the sketches of its parts.

    Hashes are ranked within (group, bucket of hashes) before they are ranked
    within the group, so a group with most of the parts is spread over tasks
    and its last step sees ``MERGE_BUCKETS * k`` hashes.
    """
    rows = parts.select(*keys, F.explode(sketch).alias("_h")).distinct().withColumn("_b", F.pmod("_h", F.lit(MERGE_BUCKETS)))
    for by in ([*keys, "_b"], keys):
        rows = rows.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy("_h"))).where(F.col("_r") <= k)
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t, next_t, block, place): each text and the text of the next document
    in descending id order, after the last one the first.

    Rows are dealt into blocks of consecutive ids (bounds from one approximate
    percentile aggregate).  A block also gets a copy of the row that heads the
    next block, so every row finds its successor inside its block: one shuffle
    of the texts and no sort of the whole table in one task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).withColumn("h", F.xxhash64("t"))
    blocks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx(F.col("id").cast("double"), [i / blocks for i in range(1, blocks)], 10 * blocks)).first()[0]
    splits = [-float("inf"), *sorted(set(cuts or [0.0])), float("inf")]
    last = len(splits)
    dealt = (Bucketizer(splits=splits, inputCol="x", outputCol="b", handleInvalid="keep")
             .transform(rows.withColumn("x", F.col("id").cast("double"))))
    dealt = dealt.select("id", "t", "h", F.when(F.col("id").isNull(), last).otherwise(last - 1 - F.col("b")).cast("int").alias("block"))
    # one row a block: its first row in the order; the number of blocks is fixed above
    heads = dealt.groupBy("block").agg(F.max(F.struct("id", "h")).alias("m")).orderBy("block").collect()
    follow = [(heads[i].block, heads[(i + 1) % len(heads)].block, heads[(i + 1) % len(heads)].m.id, heads[(i + 1) % len(heads)].m.h)
              for i in range(len(heads))]
    id_type = dealt.schema["id"].dataType.simpleString()
    marks = F.broadcast(spark.createDataFrame(follow, f"into int, head int, hid {id_type}, hh long"))
    copies = (dealt.join(marks, (F.col("block") == F.col("head")) & F.col("id").eqNullSafe(F.col("hid")) & (F.col("h") == F.col("hh")))
              .select("id", "t", "h", F.col("into").alias("block"), F.lit(True).alias("copy")))
    both = dealt.withColumn("copy", F.lit(False)).union(copies)
    order = W.partitionBy("block").orderBy("copy", F.col("id").desc_nulls_last(), F.col("h").desc(), "t")
    return both.select("id", "t", "block", "copy", F.lead("t").over(order).alias("next_t"), F.row_number().over(order).alias("place"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness."""
    rows = with_next(docs, id_col, text_col)
    n = F.length("t")
    kept = n - F.floor(n / 3).cast("int")
    rows = (rows.withColumn("n_chars", n.cast("long"))
            .withColumn("edited", F.concat(F.substring(F.col("t"), F.lit(1), kept),
                                           F.substring(F.coalesce("next_t", F.lit("")), F.lit(1), n - kept))))
    rows = rows.select("id", "block", "place", "copy", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                       word_hashes(F.col("t")).alias("wt"), word_hashes(F.col("edited")).alias("we"))
    rows = rows.select("id", "block", "place", "copy", "n_chars", "edited_sha256",
                       bottom(shingle_hashes(F.col("wt")), k).alias("st"), bottom(shingle_hashes(F.col("we")), k).alias("se"))
    after = F.lead("st").over(W.partitionBy("block").orderBy("place"))
    rows = rows.withColumn("sn", after).where(~F.col("copy"))
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", as_string(F.col("st")).alias("fingerprint"),
                       as_string(F.col("se")).alias("edited_fingerprint"),
                       resemblance(F.col("st"), F.col("se"), k).alias("near_edited"),
                       resemblance(F.col("st"), F.col("sn"), k).alias("near_next"),
                       containment(F.col("st"), F.col("se"), k).alias("in_edited"),
                       distinct_count(F.col("st"), k).alias("n_shingles_est"))
