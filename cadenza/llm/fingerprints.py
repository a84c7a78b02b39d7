"""Document fingerprints: bottom-k sketches of shingle hashes, in SQL functions only.

A shingle is ``SHINGLE_WORDS`` consecutive words (runs without ASCII white
space; fewer words: the whole sequence as one; none: no shingle). Its hash is
the first 64 bits of MD5 as hex, so equal sets have equal sketches in every
engine. The sketch of a set is its k smallest hashes in order. Sketches of
parts merge: the k smallest of their union are the sketch of the whole.
From two sketches follow resemblance (share of the union's k smallest that
both have), containment and the distinct shingle counts; with at most k
shingles all three are exact.

Defined results: null text as empty; two empty sketches resemble each other
with 1, an empty and another with 0; rows of equal doc_id are ordered by
text; null doc_ids come last; an empty table gives an empty result; other
columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import texts

SHINGLE_WORDS = 5
#: Hashes a sketch keeps: the standard error of a resemblance r is sqrt(r (1 - r) / K).
K = 128
WHITE = r"[\x20\x09-\x0D]+"
#: doc_ids of one bucket of the neighbour search, and buckets of one group.
BUCKET, GROUP = 64, 4096


def words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def shingle_hashes(words_column: str, size: int = SHINGLE_WORDS) -> Column:
    """Hashes, with repeats, of a column of words (by name: it is read once per shingle)."""
    w = f"`{words_column}`"
    return F.expr(f"if(size({w}) = 0, array(), transform(sequence(1, greatest(size({w}) - {size - 1}, 1)), i -> substr(md5(concat_ws(' ', slice({w}, i, {size}))), 1, 16)))")


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: str, out: str, size: int = SHINGLE_WORDS, k: int = K) -> DataFrame:
    """``df`` with the sketch of its ``text`` column."""
    held = f"_{out}_words"
    return df.withColumn(held, words(F.coalesce(F.col(text), F.lit("")))).withColumn(out, bottom(shingle_hashes(held, size), k)).drop(held)


def as_text(sketch: Column) -> Column:
    return F.concat_ws(",", sketch)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    union = bottom(F.array_union(a, b), k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Exact below k hashes, else (k - 1) over the k-th smallest hash as a fraction."""
    last = F.conv(F.substring(F.element_at(sketch, -1), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / last)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The share of a's shingles that b has, from resemblance and the two counts."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j / (1 + j) * (na + nb) / na))


def merge_sketches(parts: DataFrame, group: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch per group from the sketches of its parts.

    The k smallest hashes are kept map-side before the shuffle (a ranked
    window with a limit), so a group of any size reaches a task as k hashes
    per map task. A group whose parts are all empty has an empty sketch.
    """
    rows = parts.select(F.col(group).alias("_group"), F.explode_outer(sketch).alias("_hash"))
    place = F.dense_rank().over(Window.partitionBy("_group").orderBy(F.col("_hash").asc_nulls_last()))
    rows = rows.withColumn("_place", place).where(F.col("_place") <= k)
    return rows.groupBy("_group").agg(F.sort_array(F.collect_set("_hash")).alias(sketch)).withColumnRenamed("_group", group)


def with_next(docs: DataFrame, k: int = K, size: int = SHINGLE_WORDS) -> DataFrame:
    """Each document with its sketch and, as ``next_text`` and ``next_sketch``, those of the document after it.

    The order is descending doc_id; the last is followed by the first. Texts
    are dealt once by buckets of doc_ids; only each bucket's first document
    goes on to the bucket before it, and buckets are ordered group by group.
    """
    at = F.floor(F.coalesce(F.col("doc_id"), F.lit(-(1 << 62))) / BUCKET)
    rows = texts(docs).withColumn("bucket", at.cast("bigint"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]

    heads = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "text"))["text"].alias("next_text"))
    ids = heads.select("bucket", F.floor(F.col("bucket") / GROUP).alias("group"))
    ids = ids.withColumn("below", F.lead("bucket").over(Window.partitionBy("group").orderBy(F.col("bucket").desc())))
    tops = ids.groupBy("group").agg(F.max("bucket").alias("top"))
    down = Window.orderBy(F.col("group").desc())
    tops = tops.withColumn("after", F.coalesce(F.lead("top").over(down), F.first("top").over(down)))
    ids = ids.join(tops, "group").select("bucket", F.coalesce("below", "after").alias("below"))
    after = ids.join(heads.withColumnRenamed("bucket", "below"), "below").select("bucket", F.col("next_text").alias("head_text"))

    dealt = with_sketch(rows.repartition("bucket"), "text", "sketch", size, k)
    own = Window.partitionBy("bucket").orderBy(*order)
    dealt = dealt.withColumn("_next", F.lead(F.struct("text", "sketch")).over(own))
    dealt = dealt.join(with_sketch(after, "head_text", "head_sketch", size, k), "bucket", "left")
    has = F.col("_next").isNotNull()
    return dealt.select(
        "doc_id", "text", "sketch",
        F.when(has, F.col("_next.text")).otherwise(F.col("head_text")).alias("next_text"),
        F.when(has, F.col("_next.sketch")).otherwise(F.col("head_sketch")).alias("next_sketch"),
    )


def fingerprints(docs: DataFrame, k: int = K, size: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses (see the module)."""
    rows = with_next(docs, k, size)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    rows = with_sketch(rows, "edited", "edited_sketch", size, k)
    return rows.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )


def _sql() -> str:
    def sketch(text: str) -> str:
        return f"list_filter(string_split_regex({text}, '{WHITE}'), lambda w: w <> '')"

    def low(w: str) -> str:
        return (
            f"CASE WHEN len({w}) = 0 THEN [] ELSE list_slice(list_sort(list_distinct(list_transform(range(1, greatest(len({w}) - {SHINGLE_WORDS - 1}, 1) + 1), "
            f"lambda i: substr(md5(array_to_string(list_slice({w}, i, i + {SHINGLE_WORDS - 1}), ' ')), 1, 16)))), 1, {K}) END"
        )

    def near(a: str, b: str) -> str:
        union = f"list_slice(list_sort(list_distinct(list_concat({a}, {b}))), 1, {K})"
        return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE CAST(len(list_intersect({union}, list_intersect({a}, {b}))) AS DOUBLE) / len({union}) END"

    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, length(text) AS n_chars,
             coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text FROM t),
e AS (SELECT *, substr(text, 1, n_chars - n_chars // 2) || substr(next_text, 1, n_chars // 2) AS edited FROM n),
w AS (SELECT doc_id, n_chars, edited, {sketch("text")} AS w1, {sketch("edited")} AS w2, {sketch("next_text")} AS w3 FROM e),
s AS (SELECT doc_id, n_chars, edited, {low("w1")} AS s1, {low("w2")} AS s2, {low("w3")} AS s3 FROM w)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(s1, ',') AS fingerprint,
       array_to_string(s2, ',') AS edited_fingerprint, {near("s1", "s2")} AS near_edited, {near("s1", "s3")} AS near_next
FROM s"""


SQL = _sql()
