"""Homomorphic multiset fingerprints of texts: wide vectors hashed from paragraphs, summed modulo 2^64.

A paragraph's vector has two parts. ``EXACT_LANES`` lanes are hashes of the whole paragraph: their sums are
equal for equal multisets of paragraphs. ``SIGN_LANES`` more hold the sums over the paragraph's features (runs of three words) of
two bits each, 32 bits apart: seen as signs, their scalar product estimates how many features two texts
share. Sums do not depend on order, and adding or taking away a paragraph's vector inserts or deletes it.

Sums modulo 2^64 come from sums of the low and high halves, and counters of signs have 32 bits; neither can overflow below
2^31 rows of a text, so the result does not depend on how the engine treats overflow. Only built-in functions are used; the paragraphs of a
text are summed where its rows are after one exchange, with partial sums before it.

Defined results: null and empty texts have one empty paragraph and no feature; likeness of two texts without
features is 1 if their fingerprints are equal, else 0; repeated rows and ids have results of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innlake.llm.workspace import saved

EXACT_LANES = 4
SIGN_LANES = 32
RUN = 3
_HALF = 0xFFFFFFFF
_SIGNS = 0x0000000100000001


def _words(text: Column) -> Column:
    return F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " ", -1)


def paragraphs(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _halves(lane: Column, name: str) -> list[Column]:
    return [F.sum(lane.bitwiseAND(F.lit(_HALF))).alias(f"{name}_low"), F.sum(F.shiftrightunsigned(lane, 32)).alias(f"{name}_high")]


def _joined(name: str) -> Column:
    """(low + high * 2^32) modulo 2^64."""
    high = (F.col(f"{name}_high") + F.shiftrightunsigned(F.col(f"{name}_low"), 32)).bitwiseAND(F.lit(_HALF))
    return F.shiftleft(high, 32).bitwiseOR(F.col(f"{name}_low").bitwiseAND(F.lit(_HALF)))


def fingerprints(texts: DataFrame, key_cols: list[str], text_col: str = "text") -> DataFrame:
    """(keys, lanes array<long>, features long): the summed vectors of every text and its number of features."""
    parts = texts.select(*key_cols, F.explode(paragraphs(F.col(text_col))).alias("part"))
    words = _words(F.col("part"))
    rows = parts.select(*key_cols, "part", words.alias("w"))
    runs = F.arrays_zip(*([F.col("w")] + [F.slice("w", k + 1, F.greatest(F.size("w") - k, F.lit(0))) for k in range(1, RUN)]))
    spread = rows.select(*key_cols, F.posexplode(runs).alias("_nth", "run"), "part").select(
        *key_cols, F.when(F.col("_nth") == 0, F.col("part")).alias("part"), F.when(F.col("part") != "", F.xxhash64("run")).alias("feature"))
    exact = [F.when(F.col("part").isNotNull(), F.xxhash64(F.lit(k), "part")).otherwise(F.lit(0).cast("long")) for k in range(EXACT_LANES)]

    def sign(k: int) -> Column:
        """Two lanes share a hash: its bits 0 and 32, and its bits 16 and 48."""
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(k // 2), "feature"), 16 * (k % 2)).bitwiseAND(F.lit(_SIGNS))
        return F.when(F.col("feature").isNotNull(), bits).otherwise(F.lit(0).cast("long"))

    sums = [x for k, lane in enumerate(exact) for x in _halves(lane, f"e{k}")] + [F.sum(sign(k)).alias(f"s{k}") for k in range(SIGN_LANES)]
    lanes = [_joined(f"e{k}") for k in range(EXACT_LANES)] + [F.col(f"s{k}") for k in range(SIGN_LANES)]
    return spread.groupBy(*key_cols).agg(*sums, F.count("feature").alias("features")).select(
        *key_cols, F.array(*lanes).alias("lanes"), "features")


def digest(lanes: Column) -> Column:
    """The fingerprint as lowercase hex."""
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def plus(a: Column, b: Column) -> Column:
    """Lanes of the union of two multisets; sums modulo 2^64 without overflow."""
    def add(x, y):
        low = x.bitwiseAND(F.lit(_HALF)) + y.bitwiseAND(F.lit(_HALF))
        high = F.shiftrightunsigned(x, 32) + F.shiftrightunsigned(y, 32) + F.shiftrightunsigned(low, 32)
        return F.shiftleft(high.bitwiseAND(F.lit(_HALF)), 32).bitwiseOR(low.bitwiseAND(F.lit(_HALF)))

    return F.zip_with(a, b, add)


def minus(a: Column, b: Column) -> Column:
    """Lanes after taking the multiset b out of a."""
    return plus(plus(a, F.transform(b, lambda x: F.bitwise_not(x))), F.transform(b, lambda x: F.lit(1).cast("long")))


def likeness(a: Column, a_features: Column, b: Column, b_features: Column) -> Column:
    """Estimated cosine of the feature multisets, 0 to 1, from the fingerprints; exactly 1 for equal ones."""
    def signed(lanes: Column, n: Column) -> Column:
        lane = lambda x, k: 2 * F.shiftrightunsigned(x, 32 * k).bitwiseAND(F.lit(_HALF)) - n
        return F.flatten(F.transform(F.slice(lanes, EXACT_LANES + 1, SIGN_LANES), lambda x: F.array(*(lane(x, k).cast("double") for k in range(2)))))

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)

    x, y = signed(a, a_features), signed(b, b_features)
    norm = F.sqrt(total(F.transform(x, lambda v: v * v)) * total(F.transform(y, lambda v: v * v)))
    cosine = total(F.zip_with(x, y, lambda u, v: u * v)) / F.when(norm > 0, norm)
    return F.when(a == b, 1.0).otherwise(F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)), F.lit(0.0)))


RANGE_CUTS = 256


def _range_of(docs: DataFrame) -> Column:
    """A number that rises with the id and parts the rows about evenly: quantiles, and equal steps between them."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = min(parts, RANGE_CUTS)
    steps = -(-parts // cuts)
    known = docs.agg(F.percentile_approx("doc_id", [k / cuts for k in range(cuts + 1)])).first()[0]
    if not known:
        return F.lit(-1).cast("long")
    edges = F.array(*(F.lit(c).cast("long") for c in sorted(set(known))))
    at = F.size(F.filter(edges, lambda c: c < F.col("doc_id")))
    low, high = F.get(edges, at - 1), F.get(edges, at)
    inside = F.coalesce(F.floor((F.col("doc_id") - low - 1) * F.lit(steps) / F.greatest(high - low, F.lit(1))), F.lit(0))
    return F.when(F.col("doc_id").isNull(), -1).otherwise(at * steps + F.least(inside, F.lit(steps - 1))).cast("long")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next, bucket, at, next_bucket, next_at): each text with the next one's by descending id.

    Null ids come last, equal ids by text, descending; after the last comes the first. Ids are cut into ranges, each
    with a guest: the first row of the range after it, so one exchange by range is enough.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("bucket", _range_of(docs))
    tops = docs.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    around = Window.orderBy(F.desc("bucket"))  # one row per range
    tops = tops.withColumn("before", F.lag("bucket").over(around)).withColumn("last", F.min("bucket").over(Window.partitionBy()))
    tops = tops.select("bucket", "top", F.coalesce("before", "last").alias("before"))
    firsts = docs.join(F.broadcast(tops), ["bucket"]).where(F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("before", "bucket").agg(
        F.max("top").alias("doc_id"), F.max("text").alias("text"))
    guests = firsts.select("doc_id", "text", F.col("before").alias("bucket"), F.lit(1).alias("guest"), F.col("bucket").alias("from"))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("text"))
    rows = docs.withColumns({"guest": F.lit(0), "from": F.col("bucket")}).unionByName(guests)
    return rows.withColumns({
        "at": F.row_number().over(order), "next": F.lead("text").over(order),
        "next_bucket": F.lead("from").over(order), "next_guest": F.lead("guest").over(order),
    }).where("guest = 0").select(
        "doc_id", "text", "next", "bucket", "at", "next_bucket",
        F.when(F.col("next_guest") == 1, 1).otherwise(F.col("at") + 1).alias("next_at"))


def compared_with_edits(docs: DataFrame) -> DataFrame:
    """Per document: n_chars, its and its edited text's fingerprint, and likeness to the edited and the next text.

    The edit replaces the last third by the beginning of the next document.
    """
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next", F.lit(1), third))
    rows = with_next(docs).withColumn("edited", edited)
    keys = ["bucket", "at"]
    facts = ["doc_id", "next_bucket", "next_at", "n_chars", "edited_sha256"]
    rows = rows.select(*keys, "doc_id", "next_bucket", "next_at", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "text", "edited")
    prints = saved(rows.select(
        *keys, *facts, F.inline(F.array(F.struct(F.lit(False).alias("changed"), F.col("text").alias("text")), F.struct(F.lit(True).alias("changed"), F.col("edited").alias("text"))))
    ).transform(lambda df: fingerprints(df, [*keys, *facts, "changed"])))
    own = prints.where("not changed").drop("changed")
    other = prints.where("changed").select(*keys, F.col("lanes").alias("edited_lanes"), F.col("features").alias("edited_features"))
    after = own.select(F.col("bucket").alias("next_bucket"), F.col("at").alias("next_at"), F.col("lanes").alias("next_lanes"), F.col("features").alias("next_features"))
    return own.join(other, keys).join(after, ["next_bucket", "next_at"]).select(
        "doc_id", "n_chars", "edited_sha256", digest(F.col("lanes")).alias("fingerprint"), digest(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("features"), F.col("edited_lanes"), F.col("edited_features")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("features"), F.col("next_lanes"), F.col("next_features")).alias("near_next"),
    )
