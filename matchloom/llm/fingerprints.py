"""Document fingerprints by consistent weighted sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.session import stage

BINS = 64  # samples of a fingerprint
HASH_BITS = 26  # of a sample; six more name its bin


def _uniform(bits: Column, first: int) -> Column:
    """21 bits of a long as a number strictly between 0 and 1."""
    return (F.shiftrightunsigned(bits, first).bitwiseAND(F.lit(0x1FFFFF)) + 0.5) / float(1 << 21)


def sample(term: Column, weight: Column) -> Column:
    """The consistent sample of a weighted term, as one long that orders samples: the smaller wins.

    With r, c from Gamma(2, 1) and b uniform, all hashed from the term: k = floor(ln w / r + b),
    ln y = r (k - b), ln a = ln c - ln y - r. The high half holds ln a, the low half a hash of (term, k).
    """
    one, two = F.xxhash64(term, F.lit(1)), F.xxhash64(term, F.lit(2))
    r = -F.log(_uniform(one, 0) * _uniform(one, 21))
    c = -F.log(_uniform(one, 42) * _uniform(two, 0))
    b = _uniform(two, 21)
    k = F.floor(F.log(weight.cast("double")) / r + b)
    log_a = F.log(c) - r * (k - b) - r
    order = F.floor((log_a + 128.0) * float(1 << 23))
    return F.shiftleft(order, 32).bitwiseOR(F.xxhash64(term, k).bitwiseAND(F.lit((1 << HASH_BITS) - 1)))


def _placed(terms: DataFrame) -> DataFrame:
    """The samples of weighted terms by ``bin``.

    The first unit of a term's weight is sampled in one bin, by a hash of the term; what is beyond it is spread over all bins
    and sampled in each. So every bin holds an even share of the weight even if a few terms have most of it, while
    terms that occur once, nearly all of them, cost one sample.
    """
    heavy = F.greatest("own", "other") > 1
    place = F.explode(F.when(heavy, F.sequence(F.lit(-1), F.lit(BINS - 1))).otherwise(F.array(F.lit(-1))))
    spread = terms.select("*", place.alias("place"))
    first = F.col("place") < 0
    term = F.when(first, F.col("term")).otherwise(F.xxhash64("term", "place"))

    def weight(name: str) -> Column:
        return F.when(first, F.least(F.col(name), F.lit(1)).cast("double")).otherwise((F.col(name) - 1) / float(BINS))

    parts = spread.select(
        "doc_id", F.when(first, F.pmod(F.xxhash64("term", F.lit(3)), F.lit(BINS)).cast("int")).otherwise(F.col("place")).alias("bin"),
        term.alias("term"), weight("own").alias("own"), weight("other").alias("other"),
    )
    return parts.select("doc_id", "bin", *(
        F.when(F.col(c) > 0, sample(F.col("term"), F.col(c))).alias(c) for c in ("own", "other")
    ))


def shingles(df: DataFrame, keys: list[str], text: str, width: int) -> DataFrame:
    """``keys`` and ``term``, the hash of each run of ``width`` words; of fewer words, of all."""
    words = df.select(*keys, F.split(F.col(text), r"\s+").alias("words"))
    at = words.select(*keys, "words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))).alias("at"))
    return at.select(*keys, F.xxhash64(*(F.get("words", F.col("at") + i) for i in range(width))).alias("term"))


def successors(docs: DataFrame, id_col: str, size: Column) -> DataFrame:
    """``doc_id``, ``size`` and ``next_id``: the next smaller id, after the smallest the greatest.

    Ids are dealt out by ranges. Only the greatest id of each range is compared with other ranges.
    """
    sizes = docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(size).alias("size"))
    ranged = stage(
        sizes.repartitionByRange(F.desc("doc_id")).withColumn("part", F.spark_partition_id()), "ranges"
    )
    # One row per range, so these windows see as many rows as there are partitions.
    every = W.orderBy(F.desc("top"))
    tops = ranged.groupBy("part").agg(F.max("doc_id").alias("top")).select(
        "part", F.coalesce(F.lead("top").over(every), F.first("top").over(every)).alias("following")
    )
    within = W.partitionBy("part").orderBy(F.desc("doc_id"))
    return ranged.join(F.broadcast(tops), "part").select(
        "doc_id", "size", F.coalesce(F.lead("doc_id").over(within), "following").alias("next_id")
    )


def _likeness(left: Column, right: Column) -> Column:
    """Bins with equal samples over bins that either side fills."""
    def bins(x: Column) -> Column:
        return F.transform(x, lambda v: F.shiftrightunsigned(v, HASH_BITS))

    both = F.size(F.array_intersect(left, right)).cast("double")
    return both / F.size(F.array_union(bins(left), bins(right)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """Fingerprints of each whole text and of an edited text, and their likeness.

    Returns ``doc_id``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``. The edited text has its last third replaced by the beginning of the next
    document (descending id, after the last the first). A term is a run of ``width`` words, its weight the number
    of times it occurs. Each bin keeps the consistent weighted sample of its terms, so that bins with equal samples, over
    the bins filled on either side, estimate generalised Jaccard similarity.

    NULL texts are empty; empty texts have one empty term and equal fingerprints. Equal texts have equal
    fingerprints. Rows that share an id are one document, with the greatest of its texts; rows without an id are
    left out. A single document is its own next. Other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    chain = stage(successors(docs, id_col, F.char_length(text)), "next")
    # Both uses of the texts share one exchange on the id.
    texts = docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(text).alias("text"))
    heads = texts.join(
        chain.select(F.col("doc_id").alias("of"), "size", F.col("next_id").alias("doc_id")), "doc_id"
    ).select(F.col("of").alias("doc_id"), F.expr("substring(text, 1, int(floor(size / 3)))").alias("head"))
    edited = texts.join(heads, "doc_id").select(
        "doc_id", "text", F.char_length("text").cast("long").alias("n_chars"),
        F.expr("concat(substring(text, 1, char_length(text) - int(floor(char_length(text) / 3))),"
               " substring(head, 1, int(floor(char_length(text) / 3))))").alias("edited"),
    )
    sides = edited.select("doc_id", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")),
    )).alias("x")).select("doc_id", "x.side", "x.text")
    # Everything below is grouped by the id the texts are already dealt out by: no further exchange.
    terms = shingles(sides, ["doc_id", "side"], "text", width).groupBy("doc_id", "term").agg(
        *(F.sum((F.col("side") == side).cast("long")).alias(name) for side, name in ((0, "own"), (1, "other")))
    )
    bins = _placed(terms).groupBy("doc_id", "bin").agg(F.min("own").alias("own"), F.min("other").alias("other"))
    low = F.lit((1 << HASH_BITS) - 1)
    named = bins.select("doc_id", *(
        F.shiftleft("bin", HASH_BITS).bitwiseOR(F.col(c).bitwiseAND(low).cast("int")).alias(c) for c in ("own", "other")
    ))
    prints = named.groupBy("doc_id").agg(
        *(F.sort_array(F.collect_list(c)).alias(c) for c in ("own", "other")),
        (F.sum((F.col("own") == F.col("other")).cast("long")) / F.count("*")).alias("near_edited"),
    )
    facts = edited.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    done = stage(prints.join(facts, "doc_id"), "fingerprints")
    following = chain.select("doc_id", "next_id").join(
        done.select(F.col("doc_id").alias("next_id"), F.col("own").alias("next")), "next_id"
    )
    return done.join(following, "doc_id").select(
        "doc_id", "n_chars", "edited_sha256", _text(F.col("own")).alias("fingerprint"),
        _text(F.col("other")).alias("edited_fingerprint"), F.coalesce("near_edited", F.lit(0.0)).alias("near_edited"),
        _likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def _text(samples: Column) -> Column:
    """The samples of a fingerprint as eight hex digits each."""
    return F.lower(F.array_join(F.transform(samples, lambda v: F.lpad(F.hex(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))
