"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

Every term of a text weighs as often as it occurs. For sample k a term draws, from
its hash and k alone, r and c from Gamma(2, 1) and b from the unit interval; with
weight S its level is t = floor(ln S / r + b), and its arrival c / exp(r (t - b + 1)).
The term of least arrival is the sample. Two texts have the same sample k with the
probability of the generalised Jaccard similarity of their weights, the sum of the
smaller weights over the sum of the larger ones. An arrival is drawn for one term
and one level, so equal least arrivals are equal samples, and a fingerprint
holds 16 bits of a hash of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.llm.common import scratch_table

#: Samples of a fingerprint: a likeness has a standard error of at most 0.5 / sqrt(48) = 0.07.
SAMPLES = 48
HEX_DIGITS = 4  # of a fingerprint for each sample
#: Terms are the longest runs of other characters than ASCII white space.
BLANKS = r"[ \t\n\x0B\f\r]+"
_TOGETHER = 4  # samples whose arrivals one row of the aggregate holds


def _unit(bits: Column, shift: int, width: int) -> Column:
    """``width`` bits of a number as the middle of their cell of the open unit interval."""
    cell = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (cell.cast("double") + 0.5) * F.lit(2.0**-width)


def arrival(term: Column, sample: Column, log_weight: Sequence[Column]) -> list[Column]:
    """Logarithms of the term's arrivals for one sample, one for each weight (null for a null one)."""
    first, second = F.xxhash64(term, sample), F.xxhash64(sample, term)
    r = -F.log(_unit(first, 0, 32) * _unit(first, 32, 32))
    c = -F.log(_unit(second, 0, 21) * _unit(second, 21, 21))
    b = _unit(second, 42, 22)
    return [F.log(c) - r * (F.floor(w / r + b) - b + 1) for w in log_weight]


def weighted_samples(terms: DataFrame, *, keys: list[str], term_col: str, weights: Sequence[str], samples: int = SAMPLES, also: Sequence[str] = ()) -> DataFrame:
    """The ``keys`` and, for each column of ``weights``, a fingerprint of the same name; the largest value of each column of ``also``.

    ``terms`` has one row for each key and term (a long); a null weight, or one that
    isn't positive, takes no part. A fingerprint is a string of four hex digits for
    each sample (their number is a multiple of four), and empty if no term has a weight.
    """
    if samples < 1 or samples % _TOGETHER:
        raise ValueError(f"samples must be a positive multiple of {_TOGETHER} (got {samples})")
    logs = {w: F.when(F.col(w) > 0, F.log(F.col(w).cast("double"))) for w in weights}
    rows = terms.withColumns(logs).withColumn("__block", F.explode(F.array(*map(F.lit, range(0, samples, _TOGETHER)))))
    least = []
    for j in range(_TOGETHER):
        arrivals = arrival(F.col(term_col), F.col("__block") + j, [F.col(w) for w in weights])
        least += [F.min(a).alias(f"__{w}_{j}") for w, a in zip(weights, arrivals, strict=True)]
    largest = [F.max(c).alias(c) for c in also]
    blocks = rows.groupBy(*keys, "__block").agg(*least, *largest)

    def code(w: str) -> Column:
        of_sample = [F.lpad(F.hex(F.pmod(F.xxhash64(f"__{w}_{j}"), F.lit(1 << 16))), HEX_DIGITS, "0") for j in range(_TOGETHER)]
        return F.when(F.col(f"__{w}_0").isNotNull(), F.struct("__block", F.lower(F.concat(*of_sample)).alias("code")))

    # samples / _TOGETHER short strings a key
    parts = blocks.groupBy(*keys).agg(*(F.array_sort(F.collect_list(code(w))).alias(w) for w in weights), *largest)
    return parts.select(*keys, *also, *(F.array_join(F.col(f"{w}.code"), "").alias(w) for w in weights))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints: 1 for two empty ones, 0 if one is empty."""
    same = [(F.substring(a, HEX_DIGITS * k + 1, HEX_DIGITS) == F.substring(b, HEX_DIGITS * k + 1, HEX_DIGITS)).cast("int") for k in range(samples)]
    total = same[0]
    for s in same[1:]:
        total = total + s
    return F.when(a == b, 1.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(total / float(samples))


def text_terms(texts: DataFrame, *, keys: list[str], text_col: str) -> DataFrame:
    """``keys``, ``term`` (hash of a run of other characters than ASCII white space) and ``weight``, how often it occurs."""
    words = texts.select(*keys, F.explode(F.split(F.coalesce(text_col, F.lit("")), BLANKS)).alias("__word")).where("__word <> ''")
    return words.groupBy(*keys, F.xxhash64("__word").alias("term")).agg(F.count(F.lit(1)).alias("weight"))


def fingerprint_texts(texts: DataFrame, *, keys: list[str], text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """The ``keys`` and ``fingerprint`` of each text that has a term; texts that share a key count as one."""
    terms = text_terms(texts, keys=keys, text_col=text_col)
    return weighted_samples(terms, keys=keys, term_col="term", weights=["weight"], samples=samples).withColumnRenamed("weight", "fingerprint")


def _key(id_col: Column, text: Column) -> list[Column]:
    """Two hashes that name a document, its id and text."""
    return [F.xxhash64(F.lit(salt), id_col.isNull(), id_col, text).alias(name) for salt, name in ((1, "a"), (2, "b"))]


def _neighbours(docs: DataFrame) -> DataFrame:
    """Each different document's key, id, length and number of rows, with the keys of the next and previous one and the latter's length.

    Documents are sorted by range partitions. What crosses a partition's end is found
    in a table of one row a partition.
    """
    each = docs.groupBy("a", "b").agg(F.min("doc_id").alias("doc_id"), F.max(F.length("text")).cast("long").alias("n"), F.count(F.lit(1)).alias("copies"))
    sorted_ = each.repartitionByRange(F.col("doc_id").asc_nulls_last(), "a", "b").sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "a", "b")
    # written, so that a document's place stays what it is
    placed = scratch_table(sorted_.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "places")
    ends = placed.groupBy("part").agg(F.min_by(F.struct("a", "b"), "place").alias("first"), F.max_by(F.struct("a", "b", "n"), "place").alias("last"))
    by_part, every = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part", F.coalesce(F.lead("first").over(by_part), F.first("first").over(every)).alias("after"),
        F.coalesce(F.lag("last").over(by_part), F.last("last").over(every)).alias("before"),
    )
    inside = Window.partitionBy("part").orderBy("place")
    near = placed.select("*", F.lead(F.struct("a", "b")).over(inside).alias("next"), F.lag(F.struct("a", "b", "n")).over(inside).alias("previous"))
    near = near.join(ends, "part").withColumns({"next": F.coalesce("next", "after"), "previous": F.coalesce("previous", "before")})
    return near.select(
        "a", "b", "doc_id", "n", "copies", F.col("next.a").alias("next_a"), F.col("next.b").alias("next_b"),
        F.col("previous.a").alias("previous_a"), F.col("previous.b").alias("previous_b"), F.col("previous.n").alias("previous_n"),
    )


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for every row.

    The edited text is the whole text with its last quarter of code points (rounded down)
    replaced by as many from the start of the next document (or all that it has); the
    next one after the last is the first, in ascending order of the id. near_edited and near_next are the
    likeness of the fingerprint to those of the edited text and of the next document.

    A null text is an empty one. A null id comes after all others; documents of one id
    come in an order that their texts fix; rows that repeat id and text are one
    document and have the same result. A text without terms has an empty
    fingerprint, like 1 to another such text and 0 to any else. An only document is
    its own next one; an empty table gives no rows. Other columns aren't read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).alias("doc_id"), *_key(F.col(id_col), text), text.alias("text"))
    near = scratch_table(_neighbours(docs), "neighbours")

    # each different text once, where its key lies; what it gives to the one before moves there
    texts = docs.groupBy("a", "b").agg(F.first("text").alias("text"))
    placed = texts.join(near.select("a", "b", "n", "previous_a", "previous_b", "previous_n"), ["a", "b"])
    given = placed.select(
        F.col("previous_a").alias("a"), F.col("previous_b").alias("b"), F.substring("text", F.lit(1), F.floor(F.col("previous_n") / 4).cast("int")).alias("given")
    )
    both = placed.join(given, ["a", "b"])
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 4)).cast("int")), "given")

    # the words of both texts and the four parts of the edited one's digest, told apart by kind
    kinds = both.select("a", "b", "text", edited.alias("edited")).withColumn("digest", F.sha2("edited", 256))
    parts = [F.struct(F.lit(2 + i).alias("kind"), F.substring("digest", 16 * i + 1, 16).alias("of")) for i in range(4)]
    kinds = kinds.select("a", "b", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("of")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("of")), *parts)).alias("k"))
    words = kinds.select("a", "b", F.col("k.kind").alias("kind"), F.explode(F.split("k.of", BLANKS)).alias("word")).where("word <> ''")
    number = F.when(F.col("kind") < 2, F.xxhash64("word")).otherwise(F.conv("word", 16, -10).cast("long"))
    terms = words.groupBy("a", "b", F.greatest("kind", F.lit(1)).alias("kind"), number.alias("term")).agg(
        F.count_if(F.col("kind") == 0).alias("fingerprint"), F.count_if(F.col("kind") == 1).alias("edited_fingerprint")
    )
    terms = terms.withColumns({f"digest{i}": F.when(F.col("kind") == 2 + i, F.col("term")) for i in range(4)})
    found = weighted_samples(
        terms, keys=["a", "b"], term_col="term", weights=["fingerprint", "edited_fingerprint"], samples=samples, also=[f"digest{i}" for i in range(4)]
    )
    found = scratch_table(found, "fingerprints")

    digest = F.lower(F.concat(*(F.lpad(F.hex(f"digest{i}"), 16, "0") for i in range(4))))
    of_next = found.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), F.col("fingerprint").alias("next_fingerprint"))
    out = near.drop("previous_a", "previous_b", "previous_n").join(found, ["a", "b"]).join(of_next, ["next_a", "next_b"])
    return out.select(
        "doc_id", F.col("n").alias("n_chars"), digest.alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("row"),
    ).drop("row")
