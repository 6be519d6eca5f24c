"""Near-duplicate documents by ProbMinHash, banding and verification.

A text is its set of shingles of five words, weighted by how often each occurs.
Every shingle is a Poisson process whose rate is its weight: its arrivals fall into
random registers, and a register keeps the shingle that arrived first. Two texts
agree in a register with the probability of their probability Jaccard. A shingle
stops as soon as it arrives later than every register's first arrival, so a text
costs little more than one arrival a shingle. Registers are banded, texts that
share a band are candidates, and candidates are verified on their whole shingle
sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from seasonlab.llm.bpe import slices
from seasonlab.llm.cap_filters import _grouped
from seasonlab.llm.common import bound_batches, cut, row_key, scratch_folder, scratch_table
from seasonlab.llm.components import connected_components
from seasonlab.llm.words import TOGETHER, mix, runs_of, words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: At similarity 0.8 two texts share none of the bands with a probability of 5e-8, where shingles weigh the same;
#: with all that they don't share repeated a million times, with one of 2e-4.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Rounds in which members of a bucket are compared with one of them only.
LEADER_ROUNDS = 1
#: Members of a bucket that are compared with each other in one block afterwards.
BLOCK = 512
#: Bytes of shingles that a block holds on average (a text with more is a block of its own).
BLOCK_BYTES = 4 << 20
#: Arrivals that are drawn together.
ARRIVALS = 1 << 18
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, hash, count)`` of the distinct shingles of a string column, by row and hash; a text of one to four words is one shingle."""
    words = words_of(column)
    hashes = words.hashes() if len(words.start) else np.zeros(0, np.uint64)
    counts = np.diff(np.r_[0, words.ends])
    row = np.repeat(np.arange(len(counts)), counts)
    whole = runs_of(hashes, SHINGLE_WORDS)
    inside = row[: len(whole)] == row[SHINGLE_WORDS - 1 :] if len(whole) else np.zeros(0, bool)
    rows, values = [row[: len(whole)][inside]], [whole[inside]]
    for n in range(1, SHINGLE_WORDS):
        short = np.flatnonzero(counts == n)
        if len(short):
            rows.append(short)
            values.append(mix(runs_of(hashes, n)[words.ends[short] - n] + np.uint64(n)))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]) if len(row) else np.zeros(0, int)
    return row[first], value[first], np.diff(np.r_[first, len(row)])


def signatures(row: np.ndarray, value: np.ndarray, count: np.ndarray, n_rows: int) -> np.ndarray:
    """ProbMinHash signatures, one row of REGISTERS shingles each; rows without shingles are all 0.

    A shingle's weight is 1 + log10(count) / 8, so that repeated lines count for
    more, but never so much that texts of one class share no band.
    """
    weight = 1 + np.log10(count) / 8
    arrival = np.full((n_rows, REGISTERS), np.inf).ravel()
    latest = np.full(n_rows, np.inf)
    at, time, turn, chunk = np.arange(len(row)), np.zeros(len(row)), 0, 1
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(at):
        turns = np.arange(turn + 1, turn + chunk + 1, dtype=np.uint64)
        random = mix(value[at, None] + turns * STEP)
        waits = -np.log((random >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54) / weight[at, None]
        times = time[:, None] + np.cumsum(waits, axis=1)
        register = row[at, None] * REGISTERS + (mix(random) % np.uint64(REGISTERS)).astype(np.int64)
        early = times <= latest[row[at]][:, None]
        slot, when, who = register[early], times[early], np.broadcast_to(value[at, None], times.shape)[early]
        np.minimum.at(arrival, slot, when)
        first = when <= arrival[slot]
        kept.append((slot[first], when[first], who[first]))
        latest = arrival.reshape(n_rows, REGISTERS).max(axis=1)
        time = times[:, -1]
        alive = time <= latest[row[at]]
        at, time = at[alive], time[alive]
        turn += chunk
        chunk = max(1, min(32, chunk * 2 if turn > 1 else 1, ARRIVALS // max(1, len(at))))
    out = np.zeros(n_rows * REGISTERS, np.uint64)
    for slot, when, who in kept:
        first = when == arrival[slot]
        out[slot[first]] = who[first]
    return out.reshape(n_rows, REGISTERS)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """A hash of each band, of its number and its registers."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        out = mix(out * STEP + parts[:, :, i])
    return out.astype(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, batch.num_columns - 1, TOGETHER):
            row, value, count = shingles(part.column(part.num_columns - 1))
            bands = band_hashes(signatures(row, value, count, part.num_rows))
            n = np.bincount(row, minlength=part.num_rows).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n), lists], [*part.schema.names[:-1], "n", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct shingle hashes of each text, packed."""
    for batch in batches:
        for part in slices(batch, batch.num_columns - 1, TOGETHER):
            row, value, _ = shingles(part.column(part.num_columns - 1))
            ends = np.searchsorted(row, np.arange(part.num_rows), side="right") * 8
            whole = value.astype("<u8").tobytes()
            packed = [whole[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(packed, pa.binary())], [*part.schema.names[:-1], "shingles"])


def _verify_pairs(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                common = int((x[at] == y).sum())
                ok.append(common >= threshold * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return verify


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The ``(a, b)`` pairs of texts whose shingle sets have at least the threshold's Jaccard similarity."""
    left = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("sa"), F.col("n").alias("na"))
    right = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("sb"), F.col("n").alias("nb"))
    both = pairs.join(right, "b").join(left, "a").where((F.col("na") >= threshold * F.col("nb")) & (F.col("nb") >= threshold * F.col("na")))
    return both.select("a", "b", "sa", "sb").mapInArrow(_verify_pairs(threshold), "a binary, b binary")


def _components(edges: DataFrame) -> DataFrame:
    return connected_components(edges, "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("part"))


def near_duplicate_classes(docs: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, class_id, kept)`` for every row.

    Texts are linked if the Jaccard similarity of their sets of five-word shingles
    is at least ``threshold``; a class is what links reach, ``class_id`` the smallest
    id in it. One document of a class, that of the smallest id, is ``kept`` (``key``
    is row_key: rows that repeat id and text are one document). Words are runs of
    other bytes than ASCII white space, unchanged; a text of fewer than five words is
    one shingle. Null texts and texts without words link with nothing and are kept.
    A null id comes after all others.

    Exact copies are one node. Within a bucket of a band, every member is compared
    with one leader, in LEADER_ROUNDS rounds with other leaders, as long as the
    bucket's members aren't all in one class; only members of different classes
    are then compared with each other, in blocks, each pair in the first band that
    it shares. Nothing is left out for a bucket's size.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = rows.select("doc_id", row_key(F.col("doc_id"), F.col("text"))["b"].alias("key"), F.unhex(F.md5("text")).alias("fp"), F.coalesce("text", F.lit("")).alias("text"))
    schema = keyed.drop("text").schema.add("n", "integer").add("bands", ArrayType(LongType()))
    signed = scratch_table(keyed.mapInArrow(_sign, schema), "signatures")
    texts = signed.where("n > 0").groupBy("fp").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("key").alias("key"))

    with scratch_folder(docs.sparkSession, "near-texts") as table:
        parts = _parts(keyed, texts, table, threshold)
    known = signed.where("n > 0").select("fp", "doc_id", "key").join(parts, "fp", "left").withColumn("part", F.coalesce("part", "fp"))
    first = known.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key")).alias("first"))
    classed = known.join(first, "part").select("doc_id", "key", F.col("first.doc_id").alias("class_id"), (F.col("key") == F.col("first.key")).alias("kept"))
    return classed.union(signed.where("n = 0").select("doc_id", "key", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")))


def _parts(keyed: DataFrame, texts: DataFrame, table, threshold: float) -> DataFrame:
    """``(fp, part)``: the class of every text that has a link, named by its smallest text."""
    texts = table(texts, "texts")
    banded = texts.select("fp", "n", "key", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1").select("bucket")
    members = table(banded.join(shared, "bucket"), "buckets")

    needed = members.select("key", "fp", "n").distinct()
    sets = keyed.select("key", "text").join(needed, "key").select("key", "fp", "n", "text")
    sets = sets.mapInArrow(_sets, "key string, fp binary, n int, shingles binary").drop("key")
    sets = table(sets.dropDuplicates(["fp"]), "shingles")  # rows that repeat id and text share a key

    edges, parts = None, None
    for turn in range(LEADER_ROUNDS):
        at = _with_parts(members, parts)
        lead = at.groupBy("bucket").agg(
            F.min("part").alias("lo"), F.max("part").alias("hi"), F.min_by(F.struct("fp", "part"), F.xxhash64("fp", F.lit(turn))).alias("lead")
        ).where("lo <> hi").select("bucket", F.col("lead.fp").alias("a"), F.col("lead.part").alias("a_part"))
        pairs = at.join(lead, "bucket").where("part <> a_part").select("a", F.col("fp").alias("b")).distinct()
        found = cut(_linked(pairs, sets, threshold))
        if turn and found.isEmpty():
            break
        edges = found if edges is None else edges.union(found)
        parts = _components(edges)
        edges = cut(parts.select(F.col("fp").alias("a"), F.col("part").alias("b")))
    rest = cut(_compare_rest(members, parts, texts.select("fp", "bands"), sets, threshold))
    if not rest.isEmpty():
        parts = _components(edges.union(rest))
    return parts


def _with_parts(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    if parts is None:
        return members.select("bucket", "band", "fp", "n", F.col("fp").alias("part"))
    joined = members.join(parts, "fp", "left")
    return joined.select("bucket", "band", "fp", "n", F.coalesce("part", "fp").alias("part"))


def _compare_rest(members: DataFrame, parts: DataFrame, bands: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between members of a bucket that are in different classes so far."""
    at = _with_parts(members, parts)
    mixed = at.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("held"), F.sum("n").alias("size")).where("lo <> hi")
    blocks = F.greatest(F.ceil(F.col("held") / BLOCK), F.ceil(8 * F.col("size") / BLOCK_BYTES))
    mixed = mixed.select("bucket", blocks.cast("int").alias("blocks"))
    at = at.join(mixed, "bucket").withColumn("own", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    # a block meets itself and every other block once
    at = at.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    at = at.select("bucket", "band", "fp", "part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("left"))
    at = at.join(bands, "fp").join(sets.select("fp", "shingles"), "fp")
    keys = ["bucket", "i", "j"]
    at = at.repartition(*keys).sortWithinPartitions(*keys, F.col("left").desc(), "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, keys):
            found = _compare_block(group, threshold)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return at.mapInArrow(compare, "a binary, b binary")


def _compare_block(group: pa.Table, threshold: float) -> list[tuple[bytes, bytes]]:
    """Linked pairs of a block, of different classes and in the first band that they share.

    A block that meets another compares across only; one that meets itself
    leaves out the pairs within its largest class.
    """
    group = group.combine_chunks()
    n = group.num_rows
    part = np.unique(np.array([p.hex() for p in group.column("part").to_pylist()]), return_inverse=True)[1]
    left = group.column("left").to_numpy(zero_copy_only=False)
    if left.all():
        rows, columns = np.flatnonzero(part != np.bincount(part).argmax()), np.arange(n)
    else:
        rows, columns = np.flatnonzero(left), np.flatnonzero(~left)
    if not len(rows) or not len(columns):
        return []
    sets = [np.frombuffer(s, "<u8") for s in group.column("shingles").to_pylist()]
    size = np.array([len(s) for s in sets])
    _, value, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    shared = holders > 1  # a shingle of one text is in no intersection
    at = shared[value]
    value, owner = (np.cumsum(shared) - 1)[value[at]], owner[at]
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    common = np.zeros((len(rows), len(columns)), np.float32)
    for lo in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(value, [lo, lo + 4096])
        some = np.zeros((n, min(4096, int(shared.sum()) - lo)), np.float32)
        some[owner[a:b], value[a:b] - lo] = 1
        common += some[rows] @ some[columns].T
    total = size[rows, None] + size[None, columns]
    near = (common >= threshold * (total - common)) & (part[rows, None] != part[None, columns])
    fps = group.column("fp").to_pylist()
    bands = group.column("bands").chunk(0).flatten().to_numpy().reshape(n, BANDS)
    band = group.column("band")[0].as_py()
    pairs = ((rows[x], columns[y]) for x, y in zip(*np.nonzero(near), strict=True))
    return [(fps[x], fps[y]) for x, y in pairs if int((bands[x] == bands[y]).argmax()) == band]
