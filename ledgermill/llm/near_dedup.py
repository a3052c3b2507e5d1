"""Near-duplicates by SimHash, compared bit-sliced.

A fingerprint has a bit for the majority of its shingles' hashes. Two fingerprints that differ in at
most r of 64 bits agree wholly in at least 5 - r of 5 blocks of bits, so rows are dealt out by every
choice of 5 - r blocks and only compared within such a bucket. Nothing is lost: a bucket with too many
rows is dealt out again by thirds of the bits left, of which again one must agree (for r = 2), until
so few bits are left that a bucket can't be large, since fingerprints are distinct.

Within a task the rows of many buckets lie in a row and are stored vertically, one bit plane per bit.
At each distance d along the rows, the planes and the planes moved by d are compared 64 rows to a
word: their differences are added into carry-save counters, a few words of logic per plane, and words
in which every row has passed the radius are left out of the planes to come.

Only a spanning forest of each bucket's links leaves a task, so thousands of copies of one text give
thousands of links, not millions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.components import components
from ledgermill.llm.texts import text_of
from ledgermill.operators.joins import attach
from ledgermill.session import stored

RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
BITS, BLOCKS = 64, 5
# Rows of a bucket that are compared at once; a larger bucket is dealt out again.
BUCKET_ROWS = 512
BATCH_ROWS = 1 << 16
# Planes after which words that have passed the radius are looked for.
CHECKED_PLANES = 4



def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles, A-Z in lower case; 0 without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(shingle_words)))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(shingles))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, kept: list[str], shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``row``, the columns ``kept`` of every row, and ``_fp``, its fingerprint as a signed 64-bit integer."""
    packed = docs.select(F.struct(*kept).alias("row"), text_of().alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle_words) for t in batch.column("text")]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("row"), signed], ["row", "_fp"])

    return packed.mapInArrow(digest, packed.select("row").schema.add("_fp", T.LongType()))


def _parts(bits: list[int], n: int) -> list[list[int]]:
    """Bits in n runs of nearly equal length."""
    return [part.tolist() for part in np.array_split(np.array(bits), n)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def first_masks(radius: int) -> list[int]:
    blocks = _parts(list(range(BITS)), BLOCKS)
    return [_mask(sum(chosen, [])) for chosen in combinations(blocks, BLOCKS - radius)]


def finer_masks(mask: int, radius: int) -> list[int]:
    """Masks that also hold one of radius + 1 parts of the bits that ``mask`` leaves open."""
    held = [b for b in range(BITS) if mask >> b & 1]
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    return [_mask(held + part) for part in _parts(open_bits, radius + 1) if part]


def _planes(marks: np.ndarray, words: int) -> np.ndarray:
    """Bit planes: row b, word w, bit k is bit b of mark 64 w + k."""
    bits = np.unpackbits(np.ascontiguousarray(marks).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.zeros((BITS, words * 8), np.uint8)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    planes[:, : packed.shape[1]] = packed
    return planes.view(np.uint64)


def close_pairs(marks: np.ndarray, left: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one bucket that differ in at most ``radius`` bits, by their distance along the rows.

    ``marks`` are the fingerprints of whole buckets in a row; ``left`` says how many rows of its bucket
    follow each.
    """
    n, full = len(marks), np.uint64(0xFFFFFFFFFFFFFFFF)
    most = int(left.max(initial=0))
    words = (n + 63) // 64
    planes = _planes(marks, words + most // 64 + 2)
    bits_needed = (radius + 1).bit_length()
    for d in range(1, most + 1):
        inside = np.zeros(words * 8, np.uint8)
        packed = np.packbits(left >= d, bitorder="little")
        inside[: len(packed)] = packed
        inside = inside.view(np.uint64)
        at = np.flatnonzero(inside)
        if not len(at):
            return
        passed = ~inside[at]
        counters = [np.zeros(len(at), np.uint64) for _ in range(bits_needed)]
        q, r = divmod(d, 64)
        for b, plane in enumerate(planes):
            moved = plane[at + q]
            if r:
                moved = moved >> np.uint64(r) | plane[at + q + 1] << np.uint64(64 - r)
            carry = plane[at] ^ moved
            for k, counter in enumerate(counters):
                counters[k], carry = counter ^ carry, counter & carry
            reached = full
            for k, counter in enumerate(counters):
                reached = reached & (counter if radius + 1 >> k & 1 else ~counter)
            passed = passed | reached
            if b % CHECKED_PLANES == CHECKED_PLANES - 1:
                alive = passed != full
                if not alive.all():
                    at, passed = at[alive], passed[alive]
                    counters = [c[alive] for c in counters]
                    if not len(at):
                        break
        if len(at):
            hits = np.unpackbits((~passed).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, bit = np.nonzero(hits)
            i = at[word] * 64 + bit
            yield i, i + d


def _forest(marks: np.ndarray, left: np.ndarray, radius: int) -> np.ndarray:
    """Per row the first row that links lead to within its bucket."""
    root = np.arange(len(marks))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in close_pairs(marks, left, radius):
        apart = root[i] != root[j]
        for a, b in zip(i[apart].tolist(), j[apart].tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        while True:
            shorter = root[root]
            if (shorter == root).all():
                break
            root[:] = shorter
    return root


def _by_bucket(batches, key_names, value_names, found) -> Iterator[pa.RecordBatch]:
    """Call ``found`` with the keys and values of whole buckets, some thousands of rows at a time."""
    keys, values = np.zeros((len(key_names), 0), np.int64), np.zeros((len(value_names), 0), np.int64)
    for batch in batches:
        keys = np.hstack([keys, np.stack([batch.column(c).to_numpy() for c in key_names])])
        values = np.hstack([values, np.stack([batch.column(c).to_numpy() for c in value_names])])
        if keys.shape[1] >= BATCH_ROWS:
            # The last bucket may go on in the next batch.
            whole = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0))
            if len(whole):
                cut = whole[-1] + 1
                yield found(keys[:, :cut], values[:, :cut])
                keys, values = keys[:, cut:].copy(), values[:, cut:].copy()
    if keys.shape[1]:
        yield found(keys, values)


def _bucket_links(radius: int):
    def found(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        ends = np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, keys.shape[1])
        left = np.repeat(ends, np.diff(np.append(0, ends))) - np.arange(keys.shape[1]) - 1
        marks = values[0]
        root = _forest(marks.view(np.uint64), left, radius)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(marks[linked]), pa.array(marks[root[linked]])], ["u", "v"])

    return lambda batches: _by_bucket(batches, ("mask", "bucket"), ("_fp",), found)


def _literals(masks: list[int]) -> Column:
    return F.array(*(F.lit(m).cast("bigint") for m in masks))


def _near_links(distinct: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within the radius of each other."""
    masks, found = first_masks(radius), None
    finer = {m: [m] for m in masks}
    rows = distinct.select("_fp", F.explode(_literals(masks)).alias("mask"))
    while True:
        rows = rows.withColumn("bucket", F.col("_fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
        shared = stored(attach(rows, sizes, {"mask": "mask", "bucket": "bucket"}, "inner"), "buckets")
        # What is open below a mask of this round; when it is little, a bucket of distinct marks is small.
        small = F.col("n") <= bucket_rows
        last = all(BITS - bin(m & (1 << 64) - 1).count("1") <= 8 for m in finer)
        links = (
            (shared if last else shared.filter(small))
            .repartition("mask", "bucket")
            .sortWithinPartitions("mask", "bucket")
            .select("mask", "bucket", "_fp")
            .mapInArrow(_bucket_links(radius), "u bigint, v bigint")
        )
        found = links if found is None else found.unionByName(links)
        large = shared.filter(~small)
        if last or large.isEmpty():
            return found
        finer = {m: finer_masks(m, radius) for m in {x for xs in finer.values() for x in xs}}
        pairs = ((F.lit(m).cast("bigint"), _literals(xs)) for m, xs in finer.items())
        choices = F.create_map(*(c for pair in pairs for c in pair))
        # Two masks may lead to the same finer one.
        rows = large.select("_fp", F.explode(choices[F.col("mask")]).alias("mask")).distinct()
        finer = {x: [x] for xs in finer.values() for x in xs}


def group_fingerprints(marked: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per distinct ``_fp`` of ``marked`` (``doc_id``, ``_fp``): ``_root``, its group, and component_id.

    ``_root`` is one fingerprint of the group; component_id is the group's smallest doc_id, null if
    the group has none.
    """
    distinct = stored(marked.groupBy("_fp").agg(F.min("doc_id").alias("_first")), "fingerprints")
    roots = components(_near_links(distinct.select("_fp"), radius, bucket_rows))
    labels = _labelled(distinct.select(F.col("_fp").alias("node"), "_first"), roots)
    return labels.withColumnRenamed("node", "_fp")


def _labelled(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """node, _root and component_id of ``nodes`` (``node``, ``_first``: its smallest doc_id)."""
    rooted = attach(nodes, roots.withColumnRenamed("node", "_node"), {"node": "_node"}).withColumn(
        "root", F.coalesce("root", "node")
    )
    smallest = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    return attach(rooted, smallest, {"root": "root"}, "inner").select("node", F.col("root").alias("_root"), "component_id")


def _marked(docs: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id and ``_fp`` of every row, stored."""
    return stored(fingerprints(docs, ["doc_id"], shingle_words).select("row.doc_id", "_fp"), "simhash")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, fingerprint, component_id.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest doc_id that
    links reach, the row's own included.

    Null and empty texts have fingerprint zero and link like any other. A null doc_id stays null and is
    no candidate for component_id, which is null only where the whole group has no other; repeated rows
    give repeated rows; an empty table gives none. Texts of any length are read whole. Other columns are
    not looked at.
    """
    marked = _marked(docs, shingle_words)
    labels = group_fingerprints(marked, radius)
    return attach(marked, labels, {"_fp": "_fp"}, "inner").select(
        "doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group that ``near_duplicates`` finds: the one with the smallest doc_id.

    Null and empty texts are copies of each other. Rows without doc_id go where their group has a row with
    one; of rows that are equal in doc_id one stays. An empty table stays empty, texts of any length are read
    whole, and all columns are kept as they are, whatever their names.
    """
    marked = _marked(docs, shingle_words)
    labels = group_fingerprints(marked, radius)
    # A null doc_id stays only where its group has no other. Of a group's rows with the smallest doc_id one text stays.
    ids = marked.groupBy("_fp", "doc_id").agg(F.count("*").alias("_copies"))
    first = attach(ids, labels, {"_fp": "_fp"}, "inner").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("_root").agg(F.min_by(F.struct("_fp", "doc_id", "_copies"), "_fp").alias("_kept"))
    kept = stored(chosen.select(F.col("_kept._fp").alias("_mark"), _named("_kept.doc_id").alias("_name"), "_kept._copies"), "kept")
    rows = fingerprints(docs, docs.columns, shingle_words).withColumn("_own", _named("row.doc_id"))
    found = attach(rows, kept, {"_fp": "_mark", "_own": "_name"}, "inner")
    # Rows that share doc_id and fingerprint are few in any sane table; only they move once more.
    single = found.filter("_copies = 1").select("row.*")
    return single.unionByName(found.filter("_copies > 1").dropDuplicates(["_fp", "_own"]).select("row.*"))


def _named(column: str) -> Column:
    """A doc_id as a text, a null one as the empty text, which no number is."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
