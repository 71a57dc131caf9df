"""Near-duplicate documents by MinHash bands, with odd sketches for candidates and full sets for links.

A document's set holds the hashes of its distinct ``words`` -word shingles (fewer words: the whole sequence). Two
documents are linked if 100 * intersection >= ``percent`` * union, confirmed on the full sets; components of links
are the groups, named by their smallest id.

1. One pass over the texts gives each document's set size, a 128-bit fingerprint of its set, ``BANDS`` band hashes of
   ``ROWS`` MinHash values each, and an odd sketch: every MinHash sample flips one bit of ``SKETCH_BITS``, so that the
   population count of two sketches' XOR estimates how many samples differ. A second bitmap folds the whole set the
   same way; its XOR can't have more bits than the sets differ in elements, which gives an exact bound.
2. Rows with equal sets are one class (map-side combine), known by the row number of its first member.
3. In each band bucket all members are compared with one of them, by ``LEADERS`` orders in turn: as many pairs as members. A pair goes
   on if the set sizes and the sketches allow the similarity; links are confirmed on the full sets. These are built once
   more where the texts are read, for classes that still have a pair (a Bloom filter of fixed size tells the hashes of their
   texts, and other texts are not split again), so no text is shuffled. A large set is compared in slices of its hash range.
4. Components of these links. A bucket whose members are all in one component is done. In the others, members
   outside the bucket's largest component are compared with every member of another component, so that no link is
   lost between two components; pairs in one component change nothing and are left out. A bucket of more than ``BLOCK``
   members is dealt over pairs of blocks, in which only sets of neighbouring sizes meet. A task compares the sketches of
   ``PAIRS`` pairs at once, word by word.

A pair at a similarity of 0.8 shares no band with a chance of (1 - 0.8^4)^28 < 4e-7; the sketch bound lies six standard
deviations off the threshold.

Defined results: a null or empty text, or one without words, has set size 0 and is linked with nothing; rows that repeat an
id are rows of their own with that id; a null id comes after all others, so a component of null ids alone has a null
name; a very long text is one set like any other; an empty table gives an empty result; other columns are not read. Of
each component exactly one row ``stays``: the first by id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.collocations import Filter, filter_of
from revlens.llm.common import blocks, column, mix, stored, text_batches, word_hashes, word_spans
from revlens.llm.components import components

BANDS, ROWS = 28, 4
SKETCH_BITS = 512  # of the MinHash samples
SET_BITS = 1024  # of the whole set
BLOCK_CHARS = 1 << 19
SLICE = 8192  # shingles of a set that are compared at once
LEADERS = 3  # orders by which buckets choose the member that all others are compared with
BLOCK = 1024  # members of an open bucket that are compared at once
PAIRS = 1 << 18  # their pairs that are compared at once
_KEYS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 2 * BANDS * ROWS + 32, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, starts, ends, per_text = word_spans([(t or "").encode().lower() for t in texts])
    with np.errstate(over="ignore"):
        h = word_hashes(data, starts, ends)
        n = max(0, len(h) - words + 1)
        grams = np.zeros(n, dtype=np.uint64)
        for k in range(words):
            grams += h[k : k + n] * _KEYS[k]
        grams = mix(grams)
        out, at = [], 0
        for count in per_text.tolist():
            if count >= words:
                own = np.sort(grams[at : at + count - words + 1])
                out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
            elif count:
                out.append(mix(np.array([(h[at : at + count] * _KEYS[:count]).sum() + _KEYS[8 + count % 24]], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += count
    return out


def _parity(rows: np.ndarray, bits: np.ndarray, n_rows: int, width: int) -> np.ndarray:
    """Per row, ``width`` bits as longs: whether each bit was flipped an odd number of times."""
    odd = np.bincount(rows * width + bits.astype(np.int64), minlength=n_rows * width).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n_rows, width), axis=1, bitorder="little").view("<i8")


def _fingerprints(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over the hashes of each set, which begins at ``begins``."""
    with np.errstate(over="ignore"):
        return np.add.reduceat(mix(flat * _KEYS[-1]), begins), np.add.reduceat(mix(flat * _KEYS[-2]), begins)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """rid, doc_id, hash t of the text, n, fingerprint f1 and f2, band hashes, odd sketch and set bitmap (as longs)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, ids, hashes, texts = batch.column(0), batch.column(1), batch.column(2), column(batch, "text")
            for a, b in blocks(texts, BLOCK_CHARS):
                sets = shingle_sets(texts[a:b], words)
                sizes = np.array([len(s) for s in sets])
                some = np.flatnonzero(sizes)
                low = np.full((len(sets), BANDS * ROWS), 0, dtype=np.uint64)
                f1, f2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                if len(some):
                    flat = np.concatenate([sets[k] for k in some])
                    begins = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
                    sample = np.empty_like(flat)
                    with np.errstate(over="ignore"):
                        for j in range(BANDS * ROWS):
                            low[some, j] = np.minimum.reduceat(np.multiply(flat, _KEYS[j], out=sample), begins)
                        f1[some], f2[some] = _fingerprints(flat, begins)
                with np.errstate(over="ignore"):
                    rows = low.reshape(len(sets), BANDS, ROWS)
                    keys = np.zeros((len(sets), BANDS), np.uint64)
                    for r in range(ROWS):
                        keys = mix(keys * np.uint64(31) + rows[:, :, r])
                    keys = mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * _KEYS[-3])
                    bit = mix(low + np.arange(BANDS * ROWS, dtype=np.uint64) * _KEYS[-4]) % np.uint64(SKETCH_BITS)
                each = np.repeat(np.arange(len(sets)), BANDS * ROWS)
                sketch = _parity(each, bit.ravel(), len(sets), SKETCH_BITS)
                owner = np.repeat(np.arange(len(sets)), sizes)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                whole = _parity(owner, flat % np.uint64(SET_BITS), len(sets), SET_BITS)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        rids.slice(a, b - a),
                        ids.slice(a, b - a),
                        hashes.slice(a, b - a),
                        pa.array(sizes, pa.int64()),
                        pa.array(f1.view(np.int64)),
                        pa.array(f2.view(np.int64)),
                        pa.array(list(keys.view(np.int64)), longs),
                        pa.array(list(sketch), longs),
                        pa.array(list(whole), longs),
                    ],
                    ["rid", "doc_id", "t", "n", "f1", "f2", "bands", "odd", "whole"],
                )

    hashed = docs.select("rid", "doc_id", F.xxhash64("text").alias("t"), "text")
    return hashed.mapInArrow(sign, "rid bigint, doc_id bigint, t bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>, odd array<bigint>, whole array<bigint>")


def _level(n: int, width: int) -> int:
    """A set of ``n`` shingles is compared in 2^level slices of about 2^``width``."""
    return max(0, (n - 1).bit_length() - width)


def slices(docs: DataFrame, words: int, percent: int, wanted: Filter) -> DataFrame:
    """f1, f2, n, level, slice, part: the sets of the texts whose hash the filter has, cut by their leading bits.

    Other texts are not split into words again. A set is cut at the level of its own size and at that of the largest
    set it may be linked with. A class goes out once for each task, however many copies the task reads.
    """
    width = (SLICE - 1).bit_length()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()
        for batch in batches:
            asked = wanted(batch.column(0).to_numpy().view(np.uint64))
            texts = batch.column(1).filter(pa.array(asked)).to_pylist()
            for a, b in blocks(texts, BLOCK_CHARS):
                sets = [s for s in shingle_sets(texts[a:b], words) if len(s)]
                if not sets:
                    continue
                begins = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
                f1, f2 = _fingerprints(np.concatenate(sets), begins)
                for k in range(len(sets)):
                    name = (int(f1[k]), int(f2[k]))
                    if name in told:
                        continue
                    told.add(name)
                    own, n = sets[k], len(sets[k])
                    for level in {_level(n, width), _level(n * 100 // percent, width)}:
                        cuts = np.searchsorted(own, np.arange(1 << level, dtype=np.uint64) << np.uint64(64 - level)) if level else np.zeros(1, np.int64)
                        ends = np.append(cuts[1:], n)
                        size = len(cuts)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.repeat(f1[k : k + 1].view(np.int64), size)),
                                pa.array(np.repeat(f2[k : k + 1].view(np.int64), size)),
                                pa.array(np.full(size, n)),
                                pa.array(np.full(size, level, np.int32)),
                                pa.array(np.arange(size, dtype=np.int32)),
                                pa.array([own[x:y].view(np.int64) for x, y in zip(cuts, ends)], pa.list_(pa.int64())),
                            ],
                            ["f1", "f2", "n", "level", "slice", "part"],
                        )

    return docs.select(F.xxhash64("text").alias("t"), "text").mapInArrow(build, "f1 bigint, f2 bigint, n bigint, level int, slice int, part array<bigint>")


def most_bits(percent: int) -> int:
    """Sketch bits that two sets at the threshold differ in, with six standard deviations of the samples to spare."""
    k, miss = BANDS * ROWS, 1 - percent / 100
    differ = 2 * min(k, k * miss + 6 * math.sqrt(k * miss * (1 - miss)))
    return round(SKETCH_BITS / 2 * (1 - math.exp(-2 * differ / SKETCH_BITS)) + math.sqrt(SKETCH_BITS) / 3)


class Sketches(NamedTuple):
    """Set sizes of rows, and the words of their odd sketches and set bitmaps, a word of all rows at a time, without sign."""

    n: np.ndarray
    odd: np.ndarray
    whole: np.ndarray


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of arrays of one length, a row for each."""
    return batch.column(name).flatten().to_numpy().reshape(batch.num_rows, -1)


def _by_word(bits: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(bits.T).view(np.uint64)


def _differ(a: np.ndarray, left: np.ndarray, b: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The bits in which row ``left`` of a and row ``right`` of b differ."""
    bits = np.zeros(len(left), dtype=np.int64)
    for x, y in zip(a, b, strict=True):
        bits += np.bitwise_count(x.take(left) ^ y.take(right))
    return bits


def _may_link(percent: int, a: Sketches, left: np.ndarray, b: Sketches, right: np.ndarray) -> np.ndarray:
    """The places of the pairs (row ``left`` of a, row ``right`` of b) whose sizes, sketches and set bitmaps allow the similarity."""
    a_n, b_n = a.n[left], b.n[right]
    at = np.flatnonzero(100 * np.minimum(a_n, b_n) >= percent * np.maximum(a_n, b_n))
    at = at[_differ(a.odd, left[at], b.odd, right[at]) <= most_bits(percent)]
    # at the threshold t, the sets differ in (1 - t) / (1 + t) of the sum of their sizes
    elements = (100 + percent) * _differ(a.whole, left[at], b.whole, right[at]) <= (100 - percent) * (a_n[at] + b_n[at])
    return at[elements]


PAIR = "a bigint, b bigint, a_n bigint, b_n bigint"


def _likely(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, a_n, b_n) that may be linked; ``pairs`` also has a_odd, a_whole, b_odd, b_whole."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                Sketches(batch.column(f"{x}_n").to_numpy(), *(_by_word(_matrix(batch, f"{x}_{of}")) for of in ("odd", "whole")))
                for x in ("a", "b")
            )
            rows = np.arange(batch.num_rows)
            yield batch.select(["a", "b", "a_n", "b_n"]).take(pa.array(_may_link(percent, a, rows, b, rows)))

    return pairs.select("a", "b", "a_n", "b_n", "a_odd", "a_whole", "b_odd", "b_whole").mapInArrow(test, PAIR)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b, a_n, b_n) of classes that are links on their full sets."""
    ends = pairs.select(F.col("a").alias("c")).unionAll(pairs.select(F.col("b").alias("c"))).distinct()
    wanted = stored(classes.select("c", "n", "f1", "f2", F.col("first.t").alias("t")).join(ends, "c", "left_semi"))
    found = slices(docs, words, percent, filter_of(wanted.select(F.col("t").alias("h"))))
    parts = found.join(wanted, ["n", "f1", "f2"]).groupBy("c", "level", "slice").agg(F.first("part").alias("part"))
    parts = stored(parts)
    width = (SLICE - 1).bit_length()
    # the same level as ``_level`` of the larger set: the bits of n - 1 above those of a slice
    bits = F.length(F.regexp_replace(F.bin(F.greatest("a_n", "b_n") - 1), "^0+", ""))
    cut = pairs.withColumn("level", F.greatest(F.lit(0), bits - width))
    cut = cut.withColumn("slice", F.explode(F.expr("sequence(0, cast(shiftleft(1L, level) as int) - 1)")))
    for end in ("a", "b"):
        cut = cut.join(parts.select(F.col("c").alias(end), "level", "slice", F.col("part").alias(f"{end}_part")), [end, "level", "slice"])
    common = cut.groupBy("a", "b", "a_n", "b_n").agg(F.sum(F.size(F.array_intersect("a_part", "b_part"))).alias("common"))
    return common.where(100 * F.col("common") >= percent * (F.col("a_n") + F.col("b_n") - F.col("common"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _meetings(rest: DataFrame, percent: int) -> DataFrame:
    """The members of open buckets, dealt so that those which are to be compared have a ``meeting`` in common.

    In a meeting, the members that ask are compared with those that face them. A bucket of at most ``BLOCK`` members is one
    meeting. Of a larger one, sets that may be linked are at most one power of 100 / percent apart in size, so members
    meet by power, and a meeting is a block of those that ask and a block of those that face them.
    """
    outside = F.col("group") != F.col("main")
    small = rest.where(F.col("size") <= BLOCK).withColumn("meeting", F.xxhash64("bucket"))
    small = small.withColumn("asks", outside).withColumn("faces", F.lit(True))
    power = F.floor(F.log(F.col("a_n").cast("double")) / math.log(100 / percent)).cast("int")
    sized = rest.where(F.col("size") > BLOCK).withColumn("power", power)
    near = F.explode(F.array(F.col("power") - 1, F.col("power"), F.col("power") + 1))
    count = sized.groupBy("bucket", "power").agg(F.count(F.lit(1)).alias("members"), F.count_if(outside).alias("asking"))
    grid = count.select("bucket", F.col("power").alias("own"), "members", "asking", near.alias("power"))
    facing = F.max(F.when(F.col("own") == F.col("power"), F.col("members")))
    grid = grid.groupBy("bucket", "power").agg(F.ceil(F.sum("asking") / BLOCK).alias("rows"), F.ceil(facing / BLOCK).alias("columns"))
    grid = grid.where((F.col("rows") > 0) & (F.col("columns") > 0))

    def block(of: str):
        return F.pmod(F.xxhash64("a"), F.col(of))

    def every(of: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(of) - 1))

    faces = sized.join(grid, ["bucket", "power"]).withColumn("j", block("columns")).withColumn("i", every("rows"))
    faces = faces.withColumn("asks", F.lit(False)).withColumn("faces", F.lit(True))
    asks = sized.where(outside).withColumn("power", near).join(grid, ["bucket", "power"]).withColumn("i", block("rows")).withColumn("j", every("columns"))
    asks = asks.withColumn("asks", F.lit(True)).withColumn("faces", F.lit(False))
    large = faces.unionByName(asks).withColumn("meeting", F.xxhash64("bucket", "power", "i", "j"))
    columns = "meeting", "asks", "faces", "bucket", "a", "group", (F.col("group") == F.col("main")).alias("central"), "a_n", "a_odd", "a_whole", "a_bands"
    return small.select(*columns).unionAll(large.select(*columns)).repartition("meeting").sortWithinPartitions("meeting")


def _met(members: dict[str, np.ndarray], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, a_n, b_n) of members of whole meetings, which are ordered by meeting."""
    meeting, n, group, central, bands = (members[c] for c in ("meeting", "a_n", "group", "central", "a_bands"))
    sketches = Sketches(n, *(_by_word(members[c]) for c in ("a_odd", "a_whole")))
    place = np.cumsum(np.concatenate(([0], meeting[1:] != meeting[:-1]))).astype(np.int64) << 40  # a set has fewer elements
    asks, faces = np.flatnonzero(members["asks"]), np.flatnonzero(members["faces"])
    faces = faces[np.argsort(place[faces] + n[faces], kind="stable")]
    order = place[faces] + n[faces]
    begins = np.searchsorted(order, place[asks] + -(-n[asks] * percent // 100))
    counts = np.searchsorted(order, place[asks] + n[asks] * 100 // percent, "right") - begins
    upto = np.concatenate(([0], np.cumsum(counts)))
    x = 0
    while x < len(asks):
        y = max(x + 1, int(np.searchsorted(upto, upto[x] + PAIRS, "right")) - 1)
        left = np.repeat(asks[x:y], counts[x:y])
        right = faces[np.arange(upto[y] - upto[x]) + np.repeat(begins[x:y] - (upto[x:y] - upto[x]), counts[x:y])]
        x = y
        # each pair of components once: both ends outside the main one are taken from the smaller side only
        apart = np.flatnonzero((group[left] != group[right]) & (central[right] | (group[left] < group[right])))
        left, right = left[apart], right[apart]
        at = _may_link(percent, sketches, left, sketches, right)
        left, right = left[at], right[at]
        # of all buckets that two sets share, the first one compares them
        first = (bands[left] == bands[right]).argmax(axis=1)
        here = bands[left, first] == members["bucket"][left]
        left, right = left[here], right[here]
        if len(left):
            yield pa.RecordBatch.from_arrays([pa.array(members["a"][left]), pa.array(members["a"][right]), pa.array(n[left]), pa.array(n[right])], ["a", "b", "a_n", "b_n"])


def _across(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, a_n, b_n) across the components that meet in open buckets, as far as sizes and sketches allow.

    ``rest`` has the members of open buckets: bucket, size (of the bucket), a, group, main, a_n, a_odd, a_whole, a_bands.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}  # of the meeting that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            new = {c: _matrix(batch, c) if c in ("a_odd", "a_whole", "a_bands") else batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            held = {c: np.concatenate((held[c], v)) for c, v in new.items()} if held else new
            cut = int(np.searchsorted(held["meeting"], held["meeting"][-1]))
            if cut:
                yield from _met({c: v[:cut] for c, v in held.items()}, percent)
                held = {c: v[cut:] for c, v in held.items()}
        if held:
            yield from _met(held, percent)

    return _meetings(rest, percent).mapInArrow(compare, PAIR).distinct()


def near_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, stays for every row of ``docs``.

    ``row_col`` names a column with a unique number for each row, which then comes back as ``rid``.
    """
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    base = text_batches(docs).select(row.alias("rid"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(signatures(base, words))
    some = signed.where(F.col("n") > 0)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid", "t")).alias("first")
    classes = some.groupBy("n", "f1", "f2").agg(first, *(F.first(c).alias(c) for c in ("bands", "odd", "whole")))
    classes = stored(classes.withColumn("c", F.col("first.rid")))
    members = classes.select(F.col("c").alias("a"), F.posexplode("bands").alias("band", "bucket"))
    turn = F.min_by("a", F.xxhash64("a", F.col("band") % LEADERS))  # no two members of a band have one hash
    leaders = members.groupBy("bucket").agg(turn.alias("lead"), F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    buckets = stored(members.drop("band").join(leaders.select("bucket", "lead"), "bucket"))
    sketched = ("n", "odd", "whole")
    known = classes.select(F.col("c").alias("a"), *(F.col(x).alias(f"a_{x}") for x in (*sketched, "bands")))
    other = classes.select(F.col("c").alias("b"), *(F.col(x).alias(f"b_{x}") for x in sketched))

    stars = buckets.where(F.col("a") != F.col("lead")).select("a", F.col("lead").alias("b")).distinct()
    stars = stored(_likely(stars.join(known.drop("a_bands"), "a").join(other, "b"), percent))
    links = stored(confirmed(stars, classes, base, words, percent))
    groups = components(links)

    placed = buckets.join(groups.withColumnRenamed("node", "a"), "a", "left")
    placed = stored(placed.select("bucket", "a", F.coalesce("component", "a").alias("group")))
    shares = placed.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("n"))
    open_buckets = shares.groupBy("bucket").agg(
        F.max(F.struct("n", "group"))["group"].alias("main"), F.count(F.lit(1)).alias("groups"), F.sum("n").alias("size")
    )
    rest = stored(placed.join(open_buckets.where(F.col("groups") > 1).drop("groups"), "bucket").join(known, "a"))
    if not rest.isEmpty():
        pairs = stored(_across(rest, percent))
        if not pairs.isEmpty():
            groups = components(links.unionAll(confirmed(pairs, classes, base, words, percent)))

    grouped = classes.select("n", "f1", "f2", "first", F.col("c").alias("node")).join(groups, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node")).drop("node")
    named = grouped.groupBy("component").agg(F.min("first").alias("name"))
    grouped = grouped.join(named, "component").select("n", "f1", "f2", "name")
    found = some.select("rid", "doc_id", "n", "f1", "f2").join(grouped, ["n", "f1", "f2"]).select(
        "rid", "doc_id", "n", F.col("name.doc_id").alias("component_id"), (F.col("rid") == F.col("name.rid")).alias("stays")
    )
    alone = signed.where(F.col("n") == 0).select("rid", "doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.unionAll(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", kept, "stays", *([] if row_col is None else ["rid"])
    )


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=85).drop("stays")
