"""Merkle manifest of a dataset: one digest for all rows, and for each row a proof that it belongs to it.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its length in UTF-8 bytes, ``:`` and its text. In
each group leaves ascend by id; while several nodes remain, every two consecutive ones (a last one alone, too) become the
SHA-256 of their digests as hex text. The group's last digest is its subroot; the subroots, ordered by group (null
first, then bytewise), become the root in the same way. A proof is the path of sibling digests from a leaf to the root.

Leaves find their places by ranks in bitmaps, without being sorted:

1. Each task folds the ids it meets into bitmaps of 64 ids; an aggregate merges them by ``bit_or`` for every group and word
   of the id space that holds an id (empty words are not kept). ``_based`` builds directories over the words, ``FAN_BITS``
   bits of the id space at a time, that say how many rows come before a word; none looks at over 2^``FAN_BITS`` rows
   together.
2. A leaf's place is the count before its word plus the population count of the word's lower bits. Words that hold more
   rows than bits have repeated or null ids; only their rows are ranked by a range-partitioned sort.
3. Leaves are put into the slots of arrays keyed by group and place / 2^``SLOT_BITS``, in whatever order they come, and
   an array is reduced to its top digest. The tops are the nodes of the next round.
4. Downwards, every array is reduced once more and hands out paths: the siblings inside it, then the path of its top.

Defined results: any field may be null; fields that aren't strings count by their text; a null id comes before all others; rows
that share an id are ordered by their leaf; equal rows take consecutive places; a null group is a group of its own; an empty
table gives an empty result; texts may be of any length; columns that are not fields are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import stored, text_batches

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_BITS = 16
SLOT_BITS = 12
WORD_BITS = 58  # bits of an id above the 6 that a word holds
NO_ID = -(1 << 58)  # the word of null ids, before all others


def leaf_digest(values: Sequence[Column]) -> Column:
    """The leaf of a row with these field values."""
    told = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``at``, their place in a total order, by a range-partitioned sort; stored."""
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))  # a row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(starts), part == F.col("part")).withColumn("at", F.col("start") + inside).drop("part", "start")


def _based(counts: DataFrame, bits: int) -> DataFrame:
    """(grp, key, ..., rows) with ``base``, the rows of the group under smaller keys, and ``n``, all rows of the group."""
    if bits <= FAN_BITS:
        lower = Window.partitionBy("grp").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        return counts.select("*", F.coalesce(F.sum("rows").over(lower), F.lit(0)).alias("base"), F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    up = F.shiftright("key", FAN_BITS)
    upper = _based(counts.groupBy("grp", up.alias("key")).agg(F.sum("rows").alias("rows")), bits - FAN_BITS)
    lower = Window.partitionBy("grp", "up").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("up", up).withColumn("inside", F.coalesce(F.sum("rows").over(lower), F.lit(0)))
    found = inside.join(upper.select("grp", F.col("key").alias("up"), "base", "n"), ["grp", "up"])
    return found.withColumn("base", F.col("base") + F.col("inside")).drop("up", "inside")


def bitmap_index(ids: DataFrame) -> DataFrame:
    """grp, key, bits, rows, base, n: the bitmap of every word of 64 ids in use, from rows (grp, doc_id)."""
    bit = F.expr("shiftleft(1L, cast(doc_id & 63 as int))")
    words = ids.groupBy("grp", _word(F.col("doc_id")).alias("key")).agg(
        F.bit_or(F.when(F.col("doc_id").isNull(), F.lit(0).cast("bigint")).otherwise(bit)).alias("bits"), F.count(F.lit(1)).alias("rows")
    )
    return _based(words, WORD_BITS)


def _word(doc_id: Column) -> Column:
    return F.coalesce(F.shiftright(doc_id, 6), F.lit(NO_ID))


def place(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, doc_id, leaf, rid, ...) with ``pos``, their place in the group from 0, and ``n``, the group's size."""
    index = stored(bitmap_index(leaves))
    found = leaves.withColumn("key", _word(F.col("doc_id"))).join(index, ["grp", "key"])
    smaller = F.expr("~shiftleft(-1L, cast(doc_id & 63 as int))")  # the bits below the id's
    crowded = F.col("rows") > F.bit_count("bits")
    extra = ("key", "bits", "rows", "base")
    easy = found.where(~crowded).withColumn("pos", F.col("base") + F.bit_count(F.col("bits").bitwiseAND(smaller))).drop(*extra)
    if index.where(crowded).isEmpty():
        return easy
    order = [F.col("grp"), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("rid")]
    rest = numbered(found.where(crowded), *order)
    first = rest.groupBy("grp", "key").agg(F.min("at").alias("first"))
    rest = rest.join(first, ["grp", "key"]).withColumn("pos", F.col("base") + F.col("at") - F.col("first"))
    return easy.unionByName(rest.drop(*extra, "at", "first"))


def _levels(table: pa.Table, bits: int) -> tuple[list[list[str]], int]:
    """The digests of a slot array level by level, up to its top, and the place of its first slot."""
    places, n = table["pos"].to_pylist(), table["n"][0].as_py()
    start = places[0] >> bits << bits
    slots: list[str] = [""] * min(1 << bits, n - start)
    for at, digest in zip(places, table["digest"].to_pylist(), strict=True):
        slots[at - start] = digest
    levels = [slots]
    for _ in range(min(bits, (n - 1).bit_length())):
        low = levels[-1]
        levels.append([sha256("".join(low[k : k + 2]).encode()).hexdigest() for k in range(0, len(low), 2)])
    return levels, start


def _top(nodes: DataFrame, bits: int) -> DataFrame:
    """The nodes (grp, pos, n, digest) that the slot arrays of ``nodes`` reduce to."""

    def reduce(key: tuple, table: pa.Table) -> pa.Table:
        n = table["n"][0].as_py()
        row = {"grp": [key[0].as_py()], "pos": [key[1].as_py()], "n": [-(-n >> bits)], "digest": [_levels(table, bits)[0][-1][0]]}
        return pa.table(row, schema=pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]))

    slots = nodes.select("grp", F.shiftright("pos", bits).alias("slots"), "pos", "n", "digest")
    return slots.groupBy("grp", "slots").applyInArrow(reduce, "grp string, pos bigint, n bigint, digest string")


def _paths(nodes: DataFrame, tops: DataFrame, bits: int) -> DataFrame:
    """``nodes`` with ``subroot`` and ``path``: the siblings inside their slot array, then those of its top in ``tops``.

    ``tops`` has grp, pos, subroot, path. An entry of a path is a digest after ``<`` (left of the path) or ``>`` (right of it), or empty where a node is alone.
    """
    names = nodes.columns

    def walk(key: tuple, table: pa.Table, top: pa.Table) -> pa.Table:
        levels, start = _levels(table, bits)
        above, paths = top["path"][0].as_py(), []
        for at in table["pos"].to_pylist():
            k, path = at - start, []
            for low in levels[:-1]:
                other = k ^ 1
                path.append("" if other >= len(low) else (">" if other > k else "<") + low[other])
                k >>= 1
            paths.append(path + above)
        subroot = pa.array(top["subroot"].to_pylist() * len(paths), pa.string())
        return table.select(names).append_column("subroot", subroot).append_column("path", pa.array(paths, pa.list_(pa.string())))

    keyed = nodes.withColumn("slots", F.shiftright("pos", bits)).groupBy("grp", "slots")
    above = tops.select("grp", F.col("pos").alias("slots"), "subroot", "path").groupBy("grp", "slots")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", subroot string, path array<string>"
    return keyed.cogroup(above).applyInArrow(walk, schema)


def _rounds(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """``nodes`` and the nodes of each round above them, down to one for each group."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0  # one number
    while most > 1:
        rounds.append(stored(_top(rounds[-1].select("grp", "pos", "n", "digest"), bits)))
        most = -(-most >> bits)
    return rounds


def group_key(group: Column) -> Column:
    """A string that orders like the group, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def manifest(leaves: DataFrame, bits: int = SLOT_BITS) -> DataFrame:
    """``leaves`` (grp, doc_id, leaf, and what else is to be kept) with pos, n, path, subroot and root.

    ``grp`` is a ``group_key``; ``doc_id`` is a bigint.
    """
    placed = stored(place(stored(leaves.withColumn("rid", F.monotonically_increasing_id()))).withColumnRenamed("leaf", "digest"))
    rounds = _rounds(placed, bits)
    ordered = numbered(rounds[-1].select("grp", "digest"), F.col("grp"))
    number = F.lit(ordered.count()).cast("bigint")
    groups = ordered.select(F.lit("").alias("grp"), F.col("at").alias("pos"), number.alias("n"), "digest", F.col("grp").alias("of"))
    upper = _rounds(groups, bits)
    root = upper[-1].select("digest").first()  # one row, or none for an empty table
    start, nothing = F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<string>").alias("path")
    paths = upper[-1].select("grp", start, F.lit("").alias("subroot"), nothing)
    for nodes in reversed(upper[:-1]):
        paths = _paths(nodes, paths, bits)
    if len(upper) == 1:  # one group: its subroot is the root
        paths = groups.select("of", "digest", nothing)
    paths = stored(paths.select(F.col("of").alias("grp"), start, F.col("digest").alias("subroot"), "path"))  # a node here is a subroot
    for nodes in reversed(rounds[:-1]):
        paths = _paths(nodes, paths, bits)
    if len(rounds) == 1:  # every group has one leaf
        paths = placed.join(paths.drop("pos"), "grp")
    return paths.withColumnRenamed("digest", "leaf").drop("rid").withColumn("root", F.lit(root[0] if root else None).cast("string"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def step(low: Column, other: Column) -> Column:
        rest = F.substring(other, 2, 64)
        return F.sha2(F.when(other.startswith("<"), F.concat(rest, low)).otherwise(F.concat(low, rest)).cast("binary"), 256)

    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """SHA-256 of a path's sibling digests, from the leaf's level up."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.substring(x, 2, 64)), "").cast("binary"), 256)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_batches(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    fields = [F.col(c) for c in FIELDS]
    raised = [(F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c)) for c in FIELDS]
    received = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_digest(raised))
    leaves = docs.select(group_key(F.col("lang")).alias("grp"), "doc_id", leaf_digest(fields).alias("leaf"), received.alias("received"))
    proven = manifest(leaves).select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), fold(F.coalesce("received", "leaf"), F.col("path")).alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, ascii_bytes,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM (SELECT *, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS ascii_bytes FROM documents)),
c AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], ascii_bytes), lambda crc, byte:
      list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda t, z: xor(t >> 1, 3988292384::BIGINT * (t & 1))))) % 7 = 0 AS tampered
  FROM d),
l AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS altered, tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
  FROM c),
t AS (
  SELECT lang, 0 AS k, list(leaf ORDER BY doc_id) AS nodes FROM l GROUP BY lang
  UNION ALL
  SELECT lang, k + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM t WHERE len(nodes) > 1),
s AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM t WHERE len(nodes) = 1),
u AS (
  SELECT 0 AS k, (SELECT list(subroot ORDER BY pos) FROM s) AS nodes
  UNION ALL
  SELECT k + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM u WHERE len(nodes) > 1),
e AS (
  SELECT l.doc_id, t.k, (l.pos >> t.k) AS i, t.nodes FROM l JOIN t ON l.lang IS NOT DISTINCT FROM t.lang AND len(t.nodes) > 1
  UNION ALL
  SELECT l.doc_id, 1000 + u.k, (s.pos >> u.k), u.nodes FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN u ON len(u.nodes) > 1),
p AS (
  SELECT doc_id, list(CASE WHEN i % 2 = 1 THEN '<' || nodes[i] ELSE coalesce('>' || nodes[i + 2], '') END ORDER BY k) AS path FROM e GROUP BY doc_id),
f AS (
  SELECT l.doc_id, leaf, subroot, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root,
    sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x[2:]), '')) AS proof_sha256,
    list_reduce(list_concat([CASE WHEN tampered THEN altered ELSE leaf END], coalesce(path, [])), lambda low, x:
      sha256(CASE WHEN x[1] = '<' THEN x[2:] || low ELSE low || x[2:] END)) AS folded_root
  FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang LEFT JOIN p ON p.doc_id = l.doc_id)
SELECT *, folded_root = root AS verified FROM f"""
