"""SimHash near-duplicates: pigeonhole blocks, joined on equal blocks, verified by Hamming distance.

`near_duplicates` links 64-bit fingerprints at RADIUS bits; six blocks of bits lose none of them. Texts
of similarity 0.8 differ in about 15 % of all bits, at which no blocks of plain bits select: `one_of_each`
takes fingerprints of WIDE bits for the distance, and for the join blocks that are each made of a few
shingles, so that similar texts share one of them.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logpulse.llm.common import add_columns, quoted, stored
from logpulse.llm.components import components, forest

SHINGLE = 4
RADIUS = 4
SEED = 42

#: Fingerprints that differ in at most RADIUS of 64 bits agree in two of these six blocks of bits.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))

#: Rows of a key that are compared pair by pair in one go.
CHUNK = 1024

#: Similar texts: words of a shingle, bits of a fingerprint, differing bits at which two are linked. Of
#: texts whose sets of shingles have Jaccard similarity 0.8, bits differ with probability acos(0.889) / pi.
SIMILAR_SHINGLE, WIDE, WIDE_RADIUS = 5, 512, 90
#: Blocks of a wide fingerprint, and least shingle hashes in each: two texts of similarity s share one of
#: these blocks with probability 1 - (1 - s ** 5) ** 16, which is 0.998 at 0.8.
WIDE_BLOCKS, LEAST = 16, 5


def shingle_hashes(text: str, size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of `size` words; of the whole sequence if there are fewer; none of no words."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return []
    joined = b" ".join(words)
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(space + 1).tolist()]
    ends = [*space.tolist(), len(joined)][min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends)]


def majority(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The fingerprint of each consecutive group of hashes: bits set in over half of them."""
    out = np.zeros(len(lengths), np.uint64)
    full = np.flatnonzero(lengths)
    if len(full):
        starts = np.r_[0, np.cumsum(lengths[full])[:-1]]
        for bit in range(64):
            ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), starts)
            out[full] |= (2 * ones > lengths[full]).astype(np.uint64) << np.uint64(bit)
    return out


def with_fingerprints(df: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `simhash` (64 bits as a long). Texts without words have fingerprint zero."""

    def make():
        def work(texts: list[str]) -> list:
            hashes = [shingle_hashes(t) for t in texts]
            flat = np.fromiter((h for x in hashes for h in x), np.uint64)
            return [pa.array(majority(flat, np.array([len(x) for x in hashes], np.int64)).view(np.int64))]

        return work

    return add_columns(df, make, "simhash bigint", text=text, keep=keep)


def block_keys(fingerprint: Column) -> Column:
    """One key for each pair of blocks: which pair, and the bits of both."""

    def bits(k: int) -> Column:
        at, width = BLOCKS[k]
        return F.shiftrightunsigned(fingerprint, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    pairs = list(combinations(range(len(BLOCKS)), 2))
    return F.array(*(F.lit(n << 32).cast("long").bitwiseOR(F.shiftleft(bits(i), 16)).bitwiseOR(bits(j)) for n, (i, j) in enumerate(pairs)))


def mixed(hashes: np.ndarray, stream: int) -> np.ndarray:
    """Other 64-bit hashes of the same things, independent between streams (finaliser of SplitMix64)."""
    x = hashes + np.uint64((stream * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_print(hashes: np.ndarray, piece: int = 1 << 16) -> bytes:
    """WIDE bits, each set if it is set in over half of the hashes; zero of no hashes."""
    words = WIDE // 64
    ones = np.zeros((words, 64), np.int64)
    for start in range(0, len(hashes), piece):
        part = hashes[start : start + piece]
        for k in range(words):
            bits = np.unpackbits(mixed(part, k + 1).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[k] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").tobytes()


#: Each stream orders the same hashes anew: a part of the bits is flipped, then multiplied by an odd number.
_FLIPS = mixed(np.arange(WIDE_BLOCKS * LEAST, dtype=np.uint64), 101)[:, None]
_ODDS = mixed(np.arange(WIDE_BLOCKS * LEAST, dtype=np.uint64), 102)[:, None] | np.uint64(1)


def shared_blocks(hashes: np.ndarray, piece: int = 1 << 14) -> list[int]:
    """WIDE_BLOCKS blocks of a set of shingle hashes, each made of the least hashes of LEAST streams."""
    if not len(hashes):
        return []
    least = np.full(len(_FLIPS), 2**64 - 1, np.uint64)
    for start in range(0, len(hashes), piece):
        np.minimum(least, ((hashes[start : start + piece] ^ _FLIPS) * _ODDS).min(axis=1), out=least)
    value = np.arange(WIDE_BLOCKS, dtype=np.uint64)
    for row in least.reshape(WIDE_BLOCKS, LEAST).T:
        value = mixed(value ^ row, 1)
    return value.view(np.int64).tolist()


def with_wide_fingerprints(df: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `print`, WIDE bits of the distinct shingles of a text, and `blocks`; texts without words have no block."""

    def make():
        def work(texts: list[str]) -> list:
            sets = [np.unique(np.array(shingle_hashes(t, SIMILAR_SHINGLE), np.uint64)) for t in texts]
            return [pa.array([wide_print(x) for x in sets], pa.binary()), pa.array([shared_blocks(x) for x in sets], pa.list_(pa.int64()))]

        return work

    return add_columns(df, make, "print binary, blocks array<bigint>", text=text, keep=keep)


def bits_of(nodes: np.ndarray, prints) -> np.ndarray:
    """Fingerprints as rows of 64-bit words: the nodes themselves where there are no wide ones."""
    if prints is None:
        return nodes.view(np.uint64).reshape(-1, 1)
    return np.frombuffer(b"".join(prints), np.uint64).reshape(len(nodes), -1)


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i in left, j in right) of rows of words that differ in at most `radius` bits."""
    apart = np.bitwise_count(left[:, None, 0] ^ right[None, :, 0])
    if left.shape[1] > 1:
        apart = apart.astype(np.uint16)
        for k in range(1, left.shape[1]):
            apart += np.bitwise_count(left[:, None, k] ^ right[None, :, k])
    return np.nonzero(apart <= radius)


def _compare_runs(batches, chunk: int, radius: int):
    """Within sorted partitions: connect the rows of a key, in chunks; report keys not compared whole.

    Rows out: (key null, a, b) edges of a forest; (key, null, null) keys that have more than one
    chunk or touch an end of the partition, where the rest of the key may lie in the next one.
    """
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
    open_key, open_prints, open_bits, chunks = None, np.zeros(0, np.int64), None, 0
    edges_a, edges_b, unsure, first_key, held = [], [], [], None, 0

    def compare(prints: np.ndarray, bits: np.ndarray) -> None:
        nonlocal held
        if len(prints) > 1:
            i, j = close_pairs(bits, bits, radius)
            i, j = i[i < j], j[i < j]
            if len(i):
                a, b = forest(prints[i], prints[j])
                edges_a.append(a)
                edges_b.append(b)
                held += len(a)

    def flush(last: bool = False):
        nonlocal held
        if held > 200_000 or last:
            a, b = forest(np.concatenate(edges_a), np.concatenate(edges_b)) if edges_a else (np.zeros(0, np.int64),) * 2
            edges_a.clear(), edges_b.clear()
            held = 0
            keys = np.array(sorted({k for k in unsure if k is not None}), np.int64)
            unsure.clear()
            n, m = len(a), len(keys)
            yield pa.RecordBatch.from_arrays([pa.array([None] * n + keys.tolist(), pa.int64()), pa.array(a.tolist() + [None] * m, pa.int64()), pa.array(b.tolist() + [None] * m, pa.int64())], schema=schema)

    for batch in batches:
        keys, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "simhash"))
        bits = bits_of(prints, batch.column("print").to_pylist() if "print" in batch.schema.names else None) if len(keys) else None
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)] if len(keys) else [0]
        for s, e in zip(cuts, cuts[1:]):
            key = int(keys[s])
            if first_key is None:
                first_key = key
                unsure.append(key)
            if key != open_key:
                compare(open_prints, open_bits)
                if chunks:
                    unsure.append(open_key)
                open_key, open_prints, open_bits, chunks = key, prints[s:e], bits[s:e], 0
            else:
                open_prints, open_bits = np.concatenate([open_prints, prints[s:e]]), np.concatenate([open_bits, bits[s:e]])
            while len(open_prints) > chunk:
                compare(open_prints[:chunk], open_bits[:chunk])
                open_prints, open_bits, chunks = open_prints[chunk - 1 :], open_bits[chunk - 1 :], chunks + 1  # one row of overlap
        yield from flush()
    compare(open_prints, open_bits)
    unsure.append(open_key)
    yield from flush(last=True)


def _compare_chunks(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Edges between components within one pair of chunks of a key."""
    few, all_rows = rows[rows.few], rows[~rows.few]
    if few.empty or all_rows.empty:
        return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
    i, j = close_pairs(*(bits_of(x.simhash.to_numpy(), x.print if "print" in x else None) for x in (few, all_rows)), radius)
    a, b = few.root.to_numpy()[i], all_rows.root.to_numpy()[j]
    a, b = forest(a[a != b], b[a != b])
    return pd.DataFrame({"a": a, "b": b})


def _rest(keyed: DataFrame, unsure: DataFrame, roots: DataFrame, chunk: int, radius: int) -> DataFrame:
    """Edges (between roots) that chunks of the `unsure` keys have missed.

    The rows of a key that are not of its largest component are compared with all rows of the key,
    chunk by chunk; inside one component nothing is left to find. No key is gathered in one task.
    """
    own = [c for c in keyed.columns if c != "key"]
    rows = stored(
        keyed.join(unsure, "key", "left_semi").join(roots.withColumnRenamed("node", "simhash"), "simhash", "left").select("key", *own, F.coalesce("root", "simhash").alias("root")),
        "simhash-rows",
    )
    sizes = rows.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.max_by("root", "n").alias("main"), F.max("n").alias("most")).where("most < n")
    unequal = rows.join(sizes, "key").withColumns({"few": F.col("root") != F.col("main"), "own": F.pmod(F.xxhash64("simhash"), F.ceil(F.col("n") / chunk)), "own_few": F.pmod(F.xxhash64("simhash"), F.ceil((F.col("n") - F.col("most")) / chunk))})
    few = unequal.where("few").select("key", *own, "root", F.lit(True).alias("few"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / chunk) - 1)).alias("chunk"), F.col("own_few").alias("chunk_few"))
    rest = unequal.select("key", *own, "root", F.lit(False).alias("few"), F.col("own").alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil((F.col("n") - F.col("most")) / chunk) - 1)).alias("chunk_few"))
    return few.union(rest).groupBy("key", "chunk", "chunk_few").applyInPandas(lambda rows: _compare_chunks(rows, radius), "a long, b long")


def link(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(simhash, root) of every given distinct fingerprint that is linked to another; root is one of its class.

    Where there are columns `print` and `blocks`, those are the wide fingerprint and its keys, and
    `simhash` is its name alone.

    1. Every fingerprint goes to its fifteen keys, or blocks; rows are dealt out by ranges of (key, fingerprint),
       so that a key with very many fingerprints spreads over tasks. Keys of at most `chunk` rows are
       compared whole; longer ones, or those cut by a range, in consecutive chunks.
    2. In keys that were not compared whole, rows outside the main component meet all rows.
    """
    wide = "print" in prints.columns
    own, keys, radius = (["simhash", "print"], F.col("blocks"), WIDE_RADIUS) if wide else (["simhash"], block_keys(F.col("simhash")), RADIUS)
    keyed = prints.select(*own, F.explode(keys).alias("key"))
    sorted_rows = keyed.select("key", *own).repartitionByRange("key", "simhash").sortWithinPartitions("key", "simhash")
    found = stored(sorted_rows.mapInArrow(partial(_compare_runs, chunk=chunk, radius=radius), "key long, a long, b long"), "simhash-found")
    edges = found.where("key is null").select("a", "b")
    roots = components(edges)
    rest = stored(_rest(keyed, found.where("key is not null").select("key").distinct(), roots, chunk, radius), "simhash-rest")
    if rest.isEmpty():
        return roots.select(F.col("node").alias("simhash"), "root")
    joined = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(rest))
    return joined.select(F.col("node").alias("simhash"), "root")


def _rooted(prints: DataFrame) -> DataFrame:
    """The given distinct fingerprints with `root`, the fingerprint that stands for their group."""
    return prints.join(link(prints), "simhash", "left").withColumn("root", F.coalesce("root", "simhash"))


def near_duplicates(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, simhash, component_id): the smallest key that links of at most RADIUS bits reach.

    One row for each input row. Repeated rows share a fingerprint and hence a component. A null key
    is no candidate for component_id, which is null where a component has no other.
    """
    docs = stored(with_fingerprints(df.select(key, text), text=text, keep=[key]), "simhash-docs")
    prints = stored(docs.groupBy("simhash").agg(F.min(key).alias("least")), "simhash-prints")
    named = _rooted(prints)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select("simhash", "component_id")
    return docs.join(classes, "simhash").select(key, "simhash", "component_id")


def one_of_each(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of texts of similarity 0.8 or more, that of the smallest key; columns as given.

    Similarity is that of the sets of shingles of five words. It is judged by wide fingerprints, which
    differ in at most WIDE_RADIUS bits for nearly all such texts and for few below 0.7; groups are what
    links reach. Texts without words are one group. Groups are told apart by fingerprints, so those without a key, or with a key in common, keep
    a row each. A null key comes last; of rows with equal keys that of the smallest text hash stays.
    """
    digest = F.coalesce(F.md5(F.col(quoted(text)).cast("string")), F.lit(""))
    rows = df.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"), digest.alias("digest"))
    docs = stored(with_wide_fingerprints(rows, keep=["key", "digest"]), "simhash-docs")
    # Texts of one fingerprint share nearly all shingles; the blocks of one of them stand for all.
    prints = stored(docs.groupBy("print").agg(F.min("blocks").alias("blocks"), F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "digest")).alias("least")).withColumn("simhash", F.xxhash64("print")), "simhash-prints")
    best = _rooted(prints).groupBy("root").agg(F.min("least").alias("least"))
    chosen = stored(best.select("root", F.col("least.key").alias("chosen_key"), F.col("least.digest").alias("chosen_digest")), "simhash-chosen")
    whole = df.select(F.struct(*map(F.col, map(quoted, df.columns))).alias("row"), F.col(quoted(key)).alias("key"), digest.alias("digest"))
    kept = whole.join(chosen, F.col("key").eqNullSafe(F.col("chosen_key")) & (F.col("digest") == F.col("chosen_digest")))
    order = Window.partitionBy("root").orderBy("digest")  # rows repeated with key and text
    first = kept.withColumn("n", F.row_number().over(order)).where("n = 1")
    return first.select(*(F.col(f"row.{quoted(c)}") for c in df.columns))
