"""N-gram Jaccard join with bitmap signatures (operator 5).

Two texts link when their sets of word shingles are similar enough.  Equal
sets are one class from the start.  A link needs a shared shingle among the
first of both sets in one fixed order (prefix filter; shingles that a sample
of texts shows to be frequent come last).  First every class is held against
the most central class of each of its prefix shingles, which joins big groups of
copies with linear work.  Then every prefix shingle whose classes
are not all joined yet is a tile: its members, in order of size, are paired
with those of their size band as far as the shingle's places allow a link, and
the hashed bitmaps of a pair bound its overlap from above by their bit counts.
What the bound lets through is verified on the whole sorted arrays of shingle
hashes, and the links' components are the result.  They are not the join's
links: pairs of classes that are joined already are never compared, so neither
all links nor the number of links of a document can be had from here.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_intermediates
from .common import mix64, read, slices, stored, text_key, utf8
from .graph import components
from .shingles import shingle_sets

FEWEST_BITS, MOST_BITS = 512, 1 << 16   # of a bitmap; in between two to four bits per shingle
TILE_ROWS = 256          # larger tiles are cut into blocks, and pairs of blocks are tiles
SAMPLE_ONE_IN = 16       # texts looked at for frequent shingles: they only order the prefixes
FREQUENT_FROM = 4        # in the sample
MAX_FREQUENT = 1 << 18   # frequent shingles that are broadcast (2 MB)
FILTER_BITS = 1 << 28    # largest bit filter sent to the tasks (32 MB)


def bitmap(values: np.ndarray) -> bytes:
    """Hashed bits of a set, a power of two that follows its size."""
    size = min(max(FEWEST_BITS, 1 << (2 * len(values) - 1).bit_length()), MOST_BITS) if len(values) else FEWEST_BITS
    bits = np.zeros(size, np.uint8)
    bits[(mix64(values) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (one per row) folded to ``words`` 64-bit words."""
    return np.bitwise_or.reduce(maps.reshape(len(maps), -1, words), axis=1)


def needed_overlap(size_a, size_b, num: int, den: int):
    """Smallest intersection with den * i >= num * (a + b - i)."""
    return -(-(num * (size_a + size_b)) // (num + den))


def may_link(sizes_a, maps_a: list[bytes], sizes_b, maps_b: list[bytes], num, den) -> np.ndarray:
    """False where the bit counts show that the overlap is too small: every
    bit of one set that the other lacks stands for an element it lacks.
    Bitmaps of different sizes are folded to the smaller one."""
    words_a, words_b = (np.array([len(x) >> 3 for x in m], np.int64) for m in (maps_a, maps_b))
    out = np.zeros(len(sizes_a), bool)
    least = needed_overlap(sizes_a, sizes_b, num, den)
    for wa, wb in np.unique(np.column_stack([words_a, words_b]), axis=0).tolist():
        at = np.flatnonzero((words_a == wa) & (words_b == wb))
        w = min(wa, wb)
        for lo in range(0, len(at), 1 << 14):
            i = at[lo:lo + (1 << 14)]
            x = folded(np.frombuffer(b"".join([maps_a[j] for j in i]), np.uint64).reshape(len(i), wa), w)
            y = folded(np.frombuffer(b"".join([maps_b[j] for j in i]), np.uint64).reshape(len(i), wb), w)
            only_a = np.bitwise_count(x & ~y).sum(1, dtype=np.int64)
            only_b = np.bitwise_count(y & ~x).sum(1, dtype=np.int64)
            out[i] = np.minimum(sizes_a[i] - only_a, sizes_b[i] - only_b) >= least[i]
    return out


def frequent_shingles(texts: DataFrame, words: int) -> np.ndarray:
    """Sorted hashes, at most MAX_FREQUENT, of shingles that many texts of a
    sample share.  Any set gives the same result; this one keeps tiles small."""
    def run(batches):
        seen = set()
        for b in slices(batches, limit=2 << 20):
            new = [i for i, k in enumerate(b.column("tkey").to_pylist()) if k not in seen and not seen.add(k)]
            values, _ = shingle_sets(*utf8(b.column("text").take(pa.array(new, pa.int32()))), words)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["s"])

    sample = texts.where(F.pmod(F.xxhash64("tkey"), F.lit(SAMPLE_ONE_IN)) == 0)
    counted = sample.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= FREQUENT_FROM)
    top = counted.orderBy(F.desc("count"), "s").limit(MAX_FREQUENT).select("s").toArrow()
    return np.sort(top["s"].to_numpy().view(np.uint64))


def described(texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """doc_id, tkey, n, set_hash, bits, small (the bitmap folded to its least
    size) and prefix."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    frequent = frequent_shingles(texts, words)

    def run(batches):
        for b in slices(batches, limit=2 << 20):
            values, offs = shingle_sets(*utf8(b.column("text")), words)
            common = np.zeros(len(values), bool)
            if len(frequent):
                common = frequent[np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)] == values
            digest, bits, small, prefix, ends = [], [], [], [], [0]
            for lo, hi in zip(offs[:-1], offs[1:]):
                v, n = values[lo:hi], hi - lo
                digest.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest() if n else None)
                bits.append(bitmap(v))
                small.append(folded(np.frombuffer(bits[-1], np.uint64)[None], FEWEST_BITS // 64).tobytes())
                c = common[lo:hi]
                p = n - -(-num * n // den) + 1 if n else 0
                prefix.append(np.concatenate([v[~c], v[c]])[:p])
                ends.append(ends[-1] + p)
            flat = np.concatenate([*prefix, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("tkey"), pa.array(np.diff(offs), pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(bits, pa.binary()), pa.array(small, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["doc_id", "tkey", "n", "set_hash", "bits", "small", "prefix"])

    return texts.select("doc_id", "tkey", "text").mapInArrow(
        run, f"doc_id {kind}, tkey binary, n long, set_hash binary, bits binary, small binary, prefix array<long>")


def bounded(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose sizes and bitmaps allow a link."""
    x = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ma"))
    y = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("mb"))

    def run(batches):
        for t in batches:
            if t.num_rows:
                na, nb = t.column("na").to_numpy(), t.column("nb").to_numpy()
                ok = may_link(na, t.column("ma").to_pylist(), nb, t.column("mb").to_pylist(), num, den)
                yield t.select(["a", "b"]).filter(pa.array(ok))

    sized = pairs.join(x, "a").join(y, "b").where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
    return sized.mapInArrow(run, "a long, b long")


def bit_filter(keys: DataFrame, place, expected: int) -> tuple[np.ndarray, int]:
    """A bit at ``place(number of bits)`` of each key, as 64-bit words; at
    most FILTER_BITS bits.  The bits are put together before the shuffle."""
    size = 1 << 16
    while size < min(FILTER_BITS, 8 * expected):
        size <<= 1
    words = keys.select(place(size).alias("at")).groupBy(F.shiftright("at", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out, size


def verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs that link, by exact intersection of the whole shingle arrays.

    Only the texts of the pairs' classes are turned into arrays again; a bit
    filter of bounded size spares the others, and the join makes it exact."""
    with run_intermediates() as own:
        found = _linking(pairs, sets, texts, words, num, den)
    links = stored(found, "links")
    own.release(pairs.sparkSession)
    return links


def _linking(pairs: DataFrame, sets: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    needed = stored(pairs.select("a").union(pairs.select("b")).distinct()
                    .join(sets.select(F.col("sid").alias("a"), "tkey"), "a").select(F.col("a").alias("sid"), "tkey"), "needed")
    expected = needed.count()
    if not expected:
        return pairs.select("a", "b").limit(0)
    words_of, size = bit_filter(needed, lambda n: F.pmod(F.xxhash64("tkey"), F.lit(n)), expected)

    def arrays(batches):
        seen = set()
        for b in slices(batches, limit=2 << 20):
            at = b.column("at").to_numpy()
            hit = np.flatnonzero(words_of[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            keys = b.column("tkey").take(pa.array(hit)).to_pylist()
            new = [j for j, k in enumerate(keys) if k not in seen and not seen.add(k)]
            rows = pa.array(hit[new])
            values, offs = shingle_sets(*utf8(b.column("text").take(rows)), words)
            yield pa.RecordBatch.from_arrays(
                [b.column("tkey").take(rows), pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(values.view(np.int64)))], ["tkey", "items"])

    every = texts.select("tkey", "text", F.pmod(F.xxhash64("tkey"), F.lit(size)).alias("at")).mapInArrow(arrays, "tkey binary, items array<long>")
    whole = stored(needed.join(every.dropDuplicates(["tkey"]), "tkey").select("sid", "items"), "arrays")

    # den * i >= num * (a + b - i); rows with two arrays stay in the JVM, where they are not gathered into batches
    overlap, sizes = F.size(F.array_intersect("ia", "ib")), F.size("ia") + F.size("ib")
    both = (pairs.join(whole.select(F.col("sid").alias("a"), F.col("items").alias("ia")), "a")
            .join(whole.select(F.col("sid").alias("b"), F.col("items").alias("ib")), "b"))
    return both.where(overlap.cast("long") * (num + den) >= sizes.cast("long") * num).select("a", "b")


def with_components(sets: DataFrame, joined: DataFrame) -> DataFrame:
    """``sets`` with the component reached so far; a class alone is its own."""
    return (sets.join(joined.select(F.col("node").alias("sid"), "comp"), "sid", "left")
            .withColumn("comp", F.coalesce("comp", "sid")))


def leader_pairs(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Each class with the leaders of its prefix shingles, as far as the sizes
    and the shingle's places allow a link: at most one pair per prefix shingle,
    most of them the same.  Of the classes of a size band the leader is the one
    where the shingle comes earliest: rare shingles come first, so it has the
    fewest of its own, as the middle of a group of near copies has."""
    band = F.floor(F.log("n") / float(np.log(den / num))) if num < den else F.col("n")
    posts = sets.select("sid", "n", band.cast("long").alias("band"), F.posexplode("prefix").alias("pos", "key"))
    first = F.min_by(F.struct("sid", "n", "pos"), F.struct("pos", F.xxhash64("sid"), "sid"))
    leaders = posts.groupBy("key", "band").agg(first.alias("to"), F.count("*").alias("rows")).where("rows > 1").select("key", "band", "to")
    most = F.least(F.col("n") - F.col("pos"), F.col("to.n") - F.col("to.pos"))
    return (posts.join(leaders, ["key", "band"]).where((F.col("sid") != F.col("to.sid")) & (most * (num + den) >= (F.col("n") + F.col("to.n")) * num))
            .select(F.greatest("sid", "to.sid").alias("a"), F.least("sid", "to.sid").alias("b")).distinct())


def tile_pairs(sets: DataFrame, joined: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes not joined yet that share a prefix shingle and whose
    sizes, places of it and small bitmaps allow a link.  Tiles of over TILE_ROWS members are
    cut into blocks by a hash, and every pair of blocks is a tile of its own."""
    posts = with_components(sets.select("sid", "n", "prefix"), joined).select("sid", "comp", "n", F.posexplode("prefix").alias("pos", "key"))
    open_keys = posts.groupBy("key").agg(F.count("*").alias("rows"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key", "rows")
    tiles = (posts.join(open_keys, "key").join(sets.select("sid", "small"), "sid").withColumn("blocks", F.ceil(F.col("rows") / TILE_ROWS).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "sid", "comp", "n", "pos", "small", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "sid"))

    def compare(batches):
        rest = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            key, i, j = (t[c].to_numpy() for c in ("key", "i", "j"))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            cut = int(np.flatnonzero(new)[-1])             # the last tile may go on in the next batch
            if cut:
                yield from tile_batch(t.slice(0, cut), new[:cut], num, den)
            rest = t.slice(cut)
        if rest is not None:
            new = np.zeros(rest.num_rows, bool)
            new[0] = True
            yield from tile_batch(rest, new, num, den)

    return tiles.mapInArrow(compare, "a long, b long").distinct()


def tile_batch(t: pa.Table, new: np.ndarray, num: int, den: int):
    """Compare every member with the next, the next but one, ... of its tile
    while the sizes stay in its band.  If the tile's shingle is the first that
    two sets share, they share no more than what follows it in each."""
    tile = np.cumsum(new)
    n, pos, comp, sid, block = (t[c].to_numpy() for c in ("n", "pos", "comp", "sid", "block"))
    off = t["i"].to_numpy() != t["j"].to_numpy()
    maps = np.frombuffer(b"".join(t["small"].to_pylist()), np.uint64).reshape(len(n), -1)
    at, step = np.arange(len(n)), 1
    while len(at):
        at = at[at + step < len(n)]
        to = at + step
        band = (tile[at] == tile[to]) & (n[at] * den >= n[to] * num)
        at, to = at[band], to[band]
        test = ((comp[at] != comp[to]) & (~off[at] | (block[at] != block[to]))
                & (np.minimum(n[at] - pos[at], n[to] - pos[to]) >= needed_overlap(n[at], n[to], num, den)))
        x, y = at[test], to[test]
        if len(x):
            only_x = np.bitwise_count(maps[x] & ~maps[y]).sum(1, dtype=np.int64)
            only_y = np.bitwise_count(maps[y] & ~maps[x]).sum(1, dtype=np.int64)
            ok = np.minimum(n[x] - only_x, n[y] - only_y) >= needed_overlap(n[x], n[y], num, den)
            x, y = x[ok], y[ok]
        if len(x):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(sid[x], sid[y])), pa.array(np.maximum(sid[x], sid[y]))], ["a", "b"])
        step += 1


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, tkey (128 bits naming the text) per row.

    Two texts link when den * |intersection| >= num * |union| of their sets of
    ``words``-word shingles (A-Z lowered; a shorter text is one shingle).
    Null, empty and wordless texts have no shingle and link with nothing:
    their component is their own id.  The components are returned, not the
    links; those inside a joined group are mostly not looked for.  component_id
    is the smallest id that links reach; null ids count only where a component has no other.  Repeated
    rows are in one component and each is returned.  An empty table gives no
    rows.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), text_key().alias("tkey"))
    rows = stored(described(texts, words, num, den), "shingled")
    sets = stored(rows.where("n > 0").groupBy("set_hash").agg(
        F.min("doc_id").alias("least_id"), *(F.first(c).alias(c) for c in ("tkey", "n", "bits", "small", "prefix")))
        .withColumn("sid", F.monotonically_increasing_id()), "sets")
    pairs = stored(bounded(leader_pairs(sets, num, den), sets, num, den), "pairs")
    links = verified(pairs, sets, texts, words, num, den)
    joined = stored(components(links), "joined")
    pairs = stored(bounded(tile_pairs(sets, joined, num, den), sets, num, den), "pairs")
    links = links.union(verified(pairs, sets, texts, words, num, den))
    comps = components(links)
    grouped = sets.select("set_hash", "sid", "least_id").join(comps.withColumnRenamed("node", "sid"), "sid", "left").select(
        "set_hash", "least_id", F.coalesce("comp", "sid").alias("comp"))
    least = grouped.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = grouped.join(least, "comp").select(F.col("set_hash"), "component_id")
    return rows.join(named, "set_hash", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "tkey")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: 3-word shingles, similarity of at least 0.9."""
    return near_duplicates(read(spark, sf_dir, "documents"), 3, 90, 100).drop("tkey")
