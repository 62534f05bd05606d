"""Similarity join of documents on word shingles by parity sketches.

A document is the set of its five-word shingles, hashed to 64 bits. Hash values fall into P parts,
and the XOR of a part's values is a sketch of it: a shingle that two documents do not share changes
one part. With similarity s >= t the symmetric difference is at most d = (1-t)/(1+t) * (|A|+|B|), so
of the non-empty parts of the smaller one all but d are the same in both (pigeonhole). Ordered by one
global order, the first d+1 parts of both sides must have one in common. The order takes common parts
last (as counted over a share of the documents), then goes by their own hash: a passage that many
documents hold is offered only by those that have little else. Any order finds the same pairs.

P depends on the size band; documents near a lower bound also emit for the band below. Copies count
once. Candidates are kept apart by size and by the Hamming distance of a second, fixed-width parity
sketch, and are verified on whole shingle sets. Members of a key are compared with one of them first,
with another one of each key while that settles much, and only those still in different components
with each other.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.bytesops import mix, shingle_hashes, space_words, text_slices
from termloom.llm.components import components
from termloom.llm.storage import fresh, keyed, release, stored

#: Members of one key within one task beyond which they skip the exchange by key.
LOCAL_HOT = 16
#: Documents to verify are found by a broadcast of their ids up to this many, by a shuffle beyond.
BROADCAST_ROWS = 1_000_000
#: Entries that a task holds before it packs them.
HELD = 250_000
#: One document in so many is counted for the order of parts; a part is common from so many on. The most frequent go to all tasks.
COUNTED, COMMON, COMMON_MOST = 8, 2, 1 << 20
#: Texts whose sets a task holds at once.
LOT = 500
#: Rounds that compare each member with one of its key, while more pairs than members are open.
ROUNDS = 3
#: The words of the fixed-width sketch, and of the longer one of sets whose pairs are compared within keys.
SKETCH, LONG = [f"s{i}" for i in range(8)], [f"s{i}" for i in range(32)]
#: Documents up to this size take every shingle as a part of its own.
SMALL = 64
_U = np.uint64


def shingle_sets(column: pa.Array, size: int):
    """The sorted distinct shingle hashes of each text, in order."""
    for first, last, data, offsets in text_slices(column):
        words, counts = space_words(data, offsets)
        for i in range(last - first):
            yield np.unique(shingle_hashes(words[counts[i] : counts[i + 1]], size))


def signature(hashes: np.ndarray) -> int:
    """One 64-bit name of a set (copies share it)."""
    total = np.add.reduce(mix(hashes ^ _U(0xA5A5A5A5A5A5A5A5))) if len(hashes) else _U(0)
    return int(mix(np.array([total + _U(len(hashes))], _U)).view(np.int64)[0])


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each of 512 places, as eight words."""
    odd = np.bincount((hashes >> _U(40)).astype(np.int64) % (64 * len(SKETCH)), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(hashes: np.ndarray) -> bytes:
    """Parity at a number of places that grows with the set (a power of two, at least its size and all of LONG)."""
    bits = 1 << max((64 * len(LONG) - 1).bit_length(), (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes >> _U(8)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def wide_distance(x: np.ndarray, y: np.ndarray) -> int:
    """Hamming distance at the narrower width; the wider one folds onto it, as its places do."""
    if len(x) > len(y):
        x, y = y, x
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def _long(batches):
    """(sig, n, *LONG): the wide sketches folded to one width, which all have at least."""
    for batch in batches:
        rows = [np.bitwise_xor.reduce(np.frombuffer(w.as_buffer(), np.int64).reshape(-1, len(LONG)), axis=0) for w in batch.column(2)]
        columns = np.array(rows, np.int64).reshape(-1, len(LONG)).T
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in columns)], names=["sig", "n", *LONG])


def band(n: int) -> int:
    return max(int(n).bit_length(), SMALL.bit_length() - 1)


def all_part_keys(hashes: np.ndarray, threshold_pct: int) -> list[np.ndarray]:
    """The keys of all parts of a set: for its own size band, and for the band of its smallest partner."""
    n, out = len(hashes), []
    for b in {band(n), band(-(-n * threshold_pct // 100))}:
        if b <= band(SMALL - 1):
            keys = hashes
        else:
            parts = _U(1 << (b if b <= 10 else b - 1))
            order = np.argsort(mix(hashes) % parts, kind="stable")
            part = (mix(hashes) % parts)[order]
            heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            keys = np.bitwise_xor.reduceat(hashes[order], heads) + part[heads] * _U(0x9E3779B97F4A7C15)
        out.append(mix(keys ^ _U(b << 56)))
    return out


def part_keys(hashes: np.ndarray, threshold_pct: int, common: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The keys that a set offers: the first of each band, common ones (sorted keys and their counts) last."""
    n = len(hashes)
    if not n:
        return hashes
    # The pair's smaller side has n >= t * partner, so d <= (1-t)/(1+t) * (n + n/t) = n * (1-t)/t.
    keep = n * (100 - threshold_pct) // threshold_pct + 1
    out = []
    for keys in all_part_keys(hashes, threshold_pct):
        if len(keys) > keep and common is not None and len(common[0]):
            at = np.minimum(np.searchsorted(common[0], keys), len(common[0]) - 1)
            often = common[0][at] == keys
            rare = keys[~often]
            if len(rare) < keep:
                turn = np.lexsort((keys[often], common[1][at[often]]))
                keys = np.concatenate([rare, keys[often][turn][: keep - len(rare)]])
            else:
                keys = rare
        out.append(np.partition(keys, keep - 1)[:keep] if len(keys) > keep else keys)
    return np.concatenate(out)


def _counted_keys(size: int, threshold_pct: int):
    """Rows (key, n): in how many of a task's texts a part stands."""

    def counted(keys: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(keys), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["key", "n"])

    def run(batches):
        release()
        seen, keys, held = set(), [], 0
        for batch in batches:
            for hashes in shingle_sets(batch.column(0), size):
                name = signature(hashes)
                if not len(hashes) or name in seen:
                    continue
                seen.add(name)
                keys.append(np.concatenate(all_part_keys(hashes, threshold_pct)))
                held += len(keys[-1])
                if held > 2 * HELD:
                    yield counted(keys)
                    keys, held = [], 0
        if held:
            yield counted(keys)

    return run


def common_parts(docs: DataFrame, size: int, threshold_pct: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of the parts that stand in COMMON or more of one document in COUNTED, sorted by key.

    At most the COMMON_MOST most frequent; they order the parts and decide nothing else.
    """
    some = docs.filter(F.pmod(F.xxhash64("row_"), F.lit(COUNTED)) == 0).select("text")
    counts = some.mapInArrow(_counted_keys(size, threshold_pct), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = stored(counts.filter(F.col("n") >= COMMON))
    total, least = 0, COMMON
    for n, keys in sorted(((r.n, r["count"]) for r in counts.groupBy("n").count().collect()), reverse=True):
        total += keys
        if total > COMMON_MOST:
            least = n + 1
            break
    found = counts.filter(F.col("n") >= least).toArrow()
    keys, n = (found.column(c).to_numpy() for c in ("key", "n"))
    order = np.argsort(keys.view(_U))
    return keys.view(_U)[order], n[order].astype(np.int32)


def _describe(size: int):
    def run(batches):
        release()
        for batch in batches:
            for part in parts(batch):
                sets = list(shingle_sets(part.column(2), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([signature(s) for s in sets], pa.int64()),
                        *(pa.array(c, pa.int64()) for c in np.array([sketch(s) for s in sets]).reshape(-1, len(SKETCH)).T),
                        pa.array([wide_sketch(s) for s in sets], pa.binary()),
                    ],
                    names=["row_", "doc_id", "n", "sig", *SKETCH, "wide"],
                )

    return run


def parts(batch: pa.RecordBatch, rows: int = LOT):
    """The batch in slices of a few rows, so that what is made of their sets stays small."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _key_blobs(size: int, threshold_pct: int, buckets: int, common):
    """Rows (bucket, hot, entries): keys and signatures of a task's documents, packed per bucket.

    Copies within the task are taken once. Members of a key that is frequent within the task are
    known to be repeated; all but a few of them go to a bucket of their own choice.
    """

    def run(batches):
        release()
        seen: set[int] = set()
        keys, sigs, held = [], [], 0

        def packed():
            k, s = np.concatenate(keys), np.concatenate(sigs)
            order = np.argsort(k, kind="stable")
            k, s = k[order], s[order]
            heads = np.r_[True, k[1:] != k[:-1]]
            rank = np.arange(len(k)) - np.flatnonzero(heads)[np.cumsum(heads) - 1]
            hot = rank >= LOCAL_HOT
            rows = []
            for kind, mask, place in ((0, ~hot, k), (1, hot, mix(s[:].copy()))):
                kk, ss, to = k[mask], s[mask], (place[mask] % _U(buckets)).astype(np.int64)
                turn = np.argsort(to, kind="stable")
                kk, ss, to = kk[turn], ss[turn], to[turn]
                for lo, hi in _runs(to):
                    rows.append((int(to[lo]), kind, np.stack([kk[lo:hi], ss[lo:hi]]).tobytes()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)],
                names=["bucket", "hot", "entries"],
            )

        for batch in batches:
            for hashes in shingle_sets(batch.column(0), size):
                name = signature(hashes)
                if not len(hashes) or name in seen:
                    continue
                seen.add(name)
                own = np.unique(part_keys(hashes, threshold_pct, common.value))
                keys.append(own)
                sigs.append(np.full(len(own), name, np.int64).view(_U))
                held += len(own)
                if held > HELD:
                    yield packed()
                    keys, sigs, held = [], [], 0
        if held:
            yield packed()

    return run


def _runs(values: np.ndarray):
    if not len(values):
        return []
    edges = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]
    return zip(edges[:-1], edges[1:], strict=True)


def _repeated(batches):
    """Of the buckets of this task: (key, sig, least) of keys with two different sets or more.

    `least` is the smallest sig of the key. A key of two sets is no more than their pair: it is given once, without
    its key. Hot members come without `least`; their key has LOCAL_HOT others here.
    """
    pieces = []
    for batch in batches:
        for hot, blob in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            both = np.frombuffer(blob.as_buffer(), np.int64).reshape(2, -1)
            if hot:
                yield _members(both[0], both[1], None)
            else:
                pieces.append(both)
    if not pieces:
        return
    both = np.concatenate(pieces, axis=1)
    pieces.clear()
    order = np.lexsort((both[1], both[0]))
    k, s = both[0][order], both[1][order]
    new = np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])]
    k, s = k[new], s[new]
    heads = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    count = np.diff(np.r_[heads, len(k)])
    two = heads[count == 2]
    least, other = np.unique(np.stack([s[two], s[two + 1]]), axis=1)
    for at in range(0, len(least), 200_000):
        yield _members(None, other[at : at + 200_000], least[at : at + 200_000])
    many = np.repeat(count > 2, count)
    k, s, least = k[many], s[many], np.repeat(s[heads], count)[many]
    for at in range(0, len(k), 200_000):
        yield _members(k[at : at + 200_000], s[at : at + 200_000], least[at : at + 200_000])


def _members(keys: np.ndarray | None, sigs: np.ndarray, least: np.ndarray | None) -> pa.RecordBatch:
    none = pa.nulls(len(sigs), pa.int64())
    return pa.RecordBatch.from_arrays(
        [none if keys is None else pa.array(keys), pa.array(sigs), none if least is None else pa.array(least)], names=["key", "sig", "least"]
    )


def _set_blobs(size: int):
    def run(batches):
        release()
        for batch in batches:
            for part in parts(batch):
                sets = pa.array([s.tobytes() for s in shingle_sets(part.column(1), size)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), sets], names=["sig", "hashes"])

    return run


def _verified(threshold_pct: int):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold_pct * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _near(threshold_pct: int):
    def run(batches):
        release()
        for batch in batches:
            keep = [
                wide_distance(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) * (100 + threshold_pct)
                <= (100 - threshold_pct) * n
                for x, y, n in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _named_in(pairs: DataFrame, of_sig: DataFrame) -> DataFrame:
    """The rows of of_sig whose set stands in pairs; the others are not shuffled while these are few."""
    wanted = stored(pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct())
    return of_sig.join(F.broadcast(wanted), "sig", "left_semi") if wanted.count() <= BROADCAST_ROWS else of_sig


def _verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, threshold_pct: int) -> DataFrame:
    """The pairs (a, b) of set names whose whole sets are similar enough; wide sketches are compared before."""
    wide = _named_in(pairs, classes.select("sig", "n", "wide"))
    both = pairs.join(wide.select(F.col("sig").alias("a"), F.col("n").alias("m"), F.col("wide").alias("x")), "a")
    both = both.join(wide.select(F.col("sig").alias("b"), "n", F.col("wide").alias("y")), "b")
    both = both.select("a", "b", "x", "y", (F.col("m") + F.col("n")).alias("n"))
    pairs = stored(both.mapInArrow(_near(threshold_pct), "a long, b long"))
    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()
    wanted = stored(wanted.join(classes, "sig").select("sig", F.col("rep").alias("row_")))
    texts = docs.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, "row_")
    sets = stored(texts.select("sig", "text").mapInArrow(_set_blobs(size), "sig long, hashes binary"))
    left = sets.select(F.col("sig").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("sig").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(_verified(threshold_pct), "a long, b long")


def _may_link(threshold_pct: int, words: list[str] = SKETCH):
    """Sizes and sketches of x and y allow the similarity."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    bits = reduce(lambda a, b: a + b, (F.bit_count(x(c).bitwiseXOR(y(c))) for c in words))
    return (
        (100 * F.least(x("n"), y("n")) >= threshold_pct * F.greatest(x("n"), y("n")))
        & (bits * (100 + threshold_pct) <= (100 - threshold_pct) * (x("n") + y("n")))
    )


def groups(docs: DataFrame, size: int, threshold_pct: int) -> DataFrame:
    """(row_, doc_id, n_shingles, group, component_id) of every row of a keyed table.

    Rows of one group are linked; group is NULL where a text has no shingle.
    """
    docs = docs.select("row_", "doc_id", "text")
    described = docs.mapInArrow(_describe(size), "row_ long, doc_id long, n long, sig long" + "".join(f", {c} long" for c in SKETCH) + ", wide binary")
    described = stored(described)
    classes = stored(
        described.filter("n > 0").groupBy("sig").agg(F.min("row_").alias("rep"), F.min("doc_id").alias("least_id"), *(F.max(c).alias(c) for c in ("n", *SKETCH, "wide")))
    )
    shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    common = docs.sparkSession.sparkContext.broadcast(common_parts(docs, size, threshold_pct))
    blobs = docs.select("text").mapInArrow(_key_blobs(size, threshold_pct, shuffle, common), "bucket long, hot int, entries binary")
    members = blobs.repartition(shuffle, "bucket").mapInArrow(_repeated, "key long, sig long, least long")
    members = stored(members)
    sketches = classes.select("sig", F.struct("n", *SKETCH).alias("v"))

    def possible(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs.distinct())
        own = _named_in(pairs, sketches)
        pairs = pairs.join(own.select(F.col("sig").alias("a"), F.col("v").alias("x")), "a")
        pairs = pairs.join(own.select(F.col("sig").alias("b"), F.col("v").alias("y")), "b")
        return pairs.filter(_may_link(threshold_pct)).select("a", "b")

    # First every member against the smallest of its key, which settles most groups of near copies.
    hot = members.filter("key is not null and least is null").select("key", "sig")
    least = members.filter("key is not null and sig = least").select("key", "least").join(hot.select("key").distinct(), "key", "left_semi")
    pairs = members.select("sig", "least").union(hot.join(least, "key").select("sig", "least")).filter("sig <> least")
    pairs = pairs.select(F.least("least", "sig").alias("a"), F.greatest("least", "sig").alias("b"))
    tried = stored(possible(pairs))
    comps = stored(components(_verify(tried, docs, classes, size, threshold_pct)))

    # Then what is left: keys of three members or more that still lie in different components, one of
    # several that have the same members. While they hold many more pairs than members, every member is
    # compared with one of its key; each key takes another one, so that a member meets several.
    rest, before = members.filter("key is not null"), None
    for turn in range(ROUNDS + 1):
        named = rest.select("key", "sig").join(comps.withColumnRenamed("node", "sig"), "sig", "left")
        named = stored(named.select("key", "sig", F.coalesce("component", "sig").alias("comp")))
        own = named.groupBy("key", "comp").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("sig")).alias("u"), F.bit_xor(F.xxhash64("sig", F.lit(turn + 1))).alias("w"))
        each = own.groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("same"), F.bit_xor("u").alias("u"), F.bit_xor("w").alias("w"))
        once = each.filter("n > 2 and same < n * n").groupBy("n", "u", "w", "same").agg(F.min("key").alias("key"))
        once = stored(once.select("key", "n", ((F.col("n") * F.col("n") - F.col("same")) / 2).alias("open")))
        total = once.agg(F.sum("n"), F.sum("open")).first()
        rest = stored(named.join(once.select("key"), "key"))
        if not total[0] or turn == ROUNDS or total[1] <= 2 * total[0] or (before and total[1] > before / 2):
            break
        before = total[1]
        hub = rest.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "sig", F.lit(turn)), "sig", "comp")).alias("hub")).select("key", "hub.sig", "hub.comp")
        more = rest.alias("x").join(hub.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")))
        more = more.select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b"))
        more = stored(possible(more).join(tried, ["a", "b"], "left_anti"))
        tried = tried.union(more)
        links = comps.toDF("a", "b").union(_verify(more, docs, classes, size, threshold_pct))
        comps = stored(components(links))

    # Last, all pairs of what is open. The join's condition drops what sizes and longer sketches exclude (short ones
    # tell nothing of large sets), and Spark splits the join at frequent keys.
    open_ = stored(rest.select("sig").distinct())
    open_ = F.broadcast(open_) if open_.count() <= BROADCAST_ROWS else open_
    long = classes.select("sig", "n", "wide").join(open_, "sig", "left_semi").mapInArrow(_long, "sig long, n long" + "".join(f", {c} long" for c in LONG))
    rest = stored(rest.join(long, "sig"))
    more = rest.alias("x").join(rest.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.sig") < F.col("y.sig")) & (F.col("x.comp") != F.col("y.comp")) & _may_link(threshold_pct, LONG))
    more = more.select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).distinct()
    more = stored(more.join(tried, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        links = comps.toDF("a", "b").union(_verify(more, docs, classes, size, threshold_pct))
        comps = stored(components(links))

    # Components are named by their smallest document.
    roots = classes.join(comps.withColumnRenamed("node", "sig"), "sig").groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_sig = classes.join(comps.withColumnRenamed("node", "sig"), "sig", "left").join(roots, "component", "left")
    of_sig = of_sig.select("sig", F.coalesce("component", "sig").alias("group"), F.coalesce("component_id", "least_id").alias("component_id"))
    out = described.withColumn("sig", F.when(F.col("n") > 0, F.col("sig"))).join(of_sig, "sig", "left")
    return out.select("row_", "doc_id", F.col("n").alias("n_shingles"), "group", F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_join(docs: DataFrame, size: int = 5, threshold_pct: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Words are runs of other characters than blanks and line ends, A-Z lower-cased. Documents link at
    100 * |A and B| >= threshold_pct * |A or B|; component_id is the smallest doc_id reachable by
    links (NULL if none of them has one). Fewer than `size` words make one shingle; a NULL or empty
    text has no shingle and links with nothing. Repeated texts are one class; doc_id may repeat or be
    NULL. An empty table gives an empty result. Other columns are ignored.
    """
    return groups(keyed(docs.select("doc_id", "text"), compression="zstd"), size, threshold_pct).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, size: int = 5, threshold_pct: int = 75) -> DataFrame:
    """The documents that stay when one of each group of near copies is kept.

    It is the one of the smallest doc_id, a missing one last; of rows that share it, one. Texts without a
    shingle stay.
    """
    (key,) = fresh(docs.columns, "row_")
    rows = keyed(docs, key, compression="zstd")
    of_row = stored(groups(rows.select(F.col(key).alias("row_"), "doc_id", "text"), size, threshold_pct).select("row_", "doc_id", "group"))
    first = of_row.filter("group is not null").groupBy("group").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "row_")).alias("one"))
    kept = first.select("one.row_").union(of_row.filter("group is null").select("row_")).withColumnRenamed("row_", key)
    return rows.join(kept, key, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
