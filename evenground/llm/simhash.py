"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint has one bit for each bit of the shingles' hashes, set where more
than half of the hashes have it.  Distinct fingerprints are put into
``2**(radius+1) - 1`` tables.  Bit ``i`` has a non-zero vector ``m(i)`` of
``radius + 1`` bits, and table ``v`` keeps the bits whose vector has an odd
product with ``v``.  Up to ``radius`` differing bits span fewer than
``radius + 1`` dimensions, so some ``v`` is orthogonal to all of them: that
table keeps none of these bits and the pair shares its key.  No pair within
the radius is missed, whatever the data.

Pairs within a bucket are never listed.  Two fingerprints differ in ``radius``
bits or fewer (an even radius) exactly if some value is within ``radius / 2``
bits of both.  Each member of a bucket of two or more names the values around
it (bits outside the bucket's mask only), and members that name the same value
are linked to the smallest of them: as many rows as members times a constant,
also for a bucket that holds a third of the corpus.

Two texts with a good part of their shingles in common differ in a few bits
more than the radius as often as not.  Several fingerprints, from hashes that
are mixed anew, each have their own chance; a link in one of them is enough.

``similar`` links by the similarity itself.  Fingerprints within the radius
and equal bands of least hashes only name candidates; at a similarity of 0.8
one of 20 bands of 5 is equal in 99.9 % of cases.  The shingle sets of both
sides of a candidate link are then compared exactly: first those of a bucket
with its smallest one, then all pairs of a bucket that links have not joined
yet.  A parity bitmap bounds the difference of such a pair from below, so that
few sets are compared whole; large buckets are cut into cells of two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenground.llm.common import components, text_batches
from evenground.llm.pieces import FACTOR, mix
from evenground.session import discard, written

BITS = 64
SEED = 42
STEP = 1 << 16
#: bits of a set's parity bitmap; sets and shingles of a block of a bucket
PARITY = 1024
BLOCK_SETS = 1024
BLOCK_SHINGLES = 1 << 22


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of the ``size``-word shingles of a UTF-8 text, A-Z lowered.
    A shorter text is one shingle; a text without words has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-size])).tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))


def voted(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have; 0 without hashes."""
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), STEP):
        part = hashes[k : k + STEP].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, size: int) -> int:
    return voted(shingle_hashes(text, size))


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", size: int = 3, times: int = 1) -> DataFrame:
    """``keys`` of every row, its fingerprint as ``fp BIGINT`` and ``times - 1``
    further ones in ``more``."""
    text_batches(docs.sparkSession)
    fields = [docs.schema[k] for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keys)).cast(pa.binary()).to_pylist()
            fps, more = [], []
            for t in texts:
                hashes = shingle_hashes(t or b"", size)
                fps.append(voted(hashes))
                more.append([_signed(voted(mix(hashes + np.uint64(int(FACTOR) * k % 2**64)))) for k in range(1, times)])
            columns = [pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(more, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), *columns], [*keys, "fp", "more"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "fp bigint, more array<bigint>"])
    return docs.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_")).mapInArrow(run, schema)


def masks(radius: int) -> list[int]:
    """The covering masks over 64 bits."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(BITS)]
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _tables(radius: int) -> Column:
    """Array of (mask, changes): the changes are up to radius/2 free bits."""
    out = []
    for mask in masks(radius):
        free = [1 << i for i in range(BITS) if not mask >> i & 1]
        changes = [sum(c) for k in range(radius // 2 + 1) for c in combinations(free, k)]
        out.append(f"named_struct('mask', {_signed(mask)}L, 'changes', array({', '.join(f'{_signed(c)}L' for c in changes)}))")
    return F.expr(f"array({', '.join(out)})".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)"))


def links(distinct: DataFrame, radius: int = 2, by: tuple[str, ...] = ()) -> DataFrame:
    """Edges ``(a, b)`` that connect ``distinct (fp)`` exactly as all pairs
    within ``radius`` bits would; with ``by``, apart for each of its values."""
    if radius % 2 or radius < 2:
        raise ValueError("the radius is even and at least 2")
    keyed = distinct.select(*by, "fp", F.posexplode(_tables(radius)).alias("t", "table")).selectExpr(
        *by, "fp", "t", "fp & table.mask AS key", "table.changes AS changes"
    )
    full = keyed.groupBy(*by, "t", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select(*by, "t", "key")
    members = keyed.join(full, [*by, "t", "key"], "left_semi")
    near = written(members.select(*by, "fp", F.explode("changes").alias("c")).selectExpr(*by, "fp", "fp ^ c AS value").distinct(), "near")
    stars = near.groupBy(*by, "value").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select(*by, "value", "lo")
    return near.join(stars, [*by, "value"]).where("fp <> lo").selectExpr(*by, "fp AS a", "lo AS b").distinct()


def _further_links(fps: DataFrame, radius: int) -> DataFrame:
    """Edges between first fingerprints by the others: rows that share one of
    these are linked to the row with the smallest first one, and so are rows of
    linked ones."""
    own = written(fps.select("fp", F.posexplode("more").alias("k", "v")).distinct(), "further")
    least = written(own.groupBy("k", "v").agg(F.min("fp").alias("m")), "least")
    same = own.join(least, ["k", "v"]).where("fp <> m").selectExpr("fp AS a", "m AS b")
    pairs = links(least.selectExpr("k", "v AS fp"), radius, ("k",))
    one, two = least.selectExpr("k", "v AS a", "m AS x"), least.selectExpr("k", "v AS b", "m AS y")
    near = pairs.join(one, ["k", "a"]).join(two, ["k", "b"]).where("x <> y").selectExpr("x AS a", "y AS b")
    return same.unionByName(near)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, radius: int = 2, times: int = 1,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``carry``, ``fp``,
    ``fingerprint`` (hex) and ``component_id``, the smallest key that links
    reach.  Links are those of ``times`` independent fingerprints together.

    NULL texts count as empty, texts without words have fingerprint 0 and are
    linked like any other; rows with a NULL key are linked, but their key is
    no component id unless the component has no other; repeated rows and keys
    give one result row each; an empty table gives no rows.  Other columns of
    ``docs`` are not read.
    """
    fps = written(fingerprints(docs, [key, *carry], text, size, times), "fingerprints")
    groups = fps.groupBy("fp").agg(F.min(key).alias("first_"))
    edges = links(fps.select("fp").distinct(), radius)
    if times > 1:
        edges = edges.unionByName(_further_links(fps, radius))
    roots = components(edges).withColumnRenamed("node", "fp")
    linked = groups.join(roots, "fp")
    linked = linked.join(linked.groupBy("root").agg(F.min("first_").alias("least_")), "root").select("fp", "least_")
    named = groups.join(linked, "fp", "left").select("fp", F.coalesce("least_", "first_").alias("component_id"))
    return fps.join(named, "fp").select(
        key, *carry, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _described(docs: DataFrame, keys: list[str], text: str, size: int, bands: int, rows: int) -> DataFrame:
    """``keys``, the checksum ``sid`` of the set of shingles, its size ``n``,
    the fingerprint ``fp`` and ``bands`` of ``rows`` least hashes."""
    text_batches(docs.sparkSession)
    fields = [docs.schema[k] for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = [np.uint64(int(FACTOR) * (k + 1) % 2**64) for k in range(bands * rows)]
        for batch in batches:
            out = []
            for t in batch.column(len(keys)).cast(pa.binary()).to_pylist():
                hashes = shingle_hashes(t, size)
                own = np.unique(hashes)
                least = np.array([mix(own + s).min() for s in steps] if len(own) else [0] * len(steps), np.uint64).reshape(bands, rows)
                named = [_signed(xxhash.xxh64_intdigest(x.tobytes(), k)) for k, x in enumerate(least)]
                out.append((_set_name(own), len(own), _signed(voted(hashes)), named))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), *columns], [*keys, "sid", "n", "fp", "bands"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "sid bigint, n bigint, fp bigint, bands array<bigint>"])
    return docs.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_")).mapInArrow(run, schema)


def _set_name(own: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(own.tobytes(), SEED))


def _parity(own: np.ndarray) -> np.ndarray:
    """One bit for each of ``PARITY`` classes of hashes: is their number odd?
    Two sets differ in at least as many hashes as their bitmaps in bits."""
    odd = np.bincount((own % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, text: str, size: int) -> DataFrame:
    """``sid``, ``shingles`` and parity ``bits`` of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, size)) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_name(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([_parity(s) for s in sets], pa.list_(pa.int64()))], names=["sid", "shingles", "bits"])

    return docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_")).mapInArrow(run, "sid bigint, shingles array<bigint>, bits array<bigint>")


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The ``pairs (a, b)`` of at least this similarity."""
    one, two = sets.selectExpr("sid AS a", "shingles AS x"), sets.selectExpr("sid AS b", "shingles AS y")
    both = pairs.select("a", "b").distinct().join(one, "a").join(two, "b")
    common = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("c"), (F.size("x") + F.size("y")).alias("total"))
    return written(common.where(F.col("c") >= least * (F.col("total") - F.col("c")) - 1e-9).select("a", "b"), "alike")


def _open_pairs(table: pa.Table, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a cell, each with the later ones that may be alike by sizes and
    bitmaps and are of another component; in a cell of two blocks with those
    of the other block."""
    n, root, block = (table.column(c).to_numpy() for c in ("n", "root", "block"))
    bits = np.concatenate([c.flatten().to_numpy() for c in table.column("bits").chunks]).view(np.uint64).reshape(len(n), -1)
    crossed, apart = block.min() < block.max(), (1 - least) / (1 + least)
    for i in range(len(n) - 1):
        most = (n[i] + n[i + 1 :]) * apart + 1e-6
        fit = (root[i + 1 :] != root[i]) & (np.abs(n[i + 1 :] - n[i]) <= most)
        if crossed:
            fit &= block[i + 1 :] != block[i]
        js = np.flatnonzero(fit)
        if len(js):
            differ = np.bitwise_count(bits[i + 1 + js] ^ bits[i]).sum(axis=1, dtype=np.int64)
            yield i, i + 1 + js[differ <= most[js]]


def _within_buckets(rest: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)`` between the roots of all sets that share a bucket and
    are of at least this similarity; ``rest`` is ``t, v, sid, n, root``.  A cell
    gives as many links as join its components, however many pairs are alike."""
    kind = "t int, v bigint, cell bigint, block bigint, sid bigint, n bigint, root bigint, bits array<bigint>"
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    size = rest.groupBy("t", "v").agg(blocks.alias("k"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("t", "v", "k")
    placed = rest.join(size, ["t", "v"]).withColumn("block", F.expr("pmod(xxhash64(sid), k)"))
    cells = placed.withColumn("o", F.explode(F.expr("sequence(0L, k - 1)"))).selectExpr(
        "t", "v", "least(block, o) * k + greatest(block, o) AS cell", "block", "sid", "n", "root")

    def candidates(table: pa.Table) -> pa.Table:
        kept = np.zeros(table.num_rows, bool)
        for i, js in _open_pairs(table, least):
            kept[js] = True
            kept[i] |= len(js) > 0
        return table.filter(pa.array(kept))

    def linked(table: pa.Table) -> pa.Table:
        root, shingles = table.column("root").to_pylist(), table.column("shingles")
        up, out = {r: r for r in root}, []

        def top(r: int) -> int:
            while up[r] != r:
                up[r] = r = up[up[r]]
            return r

        for i, js in _open_pairs(table, least):
            one = shingles[i].values.to_numpy()
            for j in js.tolist():
                if top(root[i]) != top(root[j]):
                    two = shingles[j].values.to_numpy()
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    if both >= least * (len(one) + len(two) - both) - 1e-9:
                        up[top(root[i])] = top(root[j])
                        out.append((root[i], root[j]))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    keys = ["t", "v", "cell"]
    near = written(cells.join(sets.select("sid", "bits"), "sid").select(*keys, "block", "sid", "n", "root", "bits").groupBy(*keys).applyInArrow(candidates, kind), "open")
    found = written(near.join(sets.select("sid", "shingles"), "sid").groupBy(*keys).applyInArrow(linked, "a bigint, b bigint"), "within")
    discard(near)
    return found


def similar(docs: DataFrame, key: str, text: str = "text", size: int = 5, least: float = 0.8, radius: int = 2, bands: int = 20, rows: int = 5,
            carry: tuple[str, ...] = (), by_fingerprint: bool = False) -> DataFrame:
    """One row for each row of ``docs``: ``key`` (unique and not NULL), ``carry``
    and ``component_id``, the smallest key that links reach.  Two texts are
    linked if their sets of ``size``-word shingles have a Jaccard similarity of
    ``least`` or more; with ``by_fingerprint`` also if their fingerprints differ
    in ``radius`` bits or fewer.

    The members of a bucket are compared with its smallest set; where one of
    them is unlike it, all its pairs that no link has joined yet are compared.
    NULL texts count as empty; texts without words are equal to each other.
    Copies of a set may have fingerprints of their own, which all count.
    """
    rows_ = written(_described(docs, [key, *carry], text, size, bands, rows), "described")
    nodes = written(rows_.groupBy("sid").agg(F.min(key).alias("first_")), "nodes")
    # one row for each set, and for each of its fingerprints
    own = rows_.join(nodes.select(F.col("first_").alias(key)), key, "left_semi")
    prints = written(rows_.groupBy("sid", "fp").agg(F.first("n").alias("n")), "prints")
    within = links(prints.select("fp").distinct(), radius)
    members = own.select("sid", "n", F.posexplode("bands").alias("t", "v"))
    if by_fingerprint:
        # texts that share these buckets are linked whatever their sets
        first = prints.groupBy("fp").agg(F.min("sid").alias("m"))
        same = prints.join(first, "fp").where("sid <> m").selectExpr("sid AS a", "m AS b")
        both = within.join(first.selectExpr("fp AS a", "m AS x"), "a").join(first.selectExpr("fp AS b", "m AS y"), "b")
        by_prints = same.unionByName(both.selectExpr("x AS a", "y AS b"))
    else:
        near = within.selectExpr("a AS fp", "b AS lo").unionByName(within.selectExpr("b AS fp", "b AS lo")).distinct()
        by_fp = prints.select("sid", "n", F.lit(-1).alias("t"), F.col("fp").alias("v"))
        stars = prints.join(near, "fp").select("sid", "n", F.lit(-2).alias("t"), F.col("lo").alias("v")).distinct()
        members = members.unionByName(by_fp).unionByName(stars)
    full = members.groupBy("t", "v").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo < hi").select("t", "v")
    members = written(members.join(full, ["t", "v"], "left_semi"), "buckets")
    # the texts of sets that share a bucket are read again, one for each set
    shared = nodes.join(members.select("sid").distinct(), "sid", "left_semi").select(F.col("first_").alias(key))
    sets = written(_sets(docs.select(key, text).join(shared, key, "left_semi"), text, size), "sets")
    centre = members.groupBy("t", "v").agg(F.min(F.struct("sid", "n")).alias("c"))
    starred = members.join(centre, ["t", "v"]).where("sid <> c.sid").select(
        "t", "v", F.least("sid", "c.sid").alias("a"), F.greatest("sid", "c.sid").alias("b"), F.col("n").alias("m"), F.col("c.n").alias("k"))
    pairs = written(starred, "pairs")
    # sets of very different sizes can't be similar
    found = _alike(pairs.where(F.least("m", "k") >= least * F.greatest("m", "k") - 1e-9), sets, least)
    mixed = pairs.join(found, ["a", "b"], "left_anti").select("t", "v").distinct()
    edges = found.unionByName(by_prints) if by_fingerprint else found
    roots = components(edges).withColumnRenamed("node", "sid")
    rest = members.join(mixed, ["t", "v"], "left_semi").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rest = written(rest.select("t", "v", "sid", "n", "root"), "mixed")
    joined = components(_within_buckets(rest, sets, least)).selectExpr("node AS sid", "root AS upper")
    # a set without a root of its own may be joined to others
    roots = roots.join(joined.selectExpr("sid AS root", "upper"), "root", "left").select("sid", F.coalesce("upper", "root").alias("root")).unionByName(
        joined.join(roots, "sid", "left_anti").selectExpr("sid", "upper AS root"))
    linked = nodes.join(roots, "sid")
    linked = linked.join(linked.groupBy("root").agg(F.min("first_").alias("least_")), "root").select("sid", "least_")
    named = nodes.join(linked, "sid", "left").select("sid", F.coalesce("least_", "first_").alias("component_id"))
    discard(members, sets, pairs, rest)
    return rows_.select(key, *carry, "sid").join(named, "sid").select(key, *carry, "component_id")
