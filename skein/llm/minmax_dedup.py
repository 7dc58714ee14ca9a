"""Near-duplicate documents by min-max hashing (operator 6).

Every permutation of the shingle hashes gives two signature values, its
minimum and its maximum, so a signature of ``2 * permutations`` values costs
``permutations`` evaluations a shingle. A band takes both values of two
permutations. Documents that share a band are candidates; links are confirmed
on full shingle sets.

Groups are never expanded into all pairs. In each band bucket every member is
compared with the bucket's smallest member (a star, cut into bounded pieces).
Distance 1 - Jaccard is a metric, so after that only pairs which lie in
different components, whose distances to the centre differ by at most the
allowed one, can still add a link. A second round looks for those bucket by
bucket, in blocks: signatures tell which members may have a partner, and the
full sets of these are compared in the block's task. No pair leaves a block,
only a forest of links does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .groups import whole_groups
from .store import prepare, saved
from .words import FIRST, LOWER, Texts, doc_index, mix, text_slices, texts_of, window_starts, windows

WIDTH, PERMUTATIONS, BANDS, PER_CENT = 5, 48, 24, 75
#: Four bits of each signature value are kept, in bit planes. Of the 96 values so many agree at least for any
#: pair at the threshold (expected 0.75 + 0.25 / 16, so 73.5, standard deviation 4.1; this is 5.2 of them lower).
PLANES, SAME_VALUES = 4, 52
BITS = [f"bits{plane}{side}" for plane in range(PLANES) for side in "ab"]
STAR = 256  # members compared with one copy of a star's centre
BLOCK, BLOCK_ELEMENTS = 256, 1 << 20  # members, and shingles of all of them, of one side of a block in the second round
COLUMNS = 8192  # shingles counted at a time
_ELEMENT = np.uint64((1 << 52) - 1)


def shingle_sets(texts: Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(elements, offsets): each document's distinct shingles as sorted 52-bit hashes.

    Shingles are ``width`` consecutive words, A-Z lower-cased; a shorter
    document is one shingle of all its words; without words the set is empty.
    """
    lowered = Texts(LOWER[texts.data], texts.offsets)
    starts, ends, offs = lowered.words()
    hashes = FIRST.segments(lowered.data, starts, ends)
    doc = doc_index(offs)
    whole = window_starts(offs, width)
    shingle = windows(hashes, width)
    shingle = np.concatenate([shingle, np.zeros(len(hashes) - len(shingle), np.uint64)])[whole]
    count = np.diff(offs)
    short = np.flatnonzero((count > 0) & (count < width))
    extra = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = count[short] > k
        extra[has] = mix(extra[has] * np.uint64(31) + hashes[offs[:-1][short[has]] + k])
    extra = mix(extra + count[short].astype(np.uint64))
    keys = np.concatenate([(doc[whole].astype(np.uint64) << np.uint64(52)) | (shingle >> np.uint64(12)),
                           (short.astype(np.uint64) << np.uint64(52)) | (extra >> np.uint64(12))])
    keys.sort()
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    keys = keys[fresh]
    offsets = np.searchsorted(keys, np.arange(texts.size + 1, dtype=np.uint64) << np.uint64(52))
    return keys & _ELEMENT, offsets


def set_ids(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit id of each set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements + np.uint64(7)), dtype=np.uint64)])
    return mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def signatures(elements: np.ndarray, offsets: np.ndarray, permutations: int) -> np.ndarray:
    """(documents with a set) x (2 * permutations): minimum and maximum under each permutation."""
    rng = np.random.default_rng(5)
    factors = rng.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 2**63, permutations, dtype=np.uint64)
    some = np.diff(offsets) > 0
    first = offsets[:-1][some]
    out = np.empty((int(some.sum()), 2 * permutations), np.uint64)
    for k in range(permutations if len(first) else 0):
        values = elements * factors[k] + shifts[k]
        out[:, 2 * k] = np.minimum.reduceat(values, first)
        out[:, 2 * k + 1] = np.maximum.reduceat(values, first)
    return out


def _signed(batches: Iterator[pa.RecordBatch], permutations: int, bands: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        elements, offsets = shingle_sets(texts_of(batch.column("text")))
        sizes = np.diff(offsets)
        some = sizes > 0
        values = signatures(elements, offsets, permutations)
        rows = 2 * permutations // bands
        band = np.zeros((len(values), bands), np.uint64)
        for r in range(rows):
            band = mix(band * np.uint64(31) + values[:, r::rows][:, :bands])
        band = mix(band + np.arange(bands, dtype=np.uint64))
        mixed, half = mix(values), permutations
        packed = []
        for plane in range(PLANES):
            bits = (mixed >> np.uint64(20 + plane)) & np.uint64(1)
            packed += [(bits[:, i * half : (i + 1) * half] << np.arange(half, dtype=np.uint64)).sum(1, dtype=np.uint64) for i in (0, 1)]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * bands)]), pa.int32()),
                                         pa.array(band.ravel().view(np.int64)))
        ids = set_ids(elements, offsets)
        spread = [np.zeros(len(sizes), np.uint64) for _ in packed]
        for full, part in zip(spread, packed, strict=True):
            full[some] = part
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(ids.view(np.int64), mask=~some), lists,
             *(pa.array(x.view(np.int64)) for x in spread)],
            ["doc_id", "n_shingles", "cls", "bands", *BITS])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each needed set, once for every role that asks for it (columns did, text, roles)."""
    for batch in text_slices(batches):
        elements, offsets = shingle_sets(texts_of(batch.column("text")))
        ids = set_ids(elements, offsets).view(np.int64)
        roles = batch.column("roles")
        flat = roles.flatten()
        owner = np.repeat(np.arange(len(roles)), roles.value_lengths().to_numpy(zero_copy_only=False))
        asked = flat.field("cls").to_numpy(zero_copy_only=False)
        good = np.flatnonzero(ids[owner] == asked)
        raw = elements.tobytes()
        for at in range(0, len(good), 512):
            part = good[at : at + 512]
            blobs = [raw[8 * offsets[o] : 8 * offsets[o + 1]] for o in owner[part]]
            taken = flat.take(pa.array(part))
            yield pa.RecordBatch.from_arrays(
                [taken.field("lead"), taken.field("salt"), taken.field("role"), taken.field("cls"), pa.array(blobs, pa.binary())],
                ["lead", "salt", "role", "cls", "elements"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Common elements of each star's centre (role 0, first) and its members."""
    for table, bounds in whole_groups(batches, ["lead", "salt"]):
        role, cls = table.column("role").to_numpy(), table.column("cls").to_numpy()
        lead, blobs = table.column("lead").to_numpy(), table.column("elements").combine_chunks()
        out: list[tuple[int, int, int, int, int]] = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if role[a] != 0:
                continue
            centre = np.frombuffer(blobs[a].as_buffer(), np.uint64)
            for i in range(a + 1, b):
                if role[i]:
                    other = np.frombuffer(blobs[i].as_buffer(), np.uint64)
                    small, large = (centre, other) if len(centre) < len(other) else (other, centre)
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    out.append((lead[i], cls[i], int((large[at] == small).sum()), len(centre), len(other)))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["lead", "cls", "both", "n_lead", "n_cls"])


def _verified(spark: SparkSession, docs: DataFrame, ids: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """(lead, cls, linked, far) for distinct ``pairs`` (lead, cls); ``far`` is 1 - Jaccard. ids: cls -> did."""
    pieces = pairs.groupBy("lead").agg(F.ceil(F.count("*") / STAR).cast("int").alias("pieces"))
    member = pairs.join(pieces, "lead").select(
        "lead", F.pmod(F.xxhash64("cls"), F.col("pieces")).cast("int").alias("salt"), F.lit(1).alias("role"), "cls")
    centre = pieces.select("lead", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("salt"),
                           F.lit(0).alias("role"), F.col("lead").alias("cls"))
    roles = (member.unionByName(centre).join(ids, "cls")
             .groupBy("did", F.floor(F.col("salt") / 64).alias("part"))
             .agg(F.collect_list(F.struct("lead", "salt", "role", "cls")).alias("roles")).select("did", "roles"))
    roles = saved(spark, roles, name)
    sets = docs.join(roles.hint("merge"), "did").select("text", "roles").mapInArrow(_sets, "lead long, salt int, role int, cls long, elements binary")
    compared = (sets.repartition("lead", "salt").sortWithinPartitions("lead", "salt", "role")
                .mapInArrow(_compare, "lead long, cls long, both long, n_lead long, n_cls long"))
    union = F.col("n_lead") + F.col("n_cls") - F.col("both")
    return saved(spark, compared.select("lead", "cls", (100 * F.col("both") >= PER_CENT * union).alias("linked"),
                                        (1 - F.col("both") / union).alias("far")), f"{name}-compared").distinct()


def _hopeful(batches: Iterator[pa.RecordBatch], within: float, most_unlike: int) -> Iterator[pa.RecordBatch]:
    """Members of a block that may link with another one of a different component, by size, distance to the centre and signature."""
    for table, bounds in whole_groups(batches, ["band", "left", "right"]):
        far, size = table.column("far").to_numpy(), table.column("n").to_numpy()
        inside = table.column("cls_in").to_numpy()
        bits = {c: table.column(c).to_numpy().view(np.uint64) for c in BITS}
        keep = np.zeros(table.num_rows, bool)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if (inside[a:b] == inside[a]).all():
                continue
            unlike = np.zeros((b - a, b - a), np.int64)
            for side in "ab":
                differ = np.zeros((b - a, b - a), np.uint64)
                for plane in range(PLANES):
                    x = bits[f"bits{plane}{side}"][a:b]
                    differ |= x[:, None] ^ x
                unlike += np.bitwise_count(differ)
            n = size[a:b]
            pair = ((inside[a:b][:, None] != inside[a:b]) & (np.abs(far[a:b][:, None] - far[a:b]) <= within)
                    & (100 * np.minimum(n[:, None], n) >= PER_CENT * np.maximum(n[:, None], n)) & (unlike <= most_unlike))
            keep[a:b] = pair.any(1)
        if keep.any():
            yield from table.select(["band", "left", "right", "cls"]).filter(pa.array(keep)).combine_chunks().to_batches()


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of every two sets, exact (memory: the elements, a square and ``COLUMNS`` columns)."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    elements = np.concatenate(sets)
    order = np.argsort(elements, kind="stable")
    ranked, owner = elements[order], owner[order]
    fresh = np.ones(len(ranked), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    which = np.cumsum(fresh) - 1
    shared = np.bincount(which)[which] > 1
    owner, which = owner[shared], np.cumsum(fresh[shared]) - 1
    out = np.zeros((len(sets), len(sets)))
    for at in range(0, int(which[-1]) + 1 if len(which) else 0, COLUMNS):
        a, b = np.searchsorted(which, [at, at + COLUMNS])
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[owner[a:b], which[a:b] - at] = 1
        out += has @ has.T
    return out.astype(np.int64)


def _block_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each needed set, once for every block that asks for it (columns text, roles)."""
    for batch in text_slices(batches):
        elements, offsets = shingle_sets(texts_of(batch.column("text")))
        ids = set_ids(elements, offsets).view(np.int64)
        roles = batch.column("roles")
        flat = roles.flatten()
        owner = np.repeat(np.arange(len(roles)), roles.value_lengths().to_numpy(zero_copy_only=False))
        good = np.flatnonzero(ids[owner] == flat.field("cls").to_numpy(zero_copy_only=False))
        raw = elements.tobytes()
        for at in range(0, len(good), 512):
            part = good[at : at + 512]
            taken = flat.take(pa.array(part))
            blobs = [raw[8 * offsets[o] : 8 * offsets[o + 1]] for o in owner[part]]
            yield pa.RecordBatch.from_arrays([*(taken.field(c) for c in ("band", "left", "right", "cls")), pa.array(blobs, pa.binary())],
                                             ["band", "left", "right", "cls", "elements"])


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every member of a block that links, with the smallest member it reaches within the block."""
    for table, bounds in whole_groups(batches, ["band", "left", "right"]):
        cls, blobs = table.column("cls").to_numpy(), table.column("elements").combine_chunks()
        out: list[np.ndarray] = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            members, at = np.unique(cls[a:b], return_index=True)  # ascending: a smaller place is a smaller class
            if len(members) < 2:
                continue
            sets = [np.frombuffer(blobs[int(a + i)].as_buffer(), np.uint64) for i in at]
            sizes = np.array([len(x) for x in sets])
            both = common(sets)
            i, j = np.nonzero(np.triu(100 * both >= PER_CENT * (sizes[:, None] + sizes - both), 1))
            label = np.arange(len(members))
            while True:
                new = label.copy()
                np.minimum.at(new, i, label[j])
                np.minimum.at(new, j, label[i])
                if (new == label).all():
                    break
                label = new
            moved = label != np.arange(len(members))
            out.append(np.stack([members[moved], members[label[moved]]]))
        if out:
            rows = np.concatenate(out, 1)
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["a", "b"])


def minmax_dedup(spark: SparkSession, docs: DataFrame, permutations: int = PERMUTATIONS, bands: int = BANDS) -> DataFrame:
    """Groups of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more.

    ``docs`` needs ``doc_id`` and ``text``. Returns doc_id, n_shingles,
    component_id (smallest doc_id reachable over links, itself included) and
    kept (doc_id = component_id).

    A pair at the threshold is missed by all bands with probability
    ``(1 - 0.75 ** 4) ** 24``, about 1e-4, and less above it. Defined cases:
    null and wordless texts have an empty set and link with nothing; equal
    sets are one class, linked by being equal; rows with a null id take part,
    and a group of only such rows has a null component_id and is kept; rows
    that repeat an id are the same document. Extra columns are ignored.
    """
    prepare(spark)
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = saved(spark, base.mapInArrow(lambda it: _signed(it, permutations, bands),
                                        "doc_id long, n_shingles long, cls long, bands array<long>, " + ", ".join(f"{c} long" for c in BITS)), "signatures")
    nowhere = F.lit(-(2**63)).cast("long")
    classes = rows.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("lo"), F.first("n_shingles").alias("n"), *(F.first(c).alias(c) for c in BITS))
    ids = classes.select("cls", F.coalesce("lo", nowhere).alias("did"))
    known = base.select(F.coalesce("doc_id", nowhere).alias("did"), "text")

    banded = rows.where("cls is not null").select(F.explode("bands").alias("band"), "cls")
    centres = banded.groupBy("band").agg(F.min("cls").alias("lead"), F.max("cls").alias("hi")).where("lead < hi").drop("hi")
    stars = saved(spark, banded.join(centres, "band").where("cls <> lead").distinct(), "stars")
    first = _verified(spark, known, ids, stars.select("lead", "cls").distinct(), "roles")
    links = first.where("linked").select(F.col("lead").alias("a"), F.col("cls").alias("b"))
    label = components(spark, links)

    def labelled(df: DataFrame, column: str) -> DataFrame:
        named = label.select(F.col("node").alias(column), F.col("component").alias(f"{column}_in"))
        return df.join(named, column, "left").withColumn(f"{column}_in", F.coalesce(f"{column}_in", column))

    # members that the star left in another component than their centre, against the rest of their bucket
    judged = labelled(labelled(first, "cls"), "lead")
    apart = judged.where("cls_in <> lead_in").select("lead", "cls")
    left_over = stars.join(apart, ["lead", "cls"], "left_semi")
    near = (judged.select("lead", "cls", "cls_in", "far")
            .join(classes.select("cls", "n", *BITS), "cls"))
    members = (stars.join(left_over.select("band").distinct(), "band", "left_semi").join(near, ["lead", "cls"])
               .select("band", "cls", "cls_in", "far", "n", *BITS))
    cut = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_ELEMENTS)).cast("int")
    blocks = members.groupBy("band").agg(cut.alias("blocks"))
    own, other = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    place = ["band", "left", "right"]
    placed = (members.join(blocks, "band").withColumn("own", own).withColumn("other", other)
              .withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")))
    within = (100 - PER_CENT) / 100 + 1e-9
    most_unlike = 2 * permutations - SAME_VALUES
    hopeful = (placed.select(*place, "cls", "cls_in", "far", "n", *BITS).repartition(*place).sortWithinPartitions(*place)
               .mapInArrow(lambda it: _hopeful(it, within, most_unlike), "band long, left int, right int, cls long"))
    asked = (hopeful.join(ids, "cls").groupBy("did", F.floor(F.col("right") / 16).alias("part"), F.floor(F.col("left") / 16).alias("piece"))
             .agg(F.collect_list(F.struct(*place, "cls")).alias("roles")).select("did", "roles"))
    asked = saved(spark, asked, "again")
    if asked.head(1):
        more = (known.join(asked.hint("merge"), "did").select("text", "roles")
                .mapInArrow(_block_sets, "band long, left int, right int, cls long, elements binary")
                .repartition(*place).sortWithinPartitions(*place).mapInArrow(_block_links, "a long, b long"))
        label = components(spark, label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    placed = labelled(classes.select("cls", "lo"), "cls")
    smallest = placed.groupBy("cls_in").agg(F.min("lo").alias("component_id"))
    answer = placed.join(smallest, "cls_in").select("cls", "component_id")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (rows.select("doc_id", "n_shingles", "cls").join(answer, "cls", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.col("doc_id").eqNullSafe(component).alias("kept")))
