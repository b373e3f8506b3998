"""MinHash near-dedup by fast similarity sketching.

A document's set holds its distinct word shingles (words ``[^\\x20\\x09-\\x0D]+``
of the text with A-Z lower-cased; fewer words than a shingle: the whole sequence
as one). Each set is sketched into T coordinates in rounds: in round i < T every
element falls into one hashed bin with a value in [i, i+1); in round T+i every
element goes to bin i. A coordinate keeps its smallest value, and rounds stop as
soon as every bin is filled, so each coordinate is always filled, equal sets get
equal sketches, and two coordinates agree with a probability concentrated around
the Jaccard similarity. Sketches are cut into bands; sets that share a band are
candidates; every link is confirmed on the full sets.

No group is expanded into all its pairs:

1. equal sets collapse to one representative (two-level, heavy keys split off);
2. in each band bucket every member is compared with one head, the member whose
   buckets are largest (for copies of one text: the text itself);
3. links give components; only members of one bucket that are still in different
   components are compared with each other, and of those only pairs left possible
   by two exact bounds: shingles that a set shares with no other there are in no
   intersection (an edited copy has many), and what two sets have in common with
   the bucket's head limits what they share inside and outside it, as does the
   triangle inequality of the Jaccard distance. Pairs inside a component add
   nothing to it.

Defined cases: null or wordless texts have an empty set and stay alone; rows
that repeat a doc_id are one vertex, linked by any of their sets; a null doc_id
has no component; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.batches import forget, mix64, ragged, random_words, spread, text_slices
from audix.llm.components import components
from audix.llm.shared import discard, join_by_key, ship, small, stored

SHINGLE_WORDS = 5
BANDS, BAND_ROWS = 32, 4
T = BANDS * BAND_ROWS

_BYTE = random_words(256, 7)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
# Bytes of a word up to which a polynomial modulo 2**64 tells words apart. Longer ones of the
# Thue-Morse kind would collide under any base; they are hashed by BLAKE2.
SHORT_WORD = 64


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, words per text) of the texts of a slice."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts_of_text = offsets[:-1][offsets[:-1] < n]
    first[starts_of_text] = inside[starts_of_text]
    start = np.flatnonzero(first)
    if len(start) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    word = np.cumsum(first) - 1
    where = np.flatnonzero(inside)
    word = word[where]
    place = where - start[word]
    power = np.cumprod(np.full(SHORT_WORD, _BASE, np.uint64))
    terms = _BYTE[_LOWER[data[where]]] * power[np.minimum(place, SHORT_WORD - 1)]
    begin = np.searchsorted(where, start)
    sums = np.add.reduceat(terms, begin)
    size = np.diff(np.append(begin, len(where))).astype(np.uint64)
    counts = np.diff(np.searchsorted(start, offsets))
    hashes = mix64(sums ^ (size * np.uint64(0xD6E8FEB86659FD93)))
    for i in np.flatnonzero(size > SHORT_WORD):
        word = _LOWER[data[start[i]:start[i] + int(size[i])]]
        hashes[i] = int.from_bytes(blake2b(word.tobytes(), digest_size=8).digest(), "little")
    return hashes, counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes back to back, set size per text)."""
    w, counts = word_hashes(data, offsets)
    n = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    begin = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, np.int64)
    at = spread(begin, n)
    h = np.zeros(len(at), np.uint64)
    left = np.repeat(np.minimum(counts, words), n)
    for k in range(words):
        have = left > k
        h = np.where(have, mix64(h * _BASE + w[np.minimum(at + k, max(len(w) - 1, 0))] + np.uint64(k + 1)), h)
    sets, sizes, i = [], np.zeros(len(n), np.int64), 0
    for d, m in enumerate(n):
        if m:
            s = np.sort(h[i:i + m])
            if m > 1:
                s = s[np.append(True, s[1:] != s[:-1])]
            sets.append(s)
            sizes[d] = len(s)
            i += m
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def sketches(sets: np.ndarray, sizes: np.ndarray, t: int = T) -> np.ndarray:
    """(texts, t) sketch matrix; rows of empty sets hold the largest value."""
    out = np.full((len(sizes), t), _EMPTY, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    seeds = random_words(2 * t, 11)
    live = sizes > 0
    items, own = sets, owner
    for i in range(2 * t):
        h = mix64(items ^ seeds[i])
        value = np.uint64(i << 54) | (h >> np.uint64(10))
        place = (h & np.uint64(1023)) % np.uint64(t) if t & (t - 1) else h & np.uint64(t - 1)
        bin_ = place.astype(np.int64) if i < t else np.full(len(items), i - t)
        np.minimum.at(flat, own * t + bin_, value)
        live = live & (out == _EMPTY).any(axis=1)
        if not live.any():
            break
        keep = live[own]
        if not keep.all():
            items, own = items[keep], own[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """(texts, bands) 64-bit keys, the band's number mixed in."""
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(random_words(bands, 13), (len(sketch), bands)).copy()
    for r in range(rows):
        key = mix64(key * _BASE + parts[:, :, r])
    return key


def _sketched(bands: int, rows: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for s in text_slices(batches):
            sets, sizes = shingle_sets(s.data, s.offsets, words)
            keys = band_keys(sketches(sets, sizes, bands * rows), bands, rows)
            keys = keys[sizes > 0]
            bound = np.concatenate(([0], np.cumsum(sizes)))
            one, two = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
            for total, salt in ((one, 17), (two, 19)):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(sets ^ np.uint64(salt)), dtype=np.uint64)))
                total[:] = sums[bound[1:]] - sums[bound[:-1]]
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0), pa.array(sizes), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                 ragged(keys.reshape(-1).view(np.int64), np.where(sizes > 0, bands, 0), pa.int64())],
                ["doc_id", "n_shingles", "set_1", "set_2", "bands"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches):
            sets, sizes = shingle_sets(s.data, s.offsets, words)
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0), ragged(sets.view(np.int64), sizes, pa.int64())], ["doc_id", "items"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b) plus ``common`` and ``both``, sizes of intersection and union."""
    common = F.size(F.array_intersect("items_a", "items_b"))
    return (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b")), "b")
            .select("a", "b", common.alias("common"),
                    (F.size("items_a") + F.size("items_b") - common).alias("both")))


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = SHINGLE_WORDS,
                    bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links
    with 100 * |A and B| >= percent * |A or B|) and kept, one row per document."""
    ship(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = stored(base.mapInArrow(
        _sketched(bands, rows, words),
        "doc_id long, n_shingles long, set_1 long, set_2 long, bands array<long>"), "sketches")
    full = sketched.where(F.col("n_shingles") > 0)

    # 1. equal sets
    key = ["n_shingles", "set_1", "set_2"]
    groups = full.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    repeated = stored(groups.where(F.col("n") > 1), "repeated")
    n_rows = sketched.count()
    member = stored(join_by_key(full.select("doc_id", *key), repeated, key, "n", n_rows)
                    .select("doc_id", "rep", *key), "members")
    spare = member.where(F.col("doc_id") != F.col("rep")).select("doc_id", *key)
    reps = full.join(spare, ["doc_id", *key], "left_anti")
    # an id of several sets keeps the others, and links them to its copies
    sets_of = F.struct(*key)
    twofold = (full.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
               .agg(F.min(sets_of).alias("lo"), F.max(sets_of).alias("hi")).where(F.col("lo") != F.col("hi")))
    equal = stored(member.where(F.col("doc_id") != F.col("rep")).join(twofold.select("doc_id"), "doc_id", "left_semi")
                   .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "equal")

    # 2. band buckets of at least two sets
    rows_ = stored(reps.select("doc_id", "n_shingles", F.explode("bands").alias("key")), "bands")
    buckets = stored(rows_.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1), "buckets")
    inside = stored(join_by_key(rows_, buckets, ["key"], "n", n_rows), "inside")
    discard(rows_, buckets, repeated)
    weight = inside.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    placed = stored(inside.join(weight, "doc_id"), "placed")
    discard(inside)
    heads = (placed.groupBy("key")
             .agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("neg"), "n_shingles")).alias("h"),
                  F.count("*").alias("n"))
             .select("key", "n", (-F.col("h.neg")).alias("head"), F.col("h.n_shingles").alias("head_size")))
    headed = stored(join_by_key(placed.drop("n"), heads, ["key"], "n", n_rows), "headed")

    discard(placed)

    # 3. members against heads, on full sets
    need = stored(headed.select("doc_id").distinct(), "need")
    sets = stored(base.join(small(need, 16), "doc_id", "left_semi")
                  .mapInArrow(_sets(words), "doc_id long, items array<long>"), "sets")
    star = headed.where(F.col("doc_id") != F.col("head")).select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    checked = stored(_verified(star.distinct(), sets), "checked")
    linked = 100 * F.col("common") >= percent * F.col("both")
    links = checked.where(linked).select("a", "b").unionByName(equal)
    found = components(links)

    # 4. members of one bucket that are still apart
    distance = 1 - F.col("common") / F.col("both")
    member_of = (headed
                 .join(checked.select(F.col("a").alias("doc_id"), F.col("b").alias("head"), distance.alias("d"),
                                      F.col("common").alias("with_head")),
                       ["doc_id", "head"], "left")
                 .join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
                 .select("key", "doc_id", "n_shingles",
                         F.when(F.col("doc_id") == F.col("head"), 0.0).otherwise(F.col("d")).alias("d"),
                         F.when(F.col("doc_id") == F.col("head"), F.col("n_shingles"))
                         .otherwise(F.col("with_head")).alias("with_head"),
                         F.coalesce("component", "doc_id").alias("component")))
    member_of = stored(member_of, "placement")
    discard(headed)
    per = member_of.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = per.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.count("*").alias("parts"),
                                   F.sum("n").alias("n")) \
        .where(F.col("parts") > 1).select("key", "n", F.col("m.component").alias("major"))
    apart = stored(join_by_key(member_of, mixed, ["key"], "n", n_rows), "apart")
    discard(member_of)

    # shingles that no other set in such a bucket holds are in no intersection here
    still = stored(apart.select("doc_id").distinct(), "still")
    single = (sets.join(small(still, 16), "doc_id", "left_semi").select("doc_id", F.explode("items").alias("item"))
              .groupBy("item").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("other"))
              .where(F.col("doc_id") == F.col("other")))
    shared = stored(single.groupBy("doc_id").agg(F.count("*").alias("own")), "own")
    # the bounds hold for one set a vertex: ids of several texts go without them
    several = sets.groupBy("doc_id").agg((F.count("*") > 1).alias("several"))
    rows_ = (apart.join(shared, "doc_id", "left").join(several, "doc_id")
             .withColumn("common", F.col("n_shingles") - F.coalesce("own", F.lit(0)))
             .where(F.col("several") | (100 * F.col("common") >= percent * F.col("n_shingles"))))
    # with the band keys, a pair is named by its first common bucket alone
    own_bands = sketched.join(small(still, 16), "doc_id", "left_semi").select("doc_id", "bands").dropDuplicates(["doc_id"])
    rows_ = stored(rows_.join(own_bands, "doc_id"), "left_apart")
    slack = 1 - percent / 100 + 1e-9
    x, y = rows_.where(F.col("component") != F.col("major")).alias("x"), rows_.alias("y")
    # common shingles lie in the head, or outside it among the shared ones
    most = F.least("x.with_head", "y.with_head") + F.least(F.col("x.common") - F.col("x.with_head"),
                                                           F.col("y.common") - F.col("y.with_head"))
    here = F.array_position("x.bands", F.col("x.key"))
    first = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True)
    pairs = (x.join(y, (F.col("x.key") == F.col("y.key"))
                    & (F.col("x.component") != F.col("y.component"))
                    & ((F.col("y.component") == F.col("y.major")) | (F.col("x.doc_id") < F.col("y.doc_id")))
                    & (F.col("x.several") | F.col("y.several")
                       | ((100 * most >= percent * (F.col("x.n_shingles") + F.col("y.n_shingles") - most))
                          & (F.abs(F.col("x.d") - F.col("y.d")) <= slack)
                          & (first == here))))
             .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
             .distinct())
    tried = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = stored(_verified(pairs.join(tried, ["a", "b"], "left_anti"), sets).where(linked).select("a", "b"), "more")

    discard(sets, apart, rows_)

    # components of all links; equal sets hang on their representative
    final = components(links.unionByName(more)) if not more.isEmpty() else found
    rep_of = (member.select("doc_id", "rep").join(final.select(F.col("id").alias("rep"), "component"), "rep", "left")
              .select("doc_id", F.coalesce("component", "rep").alias("component")))
    alone = final.join(member.select(F.col("doc_id").alias("id")), "id", "left_anti") \
        .select(F.col("id").alias("doc_id"), "component")
    label = rep_of.unionByName(alone)
    return (sketched.select("doc_id", "n_shingles").join(label.dropDuplicates(["doc_id"]), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))
