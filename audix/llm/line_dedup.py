"""Line dedup by winnowing.

A document is the sequence of its lines that are not blank, each hashed after
trimming, by 128 bits of BLAKE2 (two lines are taken as equal only where all of
them agree). Grams of NOISE lines are hashed, and in every window of WINDOW grams
the smallest one (the rightmost of equal ones) is a fingerprint; a window spans
RUN = NOISE + WINDOW - 1 lines, so any run of RUN or more equal lines in two
places has a common fingerprint at the same place in both (the guarantee of
winnowing). Shorter agreements are seen by their content: with ``least``, each
run of fewer than RUN lines that holds at least so many bytes (trimmed) is a
window and its own fingerprint; without it they stay.

Fingerprints that occur more than once are joined by position: the windows they
were chosen in are matched with the first place (smallest document, then line)
whose window holds the same lines. Matches on one diagonal (same two documents,
same distance) are neighbours; together they extend each other both ways to the
maximal repeated run. Lines covered by a later occurrence are deleted; the first
occurrence of every window stays.

Hashing runs over whole Arrow slices; everything after it is DataFrame work. A
hot line makes hot keys, which are aggregated before they are shuffled and
looked up by a heavy-key split.

Defined cases: null and blank texts have no lines and stay; blank lines never
match and stay; a document that loses all its lines keeps an empty text;
rows that share doc_id are told apart by their text, and rows equal in both are
one place, which keeps its lines; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.batches import forget, mix64, text_slices
from audix.llm.shared import discard, join_by_key, packed, small, stored

NOISE, WINDOW = 2, 2
# Bytes from which a repeated line, or two, is boilerplate and not a mere phrase.
LEAST_BYTES = 40

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NOT_BLANK = "[^\\x09-\\x0D\\x20]"


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of each line that is not blank, trimmed, as two columns of 64 bits;
    such lines per text; bytes of each)."""
    breaks = np.flatnonzero(data == 0x0A)
    start = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))
    solid = np.flatnonzero(~_SPACE[data])
    if len(solid) == 0:
        return np.zeros((0, 2), np.uint64), np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.int64)
    lo, hi = np.searchsorted(solid, start), np.searchsorted(solid, end)
    full = hi > lo
    a, b = solid[lo[full]], solid[hi[full] - 1] + 1
    text = data.tobytes()
    hashes = b"".join([blake2b(text[i:j], digest_size=16).digest() for i, j in zip(a.tolist(), b.tolist())])
    return np.frombuffer(hashes, np.uint64).reshape(-1, 2), np.diff(np.searchsorted(a, offsets)), b - a


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    m = max(len(hashes) - size + 1, 0)
    g = np.zeros(m, np.uint64)
    for k in range(size):
        g = mix64(g * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + m])
    return g


def fingerprints(hashes: np.ndarray, counts: np.ndarray, noise: int, window: int) -> tuple[np.ndarray, ...]:
    """(text, first line, fingerprint, its line, two hashes of all its lines) of
    every window of the texts of a slice."""
    run = noise + window - 1
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    n = len(hashes) - run + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none, none
    short, whole, check = _grams(hashes[:, 0], noise), _grams(hashes[:, 0], run), _grams(hashes[:, 1], run)
    low, at = short[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, window):
        less = short[k:k + n] <= low
        low, at = np.where(less, short[k:k + n], low), np.where(less, k, at)
    inside = owner[:n] == owner[run - 1:]
    start = place[:n]
    return (owner[:n][inside], start[inside], low[inside].view(np.int64), (start + at)[inside],
            whole[inside].view(np.int64), check[inside].view(np.int64))


def short_windows(hashes: np.ndarray, counts: np.ndarray, sizes: np.ndarray, lines: int,
                  least: int) -> tuple[np.ndarray, ...]:
    """The same of every run of ``lines`` lines of at least ``least`` bytes."""
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    n = max(len(hashes) - lines + 1, 0)
    total = np.concatenate(([0], np.cumsum(sizes)))
    use = (owner[:n] == owner[len(owner) - n:]) & (total[lines:lines + n] - total[:n] >= least)
    salt = np.uint64(lines * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
    mark, check = (mix64(_grams(hashes[:, i], lines)[use] ^ salt).view(np.int64) for i in (0, 1))
    return owner[:n][use], place[:n][use], mark, place[:n][use], mark, check


def _windows(noise: int, window: int, least: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        full = noise + window - 1
        for s in text_slices(batches):
            hashes, counts, sizes = line_hashes(s.data, s.offsets)
            found = [(full, fingerprints(hashes, counts, noise, window))]
            if least is not None:
                found += [(k, short_windows(hashes, counts, sizes, k, least)) for k in range(1, full)]
            for lines, (owner, start, mark, at, whole, check) in found:
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [s.rows.column(0).take(take), s.rows.column(1).take(take), pa.array(start.astype(np.int32)),
                     pa.array(mark), pa.array(at.astype(np.int32)), pa.array(whole), pa.array(check),
                     pa.array(np.full(len(owner), lines, np.int32))],
                    ["did", "th", "start", "mark", "at", "run", "check", "lines"])
    return run


def repeated_runs(docs: DataFrame, noise: int = NOISE, window: int = WINDOW, least: int | None = None) -> DataFrame:
    """(did, th, first, last, from_did, from_th, from_line): maximal runs of
    lines (numbered without blank ones, from 0) that repeat an earlier place."""
    listed = stored(docs.select("did", "th", "text")
                    .mapInArrow(_windows(noise, window, least),
                                "did long, th long, start int, mark long, at int, run long, check long, lines int"), "windows")
    total = listed.count()

    # fingerprints at two or more positions
    marks = (listed.groupBy("mark")
             .agg(F.count("*").alias("n"), F.min(F.struct("did", "th", "at")).alias("lo"),
                  F.max(F.struct("did", "th", "at")).alias("hi"))
             .where(F.col("lo") != F.col("hi")).select("mark", "n"))
    marks = stored(marks, "marks")
    joined = stored(join_by_key(listed, marks, ["mark"], "n", total).drop("n"), "positions")
    discard(listed, marks)

    # every window against the first place with the same lines
    first = (joined.groupBy("mark", "run", "check")
             .agg(F.count("*").alias("n"), F.min(F.struct("did", "th", "start")).alias("f"))
             .where(F.col("n") > 1))
    later = (join_by_key(joined, stored(first, "first"), ["mark", "run", "check"], "n", total)
             .where(F.struct("did", "th", "start") != F.col("f"))
             .select("did", "th", "start", (F.col("start") + F.col("lines") - 1).alias("end"),
                     F.col("f.did").alias("from_did"), F.col("f.th").alias("from_th"),
                     F.col("f.start").alias("from_line")).distinct()
             .withColumn("diagonal", F.col("start") - F.col("from_line")))

    # neighbours on one diagonal extend each other; a window inside others is theirs
    one = ["did", "th", "from_did", "from_th", "diagonal"]
    order = Window.partitionBy(*one).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.col("start") - F.lag("start").over(order) > 1) & (F.col("end") > reach)
    return (later.withColumn("new", F.when(apart, 1).otherwise(0))
            .withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*one, "part")
            .agg(F.min("start").alias("first"), F.max("end").alias("last"), F.min("from_line").alias("from_line"))
            .select("did", "th", "first", "last", "from_did", "from_th", "from_line"))


RESULTS = ["n_lines", "n_removed", "n_runs"]


def line_dedup(docs: DataFrame, noise: int = NOISE, window: int = WINDOW, least: int | None = None) -> DataFrame:
    """All rows and columns of ``docs``, the text without its later repeated
    runs (of whole windows, and with ``least`` also shorter ones of so many
    bytes), with n_lines and n_removed (lines that are not blank) and n_runs."""
    base = (packed(docs, RESULTS)
            .withColumn("did", F.coalesce(F.col("doc_id"), F.lit(-2**63)))
            .withColumn("th", F.xxhash64(F.coalesce("text", F.lit("")))))
    runs = repeated_runs(base.select("did", "th", "text"), noise, window, least)
    per_doc = runs.groupBy("did", "th").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    covered = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"]))))
    hit = stored(per_doc.select("did", "th", F.size("runs").alias("n_runs"), covered.alias("covered")), "covered")
    joined = base.join(small(hit, 64, F.size("covered")), ["did", "th"], "left")

    lines = F.split("text", "\n")
    solid = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(_NOT_BLANK), i)), lambda i: i.isNotNull())
    gone = F.transform("covered", lambda k: F.get("solid", k))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    cut = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    hit_row = F.col("n_runs").isNotNull()
    return (joined.withColumn("lines", lines).withColumn("solid", solid)
            .withColumn("gone", F.when(hit_row, gone))
            .withColumn("text", F.when(hit_row, cut).otherwise(F.col("text")))
            .withColumn("n_lines", F.coalesce(F.size("solid"), F.lit(0)))
            .withColumn("n_removed", F.when(hit_row, F.size("covered")).otherwise(0))
            .withColumn("n_runs", F.coalesce("n_runs", F.lit(0)))
            .select("row.*", "text", *RESULTS))
