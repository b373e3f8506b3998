"""Exact Jaccard set-similarity joins (C11, J8, J9) as DataFrame programs.

The reference compares all pairs. Here the classic prefix filter (Bayardo et
al. 2007; Xiao et al. 2008, positional filter; Vernica et al. 2010 for the
MapReduce form) generates candidates with an equi-join on rare tokens:

1. a global token order: (document frequency, token) ascending - rare first,
   tokens as 64 bits of their hash; no dense rank is computed, so no
   single-task global sort;
2. the prefix of a set of size n under cutoff t is its first
   n - ceil(t*n) + 1 tokens in that order; two sets with Jaccard >= t share a
   token within both prefixes;
3. candidates: equi-join of prefixes on token with the length filter
   (t*|A| <= |B| <= |A|/t), the positional filter (overlap still possible
   after the first shared prefix token) and the bitmap filter (Sandes et al.
   2020), then distinct pairs;
4. verification with the exact intersection size, in double arithmetic.

The bitmap of a set has, for each of BITMAP_WORDS * 64 hash values, the parity
of its tokens there, so the bits in which two bitmaps differ are at most the
tokens in which the sets differ: (1-t)/(1+t) * (|A|+|B|) of them, if the pair
is similar. Bitmaps travel with the prefixes, so a pair of texts that merely
share a rare word ends inside the join, and no token list is moved for it.

Filters carry a 1e-9 slack in the safe direction, so no true pair is lost.
Token frequencies are joined, not broadcast, unless the vocabulary is checked
small; AQE's skew-join splitting spreads a hot token's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audix.functions.joins import has_at_most
from audix.functions.text import jaccard
from audix.session import cut_lineage

EPS = 1e-9
DEFAULT_CUTOFF = 0.8
VOCAB_BROADCAST_ROWS = 2_000_000
BITMAP_WORDS = 8
BITMAP = [f"bits{i}" for i in range(BITMAP_WORDS)]


def _check_cutoff(t: float) -> None:
    if not (0.0 < t <= 1.0):
        raise ValueError("cutoff must be in (0, 1]; 0 would make every pair similar")


def _bits_of(token):
    """The 64 bits that stand for a token."""
    return F.xxhash64(token)


def _hashed(sets: DataFrame, *more) -> DataFrame:
    """A row for every token of a set, as its 64 bits."""
    return sets.select(*more, F.explode(F.transform("tokens", lambda t: _bits_of(t))).alias("token"))


def _prefix_rows(sets: DataFrame, freq: DataFrame, t: float) -> DataFrame:
    """(id, n, token, pos, bitmap) for the prefix tokens of each set that another set has.
    Tokens that share their 64 bits share a place: all of them are in the prefix where one
    is, so no pair is lost. ``freq`` lacks the tokens of one set, which meet nothing."""
    own = ["id", "h"]
    freq = freq.groupBy(_bits_of(F.col("token")).alias("token")).agg(F.sum("df").alias("df"))
    if has_at_most(freq, VOCAB_BROADCAST_ROWS):
        # sets are dealt before their tokens are rows, which then stay where they are
        ranked = _hashed(sets.repartition(*own), *own).join(F.broadcast(freq), "token", "left")
    else:
        ranked = _hashed(sets, *own).join(freq, "token", "left")
    # not beside the rank: a window's arguments would be shuffled with the rows
    word = F.pmod(F.shiftrightunsigned(F.col("token"), 6), F.lit(BITMAP_WORDS))
    bit = F.expr("shiftleft(1L, cast(token & 63 as int))")
    bits = _hashed(sets, *own).groupBy(*own).agg(
        F.count("*").cast("int").alias("n"),
        *[F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(b) for i, b in enumerate(BITMAP)])
    df = F.coalesce("df", F.lit(1))
    ranked = (ranked.select(*own, "token", df.alias("df"))
              .withColumn("pos", F.rank().over(Window.partitionBy(*own).orderBy("df", "token"))).where(F.col("df") != 1))
    plen = F.col("n") - F.ceil(F.lit(t) * F.col("n") - F.lit(EPS)) + 1
    return ranked.join(bits, own).where(F.col("pos") <= plen).select("id", "n", "token", "pos", *BITMAP)


def _token_freq(*sides: DataFrame) -> DataFrame:
    """(token, df) of the tokens that more than one set has, written once."""
    ex = None
    for s in sides:
        e = s.select(F.explode("tokens").alias("token"))
        ex = e if ex is None else ex.unionByName(e)
    return cut_lineage(ex.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") > 1))


def _candidates(pa: DataFrame, pb: DataFrame, t: float, ordered: bool) -> DataFrame:
    def side(p, x):
        return p.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "pos", *BITMAP)])
    tt = F.lit(t)
    both = F.col("n_a") + F.col("n_b")
    need = F.ceil(tt / (1 + tt) * both - F.lit(EPS))
    bound = 1 + F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    apart = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in BITMAP), F.lit(0))
    cond = ((F.col("n_b") >= tt * F.col("n_a") - EPS) & (F.col("n_a") >= tt * F.col("n_b") - EPS)
            & (bound >= need) & (apart <= (1 - tt) / (1 + tt) * both + EPS))
    if ordered:
        cond = cond & (F.col("id_a") < F.col("id_b"))
    return side(pa, "a").join(side(pb, "b"), "token").where(cond).select("id_a", "id_b").distinct()


def _verify(cand: DataFrame, sa: DataFrame, sb: DataFrame, t: float) -> DataFrame:
    A = sa.select(F.col("id").alias("id_a"), F.col("tokens").alias("ta"))
    B = sb.select(F.col("id").alias("id_b"), F.col("tokens").alias("tb"))
    j = cand.join(A, "id_a").join(B, "id_b")
    inter = F.size(F.array_intersect("ta", "tb"))
    out = j.select("id_a", "id_b", inter.alias("inter"), F.size("ta").alias("n_a"), F.size("tb").alias("n_b"))
    out = out.withColumn("jaccard", jaccard("inter", "n_a", "n_b"))
    return out.where(F.col("jaccard") >= F.lit(t))


def _distinct_sets(sets: DataFrame, id_col: str, tok_col: str) -> DataFrame:
    """Materialised once: the sets feed the frequencies, the prefixes and both
    sides of the verification, so their upstream (e.g. tokenising text) must
    not run four times."""
    return cut_lineage(sets.select(F.col(id_col).alias("id"), F.array_distinct(tok_col).alias("tokens"))
                       .where(F.size("tokens") > 0))


def _collapse_copies(s: DataFrame):
    """Identical token sets -> one representative (smallest id). Returns
    (reps[id, h, tokens], members[id, rep, n]). Candidate generation then runs
    on distinct sets only, so exact copies never inflate a prefix token."""
    keyed = s.select("id", F.array_sort("tokens").alias("tokens"))
    keyed = keyed.withColumn("h", F.xxhash64("tokens")).withColumn("digest", _digest("tokens"))
    reps = cut_lineage(keyed.groupBy("h", "digest", "tokens").agg(F.min("id").alias("rep")))
    members = (keyed.select("id", "h", "digest", F.size("tokens").alias("n")).join(reps.select("h", "digest", "rep"), ["h", "digest"])
               .select("id", "rep", "n"))
    return reps.select(F.col("rep").alias("id"), "h", "tokens"), members


def _digest(tokens: str):
    """SHA-256 of a sorted set, every token after its length: members find their
    representative by it, and no second copy of the texts is shuffled."""
    return F.unhex(F.sha2(F.array_join(F.transform(tokens, lambda t: F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-"))), ""), 256))


def _expand_pairs(rep_pairs: DataFrame, ma: DataFrame, mb: DataFrame, ordered: bool) -> DataFrame:
    a = ma.select(F.col("id").alias("xa"), F.col("rep").alias("id_a"))
    b = mb.select(F.col("id").alias("xb"), F.col("rep").alias("id_b"))
    j = rep_pairs.join(a, "id_a").join(b, "id_b")
    if ordered:
        lo, hi = F.least("xa", "xb"), F.greatest("xa", "xb")
    else:
        lo, hi = F.col("xa"), F.col("xb")
    return j.select(lo.alias("id_a"), hi.alias("id_b"), "inter", "n_a", "n_b", "jaccard")


def similarity_self_join(sets: DataFrame, id_col: str = "id", tok_col: str = "tokens",
                         cutoff: float = DEFAULT_CUTOFF) -> DataFrame:
    """All pairs id_a < id_b with Jaccard >= cutoff.

    Returns (id_a, id_b, inter, n_a, n_b, jaccard). Empty sets never match
    (C11 gives 0). Ids must be unique and orderable. Exact copies are
    collapsed first; their mutual pairs (Jaccard 1) are part of the output."""
    _check_cutoff(cutoff)
    s = _distinct_sets(sets, id_col, tok_col)
    reps, members = _collapse_copies(s)
    pref = _prefix_rows(reps, _token_freq(reps), cutoff)
    cand = _candidates(pref, pref, cutoff, ordered=True)
    rep_pairs = _verify(cand, reps, reps, cutoff)
    between = _expand_pairs(rep_pairs, members, members, ordered=True)
    ca = members.select(F.col("id").alias("id_a"), "rep", "n")
    cb = members.select(F.col("id").alias("id_b"), "rep")
    within = (ca.join(cb, "rep").where(F.col("id_a") < F.col("id_b"))
              .select("id_a", "id_b", F.col("n").alias("inter"), F.col("n").alias("n_a"),
                      F.col("n").alias("n_b"), F.lit(1.0).alias("jaccard")))
    return between.unionByName(within)


def similarity_join(left: DataFrame, right: DataFrame, left_id: str = "id", right_id: str = "id",
                    tok_col: str = "tokens", cutoff: float = DEFAULT_CUTOFF) -> DataFrame:
    """All (left, right) pairs with Jaccard >= cutoff; (id_a = left id, id_b = right id).
    Exact copies on either side are collapsed before candidate generation."""
    _check_cutoff(cutoff)
    sl = _distinct_sets(left, left_id, tok_col)
    sr = _distinct_sets(right, right_id, tok_col)
    rl, ml = _collapse_copies(sl)
    rr, mr = _collapse_copies(sr)
    freq = _token_freq(rl, rr)
    cand = _candidates(_prefix_rows(rl, freq, cutoff), _prefix_rows(rr, freq, cutoff), cutoff, ordered=False)
    return _expand_pairs(_verify(cand, rl, rr, cutoff), ml, mr, ordered=False)
