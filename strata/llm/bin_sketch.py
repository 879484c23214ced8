"""Document fingerprints by one-permutation MinHash, in SQL functions only.

Every shingle of a text is hashed once. The high bits of the hash choose one of
``BINS`` bins and each bin keeps its least hash. A bin without shingles takes the
value of a filled one: it tries bins in an order that depends only on its own number
until one is filled (optimal densification), so texts that agree on the filled bins
agree on the copies too. Of each bin only the ``BITS`` low-order bits are kept, and
:func:`likeness` takes the chance that they agree by accident off the share of equal
bins.

Shingles are the runs of five words of a text; words are what white space (``\\x20``,
``\\x09-\\x0D``) leaves of the text in lower case. A shorter text is one shingle. Texts are
read whole; null texts are empty; a text without words has the empty fingerprint,
which is like another empty one (1.0) and like nothing else (0.0).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 256          # a power of two
BITS = 8            # kept of each bin: a power of two, 32 at most
WIDTH = 5           # words of a shingle
TRIES = 16          # bins that an empty one tries before it ranks all filled ones
BUCKET_ROWS = 256   # documents between two bounds of :func:`with_next`, on average
MOST_BOUNDS = 1 << 16   # so its bounds are 1 MB at most, whatever the table's size
_OVERSAMPLE = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text in lower case."""
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit("\t\n\v\f\r "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """64-bit hashes of a text's shingles, repeats included."""
    def of(w: Column) -> Column:
        n = F.size(w)
        runs = F.transform(F.sequence(F.lit(0), n - width),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return (F.when(n >= width, runs).when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", w))))
                .otherwise(F.array().cast("array<bigint>")))
    return _let(words(text), of)


def bin_values(hashes: Column, bins: int = BINS) -> Column:
    """The hash that each bin holds after densification; hashes must not be empty."""
    shift = 64 - (bins.bit_length() - 1)
    low = (1 << shift) - 1
    # One largest hash per bin, so that the sorted list has every bin and no filled one begins with it.
    last = F.lit([(b << shift) | low for b in range(-bins // 2, bins // 2)])

    def least(s: Column) -> Column:
        """The first of every bin, null where that is the largest hash."""
        firsts = F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(s, i - 1), shift)))
        return F.transform(firsts, lambda x: F.when(x.bitwiseAND(F.lit(low)) != F.lit(low), x))

    def dense(d: Column, own: Column) -> Column:
        def ranked(i: Column) -> Column:
            """The filled bin of least hash with this one; its place stands in the low bits."""
            order = F.transform(own, lambda x, at: F.xxhash64(i, F.shiftright(x, shift)).bitwiseAND(F.lit(-bins)).bitwiseOR(at))
            return F.get(own, F.array_min(order).bitwiseAND(F.lit(bins - 1)).cast("int"))
        return F.transform(d, lambda x, i: F.coalesce(
            x, *[F.get(d, F.pmod(F.xxhash64(F.lit(k), i), F.lit(bins)).cast("int")) for k in range(TRIES)], ranked(i)))
    return _let(F.sort_array(F.concat(hashes, last)),
                lambda s: _let(least(s), lambda d: _let(F.array_compact(d), lambda own: dense(d, own))))


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> Column:
    """The low-order bits of all bins, packed into 64-bit numbers; none for a text without words."""
    if bins & (bins - 1) or bits & (bits - 1) or bits > 32 or bins * bits < 64:
        raise ValueError("bins and bits must be powers of two, bits 32 at most, 64 bits or more in all")
    lanes, low = 64 // bits, F.lit((1 << bits) - 1)

    def packed(h: Column) -> Column:
        def lane(v: Column, i: Column) -> Column:
            out = F.get(v, i * lanes).bitwiseAND(low)
            for k in range(1, lanes):
                out = out.bitwiseOR(F.shiftleft(F.get(v, i * lanes + k).bitwiseAND(low), k * bits))
            return out
        numbers = _let(bin_values(h, bins), lambda v: F.transform(F.sequence(F.lit(0), F.lit(bins // lanes - 1)), lambda i: lane(v, i)))
        return F.when(F.size(h) > 0, numbers).otherwise(F.array().cast("array<bigint>"))
    return _let(shingle_hashes(text, width), packed)


def as_text(print_: Column) -> Column:
    """A fingerprint in hexadecimal, 16 digits a number."""
    return F.lower(F.concat_ws("", F.transform(print_, lambda x: F.lpad(F.hex(x), 16, "0"))))


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of two texts from their fingerprints (0 to 1)."""
    chance = 2.0 ** -bits
    ones = sum(1 << k for k in range(0, 64, bits))
    ones -= (ones >> 63) << 64

    def folded(d: Column, step: int) -> Column:
        return _let(d, lambda v: v.bitwiseOR(F.shiftrightunsigned(v, step)))

    def differing(x: Column, y: Column) -> Column:
        """Bins of one number that differ: every bin's bits are gathered in its lowest one."""
        d, step = x.bitwiseXOR(y), bits // 2
        while step:
            d = folded(d, step)
            step //= 2
        return F.bit_count(d.bitwiseAND(F.lit(ones)))
    unlike = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda n, x: n + x)
    share = F.lit(1.0) - unlike / F.lit(bins)
    empty = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(a == b, F.lit(1.0)).when(empty, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), (share - chance) / (1 - chance)))


def _bounds(keys: DataFrame) -> tuple[list[int], list[int], int]:
    """Keys that cut all into runs of about BUCKET_ROWS (longer if MOST_BOUNDS would not do), the least one included.

    A key is taken if its hash says so, so about eight times the bounds meet in one
    task and every eighth is kept: at most some 500,000, however long the table."""
    n = keys.count()
    wanted = max(1, min(MOST_BOUNDS, n // BUCKET_ROWS))
    taken = F.pmod(F.xxhash64("__mark", "__key"), F.lit(max(n, 1))) < wanted * _OVERSAMPLE
    both = F.struct("__key", "__mark")
    row = (keys.agg(F.min(both).alias("first"), F.sort_array(F.collect_set(F.when(taken, both))).alias("all"))
           .select(F.array_union(F.filter(F.array("first"), lambda x: x.isNotNull()),
                                 F.filter("all", lambda x, i: i % _OVERSAMPLE == 0)).alias("b")).first())
    return [x["__key"] for x in row["b"]], [x["__mark"] for x in row["b"]], n


def with_next(docs: DataFrame, id_col: str, text_col: str, carried: dict[str, Column]) -> DataFrame:
    """Every row with columns of the row after it: ascending ids, after the last the first.

    ``carried`` maps a name to an expression over ``docs``; the result has ``id_col`` (as
    bigint), ``text_col`` (null: empty), the carried columns and ``next_<name>`` of the
    text and each carried one. Other columns are left behind, so none can clash.

    Null ids come first; rows of one id are ordered by the hash of their text, so equal
    rows are neighbours. The texts are shuffled once: bounds from a sample of the ids
    cut the order into buckets, and a bucket's first document is also sent, as its last
    row, to the bucket before."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    least = -(1 << 63)
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(least))
    keys, marks, _ = _bounds(docs.select(key.alias("__key"), F.xxhash64(text).alias("__mark")))

    def listed(values: list[int]) -> Column:      # one literal: the list is folded before the job starts
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    if not keys:
        keys, marks = [least], [least]
    ids, hashes = listed(keys), listed(marks)
    own_key, own_mark = F.col("__key"), F.col("__mark")

    def at(i: Column) -> tuple[Column, Column]:
        return F.get(ids, i - 1), F.get(hashes, i - 1)

    def step(p: Column, s: Column) -> Column:
        k, m = at(p + s)
        return F.when((k < own_key) | ((k == own_key) & (m <= own_mark)), p + s).otherwise(p)

    steps = [1 << k for k in reversed(range(len(keys).bit_length()))]
    rows = docs.select(F.col(id_col).cast("bigint").alias("__id"), key.alias("__key"), F.xxhash64(text).alias("__mark"),
                       text.alias("__text"), *[c.alias(f"__c{i}") for i, c in enumerate(carried.values())])
    placed = rows.withColumn("__bucket", F.aggregate(F.lit(steps), F.lit(0), step))
    k, m = at(F.col("__bucket"))
    before = F.when(F.col("__bucket") > 1, F.col("__bucket") - 1).otherwise(F.lit(len(keys)))
    own = F.struct(F.col("__bucket").alias("bucket"), F.lit(0).alias("tail"))
    sent = F.when((k == own_key) & (m == own_mark), F.array(own, F.struct(before.alias("bucket"), F.lit(1).alias("tail"))))
    dealt = placed.withColumn("__to", F.explode(F.coalesce(sent, F.array(own)))).withColumn("__bucket", F.col("__to.bucket")) \
        .withColumn("__tail", F.col("__to.tail")).drop("__to")
    order = Window.partitionBy("__bucket").orderBy("__tail", "__key", "__mark")
    names = {"__text": text_col} | {f"__c{i}": name for i, name in enumerate(carried)}
    ahead = dealt.select("__id", "__tail", *names, *[F.lead(c).over(order).alias(f"__next{c}") for c in names])
    return ahead.where("__tail = 0").select(F.col("__id").alias(id_col), *[F.col(c).alias(n) for c, n in names.items()],
                                            *[F.col(f"__next{c}").alias(f"next_{n}") for c, n in names.items()])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the first code points of the next document (ascending id, after
    the last the first) in place of the last half of its own. Columns: ``id_col``,
    ``n_chars``, ``edited_sha256``, ``fingerprint`` and ``edited_fingerprint`` (hexadecimal), ``near_edited`` and
    ``near_next``. An empty table gives an empty result; for repeated ids see :func:`with_next`."""
    pairs = with_next(docs, id_col, text_col, {"print": fingerprint(F.col(text_col))})
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr(text_col, F.lit(1), F.col("n_chars").cast("int") - half), F.substr(f"next_{text_col}", F.lit(1), half))
    changed = (pairs.withColumn("n_chars", F.length(text_col).cast("bigint"))
               .select(id_col, "n_chars", "print", "next_print", edited.alias("edited")))
    both = changed.select(id_col, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "print", "next_print",
                          fingerprint(F.col("edited")).alias("edited_print"))
    return both.select(id_col, "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"),
                       as_text(F.col("edited_print")).alias("edited_fingerprint"),
                       likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                       likeness(F.col("print"), F.col("next_print")).alias("near_next"))


__all__ = ["words", "shingle_hashes", "bin_values", "fingerprint", "as_text", "likeness", "with_next", "edited_fingerprints"]
