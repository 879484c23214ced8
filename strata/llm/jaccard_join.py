"""Near-duplicate groups by shingle Jaccard similarity with a token-group matrix.

1. *Groups.* Documents with equal sets collapse to one key. Keys that agree
   in several min-hashes with the leader of their buckets are compared with it; the
   components of the verified links are the groups. Keys outside all groups then
   meet other leaders, chosen anew in every round and from grown groups first, until
   none joins any more (every key left is a group of its own).
2. *Matrix.* Tokens have one global order: ordinary tokens by hash, frequent
   ones last. A set's prefix is its first ``n - ceil(t n) + 1`` tokens. The
   matrix holds, per token and group, the union of the members' prefixes with
   the range of their sizes.
3. *Bound.* For a query set and a foreign group, the number of matching prefix
   tokens bounds the overlap with any member; groups below it stay closed.
4. *Open.* Members of open groups are compared exactly.

The order only steers cost: results are exact for any order, and no posting,
bucket or candidate is capped. The table of frequent tokens has a fixed size,
as have the bitmaps that select which sets and tokens to send on; a full bitmap
sends more and loses nothing.

Null or blank texts have an empty set and are linked with nothing. Repeated
rows are linked with each other. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.bitmap import bitmap, hit
from strata.llm.graph import components, merged, saved
from strata.llm.words import mix, shingle_sets, slices
from strata.session import shuffles_go, small_batches

FREQUENT_TOKENS = 1 << 16   # size of the table of frequent tokens
FREQUENT_FROM = 64          # least count of a frequent token
COUNTED_AT_ONCE = 1 << 21   # shingles counted together; a token below CHUNK_LEAST there is not reported
CHUNK_LEAST = 4
HASHES = 12         # min-hashes per set
PROBES = 32         # members of a large group compared first
WIDER = 3           # growth of the portions compared after them
AGREE = 4           # of these, to be compared with a bucket's leader
LIKELY = 6          # of these, to be compared with another leader later
ROUNDS = 2          # times that keys outside all groups look for another leader, at most

_ODD = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def _need(n, num, den):
    """ceil(t n) for integers, columns and arrays."""
    return -((-n * num) // den)


def _sets(batches) -> Iterator[tuple]:
    """Row runs with the shingle sets of their last column."""
    for batch in batches:
        for part in slices(batch, text=batch.num_columns - 1):
            yield part, shingle_sets(part.column(batch.num_columns - 1))


def _key(own: np.ndarray) -> bytes:
    return blake2b(own.tobytes(), digest_size=16).digest()


def frequent_tokens(texts: DataFrame) -> np.ndarray:
    """The most frequent shingles of all documents, rarest first (bounded table)."""
    def count(batches):
        held, size = [], 0

        def counted():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= CHUNK_LEAST
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))],
                names=["token", "n"])
        for _, sets in _sets(batches):
            for own in sets:
                held.append(own)
                size += len(own)
                if size >= COUNTED_AT_ONCE:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    with shuffles_go(texts.sparkSession):
        rows = (texts.select("text").mapInArrow(count, "token long, n long")
                .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_FROM)
                .orderBy(F.desc("n"), "token").limit(FREQUENT_TOKENS).collect())
    return np.array([r.token for r in rows[::-1]], dtype=np.int64).view(np.uint64)


def _in_order(own: np.ndarray, hot: np.ndarray, rank: np.ndarray, mask: np.ndarray):
    """Cold tokens of a sorted set, and its frequent ones by rank."""
    maybe = mask[(own & np.uint64(len(mask) - 1)).astype(np.int64)]
    if not len(hot) or not maybe.any():
        return own, own[:0], rank[:0]
    at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
    is_hot = maybe & (hot[at] == own)
    r = rank[at[is_hot]]
    order = np.argsort(r)
    return own[~is_hot], own[is_hot][order], r[order]


def describe(texts: DataFrame, frequent: np.ndarray, num: int, den: int) -> DataFrame:
    """Per row of ``texts(id, mark, text)``: set size, set key, prefix, order of its last token, min-hashes."""
    order = np.argsort(frequent)
    hot = frequent[order]
    rank = order.astype(np.int64)
    mask = np.zeros(1 << 20, bool)
    mask[(hot & np.uint64(len(mask) - 1)).astype(np.int64)] = True
    shared = texts.sparkSession.sparkContext.broadcast((hot, rank, mask))

    def run(batches):
        hot, rank, mask = shared.value
        for part, sets in _sets(batches):
            size, key, prefix, last, mins = [], [], [], [], []
            for own in sets:
                n = len(own)
                size.append(n)
                if not n:
                    key.append(None), prefix.append(None), last.append(None), mins.append(None)
                    continue
                key.append(_key(own))
                take = n - _need(n, num, den) + 1
                cold, tail, ranks = _in_order(own, hot, rank, mask)
                first = cold[:take]
                if len(first) < take:
                    last.append((1 << 62) + int(ranks[take - len(first) - 1]))
                    first = np.concatenate([first, tail[:take - len(first)]])
                else:
                    last.append(int(first[-1]) >> 2)
                prefix.append(first.view(np.int64))
                least = np.array([(own * c).min() for c in _ODD], np.uint64)
                mins.append(least.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(size, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(last, pa.int64()),
                 pa.array(mins, pa.list_(pa.int64()))],
                names=["id", "mark", "n", "key", "prefix", "last", "mins"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, mark long, n long, key binary, prefix array<long>, last long,"
                                 " mins array<long>")


class Marked(NamedTuple):
    """Texts, and the hash of one text of each key: only the sets of such texts are made again."""

    rows: DataFrame     # mark, text
    marks: DataFrame    # key, mark


def verify(texts: Marked, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs of keys ``(a, b)`` whose sets reach the threshold exactly."""
    pairs = saved(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))
    wanted = ends.distinct()
    shared = pairs.sparkSession.sparkContext.broadcast(bitmap(wanted.join(texts.marks, "key").select(F.col("mark").alias("cell"))))

    def run(batches):
        seen = set()
        for batch in batches:
            for part in slices(batch):
                mark = part.column(0).to_numpy()
                rows = [i for i in np.flatnonzero(hit(shared.value, mark)).tolist() if (m := int(mark[i])) not in seen and not seen.add(m)]
                found = [own for own in shingle_sets(part.column(1).take(pa.array(rows, pa.int64()))) if len(own)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([_key(own) for own in found], pa.binary()),
                                                      pa.array([own.view(np.int64) for own in found], pa.list_(pa.int64()))],
                                                     names=["key", "tokens"])

    sets = (texts.rows.select("mark", "text").mapInArrow(run, "key binary, tokens array<long>")
            .join(wanted, "key", "left_semi").groupBy("key").agg(F.first("tokens").alias("tokens")))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b")
            .select("a", "b", both.alias("o"), (F.size("x") + F.size("y")).alias("s"))
            .where(den * F.col("o") >= num * (F.col("s") - F.col("o"))).select("a", "b"))


def _bucket_pairs(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Each key with the leader of each of its min-hash buckets.

    The leader is the key whose prefix reaches farthest into the frequent tokens: the
    member with the fewest words of its own, to which the most others are similar."""
    rows = sets.select("key", "n", "last", F.posexplode("mins").alias("r", "m")).distinct()
    leaders = (rows.groupBy("r", "m")
               .agg(F.max(F.struct("last", "key", "n")).alias("l"), F.min("key").alias("lo"), F.max("key").alias("hi"))
               .where("lo <> hi").select("r", "m", F.col("l.key").alias("b"), F.col("l.n").alias("bn")))
    return (rows.join(leaders, ["r", "m"]).where("key <> b")
            .where((F.least("n", "bn") * den >= F.greatest("n", "bn") * num))
            .groupBy(F.col("key").alias("a"), "b").agg(F.count(F.lit(1)).alias("agree"))
            .where(F.col("agree") >= AGREE).select("a", "b"))


def _shared_tokens(sets: DataFrame, tokens: Column) -> DataFrame:
    """``(key, n, last, token)`` of the tokens that more than one key has (and a few more)."""
    lists = sets.select("key", "n", "last", tokens.alias("tokens"))
    # Tokens of one key alone match nothing.
    crossing = (lists.select(F.explode("tokens").alias("token"), F.xxhash64("key").alias("g"))
                .groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
                .where("lo <> hi").select(F.col("token").alias("cell")))
    shared = sets.sparkSession.sparkContext.broadcast(bitmap(crossing))

    def pick(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            if not batch.num_rows:
                continue
            tokens = lists.flatten().to_numpy(zero_copy_only=False)
            keep = hit(shared.value, tokens)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), sizes)[keep]
            rest = batch.select(list(range(batch.num_columns - 1))).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(tokens[keep])],
                                             names=["key", "n", "last", "token"])

    return lists.mapInArrow(pick, "key binary, n long, last long, token long").distinct()


def _grown(texts: Marked, sets: DataFrame, groups: DataFrame, num: int, den: int) -> DataFrame:
    """``groups`` with the keys that join one when they are compared with further leaders.

    Each bucket of equal min-hashes has one leader a round, so a key is compared with
    at most HASHES of them, and only where their min-hashes make a link likely."""
    cells = saved(_shared_tokens(sets, F.transform("mins", lambda m, r: F.xxhash64(m, r))), "cells")
    mins = saved(sets.select("key", "mins").distinct(), "mins")
    for seed in range(ROUNDS):
        inside = groups.select(F.col("node").alias("key"), F.lit(1).alias("inside")).distinct()
        rows = cells.join(inside, "key", "left").withColumn("inside", F.coalesce("inside", F.lit(0)))
        order = F.xxhash64("key", F.lit(seed)).alias("o")
        leaders = (rows.groupBy("token").agg(F.max(F.struct("inside", order, "key", "n")).alias("l"), F.min("inside").alias("least"))
                   .where("least = 0").select("token", F.col("l.key").alias("b"), F.col("l.n").alias("bn")))
        tried = (rows.where("inside = 0").join(leaders, "token").where("key <> b")
                 .where((F.least("n", "bn") * den >= F.greatest("n", "bn") * num))
                 .select(F.col("key").alias("a"), "b").distinct())
        x, y = (mins.select(F.col("key").alias(c), F.col("mins").alias(f"{c}_mins")) for c in "ab")
        agree = F.size(F.filter(F.zip_with("a_mins", "b_mins", lambda p, q: p == q), lambda same: same))
        likely = tried.join(x, "a").join(y, "b").where(agree >= LIKELY).select("a", "b")
        more = saved(verify(texts, likely, num, den), "links")
        if more.isEmpty():
            break
        groups = merged(groups, more)
    return groups


def _opened(sets: DataFrame, groups: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Query sets with the groups their bound opens, and the groups' members."""
    found = _shared_tokens(sets, F.col("prefix"))
    rows = saved(found.join(groups, found.key == groups.node, "left")
                 .select("key", "n", "last", "token", F.coalesce("root", "key").alias("grp")), "postings")
    matrix = (rows.groupBy("token", F.col("grp").alias("other"))
              .agg(F.min("n").alias("n0"), F.max("n").alias("n1"),
                   F.min("last").alias("l0"), F.max("last").alias("l1")))

    def up(x, d):  # integer ceiling division
        return F.floor((x + (d - 1)) / d)
    met = (rows.join(matrix, "token")
           .where((F.col("other") < F.col("grp")) & (F.col("n1") * den >= F.col("n") * num)
                  & (F.col("n") * den >= F.col("n0") * num))
           .groupBy("key", "other", "n", "last")
           .agg(F.count(F.lit(1)).alias("c"), F.min("n0").alias("n0"), F.max("n1").alias("n1"),
                F.min("l0").alias("l0"), F.max("l1").alias("l1")))
    n, n0, n1 = F.col("n"), F.col("n0"), F.col("n1")
    by_query = up((n + F.greatest(n0, up(n * num, den))) * num, num + den) - up(n * num, den) + 1
    by_member = up((n + F.least(n1, F.floor(n * den / num))) * num, num + den) \
        - up(F.least(n1, F.floor(n * den / num)) * num, den)
    least = (F.when(F.col("last") < F.col("l0"), by_query)
             .when(F.col("last") > F.col("l1"), by_member).otherwise(F.least(by_query, by_member)))
    opened = saved(met.where(F.col("c") >= least).select("key", "n", "other"), "opened")
    members = rows.select(F.col("grp").alias("other"), F.col("key").alias("b"), F.col("n").alias("bn")).distinct()
    sizes = members.groupBy("other").agg(F.count(F.lit(1)).alias("size"))
    return opened, saved(members.join(sizes, "other"), "members")


def _member_pairs(opened: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    return (opened.join(members, "other")
            .where((F.least("n", "bn") * den >= F.greatest("n", "bn") * num))
            .select(F.col("key").alias("a"), "b").distinct())


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          num: int = 4, den: int = 5) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` per row of ``docs``.

    Two documents link when their shingle sets have Jaccard similarity of at
    least ``num / den``; ``component_id`` is the least id reachable by links.
    """
    with small_batches(docs.sparkSession):
        return _placed(docs, id_col, text_col, num, den)


def _placed(docs: DataFrame, id_col: str, text_col: str, num: int, den: int) -> DataFrame:
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    sets = saved(describe(texts, frequent_tokens(texts), num, den), "sets")
    filled = sets.where("n > 0")
    marked = Marked(texts, saved(filled.groupBy("key").agg(F.min("mark").alias("mark")), "marks"))
    links = saved(verify(marked, _bucket_pairs(filled, num, den), num, den), "links")
    groups = _grown(marked, filled, saved(components(links), "groups"), num, den)
    opened, members = _opened(filled, groups, num, den)
    # One link makes a query a member, so a large group's members are compared in portions,
    # each WIDER times the one before, and only with the queries still outside: a query that is linked
    # with one member in a hundred meets a few hundred of them however many there are.
    place, first, last = F.pmod(F.xxhash64("b"), F.col("size")), 0, PROBES
    largest = members.agg(F.max("size")).first()[0] or 0
    roots, outside = groups, opened
    while True:
        here = (place >= first) & (place < last)
        if not first:
            here = here | (F.col("size") <= 2 * PROBES)
        else:
            here = here & (F.col("size") > 2 * PROBES)
            of_query = roots.select(F.col("node").alias("key"), F.col("root").alias("r"))
            of_group = roots.select(F.col("node").alias("other"), F.col("root").alias("s"))
            outside = (opened.join(of_query, "key", "left").join(of_group, "other")
                       .where(F.coalesce("r", "key") != F.col("s")).select("key", "n", "other"))
        pairs = saved(_member_pairs(outside, members.where(here), num, den), "rest")
        if not pairs.isEmpty():
            more = verify(marked, pairs, num, den)
            roots = merged(roots, more)
        if last >= largest or largest <= 2 * PROBES:
            break
        first, last = last, WIDER * last
    placed = (sets.select("id", "n", "key").join(roots, sets.key == roots.node, "left")
              .select("id", "n", F.coalesce("root", "key").alias("root")))
    placed = saved(placed, "placed")
    least = placed.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    return (placed.join(least, "root", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id")))


__all__ = ["near_duplicate_groups"]
