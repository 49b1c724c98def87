"""From buckets of similar items to groups: candidate pairs without all pairs of a bucket, and connected components."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlecorpus.llm.common import hot_join, stored

#: Times that the members of a bucket which are not linked yet take a leader, before the rest is settled.
ROUNDS = 3
#: Members of a part of a bucket, pairs compared at once, and pairs of two groups that a part gives in the first round of settling.
CELL, PAIRS, FEW = 512, 1 << 20, 4
#: Counts of a profile.
BINS = 256
#: Parts of a bucket's members beside its largest group, above which they meet by what tells them apart instead of all with all.
WIDE = 4


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) that is not itself the root, the smallest node it is connected to.

    Large-star and small-star rounds: each node's neighbours move to its
    smallest one, until all edges lead to their component's root; the rounds grow with the logarithm of a
    component's size. Each round is stored in the shared folder.
    """

    def star(pairs: DataFrame) -> DataFrame:
        """(u, v) -> v joined to the least of u and its neighbours."""
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("held"))
        return hot_join(pairs, least, "u", "held")

    def stars(e: DataFrame) -> bool:
        """Whether every node has one edge to a smaller one at most, and none if others have one to it."""
        ends = e.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(e.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or down = 1 and up = 1").isEmpty()

    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not stars(now):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = stored(star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large_star")
        down = star(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        now = stored(down.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
                     .select("e.a", "e.b").where("a <> b").distinct(), "small_star")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def least_keys(h: np.ndarray, owner: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) of the ``most`` least different hashes of each owner (a number under 2^20); keys have 44 bits.

    Hashes are spread evenly, so the least lie under twice the share of the
    range that ``most`` of an owner's would take; only those are sorted. An
    owner that has too few there gives all of its own.
    """

    def least(h, owner):
        x = np.sort(owner.astype(np.uint64) << np.uint64(44) | h >> np.uint64(20))
        x = x[np.concatenate([[True], x[1:] != x[:-1]])[:len(x)]]
        own = (x >> np.uint64(44)).astype(np.int64)
        begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[:len(own)])
        keep = np.arange(len(x)) - np.repeat(begins, np.diff(np.append(begins, len(x)))) < most
        return own[keep], (x[keep] & np.uint64((1 << 44) - 1)).astype(np.int64)

    count = np.bincount(owner)
    many = count > 2 * most
    limit = np.full(len(count), 2**64 - 1, np.uint64)
    limit[many] = limit[many] // count[many].astype(np.uint64) * np.uint64(2 * most)
    under = h <= limit[owner]
    own, key = least(h[under], owner[under])
    few = many & (np.bincount(own, minlength=len(count)) < most)
    return least(*(x[under | few[owner]] for x in (h, owner))) if few.any() else (own, key)


def profiles(features: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Feature counts of ``n`` items, features folded to BINS; counts over 255 stand as 255."""
    counts = np.bincount(owner * BINS + (features % np.uint64(BINS)).astype(np.int64), minlength=n * BINS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(n, BINS)


def shared(members: DataFrame) -> DataFrame:
    """The members (bucket, node, size) whose bucket holds another one; of buckets that hold the same nodes (two hashes of 64 bits tell), one stays."""
    held = members.withColumn("held", F.count("*").over(Window.partitionBy("bucket")))
    met = stored(held.where("held > 1").drop("held"), "shared_buckets")
    sets = met.groupBy("bucket").agg(F.count("*").alias("held"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    one = sets.groupBy("held", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    return stored(met.join(one, "bucket", "left_semi"), "bucket_members")


def lead(members: DataFrame, shortest: float) -> DataFrame:
    """(bucket, node, size, leader, fits, most) of the members of shared buckets but for each bucket's least node, their leader.

    ``members``: (bucket, node, size). ``fits`` tells whether the smaller of a
    node's and its leader's size is ``shortest`` of the larger at least;
    ``most`` are the edits that two similar ones of these sizes differ by at most.
    """
    least = members.groupBy("bucket").agg(F.min(F.struct("node", "size")).alias("first"), F.count("*").alias("held")).where("held > 1")
    led = hot_join(members, stored(least, "bucket_leaders"), "bucket", "held").where("first is not null and first.node <> node")
    larger = F.greatest("size", "first.size")
    fits, most = F.least("size", "first.size") >= shortest * larger, F.floor((1 - shortest) * larger + 1e-9).cast("int")
    return stored(led.select("bucket", "node", "size", F.col("first.node").alias("leader"), fits.alias("fits"), most.alias("most")), "led")


def link(led: DataFrame, verify: Callable[[DataFrame], DataFrame], shortest: float, rounds: int = ROUNDS,
         settle: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """Verified pairs (a, b) that connect the similar members of each bucket.

    First every member is verified against its bucket's leader; those that
    fail and are of no other's kind yet take the least of themselves as their
    leader and are verified again, ``rounds`` times in all. A bucket of n
    copies of one thing costs n pairs, one of n different things n pairs a
    round. What that leaves open, kinds that never led and members that are
    similar to another one than their leader, is for ``settle`` (links and
    pairs tested so far -> further links); see ``settled``.
    """
    links, tested = led_links(led, verify, shortest, rounds)
    return links if settle is None else links.unionByName(settle(links, tested))


def led_links(led: DataFrame, verify: Callable[[DataFrame], DataFrame], shortest: float, rounds: int = ROUNDS,
              possible: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The verified pairs (a, b) of members and their leaders, and all such pairs that were tested.

    ``possible`` leaves out those of the pairs (a, b, most) that cannot be similar; only the others are verified.
    """
    links = tested = None
    for k in range(rounds):
        pairs = led.where("fits").select(F.col("leader").alias("a"), F.col("node").alias("b"), "most").distinct()
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        star = stored(verify(pairs.select("a", "b") if possible is None else stored(possible(pairs), "possible_pairs")), "links")
        pairs = pairs.select("a", "b")
        links, tested = (star, pairs) if links is None else (links.unionByName(star), tested.unionByName(pairs))
        if k + 1 < rounds:
            passed = star.select(F.col("a").alias("leader"), F.col("b").alias("node"))
            led = lead(led.join(passed, ["leader", "node"], "left_anti").select("bucket", "node", "size"), shortest)
    return links, tested


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Counts that stand in one profile and not in the other, in each row: of ``x`` or of ``y``, whichever has more."""
    differ = x.astype(np.int16) - y
    over = np.maximum(differ, 0).sum(1, dtype=np.int64)
    return np.maximum(over, over - differ.sum(1, dtype=np.int64))


def near_enough(pairs: DataFrame, known: DataFrame, per_edit: int) -> DataFrame:
    """The ``pairs`` (a, b, most) whose profiles, those of the ``known`` (node, profile), ``most`` edits may turn into each other."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("pa", "pb"))
            near = pa.array(apart(x, y) <= per_edit * batch.column("most").to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(near) for c in ("a", "b")], ["a", "b"])

    of = lambda x: known.select(F.col("node").alias(x), F.col("profile").alias(f"p{x}"))
    types = dict(pairs.dtypes)
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "most", "pa", "pb").mapInArrow(rows, f"a {types['a']}, b {types['b']}")


def settled(links: DataFrame, tested: DataFrame, members: DataFrame, profile_of: Callable[[DataFrame], DataFrame],
            verify: Callable[[DataFrame], DataFrame], shortest: float, per_edit: int) -> DataFrame:
    """The verified pairs that are missing until each bucket's similar members are connected; see ``settle``."""
    return settle(links, tested, members, profile_of, verify, shortest, per_edit)[0]


def classes(members: DataFrame, led: DataFrame, profile_of: Callable[[DataFrame], DataFrame], verify: Callable[[DataFrame], DataFrame],
            shortest: float, per_edit: int, known: DataFrame | None = None, telling: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, root) of ``components`` for all links among ``members``, whose first leaders are in ``led``.

    With ``known`` profiles, (node, profile) of all nodes, pairs with a leader are held against these before they are verified.
    """
    links, tested = led_links(led, verify, shortest, possible=None if known is None else partial(near_enough, known=known, per_edit=per_edit))
    return settle(links, tested, members, profile_of, verify, shortest, per_edit, telling)[1]


def settle(links: DataFrame, tested: DataFrame, members: DataFrame, profile_of: Callable[[DataFrame], DataFrame],
           verify: Callable[[DataFrame], DataFrame], shortest: float, per_edit: int,
           telling: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The verified pairs that are missing until each bucket's similar members are connected, and (node, root) of the components then.

    ``members``: (bucket, node, size) of the shared buckets; ``profile_of``
    gives (node, profile) of nodes; an edit moves ``per_edit`` counts of a
    profile at most. Any two members of a bucket that are in different groups
    yet, of sizes that fit and with profiles near enough (a bound that no
    similar pair exceeds) are verified. Two groups need one link only, so a
    round takes their FEW nearest pairs, the next one eight times as many in
    the buckets where some were held back, until there are none: then no
    unverified pair is left that could be similar and join two groups. Links
    of a round join the groups known so far.

    ``telling`` (nodes -> bucket, node, size) gives buckets of which any two
    similar nodes share one. The members of a bucket with more than WIDE parts
    of different things meet in these instead, which cost no square of their number.
    """
    few, more, root, left = FEW, None, components(links), members
    while True:
        named, parts = by_group(left, root)
        if telling is not None:
            wide = parts.where(F.col("parts") > WIDE).select("bucket")
            if not wide.isEmpty():
                told = shared(telling(named.join(wide, "bucket", "left_semi").select("node").distinct()))
                left = named.join(wide, "bucket", "left_anti").select("bucket", "node", "size").unionByName(told)
                named, parts = by_group(left, root)
            telling = None
        mixed = stored(with_near_size(hot_join(named, parts, "bucket", "held").where("parts is not null"), shortest), "mixed_members")
        profile = profile_of(mixed.select("node").distinct())
        near = stored(near_pairs(mixed.join(profile, "node"), shortest, per_edit, few), "near_pairs")
        pairs = stored(near.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        found = stored(verify(pairs), "links")
        tested = tested.unionByName(pairs)
        if not found.isEmpty():
            more = found if more is None else more.unionByName(found)
            root = joined(root, found)
        cut = near.where("cut").select("bucket").distinct()
        if cut.isEmpty():
            return links.where("false") if more is None else more, root
        left = mixed.join(cut, "bucket", "left_semi").select("bucket", "node", "size")
        few *= 8


def by_group(members: DataFrame, root: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ``members`` with their ``root``, and (bucket, held, most, parts, most_parts) of the buckets that hold several; see ``near_pairs``."""
    named = stored(members.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")), "named_members")
    groups = named.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket").agg(
        F.sum("n").alias("held"), F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("groups")).where("groups > 1")
    cells = lambda n: F.ceil(n / CELL).cast("int")
    return named, stored(groups.select("bucket", "held", F.col("most.root").alias("most"), cells(F.col("held") - F.col("most.n")).alias("parts"),
                                       cells(F.col("most.n")).alias("most_parts")), "mixed_buckets")


def with_near_size(members: DataFrame, shortest: float) -> DataFrame:
    """The ``members`` (bucket, size, ...) but for those whose size no other one's in the bucket fits."""
    by_size = Window.partitionBy("bucket").orderBy("size")
    fits = lambda less, size: F.coalesce(size - less <= F.floor((1 - shortest) * size + 1e-9), F.lit(False))
    near = fits(F.lag("size").over(by_size), F.col("size")) | fits(F.col("size"), F.lead("size").over(by_size))
    return members.withColumn("_near", near).where("_near").drop("_near")


def joined(root: DataFrame, links: DataFrame) -> DataFrame:
    """``root`` (node, root) once ``links`` (a, b) connect further groups: only the roots that they touch are walked again."""
    of = lambda x: root.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    held = root.groupBy("root").agg(F.count("*").alias("held"))
    moved = components(between).select(F.col("node").alias("root"), F.col("root").alias("to"))
    moved = stored(moved.join(held, "root", "left").fillna(0, ["held"]), "moved_roots")
    return stored(hot_join(root, moved, "root", "held").select("node", F.coalesce("to", "root").alias("root"))
                  .unionByName(moved.select(F.col("root").alias("node"), F.col("to").alias("root"))), "roots")


def near_pairs(members: DataFrame, shortest: float, per_edit: int, few: int) -> DataFrame:
    """(a, b, cut, bucket) of members (bucket, node, size, root, most, parts, most_parts, profile) of a bucket and different roots that may be similar.

    The members of a bucket's largest group (root ``most``) are dealt to
    ``most_parts`` parts, all others to ``parts``. Any two parts meet in a cell
    of their own but for two of the largest group, whose members are linked: a
    bucket of n copies and k other texts costs n k pairs. ``cut``: the part has more than ``few`` pairs of the
    two roots, of which the nearest are given.
    """

    def pairs(cell, side, alone, size, root, profile):
        """Rows of the pairs, and whether others of their roots were held back; rows are sorted by cell."""
        end = np.searchsorted(cell, cell, "right")
        count = end - np.arange(len(cell)) - 1
        upto = np.cumsum(count)
        start = 0
        while start < len(cell):
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS, "right")))
            if stop < len(cell):  # whole cells, one at least
                whole = int(np.searchsorted(cell, cell[stop]))
                stop = whole if whole > start else int(end[start])
            n = count[start:stop]
            x = np.repeat(np.arange(start, stop), n)
            y = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + x + 1
            most = lambda x, y: np.floor((1 - shortest) * np.maximum(size[x], size[y]) + 1e-9)
            fit = (root[x] != root[y]) & (alone[x] | (side[x] != side[y])) & (np.abs(size[x] - size[y]) <= most(x, y))
            x, y = x[fit], y[fit]
            far = np.empty(len(x), np.int64)
            for at in range(0, len(x), 1 << 14):
                far[at:at + (1 << 14)] = apart(profile[x[at:at + (1 << 14)]], profile[y[at:at + (1 << 14)]])
            fit = far <= per_edit * most(x, y)
            x, y, far = x[fit], y[fit], far[fit]
            key = [cell[x], np.minimum(root[x], root[y]), np.maximum(root[x], root[y])]
            order = np.lexsort([far, *key])
            fresh = np.ones(len(order), bool)
            fresh[1:] = np.any([k[order][1:] != k[order][:-1] for k in key], axis=0)
            run = np.cumsum(fresh) - 1
            begins = np.flatnonzero(fresh)
            held = np.diff(np.append(begins, len(order)))
            keep = np.arange(len(order)) - begins[run] < few
            yield x[order][keep], y[order][keep], held[run][keep] > few
            start = stop

    def rows(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def done(t):
            names = [np.asarray(t.column(c)) for c in ("bucket", "i", "j")]
            cell = np.cumsum(np.concatenate([[False], np.any([c[1:] != c[:-1] for c in names], axis=0)]))
            node = t.column("node").combine_chunks()
            profile = np.frombuffer(b"".join(t.column("profile").to_pylist()), np.uint8).reshape(-1, BINS)
            root = np.asarray(t.column("root").combine_chunks().dictionary_encode().indices)
            for x, y, cut in pairs(cell, np.asarray(t.column("side")), names[1] == names[2], np.asarray(t.column("size")).astype(np.int64), root, profile):
                yield pa.RecordBatch.from_arrays([node.take(pa.array(x)), node.take(pa.array(y)), pa.array(cut, pa.bool_()), pa.array(names[0][x])], ["a", "b", "cut", "bucket"])

        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(pa.Table.from_batches([b]))
            size += b.num_rows
            if size < 4 * CELL:
                continue
            t = pa.concat_tables(held)
            last = pc.and_(pc.and_(*(pc.equal(t.column(c), t.column(c)[-1]) for c in ("bucket", "i"))), pc.equal(t.column("j"), t.column("j")[-1]))
            whole = int(np.argmax(np.asarray(last)))
            if whole:
                yield from done(t.slice(0, whole))
            held = [t.slice(whole)]
            size = held[0].num_rows
        if held:
            yield from done(pa.concat_tables(held))

    of = lambda n: F.pmod(F.xxhash64("node"), F.col(n).cast("long")).cast("int")
    largest = F.col("root") == F.col("most")
    dealt = members.withColumn("side", F.when(largest, F.col("parts") + of("most_parts")).otherwise(of("parts")))
    meets = F.col("parts") - 1 + F.when(largest, 0).otherwise(F.col("most_parts"))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), meets))).select(
        "bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "size", "root", "profile")
    return cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node").mapInArrow(rows, "a binary, b binary, cut boolean, bucket long")


def with_texts(pairs: DataFrame, texts: DataFrame, salts: int = 64) -> DataFrame:
    """``pairs`` (a, b) with the ``text`` of both nodes, as ``ta`` and ``tb``.

    A node of very many pairs is spread: its text goes to at most ``salts``
    places, each with that share of its pairs.
    """
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)))
    left = dealt.select("a", "salt").distinct().join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = dealt.join(left, ["a", "salt"]).drop("salt").withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(salts)))
    right = dealt.select("b", F.pmod(F.xxhash64("a"), F.lit(salts)).alias("salt")).distinct().join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return both.join(right, ["b", "salt"]).select("a", "b", "ta", "tb")


def beside_leaders(pairs: DataFrame, texts: DataFrame, most: int = 1024) -> DataFrame:
    """(a, part, b, text) of ``pairs`` (a, b), sorted by a and part: a row with the text of a and no b, then one of each b with its text.

    A node's text is there once for each ``most`` of its pairs, and rows of
    one node and part follow each other in one task, which need not hold them.
    """
    many = pairs.groupBy("a").agg(F.count("*").alias("held")).where(F.col("held") > most).select("a", F.ceil(F.col("held") / most).alias("parts"))
    # At most one row for each ``most`` pairs is broadcast.
    dealt = pairs.join(F.broadcast(many), "a", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("b"), "parts"), F.lit(0)).cast("int"))
    first = dealt.select("a", "part").distinct().select(F.col("a").alias("node"), "a", "part", F.lit(None).cast(dict(pairs.dtypes)["b"]).alias("b"))
    asked = first.unionByName(dealt.select(F.col("b").alias("node"), "a", "part", "b"))
    found = asked.join(texts.select("node", "text"), "node").select("a", "part", "b", "text")
    return found.repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
