"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Two lines are near-duplicates if at most ``EDITS`` insertions, deletions and substitutions
turn one into the other. A line is cut into ``EDITS + 1`` segments; of two such lines, the
longer one holds one of the shorter one's segments unchanged, at a place that the lengths
bound to a few. So each line is indexed under its segments, by number and text, whose length
tells the line's but for one or two, and probes the substrings at those places for all
lengths down to its own less ``EDITS``. What meets is verified by bit-parallel edit
distance within the band of diagonals that ``EDITS`` edits can reach.

Lines of one template, which share segments by the thousand, are not paired. What all lines
under a crowded key have in common at both ends is taken off, and if a short middle is left,
lines meet under variants of it: letters taken out, or places left open. Two lines are within
``EDITS`` exactly if they meet in one of the ways listed at ``variants``, so the groups stand
for all their pairs and are used as they are.

Which lines stay is settled smallest place first: a line stays if no smaller line within
``EDITS`` of it stays, else it is dropped for the smallest one that does. So whatever is dropped
is within ``EDITS`` of a line that stays, and chains of near lines do not fall as a whole.

A line is known by two 64-bit hashes. Should different lines have the first one in common, they
take no part in the join. Copies of a line are one node. Lines so frequent that at most
``COMMON`` of them can exist are taken out before segments are made and put back once each, so
no copies are paired.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from staymart.llm.common import WORD, stage_text
from staymart.scratch import scratch_folder, stage

EDITS = 2
#: Shorter lines, in characters without white space at the ends, are only held exactly equal
#: and never dropped by themselves.
LEAST_CHARS = 20
#: What is left of a document that lost lines has so many words at least.
LEAST_WORDS = 1
#: Lines that make up more than this part of all lines are at most so many.
COMMON = 10_000
#: Ids of candidate lines are broadcast up to this number (16 MB), and joined beyond it.
MOST_BROADCAST = 1_000_000
#: A key under which more lines are indexed is crowded: its pairs go by letter parities.
CROWD = 16
#: Keys that are hot are looked for among one line in so many, and dealt over so many slots.
SHOWN = 64
SLOTS = 1024
#: Middles of up to so many letters go by variants (no more than about 300 of them).
MIDDLE = 12
BLANKS = " \t\x0b\x0c\r"


def trimmed(raw: Column) -> Column:
    plain = F.trim(raw)  # the other blanks, rare at the ends of lines, take longer to look for
    ends = [f(plain, F.lit(c)) for c in BLANKS[1:] for f in (F.startswith, F.endswith)]
    return F.when(reduce(or_, ends), F.btrim(raw, F.lit(BLANKS))).otherwise(plain)


def numbered_lines(held: DataFrame, short: bool = False) -> DataFrame:
    """``row, doc_id, pos, line`` for lines of ``LEAST_CHARS`` or more, or for shorter ones
    that have a word."""
    line = trimmed(F.col("raw"))
    rows = held.select("row", "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "raw"))
    rows = rows.select("row", "doc_id", "pos", line.alias("line"))
    size = F.char_length("line")
    return rows.where((size > 0) & (size < LEAST_CHARS) if short else size >= LEAST_CHARS).select(
        "*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )


def segment(length: Column, i: int) -> tuple[Column, Column]:
    """Start, from 1, and length of segment ``i`` of a line; the last ones take the rest."""
    parts = EDITS + 1
    base, rest = F.floor(length / parts).cast("int"), length % parts
    longer = F.greatest(F.lit(0), F.lit(i - 1 - parts) + rest)
    return F.lit(1) + (i - 1) * base + longer, base + F.when(rest > parts - i, 1).otherwise(0)


def key_of(start: Column, size: Column, i: int) -> Column:
    # Letters of a plain line, one byte each, are found without counting those before them.
    cut = F.when(F.col("plain"), F.substring(F.col("bytes"), start, size))
    return F.xxhash64(cut.otherwise(F.substring(F.col("line"), start, size).cast("binary")), F.lit(i))


def with_bytes(lines: DataFrame) -> DataFrame:
    """``lines`` with what keys are made from: ``length``, ``bytes`` and ``plain``, ASCII only."""
    sized = lines.withColumn("length", F.char_length("line")).withColumn("bytes", F.col("line").cast("binary"))
    return sized.withColumn("plain", F.octet_length("line") == F.col("length"))


def index_keys(length: Column) -> Column:
    return F.array(*[key_of(*segment(length, i), i) for i in range(1, EDITS + 2)])


def probe_keys(length: Column) -> Column:
    """Keys of all substrings that can be a segment of a line up to ``EDITS`` shorter; the
    line's own ``EDITS + 1`` segments, its index keys, come first.

    Edits before and after segment ``i`` number less than ``i`` and less than
    ``EDITS + 2 - i`` if it is the first unchanged one; that bounds how far it has moved.
    """
    own, keys = [], []
    for less in range(EDITS + 1):
        short = length - less
        for i in range(1, EDITS + 2):
            start, size = segment(short, i)
            first = max(1 - i, less - (EDITS + 1 - i))
            last = min(i - 1, less + (EDITS + 1 - i))
            for move in range(first, last + 1):
                (keys if less or move else own).append(key_of(start + move, size, i))
    return F.array_distinct(F.array(*own, *keys))


def letters(line: str) -> Column:
    return F.regexp_extract_all(F.col(line), F.lit("(?s)."), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def banded_distance(a: str, b: str, edits: int = EDITS) -> Column:
    """Edit distance of the lines in columns ``a`` and ``b``; more than ``edits`` if it is more.

    One step per letter of ``b``. Bit ``i`` of the state stands for the row ``j - edits + i``
    of column ``j``: ``up`` and ``down`` tell where the distance rises or falls from the row
    above. ``score`` follows the lowest diagonal; at the end the rises and falls below the
    last row of ``a`` are taken off. The arguments should differ in length by ``edits`` at most.
    """
    return let(letters(a), lambda xs: let(letters(b), lambda ys: banded(xs, ys, edits)))


def banded(xs: Column, ys: Column, edits: int) -> Column:
    width = 2 * edits + 1
    full, below = (1 << width) - 1, (1 << edits) - 1

    def step(state: Column, j: Column) -> Column:
        lost = state["score"] - F.bit_count(state["up"]) > edits  # all rows of the band are beyond
        return F.when(lost, state).otherwise(next_column(state, j))

    def next_column(state: Column, j: Column) -> Column:
        y = F.get(ys, j - 1)
        match = F.lit(0)
        for i in range(width):
            match = match + F.when(F.get(xs, j - edits + i - 1) == y, F.lit(1 << i)).otherwise(F.lit(0))
        match = match.cast("long")
        up, down = state["up"], state["down"]

        def after(kept: Column) -> Column:
            return let(down.bitwiseOR(outside(kept.bitwiseOR(up))), lambda rise: moved(kept, rise))

        def moved(kept: Column, rise: Column) -> Column:
            along = F.shiftright(kept, 1)
            return F.struct(
                kept.bitwiseAND(up).bitwiseOR(outside(along.bitwiseOR(rise))).alias("up"),
                along.bitwiseAND(rise).alias("down"),
                (state["score"] + 1 - F.shiftright(kept, width - 1).cast("int")).alias("score"),
            )

        def kept_of(same: Column) -> Column:
            carried = (same.bitwiseAND(up) + up).bitwiseXOR(up)
            return carried.bitwiseOR(same).bitwiseOR(down).bitwiseAND(F.lit(full).cast("long"))

        return let(match, lambda same: let(kept_of(same), after))

    def outside(bits: Column) -> Column:
        return F.bitwise_not(bits).bitwiseAND(F.lit(full).cast("long"))

    start = F.struct(
        F.lit(full ^ below).cast("long").alias("up"), F.lit(0).cast("long").alias("down"), F.lit(edits).alias("score")
    )
    n, m = F.size(ys), F.size(xs)

    def ended(state: Column) -> Column:
        beyond = F.lit((1 << (width - 1)) - 1).cast("long")
        rows = beyond.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), m - n + edits) - 1))
        off = F.bit_count(state["up"].bitwiseAND(rows)) - F.bit_count(state["down"].bitwiseAND(rows))
        lost = state["score"] - F.bit_count(state["up"]) > edits
        return F.when(lost, F.lit(edits + 1)).otherwise(state["score"] - off)

    steps = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.when(F.abs(n - m) > edits, F.lit(edits + 1)).otherwise(F.aggregate(steps, start, step, ended))


def mark_of(line: str) -> Column:
    """Struct ``singles, pairs``: a bit per kind of letter, and of pair of neighbours, hashed
    to 64 kinds each: is its number odd? An edit flips two bits of singles and four of pairs
    at most."""
    one = F.lit(1).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("singles"), F.lit(0).cast("long").alias("pairs"), F.lit(0).alias("last"))

    def step(state: Column, c: Column) -> Column:
        code = F.ascii(c)
        pair = F.shiftright(state["last"] * 1103 + code * 613, 3).bitwiseAND(F.lit(63))
        return F.struct(
            state["singles"].bitwiseXOR(F.call_function("shiftleft", one, code.bitwiseAND(F.lit(63)))).alias("singles"),
            state["pairs"].bitwiseXOR(F.call_function("shiftleft", one, pair)).alias("pairs"),
            code.alias("last"),
        )

    return F.aggregate(letters(line), start, step, lambda s: F.struct(s["singles"], s["pairs"]))


def within(pairs: DataFrame) -> DataFrame:
    """The rows of ``pairs(a, b, x, y)`` whose lines ``x`` and ``y`` are near."""
    return pairs.where(banded_distance("x", "y") <= EDITS)


def hot_keys(every: DataFrame, total: int) -> DataFrame:
    """``key`` of segments under which a part of the lines, chosen by hash, shows more than
    ``CROWD`` lines and more than a thousandth of what it holds: some 3,000 keys at most.

    Each is crowded by what was seen. A key that is missed goes the usual way.
    """
    part = every.where(F.pmod("h1", F.lit(SHOWN)) == 0).select(F.explode(index_keys(F.col("length"))).alias("key"), "h1").distinct()
    least = max(CROWD, total // (1_000 * SHOWN))
    return part.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > least).select("key")


def segment_keys(lines: DataFrame, classes: DataFrame, total: int, folder: str) -> DataFrame:
    """``key, p, some, crowded``: lines ``p`` that probe a key, with the lines indexed there, or
    without them if they are more than ``CROWD``.

    Keys that only the line itself has are left out. A row per probe, however many lines are
    indexed under its key. Hot keys are dealt over ``SLOTS`` slots by the line: they are known
    to be crowded, so nothing has to meet there. Other keys have one slot, the key itself.

    A line's index keys are among its probes, so keys are shuffled once. Few slots have
    an indexed line and another one; the rows of all others are gone before anything is sorted.
    """
    common = classes.where(F.col("n") > total / COMMON)
    common = F.broadcast(common.select("h1", "h2", F.col("first.row").alias("one_row"), F.col("first.pos").alias("one_pos")))
    one = F.col("one_row").isNull() | ((F.col("one_row") == F.col("row")) & (F.col("one_pos") == F.col("pos")))
    every = with_bytes(lines.join(common, ["h1", "h2"], "left").where(one).select("h1", "line"))
    hot = stage(hot_keys(every, total), folder, "hot").withColumn("hot", F.lit(True))

    # A column first, so that what keys have in common is computed once per line. Outer,
    # as Spark would else add a filter that the array, never empty, is not empty.
    keys = every.select(probe_keys(F.col("length")).alias("keys"), F.col("h1").alias("p"))
    keys = keys.select("p", F.posexplode_outer("keys").alias("pos", "key"))
    keys = keys.join(F.broadcast(hot), "key", "left").withColumn("hot", F.col("hot").isNotNull())
    shift = F.pmod("p", F.lit(SLOTS))
    slot = F.when(F.col("hot"), F.col("key").bitwiseXOR(shift)).otherwise(F.col("key"))
    # Never null, and known not to be: Spark would else filter one reader's rows and shuffle for each.
    slot = F.coalesce(slot, F.lit(0).cast("long")).alias("slot")
    keys = keys.select(slot, "hot", "p", (F.col("pos") <= EDITS).alias("indexed")).repartition("slot")
    met = keys.groupBy("slot").agg(F.min("p").alias("a"), F.max("p").alias("b"), F.max("indexed").alias("indexed"), F.max("hot").alias("hot"))
    met = met.where(F.col("hot") | (F.col("indexed") & (F.col("a") < F.col("b")))).select("slot")
    # Inner, as Spark would take a semi-join below the shuffle and shuffle for each reader.
    probes = keys.join(met.hint("shuffle_hash"), "slot")
    probes = probes.groupBy("slot", "hot", "p").agg(F.max("indexed").alias("indexed"))
    indexed = F.col("indexed") & ~F.col("hot")
    probes = probes.withColumn("place", F.row_number().over(Window.partitionBy("slot").orderBy(~indexed, "p")))
    first = F.when(indexed & (F.col("place") <= CROWD + 1), F.col("p"))
    probes = probes.withColumn("some", F.collect_list(first).over(Window.partitionBy("slot")))
    others = (F.size("some") > 1) | F.coalesce(F.get("some", F.lit(0)) != F.col("p"), F.lit(False))
    key = F.when(F.col("hot"), F.col("slot").bitwiseXOR(shift)).otherwise(F.col("slot")).alias("key")
    crowded = F.col("hot") | (F.size("some") > CROWD)
    hits = probes.where(F.col("hot") | others).select(key, "p", "some", crowded.alias("crowded"))
    return stage(hits.withColumn("some", F.when(~F.col("crowded"), F.col("some"))), folder, "probes")


def texts_and_marks(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """``h, h2, line, mark`` of the lines whose first hash is in ``ids(h1)``."""
    few = ids.count() <= MOST_BROADCAST
    chosen = lines.join(F.broadcast(ids) if few else ids, "h1", "left_semi")
    rows = chosen.groupBy("h1").agg(F.min("line").alias("line"), F.min("h2").alias("h2"), F.max("h2").alias("other"))
    mark = F.struct(mark_of("line").alias("odd"), F.char_length("line").alias("length"))
    return rows.where("h2 = other").select(F.col("h1").alias("h"), "h2", "line", mark.alias("mark"))


def alike(p: str, q: str) -> Column:
    """May two lines be near, by their marks in columns ``p`` and ``q``?"""

    def apart(kind: str) -> Column:
        return F.bit_count(F.col(f"{p}.odd.{kind}").bitwiseXOR(F.col(f"{q}.odd.{kind}")))

    near = F.abs(F.col(f"{p}.length") - F.col(f"{q}.length")) <= EDITS
    return near & (apart("singles") <= 2 * EDITS) & (apart("pairs") <= 4 * EDITS)


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def crowded_pairs(crowd: DataFrame, marks: DataFrame) -> DataFrame:
    """``a, b`` of lines in a crowded key that may be near.

    Parities of single letters differ, for near lines, in ``2 * EDITS`` bits at most, so of one part more, every
    so many bits, one is equal. Lines meet only under an equal part of it.
    """
    parts = 2 * EDITS + 1
    masks = [sum(1 << b for b in range(64) if b % parts == k) for k in range(parts)]
    bits = [F.col("mark.odd.singles").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks]
    rows = crowd.join(marks, crowd.p == marks.h).select("key", "p", "mark", F.posexplode(F.array(*bits)).alias("part", "bits"))
    other = rows.select("key", "part", "bits", F.col("p").alias("q"), F.col("mark").alias("other"))
    return ordered(rows.join(other, ["key", "part", "bits"]).where((F.col("p") < F.col("q")) & alike("mark", "other")))


def shared_letters(one: Column, other: Column, part: Callable[[Column, Column], Column]) -> Column:
    """How many letters two strings have in common at an end, by halving; ``part`` takes so many
    letters from that end of a string."""
    short = F.least(F.char_length(one), F.char_length(other))
    halvings = F.reverse(F.sequence(F.lit(0), F.ceil(F.log2(short + 1)).cast("int")))

    def step(known: Column, power: Column) -> Column:
        more = known + F.call_function("shiftleft", F.lit(1), power)
        return F.when((more <= short) & (part(one, more) == part(other, more)), more).otherwise(known)

    return F.aggregate(halvings, F.lit(0), step)


def head(text: Column, n: Column) -> Column:
    return F.substring(text, F.lit(1), n)


def tail(text: Column, n: Column) -> Column:
    return F.substring(text, F.char_length(text) - n + 1, n)


def with_middles(crowd: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """``key, p, middle`` of ``crowd(key, p)``: what is left of the line without the letters that
    all lines of the key share at the start and at the end; null where one is too long.

    Where it is not, ``key`` becomes a hash of what was taken off, so that keys under which the
    same lines crowd become one."""
    rows = stage_text(crowd.join(texts.select(F.col("h").alias("p"), "line"), "p"), folder, "crowd")
    known = stage_text(rows.groupBy("key").agg(F.min("line").alias("model")), folder, "models")
    size = F.char_length("line")
    each = rows.join(known, "key").select(
        "key",
        shared_letters(F.col("line"), F.col("model"), head).alias("first"),
        shared_letters(F.col("line"), F.col("model"), tail).alias("last"),
        size.alias("size"),
    )
    ends = each.groupBy("key").agg(F.min("first").alias("first"), F.min("last").alias("last"), F.min("size").alias("least"), F.max("size").alias("most"))
    ends = ends.select("key", "first", F.least("last", F.col("least") - F.col("first")).alias("last"), "most")
    ends = stage(ends, folder, "ends")
    short = F.col("most") - F.col("first") - F.col("last") <= MIDDLE
    middle = F.substring(F.col("line"), F.col("first") + 1, size - F.col("first") - F.col("last"))
    ends_of = F.xxhash64(head(F.col("line"), F.col("first")), F.lit(0), tail(F.col("line"), F.col("last")))
    key = F.when(short, ends_of).otherwise(F.col("key")).alias("key")
    return rows.join(ends, "key").select(key, "p", F.when(short, middle).alias("middle")).distinct()


def variants(middle: str) -> Column:
    """Structs ``variant, hub`` of a middle. Two middles are within two edits exactly if they
    have a variant in common in which one at least is a hub:

    a  the letters, or all but one, both hubs (one out of each, or of one);
    b  the letters, a hub, or all but two;
    c  one place open: a hub as it is, or with one letter taken out elsewhere;
    d  two places open, a hub.
    """
    text = F.col(middle)
    none = F.array().cast("array<int>")

    def places(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(none)

    def cut(word: Column, at: Column) -> Column:
        return F.concat(F.substring(word, F.lit(1), at - 1), F.substring(word, at + 1, F.char_length(word)))

    def each(n: Column, f: Callable[[Column], Column]) -> Column:
        return F.transform(places(n), f)

    def two(f: Callable[[Column, Column], Column]) -> Column:
        return F.flatten(each(F.char_length(text), lambda j: each(j - 1, lambda i: f(i, j))))

    size = F.char_length(text)
    whole = F.array(text)
    less = each(size, lambda i: cut(text, i))
    opened = each(size, lambda i: F.concat_ws(":", i.cast("string"), cut(text, i)))
    twice = two(lambda i, j: cut(cut(text, j), i))
    both = F.flatten(each(size, lambda i: let(cut(text, i), lambda w: each(size - 1, lambda j: F.concat_ws(":", j.cast("string"), cut(w, j))))))
    apart = two(lambda i, j: F.concat_ws(":", i.cast("string"), j.cast("string"), cut(cut(text, j), i)))
    kinds = [("a", whole, True), ("a", less, True), ("b", whole, True), ("b", twice, False)]
    kinds += [("c", opened, True), ("c", both, False), ("d", apart, True)]

    def named(kind: str, words: Column, hub: bool) -> Column:
        return F.transform(
            F.array_distinct(words), lambda w: F.struct(F.concat_ws(":", F.lit(kind), w).alias("variant"), F.lit(hub).alias("hub"))
        )

    return F.concat(*[named(*kind) for kind in kinds])


def near_lines(lines: DataFrame, classes: DataFrame, total: int, folder: str) -> DataFrame:
    """``key, variant, hub, h, h2``: lines within ``EDITS`` of each other, as groups.

    Two lines ``h`` of one ``key, variant`` are near if one of them is a ``hub``. A pair is a
    group of its own. A line's mark, three numbers, rules out most candidates before texts
    are joined to them. All lines indexed under a crowded key also probe it, so its pairs are
    found among its probes.
    """
    probes = segment_keys(lines, classes, total, folder)
    crowded = F.col("crowded")
    listed = probes.select(F.col("p").alias("h1")).union(probes.where(~crowded).select(F.explode("some")))
    ids = stage(listed.distinct(), folder, "ids")
    texts = stage_text(texts_and_marks(lines, ids), folder, "texts")
    marks = texts.select("h", "mark")
    thin = ordered(probes.where(~crowded).select("p", F.explode("some").alias("q")).where("p <> q"))
    one, two = marks.toDF("a", "x"), marks.toDF("b", "y")
    thin = thin.join(one, "a").join(two, "b").where(alike("x", "y")).select("a", "b")
    crowd = stage(with_middles(probes.where(crowded).select("key", "p"), texts, folder), folder, "middles")
    dense = crowded_pairs(crowd.where("middle IS NULL").select("key", "p"), marks)
    pairs = stage(thin.union(dense).distinct(), folder, "pairs")
    one = texts.select(F.col("h").alias("a"), F.col("line").alias("x"))
    two = texts.select(F.col("h").alias("b"), F.col("line").alias("y"))
    pairs = within(pairs.join(one, "a").join(two, "b")).select(
        F.col("a").alias("key"), F.concat_ws(":", F.lit("pair"), F.col("b").cast("string")).alias("variant"), F.explode(F.array("a", "b")).alias("h")
    )
    groups = crowd.where("middle IS NOT NULL").select("key", F.col("p").alias("h"), F.inline(variants("middle")))
    both = pairs.select("key", "variant", F.lit(True).alias("hub"), "h").union(groups.select("key", "variant", "hub", "h"))
    return both.join(texts.select("h", "h2"), "h")


def dropped_nodes(near: DataFrame, folder: str) -> DataFrame:
    """``h, stays`` of the nodes of ``near(key, variant, hub, h, place)`` that do not stay.

    A round settles the nodes that have no smaller neighbour left: they stay, and their
    neighbours go, each for the smallest of them. Groups are looked at by their least places
    only, never by pairs; none is large, as few lines are so near to each other. Each round settles the smallest node left at least; there are as many
    rounds as the longest falling chain of near lines has steps.
    """
    group = ["key", "variant"]

    def least_places(rows: DataFrame) -> DataFrame:
        return rows.groupBy(group).agg(
            F.min(F.when(F.col("hub"), F.col("place"))).alias("hubs"), F.min(F.when(~F.col("hub"), F.col("place"))).alias("others")
        )

    beside = F.when(F.col("hub"), F.least("hubs", "others")).otherwise(F.col("hubs"))
    found, now = [], stage(near, folder, "near")
    while not now.isEmpty():
        below = now.join(least_places(now), group).groupBy("h").agg(F.min("place").alias("place"), F.min(beside).alias("least"))
        stays = stage(below.where(F.col("least").isNull() | (F.col("least") >= F.col("place"))).select("h"), folder, "stays")
        near_one = now.join(least_places(now.join(stays, "h")), group).withColumn("stays", beside).where("stays < place")
        gone = stage(near_one.groupBy("h").agg(F.min("stays").alias("stays")), folder, "gone")
        found.append(gone)
        now = stage(now.join(stays.union(gone.select("h")), "h", "left_anti"), folder, "near")
    return reduce(DataFrame.union, found) if found else now.select("h", F.col("place").alias("stays"))


@dataclass
class Found:
    """What was found: the numbered documents and the occurrences of lines to drop."""

    held: DataFrame
    dropped: DataFrame
    folder: str


def repeated_lines(docs: DataFrame, folder: str | None = None) -> Found:
    """Every occurrence of a line but its first, and the first one, too, if the line is within
    ``EDITS`` of a smaller one that stays.

    Smaller is the first occurrence by ``doc_id`` (null last), then by row of ``docs`` as it is
    stored here, then by line number. ``dropped`` has ``row, pos`` of the occurrence and
    ``first_row, first_doc_id, first_pos`` of what stays in its place.
    """
    folder = folder or scratch_folder(docs.sparkSession)
    held = stage_text(docs.withColumn("row", F.monotonically_increasing_id()), folder, "held")
    lines = numbered_lines(held)
    classes = stage(lines.groupBy("h1", "h2").agg(F.min(place_of()).alias("first"), F.count("*").alias("n")), folder, "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    near = near_lines(lines, classes, total, folder)
    places = classes.select(F.col("h1").alias("h"), "h2", F.col("first").alias("place"))
    gone = dropped_nodes(near.join(places, ["h", "h2"]).drop("h2"), folder).withColumnRenamed("h", "h1")
    known = stage(classes.join(gone, "h1").select("h1", "h2", "stays"), folder, "known")
    alone = classes.where("n > 1").join(known.select("h1", "h2"), ["h1", "h2"], "left_anti")
    stays = known.select("h1", "h2", "stays").union(alone.select("h1", "h2", F.col("first").alias("stays")))
    again = lines.drop("line").join(stays, ["h1", "h2"])
    dropped = again.where((F.col("row") != F.col("stays.row")) | (F.col("pos") != F.col("stays.pos"))).select(
        "row",
        "pos",
        F.col("stays.row").alias("first_row"),
        F.col("stays.doc_id").alias("first_doc_id"),
        F.col("stays.pos").alias("first_pos"),
    )
    return Found(held, dropped, folder)


def place_of() -> Column:
    """What the first occurrence of a line is smallest in."""
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "pos")


def short_repeats(found: Found) -> DataFrame:
    """``row, pos, first_doc_id, first_pos`` of exact repeats of lines under ``LEAST_CHARS``."""
    lines = numbered_lines(found.held, short=True).drop("h1", "h2")
    again = lines.groupBy("line").agg(F.min(place_of()).alias("first"), F.count("*").alias("n"))
    first = stage(again.where("n > 1").drop("n"), found.folder, "short")
    rows = lines.join(first, "line").where((F.col("row") != F.col("first.row")) | (F.col("pos") != F.col("first.pos")))
    return rows.select("row", "pos", F.col("first.doc_id").alias("first_doc_id"), F.col("first.pos").alias("first_pos"))


def per_row(places: DataFrame, name: str) -> DataFrame:
    place = F.struct(F.col("pos").alias("line"), "first_doc_id", F.col("first_pos").alias("first_line"))
    return places.groupBy("row").agg(F.array_sort(F.collect_list(place)).alias(name))


def line_report(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, n_lines, n_dropped, dropped, n_short, short`` per row of ``docs``.

    ``dropped`` lists the lines (from 0) that repeat a line elsewhere, by number, each with
    the place of the line that stays. A null text counts as an empty one and has one blank
    line. Short and blank lines are never dropped; ``short`` lists those with a word that
    repeat a line elsewhere exactly. An empty table gives no rows.
    """
    found = repeated_lines(docs.select("doc_id", "text"), folder)
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    rows = found.held.select("row", "doc_id", n_lines.alias("n_lines"))
    rows = rows.join(per_row(found.dropped, "dropped"), "row", "left").join(per_row(short_repeats(found), "short"), "row", "left")
    none = F.array().cast("array<struct<line:int,first_doc_id:bigint,first_line:int>>")
    return rows.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("dropped").cast("long"), F.lit(0)).alias("n_dropped"),
        F.coalesce("dropped", none).alias("dropped"),
        F.coalesce(F.size("short").cast("long"), F.lit(0)).alias("n_short"),
        F.coalesce("short", none).alias("short"),
    )


def copied_rows(found: Found, dropped: DataFrame) -> DataFrame:
    """``row`` of documents whose long lines were all dropped, and whose short lines all stand
    in a document that one of the dropped lines stays in and that has as many lines.

    Lines without a word are not looked at.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), trimmed), lambda x: x != "")
    shape = found.held.select("row", lines.alias("lines"))
    short = F.filter("lines", lambda x: F.char_length(x) < LEAST_CHARS)
    shape = shape.select("row", F.size("lines").alias("n"), F.array_distinct(short).alias("short"), F.size(short).alias("n_short"))
    shape = stage(shape.where(F.col("n") > 0), found.folder, "shape")
    lost = dropped.groupBy("row").agg(F.count("*").alias("n_dropped"), F.collect_set("first_row").alias("sources"))
    left = lost.join(shape, "row").where((F.col("n_short") > 0) & (F.col("n_dropped") + F.col("n_short") == F.col("n")))
    left = left.select("row", "n", "short", F.explode("sources").alias("source")).where("source <> row")
    held = shape.select(F.col("row").alias("source"), F.col("n").alias("n_held"), F.col("short").alias("short_held"))
    pairs = left.join(held, "source").where(F.col("n") == F.col("n_held"))
    return pairs.where(F.size(F.array_except("short", "short_held")) == 0).select("row").distinct()


def without_repeats(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, other columns as they are, but for
    ``n_chars``, if there is one, which is the new length where the text has changed.

    A document that lost lines is left out if fewer than ``LEAST_WORDS`` words are left, so
    none, or if it is a copy with only short lines left (``copied_rows``). Other documents
    stay with what is left, also short and empty ones that lost nothing. A null text is an
    empty one and stays null; repeated rows repeat each other's lines, so the first of them
    stays. Columns of any name are kept; an empty table gives no rows.
    """
    names = {c: f"__{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    plain = docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in names.items()])
    found = repeated_lines(plain, folder)
    dropped = stage(found.dropped.select("row", "pos", "first_row"), found.folder, "dropped")
    per = dropped.groupBy("row").agg(F.array_sort(F.collect_list("pos")).alias("cuts"))
    rows = found.held.join(per, "row", "left").withColumn("__lines", F.split("text", "\n"))
    starts = F.concat(F.array(F.lit(1)), F.transform("cuts", lambda x: x + 2))
    ends = F.concat("cuts", F.array(F.size("__lines")))
    parts = F.zip_with(starts, ends, lambda a, b: F.slice("__lines", a, b - a + 1))
    left = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.concat_ws("\n", F.flatten(parts)))
    rows = rows.withColumn("text", left)
    n_words = F.regexp_count("text", F.lit(WORD))
    rows = rows.where(F.when(F.col("cuts").isNull(), F.lit(True)).otherwise(n_words >= LEAST_WORDS))
    rows = rows.join(stage(copied_rows(found, dropped), found.folder, "copies"), "row", "left_anti")
    if "n_chars" in names:
        old = F.col(names["n_chars"])
        new = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn(names["n_chars"], F.when(F.col("cuts").isNull(), old).otherwise(new))
    return rows.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])
