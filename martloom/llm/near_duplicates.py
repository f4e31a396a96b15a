"""MinHash near-duplicates by a signature-coordinate inverted join.

A text is the set of its distinct word shingles. Its signature has `COORDINATES` minima. Sets are linked if their
similarity is at least `percent`; links are confirmed on the full sets. The way there:

1. Texts with the same set are one class, known by its smallest id; copies are never paired.
2. Each class is posted under its (coordinate, value) pairs. Two signatures that agree in at least `MATCHES`
   coordinates share one of their first `COORDINATES - MATCHES + 1` pairs in any common order, so a class is
   posted under that prefix only, rarest pairs first; the long lists of common pairs are skipped. Lists are kept
   by size of set as well: sets that can be linked differ in size by less than one step, and each is posted
   under its own step and the next, so they meet in one of the two. Lists with the same members are one list.
3. A list of a few classes gives all its pairs. A longer list has a hub, the class whose pairs are the most frequent,
   so the one most like the others; every member is compared with it, which is linear in the list. Hubs are the same
   in most lists of one group, and a pair of hub and member is compared once. Members whose sketch matches the
   hub's leave the list; the others, if there are any, go on as a list of their own with more hubs.
4. What is not linked to the hub may still be linked to something near it. The comparison gives each member's
   differences from the hub, what it lacks and what it has besides. Sets that differ in d items of a hub of M items
   and in a others share M - dx - dy + s items, with s common differences. Two sets not both linked to
   the hub can only be linked if they have common differences, and each must have a computable share of its own
   among them. So members are posted under a prefix of their differences, rarest first, and only those meet
   that share a rare one, have enough differences left from there on and are not known to be of one component.
   A family that is far from its hub shares most differences, so it meets one of its own first: in each list of a
   difference all compare themselves with the member closest to the hub. Those links are confirmed and joined
   to components, and only then the rest meets. A group of like texts where half are
   linked with each other and half with nothing costs its differences, not its pairs.
5. Every posting carries a sketch, four bits of each coordinate. Sketches agree wherever signatures do, and the number of
   coordinates where they differ is a metric: what matches a member that matches the hub differs from the hub in
   at most `COORDINATES - MATCHES` more than the member, so others need no differences; a hub that
   nothing matches needs none. Of several hubs a member needs its best. Pairs that stay
   are confirmed on the sets, and links give components.

A pair at exactly 80 % has MATCHES or more equal coordinates with probability over 0.9999.

No step collects links, pairs or lists of a corpus in one place, and none limits the partners of a text.
Null and empty texts, and texts of white space, have an empty set and are linked with nothing. Rows without
an id are linked like others, but an id is never null in a component that has one. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.support import LOWER, Workspace, components, text_of

COORDINATES = 64
MATCHES = 38
SHORT_LIST = 16  # lists up to here give all their pairs: at most half as many for each member
SETS_HELD = 64 << 20  # bytes of texts and sets a task keeps while it compares
SIGNED_ROW = "doc_id bigint, text_hash bigint, n_shingles bigint, class_high bigint, class_low bigint, signature array<int>, sketch struct<s0:bigint,s1:bigint,s2:bigint,s3:bigint>"
DIFFERENT_ROW = "hub bigint, node bigint, linked boolean, needs int, weight bigint, slack bigint, items array<bigint>"
SKETCH = ["s0", "s1", "s2", "s3"]  # 16 coordinates each
LOW_BITS = 0x1111111111111111
HASH_BITS = 1 << 24  # bits of the bitmap that tells which texts can be wanted: 2 MB in words of 64

# Fixed by a rule: odd multipliers and offsets of the coordinates' hash functions.
_DRAW = np.random.default_rng(7)
MULTIPLY = _DRAW.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
OFFSET = _DRAW.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; fewer words than `width` are one shingle."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    mixed = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        mixed = (mixed ^ hashes[k : k + n]) * MIX
        mixed ^= mixed >> np.uint64(29)
    if len(words) < width:
        mixed ^= np.uint64(len(words))
    return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of all coordinates, as signed 32-bit integers."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[at : at + 4096, None] * MULTIPLY + OFFSET).min(0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketch(values: np.ndarray) -> np.ndarray:
    """The low four bits of all minima in four 64-bit integers."""
    low = values.view(np.uint32).reshape(len(SKETCH), -1).astype(np.uint64) & np.uint64(15)
    return (low << (np.arange(low.shape[1], dtype=np.uint64) * np.uint64(4))).sum(1, dtype=np.uint64).view(np.int64)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """Per document the size of its set, a 128-bit name of the set, its signature and its sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, high, low, signatures, sketches = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                shingles = shingle_set(text, width)
                name = xxhash.xxh3_128_digest(shingles.tobytes())
                sizes.append(len(shingles))
                high.append(int.from_bytes(name[:8], "big", signed=True))
                low.append(int.from_bytes(name[8:], "big", signed=True))
                values = signature(shingles)
                signatures.append(values if len(shingles) else values[:0])
                sketches.append(sketch(values))
            lists = pa.array(signatures, pa.list_(pa.int32()))
            parts = np.array(sketches, np.int64).reshape(-1, len(SKETCH))
            packed = pa.StructArray.from_arrays([pa.array(parts[:, k]) for k in range(len(SKETCH))], SKETCH)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), lists, packed], names=[x.split()[0] for x in SIGNED_ROW.split(", ")])

    return _texts(docs).mapInArrow(sign, SIGNED_ROW)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().cast("binary").alias("text")
    )


def _wanted(texts: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows of `texts` whose `text_hash` may be among `hashes` (of_hash), by a bitmap of bounded size, so few others move."""
    bit = F.pmod(F.col("of_hash"), F.lit(HASH_BITS))
    words = hashes.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, int(pmod(of_hash, {HASH_BITS}) & 63))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    place = F.pmod(F.col("text_hash"), F.lit(HASH_BITS))
    met = texts.withColumn("word", F.shiftright(place, 6)).join(F.broadcast(words), "word")
    return met.where(F.getbit("bits", place.bitwiseAND(F.lit(63)).cast("int")) == 1).drop("word", "bits")


def prefixes(classes: DataFrame, percent: int, matches: int = MATCHES) -> DataFrame:
    """Postings (list, node, sketch, central) of each class's prefix: its rarest pairs that other classes have too.

    `central` is the sum of the frequencies of a class's pairs: its agreement with all other classes together.

    Pairs that one class alone has come first in the order, so a class with enough of them needs no posting.
    """
    length = COORDINATES - matches + 1
    postings = classes.select("node", F.posexplode("signature").alias("coordinate", "value")).select(
        "node", (F.shiftleft(F.col("coordinate").cast("bigint"), 32) + F.col("value").cast("bigint") + F.lit(1 << 31)).alias("pair")
    )
    shared = postings.groupBy("pair").agg(F.count("*").alias("frequency")).where("frequency > 1")
    ranked = postings.join(shared, "pair").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("frequency", "pair"))).alias("pairs"), F.sum("frequency").alias("central")
    )
    # of COORDINATES pairs, those missing here are the class's own and stand before all others
    kept = F.slice("pairs", F.lit(1), F.greatest(F.lit(length) - (F.lit(COORDINATES) - F.size("pairs")), F.lit(0)))
    step = F.floor(F.ln("n_shingles") / F.lit(math.log(100 / percent) + 1e-9)).cast("bigint")
    sized = ranked.join(classes.select("node", step.alias("step"), "sketch"), "node")
    return sized.select("node", F.explode(kept).alias("p"), "step", "sketch", "central").select(
        "node", F.explode(F.array(*[F.shiftleft(F.col("p.pair"), 8) + F.col("step") + k for k in (0, 1)])).alias("list"), "sketch", "central"
    )


def distinct_lists(lists: DataFrame) -> DataFrame:
    """The lists of two or more members, one of those with the same members: list, hub, members."""
    sized = lists.groupBy("list").agg(
        F.max(F.struct("central", "node")).alias("top"),
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    several = sized.where("members > 1").select("list", F.col("top.node").alias("hub"), "members", "x", "y")
    return several.groupBy("hub", "members", "x", "y").agg(F.min("list").alias("list")).drop("x", "y")


def _agreeing(a: str, b: str) -> Column:
    """In how many coordinates two sketches agree: no fewer than the signatures do."""
    differing = F.lit(0)
    for part in SKETCH:
        bits = F.col(f"{a}.{part}").bitwiseXOR(F.col(f"{b}.{part}"))
        any_bit = bits.bitwiseOR(F.shiftright(bits, 1)).bitwiseOR(F.shiftright(bits, 2)).bitwiseOR(F.shiftright(bits, 3))
        differing = differing + F.bit_count(any_bit.bitwiseAND(F.lit(LOW_BITS)))
    return F.lit(COORDINATES) - differing


class _Sets:
    """Sets of the texts a task has seen, up to a bound in bytes."""

    def __init__(self, width: int):
        self.width, self.known, self.held = width, {}, 0

    def of(self, text: bytes) -> np.ndarray:
        if text not in self.known:
            self.held += 10 * len(text)
            if self.held > SETS_HELD:
                self.known.clear()
                self.held = 10 * len(text)
            self.known[text] = shingle_set(text, self.width)
        return self.known[text]


def _hubs(members: DataFrame, each: int) -> DataFrame:
    """The most central members of every list: one, or the first `each`, found among the first of 32 shares of the list."""
    if each == 1:
        return members.where("node = hub").drop("hub")
    order = [F.desc("central"), F.desc("node")]
    share = F.pmod(F.col("node"), F.lit(32))
    first = members.withColumn("place", F.row_number().over(Window.partitionBy("list", share).orderBy(*order))).where(F.col("place") <= each)
    return first.withColumn("place", F.row_number().over(Window.partitionBy("list").orderBy(*order))).where(F.col("place") <= each).drop("hub")


class _Search:
    """The lists of one run: what has been linked, and what is left to compare."""

    def __init__(self, work: Workspace, nodes: DataFrame, texts: DataFrame, width: int, percent: int, matches: int):
        self.work, self.nodes, self.texts = work, nodes, texts
        self.width, self.percent, self.matches = width, percent, matches

    def _with_texts(self, pairs: DataFrame) -> DataFrame:
        pairs = self.work.table(pairs, "compared")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        texts = self.texts.join(ends, "node", "left_semi").dropDuplicates(["node"])
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The links among `pairs` (a, b), compared on their full sets."""
        width, percent = self.width, self.percent

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets = _Sets(width)

            def linked(x: bytes, y: bytes) -> bool:
                one, two = sets.of(x), sets.of(y)
                if 100 * min(len(one), len(two)) < percent * max(len(one), len(two)):
                    return False
                common = len(np.intersect1d(one, two, assume_unique=True))
                return 100 * common >= percent * (len(one) + len(two) - common)

            for batch in batches:
                flags = [linked(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(flags, pa.bool_()))

        return self._with_texts(pairs).mapInArrow(compare, "a bigint, b bigint")

    def differences(self, pairs: DataFrame) -> DataFrame:
        """Per (hub, node): whether they are linked, how many shared differences another member needs with the node
        at least, what the node's differences weigh, the hub's slack, and the differences as hashes."""
        width, percent = self.width, self.percent

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets = _Sets(width)
            for batch in batches:
                flags, needs, items, spare = [], [], [], []
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                    hub, node = sets.of(x), sets.of(y)
                    lacks = np.setdiff1d(hub, node, assume_unique=True)
                    more = np.setdiff1d(node, hub, assume_unique=True)
                    common = len(hub) - len(lacks)
                    flags.append(100 * common >= percent * (len(hub) + len(more)))
                    # (100 + percent) * s >= weight of both sets' differences - slack, from the counts in the module's text
                    weight = 100 * len(lacks) + percent * len(more)
                    slack = (100 - percent) * len(hub)
                    needs.append(weight // (100 + percent) + 1 if flags[-1] else max(1, -(-(weight - slack) // (100 + percent))))
                    items.append(np.concatenate([lacks, more]).view(np.int64))
                    spare.append((weight, slack))
                weights, slacks = zip(*spare) if spare else ((), ())
                columns = [*batch.columns[:2], pa.array(flags, pa.bool_()), pa.array(needs, pa.int32()), pa.array(weights, pa.int64()), pa.array(slacks, pa.int64()), pa.array(items, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["hub", "node", "linked", "needs", "weight", "slack", "items"])

        ends = pairs.select(F.col("hub").alias("a"), F.col("node").alias("b"))
        return self._with_texts(ends).mapInArrow(compare, DIFFERENT_ROW)

    def posted(self, different: DataFrame, roots: DataFrame) -> DataFrame:
        """Members of hubs under the rare ones of those differences that may link them to another component; `left` is how many
        such differences a member has from there on."""
        rooted = roots.select(F.col("node").alias("of"), "root")
        different = different.join(rooted, F.col("node") == F.col("of"), "left").withColumn("root", F.coalesce("root", "node")).drop("of")
        several = different.groupBy("hub").agg(F.count_if(~F.col("linked")).alias("loose"), F.min("root").alias("low"), F.max("root").alias("high"))
        different = different.join(several.where("loose > 0 AND low < high").select("hub"), "hub")
        each = different.select("hub", "node", "linked", "root", F.explode("items").alias("item"))
        counted = each.groupBy("hub", "item").agg(
            F.count("*").alias("frequency"), F.count_if(~F.col("linked")).alias("loose"), F.min("root").alias("low"), F.max("root").alias("high")
        )
        shared = counted.where("loose > 0 AND low < high").select("hub", "item", "frequency", (F.col("frequency") > F.col("loose")).alias("any_linked"))
        listed = each.join(shared, ["hub", "item"]).groupBy("hub", "node").agg(F.sort_array(F.collect_list(F.struct("frequency", "item", "any_linked"))).alias("shared"))
        # items that no other component has cannot be shared, so they stand first in the order and use up the prefix unposted
        ranked = F.transform("shared", lambda p, k: F.struct(p["item"].alias("item"), p["any_linked"].alias("any_linked"), (F.size("shared") - k).alias("left")))
        # two loose members differ by more than the slack each, so they need to share more than a loose and a linked one
        apart = F.floor(F.col("weight") / F.lit(100 + self.percent)) + 1
        kept = F.filter(ranked, lambda p: (p["left"] >= F.col("needs")) & (F.col("linked") | p["any_linked"] | (p["left"] >= apart)))
        member = ["hub", "node", "linked", "weight", "slack", "root"]
        return different.join(listed, ["hub", "node"]).select(*member, F.explode(kept).alias("p")).select(*member, "p.item", "p.left")

    def _meeting(self, others: DataFrame, posted: DataFrame) -> DataFrame:
        """Pairs (a, b) of a loose member of `others` and a posted one that meet in a list and can be linked."""
        loose = others.select(*[F.col(c).alias(f"x_{c}") for c in ("hub", "item", "node", "weight", "left", "root")])
        same = (F.col("x_hub") == F.col("hub")) & (F.col("x_item") == F.col("item")) & (F.col("x_root") != F.col("root"))
        # the first difference that two members share is followed by all others that they share
        enough = F.col("x_weight") + F.col("weight") - F.col("slack") <= (100 + self.percent) * F.least("x_left", "left")
        met = loose.join(posted, same & enough)
        return met.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()

    def near_leaders(self, posted: DataFrame) -> DataFrame:
        """Pairs (a, b) that can be linked of the loose member closest to the hub and others, in each list."""
        lead = F.min(F.struct("weight", "node", "left", "root")).alias("lead")
        return self._meeting(posted.where("not linked").groupBy("hub", "item").agg(lead).select("hub", "item", "lead.*"), posted)

    def near_hubs(self, posted: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs (a, b) of members of one hub, not both linked to it and of different components, that share enough rare
        differences to be linked."""
        rooted = roots.select(F.col("node").alias("of"), F.col("root").alias("now"))
        posted = posted.join(rooted, F.col("node") == F.col("of"), "left").withColumn("root", F.coalesce("now", "node")).drop("of", "now")
        return self._meeting(posted.where("not linked"), posted)

    def _apart(self, pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """The pairs (a, b) that are not known to be of one component."""
        for end in ("a", "b"):
            known = roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
            pairs = pairs.join(known, end, "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
        return pairs.where("ra <> rb").select("a", "b")

    def links(self, lists: DataFrame) -> DataFrame:
        """Links that connect whatever the lists (list, node, sketch, central) can connect."""
        work, far = self.work, COORDINATES - self.matches
        found: list[DataFrame] = []
        waiting: list[DataFrame] = []
        seen: list[DataFrame] = []
        hubs_each = 1
        while True:
            members = work.table(lists.join(distinct_lists(lists), "list"), "members")
            seen.append(members)
            short = members.where(F.col("members") <= SHORT_LIST)
            ends = [short.select("list", F.col("node").alias(n), F.col("sketch").alias(f"s{n}")) for n in "ab"]
            apart = (F.col("a") < F.col("b")) & (_agreeing("sa", "sb") >= self.matches)
            met = ends[0].join(ends[1].withColumnRenamed("list", "other"), (F.col("list") == F.col("other")) & apart)
            waiting.append(work.table(met.select("a", "b").distinct(), "short"))
            long = members.where(F.col("members") > SHORT_LIST)
            if long.isEmpty():
                break
            hubs = _hubs(long, hubs_each).select("list", F.col("node").alias("hub"), F.col("sketch").alias("hub_sketch"))
            against = long.select("list", "node", "sketch", "central").join(hubs, "list")
            against = against.withColumn("agree", F.when(F.col("node") == F.col("hub"), COORDINATES).otherwise(_agreeing("sketch", "hub_sketch")))
            top = F.max(F.struct("agree", "hub")).alias("top")
            best = against.groupBy("list", "node").agg(top, F.first("sketch").alias("sketch"), F.first("central").alias("central"))
            # whoever matches a hub meets the others at its best one: they differ from it in `far` more at most
            reach = best.where(F.col("top.agree") >= self.matches).groupBy("list", F.col("top.hub").alias("hub")).agg((F.min("top.agree") - far).alias("floor"))
            near = against.join(reach, ["list", "hub"]).where((F.col("node") != F.col("hub")) & (F.col("agree") >= F.col("floor")))
            pairs = near.select("hub", "node").distinct()
            for earlier in found:  # a hub of several rounds
                pairs = pairs.join(earlier.select("hub", "node"), ["hub", "node"], "left_anti")
            found.append(work.table(self.differences(pairs), "different"))
            # what matches no hub goes on; a pair with one end that does is among those near the hub
            lists = work.table(best.where(F.col("top.agree") < self.matches).drop("top"), "rest")
            hubs_each *= 4
        if not found:
            return self.linked(reduce(DataFrame.union, waiting).distinct())
        # what the hubs have brought into one component needs no comparison
        different = reduce(DataFrame.union, found)
        stars = work.table(different.where("linked").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")), "stars")
        roots = work.table(components(work, stars), "roots")
        posted = work.table(self.posted(different, roots), "differences-posted")
        work.drop(*found, *seen)
        pairs = work.table(reduce(DataFrame.union, [*waiting, self.near_leaders(posted)]).distinct(), "pairs")
        work.drop(*waiting)
        known = work.table(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(self.linked(self._apart(pairs, roots))), "known")
        roots = work.table(components(work, known), "roots")
        rest = work.table(self.near_hubs(posted, roots), "pairs")
        work.drop(posted)
        return known.union(self.linked(rest))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, matches: int = MATCHES) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest id that links lead to) and kept."""
    found = _components_of(docs, width, percent, matches).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _components_of(docs: DataFrame, width: int, percent: int, matches: int) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, and the id and text hash of the first row of its component."""
    work = Workspace(docs.sparkSession, "near-duplicates")
    rows = work.table(signed(docs, width), "signatures")
    name = ["class_high", "class_low"]
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "n_shingles", "signature", "sketch")
    # a class is known by half of its name: were two to share it, they would be compared as one, and confirmed
    classes = work.table(
        rows.where("n_shingles > 0")
        .groupBy(*name)
        .agg(F.min(first).alias("first"))
        .select(*name, F.col("class_high").alias("node"), "first.doc_id", "first.text_hash", "first.n_shingles", "first.signature", "first.sketch"),
        "classes",
    )
    posted = prefixes(classes, percent, matches)
    lists = work.table(posted.join(distinct_lists(posted).select("list"), "list"), "postings")
    active = lists.select("node").distinct().join(classes, "node").select("node", F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"))
    active = work.table(active, "active")
    texts = _wanted(_texts(docs), active).join(active, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")))
    texts = work.table(texts.select("node", "text"), "texts")
    search = _Search(work, classes.select("node"), texts, width, percent, matches)
    links = work.table(search.links(lists), "links")
    rooted = classes.select(*name, "node", "doc_id", "text_hash").join(components(work, links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("least"))
    found = rows.join(rooted.join(least, "root").select(*name, "least"), name, "left")
    known = F.col("n_shingles") > 0
    return found.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(known, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(known, F.col("least.text_hash")).otherwise(F.col("text_hash")).alias("component_hash"),
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stand for their components: the smallest id, of rows that share it the smallest text hash,
    and of rows that share both any one. Texts without words stand for themselves.
    """
    work = Workspace(docs.sparkSession, "one-of-each")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("component_hash"))
    found = _components_of(docs, width, percent, MATCHES).where(first).groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    kept = work.table(found, "kept")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    carried = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(text_of()).alias("hash"), row.alias("row"))

    def joined(wanted: DataFrame) -> DataFrame:
        return carried.join(wanted.select("doc_id", "text_hash"), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")))

    single = joined(kept.where("rows = 1")).select("row.*")
    repeated = joined(kept.where("rows > 1")).dropDuplicates(["id", "hash"]).select("row.*")
    return single.unionByName(repeated)
