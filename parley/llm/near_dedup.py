"""Near-duplicate groups by one-permutation MinHash, in DataFrame operations only.

Every text becomes the set of hashes of its two-word shingles. One permutation
(the hash itself) fills ``BINS`` bins by its leading bits; an empty bin asks
the others in an order of its own, the same for all documents, and takes the
value of the first that is filled (optimal densification: what it takes never
depends on the size of the set). Bands of ``ROWS`` bins make buckets.

Sets of up to ``SMALL`` shingles fill too few bins for that, so they have no
bands but an exact way: near sets share one of their rarest shingles (a prefix
of each set, by the number of sets that hold a shingle), and all pairs of sets
that do are confirmed.

Equal sets are folded first, so a group of thousands of copies is one row. In
each bucket all members are joined to one hub, a star, never to each other;
the hub is the bucket's smallest member, so the bands of one cluster name the
same few pairs again and again. Pairs are confirmed on the full sets.

A star misses a link between two of its points when the hub is too far from
one of them. So buckets whose members are not in one component after that get
further rounds: their next ``HUBS`` members, those of the bucket's smallest
components first, are hubs for the members of its other components, and then
leave the bucket. It is done when it holds one component only. Nothing is
capped: every pair of a bucket is tested or already joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.session import cut, free

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: 2 ** BIN_BITS bins, bands of ROWS bins each.
BIN_BITS, ROWS = 7, 4
BINS = 1 << BIN_BITS
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles up to which a set's links are found exactly, by its rarest shingles.
SMALL = 40
#: Bins that an empty bin asks first; it asks all others only if none of these is filled.
TRIES = 8
#: Hubs of a bucket in one later round.
HUBS = 32
#: Rows up to which a table of ids is broadcast (16 bytes each); beyond, ids are joined by shuffles.
BROADCAST_IDS = 2_000_000


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of the text with A-Z in lower case; null and empty texts have none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def shingles(text: Column) -> Column:
    """Sorted distinct 64-bit hashes of the two-word shingles of a text.

    A text of one word has that word as its only shingle; one without words,
    or a null, has none.
    """
    pairs = lambda h: F.zip_with(F.slice(h, 1, F.size(h) - 1), F.slice(h, 2, F.size(h) - 1), lambda a, b: F.xxhash64(a, b))
    return let(F.transform(words(text), lambda w: F.xxhash64(w)), lambda h: F.sort_array(F.array_distinct(F.when(F.size(h) < 2, h).otherwise(pairs(h)))))


def bands(sets: Column) -> Column:
    """One hash per band of the densified bins of a sorted set; an empty set has none."""
    bin_of = lambda h: F.shiftrightunsigned(h, 64 - BIN_BITS).cast("int")
    # In a sorted set every bin is one stretch, its least value first.
    firsts = lambda s: F.filter(s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(s, i - 1))))
    dense = lambda f: let(F.map_from_arrays(F.transform(f, bin_of), f), lambda m: F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.element_at(m, b)))
    # Where an empty bin looks is the same for all documents: constant tables, read from their JSON once.
    table = lambda a, b: F.from_json(F.lit(str([_order(k)[a:b] for k in range(BINS)])), "array<array<int>>")
    first, rest = table(0, TRIES), table(TRIES, BINS - 1)

    def filled(d: Column) -> Column:
        look = lambda t, b: F.aggregate(F.get(t, b), F.lit(None).cast("bigint"), lambda got, x: F.coalesce(got, F.get(d, x)))
        return F.transform(d, lambda v, b: F.coalesce(v, look(first, b), look(rest, b)))

    hashed = lambda m: F.array(*[F.xxhash64(F.lit(k), *[F.get(m, F.lit(k * ROWS + j)) for j in range(ROWS)]) for k in range(BINS // ROWS)])
    made = let(firsts(sets), lambda f: let(dense(f), lambda d: let(filled(d), hashed)))
    return F.when(F.size(sets) > 0, made)


def _order(b: int) -> list[int]:
    """All other bins, in the order in which bin ``b`` asks them."""

    def mix(x: int) -> int:
        x = (b * 0x9E3779B97F4A7C15 + (x + 1) * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1
        x = (x ^ x >> 31) * 0x94D049BB133111EB & (1 << 64) - 1
        return x ^ x >> 29

    return sorted((x for x in range(BINS) if x != b), key=mix)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node of ``a, b`` edges.

    Alternating large and small stars: each round hangs all neighbours of a
    node on the smallest of them, until nothing changes. Minima are aggregated,
    so a node with millions of neighbours is no list anywhere.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    before = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        edges = both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        edges = cut(edges.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("b", "b"))


def _confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the ``a, b`` pairs whose full sets are near enough."""
    ids = cut(pairs.select("a").union(pairs.select("b")).distinct().toDF("rep"))
    small = ids.count() <= BROADCAST_IDS
    wanted = docs.select(F.col("doc_id").alias("rep"), "text").join(F.broadcast(ids) if small else ids, "rep", "left_semi")
    sets = wanted.select("rep", shingles(F.col("text")).alias("s"))
    near = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
    both = F.size(F.array_intersect("sa", "sb"))
    return near.filter(100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _unlike(a: str, b: str) -> Column:
    """Whether two sizes alone rule a link out."""
    return 100 * F.least(a, b) < PERCENT * F.greatest(a, b)


def _small_pairs(folded: DataFrame) -> DataFrame:
    """``a, b``: all pairs that may be near with a set of ``SMALL`` shingles or less in them.

    ``small`` holds the shingles of sets of up to the size that such a set can be near to.
    """
    own = ["k1", "k2", "n", "rep"]
    held = folded.select(*own, F.explode("small").alias("h"))
    common = held.groupBy("h").agg(F.count("*").alias("sets")).filter("sets > 1")
    # Shingles of one set alone are the rarest and take the first places; they make no pairs.
    held = held.join(common, "h").groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("sets", "h"))).alias("common"))
    places = F.floor((100 - PERCENT) * F.col("n") / 100) + 1 - (F.col("n") - F.size("common"))
    first = held.select("rep", "n", F.explode(F.slice("common", F.lit(1), F.greatest(places, F.lit(0)).cast("int"))).alias("c")).select("rep", "n", "c.h")
    pairs = first.join(first.toDF("hub", "hub_n", "h"), "h").filter((F.col("rep") > F.col("hub")) & (F.least("n", "hub_n") <= SMALL) & ~_unlike("n", "hub_n"))
    return pairs.select(F.col("rep").alias("a"), F.col("hub").alias("b"))


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``doc_id, text``.

    Null and empty texts have no shingles and are their own component; so is a
    row without a ``doc_id`` unless its text has a copy. Rows that repeat a
    ``doc_id`` each have the component of their own text, by which they may
    differ. Other columns are ignored.
    """
    out = _grouped(docs).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n, component_id`` of every row; ``key`` is a hash of the text."""
    docs = docs.select("doc_id", "text")
    made = docs.select("doc_id", F.xxhash64("text").alias("key"), shingles(F.col("text")).alias("s"))
    base = cut(made.select("doc_id", "key", F.size("s").alias("n"), F.xxhash64("s").alias("k1"), F.xxhash64(F.lit(1), "s").alias("k2"), F.when(F.size("s") > SMALL, bands(F.col("s"))).alias("bands"), F.when(F.size("s") <= 100 * SMALL // PERCENT, F.col("s")).alias("small")))
    folded = base.filter("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("small").alias("small"))
    spread = folded.select("rep", "n", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("hub"), F.count("*").alias("m")).filter("m > 1")
    stars = spread.join(shared, "band").select("band", "rep", "n", "hub")
    stars = cut(stars)
    pairs = stars.filter((F.col("rep") != F.col("hub.rep")) & ~_unlike("n", "hub.n")).select(F.col("rep").alias("a"), F.col("hub.rep").alias("b")).distinct()
    pairs = cut(pairs.union(_small_pairs(folded)).distinct())
    links = cut(_confirm(pairs, docs))
    left = stars.select("band", "rep", "n")
    comp = components(links)
    while True:
        left = left.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        mixed = left.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("band")
        left = cut(left.join(mixed, "band"))
        if left.isEmpty():
            break
        ranked = left.join(left.groupBy("band", "component").agg(F.count("*").alias("size")), ["band", "component"])
        for part in (["band", F.pmod(F.xxhash64("rep"), F.lit(64))], ["band"]):
            ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy(*part).orderBy("size", "rep"))).filter(F.col("r") <= HUBS)
        hubs = cut(ranked.select("band", F.col("rep").alias("hub"), F.col("n").alias("hub_n"), F.col("component").alias("hub_component")))
        new = left.join(hubs, "band").filter((F.col("component") != F.col("hub_component")) & ~_unlike("n", "hub_n"))
        new = new.select(F.greatest("rep", "hub").alias("a"), F.least("rep", "hub").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
        new = cut(new)
        pairs = cut(pairs.union(new))
        found = cut(_confirm(new, docs))
        if not found.isEmpty():
            links = cut(links.union(found))
            comp = components(links)
        left = left.join(hubs.select("band", F.col("hub").alias("rep")), ["band", "rep"], "left_anti").select("band", "rep", "n")
    # Back from the folded sets to every document.
    reps = folded.select("k1", "k2", "n", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    reps = reps.select("k1", "k2", "n", F.coalesce("component", "rep").alias("c"))
    out = base.select("doc_id", "key", "n", "k1", "k2").join(reps, ["k1", "k2", "n"], "left")
    return out.select("doc_id", "key", "n", F.coalesce("c", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) but those that a smaller doc_id of their group stands for.

    Rows without a doc_id stay, and so do those without words. Of rows that
    repeat both a doc_id and the words of its text, one stays.
    """
    key, name = free(docs.columns, "key"), free(docs.columns, "set")
    found = cut(_grouped(docs.filter("doc_id is not null").select("doc_id", "text")).filter("n > 0").select("doc_id", "key", "component_id"))
    gone = found.filter("component_id <> doc_id").select("doc_id", F.col("key").alias(key)).distinct()
    again = found.filter("component_id = doc_id").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    out = docs.withColumn(key, F.xxhash64("text")).join(_small(gone), ["doc_id", key], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    if again.isEmpty():
        return out
    # Few ids are repeated: only their rows move.
    again = cut(again)
    once, rest = out.join(_small(again), "doc_id", "left_semi"), out.join(_small(again), "doc_id", "left_anti")
    # Rows without words are told apart by nothing else, so each has a number of its own.
    own = F.when(F.size(shingles(F.col("text"))) > 0, F.xxhash64(shingles(F.col("text")))).otherwise(F.monotonically_increasing_id())
    once = once.withColumn(name, own).dropDuplicates(["doc_id", name])
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).union(rest.select(*[F.col(f"`{c}`") for c in docs.columns]))


def _small(ids: DataFrame) -> DataFrame:
    """Broadcast a table of ids if it is small, by its counted rows."""
    ids = cut(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
