"""N-gram Jaccard join: documents whose sets of word shingles are similar, and their groups.

1. Every document becomes its sorted set of 64-bit shingle hashes. Equal sets are one
   node from here on, whatever their number.
2. The smallest ``KEYS`` hashes of a set are its keys. Two sets of similarity s share
   none of them with probability (1 - s) ** KEYS at most, below 1e-24 at 0.75. Sets that
   share a key form a tile. Keys of more than ``HOT`` sets (of a passage that very many
   documents quote) are dropped by sets whose other keys are ``COLD_SHARE`` or more of
   their own: two similar sets with a share h of hot shingles still share a cold key but
   for a probability of (0.25 + h) ** KEYS, 4.1e-11 at h = 1 - ``COLD_SHARE``.
3. A tile is sorted by size, so each set is compared with a band of sizes only, and
   split into blocks of bounded size. Comparing means counting the bits in which two
   hashed bitmaps differ: each is a shingle that only one set has, which bounds the
   overlap from above. Only pairs that pass are written.
4. Their sorted hash arrays are intersected exactly.

Within a group of near copies not all pairs are tried. A first round takes stars: in each
block a pivot and all that pass with it, up to three pivots for a set. From then on only sets
of different components are compared, and links are kept as links of components. A second
round writes, for every set, the ``NEAREST`` of its candidates by the bitmaps. Whoever had more
of them is compared once more, with all others of whom that is true and that are still in
another component. So every pair that passes the bitmaps is tried, or its sets were linked
before. In a key of several blocks the sets of its largest component stay in their own block;
the others visit all blocks. More rounds over one set of each component come before that while
the visits are many.

Cases: null or wordless texts have an empty set and link to nothing, not to each other;
fewer words than a shingle make one shingle; a null id takes part in the links, but the
smallest id of a group is a non-null one; repeated rows and equal ids are fine; an empty
table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantry.llm.common import WordHashes, chunks, free_name, mixed, small_batches, text_or_empty
from gantry.llm.components import components
from gantry.sources.scratch import staged, stored

#: Writes a table and reads it back; the table goes when the join is done.
Keep = Callable[[DataFrame], DataFrame]

SHINGLE = 5
#: Links need overlap / union >= 3/4, that is 7 * overlap >= 3 * (sum of sizes).
KEYS = 40
HOT = 1000
COLD_SHARE = 0.7
#: Most sets at home in a block of a tile.
BLOCK = 2048
#: Candidates of a set, by the bitmaps, that one tile writes in the second round.
NEAREST = 3
#: Rounds over one set of each component go on while visits are more than so many times the sets.
VISITS = 2
MIN_BITS, MAX_BITS = 256, 1 << 18

# ---- sets ----------------------------------------------------------------


def shingle_sets(texts: list[bytes], cache: WordHashes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for a, b in chunks(texts):
        words = [t.lower().split() for t in texts[a:b]]
        flat = cache.of([w for of_text in words for w in of_text])
        ends = np.cumsum([len(w) for w in words])
        rolled = np.zeros(max(0, len(flat) - size + 1), np.uint64)
        for k in range(size):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + mixed(flat[k : k + len(rolled)] + np.uint64(k))
        rolled = mixed(rolled)
        for of_text, end in zip(words, ends):
            n = len(of_text)
            if n >= size:
                yield np.unique(rolled[end - n : end - size + 1])
            elif n:
                whole = xxhash.xxh64_intdigest(b"\n".join(of_text), seed=n)
                yield np.array([whole], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def bitmap(hashes: np.ndarray) -> bytes:
    """A bitmap of about four bits for each shingle; halves can be folded onto each other."""
    bits = MIN_BITS
    while bits < min(4 * len(hashes), MAX_BITS):
        bits *= 2
    marks = np.zeros(bits, bool)
    marks[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marks).tobytes()


def _node(hashes: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(hashes.tobytes())


def _set_columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = WordHashes()
    for frame in batches:
        rows = []
        for hashes in shingle_sets(list(frame.pop("text")), cache):
            rows.append((len(hashes), _node(hashes), hashes[:KEYS].view(np.int64), bitmap(hashes)))
        sets = pd.DataFrame(rows, columns=["n", "node", "keys", "bits"], index=frame.index)
        yield pd.concat([frame, sets], axis=1)


def _hash_arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = WordHashes()
    for frame in batches:
        rows = [(_node(h), h.tobytes()) for h in shingle_sets(list(frame["text"]), cache)]
        yield pd.DataFrame(rows, columns=["node", "hashes"])


# ---- tiles ---------------------------------------------------------------


def _fold(bits: bytes, size: int) -> bytes:
    array = np.frombuffer(bits, np.uint8)
    while len(array) > size:
        half = len(array) // 2
        array = array[:half] | array[half:]
    return array.tobytes()


def tile_pairs(
    n: np.ndarray, bits: list[bytes], groups: np.ndarray, visits: np.ndarray, star: bool
) -> list[tuple[int, int]]:
    """The pairs of :func:`bounded_pairs`."""
    one, other, _ = bounded_pairs(n, bits, groups, visits.astype(bool), star)
    return list(zip(one.tolist(), other.tolist()))


def bounded_pairs(
    n: np.ndarray, bits: list[bytes], groups: np.ndarray, visits: np.ndarray, star: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a tile, sorted by size, that the bitmaps do not rule out, and the share of shingles
    in which they differ at least.

    Only sets of different ``groups`` are compared, and no two visitors. With ``star`` a set that
    passed with an earlier pivot is not compared again.
    """
    count = len(n)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    last = np.searchsorted(n, n * 4 // 3, side="right")
    absorbed = np.zeros(count, bool)
    folded: dict[int, np.ndarray] = {}
    for p in range(count - 1):
        if star and absorbed[p]:
            continue
        q = np.arange(p + 1, last[p])
        q = q[(groups[q] != groups[p]) & ~(visits[q] & visits[p])]
        if star:
            q = q[~absorbed[q]]
        if not len(q):
            continue
        size = len(bits[p])
        if count <= 24:
            own = int.from_bytes(bits[p], "little")
            differ = np.array(
                [(own ^ int.from_bytes(_fold(bits[j], size) if len(bits[j]) > size else bits[j], "little")).bit_count() for j in q]
            )
        else:
            if size not in folded:
                folded.clear()
                fits = [b if len(b) == size else _fold(b, size) if size < len(b) <= 4 * size else bytes(size) for b in bits]
                folded[size] = np.frombuffer(b"".join(fits), np.uint64).reshape(count, -1)
            table = folded[size]
            differ = np.bitwise_count(table[q] ^ table[p]).sum(axis=1, dtype=np.int64)
        passed = 7 * differ <= n[p] + n[q]
        q, differ = q[passed], differ[passed]
        absorbed[q] = True
        found.append((np.full(len(q), p), q, differ / (n[p] + n[q])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*found))


def own_pairs(key: int, used: list[np.ndarray], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which pairs of sets that have ``key`` share no smaller one, from the keys of each set."""
    sizes = [len(u) for u in used]
    keys, owner = np.concatenate(used), np.repeat(np.arange(len(used)), sizes)
    smaller = keys < key
    _, which, holders = np.unique(keys[smaller], return_inverse=True, return_counts=True)
    common = holders >= 2
    column = (np.cumsum(common) - 1)[which][common[which]]
    marks = np.zeros((len(used), int(common.sum()) // 64 + 1), np.uint64)
    bit = np.uint64(1) << (column % 64).astype(np.uint64)
    np.bitwise_or.at(marks, (owner[smaller][common[which]], column // 64), bit)
    step = max(1, (1 << 20) // marks.shape[1])
    parts = [(marks[one[i : i + step]] & marks[other[i : i + step]]).any(axis=1) for i in range(0, len(one), step)]
    return ~np.concatenate(parts) if parts else np.zeros(0, bool)


def nearest(one: np.ndarray, other: np.ndarray, differ: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are among the ``NEAREST`` of either set, and which of ``count`` sets have more pairs."""
    sets = np.concatenate([one, other])
    order = np.lexsort((np.tile(np.arange(len(one)), 2), np.tile(differ, 2), sets))
    ordered = sets[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    place = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.r_[starts, len(ordered)]))
    kept = np.zeros(len(one), bool)
    kept[order[place < NEAREST] % len(one)] = True
    more = np.zeros(count, bool)
    more[ordered[place >= NEAREST]] = True
    return kept, more


def _tiles(star: bool, few: bool):
    """Pairs of sets, the smaller node first, and for ``few`` whether each of them has more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs(frame: pd.DataFrame) -> pd.DataFrame:
            n, bits, nodes = frame["n"].to_numpy(np.int64), frame["bits"].tolist(), frame["node"].tolist()
            groups = pd.factorize(frame["component"])[0]
            tile = frame["tile"].to_numpy()
            visits = frame["visits"].to_numpy(bool)
            starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
            used = frame["used"].tolist() if not star else None
            rows = set()
            for a, b in zip(starts, np.r_[starts[1:], len(tile)]):
                one, other, differ = bounded_pairs(n[a:b], bits[a:b], groups[a:b], visits[a:b], star)
                if not len(one):
                    continue
                if not star:
                    # of all tiles that hold both sets, those of their smallest common key name the pair
                    named = own_pairs(int(tile[a].partition(":")[0]), used[a:b], one, other)
                    one, other, differ = one[named], other[named], differ[named]
                more = np.zeros(b - a, bool)
                if few and len(one):
                    kept, more = nearest(one, other, differ, b - a)
                    one, other = one[kept], other[kept]
                for i, j in zip(one.tolist(), other.tolist()):
                    x, y = (i, j) if nodes[a + i] < nodes[a + j] else (j, i)
                    rows.add((nodes[a + x], nodes[a + y], bool(more[x]), bool(more[y])))
            return pd.DataFrame(list(rows), columns=["a", "b", "more_a", "more_b"])

        waiting: list[pd.DataFrame] = []  # of one tile, which may go on in the next batch
        for frame in batches:
            if not len(frame):
                continue
            cut = int(np.argmax(frame["tile"].to_numpy() == frame["tile"].iloc[-1]))
            if cut or (waiting and waiting[0]["tile"].iloc[0] != frame["tile"].iloc[0]):
                yield pairs(pd.concat([*waiting, frame.iloc[:cut]], ignore_index=True))
                waiting = []
            waiting.append(frame.iloc[cut:])
        if waiting:
            yield pairs(pd.concat(waiting, ignore_index=True))

    return run


@F.pandas_udf(T.BooleanType())
def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    """Exact: the intersection of two sorted arrays of distinct hashes."""

    def linked(x: bytes, y: bytes) -> bool:
        one, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.sort(np.concatenate([one, other]), kind="stable")
        overlap = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * overlap >= 75 * (len(both) - overlap)

    return pd.Series([linked(x, y) for x, y in zip(a, b)], dtype=bool)


def _shared_keys(nodes: DataFrame, keep: Keep) -> DataFrame:
    """``key``, ``node``, ``n_blocks`` where at least two nodes have the key; hot keys only where needed."""
    entries = nodes.select("node", F.size("keys").alias("n_keys"), F.explode("keys").alias("key"))
    counts = entries.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = keep(entries.join(counts, "key").withColumn("n_blocks", F.ceil(F.col("holders") / BLOCK)))
    hot = F.col("holders") > HOT
    mostly_hot = (
        shared.where(hot)
        .groupBy("node")
        .agg(F.count("*").alias("n_hot"), F.first("n_keys").alias("n_keys"))
        .where(F.col("n_hot") > (1 - COLD_SHARE) * F.col("n_keys"))
        .select("node")
    )
    names = ["key", "node", "n_blocks"]
    return shared.where(~hot).select(names).union(shared.where(hot).join(mostly_hot, "node", "left_semi").select(names))


def _block() -> Column:
    return F.pmod(F.xxhash64("node", F.lit(7)), F.col("n_blocks"))


def _first_members(keyed: DataFrame) -> DataFrame:
    """Every set at home in its block, each a component of its own."""
    return keyed.select("key", "node", F.col("node").alias("component"), _block().alias("block"), F.lit(False).alias("visits"))


def _in_components(keyed: DataFrame, labels: DataFrame) -> DataFrame:
    """``key``, ``node``, ``component``."""
    named = labels.select(F.col("child").alias("node"), "parent")
    return keyed.select("key", "node").join(named, "node", "left").select("key", "node", F.coalesce("parent", "node").alias("component"))


def _open_keys(members: DataFrame) -> DataFrame:
    """Keys of more than one component, with their ``n_blocks``, the largest component and the visits."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("size"))
    keys = sizes.groupBy("key").agg(
        F.sum("size").alias("sets"), F.count("*").alias("components"), F.max(F.struct("size", "component")).alias("top")
    )
    blocks = F.ceil(F.col("sets") / BLOCK)
    return keys.where("components > 1").select(
        "key",
        "sets",
        blocks.alias("n_blocks"),
        F.col("top.component").alias("largest"),
        ((blocks - 1) * (F.col("sets") - F.col("top.size"))).alias("visits"),
    )


def _one_of_each(members: DataFrame) -> DataFrame:
    """One set of each component of a key, at home in its block."""
    one = members.groupBy("key", "component").agg(F.min("node").alias("node"))
    keys = one.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1")
    blocks = keys.select("key", F.ceil(F.col("sets") / BLOCK).alias("n_blocks"))
    return one.join(blocks, "key").select("key", "node", "component", _block().alias("block"), F.lit(False).alias("visits"))


def _dealt(members: DataFrame, keys: DataFrame) -> DataFrame:
    """Sets of open keys in their own blocks and, but for the largest component's, in all others."""
    joined = members.join(keys.select("key", "n_blocks", "largest"), "key").withColumn("home", _block())
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)
    blocks = F.when(F.col("component") == F.col("largest"), F.array("home")).otherwise(everywhere)
    dealt = joined.select("key", "node", "component", "home", F.explode(blocks).alias("block"))
    return dealt.withColumn("visits", F.col("block") != F.col("home")).drop("home")


def _run_tiles(members: DataFrame, nodes: DataFrame, star: bool = False, few: bool = False) -> DataFrame:
    """Pairs of ``members``, repeated if ``star``; ``nodes`` has sizes, bitmaps and, if not ``star``, the keys in use of each set."""
    extra = [] if star else ["used"]
    members = members.join(nodes.select("node", "n", "bits", *extra), "node")
    tiled = members.withColumn("tile", F.concat_ws(":", "key", "block")).drop("key", "block")
    dealt = tiled.repartition("tile").sortWithinPartitions("tile", "n", "node")
    pairs = dealt.mapInPandas(_tiles(star, few), "a binary, b binary, more_a boolean, more_b boolean")
    if star:
        return pairs
    return pairs.groupBy("a", "b").agg(F.max("more_a").alias("more_a"), F.max("more_b").alias("more_b"))


def _few_pivots(pairs: DataFrame) -> DataFrame:
    """At most three of the pairs of each ``b``."""
    some = F.array_distinct(F.array(F.min("a"), F.max("a"), F.min_by("a", F.xxhash64("a", "b"))))
    return pairs.groupBy("b").agg(some.alias("some")).select(F.explode("some").alias("a"), "b")


def _linked(labels: DataFrame | None, links: DataFrame, keep: Keep) -> DataFrame:
    """``child``, ``parent`` (a component's name) for all sets with links, after more links.

    Links become links of components first, each once, so what is left of a group that is
    known already is small.
    """
    if labels is None:
        return components(links, keep)
    for end in ("a", "b"):
        names = labels.select(F.col("child").alias(end), F.col("parent").alias(f"of_{end}"))
        links = links.join(names, end, "left").withColumn(end, F.coalesce(f"of_{end}", end)).drop(f"of_{end}")
    roots = components(links.distinct(), keep)
    renamed = roots.select(F.col("child").alias("parent"), F.col("parent").alias("root"))
    moved = labels.join(renamed, "parent", "left").select("child", F.coalesce("root", "parent").alias("parent"))
    return keep(moved.union(roots))


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sets are similar. ``texts``: ``t1``, ``t2``, ``text``."""
    pairs = pairs.select("a", "b")
    ends = pairs.select("a").union(pairs.select("b")).withColumnRenamed("a", "node").distinct()
    wanted = nodes.join(ends, "node", "left_semi").select("t1", "t2", F.col("id").alias("of_id"))
    # of equal texts that of the smallest id moves, and as hashes
    same = (F.col("id").eqNullSafe(F.col("of_id"))) & (texts["t1"] == wanted["t1"]) & (texts["t2"] == wanted["t2"])
    found = texts.join(wanted, same, "left_semi").select("text").mapInPandas(_hash_arrays, "node binary, hashes binary")
    arrays = found.groupBy("node").agg(F.first("hashes").alias("hashes"))
    left = arrays.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a"))
    right = arrays.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))
    checked = pairs.join(right, "b").join(left, "a")
    return checked.where(_similar("hashes_a", "hashes_b")).select("a", "b")


# ---- the join ------------------------------------------------------------


def similar_groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n`` (set size) and ``component`` for each row; null for an empty set."""
    text = text_or_empty(text_col)
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text, F.lit(1)).alias("t1"),
        F.xxhash64(text, F.lit(2)).alias("t2"),
        text.cast("binary").alias("text"),
    )
    with small_batches(docs.sparkSession), ExitStack() as scratch:
        def keep(df: DataFrame) -> DataFrame:
            return scratch.enter_context(staged(df))

        id_type = texts.schema["id"].dataType.simpleString()
        sets = keep(
            texts.mapInPandas(
                _set_columns, f"id {id_type}, t1 long, t2 long, n long, node binary, keys array<long>, bits binary"
            )
        )
        nodes = keep(
            sets.where("n > 0")
            .groupBy("node")
            .agg(
                F.first("n").alias("n"),
                F.first("keys").alias("keys"),
                F.first("bits").alias("bits"),
                F.min(F.struct("t1", "t2", "id")).alias("t"),
            )
            .select("node", "n", "keys", "bits", "t.t1", "t.t2", "t.id")
        )
        keyed = keep(_shared_keys(nodes, keep))
        pairs = keep(_few_pivots(_run_tiles(_first_members(keyed), nodes, star=True)))
        labels = _linked(None, _verified(pairs, nodes, texts), keep)
        while True:
            members = keep(_in_components(keyed, labels))
            keys = keep(_open_keys(members))
            at_home, visits = keys.agg(F.sum("sets"), F.sum("visits")).first()
            if not at_home or visits <= VISITS * at_home:
                break
            pairs = keep(_few_pivots(_run_tiles(_one_of_each(members), nodes, star=True)))
            new = keep(_verified(pairs, nodes, texts))
            labels = _linked(labels, new, keep)
            if new.isEmpty():
                break
        used = nodes.join(keyed.groupBy("node").agg(F.collect_list("key").alias("used")), "node")  # KEYS at most
        pairs = keep(_run_tiles(_dealt(members, keys), used, few=True))
        labels = _linked(labels, _verified(pairs, nodes, texts), keep)
        ends = [F.struct(F.col(end).alias("node"), F.col(f"more_{end}").alias("more")) for end in ("a", "b")]
        crowded = pairs.select(F.inline(F.array(*ends))).where("more").select("node").distinct()
        crowded = keep(keyed.join(crowded, "node", "left_semi"))
        if not crowded.isEmpty():
            members = keep(_in_components(crowded, labels))
            pairs = keep(_run_tiles(_dealt(members, _open_keys(members)), used))
            labels = _linked(labels, _verified(pairs, nodes, texts), keep)
        root = labels.select(F.col("child").alias("node"), F.col("parent").alias("root"))
        component = F.when(F.col("n") > 0, F.coalesce("root", "node"))
        return stored(sets.join(root, "node", "left").select("id", "n", component.alias("component")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``, the smallest id of its group."""
    grouped = similar_groups(docs, id_col, text_col)
    smallest = grouped.where("component is not null").groupBy("component").agg(F.min("id").alias("component_id"))
    return grouped.join(smallest, "component", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id (non-null first) of each group, with all columns.

    Rows with an empty set are groups of their own and stay.
    """
    row = free_name(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    grouped = similar_groups(rows, row, text_col)
    ids = rows.select(F.col(row).alias("id"), F.col(id_col).alias("own"))
    group = F.coalesce("component", F.concat(F.lit("row "), F.col("id")).cast("binary"))
    first = F.struct(F.col("own").isNull(), "own", "id")
    kept = grouped.join(ids, "id").groupBy(group.alias("g")).agg(F.min(first)["id"].alias(row))
    return rows.join(kept.select(row), row, "left_semi").drop(row)
