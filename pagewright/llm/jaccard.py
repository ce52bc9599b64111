"""N-gram Jaccard join: prefix filters under several token orders, then exact verification."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import content_hash, documents, fresh_name, small_batches, stage, unstage, without
from pagewright.llm.components import components

SIZE, PERCENT = 4, 85
ORDERS = 3               # token orders whose prefix filters are intersected
SKETCH = 1 << 20         # counters of the frequency sketch; bounds what is broadcast
BLOCK = 1 << 10          # counters in one row
CACHED_WORDS = 500_000   # a worker forgets its words beyond that
SHORT = 8                # a list of no more members is done at once: each meets those before it
STAR_ROUNDS = 6
FEW_PAIRS = 4            # with fewer open pairs per listed document, star rounds end
PARITY_WORDS = 8         # 64-bit words of a set's parity sketch
PARITY = [f"p{i}" for i in range(PARITY_WORDS)]
SHARE_WORDS = 2          # 64-bit words of the signature of a prefix
SHARES = [f"s{order}_{i}" for order in range(1, ORDERS) for i in range(SHARE_WORDS)]
DETAILS = ["n", *PARITY, *SHARES]
LARGE = 128 * PARITY_WORDS  # sets of more tokens also have a long parity sketch


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; bytes.split knows just ASCII white space."""
    found = (text or "").encode().lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, n)
    width = min(n, size)
    acc = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        acc = mix64((acc + h[j:n - width + 1 + j]) * np.uint64(0x9E3779B97F4A7C15))
    return np.unique(acc)


def prefix_length(n: int, percent: int) -> int:
    """So many first tokens of a set of n must meet those of any set that is similar enough."""
    return n + (-percent * n // 100) + 1


def prefix(tokens: np.ndarray, levels: np.ndarray | None, order: int, percent: int) -> np.ndarray:
    """The first tokens in a global order: by a hash of the token, in the first order after its
    level, rare ones first."""
    p = prefix_length(len(tokens), percent)
    if p >= len(tokens):
        return tokens
    rank = mix64(tokens + np.uint64(order * 0xD1342543DE82EF95 % (1 << 64)))
    if order == 0:
        rank = rank >> np.uint64(8) | levels[(tokens % np.uint64(SKETCH)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    return tokens[np.argpartition(rank, p - 1)[:p]]


def signature(tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
    """Each token of the prefix sets a bit; where two signatures share none, neither do the prefixes."""
    bits = np.zeros(64 * SHARE_WORDS, np.uint8)
    if len(tokens):
        bits[(mix64(prefix(tokens, None, order, percent)) % np.uint64(len(bits))).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def node_of(tokens: np.ndarray) -> int:
    """A document's node: 64 bits of its set, so equal sets are one node."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity(tokens: np.ndarray) -> np.ndarray:
    """Each token flips one of 512 bits. The bits in which two sets differ are never more than
    the tokens in which they differ, and nearly as many while these are few."""
    bits = 64 * PARITY_WORDS
    flips = np.bincount((mix64(tokens) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def long_parity(tokens: np.ndarray) -> bytes | None:
    """The same sketch of as many bits as the set has tokens, rounded up to a power of two; none
    for sets that the short one serves. The xor of its halves is the sketch of half the bits."""
    if len(tokens) <= LARGE:
        return None
    bits = 1 << (len(tokens) - 1).bit_length()
    flips = np.bincount((mix64(tokens) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def parities_differ(x: bytes, y: bytes) -> int:
    """In how many bits two long sketches differ, at the length of the shorter one."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


NODE = ("doc_id long, key long, pick long, node long, long binary, block int, counts binary, "
        + ", ".join(f"{c} long" for c in DETAILS))


def _nodes(size: int, percent: int):
    """A row for each document, then the task's sketch: in how many sets a token's counter occurs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, counts, seen = WordHashes(), np.zeros(SKETCH, np.int32), set()
        for batch in batches:
            node, long, details = [], [], []
            for text in batch["text"]:
                tokens = shingles(text, size, hashes)
                node.append(node_of(tokens))
                long.append(long_parity(tokens))
                details.append(np.concatenate([[len(tokens)], parity(tokens), *[signature(tokens, o, percent) for o in range(1, ORDERS)]]))
                if node[-1] not in seen and len(tokens):
                    seen.add(node[-1])
                    np.add.at(counts, (tokens % np.uint64(SKETCH)).astype(np.int64), 1)
                    if len(seen) > 1_000_000:
                        seen.clear()
            details = np.array(details, np.int64).reshape(-1, len(DETAILS))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").array, "key": batch["key"].astype("Int64").array, "pick": batch["pick"],
                                "node": node, "long": long, "block": None, "counts": None} | {c: details[:, i] for i, c in enumerate(DETAILS)})
        blocks = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        none = pd.array([None] * len(used), "Int64")
        yield pd.DataFrame({"doc_id": none, "key": none, "pick": none, "node": none, "long": None, "block": used,
                            "counts": [blocks[i].tobytes() for i in used]} | {c: none for c in DETAILS})

    return run


def _total(group: pd.DataFrame) -> pd.DataFrame:
    """The sum of a block of counters over all tasks."""
    sums = np.zeros(BLOCK, np.int64)
    for counts in group["counts"]:
        sums += np.frombuffer(counts, np.int32)
    return pd.DataFrame({"block": group["block"].iloc[:1], "counts": [sums.tobytes()]})


def levels_of(sketch: DataFrame) -> np.ndarray:
    """Levels of tokens by counter: 0 for usual ones, then by the logarithm of how frequent they
    are. ``SKETCH`` counters reach the driver."""
    df = np.zeros(SKETCH, np.int64)
    for r in sketch.groupBy("block").applyInPandas(_total, "block int, counts binary").toLocalIterator():
        df[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.counts, np.int64)
    mean = df.sum() / SKETCH
    levels = np.zeros(SKETCH, np.uint8)
    frequent = df > mean + 6 * mean ** 0.5 + 2
    levels[frequent] = np.ceil(np.log2(df[frequent] - mean) * 4).clip(1, 255).astype(np.uint8)
    return levels


def _postings(size: int, percent: int, levels: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            tokens, nodes = [], []
            for text in batch["text"]:
                found = shingles(text, size, hashes)
                if not len(found) or (node := node_of(found)) in seen:
                    continue
                seen.add(node)
                first = prefix(found, levels, 0, percent)
                tokens.append(first.view(np.int64))
                nodes.append(np.full(len(first), node))
                if len(seen) > 1_000_000:
                    seen.clear()
            if tokens:
                yield pd.DataFrame({"token": np.concatenate(tokens), "node": np.concatenate(nodes)})

    return run


def _sets(size: int, wanted: np.ndarray):
    """The sets of the rows whose ``pick`` falls on a wanted counter; few others pass."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            batch = batch[wanted[(batch["pick"] % SKETCH).to_numpy()]]
            found = [shingles(text, size, hashes).tobytes() for text in batch["text"]]
            yield pd.DataFrame({"pick": batch["pick"], "tokens": found})

    return run


def _likely(percent: int):
    """Whether the long sketches of a pair allow the similarity; this never excludes a link."""
    def likely(n: int, x: bytes, m: int, y: bytes) -> bool:
        return parities_differ(x, y) * (100 + percent) <= (n + m) * (100 - percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [likely(*pair) for pair in zip(batch["n"], batch["x"], batch["m"], batch["y"])]
            yield batch[["a", "b"]].assign(likely=np.array(found, bool))

    return run


def _verify(percent: int, levels: np.ndarray):
    def similar(x: np.ndarray, y: np.ndarray) -> bool:
        for order in range(1, ORDERS):
            if not len(np.intersect1d(prefix(x, levels, order, percent), prefix(y, levels, order, percent), True)):
                return False
        both = len(np.intersect1d(x, y, True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                      for x, y in zip(batch["x"], batch["y"])]
            yield batch[["a", "b"]].assign(linked=linked)

    return run


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
         percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, the smallest id that links
    of Jaccard similarity ``percent``/100 or more reach.

    Documents of equal sets are one node. The first global order puts shingles of rare sketch
    counters first, so passages that many documents share stay out of prefixes; the other orders
    are hashes of the token. Candidates share a prefix token under every one of the ``ORDERS``
    orders: under the first by an inverted list, under the others by bit signatures of the
    prefixes that each member of a list carries, so that a pair whose signatures share no bit is
    not emitted. Sizes and parity sketches exclude pairs in the same way. What is left is
    verified, exactly, on prefixes and whole sets.

    No list emits all its pairs: in one of up to ``SHORT`` nodes each is compared with those before
    it, and in star rounds every member of a longer one is compared with one
    leader of the list in another component, and components are joined. The first leader of a
    list is the node that shares most prefix tokens with others, such as the text from which
    copies were made. In the last step the members outside a list's largest component meet the
    members of other components, so no link that could join two components is lost, whatever
    the size of a list.

    Words are lower-cased in A-Z only; a document with fewer words than ``size`` has its
    whole sequence as one shingle; one without words, or null, is linked with nothing. Rows of
    no id are linked like others, but give no component id. Repeated rows are equal sets; other
    columns are not read; an empty table gives no rows. Sets are compared by 64-bit hashes.
    """
    placed = linked(docs, doc_id, text, size, percent)
    least = placed.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return (placed.join(least, "root", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")))


def linked(docs: DataFrame, doc_id: str, text: str, size: int, percent: int, key: str | None = None) -> DataFrame:
    """One row per document: doc_id, key (the column of that name), pick (a hash of id and text),
    n and root, which the documents of a component share. See ``join``."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       (F.col(key) if key else F.lit(None)).cast("long").alias("key"))
    keyed = slim.withColumn("pick", F.xxhash64("doc_id", F.xxhash64("text")))
    both = stage(keyed.mapInPandas(_nodes(size, percent), NODE), "nodes")
    nodes = both.where("block IS NULL").drop("block", "counts")
    levels = levels_of(both.where("block IS NOT NULL").select("block", "counts"))

    # lists of at least two nodes; those of the same nodes are one list of that weight, since they give the
    # same pairs: copies share most tokens of their prefixes
    postings = slim.select("text").mapInPandas(_postings(size, percent, levels), "token long, node long")
    whole_list, by_node = Window.partitionBy("token"), Window.partitionBy("token").orderBy("node")
    lists = (postings.select("token", "node", F.min("node").over(whole_list).alias("lo"),
                             F.max("node").over(whole_list).alias("hi"), F.lag("node").over(by_node).alias("before"))
             .where("lo <> hi AND (before IS NULL OR before <> node)")
             .select("node", F.count(F.lit(1)).over(whole_list).alias("c"), F.bit_xor(F.xxhash64("node")).over(whole_list).alias("h1"),
                     F.bit_xor(F.xxhash64(F.lit(1), "node")).over(whole_list).alias("h2")))
    lists = (lists.select("node", "c", F.xxhash64("h1", "h2", "c").alias("token")).repartition("node")
             .groupBy("node", "token", "c").agg(F.count(F.lit(1)).alias("same")))

    # one document for each node
    picked = nodes.groupBy("node").agg(F.min("pick").alias("pick"), *[F.min(c).alias(c) for c in DETAILS])
    lists = stage(lists.join(picked.drop("pick"), "node").select(
        "token", "node", "c", F.sum(F.col("c") * F.col("same")).over(Window.partitionBy("node")).alias("hub"), *DETAILS), "listed")

    def named(pairs: DataFrame) -> DataFrame:
        """The nodes of the pairs and their documents."""
        ends = pairs.select(F.col("a").alias("node")).distinct().unionByName(pairs.select(F.col("b").alias("node")).distinct())
        return ends.distinct().join(picked.select("node", "pick"), "node")

    def verified(pairs: DataFrame) -> DataFrame:
        """Tested pairs. Long sketches first exclude pairs of large sets. Texts of the pairs' documents are read again: a bitmap of SKETCH counters
        leaves out most others where they lie, and only sets of a pair's document are moved."""
        pairs = stage(pairs, "pairs")
        long = stage(named(pairs).join(nodes.where("long IS NOT NULL").select("pick", "n", "long"), "pick")
                     .select("node", "n", "long").dropDuplicates(["node"]), "long")
        ends = (pairs.join(long.select(F.col("node").alias("a"), "n", F.col("long").alias("x")), "a", "left")
                .join(long.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("long").alias("y")), "b", "left"))
        rated = (ends.where("x IS NOT NULL AND y IS NOT NULL").select("a", "b", "n", "x", "m", "y")
                 .mapInPandas(_likely(percent), "a long, b long, likely boolean"))
        short = ends.where("x IS NULL OR y IS NULL").select("a", "b", F.lit(True).alias("likely"))
        rated = stage(rated.unionByName(short), "rated")
        open_pairs = rated.where("likely").select("a", "b")
        needed = named(open_pairs)
        used = needed.select(F.pmod("pick", F.lit(SKETCH)).alias("w")).distinct().toPandas()["w"]
        wanted = np.zeros(SKETCH, bool)
        wanted[used.to_numpy(np.int64)] = True
        sets = (keyed.select("pick", "text").mapInPandas(_sets(size, wanted), "pick long, tokens binary")
                .join(needed, "pick").select("node", "tokens").dropDuplicates(["node"]))
        sets = stage(sets, "sets")
        sides = (open_pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
                 .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b"))
        found = sides.select("a", "b", "x", "y").mapInPandas(_verify(percent, levels), "a long, b long, linked boolean")
        excluded = rated.where("NOT likely").select("a", "b", F.lit(False).alias("linked"))
        found = stage(found.unionByName(excluded), "tested")
        unstage(pairs, long, rated, sets)
        return found

    def may_link(other):
        """Sizes, prefixes and parity sketches allow the similarity; this never excludes a link."""
        of = (lambda c: F.col(f"{other}.{c}")) if isinstance(other, str) else lambda c: other[c]
        n, m = F.col("n"), of("n")
        differ = sum((F.bit_count(F.col(p).bitwiseXOR(of(p))) for p in PARITY), F.lit(0))
        shared = F.lit(True)
        for order in range(1, ORDERS):
            meet = [F.col(f"s{order}_{i}").bitwiseAND(of(f"s{order}_{i}")) != 0 for i in range(SHARE_WORDS)]
            shared = shared & reduce(lambda x, y: x | y, meet)
        return ((100 * F.least(n, m) >= percent * F.greatest(n, m)) & shared
                & (differ * (100 + percent) <= (n + m) * (100 - percent)))

    def tidy(pairs: DataFrame, other: str) -> DataFrame:
        """Distinct pairs a < b that were not tested yet."""
        ends = [F.col("node"), F.col(f"{other}.node")]
        pairs = pairs.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
        return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")

    whole = F.struct("node", "root", *DETAILS)
    tested, roots, todo = None, None, None
    spent = [lists]
    listed = lists.where(F.col("c") > SHORT).count()
    for turn in range(STAR_ROUNDS + 1):
        placed = lists.withColumn("root", F.col("node")) if roots is None else \
            lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if turn:
            per = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"))
            lot = per.groupBy("token").agg(F.sum("c").alias("all"), F.max("c").alias("most"), F.max_by("root", "c").alias("big"))
            lot = lot.where(F.col("all") > F.col("most"))  # the others lie in one component and are done
            placed = stage(placed.join(lot, "token"), "open")
            spent.append(placed)
            last, todo = todo, placed.agg(F.sum(F.when(F.col("root") != F.col("big"), F.col("all")))).first()[0] or 0
            if todo <= FEW_PAIRS * listed or turn == STAR_ROUNDS or (last and todo > 0.8 * last):
                break
        # first the member that shares most, then others at random; outside the largest component in odd turns
        outer = [(F.col("root") != F.col("big")).desc()] if turn % 2 else []
        rank = Window.partitionBy("token").orderBy(*outer, F.xxhash64("node", F.lit(turn)) if turn > 1 else F.col("hub").desc(), "node")
        led = placed.withColumn("l", F.first(whole).over(rank))
        if not turn:
            before = Window.partitionBy("token").orderBy(F.col("hub").desc(), "node").rowsBetween(1 - SHORT, -1)
            led = led.withColumn("met", F.collect_list(whole).over(before))
            led = led.withColumn("met", F.when(F.col("c") <= SHORT, F.col("met")).otherwise(F.array("l")))
            led = led.withColumn("l", F.explode(F.filter("met", lambda e: (e["node"] != F.col("node")) & may_link(e))))
            lists = lists.where(F.col("c") > SHORT)
        found = verified(tidy(led.where("root <> l.root").where(may_link("l")), "l"))
        tested = found if tested is None else tested.unionByName(found)
        roots = components(tested.where("linked"))
    if todo:
        # members outside the largest component of a list meet all members of other components
        outside = placed.where("root <> big").alias("o")
        every = placed.select("token", whole.alias("e"))
        rest = tidy(outside.join(every, "token").where("root <> e.root AND (e.root = big OR node < e.node)")
                    .where(may_link("e")), "e")
        tested = tested.unionByName(verified(rest))
        roots = components(tested.where("linked"))
    unstage(*spent)

    found = stage(nodes.select("doc_id", "key", "pick", "n", "node").join(roots, "node", "left")
                  .select("doc_id", "key", "pick", "n", F.coalesce("root", "node").alias("root")), "linked")
    unstage(both)
    return found


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                       percent: int = 80) -> DataFrame:
    """Exactly one row of each component: that of the smallest id, rows without an id last, then
    by hashes of the text and of the whole row; of rows equal in all columns one stays. Rows
    without words are in no component and all stay. Rows are found again by 128 bits of their
    content, so the table is not written with a key. Columns stay as they are."""
    name = fresh_name(docs, "_content")
    found = linked(docs.withColumn(name, content_hash(docs)), doc_id, text, size, percent, name)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pick", "key")
    first = found.where("n > 0").groupBy("root").agg(F.min(order).alias("first"))
    stays = (F.col("pick") == F.col("first.pick")) & (F.col("key") == F.col("first.key"))
    marked = found.where("n > 0").join(first, "root").groupBy("pick", "key", stays.alias("stays")).agg(F.count(F.lit(1)).alias("c"))
    marked = stage(marked.where("NOT stays OR c > 1"), "marked")
    unstage(found)

    keys = [F.xxhash64(doc_id, F.xxhash64(text)), content_hash(docs)]
    kept = without(docs, marked.where("NOT stays").select("pick", "key"), *keys)
    repeated = marked.where("stays").select("pick", "key")
    if repeated.isEmpty():
        return kept
    names = [fresh_name(docs, "_pick"), fresh_name(docs, "_content")]
    again = kept.withColumns(dict(zip(names, keys))).join(repeated.toDF(*names), names, "left_semi").dropDuplicates(names)
    return without(kept, repeated, *keys).unionByName(again.drop(*names))


def op8_ngram_jaccard(spark, sf_dir):
    return join(documents(spark, sf_dir))
