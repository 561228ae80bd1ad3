"""N-gram Jaccard self-join by prefix filters under several global token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, fresh, mix, sets, shingles, slices, table, tidied, written
from .graph import components

#: Global token orders: all sort by a token's document frequency first (rare ones first), each breaks ties by a hash of its own.
ORDERS = 3
#: 64-bit words of a set's parity bitmap. Each bit in which two bitmaps differ is the place of a token that only one set has.
WORDS = 8
#: Bytes of text of a chunk: a task holds one chunk's tokens at a time.
CHUNK_BYTES = 6 << 20
#: Bits of a token that its frequency is counted by: tokens alike in them count as one, which every order may do.
COUNTED = 48
#: Rows of a block: all pairs of a component, or of a token's list, are compared block against block.
BLOCK = 256
#: Tokens of a frequency bucket.
BUCKET_TOKENS = 1 << 21
_U = np.uint64
_SALT = [_U(0), _U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25), _U(0x8CB92BA72F3D8DD7)]


def _column(b: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    c = b.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def token_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes of each text, ascending, and where each text's begin."""
    hs, begins, at = [], [np.zeros(1, np.int64)], 0
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    for b in slices(batch):
        w = Words(b.column(0))
        h, begin = sets(*shingles(w.hash, w.first, k), b.num_rows)
        hs.append(h)
        begins.append(begin[1:] + at)
        at += len(h)
    return (np.concatenate(hs) if hs else np.zeros(0, np.uint64)), np.concatenate(begins)


def set_keys(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """64 bits of each set: a mixed sum of its hashes and its size."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h ^ _U(0x2545F4914F6CDD1D)), out=total[1:])
    size = np.diff(begin).astype(np.uint64)
    return mix(total[begin[1:]] - total[begin[:-1]] + size * _U(0x9E3779B97F4A7C15))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Of two sets with 100 * intersection >= percent * union, the first n - ceil(percent * n / 100) + 1 tokens of either,
    under any one order of all tokens, share a token."""
    return n - (percent * n + 99) // 100 + 1


def parities(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each set WORDS numbers, whose bits tell whether an odd number of its tokens falls on their place."""
    bits, rows = 64 * WORDS, len(begin) - 1
    out = np.zeros((rows, WORDS), np.int64)
    place = (mix(h ^ _SALT[3]) % _U(bits)).astype(np.int64)
    for a in range(0, rows, 4096):
        z = min(a + 4096, rows)
        row = np.repeat(np.arange(z - a), np.diff(begin[a : z + 1]))
        odd = np.bincount(row * bits + place[begin[a] : begin[z]], minlength=(z - a) * bits) & 1
        out[a:z] = np.packbits(odd.astype(np.uint8).reshape(z - a, bits), axis=1).view(np.int64)
    return out


def distinct_texts(docs: DataFrame, text: str, k: int, key: str = "key") -> DataFrame:
    """docs plus n_shingles and a key that is equal for equal sets, null for none. A map."""
    kept = docs.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"n_shingles bigint, `{key}` bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text):
                h, begin = token_sets(b.column(text), k)
                n = np.diff(begin)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64()), pa.array(set_keys(h, begin).view(np.int64), mask=n == 0)], names=[*kept, "n_shingles", key])

    return docs.mapInArrow(tidied(run), schema)


def _pack(x: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences, low bytes apart from high ones, compressed."""
    d = np.diff(x, prepend=_U(0))
    return zstandard.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zstandard.decompress(b), np.uint8).reshape(8, -1).T).reshape(-1).view(np.uint64), dtype=np.uint64)


def _chunk_tokens(texts: pa.Array, k: int, bits: int):
    """Sets, and the chunk's distinct tokens by their first COUNTED bits, how many sets have each, and where buckets begin."""
    h, begin = token_sets(texts, k)
    keys = set_keys(h, begin)
    _, one = np.unique(keys, return_index=True)
    n = np.diff(begin)
    keep = np.zeros(len(n), bool)
    keep[one] = True
    keep &= n > 0  # equal sets of a chunk count once
    h = h[np.repeat(keep, n)]
    n, keys = n[keep], keys[keep]
    begin = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    every, where, count = np.unique(h >> _U(64 - COUNTED), return_inverse=True, return_counts=True)
    cuts = np.searchsorted(every >> _U(COUNTED - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    return h, begin, keys, every, where, count, cuts


def candidates(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """A row for each distinct set that may have a partner: key, n, alone (how many of its tokens no other set has),
    members (its packed tokens), s0.. (its parity bitmap), p0.. (its prefix tokens under each order, of those that another set has too).

    One exact document frequency for each token (of COUNTED bits) decides the orders. Chunks of documents send their distinct
    tokens, packed and cut by range, to buckets; a bucket counts its tokens over all chunks and answers every chunk with a
    byte for each of its tokens (the class of its frequency, 0 for one alone); a chunk then knows the place of its tokens in
    each order. So tokens cross once, in about 4 bytes, answers in a few bits, texts once by chunk; no table is broadcast."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
    chunks = max(1, -(-size[0] // CHUNK_BYTES), -(-size[1] // 40_000))
    bits = min(24, max(0, int(np.ceil(np.log2(max(1, size[0] / 6 / BUCKET_TOKENS))))))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # copies collapse before the shuffle, so that a text that many documents have is not one chunk's burden
        seen: set[int] = set()
        for b in batches:
            keep = []
            for x in b.column("x").to_pylist():
                keep.append(x not in seen)
                if len(seen) < 2_000_000:
                    seen.add(x)
            yield b.filter(pa.array(keep, pa.bool_()))

    d = docs.select(F.pmod(F.xxhash64(text, F.lit(17)), F.lit(chunks)).cast("int").alias("chunk"), F.xxhash64(text).alias("x"), F.col(text).alias("text")).where("text is not null")
    d = d.mapInArrow(tidied(once), "chunk int, x bigint, text string").select("chunk", "text")

    def send(key, t):
        _, _, _, every, _, count, cuts = _chunk_tokens(_column(t, "text"), k, bits)
        at = [i for i in range(1 << bits) if cuts[i + 1] > cuts[i]]
        counts = np.minimum(count, 2**31 - 1).astype(np.uint32)
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(at), pa.int32()), "bucket": pa.array(at, pa.int32()), "packed": pa.array([_pack(every[cuts[i] : cuts[i + 1]]) for i in at], pa.binary()), "counts": pa.array([zstandard.compress(counts[cuts[i] : cuts[i + 1]].tobytes(), 1) for i in at], pa.binary())})

    def tally(t):
        lists = [_unpack(x) for x in t.column("packed").to_pylist()]
        counts = np.concatenate([np.frombuffer(zstandard.decompress(x), np.uint32) for x in t.column("counts").to_pylist()])
        every, where = np.unique(np.concatenate(lists), return_inverse=True)
        df = np.bincount(where, weights=counts)
        # class 0: in one set alone; then eight steps for each doubling
        cls = np.where(df > 1, np.minimum(1 + np.floor(np.log2(df) * 8), 255), 0).astype(np.uint8)[where]
        cuts = np.cumsum([0, *map(len, lists)])
        return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"), "classes": pa.array([zstandard.compress(cls[a:b].tobytes(), 1) for a, b in zip(cuts, cuts[1:])], pa.binary())})

    def place(key, t, answers):
        h, begin, keys, every, where, _, cuts = _chunk_tokens(_column(t, "text"), k, bits)
        cls = np.zeros(len(every), np.uint8)
        for bucket, c in zip(answers.column("bucket").to_pylist(), answers.column("classes").to_pylist()):
            cls[cuts[bucket] : cuts[bucket + 1]] = np.frombuffer(zstandard.decompress(c), np.uint8)
        return _prefixes(h, begin, keys, cls[where], percent)

    schema = "key bigint, n bigint, alone bigint, members binary, " + ", ".join([f"s{w} bigint" for w in range(WORDS)] + [f"p{o} array<bigint>" for o in range(ORDERS)])
    dealt = d.groupBy("chunk")
    answers = dealt.applyInArrow(send, "chunk int, bucket int, packed binary, counts binary").groupBy("bucket").applyInArrow(tally, "chunk int, bucket int, classes binary")
    return dealt.cogroup(answers.groupBy("chunk")).applyInArrow(place, schema).dropDuplicates(["key"])


def _prefixes(h: np.ndarray, begin: np.ndarray, keys: np.ndarray, cls: np.ndarray, percent: int) -> pa.Table:
    n = np.diff(begin)
    row = np.repeat(np.arange(len(n)), n)
    alone = np.bincount(row[cls == 0], minlength=len(n)) if len(n) else n
    keep_of = prefix_length(n, percent)
    # the tokens of class 0 come first in every order and lead to nobody: what is left of the prefix is for the others
    room = np.maximum(keep_of - alone, 0)
    may = (room > 0) & (100 * (n - alone) >= percent * n)
    take = (cls > 0) & may[row]
    h2, row2, cls2 = h[take], row[take], cls[take]
    first = np.searchsorted(row2, np.arange(len(n) + 1))
    m = np.diff(first)
    lists = []
    for o in range(ORDERS):
        order = np.lexsort((mix(h2 ^ _SALT[o]) if o else h2, cls2, row2))
        rank = np.arange(len(h2)) - np.repeat(first[:-1], m)
        keep = rank < np.repeat(room, m)
        got = h2[order][keep]
        lists.append((got.view(np.int64), np.searchsorted(row2[order][keep], np.arange(len(n) + 1))))
    at = np.flatnonzero(may & (m > 0))
    out = {"key": pa.array(keys[at].view(np.int64)), "n": pa.array(n[at], pa.int64()), "alone": pa.array(alone[at], pa.int64()), "members": pa.array([h[begin[i] : begin[i + 1]].tobytes() for i in at], pa.binary())}
    bitmap = parities(h, begin)[at]
    out |= {f"s{w}": pa.array(bitmap[:, w]) for w in range(WORDS)}
    for o, (got, cut) in enumerate(lists):
        out[f"p{o}"] = pa.array([got[cut[i] : cut[i + 1]] for i in at], pa.list_(pa.int64()))
    return pa.table(out)


def _may(percent: int, a: str, b: str) -> str:
    """SQL: what a and b can share at most (tokens that are not one set's alone) may be enough for a link."""
    most = f"least({a}.n - {a}.alone, {b}.n - {b}.alone)"
    return f"100 * {most} >= {percent} * ({a}.n + {b}.n - {most})"


def _near(percent: int, a: str, b: str) -> str:
    """SQL: the bitmaps of a and b differ in no more places than a link's sets may differ in tokens, which is at most
    (100 - percent) / (100 + percent) of the sum of their sizes. Every link passes."""
    apart = " + ".join(f"bit_count({a}.s{w} ^ {b}.s{w})" for w in range(WORDS))
    return f"{100 + percent} * ({apart}) <= {100 - percent} * ({a}.n + {b}.n)"


def _verify(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys that truly link. Pairs must share a prefix token under every other order too before their
    sets are compared."""
    more = [f"p{o}" for o in range(1, ORDERS)]
    both = pairs
    for side in "ab":
        both = both.join(found.select(F.col("key").alias(side), *[F.col(p).alias(f"{p}_{side}") for p in more]), side)
    for p in more:
        both = both.where(F.arrays_overlap(f"{p}_a", f"{p}_b"))
    both = both.select("a", "b")
    for side in "ab":
        both = both.join(found.select(F.col("key").alias(side), F.col("members").alias(f"members_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("members_a").to_pylist(), b.column("members_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * inter >= percent * (len(x) + len(y) - inter))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "members_a", "members_b").mapInArrow(tidied(run), "a bigint, b bigint")


#: SQL: rows of one pair of blocks, and not both of the same block of two.
MEET = "x.lo_ = y.lo_ and x.hi_ = y.hi_ and (x.lo_ = x.hi_ or x.block_ <> y.block_)"


def blocked(lists: DataFrame, size: str) -> DataFrame:
    """Rows of (key, `size` of the list that the row is in) for a self-join by pairs of blocks (lo_, hi_): a list of more than
    about BLOCK rows is cut into blocks by a hash of key, and each row goes to every pair of its block with another, so that
    no long list is one task's. Any two rows of a list meet in one pair of blocks alone (MEET)."""
    blocks = F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")
    cut = lists.withColumn("n_", blocks).withColumn("block_", F.pmod(F.xxhash64("key", F.lit(43)), F.col("n_")).cast("int"))
    cut = cut.withColumn("other_", F.explode(F.sequence(F.lit(0), F.col("n_") - 1)))
    return cut.withColumn("lo_", F.least("block_", "other_")).withColumn("hi_", F.greatest("block_", "other_")).drop("n_", "other_", size)


def links(found: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between distinct sets whose components are those of all links.

    First, in the list of each prefix token, every set is compared with the set before it and with the list's first one, the
    one with the fewest tokens of its own: two pairs a member instead of all pairs, which joins most groups. Then only sets
    of different components that share a prefix token and may link are paired: members of a group are never paired with
    each other, and no pair of different groups is left out."""
    lists = written(found.select(F.explode("p0").alias("token"), "alone", "n", "key"))
    shared = lists.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    lists = written(lists.join(shared, "token", "left_semi"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = last = None  # (token, n, key, alone) of the list's first row, and of the row before
        for b in batches:
            ab = []
            for row in zip(*(b.column(c).to_pylist() for c in ("token", "n", "key", "alone", "step"))):
                if hub is None or (hub[0], hub[4]) != (row[0], row[4]):
                    hub = last = row
                    continue
                for other in {hub, last}:
                    most = min(row[1] - row[3], other[1] - other[3])
                    if 100 * most >= percent * (row[1] + other[1] - most) and row[2] != other[2]:
                        ab.append((min(row[2], other[2]), max(row[2], other[2])))
                last = row
            ab = sorted(set(ab))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in ab], pa.int64()), pa.array([y for _, y in ab], pa.int64())], names=["a", "b"])

    spread = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a frequent token's list is cut by size class, so that no task gets it whole
    cut = lists.withColumn("step", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))))
    chained = cut.repartition(spread, "token", "step").sortWithinPartitions("token", "step", "alone", "n", "key").mapInArrow(tidied(chain), "a bigint, b bigint").distinct()
    first = written(_verify(chained, found, percent))
    label = components(first)
    marked = written(lists.join(label, lists["key"] == label["node"], "left").select("token", "n", "alone", "key", F.coalesce("component", "key").alias("c")))
    mixed = marked.groupBy("token").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("m")).where("c0 <> c1").select("token", "m")
    prefixes = [f"p{o}" for o in range(ORDERS)]
    left = blocked(marked.join(mixed, "token"), "m").join(found.select("key", *prefixes, *[f"s{w}" for w in range(WORDS)]), "key")
    # a pair comes from its first common token alone, and only if its bitmaps allow a link and it shares a prefix token under
    # the other orders as well
    same = [f"x.token = y.token and x.c < y.c and {MEET} and {_may(percent, 'x', 'y')}", _near(percent, "x", "y"), *[f"arrays_overlap(x.{p}, y.{p})" for p in prefixes[1:]], "x.token = element_at(array_intersect(x.p0, y.p0), 1)"]
    pairs = left.alias("x").join(left.alias("y"), F.expr(" and ".join(same)))
    pairs = pairs.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()
    # what first joined is joined already: its stars stand for it
    return label.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(_verify(pairs, found, percent))


def cluster(docs: DataFrame, text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs: documents link when 100 * intersection >= percent * union of
    their sets of distinct k-word shingles; component_id is the least doc_id reachable by links.

    Words are runs without space or 0x09-0x0D, A-Z lower-cased; a text of fewer than k words is one shingle; null, empty and
    wordless texts have none and link with nothing, not even each other. Equal sets are one node. Repeated rows stay, with
    equal results. A null doc_id is never a component's name unless all its members' are null. Other columns are ignored."""
    return _clustered(docs, text, k, percent)[0].drop("key")


def one_of_each(docs: DataFrame, text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component of cluster(): that of the least doc_id (null only if no member has one), among rows
    of that id that of the least key, and one row of these if several are alike in both. Rows without shingles link with
    nothing and stay, all of them. Columns stay as they are."""
    _, keyed, _, label = _clustered(docs, text, k, percent)
    named = keyed.where("key is not null").groupBy("key", "doc_id").agg(F.count("*").alias("n"))
    named = named.join(label, named["key"] == label["node"], "left").withColumn("c", F.coalesce("component", "key"))
    least = named.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null_"), F.col("doc_id").alias("id_"), F.col("key").alias("key_"), "n")).alias("r"))
    least = written(least.select("r.*"))
    name = fresh(docs, "key_", "n_shingles")[0]
    d = distinct_texts(docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]), f"c{docs.columns.index(text)}", k, name)
    at = f"c{docs.columns.index('doc_id')}"
    same = (d[name] == least["key_"]) & d[at].eqNullSafe(least["id_"])
    stay = d.where(F.col(name).isNotNull()).join(least.select("key_", "id_"), same, "left_semi")
    if not least.where("n > 1").isEmpty():
        stay = stay.dropDuplicates([name, at])
    out = stay.unionByName(d.where(F.col(name).isNull()))
    return out.select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def linked(docs: DataFrame, text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """cluster() and n_links: how many other rows of docs each row links with, copies (equal sets) among them. A row without
    shingles has 0."""
    out, keyed, found, label = _clustered(docs, text, k, percent)
    copies = keyed.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"))
    links_of = counts(found.select("key", "members").join(label.withColumnRenamed("node", "key"), "key").join(copies, "key"), percent)
    per = written(copies.join(links_of, "key", "left").select(F.col("key").alias("key_"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return out.join(per, out["key"] == per["key_"], "left").select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def counts(sets_: DataFrame, percent: int) -> DataFrame:
    """(key, links) of (key, members, component, copies): the copies of the other sets that each set links with, all pairs of
    a component compared exactly. Components are cut into blocks of about BLOCK sets, and a task compares two blocks, so no
    group is one task's burden and no row is made for a pair."""
    size = sets_.groupBy("component").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = sets_.join(size, "component").withColumn("block", F.pmod(F.xxhash64("key", F.lit(41)), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "key", "copies", "members")

    def compare(rows: list[tuple]) -> np.ndarray:
        lists = [np.frombuffer(r[6], np.uint64) for r in rows]
        n = np.array([len(x) for x in lists])
        every, where, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        place = (np.cumsum(times > 1) - 1)[where]
        row, shared = np.repeat(np.arange(len(rows)), n), times[where] > 1
        row, place = row[shared], place[shared]
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        inter, width = np.zeros((len(rows), len(rows)), np.int64), max(4096, (1 << 21) // len(rows))
        for at in range(0, int((times > 1).sum()), width):
            i, j = np.searchsorted(place, [at, at + width])
            m = np.zeros((len(rows), min(width, int(place[j - 1]) + 1 - at)), np.float32)
            m[row[i:j], place[i:j] - at] = 1
            inter += np.rint(m @ m.T).astype(np.int64)
        link = 100 * inter >= percent * (n[:, None] + n[None, :] - inter)
        np.fill_diagonal(link, False)
        if rows[0][1] != rows[0][2]:
            block = np.array([r[3] for r in rows])
            link &= block[:, None] != block[None, :]
        return link.astype(np.int64) @ np.array([r[5] for r in rows], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[4] for r in held], pa.int64()), pa.array(compare(held), pa.int64())], names=["key", "links"])

        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("component", "lo", "hi", "block", "key", "copies", "members"))):
                if held and held[0][:3] != r[:3]:
                    yield done()
                    held = []
                held.append(r)
        if held:
            yield done()

    spread = int(sets_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = dealt.repartition(spread, "component", "lo", "hi").sortWithinPartitions("component", "lo", "hi").mapInArrow(tidied(run), "key bigint, links bigint")
    return per.groupBy("key").agg(F.sum("links").alias("links"))


def _clustered(docs: DataFrame, text: str, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    keyed = written(distinct_texts(docs.select("doc_id", text), text, k).select("doc_id", "n_shingles", "key"))
    found = written(candidates(docs, text, k, percent))
    label = components(links(found, percent))
    nodes = keyed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(label, nodes["key"] == label["node"], "left").select("key", "least", F.coalesce("component", "key").alias("component"))
    nodes = written(nodes)
    named = nodes.join(nodes.groupBy("component").agg(F.min("least").alias("component_id")), "component").select(F.col("key").alias("key_"), "component_id")
    out = keyed.join(named, keyed["key"] == named["key_"], "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "key")
    return out, keyed, found, label


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: All pairs that share a shingle, counted; components by a recursive walk.
OP3_SQL = """
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as t from documents),
s as (select doc_id, case when len(t) = 0 then [] when len(t) < 4 then [array_to_string(t, ' ')] else list_distinct(list_transform(range(1, len(t) - 2), lambda i: array_to_string(t[i:i + 3], ' '))) end as s from w),
u as (select doc_id, len(s) as n, unnest(s) as x from s),
p as (select a.doc_id as a, b.doc_id as b from u a join u b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2 having 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
e as (select a, b from p union all select b, a from p),
r as (select doc_id as d, doc_id as c from documents union select e.b, r.c from r join e on r.d = e.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, (select min(c) from r where d = s.doc_id) as component_id, (select count(*) from e where e.a = s.doc_id) as n_links from s
"""
