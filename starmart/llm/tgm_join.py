"""Jaccard self-join of documents with a token-group matrix (operator 8).

A document is its set of 5-word shingles (its *tokens*). The join finds every link of
Jaccard >= 0.8 that is needed to connect what is connected:

1. **Sets.** One pass over the texts gives each document's set hash, its size, four
   min-hashes and its *prefix*: the n - ceil(0.8 n) + 1 first tokens in one global order,
   rare tokens first. (Two sets that link share a token of their prefixes.) A token's
   rarity is read from the exact corpus counts of its words: the rarest of its five
   words; words below a fixed share of the corpus count as rare. Equal sets become one
   class.
2. **Groups of similar documents.** Classes that share a min-hash are compared with one
   pivot of that bucket, linear in the bucket's size, and the links found are joined to
   components: the groups. A group of thousands of near copies is one group from here on.
3. **Token-group matrix.** Components are dealt to groups of about ``CHUNK`` members: a
   large one to groups of its own, small ones that share a prefix token with the same
   first component to common groups. A matrix row (token, group) says that a member has
   the token in its prefix, with the group's size range and first place of the token
   there. Tokens of one component only never enter it.
4. **Open qualifying groups.** A document asks a group if a shared token, by sizes and by
   what is left after the token's place, allows the overlap; of two components the smaller
   one asks. The group keeps its members' token union: a query opens it only if its
   overlap with the union reaches 80 % of the query; then intersections are counted
   exactly, and one link to each component in the group is kept.

No pair is left out: links inside a component cannot change the result, and of a link
between two the smaller one's document meets the other's group at their first common
token. Work and rows grow with documents and groups, a 64th of a family's members, not
with the square of a group of copies. Workers hold one group and one query at a time.

Defined results: a null, empty or blank text has an empty set and is its own component;
with fewer than five words the whole sequence is the one token; repeated rows and equal
sets share a component; a null id links like any other and is only left out of naming (a
component of null ids only has a null id). A long text is hashed whole, in a slice of its
own; an empty table gives an empty result. Other columns are not read, whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import textkit as K
from starmart.llm.components import components, stored

NUM, DEN = 80, 100             # link: DEN * intersection >= NUM * union
CHUNK = 64                     # members of a group
SLICE = 1000                   # queries of a group that one worker takes
BAND = 0.1                     # sizes of a group's sets lie within a factor e**BAND
HASHES = 4
WORDS = 1 << 22                # bound of the word counts sent to workers, 16 bytes each
BLOOM_BITS = 1 << 27           # bound of the filters of wanted documents and tokens (16 MB)
_U = np.uint64


def prefix_size(n):
    """Tokens of a set of n of which two linked sets share one at least."""
    return n - -(-NUM * n // DEN) + 1


def ordered_sets(texts, table: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Per text its sorted distinct tokens. A token's top six bits are its commonness
    (twice the log2 of its rarest word's count), the rest its hash, so that sorting puts
    rare tokens first alike in every document."""
    words, first = K.word_hashes(texts)
    at, known = K.in_sorted(table, words)
    c = np.where(known, counts[at], 0) if len(table) else np.zeros(len(words), np.int64)
    level = np.minimum(63, (2 * np.log2(c + 1.0)).astype(np.int64)).astype(np.uint64)
    grams = K.gram_hashes(words, 5)
    if len(grams):
        least = level[:len(grams)].copy()
        for k in range(1, 5):
            np.minimum(least, level[k:k + len(grams)], out=least)
        grams = (least << _U(58)) | (grams >> _U(6))
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= 5:
            out.append(np.unique(grams[a:z - 4]))
        elif z > a:
            out.append((level[a:z].min() << _U(58)) | (K.gram_hashes(words[a:z], z - a) >> _U(6)))
        else:
            out.append(words[:0])
    return out


def set_hash(s: np.ndarray) -> int:
    h = K.mix(np.array([K.mix(s).sum(dtype=np.uint64)], np.uint64) + _U(len(s)))
    return int(h.view(np.int64)[0])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offs = pa.array(np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32))
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(offs, pa.array(flat))


def signature_batches(batches, shared):
    """Worker: (doc_id, text, text_key) to set size, set hash, min-hashes and prefix."""
    table, counts = shared.value
    for b in batches:
        texts = b.column("text")
        for lo, hi in K.slices(texts):
            sets = ordered_sets(texts.slice(lo, hi - lo), table, counts)
            low = [np.array([K.mix(s ^ K.MULT[k]).min() for k in range(HASHES)] if len(s) else [0] * HASHES, np.uint64) for s in sets]
            yield pa.record_batch(
                [b.column("doc_id").slice(lo, hi - lo), b.column("text_key").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()), _lists(low),
                 _lists([s[:prefix_size(len(s))] if len(s) else s for s in sets])],
                names=["doc_id", "text_key", "n_shingles", "cls", "low", "prefix"])


class IdFilter:
    """Bloom filter of wanted ids or tokens; false positives are removed by a join."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def has(self, ids: np.ndarray) -> np.ndarray:
        h = K.mix(ids.view(np.uint64))
        out = np.ones(len(ids), bool)
        for k in range(4):
            at = (h >> _U(16 * k)) * K.MULT[60 + k % 3] >> _U(64 - (self.bits.bit_length() - 1))
            out &= (self.words[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) == 1
        return out


def id_bit_batches(batches, bits: int):
    """Worker: (id) to the filter's words this task sets."""
    f = IdFilter(np.zeros(bits // 64, np.uint64), bits)
    for b in batches:
        h = K.mix(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        for k in range(4):
            at = (h >> _U(16 * k)) * K.MULT[60 + k % 3] >> _U(64 - (bits.bit_length() - 1))
            np.bitwise_or.at(f.words, (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
    some = np.flatnonzero(f.words)
    for lo in range(0, len(some), 100_000):
        yield pa.record_batch([pa.array(some[lo:lo + 100_000]), pa.array(f.words[some[lo:lo + 100_000]].view(np.int64))], names=["i", "w"])


def id_filter(ids: DataFrame) -> IdFilter:
    """Filter of a one-column frame of ids, at most ``BLOOM_BITS`` bits: past that it only
    lets more unwanted rows through to the join."""
    n = ids.count()
    bits = min(BLOOM_BITS, 1 << max(12, (16 * max(1, n) - 1).bit_length()))
    t = (K.arrow_map(ids, "starmart.llm.tgm_join:id_bit_batches", "i long, w long", bits)
         .groupBy("i").agg(F.bit_or("w").alias("w")).toArrow())
    words = np.zeros(bits // 64, np.uint64)
    if len(t):
        words[t.column("i").to_numpy()] = t.column("w").to_numpy().view(np.uint64)
    return IdFilter(words, bits)


def wanted_sets(batches, shared, wanted):
    """Sets of wanted documents, a slice at a time: by id, or by class if the id is null
    and some wanted class has null ids only."""
    table, counts = shared.value
    f, classes = wanted.value
    for b in batches:
        ids = b.column("doc_id")
        null = ids.is_null().to_numpy(zero_copy_only=False)
        by_id = f.has(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) & ~null
        use = np.flatnonzero(by_id | null if classes else by_id)
        texts = b.column("text").take(pa.array(use))
        for lo, hi in K.slices(texts):
            sets = ordered_sets(texts.slice(lo, hi - lo), table, counts)
            yield [s for s, no_id in zip(sets, null[use[lo:hi]].tolist())
                   if len(s) and (not no_id or classes.has(np.array([set_hash(s)], np.int64))[0])]


def set_batches(batches, shared, wanted):
    """Worker: (cls, tokens) of wanted documents only."""
    for sets in wanted_sets(batches, shared, wanted):
        yield pa.record_batch([pa.array([set_hash(s) for s in sets], pa.int64()), _lists(sets)], names=["cls", "tokens"])


def bit_batches(batches, shared, wanted):
    """Worker: (cls, bits) of wanted documents only."""
    for sets in wanted_sets(batches, shared, wanted):
        yield pa.record_batch([pa.array([set_hash(s) for s in sets], pa.int64()),
                               pa.array([parity_bits(s).tobytes() for s in sets], pa.binary())], names=["cls", "bits"])


def parity_bits(s: np.ndarray) -> np.ndarray:
    """Bitmap of about four bits a token (a power of two): each bit is the parity of the
    tokens hashed to it. Two sets' bitmaps differ in at most as many bits as the sets
    differ in tokens, which bounds their overlap from above."""
    size = max(64, 4 << (len(s) - 1).bit_length())
    n = np.bincount((s & _U(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((n & 1).astype(bool))


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) as bitmaps of ``size`` bytes. Bit i of the small one is the
    parity of the bits i, i+size, ... of the large one."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def allow_batches(batches):
    """Worker over partitions sorted by (part, kind): members (kind 0) and queries (kind 1)
    as bitmaps. Returns (gid, kind, cls) of the queries whose bitmaps allow a link with a
    member and of the members that some query may link with, not their pairs."""
    part, gid, members, out, met = None, None, [], [], None
    stack: dict = {}

    def close():
        if met is not None:
            out.extend((gid, 0, members[k][0]) for k in np.flatnonzero(met).tolist())

    def flush():
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64()))], names=["gid", "kind", "cls"])

    for b in batches:
        for p, g, kind, c, grp, n, bits in zip(*(b.column(x).to_pylist() for x in ("part", "gid", "kind", "cls", "grp", "n", "bits"))):
            if p != part:
                close()
                part, gid, members, stack, met = p, g, [], {}, None
            row = np.frombuffer(bits, np.uint8)[None, :]
            if kind == 0:
                members.append((c, grp, n, row))
                continue
            if not members:
                continue
            if met is None:
                met = np.zeros(len(members), bool)
                stack = {"least": min(m[3].shape[1] for m in members), "n": np.array([m[2] for m in members]),
                         "grp": np.array([m[1] for m in members])}
            size = min(row.shape[1], stack["least"])
            if size not in stack:
                stack[size] = np.concatenate([folded(m[3], size) for m in members])
            differ = np.bitwise_count(stack[size] ^ folded(row, size)).sum(1, dtype=np.int64)
            both = (n + stack["n"] - differ) // 2          # no fewer than the overlap
            ok = (DEN * both >= NUM * (n + stack["n"] - both)) & (stack["grp"] != grp)
            if ok.any():
                met |= ok
                out.append((gid, 1, c))
        if len(out) > 100_000:
            yield flush()
            out.clear()
    close()
    if out:
        yield flush()


def open_batches(batches):
    """Worker over partitions sorted by (part, kind): members (kind 0) of a slice of a group
    come first, then its queries (kind 1). Returns (a, b) links of queries to members: those
    that connect two components (``grp``) which the slice's earlier links do not, so never
    more than its members and queries."""
    part, names, owners, sets, union = None, [], [], [], None
    owner = tokens = sizes = None
    links: list[tuple[int, int]] = []
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for b in batches:
        flat = b.column("tokens")
        values, offs = flat.values.to_numpy().view(np.uint64), flat.offsets.to_numpy()
        for i, (p, kind, c, grp) in enumerate(zip(*(b.column(n).to_pylist() for n in ("part", "kind", "cls", "grp")))):
            s = values[offs[i]:offs[i + 1]]
            if p != part:
                part, names, owners, sets, union = p, [], [], [], None
                parent.clear()
            if kind == 0:
                names.append(c)
                owners.append(grp)
                sets.append(s.copy())
                union = None
                continue
            if not sets:
                continue
            if union is None:                  # the group's row of the matrix, and its members'
                tokens = np.concatenate(sets)
                order = np.argsort(tokens, kind="stable")
                tokens = tokens[order]
                owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]
                sizes = np.array([len(x) for x in sets])
                union = tokens[np.r_[True, tokens[1:] != tokens[:-1]]]
            hit = s[K.in_sorted(union, s)[1]]
            if DEN * len(hit) < NUM * len(s):  # |Q n union| bounds every member's overlap
                continue
            lo, hi = np.searchsorted(tokens, hit, "left"), np.searchsorted(tokens, hit, "right")
            n = hi - lo
            at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            for k in np.flatnonzero(DEN * both >= NUM * (len(s) + sizes - both)).tolist():
                x, y = root(grp), root(owners[k])
                if x != y:                     # else earlier links of the group connect them
                    parent[x] = y
                    links.append((c, names[k]))
        if len(links) > 100_000:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])
            links = []
    if links:
        yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])


def dealt(members: DataFrame, queries: DataFrame, payload: DataFrame, *columns: str) -> DataFrame:
    """Members (kind 0) and queries (kind 1) of groups with their payload by class, sorted
    for a worker: a group's queries are dealt to slices of about ``SLICE``, and its members,
    at most CHUNK or so, copied to each, so that a group many ask is not one task's. ``part``
    names a slice of a group."""
    many = queries.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices")).where("slices > 1")
    n = F.coalesce("slices", F.lit(1))
    q = queries.join(many, "gid", "left").withColumn("slice", F.pmod(F.xxhash64("cls", F.lit(9)), n).cast("int")).withColumn("kind", F.lit(1))
    m = members.join(many, "gid", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("kind", F.lit(0))
    rows = (m.drop("slices").unionByName(q.drop("slices")).withColumn("part", F.xxhash64("gid", "slice"))
            .join(payload, "cls").select("part", "gid", "kind", "cls", "grp", *columns))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "part").sortWithinPartitions("part", "kind")


def opened(members: DataFrame, queries: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between queries (gid, cls, grp) and the members (gid, cls, grp) of their groups."""
    return K.arrow_map(dealt(members, queries, sets, "tokens"), "starmart.llm.tgm_join:open_batches", "a long, b long")


def allowed(members: DataFrame, queries: DataFrame, bits: DataFrame) -> DataFrame:
    """(gid, kind, cls): members and queries whose bitmaps allow a link, each once."""
    rows = dealt(members, queries, bits, "n", "bits")
    return K.arrow_map(rows, "starmart.llm.tgm_join:allow_batches", "gid long, kind int, cls long").distinct()


def prefix_rows(batch):
    """(token, row, pos) arrays of the prefixes of one batch of classes."""
    col = batch.column("prefix")
    values, offs = col.values.to_numpy(), col.offsets.to_numpy().astype(np.int64)
    size = np.diff(offs)
    row = np.repeat(np.arange(len(size)), size)
    return values[offs[0]:offs[-1]], row, np.arange(len(row)) - np.repeat(offs[:-1] - offs[0], size)


def token_batches(batches):
    """Worker: (token, cls), once a batch, so copies collapse before the exchange."""
    for b in batches:
        token, row, _ = prefix_rows(b)
        cls = b.column("cls").to_numpy()
        new = np.zeros(len(cls), bool)
        new[np.unique(cls, return_index=True)[1]] = True
        k = new[row]
        yield pa.record_batch([pa.array(token[k]), pa.array(cls[row[k]])], names=["token", "cls"])


def place_batches(batches, wanted):
    """Worker: (token, cls, pos) of wanted tokens, once a batch and class."""
    f = wanted.value
    for b in batches:
        token, row, pos = prefix_rows(b)
        cls = b.column("cls").to_numpy()
        new = np.zeros(len(cls), bool)
        new[np.unique(cls, return_index=True)[1]] = True
        k = np.flatnonzero(new[row])
        k = k[f.has(token[k])]
        yield pa.record_batch([pa.array(token[k]), pa.array(cls[row[k]]), pa.array(pos[k].astype(np.int32))],
                              names=["token", "cls", "pos"])


def places_of(sig: DataFrame, classes: DataFrame) -> DataFrame:
    """(token, cls, pos, grp, size, n, first): the places of tokens that several components
    hold, and the smallest of these. A first aggregate finds the tokens of several classes
    (most are of one only), a bounded filter of them keeps the others' rows out of the
    second exchange, and the joins remove the filter's false positives and the tokens of
    one component."""
    spark = sig.sparkSession
    own = sig.where("cls is not null").select("cls", "prefix")
    several = stored(K.arrow_map(own, "starmart.llm.tgm_join:token_batches", "token long, cls long")
                     .groupBy("token").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x < y")
                     .select("token"), "jaccard-tokens")
    wanted = spark.sparkContext.broadcast(id_filter(several))
    rows = K.arrow_map(own, "starmart.llm.tgm_join:place_batches", "token long, cls long, pos int", wanted)
    placed = stored(rows.distinct().join(classes, "cls"), "jaccard-placed")
    shared = placed.groupBy("token").agg(F.min("grp").alias("first"), F.max("grp").alias("last")).where("first < last").select("token", "first")
    return stored(placed.join(shared, "token"), "jaccard-places")


def grouped(places: DataFrame) -> DataFrame:
    """(cls, grp, size, n, gid) of every class with a place. A component of CHUNK classes or
    more has groups of its own; smaller ones share groups with those whose tokens lead to
    the same first component. Members of a group have sets of about one size, as a wide
    range would qualify for too many queries."""
    placed = places.groupBy("cls", "grp", "size", "n").agg(F.min("first").alias("lead"))
    lead = placed.groupBy("grp").agg(F.min("lead").alias("lead"))
    large = F.col("size") >= CHUNK
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(BAND))
    home = placed.drop("lead").join(lead, "grp").withColumn(
        "home", F.xxhash64(F.when(large, F.xxhash64("grp", F.lit(1))).otherwise(F.xxhash64("lead", F.lit(2))), band))
    count = home.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("groups"))
    return (home.join(count, "home")
            .select("cls", "grp", "size", "n", F.xxhash64("home", F.pmod(F.xxhash64("cls"), F.col("groups"))).alias("gid")))


def qualifying(places: DataFrame, groups: DataFrame) -> DataFrame:
    """(cls, gid): the groups a class asks, by the token-group matrix."""
    rows = stored(places.select("token", "cls", "pos").join(groups, "cls"), "jaccard-matrix")
    matrix = rows.groupBy("token", "gid").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("first"),
                                              F.max("size").alias("top"), F.max("grp").alias("last"))
    q = rows.select("token", "cls", "grp", "size", "n", "pos")
    need = F.ceil((F.col("n") + F.col("lo")) * F.lit(NUM) / F.lit(NUM + DEN))
    # of two components the one smaller by (size, name) asks
    asks = (F.col("size") < F.col("top")) | ((F.col("size") == F.col("top")) & (F.col("grp") < F.col("last")))
    fits = (DEN * F.col("hi") >= NUM * F.col("n")) & (DEN * F.col("n") >= NUM * F.col("lo"))
    rest = F.least(F.col("n") - F.col("pos"), F.col("hi") - F.col("first")) >= need
    return q.join(matrix, "token").where(asks & fits & rest).select("cls", "gid").distinct()


def join_documents(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_key, n_shingles, cls, component, component_id) of every row: text_key
    is the hash of its text, component the name of its component among the class hashes."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = stored(K.word_counts(src.select("text")), "jaccard-words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    table, c, _ = K.frequent(counts, total, words)
    shared = spark.sparkContext.broadcast((table, c))
    sig = stored(K.arrow_map(src.withColumn("text_key", F.xxhash64("text")), "starmart.llm.tgm_join:signature_batches",
                             "doc_id long, text_key long, n_shingles long, cls long, low array<long>, prefix array<long>", shared), "jaccard-sets")
    rep = stored(sig.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"),
                                                               *[F.min(F.col("low")[k]).alias(f"low{k}") for k in range(HASHES)]), "jaccard-classes")

    nameless = not rep.where("rep is null").isEmpty()

    def sets_of(classes, target="set_batches", schema="cls long, tokens array<long>"):
        wanted = rep.join(classes, "cls", "left_semi")
        f = spark.sparkContext.broadcast((id_filter(wanted.where("rep is not null").select("rep")),
                                          id_filter(wanted.where("rep is null").select("cls")) if nameless else None))
        got = K.arrow_map(src, f"starmart.llm.tgm_join:{target}", schema, shared, f)
        return got.join(classes, "cls", "left_semi").dropDuplicates(["cls"])

    # 2. groups of similar documents
    keyed = rep.select("cls", "n", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"low{k}").alias("v")) for k in range(HASHES)])).alias("key"))
    keyed = keyed.select("cls", "n", F.col("key.k").alias("k"), F.col("key.v").alias("v"))
    pivots = keyed.groupBy("k", "v").agg(F.min(F.struct("cls", "n")).alias("p"), F.count(F.lit(1)).alias("size")).where("size > 1")
    star = (keyed.join(pivots, ["k", "v"]).where((F.col("cls") != F.col("p.cls"))
                                               & (DEN * F.least("n", "p.n") >= NUM * F.greatest("n", "p.n")))
            .select("cls", F.col("p.cls").alias("pivot")).distinct())
    star = stored(star, "jaccard-star")
    chunks = star.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    asked = star.join(chunks, "pivot").withColumn("gid", F.xxhash64("pivot", F.pmod(F.xxhash64("cls"), F.col("chunks"))))
    involved = star.select("cls").unionByName(star.select(F.col("pivot").alias("cls"))).distinct()
    links = stored(opened(asked.select("gid", F.col("pivot").alias("cls"), F.col("pivot").alias("grp")).distinct(),
                          asked.select("gid", "cls", F.col("cls").alias("grp")), sets_of(involved)), "jaccard-links")
    comp = components(links)

    # 3. token-group matrix
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    classes = stored(rep.join(comp.join(sizes, "component"), F.col("cls") == F.col("node"), "left")
                     .select("cls", "n", F.coalesce("component", "cls").alias("grp"), F.coalesce("size", F.lit(1)).alias("size")),
                     "jaccard-components")
    places = places_of(sig, classes)
    groups = stored(grouped(places), "jaccard-groups")
    queries = stored(qualifying(places, groups), "jaccard-queries")

    # 4. open qualifying groups: bitmaps first, then whole sets of what they allow
    members = groups.join(queries.select("gid").distinct(), "gid", "left_semi").select("gid", "cls", "grp", "n")
    queries = queries.join(groups.select("cls", "grp", "n"), "cls").select("gid", "cls", "grp", "n")
    touched = stored(members.select("cls").unionByName(queries.select("cls")).distinct(), "jaccard-touched")
    left = stored(allowed(members, queries, sets_of(touched, "bit_batches", "cls long, bits binary")), "jaccard-allowed")
    side = lambda kind: (left.where(F.col("kind") == kind).select("gid", "cls")
                         .join(groups.select("cls", "grp"), "cls").select("gid", "cls", "grp"))
    found = opened(side(0), side(1), sets_of(stored(left.select("cls").distinct(), "jaccard-touched")))
    comp = components(stored(found.unionByName(links), "jaccard-links"))
    named = rep.join(comp, F.col("cls") == F.col("node"), "left").select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    result = named.join(least, "component").select("cls", "component", "component_id")
    return (sig.select("doc_id", "text_key", "n_shingles", "cls").join(result, "cls", "left")
            .select("doc_id", "text_key", "n_shingles", "cls", "component", F.coalesce("component_id", "doc_id").alias("component_id")))
