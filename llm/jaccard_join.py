"""N-gram Jaccard join: rare-first prefixes, length, positional and suffix filters.

The universe of shingles is ordered by document frequency, rare ones first. Two
sets with a Jaccard similarity of t or more share a shingle among the first
n - ceil(t * n) + 1 of each. A shingle that a single set holds can't be shared,
so only shingles of two sets or more travel on.

How the work is dealt out:

* Equal sets are one node from the start, whatever the number of copies.
* Frequencies are counted per bucket of the hash space; each task sends a bucket
  its shingles as packed 48-bit rests, since the bucket holds the other bits.
* What a bucket found shared goes on packed by parts of the sets, as many parts as
  buckets, so a part has about as many shingles as a bucket and a set costs no row
  for each bucket. A part is put in order a block of sets at a time.
* Shingles in more than about 1/64 of all sets form a tier of their own behind
  all others, ordered by hash. There are at most 128 mean set sizes of them,
  whatever the number of documents, so this list may be broadcast. No bucket
  ever gathers their occurrences.
* A prefix shingle's holders are first matched with one of them only (a star), in
  a few rounds. Pairs are matched in full only across what the stars left apart.
  So a group of near copies costs a multiple of its size, not its square.

Verification needs no text: what two sets share lies in their shared shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textbits
from llm.tables import components, stored

#: Words of a shingle, and the similarity as a fraction.
WORDS, NUMERATOR, DENOMINATOR = 5, 4, 5

#: Shingles a bucket should hold, and the most buckets there can be.
BUCKET_SHINGLES, MAX_BUCKETS = 2_500_000, 1 << 15

#: A shingle in a larger share of the sets than one in this many belongs to the last tier.
HOT_SHARE = 64

#: Shared shingles put in order at once; a longer single set is handled alone.
BLOCK_SHINGLES = 1 << 18

#: Sets looked at together when frequent shingles are noticed.
HOT_BLOCK = 1024

#: Rounds of stars, and documents of a block of what they leave.
STARS, TILE = 2, 128

#: Pairs of blocks in one batch.
TILES = 16

#: Frequency written for the last tier.
HOT_RANK = 2**32 - 1

#: Parts of the hash space whose counts bound an overlap.
BINS = 16

_HOT_BIT = np.uint64(1 << 63)
_LOW48 = np.uint64((1 << 48) - 1)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` for every row of `docs`.

    Words are runs of characters other than 0x20 and 0x09-0x0D, A-Z lower-cased; a set holds the
    distinct 5-word shingles, with fewer words the whole sequence. Rows whose sets
    have 100 * intersection >= 80 * union are linked; component_id is the smallest
    id reachable over links, the row's own included.

    A null or empty text, or one of white space, has an empty set and no link. A
    row with a null id keeps its n_shingles, has no component and links nothing.
    Repeated rows come back as often as they came in. No rows give no rows. Other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    summary = stored(rows.mapInArrow(_summaries, "doc_id long, n long, s0 long, s1 long, hot boolean"), "sets")
    sets = summary.where("not hot").select("doc_id", "n", "s0", "s1")
    links = _links(rows, summary, sets)
    labels = components(links)
    heads = sets.where("n > 0 and doc_id is not null").groupBy("s0", "s1").agg(F.min("doc_id").alias("head"))
    heads = heads.join(labels.withColumnRenamed("node", "head"), "head", "left")
    heads = heads.select("s0", "s1", F.coalesce("component", "head").alias("component"))
    found = sets.join(heads, ["s0", "s1"], "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(alone, "component")).alias("component_id"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, columns as they are, whose id is the smallest of its component.

    Rows with a null id stay. Of repeated rows with one id all or none stay.
    """
    found = jaccard_components(docs)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    # Merged at every size: what fits a broadcast today may not tomorrow.
    return docs.join(gone.hint("merge"), docs["doc_id"] == gone["_gone"], "left_anti")


def _links(rows: DataFrame, summary: DataFrame, sets: DataFrame) -> DataFrame:
    size = sets.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    n_sets, n_shingles = size[0], size[1] or 0
    hot = summary.where("hot").groupBy("s0").agg(F.sum("n").alias("n"))
    hot = hot.where(F.col("n") * 2 * HOT_SHARE >= max(n_sets, 2 * HOT_BLOCK)).select("s0").toPandas()["s0"]
    hot = np.sort(hot.to_numpy(np.int64).view(np.uint64))
    n_buckets = int(min(MAX_BUCKETS, max(8, -(-n_shingles // BUCKET_SHINGLES))))

    packed = rows.where("doc_id is not null").mapInArrow(_emit(hot, n_buckets), "bucket int, payload binary")
    shared = packed.groupBy("bucket").applyInArrow(_shared(n_buckets), "part int, payload binary")
    prefixes = shared.groupBy("part").applyInArrow(
        _prefixes, "s0 long, s1 long, n long, tokens binary, sig array<int>, prefix array<long>, first long"
    )
    heads = sets.where("n > 0").groupBy("s0", "s1").agg(F.min("doc_id").alias("doc"))
    prefixes = stored(prefixes.join(heads, ["s0", "s1"]).drop("s0", "s1"), "prefixes")

    posts = prefixes.select("doc", "n", "first", F.posexplode("prefix").alias("i", "token"))
    posts = posts.select("token", "doc", "n", (F.col("first") + F.col("i")).alias("at"))
    posts = _merged(posts).withColumn("component", F.col("doc"))
    links = []
    for turn in range(STARS + 1):
        posts = _unsettled(posts, turn)
        if turn == STARS:
            break
        links.append(stored(_verified(_stars(posts), prefixes), "links"))
        labels = components(_union(links)).withColumnRenamed("node", "doc")
        posts = posts.drop("component", "hub").join(labels, "doc", "left")
        posts = posts.withColumn("component", F.coalesce("component", "doc"))

    # Rows that hold the token lists of two blocks: few at once.
    return _union([*links, stored(_rest(posts.drop("hub"), prefixes), "links", TILES)])


def _rest(posts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """What the stars left: all pairs of different components that share a prefix shingle, in tiles.

    Documents with the same most frequent shingle share a block, cut into blocks of
    about TILE. Blocks meet if a shingle is in both. A document is in one block, so a
    pair is verified once, in one product of incidence matrices; a tile gives back
    links that join components, not pairs.
    """
    docs = posts.groupBy("doc").agg(
        F.max("token").alias("key"), F.first("n").alias("n"), F.first("component").alias("component")
    )
    sizes = docs.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    salt = F.expr(f"pmod(xxhash64(doc), cast(ceil(size / {TILE}) as bigint))")
    docs = docs.join(sizes, "key").select("doc", "n", "component", F.xxhash64("key", salt).alias("block"))
    docs = stored(docs, "blocks")
    held = posts.join(docs.select("doc", "block"), "doc").select("token", "block").distinct()
    pairs = held.join(held.withColumnRenamed("block", "other"), "token").where("block <= other")
    pairs = stored(pairs.select("block", "other").distinct(), "block_pairs")
    member = F.struct("doc", "n", "component", "tokens")
    members = docs.join(prefixes.select("doc", "tokens"), "doc").groupBy("block").agg(F.collect_list(member).alias("docs"))
    members = stored(members, "members")
    tiles = pairs.join(members, "block").join(members.toDF("other", "others"), "other")
    return tiles.mapInArrow(_tiles, "a long, b long")


def _merged(posts: DataFrame) -> DataFrame:
    """Shingles with the same holders propose the same pairs: one of them is enough, at its first place."""
    held = posts.groupBy("token").agg(
        F.struct(
            F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("doc", F.lit(1))), F.bit_xor(F.xxhash64("doc", F.lit(2)))
        ).alias("holders")
    )
    merged = posts.join(held.where("holders.c > 1"), "token").groupBy("holders", "doc")
    return merged.agg(F.first("n").alias("n"), F.min("at").alias("at")).withColumnRenamed("holders", "token")


def _unsettled(posts: DataFrame, turn: int) -> DataFrame:
    """The posts of shingles held in several components, each with its hub, another one each turn."""
    order = F.xxhash64("doc", "token", F.lit(turn))
    tokens = posts.groupBy("token").agg(
        F.min(F.struct(order.alias("order"), "doc", "n", "at", "component")).alias("hub"),
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
    )
    return stored(posts.join(tokens.where("lo < hi").select("token", "hub"), "token"), "posts")


def _stars(posts: DataFrame) -> DataFrame:
    """Each holder of a shingle against the shingle's hub only.

    From a common shingle on, two sets share at most what follows it in either. If it
    isn't their first common one, this may leave out a pair that `_rest` finds.
    """
    whole = NUMERATOR + DENOMINATOR
    near = posts.where(
        f"component <> hub.component and {DENOMINATOR} * least(n, hub.n) >= {NUMERATOR} * greatest(n, hub.n)"
        f" and {whole} * least(n - at, hub.n - hub.at) >= {NUMERATOR} * (n + hub.n)"
    )
    flip = F.col("doc") < F.col("hub.doc")
    return near.select(
        F.when(flip, F.col("doc")).otherwise(F.col("hub.doc")).alias("a"),
        F.when(flip, F.col("hub.doc")).otherwise(F.col("doc")).alias("b"),
        F.when(flip, F.col("n")).otherwise(F.col("hub.n")).alias("na"),
        F.when(flip, F.col("hub.n")).otherwise(F.col("n")).alias("nb"),
    ).distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def _verified(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb) that reach the similarity, each looked at once."""
    whole = NUMERATOR + DENOMINATOR
    sigs = prefixes.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a"))
    pairs = pairs.join(sigs, "a").join(sigs.select(F.col("a").alias("b"), F.col("sig_a").alias("sig_b")), "b")
    bound = F.expr("aggregate(zip_with(sig_a, sig_b, (x, y) -> least(x, y)), 0, (s, x) -> s + x)")
    pairs = pairs.where(bound * whole >= NUMERATOR * (F.col("na") + F.col("nb"))).drop("sig_a", "sig_b")
    held = prefixes.select("doc", "tokens")
    pairs = pairs.join(held.select(F.col("doc").alias("a"), F.col("tokens").alias("ta")), "a")
    pairs = pairs.join(held.select(F.col("doc").alias("b"), F.col("tokens").alias("tb")), "b")
    return pairs.mapInArrow(_verify, "a long, b long")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with the digest of its set; at the end the shingles frequent in some block."""
    frequent: dict[int, int] = {}
    held: list[np.ndarray] = []

    def count() -> None:
        if held:
            seen, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(4, len(held) // HOT_SHARE)
            for h, c in zip(seen[often].view(np.int64).tolist(), n[often].tolist()):
                frequent[h] = frequent.get(h, 0) + c
            held.clear()

    names = ["doc_id", "n", "s0", "s1", "hot"]
    for batch in batches:
        n, s0, s1 = [], [], []
        for _, _, data, offsets in textbits.blocks(batch.column("text")):
            for one in textbits.shingle_sets(data, offsets, WORDS):
                a, b = textbits.digest(one.tobytes())
                n.append(len(one)), s0.append(a), s1.append(b)
                if len(one):
                    held.append(one)
                if len(held) >= HOT_BLOCK:
                    count()
        flags = pa.array(np.zeros(len(n), bool))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(s0, pa.int64()), pa.array(s1, pa.int64()), flags], names
        )
    count()
    keys, counts = pa.array(list(frequent), pa.int64()), pa.array(list(frequent.values()), pa.int64())
    none = pa.nulls(len(keys), pa.int64())
    yield pa.RecordBatch.from_arrays([none, counts, keys, none, pa.array(np.ones(len(keys), bool))], names)


#: Heads a run of shingles of one set in a payload.
_RUN = np.dtype([("s0", "<i8"), ("s1", "<i8"), ("n", "<u4"), ("count", "<u4")])


def _pack(runs: np.ndarray, tokens: np.ndarray) -> bytes:
    rest = np.ascontiguousarray(tokens).view(np.uint8).reshape(-1, 8)[:, :6]
    return np.uint32(len(runs)).tobytes() + runs.tobytes() + rest.tobytes()


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(payload, "<u4", 1)[0])
    runs = np.frombuffer(payload, _RUN, n, 4)
    rest = np.frombuffer(payload, np.uint8, offset=4 + n * _RUN.itemsize).reshape(-1, 6)
    tokens = np.zeros((len(rest), 8), np.uint8)
    tokens[:, :6] = rest
    return runs, tokens.view("<u8").reshape(-1)


def _runs(keys: np.ndarray, n: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Run heads for consecutive equal entries of `doc`, which index `keys` and `n`."""
    cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    out = np.zeros(len(cut), _RUN)
    out["s0"], out["s1"], out["n"] = keys[doc[cut], 0], keys[doc[cut], 1], n[doc[cut]]
    out["count"] = np.diff(np.append(cut, len(doc)))
    return out


def _emit(hot: np.ndarray, n_buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for _, _, data, offsets in textbits.blocks(batch.column("text")):
                keys, sets = [], []
                for one in textbits.shingle_sets(data, offsets, WORDS):
                    key = textbits.digest(one.tobytes())
                    if len(one) and key not in seen:
                        seen.add(key)
                        keys.append(key), sets.append(one)
                if not sets:
                    continue
                n = np.array([len(x) for x in sets])
                key = np.array(keys, np.int64)
                doc = np.repeat(np.arange(len(sets), dtype=np.int32), n)
                flat = np.concatenate(sets)
                bucket = (((flat >> np.uint64(48)) * np.uint64(n_buckets)) >> np.uint64(16)).astype(np.uint16)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, flat), len(hot) - 1)
                    often = hot[at] == flat
                    yield from _hot_rows(key, n, doc[often], flat[often], n_buckets)
                    doc, flat, bucket = doc[~often], flat[~often], bucket[~often]
                order = np.argsort(bucket, kind="stable")
                doc, flat, bucket = doc[order], flat[order], bucket[order]
                cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
                ids, payloads = [], []
                for b in np.flatnonzero(np.diff(cuts)):
                    part = slice(cuts[b], cuts[b + 1])
                    ids.append(b), payloads.append(_pack(_runs(key, n, doc[part]), flat[part]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int32()), pa.array(payloads, pa.binary())], ["bucket", "payload"]
                )

    return emit


def _hot_rows(key: np.ndarray, n: np.ndarray, doc: np.ndarray, flat: np.ndarray, n_buckets: int):
    """Shingles of the last tier go by set, not by bucket: nobody gathers a frequent shingle."""
    if not len(doc):
        return
    runs = _runs(key, n, doc)
    ends = np.cumsum(runs["count"].astype(np.int64))
    to = n_buckets + (runs["s0"] % n_buckets)
    payloads = [runs[i].tobytes() + flat[e - runs["count"][i] : e].tobytes() for i, e in enumerate(ends)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(to, pa.int32()), pa.array(payloads, pa.binary())], ["bucket", "payload"]
    )


def _once(runs: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Several tasks may have sent the same set: one run of each."""
    _, first = np.unique(runs[["s0", "s1"]], return_index=True)
    fresh = np.zeros(len(runs), bool)
    fresh[first] = True
    return runs[fresh], tokens[np.repeat(fresh, runs["count"])]


def _shared(n_buckets: int):
    """What two sets or more of a bucket hold, with the frequencies, packed by parts of the sets."""

    def rows(runs: np.ndarray, tokens: np.ndarray, ranks: np.ndarray) -> pa.Table:
        part = runs["s0"] % n_buckets
        order = np.argsort(part, kind="stable")
        moved = np.argsort(np.repeat(part, runs["count"]), kind="stable")
        part, runs, tokens, ranks = part[order], runs[order], tokens[moved], ranks[moved].astype("<u4")
        ends = np.concatenate([[0], np.cumsum(runs["count"].astype(np.int64))])
        cuts = np.searchsorted(part, np.arange(n_buckets + 1))
        parts = np.flatnonzero(np.diff(cuts))
        payloads = []
        for p in parts:
            lo, hi = cuts[p], cuts[p + 1]
            held = slice(ends[lo], ends[hi])
            payloads.append(b"".join([np.uint32(hi - lo).tobytes(), runs[lo:hi].tobytes(), tokens[held].tobytes(), ranks[held].tobytes()]))
        return pa.Table.from_arrays([pa.array(parts, pa.int32()), pa.array(payloads, pa.binary())], ["part", "payload"])

    def shared(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        payloads = [x.as_py() for x in table.column("payload")]
        if bucket >= n_buckets:
            runs = np.concatenate([np.frombuffer(p, _RUN, 1) for p in payloads])
            tokens = np.concatenate([np.frombuffer(p, "<u8", offset=_RUN.itemsize) for p in payloads])
            runs, tokens = _once(runs, tokens)
            return rows(runs, tokens | _HOT_BIT, np.full(len(tokens), HOT_RANK))
        parts = [_unpack(p) for p in payloads]
        del payloads
        runs, tokens = np.concatenate([r for r, _ in parts]), np.concatenate([t for _, t in parts])
        del parts
        runs, tokens = _once(runs, tokens)
        order = np.argsort(tokens)
        ordered = tokens[order]
        cut = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
        df = np.zeros(len(tokens), np.uint32)
        counts = np.diff(np.append(cut, len(ordered)))
        df[order] = np.repeat(counts, counts)
        kept = df > 1
        starts = np.concatenate([[0], np.cumsum(runs["count"].astype(np.int64))[:-1]])
        per_run = np.add.reduceat(kept, starts, dtype=np.int64)
        tokens = (tokens[kept] & _LOW48) | np.uint64(bucket << 48)
        left = runs[per_run > 0]
        left["count"] = per_run[per_run > 0]
        return rows(left, tokens, df[kept])

    return shared


def _part(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    runs = np.frombuffer(payload, _RUN, int(np.frombuffer(payload, "<u4", 1)[0]), 4)
    size, at = int(runs["count"].sum(dtype=np.int64)), 4 + runs.nbytes
    return runs, np.frombuffer(payload, "<u8", size, at), np.frombuffer(payload, "<u4", size, at + 8 * size)


def _prefixes(table: pa.Table) -> pa.Table:
    """The sets of a part, each in the order of frequencies, with their prefixes."""
    runs, tokens, ranks = (np.concatenate(x) for x in zip(*(_part(p.as_py()) for p in table.column("payload"))))
    sets, first, doc = np.unique(runs[["s0", "s1"]], return_index=True, return_inverse=True)
    doc = np.repeat(doc.astype(np.int32), runs["count"])
    order = np.argsort(doc, kind="stable")
    doc, tokens, ranks, n = doc[order], tokens[order], ranks[order], runs["n"][first].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(sets)))])
    at, out = 0, []
    while at < len(sets):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK_SHINGLES, "right")) - 1)
        held = slice(ends[at], ends[end])
        out.append(_prefix_rows(sets["s0"][at:end], sets["s1"][at:end], n[at:end], doc[held] - at, tokens[held], ranks[held]))
        at = end
    return pa.Table.from_batches(out)


def _prefix_rows(
    s0: np.ndarray, s1: np.ndarray, n: np.ndarray, doc: np.ndarray, tokens: np.ndarray, ranks: np.ndarray
) -> pa.RecordBatch:
    """`doc` (ascending) indexes the sets `s0`, `s1`, `n`."""
    order = np.lexsort((tokens, ranks, doc))
    tokens = tokens[order]
    size = np.bincount(doc, minlength=len(n))
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    first = n - size
    length = n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1
    wanted = np.clip(length - first, 0, size)
    at = np.arange(len(tokens)) - np.repeat(starts, size)
    prefix = tokens[at < np.repeat(wanted, size)].view(np.int64)
    ends = np.concatenate([[0], np.cumsum(wanted)]).astype(np.int32)
    bins = (textbits.mix(tokens) >> np.uint64(60)).astype(np.int64)
    sig = np.bincount(doc * BINS + bins, minlength=len(n) * BINS).astype(np.int32)
    by_token = np.lexsort((tokens, doc))
    out = pa.RecordBatch.from_arrays(
        [
            pa.array(s0), pa.array(s1), pa.array(n), textbits.binary(tokens[by_token], size),
            pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BINS), pa.array(sig)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix)), pa.array(first),
        ],
        ["s0", "s1", "n", "tokens", "sig", "prefix", "first"],
    )
    return out.filter(pa.array(wanted > 0))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = zip(batch.column("na").to_pylist(), batch.column("nb").to_pylist())
        kept = []
        for (na, nb), a, b in zip(sizes, batch.column("ta"), batch.column("tb")):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            kept.append(DENOMINATOR * common >= NUMERATOR * (na + nb - common))
        mask = pa.array(kept, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            a, b = _tile(row["docs"], row["others"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _tile(docs: list[dict], others: list[dict]) -> tuple[list[int], list[int]]:
    """For each document a linked one of each component among `others` that isn't its own."""
    sides = []
    for side in (docs, others):
        sets = [np.frombuffer(d["tokens"], np.uint64) for d in side]
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(side)), [len(x) for x in sets])))
    known = np.intersect1d(sides[0][0], sides[1][0])
    if not len(known):
        return [], []
    n_a, n_b = (np.array([d["n"] for d in side]) for side in (docs, others))
    common = np.zeros((len(docs), len(others)))
    for start in range(0, len(known), 1 << 14):  # bounded matrices, whatever the texts' lengths
        part = known[start : start + (1 << 14)]
        rows = []
        for (tokens, doc), side in zip(sides, (docs, others)):
            at = np.minimum(np.searchsorted(part, tokens), len(part) - 1)
            hit = part[at] == tokens
            matrix = np.zeros((len(side), len(part)), np.float32)
            matrix[doc[hit], at[hit]] = 1
            rows.append(matrix)
        common += rows[0] @ rows[1].T
    linked = DENOMINATOR * common >= NUMERATOR * (n_a[:, None] + n_b[None, :] - common)
    own, other = (np.array([d["component"] for d in side]) for side in (docs, others))
    linked &= own[:, None] != other[None, :]
    a, b = [], []
    for i in np.flatnonzero(linked.any(1)):
        hits = np.flatnonzero(linked[i])
        _, first = np.unique(other[hits], return_index=True)
        for j in hits[first]:
            a.append(docs[i]["doc"]), b.append(others[j]["doc"])
    return a, b
