"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its 4-word shingles (64-bit hashes).  Documents with the same set are one
*entity*.  Tokens (shingles) are ordered by how many entities hold them, rarest first, then by hash.
Two entities whose Jaccard similarity reaches the threshold share K = 2 tokens at least among the first
n - ceil(t n) + K of each (n: its size).  So each entity indexes that extended prefix: a token of the
rare class (at most ``RARE`` entities) alone, tokens of the frequent class in combinations of K.  If
two similar entities share a rare token there, they meet at it; if not, they share K frequent ones and
meet at a combination.  Combinations are for sets of up to ``COMBINED`` tokens (their number grows with
the square of the prefix); larger sets index their frequent tokens alone, and sets of the sizes in
between, which may be similar to either, do both.  Tokens of a single entity are never indexed: they
only push the prefix on.  Nothing is capped or sampled.

Entities that meet are tied to the least of them (no pairs within a group); the components of these
ties are clusters, and similar entities are always in one cluster.  A cluster is verified exactly on its
whole sets: in blocks of ``BLOCK`` entities, each pair of blocks in one task, by an inverted index.  Links are
counted per entity, weighted with the copies, not emitted; what a task keeps besides is one edge per entity that joins
what its links join.  The components of these edges are the result.  Sets so small that one shared token can make
them similar index all their tokens alone.

Most entities are similar to no other.  They are found first, by counting a quarter of all tokens
(:func:`likely_entities`); the rest is done for the others alone.  What moves is packed: tokens travel as
arrays of 32 bits by token group, where they are counted, and back by entity group.  Group counts follow
the number of tokens, so a group's size does not.

Defined results: null, empty and blank texts have no tokens and are linked with nothing; rows with equal
ids are separate documents; a null id takes part in links, its component is the least id that is not
null (null if there is none); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import lean, table
from layerflow.llm.graph import components, forest
from layerflow.llm.rowfilter import split
from layerflow.session import scratch_dir

WORDS = 4
PERCENT = 85
K = 2
RARE = 64
COMBINED = 200
BLOCK = 512
GROUP_TOKENS = 1_500_000
BLOCK_TOKENS = 2_000_000
BIN_TOKENS = 200_000
BATCH_TOKENS = 1_000_000
MAX_BITS = 1 << 28  # 32 MB
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * M2
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct tokens; fewer words than ``size`` are one token.  Bytes split at exactly the six
    ASCII blanks and are lower-cased in A-Z only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    out = np.full(len(h) - size + 1, np.uint64(size * int(M2) % 2**64))
    for k in range(size):
        out = mixed((out ^ h[k:len(h) - size + 1 + k]) * M1)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def entity_of(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).view(np.int64))


def least_overlap(n, percent: int):
    return (percent * n + 99) // 100


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))


def memberships(rows: DataFrame, folder: str, size: int) -> DataFrame:
    """(doc_id, n, entity) of every row, and its text_key if it has one, kept as a table; entity is null
    for the empty set."""
    @lean
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            sets = [shingle_set(t, size) for t in p["text"]]
            out = pd.DataFrame({"doc_id": p["doc_id"], "n": [len(s) for s in sets],
                                "entity": pd.array([entity_of(s) if len(s) else None for s in sets], "Int64")})
            yield out.assign(text_key=p["text_key"]) if "text_key" in p else out

    schema = "doc_id string, n long, entity long" + (", text_key long" if "text_key" in rows.columns else "")
    rows.mapInPandas(run, schema).write.parquet(f"{folder}/members")
    return rows.sparkSession.read.schema(schema).parquet(f"{folder}/members")


def _blob(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unblob(blob: bytes, *kinds) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes, kinds):
        out.append(np.frombuffer(blob, kind, n, at))
        at += out[-1].nbytes
    return out


def _by_group(group: np.ndarray, entity: np.ndarray, n: np.ndarray, own: np.ndarray,
              *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A blob per group that has records: its entities with their sizes, and per record the entity's
    place and columns.  own: per record the place in entity."""
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0])) if len(group) else np.zeros(0, np.int64)
    for at in np.split(order, first[1:]) if len(first) else ():
        used, place = np.unique(own[at], return_inverse=True)
        kind = np.uint16 if len(used) < 65_536 else np.uint32
        yield int(group[at[0]]), _blob(entity[used], n[used].astype(np.uint32), place.astype(kind).view(np.uint8),
                                       *[c[at] for c in columns])


def _read_group(p: pd.DataFrame, *kinds) -> tuple[np.ndarray, ...]:
    """entity and size per record, the group it came from, and the columns."""
    out: list[list[np.ndarray]] = [[] for _ in range(3 + len(kinds))]
    for source, blob in zip(p["source"], p["blob"]):
        entity, n, place, *columns = _unblob(blob, np.int64, np.uint32, np.uint8, *kinds)
        place = place.view(np.uint16 if len(entity) < 65_536 else np.uint32)
        for k, c in enumerate((entity[place], n[place], np.full(len(place), source, np.int32), *columns)):
            out[k].append(c)
    return tuple(np.concatenate(x) for x in out)


SPREAD = "target long, source long, blob binary"


def spread_tokens(rows: DataFrame, size: int, groups: int, pick, bits: "Bits | None" = None) -> DataFrame:
    """(target, 0, blob): by token group, the tokens that ``pick`` takes of each entity's sorted set;
    only of entities in ``bits`` where that is given."""
    def some_sets(texts, seen, own):
        """Sets, picked tokens and entities, about ``BATCH_TOKENS`` tokens at a time."""
        out, held = [], 0
        for t in texts:
            s = shingle_set(t, size)
            # a copy in the same task adds nothing
            if len(s) and (e := entity_of(s)) not in seen and (own is None or own.has(e)):
                seen.add(e)
                out.append((len(s), pick(s), e))
                held += len(out[-1][1])
                if held >= BATCH_TOKENS:
                    yield out
                    out, held = [], 0
        if out:
            yield out

    shared = rows.sparkSession.sparkContext.broadcast(bits.packed) if bits is not None else None

    @lean
    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filter_ = Bits(shared.value) if shared is not None else None
        for batch in some_sets((t for p in parts for t in p["text"]), set(), filter_):
            n, sets, entity = zip(*batch)
            every, own = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            # two tokens of a set that are alike in what travels count as one there; a size less by 20
            # for each keeps every bound on counts and prefixes on the safe side
            alike = (every[1:] >> np.uint64(32) == every[:-1] >> np.uint64(32)) & (own[1:] == own[:-1])
            n = np.maximum(np.array(n) - 20 * np.bincount(own[1:][alike], minlength=len(n)), 1)
            out = _by_group((every % np.uint64(groups)).astype(np.int64), np.array(entity), n, own,
                            (every >> np.uint64(32)).astype(np.uint32))
            yield pd.DataFrame([(g, 0, b) for g, b in out], columns=["target", "source", "blob"])

    return rows.mapInPandas(spread, SPREAD)


def _of_many(p: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """entity, size, token and count of the tokens of a group that more than one entity holds."""
    entity, n, _, token = _read_group(p, np.uint32)
    order = np.lexsort((entity, token))
    entity, n, token = entity[order], n[order], token[order]
    new_token = np.concatenate([[True], token[1:] != token[:-1]])
    new_pair = new_token | np.concatenate([[True], entity[1:] != entity[:-1]])
    entity, n, token, new_token = entity[new_pair], n[new_pair], token[new_pair], new_token[new_pair]
    first = np.flatnonzero(new_token)
    df = np.diff(np.append(first, len(token)))
    df = np.repeat(df, df)
    return entity[df > 1], n[df > 1], token[df > 1], df[df > 1]


def likely_entities(rows: DataFrame, size: int, percent: int, groups: int, folder: str) -> DataFrame:
    """(entity, n) of the entities that may be similar to another one, kept as a table.

    In hash order, two similar sets share at least min(k, k') tokens among the first n - ceil(t n) + k of
    each, k = ceil(n / 10).  So only that quarter of the tokens is counted, and an entity that shares
    fewer than ceil(t n) / 10 of them with any others is similar to none."""
    def quarter(s: np.ndarray) -> np.ndarray:
        return s[:len(s) - least_overlap(len(s), percent) + (len(s) + 9) // 10]

    @lean
    def count(p: pd.DataFrame) -> pd.DataFrame:
        entity, n, _, _ = _of_many(p)
        names, at, c = np.unique(entity, return_index=True, return_counts=True)
        return pd.DataFrame({"entity": names, "n": n[at].astype(np.int64), "c": c})

    found = spread_tokens(rows, size, groups, quarter).groupBy("target").applyInPandas(count, "entity long, n long, c long")
    found = found.groupBy("entity").agg(F.min("n").alias("n"), F.sum("c").alias("c"))
    found.where(10 * F.col("c") >= F.floor((percent * F.col("n") + 99) / 100)).select("entity", "n").write.parquet(f"{folder}/likely")
    return rows.sparkSession.read.schema("entity long, n long").parquet(f"{folder}/likely")


def shared_tokens(rows: DataFrame, size: int, groups: int, bits: "Bits") -> DataFrame:
    """(target, source, blob): the tokens that more than one of the entities in ``bits`` holds, with
    their counts, by entity group (target) and token group (source)."""
    @lean
    def count(p: pd.DataFrame) -> pd.DataFrame:
        group = int(p["target"].iloc[0])
        entity, n, token, df = _of_many(p)
        names, at, own = np.unique(entity, return_index=True, return_inverse=True)
        out = _by_group((names.view(np.uint64)[own] % np.uint64(groups)).astype(np.int64), names, n[at], own,
                        token, np.minimum(df, 2**31 - 1).astype(np.uint32))
        return pd.DataFrame([(g, group, b) for g, b in out], columns=["target", "source", "blob"])

    return spread_tokens(rows, size, groups, lambda s: s, bits).groupBy("target").applyInPandas(count, SPREAD)


def prefix_keys(entity, n, key, df, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, entity) index entries of some entities, from all their shared tokens."""
    order = np.lexsort((key, df, entity))
    entity, n, key, df = entity[order], n[order].astype(np.int64), key[order], df[order]
    first = np.flatnonzero(np.concatenate([[True], entity[1:] != entity[:-1]]))
    counts = np.diff(np.append(first, len(entity)))
    rank = np.arange(len(entity)) - np.repeat(first, counts)
    size = n[first]
    room = size - least_overlap(size, percent) + K - (size - counts)  # the tokens of one entity come first
    taken = rank < np.repeat(room, counts)
    entity, n, key, df = entity[taken], n[taken], key[taken], df[taken]
    # a set that can be similar to another by a single shared token has no combination to meet at
    alone = (df <= RARE) | (100 * n >= percent * (COMBINED - 10)) | (least_overlap(n, percent) < K)
    keys, owners = [key[alone]], [entity[alone]]
    frequent = (df > RARE) & (n <= COMBINED)
    e, k = entity[frequent], key[frequent].view(np.uint64)
    if len(e):
        cuts = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
        for a, b in zip(cuts, np.append(cuts[1:], len(e))):
            i, j = np.triu_indices(b - a, 1)
            pair = mixed(mixed(k[a + i] * M1) ^ (k[a + j] * M2))
            keys.append(pair.view(np.int64))
            owners.append(np.full(len(pair), e[a]))
    return np.concatenate(keys), np.concatenate(owners)


def candidate_ties(shared: DataFrame, percent: int, folder: str) -> DataFrame:
    """Edges (a, b) that tie all entities with a common index entry."""
    @lean
    def index(p: pd.DataFrame) -> pd.DataFrame:
        entity, n, source, token, df = _read_group(p, np.uint32, np.uint32)
        key, owner = prefix_keys(entity, n, (source.astype(np.int64) << 32) | token.astype(np.int64), df, percent)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        # one entry a key leaves the group; its other entities are tied to that one here
        least = owner[first][np.cumsum(first) - 1] if len(key) else owner
        ties = np.unique(np.stack([owner, least])[:, owner != least], axis=1) if len(key) else np.zeros((2, 0), np.int64)
        return pd.DataFrame({"tie": np.repeat([False, True], [int(first.sum()), ties.shape[1]]),
                             "a": np.concatenate([key[first], ties[0]]), "b": np.concatenate([owner[first], ties[1]])})

    schema = "tie boolean, a long, b long"
    shared.groupBy("target").applyInPandas(index, schema).write.parquet(f"{folder}/index")
    entries = shared.sparkSession.read.schema(schema).parquet(f"{folder}/index")
    keys = entries.where("NOT tie").select(F.col("a").alias("key"), F.col("b").alias("entity"))
    least = keys.groupBy("key").agg(F.min("entity").alias("least"), F.count("*").alias("n")).where("n > 1")
    met = keys.join(least, "key").where("entity <> least").select(F.col("entity").alias("a"), F.col("least").alias("b"))
    return entries.where("tie").select("a", "b").unionByName(met.distinct())


class Bits:
    """A filter of (entity, doc_id) or of entities alone: no false negatives."""

    def __init__(self, packed: np.ndarray):
        self.packed, self.size = packed, 8 * len(packed)

    def places(self, entity: int, doc_id: str | None = None) -> tuple[int, int]:
        h = xxhash.xxh64_intdigest(f"{entity}:{doc_id}".encode("utf-8", "surrogatepass"))
        return h % self.size, (h >> 32) % self.size

    def has(self, entity: int, doc_id: str | None = None) -> bool:
        return all(self.packed[b >> 3] >> (b & 7) & 1 for b in self.places(entity, doc_id))


def filter_of(wanted: DataFrame) -> Bits:
    """Filter of the rows of ``wanted`` (entity and, if there is one, doc_id): 16 bits a row, but at most
    ``MAX_BITS``; beyond, it lets more through, which is dropped later."""
    size = min(MAX_BITS, max(1 << 16, 1 << (16 * wanted.count()).bit_length()))
    named = "doc_id" in wanted.columns

    @lean
    def mark(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = Bits(np.zeros(size // 8, np.uint8))
        for p in parts:
            at = np.array([bits.places(e, d) for e, d in zip(p["entity"], p["doc_id"] if named else [None] * len(p))],
                          np.int64).ravel()
            np.bitwise_or.at(bits.packed, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pd.DataFrame({"bits": [bits.packed.tobytes()]})

    out = np.zeros(size // 8, np.uint8)
    for r in wanted.coalesce(8).mapInPandas(mark, "bits binary").toLocalIterator():
        out |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return Bits(out)


def near_of(sets: list[np.ndarray], percent: int):
    """Function i -> the places of the sets whose similarity to set i reaches the threshold (i itself too, if
    it shares a token).  An inverted index counts exact overlaps."""
    n = np.array([len(s) for s in sets])
    every, own = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(every, kind="stable")
    token, doc = every[order], own[order]
    first = np.concatenate([[True], token[1:] != token[:-1]])
    number = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    length = np.diff(np.append(start, len(token)))
    of_doc = np.empty(len(token), np.int64)
    of_doc[order] = number
    edges = np.concatenate([[0], np.cumsum(n)])

    def near(i: int) -> np.ndarray:
        t = of_doc[edges[i]:edges[i + 1]]
        t = t[length[t] > 1]
        if not len(t):
            return t
        runs = length[t]
        at = np.repeat(start[t] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
        both = np.bincount(doc[at], minlength=len(sets))
        return np.flatnonzero((100 * both >= percent * (n[i] + n - both)) & (both > 0))

    return near


def spanning_links(sets: list[np.ndarray], percent: int, every_link: bool = False) -> list[tuple[int, int]]:
    """Links between sets whose similarity reaches the threshold: all, or as many as join all that such
    links join.  Where not all are asked for, a set that is joined already is not looked up as a partner again."""
    near, waiting, out = near_of(sets, percent), np.ones(len(sets), bool), []
    for seed in range(len(sets)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        queue = [seed]
        while queue and (every_link or waiting.any()):
            i = queue.pop()
            found = near(i)
            found = found[found > i] if every_link else found[waiting[found]]
            out += [(i, j) for j in found.tolist()]
            if not every_link:
                waiting[found] = False
                queue.extend(found.tolist())
    return out


def counted_links(sets: list[np.ndarray], percent: int, copies: np.ndarray, block: np.ndarray | None
                  ) -> tuple[np.ndarray, np.ndarray]:
    """(rows linked to each set, least place it is joined to by links).  ``copies``: the rows of each set;
    links within one ``block`` are left out."""
    near, count, a, b = near_of(sets, percent), np.zeros(len(sets), np.int64), [], []
    for i in range(len(sets)):
        found = near(i)
        found = found[found > i]
        if block is not None:
            found = found[block[found] != block[i]]
        if len(found):
            count[i] += copies[found].sum()
            count[found] += copies[i]
            a.append(np.full(len(found), i))
            b.append(found)
    root = np.arange(len(sets))
    if a:
        node, least = forest(np.concatenate(a), np.concatenate(b))
        root[node] = least
    return count, root


def verified_links(rows: DataFrame, clusters: DataFrame, members: DataFrame, size: int, percent: int,
                   every_link: bool = False, counts: bool = False) -> DataFrame:
    """Links (a, b) between similar entities, each once if all are asked for; clusters has (entity, cluster).
    With ``counts`` (a, b, n) instead: each entity with a link, the rows that the links of a task add to it, and an
    entity it is joined to by them (or itself)."""
    spark = rows.sparkSession
    every_link = every_link or counts
    lead = members.where("entity IS NOT NULL").groupBy("entity").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.count("*").alias("copies"))
    placed = clusters.join(lead, "entity")
    total = placed.groupBy("cluster").agg(F.count("*").alias("c"), F.sum("n").alias("t")).select(
        "cluster", F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("t") / BLOCK_TOKENS)).cast("long").alias("blocks"), "t")
    tokens = total.agg(F.sum("t")).first()[0] or 0
    bins = max(1, -(-tokens // BIN_TOKENS))
    bits = spark.sparkContext.broadcast(filter_of(placed.select("entity", "doc_id")).packed)

    @lean
    def fetch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = Bits(bits.value)
        for p in parts:
            out = []
            for d, t in zip(p["doc_id"], p["text"]):
                s = shingle_set(t, size)
                if len(s):
                    e = entity_of(s)
                    if wanted.has(e, d):
                        out.append((e, s.tobytes()))
            yield pd.DataFrame(out, columns=["entity", "tokens"])

    sets = rows.mapInPandas(fetch, "entity long, tokens binary")
    tasks = placed.join(total, "cluster").withColumn("own", F.pmod(F.xxhash64("entity"), F.col("blocks")))
    # a cluster of one block goes to a bin with others; one of more meets once for each pair of blocks
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    tasks = tasks.select("entity", "cluster", "copies", "own", "blocks", other.alias("other")).select(
        "entity", "cluster", *(["own"] if every_link else []), *(["copies"] if counts else []),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(F.col("cluster")).alias("k"),
        F.when(F.col("blocks") == 1, -1).otherwise(F.least("own", "other")).cast("long").alias("i"),
        F.when(F.col("blocks") == 1, -1).otherwise(F.greatest("own", "other")).cast("long").alias("j"))

    @lean
    def verify(p: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, c in p.drop_duplicates("entity").groupby("cluster", sort=False):
            own = [np.frombuffer(x, np.uint64) for x in c["tokens"]]
            names = c["entity"].to_numpy()
            # links within a block are those of the task that has this block alone
            block = c["own"].to_numpy() if every_link and (c["i"] != c["j"]).any() else None
            for i, j in spanning_links(own, percent, every_link):
                if block is not None and block[i] == block[j]:
                    continue
                a.append(names[i])
                b.append(names[j])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    @lean
    def count(p: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((3, 0), np.int64)]
        for _, c in p.drop_duplicates("entity").groupby("cluster", sort=False):
            names = c["entity"].to_numpy()
            block = c["own"].to_numpy() if (c["i"] != c["j"]).any() else None
            n, root = counted_links([np.frombuffer(x, np.uint64) for x in c["tokens"]], percent, c["copies"].to_numpy(), block)
            out.append(np.stack([names, names[root], n])[:, n > 0])
        return pd.DataFrame(np.concatenate(out, axis=1).T, columns=["a", "b", "n"])

    met = tasks.join(sets, "entity").groupBy("k", "i", "j")
    return met.applyInPandas(count, "a long, b long, n long") if counts else met.applyInPandas(verify, "a long, b long")


def clusters_of(rows: DataFrame, members: DataFrame, size: int, percent: int, folder: str) -> DataFrame:
    """(entity, cluster): similar entities are always in one cluster."""
    tokens = members.agg(F.sum("n")).first()[0] or 0
    likely = likely_entities(rows, size, percent, max(16, -(-tokens // (4 * GROUP_TOKENS))), folder)
    few = likely.agg(F.sum("n")).first()[0] or 0
    shared = shared_tokens(rows, size, max(16, -(-few // GROUP_TOKENS)), filter_of(likely.select("entity")))
    ties = candidate_ties(shared, percent, folder)
    found = components(ties)
    return found.select(F.col("node").alias("entity"), F.col("root").alias("cluster")).unionByName(
        found.select(F.col("root").alias("entity"), F.col("root").alias("cluster")).distinct())


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
               percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Every link between different texts, and whose texts they are: pairs (a, b) of all similar entities,
    each once with a < b, and (doc_id, n, entity) per row of docs.  Rows with one entity are copies."""
    folder, rows = scratch_dir(docs.sparkSession, "ngramjoin"), _docs(docs, id_col, text_col)
    members = memberships(rows, folder, size)
    clusters = clusters_of(rows, members, size, percent, folder)
    links = verified_links(rows, clusters, members, size, percent, every_link=True)
    return (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")),
            members.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)))


def entity_roots(rows: DataFrame, members: DataFrame, size: int, percent: int, folder: str) -> DataFrame:
    """(node, root): the entities that links join to a lesser one."""
    spark, clusters = rows.sparkSession, clusters_of(rows, members, size, percent, folder)
    # a table of its own: verified once, whatever the rounds after it read again or lose
    verified_links(rows, clusters, members, size, percent).write.parquet(f"{folder}/links")
    return components(spark.read.schema("a long, b long").parquet(f"{folder}/links"))


def least_of_group(members: DataFrame, roots: DataFrame, value) -> DataFrame:
    """(e, least) per entity: the least ``value`` of the rows that links reach."""
    least = members.where("entity IS NOT NULL").groupBy("entity").agg(F.min(value).alias("least"))
    least = least.join(roots, F.col("entity") == F.col("node"), "left").select(
        "entity", "least", F.coalesce("root", "entity").alias("root"))
    of_root = least.groupBy("root").agg(F.min("least").alias("of_root"))
    return least.join(of_root, "root").select(F.col("entity").alias("e"), F.col("of_root").alias("least"))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """Per row of docs: id, n_shingles, component_id (the least id that links reach), n_links (the other rows
    it is linked with: every pair counts, none is emitted)."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    folder, rows = scratch_dir(spark, "ngramjoin"), _docs(docs, id_col, text_col)
    members = memberships(rows, folder, size)
    clusters = clusters_of(rows, members, size, percent, folder)
    # a table of its own: verified once, whatever the rounds after it read again or lose
    verified_links(rows, clusters, members, size, percent, counts=True).write.parquet(f"{folder}/links")
    links = spark.read.schema("a long, b long, n long").parquet(f"{folder}/links")
    roots, own = components(links.select("a", "b")), F.col("doc_id").cast(kind)
    copies = members.where("entity IS NOT NULL").groupBy("entity").agg((F.count("*") - 1).alias("n"))
    linked = links.select(F.col("a").alias("entity"), "n").unionByName(copies).groupBy("entity").agg(
        F.sum("n").alias("n_links"))
    named = least_of_group(members, roots, own).join(linked, F.col("e") == linked["entity"]).drop("entity")
    return members.join(named, members["entity"] == named["e"], "left").select(
        own.alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("entity").isNull(), own).otherwise(F.col("least")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, size: int = WORDS,
                          percent: int = PERCENT) -> DataFrame:
    """Keeps one row of each group of near copies; documents without words stay.

    Rows are told apart by id and text, so an id does not take other texts with it.  The row with the least
    id stays, one with an id before one without; of equal ids, the least hash of the text; of rows with
    equal id and text, one.  What goes is written first; texts that stay are not moved (see :mod:`.rowfilter`)."""
    folder, kind = scratch_dir(spark, "ngramjoin"), docs.schema["doc_id"].dataType
    rows = _docs(docs, "doc_id", "text")
    members = memberships(rows.withColumn("text_key", F.xxhash64("text")), folder, size)
    roots = entity_roots(rows, members, size, percent, folder)
    row = F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast(kind), F.col("text_key"), F.col("doc_id"))
    best = least_of_group(members, roots, row)
    # copies of a row are one before the join
    own = members.where("entity IS NOT NULL").groupBy("entity", "doc_id", "text_key").agg(F.count("*").alias("copies"))
    own.join(best, own["entity"] == best["e"]).select(
        F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), (row == F.col("least")).alias("stays"),
        "copies").where("NOT stays OR copies > 1").write.parquet(f"{folder}/decided")
    decided = spark.read.parquet(f"{folder}/decided")

    own_key = F.xxhash64(F.xxhash64(docs["text"]), docs["doc_id"].cast("string"))
    hit, untouched = split(docs, decided, F.xxhash64("own_key", "own_id"), own_key)

    def of(which: DataFrame):
        return (hit["doc_id"].cast("string").eqNullSafe(which["own_id"])) & (F.xxhash64(hit["text"]) == which["own_key"])

    kept = untouched.unionByName(hit.join(decided, of(decided), "left_anti"))
    again = decided.where("stays")
    if again.isEmpty():
        return kept
    comparable = [c for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]
    one = hit.join(again, of(again), "left_semi").select(F.struct(*docs.columns).alias("row")).groupBy(
        F.col("row.doc_id").alias("i"), F.xxhash64("row.text").alias("k")).agg(
        F.min_by("row", F.xxhash64(*[F.col("row")[c] for c in comparable])).alias("row"))
    return kept.unionByName(one.select("row.*"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS g FROM w),
t AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS i
  FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o WHERE 100 * i >= 85 * (n - i)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, m.c AS component_id, coalesce(l.n, 0)::BIGINT AS n_links
FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM e GROUP BY a) l USING (doc_id)
"""
