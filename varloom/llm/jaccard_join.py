"""Operator 10, n-gram Jaccard join: a token-group matrix finds the groups that a set may have links in.

Sets are distinct hashed shingles. 1. Equal sets become one class, named by its smallest id. 2. Each class lists the
tokens of its prefix: tokens are ordered rare first (levels from a count sketch of fixed size over all texts, then by
hash), and of two sets with overlap of at least a, any two prefixes of n - a + l tokens share l tokens at least.
3. Each class is compared with the smallest class that lists the same token; the
links that hold join classes to components. 4. Similar classes, those with the same smallest candidate (their home),
make a group, apart from components of BLOCK ids or more, which are groups of their own inside the home. The matrix
keeps, for each token that still spans components, the groups whose union of prefixes holds it with the range of their
set sizes. The number of a set's tokens in a group's union bounds the overlap with any member, and only groups at or
above the bound are opened, chunk by chunk: a chunk's full token union bounds the overlap again, and then one pass of
counts compares all its members. A set doesn't ask its own component, and of two large components the smaller asks.
5. Links of 3 and 4 give the components; equal sets follow their class.

No row is made for each pair of a group: a near copy is compared with one leader for each token, tokens inside one
component are dropped, and an asker is dealt to chunks, not to members. Comparisons read the sets of the ids in question only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import BROADCAST_IDS, HOT_KEYS, Words, discard, drop_ids, durable, join_keyed, keep_ids, key_rows, slices, table
from varloom.llm.components import components

#: Words of a shingle; hundredths of the union that the intersection must reach.
SHINGLE, PERCENT = 4, 85
#: Tokens that two prefixes must share, for sets large enough; tokens that make two sets similar enough for one home.
SHARED, HOME = 16, 8
#: Components of this many ids or more are groups of their own; members of a group that are compared at once, about.
BLOCK, CHUNK = 64, 128
#: Partners that an id meets in one chunk, about.
ASKERS = 2_000
#: Counters of the sketch, as a power of two, and the rows that a task hands it on in.
SKETCH_BITS, SKETCH_ROWS = 20, 64


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if it has fewer words."""
    w = Words(text, lower=True)
    return np.unique(w.grams(min(k, len(w)))) if len(w) else np.empty(0, np.uint64)


def least_overlap(n, percent: int = PERCENT):
    """The least overlap of a set of n with any set that it links with."""
    return (n * percent + 99) // 100


def slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _profile(k: int):
    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in slices(batches):
            sets = [shingle_set(t, k) for t in b.column("text").to_pylist()]
            for s in sets:
                np.add.at(counts, slot(s), 1)
            n = len(sets)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n": pa.array([len(s) for s in sets], pa.int64()),
                "set_hash": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "part": pa.nulls(n, pa.int32()), "counts": pa.nulls(n, pa.binary()),
            })
        parts = counts.reshape(SKETCH_ROWS, -1)
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.nulls(SKETCH_ROWS, pa.int64()), "n": pa.nulls(SKETCH_ROWS, pa.int64()), "set_hash": pa.nulls(SKETCH_ROWS, pa.binary()),
            "part": pa.array(range(SKETCH_ROWS), pa.int32()), "counts": pa.array([np.minimum(p, 65_535).astype("<u2").tobytes() for p in parts], pa.binary()),
        })

    return run


def _add_up(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each part of the sketch; batch after batch, so that memory doesn't grow with the tasks."""
    total = 0
    for b in batches:
        for x in b.column("counts").to_pylist():
            total = total + np.frombuffer(x, "<u2" if len(x) == 2 * (1 << SKETCH_BITS) // SKETCH_ROWS else "<i8").astype(np.int64)
    yield pa.RecordBatch.from_pydict({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def rarity(sketch: DataFrame) -> np.ndarray:
    """A level for each counter: 0 up to twice the root of the mean over it (what chance makes of tokens that stand in one
    text), then one more for each doubling of the excess."""
    merged = (
        sketch.withColumn("deal", F.pmod(F.xxhash64("counts"), F.lit(64))).groupBy("part", "deal").applyInArrow(_add_up, "part int, counts binary")
        .groupBy("part").applyInArrow(_add_up, "part int, counts binary").collect()
    )  # SKETCH_ROWS rows of fixed size
    counts = np.zeros((SKETCH_ROWS, (1 << SKETCH_BITS) // SKETCH_ROWS))
    for part, x in merged:
        counts[part] = np.frombuffer(x, "<i8")
    counts = counts.ravel()
    mean = max(1.0, counts.mean())
    return np.ceil(np.log2(np.maximum(1, (counts - mean) / (2 * np.sqrt(mean))))).astype(np.int8)


def _prefixes(levels, k: int, percent: int):
    def run(batches):
        for b in slices(batches):
            tokens, ids, rarest = [], [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                s = shingle_set(text, k)
                n = len(s)
                if not n:
                    continue
                a = least_overlap(n, percent)
                p = s[np.argsort(levels.value[slot(s)], kind="stable")][: n - a + min(SHARED, a)]
                tokens.append(p)
                ids.append(doc_id)
                rarest.append(np.arange(len(p)) <= n - a)
            token = np.concatenate([*tokens, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_pydict({"token": pa.array(token), "id": pa.array(np.repeat(np.array(ids, np.int64), [len(p) for p in tokens])), "rare": pa.array(np.concatenate([*rarest, np.empty(0, bool)]))})

    return run


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, tokens) of the documents whose id is in ids."""

    def run(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_pydict({"id": b.column("doc_id"), "tokens": pa.array([shingle_set(t, k).tobytes() for t in b.column("text").to_pylist()], pa.binary())})

    return keep_ids(docs, ids).mapInArrow(run, "id long, tokens binary")


class Group:
    """Members of one chunk of a group, with the union of their tokens."""

    def __init__(self):
        self.ids, self.gs, self.sets, self.union = [], [], [], None

    def add(self, member: int, g: int, tokens: np.ndarray) -> None:
        if len(tokens):
            self.ids.append(member)
            self.gs.append(g)
            self.sets.append(tokens)

    def links(self, asker: int, g: int, x: np.ndarray, percent: int) -> list[int]:
        """One member for each other component that x links with."""
        if not self.sets or not len(x):
            return []
        if self.union is None:
            flat = np.concatenate(self.sets)
            self.union, self._at = np.unique(flat, return_inverse=True)
            self._sizes = np.array([len(s) for s in self.sets])
            self._starts = np.cumsum(self._sizes) - self._sizes
        at = np.minimum(np.searchsorted(self.union, x), len(self.union) - 1)
        at = at[self.union[at] == x]
        if len(at) < least_overlap(len(x), percent):  # no member can reach the overlap
            return []
        mark = np.zeros(len(self.union), np.int32)
        mark[at] = 1
        both = np.add.reduceat(mark[self._at], self._starts)
        found = {}
        for i in np.flatnonzero(100 * both >= percent * (len(x) + self._sizes - both)):
            if self.ids[i] != asker and self.gs[i] != g:
                found.setdefault(self.gs[i], self.ids[i])
        return list(found.values())


def _open(percent: int):
    """Rows in the order home, block, chunk, members before askers: links (asker, member)."""

    def run(batches):
        at, group = None, None
        for b in batches:
            out = []
            for *key, asks, member, g, tokens in zip(*(b.column(c).to_pylist() for c in ("home", "block", "chunk", "asks", "id", "g", "tokens"))):
                if at != key:
                    at, group = key, Group()
                x = np.frombuffer(tokens, "<u8")
                if asks:
                    out += [(member, y) for y in group.links(member, g, x, percent)]
                else:
                    group.add(member, g, x)
            a, c = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(c, pa.int64())})

    return run


def _met(docs: DataFrame, roles: DataFrame, k: int, percent: int) -> DataFrame:
    """Durable links (a, b) of askers with members. roles: durable, discarded here, with home, block, chunk (who meets
    where), asks (1 or 0), id and g (component). The sets are made where the texts are read, and each is sent once for each
    of its roles."""
    ids = durable(roles.select("id").distinct(), "role-ids")
    n = BROADCAST_IDS // 5  # a role takes five times the bytes of an id
    few = roles.limit(n + 1).count() <= n
    dealt = _sets(docs, ids, k).join(F.broadcast(roles) if few else roles, "id").repartition("home", "block", "chunk").sortWithinPartitions("home", "block", "chunk", "asks")
    links = durable(dealt.select("home", "block", "chunk", "asks", "id", "g", "tokens").mapInArrow(_open(percent), "a long, b long").distinct(), "links")
    discard(roles, ids)
    return links


def linked_pairs(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets link, as a durable table. pairs: durable and distinct. An id with many
    partners meets them in chunks of ASKERS."""
    chunks = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / ASKERS).alias("chunks"))
    hot = durable(chunks.filter(F.col("chunks") > max(1, pairs.count() // ASKERS // HOT_KEYS)), "hot-partners")  # HOT_KEYS rows at most
    many = F.coalesce("chunks", F.lit(1).cast("long"))
    ask = pairs.join(F.broadcast(hot), "b", "left").select(F.col("b").alias("home"), F.lit(-1).cast("long").alias("block"), F.pmod(F.xxhash64("a"), many).alias("chunk"), F.lit(1).alias("asks"), F.col("a").alias("id"), F.col("a").alias("g"))
    stay = ask.select("home", "block", "chunk", F.lit(0).alias("asks"), F.col("home").alias("id"), F.col("home").alias("g")).distinct()
    return _met(docs, durable(ask.unionByName(stay), "pair-roles"), k, percent)


def may_fit(percent: int) -> str:
    """Whether a member of group m that lists the token is of a size that may link with q."""
    return f"m.most * 100 >= q.n * {percent} and q.n2 * 100 >= m.least * {percent}"


def candidates(held: DataFrame, matrix: DataFrame, percent: int) -> DataFrame:
    """Distinct (id, home, block): groups that hold one of the set's rarest tokens as one of theirs, not the set's own component,
    and of two large components only the smaller one asking."""
    q, m = held.filter("rare").alias("q"), matrix.filter("rare").alias("m")
    larger = "(q.block = -1 or m.weight > q.weight or m.weight = q.weight and m.block < q.block) and not (m.block = -1 and q.block <> -1) and m.block <> if(q.block = -1, -2, q.block)"
    met = q.join(m, F.expr(f"q.token = m.token and {larger} and {may_fit(percent)}"))
    return met.select(F.col("q.id").alias("id"), F.col("m.home").alias("home"), F.col("m.block").alias("block")).distinct()


def jaccard_links(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(profile, classes, links): profile has doc_id, n, set_hash of every row; classes the first id and size of each
    set_hash; links has pairs of class names that link.

    The links suffice for the components: each linked pair of classes is a link or inside one component."""
    docs = key_rows(docs, "doc_id", "text")
    both = durable(docs.mapInArrow(_profile(k), "doc_id long, n long, set_hash binary, part int, counts binary"), "profile")
    profile = both.filter("part is null").select("doc_id", "n", "set_hash")
    levels = docs.sparkSession.sparkContext.broadcast(rarity(both.filter("part is not null").select("part", "counts")))
    known = profile.filter("n > 0 and doc_id is not null")
    classes = durable(known.groupBy("set_hash").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size")), "classes")
    copies = durable(known.select("doc_id").distinct().join(classes.select(F.col("first").alias("doc_id")), "doc_id", "left_anti"), "copies")

    listed = drop_ids(docs.filter("doc_id is not null"), copies).mapInArrow(_prefixes(levels, k, percent), "token long, id long, rare boolean")
    listed = durable(listed, "prefixes")
    discard(copies)
    leads = listed.groupBy("token").agg(F.min("id").alias("lead"), F.max("id").alias("last")).filter("lead < last").drop("last")
    shared = durable(listed.join(leads, "token"), "shared")
    discard(listed)
    # what an id's tokens need not carry: sizes of its set, or of both where the id repeats, and how many tokens a partner shares
    least = lambda n: F.floor((n * percent + 99) / 100)
    sized = known.groupBy(F.col("doc_id").alias("id")).agg(F.min("n").cast("int").alias("n"), F.max("n").cast("int").alias("n2"))
    sized = durable(sized.withColumn("need", F.least(F.lit(SHARED), least(least(F.col("n")))).cast("int")), "sizes")  # partners have least(n) tokens at least
    counted = shared.filter("id > lead").groupBy(F.col("id").alias("a"), F.col("lead").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    counted = durable(counted.join(sized.select(F.col("id").alias("a"), "need"), "a").filter(f"c >= need or c >= {HOME}"), "lead-counts")
    to_leads = counted.filter("c >= need").select("a", "b")
    first_links = linked_pairs(docs, to_leads, k, percent)

    groups = components(first_links)
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("weight"))
    joined = groups.join(sizes, "component").select("id", F.col("component").alias("g"), "weight")
    home = counted.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("home"))
    home = home.join(home.select(F.col("id").alias("home"), F.col("home").alias("further")), "home", "left").select("id", F.coalesce("further", "home").alias("home"))
    g, weight = F.coalesce("g", "id"), F.coalesce("weight", F.lit(1))
    own = sized.join(joined, "id", "left").join(home, "id", "left")
    own = own.select("id", "n", "n2", "need", g.alias("g"), F.coalesce("home", "id").alias("home"), F.when(weight >= BLOCK, g).otherwise(-1).alias("block"), F.when(weight >= BLOCK, weight).otherwise(0).alias("weight"))
    held = shared.select("token", "id", "rare").join(own, "id")
    spans = held.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high")).filter("low < high").select("token")
    held = durable(held.join(spans, "token", "left_semi"), "spanning")
    discard(shared, counted, sized)
    matrix = held.groupBy("token", "home", "block").agg(F.first("weight").alias("weight"), F.min("n").alias("least"), F.max("n2").alias("most"), F.bool_or("rare").alias("rare"))
    matrix = durable(matrix, "matrix")
    seen = durable(candidates(held, matrix, percent), "candidates")
    q, m = held.drop("home", "block").join(seen, "id").alias("q"), matrix.alias("m")
    counts = q.join(m, F.expr("q.token = m.token and q.home = m.home and q.block = m.block and " + may_fit(percent)))
    opened = counts.groupBy(F.col("q.id").alias("id"), F.col("q.home").alias("home"), F.col("q.block").alias("block")).agg(F.count(F.lit(1)).alias("c"), F.min("q.need").alias("need")).filter("c >= need")
    places = durable(held.select("id", "g", "home", "block").distinct(), "places")
    opened = durable(opened.select("id", "home", "block").join(places.select("id", "g"), "id"), "opened")
    discard(held, matrix, seen)
    members = places.join(opened.select("home", "block").distinct(), ["home", "block"], "left_semi")
    chunks = members.groupBy("home", "block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    stay = members.join(chunks, ["home", "block"]).select("id", "g", "home", "block", F.pmod(F.xxhash64("id"), "chunks").alias("chunk"), F.lit(0).alias("asks"))
    ask = opened.join(chunks, ["home", "block"]).select("id", "g", "home", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("asks"))
    roles = durable(stay.unionByName(ask), "roles")
    discard(places, opened)
    more = _met(docs, roles, k, percent)
    return profile, classes, first_links.unionByName(more)


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id.

    A null or wordless text has an empty set and is its own component. Rows that repeat an id are one node: a link of
    either is a link of the id. A null id takes no part and its component is null. Equal sets always link. An empty table
    gives an empty result; other columns of docs are not read; very long texts count whole. Shingles are compared as 64-bit
    hashes of their words, sets as digests or sorted lists of these."""
    profile, classes, links = jaccard_links(docs, k, percent)
    known = profile.filter("n > 0 and doc_id is not null")
    repeats = known.select("doc_id", "set_hash").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc_id")
    ties = join_keyed(known.join(repeats, "doc_id", "left_semi"), classes, ["set_hash"], "size").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    found = components(links.unionByName(ties))
    return (
        join_keyed(profile, classes, ["set_hash"], "size", "left")
        .select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("first")).otherwise(F.col("doc_id")).alias("class"))
        .join(found.withColumnRenamed("id", "class"), "class", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class").alias("component_id"))
    )


def keep_one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs, all columns, with only the smallest id of each component. Rows without words or with a null id stay; rows that
    repeat the id that stays all stay; an empty table stays empty."""
    gone = jaccard_components(docs, k, percent).filter("component_id < doc_id").select("doc_id").distinct()
    return drop_ids(docs, durable(gone, "near-copies"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
      FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b USING (shingle) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
          WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.y) AS component_id
FROM d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""
